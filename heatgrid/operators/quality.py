"""Data-quality checks as distributed DataFrames.

Every check emits report rows ``(file, check, level, message, details)``.
``details`` is JSON text written like the reference's report (``json.dump``
separators); numbers are formatted from 2-decimal values so both engines
print them identically. Nothing is collected: a duplicate-heavy landing file
yields one summary row here and its member rows stay a table
(``duplicate_rows``), never one list in one cell.
"""

from __future__ import annotations

import functools

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from heatgrid.functions.dates import to_day
from heatgrid.functions.text import city_slug, py_float_text
from heatgrid.operators import clean, summary
from heatgrid.operators.numbering import numbered
from heatgrid.schemas import QUALITY_COLUMNS
from heatgrid.sources.local import local_table

WARNING, ERROR = "WARNING", "ERROR"
# Fixed report texts.
DUPLICATE_CHECK = "Duplicate Raw Data"
DUPLICATE_MESSAGE = ("Duplicate weather data points found. This can cause processing errors. "
                     "Taking first entry.")
TEMP_CHECK = "Temperature Logic"
ENERGY_CHECK = "Negative Energy"
PIVOT_CHECK = "Data Pivoting"
COMBINE_CHECK = "Processed File"
PIVOT_MESSAGE = ("Could not pivot data, likely due to duplicate TMAX/TMIN values for a single day. "
                 "Error: unparsable date or corrupt record in file")

# Documented thresholds (°F) of the outlier check.
TEMP_HIGH_F, TEMP_LOW_F = 130.0, -50.0


def landing_file(source: str, city: Column, start=None, end=None) -> Column:
    """Name of a city's landing file, e.g. ``noaa_new_york_2024-01-01_to_2024-12-31.json``."""
    suffix = f"_{start}_to_{end}.json" if start is not None and end is not None else ".json"
    return F.concat(F.lit(f"{source}_"), city_slug(city), F.lit(suffix))


def _report(df: DataFrame, file: Column, check: str, level: str, message: Column,
            details: Column) -> DataFrame:
    return df.select(file.alias("file"), F.lit(check).alias("check"), F.lit(level).alias("level"),
                     message.alias("message"), details.alias("details"))


def _json_date(d: Column) -> Column:
    return F.concat(F.lit('"'), d.cast("string"), F.lit('"'))


# ---------------------------------------------------------------- Q1
def duplicate_groups(raw: DataFrame) -> DataFrame:
    """``(city, date, datatype, n)`` keys read more than once (A1)."""
    return (
        raw.groupBy(*clean.file_columns(raw), to_day(raw, "date").alias("date"), "datatype")
        .agg(F.count(F.lit(1)).alias("n"))
        .filter(F.col("n") > 1)
    )


def duplicate_rows(raw: DataFrame, keep_pos: bool = False) -> DataFrame:
    """Every raw reading whose key is duplicated (the reference's details list).

    A join of the raw table with the duplicate keys: AQE broadcasts the key
    side when it is measured small and otherwise splits hot keys.
    """
    file = clean.file_columns(raw)
    keyed = raw.select(*file, to_day(raw, "date").alias("date"), "datatype", "value",
                       *([c for c in ("pos",) if c in raw.columns]))
    keys = duplicate_groups(raw).select(*(F.col(c).alias(f"_{c}") for c in (*file, "date", "datatype")))
    same = [F.col(c).eqNullSafe(F.col(f"_{c}")) if c == "date" else F.col(c) == F.col(f"_{c}")
            for c in (*file, "date", "datatype")]
    out = keyed.join(keys, functools.reduce(lambda x, y: x & y, same), "left_semi")
    return out if keep_pos else out.drop("pos")


def ordered_duplicates(raw: DataFrame, path: str) -> DataFrame:
    """The duplicate readings in the report's order (O1): by date, datatype and landing order, with their place
    in their file from 1. Written under ``path`` as a range-sorted table; no file's rows meet in one task."""
    rows = duplicate_rows(raw, keep_pos=True)
    file = clean.file_columns(rows)
    return numbered(rows, [*file, "date", "datatype", "pos"], file, "place", path).drop("pos")


def duplicate_details(groups: Column, rows: Column) -> Column:
    return F.concat(F.lit('{"duplicate_groups": '), groups.cast("string"),
                    F.lit(', "duplicate_rows": '), rows.cast("string"), F.lit("}"))


def q_duplicates(raw: DataFrame, start=None, end=None) -> DataFrame:
    """One WARNING per landing file that has duplicates (Q1)."""
    per_file = duplicate_groups(raw).groupBy(*clean.file_columns(raw)).agg(
        F.count(F.lit(1)).alias("groups"), F.sum("n").alias("rows"))
    return _report(per_file, file_of(per_file, "noaa", start, end), DUPLICATE_CHECK,
                   WARNING, F.lit(DUPLICATE_MESSAGE), duplicate_details(F.col("groups"), F.col("rows")))


# ---------------------------------------------------------------- Q2, Q3
class RowCheck:
    """A per-row check: its condition and the report columns of a flagged row."""

    def __init__(self, cond: Column, file: Column, check: str, level: str, message: Column, details: Column):
        self.cond, self.file, self.check, self.level = cond, file, check, level
        self.message, self.details = message, details


def report_struct(c: RowCheck) -> Column:
    return F.struct(c.file.alias("file"), F.lit(c.check).alias("check"), F.lit(c.level).alias("level"),
                    c.message.alias("message"), c.details.alias("details"))


def temp_logic_check(start=None, end=None) -> RowCheck:
    """TMIN_F > TMAX_F on a day; rows are flagged, not removed (F1, Q2)."""
    tmin, tmax = py_float_text(F.col("TMIN_F")), py_float_text(F.col("TMAX_F"))
    d = F.coalesce(F.col("date").cast("string"), F.lit("NaT"))
    msg = F.concat(F.lit("Date "), d, F.lit(": TMIN ("), tmin, F.lit("°F) > TMAX ("), tmax, F.lit("°F)."))
    details = F.concat(F.lit('{"date": '), F.coalesce(_json_date(F.col("date")), F.lit("null")), F.lit(', "tmin_f": '), tmin,
                       F.lit(', "tmax_f": '), tmax, F.lit("}"))
    return RowCheck(F.col("TMIN_F") > F.col("TMAX_F"), landing_file("noaa", F.col("city"), start, end),
                    TEMP_CHECK, WARNING, msg, details)


def negative_energy_check(start=None, end=None) -> RowCheck:
    """Summed daily energy below zero (F2, Q3)."""
    e = py_float_text(F.col("energy_mwh"))
    msg = F.concat(F.lit("Date "), F.col("date").cast("string"),
                   F.lit(": Negative energy consumption detected ("), e, F.lit(" MWh)."))
    details = F.concat(F.lit('{"date": '), F.coalesce(_json_date(F.col("date")), F.lit("null")), F.lit(', "energy_mwh": '), e, F.lit("}"))
    return RowCheck(F.col("energy_mwh") < 0, landing_file("eia", F.col("city"), start, end),
                    ENERGY_CHECK, WARNING, msg, details)


def _apply(df: DataFrame, c: RowCheck) -> DataFrame:
    return _report(df.filter(c.cond), c.file, c.check, c.level, c.message, c.details)


def q_temp_logic(weather_daily: DataFrame, start=None, end=None) -> DataFrame:
    """One WARNING per day with TMIN_F > TMAX_F (Q2)."""
    return _apply(weather_daily, temp_logic_check(start, end))


def q_negative_energy(energy_daily: DataFrame, start=None, end=None) -> DataFrame:
    """One WARNING per day whose summed energy is negative (Q3)."""
    return _apply(energy_daily, negative_energy_check(start, end))


# ---------------------------------------------------------------- Q4
def q_bad_files(raw: DataFrame, start=None, end=None) -> DataFrame:
    """One ERROR per weather file that fails as a whole (Q4): corrupt record or unparsable date."""
    if clean._file_checks_needed(raw):
        bad = clean.failed_files(clean.weather_keys(raw))
    else:
        bad = local_table(raw.sparkSession, [], "city string")
    return _report(bad, file_of(bad, "noaa", start, end), PIVOT_CHECK, ERROR, F.lit(PIVOT_MESSAGE), F.lit("{}"))


def file_of(df: DataFrame, source: str, start=None, end=None) -> Column:
    """A row's landed file: its own name where it carries one, else the run's file of its city."""
    name = landing_file(source, F.col("city"), start, end)
    return F.coalesce(F.col("_file"), name) if "_file" in df.columns else name


# ---------------------------------------------------------------- the report of a refresh (U4)
def _records(rows: DataFrame, checks: list) -> DataFrame:
    """Zero or more report rows of each row in one pass: the records whose condition holds."""
    arr = F.array(*[F.when(cond, rec) for cond, rec in checks])
    return rows.select(F.explode(F.filter(arr, lambda x: x.isNotNull())).alias("r")).select("r.*")


def file_report(judged: DataFrame, start=None, end=None) -> DataFrame:
    """Q1 and Q4 of a verdict table (``clean.verdicts``): weather files that failed, and those with duplicates."""
    weather = judged.filter(F.col("source") == "noaa")
    file = F.coalesce(F.col("file"), landing_file("noaa", F.col("city"), start, end))
    return _records(weather, [
        (~F.col("failed") & (F.col("duplicate_groups") > 0),
         report_struct(RowCheck(F.lit(True), file, DUPLICATE_CHECK, WARNING, F.lit(DUPLICATE_MESSAGE),
                                duplicate_details(F.col("duplicate_groups"), F.col("duplicate_rows"))))),
        (F.col("failed"),
         report_struct(RowCheck(F.lit(True), file, PIVOT_CHECK, ERROR, F.lit(PIVOT_MESSAGE), F.lit("{}")))),
    ])


def day_report(processed: DataFrame, start=None, end=None) -> DataFrame:
    """Q2 and Q3 in one pass over the processed rows."""
    return _records(processed, [(c.cond, report_struct(c)) for c in (temp_logic_check(start, end),
                                                                     negative_energy_check(start, end))])


def damage_report(damaged: DataFrame) -> DataFrame:
    """One ERROR per processed file that cannot be read (S10); its rows are left out of the master."""
    message = F.concat(F.lit("Could not read or process file: "), F.col("error"))
    return _report(damaged, F.element_at(F.split("path", "/"), -1), COMBINE_CHECK, ERROR, message,
                   F.concat(F.lit('{"city": "'), F.col("city"), F.lit('"}')))


def quality_view(report: DataFrame) -> DataFrame:
    """The table shown to users: level, check, message, file."""
    return report.select("level", "check", "message", "file")


def quality_summary(report: DataFrame) -> DataFrame:
    """Number of issues per check and level (A14's count)."""
    return report.groupBy("check", "level").agg(F.count(F.lit(1)).alias("n_issues"))


# ---------------------------------------------------------------- Q6-Q8
def q_missing_values(master: DataFrame) -> DataFrame:
    """Missing entries per city and column (Q6): counted per city, then unpivoted."""
    return summary.missing_values(summary.city_summary(master))


def q_outliers(master: DataFrame, high: float = TEMP_HIGH_F, low: float = TEMP_LOW_F) -> DataFrame:
    """Readings outside physical ranges (Q7): temperatures beyond the
    documented bounds and negative daily energy."""
    long = master.unpivot(["city", "date"], ["TMAX_F", "TMIN_F", "energy_mwh"], "column_name", "value")
    v, c = F.col("value"), F.col("column_name")
    is_temp = c.isin("TMAX_F", "TMIN_F")
    rule = (
        F.when(is_temp & (v > high), F.lit(f"temperature above {high:g}°F"))
        .when(is_temp & (v < low), F.lit(f"temperature below {low:g}°F"))
        .when((c == "energy_mwh") & (v < 0), F.lit("negative energy"))
    )
    return long.withColumn("rule", rule).filter(F.col("rule").isNotNull())


def q_freshness(master: DataFrame, as_of) -> DataFrame:
    """Latest date per city and days since it, against ``as_of`` (Q8)."""
    return summary.freshness(summary.city_summary(master), as_of)
