"""Raw readings -> one row per city and day.

All per-day work is a single hash aggregate on ``(city, date)``: keep-first
dedup and the TMAX/TMIN pivot are fused into it, so the raw table is scanned
once and shuffled only after map-side partial aggregation (at most one row per
city-day per task). Landed files, which can fail as a whole, are aggregated
with their file as a key: their failures and the days they own are judged on
the aggregated rows (``weather_keys``, ``energy_keys``, ``verdicts``), by joins
on the file. No window sorts or scans a city.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from heatgrid.functions.dates import bad_day, in_range, to_day
from heatgrid.functions.numeric import coerce_double, sum_or_zero
from heatgrid.functions.temperature import c_to_f

# Weather datatypes that become columns, and BA codes that mean
# "no energy source" after trimming and upper-casing.
PIVOT_DATATYPES = ["TMAX", "TMIN"]
NO_BA_CODES = ["NONE", "N/A"]


# ---------------------------------------------------------------- city gates
def valid_cities(city_dim: DataFrame) -> DataFrame:
    """Configured entries that are processed: name and station id present.

    Configuration entries carry ``entry_complete`` (both keys present, even
    with an empty value, as the reference checks); other dimensions use
    non-NULL values.
    """
    if "entry_complete" in city_dim.columns:
        return city_dim.filter(F.col("city").isNotNull() & F.col("entry_complete"))
    return city_dim.filter(F.col("city").isNotNull() & F.col("noaa_station_id").isNotNull())


def ba_available(ba: Column) -> Column:
    """BA gate (S5): present, non-empty and not NONE / N/A after trim+upper."""
    return ba.isNotNull() & (F.length(ba) > 0) & ~F.upper(F.trim(ba)).isin(*NO_BA_CODES)


def energy_cities(city_dim: DataFrame) -> DataFrame:
    """Cities whose energy is fetched: valid entries passing the BA gate."""
    return valid_cities(city_dim).filter(ba_available(F.col("eia_ba_code"))).select("city")


def gate_energy(raw_energy: DataFrame, city_dim: DataFrame) -> DataFrame:
    """Raw energy rows of cities that pass the BA gate (semi join, no columns added)."""
    return raw_energy.join(energy_cities(city_dim), "city", "left_semi")


# ---------------------------------------------------------------- weather
def _has_corrupt(raw: DataFrame) -> bool:
    return "_corrupt" in raw.columns


def _row_is_bad(raw: DataFrame) -> Column:
    bad = bad_day(raw, "date")
    if _has_corrupt(raw):
        bad = bad | F.col("_corrupt").isNotNull()
    return bad


def _file_checks_needed(raw: DataFrame) -> bool:
    """Whole-file failures (Q4) can only occur for text dates or JSON scans."""
    return _has_corrupt(raw) or dict(raw.dtypes)["date"] == "string"


def weather_in_range(raw: DataFrame, start=None, end=None) -> DataFrame:
    """Raw readings inside an inclusive run range (S6); pushed to the scan.

    Readings without a date are kept: they make a day of their own (A3). So are
    rows whose date text does not parse, and a failed file is still seen (and
    reported) as a whole by Q4.
    """
    if start is None and end is None:
        return raw
    keep = in_range(to_day(raw, "date"), start, end) | F.col("date").isNull()
    if _file_checks_needed(raw):
        keep = keep | _row_is_bad(raw)
    return raw.filter(keep)


def weather_dedup(raw: DataFrame) -> DataFrame:
    """First reading per (city, date, datatype) in landing order.

    ``min_by`` keeps the value of the earliest ``pos`` even when it is NULL,
    and is a partial aggregate: hot keys are combined map-side.
    """
    return (
        raw.groupBy("city", to_day(raw, "date").alias("date"), "datatype")
        .agg(F.min_by("value", "pos").alias("value"))
    )


def weather_fahrenheit(raw: DataFrame) -> DataFrame:
    """Deduplicated TMAX/TMIN readings converted to °F."""
    return (
        weather_dedup(raw.filter(F.col("datatype").isin(*PIVOT_DATATYPES)))
        .select("city", "date", "datatype", c_to_f(F.col("value")).alias("temp_f"))
    )


def _fused_daily(raw: DataFrame) -> DataFrame:
    """One aggregate per (city, date): keep-first TMAX and TMIN."""
    dt = F.col("datatype")
    aggs = []
    for name in PIVOT_DATATYPES:
        hit = dt == name
        aggs.append(F.min_by(F.when(hit, F.col("value")), F.when(hit, F.col("pos"))).alias(name))
    return raw.groupBy("city", to_day(raw, "date").alias("date")).agg(*aggs)


def _fahrenheit(pivoted: DataFrame, city_dim: DataFrame | None) -> DataFrame:
    daily = pivoted.select(
        "city", "date",
        c_to_f(F.col("TMAX")).alias("TMAX_F"),
        c_to_f(F.col("TMIN")).alias("TMIN_F"),
    )
    if city_dim is not None:
        daily = daily.join(valid_cities(city_dim).select("city"), "city", "left_semi")
    return daily


def weather_daily(raw: DataFrame, city_dim: DataFrame | None = None,
                  start=None, end=None) -> DataFrame:
    """Wide daily weather ``(city, date, TMAX_F, TMIN_F)``.

    Days that only carry other datatypes still give a row of NULLs; NULL
    dates form one row per city. A landed file that failed (Q4) contributes
    nothing; readings that can fail are read twice here, once for the failed
    files (a refresh stages ``weather_keys`` instead).
    """
    raw = weather_in_range(raw, start, end)
    if _file_checks_needed(raw):
        return weather_daily_from_keys(weather_keys(raw), city_dim)
    return _fahrenheit(_fused_daily(raw), city_dim)


def file_columns(df: DataFrame) -> list[str]:
    """What names a landed file: its city, and the file where a city can have several."""
    return ["city", "_file"] if "_file" in df.columns else ["city"]


def failed_files(keys: DataFrame) -> DataFrame:
    """Landed files with any corrupt record or unparsable date (Q4)."""
    return keys.filter("bad").select(*file_columns(keys)).distinct()


def sound(keys: DataFrame, failed: DataFrame | None = None, owners: DataFrame | None = None) -> DataFrame:
    """Rows of files that did not fail, each city's day from one file.

    ``owners`` (city, date, _file) names the file of each day; without it the
    greatest file name that holds the day has it.
    """
    kept = keys.join(failed_files(keys) if failed is None else failed, file_columns(keys), "left_anti")
    if "_file" not in keys.columns:
        return kept
    if owners is None:
        owners = kept.groupBy("city", "date").agg(F.max("_file").alias("_file"))
    o = owners.select(F.col("city").alias("_c"), F.col("date").alias("_d"), F.col("_file").alias("_f"))
    same = (F.col("city") == F.col("_c")) & (F.col("_file") == F.col("_f")) & F.col("date").eqNullSafe(F.col("_d"))
    return kept.join(o, same, "left_semi")


def weather_keys(raw: DataFrame) -> DataFrame:
    """Refresh stage: one row per (city, landed file, date, datatype) of the raw readings.

    ``value`` is the first reading in landing order, ``n`` the number of
    readings (duplicates when > 1, Q1) and ``bad`` whether any of them is a
    corrupt record or has an unparsable date (Q4). A single partial hash
    aggregate over the raw table feeds the daily pivot and both checks.
    """
    aggs = [F.min_by("value", "pos").alias("value"), F.count(F.lit(1)).alias("n")]
    aggs.append((F.bool_or(_row_is_bad(raw)) if _file_checks_needed(raw) else F.lit(False)).alias("bad"))
    return raw.groupBy(*file_columns(raw), to_day(raw, "date").alias("date"), "datatype").agg(*aggs)


def weather_daily_from_keys(keys: DataFrame, city_dim: DataFrame | None = None, failed: DataFrame | None = None,
                            owners: DataFrame | None = None) -> DataFrame:
    """``weather_daily`` from the stage table; failed files contribute nothing.

    Keys are unique per (city, date, datatype) once each day has one file, so
    ``max`` picks the one value.
    """
    dt = F.col("datatype")
    return _fahrenheit(
        sound(keys, failed, owners).groupBy("city", "date")
        .agg(*[F.max(F.when(dt == name, F.col("value"))).alias(name) for name in PIVOT_DATATYPES]), city_dim)


def verdicts(weather: DataFrame, energy: DataFrame | None = None) -> DataFrame:
    """Per landed file whether it failed as a whole, and its duplicate groups and rows (Q1, Q4).

    ``weather`` and ``energy`` are the stages ``weather_keys`` and
    ``energy_keys``. ``file`` is null where a city has one landed file only.
    """
    def file(keys: DataFrame) -> Column:
        return (F.col("_file") if "_file" in keys.columns else F.lit(None).cast("string")).alias("file")
    twice = F.col("n") > 1
    out = weather.groupBy(*file_columns(weather)).agg(
        F.bool_or("bad").alias("failed"), F.count(F.when(twice, 1)).alias("duplicate_groups"),
        F.coalesce(F.sum(F.when(twice, F.col("n"))), F.lit(0)).alias("duplicate_rows")).select(
        F.lit("noaa").alias("source"), file(weather), "city", "failed", "duplicate_groups", "duplicate_rows")
    if energy is None:
        return out
    none = F.lit(0).cast("long")
    return out.unionByName(energy.groupBy(*file_columns(energy)).agg(F.bool_or("bad").alias("failed")).select(
        F.lit("eia").alias("source"), file(energy), "city", "failed", none.alias("duplicate_groups"),
        none.alias("duplicate_rows")))


def failed_of(judged: DataFrame, source: str, keys: DataFrame) -> DataFrame:
    """The failed files of one source in a verdict table, as ``keys`` names files."""
    bad = judged.filter((F.col("source") == source) & F.col("failed"))
    return bad.select("city", *([F.col("file").alias("_file")] if "_file" in keys.columns else []))


# ---------------------------------------------------------------- energy
def energy_coerced(raw_energy: DataFrame) -> DataFrame:
    """``(city, date, energy_mwh)`` per record, value coerced to double."""
    return raw_energy.select(
        "city",
        to_day(raw_energy, "period").alias("date"),
        coerce_double(F.col("value")).alias("energy_mwh"),
    )


def of_respondent(raw_energy: DataFrame, city_dim: DataFrame) -> DataFrame:
    """Records of the city's own balancing authority (S8); records without a respondent stay."""
    ba = valid_cities(city_dim).select(F.col("city").alias("_city"), F.trim("eia_ba_code").alias("_ba"))
    own = F.col("respondent").isNull() | (F.trim("respondent") == F.col("_ba"))
    return raw_energy.join(ba, (F.col("city") == F.col("_city")) & own, "left_semi")


def energy_keys(raw_energy: DataFrame, city_dim: DataFrame | None = None, start=None, end=None) -> DataFrame:
    """Refresh stage: one row per (city, landed file, date) with the day's exact sum, rounded half-even to 2
    decimals (A4, P9), and whether any record is corrupt or has an unparsable period.

    NULL values are skipped, an all-NULL day gives 0.0. Only cities passing
    the BA gate contribute (S5), and of records that name a respondent only
    those of the city's BA (S8).
    """
    if city_dim is not None and "respondent" in raw_energy.columns:
        raw_energy = of_respondent(raw_energy, city_dim)
    bad = bad_day(raw_energy, "period")
    if _has_corrupt(raw_energy):
        bad = bad | F.col("_corrupt").isNotNull()
    rec = raw_energy.select(
        *file_columns(raw_energy), to_day(raw_energy, "period").alias("date"),
        coerce_double(F.col("value")).alias("energy_mwh"), bad.alias("bad"))
    keys = (rec.filter(in_range(F.col("date"), start, end) | F.col("bad"))
            .groupBy(*file_columns(rec), "date")
            .agg(sum_or_zero(F.col("energy_mwh")).alias("energy_mwh"), F.bool_or("bad").alias("bad")))
    if city_dim is not None:
        keys = keys.join(energy_cities(city_dim), "city", "left_semi")
    return keys


def energy_daily_from_keys(keys: DataFrame, failed: DataFrame | None = None,
                           owners: DataFrame | None = None) -> DataFrame:
    """Daily energy per city from the stage table; NULL dates and failed files are left out, without a warning."""
    return sound(keys.filter(F.col("date").isNotNull() | F.col("bad")), failed, owners).filter(
        F.col("date").isNotNull()).select("city", "date", "energy_mwh")


def energy_daily(raw_energy: DataFrame, city_dim: DataFrame | None = None,
                 start=None, end=None) -> DataFrame:
    """Daily energy per city (A4, P9): ``energy_keys`` of files that did not fail, NULL dates dropped."""
    keys = energy_keys(raw_energy, city_dim, start, end)
    if _has_corrupt(raw_energy) or dict(raw_energy.dtypes)["period"] == "string":
        return energy_daily_from_keys(keys)
    return keys.select("city", "date", "energy_mwh")
