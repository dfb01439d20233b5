"""Analytical queries over the master table.

Each view is one lazy DataFrame over the whole master. The master has one
row per city-day, so every aggregate here runs after map-side partial
aggregation; single-row results (bounds, global minima) are joined back as
scalar subqueries (evaluated once, no join).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from heatgrid.functions.dates import in_range
from heatgrid.functions.numeric import exact_mean, pct_change, safe_corr, sum_or_zero
from heatgrid.functions.temperature import (
    TEMP_BIN_LABELS, WEEKDAYS, day_order, is_weekend, temp_bin_label,
    temp_bin_order, temp_metric,
)
from heatgrid.functions.text import energy_text, pct_text
from heatgrid.sources.local import local_table

TEMP = "temp_for_analysis"
MISSING_ENERGY_SIZE = 1000.0  # map marker size when energy is missing (fixed value)


# ---------------------------------------------------------------- base frames
def coordinates(city_dim: DataFrame) -> DataFrame:
    """``(city, latitude, longitude)``; a duplicated configured name: last wins."""
    return (
        city_dim.filter(F.col("city").isNotNull())
        .groupBy("city")
        .agg(F.max_by("latitude", "cfg_pos").alias("latitude"),
             F.max_by("longitude", "cfg_pos").alias("longitude"))
    )


def with_coordinates(master: DataFrame, city_dim: DataFrame) -> DataFrame:
    """Attach coordinates by city; unknown city -> NULL."""
    return master.join(coordinates(city_dim), "city", "left").select(
        *master.columns, "latitude", "longitude")


def date_filtered(master: DataFrame, city_dim: DataFrame, start=None, end=None,
                  metric: str = "max") -> DataFrame:
    """All cities inside the date range, chosen temperature present.

    Default bounds are the master's own min and max date, which only drops
    the NULL-dated placeholder rows, so no bounds aggregate is needed.
    """
    if start is not None and end is not None and str(start) > str(end):
        raise ValueError("end date must be on or after start date")
    df = with_coordinates(master.filter(in_range(F.col("date"), start, end)), city_dim)
    return df.withColumn(TEMP, temp_metric(metric)).filter(F.col(TEMP).isNotNull())


def select_city(df: DataFrame, city: str | None) -> DataFrame:
    """City selection: None means all cities."""
    return df if city is None else df.filter(F.col("city") == city)


def analysis_base(master: DataFrame, city_dim: DataFrame, start=None, end=None,
                  metric: str = "max", city: str | None = None) -> DataFrame:
    """The frame every view reads: filtered master + coordinates + temperature."""
    return select_city(date_filtered(master, city_dim, start, end, metric), city)


# ---------------------------------------------------------------- bounds
def date_bounds(master: DataFrame) -> DataFrame:
    """``(min_date, max_date)`` of the master (A10)."""
    return master.agg(F.min("date").alias("min_date"), F.max("date").alias("max_date"))


def city_list(master: DataFrame) -> DataFrame:
    """Distinct cities, ascending (A10, O3)."""
    return master.select("city").distinct().orderBy("city")


# ---------------------------------------------------------------- KPIs
def kpis(base: DataFrame, master: DataFrame, start=None, end=None) -> DataFrame:
    """Headline metrics (A6): cities, requested duration in days, three means.

    Duration is end - start + 1 of the requested range (defaults: master
    bounds), not the number of observed days. No row when ``base`` is empty.
    ``master`` is only read when a bound is missing.
    """
    if start is not None and end is not None:
        dur = F.datediff(F.lit(end).cast("date"), F.lit(start).cast("date")) + 1
    else:
        # one scalar subquery over the master (evaluated once, no join)
        b = master.agg(F.struct(F.min("date").alias("lo"), F.max("date").alias("hi"))).scalar()
        lo = F.lit(start).cast("date") if start is not None else b.getField("lo")
        hi = F.lit(end).cast("date") if end is not None else b.getField("hi")
        dur = F.datediff(hi, lo) + 1
    stats = base.agg(
        F.count(F.lit(1)).alias("_n"),
        F.count_distinct("city").alias("n_cities"),
        F.round(F.avg("TMAX_F"), 6).alias("avg_tmax_f"),
        F.round(F.avg("TMIN_F"), 6).alias("avg_tmin_f"),
        F.round(exact_mean(F.col("energy_mwh")), 6).alias("avg_energy_mwh"),
    ).filter(F.col("_n") > 0)
    out = stats.withColumn("duration_days", dur)
    return out.select("n_cities", F.col("duration_days").cast("int").alias("duration_days"),
                      "avg_tmax_f", "avg_tmin_f", "avg_energy_mwh")


# ---------------------------------------------------------------- time series
def time_series(base: DataFrame) -> DataFrame:
    """One table for all per-city traces: ``(date, city, temp, energy)``."""
    return base.select("date", "city", TEMP, "energy_mwh")


def total_energy_by_date(base: DataFrame) -> DataFrame:
    """Energy summed over cities per date; all-NULL date -> 0.0 (A5)."""
    return base.groupBy("date").agg(sum_or_zero(F.col("energy_mwh")).alias("total_energy_mwh"))


def weekend_bands(base: DataFrame) -> DataFrame:
    """Distinct weekend dates with their ±12 h shading bounds."""
    d = F.col("date")
    ts = d.cast("timestamp_ntz")
    return (
        base.filter(is_weekend(d)).select("date").distinct()
        .select("date",
                (ts - F.expr("INTERVAL 12 HOURS")).alias("band_start"),
                (ts + F.expr("INTERVAL 12 HOURS")).alias("band_end"))
    )


# ---------------------------------------------------------------- regression
def _pairs(base: DataFrame) -> DataFrame:
    return base.filter(F.col(TEMP).isNotNull() & F.col("energy_mwh").isNotNull())  # F6


def ols_correlation(base: DataFrame, digits: int = 6) -> DataFrame:
    """Pooled OLS energy ~ 1 + temp and Pearson r in one aggregate.

    Constant temperature gives NULL intercept/slope/r2; constant energy
    gives NULL r2 and r (no division error under ANSI).
    """
    y, x = F.col("energy_mwh"), F.col(TEMP)
    const_y = F.stddev_samp(y) == 0
    return _pairs(base).agg(
        F.count(F.lit(1)).alias("n"),
        F.round(F.regr_intercept(y, x), digits).alias("intercept"),
        F.round(F.regr_slope(y, x), digits).alias("slope"),
        F.round(F.when(~const_y, F.regr_r2(y, x)), digits + 3).alias("r2"),
        F.round(safe_corr(x, y), digits + 3).alias("r"),
    ).filter(F.col("n") > 0)


def regression_line(base: DataFrame, digits: int = 6) -> DataFrame:
    """The fitted line at min and max temperature: two points."""
    y, x = F.col("energy_mwh"), F.col(TEMP)
    fit = _pairs(base).agg(
        F.regr_intercept(y, x).alias("b0"), F.regr_slope(y, x).alias("b1"),
        F.min(x).alias("x_min"), F.max(x).alias("x_max"), F.count(F.lit(1)).alias("n"),
    ).filter(F.col("n") > 0)
    pts = fit.select("b0", "b1", F.explode(F.array(
        F.struct(F.lit(0).alias("point"), F.col("x_min").alias("x")),
        F.struct(F.lit(1).alias("point"), F.col("x_max").alias("x")))).alias("p"))
    return pts.select(
        "p.point",
        F.round(F.col("p.x"), digits).alias("temp"),
        F.round(F.col("b0") + F.col("b1") * F.col("p.x"), digits).alias("energy_fit"),
    )


# ---------------------------------------------------------------- latest rows
def latest_per_city(base: DataFrame) -> DataFrame:
    """Row at each city's maximum date, (city, date) being unique.

    One partial hash aggregate, a ``max_by`` per column: no ranking window sorts
    a city's rows, no join reads them again, and since a city has one row per
    date, all columns come from the same row.
    """
    last = [F.max_by(c, "date").alias(c) for c in base.columns if c not in ("city", "date")]
    return base.groupBy("city").agg(F.max("date").alias("date"), *last).select(*base.columns)


def _geo(latest: DataFrame, filtered: DataFrame, previous_day: Column, city: str | None) -> DataFrame:
    """The map's rows from the latest row per city, derived once.

    The colour range over every latest row (A11, before the city filter and
    F7) and the global previous day are windows over one row per city; previous
    energies come by one join on city and that day.
    """
    every = Window.partitionBy()
    e, p = F.col("energy_mwh"), F.col("energy_prev_day")
    marked = latest.withColumns({"color_min": F.min("energy_mwh").over(every),
                                 "color_max": F.max("energy_mwh").over(every), "_day": previous_day})
    before = filtered.select(F.col("city").alias("_city"), F.col("date").alias("_date"), e.alias("energy_prev_day"))
    m = marked.join(before, (F.col("city") == F.col("_city")) & (F.col("_day") == F.col("_date")), "left").withColumn(
        "energy_pct_change", pct_change(e, p))
    m = select_city(m, city).filter(
        F.col("latitude").isNotNull() & F.col("longitude").isNotNull() & F.col(TEMP).isNotNull())
    return m.select(
        "city", "date", "latitude", "longitude", TEMP, "energy_mwh", "energy_prev_day",
        "energy_pct_change",
        F.coalesce(e, F.lit(MISSING_ENERGY_SIZE)).alias("size_for_map"),
        energy_text(e).alias("hover_energy_text"),
        pct_text(F.col("energy_pct_change")).alias("hover_pct_change_text"),
        "color_min", "color_max",
    )


def geo_latest(filtered: DataFrame, city: str | None = None) -> DataFrame:
    """Map table.

    ``filtered`` is the all-city date-filtered frame. The previous day is one
    global date: the minimum over cities of their latest date, minus one.
    """
    previous = F.date_sub(F.min("date").over(Window.partitionBy()), 1)
    return _geo(latest_per_city(filtered), filtered, previous, city)


def geo_latest_per_city_prev(filtered: DataFrame, city: str | None = None) -> DataFrame:
    """Documented variant: each city compared with its own previous day."""
    return _geo(latest_per_city(filtered), filtered, F.date_sub("date", 1), city)


# ---------------------------------------------------------------- heatmap
def with_temp_bins(base: DataFrame) -> DataFrame:
    """Rows with their temperature bin ordinal and label."""
    o = temp_bin_order(F.col(TEMP))
    return base.withColumn("bin_order", o).withColumn("temp_bin", temp_bin_label(F.col("bin_order")))


def _bin_table(spark: SparkSession) -> DataFrame:
    return local_table(spark, list(enumerate(TEMP_BIN_LABELS)), "bin_order int, temp_bin string")


def usage_heatmap_long(base: DataFrame) -> DataFrame:
    """Complete 6×7 grid ``(temp_bin, day_of_week, avg_energy_mwh)``.

    Pooled mean over city-days, half-even to 0 decimals; empty cells NULL.
    """
    spark = base.sparkSession
    cells = (
        with_temp_bins(base)
        .groupBy("bin_order", day_order(F.col("date")).alias("day_order"))
        .agg(F.bround(exact_mean(F.col("energy_mwh")), 0).alias("avg_energy_mwh"))
    )
    grid = local_table(
        spark,
        [(b, bl, d, dn) for b, bl in enumerate(TEMP_BIN_LABELS) for d, dn in enumerate(WEEKDAYS)],
        "bin_order int, temp_bin string, day_order int, day_of_week string",
    )  # the 42 fixed cells
    return grid.join(cells, ["bin_order", "day_order"], "left").select(
        "bin_order", "temp_bin", "day_order", "day_of_week", "avg_energy_mwh")


def usage_heatmap(base: DataFrame) -> DataFrame:
    """Wide heatmap: one row per bin in fixed order, one column per weekday.

    One conditional mean per weekday in a single aggregate (the weekday names
    are fixed), so it is one codegen'd hash aggregate and one shuffle.
    """
    dow = day_order(F.col("date"))
    e = F.col("energy_mwh")
    cells = (
        with_temp_bins(base).filter(F.col("bin_order").isNotNull())
        .groupBy("bin_order")
        .agg(*[F.bround(exact_mean(F.when(dow == k, e)), 0).alias(d) for k, d in enumerate(WEEKDAYS)])
    )
    # at most 6 rows (one per bin) by construction: a proven broadcast bound
    return (
        _bin_table(base.sparkSession).join(F.broadcast(cells), "bin_order", "left")
        .select("bin_order", "temp_bin", *WEEKDAYS)
    )
