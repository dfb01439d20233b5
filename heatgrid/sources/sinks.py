"""Sinks (S3, S9, S11, S13, S16). All overwrite: each refresh is a full snapshot."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from heatgrid import schemas
from heatgrid.functions.dates import span_of, to_day
from heatgrid.functions.text import city_slug
from heatgrid.operators.master import slug_owners
from heatgrid.schemas import MASTER_COLUMNS, QUALITY_COLUMNS


def land_readings(df: DataFrame, root: str, rebalance: bool = False, city_dim: DataFrame | None = None) -> None:
    """S3: land raw readings of many cities as splittable JSON Lines,
    one ``slug=`` folder per city. A city with no rows has no folder, which
    reads back as zero rows (the reference's empty ``[]`` file).

    Fetches normally arrive per city, so each task writes one folder and no
    shuffle is needed. When every task holds many cities, ``rebalance=True``
    adds an AQE rebalance on the slug first: rows of a city are gathered into
    advisory-sized partitions and a hot city is split across several, so the
    folder gets a few large files instead of one small file per task.

    With ``city_dim``, a slug's folder gets its owner's rows only (P7): of
    cities that share a slug, the last complete entry's file remains.
    """
    out = df.withColumn("slug", city_slug(F.col("city")))
    if city_dim is not None:
        out = out.join(slug_owners(city_dim), ["slug", "city"], "left_semi")
    out = out.drop("city")
    if rebalance:
        out = out.hint("rebalance", "slug")
    out.write.mode("overwrite").partitionBy("slug").json(root)


def land_spans(df: DataFrame, root: str, source: str, city_dim: DataFrame | None = None,
               start=None, end=None, grain: str = "month") -> None:
    """S3: land raw readings as Parquet under ``slug=`` and ``span=`` folders.

    A span is a month or, with ``grain="year"``, a year: runs of many years
    then make fewer, larger folders. Only the spans that ``df`` holds are
    replaced, each as a whole, so one can be landed again and the others stay.
    Rows are rebalanced by (slug, span): each task writes few folders, and a
    large city's span is several tasks' work. They keep the landing order
    (``pos``), so nothing is sorted by it and the input is read once. ``day``
    is the day of the row's text, parsed here for good. ``landing`` names the
    reference's file of the run. Rows whose day is missing or does not parse go
    to their city's folder without a span.
    """
    day = "date" if source == "noaa" else "period"
    cast = lambda c, kind: (F.col(c) if c in df.columns else F.lit(None)).cast(kind).alias(c)
    named = F.concat(F.lit(f"{source}_"), F.col("slug"),
                     F.lit(f"_{start}_to_{end}.json" if start is not None and end is not None else ".json"))
    fields = [cast("datatype", "string"), cast("value", "double")] if source == "noaa" else [
        cast("respondent", "string"), cast("value", "string")]
    if city_dim is not None:
        out = df.drop("slug").join(slug_owners(city_dim), "city")
    else:
        out = df.withColumn("slug", city_slug(F.col("city")))
    pos = F.col("pos") if "pos" in df.columns else F.monotonically_increasing_id()
    out = out.select(F.col(day).cast("string").alias(day), *fields, to_day(df, day).alias("day"),
                     pos.cast("decimal(38,0)").alias("pos"), "slug")
    out = out.withColumn("span", span_of(F.col("day"), grain)).hint("rebalance", "slug", "span")
    (out.withColumn("landing", named)
     .select(*(f.name for f in (schemas.WEATHER_SPANS if source == "noaa" else schemas.ENERGY_SPANS)
               if f.name != "seq"))
     .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("slug", "span").parquet(root))


def write_processed(merged: DataFrame, path: str) -> None:
    """Per-city processed table, one ``city=`` partition per city.

    Rebalanced by city: a city's rows are gathered into files of advisory
    size, and a city beyond that size is several tasks' work.
    """
    (merged.select(*MASTER_COLUMNS).hint("rebalance", "city")
       .write.mode("overwrite").partitionBy("city").parquet(path))


def sorted_master(master: DataFrame) -> DataFrame:
    """S11 order: city, then date, NULLs first (a range-partitioned sort)."""
    return master.orderBy(F.asc_nulls_first("city"), F.asc_nulls_first("date")).select(*MASTER_COLUMNS)


def write_master(master: DataFrame, path: str, fmt: str = "parquet") -> None:
    """The master table, full snapshot replace, globally ordered."""
    w = sorted_master(master).write.mode("overwrite")
    if fmt == "csv":
        w.option("header", "true").csv(path)
    else:
        w.parquet(path)


def write_quality_report(report: DataFrame, path: str) -> None:
    """The quality report as JSON Lines; an empty report is an empty table."""
    report.select(*QUALITY_COLUMNS).write.mode("overwrite").json(path)


def write_filtered_export(filtered: DataFrame, path: str) -> None:
    """The rows under the current filters, all columns, CSV with header."""
    filtered.write.mode("overwrite").option("header", "true").csv(path)
