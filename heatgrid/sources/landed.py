"""Scans of landed files (S1, S2, S10, S14, S15, S17) and the city they belong to.

Three landing layouts are read:

* ``array``, the reference layout: a flat folder of JSON-array files named
  ``<source>_<slug>_<start>_to_<end>.json`` (a JSON array cannot be split, so
  each such file is one task - the layout of legacy data). A manifest of the
  folder prunes files of other ranges before they are read (``manifest.py``);
* ``lines``, written by ``sinks.land_readings``: JSON Lines under
  ``<root>/slug=<slug>/``, splittable into as many tasks as the data needs;
* ``spans``, written by ``sinks.land_spans``: Parquet under
  ``<root>/slug=<slug>/span=<yyyy-MM or yyyy>/``; a run's range reads its spans only.

``pos`` (landing order, for keep-first) is ``monotonically_increasing_id`` taken
in the scan projection, before any shuffle: ids grow with the partition index
and the row index, and a file's splits are read in offset order, so the id
order is the file order. It is recomputed identically when a task is retried.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from heatgrid import schemas
from heatgrid.functions.dates import to_day
from heatgrid.operators.master import slug_owners
from heatgrid.sources import manifest, storage
from heatgrid.sources.local import local_table

_NAME_RE = r"^{src}_(.+)_(\d{{4}}-\d{{2}}-\d{{2}})_to_(\d{{4}}-\d{{2}}-\d{{2}})\.json$"


def _read_json(spark: SparkSession, path: str | list[str], schema, multi_line: bool) -> DataFrame:
    if not path:
        return _no_rows(spark, schema)
    reader = (
        spark.read.schema(schema)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", "_corrupt")
        .option("multiLine", str(multi_line).lower())
    )
    return reader.json(path)


def _no_rows(spark: SparkSession, schema) -> DataFrame:
    """A scan of no file, with the metadata that other scans have."""
    meta = F.struct(F.lit(None).cast("string").alias("file_name")).alias("_metadata")
    return local_table(spark, [], schema).select("*", meta)


def _with_city(df: DataFrame, source: str, city_dim: DataFrame) -> DataFrame:
    """Attach the configured city of each landed row.

    The slug comes from the ``slug=`` partition folder when present, else from
    the file name; the later-configured name owns a shared slug (P7).
    """
    if "slug" in df.columns:
        slug = F.col("slug")
    else:
        slug = F.regexp_extract(F.col("_file"), _NAME_RE.format(src=source), 1)
    keyed = df.withColumn("slug", slug)
    return keyed.join(slug_owners(city_dim), "slug").drop("slug")


def _read_spans(spark: SparkSession, path: str, source: str, start, end) -> DataFrame:
    """The spans that a range meets, and rows without a day of landings whose range meets it."""
    schema = schemas.WEATHER_SPANS if source == "noaa" else schemas.ENERGY_SPANS
    df = spark.read.schema(schema).parquet(path)
    span, undated = F.col("span"), F.col("span").isNull()
    if start is not None:
        df = df.filter((span >= F.substring(F.lit(str(start)), F.lit(1), F.length(span))) | undated)
    if end is not None:
        df = df.filter((span <= F.substring(F.lit(str(end)), F.lit(1), F.length(span))) | undated)
    parts = manifest.name_parts(F.col("landing"))
    meets = manifest.meets(parts["from_day"], parts["to_day"], start, end) | parts["from_day"].isNull()
    text = "date" if source == "noaa" else "period"
    return df.filter(~undated | meets).select(
        text, *(f.name for f in schema if f.name not in (text, "day", "pos", "seq", "landing", "slug", "span")),
        F.coalesce("day", to_day(df, text)).alias("_day"), F.coalesce("pos", F.col("seq").cast("decimal(38,0)")).alias("pos"),
        F.col("landing").alias("_file"), "slug")


def read_landed(spark: SparkSession, path: str, source: str, city_dim: DataFrame, multi_line: bool = False,
                layout: str | None = None, start=None, end=None, files: DataFrame | None = None) -> DataFrame:
    """Raw rows of one source (``noaa`` weather or ``eia`` energy) with ``city``, ``pos``, the landed file where
    a city can have several, and the corrupt-record column of JSON layouts.

    ``layout`` is ``array``, ``lines`` or ``spans`` (default: ``array`` with
    ``multi_line``, else ``lines``). A range reads what its landed files hold;
    ``files`` is the run's part of the manifest, if it was made already.
    """
    layout = layout or ("array" if multi_line else "lines")
    if layout == "spans":
        return _with_city(_read_spans(spark, path, source, start, end), source, city_dim)
    schema = schemas.RAW_WEATHER if source == "noaa" else schemas.RAW_ENERGY
    if layout == "array":
        files = manifest.chosen(spark, path, source, start, end) if files is None else files
        paths = [r.path for r in files.select("path").collect()]
        df = _read_json(spark, paths, schema, True).withColumn("_file", F.col("_metadata.file_name"))
    else:
        df = _read_json(spark, path, schema, False)
    # a landed sequence number wins; legacy files fall back to scan order
    df = df.withColumn("pos", F.coalesce(F.col("pos"), F.monotonically_increasing_id().cast("decimal(38,0)")))
    return _with_city(df, source, city_dim)


def read_weather(spark: SparkSession, path: str, city_dim: DataFrame, multi_line: bool = False,
                 **options) -> DataFrame:
    """``(city, date, datatype, value, pos, ...)``; an empty ``[]`` file gives no rows."""
    return read_landed(spark, path, "noaa", city_dim, multi_line, **options)


def read_energy(spark: SparkSession, path: str, city_dim: DataFrame, multi_line: bool = False,
                **options) -> DataFrame:
    """``(city, period, respondent, value, pos, ...)`` with ``value`` kept as text."""
    return read_landed(spark, path, "eia", city_dim, multi_line, **options)


def read_master(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """The master table with its explicit schema (CSV or Parquet), of the current version where one is committed."""
    path = storage.resolve(spark, path)
    if fmt == "csv":
        return spark.read.schema(schemas.MASTER).option("header", "true").csv(path)
    return spark.read.schema(schemas.MASTER).parquet(path)


def read_quality_report(spark: SparkSession, path: str) -> DataFrame:
    """The quality report written by ``sinks.write_quality_report``."""
    return spark.read.schema(schemas.QUALITY_REPORT).json(storage.resolve(spark, path))


def read_stations(spark: SparkSession, path: str) -> DataFrame:
    """A landed station catalogue (JSON Lines)."""
    return spark.read.schema(schemas.STATIONS).json(path)


def city_dim_from_entries(spark: SparkSession, entries: list[dict]) -> DataFrame:
    """City dimension from configuration entries.

    Entries keep their configuration order in ``cfg_pos``; ``name`` becomes
    ``city``. Coordinates given as text are cast (``stations.city_dim_cast``
    reports edits that do not parse).
    """
    rows = []
    for pos, e in enumerate(entries):
        def num(v):
            try:
                return None if v is None else float(v)
            except (TypeError, ValueError):
                return None
        rows.append((e.get("name"), e.get("state"), e.get("noaa_station_id"),
                     None if e.get("eia_ba_code") is None else str(e.get("eia_ba_code")),
                     num(e.get("latitude")), num(e.get("longitude")), pos,
                     "name" in e and "noaa_station_id" in e))
    return local_table(spark, rows, schemas.CITY_DIM_ENTRIES)
