"""The refresh job: landed files -> processed -> master + quality report, as one atomic snapshot.

Each raw table is scanned once. Its aggregate by city, landed file and day is
written as a stage table, which cuts the lineage (a lost executor never
re-reads raw files for later steps) and is shared storage on a cluster. From
the stages a verdict per landed file is written: files that failed as a whole
are left out of both sources by an anti join on the file. Processed rows are
written per city, probed for damage, read back, completed with placeholders
and written as the master.

Everything goes to a new version folder; the pointer to it is replaced last,
so readers see the old master and report until both new ones are there. Then
the stages and older versions are deleted.
"""

from __future__ import annotations

import datetime as dt
import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from heatgrid.functions.dates import RunMode
from heatgrid.operators import clean, master as mst, quality, summary
from heatgrid.schemas import MASTER, QUALITY_COLUMNS
from heatgrid.sources import landed, manifest, sinks, storage

TABLES = ("processed", "master", "quality_report", "file_verdicts", "quarantine", "city_summary")
_STAGES = ("stage_weather_keys", "stage_energy_keys")
#: Damaged files that a run goes on without; more are a broken store, which stops the run.
MOST_DAMAGED = 10_000


def refresh(spark: SparkSession, weather_path: str, energy_path: str, city_dim: DataFrame,
            out_dir: str, mode: RunMode = RunMode(), as_of: dt.date | None = None,
            multi_line: bool = False, master_format: str = "parquet", layout: str | None = None) -> dict[str, str]:
    """Run one refresh; returns the written paths, which the next refresh but one retires.

    ``as_of`` defaults to today. ``layout`` is that of the landing folders
    (``landed.read_landed``).
    """
    start, end = mode.resolve(as_of or dt.date.today())
    layout = layout or ("array" if multi_line else "lines")
    files = {s: manifest.chosen(spark, p, s, start, end) if layout == "array" else None
             for s, p in (("noaa", weather_path), ("eia", energy_path))}
    raw_w, raw_e = (read(spark, path, city_dim, layout=layout, start=start, end=end, files=files[source])
                    for read, path, source in ((landed.read_weather, weather_path, "noaa"),
                                               (landed.read_energy, energy_path, "eia")))
    return refresh_raw(raw_w, raw_e, city_dim, out_dir, start, end, master_format, files)


def refresh_raw(raw_weather: DataFrame, raw_energy: DataFrame, city_dim: DataFrame, out_dir: str, start=None,
                end=None, master_format: str = "parquet", files: dict[str, DataFrame | None] | None = None,
                after_processed: Callable[[str], None] | None = None) -> dict[str, str]:
    """The refresh of raw rows. ``files`` is the manifest of each source whose cities can have several files;
    ``after_processed`` is called with the path of the processed table before it is read back."""
    spark = raw_weather.sparkSession
    version = storage.new_version(out_dir)
    paths = {k: os.path.join(version, k) for k in (*_STAGES, *TABLES)}

    def keep(name: str, df: DataFrame) -> DataFrame:
        df.write.mode("overwrite").parquet(paths[name])
        return spark.read.schema(df.schema).parquet(paths[name])

    weather = keep("stage_weather_keys", clean.weather_keys(clean.weather_in_range(raw_weather, start, end)))
    energy = keep("stage_energy_keys", clean.energy_keys(raw_energy, city_dim, start, end))
    judged = keep("file_verdicts", clean.verdicts(weather, energy))
    failed = {"noaa": clean.failed_of(judged, "noaa", weather), "eia": clean.failed_of(judged, "eia", energy)}
    owners = {s: None if not files or files.get(s) is None else manifest.day_owners(
        files[s], keys.join(failed[s], ["city", "_file"], "left_anti"), mst.slug_owners(city_dim), start, end)
        for s, keys in (("noaa", weather), ("eia", energy))}
    merged = mst.weather_energy_outer(
        clean.weather_daily_from_keys(weather, city_dim, failed["noaa"], owners["noaa"]),
        clean.energy_daily_from_keys(energy, failed["eia"], owners["eia"]))
    sinks.write_processed(merged, paths["processed"])
    if after_processed:
        after_processed(paths["processed"])
    processed, damaged = read_processed(spark, paths["processed"], paths["quarantine"])

    sinks.write_master(mst.master_of_processed(processed, city_dim), paths["master"], master_format)
    written = landed.read_master(spark, paths["master"], master_format)
    summary.city_summary(written).write.mode("overwrite").parquet(paths["city_summary"])
    sinks.write_quality_report(quality_report(judged, processed, damaged, start, end), paths["quality_report"])
    storage.commit(spark, out_dir, version)
    for stage in _STAGES:
        storage.delete(spark, paths.pop(stage))
    return paths


def read_processed(spark: SparkSession, path: str, quarantine_path: str) -> tuple[DataFrame, DataFrame]:
    """The processed rows of readable files, and the damaged files (path, city, error).

    The files are probed by a Spark job; damaged ones are kept as a table
    under ``quarantine_path`` and never opened again.
    """
    city = F.regexp_extract("path", r"/city=([^/]*)/", 1)
    name = F.when(city == "__HIVE_DEFAULT_PARTITION__", F.lit(None)).otherwise(
        F.expr("try_url_decode(replace(regexp_extract(path, '/city=([^/]*)/', 1), '+', '%2B'))"))
    found = manifest.quarantine(spark, path).select("path", name.alias("city"), "error")
    found.write.mode("overwrite").parquet(quarantine_path)
    damaged = spark.read.schema(found.schema).parquet(quarantine_path)
    bad = {r.path for r in damaged.select("path").limit(MOST_DAMAGED + 1).collect()}
    if len(bad) > MOST_DAMAGED:
        raise OSError(f"over {MOST_DAMAGED} damaged files under {path}")
    reader = spark.read.schema(MASTER).option("basePath", path)
    if not bad:
        return reader.parquet(path), damaged
    listed = (spark.read.format("binaryFile").option("recursiveFileLookup", "true")
              .option("pathGlobFilter", "*.parquet").load(path).select("path"))
    good = sorted({r.path for r in listed.collect()} - bad)
    if not good:
        return spark.createDataFrame([], MASTER), damaged
    return reader.parquet(*good), damaged


def quality_report(judged: DataFrame, processed: DataFrame, damaged: DataFrame | None = None, start=None,
                   end=None) -> DataFrame:
    """The report of a refresh (U4): Q1 and Q4 of the verdicts, Q2 and Q3 of the processed rows, damaged files."""
    report = quality.file_report(judged, start, end).unionByName(quality.day_report(processed, start, end))
    if damaged is not None:
        report = report.unionByName(quality.damage_report(damaged))
    return report.select(*QUALITY_COLUMNS)


def report_from_stage(keys: DataFrame, processed: DataFrame, start=None, end=None) -> DataFrame:
    """``quality_report`` of weather keys and processed rows."""
    return quality_report(clean.verdicts(keys), processed, None, start, end)
