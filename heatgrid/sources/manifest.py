"""File manifests (J6, S6): which landed files a run reads, which file a day comes from, which files are damaged.

A landed file is named ``<source>_<slug>_<from>_to_<to>.json``. The manifest
lists a landing folder without opening a file; files whose range does not meet
the run's are pruned there, so they are never read and cannot fail the run.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from heatgrid.sources.local import local_table

MANIFEST = "path string, _file string, source string, slug string, from_day date, to_day date, modified timestamp"
_NAME = r"^(noaa|eia)_(.+)_(\d{4}-\d{2}-\d{2})_to_(\d{4}-\d{2}-\d{2})\.json$"


def name_parts(name: Column) -> dict[str, Column]:
    """Source, slug and range of a landed file's name; empty or null for other names."""
    day = lambda k: F.try_to_date(F.nullif(F.regexp_extract(name, _NAME, k), F.lit("")), "yyyy-MM-dd")
    return {"source": F.regexp_extract(name, _NAME, 1), "slug": F.regexp_extract(name, _NAME, 2),
            "from_day": day(3), "to_day": day(4)}


def meets(from_day: Column, to_day: Column, start, end) -> Column:
    """Whether a file's range meets the run's; no bound means all days."""
    cond = from_day.isNotNull() & to_day.isNotNull()
    if start is not None:
        cond = cond & (to_day >= F.lit(str(start)).cast("date"))
    if end is not None:
        cond = cond & (from_day <= F.lit(str(end)).cast("date"))
    return cond


def list_files(spark: SparkSession, path: str, source: str) -> DataFrame:
    """Manifest of one source's landed files under ``path``: a listing, no file is opened."""
    found = (spark.read.format("binaryFile").option("recursiveFileLookup", "true")
             .option("pathGlobFilter", f"{source}_*.json").load(path)
             .select("path", F.element_at(F.split("path", "/"), -1).alias("_file"),
                     F.col("modificationTime").alias("modified")))
    parts = name_parts(F.col("_file"))
    return (found.select("path", "_file", *(c.alias(k) for k, c in parts.items()), "modified")
            .filter((F.col("source") == source) & F.col("from_day").isNotNull() & F.col("to_day").isNotNull()))


def files_of_run(manifest: DataFrame, start=None, end=None) -> DataFrame:
    """The files a run reads: a slug's file of exactly the run's range alone, as a run writes it; else all
    files whose range meets the run's."""
    near = manifest.filter(meets(F.col("from_day"), F.col("to_day"), start, end))
    if start is None or end is None:
        return near
    exact = (F.col("from_day") == F.lit(str(start)).cast("date")) & (F.col("to_day") == F.lit(str(end)).cast("date"))
    own = near.filter(exact).select("slug").distinct()
    return near.join(own, "slug", "left_anti").unionByName(near.filter(exact))


def chosen(spark: SparkSession, path: str, source: str, start=None, end=None) -> DataFrame:
    """``files_of_run`` of a folder, as a table of the driver: Spark's own file index holds the same paths there."""
    columns = [f.split()[0] for f in MANIFEST.split(", ")]
    rows = files_of_run(list_files(spark, path, source), start, end).select(*columns).orderBy("path").collect()
    if len(rows) > 1000:
        return spark.createDataFrame(rows, MANIFEST)
    return local_table(spark, [tuple(r) for r in rows], MANIFEST)


def day_owners(manifest: DataFrame, rows: DataFrame, owners: DataFrame, start=None, end=None) -> DataFrame:
    """(city, date, _file): the one file each day of a city comes from.

    Of the files that cover the day by name or hold a row of it, the one
    modified last, then the one with the greater name. ``rows`` (city, _file,
    date) are aggregated already; days without a date count as a day.
    """
    low = F.col("from_day") if start is None else F.greatest("from_day", F.lit(str(start)).cast("date"))
    high = F.col("to_day") if end is None else F.least("to_day", F.lit(str(end)).cast("date"))
    files = manifest.join(owners, "slug").select("city", "_file", "modified", low.alias("low"), high.alias("high"))
    covered = files.filter("low <= high").select(
        "city", "_file", "modified", F.explode(F.sequence("low", "high")).alias("date"))
    held = (rows.select("city", "_file", "date").distinct()
            .join(files.select("city", "_file", "modified"), ["city", "_file"])
            .select("city", "_file", "modified", "date"))
    return (covered.unionByName(held).groupBy("city", "date")
            .agg(F.max(F.struct("modified", "_file")).alias("last")).select("city", "date", F.col("last._file")))


def of_owners(rows: DataFrame, owners: DataFrame) -> DataFrame:
    """The rows (city, _file, date and any others) whose file owns their day."""
    o = owners.select(F.col("city").alias("_c"), F.col("date").alias("_d"), F.col("_file").alias("_f"))
    same = (F.col("city") == F.col("_c")) & (F.col("_file") == F.col("_f")) & F.col("date").eqNullSafe(F.col("_d"))
    return rows.join(o, same, "left_semi")


# ---------------------------------------------------------------- damaged table files
def _probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Why a Parquet file cannot be read, null if it can: its footer and every page are decoded."""
    import pyarrow.parquet as pq
    for batch in batches:
        said = []
        for content in batch.column(1):
            try:
                parquet = pq.ParquetFile(pa.BufferReader(content.as_buffer()))
                for group in range(parquet.num_row_groups):
                    parquet.read_row_group(group)
                said.append(None)
            except (pa.ArrowException, OSError) as e:
                said.append(str(e).splitlines()[0][:200])
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(said, pa.string())], names=["path", "error"])


def quarantine(spark: SparkSession, path: str) -> DataFrame:
    """(path, error) of the damaged Parquet files under ``path``, found by one task a few files.

    Files are read whole: meant for tables of bounded files, as ``processed``
    is. Spark's reader brings the bytes, so any storage that it reads will do.
    """
    files = (spark.read.format("binaryFile").option("recursiveFileLookup", "true")
             .option("pathGlobFilter", "*.parquet").load(path).select("path", "content"))
    return files.mapInArrow(_probe, "path string, error string").filter("error is not null")
