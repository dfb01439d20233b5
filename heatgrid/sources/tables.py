"""Readers for the given Parquet tables (one file or folder per table).

Each reader selects only the columns its callers use, so the scan's
``ReadSchema`` is pruned even before Catalyst's own column pruning.

A plain ``spark.read.parquet(path)`` runs a footer-reading job to infer the
schema on every call; one query reads the same small dimension tables
several times, so the schema of each path is inferred once per session and
passed explicitly afterwards (no job, same plan).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from heatgrid.session import table_path

_SCHEMAS: dict[tuple[str, str], T.StructType] = {}


def _session_key(spark: SparkSession) -> str:
    try:
        return spark.sparkContext.applicationId
    except Exception:  # Spark Connect sessions expose no SparkContext
        return str(id(spark))


def table_schema(spark: SparkSession, path: str) -> T.StructType:
    key = (_session_key(spark), path)
    if key not in _SCHEMAS:
        _SCHEMAS[key] = spark.read.parquet(path).schema
    return _SCHEMAS[key]


def read_table(spark: SparkSession, sf_dir: str, name: str, *cols: str) -> DataFrame:
    path = table_path(sf_dir, name)
    df = spark.read.schema(table_schema(spark, path)).parquet(path)
    return df.select(*cols) if cols else df
