"""Per-city summary of a master (A10, Q6, Q8): mergeable states that answer the small queries without the master."""

from __future__ import annotations

import functools

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MEASURES = ["date", "TMAX_F", "TMIN_F", "energy_mwh"]


def city_summary(master: DataFrame) -> DataFrame:
    """Per city the rows, the missing entries of each column and the first and last date."""
    return master.groupBy("city").agg(
        F.count(F.lit(1)).alias("n_rows"),
        *[(F.count(F.lit(1)) - F.count(c)).alias(f"missing_{c}") for c in MEASURES],
        F.min("date").alias("min_date"), F.max("date").alias("max_date"))


def merged(*summaries: DataFrame) -> DataFrame:
    """One summary of masters that share no row, from theirs."""
    rows = functools.reduce(DataFrame.unionByName, summaries)
    return rows.groupBy("city").agg(
        *[F.sum(c).alias(c) for c in ("n_rows", *(f"missing_{c}" for c in MEASURES))],
        F.min("min_date").alias("min_date"), F.max("max_date").alias("max_date"))


def date_bounds(summary: DataFrame) -> DataFrame:
    """``(min_date, max_date)`` of the master (A10)."""
    return summary.agg(F.min("min_date").alias("min_date"), F.max("max_date").alias("max_date"))


def city_list(summary: DataFrame) -> DataFrame:
    """The master's cities, ascending (A10, O3)."""
    return summary.select("city").orderBy("city")


def missing_values(summary: DataFrame) -> DataFrame:
    """Missing entries per city and column (Q6)."""
    named = summary.select("city", "n_rows", *(F.col(f"missing_{c}").alias(c) for c in MEASURES))
    return named.unpivot(["city", "n_rows"], MEASURES, "column_name", "n_missing").select(
        "city", "column_name", "n_rows", F.col("n_missing").cast("long").alias("n_missing"))


def freshness(summary: DataFrame, as_of) -> DataFrame:
    """Latest date per city and days since it, against ``as_of`` (Q8)."""
    return summary.select(
        "city", F.col("max_date").alias("latest_date"),
        F.datediff(F.lit(as_of).cast("date"), F.col("max_date")).cast("long").alias("days_since_latest"))
