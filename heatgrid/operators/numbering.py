"""Gapless numbers in a fixed order, without one task holding a key's rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

_ROW = (1 << 33) - 1        # bits of monotonically_increasing_id that count the rows of a task


def numbered(df: DataFrame, order: list[str], keys: list[str], out: str, path: str) -> DataFrame:
    """``df`` with ``out``: each row's place, from 1, among the rows of its ``keys`` in the order of ``order``.

    ``order`` begins with ``keys``. Rows are sorted over ranges and written
    under ``path`` with their task and place in it; a key that lies in several
    tasks starts in each where the task before ended. Only counts per key and
    task are added up, so a key may hold any share of the rows.
    """
    task, at, first, n = f"__{out}_task", f"__{out}_at", f"__{out}_first", f"__{out}_n"
    ranged = df.repartitionByRange(*order).sortWithinPartitions(*order)
    (ranged.withColumns({task: F.spark_partition_id(), at: F.monotonically_increasing_id().bitwiseAND(F.lit(_ROW))})
     .write.mode("overwrite").parquet(path))
    rows = df.sparkSession.read.parquet(path)
    sums = rows.groupBy(*keys, task).agg(F.min(at).alias(first), F.count("*").alias(n))
    before = Window.partitionBy(*keys).orderBy(task).rowsBetween(Window.unboundedPreceding, -1)
    starts = sums.select(*(F.col(k).alias(f"__{k}") for k in keys), F.col(task).alias("__task"), first,
                         F.coalesce(F.sum(n).over(before), F.lit(0)).alias(n))
    same = F.col(task) == F.col("__task")
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"__{k}"))
    place = F.col(n) + F.col(at) - F.col(first) + 1
    return rows.join(starts, same).select(*df.columns, place.alias(out))
