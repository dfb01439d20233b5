"""Written tables, gapless numbers and linked groups: what several operators use."""

from __future__ import annotations

import gc
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from heatgrid.session import ensure_checkpoint_dir


class Stage:
    """Tables written under the shared checkpoint folder; they cut lineage, so a
    lost executor costs no more than the step at hand."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"

    def keep(self, name: str, df: DataFrame, codec: str = "snappy") -> DataFrame:
        path = f"{self.path}/{name}"
        df.write.mode("overwrite").option("compression", codec).parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def release(self) -> None:
        """Let Spark's cleaner delete the shuffle files of finished steps now:
        it goes by the driver's garbage collections, which small drivers make seldom."""
        gc.collect()
        self.spark.sparkContext._jvm.System.gc()

    def drop(self, name: str) -> None:
        """Delete a table that no later step reads."""
        jvm, sc = self.spark.sparkContext._jvm, self.spark.sparkContext
        path = jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}")
        path.getFileSystem(sc._jsc.hadoopConfiguration()).delete(path, True)


def one_table(batches: Iterator[pa.RecordBatch], schema: pa.Schema) -> pa.Table:
    return pa.Table.from_batches(list(batches), schema)


def numbered(stage: Stage, name: str, df: DataFrame, keys: list[str], out: str) -> DataFrame:
    """Number the rows of each key value from 0, gapless, in an order fixed once.

    The rows are written with their task and their number within it; the tasks'
    counts per key then give each task's first number. No key's rows meet in
    one task, whatever its share. Order: by task, then by row.
    """
    part, local, rows = f"__{out}_part", f"__{out}_local", f"__{out}_rows"
    kinds = T.StructType([*df.schema.fields, T.StructField(part, T.IntegerType()),
                          T.StructField(local, T.LongType())])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, seen = TaskContext.get().partitionId(), {}
        for batch in batches:
            cols = [batch.column(batch.schema.get_field_index(k)).to_numpy(zero_copy_only=False) for k in keys]
            code = np.zeros(batch.num_rows, np.int64)
            names = []
            for c in cols:
                values, at = np.unique(c, return_inverse=True)
                code = code * len(values) + at
                names.append(values)
            order = np.argsort(code, kind="stable")
            codes, first, n = np.unique(code[order], return_index=True, return_counts=True)
            number = np.empty(batch.num_rows, np.int64)
            number[order] = np.arange(batch.num_rows) - np.repeat(first, n)
            base = np.empty(len(codes), np.int64)
            for i, (c, k) in enumerate(zip(codes.tolist(), n.tolist())):
                key = []
                for values in reversed(names):
                    c, r = divmod(c, len(values))
                    key.append(values[r])
                base[i] = seen.get(key := tuple(key), 0)
                seen[key] = base[i] + k
            number += base[np.searchsorted(codes, code)]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(np.full(batch.num_rows, task, np.int32)), pa.array(number)],
                names=[*batch.schema.names, part, local])

    written = stage.keep(name, df.mapInArrow(count, kinds))
    sums = written.groupBy(*keys, part).agg(F.count("*").alias(rows))
    before = (f"coalesce(sum({rows}) over (partition by {', '.join(f'`{k}`' for k in keys)} order by {part} "
              "rows between unbounded preceding and 1 preceding), 0)")
    starts = stage.keep(f"{name}_starts", sums.select(*keys, part, F.expr(before).alias(rows)))
    return (written.join(starts, [*keys, part])
            .withColumn(out, F.col(local) + F.col(rows)).drop(part, local, rows))


def components(stage: Stage, name: str, links: DataFrame, rounds: int = 60) -> DataFrame:
    """(id, comp) of every id in ``links`` (a, b): the smallest id that links reach.

    Labels start at an id's smallest neighbour. In a round, each link offers
    its two labels' smaller one to the greater one's id and to both ends, then
    labels step to their label's label. A group settles in about as many
    rounds as the logarithm of its longest path. Each round is a written
    table; nothing but the count of changes comes to the driver.
    """
    both = stage.keep(f"{name}_links", links.select("a", "b").unionByName(
        links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct())
    label = stage.keep(f"{name}_0", both.groupBy(F.col("a").alias("id")).agg(
        F.least(F.min("b"), F.first("a")).alias("comp")))
    for k in range(1, rounds):
        near = (both.join(label.select(F.col("id").alias("b"), F.col("comp").alias("near")), "b")
                .groupBy(F.col("a").alias("id")).agg(F.min("near").alias("near")))
        seen = label.join(near, "id").select("id", "comp", F.least("comp", "near").alias("next"))
        offered = (seen.select("id", "next").unionByName(seen.select(F.col("comp").alias("id"), "next"))
                   .groupBy("id").agg(F.min("next").alias("next")))
        jump = offered.select(F.col("id").alias("next"), F.col("next").alias("far"))
        fresh = (label.join(offered, "id").join(jump, "next", "left")
                 .select("id", F.least("next", F.coalesce("far", "next")).alias("comp"),
                         F.col("comp").alias("was")))
        fresh = stage.keep(f"{name}_{k}", fresh)
        changed = fresh.filter("comp <> was").limit(1).count()
        stage.drop(f"{name}_{k - 1}")
        label = fresh.select("id", "comp")
        if not changed:
            return label
    raise RuntimeError(f"links did not settle in {rounds} rounds")


def forest(edges: list[np.ndarray], n: int) -> list[tuple[int, int]]:
    """Links between each member and the first of its component."""
    label = np.arange(n)
    pairs = np.concatenate(edges) if edges else np.zeros((0, 2), np.int64)
    while len(pairs):
        before = label.copy()
        low = np.minimum(label[pairs[:, 0]], label[pairs[:, 1]])
        for side in (0, 1):
            np.minimum.at(label, pairs[:, side], low)
            np.minimum.at(label, before[pairs[:, side]], low)
        label = label[label]
        if (label == before).all():
            break
    return [(int(label[i]), int(i)) for i in np.flatnonzero(label != np.arange(n))]
