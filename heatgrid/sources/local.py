"""Small driver-side tables with exact size statistics.

``spark.createDataFrame(list)`` yields an RDD scan whose size the optimizer
cannot know (it assumes "huge"), so a join with it never broadcasts and may
shuffle the large side. A parameterized ``VALUES`` list is a local relation
with exact row count and size: the optimizer's size-checked broadcast
applies, and sort-merge join remains the fallback beyond the threshold.
Values are bound as parameters, never spliced into the SQL text.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def local_table(spark: SparkSession, rows: Sequence[Sequence], schema: T.StructType | str) -> DataFrame:
    if isinstance(schema, str):
        schema = T._parse_datatype_string(schema)
    names = [f.name for f in schema.fields]
    casts = ", ".join(f"cast(c{k} as {f.dataType.simpleString()}) as `{f.name}`"
                      for k, f in enumerate(schema.fields))
    cols = ", ".join(f"c{k}" for k in range(len(names)))
    if not rows:
        nulls = ", ".join("null" for _ in names)
        return spark.sql(f"select {casts} from values ({nulls}) as t({cols}) where false")
    args, tuples = {}, []
    for i, row in enumerate(rows):
        marks = []
        for k, v in enumerate(row):
            key = f"p{i}_{k}"
            args[key] = v
            marks.append(f":{key}")
        tuples.append("(" + ", ".join(marks) + ")")
    return spark.sql(f"select {casts} from values {', '.join(tuples)} as t({cols})", args=args)
