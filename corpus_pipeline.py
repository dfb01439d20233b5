"""A corpus pipeline over ``documents``: each stage reads what the one before it wrote.

Quality classifier, line dedup, n-gram Jaccard join, benchmark decontamination,
packing. All stages but the last return the columns of ``documents``. Rows with
null or empty texts go with the first stage (nothing in them can be good).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from heatgrid.llm import (best_fit_packing, edit_decontamination, line_crf, ngram_jaccard_join, queries, shared,
                          window_line_dedup)


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the classifier takes for good."""
    queries.prepare_workers(spark)
    model = line_crf.train(docs, queries.labels_to_learn(spark, sf_dir))
    return line_crf.score(docs, model).filter("score >= 0.5").select(*docs.columns)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents without repeated passages; those of which nothing is left go."""
    queries.prepare_workers(spark)
    cut = window_line_dedup.dedup_lines(docs).filter("lines_removed = 0 or trim(text) <> ''")
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        cut = cut.withColumn("n_chars", F.when(F.col("lines_removed") > 0, F.char_length("text").cast(kind))
                             .otherwise(F.col("n_chars")))
    return cut.select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of linked documents the one with the smallest doc_id; rows without doc_id stay.

    Rows that repeat a doc_id with another text are documents like any other; of
    those that repeat it with the same text one stays.
    """
    queries.prepare_workers(spark)
    named, nameless = docs.filter("doc_id is not null"), docs.filter("doc_id is null")
    if named.groupBy("doc_id").count().filter("count > 1").limit(1).count():
        one = _one_of_each_group(shared.Stage(spark, "near-duplicates"), named)
    else:
        groups = ngram_jaccard_join.jaccard_components(named)
        one = named.join(groups.filter("component_id <> doc_id").select("doc_id"), "doc_id", "left_anti")
    return one.select(*docs.columns).unionByName(nameless)


def _one_of_each_group(stage: shared.Stage, named: DataFrame) -> DataFrame:
    """The same where ids repeat: each (doc_id, text) gets a number of its own, which the join links."""
    named = named.withColumn("__text", F.unhex(F.md5(F.encode(F.coalesce(F.col("text").cast("string"), F.lit("")),
                                                              "UTF-8"))))
    keys = stage.keep("keys", named.select("doc_id", "__text").distinct()
                      .withColumn("__row", F.monotonically_increasing_id()))
    rows = stage.keep("rows", named.join(keys, ["doc_id", "__text"]).dropDuplicates(["__row"]))
    groups = ngram_jaccard_join.jaccard_components(rows.select(F.col("__row").alias("doc_id"), "text"))
    first = (groups.withColumnRenamed("doc_id", "__row").join(keys, "__row").groupBy("component_id")
             .agg(F.min(F.struct("doc_id", "__text", "__row")).alias("first")).select("first.__row"))
    return rows.join(first, "__row", "left_semi")


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that hold no benchmark item."""
    queries.prepare_workers(spark)
    return edit_decontamination.decontaminate(docs, queries.table(spark, sf_dir, "benchmark"))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The places of the documents' pieces in sequences."""
    queries.prepare_workers(spark)
    return best_fit_packing.pack(docs, queries.tokenizer("word_bpe_49k.json"))


STAGES = [("quality", quality), ("line_dedup", line_dedup), ("near_duplicates", near_duplicates),
          ("decontamination", decontamination), ("packing", packing)]

#: The classifier's training, the joins and the tokenizer are beyond SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows for the tables in ``sf_dir``."""
    stage = shared.Stage(spark, "pipeline")
    docs = queries.table(spark, sf_dir, "documents")
    for k, (name, step) in enumerate(STAGES):
        docs = stage.keep(name, step(spark, docs, sf_dir))
        if k:
            stage.drop(STAGES[k - 1][0])
    return docs
