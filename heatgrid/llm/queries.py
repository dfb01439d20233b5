"""The registered queries of this subpackage: one per operator, over whole tables."""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

import heatgrid
from heatgrid.llm import (best_fit_packing, cross_polytope, deleted_interpolation, edit_decontamination,
                          edit_token_counts, line_crf, minimax_sharding, ngram_jaccard_join, prefix_trie,
                          spelling_variants, trigram_secrets, window_line_dedup, zstd_language)

Query = Callable[[SparkSession, str], DataFrame]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer(name: str) -> str:
    """The path of a public tokenizer's file; the same on every executor."""
    import public_tokenizers
    return public_tokenizers.path(name)


def remainder(column: Column, k: int) -> Column:
    return F.crc32(column.cast("string")) % k


def labels_to_learn(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "labels").filter(remainder(F.col("doc_id"), 3) != 1)


def op1_line_crf(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = line_crf.train(docs, labels_to_learn(spark, sf_dir))
    return line_crf.score(docs, model, keep_text=False).select(
        "doc_id", (F.coalesce(remainder(F.col("doc_id"), 3), F.lit(0)) == 1).alias("held_out"), "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"), "n_lines", "bad_lines")


def op2_deleted_interpolation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return deleted_interpolation.lm_scores(table(spark, sf_dir, "documents"))


def op3_cross_polytope(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cross_polytope.near_duplicates(table(spark, sf_dir, "embeddings"))


def op4_edit_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return edit_decontamination.find_items(table(spark, sf_dir, "documents").select("doc_id", "text"),
                                           table(spark, sf_dir, "benchmark"))


def op5_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return best_fit_packing.pack(table(spark, sf_dir, "documents"), tokenizer("word_bpe_49k.json"))


def op6_window_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    text = F.coalesce("text", F.lit(""))
    lines = F.size(F.split(text, "\n")).alias("lines_total")
    total = docs.select("doc_id", F.col("text"), lines)
    return window_line_dedup.dedup_lines(total).select(
        "doc_id", F.col("lines_total").cast("long").alias("lines_total"),
        F.col("lines_removed").cast("long").alias("lines_removed"), F.md5(text).alias("kept_md5"))


def op7_minimax_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minimax_sharding.shard(table(spark, sf_dir, "documents"))


def op8_edit_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three edits to every document, from its own text: a cut, an insertion and a replacement,
    at places that a hash of its doc_id chooses."""
    import public_tokenizers
    docs = table(spark, sf_dir, "documents").select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    size = F.char_length("text") + 1
    pick = lambda k, n: F.pmod(F.xxhash64("doc_id", F.lit(k)), n).cast("int")

    def edit(seq: int, length: int, copied: int) -> Column:
        copy = F.substring(F.col("text"), pick(10 + seq, size), F.lit(copied)) if copied else F.lit("")
        return F.struct(F.lit(seq).cast("long").alias("seq"), pick(seq, size).cast("long").alias("start"),
                        F.lit(length).cast("long").alias("length"), copy.alias("replacement"))
    edits = F.array(edit(1, 12, 0), edit(2, 0, 30), edit(3, 8, 20))
    return edit_token_counts.count_edited(docs.withColumn("edits", edits), tokenizer("byte_bpe_50k.tiktoken"),
                                          public_tokenizers.PATTERN)


def op9_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_jaccard_join.jaccard_components(table(spark, sf_dir, "documents"))


def op10_trigram_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trigram_secrets.find_secrets(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op11_zstd_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows without doc_id are neither learned from nor held out."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    fold = remainder(F.col("doc_id"), 5)
    model = zstd_language.train(docs.filter(fold != 0))
    found = zstd_language.identify(docs.select("doc_id", "text"), model, keep_text=False)
    return found.select("doc_id", (F.coalesce(fold, F.lit(1)) == 0).alias("held_out"), "lang_pred", "score", "margin",
                        F.col("language").isNull().alias("rejected"))


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.prefix_trie(table(spark, sf_dir, "conversations"))


def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling_variants.spelling_variants(table(spark, sf_dir, "documents"))


_QUERIES = (op1_line_crf, op2_deleted_interpolation, op3_cross_polytope, op4_edit_decontamination,
            op5_best_fit_packing, op6_window_line_dedup, op7_minimax_sharding, op8_edit_token_counts,
            op9_ngram_jaccard_join, op10_trigram_secrets, op11_zstd_language, op12_prefix_trie,
            op13_spelling_variants)


def prepare_workers(spark: SparkSession) -> None:
    """Python workers on machines that hold this package at the same path import it from there,
    and give freed blocks of 1 MB and more back to the system: they outlive their tasks."""
    root = os.path.dirname(os.path.dirname(os.path.abspath(heatgrid.__file__)))
    environment = spark.sparkContext.environment
    paths = environment.get("PYTHONPATH", os.environ.get("PYTHONPATH", "")).split(os.pathsep)
    if root not in paths:
        environment["PYTHONPATH"] = os.pathsep.join([root, *filter(None, paths)])
    environment |= {"ARROW_DEFAULT_MEMORY_POOL": "system", "MALLOC_MMAP_THRESHOLD_": str(1 << 20),
                    "MALLOC_TRIM_THRESHOLD_": str(1 << 20)}


def _ready(query: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        prepare_workers(spark)
        return query(spark, sf_dir)
    return run


def queries() -> dict[str, Query]:
    return {q.__name__: _ready(q) for q in _QUERIES}


def oracle_sql() -> dict[str, str]:
    return {"op6_window_line_dedup": window_line_dedup.oracle_sql()}
