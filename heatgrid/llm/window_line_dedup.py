"""Removal of repeated passages of three lines or more.

Every run of three consecutive lines (blank ones do not count) is a window.
A window that occurs more than once, in any document, is repeated; its first
occurrence, by (doc_id, place), stays. The lines that later occurrences cover
are removed: windows overlap, so a passage of n lines is covered by n - 2
windows, and its cover is their union.

A window travels as its 128-bit hash, document and place. First occurrences
are found by a partial aggregation; the windows are then joined to the
repeated hashes only (one row each), which Spark's skew join may split, so a
frequent window does not load one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from heatgrid.llm import shared

LINES = 3


def _windows(width: int) -> Column:
    """Of array ``l`` of (place, line): per window the place of its first line, its lines' hash and places."""
    return F.expr(f"""
        transform(sequence(1, greatest(size(l) - {width - 1}, 0), 1), i -> named_struct(
            'w', unhex(md5(array_join(transform(slice(l, i, {width}), x -> x.line), chr(10)))),
            'places', transform(slice(l, i, {width}), x -> x.place)))""")


def repeated_lines(docs: DataFrame, width: int = LINES, stage: shared.Stage | None = None) -> DataFrame:
    """(row, places): per row (its ``row`` number, doc_id order decides) the places of lines to remove."""
    lines = F.filter(F.transform(F.split("text", "\n"), lambda x, i: F.struct(i.alias("place"), x.alias("line"))),
                     lambda x: F.trim(x["line"]) != "")
    with_lines = docs.select("row", lines.alias("l")).filter(f"size(l) >= {width}")
    windows = (with_lines.select("row", F.explode(_windows(width)).alias("x"))
               .select("row", "x.w", "x.places", F.col("x.places")[0].alias("place")))
    if stage:
        windows = stage.keep("windows", windows)
    repeated = (windows.groupBy("w").agg(F.count("*").alias("n"), F.min(F.struct("row", "place")).alias("first"))
                .filter("n > 1").select("w", "first"))
    return (windows.join(repeated, "w").filter(F.struct("row", "place") != F.col("first"))
            .select("row", F.explode("places").alias("place")).distinct()
            .groupBy("row").agg(F.sort_array(F.collect_list("place")).alias("places")))


def dedup_lines(docs: DataFrame, width: int = LINES) -> DataFrame:
    """``docs`` with repeated passages cut from its texts: all columns, and lines_removed.

    ``docs``: doc_id, text and any others, which stay as they are. Lines are
    split at ``\\n``; blank ones (spaces only) belong to no window, and are kept.
    Texts with fewer than ``width`` other lines have no window, and are kept.
    Null texts stay null. Rows are ordered by doc_id (null first), equal ids by
    text; equal rows are numbered in the order of their first reading. A text of
    which all lines are removed becomes empty; its row stays.
    """
    if "lines_removed" in docs.columns:
        docs = docs.drop("lines_removed")
    spark = docs.sparkSession
    stage = shared.Stage(spark, "line-dedup")
    columns = docs.columns
    order = F.struct(F.coalesce(F.col("doc_id").cast("long"), F.lit(-(1 << 63))).alias("id"),
                     F.coalesce(F.xxhash64("text"), F.lit(0)).alias("h"), F.monotonically_increasing_id().alias("m"))
    rows = stage.keep("rows", docs.withColumn("__row", order), "zstd")
    cut = repeated_lines(rows.select(F.col("__row").alias("row"), "text"), width, stage)
    cut = cut.select(F.col("row").alias("__row"), F.col("places").alias("__cut"))
    kept = F.expr("array_join(transform(filter(transform(split(text, '\n'), (x, i) -> named_struct('p', i, 'x', x)), "
                  "s -> not array_contains(__cut, s.p)), s -> s.x), '\n')")
    return (rows.join(cut, "__row", "left")
            .withColumn("text", F.when(F.col("__cut").isNull(), F.col("text")).otherwise(kept))
            .withColumn("lines_removed", F.coalesce(F.size("__cut"), F.lit(0)))
            .select(*columns, "lines_removed"))


def oracle_sql() -> str:
    """DuckDB SQL for the query: per document its lines, removed lines and the kept text's md5."""
    return """
    WITH l AS (
        SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
               generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) - 1 AS place FROM documents),
    n AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY place) AS k FROM l WHERE trim(line) <> ''),
    w AS (
        SELECT a.doc_id, a.place, a.line || chr(10) || b.line || chr(10) || c.line AS w,
               [a.place, b.place, c.place] AS places
        FROM n a JOIN n b ON a.doc_id = b.doc_id AND b.k = a.k + 1 JOIN n c ON a.doc_id = c.doc_id AND c.k = a.k + 2),
    f AS (SELECT *, row_number() OVER (PARTITION BY w ORDER BY doc_id, place) AS occurrence FROM w),
    cut AS (SELECT DISTINCT doc_id, unnest(places) AS place FROM f WHERE occurrence > 1),
    kept AS (
        SELECT l.doc_id, count(*) AS lines_total, count(cut.place) AS lines_removed,
               md5(coalesce(string_agg(l.line, chr(10) ORDER BY l.place) FILTER (WHERE cut.place IS NULL), ''))
               AS kept_md5
        FROM l LEFT JOIN cut ON l.doc_id = cut.doc_id AND l.place = cut.place GROUP BY l.doc_id)
    SELECT doc_id, CAST(lines_total AS BIGINT) AS lines_total, CAST(lines_removed AS BIGINT) AS lines_removed, kept_md5
    FROM kept"""
