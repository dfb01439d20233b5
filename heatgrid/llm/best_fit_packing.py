"""Packing of tokenized documents into windows by best-fit decreasing.

A document's full windows are cut off first. What is left has a length below
the window, so there are at most ``window - 1`` different lengths, and best-fit
decreasing needs to know their counts only: windows with the same remaining
capacity are alike, and the rests of one length go to them in blocks. The
driver packs that histogram (its size is bounded by the window), with a
segment tree over the remaining capacities that finds the tightest open window
for a length; Spark then deals the rests to the blocks by their number within
their length. The result is that of best-fit decreasing on the single rests.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from heatgrid.llm import shared
from heatgrid.llm.word_tokens import WordTokens

_PIECE = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64()),
                    ("doc_tokens", pa.int64()), ("ids", pa.binary())])
_BATCH_IDS = 1 << 20


class CapacityTree:
    """Open windows by remaining capacity; an inner node holds whether its range has any."""

    def __init__(self, window: int):
        self.leaves = 1 << (window + 1).bit_length()
        self.some = [False] * (2 * self.leaves)
        self.runs: dict[int, list[tuple[int, int]]] = {}    # capacity -> runs (first window, windows)

    def put(self, capacity: int, run: tuple[int, int]) -> None:
        self.runs.setdefault(capacity, []).append(run)
        k = capacity + self.leaves
        while k and not self.some[k]:
            self.some[k] = True
            k //= 2

    def take(self, capacity: int, most: int) -> tuple[int, int]:
        first, n = self.runs[capacity].pop()
        if n > most:
            self.runs[capacity].append((first + most, n - most))
            n = most
        if not self.runs[capacity]:
            k = capacity + self.leaves
            self.some[k] = False
            while k > 1:
                k //= 2
                self.some[k] = self.some[2 * k] or self.some[2 * k + 1]
        return first, n

    def tightest(self, length: int) -> int | None:
        """The smallest capacity of ``length`` or more that an open window has."""
        k = length + self.leaves
        if self.some[k]:
            return length
        while k > 1:
            if k % 2 == 0 and self.some[k + 1]:
                k += 1
                while k < self.leaves:
                    k = 2 * k if self.some[2 * k] else 2 * k + 1
                return k - self.leaves
            k //= 2
        return None


def pack_lengths(counts: dict[int, int], window: int) -> list[tuple[int, int, int, int, int]]:
    """Blocks (length, first number, rests, first window, offset): rest number
    ``first number + i`` of a length goes to window ``first window + i``, at the offset."""
    tree, blocks, windows = CapacityTree(window), [], 0
    for length in sorted(counts, reverse=True):
        done = 0
        while done < counts[length]:
            left = counts[length] - done
            capacity = tree.tightest(length) or window
            # a window takes as many rests of this length as fit: after each it is the tightest
            fit = capacity // length
            most = max(1, left // fit)
            if capacity in tree.runs and tree.runs[capacity]:
                first, n = tree.take(capacity, most)
            else:
                first, n, windows = windows, most, windows + most
            for _ in range(min(fit, left)):
                blocks.append((length, done, n, first, window - capacity))
                done += n
                capacity -= length
            if capacity:
                tree.put(capacity, (first, n))
    return blocks


def _pieces(path: str, end: int, window: int, with_ids: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, rows, held = WordTokens(path), [], 0     # its memory goes with the task
        for batch in batches:
            ids = batch.column(0).to_pylist()
            texts = batch.column(1)
            for a in range(0, batch.num_rows, 256):
                part = [t or "" for t in texts.slice(a, 256).to_pylist()]
                for doc, raw in zip(ids[a:a + 256], encode(part)):
                    raw += end.to_bytes(4, "little")
                    n = len(raw) // 4
                    for start in range(0, n, window):
                        piece = raw[4 * start:4 * (start + window)]
                        rows.append((doc, start, len(piece) // 4, zlib.crc32(piece), n, piece if with_ids else None))
                        held += len(piece) // 4
                    if held >= _BATCH_IDS:
                        yield _rows(rows)
                        rows, held = [], 0
        yield _rows(rows)
    return run


def _rows(rows: list[tuple]) -> pa.RecordBatch:
    cols = list(zip(*rows)) if rows else [[]] * len(_PIECE)
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(cols, _PIECE)], schema=_PIECE)


def pack(docs: DataFrame, tokenizer: str, window: int = 4096, end: int = 2, with_ids: bool = False) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset (and ids).

    ``docs``: doc_id, text. ``tokenizer``: the file of a word BPE, on every
    executor. A text's ids, then ``end``, are cut into full windows and a rest;
    a window is a sequence of its own, and the rests are packed best-fit
    decreasing into the sequences after them. ``ids`` (on demand): the piece's
    ids as little-endian unsigned 32-bit numbers.

    A null or empty text is the end id alone. Rows that repeat a doc_id, or
    have none, are packed like all others. No rows, no pieces.
    """
    spark = docs.sparkSession
    stage = shared.Stage(spark, "packing")
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    pieces = docs.mapInArrow(_pieces(tokenizer, end, window, with_ids),
                             "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, ids binary")
    if not with_ids:
        pieces = pieces.drop("ids")
    pieces = shared.numbered(stage, "pieces", pieces, ["length"], "number")
    counts = {r.length: r.n for r in pieces.groupBy("length").agg(F.count("*").alias("n")).collect()}
    full = counts.pop(window, 0)
    blocks = pack_lengths(counts, window)
    layout = [(window, 0, full, 0, 0), *((n, a, k, w + full, o) for n, a, k, w, o in blocks)]
    by_length: dict[int, list] = {}
    for n, a, k, w, o in sorted(layout):
        by_length.setdefault(n, []).append((a, w, o))
    # at most `window` rows; the blocks of a length are an array, searched by the rest's number
    table = spark.createDataFrame([(n, [x[0] for x in b], [x[1] for x in b], [x[2] for x in b])
                                   for n, b in by_length.items()],
                                  "length long, firsts array<long>, windows array<long>, offsets array<long>")
    at = F.expr("size(filter(firsts, f -> f <= number)) - 1")
    placed = (pieces.join(F.broadcast(table), "length").withColumn("at", at)
              .withColumn("sequence_id", F.expr("windows[at] + number - firsts[at]"))
              .withColumn("offset", F.expr("offsets[at]")))
    return placed.select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset",
                         *(["ids"] if with_ids else []))
