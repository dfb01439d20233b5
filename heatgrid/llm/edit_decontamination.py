"""Test items that occur in documents, up to an edit distance.

An item of m characters may differ by ``k = floor(rate * m)`` edits. Cut into
``k + 1`` pieces, at least one piece of it is then found unchanged (pigeonhole).
All pieces are searched at once with one automaton; around each hit the item
is verified with Myers' bit-parallel distance, so nothing within the budget is
missed and nothing beyond it is reported.

The items are taken in blocks of ``BLOCK_CHARS`` at most (or one longer item),
so what a task holds has a fixed bound; each block is one scan of the
documents. No shuffle.
"""

from __future__ import annotations

import functools
from collections import defaultdict
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

RATE = 0.05
BLOCK_CHARS = 4 << 20


def normal(text: str | None) -> str:
    """Lower case, any white space as one space, none at the ends."""
    return " ".join(text.lower().split()) if text else ""


def pieces(item: str, budget: int) -> list[tuple[int, str]]:
    """``budget + 1`` pieces of about equal length, with their places."""
    n = min(budget + 1, len(item))
    edges = [i * len(item) // n for i in range(n + 1)]
    return [(a, item[a:b]) for a, b in zip(edges[:-1], edges[1:])]


def myers(pattern: str, text: str) -> tuple[int, int]:
    """Smallest distance of ``pattern`` to a substring of ``text``, and the first end where it is reached."""
    m, mask = len(pattern), (1 << len(pattern)) - 1
    where: dict[str, int] = defaultdict(int)
    for i, c in enumerate(pattern):
        where[c] |= 1 << i
    up, down, score, top = mask, 0, m, 1 << (m - 1)
    best, end = m, 0
    for j, c in enumerate(text, 1):
        eq = where.get(c, 0)
        vertical = eq | down
        across = (((eq & up) + up) ^ up) | eq
        more, less = down | ~(across | up) & mask, up & across
        if more & top:
            score += 1
        elif less & top:
            score -= 1
            if score < best:
                best, end = score, j
        more, less = (more << 1) & mask, (less << 1) & mask
        up, down = less | ~(vertical | more) & mask, more & vertical
    return best, end


class Items:
    """One block of test items: the automaton over their pieces, and the verification."""

    def __init__(self, items: list[tuple[int, str]], rate: float):
        import ahocorasick
        self.items, self.rate = items, rate
        found: dict[str, list[tuple[int, int]]] = defaultdict(list)
        for i, (_, text) in enumerate(items):
            for at, piece in pieces(text, int(rate * len(text))):
                found[piece].append((i, at))
        self.automaton = ahocorasick.Automaton()
        for piece, uses in found.items():
            self.automaton.add_word(piece, (len(piece), uses))
        self.automaton.make_automaton()

    def matches(self, text: str) -> Iterator[tuple[int, int, int, int]]:
        """(item's place, distance, start, end): the best occurrence of each item in a normalized text."""
        begins: dict[int, set[int]] = defaultdict(set)
        for end, (n, uses) in self.automaton.iter(text):
            for i, at in uses:
                begins[i].add(end + 1 - n - at)
        for i in sorted(begins):
            item = self.items[i][1]
            m, k = len(item), int(self.rate * len(item))
            exact = min((b for b in begins[i] if b >= 0 and text.startswith(item, b)), default=None)
            if exact is not None:
                yield i, 0, exact, exact + m
                continue
            best = (k + 1, 0, 0)
            for a, b in _merged(sorted(begins[i]), k, m + k):
                a = max(0, a)
                part = text[a:b]
                distance, end = myers(item, part)
                if distance < best[0]:
                    _, back = myers(item[::-1], part[:end][::-1])
                    best = (distance, a + end - back, a + end)
            if best[0] <= k:
                yield i, *best


def _merged(begins: list[int], before: int, after: int) -> list[list[int]]:
    out: list[list[int]] = []
    for b in begins:
        if out and b - before <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b + after)
        else:
            out.append([b - before, b + after])
    return out


@functools.lru_cache(2)
def _block(items: tuple, rate: float) -> Items:
    return Items(list(items), rate)


def blocks(items: DataFrame, limit: int = BLOCK_CHARS) -> Iterator[list[tuple[int, str]]]:
    """The distinct items, normalized, in blocks; rows come to the driver one partition at a time."""
    rows = (items.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text"))
            .filter("item_id is not null and text is not null").distinct().orderBy("item_id", "text"))
    block, held = [], 0
    for row in rows.toLocalIterator():
        text = normal(row.text)
        if not text:
            continue
        if block and held + len(text) > limit:
            yield block
            block, held = [], 0
        block.append((row.item_id, text))
        held += len(text)
    if block:
        yield block


def _find(items, rate: float, column: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = _block(tuple(items.value), rate)
        for batch in batches:
            for a in range(0, batch.num_rows, 512):
                part = batch.slice(a, 512)
                at, found = [], []
                for k, text in enumerate(part.column(column).to_pylist()):
                    text = normal(text)
                    hits: dict[int, tuple] = {}
                    for i, *hit in index.matches(text) if text else ():
                        item = index.items[i][0]
                        hits[item] = min(hits.get(item, hit), hit)
                    for item, hit in sorted(hits.items()):
                        at.append(k)
                        found.append((item, *hit))
                cols = list(zip(*found)) if found else [[]] * 4
                others = part.drop_columns([part.schema.names[column]]).take(pa.array(at, pa.int64()))
                yield pa.RecordBatch.from_arrays(
                    [*others.columns, pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.int32()),
                     pa.array(cols[2], pa.int64()), pa.array(cols[3], pa.int64())],
                    names=[*others.schema.names, "item_id", "distance", "match_start", "match_end"])
    return run


def find_items(docs: DataFrame, items: DataFrame, rate: float = RATE) -> DataFrame:
    """One row per document and test item that occurs in it: the columns of ``docs`` but text,
    and item_id, distance, match_start, match_end.

    ``docs``: text and any others; ``items``: item_id, text. Texts are compared
    in lower case with white space as one space; the place, in characters of
    that form, is that of the smallest distance, among equal ones the first
    found. Null or empty texts hold nothing; null or empty items are in
    nothing. Items that share an id count as one. Repeated rows of ``docs`` are
    rows like any other. Columns named like the new ones are replaced.
    """
    spark = docs.sparkSession
    docs = docs.drop("item_id", "distance", "match_start", "match_end")
    column = docs.columns.index("text")
    schema = T.StructType([*docs.drop("text").schema.fields, *T._parse_datatype_string(
        "item_id long, distance int, match_start long, match_end long").fields])
    out = None
    for block in blocks(items):
        part = docs.mapInArrow(_find(spark.sparkContext.broadcast(block), rate, column), schema)
        out = part if out is None else out.unionByName(part)
    if out is None:
        return docs.drop("text").withColumns({f.name: F.lit(None).cast(f.dataType) for f in schema.fields[-4:]}
                                             ).filter("false")
    return out


def _clean(items, rate: float, column: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = _block(tuple(items.value), rate)
        for batch in batches:
            for a in range(0, batch.num_rows, 512):
                part = batch.slice(a, 512)
                clean = [next(index.matches(normal(t)), None) is None if t else True
                         for t in part.column(column).to_pylist()]
                yield part.filter(pa.array(clean, pa.bool_()))
    return run


def decontaminate(docs: DataFrame, items: DataFrame, rate: float = RATE) -> DataFrame:
    """The rows of ``docs`` (text and any others) in which no test item occurs; see ``find_items``."""
    for block in blocks(items):
        docs = docs.mapInArrow(_clean(docs.sparkSession.sparkContext.broadcast(block), rate,
                                      docs.columns.index("text")), docs.schema)
    return docs
