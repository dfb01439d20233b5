"""Near-duplicate vectors by cross-polytope hashing.

A hash function turns a unit vector by a pseudo-random rotation (three rounds
of random signs and a fast Hadamard transform) and names the closest of the
2 * d signed axes. Some of them make a table's cell: as many as leave
``OCCUPANCY`` of a label's vectors a cell if these lay evenly, so cells do not
grow with the rows. A vector lies in its home cell and in the ``PROBES`` next
cells (nearest axes by lost distance) of each table; two vectors with a label
in common are a candidate pair where one's home cell is a cell of the other.
There are as many tables as miss at most ``MISS`` of the pairs right at the
threshold, by the rate at which random ones meet. Every candidate's cosine is
computed in double precision, so no false link is made.

Equal vectors are one class from the start. A cell with many members is cut
into blocks, and each pair of blocks is a group of its own, so no cell's size
is bounded and none meets in one task. A pair that meets in several cells
counts in the first one, which both members' cells tell, so links are counted
without writing them out; of a group's links only a spanning forest is written.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from heatgrid.llm import shared

PROBES = 3
OCCUPANCY = 4               # vectors of a label per cell, were they spread evenly
MISS = 1e-4                 # share of the pairs at the threshold that meet in no cell
NARROWEST = 16              # narrower vectors are padded: they have few rotations
BLOCK = 1024                # members of a cell per block
SEED = 20_240_229
_PAIRS = 100_000
_SLICE = 1 << 21            # numbers turned at once


def hadamard(x: np.ndarray) -> np.ndarray:
    """The unnormalized Walsh-Hadamard transform of the rows; their length is a power of two."""
    x, h, n = x.copy(), 1, x.shape[1]
    while h < n:
        y = x.reshape(len(x), n // (2 * h), 2, h)
        x = np.stack([y[:, :, 0] + y[:, :, 1], y[:, :, 0] - y[:, :, 1]], 2).reshape(len(x), n)
        h *= 2
    return x


def rotations(x: np.ndarray, count: int, seed: int) -> Iterator[np.ndarray]:
    """``count`` pseudo-random rotations of the rows, padded with zeros to a power of two."""
    wide = max(NARROWEST, 1 << (x.shape[1] - 1).bit_length())
    x = np.pad(x, ((0, 0), (0, wide - x.shape[1])))
    random = np.random.default_rng(seed)
    for _ in range(count):
        y = x
        for _ in range(3):
            y = hadamard(y * random.choice([-1.0, 1.0], wide)) / np.sqrt(wide)
        yield y


def cells(x: np.ndarray, tables: int, functions: int, probes: int, seed: int) -> np.ndarray:
    """(rows, tables, 1 + probes) cells of unit vectors: home first, then the nearest others."""
    n, out, turned = len(x), [], rotations(x, tables * functions, seed)
    for _ in range(tables):
        codes, losses = np.zeros((n, 1), np.int64), np.zeros((n, 1))
        for _ in range(functions):
            y = next(turned)
            top = np.argsort(-np.abs(y), axis=1, kind="stable")[:, :3]
            near = np.take_along_axis(y, top, 1)
            axis = 2 * top + (near < 0)
            loss = (np.abs(near[:, :1]) - np.abs(near)) ** 2
            codes = (codes[:, :, None] * (2 * y.shape[1]) + axis[:, None, :]).reshape(n, -1)
            losses = (losses[:, :, None] + loss[:, None, :]).reshape(n, -1)
            best = np.argsort(losses, axis=1, kind="stable")[:, :1 + probes]    # no other can lead to one of these
            codes, losses = np.take_along_axis(codes, best, 1), np.take_along_axis(losses, best, 1)
        out.append(codes)
    return np.stack(out, 1)


def tables_needed(wide: int, functions: int, probes: int, threshold: float, seed: int, pairs: int = 256) -> int:
    """Tables that miss at most ``MISS`` of the pairs at the threshold, from the share of ``pairs``
    random ones that meet in a table (a quarter of a pair less, so the share is never one)."""
    random, trial = np.random.default_rng(seed), 4
    if not 0 < threshold < 1:
        return trial
    a, b = (x / np.linalg.norm(x, axis=1, keepdims=True) for x in random.normal(size=(2, pairs, wide)))
    b -= (a * b).sum(1, keepdims=True) * a
    b *= np.sqrt(1 - threshold ** 2) / np.linalg.norm(b, axis=1, keepdims=True)
    at_a, at_b = (cells(x, trial, functions, probes, seed) for x in (a, threshold * a + b))
    met = (at_b == at_a[:, :, :1]).any(2) | (at_a == at_b[:, :, :1]).any(2)
    share = (met.sum() - 0.25) / met.size
    if share <= 0:
        raise ValueError(f"no pair at {threshold} meets in {functions} functions of width {wide}")
    return int(np.ceil(np.log(MISS) / np.log1p(-share)))


def _matrix(raw: list[bytes]) -> np.ndarray:
    """Rows of float64, as unit vectors; all of one width."""
    x = np.frombuffer(b"".join(raw), "<f8").reshape(len(raw), -1)
    x = x / np.abs(x).max(1, keepdims=True)     # neither overflow nor underflow in the squares
    return x / np.sqrt((x * x).sum(1, keepdims=True))


def _rows(column: pa.ListArray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(rows, their vectors as a matrix) of each length."""
    length = column.value_lengths().to_numpy()
    start, flat = column.offsets.to_numpy()[:-1], column.values.to_numpy(zero_copy_only=False)
    for width in np.unique(length).tolist():
        rows = np.flatnonzero(length == width)
        step = max(1, _SLICE // max(NARROWEST, width))
        for k in range(0, len(rows), step):
            part = rows[k:k + step]
            yield part, flat[start[part][:, None] + np.arange(width)].astype("<f8")


def _code(tables: dict[tuple[int, int], int], probes: int, seed: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            wide, functions = (batch.column(k).to_numpy() for k in (2, 3))
            for rows, vectors in _rows(batch.column(1)):
                for count in np.unique(functions[rows]).tolist():
                    of = functions[rows] == count
                    some, raw = rows[of], [v.tobytes() for v in vectors[of]]
                    code = cells(_matrix(raw), tables[int(wide[some[0]]), count], count, probes, seed)
                    yield pa.RecordBatch.from_arrays(
                        [batch.column(0).take(pa.array(some)), pa.array(raw, pa.binary()),
                         pa.array([c.astype("<i8").tobytes() for c in code], pa.binary()),
                         pa.array(code.reshape(len(some), -1).tolist(), pa.list_(pa.int64()))],
                        names=["cid", "vector", "cells", "flat"])
    return run


def _compare(threshold: float, probes: int):
    names = ["a", "b", "links"]

    def group(g: dict) -> list[tuple]:
        order = np.argsort(g["cid"], kind="stable")
        cid, copies = g["cid"][order], g["copies"][order]
        side = g["block"][order]
        low, high, table, code = g["low"], g["high"], g["table"], g["code"]
        x = _matrix([g["vector"][i] for i in order])
        at = np.stack([np.frombuffer(g["cells"][i], "<i8").reshape(-1, 1 + probes) for i in order])
        home = at[:, table, 0] == code
        counts, edges = np.zeros(len(cid), np.int64), []
        for a in range(0, len(cid), 256):
            hit = x[a:a + 256] @ x.T >= threshold
            after = np.arange(len(cid)) > np.arange(a, min(a + 256, len(cid)))[:, None]
            hit &= (home[a:a + 256, None] | home[None]) & after
            if low != high:
                hit &= side[a:a + 256, None] != side[None]
            u, v = np.nonzero(hit)
            u += a
            for k in range(0, len(u), _PAIRS):
                i, j = u[k:k + _PAIRS], v[k:k + _PAIRS]
                first = _first(at[i], at[j], table, code)
                i, j = i[first], j[first]
                np.add.at(counts, i, copies[j])
                np.add.at(counts, j, copies[i])
                edges.append(np.stack([i, j], 1))
        out = [(int(cid[i]), None, int(counts[i])) for i in np.flatnonzero(counts)]
        return out + [(int(cid[i]), int(cid[j]), 0) for i, j in shared.forest(edges, len(cid))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = []
        for g in _groups(batches):
            if len(g["cid"]) > 1:
                rows += group(g)
            if len(rows) > 50_000:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows)], names=names)
                rows = []
        cols = list(zip(*rows)) if rows else [[]] * 3
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols], names=names)
    return run


_KEY = ["width", "label", "table", "code", "low", "high"]


def _groups(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    """Runs of rows with one key, across batches; a run has two blocks of members at most."""
    held, last = [], None
    for batch in batches:
        key = np.stack([batch.column(batch.schema.get_field_index(k)).to_numpy() for k in _KEY], 1)
        if not len(key):
            continue
        cuts = np.concatenate([[0], np.flatnonzero((key[1:] != key[:-1]).any(1)) + 1, [len(key)]])
        for a, b in zip(cuts[:-1], cuts[1:]):
            if last is not None and (key[a] != last).any():
                yield _group(held, last)
                held = []
            last = key[a]
            held.append(batch.slice(a, b - a))
    if held:
        yield _group(held, last)


def _group(parts: list[pa.RecordBatch], key: np.ndarray) -> dict:
    table = pa.Table.from_batches(parts)
    out = {k: int(v) for k, v in zip(_KEY, key)}
    for c in ("cid", "copies", "block"):
        out[c] = table.column(c).to_numpy()
    return out | {c: table.column(c).to_pylist() if len(out["cid"]) > 1 else [] for c in ("vector", "cells")}


def _first(a: np.ndarray, b: np.ndarray, table: int, code: int) -> np.ndarray:
    """Whether ``code`` in ``table`` is the first cell where the pairs meet."""
    at_a = (b == a[:, :, :1]).any(2)        # b is in a's home cell
    at_b = (a == b[:, :, :1]).any(2)
    first = (at_a | at_b).argmax(1) == table
    home_a, home_b = a[:, table, 0], b[:, table, 0]
    at_a, at_b = at_a[:, table], at_b[:, table]
    place = np.where(at_a & at_b, np.minimum(home_a, home_b), np.where(at_a, home_a, home_b))
    return first & (place == code)


def near_duplicates(vectors: DataFrame, threshold: float = 0.98, probes: int = PROBES, block: int = BLOCK,
                    occupancy: float = OCCUPANCY, seed: int = SEED) -> DataFrame:
    """One row per row of ``vectors`` (vec_id, embedding, label): vec_id, n_links, component_id, kept.

    Vectors link if their labels are equal and not null and their cosine is
    ``threshold`` or more; pairs are found by hashing, so a few are missed (the
    tests measure recall), and none below the threshold is linked. ``n_links``:
    the other vectors linked directly. ``component_id``: the smallest vec_id
    that links reach. ``kept``: vec_id is that smallest one.

    Vectors that are null, empty, zero or hold null or non-finite components,
    and rows without label or vec_id, link with nothing (component: their own
    vec_id; kept). Vectors of different lengths never link. Rows that repeat a
    vec_id are vectors of their own, and share its component. Other columns
    are ignored.
    """
    spark = vectors.sparkSession
    stage = shared.Stage(spark, "cross-polytope")
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"),
                          F.col("embedding").cast("array<double>").alias("embedding"),
                          F.col("label").cast("long").alias("label"))
    fine = F.expr("""coalesce(vec_id is not null and label is not null and size(embedding) > 0
        and forall(embedding, x -> x is not null and not isnan(x) and abs(x) < double('inf'))
        and exists(embedding, x -> x <> 0), false)""")
    rows = stage.keep("rows", rows.withColumn("fine", fine))
    usable = rows.filter("fine").select("vec_id", "embedding", "label")
    classes = (usable.groupBy("label", "embedding").agg(F.min("vec_id").alias("rep"), F.count("*").alias("copies"))
               .withColumn("cid", F.monotonically_increasing_id()))
    classes = stage.keep("classes", classes)
    wide = F.expr(f"greatest({NARROWEST}, shiftleft(1, length(bin(size(embedding) - 1))))").alias("wide")
    sizes = classes.groupBy("label", wide).agg(F.count("*").alias("n")).select("label", "wide", F.greatest(
        F.lit(2), F.ceil(F.log(F.col("n") / occupancy) / F.log(F.lit(2) * F.col("wide")))).cast("int")
        .alias("functions"))
    sizes = stage.keep("sizes", sizes)
    # one row for each power of two and number of functions, so a few dozen
    kinds = [(r.wide, r.functions) for r in sizes.select("wide", "functions").distinct().collect()]
    tables = {kind: tables_needed(*kind, probes, threshold, seed) for kind in kinds}
    coded = stage.keep("coded", classes.select("cid", "embedding", "label", wide).join(sizes, ["label", "wide"])
                       .select("cid", "embedding", "wide", "functions").mapInArrow(
        _code(tables, probes, seed), "cid long, vector binary, cells binary, flat array<long>"))
    of = coded.join(classes.select("cid", "label", "copies"), "cid")
    spots = (of.select("cid", "label", F.octet_length("vector").alias("width"), F.posexplode("flat").alias("p", "code"))
             .withColumn("table", F.floor(F.col("p") / (1 + probes)).cast("int")))
    cell = ["width", "label", "table", "code"]
    crowd = (spots.groupBy(*cell).agg(F.count("*").alias("n"), F.max((F.col("p") % (1 + probes) == 0).cast("int"))
                                      .alias("home")).filter("n > 1 and home = 1")
             .select(*cell, F.ceil(F.col("n") / block).cast("int").alias("blocks")))
    members = (spots.join(crowd, cell).withColumn("block", F.pmod(F.xxhash64("cid"), F.col("blocks")).cast("int"))
               .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
               .select("cid", *cell, "block", F.least("block", "other").alias("low"),
                       F.greatest("block", "other").alias("high")))
    compared = (members.join(of.select("cid", "vector", "cells", "copies"), "cid")
                .repartition(*_KEY).sortWithinPartitions(*_KEY)
                .select(*_KEY, "cid", "copies", "block", "vector", "cells")
                .mapInArrow(_compare(threshold, probes), "a long, b long, links long"))
    compared = stage.keep("compared", compared)
    linked = compared.filter("b is null").groupBy(F.col("a").alias("cid")).agg(F.sum("links").alias("links"))
    name = lambda side: classes.select(F.col("cid").alias(side), F.col("rep").alias(f"{side}_rep"))
    edges = (compared.filter("b is not null").join(name("a"), "a").join(name("b"), "b")
             .select(F.col("a_rep").alias("a"), F.col("b_rep").alias("b")))
    comp = shared.components(stage, "comp", edges)
    known = (classes.join(linked, "cid", "left").join(comp.withColumnRenamed("id", "rep"), "rep", "left")
             .select("label", "embedding", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
                     F.coalesce("comp", "rep").alias("component_id")))
    found = usable.join(known, ["label", "embedding"]).select("vec_id", "n_links", "component_id")
    alone = rows.filter("not fine").select("vec_id", F.lit(0).cast("long").alias("n_links"),
                                           F.col("vec_id").alias("component_id"))
    return found.unionByName(alone).withColumn("kept", F.coalesce(F.expr("vec_id = component_id"), F.lit(True)))
