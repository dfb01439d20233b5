"""Prefix trie of conversations in sharded minimal-perfect-hash node tables.

Turns are hashed (128 bits of role and text), numbered within their
conversation, and conversations are rebuilt from their base's first turns and
their own later ones. A prefix's digest is the xor of its turns' hashes mixed
with their depths, so it can be put together from any pieces of a conversation.

Rebuilt turns are dealt to shards by family (the conversations of one base) and
by band of ``BAND`` depths, so no task holds a conversation whole. A shard
enumerates its distinct prefix digests, gives them slots by a minimal perfect
hash (each slot keeps its digest, and every look-up is verified against it),
and scatters its conversations' ends into flat arrays by slot; counts and least
members then climb through the parent-slot array in depth order. Nodes of one
digest are merged over the shards: one row a shard, however many conversations
pass. With the merged least members each node has one owning shard, and a
second climb over the same slots sums children, leaves and saved bytes of owned
nodes; shards' sums add up to the nodes' results. Deeper bands go first and
hand their sums to the last depth of the band above.

A node's ends are hashed as a stream of its conversations' ids in order; they
come to it packed, in runs of one range of ids, and are never held together.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from heatgrid.llm import shared, words
from heatgrid.sources.local import local_table

#: Fixed values of the contract: conversations of a family, the remainder that chooses how many turns its base gives.
FAMILY, HEADS = 5, 9
SHARD_ROWS = 1 << 14
BAND = 1 << 16              # depths of a shard; longer conversations go through several
RUN = 4096                  # ids packed together
U = np.uint64
_NONE = np.iinfo(np.int64).max


class PerfectHash:
    """Slots 0 to n - 1 for n distinct 64-bit keys: a key takes the first level where it is alone in its place."""

    def __init__(self, keys: np.ndarray):
        self.levels: list[tuple[np.ndarray, np.ndarray]] = []
        given = 0
        while len(keys):
            place = self._place(keys, len(self.levels), 2 * len(keys))
            alone = np.bincount(place, minlength=2 * len(keys)) == 1
            self.levels.append((alone, given + np.cumsum(alone) - 1))
            given += int(alone.sum())
            keys = keys[~alone[place]]

    @staticmethod
    def _place(keys: np.ndarray, level: int, size: int) -> np.ndarray:
        step = U((level + 1) * 0x9E3779B97F4A7C15 % (1 << 64))
        return (words.mix(keys + step) % U(size)).astype(np.int64)

    def slots(self, keys: np.ndarray) -> np.ndarray:
        """The keys' slots; of a key that is not in the set any slot or -1."""
        out, open_ = np.full(len(keys), -1), np.arange(len(keys))
        for level, (alone, rank) in enumerate(self.levels):
            place = self._place(keys[open_], level, len(alone))
            hit = alone[place]
            out[open_[hit]] = rank[place[hit]]
            open_ = open_[~hit]
        return out


class NodeTable:
    """Distinct digests (a, b) in flat arrays by slot; look-ups are verified against the kept digests."""

    def __init__(self, a: np.ndarray, b: np.ndarray):
        order = np.lexsort((b, a))
        a, b = a[order], b[order]
        fresh = np.concatenate([[True], (a[1:] != a[:-1]) | (b[1:] != b[:-1])])
        a, b = a[fresh], b[fresh]
        self.salt = 0
        while len(np.unique(keys := self._keys(a, b))) < len(a):    # two digests under one key: mix them otherwise
            self.salt += 1
        self.hash = PerfectHash(keys)
        at = self.hash.slots(keys)
        self.a, self.b = np.empty_like(a), np.empty_like(b)
        self.a[at], self.b[at] = a, b

    def _keys(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return a ^ words.mix(b + U(self.salt))

    def find(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """The digests' slots, -1 for those that are not in the table."""
        at = self.hash.slots(self._keys(a, b))
        return np.where((self.a[at] == a) & (self.b[at] == b), at, -1)


def climb(up: np.ndarray, depth: np.ndarray, sums: list[np.ndarray], least: np.ndarray | None = None) -> None:
    """Add each slot's values to its parent's, the deepest first; of ``least`` parents keep the minimum."""
    order = np.argsort(-depth, kind="stable")
    order = order[up[order] >= 0]
    cuts = np.flatnonzero(np.diff(depth[order])) + 1
    for level in np.split(order, cuts) if len(order) else []:
        for values in sums:
            np.add.at(values, up[level], values[level])
        if least is not None:
            np.minimum.at(least, up[level], least[level])


def _column(table: pa.Table, name: str) -> np.ndarray:
    return table.column(name).to_numpy()


_LOCAL = ("g long, band long, slot long, up long, a long, b long, pa long, pb long, depth long, bytes long, "
          "n long, low long, ends long, anchor boolean")


def _shard_nodes(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
    """One shard's rebuilt turns (conv_id, length, d, za, zb, bytes, pa, pb) as nodes by slot."""
    conv, d = _column(table, "conv_id"), _column(table, "d")
    order = np.lexsort((d, conv))
    conv, d = conv[order], d[order]
    length, size = _column(table, "length")[order], _column(table, "bytes")[order]
    first = np.concatenate([[True], conv[1:] != conv[:-1]])
    head = np.flatnonzero(first)[np.cumsum(first) - 1]
    digest, parent = [], []
    for z, prefix in (("za", "pa"), ("zb", "pb")):
        z, prefix = _column(table, z)[order].view(U), _column(table, prefix)[order].view(U)
        run = np.bitwise_xor.accumulate(z)
        digest.append(run ^ run[head] ^ z[head] ^ prefix)
        parent.append(digest[-1] ^ z)
    turn = d > 0
    top = first & turn                  # a conversation's first turn here hangs at the root or the band's anchor
    whole = [np.concatenate([x[turn], p[top], x[~turn]]) for x, p in zip(digest, parent)]
    nodes = NodeTable(*whole)
    n = len(nodes.a)
    at, above = nodes.find(*digest), nodes.find(*parent)
    depth, weight, up = np.zeros(n, np.int64), np.zeros(n, np.int64), np.full(n, -1)
    pa_, pb_ = np.zeros(n, np.int64), np.zeros(n, np.int64)
    depth[above[top]] = d[top] - 1
    depth[at], weight[at] = d, size
    up[at[turn]] = above[turn]
    pa_[at], pb_[at] = parent[0].view(np.int64), parent[1].view(np.int64)
    last = np.concatenate([first[1:], [True]])
    count, low, ends = np.zeros(n, np.int64), np.full(n, _NONE), np.zeros(n, np.int64)
    np.add.at(count, at[last], 1)
    np.minimum.at(low, at[last], conv[last])
    np.add.at(ends, at[last], (d == length)[last].astype(np.int64))
    climb(up, depth, [count], low)
    g, band = (k.as_py() for k in key)
    anchor = (up < 0) & (band > 0)
    return pa.table({"g": np.full(n, g), "band": np.full(n, band), "slot": np.arange(n), "up": up,
                     "a": nodes.a.view(np.int64), "b": nodes.b.view(np.int64), "pa": pa_, "pb": pb_,
                     "depth": depth, "bytes": weight, "n": count, "low": low, "ends": ends, "anchor": anchor})


_SUMS = "g long, a long, b long, anchor boolean, parent_conv_id long, children long, leaves long, saved long"


def _shard_sums(table: pa.Table) -> pa.Table:
    """Children, leaves and saved bytes under each slot of one shard's table."""
    n = table.num_rows
    by_slot = np.argsort(_column(table, "slot"))
    get = {k: _column(table, k)[by_slot] for k in ("up", "depth", "bytes", "n", "low", "conv_id", "childless", "anchor",
                                                    "a", "b", "g", "deeper_leaves", "deeper_saved")}
    up, anchor = get["up"], get["anchor"].astype(bool)
    own = (get["low"] == get["conv_id"]) & ~anchor
    children = np.zeros(n, np.int64)
    hung = up >= 0
    np.add.at(children, up[hung], own[hung].astype(np.int64))
    leaves = (own & get["childless"].astype(bool)).astype(np.int64) + get["deeper_leaves"]
    saved = np.where(anchor, 0, get["bytes"] * (get["n"] - own)) + get["deeper_saved"]
    climb(up, get["depth"], [leaves, saved])
    parent = np.where(hung, get["conv_id"][up], 0)
    return pa.table({"g": get["g"], "a": get["a"], "b": get["b"], "anchor": anchor,
                     "parent_conv_id": pa.array(parent, pa.int64(), mask=~(hung & own)),
                     "children": children, "leaves": leaves, "saved": saved})


# ---------------------------------------------------------------- turns and rebuilt conversations
def _number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Place of each row within its run of one conv_id; rows come sorted."""
    task, conv, seen = TaskContext.get().partitionId(), None, 0
    for batch in batches:
        if not batch.num_rows:
            continue
        ids = batch.column(0).to_numpy()
        first = np.concatenate([[True], ids[1:] != ids[:-1]])
        head = np.flatnonzero(first)
        place = np.arange(len(ids)) - head[np.cumsum(first) - 1]
        if ids[0] == conv:
            place[:head[1] if len(head) > 1 else len(ids)] += seen
        conv, seen = ids[-1], int(place[-1]) + 1
        yield pa.RecordBatch.from_arrays(
            [*batch.columns, pa.array(np.full(len(ids), task, np.int32)), pa.array(place)],
            names=[*batch.schema.names, "part", "place"])


def numbered_turns(stage: shared.Stage, conversations: DataFrame) -> DataFrame:
    """(conv_id, pos, ha, hb, bytes) of all turns; ``pos`` counts from 1 in the conversation's order.

    Rows are sorted over ranges, so a long conversation lies in several tasks;
    each starts at the places taken before it. One row a task comes to the driver.
    """
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    turns = conversations.filter("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn"),
        F.xxhash64(role, text, F.lit(1)).alias("ha"), F.xxhash64(F.lit(2), text, role).alias("hb"),
        F.octet_length(text).cast("long").alias("bytes"), F.monotonically_increasing_id().alias("row"))
    order = ["conv_id", "turn", "ha", "hb", "row"]      # rows alike in all but ``row`` can be split as well
    ranged = turns.repartitionByRange(*order).sortWithinPartitions(*order).select("conv_id", "ha", "hb", "bytes")
    rows = stage.keep("turns", ranged.mapInArrow(
        _number, "conv_id long, ha long, hb long, bytes long, part int, place long"))
    tasks = (rows.groupBy("part").agg(F.min("conv_id").alias("first"),
                                      F.max(F.struct("conv_id", "place")).alias("last")).orderBy("part").collect())
    starts, conv, taken = [], None, 0
    for t in tasks:
        before = taken if t["first"] == conv else 0
        if before:
            starts.append((t["part"], conv, before))
        whole = t["last"]["conv_id"] == t["first"]
        conv, taken = t["last"]["conv_id"], t["last"]["place"] + 1 + (before if whole else 0)
    late = shared_starts(rows, starts)
    return rows.join(F.broadcast(late), ["part", "conv_id"], "left").select(
        "conv_id", (F.col("place") + F.coalesce("taken", F.lit(0)) + 1).alias("pos"), "ha", "hb", "bytes")


def shared_starts(rows: DataFrame, starts: list[tuple[int, int, int]]) -> DataFrame:
    """One row a task at most: the places that earlier tasks have taken of its first conversation."""
    spark = rows.sparkSession
    if len(starts) <= 1000:
        return local_table(spark, starts, "part int, conv_id long, taken long")
    return spark.createDataFrame(starts, "part int, conv_id long, taken long")


def _base(conv: Column) -> Column:
    return conv - conv % FAMILY


def rebuilt_lengths(turns: DataFrame) -> DataFrame:
    """Per conversation: own turns left out (``skip``), turns of its base (``heads``) and the rebuilt length."""
    counts = turns.groupBy("conv_id").agg(F.count("*").alias("own"))
    base = counts.select(F.col("conv_id").alias("base"), F.col("own").alias("of_base"))
    apart = F.col("conv_id") % FAMILY != 0
    skip = F.when(apart, F.crc32(F.col("conv_id").cast("string")) % HEADS).otherwise(0)
    return (counts.withColumn("base", _base(F.col("conv_id"))).join(base, "base", "left").withColumn("skip", skip)
            .withColumn("heads", F.least("skip", F.coalesce("of_base", F.lit(0))))
            .select("conv_id", "base", "skip", "heads",
                    (F.col("heads") + F.greatest(F.col("own") - F.col("skip"), F.lit(0))).alias("length")))


def rebuilt_turns(turns: DataFrame, convs: DataFrame, shards: int, band: int) -> DataFrame:
    """The rebuilt conversations' turns at depth d with their hashes, shard and band; one row of depth 0 if turnless."""
    own = turns.join(convs, "conv_id").filter("pos > skip").select(
        "conv_id", "length", (F.col("heads") + F.col("pos") - F.col("skip")).alias("d"), "ha", "hb", "bytes")
    heads = turns.filter((F.col("conv_id") % FAMILY == 0) & (F.col("pos") < HEADS)).withColumnRenamed("conv_id", "base")
    given = convs.filter("heads > 0").join(heads, "base").filter("pos <= heads").select(
        "conv_id", "length", F.col("pos").alias("d"), "ha", "hb", "bytes")
    zero = F.lit(0).cast("long")
    turnless = convs.filter("length = 0").select("conv_id", "length", zero.alias("d"), zero.alias("ha"),
                                                 zero.alias("hb"), zero.alias("bytes"))
    rows = own.unionByName(given).unionByName(turnless)
    real = F.col("d") > 0
    return rows.select(
        "conv_id", "length", "d", "bytes",
        F.when(real, F.xxhash64("ha", "hb", "d")).otherwise(zero).alias("za"),
        F.when(real, F.xxhash64("d", "hb", "ha")).otherwise(zero).alias("zb"),
        F.pmod(F.xxhash64(_base(F.col("conv_id"))), F.lit(shards)).cast("long").alias("g"),
        F.when(real, F.floor((F.col("d") - 1) / band)).otherwise(zero).cast("long").alias("band"))


def _with_prefixes(rows: DataFrame, band: int, longest: int) -> DataFrame:
    """``rows`` with the digest of what comes before the row's band."""
    zero = F.lit(0).cast("long")
    if longest <= band:
        return rows.withColumns({"pa": zero, "pb": zero})
    pieces = rows.filter(F.col("length") > band).groupBy("conv_id", "band").agg(
        F.bit_xor("za").alias("xa"), F.bit_xor("zb").alias("xb"))
    before = "over (partition by conv_id order by band rows between unbounded preceding and 1 preceding)"
    prefixes = pieces.select("conv_id", "band", F.expr(f"bit_xor(xa) {before}").alias("pa"),
                             F.expr(f"bit_xor(xb) {before}").alias("pb"))
    return rows.join(prefixes, ["conv_id", "band"], "left").withColumns(
        {"pa": F.coalesce("pa", zero), "pb": F.coalesce("pb", zero)})


# ---------------------------------------------------------------- ends
def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Ids (a, b, conv_id), sorted, as packed runs of one digest."""
    for batch in batches:
        a, b, ids = (batch.column(k).to_numpy() for k in range(3))
        if not len(ids):
            continue
        cut = np.flatnonzero(np.concatenate([[True], (a[1:] != a[:-1]) | (b[1:] != b[:-1])]))
        ends = np.append(cut[1:], len(ids))
        spans = [(s, min(s + RUN, e)) for c, e in zip(cut.tolist(), ends.tolist()) for s in range(c, e, RUN)]
        at = np.array([s for s, _ in spans])
        packed = [words.pack_ints(np.diff(ids[s:e]).view(U)) if e - s > 1 else b"" for s, e in spans]
        yield pa.RecordBatch.from_arrays([pa.array(a[at]), pa.array(b[at]), pa.array(ids[at]),
                                          pa.array(packed, pa.binary())], names=["a", "b", "first", "steps"])


def _hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 of each digest's ids, from its runs in order."""
    key, state, n = None, None, 0
    for batch in batches:
        done = []
        for a, b, first, steps in zip(*(c.to_pylist() for c in batch.columns)):
            if (a, b) != key:
                if key is not None:
                    done.append((*key, n, state.hexdigest()))
                key, state, n = (a, b), hashlib.sha256(), 0
            ids = [first]
            if steps:
                ids = np.concatenate([[first], first + np.cumsum(words.unpack_ints(steps).view(np.int64))]).tolist()
            state.update(((b"," if n else b"") + ",".join(map(str, ids)).encode()))
            n += len(ids)
        yield _ends_batch(done)
    if key is not None:
        yield _ends_batch([(*key, n, state.hexdigest())])


def _ends_batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = (("a", pa.int64()), ("b", pa.int64()), ("n_ends", pa.int64()), ("ends_sha256", pa.string()))
    return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], kind) for k, (_, kind) in enumerate(kinds)],
                                      names=[name for name, _ in kinds])


def ends_hashes(rows: DataFrame) -> DataFrame:
    """(a, b, n_ends, ends_sha256) of each digest at which rebuilt conversations end."""
    last = rows.groupBy("conv_id").agg(F.bit_xor("za").alias("a"), F.bit_xor("zb").alias("b"))
    runs = (last.select("a", "b", "conv_id").repartitionByRange("conv_id").sortWithinPartitions("a", "b", "conv_id")
            .mapInArrow(_runs, "a long, b long, first long, steps binary"))
    return (runs.repartition("a", "b").sortWithinPartitions("a", "b", "first")
            .mapInArrow(_hashes, "a long, b long, n_ends long, ends_sha256 string"))


def prefix_trie(conversations: DataFrame, shard_rows: int = SHARD_ROWS, band: int = BAND) -> DataFrame:
    """The trie's nodes of ``conversations`` (conv_id, turn, role, text and any others).

    Returns per node conv_id (smallest member), depth, parent_conv_id, n_convs,
    n_children, n_leaves, saved_tokens, ends_sha256 and n_ends (members that end
    there). Turns go by ``turn``, null first; those with equal numbers by a hash
    of role and text, so repeated rows are turns of their own, next to each
    other. Null role and text are empty; rows without conv_id are left out.
    Without conversations there are no nodes, not even the root.
    """
    spark = conversations.sparkSession
    stage = shared.Stage(spark, "prefix-trie")
    turns = numbered_turns(stage, conversations)
    convs = stage.keep("convs", rebuilt_lengths(turns))
    total, longest = convs.agg(F.sum("length"), F.max("length")).first()
    parallel = int(spark.conf.get("spark.sql.shuffle.partitions"))
    shards = max(2 * parallel, -(-(total or 0) // shard_rows))
    rows = stage.keep("rows", rebuilt_turns(turns, convs, shards, band))
    placed = _with_prefixes(rows, band, longest or 0)
    local = stage.keep("local", placed.groupBy("g", "band").applyInArrow(_shard_nodes, _LOCAL))
    node = ["a", "b"]
    merged = local.filter("not anchor").groupBy(*node).agg(
        F.min("low").alias("conv_id"), F.sum("n").alias("n_convs"), F.sum("ends").alias("n_ends"),
        F.min("depth").alias("depth"), *(F.min(c).alias(f"{c}_0") for c in ("pa", "pb", "bytes")),
        *(F.max(c).alias(f"{c}_1") for c in ("depth", "pa", "pb", "bytes")))
    same = (F.col("depth") == F.col("depth_1")) & (F.col("bytes_0") == F.col("bytes_1")) & (
        F.col("pa_0") == F.col("pa_1")) & (F.col("pb_0") == F.col("pb_1"))
    nodes = stage.keep("nodes", merged.select(
        *node, "conv_id", "n_convs", "n_ends",
        F.when(same, F.col("depth")).otherwise(F.raise_error(F.lit("two prefixes have one digest"))).alias("depth")))
    known = local.join(nodes.select(*node, "conv_id", (F.col("n_convs") == F.col("n_ends")).alias("childless")), node)
    zero, deeper, parts = F.lit(0).cast("long"), None, None
    for k in range((max(longest or 0, 1) - 1) // band, -1, -1):
        here = known.filter(F.col("band") == k)
        if deeper is None:
            here = here.withColumns({"deeper_leaves": zero, "deeper_saved": zero})
        else:
            here = here.join(deeper, ["g", *node], "left").withColumns(
                {c: F.coalesce(c, zero) for c in ("deeper_leaves", "deeper_saved")})
        sums = stage.keep(f"sums-{k}", here.groupBy("g").applyInArrow(_shard_sums, _SUMS))
        deeper = sums.filter("anchor").select("g", *node, F.col("leaves").alias("deeper_leaves"),
                                              F.col("saved").alias("deeper_saved"))
        parts = sums if parts is None else parts.unionByName(sums)
    own = ~F.col("anchor")
    totals = parts.groupBy(*node).agg(
        F.max("parent_conv_id").alias("parent_conv_id"), F.sum("children").alias("n_children"),
        F.sum(F.when(own, F.col("leaves")).otherwise(0)).alias("n_leaves"),
        F.sum(F.when(own, F.col("saved")).otherwise(0)).alias("saved_tokens"))
    nothing = hashlib.sha256(b"").hexdigest()
    return (nodes.join(totals, node).join(ends_hashes(rows).drop("n_ends"), node, "left")
            .select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
                    F.coalesce("ends_sha256", F.lit(nothing)).alias("ends_sha256"), "n_ends"))
