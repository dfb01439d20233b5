"""Join of documents on the Jaccard similarity of their word n-gram sets.

Prefix filtering under several global orders of the shingles at once. Two sets
with similarity t or more share a shingle among the first
``n - ceil(t * n) + 1`` of each under *any* order, so a candidate pair must
share a prefix shingle under *every* order. Order 0 (document frequency, then
hash) finds the candidates through postings; the other orders (a coarser
frequency class, then a hash of their own) are intersected next, and the pairs
left are verified on their whole sets, with integers only.

Steps, each a Spark job:

1. every text's set, its size and a 128-bit signature; equal sets are one class,
   found by salted aggregates, and its smallest doc_id stands for it. Where a
   doc_id stands for several classes (its rows have several texts), all but one
   get a number of their own, and the classes of one doc_id are linked;
2. frequencies: a task sends each range of the hash space one packed block of
   shortened keys; a range's task answers with each document's number of keys
   that occur elsewhere (never too few). Documents with enough keys of their own
   for a whole prefix have no partner and end here;
3. the classes left exchange their keys once more, and get prefixes and postings.
   Their texts are found by a semi join on doc_id;
4. candidates: in rounds, a document meets up to ``HUBS`` hubs of its postings
   that are of another component, those that share most postings with it first,
   so a group of n copies takes about n checks and not n squared. Pairs of
   different components that still share a posting are then all checked, so no
   link between components is lost: a short posting's as rows, a long one's as
   matrix products of its blocks, which write links only. A shared key counts only if the places of
   the key in both orders leave room for enough common keys behind it
   (positional filter; a pair that links passes it at its first common key).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from heatgrid.llm import shared, words
from heatgrid.llm.words import U, mix, pack48, unpack48

RANGE_BYTES = 24 << 20      # text whose keys meet in one task of the frequency exchange
RANGE_KEYS = 3 << 20        # keys that meet in one task of the second exchange
ROUNDS = 4                  # hub rounds at most, before all other pairs are checked
SEEDS, HUBS = 3, 4          # hubs per posting and round: 2 * SEEDS; checks per document and round
SALTS = 64                  # parts of a class of equal sets, while its smallest doc_id is found
LONG = 32                   # rows of a posting, from which on its pairs are compared in blocks
BLOCK = 512                 # its rows per block
ORDERS = 3
_SEEDS = [0x243F6A8885A308D3, 0x13198A2E03707344, 0xA4093822299F31D0, 0x082EFA98EC4E6C89]


def _signatures(n: int):
    schema = pa.schema([("doc_id", pa.int64()), ("n_shingles", pa.int64()),
                        ("sig_a", pa.int64()), ("sig_b", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0)
            for s in words.shingle_sets(batch.column(1), n):
                size = np.diff(s.rows)
                yield pa.RecordBatch.from_arrays(
                    [ids.slice(s.first, s.last - s.first), pa.array(size), *_signature(s)], schema=schema)
    return run


def _signature(s: words.Sets) -> list[pa.Array]:
    out = []
    for seed in _SEEDS[:2]:
        total = np.concatenate([np.zeros(1, U), np.cumsum(mix(s.keys ^ U(seed)), dtype=U)])
        out.append(pa.array((total[s.rows[1:]] - total[s.rows[:-1]]).view(np.int64)))
    return out


def _token(ids: np.ndarray, sigs: np.ndarray) -> np.ndarray:
    """48 bits that stand for a document's text."""
    return mix(ids.view(U) ^ mix(sigs.view(U))) >> U(16)


def _tokens(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        token = _token(batch.column(0).to_numpy(), batch.column(2).to_numpy())
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(token.view(np.int64))],
                                         names=[*batch.schema.names, "token"])


_BLOCK = pa.schema([("range", pa.int32()), ("ids", pa.binary()), ("sigs", pa.binary()), ("sizes", pa.binary()),
                    ("keys", pa.binary())])
_BLOCK_SQL = "range int, ids binary, sigs binary, sizes binary, keys binary"


def _by_range(batches: Iterator[pa.RecordBatch], n: int, ranges: int):
    """For each part of the texts: ids, signatures, and by range of the hash space
    (range, places of its texts, how many keys each has there, keys)."""
    for batch in batches:
        ids = batch.column(0).to_numpy(zero_copy_only=False)
        for s in words.shingle_sets(batch.column(1), n):
            doc = np.repeat(np.arange(s.last - s.first), np.diff(s.rows))
            at = ((s.keys >> U(16)) * U(ranges) >> U(32)).astype(np.int32)
            order = np.argsort(at, kind="stable")
            at, doc, keys = at[order], doc[order], s.keys[order]
            edges = np.searchsorted(at, np.arange(ranges + 1))
            yield ids[s.first:s.last], _signature(s)[0].to_numpy(), [
                (r, *np.unique(doc[lo:hi], return_counts=True), keys[lo:hi])
                for r in np.flatnonzero(np.diff(edges)) for lo, hi in [edges[r:r + 2]]]


def _rows(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    cols = list(zip(*rows)) if rows else [[]] * len(schema)
    return pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(cols, schema)], schema=schema)


def _send(n: int, ranges: int):
    """Blocks of keys by range of the hash space, with the ids and signatures of their texts."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, sig, parts in _by_range(batches, n, ranges):
            yield _rows([(r, ids[own].astype("<i8").tobytes(), sig[own].astype("<i8").tobytes(),
                          size.astype("<i4").tobytes(), pack48(keys)) for r, own, size, keys in parts], _BLOCK)
    return run


_SHORT = pa.schema([("range", pa.int32()), ("tokens", pa.binary()), ("sizes", pa.binary()), ("keys", pa.binary())])
_SHORT_SQL = "range int, tokens binary, sizes binary, keys binary"
_COUNTS = pa.schema([("part", pa.int32()), ("tokens", pa.binary()), ("sizes", pa.binary())])


def _pieces(tokens: np.ndarray, sizes: np.ndarray) -> tuple[bytes, bytes]:
    """Tokens in 6 bytes and sizes in one; a size over 255 takes several entries."""
    times = -(-sizes // 255)
    short = np.full(times.sum(), 255, np.uint8)
    short[np.cumsum(times) - 1] = sizes - 255 * (times - 1)
    return pack48(np.repeat(tokens, times)), short.tobytes()


def _send_short(n: int, ranges: int):
    """Blocks of the lower 32 bits of the keys by range, with the tokens of their texts.

    Keys of a range that agree in these bits only count as shared, which lets
    a few more texts pass to the next step, where whole keys meet.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, sig, parts in _by_range(batches, n, ranges):
            token = _token(ids.astype(np.int64), sig)
            yield _rows([(r, *_pieces(token[own], size), keys.astype("<u4").tobytes())
                         for r, own, size, keys in parts], _SHORT)
    return run


def _gather(table: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """doc ids, signatures, keys and each key's frequency in the range; rows that repeat a text count once."""
    join = lambda c, kind: np.frombuffer(b"".join(table.column(c).to_pylist()), kind)
    sizes = join("sizes", "<i4")
    text, at = np.unique(np.stack([join("ids", "<i8"), join("sigs", "<i8")]), axis=1, return_inverse=True)
    keys = unpack48(b"".join(table.column("keys").to_pylist()))
    doc = np.repeat(at.ravel(), sizes)
    order = np.argsort(keys, kind="stable")
    keys, doc = keys[order], doc[order]
    first = np.concatenate([[True], keys[1:] != keys[:-1]])
    once = np.ones(len(keys), bool)
    once[1:] = first[1:] | (doc[1:] != doc[:-1])
    if not once.all():
        again = np.lexsort((doc, keys))
        doc = doc[again]
        once[1:] = first[1:] | (doc[1:] != doc[:-1])
        keys, doc = keys[once], doc[once]
        first = np.concatenate([[True], keys[1:] != keys[:-1]])
    start = np.flatnonzero(first)
    df = np.diff(np.append(start, len(keys)))
    return text, doc, keys, np.repeat(df, df)


def _sized(table: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct tokens, each entry's place among them, and each entry's size."""
    token, at = np.unique(unpack48(b"".join(table.column("tokens").to_pylist())), return_inverse=True)
    return token, at, np.frombuffer(b"".join(table.column("sizes").to_pylist()), np.uint8)


def _shared_counts(parts: int):
    """How many of its keys each text shares, packed by its token.

    A row that repeats a text shares its keys with it: the count may be too great, never too small.
    """
    def run(table: pa.Table) -> pa.Table:
        token, at, sizes = _sized(table)
        doc = np.repeat(at, sizes)
        keys = np.frombuffer(b"".join(table.column("keys").to_pylist()), "<u4")
        order = np.argsort(keys, kind="stable")
        same = np.diff(keys[order]) == 0
        shared_ = np.append(same, False) | np.insert(same, 0, False)
        counts = np.bincount(doc[order[shared_]], minlength=len(token))
        used = np.flatnonzero(counts)
        part = token[used] % U(parts)
        used = used[np.argsort(part, kind="stable")]
        edges = np.searchsorted(np.sort(part), np.arange(parts + 1, dtype=U))
        return pa.Table.from_batches([_rows([
            (p, *_pieces(token[i], counts[i]))
            for p in np.flatnonzero(np.diff(edges)) for i in [used[edges[p]:edges[p + 1]]]], _COUNTS)])
    return run


def _add_up(table: pa.Table) -> pa.Table:
    token, at, sizes = _sized(table)
    total = np.bincount(at, sizes, minlength=len(token)).astype(np.int64)
    return pa.table({"token": token.astype(np.int64), "shared": total})


def _shared_keys(table: pa.Table) -> pa.Table:
    (ids, sigs), doc, keys, df = _gather(table)
    keep = df > 1
    doc, keys, df = doc[keep], keys[keep], df[keep]
    order = np.argsort(doc, kind="stable")
    doc, keys, df = doc[order], keys[order], df[order]
    own, at = np.unique(doc, return_index=True)
    ends = np.append(at, len(doc))
    part = [slice(a, b) for a, b in zip(ends[:-1], ends[1:])]
    return pa.table({"doc_id": pa.array(ids[own], pa.int64()), "sig_a": pa.array(sigs[own], pa.int64()),
                     "keys": pa.array([pack48(keys[p]) for p in part], pa.binary()),
                     "dfs": pa.array([df[p].astype("<i4").tobytes() for p in part], pa.binary())})


def _prefixes(percent: int, orders: int):
    schema = pa.schema([("doc_id", pa.int64()), ("n", pa.int64()), ("keys", pa.binary()),
                        ("prefixes", pa.list_(pa.binary()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for doc, n, parts in zip(*(c.to_pylist() for c in batch.columns)):
                keys = unpack48(b"".join(p["keys"] for p in parts))
                df = np.frombuffer(b"".join(p["dfs"] for p in parts), "<i4")
                own, first = n - len(keys), n - (percent * n + 99) // 100 + 1
                if own >= first or not len(keys):   # its own keys fill the prefix
                    continue
                level = np.log2(df).astype(np.int64)
                prefixes = []
                for k in range(orders):     # each in its order
                    rank = np.lexsort((mix(keys ^ U(_SEEDS[k % 4] + k)), df if k == 0 else level))
                    prefixes.append(pack48(keys[rank[:first - own]]))
                rows.append((doc, n, pack48(np.sort(keys)), prefixes))
            cols = list(zip(*rows)) if rows else [[]] * 4
            yield pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(cols, schema)], schema=schema)
    return run


def _postings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        keys = [unpack48(p) for p in batch.column(2).to_pylist()]
        size = np.array([len(k) for k in keys], np.int64)
        flat = np.concatenate(keys).view(np.int64) if keys else np.zeros(0, np.int64)
        place = np.arange(len(flat)) - np.repeat(np.cumsum(size) - size, size)
        doc, n, own = (np.repeat(batch.column(c).to_numpy(), size) for c in (0, 1, 3))
        # room: the key itself and all keys behind it; the document's own keys come first
        yield pa.RecordBatch.from_arrays(list(map(pa.array, (flat, doc, n, n - own - place))),
                                         names=["key", "doc", "n", "room"])


def _common(a: np.ndarray, b: np.ndarray) -> int:
    both = np.sort(np.concatenate([a, b]))
    return int(np.count_nonzero(both[1:] == both[:-1]))


def _verify(percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for a, b, na, nb, ka, kb, pa_, pb in zip(*(c.to_pylist() for c in batch.columns)):
                # the other orders first, then the whole sets
                if all(_common(unpack48(x), unpack48(y)) for x, y in zip(pa_[1:], pb[1:])):
                    both = _common(unpack48(ka), unpack48(kb))
                    if 100 * both >= percent * (na + nb - both):
                        found.append((a, b))
            cols = list(zip(*found)) if found else [[], []]
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols], names=["a", "b"])
    return run


def _overlaps(sets: list[np.ndarray], width: int = 4096) -> np.ndarray:
    """Sizes of all pairwise intersections of arrays of distinct keys."""
    row = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    _, column, times = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    often = times > 1
    row, column = row[often[column]], (np.cumsum(often) - 1)[column[often[column]]]
    order = np.argsort(column, kind="stable")
    row, column = row[order], column[order]
    total = np.zeros((len(sets), len(sets)), np.float32)
    for k in range(0, int(often.sum()), width):
        a, b = np.searchsorted(column, (k, k + width))
        part = np.zeros((len(sets), width), np.float32)
        part[row[a:b], column[a:b] - k] = 1
        total += part @ part.T
    return total.astype(np.int64)


def _compare_blocks(percent: int):
    def run(table: pa.Table) -> pa.Table:
        doc, comp, n, room, block = (table.column(c).to_numpy() for c in ("doc", "comp", "n", "room", "block"))
        low, high = table.column("low")[0].as_py(), table.column("high")[0].as_py()
        open_ = comp[:, None] < comp[None]      # either order of a pair is enough
        if low != high:
            open_ &= block[:, None] != block[None]
        size = n[:, None] + n[None]
        open_ &= np.minimum(room[:, None], room[None]) * (100 + percent) >= size * percent
        prefixes = table.column("prefixes").to_pylist()
        for k in range(1, len(prefixes[0])):
            if open_.any():
                open_ &= _overlaps([unpack48(p[k]) for p in prefixes]) > 0
        edges = []
        if open_.any():
            both = _overlaps([unpack48(k) for k in table.column("keys").to_pylist()])
            edges = [np.stack(np.nonzero(open_ & (100 * both >= percent * (size - both))), 1)]
        links = shared.forest(edges, len(doc))
        return pa.table({"a": pa.array([doc[i] for i, _ in links], pa.int64()),
                         "b": pa.array([doc[j] for _, j in links], pa.int64())})
    return run


def _links(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    side = lambda x: sets.select(F.col("doc_id").alias(x), F.col("n").alias(f"n{x}"),
                                 F.col("keys").alias(f"k{x}"), F.col("prefixes").alias(f"p{x}"))
    return (pairs.join(side("a"), "a").join(side("b"), "b")
            .select("a", "b", "na", "nb", "ka", "kb", "pa", "pb")
            .mapInArrow(_verify(percent), "a long, b long"))


def jaccard_components(docs: DataFrame, n: int = 5, percent: int = 80, orders: int = ORDERS) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): doc_id, n_shingles (set size), component_id.

    Two documents link when ``100 * |A & B| >= percent * |A | B|`` over their
    sets of distinct ``n``-word shingles (A-Z as a-z; with fewer words, the
    whole sequence is the one shingle). ``component_id`` is the smallest doc_id
    that links reach. Null or empty texts have size 0 and link with nothing.
    Rows without doc_id get a null component. Rows repeating a doc_id are one
    document with all their texts: each text is compared, the links of all of
    them are the document's, and each row has its own text's size. Other
    columns are ignored.
    """
    spark = docs.sparkSession
    stage = shared.Stage(spark, "jaccard")
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    sigs = stage.keep("sigs", docs.mapInArrow(_signatures(n), "doc_id long, n_shingles long, sig_a long, sig_b long"))
    sig = ["n_shingles", "sig_a", "sig_b"]
    linkable = sigs.filter("n_shingles > 0 and doc_id is not null")
    members, twice = _classes(stage, linkable.select("doc_id", *sig).distinct(), sig)

    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    ranges = max(1, min(1 << 20, -(-size // RANGE_BYTES)))
    cut = F.col("n_shingles") - F.floor((percent * F.col("n_shingles") + 99) / 100) + 1
    named = docs.filter("doc_id is not null and text is not null")
    counts = (named.mapInArrow(_send_short(n, ranges), _SHORT_SQL).groupBy("range")
              .applyInArrow(_shared_counts(ranges), "part int, tokens binary, sizes binary")
              .groupBy("part").applyInArrow(_add_up, "token long, shared long"))
    reps = (members.filter("doc_id = rep").select("doc_id", *sig, "node")
            .mapInArrow(_tokens, "doc_id long, n_shingles long, sig_a long, sig_b long, node long, token long"))
    left = stage.keep("left", reps.join(counts, "token")
                      .filter(F.col("n_shingles") - F.col("shared") < cut).select("doc_id", *sig, "node"))
    stage.release()
    keys = left.agg(F.sum("n_shingles")).first()[0] or 0
    # another text of a doc_id that is left only adds to frequencies, and finds no row of `left` afterwards
    # by a merge at every size, so the texts' shuffle grows as the input does; a hot doc_id is split by AQE
    passing = named.join(left.select("doc_id").distinct().hint("merge"), "doc_id", "left_semi")
    answered = (passing.mapInArrow(_send(n, max(1, -(-keys // RANGE_KEYS))), _BLOCK_SQL)
                .groupBy("range").applyInArrow(_shared_keys, "doc_id long, sig_a long, keys binary, dfs binary")
                .groupBy("doc_id", "sig_a").agg(F.collect_list(F.struct("keys", "dfs")).alias("parts")))
    of = left.select("doc_id", "sig_a", F.col("n_shingles").alias("n"), "node")
    sets = stage.keep("sets", answered.join(of, ["doc_id", "sig_a"]).select(F.col("node").alias("doc_id"), "n", "parts")
                      .mapInArrow(_prefixes(percent, orders),
                                  "doc_id long, n long, keys binary, prefixes array<binary>"))
    stage.release()
    own = F.col("n") - F.octet_length("keys") / 6
    posts = (sets.select("doc_id", "n", F.col("prefixes")[0], own.cast("long"))
             .mapInArrow(_postings, "key long, doc long, n long, room long"))
    posts = stage.keep("posts", _roomy(stage.keep("all_posts", posts), percent))

    similar = ((F.least("na", "nb") * 100 >= F.greatest("na", "nb") * percent)
               & (F.least("ra", "rb") * (100 + percent) >= (F.col("na") + F.col("nb")) * percent))

    def all_pairs(known: DataFrame) -> DataFrame:
        known = _roomy(known, percent).join(known.groupBy("key").agg(F.count("*").alias("rows")), "key")
        a, b = (known.filter(F.col("rows") < LONG)
                .select("key", F.col("doc").alias(x), F.col("comp").alias(f"c{x}"), F.col("n").alias(f"n{x}"),
                        F.col("room").alias(f"r{x}")) for x in "ab")
        rest = a.join(b, "key").filter((F.col("a") < F.col("b")) & (F.col("ca") != F.col("cb")) & similar)
        blocks = F.ceil(F.col("rows") / BLOCK).cast("int")
        spread = (known.filter(F.col("rows") >= LONG).withColumn("block", F.pmod(F.xxhash64("doc"), blocks).cast("int"))
                  .withColumn("other", F.explode(F.sequence(F.lit(0), blocks - 1)))
                  .select("key", "doc", "comp", "n", "room", "block", F.least("block", "other").alias("low"),
                          F.greatest("block", "other").alias("high")))
        held = sets.select(F.col("doc_id").alias("doc"), "keys", "prefixes")
        long = (spread.join(held, "doc").groupBy("key", "low", "high")
                .applyInArrow(_compare_blocks(percent), "a long, b long"))
        return stage.keep("rest", _links(rest.select("a", "b").distinct(), sets, percent).unionByName(long))

    links, comp, before = twice, None, float("inf")
    if twice is not None:
        comp = shared.components(stage, "comp-twice", twice)
    for r in range(ROUNDS + 1):
        known = _labelled(posts, comp)
        if r:
            known = stage.keep(f"open{r}", _open(known))
            n_rows, n_pairs = known.agg(F.count("*"), F.sum("cross")).first()
            if not n_rows:
                break
            posts = known.select("key", "doc", "n", "room")     # a closed posting stays closed
            # few pairs are left, or rounds no longer help: all that pass the positional filter
            if n_pairs <= 4 * n_rows or r == ROUNDS or n_pairs > 0.7 * before:
                links = _more(links, all_pairs(known))
                comp = shared.components(stage, f"comp{r}", links)
                break
            before = n_pairs
        rank = [F.struct(F.xxhash64("doc", F.lit(SEEDS * r + k)).alias("h"), F.col("doc").alias("hub"),
                         F.col("comp").alias("hc"), F.col("n").alias("nb"), F.col("room").alias("rb"))
                for k in range(SEEDS)]
        hubs = known.groupBy("key").agg(F.array(*(f(x) for x in rank for f in (F.min, F.max))).alias("hubs"))
        met = (known.join(hubs, "key").select("doc", "comp", F.col("n").alias("na"), F.col("room").alias("ra"),
                                              F.explode("hubs").alias("x"))
               .select("doc", "comp", "na", "ra", "x.*").filter((F.col("comp") != F.col("hc")) & similar)
               .groupBy("doc", "hub").agg(F.count("*").alias("times")))
        best = Window.partitionBy("doc").orderBy(F.desc("times"), F.xxhash64("hub", F.lit(r)))
        pairs = (met.withColumn("place", F.row_number().over(best)).filter(F.col("place") <= HUBS)
                 .select(F.least("doc", "hub").alias("a"), F.greatest("doc", "hub").alias("b")).distinct())
        links = _more(links, stage.keep(f"hub{r}", _links(pairs, sets, percent)))
        comp = shared.components(stage, f"comp{r}", links)
    of = (members.select("doc_id", "node").join(comp.withColumnRenamed("id", "node"), "node", "left")
          .groupBy("doc_id").agg(F.min(F.coalesce("comp", "node")).alias("comp")))
    return (sigs.join(of, "doc_id", "left")
            .select("doc_id", "n_shingles", F.coalesce("comp", "doc_id").alias("component_id")))


def _classes(stage: shared.Stage, texts: DataFrame, sig: list[str]) -> tuple[DataFrame, DataFrame | None]:
    """The texts (doc_id and signature) with their class's smallest doc_id ``rep`` and its number ``node``;
    links between the classes of one doc_id, None if each has one.

    A class's rows are dealt to ``SALTS`` parts; only the parts' smallest ids meet.
    """
    salted = texts.withColumn("salt", F.pmod(F.xxhash64("doc_id"), F.lit(SALTS)))
    parts = salted.groupBy(*sig, "salt").agg(F.min("doc_id").alias("low"))
    reps = parts.groupBy(*sig).agg(F.min("low").alias("rep"))
    members = stage.keep("members", salted.join(parts.drop("low").join(reps, sig), [*sig, "salt"])
                         .select("doc_id", "rep", *sig))
    own = F.col("doc_id") == F.col("rep")
    several = members.filter(own).groupBy("rep").agg(F.min(F.struct(*sig)).alias("first"), F.count("*").alias("n"))
    several = stage.keep("several", several.filter("n > 1").select("rep", "first"))
    shares = members.groupBy("doc_id").agg(F.min(F.struct(*sig)).alias("s"), F.max(F.struct(*sig)).alias("t")).filter(
        "s <> t")
    if not shares.limit(1).count():
        return members.withColumn("node", F.col("rep")), None
    top = members.agg(F.max("doc_id")).first()[0]
    others = stage.keep("others", members.filter(own).join(several, "rep").filter(F.struct(*sig) != F.col("first"))
                        .select(*sig, (F.lit(top) + 1 + F.monotonically_increasing_id()).alias("node")))
    numbered = stage.keep("nodes", members.join(others, sig, "left").select(
        "doc_id", "rep", *sig, F.coalesce("node", "rep").alias("node")))
    hubs = numbered.groupBy("doc_id").agg(F.min("node").alias("a"), F.max("node").alias("b")).filter("a < b")
    links = numbered.join(hubs.select("doc_id", "a"), "doc_id").filter("a < node").select("a", F.col("node").alias("b"))
    return numbered, stage.keep("twice", links.distinct())


def _more(links: DataFrame | None, found: DataFrame) -> DataFrame:
    return found if links is None else links.unionByName(found)


def _labelled(posts: DataFrame, comp: DataFrame | None) -> DataFrame:
    if comp is None:
        return posts.withColumn("comp", F.col("doc"))
    return (posts.join(comp.withColumnRenamed("id", "doc"), "doc", "left")
            .select("key", "doc", "n", "room", F.coalesce("comp", "doc").alias("comp")))


def _roomy(posts: DataFrame, percent: int) -> DataFrame:
    """Rows with room for the common keys that a link to the smallest set of their posting takes."""
    least = posts.groupBy("key").agg(F.min("n").alias("least"), F.count("*").alias("rows")).filter("rows > 1")
    other = F.greatest("least", F.floor((F.col("n") * percent + 99) / 100))
    return (posts.join(least, "key").filter(F.col("room") * (100 + percent) >= (F.col("n") + other) * percent)
            .drop("least", "rows"))


def _open(known: DataFrame) -> DataFrame:
    """Postings with several components, with the pairs across them that a row stands for."""
    sizes = known.groupBy("key", "comp").agg(F.count("*").alias("k"))
    cross = (sizes.groupBy("key").agg(F.count("*").alias("comps"), F.sum("k").alias("all"))
             .filter("comps > 1").select("key", "all"))
    own = sizes.join(cross, "key").select("key", "comp", ((F.col("all") - F.col("k")) / 2).alias("cross"))
    return known.join(own, ["key", "comp"])
