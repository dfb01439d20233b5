"""Language-model scores by deleted interpolation of n-gram estimates (bigrams).

    p(w | u) = a_b * c(u, w) / c(u)  +  b_b * c(w) / N  +  g_b / (V + 1)

The weights belong to the bucket b of the context's frequency (powers of two)
and are learned by expectation-maximisation: a tenth of the training documents
is deleted from the counts, and the weights maximise the likelihood of that
tenth's bigram counts under the estimates of the rest. Scores then use the
counts of all training documents.

The counts are never in one place. Words are dealt to ``side`` parts by hash,
and the bigram (u, w) to the cell (part of u, part of w) of a square grid, whose
side grows with the root of the text. So neither a frequent context nor a
frequent word loads one task, and a cell needs the counts of its own words only:

1. each task sends a word part the counts of its chunk's distinct words and, as
   bit masks, the grid rows and columns that need them; a part adds up and
   sends each cell what it needs;
2. each task sends a cell its bigrams, per document, with a dictionary of the
   words; a cell joins counts and bigrams and writes both, with a histogram of
   the deleted tenth's counts over (bucket, log estimates);
3. the driver runs EM on the summed histogram, whose size is bounded by its
   grid and not by the data;
4. each cell scores its bigrams; its sums per document, packed by ranges of
   hashes, are added up.

A document goes by its id where that is its own. Of rows that repeat an id, each
different text has a ``copy`` number beside it, and equal ones share their sums.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from heatgrid.llm import shared, words
from heatgrid.llm.words import U, pack_ints, pack_sorted, unpack_ints, unpack_sorted

CELL_BYTES = 20 << 20       # text whose bigrams meet in one cell
CHUNK_BYTES = 3 << 20       # text whose bigrams go into one message
STEPS = 8                   # histogram steps per unit of the natural logarithm
EM_ROUNDS = 60
REPEAT = 1 << 16            # equal rows given out by one task at a time
NO_ID = -(1 << 63)
START, END = U(1), U(2)     # a text's start, as a context, and its end, as a token

_SQL = ("cell int, kind int, k1 binary, k2 binary, a binary, b binary, c binary, d binary, e binary, "
        "n_train long, n_fit long, v_train long, v_fit long")
_NAMES = ["cell", "kind", "k1", "k2", "a", "b", "c", "d", "e", "n_train", "n_fit", "v_train", "v_fit"]
_TYPES = [pa.int32(), pa.int32(), *[pa.binary()] * 7, *[pa.int64()] * 4]
_SCHEMA = pa.schema(list(zip(_NAMES, _TYPES)))
CONTEXTS, TOKENS, BIGRAMS, TOTALS = range(4)
_DIGEST = "unhex(md5(encode(coalesce(text, ''), 'UTF-8')))"


def _batch(rows: list[dict], schema: pa.Schema = _SCHEMA) -> pa.RecordBatch:
    return pa.RecordBatch.from_pylist(rows, schema=schema)


def _part(keys: np.ndarray, side: int) -> np.ndarray:
    return ((keys >> U(32)) % U(side)).astype(np.int64)


def _sequences(batch: pa.RecordBatch, limit: int):
    """Per chunk of texts: each token's context, the token, its text's place in the batch."""
    for w in words.word_chunks(batch.column(1), limit):
        h = np.where(w.hashes < U(3), U(3), w.hashes)
        before, after = np.insert(h, w.rows[:-1], START), np.insert(h, w.rows[1:], END)
        yield before, after, np.repeat(np.arange(w.first, w.last), np.diff(w.rows) + 1)


def _folds(batch: pa.RecordBatch) -> np.ndarray:
    return batch.column(2).to_numpy(zero_copy_only=False)


def _word_counts(side: int):
    """(part; words, mask of columns as context, mask of rows as token, counts to fit, deleted counts)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            folds = _folds(batch)
            for before, after, doc in _sequences(batch, CHUNK_BYTES):
                fold = folds[doc]
                keys, at = np.unique(np.concatenate([before, after]), return_inverse=True)
                u, w = at[:len(before)], at[len(before):]
                row = np.zeros(len(keys), U)
                col = np.zeros(len(keys), U)
                parts = _part(keys, side)
                for mask, of, other in ((row, u, w), (col, w, u)):
                    pair = np.unique(of * 64 + parts[other] % 64)
                    np.bitwise_or.at(mask, pair >> 6, U(1) << (pair & 63).astype(U))
                # a text's start is counted as a context, every token as itself
                first = u[before == START]
                fit = np.bincount(w[fold > 1], minlength=len(keys)) + np.bincount(
                    first[fold[before == START] > 1], minlength=len(keys))
                off = np.bincount(w[fold == 1], minlength=len(keys)) + np.bincount(
                    first[fold[before == START] == 1], minlength=len(keys))
                order = np.argsort(parts, kind="stable")
                edges = np.searchsorted(parts[order], np.arange(side + 1))
                for p in np.flatnonzero(np.diff(edges)):
                    i = order[edges[p]:edges[p + 1]]
                    yield _batch([{"cell": int(p), "k1": pack_sorted(keys[i]), "k2": pack_ints(row[i]),
                                   "a": pack_ints(col[i]), "b": pack_ints(fit[i]), "c": pack_ints(off[i])}])
    return run


def _joined(table: pa.Table, name: str, unpack=unpack_ints) -> np.ndarray:
    return np.concatenate([np.zeros(0, U), *map(unpack, table.column(name).to_pylist())])


def _deal_counts(side: int):
    """A part's sums, dealt to the cells that need them."""
    def run(table: pa.Table) -> pa.Table:
        part = table.column("cell")[0].as_py()
        keys = _joined(table, "k1", unpack_sorted)
        order = np.argsort(keys, kind="stable")     # sorted runs
        ordered = keys[order]
        first = np.flatnonzero(np.concatenate([[True], ordered[1:] != ordered[:-1]]))
        keys = ordered[first]
        row, col = (np.bitwise_or.reduceat(_joined(table, c)[order], first) for c in ("k2", "a"))
        fit, off = (np.add.reduceat(_joined(table, c)[order], first) for c in ("b", "c"))
        token = keys != START
        known, seen = (fit + off > 0) & token, (fit > 0) & token
        rows = [{"cell": -1, "kind": TOTALS, "n_train": int((fit + off)[token].sum()),
                 "n_fit": int(fit[token].sum()), "v_train": int(known.sum()), "v_fit": int(seen.sum())}]
        for other in range(side):
            bit = U(1) << U(other % 64)
            for kind, mask, cell in ((CONTEXTS, row, part * side + other), (TOKENS, col, other * side + part)):
                i = np.flatnonzero(mask & bit)
                if len(i):
                    rows.append({"cell": cell, "kind": kind, "k1": pack_sorted(keys[i]),
                                 "a": pack_ints(fit[i]), "b": pack_ints(off[i])})
        return pa.Table.from_batches([_batch(rows)])
    return run


def _bits(n: int) -> int:
    return max(1, int(n).bit_length())


def _pack_ids(ids: np.ndarray, folds: np.ndarray) -> bytes:
    return pack_ints(np.concatenate([np.diff(ids.astype("<i8").view(U), prepend=U(0)), folds.astype(U)]))


def _unpack_ids(raw: bytes) -> tuple[np.ndarray, np.ndarray]:
    steps, folds = unpack_ints(raw).reshape(2, -1)
    return np.cumsum(steps, dtype=U).view(np.int64), folds


def _pack_copies(copies: np.ndarray) -> bytes | None:
    return pack_ints(copies) if copies.any() else None


def _unpack_copies(raw: bytes | None, n: int) -> np.ndarray:
    return np.zeros(n, U) if raw is None else unpack_ints(raw)


def _distinct(ids: np.ndarray, copies: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The distinct (id, copy) in order, and the place of each among them."""
    order = np.lexsort((copies, ids))
    new = np.ones(len(ids), bool)
    new[1:] = (np.diff(ids[order]) != 0) | (np.diff(copies[order]) != 0)
    at = np.empty(len(ids), np.int64)
    at[order] = np.cumsum(new) - 1
    return ids[order][new], copies[order][new], at


def _send_bigrams(side: int):
    """(cell; words as context, words as token, per context its entries, per entry token, text and times)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, folds = batch.column(0).to_numpy(), _folds(batch)
            copies = batch.column(3).to_numpy().astype(U)
            for before, after, doc in _sequences(batch, CHUNK_BYTES):
                base, n_docs = int(doc[0]), int(doc[-1] - doc[0]) + 1
                keys, at = np.unique(np.concatenate([before, after]), return_inverse=True)
                wide, deep = _bits(len(keys)), _bits(n_docs)
                code = ((at[:len(before)].astype(U) << U(wide + deep)) | (at[len(before):].astype(U) << U(deep))
                        | (doc - base).astype(U))
                code = np.sort(code)
                first = np.flatnonzero(np.concatenate([[True], code[1:] != code[:-1]]))
                times = np.diff(np.append(first, len(code)))
                code = code[first]
                u = (code >> U(wide + deep)).astype(np.int64)
                w = ((code >> U(deep)) & U((1 << wide) - 1)).astype(np.int64)
                d = (code & U((1 << deep) - 1)).astype(np.int64)
                parts = _part(keys, side)
                cell = parts[u] * side + parts[w]
                order = np.argsort(cell.astype(np.int32), kind="stable")
                edges = np.searchsorted(cell[order], np.arange(side * side + 1))
                for c in np.flatnonzero(np.diff(edges)):
                    i = order[edges[c]:edges[c + 1]]
                    contexts, entries = np.unique(u[i], return_counts=True)
                    tokens, token = np.unique(w[i], return_inverse=True)
                    docs, text = np.unique(d[i], return_inverse=True)
                    yield _batch([{"cell": int(c), "kind": BIGRAMS, "k1": pack_sorted(keys[contexts]),
                                   "k2": pack_sorted(keys[tokens]), "a": pack_ints(entries),
                                   "b": pack_ints(np.concatenate([token, text])), "c": pack_ints(times[i]),
                                   "d": _pack_ids(ids[base + docs], folds[base + docs]),
                                   "e": _pack_copies(copies[base + docs])}])
    return run


_CELL = pa.schema([("cell", pa.int32()), ("kinds", pa.binary()), ("uses", pa.binary()), ("docs", pa.binary()),
                   ("copies", pa.binary()), ("doc", pa.binary()), ("times", pa.binary()), ("grid", pa.binary()), ("grid_sums", pa.binary())])


def _bucket(c: np.ndarray) -> np.ndarray:
    """0 for an unseen context, else 1 + floor(log2(c))."""
    return np.where(c > 0, np.frexp(np.maximum(c, 1))[1], 0).astype(np.int64)


def _fill_cell(n_fit: int):
    """Counts and bigrams of a cell: per distinct bigram its counts, per entry its text, and the histogram."""
    def run(table: pa.Table) -> pa.Table:
        kind = table.column("kind").to_numpy()
        counts = {}
        for k in (CONTEXTS, TOKENS):
            part = table.filter(pa.array(kind == k))
            keys = _joined(part, "k1", unpack_sorted)
            order = np.argsort(keys, kind="stable")
            counts[k] = (keys[order], *(_joined(part, x)[order].astype(np.int64) for x in "ab"))
        ids, folds, copies, cols = [], [], [], {"code": [], "doc": [], "times": []}
        for k1, k2, a, b, c, d, e in zip(*(table.filter(pa.array(kind == BIGRAMS)).column(x).to_pylist()
                                           for x in ("k1", "k2", "a", "b", "c", "d", "e"))):
            times, pair = unpack_ints(c), unpack_ints(b).astype(np.int64)
            u = np.repeat(np.searchsorted(counts[CONTEXTS][0], unpack_sorted(k1)), unpack_ints(a).astype(np.int64))
            w = np.searchsorted(counts[TOKENS][0], unpack_sorted(k2))[pair[:len(times)]]
            cols["code"].append((u.astype(U) << U(32)) | w.astype(U))
            cols["doc"].append((pair[len(times):] + sum(map(len, folds))).astype(np.uint32))
            cols["times"].append(times.astype(np.uint32))
            own, fold = _unpack_ids(d)
            ids.append(own)
            folds.append(fold)
            copies.append(_unpack_copies(e, len(own)))
        if not ids:
            return pa.Table.from_batches([], _CELL)
        code, doc, times, ids, fold, copies = (np.concatenate(x) for x in (*cols.values(), ids, folds, copies))
        order = np.argsort(code, kind="stable")
        code, doc, times = code[order], doc[order], times[order].astype(np.int64)
        first = np.flatnonzero(np.concatenate([[True], code[1:] != code[:-1]]))
        own = fold[doc]
        fit, off = (np.add.reduceat(times * which, first) for which in (own > 1, own == 1))
        u, w = (code[first] >> U(32)).astype(np.int64), (code[first] & U(0xFFFFFFFF)).astype(np.int64)
        (_, u_fit, u_off), (_, w_fit, w_off) = counts[CONTEXTS], counts[TOKENS]
        kinds = np.stack([fit + off, u_fit[u] + u_off[u], w_fit[w] + w_off[w]])
        grid, sums = _histogram(off, fit, u_fit[u], w_fit[w], n_fit)
        uses = np.diff(np.append(first, len(code)))
        return pa.Table.from_pylist([{
            "cell": table.column("cell")[0].as_py(), "kinds": pack_ints(kinds.ravel()),
            "uses": pack_ints(uses), "docs": _pack_ids(ids, fold), "copies": _pack_copies(copies),
            "doc": pack_ints(doc), "times": pack_ints(times),
            "grid": grid.astype("<i8").tobytes(), "grid_sums": sums.astype("<f8").tobytes()}], schema=_CELL)
    return run


def _histogram(off, fit, u, w, n_fit) -> tuple[np.ndarray, np.ndarray]:
    """Deleted counts by (bucket, steps of -ln of the two estimates; 0 for an estimate of zero),
    each with its count and the weighted sums of both logarithms."""
    use = off > 0
    off, fit, u, w = off[use], fit[use], u[use], w[use]
    logs = [np.log(np.where(c > 0, c, 1) / np.maximum(n, 1)) for c, n in ((fit, u), (w, max(1, n_fit)))]
    step = [np.where(c > 0, 1 + np.floor(-x * STEPS), 0).astype(np.int64) for c, x in zip((fit, w), logs)]
    code = (_bucket(u) << 40) | (step[0] << 20) | step[1]
    grid, at = np.unique(code, return_inverse=True)
    return grid, np.stack([np.bincount(at, x, minlength=len(grid)) for x in (off, off * logs[0], off * logs[1])])


def _cells_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for g, s in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            s = np.frombuffer(s, "<f8").reshape(3, -1)
            yield pa.RecordBatch.from_arrays([pa.array(np.frombuffer(g, "<i8")), *map(pa.array, s)],
                                             names=["code", "n", "x", "y"])


def fit_weights(grid: list[tuple], v_fit: int) -> dict[int, tuple[float, float, float]]:
    """EM per bucket; bucket -1 is all of them together, for buckets without deleted counts."""
    code, n, x, y = (np.array(c, float if i else np.int64) for i, c in enumerate(zip(*grid))) if grid else [
        np.zeros(0, np.int64), *[np.zeros(0)] * 3]
    p = np.stack([np.where((code >> 20) & 0xFFFFF, np.exp(x / n), 0), np.where(code & 0xFFFFF, np.exp(y / n), 0),
                  np.full(len(code), 1 / (v_fit + 1))])
    bucket, out = code >> 40, {}
    for b in [-1, *np.unique(bucket).tolist()]:
        q, m = (p, n) if b < 0 else (p[:, bucket == b], n[bucket == b])
        weight = np.full(3, 1 / 3)
        for _ in range(EM_ROUNDS if len(m) else 0):
            share = weight[:, None] * q
            weight = (share / share.sum(0) * m).sum(1) / m.sum()
        weight = np.maximum(weight, 1e-6)    # the uniform part keeps every probability above zero
        out[b] = tuple((weight / weight.sum()).tolist())
    return out


def _score(weights: dict, n_train: int, v_train: int, ranges: int):
    table = np.array([weights.get(b, weights[-1]) for b in range(65)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for kinds, uses, docs, copies, doc, times in zip(*(c.to_pylist() for c in batch.columns)):
                uses, times, doc = (unpack_ints(x).astype(np.int64) for x in (uses, times, doc))
                both, u, w = unpack_ints(kinds).astype(np.int64).reshape(3, -1)
                weight = table[_bucket(u)].T
                p = weight[1] * w / max(1, n_train) + weight[2] / (v_train + 1) + np.where(
                    u > 0, weight[0] * both / np.maximum(u, 1), 0)
                lost = np.where(u > 0, 0, weight[0])     # an unseen context's share goes to the words
                p = np.log10(p + lost * w / max(1, n_train))
                base = np.log10((w + 0.1) / (n_train + 0.1 * (v_train + 1)))
                ids = _unpack_ids(docs)[0]
                ids, copies, at = _distinct(ids, _unpack_copies(copies, len(ids)))
                doc = at[doc]
                total = lambda x: np.bincount(doc, times * np.repeat(x, uses), minlength=len(ids))
                n, known, base, p = (total(x) for x in (np.ones(len(uses)), w > 0, base, p))
                used = np.flatnonzero(n)
                part = words.mix(ids[used].view(U) ^ words.mix(copies[used])) % U(ranges)
                order = used[np.argsort(part, kind="stable")]
                edges = np.searchsorted(np.sort(part), np.arange(ranges + 1, dtype=U))
                rows = []
                for r in np.flatnonzero(np.diff(edges)):
                    i = order[edges[r]:edges[r + 1]]
                    rows.append({"range": int(r), "ids": pack_sorted(ids[i].view(U)), "copies": _pack_copies(copies[i]),
                                 "counts": pack_ints(np.concatenate([n[i], known[i]])),
                                 "sums": np.concatenate([base[i], p[i]]).tobytes()})
                yield _batch(rows, _SUMS)
    return run


_SUMS = pa.schema([("range", pa.int32()), ("ids", pa.binary()), ("copies", pa.binary()), ("counts", pa.binary()),
                   ("sums", pa.binary())])


def _add_up(table: pa.Table) -> pa.Table:
    ids = [unpack_sorted(x).view(np.int64) for x in table.column("ids").to_pylist()]
    copies = [_unpack_copies(x, len(i)) for x, i in zip(table.column("copies").to_pylist(), ids)]
    counts = np.concatenate([unpack_ints(x).reshape(2, -1) for x in table.column("counts").to_pylist()], 1)
    sums = np.concatenate([np.frombuffer(x, "<f8").reshape(2, -1) for x in table.column("sums").to_pylist()], 1)
    ids, copies, at = _distinct(np.concatenate(ids), np.concatenate(copies))
    n, known, base, score = (np.bincount(at, c, minlength=len(ids)) for c in (*counts, *sums))
    return pa.table({"id": ids, "copy": copies.astype(np.int64), "n_tokens": n.astype(np.int64),
                     "n_known": known.astype(np.int64), "base_score": base, "score": score})


def _copies(stage: shared.Stage, docs: DataFrame) -> DataFrame:
    """(id, digest, copy, times) of each different text of the ids that several rows have; copies from 1."""
    keys = stage.keep("keys", docs.groupBy("id", F.expr(_DIGEST).alias("digest")).agg(F.count("*").alias("times")))
    many = keys.groupBy("id").agg(F.sum("times").alias("rows")).filter("rows > 1").select("id")
    found = stage.keep("copies", keys.join(many, "id").withColumn("copy", F.monotonically_increasing_id() + 1))
    stage.drop("keys")
    return found


def lm_scores(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score.

    Documents whose crc32(doc_id as text) mod 10 is 0 are held out; 1 is the
    deleted tenth, on which the weights are learned; all but 0 are training.
    Tokens: words (runs of bytes other than space, tab, newline, \\v, \\f, \\r;
    A-Z as a-z), then one end per text. ``score`` is the model's log10
    probability of the text; ``base_score`` that of add-0.1 unigrams.

    A null or empty text is its end alone. Rows that repeat a doc_id are
    documents of their own; so are rows without doc_id, which are held out. No
    rows, no result rows. Other columns are ignored.
    """
    spark = docs.sparkSession
    stage = shared.Stage(spark, "lm")
    docs = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("id"),
                       F.col("text").cast("string").alias("text"),
                       F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 10, F.lit(0)).cast("int").alias("fold"))
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    side = max(1, math.isqrt(max(0, size - 1) // CELL_BYTES) + 1)
    counts = stage.keep("counts", docs.mapInArrow(_word_counts(side), _SQL).groupBy("cell")
                        .applyInArrow(_deal_counts(side), _SQL), "zstd")
    stage.release()
    copies = _copies(stage, docs)
    named = (docs.withColumn("digest", F.expr(_DIGEST)).join(copies.select("id", "digest", "copy"), ["id", "digest"], "left")
             .select("id", "text", "fold", F.coalesce("copy", F.lit(0)).cast("long").alias("copy")))
    n_train, n_fit, v_train, v_fit = (x or 0 for x in counts.filter(f"kind = {TOTALS}").agg(
        *(F.sum(x) for x in _NAMES[-4:])).first())
    cells = stage.keep("cells", counts.filter(f"kind <> {TOTALS}")
                       .unionByName(named.mapInArrow(_send_bigrams(side), _SQL)).groupBy("cell")
                       .applyInArrow(_fill_cell(n_fit), "cell int, kinds binary, uses binary, docs binary, "
                                     "copies binary, doc binary, times binary, grid binary, grid_sums binary"), "zstd")
    stage.release()
    stage.drop("counts")
    grid = (cells.select("grid", "grid_sums").mapInArrow(_cells_of, "code long, n double, x double, y double")
            .groupBy("code").agg(F.sum("n"), F.sum("x"), F.sum("y")).collect())
    weights = fit_weights([tuple(r) for r in sorted(grid)], v_fit)
    sums = stage.keep("sums", cells.select("kinds", "uses", "docs", "copies", "doc", "times")
                      .mapInArrow(_score(weights, n_train, v_train, 4 * side),
                                  "range int, ids binary, copies binary, counts binary, sums binary")
                      .groupBy("range").applyInArrow(_add_up, "id long, copy long, n_tokens long, n_known long, "
                                                              "base_score double, score double"))
    stage.drop("cells")
    # the sums of equal rows are theirs together; a text of many rows is dealt to tasks before it is repeated
    shared_by = (sums.filter("copy > 0").join(copies.select("id", "copy", "times"), ["id", "copy"])
                 .select("id", *(F.expr(f"{c} div times").alias(c) for c in ("n_tokens", "n_known")),
                         *(F.expr(f"{c} / times").alias(c) for c in ("base_score", "score")), "times")
                 .withColumn("block", F.explode(F.expr(f"sequence(0, (times - 1) div {REPEAT})")))
                 .repartition("id", "block", "score")
                 .withColumn("row", F.explode(F.expr(f"sequence(1, least({REPEAT}, times - block * {REPEAT}))")))
                 .drop("times", "block", "row"))
    rows = sums.filter("copy = 0").drop("copy").unionByName(shared_by)
    doc_id = F.when(F.col("id") != NO_ID, F.col("id"))
    return rows.select(doc_id.alias("doc_id"),
                       (F.coalesce(F.crc32(doc_id.cast("string")) % 10, F.lit(0)) == 0).alias("held_out"),
                       "n_tokens", "n_known", F.lit(n_train).cast("long").alias("train_tokens"),
                       "base_score", "score")
