"""Document quality from a linear-chain conditional random field over lines.

Every line that is not blank is labelled good or bad. A line's features are its
own, its neighbours' and a transition to the next label; forward-backward gives
the marginal probability of good. A document's quality is the mean marginal,
weighted by the lines' bytes, put on the scale of the labels by a logistic
curve of one variable.

Only documents are labelled, so training starts with the document's label on
each of its lines, and then lets the lines of bad documents take the model's
label (their worst line stays bad) and fits again. It uses a bounded sample of
the labelled documents: ``SAMPLE`` of each label at most, by hash order, and no
further one once those before it have ``SAMPLE_LINES`` lines. Each is taken
whole. Scores read all lines of all texts: ``SLICE`` bytes at a time become
features, of which each line keeps four numbers, and a long text's chain goes
in pieces of ``PIECE`` lines that step together. Repeated rows are scored each.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from heatgrid.llm import shared, words

SAMPLE = 1500
SAMPLE_LINES = 1 << 17       # of each label
ROUNDS, STEPS, PENALTY = 3, 150, 1e-3
CHUNK_BYTES = 2 << 20
SLICE = 1 << 18              # bytes made into features at a time when texts are scored
PIECE = 512                  # lines of a chain stepped one after another when texts are scored

_CLASS = np.zeros(256, np.int8)      # byte -> class; 0: none of these
for _k, _bytes in enumerate((b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789", b".,;:'\"-()", b"!?", b"|",
                             b"#$%&*@^~+=_<>{}[]/\\`"), 1):
    _CLASS[list(_bytes)] = _k
_CLASSES = 7
_LINE_FEATURES = 15


def line_features(data: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of the texts in ``data`` at ``rows``: features and bytes of each line with words, lines before each text."""
    breaks = np.flatnonzero(data == 10) + 1
    cuts = np.unique(np.concatenate([breaks, rows]))
    starts, ends, at = words.word_spans(data, cuts)
    count = np.diff(at)
    use = np.flatnonzero(count)
    n = len(use)
    text_lines = np.searchsorted(cuts[use], rows)
    if not n:
        return np.zeros((0, _LINE_FEATURES)), np.zeros(0), text_lines
    line = np.repeat(np.arange(n), count[use])
    k = count[use].astype(float)
    size = np.bincount(line, ends - starts, minlength=n)
    kinds = np.zeros((n, _CLASSES))
    cls = _CLASS[data]
    special = np.flatnonzero(cls)
    of = np.searchsorted(cuts, special, "right") - 1
    back = np.full(len(cuts), -1)
    back[use] = np.arange(n)
    of = back[of]
    np.add.at(kinds, (of[of >= 0], cls[special][of >= 0]), 1)
    h = words.hash_spans(data, starts, ends)
    same = np.zeros(len(h), bool)
    same[1:] = (h[1:] == h[:-1]) & (line[1:] == line[:-1])
    pair = np.sort((line.astype(words.U) << words.U(40)) | (h >> words.U(24)))
    fresh = np.concatenate([[True], pair[1:] != pair[:-1]])
    distinct = np.bincount((pair[fresh] >> words.U(40)).astype(np.int64), minlength=n)
    length = ends - starts
    last = cls[ends - 1]
    share = lambda x: np.bincount(line, x, minlength=n) / k
    cols = [kinds[:, 1] / size, kinds[:, 2] / size, kinds[:, 3] / k, kinds[:, 4] / k, kinds[:, 5] / k,
            kinds[:, 6] / k, share(last == 4), share(last == 6), share((length == 1) & (last == 5)), share(same),
            1 - distinct / k, np.log1p(k) / 5, np.minimum(size / k, 30) / 10, share(length <= 3), np.sqrt(share(same))]
    return np.minimum(np.stack(cols, 1), 3.0), size, text_lines


def with_neighbours(x: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Own, previous and next line's features (zeros beyond a text's ends) and a constant."""
    before, after = np.zeros_like(x), np.zeros_like(x)
    before[1:], after[:-1] = x[:-1], x[1:]
    edge = rows[:-1][np.diff(rows) > 0]
    before[edge] = 0
    after[rows[1:][np.diff(rows) > 0] - 1] = 0
    return np.concatenate([x, before, after, np.ones((len(x), 1))], 1)


def marginals(emit: np.ndarray, rows: np.ndarray, move: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """P(good) of each line, and the expected number of each transition; chains are the runs in ``rows``.

    All chains step together; longest first, so those still going are a prefix.
    """
    size = np.diff(rows)
    order = np.argsort(-size, kind="stable")
    first, size = rows[:-1][order], size[order]
    going = np.searchsorted(-size, -np.arange(size[0] if len(size) else 0), "left")
    e = np.stack([np.zeros_like(emit), emit], 1)
    fore, back = e.copy(), np.zeros_like(e)
    for t in range(1, len(going)):
        at = first[:going[t]] + t
        fore[at] += np.logaddexp(fore[at - 1, :1] + move[0], fore[at - 1, 1:] + move[1])
    for t in range(len(going) - 1, 0, -1):
        at = first[:going[t]] + t
        reach = e[at] + back[at]
        back[at - 1] = np.logaddexp(reach[:, :1] + move[:, 0], reach[:, 1:] + move[:, 1])
    both = fore + back
    total = np.logaddexp(both[:, 0], both[:, 1])
    inner = np.ones(len(emit), bool)
    inner[rows[:-1][np.diff(rows) > 0]] = False
    at = np.flatnonzero(inner)
    pair = fore[at - 1][:, :, None] + move + (e[at] + back[at])[:, None, :] - total[at][:, None, None]
    return np.exp(both[:, 1] - total), np.exp(pair).sum(0)


def _going(size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Runs by falling size, and how many of them have a step t."""
    order = np.argsort(-size, kind="stable")
    return order, np.searchsorted(-size[order], -np.arange(size.max() if len(size) else 0), "left")


def posterior(emit: np.ndarray, rows: np.ndarray, move: np.ndarray, piece: int = PIECE) -> np.ndarray:
    """P(good) of each line, as ``marginals`` gives it, for chains of any length.

    Chains are cut into pieces. All pieces step together and give the weights
    from their first line's state to their last line's; these are put together
    piece by piece, and then all pieces step once more, from what came before
    and what follows.
    """
    size = np.diff(rows)
    pieces = -(-size // piece)
    chain = np.repeat(np.arange(len(size)), pieces)
    place = np.arange(len(chain)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
    start = rows[:-1][chain] + place * piece
    stop = np.minimum(start + piece, rows[1:][chain])
    order, going = _going(stop - start)
    first = start[order]
    e = np.stack([np.zeros_like(emit), emit], 1)
    before, after = np.zeros((len(chain), 2)), np.zeros((len(chain), 2))
    several = len(pieces) and pieces.max() > 1
    if several:
        through = np.full((len(chain), 2, 2), -np.inf)         # by rank: first line's state to last line's
        through[:, 0, 0], through[:, 1, 1] = e[first, 0], e[first, 1]
        for t in range(1, len(going)):
            n = going[t]
            through[:n] = np.logaddexp(through[:n, :, :1] + move[0], through[:n, :, 1:] + move[1]) + e[
                first[:n] + t][:, None, :]
        of = np.empty_like(through)
        of[order] = through
        for k in range(1, pieces.max()):
            at = np.flatnonzero(place == k)
            end = np.logaddexp(before[at - 1, :1] + of[at - 1, 0], before[at - 1, 1:] + of[at - 1, 1])
            before[at] = np.logaddexp(end[:, :1] + move[0], end[:, 1:] + move[1])
        for k in range(pieces.max() - 1, 0, -1):
            at = np.flatnonzero(place == k)
            whole = np.logaddexp(of[at, :, 0] + after[at, :1], of[at, :, 1] + after[at, 1:])
            after[at - 1] = np.logaddexp(whole[:, :1] + move[:, 0], whole[:, 1:] + move[:, 1])
    fore, back = e.copy(), np.zeros_like(e)
    fore[start] += before
    back[stop - 1] = after
    for t in range(1, len(going)):
        at = first[:going[t]] + t
        fore[at] += np.logaddexp(fore[at - 1, :1] + move[0], fore[at - 1, 1:] + move[1])
    for t in range(len(going) - 1, 0, -1):
        at = first[:going[t]] + t
        reach = e[at] + back[at]
        back[at - 1] = np.logaddexp(reach[:, :1] + move[:, 0], reach[:, 1:] + move[:, 1])
    fore += back
    return np.exp(fore[:, 1] - np.logaddexp(fore[:, 0], fore[:, 1]))


def _slices(data: np.ndarray, rows: np.ndarray, limit: int) -> Iterator[tuple[int, int]]:
    """Runs of whole lines with about ``limit`` bytes each; a text's end ends a line as well."""
    cuts = np.unique(np.concatenate([np.flatnonzero(data == 10) + 1, rows]))
    return ((int(cuts[a]), int(cuts[b])) for a, b in words.chunks(cuts, limit))


@dataclass
class Model:
    mean: np.ndarray
    scale: np.ndarray
    weight: np.ndarray
    move: np.ndarray
    slope: float = 1.0
    shift: float = 0.0

    def lines(self, data: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Of the texts in ``data`` at ``rows``: P(good) and bytes of each line with words, lines before each text."""
        weight = self.weight / self.scale
        n = _LINE_FEATURES
        part = np.stack([weight[:n], weight[n:2 * n], weight[2 * n:3 * n]], 1)      # own, previous, next line
        seen, sizes, marks, counts = [np.zeros((0, 3))], [np.zeros(0)], [np.zeros(1, np.int64)], [np.zeros(1, np.int64)]
        for a, b in _slices(data, rows, SLICE):
            inner = rows[(rows > a) & (rows < b)]
            x, size, at = line_features(data[a:b], np.concatenate([[0], inner - a, [b - a]]))
            seen.append(x @ part)
            sizes.append(size)
            marks.append(np.append(inner, b))           # lines are counted up to texts' starts and slices' ends
            counts.append(counts[-1][-1] + at[1:])
        seen, size = np.concatenate(seen), np.concatenate(sizes)
        del sizes
        lines = np.concatenate(counts)[np.searchsorted(np.concatenate(marks), rows)]
        emit = seen[:, 0] + self.weight[-1] - float(self.mean[:-1] @ weight[:-1])
        inside = np.ones(len(emit), bool)
        inside[lines[:-1][np.diff(lines) > 0]] = False
        at = np.flatnonzero(inside)
        emit[at] += seen[at - 1, 1]
        emit[at - 1] += seen[at, 2]
        del seen, inside, at
        return posterior(emit, lines, self.move), size, lines


def aggregate(good: np.ndarray, size: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Per text the mean marginal, weighted by bytes, as log odds; nan without lines."""
    total = np.concatenate([[0], np.cumsum(size)])
    part = np.concatenate([[0], np.cumsum(good * size)])
    n = total[rows[1:]] - total[rows[:-1]]
    mean = np.clip((part[rows[1:]] - part[rows[:-1]]) / np.where(n > 0, n, np.nan), 1e-4, 1 - 1e-4)
    return np.log(mean / (1 - mean))


def _adam(gradient, start: np.ndarray, steps: int, rate: float) -> np.ndarray:
    x, m, v = start.copy(), np.zeros_like(start), np.zeros_like(start)
    for t in range(1, steps + 1):
        g = gradient(x)
        m, v = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g
        x += rate * (m / (1 - 0.9 ** t)) / (np.sqrt(v / (1 - 0.99 ** t)) + 1e-9)
    return x


def fit(features: list[np.ndarray], sizes: list[np.ndarray], labels: np.ndarray) -> Model:
    """Train on texts' line features, line bytes and labels (1 good)."""
    keep = [i for i, f in enumerate(features) if len(f)]
    labels = labels[keep].astype(float)
    rows = np.concatenate([[0], np.cumsum([len(features[i]) for i in keep])]).astype(np.int64)
    x = np.concatenate([features[i] for i in keep])
    size = np.concatenate([sizes[i] for i in keep])
    full = with_neighbours(x, rows)
    mean, scale = full.mean(0), full.std(0)
    mean[-1], scale = 0, np.where(scale > 1e-9, scale, 1)
    full -= mean
    full /= scale
    z = full
    text = np.repeat(np.arange(len(keep)), np.diff(rows))
    of_label = np.bincount(labels.astype(int), minlength=2)
    share = (len(labels) / 2 / np.maximum(of_label, 1))[labels.astype(int)]    # both labels weigh the same
    weigh = (share / np.diff(rows))[text]                                      # and each text as much as any other
    inner = np.ones(len(x), bool)
    inner[rows[:-1]] = False
    at = np.flatnonzero(inner)
    y, params = labels[text], np.zeros(z.shape[1] + 4)
    for r in range(ROUNDS):
        seen = np.zeros((2, 2))
        np.add.at(seen, (y[at - 1].astype(int), y[at].astype(int)), 1)

        def gradient(p):
            good, moved = marginals(z @ p[:-4], rows, p[-4:].reshape(2, 2))
            g = np.concatenate([z.T @ ((y - good) * weigh) / len(labels),
                                ((seen - moved) / max(1, len(at))).ravel()])
            return g - PENALTY * p
        params = _adam(gradient, params, STEPS, 0.05)
        good, _ = marginals(z @ params[:-4], rows, params[-4:].reshape(2, 2))
        bad_text = labels[text] == 0
        worst = np.minimum.reduceat(good, rows[:-1])[text]
        y = np.where(bad_text, ((good > 0.5) & (good > worst)).astype(float), 1.0)
    model = Model(mean, scale, params[:-4], params[-4:].reshape(2, 2))
    odds = aggregate(good, size, rows)

    def curve(p):
        miss = (labels - 1 / (1 + np.exp(-np.clip(p[0] * odds + p[1], -30, 30)))) * share
        return np.array([(miss * odds).mean(), miss.mean()]) - 1e-3 * p
    model.slope, model.shift = _adam(curve, np.array([1.0, 0.0]), 400, 0.05).tolist()
    return model


def _features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        raw, ends = words.column_bytes(batch.column(2))
        for a, b in words.chunks(ends):
            x, size, rows = line_features(raw[ends[a]:ends[b]], ends[a:b + 1] - ends[a])
            at = list(zip(rows[:-1], rows[1:]))
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(k).slice(a, b - a) for k in (0, 1)), pa.array(np.diff(rows).astype(np.int64)),
                 pa.array([x[i:j].astype("<f4").tobytes() for i, j in at], pa.binary()),
                 pa.array([size[i:j].astype("<f4").tobytes() for i, j in at], pa.binary())],
                names=["doc_id", "label", "lines", "x", "size"])


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, lines: int = SAMPLE_LINES) -> Model | None:
    """Fit on ``docs`` (doc_id, text) with ``labels`` (doc_id, quality 0 or 1). None without both labels.

    Of several labels of an id the lowest holds; null ids and labels are left out.
    """
    marked = (labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("long").alias("label"))
              .filter("doc_id is not null and label in (0, 1)").groupBy("doc_id").agg(F.min("label").alias("label")))
    # by hash, so the sample is the same for every layout of the tables; 2 * sample rows at most
    some = [marked.filter(F.col("label") == k).orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample) for k in (0, 1)]
    stage = shared.Stage(docs.sparkSession, "line-crf")
    table = stage.keep("features", docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                                               F.col("text").cast("string").alias("text"))
                       .join(F.broadcast(some[0].unionByName(some[1])), "doc_id").groupBy("doc_id")
                       .agg(F.min("label").alias("label"), F.min("text").alias("text"))
                       .mapInArrow(_features, "doc_id long, label long, lines long, x binary, size binary"))
    earlier = (Window.partitionBy("label").orderBy(F.xxhash64("doc_id"), "doc_id")
               .rowsBetween(Window.unboundedPreceding, -1))
    fits = (table.select("doc_id", F.coalesce(F.sum("lines").over(earlier), F.lit(0)).alias("before"))
            .filter(F.col("before") < lines).select("doc_id"))
    rows = table.join(F.broadcast(fits), "doc_id").orderBy("doc_id").select("label", "lines", "x", "size").collect()
    stage.drop("features")
    if len({r.label for r in rows if r.lines}) < 2:
        return None
    return fit([np.frombuffer(r.x, "<f4").reshape(r.lines, -1).astype(float) for r in rows],
               [np.frombuffer(r.size, "<f4").astype(float) for r in rows], np.array([r.label for r in rows]))


def _scores(model: Model | None, column: int, keep_text: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw, ends = words.column_bytes(batch.column(column))
            for a, b in words.chunks(ends, CHUNK_BYTES):
                data, texts = raw[ends[a]:ends[b]], ends[a:b + 1] - ends[a]
                if model is None:
                    rows = line_features(data, texts)[2]
                    score, bad = np.full(b - a, 0.5), np.zeros(b - a, np.int64)
                else:
                    good, size, rows = model.lines(data, texts)
                    odds = aggregate(good, size, rows)
                    score = 1 / (1 + np.exp(-np.clip(model.slope * odds + model.shift, -30, 30)))
                    count = np.concatenate([[0], np.cumsum(good < 0.5)])
                    bad = count[rows[1:]] - count[rows[:-1]]
                lines = np.diff(rows)
                score = np.where(lines > 0, score, 0.0)
                part = batch.slice(a, b - a)
                if not keep_text:
                    part = part.drop_columns([batch.schema.names[column]])
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, pa.array(score), pa.array(lines.astype(np.int64)),
                     pa.array(bad.astype(np.int64))], names=[*part.schema.names, "score", "n_lines", "bad_lines"])
    return run


def score(docs: DataFrame, model: Model | None, keep_text: bool = True) -> DataFrame:
    """``docs`` (a column ``text`` and any others) with score, n_lines (not blank) and bad_lines.

    ``score`` is from 0 to 1, higher if the text is likelier good. A text
    without words, null or empty, has no line and scores 0. Without a model
    all others score 0.5. Columns that are named like the new ones are replaced.
    """
    docs = docs.drop("score", "n_lines", "bad_lines")
    schema = docs.withColumns({"score": F.lit(0.5), "n_lines": F.lit(0).cast("long"),
                               "bad_lines": F.lit(0).cast("long")}).schema
    if not keep_text:
        schema = T.StructType([f for f in schema if f.name != "text"])
    return docs.mapInArrow(_scores(model, docs.columns.index("text"), keep_text), schema)
