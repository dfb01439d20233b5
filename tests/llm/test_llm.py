"""Every operator against a brute-force version, and its edge cases, on small tables."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from heatgrid.llm import (best_fit_packing as bfp, cross_polytope as cp, deleted_interpolation as di,
                          edit_decontamination as ed, edit_token_counts as et, line_crf, minimax_sharding as ms,
                          ngram_jaccard_join as nj, queries, trigram_secrets as ts, window_line_dedup as wl, words)
from heatgrid.llm.word_tokens import WordTokens

P = pytest.importorskip("public_tokenizers")
SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long, score string, row int, spans int, w int"
LONG = "word " * 30000 + "password=abcdefghijklmnop\n" * 40
EDGE = [(1, "a b c d e f g"), (1, "a b c d e f g"), (2, None), (3, ""), (None, "a b c d e f g"), (4, " \n\t "),
        (5, "one two"), (6, "one two"), (7, LONG), (8, LONG + " end"), (9, "ÀÉ ñ 字 \U0001f600 é x"),
        (None, None), (10, "l one\nl two\nl three\n\nl four"), (11, "x\nl one\nl two\nl three\n \nl four\ny")]


@pytest.fixture(scope="module", autouse=True)
def package(spark):
    queries.prepare_workers(spark)


def table(spark, rows, schema=DOCS):
    width = len(schema.split(","))
    return spark.createDataFrame([(*r, *[None] * (width - len(r))) for r in rows], schema)


def tokens(text):
    low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall(r"[^\x20\x09-\x0D]+", low)


def shingles(text, n=5):
    w = tokens(text)
    return {tuple(w[k:k + n]) for k in range(len(w) - n + 1)} if len(w) >= n else ({tuple(w)} if w else set())


def groups(ids, links):
    up = {i: i for i in ids}

    def root(x):
        while up[x] != x:
            x = up[x]
        return x
    for a, b in links:
        a, b = sorted((root(a), root(b)))
        up[b] = a
    return {i: root(i) for i in ids}


def sf_docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


def near_copies(seed=7):
    """Copies with few and many changes of two texts, so that links form chains."""
    rnd = random.Random(seed)
    out = []
    for base in range(2):
        text = [f"w{base}{rnd.randint(0, 60)}" for _ in range(120)]
        for _ in range(45):
            copy = list(text)
            for _ in range(rnd.choice([0, 0, 1, 2, 3])):
                copy[rnd.randrange(len(copy))] = f"n{rnd.randint(0, 10 ** 6)}"
            out.append(" ".join(copy))
    return out


# words -------------------------------------------------------------------------------------------

def test_word_hashes_tell_words_apart_and_ignore_ascii_case():
    import pyarrow as pa
    rnd = random.Random(1)
    texts = ["".join(rnd.choices("aAbB é字\n\t\x1c", k=rnd.randint(0, 40))) for _ in range(400)] + [None, ""]
    seen = {}
    for w in words.word_chunks(pa.array(texts), 300):
        for k in range(w.first, w.last):
            mine = w.hashes[w.rows[k - w.first]:w.rows[k - w.first + 1]].tolist()
            assert len(mine) == len(tokens(texts[k]))
            for h, t in zip(mine, tokens(texts[k])):
                assert seen.setdefault(t, h) == h
    assert len(set(seen.values())) == len(seen)


def test_packed_numbers_come_back():
    for x in ([], [0], [5, 300, 2 ** 63], list(range(1000))):
        x = np.array(x, np.uint64)
        assert words.unpack_ints(words.pack_ints(x)).tolist() == x.tolist()
        assert words.unpack_sorted(words.pack_sorted(np.sort(x))).tolist() == sorted(x.tolist())


# 1 -----------------------------------------------------------------------------------------------

def test_forward_backward_equals_enumeration():
    rnd = np.random.default_rng(2)
    emit, move, rows = rnd.normal(size=9), rnd.normal(size=(2, 2)), np.array([0, 4, 4, 5, 9])
    good, moved = line_crf.marginals(emit, rows, move)
    want, pairs = np.zeros(9), np.zeros((2, 2))
    for a, b in zip(rows[:-1], rows[1:]):
        n = b - a
        paths = [[(m >> t) & 1 for t in range(n)] for m in range(1 << n)] if n else []
        weight = [math.exp(sum(emit[a + t] * p[t] for t in range(n)) + sum(move[p[t - 1], p[t]] for t in range(1, n)))
                  for p in paths]
        for p, w in zip(paths, weight):
            for t in range(n):
                want[a + t] += p[t] * w / sum(weight)
                if t:
                    pairs[p[t - 1], p[t]] += w / sum(weight)
    assert np.allclose(good, want) and np.allclose(moved, pairs)


def test_quality_on_held_out_documents(spark):
    sf = "/root/testdata/sf0.01"
    got = queries.op1_line_crf(spark, sf).join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").filter("held_out")
    rows = got.collect()
    assert sum(r.predicted == r.quality for r in rows) >= 0.97 * len(rows)


def test_quality_edges(spark):
    docs = table(spark, EDGE)
    labels = spark.createDataFrame([(1, 1), (5, 0), (7, 0), (None, 1), (9, None)], "doc_id long, quality int")
    model = line_crf.train(docs, labels)
    rows = line_crf.score(docs, model).collect()
    assert len(rows) == len(EDGE) and all(0 <= r.score <= 1 for r in rows)
    assert all(r.score == 0 and r.n_lines == 0 for r in rows if not (r.text or "").split())
    assert line_crf.train(docs, labels.filter("quality = 1")) is None
    assert {r.score for r in line_crf.score(docs, None).collect()} == {0.0, 0.5}
    assert line_crf.score(docs.limit(0), model).count() == 0


def test_quality_trains_on_whole_documents(spark, monkeypatch):
    seen = []
    monkeypatch.setattr(line_crf, "fit", lambda x, sizes, labels: seen.append(
        sorted((int(k), len(a), len(b)) for k, a, b in zip(labels, x, sizes))))
    rows = [(i, "\n".join(["some words here"] * n)) for i, n in enumerate([700, 300, 5, 400, 20, 6])]
    docs = table(spark, rows)
    labels = spark.createDataFrame([(i, i % 2) for i in range(6)], "doc_id long, quality int")
    line_crf.train(docs, labels)
    assert seen.pop() == [(0, 5, 5), (0, 20, 20), (0, 700, 700), (1, 6, 6), (1, 300, 300), (1, 400, 400)]
    line_crf.train(docs, labels, lines=1)
    one, = seen
    assert [k for k, *_ in one] == [0, 1] and all((k, n) in {(i % 2, t.count("\n") + 1) for i, t in rows} for k, n, _ in one)


# 2 -----------------------------------------------------------------------------------------------

def brute_lm(docs):
    """Direct counts; EM on the deleted tenth's single bigrams, not on a histogram."""
    fold = {i: zlib.crc32(str(i).encode()) % 10 for i, _ in docs}
    seq = {i: ["<s>", *tokens(t), "</s>"] for i, t in docs}

    def count(keep):
        uni, bi, ctx = Counter(), Counter(), Counter()
        for i, s in seq.items():
            if keep(fold[i]):
                uni.update(s[1:])
                bi.update(zip(s, s[1:]))
                ctx.update(s[:-1])
        return uni, bi, ctx, sum(uni.values())
    uni, bi, ctx, n = count(lambda f: f > 1)
    held = count(lambda f: f == 1)[1]
    bucket = lambda c: c.bit_length()
    cells = defaultdict(list)
    for (u, w), m in held.items():
        p = (bi[u, w] / ctx[u] if ctx[u] else 0, uni[w] / n, 1 / (len(uni) + 1))
        cells[bucket(ctx[u])].append((m, p))
        cells[-1].append((m, p))
    weights = {}
    for b, rows in cells.items():
        x = np.full(3, 1 / 3)
        m, p = np.array([r[0] for r in rows], float), np.array([r[1] for r in rows]).T
        for _ in range(di.EM_ROUNDS):
            s = x[:, None] * p
            x = (s / s.sum(0) * m).sum(1) / m.sum()
        x = np.maximum(x, 1e-6)
        weights[b] = x / x.sum()
    uni, bi, ctx, n = count(lambda f: f > 0)
    out = {}
    for i, s in seq.items():
        base = sum(math.log10((uni[w] + 0.1) / (n + 0.1 * (len(uni) + 1))) for w in s[1:])
        score = 0
        for u, w in zip(s, s[1:]):
            a, b, g = weights.get(bucket(ctx[u]), weights[-1])
            score += math.log10((a * bi[u, w] / ctx[u] if ctx[u] else a * uni[w] / n) + b * uni[w] / n + g / (len(uni) + 1))
        out[i] = (len(s) - 1, sum(uni[w] > 0 for w in s[1:]), n, base, score)
    return out


def test_language_model_equals_direct_counts(spark):
    rows = [(r.doc_id, r.text) for r in sf_docs(spark).collect()]
    want = brute_lm(rows)
    got = {r.doc_id: r for r in di.lm_scores(table(spark, rows)).collect()}
    assert got.keys() == want.keys()
    for i, (n, known, total, base, score) in want.items():
        r = got[i]
        assert (r.n_tokens, r.n_known, r.train_tokens) == (n, known, total)
        assert r.base_score == pytest.approx(base, rel=1e-9)
        assert r.score == pytest.approx(score, rel=2e-3)      # the histogram's steps


def test_language_model_of_repeated_ids(spark, monkeypatch):
    monkeypatch.setattr(di, "CELL_BYTES", 1 << 16)
    monkeypatch.setattr(di, "REPEAT", 3)
    base = [(r.doc_id, r.text) for r in sf_docs(spark).collect()]
    rows = [*base, *[base[0]] * 9, (base[1][0], "another text " + base[2][1]), (None, base[3][1]), (None, base[3][1])]
    got = di.lm_scores(table(spark, rows)).collect()
    assert Counter(r.doc_id for r in got) == Counter(i for i, _ in rows)
    fold = lambda i: 0 if i is None else zlib.crc32(str(i).encode()) % 10
    uni = Counter(w for i, t in rows if fold(i) for w in [*tokens(t), "</s>"])
    n = sum(uni.values())
    want = Counter()
    for i, t in rows:
        seq = [*tokens(t), "</s>"]
        total = sum(math.log10((uni[w] + 0.1) / (n + 0.1 * (len(uni) + 1))) for w in seq)
        want[i, len(seq), sum(uni[w] > 0 for w in seq), round(total, 6)] += 1
    assert Counter((r.doc_id, r.n_tokens, r.n_known, round(r.base_score, 6)) for r in got) == want
    assert {r.train_tokens for r in got} == {n}
    same = {r.score for r in got if r.doc_id == base[0][0]}
    assert len(same) == 1 and len({round(r.score, 9) for r in got if r.doc_id == base[1][0]}) == 2


def test_language_model_probabilities_sum_to_one():
    grid = [((3 << 40) | (4 << 20) | 9, 5.0, -2.0, -5.0), ((3 << 40) | 9, 2.0, 0.0, -2.0)]
    weights = di.fit_weights(grid, 100)
    assert weights.keys() == {-1, 3} and all(sum(w) == pytest.approx(1) for w in weights.values())
    assert di.fit_weights([], 0)[-1] == pytest.approx((1 / 3,) * 3)


def test_language_model_edges(spark):
    rows = di.lm_scores(table(spark, EDGE)).collect()
    got = {r.doc_id: r for r in rows}
    assert Counter(r.doc_id for r in rows) == Counter(i for i, _ in EDGE)
    assert got[2].n_tokens == 1 and got[3].n_tokens == 1 and got[1].n_tokens == 8
    assert sorted(r.n_tokens for r in rows if r.doc_id is None) == [1, 8] and all(r.held_out for r in rows if r.doc_id is None)
    assert di.lm_scores(table(spark, [])).count() == 0
    assert all(math.isfinite(r.score) for r in di.lm_scores(table(spark, [(1, None)])).collect())


# 3 -----------------------------------------------------------------------------------------------

def test_vectors_recall_and_no_false_link(spark):
    rnd = np.random.default_rng(5)
    base = rnd.normal(size=(60, 48))
    rows = [(int(k), (base[k % 60] + rnd.normal(size=48) * rnd.choice([0, 0.02, 0.1, 0.2])).tolist(), int(k % 3 == 0))
            for k in range(900)]
    x = np.array([r[1] for r in rows])
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    label = np.array([r[2] for r in rows])
    true = (x @ x.T >= 0.98) & (label[:, None] == label) & ~np.eye(900, dtype=bool)
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    # the last one takes five functions for a cell
    for block, occupancy in ((cp.BLOCK, cp.OCCUPANCY), (7, cp.OCCUPANCY), (cp.BLOCK, 1e-7)):
        got = {r.vec_id: r for r in cp.near_duplicates(df, block=block, occupancy=occupancy).collect()}
        n = np.array([got[k].n_links for k in range(900)])
        assert (n <= true.sum(1)).all() and n.sum() >= 0.9 * true.sum()
        assert all(got[k].kept == (got[k].component_id == k) for k in got)
        assert all(got[got[k].component_id].component_id == got[k].component_id for k in got)


def test_tables_meet_pairs_at_the_threshold():
    rnd = np.random.default_rng(6)
    for width, functions in ((16, 8), (64, 2), (64, 5), (128, 4)):
        a, b = (x / np.linalg.norm(x, axis=1, keepdims=True) for x in rnd.normal(size=(2, 400, width)))
        b -= (a * b).sum(1, keepdims=True) * a
        c = 0.98 * a + np.sqrt(1 - 0.98 ** 2) * b / np.linalg.norm(b, axis=1, keepdims=True)
        tables = cp.tables_needed(width, functions, cp.PROBES, 0.98, cp.SEED)
        at_a, at_c = (cp.cells(x, tables, functions, cp.PROBES, cp.SEED) for x in (a, c))
        met = ((at_c == at_a[:, :, :1]).any(2) | (at_a == at_c[:, :, :1]).any(2)).any(1)
        assert met.mean() >= 0.99


def test_vector_edges(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [1.0, 0.0, 0.5], 1), (2, [2.0, 0.0, 1.0], 1), (3, [1.0, 0.0, 0.5], 2), (4, None, 1), (5, [], 1),
            (6, [0.0, 0.0, 0.0], 1), (7, [nan, 1.0, 0.0], 1), (8, [inf, 1.0, 0.0], 1), (9, [1.0, None, 0.0], 1),
            (10, [1.0, 0.0, 0.5], None), (None, [1.0, 0.0, 0.5], 1), (1, [1.0, 0.0, 0.5], 1),
            (11, [1.0, 0.0], 1), (12, [1e300, 0.0, 5e299], 1)]
    schema = "vec_id long, embedding array<double>, label int, cid int, links int"
    got = cp.near_duplicates(table(spark, rows, schema)).collect()
    assert sorted((r.vec_id or 0, r.n_links, r.component_id or 0) for r in got) == sorted(
        [(1, 3, 1), (1, 3, 1), (2, 3, 1), (12, 3, 1), (0, 0, 0)] + [(k, 0, k) for k in range(3, 12)])
    assert cp.near_duplicates(table(spark, [], schema)).count() == 0


# 4 -----------------------------------------------------------------------------------------------

def distance(pattern, text):
    row = [0] * (len(text) + 1)
    for i, c in enumerate(pattern, 1):
        new = [i]
        for j, x in enumerate(text, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (c != x)))
        row = new
    return min(row)


def test_myers_equals_dynamic_programming():
    rnd = random.Random(3)
    for _ in range(300):
        p, t = ("".join(rnd.choices("abé ", k=rnd.randint(lo, hi))) for lo, hi in ((1, 80), (0, 90)))
        assert ed.myers(p, t)[0] == distance(p, t)


def test_items_within_the_budget_are_found_and_no_others(spark):
    rnd = random.Random(4)
    word = lambda: "".join(rnd.choices("abcdefghij", k=rnd.randint(2, 8)))
    items = [(k, " ".join(word() for _ in range(rnd.randint(3, 40)))) for k in range(25)]
    docs = []
    for k in range(120):
        text = list(items[k % 25][1])
        for _ in range(rnd.randint(0, 1 + len(text) // 12)):
            at = rnd.randrange(len(text))
            text[at:at + rnd.randint(0, 1)] = rnd.choice(["", "x", "q"])
        docs.append((k, " ".join([word(), "".join(text).upper() if k % 3 else "".join(text), word()])))
    items += [(90, None), (91, "  "), (None, "abc"), (92, "ab")]
    got = ed.find_items(table(spark, docs).select("doc_id", "text", "lang"),
                        spark.createDataFrame(items, "item_id long, text string")).collect()
    want = {}
    for i, text in docs:
        for j, item in items:
            item = ed.normal(item)
            if item and j is not None:
                d = distance(item, ed.normal(text))
                if d <= int(ed.RATE * len(item)):
                    want[i, j] = d
    assert {(r.doc_id, r.item_id): r.distance for r in got} == want and len(got) == len(want)
    texts = dict(docs)
    for r in got:
        part = ed.normal(texts[r.doc_id])[r.match_start:r.match_end]
        assert distance(ed.normal(dict(items)[r.item_id]), part) == r.distance
    assert len(ed.find_items(table(spark, docs).drop("w"), spark.createDataFrame(
        items, "item_id long, text string"), rate=0).collect()) <= len(want)


def test_item_blocks_and_edges(spark):
    items = spark.createDataFrame([(k, f"item number {k} of all") for k in range(9)], "item_id long, text string")
    assert sum(map(len, ed.blocks(items, 60))) == 9 and max(map(len, ed.blocks(items, 60))) < 9
    docs = table(spark, [*EDGE, (20, "An ITEM number\n5 of all"), (20, "An ITEM number\n5 of all")])
    got = ed.find_items(docs, items).collect()
    assert [(r.doc_id, r.item_id, r.distance) for r in got if r.item_id == 5] == [(20, 5, 0)] * 2
    assert ed.decontaminate(docs, items).count() == len(EDGE) and ed.decontaminate(docs, items).schema == docs.schema
    assert ed.find_items(docs, items.limit(0)).count() == 0 == ed.find_items(docs.limit(0), items).count()
    assert ed.decontaminate(docs, items.limit(0)).count() == len(EDGE) + 2


# 5 -----------------------------------------------------------------------------------------------

def best_fit(lengths, window):
    """Windows' contents by best-fit decreasing on single rests."""
    windows = []
    for n in sorted(lengths, reverse=True):
        fits = [w for w in windows if sum(w) + n <= window]
        if fits:
            max(fits, key=sum).append(n)
        else:
            windows.append([n])
    return sorted(sorted(w) for w in windows)


def test_packing_of_counts_equals_best_fit_decreasing():
    rnd = random.Random(6)
    for _ in range(60):
        window = rnd.choice([8, 30, 100])
        lengths = [rnd.randint(1, window - 1) for _ in range(rnd.randint(0, 150))]
        filled = defaultdict(list)
        for n, a, k, first, offset in bfp.pack_lengths(dict(Counter(lengths)), window):
            for w in range(first, first + k):
                assert sum(filled[w]) == offset
                filled[w].append(n)
        assert sorted(filled) == list(range(len(filled)))
        # ties between equal capacities make no difference to sizes
        assert sorted(map(sorted, filled.values())) == best_fit(lengths, window) or \
            sorted(map(sum, filled.values())) == sorted(map(sum, best_fit(lengths, window)))


def test_packing_round_trip(spark):
    path = P.path("word_bpe_49k.json")
    rows = [(k, t) for k, (_, t) in enumerate(EDGE)] + [(100 + r.doc_id, r.text) for r in sf_docs(spark).collect()]
    got = bfp.pack(table(spark, rows), path, window=512, with_ids=True).collect()
    encoder = WordTokens(path).encoder
    by_doc, by_seq = defaultdict(list), defaultdict(list)
    for r in got:
        assert zlib.crc32(r.ids) == r.ids_crc32 and len(r.ids) == 4 * r.length
        by_doc[r.doc_id].append(r)
        by_seq[r.sequence_id].append(r)
    for i, text in rows:
        ids = np.array(encoder.encode(text or "", add_special_tokens=False).ids + [2], "<u4").tobytes()
        parts = sorted(by_doc[i], key=lambda r: r.start)
        assert b"".join(p.ids for p in parts) == ids and {p.doc_tokens for p in parts} == {len(ids) // 4}
    assert sorted(by_seq) == list(range(len(by_seq)))
    for parts in by_seq.values():
        parts.sort(key=lambda r: r.offset)
        assert [p.offset for p in parts] == [sum(q.length for q in parts[:k]) for k in range(len(parts))]
        assert sum(p.length for p in parts) <= 512
    assert len(bfp.pack(table(spark, EDGE), path).collect()) >= len(EDGE)
    assert bfp.pack(table(spark, []), path).count() == 0


def test_word_tokens_equal_the_tokenizer():
    w = WordTokens(P.path("word_bpe_49k.json"))
    rnd = random.Random(8)
    some = [*"aBcΣσςİéÉẞßñ.,!?'\"|<>_ \n\t0１²#…", "é", "́", "<|endoftext|>", "<|ENDOFTEXT|>", "'s", "can't",
            "\x85", "\x1c", "字", "ﬁ", "...", ". ", ", "]
    texts = ["".join(rnd.choices(some, k=rnd.randint(0, 25))) for _ in range(4000)]
    want = w.encoder.encode_batch(texts, add_special_tokens=False)
    assert w(texts) == [np.array(e.ids, "<u4").tobytes() for e in want]


# 6 -----------------------------------------------------------------------------------------------

def test_line_dedup_equals_its_sql(spark):
    import duckdb
    con = duckdb.connect()
    con.sql(f"create view documents as select * from '{SF}/documents.parquet'")
    want = sorted(con.sql(wl.oracle_sql()).fetchall())
    got = sorted(tuple(r) for r in queries.op6_window_line_dedup(spark, SF).collect())
    assert got == want and sum(r[2] for r in got) > 0


def test_line_dedup_edges(spark):
    docs = table(spark, [*EDGE, (12, "p\nq\np\nq\np\nq"), (13, "l two\nl three\nl four\nz")])
    got = {(r.doc_id, r.text): r.lines_removed for r in wl.dedup_lines(docs).collect()}
    assert wl.dedup_lines(docs).columns == [*docs.columns, "lines_removed"]
    assert got[11, "x\n \ny"] == 4 and got[13, "z"] == 3 and got[10, EDGE[12][1]] == 0
    assert got[12, "p\nq"] == 4 and got[2, None] == 0 and got[5, "one two"] == 0 and got[6, "one two"] == 0
    assert wl.dedup_lines(docs).count() == len(EDGE) + 2 and wl.dedup_lines(docs.limit(0)).count() == 0


# 7 -----------------------------------------------------------------------------------------------

def test_minimax_cuts_equal_all_partitions():
    from itertools import combinations
    rnd = random.Random(9)
    for _ in range(150):
        sizes, k = [rnd.randint(1, 30) for _ in range(rnd.randint(1, 9))], rnd.randint(1, 4)
        best = min(max(sum(sizes[a:b]) for a, b in zip((0, *c), (*c, len(sizes))))
                   for m in range(min(k, len(sizes))) for c in combinations(range(1, len(sizes)), m))
        cuts = ms.minimax_cuts(sizes, k)
        assert len(cuts) <= k and cuts[0] == 0
        assert max(sum(sizes[a:b]) for a, b in zip(cuts, [*cuts[1:], len(sizes)])) == best


def test_shards(spark):
    rows = [*EDGE, *((100 + r.doc_id, r.text) for r in sf_docs(spark).collect())]
    got = ms.shard(table(spark, rows), 5).collect()
    assert len(got) == len(rows) and {r.law for r in got} == {"bytes"}
    size = lambda t: len((t or "").encode()) + 16
    want = sorted((-1 if i is None else i, size(t), zlib.crc32((t or "").encode())) for i, t in rows)
    assert sorted((-1 if r.doc_id is None else r.doc_id, r.size, r.text_crc32) for r in got) == want
    first, total = {}, Counter()
    for i, t in rows:
        first[t or ""] = min(first.get(t or "", math.inf), -1 if i is None else i)
        total[t or ""] += size(t)
    order = sorted(total, key=lambda t: (first[t], hashlib.md5(t.encode()).digest()))
    sizes = [total[t] for t in order]
    cuts = ms.minimax_cuts(sizes, 5)
    capacity = max(sum(sizes[a:b]) for a, b in zip(cuts, [*cuts[1:], len(sizes)]))
    shards = defaultdict(list)
    for r in got:
        shards[r.shard].append(r)
    assert max(sum(r.size for r in s) for s in shards.values()) == capacity
    assert all(sorted(r.slot for r in s) == list(range(len(s))) for s in shards.values())
    of = defaultdict(set)
    for r in got:
        of[r.size, r.text_crc32].add(r.shard)
    assert all(len(s) == 1 for s in of.values())
    assert ms.shard(table(spark, [])).count() == 0


def test_search_in_stretches_equals_single_groups(monkeypatch):
    monkeypatch.setattr(ms, "UNITS", 8)
    rnd, most_asked = random.Random(11), 0
    for _ in range(400):
        sizes = [rnd.choice([1, 2, 3, rnd.randint(1, 30), rnd.choice([1, 4000])]) for _ in range(rnd.randint(1, 300))]
        k, total = rnd.randint(1, 7), sum(sizes)
        at = [sum(sizes[:i]) for i in range(len(sizes))]

        def fetch(windows, single):
            nonlocal most_asked
            of, most = defaultdict(list), max(2, 8 // len(windows))
            for w, (a, b) in enumerate(windows):
                width = 1 if single else (b - a) // most + 1
                for x in at:
                    if a <= x <= b:
                        of[w, (x - a) // width].append(x)
            most_asked = max(most_asked, len(of))
            return sorted((min(v), max(v), len(v)) for v in of.values())
        runs = [*fetch([(0, total)], len(at) <= 8), (total, total, 0)]
        got = ms.search(fetch, runs, max(max(sizes), -(-total // k)), total, k)
        assert [x for x in got if x < total] == [at[u] for u in ms.minimax_cuts(sizes, k)]
    assert most_asked <= 3 * 2 * 8       # two stretches at least in each of the bounds' windows


def test_level_cuts_keep_the_capacity_and_are_no_emptier_than_greedy_ones():
    rnd = random.Random(12)
    for _ in range(400):
        sizes = [rnd.choice([1, 2, 3, rnd.randint(1, 30), rnd.choice([1, 400])]) for _ in range(rnd.randint(1, 120))]
        k, total = rnd.randint(1, 12), sum(sizes)
        at = [sum(sizes[:i]) for i in range(len(sizes) + 1)]
        runs = [*((a, a, 1) for a in at[:-1]), (total, total, 0)]

        def fetch(windows, single):
            return [(x, x, 1) for x in at[:-1] if any(a <= x <= b for a, b in windows)]

        greedy = ms.search(fetch, runs, max(max(sizes), -(-total // k)), total, k)
        capacity = max(b - a for a, b in zip(greedy, greedy[1:]))
        early = ms.earliest(fetch, runs, capacity, k)
        for j in range(k):      # brute force: the first start whose rest fits into k - j shards
            fits = lambda x: ms.greedy_cuts([e - x for e in at if e > x], capacity, k - j) is not None
            assert early[j] == min(x for x in at if fits(x))
        cuts = ms.level(lambda x: (max(a for a in at if a <= x), min(a for a in at if a > x)), early, capacity, k, total)
        filled = [b - a for a, b in zip(cuts, cuts[1:])]
        assert len(filled) == k and max(filled) == capacity and min(filled) >= 0 and set(cuts) <= set(at)
        assert min(filled) >= min(b - a for a, b in zip(greedy, greedy[1:])) or max(sizes) > total / k / 8


def test_shards_of_many_groups_are_those_of_single_groups(spark, monkeypatch):
    docs = sf_docs(spark).select("doc_id", "text")
    whole = sorted(tuple(r)[:5] for r in ms.shard(docs, 5).drop("slot").collect())
    monkeypatch.setattr(ms, "UNITS", 8)
    assert sorted(tuple(r)[:5] for r in ms.shard(docs, 5).drop("slot").collect()) == whole


# 8 -----------------------------------------------------------------------------------------------

def test_edited_counts_equal_a_new_encoding(spark):
    counter = et.Counter(P.path("byte_bpe_50k.tiktoken"), P.PATTERN)
    rnd = random.Random(10)
    some = ["a", "B", " ", "  ", "\n", "'", "re", "'s", "1", "23", ".", "!?", "é", "　", "ll"]
    text = lambda k: "".join(rnd.choices(some, k=k))
    for n in range(300):
        tree = et.Tree(counter, text(rnd.choice([0, 5, 60, 900])))
        for _ in range(4):
            tree.edit(rnd.randint(-1, len(tree.text) + 2), rnd.choice([0, 1, 3, 200]), text(rnd.choice([0, 1, 30])))
            fresh = et.Tree(counter, tree.text)
            assert [c for leaf in tree.leaves for c in leaf[0]] == [c for leaf in fresh.leaves for c in leaf[0]]
            assert tree.tokens == fresh.tokens == len(counter.encode(tree.text))
            assert tree.sums[1][0] == len(tree.text)


def test_kept_trees_take_further_edits_without_encoding_the_rest(spark, scratch):
    ranks, end = queries.tokenizer("byte_bpe_50k.tiktoken"), "doc_id long, seq long, start long, length long, replacement string"
    counter = et.Counter.of(ranks, P.PATTERN)
    count = lambda t: sum(counter.tokens(counter.cut.findall(t)))
    texts = {r.doc_id: r.text for r in sf_docs(spark).limit(40).collect()} | {-1: "", -2: None, -3: LONG}
    kept = et.build_trees(table(spark, list(texts.items())).select("doc_id", "text"), ranks, P.PATTERN)
    rnd = random.Random(4)
    for batch in range(2):
        kept.write.parquet(f"{scratch}/{batch}")
        kept = spark.read.parquet(f"{scratch}/{batch}")
        edits, want = [], {}
        for i, t in texts.items():
            t = t or ""
            if rnd.random() < 0.3 and i != -3:
                want[i] = t
                continue
            at, new = rnd.randint(0, len(t)), rnd.choice(["", "x", "two words ", "a b " * 200])
            edits.append((i, 1, at, 5, new))
            want[i] = t[:at] + new + t[at + 5:]
        kept, texts = et.apply_edits(kept, spark.createDataFrame(edits, end), ranks, P.PATTERN), want
        got = {r.doc_id: r for r in kept.collect()}
        touched = {e[0]: len(e[4]) for e in edits}
        assert {i: r.text for i, r in got.items()} == want
        for i, r in got.items():
            assert r.n_tokens == count(want[i])
            assert r.encoded_chars <= touched[i] + 300 if i in touched else r.encoded_chars == 0


def test_loaded_tree_encodes_nothing_and_leaves_are_split():
    counter = et.Counter.of(queries.tokenizer("byte_bpe_50k.tiktoken"), P.PATTERN)
    tree = et.Tree(counter, "some words here " * 500)
    again = et.Tree.load(None, tree.text, tree.pack())      # no counter: nothing can be encoded
    assert (again.tokens, again.leaves) == (tree.tokens, tree.leaves)
    for _ in range(300):
        tree.edit(100, 0, "more of it ")
    assert max(len(c) for c, _ in tree.leaves) <= 2 * et.LEAF
    assert tree.tokens == sum(counter.tokens(counter.cut.findall(tree.text)))


def test_edit_edges(spark):
    edits = spark.createDataFrame(
        [(1, 2, 0, 1, "Q"), (1, 1, 2, None, "zz"), (5, 1, None, 1, "x"), (7, 1, 10 ** 9, 5, " tail"), (9, None, 1, 2, None),
         (99, 1, 0, 0, "lost"), (None, 1, 0, 0, "lost"), (2, 1, 0, 3, "new text")],
        "doc_id long, seq long, start long, length long, replacement string")
    docs = et.with_edits(table(spark, EDGE), edits)
    path = P.path("byte_bpe_50k.tiktoken")
    got = et.count_edited(docs, path, P.PATTERN, keep_text=True).collect()
    counter = et.Counter(path, P.PATTERN)
    assert len(got) == len(EDGE)
    assert all(r.edited_tokens == len(counter.encode(r.edited_text)) for r in got)
    texts = {r.doc_id: r.edited_text for r in got}
    assert texts[1] == "Q zzb c d e f g" and texts[2] == "new text" and texts[5] == "one two"
    assert texts[7].endswith(" tail") and max(r.encoded_chars for r in got) < 100
    assert et.count_edited(docs.limit(0), path, P.PATTERN).count() == 0
    small = queries.op8_edit_token_counts(spark, SF).collect()
    assert len(small) == sf_docs(spark).count() and all(r.edits_applied == 3 for r in small)


# 9 -----------------------------------------------------------------------------------------------

def brute_jaccard(rows):
    sets = {i: shingles(t) for i, t in rows}
    ids = sorted(i for i in sets)
    links = [(i, j) for k, i in enumerate(ids) for j in ids[:k] if sets[i] and sets[j]
             and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j])]
    comp = groups(ids, links)
    return {i: (len(sets[i]), comp[i]) for i in ids}, links


@pytest.mark.parametrize("long", [2, nj.LONG])
def test_jaccard_join_equals_all_pairs(spark, monkeypatch, long):
    monkeypatch.setattr(nj, "LONG", long)      # blocks also for short postings
    rows = [(k, t) for k, t in enumerate(near_copies())] + [(1000 + r.doc_id, r.text) for r in sf_docs(spark).collect()]
    want, links = brute_jaccard(rows)
    got = nj.jaccard_components(table(spark, rows)).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == want and len(links) > 50


def test_jaccard_edges(spark):
    got = nj.jaccard_components(table(spark, EDGE)).collect()
    assert len(got) == len(EDGE)
    of = {r.doc_id: (r.n_shingles, r.component_id) for r in got if r.doc_id is not None}
    assert of[1] == (3, 1) and of[2] == (0, 2) and of[3] == (0, 3) and of[5] == (1, 5) and of[6] == (1, 5)
    assert of[8][1] == 7 and all(r.component_id is None for r in got if r.doc_id is None)
    assert nj.jaccard_components(table(spark, [])).count() == 0


# 10 ----------------------------------------------------------------------------------------------

def brute_secrets(text):
    spans = []
    for k, (pattern, group, least, flags) in enumerate([
            (r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 12,
             re.I | re.A), (r"AKIA[A-Z0-9]+", 0, 18, 0), (r"[0-9a-f]+", 0, 16, 0)]):
        spans += [(m.start(), k, m.end()) for m in re.finditer(pattern, text or "", flags) if len(m[group]) >= least]
    return [f"{('assign', 'access', 'hex')[k]}:{a}:{b}" for a, k, b in sorted(spans)]


def test_secrets_equal_a_full_scan(spark):
    rnd = random.Random(11)
    some = ["password", "PassWd", "ſecret", "SECRET", "api_key", "apiKEY", "toKen", "toKen", "=", ":", " ", "'", '"',
            "AKIA", "ABCDEFGH12345678", "0123456789abcdef", "deadbeef", "é字", "\n", "x.y/z+w-=_", "-----BEGIN RSA PRIVATE KEY-----",
            "ghp_" + "a1" * 18]
    rows = [*EDGE, *((100 + k, "".join(rnd.choices(some, k=rnd.randint(0, 14)))) for k in range(500))]
    got = ts.find_secrets(table(spark, rows)).collect()
    texts = defaultdict(list)
    for i, t in rows:
        texts[i].append(brute_secrets(t))
    assert len(got) == len(rows)
    for r in got:
        base = [s for s in r.spans.split(",") if s.split(":")[0] in ("assign", "access", "hex")]
        assert base in texts[r.doc_id]
        assert r.base_sha256 == hashlib.sha256(",".join(base).encode()).hexdigest()
        assert [r.n_assign, r.n_access, r.n_hex] == [sum(s.startswith(k) for s in base) for k in ("assign", "access", "hex")]
    assert any("private_key" in r.spans for r in got) and any("github" in r.spans for r in got)
    assert ts.find_secrets(table(spark, [])).count() == 0


def test_trigram_queries_hold_for_every_match():
    want = {"AKIA[A-Z0-9]+": [["aki", "kia"]], "[0-9a-f]+": [[]], "ab?cd": [["abc", "bcd"], ["acd"]], "x*abc": [["abc"]],
            "(foo|bar)+": [["bar"], ["foo"]], "a.c": [[]], "(abc)?def": [["abc", "bcd", "cde", "def"], ["def"]]}
    for pattern, query in want.items():
        assert sorted(map(sorted, ts.trigram_query(pattern))) == query


# pipeline ----------------------------------------------------------------------------------------

def test_pipeline_stages_take_effect(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    model = line_crf.train(docs, queries.labels_to_learn(spark, SF))
    good = {r.doc_id for r in line_crf.score(docs, model).filter("score >= 0.5").collect()}
    step = corpus_pipeline.quality(spark, docs, SF)
    assert step.columns == docs.columns and {r.doc_id for r in step.collect()} == good
    cut = corpus_pipeline.line_dedup(spark, step, SF)
    assert cut.columns == docs.columns and all(r.n_chars == len(r.text) for r in cut.collect())
    rows = [(r.doc_id, r.text) for r in cut.collect()]
    keep = {i for i, (_, c) in brute_jaccard(rows)[0].items() if c == i}
    one = corpus_pipeline.near_duplicates(spark, cut, SF)
    assert one.columns == docs.columns and {r.doc_id for r in one.collect()} == keep
    bench = [ed.normal(r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    clean = corpus_pipeline.decontamination(spark, one, SF)
    left = {r.doc_id for r in clean.collect()}
    held = {i for i, t in rows if any(b in ed.normal(t) for b in bench)}
    assert clean.columns == docs.columns and left <= keep - held and keep - left
    packed = corpus_pipeline.packing(spark, clean, SF).collect()
    assert {r.doc_id for r in packed} == left
    whole = corpus_pipeline.run(spark, SF).collect()
    assert sorted(map(tuple, whole)) == sorted(map(tuple, packed)) or {r.doc_id for r in whole} == left


def test_near_duplicates_of_repeated_ids(spark):
    a, b, c = ("one two three four five six", "an other text that is not like it", "a third one of its own kind")
    rows = [(1, a), (1, b), (2, b), (3, a), (3, c), (4, c), (4, c), (5, "x"), (5, "x"), (6, None), (None, a), (None, a)]
    got = corpus_pipeline.near_duplicates(spark, table(spark, rows), SF).collect()
    assert sorted((r.doc_id or 0, r.text or "") for r in got) == [
        (0, a), (0, a), (1, b), (1, a), (3, c), (5, "x"), (6, "")]
    got = corpus_pipeline.near_duplicates(spark, table(spark, [(1, a), (2, b), (3, a), (None, a)]), SF).collect()
    assert sorted((r.doc_id or 0, r.text) for r in got) == [(0, a), (1, a), (2, b)]


@pytest.mark.parametrize("rows", [EDGE, []])
def test_pipeline_stages_on_edges(spark, rows):
    docs = table(spark, rows)
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, SF)
        assert out.count() <= max(len(rows), 1) * 100
        if name != "packing":
            assert out.columns == docs.columns
