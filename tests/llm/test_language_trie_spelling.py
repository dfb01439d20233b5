"""Language identification, prefix trie, spelling variants and line scores against brute force, and edge cases."""

import hashlib
import os
import random
import re
import subprocess
import sys
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from heatgrid.llm import line_crf, prefix_trie as pt, queries, spelling_variants as sv, zstd_language as zl

SF = "/root/testdata/sf0.001"
LONG = "Straße und Wörter " * 20000


@pytest.fixture(scope="module", autouse=True)
def package(spark):
    queries.prepare_workers(spark)


# ---------------------------------------------------------------- language identification
def test_language_on_held_out_documents(spark):
    rows = queries.queries()["op11_zstd_language"](spark, "/root/testdata/sf0.01").collect()
    langs = {r.doc_id: r.lang for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").collect()}
    assert sorted(r.doc_id for r in rows) == sorted(langs)
    held = [r for r in rows if zlib.crc32(str(r.doc_id).encode()) % 5 == 0]
    assert {r.doc_id for r in rows if r.held_out} == {r.doc_id for r in held}
    assert sum(r.lang_pred == langs[r.doc_id] for r in held) >= 0.97 * len(held)
    assert all(0 <= r.score <= 1 for r in rows)
    sure = [r for r in held if not r.rejected]
    assert len(sure) >= 0.95 * len(held) and sum(r.lang_pred == langs[r.doc_id] for r in sure) >= 0.98 * len(sure)


def test_sizes_are_those_of_all_blocks_under_each_dictionary():
    import zstandard
    model = zl.Model(["x", "y"], [b" haus und hof " * 50, b" house and yard " * 50], 0.3)
    text = "Haus UND Hof, 12 Höfe! " * 700
    params = zstandard.ZstdCompressionParameters.from_level(zl.LEVEL, write_content_size=False, write_checksum=False,
                                                            write_dict_id=False)
    want = []
    for content in model.dictionaries:
        kept = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        total = 0
        for at in range(0, len(text), zl.BLOCK):
            block = " ".join(re.findall(r"[^\W\d_]+", text[at:at + zl.BLOCK].lower()))
            block = f" {block} ".encode()
            total += len(zstandard.ZstdCompressor(dict_data=kept, compression_params=params).compress(
                block * zl.TIMES if len(block) < zl.SHORT else block))
        want.append(total)
    assert model.sizes(text).tolist() == want
    assert model.predict(text)[0] == "x"
    assert model.predict("house and yard and house")[0] == "y"


def test_passages_of_every_layout_are_the_same(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    one, many = zl.train(docs.coalesce(1)), zl.train(docs.repartition(7))
    assert one.languages == many.languages and one.dictionaries == many.dictionaries and one.scale == many.scale
    assert all(0 < len(d) <= zl.DICTIONARY for d in one.dictionaries)


def test_language_edges(spark, monkeypatch):
    kinds = "doc_id long, text string, lang string, score string, margin int, language int, lang_pred int"
    docs = [(1, "das Haus und der Hof sind alt und gross", "de"), (2, LONG, "de"), (2, LONG, "de"),
            (3, "the house and the yard are old and large", "en"), (4, None, "de"), (5, "", "en"),
            (6, "12 34 !!", "de"), (7, "Text ohne Sprache", None), (None, "the house", "en"), (None, None, None)]
    table = spark.createDataFrame([(*d, "s", 1, 2, 3) for d in docs], kinds)
    model = zl.train(table)
    assert model.languages == ["de", "en"]
    rows = zl.identify(table, model).collect()
    assert len(rows) == len(docs) and set(rows[0].asDict()) == {"doc_id", "text", "lang", "lang_pred", "score", "margin",
                                                              "language"}
    found = {r.doc_id: r for r in rows if r.doc_id is not None}
    assert found[1].lang_pred == "de" and found[2].lang_pred == "de" and found[3].lang_pred == "en"
    assert all(found[k].lang_pred == "und" and found[k].score == 0 and found[k].language is None for k in (4, 5, 6))
    assert found[7].lang_pred in ("de", "en")
    nothing = zl.train(table.filter("lang = 'xx'"))
    assert {(r.lang_pred, r.score) for r in zl.identify(table, nothing).collect()} == {("und", 0.0)}
    single = zl.train(table.filter("lang = 'de'"))
    assert {r.lang_pred for r in zl.identify(table.filter("doc_id in (1, 3)"), single).collect()} == {"de"}
    assert zl.identify(table.limit(0), model).count() == 0
    monkeypatch.setattr(zl, "LANGUAGES", 1)
    with pytest.raises(ValueError):
        zl.train(table)


# ---------------------------------------------------------------- prefix trie
def brute_trie(rows):
    convs = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            convs[conv].append(((turn is not None, turn or 0), role or "", text or ""))
    whole = {}
    for conv, turns in convs.items():
        # equal turn numbers in these tables carry equal texts, so their order is no matter
        own = [t[1:] for t in sorted(turns)]
        base = [t[1:] for t in sorted(convs.get(conv - conv % 5, []))]
        h = zlib.crc32(str(conv).encode()) % 9
        whole[conv] = tuple(base[:h] + own[h:])
    members, kids = defaultdict(list), defaultdict(list)
    for conv, turns in whole.items():
        for d in range(len(turns) + 1):
            members[turns[:d]].append(conv)
    for node in members:
        if node:
            kids[node[:-1]].append(node)
    leaves, saved, out = {}, {}, set()
    for node in sorted(members, key=len, reverse=True):
        n = len(members[node])
        leaves[node] = sum(leaves[k] for k in kids[node]) or 1
        saved[node] = sum(saved[k] for k in kids[node]) + ((n - 1) * len(node[-1][1].encode()) if node else 0)
        ends = sorted(c for c in members[node] if len(whole[c]) == len(node))
        out.add((min(members[node]), len(node), min(members[node[:-1]]) if node else None, n, len(kids[node]),
                 leaves[node], saved[node], hashlib.sha256(",".join(map(str, ends)).encode()).hexdigest()))
    return out


def trie_rows(df):
    rows = [tuple(r) for r in df.drop("n_ends").collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


KINDS = "conv_id long, turn long, role string, text string"


def random_conversations(seed):
    rnd = random.Random(seed)
    shapes = [[(rnd.choice(["user", "assistant", None]), rnd.choice(["a", "bé", "", None, "ccc"])) for _ in range(n)]
              for n in (1, 2, 3, 9, 30)]
    rows = []
    for conv in rnd.sample(range(400), 120):
        turns = list(rnd.choice(shapes))[:rnd.randrange(1, 31)]
        if rnd.random() < 0.3:
            turns.append(("user", f"own {conv % 7}"))
        rows += [(conv, k if k or rnd.random() < 0.5 else None, *t) for k, t in enumerate(turns)]
    rnd.shuffle(rows)
    return rows


@pytest.mark.parametrize("seed, shard_rows, band", [(1, 1 << 14, 1 << 16), (2, 40, 4), (3, 7, 1)])
def test_trie_equals_brute_force(spark, seed, shard_rows, band):
    rows = random_conversations(seed)
    found = pt.prefix_trie(spark.createDataFrame(rows, KINDS), shard_rows, band)
    assert trie_rows(found) == brute_trie(rows)


def test_registered_trie_equals_brute_force(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/conversations.parquet").select(*[k.split()[0] for k in
                                                                                        KINDS.split(", ")]).collect()]
    assert trie_rows(queries.queries()["op12_prefix_trie"](spark, SF)) == brute_trie(rows)


def test_long_conversation_goes_over_tasks(spark):
    rows = [(5, k, "user", f"t{k % 3}") for k in range(3000)] + [(10, k, "user", f"t{k % 3}") for k in range(2999)]
    df = spark.createDataFrame(rows, KINDS).repartition(8)
    assert trie_rows(pt.prefix_trie(df, 1 << 14, 500)) == brute_trie(rows)


def test_trie_edges(spark):
    twice = [(1, 0, "u", "x"), (1, 0, "u", "x"), (None, 0, "u", "x"), (3, None, None, None), (3, 1, "u", "y" * 100000)]
    clash = spark.createDataFrame([(*r, 1, 2, 3) for r in twice], KINDS + ", depth int, pos int, n int")
    assert trie_rows(pt.prefix_trie(clash)) == brute_trie(twice)
    assert pt.prefix_trie(spark.createDataFrame([], KINDS)).count() == 0
    assert pt.prefix_trie(spark.createDataFrame([(None, 1, "u", "x")], KINDS)).count() == 0


def test_perfect_hash_is_minimal_and_verified():
    rnd = np.random.default_rng(5)
    a, b = rnd.integers(0, 1 << 63, 5000).astype(np.uint64), rnd.integers(0, 1 << 63, 5000).astype(np.uint64)
    table = pt.NodeTable(np.concatenate([a, a[:100]]), np.concatenate([b, b[:100]]))
    at = table.find(a, b)
    assert sorted(at.tolist()) == list(range(5000))
    assert (table.find(a + np.uint64(1), b) == -1).all()


# ---------------------------------------------------------------- spelling variants
def brute_variants(docs):
    low = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    seen = Counter()
    for doc_id, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(low)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 199 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            seen[run] += 1
    n = {w: k for w, k in seen.items() if len(w) >= 6 and k >= 5}

    def near(v, w):
        if len(v) == len(w):
            return sum(x != y for x, y in zip(v, w)) == 1
        v, w = sorted((v, w), key=len)
        return len(w) == len(v) + 1 and any(w[:k] + w[k + 1:] == v for k in range(len(w)))
    links = {w: [v for v in n if abs(len(v) - len(w)) < 2 and near(v, w)] for w in n}
    form = {}
    for w, vs in links.items():
        best = min(vs, key=lambda v: (-n[v], v), default=None)
        form[w] = best if best and n[best] >= 5 * n[w] else None
    out = set()
    for w in n:
        root = w
        while form[root]:
            root = form[root]
        out.add((w, form[w], root, n[w], len(links[w]), n[form[w]] if form[w] else None))
    return out


def variants_of(words, times):
    return [(k, " ".join(words)) for k in range(times)]


@pytest.mark.parametrize("crowd", [sv.CROWD, 2])
def test_variants_equal_all_pairs(spark, crowd):
    rnd = random.Random(11)
    docs = []
    bases = ["receive", "aaaaaaa", "étonnant", "internationale", "xyzxyzx"]
    pool = set()
    for base in bases:
        for _ in range(25):
            k, kind = rnd.randrange(len(base)), rnd.randrange(3)
            letter = rnd.choice("aeixyzé÷")
            pool.add(base[:k] + (letter if kind else "") + base[k + (kind < 2):])
        pool.add(base)
    for w in sorted(pool):
        docs += [(rnd.randrange(10 ** 6), w) for _ in range(rnd.choice([4, 5, 6, 30, 160, 900]))]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    assert {tuple(r) for r in sv.spelling_variants(df, crowd).collect()} == brute_variants(docs)


def test_registered_variants_equal_all_pairs(spark):
    docs = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    found = queries.queries()["op13_spelling_variants"](spark, SF)
    assert {tuple(r) for r in found.select("word", "form", "root", "n", "n_near", "form_n").collect()} == brute_variants(docs)


def test_variant_edges(spark):
    text = "Straßen STRASSEN straxsen " * 3
    docs = [(1, text), (1, text), (2, None), (3, ""), (None, text), (4, "kurz"), (5, LONG), (6, "a" * 50000)]
    kinds = "doc_id long, text string, word int, n string, lo int, length int"
    df = spark.createDataFrame([(*d, 1, "x", 2, 3) for d in docs], kinds)
    assert {tuple(r) for r in sv.spelling_variants(df).collect()} == brute_variants(docs)
    assert sv.spelling_variants(df.limit(0)).count() == 0
    assert sv.spelling_variants(df.filter(F.col("doc_id") == 4)).count() == 0


# ---------------------------------------------------------------- line CRF
def plain_score(model, text):
    """One text's (score, lines, bad lines), line by line in plain Python."""
    classes = [b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789", b".,;:'\"-()", b"!?", b"|", b"#$%&*@^~+=_<>{}[]/\\`"]
    rows, sizes = [], []
    for line in text.encode().split(b"\n"):
        ws = re.findall(rb"[^\x20\x09-\x0D]+", line)
        if not ws:
            continue
        k, size = len(ws), sum(map(len, ws))
        of = [sum(c in cls for c in line) for cls in classes]
        low = [w.lower() for w in ws]
        same = sum(a == b for a, b in zip(low, low[1:])) / k
        end = lambda cls: sum(w[-1] in classes[cls] for w in ws) / k
        row = [of[0] / size, of[1] / size, *(n / k for n in of[2:]), end(3), end(5),
               sum(len(w) == 1 and w[-1] in classes[4] for w in ws) / k, same, 1 - len(set(low)) / k,
               np.log1p(k) / 5, min(size / k, 30) / 10, sum(len(w) <= 3 for w in ws) / k, same ** 0.5]
        rows.append([min(v, 3.0) for v in row])
        sizes.append(size)
    if not rows:
        return 0.0, 0, 0
    none = [0.0] * len(rows[0])
    emit = []
    for t, row in enumerate(rows):
        around = row + (rows[t - 1] if t else none) + (rows[t + 1] if t + 1 < len(rows) else none) + [1.0]
        emit.append(float(((np.array(around) - model.mean) / model.scale) @ model.weight))
    w = [[1.0, np.exp(e)] for e in emit]
    m = np.exp(model.move)
    fore, back = [np.array(w[0])], [np.ones(2)]
    for t in range(1, len(w)):
        f = (fore[-1] @ m) * w[t]
        fore.append(f / f.sum())
    for t in range(len(w) - 1, 0, -1):
        b = m @ (back[0] * w[t])
        back.insert(0, b / b.sum())
    good = [float((f * b)[1] / (f * b).sum()) for f, b in zip(fore, back)]
    mean = min(max(sum(g * s for g, s in zip(good, sizes)) / sum(sizes), 1e-4), 1 - 1e-4)
    odds = np.log(mean / (1 - mean))
    return 1 / (1 + np.exp(-(model.slope * odds + model.shift))), len(rows), sum(g < 0.5 for g in good)


def test_quality_scores_equal_plain_line_by_line_scores(spark, monkeypatch):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    model = line_crf.train(docs, queries.labels_to_learn(spark, "/root/testdata/sf0.01"))
    texts = [r.text for r in docs.filter("doc_id % 7 = 0").collect()] + [
        "", "\n \n", "one", "Ating. Ating.\n\n| a | b |\n" * 400, "x\n" * 1500, "é É ß\n字字 12!\n"]
    data = np.frombuffer("".join(texts).encode(), np.uint8)
    rows = np.concatenate([[0], np.cumsum([len(t.encode()) for t in texts])])
    for size, piece in ((1 << 18, 512), (300, 5)):
        monkeypatch.setattr(line_crf, "SLICE", size)
        monkeypatch.setattr(line_crf.posterior, "__defaults__", (piece,))
        good, weight, lines = model.lines(data, rows)
        odds = line_crf.aggregate(good, weight, lines)
        for k, text in enumerate(texts):
            score, n, bad = plain_score(model, text)
            part = good[lines[k]:lines[k + 1]]
            assert len(part) == n and (part < 0.5).sum() == bad
            if n:
                assert abs(1 / (1 + np.exp(-(model.slope * odds[k] + model.shift))) - score) < 1e-6
    scored = {r.doc_id: r for r in line_crf.score(docs, model).filter("doc_id % 50 = 0").collect()}
    for r in scored.values():
        score, n, bad = plain_score(model, r.text)
        assert abs(r.score - score) < 1e-6 and (r.n_lines, r.bad_lines) == (n, bad)


def test_memory_of_many_short_lines():
    code = """if True:
        import resource, sys
        import numpy as np
        from heatgrid.llm import line_crf
        rnd = np.random.default_rng(1)
        model = line_crf.Model(np.zeros(46), np.ones(46), rnd.normal(size=46), rnd.normal(size=(2, 2)))
        data = np.frombuffer(b"ab\\n" * (2 << 20), np.uint8)
        before = resource.getrusage(resource.RUSAGE_SELF).ru_maxrss
        assert len(model.lines(data, np.array([0, len(data)]))[0]) == 2 << 20
        print((resource.getrusage(resource.RUSAGE_SELF).ru_maxrss - before) / 1024)
    """
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    out = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, cwd=root, check=True).stdout
    assert float(out) < 300


# ---------------------------------------------------------------- n-gram Jaccard join
def test_every_text_of_a_repeated_id_is_compared(spark):
    from heatgrid.llm import ngram_jaccard_join as nj
    rnd = random.Random(3)
    base = [" ".join(rnd.choice("abcdefghij") + str(rnd.randrange(30)) for _ in range(60)) for _ in range(9)]
    near = lambda t: t + " more"
    rows = [(1, base[0]), (1, base[1]), (1, base[2]), (2, near(base[1])), (3, near(base[2])), (4, base[2]),
            (5, base[3]), (5, base[4]), (6, base[4]), (7, base[5]), (7, base[6]), (8, near(base[6])), (9, base[7]),
            (10, base[8]), (10, base[8]), (5, base[0] + " x y"), (11, base[7] + " a b c"), (None, base[0]), (12, None),
            (12, base[3])]
    sets = [(i, set(zip(*(w[k:] for k in range(5))))) for i, t in rows for w in [(t or "").split()]]
    up = {i: i for i, _ in rows if i is not None}

    def root(i):
        while up[i] != i:
            i = up[i]
        return i
    for i, a in sets:
        for j, b in sets:
            if i is not None and j is not None and i != j and a and b and 100 * len(a & b) >= 80 * len(a | b):
                x, y = sorted((root(i), root(j)))
                up[y] = x
    got = nj.jaccard_components(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert len(got) == len(rows)
    assert {(r.doc_id, r.component_id) for r in got if r.doc_id is not None} == {(i, root(i)) for i in up}
    assert sorted((r.doc_id, r.n_shingles) for r in got if r.doc_id) == sorted((i, len(s)) for i, s in sets if i)
