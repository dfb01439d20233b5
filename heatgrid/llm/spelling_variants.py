"""Spelling variants: words one edit apart, found by asymmetric q-chunks.

A word contributes two disjoint chunks, its halves. One edit touches one of
them at most, so a word that is one edit away holds the other chunk as one of
its positional grams: the first half at its own place, the second shifted by
the difference of the lengths, 0 or 1 when the chunks come from the shorter
word (of equal lengths: from the smaller). Only grams within that shift can
match, so only they are made. Candidates agree in the length and in the chunk
with its place; the rest of both words is verified by edit distance.

A key is everything outside a free segment ``[lo, hi)``, at first a half. Keys
with over ``CROWD`` rows are not compared: the same rule is used again on their
free segment, whose two halves are chunks of their own, until few words share
a key or one letter is free (the alphabet of 90 letters bounds such a group).
A pair counts at the segment with its edit's last possible place, so
it is found once and no distinct is needed.

Everything is DataFrame code. A word has a bounded number of words one edit
away, so no word's links are unbounded.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from heatgrid.llm import shared

#: Fixed values of the contract: runs, least length and occurrences, form's share, one run in 199 is damaged.
LETTERS = r"A-Za-zÀ-ÿ"
LEAST_LENGTH, LEAST_COUNT, FORM_TIMES, DAMAGE = 6, 5, 5, 199
CROWD = 256
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_KEY = ["length", "lo", "hi", "head", "tail"]


def occurrences(docs: DataFrame) -> DataFrame:
    """Each run of ``docs`` (doc_id, text) that can give a word, as ``word``.

    Null texts have none; a null doc_id counts as the empty string. Runs are
    maximal and at least ``LEAST_LENGTH`` long: shorter ones give no word.
    """
    runs = docs.select(
        F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("doc_id"),
        F.explode(F.regexp_extract_all(F.col("text").cast("string"), F.lit(f"[{LETTERS}]{{{LEAST_LENGTH},}}"),
                                       F.lit(0))).alias("run"))
    runs = runs.withColumn("run", F.translate("run", _UPPER, _LOWER))
    runs = runs.withColumn("h", F.crc32(F.concat("doc_id", F.lit(":"), "run")))
    at = F.col("h") % F.char_length("run")
    cut = F.concat(F.substring("run", F.lit(1), at.cast("int")),
                   F.substring(F.col("run"), (at + 2).cast("int"), F.char_length("run")))
    return runs.select(F.when(F.col("h") % DAMAGE == 0, cut).otherwise(F.col("run")).alias("word"))


def count_words(docs: DataFrame) -> DataFrame:
    """(word, n) of the words: long enough and frequent enough, counted over all texts."""
    return (occurrences(docs).filter(F.char_length("word") >= LEAST_LENGTH)
            .groupBy("word").agg(F.count("*").alias("n")).filter(F.col("n") >= LEAST_COUNT))


def _halves(lo: Column, hi: Column) -> Column:
    middle = F.floor((lo + hi) / 2).cast("int")
    return F.array(F.struct(lo.alias("lo"), middle.alias("hi")), F.struct(middle.alias("lo"), hi.alias("hi")))


def _keyed(rows: DataFrame) -> DataFrame:
    """``rows`` (word, n, longer, length, segment) with head and tail, what stands outside the segment.

    ``longer`` is 1 for the grams that words shorter by one are to meet; a place
    behind the segment is then shifted by one.
    """
    rows = rows.select("word", "n", "longer", "length", "segment.lo", "segment.hi")
    behind = F.col("hi") + F.col("longer")
    return rows.select("*", F.substring("word", F.lit(1), F.col("lo")).alias("head"),
                       F.substring("word", behind + 1, F.char_length("word")).alias("tail"))


def signatures(words: DataFrame) -> DataFrame:
    """Chunks (``longer`` 0) of each word and the grams (0 and 1) that shorter or equal words' chunks meet."""
    length = F.char_length("word")
    rows = (words.select("word", "n", F.explode(F.array(F.lit(0), F.lit(1))).alias("longer"))
            .withColumn("length", length - F.col("longer")).filter(F.col("length") >= LEAST_LENGTH))
    return _keyed(rows.withColumn("segment", F.explode(_halves(F.lit(0), F.col("length")))))


def _verified(rows: DataFrame) -> DataFrame:
    """Pairs (a, b, n_a, n_b) one edit apart among the rows that share a key; a is the shorter or smaller."""
    x = rows.filter("longer = 0").select(*_KEY, F.col("word").alias("a"), F.col("n").alias("n_a"))
    y = rows.select(*_KEY, "longer", F.col("word").alias("b"), F.col("n").alias("n_b"))
    mine, theirs = F.col("hi") - F.col("lo"), F.col("hi") - F.col("lo") + F.col("longer")
    start = F.col("lo") + 1
    one_edit = F.levenshtein(F.substring("a", start, mine), F.substring("b", start, theirs), 1) == 1
    here = (F.col("hi") == F.col("length")) | (F.substring("a", F.lit(1), F.col("hi"))
                                               != F.substring("b", F.lit(1), F.col("hi")))
    ordered = (F.col("longer") == 1) | (F.col("a") < F.col("b"))
    return x.join(y, _KEY).filter(ordered & here & one_edit).select("a", "b", "n_a", "n_b")


def near_pairs(stage: shared.Stage, words: DataFrame, crowd: int = CROWD) -> DataFrame:
    """All pairs of ``words`` (word, n) that differ by one inserted, deleted or replaced letter, each once."""
    rows, found, k = stage.keep("signatures-0", signatures(words)), [], 0
    while True:
        crowded = stage.keep(f"crowded-{k}", rows.groupBy(*_KEY).count()
                             .filter((F.col("count") > crowd) & (F.col("hi") - F.col("lo") > 1)).select(*_KEY))
        found.append(stage.keep(f"pairs-{k}", _verified(rows.join(crowded, _KEY, "left_anti"))))
        if crowded.limit(1).count() == 0:
            stage.drop(f"signatures-{k}")
            break
        finer = rows.join(crowded, _KEY, "left_semi").select(
            "word", "n", "longer", "length", F.explode(_halves(F.col("lo"), F.col("hi"))).alias("segment"))
        fresh = stage.keep(f"signatures-{k + 1}", _keyed(finer))
        stage.drop(f"signatures-{k}")
        rows, k = fresh, k + 1
    pairs = found[0]
    for more in found[1:]:
        pairs = pairs.unionByName(more)
    return pairs


def _roots(stage: shared.Stage, forms: DataFrame) -> DataFrame:
    """(word, root) of the words with a form. Occurrences grow along forms, so they end;
    each round steps to the step's step."""
    step = stage.keep("root-0", forms.select("word", F.col("form").alias("root")))
    k = 0
    while True:
        on = step.select(F.col("word").alias("root"), F.col("root").alias("further"))
        fresh = stage.keep(f"root-{k + 1}", step.join(on, "root", "left").select(
            "word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved")))
        stage.drop(f"root-{k}")
        step, k = fresh.select("word", "root"), k + 1
        if fresh.filter("moved").limit(1).count() == 0:
            return step


def spelling_variants(docs: DataFrame, crowd: int = CROWD) -> DataFrame:
    """Per word of ``docs`` (doc_id, text and any others): word, form, root, n, n_near, form_n.

    ``form`` is the near word of largest n (ties: the smallest by code points)
    if that n is at least five times the word's, else null; ``root`` is the end
    of the chain of forms, the word itself without one. Null and empty texts
    have no words; repeated rows count each time; without words the result is
    empty.
    """
    stage = shared.Stage(docs.sparkSession, "spelling")
    words = stage.keep("words", count_words(docs.select("doc_id", "text")))
    pairs = near_pairs(stage, words, crowd)
    both = pairs.select(F.col("a").alias("word"), F.col("b").alias("near"), F.col("n_b").alias("n_other")).unionByName(
        pairs.select(F.col("b").alias("word"), F.col("a").alias("near"), F.col("n_a").alias("n_other")))
    best = both.groupBy("word").agg(F.count("*").alias("n_near"),
                                    F.min(F.struct((-F.col("n_other")).alias("less"), "near")).alias("best"))
    enough = -F.col("best.less") >= FORM_TIMES * F.col("n")
    judged = stage.keep("judged", words.join(best, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
        F.when(enough, F.col("best.near")).alias("form"), F.when(enough, -F.col("best.less")).alias("form_n")))
    roots = _roots(stage, judged.filter("form is not null"))
    return judged.join(roots, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n",
                                                     "n_near", "form_n")
