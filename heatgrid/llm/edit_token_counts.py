"""Token counts that follow edits without encoding the text anew.

A document's pre-tokens (the pieces that a byte BPE's pattern cuts a text
into; no token spans two) are the leaves of a segment tree, ``LEAF`` of them to
a node of the lowest level, whose sums are characters and tokens. An edit is
located by characters, going down from the root; pre-tokens are cut anew from
shortly before the edit until a cut falls on an old one behind it, only those
are encoded, and the sums on the way to the root are updated.

Cutting may start at any old cut: the pattern does not look back, and a
pre-token's match looks at most ``AHEAD`` characters beyond its end, so cuts
that far before the edit are not moved by it, and after a cut on the same
remaining text all further cuts are the same.

Trees can be kept: ``build_trees`` gives a table with each text's tree, and
``apply_edits`` the same table after a batch of edits, in which only what the
edits touch is cut and encoded. Writing that table is the caller's.
"""

from __future__ import annotations

import base64
import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from heatgrid.llm.words import pack_ints, unpack_ints

LEAF = 64
AHEAD = 3
KEPT = 500_000              # pre-tokens whose number of tokens a worker keeps
EDIT = "array<struct<seq: long, start: long, length: long, replacement: string>>"


class Counter:
    """Tokens of pre-tokens, by the ranks file of a byte BPE."""

    def __init__(self, path: str, pattern: str):
        import regex
        import tiktoken
        with open(path, "rb") as file:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
        self.cut = regex.compile(pattern)
        self.encode = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks,
                                        special_tokens={}).encode_ordinary
        self.known: dict[str, int] = {}

    @staticmethod
    @functools.lru_cache(2)
    def of(path: str, pattern: str) -> "Counter":
        return Counter(path, pattern)

    def tokens(self, pieces: list[str]) -> list[int]:
        found = list(map(self.known.get, pieces))
        if None in found:
            if len(self.known) > KEPT:
                self.known.clear()
            for i, n in enumerate(found):
                if n is None:
                    piece = pieces[i]
                    n = self.known.get(piece)
                    if n is None:
                        n = self.known[piece] = len(self.encode(piece))
                    found[i] = n
        return found


class Tree:
    """The pre-tokens of one text, in leaves of a segment tree with sums of characters and tokens."""

    def __init__(self, counter: Counter, text: str):
        pieces = counter.cut.findall(text)
        self._hold(counter, text, list(map(len, pieces)), counter.tokens(pieces))

    @classmethod
    def load(cls, counter: Counter, text: str, raw: bytes | None) -> "Tree":
        """The tree that ``pack`` gave, without cutting or encoding; a new one if it isn't this text's length."""
        chars, tokens = unpack_ints(raw).reshape(2, -1).tolist() if raw else ([], [])
        if raw is None or sum(chars) != len(text):
            return cls(counter, text)
        tree = cls.__new__(cls)
        tree._hold(counter, text, chars, tokens)
        return tree

    def pack(self) -> bytes:
        return pack_ints(np.array([[n for leaf in self.leaves for n in leaf[k]] for k in (0, 1)], np.uint64).ravel())

    def _hold(self, counter: Counter, text: str, chars: list[int], tokens: list[int]) -> None:
        self.counter, self.text, self.encoded = counter, text, 0
        self._build([(chars[i:i + LEAF], tokens[i:i + LEAF]) for i in range(0, len(chars), LEAF)])

    def _build(self, leaves: list[tuple[list[int], list[int]]]) -> None:
        self.leaves = leaves or [([], [])]
        self.first = 1 << (len(self.leaves) - 1).bit_length()
        self.sums = [(0, 0)] * (2 * self.first)
        for i, (c, t) in enumerate(self.leaves):
            self.sums[self.first + i] = (sum(c), sum(t))
        for k in range(self.first - 1, 0, -1):
            self._add(k)

    def _add(self, k: int) -> None:
        a, b = self.sums[2 * k], self.sums[2 * k + 1]
        self.sums[k] = (a[0] + b[0], a[1] + b[1])

    @property
    def tokens(self) -> int:
        return self.sums[1][1]

    def find(self, char: int) -> tuple[int, int, int]:
        """Leaf, place in it and first character of the pre-token that holds a character."""
        k, at = 1, 0
        while k < self.first:
            k *= 2
            if char >= at + self.sums[k][0]:
                at += self.sums[k][0]
                k += 1
        leaf = min(k - self.first, len(self.leaves) - 1)
        for i, n in enumerate(self.leaves[leaf][0]):
            if char < at + n:
                return leaf, i, at
            at += n
        return leaf, len(self.leaves[leaf][0]), at

    def edit(self, start: int, length: int, replacement: str) -> None:
        """Replace ``length`` characters from ``start``; both are held to the text."""
        start = max(0, min(start, len(self.text)))
        length = max(0, min(length, len(self.text) - start))
        shift, old_end = len(replacement) - length, start + length
        # a cut that starts AHEAD before the edit is the last that cannot have moved
        leaf, place, at = self.find(max(0, start - AHEAD))
        self.text = f"{self.text[:start]}{replacement}{self.text[old_end:]}"
        end_leaf, end_place, old_at = leaf, place, at
        pieces, new_at = [], at
        for m in self.counter.cut.finditer(self.text, at):
            pieces.append(m.group())
            new_at = m.end()
            if new_at - shift >= old_end:
                end_leaf, end_place, old_at = self._forward(end_leaf, end_place, old_at, new_at - shift)
                if old_at == new_at - shift:
                    break
        else:
            end_leaf, end_place = len(self.leaves) - 1, len(self.leaves[-1][0])
        self.encoded += new_at - at
        tokens = self.counter.tokens(pieces)
        chars = list(map(len, pieces))
        before, after = self.leaves[leaf], self.leaves[end_leaf]
        fresh = tuple(b[:place] + new + a[end_place:] for b, new, a in zip(before, (chars, tokens), after))
        if len(fresh[0]) > 2 * LEAF:        # grown by more than a leaf: cut it and leave out the empty ones
            parts = [tuple(x[i:i + LEAF] for x in fresh) for i in range(0, len(fresh[0]), LEAF)]
            self._build([x for x in (*self.leaves[:leaf], *parts, *self.leaves[end_leaf + 1:]) if x[0]])
            return
        for i in range(leaf, end_leaf + 1):
            self.leaves[i] = fresh if i == leaf else ([], [])
            self.sums[self.first + i] = tuple(map(sum, self.leaves[i]))
        for i in range(leaf, end_leaf + 1):
            k = (self.first + i) // 2
            while k:
                self._add(k)
                k //= 2

    def _forward(self, leaf: int, place: int, at: int, goal: int) -> tuple[int, int, int]:
        """The first old cut at ``goal`` or after it, from an earlier one."""
        while at < goal:
            while place == len(self.leaves[leaf][0]):
                leaf, place = leaf + 1, 0
            at += self.leaves[leaf][0][place]
            place += 1
        return leaf, place, at


_NEW = "n_tokens long, edits_applied long, edited_tokens long, edited_chars long, encoded_chars long"


def _count(path: str, pattern: str, text_at: int, edits_at: int, tree_at: int | None, keep_text: bool,
           keep_tree: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = Counter.of(path, pattern)
        for batch in batches:
            for a in range(0, batch.num_rows, 512):
                part = batch.slice(a, 512)
                rows, texts, trees = [], [], []
                kept = [None] * part.num_rows if tree_at is None else part.column(tree_at).to_pylist()
                for text, edits, raw in zip(part.column(text_at).to_pylist(), part.column(edits_at).to_pylist(), kept):
                    tree = Tree.load(counter, text or "", raw)
                    before, done = tree.tokens, 0
                    edits = [e for e in edits or [] if e and e["start"] is not None]
                    for e in sorted(edits, key=lambda e: (e["seq"] is None, e["seq"] or 0, e["start"],
                                                          e["length"] or 0, e["replacement"] or "")):
                        tree.edit(e["start"], e["length"] or 0, e["replacement"] or "")
                        done += 1
                    rows.append((before, done, tree.tokens, len(tree.text), tree.encoded))
                    texts.append(tree.text)
                    if keep_tree:
                        trees.append(tree.pack())
                gone = [n for k, n in enumerate(part.schema.names) if k in (text_at, edits_at, tree_at)]
                others = part.drop_columns(gone)
                cols = [pa.array(np.array(c, np.int64)) for c in zip(*rows)]
                names = [f.split()[0] for f in _NEW.split(", ")]
                if keep_text:
                    cols, names = [*cols, pa.array(texts, pa.string())], [*names, "edited_text"]
                if keep_tree:
                    cols, names = [*cols, pa.array(trees, pa.binary())], [*names, "edited_tree"]
                yield pa.RecordBatch.from_arrays([*others.columns, *cols], names=[*others.schema.names, *names])
    return run


def with_edits(docs: DataFrame, edits: DataFrame) -> DataFrame:
    """``docs`` with a column ``edits``, from a table (doc_id, seq, start, length, replacement).

    Rows of edits without doc_id or document are left out.
    """
    edit = F.struct(*(F.col(c).cast(t).alias(c) for c, t in
                      (("seq", "long"), ("start", "long"), ("length", "long"), ("replacement", "string"))))
    of = edits.filter("doc_id is not null").groupBy("doc_id").agg(F.collect_list(edit).alias("edits"))
    return docs.drop("edits").join(of, "doc_id", "left")


def count_edited(docs: DataFrame, ranks: str, pattern: str, keep_text: bool = False, tree: str | None = None,
                 keep_tree: bool = False) -> DataFrame:
    """``docs`` without text and edits, with n_tokens, edits_applied, edited_tokens, edited_chars, encoded_chars.

    ``docs``: text, edits (array of (seq, start, length, replacement)) and any
    other columns; those named like the new ones are replaced. Edits go by seq
    (null last), equal ones by start, length and replacement; each sees the
    text that the ones before it left, in code points. ``start`` and ``length``
    are held to the text; a null length is 0, a null replacement empty, and an
    edit without start is left out. ``n_tokens``: before the edits;
    ``encoded_chars``: characters cut and encoded anew by the edits.
    ``edited_text`` and ``edited_tree`` on demand. A null text is empty. Every
    row gives one row. ``tree`` names a column with the trees kept of the texts,
    which is dropped; a row where it is null, or of another text length, gets a new one.
    """
    new = T._parse_datatype_string(_NEW + (", edited_text string" if keep_text else "")
                                   + (", edited_tree binary" if keep_tree else ""))
    docs = docs.drop(*new.names).withColumn("edits", F.col("edits").cast(EDIT))
    names = docs.columns
    tree_at = None if tree is None else names.index(tree)
    gone = ["text", "edits", *([] if tree is None else [tree])]
    return docs.mapInArrow(_count(ranks, pattern, names.index("text"), names.index("edits"), tree_at, keep_text, keep_tree),
                           T.StructType([*docs.drop(*gone).schema.fields, *new.fields]))


def _as_trees(counted: DataFrame) -> DataFrame:
    return (counted.drop("n_tokens", "edits_applied", "edited_chars").withColumnsRenamed(
        {"edited_tokens": "n_tokens", "edited_text": "text", "edited_tree": "tree"}))


def build_trees(docs: DataFrame, ranks: str, pattern: str) -> DataFrame:
    """``docs`` with each text's tree and n_tokens, as a table to keep; columns of these names are replaced.

    ``encoded_chars`` is 0 here: it counts what edits encode anew. A null text becomes empty.
    """
    bare = docs.drop("tree", "n_tokens", "edits").withColumn("edits", F.lit(None).cast(EDIT))
    return _as_trees(count_edited(bare, ranks, pattern, keep_text=True, keep_tree=True))


def apply_edits(trees: DataFrame, edits: DataFrame, ranks: str, pattern: str) -> DataFrame:
    """The table of ``build_trees`` after a batch of edits (doc_id, seq, start, length, replacement).

    Texts, trees and n_tokens are those after the edits; ``encoded_chars``:
    what this batch cut and encoded. Texts without edits keep their trees.
    """
    return _as_trees(count_edited(with_edits(trees, edits), ranks, pattern, keep_text=True, tree="tree", keep_tree=True))
