"""Secrets in texts, by regular expressions behind a trigram inverted index.

Every rule's regex gives a Boolean query over trigrams (lower case) that each
of its matches must hold: an OR of ANDs. A task indexes the texts of its own
chunk, a bounded number of bytes, as postings of the trigrams that any query
asks for; intersecting and uniting postings leaves each rule's candidates,
which its regex then verifies. A rule without mandatory trigrams scans all
texts. Index and texts meet in the same task, so nothing is shuffled, and an
index never outlives or outgrows its chunk.
"""

from __future__ import annotations

import functools
import re
from collections.abc import Iterator
from dataclasses import dataclass
from hashlib import sha256
from itertools import product
from re import _constants as op
from re import _parser as parser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from heatgrid.llm import words


@dataclass(frozen=True)
class Rule:
    """Leftmost non-overlapping matches of ``pattern`` (bytes); those whose ``group`` is shorter than
    ``least`` are dropped. ``scan``: another pattern with the same remaining matches, for speed."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 0
    any_case: bool = False
    scan: str = ""


BASE = (
    Rule("assign", r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
         2, 12, any_case=True),
    Rule("access", r"AKIA[A-Z0-9]+", 0, 18),
    Rule("hex", r"[0-9a-f]+", 0, 16, scan=r"[0-9a-f]{16,}"),
)
MORE = (
    Rule("private_key", r"-----BEGIN [A-Z ]{0,30}PRIVATE KEY-----"),
    Rule("github", r"gh[pousr]_[A-Za-z0-9]{36}"),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("google", r"AIza[0-9A-Za-z_-]{35}"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
)
RULES = BASE + MORE
_MOST = 64                  # alternatives of one literal; beyond them a query asks for less

#: A query is a set of AND-sets of trigrams; ALL holds the empty AND-set and is true of every text.
Query = frozenset
ALL: Query = frozenset([frozenset()])


def _both(a: Query, b: Query) -> Query:
    joined = frozenset(x | y for x, y in product(a, b))
    return joined if len(joined) <= _MOST else min(a, b, key=len)


def _of_strings(strings: frozenset[str]) -> Query:
    grams = [frozenset(s[i:i + 3] for i in range(len(s) - 2)) for s in strings]
    return frozenset(grams) if all(grams) else ALL


def _walk(nodes) -> tuple[frozenset[str] | None, Query]:
    """The strings that the nodes match, if these are few, and the query that every match meets."""
    query, run, exact = ALL, frozenset([""]), True
    for kind, arg in nodes:
        some, need = _node(kind, arg)
        query = _both(query, need)
        if some is not None and len(run) * len(some) <= _MOST:
            run = frozenset(a + b for a, b in product(run, some))
        else:
            query = _both(query, _of_strings(run))
            exact, run = False, some if some is not None else frozenset([""])
    if exact:
        return run, query
    return None, _both(query, _of_strings(run))


def _node(kind, arg) -> tuple[frozenset[str] | None, Query]:
    if kind is op.LITERAL:
        return frozenset([chr(arg).lower()]), ALL
    if kind is op.IN:
        if all(k is op.LITERAL for k, _ in arg):
            return frozenset(chr(c).lower() for _, c in arg), ALL
        return None, ALL
    if kind is op.SUBPATTERN:
        return _walk(arg[-1])
    if kind is op.BRANCH:
        parts = [_walk(nodes) for nodes in arg[1]]
        if all(some is not None for some, _ in parts):
            return frozenset().union(*(some for some, _ in parts)), ALL
        need = frozenset().union(*(_both(q, ALL if some is None else _of_strings(some)) for some, q in parts))
        return None, ALL if frozenset() in need else need
    if kind in (op.MAX_REPEAT, op.MIN_REPEAT, op.POSSESSIVE_REPEAT):
        low, high, nodes = arg
        some, need = _walk(nodes)
        if (low, high) == (0, 1) and some is not None:
            return some | {""}, ALL
        if low and some is not None and low == high and len(some) ** low <= _MOST:
            return frozenset("".join(p) for p in product(some, repeat=low)), ALL
        return None, _both(need, ALL if some is None else _of_strings(some)) if low else ALL
    return None, ALL


def trigram_query(pattern: str) -> Query:
    """What every match of the regex must hold, in lower case, as an OR of ANDs of trigrams."""
    some, need = _walk(parser.parse(pattern))
    need = _both(need, _of_strings(some)) if some is not None else need
    return ALL if frozenset() in need else need


class Index:
    """Postings, by row, of the queried trigrams in a chunk of texts."""

    def __init__(self, grams: list[str]):
        self.grams = grams
        self.place = np.full(1 << 24, -1, np.int16)
        for i, g in enumerate(grams):
            a, b, c = g.encode("latin-1")
            self.place[a << 16 | b << 8 | c] = i

    def postings(self, data: np.ndarray, ends: np.ndarray) -> dict[str, np.ndarray]:
        low = words._LOWER.astype(np.int32)[data]
        found = self.place[(low[:-2] << 16) | (low[1:-1] << 8) | low[2:]] if len(low) > 2 else np.zeros(0, np.int16)
        at = np.flatnonzero(found >= 0)
        row = np.searchsorted(ends, at, "right") - 1
        pair = np.unique(found[at].astype(np.int64) << 40 | row)
        gram, row = pair >> 40, pair & ((1 << 40) - 1)
        edges = np.searchsorted(gram, np.arange(len(self.grams) + 1))
        return {g: row[edges[i]:edges[i + 1]] for i, g in enumerate(self.grams)}

    @staticmethod
    def candidates(query: Query, postings: dict[str, np.ndarray], rows: int) -> np.ndarray:
        if query == ALL:
            return np.arange(rows)
        out = [functools.reduce(lambda a, b: np.intersect1d(a, b, assume_unique=True),
                                sorted((postings[g] for g in every), key=len)) for every in query]
        return functools.reduce(np.union1d, out)


class Scanner:
    def __init__(self, rules: tuple[Rule, ...]):
        self.rules = rules
        self.queries = [trigram_query(r.pattern) for r in rules]
        self.regexes = [re.compile((r.scan or r.pattern).encode(), re.IGNORECASE if r.any_case else 0) for r in rules]
        self.index = Index(sorted({g for q in self.queries for every in q for g in every}))

    @staticmethod
    @functools.lru_cache(4)
    def of(rules: tuple[Rule, ...]) -> "Scanner":
        return Scanner(rules)

    def spans(self, data: np.ndarray, ends: np.ndarray) -> dict[int, list[tuple[int, int, int]]]:
        """Row -> (start, rule, end) in code points, for the rows of ``data`` that have any."""
        postings = self.index.postings(data, ends)
        found: dict[int, list[tuple[int, int, int]]] = {}
        for k, (rule, query, regex) in enumerate(zip(self.rules, self.queries, self.regexes)):
            for i in self.index.candidates(query, postings, len(ends) - 1).tolist():
                raw = data[ends[i]:ends[i + 1]].tobytes()
                for m in regex.finditer(raw):
                    if m.end(rule.group) - m.start(rule.group) >= rule.least:
                        found.setdefault(i, []).append((m.start(), k, m.end()))
        for i, spans in found.items():
            raw = data[ends[i]:ends[i + 1]]
            before = np.concatenate([[0], np.cumsum((raw & 0xC0) != 0x80)])     # characters before each byte
            found[i] = sorted((int(before[a]), k, int(before[b])) for a, k, b in spans)
        return found


def _scan(rules: tuple[Rule, ...], base: tuple[str, ...], column: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner.of(rules)
        kinds = [r.kind for r in rules]
        nothing = sha256(b"").hexdigest()
        for batch in batches:
            raw, ends = words.column_bytes(batch.column(column))
            for a, b in words.chunks(ends):
                data, rows = raw[ends[a]:ends[b]], ends[a:b + 1] - ends[a]
                counts = np.zeros((len(base), b - a), np.int64)
                digest, text = [nothing] * (b - a), [""] * (b - a)
                for i, spans in scanner.spans(data, rows).items():
                    named = [(kinds[k], f"{kinds[k]}:{s}:{e}") for s, k, e in spans]
                    for j, kind in enumerate(base):
                        counts[j, i] = sum(k == kind for k, _ in named)
                    digest[i] = sha256(",".join(x for k, x in named if k in base).encode()).hexdigest()
                    text[i] = ",".join(x for _, x in named)
                part = batch.slice(a, b - a).drop_columns([batch.schema.names[column]])
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, *map(pa.array, counts), pa.array(digest), pa.array(text)],
                    names=[*part.schema.names, *(f"n_{k}" for k in base), "base_sha256", "spans"])
    return run


def find_secrets(docs: DataFrame, more: tuple[Rule, ...] = MORE) -> DataFrame:
    """``docs`` without text, with n_assign, n_access, n_hex, base_sha256 and spans.

    ``spans``: ``kind:start:end`` by start, then kind as listed in the rules,
    comma-joined; in code points, the end exclusive. ``base_sha256``: of the
    same string with the base kinds only. ``more``: rules besides the base ones.
    A null or empty text has no spans. Every row gives one row; columns that
    are named like the new ones are replaced.
    """
    base = tuple(r.kind for r in BASE)
    new = [*(f"n_{k}" for k in base), "base_sha256", "spans"]
    docs = docs.drop(*new)
    fields = [T.StructField(n, T.LongType() if n.startswith("n_") else T.StringType()) for n in new]
    return docs.mapInArrow(_scan(BASE + tuple(more), base, docs.columns.index("text")),
                           T.StructType([*docs.drop("text").schema.fields, *fields]))
