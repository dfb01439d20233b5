"""Words and word n-grams of Arrow text columns, as 64-bit hashes in numpy.

A word is a run of bytes other than space and ``\\t \\n \\v \\f \\r``; A-Z count
as a-z. UTF-8 keeps those bytes out of every other character, so the bytes of
a column can be cut without decoding them.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

CHUNK_BYTES = 2 << 20       # texts handled at a time; one longer text is a chunk of its own
_SEGMENT = 1 << 18          # bytes hashed at a time
_BASE = 0x9E3779B97F4A7C15  # odd, so it has an inverse modulo 2**64
_INVERSE = pow(_BASE, -1, 1 << 64)

_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_LOWER = np.arange(256)
_LOWER[65:91] += 32
U = np.uint64


def mix(h: np.ndarray) -> np.ndarray:
    """Spread every input bit over all 64 (multiply and shift, twice)."""
    h = (h ^ (h >> U(30))) * U(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> U(27))) * U(0x94D049BB133111EB)
    return h ^ (h >> U(31))


_VALUE = mix(_LOWER.astype(U) + U(1))
_POWERS = [np.ones(1, U), np.ones(1, U)]


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_POWERS[0]) < n:
        for k, base in enumerate((_BASE, _INVERSE)):
            steps = np.full(n, base, U)
            steps[0] = 1
            _POWERS[k] = np.cumprod(steps, dtype=U)
    return _POWERS[0], _POWERS[1]


def column_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The column's UTF-8 bytes and its n + 1 offsets into them; null as empty."""
    column = column.cast(pa.large_string()).fill_null("")
    if column.offset:
        column = pa.concat_arrays([column])
    _, offsets, data = column.buffers()
    ends = np.frombuffer(offsets, np.int64, len(column) + 1, column.offset * 8)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw, ends


def chunks(ends: np.ndarray, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int]]:
    """Runs of whole rows with about ``limit`` bytes each."""
    first, n = 0, len(ends) - 1
    while first < n:
        last = int(np.searchsorted(ends, ends[first] + limit, "right")) - 1
        last = min(n, max(first + 1, last))
        yield first, last
        first = last


def word_spans(data: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of each word in ``data``, and the words before each row's start.

    ``rows``: the rows' offsets in ``data``, with its length at the end.
    """
    word = ~_SPACE[data]
    begin, end = word.copy(), word.copy()
    begin[1:] &= ~word[:-1]
    end[:-1] &= ~word[1:]
    inner = rows[(rows > 0) & (rows < len(data))]
    begin[inner] |= word[inner]
    end[inner - 1] |= word[inner - 1]
    starts, ends = np.flatnonzero(begin), np.flatnonzero(end) + 1
    return starts, ends, np.searchsorted(starts, rows)


def hash_spans(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of the bytes (A-Z as a-z) of each span; spans are in order and apart."""
    out = np.empty(len(starts), U)
    first = 0
    while first < len(starts):
        at = int(starts[first])
        last = max(first + 1, int(np.searchsorted(ends, at + _SEGMENT, "right")))
        part = data[at:int(ends[last - 1])]
        up, down = _powers(len(part) + 1)
        total = np.zeros(len(part) + 1, U)
        np.cumsum(_VALUE[part] * up[:len(part)], out=total[1:])
        s, e = starts[first:last] - at, ends[first:last] - at
        out[first:last] = mix((total[e] - total[s]) * down[s])
        first = last
    return out


@dataclass
class Words:
    """The words of rows ``first`` to ``last``: hashes, and each row's offsets into them."""

    first: int
    last: int
    hashes: np.ndarray
    rows: np.ndarray

    def row_of(self) -> np.ndarray:
        return np.repeat(np.arange(self.last - self.first), np.diff(self.rows))


def word_chunks(column: pa.Array, limit: int = CHUNK_BYTES) -> Iterator[Words]:
    raw, ends = column_bytes(column)
    for first, last in chunks(ends, limit):
        data, rows = raw[ends[first]:ends[last]], ends[first:last + 1] - ends[first]
        starts, stops, counts = word_spans(data, rows)
        yield Words(first, last, hash_spans(data, starts, stops), counts)


#: Bits of a shingle's hash that are kept; the rest has the row while sets are made.
SHINGLE_BITS = 48


@dataclass
class Sets:
    """The distinct shingles of rows ``first`` to ``last``, ascending in each row."""

    first: int
    last: int
    keys: np.ndarray
    rows: np.ndarray


def shingle_sets(column: pa.Array, n: int, limit: int = CHUNK_BYTES) -> Iterator[Sets]:
    """Each row's set of word n-grams; with fewer words the whole sequence is the one shingle."""
    drop, keep = U(64 - SHINGLE_BITS), U(SHINGLE_BITS)
    for w in word_chunks(column, limit):
        for a in range(0, w.last - w.first, 1 << 15):
            b = min(w.last - w.first, a + (1 << 15))
            rows = w.rows[a:b + 1]
            h, rows = w.hashes[rows[0]:rows[-1]], rows - rows[0]
            grams = np.zeros(len(h), U)
            for k in range(min(n, len(h))):
                grams[:len(h) - k] += h[k:] * U(2 * k + 3)
                grams = mix(grams)
            size = np.diff(rows)
            row = np.repeat(np.arange(b - a), size)
            whole = (rows[1:][row] - np.arange(len(h))) >= n
            keys = (grams[whole] >> drop) | (row[whole].astype(U) << keep)
            short = np.flatnonzero((size > 0) & (size < n))
            if len(short):
                own = [_sequence(h[rows[i]:rows[i + 1]]) for i in short]
                keys = np.concatenate([keys, (np.array(own, U) >> drop) | (short.astype(U) << keep)])
            keys = np.sort(keys)
            if len(keys):
                keys = keys[np.concatenate([[True], keys[1:] != keys[:-1]])]
            at = np.searchsorted(keys, np.arange(b - a + 1, dtype=U) << keep)
            yield Sets(w.first + a, w.first + b, keys & ((U(1) << keep) - U(1)), at)


def _sequence(h: np.ndarray) -> int:
    out = np.array([len(h)], U)
    for k in range(len(h)):
        out = mix(out * U(0xD6E8FEB86659FD93) + h[k:k + 1])
    return int(out[0])


def pack48(keys: np.ndarray) -> bytes:
    return keys.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :6].tobytes()


def unpack48(raw: bytes) -> np.ndarray:
    part = np.frombuffer(raw, np.uint8).reshape(-1, 6)
    out = np.zeros((len(part), 8), np.uint8)
    out[:, :6] = part
    return out.view("<u8").ravel()


def pack_ints(values: np.ndarray) -> bytes:
    """Whole numbers from 0, in as many bytes as the largest takes, compressed by byte place."""
    values = values.astype("<u8")
    width = max(1, (int(values.max()).bit_length() + 7) // 8) if len(values) else 1
    planes = np.ascontiguousarray(values.view(np.uint8).reshape(-1, 8)[:, :width].T)
    return len(values).to_bytes(6, "little") + bytes([width]) + pa.compress(planes, "zstd", asbytes=True)


def unpack_ints(raw: bytes) -> np.ndarray:
    n, width = int.from_bytes(raw[:6], "little"), raw[6]
    planes = np.frombuffer(pa.decompress(raw[7:], n * width, "zstd", asbytes=True), np.uint8).reshape(width, n)
    out = np.zeros((n, 8), np.uint8)
    out[:, :width] = planes.T
    return out.view("<u8").ravel()


def pack_sorted(keys: np.ndarray) -> bytes:
    """Ascending 64-bit keys, as their steps."""
    return pack_ints(np.diff(keys, prepend=U(0)))


def unpack_sorted(raw: bytes) -> np.ndarray:
    return np.cumsum(unpack_ints(raw), dtype=U)
