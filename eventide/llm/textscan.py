"""Vectorised word and byte-window hashing over Arrow text columns.

The helpers work on one slice of a batch at a time, so that memory depends on
``SLICE_BYTES`` (or on the one text that is longer), not on the batch.
"""

from __future__ import annotations

from typing import Iterator, NamedTuple

import numpy as np
import pyarrow as pa

SLICE_BYTES = 1 << 20
_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_BASE_INV = np.uint64(pow(int(_BASE), -1, 1 << 64))
_U = np.uint64

# Word classes, by byte: any byte of a multi-byte character is 0x80 or more.
_BYTES = np.arange(256)
ALNUM_WORD = ((_BYTES >= 0x30) & (_BYTES <= 0x39)) | ((_BYTES >= 0x41) & (_BYTES <= 0x5A)) \
    | ((_BYTES >= 0x61) & (_BYTES <= 0x7A)) | (_BYTES >= 0x80)
BLANK_WORD = ~((_BYTES == 0x20) | ((_BYTES >= 0x09) & (_BYTES <= 0x0D)))

_TABLE = np.random.RandomState(20240607).randint(1, 1 << 62, 256, dtype=np.int64).astype(np.uint64) | _U(1)
EXACT = _TABLE
FOLD_AZ = _TABLE[np.where((_BYTES >= 0x41) & (_BYTES <= 0x5A), _BYTES + 32, _BYTES)]

_pow = np.ones(1, np.uint64)
_inv = np.ones(1, np.uint64)


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    global _pow, _inv
    if len(_pow) < n:
        m = max(n, SLICE_BYTES + 4096)
        ones = np.full(m - 1, _BASE)
        pw, iv = (np.concatenate(([_U(1)], np.cumprod(a, dtype=np.uint64)))
                  for a in (ones, np.full(m - 1, _BASE_INV)))
        if m > 8 * SLICE_BYTES:
            return pw, iv
        _pow, _inv = pw, iv
    return _pow, _inv


def mix64(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (bijective)."""
    x = x ^ (x >> _U(30))
    x = x * _U(0xBF58476D1CE4E5B9)
    x = x ^ (x >> _U(27))
    x = x * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def prefix_hash(data: np.ndarray, fold: np.ndarray = EXACT) -> tuple[np.ndarray, np.ndarray]:
    """H and inverse powers with hash(data[a:b]) = (H[b] - H[a]) * inv[a]."""
    pw, iv = _powers(len(data) + 1)
    h = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(fold[data] * pw[: len(data)], out=h[1:], dtype=np.uint64)
    return h, iv


def range_hash(data: np.ndarray, start: np.ndarray, end: np.ndarray, fold: np.ndarray) -> np.ndarray:
    """64-bit hash of data[start:end] for ranges in ascending order."""
    out = np.empty(len(start), np.uint64)
    i = 0
    while i < len(start):
        a = start[i]
        j = max(i + 1, int(np.searchsorted(start, a + SLICE_BYTES)))
        h, iv = prefix_hash(data[a:end[j - 1]], fold)
        b, e = start[i:j] - a, end[i:j] - a
        out[i:j] = mix64((h[e] - h[b]) * iv[b] + (e - b).astype(np.uint64))
        i = j
    return out


class Slice(NamedTuple):
    """Consecutive rows of a batch, their bytes joined by line ends."""

    first: int              # row in the batch
    rows: int
    data: np.ndarray        # uint8
    begin: np.ndarray       # first byte of each row's text
    end: np.ndarray         # end byte of each row's text


def slices(texts: pa.Array, limit: int = SLICE_BYTES) -> Iterator[Slice]:
    """Cut a text column (null: empty) into slices of at most ``limit`` bytes,
    or one longer text."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    raw = texts.cast(pa.large_binary()).fill_null(b"")
    offs = np.frombuffer(raw.buffers()[1], np.int64)[raw.offset: raw.offset + len(raw) + 1]
    buf = raw.buffers()[2]
    data = np.frombuffer(buf, np.uint8) if buf is not None and buf.size else np.zeros(0, np.uint8)
    i, n = 0, len(raw)
    while i < n:
        j = max(i + 1, int(np.searchsorted(offs, offs[i] + limit, "right")) - 1)
        j = min(j, n)
        lens = np.diff(offs[i:j + 1])
        if j == i + 1:
            out = data[offs[i]:offs[j]]
            begin = np.zeros(1, np.int64)
        else:
            out = np.insert(data[offs[i]:offs[j]], offs[i + 1:j] - offs[i], 10)
            begin = offs[i:j] - offs[i] + np.arange(j - i)
        yield Slice(i, j - i, out, begin, begin + lens)
        i = j


class Words(NamedTuple):
    start: np.ndarray       # byte offsets in the slice
    end: np.ndarray
    row: np.ndarray         # row in the slice
    hash: np.ndarray        # uint64
    first: np.ndarray       # per row: its first word; one entry more at the end


def words(s: Slice, word_class: np.ndarray, fold: np.ndarray = FOLD_AZ) -> Words:
    """All maximal runs of ``word_class`` bytes, with a 64-bit hash each."""
    edge = np.diff(np.concatenate(([0], word_class[s.data].view(np.int8), [0])))
    start, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    out = range_hash(s.data, start, end, fold)
    first = np.searchsorted(start, np.concatenate((s.begin, [len(s.data) + 1])))
    row = np.repeat(np.arange(s.rows), np.diff(first))
    return Words(start, end, row, out, first)


def shingles(w: Words, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(first word, hash) of every run of ``size`` words inside one row."""
    n = len(w.hash) - size + 1
    if n <= 0:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    h = np.full(n, _U(size))
    for k in range(size):
        h = mix64(h * _U(0xD1342543DE82EF95) + w.hash[k:k + n])
    at = np.flatnonzero(w.row[:n] == w.row[size - 1:size - 1 + n])
    return at, h[at]


def planes(x: np.ndarray) -> bytes:
    """Bytes of equal weight side by side: high ones are mostly 0 and compress."""
    return np.ascontiguousarray(x.view(np.uint8).reshape(len(x), x.itemsize).T).tobytes()


def from_planes(raw: bytes, dtype) -> np.ndarray:
    size = np.dtype(dtype).itemsize
    return np.ascontiguousarray(np.frombuffer(raw, np.uint8).reshape(size, -1).T).view(dtype).ravel()
