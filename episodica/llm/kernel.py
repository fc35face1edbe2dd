"""Vectorised byte-level text primitives shared by the training-data operators.

An Arrow string column already is one UTF-8 buffer plus offsets, so words, shingles and n-grams are
hashed for a whole batch of documents with a handful of numpy passes instead of a Python loop per word.

A word's hash is a 64-bit polynomial over a fixed random byte table (sum of T[b]*P**j modulo 2**64),
finished by a bit mixer.  Work arrays are bounded by SEGMENT bytes: longer texts are cut between words.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa

SEGMENT = 1 << 19
_P = np.uint64(0x9E3779B97F4A7C15)
_P_INV = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_Q = np.uint64(0xD6E8FEB86659FD93)


def mix(x: np.ndarray) -> np.ndarray:
    """Bijective finaliser of 64-bit values."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_BYTE = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xA0761D6478BD642F))
#: A-Z lower-cased, every other byte as it is.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
#: Words of all but ASCII white space.
NOT_SPACE = np.ones(256, dtype=bool)
NOT_SPACE[[0x20, *range(0x09, 0x0E)]] = False
#: Words of digits, a-z and bytes of non-ASCII characters (after lower-casing).
ALNUM = np.zeros(256, dtype=bool)
ALNUM[0x30:0x3A] = ALNUM[0x61:0x7B] = ALNUM[0x80:] = True

#: Every byte as it is.
SAME = np.arange(256, dtype=np.uint8)

_powers: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """P**j and P**-j for j < n, kept by the process."""
    if len(_powers[0]) < n:
        size = max(n, SEGMENT + 4096)
        for k, base in enumerate((_P, _P_INV)):
            step = np.full(size, base, np.uint64)
            step[0] = 1
            _powers[k] = np.multiply.accumulate(step)
    return _powers[0][:n], _powers[1][:n]


def drop_caches() -> None:
    _powers[:] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def column_bytes(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string or binary column and its int64 offsets; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
        if isinstance(column, pa.ChunkedArray):
            column = pa.concat_arrays(column.chunks) if column.num_chunks else pa.array([], column.type)
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    if column.null_count:
        column = column.fill_null(b"" if pa.types.is_binary(column.type) or pa.types.is_large_binary(column.type) else "")
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, ends, data = column.buffers()
    offsets = np.frombuffer(ends, np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    whole = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return whole[offsets[0] : offsets[-1]], offsets - offsets[0]


def slices(offsets: np.ndarray, limit: int = SEGMENT) -> Iterator[tuple[int, int]]:
    """Row ranges [a, b) of at most `limit` bytes each, or a single longer row."""
    a, n = 0, len(offsets) - 1
    while a < n:
        b = max(a + 1, int(np.searchsorted(offsets, offsets[a] + limit, side="right")) - 1)
        yield a, b
        a = b


def gram_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hash of data[start:end] for each range (data within one segment)."""
    up, down = powers(len(data) + 1)
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_BYTE[data] * up[:-1], out=sums[1:])
    return mix((sums[ends] - sums[starts]) * down[starts])


def words(data: np.ndarray, table: np.ndarray, offsets: np.ndarray | None = None, fold: np.ndarray = LOWER, trim: Callable | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and hash of each maximal run of bytes that `table` marks, each byte first replaced by
    `fold` (lower-cased); no run crosses a row's offset.  `trim` may move the ends within a piece of the bytes."""
    n, found, a = len(data), [], 0
    inner = offsets[1:-1] if offsets is not None else np.zeros(0, np.int64)
    while a < n:
        b = min(n, a + SEGMENT)
        while b < n and table[fold[data[b - 1]]] and b not in inner:  # extend to the end of a word
            more = np.flatnonzero(~table[fold[data[b : b + 4096]]])
            nxt = b + (int(more[0]) if len(more) else min(4096, n - b))
            cut = inner[(inner > b) & (inner <= nxt)]
            b = int(cut[0]) if len(cut) else nxt
            if len(more) or len(cut):
                break
        part = fold[data[a:b]]
        inside = np.zeros(len(part) + 2, bool)
        inside[1:-1] = table[part]
        cuts = inner[(inner > a) & (inner < b)] - a
        edge = inside[1:] != inside[:-1]
        begin, end = edge & inside[1:], edge & ~inside[1:]
        if len(cuts):
            both = cuts[inside[1:][cuts] & inside[:-1][cuts]]
            begin[both] = True
            end[both] = True
        s, e = np.flatnonzero(begin), np.flatnonzero(end)
        if trim is not None:
            e = trim(part, s, e)
        found.append((s + a, e + a, gram_hashes(part, s, e)))
        a = b
    if not found:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint64)
    return tuple(np.concatenate(x) for x in zip(*found, strict=True))  # type: ignore[return-value]


def rows_of(starts: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """First word of each row, plus the number of words: bounds so that row r has words bounds[r]:bounds[r+1]."""
    return np.searchsorted(starts, offsets, side="left")


def windows(hashes: np.ndarray, length: int) -> np.ndarray:
    """Hash of each `length` consecutive word hashes, for every start that fits."""
    n = len(hashes) - length + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = hashes[:n].copy()
    for k in range(1, length):
        out *= _Q
        out += hashes[k : n + k]
    return mix(out + np.uint64(length))


def windows_in_rows(hashes: np.ndarray, bounds: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Starts (word numbers) and hashes of the windows that lie within one row."""
    all_of = windows(hashes, length)
    if not len(all_of):
        return np.zeros(0, np.int64), all_of
    fits = np.zeros(len(all_of) + 1, np.int32)
    first, last = bounds[:-1], np.maximum(bounds[1:] - length + 1, bounds[:-1])
    first, last = np.minimum(first, len(all_of)), np.minimum(last, len(all_of))
    np.add.at(fits, first, 1)
    np.add.at(fits, last, -1)
    starts = np.flatnonzero(np.cumsum(fits[:-1]) > 0)
    return starts, all_of[starts]
