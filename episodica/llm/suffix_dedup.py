"""Removal of byte strings of LENGTH bytes that occur more than once, by two-stage suffix sorting.

1. Anchors.  Of every run of LENGTH bytes the smallest GRAM-gram hash is kept (winnowing): two equal strings
   of LENGTH bytes hold the same anchor at the same place, so equal strings always meet under an anchor.
2. An aggregation leaves the anchors that occur at least twice; their documents cut out segments: what the strings
   cover whose anchor it is (every start belongs to one anchor).
3. Segments meet by anchor.  Their suffixes up to the anchor are sorted in two stages: those smaller than their
   successor directly, the others induced by scanning buckets of the first byte; then common prefixes of
   neighbours are computed, up to LENGTH bytes.  A suffix that shares LENGTH bytes with a neighbour is a repeat.
   An anchor of more than `most` segments is no single task: its segments are sorted in packs of HOT bytes, each string
   that a pack holds more than once is settled there, and of each different string one goes on.  Those that other packs
   may hold too (by a hash, which only filters) meet by it and are sorted again, so that bytes decide everywhere and a string that
   stands in every document is one row a pack.
4. Each document gets its repeated starts, merges what they cover and removes it.

Matches never cross rows; they are judged on the input, overlaps count.  Null, empty and short texts keep all; very long ones
are read in pieces that overlap.  Equal texts are told by a 128-bit hash and cut once; if there are several, all of each
occurs elsewhere.  Repeated rows are such copies too, even under one id; null ids are rows like any.  An empty table stays
empty.  Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import kernel as K
from . import store

LENGTH = 200
GRAM = 64
#: Segments that one task sorts for one anchor; those of more common ones are sorted in packs of HOT bytes.
MOST, HOT = 20_000, 1 << 20
#: Bytes of text whose anchors are found at once.
PIECE = 1 << 19


def gram_windows(data: np.ndarray, size: int) -> np.ndarray:
    """Hash of each `size` consecutive bytes (data within one piece)."""
    up, down = K.powers(len(data) + 1)
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(K._BYTE[data] * up[:-1], out=sums[1:])
    return K.mix((sums[size:] - sums[:-size]) * down[: len(data) - size + 1])


def _least(x: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each `width` consecutive values."""
    have = 1
    while have * 2 <= width:
        x = np.minimum(x[: len(x) - have], x[have:])
        have *= 2
    return np.minimum(x[: len(x) - (width - have)], x[width - have :]) if width > have else x


def anchors(data: np.ndarray, offsets: np.ndarray, length: int, gram: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(row, position, hash, first, last): the anchors of rows of at least `length` bytes, positions within the row,
    and the strings whose anchor it is: those that start at first..last.  Every start has one anchor."""
    width, found = length - gram + 1, []
    groups: list[list[tuple[int, int, int]]] = []
    room = 0
    for r in np.flatnonzero(np.diff(offsets) >= length).tolist():  # pieces overlap by length - 1 bytes
        a, end = int(offsets[r]), int(offsets[r + 1])
        while True:
            b = min(end, a + PIECE)
            if not groups or room < b - a:
                groups.append([])
                room = PIECE
            groups[-1].append((r, a, b))
            room -= b - a
            if b == end:
                break
            a = b - length + 1
    for group in groups:
        part = np.concatenate([data[a:b] for _, a, b in group])
        hashes = gram_windows(part, gram)
        low = np.uint64((1 << 24) - 1)
        least = _least((hashes & ~low) | np.arange(len(hashes), dtype=np.uint64), width)
        begin = np.r_[0, np.cumsum([b - a for _, a, b in group])]
        inside = np.zeros(len(least) + 1, np.int32)
        np.add.at(inside, begin[:-1], 1)
        np.add.at(inside, np.minimum(begin[1:] - length + 1, len(least)), -1)
        starts = np.flatnonzero(np.cumsum(inside[:-1]) > 0)
        at = (least[starts] & low).astype(np.int64)
        new = np.flatnonzero(np.r_[True, at[1:] != at[:-1]])
        first, last, at = starts[new], starts[np.r_[new[1:], len(starts)] - 1], at[new]
        piece = np.searchsorted(begin, at, side="right") - 1
        rows, froms = np.array([r for r, _, _ in group]), np.array([a for _, a, _ in group])
        move = froms[piece] - begin[piece] - offsets[rows[piece]]
        found.append((rows[piece], at + move, hashes[at], first + move, last + move))
    if not found:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    return tuple(np.concatenate(x) for x in zip(*found, strict=True))  # type: ignore[return-value]


def _words(text: np.ndarray, starts: np.ndarray, k: int, depth: int) -> np.ndarray:
    """Bytes 8k..8k+7 of each suffix as one big-endian number; beyond `depth` as 0.  (`text` has 8 bytes to spare.)"""
    eight = np.ndarray(len(text) - 7, ">u8", text, 0, (1,))
    out = eight[starts + 8 * k].astype(np.uint64)
    more = depth - 8 * k
    return out if more >= 8 else out & ~np.uint64((1 << (64 - 8 * more)) - 1)


def _string_hashes(text: np.ndarray, starts: np.ndarray, depth: int) -> np.ndarray:
    """A hash of the `depth` bytes at each start, computed piece by piece."""
    out = np.zeros(len(starts), np.uint64)
    for a in range(0, len(text), PIECE):
        b, e = np.searchsorted(starts, (a, a + PIECE))
        if b < e:
            part = gram_windows(text[a : a + PIECE + depth - 1], depth)
            out[b:e] = part[starts[b:e] - a]
    return out


def _extended(text: np.ndarray, starts: np.ndarray, depth: int) -> np.ndarray:
    """`starts` with what follows each run, up to a suffix smaller than its successor (or `depth` bytes on, where
    order no longer matters): so every run ends with a suffix of the kind that is sorted directly."""
    last = starts[np.r_[starts[1:] != starts[:-1] + 1, True]]
    rising = np.flatnonzero(text[:-1] < text[1:])
    nearest = np.r_[rising, len(text)][np.searchsorted(rising, last)]
    more = np.minimum(nearest, last + depth) - last
    row = np.repeat(np.arange(len(last)), more)
    extra = last[row] + 1 + np.arange(len(row)) - np.r_[0, np.cumsum(more)[:-1]][row]
    return np.unique(np.concatenate([starts, extra]))


def two_stage_sort(text: np.ndarray, wanted: np.ndarray, depth: int) -> np.ndarray:
    """Suffix starts in the order of their first `depth` bytes (all of which `text` must hold).

    Directly sorted are the suffixes smaller than their successor; every other suffix is put in order by its
    successor, bucket by bucket."""
    if len(wanted) < 2:
        return wanted
    text = np.concatenate([text, np.zeros(2 * depth + 10, np.uint8)])
    starts = _extended(text, wanted, depth)
    n = len(starts)
    follows = np.r_[starts[1:] == starts[:-1] + 1, False]
    now, after = text[starts], text[starts + 1]
    # type of a suffix by its first byte unlike the next: decided from the right, in runs of equal bytes
    decided = (now != after) | ~follows
    smaller = np.where(follows, now < after, True)
    nearest = np.minimum.accumulate(np.where(decided, np.arange(n), n)[::-1])[::-1]
    direct = smaller[nearest]
    # first stage
    some = np.flatnonzero(direct)
    rank = np.zeros(len(some), np.int64)
    whole = _string_hashes(text, starts[some], depth)
    active, k = np.arange(len(some)), 0
    while len(active) and 8 * k < depth:
        key = _words(text, starts[some[active]], k, depth)
        order = np.lexsort((key, rank[active]))
        a, key = active[order], key[order]
        old = rank[a]
        group = np.r_[True, old[1:] != old[:-1]]
        new = group | np.r_[True, key[1:] != key[:-1]]
        begin = np.maximum.accumulate(np.where(group, np.arange(len(a)), 0))
        rank[a] = old + np.maximum.accumulate(np.where(new, np.arange(len(a)), 0)) - begin
        # a group of equal strings (alone or by their hash) needs no more bytes
        first = np.flatnonzero(new)
        same = np.minimum.reduceat(whole[a], first) == np.maximum.reduceat(whole[a], first)
        active, k = a[~np.repeat(same, np.diff(np.r_[first, len(a)]))], k + 1
    some = some[np.argsort(rank, kind="stable")]
    # second stage: in each bucket the induced ones come first, then the directly sorted
    cut = np.searchsorted(now[some], np.arange(257))
    waiting: list[list[np.ndarray]] = [[] for _ in range(256)]
    out: list[np.ndarray] = []
    has_before = np.r_[False, follows[:-1]]
    for c in range(256):
        bucket: list[np.ndarray] = []
        induced = np.concatenate(waiting[c]) if waiting[c] else np.zeros(0, np.int64)
        while len(induced):  # a run of equal bytes induces its own bucket
            bucket.append(induced)
            back = induced[has_before[induced]] - 1
            induced = back[(now[back] == c) & ~direct[back]]
        bucket.append(some[cut[c] : cut[c + 1]])
        whole = np.concatenate(bucket)
        out.append(whole)
        back = whole[has_before[whole]] - 1
        back = back[(now[back] > c) & ~direct[back]]
        if len(back):
            order = np.argsort(now[back], kind="stable")
            back = back[order]
            for d, x in zip(np.unique(now[back]), np.split(back, np.flatnonzero(np.diff(now[back].astype(np.int64))) + 1), strict=True):
                waiting[int(d)].append(x)
        waiting[c] = []
    out_of = starts[np.concatenate(out)]
    return out_of if n == len(wanted) else out_of[np.isin(out_of, wanted)]


def common_prefixes(text: np.ndarray, order: np.ndarray, depth: int) -> np.ndarray:
    """Of each neighbouring two of `order`, the bytes they have in common, up to `depth`."""
    text = np.concatenate([text, np.zeros(depth + 8, np.uint8)])
    a, b = order[:-1], order[1:]
    common = np.zeros(len(a), np.int64)
    active = np.arange(len(a))
    for k in range(-(-depth // 8)):
        if not len(active):
            break
        x = _words(text, a[active], k, depth) ^ _words(text, b[active], k, depth)
        equal = x == 0
        rest = active[~equal]
        if len(rest):
            common[rest] = 8 * k + (63 - np.floor(np.log2(x[~equal].astype(np.float64))).clip(0, 63).astype(np.int64)) // 8
        active = active[equal]
    common[active] = depth
    return common


def equal_strings(text: np.ndarray, starts: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """The starts in the order of their strings of `depth` bytes, and the number of each one's string."""
    order = two_stage_sort(text, starts, depth)
    return order, np.cumsum(np.r_[False, common_prefixes(text, order, depth) < depth]) if len(order) else np.zeros(0, np.int64)


def repeated_starts(text: np.ndarray, starts: np.ndarray, depth: int) -> np.ndarray:
    """The starts whose string of `depth` bytes occurs at another start too."""
    order, number = equal_strings(text, starts, depth)
    return np.sort(order[np.bincount(number)[number] > 1]) if len(order) else order


def _press(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    press = zstandard.ZstdCompressor(level=3)
    for batch in it:
        z = pa.array([press.compress((t or "").encode()) for t in batch.column("text").to_pylist()], pa.binary())
        yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("doc_id", "key", "other")), z], ["doc_id", "key", "other", "z"])


def _texts(batch: pa.RecordBatch) -> list[bytes]:
    press = zstandard.ZstdDecompressor()
    return [press.decompress(z) for z in batch.column("z").to_pylist()]


def _anchored(length: int, gram: int) -> Callable:
    def run(it):
        for batch in it:
            keys = batch.column("key").to_numpy()
            data, offsets = K.column_bytes(batch.column("text"))
            for a, b in K.slices(offsets, 1 << 20):
                rows, pos, h, first, last = anchors(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a], length, gram)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(h.view(np.int64)),
                        pa.array(keys[a + rows]),
                        pa.array(pos),
                        pa.array((pos - first).astype(np.int16)),
                        pa.array((last - first).astype(np.int16))
                    ],
                    ["anchor", "key", "pos", "back", "more"]
                )

    return run


_SEGMENT = pa.schema([("anchor", pa.int64()), ("key", pa.int64()), ("other", pa.int64()), ("first", pa.int64()), ("count", pa.int64()), ("segment", pa.binary())])


def _segments(length: int, parts: int, hot: int) -> Callable:
    """Of rows (key, other, z, found), found being a document's repeated anchors: their segments, packed by the part that
    will sort them.  Those of anchors too common for a task are part -1, in packs of about `hot` bytes with a number each."""

    def run(it):
        press, size = zstandard.ZstdCompressor(level=3), [0, 0]
        rows: dict[int, list] = {}  # only of parts that have some, so that a pack costs as much as it holds, however many parts there are
        task, serial = TaskContext.get().partitionId(), 0  # type: ignore[union-attr]

        def packed(some: list[int]) -> pa.RecordBatch:
            nonlocal serial
            blobs = [
                press.compress(
                    pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows.pop(p), strict=True), _SEGMENT, strict=True)], schema=_SEGMENT).serialize()
                ) for p in some
            ]
            serial += 1
            return pa.RecordBatch.from_arrays(
                [pa.array(some, pa.int32()), pa.array([task << 32 | serial] * len(some), pa.int64()), pa.array(blobs, pa.binary())],
                ["part", "pack", "segments"]
            )

        for batch in it:
            for key, other, text, found in zip(*(batch.column(c).to_pylist() for c in ("key", "other")), _texts(batch), batch.column("found").to_pylist(), strict=True):
                for f in found:
                    first = f["pos"] - f["back"]
                    last = first + f["more"]
                    segment = text[first : last + length]
                    rows.setdefault(-1 if f["many"] else f["anchor"] % parts, []).append((f["anchor"], key, other, first, last - first + 1, segment))
                    size[f["many"]] += len(segment)
                    if size[1] > hot:
                        yield packed([-1])
                        size[1] = 0
                    if size[0] > 16 << 20:
                        yield packed(sorted(p for p in rows if p >= 0))
                        size[0] = 0
        yield packed(sorted(rows))

    return run


def _unpacked(blob: bytes) -> pa.RecordBatch:
    return pa.ipc.read_record_batch(pa.py_buffer(zstandard.decompress(blob)), _SEGMENT)


def _opened(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in it:
        for z in batch.column("segments").to_pylist():
            yield _unpacked(z)


_RUNS = "key long, other long, first long, last long"


def _runs(keys: np.ndarray, others: np.ndarray, starts: np.ndarray) -> pa.RecordBatch:
    """Starts as runs of consecutive ones."""
    order = np.lexsort((starts, others, keys))
    keys, others, starts = keys[order], others[order], starts[order]
    new = np.r_[True, (keys[1:] != keys[:-1]) | (others[1:] != others[:-1]) | (starts[1:] > starts[:-1] + 1)] if len(keys) else np.zeros(0, bool)
    first = np.flatnonzero(new)
    last = np.r_[first[1:], len(keys)] - 1 if len(first) else first
    return pa.RecordBatch.from_arrays([pa.array(keys[first]), pa.array(others[first]), pa.array(starts[first]), pa.array(starts[last])], ["key", "other", "first", "last"])


def _starts(rows: pa.Table | pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of segments: their bytes, and of each string in them where it starts there, its text (key, other) and its place in
    the text.  A text's segments overlap, so one place may stand in several; it is listed once, as a repeat needs two."""
    data, at = K.column_bytes(rows.column("segment"))
    counts, first, key, other = (rows.column(c).to_numpy() for c in ("count", "first", "key", "other"))
    row = np.repeat(np.arange(len(counts)), counts)
    starts = np.arange(len(row)) - np.r_[0, np.cumsum(counts)[:-1]][row] + at[row]
    keys, others, place = key[row], other[row], first[row] + starts - at[row]
    once = np.lexsort((place, others, keys))
    k, o, p = keys[once], others[once], place[once]
    use = np.zeros(len(row), bool)
    use[once[np.r_[True, (k[1:] != k[:-1]) | (o[1:] != o[:-1]) | (p[1:] != p[:-1])]]] = True
    return data, starts[use], keys[use], others[use], place[use]


def _solve(rows: pa.Table, length: int) -> pa.RecordBatch:
    """Repeated starts of the segments; many anchors share a sort, a string can't be taken for another's."""
    data, starts, keys, others, place = _starts(rows)
    found = np.searchsorted(starts, repeated_starts(data, starts, length))
    return _runs(keys[found], others[found], place[found])


def _sorted(length: int, at_once: int = 1 << 19) -> Callable:
    """The segments of whole parts, sorted in groups of anchors of about `at_once` bytes."""

    def run(it):
        held = list(_opened(it))
        if not held:
            return
        rows = pa.Table.from_batches(held).combine_chunks()
        del held
        anchor = rows.column("anchor").to_numpy()
        order = np.argsort(anchor, kind="stable")
        last = np.flatnonzero(np.r_[anchor[order][1:] != anchor[order][:-1], True]) + 1  # where an anchor's rows end
        size = np.r_[0, np.cumsum(pa.compute.binary_length(rows.column("segment")).to_numpy()[order])]
        a = 0
        while a < len(order):
            k = int(np.searchsorted(size[last], size[a] + at_once))
            b = int(last[min(k, len(last) - 1)])
            yield _solve(rows.take(pa.array(order[a:b])).combine_chunks(), length)
            a = b

    return run


_HOT = f"{_RUNS}, pack long, number int, h long, many boolean"


def _hot(length: int) -> Callable:
    """Of packs: the runs of starts whose string the pack holds more than once; and a row (pack, number, h, many) for each
    different string: the number of one of its starts, its hash, whether it is settled."""

    def run(it):
        for batch in it:
            for pack, blob in zip(batch.column("pack").to_pylist(), batch.column("segments").to_pylist(), strict=True):
                data, starts, keys, others, place = _starts(_unpacked(blob))
                order, number = equal_strings(data, starts, length)
                at, many = np.searchsorted(starts, order), (np.bincount(number) > 1)
                settled = at[many[number]]
                runs = _runs(keys[settled], others[settled], place[settled])
                yield pa.RecordBatch.from_arrays([*runs.columns, *(pa.nulls(runs.num_rows, t) for t in (pa.int64(), pa.int32(), pa.int64(), pa.bool_()))], _HOT_NAMES)
                one = at[np.r_[True, number[1:] != number[:-1]]] if len(number) else at
                h = _string_hashes(np.concatenate([data, np.zeros(length, np.uint8)]), starts, length)[one].view(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [
                        *(pa.nulls(len(one), pa.int64()) for _ in range(4)),
                        pa.array(np.full(len(one), pack, np.int64)),
                        pa.array(one.astype(np.int32)),
                        pa.array(h),
                        pa.array(many)
                    ],
                    _HOT_NAMES
                )

    return run


_HOT_NAMES = [c.split()[0] for c in _HOT.split(", ")]


def _strings(length: int) -> Callable:
    """Of packs and the strings wanted of each: the strings themselves with their text and place."""

    def run(it):
        for batch in it:
            for blob, wanted in zip(batch.column("segments").to_pylist(), batch.column("wanted").to_pylist(), strict=True):
                data, starts, keys, others, place = _starts(_unpacked(blob))
                at, raw = np.array([w["number"] for w in wanted], np.int64), data.tobytes()
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([w["h"] for w in wanted], pa.int64()),
                        pa.array([w["many"] for w in wanted], pa.bool_()),
                        pa.array(keys[at]),
                        pa.array(others[at]),
                        pa.array(place[at]),
                        pa.array([raw[s : s + length] for s in starts[at].tolist()], pa.binary())
                    ],
                    ["h", "many", "key", "other", "start", "string"],
                )

    return run


def _met(length: int, at_once: int = 1 << 19) -> Callable:
    """Of strings sorted by h: the starts of those that occur more than once, by a sort of about `at_once` bytes at a time.
    Where strings of one h are cut apart, one of each goes on to the next sort."""

    def run(it):
        most = max(2, at_once // length)
        held: list[pa.RecordBatch] = []

        def solve() -> tuple[pa.RecordBatch, pa.RecordBatch | None]:
            """The runs, and what the next rows of the last h are compared with."""
            rows = pa.Table.from_batches(held).combine_chunks().to_batches()[0]
            data, at = K.column_bytes(rows.column("string"))
            order, number = equal_strings(data, at[:-1], length)
            row = np.searchsorted(at, order)
            twice = np.bincount(number)[number] > 1
            many, h = rows.column("many").to_numpy(zero_copy_only=False), rows.column("h").to_numpy()
            new = row[twice & ~many[row]]
            keys, others, starts = (rows.column(c).to_numpy()[new] for c in ("key", "other", "start"))
            many[row] |= twice
            one = row[np.r_[True, number[1:] != number[:-1]]]
            one = np.sort(one[h[one] == h[-1]])
            k = rows.schema.get_field_index("many")
            return _runs(keys, others, starts), rows.set_column(k, "many", pa.array(many)).take(pa.array(one))

        for batch in it:
            h = batch.column("h").to_numpy()
            a = 0
            while a < len(h):  # up to the end of an h, or as many as are sorted at once
                b = min(len(h), a + max(1, most - sum(x.num_rows for x in held)))
                held.append(batch.slice(a, b - a))
                a = b
                if sum(x.num_rows for x in held) >= most:
                    runs, rest = solve()
                    yield runs
                    held = [rest] if rest is not None and rest.num_rows else []
        if held:
            yield solve()[0]

    return run


def _removed(length: int) -> Callable:
    def run(it):
        for batch in it:
            rows = []
            for doc, text, runs, copies in zip(batch.column("doc_id").to_pylist(), _texts(batch), batch.column("runs").to_pylist(), batch.column("copies").to_pylist(), strict=True):
                spans: list[list[int]] = []
                if copies > 1 and len(text) >= length:  # all of it occurs elsewhere
                    spans, runs = [[0, len(text)]], None
                for r in sorted((r["first"], r["last"] + length) for r in runs or ()):
                    if spans and r[0] <= spans[-1][1]:
                        spans[-1][1] = max(spans[-1][1], r[1])
                    else:
                        spans.append(list(r))
                at, kept = 0, []
                for a, b in spans:
                    kept.append(text[at:a])
                    at = b
                rest = b"".join([*kept, text[at:]])
                rows.append((doc, len(text), len(text) - len(rest), [x for s in spans for x in s], rest))
            cols = list(zip(*rows, strict=True)) or [[]] * 5
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(cols[0], pa.int64()),
                    pa.array(cols[1], pa.int64()),
                    pa.array(cols[2], pa.int64()),
                    pa.array(cols[3], pa.list_(pa.int64())),
                    pa.array(cols[4], pa.binary())
                ],
                ["doc_id", "n_bytes", "n_removed", "spans", "kept"]
            )

    return run


def dedup(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, most: int = MOST, hot: int = HOT) -> DataFrame:
    """Per row: doc_id, n_bytes, n_removed, spans (starts and ends removed, alternating), kept (the bytes that remain)."""
    spark, both = docs.sparkSession, ["key", "other"]
    text = F.coalesce("text", F.lit(""))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text).alias("key"), F.xxhash64(F.lit(1), text).alias("other"), "text")
    packed = rows.transform(store.arrow, _press, "doc_id long, key long, other long, z binary")
    copies = store.written(
        rows.groupBy(*both).agg(
            F.count("*").alias("copies"),
            F.min(F.coalesce("doc_id", F.lit(-(1 << 63)))).alias("head"),
            F.max(F.octet_length(F.coalesce("text", F.lit("")))).alias("bytes")
        ),
        "copies"
    )
    n = store.parts(spark, copies.agg(F.sum("bytes")).first()[0] or 0)
    all_of = store.written(rows.select("key", "text").transform(store.arrow, _anchored(length, gram), "anchor long, key long, pos long, back short, more short"), "anchors")
    twice = all_of.groupBy("anchor").agg(F.count("*").alias("c"), F.min("key").alias("k"), F.max("key").alias("l"), F.min("pos").alias("p"), F.max("pos").alias("q"))
    twice = store.written(twice.where("k <> l or p <> q").select(F.col("anchor").alias("a"), (F.col("c") > most).alias("many")), "repeated")
    store.release(spark)
    found = all_of.join(twice, F.col("anchor") == F.col("a")).groupBy("key").agg(F.collect_set(F.struct("anchor", "pos", "back", "more", "many")).alias("found"))
    found = copies.join(found, "key").select(F.col("key").alias("k"), F.col("other").alias("o"), "head", "found")
    # of one row of each distinct text
    cut = packed.join(found, (F.col("key") == F.col("k")) & (F.col("other") == F.col("o")) & (F.coalesce("doc_id", F.lit(-(1 << 63))) == F.col("head"))).select(*both, "z", "found")
    cut = store.written(cut.transform(store.arrow, _segments(length, 2 * n, hot), "part int, pack long, segments binary"), "segments")
    store.forget(all_of, twice)
    store.release(spark)
    few = cut.where("part >= 0").select("part", "segments").repartition(n, "part").transform(store.arrow, _sorted(length), _RUNS)
    runs = store.written(few, "runs")
    packs = cut.where("part < 0").select("pack", "segments")
    if not packs.isEmpty():
        seen = store.written(packs.transform(store.arrow, _hot(length), _HOT), "hot")
        strings = seen.where("h is not null").select("pack", "number", "h", "many")
        again = strings.groupBy("h").agg(F.count("*").alias("c")).where("c > 1").select(F.col("h").alias("g"))
        wanted = strings.join(again, F.col("h") == F.col("g")).groupBy("pack").agg(F.collect_list(F.struct("number", "h", "many")).alias("wanted")).withColumnRenamed("pack", "of")
        strings = packs.join(wanted, F.col("pack") == F.col("of")).select("segments", "wanted").transform(
            store.arrow,
            _strings(length),
            "h long, many boolean, key long, other long, start long, string binary"
        )
        more = strings.repartition(n, "h").sortWithinPartitions("h").transform(store.arrow, _met(length), _RUNS)
        runs = runs.union(seen.where("h is null").select(*both, "first", "last")).union(store.written(more, "runs"))
    store.forget(cut)
    store.release(spark)
    spans = copies.join(
        runs.groupBy(*both).agg(F.collect_list(F.struct("first", "last")).alias("runs")),
        both,
        "left"
    ).select(F.col("key").alias("k"), F.col("other").alias("o"), "copies", "runs")
    out = packed.join(spans, (F.col("key") == F.col("k")) & (F.col("other") == F.col("o"))).select("doc_id", "z", "runs", "copies")
    return out.transform(store.arrow, _removed(length), "doc_id long, n_bytes long, n_removed long, spans array<long>, kept binary")


def report(docs: DataFrame, **options) -> DataFrame:
    out = dedup(docs, **options)
    return out.select("doc_id", "n_bytes", "n_removed", (F.size("spans") / 2).cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))
