"""Exact n-gram Jaccard self-join by filtered prefix lists; near duplicates and their components.

A document's set holds its distinct word shingles.  The steps:

1. Equal sets are one class, found by an aggregation on a 128-bit set fingerprint; its smallest id stands for it.
2. Each document indexes a prefix of its set, rarest shingles first, under its fingerprint, so that equal sets are
   one entry.  The order comes from a count-min sketch of fixed size; any common order is exact, the sketch only
   makes prefixes selective.
3. An index list falls into blocks of entries of equal size and position, and is skipped block by block: a block stays only
   if a partner of compatible size exists and the smaller of the two has the shingle within its index prefix.  A
   list's members form the family of its smallest id, so every pair that could link meets in some family.  Lists that may
   be long (the sketch never counts too low) take an aggregation and a join, which Spark can split; the others are packed.
4. Within a family the exact overlaps with one pivot are computed first.  A set is then compared only with sets that
   aren't already connected to it, whose sizes allow a link, and whose distance to the pivot does (triangle inequality
   of the Jaccard distance).  Its overlaps are derived from the known ones of a set X connected to it: X's overlap, less
   the shingles only X has, more those only it has; where the number of these shows that nothing can link, nothing is counted.
5. A family of more than `chunk` shingles is dealt to chunks, each with the pivot.  Sets that got connected to the pivot
   need no comparison with each other; only the others meet the members of all chunks, in tasks of their own.  So a
   family of near copies of one text is compared in time and space proportional to its size.
6. Each task emits a spanning forest of true links, never its pairs; components follow from these.

Null and empty texts have no set and link with nothing.  Fewer words than a shingle: the whole sequence is one.  Very long texts
are read in pieces between words.  Ids should be unique: a repeated id's different texts are told apart by their sets, but
are one node; repeated rows are equal sets.  A row without id takes the component of its equal texts, else null.  An empty table
stays empty.  Extra columns are ignored by `near_duplicates` and kept by `keep_one`, whatever their names.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import kernel as K
from . import store
from .components import components

SHINGLE = 4
#: Jaccard similarity from which two sets link, in percent.
PERCENT = 85
#: Counters of the sketch: DEPTH rows of 2**WIDTH.
WIDTH, DEPTH = 22, 2
#: Index lists that may be longer than this are built by a join instead of in one task.
LONG = 500_000
#: Shingles of a family's sets that are compared in one task, about.
CHUNK = 1 << 20
#: Classes that hold more than one of so many rows are looked up by a broadcast.
LARGE = 1000
#: Families of several chunks up to which a row for each is broadcast.
FEW = 100_000


def shingle_sets(data: np.ndarray, offsets: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, hash) of each row's distinct shingles, ordered by row, then hash."""
    starts, _, hashes = K.words(data, K.NOT_SPACE, offsets)
    bounds = K.rows_of(starts, offsets)
    at, found = K.windows_in_rows(hashes, bounds, size)
    rows = np.searchsorted(bounds, at, side="right") - 1
    counts = np.diff(bounds)
    for length in range(1, size):  # shorter texts
        if len(short := np.flatnonzero(counts == length)):
            whole = hashes[bounds[short]].copy()
            for k in range(1, length):
                whole = whole * K._Q + hashes[bounds[short] + k]
            rows, found = np.concatenate([rows, short]), np.concatenate([found, K.mix(whole + np.uint64(length))])
    order = np.lexsort((found, rows))
    rows, found = rows[order], found[order]
    new = np.ones(len(rows), bool)
    new[1:] = (rows[1:] != rows[:-1]) | (found[1:] != found[:-1])
    return rows[new], found[new]


def _sets(column, size: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """For slices of a text column: first row, bounds of the rows' sets, hashes."""
    data, offsets = K.column_bytes(column)
    for a, b in K.slices(offsets):
        rows, found = shingle_sets(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a], size)
        yield a, np.searchsorted(rows, np.arange(b - a + 1)), found


def _fingerprint(bounds: np.ndarray, found: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two 64-bit sums over each row's set, the same for equal sets."""
    out = []
    for x in (K.mix(found), K.mix(found ^ np.uint64(0x5851F42D4C957F2D))):
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(x, dtype=np.uint64)])
        out.append((sums[bounds[1:]] - sums[bounds[:-1]]).view(np.int64))
    return out[0], out[1]


def _fingerprints(size: int) -> Callable:
    def run(it):
        for batch in it:
            n, f1, f2 = (np.zeros(batch.num_rows, np.int64) for _ in range(3))
            for a, bounds, found in _sets(batch.column("text"), size):
                b = a + len(bounds) - 1
                n[a:b] = np.diff(bounds)
                f1[a:b], f2[a:b] = _fingerprint(bounds, found)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(n), pa.array(f1), pa.array(f2)], ["doc_id", "n", "f1", "f2"])

    return run


def _press(it):
    press = zstandard.ZstdCompressor(level=3)
    for batch in it:
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array([press.compress((t or "").encode()) for t in batch.column("text").to_pylist()], pa.binary())], ["doc_id", "z"])


def _unpacked(batch: pa.RecordBatch) -> Iterator[tuple[pa.RecordBatch, pa.Array]]:
    """Slices of about 4 MB of text, with their texts."""
    press, rows, a, size = zstandard.ZstdDecompressor(), [], 0, 0
    for r, z in enumerate(batch.column("z").to_pylist()):
        rows.append(press.decompress(z))
        size += len(rows[-1])
        if size > 4 << 20 or r + 1 == batch.num_rows:
            yield batch.slice(a, r + 1 - a), pa.array(rows, pa.binary())
            rows, a, size = [], r + 1, 0


def _slots(found: np.ndarray, row: int) -> np.ndarray:
    return ((found * np.uint64(0x9E3779B97F4A7C15 + 2 * row)) >> np.uint64(64 - WIDTH)).astype(np.int64)


_PIECE = 1 << 16


def _capped(x: np.ndarray) -> np.ndarray:
    """Counts as the sketch keeps them: what is too many for 32 bits stays the largest."""
    return np.minimum(x, np.int64(0xFFFFFFFF)).astype(np.uint32)


def _sketch(size: int) -> Callable:
    def run(it):
        table = np.zeros((DEPTH, 1 << WIDTH), np.uint32)
        for batch in it:
            for _, _, found in _sets(batch.column("text"), size):
                for row in range(DEPTH):
                    slots, n = np.unique(_slots(found, row), return_counts=True)
                    table[row, slots] = _capped(table[row, slots].astype(np.int64) + n)
        flat = table.reshape(-1, _PIECE)
        for k in np.flatnonzero(flat.any(axis=1)):
            planes = np.ascontiguousarray(flat[k].view(np.uint8).reshape(-1, 4).T)
            yield pa.RecordBatch.from_arrays([pa.array([k], pa.int64()), pa.array([zstandard.compress(planes.tobytes(), 3)], pa.binary())], ["piece", "counts"])

    return run


def _read_piece(x: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(zstandard.decompress(x), np.uint8).reshape(4, -1).T).view(np.uint32).ravel()


def _add(it):
    total: dict[int, np.ndarray] = {}
    for batch in it:
        for k, x in zip(batch.column("piece").to_pylist(), batch.column("counts").to_pylist(), strict=True):
            y = _read_piece(x)
            total[k] = _capped(total[k].astype(np.int64) + y) if k in total else y
    yield pa.RecordBatch.from_arrays(
        [
            pa.array(list(total), pa.int64()),
            pa.array([zstandard.compress(np.ascontiguousarray(x.view(np.uint8).reshape(-1, 4).T).tobytes(), 3) for x in total.values()], pa.binary())
        ],
        ["piece", "counts"]
    )


def frequencies(rows: DataFrame, size: int) -> np.ndarray:
    """The sketch of all shingles' document frequencies, of fixed size."""
    made = rows.select("text").transform(store.arrow, _sketch(size), "piece long, counts binary")
    table = np.zeros(((DEPTH << WIDTH) // _PIECE, _PIECE), np.uint32)
    for k, x in made.repartition(min(store.parts(rows.sparkSession), len(table)), "piece").transform(store.arrow, _add, "piece long, counts binary").collect():
        table[k] = _read_piece(x)
    return table.reshape(DEPTH, -1)


_ENTRY = np.dtype([("token", "<i8"), ("id", "<i8"), ("n", "<i4"), ("pos", "<i4")])


def _prefixes(size: int, percent: int, shared, parts: int, long: int) -> Callable:
    """Prefix entries, packed by part; entries of equal sets within some megabytes of text are one."""

    def run(it):
        table = shared.value
        for batch in it:
            made: list[np.ndarray] = []
            counts: list[np.ndarray] = []
            for _, bounds, found in _sets(batch.column("text"), size):
                often = np.minimum.reduce([table[row][_slots(found, row)] for row in range(DEPTH)])
                n = np.diff(bounds)
                rows = np.repeat(np.arange(len(n)), n)
                order = np.lexsort((found, often, rows))
                pos = np.arange(len(found)) - bounds[rows]
                keep = pos < n[rows] - (percent * n[rows] + 99) // 100 + 1
                e = np.zeros(int(keep.sum()), _ENTRY)
                e["token"], e["id"], e["n"], e["pos"] = found[order][keep].view(np.int64), _fingerprint(bounds, found)[0][rows[keep]], n[rows[keep]], pos[keep]
                made.append(e)
                counts.append(often[order][keep])
            if not made:
                continue
            e, often = np.concatenate(made), np.concatenate(counts)
            part_of = np.where(often > long, -1, ((e["token"].view(np.uint64) >> np.uint64(20)) % np.uint64(parts)).astype(np.int64))
            order = np.lexsort((e["id"], e["token"], part_of))
            e, part_of = e[order], part_of[order]
            new = np.r_[True, (e["token"][1:] != e["token"][:-1]) | (e["id"][1:] != e["id"][:-1])] if len(e) else np.zeros(0, bool)
            e, part_of = e[new], part_of[new]
            first = np.flatnonzero(np.r_[True, part_of[1:] != part_of[:-1]]) if len(e) else np.zeros(0, int)
            yield pa.RecordBatch.from_arrays(
                [pa.array(part_of[first], pa.int64()), pa.array([x.tobytes() for x in np.split(e, first[1:])] if len(e) else [], pa.binary())],
                ["part", "entries"]
            )

    return run


def _compatible(token: np.ndarray, n: np.ndarray, pos: np.ndarray, count: np.ndarray, percent: int) -> np.ndarray:
    """Of blocks of `count` entries, sorted by token, size and position: which have a partner that sizes and positions allow."""
    if not len(token):
        return np.zeros(0, bool)
    n = n.astype(np.int64)
    early = pos <= n - -(-2 * percent * n // (100 + percent))  # the smaller of two linked sets has the shingle this early
    group = np.cumsum(np.r_[True, token[1:] != token[:-1]])
    after = np.r_[(group[1:] == group[:-1]) & (n[:-1] * 100 >= percent * n[1:]), False] | (count > 1)
    last = np.maximum.accumulate(np.where(early, np.arange(len(n)), -1))
    last = np.r_[-1, last[:-1]]
    before = (last >= 0) & (group[last] == group) & (n[last] * 100 >= percent * n)
    return (early & after) | before


def _changes(*columns: np.ndarray) -> np.ndarray:
    """Where a row differs from the one before."""
    out = np.ones(len(columns[0]), bool)
    if len(out):
        out[1:] = np.any([c[1:] != c[:-1] for c in columns], axis=0)
    return out


def _families(percent: int) -> Callable:
    def run(it):
        """All entries of a partition's parts; each part has the whole lists of its shingles."""
        held = [np.frombuffer(x, _ENTRY) for batch in it for x in batch.column("entries").to_pylist()]
        e = np.concatenate(held) if held else np.zeros(0, _ENTRY)
        del held
        e = e[np.lexsort((e["id"], e["pos"], e["n"], e["token"]))]
        e = e[_changes(*(e[c] for c in ("token", "n", "pos", "id")))]  # equal sets of different places
        first = np.flatnonzero(_changes(e["token"], e["n"], e["pos"]))
        count = np.diff(np.r_[first, len(e)])
        e = e[np.repeat(_compatible(e["token"][first], e["n"][first], e["pos"][first], count, percent), count)]
        first = np.flatnonzero(_changes(e["token"]))
        count = np.diff(np.r_[first, len(e)])
        family = np.repeat(np.minimum.reduceat(e["id"], first), count) if len(e) else e["id"]
        some = np.repeat(count > 1, count)
        family, member = family[some], e["id"][some]
        order = np.lexsort((member, family))
        family, member = family[order], member[order]
        new = _changes(family, member)
        yield pa.RecordBatch.from_arrays([pa.array(family[new]), pa.array(member[new])], ["family", "id"])

    return run


def _entries(it):
    for batch in it:
        for x in batch.column("entries").to_pylist():
            e = np.frombuffer(x, _ENTRY)
            yield pa.RecordBatch.from_arrays([pa.array(e[c]) for c in ("token", "id", "n", "pos")], ["token", "id", "n", "pos"])


def family_members(rows: DataFrame, size: int, percent: int, n: int, long: int = LONG) -> DataFrame:
    """(family, id): families of sets, by their first fingerprints, such that every two linked sets are in one family.
    The index is dealt to `n` tasks."""
    spark = rows.sparkSession
    table = frequencies(rows, size)
    lengthy = bool((table > long).any(axis=1).all())  # else the sketch proves that no list is that long
    shared = spark.sparkContext.broadcast(table)
    made = rows.select("text").transform(store.arrow, _prefixes(size, percent, shared, 4 * n, long), "part long, entries binary")
    packed = made.where("part >= 0").repartition(n, "part").transform(store.arrow, _families(percent), "family long, id long")
    if lengthy:
        entries = made.where("part < 0").transform(store.arrow, _entries, "token long, id long, n int, pos int").distinct()
        packed = packed.union(_long_lists(store.written(entries, "entries"), percent))
    return packed.distinct()


def _long_lists(entries: DataFrame, percent: int) -> DataFrame:
    """(family, id) of entries (token, id, n, pos) by aggregations and a join: the blocks are skipped as in `_compatible`,
    and only blocks, of which a list has few, stand in one place."""
    blocks = entries.groupBy("token", "n", "pos").agg(F.count("*").alias("c"), F.min("id").alias("least"))
    w, n = Window.partitionBy("token").orderBy("n", "pos"), F.col("n").cast("long")
    early = F.col("pos") <= n - F.ceil(F.lit(2) * percent * n / (100 + percent))
    after = (F.col("c") > 1) | F.coalesce(n * 100 >= F.lead(n).over(w) * percent, F.lit(False))
    smaller = F.last(F.when(early, n), ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, -1))
    stay = blocks.withColumn("stays", (early & after) | F.coalesce(smaller * 100 >= percent * n, F.lit(False))).where("stays")
    lists = stay.groupBy("token").agg(F.min("least").alias("family"), F.sum("c").alias("all")).where("all > 1")
    found = stay.select("token", "n", "pos").join(lists.select("token", "family"), "token")
    return entries.join(found, ["token", "n", "pos"]).select("family", "id")


class _Overlaps:
    """How many shingles each of a family's sets shares with one of them: counted from the shingles' lists of sets, or derived
    from the known overlaps of another one by the shingles in which the two differ."""

    KEEP = 64

    def __init__(self, bounds: np.ndarray, found: np.ndarray) -> None:
        vocabulary, self.codes = np.unique(found, return_inverse=True)
        self.bounds, self.m = bounds, len(bounds) - 1
        by = np.argsort(self.codes, kind="stable")
        self.sets = np.repeat(np.arange(self.m), np.diff(bounds))[by]
        self.cuts = np.searchsorted(self.codes[by], np.arange(len(vocabulary) + 1))
        self.known: dict[int, np.ndarray] = {}

    def of(self, x: int) -> np.ndarray:
        return self.codes[self.bounds[x] : self.bounds[x + 1]]

    def count(self, codes: np.ndarray) -> np.ndarray:
        n = self.cuts[codes + 1] - self.cuts[codes]
        at = np.repeat(self.cuts[codes] - np.r_[0, np.cumsum(n)[:-1]], n) + np.arange(n.sum())
        return np.bincount(self.sets[at], minlength=self.m)

    def keep(self, x: int, common: np.ndarray) -> np.ndarray:
        if len(self.known) >= self.KEEP:
            del self.known[next(iter(self.known))]
        self.known[x] = common
        return common

    def differences(self, x: int, base: int) -> tuple[np.ndarray, np.ndarray]:
        """The shingles that only x has, and those that only `base` has."""
        a, b = self.of(x), self.of(base)
        return np.setdiff1d(a, b, assume_unique=True), np.setdiff1d(b, a, assume_unique=True)


def family_links(
    ids: np.ndarray, bounds: np.ndarray, found: np.ndarray, percent: int, pivot: int | None = None, side: np.ndarray | None = None, together: np.ndarray | None = None,
    distance: np.ndarray | None = None
) -> tuple[np.ndarray, np.ndarray]:
    """(component, distance to the pivot) of each of a family's sets; components are numbered by a member.

    Pairs of members of one `side` are another task's; members `together` are known to be connected; `distance`: to a
    pivot that isn't among them, instead of to member `pivot`."""
    m, n, label = len(ids), np.diff(bounds), np.arange(len(ids))
    fits = lambda x, others, common: 100 * common >= percent * (n[x] + n[others] - common)
    if m == 2 and side is None:
        common = len(np.intersect1d(found[: bounds[1]], found[bounds[1] :], assume_unique=True))
        if fits(0, 1, common):
            label[1] = 0
        return label, np.where(np.arange(2) == (pivot or 0), 0.0, 1 - common / max(1, n.sum() - common))
    if together is not None and together.any():
        label[together] = np.flatnonzero(together)[0]
    overlaps, everyone, far = _Overlaps(bounds, found), np.arange(m), 1 - percent / 100 + 1e-9
    answered: dict[int, int] = {}  # component -> a member whose overlaps are known

    def join(x: int, others: np.ndarray) -> None:
        roots = np.unique(np.append(label[others], label[x]))
        label[np.isin(label, roots)] = roots[0]
        answered.update({int(roots[0]): answered[r] for r in roots.tolist() if r in answered})

    if distance is None:
        pivot = pivot or 0
        common = overlaps.keep(pivot, overlaps.count(overlaps.of(pivot)))
        distance = 1 - common / np.maximum(n[pivot] + n - common, 1)
        answered[pivot] = pivot
        join(pivot, everyone[fits(pivot, everyone, common)])
    for x in np.argsort(ids, kind="stable").tolist():
        if x == pivot:
            continue
        rest = (label != label[x]) & (np.abs(distance - distance[x]) <= far) & (100 * np.minimum(n, n[x]) >= percent * np.maximum(n, n[x]))
        if side is not None:
            rest &= side != side[x]
        rest = np.flatnonzero(rest)
        if not len(rest):
            continue
        base = answered.get(int(label[x]), -1)
        if base in overlaps.known:
            mine, other = overlaps.differences(x, base)
            known = overlaps.known[base]
            rest = rest[fits(x, rest, known[rest] + len(mine))]  # no more than these can be common
            if not len(rest):
                continue
            common = known + overlaps.count(mine) - overlaps.count(other)
        else:
            common = overlaps.count(overlaps.of(x))
        overlaps.keep(x, common)
        answered[int(label[x])] = x
        near = rest[fits(x, rest, common[rest])]
        if len(near):
            join(x, near)
    return label, distance


_KEY = ("family", "i", "j")
_LINKED = "a long, b long, family long, chunk int, near boolean, far double, n long"


def _link(size: int, percent: int, second: bool) -> Callable:
    """Rows (family, i, j, id, z, pivot, side, near, far, several) sorted by the first three, a task's rows each: links (a, b), and for
    members of families in several chunks (family, chunk, a, near, far, n): whether they are connected to the pivot."""
    names = [c.split()[0] for c in _LINKED.split(", ")]

    def solve(rows: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        whole = pa.Table.from_batches(rows).combine_chunks().to_batches()[0]
        get = lambda c: whole.column(c).to_numpy(zero_copy_only=False)
        ids, key = get("id"), [get(c) for c in _KEY]
        first = np.flatnonzero(_changes(*key))
        sets, sizes = [], []
        for _, texts in _unpacked(whole):
            for _, bounds, found in _sets(texts, size):
                sets.append(found)
                sizes.append(np.diff(bounds))
        found, bounds = np.concatenate(sets), np.r_[0, np.cumsum(np.concatenate(sizes))]
        pivots, several, side, near, far = (get(c) for c in ("pivot", "several", "side", "near", "far"))
        a_of, b_of, state = [], [], []
        for a, b in zip(first, np.r_[first[1:], len(ids)], strict=True):
            if b - a < 2:
                continue
            part = slice(a, b)
            inner = (ids[part], bounds[a : b + 1] - bounds[a], found[bounds[a] : bounds[b]], percent)
            if second:
                label, _ = family_links(*inner, side=side[part], together=near[part] & (side[part] == 2), distance=far[part])
            else:
                pivot = int(np.argmax(pivots[part]))
                label, apart = family_links(*inner, pivot=pivot)
                if several[a]:
                    keep = ~pivots[part]
                    state.append(
                        (
                            np.full(keep.sum(), key[0][a]), np.full(keep.sum(), key[1][a]), ids[part][keep], (label == label[pivot])[keep], apart[keep],
                            np.diff(bounds[a : b + 1])[keep]
                        )
                    )
            order = np.lexsort((ids[part], label))
            least = np.flatnonzero(_changes(label[order]))
            head = np.repeat(ids[part][order][least], np.diff(np.r_[least, b - a]))
            other = ids[part][order] != head
            a_of.append(ids[part][order][other])
            b_of.append(head[other])
        a_of, b_of = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in (a_of, b_of))
        none = [pa.nulls(len(a_of), t) for t in (pa.int64(), pa.int32(), pa.bool_(), pa.float64(), pa.int64())]
        yield pa.RecordBatch.from_arrays([pa.array(a_of), pa.array(b_of), *none], names)
        for family, chunk, member, is_near, apart, n in state:
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(member), pa.nulls(len(member), pa.int64()), pa.array(family), pa.array(chunk.astype(np.int32)), pa.array(is_near), pa.array(apart),
                    pa.array(n.astype(np.int64))
                ],
                names
            )

    def run(it):
        held: list[pa.RecordBatch] = []
        for batch in it:
            if not batch.num_rows:
                continue
            last = [batch.column(c)[batch.num_rows - 1].as_py() for c in _KEY]
            same = np.all([batch.column(c).to_numpy() == x for c, x in zip(_KEY, last, strict=True)], axis=0)
            cut = int(np.argmax(same))
            if cut or (held and [held[-1].column(c)[held[-1].num_rows - 1].as_py() for c in _KEY] != last):
                if cut:
                    held.append(batch.slice(0, cut))
                yield from solve(held)
                held = []
            held.append(batch.slice(cut))
        if held:
            yield from solve(held)

    return run


def links(docs: DataFrame, size: int = SHINGLE, percent: int = PERCENT, chunk: int = CHUNK, long: int = LONG) -> tuple[DataFrame, DataFrame]:
    """(classes, edges).  classes: doc_id, n, f1, f2 of every row, f1 and f2 the same for equal sets.  edges (a, b):
    links between ids whose components are those of all links between different sets, by their smallest ids."""
    spark = docs.sparkSession
    rows = store.texts(docs.withColumn("doc_id", F.col("doc_id").cast("long")))
    classes = store.written(rows.transform(store.arrow, _fingerprints(size), "doc_id long, n long, f1 long, f2 long"), "classes")
    entries = classes.agg(F.sum(F.col("n") * (100 - percent) / 100 + 2)).first()[0] or 0
    heads = classes.where("n > 0").groupBy("f1", "f2").agg(F.min("doc_id").alias("head"), F.max("n").alias("n")).where("head is not null")
    members = family_members(rows, size, percent, store.parts(spark, entries * _ENTRY.itemsize), long)
    # from here on a set goes by its smallest id; its text is that id's
    members = store.written(members.join(heads, members.id == heads.f1).select("family", (F.col("id") == F.col("family")).alias("pivot"), F.col("head").alias("id"), "n"), "families")
    store.release(spark)
    total, large = members.agg(F.sum("n")).first()[0] or 0, members.groupBy("family").agg(F.sum("n").alias("s")).where(F.col("s") > chunk)
    large = store.written(large.select(F.col("family").alias("f"), F.ceil(F.col("s") / chunk).cast("int").alias("chunks")), "large")
    few = F.broadcast if large.count() <= FEW else (lambda df: df)
    parts = store.parts(spark, total * 8)
    packed = rows.where("doc_id is not null").transform(store.arrow, _press, "doc_id long, z binary")

    def compared(tasks: DataFrame, second: bool) -> DataFrame:
        tasks = tasks.select("family", F.col("i").cast("int"), F.col("j").cast("int"), "id", "pivot", F.col("side").cast("int"), "near", "far", "several")
        joined = packed.join(tasks.hint("merge"), packed.doc_id == tasks.id).drop("doc_id")
        done = joined.repartition(parts, *_KEY).sortWithinPartitions(*_KEY).transform(store.arrow, _link(size, percent, second), _LINKED)
        return store.written(done, "links")

    none = {"j": F.lit(0), "side": F.lit(0), "near": F.lit(False), "far": F.lit(0.0)}
    tasks = members.join(few(large), members.family == large.f, "left").withColumn("mine", F.coalesce(F.pmod(F.xxhash64("id"), "chunks"), F.lit(0)))
    tasks = tasks.withColumn(
        "i",
        F.explode(F.when(F.col("pivot") & F.col("chunks").isNotNull(), F.sequence(F.lit(0).cast("long"), F.col("chunks").cast("long") - 1)).otherwise(F.array("mine")))
    )
    first = compared(tasks.withColumns(none | {"several": F.col("chunks").isNotNull()}), False)
    edges = first.where("b is not null").select("a", "b")
    state = first.where("family is not null").select("family", "chunk", F.col("a").alias("id"), "near", "far", "n")
    apart = state.where("not near").groupBy("family").agg(F.sum("n").alias("s"))
    apart = store.written(apart.select(F.col("family").alias("g"), F.ceil(F.col("s") / chunk).cast("long").alias("groups")), "apart")
    if not apart.isEmpty():
        state = state.join(few(apart), state.family == apart.g).join(few(large), F.col("family") == F.col("f"))
        state = state.withColumn("own", F.pmod(F.xxhash64("id", F.lit(3)), "groups")).withColumns({"pivot": F.lit(False), "several": F.lit(False)})
        one = state.where("not near").withColumns({"i": F.col("own"), "side": F.lit(1), "j": F.explode(F.sequence(F.lit(0), F.col("chunks") - 1))})
        # of two that aren't near, one asks the other
        other = state.withColumns(
            {"j": F.col("chunk"), "side": F.lit(2), "i": F.explode(F.sequence(F.lit(0).cast("long"), F.when(F.col("near"), F.col("groups") - 1).otherwise(F.col("own"))))}
        )
        edges = edges.union(compared(one.unionByName(other), True).where("b is not null").select("a", "b"))
    store.forget(members, large, apart)
    store.release(spark)
    return classes, edges


def near_duplicates(docs: DataFrame, size: int = SHINGLE, percent: int = PERCENT, **options) -> DataFrame:
    """Per row: doc_id, n_shingles, component_id (the smallest id reachable by links)."""
    classes, edges = links(docs, size, percent, **options)
    roots = components(edges)
    # a class of more than this share of all rows is looked up by a broadcast of at most as many classes, the others by a join
    least = classes.count() / LARGE
    heads = classes.where("n > 0").groupBy("f1", "f2").agg(F.min("doc_id").alias("head"), (F.count("*") > least).alias("large"))
    heads = heads.join(roots, heads["head"] == roots.node, "left").select(F.col("f1").alias("g1"), F.col("f2").alias("g2"), F.coalesce("root", "head").alias("component_id"), "large")
    heads = store.written(heads, "components")
    large = F.broadcast(heads.where("large").select(F.col("g1").alias("h1"), F.col("g2").alias("h2"), F.col("component_id").alias("own")))
    rows = classes.join(large, (classes.n > 0) & (classes.f1 == large.h1) & (classes.f2 == large.h2), "left")
    found = rows.where("h1 is not null").select("doc_id", "n", F.col("own").alias("component_id"))
    rest = rows.where("h1 is null").select("doc_id", "n", "f1", "f2")
    rest = rest.join(heads.where("not large"), (F.col("n") > 0) & (F.col("f1") == F.col("g1")) & (F.col("f2") == F.col("g2")), "left").select("doc_id", "n", "component_id")
    return found.unionAll(rest).select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("component_id", "doc_id").alias("component_id"))


def keep_one(docs: DataFrame, **options) -> DataFrame:
    """One row of each group of near duplicates: the one whose id is the group's smallest.  Rows without a set stay.

    Rows without id take part: equal texts are one row, known by the text's 64-bit hash, and it stays if its group has
    no row with an id and no smaller hash."""
    columns, (kept, marked) = [f"`{c}`" for c in docs.columns], store.unused(docs.columns, "__kept", "__mark")
    lost = docs.where(F.col("doc_id").isNull())
    if lost.isEmpty():
        found = near_duplicates(docs, **options).where("doc_id = component_id").select(F.col("doc_id").alias(kept)).distinct()
        return docs.join(found, docs["doc_id"] == found[kept], "left_semi").select(*columns)
    word = F.coalesce(F.col("text").rlike(r"[^ \t-\r]"), F.lit(False))
    mark = F.xxhash64("text", F.lit(5))
    have = docs.where(F.col("doc_id").isNotNull())
    nameless = lost.where(word).withColumn(marked, mark).dropDuplicates([marked])
    rows = store.texts(have).select(F.col("doc_id").cast("long").alias("doc_id"), "text").union(lost.where(word).select(mark.alias("doc_id"), "text"))
    marks = nameless.select(marked).distinct()
    found = near_duplicates(rows, **options)
    found = found.join(marks, found["doc_id"] == marks[marked], "left")
    first = found.groupBy("component_id").agg(F.min(F.struct(F.col(marked).isNotNull().alias("nameless"), F.col("doc_id").alias("id"))).alias("first"))
    first = first.select("first.nameless", F.col("first.id").alias(kept)).distinct()
    with_id, without = first.where("not nameless").select(kept), first.where("nameless").select(kept)
    out = have.join(with_id, have["doc_id"] == with_id[kept], "left_semi").select(*columns)
    alone = nameless.join(without, nameless[marked] == without[kept], "left_semi").select(*columns)
    return out.union(alone).union(lost.where(~word).select(*columns))
