"""Merkle manifest of a dataset: one root, a proof for each row, and rows of today folded against the proofs of then.

A row's leaf is the sha256 of its columns (`-` if null, else the UTF-8 byte count, `:` and the value), digests being
lowercase hex throughout.  Per group (source) leaves ascend by key; while several nodes remain, every FAN consecutive
ones become the digest of their concatenation.  What remains is the group's subroot; subroots, ordered by group, give
the root in the same way.

How it scales: leaves are made where the texts lie, and only they (about 100 bytes a row) are sorted by ranges of (group,
key), numbered and dealt in blocks of FAN**k consecutive rows, with k such that blocks number at most `most`.  A task
reduces a block k levels.  The block nodes are the small upper tree: the driver builds it and broadcasts it, and each
block's task cuts its suffix path from it, to finish the proofs of its rows and to fold them.  Where the groups themselves
number more than `most`, their subroots become the leaves of a second tree of the same kind, whose paths are joined to the
blocks.

Null keys come first (and are never tampered with in the report), null groups are one group before all others.  Repeated
keys ascend by leaf; wholly equal rows have equal leaves, and which of them comes first changes nothing but which of their
proofs a row gets.  Null and empty texts have different leaves.  Very long texts are hashed whole in the JVM.  An empty
table has no rows.  Extra columns are ignored, whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.index import running_totals
from . import store

#: Consecutive nodes that become one.
FAN = 16
#: Nodes the driver takes, at most, from the blocks (32 bytes each) and again from the groups.
MOST = 1 << 16
#: Levels within a block, at least.
LEVELS = 2
#: Bytes of group names broadcast to number the rows' groups, and how many groups, at most; else a plain join.
FEW, FEW_BYTES = 50_000, 16 << 20
COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")
_WIDE = 64  # characters of a digest
_BLOCK = "no long, block long, n long, rows binary, seen binary, nulls binary, ids binary, top string, alone string"
_ROW = "doc_id long, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean, path binary"


def _sha(data: bytes) -> bytes:
    return hashlib.sha256(data).hexdigest().encode()


def leaf(values: list[Column]) -> Column:
    """The digest of a row's values."""
    each = []
    for v in values:
        v = v.cast("string")
        each.append(F.coalesce(F.concat(F.octet_length(v).cast("string"), F.lit(":"), v), F.lit("-")))
    return F.sha2(F.concat(*each).cast("binary"), 256)


def above(nodes: bytes) -> bytes:
    """The next level of nodes (hex digests, one after another)."""
    step = FAN * _WIDE
    return b"".join(_sha(nodes[a : a + step]) for a in range(0, len(nodes), step))


def levels(nodes: bytes, rounds: int | None = None) -> list[bytes]:
    """The nodes and the levels above them: `rounds` of them, or until one node remains."""
    out = [nodes]
    while len(out) <= rounds if rounds is not None else len(out[-1]) > _WIDE:
        out.append(above(out[-1]))
    return out


def path(tree: list[bytes], at: int, rounds: int) -> list[tuple[bytes, bytes]]:
    """Siblings on the left and on the right of node `at` and of the nodes above it, for the first `rounds` levels."""
    out = []
    for level in tree[:rounds]:
        first, k = at // FAN * FAN * _WIDE, at % FAN * _WIDE
        run = level[first : first + FAN * _WIDE]
        out.append((run[:k], run[k + _WIDE :]))
        at //= FAN
    return out


def packed(steps: list[tuple[bytes, bytes]]) -> bytes:
    """A path as bytes: of each level the numbers of left and right siblings, then their digests."""
    return b"".join(bytes((len(a) // _WIDE, len(b) // _WIDE)) + bytes.fromhex((a + b).decode()) for a, b in steps)


def unpacked(data: bytes) -> list[tuple[bytes, bytes]]:
    out, at = [], 0
    while at < len(data):
        a, b = data[at], data[at + 1]
        both = data[at + 2 : at + 2 + 32 * (a + b)].hex().encode()
        out.append((both[: a * _WIDE], both[a * _WIDE :]))
        at += 2 + 32 * (a + b)
    return out


def folded(digest: bytes, steps: list[tuple[bytes, bytes]]) -> bytes:
    """The root to which a leaf and its siblings lead."""
    for a, b in steps:
        digest = _sha(a + digest + b)
    return digest


class Upper:
    """The driver's tree: above the blocks of each group that has several, and above the subroots (unless those are too many)."""

    def __init__(self, rounds: int) -> None:
        self.rounds, self.groups, self.top = rounds, {}, None

    def add(self, no: int, tops: bytes) -> bytes:
        self.groups[no] = levels(tops)
        return self.groups[no][-1]

    def steps(self, no: int, block: int) -> list[tuple[bytes, bytes]]:
        """From a block's node to the subroot."""
        tree = self.groups.get(no)
        return path(tree, block, len(tree) - 1) if tree else []

    def last(self, no: int) -> list[tuple[bytes, bytes]]:
        """From a subroot to the root."""
        return path(self.top, no, len(self.top) - 1)


def _pack(rounds: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Rows (no, block, doc_id, leaf, seen), sorted, to a row a block."""

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in store.by_group(it, "no", "block"):
            nodes = b"".join(x.as_py() for x in rows.column("leaf")).hex().encode()
            seen = b"".join(x.as_py() for x in rows.column("seen"))
            ids = rows.column("doc_id")
            null = ids.is_null().to_numpy(zero_copy_only=False) if ids.null_count else np.zeros(rows.num_rows, bool)
            top, alone = levels(nodes, rounds)[-1], levels(nodes)[-1]
            values = [
                rows.column("no")[0].as_py(), rows.column("block")[0].as_py(), rows.num_rows, bytes.fromhex(nodes.decode()), seen, null.tobytes(),
                ids.fill_null(0).to_numpy().astype(np.int64).tobytes(), top.decode(), alone.decode()
            ]
            kinds = [pa.int64()] * 3 + [pa.binary()] * 4 + [pa.string()] * 2
            yield pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(values, kinds, strict=True)], [c.split()[0] for c in _BLOCK.split(", ")])

    return run


def _prove(shared, keep: bool) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Rows of blocks to rows of documents: proofs finished and folded.  `keep`: with the path itself."""
    names = [c.split()[0] for c in _ROW.split(", ")][: None if keep else -1]

    def one(upper: Upper, no: int, block: int, ids: list, nodes: bytes, seen: bytes, last: bytes | None) -> pa.RecordBatch:
        lone = no not in upper.groups
        tree = levels(nodes, None if lone else upper.rounds)
        within = len(tree) - 1
        to_sub = upper.steps(no, block)
        rest = to_sub + (upper.last(no) if last is None else unpacked(last))
        suffix = b"".join(a + b for a, b in rest)
        sub = upper.groups[no][-1] if not lone else tree[-1]
        root = folded(sub, rest[len(to_sub) :])
        out: list[list] = [[] for _ in range(5)]
        for k in range(len(ids)):
            steps, x = path(tree, k, within), _WIDE * k
            proof = hashlib.sha256(b"".join(a + b for a, b in steps))
            proof.update(suffix)
            to = folded(seen[x : x + _WIDE], steps + rest)
            row = (nodes[x : x + _WIDE].decode(), proof.hexdigest(), to.decode(), to == root, packed(steps + rest) if keep else None)
            for column, value in zip(out, row, strict=True):
                column.append(value)
        n = len(ids)
        columns = [
            pa.array(ids, pa.int64()), pa.array(out[0]), pa.array([sub.decode()] * n), pa.array([root.decode()] * n), pa.array(out[1]), pa.array(out[2]),
            pa.array(out[3], pa.bool_()), pa.array(out[4], pa.binary())
        ]
        return pa.RecordBatch.from_arrays(columns[: len(names)], names)

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        upper: Upper = shared.value
        for batch in it:
            for r in batch.to_pylist():
                null = np.frombuffer(r["nulls"], bool)
                ids = [None if z else i for i, z in zip(np.frombuffer(r["ids"], np.int64).tolist(), null.tolist(), strict=True)]
                done = one(upper, r["no"], r["block"], ids, r["rows"].hex().encode(), r["seen"].hex().encode(), r.get("last"))
                for a in range(0, done.num_rows, 1000 if keep else 10_000):
                    yield done.slice(a, 1000 if keep else 10_000)

    return run


def _numbered(rows: DataFrame) -> tuple[DataFrame, int]:
    """Rows (source, doc_id, leaf, seen) with their group's number and their place in it; and the number of groups."""
    sizes = store.written(rows.groupBy("source").agg(F.count("*").alias("size")), "sizes")
    groups, names = sizes.agg(F.count("*"), F.sum(F.octet_length("source"))).first()
    starts = running_totals(sizes, ["source"], {"no": None, "start": F.col("size")}).select(F.col("source").alias("s"), "no", "start")
    if groups <= FEW and (names or 0) <= FEW_BYTES:
        starts = F.broadcast(starts)
    order = ["source", "doc_id", "leaf", "tie"]  # the tie deals equal rows to several tasks
    placed = running_totals(rows, order, {"place": None}).join(starts, F.col("source").eqNullSafe(F.col("s")))
    return placed.select("no", (F.col("place") - F.col("start")).alias("place"), "doc_id", "leaf", "seen"), groups


def _blocks(placed: DataFrame, rounds: int) -> DataFrame:
    dealt = placed.withColumn("block", F.floor(F.col("place") / F.lit(FAN**rounds))).repartition("no", "block").sortWithinPartitions("no", "block", "place")
    return store.written(dealt.select("no", "block", "doc_id", "leaf", "seen").transform(store.arrow, _pack(rounds), _BLOCK), "blocks")


def _upper(blocks: DataFrame, rounds: int) -> tuple[Upper, dict[int, bytes]]:
    """The trees above the blocks of groups that have several, and those groups' subroots."""
    upper, several = Upper(rounds), blocks.groupBy("no").agg(F.max("block").alias("b")).where("b > 0").select("no")
    tops = blocks.select("no", "block", "top").join(several, "no", "left_semi").toArrow()  # at most 2 rows for FAN**rounds documents
    order = np.lexsort((tops.column("block").to_numpy(), tops.column("no").to_numpy())) if tops.num_rows else np.zeros(0, int)
    no, top = tops.column("no").to_numpy()[order], np.array(tops.column("top").to_pylist(), object)[order]
    cuts = np.flatnonzero(np.diff(no, prepend=-1))
    subs = {int(no[a]): upper.add(int(no[a]), "".join(top[a:b]).encode()) for a, b in zip(cuts, [*cuts[1:], len(no)], strict=False)}
    return upper, subs


def _rounds(n: int, least: int, most: int) -> int:
    """Levels in a block so that blocks of that many leaves number at most `most`."""
    while n > most * FAN**least:
        least += 1
    return least


def proofs(docs: DataFrame, seen: dict[str, Column] | None = None, columns: tuple[str, ...] = COLUMNS, keep: bool = False, most: int = MOST, least: int = LEVELS) -> DataFrame:
    """Per row: doc_id, leaf, subroot, root, proof_sha256 (of its siblings, level by level, left to right), folded_root (from
    the leaf of the row as `seen`, that is with these columns in place of its own) and verified; `keep`: and its path."""
    spark = docs.sparkSession
    values = [F.col(c) for c in columns]
    now = leaf([(seen or {}).get(c, F.col(c)) for c in columns]) if seen else leaf(values)
    made = docs.select("source", F.col("doc_id").cast("long").alias("doc_id"), F.unhex(leaf(values)).alias("leaf"), F.unhex(now).alias("seen"), F.monotonically_increasing_id().alias("tie"))
    leaves = store.written(made, "leaves")
    placed, groups = _numbered(leaves)
    if not groups:
        return spark.createDataFrame([], ", ".join(_ROW.split(", ")[: None if keep else -1]))
    rounds = _rounds(leaves.count(), least, most)
    blocks = _blocks(placed, rounds)
    upper, subs = _upper(blocks, rounds)
    roots = blocks.where("block = 0").select("no", "alone")
    if groups <= most:  # one subroot a group
        found = roots.toArrow().to_pydict()
        alone = dict(zip(found["no"], found["alone"], strict=True))
        upper.top = levels(b"".join(subs.get(k) or alone[k].encode() for k in range(groups)))
    else:
        blocks = _joined(blocks, roots, subs, groups, most, least)
    schema = ", ".join(_ROW.split(", ")[: None if keep else -1])
    return blocks.transform(store.arrow, _prove(spark.sparkContext.broadcast(upper), keep), schema)


def _joined(blocks: DataFrame, roots: DataFrame, subs: dict[int, bytes], groups: int, most: int, least: int) -> DataFrame:
    """`blocks` with the path from their subroot to the root, as the subroots' own tree has it."""
    spark = blocks.sparkSession
    rows = [(k, v.decode()) for k, v in subs.items()] or [(-1, "")]
    large = spark.createDataFrame(rows, "large long, sub string")  # at most `most` groups have several blocks
    leaves = roots.join(F.broadcast(large), F.col("no") == F.col("large"), "left").select(
        F.lit(0).cast("long").alias("no"), F.col("no").alias("place"), F.col("no").alias("doc_id"), F.unhex(F.coalesce("sub", "alone")).alias("leaf")
    )
    rounds = _rounds(groups, least, most)
    above_ = _blocks(leaves.withColumn("seen", F.col("leaf")), rounds)
    upper, sub = _upper(above_, rounds)
    upper.top = [next(iter(sub.values()))] if sub else levels(above_.first()["alone"].encode())  # one group: its subroot is the root
    paths = above_.transform(store.arrow, _prove(spark.sparkContext.broadcast(upper), True), _ROW)
    paths = store.written(paths.select(F.col("doc_id").alias("of"), F.col("path").alias("last")), "paths")
    return blocks.join(paths, F.col("no") == F.col("of")).drop("of")


def verify(docs: DataFrame, kept: DataFrame, columns: tuple[str, ...] = COLUMNS) -> DataFrame:
    """(doc_id, verified): whether a row of today folds to the root with the path kept for its id (`proofs` with keep=True,
    written somewhere).  A row without a path isn't verified; of a repeated id one path that fits is enough."""
    now = docs.select(F.col("doc_id").cast("long").alias("doc_id"), leaf([F.col(c) for c in columns]).alias("now"), F.monotonically_increasing_id().alias("row"))
    held = kept.select(F.col("doc_id").alias("of"), "root", "path")

    def fold(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in it:
            rows = zip(*(batch.column(c).to_pylist() for c in ("now", "root", "path")), strict=True)
            fits = [p is not None and folded(n.encode(), unpacked(p)).decode() == r for n, r, p in rows]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("row"), pa.array(fits, pa.bool_())], ["doc_id", "row", "verified"])

    both = now.join(held, F.col("doc_id").eqNullSafe(F.col("of")), "left").select("doc_id", "row", "now", "root", "path")
    out = both.transform(store.arrow, fold, "doc_id long, row long, verified boolean")
    return out.groupBy("row", "doc_id").agg(F.max("verified").alias("verified")).drop("row")


def lowered(docs: DataFrame, every: int = 5) -> Column:
    """A text as the tampering of the report leaves it: A-Z lower-cased where `every` divides the id's crc32."""
    some = F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(every)) == 0
    return F.when(some, F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")).otherwise(F.col("text"))


def report(docs: DataFrame, **options) -> DataFrame:
    """Proofs of the rows as they are, folded from the leaves of the rows as tampered with."""
    docs = docs.select(*COLUMNS)
    return proofs(docs, {"text": lowered(docs)}, **options)
