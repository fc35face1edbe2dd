"""Nearest neighbours by multi-index hashing of learned binary codes.

Codes: vectors of length 1 are centred, turned onto their principal axes and then by learned orthogonal matrices
that minimise the binarisation error; the signs are the code.  A code has about two bits a dimension (several rotations are
learned where one doesn't give as many), in 16-bit substrings.

Radius: on a bounded sample (`sample` rows with the smallest id hash, fewer if they are long) a table is learned that says
within which Hamming distance the share `recall` of the vectors of a given cosine lies.  A query begins with the k-th
best cosine c that the sample holds for it: whatever is nearer than that lies within radius(c), and so do k vectors, so
that it never finds fewer.  In tables larger than the sample a first round probes only codes that differ by about one
bit a substring; where that brings a better k-th cosine, the radius of the second round shrinks accordingly, and a
query whose radius the first round has covered is done.

Search: queries come in blocks of `block_bytes`, broadcast; each task holds some thousand vectors in a table keyed by
substring number and value.  By the pigeonhole principle, a code within radius r = m*s + a of the query (m substrings) has
one of the first a+1 substrings within s or one of the others within s-1, so probing those values retrieves every code
within r.  What lies within r is ranked by the exact cosine of the original vectors.

Components of any magnitude are measured right: rows are scaled by powers of two first.  Vectors null, empty, zero, or with null or non-finite components take no part, nor those whose length isn't the
most common one of `vectors` (the longer one on a tie).  Rows of the query's id are its own; of several queries of one id
the smallest vector (component by component) asks.  Repeated rows are candidates each.  Fewer candidates than k: all.
Null ids take no part.  No vectors or no queries: no rows.  Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import store

SAMPLE = 8192
#: Bytes of the vectors in a block of queries, and in the sample at most.
BLOCK_BYTES, SAMPLE_BYTES = 16 << 20, 64 << 20
RECALL = 0.97
#: Vectors in one table of a task.
CHUNK = 32_768
_BY_BITS = np.argsort(np.bitwise_count(np.arange(1 << 16, dtype=np.uint16)), kind="stable").astype(np.uint16)
#: How many 16-bit values have at most so many bits.
_UP_TO = np.cumsum(np.bincount(np.bitwise_count(np.arange(1 << 16, dtype=np.uint16)), minlength=17))


def usable(vectors: DataFrame) -> DataFrame:
    """(vec_id, v): vectors with finite components, not all 0, as doubles."""
    v = F.col("embedding").cast("array<double>")
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), v.alias("v"))
    fine = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return rows.where("vec_id is not null and v is not null and size(v) > 0").where(fine).where(F.exists("v", lambda x: x != 0))


def _matrix(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
        column = pa.concat_arrays(column.chunks) if isinstance(column, pa.ChunkedArray) else column
    x = column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)
    # scaled by powers of two, which changes no cosine and no bit of one, so that no square over- or underflows
    return np.ldexp(x, -np.frexp(np.abs(x).max(axis=1, initial=0.0))[1][:, None])


def _unit(x: np.ndarray) -> np.ndarray:
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Hamming distances of codes (16-bit substrings in the last axis)."""
    return np.bitwise_count(a ^ b).sum(axis=-1, dtype=np.int64)


class Codes:
    """The learned rotations, and the radius that goes with a cosine."""

    def __init__(self, x: np.ndarray, recall: float, seed: int = 0) -> None:
        rng, d = np.random.default_rng(seed), x.shape[1]
        self.bits = int(np.clip(-(-2 * d // 64) * 64, 64, 256))
        x = _unit(x)
        self.mean = x.mean(axis=0)
        _, axes = np.linalg.eigh(np.cov((x - self.mean).T, ddof=0).reshape(d, d))
        axes = axes[:, ::-1][:, : self.bits]
        v, turned = (x - self.mean) @ axes, []
        while sum(t.shape[1] for t in turned) < self.bits:
            r = np.linalg.qr(rng.normal(size=(axes.shape[1], axes.shape[1])))[0]
            for _ in range(20):
                u, _, w = np.linalg.svd(np.where(v @ r > 0, 1.0, -1.0).T @ v)
                r = w.T @ u.T
            turned.append(axes @ r)
        self.rotation = np.concatenate(turned, axis=1)[:, : self.bits]
        self._calibrate(x, recall, rng)

    def _calibrate(self, x: np.ndarray, recall: float, rng: np.random.Generator, pairs: int = 64) -> None:
        """Pairs of sampled vectors, near and far, and of sampled vectors with points on the way to others."""
        self.cosines, self.radii = np.zeros(0), np.zeros(0, np.int64)
        if len(x) < 3:
            return
        some, code = rng.permutation(len(x))[:512], self.encode(x)
        cos = x[some] @ x.T
        cos[np.arange(len(some)), some] = -2
        near = np.argpartition(-cos, min(pairs, len(x) - 2), axis=1)[:, : min(pairs, len(x) - 1)]
        other = rng.integers(0, len(x), (len(some), pairs))
        both = np.concatenate([near, other], axis=1)
        c, h = [np.take_along_axis(cos, both, axis=1).ravel()], [distances(code[some][:, None], code[both]).ravel()]
        for t in np.linspace(0, 1, 17)[1:-1]:
            way = (1 - t) * x[some] + t * x[other[:, 0]]
            fine = np.linalg.norm(way, axis=1) > 1e-9
            way = _unit(way[fine])
            c.append((way * x[some][fine]).sum(axis=1))
            h.append(distances(self.encode(way), code[some][fine]))
        c, h = np.concatenate(c), np.concatenate(h)
        use = c > -2
        order = np.argsort(c[use])
        c, h = c[use][order], h[use][order]
        parts = np.array_split(np.arange(len(c)), max(1, len(c) // 400))
        self.cosines = np.array([c[p[0]] for p in parts])
        far = np.array([np.quantile(h[p], recall, method="higher") + 1 for p in parts], np.int64)
        self.radii = np.maximum.accumulate(far[::-1])[::-1]

    def radius(self, cosines: np.ndarray) -> np.ndarray:
        """Within which distance the vectors of at least these cosines lie."""
        at = np.searchsorted(self.cosines, cosines, side="right") - 1
        return np.where(at >= 0, self.radii[np.maximum(at, 0)] if len(self.radii) else self.bits, self.bits)

    def encode(self, x: np.ndarray) -> np.ndarray:
        bits = np.packbits((_unit(x) - self.mean) @ self.rotation > 0, axis=1)
        return np.ascontiguousarray(bits).view(np.uint16)


class Index:
    """Rows of codes in a table keyed by substring number and value."""

    def __init__(self, codes: np.ndarray) -> None:
        self.codes, self.tables, self.probed = codes, [], 0
        for c in codes.T:
            order = np.argsort(c, kind="stable")
            values, first = np.unique(c[order], return_index=True)
            self.tables.append((order, values, np.append(first, len(c))))

    def within(self, code: np.ndarray, radius: int) -> np.ndarray:
        """Rows whose code is within the Hamming radius: probed by substrings, then verified.

        Values are looked up one by one, or the table's own compared where that are fewer.  `probed` counts rows retrieved."""
        m, found = len(self.tables), []
        s, a = divmod(min(int(radius), 16 * m), m)
        for t, (order, values, cuts) in enumerate(self.tables):
            reach = min(s if t <= a else s - 1, 16)
            if reach < 0:
                continue
            if _UP_TO[reach] < len(values):
                wanted = _BY_BITS[: _UP_TO[reach]] ^ code[t]
                at = np.minimum(np.searchsorted(values, wanted), len(values) - 1)
                at = at[values[at] == wanted]
            else:
                at = np.flatnonzero(np.bitwise_count(values ^ code[t]) <= reach)
            n = cuts[at + 1] - cuts[at]
            rows = order[np.repeat(cuts[at] - np.r_[0, np.cumsum(n)[:-1]], n) + np.arange(n.sum())] if len(at) else order[:0]
            if len(rows):
                self.probed += len(rows)
                found.append(rows[distances(self.codes[rows], code) <= radius])
        return np.unique(np.concatenate(found)) if found else np.zeros(0, np.int64)


def _search(shared, k: int) -> Callable:
    def solve(ids: np.ndarray, x: np.ndarray, model: Codes, query_ids: np.ndarray, q: np.ndarray, radii: np.ndarray) -> pa.RecordBatch:
        index, codes = Index(model.encode(x)), model.encode(q) if len(q) else []
        norms, lengths, out = np.linalg.norm(x, axis=1), np.linalg.norm(q, axis=1), []
        for j, query in enumerate(query_ids.tolist()):
            rows = index.within(codes[j], radii[j])
            rows = rows[ids[rows] != query]
            score = (x[rows] @ q[j]) / (norms[rows] * lengths[j])
            best = np.lexsort((ids[rows], -score))[:k]
            out.append((np.full(len(best), query), ids[rows[best]], score[best]))
        cols = [np.concatenate(c) for c in zip(*out, strict=True)] if out else [np.zeros(0, np.int64)] * 2 + [np.zeros(0)]
        return pa.RecordBatch.from_arrays([pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.int64()), pa.array(cols[2], pa.float64())], ["query_id", "vec_id", "score"])

    def run(it):
        held, n = [], 0
        for batch in it:
            held.append((batch.column("vec_id").to_numpy(), _matrix(batch.column("v"))))
            n += batch.num_rows
            if n >= CHUNK:
                yield solve(*(np.concatenate(c) for c in zip(*held, strict=True)), *shared.value)
                held, n = [], 0
        if n:
            yield solve(*(np.concatenate(c) for c in zip(*held, strict=True)), *shared.value)

    return run


def first_radii(model: Codes, query_ids: np.ndarray, q: np.ndarray, ids: np.ndarray, x: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Of each query: the k-th best cosine among the sample's rows of other ids, and a radius that holds whatever is nearer
    and those k (all bits where there aren't k)."""
    codes, mine, unit = model.encode(x), model.encode(q), _unit(x)
    least, radii = np.full(len(q), -2.0), np.full(len(q), model.bits)
    for a in range(0, len(q), 256):
        cos = _unit(q[a : a + 256]) @ unit.T
        cos[query_ids[a : a + 256, None] == ids[None]] = -2
        if len(x) < k:
            continue
        best = np.argpartition(-cos, k - 1, axis=1)[:, :k]
        c = np.take_along_axis(cos, best, axis=1).min(axis=1)
        far = distances(mine[a : a + 256, None], codes[best]).max(axis=1)
        least[a : a + 256] = c
        radii[a : a + 256] = np.where(c > -2, np.maximum(model.radius(c), far), model.bits)
    return least, radii


_FOUND = "query_id long, vec_id long, score double"


def nearest(vectors: DataFrame, queries: DataFrame, k: int = 5, sample: int = SAMPLE, block_bytes: int = BLOCK_BYTES, recall: float = RECALL) -> DataFrame:
    """(query_id, rank, vec_id, score): the k nearest found of each query.  `vectors`, `queries`: vec_id, embedding."""
    spark = vectors.sparkSession
    rows = usable(vectors)
    most = rows.groupBy(F.size("v").alias("n")).agg(F.count("*").alias("c")).orderBy(F.desc("c"), F.desc("n")).first()
    if most is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    dims, total = most.n, most.c
    rows = rows.where(F.size("v") == dims)
    asked = usable(queries).where(F.size("v") == dims).groupBy("vec_id").agg(F.min("v").alias("v"))
    sample = max(2, min(sample, SAMPLE_BYTES // (8 * dims)))
    part = rows.where(F.pmod(F.xxhash64("vec_id"), F.lit(1 << 30)) < int(min(1.0, 1.5 * sample / total) * (1 << 30))) if total > sample else rows
    fit = part.orderBy(F.xxhash64("vec_id"), "vec_id").limit(sample).toArrow()
    if not fit.num_rows:  # a few ids, all with large hashes
        fit = rows.limit(sample).toArrow()
    fit_ids, fit_rows = fit.column("vec_id").to_numpy(), _matrix(fit.column("v"))
    model = Codes(fit_rows, recall)
    near = 2 * (model.bits // 16) - 1  # what probing values that differ by one bit covers
    blocks, found = -(-asked.count() * 8 * dims // block_bytes), []

    def searched(ids: np.ndarray, q: np.ndarray, radii: np.ndarray) -> DataFrame:
        return rows.transform(store.arrow, _search(spark.sparkContext.broadcast((model, ids, q, radii)), k), _FOUND)

    for b in range(blocks):  # each block is a hash range of the queries
        mine = asked.where(F.pmod(F.xxhash64("vec_id"), F.lit(blocks)) == b).toArrow()
        if not mine.num_rows:
            continue
        ids, q = mine.column("vec_id").to_numpy(), _matrix(mine.column("v"))
        least, radii = first_radii(model, ids, q, fit_ids, fit_rows, k)
        if total > fit.num_rows and (radii > near).any():
            first = store.written(searched(ids, q, np.minimum(radii, near)), "neighbours")
            kth = first.groupBy("query_id").agg(F.get(F.sort_array(F.collect_list("score"), False), F.lit(k - 1)).alias("c")).where("c is not null").toArrow()
            better = dict(zip(kth.column("query_id").to_pylist(), kth.column("c").to_pylist(), strict=True))
            c = np.maximum(least, np.array([better.get(i, -2.0) for i in ids.tolist()]))
            radii = np.where(c > least, np.minimum(radii, np.maximum(model.radius(c), near)), radii)
            more = radii > near
            found.append(
                first.where(~F.col("query_id").isin(*ids[more].tolist())) if more.sum() <= 1000 else first.join(
                    F.broadcast(spark.createDataFrame([(i,) for i in ids[more].tolist()], "q long")),
                    F.col("query_id") == F.col("q"),
                    "left_anti"
                )
            )
            ids, q, radii = ids[more], q[more], radii[more]
        if len(ids):
            made = searched(ids, q, radii)
            found.append(store.written(made, "neighbours") if blocks > 1 else made)  # blocks don't wait for each other's executors
    if not found:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    out = found[0]
    for f in found[1:]:
        out = out.unionAll(f)
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return out.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
