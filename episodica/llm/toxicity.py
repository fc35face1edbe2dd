"""Toxicity by FTRL-proximal logistic regression over hashed word n-grams and skip-grams.

A text's features are the distinct hashes of its words, word pairs and pairs that skip one word (words of a-z,
digits and non-ASCII characters, lower-cased), in BITS bits.  Training walks over a bounded sample of the
labelled rows: at most about `sample` of them, taken by a hash of the id, whichever their label, and in the hash's order
only as many as have `sample_bytes` of features together.  Per-coordinate
learning rates and L1 leave a sparse weight table of fixed maximal size, which is broadcast for scoring.

Only the text is scored.  Null and empty texts have no feature: their score is that of the bias.  Very long texts are read in
pieces between words.  An empty table stays empty.  Labels that
are null or of rows without text don't train; several labels of an id train as that many rows.  No labels at
all: every score is 0.5.  Repeated rows score alike; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import kernel as K
from . import store

BITS = 20
#: Labelled rows that train, about, and bytes of their features (4 each) that the driver takes.
SAMPLE, SAMPLE_BYTES = 12_000, 96 << 20
THRESHOLD = 0.7


def features(data: np.ndarray, offsets: np.ndarray, bits: int = BITS) -> tuple[np.ndarray, np.ndarray]:
    """(bounds, features): each row's distinct features, sorted."""
    starts, _, h = K.words(data, K.ALNUM, offsets)
    bounds = K.rows_of(starts, offsets)
    row = np.searchsorted(bounds, np.arange(len(h)), side="right") - 1
    shift = np.uint64(64 - bits)
    rows, found = [row], [h >> shift]
    for gap, salt in ((1, 0x1F83D9ABFB41BD6B), (2, 0x5BE0CD19137E2179)):
        fits = row[gap:] == row[:-gap] if len(h) > gap else np.zeros(0, bool)
        pair = K.mix(h[:-gap][fits] * np.uint64(salt) + h[gap:][fits]) if len(h) > gap else h[:0]
        rows.append(row[gap:][fits] if len(h) > gap else row[:0])
        found.append(pair >> shift)
    code = np.unique(np.concatenate(rows).astype(np.uint64) << np.uint64(bits) | np.concatenate(found))
    return np.searchsorted(code >> np.uint64(bits), np.arange(len(offsets))), (code & np.uint64((1 << bits) - 1)).astype(np.int64)


class Ftrl:
    """FTRL-proximal logistic regression on binary features; coordinate 2**bits is the bias."""

    def __init__(self, bits: int = BITS, alpha: float = 2.0, beta: float = 1.0, l1: float = 8.0, l2: float = 0.0) -> None:
        self.bias, self.alpha, self.beta, self.l1, self.l2 = 1 << bits, alpha, beta, l1, l2
        self.z, self.n = np.zeros(self.bias + 1), np.zeros(self.bias + 1)

    def weights(self, at: np.ndarray | slice) -> np.ndarray:
        z, n = self.z[at], self.n[at]
        return np.where(np.abs(z) <= self.l1, 0.0, -(z - np.sign(z) * self.l1) / ((self.beta + np.sqrt(n)) / self.alpha + self.l2))

    def learn(self, found: np.ndarray, label: int) -> None:
        at = np.append(found, self.bias)
        w = self.weights(at)
        g = 1 / (1 + np.exp(-np.clip(w.sum(), -35, 35))) - label
        n = self.n[at]
        self.z[at] += g - (np.sqrt(n + g * g) - np.sqrt(n)) / self.alpha * w
        self.n[at] += g * g


def _featurised(bits: int) -> Callable:
    def run(it):
        for batch in store.batches(it, K.SEGMENT):
            bounds, found = features(*K.column_bytes(batch.column("text")), bits)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("order"),
                    batch.column("label"),
                    pa.array([found[a:b].astype(np.int32).tobytes() for a, b in zip(bounds[:-1], bounds[1:], strict=True)], pa.binary())
                ],
                ["order", "label", "found"]
            )

    return run


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, sample_bytes: int = SAMPLE_BYTES, bits: int = BITS, rounds: int = 4) -> tuple[np.ndarray, np.ndarray]:
    """(features, weights) that aren't 0, the bias last.  `labels`: doc_id, label (0 or 1), already without held-out rows."""
    marked = labels.select(F.col("doc_id").cast("long").alias("id"), F.col("label").cast("int").alias("label")).where("id is not null and label in (0, 1)")
    share = min(1.0, sample / max(1, marked.count()))
    chosen = marked.withColumn("order", F.xxhash64("id", F.lit(17))).where(F.pmod("order", F.lit(1 << 30)) < int(share * (1 << 30)))
    rows = store.texts(docs).join(F.broadcast(chosen), F.col("doc_id").cast("long") == F.col("id")).where("text is not null").select("order", "label", "text")
    made = store.written(rows.transform(store.arrow, _featurised(bits), "order long, label int, found binary"), "features")
    upto = F.sum(F.length("found")).over(Window.orderBy("order", "label"))  # over `sample` rows, about
    last = made.select("order", upto.alias("upto")).where(F.col("upto") > sample_bytes).agg(F.min("order")).first()[0]
    table = (made if last is None else made.where(F.col("order") < last)).toArrow()
    store.forget(made)
    held = [(o, y, np.frombuffer(x, np.int32)) for o, y, x in zip(*(table.column(c).to_pylist() for c in ("order", "label", "found")), strict=True)]
    held.sort(key=lambda r: (r[0], r[1], r[2].tobytes()))
    model = Ftrl(bits)
    for k in range(rounds if held else 0):
        for r in np.random.default_rng(k).permutation(len(held)):
            model.learn(held[r][2], held[r][1])
    w = model.weights(slice(None))
    at = np.append(np.flatnonzero(w[:-1]), model.bias)
    return at, w[at]


def _scored(shared, bits: int) -> Callable:
    def run(it):
        at, w = shared.value
        table = np.zeros((1 << bits) + 1)
        table[at] = w
        for batch in store.batches(it, K.SEGMENT):
            bounds, found = features(*K.column_bytes(batch.column("text")), bits)
            sums = np.r_[0.0, np.cumsum(table[found])]
            score = 1 / (1 + np.exp(-np.clip(sums[bounds[1:]] - sums[bounds[:-1]] + table[-1], -35, 35)))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("held_out"), pa.array(score)], ["doc_id", "held_out", "score"])

    return run


def score(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD, bits: int = BITS, **options) -> DataFrame:
    """Per row: doc_id, held_out, score, predicted.  `labels`: doc_id, toxic; rows with crc32(doc_id as text) mod 3 = 1 don't train."""
    held = store.remainder("doc_id", 3) == 1
    model = train(docs, labels.where(~held).select("doc_id", F.col("toxic").alias("label")), bits=bits, **options)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), held.alias("held_out"), "text").transform(
        store.arrow,
        _scored(shared, bits),
        "doc_id long, held_out boolean, score double"
    )
    return rows.withColumn("predicted", F.when(F.col("score") >= threshold, 1).otherwise(0))
