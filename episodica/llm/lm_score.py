"""Language-model scores by deleted interpolation of n-gram, ..., unigram and uniform estimates.

P(w|u,v) = l3 c(u,v,w)/c(u,v) + l2 c(v,w)/c(v) + l1 c(w)/N + l0/(V+1) for `order` 3, the default; order 2 has no l3.
The weights depend on the bucket of the count of the longest context that was seen, and come from
expectation-maximisation on deleted counts: each training token is predicted by the counts of all other training
tokens, so it is held out from its own estimate.

Counts are exact, over all training documents, and never meet in one place:

1. Documents become blocks of about BLOCK bytes in a written table: vocabulary hashes and word numbers.
2. Each block asks for its distinct words and n-grams: packed sorted 64-bit keys with the block's training counts, dealt
   to parts by key range, as many as keep a part at PART bytes.  A word as frequent as "the" is one key a block, not
   one row a token.  Words and word pairs are one step, triples another, so that one step's shuffle is gone before the next.
3. Each part sums its keys, a sub-range at a time, and answers every block; N and V are sums over the parts.
4. Blocks meet their answers.  A first pass gathers a histogram of (bucket, log ratio cells) whose size is bounded by
   its cells, and EM on the driver fits the weights; a second pass scores the documents.

Text null or empty: one token (the end).  Lower-cased A-Z, words without ASCII white space.  A very long text is a block of its
own.  Repeated rows and ids: each row by itself.  Null ids are held out or not as the empty text.  No training documents:
N = V = 0, every token has probability 1 by the uniform part.  No rows: none.  Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import kernel as K
from . import store

#: Bytes of text in a block, and of packed keys in a part.
BLOCK, PART = 4 << 20, 16 << 20
#: Longest n-gram, and the lengths that are counted in one step.
ORDER = 3
STEPS = ((1, 2), (3,))
#: Numbers of parts of one step.
_SPREAD = 1 << 20
#: Buckets of context counts: 0, then powers of two.
BUCKETS = 24
#: Cells for each halving of a ratio in the histogram of EM, by order, and halvings told apart.
FINE, DEEP = {1: 8, 2: 4, 3: 1}, 40
END = np.uint64(0x7E57AB1E0DDBA115)
_BLOCKS = "block long, part int, a binary, b binary, c binary, d binary"


def _press(x: np.ndarray) -> bytes:
    """An array of small unsigned numbers: narrowest type, compressed."""
    top = int(x.max()) if len(x) else 0
    kind = next(k for k in "BHIQ" if top <= np.iinfo(k).max)
    return kind.encode() + zstandard.compress(np.ascontiguousarray(x.astype(kind)).tobytes(), 1)


def _open(x: bytes) -> np.ndarray:
    return np.frombuffer(zstandard.decompress(x[1:]), x[:1].decode())


def _press_keys(keys: np.ndarray) -> bytes:
    """Sorted 64-bit keys: differences, byte by byte, so that their high zero bytes vanish."""
    steps = np.diff(keys, prepend=np.uint64(0))
    return zstandard.compress(np.ascontiguousarray(steps.view(np.uint8).reshape(-1, 8).T).tobytes(), 1)


def _open_keys(x: bytes) -> np.ndarray:
    raw = np.frombuffer(zstandard.decompress(x), np.uint8).reshape(8, -1)
    return np.cumsum(np.ascontiguousarray(raw.T).view(np.uint64).ravel(), dtype=np.uint64)


def _frames(some: list[bytes]) -> bytes:
    """Byte strings as one, each after its length."""
    return b"".join(x for s in some for x in (len(s).to_bytes(8, "little"), s))


def _unframed(x: bytes) -> list[bytes]:
    out, at = [], 0
    while at < len(x):
        n = int.from_bytes(x[at : at + 8], "little")
        out.append(x[at + 8 : at + 8 + n])
        at += 8 + n
    return out


def _rows(block: list[int], part: list[int], *columns: list[bytes | None]) -> pa.RecordBatch:
    filled = [*columns, *([[None] * len(block)] * (4 - len(columns)))]
    return pa.RecordBatch.from_arrays([pa.array(block, pa.int64()), pa.array(part, pa.int32()), *(pa.array(c, pa.binary()) for c in filled)], ["block", "part", "a", "b", "c", "d"])


def _tokenised(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks of documents.  a: ids; b: tokens of each; c: whether it trains; d: vocabulary and word numbers."""
    task, serial = TaskContext.get().partitionId(), 0  # type: ignore[union-attr]
    held, size = [], 0

    def block(rows: list[pa.RecordBatch]) -> pa.RecordBatch:
        nonlocal serial
        hashes, lengths = [], []
        for batch in rows:
            data, offsets = K.column_bytes(batch.column("text"))
            starts, _, h = K.words(data, K.NOT_SPACE, offsets)
            bounds = K.rows_of(starts, offsets)
            hashes.append(np.insert(h, bounds[1:], END))
            lengths.append(np.diff(bounds) + 1)
        vocabulary, codes = np.unique(np.concatenate(hashes), return_inverse=True)
        table = pa.Table.from_batches([b.select(["doc_id", "trains"]) for b in rows])
        ids, trains = table.column("doc_id").to_pylist(), np.array(table.column("trains").to_pylist(), bool)
        known = np.array([x is not None for x in ids], np.uint8)
        serial += 1
        return _rows(
            [task << 32 | serial],
            [-1],
            [np.array([x or 0 for x in ids], np.int64).tobytes() + known.tobytes()],
            [_press(np.concatenate(lengths))],
            [_press(trains)],
            [_frames([_press_keys(vocabulary), _press(codes)])]
        )

    for batch in store.batches(it, BLOCK):
        n = batch.column("text").nbytes
        if held and size + n > BLOCK:
            yield block(held)
            held, size = [], 0
        held.append(batch)
        size += n
    if held:
        yield block(held)


class _Block:
    """A block of the written table, and by n-gram length the sorted keys it asks for and each token's number among them.

    The n-gram before a text's first words is made of ends; `first` marks tokens whose context holds no word of the text."""

    def __init__(self, order: int, a: bytes, b: bytes, c: bytes, d: bytes) -> None:
        n = len(a) // 9
        self.ids, self.known = np.frombuffer(a[: 8 * n], np.int64), np.frombuffer(a[8 * n :], np.uint8).astype(bool)
        self.lengths, self.trains = _open(b).astype(np.int64), _open(c).astype(bool)
        vocabulary, codes = _unframed(d)
        keys, number = _open_keys(vocabulary), _open(codes).astype(np.int64)
        self.doc = np.repeat(np.arange(n), self.lengths)
        self.first = np.r_[0, np.cumsum(self.lengths)[:-1]]
        self.end = int(np.searchsorted(keys, END))
        self.keys, self.numbers = [keys], [number]
        words, before = keys, np.r_[self.end, number[:-1]]
        before[self.first] = self.end  # a text begins after the end of another
        for _ in range(order - 1):
            longer, number = np.unique(before * np.int64(len(words)) + self.numbers[0], return_inverse=True)
            made = K.mix(keys[longer // len(words)] * K._Q + words[longer % len(words)] + np.uint64(len(self.keys)))
            place = np.empty(len(made), np.int64)
            place[by := np.argsort(made, kind="stable")] = np.arange(len(made))
            keys, number = made[by], place[number]
            self.keys.append(keys)
            self.numbers.append(number)
            before = np.r_[0, number[:-1]]  # of a text's first token the n-gram before is another text's; `counted` leaves it out

    def asked(self) -> list[np.ndarray]:
        """The training counts of the keys, by length."""
        use = self.trains[self.doc]
        return [np.bincount(x[use], minlength=len(k)) for x, k in zip(self.numbers, self.keys, strict=True)]

    def counted(self, totals: list[np.ndarray]) -> tuple[list[np.ndarray], list[np.ndarray]]:
        """Of every token, by n-gram length: the count of its n-gram, and of what stands before its last word (from length 2)."""
        grams = [t[x] for t, x in zip(totals, self.numbers, strict=True)]
        contexts = []
        for k, c in enumerate(grams[:-1]):
            before = np.r_[c[:1], c[:-1]]
            before[self.first] = totals[0][self.end] if k == 0 else 0
            contexts.append(before)
        for k in range(2, len(grams)):
            grams[k] = np.where(contexts[k - 1] > 0, grams[k], 0)
        return grams, contexts


def _part_of(keys: np.ndarray, parts: int) -> np.ndarray:
    return ((keys >> np.uint64(32)) * np.uint64(parts) >> np.uint64(32)).astype(np.int64)


def _steps(x: np.ndarray) -> np.ndarray:
    """Where a sorted array takes a new value."""
    return np.flatnonzero(np.r_[True, x[1:] != x[:-1]]) if len(x) else np.zeros(0, np.int64)


def _asked(lengths: tuple[int, ...], parts: int, first: int = 0) -> Callable:
    """What blocks ask of n-grams of these lengths, dealt to parts from `first` on."""

    def run(it):
        for batch in it:
            for row in batch.to_pylist():
                b = _Block(max(lengths), row["a"], row["b"], row["c"], row["d"])
                counts = b.asked()
                keys, counts = [b.keys[n - 1] for n in lengths], [counts[n - 1] for n in lengths]
                dealt = [_part_of(k, parts) for k in keys]
                some = np.unique(np.concatenate([p[_steps(p)] for p in dealt]))  # never more than there are keys
                cuts = [list(zip(np.searchsorted(p, some), np.searchsorted(p, some, "right"), strict=True)) for p in dealt]
                some = some.tolist()
                pressed = [[_frames([f(x[c[j][0] : c[j][1]]) for x, c in zip(xs, cuts, strict=True)]) for j in range(len(some))] for f, xs in ((_press_keys, keys), (_press, counts))]
                yield _rows([row["block"]] * len(some), [first + p for p in some], *pressed)

    return run


def summed(keys: list[np.ndarray], counts: list[np.ndarray], at_once: int = 1 << 18) -> tuple[list[np.ndarray], int, int]:
    """Of several blocks' sorted keys and counts: each block's keys with their counts over all blocks, the sum of all
    counts, and the keys counted at all.  About `at_once` keys are merged at a time."""
    answers, total, distinct = [np.zeros(len(k), np.int64) for k in keys], 0, 0
    pieces = sum(map(len, keys)) // at_once
    bounds = np.zeros(0, np.uint64)
    if pieces:
        sample = np.sort(np.concatenate([k[:: max(1, len(k) // 64)] for k in keys]))
        bounds = np.unique(sample[np.linspace(0, len(sample) - 1, pieces + 1).astype(np.int64)[1:-1]])
    cuts = [np.r_[0, np.searchsorted(k, bounds), len(k)] for k in keys]
    for p in range(len(bounds) + 1):
        some = [j for j, c in enumerate(cuts) if c[p] < c[p + 1]]
        if not some:
            continue
        k = np.concatenate([keys[j][cuts[j][p] : cuts[j][p + 1]] for j in some])
        n = np.concatenate([counts[j][cuts[j][p] : cuts[j][p + 1]] for j in some]).astype(np.int64)
        order = np.argsort(k, kind="stable")
        new = np.r_[True, (s := k[order])[1:] != s[:-1]]
        sums = np.add.reduceat(n[order], np.flatnonzero(new))
        total, distinct = total + int(sums.sum()), distinct + int((sums > 0).sum())
        n[order] = sums[np.cumsum(new) - 1]
        at = 0
        for j in some:
            a, b = cuts[j][p], cuts[j][p + 1]
            answers[j][a:b] = n[at : at + b - a]
            at += b - a
    return answers, total, distinct


def _answered(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of one part's rows: each block's keys get their total counts.  A row of block -1 has N, V."""
    for table in store.by_group(it, "part"):
        blocks, part = table.column("block").to_pylist(), table.column("part")[0].as_py()
        keys, counts = ([_unframed(x) for x in table.column(c).to_pylist()] for c in "ab")
        del table
        out: list[list[bytes]] = [[] for _ in blocks]
        totals = (0, 0)
        for level in range(len(keys[0])):
            found, total, distinct = summed([_open_keys(k[level]) for k in keys], [_open(n[level]) for n in counts])
            totals = totals if level else (total, distinct)
            for o, x in zip(out, found, strict=True):
                o.append(_press(x))
        del keys, counts
        for a in range(0, len(blocks), 64):
            yield _rows(blocks[a : a + 64], [part] * len(blocks[a : a + 64]), [_frames(o) for o in out[a : a + 64]])
        yield _rows([-1], [part], *([np.array([x], np.int64).tobytes()] for x in totals))


def _met(order: int, it: Iterator[pa.RecordBatch]) -> Iterator[tuple[_Block, list[np.ndarray], list[np.ndarray]]]:
    """Blocks with the counts of their tokens' n-grams and contexts."""
    for table in store.by_group(it, "block"):
        rows = sorted(table.to_pylist(), key=lambda r: r["part"])
        del table
        b = _Block(order, *(rows[0][c] for c in "abcd"))
        totals = []
        for k in range(-(-rows[-1]["part"] // _SPREAD) + 1):
            found = [_unframed(r["a"]) for r in rows[1:] if r["part"] // _SPREAD == k]
            totals += [np.concatenate([_open(x[j]).astype(np.int64) for x in found]) for j in range(len(found[0]) if found else 0)]
        yield b, *b.counted(totals)


def bucket(count: np.ndarray) -> np.ndarray:
    return np.minimum(np.where(count > 0, np.floor(np.log2(np.maximum(count, 1))) + 1, 0), BUCKETS - 1).astype(np.int64)


def state(contexts: list[np.ndarray]) -> np.ndarray:
    """The bucket of the longest context that was seen: BUCKETS numbers a length, the shortest first."""
    out = np.zeros(len(contexts[0]), np.int64)
    for k, c in enumerate(contexts):
        out = np.where(c > 0, k * BUCKETS + bucket(c), out)
    return out


def _span(order: int) -> int:
    return FINE[order] * DEEP + 2


def _cell(ratio: np.ndarray, order: int) -> np.ndarray:
    """0 for a ratio of 0, else 1 + its halvings in steps of 1/FINE."""
    fine = FINE[order]
    return np.where(ratio > 0, 1 + np.minimum(np.round(-np.log2(np.maximum(ratio, 1e-300)) * fine), fine * DEEP), 0).astype(np.int64)


def _histogram(order: int, total: int) -> Callable:
    def run(it):
        for b, grams, contexts in _met(order, it):
            use = b.trains[b.doc]
            grams, contexts = [np.maximum(g[use] - 1, 0) for g in grams], [np.maximum(c[use] - 1, 0) for c in contexts]
            cell = state(contexts) if contexts else np.zeros(len(grams[0]), np.int64)
            for c2, c in zip(grams[:0:-1], contexts[::-1], strict=True):
                cell = cell * _span(order) + _cell(c2 / np.maximum(c, 1), order)
            cell = cell * _span(order) + _cell(grams[0] / max(total - 1, 1), order)
            cells, n = np.unique(cell, return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(cells), pa.array(n.astype(np.int64))], ["cell", "n"])

    return run


def fit_weights(cells: np.ndarray, n: np.ndarray, distinct: int, order: int = ORDER, rounds: int = 60) -> np.ndarray:
    """Mixture weights by state, longest n-gram first and the uniform part last, by EM over the cells of the deleted counts."""
    span, states = _span(order), BUCKETS * max(order - 1, 1)
    back = lambda c: np.where(c > 0, 2.0 ** (-(c - 1) / FINE[order]), 0.0)
    of = cells // span**order
    p = np.stack([*(back(cells // span**k % span) for k in range(order - 1, -1, -1)), np.full(len(cells), 1 / (distinct + 1))], axis=1)
    weights = np.zeros((states, order + 1))
    for k in range(states):
        use = of == k
        seen = 0 if k == 0 else k // BUCKETS + 1  # lengths of context that are seen; no weight on longer n-grams
        w = np.r_[np.zeros(order - 1 - seen), np.full(seen, 1.0), 1.0, 0.5]
        if use.any():
            w = w / w.sum()
            for _ in range(rounds):
                q = w * p[use]
                w = (n[use, None] * q / q.sum(axis=1, keepdims=True)).sum(axis=0)
                w /= w.sum()
        elif k % BUCKETS > 1 or (k and seen == 1):  # as the next smaller bucket
            w = weights[k - 1] if weights[k - 1][order - 1 - seen] else w
        w = np.maximum(w, np.r_[np.zeros(order), 1e-6])
        weights[k] = w / w.sum()
    return weights


def _scored(order: int, total: int, distinct: int, weights: np.ndarray) -> Callable:
    def run(it):
        for b, grams, contexts in _met(order, it):
            w = weights[state(contexts) if contexts else np.zeros(len(grams[0]), np.int64)]
            p = w[:, order] / (distinct + 1) + w[:, order - 1] * grams[0] / max(total, 1)
            for k, (c2, c) in enumerate(zip(grams[1:], contexts, strict=True)):
                p += w[:, order - 2 - k] * c2 / np.maximum(c, 1)
            p = np.where(total > 0, p, 1 / (distinct + 1))
            base = np.log10((grams[0] + 0.1) / (total + 0.1 * (distinct + 1)))
            n = len(b.ids)
            sums = lambda x: np.bincount(b.doc, weights=x, minlength=n)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(b.ids, mask=~b.known),
                    pa.array(~b.trains),
                    pa.array(b.lengths),
                    pa.array(sums(grams[0] > 0).astype(np.int64)),
                    pa.array(np.full(n, total, np.int64)),
                    pa.array(sums(base)),
                    pa.array(sums(np.log10(p)))
                ],
                ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"],
            )

    return run


def score(docs: DataFrame, trains=None, order: int = ORDER) -> DataFrame:
    """Per row: doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score (log10).

    `trains`: a condition on the columns of `docs`; by default crc32(doc_id as text) mod 10 is not 0."""
    spark = docs.sparkSession
    trains = store.remainder("doc_id", 10) != 0 if trains is None else trains
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(trains, F.lit(False)).alias("trains"), "text")
    blocks = store.written(rows.transform(store.arrow, _tokenised, _BLOCKS), "blocks")
    size = blocks.agg(F.sum(F.length("d"))).first()[0] or 0  # a length's packed keys are about as large as the packed words
    answers = []
    for k, lengths in enumerate(tuple(n for n in step if n <= order) for step in STEPS):
        if lengths:
            parts = store.parts(spark, size * len(lengths), PART)
            asked = blocks.transform(store.arrow, _asked(lengths, parts, k * _SPREAD), _BLOCKS)
            dealt = asked.repartition(parts, "part").sortWithinPartitions("part").transform(store.arrow, _answered, _BLOCKS)
            answers.append(store.written(dealt, "counts"))
            del asked, dealt
            store.release(spark)
    sums = answers[0].where("block = -1").select("a", "b").collect()  # a row a part
    total, distinct = (sum(x) for x in zip((0, 0), *((int.from_bytes(r.a, "little"), int.from_bytes(r.b, "little")) for r in sums), strict=True))
    answers = reduce(DataFrame.union, answers).where("block >= 0")
    met = blocks.union(answers).repartition(store.parts(spark, size, PART), "block").sortWithinPartitions("block", "part")
    cells = met.transform(store.arrow, _histogram(order, total), "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n"))
    cells = store.written(cells.coalesce(4), "cells").toArrow()  # written, or the driver would hold on to the shuffle
    store.release(spark)
    weights = fit_weights(cells.column("cell").to_numpy(), cells.column("n").to_numpy().astype(float), distinct, order)
    return met.transform(
        store.arrow,
        _scored(order, total, distinct, weights),
        "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
    )
