"""Language identification with hyperdimensional profiles.

Every letter has a fixed random vector of +1 and -1; an n-gram's vector binds (multiplies) its letters' vectors, each
permuted (rotated) by its place; a text's vector bundles (adds) those of its n-grams, and a language's prototype
bundles the texts of that language.  A text goes to the prototype with the largest cosine.

Texts are lower-cased; everything but letters counts as one space between words.  Prototypes are learned from a
bounded sample of about `sample` texts a language, chosen by a hash of the id, and summed by an aggregation.

Null and empty texts and texts without letters: `und`, score 0.  Very long texts are whole, in slices of n-grams.  Null languages
don't train.  No training rows: every text is `und`.  Equal cosines: the language first in code point order.  Repeated rows
are judged alike.  An empty table stays empty.  Extra columns pass through, whatever their names: the columns added take other ones.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import kernel as K
from . import store

DIMS = 1024
GRAM = 3
#: Training texts a language, about; languages that are summed, fetched and compared at once.
SAMPLE, BLOCK = 2000, 1000
UNKNOWN = "und"
_SPACE = 32


def _letters() -> np.ndarray:
    """For each code point its lower-cased letter, or a space."""
    table = np.full(0x110000, _SPACE, np.uint32)
    for c in range(len(table)):
        x = chr(c)
        if x.isalpha():
            low = x.lower()
            table[c] = ord(low) if len(low) == 1 else c
    return table


class Vectors:
    """Letter vectors made from the code point; n-gram vectors bound from them, the latest kept."""

    KEEP = 8192

    def __init__(self, dims: int = DIMS, gram: int = GRAM) -> None:
        self.dims, self.gram, self.letters = dims, gram, _letters()
        self.slot: dict[int, int] = {}
        self.table = np.zeros((self.KEEP, dims), np.float32)
        self.letter: dict[int, np.ndarray] = {}

    def of_letter(self, c: int) -> np.ndarray:
        if c not in self.letter:
            bits = K.mix(np.full(1, c + 1, np.uint64) * np.uint64(0x2545F4914F6CDD1D) + np.arange(-(-self.dims // 64), dtype=np.uint64))
            self.letter[c] = np.unpackbits(bits.view(np.uint8))[: self.dims].astype(np.float32) * 2 - 1
        return self.letter[c]

    def bind(self, key: int) -> np.ndarray:
        out = np.ones(self.dims, np.float32)
        for place in range(self.gram):
            out *= np.roll(self.of_letter(key >> (21 * place) & 0x1FFFFF), place)
        return out

    def of_grams(self, keys: np.ndarray) -> np.ndarray:
        out = np.empty((len(keys), self.dims), np.float32)
        for i, key in enumerate(keys.tolist()):
            at = self.slot.get(key)
            if at is None:
                if len(self.slot) == self.KEEP:
                    self.slot.clear()
                at = self.slot[key] = len(self.slot)
                self.table[at] = self.bind(key)
            out[i] = self.table[at]
        return out

    def bundle(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(vectors, has letters) of the rows' UTF-8 texts."""
        n = len(offsets) - 1
        points = np.frombuffer(data.tobytes().decode("utf-8", "replace").encode("utf-32-le"), np.uint32)
        first = (data & 0xC0) != 0x80
        place = np.r_[0, np.cumsum(first)][offsets]  # rows in code points
        code = self.letters[points].astype(np.int64)
        space = code == _SPACE
        row = np.repeat(np.arange(n), np.diff(place))
        if len(code):  # of white space between words one stays, at a row's ends none
            keep = ~(space & np.r_[True, space[:-1] | (row[1:] != row[:-1])])
            code, row = code[keep], row[keep]
            keep = (code != _SPACE) | np.r_[row[1:] == row[:-1], False]
            code, row = code[keep], row[keep]
        lettered = np.bincount(row[code != _SPACE], minlength=n) > 0
        # a space before and after each row
        ends = np.searchsorted(row, np.arange(n + 1))
        code = np.insert(code, np.r_[ends[:-1], ends[1:]], _SPACE)
        row = np.insert(row, np.r_[ends[:-1], ends[1:]], np.r_[np.arange(n), np.arange(n)])
        order = np.argsort(row, kind="stable") if np.any(row[1:] < row[:-1]) else slice(None)
        code, row = code[order], row[order]
        m = len(code) - self.gram + 1
        if m <= 0:
            return np.zeros((n, self.dims), np.float32), lettered
        keys = np.zeros(m, np.int64)
        for k in range(self.gram):
            keys |= code[k : k + m] << (21 * k)
        inside = row[:m] == row[self.gram - 1 :]
        keys, row = keys[inside], row[:m][inside]
        distinct, number = np.unique(keys, return_inverse=True)
        out = np.zeros((n, self.dims), np.float32)
        width = min(4096, max(1, (1 << 20) // max(n, 1)))
        for a in range(0, len(distinct), width):  # counts of some n-grams at once, times their vectors
            some = (number >= a) & (number < a + width) if len(distinct) > width else slice(None)
            counts = np.bincount(row[some] * width + number[some] - a, minlength=n * width).reshape(n, width).astype(np.float32)
            out += counts[:, : len(distinct) - a] @ self.of_grams(distinct[a : a + width])
        return out, lettered


_kept: dict[tuple[int, int], Vectors] = {}


def drop_caches() -> None:
    _kept.clear()


def _vectors(dims: int, gram: int) -> Vectors:
    if (dims, gram) not in _kept:
        _kept[dims, gram] = Vectors(dims, gram)
    return _kept[dims, gram]


def _profiles(dims: int, gram: int) -> Callable:
    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        for batch in store.batches(it, 1 << 18):
            v, _ = _vectors(dims, gram).bundle(*K.column_bytes(batch.column("text")))
            for k, lang in enumerate(batch.column("lang").to_pylist()):
                sums[lang] = sums.get(lang, 0) + v[k].astype(np.int64)
                if len(sums) == BLOCK:
                    yield from flushed(sums)
                    sums.clear()
        yield from flushed(sums)

    def flushed(sums: dict[str, np.ndarray]) -> Iterator[pa.RecordBatch]:
        for lang, v in sums.items():
            yield pa.RecordBatch.from_arrays([pa.array([lang] * dims), pa.array(range(dims), pa.int32()), pa.array(v)], ["lang", "dim", "value"])

    return run


def learn(docs: DataFrame, dims: int = DIMS, gram: int = GRAM, sample: int = SAMPLE) -> tuple[list[str], np.ndarray]:
    """Languages, sorted, and their prototypes.  `docs`: doc_id, text, lang of the training rows."""
    rows = docs.where("lang is not null and text is not null").select("doc_id", "lang", "text")
    counts = rows.groupBy("lang").agg(F.count("*").alias("n")).collect()
    if not counts:
        return [], np.zeros((0, dims))
    shares = docs.sparkSession.createDataFrame([(r.lang, int(min(1.0, sample / r.n) * (1 << 30))) for r in counts], "l string, share long")
    chosen = rows.join(F.broadcast(shares), F.col("lang") == F.col("l")).where(F.pmod(F.xxhash64("doc_id", F.lit(5)), F.lit(1 << 30)) < F.col("share")).select("lang", "text")
    sums = chosen.transform(store.arrow, _profiles(dims, gram), "lang string, dim int, value long").groupBy("lang", "dim").agg(F.sum("value").alias("value"))
    known = sorted(r.lang for r in counts)
    if len(known) > BLOCK:
        sums = store.written(sums, "profiles")
    found: dict[str, np.ndarray] = {}
    for a in range(0, len(known), BLOCK):
        part = known[a : a + BLOCK]
        for r in (sums if len(known) <= BLOCK else sums.where(F.col("lang").isin(part))).collect():
            found.setdefault(r.lang, np.zeros(dims))[r.dim] = r.value
    names = sorted(found)
    return names, np.stack([found[x] for x in names]) if names else np.zeros((0, dims))


def _judged(shared, dims: int, gram: int, columns: list[str]) -> Callable:
    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, prototypes = shared.value
        unit = (prototypes / np.maximum(np.linalg.norm(prototypes, axis=1, keepdims=True), 1e-12)).T
        for batch in store.batches(it, 1 << 18):
            v, lettered = _vectors(dims, gram).bundle(*K.column_bytes(batch.column("text")))
            lang, score = [UNKNOWN] * batch.num_rows, np.zeros(batch.num_rows)
            if names:
                best, top = np.zeros(len(v), np.int64), np.full(len(v), -np.inf)
                for a in range(0, len(names), BLOCK):
                    cos = v.astype(float) @ unit[:, a : a + BLOCK] / np.maximum(np.linalg.norm(v.astype(float), axis=1, keepdims=True), 1e-12)
                    k = cos.argmax(axis=1)
                    most = cos[np.arange(len(k)), k]
                    more = most > top
                    best[more], top[more] = a + k[more], most[more]
                score = np.where(lettered, np.clip(top, 0, 1), 0.0)
                lang = [names[b] if ok else UNKNOWN for b, ok in zip(best, lettered, strict=True)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(lang, pa.string()), pa.array(score)], [*batch.schema.names, *columns])

    return run


def annotate(docs: DataFrame, trains: Column | None = None, dims: int = DIMS, gram: int = GRAM, sample: int = SAMPLE) -> tuple[DataFrame, str, str]:
    """`docs` with two more columns, language and score, and their names; learned from its rows under `trains` (by
    default crc32(doc_id as text) mod 4 is not 2)."""
    trains = store.remainder("doc_id", 4) != 2 if trains is None else trains
    model = learn(docs.where(trains), dims, gram, sample)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    lang, score = store.unused(docs.columns, "__lang", "__score")
    schema = T.StructType([*docs.schema.fields, T.StructField(lang, T.StringType()), T.StructField(score, T.DoubleType())])
    return docs.transform(store.arrow, _judged(shared, dims, gram, [lang, score]), schema), lang, score


def report(docs: DataFrame, **options) -> DataFrame:
    out, lang, score = annotate(docs.select("doc_id", "text", "lang"), **options)
    return out.select("doc_id", (store.remainder("doc_id", 4) == 2).alias("held_out"), F.col(lang).alias("lang_pred"), F.col(score).alias("score"))


def keep_known(docs: DataFrame, least: float = 0.0, **options) -> DataFrame:
    """`docs` without rows that have no letters, or a cosine under `least` with every prototype.

    Cosines are cut off at 0, so the default `least`, which the pipeline takes, rejects rows without letters only; texts of
    letters in a language that wasn't learned stay, under the nearest name.  Without training rows every row goes."""
    out, lang, score = annotate(docs, **options)
    return out.where((F.col(lang) != UNKNOWN) & (F.col(score) >= least)).select(*(f"`{c}`" for c in docs.columns))
