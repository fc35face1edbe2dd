"""Benchmark decontamination: a broadcast hash set of normalised test n-grams against every training window.

Test items are cut into windows of WINDOW words (a shorter item is one window).  Their hashes and texts are broadcast
as a few arrays, in blocks of about `block_bytes` by hash and item (a window of many items is dealt to all blocks), so the
broadcast has a fixed bound; a larger benchmark takes more passes over the documents, each starting from the written result of the one before.  A document batch is hashed once
for each window length in use, filtered by a bitmap, looked up, and every hit is verified word by word, so a
hash collision can't mark a clean document.  The documents are never shuffled.

Nulls, empty texts: no words, never contaminated.  Very long texts are read in pieces between words.  Repeated rows and
ids: each row is judged by itself.  Items of equal id count once; a null item id is the id "null".  An empty benchmark
leaves all documents clean, an empty table stays empty.  Extra columns pass through, whatever their names: the columns
added take other ones.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import kernel as K
from . import store

WINDOW = 10
#: Bytes of one broadcast, about: a window's words and item, and 24 for its hash and places.
BLOCK_BYTES = 64 << 20
_GRAMS = "item string, length int, hash long, words binary"
_KINDS = {"words": T.LongType(), "hits": T.ArrayType(T.LongType()), "items": T.ArrayType(T.StringType()), "spans": T.ArrayType(T.LongType())}


def _grams(window: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in it:
            data, offsets = K.column_bytes(batch.column("text"))
            starts, ends, hashes = K.words(data, K.ALNUM, offsets)
            bounds, low = K.rows_of(starts, offsets), K.LOWER[data].tobytes()
            rows: dict[str, list] = {"item": [], "length": [], "hash": [], "words": []}
            for r, item in enumerate(batch.column("item").to_pylist()):
                a, b = int(bounds[r]), int(bounds[r + 1])
                length = min(window, b - a)
                for i, h in enumerate(K.windows(hashes[a:b], length) if length else ()):
                    rows["item"].append(item)
                    rows["length"].append(length)
                    rows["hash"].append(int(h.view(np.int64)))
                    rows["words"].append(b" ".join(low[s:e] for s, e in zip(starts[a + i : a + i + length], ends[a + i : a + i + length], strict=True)))
            yield pa.RecordBatch.from_arrays(
                [pa.array(rows["item"], pa.string()), pa.array(rows["length"], pa.int32()), pa.array(rows["hash"], pa.int64()), pa.array(rows["words"], pa.binary())],
                ["item", "length", "hash", "words"]
            )

    return run


class _Set:
    """One block of test windows: by length their sorted hashes, a bitmap of the hashes' top bits, and the numbers of
    the windows, whose words lie in one buffer and whose items in one list."""

    BITS = 22

    def __init__(self, rows: pa.Table) -> None:
        self.text, self.at = K.column_bytes(rows.column("words"))
        self.text = self.text.tobytes()
        items = rows.column("item").combine_chunks().dictionary_encode()
        if isinstance(items, pa.ChunkedArray):
            items = pa.concat_arrays([c for c in items.unify_dictionaries().chunks]) if items.num_chunks else pa.array([], pa.string()).dictionary_encode()
        self.names, self.item = items.dictionary.to_pylist(), items.indices.to_numpy()
        length, h = rows.column("length").to_numpy(), rows.column("hash").to_numpy().view(np.uint64)
        self.windows: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]] = {}
        for n in np.unique(length).tolist():
            some = np.flatnonzero(length == n)
            some = some[np.argsort(h[some], kind="stable")]
            top = np.zeros(1 << self.BITS, bool)
            top[(h[some] >> np.uint64(64 - self.BITS)).astype(np.int64)] = True
            self.windows[n] = h[some], some.astype(np.int32), top

    def hits(self, hashes: np.ndarray, bounds: np.ndarray) -> Iterator[tuple[int, int, int]]:
        """(first word, length, hash) of windows with a known hash."""
        for n, (wanted, _, top) in self.windows.items():
            starts, found = K.windows_in_rows(hashes, bounds, n)
            near = np.flatnonzero(top[(found >> np.uint64(64 - self.BITS)).astype(np.int64)])
            at = np.minimum(np.searchsorted(wanted, found[near]), len(wanted) - 1)
            near = near[wanted[at] == found[near]]
            yield from zip(starts[near].tolist(), [n] * len(near), found[near].tolist(), strict=True)

    def owners(self, length: int, h: int, text: bytes) -> set[str]:
        """The items with a window of this hash whose words are these."""
        wanted, number, _ = self.windows[length]
        a, b = np.searchsorted(wanted, np.uint64(h), "left"), np.searchsorted(wanted, np.uint64(h), "right")
        return {self.names[self.item[k]] for k in number[a:b].tolist() if self.text[self.at[k] : self.at[k + 1]] == text}


def _scan(shared, names: list[str], again: bool) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Adds the columns `names` (words, hits, items, spans); `again`: to what earlier blocks found, in columns of these names."""

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: _Set = shared.value
        for batch in store.batches(it, 2 << 20):
            data, offsets = K.column_bytes(batch.column("text"))
            starts, ends, hashes = K.words(data, K.ALNUM, offsets)
            bounds, n = K.rows_of(starts, offsets), batch.num_rows
            counts = np.diff(bounds)
            hit: dict[int, set[int]] = {}
            items: dict[int, set[str]] = {}
            for first, length, h in known.hits(hashes, bounds):
                text = b" ".join(K.LOWER[data[s:e]].tobytes() for s, e in zip(starts[first : first + length], ends[first : first + length], strict=True))
                if owners := known.owners(length, h, text):
                    r = int(np.searchsorted(bounds, first, side="right")) - 1
                    hit.setdefault(r, set()).update(range(first - int(bounds[r]), first - int(bounds[r]) + length))
                    items.setdefault(r, set()).update(owners)
            if again:
                for name, found in ((names[1], hit), (names[2], items)):
                    for r, old in enumerate(batch.column(name).to_pylist()):
                        if old:
                            found.setdefault(r, set()).update(old)
                batch = batch.select(batch.schema.names[: -len(names)])
            spans = []
            for r in range(n):
                at = sorted(hit.get(r, ()))
                cuts: list[int] = []
                for w in at:
                    s, e = int(starts[bounds[r] + w] - offsets[r]), int(ends[bounds[r] + w] - offsets[r])
                    if at and cuts and w - 1 in hit[r]:
                        cuts[-1] = e
                    else:
                        cuts += [s, e]
                spans.append(cuts)
            yield pa.RecordBatch.from_arrays(
                [
                    *batch.columns,
                    pa.array(counts, pa.int64()),
                    pa.array([sorted(hit.get(r, ())) for r in range(n)], pa.list_(pa.int64())),
                    pa.array([sorted(items.get(r, ())) for r in range(n)], pa.list_(pa.string())),
                    pa.array(spans, pa.list_(pa.int64()))
                ],
                [*batch.schema.names, *names],
            )

    return run


def annotate(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, block_bytes: int = BLOCK_BYTES) -> tuple[DataFrame, list[str]]:
    """`docs` (with a text column) and four more columns, whose names are returned too: words (count), hits (numbers of the
    words hit), items (ids of the items found, as strings, sorted), spans (byte starts and ends of hit runs, alternating)."""
    spark = docs.sparkSession
    items = benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("null")).alias("item"), "text")
    grams = items.transform(store.arrow, _grams(window), _GRAMS).distinct()
    size = grams.agg(F.sum(F.octet_length("words") + F.octet_length("item") + 24)).first()[0] or 0
    blocks = max(1, -(-size // block_bytes))
    names = store.unused(docs.columns, *(f"__{k}" for k in _KINDS))
    schema = T.StructType([*docs.schema.fields, *(T.StructField(n, t) for n, t in zip(names, _KINDS.values(), strict=True))])
    out, before = docs, None
    for k in range(blocks):
        block = grams.where(F.pmod(F.xxhash64("hash", "item"), F.lit(blocks)) == k) if blocks > 1 else grams
        shared = spark.sparkContext.broadcast(_Set(block.toArrow()))
        out = out.transform(store.arrow, _scan(shared, names, k > 0), schema)
        if k + 1 < blocks:
            out = store.written(out, "decontaminate")
            if before is not None:
                store.forget(before)
            before = out
    return out, names


def remove(docs: DataFrame, benchmark: DataFrame, mode: str = "documents", **options) -> DataFrame:
    """`docs` without contamination: mode "documents" drops each contaminated row, "spans" cuts the hit runs out of its text."""
    marked, (_, hits, _, runs) = annotate(docs, benchmark, **options)
    columns = docs.columns
    if mode == "documents":
        return marked.where(F.size(hits) == 0).select(*(f"`{c}`" for c in columns))

    def cut(it):
        for batch in it:
            kept = []
            for text, spans in zip(batch.column("text").to_pylist(), batch.column(runs).to_pylist(), strict=True):
                if spans:
                    raw, at, rest = text.encode(), 0, []
                    for s, e in zip(spans[::2], spans[1::2], strict=True):
                        rest.append(raw[at:s])
                        at = e
                    text = b"".join([*rest, raw[at:]]).decode()
                kept.append(text)
            k = batch.schema.get_field_index("text")
            yield batch.set_column(k, "text", pa.array(kept, pa.string())).select(columns)

    return marked.transform(store.arrow, cut, docs.schema)


def report(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """One row per document: its words, the words hit, the items found and the digest of their ids."""
    found, (words, hits, items, _) = annotate(store.texts(docs), benchmark, **options)
    return found.select(
        "doc_id", F.col(words).alias("n_words"), F.size(hits).cast("long").alias("n_hit"), F.size(items).cast("long").alias("n_items"),
        F.sha2(F.array_join(items, ",").cast("binary"), 256).alias("items_sha256"), (F.size(hits) > 0).alias("contaminated"),
    )
