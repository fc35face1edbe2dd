"""Token ids in binary shards: one compressed frame a document under a shared dictionary, with an offset index.

A shard file, all numbers little-endian:

    magic "TOKSHRD1" | sha256 of the dictionary (32 bytes) | bytes an id: 2 or 4 (u4)
    frames: for each document one zstandard frame of its ids, compressed with the dictionary
    index: for each document  known (u8: 0 if its id is null) | doc_id (i8) | offset (u8) | length (u8) | ids (u8)
    number of documents (u8) | offset of the index (u8) | magic "TOKINDX1"

The dictionary is a file of its own beside the shards.  It is trained on serialized ids: of a bounded sample of
documents, chosen by a hash of the id, whole texts are encoded and cut into pieces, and of these as many as about
SAMPLE_BYTES hold are chosen by a hash of the piece.  Documents are dealt to shards by ranges of doc_id and sorted within them, so
the shards in order hold ascending ids.  A shard is written under a name of its attempt and renamed when complete, so
a lost executor leaves nothing half written; a repeated attempt writes the same bytes.

Ids are those of the library as the file sets it up: the string of an added token in a text, such as <|endoftext|>, becomes
that token's id.

Null and empty texts: their ids are the end id alone.  Very long texts are encoded in pieces that no token can cross.  Null
ids come first.  Repeated rows are written as often; equal ids go by their texts.  An empty table: no shard, no rows.  Extra columns
are ignored.
"""

from __future__ import annotations

import hashlib
import json
import os
import uuid
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
import pyarrow.fs as pafs
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import kernel as K
from . import store

MAGIC, INDEX = b"TOKSHRD1", b"TOKINDX1"
END_ID = 0
#: Documents that train the dictionary, about; ids of a piece of them; bytes of the pieces taken, about; the dictionary's bytes.
SAMPLE, PIECE_IDS, SAMPLE_BYTES, DICTIONARY = 2000, 4096, 16 << 20, 112_640
_ENTRY = np.dtype([("known", "<u8"), ("doc_id", "<i8"), ("offset", "<u8"), ("length", "<u8"), ("ids", "<u8")])
#: Bytes of text and index that a shard takes, and of frames that are read at once, about.
SHARD_BYTES, READ_BYTES = 128 << 20, 1 << 20
#: Texts longer than this are encoded in pieces, cut before a single space between words, where no token can cross.
PIECE = 1 << 20


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


_loaded: dict[str, object] = {}


def tokenizer(path: str):
    if path not in _loaded:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        _loaded[path] = Tokenizer.from_file(path)
    return _loaded[path]


def pieces(text: str, size: int = PIECE) -> list[str]:
    out, a = [], 0
    while len(text) - a > size:
        b = a + size
        while b > a + 1 and not (text[b] == " " and not text[b - 1].isspace() and not text[b + 1 : b + 2].isspace()):
            b -= 1
        if b == a + 1:  # nowhere before: the first place after
            b = a + size
            while b < len(text) and not (text[b] == " " and not text[b - 1].isspace() and not text[b + 1 : b + 2].isspace()):
                b += 1
        out.append(text[a:b])
        a = b
    return [*out, text[a:]] if a < len(text) or not out else out


#: Bytes of the characters whose class is read alike everywhere: tab, line ends, printable ASCII, Latin letters to U+017F.
_PLAIN = np.zeros(256, bool)
_PLAIN[[0x09, 0x0A, 0x0D, *range(0x20, 0x7F), *range(0x80, 0xC0), 0xC3, 0xC4, 0xC5]] = True
_NOT_BLANK = np.arange(256) != 0x20
#: Words whose ids a process keeps (about 25 bytes each).
KEEP = 1_000_000


class _Known:
    """Ids of words seen, by the word's hash.  Sorted keys in two levels (the latest apart, so that adding moves little),
    and where their ids lie in one array."""

    def __init__(self) -> None:
        none = (np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64))  # keys, places, numbers of ids
        self.levels = [none, none]
        self.flat = np.zeros(1 << 16, np.uint32)
        self.used = 0

    def __len__(self) -> int:
        return sum(len(x[0]) for x in self.levels)

    def add(self, keys: np.ndarray, ids: np.ndarray, n: np.ndarray) -> None:
        """`keys` sorted, none of them known."""
        if len(self) + len(keys) > KEEP:
            self.__init__()  # type: ignore[misc]
        if self.used + len(ids) > len(self.flat):
            self.flat = np.concatenate([self.flat, np.zeros(max(len(self.flat), len(ids)), np.uint32)])
        self.flat[self.used : self.used + len(ids)] = ids
        new = (keys, self.used + np.cumsum(n) - n, n)
        self.used += len(ids)
        for k in (1, 0):
            new = self._merged(self.levels[k], new)
            if k == 0 or len(new[0]) < len(self.levels[0][0]) // 4:
                self.levels[k] = new
                break
            self.levels[k] = tuple(x[:0] for x in new)

    @staticmethod
    def _merged(old: tuple, new: tuple) -> tuple:
        place = np.searchsorted(old[0], new[0])
        return tuple(np.insert(a, place, b) for a, b in zip(old, new, strict=True))

    def find(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(whether known, place, number of ids) of each key."""
        known, at, n = np.zeros(len(keys), bool), np.zeros(len(keys), np.int64), np.zeros(len(keys), np.int64)
        for level, places, numbers in self.levels:
            if len(level):
                k = np.minimum(np.searchsorted(level, keys), len(level) - 1)
                here = level[k] == keys
                known |= here
                at[here], n[here] = places[k[here]], numbers[k[here]]
        return known, at, n


_known: dict[str, _Known] = {}


def drop_caches() -> None:
    _known.clear()
    _loaded.clear()


def _encode(model, texts: list[str]) -> list[list[int]]:
    """Ids of whole texts; encodings are large objects, so about a MB of text at once."""
    out: list[list[int]] = []
    a = 0
    while a < len(texts):
        b, size = a, 0
        while b < len(texts) and (b == a or size + len(texts[b]) + 50 <= PIECE):
            size += len(texts[b]) + 50
            b += 1
        out += [e.ids for e in model.encode_batch_fast(texts[a:b], add_special_tokens=False)]
        a = b
    return out


def _encode_words(model, words: list[str], at_once: int = 20_000) -> tuple[np.ndarray, np.ndarray]:
    """(ids, how many of them are each word's), every word by itself: many words are one call."""
    ids, n = [np.zeros(0, np.uint32)], [np.zeros(0, np.int64)]
    for a in range(0, len(words), at_once):
        part = words[a : a + at_once]
        made = model.encode(part, is_pretokenized=True, add_special_tokens=False)
        ids.append(np.array(made.ids, np.uint32))
        n.append(np.bincount(np.array(made.word_ids, np.int64), minlength=len(part)))
    return np.concatenate(ids), np.concatenate(n)


def _even(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Texts of plain bytes in which every space stands between two characters that aren't white space: such a text
    can be cut before each space, and no token crosses a cut."""
    bad = ~_PLAIN[data]
    bad[1:] |= (data[:-1] == 0xC3) & ((data[1:] == 0x97) | (data[1:] == 0xB7))  # multiplication and division signs
    blank, white = ~_NOT_BLANK[data], ~K.NOT_SPACE[data]
    bad[1:] |= blank[1:] & white[:-1]
    bad[:-1] |= blank[:-1] & white[1:]
    some = np.diff(offsets) > 0
    edge = np.r_[offsets[:-1][some], offsets[1:][some] - 1]
    bad[edge] |= blank[edge]
    sums = np.r_[0, np.cumsum(bad)]
    return sums[offsets[1:]] == sums[offsets[:-1]]


_MARK = np.isin(np.arange(256), [0x2C, 0x2E])
_LETTER = np.array([c >= 0x80 or chr(c).isalnum() for c in range(256)])


def _without_mark(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Ends without a last comma or full stop after a letter or digit: such a mark is a word of its own."""
    cut = (end - start > 1) & _MARK[data[end - 1]] & _LETTER[data[end - 2]]
    return end - cut


def encoded(path: str, texts: list[str] | pa.Array) -> list[np.ndarray]:
    """Ids of each text, with the end id.

    A byte-level BPE encodes each word of its split by itself, so even texts (see `_even`) are cut before their
    spaces, a last comma or full stop apart, and each distinct piece is encoded once and kept by its 64-bit hash.  Other texts go to the library whole."""
    model, known = tokenizer(path), _known.setdefault(path, _Known())
    column = pa.array(texts, pa.large_string()) if isinstance(texts, list) else texts
    data, offsets = K.column_bytes(column)
    even, (added, cuttable) = _even(data, offsets) if _by_words(path) else np.zeros(len(offsets) - 1, bool), _added(path)
    special = np.zeros(len(even), bool)
    for t in added:
        special |= pa.compute.match_substring(column.fill_null(""), t).to_numpy(zero_copy_only=False)
    even &= ~special
    start, end, h = K.words(data, _NOT_BLANK, offsets, K.SAME, _without_mark)
    bounds = K.rows_of(start, offsets)
    use = np.repeat(even, np.diff(bounds))
    first = np.zeros(len(start), bool)
    first[bounds[:-1][np.diff(bounds) > 0]] = True  # a text's first piece has no space before it
    row_end = np.repeat(offsets[1:], np.diff(bounds))
    marked = (end < row_end) & _MARK[data[np.minimum(end, len(data) - 1)]] if len(data) else np.zeros(0, bool)
    start, end, first, h, marked = start[use], end[use], first[use], h[use], marked[use]
    keys, sample, number = np.unique(K.mix(h + first.astype(np.uint64)), return_index=True, return_inverse=True)
    there, at, n = known.find(keys)
    while not there.all():  # again if the kept words had to be dropped for new ones
        new, raw = np.flatnonzero(~there), data.tobytes()
        cut = zip((start - (~first).astype(np.int64))[sample[new]].tolist(), end[sample[new]].tolist(), strict=True)
        known.add(keys[new], *_encode_words(model, [raw[a:b].decode() for a, b in cut]))
        there, at, n = known.find(keys)
    length, begin = n[number] + marked, at[number]
    ends = np.cumsum(length)
    flat = known.flat[np.minimum(np.repeat(begin - (ends - length), length) + np.arange(ends[-1] if len(ends) else 0), len(known.flat) - 1)]
    flat[ends[marked] - 1] = _mark_ids(path)[data[end[marked]]]
    pieces_before = np.r_[0, np.cumsum(np.where(even, np.diff(bounds), 0))]
    cuts = np.r_[0, ends][pieces_before]
    stop, out = np.array([END_ID], np.uint32), []
    for k in range(len(even)):
        if even[k]:
            ids = flat[cuts[k] : cuts[k + 1]]
        else:
            text = data[offsets[k] : offsets[k + 1]].tobytes().decode()
            ids = np.array([i for x in _encode(model, [text] if special[k] and not cuttable else pieces(text)) for i in x], np.uint32)
        out.append(np.concatenate([ids, stop]))
    return out


_adds: dict[str, tuple[list[str], bool]] = {}


def _added(path: str) -> tuple[list[str], bool]:
    """The strings of the tokenizer's added tokens, and whether a text that holds them can be cut at spaces all the same."""
    if path not in _adds:
        found = json.loads(tokenizer(path).to_str()).get("added_tokens") or []
        plain = not any(t.get("lstrip") or t.get("rstrip") or t.get("single_word") or any(c.isspace() for c in t["content"]) for t in found)
        _adds[path] = [t["content"] for t in found], plain
    return _adds[path]


_splits: dict[str, bool] = {}
_marks: dict[str, np.ndarray] = {}


def _mark_ids(path: str) -> np.ndarray:
    """The id of a comma and of a full stop, by byte."""
    if path not in _marks:
        _marks[path] = np.zeros(256, np.uint32)
        for c in ",.":
            (_marks[path][ord(c)],) = tokenizer(path).encode(c, add_special_tokens=False).ids
    return _marks[path]



def _by_words(path: str) -> bool:
    """Whether the tokenizer is a byte-level BPE with its own split and nothing else."""
    if path not in _splits:
        made = json.loads(tokenizer(path).to_str())
        pre = made.get("pre_tokenizer") or {}
        _splits[path] = made.get("normalizer") is None and made["model"]["type"] == "BPE" and pre.get("type") == "ByteLevel" and pre.get("use_regex", True) and not pre.get("add_prefix_space")
    return _splits[path]


def _open(url: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(url) if "://" in url else (pafs.LocalFileSystem(), url.removeprefix("file:"))


def _sampled(path: str, width: int, share: float) -> Callable:
    def run(it):
        for batch in it:
            for ids in encoded(path, batch.column("text")):
                pieces_of = [ids[a : a + PIECE_IDS].astype(f"<u{width}").tobytes() for a in range(0, len(ids), PIECE_IDS)]
                kept = [x for x in pieces_of if zlib.crc32(x) <= share * 0xFFFFFFFF]
                yield pa.RecordBatch.from_arrays([pa.array(kept, pa.binary())], ["ids"])

    return run


def dictionary(docs: DataFrame, path: str, width: int, sample: int = SAMPLE, sample_bytes: int = SAMPLE_BYTES) -> bytes:
    """A zstandard dictionary from pieces of about `sample` documents; raw ids if they are too few to train on."""
    n, size = docs.agg(F.count("*"), F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()
    part = min(1.0, sample / max(n, 1))
    chosen = docs.where(F.pmod(F.xxhash64("doc_id", F.lit(9)), F.lit(1 << 30)) < int(part * (1 << 30)))
    share = min(1.0, sample_bytes / max(1.0, size * part * width / 4))  # a token is about four bytes of text
    rows = chosen.select("text").transform(store.arrow, _sampled(path, width, share), "ids binary").toArrow()
    samples = sorted(rows.column("ids").to_pylist())
    try:
        return zstandard.train_dictionary(DICTIONARY, samples).as_bytes()
    except zstandard.ZstdError:
        return b"".join(samples)[:DICTIONARY]


def _compressor(data: bytes) -> zstandard.ZstdCompressor:
    return zstandard.ZstdCompressor(level=3, dict_data=zstandard.ZstdCompressionDict(data)) if len(data) >= 8 else zstandard.ZstdCompressor(level=3)


def _decompressor(data: bytes) -> zstandard.ZstdDecompressor:
    return zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(data)) if len(data) >= 8 else zstandard.ZstdDecompressor()


def _writer(folder: str, path: str, shared, width: int) -> Callable:
    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard = TaskContext.get().partitionId()  # type: ignore[union-attr]
        press, index, docs, total = _compressor(shared.value), [], 0, 0
        fs, base = _open(folder)
        name, temp = f"{base}/shard-{shard:06d}.tok", f"{base}/.shard-{shard:06d}.{uuid.uuid4().hex}"
        with fs.open_output_stream(temp) as out:
            out.write(head := MAGIC + hashlib.sha256(shared.value).digest() + np.uint32(width).tobytes())
            at = len(head)
            for batch in store.batches(it, 2 << 20):
                entries = []
                for doc, ids in zip(batch.column("doc_id").to_pylist(), encoded(path, batch.column("text")), strict=True):
                    frame = press.compress(ids.astype(f"<u{width}").tobytes())
                    out.write(frame)
                    entries.append((doc is not None, doc or 0, at, len(frame), len(ids)))
                    at, total = at + len(frame), total + len(ids)
                docs += len(entries)
                index.append(np.array(entries, _ENTRY).tobytes())
            for x in index:
                out.write(x)
            out.write(np.array([docs, at], "<u8").tobytes() + INDEX)
        if not docs:
            fs.delete_file(temp)
            return
        fs.move(temp, name)
        yield pa.RecordBatch.from_arrays(
            [pa.array([shard], pa.int32()), pa.array([f"{folder}/shard-{shard:06d}.tok"]), pa.array([docs], pa.int64()), pa.array([total], pa.int64())],
            ["shard", "url", "docs", "ids"]
        )

    return run


_SHARDS = "shard int, url string, docs long, ids long"


def write(docs: DataFrame, folder: str | None = None, path: str | None = None, shards: int | None = None) -> DataFrame:
    """Writes `docs` (doc_id, text) and returns the shards: (shard, url, docs, ids), the folder's `dictionary` beside them."""
    spark = docs.sparkSession
    path, folder = path or default_tokenizer(), folder or store.lasting(spark, "tokens")
    width = 2 if tokenizer(path).get_vocab_size() <= 1 << 16 else 4
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    data = dictionary(rows, path, width)
    fs, base = _open(folder)
    fs.create_dir(base, recursive=True)
    with fs.open_output_stream(f"{base}/dictionary") as out:
        out.write(data)
    shared = spark.sparkContext.broadcast(data)
    size = rows.agg(F.sum(F.coalesce(F.octet_length("text"), F.lit(0)) + _ENTRY.itemsize)).first()[0] or 0
    # rows of one id (or of none) may lie in several shards, dealt by their texts' hashes
    order = ["doc_id", F.xxhash64("text")]
    dealt = rows.repartitionByRange(shards or store.parts(spark, size, SHARD_BYTES), *order).sortWithinPartitions(*order, "text")
    return store.written(dealt.transform(store.arrow, _writer(folder, path, shared, width), _SHARDS), "shards")


class Shard:
    """Reads a shard: its index at once, each document's frame when asked for."""

    def __init__(self, url: str, dictionary: bytes) -> None:
        fs, path = _open(url)
        self.file = fs.open_input_file(path)
        end = self.file.size()
        self.file.seek(end - 24)
        tail = self.file.read(24)
        self.file.seek(0)
        head = self.file.read(44)
        if tail[16:] != INDEX or head[:8] != MAGIC:
            raise ValueError(f"{url} is no complete shard")
        if head[8:40] != hashlib.sha256(dictionary).digest():
            raise ValueError(f"{url} was written with another dictionary")
        self.width = int.from_bytes(head[40:44], "little")
        n, at = np.frombuffer(tail[:16], "<u8")
        self.file.seek(int(at))
        self.index = np.frombuffer(self.file.read(int(n) * _ENTRY.itemsize), _ENTRY)
        self.press = _decompressor(dictionary)

    def ids(self, k: int) -> np.ndarray:
        return next(self.run(k, k + 1))

    def run(self, a: int, b: int) -> Iterator[np.ndarray]:
        """The ids of documents a to b, whose frames are read at once."""
        part = self.index[a:b]
        first, last = int(part["offset"][0]), int(part["offset"][-1] + part["length"][-1])
        self.file.seek(first)
        raw = self.file.read(last - first)
        for e in part:
            at = int(e["offset"]) - first
            ids = self.press.decompress(raw[at : at + int(e["length"])], max_output_size=int(e["ids"]) * self.width)
            yield np.frombuffer(ids, f"<u{self.width}").astype("<u4")


def read_dictionary(url: str) -> bytes:
    fs, path = _open(f"{url.rpartition('/')[0]}/dictionary")
    with fs.open_input_file(path) as f:
        return f.read()


def _reader(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in it:
        for url, start in zip(batch.column("url").to_pylist(), batch.column("start").to_pylist(), strict=True):
            shard = Shard(url, read_dictionary(url))
            ends = np.r_[shard.index["offset"][:1], shard.index["offset"] + shard.index["length"]].astype(np.int64)
            for a, b in K.slices(ends, READ_BYTES):
                part = shard.index[a:b]
                crc = [zlib.crc32(ids.tobytes()) for ids in shard.run(a, b)]
                n = part["ids"].astype(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(part["doc_id"].astype(np.int64), mask=part["known"] == 0), pa.array(start + np.cumsum(n) - n), pa.array(n), pa.array(crc, pa.int64())],
                    ["doc_id", "start", "n_tokens", "ids_crc32"]
                )
                start += int(n.sum())


def read_back(spark: SparkSession, shards: DataFrame) -> DataFrame:
    """Per document, from the files: doc_id, start (ids before it), n_tokens, ids_crc32."""
    rows = shards.orderBy("shard").collect()  # a row for each file
    starts = np.r_[0, np.cumsum([r.ids for r in rows])] if rows else []
    listed = spark.createDataFrame([(r.url, int(s)) for r, s in zip(rows, starts, strict=False)], "url string, start long")
    return listed.repartition(max(1, len(rows))).transform(store.arrow, _reader, "doc_id long, start long, n_tokens long, ids_crc32 long")


def report(docs: DataFrame, **options) -> DataFrame:
    return read_back(docs.sparkSession, write(docs, **options))
