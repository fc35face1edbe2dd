import random
import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

from episodica.llm import token_output as O


plain = Tokenizer.from_file


@pytest.mark.parametrize("alphabet", [" \t\n\r''stveml_1a9zéñß.,-!?  ", " \n²ſİ \x85\x1c\xa0漢😀a'b,", "ab ,."])
def test_encoding_is_the_library_s(alphabet):
    rng, path = random.Random(1), O.default_tokenizer()
    texts = ["".join(rng.choice(alphabet) for _ in range(rng.randrange(80))) for _ in range(3000)] + [
        "<|endoftext|> a", "The end. <|endoftext|> Next one", "a<|endoftext|>b c", "<|endoftext|", "", " ", "a" * 3000
    ]
    want = [e.ids + [0] for e in plain(path).encode_batch(texts, add_special_tokens=False)]
    assert [x.tolist() for x in O.encoded(path, texts)] == want


def test_pieces_join_without_changing_ids():
    rng, t = random.Random(2), plain(O.default_tokenizer())
    text = "".join(rng.choice("ab c\n é1.'") for _ in range(4000))
    parts = O.pieces(text, 50)
    assert "".join(parts) == text and len(parts) > 20
    assert [i for p in parts for i in t.encode(p, add_special_tokens=False).ids] == t.encode(text, add_special_tokens=False).ids
    assert O.pieces("x" * 200, 50) == ["x" * 200]


def test_an_added_token_is_its_id():
    path, end = O.default_tokenizer(), Tokenizer.from_file(O.default_tokenizer()).token_to_id("<|endoftext|>")
    text = "some words here " * 40 + "<|endoftext|>" + " and some more" * 40
    (got,) = O.encoded(path, [text])
    assert got.tolist() == plain(path).encode(text, add_special_tokens=False).ids + [0] and got.tolist().count(end) == 1
    long, parts = text * 3, O.pieces(text * 3, 100)
    assert len(parts) > 10 and [i for p in parts for i in plain(path).encode(p, add_special_tokens=False).ids] == plain(path).encode(long, add_special_tokens=False).ids


def test_the_dictionary_comes_from_whole_texts(llm):
    """A text of one long document and pieces from all over it."""
    words = [f"w{k}" for k in range(30_000)]
    docs = llm.createDataFrame([(1, " ".join(words))], "doc_id long, text string")
    made = docs.select("text").transform(O.store.arrow, O._sampled(O.default_tokenizer(), 2, 1.0), "ids binary").collect()
    whole = O.encoded(O.default_tokenizer(), [" ".join(words)])[0].astype("<u2").tobytes()
    assert b"".join(r.ids for r in made) == whole and len(made) > 5
    part = docs.select("text").transform(O.store.arrow, O._sampled(O.default_tokenizer(), 2, 0.5), "ids binary").collect()
    assert 0 < len(part) < len(made) and any(r.ids != made[0].ids for r in part)


def test_round_trip(llm, docs, tmp_path):
    shards = O.write(docs, f"file://{tmp_path}/t", shards=5)
    rows, t = sorted(docs.collect(), key=lambda r: r.doc_id), plain(O.default_tokenizer())
    want, start = [], 0
    for r in rows:
        ids = np.array(t.encode(r.text, add_special_tokens=False).ids + [0], "<u4")
        want.append((r.doc_id, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    assert sorted(tuple(r) for r in O.read_back(llm, shards).collect()) == want
    one = shards.orderBy("shard").first()
    shard = O.Shard(one.url, O.read_dictionary(one.url))
    k = len(shard.index) // 2  # a single document, by its offset
    assert (int(shard.index[k]["doc_id"]), zlib.crc32(shard.ids(k).tobytes())) == (want[k][0], want[k][3])
    with pytest.raises(ValueError, match="another dictionary"):
        O.Shard(one.url, b"other dictionary")
    path = one.url.removeprefix("file://")
    with open(path, "rb") as f:
        data = f.read()
    with open(f"{path}.cut", "wb") as f:
        f.write(data[:-3])
    with pytest.raises(ValueError, match="complete"):
        O.Shard(f"{one.url}.cut", O.read_dictionary(one.url))
    assert not list((tmp_path / "t").glob(".shard*"))


def test_shards_grow_with_the_input_and_split_one_id(llm, tmp_path, monkeypatch):
    """As many shards as the texts' bytes ask for, though most rows have no id; frames are read in runs."""
    monkeypatch.setattr(O, "SHARD_BYTES", 2000)
    monkeypatch.setattr(O, "READ_BYTES", 300)
    rows = [(None if k % 3 else k, f"text number {k} " * (k % 9)) for k in range(600)]
    shards = O.write(llm.createDataFrame(rows, "doc_id long, text string").repartition(3), f"file://{tmp_path}/t")
    held = [r.docs for r in shards.collect()]
    assert len(held) > 20 and sum(held) == 600 and max(held) < 100
    encode = plain(O.default_tokenizer()).encode
    ids = [(d, np.array(encode(t, add_special_tokens=False).ids + [0], "<u4")) for d, t in rows]
    key = lambda r: (r[0] is not None, r[0] or 0, *r[1:])
    got = O.read_back(llm, shards).collect()
    assert sorted(((r.doc_id, r.n_tokens, r.ids_crc32) for r in got), key=key) == sorted(((d, len(x), zlib.crc32(x.tobytes())) for d, x in ids), key=key)
    got.sort(key=lambda r: r.start)
    assert [r.doc_id for r in got] == sorted((r.doc_id for r in got), key=lambda x: (x is not None, x or 0))
    assert all(b.start == a.start + a.n_tokens for a, b in zip(got, got[1:], strict=False))


def test_edges(edges, empty):
    rows = O.report(edges).collect()
    assert len(rows) == edges.count() and [r.n_tokens for r in rows if r.doc_id in (0, 1)] == [1, 1]
    got = sorted(rows, key=lambda r: r.start)
    assert [r.doc_id for r in got] == sorted((r.doc_id for r in got), key=lambda x: (x is not None, x or 0))
    assert all(b.start == a.start + a.n_tokens for a, b in zip(got, got[1:], strict=False))
    assert O.report(empty).count() == 0
