import zlib

import numpy as np
import pyarrow as pa

from episodica.llm import kernel as K
from episodica.llm import language_id as L
from episodica.llm import toxicity as T


def brute(text, dims, gram):
    v = L._vectors(dims, gram)
    letters = [c.lower() if c.isalpha() and len(c.lower()) == 1 else c if c.isalpha() else " " for c in text]
    flat = " ".join(" ".join("".join(letters).split(" ")).split())
    if not flat:
        return np.zeros(dims)
    flat = f" {flat} "
    out = np.zeros(dims)
    for i in range(len(flat) - gram + 1):
        one = np.ones(dims)
        for k, c in enumerate(flat[i : i + gram]):
            one *= np.roll(v.of_letter(ord(c)), k)
        out += one
    return out


def test_bundles_are_the_definition():
    texts = ["Hello, World 12x", "", "...", "ÄÖ ß漢 \U0001f600 İx", "a", " the the THE "]
    got, lettered = L._vectors(256, 3).bundle(*K.column_bytes(pa.array(texts)))
    for g, t in zip(got, texts, strict=True):
        assert np.array_equal(g, brute(t, 256, 3)) or not t.strip(" .")
    assert lettered.tolist() == [True, False, False, True, True, True]


def test_language_of_held_out_rows(llm):
    docs = llm.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = L.report(docs).join(docs.select("doc_id", "lang"), "doc_id").collect()
    held = [r for r in rows if r.held_out]
    assert len(rows) == docs.count() and all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) and 0 <= r.score <= 1 for r in rows)
    assert sum(r.lang == r.lang_pred for r in held) >= 0.97 * len(held)


def test_every_language_value_is_learned(llm):
    from pyspark.sql import functions as F

    rng = np.random.default_rng(4)
    rows = [(k, " ".join("".join(chr(97 + c) for c in rng.integers(0, 26, 6)) for _ in range(12)), f"l{k:04d}") for k in range(1003)]
    docs = llm.createDataFrame(rows, "doc_id long, text string, lang string")
    got = {r.doc_id: r.lang_pred for r in L.report(docs, trains=F.lit(True), dims=128).collect()}
    assert got == {k: lang for k, _, lang in rows}


def test_letters_of_all_planes():
    assert L._vectors(64, 3).bundle(*K.column_bytes(pa.array(["\U00030000\U00031350", "\U000e0100"])))[1].tolist() == [True, False]


def test_language_edges(edges, empty):
    rows = L.report(edges).collect()
    assert len(rows) == edges.count()
    by = {r.doc_id: r for r in rows}
    assert all((by[k].lang_pred, by[k].score) == ("und", 0.0) for k in (0, 1, 2, 13)) and by[6].lang_pred != "und"
    kept = L.keep_known(edges)
    assert kept.columns == edges.columns and {0, 1, 2, 13}.isdisjoint({r.doc_id for r in kept.collect()})
    assert L.report(empty).count() == 0
    from pyspark.sql import functions as F

    assert {r.lang_pred for r in L.report(edges.withColumn("lang", F.lit(None).cast("string"))).collect()} == {"und"}


def test_features_are_the_definition():
    texts = ["You idiot, you", "", None, "a b", "x"]
    bounds, found = T.features(*K.column_bytes(pa.array(texts)), 20)
    assert np.diff(bounds).tolist() == [2 + 2 + 1, 0, 0, 3, 1]  # words, pairs, skips
    again = T.features(*K.column_bytes(pa.array(["you IDIOT you"])), 20)[1]
    assert np.array_equal(found[: bounds[1]], again)


def test_ftrl_against_scalar_steps():
    rng, m = np.random.default_rng(0), T.Ftrl(4, 0.5, 1.0, 0.1, 0.2)
    z, n = np.zeros(17), np.zeros(17)
    for _ in range(200):
        x, y = np.unique(rng.integers(0, 16, 4)), int(rng.integers(2))
        m.learn(x, y)
        w = [0.0 if abs(z[i]) <= 0.1 else -(z[i] - np.sign(z[i]) * 0.1) / ((1 + n[i] ** 0.5) / 0.5 + 0.2) for i in (*x, 16)]
        g = 1 / (1 + np.exp(-sum(w))) - y
        for i, wi in zip((*x, 16), w, strict=True):
            z[i] += g - ((n[i] + g * g) ** 0.5 - n[i] ** 0.5) / 0.5 * wi
            n[i] += g * g
    assert np.allclose(z, m.z) and np.allclose(n, m.n)


def test_toxicity_of_held_out_rows(llm):
    d = "/root/testdata/sf0.1"
    docs, labels = llm.read.parquet(f"{d}/documents.parquet"), llm.read.parquet(f"{d}/labels.parquet")
    some = docs.join(labels.select("doc_id"), "doc_id", "left_semi")
    rows = T.score(some, labels).join(labels, "doc_id").where("held_out").collect()
    bad, good = [r.score for r in rows if r.toxic == 1], [r.score for r in rows if r.toxic == 0]
    assert np.mean(np.array(bad)[:, None] > np.array(good)[None]) > 0.95
    assert sum(r.predicted for r in rows if r.toxic == 0) <= 0.01 * len(good) and sum(r.predicted for r in rows if r.toxic == 1) >= 0.6 * len(bad)


def test_toxicity_edges(llm, edges, empty):
    labels = llm.createDataFrame([(6, 1, 1), (6, 1, 0), (0, 1, 1), (None, 1, 1), (10, 0, None), (14, 0, 0)], "doc_id long, quality int, toxic int")
    rows = T.score(edges, labels).collect()
    assert len(rows) == edges.count() and len({r.score for r in rows if r.doc_id in (0, 1, 2)}) == 1
    assert {r.score for r in T.score(edges, labels.where("false")).collect()} == {0.5} and T.score(empty, labels).count() == 0
