import hashlib
import os
import random

import numpy as np
import pytest

from episodica.llm import suffix_dedup as S


@pytest.mark.parametrize("seed", range(5))
def test_two_stage_sort_and_common_prefixes(seed):
    rng = np.random.default_rng(seed)
    for _ in range(40):
        n, depth, letters = int(rng.integers(30, 300)), int(rng.integers(1, 30)), int(rng.integers(1, 5))
        t = (97 + rng.integers(0, letters, n)).astype(np.uint8)
        starts = np.flatnonzero(rng.random(n - depth) < 0.8)
        order, raw = S.two_stage_sort(t, starts, depth), t.tobytes()
        keys = [raw[i : i + depth] for i in order]
        assert sorted(order.tolist()) == starts.tolist() and keys == sorted(keys)
        assert S.common_prefixes(t, order, depth).tolist() == [len(os.path.commonprefix([a, b])) for a, b in zip(keys, keys[1:], strict=False)]


def test_equal_strings_share_an_anchor():
    rng = random.Random(1)
    passage = "".join(rng.choice("abcdef ") for _ in range(90))
    texts = ["".join(rng.choice("abcdef ") for _ in range(rng.randrange(200))) + passage + "".join(rng.choice("abcdef ") for _ in range(100)) for _ in range(20)]
    data, offsets = S.K.column_bytes(S.pa.array([t.encode() for t in texts], S.pa.binary()))
    rows, pos, h, first, last = S.anchors(data, offsets, 60, 20)
    starts = {}
    for r, p, x, a, b in zip(rows, pos, h, first, last, strict=True):
        assert a <= p <= b + 40 and b <= len(texts[r]) - 60
        for s in range(a, b + 1):
            assert (r, s) not in starts
            starts[r, s] = (int(x), int(p) - s)
    assert len(starts) == sum(len(t) - 59 for t in texts)
    by = {}
    for (r, s), v in starts.items():
        assert by.setdefault(texts[r][s : s + 60], v) == v


def brute(rows, length):
    raw = [(t or "").encode() for _, t in rows]
    count = {}
    for b in raw:
        for i in range(len(b) - length + 1):
            count[b[i : i + length]] = count.get(b[i : i + length], 0) + 1
    out = []
    for (d, _), b in zip(rows, raw, strict=True):
        gone = bytearray(len(b))
        for i in range(len(b) - length + 1):
            if count[b[i : i + length]] > 1:
                gone[i : i + length] = b"\1" * length
        kept = bytes(x for x, g in zip(b, gone, strict=True) if not g)
        out.append((d, len(b), sum(gone), sum(g and not (i and gone[i - 1]) for i, g in enumerate(gone)), hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


@pytest.mark.parametrize(("length", "gram", "options"), [(200, 64, {}), (30, 8, {}), (200, 64, {"most": 1}), (30, 8, {"most": 1, "hot": 100}), (30, 8, {"most": 8, "hot": 2000})])
def test_against_brute_force(llm, length, gram, options):
    rng = random.Random(length)
    text = lambda n: "".join(rng.choice("abcdeé \n") for _ in range(n))
    shared = [text(k) for k in (length - 5, length, length + 7, 3 * length)]
    texts = [text(rng.randrange(300)) + rng.choice(shared) + text(rng.randrange(200)) + rng.choice(shared) for _ in range(25)]
    texts += [texts[0], texts[0], "z" * 700, "xy" * 350, None, "", text(length - 1), shared[3] * 2]
    rows = list(enumerate(texts)) + [(3, texts[3]), (None, texts[5])]
    df = llm.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = sorted((tuple(r) for r in S.report(df, length=length, gram=gram, **options).collect()), key=str)
    assert got == brute(rows, length)


def test_long_texts_in_pieces(llm, monkeypatch):
    monkeypatch.setattr(S, "PIECE", 1000)
    rng = random.Random(7)
    long = "".join(rng.choice("abcdefgh ") for _ in range(9000))
    data, offsets = S.K.column_bytes(S.pa.array([long.encode(), long[100:500].encode()], S.pa.binary()))
    whole = S.anchors(data, offsets, 200, 64)
    assert sum(b - a + 1 for a, b in zip(whole[3][whole[0] == 0], whole[4][whole[0] == 0], strict=True)) >= 9000 - 199


def test_edges(edges, empty):
    rows = S.report(edges).collect()
    by = {r.doc_id: r for r in rows}
    assert len(rows) == edges.count() and (by[0].n_bytes, by[0].n_spans) == (0, 0) and by[11].n_removed == by[11].n_bytes and by[6].n_removed == by[6].n_bytes
    assert S.report(empty).count() == 0


def test_strings_of_one_hash_in_several_sorts():
    """Rows of one h are cut apart after every few; what was met before is met again."""
    rng = random.Random(2)
    kinds = [bytes(rng.choice(b"abc") for _ in range(20)) for _ in range(5)]
    rows = [(7, False, 1, k, 5 * k, rng.choice(kinds[:3])) for k in range(60)] + [(8, True, 2, 0, 0, kinds[3]), (8, False, 2, 1, 9, kinds[3]), (9, False, 3, 0, 0, kinds[4])]
    schema = S.pa.schema([("h", S.pa.int64()), ("many", S.pa.bool_()), ("key", S.pa.int64()), ("other", S.pa.int64()), ("start", S.pa.int64()), ("string", S.pa.binary())])
    batches = [S.pa.RecordBatch.from_pylist([dict(zip(schema.names, r, strict=True)) for r in rows[a : a + 11]], schema) for a in range(0, len(rows), 11)]
    count = {}
    for r in rows:
        count[r[0], r[5]] = count.get((r[0], r[5]), 0) + 1
    want = sorted((r[2], r[3], r[4]) for r in rows if count[r[0], r[5]] > 1 and not r[1])
    for at_once in (20 * 1000, 20 * 7, 40):
        got = sorted((r["key"], r["other"], x) for b in S._met(20, at_once)(iter(batches)) for r in b.to_pylist() for x in range(r["first"], r["last"] + 1))
        assert got == want
