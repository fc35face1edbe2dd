import collections
import math
import re
import zlib

import numpy as np
import pytest

from episodica.llm import lm_score as M

PATTERN = re.compile(r"[^\x20\x09-\x0D]+")


def tokens(text):
    return [*PATTERN.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or "")), None]


def model(rows, weights, order):
    """Straight from the definition, with given weights."""
    train = [tokens(t) for d, t in rows if zlib.crc32(str("" if d is None else d).encode()) % 10]
    c1 = collections.Counter(w for t in train for w in t)
    c2 = collections.Counter((v, w) for t in train for v, w in zip([None, *t], t, strict=False))
    c3 = collections.Counter(x for t in train for x in zip([None, *t], t, t[1:], strict=False))
    n, v = sum(c1.values()), len(c1)
    out = []
    bucket = lambda c: int(M.bucket(np.array([c]))[0])
    for d, t in rows:
        base = score = 0.0
        words = tokens(t)
        for k, w in enumerate(words):
            a = words[k - 1] if k else None
            two = (words[k - 2] if k > 1 else None, a) if k else None  # the two words before the token
            seen = c2[two] if order == 3 and k else 0
            q = weights[M.BUCKETS + bucket(seen) if seen else bucket(c1[a])][::-1]
            base += math.log10((c1[w] + 0.1) / (n + 0.1 * (v + 1)))
            p = q[2] * c2[a, w] / max(c1[a], 1) + q[1] * c1[w] / max(n, 1) + q[0] / (v + 1)
            if seen:
                p += q[3] * c3[*two, w] / seen
            score += math.log10(p if n else 1 / (v + 1))
        out.append((d, zlib.crc32(str("" if d is None else d).encode()) % 10 == 0, len(words), sum(c1[w] > 0 for w in words), n, base, score))
    return sorted(out, key=str)


@pytest.mark.parametrize(("block", "order"), [(M.BLOCK, 2), (3000, 2), (3000, 3)])
def test_against_the_definition(llm, docs, edges, monkeypatch, block, order):
    fitted = []
    fit = M.fit_weights
    monkeypatch.setattr(M, "fit_weights", lambda *a: fitted.append(fit(*a)) or fitted[-1])
    monkeypatch.setattr(M, "BLOCK", block)
    for df in (docs, edges):
        got = sorted((tuple(r) for r in M.score(df, order=order).collect()), key=str)
        want = model([(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()], fitted[-1], order)
        assert len(got) == len(want)
        for g, w in zip(got, want, strict=True):
            assert g[:5] == w[:5] and g[5] == pytest.approx(w[5], rel=1e-9, abs=1e-9) and g[6] == pytest.approx(w[6], rel=1e-9, abs=1e-9)


def test_longer_n_grams_score_better(llm):
    df = llm.read.parquet("/root/testdata/sf0.01/documents.parquet")
    two, three = (sum(r.score for r in M.score(df, order=k).where("held_out").collect()) for k in (2, 3))
    assert three > two


def test_sums_in_sub_ranges():
    rng = np.random.default_rng(1)
    keys = [np.sort(rng.choice(5000, n, replace=False)).astype(np.uint64) * np.uint64(10**15) for n in (3000, 1, 0, 2500, 40)]
    counts = [rng.integers(0, 3, len(k)) for k in keys]
    whole, parts = M.summed(keys, counts, 10**9), M.summed(keys, counts, 100)
    total = collections.Counter()
    for k, n in zip(keys, counts, strict=True):
        total.update(dict(zip(k.tolist(), n.tolist(), strict=True)))
    for found in (whole, parts):
        assert found[1:] == (sum(total.values()), sum(x > 0 for x in total.values()))
        assert all(a.tolist() == [total[x] for x in k.tolist()] for a, k in zip(found[0], keys, strict=True))


def test_weights_rise_to_the_likeliest():
    cells = np.array([(3 * M._span(2) + 5) * M._span(2) + 40, 3 * M._span(2) * M._span(2) + 30, 3 * M._span(2) * M._span(2)])
    n, v = np.array([50.0, 30.0, 20.0]), 1000
    w = M.fit_weights(cells, n, v, 2, 400)[3]
    back = lambda c: 2.0 ** (-(c - 1) / M.FINE[2]) if c else 0.0
    like = lambda q: sum(k * math.log(q[0] * back(c // M._span(2) % M._span(2)) + q[1] * back(c % M._span(2)) + q[2] / (v + 1)) for c, k in zip(cells.tolist(), n, strict=True))
    rng = np.random.default_rng(0)
    assert abs(w.sum() - 1) < 1e-9 and all(like(w) >= like(rng.dirichlet([1, 1, 1])) - 1e-6 for _ in range(300))


def test_better_than_the_base_on_held_out(llm):
    rows = M.score(llm.read.parquet("/root/testdata/sf0.01/documents.parquet")).where("held_out").collect()
    assert sum(r.score for r in rows) > sum(r.base_score for r in rows)


def test_empty_and_untrained(llm, empty):
    assert M.score(empty).count() == 0
    held = next(k for k in range(1000) if zlib.crc32(str(k).encode()) % 10 == 0)
    r = M.score(llm.createDataFrame([(held, "a b")], "doc_id long, text string")).first()
    assert (r.train_tokens, r.n_tokens, r.n_known, r.score) == (0, 3, 0, 0.0)


def test_packing():
    keys = np.sort(np.random.default_rng(0).integers(0, 2**64, 1000, dtype=np.uint64))
    assert np.array_equal(M._open_keys(M._press_keys(keys)), keys) and M._open_keys(M._press_keys(keys[:0])).size == 0
    for x in (np.array([0, 5]), np.array([300]), np.array([1 << 40]), np.zeros(0, int)):
        assert M._open(M._press(x)).tolist() == x.tolist()
