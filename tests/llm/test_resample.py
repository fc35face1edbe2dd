import hashlib
import math
import random
import re
import zlib

import pytest

from episodica.llm import resample as R

PATTERN = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def features(text, order):
    w = PATTERN.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return [" ".join(w[i : i + k]) for k in range(1, order + 1) for i in range(len(w) - k + 1)], len(w)


def brute(docs, target, order=1, buckets=10_000, least=20, percent=10, seed=2024):
    number = lambda f: zlib.crc32(f.encode()) % buckets
    s, t = {}, {}
    for rows, c in ((docs, s), (target, t)):
        for _, text in rows:
            for f in features(text, order)[0]:
                c[number(f)] = c.get(number(f), 0) + 1
    total, aim = sum(s.values()) + buckets, sum(t.values()) + buckets
    gain = lambda b: math.floor(1000 * math.log((t.get(b, 0) + 1) * total / ((s.get(b, 0) + 1) * aim)))
    out = []
    for i, text in docs:
        f, n = features(text, order)
        w = sum(gain(number(x)) for x in f)
        h = int(hashlib.sha256(f"{seed}:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        out.append([i, n, len(f), w, w + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None])
    able = sorted((r for r in out if r[1] >= least), key=lambda r: (-r[4], r[0] is not None, r[0]))
    for k, r in enumerate(able[: len(able) * percent // 100]):
        r[5] = k + 1
    return sorted(map(tuple, out), key=repr)


@pytest.mark.parametrize("options", [{}, {"order": 3, "buckets": 500, "percent": 30}, {"order": 2, "least": 0}])
def test_against_brute_force(llm, options):
    rng = random.Random(3)
    known = [f"Wo{k}é" if k % 3 else f"B{k}" for k in range(300)]
    text = lambda n, m=300: " ".join(rng.choice(known[:m]) for _ in range(n))
    docs = [(k, text(rng.randrange(60))) for k in range(300)] + [(None, None), (None, text(30)), (7, "x-y Z " * 10), (400, ""), (401, "!!"), (402, text(9000))]
    target = [(k, text(30, 60)) for k in range(20)] + [(99, None)]
    got = R.draw(llm.createDataFrame(docs, "doc_id long, text string").repartition(4), llm.createDataFrame(target, "item_id long, text string"), **options)
    assert sorted((tuple(r) for r in got.collect()), key=repr) == brute(docs, target, **options)


def test_windows_hold_a_piece_at_most(llm):
    """A row longer than a piece, cut between any two words, has the same features."""
    docs = llm.createDataFrame([(1, " ".join(f"w{k % 7}" for k in range(50)))], "row long, text string")
    whole = sorted(r.feature for r in R.features(docs, 3).collect())
    for piece in (1, 2, 3, 7, 49, 50, 51):
        assert sorted(r.feature for r in R.features(docs, 3, piece).collect()) == whole


def test_edges(llm, edges, empty):
    target = llm.createDataFrame([(1, "one two three"), (2, None)], "item_id long, text string")
    out = R.report(edges, target)
    assert out.columns == ["doc_id", "n_features", "weight", "score", "rank"] and out.count() == edges.count()
    assert all((r.n_features, r.weight, r.rank) == (0, 0, None) for r in out.where("doc_id in (0, 1, 2)").collect())
    assert R.report(empty, target).count() == 0
    assert R.report(edges, target.where("false")).count() == edges.count()
    top = R.drawn(edges, target, percent=100, least=1).collect()
    assert sorted(r["rank"] for r in top) == list(range(1, len(top) + 1))
