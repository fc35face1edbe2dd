import random
import re

import pytest
from pyspark.sql import functions as F

from episodica.llm import mixing as M


def levels(sizes):
    """Targets by the rule: fix whoever is above three times its size, reshare the rest."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: k % 3 + 1 for k, s in enumerate(names)}
    fixed, total = {}, sum(sizes.values())
    while True:
        free = [s for s in names if s not in fixed]
        rest = total - sum(fixed.values())
        share = {s: rest * weight[s] / sum(weight[t] for t in free) for s in free}
        over = [s for s in free if share[s] > 3 * sizes[s]]
        if not over:
            return fixed | share
        fixed |= {s: 3.0 * sizes[s] for s in over}


@pytest.mark.parametrize("seed", range(3))
def test_targets_and_what_is_taken(llm, seed):
    rng = random.Random(seed)
    rows = [(k, " ".join(["w"] * rng.randrange(1, 30)), rng.choice(["a", "b", "b", "b", "c", "d", "é", None, "small"]) if k > 5 else "tiny") for k in range(900)]
    df = llm.createDataFrame(rows, "doc_id long, text string, source string").repartition(3)
    options = {"step": 4, "few": 0} if seed else {}
    out = M.mix(df, **options)
    got = {r.doc_id: r for r in out.collect()}
    sizes = {}
    for d, t, s in rows:
        assert got[d].size == len(t.split())
        sizes[s] = sizes.get(s, 0) + len(t.split())
    want = levels(sizes)
    for s in sizes:
        mine = [got[d] for d, _, x in rows if x == s]
        assert all(r.source_size == sizes[s] and r.target == pytest.approx(want[s]) and r.taken % r.size == 0 and r.taken <= 3 * r.size for r in mine)
        assert abs(sum(r.taken for r in mine) - want[s]) <= 1
    assert {r.doc_id: r.taken for r in M.mix(df.repartition(7), **options).collect()} == {d: r.taken for d, r in got.items()}


def test_inclusion_follows_the_probabilities(llm):
    """Over many sources that differ in their ids only, a document is in the sample as often as its size says."""
    rng = random.Random(11)
    size = [rng.choice([5, 10, 20, 40, 80]) for _ in range(120)] + [1500]
    rows = [(t * 1000 + k, " ".join(["w"] * n), f"s{t:03}") for t in range(240) for k, n in enumerate(size)]
    got = M.mix(llm.createDataFrame(rows, "doc_id long, text string, source string").repartition(4)).collect()
    # weights 1, 2, 3 of equal sources: half a source, the whole, and one and a half
    rest = sum(size) / 2
    share = (rest - 1500) / sum(n * n for n in size[:-1])  # the large one is certain
    assert share * 1500 > 1 > share * 80
    sampled = {n: [] for n in size}
    for r in got:
        t = r.doc_id // 1000
        if t % 3 != 1:
            sampled[r.size].append(r.copies - (t % 3 == 2))
        else:
            assert r.copies == 1
    assert all(set(x) <= {0, 1} for x in sampled.values()) and set(sampled[1500]) == {1}
    for n in (5, 10, 20, 40, 80):
        assert abs(sum(sampled[n]) / len(sampled[n]) - share * n) < 0.03, n


def test_one_larger_than_what_is_left(llm):
    rows = [(1, " ".join(["w"] * 10), "a"), (2, " ".join(["w"] * 10), "b"), (3, "w w w", "b")]
    got = {r.doc_id: r.taken for r in M.mix(llm.createDataFrame(rows, "doc_id long, text string, source string")).collect()}
    assert got == {1: 10, 2: 10, 3: 6}  # targets 23/3 and 46/3: ten words are nearer to the first than none


def test_the_mix_has_the_rows(edges):
    mixed = M.mixture(edges)
    want = sum(r.taken for r in M.mix(edges).collect())
    assert mixed.columns == edges.columns
    assert sum(len(re.findall(M.WORDS, r.text or "")) for r in mixed.collect()) == want


def test_edges(llm, edges, empty):
    rows = M.mix(edges).collect()
    assert len(rows) == edges.count() and all(r.size == r.taken == 0 for r in rows if r.doc_id in (0, 1, 2))
    assert M.mix(empty).count() == 0
    none = edges.withColumn("text", F.lit(None).cast("string"))
    assert {(r.target, r.taken) for r in M.mix(none).collect()} == {(0.0, 0)}
    same = llm.createDataFrame([(1, "a b c", "x")] * 10 + [(2, "a b", "y")] * 10, "doc_id long, text string, source string")
    got = M.mix(same).collect()
    assert len(got) == 20 and abs(sum(r.taken for r in got) - 50) <= 5
