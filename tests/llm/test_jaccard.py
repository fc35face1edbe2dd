import random
import re

import numpy as np
import pytest

from episodica.llm import jaccard_join as J
from episodica.llm.components import components

PATTERN = re.compile(r"[^\x20\x09-\x0D]+")


def brute(rows, percent=85):
    sets = {}
    for d, t in rows:
        w = PATTERN.findall(re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
        sets[d] = frozenset(tuple(w[k : k + 4]) for k in range(len(w) - 3)) if len(w) > 3 else frozenset([tuple(w)] if w else [])
    up = {d: d for d in sets}

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[:i]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
                x, y = root(a), root(b)
                up[max(x, y)] = min(x, y)
    return {d: (len(s), root(d)) for d, s in sets.items()}


def family(rng, base, n, most):
    out = []
    for _ in range(n):
        w = base[:]
        for _ in range(rng.randrange(most)):
            w[rng.randrange(len(w))] = f"x{rng.randrange(9999)}"
        out.append(" ".join(w))
    return out


@pytest.mark.parametrize("options", [{}, {"chunk": 600}, {"chunk": 60}, {"long": 3}, {"long": 0, "chunk": 500}])
def test_against_brute_force(llm, options):
    rng = random.Random(9)
    texts = []
    for size, n in ((120, 30), (60, 20), (300, 10)):
        texts += family(rng, [f"w{rng.randrange(10**6)}" for _ in range(size)], n, 9)
    shared = " ".join(f"s{k}" for k in range(12))
    texts += [shared + " " + " ".join(f"u{rng.randrange(10**6)}" for _ in range(rng.randrange(30))) for _ in range(25)] + [shared] * 6 + ["a b", "A B", "a", "", None]
    rng.shuffle(texts)
    rows = list(enumerate(texts))
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in J.near_duplicates(llm.createDataFrame(rows, "doc_id long, text string").repartition(4), **options).collect()}
    assert got == brute(rows)


def test_a_large_family_links_as_pairs_do(llm):
    rng = random.Random(3)
    rows = list(enumerate(family(rng, [f"w{k}" for k in range(150)], 400, 14)))
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in J.near_duplicates(llm.createDataFrame(rows, "doc_id long, text string"), chunk=64 * 147).collect()}
    assert got == brute(rows)


@pytest.mark.parametrize("chunk", [1 << 20, 3000])
def test_families_of_several_clusters(llm, chunk):
    """Texts that share a passage, so that they are one family, in clusters of near copies that don't reach one another."""
    rng = random.Random(6)
    shared, texts = [f"s{k}" for k in range(30)], []
    for _ in range(12):
        own = [f"o{rng.randrange(10**6)}" for _ in range(25)]
        texts += family(rng, own + shared, 12, 4)
    rng.shuffle(texts)
    rows = list(enumerate(texts))
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in J.near_duplicates(llm.createDataFrame(rows, "doc_id long, text string").repartition(3), chunk=chunk, long=0).collect()}
    assert got == brute(rows)


def test_long_lists_are_skipped_like_packed_ones(llm):
    """Lists built by a join hold the same families as packed ones, for sets of many sizes that share shingles."""
    rng, texts = random.Random(9), []
    for g in range(30):
        words = [f"g{g}_{k}" for k in range(70)]
        texts += family(rng, words[:40], 4, 2) + [" ".join(words[: rng.randrange(5, 70)]) for _ in range(6)]
    rows = llm.createDataFrame([(t,) for t in texts], "text string").repartition(4)
    for percent in (60, 85):
        joined, packed = ({tuple(r) for r in J.family_members(rows, 4, percent, 3, long).collect()} for long in (0, J.LONG))
        assert joined == packed and len(packed) > 20


def test_overlaps_are_derived(monkeypatch):
    """Chains of sets: what is derived from an answer is what a count says, and most is."""
    rng = np.random.default_rng(3)
    sets, counted, derived = [], [0], [0]
    for _ in range(5):
        x = set(rng.integers(0, 4000, 120).tolist())
        for _ in range(40):
            sets.append(x)
            x = set(x)
            for _ in range(4):
                x.discard(next(iter(x)))
                x.add(int(rng.integers(0, 4000)))
    found = np.concatenate([np.array(sorted(s), np.uint64) for s in sets])
    bounds = np.r_[0, np.cumsum([len(s) for s in sets])]
    count, differences = J._Overlaps.count, J._Overlaps.differences

    def spy(self, codes):
        counted[0] += len(codes)
        return count(self, codes)

    monkeypatch.setattr(J._Overlaps, "count", spy)
    monkeypatch.setattr(J._Overlaps, "differences", lambda self, x, base: derived.__setitem__(0, derived[0] + 1) or differences(self, x, base))
    label, _ = J.family_links(np.arange(len(sets)), bounds, found, 85)
    root = list(range(len(sets)))
    for i, a in enumerate(sets):
        for k in range(i):
            if 100 * len(a & sets[k]) >= 85 * len(a | sets[k]):
                x, y = root[i], root[k]
                root = [min(x, y) if r in (x, y) else r for r in root]
    same = lambda of: [[j for j in range(len(of)) if of[j] == of[i]] for i in range(len(of))]
    assert same(label.tolist()) == same(root) and derived[0] > 50 and counted[0] < len(found) / 2


def test_a_large_family_of_near_copies_is_linear(llm, monkeypatch):
    """Sets connected to the pivot meet once, whatever the number of chunks."""
    rng, shipped = random.Random(5), []
    rows = list(enumerate(family(rng, [f"w{k}" for k in range(150)], 300, 2)))
    write = J.store.written
    monkeypatch.setattr(J.store, "written", lambda df, name: shipped.append(name) or write(df, name))
    got = J.near_duplicates(llm.createDataFrame(rows, "doc_id long, text string"), chunk=20 * 147)
    assert {r.component_id for r in got.collect()} == {0} and shipped.count("links") == 1


def test_driver_s_table(llm, docs):
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in J.near_duplicates(docs).collect()}
    assert got == brute([(r.doc_id, r.text) for r in docs.collect()])


def test_edges(edges, empty):
    rows = J.near_duplicates(edges).collect()
    by = {r.doc_id: r for r in rows if r.doc_id is not None}
    assert len(rows) == edges.count() and [by[k].component_id for k in (0, 1, 2, 3, 4, 6, 7, 8, 9)] == [0, 1, 2, 3, 3, 6, 6, 6, 6]
    assert {r.component_id for r in rows if r.doc_id is None} == {6, None} and by[0].n_shingles == 0
    kept = J.keep_one(edges)
    ids = [r.doc_id for r in kept.collect()]
    assert kept.columns == edges.columns and 7 not in ids and 6 in ids and {0, 1, 2} <= set(ids)
    assert J.near_duplicates(empty).count() == 0


def test_keep_one_keeps_rows_without_id(llm, edges):
    rng = random.Random(8)
    base, other, third = ([f"{c}{rng.randrange(10**6)}" for _ in range(100)] for c in "abc")
    near = lambda w, c: " ".join([*w, f"{c}{rng.randrange(10**6)}"])
    rows = [
        (42, "", "empty"), (None, "", "empty, no id"), (None, " \t\n", "blank"), (None, None, "null"), (None, None, "null again"),
        (None, "only here", "alone"), (None, "Only  HERE", "its equal set"), (None, "only here", "its copy"), (-5, " ".join(base), "head"), (9, near(base, "x"), "near"), (
            None,
            near(base, "y"),
            "near, no id"
        ),
        (None, " ".join(base), "equal, no id"), (None, " ".join(other), "pair"), (None, near(other, "z"), "pair"), (2**63 - 1, " ".join(third), "largest id"), (
            None,
            near(third, "v"),
            "near the largest"
        ),
    ]
    docs = llm.createDataFrame(rows, "doc_id long, text string, name string").repartition(3)
    kept = [r.name for r in J.keep_one(docs).collect()]
    alone = [n for n in kept if n in ("alone", "its equal set", "its copy")]
    assert len(alone) == 1 and sorted(set(kept) - set(alone)) == sorted({"empty", "empty, no id", "blank", "null", "null again", "head", "pair", "largest id"})
    assert kept.count("pair") == 1 and len(kept) == 9
    out = J.keep_one(edges)
    assert out.columns == edges.columns and [r.text for r in out.where("doc_id is null").collect()] == [None]
    assert J.keep_one(docs.where("doc_id is null")).where("name = 'pair'").count() == 1


def test_components_of_long_chains(llm):
    rng = random.Random(0)
    order = rng.sample(range(300), 300)
    edges = [(a, b) for a, b in zip(order[:199], order[1:200], strict=True)] + [(a, b) for a, b in zip(order[200:-1], order[201:], strict=True)] + [(5, 5), (None, 3)]
    got = {r.node: r.root for r in components(llm.createDataFrame(edges, "a long, b long")).collect()}
    x, y = min(order[:200]), min(order[200:])
    assert got == {k: x for k in order[:200] if k != x} | {k: y for k in order[200:] if k != y}
    assert components(llm.createDataFrame([], "a long, b long")).count() == 0
