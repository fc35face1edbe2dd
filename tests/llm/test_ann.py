import numpy as np
import pytest

from episodica.llm import ann as A


def test_index_finds_every_code_within_the_radius():
    rng = np.random.default_rng(0)
    for m, spread in ((1, 16), (3, 4), (8, 2), (8, 16)):
        codes = rng.integers(0, 1 << spread, (500, m)).astype(np.uint16)
        index = A.Index(codes)
        for radius in (0, 1, m - 1, m, 2 * m + 1, 3 * m + 2, 7 * m, 16 * m):
            q = rng.integers(0, 1 << spread, m).astype(np.uint16)
            want = np.flatnonzero(np.bitwise_count(codes ^ q).sum(axis=1) <= radius)
            assert np.array_equal(index.within(q, radius), want)


def exact(rows, k=5):
    ids, x = np.array([r[0] for r in rows]), np.array([r[1] for r in rows], float)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    out = {}
    for i, q in enumerate(ids.tolist()):
        if q % 50 == 0:
            s = x @ x[i]
            order = [j for j in np.lexsort((ids, -s)) if ids[j] != q][:k]
            out[q] = [(int(ids[j]), float(s[j])) for j in order]
    return out


def recall(found, want):
    got = {}
    for r in found.collect():
        got.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    assert set(got) == set(want)
    for q, rows in got.items():
        rows.sort()
        assert [r[0] for r in rows] == list(range(1, len(want[q]) + 1)) and [r[2] for r in rows] == sorted((r[2] for r in rows), reverse=True)
    return sum(len({v for _, v, _ in got[q]} & {v for v, _ in want[q]}) for q in want) / sum(map(len, want.values()))


@pytest.mark.parametrize("options", [{}, {"block_bytes": 1500}, {"sample": 60}])
def test_recall(llm, options):
    df = llm.read.parquet("/root/testdata/sf0.01/embeddings.parquet")
    assert recall(A.nearest(df, df.where("vec_id % 50 = 0"), **options), exact([(r.vec_id, r.embedding) for r in df.collect()])) >= 0.9


def shapes():
    rng = np.random.default_rng(4)
    centres = rng.normal(size=(300, 48))
    return {
        "clustered": np.repeat(centres, 20, axis=0) + 0.15 * rng.normal(size=(6000, 48)),
        "offset": rng.normal(size=(4000, 20)) + 6,
        "few axes": rng.normal(size=(4000, 6)) @ rng.normal(size=(6, 80)) + 0.02 * rng.normal(size=(4000, 80)),
        "short": rng.normal(size=(3000, 3)),
    }


@pytest.mark.parametrize("name", sorted(shapes()))
@pytest.mark.parametrize("sample", [A.SAMPLE, 1000])
def test_recall_and_what_is_probed(llm, name, sample):
    x = shapes()[name]
    rows = list(enumerate(x.tolist()))
    df = llm.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(3)
    assert recall(A.nearest(df, df.where("vec_id % 50 = 0"), sample=sample), exact(rows)) >= 0.9
    if name == "clustered":  # what a query retrieves before codes are compared
        model = A.Codes(x[:: len(x) // 1000], A.RECALL)
        index, q = A.Index(model.encode(x)), np.arange(0, len(x), 50)
        _, radii = A.first_radii(model, q, x[q], np.arange(len(x)), x, 5)
        for j, r in zip(q, radii, strict=True):
            index.within(index.codes[j], r)
        assert index.probed < 0.2 * len(q) * len(x)


def test_edges(llm):
    nan, inf = float("nan"), float("inf")
    rows = [
        (0, [1.0, 0.0, 0.0]), (1, None), (2, [0.0, 0.0, 0.0]), (3, [nan, 1.0, 1.0]), (4, [inf, 1.0, 1.0]), (5, [None, 1.0, 1.0]), (6, [2.0, 0.0, 0.0]),
        (7, [2.0, 0.0, 0.0]), (8, [0.0, 1.0, 0.0]), (9, [1.0]), (None, [1.0, 1.0, 1.0]), (10, []), (50, None)
    ]
    df = llm.createDataFrame(rows, "vec_id long, embedding array<double>").selectExpr("*", "1 as rank", "'x' as score", "2 as v")
    got = sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in A.nearest(df, df.where("vec_id % 50 = 0")).collect())
    assert got == [(0, 1, 6, 1.0), (0, 2, 7, 1.0), (0, 3, 8, 0.0)]
    assert A.nearest(df.where("false"), df).count() == 0 and A.nearest(df, df.where("vec_id = 1")).count() == 0
    one = df.where("vec_id = 0")
    assert A.nearest(one, one).count() == 0


@pytest.mark.parametrize("scale", [1e200, 1e-170, 5e-320, 1.0])
def test_components_of_any_magnitude(llm, scale):
    x = np.random.default_rng(7).normal(size=(400, 12))
    rows = [(k, (v * (scale if k % 2 else 1.0)).tolist()) for k, v in enumerate(x)]
    df = llm.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(3)
    want = exact([(k, np.ldexp(v, -np.frexp(np.abs(v).max())[1])) for k, v in rows])
    found = A.nearest(df, df.where("vec_id % 50 = 0"))
    assert recall(found, want) >= 0.9
    known = {(q, v): s for q, near in exact([(k, np.ldexp(v, -np.frexp(np.abs(v).max())[1])) for k, v in rows], 399).items() for v, s in near}
    assert all(abs(r.score - known[r.query_id, r.vec_id]) < 1e-12 for r in found.collect())


def test_lengths_and_repeated_queries(llm):
    """Vectors are mostly of two components, queries mostly of three; one query stands twice."""
    rows = [(1, [1.0, 0.0]), (2, [0.9, 0.1]), (3, [0.0, 1.0]), (50, [1.0, 0.2]), (50, [0.0, 1.0]), (100, [1.0, 0.0, 0.0]), (150, [1.0, 1.0, 0.0])]
    df = llm.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = [(r.query_id, r["rank"], r.vec_id) for r in A.nearest(df, df.where("vec_id % 50 = 0")).orderBy("query_id", "rank").collect()]
    assert got == [(50, 1, 3), (50, 2, 2), (50, 3, 1)]
    same = llm.createDataFrame([(k, [1.0, 1.0, 0.0]) for k in range(0, 40, 10)] + [(50, [1.0, 1.0, 0.0])], "vec_id long, embedding array<double>")
    assert [r.vec_id for r in A.nearest(same, same.where("vec_id = 50")).orderBy("rank").collect()] == [0, 10, 20, 30]
