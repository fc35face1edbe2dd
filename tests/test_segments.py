import random

import pytest

from episodica.operators import horizon, index, segments, subset


def _frames(seed):
    rng = random.Random(seed)
    rows, n = [], 0
    for e in range(rng.randint(1, 6)):
        for p in range(rng.randint(1, 60)):
            rows.append((e * 3, p, n, rng.choice([0, 0, 0, 1, 2]) if rng.random() < 0.4 else e % 3))
            n += 1
    return rows


def _runs(values):
    out = []
    for i, v in enumerate(values):
        if not out or out[-1][0] != v:
            out.append([v, i, i + 1])
        out[-1][2] = i + 1
    return [tuple(r) for r in out]


@pytest.mark.parametrize("seed", range(4))
def test_against_loops(spark, seed):
    rows = _frames(seed)
    df = spark.createDataFrame(random.Random(seed).sample(rows, len(rows)), "episode_index long, frame_index long, index long, subtask_index long").repartition(3)
    by = {}
    for e, _, _, s in sorted(rows):
        by.setdefault(e, []).append(s)
    order = ["frame_index"]
    found = {(r.episode_index, r.subtask_index, r.start_frame, r.end_frame) for r in segments.run_segments(df, "subtask_index", order).collect()}
    assert found == {(e, *r) for e, v in by.items() for r in _runs(v)}
    assert {r.episode_index: list(r["values"]) for r in segments.run_values(df, "subtask_index", order).collect()} == {e: [r[0] for r in _runs(v)] for e, v in by.items()}
    assert {r.episode_index: list(r["values"]) for r in segments.first_seen(df, "subtask_index", order).collect()} == {e: list(dict.fromkeys(v)) for e, v in by.items()}
    for h in (1, 2, 3, 10, 40):
        want = set()
        for e, v in by.items():
            for p in range(len(v) - h + 1):
                later = [k for k in range(1, h) if v[p + k] != v[p]]
                if later:
                    want.add((e, p, later[0], v[p + later[0]]))
        got = {(r.episode_index, r.frame_index, r.first_next_offset, r.next_subtask_index) for r in horizon.boundary_starts(df, "subtask_index", order, h).collect()}
        assert got == want
        s = horizon.boundary_stats(df, "subtask_index", order, h).first()
        assert [r for r in horizon.boundary_stats(df, "subtask_index", order, 7, h, 1).collect() if r.horizon == h][0] == s
        assert (s.frames, s.crossing_starts, s.boundaries) == (len(rows), len(want), sum(len(_runs(v)) - 1 for v in by.values()))


@pytest.mark.parametrize("seed", range(3))
def test_islands_are_the_anti_join(spark, seed):
    rows = _frames(seed + 50)
    df = spark.createDataFrame(rows, "episode_index long, frame_index long, index long, subtask_index long")
    drop = spark.createDataFrame([(0, 1), (3, 0), (99, 0)], "episode_index long, subtask_index long")
    kept = subset.islands(subset.flagged(df, drop, ["frame_index"]))
    found = subset.segments(kept)
    out = sorted(subset.reindexed(kept, found, 15.0).collect(), key=lambda r: r.new_index)
    want = [r for r in sorted(rows) if (r[0], r[3]) not in {(0, 1), (3, 0)}]
    assert [(r.episode_index, r.pos) for r in out] == [(r[0], r[1]) for r in want]
    assert [r.new_index for r in out] == list(range(len(want)))
    pieces = sorted(found.collect(), key=lambda r: r.new_episode)
    assert [r.new_episode for r in pieces] == list(range(len(pieces))) and sum(r.length for r in pieces) == len(want)
    assert all((a.dataset_to_index, True) == (b.dataset_from_index, a.start_frame < a.end_frame) for a, b in zip(pieces, pieces[1:], strict=False))


def test_numbering_at_any_partitioning(spark):
    rows = [(k * 7 % 1000, k % 5) for k in range(3000)]
    for n in (1, 7):
        df = spark.createDataFrame(rows, "k long, v long").repartition(n)
        out = sorted(index.running_total(df, "k", df.v, "before", ("v",)).collect(), key=lambda r: (r.k, r.v))
        total = 0
        for r in out:
            assert r.before <= total
            total += r.v
        assert out[-1].before + out[-1].v == total
    assert index.running_total(spark.createDataFrame([], "k long"), "k").count() == 0
