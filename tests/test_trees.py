"""Trees of files: listed, hashed, copied, written and published by executors."""

import dataclasses
import hashlib
import json
import os
from pathlib import Path

import pyarrow.parquet as pq
import pytest
from oracle import DATA, TABLES, both
from pyspark.sql import functions as F

from episodica import queries_trees
from episodica.operators import manifest
from episodica.plans import datasets, layouts
from episodica.queries import ORACLES, QUERIES
from episodica.sources import files, sinks, trees


@pytest.fixture()
def mixed(tmp_path):
    root = tmp_path / "mixed"
    big = os.urandom(3 * trees.BLOCK + 17)
    for path, content in {"a-b": b"1", "a/b": b"2", "meta/info.json": b"{}", ".cache/x": b"4", "MERGE_RECEIPT.json": b"3", "deep/er/still/v.mp4": big, "empty": b""}.items():
        (root / path).parent.mkdir(parents=True, exist_ok=True)
        (root / path).write_bytes(content)
    return root


def every(root):
    return sorted(p for p in root.rglob("*") if p.is_file())


def test_listing_and_hashes_of_several_blocks(spark, mixed):
    found = trees.listing(spark, str(mixed))
    want = {p.relative_to(mixed).as_posix(): (p.stat().st_size, hashlib.sha256(p.read_bytes()).hexdigest()) for p in every(mixed)}
    assert {r.path: r.bytes for r in found.collect()} == {k: n for k, (n, _) in want.items()}
    assert {r.path: (r.bytes, r.sha256) for r in trees.hashes(found).collect()} == want
    assert trees.listing(spark, str(mixed / "a")).count() == 1


def test_blocks_have_a_bound(mixed):
    assert {len(b) for b in trees.blocks(str(mixed / "deep/er/still/v.mp4"))} == {trees.BLOCK, 17}


def test_digests_in_order(spark, mixed):
    inventory, metadata = hashlib.sha256(), hashlib.sha256()
    for p in every(mixed):
        inventory.update(f"{p.relative_to(mixed).as_posix()}\0{p.stat().st_size}\n".encode())
    metadata.update(b"meta/info.json\0{}")
    got = manifest.tree_fingerprint(spark, str(mixed)).first()
    assert (got.inventory_sha256, got.metadata_sha256, got.file_count) == (inventory.hexdigest(), metadata.hexdigest(), 7)
    for flavour, (names, folders) in manifest.LEFT_OUT.items():
        kept = [p.relative_to(mixed).as_posix() for p in every(mixed) if p.name not in names and p.relative_to(mixed).parts[0] not in folders]
        text = "".join(f"{hashlib.sha256((mixed / p).read_bytes()).hexdigest()}  {p}\n" for p in kept)
        got = manifest.tree_digest(spark, str(mixed), flavour).first()
        assert (got.digest, got.files) == (hashlib.sha256(text.encode()).hexdigest(), len(kept)), flavour


def test_a_digest_goes_over_many_tasks_in_order(spark):
    rows = spark.range(5000).select(F.format_string("%05d|", 4999 - F.col("id")).alias("data"), (4999 - F.col("id")).alias("k")).repartition(7)
    got = trees.stream_digest(rows, ["k"], "h").first()
    text = "".join(f"{k:05d}|" for k in range(5000)).encode()
    assert (got.h, got.bytes) == (hashlib.sha256(text).hexdigest(), len(text))
    assert trees.stream_digest(rows.where("false"), ["k"]).first().digest == hashlib.sha256().hexdigest()


def test_footers_read_no_data(spark, tmp_path):
    for k in range(40):
        (tmp_path / f"t/c{k % 3}").mkdir(parents=True, exist_ok=True)
        pq.write_table(__import__("pyarrow").table({"a": [1] * k, **({"b": ["x"] * k} if k % 2 else {})}), tmp_path / f"t/c{k % 3}/f{k:02d}.parquet")
    # nothing but the footer is left of one file
    path = tmp_path / "t/c0/f39.parquet"
    raw = path.read_bytes()
    tail = int.from_bytes(raw[-8:-4], "little") + 8
    path.write_bytes(b"\0" * (len(raw) - tail) + raw[-tail:])
    found = {r.path: r for r in trees.footers(trees.listing(spark, str(tmp_path / "t"))).collect()}
    assert len(found) == 40 and found["c0/f39.parquet"].rows == 39 and found["c1/f01.parquet"].types == ["a bigint", "b string"] and found["c2/f38.parquet"].columns == ["a"]


def test_one_file_a_key(spark, tmp_path):
    rows = spark.range(3000).select((F.col("id") % 11).alias("e"), F.col("id").alias("i"), F.array(F.col("id").cast("float")).alias("a.b")).withColumn("file", F.format_string("d/e%02d.parquet", "e"))
    done = trees.keyed_parquet(rows, str(tmp_path / "out"), "file", ["i"])
    assert {(r.path, r.rows) for r in done.collect()} == {(f"d/e{k:02d}.parquet", len(range(k, 3000, 11))) for k in range(11)}
    for k in range(11):
        t = pq.read_table(tmp_path / f"out/d/e{k:02d}.parquet")
        assert t.column("i").to_pylist() == list(range(k, 3000, 11)) and t.column_names == ["e", "i", "a.b"]
    assert len(list((tmp_path / "out/d").iterdir())) == 11
    trees.keyed_parquet(rows.where("i < 100"), str(tmp_path / "out"), "file", ["i"])  # a task that runs again replaces its files
    assert pq.read_table(tmp_path / "out/d/e00.parquet").num_rows == 10
    lines = trees.keyed_lines(rows.select("file", F.col("i").cast("string").alias("line"), "i"), str(tmp_path / "txt"), "file", "line", ["i"])
    assert lines.agg(F.sum("rows")).first()[0] == 3000 and (tmp_path / "txt/d/e03.parquet").read_text().splitlines()[:2] == ["3", "14"]


def test_file_sizes_keep_their_bound(spark):
    sizes = spark.createDataFrame([(k, 100 if k != 5 else 5000) for k in range(50)], "episode_index long, bytes long")
    got = trees.sized_files(sizes, 1000, "episode_index", "data", 3).join(sizes, "episode_index").groupBy("file").agg(F.sum("bytes").alias("b"), F.min("episode_index").alias("a"), F.max("episode_index").alias("z"), F.count("*").alias("n")).orderBy("a").collect()
    assert all(r.b <= 1000 + 5000 for r in got) and sum(r.b > 1100 for r in got) == 1
    assert all(r.z - r.a + 1 == r.n for r in got) and [r.file for r in got] == [f"data/chunk-{k // 3:03d}/file-{k % 3:03d}.parquet" for k in range(len(got))]


def dataset(spark, episodes=7):
    rows = [(e, k, 10 * e + k, k // 5, k // 5, [float(k), 1.0]) for e in range(episodes) for k in range(10)]
    frames = spark.createDataFrame(rows, "episode_index long, frame_index long, index long, task_index long, subtask_index long, `observation.state` array<float>")
    words = [(0, "reach"), (1, "grasp")]
    meta = [(e, 10, 10 * e, 10 * e + 10, ["reach", "grasp"], [4.5, 1.0], [2.5, 0.0], [0.0, 1.0], [9.0, 1.0], [10]) for e in range(episodes)]
    stat = ", ".join(f"`stats/observation.state/{n}` array<{'long' if n == 'count' else 'double'}>" for n in ("mean", "std", "min", "max", "count"))
    return datasets.Dataset(
        frames, spark.createDataFrame(words, "task_index long, task string"), spark.createDataFrame(words, "subtask_index long, subtask string"),
        spark.createDataFrame(meta, f"episode_index long, length long, dataset_from_index long, dataset_to_index long, tasks array<string>, {stat}"), None, {"fps": 15, "features": {}},
    )


def test_written_tree_reads_the_same(spark, tmp_path):
    data = dataset(spark)
    done = layouts.write(data, str(tmp_path / "out"), 700, 2)
    said = {r.path: r.rows for r in done.collect()}
    assert sum(n for p, n in said.items() if p.startswith("data/")) == 70 and len([p for p in said if p.startswith("data/")]) > 2
    (tmp_path / "out/meta/info.json").write_text(json.dumps({"total_episodes": 7, "total_frames": 70}))
    (tmp_path / "out/annotations").mkdir()
    again = datasets.load(spark, str(tmp_path / "out"))
    assert again.frames.drop("place").exceptAll(data.frames).isEmpty() and again.frames.where("place <> index").isEmpty() and again.frames.count() == 70
    at = {(r["data/chunk_index"], r["data/file_index"]) for r in again.episodes.collect()}
    assert {f"data/chunk-{c:03d}/file-{f:03d}.parquet" for c, f in at} == {p for p in said if p.startswith("data/")}
    with pytest.raises(FileExistsError):
        layouts.write(data, str(tmp_path / "out"))
    assert not [p for p in tmp_path.iterdir() if "staging" in p.name or "publishing" in p.name]


def test_one_file_an_episode_there_and_back(spark, tmp_path):
    data, root = dataset(spark), str(tmp_path / "lines")
    layouts.convert(data, root, 3)
    assert sorted(p.relative_to(root).as_posix() for p in Path(root).rglob("*.parquet")) == [f"data/chunk-{e // 3:03d}/episode_{e:06d}.parquet" for e in range(7)]
    tree = layouts.load_lines(spark, root)
    assert tree.frames.drop(layouts.ANNOTATION).exceptAll(data.frames).isEmpty() and tree.frames.count() == 70
    assert (tree.info["codebase_version"], tree.info["total_frames"], tree.info["total_episodes"], tree.info["total_chunks"]) == ("v2.1", 70, 7, 3)
    stats = tree.episode_stats.where("episode_index = 2").first().stats
    assert stats["index"]["mean"] == [24.5] and stats["observation.state"]["max"] == [9.0, 1.0] and stats["task_index"]["count"] == [10.0]
    whole = json.loads((tmp_path / "lines/meta/stats.json").read_text())
    assert whole["index"]["max"] == [69.0] and whole["observation.state"]["mean"] == [4.5, 1.0]
    lines = [json.loads(x) for x in (tmp_path / "lines/meta/episodes.jsonl").read_text().splitlines()]
    assert [x["episode_index"] for x in lines] == list(range(7)) and lines[0]["tasks"] == ["reach", "grasp"]
    # a language view of the tree
    one = spark.createDataFrame([(0, "do it")], "task_index long, task string")
    view, whole = layouts.lines_view(tree, one, False)
    layouts.write_lines(view, str(tmp_path / "view"), whole, 3)
    again = layouts.load_lines(spark, str(tmp_path / "view"))
    assert {tuple(r.tasks) for r in again.episodes.collect()} == {("do it",)} and again.info["total_tasks"] == 1
    assert again.frames.where(f"task_index <> 0 or `{layouts.ANNOTATION}` <> 0").isEmpty() and again.episode_stats.first().stats["task_index"]["max"] == [0.0]
    broken = layouts.LineTree(tree.frames.where("frame_index <> 3"), tree.tasks, tree.episodes, tree.episode_stats, tree.info)
    with pytest.raises(ValueError, match="frame_index"):
        layouts.lines_view(broken, one, False)


def test_trees_are_published_together_or_not_at_all(spark, tmp_path):
    def stages(*names):
        out = []
        for n in names:
            stage = tmp_path / f"{n}.stage"
            stage.mkdir()
            (stage / "x").write_text(n)
            out.append((str(stage), str(tmp_path / n)))
        return out

    layouts.publish(spark, stages("a", "b"))
    assert (tmp_path / "a/x").read_text() == "a" and (tmp_path / "b/x").exists()
    with pytest.raises(FileExistsError):
        layouts.publish(spark, stages("c", "b"))
    lost = stages("d", "e")
    (tmp_path / "e.stage/x").unlink()
    (tmp_path / "e.stage").rmdir()
    with pytest.raises(Exception):  # noqa: B017
        layouts.publish(spark, lost)
    # a driver that died after the first rename
    (stage, target), other = stages("f", "g")
    sinks.small_text(spark, str(tmp_path / "journal"), json.dumps([(stage, target), other]))
    os.rename(stage, target)
    assert layouts.recover(spark, str(tmp_path / "journal")) == [target] and layouts.recover(spark, str(tmp_path / "journal")) == []
    assert sorted(p.name for p in tmp_path.iterdir()) == ["a", "b"]


def test_package(spark, mixed, tmp_path):
    said = layouts.package(spark, str(mixed), str(tmp_path / "pkg"), ["a/b", "meta/info.json"])
    assert said == {"files": 7, "bytes": sum(p.stat().st_size for p in every(mixed))}
    lines = spark.read.text(str(tmp_path / "pkg/SHA256SUMS"))
    present = trees.hashes(trees.listing(spark, str(tmp_path / "pkg")).where("path <> 'SHA256SUMS'"))
    assert manifest.verified(manifest.parsed(lines), present).isEmpty()
    assert lines.first().value.endswith(".cache/x")
    with pytest.raises(FileNotFoundError, match="missing nope"):
        layouts.package(spark, str(mixed), str(tmp_path / "pkg2"), ["nope"])
    with pytest.raises(FileExistsError):
        layouts.package(spark, str(mixed), str(tmp_path / "pkg"), ["a/b"])


def test_first_file_and_footers_of_a_folder(spark, tmp_path):
    spark.createDataFrame([(1,)], "a int").coalesce(1).write.parquet(f"{tmp_path}/t/chunk-0")
    spark.createDataFrame([(1, "x")], "a long, b string").coalesce(1).write.parquet(f"{tmp_path}/t/chunk-1")
    assert files.first_file(spark, f"{tmp_path}/t").columns == ["a"]
    assert [r.types for r in files.footers(spark, f"{tmp_path}/t").orderBy("path").collect()] == [["a int"], ["a bigint", "b string"]]


def test_views_of_three_trees_appear_together(spark, tmp_path):
    words = [(k, f"step {k}") for k in range(5)]
    rows = [(e, k, 50 * e + k, 0, k // 10, [float(k)]) for e in range(2) for k in range(50)]
    frames = spark.createDataFrame(rows, "episode_index long, frame_index long, index long, task_index long, subtask_index long, `observation.state` array<float>")
    meta = spark.createDataFrame([(e, 50, 50 * e, 50 * e + 50, ["do it"]) for e in range(2)], "episode_index long, length long, dataset_from_index long, dataset_to_index long, tasks array<string>")
    data = datasets.Dataset(
        frames, spark.createDataFrame([(0, "do it")], "task_index long, task string"), spark.createDataFrame(words, "subtask_index long, subtask string"), meta, None, {"fps": 15, "features": {}, "root": "/p"}
    )
    lines = layouts.converted(data)
    parent = {"name": "p", "contract": {}, "validation": {}}
    made = layouts.publish_views(data, data, lines, ["per_subtask"], str(tmp_path / "out"), parent, "do it")
    assert list(made) == ["view_per_subtask"]
    for name, doc in made.items():
        assert json.loads((tmp_path / f"out/registrations/{name}.json").read_text()) == doc
        for kind in ("source", "prepared", "isaac"):
            root = tmp_path / f"out/{name}/{kind}"
            receipt = json.loads((root / layouts.RECEIPT).read_text())
            assert receipt["tree_kind"] == kind and receipt["payload_sha256"] == manifest.tree_digest(spark, str(root), "language").first().digest
            assert receipt["h40"]["language_conflict_start_count"] == receipt["h40"]["cross_boundary_start_count"] > 0 and (root / receipt["h40_boundary_manifest"]).exists()
        own = layouts.load_lines(spark, str(tmp_path / f"out/{name}/isaac"))
        assert own.episodes.first().tasks == [w for _, w in words]
    with pytest.raises(FileExistsError):  # one of the trees is there: none of the new ones stays
        layouts.publish_views(data, data, lines, ["mapped_subtask", "per_subtask"], str(tmp_path / "out"), parent, "do it", {"step 1": "turn"})
    assert not (tmp_path / "out/view_mapped_subtask/source").exists() and not [p for p in (tmp_path / "out").iterdir() if "staging" in p.name or "publishing" in p.name]


def _many_users(spark, folder, users):
    """The driver's smallest tables with other events: one for each user."""
    for t in TABLES:
        if t != "events":
            (folder / f"{t}.parquet").symlink_to(f"{DATA}/sf0.001/{t}.parquet")
    rows = spark.range(users).select(
        F.col("id").alias("event_id"), F.timestamp_seconds(1_700_000_000 + F.col("id")).cast("timestamp_ntz").alias("ts"), F.col("id").alias("user_id"),
        F.when(F.col("id") % 3 == 0, "click").otherwise("view").alias("event_type"), (F.col("id") / 4).alias("value"), F.lit("{}").alias("props"),
    )
    rows.toPandas().to_parquet(folder / "events.parquet", coerce_timestamps="us")
    return str(folder)


def test_planned_files_of_a_thousand_chunks_and_more_equal_the_sql(spark, tmp_path, monkeypatch):
    write, tree = layouts.write, {}
    monkeypatch.setattr(layouts, "write", lambda data, root, limit, chunk: write(data, tree.setdefault("root", root), limit // 1000, chunk // 4))
    sql = ORACLES["planned_files"].replace("40000", "40").replace("f // 4", "f // 1").replace("f % 4", "f % 1")
    mine, theirs = both(spark, QUERIES["planned_files"], sql, _many_users(spark, tmp_path, 1012))
    assert mine == theirs and len(mine) == 1012
    # the tree's own names are whole, so that no two files share one
    there = [r.path for r in trees.listing(spark, tree["root"]).where("path like 'data/%'").collect()]
    assert len(set(there)) == 1012 and "data/chunk-1011/file-000.parquet" in there


def test_episode_files_of_a_thousand_chunks_and_more_equal_the_sql(spark, tmp_path, monkeypatch):
    whole, kept = queries_trees._dataset, "episode_index >= 9996"

    def last(*of):  # numbered among all episodes; files of the last ones are enough here
        data = whole(*of)
        return dataclasses.replace(data, frames=data.frames.where(kept), episodes=data.episodes.where(kept))

    monkeypatch.setattr(queries_trees, "_dataset", last)
    sql = f"SELECT * FROM ({ORACLES['episode_files']}) WHERE {kept}"
    mine, theirs = both(spark, QUERIES["episode_files"], sql, _many_users(spark, tmp_path, 10_003))
    assert mine == theirs and len(mine) == 7
