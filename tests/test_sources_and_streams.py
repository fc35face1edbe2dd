import hashlib
import json
import time

import pytest
from pyspark.sql import functions as F

from episodica.operators import manifest, media
from episodica.plans import rules
from episodica.sources import files, sinks
from episodica.streaming import logs, machine


def test_sources(spark, tmp_path):
    (tmp_path / "q.tsv").write_text("# comment\nr1\trel\t42\t0.1\tnone\t10\n\n")
    assert [(r.run_name, r.seed) for r in files.queue_table(spark, str(tmp_path / "q.tsv")).collect()] == [("r1", 42)]
    (tmp_path / "kv").write_text("revision=a=b\nnothing\n")
    assert [(r.key, r.value) for r in files.key_values(spark, str(tmp_path / "kv")).collect()] == [("revision", "a=b")]
    (tmp_path / "l.jsonl").write_text('{"a": 1}\n\n{"a": 2}\n')
    assert files.json_lines(spark, str(tmp_path / "l.jsonl"), "a long").count() == 2
    (tmp_path / "m/meta").mkdir(parents=True)
    (tmp_path / "m/meta/stats.json").write_text(json.dumps({"f": {"mean": [1.0, 2.0]}}))
    assert [(r.feature, r.dim, r.value) for r in files.stats(spark, str(tmp_path / "m")).orderBy("dim").collect()] == [("f", 0, 1.0), ("f", 1, 2.0)]
    found = files.files(spark, str(tmp_path / "m")).collect()
    assert [r.path for r in found] == ["meta/stats.json"]
    for k in ("", "attempt-2/", "attempt-10/"):
        (tmp_path / f"runs/r/{k}").mkdir(parents=True, exist_ok=True)
        (tmp_path / f"runs/r/{k}result.json").write_text(json.dumps({"run_name": "r", "status": {"state": "completed"}}))
    (tmp_path / "runs/r/attempt-2/result.json").rename(tmp_path / "runs/r/attempt-2/result.yaml")
    assert sorted((r.attempt or -1, r.run) for r in files.results(spark, str(tmp_path / "runs")).collect()) == [(-1, "r"), (2, "r"), (10, "r")]
    (tmp_path / "odd/r").mkdir(parents=True)
    (tmp_path / "odd/r/result.json").write_text("[1]")
    with pytest.raises(Exception, match="is no mapping"):
        files.results(spark, str(tmp_path / "odd")).collect()


def test_footers_and_probes(spark, tmp_path):
    spark.createDataFrame([(1, "x")], "a long, b string").coalesce(1).write.parquet(f"{tmp_path}/t/chunk-1")
    spark.createDataFrame([(1,)], "a int").coalesce(1).write.parquet(f"{tmp_path}/t/chunk-0")
    found = files.footers(spark, f"{tmp_path}/t")
    assert [r.types for r in found.orderBy("path").collect()] == [["a int"], ["a bigint", "b string"]]
    (lost,) = rules.missing_columns(found, ["a", "b"]).collect()
    assert lost.observed == "b" and "chunk-0" in lost.location
    assert files.first_file(spark, f"{tmp_path}/t").columns == ["a"]
    other = found.withColumn("types", F.transform("types", lambda t: F.regexp_replace(t, "bigint", "int")))
    assert [r.observed for r in rules.schema_differences(other, found).collect()] == ["a int, b string"]
    with pytest.raises(ValueError, match="lacks b"):
        files.vocabulary(spark, f"{tmp_path}/t/chunk-0", "a", "b", strict=True)
    packets = [{"flags": "K__" if k in (0, 4) else "___"} for k in range(11)]
    for name, doc in (
        ("v.mp4", {"streams": [{"width": 640, "height": 480, "avg_frame_rate": "15/1", "codec_name": "h264"}], "packets": packets}),
        ("w.mp4", {"streams": [{"width": 1}], "packets": packets[1:4]})
    ):
        (tmp_path / f"{name}.json").write_text(json.dumps(doc))
    got = {r.path.rpartition("/")[2]: r for r in media.probe_rows(files.probes(spark, str(tmp_path))).collect()}
    v, w = got["v.mp4"], got["w.mp4"]
    assert (v.width, v.codec_name, v.frames, v.key_frames, v.max_gop) == (640, "h264", 11, 2, 7) and (w.frames, w.key_frames, w.max_gop) == (3, 0, None)


def test_source_revision(spark, tmp_path):
    (tmp_path / "s").mkdir()
    (tmp_path / "s/other.txt").write_text("x")
    assert files.source_revision(spark, str(tmp_path / "s")) is None
    (tmp_path / "s/DOWNLOAD_RECEIPT.txt").write_text("a=b\nresolved_hub_commit=abc\n")
    assert files.source_revision(spark, str(tmp_path / "s")) == "abc"
    (tmp_path / "s/.groot_registry_download.json").write_text('{"revision": "def"}')
    assert files.source_revision(spark, str(tmp_path / "s")) == "def"


def test_digest_flavours(spark, tmp_path):
    rows = [("a-b", "1"), ("a/b", "2"), ("meta/info.json", "{}"), ("MERGE_RECEIPT.json", "3"), (".cache/x", "4"), (".groot_registry_download.json", "5")]
    df = spark.createDataFrame(rows, "path string, content string")
    names = lambda flavour: [x.split("  ")[1] for x in manifest.payload(df, flavour).first().text.splitlines()]
    assert names("registry") == ["MERGE_RECEIPT.json", "a/b", "a-b", "meta/info.json"] and names("merge") == [".cache/x", ".groot_registry_download.json", "a/b", "a-b", "meta/info.json"]
    assert ".groot_registry_download.json" not in names("language") and ".cache/x" in names("language") and len(names("correction")) == 6
    for path, content in rows:
        (tmp_path / path).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / path).write_text(content)
    inventory, metadata = hashlib.sha256(), hashlib.sha256()
    for p in sorted(x for x in tmp_path.rglob("*") if x.is_file()):
        inventory.update(f"{p.relative_to(tmp_path).as_posix()}\0{p.stat().st_size}\n".encode())
    metadata.update(b"meta/info.json\0{}")
    hidden = files.hidden_files(spark, str(tmp_path))
    assert {r.path for r in hidden.collect()} == {".cache/x", ".groot_registry_download.json"}
    got = manifest.fingerprint(files.files(spark, str(tmp_path)).unionByName(hidden)).first()
    assert (got.inventory_sha256, got.metadata_sha256, got.file_count, got.bytes) == (inventory.hexdigest(), metadata.hexdigest(), 6, 7)


def test_sinks(spark, tmp_path):
    sinks.document(tmp_path / "d.json", {"b": 1, "a": 2})
    assert (tmp_path / "d.json").read_text().startswith('{\n  "a": 2')
    sinks.json_lines(spark.createDataFrame([(2, None), (1, "x")], "k long, t string"), tmp_path / "x.jsonl", ["k"])
    assert [json.loads(x) for x in (tmp_path / "x.jsonl").read_text().splitlines()] == [{"k": 1, "t": "x"}, {"k": 2, "t": None}]
    (tmp_path / "src/v").mkdir(parents=True)
    (tmp_path / "src/v/a.mp4").write_bytes(b"1")
    (tmp_path / "src/b.txt").write_bytes(b"2")
    assert sinks.clone(tmp_path / "src", tmp_path / "dst") == {"linked": 1, "copied": 1}
    assert sinks.rolling_digest(tmp_path / "src") == sinks.rolling_digest(tmp_path / "dst")
    (tmp_path / "src/link").symlink_to(tmp_path / "src/b.txt")
    with pytest.raises(ValueError, match="symbolic"):
        sinks.clone(tmp_path / "src", tmp_path / "dst2")


def test_links_status_rows_and_locks(tmp_path):
    for name, text in (("a", "1"), ("b", "1"), ("c", "2")):
        (tmp_path / name).write_text(text)
    with pytest.raises(ValueError, match="differs"):
        sinks.relink([(tmp_path / "a", tmp_path / "b"), (tmp_path / "a", tmp_path / "c")])
    assert not (tmp_path / "b").samefile(tmp_path / "a")
    assert sinks.relink([(tmp_path / "a", tmp_path / "b")]) == {"linked": 1, "bytes": 1} and (tmp_path / "b").samefile(tmp_path / "a")
    for k in range(2):
        sinks.append_rows(tmp_path / "s/status.tsv", ["run", "code"], [("r", k)])
    assert (tmp_path / "s/status.tsv").read_text() == "run\tcode\nr\t0\nr\t1\n"
    with sinks.exclusive(tmp_path / "lock"):
        with pytest.raises(RuntimeError, match="held"), sinks.exclusive(tmp_path / "lock"):
            pass
    with sinks.exclusive(tmp_path / "lock"):
        pass


def test_log_stream_equals_batch(spark, tmp_path):
    (tmp_path / "in").mkdir()
    for k in range(3):
        (tmp_path / f"in/{k}.log").write_text("".join(f"step:{s} loss:{s / 10 + k} grdn:1 smp/s:2 mem_gb:3\nnoise\n" for s in range(5)))
    q = logs.last_metrics(logs.log_stream(spark, str(tmp_path / "in"), 1)).writeStream.outputMode("complete").format("memory").queryName("last").start()
    q.processAllAvailable()
    q.stop()
    streamed = {(r.path, r.step, r.loss) for r in spark.table("last").collect()}
    batch = spark.read.text(str(tmp_path / "in")).selectExpr("_metadata.file_path as path", "value as line")
    assert streamed == {(r.path, r.step, r.loss) for r in logs.last_metrics(batch).collect()} and len(streamed) == 3


def test_windows_stream_equals_batch(spark, tmp_path):
    rows = spark.createDataFrame(
        [(k, f"2024-01-0{1 + k % 3} 0{k % 9}:00:00", "e", 1.0) for k in range(30)],
        "user_id long, t string, event_type string, value double"
    ).selectExpr("user_id", "cast(t as timestamp) as ts", "event_type", "value")
    rows.write.parquet(str(tmp_path / "e"))
    stream = spark.readStream.schema(rows.schema).parquet(str(tmp_path / "e"))
    q = logs.tumbling(stream, "1 day", "1 hour").writeStream.outputMode("complete").format("memory").queryName("days").start()
    q.processAllAvailable()
    q.stop()
    assert sorted(map(tuple, spark.table("days").collect())) == sorted(map(tuple, logs.tumbling(rows, "1 day").collect()))


def _pieces(cut, runs):
    """Events of runs: (name, [(log, code), ...]) with each log cut in pieces of `cut` characters."""
    out = []
    for name, attempts in runs:
        n = 0
        for log, code in attempts:
            for a in range(0, len(log), cut):
                out.append((name, n, log[a : a + cut], None))
                n += 1
            if code is not None:
                out.append((name, n, None, code))
                n += 1
    return out


STEPS = "".join(f"step:{s} loss:{s / 10 + 1} grdn:1 smp/s:{s}.5 mem_gb:3\nnoise\n" for s in range(9))
RUNS = [
    ("good", [(STEPS, 0)]), ("oom", [(STEPS + "CUDA out of memory", 1)]), ("again", [("x\nOutOfMemoryError\n", 1), (STEPS, 0)]), ("spent", [("a\n", 1), ("b\n", -9), ("c", 2), ("d\n", 0)]),
    ("old", [("CUDA out of memory" + "y" * 50 + "\n" + "z" * 2_000_000, 1)]), ("open", [("step:1 loss:2 grdn:1 smp/s:2 mem_gb:3", None)]), ("none", [("", -15)]),
]
WANT = {
    "good": (1, "completed", 0, None, 8), "oom": (1, "failed", 1, "oom", 8), "again": (2, "completed", 1, None, 8), "spent": (3, "blocked", 3, "trainer_error", None),
    "old": (1, "failed", 1, "trainer_error", None), "open": (1, "running", 0, None, None), "none": (1, "failed", 1, "signal", None),
}


def _short(rows):
    return {r.run_name: (r.attempt, r.state, r.failures, r.category, r.step) for r in rows}


def _reached(spark, query, name, want, seconds=60):
    """A query with timers always has another batch, so that it can't be waited for: what it has told at last, or when it is as wanted."""
    began, got = time.monotonic(), None
    while got != want and time.monotonic() - began < seconds and query.isActive:
        time.sleep(1)
        got = _short(machine.latest(spark.table(name)).collect())
    query.stop()
    return got


@pytest.mark.parametrize(("cut", "files_"), [(7, 3), (50, 1), (10_000_000, 2)])
def test_run_machine_for_any_split(spark, tmp_path, cut, files_):
    runs = [r for r in RUNS if r[0] != "old" or cut > 1000]
    want = {k: v for k, v in WANT.items() if k in dict(runs)}
    events = spark.createDataFrame(_pieces(cut, runs), machine.EVENTS)
    assert _short(machine.run_table(events).collect()) == want
    for k in range(files_):  # pieces come in several batches, out of order and some of them twice
        events.where(f"piece % {files_} = {files_ - 1 - k} or piece = 0").coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    name = f"machine_{cut}"
    q = machine.run_machine(stream).writeStream.outputMode("update").format("memory").queryName(name).trigger(processingTime="1 second").start()
    assert _reached(spark, q, name, want) == want


def test_a_silent_run_times_out(spark, tmp_path):
    events = spark.createDataFrame([("quiet", 0, "line\n", None), ("done", 0, None, 0)], machine.EVENTS)
    events.coalesce(1).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(events.schema).parquet(str(tmp_path / "in"))
    q = machine.run_machine(stream, 1, 500).writeStream.outputMode("update").format("memory").queryName("silent").trigger(processingTime="1 second").start()
    want = {"quiet": (1, "blocked", 1, "timeout", None), "done": (1, "completed", 0, None, None)}
    assert _reached(spark, q, "silent", want) == want


def test_metrics_joined_to_a_registry_that_grows(spark, tmp_path):
    rows = [("a", 1), ("b", 1), ("a", 2), ("c", 1)]
    for k, r in enumerate(rows):
        spark.createDataFrame([r], "run_name string, step long").coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    known = {0: ["a"], 1: ["a"], 2: ["a", "b"], 3: ["a", "b"]}
    seen = []

    def registry(s):
        seen.append(len(seen))
        return s.createDataFrame([(n, n.upper()) for n in known[min(seen[-1], 3)]], "run_name string, title string")

    join = machine.RegistryJoin(registry, str(tmp_path / "out"))
    stream = spark.readStream.schema("run_name string, step long").option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    q = stream.writeStream.foreachBatch(join).option("checkpointLocation", str(tmp_path / "cp")).start()
    q.processAllAvailable()
    q.stop()
    got = sorted(map(tuple, join.result(spark, "run_name string, step long, title string").collect()))
    assert got == [("a", 1, "A"), ("a", 2, "A"), ("b", 1, "B")]
    join(spark.createDataFrame([], "run_name string, step long"), len(seen))  # nothing new, and c still waits
    assert spark.read.parquet(f"{tmp_path}/out/waiting/batch={len(seen) - 1}").first().run_name == "c"
