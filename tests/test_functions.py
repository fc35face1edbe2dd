import pytest
from pyspark.sql import functions as F

from episodica.functions import config, text
from episodica.operators import manifest, media, stats, vectors, vocab
from episodica.plans import rules, runs


def _one(spark, column):
    return spark.range(1).select(column.alias("x")).first().x


@pytest.mark.parametrize(
    ("caption", "problem"),
    [
        ("a b", None),
        ("a  b", "repeated ASCII spaces"),
        (" a", "leading or trailing whitespace"),
        ("a　", "leading or trailing whitespace"),
        ("a\tb", "unexpected whitespace U+0009"),
        ("a\nb", "unexpected whitespace U+000A"),
        ("a b", "unexpected whitespace U+00A0"),
        ("a\x1cb", "unexpected whitespace U+001C")
    ]
)
def test_whitespace(spark, caption, problem):
    assert _one(spark, text.whitespace_problem(F.lit(caption))) == problem


def test_whitespace_is_python_s(spark):
    rows = spark.range(0x3100).where("id not between 55296 and 57343").select(
        "id",
        text.whitespace_problem(F.concat(F.lit("a"), F.char("id") if False else F.decode(F.unhex(F.lpad(F.hex("id"), 4, "0")), "UTF-16BE"), F.lit("b"))).alias("p")
    )
    assert {r.id for r in rows.where("p is not null").collect()} == {c for c in range(0x3100) if chr(c).isspace() and c != 0x20}


def test_scalars(spark):
    assert _one(spark, text.caption_problem(F.lit(None).cast("string"))) == "not a string" and _one(spark, text.caption_problem(F.lit(""))) == "empty"
    assert [_one(spark, text.safe_name(F.lit(n))) for n in ("a.b-1", "-a", "a b", "a\n", "")] == [True, False, False, False, False]
    assert _one(spark, text.number_after(F.lit("x/attempt-10"), "attempt-")) == 10 and _one(spark, text.number_after(F.lit("x/attempt-a"), "attempt-")) is None
    assert _one(spark, text.exit_code(F.lit(-9))) == 137 and _one(spark, text.fraction(F.lit("30/2"))) == 15.0
    assert _one(spark, text.is_close(F.lit(1e-4), F.lit(1e-4 * (1 + 1e-10))))
    m = _one(spark, text.step_metrics(F.lit("INFO step:20 smpl:320 eval_loss:9.5 loss:1.293 grdn:1.519 smp/s:13 mem_gb:35.94")))
    assert tuple(m) == (20, 1.293, 1.519, 13.0, 35.94)
    m = _one(spark, text.step_metrics(F.lit("step:1 loss:1 grdn:1 smp/s:1 mem_gb:1 step:2 loss:2.5 grdn:1 smp/s:1 mem_gb:1")))
    assert (m.step, m.loss) == (2, 2.5)
    for line in ("step:20 eval_loss:9.5 loss:1.2", "substep:20 loss:1 grdn:1 smp/s:1 mem_gb:1", "step:20 eval_loss:1 grdn:1 smp/s:1 mem_gb:1", ""):
        assert _one(spark, text.step_metrics(F.lit(line))) is None
    said = "{'train_runtime': 37.7, 'train_samples_per_second': 0.026, 'train_loss': 1.5}"
    assert [_one(spark, text.summary_metric(F.lit(said), k)) for k in ("loss", "samples_per_second")] == [1.5, 0.026]
    assert _one(spark, text.summary_metric(F.lit("train_loss: 3"), "loss") ) is None
    codes = [(0, False, ""), (0, True, "CUDA out of memory"), (1, True, "oom out of memory"), (1, False, "CUDA out of memory"), (137, False, ""), (1, False, "x")]
    df = spark.createDataFrame(codes, "c int, t boolean, l string").select(text.failure_category(F.col("c"), F.col("t"), F.col("l")).alias("f"))
    assert [r.f for r in df.collect()] == [None, None, "timeout", "oom", "signal", "trainer_error"]


def test_config(spark):
    assert config.merge({"a": {"b": 1, "c": [1, 2]}, "d": 1}, {"a": {"c": [3]}, "d": {"e": 2}}) == {"a": {"b": 1, "c": [3]}, "d": {"e": 2}}
    docs = {"p/a": {"_base": "b", "x": 1}, "p/b": {"_base": "p/c", "x": 0, "y": {"z": 1}}, "p/c": {"y": {"w": 2}}}
    assert config.layered(docs, "p/a") == {"x": 1, "y": {"w": 2, "z": 1}}
    with pytest.raises(config.ConfigError, match="cycle"):
        config.layered({"a": {"_base": "b"}, "b": {"_base": "a"}}, "a")
    assert config.assigned({"a": {"b": 1}}, ["a.b=2", "a.c=true", "d=x"]) == {"a": {"b": 2, "c": True}, "d": "x"}
    assert config.substituted({"a": ["${w}/x"]}, {"w": "/r"}) == {"a": ["/r/x"]}
    with pytest.raises(config.ConfigError, match="unknown variable q"):
        config.substituted("${q}", {})
    assert config.flags("p", {"a": True, "b": None, "c": [], "d": {"e": [1, 2]}, "tfs": {"k": 1}}) == ["--p.a=true", "--p.d.e=[1,2]", '--p.tfs={"k":1}']
    good = {k: {} for k in rules.CONFIG_MAPPINGS} | {
        "schema_version": 1,
        "backend": "act",
        "name": "n",
        "tags": ["t"],
        "dataset": {"repo_id": "r", "root": "/r"},
        "policy": {"type": "act", "device": "cpu"},
        "train": {"steps": 5, "batch_size": 1, "num_workers": 0},
        "tracking": {"backend": "none"},
        "resources": {"timeout_hours": 1}
    }
    assert rules.config(good) == []
    bad = config.merge(
        good,
        {
            "schema_version": 2,
            "backend": "zz",
            "name": "-n",
            "zzz": 1,
            "train": {"steps": True},
            "optimizer": {"lr": 1.0},
            "policy": {"type": "groot", "optimizer_lr": 2.0, "use_relative_actions": True, "relative_exclude_joints": ["grip"]},
            "tracking": {"backend": "wandb"}
        }
    )
    assert [r for r, _ in rules.config(bad)] == ["unknown_key", "schema_version", "backend", "name", "learning_rate", "steps", "exclusion_term", "tracking_project"]
    native = config.merge(good, {"backend": "isaac", "policy": {"type": "groot", "chunk_size": 16}, "train": {"seed": 1}})
    assert [r for r, _ in rules.config(native)] == ["absolute_action", "modality", "horizon", "seed"]
    links = spark.createDataFrame([("a", "b"), ("b", "a"), ("c", "d")], "child string, parent string")
    assert {r.name: r.cyclic for r in config.chains(links).collect()} == {"a": True, "b": True, "c": False, "d": False}


def test_chains_of_any_length(spark):
    """A chain of 37 names, a cycle of 5 that a tail of 6 leads to, a name that is its own parent, and one with two parents."""
    line, tail, ring = [f"n{k}" for k in range(37)], [f"t{k}" for k in range(6)], [f"r{k}" for k in range(5)]
    pairs = [*zip(line, line[1:]), *zip(tail, [*tail[1:], "r0"]), *zip(ring, [*ring[1:], "r0"]), ("me", "me"), ("two", "n35"), ("two", "n36")]
    got = {(r.name, tuple(r.chain)): r.cyclic for r in config.chains(spark.createDataFrame([*pairs, ("n36", None)], "child string, parent string")).collect()}
    want = {(n, tuple(line[k:])): False for k, n in enumerate(line)}
    want |= {(n, (*tail[k:], *ring, "r0")): True for k, n in enumerate(tail)}
    want |= {(n, (*ring[k:], *ring[:k], n)): True for k, n in enumerate(ring)}
    want |= {("me", ("me", "me")): True, ("two", ("two", "n35", "n36")): False, ("two", ("two", "n36")): False}
    assert {k: v for k, v in got.items() if k[0] is not None} == want


def test_log_falls_back_only_without_steps(spark):
    step = "step:{} loss:{} grdn:1 smp/s:2 mem_gb:3"
    rows = [
        ("a", 1, step.format(1, 0.5)),
        ("a", 2, step.format(2, 0.4)),
        ("a", 3, "{'train_loss': 9.0}"),
        ("b", 1, "{'train_loss': 8.0, 'train_samples_per_second': 4}"),
        ("b", 2, "{'train_loss': 7.0}"),
        ("c", 1, "{'train_samples_per_second': 4}"),
        ("d", 1, "step:3 loss:1")
    ]
    got = {r.run: tuple(r)[1:] for r in runs.last_metrics(spark.createDataFrame(rows, "run string, line_no long, line string")).collect()}
    assert got == {"a": (2, 0.4, 1.0, 2.0, 3.0), "b": (None, 7.0, None, 4.0, None)}


def test_manifest(spark):
    rows = spark.createDataFrame([("b", "2"), ("a", "1")], "path string, content string")
    one = manifest.lines(manifest.hashed(rows)).first()
    assert one.text.split("\n")[0].endswith("  a") and (one.files, one.bytes) == (2, 2)
    said = manifest.parsed(spark.createDataFrame([(x,) for x in one.text.split("\n")], "value string"))
    assert manifest.verified(said, manifest.hashed(rows)).isEmpty()
    other = spark.createDataFrame([("b", "x"), ("c", "3")], "path string, content string")
    assert {(r.path, r.problem) for r in manifest.verified(said, manifest.hashed(other)).collect()} == {("a", "missing"), ("b", "checksum mismatch"), ("c", "not listed")}


def test_latest_attempt_is_numeric(spark):
    rows = spark.createDataFrame([("r", "x", None), ("r", "attempt-2", 2), ("r", "attempt-10", 10), ("q", "y", None), ("_z", "w", 1)], "run string, path string, attempt long")
    assert {r.run: r.path for r in runs.latest_attempts(rows).collect()} == {"r": "attempt-10", "q": "y"}


def test_vectors_vocab_stats_media(spark):
    rows = spark.createDataFrame([([1.0, 2.0, float("nan")],), ([1.0],)], "v array<double>")
    assert [r.x for r in rows.select(vectors.all_finite(F.col("v")).alias("x")).collect()] == [False, True]
    with pytest.raises(Exception, match="fewer than 2"):
        rows.select(vectors.select_dims(F.col("v"), [0, 1])).collect()
    assert _one(spark, vectors.positions_of(F.array(F.lit("a"), F.lit("b")), ["b", "z"])) == [1, -1]
    pairs = spark.createDataFrame([(0, 5)], "k long, new_k long")
    with pytest.raises(Exception, match="no mapping for k 1"):
        vocab.remap(spark.createDataFrame([(0,), (1,)], "k long"), pairs, ["k"], "new_k").collect()
    flags = spark.createDataFrame([("v", k, k in (0, 4)) for k in range(11)], "path string, n long, key boolean")
    r = media.key_intervals(flags, "key", "n").first()
    assert (r.frames, r.key_frames, r.starts_on_key, r.max_gop) == (11, 2, True, 7)
    assert not media.key_intervals(flags.where("n > 0"), "key", "n").first().starts_on_key
    videos = spark.createDataFrame([("a", 9, True, 1), ("b", 9, False, 1), ("c", 9, True, 2), ("d", 0, None, 1)], "path string, frames long, starts_on_key boolean, streams int")
    assert {r.path: r.problem for r in media.unusable(videos).collect()} == {"b": "does not start on a key frame", "c": "not one video stream", "d": "empty"}
    parts = spark.createDataFrame([("f", 1.0, 0.0, 1.0, 1.0, 1), ("f", 4.0, 1.0, 3.0, 5.0, 3)], "k string, mean double, std double, min double, max double, count long")
    p = stats.pooled(parts, ["k"]).first()
    assert p.mean == 3.25 and abs(p.std - ((2.25**2 + 3 * (1 + 0.75**2)) / 4) ** 0.5) < 1e-12 and stats.incomplete(parts).isEmpty()
