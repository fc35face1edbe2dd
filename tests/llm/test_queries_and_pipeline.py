import random
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).parents[1]))
from oracle import both  # noqa: E402

import corpus_pipeline  # noqa: E402
from episodica.llm import decontaminate, jaccard_join, language_id, mixing, token_output  # noqa: E402
from episodica.llm.queries import ORACLES, QUERIES  # noqa: E402

SMALL = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(llm, name):
    mine, theirs = both(llm, QUERIES[name], ORACLES[name], SMALL)
    assert mine == theirs


def test_names():
    assert [q.split("_")[0] for q in QUERIES] == [f"op{n}" for n in range(1, 14)]
    assert [s for s, _ in corpus_pipeline.STAGES] == ["language_id", "near_duplicates", "decontamination", "mixing", "token_output"]


def test_pipeline_stage_by_stage(llm):
    docs = llm.read.parquet(f"{SMALL}/documents.parquet")
    bench = llm.read.parquet(f"{SMALL}/benchmark.parquet")
    rows = {r.doc_id: r for r in docs.collect()}
    known = {r.doc_id for r in language_id.report(docs).where("lang_pred <> 'und'").collect()}
    at = docs.where(docs.doc_id.isin(*known))
    heads = {r.component_id for r in jaccard_join.near_duplicates(at).collect()}
    at = docs.where(docs.doc_id.isin(*heads))
    clean = {r.doc_id for r in decontaminate.report(at, bench).where("not contaminated").collect()}
    at = docs.where(docs.doc_id.isin(*clean))
    copies = {r.doc_id: r.copies for r in mixing.mix(at).collect() if r.copies}
    out = corpus_pipeline.run(llm, SMALL).collect()
    got = {}
    for r in out:
        got[r.doc_id] = got.get(r.doc_id, 0) + 1
    assert got == copies
    path = token_output.default_tokenizer()
    assert all(r.n_tokens == len(token_output.encoded(path, [rows[r.doc_id].text])[0]) for r in out)
    at = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        at = stage(llm, at, SMALL)
        assert at.columns == docs.columns, name


def test_near_duplicate_stage_takes_five_words_and_four_fifths(llm):
    rng = random.Random(5)
    rows, bases = [], [[f"w{rng.randrange(10**6)}" for _ in range(200)] for _ in range(8)]
    for base in bases:
        rows.append(" ".join(base))
        for tail in (20, 30, 45, 60):  # the longest falls below both measures
            rows.append(" ".join(base + [f"t{rng.randrange(10**6)}" for _ in range(tail)]))
    rows += ["a b c d", "a b c d", "a b c d e", ""]
    sets = [frozenset(tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))) if (w := t.split()) else frozenset() for t in rows]
    root = list(range(len(rows)))
    for i, a in enumerate(sets):
        for k, b in enumerate(sets[:i]):
            if a and 5 * len(a & b) >= 4 * len(a | b):
                x, y = root[i], root[k]
                root = [min(x, y) if r in (x, y) else r for r in root]
    want = [k for k, r in enumerate(root) if k == r]
    docs = llm.createDataFrame(list(enumerate(rows)), "doc_id long, text string").repartition(3)
    got = sorted(r.doc_id for r in corpus_pipeline.near_duplicate_stage(llm, docs, SMALL).collect())
    assert got == want and got != sorted(r.doc_id for r in jaccard_join.keep_one(docs).collect())


def test_edges_through_the_pipeline(llm, edges, empty, tmp_path):
    own = edges.selectExpr("*", "1 as __lang", "'x' as __words", "2 as __kept", "3 as `a.b`")
    for name, df, count in (("edges", own, None), ("empty", own.where("false"), 0), ("blank", own.where("doc_id < 3"), 0)):
        df.write.parquet(f"{tmp_path}/{name}/documents.parquet")
        llm.createDataFrame([(1, "same row here with five words"), (None, None)], "item_id long, text string").write.parquet(f"{tmp_path}/{name}/benchmark.parquet")
        docs = llm.read.parquet(f"{tmp_path}/{name}/documents.parquet")
        for stage, f in corpus_pipeline.STAGES[:-1]:
            docs = f(llm, docs, f"{tmp_path}/{name}")
            assert docs.columns == own.columns, stage
        left = [r.doc_id for r in docs.collect()]
        out = corpus_pipeline.run(llm, f"{tmp_path}/{name}").collect()
        assert len(out) == (len(left) if count is None else count)
        if count is None:
            assert {r.doc_id for r in out} == set(left) and not {0, 1, 2, 7, 15} & set(left) and {6, 10, 12} <= set(left)
