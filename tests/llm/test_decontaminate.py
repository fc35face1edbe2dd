import hashlib
import random
import re

import pytest

from episodica.llm import decontaminate as D

PATTERN = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def brute(docs, items, window=10):
    split = lambda t: PATTERN.findall(re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
    known = {}
    for i, t in items:
        w = split(t)
        n = min(window, len(w))
        for k in range(len(w) - n + 1 if n else 0):
            known.setdefault(tuple(w[k : k + n]), set()).add(str(i))
    out = []
    for d, t in docs:
        w, hit, found = split(t), set(), set()
        for n in {len(k) for k in known}:
            for k in range(len(w) - n + 1):
                if owners := known.get(tuple(w[k : k + n])):
                    hit.update(range(k, k + n))
                    found |= owners
        out.append((d, len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), bool(hit)))
    return sorted(out, key=str)


@pytest.mark.parametrize("block", [D.BLOCK_BYTES, 900])
def test_against_brute_force(llm, block):
    rng = random.Random(2)
    text = lambda n: " ".join(rng.choice(["Aa", "b", "c-d", "é", "7"]) for _ in range(n))
    items = [(k, text(rng.choice([0, 1, 3, 9, 10, 14]) + 2 * (k > 3))) for k in range(12)] + [(3, "unseen words"), (99, None), (98, "!!")]
    docs = [(k, text(rng.randrange(80))) for k in range(40)] + [(7, items[5][1]), (None, items[6][1]), (50, None)]
    a = llm.createDataFrame(docs, "doc_id long, text string").repartition(3)
    b = llm.createDataFrame(items, "item_id long, text string")
    got = sorted((tuple(r) for r in D.report(a, b, block_bytes=block).collect()), key=str)
    assert got == brute(docs, items)


def test_a_window_of_very_many_items(llm, monkeypatch):
    """One header in every item: its rows are dealt to all blocks, and each document names all items."""
    items = [(k, f"the header of all tests of this suite in ten words {k}") for k in range(400)]
    docs = [(1, "x the header of all tests of this suite in ten y"), (2, "the header of all tests"), (3, items[7][1])]
    sizes, made = [], D._Set.__init__

    def spy(self, rows):
        sizes.append(rows.num_rows)
        made(self, rows)

    monkeypatch.setattr(D._Set, "__init__", spy)
    a, b = llm.createDataFrame(docs, "doc_id long, text string"), llm.createDataFrame(items, "item_id long, text string")
    assert sorted((tuple(r) for r in D.report(a, b, block_bytes=16_000).collect()), key=str) == brute(docs, items)
    assert len(sizes) > 3 and max(sizes) < 1.5 * sum(sizes) / len(sizes)


def test_removal(llm, edges, empty):
    bench = llm.createDataFrame([(1, "same row here with five words"), (2, None)], "item_id long, text string")
    clean = D.remove(edges, bench)
    assert clean.columns == edges.columns and {r.doc_id for r in edges.collect()} - {r.doc_id for r in clean.collect()} == {15}
    cut = D.remove(llm.createDataFrame([(1, "Keep this, same row here WITH five words; and this")], "doc_id long, text string"), bench, "spans").first()
    assert cut.text == "Keep this, ; and this"
    assert D.remove(edges, bench.where("false")).count() == edges.count() and D.report(empty, bench).count() == 0
    assert len(D.report(edges, bench).collect()) == edges.count()


@pytest.mark.parametrize("block", [D.BLOCK_BYTES, 60])
def test_columns_named_as_its_own(llm, block):
    docs = llm.createDataFrame([(1, "a b c d e f g h i j k", 5, "x"), (2, "none of it", 6, "y")], "doc_id long, text string, __words long, __HITS string")
    bench = llm.createDataFrame([(1, "a b c d e f g h i j"), (2, "k")], "item_id long, text string")
    assert [tuple(r) for r in D.remove(docs, bench, block_bytes=block).collect()] == [(2, "none of it", 6, "y")]
    cut = {r.doc_id: tuple(r) for r in D.remove(docs, bench, "spans", block_bytes=block).collect()}
    assert cut == {1: (1, "", 5, "x"), 2: (2, "none of it", 6, "y")}
