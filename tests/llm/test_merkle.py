import hashlib
import random
import zlib

import pytest

from episodica.llm import merkle as M

SCHEMA = "doc_id long, source string, lang string, n_chars long, text string"


def digest(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(row):
    return digest(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row))


def brute(rows):
    leaves, by = [leaf(r) for r in rows], {}
    for k, r in enumerate(rows):
        by.setdefault(r[1], []).append(k)
    siblings = {k: [] for k in range(len(rows))}

    def climb(nodes):
        while len(nodes) > 1:
            up = []
            for a in range(0, len(nodes), 16):
                run = nodes[a : a + 16]
                for j, (_, members) in enumerate(run):
                    for k in members:
                        siblings[k].append(("".join(x for x, _ in run[:j]), "".join(x for x, _ in run[j + 1 :])))
                up.append((digest(*(x for x, _ in run)), [k for _, members in run for k in members]))
            nodes = up
        return nodes[0]

    tops, sub = [], {}
    for s in sorted(by, key=lambda s: (s is not None, (s or "").encode())):
        order = sorted(by[s], key=lambda k: (rows[k][0] is not None, rows[k][0] or 0, leaves[k]))
        tops.append(climb([(leaves[k], [k]) for k in order]))
        sub |= dict.fromkeys(order, tops[-1][0])
    root, out = climb(tops)[0] if tops else None, []
    for k, r in enumerate(rows):
        text = r[4]
        if r[0] is not None and text is not None and zlib.crc32(str(r[0]).encode()) % 5 == 0:
            text = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)
        x = leaf((*r[:4], text))
        for a, b in siblings[k]:
            x = digest(a, x, b)
        out.append((r[0], leaves[k], sub[k], root, digest("".join(a + b for a, b in siblings[k])), x, x == root))
    return sorted(out, key=repr)


def rows(n, sources, seed=1):
    rng = random.Random(seed)
    ids = list(range(n))
    rng.shuffle(ids)
    out = [(i if rng.random() > 0.02 else None, rng.choice(sources), rng.choice(["en", None]), rng.choice([None, 7]), rng.choice([None, "", "Abc é", "X" * 50, "low"])) for i in ids]
    return out + [r for r in out[: n // 20] if r[0] is not None]  # repeated rows and ids


@pytest.mark.parametrize(
    ("n", "sources", "options"),
    [
        (400, ["a", "b", None, "", "é"], {}),
        (700, ["a"], {"least": 1}),  # a tree above the blocks
        (3000, ["a"] * 3 + ["b"], {"most": 8, "least": 1}),  # larger blocks, so that they number few
        (600, [f"s{k}" for k in range(200)] + ["hot"] * 100, {"most": 20, "least": 1}),  # the subroots' own tree
        (1, ["x"], {}),
    ],
)
def test_against_brute_force(llm, n, sources, options):
    data = rows(n, sources)
    got = sorted((tuple(r) for r in M.report(llm.createDataFrame(data, SCHEMA).repartition(5), **options).collect()), key=repr)
    assert got == brute(data)


def test_edges(llm, edges, empty):
    docs = edges.withColumn("n_chars", edges.doc_id * 2)
    out = M.report(docs).collect()
    assert len(out) == docs.count() and len({r.root for r in out}) == 1 and len({r.subroot for r in out}) == len({r.source for r in docs.collect()})
    assert M.report(empty.withColumn("n_chars", empty.doc_id)).count() == 0
    one = M.report(llm.createDataFrame([(5, None, None, None, None)], SCHEMA)).first()
    assert one.leaf == one.subroot == one.root == one.folded_root == digest("1:5", "-", "-", "-", "-") and one.proof_sha256 == digest() and one.verified


def test_rows_of_today_against_kept_proofs(llm, tmp_path):
    data = [r for r in rows(300, ["a", "b"]) if r[0] is not None]
    docs = llm.createDataFrame(data, SCHEMA)
    M.proofs(docs, keep=True).write.parquet(f"{tmp_path}/proofs")
    kept = llm.read.parquet(f"{tmp_path}/proofs")
    assert all(r.verified for r in M.verify(docs, kept).collect())
    changed = [(r[0], r[1], r[2], r[3], (r[4] or "") + "!") if r[0] in (7, 8) else r for r in data] + [(10**6, "a", None, None, "new")]
    now = M.verify(llm.createDataFrame(changed, SCHEMA), kept).collect()
    assert {r.doc_id for r in now if not r.verified} == {7, 8, 10**6} and len(now) == len(changed)


def test_packed_paths():
    steps = [(b"", b""), (b"ab" * 32, b"cd" * 64), (b"", b"01" * 32)]
    assert M.unpacked(M.packed(steps)) == steps


def test_driver_tree_stays_bounded():
    for n in (1, 10**6, 10**9, 10**11):
        assert n / M.FAN ** M._rounds(n, M.LEVELS, M.MOST) <= M.MOST
