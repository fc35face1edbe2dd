import hashlib
import random
import re
import time

import pytest

from episodica.llm import pii as P

PATTERNS = [
    re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"), re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
    re.compile(r"[0-9]([\x20-]?[0-9])+"), re.compile(r"\+[0-9][\x20().0-9-]+[0-9]"),
]


def luhn(digits):
    twice = [int(c) * (2 if k % 2 else 1) for k, c in enumerate(digits[::-1])]
    return sum(v - 9 if v > 9 else v for v in twice) % 10 == 0


def brute(text):
    digits = lambda m: re.sub("[^0-9]", "", m[0])
    fits = [
        lambda m: True, lambda m: all(int(x) <= 255 for x in m[0].split(".")), lambda m: 14 <= len(digits(m)) <= 19 and luhn(digits(m)),
        lambda m: 10 <= len(digits(m)) <= 15,
    ]
    return sorted((m.start(), k, m.end()) for k in range(4) for m in PATTERNS[k].finditer(text) if fits[k](m))


@pytest.mark.parametrize("letters", ["a1.@-", "0123.+ ()-", "ab.@ _%+-é1", "12 -", "1.2+@a"])
def test_base_against_the_patterns(letters):
    rng = random.Random(letters)
    for _ in range(4000):
        text = "".join(rng.choice(letters) for _ in range(rng.randrange(60)))
        assert P.identifiers(text) == brute(text), text


DISGUISED = [
    ("write john.doe [at] example [dot] com now", "email", "john.doe [at] example [dot] com"),
    ("john (at) mail.example (dot) org, ok", "email", "john (at) mail.example (dot) org"),
    ("JOHN AT EXAMPLE DOT COM", "email", "JOHN AT EXAMPLE DOT COM"),
    ("mail john dot doe at mail dot example dot com please", "email", "john dot doe at mail dot example dot com"),
    ("jоhn@exаmple.com is it", "email", "jоhn@exаmple.com"),
    ("Jane.Roe＠example．com", "email", "Jane.Roe＠example．com"),
    ("user​name@exam​ple.com", "email", "user​name@exam​ple.com"),
    ("mail john @ example . com", "email", "john @ example . com"),
    ("j&#64;x&period;com", "email", "j&#64;x&period;com"),
    ("john-at-example-dot-com", "email", "john-at-example-dot-com"),
    ("first_last at example.co.uk", "email", "first_last at example.co.uk"),
    ("tel plus one five five five zero one two three four five six seven end", "phone", "plus one five five five zero one two three four five six seven"),
    ("call +1 (zero one seven) five five five - seven seven one three.", "phone", "+1 (zero one seven) five five five - seven seven one three"),
    ("plus four nine, one seven zero, double two three four five six seven", "phone", "plus four nine, one seven zero, double two three four five six seven"),
    ("+1 555 O12 34l7 9", "phone", "+1 555 O12 34l7 9"),
    ("+١ ٥٥٥ 123 4567", "phone", "+١ ٥٥٥ 123 4567"),
    ("ip one nine two dot one six eight dot zero dot one.", "ip", "one nine two dot one six eight dot zero dot one"),
    ("１９２.168.0.1", "ip", "１９２.168.0.1"),
    ("pay four" + " one" * 15 + " x", "card", "four" + " one" * 15),
    ("4111 1111‑1111 1111", "card", "4111 1111‑1111 1111"),
]


@pytest.mark.parametrize(("text", "kind", "what"), DISGUISED)
def test_disguises(text, kind, what):
    base, found = P.spans(text)
    assert base == brute(text) and set(base) <= set(found)
    assert [(P.KINDS[k], text[a:b]) for a, k, b in found if (a, k, b) not in base] == [(kind, what)]


@pytest.mark.parametrize(
    "text",
    [
        "look at the dot in the middle", "meet us at example.com today", "we met at noon. Com is", "one, two, three, four steps", "stay-at-home, look-at-me.com", "a(b)c.com",
        "Она сказала.", "call +1 (848) 555-1373 un jour", "write a@b.com. It is mine", "at 10.30 dot", "m² and 12– 14",
    ],
)
def test_clean_texts_get_nothing_more(text):
    base, found = P.spans(text)
    assert base == found == brute(text)


def test_edits_map_back():
    """A place in what any chain of edits wrote lies in the range it came from."""
    rng = random.Random(9)
    for _ in range(300):
        text, chain, owner = "".join(rng.choice("abcdef") for _ in range(40)), [], None
        owner = [(k, k + 1) for k in range(len(text))]
        now = text
        for _ in range(3):
            cuts = sorted(rng.sample(range(len(now) + 1), min(6, len(now) // 2 * 2)))
            edits = [(a, b, rng.choice(["", "X", "YZ"])) for a, b in zip(cuts[::2], cuts[1::2], strict=True)]
            made, at = [], 0
            for a, b, new in edits:
                made += owner[at:a] + [(owner[a][0], owner[b - 1][1])] * len(new)
                at = b
            owner = made + owner[at:]
            chain.append(P.Written(now, edits))
            now = chain[-1].text
        assert len(now) == len(owner)
        for a in range(len(now)):
            for b in range(a + 1, len(now) + 1):
                assert P.chained(chain, a, b) == (owner[a][0], owner[b - 1][1])


@pytest.mark.parametrize("unit", ["a", "1", "1.", "+1 ", "@a.b", "one two ", "john at example dot ", "O1l0", "а.я ", "-at-", "[at] ", "one "])
def test_long_texts_take_time_in_proportion(unit):
    began = time.perf_counter()
    P.spans(unit * (400_000 // len(unit)))
    assert time.perf_counter() - began < 20


def test_report(llm, edges, empty, docs):
    rows = [(1, "mail a@b.co, +1 (555) 555-0100 and 10.0.0.1; a [at] b [dot] co"), (None, None), (2, ""), (2, "4111 1111 1111 1111")]
    got = {r.spans: r for r in P.report(llm.createDataFrame(rows, "doc_id long, text string")).collect()}
    first = got["email:5:11,phone:13:30,ip:35:43,email:45:62"]
    assert (first.doc_id, first.n_email, first.n_ip, first.n_card, first.n_phone) == (1, 1, 1, 0, 1)
    assert first.base_sha256 == hashlib.sha256(b"email:5:11,phone:13:30,ip:35:43").hexdigest()
    assert got["card:0:19"].n_card == 1 and got[""].base_sha256 == hashlib.sha256(b"").hexdigest()
    assert P.report(edges).count() == edges.count() and P.report(empty).count() == 0
    for r in P.report(docs).join(docs.select("doc_id", "text"), "doc_id").collect():
        base = brute(r.text or "")
        shown = ",".join(f"{P.KINDS[k]}:{a}:{b}" for a, k, b in base)
        assert r.base_sha256 == hashlib.sha256(shown.encode()).hexdigest() and r.spans == shown


def test_redaction(llm, edges):
    df = llm.createDataFrame([(1, "é: a@b.co or a [at] b [dot] co!"), (2, None)], "doc_id long, text string").selectExpr("*", "1 as __spans")
    out = {r.doc_id: r for r in P.redact(df).collect()}
    assert out[1].text == "é: [EMAIL] or [EMAIL]!" and out[2].text is None and out[1]["__spans"] == 1
    assert P.redact(edges).columns == edges.columns
