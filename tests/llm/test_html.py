import html
import random
import re

import numpy as np
import pytest

from episodica.llm import html_extract as H
from episodica.llm.boosting import Trees
from episodica.llm.dom import Page


def test_trees_learn_a_pattern():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(4000, 6))
    y = ((x[:, 0] > 0) ^ (x[:, 3] > 0.5)).astype(float)
    t = Trees(40, 3).fit(x[:3000], y[:3000])
    assert ((t.logits(x[3000:]) > 0) == y[3000:]).mean() > 0.95


def test_reader_follows_implied_ends():
    p = Page(
        "<body><p>a<p><b>b &amp; c<br><p>d\n e<div>f<ul><li>g<li>h</ul></div></p>i<script>var x='<p>no</p>'</script><!-- <p>no -->j<table><tr><td>k<td>l</table><p>unclosed \"<a href='x>y'>z</a>"
    )
    assert [b[1] for b in p.blocks] == ["a", "b & c", "d e", "f", "g", "h", "ij", "k", "l", 'unclosed "z']
    assert p.end[0] == len(p.parent) and all(k < p.end[k] <= p.end[max(p.parent[k], 0)] for k in range(len(p.parent)))


def blocks(source):
    p = Page(source)
    assert p.end[0] == len(p.parent) and all(k < p.end[k] <= p.end[max(p.parent[k], 0)] for k in range(len(p.parent)))
    return [b[1] for b in p.blocks]


def test_elements_without_text_end_with_their_parent():
    article = "<article><h1>t</h1><p>a <b>b</b></p><p>c</p></article>"
    for top in (
        "<form><datalist><option value=a><option value=b></datalist></form>", "<form><select><option>x<option>y</form>", "<div><label>l <select><option>x</label></div>",
        "<div><noscript>n<p>m</div>", "<div><svg><g><text>s</div>", "<svg><g><text>s", "<a href=x><svg><path></a>", "<div><canvas>v</div>", "<header><template><p>q</header>",
        "<table><tr><td><select><option>x<td>k</table>", "<ul><li><canvas>v<li>k</ul>", "<select><option>x<input>", "<div><select><option>x<option>y</select></div>", "<svg/>",
        "<noscript><div><p>n</div></noscript>", "<template><ul><li>n<li>m</ul></template>", "<svg><title>i</title><foreignObject><p>s</p></foreignObject></svg>",
    ):
        shown = [b for b in blocks(f"<body>{top}{article}<select><option>z</option></select></body>") if b not in ("l", "k")]
        assert shown == ["t", "a b", "c"], top
    assert blocks("<p>one<svg><path d=x></path><text>no</text></svg> two<noscript>no</noscript> three</p>") == ["one two three"]
    assert blocks("<p>a<p>b<script>x<p>no") == ["a", "b"]


def test_formulas_and_objects_are_text():
    assert blocks("<p>so <math><semantics><mrow><mi>x</mi><mo>=</mo><mn>2</mn></mrow><annotation encoding='tex'>no</annotation></semantics></math> holds</p>") == ["so x=2 holds"]
    assert blocks("<div>see <object data=x><param name=a><p>a text</p></object></div>") == ["see", "a text"]


def test_composed_pages_come_back():
    rng, trees = random.Random(123), H.fitted()
    kept = found = main = 0
    for _ in range(120):
        source, truth = H.composed_page(rng)
        assert truth <= {b[1] for b in Page(source).blocks}
        got = {t for t in H.main_texts([source], trees)[0].split("\n") if t}
        kept, found, main = kept + len(got & truth), found + len(got), main + len(truth)
    assert kept / main > 0.95 and kept / found > 0.97


SENTENCES = [
    "The council met on Tuesday evening to consider the new plan for the harbour, which has been debated for months.",
    "Residents, many of whom have lived near the water for decades, said that traffic was their main concern.",
    "\u201cWe want the work done,\u201d said one of them, \u201cbut not at the price of our street.\u201d",
    "Engineers presented three variants; each moves the entrance further north, and each would cost more than planned.",
    "A decision is expected in spring, after a second hearing.",
]
TITLE = "Harbour plan divides the town"
MENU = '<div class="menu"><ul><li><a href="/">Home</a></li><li><a href="/n">News</a></li><li><a href="/s">Sports</a></li><li><a href="/c">Contact</a></li></ul></div>'
NAV = '<nav><a href="/">Home</a> <a href="/a">About us</a> <a href="/b">Blog</a></nav>'
FOOT = "<footer>&copy; 2024 The Gazette. All rights reserved.</footer>"
SAID = ("I think this is a really bad idea, they should have asked us before.", "Finally someone does something about the harbour!", "Why does it always cost more than planned?")
COMMENTS = '<div class="comments"><h3>Comments</h3>' + "".join(f'<div class="comment"><p>{x}</p></div>' for x in SAID) + "</div>"
SIDE = '<div class="sidebar"><h4>Most read</h4><ul><li><a href="/1">Storm warning for the coast</a></li><li><a href="/2">New bakery opens</a></li></ul></div>'
PARAGRAPHS = "".join(f"<p>{x}</p>" for x in SENTENCES)
#: Written by hand, apart from the grammar: what stands in the body, and the article's blocks.
BY_HAND = {
    "text and line breaks in the body": (MENU + "<br><br>".join(SENTENCES) + FOOT, [" ".join(SENTENCES)]),
    "text only": (" ".join(SENTENCES), [" ".join(SENTENCES)]),
    "elements of a story": (MENU + '<div class="story">' + "".join(f"<div>{x}</div>" for x in SENTENCES) + "</div>" + FOOT, SENTENCES),
    "paragraphs in the body": (MENU + PARAGRAPHS + FOOT, SENTENCES),
    "heading and paragraphs in the body": (f"{NAV}<h1>{TITLE}</h1>{PARAGRAPHS}{FOOT}", [TITLE, *SENTENCES]),
    "main": (f"{NAV}<main><h1>{TITLE}</h1>{PARAGRAPHS}</main>{FOOT}", [TITLE, *SENTENCES]),
    "main with one paragraph": (f"{NAV}<main><h1>{TITLE}</h1><p>{SENTENCES[0]}</p></main>{FOOT}", [TITLE, SENTENCES[0]]),
    "one paragraph beside comments": (f'{NAV}<div id="content"><p>{SENTENCES[0]}</p></div>{COMMENTS}{FOOT}', SENTENCES[:1]),
    "one paragraph above comments": (f'{NAV}<div id="content"><p>{SENTENCES[0]}</p>{COMMENTS}</div>{FOOT}', SENTENCES[:1]),
    "cells": (f"<table><tr><td>{MENU}</td><td><h1>{TITLE}</h1>{PARAGRAPHS}</td></tr></table>{FOOT}", [TITLE, *SENTENCES]),
    "nested, without names": (f"<div><div>{NAV}</div><div><div><h1>{TITLE}</h1>{PARAGRAPHS}</div>{SIDE}</div></div>{FOOT}", [TITLE, *SENTENCES]),
    "beside a side bar and comments": (f"{NAV}<article><h1>{TITLE}</h1>{PARAGRAPHS}</article>{SIDE}{COMMENTS}{FOOT}", [TITLE, *SENTENCES]),
    "not shown": (f'{NAV}<main><h1>{TITLE}</h1>{PARAGRAPHS}<div style="display:none">Subscribe now to read the rest of this story and many others.</div></main>{FOOT}', [TITLE, *SENTENCES]),
    "sections and a list": (
        f'{NAV}<div id="main"><h1>{TITLE}</h1><p>{SENTENCES[0]}</p><h2>What comes next</h2><p>{SENTENCES[1]}</p><ul><li>{SENTENCES[2]}</li><li>{SENTENCES[3]}</li></ul></div>{FOOT}',
        [TITLE, SENTENCES[0], "What comes next", *SENTENCES[1:4]],
    ),
    "spans": (f"{MENU}<div><h1>{TITLE}</h1>" + "".join(f"<div><span>{x}</span></div>" for x in SENTENCES) + f"</div>{FOOT}", [TITLE, *SENTENCES]),
    "cookies": (f'<div id="cookie-banner"><p>We use cookies to give you the best experience.</p><button>Accept</button></div>{NAV}<article><h1>{TITLE}</h1>{PARAGRAPHS}</article>{FOOT}', [TITLE, *SENTENCES]),
    "a form between": (f'{NAV}<div class="content"><h1>{TITLE}</h1><p>{SENTENCES[0]}</p><form><label>Mail</label><input><button>Subscribe</button></form><p>{SENTENCES[1]}</p></div>{FOOT}', [TITLE, *SENTENCES[:2]]),
    "nothing else": (f"<h1>{TITLE}</h1>{PARAGRAPHS}", [TITLE, *SENTENCES]),
}


@pytest.mark.parametrize("name", BY_HAND)
def test_pages_written_by_hand(name):
    body, want = BY_HAND[name]
    source = f"<!DOCTYPE html><html><head><title>{TITLE}</title></head><body>{body}</body></html>"
    assert H.main_texts([source], H.fitted())[0].split("\n") == want


def test_trees_are_kept(llm):
    trees = H.shared_trees(llm, 40, 3)
    H._fitted.pop((40, 3))
    again, x = H.shared_trees(llm, 40, 3), np.random.default_rng(1).normal(size=(50, len(trees.edges)))
    assert again is not trees and np.array_equal(again.logits(x), trees.logits(x))


def test_what_a_page_does_not_show():
    p = Page("<div hidden>a</div><div style='x:y; Display : NONE'>b</div><p aria-hidden='true'>c</p><p aria-hidden=false data-hidden=1>d</p><p style='color:red'>e</p>")
    unseen = 1 << H.GROUPS.index("hidden")
    assert [bool(p.hints[k] & unseen) for k, _, _ in p.blocks] == [True, True, True, False, False]


def test_decoding_has_no_contradiction():
    rng, pages, trees = np.random.default_rng(5), random.Random(5), H.fitted()
    for _ in range(30):
        p = Page(H.composed_page(pages)[0])
        odds = rng.normal(size=len(p.parent)) * 3
        kept = H.decode(p, odds)
        assert set(kept) <= {b[1] for b in p.blocks}
        assert H.decode(p, np.full(len(p.parent), 5.0)) == [b[1] for b in p.blocks] and H.decode(p, np.full(len(p.parent), -5.0)) == []
    assert trees is H.fitted()


def choices(page, k):
    """Every way to decide the subtree of node k: (sets of kept nodes, splits paid for)."""
    inside, children = list(range(k, page.end[k])), [j for j in range(k + 1, page.end[k]) if page.parent[j] == k]
    out = [(frozenset(inside), 0), (frozenset(), 0)]
    if children:
        for own in (frozenset(), frozenset([k])):
            some = [(own, 1)]
            for j in children:
                some = [(a | b, m + n) for a, m in some for b, n in choices(page, j)]
            out += some
    return out


def test_decoding_is_the_best_choice():
    """Against all choices on small trees: what is kept is worth as much as the best of them."""
    rng, checked = np.random.default_rng(8), 0
    for _ in range(60):
        p = Page("".join(rng.choice(["<div>", "<ul>", "<p>a b c", "x</div>", "</ul>", "<li>word. ", "</li>", "text"], 9)))
        if not 2 <= len(p.parent) <= 7:
            continue
        odds = rng.normal(size=len(p.parent)) * 2
        weight = np.zeros(len(p.parent))
        for node, text, _ in p.blocks:
            weight[node] += 1 + np.log1p(len(text))
        own = weight * np.clip(odds, -6, 6)
        value = lambda kept, paid: sum(x if k in kept else -x for k, x in enumerate(own)) - H.PRICE * paid  # noqa: E731, B023
        best = max(value(*c) for c in choices(p, 0))
        got = H.decode(p, odds)
        texts = lambda kept: [t for n, t, _ in p.blocks if n in kept]  # noqa: E731, B023
        assert any(abs(value(*c) - best) < 1e-9 and texts(c[0]) == got for c in choices(p, 0))
        checked += 1
    assert checked > 25


def truth(page):
    inner = page[page.index("<article>") + 9 : page.index("</article>")]
    blocks = (re.sub(r"\s+", " ", html.unescape(re.sub(r"<[^>]+>", " ", b))).strip() for b in re.split(r"</?(?:h1|p)>", inner))
    return "\n".join(b for b in blocks if b)


def test_whole_table(llm):
    pages = llm.read.parquet("/root/testdata/sf0.01/pages.parquet")
    rows = H.extract(pages).join(pages.select("page_id", "html"), "page_id").collect()
    assert len(rows) == pages.count() and all(r.text == truth(r.html) and r.n_chars == len(r.text) for r in rows)


def test_edges(llm):
    rows = [
        (1, "u", None),
        (2, None, ""),
        (None, "u", "<p"),
        (4, "u", "plain text only"),
        (4, "u", "<article><p>" + "word, and more. " * 40_000 + "</p></article>"),
        (5, "u", "<" * 5000),
        (6, "u", "<div>" * 3000 + "deep")
    ]
    df = llm.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "1 as text", "2 as n_chars")
    out = H.extract(df).collect()
    assert len(out) == 7 and all(r.text == "" for r in out if r.page_id in (1, 2)) and max(r.n_chars for r in out) == len("word, and more. " * 40_000) - 1
    assert H.extract(df.where("false")).count() == 0


def test_elements_that_stand_in_a_line():
    assert blocks("<p>a <picture><source srcset=x><img src=y></picture>b <output>c</output> <my-tag class=x>d <b>e</b></my-tag> f</p>") == ["a b c d e f"]
    assert blocks("<p>x <video src=v>no video</video> y<fieldset><legend>l</legend>z</fieldset>") == ["x no video y", "l", "z"]


def test_a_reference_ends_with_its_text():
    assert blocks("<p>&am<b>p;lt</b> &lt;b&gt; &#x26;amp; &nbsp;&eacute;</p>") == ["&amp;lt <b> &amp; é"] or blocks("<p>&am<b>p;lt</b></p>") == ["&amp;lt"]
    assert blocks("<p>a&lt<i>b</i> &copy;&notit; &#0;</p>")[0].startswith("a<b ©¬it;")
