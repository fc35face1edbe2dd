"""Main-text extraction: gradient-boosted trees over DOM-node features, decoded along the tree.

A page becomes block-level nodes.  Each gets features of its subtree (text, tags, links and their densities), its
attribute tokens, its place (depth, siblings, share of the page before it) and what its ancestors are.  Boosted
trees give the log odds that the node's own text is main text.  Decoding then chooses for every node to keep its
whole subtree, to drop it whole, or to leave the choice to its children at a price; the best total is found from
the leaves up, so no node can be kept below a dropped ancestor or dropped below a kept one.

The trees are trained here, on pages composed by `composed_page` from a grammar of layouts whose parts are known;
their number is a parameter.  The model is a fixed number of small trees, kept in the shared folder once fitted, and travels with
the task.

Null or empty html: an empty text.  Broken markup: elements end as HTML's implied end tags say, unclosed ones at
their parent's end.  Very long pages are read whole, a batch at a time.  Null ids and urls stay null.  Repeated rows alike, extra
columns are ignored, an empty table stays empty.  Of equally good choices a node is kept or dropped whole.
"""

from __future__ import annotations

import hashlib
import inspect
import random
import sys
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import shared_dir
from . import boosting, dom, store
from .boosting import Trees
from .dom import GROUPS, TAGS, Page

#: Pages composed for training.
PAGES = 1500
#: Price of leaving the choice to the children, in log odds.
PRICE = 0.5
_PLACES = tuple(TAGS.index(t) for t in ("article", "main", "nav", "header", "footer", "aside", "form", "li", "table"))
#: Groups and tags that are no part of an article, as bits.
_OFF = sum(1 << k for k, g in enumerate(GROUPS) if g not in ("content", "meta"))
_OFF_TAGS = sum(1 << (len(GROUPS) + TAGS.index(t)) for t in ("nav", "header", "footer", "aside", "form"))
#: Boosting rounds, and the share of nodes each sees.
ROUNDS, SHARE = 120, 0.4


def node_features(pages: list[Page]) -> tuple[np.ndarray, np.ndarray]:
    """(features, first node of each page) of all nodes; a page's node 0 is the page itself."""
    first = np.r_[0, np.cumsum([len(p.parent) for p in pages])]
    n = int(first[-1])
    join = lambda f, kind=np.int64: np.fromiter((x for p in pages for x in f(p)), kind, n)
    shift = np.repeat(first[:-1], np.diff(first))
    parent, end = join(lambda p: p.parent), join(lambda p: p.end) + shift
    tag, hints, links = join(lambda p: p.tag), join(lambda p: p.hints), join(lambda p: p.links)
    root = parent < 0
    parent = np.where(root, np.arange(n), parent + shift)
    own, linked, marks, blocks = np.zeros(n), np.zeros(n), np.zeros(n), np.zeros(n)
    for p, a in zip(pages, first, strict=False):
        for node, text, in_link in p.blocks:
            own[a + node] += len(text)
            linked[a + node] += min(in_link, len(text))
            marks[a + node] += text.count(".") + text.count(",") + text.count("!") + text.count("?")
            blocks[a + node] += 1
    sums = lambda x: (c := np.r_[0.0, np.cumsum(x)])[end] - c[np.arange(n)]
    below = sums(np.ones(n))
    text, link_text, mark, block = sums(own), sums(linked), sums(marks), sums(blocks)
    total = np.maximum(text[shift], 1)
    before = (np.r_[0.0, np.cumsum(own)][np.arange(n)] - np.r_[0.0, np.cumsum(own)][shift]) / total
    depth, bits, marked = np.zeros(n), (1 << (tag.clip(0) + len(GROUPS))) * (tag >= 0) | hints, np.zeros(n, np.int64)
    above = np.zeros(n, np.int64)
    level = np.flatnonzero(root)
    children = np.argsort(parent, kind="stable")
    cut = np.searchsorted(parent[children], np.arange(n + 1))
    while len(level):  # from the root down, a level at once
        size = cut[level + 1] - cut[level]
        at = np.repeat(cut[level] - np.r_[0, np.cumsum(size)[:-1]], size) + np.arange(size.sum())
        nxt = children[at]
        nxt = nxt[~root[nxt]]
        depth[nxt] = depth[parent[nxt]] + 1
        above[nxt] = above[parent[nxt]] | bits[parent[nxt]]
        level = nxt
    del marked
    order = children[~root[children]]
    siblings = np.bincount(parent[order], minlength=n)[parent]
    place = np.zeros(n)
    place[order] = np.arange(len(order)) - np.searchsorted(parent[order], parent[order])
    same = np.unique(parent * 64 + tag.clip(0), return_inverse=True)[1]
    alike = np.bincount(same)[same]
    share = lambda a, b: a / np.maximum(b, 1)
    title = tag == TAGS.index("h1")
    titles = np.cumsum(title) - title  # before each node, and of these those of its own page
    titles = titles - titles[shift]
    at = np.maximum.accumulate(np.where(title, np.arange(n), -1))
    since = np.where(titles > 0, before - before[np.maximum(at, 0)], -1.0)
    alike_text = np.bincount(same, own)[same]
    up_text, up_link, up_block = text[parent], link_text[parent], block[parent]
    columns = [
        np.log1p(own), np.log1p(text), text / total, share(text, below), share(link_text, text), share(linked, own), share(mark, text), share(marks, own),
        np.log1p(below), depth, np.log1p(siblings), share(place, siblings), share(alike, siblings), before, sums(links) / np.maximum(block, 1),
        share(text, block), np.log1p(up_text), share(up_link, up_text), share(up_text, up_block), text / np.maximum(up_text, 1), tag,
        np.minimum(titles, 3), since, alike_text / total, share(alike_text, alike), share(own, text), np.log1p(total), np.bitwise_count((hints | above) & _OFF), np.bitwise_count((above | bits) & _OFF_TAGS),
    ]
    columns += [hints >> k & 1 for k in range(len(GROUPS))] + [above >> k & 1 for k in range(len(GROUPS))]
    columns += [(above | bits) >> (len(GROUPS) + t) & 1 for t in _PLACES]
    return np.stack(columns, axis=1).astype(float), first


def decode(page: Page, odds: np.ndarray, price: float = PRICE) -> list[str]:
    """The blocks kept, from log odds by node."""
    n = len(page.parent)
    weight = np.zeros(n)
    for node, text, _ in page.blocks:
        weight[node] += 1 + np.log1p(len(text))
    own = weight * np.clip(odds, -6, 6)
    below = np.r_[0.0, np.cumsum(own)]
    keep = below[page.end] - below[np.arange(n)]  # of the whole subtree; dropping it is worth the opposite
    best, split = np.abs(keep), np.zeros(n, bool)
    inner = np.abs(own)
    for k in range(n - 1, -1, -1):
        apart = inner[k] - price
        if page.end[k] > k + 1 and apart > best[k]:
            best[k], split[k] = apart, True
        if k:
            inner[page.parent[k]] += best[k]
    kept, until = np.zeros(n, bool), 0
    for k in range(n):
        if k < until:
            continue
        if split[k]:
            kept[k] = own[k] > 0
        else:
            kept[k : page.end[k]] = keep[k] > 0
            until = page.end[k]
    return [text for node, text, _ in page.blocks if kept[node]]


def composed_page(rng: random.Random) -> tuple[str, set[str]]:
    """A page of a random layout, and the texts of its main blocks (texts are unique within the page).

    The article stands in a container with or without a telling name, in several of them, in a table's cell, or straight in the
    body; its blocks are paragraphs, div elements, or text between line breaks."""
    serial = [0]
    pick = lambda *x: x[int(rng.random() * len(x))]
    chance = lambda p: rng.random() < p

    def word() -> str:
        return "".join(pick("ta", "ri", "on", "es", "lo", "men", "ka", "vi", "dor", "un") for _ in range(pick(1, 2, 3)))

    def words(a: int, b: int, dots: bool = True) -> str:
        serial[0] += 1
        out = [word() for _ in range(rng.randint(a, b))]
        if dots:
            out = [w + pick("", "", "", "", "", "", ",", ".") for w in out]
        return " ".join(out).capitalize() + f" {serial[0]}" + ("." if dots else "")

    def attributes(*names: str) -> str:
        if chance(0.45):
            return ""
        return f' {pick("class", "class", "id")}="{pick("", "", "c-", "site-", "b1 ")}{pick(*names)}{pick("", "", "-box", "_wrap", "1")}"'

    main: set[str] = set()

    def kept(text: str) -> str:
        main.add(text)
        return text

    style = pick("p", "p", "p", "p", "div", "break", "mixed")
    plain = chance(0.12)  # no part of the article has a name or an element of its own

    def paragraph() -> str:
        text = words(*pick((1, 4), (4, 25), (15, 60), (40, 120)))
        way = style if style != "mixed" else pick("p", "div")
        if way == "div":
            return f"<div>{kept(text)}</div>"
        if way == "break":
            more = [text] + [words(8, 60) for _ in range(pick(0, 1, 1, 2, 3))]
            kept(" ".join(more))
            return pick("<br><br>", "<br/><br/>", "<br>\n<br>").join(more) + pick("", "<br><br>", "<hr>") + "<!-- -->"
        text = kept(text)
        return pick(f"<p>{text}</p>", f"<p>{text}</p>", f"<p>{text}</p>", f"<p>{text}", f"<p><b>{text}<br>", f"<p><em>{text}</em></p>")

    def parts_of_article() -> list[str]:
        parts = [f"<h1>{kept(words(2, 12, False))}</h1>"] if chance(0.85) else []
        loose = False  # text without an element of its own ends where one begins
        for _ in range(pick(0, 1, 1, 2) if chance(0.4) else rng.randint(2, 15)):
            x = rng.random()
            if x < 0.78:
                if style == "break" and loose:
                    parts.append("<hr>")
                parts.append(paragraph())
                loose = True
                continue
            loose = False
            if x < 0.84:
                parts.append(f"<{(h := pick('h2', 'h3', 'h4'))}>{kept(words(1, 8, False))}</{h}>")
            elif x < 0.89:
                parts.append(f"<{(t := pick('ul', 'ol'))}>" + "".join(f"<li>{kept(words(3, 25))}</li>" for _ in range(rng.randint(2, 5))) + f"</{t}>")
            elif x < 0.92:
                parts.append(f"<blockquote><p>{kept(words(8, 40))}</p></blockquote>")
            elif x < 0.95:
                parts.append("<table>" + "".join(f"<tr><td>{kept(words(1, 4))}</td><td>{kept(words(1, 6))}</td></tr>" for _ in range(rng.randint(2, 4))) + "</table>")
            elif x < 0.98:
                y = rng.random()
                if y < 0.3:
                    parts.append(f'<div class="{pick("ad", "ads", "promo", "sponsored")}">{words(3, 20)}</div>')
                elif y < 0.45:
                    parts.append(unseen())
                elif y < 0.7:
                    parts.append(form())
                else:
                    parts.append(box(("related", "share", "newsletter", "widget", "toc"), ("aside", "div")))
            else:
                parts.append(f"<pre>{kept(words(5, 30))}</pre>")
        if not main:
            parts.append(f"<p>{kept(words(15, 60))}</p>")
        return parts

    def article() -> str:
        body = "".join(parts_of_article())
        if plain:
            return pick(body, body, f"<div>{body}</div>")
        if chance(0.3):
            body = f"<div{attributes('content', 'entry', 'text', 'body')}>{body}</div>"
        if chance(0.1):
            body = f"<div><div>{body}</div></div>"
        return pick(
            f"<article{attributes('post', 'article', 'entry')}>{body}</article>",
            f"<article>{body}</article>",
            f"<main{attributes('main', 'content')}>{body}</main>",
            f'<div {pick("class", "id")}="{pick("content", "article-body", "post", "entry-content", "main", "story", "text")}">{body}</div>',
            f"<div>{body}</div>",
            f"<section{attributes('content', 'article')}>{body}</section>",
            f"<td>{body}</td>" if chance(0.3) else body,
        )

    def link() -> str:
        return f'<a href="/{word()}">{words(1, 3, False)}</a>'

    def menu(name: str = "") -> str:
        inner = "<ul>" + "".join(f"<li>{link()}</li>" for _ in range(rng.randint(3, 11))) + "</ul>" if chance(0.8) else pick(" ", " | ").join(link() for _ in range(rng.randint(3, 8)))
        return pick(f"<nav{attributes('menu', 'nav')}>{inner}</nav>", f'<div class="{name or pick("menu", "navbar", "navigation", "breadcrumb")}">{inner}</div>', f"<div>{inner}</div>" if chance(0.3) else f"<nav>{inner}</nav>")

    def box(names: tuple[str, ...], tags: tuple[str, ...] = ("div",)) -> str:
        inner = pick(
            words(3, 30),
            f"<p>{words(3, 40)}</p>",
            f"<h3>{words(1, 4, False)}</h3><p>{words(5, 40)}</p>",
            f"<h4>{words(1, 3, False)}</h4><ul>" + "".join(f"<li>{link()}</li>" for _ in range(rng.randint(2, 6))) + "</ul>",
            f"<p>{words(10, 60)}</p><p>{words(5, 40)}</p>"
        )
        t = pick(*tags)
        return f'<{t} {pick("class", "class", "id")}="{pick(*names)}">{inner}</{t}>' if t == "div" else f"<{t}{attributes(*names)}>{inner}</{t}>"

    def unseen() -> str:
        return f"<{(t := pick('div', 'p', 'section'))} {pick('hidden', 'style=\"display:none\"', 'style=\"color:red; display: none\"', 'aria-hidden=\"true\"')}>{words(3, 60)}</{t}>"

    def form() -> str:
        return f'<form action="/{word()}"><label>{words(1, 4, False)}</label><input name="{word()}">{pick("", f"<p>{words(3, 12)}</p>")}<button>{words(1, 2, False)}</button></form>'

    def comments() -> str:
        long = pick((3, 50), (3, 50), (20, 120))
        one = lambda: pick(f'<div class="comment"><b>{words(1, 2, False)}</b><p>{words(*long)}</p></div>', f"<li><p>{words(*long)}</p></li>", f'<div class="comment">{words(*long)}</div>')
        return f'<{(t := pick("div", "section", "ol"))} {pick("id", "class")}="{pick("comments", "replies", "discussion", "reader-comments")}">{pick("", f"<h3>{words(1, 3, False)}</h3>")}' + "".join(
            one() for _ in range(rng.randint(1, 8))
        ) + f"</{t}>"

    some = lambda share, f, *x: f(*x) if chance(share) else ""
    top = some(0.6, menu) + some(0.4, lambda: f"<header{attributes('header', 'masthead')}>{pick(f'<h2>{words(1, 4, False)}</h2>', f'<p>{words(2, 10)}</p>', '')}{some(0.6, menu)}</header>")
    notice = some(0.3, box, ("cookie-notice", "consent", "alert", "newsletter", "popup")) + some(0.08, unseen)
    advert = some(0.5, box, ("ad", "ads", "advert", "sponsored", "promo", "ad-slot"))
    body = article()
    side = some(0.35, box, ("sidebar", "widget", "related", "side"), ("aside", "div", "aside"))
    tail = some(0.3, form) + some(0.3, comments) + some(0.2, box, ("share", "social", "related-posts"))
    foot = some(
        0.8,
        lambda: pick(
            f"<footer{attributes('footer')}>&copy; {words(1, 30)}{some(0.4, menu)}</footer>",
            f"<footer>&copy; {word()}.example &middot; {words(4, 60)}</footer>",
            f'<div class="footer">{words(2, 20)} {link()}</div>'
        )
    )
    if body.startswith("<td>"):  # a layout by cells
        cells = [f"<td>{menu()}</td>", body] + ([f'<td class="side">{side}</td>'] if side else [])
        middle = [notice, advert, f"<table><tr>{''.join(cells)}</tr></table>", tail]
    elif chance(0.5):
        middle = [notice, advert, *rng.sample([body, side], 2), tail]
    else:
        middle = [advert, body, notice, side, tail]
    inner = top + "".join(f"<div{attributes('wrapper', 'container', 'row')}>{x}</div>" if x and chance(0.15) and not plain else x for x in middle) + foot
    if chance(0.4) and not plain:
        inner = f"<div{attributes('page', 'wrapper', 'container')}>{inner}</div>"
    return f"<!DOCTYPE html><html><head><title>{words(1, 9, False)}</title><style>p{{}}</style><script>var x='</p>';</script></head><body>{inner}" + pick(
        "</body></html>",
        "</body></html>",
        ""
    ), main


_fitted: dict[tuple[int, int], Trees] = {}


def fitted(pages: int = PAGES, seed: int = 11) -> Trees:
    """Trees trained on composed pages: a node's text counts as main if most of its own characters are."""
    if (pages, seed) not in _fitted:
        rng = random.Random(seed)
        made = [composed_page(rng) for _ in range(pages)]
        read = [Page(h) for h, _ in made]
        x, first = node_features(read)
        y, own = np.zeros(len(x)), np.zeros(len(x))
        for p, (_, main), a in zip(read, made, first, strict=False):
            for node, text, _ in p.blocks:
                own[a + node] += len(text)
                y[a + node] += len(text) * (text in main)
        some = own > 0
        _fitted[pages, seed] = Trees(ROUNDS, share=SHARE).fit(x[some], (y[some] > own[some] / 2).astype(float))
    return _fitted[pages, seed]


def shared_trees(spark: SparkSession, pages: int = PAGES, seed: int = 11) -> Trees:
    """`fitted`, kept in the shared folder under a name made of what it depends on: grammar, reader, features, sizes."""
    if (pages, seed) not in _fitted:
        code = "".join(inspect.getsource(m) for m in (sys.modules[__name__], dom, boosting))
        path = f"{shared_dir(spark)}/extractor-{hashlib.sha256(f'{code}{pages}:{seed}'.encode()).hexdigest()[:24]}"
        jvm = spark._jvm
        done = jvm.org.apache.hadoop.fs.Path(f"{path}/_SUCCESS")
        if done.getFileSystem(spark._jsc.hadoopConfiguration()).exists(done):
            _fitted[pages, seed] = Trees.loaded(bytes(spark.read.schema("trees binary").parquet(path).first().trees))
        else:
            spark.createDataFrame([(bytearray(fitted(pages, seed).saved()),)], "trees binary").coalesce(1).write.mode("overwrite").parquet(path)
    return _fitted[pages, seed]


def main_texts(sources: list[str], trees: Trees, price: float = PRICE) -> list[str]:
    pages = [Page(s) for s in sources]
    x, first = node_features(pages)
    own = np.zeros(len(x), bool)
    for p, a in zip(pages, first, strict=False):
        own[[a + b[0] for b in p.blocks]] = True
    odds = np.zeros(len(x))
    if own.any():
        odds[own] = trees.logits(x[own])
    return ["\n".join(decode(p, odds[a:b], price)) for p, a, b in zip(pages, first[:-1], first[1:], strict=True)]


def _extracted(shared, price: float) -> Callable:
    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trees = shared.value
        for batch in store.batches(it, 1 << 20, "html"):
            texts = main_texts([h or "" for h in batch.column("html").to_pylist()], trees, price)
            yield pa.RecordBatch.from_arrays(
                [batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                ["page_id", "url", "text", "n_chars"]
            )

    return run


def extract(pages: DataFrame, price: float = PRICE, train_pages: int = PAGES) -> DataFrame:
    """Per row of `pages` (page_id, url, html): page_id, url, text, n_chars."""
    shared = pages.sparkSession.sparkContext.broadcast(shared_trees(pages.sparkSession, train_pages))
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), "html")
    return rows.transform(store.arrow, _extracted(shared, price), "page_id long, url string, text string, n_chars long")
