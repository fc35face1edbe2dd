"""A forgiving HTML reader: block-level nodes with their text blocks, as flat arrays in page order.

Raw-text elements without an end tag run to the end of the page, as in HTML.  Other elements that show no text (see MUTE)
are read like any element and end by their end tag, by an implied one or with their parent; they make no nodes."""

from __future__ import annotations

import html
import re

#: Fixed lists: elements by how they nest and show.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title iframe noembed noframes xmp".split())
MUTE = frozenset("noscript template select option svg canvas annotation annotation-xml".split())
TAGS = tuple(
    "html body div p article main section nav header footer aside form ul ol li table tr td h1 h2 h3 h4 h5 h6 blockquote pre figure figcaption dl dt dd address details dialog".split()
)
#: Elements that begin a block of text; all others, unknown ones too, stand in a line.
BLOCK = frozenset(TAGS) | frozenset("head th thead tbody tfoot caption colgroup fieldset legend summary hgroup menu dir center search listing plaintext frameset".split())
#: Attribute tokens that hint at a part of a page, by group.
HINTS = {
    "menu": "nav navbar navigation menu breadcrumb breadcrumbs pagination pager tabs toolbar skip toc",
    "head": "header masthead topbar banner branding logo hero",
    "foot": "footer copyright legal imprint colophon bottom",
    "side": "sidebar aside side rail widget widgets related recommended popular trending tags archive",
    "notice": "cookie cookies consent notice alert gdpr popup modal overlay toast newsletter subscribe signup subscription paywall",
    "advert": "ad ads adv advert advertisement sponsor sponsored promo promotion banner outbrain taboola affiliate",
    "form": "form search login contact input field captcha",
    "comment": "comment comments reply replies respond discussion disqus thread reviews",
    "share": "share sharing social follow like tweet",
    "meta": "meta byline author date timestamp info byl caption credit",
    "content": "content article main post entry story body text articlebody maincontent prose page blog news",
}
#: The last group are elements that a page doesn't show.
GROUPS = (*HINTS, "hidden")
_GROUP = {w: k for k, words in enumerate(HINTS.values()) for w in words.split()}
_TAG = {t: k for k, t in enumerate(TAGS)}
#: A start tag of these ends an open one (of the second list) first, up to the given stops.
_CLOSES = {
    "li": ("li",),
    "dt": ("dt", "dd"),
    "dd": ("dt", "dd"),
    "tr": ("tr", "td", "th"),
    "td": ("td", "th"),
    "th": ("td", "th"),
    "tbody": ("thead", "tbody", "tr", "td", "th"),
    "thead": ("caption",),
    "tfoot": ("tbody", "tr", "td", "th")
}
_STOP = {
    "li": ("ul", "ol", "menu"), "dt": ("dl",), "dd": ("dl",), "tr": ("table",), "td": ("table", "tr"), "th": ("table", "tr"), "tbody": ("table",), "thead": ("table",),
    "tfoot": ("table",)
}
#: Start tags that end an open select; those that end an open svg, unless inside these of its elements.
_NOT_IN_SELECT = frozenset("select input keygen textarea caption table tbody thead tfoot tr td th".split())
_NOT_IN_SVG = frozenset(
    "b big blockquote body br center code dd div dl dt em embed h1 h2 h3 h4 h5 h6 head hr i img li listing menu meta nobr ol p pre ruby s small span strong strike sub sup table tt u ul var".split()
)
_IN_SVG = frozenset("foreignobject desc".split())


def _in_line(name: str) -> bool:
    return not (name in BLOCK or name in VOID or name in RAW or name in MUTE)


_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>|<(/?)([a-zA-Z][^\s/>]*)([^>]*)(?:>|\Z)", re.S)
_ATTRIBUTE = re.compile(r"(?<![\w-])(class|id|role|itemprop|aria-label|aria-hidden|hidden|style)\b\s*(?:=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'>]+))?", re.I)
_UNSEEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)
_PART = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
_ENDS: dict[str, re.Pattern] = {}
SPACE = re.compile(r"\s+")


class Page:
    """Nodes in page order.  node k: parent, tag, hints (bit mask of GROUPS), end (its subtree is k..end-1), links;
    blocks: (node, text, characters inside links)."""

    def __init__(self, source: str) -> None:
        self.parent, self.tag, self.hints, self.end, self.links = [-1], [-1], [0], [0], [0]
        self.blocks: list[tuple[int, str, int]] = []
        self._text: list[str] = []
        self._linked = self._in_link = 0
        self._mute = 0  # where on the stack the outermost open element without text is; 0: none
        self._inline: dict[str, int] = {}  # open inline elements outside of it
        self._inside: dict[str, int] = {}  # open elements inside, itself too
        stack: list[tuple[str, int]] = [("", 0)]
        at, n = 0, len(source)
        while at < n:
            m = _TOKEN.search(source, at)
            if m is None:
                self._add(source[at:])
                break
            if m.start() > at:
                self._add(source[at : m.start()])
            at = m.end()
            name = m[2] or m[5]
            if name is None:
                continue
            name, closing, attributes = name.lower(), m[1] or m[4], m[3] or m[6] or ""
            if closing:
                self._close(stack, name)
                continue
            if self._mute:
                self._implied(stack, name)
            if name in RAW:
                if name not in _ENDS:
                    _ENDS[name] = re.compile(rf"</{name}\b[^>]*(?:>|\Z)", re.I)
                if not attributes.endswith("/"):
                    e = _ENDS[name].search(source, at)
                    at = e.end() if e else n
                continue
            if self._mute or name in MUTE:
                if name not in VOID and not attributes.endswith("/"):
                    self._mute = self._mute or len(stack)
                    stack.append((name, stack[-1][1]))
                    self._inside[name] = self._inside.get(name, 0) + 1
                continue
            if _in_line(name) and not attributes.endswith("/"):
                self._inline[name] = self._inline.get(name, 0) + 1
            if name == "br":
                self._text.append(" ")
            elif name == "a":
                self._in_link = 1
                self.links[stack[-1][1]] += 1
            elif name not in BLOCK:
                if name == "hr":
                    self._flush(stack)
            else:
                self._open(stack, name, attributes)
        self._flush(stack)
        while len(stack) > 1:
            self._pop(stack)
        self.end[0] = len(self.parent)

    def _add(self, text: str) -> None:
        if text and not self._mute:
            if "&" in text:  # a character reference ends where its run of text does
                text = html.unescape(text)
            self._text.append(text)
            if self._in_link:
                self._linked += len(text.strip())

    def _flush(self, stack: list[tuple[str, int]]) -> None:
        if self._text:
            text = SPACE.sub(" ", "".join(self._text)).strip()
            if text:
                self.blocks.append((stack[-1][1], text, self._linked))
            self._text, self._linked = [], 0

    def _pop(self, stack: list[tuple[str, int]]) -> None:
        self._flush(stack)
        self.end[stack.pop()[1]] = len(self.parent)

    def _cut(self, stack: list[tuple[str, int]], k: int) -> None:
        """Ends elements from the k-th on, all of them in one without text."""
        for name, _ in stack[k:]:
            self._inside[name] -= 1
        del stack[k:]
        if k <= self._mute:
            self._mute = 0

    def _implied(self, stack: list[tuple[str, int]], name: str) -> None:
        """What a start tag ends of an open element without text."""
        if name in ("option", "optgroup"):
            while self._mute and (stack[-1][0] == "option" or stack[-1][0] == name):
                self._cut(stack, len(stack) - 1)
            return
        has = self._inside.get
        if name in _NOT_IN_SELECT and has("select"):
            self._cut(stack, next(k for k in range(self._mute, len(stack)) if stack[k][0] == "select"))
        elif name in _NOT_IN_SVG and has("svg") and not any(has(t) for t in _IN_SVG):
            self._cut(stack, next(k for k in range(self._mute, len(stack)) if stack[k][0] == "svg"))
        if 0 < self._mute < len(stack) - 1 and stack[-1][0] == "p" and name in BLOCK:
            self._cut(stack, len(stack) - 1)
        if self._mute and name in _CLOSES and not has("template"):
            for k in range(len(stack) - 1, 0, -1):
                if stack[k][0] in _STOP.get(name, ()):
                    break
                if stack[k][0] in _CLOSES[name]:
                    self._cut(stack, max(k, self._mute))
                    break

    def _close(self, stack: list[tuple[str, int]], name: str) -> None:
        if self._mute:
            if self._inside.get(name):
                self._cut(stack, next(k for k in range(len(stack) - 1, 0, -1) if stack[k][0] == name))
                return
            if not (self._inline.get(name) if _in_line(name) else any(t == name for t, _ in stack)):
                return
            self._cut(stack, self._mute)  # its parent ends
        if self._inline.get(name):
            self._inline[name] -= 1
        if name == "a":
            self._in_link = 0
        elif name in BLOCK:
            for k in range(len(stack) - 1, 0, -1):
                if stack[k][0] == name:
                    while len(stack) > k:
                        self._pop(stack)
                    break
            else:
                self._flush(stack)

    def _open(self, stack: list[tuple[str, int]], name: str, attributes: str) -> None:
        self._flush(stack)
        self._in_link = 0
        if stack[-1][0] == "p" or any(t == "p" for t, _ in stack[-3:]):
            while any(t == "p" for t, _ in stack[-3:]):
                self._pop(stack)
        for k in range(len(stack) - 1, 0, -1):
            if stack[k][0] in _STOP.get(name, ()) or name not in _CLOSES:
                break
            if stack[k][0] in _CLOSES[name]:
                while len(stack) > k:
                    self._pop(stack)
        hints = 0
        if attributes and not attributes.isspace():
            for a in _ATTRIBUTE.finditer(attributes):
                what, said = a[1].lower(), a[2] or ""
                if what == "hidden" or what == "aria-hidden" and "true" in said.lower() or what == "style" and _UNSEEN.search(said):
                    hints |= 1 << len(HINTS)
                if what in ("hidden", "aria-hidden", "style"):
                    continue
                for w in _PART.findall(said):
                    if (g := _GROUP.get(w.lower())) is not None:
                        hints |= 1 << g
        self.parent.append(stack[-1][1])
        self.tag.append(_TAG.get(name, len(TAGS)))
        self.hints.append(hints)
        self.links.append(0)
        self.end.append(0)
        stack.append((name, len(self.parent) - 1))
