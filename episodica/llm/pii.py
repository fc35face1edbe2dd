"""Personal data behind disguises: transducers that keep offsets, identifiers found in what they write, spans in the source.

A transducer reads a text and writes another one as edits (a range of what it reads, and what stands there instead), so
each place of its output has a place in its input, and a chain of them maps a span back to the source's characters.
In a fixed order:

1. `homoglyphs`: characters that look like ASCII (wide, mathematical, circled forms by their compatibility mapping; digits
   of any script by their value; letters of other scripts by LOOKALIKES), white space of other kinds, and characters
   without width, which go.  A letter of LOOKALIKES is only read as Latin within a word that
   has ASCII letters or digits, an @ or a dot in it.
2. `entities`: `&#64;`, `&#x40;`, `%40`, `&commat;`, `&period;` and so on.
3. `brackets`: an at or dot word or sign in brackets (or between _ or -), with the space around it.
4. `numerals`: spelled digits in a run of at least RUN digits, WORDS of them spelled ("double" and "triple" count), "plus"
   before it, "dot" or "point" between digits, and the letters O, l, I that stand in a number.
5. `addresses`: at and dot as plain words, and spaces around signs, only where the whole is an address: a local part, at,
   labels and dots, and a last label out of SUFFIXES (so that "look at the dot in the middle" is none).

The same four patterns then run over the source and over what the chain wrote.  Spans of the source stay; of the others
those are added that no span of the source of their kind covers.

Null: as the empty text, which has no spans.  Very long texts are read whole, in time proportional to their length (no
pattern starts again within a run it has read).  Each row is judged by itself, so repeated rows and ids have equal results;
null ids pass.  An empty table stays empty.  Extra columns pass through `annotate`, whatever their names.
"""

from __future__ import annotations

import re
import unicodedata
from bisect import bisect_right
from collections.abc import Callable, Iterator
from functools import cache, lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import store

KINDS = ("email", "ip", "card", "phone")
#: Digits of a run, and digit words in it (one less after a spelled plus), below which spelled digits are left as words.
RUN, WORDS = 4, 3
# Characters of other scripts that look like ASCII ones.
LOOKALIKES = {
    "а": "a", "в": "b", "с": "c", "ԁ": "d", "е": "e", "һ": "h", "і": "i", "ј": "j", "к": "k", "ӏ": "l", "м": "m", "н": "h", "о": "o", "р": "p",
    "ԛ": "q", "г": "r", "ѕ": "s", "т": "t", "у": "y", "ѵ": "v", "ԝ": "w", "х": "x", "ё": "e", "ї": "i", "А": "A", "В": "B", "С": "C", "Е": "E",
    "Н": "H", "І": "I", "Ј": "J", "К": "K", "М": "M", "О": "O", "Р": "P", "Ѕ": "S", "Т": "T", "У": "Y", "Х": "X", "Ԛ": "Q", "Ԝ": "W", "Ѵ": "V",
    "α": "a", "ε": "e", "ι": "i", "κ": "k", "ν": "v", "ο": "o", "ρ": "p", "τ": "t", "υ": "u", "χ": "x", "γ": "y", "ϲ": "c", "ϳ": "j", "Α": "A",
    "Β": "B", "Ε": "E", "Ζ": "Z", "Η": "H", "Ι": "I", "Κ": "K", "Μ": "M", "Ν": "N", "Ο": "O", "Ρ": "P", "Τ": "T", "Υ": "Y", "Χ": "X", "օ": "o",
    "ո": "n", "ս": "u", "հ": "h", "ց": "g", "զ": "q", "ı": "i", "ɑ": "a", "ɡ": "g", "ɩ": "i", "ʟ": "L", "ᴏ": "o", "ⲟ": "o", "ꓳ": "O",
}
# Signs of other forms.
SIGNS = {
    "‐": "-", "‑": "-", "‒": "-", "–": "-", "—": "-", "―": "-", "−": "-", "·": ".", "•": ".", "∙": ".", "⋅": ".",
    "。": ".", "・": ".", "۔": ".", "։": ":", "➕": "+",
}
#: Characters without width that aren't format controls (those go by their category).
NO_WIDTH = "\u034f\u115f\u1160\u17b4\u17b5\ufe0e\ufe0f"
# Digits as words in four languages, and words around them.
DIGITS = {
    "zero": "0", "oh": "0", "one": "1", "two": "2", "three": "3", "four": "4", "five": "5", "six": "6", "seven": "7", "eight": "8", "nine": "9",
    "null": "0", "eins": "1", "zwei": "2", "zwo": "2", "drei": "3", "vier": "4", "fünf": "5", "sechs": "6", "sieben": "7", "acht": "8", "neun": "9",
    "zéro": "0", "un": "1", "deux": "2", "trois": "3", "quatre": "4", "cinq": "5", "sept": "7", "huit": "8", "neuf": "9",
    "cero": "0", "uno": "1", "dos": "2", "tres": "3", "cuatro": "4", "cinco": "5", "seis": "6", "siete": "7", "ocho": "8", "nueve": "9",
}
TIMES = {"double": 2, "triple": 3}
PLUS = ("plus", "más")
AT = ("at", "arroba", "arobase")
DOT = ("dot", "punkt", "point", "punto", "period")
# Last labels of an address written in plain words; none of them is a common word.
SUFFIXES = (
    "com org net edu gov mil int info biz name pro mobi app dev cloud online site store shop tech blog xyz io ai co uk de fr es eu ch nl se dk fi pl cz hu ro gr ie "
    "pt ru ua tr il ae sg hk jp kr cn tw au nz ca mx br ar cl za ke ng example test invalid local localhost"
).split()

Edit = tuple[int, int, str]


class Written:
    """A text that edits made of another one, and where its places come from."""

    def __init__(self, text: str, edits: list[Edit]) -> None:
        """Edits: ranges in order that don't overlap, and what stands there instead."""
        parts, self.starts, self.edits, at, out = [], [], [], 0, 0
        for a, b, new in edits:
            parts += [text[at:a], new]
            out += a - at
            self.starts.append(out)
            self.edits.append((out, out + len(new), a, b))
            out += len(new)
            at = b
        self.text = "".join([*parts, text[at:]])

    def source(self, start: int, end: int) -> tuple[int, int]:
        """The range of the input that the output's range [start, end) comes from; an edit counts whole, an edit that writes
        nothing at a border not at all."""
        return self._place(start, False), self._place(end, True)

    def _place(self, p: int, end: bool) -> int:
        """As a start, p is the place of the character from it; as an end, of the one before it."""
        k = bisect_right(self.starts, p - end) - 1
        if k < 0:
            return p
        first, last, a, b = self.edits[k]
        if p - end < last:  # within what the edit wrote
            return b if end else a
        return b + (p - last)


def chained(chain: list[Written], start: int, end: int) -> tuple[int, int]:
    for w in reversed(chain):
        start, end = w.source(start, end)
    return start, end


# --- what identifiers look like -------------------------------------------------------------------------------------

_DOMAIN = re.compile(r"@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
_LOCAL = re.compile(r"[^A-Za-z0-9._%+-]")
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_DOTTED = re.compile(r"\.[0-9]")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_LONG_RUN = 512


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """An @ with labels behind it, and as far before it as the local part goes, back to the last address."""
    last = 0
    for m in _DOMAIN.finditer(text):
        at = start = m.start()
        while start > last:  # in strides, as local parts can be long
            a = max(last, start - _LONG_RUN)
            stops = [x.end() for x in _LOCAL.finditer(text, a, start)]
            if stops:
                start = a = stops[-1]
                break
            start = a
        if start < at:
            yield start, m.end()
            last = m.end()


def _luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = int(c) * (1 + k % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def _small(part: str) -> bool:
    part = part.lstrip("0") or "0"
    return len(part) <= 3 and int(part) <= 255


def _digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def identifiers(text: str) -> list[tuple[int, int, int]]:
    """(start, kind number, end) of each identifier, by kind leftmost and not overlapping; a match that fails its check isn't tried again."""
    found = []
    if "@" in text:
        found += [(a, 0, b) for a, b in _emails(text)]
    if _DOTTED.search(text):
        found += [(m.start(), 1, m.end()) for m in _IP.finditer(text) if all(_small(p) for p in m[0].split("."))]
    found += [(m.start(), 2, m.end()) for m in _CARD.finditer(text) if m.end() - m.start() >= 14 and 14 <= len(d := _digits(m[0])) <= 19 and _luhn(d)]
    if "+" in text:
        found += [(m.start(), 3, m.end()) for m in _PHONE.finditer(text) if 10 <= len(_digits(m[0])) <= 15]
    return sorted(found)


# --- transducers ----------------------------------------------------------------------------------------------------


@cache
def _plain() -> dict[str, str]:
    """Characters outside ASCII that are read as ASCII ones wherever they stand, by rule: compatibility forms, digits, spaces, signs."""
    out = {}
    for k in range(0x80, 0x20000):
        if 0xD800 <= k < 0xE000 or 0x3400 <= k < 0xA000 or 0xAC00 <= k < 0xD7A4:
            continue
        c = chr(k)
        kind = unicodedata.decomposition(c).partition(" ")[0]
        plain = unicodedata.normalize("NFKC", c) if kind in ("<wide>", "<narrow>", "<font>", "<small>", "<circle>", "<square>", "<noBreak>") or k == 0x2024 else ""
        if unicodedata.category(c) == "Nd":
            out[c] = str(unicodedata.decimal(c))
        elif unicodedata.category(c) == "Zs":
            out[c] = " "
        elif unicodedata.category(c) == "Cf":
            out[c] = ""
        elif plain and plain.isascii():
            out[c] = plain
    return out | SIGNS | dict.fromkeys(NO_WIDTH, "")


_ASCII = re.compile(r"[A-Za-z0-9@.]")


@lru_cache(256)
def _class(characters: frozenset[str]) -> re.Pattern:
    return re.compile("[" + "".join(re.escape(c) for c in sorted(characters)) + "]")


def homoglyphs(text: str) -> list[Edit]:
    if text.isascii():
        return []
    table, there, edits = _plain(), set(text), []
    if some := frozenset(there & table.keys()):
        edits = [(m.start(), m.end(), table[m[0]]) for m in _class(some).finditer(text)]
    if some := frozenset(there & LOOKALIKES.keys()):
        pattern = _class(some)
        for word in re.finditer(r"\S+", text):
            found = list(pattern.finditer(text, word.start(), word.end()))
            if found and _ASCII.search(text, word.start(), word.end()):
                edits += [(m.start(), m.end(), LOOKALIKES[m[0]]) for m in found]
        edits.sort()
    return edits


_ENTITY = re.compile(r"&#0*(?:64|46|43|45);|&#[xX]0*(?:40|2[eE]|2[bB]|2[dD]);|&(?:commat|period|plus|hyphen);|(?<=[A-Za-z0-9])%(?:40|2[eE])(?=[A-Za-z0-9])", re.ASCII)
_NAMED = {"commat": "@", "period": ".", "plus": "+", "hyphen": "-"}


def entities(text: str) -> list[Edit]:
    out = []
    if "&" in text or "%" in text:
        for m in _ENTITY.finditer(text):
            body = m[0].strip("&;")
            if body[0] == "%":
                new = chr(int(body[1:], 16))
            elif body[0] != "#":
                new = _NAMED[body]
            else:
                new = chr(int(body[2:], 16) if body[1] in "xX" else int(body[1:]))
            out.append((m.start(), m.end(), new))
    return out


_AT, _DOT = "|".join(AT), "|".join(DOT)
_BRACKETS = re.compile(rf"[\[({{<*_-] ?(?:(?P<at>{_AT}|@|a)|(?P<dot>{_DOT}|\.)) ?[\])}}>*_-]", re.IGNORECASE)
_CLOSES = {"[": "]", "(": ")", "{": "}", "<": ">", "*": "*", "_": "_", "-": "-"}
_LATER = re.compile(rf"[A-Za-z0-9]{{1,63}}(?:-(?i:{_DOT})-|_(?i:{_DOT})_)")
_LATIN = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789")
_BLANKS = 3


def brackets(text: str) -> list[Edit]:
    """[at], (dot), {@}, <.>, (a), *at*; _at_ and -at- only where a -dot- follows."""
    out: list[Edit] = []
    for m in _BRACKETS.finditer(text):
        mark, a, b = m[0], m.start(), m.end()
        if _CLOSES[mark[0]] != mark[-1] or mark[1:-1] in ("a", "A") and mark[0] not in "[(":
            continue
        if mark[0] in "_-":
            if mark[1:-1].strip() in ("@", "a", "A", ".") or " " in mark:
                continue
            if not (_LATER.match(text, b) if m["at"] else out and a - out[-1][1] <= 63 and " " not in text[out[-1][1] : a]):
                continue
        while m.start() - a < _BLANKS and text[a - 1 : a] in (" ", "\t"):
            a -= 1
        while b - m.end() < _BLANKS and text[b : b + 1] in (" ", "\t"):
            b += 1
        if text[a - 1 : a] in _LATIN and text[b : b + 1] in _LATIN and (not out or out[-1][1] < a):
            out.append((a, b, "." if m["dot"] else "@"))
    return out


_ONE = "|".join(sorted(map(re.escape, DIGITS), key=len, reverse=True))
_MANY = "|".join(TIMES)
_POINT = "|".join(DOT)
_ITEM = rf"(?:(?:{_MANY})[ -])?(?:{_ONE})|[0-9]+"
_RUNS = re.compile(
    rf"(?<![\w@.])(?:(?:{'|'.join(PLUS)})[ -]?|\+[ ]?)?(?:{_ITEM})(?:(?:[ ]?[,.-][ ]?|[ ]{{1,2}}|[ ]?[()][ ]?|[ ](?:{_POINT}|dash|hyphen)[ ])(?:{_ITEM}))+(?![\w@])", re.IGNORECASE
)
_SPELLED = re.compile(rf"\b(?:{_ONE})\b", re.IGNORECASE)
_PIECE = re.compile(
    rf"(?:(?P<many>{_MANY})[ -])?\b(?P<one>{_ONE})\b|(?P<plus>(?:{'|'.join(PLUS)})[ -]?|\+[ ]?)|(?P<point>[ ](?:{_POINT})[ ])|(?P<dash>[ ](?:dash|hyphen)[ ])|(?P<digits>[0-9]+)|(?P<gap>.)",
    re.IGNORECASE | re.DOTALL
)
_FALSE_DIGITS = re.compile(r"(?<![\w@])[0-9OolI]*[0-9][OolI][0-9OolI]*(?![\w@])|(?<![\w@])[OolI]+[0-9]{2}[0-9OolI]*(?![\w@])")
_LIKE_DIGITS = {"O": "0", "o": "0", "l": "1", "I": "1"}


_MIXED = re.compile(r"[0-9][OolI]|[OolI][0-9]{2}")
_BREAKS = (",", ".", "-", "(", ")", '"', "'", ":", ";", "[", "]", "\u201c", "\u201d")


def _spelled(text: str) -> bool:
    """Whether there are as many digit words as a run needs."""
    text = text.lower()
    for c in _BREAKS:
        text = text.replace(c, " ")
    return sum(map(DIGITS.__contains__, text.split())) >= WORDS - 1


def numerals(text: str) -> list[Edit]:
    out: list[Edit] = []
    for m in _RUNS.finditer(text) if _spelled(text) else ():
        if len(_SPELLED.findall(m[0])) < WORDS - m[0][:1].isalpha() * m[0].lower().startswith(PLUS):
            continue  # "+1 848 555 1373 un"
        pieces = list(_PIECE.finditer(text, m.start(), m.end()))
        count = sum(TIMES.get((p["many"] or "").lower(), 1) if p["one"] else len(p["digits"] or "") for p in pieces)
        if count < RUN:
            continue
        # what stands between two digits goes, where one of them was spelled; points and dashes stay as signs
        spelled = [bool(p["one"]) for p in pieces]
        for k, p in enumerate(pieces):
            new = None
            if p["one"]:
                new = DIGITS[p["one"].lower()] * TIMES.get((p["many"] or "").lower(), 1)
            elif p["plus"] and k == 0:
                new = "+"
            elif p["point"]:
                new = "."
            elif p["dash"]:
                new = "-"
            elif p["gap"] in (" ", ",", "-") and (spelled[k - 1] or spelled[k + 1 : k + 2] == [True] or (p["gap"] != "-" and pieces[k - 1]["gap"] == ",")):
                new = ""
            if new is not None:
                out.append((p.start(), p.end(), new))
    taken = iter([*out, (len(text) + 1, len(text) + 1, "")])
    a, b, _ = next(taken)
    more = []
    for m in _FALSE_DIGITS.finditer(text) if _MIXED.search(text) else ():
        while b <= m.start():
            a, b, _ = next(taken)
        if a < m.end() or 2 * sum(c in _LIKE_DIGITS for c in m[0]) > len(m[0]):
            continue
        more += [(m.start() + k, m.start() + k + 1, _LIKE_DIGITS[c]) for k, c in enumerate(m[0]) if c in _LIKE_DIGITS]
    return sorted(out + more)


_PLAIN_AT = r"at|AT|At|arroba|ARROBA|arobase|AROBASE"
_PLAIN_DOT = r"dot|DOT|Dot|punkt|PUNKT|Punkt|point|POINT|punto|PUNTO"
_HINT = re.compile(rf"(?<=[A-Za-z0-9_%+-])(?:[ ]{{0,3}}@[ ]{{0,3}}|[ ]{{1,3}}(?:{_PLAIN_AT})[ ]{{1,3}})(?=[A-Za-z0-9])")
_HINTS = ("@", *(f" {w} " for w in _PLAIN_AT.split("|")))
_LABEL = r"[A-Za-z0-9][A-Za-z0-9-]{0,62}"
_LABELS = re.compile(rf"{_LABEL}(?:(?:[ ]{{1,3}}(?:{_PLAIN_DOT})[ ]{{1,3}}|[ ]{{0,3}}\.[ ]{{0,3}}){_LABEL}){{1,6}}")
_BEFORE = re.compile(rf"(?<![A-Za-z0-9._%+@-])[A-Za-z0-9%+_-]{{1,64}}(?:(?:\.|[ ](?:{_PLAIN_DOT})[ ])[A-Za-z0-9%+_-]{{1,64}}){{0,4}}\Z")
_SEPARATOR = re.compile(rf"[ ]{{1,3}}(?:{_PLAIN_DOT})[ ]{{1,3}}|[ ]{{0,3}}\.[ ]{{0,3}}")
#: A local part that no word of a sentence looks like.
_NAME = re.compile(r"[A-Za-z][0-9]*[._][A-Za-z0-9]|[A-Za-z]{2,}[0-9]{2,}$")
_SUFFIXES = frozenset(SUFFIXES)
#: Characters of a local part in plain words, at most.
_REACH = 400


def addresses(text: str) -> list[Edit]:
    """Addresses in plain words.  The domain ends with its last label that is a known suffix."""
    out: list[Edit] = []
    last = 0
    for hint in _HINT.finditer(text) if any(w in text for w in _HINTS) else ():
        labels = _LABELS.match(text, hint.end()) if hint.start() >= last else None
        if labels is None:
            continue
        seps = list(_SEPARATOR.finditer(text, labels.start(), labels.end()))
        ends = [s.start() for s in seps[1:]] + [labels.end()]
        known = [k for k, (s, e) in enumerate(zip(seps, ends, strict=True)) if text[s.end() : e].lower() in _SUFFIXES]
        if not known:
            continue
        seps, end = seps[: known[-1] + 1], ends[known[-1]]
        first = max(last, hint.start() - _REACH)
        before = _BEFORE.search(text[first : hint.start()])
        if before is None:
            continue
        local, spoken, words = before[0], "@" not in hint[0], any(s[0].strip() != "." for s in seps)
        if not spoken and hint[0] == "@" and all(s[0] == "." for s in seps) and " " not in local:
            continue  # an address as it stands
        if not words and (not _NAME.search(local) if spoken else any(s[0].endswith(" ") and text[s.end()].isupper() for s in seps)):
            continue  # "meet us at example.com", or an address and the next sentence
        out += [(first + before.start() + s.start(), first + before.start() + s.end(), ".") for s in _SEPARATOR.finditer(local) if s[0] != "."]
        out.append((hint.start(), hint.end(), "@"))
        out += [(s.start(), s.end(), ".") for s in seps if s[0] != "."]
        last = end
    return out


TRANSDUCERS: tuple[Callable[[str], list[Edit]], ...] = (homoglyphs, entities, brackets, numerals, addresses)


def normalised(text: str) -> tuple[str, list[Written]]:
    """What the chain writes of a text, and the chain."""
    chain = []
    for t in TRANSDUCERS:
        if edits := t(text):
            chain.append(Written(text, edits))
            text = chain[-1].text
    return text, chain


def spans(text: str) -> tuple[list[tuple[int, int, int]], list[tuple[int, int, int]]]:
    """(start, kind number, end) of the identifiers of the source, and of all."""
    base = identifiers(text)
    plain, chain = normalised(text)
    if not chain:
        return base, base
    found = set(base)
    for start, kind, end in identifiers(plain):
        a, b = chained(chain, start, end)
        if not any(k == kind and x <= a and b <= y for x, k, y in base):
            found.add((a, kind, b))
    return base, sorted(found)


# --- tables ---------------------------------------------------------------------------------------------------------

_SPAN = T.ArrayType(T.StructType([T.StructField("kind", T.StringType()), T.StructField("start", T.LongType()), T.StructField("end", T.LongType()), T.StructField("disguised", T.BooleanType())]))


def _struct(base: list[tuple[int, int, int]], all_: list[tuple[int, int, int]]) -> list[dict]:
    plain = set(base)
    return [{"kind": KINDS[k], "start": a, "end": b, "disguised": (a, k, b) not in plain} for a, k, b in all_]


def annotate(docs: DataFrame) -> tuple[DataFrame, str]:
    """`docs` (with a text column) and one more column, whose name is returned too: the identifiers' spans."""
    name = store.unused(docs.columns, "__spans")[0]
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("disguised", pa.bool_())]))

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in store.batches(it):
            rows = [_struct(*spans(t or "")) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(rows, kind)], [*batch.schema.names, name])

    return docs.transform(store.arrow, run, T.StructType([*docs.schema.fields, T.StructField(name, _SPAN)])), name


def redact(docs: DataFrame, mark: str = "[{kind}]") -> DataFrame:
    """`docs` with each identifier's characters replaced; overlapping spans are one, under the first one's kind."""
    marked, name = annotate(docs)
    columns = docs.columns

    def cut(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in it:
            out = []
            for text, found in zip(batch.column("text").to_pylist(), batch.column(name).to_pylist(), strict=True):
                parts, at = [], 0
                for s in found:
                    if s["start"] >= at:
                        parts += [text[at : s["start"]], mark.format(kind=s["kind"].upper())]
                    at = max(at, s["end"])
                out.append(text if not found else "".join([*parts, text[at:]]))
            k = batch.schema.get_field_index("text")
            yield batch.set_column(k, "text", pa.array(out, pa.string())).select(columns)

    return marked.transform(store.arrow, cut, docs.schema)


def report(docs: DataFrame) -> DataFrame:
    """Per row: doc_id, the source's identifiers by kind, the digest of their spans, and all spans."""
    marked, name = annotate(store.texts(docs))
    shown = lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])
    base = F.filter(name, lambda s: ~s["disguised"])
    number = lambda k: F.size(F.filter(name, lambda s: (s["kind"] == k) & ~s["disguised"])).cast("long").alias(f"n_{k}")
    return marked.select(
        "doc_id", *(number(k) for k in KINDS), F.sha2(F.array_join(F.transform(base, shown), ",").cast("binary"), 256).alias("base_sha256"),
        F.array_join(F.transform(F.col(name), shown), ",").alias("spans"),
    )
