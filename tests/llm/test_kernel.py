import random
import re

import numpy as np
import pyarrow as pa

from episodica.llm import kernel as K

PATTERNS = ((K.NOT_SPACE, r"[^\x20\x09-\x0D]+"), (K.ALNUM, r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"))


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text)


def test_words_are_the_pattern_s(monkeypatch):
    rng = random.Random(1)
    for segment in (16, 64, 1 << 19):
        monkeypatch.setattr(K, "SEGMENT", segment)
        for _ in range(60):
            rows = ["".join(rng.choice("abAZ09 \t\n\x0b.,-é漢\x1f_") for _ in range(rng.randrange(50))) for _ in range(rng.randrange(1, 8))]
            data, offsets = K.column_bytes(pa.array(rows))
            for table, pattern in PATTERNS:
                s, e, h = K.words(data, table, offsets)
                bounds = K.rows_of(s, offsets)
                got = [[K.LOWER[data[a:b]].tobytes().decode() for a, b in zip(s[x:y], e[x:y], strict=True)] for x, y in zip(bounds[:-1], bounds[1:], strict=True)]
                want = [re.findall(pattern, lower(t)) for t in rows]
                assert got == want
                flat = [w for r in want for w in r]
                assert len(set(zip(flat, h.tolist(), strict=True))) == len(set(flat)) == len(set(h.tolist()))


def test_windows_stay_in_rows():
    data, offsets = K.column_bytes(pa.array(["a b c d", "", None, "b c", "a b c d e"]))
    s, _, h = K.words(data, K.NOT_SPACE, offsets)
    at, found = K.windows_in_rows(h, K.rows_of(s, offsets), 3)
    assert at.tolist() == [0, 1, 6, 7, 8] and found[0] == found[2] and found[1] == found[3]
    assert K.windows(h, 99).size == 0


def test_slices_and_sliced_columns():
    column = pa.array(["xx", None, "yyy", "z" * 50, "w"]).slice(1)
    data, offsets = K.column_bytes(column)
    assert data.tobytes() == b"yyy" + b"z" * 50 + b"w" and offsets.tolist() == [0, 0, 3, 53, 54]
    assert list(K.slices(offsets, 10)) == [(0, 2), (2, 3), (3, 4)]
    assert K.column_bytes(pa.array([], pa.string()))[1].tolist() == [0]
    assert np.unique(K.mix(np.arange(1000, dtype=np.uint64))).size == 1000
