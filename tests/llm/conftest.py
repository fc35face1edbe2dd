import random

import pytest

#: Columns whose names the operators might use themselves.
EXTRA = "n long, key string, size string, id string, z binary, part int, family string, count long, score string, held_out string, row string, rank double"


@pytest.fixture(scope="session")
def llm(spark):
    from episodica.llm.store import bounded_batches

    return bounded_batches(spark)


def words(rng, n, size=400):
    return " ".join(f"{rng.choice('bcdfg')}{rng.randrange(size)}{rng.choice(['', '', ',', '.'])}" for _ in range(n))


@pytest.fixture(scope="session")
def edges(llm):
    """Documents with nulls in every column, empty, short, very long, equal and repeated texts, and clashing columns."""
    rng = random.Random(4)
    long = words(rng, 60_000, 20_000)
    base = words(rng, 120)
    rows = [
        (0, None, "en", "a"), (1, "", "en", "a"), (2, " \t\n", None, None), (3, "one", "de", "b"), (4, "one", "de", "b"), (5, "one two three", "de", None),
        (6, base, "en", "a"), (7, base, None, "b"), (8, base.replace("b", "B"), "en", "c"), (9, base + " tail", "en", "c"), (10, long, "en", "a"),
        (11, long[: len(long) // 2], "en", "a"), (12, "ä ö ß \U0001f600 İx", "de", "ü"), (13, "...!!! 123 --", "en", "z"), (None, base, "en", "a"), (None, None, None, None),
        (14, words(rng, 300), "fr", "a"), (14, words(rng, 300), "fr", "a"), (15, "same row here with five words", "en", "b"), (15, "same row here with five words", "en", "b"),
    ]
    df = llm.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    for c in EXTRA.split(", "):
        name, kind = c.split()
        df = df.selectExpr("*", f"cast('1' as {kind}) as `{name}`")
    return df.repartition(3)


@pytest.fixture(scope="session")
def empty(edges):
    return edges.where("false")


@pytest.fixture(scope="session")
def docs(llm):
    """A small table of the driver's documents, whole."""
    return llm.read.parquet("/root/testdata/sf0.001/documents.parquet")
