import random

import pytest
from pyspark.sql import functions as F

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
# Names that the operators use inside themselves.
CLASHING = [
    "_row", "_id", "_slot", "_map", "_key", "_epoch", "_source", "_left", "h1", "h2", "cls", "no",
    "line", "doc", "at", "rank", "bands", "unit", "score", "kept", "dropped", "held_out", "n",
]


def words(seed, n):
    rnd = random.Random(seed)
    return [
        "".join(rnd.choice(["the", "on", "ing", "er", "an", "st", "re", "é", "ti"]) for _ in range(rnd.randint(1, 3)))
        for _ in range(n)
    ]


def awkward_rows():
    """Nulls, empty and long texts, copies, near copies, ties, and repeated rows."""
    base = words(1, 120)
    near = list(base)
    near[60] = "changed"
    rows = [
        (0, " ".join(base), "en", "a"),
        (1, " ".join(near), "en", "a"),
        (2, " ".join(base), "en", "b"),
        (3, None, None, None),
        (4, "", "en", "a"),
        (5, " \t\n \n\r", "en", "a"),
        (6, "one two", "en", "b"),
        (7, "one two", "en", "b"),
        (8, "x" * 50_000, "en", None),
        (9, " ".join(words(2, 30_000)), "de", "c"),
        (10, "a same line here\na same line hero\nsome other line\n\na same line here", "en", "a"),
        (11, "a same lime here\nquite another text line", "en", "a"),
        (12, "\x00 ▁ ퟿ 😀 <|endoftext|> </s>[INST] ~0", "en", "a"),
        (13, "quite another text lines\n", "en", "c"),
        (None, "text of nobody in these rows", "en", "a"),
        (None, None, None, None),
        (14, " ".join(words(5, 80)), None, "c"),
        (14, " ".join(words(5, 80)), None, "c"),
        (15, " ".join(words(6, 80)), "fr", None),
    ]
    return [(i, t, lang, s, len(t) if t is not None else None) for i, t, lang, s in rows]


@pytest.fixture(scope="session")
def awkward(spark):
    """The awkward rows with extra columns of clashing names."""
    docs = spark.createDataFrame(awkward_rows(), SCHEMA)
    return docs.select("*", *(F.lit(f"x-{c}").alias(c) for c in CLASHING)).repartition(3)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def labels(spark):
    rows = [(i, 1 if i not in (9, 12) else 0, 0) for i in (0, 1, 2, 6, 9, 12, 14, 15)] + [(None, 1, 0), (3, None, 0)]
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")


def frame(df):
    """Rows as sorted plain tuples."""
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.fixture(scope="session")
def rows_of():
    return frame
