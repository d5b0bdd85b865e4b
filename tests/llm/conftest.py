import pytest
from pyspark.sql import functions as F, types as T

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def make_docs(spark):
    """Documents from (id, text) or (id, text, source) rows, with columns that operators might use themselves."""

    def make(rows):
        full = [(r[0], r[1], "en", r[2] if len(r) > 2 else "s", len(r[1] or "")) for r in rows]
        docs = spark.createDataFrame(full, DOCS)
        clashing = ("row", "key", "size", "hash", "group_size", "slice", "tie", "node", "copies", "score", "features", "rank")
        return docs.withColumns({c: F.lit("extra") for c in clashing})

    return make


@pytest.fixture(scope="session")
def empty_docs(spark):
    return spark.createDataFrame([], T.StructType([T.StructField("doc_id", T.LongType()), *[T.StructField(c, T.StringType()) for c in ("text", "lang", "source")]]))


@pytest.fixture(scope="session")
def hard_rows():
    """Nulls, empty and blank texts, copies, repeated rows, ties, and a very long text."""
    passage = " ".join(f"w{i}" for i in range(60))
    near = " ".join(f"n{i}" for i in range(100))
    return [
        (1, "alpha beta gamma", "a"), (2, None, "a"), (3, "", None), (4, "alpha beta gamma", "b"),
        (5, "x", None), (5, "x", None), (None, "alpha beta gamma", "c"), (None, None, None), (6, " \t\n", "a"),
        (7, f"{passage} end one", "b"), (8, f"start two {passage} {passage}", "b"), (9, "é   ß　z " * 3, "c"),
        (10, near, "a"), (11, near.replace("n50", "other"), "a"), (12, near.upper(), "b"),
        (13, " ".join(f"long{i % 977}" for i in range(30_000)), "d"), (14, "x x x x x x " * 20, "d"), (-15, "x\x0by\x0cz", "e"),
    ]
