import pytest
from pyspark.sql import functions as F

LONG = " ".join(f"word{i % 977} und {i}" for i in range(40_000))
ROWS = [
    (1, "a b c d e f"), (2, "a  b\tc d\x0be f"), (None, "a b c d e f"), (3, None), (4, ""), (4, ""), (5, " \t "),
    (6, LONG), (7, LONG + " "), (8, LONG), (9, "One line of some words here\nOne line of some words here\nOther words stand in this one"),
    (9, "One line of some words here\nOne line of some words here\nOther words stand in this one"), (9, "the same id, another text"),
    (10, "mail a.b@c.example and 10.0.0.1 or +1 (743) 555-3824, 4111 1111 1111 1111."), (11, "é" * 3000), (None, None),
    (-5, "a b c d e f "), (12, "<|endoftext|>'s \x1c İ Σ"),
]
CLASHES = ("kept", "fp1", "uid", "n", "root", "score", "size", "part", "copies", "key", "value", "ids", "spans", "mark", "words", "lines", "drop", "rank", "target")


@pytest.fixture(scope="session")
def odd_rows():
    return ROWS


@pytest.fixture(scope="session")
def odd(spark):
    """Nulls, empty and very long texts, ties, repeated rows and columns named like internal ones."""
    rows = [(i, t, "en", None if k % 5 == 0 else f"s{k % 3}", len(t or "")) for k, (i, t) in enumerate(ROWS)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(3)
    return df.withColumns({c: F.lit(c) for c in CLASHES})


@pytest.fixture(scope="session")
def empty(odd):
    return odd.where("false")


@pytest.fixture(scope="session")
def small(spark):
    return spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
