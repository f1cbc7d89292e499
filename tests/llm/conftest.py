import random

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, kept boolean, score double"


def words(seed, n):
    r = random.Random(seed)
    return " ".join("".join(r.choice(["th", "an", "er", "ou", "é", "ti"]) for _ in range(r.randint(1, 4))) for _ in range(n))


@pytest.fixture(scope="session")
def edge_rows():
    """Nulls in every column, empty and long texts, ties, repeated rows; columns that clash with outputs."""
    base = words(1, 400)
    long = words(2, 9000)
    texts = [base, base, None, "", base + " end.", long, long, long[:30000] + " x " + long[30000:], "a", "\x1c\x85　 \t\n", "Don't  stop\r\n!! 12345 ñandú́",
             words(3, 700), words(3, 700).upper(), "<|endoftext|> <|im_end|>", "." * 3000, "x" * 9000, "1 2 3", "A b", "a B"]
    rows = [(i, t, "en", "s", 1, True, 0.5) for i, t in enumerate(texts)]
    rows += [rows[5], rows[2], (None, base, None, None, None, None, None), (None, None, None, None, None, None, None), (None, words(9, 50), None, None, None, None, None)]
    return rows


@pytest.fixture(scope="session")
def edge_docs(spark, edge_rows):
    return spark.createDataFrame(edge_rows, SCHEMA).repartition(3)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def small(spark):
    return "/root/testdata/sf0.001"
