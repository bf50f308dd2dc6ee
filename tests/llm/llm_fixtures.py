import random

import pytest
from pyspark.sql import functions as F

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def make_docs(spark, rows):
    """documents from (doc_id, text) pairs, with columns whose names operators might use themselves."""
    full = [(d, t, "en", "src0", None if t is None else len(t)) for d, t in rows]
    df = spark.createDataFrame(full, SCHEMA)
    for clash in ("words", "hash", "key", "fp", "rid", "ord", "runs", "ids", "score", "start", "n", "bucket", "kept"):
        df = df.withColumn(clash, F.lit("x"))
    return df


def text_of(n, seed=0, vocabulary=3000):
    rng = random.Random(seed)
    return " ".join(f"w{rng.randrange(vocabulary)}" for _ in range(n))


def rows(df, *cols):
    picked = df.select(*cols) if cols else df
    return sorted((tuple(r) for r in picked.collect()), key=repr)


@pytest.fixture
def odd_rows():
    """Null and empty texts, separators only, one word, a very long text, repeated rows, ties, a null id."""
    long = text_of(30_000, 5)
    same = text_of(60, 6)
    return [
        (1, None), (2, ""), (3, " \t\n\x0b\x0c\r "), (4, "word"), (5, long), (6, same), (6, same), (7, same),
        (8, "a " * 3000), (9, "é" * 500 + " ß€𐍈 " * 40), (None, "no id here " * 30), (10, same + " and more"),
    ]
