"""Words per document, with and without repeated ids."""

from collections import Counter

from conftest import plan, rows

import __spark_entry__ as entry
from marketflow.suite.functions import _words_per_document

DOCS = [
    (1, "b a  b a\nb"), (2, ""), (3, None), (4, " "), (5, "one"), (6, "ä z ä Z"),
    (7, "b a"), (7, "a c"), (7, None), (None, "x y"), (None, "y y"), (8, " ".join(str(k % 97) for k in range(5000))),
]


def counted(docs):
    n = Counter((d, w) for d, t in docs if t is not None for w in t.split(" "))
    return sorted(((*k, v) for k, v in n.items()), key=repr)


def test_words_per_document(spark):
    for docs in (DOCS, [d for d in DOCS if d[0] not in (None, 7)], DOCS[-3:-1], []):
        got = _words_per_document(spark.createDataFrame(docs, "doc_id long, text string"))
        assert got.dtypes == [("doc_id", "bigint"), ("word", "string"), ("n", "bigint")]
        assert rows(got) == counted(docs)


def test_words_of_distinct_ids_are_not_shuffled(spark, sf_dir):
    assert "Exchange" not in plan(entry.queries()["str_02_words"](spark, sf_dir))
