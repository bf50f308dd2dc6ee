"""Windows of words whose state is packed: the same counts as a row of state per word, in far fewer rows."""

import datetime as dt
import subprocess
import sys
from collections import Counter

import pytest
from conftest import rows
from pyspark import cloudpickle
from pyspark.sql import functions as F

import __spark_entry__ as entry
from marketflow.session import scratch_path
from marketflow.streaming import packed as P
from marketflow.streaming import sinks as K
from marketflow.streaming import words as X

AT = dt.datetime(2020, 1, 1)
#: Seconds and line: ends of windows, a time long ago, no time, no text, empty words, long and foreign words.
LINES = [
    (0, "a b a"), (4, "a  b"), (5, ""), (9, " "), (10, None), (None, "a b"), (14, "ä 漢字 a"), (15, "x" * 70_000 + " b"),
    (-100_003, "a old"), (33, " ".join(f"w{k % 700}" for k in range(5000))), (33, "w1 w1"), (61, "late" + " b" * 300),
]


def table(spark, lines=LINES):
    made = [(None if t is None else AT + dt.timedelta(seconds=t), v) for t, v in lines]
    return spark.createDataFrame(made, "timestamp timestamp, value string").repartition(3)


def streamed(spark, df, **options):
    path = scratch_path(spark, "in")
    df.write.parquet(path)
    return spark.readStream.schema(df.schema).options(**options).parquet(path)


def expected(lines=LINES, width=10, slide=5):
    n = Counter()
    for t, v in lines:
        if t is not None and v is not None:
            first = t // slide * slide
            starts = [s for s in range(first - width // slide * slide, first + slide, slide) if s <= t < s + width]
            n.update((s, w) for s in starts for w in v.split(" "))
    return sorted(((AT + dt.timedelta(seconds=s), AT + dt.timedelta(seconds=s + width), w, k) for (s, w), k in n.items()), key=repr)


def flat(df):
    return df.select(F.col("wdw.start").cast("timestamp_ntz"), F.col("wdw.end").cast("timestamp_ntz"), "word", "n")


@pytest.mark.parametrize("parts", [1, 7, 64])
@pytest.mark.parametrize("lists", [True, False])
def test_packed_windows(spark, parts, lists):
    words = X.split_words(table(spark), lists=lists)
    got = X.windowed_word_counts(words, "10 seconds", "5 seconds", parts=parts)
    assert [c for c, _ in got.dtypes] == ["wdw", "word", "n"] and got.dtypes[2][1] == "bigint"
    assert rows(flat(got)) == expected()


@pytest.mark.parametrize("width,slide", [(10, 5), (10, 3), (5, 5), (7, 7), (11, 4)])
def test_windows_of_any_slide(spark, width, slide):
    words = X.split_words(table(spark), lists=True)
    epoch = int(AT.replace(tzinfo=dt.timezone.utc).timestamp())
    got = X.windowed_word_counts(words, f"{width} seconds", f"{slide} seconds", parts=5)
    plain = X.windowed_word_counts(X.split_words(table(spark)), f"{width} seconds", f"{slide} seconds")
    assert rows(flat(got)) == rows(flat(plain))
    if epoch % slide == 0:
        assert rows(flat(got)) == expected(width=width, slide=slide)


def test_many_batches_in_one_task(spark, monkeypatch):
    monkeypatch.setattr(P, "WORDS", 50)
    monkeypatch.setattr(P, "BYTES", 2000)
    words = X.split_words(table(spark).coalesce(1), lists=True)
    assert rows(flat(X.windowed_word_counts(words, "10 seconds", "5 seconds", parts=3))) == expected()


def test_null_words_are_words(spark):
    df = spark.createDataFrame([(AT, ["a", None, None]), (AT, [None, ""]), (AT, None), (AT, [])], "timestamp timestamp, words array<string>")
    got = X.windowed_word_counts(df, "10 seconds", "10 seconds", parts=4)
    assert rows(got, "word", "n") == sorted([("a", 1), (None, 3), ("", 1)], key=repr)


def test_intervals(spark):
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "Europe/London")  # an hour ahead of UTC on the first day of 1970
    try:
        assert P._micros(spark, "10 hours", "1 day 2 seconds", "200 days", "3 microseconds") == [36_000_000_000, 86_402_000_000, 200 * 86_400_000_000, 3]
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


def test_complete_stream_over_batches(spark):
    words = X.split_words(streamed(spark, table(spark), maxFilesPerTrigger=1), lists=True)
    assert rows(flat(K.run_complete(X.windowed_word_counts(words, "10 seconds", "5 seconds", parts=3)))) == expected()


def test_only_closed_windows_are_appended(spark):
    words = X.split_words(streamed(spark, table(spark)), lists=True)
    out, _ = K.run_append(X.windowed_word_counts(words, "10 seconds", "5 seconds", "2 seconds", parts=3))
    closed = AT + dt.timedelta(seconds=61 - 2)  # lines without words do not move the watermark
    assert rows(flat(out)) == [r for r in expected() if r[1] <= closed]


def test_lines_without_words_do_not_close_windows(spark):
    lines = [(0, "a"), (11, "b"), (15, None), (16, None), (None, "c")]
    words = X.split_words(streamed(spark, table(spark, lines)), lists=True)
    out, _ = K.run_append(X.windowed_word_counts(words, "10 seconds", "5 seconds", "2 seconds", parts=3))
    assert rows(flat(out)) == [r for r in expected(lines) if r[1] <= AT + dt.timedelta(seconds=9)]


def test_watermark_set_before(spark):
    words = X.split_words(streamed(spark, table(spark)).withWatermark("timestamp", "2 seconds"), lists=True)
    out, _ = K.run_append(X.windowed_word_counts(words, "10 seconds", "5 seconds", parts=3))
    assert rows(flat(out)) == [r for r in expected() if r[1] <= AT + dt.timedelta(seconds=61 - 2)]


def test_functions_need_no_package_on_executors():
    """Executors of a cluster have pyarrow, and this package only where it was sent."""
    code = (
        "import pickle, sys; pack, unpack = pickle.load(sys.stdin.buffer); import pyarrow as pa; "
        "rows = [pa.array([1, 2]), pa.array([['a', 'b', 'a'], ['a']])]; "
        "out = next(pack([pa.RecordBatch.from_arrays(rows, ['ts', 'words'])])).column(2); "
        "lists = pa.ListArray.from_arrays(pa.array([0, len(out)], pa.int32()), out); "
        "assert sorted((e['word'], e['n']) for e in unpack(lists)[0].as_py()) == [('a', 3), ('b', 1)]; "
        "assert 'marketflow' not in sys.modules"
    )
    both = cloudpickle.dumps((P._packer("ts", 10, 5, 3), P._unpacker()))
    subprocess.run([sys.executable, "-c", code], input=both, check=True, cwd="/")


@pytest.mark.parametrize("name", ["st_05_windowed_word_counts", "st_07_watermarked_word_counts"])
def test_state_of_a_window_is_few_rows(spark, tmp_path, monkeypatch, name):
    """20,000 different words in two windows were 40,000 rows of state, each read, written and scanned."""
    docs = [(k, " ".join(f"w{k}x{i}" for i in range(5000))) for k in range(4)]
    spark.createDataFrame(docs, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    queries, start = [], K.start
    monkeypatch.setattr(K, "start", lambda *a: queries.append(start(*a)) or queries[-1])
    got = entry.queries()[name](spark, str(tmp_path))
    assert got.count() == (40_000 if "05" in name else 0)
    kept = [op["numRowsTotal"] for p in queries[0].recentProgress for op in p["stateOperators"]]
    assert 0 < max(kept) <= 200
