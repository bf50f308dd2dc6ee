"""Structured Streaming over the whole tables, each run to the end of its input."""

from __future__ import annotations

from pyspark.sql import functions as F

from marketflow.session import scratch_path
from marketflow.streaming import quotes as Q
from marketflow.streaming import sinks as K
from marketflow.streaming import sources as S
from marketflow.streaming import words as X
from marketflow.suite.registry import query


def _stream(t, name: str):
    """The table's files as a stream."""
    schema = getattr(t, name).schema
    # A stream refuses the plain path of one file; as a pattern, the path is a file's or a folder's alike.
    return t.spark.readStream.schema(schema).parquet(t.path(name)[:-1] + "[t]")


def _lines(t):
    """Document lines; one minute of event time per document."""
    docs = _stream(t, "documents")
    return docs.select(
        F.col("text").alias("value"), F.timestamp_seconds(F.col("doc_id") * 60).alias("timestamp")
    )


def _words(t, lists: bool = False):
    return X.split_words(_lines(t), lists=lists)


#: A window of ten hours has 600 documents, with a thousand words or more for each part.
PARTS = 64

DOC_WORDS = """
w AS (SELECT unnest(string_split(text, ' ')) AS word, make_timestamp(doc_id * 60000000) AS ts FROM documents)
"""


def _sliding(source: str, keys: str, width: str, slide: str) -> str:
    """Rows of ``source`` once per sliding window (width is twice the slide)."""
    bucket = f"time_bucket(INTERVAL '{slide}', ts, TIMESTAMP '1970-01-01')"
    return (
        f"s AS (SELECT *, unnest([{bucket}, {bucket} - INTERVAL '{slide}']) AS w_start FROM {source}), "
        f"k AS (SELECT *, w_start + INTERVAL '{width}' AS w_end FROM s)"
    )


def _flat(df):
    return df.select(
        F.col("wdw.start").cast("timestamp_ntz").alias("w_start"),
        F.col("wdw.end").cast("timestamp_ntz").alias("w_end"),
        *[c for c in df.columns if c != "wdw"],
    )


@query("st_02_line_stream", "SELECT text AS value, count(*) AS n FROM (SELECT unnest(string_split(text, chr(10))) AS text FROM documents) GROUP BY 1")
def _(t):
    path = scratch_path(t.spark, "lines")
    t.documents.select("text").write.text(path)
    lines = S.line_stream(t.spark, path)
    out, _ = K.run_append(lines)
    return out.filter(F.col("timestamp").isNotNull()).groupBy("value").agg(F.count(F.lit(1)).alias("n"))


@query("st_04_word_counts", f"WITH {DOC_WORDS} SELECT word, count(*) AS n FROM w GROUP BY 1")
def _(t):
    return K.run_complete(X.word_counts(_words(t)))


@query(
    "st_05_windowed_word_counts",
    f"WITH {DOC_WORDS}, {_sliding('w', 'word', '10 hours', '5 hours')} SELECT w_start, w_end, word, count(*) AS n "
    "FROM k GROUP BY ALL",
)
def _(t):
    return _flat(K.run_complete(X.windowed_word_counts(_words(t, lists=True), "10 hours", "5 hours", parts=PARTS)))


@query(
    "st_06_record_word_counts",
    "WITH w AS (SELECT unnest(string_split(props, ' ')) AS word, ts FROM events), "
    f"{_sliding('w', 'word', '4 hours', '2 hours')} SELECT w_start, w_end, word, count(*) AS n FROM k GROUP BY ALL",
)
def _(t):
    # Message records: the payload is binary and becomes text first.
    path = scratch_path(t.spark, "records")
    t.events.select(
        F.col("event_type").alias("key"), F.col("props").cast("binary").alias("value"),
        F.col("ts").cast("timestamp").alias("timestamp"),
    ).write.parquet(path)
    records = S.record_stream(t.spark, path).withColumn("value", F.col("value").cast("string"))
    return _flat(K.run_complete(X.windowed_word_counts(X.split_words(records), "4 hours", "2 hours")))


@query(
    "st_07_watermarked_word_counts",
    f"WITH {DOC_WORDS}, {_sliding('w', 'word', '10 hours', '5 hours')} SELECT w_start, w_end, word, count(*) AS n FROM k "
    "WHERE w_end <= (SELECT max(ts) FROM w) - INTERVAL '2 minutes' GROUP BY ALL",
)
def _(t):
    # Append mode: a window is out once the watermark, two minutes behind the newest time, passes its end.
    counted = X.windowed_word_counts(_words(t, lists=True), "10 hours", "5 hours", watermark="2 minutes", parts=PARTS)
    out, _ = K.run_append(counted)
    return _flat(out)


def _quote_records(t):
    """Event rows as quote lines: symbol, six price fields, quantity and value at 8 and 9."""
    cents = F.round(F.col("value") * 100).cast("bigint").cast("string")
    price = F.col("value").cast("string")
    line = F.concat_ws(
        ",", "event_type", F.lit("EQ"), price, price, price, price, price, price, cents, price, F.lit("X")
    )
    return _stream(t, "events").select(
        F.col("event_type").alias("key"), line.cast("binary").alias("value"),
        F.col("ts").cast("timestamp").alias("timestamp"),
    )


def _quotes(t):
    return S.parse_quote_stream(_quote_records(t))


QUOTES = "q AS (SELECT event_type AS symbol, round(value * 100)::BIGINT AS qty, value AS vlu, value AS clspr, ts FROM events)"


@query("st_01_record_stream", "SELECT event_type AS key, props AS value, ts AS at FROM events")
def _(t):
    path = scratch_path(t.spark, "records")
    t.events.select(
        F.col("event_type").alias("key"), F.col("props").cast("binary").alias("value"),
        F.col("ts").cast("timestamp").alias("timestamp"),
    ).write.parquet(path)
    out, _ = K.run_append(S.record_stream(t.spark, path))
    return out.select("key", F.col("value").cast("string").alias("value"), F.col("timestamp").cast("timestamp_ntz").alias("at"))


@query("st_03_parse_quotes", f"WITH {QUOTES} SELECT symbol, qty, vlu, clspr, ts AS at FROM q")
def _(t):
    out, _ = K.run_append(_quotes(t))
    return out.select("symbol", "qty", "vlu", "clspr", F.col("tstamp").cast("timestamp_ntz").alias("at"))


@query(
    "st_08_quote_totals",
    f"WITH {QUOTES} SELECT symbol, sum(qty)::BIGINT AS totqty, avg(qty) AS avgqty, round(sum(vlu), 2) AS totvlu, "
    "round(avg(vlu), 8) AS avgvlu FROM q GROUP BY 1",
)
def _(t):
    totals = K.run_update(Q.quote_totals(_quotes(t)), ["symbol"])
    return totals.withColumns({c: F.round(c, n) for c, n in (("totvlu", 2), ("avgvlu", 8))})


_Q_WINDOWS = (
    "SELECT symbol, w_start, w_end, avg(qty) AS avgqty, round(avg(vlu), 8) AS avgval, sum(qty)::BIGINT AS totqty, "
    "round(sum(vlu), 2) AS sumval, min(clspr) AS mincls, max(clspr) AS maxcls FROM k"
)


@query(
    "st_09_quote_windows",
    f"WITH {QUOTES}, {_sliding('q', 'symbol', '1 day', '12 hours')} {_Q_WINDOWS} "
    "WHERE w_end <= (SELECT max(ts) FROM q) - INTERVAL '30 seconds' GROUP BY ALL",
)
def _(t):
    out, _ = K.run_append(Q.quote_windows(_quotes(t), "1 day", "12 hours"))
    return _flat(out).withColumns({c: F.round(c, n) for c, n in (("avgval", 8), ("sumval", 2))})


@query(
    "st_10_kv_records",
    f"WITH {QUOTES} SELECT symbol AS key, sum(qty)::BIGINT::VARCHAR AS totqty, min(clspr)::VARCHAR AS minpr, "
    "max(clspr)::VARCHAR AS maxpr, 6::INTEGER AS fields FROM q GROUP BY 1",
)
def _(t):
    records = K.run_update(Q.to_kv_record(Q.quote_summary(_quotes(t))), ["key"])
    part = F.split("value", ",")
    return records.select(
        "key", part[0].alias("totqty"), part[4].alias("minpr"), part[5].alias("maxpr"), F.size(part).alias("fields")
    )


@query(
    "st_11_sinks",
    f"WITH {QUOTES} SELECT symbol, count(*) AS n FROM q GROUP BY 1",
)
def _(t):
    # The stateless quote stream into a Parquet sink, then counted.
    out = scratch_path(t.spark, "sink")
    q = K.start_sink(_quotes(t), "parquet", "append", f"{out}/ck", {"path": f"{out}/data"}, available_now=True)
    q.awaitTermination()
    return t.spark.read.parquet(f"{out}/data").groupBy("symbol").agg(F.count(F.lit(1)).alias("n"))


def _weights(t):
    """Word weights: short document words by length, so most words have none."""
    word = F.explode(F.split("text", " ")).alias("word")
    return t.benchmark.select(word).distinct().select("word", F.length("word").alias("freq"))


@query(
    "st_12_weighted_word_counts",
    f"WITH {DOC_WORDS}, wt AS (SELECT DISTINCT unnest(string_split(text, ' ')) AS word FROM benchmark) "
    "SELECT word, coalesce(length(wt.word), 0)::INTEGER AS freq, n, coalesce(length(wt.word), 0) * n AS wtdfreq "
    "FROM (SELECT word, count(*) AS n FROM w GROUP BY 1) LEFT JOIN wt USING (word)",
)
def _(t):
    return K.run_complete(X.weighted_word_counts(_words(t), _weights(t)))


@query("jn_18_stream_static_join", "SELECT event_type, coalesce(c_name, '') AS name, count(*) AS n FROM events LEFT JOIN customer "
       "ON c_custkey = user_id GROUP BY ALL")  # fmt: skip
def _(t):
    static = t.customer.select(F.col("c_custkey").alias("user_id"), F.col("c_name").alias("name"))
    joined = _stream(t, "events").join(static, "user_id", "left_outer").na.fill("", ["name"])
    return K.run_complete(joined.groupBy("event_type", "name").agg(F.count(F.lit(1)).alias("n")))


@query("st_13_progress", "SELECT count(*) AS rows, true AS ok FROM events")
def _(t):
    _, q, batches = K.run_logged(_quotes(t))
    progress = K.progress_frame(q, batches)
    return progress.agg(F.sum("input_rows").alias("rows"), F.bool_and(F.col("error").isNull()).alias("ok"))


@query("st_14_output_modes", f"WITH {QUOTES}, a AS (SELECT symbol, sum(qty)::BIGINT AS totqty FROM q GROUP BY 1) "
       "SELECT 'update' AS mode, * FROM a UNION ALL SELECT 'complete', * FROM a")  # fmt: skip
def _(t):
    update = K.run_update(Q.quote_totals(_quotes(t)), ["symbol"]).select(F.lit("update").alias("mode"), "symbol", "totqty")
    complete = K.run_complete(Q.quote_totals(_quotes(t))).select(F.lit("complete").alias("mode"), "symbol", "totqty")
    return update.unionByName(complete)


@query("st_15_replay_csv", "SELECT o_orderstatus AS key, o_orderstatus || ',' || o_orderkey || ',' || o_custkey AS value FROM orders")
def _(t):
    # Daily files with a header and a trailing comma on every line.
    path = scratch_path(t.spark, "replay")
    line = F.concat_ws(",", "o_orderstatus", "o_orderkey", "o_custkey", F.lit(""))
    header = t.spark.createDataFrame([("SYMBOL,ORDER,CUSTOMER,",)], ["value"])
    t.orders.select(line.alias("value")).union(header).write.text(path)
    out, _ = K.run_append(S.replay_csv(t.spark, path, max_files_per_trigger=1))
    return out
