"""Streams over tables that are folders of several files, as large tables are."""

import duckdb
import pytest
from compare import differences, duck

import __spark_entry__ as entry
from marketflow.streaming import sinks
from marketflow.streaming import words as X

QUERIES, SQL = entry.queries(), entry.oracle_sql()


@pytest.fixture(scope="module")
def folder(spark, sf_dir, tmp_path_factory):
    out = str(tmp_path_factory.mktemp("tables"))
    for name in ("documents", "benchmark", "events", "customer"):
        spark.read.parquet(f"{sf_dir}/{name}.parquet").repartition(3).write.parquet(f"{out}/{name}.parquet")
    return out


@pytest.mark.parametrize(
    "name",
    [
        "st_04_word_counts", "st_05_windowed_word_counts", "st_12_weighted_word_counts", "st_03_parse_quotes",
        "jn_18_stream_static_join",
    ],
)
def test_stream_over_a_folder(spark, sf_dir, folder, name):
    assert differences(QUERIES[name](spark, folder), duck(sf_dir), SQL[name]) == []


def test_closed_windows_of_a_folder(spark, sf_dir, tmp_path):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    spread = docs.withColumn("doc_id", docs["doc_id"] * 20).repartition(3)  # so that some windows are closed
    spread.write.parquet(f"{tmp_path}/documents.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{tmp_path}/documents.parquet/*.parquet')")
    name = "st_07_watermarked_word_counts"
    assert differences(QUERIES[name](spark, str(tmp_path)), con, SQL[name]) == []


def test_state_is_on_disk(spark, sf_dir):
    path = f"{sf_dir}/documents.parque[t]"
    docs = spark.readStream.schema("doc_id long, text string").parquet(path).selectExpr("text", "timestamp_seconds(doc_id) ts")
    counts = X.windowed_word_counts(X.split_words(docs, "text", ("ts",)), "1 hour", "1 hour", "1 minute", "ts")
    _, query = sinks.run_append(counts)
    metrics = query.lastProgress["stateOperators"][0]["customMetrics"]
    assert any(m.startswith("rocksdb") for m in metrics)
    assert all(spark.conf.get(k, None) is None for k in sinks.STATE)
