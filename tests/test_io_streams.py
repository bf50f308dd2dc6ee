"""Readers, writers, snapshots and streams on small files."""

import pytest
from conftest import plan, rows
from pyspark.sql import functions as F

from marketflow.operators import partitions as P
from marketflow.operators import snapshots as V
from marketflow.session import scratch_path
from marketflow.sources import files as R
from marketflow.sources import jdbc as J
from marketflow.sources import sinks as K
from marketflow.streaming import quotes as Q
from marketflow.streaming import sinks as SK
from marketflow.streaming import sources as SS
from marketflow.streaming import words as SW


def test_partition_pruning_and_pushdown(spark):
    name = K.fresh_table(spark)
    K.create_clustered_table(spark, name, "sym string, day int, v double", "sym")
    df = spark.range(100).select(
        F.when(F.col("id") % 2 == 0, "A").otherwise("B").alias("sym"), F.col("id").cast("int").alias("day"),
        F.lit(1.0).alias("v"),
    )
    K.append_clustered(df, name, "sym", ["day"])
    got = K.read_by_key(spark, name, ["sym", "day"], {"sym": "A", "day": 4})
    assert rows(got, "sym", "day") == [("A", 4)]
    text = plan(got)
    assert "PartitionFilters: [isnotnull(sym" in text and "EqualTo(day,4)" in text
    with pytest.raises(ValueError):
        K.read_by_key(spark, name, ["sym", "day"], {"v": 1.0})


def test_items_path_may_be_null(spark, tmp_path):
    (tmp_path / "items.xml").write_text(
        "<items><item id='1'><batters><batter id='10'>Plain</batter><batter id='11'>Dark</batter></batters></item>"
        "<item id='2'><name>x</name></item></items>"
    )
    df = R.read_xml(spark, str(tmp_path / "items.xml"), "item", root_tag="items", value_tag="true")
    got = df.select("_id", F.explode_outer("batters.batter").alias("b")).select("_id", "b._id", "b.true")
    assert rows(got) == [(1, 10, "Plain"), (1, 11, "Dark"), (2, None, None)]


def test_file_date_from_gzip_name(spark, tmp_path):
    import gzip

    with gzip.open(tmp_path / "fo01JUN2023bhav.csv.gz", "wt") as f:
        f.write("a\n1\n2\n")
    got = R.with_file_date(R.read_csv(spark, str(tmp_path)))
    assert [str(r.file_date) for r in got.collect()] == ["2023-06-01"] * 2


def test_jdbc_arguments(monkeypatch):
    """No database is started here: only what is passed to Spark's reader is checked."""
    calls = []

    class Reader:
        def jdbc(self, *args, **kw):
            calls.append((args, kw))

    class Session:
        read = Reader()

    J.read_jdbc(Session(), "u", "t", {"user": "x"}, "id", 0, 1000, 4)
    J.read_jdbc_query(Session(), "u", "select 1")
    assert calls[0] == (("u", "t", "id", 0, 1000, 4), {"properties": {"user": "x"}})
    assert calls[1][0] == ("u", "(select 1) fq")


def test_snapshot_history(spark):
    path = scratch_path(spark, "vt")
    df = spark.createDataFrame([("ACC", 1), ("ITC", 2), (None, 3)], "symbol string, n int")
    V.vt_create(df, path, ["symbol"])
    V.vt_update(spark, path, {"symbol": "'ACCEMENT'"}, "symbol = 'ACC'")
    V.vt_insert(spark, path, df.filter("symbol = 'ACC'"))
    V.vt_delete(spark, path, "symbol = 'ITC'")
    assert rows(V.vt_read(spark, path)) == [("ACC", 1), ("ACCEMENT", 1), (None, 3)]
    assert rows(V.vt_read(spark, path, version=0)) == rows(df)
    V.vt_restore(spark, path, 2, "symbol = 'ITC'")
    assert V.vt_read(spark, path).filter("symbol = 'ITC'").count() == 1
    ops = [r.operation for r in V.vt_history(spark, path).orderBy("version").collect()]
    assert ops == ["CREATE", "UPDATE", "INSERT", "DELETE", "RESTORE"]
    assert rows(V.vt_diff_counts(spark, path, 0, 1, "symbol")) == [("ACC", 1, 0), ("ACCEMENT", 0, 1), ("ITC", 1, 1), (None, 1, 1)]
    with pytest.raises(ValueError):
        V.vt_read(spark, path, version=99)


def test_delete_keeps_rows_whose_predicate_is_null(spark):
    path = scratch_path(spark, "vt")
    V.vt_create(spark.createDataFrame([(1, None), (2, 5)], "a int, b int"), path)
    V.vt_delete(spark, path, "b > 1")
    assert rows(V.vt_read(spark, path)) == [(1, None)]


def test_merge_never_matches_null_keys_unless_asked(spark):
    path = scratch_path(spark, "vt")
    df = spark.createDataFrame([(None, 1), (7, 2)], "k int, v int")
    V.vt_create(df, path)
    V.vt_merge_insert(spark, path, df, ["k"], null_safe=True)
    assert V.vt_read(spark, path).count() == 2
    V.vt_merge_insert(spark, path, df, ["k"])
    assert V.vt_read(spark, path).count() == 3


def test_unchanged_folders_are_not_rewritten(spark):
    path = scratch_path(spark, "vt")
    V.vt_create(spark.createDataFrame([(1,)], "a int"), path)
    V.vt_insert(spark, path, spark.createDataFrame([(2,)], "a int"))
    V.vt_delete(spark, path, "a = 2")
    folders = [r.folders for r in V._history(spark, path).orderBy("version").collect()]
    assert folders[2][0] == folders[0][0] and folders[2][1] != folders[1][1]


def lines(spark, folder, batches):
    for i, text in enumerate(batches):
        spark.createDataFrame(text, "value string, timestamp timestamp").coalesce(1).write.mode("append").parquet(folder)


def test_stream_equals_batch(spark):
    folder = scratch_path(spark, "in")
    stamp = F.timestamp_seconds(F.col("id") * 3)
    rows_ = spark.range(300).select(F.concat_ws(" ", F.lit("spark"), (F.col("id") % 7).cast("string")).alias("value"), stamp.alias("timestamp"))
    rows_.repartition(5).write.parquet(folder)
    stream = spark.readStream.schema(rows_.schema).option("maxFilesPerTrigger", 2).parquet(folder)
    batch_words, stream_words = SW.split_words(rows_), SW.split_words(stream)
    assert rows(SK.run_complete(SW.word_counts(stream_words))) == rows(SW.word_counts(batch_words))
    windowed = SK.run_complete(SW.windowed_word_counts(stream_words, "10 seconds", "5 seconds"))
    assert rows(windowed) == rows(SW.windowed_word_counts(batch_words, "10 seconds", "5 seconds"))
    updated = SK.run_update(SW.word_counts(stream_words), ["word"])
    assert rows(updated) == rows(SW.word_counts(batch_words))
    weights = spark.createDataFrame([("spark", 40), ("java", 90)], "word string, freq int")
    weighted = rows(SK.run_complete(SW.weighted_word_counts(stream_words, weights)))
    assert ("spark", 40, 300, 12000) in weighted and all(r[1] == 0 for r in weighted if r[0] != "spark")


def test_prices_compare_as_numbers(spark):
    line = "INFY,EQ,1,1,1,{p},1,1,10,95.5,X"
    records = spark.createDataFrame([("INFY", line.format(p=p).encode()) for p in ("9.5", "10.0")], "key string, value binary")
    quotes = SS.parse_quote_stream(records.withColumn("timestamp", F.current_timestamp()))
    got = Q.quote_summary(quotes).first()
    assert (got.minpr, got.maxpr, got.totqty) == (9.5, 10.0, 20)
    assert Q.to_kv_record(Q.quote_summary(quotes)).first().value == "20,10.0,191.0,95.5,9.5,10.0"


def test_replay_skips_headers_and_trailing_commas(spark):
    df = spark.createDataFrame([("SYMBOL,OPEN,",), ("INFY,10,",)], "value string")
    assert rows(SS.records_of(df)) == [("INFY", "INFY,10")]


def test_scratch_needs_a_shared_folder_on_a_cluster():
    class Context:
        master = "spark://host"

    class Conf:
        def get(self, key, default=None):
            return default

    class Session:
        sparkContext, conf = Context(), Conf()

    with pytest.raises(ValueError):
        scratch_path(Session(), "x")


def test_small_change_leaves_other_files(spark, tmp_path):
    path = str(tmp_path / "t")
    rows_ = spark.range(1000).selectExpr("id", "id % 3 as part", "'x' as v").repartitionByRange(4, "id")
    V.vt_create(rows_, path, ["part"])
    before = set(V.vt_read(spark, path).inputFiles())
    V.vt_update(spark, path, {"v": "'y'"}, "id = 5")
    after = set(V.vt_read(spark, path).inputFiles())
    assert len(before - after) == 1 and len(after - before) >= 1
    assert V.vt_read(spark, path).filter("v = 'y'").count() == 1
    V.vt_restore(spark, path, 0, "id < 10")
    for i in range(8):
        V.vt_insert(spark, path, spark.createDataFrame([(2000 + i, 1, "z")], "id long, part long, v string"))
    now = V.vt_read(spark, path)
    assert now.count() == 1008 and now.filter("v = 'y'").count() == 0
    assert plan(now).count("FileScan") == 1


def test_partitions_without_rows(spark):
    got = rows(P.partition_profile(P.partition_by(spark.range(10), F.lit(2), 4)))
    assert got == [(0, 0), (1, 0), (2, 10), (3, 0)]
    with pytest.raises(ValueError):
        SS.record_stream(spark, "/nowhere", start="latest")


def test_offsets_across_part_files(spark, tmp_path):
    """Parts of one folder are one text; other folders begin anew."""
    for folder in ("k=a", "k=b"):
        (tmp_path / folder).mkdir()
        for part in range(5):
            text = "".join(f"{folder} {part} {'é' * i}\n" for i in range(part * 7))
            (tmp_path / folder / f"part-{part:05d}.txt").write_text(text, newline="")
    got = rows(R.read_lines_with_offset(spark, str(tmp_path), parts=True), "offset", "line")
    want = []
    for folder in ("k=a", "k=b"):
        at = 0
        for part in range(5):
            for i in range(part * 7):
                line = f"{folder} {part} {'é' * i}"
                want.append((at, line))
                at += len(line.encode()) + 1
    assert got == sorted(want, key=repr)


def test_offsets_across_splits(spark, tmp_path):
    lines = [f"line {i} " + "é" * (i % 50) for i in range(3000)]
    path = tmp_path / "a.txt"
    path.write_text("\n".join(lines) + "\n", newline="")
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        got = rows(R.read_lines_with_offset(spark, str(path)), "offset", "line")
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    at, want = 0, []
    for line in lines:
        want.append((at, line))
        at += len(line.encode()) + 1
    assert got == sorted(want, key=repr)


def test_clean_scratch_removes_what_was_made(spark, tmp_path):
    from marketflow import session

    kept = list(session._handed_out)
    session._handed_out[:] = []
    try:
        name = K.fresh_table(spark)
        K.write_table(spark.range(3).toDF("a"), name)
        path = scratch_path(spark, "x")
        spark.range(3).write.parquet(path)
        session.clean_scratch(spark)
        assert name.split(".")[0] not in [d.name for d in spark.catalog.listDatabases()]
        with pytest.raises(Exception, match="PATH_NOT_FOUND"):
            spark.read.parquet(path)
    finally:
        session._handed_out[:] = kept


def test_progress_of_more_batches_than_spark_keeps(spark, tmp_path):
    path = str(tmp_path / "in")
    spark.range(120).selectExpr("cast(id as string) as value").repartition(120).write.text(path)
    n = len(spark.read.text(path).inputFiles())
    old = spark.conf.get("spark.sql.streaming.numRecentProgressUpdates")
    spark.conf.set("spark.sql.streaming.numRecentProgressUpdates", "5")
    try:
        lines = spark.readStream.option("maxFilesPerTrigger", max(1, n // 12)).text(path)
        _, query, batches = SK.run_logged(lines)
    finally:
        spark.conf.set("spark.sql.streaming.numRecentProgressUpdates", old)
    assert len(query.recentProgress) <= 5 < len(batches)
    assert SK.progress_frame(query, batches).agg(F.sum("input_rows")).first()[0] == 120
