"""Hot-key windows against the plain window on the same rows."""

import pytest
from conftest import plan, rows
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from marketflow.operators.skew import find_hot_keys
from marketflow.operators import windows
from marketflow.operators.windows import lagged, moving_avg, row_numbers, running_sum, top_per_key


@pytest.fixture(scope="module")
def skewed(spark):
    """Two thirds of the rows under key 1; days tie; key null and value null occur."""
    base = spark.range(3000).select(
        F.col("id"),
        F.when(F.col("id") % 3 != 0, 1).when(F.col("id") % 7 == 0, None).otherwise(F.col("id") % 40).alias("k"),
        (F.pmod(F.xxhash64("id"), F.lit(60))).alias("day"),
        F.when(F.col("id") % 11 != 0, F.col("id") % 100).alias("v"),
    )
    return base.repartition(6).persist()


def same(a, b):
    cols = a.columns
    assert a.exceptAll(b.select(*cols)).count() == 0
    assert b.select(*cols).exceptAll(a).count() == 0


def test_hot_keys_are_found(skewed):
    hot = find_hot_keys(skewed, ["k"], ["day", "id"], 8)
    assert [r[0] for r in hot.table.collect()] == [1]
    tagged = hot.tag(skewed)
    assert tagged.count() == skewed.count()
    assert tagged.filter("_range is not null and k <> 1").count() == 0
    per = [r["count"] for r in tagged.filter("k = 1").groupBy("_range").count().collect()]
    assert len(per) >= 4 and max(per) < 2000


def test_ranges_follow_the_order(skewed):
    tagged = find_hot_keys(skewed, ["k"], ["day", "id"], 16).tag(skewed).filter("_range is not null")
    edges = tagged.groupBy("_range").agg(
        F.min(F.struct("day", "id")).alias("lo"), F.max(F.struct("day", "id")).alias("hi")
    )
    found = [(tuple(r.lo), tuple(r.hi)) for r in edges.orderBy("_range").collect()]
    assert all(a[1] < b[0] for a, b in zip(found, found[1:]))


@pytest.mark.parametrize("tasks", [2, 8, 64])
def test_row_numbers(skewed, tasks):
    got = row_numbers(skewed, ["k"], ["day", "id"], tasks=tasks)
    want = skewed.withColumn("rno", F.row_number().over(W.partitionBy("k").orderBy("day", "id")).cast("long"))
    same(got, want)


def test_global_row_numbers_use_many_tasks(skewed):
    got = row_numbers(skewed, [], ["day", "id"])
    want = skewed.withColumn("rno", F.row_number().over(W.orderBy("day", "id")).cast("long"))
    same(got, want)
    windows = [line for line in plan(got).splitlines() if "Window [row_number()" in line]
    assert windows and all("_range" in line for line in windows)


@pytest.mark.parametrize("tasks", [2, 8, 64])
@pytest.mark.parametrize("frame", ["range", "rows"])
def test_running_sum(skewed, tasks, frame):
    order = ["day"] if frame == "range" else ["day", "id"]
    spec = W.partitionBy("k").orderBy(*order)
    if frame == "rows":
        spec = spec.rowsBetween(W.unboundedPreceding, 0)
    got = running_sum(skewed, ["k"], order, {"s": F.col("v"), "p": F.col("v") * 2}, frame, tasks)
    want = skewed.withColumns({"s": F.sum("v").over(spec), "p": F.sum(F.col("v") * 2).over(spec)})
    same(got, want)


def test_running_sum_of_hot_keys_reads_twice(spark, skewed, tmp_path):
    path = str(tmp_path / "skewed")
    skewed.write.parquet(path)
    df = spark.read.parquet(path)
    text = plan(running_sum(df, ["k"], ["day", "id"], {"s": F.col("v")}, "rows", 8))
    assert text.count("FileScan") == 2  # the rows, and the totals of ranges
    assert plan(row_numbers(df, ["k"], ["day", "id"], tasks=8)).count("FileScan") == 2


def test_running_sum_when_one_day_is_most_of_a_key(spark):
    df = spark.range(2000).select(
        "id", F.lit(1).alias("k"), F.when(F.col("id") % 10 != 0, 5).otherwise(F.col("id") % 9).alias("day"),
        (F.col("id") % 13).alias("v"),
    )
    assert find_hot_keys(df, ["k"], ["day"], 16).heavy_ties
    got = running_sum(df, ["k"], ["day"], {"s": F.col("v")}, tasks=16)
    same(got, df.withColumn("s", F.sum("v").over(W.partitionBy("k").orderBy("day"))))


def test_running_sum_of_only_nulls_stays_null(spark):
    df = spark.range(500).select("id", F.lit(1).alias("k"), F.lit(None).cast("long").alias("v"))
    got = running_sum(df, ["k"], ["id"], {"s": F.col("v")}, tasks=8)
    assert got.filter("s is not null").count() == 0


@pytest.mark.parametrize("block_rows", [1, 7, 100])
def test_moving_avg_and_lag_across_blocks(skewed, block_rows):
    spec = W.partitionBy("k").orderBy("day", "id")
    got = moving_avg(skewed, ["k"], ["day", "id"], "v", {"m5": 5, "m20": 20}, block_rows=block_rows)
    want = skewed.withColumns({f"m{n}": F.avg("v").over(spec.rowsBetween(-n, 0)) for n in (5, 20)})
    same(got, want)
    got = lagged(skewed, ["k"], ["day", "id"], "v", [1, 20], block_rows=block_rows)
    same(got, skewed.withColumns({f"v_{n}": F.lag("v", n).over(spec) for n in (1, 20)}))


@pytest.mark.parametrize("block_rows", [1, 100, 65_536])
def test_long_moving_avg_is_put_together_from_laps(skewed, monkeypatch, block_rows):
    monkeypatch.setattr(windows, "SHORT_FRAME", 2)
    spec = W.partitionBy("k").orderBy("day", "id")
    sizes = {f"m{n}": n for n in (2, 3, 20, 200)}
    kinds = {"v": "long", "d": "decimal(12,2)", "x": "double"}
    df = skewed.withColumns({"d": (F.col("v") / 4).cast("decimal(12,2)"), "x": F.col("v") / 8})
    for col, kind in kinds.items():
        got = moving_avg(df, ["k"], ["day", "id"], col, sizes, block_rows=block_rows)
        want = df.withColumns({name: F.avg(col).over(spec.rowsBetween(-n, 0)) for name, n in sizes.items()})
        assert got.schema == want.schema, kind
        same(got, want)


def test_long_moving_avg_shuffles_once(skewed):
    text = plan(moving_avg(skewed, ["k"], ["day", "id"], "v", {"m200": 200}))
    assert text.count("Exchange hashpartitioning") == 1
    assert "-200, currentrow" not in text  # no frame of that length, only a look at the row 200 places back


def test_five_preceding_rows_are_six_rows(spark):
    df = spark.range(10).select(F.lit("A").alias("s"), "id", F.col("id").cast("double").alias("c"))
    got = moving_avg(df, ["s"], ["id"], "c", {"m": 5}, tasks=2)
    assert got.filter("id = 9").first().m == sum(range(4, 10)) / 6


def test_top_per_key_both_ways(skewed, spark):
    spec = W.partitionBy("k").orderBy("day", "id")
    order = [F.col("day"), F.col("id")]
    for n, skip in ((3, 0), (5, 2)):
        want = skewed.withColumn("r", F.row_number().over(spec)).filter(f"r <= {n} and r > {skip}").drop("r")
        same(top_per_key(skewed, ["k"], order, n, skip), want)
    spark.conf.set("spark.sql.optimizer.windowGroupLimitThreshold", "2")
    try:
        want = skewed.withColumn("r", F.row_number().over(spec)).filter("r <= 50").drop("r")
        same(top_per_key(skewed, ["k"], order, 50), want)
    finally:
        spark.conf.unset("spark.sql.optimizer.windowGroupLimitThreshold")


def test_top_per_key_is_cut_before_the_shuffle(skewed):
    text = plan(top_per_key(skewed, ["k"], [F.col("day"), F.col("id")], 3))
    below_exchange = text.split("Exchange hashpartitioning")[1]
    assert "WindowGroupLimit" in below_exchange


def test_top_per_key_of_equal_rows(spark):
    # 3,000 equal rows of one key and more rows wanted than Catalyst's own limit covers
    df = spark.range(3000).selectExpr("1 as k", "7 as v").unionByName(spark.range(10).selectExpr("1 as k", "cast(id as int) as v"))
    got = top_per_key(df, ["k"], [F.desc("v")], 2500)
    assert rows(got.groupBy("v").count()) == [(7, 2498), (8, 1), (9, 1)]
    low = top_per_key(df, ["k"], [F.col("v")], 1500)
    assert rows(low.groupBy("v").count()) == [(0, 1), (1, 1), (2, 1), (3, 1), (4, 1), (5, 1), (6, 1), (7, 1493)]
