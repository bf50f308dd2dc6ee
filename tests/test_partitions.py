"""Partition members come in bounded parts."""

from pyspark.sql import functions as F

from marketflow.operators import partitions as P


def test_members_of_a_partition_come_batch_by_batch(spark):
    old = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "100")
    try:
        df = P.partition_by(spark.range(1050), F.lit(0), 2)
        got = P.partition_members(df, "id", ",").collect()
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", old)
    assert max(r["n"] for r in got) <= 100 and sum(r["n"] for r in got) == 1050
    assert [(r["part"], r["n"], r["members"]) for r in got if r["partition"] == 1] == [(0, 0, "")]
    parts = sorted((r["part"], r["members"]) for r in got if r["partition"] == 0)
    assert [p for p, _ in parts] == list(range(len(parts)))
    assert sorted(int(v) for _, m in parts for v in m.split(",")) == list(range(1050))
