"""Starting streaming queries and reading what they produced."""

from __future__ import annotations

import json
import threading

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery, StreamingQueryListener

from marketflow.session import scratch_path


PROVIDER = "spark.sql.streaming.stateStore.providerClass"
#: State lives on the executors' disks, within a bounded memory, unless the session names a provider.
STATE = {
    PROVIDER: "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    # else each store sets aside room for its files, however small they are
    "spark.sql.streaming.stateStore.rocksdb.allowFAllocate": "false",
}
#: An Arrow function gives back the rows of a whole batch at once, and packed rows grow manifold.
ARROW = {"spark.sql.execution.arrow.maxBytesPerBatch": "8m"}


def start(writer: DataStreamWriter, spark: SparkSession) -> StreamingQuery:
    """Start a stream that keeps its state as ``STATE`` says; the session itself stays as it is."""
    wanted = ARROW if spark.conf.get(PROVIDER, None) else STATE | ARROW
    added = [k for k in wanted if spark.conf.get(k, None) is None]
    for key in added:
        spark.conf.set(key, wanted[key])
    try:
        return writer.start()
    finally:
        for key in added:
            spark.conf.unset(key)


def start_sink(
    df: DataFrame,
    kind: str,
    mode: str,
    checkpoint: str,
    options: dict[str, str] | None = None,
    available_now: bool = False,
    name: str | None = None,
) -> StreamingQuery:
    """Start ``df`` into a console, Kafka, memory or Parquet sink."""
    writer = df.writeStream.format(kind).outputMode(mode).option("checkpointLocation", checkpoint)
    writer = writer.options(**(options or {}))
    if name is not None:
        writer = writer.queryName(name)
    if available_now:
        writer = writer.trigger(availableNow=True)
    return start(writer, df.sparkSession)


class ProgressLog(StreamingQueryListener):
    """Keeps the progress of every micro-batch of one query, however many there are."""

    def __init__(self) -> None:
        self.rows: list[dict] = []
        self.ended = threading.Event()

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        self.rows.append(json.loads(event.progress.json))

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        self.ended.set()


def run_logged(df: DataFrame) -> tuple[DataFrame, StreamingQuery, list[dict]]:
    """As :func:`run_append`, with the progress of all batches."""
    log, streams = ProgressLog(), df.sparkSession.streams
    streams.addListener(log)
    try:
        data, query = run_append(df)
        log.ended.wait(60)
    finally:
        streams.removeListener(log)
    return data, query, [r for r in log.rows if r["runId"] == str(query.runId)]


def run_append(df: DataFrame) -> tuple[DataFrame, StreamingQuery]:
    """Run a stream over what is available now; append mode, Parquet files in the shared folder."""
    spark = df.sparkSession
    out = scratch_path(spark, "stream")
    query = start_sink(
        df, "parquet", "append", f"{out}/checkpoint", {"path": f"{out}/data", "compression": "zstd"}, available_now=True
    )
    query.awaitTermination()
    return spark.read.schema(df.schema).parquet(f"{out}/data"), query


def _run_batches(df: DataFrame, mode: str) -> tuple[SparkSession, str]:
    spark = df.sparkSession
    out = scratch_path(spark, "stream")

    def save(batch: DataFrame, batch_id: int) -> None:
        # One folder per batch, overwritten when a batch is run again after a failure.
        batch.write.mode("overwrite").option("compression", "zstd").parquet(f"{out}/data/batch={batch_id}")

    writer = df.writeStream.outputMode(mode).option("checkpointLocation", f"{out}/checkpoint")
    start(writer.trigger(availableNow=True).foreachBatch(save), spark).awaitTermination()
    return spark, f"{out}/data"


def run_complete(df: DataFrame) -> DataFrame:
    """Complete mode: the result table after the last batch."""
    spark, path = _run_batches(df, "complete")
    batches = spark.read.parquet(path)
    # the batch is a partition: only its newest folder is read
    last = max(int(f.rsplit("/batch=", 1)[1].split("/")[0]) for f in batches.inputFiles())
    return batches.filter(F.col("batch") == last).drop("batch")


def run_update(df: DataFrame, keys: list[str]) -> DataFrame:
    """Update mode: the newest emitted row of every key."""
    spark, path = _run_batches(df, "update")
    rest = [c for c in df.columns if c not in keys]
    newest = spark.read.parquet(path).groupBy(*keys).agg(
        F.max_by(F.struct(*rest), "batch").alias("_row")
    )
    return newest.select(*keys, "_row.*")


def progress_frame(query: StreamingQuery, progress: list[dict] | None = None) -> DataFrame:
    """One row per micro-batch: ids, name, rows, and error text if the query failed.

    ``progress`` holds all batches (:func:`run_logged`); without it Spark's recent ones are shown.
    """
    spark = query.sparkSession if hasattr(query, "sparkSession") else SparkSession.active()
    failed = query.exception()
    rows = []
    for p in query.recentProgress if progress is None else progress:
        p = p if isinstance(p, dict) else json.loads(p.json)
        rows.append((p["id"], p["runId"], p.get("name"), p["batchId"], p["numInputRows"], str(failed) if failed else None))
    return spark.createDataFrame(
        rows, "id string, run_id string, name string, batch long, input_rows long, error string"
    )
