"""Session defaults and the shared scratch folder."""

from __future__ import annotations

import functools
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def build_session(app: str = "marketflow", master: str | None = None, **conf) -> SparkSession:
    """A session with the settings the queries rely on.

    Partition counts are left to the cluster; callers pass their own through ``conf``
    (keys written with ``__`` for dots).
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.ui.enabled": "false",
    }
    settings.update({k.replace("__", "."): str(v) for k, v in conf.items()})
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by ``spark.checkpoint.dir``.

    Only a local-mode session without that setting gets a temporary folder; on a cluster the
    setting is required, because a driver-local folder is not visible to executors.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
        named = _local_dir()
    return named.rstrip("/")


@functools.cache
def _local_dir() -> str:
    return tempfile.mkdtemp(prefix="marketflow-")


#: Paths handed out by this process, for :func:`clean_scratch`.
_handed_out: list[str] = []


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below :func:`shared_dir`; nothing exists there yet."""
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    _handed_out.append(path)
    return path


def clean_scratch(spark: SparkSession) -> None:
    """Drop the databases and delete the folders that this process made.

    For the end of an application, when no result that reads them is needed any more.
    """
    for db in spark.catalog.listDatabases("mf_*"):
        if any(db.locationUri.endswith(p.rsplit("/", 1)[1]) for p in _handed_out):
            spark.sql(f"DROP DATABASE {db.name} CASCADE")
    while _handed_out:
        path = spark._jvm.org.apache.hadoop.fs.Path(_handed_out.pop())
        store = path.getFileSystem(spark._jsc.hadoopConfiguration())
        store.delete(path, True)


def ship_module(spark: SparkSession, path: str) -> None:
    """Make a Python file, or a zipped package, importable inside UDFs on every executor."""
    spark.sparkContext.addPyFile(path)


def stored(df: DataFrame, name: str = "stage") -> DataFrame:
    """``df`` written to the shared folder and read back.

    For costly results that several jobs need: the lineage ends at files that outlive executors.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
