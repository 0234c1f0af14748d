"""Session settings and the shared folder that written intermediates go to."""

from __future__ import annotations

import tempfile
import threading
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Settings a Spark user would put in spark-defaults; nothing in the library depends on a value here.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "static",
    "spark.sql.parquet.filterPushdown": "true",
}

# Of what lies for long or is copied whole: a third smaller than the default.
COMPRESSION = "zstd"

_local_dirs: dict[str, str] = {}


def session(app: str = "storelens", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the library's settings; keyword arguments use ``__`` for dots."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as the cluster names it in ``spark.checkpoint.dir``.

    Only a local master may go without the setting; there driver and executors share one disk.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors can reach")
    app = context.applicationId
    if app not in _local_dirs:
        _local_dirs[app] = tempfile.mkdtemp(prefix="storelens-")
        context.setCheckpointDir(_local_dirs[app])
    return _local_dirs[app]


def application_dir(spark: SparkSession) -> str:
    """The part of the shared folder that belongs to this application."""
    return f"{shared_dir(spark)}/storelens/{spark.sparkContext.applicationId}"


_areas = threading.local()


@contextmanager
def staging_area(spark: SparkSession) -> Iterator[None]:
    """What is staged inside goes when the block ends; the block must have written its result by then."""
    areas = _areas.__dict__.setdefault("open", [])
    areas.append(f"{application_dir(spark)}/staged/{uuid.uuid4().hex}")
    try:
        yield
    finally:
        remove_path(spark, areas.pop())


def staged(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    Cuts the lineage, fixes the outcome of nondeterministic columns and survives lost executors. Outside
    a ``staging_area`` the copy stays until the application's folder is cleared.
    """
    spark = df.sparkSession
    areas = _areas.__dict__.get("open")
    folder = areas[-1] if areas else f"{application_dir(spark)}/staged"
    path = f"{folder}/{label}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def path_exists(spark: SparkSession, path: str) -> bool:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()).exists(target)


def remove_path(spark: SparkSession, path: str) -> None:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def path_bytes(spark: SparkSession, path: str) -> int:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()).getContentSummary(target).getLength()
