"""Session settings and the shared folder."""

from __future__ import annotations

import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import SparkSession

ROCKSDB_PROVIDER = (
    "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
)

_local_roots: dict[str, str] = {}


def build_session(app_name: str = "skyledger", master: str | None = None, **conf) -> SparkSession:
    """A session with adaptive execution and a UTC clock; ``conf`` keys use ``__`` for dots."""
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), str(value))
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by ``spark.checkpoint.dir``.

    Only a local master, where driver and executors share one disk, may go
    without the setting; it then gets one temporary folder per application.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    if context.applicationId not in _local_roots:
        _local_roots[context.applicationId] = tempfile.mkdtemp(prefix="skyledger-")
    return _local_roots[context.applicationId]


def new_dir(spark: SparkSession, label: str) -> str:
    """A path in the shared folder that no other run uses."""
    return f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"


def path_exists(spark: SparkSession, path: str) -> bool:
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark._jsc.hadoopConfiguration()).exists(folder)


def path_size(spark: SparkSession, path: str) -> int:
    """The bytes of a file, or of all files in a folder."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark._jsc.hadoopConfiguration()).getContentSummary(folder).getLength()


@contextmanager
def scratch_dir(spark: SparkSession, label: str):
    """A ``new_dir`` that is deleted when the block ends, also by an error."""
    path = new_dir(spark, label)
    try:
        yield path
    finally:
        folder = spark._jvm.org.apache.hadoop.fs.Path(path)
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


@contextmanager
def session_conf(spark: SparkSession, **conf):
    """Settings that hold only while the block runs; a streaming query keeps those it started with."""
    wanted = {key.replace("__", "."): str(value) for key, value in conf.items()}
    before = {key: spark.conf.get(key, None) for key in wanted}
    try:
        for key, value in wanted.items():
            spark.conf.set(key, value)
        yield spark
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)
