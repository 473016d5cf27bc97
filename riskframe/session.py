"""Session settings and the shared scratch folder."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

CHECKPOINT_SETTING = "spark.checkpoint.dir"
METHOD_SETTING = "spark.sql.codegen.hugeMethodLimit"
#: Methods of more bytes than this the JVM interprets and never compiles; Spark's own limit is eight times as high.
COMPILED_METHOD = 8000


def build_session(app_name: str = "riskframe", master: str | None = None, **settings: str) -> SparkSession:
    """A session with the settings the library's results assume (UTC, AQE on).

    ``settings`` are Spark settings with dots written as double underscores,
    e.g. ``spark__sql__shuffle__partitions="8"``.
    """
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")  # no call-site capture per column
    )
    if master:
        builder = builder.master(master)
    for key, value in settings.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def _is_local(spark: SparkSession) -> bool:
    master = spark.conf.get("spark.master", "")
    return master == "local" or master.startswith("local[")


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by ``spark.checkpoint.dir``.

    Only a local session (one machine, e.g. a benchmark) may leave the setting
    out; it then gets a temporary folder that goes when the program ends. On a
    cluster, a local one of several processes included, the missing setting is an
    error, because a machine-local folder would lose data.
    """
    folder = spark.conf.get(CHECKPOINT_SETTING, None)
    if folder:
        return folder.rstrip("/")
    if not _is_local(spark):
        raise RuntimeError(f"set {CHECKPOINT_SETTING} to a folder shared by the cluster")
    folder = tempfile.mkdtemp(prefix="riskframe-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    spark.conf.set(CHECKPOINT_SETTING, folder)
    return folder


_made: list[str] = []


def scratch_path(spark: SparkSession, label: str) -> str:
    """A path nobody used before, inside the shared folder."""
    path = f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"
    _made.append(path)
    return path


@contextmanager
def scratch_tables(spark: SparkSession) -> Iterator[None]:
    """Owns the tables that are stored inside the block and deletes them at its end.

    Results that still read them must be written or collected inside the block, because they are lazy.
    """
    before = len(_made)
    try:
        yield
    finally:
        hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
        while len(_made) > before:
            path = hadoop.Path(_made.pop())
            path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


@contextmanager
def compiled_methods(spark: SparkSession) -> Iterator[None]:
    """What runs inside the block over very many columns is generated in methods that the JVM compiles.

    Results do not change. What is still lazy at the end of the block runs with the session's own setting.
    """
    before = spark.conf.get(METHOD_SETTING)
    spark.conf.set(METHOD_SETTING, str(min(int(before), COMPILED_METHOD)))
    try:
        yield
    finally:
        spark.conf.set(METHOD_SETTING, before)


def shuffle_parallelism(spark: SparkSession, low: int = 8) -> int:
    """How many slices a value range is cut into; follows the session's shuffle width."""
    return max(low, int(spark.conf.get("spark.sql.shuffle.partitions")))
