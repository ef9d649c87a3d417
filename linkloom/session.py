"""Session settings and the shared folder for intermediate tables."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

_LOCAL_DIRS: dict[str, str] = {}
#: Folder below the application's own that intermediate tables go to just now.
_SCRATCH: ContextVar[str] = ContextVar("scratch", default="")


def pin_settings(spark: SparkSession) -> SparkSession:
    """Runtime settings the operators rely on; cluster sizing is left alone."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.conf.set("spark.sql.adaptive.enabled", "true")
    spark.conf.set("spark.sql.adaptive.skewJoin.enabled", "true")
    # Split a hot join key even where the next operator then needs a shuffle.
    spark.conf.set("spark.sql.adaptive.forceOptimizeSkewedJoin", "true")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach: the session's checkpoint directory.

    A temporary folder is used only when nothing is configured and the master
    is local, as in tests.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    app = spark.sparkContext.applicationId
    if app not in _LOCAL_DIRS:
        _LOCAL_DIRS[app] = "file://" + tempfile.mkdtemp(prefix="linkloom-")
    return _LOCAL_DIRS[app]


def spread(df: DataFrame, *columns: str) -> DataFrame:
    """Deal few small rows, each about to become many, over all tasks.

    The number is given, as the adaptive planner would merge such small partitions again.
    """
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), *columns)


def _run_dir(spark: SparkSession) -> str:
    return f"{shared_dir(spark)}/linkloom-{spark.sparkContext.applicationId}"


def new_path(spark: SparkSession, label: str) -> str:
    """A path in this application's part of the shared folder, never used before."""
    return f"{_run_dir(spark)}{_SCRATCH.get()}/{label}-{uuid.uuid4().hex}"


def _place(spark: SparkSession, path: str) -> tuple:
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), place


def delete(spark: SparkSession, path: str) -> None:
    """Delete a folder, wherever it is stored; none is fine."""
    files, place = _place(spark, path)
    files.delete(place, True)


def folders(spark: SparkSession, path: str) -> list[str]:
    """Names of what lies in a folder; none there is an empty one."""
    files, place = _place(spark, path)
    return [f.getPath().getName() for f in files.listStatus(place)] if files.exists(place) else []


def move(spark: SparkSession, source: str, target: str) -> None:
    """Rename a folder; the target appears with all its files at once where the store can do that."""
    files, place = _place(spark, target)
    files.mkdirs(place.getParent())
    if not files.rename(_place(spark, source)[1], place):
        raise OSError(f"could not move {source} to {target}")


def release(spark: SparkSession) -> None:
    """Delete this application's intermediate tables once their results are saved."""
    delete(spark, _run_dir(spark))


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Intermediate tables written inside are deleted at the end, however it ends.

    What is computed from them has to be saved, or shown, inside.
    """
    inner = f"{_SCRATCH.get()}/scratch-{uuid.uuid4().hex}"
    token = _SCRATCH.set(inner)
    try:
        yield
    finally:
        _SCRATCH.reset(token)
        delete(spark, f"{_run_dir(spark)}{inner}")


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read it back.

    This cuts the lineage without depending on executor-local blocks, and the
    file sizes give the planner a checked size for its broadcast decisions.
    """
    spark = df.sparkSession
    path = new_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
