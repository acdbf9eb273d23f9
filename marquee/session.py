"""Session helpers: the shared scratch folder and staged tables."""

from __future__ import annotations

import atexit
import contextlib
import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_local_dirs: dict[str, str] = {}
_scratch: list[str] = []


def local_session(cores: int | str = "*", memory: str = "20g", **conf: str) -> SparkSession:
    """A single-JVM session for tests and benchmarks.

    On a cluster the session comes from spark-submit; README lists the
    settings that matter there.
    """
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("marquee")
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.adaptive.enabled", "true")
    )
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors can reach, as named by ``spark.checkpoint.dir``.

    Only a local session may go without the setting; it then gets a fresh
    temporary folder, since driver and executors are one process there.  A
    ``local-cluster`` has executors of their own and must name a folder.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    master = spark.conf.get("spark.master", "")
    if not re.fullmatch(r"local(\[.*\])?", master):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    app = spark.conf.get("spark.app.id", "local")
    if app not in _local_dirs:
        _local_dirs[app] = tempfile.mkdtemp(prefix="marquee-")
    return _local_dirs[app]


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, unused path below the shared folder."""
    path = f"{shared_dir(spark)}/marquee/{name}-{uuid.uuid4().hex}"
    if not _scratch:
        atexit.register(_drop_at_exit)
    _scratch.append(path)
    return path


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to the shared folder and return a scan of it.

    For a frame that several branches of one plan read: the work behind it
    runs once, lost executors do not bring it back, and unlike a checkpoint
    the scan still prunes columns and takes pushed filters.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path, compression="zstd")
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _drop_at_exit() -> None:
    """Leave nothing behind where the program ends in order and the session still runs."""
    with contextlib.suppress(Exception):
        if (spark := SparkSession.getActiveSession()) is not None:
            drop_scratch(spark)


def drop_scratch(spark: SparkSession) -> int:
    """Delete what this process wrote to scratch paths; returns how many there were.

    Frames that scan staged tables go stale.
    """
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    dropped = 0
    while _scratch:
        path = spark._jvm.org.apache.hadoop.fs.Path(_scratch.pop())
        dropped += path.getFileSystem(conf).delete(path, True)
    return dropped
