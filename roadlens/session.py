"""Session helpers.

Library code never creates its own session; it takes the caller's.  The
helpers here only fill in settings that are unset (tests, bench), and read the
shared checkpoint folder from ``spark.checkpoint.dir`` when a cluster names one.
"""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import AbstractContextManager, contextmanager

from pyspark.sql import DataFrame, SparkSession

# Settings applied to sessions we build ourselves (tests, bench).  On a cluster
# these come from the submit configuration instead.
LOCAL_DEFAULTS = {
    "spark.ui.enabled": "false",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.shuffle.partitions": "8",
}


def _driver_memory() -> str:
    """60% of the machine's memory, at most 16g (local mode: driver = executor)."""
    try:
        with open("/proc/meminfo") as fh:
            kb = next(int(line.split()[1]) for line in fh if line.startswith("MemTotal:"))
        return f"{max(1, min(16, int(kb * 0.6 / 1024 / 1024)))}g"
    except (OSError, StopIteration, ValueError):
        return "4g"


def local_session(cores: int | str = "*", app: str = "roadlens", **extra: str) -> SparkSession:
    builder = SparkSession.builder.master(f"local[{cores}]").appName(app)
    for k, v in {**LOCAL_DEFAULTS, "spark.driver.memory": _driver_memory(), **extra}.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder, setting a scratch one only for local masters.

    On a cluster ``spark.checkpoint.dir`` names a shared (HDFS/S3/...) folder and
    is used as is; a cluster session without one is an error, since a folder of
    one machine cannot be read by the others.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if current:
        if not sc.getCheckpointDir():
            sc.setCheckpointDir(current)
        return current
    if not re.match(r"local(\[|$)", sc.master):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    sc.setCheckpointDir(tempfile.mkdtemp(prefix="roadlens-ckpt-"))
    return sc.getCheckpointDir()


def materialise(df: DataFrame, name: str, compression: str | None = None, by: str | None = None) -> DataFrame:
    """Write ``df`` once as Parquet in the shared folder and read it back.

    Cuts the lineage like a reliable checkpoint (the copy survives lost
    executors), and gives later joins the measured size and column pruning.
    ``compression`` names another codec than the session's, ``by`` a column
    whose values get a folder each.
    """
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/tables/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path, compression=compression, partitionBy=by)
    _written.append(path)
    return spark.read.schema(df.schema).parquet(path)


_written: list[str] = []


def release(df: DataFrame, part: str = "") -> None:
    """Delete the folders that ``df`` reads and ``materialise`` wrote in this process, once
    nothing else reads them; ``part`` (column=value): the folder of this value of ``by`` alone."""
    spark = df.sparkSession
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    names = {path.rsplit("/", 1)[1] for path in _written}
    for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        if names.intersection(folder.split("/")) and folder.endswith(f"/{part}" if part else ""):
            path = jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(conf).delete(path, True)


@contextmanager
def _held(spark: SparkSession, key: str, value: str) -> Iterator[None]:
    before = spark.conf.get(key, None)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        spark.conf.set(key, before) if before is not None else spark.conf.unset(key)


def shuffles_dropped(spark: SparkSession) -> AbstractContextManager[None]:
    """Inside, the shuffle files of a write go as soon as it has ended, not when the
    driver collects its garbage."""
    return _held(spark, "spark.sql.classic.shuffleDependency.fileCleanup.enabled", "true")


def arrow_batches(spark: SparkSession, most: int) -> AbstractContextManager[None]:
    """Inside, a write hands Python code batches of about ``most`` bytes (Spark's own limit is 64 MB)."""
    return _held(spark, "spark.sql.execution.arrow.maxBytesPerBatch", str(most))


def release_tables(spark: SparkSession) -> int:
    """Delete the folders ``materialise`` wrote in this process, once no result that
    reads them is needed any more; returns how many."""
    jvm, conf, n = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration(), len(_written)
    while _written:
        path = jvm.org.apache.hadoop.fs.Path(_written.pop())
        path.getFileSystem(conf).delete(path, True)
    return n
