"""Sinks (B2, B3, B5, B6, B8, B9).

Folders carry the number of the epoch or load that wrote them and are written
with overwrite, so a replay replaces its own rows; streams that other streams
read use Spark's file sink, whose commit log lists each file once.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources import topic_log


def write_snapshot(df: DataFrame, path: str, epoch: int, fmt: str = "parquet") -> str:
    """B2: write one micro-batch under ``path/epoch=<n>`` (overwrite = idempotent)."""
    out = f"{path.rstrip('/')}/epoch={int(epoch):012d}"
    df.write.mode("overwrite").format(fmt).save(out)
    return out


def snapshot_writer(path: str, transform=None, fmt: str = "parquet"):
    """``foreachBatch`` callback: optional per-batch ``transform(df, epoch)`` then
    ``write_snapshot``."""

    def _write(df: DataFrame, epoch: int) -> None:
        out = transform(df, epoch) if transform else df
        write_snapshot(out, path, epoch, fmt)

    return _write


def append_history(df: DataFrame, path: str, load: int, day_col: str = "tod") -> None:
    """Add one load of history rows, partitioned by day for partition pruning.

    The folder carries the load's number and is written with overwrite, so a
    repeated load replaces its own rows and never adds them twice.
    """
    out = f"{path.rstrip('/')}/load={int(load):012d}"
    df.withColumn("day", F.to_date(day_col)).write.mode("overwrite").partitionBy("day").parquet(out)


def read_history(spark: SparkSession, path: str) -> DataFrame:
    """All loads of a history table; filters on ``day`` prune folders."""
    return spark.read.parquet(path).drop("load")


def history_stream_sink(df: DataFrame, path: str, checkpoint: str, day_col: str = "tod", trigger: dict | None = None):
    """B3 as a stream: file sink (exactly-once via its commit log), by day."""
    w = (
        df.withColumn("day", F.to_date(day_col))
        .writeStream.format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .partitionBy("day")
        .outputMode("append")
    )
    return w.trigger(**(trigger or {"availableNow": True})).start()


def peek(df: DataFrame, n: int = 10, checkpoint: str | None = None, trigger: dict | None = None):
    """Print the first ``n`` rows of every micro-batch (console sink)."""
    w = df.writeStream.format("console").option("numRows", n).option("truncate", "false")
    if checkpoint:
        w = w.option("checkpointLocation", checkpoint)
    return w.trigger(**(trigger or {"availableNow": True})).start()


def publish_events(df: DataFrame, topic: str, key_col: str = "key", sink: str = "files", path: str | None = None,
                   bootstrap: str | None = None) -> None:
    """Publish ``key``/``value`` rows: to Kafka, to a topic log (``sink='log'``, as one
    commit), or as JSON-lines files with one folder per key value.  Every task writes what it holds, so
    the write runs with the parallelism of ``df`` whatever the number of keys."""
    if sink == "kafka":
        (df.select(F.col(key_col).cast("string").alias("key"), F.col("value"))
         .write.format("kafka").option("kafka.bootstrap.servers", bootstrap).option("topic", topic).save())
        return
    if sink == "log":
        topic_log.register(df.sparkSession)
        (df.select(F.col(key_col).cast("string").alias("key"), F.col("value").cast("string").alias("value"))
         .write.format(topic_log.FORMAT).option("path", path).option("topic", topic).mode("append").save())
        return
    df.select("value", key_col).write.mode("append").partitionBy(key_col).text(f"{path.rstrip('/')}/{topic}")


def publish_stream(df: DataFrame, topic: str, path: str, checkpoint: str, writer: str, partitions: int = 8, trigger: dict | None = None):
    """B6 over a stream: each micro-batch is one commit of the topic log; failed, retried
    and replayed batches leave one copy of each message."""
    topic_log.register(df.sparkSession)
    w = (df.select(F.col("key").cast("string").alias("key"), F.col("value").cast("string").alias("value")).writeStream.format(topic_log.FORMAT)
         .option("path", path).option("topic", topic).option("partitions", partitions).option("writer", writer)
         .option("checkpointLocation", checkpoint).outputMode("append"))
    return w.trigger(**(trigger or {"availableNow": True})).start()


def numbered(spark: SparkSession, base: str, prefix: str) -> list[int]:
    """Numbers of the folders ``prefix<number>`` under ``base``, ascending."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(base)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(p):
        return []
    names = [s.getPath().getName() for s in fs.listStatus(p) if s.isDirectory()]
    return sorted(int(n[len(prefix):]) for n in names if n.startswith(prefix) and n[len(prefix):].isdigit())


def reset(spark: SparkSession, base: str) -> str:
    """Start a new, empty state version instead of deleting keys in place.

    Versions are numbered (``v=000000000007``), so the newest is told by name
    on any file system; readers use the newest and a stream restarted on it
    gets a fresh checkpoint next to it.  Returns the new version folder.
    """
    number = max(numbered(spark, base, "v="), default=0) + 1
    version = f"{base.rstrip('/')}/v={number:012d}"
    spark.createDataFrame([], "k string").write.mode("errorifexists").parquet(f"{version}/data")
    return version


def latest_version(spark: SparkSession, base: str) -> str | None:
    """Newest version folder under ``base``, by its number."""
    found = numbered(spark, base, "v=")
    return f"{base.rstrip('/')}/v={found[-1]:012d}" if found else None


def create_view(spark: SparkSession, name: str, df: DataFrame) -> DataFrame:
    """Create-table-as-select scoped to the session (the surveyed CTAS was
    never committed, so it behaved as a transaction-scoped view)."""
    df.createOrReplaceTempView(name)
    return spark.table(name)
