"""G3 live: the number of active users after every register and sign-off.

Two steps.  Per user, messages take effect in event-time order once the
watermark has passed them (``ordered.in_event_order``), so a micro-batch releases
all effective changes between the watermark before and its own, over all
users.  Micro-batches therefore follow one another in time: the gauge inside one is a
running sum in levels (second, hour, day, month), and one carried number, the
active users when the last one closed, is added to all of its rows.

Each micro-batch ``k`` writes ``changes/epoch=k`` (its changes), ``gauge/epoch=k`` (them
with the gauge) and last ``closed/epoch=k``, one row that makes it count.  A writer
that dies in between has written nothing a reader sees, and its replay
overwrites it; a replay of a closed micro-batch does nothing.  An epoch's rows depend only on
its changes and the row of the epoch before.

Messages later than the watermark are dropped by Spark (``ordered.admitted`` keeps
them); rows without user or time take no part.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas as S
from ..operators.scan import global_running_sum
from ..sinks.writers import numbered
from . import ordered as O

GAUGE_SCHEMA = "ts timestamp_ntz, seq bigint, delta int, active_users bigint"
CLOSED_SCHEMA = "changes bigint, active_users bigint"


def transitions_stream(requests: DataFrame, watermark: str) -> DataFrame:
    """Effective registers (+1) and sign-offs (-1) of a stream, as ``effective_transitions`` has them."""
    rs = requests.where(F.col("req_type").isin(S.REQ_REGISTER, S.REQ_SIGNOFF)).select("user_id", "ts", "seq", "req_type")
    return O.in_event_order(rs, "user_id", ["req_type"], watermark, O.transition_step, (False,), O.TRANSITION_SCHEMA, "active boolean")


def _epoch(path: str, kind: str, epoch: int) -> str:
    return f"{path.rstrip('/')}/{kind}/epoch={epoch:012d}"


def _is_closed(spark: SparkSession, path: str, epoch: int) -> bool:
    mark = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{_epoch(path, 'closed', epoch)}/_SUCCESS")
    return mark.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(mark)


def _last(spark: SparkSession, path: str) -> int | None:
    """The last closed epoch."""
    epochs = numbered(spark, f"{path.rstrip('/')}/closed", "epoch=")
    return next((e for e in reversed(epochs) if _is_closed(spark, path, e)), None)


def gauge_writer(path: str):
    """``foreachBatch`` callback: closes micro-batches under ``path``, one after the other."""
    def write(batch: DataFrame, epoch: int) -> None:
        spark = batch.sparkSession
        if _is_closed(spark, path, epoch):
            return
        if epoch and not _is_closed(spark, path, epoch - 1):
            raise RuntimeError(f"micro-batch {epoch - 1} is not closed under {path}: another checkpoint's folder?")
        carried = spark.read.schema(CLOSED_SCHEMA).parquet(_epoch(path, "closed", epoch - 1)).first()["active_users"] if epoch else 0
        batch.write.mode("overwrite").parquet(_epoch(path, "changes", epoch))  # the stream is evaluated once
        changes = spark.read.schema(O.TRANSITION_SCHEMA).parquet(_epoch(path, "changes", epoch))
        n, net = changes.agg(F.count("*"), F.coalesce(F.sum("delta"), F.lit(0))).first()
        if n:
            rows = global_running_sum(changes, "ts", ["seq"], "delta", "active_users", store=False)
            rows = rows.withColumn("active_users", F.col("active_users") + F.lit(carried)).select(*O.names(GAUGE_SCHEMA))
            rows.write.mode("overwrite").parquet(_epoch(path, "gauge", epoch))
        last = spark.createDataFrame([(n, carried + net)], CLOSED_SCHEMA)
        last.coalesce(1).write.mode("overwrite").parquet(_epoch(path, "closed", epoch))

    return write


def active_users_stream(requests: DataFrame, path: str, checkpoint: str, watermark: str, trigger: dict | None = None):
    """Start the gauge over a stream of parsed requests; ``path`` belongs to this ``checkpoint``."""
    w = transitions_stream(requests, watermark).writeStream.outputMode("append").option("checkpointLocation", checkpoint)
    return w.foreachBatch(gauge_writer(path)).trigger(**(trigger or {"availableNow": True})).start()


def read_gauge(spark: SparkSession, path: str) -> DataFrame:
    """(ts, seq, delta, active_users) of all closed micro-batches, as ``active_users_gauge`` gives for a table."""
    last = _last(spark, path)
    if last is None or not numbered(spark, f"{path.rstrip('/')}/gauge", "epoch="):
        return spark.createDataFrame([], GAUGE_SCHEMA)
    rows = spark.read.schema(GAUGE_SCHEMA + ", epoch bigint").parquet(f"{path.rstrip('/')}/gauge")
    return rows.where(F.col("epoch") <= last).drop("epoch")


def active_users_now(spark: SparkSession, path: str) -> int:
    """Active users when the last micro-batch closed: one row is read."""
    last = _last(spark, path)
    return 0 if last is None else spark.read.schema(CLOSED_SCHEMA).parquet(_epoch(path, "closed", last)).first()["active_users"]
