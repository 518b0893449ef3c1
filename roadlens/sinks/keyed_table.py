"""A keyed table in files: deltas, hash buckets and a manifest that is written last.

Under the table's folder:

* ``epoch=<n>``    the rows of one write (the latest per key), added by ``write_delta``;
* ``data/v=<n>``   buckets of rows, one row per key, made by ``compact``;
* ``manifest=<n>`` which version holds each bucket, all deltas up to ``n`` folded in;
* ``rejects/epoch=<n>`` the rows of a write that cannot be stored, with the reason.

A folder counts once Spark has marked it complete (``_SUCCESS``), and data
counts only if the newest complete manifest names it.  A writer that dies at any
point therefore leaves the table as it was: an unfinished delta, version or
manifest is not read, blocks nobody, and is replaced by the next try.  ``compact``
reads and rewrites only the buckets that the new deltas touch.  One writer at a
time (a stream, or a scheduled job); any number of readers.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import ingest as I
from .writers import numbered, write_snapshot

BUCKETS = 64
_BUCKET = "_bucket"


def complete(spark: SparkSession, base: str, prefix: str) -> list[int]:
    """Numbers of the folders ``prefix<number>`` under ``base`` that Spark has finished, ascending."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()

    def done(n: int) -> bool:
        mark = jvm.org.apache.hadoop.fs.Path(f"{base}/{prefix}{n:012d}/_SUCCESS")
        return mark.getFileSystem(conf).exists(mark)

    return [n for n in numbered(spark, base, prefix) if done(n)]


def _bucket_of(keys: Sequence[str], buckets: int) -> Column:
    return F.pmod(F.hash(*keys), F.lit(buckets))


class Manifest:
    """The newest complete manifest: ``folded`` (last delta in it) and a version per bucket."""

    def __init__(self, spark: SparkSession, base: str, buckets: int = BUCKETS):
        found = complete(spark, base, "manifest=")
        self.folded = found[-1] if found else -1
        # one row per bucket: bounded by the table's number of buckets
        rows = spark.read.parquet(f"{base}/manifest={self.folded:012d}").collect() if found else []
        self.buckets = rows[0]["buckets"] if rows else buckets
        self.versions = {r["bucket"]: r["version"] for r in rows}

    def folders(self, base: str, buckets=None) -> list[str]:
        return [f"{base}/data/v={v:012d}/{_BUCKET}={b}" for b, v in sorted(self.versions.items()) if buckets is None or b in buckets]


def write_delta(df: DataFrame, keys: Sequence[str], order_cols: Sequence[str], path: str, epoch: int) -> None:
    """Add one write: the latest row per key, and the rows that have no key or no order.
    A repeated ``epoch`` replaces its own rows."""
    base = path.rstrip("/")
    df = df.persist()  # read twice: rows and rejects
    try:
        write_snapshot(I.upsert_rejects(df, keys, order_cols), f"{base}/rejects", epoch)
        write_snapshot(I.upsert_latest(df, keys, order_cols), base, epoch)
    finally:
        df.unpersist()


def _deltas(spark: SparkSession, base: str, after: int) -> list[int]:
    return [n for n in complete(spark, base, "epoch=") if n > after]


def read(spark: SparkSession, path: str, keys: Sequence[str], order_cols: Sequence[str]) -> DataFrame:
    """The table now: the buckets of the newest manifest and the complete deltas after it, merged."""
    base = path.rstrip("/")
    m = Manifest(spark, base)
    folders = m.folders(base) + [f"{base}/epoch={n:012d}" for n in _deltas(spark, base, m.folded)]
    if not folders:
        raise ValueError(f"nothing has been written to {path}")
    return I.upsert_latest(spark.read.parquet(*folders), keys, order_cols)


def candidates(rows: DataFrame, path: str, keys: Sequence[str], before: int) -> DataFrame | None:
    """Stored rows among which the keys of ``rows`` can be: the buckets those fall into and the
    deltas not folded yet, numbered below ``before``.  None where there are none.  A key may come twice."""
    spark, base = rows.sparkSession, path.rstrip("/")
    m = Manifest(spark, base)
    folders = [f"{base}/epoch={n:012d}" for n in _deltas(spark, base, m.folded) if n < before]
    if m.versions:
        touched = {r[0] for r in rows.select(_bucket_of(keys, m.buckets)).distinct().collect()}  # at most ``buckets`` rows
        folders += m.folders(base, touched)
    return spark.read.parquet(*folders) if folders else None


def compact(spark: SparkSession, path: str, keys: Sequence[str], order_cols: Sequence[str], buckets: int = BUCKETS) -> str:
    """Fold the deltas after the newest manifest into the buckets they touch, then write the
    manifest that names them.  Returns the folder of the newest version."""
    base = path.rstrip("/")
    m = Manifest(spark, base, buckets)
    deltas = _deltas(spark, base, m.folded)
    if not deltas:
        return f"{base}/data/v={max(m.versions.values(), default=0):012d}"
    last = deltas[-1]
    out = f"{base}/data/v={last:012d}"
    rows = spark.read.parquet(*[f"{base}/epoch={n:012d}" for n in deltas])
    bucket = _bucket_of(keys, m.buckets)
    touched = {r[0] for r in rows.select(bucket.alias(_BUCKET)).distinct().collect()}  # at most ``buckets`` rows
    if held := m.folders(base, touched):
        rows = rows.unionByName(spark.read.parquet(*held))
    merged = I.upsert_latest(rows, keys, order_cols).withColumn(_BUCKET, bucket)
    merged.write.mode("overwrite").partitionBy(_BUCKET).parquet(out)
    versions = {**m.versions, **{b: last for b in touched}}
    listed = spark.createDataFrame([(b, v, m.buckets) for b, v in sorted(versions.items())], "bucket int, version long, buckets int")
    listed.coalesce(1).write.mode("overwrite").parquet(f"{base}/manifest={last:012d}")
    return out


def vacuum(spark: SparkSession, path: str, keep: int = 2) -> int:
    """Delete versions that none of the ``keep`` newest manifests names, the deltas they have all
    folded in and older manifests; readers of those manifests are not disturbed.  Returns how many folders."""
    base = path.rstrip("/")
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    kept = complete(spark, base, "manifest=")[-keep:]
    if not kept:
        return 0
    used = {r["version"] for n in kept for r in spark.read.parquet(f"{base}/manifest={n:012d}").select("version").distinct().collect()}
    old = [f"{base}/manifest={n:012d}" for n in numbered(spark, base, "manifest=") if n < kept[0]]
    old += [f"{base}/epoch={n:012d}" for n in numbered(spark, base, "epoch=") if n <= kept[0]]
    old += [f"{base}/data/v={n:012d}" for n in numbered(spark, f"{base}/data", "v=") if n < kept[-1] and n not in used]
    for folder in old:
        p = jvm.org.apache.hadoop.fs.Path(folder)
        p.getFileSystem(conf).delete(p, True)
    return len(old)
