"""Stream and file sources.

Brokered topics are read with the Kafka source when its package is on the
classpath; the same functions read JSON-lines / text / parquet folders, which
is what tests use (no Kafka jar ships here).  Consumer-group offsets of the
surveyed receiver streams become the query's checkpoint.  A topic log in files
(``topic_log``) has partitions, offsets and groups without a broker.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..operators.messages import parse_json
from . import topic_log

CHUNK_LOG_SCHEMA = (
    "route_num int, batch timestamp_ntz, fi struct<ts:timestamp_ntz,seq:bigint,loc:int>, "
    "fc struct<ts:timestamp_ntz,seq:bigint,duration:int>, fic struct<ts:timestamp_ntz,seq:bigint,loc:int>, "
    "n_pos bigint, hist array<struct<loc:int,n:bigint>>"
)
MESSAGE_LOG_SCHEMA = (
    "batch timestamp_ntz, rnk int, route_num int, msg_type int, ts timestamp_ntz, seq bigint, "
    "loc int, duration int, n_positions bigint, loc_hist array<struct<loc:int,n:bigint>>"
)


def read_events(
    spark: SparkSession,
    topic: str,
    schema: StructType,
    source: str = "files",
    path: str | None = None,
    bootstrap: str | None = None,
    max_per_trigger: int | None = None,
    group: str | None = None,
) -> DataFrame:
    """A1/A2: a topic of JSON messages as a parsed streaming DataFrame.

    ``source='kafka'`` subscribes to ``topic`` (``seq`` = partition/offset
    order); ``source='log'`` reads the topic log under ``path`` (``topic_log``) with the
    same ``seq``, ``max_per_trigger`` commits at a time; ``source='files'`` reads JSON lines under ``path/topic``.  Files carry
    no offsets: unless the messages have a ``seq`` field of their own, ``seq``
    is a hash of the message, which orders messages of the same second the
    same way whatever file, batch or replay brings them.
    Malformed messages give null fields and ``_malformed`` = true; ``_raw`` is
    the message text.
    """
    if source == "kafka":
        reader = (
            spark.readStream.format("kafka")
            .option("kafka.bootstrap.servers", bootstrap)
            .option("subscribe", topic)
            .option("startingOffsets", "earliest")
        )
        if max_per_trigger:
            reader = reader.option("maxOffsetsPerTrigger", max_per_trigger)
        raw = reader.load()
        lines = raw.select(
            F.col("value").cast("string").alias("value"),
            (F.col("partition").cast("long") * F.lit(1 << 40) + F.col("offset")).alias("seq"),
        )
    elif source == "log":
        topic_log.register(spark)
        reader = spark.readStream.format(topic_log.FORMAT).option("path", path).option("topic", topic)
        if max_per_trigger:
            reader = reader.option("maxCommitsPerTrigger", max_per_trigger)
        if group:
            reader = reader.option("group", group)
        lines = reader.load().select("value", (F.col("partition").cast("long") * F.lit(1 << 40) + F.col("offset")).alias("seq"))
    else:
        reader = spark.readStream.format("text")
        if max_per_trigger:
            reader = reader.option("maxFilesPerTrigger", max_per_trigger)
        lines = reader.load(f"{path.rstrip('/')}/{topic}")
        if "seq" not in schema.fieldNames():
            lines = lines.withColumn("seq", F.xxhash64("value"))
    return parse_json(lines, schema, keep_raw=True)


def read_lines(spark: SparkSession, path: str, max_files: int | None = None) -> DataFrame:
    """A3: a stream of text lines (``value``).  The socket source is for tests
    in Spark itself, so folders (or a broker) carry lines here."""
    reader = spark.readStream.format("text")
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.load(path)


def read_chunks(spark: SparkSession, path: str, max_files: int | None = None) -> DataFrame:
    """Drain the chunk log of the incident stream, oldest files first.

    The log is written by Spark's file sink, whose commit list is honoured
    here: files of a failed or repeated epoch are not read.  A file holds whole
    chunks and all chunks of its routes of one epoch, so any number of files
    per trigger gives the same result.
    """
    reader = spark.readStream.schema(CHUNK_LOG_SCHEMA).option("latestFirst", "false")
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.parquet(path)


def read_csv_pairs(spark: SparkSession, path: str) -> DataFrame:
    """A4: ``text,number`` lines from storage -> (textstr, numero)."""
    from ..operators.ingest import parse_csv_pairs

    return parse_csv_pairs(spark.read.text(path))


def read_violations(spark: SparkSession, path: str, skip_header: bool = True) -> DataFrame:
    """A5 from storage: the lenient violations CSV, one typed row per line."""
    from ..operators.ingest import normalise_violations

    return normalise_violations(spark.read.text(path), skip_header=skip_header)


def scan(spark: SparkSession, path_or_table: str) -> DataFrame:
    """Full table scan (a catalog table name or a parquet path)."""
    if "/" in path_or_table:
        return spark.read.parquet(path_or_table)
    return spark.table(path_or_table)
