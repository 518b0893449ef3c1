"""F20 live: the distinct words of a stream, kept in a keyed table instead of state.

``queries.distinct_words_stream`` remembers every word in one state store, which
grows for as long as new words come.  Here no operator keeps state: a micro-batch is
reduced to its distinct words, those are looked up in the buckets of the table they
fall into (and in the deltas not yet folded), and only words never seen before are added,
with the micro-batch that saw them first.  Every ``compact_every`` micro-batches the deltas
are folded into the buckets they touch, so folders to read stay few.

A replayed micro-batch looks at earlier ones alone and so writes the same rows again.
One writer, any number of readers (``sinks.keyed_table``).  Null texts hold no words;
the empty word counts, as in ``ingest.distinct_words``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import ingest as I
from ..sinks import keyed_table as KT

KEYS, ORDER = ["key"], ["first_epoch"]
COMPACT_EVERY = 32


def add_words(lines: DataFrame, path: str, epoch: int, col: str = "value") -> None:
    """Add the words of micro-batch ``epoch`` that no earlier one has."""
    words = I.distinct_words(lines, col).persist()  # read twice: touched buckets and the look-up
    try:
        known = KT.candidates(words, path, KEYS, before=epoch)
        new = words if known is None else words.join(known.select(*KEYS), KEYS, "left_anti")
        KT.write_delta(new.withColumn("first_epoch", F.lit(epoch).cast("long")), KEYS, ORDER, path, epoch)
    finally:
        words.unpersist()


def vocabulary_stream(lines: DataFrame, path: str, checkpoint: str, trigger: dict | None = None,
                      compact_every: int = COMPACT_EVERY, buckets: int = KT.BUCKETS):
    """Keep the vocabulary of ``lines`` (column ``value``) under ``path`` up to date."""

    def _write(batch: DataFrame, epoch: int) -> None:
        add_words(batch, path, epoch)
        if epoch % compact_every == compact_every - 1:
            KT.compact(batch.sparkSession, path, KEYS, ORDER, buckets)

    w = lines.writeStream.foreachBatch(_write).option("checkpointLocation", checkpoint)
    return w.trigger(**(trigger or {"availableNow": True})).start()


def read_vocabulary(spark: SparkSession, path: str) -> DataFrame:
    """(key, value, first_epoch): every word seen so far and the micro-batch that saw it first."""
    return KT.read(spark, path, KEYS, ORDER).select("key", "value", "first_epoch")


def sightings_since(spark: SparkSession, path: str, epoch: int) -> DataFrame:
    """The words first seen in micro-batch ``epoch`` or later."""
    return read_vocabulary(spark, path).where(F.col("first_epoch") >= epoch)
