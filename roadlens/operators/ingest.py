"""Ingest and keyed-table operators: CSV loads (A4, A5), keyed upsert (B1),
selections over violations (C4, D6, F18), page-view rollups (F1, G5) and the
distinct word set (F20)."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import schemas as S
from ..functions import text as T
from .scan import ranks

HEADER_FIRST_FIELD = "date of stop"


def parse_csv_pairs(lines: DataFrame, col: str = "value") -> DataFrame:
    """A4: ``text,number`` lines -> (textstr, numero); a bad number gives null."""
    items = F.split(F.col(col), ",", -1)
    return lines.select(
        T.field(items, 0).alias("textstr"), T.field(items, 1).try_cast("int").alias("numero")
    )


def normalise_violations(lines: DataFrame, col: str = "value", skip_header: bool = True) -> DataFrame:
    """A5: lenient 35-column violations CSV -> typed record per line.

    Other columns of ``lines`` are passed through.  With ``skip_header`` the
    header line (first field "Date Of Stop") is dropped.
    """
    keep = [c for c in lines.columns if c != col]
    src = lines
    if skip_header:
        head = F.lower(F.substring(F.col(col), 1, len(HEADER_FIRST_FIELD) + 1))
        src = lines.where(~head.eqNullSafe(F.lit(HEADER_FIRST_FIELD + ",")))
    # split once: neither is the projection over the array collapsed into 35 splits, nor are
    # conditions on its fields moved below the explode, where each would split the line again
    staged = src.select(*keep, F.explode(F.array(T.csv_fields(F.col(col)))).alias("_items"))
    return staged.select(*keep, *T.violation_record(F.col("_items")))


def _all_known(columns: Sequence[str]) -> Column:
    return reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in columns])


def upsert_latest(df: DataFrame, keys: Sequence[str], order_cols: Sequence[str]) -> DataFrame:
    """B1: last write wins per primary key.

    The row with the largest ``order_cols`` of each key stays; of rows that tie in
    all of them one stays.  The input is read once: Spark keeps the first row of each key in
    every task before the shuffle (a group limit below the window), so a hot key
    is one row per task.  Rows with a null among key or order columns are not
    stored; ``upsert_rejects`` returns them.
    """
    keys, order_cols = list(keys), list(order_cols)
    place = "_upsert_place"
    newest = Window.partitionBy(*keys).orderBy(*[F.desc(c) for c in order_cols])
    kept = df.where(_all_known(keys + order_cols)).withColumn(place, F.row_number().over(newest)).where(F.col(place) == 1)
    return kept.select(*keys, *[c for c in df.columns if c not in keys])


def upsert_rejects(df: DataFrame, keys: Sequence[str], order_cols: Sequence[str] = ()) -> DataFrame:
    """B1: the rows ``upsert_latest`` does not store, with the first missing key or order column."""
    needed = [*keys, *order_cols]
    missing = F.coalesce(*[F.when(F.col(c).isNull(), F.lit(c)) for c in needed])
    return df.where(~_all_known(needed)).withColumn("missing_key", missing)


def select_where(df: DataFrame, cols: Sequence[str], cond) -> DataFrame:
    """Projection under a predicate (pushed to the scan by Catalyst)."""
    return df.where(cond).select(*cols)


def avg_where(df: DataFrame, col: str, cond, name: str) -> DataFrame:
    """scalar average under a filter (DOUBLE, 6 places)."""
    return df.where(cond).agg(F.round(F.avg(F.col(col).cast("double")), 6).alias(name))


def pageviews(events: DataFrame, interval: str = "1 hour") -> DataFrame:
    """page views per site per interval; the interval end stamps the row
    (in place of a time-UUID) so re-runs write the same keys."""
    return events.groupBy(F.window("ts", interval).alias("w"), "site_id").agg(
        F.count(F.lit(1)).alias("pageviews")
    ).select("site_id", F.col("w.end").alias("window_end"), "pageviews")


def ranked_within(df: DataFrame, key: str, order: Sequence, n: int | None = None) -> DataFrame:
    """Rank rows inside a key by ``order`` (e.g. page views descending),
    optionally keeping the first ``n``.

    The first ``n`` are cut in every task before the shuffle; all rows are ranked by
    range partitions (``scan.ranks``), so a key with most rows is no single task.
    """
    order = [F.col(o) if isinstance(o, str) else o for o in order]
    if n is None:
        return ranks(df, [key], order, "rank")
    w = Window.partitionBy(key).orderBy(*order)
    return df.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= n)


def write_ordered(df: DataFrame, path: str, partition_col: str, order: Sequence[str]) -> None:
    """G5 as a table: one folder per ``partition_col`` value, rows of each file in
    ``order`` (the clustering order of the surveyed tables).

    The range exchange splits a large value over several files, and the files
    of a value follow each other in ``order``.
    """
    (df.repartitionByRange(partition_col, *order).sortWithinPartitions(partition_col, *order)
     .write.mode("overwrite").partitionBy(partition_col).parquet(path))


def word_keys(lines: DataFrame, col: str = "value") -> DataFrame:
    """``Word:<w>`` = 1 for every word of whole texts."""
    w = lines.select(F.explode(T.words(F.col(col))).alias("word"))
    return w.select(F.concat(F.lit("Word:"), F.col("word")).alias("key"), F.lit(1).alias("value"))


def distinct_words(lines: DataFrame, col: str = "value") -> DataFrame:
    """the keyed word set over whole texts.

    ``distinct`` aggregates partially per task, so a frequent word crosses the
    shuffle once per task, not once per occurrence.
    """
    return word_keys(lines, col).distinct()


VIOLATION_KEY = list(S.VIOLATION_KEY)
