"""Helpers shared by the operators: bounded batches, skewed joins, components."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialise

#: A key is hot when it holds more than one in HOT_KEYS of all rows, so there
#: are fewer than HOT_KEYS hot keys whatever the input: a proven broadcast bound.
HOT_KEYS = 1024

#: Rows handed to Python code at a time (a task holds few texts at once).
SLICE_ROWS = 256

#: White space of all text contracts, as a Java and Python character class.
BLANKS = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"


def slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Cut Arrow batches into short ones, so Python objects stay few."""
    for batch in batches:
        for at in range(0, batch.num_rows, SLICE_ROWS):
            yield batch.slice(at, SLICE_ROWS)


def table(spark, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def id_and_text(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", binary: bool = True) -> DataFrame:
    """(doc_id, text) of ``docs`` alone: extra columns cannot clash with ours."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    return docs.select(
        F.col(id_col).cast("long").alias("doc_id"),
        (text.cast("binary") if binary else text).alias("text"),
    )


def join_counted(left: DataFrame, right: DataFrame, keys: list[str], n: str, total: int) -> DataFrame:
    """Inner join with hot keys kept out of the shuffle.

    ``right`` holds one row per key and, in column ``n``, how many left rows
    carry it; ``total`` is the number of left rows.  Keys above total/HOT_KEYS
    (fewer than HOT_KEYS of them) are broadcast, the others shuffle: no
    shuffled key holds more than one in HOT_KEYS rows.  Keys are not null.
    """
    limit = max(1, total // HOT_KEYS)
    hot = right.where(F.col(n) > limit)
    rest = right.where(F.col(n) <= limit)
    return left.join(F.broadcast(hot), keys).unionByName(
        left.join(F.broadcast(hot.select(*keys)), keys, "left_anti").join(rest, keys)
    )


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """Connected components of undirected ``edges`` over long ids: (node, root).

    Contraction rounds: every node points to its smallest neighbour (or itself),
    edges are renamed to what their ends point to, loops and repeats go, until
    no edge is left.  Each round is a map-side combined aggregate and two joins
    whose hot ids are broadcast (``join_counted``); every round's tables are
    written to the shared folder.  At least every second node of an edge goes
    in two rounds, so rounds grow with the logarithm of the longest component.
    ``root`` is the smallest id of the component; nodes without an edge are absent.
    """
    spark = edges.sparkSession
    left = F.least(F.col(a), F.col(b)).alias("a"), F.greatest(F.col(a), F.col(b)).alias("b")
    # n counts an id on either side, so the sums below are twice the edges: fewer than 2 * HOT_KEYS hot ids
    now = materialise(edges.where(F.col(a) != F.col(b)).select(*left).distinct(), "edges")
    rounds: list[DataFrame] = []
    while total := now.count():
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        to = materialise(
            both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("to"), F.count("*").alias("n")).withColumnRenamed("a", "node"),
            "parents",
        )
        rounds.append(to.select("node", "to", "n"))
        at_a = join_counted(now.withColumnRenamed("a", "node"), to, ["node"], "n", total).select(F.col("to").alias("a"), F.col("b").alias("node"))
        at_b = join_counted(at_a, to, ["node"], "n", total).select(F.col("a"), F.col("to").alias("b"))
        now = materialise(
            at_b.where(F.col("a") != F.col("b")).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(),
            "edges",
        )
    if not rounds:
        return spark.createDataFrame([], "node long, root long")
    # compose the rounds from the last: root(node) = later(to(node))
    later = rounds[-1].select("node", F.col("to").alias("root"))
    for to in reversed(rounds[:-1]):
        pointing = to.select(F.col("node").alias("from_node"), F.col("to").alias("node"))
        indegree = pointing.groupBy("node").agg(F.count("*").alias("n"))
        known = materialise(indegree.join(later, "node", "left").select("node", F.coalesce("root", "node").alias("root"), "n"), "roots")
        later = materialise(
            join_counted(pointing, known, ["node"], "n", to.count()).select(F.col("from_node").alias("node"), "root"), "roots",
        )
    return later


def places(rows: DataFrame, group: list[str], order: list[str], name: str) -> DataFrame:
    """``rows``, written in (group, order) order, with ``pos`` (place in their group
    from 0) and ``n`` (size of the group).  Columns of ``group`` are not null;
    nulls of ``order`` come first; equal rows need a column that parts them.

    Range partitions hold contiguous stretches of each group, and the row id
    counts within a partition: only one row per group and partition is summed
    up across partitions, whatever the size of a group.
    """
    by = [F.col(c).asc_nulls_first() for c in group + order]
    dealt = materialise(
        rows.repartitionByRange(*by).sortWithinPartitions(*by).withColumn("_row", F.monotonically_increasing_id()), name
    ).withColumn("_part", F.shiftright("_row", 33))
    one = Window.partitionBy(*group)
    earlier = one.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    spans = dealt.groupBy(*group, "_part").agg(F.min("_row").alias("_first"), F.count("*").alias("_n")).select(
        *group, "_part", (F.coalesce(F.sum("_n").over(earlier), F.lit(0)) - F.col("_first")).alias("_shift"), F.sum("_n").over(one).alias("n"))
    return dealt.join(spans, group + ["_part"]).withColumn("pos", F.col("_row") + F.col("_shift")).drop("_row", "_part", "_shift")


def unused(df: DataFrame, *names: str) -> list[str]:
    """``names``, lengthened until no column of ``df`` has one of them (in any case)."""
    taken, out = {c.lower() for c in df.columns}, []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out


def first_of_each(df: DataFrame, key: str) -> DataFrame:
    """One row per ``key``, by a hash of the whole row: the same one in every run.  Each task
    keeps one row per key before the shuffle, so a key repeated in most rows is no large group."""
    (place,) = unused(df, "__place")
    whole = F.xxhash64(F.to_json(F.struct(*[F.col(f"`{c}`") for c in df.columns])))
    ranked = df.withColumn(place, F.row_number().over(Window.partitionBy(key).orderBy(whole)))
    return ranked.where(F.col(place) == 1).drop(place)


def lower_ascii(column: Column) -> Column:
    """``column`` with A-Z alone lower-cased (texts without other letters take the fast way)."""
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.when(F.octet_length(column) == F.length(column), F.lower(column)).otherwise(F.translate(column, upper, upper.lower()))


def crc_mod(column: Column, m: int) -> Column:
    return F.crc32(column.cast("string").cast("binary")) % m
