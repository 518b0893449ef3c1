"""Mixing sources to target weights, in DataFrame operations only.

Sizes (words) are summed per source; each source has a weight, sources share
the total by weight, no source gets more than ``cap`` times its size, and what
is above is shared again by weight until none is above.  A source's repetition
rate is target / size; a document is emitted floor(rate) times, plus one copy
when a draw from its doc_id falls below the fraction of the rate.

Scale: documents shrink to a row per source before any shuffle (map-side sums,
so a hot source costs one row per task); the shares are solved by a few
aggregates over the source table, of which the driver sees three sums; rates
come back through ``join_counted``, hot sources broadcast and the others
shuffled.

Defined results: a null source is a source of its own, last in order; null
text has size 0; a source without words has target and rate 0; rows with the
same doc_id draw alike (null ids too), so reruns agree; an empty table gives
an empty result; extra columns pass through untouched.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialise
from .common import WORD, join_counted, unused

WEIGHTS = (1, 2, 3)
CAP = 3
SEED = "mix"
_UNIT = float(1 << 52)


def words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def ranked_sources(sources: DataFrame) -> DataFrame:
    """``sources`` with ``rank``: 0, 1, ... by (is_null, source), without a
    window over all of them: range parts are ranked and offset by the parts before."""
    parts = max(1, int(sources.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    placed = materialise(sources.repartitionByRange(parts, "is_null", "source").withColumn("part", F.spark_partition_id()), "sources")
    before, offsets = 0, []
    for row in placed.groupBy("part").count().orderBy("part").collect():  # one row per range part
        offsets.append((row["part"], before))
        before += row["count"]
    if not offsets:
        return placed.withColumn("rank", F.lit(0).cast("long")).drop("part")
    known = sources.sparkSession.createDataFrame(offsets, "part int, before long")
    local = F.row_number().over(Window.partitionBy("part").orderBy("is_null", "source"))
    return placed.withColumn("local", local).join(F.broadcast(known), "part").withColumn("rank", F.col("before") + F.col("local") - 1).drop("part", "local", "before")


def source_targets(sized: DataFrame, weights=WEIGHTS, cap: int = CAP) -> DataFrame:
    """One row per source of ``sized`` (is_null, source, size): source_size,
    n (documents), target, rate."""
    sums = sized.groupBy("is_null", "source").agg(F.sum("size").alias("source_size"), F.count("*").alias("n"))
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), (F.col("rank") % len(weights)).cast("int") + 1)
    shares = materialise(ranked_sources(sums).withColumn("weight", weight), "shares")
    all_size, all_weight = shares.agg(F.sum("source_size"), F.sum("weight")).first()
    level, capped = (all_size / all_weight if all_weight else 0.0), -1
    while all_weight:
        above = cap * F.col("source_size") < F.lit(level) * F.col("weight")
        count, size, weight_sum = shares.where(above).agg(F.count("*"), F.sum(cap * F.col("source_size")), F.sum("weight")).first()
        if count == capped:
            break
        capped = count
        if count:
            level = (all_size - size) / (all_weight - weight_sum)
    target = F.least((cap * F.col("source_size")).cast("double"), F.lit(level) * F.col("weight"))
    return shares.withColumn("target", target).withColumn(
        "rate", F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0))


def copies(doc_id: Column, rate: Column, seed: str = SEED) -> Column:
    """floor(rate), plus one when the draw of this doc_id is below the fraction."""
    key = F.concat(F.lit(seed + ":"), F.coalesce(doc_id.cast("string"), F.lit("")))
    draw = F.conv(F.substring(F.md5(key), 1, 13), 16, 10).cast("double") / F.lit(_UNIT)
    return (F.floor(rate) + F.when(draw < rate - F.floor(rate), 1).otherwise(0)).cast("long")


def _keyed(docs: DataFrame, source_col: str) -> list[Column]:
    source = F.col(source_col).cast("string")
    return [source.isNull().alias("is_null"), F.coalesce(source, F.lit("")).alias("source")]


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", weights=WEIGHTS, cap: int = CAP, seed: str = SEED) -> DataFrame:
    """One row per document: doc_id, size, source_size, target, copies, taken."""
    sized = materialise(docs.select(F.col(id_col).alias("doc_id"), words(F.col(text_col)).alias("size"), *_keyed(docs, source_col)), "sized")
    targets = materialise(source_targets(sized.select("is_null", "source", "size"), weights, cap), "targets")
    total = targets.agg(F.sum("n")).first()[0] or 0
    n_copies = copies(F.col("doc_id"), F.col("rate"), seed)
    return join_counted(sized, targets, ["is_null", "source"], "n", total).select(
        "doc_id", "size", "source_size", "target", n_copies.alias("copies"), (F.col("size") * n_copies).alias("taken"))


def emit(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", weights=WEIGHTS, cap: int = CAP, seed: str = SEED) -> DataFrame:
    """``docs`` with every row repeated as the mix takes it, all columns as they came."""
    sized = docs.select(words(F.col(text_col)).alias("size"), *_keyed(docs, source_col))
    targets = materialise(source_targets(sized, weights, cap), "targets")
    total = targets.agg(F.sum("n")).first()[0] or 0
    is_null, source, rate, n, times, copy = unused(docs, "__mix_null", "__mix_source", "__mix_rate", "__mix_n", "__mix_copies", "__mix_copy")
    marked = docs.withColumns(dict(zip((is_null, source), _keyed(docs, source_col))))
    rates = targets.select(F.col("is_null").alias(is_null), F.col("source").alias(source), F.col("rate").alias(rate), F.col("n").alias(n))
    joined = join_counted(marked, rates, [is_null, source], n, total)
    taken = joined.withColumn(times, copies(F.col(id_col), F.col(rate), seed)).where(F.col(times) > 0)
    return taken.withColumn(copy, F.explode(F.sequence(F.lit(1).cast("long"), times))).select(*[F.col(f"`{c}`") for c in docs.columns])


SQL = r"""
WITH d AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size FROM documents
), s AS (
  SELECT source, sum(size)::BIGINT AS source_size,
         1 + (row_number() OVER (ORDER BY (source IS NULL), source) - 1) % 3 AS weight
  FROM d GROUP BY source
), o AS (
  SELECT *, sum(source_size) OVER () AS t, sum(weight) OVER () AS w,
         coalesce(sum(3 * source_size) OVER p, 0) AS c, coalesce(sum(weight) OVER p, 0) AS cw,
         count(*) OVER p AS before
  FROM s WINDOW p AS (ORDER BY 3.0 * source_size / weight, source_size, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), l AS (
  SELECT arg_min((t - c)::DOUBLE / (w - cw)::DOUBLE, before) AS level FROM o
  WHERE 3 * source_size >= ((t - c)::DOUBLE / (w - cw)::DOUBLE) * weight
), r AS (
  SELECT source, source_size, least((3 * source_size)::DOUBLE, level * weight) AS target FROM s, l
), m AS (
  SELECT d.doc_id, d.size, r.source_size, r.target,
         CASE WHEN r.source_size > 0 THEN r.target / r.source_size ELSE 0 END AS rate,
         ('0x' || substr(md5('mix:' || coalesce(d.doc_id::VARCHAR, '')), 1, 13))::BIGINT / 4503599627370496 AS draw
  FROM d JOIN r ON d.source IS NOT DISTINCT FROM r.source
)
SELECT doc_id, size, source_size, target,
       (size * (floor(rate) + CASE WHEN draw < rate - floor(rate) THEN 1 ELSE 0 END))::BIGINT AS taken
FROM m
"""
