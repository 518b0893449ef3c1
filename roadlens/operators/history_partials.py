"""History answers kept up to date (F8-F13, F15, F17, G4): mergeable partial aggregates.

A load of history rows is reduced once to one row per (day, route, location) with
counts, sums and maxima; the answers fold the partials of all loads.  A new load
reads its own rows only, and an answer reads rows by the number of days, routes and
locations, not of incidents.  Averages are folded as sums and counts of the
non-null values, so they equal those over the rows.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

VALUES = ("users_total", "users_affected", "duration")


def partials(h: DataFrame) -> DataFrame:
    """One row per (day, route_num, location): count and sum of each value, maximum of the affected users."""
    return h.groupBy(F.to_date("tod").alias("day"), "route_num", "location").agg(
        *[F.count(v).alias(f"n_{v}") for v in VALUES],
        *[F.sum(v).cast("long").alias(f"sum_{v}") for v in VALUES],
        F.max("users_affected").cast("long").alias("max_users_affected"))


def append(h: DataFrame, path: str, load: int) -> None:
    """Add the partials of one load; a repeated load replaces its own."""
    partials(h).write.mode("overwrite").partitionBy("day").parquet(f"{path.rstrip('/')}/load={int(load):012d}")


def read(spark: SparkSession, path: str) -> DataFrame:
    """The partials of all loads; filters on ``day`` prune folders."""
    return spark.read.parquet(path).drop("load")


def _avg(value: str, name: str) -> Column:
    return F.round(F.sum(f"sum_{value}").cast("double") / F.sum(f"n_{value}"), 6).alias(name)


def _avgs() -> list[Column]:
    return [_avg("users_total", "avg_users_total"), _avg("users_affected", "avg_users_affected"), _avg("duration", "avg_duration")]


def _sums() -> list[Column]:
    return [F.sum("sum_users_total").cast("long").alias("sum_users_total"), F.sum("sum_users_affected").cast("long").alias("sum_users_affected")]


def _by(p: DataFrame, *keys: Column) -> Callable:
    return p.groupBy(*keys).agg


def daily(p: DataFrame) -> DataFrame:
    """F8."""
    return _by(p, F.col("day").cast("string").alias("idate"))(*_sums())


def daily_avg(p: DataFrame) -> DataFrame:
    """F9."""
    return _by(p, F.col("day").cast("string").alias("idate"))(*_sums(), _avg("duration", "avg_duration"))


def day_total(p: DataFrame, day: str) -> DataFrame:
    """F10."""
    return p.where(F.col("day") == F.lit(day).cast("date")).agg(*_sums())


def month_avg(p: DataFrame, month: int) -> DataFrame:
    """F11."""
    return p.where(F.month("day") == month).agg(*_avgs())


def by_month(p: DataFrame) -> DataFrame:
    """F12."""
    return _by(p, F.month("day").cast("int").alias("month"))(*_avgs())


def by_ymd(p: DataFrame) -> DataFrame:
    """F13."""
    return _by(p, F.year("day").cast("int").alias("year"), F.month("day").cast("int").alias("month"),
               F.dayofmonth("day").cast("int").alias("day"))(*_avgs())


def by_md(p: DataFrame) -> DataFrame:
    """by the colliding ``month + day`` key."""
    return _by(p, (F.month("day") + F.dayofmonth("day")).cast("int").alias("md"))(*_avgs())


def max_by_location(p: DataFrame, n: int = 10) -> DataFrame:
    """F17."""
    return _by(p, F.col("route_num"), F.col("location"))(F.max("max_users_affected").alias("affected")).orderBy("route_num", "location").limit(n)


def hotspots(p: DataFrame, n: int = 10) -> DataFrame:
    """G4."""
    return _by(p, F.col("route_num"), F.col("location"))(F.sum("sum_users_affected").cast("long").alias("affected")).orderBy(
        F.desc("affected"), "route_num", "location").limit(n)
