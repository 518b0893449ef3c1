"""History questions over ``hist_traffic``.

All are declarative DataFrame plans: Catalyst prunes columns down to the
parquet scan and aggregates partially before the shuffle.  Averages of integer
columns are returned as DOUBLE rounded to 6 places.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .messages import text_of_ntz

AVG_SCALE = 6


def _avg(c: str, name: str) -> Column:
    return F.round(F.avg(F.col(c).cast("double")), AVG_SCALE).alias(name)


def _avgs() -> list[Column]:
    return [
        _avg("users_total", "avg_users_total"),
        _avg("users_affected", "avg_users_affected"),
        _avg("duration", "avg_duration"),
    ]


def _text() -> Column:
    """``yyyy-MM-dd HH:mm:ss`` of TIMESTAMP_NTZ, without the session zone."""
    return text_of_ntz("tod")


def _odd_time() -> Column:
    """Twelve-hour clock, month and seconds, as the surveyed pattern writes them."""
    hour = F.lpad(((F.hour("tod") + 11) % 12 + 1).cast("string"), 2, "0")
    return F.concat_ws(":", hour, F.substring(_text(), 6, 2), F.substring(_text(), 18, 2))


def day_time(h: DataFrame) -> DataFrame:
    """``idate`` and ``itime`` as text.

    ``itime`` keeps the surveyed pattern HH:MM:SS, where MM is the *month* and
    HH the 12-hour clock (parity); ``itime24`` is the real time of day.
    """
    return h.select(
        F.substring(_text(), 1, 10).alias("idate"),
        _odd_time().alias("itime"),
        F.substring(_text(), 12, 8).alias("itime24"),
        "route_num", "location", "users_total", "users_affected", "duration",
    )


def hist_text(h: DataFrame) -> DataFrame:
    """The full timestamp as text with the same parity pattern."""
    return h.select(
        F.concat_ws(" ", F.substring(_text(), 1, 10), _odd_time()).alias("tod_text"),
        "route_num", "location", "users_total", "users_affected", "duration",
    )


def month_day(h: DataFrame) -> DataFrame:
    """Month, day and the (colliding) ``month + day`` key."""
    m, d = F.month("tod").cast("int"), F.dayofmonth("tod").cast("int")
    return h.select(
        m.alias("month"), d.alias("day"), (m + d).alias("md"),
        "users_total", "users_affected", "duration",
    )


def daily(h: DataFrame) -> DataFrame:
    """F8: daily sums of total and affected users."""
    return day_time(h).groupBy("idate").agg(
        F.sum("users_total").cast("long").alias("sum_users_total"),
        F.sum("users_affected").cast("long").alias("sum_users_affected"),
    )


def daily_avg(h: DataFrame) -> DataFrame:
    """daily sums plus average duration."""
    return day_time(h).groupBy("idate").agg(
        F.sum("users_total").cast("long").alias("sum_users_total"),
        F.sum("users_affected").cast("long").alias("sum_users_affected"),
        _avg("duration", "avg_duration"),
    )


def _when(h: DataFrame, cond: Callable[[Column], Column]) -> DataFrame:
    """Rows whose day satisfies ``cond``; on stored history the ``day`` folders are pruned."""
    day = F.to_date("tod")
    return h.where(cond(day) & cond(F.col("day"))) if "day" in h.columns else h.where(cond(day))


def day_total(h: DataFrame, day: str) -> DataFrame:
    """global sums for one calendar day (D7 filter)."""
    return _when(h, lambda d: d == F.lit(day).cast("date")).agg(
        F.sum("users_total").cast("long").alias("sum_users_total"),
        F.sum("users_affected").cast("long").alias("sum_users_affected"),
    )


def month_avg(h: DataFrame, month: int) -> DataFrame:
    """global averages for one month (D7 filter)."""
    return _when(h, lambda d: F.month(d) == month).agg(*_avgs())


def by_month(h: DataFrame) -> DataFrame:
    """F12."""
    return h.groupBy(F.month("tod").cast("int").alias("month")).agg(*_avgs())


def by_ymd(h: DataFrame) -> DataFrame:
    """by year, month and day (the intent of the invalid original)."""
    return h.groupBy(
        F.year("tod").cast("int").alias("year"),
        F.month("tod").cast("int").alias("month"),
        F.dayofmonth("tod").cast("int").alias("day"),
    ).agg(*_avgs())


def by_tod(h: DataFrame) -> DataFrame:
    """by exact timestamp."""
    return h.groupBy("tod").agg(*_avgs())


def by_md(h: DataFrame) -> DataFrame:
    """by the colliding ``month + day`` key."""
    return month_day(h).groupBy("md").agg(*_avgs())


def by_route_location(h: DataFrame) -> DataFrame:
    """F16: grouped by route, location, total and affected; ordered."""
    return (
        h.groupBy("route_num", "location", "users_total", "users_affected")
        .agg(_avg("users_total", "avg_users_total"), _avg("users_affected", "avg_users_affected"))
        .orderBy("route_num", "location")
    )


def max_by_location(h: DataFrame, n: int = 10) -> DataFrame:
    """max affected per (route, location); first ``n`` in key order."""
    return (
        h.groupBy("route_num", "location")
        .agg(F.max("users_affected").cast("long").alias("affected"))
        .orderBy("route_num", "location")
        .limit(n)
    )


def hotspots(h: DataFrame, n: int = 10) -> DataFrame:
    """Top ``n`` (route, location) by summed affected users.

    ``orderBy(...).limit(n)`` plans as TakeOrderedAndProject: each task keeps
    its own top n, only those reach the final merge.
    """
    return (
        h.groupBy("route_num", "location")
        .agg(F.sum("users_affected").cast("long").alias("affected"))
        .orderBy(F.desc("affected"), "route_num", "location")
        .limit(n)
    )


def month_self_join(h: DataFrame, month: int) -> DataFrame:
    """Self-join of history with one month's rows on the month.

    The pairs grow as rows squared, so they are counted, not listed: per month
    the pair count is n_left * n_right and pair sums factor the same way.
    """
    left = h.groupBy(F.month("tod").cast("int").alias("month")).agg(
        F.count(F.lit(1)).alias("n_left"), F.sum("users_total").cast("long").alias("sum_left")
    )
    right = h.where(F.month("tod") == month).groupBy(F.month("tod").cast("int").alias("month")).agg(
        F.count(F.lit(1)).alias("n_right"), F.sum("users_total").cast("long").alias("sum_right")
    )
    return left.join(right, "month").select(
        "month",
        "n_left",
        "n_right",
        (F.col("n_left") * F.col("n_right")).alias("n_pairs"),
        (F.col("sum_left") * F.col("n_right")).alias("pairs_sum_left_users_total"),
        (F.col("sum_right") * F.col("n_left")).alias("pairs_sum_right_users_total"),
    )


def vs_month_avg(h: DataFrame, month: int) -> DataFrame:
    """Each row of a month beside that month's average users_total."""
    mh = h.select(F.month("tod").cast("int").alias("month"), "tod", "route_num", "users_total")
    avgs = mh.groupBy("month").agg(_avg("users_total", "avg_users_total"))
    return mh.join(avgs, "month").where(F.col("month") == month).select(
        "month", "tod", "route_num", "users_total", "avg_users_total"
    )
