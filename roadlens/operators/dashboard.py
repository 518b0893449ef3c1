"""Current-state views for the dashboard (C8, C9, D9, H1) and route layout."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import schemas as S


def layout_routes(lengths: DataFrame) -> DataFrame:
    """Consecutive ``[start, end)`` intervals from route lengths.

    The route table is a dimension (one row per route id), so the global
    running sum over it is tiny whatever the event volume.
    """
    w = Window.orderBy("route_id").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    run = F.sum("length").over(w)
    return lengths.select(
        "route_id",
        "length",
        (run - F.col("length")).cast("int").alias("start"),
        run.cast("int").alias("end"),
    )


def with_route(df: DataFrame, routes: DataFrame, route_col: str = "route_num") -> DataFrame:
    """E5: attach route endpoints.  No broadcast is forced: Spark broadcasts
    ``routes`` when its measured size is under the session's threshold and
    shuffles both sides (with skew splitting) when it is not."""
    r = routes.select(
        F.col("route_id").alias(route_col), F.col("start").alias("route_start"), F.col("end").alias("route_end")
    )
    return df.join(r, route_col, "left")


def road_condition(routes: DataFrame, current: DataFrame) -> DataFrame:
    """One sentence per route: no incident, or the incident's location."""
    cur = current.select(F.col("route_num").alias("route_id"), "location")
    j = routes.select("route_id").join(cur, "route_id", "left")
    rid = F.col("route_id").cast("string")
    return j.select(
        "route_id",
        F.when(F.col("location").isNull(), F.format_string(S.ROAD_CLEAR_TEXT, rid))
        .otherwise(F.format_string(S.ROAD_INCIDENT_TEXT, rid, F.col("location").cast("string")))
        .alias("roadtext"),
    )


def metric_rows(counters: DataFrame, names: Sequence[str], suffix: Column | None = None) -> DataFrame:
    """One (name, value) row per requested counter and counters row
    (the bag union of the metric kinds, built in one pass with an explode).

    A name that is not a column of ``counters``, or whose value is null, yields
    no row (key-exists read).  ``suffix`` is appended to the names (J4).
    """
    def named(n: str) -> Column:
        return F.lit(n) if suffix is None else F.concat(F.lit(n), suffix)

    rows = [F.struct(named(n).alias("name"), F.col(n).cast("long").alias("value")) for n in names if n in counters.columns]
    typed = F.array(*rows).cast("array<struct<name:string,value:bigint>>")
    return counters.select(F.inline(F.filter(typed, lambda r: r["value"].isNotNull())))


def route_metric_rows(counters: DataFrame, names: Sequence[str], route_col: str = "route_num") -> DataFrame:
    """D9 / H1 per route: names carry the route, as in ``users_total_on_route_7``."""
    return metric_rows(counters, names, F.concat(F.lit("_on_route_"), F.col(route_col).cast("string")))


def chart_series(df: DataFrame, category: str, metrics: Sequence[str]) -> DataFrame:
    """``{name, data[]}`` per metric with the shared category list.

    The input is already aggregated per category (one row per day), so the
    arrays grow with the number of categories, not with the data.
    """
    long = df.select(
        category, F.explode(F.array(*[F.struct(F.lit(m).alias("name"), F.col(m).cast("long").alias("v"))
                                      for m in metrics])).alias("kv")
    ).select(category, "kv.name", "kv.v")
    g = long.groupBy("name").agg(F.array_sort(F.collect_list(F.struct(category, "v"))).alias("pts"))
    return g.select(
        "name",
        F.col(f"pts.{category}").alias("categories"),
        F.col("pts.v").alias("data"),
    )
