"""Small literal checks of library helpers not covered by a registered query."""

import datetime as dt

from pyspark.sql import functions as F

from roadlens.operators import dashboard as DB
from roadlens.operators import ingest as I
from roadlens.operators import joins as J
from roadlens.sinks import writers as W


def test_affected_modes_and_within(spark):
    df = spark.createDataFrame([(10, u) for u in range(6, 15)], "inc int, user int")
    rows = df.select(
        "user",
        J.affected(F.col("user"), F.col("inc"), "downstream", 2).alias("down2"),
        J.affected(F.col("user"), F.col("inc"), "upstream", 2).alias("up2"),
        J.affected(F.col("user"), F.col("inc"), "downstream", None).alias("down"),
        J.affected(F.col("user"), F.col("inc"), "upstream", None).alias("up"),
        J.within(F.col("user"), F.lit(8), F.col("inc")).alias("in"),
    ).orderBy("user").collect()
    by = {r.user: r for r in rows}
    assert [u for u in by if by[u].down2] == [11, 12]
    assert [u for u in by if by[u].up2] == [8, 9]
    assert [u for u in by if by[u].down] == [11, 12, 13, 14]
    assert [u for u in by if by[u].up] == [6, 7, 8, 9]
    assert [u for u in by if by[u]["in"]] == [8, 9, 10]


def test_ranked_within_and_chart_series(spark):
    df = spark.createDataFrame(
        [("a", "d1", 5), ("a", "d2", 9), ("a", "d3", 9), ("b", "d1", 1)], "site string, day string, v int")
    top = I.ranked_within(df, "site", [F.desc("v"), F.asc("day")], 2).orderBy("site", "rank").collect()
    assert [(r.site, r.day, r.rank) for r in top] == [("a", "d2", 1), ("a", "d3", 2), ("b", "d1", 1)]
    daily = spark.createDataFrame([("d2", 3, 1), ("d1", 2, 0)], "idate string, tot int, aff int")
    cs = {r.name: (r.categories, r.data) for r in DB.chart_series(daily, "idate", ["tot", "aff"]).collect()}
    assert cs == {"tot": (["d1", "d2"], [2, 3]), "aff": (["d1", "d2"], [0, 1])}


def test_metric_rows_key_exists(spark):
    c = spark.createDataFrame([(3, 4)], "users_total long, users_affected long")
    rows = {(r.name, r.value) for r in DB.metric_rows(c, ["users_total", "no_such_metric"]).collect()}
    assert rows == {("users_total", 3)}


def test_create_view(spark):
    df = spark.createDataFrame([(dt.date(2024, 1, 1), 1)], "idate date, n int")
    v = W.create_view(spark, "hist_day_time_test", df)
    assert spark.sql("SELECT SUM(n) AS s FROM hist_day_time_test").collect()[0].s == 1
    assert v.count() == 1


def test_written_tables_can_be_released(spark, monkeypatch):
    import os

    from roadlens import session as SE

    monkeypatch.setattr(SE, "_written", [])
    df = SE.materialise(spark.range(5), "five")
    folder = os.path.dirname(df.inputFiles()[0]).removeprefix("file://").removeprefix("file:")
    assert df.count() == 5 and os.path.isdir(folder)
    assert SE.release_tables(spark) == 1 and not os.path.exists(folder) and SE.release_tables(spark) == 0
