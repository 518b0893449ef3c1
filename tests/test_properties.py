"""Invariants on the whole sf0.01 tables."""

from pyspark.sql import functions as F

from roadlens.operators import dashboard as DB
from roadlens.operators import ingest as I
from roadlens.operators import lifecycle as L
from roadlens.operators import requests as R
from roadlens.plans.tables import Tables
from roadlens.sources import driver as D

SF = "/root/testdata/sf0.01"


def test_lifecycle_invariants(spark):
    st = Tables(spark, SF).lifecycle_state.collect()
    for r in st:
        assert 0 <= r.incidents_reported - r.incidents_cleared <= 1
        assert r.users_affected <= r.users_total
        assert (r.expect == L.EXPECT_INCIDENT) == (r.incidents_reported == r.incidents_cleared)


def test_history_totals_are_running_sums(spark):
    h = Tables(spark, SF).hist_full
    w = F.sum("incident_users").over(
        __import__("pyspark.sql", fromlist=["Window"]).Window.partitionBy("route_num").orderBy("tod"))
    bad = h.withColumn("_run", w).where(F.col("_run") != F.col("users_total")).count()
    assert bad == 0


def test_cap_never_exceeded(spark):
    for r in L.capped_incidents(Tables(spark, SF).incidents).collect():
        assert 0 <= r.active <= 5 and r.reported - r.cleared == r.active


def test_upsert_one_row_per_key(spark):
    q = I.upsert_latest(D.querylog_events(Tables(spark, SF).events), ["query_type", "ts"], ["seq"])
    assert q.count() == q.select("query_type", "ts").distinct().count()


def test_route_intervals_adjoin(spark):
    r = DB.layout_routes(D.route_lengths(Tables(spark, SF).events)).orderBy("route_id").collect()
    assert r[0].start == 0
    for a, b in zip(r, r[1:]):
        assert a.end == b.start and b.end - b.start == b.length


def test_sessions_do_not_overlap(spark):
    s = R.sessions(Tables(spark, SF).requests).orderBy("user_id", "register_ts").collect()
    prev = {}
    for r in s:
        p = prev.get(r.user_id)
        if p is not None:
            assert p.signoff_ts is not None and p.signoff_ts <= r.register_ts
        prev[r.user_id] = r
