"""Incident pipeline checks: lifecycle (K1-K3, K7, K8), counters (F3-F6, F23),
dashboard rows (C8, C9, D9, H1), message log (B4, F2), route layout (G2, E5)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import dashboard as DB
from ..operators import history as H
from ..operators import lifecycle as L
from ..operators import messages as M
from ..sources import driver as D
from ..sources import streams as SRC
from .registry import check
from .tables import HOURLY, Tables


@check("incident_lifecycle", """
SELECT tod, route_num, location, users_total, users_affected, duration, incident_users, incident_affected,
       occur_ts FROM hist_full""")
def incident_lifecycle(spark, sf):
    return Tables(spark, sf).hist_full


@check("lifecycle_state", """
SELECT route_num, expect, location, users_total, users_affected, incidents_reported, incidents_cleared
FROM lstate""")
def lifecycle_state(spark, sf):
    return Tables(spark, sf).lifecycle_state


@check("global_counters", """
SELECT CAST(SUM(users_total) AS BIGINT) AS users_total, CAST(SUM(users_affected) AS BIGINT) AS users_affected,
       CAST(SUM(incidents_reported) AS BIGINT) AS incidents_reported,
       CAST(SUM(incidents_cleared) AS BIGINT) AS incidents_cleared,
       CAST(SUM(incidents_reported) AS BIGINT) AS routes_affected,
       COUNT(*) FILTER (WHERE incidents_reported > 0) AS routes_distinct_affected
FROM lstate""")
def global_counters(spark, sf):
    return L.global_counters(Tables(spark, sf).lifecycle_state)


@check("route_counters", """
SELECT route_num, users_total, users_affected, incidents_reported, incidents_cleared FROM lstate""")
def route_counters(spark, sf):
    return L.route_counters(Tables(spark, sf).lifecycle_state)


@check("current_global_stats", """
SELECT name, value FROM (
  SELECT 'users_total' AS name, CAST(SUM(users_total) AS BIGINT) AS value FROM lstate
  UNION ALL SELECT 'users_affected', CAST(SUM(users_affected) AS BIGINT) FROM lstate)""")
def current_global_stats(spark, sf):
    g = L.global_counters(Tables(spark, sf).lifecycle_state)
    return DB.metric_rows(g, ["users_total", "users_affected"])


@check("current_incident_stats", """
SELECT name, value FROM (
  SELECT 'incidents_reported' AS name, CAST(SUM(incidents_reported) AS BIGINT) AS value FROM lstate
  UNION ALL SELECT 'incidents_cleared', CAST(SUM(incidents_cleared) AS BIGINT) FROM lstate)""")
def current_incident_stats(spark, sf):
    g = L.global_counters(Tables(spark, sf).lifecycle_state)
    return DB.metric_rows(g, ["incidents_reported", "incidents_cleared"])


@check("road_condition", """
SELECT r.route_id,
       CASE WHEN s.location IS NULL THEN 'No incidents on Route ' || CAST(r.route_id AS VARCHAR)
            ELSE 'Incident(s) on Route ' || CAST(r.route_id AS VARCHAR) || ' at location '
                 || CAST(s.location AS VARCHAR) END AS roadtext
FROM routes r LEFT JOIN (SELECT route_num, location FROM lstate WHERE expect <> 0) s
  ON s.route_num = r.route_id""")
def road_condition(spark, sf):
    t = Tables(spark, sf)
    routes = DB.layout_routes(D.route_lengths(t.events))
    return DB.road_condition(routes, L.current_incidents(t.lifecycle_state))


@check("chart_series_daily", """
SELECT name, array_to_string(list(idate ORDER BY idate), ',') AS categories,
       array_to_string(list(CAST(v AS VARCHAR) ORDER BY idate), ',') AS data
FROM (SELECT idate, 'sum_users_total' AS name, CAST(SUM(users_total) AS BIGINT) AS v FROM hist_day_time GROUP BY idate
      UNION ALL
      SELECT idate, 'sum_users_affected', CAST(SUM(users_affected) AS BIGINT) FROM hist_day_time GROUP BY idate)
GROUP BY name""")
def chart_series_daily(spark, sf):
    daily = H.daily(Tables(spark, sf).hist_traffic)
    cs = DB.chart_series(daily, "idate", ["sum_users_total", "sum_users_affected"])
    # arrays compared as text
    return cs.select(
        "name",
        F.array_join("categories", ",").alias("categories"),
        F.array_join(F.transform("data", lambda x: x.cast("string")), ",").alias("data"),
    )


@check("incident_history_pairs", """
SELECT CAST(CAST(occur_ts AS DATE) AS VARCHAR) AS day, route_num, location, occur_ts AS occur_time,
       tod AS clear_time, incident_affected AS users_affected, duration FROM hist_full""")
def incident_history_pairs(spark, sf):
    t = Tables(spark, sf)
    return L.incident_history_pairs(t.incidents, t.positions, HOURLY)


@check("capped_incidents", """
, cseq AS (SELECT route_num, occur_clear AS o,
                 ROW_NUMBER() OVER (PARTITION BY route_num ORDER BY ts, seq) AS rn FROM inc),
cwalk AS (
  SELECT route_num, CAST(0 AS BIGINT) AS rn, 0 AS active, CAST(0 AS BIGINT) AS reported, CAST(0 AS BIGINT) AS dropped,
         CAST(0 AS BIGINT) AS cleared, CAST(0 AS BIGINT) AS ignored
  FROM (SELECT DISTINCT route_num FROM cseq)
  UNION ALL
  SELECT w.route_num, m.rn,
    CASE WHEN m.o = 1 AND w.active < 5 THEN w.active + 1 WHEN m.o = 0 AND w.active > 0 THEN w.active - 1
         ELSE w.active END,
    w.reported + CASE WHEN m.o = 1 AND w.active < 5 THEN 1 ELSE 0 END,
    w.dropped + CASE WHEN m.o = 1 AND w.active >= 5 THEN 1 ELSE 0 END,
    w.cleared + CASE WHEN m.o = 0 AND w.active > 0 THEN 1 ELSE 0 END,
    w.ignored + CASE WHEN m.o = 0 AND w.active = 0 THEN 1 ELSE 0 END
  FROM cwalk w JOIN cseq m ON m.route_num = w.route_num AND m.rn = w.rn + 1)
SELECT route_num, CAST(active AS BIGINT) AS active, reported, dropped, cleared, ignored
FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY route_num ORDER BY rn DESC) AS k FROM cwalk) WHERE k = 1""")
def capped_incidents(spark, sf):
    return L.capped_incidents(Tables(spark, sf).incidents)


@check("last_incident_location", """
SELECT route_num, loc AS location FROM (
  SELECT route_num, loc, ROW_NUMBER() OVER (PARTITION BY route_num ORDER BY ts DESC, seq DESC) AS k FROM inc)
WHERE k = 1""")
def last_incident_location(spark, sf):
    return M.last_incident(Tables(spark, sf).incidents)


@check("incident_counters", """
SELECT route_num, COUNT(*) AS incidents, GROUPING(route_num) = 1 AS is_total FROM inc GROUP BY ROLLUP (route_num)""")
def incident_counters(spark, sf):
    return M.incident_counters(Tables(spark, sf).incidents)


@check("positions_by_route", """
SELECT route_num, COUNT(*) AS users_total FROM pos GROUP BY route_num""")
def positions_by_route(spark, sf):
    return M.positions_by_route(Tables(spark, sf).positions)


@check("positions_bundle", """
SELECT batch, route_num, CAST(SUM(n) AS BIGINT) AS n_positions,
       array_to_string(list(CAST(loc AS VARCHAR) || ':' || CAST(n AS VARCHAR) ORDER BY loc), ',') AS loc_hist
FROM hpos GROUP BY batch, route_num""")
def positions_bundle(spark, sf):
    b = M.bundle_positions(Tables(spark, sf).positions)
    return b.select(
        "batch", "route_num", "n_positions",
        F.array_join(F.transform("loc_hist", lambda x: F.concat_ws(":", x["loc"], x["n"])), ",").alias("loc_hist"),
    )


@check("message_log", """
SELECT batch, 0 AS rnk, route_num, occur_clear AS msg_type, ts, seq, loc, duration, CAST(NULL AS BIGINT) AS n_positions
FROM inc
UNION ALL
SELECT batch, 1, route_num, 2, MIN(ts), MIN(seq), NULL, NULL, COUNT(*) FROM pos GROUP BY batch, route_num""")
def message_log(spark, sf):
    t = Tables(spark, sf)
    return M.build_messages(t.incidents, t.positions)


@check("route_layout", """SELECT route_id, length, "start", "end" FROM routes""")
def route_layout(spark, sf):
    return DB.layout_routes(D.route_lengths(Tables(spark, sf).events))


@check("scan_routes", """SELECT route_id, length, "start", "end" FROM routes""")
def scan_routes(spark, sf):
    t = Tables(spark, sf)
    return SRC.scan(spark, t.table_file("routes", lambda: DB.layout_routes(D.route_lengths(t.events))))


@check("route_metric_rows", """
SELECT 'users_total_on_route_' || route_num AS name, users_total AS value FROM lstate
UNION ALL
SELECT 'users_affected_on_route_' || route_num, users_affected FROM lstate""")
def route_metric_rows(spark, sf):
    c = L.route_counters(Tables(spark, sf).lifecycle_state)
    return DB.route_metric_rows(c, ["users_total", "users_affected", "not_a_counter"])


@check("route_lookup", """
SELECT p.seq, p.route_num, p.loc, r."start" AS route_start, r."end" AS route_end
FROM pos p LEFT JOIN routes r ON r.route_id = p.route_num""")
def route_lookup(spark, sf):
    t = Tables(spark, sf)
    routes = DB.layout_routes(D.route_lengths(t.events))
    return DB.with_route(t.positions.select("seq", "route_num", "loc"), routes)
