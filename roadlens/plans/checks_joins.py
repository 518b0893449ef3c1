"""Join checks: E1, E2, E3, F21, F22."""

from __future__ import annotations

from ..operators import dashboard as DB
from ..operators import joins as J
from ..sources import driver as D
from .registry import check
from .tables import Tables

_E1 = """(SELECT i.batch, i.route_num, i.seq AS inc_seq, i.loc AS inc_loc, i.ts AS inc_ts, p.seq AS pos_seq,
        p.user_id, p.loc AS user_loc, p.ts AS user_ts
 FROM inc i JOIN pos p ON p.route_num = i.route_num AND p.batch = i.batch
 WHERE p.loc > i.loc AND p.loc - i.loc <= 2)"""


@check("incident_user_join", f"SELECT * FROM {_E1}")
def incident_user_join(spark, sf):
    t = Tables(spark, sf)
    return J.incident_user_join(t.incidents, t.positions)


@check("route_member_set", f"SELECT DISTINCT route_num, user_id, user_ts AS ts FROM {_E1}")
def route_member_set(spark, sf):
    t = Tables(spark, sf)
    return J.route_members(t.incidents, t.positions)


@check("join_counters", f"""
SELECT route_num, CAST(COUNT(*) AS BIGINT) AS pairs FROM {_E1} GROUP BY ROLLUP (route_num)""")
def join_counters(spark, sf):
    t = Tables(spark, sf)
    return J.join_counters(t.incidents, t.positions)


@check("asof_affected_users", """
SELECT p.route_num, CAST(CAST(p.ts AS DATE) AS VARCHAR) AS day, COUNT(*) AS positions,
       COUNT(*) FILTER (WHERE i.occur_clear = 1 AND i.loc - p.loc > 0 AND i.loc - p.loc <= 2) AS affected
FROM pos p ASOF LEFT JOIN inc i ON p.route_num = i.route_num AND p.ts >= i.ts
GROUP BY p.route_num, CAST(CAST(p.ts AS DATE) AS VARCHAR)""")
def asof_affected_users(spark, sf):
    t = Tables(spark, sf)
    return J.asof_affected_counts(t.positions, t.incidents)


@check("incidents_on_span", """
SELECT q.seq, q.route_num, r."start" + q.loc % r.length AS span_start, r."end" AS span_end,
       CAST(COUNT(i.seq) AS BIGINT) AS hits, COUNT(i.seq) > 0 AS notify
FROM req q JOIN routes r ON r.route_id = q.route_num
LEFT JOIN inc i ON i.route_num = q.route_num AND i.occur_clear = 1
     AND r."start" + i.loc % r.length BETWEEN r."start" + q.loc % r.length AND r."end"
WHERE q.req_type = 2
GROUP BY q.seq, q.route_num, r."start" + q.loc % r.length, r."end\"""")
def incidents_on_span(spark, sf):
    t = Tables(spark, sf)
    routes = DB.layout_routes(D.route_lengths(t.events))
    queries = t.requests.where("req_type = 2")
    return J.incidents_on_span(queries, t.incidents, routes)


@check("incidents_on_span_at_query_time", """
, ch AS (
  SELECT route_num, loc, ts, seq, CASE WHEN sub_req_type = 2 THEN -1 ELSE 1 END AS delta
  FROM req WHERE req_type = 4),
qs AS (
  SELECT q.seq, q.route_num, q.ts, r.length, q.loc % r.length AS qoff,
         r."start" + q.loc % r.length AS span_start, r."end" AS span_end
  FROM req q JOIN routes r ON r.route_id = q.route_num WHERE q.req_type = 2),
probe AS (
  SELECT qs.seq, qs.route_num, qs.ts, k.loc
  FROM qs JOIN (SELECT DISTINCT route_num, loc FROM ch) k ON k.route_num = qs.route_num
  WHERE k.loc % qs.length >= qs.qoff),
asof_state AS (
  SELECT p.seq, c.delta FROM probe p
  ASOF LEFT JOIN ch c ON c.route_num = p.route_num AND c.loc = p.loc AND p.ts >= c.ts)
SELECT qs.seq, qs.route_num, qs.span_start, qs.span_end,
       CAST(COUNT(a.seq) FILTER (WHERE a.delta = 1) AS BIGINT) AS hits,
       COUNT(a.seq) FILTER (WHERE a.delta = 1) > 0 AS notify
FROM qs LEFT JOIN asof_state a ON a.seq = qs.seq
GROUP BY qs.seq, qs.route_num, qs.span_start, qs.span_end""")
def incidents_on_span_at_query_time(spark, sf):
    from ..operators.requests import report_events

    t = Tables(spark, sf)
    routes = DB.layout_routes(D.route_lengths(t.events))
    queries = t.requests.where("req_type = 2")
    return J.incidents_on_span_at(queries, report_events(t.requests), routes)
