"""Independent SQL (DuckDB dialect) for every registered check.

The adapter CTEs restate SURVEY §7.2 in SQL.  Stateful operators are checked
with recursive CTEs that walk each key's messages one at a time, a different
algorithm from the chunked scans used on Spark.
"""

from __future__ import annotations

from .. import schemas as S
from ..sources import driver as D

_TEXTS = ", ".join("'" + t.replace("'", "''") + "'" for t in S.STOCK_QUERY_TEXTS)

ADAPTER = f"""
ev AS (
  SELECT event_type, ts, event_id AS seq, user_id AS uid,
         CAST(user_id % 10 AS INTEGER) AS route_num,
         CAST(CAST(floor(value) AS BIGINT) % 23 AS INTEGER) AS loc,
         CAST(json_extract_string(props, '$.k') AS INTEGER) AS k,
         date_trunc('hour', ts) AS batch
  FROM events),
inc AS (
  SELECT route_num, loc, ts,
         CASE WHEN event_type = 'error' THEN 1 ELSE 0 END AS occur_clear,
         CAST(CASE WHEN event_type = 'error' THEN 0 ELSE 5 + k % 10 END AS INTEGER) AS duration,
         seq, batch
  FROM ev WHERE event_type IN ('error', 'purchase')),
pos AS (
  SELECT route_num, loc, CAST(uid AS VARCHAR) AS user_id, ts, seq, batch
  FROM ev WHERE event_type IN ('click', 'signup', 'view')),
req AS (
  SELECT CASE event_type WHEN 'signup' THEN 0 WHEN 'purchase' THEN 1 WHEN 'view' THEN 2 ELSE 4 END AS req_type,
         CASE event_type WHEN 'error' THEN 0 WHEN 'click' THEN 2 END AS sub_req_type,
         CAST(uid AS VARCHAR) AS user_id, route_num, loc, ts, seq, batch
  FROM ev),
routes AS (
  SELECT route_id, len AS length,
         CAST(SUM(len) OVER (ORDER BY route_id) - len AS INTEGER) AS "start",
         CAST(SUM(len) OVER (ORDER BY route_id) AS INTEGER) AS "end"
  FROM (SELECT route_id, CAST(11 + (route_id * 7) % 12 AS INTEGER) AS len
        FROM (SELECT DISTINCT CAST(user_id % 10 AS INTEGER) AS route_id FROM events))),
qlog AS (
  SELECT CAST(CASE event_type WHEN 'view' THEN 0 WHEN 'click' THEN 1 ELSE 2 END AS INTEGER) AS query_type,
         date_trunc('hour', ts) AS ts, event_id AS seq
  FROM events),
querylog AS (
  SELECT query_type, ts, [{_TEXTS}][query_type + 1] AS query_text, seq FROM qlog),
hpos AS (
  SELECT route_num, batch, loc, COUNT(*) AS n FROM pos GROUP BY route_num, batch, loc),
bsum AS (
  SELECT route_num, batch, CAST(SUM(n) AS BIGINT) AS npos FROM hpos GROUP BY route_num, batch),
gt_rows AS (
  SELECT b.route_num, b.batch, b.npos, l.lv, CAST(COALESCE(SUM(h.n), 0) AS BIGINT) AS g
  FROM bsum b
  CROSS JOIN (SELECT CAST(range AS INTEGER) AS lv FROM range(0, {D.LOC_KEY_SPACE})) l
  LEFT JOIN hpos h ON h.route_num = b.route_num AND h.batch = b.batch AND h.loc > l.lv
  GROUP BY b.route_num, b.batch, b.npos, l.lv),
bundle_gt AS (
  SELECT route_num, batch, npos, list(g ORDER BY lv) AS gt FROM gt_rows GROUP BY route_num, batch, npos),
msgs AS (
  SELECT route_num, batch, 0 AS rnk, ts, seq, occur_clear AS mtype, loc, duration,
         CAST(NULL AS BIGINT[]) AS gt, CAST(0 AS BIGINT) AS npos
  FROM inc
  UNION ALL
  SELECT route_num, batch, 1, NULL, NULL, 2, NULL, NULL, gt, npos
  FROM bundle_gt),
seqm AS (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY route_num ORDER BY batch, rnk, ts, seq) AS rn FROM msgs),
walk AS (
  SELECT route_num, CAST(0 AS BIGINT) AS rn, 0 AS expect, CAST(NULL AS INTEGER) AS cur_loc,
         CAST(NULL AS TIMESTAMP) AS occ_ts, CAST(0 AS BIGINT) AS tot, CAST(0 AS BIGINT) AS aff,
         CAST(NULL AS BIGINT) AS last_n, CAST(NULL AS BIGINT) AS last_a,
         CAST(0 AS BIGINT) AS rep, CAST(0 AS BIGINT) AS clr, FALSE AS emit,
         CAST(NULL AS TIMESTAMP) AS tod, CAST(NULL AS INTEGER) AS hloc, CAST(NULL AS INTEGER) AS dur,
         CAST(NULL AS BIGINT) AS htot, CAST(NULL AS BIGINT) AS haff,
         CAST(NULL AS BIGINT) AS hn, CAST(NULL AS BIGINT) AS ha, CAST(NULL AS TIMESTAMP) AS hocc
  FROM (SELECT DISTINCT route_num FROM seqm)
  UNION ALL
  SELECT w.route_num, m.rn,
    CASE WHEN m.mtype = 1 AND w.expect = 0 THEN 1 WHEN m.mtype = 2 AND w.expect = 1 THEN 2
         WHEN m.mtype = 0 AND w.expect = 2 THEN 0 ELSE w.expect END,
    CASE WHEN m.mtype = 1 AND w.expect = 0 THEN m.loc WHEN m.mtype = 0 AND w.expect = 2 THEN NULL
         ELSE w.cur_loc END,
    CASE WHEN m.mtype = 1 AND w.expect = 0 THEN m.ts ELSE w.occ_ts END,
    w.tot + CASE WHEN m.mtype = 2 AND w.expect = 1 THEN m.npos ELSE 0 END,
    w.aff + CASE WHEN m.mtype = 2 AND w.expect = 1 THEN m.gt[w.cur_loc + 1] ELSE 0 END,
    CASE WHEN m.mtype = 2 AND w.expect = 1 THEN m.npos ELSE w.last_n END,
    CASE WHEN m.mtype = 2 AND w.expect = 1 THEN m.gt[w.cur_loc + 1] ELSE w.last_a END,
    w.rep + CASE WHEN m.mtype = 1 AND w.expect = 0 THEN 1 ELSE 0 END,
    w.clr + CASE WHEN m.mtype = 0 AND w.expect = 2 THEN 1 ELSE 0 END,
    (m.mtype = 0 AND w.expect = 2),
    m.ts, w.cur_loc, m.duration, w.tot, w.aff, w.last_n, w.last_a, w.occ_ts
  FROM walk w JOIN seqm m ON m.route_num = w.route_num AND m.rn = w.rn + 1),
hist_full AS (
  SELECT tod, route_num, hloc AS location, htot AS users_total, haff AS users_affected,
         dur AS duration, hn AS incident_users, ha AS incident_affected, hocc AS occur_ts
  FROM walk WHERE emit),
hist_traffic AS (
  SELECT tod, route_num, location, users_total, users_affected, duration FROM hist_full),
lstate AS (
  SELECT route_num, expect, cur_loc AS location, tot AS users_total, aff AS users_affected,
         rep AS incidents_reported, clr AS incidents_cleared
  FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY route_num ORDER BY rn DESC) AS k FROM walk) WHERE k = 1),
hist_day_time AS (
  SELECT strftime(tod, '%Y-%m-%d') AS idate, strftime(tod, '%I:%m:%S') AS itime,
         strftime(tod, '%H:%M:%S') AS itime24, route_num, location, users_total, users_affected, duration
  FROM hist_traffic)
"""


def sql(body: str) -> str:
    """Prefix a query body with the adapter CTEs."""
    return "WITH RECURSIVE " + ADAPTER.strip() + "\n" + body.strip()
