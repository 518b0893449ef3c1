"""Ingest checks: A4, A5, B1, B6, C1-C4, D6, F1, F18, F20, G5, J3, J8."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import schemas as S
from ..operators import ingest as I
from ..sinks import keyed_table as KT
from ..operators import messages as M
from ..sources import driver as D
from ..sources import streams as SRC
from ..streaming import vocabulary as V
from .registry import check
from .tables import Tables

STATE = "BUILDING"
BEFORE_DATE = "1995-06-10"
MALFORMED_EVERY = 50


def _violation_sql_columns() -> str:
    cols = []
    for i, name in enumerate(S.VIOLATION_COLUMNS):
        v = f"it[{i + 1}]"
        if i in S.VIOLATION_BOOL_POSITIONS:
            c = f"lower({v}) = 'yes'"
        else:
            c = f"nullif({v}, '')"
            if name in S.VIOLATION_DOUBLE_COLUMNS:
                c = f"TRY_CAST({c} AS DOUBLE)"
            elif name in S.VIOLATION_INT_COLUMNS:
                c = f"TRY_CAST({c} AS INTEGER)"
        cols.append(f"{c} AS {name}")
    return ",\n       ".join(cols)


_VIOL = f"""
, vlines AS (
  SELECT {D.violation_line_sql()} AS value
  FROM orders JOIN customer ON o_custkey = c_custkey),
vitems AS (
  SELECT string_split(replace(replace(
             CASE WHEN value LIKE '%,' AND value NOT LIKE '%,,' THEN value || ',' ELSE value END,
             ', ', '  '), '"', ''), ',') AS it
  FROM vlines),
violations AS (
  SELECT {_violation_sql_columns()}
  FROM vitems)
"""
_VKEY = ", ".join(S.VIOLATION_KEY)
_VKEY_SET = " AND ".join(f"{k} IS NOT NULL" for k in S.VIOLATION_KEY)


def _violations(spark, sf):
    t = Tables(spark, sf)
    path = t.text_file("violations", lambda: D.violation_lines(t.raw("orders"), t.raw("customer")))
    return SRC.read_violations(spark, path)


@check("violations_ingest", _VIOL + "SELECT * FROM violations")
def violations_ingest(spark, sf):
    return _violations(spark, sf)


@check("violations_upsert", _VIOL + f"""
SELECT * EXCLUDE (k) FROM (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY {_VKEY} ORDER BY agency DESC) AS k
  FROM violations WHERE {_VKEY_SET}) WHERE k = 1""")
def violations_upsert(spark, sf):
    rows = _violations(spark, sf).withColumn("seq", F.expr("try_cast(substring(agency, 8) AS BIGINT)"))
    return I.upsert_latest(rows, S.VIOLATION_KEY, ["seq"]).drop("seq")


@check("violations_key_rejects", _VIOL + f"""
SELECT *, CASE WHEN driver_state IS NULL THEN 'driver_state' WHEN driver_city IS NULL THEN 'driver_city'
               WHEN date_of_stop IS NULL THEN 'date_of_stop' ELSE 'time_of_stop' END AS missing_key
FROM violations WHERE NOT ({_VKEY_SET})""")
def violations_key_rejects(spark, sf):
    return I.upsert_rejects(_violations(spark, sf), S.VIOLATION_KEY)


@check("violation_cities_in_state_order", _VIOL + """
SELECT driver_state, driver_city, stops, CAST(ROW_NUMBER() OVER (PARTITION BY driver_state ORDER BY driver_city) AS INTEGER) AS rank
FROM (SELECT driver_state, driver_city, COUNT(*) AS stops FROM violations
      WHERE driver_state IS NOT NULL AND driver_city IS NOT NULL GROUP BY ALL)""")
def violation_cities_in_state_order(spark, sf):
    stops = _violations(spark, sf).where("driver_state IS NOT NULL AND driver_city IS NOT NULL").groupBy("driver_state", "driver_city").count()
    return I.ranked_within(stops.withColumnRenamed("count", "stops"), "driver_state", ["driver_city"])


@check("violation_locations_by_state", _VIOL + f"""
SELECT agency, location FROM violations WHERE driver_state = '{STATE}'""")
def violation_locations_by_state(spark, sf):
    return I.select_where(_violations(spark, sf), ["agency", "location"], F.col("driver_state") == STATE)


@check("violation_locations_before", _VIOL + f"""
SELECT agency, location FROM violations WHERE date_of_stop < '{BEFORE_DATE}'""")
def violation_locations_before(spark, sf):
    return I.select_where(
        _violations(spark, sf), ["agency", "location"], F.col("date_of_stop") < F.lit(BEFORE_DATE)
    )


@check("violation_avg_year", _VIOL + f"""
SELECT ROUND(AVG(CAST(year AS DOUBLE)), 6) AS avg_year FROM violations WHERE driver_state = '{STATE}'""")
def violation_avg_year(spark, sf):
    return I.avg_where(_violations(spark, sf), "year", F.col("driver_state") == STATE, "avg_year")


@check("csv_pairs_ingest", """
SELECT string_split(l, ',')[1] AS textstr, TRY_CAST(string_split(l, ',')[2] AS INTEGER) AS numero
FROM (SELECT p_name || ',' || CAST(p_size AS VARCHAR) AS l FROM part)""")
def csv_pairs_ingest(spark, sf):
    t = Tables(spark, sf)
    return SRC.read_csv_pairs(spark, t.text_file("csv_pairs", lambda: D.csv_pair_lines(t.raw("part"))))


@check("querylog_upsert", """
SELECT query_type, ts, query_text, seq FROM (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY query_type, ts ORDER BY seq DESC) AS k FROM querylog) WHERE k = 1""")
def querylog_upsert(spark, sf):
    return I.upsert_latest(D.querylog_events(Tables(spark, sf).events), ["query_type", "ts"], ["seq"])


@check("querylog_keyed_table", """
SELECT query_type, ts, query_text, seq FROM (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY query_type, ts ORDER BY seq DESC) AS k FROM querylog) WHERE k = 1""")
def querylog_keyed_table(spark, sf):
    return KT.read(spark, Tables(spark, sf).querylog_table, ["query_type", "ts"], ["seq"])


_PV = """(SELECT CAST(user_id AS VARCHAR) AS site_id, date_trunc('hour', ts) + INTERVAL 1 HOUR AS window_end,
        COUNT(*) AS pageviews FROM events GROUP BY ALL)"""


@check("pageviews_per_site", f"SELECT * FROM {_PV}")
def pageviews_per_site(spark, sf):
    return I.pageviews(D.pageview_events(Tables(spark, sf).events))


@check("top_pageviews_per_site", f"""
SELECT site_id, window_end, pageviews,
       CAST(ROW_NUMBER() OVER (PARTITION BY site_id ORDER BY pageviews DESC, window_end) AS INTEGER) AS rank FROM {_PV}""")
def top_pageviews_per_site(spark, sf):
    pv = I.pageviews(D.pageview_events(Tables(spark, sf).events))
    return I.ranked_within(pv, "site_id", [F.desc("pageviews"), F.asc("window_end")])


@check("distinct_words", """
SELECT DISTINCT 'Word:' || w AS key, 1 AS value
FROM (SELECT unnest(string_split_regex(text, '[ \n]')) AS w FROM documents)""")
def distinct_words(spark, sf):
    return I.distinct_words(D.text_lines(Tables(spark, sf).raw("documents")))


@check("word_first_sightings", """
SELECT 'Word:' || w AS key, 1 AS value, MIN(load) AS first_epoch
FROM (SELECT unnest(string_split_regex(text, '[ \n]')) AS w, doc_id % 4 AS load FROM documents) GROUP BY w""")
def word_first_sightings(spark, sf):
    return V.read_vocabulary(spark, Tables(spark, sf).vocabulary)


@check("json_parse", f"""
SELECT seq,
       CASE WHEN seq % {MALFORMED_EVERY} = 0 THEN NULL ELSE CAST(route_num AS VARCHAR) END AS user_route_num,
       CASE WHEN seq % {MALFORMED_EVERY} = 0 THEN NULL ELSE CAST(loc AS VARCHAR) END AS user_loc,
       CASE WHEN seq % {MALFORMED_EVERY} = 0 THEN NULL ELSE user_id END AS user_id,
       CASE WHEN seq % {MALFORMED_EVERY} = 0 THEN NULL ELSE strftime(ts, '%Y-%m-%d %H:%M:%S') END AS ts,
       seq % {MALFORMED_EVERY} = 0 AS malformed
FROM pos""")
def json_parse(spark, sf):
    w = M.position_wire_json(Tables(spark, sf).positions).drop("route_num")
    # every MALFORMED_EVERY-th message arrives cut short
    w = w.withColumn(
        "value", F.when(F.col("seq") % MALFORMED_EVERY == 0, F.substring("value", 1, 10)).otherwise(F.col("value"))
    )
    p = M.parse_json(w, S.USER_POS_SCHEMA)
    return p.select("seq", "user_route_num", "user_loc", "user_id", "ts", F.col("_malformed").alias("malformed"))


@check("incident_projection", """
SELECT seq, route_num, loc, date_trunc('second', ts) AS ts, occur_clear, duration FROM inc""")
def incident_projection(spark, sf):
    w = M.incident_wire_json(Tables(spark, sf).incidents)
    parsed = M.parse_json(w, S.USER_ACCIDENT_SCHEMA)
    return M.parse_incidents(parsed).select("seq", "route_num", "loc", "ts", "occur_clear", "duration")


@check("position_projection", """
SELECT seq, route_num, loc, user_id, date_trunc('second', ts) AS ts FROM pos""")
def position_projection(spark, sf):
    w = M.position_wire_json(Tables(spark, sf).positions).drop("route_num")
    return M.parse_positions(M.parse_json(w, S.USER_POS_SCHEMA)).select("seq", "route_num", "loc", "user_id", "ts")


@check("request_projection", """
SELECT seq, req_type, sub_req_type, user_id, route_num, loc, date_trunc('second', ts) AS ts FROM req""")
def request_projection(spark, sf):
    r = Tables(spark, sf).requests
    w = M.wire_json(r, {
        "req_type": F.col("req_type"), "sub_req_type": F.col("sub_req_type").cast("string"), "user_id": F.col("user_id"),
        "route_id": F.col("route_num"), "location": F.col("loc").cast("string"), "ts": M.text_of_ntz("ts")}, ["seq"])
    return M.parse_requests(M.parse_json(w, S.USER_TRAFFIC_SCHEMA)).select("seq", "req_type", "sub_req_type", "user_id", "route_num", "loc", "ts")


@check("pageview_projection", """
SELECT CAST(user_id AS VARCHAR) AS site_id, CAST(event_id AS VARCHAR) AS page_view, date_trunc('second', ts) AS ts FROM events""")
def pageview_projection(spark, sf):
    e = D.pageview_events(Tables(spark, sf).events)
    w = M.wire_json(e, {"site_id": F.col("site_id"), "page_view": F.col("page_view"), "ts": M.text_of_ntz("ts")}, [])
    return M.parse_pageviews(M.parse_json(w, S.PAGEVIEW_SCHEMA)).select("site_id", "page_view", "ts")


@check("querylog_projection", "SELECT seq, query_type, date_trunc('second', ts) AS ts, query_text FROM querylog")
def querylog_projection(spark, sf):
    q = D.querylog_events(Tables(spark, sf).events)
    w = M.wire_json(q, {"ts": M.text_of_ntz("ts"), "query_type": F.col("query_type"), "query_text": F.col("query_text")}, ["seq"])
    return M.parse_querylog(M.parse_json(w, S.QUERYLOG_SCHEMA)).select("seq", "query_type", "ts", "query_text")


PER_LINE = 4
CUT_EVERY = 7


@check("packed_message_roundtrip", f"""
, numbered AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY route_num ORDER BY ts, seq) - 1 AS n FROM pos),
marked AS (SELECT *, n // {PER_LINE} AS line_no, n % {PER_LINE} AS k_at,
                  MAX(n % {PER_LINE}) OVER (PARTITION BY route_num, n // {PER_LINE}) AS last_at,
                  MIN(seq) OVER (PARTITION BY route_num, n // {PER_LINE}) AS line_seq FROM numbered)
SELECT seq, occur_clear AS msg_type, route_num, loc, CAST(NULL AS VARCHAR) AS user_id,
       date_trunc('second', ts) AS ts, duration, CAST(NULL AS VARCHAR) AS problem FROM inc
UNION ALL
SELECT line_seq, 2, route_num,
       CASE WHEN line_seq % {CUT_EVERY} = 0 AND k_at = last_at THEN NULL ELSE loc END,
       CASE WHEN line_seq % {CUT_EVERY} = 0 AND k_at = last_at THEN NULL ELSE user_id END,
       CASE WHEN line_seq % {CUT_EVERY} = 0 AND k_at = last_at THEN NULL ELSE date_trunc('second', ts) END, NULL,
       CASE WHEN line_seq % {CUT_EVERY} = 0 AND k_at = last_at THEN 'cut' END FROM marked""")
def packed_message_roundtrip(spark, sf):
    """Several positions a line; every CUT_EVERY-th line has lost its last token."""
    t = Tables(spark, sf)
    lines = M.pack_position_lines(t.positions, PER_LINE)
    cut = F.when(F.col("seq") % CUT_EVERY == 0, F.regexp_replace("value", " [^ ]+$", "")).otherwise(F.col("value"))
    return M.unpack_messages(M.pack_incidents(t.incidents).unionByName(lines.withColumn("value", cut)))


@check("expected_clear_time", """
SELECT seq, route_num, ts, duration, ts + to_seconds(duration) AS expected_ts FROM inc WHERE occur_clear = 0""")
def expected_clear_time(spark, sf):
    return M.expected_clear_time(Tables(spark, sf).incidents)


@check("publish_keyed_json", f"""
SELECT seq, CAST(route_num % {S.PUBLISH_KEY_SPACE} AS INTEGER) AS key,
       '{{"user_route_num":' || route_num || ',"user_loc":' || loc || ',"user_id":"' || user_id
       || '","ts":"' || strftime(ts, '%Y-%m-%d %H:%M:%S') || '"}}' AS value
FROM pos""")
def publish_keyed_json(spark, sf):
    w = M.position_wire_json(Tables(spark, sf).positions)
    return M.publish_keyed(w, F.col("route_num")).select("seq", "key", "value")
