"""History checks (C5-C7, F8-F17, E6, E7, G4) over the lifecycle's hist_traffic."""

from __future__ import annotations

from ..operators import history as H
from ..operators import history_partials as HP
from .registry import check
from .tables import Tables

DAY = "2024-01-15"
MONTH = 1
_AVG3 = """ROUND(AVG(CAST(users_total AS DOUBLE)), 6) AS avg_users_total,
           ROUND(AVG(CAST(users_affected AS DOUBLE)), 6) AS avg_users_affected,
           ROUND(AVG(CAST(duration AS DOUBLE)), 6) AS avg_duration"""


@check("hist_day_time", """
SELECT idate, itime, itime24, route_num, location, users_total, users_affected, duration FROM hist_day_time""")
def hist_day_time(spark, sf):
    return H.day_time(Tables(spark, sf).hist_traffic)


@check("hist_full_text", """
SELECT strftime(tod, '%Y-%m-%d %I:%m:%S') AS tod_text, route_num, location, users_total, users_affected,
       duration FROM hist_traffic""")
def hist_full_text(spark, sf):
    return H.hist_text(Tables(spark, sf).hist_traffic)


@check("hist_month_day", """
SELECT CAST(month(tod) AS INTEGER) AS month, CAST(day(tod) AS INTEGER) AS day,
       CAST(month(tod) + day(tod) AS INTEGER) AS md, users_total, users_affected, duration FROM hist_traffic""")
def hist_month_day(spark, sf):
    return H.month_day(Tables(spark, sf).hist_traffic)


@check("hist_daily", """
SELECT idate, CAST(SUM(users_total) AS BIGINT) AS sum_users_total,
       CAST(SUM(users_affected) AS BIGINT) AS sum_users_affected
FROM hist_day_time GROUP BY idate""")
def hist_daily(spark, sf):
    return H.daily(Tables(spark, sf).hist_traffic)


@check("hist_daily_avg", """
SELECT idate, CAST(SUM(users_total) AS BIGINT) AS sum_users_total,
       CAST(SUM(users_affected) AS BIGINT) AS sum_users_affected,
       ROUND(AVG(CAST(duration AS DOUBLE)), 6) AS avg_duration
FROM hist_day_time GROUP BY idate""")
def hist_daily_avg(spark, sf):
    return H.daily_avg(Tables(spark, sf).hist_traffic)


@check("hist_day_total", f"""
SELECT CAST(SUM(users_total) AS BIGINT) AS sum_users_total, CAST(SUM(users_affected) AS BIGINT) AS sum_users_affected
FROM hist_traffic WHERE CAST(tod AS DATE) = DATE '{DAY}'""")
def hist_day_total(spark, sf):
    return H.day_total(Tables(spark, sf).hist_traffic, DAY)


@check("hist_month_avg", f"SELECT {_AVG3} FROM hist_traffic WHERE month(tod) = {MONTH}")
def hist_month_avg(spark, sf):
    return H.month_avg(Tables(spark, sf).hist_traffic, MONTH)


@check("hist_by_month", f"""
SELECT CAST(month(tod) AS INTEGER) AS month, {_AVG3} FROM hist_traffic GROUP BY month(tod)""")
def hist_by_month(spark, sf):
    return H.by_month(Tables(spark, sf).hist_traffic)


@check("hist_by_ymd", f"""
SELECT CAST(year(tod) AS INTEGER) AS year, CAST(month(tod) AS INTEGER) AS month, CAST(day(tod) AS INTEGER) AS day,
       {_AVG3} FROM hist_traffic GROUP BY year(tod), month(tod), day(tod)""")
def hist_by_ymd(spark, sf):
    return H.by_ymd(Tables(spark, sf).hist_traffic)


@check("hist_by_tod", f"SELECT tod, {_AVG3} FROM hist_traffic GROUP BY tod")
def hist_by_tod(spark, sf):
    return H.by_tod(Tables(spark, sf).hist_traffic)


@check("hist_by_md", f"""
SELECT CAST(month(tod) + day(tod) AS INTEGER) AS md, {_AVG3} FROM hist_traffic GROUP BY month(tod) + day(tod)""")
def hist_by_md(spark, sf):
    return H.by_md(Tables(spark, sf).hist_traffic)


@check("hist_by_route_location", """
SELECT route_num, location, users_total, users_affected,
       ROUND(AVG(CAST(users_total AS DOUBLE)), 6) AS avg_users_total,
       ROUND(AVG(CAST(users_affected AS DOUBLE)), 6) AS avg_users_affected
FROM hist_traffic GROUP BY route_num, location, users_total, users_affected ORDER BY route_num, location""")
def hist_by_route_location(spark, sf):
    return H.by_route_location(Tables(spark, sf).hist_traffic)


@check("hist_max_by_location", """
SELECT route_num, location, CAST(MAX(users_affected) AS BIGINT) AS affected
FROM hist_traffic GROUP BY route_num, location ORDER BY route_num, location LIMIT 10""")
def hist_max_by_location(spark, sf):
    return H.max_by_location(Tables(spark, sf).hist_traffic)


@check("hotspots_top10", """
SELECT route_num, location, CAST(SUM(users_affected) AS BIGINT) AS affected
FROM hist_day_time GROUP BY route_num, location ORDER BY affected DESC, route_num, location LIMIT 10""")
def hotspots_top10(spark, sf):
    return H.hotspots(Tables(spark, sf).hist_traffic)


@check("hist_month_self_join", f"""
SELECT CAST(month(h1.tod) AS INTEGER) AS month,
       COUNT(DISTINCT h1.rid) AS n_left, COUNT(DISTINCT h2.rid) AS n_right, COUNT(*) AS n_pairs,
       CAST(SUM(h1.users_total) AS BIGINT) AS pairs_sum_left_users_total,
       CAST(SUM(h2.users_total) AS BIGINT) AS pairs_sum_right_users_total
FROM (SELECT *, ROW_NUMBER() OVER () AS rid FROM hist_traffic) h1
JOIN (SELECT *, ROW_NUMBER() OVER () AS rid FROM hist_traffic WHERE month(tod) = {MONTH}) h2
  ON month(h1.tod) = month(h2.tod)
GROUP BY month(h1.tod)""")
def hist_month_self_join(spark, sf):
    return H.month_self_join(Tables(spark, sf).hist_traffic, MONTH)


@check("hist_vs_month_avg", f"""
SELECT CAST(month(h1.tod) AS INTEGER) AS month, h1.tod, h1.route_num, h1.users_total, h2.avg_users_total
FROM hist_traffic h1
JOIN (SELECT month(tod) AS m, ROUND(AVG(CAST(users_total AS DOUBLE)), 6) AS avg_users_total
      FROM hist_traffic GROUP BY month(tod)) h2 ON month(h1.tod) = h2.m
WHERE h2.m = {MONTH}""")
def hist_vs_month_avg(spark, sf):
    return H.vs_month_avg(Tables(spark, sf).hist_traffic, MONTH)


@check("hist_folded_daily", """
SELECT idate, CAST(SUM(users_total) AS BIGINT) AS sum_users_total, CAST(SUM(users_affected) AS BIGINT) AS sum_users_affected,
       ROUND(AVG(CAST(duration AS DOUBLE)), 6) AS avg_duration
FROM hist_day_time GROUP BY idate""")
def hist_folded_daily(spark, sf):
    return HP.daily_avg(Tables(spark, sf).hist_partials)


@check("hist_folded_by_month", f"""
SELECT CAST(month(tod) AS INTEGER) AS month, {_AVG3} FROM hist_traffic GROUP BY month(tod)""")
def hist_folded_by_month(spark, sf):
    return HP.by_month(Tables(spark, sf).hist_partials)


@check("hist_folded_hotspots", """
SELECT route_num, location, CAST(SUM(users_affected) AS BIGINT) AS affected
FROM hist_day_time GROUP BY route_num, location ORDER BY affected DESC, route_num, location LIMIT 10""")
def hist_folded_hotspots(spark, sf):
    return HP.hotspots(Tables(spark, sf).hist_partials)
