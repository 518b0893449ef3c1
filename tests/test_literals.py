"""Literal cases: lifecycle cycles, the cap, wire quirks, CSV quirks, upserts."""

import datetime as dt

from pyspark.sql import functions as F

from roadlens import schemas as S
from roadlens.operators import ingest as I
from roadlens.operators import lifecycle as L
from roadlens.operators import messages as M

T0 = dt.datetime(2024, 1, 1, 0, 0, 0)
INC_SCHEMA = "route_num int, loc int, ts timestamp_ntz, occur_clear int, duration int, seq bigint, batch timestamp_ntz"
POS_SCHEMA = "route_num int, loc int, user_id string, ts timestamp_ntz, seq bigint, batch timestamp_ntz"


def _mk(spark, script):
    """script: list of (hour, kind, payload) with kind I(loc) / C(duration) / U([locs])."""
    inc, pos, seq = [], [], 0
    for hour, kind, payload in script:
        b = T0 + dt.timedelta(hours=hour)
        seq += 1
        ts = b + dt.timedelta(seconds=seq)
        if kind == "I":
            inc.append((7, payload, ts, 1, 0, seq, b))
        elif kind == "C":
            inc.append((7, 3, ts, 0, payload, seq, b))
        else:
            for j, loc in enumerate(payload):
                seq += 1
                pos.append((7, loc, f"u{seq}", ts + dt.timedelta(milliseconds=j), seq, b))
    return spark.createDataFrame(inc, INC_SCHEMA), spark.createDataFrame(pos, POS_SCHEMA)


def _hist(spark, script):
    inc, pos = _mk(spark, script)
    return [r.asDict() for r in L.incident_lifecycle(inc, pos).orderBy("tod").collect()]


def _state(spark, script):
    inc, pos = _mk(spark, script)
    return L.lifecycle_state(inc, pos).collect()[0].asDict()


def test_plain_cycle(spark):
    h = _hist(spark, [(0, "I", 10), (0, "U", [11, 9, 13]), (1, "C", 7)])
    assert len(h) == 1
    assert (h[0]["users_total"], h[0]["users_affected"], h[0]["duration"], h[0]["location"]) == (3, 2, 7, 10)


def test_out_of_turn(spark):
    script = [(0, "C", 9), (0, "U", [5]), (1, "I", 10), (1, "I", 12), (1, "U", [11]), (2, "U", [20]),
              (3, "C", 5), (3, "C", 6)]
    h = _hist(spark, script)
    assert len(h) == 1
    assert (h[0]["location"], h[0]["users_total"], h[0]["users_affected"], h[0]["duration"]) == (10, 1, 1, 5)


def test_cumulative_totals(spark):
    cycle = [(0, "I", 10), (0, "U", [11, 9, 13]), (1, "C", 7)]
    again = [(h + 2, k, p) for h, k, p in cycle]
    h = _hist(spark, cycle + again)
    assert [r["users_total"] for r in h] == [3, 6]
    assert [r["incident_users"] for r in h] == [3, 3]


def test_location_zero_kept(spark):
    h = _hist(spark, [(0, "I", 0), (0, "U", [0, 1]), (1, "C", 5)])
    assert (h[0]["location"], h[0]["users_total"], h[0]["users_affected"]) == (0, 2, 1)


def test_state_after_open_incident(spark):
    st = _state(spark, [(0, "I", 4), (0, "U", [5, 6])])
    assert st["expect"] == L.EXPECT_CLEAR and st["location"] == 4
    assert st["incidents_reported"] - st["incidents_cleared"] == 1


def test_string_flag_is_a_clear(spark):
    df = spark.createDataFrame(
        [('{"incident_route_num":"3","incident_loc":"5","ts":"2024-01-01 00:00:01","occur_clear":"0",'
          '"accident_duration":"9"}',),
         ('{"incident_route_num":3,"incident_loc":5,"ts":"2024-01-01 00:00:02","occur_clear":1,'
          '"accident_duration":0}',)], "value string")
    rows = M.parse_incidents(M.parse_json(df, S.USER_ACCIDENT_SCHEMA)).orderBy("ts").collect()
    assert [r.occur_clear for r in rows] == [0, 1]
    assert rows[0].duration == 9 and rows[0].route_num == 3


def test_cap_and_clear_on_empty(spark):
    inc, _ = _mk(spark, [(0, "I", 1)] * 6 + [(1, "C", 5)])
    r = L.capped_incidents(inc).collect()[0]
    assert (r.active, r.reported, r.dropped, r.cleared, r.ignored) == (4, 5, 1, 1, 0)
    inc, _ = _mk(spark, [(0, "C", 5)])
    r = L.capped_incidents(inc).collect()[0]
    assert (r.active, r.cleared, r.ignored) == (0, 0, 1)


def test_cap_across_batches(spark):
    script = [(h, "I", 1) for h in range(7)] + [(8, "C", 5), (9, "C", 5)]
    inc, _ = _mk(spark, script)
    r = L.capped_incidents(inc).collect()[0]
    assert (r.active, r.reported, r.dropped, r.cleared) == (3, 5, 2, 2)


VIOL_HEADER = ("Date Of Stop,Time Of Stop,Agency,SubAgency,Description,Location,Latitude,Longitude,Accident,"
               "Belts,Personal Injury,Property Damage,Fatal,Commercial License,HAZMAT,Commercial Vehicle,Alcohol,"
               "Work Zone,State,VehicleType,Year,Make,Model,Color,Violation Type,Charge,Article,"
               "Contributed To Accident,Race,Gender,Driver City,Driver State,DL State,Arrest Type,Geolocation")


def _line(fields):
    return ",".join(fields)


def _base():
    f = ["09/24/2013", "17:11:00", "MCP", "3rd district", "DRIVING", "PARK RD", "38.98", "-77.09"]
    f += ["No"] * 10
    f += ["MD", "02 - Automobile", "2008", "FORD", "4S", "BLACK", "Citation", "21-201", "Transportation Article",
          "No", "WHITE", "F", "ROCKVILLE", "MD", "MD", "A - Marked Patrol", '"(38.98, -77.09)"']
    return f


def test_violation_literal_cases(spark):
    base = _base()
    yes_cases = base.copy()
    yes_cases[8], yes_cases[9], yes_cases[10], yes_cases[11] = "YES", "yes", "", "maybe"
    quoted = base.copy()
    quoted[4] = '"SPEED, 55"'
    split_comma = base.copy()
    split_comma[4] = '"A,B"'
    empty_text = base.copy()
    empty_text[2] = ""
    lines = [
        (0, VIOL_HEADER),
        (1, _line(base)),
        (2, _line(base[:-1]) + ","),        # one trailing comma -> padded
        (3, _line(base[:-2]) + ",,"),       # two trailing commas
        (4, _line(yes_cases)),
        (5, _line(quoted)),
        (6, _line(split_comma)),
        (7, _line(empty_text)),
        (8, _line(base[:10])),              # short line
        (9, _line(base + ["x", "y"])),      # long line
    ]
    df = spark.createDataFrame(lines, "id int, value string")
    out = {r.id: r for r in I.normalise_violations(df).collect()}
    assert 0 not in out                                   # header dropped
    assert out[1].geo_location == "(38.98  -77.09)"       # quoted ", " -> two blanks, quotes gone
    assert out[1].latitude == 38.98 and out[1].year == 2008 and out[1].accident is False
    assert out[2].geo_location is None and out[2].arrest_type == "A - Marked Patrol"
    assert out[3].arrest_type is None and out[3].dl_state == "MD"
    assert (out[4].accident, out[4].belts, out[4].personal_injury, out[4].property_damage) == (True, True, False, False)
    assert out[5].description == "SPEED  55"
    assert out[6].description == "A" and out[6].location == "B"      # quoted comma still splits
    assert out[7].agency is None
    assert out[8].belts is False and out[8].personal_injury is None and out[8].driver_state is None
    assert out[9].geo_location == "(38.98  -77.09)"


def test_violations_keep_header_option(spark):
    df = spark.createDataFrame([(VIOL_HEADER,)], "value string")
    assert I.normalise_violations(df, skip_header=False).count() == 1


def test_upsert_duplicate_key(spark):
    df = spark.createDataFrame(
        [(0, "2024-01-01 10:00:00", "a", 1), (0, "2024-01-01 10:00:00", "b", 2), (1, "2024-01-01 10:00:00", "c", 3),
         (None, "2024-01-01 10:00:00", "d", 4)],
        "query_type int, ts string, query_text string, seq int")
    out = {(r.query_type, r.ts): r.query_text for r in I.upsert_latest(df, ["query_type", "ts"], ["seq"]).collect()}
    assert out == {(0, "2024-01-01 10:00:00"): "b", (1, "2024-01-01 10:00:00"): "c"}


def test_empty_words_kept(spark):
    df = spark.createDataFrame([("a  b\nc",), ("",)], "value string")
    keys = sorted(r.key for r in I.distinct_words(df).collect())
    assert keys == ["Word:", "Word:a", "Word:b", "Word:c"]


def test_packed_users_line_with_many_positions(spark):
    df = spark.createDataFrame([("2 7 121 user3 2024-01-01 10:00:04 119 user8 2024-01-01 10:00:05",),
                                ("1 7 120 2024-01-01 10:00:00 1 0",), ("0 7 120 2024-01-01 10:00:09 0 9",)],
                               "value string")
    rows = M.unpack_messages(df).orderBy("ts").collect()
    assert [(r.msg_type, r.loc, r.user_id, r.duration) for r in rows] == [
        (1, 120, None, 0), (2, 121, "user3", None), (2, 119, "user8", None), (0, 120, None, 9)]


def test_itime_parity_pattern(spark):
    from roadlens.operators import history as H

    df = spark.createDataFrame([(dt.datetime(2016, 7, 30, 15, 4, 5),)], "tod timestamp_ntz").select(
        "tod", F.lit(1).alias("route_num"), F.lit(2).alias("location"), F.lit(3).alias("users_total"),
        F.lit(4).alias("users_affected"), F.lit(5).alias("duration"))
    r = H.day_time(df).collect()[0]
    assert (r.idate, r.itime, r.itime24) == ("2016-07-30", "03:07:05", "15:04:05")


def test_packed_lines_that_cannot_be_decoded(spark):
    lines = ["2 7 121 user3 2024-01-01 10:00:04 119 user8 2024-01-01", "1 7", "x", "", "1 a 3 2024-01-01 10:00:00 1 0",
             "2 7 b user1 2024-01-01 10:00:00", "0 7 3 2024-02-30 10:00:00 0 9", "9 7 3 2024-01-01 10:00:00 0 9", "2 7"]
    df = spark.createDataFrame(list(enumerate(lines)), "id int, value string")
    got = {}
    for r in M.unpack_messages(df).collect():
        got.setdefault(r.id, []).append((r.loc, r.problem))
    assert got[0] == [(121, None), (None, "cut")]
    assert [got[i][0][1] for i in range(1, 9)] == ["loc", "type", "type", "route", "loc", "ts", "type", "cut"]


def test_times_do_not_depend_on_the_session_zone(spark):
    """02:30 on the night clocks go forward exists in a TIMESTAMP_NTZ, whatever the zone."""
    from roadlens.operators import history as H
    from roadlens.streaming import queries as P

    text = "2024-03-10 02:30:00"
    out = []
    for zone in ("UTC", "America/New_York"):
        spark.conf.set("spark.sql.session.timeZone", zone)
        try:
            wire = spark.createDataFrame([("3", "5", text, "1", "0")], ["incident_route_num", "incident_loc", "ts", "occur_clear", "accident_duration"])
            parsed = M.parse_incidents(wire)
            back = M.incident_wire_json(parsed.withColumn("seq", F.lit(2))).collect()[0].value
            h = parsed.select(F.col("ts").alias("tod"), "route_num", F.lit(2).alias("location"), F.lit(3).alias("users_total"),
                              F.lit(4).alias("users_affected"), F.lit(5).alias("duration"))
            days = H.day_time(h).collect()[0]
            clock = parsed.withColumn("et", P.event_time("ts")).select(P.wall_clock("et").cast("string").alias("t")).collect()[0].t
            unpacked = M.unpack_messages(spark.createDataFrame([(f"1 3 5 {text} 1 0",)], "value string"))
            out.append((parsed.select(F.col("ts").cast("string")).collect()[0][0], back, days.idate, days.itime, days.itime24,
                        H.hist_text(h).collect()[0].tod_text, clock, unpacked.select(F.col("ts").cast("string")).collect()[0][0]))
        finally:
            spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert out[0] == out[1]
    assert out[0][0] == out[0][6] == out[0][7] == text and text in out[0][1]
    assert out[0][2:6] == ("2024-03-10", "02:03:00", "02:30:00", "2024-03-10 02:03:00")


def test_wire_text_that_is_no_time(spark):
    df = spark.createDataFrame([(t,) for t in ("2024-01-01", "2024-13-01 00:00:00", "2024-01-01T00:00:00", "x", None, "2024-01-01 00:00:00")], "ts string")
    assert df.select(M.ntz_of_text(F.col("ts")).alias("t")).where("t IS NOT NULL").count() == 1


def test_incident_counters_keep_missing_routes_apart(spark):
    inc, _ = _mk(spark, [(0, "I", 1), (0, "I", 2)])
    rows = {(r.route_num, r.is_total): r.incidents for r in M.incident_counters(
        inc.unionByName(inc.withColumn("route_num", F.lit(None).cast("int")))).collect()}
    assert rows == {(7, False): 2, (None, False): 2, (None, True): 4}


def test_bundle_rows_of_one_batch_are_one_bundle(spark):
    """A message log that holds a route's bundle of a batch in two rows."""
    b = [T0 + dt.timedelta(hours=h) for h in range(2)]
    rows = [
        (b[0], 0, 7, 1, b[0], 1, 10, 0, None, None), (b[0], 1, 7, 2, b[0], 2, None, None, 1, [(11, 1)]),
        (b[0], 1, 7, 2, b[0], 3, None, None, 2, [(9, 1), (11, 1)]), (b[1], 0, 7, 0, b[1], 4, 3, 6, None, None)]
    from roadlens.sources.streams import MESSAGE_LOG_SCHEMA

    h = L.lifecycle_from_messages(spark.createDataFrame(rows, MESSAGE_LOG_SCHEMA)).collect()
    assert [(r.users_total, r.users_affected, r.duration) for r in h] == [(3, 2, 6)]


def test_queries_see_the_queue_of_their_time(spark):
    from roadlens.operators import requests as R

    t = [T0 + dt.timedelta(seconds=s) for s in range(8)]
    rows = [(2, None, "a", 1), (4, 2, "b", 1), (4, 0, "c", 1), (2, None, "a", 1), (4, 2, "d", 1), (2, None, "a", 1), (4, 0, "e", 2), (2, None, "a", 1)]
    df = spark.createDataFrame([(k, s, u, r, 3, t[i], i, T0) for i, (k, s, u, r) in enumerate(rows)],
                               "req_type int, sub_req_type int, user_id string, route_num int, loc int, ts timestamp_ntz, seq long, batch timestamp_ntz")
    assert {r.seq for r in R.queries_on_incident_routes(df).collect()} == {3}


def test_metric_rows_without_values(spark):
    from roadlens.operators import dashboard as DB

    c = spark.createDataFrame([(3, None, 7)], "users_total long, users_affected long, route_num int")
    assert [tuple(r) for r in DB.metric_rows(c, ["users_total", "users_affected"]).collect()] == [("users_total", 3)]
    assert DB.metric_rows(c, ["nothing"]).collect() == []
    assert [tuple(r) for r in DB.route_metric_rows(c, ["users_total", "users_affected"]).collect()] == [("users_total_on_route_7", 3)]


def test_upsert_rejects_are_returned(spark):
    df = spark.createDataFrame([(0, "t", 1), (None, "t", 2), (1, None, 3)], "a int, b string, seq int")
    assert {(r.seq, r.missing_key) for r in I.upsert_rejects(df, ["a", "b"]).collect()} == {(2, "a"), (3, "b")}


def test_table_in_clustering_order(spark, scratch):
    df = spark.createDataFrame([("MD", c, n) for n, c in enumerate("dbacfe")] + [("VA", "z", 1)], "state string, city string, n int")
    I.write_ordered(df, f"{scratch}/t", "state", ["city"])
    back = spark.read.parquet(f"{scratch}/t").where("state = 'MD'")
    assert [r.city for r in back.collect()] == sorted("abcdef")
