"""Answers that are there while streams run: as-of impact counts, current state, folded history."""

import json
import os
import random
import time

import pytest
from pyspark.sql import functions as F

from roadlens import schemas as S
from roadlens.operators import history as H
from roadlens.operators import history_partials as HP
from roadlens.operators import joins as J
from roadlens.operators import messages as M
from roadlens.plans.tables import Tables
from roadlens.sources import streams as SRC
from roadlens.streaming import queries as P
from tests.test_streaming import _chunk_files, _rows

SF = "/root/testdata/sf0.001"


def _topic(folder, messages, files, close):
    os.makedirs(folder)
    random.Random(files).shuffle(messages)
    for k in range(files):
        with open(os.path.join(folder, f"{k:03d}.json"), "w") as fh:
            fh.writelines(json.dumps(m) + "\n" for m in messages[k::files])
        time.sleep(0.02)
    with open(os.path.join(folder, "999.json"), "w") as fh:
        fh.write(json.dumps(close) + "\n")


@pytest.mark.parametrize("files", [1, 6])
def test_asof_stream_equals_batch(spark, scratch, files):
    t, topics = Tables(spark, SF), os.path.join(scratch, "topics")
    text = "%Y-%m-%d %H:%M:%S"
    inc = [{"incident_route_num": str(r.route_num), "incident_loc": str(r.loc), "ts": r.ts.strftime(text), "occur_clear": str(r.occur_clear),
            "accident_duration": "0"} for r in t.incidents.collect()]
    pos = [{"user_route_num": str(r.route_num), "user_loc": str(r.loc), "user_id": r.user_id, "ts": r.ts.strftime(text)} for r in t.positions.collect()]
    far = "2050-01-01 00:00:00"
    _topic(os.path.join(topics, "user_accident"), inc, files, {"incident_route_num": "-1", "incident_loc": "0", "ts": far, "occur_clear": "1", "accident_duration": "0"})
    _topic(os.path.join(topics, "user_pos"), pos, files, {"user_route_num": "-1", "user_loc": "0", "user_id": "clock", "ts": far})

    def parsed(read):
        return M.parse_incidents(read("user_accident", S.USER_ACCIDENT_SCHEMA)), M.parse_positions(read("user_pos", S.USER_POS_SCHEMA))

    stream = P.asof_affected_stream(*parsed(lambda topic, schema: SRC.read_events(spark, topic, schema, path=topics, max_per_trigger=1)), "3000 days")
    q = stream.writeStream.format("memory").queryName(f"asof_{files}").trigger(availableNow=True).start()
    q.awaitTermination(300)
    got = P.asof_totals(spark.table(f"asof_{files}")).where("route_num >= 0")
    batch = parsed(lambda topic, schema: M.parse_json(spark.read.text(os.path.join(topics, topic)).withColumn("seq", F.xxhash64("value")), schema, keep_raw=True))
    batch = [df.withColumn("batch", F.window("ts", "1 hour").start).where("route_num >= 0") for df in batch]
    want = J.asof_affected_counts(batch[1], batch[0])
    cols = ["route_num", "day", "positions", "affected"]
    assert _rows(got, cols) == _rows(want, cols) and want.agg(F.sum("affected")).first()[0] > 0
    q.stop()


def test_current_state_from_the_checkpoint(spark, scratch):
    t = Tables(spark, SF)
    path, ck = _chunk_files(spark, scratch, t, "chunks", 9), os.path.join(scratch, "ck")
    q = (P.lifecycle_stream(SRC.read_chunks(spark, path, 1)).writeStream.format("parquet").option("path", os.path.join(scratch, "out"))
         .option("checkpointLocation", ck).trigger(availableNow=True).start())
    q.awaitTermination(300)
    cols = ["route_num", "expect", "location", "users_total", "users_affected", "incidents_reported", "incidents_cleared"]
    now = P.lifecycle_state_now(spark, ck).select(*cols)
    assert sorted(map(str, now.collect())) == sorted(map(str, t.lifecycle_state.select(*cols).collect())) and now.count() > 5


def test_folded_history_equals_the_rows(spark, scratch):
    h = Tables(spark, SF).hist_traffic.drop("day")
    odd = spark.createDataFrame([(None, 1, 2, 3)], "duration int, route_num int, location int, users_total long").select(
        F.expr("TIMESTAMP_NTZ'2024-01-02 03:04:05'").alias("tod"), "route_num", "location", "users_total",
        F.lit(None).cast("long").alias("users_affected"), "duration")
    h = h.unionByName(odd)
    path = os.path.join(scratch, "partials")
    for k in range(3):  # loads that share days
        HP.append(h.where(F.pmod(F.xxhash64("tod", "route_num"), F.lit(3)) == k), path, k)
    HP.append(h.where(F.pmod(F.xxhash64("tod", "route_num"), F.lit(3)) == 1), path, 1)  # a repeated load
    p = HP.read(spark, path)
    day = str(h.agg(F.max(F.to_date("tod"))).first()[0])
    month = h.agg(F.max(F.month("tod"))).first()[0]
    for name, args in (("daily", ()), ("daily_avg", ()), ("day_total", (day,)), ("month_avg", (month,)), ("by_month", ()), ("by_ymd", ()),
                       ("by_md", ()), ("max_by_location", ()), ("hotspots", ())):
        want, got = getattr(H, name)(h, *args), getattr(HP, name)(p, *args)
        assert got.columns == want.columns, name
        assert sorted(map(str, got.collect())) == sorted(map(str, want.collect())), name
    assert "PartitionFilters: [isnotnull(day" in HP.day_total(p, day)._jdf.queryExecution().executedPlan().toString()
