"""Late messages are kept: on-time + late + rejected = input, by content."""

import json
import os
import time

from pyspark.sql import functions as F

from roadlens import schemas as S
from roadlens.operators import lifecycle as L
from roadlens.operators import messages as M
from roadlens.streaming import queries as P


def _position(k, minute):
    return {"user_route_num": str(k % 2), "user_loc": str(5 + k % 5), "user_id": f"u{k}", "ts": f"2024-01-01 {minute // 60:02d}:{minute % 60:02d}:{k % 60:02d}"}


def _incident(route, flag, minute):
    return {"incident_route_num": str(route), "incident_loc": "4", "ts": f"2024-01-01 {minute // 60:02d}:{minute % 60:02d}:00", "occur_clear": str(flag),
            "accident_duration": "7"}


def test_on_time_late_and_rejected_make_the_input(spark, scratch):
    topics, out, ck = (os.path.join(scratch, x) for x in ("topics", "out", "ck"))
    files = {"user_pos": [], "user_accident": []}
    for step in range(8):  # an hour of positions a file; some of the file come hours late, some are broken
        hour = step * 60
        files["user_pos"].append([json.dumps(_position(step * 40 + k, hour + k)) for k in range(30)]
                                 + [json.dumps(_position(step * 40 + 30 + k, max(0, hour - 300 + k))) for k in range(4)]
                                 + ['{"user_route_num": "1", "user_lo', json.dumps({"user_route_num": "1", "user_loc": "3", "user_id": "x", "ts": f"at {step}"})])
        files["user_accident"].append([json.dumps(_incident(r, f, hour + m)) for r in (0, 1) for f, m in ((1, 2), (0, 40))]
                                      + [json.dumps(_incident(0, 1, max(0, hour - 290)))])
    for topic, parts in files.items():
        os.makedirs(os.path.join(topics, topic))
        for k, lines in enumerate(parts):
            with open(os.path.join(topics, topic, f"{k}.json"), "w") as fh:
                fh.writelines(x + "\n" for x in lines)
            time.sleep(0.02)
    streams = P.start_incident_streams(spark, out, ck, topics_dir=topics, max_files=1, watermark="90 minutes", keep_late=True)
    streams.consumer.awaitTermination(300)
    streams.rejects.awaitTermination(300)
    log = spark.read.schema("kind string, value string, seq bigint, late boolean").parquet(os.path.join(out, "messages"))
    late = log.where("late").select("value")
    rejected = spark.read.parquet(os.path.join(out, "rejects")).select(F.col("message").alias("value"))
    on_time = log.where("NOT late").select("value").exceptAll(rejected)
    sent = sorted(x for parts in files.values() for lines in parts for x in lines)
    got = [sorted(r["value"] for r in df.collect()) for df in (on_time, late, rejected)]
    assert sorted(sum(got, [])) == sent and all(got)
    old = {x for step in range(8) for x in files["user_pos"][step][30:34] if step >= 5}
    assert old <= set(got[1]) and len(got[2]) == 16

    # nothing that was admitted was dropped below: the history is the batch history of the on-time messages
    def rows(topic, schema, kind):
        lines = spark.createDataFrame([(x,) for x in got[0]], "value string").where(F.col("value").contains("incident_loc" if kind == "incident" else "user_loc"))
        return P.domain_rows(M.parse_json(lines.withColumn("seq", F.xxhash64("value")), schema, keep_raw=True), kind).withColumn(
            "batch", F.window("ts", "1 hour").start)

    inc, pos = rows("user_accident", S.USER_ACCIDENT_SCHEMA, "incident"), rows("user_pos", S.USER_POS_SCHEMA, "position")
    want = L.incident_lifecycle(inc, pos.withColumn("user_id", F.lit("u")))
    closed = spark.read.parquet(os.path.join(out, "chunks")).agg(F.max("batch")).first()[0]
    cols = ["tod", "route_num", "location", "users_total", "users_affected", "duration"]
    history = spark.read.parquet(os.path.join(out, "history"))
    want = want.where(F.col("tod") < F.lit(closed) + F.expr("INTERVAL 1 HOUR"))
    assert sorted(map(tuple, history.select(*cols).collect())) == sorted(map(tuple, want.select(*cols).collect())) and history.count() >= 6
