"""Stream = batch: the same rows fed as ordered files through Structured
Streaming (availableNow) give the batch operator's answer."""

import json
import os
import time

import pytest
from pyspark.sql import functions as F

SF_SMALL = "/root/testdata/sf0.001"
from roadlens import schemas as S
from roadlens.operators import ingest as I
from roadlens.operators import joins as J
from roadlens.plans.tables import Tables
from roadlens.sinks import writers as W
from roadlens.sources import driver as D
from roadlens.sources import streams as SRC
from roadlens.streaming import queries as P

def _run_to_memory(df, name, mode="append"):
    q = df.writeStream.format("memory").queryName(name).outputMode(mode).trigger(availableNow=True).start()
    q.awaitTermination(300)
    return q


def _rows(df, cols):
    return sorted(tuple(r[c] for c in cols) for r in df.select(*cols).collect())


def _json_value(c, v):
    if c == "ts":
        return v.strftime("%Y-%m-%d %H:%M:%S.%f")
    if isinstance(v, float):  # pandas widens nullable ints to float
        return None if v != v else int(v)
    return v


def _write_jsonl_by_day(df, path, cols):
    os.makedirs(path)
    pdf = df.toPandas()
    pdf["day"] = pdf["ts"].dt.date
    for i, (_, part) in enumerate(sorted(pdf.groupby("day"), key=lambda kv: kv[0])):
        with open(os.path.join(path, f"part-{i:05d}.json"), "w") as fh:
            for r in part.itertuples(index=False):
                rec = {c: _json_value(c, getattr(r, c)) for c in cols}
                fh.write(json.dumps(rec) + "\n")
        time.sleep(0.02)


def test_pageviews_stream_equals_batch(spark, scratch):
    ev = D.pageview_events(Tables(spark, SF_SMALL).events)
    _write_jsonl_by_day(ev, os.path.join(scratch, "pageviews"), ["site_id", "page_view", "ts"])
    schema = "site_id string, page_view string, ts string"
    raw = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).json(os.path.join(scratch, "pageviews"))
    stream = P.pageviews_stream(raw.withColumn("ts", F.to_timestamp_ntz("ts")), "1 hour", "1 hour")
    q = _run_to_memory(stream, "pv_stream")
    got = _rows(spark.table("pv_stream"), ["site_id", "window_end", "pageviews"])
    q.stop()
    batch = I.pageviews(ev)
    # append mode emits a window once the watermark (max event time - 1 hour) passes its end
    cutoff = ev.agg(F.max("ts")).collect()[0][0]
    want = _rows(batch.where(F.col("window_end") <= F.lit(cutoff) - F.expr("INTERVAL 1 HOUR")),
                 ["site_id", "window_end", "pageviews"])
    assert len(want) > 0 and got == want


def test_incident_join_stream_equals_batch(spark, scratch):
    t = Tables(spark, SF_SMALL)
    inc_cols = ["route_num", "loc", "ts", "occur_clear", "duration", "seq"]
    pos_cols = ["route_num", "loc", "user_id", "ts", "seq"]
    _write_jsonl_by_day(t.incidents.select(*inc_cols), os.path.join(scratch, "inc"), inc_cols)
    _write_jsonl_by_day(t.positions.select(*pos_cols), os.path.join(scratch, "pos"), pos_cols)
    inc = spark.readStream.schema(
        "route_num int, loc int, ts string, occur_clear int, duration int, seq bigint").json(
        os.path.join(scratch, "inc")).withColumn("ts", F.to_timestamp_ntz("ts"))
    pos = spark.readStream.schema("route_num int, loc int, user_id string, ts string, seq bigint").json(
        os.path.join(scratch, "pos")).withColumn("ts", F.to_timestamp_ntz("ts"))
    q = _run_to_memory(P.incident_user_join_stream(inc, pos), "join_stream")
    cols = ["batch", "route_num", "inc_seq", "pos_seq", "user_loc"]
    got = _rows(spark.table("join_stream"), cols)
    q.stop()
    want = _rows(J.incident_user_join(t.incidents, t.positions), cols)
    assert len(want) > 0 and got == want


def test_src_line_stream_distinct_words(spark, scratch):
    d = os.path.join(scratch, "lines")
    os.makedirs(d)
    with open(os.path.join(d, "a.txt"), "w") as fh:
        fh.write("the road is  closed\nthe road\n")
    with open(os.path.join(d, "b.txt"), "w") as fh:
        fh.write("open road\n")
    q = _run_to_memory(P.distinct_words_stream(SRC.read_lines(spark, d, max_files=1)), "words_stream")
    got = sorted(r.key for r in spark.table("words_stream").collect())
    q.stop()
    assert got == ["Word:", "Word:closed", "Word:is", "Word:open", "Word:road", "Word:the"]


def test_src_event_stream_and_sink_foreach_batch(spark, scratch):
    src = os.path.join(scratch, "topics", "user_pos")
    os.makedirs(src)
    with open(os.path.join(src, "m.json"), "w") as fh:
        fh.write('{"user_route_num": 3, "user_loc": "7", "user_id": "u1", "ts": "2024-01-01 00:00:01"}\n')
        fh.write('{"user_route_num": "4", "user_loc": 8, "user_id"\n')
    ev = SRC.read_events(spark, "user_pos", S.USER_POS_SCHEMA, path=os.path.join(scratch, "topics"))
    out = os.path.join(scratch, "snap")
    q = ev.writeStream.foreachBatch(W.snapshot_writer(out)).option(
        "checkpointLocation", os.path.join(scratch, "ck")).trigger(availableNow=True).start()
    q.awaitTermination(120)
    got = spark.read.parquet(out).orderBy("_malformed").collect()
    assert [(r.user_route_num, r._malformed) for r in got] == [("3", False), (None, True)]
    # replaying epoch 0 rewrites the same folder (idempotent)
    W.write_snapshot(spark.read.parquet(out).drop("epoch"), out + "2", 0)
    W.write_snapshot(spark.read.parquet(out).drop("epoch"), out + "2", 0)
    assert spark.read.parquet(out + "2").count() == 2


def test_upsert_stream_and_state_reset(spark, scratch):
    src = os.path.join(scratch, "ql")
    os.makedirs(src)
    for i, rows in enumerate([[(0, "t1", "a", 1), (0, "t1", "b", 2)], [(0, "t1", "c", 3), (1, "t1", "d", 4)]]):
        with open(os.path.join(src, f"{i}.json"), "w") as fh:
            for qt, ts, txt, seq in rows:
                fh.write(json.dumps({"query_type": qt, "ts": ts, "query_text": txt, "seq": seq}) + "\n")
        time.sleep(0.02)
    df = spark.readStream.schema("query_type int, ts string, query_text string, seq int").option(
        "maxFilesPerTrigger", 1).json(src)
    path = os.path.join(scratch, "qlog")
    q = P.upsert_stream(df, ["query_type", "ts"], ["seq"], path, os.path.join(scratch, "ck2"))
    q.awaitTermination(120)
    got = {(r.query_type, r.query_text) for r in P.read_upserted(spark, path, ["query_type", "ts"], ["seq"]).collect()}
    assert got == {(0, "c"), (1, "d")}
    snapshot = P.compact_upserts(spark, path, ["query_type", "ts"], ["seq"])
    assert spark.read.parquet(snapshot).count() == 2
    late = spark.createDataFrame([(0, "t1", "e", 9)], "query_type int, ts string, query_text string, seq int")
    W.write_snapshot(late, path, 7)  # a delta after the snapshot
    got = {(r.query_type, r.query_text) for r in P.read_upserted(spark, path, ["query_type", "ts"], ["seq"]).collect()}
    assert got == {(0, "e"), (1, "d")}
    assert P.compact_upserts(spark, path, ["query_type", "ts"], ["seq"]) != snapshot
    base = os.path.join(scratch, "state")
    assert W.latest_version(spark, base) is None
    v1 = W.reset(spark, base)
    v2 = W.reset(spark, base)
    os.utime(v1)  # the number tells, not the time
    assert W.latest_version(spark, base) == v2 != v1
    assert spark.read.parquet(v2 + "/data").count() == 0


def test_sink_peek(spark, scratch):
    d = os.path.join(scratch, "peek")
    os.makedirs(d)
    with open(os.path.join(d, "x.txt"), "w") as fh:
        fh.write("a\nb\nc\n")
    q = W.peek(SRC.read_lines(spark, d), n=2, checkpoint=os.path.join(scratch, "ckp"))
    q.awaitTermination(60)
    assert q.exception() is None


def test_sink_history_append(spark, scratch):
    t = Tables(spark, SF_SMALL)
    out = os.path.join(scratch, "hist")
    W.append_history(t.hist_traffic.drop("day"), out, 1)
    W.append_history(t.hist_traffic.drop("day"), out, 1)  # a repeated load replaces itself
    back = W.read_history(spark, out)
    assert back.count() == t.hist_traffic.count()
    day = back.where(F.col("day") == F.lit("2024-01-15").cast("date"))
    assert "PartitionFilters: [isnotnull(day" in day._jdf.queryExecution().explainString(
        spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))


def test_history_questions_prune_days(spark):
    from roadlens.operators import history as H

    plan = H.day_total(Tables(spark, SF_SMALL).hist_traffic, "2024-01-15")._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(day" in plan


def _incident_stream(spark, scratch, t):
    inc_cols = ["route_num", "loc", "ts", "occur_clear", "duration", "seq"]
    path = os.path.join(scratch, "inc_k3")
    _write_jsonl_by_day(t.incidents.select(*inc_cols), path, inc_cols)
    return spark.readStream.schema(
        "route_num int, loc int, ts string, occur_clear int, duration int, seq bigint").option(
        "maxFilesPerTrigger", 3).json(path).withColumn("ts", F.to_timestamp_ntz("ts"))


def test_capped_incidents_stream_equals_batch(spark, scratch):
    from roadlens.operators import lifecycle as L

    t = Tables(spark, SF_SMALL)
    q = _run_to_memory(P.capped_incidents_stream(_incident_stream(spark, scratch, t)), "capped_stream")
    rows = spark.table("capped_stream").collect()
    q.stop()
    latest = {}
    for r in rows:
        if r.route_num not in latest or r.n_msgs > latest[r.route_num].n_msgs:
            latest[r.route_num] = r
    got = sorted((k, v.active, v.reported, v.dropped, v.cleared, v.ignored) for k, v in latest.items())
    want = sorted(tuple(r) for r in L.capped_incidents(t.incidents).select(
        "route_num", "active", "reported", "dropped", "cleared", "ignored").collect())
    assert got == want


def _request_stream(spark, scratch, t):
    """Requests off the wire: JSON messages of ``user_traffic``, four days a trigger."""
    cols = {"req_type": "req_type", "sub_req_type": "sub_req_type", "user_id": "user_id", "route_num": "route_id", "loc": "location", "ts": "ts", "seq": "seq"}
    path = os.path.join(scratch, "topics", "user_traffic")
    _write_jsonl_by_day(t.requests.select(*[F.col(a).alias(b) for a, b in cols.items()]), path, list(cols.values()))
    schema = spark.createDataFrame([], ", ".join(f"{f} string" for f in [*S.USER_TRAFFIC_SCHEMA.fieldNames(), "seq"])).schema
    raw = SRC.read_events(spark, "user_traffic", schema, path=os.path.join(scratch, "topics"), max_per_trigger=4)
    # files carry microseconds; the wire format has seconds
    from roadlens.operators import messages as M

    rows = M.parse_requests(raw.withColumn("full_ts", F.col("ts")).withColumn("ts", F.substring("ts", 1, 19)))
    return rows.withColumns({"ts": F.to_timestamp_ntz("full_ts"), "seq": F.col("seq").cast("long"), "batch": F.window(F.to_timestamp_ntz("full_ts"), "1 hour").start})


def test_report_state_stream_equals_batch(spark, scratch):
    from roadlens.operators import requests as R

    t = Tables(spark, SF_SMALL)
    q = _run_to_memory(P.report_state_stream(_request_stream(spark, scratch, t)), "report_stream")
    got = {r.seq for r in P.open_reports(spark.table("report_stream")).collect()}
    q.stop()
    want = {r.seq for r in R.report_state(t.requests).select("seq").collect()}
    assert want and got == want


def test_request_counters_and_sessions_stream_equal_batch(spark, scratch):
    from roadlens.operators import requests as R

    t = Tables(spark, SF_SMALL)
    req = _request_stream(spark, scratch, t)
    q = _run_to_memory(P.call_counters_stream(req), "calls_stream", "complete")
    assert _rows(spark.table("calls_stream"), ["kind", "calls"]) == _rows(R.call_counters(t.requests), ["kind", "calls"])
    q.stop()
    q = _run_to_memory(P.sessions_stream(req), "sessions_stream")
    cols = ["user_id", "route_num", "loc", "register_ts", "signoff_ts"]
    want = _rows(R.sessions(t.requests).where("signoff_ts IS NOT NULL"), cols)
    assert want and _rows(spark.table("sessions_stream"), cols) == want
    q.stop()


def test_incident_table_stream_equals_batch(spark, scratch):
    from roadlens.operators import requests as R

    t = Tables(spark, SF_SMALL)
    path = os.path.join(scratch, "incident_table")
    P.incident_table_stream(_request_stream(spark, scratch, t), path, os.path.join(scratch, "ck_it")).awaitTermination(120)
    cols = ["route_id", "location", "user_id", "incident_type", "ts"]
    want = _rows(R.incident_table_state(t.requests), cols)
    assert want and _rows(P.read_incident_table(spark, path), cols) == want


def test_publish_keyed_files(spark, scratch):
    from roadlens.operators import messages as M

    t = Tables(spark, SF_SMALL)
    w = M.publish_keyed(M.position_wire_json(t.positions), F.col("route_num"))
    W.publish_events(w, "user_pos", path=scratch)
    back = spark.read.text(os.path.join(scratch, "user_pos"))
    assert back.count() == t.positions.count()
    keys = {r.key for r in back.select("key").distinct().collect()}
    assert keys <= set(range(S.PUBLISH_KEY_SPACE))


def test_lifecycle_from_message_log_equals_tables(spark):
    from roadlens.operators import lifecycle as L

    t = Tables(spark, SF_SMALL)
    cols = ["tod", "route_num", "location", "users_total", "users_affected", "duration", "incident_users",
            "incident_affected", "occur_ts"]
    log = P.message_rows(t.incidents, t.positions)
    assert _rows(L.lifecycle_from_messages(log), cols) == _rows(t.hist_full, cols)


HIST_COLS = ["tod", "route_num", "location", "users_total", "users_affected", "duration", "incident_users",
             "incident_affected", "occur_ts"]


def _wire(t, with_seq):
    acc = [(r.ts, {"incident_route_num": str(r.route_num), "incident_loc": r.loc, "ts": r.ts.strftime("%Y-%m-%d %H:%M:%S"),
                   "occur_clear": str(r.occur_clear), "accident_duration": r.duration, "seq": str(r.seq)}) for r in t.incidents.collect()]
    pos = [(r.ts, {"user_route_num": r.route_num, "user_loc": str(r.loc), "user_id": r.user_id,
                   "ts": r.ts.strftime("%Y-%m-%d %H:%M:%S"), "seq": str(r.seq)}) for r in t.positions.collect()]
    # one later position closes every batch before it
    pos.append((max(x[0] for x in pos), {"user_route_num": 99, "user_loc": 1, "user_id": "z", "ts": "2024-06-01 00:00:00", "seq": "0"}))
    for _, m in acc + pos:
        if not with_seq:
            m.pop("seq")
    return {"user_accident": sorted(acc, key=lambda x: x[0]), "user_pos": sorted(pos, key=lambda x: x[0])}


def _write_topics(messages, topics, files, bad=()):
    """Each topic in ``files`` files in time order; ``bad`` lines go into the middle one."""
    for topic, rows in messages.items():
        os.makedirs(os.path.join(topics, topic))
        size = -(-len(rows) // files)
        for k in range(files):
            with open(os.path.join(topics, topic, f"part-{k}.json"), "w") as fh:
                fh.writelines(json.dumps(m) + "\n" for _, m in rows[k * size:(k + 1) * size])
                if k == files // 2:
                    fh.writelines(x + "\n" for topic_of, x in bad if topic_of == topic)
            time.sleep(0.02)


def _schemas(with_seq):
    from pyspark.sql.types import StringType, StructField, StructType

    more = [StructField("seq", StringType())] if with_seq else []
    return {"accident_schema": StructType(list(S.USER_ACCIDENT_SCHEMA.fields) + more), "position_schema": StructType(list(S.USER_POS_SCHEMA.fields) + more)}


def _batch_history(spark, topics, schemas):
    """The batch lifecycle over the same wire messages, by the same rule of what can be used."""
    from roadlens.operators import lifecycle as L
    from roadlens.operators import messages as M

    def rows(topic, schema, kind):
        lines = spark.read.text(os.path.join(topics, topic))
        if "seq" not in schema.fieldNames():
            lines = lines.withColumn("seq", F.xxhash64("value"))
        good = P.domain_rows(M.parse_json(lines, schema, keep_raw=True), kind).where("problem IS NULL AND route_num <> 99")
        return good.withColumn("user_id", F.lit("u")).withColumn("batch", F.window("ts", "1 hour").start)

    return L.incident_lifecycle(rows("user_accident", schemas["accident_schema"], "incident"), rows("user_pos", schemas["position_schema"], "position"))


BAD = [
    ("user_accident", '{"incident_route_num": 3, "incident_loc": 4, "ts": "2024-01-09 00:00:01", "occur_clear": "abc"}'),
    ("user_accident", '{"incident_route_num": 3, "incident_loc": 4, "ts": "2024-01-09 00:00:01", "occur_clear": 2}'),
    ("user_accident", '{"incident_route_num": 3, "incident_loc": null, "ts": "2024-01-09 00:00:02", "occur_clear": 1}'),
    ("user_accident", '{"incident_route_num": "x", "incident_loc": 4, "ts": "2024-01-09 00:00:02", "occur_clear": 1}'),
    ("user_pos", '{"user_route_num": 3, "user_loc": 4, "user_id": "u", "ts": "yesterday"}'),
    ("user_pos", '{"user_route_num": 3, "us'),
]


@pytest.mark.parametrize("files,max_files,with_seq", [(1, None, True), (5, 1, True), (5, 2, False), (5, None, False)])
def test_incident_flow_end_to_end(spark, scratch, files, max_files, with_seq):
    """Topics -> closed batches -> lifecycle state -> history, equal to the batch
    lifecycle however the messages fall into files and triggers; what cannot be
    used is in the rejects, by problem."""
    topics, out, ck = (os.path.join(scratch, x) for x in ("topics", "out", "ck"))
    _write_topics(_wire(Tables(spark, SF_SMALL), with_seq), topics, files, BAD)
    schemas = _schemas(with_seq) if with_seq else {"accident_schema": S.USER_ACCIDENT_SCHEMA, "position_schema": S.USER_POS_SCHEMA}
    # files of one topic may run ahead of the other's: the watermark waits for a month
    streams = P.start_incident_streams(spark, out, ck, topics_dir=topics, max_files=max_files, watermark="31 days", **schemas)
    streams.consumer.awaitTermination(300)
    streams.rejects.awaitTermination(300)
    want = _rows(_batch_history(spark, topics, schemas), HIST_COLS)
    got = _rows(spark.read.parquet(os.path.join(out, "history")), HIST_COLS)
    assert len(want) > 10 and got == want
    rejects = spark.read.parquet(os.path.join(out, "rejects"))
    assert sorted((r.kind, r.problem) for r in rejects.collect()) == sorted(
        [("incident", "occur_clear")] * 2 + [("incident", "loc"), ("incident", "route"), ("position", "ts"), ("position", "malformed")])
    assert {r.message for r in rejects.collect()} == {x for _, x in BAD}


def _chunk_rows(spark, t):
    from roadlens.operators import lifecycle as L

    return L.chunk_summaries(t.incidents, t.positions).select("route_num", "batch", "fi", "fc", "fic", "n_pos", "hist")


def _chunk_files(spark, scratch, t, name, per_file_days):
    """A chunk log: every file holds whole days, in time order."""
    path = os.path.join(scratch, name)
    os.makedirs(path)
    days = sorted(r[0] for r in _chunk_rows(spark, t).select(F.to_date("batch")).distinct().collect())
    for k in range(0, len(days), per_file_days):
        part = _chunk_rows(spark, t).where(F.to_date("batch").between(days[k], days[min(k + per_file_days, len(days)) - 1]))
        tmp = os.path.join(scratch, f"{name}-tmp-{k}")
        part.coalesce(1).write.parquet(tmp)
        src = next(f for f in os.listdir(tmp) if f.startswith("part-"))
        os.rename(os.path.join(tmp, src), os.path.join(path, f"{k:05d}.parquet"))
        time.sleep(0.02)
    return path


@pytest.mark.parametrize("max_files", [1, 2, None])
def test_lifecycle_stream_and_replayed_epochs(spark, scratch, max_files):
    """1, 2 or all files per trigger, and files that come a second time."""
    import shutil

    t = Tables(spark, SF_SMALL)
    path = _chunk_files(spark, scratch, t, "chunks", 9)
    shutil.copy(os.path.join(path, "00000.parquet"), os.path.join(path, "99990.parquet"))  # a replay
    name = f"hist_{max_files}"
    q = _run_to_memory(P.lifecycle_stream(SRC.read_chunks(spark, path, max_files)), name)
    assert _rows(spark.table(name), HIST_COLS) == _rows(t.hist_full, HIST_COLS)
    q.stop()
    q = _run_to_memory(P.route_counters_stream(SRC.read_chunks(spark, path, max_files)), name + "_c")
    now = spark.table(name + "_c").groupBy("route_num").agg(F.max_by(F.struct("expect", "location", "users_total", "users_affected", "incidents_reported", "incidents_cleared"), "batch").alias("s")).select("route_num", "s.*")
    cols = ["route_num", "expect", "location", "users_total", "users_affected", "incidents_reported", "incidents_cleared"]
    assert sorted(map(str, now.select(*cols).collect())) == sorted(map(str, t.lifecycle_state.select(*cols).collect()))
    q.stop()


def test_chunk_stream_equals_batch_summaries(spark, scratch):
    """Every closed batch, whatever the triggers: the same row as the batch summary."""
    t = Tables(spark, SF_SMALL)
    inc = t.incidents.select("route_num", "loc", "ts", "occur_clear", "duration", "seq", F.lit("incident").alias("kind"))
    pos = t.positions.select("route_num", "loc", "ts", F.lit(None).cast("int").alias("occur_clear"), F.lit(None).cast("int").alias("duration"), "seq", F.lit("position").alias("kind"))
    src = os.path.join(scratch, "domain")
    rows = inc.unionByName(pos)
    for k, (lo, hi) in enumerate([(1, 10), (11, 20), (21, 31)]):
        rows.where(F.dayofmonth("ts").between(lo, hi)).coalesce(1).write.mode("append").parquet(src)
        time.sleep(0.05)
    stream = spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 1).parquet(src)
    out = os.path.join(scratch, "chunklog")
    P.chunk_log_query(P.chunk_stream(stream, "1 hour", "2 hours"), out, os.path.join(scratch, "ck_ch")).awaitTermination(200)
    end = rows.agg(F.max("ts")).collect()[0][0]
    closed = _chunk_rows(spark, t).where(F.col("batch") + F.expr("INTERVAL 1 HOUR") <= F.lit(end) - F.expr("INTERVAL 2 HOURS"))

    def plain(df):
        return sorted(str(r) for r in df.withColumn("hist", F.array_sort(F.coalesce("hist", F.array().cast("array<struct<loc:int,n:bigint>>")))).collect())

    got = spark.read.schema(SRC.CHUNK_LOG_SCHEMA).parquet(out)
    assert closed.count() > 100 and plain(got) == plain(closed)
    from roadlens.operators import lifecycle as L

    assert _rows(L.lifecycle_from_chunks(got), HIST_COLS) == _rows(L.lifecycle_from_chunks(closed), HIST_COLS)


def test_pageviews_and_querylog_from_the_wire(spark, scratch):
    """Wire messages of both topics through ``read_events`` and their parsers."""
    from roadlens.operators import messages as M

    topics = os.path.join(scratch, "topics")
    t = Tables(spark, SF_SMALL)
    for topic, df in (("pageviews", D.pageview_events(t.events)), ("querylog", D.querylog_events(t.events).drop("seq"))):
        os.makedirs(os.path.join(topics, topic))
        with open(os.path.join(topics, topic, "m.json"), "w") as fh:
            for r in df.collect():
                fh.write(json.dumps({k: v.strftime("%Y-%m-%d %H:%M:%S") if k == "ts" else v for k, v in r.asDict().items()}) + "\n")
    pv = M.parse_pageviews(SRC.read_events(spark, "pageviews", S.PAGEVIEW_SCHEMA, path=topics))
    q = _run_to_memory(pv.groupBy("site_id").count(), "pv_wire", "complete")
    want = D.pageview_events(t.events).groupBy("site_id").count()
    assert _rows(spark.table("pv_wire"), ["site_id", "count"]) == _rows(want, ["site_id", "count"])
    q.stop()
    ql = M.parse_querylog(SRC.read_events(spark, "querylog", S.QUERYLOG_SCHEMA, path=topics)).select("query_type", "ts", "query_text", "seq")
    path = os.path.join(scratch, "ql_wire")
    P.upsert_stream(ql, ["query_type", "ts"], ["seq"], path, os.path.join(scratch, "ck_ql")).awaitTermination(120)
    got = P.read_upserted(spark, path, ["query_type", "ts"], ["seq"])
    want = I.upsert_latest(D.querylog_events(t.events), ["query_type", "ts"], ["seq"])
    assert _rows(got, ["query_type", "ts", "query_text"]) == _rows(want, ["query_type", "ts", "query_text"])


def test_three_run_firsts_of_a_slice_are_enough(spark):
    """Any mix of incidents and clears in slices: the kept messages give the batch's own first ones."""
    import itertools

    from roadlens.streaming.queries import _first_of_runs

    cases = [[flags[:k], flags[k:]] for n in (4, 6) for flags in itertools.product((0, 1), repeat=n) for k in (1, n // 2, n - 1)]
    rows = [(c, s, [(c * 100 + s * 10 + i, f) for i, f in enumerate(part)]) for c, case in enumerate(cases) for s, part in enumerate(case)]
    df = spark.createDataFrame(rows, "c int, s int, m array<struct<ts:int,occur_clear:int>>")
    kept = df.groupBy("c").agg(F.flatten(F.collect_list(F.slice(_first_of_runs(F.col("m")), 1, 3))).alias("m")).select("c", _first_of_runs(F.col("m")).alias("m"))

    def three(messages):
        fi = next((t for t, f in messages if f == 1), None)
        fc = next((t for t, f in messages if f == 0), None)
        return fi, fc, next((t for t, f in messages if f == 1 and fc is not None and t > fc), None)

    got = {r.c: three([(m.ts, m.occur_clear) for m in r.m]) for r in kept.collect()}
    want = {c: three([(c * 100 + s * 10 + i, f) for s, part in enumerate(case) for i, f in enumerate(part)]) for c, case in enumerate(cases)}
    assert got == want
