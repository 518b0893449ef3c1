"""The topic log: offsets, restarts, retried tasks and aborted batches."""

import json
import os
import shutil
from collections import Counter

import pytest
from pyspark.sql import functions as F

from roadlens import schemas as S
from roadlens.operators import messages as M
from roadlens.sinks import writers as W
from roadlens.sources import streams as SRC
from roadlens.sources import topic_log as TL


def _messages(spark, a, b):
    return spark.range(a, b, numPartitions=3).select(
        F.when(F.col("id") % 10 == 0, None).otherwise((F.col("id") % 7).cast("string")).alias("key"),
        F.concat(F.lit('line "'), F.col("id").cast("string"), F.lit('"\né')).alias("value"))


def _append(spark, path, a, b, **options):
    TL.register(spark)
    _messages(spark, a, b).write.format("topiclog").options(path=path, topic="t", partitions=4, **options).mode("append").save()


def _read(spark, path, out, **options):
    TL.register(spark)
    q = (spark.readStream.format("topiclog").options(path=path, topic="t", **options).load()
         .writeStream.format("parquet").option("path", out + "/rows").option("checkpointLocation", out + "/ck")
         .trigger(processingTime="0 seconds").start())
    q.processAllAvailable()
    progress = [(p["batchId"], p["numInputRows"]) for p in q.recentProgress if p["numInputRows"]]
    q.stop()
    return progress


def _rows(spark, out):
    return [tuple(r) for r in spark.read.parquet(out + "/rows").select("key", "value", "partition", "offset").collect()]


@pytest.mark.parametrize("limit", [0, 1, 2])
def test_each_message_once_over_restarts(spark, scratch, limit):
    path, out = os.path.join(scratch, "log"), os.path.join(scratch, "out")
    options = {"group": "g", **({"maxCommitsPerTrigger": limit} if limit else {})}
    for k in range(5):
        _append(spark, path, k * 100, (k + 1) * 100)
    first = _read(spark, path, out, **options)
    if limit:
        assert max(n for _, n in first) <= 100 * limit
    for k in range(5, 11):
        _append(spark, path, k * 100, (k + 1) * 100)
    again = _read(spark, path, out, **options)  # restarted from its checkpoint
    if limit:
        assert max(n for _, n in again) <= 100 * limit and len(again) > 1
    rows = _rows(spark, out)
    assert sorted(r[1] for r in rows) == sorted(r["value"] for r in _messages(spark, 0, 1100).collect())
    # offsets are dense in each partition, and a key stands in one partition
    for p in range(4):
        assert sorted(r[3] for r in rows if r[2] == p) == list(range(sum(r[2] == p for r in rows)))
    assert all(len({r[2] for r in rows if r[0] == str(k)}) == 1 for k in range(7))


def test_a_query_that_fails_reads_the_batch_again(spark, scratch):
    path, out = os.path.join(scratch, "log"), os.path.join(scratch, "out")
    for k in range(4):
        _append(spark, path, k * 10, (k + 1) * 10)
    TL.register(spark)
    bad, seen = {"on": True}, []

    def batch(df, epoch):
        values = [r["value"] for r in df.collect()]
        if bad["on"] and epoch == 1:
            raise RuntimeError("killed")
        seen.extend((epoch, v) for v in values)

    def start():
        return (spark.readStream.format("topiclog").options(path=path, topic="t", maxCommitsPerTrigger=1, group="g").load()
                .writeStream.foreachBatch(batch).option("checkpointLocation", out).trigger(processingTime="0 seconds").start())

    q = start()
    with pytest.raises(Exception, match="killed"):
        q.processAllAvailable()
    bad["on"] = False
    q = start()
    q.processAllAvailable()
    q.stop()
    assert Counter(v for _, v in seen) == Counter(r["value"] for r in _messages(spark, 0, 40).collect())


def test_retried_tasks_leave_one_copy_and_abort_none(spark, scratch):
    path = os.path.join(scratch, "log")
    options = {"path": path, "topic": "t", "partitions": "2", "writer": "w"}
    rows = [{"key": str(k % 3), "value": f"v{k}"} for k in range(9)]
    w = TL.StreamWriter(options)
    lost = w.write(iter(rows))  # an attempt whose executor went away
    good = w.write(iter(rows))
    w.commit([good], 0)
    w.commit([w.write(iter(rows))], 0)  # the batch once more, after a restart
    aborted = w.write(iter(rows))
    w.abort([aborted, None], 1)
    store = TL.Store(path, "t")
    assert store.last_commit() == 0 and sum(store.commit(0)["ends"].values()) == 9
    assert all(not os.path.exists(os.path.join(path, "t", n)) for _, n, _ in aborted.segments)
    out = os.path.join(scratch, "out")
    _read(spark, path, out)
    assert sorted(r[1] for r in _rows(spark, out)) == sorted(r["value"] for r in rows)
    assert lost.segments  # its files may stay, but no commit names them

    def breaks():
        yield rows[0]
        raise OSError("lost")

    with pytest.raises(OSError):
        w.write(breaks())
    assert store.last_commit() == 0


def test_publish_stream_replays_its_last_batch(spark, scratch):
    """The sink commits, then the query dies before Spark notes it: the batch comes again."""
    src, path, ck = (os.path.join(scratch, x) for x in ("src", "log", "ck"))
    os.makedirs(src)
    for k in range(3):
        with open(os.path.join(src, f"{k}.json"), "w") as fh:
            fh.writelines(json.dumps({"key": str(i % 5), "value": f"{k}:{i}"}) + "\n" for i in range(50))
    stream = spark.readStream.schema("key string, value string").option("maxFilesPerTrigger", 1).json(src)
    W.publish_stream(stream, "t", path, ck, "w").awaitTermination(120)
    commits = sorted(os.listdir(os.path.join(ck, "commits")), key=lambda n: int(n) if n.isdigit() else -1)
    for name in (commits[-1], f".{commits[-1]}.crc"):
        shutil.move(os.path.join(ck, "commits", name), os.path.join(scratch, "gone" + name))
    W.publish_stream(stream, "t", path, ck, "w").awaitTermination(120)
    out = os.path.join(scratch, "out")
    _read(spark, path, out)
    assert sorted(r[1] for r in _rows(spark, out)) == sorted(f"{k}:{i}" for k in range(3) for i in range(50))


def test_events_from_a_topic_log(spark, scratch):
    """Published positions come back through ``read_events`` with (partition, offset) as their order."""
    path = os.path.join(scratch, "log")
    rows = [{"user_route_num": "3", "user_loc": str(k), "user_id": f"u{k}", "ts": f"2024-01-01 00:00:{k:02d}"} for k in range(40)]
    for half in (rows[:20], rows[20:]):
        df = spark.createDataFrame([("3", json.dumps(m)) for m in half], "key string, value string").coalesce(1)
        W.publish_events(df, "user_pos", sink="log", path=path)
    pos = M.parse_positions(SRC.read_events(spark, "user_pos", S.USER_POS_SCHEMA, "log", path, max_per_trigger=1, group="g"))
    q = pos.writeStream.format("memory").queryName("log_pos").trigger(processingTime="0 seconds").start()
    q.processAllAvailable()
    q.stop()
    got = [(r.user_id, r.loc) for r in spark.table("log_pos").orderBy("seq").collect()]
    assert got == [(f"u{k}", k) for k in range(40)]
