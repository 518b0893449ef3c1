"""The keyed table: whatever a dead writer leaves, readers see the last complete state."""

import os
import random
import shutil

import pytest
from pyspark.sql import functions as F

from roadlens.operators import ingest as I
from roadlens.sinks import keyed_table as KT

SCHEMA = "k int, part string, o1 int, o2 int, value string"
KEYS, ORDER = ["k", "part"], ["o1", "o2"]


def _rows(seed, n=200, keys=40):
    r = random.Random(seed)
    out = [(r.choice([None, *range(keys)]), r.choice(["a", "b"]), r.choice([None, *range(50)]), seed * 1000 + i, f"{seed}:{i}") for i in range(n)]
    return out


def _plain(rows):
    best = {}
    for k, p, a, b, v in rows:
        if None not in (k, p, a, b) and ((k, p) not in best or (a, b) > best[k, p][:2]):
            best[k, p] = (a, b, v)
    return sorted((*key, *row) for key, row in best.items())


def _read(spark, path):
    return sorted(tuple(r) for r in KT.read(spark, path, KEYS, ORDER).select("k", "part", "o1", "o2", "value").collect())


def _delta(spark, path, epoch, rows):
    KT.write_delta(spark.createDataFrame(rows, SCHEMA), KEYS, ORDER, path, epoch)


def test_stored_superseded_and_rejected_make_the_input(spark, scratch):
    path, written = os.path.join(scratch, "t"), []
    for epoch in range(3):
        written += (rows := _rows(epoch))
        _delta(spark, path, epoch, rows)
        _delta(spark, path, epoch, rows)  # a replay
    assert _read(spark, path) == _plain(written)
    rejects = spark.read.parquet(os.path.join(path, "rejects"))
    bad = [r for r in written if None in r]
    assert sorted(r["value"] for r in rejects.collect()) == sorted(r[4] for r in bad) and len(bad) > 5
    assert {r["missing_key"] for r in rejects.collect()} == {"k", "o1"}


def test_a_null_order_is_a_reject_not_a_loss(spark):
    df = spark.createDataFrame([(1, "a", None, 1, "x"), (2, "a", 1, 1, "y")], SCHEMA)
    assert [r["k"] for r in I.upsert_latest(df, KEYS, ORDER).collect()] == [2]
    assert [(r["k"], r["missing_key"]) for r in I.upsert_rejects(df, KEYS, ORDER).collect()] == [(1, "o1")]


@pytest.mark.parametrize("point", ["data without manifest", "half the data", "manifest not complete", "delta not complete", "all done"])
def test_a_writer_killed_at_any_point(spark, scratch, point):
    path, written = os.path.join(scratch, "t"), []
    for epoch in range(2):
        written += (rows := _rows(epoch))
        _delta(spark, path, epoch, rows)
    KT.compact(spark, path, KEYS, ORDER, buckets=8)
    written += (rows := _rows(2))
    _delta(spark, path, 2, rows)
    before = _plain(written)
    if point == "delta not complete":
        _delta(spark, path, 3, _rows(3))
        os.remove(os.path.join(path, "epoch=000000000003", "_SUCCESS"))
    else:
        out = KT.compact(spark, path, KEYS, ORDER)
        manifest = os.path.join(path, "manifest=000000000002")
        if point == "manifest not complete":
            os.remove(os.path.join(manifest, "_SUCCESS"))
        elif point != "all done":
            shutil.move(manifest, os.path.join(scratch, "gone"))
        if point == "half the data":
            for folder in sorted(os.listdir(out))[::2]:
                if folder.startswith("_bucket"):
                    shutil.move(os.path.join(out, folder), os.path.join(scratch, folder))
    assert _read(spark, path) == before  # reads are as before
    KT.compact(spark, path, KEYS, ORDER)  # and the next try works
    assert _read(spark, path) == before
    written += (rows := _rows(3))
    _delta(spark, path, 3, rows)
    assert _read(spark, path) == _plain(written)
    KT.compact(spark, path, KEYS, ORDER)
    assert _read(spark, path) == _plain(written)
    assert KT.vacuum(spark, path) > 0 and _read(spark, path) == _plain(written)


def test_only_touched_buckets_are_rewritten(spark, scratch):
    path = os.path.join(scratch, "t")
    rows = [(k, "a", 1, k, f"v{k}") for k in range(400)]
    _delta(spark, path, 0, rows)
    KT.compact(spark, path, KEYS, ORDER, buckets=16)
    _delta(spark, path, 1, [(7, "a", 2, 0, "new")])
    out = KT.compact(spark, path, KEYS, ORDER)
    m = KT.Manifest(spark, path)
    assert m.buckets == 16 and sorted(m.versions.values()) == [0] * 15 + [1]
    assert spark.read.parquet(out).count() < 60 and len(_read(spark, path)) == 400
    assert ("new",) in [(r[4],) for r in _read(spark, path)]


def test_reads_its_input_once(spark):
    """One scan and one exchange, whatever the number of order columns; a hot key is cut in each task."""
    df = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    plan = I.upsert_latest(df, ["event_type"], ["ts", "event_id"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and plan.count("Exchange") == 1 and plan.count("WindowGroupLimit") == 2
    want = df.groupBy("event_type").agg(F.max(F.struct("ts", "event_id")).alias("m")).select("event_type", "m.event_id")
    got = I.upsert_latest(df, ["event_type"], ["ts", "event_id"]).select("event_type", "event_id")
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
