"""The chunked scan helpers equal a plain sequential pass per key, across
chunk, period and month boundaries (random data, fixed seed)."""

import datetime as dt
import random

from pyspark.sql import functions as F

from roadlens.operators import scan as SC

T0 = dt.datetime(2024, 1, 30, 22, 0, 0)  # spans a month boundary


def _rows(seed=7, keys=4, n=400):
    rnd = random.Random(seed)
    out = []
    for i in range(n):
        k = rnd.randrange(keys)
        ts = T0 + dt.timedelta(seconds=rnd.randrange(0, 3 * 24 * 3600))
        v = rnd.choice([None, None, rnd.randrange(-5, 6)])
        out.append((k, ts, i, v))
    return out


def _by_key(rows):
    per = {}
    for k, ts, seq, v in sorted(rows, key=lambda r: (r[0], r[1], r[2])):
        per.setdefault(k, []).append((ts, seq, v))
    return per


def _df(spark, rows):
    return spark.createDataFrame(rows, "k int, ts timestamp_ntz, seq long, v int").withColumn(
        "chunk", F.window("ts", "1 hour").start)


def test_carry_last_and_next(spark):
    rows = _rows()
    df = _df(spark, rows)
    got = {r.seq: (r.last, r.nxt) for r in SC.carry_last(
        SC.carry_last(df, ["k"], "chunk", ["ts", "seq"], "v", "last"),
        ["k"], "chunk", ["ts", "seq"], "v", "nxt", descending=True).collect()}
    for k, seq_rows in _by_key(rows).items():
        last = None
        for ts, seq, v in seq_rows:
            last = v if v is not None else last
            assert got[seq][0] == last
        nxt = None
        for ts, seq, v in reversed(seq_rows):
            nxt = v if v is not None else nxt
            assert got[seq][1] == nxt


def test_keyed_lag_and_running_sum(spark):
    rows = _rows(seed=11)
    df = _df(spark, rows).withColumn("w", F.coalesce("v", F.lit(0)))
    lag = {r.seq: r.p for r in SC.keyed_lag(df, ["k"], "chunk", ["ts", "seq"], "w", "p").collect()}
    run = {r.seq: r.s for r in SC.running_sum(df, ["k"], "chunk", ["ts", "seq"], "w", "s").collect()}
    glob = {r.seq: r.s for r in SC.global_running_sum(df, "ts", ["k", "seq"], "w", "s").collect()}
    low = {r.seq: r.lo for r in SC.running_sum(df, ["k"], "chunk", ["ts", "seq"], "w", "s", low_col="lo").collect()}
    for k, seq_rows in _by_key(rows).items():
        prev, total, least = None, 0, None
        for ts, seq, v in seq_rows:
            w = v or 0
            total += w
            least = total if least is None else min(least, total)
            assert low[seq] == least
            assert lag[seq] == prev and run[seq] == total
            prev = w
    total = 0
    for k, ts, seq, v in sorted(rows, key=lambda r: (r[1], r[0], r[2])):
        total += v or 0
        assert glob[seq] == total


def test_prefix_states_all_levels(spark):
    rnd = random.Random(3)
    n_states = 4
    chunks = []
    for k in range(3):
        for h in range(0, 24 * 70, 5):  # ~70 days of 5-hour chunks: several months
            fn = [rnd.randrange(n_states) for _ in range(n_states)]
            chunks.append((k, T0 + dt.timedelta(hours=h), fn))
    df = spark.createDataFrame(chunks, "k int, b timestamp_ntz, fn array<int>")
    for levels in [(), ("month",), ("day", "month"), ("hour", "day", "month")]:
        got = {(r.k, r.b): r.s for r in SC.prefix_states(df, ["k"], "b", "fn", n_states, 1, levels, "s").collect()}
        state = {}
        for k, b, fn in sorted(chunks, key=lambda c: (c[0], c[1])):
            st = state.get(k, 1)
            assert got[(k, b)] == st, (levels, k, b)
            state[k] = fn[st]


def test_levels_for_intervals():
    assert SC.levels_for("1 hour") == ("day", "month")
    assert SC.levels_for("4 seconds") == ("minute", "hour", "day", "month") == SC.DEFAULT_LEVELS
    assert SC.levels_for("10 minutes") == ("hour", "day", "month")
    assert SC.levels_for("1 day") == ("year",)


def test_bucket_counts_far_along_the_road(spark):
    """Intervals of locations in the thousands against a plain count."""
    from roadlens.operators.joins import bucket_counts

    rnd = random.Random(5)
    steps = [(rnd.randrange(2), T0 + dt.timedelta(seconds=rnd.randrange(7200)), rnd.choice([1, -1, 1]), rnd.randrange(3000)) for _ in range(400)]
    probes = []
    for k in range(120):
        a, b = sorted((rnd.randrange(3001), rnd.randrange(3001)))
        probes.append((rnd.randrange(2), T0 + dt.timedelta(seconds=rnd.randrange(7200)), k, a, b if k % 9 else a))
    s = spark.createDataFrame(steps, "route_num int, ts timestamp_ntz, d long, off int").withColumn("length", F.lit(3000))
    p = spark.createDataFrame(probes, "route_num int, ts timestamp_ntz, seq long, low int, bound int").withColumn("length", F.lit(3000))
    rows = bucket_counts(s, p)
    got = {r.seq: r.n for r in rows.collect()}
    for route, ts, seq, a, b in probes:
        assert got.get(seq, 0) == sum(d for r, t, d, off in steps if r == route and t <= ts and a <= off < b)


def test_notified_users_far_along_the_road(spark):
    from roadlens.operators import requests as R

    rnd = random.Random(8)
    rows = []
    for k in range(300):
        t = T0 + dt.timedelta(seconds=k * 7)
        kind = rnd.choice([0, 0, 1, 4])
        rows.append((kind, 0 if kind == 4 else None, f"u{rnd.randrange(12)}", rnd.randrange(2), 40_000 + rnd.randrange(2000), t, k, t))
    df = spark.createDataFrame(rows, "req_type int, sub_req_type int, user_id string, route_num int, loc int, ts timestamp_ntz, seq long, batch timestamp_ntz")
    active, want = {}, {}
    for kind, _, user, route, loc, _, seq, _ in rows:
        if kind == 0:
            active.setdefault(user, (route, loc))
        elif kind == 1:
            active.pop(user, None)
        else:
            want[seq] = sum(r == route and x <= loc - 1 for r, x in active.values())
    assert {r.seq: r.users_to_notify for r in R.users_to_notify(df).collect()} == want


def test_ranks_equal_a_window_over_each_key(spark):
    from pyspark.sql import Window

    df = spark.range(3000).select(
        F.when(F.col("id") % 10 < 8, "hot").when(F.col("id") % 50 == 9, None).otherwise(F.col("id").cast("string")).alias("k"),
        (F.xxhash64("id") % 100).alias("v"), "id")
    want = df.withColumn("rank", F.row_number().over(Window.partitionBy("k").orderBy(F.desc("v"), "id")))
    got = SC.ranks(df, ["k"], [F.desc("v"), F.col("id")], "rank")
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
    assert SC.ranks(df.where("false"), ["k"], [F.col("id")], "rank").count() == 0
