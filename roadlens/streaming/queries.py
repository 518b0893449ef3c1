"""Structured Streaming versions of the operators.

* ``chunk_stream``: incidents + positions -> one row per route and *closed*
  batch (B4/H2 over streams): a batch is an event-time window, emitted once
  when the watermark passes its end, so the result does not depend on how the
  messages fall into micro-batches.
* ``lifecycle_stream``: the incident automaton (K1) over those rows as
  ``applyInPandasWithState`` keyed by route; state is O(1) per route.
* ``pageviews_stream`` (F1), ``incident_user_join_stream`` (E1),
  ``distinct_words_stream`` (F20), ``call_counters_stream`` (F7): built-in
  streaming aggregates and joins.
* ``upsert_stream`` (B1): per-batch deltas and rejects, compacted into buckets and merged on read.

Event time arrives as TIMESTAMP_NTZ; watermarks need TIMESTAMP, so
``event_time`` maps the wall clock to UTC and ``wall_clock`` maps it back,
whatever the session zone.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupStateTimeout

from .. import schemas as S
from ..operators import ingest as I
from ..operators import messages as M
from ..sinks import keyed_table as KT
from ..sources.streams import MESSAGE_LOG_SCHEMA
from . import ordered as O
from .ordered import event_time, names, stamp, wall_clock


# ----------------------------------------------------------------- message log


def message_rows(incidents: DataFrame, positions: DataFrame) -> DataFrame:
    """Message log rows (MESSAGE_LOG_SCHEMA): incidents/clears as they are, one
    USERS row per (batch, route) carrying the location histogram."""
    inc = incidents.select(
        "batch", F.lit(0).alias("rnk"), "route_num", F.col("occur_clear").alias("msg_type"), "ts", "seq",
        "loc", "duration", F.lit(None).cast("long").alias("n_positions"),
        F.lit(None).cast("array<struct<loc:int,n:bigint>>").alias("loc_hist"),
    )
    b = M.bundle_positions(positions)
    first = positions.groupBy("batch", "route_num").agg(F.min("ts").alias("ts"), F.min("seq").alias("seq"))
    bun = b.join(first, ["batch", "route_num"]).select(
        "batch", F.lit(1).alias("rnk"), "route_num", F.lit(S.MSG_USERS).alias("msg_type"), "ts", "seq",
        F.lit(None).cast("int").alias("loc"), F.lit(None).cast("int").alias("duration"), "n_positions",
        F.col("loc_hist").cast("array<struct<loc:int,n:bigint>>").alias("loc_hist"),
    )
    cols = [f.split()[0] for f in MESSAGE_LOG_SCHEMA.split(", ")]
    return inc.select(*cols).unionByName(bun.select(*cols))


SLICE_MICROS = 10_000_000  # ten seconds
_MSG = "struct<ts:timestamp_ntz,seq:bigint,occur_clear:int,loc:int,duration:int>"


def _first_of_runs(messages: Column) -> Column:
    """Messages in (ts, seq) order, the first of each run of equal type: the
    automaton cannot accept another message of the run."""
    ordered = F.array_sort(messages)
    return F.filter(ordered, lambda x, i: (i == 0) | (F.get(ordered, i - 1)["occur_clear"] != x["occur_clear"]))


def chunk_stream(events: DataFrame, batch: str = "1 hour", watermark: str = "10 minutes") -> DataFrame:
    """One row per (route, closed batch): what the automaton can accept there
    (``read_chunks`` layout, as ``lifecycle.chunk_summaries`` gives for tables).

    ``events`` carries valid incidents and positions with a ``kind`` column.
    Two chained windowed aggregates: positions become counts per location and
    incidents the first three run firsts per ten-second slice, then both meet in
    one row per route.  Three are enough: the first incident, the first clear and the
    first incident after it of a batch are among those of its slices, so what meets
    is bounded by the slices of a batch, whatever the rate.  Incidents of an open slice
    are kept until it closes, since a late message may split a run; positions only as counts.  Messages
    later than the watermark are dropped by Spark and counted in the query's
    progress (``numRowsDroppedByWatermark``).
    """
    is_inc = F.col("kind") == "incident"
    msg = F.struct("ts", "seq", "occur_clear", "loc", "duration")
    ev = events.withColumn("_et", event_time("ts")).withWatermark("_et", watermark)
    parts = ev.groupBy(
        F.window("_et", batch).alias("w"), "route_num", F.when(~is_inc, F.col("loc")).alias("at_loc"),
        F.when(is_inc, F.floor(F.unix_micros("_et") / SLICE_MICROS)).alias("slice"),
    ).agg(F.count(F.when(~is_inc, 1)).alias("n"), F.collect_list(F.when(is_inc, msg)).alias("m"))
    parts = parts.select("w", "route_num", "at_loc", "n", F.slice(_first_of_runs(F.col("m")), 1, 3).alias("m"))
    whole = parts.groupBy("w", "route_num").agg(
        F.sum("n").cast("long").alias("n_pos"),
        F.collect_list(F.when(F.col("at_loc").isNotNull(), F.struct(F.col("at_loc").alias("loc"), "n"))).alias("hist"),
        F.flatten(F.collect_list("m")).alias("m"),
    ).select(wall_clock("w.start").alias("batch"), "route_num", "n_pos", F.array_sort("hist").alias("hist"), _first_of_runs(F.col("m")).alias("m"))

    def first(kind: int, start: int | Column = 0) -> Column:
        return F.get(F.filter("m", lambda x, i: (x["occur_clear"] == kind) & (i >= start)), 0)

    fi, fc = first(1), first(0)
    place = F.array_position(F.transform("m", lambda x: x["occur_clear"]), F.lit(0)) - 1  # of the first clear
    fic = F.when(fc.isNotNull(), F.get(F.col("m"), place.cast("int") + 1))  # runs alternate: an incident follows

    def place_of(x: Column) -> Column:
        return F.when(x.isNotNull(), F.struct(x["ts"].alias("ts"), x["seq"].alias("seq"), x["loc"].alias("loc")))

    cleared = F.when(fc.isNotNull(), F.struct(fc["ts"].alias("ts"), fc["seq"].alias("seq"), fc["duration"].alias("duration")))
    return whole.select("route_num", "batch", place_of(fi).alias("fi"), cleared.alias("fc"), place_of(fic).alias("fic"), "n_pos", "hist")


def chunk_log_query(chunks: DataFrame, out_path: str, checkpoint: str, trigger: dict | None = None):
    """Write ``chunk_stream`` rows with the exactly-once file sink.

    Rows are exchanged by route, so one file of an epoch holds all chunks of
    its routes; the number of files follows the shuffle partitions.
    """
    w = (chunks.repartition("route_num").writeStream.format("parquet").option("path", out_path)
         .option("checkpointLocation", checkpoint).outputMode("append"))
    return w.trigger(**(trigger or {"availableNow": True})).start()


# ----------------------------------------------------------------- lifecycle (K1)

HISTORY_STREAM_SCHEMA = (
    "tod timestamp_ntz, route_num int, location int, users_total bigint, users_affected bigint, "
    "duration int, incident_users bigint, incident_affected bigint, occur_ts timestamp_ntz"
)
COUNTER_STREAM_SCHEMA = (
    "route_num int, batch timestamp_ntz, expect int, location int, users_total bigint, users_affected bigint, "
    "incidents_reported bigint, incidents_cleared bigint"
)
LIFECYCLE_STATE_SCHEMA = (
    "done_us bigint, expect int, loc int, occur_us bigint, tot bigint, aff bigint, last_n bigint, last_a bigint, "
    "rep bigint, clr bigint"
)


def _micros(ts) -> int:
    return pd.Timestamp(ts).value // 1000


def _lifecycle_fold(emit_history: bool):
    """Per route: fold chunk rows in batch order.  Chunks at or before the last
    folded batch are skipped, so a repeated row changes nothing."""

    def fold(key, pdfs, state):
        done, expect, loc, occ, tot, aff, last_n, last_a, rep, clr = state.get if state.exists else (
            None, 0, None, None, 0, 0, None, None, 0, 0)
        history, route = [], int(key[0])
        frames = [p for p in pdfs if len(p)]
        for c in pd.concat(frames).sort_values("batch").itertuples(index=False) if frames else ():
            at = _micros(c.batch)
            if done is not None and at <= done:
                continue
            done, accepted = at, None
            if expect == 0:
                accepted = c.fi
            elif expect == 2 and c.fc is not None:
                history.append((c.fc["ts"], route, loc, tot, aff, c.fc["duration"], last_n, last_a, stamp(occ)))
                clr, loc, expect, accepted = clr + 1, None, 0, c.fic
            if accepted is not None:
                loc, occ, rep, expect = int(accepted["loc"]), _micros(accepted["ts"]), rep + 1, 1
            if c.n_pos and expect == 1:
                last_n, last_a = int(c.n_pos), sum(int(h["n"]) for h in c.hist if h["loc"] > loc)
                tot, aff, expect = tot + last_n, aff + last_a, 2
        state.update((done, expect, loc, occ, tot, aff, last_n, last_a, rep, clr))
        if emit_history:
            yield pd.DataFrame(history, columns=names(HISTORY_STREAM_SCHEMA))
        else:
            yield pd.DataFrame([(route, stamp(done), expect, loc, tot, aff, rep, clr)], columns=names(COUNTER_STREAM_SCHEMA))

    return fold


def lifecycle_stream(chunks: DataFrame) -> DataFrame:
    """K1 as a stream: history rows appended as clears are accepted.

    Keyed by route; a row of ``chunks`` is a whole closed batch of a route
    (three messages and a histogram), and the state is a handful of numbers.
    """
    return chunks.groupBy("route_num").applyInPandasWithState(
        _lifecycle_fold(True), HISTORY_STREAM_SCHEMA, LIFECYCLE_STATE_SCHEMA, "append", GroupStateTimeout.NoTimeout
    )


def route_counters_stream(chunks: DataFrame) -> DataFrame:
    """F6/K7 while the stream runs: each route's counters, state and location after
    every micro-batch that touched it (the row with the largest ``batch`` is
    current; F5 is their sum over routes)."""
    return chunks.groupBy("route_num").applyInPandasWithState(
        _lifecycle_fold(False), COUNTER_STREAM_SCHEMA, LIFECYCLE_STATE_SCHEMA, "append", GroupStateTimeout.NoTimeout
    )


def lifecycle_state_now(spark, checkpoint: str) -> DataFrame:
    """The state of a ``lifecycle_stream`` (or ``route_counters_stream``) query as of its
    last committed batch, read from its checkpoint: the columns of ``lifecycle.lifecycle_state``.
    No output is scanned; the read grows with the number of routes."""
    state = spark.read.format("statestore").load(checkpoint).select("key.route_num", "value.groupState.*")
    return state.select(
        "route_num", F.col("expect"), F.col("loc").alias("location"), F.col("tot").alias("users_total"), F.col("aff").alias("users_affected"),
        F.col("rep").alias("incidents_reported"), F.col("clr").alias("incidents_cleared"))


# ----------------------------------------------------------------- windowed operators


def call_counters_stream(requests: DataFrame) -> DataFrame:
    """F7 as a stream: calls per kind so far (complete or update mode)."""
    from ..operators.requests import call_counters

    return call_counters(requests)



def pageviews_stream(events: DataFrame, interval: str = "1 hour", watermark: str = "1 hour") -> DataFrame:
    """F1 as a stream: counts per site and interval, emitted once the
    watermark passes the interval end (append mode, late rows dropped)."""
    ev = events.withColumn("_et", event_time("ts")).withWatermark("_et", watermark)
    return ev.groupBy(F.window("_et", interval).alias("w"), "site_id").agg(
        F.count(F.lit(1)).alias("pageviews")
    ).select("site_id", wall_clock("w.end").alias("window_end"), "pageviews")


def incident_user_join_stream(inc: DataFrame, pos: DataFrame, interval: str = "1 hour",
                              watermark: str = "1 hour", reach: int = S.AFFECTED_REACH) -> DataFrame:
    """E1 as a stream-stream join: same route, same batch window, position past
    the incident within ``reach``.  Both sides are watermarked and the time
    range bounds the join state."""
    i = inc.select(
        "route_num", F.col("seq").alias("inc_seq"), F.col("loc").alias("inc_loc"),
        event_time("ts").alias("inc_et"), F.window(event_time("ts"), interval).start.alias("i_batch"),
        F.explode(F.sequence(F.lit(1), F.lit(reach))).alias("_d"),
    ).withColumn("i_loc", F.col("inc_loc") + F.col("_d")).withWatermark("inc_et", watermark)
    p = pos.select(
        F.col("route_num").alias("p_route"), F.col("seq").alias("pos_seq"), "user_id",
        F.col("loc").alias("user_loc"), event_time("ts").alias("pos_et"),
        F.window(event_time("ts"), interval).start.alias("p_batch"),
    ).withWatermark("pos_et", watermark)
    cond = (
        (F.col("route_num") == F.col("p_route")) & (F.col("i_loc") == F.col("user_loc"))
        & (F.col("i_batch") == F.col("p_batch"))
        & (F.col("pos_et") >= F.col("inc_et") - F.expr(f"INTERVAL {interval}"))
        & (F.col("pos_et") <= F.col("inc_et") + F.expr(f"INTERVAL {interval}"))
    )
    return i.join(p, cond).select(
        wall_clock("i_batch").alias("batch"), "route_num", "inc_seq", "inc_loc",
        wall_clock("inc_et").alias("inc_ts"), "pos_seq", "user_id", "user_loc",
        wall_clock("pos_et").alias("user_ts"),
    )


def asof_affected_stream(inc: DataFrame, pos: DataFrame, watermark: str, reach: int = S.AFFECTED_REACH) -> DataFrame:
    """E2 as a stream: each position against the latest incident message of its route at
    or before it, whatever order both streams arrive in.  Emits (route_num, day,
    positions, affected) as messages are passed by the watermark; their sums per
    route and day (``asof_totals``) equal ``joins.asof_affected_counts``."""
    rows = inc.select("route_num", "ts", F.lit(0).alias("rank"), "seq", F.col("occur_clear").alias("occur"), "loc").unionByName(
        pos.select("route_num", "ts", F.lit(1).alias("rank"), "seq", F.lit(None).cast("int").alias("occur"), "loc"))
    return O.in_event_order(rows, "route_num", ["occur", "loc"], watermark, O.asof_step(reach), (None, None),
                            O.ASOF_STREAM_SCHEMA, O.ASOF_STATE_SCHEMA, order=["rank", "seq"])


def asof_totals(rows: DataFrame) -> DataFrame:
    return rows.groupBy("route_num", "day").agg(F.sum("positions").alias("positions"), F.sum("affected").alias("affected"))


def distinct_words_stream(lines: DataFrame) -> DataFrame:
    """F20 as a stream: first sighting of every word (one state store: the vocabulary)."""
    return I.word_keys(lines).dropDuplicates(["key"])


# ----------------------------------------------------------------- keyed upsert (B1)


def upsert_stream(df: DataFrame, keys: Sequence[str], order_cols: Sequence[str], path: str, checkpoint: str,
                  trigger: dict | None = None):
    """B1 over a stream: each micro-batch writes its latest row per key as a
    delta, and the rows it cannot store as rejects (``sinks.keyed_table``);
    ``read_upserted`` merges on read, ``compact_upserts`` folds deltas into buckets."""

    def _write(batch: DataFrame, epoch: int) -> None:
        KT.write_delta(batch, keys, order_cols, path, epoch)

    w = df.writeStream.foreachBatch(_write).option("checkpointLocation", checkpoint)
    return w.trigger(**(trigger or {"availableNow": True})).start()


def read_upserted(spark, path: str, keys: Sequence[str], order_cols: Sequence[str]) -> DataFrame:
    return KT.read(spark, path, keys, order_cols)


def compact_upserts(spark, path: str, keys: Sequence[str], order_cols: Sequence[str], buckets: int = KT.BUCKETS) -> str:
    """Fold the deltas into the buckets they touch; returns the folder of the new version."""
    return KT.compact(spark, path, keys, order_cols, buckets)


# ----------------------------------------------------------------- capped incidents (K3)

def _ordered(pdfs, column: str) -> tuple[np.ndarray, np.ndarray]:
    """``column`` and ``seq`` of one key's rows in (ts, seq) order, as two narrow arrays."""
    frames = [p[["ts", "seq", column]] for p in pdfs if len(p)]
    if not frames:
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
    pdf = pd.concat(frames).sort_values(["ts", "seq"], kind="mergesort")
    return pdf[column].to_numpy(dtype=np.int64), pdf["seq"].to_numpy(dtype=np.int64)


def _by_arrival(step: O.Step, column: str, init: tuple):
    """The fold for sources that keep each key's order: a micro-batch is sorted, then taken."""

    def fold(key, pdfs, state):
        values, seq = _ordered(pdfs, column)
        rows = np.column_stack([np.zeros_like(seq), seq, values])
        kept, out = step(key, rows, tuple(state.get) if state.exists else init)
        state.update(kept)
        yield out

    return fold


def capped_incidents_stream(incidents: DataFrame, cap: int = S.INCIDENT_CAP, watermark: str | None = None) -> DataFrame:
    """K3 as a stream: per route, the counters after each micro-batch (the row
    with the largest ``n_msgs`` is current).  State: six numbers per route.

    With ``watermark`` messages take effect in event-time order once it has passed
    them, however late they come within it (``ordered.in_event_order``); without,
    the source must bring each route's messages in order.
    """
    if watermark:
        return O.in_event_order(incidents, "route_num", ["occur_clear"], watermark, O.capped_step(cap), (0,) * 6,
                                O.CAPPED_STREAM_SCHEMA, O.CAPPED_STATE_SCHEMA)
    return incidents.select("route_num", "ts", "seq", "occur_clear").groupBy("route_num").applyInPandasWithState(
        _by_arrival(O.capped_step(cap), "occur_clear", (0,) * 6), O.CAPPED_STREAM_SCHEMA, O.CAPPED_STATE_SCHEMA, "append", GroupStateTimeout.NoTimeout
    )


# ----------------------------------------------------------------- report queues (K5)


def report_state_stream(requests: DataFrame, watermark: str | None = None) -> DataFrame:
    """K5 as a stream (append mode): a keyed table of numbered reports and the
    head of each route's queue; ``open_reports`` reads the state off it.
    ``watermark`` as in ``capped_incidents_stream``."""
    from ..operators.requests import report_events

    ev = report_events(requests).select("route_num", "ts", "seq", "delta")
    if watermark:
        return O.in_event_order(ev, "route_num", ["delta"], watermark, O.report_step, (0, 0), O.REPORT_STREAM_SCHEMA, O.REPORT_STATE_SCHEMA)
    return ev.groupBy("route_num").applyInPandasWithState(
        _by_arrival(O.report_step, "delta", (0, 0)), O.REPORT_STREAM_SCHEMA, O.REPORT_STATE_SCHEMA, "append", GroupStateTimeout.NoTimeout
    )


def open_reports(rows: DataFrame) -> DataFrame:
    """(route_num, rank, seq) still open, from the rows of ``report_state_stream``."""
    heads = rows.where("action = 'head'").groupBy(F.col("route_num").cast("int").alias("of_route")).agg(F.max("rank").alias("head"))
    opened = rows.where("action = 'open'")
    return opened.join(heads, F.col("route_num") == F.col("of_route")).where("rank > head").select("route_num", "rank", "seq")


# ----------------------------------------------------------------- sessions (K4), incident table (K6)

def _session_fold(key, pdfs, state):
    """Per user: alternate register / sign-off; other messages of a run change nothing."""
    active, route, loc, since = state.get if state.exists else (False, None, None, None)
    frames, out = [p for p in pdfs if len(p)], []
    if frames:
        pdf = pd.concat(frames).sort_values(["ts", "seq"], kind="mergesort")
        pdf = pdf[pdf["req_type"] != pdf["req_type"].shift()]  # the first of each run
        for r in pdf.itertuples(index=False):
            if r.req_type == S.REQ_REGISTER and not active:
                active, route, loc, since = True, int(r.route_num), int(r.loc), _micros(r.ts)
            elif r.req_type == S.REQ_SIGNOFF and active:
                out.append((key[0], route, loc, stamp(since), r.ts))
                active, route, loc, since = False, None, None, None
    state.update((active, route, loc, since))
    yield pd.DataFrame(out, columns=names(O.SESSION_STREAM_SCHEMA))


def sessions_stream(requests: DataFrame, watermark: str | None = None) -> DataFrame:
    """K4 as a stream: a session is appended when its user signs off; open
    sessions are the state (four values per active user).  ``watermark`` as in
    ``capped_incidents_stream``."""
    rs = requests.where(F.col("req_type").isin(S.REQ_REGISTER, S.REQ_SIGNOFF)).select("user_id", "route_num", "loc", "ts", "seq", "req_type")
    if watermark:
        return O.in_event_order(rs, "user_id", ["req_type", "route_num", "loc"], watermark, O.session_step, (False, None, None, None),
                                O.SESSION_STREAM_SCHEMA, O.SESSION_STATE_SCHEMA)
    return rs.groupBy("user_id").applyInPandasWithState(
        _session_fold, O.SESSION_STREAM_SCHEMA, O.SESSION_STATE_SCHEMA, "append", GroupStateTimeout.NoTimeout)


def incident_table_stream(requests: DataFrame, path: str, checkpoint: str, trigger: dict | None = None):
    """K6/B7 over a stream: the latest change per (route, location) as keyed upserts;
    a clear is stored as a deletion mark (``read_incident_table`` leaves it out)."""
    from ..operators.requests import report_events

    ev = report_events(requests).select("route_num", "loc", "user_id", "sub_req_type", "ts", "seq", "delta")
    return upsert_stream(ev, ["route_num", "loc"], ["ts", "seq"], path, checkpoint, trigger)


def read_incident_table(spark, path: str) -> DataFrame:
    rows = read_upserted(spark, path, ["route_num", "loc"], ["ts", "seq"])
    return rows.where("delta = 1").select(
        F.col("route_num").alias("route_id"), F.col("loc").alias("location"), "user_id", F.col("sub_req_type").alias("incident_type"), "ts")


# ----------------------------------------------------------------- the incident flow end to end

_DOMAIN_COLS = ["route_num", "loc", "ts", "occur_clear", "duration", "seq", "kind", "problem", "_raw"]


def domain_rows(parsed: DataFrame, kind: str) -> DataFrame:
    """Parsed wire rows -> domain rows; ``problem`` tells why a row cannot be used
    (null: it can), by the rule the batch side uses too."""
    rows = parsed.withColumns({"seq": F.col("seq").cast("long"), "_bad": F.col("_malformed")})
    if "_raw" not in rows.columns:
        rows = rows.withColumn("_raw", F.lit(None).cast("string"))
    if kind == "incident":
        rows = M.parse_incidents(rows).withColumn("problem", M.incident_problem(F.col("_bad")))
    else:
        rows = M.parse_positions(rows).withColumns({
            "occur_clear": F.lit(None).cast("int"), "duration": F.lit(None).cast("int"), "problem": M.position_problem(F.col("_bad"))})
    return rows.withColumn("kind", F.lit(kind)).select(*_DOMAIN_COLS)


class IncidentStreams(NamedTuple):
    producer: object
    consumer: object
    rejects: object
    admission: object = None


def admission_query(rows: DataFrame, out_path: str, checkpoint: str, watermark: str, trigger: dict | None = None):
    """L1: all messages of ``rows`` (``domain_rows`` of any kinds) in folders ``late=false`` and
    ``late=true``, by the exactly-once file sink.  Whoever reads whole epochs of the first
    with the same watermark delay drops none of them: its watermark cannot be ahead
    of the one they were admitted under."""
    marked = O.admitted(rows.select("kind", F.col("_raw").alias("value"), "seq", "ts"), watermark)
    # a computed column: the partitioned writer's sort needs rows that a projection has made
    marked = marked.withColumn("late", F.coalesce("late", F.lit(False)))
    w = (marked.writeStream.format("parquet").option("path", out_path).option("checkpointLocation", checkpoint)
         .partitionBy("late").outputMode("append"))
    return w.trigger(**(trigger or {"availableNow": True})).start()


def read_admitted(spark, path: str, schemas: dict) -> DataFrame:
    """The on-time messages of an admission log as domain rows; ``schemas``: wire schema per kind."""
    log = spark.readStream.schema(O.ADMITTED_SCHEMA).parquet(path).where(~F.col("late"))
    parts = []
    for kind, schema in schemas.items():
        lines = log.where(F.col("kind") == kind).select("value", *([] if "seq" in schema.fieldNames() else ["seq"]))
        parts.append(domain_rows(M.parse_json(lines, schema, keep_raw=True), kind))
    return reduce(DataFrame.unionByName, parts)


def start_incident_streams(spark, out_dir: str, checkpoint_dir: str, source: str = "files",
                           topics_dir: str | None = None, bootstrap: str | None = None,
                           batch: str = "1 hour", watermark: str = "10 minutes", trigger: dict | None = None,
                           accident_schema=S.USER_ACCIDENT_SCHEMA, position_schema=S.USER_POS_SCHEMA,
                           max_files: int | None = None, keep_late: bool = False) -> IncidentStreams:
    """The incident flow end to end: topics ``user_accident`` and ``user_pos``
    -> parsed domain rows -> closed batches per route (``out_dir/chunks``)
    -> lifecycle state per route -> history rows appended to
    ``out_dir/history`` partitioned by day.  Messages that cannot be used go to
    ``out_dir/rejects`` (topic kind, problem, text).  With ``keep_late`` all messages first
    pass the admission log ``out_dir/messages``: those later than the watermark stay
    in its folder ``late=true``, the flow reads the others.

    A batch is closed, and its messages take effect, when the watermark passes
    its end.  With ``availableNow`` the consumer starts after the producer has
    drained its input; with a processing-time trigger all run side by side.
    """
    from ..sinks.writers import history_stream_sink
    from ..sources.streams import read_chunks, read_events

    acc = read_events(spark, "user_accident", accident_schema, source, topics_dir, bootstrap, max_files)
    pos = read_events(spark, "user_pos", position_schema, source, topics_dir, bootstrap, max_files)
    rows = domain_rows(acc, "incident").unionByName(domain_rows(pos, "position"))
    out, ck = out_dir.rstrip("/"), checkpoint_dir.rstrip("/")
    admission = None
    if keep_late:
        spark.createDataFrame([], O.ADMITTED_SCHEMA).write.mode("ignore").partitionBy("late").parquet(f"{out}/messages")
        admission = admission_query(rows, f"{out}/messages", f"{ck}/messages", watermark, trigger)
        if trigger is None or "availableNow" in trigger:
            admission.awaitTermination()
        rows = read_admitted(spark, f"{out}/messages", {"incident": accident_schema, "position": position_schema})
    rejects = (
        rows.where("problem IS NOT NULL").select("kind", "problem", F.col("_raw").alias("message"))
        .writeStream.format("parquet").option("path", f"{out}/rejects").option("checkpointLocation", f"{ck}/rejects")
        .outputMode("append").trigger(**(trigger or {"availableNow": True})).start())
    chunks = chunk_stream(rows.where("problem IS NULL"), batch, watermark)
    producer = chunk_log_query(chunks, f"{out}/chunks", f"{ck}/chunks", trigger)
    if trigger is None or "availableNow" in trigger:
        producer.awaitTermination()
    history = lifecycle_stream(read_chunks(spark, f"{out}/chunks", max_files))
    consumer = history_stream_sink(history, f"{out}/history", f"{ck}/history", "tod", trigger)
    return IncidentStreams(producer, consumer, rejects, admission)
