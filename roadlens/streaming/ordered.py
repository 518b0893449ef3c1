"""Keyed folds in event-time order, whatever order the messages arrive in.

A fold sees a key's messages in (ts, seq) order.  Messages wait in the key's
state until the watermark has passed them; no message before it can come any more
(Spark drops what is later than the watermark), so what is released is final and
the result does not depend on how messages fall into files, triggers or
epochs.  Event-time timeouts release a key's messages when the watermark
advances without new input for it.

The state of a key is its waiting messages (its rate times the watermark delay, as
packed integers) and the few numbers of the fold.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupStateTimeout

from .. import schemas as S

_EPOCH = "TIMESTAMP_NTZ'1970-01-01 00:00:00'"
NULL = int(np.iinfo(np.int64).min)  # stands for a null among packed integers


def event_time(col: str = "ts") -> Column:
    """TIMESTAMP with the wall clock of a TIMESTAMP_NTZ column, read as UTC."""
    return F.expr(f"timestamp_micros(CAST(CAST(`{col}` - {_EPOCH} AS DECIMAL(20,6)) * 1000000 AS BIGINT))")


def wall_clock(col: str) -> Column:
    """Back from ``event_time``."""
    return F.expr(f"{_EPOCH} + make_dt_interval(0, 0, 0, CAST(unix_micros({col}) / 1000000BD AS DECIMAL(18,6)))")


def stamp(us: int | None):
    return None if us is None else pd.Timestamp(us * 1000)


def names(schema: str) -> list[str]:
    return [f.split()[0] for f in schema.split(", ")]


# A step takes (key, rows, kept): ``rows`` are the released messages, one row of integers
# each (ts in microseconds, seq, then the values), in order; ``kept`` is the fold's state.
# It returns the new state and the rows it emits, or None.
Step = Callable[[tuple, np.ndarray, tuple], tuple[tuple, pd.DataFrame | None]]


def _fold(step: Step, columns: list[str], init: tuple, n_order: int = 1):
    def fold(key, pdfs, state):
        held, *kept = state.get if state.exists else (b"", *init)
        new = [np.column_stack([p[c].to_numpy(dtype=np.int64) for c in columns]) for p in pdfs if len(p)]
        rows = np.concatenate([np.frombuffer(held, dtype="<i8").reshape(-1, len(columns)), *new])
        rows = rows[np.lexsort(rows[:, n_order::-1].T)]  # by the first columns: ts, then the order
        mark = state.getCurrentWatermarkMs()
        ready = int(np.searchsorted(rows[:, 0], mark * 1000, side="left"))
        out = None
        if ready:
            kept, out = step(key, rows[:ready], tuple(kept))
        rows = rows[ready:]
        state.update((rows.astype("<i8").tobytes(), *kept))
        if len(rows):
            state.setTimeoutTimestamp(max(mark, int(rows[0, 0] // 1000), 1))  # released by the first watermark past it
        if out is not None:
            yield out

    return fold


def in_event_order(df: DataFrame, key: str, values: Sequence[str], watermark: str, step: Step,
                   init: tuple, out_schema: str, state_schema: str, order: Sequence[str] = ("seq",)) -> DataFrame:
    """Fold each ``key``'s rows of a stream in (ts, *order) order (append mode).

    ``df`` has ``ts`` (TIMESTAMP_NTZ) and the integer columns ``order`` and ``values``; rows
    without key or ts take no part.  A message takes effect when the watermark
    has passed it.
    """
    rows = df.where(F.col(key).isNotNull() & F.col("ts").isNotNull()).withColumn("_et", event_time("ts")).withWatermark("_et", watermark)
    packed = rows.select(
        key, "_et", F.unix_micros("_et").alias("_ts"),
        *[F.coalesce(F.col(c).cast("long"), F.lit(NULL)).alias(f"_{c}") for c in (*order, *values)])
    columns = ["_ts", *[f"_{c}" for c in (*order, *values)]]
    return packed.groupBy(key).applyInPandasWithState(
        _fold(step, columns, init, len(order)), out_schema, f"held binary, {state_schema}", "append", GroupStateTimeout.EventTimeTimeout)


# ----------------------------------------------------------------- late messages (L1)

ADMITTED_SCHEMA = "kind string, value string, seq bigint, late boolean"
NEVER = 1 << 62  # event time of a message without one: never late


def admitted(messages: DataFrame, watermark: str, buckets: int = 200) -> DataFrame:
    """Tell on-time messages from late ones, and keep both (append mode).

    ``messages``: kind, value, seq, ts (null where it cannot be read).  A message is late
    when the watermark had passed its time before its micro-batch; the stateful
    operators below would drop it without a trace.  Here an operator without timeouts,
    which Spark lets late rows reach, reads the watermark and marks them.  Messages
    are dealt by a hash, so no key is a bottleneck; the state is a count per bucket.
    """
    rows = messages.withColumn("_et", F.coalesce(event_time("ts"), F.timestamp_millis(F.lit(0)))).withWatermark("_et", watermark)
    rows = rows.select(
        F.pmod(F.xxhash64("value", "seq"), F.lit(buckets)).alias("bucket"), "_et", "kind", "value", "seq",
        F.coalesce(F.unix_millis(event_time("ts")), F.lit(NEVER)).alias("_ms"))

    def tap(key, pdfs, state):
        n = state.get[0] if state.exists else 0
        mark = state.getCurrentWatermarkMs()
        for p in pdfs:
            n += len(p)
            yield p[["kind", "value", "seq"]].assign(late=p["_ms"] <= mark)
        state.update((n,))

    return rows.groupBy("bucket").applyInPandasWithState(tap, ADMITTED_SCHEMA, "n bigint", "append", GroupStateTimeout.NoTimeout)


def run_starts(kinds: np.ndarray) -> np.ndarray:
    """Where runs of equal values begin."""
    return np.flatnonzero(np.r_[True, kinds[1:] != kinds[:-1]]) if len(kinds) else np.zeros(0, dtype=np.int64)


# ----------------------------------------------------------------- capped incidents (K3)

CAPPED_STREAM_SCHEMA = (
    "route_num int, n_msgs bigint, active bigint, reported bigint, dropped bigint, cleared bigint, ignored bigint"
)
CAPPED_STATE_SCHEMA = "n bigint, active bigint, reported bigint, dropped bigint, cleared bigint, ignored bigint"


def capped(kinds: np.ndarray, kept: tuple, cap: int) -> tuple:
    """The counters after messages of ``kinds`` (1 occur, else clear), run by run: a run of
    occurs fills up to the cap, a run of clears empties."""
    n, active, rep, drop, clr, ign = kept
    starts = run_starts(kinds)
    for at, size in zip(starts, np.diff(np.r_[starts, len(kinds)])):
        size = int(size)
        n += size
        if kinds[at] == 1:
            taken = min(size, cap - active)
            active, rep, drop = active + taken, rep + taken, drop + size - taken
        else:
            taken = min(size, active)
            active, clr, ign = active - taken, clr + taken, ign + size - taken
    return n, active, rep, drop, clr, ign


def capped_step(cap: int) -> Step:
    def step(key, rows, kept):
        kept = capped(rows[:, 2], kept, cap)
        return kept, pd.DataFrame([(int(key[0]), *kept)], columns=names(CAPPED_STREAM_SCHEMA))

    return step


# ----------------------------------------------------------------- report queues (K5)

REPORT_STREAM_SCHEMA = "route_num int, action string, rank bigint, seq bigint"
REPORT_STATE_SCHEMA = "added bigint, cleared bigint"


def report_step(key, rows, kept):
    """Number the added reports and move the head of the route's queue.

    Emits one ``open`` row per add with its number and one ``head`` row with
    the number of clears that took effect so far: reports numbered above the
    head are open.  State is two counters, whatever is open.
    """
    added, cleared = kept
    seq, delta = rows[:, 1], rows[:, 2]
    adds = delta == 1
    ranks = added + np.cumsum(adds)[adds]
    level = (added - cleared) + np.cumsum(delta)  # below zero: clears that found the queue empty
    ignored = max(0, -int(level.min(initial=0)))
    added, cleared = added + int(adds.sum()), cleared + int((~adds).sum()) - ignored
    opened = pd.DataFrame({"route_num": int(key[0]), "action": "open", "rank": ranks, "seq": seq[adds]})
    head = pd.DataFrame({"route_num": [int(key[0])], "action": ["head"], "rank": [cleared], "seq": [None]})
    return (added, cleared), pd.concat([opened, head]).astype({"route_num": "int32", "rank": "int64", "seq": "Int64"})


# ----------------------------------------------------------------- as-of join

ASOF_STREAM_SCHEMA = "route_num int, day string, positions bigint, affected bigint"
ASOF_STATE_SCHEMA = "occur bigint, loc bigint"
_DAY = 86_400_000_000


def asof_step(reach: int) -> Step:
    """Each position against the latest incident message of its route: rows are (ts, rank, seq,
    occur, loc) with incidents of rank 0.  Emits counts per day; the state is that message."""

    def step(key, rows, kept):
        occur, loc = (NULL if x is None else x for x in kept)
        incident = rows[:, 1] == 0
        last = np.maximum.accumulate(np.where(incident, np.arange(len(rows)), -1))
        seen = last >= 0
        at_occur, at_loc = np.where(seen, rows[last, 3], occur), np.where(seen, rows[last, 4], loc)
        user = rows[:, 4]
        known = (at_occur == 1) & (at_loc != NULL) & (user != NULL)
        ahead = np.where(known, at_loc, 0) - np.where(known, user, 0)
        hit = known & (ahead > 0) & (ahead <= reach)
        if seen[-1]:
            occur, loc = int(at_occur[-1]), int(at_loc[-1])
        kept = tuple(None if x == NULL else int(x) for x in (occur, loc))
        days, which = np.unique(rows[~incident, 0] // _DAY, return_inverse=True)
        if not len(days):
            return kept, None
        return kept, pd.DataFrame({
            "route_num": int(key[0]), "day": days.astype("datetime64[D]").astype(str),
            "positions": np.bincount(which), "affected": np.bincount(which, weights=hit[~incident]).astype(np.int64)})

    return step


# ----------------------------------------------------------------- sessions (K4)

SESSION_STREAM_SCHEMA = (
    "user_id string, route_num int, loc int, register_ts timestamp_ntz, signoff_ts timestamp_ntz"
)
SESSION_STATE_SCHEMA = "active boolean, route_num int, loc int, register_us bigint"


def _known(x) -> int | None:
    return None if x == NULL else int(x)


def session_step(key, rows, kept):
    """Alternate register / sign-off; only the first message of a run can change anything."""
    active, route, loc, since = kept
    out = []
    for ts, _, kind, at_route, at_loc in rows[run_starts(rows[:, 2])]:
        if kind == S.REQ_REGISTER and not active:
            active, route, loc, since = True, _known(at_route), _known(at_loc), int(ts)
        elif kind == S.REQ_SIGNOFF and active:
            out.append((key[0], route, loc, stamp(since), stamp(int(ts))))
            active, route, loc, since = False, None, None, None
    return (active, route, loc, since), pd.DataFrame(out, columns=names(SESSION_STREAM_SCHEMA)) if out else None


TRANSITION_SCHEMA = "ts timestamp_ntz, seq bigint, delta int"


def transition_step(key, rows, kept):
    """+1 for a register of an inactive user, -1 for a sign-off of an active one; others change nothing."""
    active, out = kept[0], []
    for ts, seq, kind in rows[run_starts(rows[:, 2])]:
        if (kind == S.REQ_REGISTER) != active:
            active = not active
            out.append((stamp(int(ts)), int(seq), 1 if active else -1))
    return (active,), pd.DataFrame(out, columns=names(TRANSITION_SCHEMA)) if out else None
