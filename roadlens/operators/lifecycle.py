"""Incident lifecycle per route (K1, K7, K8, F4-F6) and capped incidents (K3).

Automaton per route, over the message log ordered by (batch, rank, ts, seq)
where incidents and clears (rank 0) precede the batch's position bundle
(rank 1, one per route and batch)::

    expect INCIDENT --I--> expect USERS --U--> expect CLEAR --C--> expect INCIDENT

Any message of another type is ignored.  An accepted I sets the location, the
accepted U adds the bundle's size and the number of positions past the
incident (``user_loc > loc``) to the route's running totals, an accepted C
emits a history row carrying the running totals and resets.

Inside one (route, batch) chunk the outcome only depends on the first I, the
first C, the first I after that C and whether the bundle exists, so chunk
summaries are plain aggregates; the state at each chunk start comes from
``prefix_states``.  A hot route therefore costs one task per batch, not one
task for its whole history.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import schemas as S
from ..session import materialise
from .scan import DEFAULT_LEVELS, apply_fn, key_window, prefix_states

EXPECT_INCIDENT, EXPECT_USERS, EXPECT_CLEAR = 0, 1, 2
KEYS = ["route_num"]


def position_histogram(positions: DataFrame) -> DataFrame:
    """Bundle content as counts per location: (route_num, batch, loc, n)."""
    return positions.groupBy("route_num", "batch", "loc").agg(F.count(F.lit(1)).alias("n"))


def bundles(positions: DataFrame) -> DataFrame:
    """One bundle per (route, batch): size and location histogram.  The
    histogram has at most one entry per location of the route, whatever the
    number of positions."""
    return position_histogram(positions).groupBy("route_num", "batch").agg(
        F.sum("n").cast("long").alias("n_pos"), F.collect_list(F.struct("loc", "n")).alias("hist")
    )


# Exact (ts, seq) order as one DECIMAL(38,0): micros since the epoch * 2^63 + seq.
# Decimal buffers are mutable in hash aggregation, so min/min_by over this key
# aggregate with a hash map; a struct key would fall back to sort aggregation.
ORDER_KEY = (
    "CAST(CAST(CAST(ts - TIMESTAMP_NTZ'1970-01-01 00:00:00' AS DECIMAL(20,6)) * 1000000 AS BIGINT) AS DECIMAL(38,0))"
    " * 9223372036854775808BD + CAST(seq AS DECIMAL(38,0))"
)


def _first(cond, key: str, fields: dict[str, str], prefix: str) -> list:
    """min_by of each field by ``key`` over rows where ``cond`` holds."""
    k = F.when(cond, F.col(key))
    return [F.min(k).alias(f"{prefix}_ord")] + [
        F.min_by(F.col(src), k).alias(f"{prefix}_{name}") for name, src in fields.items()
    ]


def _struct_of(prefix: str, names: list[str]):
    return F.when(F.col(f"{prefix}_ord").isNotNull(), F.struct(*[F.col(f"{prefix}_{n}").alias(n) for n in names]))


def chunk_summaries(incidents: DataFrame, positions: DataFrame, bundle_rows: DataFrame | None = None) -> DataFrame:
    """One row per (route_num, batch) with what the automaton can accept there.

    Bundles come from ``positions`` or, when given, from ready ``bundle_rows``
    (route_num, batch, n_pos, hist) such as a message log's USERS rows.

    Only hash aggregates and a many-to-one join: a hot (route, batch) is
    reduced map-side and split by AQE's skew handling, never processed as one
    group.
    """
    inc = incidents.select("route_num", "batch", "ts", "seq", "occur_clear", "loc", "duration",
                           F.expr(ORDER_KEY).alias("_o"))
    occur = F.col("occur_clear") == 1
    firsts = inc.groupBy("route_num", "batch").agg(
        *_first(occur, "_o", {"ts": "ts", "seq": "seq", "loc": "loc"}, "fi"),
        *_first(~occur, "_o", {"ts": "ts", "seq": "seq", "duration": "duration"}, "fc"),
    )
    # first incident after the chunk's first clear
    fic = (
        inc.where(occur)
        .join(firsts.where(F.col("fc_ord").isNotNull()).select("route_num", "batch", "fc_ord"),
              ["route_num", "batch"])
        .where(F.col("_o") > F.col("fc_ord"))
        .groupBy("route_num", "batch")
        .agg(*_first(F.lit(True), "_o", {"ts": "ts", "seq": "seq", "loc": "loc"}, "fic"))
    )
    summ = firsts.join(fic, ["route_num", "batch"], "left").select(
        "route_num", "batch",
        _struct_of("fi", ["ts", "seq", "loc"]).alias("fi"),
        _struct_of("fc", ["ts", "seq", "duration"]).alias("fc"),
        _struct_of("fic", ["ts", "seq", "loc"]).alias("fic"),
    )
    b = bundle_rows if bundle_rows is not None else bundles(positions)
    return summ.join(b, ["route_num", "batch"], "full").select(
        "route_num", "batch", "fi", "fc", "fic", F.coalesce("n_pos", F.lit(0)).cast("long").alias("n_pos"), "hist"
    )


def _transition(has_i, has_c, has_ic, has_b):
    nxt_after_i = F.when(has_b, EXPECT_CLEAR).otherwise(EXPECT_USERS)
    return F.array(
        F.when(has_i, nxt_after_i).otherwise(EXPECT_INCIDENT),
        F.when(has_b, EXPECT_CLEAR).otherwise(EXPECT_USERS),
        F.when(has_c, F.when(has_ic, nxt_after_i).otherwise(EXPECT_INCIDENT)).otherwise(EXPECT_CLEAR),
    )


def lifecycle_chunks(incidents: DataFrame, positions: DataFrame | None, levels=DEFAULT_LEVELS,
                     bundle_rows: DataFrame | None = None) -> DataFrame:
    """Resolved chunks: start state, accepted messages and carried route values."""
    return resolve_chunks(chunk_summaries(incidents, positions, bundle_rows), levels)


def resolve_chunks(ch: DataFrame, levels=DEFAULT_LEVELS) -> DataFrame:
    """``lifecycle_chunks`` from ready chunk summaries (``chunk_summaries`` or a
    stream's chunk log).

    The summaries (one row per route and batch) are written as one stage: the
    scan tree reads them instead of summarising the events again per level.
    """
    ch = materialise(ch.select("route_num", "batch", "fi", "fc", "fic", "n_pos", "hist"), "chunks")
    has_i, has_c, has_ic = F.col("fi").isNotNull(), F.col("fc").isNotNull(), F.col("fic").isNotNull()
    has_b = F.col("n_pos") > 0
    ch = ch.select("*", _transition(has_i, has_c, has_ic, has_b).alias("fn"))
    ch = prefix_states(ch, KEYS, "batch", "fn", 3, EXPECT_INCIDENT, levels, "s")

    s = F.col("s")
    acc_i_first = (s == EXPECT_INCIDENT) & has_i
    acc_c = (s == EXPECT_CLEAR) & has_c
    acc_i_after_c = acc_c & has_ic
    acc_b = has_b & (acc_i_first | (s == EXPECT_USERS) | acc_i_after_c)
    acc_i = F.when(acc_i_first, F.col("fi")).when(acc_i_after_c, F.col("fic"))
    # windows below run over chunk rows (one per route and batch), never over events
    wprev = key_window(KEYS, "batch")
    prev_loc = F.last(acc_i["loc"], ignorenulls=True).over(wprev)
    bundle_loc = F.when(acc_b & (s == EXPECT_USERS), prev_loc).when(acc_b, acc_i["loc"])
    b_tot = F.when(acc_b, F.col("n_pos")).otherwise(F.lit(0)).cast("long")
    # affected = positions of the accepted bundle strictly past the incident
    b_aff = F.when(
        acc_b,
        F.aggregate(F.filter("hist", lambda h: h["loc"] > bundle_loc), F.lit(0).cast("long"),
                    lambda acc, h: acc + h["n"]),
    ).otherwise(F.lit(0)).cast("long")
    ch = ch.select(
        "route_num", "batch", "fc", "s",
        apply_fn(F.col("fn"), s).alias("end_state"),
        acc_i.alias("acc_i"),
        acc_c.alias("acc_c"),
        acc_b.alias("acc_b"),
        prev_loc.alias("prev_loc"),
        F.last(acc_i["ts"], ignorenulls=True).over(wprev).alias("prev_occur_ts"),
        b_tot.alias("b_tot"),
        b_aff.alias("b_aff"),
    )
    return ch.select(
        "*",
        F.coalesce(F.sum("b_tot").over(wprev), F.lit(0)).cast("long").alias("cum_tot"),
        F.coalesce(F.sum("b_aff").over(wprev), F.lit(0)).cast("long").alias("cum_aff"),
        F.last(F.when(F.col("acc_b"), F.col("b_tot")), True).over(wprev).alias("last_b_tot"),
        F.last(F.when(F.col("acc_b"), F.col("b_aff")), True).over(wprev).alias("last_b_aff"),
    )


def incident_lifecycle(incidents: DataFrame, positions: DataFrame, levels=DEFAULT_LEVELS) -> DataFrame:
    """History rows (``hist_traffic``), one per accepted clear.

    ``users_total``/``users_affected`` are the route's running totals (parity
    with the surveyed system); ``incident_users``/``incident_affected`` are this
    incident's own bundle values; ``occur_ts`` is the accepted incident's time.
    """
    return _history_rows(lifecycle_chunks(incidents, positions, levels))


def _history_rows(ch: DataFrame) -> DataFrame:
    return ch.where("acc_c").select(
        F.col("fc.ts").alias("tod"),
        "route_num",
        F.col("prev_loc").alias("location"),
        F.col("cum_tot").alias("users_total"),
        F.col("cum_aff").alias("users_affected"),
        F.col("fc.duration").cast("int").alias("duration"),
        F.col("last_b_tot").alias("incident_users"),
        F.col("last_b_aff").alias("incident_affected"),
        F.col("prev_occur_ts").alias("occur_ts"),
    )


def lifecycle_from_messages(messages: DataFrame, levels=DEFAULT_LEVELS) -> DataFrame:
    """K1 over a typed message log (B4 layout, as drained by A7): the same
    history rows as ``incident_lifecycle`` on the tables the log came from.

    A route's bundle of a batch may arrive in several rows (one per epoch that
    saw part of it): they are one bundle, their counts per location are added.
    """
    inc = messages.where(F.col("rnk") == 0).select(
        "route_num", "batch", "ts", "seq", F.col("msg_type").alias("occur_clear"), "loc", "duration")
    per_loc = messages.where(F.col("rnk") == 1).select("route_num", "batch", F.inline("loc_hist")).groupBy(
        "route_num", "batch", "loc").agg(F.sum("n").alias("n"))
    bun = per_loc.groupBy("route_num", "batch").agg(
        F.sum("n").cast("long").alias("n_pos"), F.collect_list(F.struct("loc", "n")).alias("hist"))
    return _history_rows(lifecycle_chunks(inc, None, levels, bun))


def lifecycle_from_chunks(chunks: DataFrame, levels=DEFAULT_LEVELS) -> DataFrame:
    """K1 over a chunk log written by the stream (one row per route and closed batch)."""
    return _history_rows(resolve_chunks(chunks, levels))


def hist_traffic(incidents: DataFrame, positions: DataFrame, levels=DEFAULT_LEVELS) -> DataFrame:
    """The warehouse fact table: tod, route_num, location, users_total, users_affected, duration."""
    return incident_lifecycle(incidents, positions, levels).select(*S.HIST_TRAFFIC_SCHEMA.fieldNames())


def lifecycle_state(incidents: DataFrame, positions: DataFrame, levels=DEFAULT_LEVELS) -> DataFrame:
    """State per route after all messages: expect, location, counters."""
    ch = lifecycle_chunks(incidents, positions, levels)
    return ch.groupBy("route_num").agg(
        F.max_by("end_state", "batch").alias("expect"),
        F.max_by(F.col("acc_i.loc"), F.when(F.col("acc_i").isNotNull(), F.col("batch"))).alias("_last_loc"),
        F.sum("b_tot").cast("long").alias("users_total"),
        F.sum("b_aff").cast("long").alias("users_affected"),
        F.count("acc_i").cast("long").alias("incidents_reported"),
        F.count(F.when(F.col("acc_c"), 1)).cast("long").alias("incidents_cleared"),
    ).select(
        "route_num",
        "expect",
        F.when(F.col("expect") != EXPECT_INCIDENT, F.col("_last_loc")).alias("location"),
        "users_total",
        "users_affected",
        "incidents_reported",
        "incidents_cleared",
    )


def route_counters(state: DataFrame) -> DataFrame:
    """per-route users total/affected, incidents reported/cleared."""
    return state.select(
        "route_num", "users_total", "users_affected", "incidents_reported", "incidents_cleared"
    )


def global_counters(state: DataFrame) -> DataFrame:
    """the global counters; ``routes_affected`` moves with reported incidents."""
    return state.agg(
        F.sum("users_total").cast("long").alias("users_total"),
        F.sum("users_affected").cast("long").alias("users_affected"),
        F.sum("incidents_reported").cast("long").alias("incidents_reported"),
        F.sum("incidents_cleared").cast("long").alias("incidents_cleared"),
        F.sum("incidents_reported").cast("long").alias("routes_affected"),
        F.count(F.when(F.col("incidents_reported") > 0, 1)).cast("long").alias("routes_distinct_affected"),
    )


def current_incidents(state: DataFrame) -> DataFrame:
    """K7: routes with an incident in progress and its location."""
    return state.where(F.col("expect") != EXPECT_INCIDENT).select("route_num", "location")


def incident_history_pairs(incidents: DataFrame, positions: DataFrame, levels=DEFAULT_LEVELS) -> DataFrame:
    """K8: one record per cleared incident keyed by day, route and location."""
    h = incident_lifecycle(incidents, positions, levels)
    return h.select(
        F.to_date("occur_ts").cast("string").alias("day"),
        "route_num",
        "location",
        F.col("occur_ts").alias("occur_time"),
        F.col("tod").alias("clear_time"),
        F.col("incident_affected").alias("users_affected"),
        "duration",
    )


# ---------------------------------------------------------------------------
# K3: capped active incidents per route.
# ---------------------------------------------------------------------------

def capped_incidents(incidents: DataFrame, cap: int = S.INCIDENT_CAP, chunk: str = "10 seconds",
                     levels=DEFAULT_LEVELS) -> DataFrame:
    """Active incidents per route with a cap: an occur is dropped while ``cap``
    are active, a clear removes one (oldest first), a clear on none is ignored.

    The state is the active count 0..cap.  Each (route, ``chunk``) slice is
    folded once for every possible start count (its own messages only, in
    (ts, seq) order; the slice is bounded by the route's rate times ``chunk``),
    the start count of each slice comes from ``prefix_states`` over
    ``levels``, and the matching counters are summed per route.
    """
    n = cap + 1
    msgs = incidents.select(
        "route_num", F.window("ts", chunk).start.alias("chunk"),
        F.struct("ts", "seq", F.col("occur_clear").alias("o")).alias("m"),
    )
    chunks = msgs.groupBy("route_num", "chunk").agg(F.array_sort(F.collect_list("m")).alias("ms"))
    # fold: for each start count keep [count, reported, dropped, cleared, ignored]
    init = "transform(sequence(0, {c}), v -> array(v, 0, 0, 0, 0))".format(c=cap)
    step = (
        "transform(acc, a -> CASE WHEN x.o = 1 THEN "
        "  (CASE WHEN a[0] >= {c} THEN array(a[0], a[1], a[2] + 1, a[3], a[4]) "
        "        ELSE array(a[0] + 1, a[1] + 1, a[2], a[3], a[4]) END) "
        " ELSE (CASE WHEN a[0] = 0 THEN array(a[0], a[1], a[2], a[3], a[4] + 1) "
        "        ELSE array(a[0] - 1, a[1], a[2], a[3] + 1, a[4]) END) END)"
    ).format(c=cap)
    chunks = chunks.select(
        "route_num", "chunk", F.expr(f"aggregate(ms, {init}, (acc, x) -> {step})").alias("res")
    ).withColumn("fn", F.expr("transform(res, a -> a[0])"))
    # one written row per slice: the scan tree and the final pick read it
    chunks = materialise(chunks, "slices")
    chunks = prefix_states(chunks, KEYS, "chunk", "fn", n, 0, levels, "s")
    picked = chunks.select("route_num", "chunk", F.element_at("res", F.col("s") + 1).alias("r"))
    return picked.groupBy("route_num").agg(
        F.max_by(F.col("r")[0], "chunk").cast("long").alias("active"),
        F.sum(F.col("r")[1]).cast("long").alias("reported"),
        F.sum(F.col("r")[2]).cast("long").alias("dropped"),
        F.sum(F.col("r")[3]).cast("long").alias("cleared"),
        F.sum(F.col("r")[4]).cast("long").alias("ignored"),
    )
