"""Ordered per-key scans that never pull one key into one task.

The surveyed system folds each route's messages in a single process.  Here a
key's history is cut into *chunks* (a micro-batch, minute or second of one
key).  Everything
inside a chunk is computed with ordinary aggregates or chunk-local windows, so
a hot key is spread over as many tasks as it has batches.  What has to cross
chunk boundaries is carried by tiny per-chunk summaries:

* ``prefix_states`` composes per-chunk transition functions of a finite
  automaton with a hierarchical (period, coarser period, all) exclusive scan,
  so no list is longer than the number of chunks of one period.
* ``carry_last`` / ``keyed_lag`` / ``running_sum`` stitch chunk-local values to
  the previous chunks' summary rows (one row per key and batch).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialise

#: Safe for chunks of a second or longer: no list holds more than 60 elements.
DEFAULT_LEVELS = ("minute", "hour", "day", "month")

_UNIT_SECONDS = {"second": 1, "minute": 60, "hour": 3600, "day": 86400, "week": 604800}


def levels_for(interval: str) -> tuple[str, ...]:
    """Scan levels for chunks of ``interval`` (e.g. "4 seconds", "1 hour") so
    that no period holds more than 60 chunks or periods (366 days a year at
    the coarsest): a list of that length is composed in one task."""
    n, unit = interval.strip().split()
    secs = float(n) * _UNIT_SECONDS[unit.lower().rstrip("s")]
    if secs >= 86400:
        return ("year",)
    if secs >= 3600:
        return ("day", "month")
    if secs >= 60:
        return ("hour", "day", "month")
    if secs >= 1:
        return ("minute", "hour", "day", "month")
    return ("second", "minute", "hour", "day", "month")


_SCAN = (
    "aggregate({arr}, named_struct('acc', sequence(0, {m}), 'pre', cast(array() as array<array<int>>)),"
    " (s, x) -> named_struct('acc', transform(s.acc, v -> element_at(x.f, v + 1)),"
    " 'pre', concat(s.pre, array(s.acc))))"
)


def _scan_groups(df: DataFrame, gkeys: list[str], elem: str, fcol: str, n_states: int):
    """Exclusive prefix composition of transition functions inside each group.

    ``fcol`` holds ``array<int>`` of length ``n_states``: next state per state.
    Returns (per element: gkeys, elem, _pre) and (per group: gkeys, _F).
    """
    merged = df.groupBy(*gkeys).agg(
        F.array_sort(F.collect_list(F.struct(F.col(elem).alias("o"), F.col(fcol).alias("f")))).alias("_a")
    ).select(*gkeys, F.col("_a.o").alias("_os"), F.expr(_SCAN.format(arr="_a", m=n_states - 1)).alias("_s"))
    per_elem = merged.select(
        *gkeys, F.inline(F.arrays_zip(F.col("_os").alias(elem), F.col("_s.pre").alias("_pre")))
    )
    per_group = merged.select(*gkeys, F.col("_s.acc").alias("_F"))
    return per_elem, per_group


def prefix_states(
    chunks: DataFrame,
    keys: Sequence[str],
    order_col: str,
    fn_col: str,
    n_states: int,
    init: int = 0,
    levels: Sequence[str] = DEFAULT_LEVELS,
    out_col: str = "start_state",
) -> DataFrame:
    """State of a per-key automaton at the start of every chunk.

    ``chunks`` has one row per (keys, order_col) with ``fn_col`` = the chunk's
    transition function as ``array<int>`` (index = state before, value = state
    after).  ``order_col`` is a timestamp.  ``levels`` are ``date_trunc``
    units from fine to coarse; chunks are composed inside the finest period,
    periods inside coarser ones, so no list composed in one task is longer
    than the number of chunks of one finest period (``levels_for`` keeps that
    at 60).

    The chunk rows ride along in the finest period's array and are exploded
    back with their start state, so there is no join back to ``chunks``.
    """
    keys = list(keys)
    rest = [c for c in chunks.columns if c not in keys]
    lv = [f"_lv{i}" for i in range(len(levels))]
    base = chunks.select(*keys, *[F.date_trunc(u, F.col(order_col)).alias(c) for u, c in zip(levels, lv)],
                         F.struct(F.col(order_col).alias("o"), F.col(fn_col).alias("f"),
                                  F.struct(*rest).alias("row")).alias("_e"))
    g0 = base.groupBy(*keys, *lv).agg(F.array_sort(F.collect_list("_e")).alias("_a")).select(
        *keys, *lv, "_a", F.expr(_SCAN.format(arr="_a", m=n_states - 1)).alias("_s"))
    if lv:
        # coarser levels compose the finest periods' functions
        prefixes = []
        cur, elem, fcol = g0.select(*keys, *lv, F.col("_s.acc").alias("_F")), lv[0], "_F"
        for i in range(1, len(lv) + 1):
            gkeys = keys + lv[i:]
            per_elem, per_group = _scan_groups(cur, gkeys, elem, fcol, n_states)
            prefixes.append((gkeys, elem, per_elem))
            if i < len(lv):
                cur, elem, fcol = per_group, lv[i], "_F"
        gkeys, elem, top = prefixes[-1]
        states = top.select(*gkeys, elem, F.element_at("_pre", init + 1).alias("_st"))
        for gkeys, elem, per_elem in reversed(prefixes[:-1]):
            states = per_elem.join(states.withColumnRenamed("_st", "_pst"), on=gkeys).select(
                *gkeys, elem, F.expr("element_at(_pre, _pst + 1)").alias("_st"))
        g0 = g0.join(states, on=keys + lv)
        start = F.col("_st")
    else:
        start = F.lit(init)
    out = g0.select(
        *keys, F.explode(F.arrays_zip(F.col("_a").alias("e"), F.col("_s.pre").alias("p"))).alias("_z"),
        start.alias("_st0"),
    )
    return out.select(
        *keys, *[F.col(f"_z.e.row.{c}").alias(c) for c in rest],
        F.expr("element_at(_z.p, _st0 + 1)").alias(out_col),
    )


def apply_fn(fn: Column, state: Column) -> Column:
    """Next state: ``fn[state]`` for an ``array<int>`` transition function."""
    return F.element_at(fn, state + 1)


def key_window(keys: Sequence[str], order_col: str, preceding_only: bool = True) -> Window:
    w = Window.partitionBy(*keys).orderBy(order_col)
    if preceding_only:
        return w.rowsBetween(Window.unboundedPreceding, -1)
    return w.rowsBetween(Window.unboundedPreceding, Window.currentRow)


def _placed(local: DataFrame, ckeys: list[str]) -> DataFrame:
    """The chunk-local result as one written stage: its summaries and the join
    back read it, so the exchange and the window below it run once."""
    return materialise(local, "scan")


def carry_last(
    df: DataFrame,
    keys: Sequence[str],
    chunk_col: str,
    order: Sequence[str | Column],
    value: str,
    out_col: str,
    inclusive: bool = True,
    descending: bool = False,
) -> DataFrame:
    """Last non-null ``value`` at (or strictly before) each row in key order.

    Order is (chunk_col, *order), reversed when ``descending`` (then it is the
    *next* value).  Inside a chunk a chunk-local window does the work and marks
    the chunk's own last value; rows with nothing earlier in their chunk take
    the previous chunks' last value from a per-(key, chunk) summary.
    """
    keys = list(keys)
    ckeys = keys + [chunk_col]
    ordcols = [F.col(o) if isinstance(o, str) else o for o in order]
    sort = [c.desc() for c in ordcols] if descending else ordcols
    w = Window.partitionBy(*ckeys).orderBy(*sort)
    frame_end = Window.currentRow if inclusive else -1
    local = _placed(
        df.withColumn("_loc_last", F.last(value, ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, frame_end)))
        .withColumn("_thru", F.last(value, ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
        .withColumn("_end", F.lead(F.lit(1)).over(w).isNull()), ckeys)
    wc = Window.partitionBy(*keys).orderBy(F.col(chunk_col).desc() if descending else F.col(chunk_col))
    carry = F.last("_thru", ignorenulls=True).over(wc.rowsBetween(Window.unboundedPreceding, -1))
    summary = local.where("_end").select(*ckeys, "_thru").select(*ckeys, carry.alias("_carry"))
    return (
        local.join(summary, on=ckeys, how="left")
        .withColumn(out_col, F.coalesce(F.col("_loc_last"), F.col("_carry")))
        .drop("_loc_last", "_thru", "_end", "_carry")
    )


def running_sum(
    df: DataFrame,
    keys: Sequence[str],
    chunk_col: str,
    order: Sequence[str | Column],
    value: str,
    out_col: str,
    low_col: str | None = None,
) -> DataFrame:
    """Running sum of ``value`` per key in (chunk_col, *order) order, chunked.

    With ``low_col`` also the smallest running sum so far (the row's own included).
    """
    keys = list(keys)
    ckeys = keys + [chunk_col]
    ordcols = [F.col(o) if isinstance(o, str) else o for o in order]
    w = Window.partitionBy(*ckeys).orderBy(*ordcols)
    upto = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    local = df.withColumn("_loc_sum", F.coalesce(F.sum(value).over(upto), F.lit(0)).cast("long"))
    local = local.withColumn("_loc_low", F.min("_loc_sum").over(upto) if low_col else F.lit(None).cast("long"))
    local = _placed(local.withColumn("_end", F.lead(F.lit(1)).over(w).isNull()), ckeys)
    before = F.coalesce(F.sum("_loc_sum").over(key_window(keys, chunk_col)), F.lit(0))
    summary = local.where("_end").select(*ckeys, "_loc_sum", "_loc_low").withColumn("_before", before)
    summary = summary.withColumn(
        "_low_before", F.min(F.col("_before") + F.col("_loc_low")).over(key_window(keys, chunk_col))
    ).select(*ckeys, "_before", "_low_before")
    out = local.join(summary, on=ckeys, how="left").withColumn(out_col, F.col("_before") + F.col("_loc_sum"))
    if low_col:
        out = out.withColumn(low_col, F.least("_low_before", F.col("_before") + F.col("_loc_low")))
    return out.drop("_loc_sum", "_loc_low", "_end", "_before", "_low_before")


def keyed_lag(
    df: DataFrame,
    keys: Sequence[str],
    chunk_col: str,
    order: Sequence[str | Column],
    value: str,
    out_col: str,
) -> DataFrame:
    """``lag(value)`` in (chunk_col, *order) order per key, across chunks."""
    keys = list(keys)
    ckeys = keys + [chunk_col]
    ordcols = [F.col(o) if isinstance(o, str) else o for o in order]
    w = Window.partitionBy(*ckeys).orderBy(*ordcols)
    local = _placed(
        df.withColumn("_kl_lag", F.lag(value).over(w)).withColumn("_kl_first", F.row_number().over(w) == 1)
        .withColumn("_kl_end", F.lead(F.lit(1)).over(w).isNull()), ckeys)
    prev = local.where("_kl_end").select(
        *ckeys, F.lag(value).over(Window.partitionBy(*keys).orderBy(chunk_col)).alias("_kl_prev"))
    return (
        local.join(prev, on=ckeys, how="left")
        .withColumn(out_col, F.when(F.col("_kl_first"), F.col("_kl_prev")).otherwise(F.col("_kl_lag")))
        .drop("_kl_lag", "_kl_first", "_kl_end", "_kl_prev")
    )


def global_running_sum(df: DataFrame, ts: str, order: Sequence[str], value: str, out_col: str, store: bool = True) -> DataFrame:
    """Running sum over all rows in (ts, *order) order, without a window over all of them.

    Sums per second are offset inside their hour, hours inside their day, days
    inside their month; the months (a few per year) are added up in one array.
    ``store=False`` writes no table between the steps: for a ``df`` that is read from one.
    """
    units = ("second", "hour", "day", "month")
    cols = {u: f"_gs_{u}" for u in units}
    local = df.withColumns({cols[u]: F.date_trunc(u, F.col(ts)).cast("timestamp_ntz") for u in units})
    w = Window.partitionBy(cols["second"]).orderBy(ts, *order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    local = local.withColumn("_gs_in", F.sum(value).over(w).cast("long"))
    out = local = _placed(local, []) if store else local
    totals = local.groupBy(*[cols[u] for u in units]).agg(F.sum(value).alias("_gs_t"))
    totals = materialise(totals, "seconds") if store else totals
    for fine, coarse in zip(units, units[1:]):
        by = [cols[u] for u in units[units.index(fine):]]
        level = totals.groupBy(*by).agg(F.sum("_gs_t").alias("_gs_t"))
        offset = F.coalesce(F.sum("_gs_t").over(key_window([cols[coarse]], cols[fine])), F.lit(0))
        level = level.select(cols[fine], offset.alias(f"_gs_off_{fine}"))
        out = out.join(level, cols[fine])
    months = totals.groupBy(cols["month"]).agg(F.sum("_gs_t").alias("t")).agg(
        F.array_sort(F.collect_list(F.struct(F.col(cols["month"]).alias("m"), "t"))).alias("a"))
    months = months.select(F.inline(F.transform("a", lambda x, i: F.struct(
        x["m"].alias(cols["month"]),
        F.aggregate(F.slice(F.col("a"), F.lit(1), i), F.lit(0).cast("long"), lambda acc, y: acc + y["t"]).alias("_gs_off_month")))))
    out = out.join(months, cols["month"])
    total = F.col("_gs_in")
    for u in units:
        total = total + F.col(f"_gs_off_{u}")
    return out.withColumn(out_col, total).drop("_gs_in", *cols.values(), *[f"_gs_off_{u}" for u in units])


def ranks(df: DataFrame, keys: Sequence[str], order: Sequence[Column], out_col: str) -> DataFrame:
    """Place of every row among the rows of its ``keys`` in ``order``, from 1, without a window
    over a key's rows.

    Range partitions by (keys, order) hold contiguous stretches of each key, and a row
    id counts inside a partition: one summary row per key and partition is summed up,
    so a key with most of the rows is ranked by as many tasks as it fills.
    """
    keys = list(keys)
    by = [F.col(k).asc_nulls_first() for k in keys] + list(order)
    placed = _placed(df.repartitionByRange(*by).sortWithinPartitions(*by).withColumn("_rk_row", F.monotonically_increasing_id()), keys)
    placed = placed.withColumn("_rk_part", F.shiftright("_rk_row", 33))
    before = F.coalesce(F.sum("_n").over(key_window([f"_k{i}" for i in range(len(keys))], "_part")), F.lit(0))
    spans = placed.groupBy(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)], F.col("_rk_part").alias("_part")).agg(
        F.min("_rk_row").alias("_first"), F.count(F.lit(1)).alias("_n"))
    spans = spans.select(*[f"_k{i}" for i in range(len(keys))], "_part", (before - F.col("_first") + 1).alias("_shift"))
    same = F.col("_rk_part") == F.col("_part")
    for i, k in enumerate(keys):
        same = same & F.col(k).eqNullSafe(F.col(f"_k{i}"))
    return placed.join(spans, same).withColumn(out_col, (F.col("_rk_row") + F.col("_shift")).cast("int")).select(*df.columns, out_col)
