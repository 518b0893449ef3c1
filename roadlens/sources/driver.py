"""Adapter: the driver's generated tables -> the domain tables.

The mapping (SURVEY §7.2) is the specification shared with the SQL oracle in
``roadlens.plans.oracle``; both sides must compute the same columns.

* ``route_num``  = user_id % 10
* ``loc``        = floor(value) % 23
* ``error`` -> INCIDENT, ``purchase`` -> CLEAR, other event types -> positions
* ``duration``   = 5 + props.k % 10 on clears, 0 on incidents
* ``batch``      = the hour window start of ``ts`` (TIMESTAMP_NTZ)
* ``seq``        = event_id (total tie-break inside equal ``ts``)
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas as S

ROUTE_KEY_SPACE = 10
LOC_KEY_SPACE = 23
DEFAULT_BATCH = "1 hour"

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem",
    "events", "documents", "embeddings", "pages", "benchmark", "labels",
    "conversations",
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def batch_of(ts: Column | str, interval: str = DEFAULT_BATCH) -> Column:
    """Tumbling batch key (G1) as TIMESTAMP_NTZ, independent of the session zone."""
    return F.window(ts, interval).start


def domain_events(events: DataFrame, batch: str = DEFAULT_BATCH) -> DataFrame:
    """Columns every domain view derives from the raw event rows."""
    return events.select(
        "event_type",
        "ts",
        F.col("event_id").alias("seq"),
        F.col("user_id").alias("uid"),
        (F.col("user_id") % ROUTE_KEY_SPACE).cast("int").alias("route_num"),
        (F.floor("value") % LOC_KEY_SPACE).cast("int").alias("loc"),
        F.get_json_object("props", "$.k").cast("int").alias("k"),
        batch_of("ts", batch).alias("batch"),
    )


def incidents(events: DataFrame, batch: str = DEFAULT_BATCH) -> DataFrame:
    """``incidents``: route_num, loc, ts, occur_clear, duration, seq, batch."""
    ev = domain_events(events, batch).where(F.col("event_type").isin("error", "purchase"))
    occur = F.col("event_type") == "error"
    return ev.select(
        "route_num",
        "loc",
        "ts",
        F.when(occur, 1).otherwise(0).alias("occur_clear"),
        F.when(occur, 0).otherwise(5 + F.col("k") % 10).cast("int").alias("duration"),
        "seq",
        "batch",
    )


def positions(events: DataFrame, batch: str = DEFAULT_BATCH) -> DataFrame:
    """``positions``: route_num, loc, user_id, ts, seq, batch."""
    ev = domain_events(events, batch).where(F.col("event_type").isin("click", "signup", "view"))
    return ev.select(
        "route_num", "loc", F.col("uid").cast("string").alias("user_id"), "ts", "seq", "batch"
    )


def requests(events: DataFrame, batch: str = DEFAULT_BATCH) -> DataFrame:
    """``requests``: req_type, sub_req_type, user_id, route_num, loc, ts, seq, batch.

    signup REGISTER, purchase SIGNOFF, view QUERY, error UPDATE/ACCIDENT,
    click UPDATE/CLEAR.
    """
    et = F.col("event_type")
    req = (
        F.when(et == "signup", S.REQ_REGISTER)
        .when(et == "purchase", S.REQ_SIGNOFF)
        .when(et == "view", S.REQ_QUERY)
        .otherwise(S.REQ_UPDATE)
    )
    sub = F.when(et == "error", S.SUB_ACCIDENT).when(et == "click", S.SUB_CLEAR)
    return domain_events(events, batch).select(
        req.cast("int").alias("req_type"),
        sub.cast("int").alias("sub_req_type"),
        F.col("uid").cast("string").alias("user_id"),
        "route_num",
        "loc",
        "ts",
        "seq",
        "batch",
    )


def pageview_events(events: DataFrame) -> DataFrame:
    """Page-view stream rows: site_id = user_id, page_view = event_id."""
    return events.select(
        F.col("user_id").cast("string").alias("site_id"),
        F.col("event_id").cast("string").alias("page_view"),
        "ts",
    )


def querylog_events(events: DataFrame) -> DataFrame:
    """Query-log rows; ts truncated to the hour so primary keys collide."""
    et = F.col("event_type")
    qtype = F.when(et == "view", S.QUERY_SPECIFIC).when(et == "click", S.QUERY_AVG).otherwise(
        S.QUERY_DATE_BASED
    )
    texts = F.array(*[F.lit(t) for t in S.STOCK_QUERY_TEXTS])
    return events.select(
        qtype.cast("int").alias("query_type"),
        batch_of("ts").alias("ts"),
        "event_id",
    ).select(
        "query_type",
        "ts",
        F.element_at(texts, F.col("query_type") + 1).alias("query_text"),
        F.col("event_id").alias("seq"),
    )


def route_lengths(events: DataFrame) -> DataFrame:
    """Route ids seen in the data with their lengths 11 + (id * 7) % 12."""
    ids = events.select((F.col("user_id") % ROUTE_KEY_SPACE).cast("int").alias("route_id")).distinct()
    return ids.select("route_id", (11 + (F.col("route_id") * 7) % 12).cast("int").alias("length"))


# --------------------------------------------------------------------------
# Text inputs built from the TPC-H tables.  The expressions are SQL text so the
# oracle builds byte-identical lines.
# --------------------------------------------------------------------------

YES_NO_CYCLE = ("Yes", "No", "yes", "YES", "", "maybe")


def _bool_field(i: int, dialect: str) -> str:
    """Yes/no cell cycling through the literal cases; array lookup in Spark SQL,
    list indexing in DuckDB (same values)."""
    vals = ", ".join(f"'{v}'" for v in YES_NO_CYCLE)
    if dialect == "spark":
        return f"element_at(array({vals}), CAST((o_orderkey + {i}) % 6 + 1 AS INT))"
    return f"[{vals}][(o_orderkey + {i}) % 6 + 1]"


def _violation_fields(dialect: str = "spark") -> list[str]:
    s = "CAST({} AS STRING)".format
    f: list[str] = [
        s("CAST(date_trunc('month', o_orderdate) AS DATE)"),                # date_of_stop: keys collide
        f"lpad({s('o_orderkey % 3')}, 2, '0') || ':00'",                    # time_of_stop
        f"'Agency ' || lpad({s('o_orderkey')}, 12, '0')",                   # agency: unique, orders the upserts
        "o_orderpriority",                                                  # subagency
        # description: quoted with ", " / quoted comma without a blank / plain
        "CASE o_orderkey % 7 WHEN 0 THEN '\"' || c_name || ', ' || o_orderpriority || '\"' "
        "WHEN 3 THEN '\"' || c_name || ',' || o_orderstatus || '\"' ELSE c_name END",
        f"'LOC ' || {s('c_nationkey')}",                                     # location
        f"CASE WHEN o_orderkey % 9 = 5 THEN '' ELSE {s('c_nationkey')} || '.' || {s('o_orderkey % 1000')} END",
        f"'-' || {s('o_custkey % 180')} || '.' || {s('o_orderkey % 97')}",  # longitude
    ]
    f += [_bool_field(i, dialect) for i in range(8, 18)]                             # 10 yes/no columns
    f += [
        "substr(c_mktsegment, 1, 2)",                                       # state
        "o_orderpriority",                                                  # vehicle_type
        s("year(o_orderdate)"),                                             # year
        f"'MAKE' || {s('o_custkey % 13')}",
        f"CASE WHEN o_orderkey % 8 = 2 THEN '' ELSE 'M' || {s('o_orderkey % 31')} END",
        "o_orderstatus",                                                    # color
        "CASE o_orderkey % 2 WHEN 0 THEN 'Citation' ELSE 'Warning' END",
        f"'21-' || {s('o_orderkey % 900')}",                                # charge
        "'Transportation Article'",
        _bool_field(27, dialect),                                                    # contributed_to_accident
        "CASE o_custkey % 3 WHEN 0 THEN 'WHITE' WHEN 1 THEN 'BLACK' ELSE 'ASIAN' END",
        "CASE o_custkey % 2 WHEN 0 THEN 'F' ELSE 'M' END",
        f"'CITY' || {s('c_nationkey')}",                                     # driver_city
        "c_mktsegment",                                                     # driver_state
        "substr(c_mktsegment, 2, 2)",                                       # dl_state
        "'A - Marked Patrol'",
        f"'\"(' || {s('c_nationkey')} || '.5, -' || {s('o_custkey % 180')} || '.25)\"'",
    ]
    return f


def violation_line_sql() -> str:
    """One CSV text line per order: 35 fields with the literal quirks mixed in.

    orderkey % 5 = 1 -> ends in one comma, = 2 -> ends in two commas,
    % 11 = 4 -> short line (20 fields), % 13 = 6 -> long line (extra values).
    """
    fields = _violation_fields("duckdb")
    full = " || ',' || ".join(fields)
    short = " || ',' || ".join(fields[:20])
    return (
        "CASE WHEN o_orderkey % 11 = 4 THEN " + short + " "
        "WHEN o_orderkey % 13 = 6 THEN " + full + " || ',extra1,extra2' "
        "WHEN o_orderkey % 5 = 1 THEN " + " || ',' || ".join(fields[:-1]) + " || ',' "
        "WHEN o_orderkey % 5 = 2 THEN " + " || ',' || ".join(fields[:-2]) + " || ',,' "
        "ELSE " + full + " END"
    )


def violation_lines(orders: DataFrame, customer: DataFrame) -> DataFrame:
    """``value`` text lines (plus ``o_orderkey``) for the violations normaliser.

    Same lines as ``violation_line_sql`` but the 35 fields are built once as an
    array and cut by length, which keeps the generated code small.
    """
    joined = orders.join(customer, orders.o_custkey == customer.c_custkey)
    fields = F.array(*[F.expr(f) for f in _violation_fields()])
    k = F.col("o_orderkey")
    n = F.when(k % 11 == 4, 20).when(k % 13 == 6, 35).when(k % 5 == 1, 34).when(k % 5 == 2, 33).otherwise(35)
    tail = F.when(k % 11 == 4, "").when(k % 13 == 6, ",extra1,extra2").when(k % 5 == 1, ",").when(
        k % 5 == 2, ",,").otherwise("")
    staged = joined.select("o_orderkey", fields.alias("_f"), n.alias("_n"), tail.alias("_t"))
    return staged.select(
        "o_orderkey", F.concat(F.concat_ws(",", F.slice("_f", F.lit(1), F.col("_n"))), F.col("_t")).alias("value")
    )


CSV_PAIR_LINE_SQL = "p_name || ',' || CAST(p_size AS STRING)"


def csv_pair_lines(part: DataFrame) -> DataFrame:
    return part.select(F.expr(CSV_PAIR_LINE_SQL).alias("value"))


def text_lines(documents: DataFrame) -> DataFrame:
    """Whole document texts as the source of the word set (one value per document)."""
    return documents.select(F.col("text").alias("value"))
