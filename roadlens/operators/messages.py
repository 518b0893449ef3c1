"""Message-level operators: projections (C1-C3), bundles and the message log
(F2, B4), packed text (J3), publishing (B6), simple incident counters
(F3, F23, K2) and the expected clear time (J8)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from .. import schemas as S


# ---------------------------------------------------------------- parsing

def parse_json(df: DataFrame, schema: StructType, col: str = "value", keep_raw: bool = False) -> DataFrame:
    """JSON text -> record.  Malformed text gives null fields and
    ``_malformed`` = true instead of failing the batch (the surveyed consumer
    would raise); ``keep_raw`` passes the text on as ``_raw`` for rejects."""
    with_bad = StructType(list(schema.fields) + [StructField("_bad", StringType(), True)])
    parsed = F.from_json(F.col(col), with_bad, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_bad"})
    keep = [c for c in df.columns if c != col]
    raw = [F.col(col).alias("_raw")] if keep_raw else []
    return df.select(*keep, *raw, parsed.alias("_r")).select(
        *keep, *[c for c in ["_raw"] if keep_raw], *[F.col(f"_r.{f.name}").alias(f.name) for f in schema.fields],
        F.col("_r._bad").isNotNull().alias("_malformed"),
    )


def _int(c: str) -> Column:
    return F.expr(f"try_cast({c} AS INT)")


def ntz_of_text(c: Column) -> Column:
    """``yyyy-MM-dd HH:mm:ss`` text -> TIMESTAMP_NTZ, null for anything else.
    Parsed without the session zone, so no time is shifted by a zone's gaps."""
    return F.when(c.rlike(r"^\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2}$"), c.try_cast("timestamp_ntz"))


def text_of_ntz(c: Column | str) -> Column:
    """TIMESTAMP_NTZ -> ``yyyy-MM-dd HH:mm:ss`` text, without the session zone."""
    c = F.col(c) if isinstance(c, str) else c
    return F.substring(c.cast("timestamp_ntz").cast("string"), 1, 19)


def _ts(c: str) -> Column:
    return ntz_of_text(F.col(c))


def parse_incidents(df: DataFrame) -> DataFrame:
    """Wire accident record -> ``incidents`` columns (ints or strings on the wire)."""
    wire = set(S.USER_ACCIDENT_SCHEMA.fieldNames()) | {"_malformed"}
    return df.select(
        *[c for c in df.columns if c not in wire],
        _int("incident_route_num").alias("route_num"),
        _int("incident_loc").alias("loc"),
        _ts("ts").alias("ts"),
        _int("occur_clear").alias("occur_clear"),
        _int("accident_duration").alias("duration"),
    )


def parse_positions(df: DataFrame) -> DataFrame:
    """Wire position record -> ``positions`` columns."""
    wire = set(S.USER_POS_SCHEMA.fieldNames()) | {"_malformed"}
    return df.select(
        *[c for c in df.columns if c not in wire],
        _int("user_route_num").alias("route_num"),
        _int("user_loc").alias("loc"),
        F.col("user_id"),
        _ts("ts").alias("ts"),
    )


def incident_problem(malformed: Column | None = None) -> Column:
    """Why parsed incident columns cannot be used (null: they can); the same rule
    for streams and tables."""
    bad = F.lit(False) if malformed is None else malformed
    return (
        F.when(bad, "malformed").when(F.col("route_num").isNull(), "route").when(F.col("loc").isNull(), "loc")
        .when(F.col("ts").isNull(), "ts").when(~F.coalesce(F.col("occur_clear").isin(0, 1), F.lit(False)), "occur_clear")
    )


def position_problem(malformed: Column | None = None) -> Column:
    """Why parsed position columns cannot be used (null: they can)."""
    bad = F.lit(False) if malformed is None else malformed
    return (
        F.when(bad, "malformed").when(F.col("route_num").isNull(), "route").when(F.col("loc").isNull(), "loc")
        .when(F.col("ts").isNull(), "ts")
    )


def parse_requests(df: DataFrame) -> DataFrame:
    """D8 on the wire: ``user_traffic`` record -> ``requests`` columns."""
    wire = set(S.USER_TRAFFIC_SCHEMA.fieldNames()) | {"_malformed"}
    return df.select(
        *[c for c in df.columns if c not in wire],
        _int("req_type").alias("req_type"), _int("sub_req_type").alias("sub_req_type"), F.col("user_id"),
        _int("route_id").alias("route_num"), _int("location").alias("loc"),
        F.expr("try_cast(`start` AS INT)").alias("start"), F.expr("try_cast(`end` AS INT)").alias("end"), _ts("ts").alias("ts"),
    )


def parse_pageviews(df: DataFrame) -> DataFrame:
    """F1 on the wire: ``pageviews`` record -> site_id, page_view, ts."""
    wire = set(S.PAGEVIEW_SCHEMA.fieldNames()) | {"_malformed"}
    return df.select(*[c for c in df.columns if c not in wire], "site_id", "page_view", _ts("ts").alias("ts"))


def parse_querylog(df: DataFrame) -> DataFrame:
    """B1 on the wire: ``querylog`` record -> query_type, ts, query_text."""
    wire = set(S.QUERYLOG_SCHEMA.fieldNames()) | {"_malformed"}
    return df.select(*[c for c in df.columns if c not in wire], _int("query_type").alias("query_type"), _ts("ts").alias("ts"), "query_text")


def wire_json(df: DataFrame, fields: dict[str, Column], keep: list[str]) -> DataFrame:
    """``keep`` columns and ``value``: the fields as one JSON object (null fields left out)."""
    return df.select(*keep, F.to_json(F.struct(*[c.alias(n) for n, c in fields.items()])).alias("value"))


def incident_wire_json(incidents: DataFrame) -> DataFrame:
    """Accident messages as JSON text; odd ``seq`` sends numbers as strings,
    the way the two producers differ on the wire."""
    as_str = F.col("seq") % 2 == 1

    def num(c: str) -> Column:
        txt = F.col(c).cast("string")
        return F.when(as_str, F.concat(F.lit('"'), txt, F.lit('"'))).otherwise(txt)

    body = F.concat(
        F.lit('{"incident_route_num":'), num("route_num"),
        F.lit(',"incident_loc":'), num("loc"),
        F.lit(',"ts":"'), text_of_ntz("ts"),
        F.lit('","occur_clear":'), num("occur_clear"),
        F.lit(',"accident_duration":'), num("duration"), F.lit("}"),
    )
    return incidents.select("seq", body.alias("value"))


# ---------------------------------------------------------------- bundles / log

def bundle_positions(positions: DataFrame) -> DataFrame:
    """one bundle per (batch, route): size and a per-location histogram.

    The histogram is bounded by the route length, unlike a list of every
    position, so a busy route never builds an unbounded row.
    """
    h = positions.groupBy("batch", "route_num", "loc").agg(F.count(F.lit(1)).alias("n"))
    return h.groupBy("batch", "route_num").agg(
        F.sum("n").cast("long").alias("n_positions"),
        F.array_sort(F.collect_list(F.struct("loc", "n"))).alias("loc_hist"),
    )


def build_messages(incidents: DataFrame, positions: DataFrame) -> DataFrame:
    """Both streams as one typed log ordered by (batch, rnk, ts, seq).

    Incidents and clears keep their own type code (rank 0); each (batch, route)
    bundle becomes one USERS message (rank 1) stamped with its first position.
    """
    inc = incidents.select(
        "batch", F.lit(0).alias("rnk"), "route_num", F.col("occur_clear").alias("msg_type"),
        "ts", "seq", "loc", "duration", F.lit(None).cast("long").alias("n_positions"),
    )
    bun = positions.groupBy("batch", "route_num").agg(
        F.min("ts").alias("ts"), F.min("seq").alias("seq"), F.count(F.lit(1)).alias("n_positions")
    ).select(
        "batch", F.lit(1).alias("rnk"), "route_num", F.lit(S.MSG_USERS).alias("msg_type"), "ts", "seq",
        F.lit(None).cast("int").alias("loc"), F.lit(None).cast("int").alias("duration"), "n_positions",
    )
    return inc.unionByName(bun)


# ---------------------------------------------------------------- packed text

def pack_incidents(incidents: DataFrame) -> DataFrame:
    """``type route loc day time flag duration`` lines (flag 1 occur / 0 clear)."""
    return incidents.select(
        "seq",
        F.concat_ws(
            " ",
            F.col("occur_clear").cast("string"), F.col("route_num").cast("string"), F.col("loc").cast("string"),
            text_of_ntz("ts"), F.col("occur_clear").cast("string"),
            F.col("duration").cast("string"),
        ).alias("value"),
    )


def pack_positions(positions: DataFrame) -> DataFrame:
    """``2 route (loc user day time)+`` lines, one position per line."""
    return positions.select(
        "seq",
        F.concat_ws(
            " ", F.lit(str(S.MSG_USERS)), F.col("route_num").cast("string"), F.col("loc").cast("string"),
            "user_id", text_of_ntz("ts"),
        ).alias("value"),
    )


def pack_position_lines(positions: DataFrame, per_line: int) -> DataFrame:
    """``2 route (loc user day time)+`` lines of up to ``per_line`` positions of a
    route in (ts, seq) order; ``seq`` is the smallest of the line."""
    w = Window.partitionBy("route_num").orderBy("ts", "seq")
    one = F.concat_ws(" ", F.col("loc").cast("string"), "user_id", text_of_ntz("ts"))
    numbered = positions.select("route_num", "ts", "seq", one.alias("p"), F.floor((F.row_number().over(w) - 1) / per_line).alias("line_no"))
    lines = numbered.groupBy("route_num", "line_no").agg(
        F.min("seq").alias("seq"), F.array_sort(F.collect_list(F.struct("ts", "seq", "p"))).alias("ps"))
    return lines.select("seq", F.concat_ws(
        " ", F.lit(str(S.MSG_USERS)), F.col("route_num").cast("string"), F.array_join(F.col("ps.p"), " ")).alias("value"))


def unpack_messages(lines: DataFrame, col: str = "value") -> DataFrame:
    """Decode packed lines into typed rows; USERS lines may hold many positions
    (strides of four tokens), each becomes its own row.

    ``problem`` is null on a good row.  A line that cannot be decoded (short,
    not a number where one belongs, unknown type) gives one row with the
    reason; a USERS line cut inside a stride gives its whole positions and one
    row for the rest.
    """
    tok = F.split(F.col(col), " ")

    def token(i) -> Column:
        return F.get(tok, i if isinstance(i, Column) else F.lit(i))

    def moment(i) -> Column:
        return ntz_of_text(F.concat_ws(" ", token(i), token(i + 1)))

    kind, route = token(0).try_cast("int"), token(1).try_cast("int")
    n_rest = F.size(tok) - 2
    n_pos = F.floor(n_rest / 4).cast("int")
    none = F.lit(None)

    def row(loc, user, ts, duration, problem) -> Column:
        return F.struct(loc.alias("loc"), user.alias("user_id"), ts.alias("ts"), duration.alias("duration"), problem.alias("problem"))

    def checked(loc, ts) -> Column:
        return F.when(loc.isNull(), "loc").when(ts.isNull(), "ts")

    def position(i) -> Column:
        loc, ts = token(i * 4 + 2).try_cast("int"), moment(i * 4 + 4)
        return row(loc, token(i * 4 + 3), ts, none.cast("int"), checked(loc, ts))

    cut = row(none.cast("int"), none.cast("string"), none.cast("timestamp_ntz"), none.cast("int"), F.lit("cut"))
    empty = F.array().cast("array<struct<loc:int,user_id:string,ts:timestamp_ntz,duration:int,problem:string>>")
    users = F.concat(
        F.when(n_pos > 0, F.transform(F.sequence(F.lit(0), n_pos - 1), position)).otherwise(empty),
        F.when((n_rest % 4 != 0) | (n_rest <= 0), F.array(cut)).otherwise(empty))
    loc, ts, duration = token(2).try_cast("int"), moment(3), token(6).try_cast("int")
    single = F.array(row(loc, none.cast("string"), ts, duration, F.coalesce(checked(loc, ts), F.when(duration.isNull(), "duration"))))
    keep = [c for c in lines.columns if c != col]
    rows = lines.select(
        *keep, kind.alias("msg_type"), route.alias("route_num"),
        F.explode(F.when(kind == S.MSG_USERS, users).when(kind.isin(S.MSG_CLEAR, S.MSG_INCIDENT), single).otherwise(F.array(cut))).alias("p"),
    )
    known = F.col("msg_type").isin(S.MSG_CLEAR, S.MSG_INCIDENT, S.MSG_USERS)
    problem = F.when(~F.coalesce(known, F.lit(False)), "type").when(F.col("route_num").isNull(), "route").otherwise(F.col("p.problem"))
    return rows.select(
        *keep, "msg_type", "route_num", F.col("p.loc").alias("loc"), F.col("p.user_id").alias("user_id"),
        F.col("p.ts").alias("ts"), F.col("p.duration").alias("duration"), problem.alias("problem"),
    )


# ---------------------------------------------------------------- publish

def position_wire_json(positions: DataFrame) -> DataFrame:
    """``user_pos`` JSON value per position (numbers as JSON ints)."""
    value = F.to_json(
        F.struct(
            F.col("route_num").alias("user_route_num"), F.col("loc").alias("user_loc"), "user_id",
            text_of_ntz("ts").alias("ts"),
        )
    )
    return positions.select("seq", "route_num", value.alias("value"))


def publish_keyed(df: DataFrame, key: Column, n: int = S.PUBLISH_KEY_SPACE) -> DataFrame:
    """``key`` = route % n, the key a keyed topic partitions by.  The rows stay
    where they are: the broker (or the folder layout of the file sink) groups
    them, so parallelism does not fall to the number of keys."""
    return df.withColumn("key", (key % n).cast("int"))


# ---------------------------------------------------------------- counters

def positions_by_route(positions: DataFrame) -> DataFrame:
    """positions per route (rows, not distinct users)."""
    return positions.groupBy("route_num").agg(F.count(F.lit(1)).alias("users_total"))


def incident_counters(incidents: DataFrame) -> DataFrame:
    """incident messages per route and in total (``is_total`` marks that
    row, so messages without a route keep a row of their own)."""
    return incidents.rollup("route_num").agg(
        F.count(F.lit(1)).alias("incidents"), (F.grouping("route_num") == 1).alias("is_total"))


def last_incident(incidents: DataFrame) -> DataFrame:
    """K2: last incident location per route, occur and clear alike.

    ``max_by`` over the exact (ts, seq) decimal key is a hash partial
    aggregate, so a hot route is reduced map-side without sorting.
    """
    from .lifecycle import ORDER_KEY

    return incidents.groupBy("route_num").agg(
        F.max_by("loc", F.expr(ORDER_KEY)).alias("location")
    )


def expected_clear_time(incidents: DataFrame) -> DataFrame:
    """A clear's time plus its duration in seconds."""
    clears = incidents.where(F.col("occur_clear") == 0)
    return clears.select(
        "seq", "route_num", "ts", "duration",
        (F.col("ts") + F.make_dt_interval(secs=F.col("duration").cast("decimal(18,6)"))).alias("expected_ts"),
    )
