"""Schemas, enumerations and fixed values shared by batch and stream code."""

from __future__ import annotations

from pyspark.sql import types as T

# --------------------------------------------------------------------------
# Fixed values (must equal the surveyed system's for identical results).
# --------------------------------------------------------------------------

# Message log type codes.
MSG_CLEAR, MSG_INCIDENT, MSG_USERS = 0, 1, 2

# Request types and update sub-types.
REQ_REGISTER, REQ_SIGNOFF, REQ_QUERY, REQ_ADD_ROUTE, REQ_UPDATE = 0, 1, 2, 3, 4
SUB_ACCIDENT, SUB_OTHER, SUB_CLEAR, SUB_POS = 0, 1, 2, 3

# Query-log types.
QUERY_SPECIFIC, QUERY_AVG, QUERY_DATE_BASED = 0, 1, 2

# Road-condition sentences.
ROAD_CLEAR_TEXT = "No incidents on Route %s"
ROAD_INCIDENT_TEXT = "Incident(s) on Route %s at location %s"

# Timestamp text format of the wire messages.
TS_TEXT_FORMAT = "yyyy-MM-dd HH:mm:ss"

# Reach of the "affected" predicates (positions within 2 of the incident).
AFFECTED_REACH = 2

# Active incidents kept per route by the capped tracker (a sixth is dropped).
INCIDENT_CAP = 5

# Partition-key space of the keyed publisher.
PUBLISH_KEY_SPACE = 18

# Violations CSV: the 35 positional columns, in file order (our spelling of
# accident / vehicle_type / geo_location), and the 0-based positions of the
# eleven yes/no columns.
VIOLATION_COLUMNS = (
    "date_of_stop", "time_of_stop", "agency", "subagency", "description",
    "location", "latitude", "longitude", "accident", "belts",
    "personal_injury", "property_damage", "fatal", "commercial_license",
    "hazmat", "commercial_vehicle", "alcohol", "work_zone", "state",
    "vehicle_type", "year", "make", "model", "color", "violation_type",
    "charge", "article", "contributed_to_accident", "race", "gender",
    "driver_city", "driver_state", "dl_state", "arrest_type", "geo_location",
)
VIOLATION_BOOL_POSITIONS = (8, 9, 10, 11, 12, 13, 14, 15, 16, 17, 27)
VIOLATION_DOUBLE_COLUMNS = ("latitude", "longitude")
VIOLATION_INT_COLUMNS = ("year",)
VIOLATION_KEY = ("driver_state", "driver_city", "date_of_stop", "time_of_stop")

# Our own sample text per query type; no result depends on the wording.
STOCK_QUERY_TEXTS = (
    "locations of stops of drivers from one state",
    "mean model year of vehicles from one state",
    "locations of stops before a given day",
)

# --------------------------------------------------------------------------
# Wire schemas.  Numbers arrive as JSON ints from one producer and as strings
# from another, so every field is read as STRING and cast with try_cast.
# --------------------------------------------------------------------------


def _strings(*names: str) -> T.StructType:
    return T.StructType([T.StructField(n, T.StringType(), True) for n in names])


USER_POS_SCHEMA = _strings("user_route_num", "user_loc", "user_id", "ts")
USER_ACCIDENT_SCHEMA = _strings(
    "incident_route_num", "incident_loc", "ts", "occur_clear", "accident_duration"
)
USER_TRAFFIC_SCHEMA = _strings(
    "req_type", "sub_req_type", "ts", "user_id", "route_id", "start", "end", "location"
)
PAGEVIEW_SCHEMA = _strings("site_id", "page_view", "ts")
QUERYLOG_SCHEMA = _strings("ts", "query_type", "query_text")

# Canonical logical tables.
INCIDENTS_SCHEMA = T.StructType([
    T.StructField("route_num", T.IntegerType()),
    T.StructField("loc", T.IntegerType()),
    T.StructField("ts", T.TimestampNTZType()),
    T.StructField("occur_clear", T.IntegerType()),
    T.StructField("duration", T.IntegerType()),
    T.StructField("seq", T.LongType()),
])
POSITIONS_SCHEMA = T.StructType([
    T.StructField("route_num", T.IntegerType()),
    T.StructField("loc", T.IntegerType()),
    T.StructField("user_id", T.StringType()),
    T.StructField("ts", T.TimestampNTZType()),
    T.StructField("seq", T.LongType()),
])
HIST_TRAFFIC_SCHEMA = T.StructType([
    T.StructField("tod", T.TimestampNTZType()),
    T.StructField("route_num", T.IntegerType()),
    T.StructField("location", T.IntegerType()),
    T.StructField("users_total", T.LongType()),
    T.StructField("users_affected", T.LongType()),
    T.StructField("duration", T.IntegerType()),
])
