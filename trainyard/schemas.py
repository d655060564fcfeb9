"""Schemas of the inputs and of the tables the jobs write."""

from pyspark.sql import types as T

S = T.StringType()

_EVENT_FIELDS = ["_pt", "_pp", "_ct", "_cp", "_cs", "_dc", "_l", "_ppth"]
EVENT = T.StructType([T.StructField(f, S) for f in _EVENT_FIELDS])
TRAIN_LABEL = T.StructType([T.StructField(f, S) for f in
                            ["_c", "_n", "_o", "_t", "_f"]])
STOP = T.StructType([
    T.StructField("_id", S),
    T.StructField("tl", TRAIN_LABEL),
    T.StructField("ar", EVENT),
    T.StructField("dp", EVENT),
])
# Union of every attribute read from plan and change documents; the corrupt
# record column receives the text of files that do not parse.
TIMETABLE_XML = T.StructType([
    T.StructField("_station", S),
    T.StructField("_eva", S),
    T.StructField("s", T.ArrayType(STOP)),
    T.StructField("_bad", S),
])

EVA_NUMBER = T.StructType([
    T.StructField("number", T.LongType()),
    T.StructField("isMain", T.BooleanType()),
    T.StructField("geographicCoordinates", T.StructType([
        T.StructField("coordinates", T.ArrayType(T.DoubleType())),
    ])),
])
STATION_ENTRY = T.StructType([
    T.StructField("name", S),
    T.StructField("evaNumbers", T.ArrayType(EVA_NUMBER)),
])
STATION_JSON = T.StructType([
    T.StructField("result", T.ArrayType(STATION_ENTRY)),
])

DIM_STATION = T.StructType([
    T.StructField("station_key", T.LongType(), False),
    T.StructField("eva", T.LongType(), False),
    T.StructField("station_name", S, False),
    T.StructField("lat", T.DoubleType()),
    T.StructField("lon", T.DoubleType()),
])

DIM_TRAIN_PARTS = ["category", "train_number", "owner", "trip_type",
                   "filter_flags"]

FACT_COLUMNS = [
    "movement_key", "station_key", "train_key", "snapshot_time_key",
    "stop_id", "event_type", "planned_time_key", "changed_time_key",
    "event_status", "planned_platform", "changed_platform", "line",
    "planned_path", "delay_minutes", "is_cancelled",
]

RAW_PLAN_COLUMNS = [
    "station_name", "stop_id", "train_category", "train_number",
    "planned_arrival", "platform_arrival", "planned_departure",
    "platform_departure",
]
RAW_CHANGE_COLUMNS = [
    "stop_id", "actual_arrival", "actual_platform_arrival", "arrival_status",
    "actual_departure", "actual_platform_departure", "departure_status",
    "source_file", "update_timestamp",
]
MOVEMENT_COLUMNS = [
    "stop_id", "station_name", "train_category", "train_number",
    "planned_arrival", "actual_arrival", "arrival_delay_minutes",
    "planned_departure", "actual_departure", "departure_delay_minutes",
    "is_cancelled", "date", "hour",
]
