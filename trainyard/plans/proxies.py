"""Timetable-shaped inputs derived from the driver's test tables.

The test tables are not rail data, so each function maps columns of them
onto the inputs the operators expect (raw plan / change rows, event rows,
station entries, planned paths, timetable events).  Every derivation uses
whole tables; nothing is sampled or capped, so the work grows with the
data.  ``__spark_entry__`` runs the real operators on these frames and
carries the equivalent SQL for the DuckDB check.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trainyard.functions.delay import signed_delay
from trainyard.functions.times import time_key
from trainyard.operators.fact import order_key


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _plus(ts, n, unit: str):
    return F.timestamp_add(unit, n, ts)


def _stamp(ts):
    """timestamp -> YYMMDDHHMM text (as the XML attributes carry it)."""
    return F.date_format(ts, "yyMMddHHmm")


# ------------------------------------------------------------ lake inputs
# The movement proxy spans one week (as a timetable snapshot series does),
# so the date/hour layout has 7 x 24 folders at every scale.
WEEK0 = "2025-09-01 00:00:00"
EPOCH_DAY = "1995-01-01"


def _in_week(day_col, hours, minutes):
    """Week start + (days since EPOCH_DAY mod 7) + hours + minutes."""
    days = F.datediff(F.to_date(day_col), F.lit(EPOCH_DAY).cast("date")) % 7
    t = F.timestamp_add("DAY", days, F.lit(WEEK0).cast("timestamp_ntz"))
    return _plus(_plus(t, hours, "HOUR"), minutes, "MINUTE")


def plan_raw(spark, sf_dir) -> DataFrame:
    """orders -> raw plan rows (one stop per order)."""
    o = table(spark, sf_dir, "orders")
    dep = _in_week("o_orderdate", F.col("o_orderkey") % 24,
                   F.col("o_custkey") % 60)
    return o.select(
        F.concat(F.lit("S"), (F.col("o_custkey") % 40).cast("string"))
        .alias("station_name"),
        F.col("o_orderkey").cast("string").alias("stop_id"),
        F.col("o_orderpriority").alias("train_category"),
        F.col("o_custkey").cast("string").alias("train_number"),
        F.when(F.col("o_orderstatus") != "O", _plus(dep, F.lit(-7), "MINUTE"))
        .alias("planned_arrival"),
        F.substring("o_orderpriority", 1, 1).alias("platform_arrival"),
        F.when(F.col("o_orderstatus") != "F", dep).alias("planned_departure"),
        F.substring("o_orderpriority", 1, 1).alias("platform_departure"),
    )


def change_raw(spark, sf_dir) -> DataFrame:
    """lineitem -> raw change rows; the snapshot stamp is the hour of the
    (week-mapped) ship time."""
    li = table(spark, sf_dir, "lineitem")
    base = _in_week("l_shipdate", F.col("l_orderkey") % 24,
                    F.col("l_linenumber") * 7)
    stamp = F.concat(F.date_format(base, "yyMMddHH"), F.lit("00"))
    return li.select(
        F.col("l_orderkey").cast("string").alias("stop_id"),
        F.when(F.col("l_discount") >= 0.03, base).alias("actual_arrival"),
        F.col("l_linenumber").cast("string")
        .alias("actual_platform_arrival"),
        F.when(F.col("l_returnflag") == "R", "c")
        .when(F.col("l_returnflag") == "A", "a").alias("arrival_status"),
        F.when(F.col("l_tax") >= 0.02,
               _plus(base, F.col("l_linenumber") * 4, "MINUTE"))
        .alias("actual_departure"),
        (F.col("l_suppkey") % 10).cast("string")
        .alias("actual_platform_departure"),
        F.when((F.col("l_linestatus") == "O") & (F.col("l_returnflag") == "N"),
               "c").when(F.col("l_linestatus") == "F", "p")
        .alias("departure_status"),
        F.concat(F.lit("changes/"), stamp, F.lit("/"),
                 F.col("l_suppkey").cast("string"), F.lit(".xml"))
        .alias("source_file"),
        stamp.alias("update_timestamp"),
    )


# ------------------------------------------------------------ star inputs
def _unk():
    return F.struct(F.lit("UNK").alias("category"),
                    F.lit("UNK").alias("train_number"),
                    F.lit("").alias("owner"), F.lit("").alias("trip_type"),
                    F.lit("").alias("filter_flags"))


def _li_seq(phase: int):
    """Order key (phase, orderkey, linenumber, partkey)."""
    return order_key(phase, F.col("l_orderkey"), F.col("l_linenumber"),
                     F.col("l_partkey"))


def _month():
    return F.date_trunc("month", "l_shipdate").cast("timestamp_ntz")


def _li_key():
    return [
        time_key("month").alias("snapshot_time_key"),
        F.col("l_suppkey").alias("station_key"),
        F.concat("l_returnflag", "l_linestatus").alias("stop_id"),
        F.when(F.col("l_linenumber") % 2 == 1, "A").otherwise("D")
        .alias("event_type"),
    ]


def plan_rows(spark, sf_dir) -> DataFrame:
    """lineitem -> plan-phase event rows."""
    # made in front of the keys, whose digits each ask for the time
    li = table(spark, sf_dir, "lineitem").withColumns({
        "month": _month(), "planned": F.when(F.col("l_discount") != 0, _plus(
            F.col("l_shipdate"), F.col("l_linenumber"), "HOUR"))})
    unk = F.col("l_quantity") < 5
    train = F.when(unk, _unk()).otherwise(F.struct(
        F.concat(F.lit("T"), F.col("l_linenumber").cast("string"))
        .alias("category"),
        F.col("l_partkey").cast("string").alias("train_number"),
        F.lit("").alias("owner"), F.lit("").alias("trip_type"),
        F.lit("").alias("filter_flags")))
    return li.select(
        F.lit(0).alias("phase"), _li_seq(0).alias("seq"), *_li_key(),
        train.alias("train"),
        time_key("planned").alias("planned_time_key"),
        F.lit(None).cast("long").alias("changed_time_key"),
        F.lit(None).cast("string").alias("event_status"),
        F.when(F.col("l_tax") != 0, F.col("l_linenumber").cast("string"))
        .alias("planned_platform"),
        F.lit(None).cast("string").alias("changed_platform"),
        F.when(F.col("l_quantity") <= 40, F.concat(
            F.lit("L"), (F.col("l_suppkey") % 5).cast("string")))
        .alias("line"),
        F.when(F.col("l_returnflag") != "R", F.concat(
            F.lit("P"), F.col("l_partkey").cast("string")))
        .alias("planned_path"),
        F.lit(None).cast("int").alias("delay_minutes"),
        F.lit(False).alias("is_cancelled"),
    )


def change_rows(spark, sf_dir) -> DataFrame:
    """lineitem -> change-phase event rows (own planned time, changed time,
    status, delay text)."""
    li = table(spark, sf_dir, "lineitem").withColumns({
        "month": _month(),
        "planned": F.when(F.col("l_quantity") >= 10, F.col("l_shipdate")),
        "changed": F.when(F.col("l_discount") <= 0.08, _plus(
            F.col("l_shipdate"), F.col("l_linenumber") * 13, "MINUTE"))})
    train = F.when(F.col("l_linestatus") == "O", _unk()).otherwise(F.struct(
        F.concat(F.lit("T"), (F.col("l_linenumber") + 1).cast("string"))
        .alias("category"),
        F.col("l_partkey").cast("string").alias("train_number"),
        F.lit("o").alias("owner"), F.lit("").alias("trip_type"),
        F.lit("").alias("filter_flags")))
    pt, ct = F.col("planned"), F.col("changed")
    dc = F.when(F.col("l_quantity") > 45, F.col("l_linenumber").cast("string")) \
        .when(F.col("l_quantity") < 2, F.lit("--5"))
    status = F.when(F.col("l_returnflag") == "R", "c") \
        .when(F.col("l_returnflag") == "A", "a")
    return li.select(
        F.lit(1).alias("phase"), _li_seq(1).alias("seq"), *_li_key(),
        train.alias("train"),
        time_key(pt).alias("planned_time_key"),
        time_key(ct).alias("changed_time_key"),
        status.alias("event_status"),
        F.when(F.col("l_quantity") >= 25, F.concat(
            F.lit("X"), F.col("l_linenumber").cast("string")))
        .alias("planned_platform"),
        F.when(F.col("l_tax") <= 0.05,
               (F.col("l_suppkey") % 9).cast("string"))
        .alias("changed_platform"),
        F.when(F.col("l_discount") >= 0.02, F.concat(
            F.lit("CL"), F.col("l_linenumber").cast("string"))).alias("line"),
        F.when(F.col("l_linenumber") != 3, F.concat(
            F.lit("CP"), F.col("l_orderkey").cast("string")))
        .alias("planned_path"),
        signed_delay(dc, pt, ct).alias("delay_minutes"),
        F.coalesce(status == "c", F.lit(False)).alias("is_cancelled"),
    )


def supplier_entries(spark, sf_dir) -> DataFrame:
    """supplier -> station entries (one EVA each, with coordinates)."""
    s = table(spark, sf_dir, "supplier")
    eva = F.struct(F.col("s_suppkey").alias("number"),
                   F.lit(True).alias("isMain"),
                   F.struct(F.array(F.col("s_nationkey").cast("double"),
                                    F.col("s_acctbal") / 100.0)
                            .alias("coordinates"))
                   .alias("geographicCoordinates"))
    return s.select(F.col("s_name").alias("name"),
                    F.array(eva).alias("evaNumbers"),
                    F.struct(F.col("s_suppkey")).alias("entry_order"))


def customer_entries(spark, sf_dir) -> DataFrame:
    """customer -> station entries with two EVA numbers, a main flag on the
    second for one segment, 2- or 3-value coordinates, no EVA for one
    segment, and names with prefixes/blanks/underscores."""
    c = table(spark, sf_dir, "customer")
    lat = F.col("c_acctbal") / 100.0
    lon = F.col("c_nationkey").cast("double")
    coords1 = F.when(F.col("c_acctbal") > 5000, F.array(lon, lat, F.lit(0.0))) \
        .otherwise(F.array(lon, lat))
    e1 = F.struct((F.lit(8000000) + F.floor(F.col("c_custkey") / 3))
                  .cast("long").alias("number"),
                  F.when(F.col("c_acctbal") < 0, F.lit(False)).alias("isMain"),
                  F.struct(coords1.alias("coordinates"))
                  .alias("geographicCoordinates"))
    e2 = F.struct((F.lit(9000000) + F.col("c_nationkey")).cast("long")
                  .alias("number"),
                  (F.col("c_mktsegment") == "BUILDING").alias("isMain"),
                  F.struct(F.array(lat, lon).alias("coordinates"))
                  .alias("geographicCoordinates"))
    evas = F.when(F.col("c_mktsegment") == "AUTOMOBILE",
                  F.array().cast("array<struct<number:bigint,isMain:boolean,"
                                 "geographicCoordinates:struct<coordinates:"
                                 "array<double>>>>")) \
        .otherwise(F.array(e1, e2))
    k = F.col("c_custkey") % 4
    name = F.when(k == 0, F.col("c_name")) \
        .when(k == 1, F.concat(F.lit("Berlin_"), F.col("c_name"))) \
        .when(k == 2, F.concat(F.lit(" berlin   "), F.col("c_mktsegment"))) \
        .otherwise(F.concat(F.lit("BERLIN"), F.col("c_mktsegment")))
    return c.select(name.alias("name"), evas.alias("evaNumbers"),
                    F.struct(F.col("c_custkey")).alias("entry_order"))


# ------------------------------------------------------------ graph inputs
def lineitem_paths(spark, sf_dir) -> DataFrame:
    """lineitem -> departure rows with a planned path of four stations
    (prefix rewrite, suffixes, blank and emptied segments)."""
    li = table(spark, sf_dir, "lineitem")

    def n(c):
        return F.round(c).cast("int").cast("string")
    e1 = F.concat(F.lit("Berlin-Hub "), F.col("l_linenumber").cast("string"))
    e2 = F.concat(F.lit("Stop "), n(F.col("l_quantity")), F.lit(" (S)"))
    e3 = F.when(F.col("l_returnflag") == "R", F.lit("(S)")) \
        .when(F.col("l_returnflag") == "A", F.lit(" ")) \
        .otherwise(F.concat(F.lit("Stop "), n(F.col("l_tax") * 100)))
    e4 = F.concat(F.lit("Stop "), n(F.col("l_discount") * 100 + 40))
    return li.select(F.lit("D").alias("event_type"),
                     F.concat_ws("|", e1, e2, e3, e4).alias("planned_path"))


def event_timetable(spark, sf_dir) -> DataFrame:
    """events -> timetable events: train = user, station from ``props.k``,
    click/view departures, signup/purchase arrivals, errors cancelled."""
    ev = table(spark, sf_dir, "events")
    k = F.get_json_object("props", "$.k").cast("int")
    et = F.when(F.col("event_type").isin("click", "view"), "D") \
        .when(F.col("event_type").isin("signup", "purchase"), "A")
    return ev.filter(F.col("event_type") != "error").select(
        F.col("user_id").alias("train_key"),
        F.concat(F.lit("S"), F.floor(k / 3).cast("string")).alias("station"),
        et.alias("event_type"), F.col("ts"),
        F.col("event_id").cast("string").alias("stop_id"),
        F.to_date("ts").alias("date"))
