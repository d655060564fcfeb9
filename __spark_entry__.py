"""

The driver's tables are not rail data; ``trainyard.plans.proxies`` maps them
onto timetable-shaped inputs (see the table in README.md) and every query
below runs the library's operators on whole tables.  Each oracle is written
independently in DuckDB SQL over the same views.
"""

from __future__ import annotations

import functools
import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trainyard.functions.delay import clamped_delay, signed_delay
from trainyard.functions.text import normalize_station
from trainyard.functions.times import calendar_columns, parse_stamp, time_key
from trainyard.operators import analysis as A
from trainyard.operators import checks as C
from trainyard.operators import dims as D
from trainyard.operators import fact as FT
from trainyard.operators import graph as G
from trainyard.operators import lake as L
from trainyard.operators.common import cut_lineage
from trainyard.operators.nearest import nearest_station
from trainyard.plans import proxies as P
from trainyard.plans.lake import run_lake_pipeline
from trainyard.plans.star import (apply_event_rows, build_star, read_star,
                                  write_star)
from trainyard.schemas import STOP
from pyspark.sql import types as T
from trainyard.session import (apply_runtime_conf, ensure_checkpoint_dir,
                               work_dir)
from trainyard.sources.stations import read_station_entries
from trainyard.sources.tables import (read_movements, write_file,
                                      write_movements, write_parquet)
from trainyard.sources.xml import (read_change_raw, read_plan_raw,
                                   write_timetable_xml)

SMOKE_DIR = "/root/testdata/sf0.001"
DEPARTURE = "2024-01-01 00:00:00"
HOP_SOURCE = "Berlin Hub 1"


def _prep(spark: SparkSession) -> None:
    apply_runtime_conf(spark)
    ensure_checkpoint_dir(spark)


# ===================================================================== lake
def movements(spark, d) -> DataFrame:
    return L.build_movements(P.plan_raw(spark, d), P.change_raw(spark, d))


def q_latest_update(spark, d):
    return L.latest_updates(P.change_raw(spark, d))


def q_merge_left_delay(spark, d):
    return movements(spark, d)


def q_partitioned_write(spark, d):
    path = work_dir(spark, "movements")
    write_movements(movements(spark, d), path)
    return read_movements(spark, path)


def q32_daily_mean(spark, d):
    r = A.daily_mean_delay(movements(spark, d))
    return r.select("station_name", F.round("final_avg", 6).alias("final_avg"),
                    "days")


def q33_peak_hours(spark, d):
    return A.peak_hour_departures(movements(spark, d))


# ===================================================================== star
def fact_rows(spark, d):
    return P.plan_rows(spark, d).unionByName(P.change_rows(spark, d))


def star_fact(spark, d):
    return FT.upsert_fact(fact_rows(spark, d))


FACT_OUT = ["snapshot_time_key", "station_key", "stop_id", "event_type",
            "planned_time_key", "changed_time_key", "event_status",
            "planned_platform", "changed_platform", "line", "planned_path",
            "delay_minutes", "is_cancelled"]
TRAIN_PARTS = ["category", "train_number", "owner", "trip_type",
               "filter_flags"]


def q_fact_upsert(spark, d):
    return star_fact(spark, d).select(
        *FACT_OUT, *[F.col(f"train.{p}").alias(p) for p in TRAIN_PARTS])


def _log_rows(rows: DataFrame) -> DataFrame:
    """Event rows as a log keeps them: one file per snapshot and station."""
    return rows.withColumn("folder", F.concat(
        F.lit("w/"), F.col("snapshot_time_key").cast("string"))).withColumn(
        "file", F.concat(F.col("station_key").cast("string"), F.lit(".xml")))


def q_incremental_load(spark, d):
    """Batches out of order: the changes first, then the plans, then both
    replayed, the older one last; read back."""
    base = work_dir(spark, "star")
    plans = _log_rows(P.plan_rows(spark, d))
    changes = _log_rows(P.change_rows(spark, d))
    apply_event_rows(spark, changes, base, incremental=False)
    apply_event_rows(spark, plans, base, batch="plans")
    apply_event_rows(spark, changes, base)
    apply_event_rows(spark, plans, base)
    apply_event_rows(spark, plans, base, batch="plans")    # in the ledger
    fact = spark.read.parquet(os.path.join(base, "fact_train_movement"))
    trains = spark.read.parquet(os.path.join(base, "dim_train"))
    return fact.join(trains, "train_key").select(
        *FACT_OUT, "category", "train_number", "owner", "trip_type",
        "filter_flags")


def q_load_constraints(spark, d):
    """A load whose rows break the schema's constraints: statuses outside
    p/a/c, missing stop ids, and train keys (here the train number alone)
    that several trains share.  What was quarantined, by rule, and what the
    tables hold."""
    base = work_dir(spark, "star-checked")
    changes = P.change_rows(spark, d)
    line = F.col("seq.second")
    rows = P.plan_rows(spark, d).unionByName(
        changes.withColumn("event_status", F.when(
            (line == 5) & (F.col("event_status") == "a"), "x")
            .otherwise(F.col("event_status")))
        .withColumn("stop_id", F.when(line != 6, F.col("stop_id"))))

    def key(train):
        return F.coalesce(train["train_number"].try_cast("long"), F.lit(-1))

    apply_event_rows(spark, _log_rows(rows), base, incremental=False,
                     key=key)
    stars = {n: spark.read.parquet(os.path.join(base, n)) for n in
             ("quarantine", "event_log", "dim_train", "fact_train_movement")}
    dangling = stars["fact_train_movement"].join(
        stars["dim_train"], "train_key", "left_anti")
    parts = [stars["quarantine"].groupBy("rule").count()] + [
        df.agg(F.lit(name).alias("rule"), F.count("*").alias("count"))
        for name, df in (("loaded", stars["event_log"]),
                         ("facts", stars["fact_train_movement"]),
                         ("trains", stars["dim_train"]),
                         ("facts without train", dangling))]
    return functools.reduce(DataFrame.unionByName, parts) \
        .withColumnRenamed("count", "n")


def supplier_dim(spark, d):
    return D.build_dim_station(P.supplier_entries(spark, d))


def q21_station_lookup(spark, d):
    s = P.table(spark, d, "supplier")
    req = s.select(F.col("s_suppkey").alias("request_id"), F.when(
        F.col("s_suppkey") % 2 == 0, F.lower(F.substring("s_name", 7, 6)))
        .otherwise(F.substring("s_name", 15, 3)).alias("text"))
    return A.station_lookup_batch(supplier_dim(spark, d), req)


def q22_nearest(spark, d):
    c = P.table(spark, d, "customer")
    pts = c.select(F.col("c_custkey").alias("request_id"),
                   (F.col("c_acctbal") / 100.0).alias("lat"),
                   F.col("c_nationkey").cast("double").alias("lon"))
    # station coordinates: lat = s_acctbal / 100, lon = s_nationkey
    return nearest_station(supplier_dim(spark, d), pts) \
        .select("request_id", "station_name")


def q23_cancelled_distinct(spark, d):
    return A.cancelled_trains(star_fact(spark, d))


def q24_avg_delay(spark, d):
    return A.avg_departure_delay(star_fact(spark, d), supplier_dim(spark, d),
                                 "supplier")


def _part_dim(spark, d):
    """part -> stations named by their part's name and key."""
    p = P.table(spark, d, "part")
    return p.select(
        F.col("p_partkey").alias("station_key"),
        F.col("p_partkey").alias("eva"),
        F.concat_ws(" ", "p_name", F.col("p_partkey").cast("string"))
        .alias("station_name"), (F.col("p_size") / 1.0).alias("lat"),
        F.col("p_retailprice").alias("lon"))


def q21_wildcards(spark, d):
    """Lookup texts with wildcards, short ones, and texts no name has."""
    c = P.table(spark, d, "customer")
    k, n = F.col("c_custkey"), F.col("c_custkey").cast("string")
    text = F.when(k % 8 == 0, F.concat(F.lit("%"), n)) \
        .when(k % 8 == 1, F.concat(F.substring(n, 1, 1), F.lit("_"),
                                   F.substring(n, 2, 2))) \
        .when(k % 8 == 2, F.repeat(F.lit("_"), (k % 40).cast("int"))) \
        .when(k % 8 == 3, F.upper(F.concat(F.lit("r%"), n))) \
        .when(k % 8 == 4, F.lit("")) \
        .when(k % 8 == 5, F.concat(F.lit(" "), n)) \
        .when(k % 8 == 6, F.substring("c_name", 1, 4)) \
        .otherwise(F.concat(F.lit("\\_"), n))
    return A.station_lookup_batch(_part_dim(spark, d), c.select(
        k.alias("request_id"), text.alias("text")))


def q22_uneven(spark, d):
    """Stations in one dense town with an outlier far away; points in the
    town, around it and far off."""
    town = _part_dim(spark, d).select(
        "station_name", (F.col("lat") / 10_000 + 52.5).alias("lat"),
        (F.col("lon") / 100_000 + 13.4).alias("lon"))
    far = spark.range(1).select(
        F.lit("null island").alias("station_name"), F.lit(0.0).alias("lat"),
        F.lit(0.0).alias("lon"))
    c = P.table(spark, d, "customer")
    near = F.col("c_custkey") % 3 != 0
    points = c.select(
        F.col("c_custkey").alias("request_id"),
        F.when(near, F.col("c_acctbal") / 1_000_000 + 52.5)
        .otherwise(F.col("c_acctbal") / 120).alias("lat"),
        F.when(near, F.col("c_nationkey") / 1000 + 13.4)
        .otherwise(F.col("c_nationkey") * 7 - 80.0).alias("lon"))
    return nearest_station(town.unionByName(far), points).select(
        "request_id", "station_name")


def q23_one_snapshot(spark, d):
    """Cancellations of one snapshot of the XML load, by its stamp."""
    return A.cancelled_trains(_star(spark, d).fact, SNAPSHOTS[1])


def q32_absent_station(spark, d):
    """A station without movements gives no row."""
    mv = cut_lineage(movements(spark, d), "movements")
    r = A.daily_mean_delay(mv, "S3").unionByName(
        A.daily_mean_delay(mv, "Nowhere"))
    return r.select("station_name", F.round("final_avg", 6)
                    .alias("final_avg"), "days")


def q33_top(spark, d):
    """The report's first rows: most peak departures, ties by name."""
    return A.peak_hour_departures(movements(spark, d), top=7)


def q21_lookup_single(spark, d):
    """Single-text lookup as the original query: ILIKE with the text between
    wildcards, first by name."""
    return A.station_lookup(supplier_dim(spark, d), "plier#0")


def q_connections_star(spark, d):
    """Timetable connections from the star schema: fact x station x time
    (planned times), non-cancelled A/D events, D followed by A per train
    and date."""
    fact = star_fact(spark, d)
    times = D.build_dim_time(FT.observed_times(fact_rows(spark, d)))
    ev = G.timetable_events(fact, supplier_dim(spark, d), times)
    return G.connections(ev).drop("train_id")


def q_connections_day(spark, d):
    """Timetable connections of one date; the date reaches the fact scan."""
    base = work_dir(spark, "star-day")
    rows = fact_rows(spark, d)
    FT.upsert_fact(rows).write.parquet(base)
    times = D.build_dim_time(FT.observed_times(rows))
    ev = G.timetable_events(spark.read.parquet(base), supplier_dim(spark, d),
                            times, "1995-03-10")
    return G.connections(ev).drop("train_id")


def q_dim_time(spark, d):
    o = P.table(spark, d, "orders").select(F.col("o_orderdate").alias("ts"))
    li = P.table(spark, d, "lineitem").select(F.col("l_shipdate").alias("ts"))
    ev = P.table(spark, d, "events").select(
        F.date_trunc("minute", "ts").cast("timestamp_ntz").alias("ts"))
    return D.build_dim_time(o.unionByName(li).unionByName(ev))


def _part_trains(spark, d):
    p = P.table(spark, d, "part")
    tl = F.struct(
        F.when(F.col("p_size") < 5, F.lit("")).otherwise(F.col("p_brand"))
        .alias("_c"),
        F.col("p_type").alias("_n"),
        F.col("p_size").cast("string").alias("_o"),
        F.when(F.col("p_size") > 25, F.lit("p")).alias("_t"),
        F.lit(None).cast("string").alias("_f"))
    return p.select(D.train_parts(tl).alias("train"))


def q_dim_train(spark, d):
    return D.build_dim_train(_part_trains(spark, d)).drop("train_key")


def q_unknown_member(spark, d):
    t = D.build_dim_train(_part_trains(spark, d))
    return t.filter((F.col("category") == "UNK") &
                    (F.col("train_number") == "UNK")) \
        .groupBy("owner", "trip_type", "filter_flags") \
        .agg(F.count(F.lit(1)).alias("n"))


def q_dim_station_last_wins(spark, d):
    return D.build_dim_station(P.customer_entries(spark, d))


def q_station_alias(spark, d):
    return D.build_station_aliases(P.customer_entries(spark, d))


def q_json_explode(spark, d):
    path = work_dir(spark, "stations-json")
    e = P.customer_entries(spark, d).drop("entry_order")
    e.select(F.to_json(F.struct(F.array(F.struct("name", "evaNumbers"))
                                .alias("result"))).alias("value")) \
        .write.mode("overwrite").text(path)
    entries = read_station_entries(spark, path, multi_line=False)
    return D.station_records(entries).drop("entry_order")


def _event_docs(spark, d):
    ev = P.table(spark, d, "events")
    k = F.get_json_object("props", "$.k").cast("int")
    snap = F.concat(F.date_format("ts", "yyMMddHH"), F.lit("00"))
    fname = F.concat(F.lit("STOP_"), k.cast("string"),
                     F.lit("_timetable.xml"))
    return ev.select(
        "event_id",
        F.when(F.col("event_type") == "view", F.lit(None).cast("string"))
        .otherwise(F.concat(F.lit("STOP_"), k.cast("string")))
        .alias("_station"),
        fname.alias("file_name"), snap.alias("snapshot"),
        F.concat(F.lit("/w/"), snap, F.lit("/"), F.col("event_id")
                 .cast("string"), F.lit("/"), fname).alias("file_path"),
        F.when(F.col("value") > 19.0, F.lit("<timetable")).alias("_bad"),
        F.lit(None).cast(T.ArrayType(STOP)).alias("s"))


def _nation_entries(spark, d):
    n = P.table(spark, d, "nation")
    eva = F.struct((F.lit(7000000) + F.col("n_nationkey")).cast("long")
                   .alias("number"), F.lit(True).alias("isMain"),
                   F.struct(F.lit(None).cast("array<double>")
                            .alias("coordinates"))
                   .alias("geographicCoordinates"))
    return n.select(F.concat(F.lit("Stop "), F.col("n_nationkey")
                             .cast("string")).alias("name"),
                    F.array(eva).alias("evaNumbers"),
                    F.struct(F.col("n_nationkey")).alias("entry_order"))


def _resolved_events(spark, d):
    from trainyard.sources.xml import split_rejects
    docs = _event_docs(spark, d)
    good, bad = split_rejects(docs)
    e = _nation_entries(spark, d)
    ok, skipped = FT.resolve_plan_docs(good, D.build_station_aliases(e),
                                       D.build_dim_station(e))
    return docs, ok, bad.unionByName(skipped)


def q_station_resolve(spark, d):
    _, ok, _ = _resolved_events(spark, d)
    return ok.select("event_id", "station_key")


def q_load_stats(spark, d):
    docs, ok, rej = _resolved_events(spark, d)
    return FT.load_statistics(docs.select("snapshot", "file_path"), rej, ok) \
        .drop("no_document")


def q_event_unpivot(spark, d):
    li = P.table(spark, d, "lineitem")
    ev_t = "struct<_pt:string,_pp:string>"
    stop = F.struct(
        F.col("l_orderkey").cast("string").alias("_id"),
        F.when(F.col("l_discount") > 0.02, F.struct(
            F.date_format("l_shipdate", "yyMMddHHmm").alias("_pt"),
            F.col("l_linenumber").cast("string").alias("_pp")))
        .cast(ev_t).alias("ar"),
        F.when(F.col("l_tax") > 0.01, F.struct(
            F.date_format(F.timestamp_add("HOUR", F.lit(2), "l_shipdate"),
                          "yyMMddHHmm").alias("_pt"),
            F.lit(None).cast("string").alias("_pp"))).cast(ev_t).alias("dp"))
    s = li.select("l_orderkey", "l_linenumber", stop.alias("stop"))
    u = FT.unpivot_events(s)
    return u.select("l_orderkey", "l_linenumber", "event_type",
                    F.col("ev._pt").alias("pt"), F.col("ev._pp").alias("pp"))


def q_check_unique(spark, d):
    return C.duplicate_keys(P.table(spark, d, "lineitem"),
                            ["l_orderkey", "l_linenumber"], "unique")


def q_check_fk(spark, d):
    o = P.table(spark, d, "orders").select("o_orderkey", "o_custkey")
    return C.missing_references(o, "o_custkey", P.table(spark, d, "customer"),
                                "c_custkey", "fk customer")


def q_check_fk_missing(spark, d):
    """Keys of line items, shifted so that some have no part."""
    li = P.table(spark, d, "lineitem").select(
        "l_orderkey", "l_linenumber", (F.col("l_partkey") * 2)
        .alias("part"))
    return C.missing_references(li, "part", P.table(spark, d, "part"),
                                "p_partkey", "fk part")


def q_check_domain(spark, d):
    li = P.table(spark, d, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_returnflag", "l_linestatus",
        "l_discount")
    ok = F.col("l_returnflag").isin("A", "N") & \
        F.col("l_linestatus").isin("O", "F") & \
        F.col("l_discount").between(0.0, 0.09)
    return C.failed_check(li, ok, "domain")


def _stamp_text():
    hrs = F.timestamp_add("HOUR", F.col("o_orderkey") % 24, "o_orderdate")
    return F.when(F.col("o_orderstatus") == "F",
                  F.date_format(hrs, "yyMMddHHmm")) \
        .when(F.col("o_orderstatus") == "O",
              F.concat(F.date_format("o_orderdate", "yyMM"), F.lit("321200"))) \
        .otherwise(F.concat(F.lit(" "), F.substring("o_orderpriority", 1, 9)))


def q_parse_stamp(spark, d):
    o = P.table(spark, d, "orders").select("o_orderkey",
                                           _stamp_text().alias("s"))
    ts = parse_stamp("s")
    return o.select("o_orderkey", "s", ts.alias("ts"),
                    time_key(ts).alias("time_key"), *calendar_columns(ts))


def _delay_inputs(spark, d):
    o = P.table(spark, d, "orders")
    li = P.table(spark, d, "lineitem")
    j = li.join(o, li["l_orderkey"] == o["o_orderkey"])
    pt = F.when(F.col("o_orderstatus") != "P", F.timestamp_add(
        "HOUR", F.col("o_orderkey") % 24, "o_orderdate"))
    ct = F.when(F.col("l_discount") >= 0.03, F.timestamp_add(
        "MINUTE", F.col("l_linenumber") * 37, "l_shipdate"))
    dc = F.when(F.col("l_quantity") > 45, F.col("l_linenumber")
                .cast("string")) \
        .when(F.col("l_quantity") < 3, F.lit("--5")) \
        .when(F.col("l_quantity") < 4, F.lit(" 5"))
    return j.select("l_orderkey", "l_linenumber", pt.alias("pt"),
                    ct.alias("ct"), dc.alias("dc"))


def q_signed_delay(spark, d):
    x = _delay_inputs(spark, d)
    return x.select("l_orderkey", "l_linenumber",
                    signed_delay("dc", "pt", "ct").alias("delay_minutes"))


def q_clamped_delay(spark, d):
    x = _delay_inputs(spark, d)
    return x.select("l_orderkey", "l_linenumber",
                    clamped_delay("ct", "pt").alias("delay_minutes"))


def q_xml_roundtrip(spark, d):
    plan = P.plan_raw(spark, d)
    ev_t = "struct<_pt:string,_pp:string>"
    doc = plan.select(
        F.col("station_name").alias("_station"),
        F.lit(None).cast("string").alias("_eva"),
        F.array(F.struct(
            F.col("stop_id").alias("_id"),
            F.struct(F.col("train_category").alias("_c"),
                     F.col("train_number").alias("_n")).alias("tl"),
            F.struct(F.date_format("planned_arrival", "yyMMddHHmm")
                     .alias("_pt"), F.col("platform_arrival").alias("_pp"))
            .cast(ev_t).alias("ar"),
            F.struct(F.date_format("planned_departure", "yyMMddHHmm")
                     .alias("_pt"), F.col("platform_departure").alias("_pp"))
            .cast(ev_t).alias("dp"))).alias("s"))
    root = work_dir(spark, "xml-week")
    write_timetable_xml(doc, os.path.join(root, "2501010000"))
    return read_plan_raw(spark, root)


def q_change_roundtrip(spark, d):
    """Change stops written as XML, one document a line item, and read back
    as the raw change table."""
    raw = P.change_raw(spark, d)
    stamp = "yyMMddHHmm"
    doc = raw.select(
        F.lit(None).cast("string").alias("_station"),
        F.lit("8000001").alias("_eva"), F.array(F.struct(
            F.col("stop_id").alias("_id"),
            F.lit(None).cast("struct<_c:string,_n:string,_o:string,"
                             "_t:string,_f:string>").alias("tl"),
            _event(_ct=F.date_format("actual_arrival", stamp),
                   _cp=F.col("actual_platform_arrival"),
                   _cs=F.col("arrival_status")).alias("ar"),
            _event(_ct=F.date_format("actual_departure", stamp),
                   _cp=F.col("actual_platform_departure"),
                   _cs=F.col("departure_status")).alias("dp")))
        .alias("s"))
    root = work_dir(spark, "xml-changes")
    write_timetable_xml(doc, os.path.join(root, "week", SNAPSHOTS[0]))
    return read_change_raw(spark, root).drop("source_file")


def q_raw_tables(spark, d):
    """The raw plan table, written and read back."""
    path = work_dir(spark, "raw-plan")
    write_parquet(P.plan_raw(spark, d), path)
    return spark.read.parquet(path)


def _lake(spark, d):
    proot, croot, _ = _xml_star_inputs(spark, d)
    path = work_dir(spark, "lake")
    return path, run_lake_pipeline(spark, proot, croot, path)


def q_lake_from_xml(spark, d):
    """The lake pipeline on XML trees (broken files among them)."""
    return read_movements(spark, _lake(spark, d)[0])


def q_lake_counts(spark, d):
    return spark.createDataFrame([_lake(spark, d)[1]],
                                 "plan_rows long, change_rows long")


def _event(**attrs):
    """A full ``ar``/``dp`` struct; attributes not given are absent."""
    fields = ["_pt", "_pp", "_ct", "_cp", "_cs", "_dc", "_l", "_ppth"]
    return F.struct(*[(attrs[f] if f in attrs else
                       F.lit(None).cast("string")).alias(f) for f in fields])


SNAPSHOTS = ["2509010800", "2509010815", "2509010830", "2509010845"]


def _xml_star_inputs(spark, d):
    """Plan documents (one per order), change documents (one per order, a
    stop for each line item) in the snapshot folders of a nested week, and
    station JSON lines for most of the stations they name, all written by
    Spark from the driver tables; and broken files among the plans, one for
    each nation: malformed, empty, or with another root."""
    o = P.table(spark, d, "orders")
    li = P.table(spark, d, "lineitem")
    k = F.col("o_custkey") % 40
    plan = P.plan_raw(spark, d)
    stamp = "yyMMddHHmm"
    pdocs = plan.select(
        (F.col("stop_id").cast("long") % 4).alias("snap"),
        F.concat(F.lit("Stop "), F.substring("station_name", 2, 3))
        .alias("_station"),
        F.lit(None).cast("string").alias("_eva"),
        F.array(F.struct(
            F.col("stop_id").alias("_id"),
            F.struct(F.col("train_category").alias("_c"),
                     F.col("train_number").alias("_n"),
                     F.lit(None).cast("string").alias("_o"),
                     F.lit(None).cast("string").alias("_t"),
                     F.lit(None).cast("string").alias("_f")).alias("tl"),
            F.when(F.col("planned_arrival").isNotNull(), _event(
                _pt=F.date_format("planned_arrival", stamp),
                _pp=F.col("platform_arrival"))).alias("ar"),
            F.when(F.col("planned_departure").isNotNull(), _event(
                _pt=F.date_format("planned_departure", stamp),
                _pp=F.col("platform_departure"),
                _l=F.concat(F.lit("L"), F.substring("train_number", -1, 1)),
                _ppth=F.concat(F.col("station_name"), F.lit("|S0"))))
            .alias("dp"),
        )).alias("s"))
    # an order has few line items; their order is the documents' order
    lines = li.groupBy("l_orderkey").agg(F.sort_array(F.collect_list(F.struct(
        "l_linenumber", "l_shipdate", "l_returnflag", "l_quantity")))
        .alias("lines"))

    def stop(x):
        ct = F.date_format(F.timestamp_add(
            "MINUTE", x["l_linenumber"] * 7, x["l_shipdate"]), stamp)
        return F.struct(
            F.col("o_orderkey").cast("string").alias("_id"),
            F.lit(None).cast("struct<_c:string,_n:string,_o:string,"
                             "_t:string,_f:string>").alias("tl"),
            _event(_ct=ct, _cs=F.when(x["l_returnflag"] == "R", "c"))
            .alias("ar"),
            _event(_ct=ct, _dc=F.when(x["l_quantity"] > 25, x["l_linenumber"]
                                      .cast("string"))).alias("dp"))

    cdocs = lines.join(o, lines["l_orderkey"] == o["o_orderkey"]).select(
        (F.col("o_orderkey") % 4).alias("snap"),
        F.lit(None).cast("string").alias("_station"),
        (F.lit(8000000) + k).cast("string").alias("_eva"),
        F.transform("lines", stop).alias("s"))
    root = work_dir(spark, "xml-star")
    proot, croot = os.path.join(root, "plans"), os.path.join(root, "changes")
    for docs, base in ((pdocs, proot), (cut_lineage(cdocs, "docs"), croot)):
        for i, snapshot in enumerate(SNAPSHOTS):
            write_timetable_xml(
                docs.filter(F.col("snap") == i).drop("snap"),
                os.path.join(base, "250901_250908", snapshot))
    broken = ["<timetable station='x'><s id='1'", "",
              "<stations><s id='1'/></stations>"]
    for r in P.table(spark, d, "nation").select("n_nationkey").collect():
        i = r.n_nationkey
        write_file(spark, os.path.join(
            proot, "250901_250908", SNAPSHOTS[i % 4], f"broken-{i}.xml"),
            broken[i % 3])
    stations = o.select(k.alias("k")).distinct().filter("k % 13 != 12") \
        .select(F.to_json(F.struct(F.array(F.struct(
            F.concat(F.lit("Stop "), F.col("k").cast("string"))
            .alias("name"),
            F.array(F.struct((F.lit(8000000) + F.col("k")).cast("long")
                             .alias("number"),
                             F.lit(True).alias("isMain")))
            .alias("evaNumbers"))).alias("result"))).alias("value"))
    sj = os.path.join(root, "stations")
    stations.write.mode("overwrite").text(sj)
    return proot, croot, sj


def _star(spark, d):
    proot, croot, sj = _xml_star_inputs(spark, d)
    return build_star(spark, proot, croot, sj, multi_line_json=False)


def q_star_from_xml(spark, d):
    """Star load from XML documents and station JSON (S1-S8, D8-D12)."""
    t = _star(spark, d)
    return t.fact.join(t.dim_train, "train_key").select(
        *FACT_OUT, *TRAIN_PARTS)


def q_star_dim_train(spark, d):
    return _star(spark, d).dim_train.select(*TRAIN_PARTS)


def q_star_dim_time(spark, d):
    return _star(spark, d).dim_time


def q_star_load_stats(spark, d):
    """Counters of the whole load, broken files included; ``unaccounted``:
    listed files that are neither read nor rejected."""
    t = _star(spark, d)
    seen = t.bronze.select("file_path").unionByName(
        t.rejects.select("file_path")).agg(
        F.count_distinct("file_path").alias("seen"))
    return t.stats.crossJoin(F.broadcast(seen)).select(
        "snapshots", "event_rows", "skipped_station", "bad_xml",
        "no_document", (F.col("xml_files") - F.col("seen"))
        .alias("unaccounted"))


def q_star_written(spark, d):
    """The star schema's tables, written and read back: their rows, and the
    constraints they break."""
    base = work_dir(spark, "star-written")
    write_star(_star(spark, d), base)
    t = read_star(spark, base)
    broken = C.star_violations(t["dim_station"], t["dim_train"],
                               t["dim_time"], t["fact_train_movement"])
    parts = [df.agg(F.lit(name).alias("name"), F.count("*").alias("n"))
             for name, df in (t | {"violations": broken}).items()]
    return functools.reduce(DataFrame.unionByName, parts)


# ==================================================================== graph
def _paths(spark, d):
    return G.departure_paths(P.lineitem_paths(spark, d))


PATH_NAMES = ["Berlin Zoo", "Zoo", "Berlin Hauptbahnhof",
              "Berlin-Hbf (S-Bahn)", "Berlin Yorckstr.(S1)",
              "Berlin-Yorckstr.(S2) (S+U)", "Berlin Südkreuz (Bus)",
              "Berlin Wittenau (Wilhelmsruher Damm) (U)", "Bernau(b Berlin)",
              "Borgsdorf, Hohen Neuendorf", "Birkenwerder Hauptstraße (S)",
              "Buch (S), Berlin", "Karow Bahnhof, Berlin",
              "Pankow-Heinersdorf, Berlin", "Köpenick/Parrisiusstr., Berlin",
              "Blankenburg, Berlin", " Zoo", "Berlin-Zoo "]


def q_normalise_names(spark, d):
    """Each part's name in one of five path spellings, and one of the known
    names; the last two are padded and keep their alias from matching."""
    p = P.table(spark, d, "part")
    k = F.col("p_size") % 5
    name = F.when(k == 0, F.concat(F.lit("Berlin-"), "p_name")) \
        .when(k == 1, F.concat("p_name", F.lit(" (S)"))) \
        .when(k == 2, F.concat("p_name", F.lit("(U)"))) \
        .when(k == 3, F.concat("p_name", F.lit(" (S+U) "))) \
        .otherwise(F.concat(F.lit(" "), "p_name"))
    known = F.element_at(F.array(*map(F.lit, PATH_NAMES)), (
        F.col("p_partkey") % len(PATH_NAMES) + 1).cast("int"))
    both = p.select("p_partkey", F.explode(F.array(name, known))
                    .alias("name"))
    return both.withColumn("normalized", normalize_station("name"))


def q_unique_stations(spark, d):
    return G.unique_path_stations(_paths(spark, d))


def q_static_graph(spark, d):
    _, edges = G.static_graph(_paths(spark, d))
    return edges


def q_graph_nodes(spark, d):
    nodes, _ = G.static_graph(_paths(spark, d))
    return nodes


def _fuzzy_requests(spark, d):
    p = P.table(spark, d, "part")
    k = F.col("p_size") % 4
    text = F.when(k == 0, F.concat(F.lit("Stop "), F.col("p_size")
                                   .cast("string"))) \
        .when(k == 1, F.concat(F.lit("stop "), F.col("p_size")
                               .cast("string"))) \
        .when(k == 2, F.concat(F.lit("HUB "), (F.col("p_size") % 9)
                               .cast("string"))) \
        .otherwise(F.concat(F.lit("p "), F.col("p_size").cast("string")))
    return p.select(F.col("p_partkey").alias("request_id"),
                    text.alias("text"))


def q_resolve_fuzzy(spark, d):
    nodes, _ = G.static_graph(_paths(spark, d))
    return G.resolve_stations(nodes, _fuzzy_requests(spark, d),
                              nodes_materialized=True)


def q_shortest_hops(spark, d):
    nodes, edges = G.static_graph(_paths(spark, d))
    req = nodes.select(F.xxhash64("station").alias("request_id"),
                       F.lit(HOP_SOURCE).alias("source"),
                       F.col("station").alias("target"))
    r = G.shortest_hops(nodes, edges, req, inputs_materialized=True,
                        paths=False)
    return r.filter(F.col("status") == G.FOUND).select("target_station",
                                                       "hops")


def _part_stops(spark, d):
    """lineitem -> an order's distinct parts as the stops of a train, in line
    order; stations and edges grow with the tables."""
    return P.table(spark, d, "lineitem").groupBy(
        "l_orderkey", F.format_string("Part %07d", "l_partkey")
        .alias("station")).agg(F.min("l_linenumber").alias("line"))


def q_hop_routes(spark, d):
    """Routes for every customer between several hundred sources and many
    targets; some ends do not exist."""
    # an order has few lines
    paths = _part_stops(spark, d).groupBy("l_orderkey").agg(F.array_join(
        F.transform(F.sort_array(F.collect_list(F.struct("line", "station"))),
                    lambda x: x["station"]), "|").alias("planned_path"))
    nodes, edges = G.static_graph(paths.select("planned_path").distinct())
    c = F.col("c_custkey")
    req = P.table(spark, d, "customer").select(
        c.alias("request_id"),
        F.when(c % 97 == 0, F.lit("Nowhere")).otherwise(
            F.format_string("part %07d", c * 7 % 300 + 1)).alias("source"),
        F.when(c % 89 == 0, F.lit("%")).otherwise(
            F.format_string("Part %07d", c * 131 % 2500 + 1))
        .alias("target"))
    return G.shortest_hops(nodes, edges, req, inputs_materialized=True) \
        .drop("path")


def q_earliest_routes(spark, d):
    """Earliest arrival for every customer, from many sources at many times;
    an order is a train that stops at its parts."""
    stop = _part_stops(spark, d)
    ready = F.timestamp_add("MINUTE", (F.col("l_orderkey") * 37 % 720)
                            + F.col("line") * 15,
                            F.lit("2025-09-01").cast("timestamp_ntz"))
    events = stop.select(
        F.col("l_orderkey").alias("train_key"), "station",
        F.explode(F.array(
            F.struct(F.lit("A").alias("event_type"), ready.alias("ts")),
            F.struct(F.lit("D").alias("event_type"),
                     F.timestamp_add("MINUTE", F.lit(5), ready)
                     .alias("ts")))).alias("e"),
        F.col("line").cast("string").alias("stop_id")).select(
        "train_key", "station", "e.*", "stop_id",
        F.to_date("e.ts").alias("date"))
    c = F.col("c_custkey")
    req = P.table(spark, d, "customer").select(
        c.alias("request_id"),
        F.when(c % 97 == 0, F.lit("Nowhere")).otherwise(
            F.format_string("Part %07d", c * 7 % 60 + 1)).alias("source"),
        F.format_string("Part %07d", c * 131 % 2500 + 1).alias("target"),
        F.timestamp_add("HOUR", c % 4 * 3, F.lit("2025-09-01")
                        .cast("timestamp_ntz")).alias("departure"))
    return G.earliest_arrival(G.connections(events), req, itinerary=False)


def q_connections(spark, d):
    return G.connections(P.event_timetable(spark, d))


def _arrival_requests(conns):
    st = conns.select(F.col("to_station").alias("s")).unionByName(
        conns.select(F.col("from_station").alias("s"))).distinct()
    return st.select(F.xxhash64("s").alias("request_id"),
                     F.lit("S0").alias("source"), F.col("s").alias("target"),
                     F.lit(DEPARTURE).cast("timestamp_ntz")
                     .alias("departure"))


def _timetable(spark, d):
    # the timetable feeds both the request batch and the search rounds
    return cut_lineage(G.connections(P.event_timetable(spark, d)),
                       "timetable")


def q_earliest_arrival(spark, d):
    conns = _timetable(spark, d)
    r = G.earliest_arrival(conns, _arrival_requests(conns), itinerary=False)
    return r.filter(F.col("status") == G.FOUND).select("target_station",
                                                       "arrival")


def q_itinerary(spark, d):
    conns = _timetable(spark, d)
    r = G.earliest_arrival(conns, _arrival_requests(conns))
    return G.itinerary_summary(r.filter(F.col("status") == G.FOUND)).select(
        "target_station", "arrival", "duration_minutes", "segments",
        "stations", "itinerary")


# ================================================================ registry
def entry(spark: SparkSession) -> DataFrame:
    """Flagship: lake pipeline (plan x latest change, clamped delays) into
    the peak-hour departure analysis, on the smallest driver tables."""
    _prep(spark)
    return q33_peak_hours(spark, SMOKE_DIR)


_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "latest_update": q_latest_update,
    "merge_left_delay": q_merge_left_delay,
    "partitioned_write": q_partitioned_write,
    "q32_daily_mean": q32_daily_mean,
    "q33_peak_hours": q33_peak_hours,
    "fact_upsert": q_fact_upsert,
    "incremental_load": q_incremental_load,
    "load_constraints": q_load_constraints,
    "star_from_xml": q_star_from_xml,
    "star_dim_train": q_star_dim_train,
    "star_dim_time": q_star_dim_time,
    "star_load_stats": q_star_load_stats,
    "star_written": q_star_written,
    "lake_from_xml": q_lake_from_xml,
    "lake_counts": q_lake_counts,
    "change_roundtrip": q_change_roundtrip,
    "raw_tables": q_raw_tables,
    "q21_station_lookup": q21_station_lookup,
    "q21_lookup_single": q21_lookup_single,
    "q21_wildcards": q21_wildcards,
    "q22_uneven": q22_uneven,
    "q23_one_snapshot": q23_one_snapshot,
    "q32_absent_station": q32_absent_station,
    "q33_top": q33_top,
    "q22_nearest": q22_nearest,
    "q23_cancelled_distinct": q23_cancelled_distinct,
    "q24_avg_delay": q24_avg_delay,
    "dim_time": q_dim_time,
    "dim_train": q_dim_train,
    "unknown_member": q_unknown_member,
    "dim_station_last_wins": q_dim_station_last_wins,
    "station_alias": q_station_alias,
    "json_explode": q_json_explode,
    "station_resolve": q_station_resolve,
    "load_stats": q_load_stats,
    "event_unpivot": q_event_unpivot,
    "check_unique": q_check_unique,
    "check_fk": q_check_fk,
    "check_fk_missing": q_check_fk_missing,
    "check_domain": q_check_domain,
    "parse_stamp": q_parse_stamp,
    "signed_delay": q_signed_delay,
    "clamped_delay": q_clamped_delay,
    "xml_roundtrip": q_xml_roundtrip,
    "normalise_names": q_normalise_names,
    "unique_stations": q_unique_stations,
    "static_graph": q_static_graph,
    "graph_nodes": q_graph_nodes,
    "resolve_fuzzy": q_resolve_fuzzy,
    "shortest_hops": q_shortest_hops,
    "hop_routes": q_hop_routes,
    "earliest_routes": q_earliest_routes,
    "connections": q_connections,
    "connections_star": q_connections_star,
    "connections_day": q_connections_day,
    "earliest_arrival": q_earliest_arrival,
    "itinerary": q_itinerary,
}


def _wrap(fn):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        _prep(spark)
        return fn(spark, sf_dir)
    run.__name__ = fn.__name__
    run.__doc__ = fn.__doc__
    return run


def _llm() -> tuple[dict, dict]:
    """Queries and SQL of the training-data operators, if they are there."""
    try:
        from trainyard.llm.queries import ORACLE_SQL, QUERIES
    except ImportError:
        return {}, {}
    return QUERIES, ORACLE_SQL


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {k: _wrap(v) for k, v in (_QUERIES | _llm()[0]).items()}


def oracle_sql() -> dict[str, str]:
    from trainyard.plans.oracles import ORACLE
    return ORACLE | _llm()[1]
