"""Command line: ``python -m trainyard <command> ...``.

Commands mirror the jobs users run: load the star schema, run the lake
pipeline, the analyses, the station questions and the two routings.  Each
prints its result table; all work runs as Spark jobs.
"""

from __future__ import annotations

import argparse
import os
import sys

from pyspark.sql import functions as F


def _session(args):
    from trainyard.session import get_session
    return get_session(args.master, app=f"trainyard-{args.cmd}")


def _show(df):
    """Print the whole result, one partition at a time."""
    print("\t".join(df.columns))
    for row in df.toLocalIterator():
        print("\t".join("" if v is None else str(v) for v in row))


def cmd_star_load(args):
    from trainyard.plans.star import build_star, write_star
    spark = _session(args)
    t = build_star(spark, args.plans, args.changes, args.stations,
                   multi_line_json=not args.json_lines)
    write_star(t, args.out, incremental=args.incremental)
    _show(t.stats)


def cmd_lake(args):
    from trainyard.plans.lake import run_lake_pipeline
    spark = _session(args)
    counts = run_lake_pipeline(spark, args.plans, args.changes, args.out,
                               args.raw_plan, args.raw_changes,
                               args.incremental)
    print(counts)


def cmd_analyze(args):
    from trainyard.operators.analysis import (daily_delay_table,
                                              daily_mean_delay,
                                              peak_hour_departures)
    from trainyard.sources.tables import read_movements
    spark = _session(args)
    mv = read_movements(spark, args.movements)
    _show(daily_delay_table(mv, args.station, top=50))
    _show(daily_mean_delay(mv, args.station))
    _show(peak_hour_departures(mv, args.hours, top=200))


def _star(spark, d):
    from trainyard.plans.star import read_star
    return read_star(spark, d)


def cmd_lookup(args):
    from trainyard.operators.analysis import station_lookup
    spark = _session(args)
    _show(station_lookup(_star(spark, args.star)["dim_station"], args.text))


def cmd_nearest(args):
    from trainyard.operators.nearest import nearest_station
    spark = _session(args)
    pts = spark.createDataFrame([(1, args.lat, args.lon)],
                                "request_id long, lat double, lon double")
    _show(nearest_station(_star(spark, args.star)["dim_station"], pts))


def cmd_cancelled(args):
    from trainyard.operators.analysis import cancelled_trains
    spark = _session(args)
    _show(cancelled_trains(_star(spark, args.star)["fact_train_movement"],
                           args.snapshot))


def cmd_avg_delay(args):
    from trainyard.operators.analysis import avg_departure_delay
    spark = _session(args)
    s = _star(spark, args.star)
    _show(avg_departure_delay(s["fact_train_movement"], s["dim_station"],
                              args.text))


def cmd_stations(args):
    """The stations of the planned paths, or (--graph) the size of the
    network they make."""
    from trainyard.operators.graph import (departure_paths, static_graph,
                                           unique_path_stations)
    spark = _session(args)
    paths = departure_paths(_star(spark, args.star)["fact_train_movement"])
    if not args.graph:
        return _show(unique_path_stations(paths))
    nodes, edges = static_graph(paths)
    _show(nodes.agg(F.count("*").alias("stations")).crossJoin(
        edges.agg(F.count("*").alias("connections"))))


def cmd_hops(args):
    from trainyard.operators.graph import (departure_paths, shortest_hops,
                                           static_graph)
    spark = _session(args)
    fact = _star(spark, args.star)["fact_train_movement"]
    nodes, edges = static_graph(departure_paths(fact))
    req = spark.createDataFrame(
        [(i, s, t) for i, (s, t) in enumerate(_pairs(args.route))],
        "request_id long, source string, target string")
    _show(shortest_hops(nodes, edges, req, inputs_materialized=True)
          .orderBy("request_id"))


def cmd_earliest(args):
    from trainyard.operators.graph import (connections, earliest_arrival,
                                           itinerary_summary,
                                           timetable_events)
    spark = _session(args)
    s = _star(spark, args.star)
    ev = timetable_events(s["fact_train_movement"], s["dim_station"],
                          s["dim_time"], args.date)
    req = spark.createDataFrame(
        [(i, a, b, args.departure) for i, (a, b) in
         enumerate(_pairs(args.route))],
        "request_id long, source string, target string, departure string")
    req = req.withColumn("departure", F.to_timestamp_ntz("departure"))
    _show(itinerary_summary(earliest_arrival(connections(ev), req))
          .orderBy("request_id"))


def _pairs(items):
    out = []
    for r in items:
        a, _, b = r.partition(":")
        out.append((a, b))
    return out


def main(argv=None):
    ap = argparse.ArgumentParser(prog="trainyard")
    ap.add_argument("--master", default=os.environ.get("SPARK_MASTER"))
    sub = ap.add_subparsers(dest="cmd", required=True)
    p = sub.add_parser("star-load")
    p.add_argument("--plans"), p.add_argument("--changes")
    p.add_argument("--stations", required=True)
    p.add_argument("--out", required=True)
    p.add_argument("--incremental", action="store_true")
    p.add_argument("--json-lines", action="store_true")
    p.set_defaults(fn=cmd_star_load)
    p = sub.add_parser("lake")
    p.add_argument("--plans", required=True)
    p.add_argument("--changes", required=True)
    p.add_argument("--out", required=True)
    p.add_argument("--raw-plan"), p.add_argument("--raw-changes")
    p.add_argument("--incremental", action="store_true")
    p.set_defaults(fn=cmd_lake)
    p = sub.add_parser("analyze")
    p.add_argument("--movements", required=True)
    p.add_argument("--station", default="Berlin Hbf")
    p.add_argument("--hours", type=int, nargs="+", default=[7, 8, 17, 18])
    p.set_defaults(fn=cmd_analyze)
    for name, fn, extra in [
            ("lookup", cmd_lookup, [("--text", str, True)]),
            ("nearest", cmd_nearest, [("--lat", float, True),
                                      ("--lon", float, True)]),
            ("cancelled", cmd_cancelled, [("--snapshot", str, True)]),
            ("avg-delay", cmd_avg_delay, [("--text", str, True)])]:
        p = sub.add_parser(name)
        p.add_argument("--star", required=True)
        for flag, typ, req in extra:
            p.add_argument(flag, type=typ, required=req)
        p.set_defaults(fn=fn)
    p = sub.add_parser("stations")
    p.add_argument("--star", required=True)
    p.add_argument("--graph", action="store_true")
    p.set_defaults(fn=cmd_stations)
    p = sub.add_parser("hops")
    p.add_argument("--star", required=True)
    p.add_argument("route", nargs="+", help="SOURCE:TARGET")
    p.set_defaults(fn=cmd_hops)
    p = sub.add_parser("earliest")
    p.add_argument("--star", required=True)
    p.add_argument("--date")
    p.add_argument("--departure", required=True)
    p.add_argument("route", nargs="+", help="SOURCE:TARGET")
    p.set_defaults(fn=cmd_earliest)
    args = ap.parse_args(argv)
    args.fn(args)


if __name__ == "__main__":
    sys.exit(main())
