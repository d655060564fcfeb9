"""Star load and lake pipeline on small hand-written XML/JSON fixtures."""

import datetime as dt
import json
import os

import pytest

from conftest import write

from trainyard.operators.analysis import (daily_mean_delay,
                                          peak_hour_departures)
from trainyard.plans.lake import run_lake_pipeline
from trainyard.plans.star import (build_star, read_quarantine, read_star,
                                  write_star)
from trainyard.sources.tables import read_movements

STATIONS = {"result": [
    {"name": "Berlin Hbf", "evaNumbers": [
        {"number": 8011160, "isMain": True,
         "geographicCoordinates": {"coordinates": [13.369, 52.525]}}]},
    {"name": "Berlin Alexanderplatz", "evaNumbers": [
        {"number": 8011155, "isMain": False},
        {"number": 8089001, "isMain": True,
         "geographicCoordinates": {"coordinates": [13.41, 52.52]}}]},
    {"name": "No Eva", "evaNumbers": []},
    {"name": "Berlin Ostkreuz", "evaNumbers": [{"number": 8011162}]},
    {"name": "Ostkreuz", "evaNumbers": [{"number": 8099999}]},
]}

HBF_1200 = """<?xml version='1.0' encoding='UTF-8'?>
<timetable>
 <s id="1"><tl c="ICE" n="5" o="80" t="p" f="F"/>
  <ar pt="2509021210" pp="1" ppth="A|B"/>
  <dp pt="2509021215" pp="1" l="X" ppth="C|D"/></s>
 <s id="2"><dp pt="2513021201"/></s>
 <s id="3"><ar pt="2509021300"/></s>
</timetable>"""
ALEX_1200 = """<timetable station="Berlin Alexanderplatz">
 <s id="9"><tl c="RE" n="7"/><dp pt="2509021230" pp="2"/></s></timetable>"""
OST_1200 = """<timetable station="Berlin Ostkreuz">
 <s id="7"><dp pt="2509021240"/></s></timetable>"""
HBF_1215 = """<timetable>
 <s id="1"><tl c="ICE" n="5" o="80" t="p" f="F"/>
  <dp pt="2509021215"/></s></timetable>"""

CH_A = """<timetable eva="8011160" station="Berlin Hbf">
 <s id="1"><ar ct="2509021212" cs="c"/>
  <dp pt="2509021205" ct="2509021220"/></s></timetable>"""
CH_B = """<timetable eva="8011160"><s id="1"><ar cp="5"/></s></timetable>"""
CH_C = """<timetable eva="99999"><s id="1"><ar cs="c"/></s></timetable>"""
CH_UNK = """<timetable eva="8089001">
 <s id="9"><dp ct="2509021235" dc="4"/></s></timetable>"""
CH_LATER = """<timetable eva="8011160"><s id="1"><ar cp="6"/></s></timetable>"""


@pytest.fixture()
def inputs(tmp):
    p = os.path.join(tmp, "plans", "250902_250909")
    c = os.path.join(tmp, "changes", "wrap")
    write(p, "2509021200/Berlin_Hbf_timetable.xml", HBF_1200)
    write(p, "2509021200/alex.xml", ALEX_1200)
    write(p, "2509021200/ost.xml", OST_1200)
    write(p, "2509021200/bad.xml", "<timetable station='x'><s id='1'")
    write(p, "2509021200/nowhere.xml", "<timetable station='Nowhere'/>")
    write(p, "2509021215/Berlin_Hbf_timetable.xml", HBF_1215)
    write(c, "2509021200/a.xml", CH_A)
    write(c, "2509021200/b.xml", CH_B)
    write(c, "2509021200/c.xml", CH_C)
    write(c, "2509021200/unk.xml", CH_UNK)
    write(c, "2509021215/a.xml", CH_LATER)
    sj = write(tmp, "stations.json", json.dumps(STATIONS))
    return p, c, sj


def facts(tables):
    rows = tables.fact.join(tables.dim_train, "train_key").collect()
    return {(r.snapshot_time_key, r.station_key, r.stop_id, r.event_type): r
            for r in rows}


def test_star_load(spark, inputs, tmp):
    p, c, sj = inputs
    t = build_star(spark, p, c, sj)
    f = facts(t)
    assert len(f) == 8
    a = f[(202509021200, 8011160, "1", "A")]
    assert a.is_cancelled and a.event_status == "c"      # sticky cancel
    assert a.changed_time_key == 202509021212
    assert a.planned_time_key == 202509021210 and a.planned_path == "A|B"
    assert a.changed_platform == "5"                      # later change
    assert (a.category, a.train_number) == ("ICE", "5")
    d = f[(202509021200, 8011160, "1", "D")]
    assert d.planned_time_key == 202509021215             # plan wins
    assert d.delay_minutes == 15                          # change's own pt
    assert d.line == "X" and not d.is_cancelled
    assert f[(202509021200, 8011160, "2", "D")].planned_time_key is None
    alex = f[(202509021200, 8089001, "9", "D")]           # main EVA chosen
    assert (alex.category, alex.train_number) == ("RE", "7")  # UNK kept out
    assert alex.delay_minutes == 4
    ost = f[(202509021200, 8099999, "7", "D")]            # alias overwrite
    assert ost.planned_time_key == 202509021240
    later_a = f[(202509021215, 8011160, "1", "A")]        # new snapshot row
    assert not later_a.is_cancelled and later_a.category == "UNK"
    assert f[(202509021215, 8011160, "1", "D")].planned_time_key == \
        202509021215
    st = {r.eva: r for r in t.dim_station.collect()}
    assert (st[8089001].lat, st[8089001].lon) == (52.52, 13.41)
    assert st[8011162].lat is None and len(st) == 4
    reasons = sorted(r.reason for r in t.rejects.collect())
    assert reasons == ["bad planned time", "malformed xml",
                       "unknown station", "unknown station"]
    s = t.stats.first()
    assert (s.snapshots, s.skipped_station, s.bad_xml) == (2, 2, 1)
    tm = {r.time_key: r for r in t.dim_time.collect()}
    assert 202509021200 in tm and 202509021235 in tm
    assert tm[202509021200].dow == 2


def test_star_keeps_every_train_and_snapshot(spark, inputs, tmp):
    p, c, sj = inputs
    write(p, "2509021230/nowhere.xml", "<timetable station='Nowhere'/>")
    write(p, "2509021245/Berlin_Hbf_timetable.xml", """<timetable>
     <s id="20"><tl c="S" n="1"/><dp pt="2509021250"/></s>
     <s id="20"><tl c="S" n="2"/><dp pt="2509021250"/></s></timetable>""")
    write(c, "2509021245/a.xml", """<timetable eva="8011160">
     <s id="21"><tl c="ICE" n="77"/></s>
     <s id="20"><tl c="RE" n="9"/><dp cp="3"/></s></timetable>""")
    out = os.path.join(tmp, "star")
    t = build_star(spark, p, c, sj)
    write_star(t, out)
    for dim in (t.dim_train, read_star(spark, out)["dim_train"]):
        got = {(r.category, r.train_number) for r in dim.collect()}
        # replaced in the fold, and a stop without any event
        assert {("S", "1"), ("S", "2"), ("RE", "9"), ("ICE", "77"),
                ("UNK", "UNK")} <= got
        assert dim.count() == dim.select("train_key").distinct().count()
    for dim in (t.dim_time, read_star(spark, out)["dim_time"]):
        # its only file was skipped
        assert dim.where("time_key = 202509021230").count() == 1


def test_trains_whose_key_is_taken(spark):
    """A stored train keeps its key, then the unknown one, then the first."""
    from trainyard.operators.dims import new_trains, taken_keys
    cols = "train_key long, category string, train_number string, " \
        "owner string, trip_type string, filter_flags string"
    old = spark.createDataFrame([(1, "S", "1", "", "", "")], cols)
    new = spark.createDataFrame([
        (1, "S", "2", "", "", ""), (1, "S", "1", "", "", ""),
        (2, "RE", "8", "", "", ""), (2, "RE", "7", "", "", ""),
        (3, "A", "A", "", "", ""), (3, "UNK", "UNK", "", "", "")], cols)
    members = new_trains(old, new)
    assert members.count() == 5
    assert sorted(r.train_number for r in taken_keys(old, members)
                  .collect()) == ["2", "8", "A"]


def tables_of(spark, out):
    t = read_star(spark, out)
    fact = t["fact_train_movement"]
    return (sorted(map(str, fact.select(*sorted(fact.columns)).collect())),
            sorted(map(str, t["dim_time"].collect())),
            sorted(map(str, t["dim_train"].collect())))


@pytest.mark.parametrize("order", ["cp", "pcpc"])
def test_batches_in_any_order(spark, inputs, tmp, order):
    """Plans, changes and replays of either, in any order: one result."""
    p, c, sj = inputs
    whole = os.path.join(tmp, "whole")
    write_star(build_star(spark, p, c, sj), whole)
    out = os.path.join(tmp, order)
    for i, kind in enumerate(order):
        t = build_star(spark, p if kind == "p" else None,
                       c if kind == "c" else None, sj)
        write_star(t, out, incremental=i > 0)
    assert tables_of(spark, out) == tables_of(spark, whole)


def test_a_file_sent_again_replaces_its_rows(spark, inputs, tmp):
    p, c, sj = inputs
    out = os.path.join(tmp, "star")
    write_star(build_star(spark, p, c, sj), out)
    write(c, "2509021200/b.xml", CH_B.replace('cp="5"', 'cp="9" cs="x"'))
    write(p, "2509021215/Berlin_Hbf_timetable.xml", "<timetable/>")
    write(c, "2509021215/a.xml", "<timetable eva='8011160'/>")
    write_star(build_star(spark, p, c, sj), out, incremental=True)
    rows = {(r.stop_id, r.event_type): r for r in spark.read.parquet(
        os.path.join(out, "fact_train_movement")).collect()
        if r.station_key == 8011160}
    assert rows["1", "A"].changed_platform is None      # quarantined now
    assert rows["1", "A"].event_status == "c"
    # the later snapshot has no rows left
    assert {r.snapshot_time_key for r in rows.values()} == {202509021200}
    bad = read_quarantine(spark, out).collect()
    assert [(r.rule, r.event_status) for r in bad] == [("event_status", "x")]
    write(c, "2509021200/b.xml", CH_B)
    write_star(build_star(spark, None, c, sj), out, incremental=True)
    assert read_quarantine(spark, out).count() == 0


def test_ledger_and_sole_writer(spark, inputs, tmp):
    from trainyard.sources.tables import sole_writer
    p, c, sj = inputs
    out = os.path.join(tmp, "star")
    t = build_star(spark, p, None, sj)
    write_star(t, out, batch="a")
    for _ in range(2):      # the second time it is in the ledger
        write_star(t, out, incremental=True, batch="b")
    ledger = spark.read.parquet(os.path.join(out, "batches")).collect()
    assert sorted(r.batch for r in ledger) == ["a", "b"]
    with sole_writer(spark, out):
        with pytest.raises(RuntimeError, match="has a writer already"):
            write_star(t, out, incremental=True)
    write_star(t, out, incremental=True, batch="c")


def test_every_file_is_counted(spark, inputs, tmp):
    """Good, malformed, empty, foreign and unknown files are all files."""
    p, c, sj = inputs
    write(p, "2509021200/empty.xml", "")
    write(p, "2509021215/foreign.XML", "<stations><s id='1'/></stations>")
    write(c, "2509021230/blank.xml", "  \n")
    write(p, "notes/other.xml", "<timetable/>")     # not in a snapshot
    t = build_star(spark, p, c, sj)
    s = t.stats.first()
    assert (s.snapshots, s.xml_files) == (3, 14)
    assert (s.skipped_station, s.bad_xml, s.no_document) == (2, 1, 3)
    reasons = {}
    for r in t.rejects.collect():
        reasons.setdefault(r.reason, []).append(os.path.basename(r.file_path))
    assert sorted(reasons["no timetable"]) == ["blank.xml", "empty.xml",
                                               "foreign.XML"]
    good = t.rows.select("folder", "file").distinct().count()
    assert good + 2 + 1 + 3 == 14
    assert t.dim_time.filter("time_key = 202509021230").count() == 1


def test_each_tree_is_parsed_once(spark, inputs, monkeypatch):
    """One XML scan a tree; all tables read the stops written by it."""
    from trainyard.plans import star
    plans, real = [], star.cut_lineage

    def counted(df, name="round"):
        plans.append((name, df._jdf.queryExecution().toString()))
        return real(df, name)

    monkeypatch.setattr(star, "cut_lineage", counted)
    p, c, sj = inputs
    t = build_star(spark, p, c, sj)

    def scans(text):
        return text.split("== Physical Plan ==")[1].count("FileScan xml")

    assert [n for n, text in plans if scans(text)] == ["bronze", "bronze"]
    assert all(scans(text) <= 1 for _, text in plans)
    for df in (t.dim_station, t.dim_train, t.dim_time, t.fact, t.rejects,
               t.stats, t.rows, t.trains, t.files):
        text = df._jdf.queryExecution().toString()
        assert scans(text) == 0 and "FileScan json" not in text


def test_star_write_incremental_idempotent(spark, inputs, tmp):
    p, c, sj = inputs
    out = os.path.join(tmp, "star")
    write_star(build_star(spark, p, None, sj), out)
    write_star(build_star(spark, None, c, sj), out, incremental=True)
    once = read_star(spark, out)["fact_train_movement"]
    full = build_star(spark, p, c, sj).fact
    cols = [c_ for c_ in full.columns if c_ != "movement_key"]
    assert sorted(once.select(*cols).collect()) == \
        sorted(full.select(*cols).collect())
    write_star(build_star(spark, None, c, sj), out, incremental=True)
    again = read_star(spark, out)["fact_train_movement"]
    assert sorted(again.select(*cols).collect()) == \
        sorted(full.select(*cols).collect())


def test_lake_pipeline(spark, inputs, tmp):
    p, c, _ = inputs
    out = os.path.join(tmp, "movements")
    counts = run_lake_pipeline(spark, p, c, out)
    assert counts["plan_rows"] == 6
    mv = read_movements(spark, out)
    allrows = mv.collect()
    rows = {(r.stop_id, r.planned_departure): r for r in allrows}
    # stop 1 appears in two plan snapshots; both rows survive the join
    assert len([r for r in allrows if r.stop_id == "1"]) == 2
    r1 = rows[("1", dt.datetime(2025, 9, 2, 12, 15))]
    assert not r1.is_cancelled            # latest change has no cancel
    assert r1.arrival_delay_minutes == 0.0
    r9 = rows[("9", dt.datetime(2025, 9, 2, 12, 30))]
    assert r9.departure_delay_minutes == 5.0 and r9.hour == 12
    assert str(r9.date) == "2025-09-02"
    d = daily_mean_delay(mv, "Berlin Alexanderplatz").collect()
    assert d[0].final_avg == 0.0
    ph = peak_hour_departures(mv, [12]).collect()
    assert {r.station_name for r in ph} >= {"Berlin Alexanderplatz"}


def test_mean_of_daily_means(spark):
    mv = spark.createDataFrame(
        [("S", dt.date(2025, 9, 1), 0.0, False),
         ("S", dt.date(2025, 9, 1), 10.0, False),
         ("S", dt.date(2025, 9, 2), 20.0, False),
         ("S", dt.date(2025, 9, 2), 99.0, True)],
        "station_name string, date date, arrival_delay_minutes double, "
        "is_cancelled boolean")
    assert daily_mean_delay(mv, "S").first().final_avg == 12.5
    assert daily_mean_delay(mv, "T").count() == 0


def test_peak_hours_day_gap(spark):
    ts = dt.datetime(2025, 9, 1, 7)
    mv = spark.createDataFrame(
        [("S", ts, dt.date(2025, 9, 1), 7), ("S", ts, dt.date(2025, 9, 1), 8),
         ("S", ts, dt.date(2025, 9, 3), 17),
         ("S", ts, dt.date(2025, 9, 2), 12)],
        "station_name string, planned_departure timestamp_ntz, date date, "
        "hour int")
    r = peak_hour_departures(mv).first()
    assert (r.avg_peak_departures, r.days_observed) == (1.5, 2)


def test_integrity_checks(spark, inputs):
    from trainyard.operators.checks import star_violations
    p, c, sj = inputs
    t = build_star(spark, p, c, sj)
    v = star_violations(t.dim_station, t.dim_train, t.dim_time, t.fact)
    assert v.count() == 0
    # a duplicated fact row and a dangling train key are reported
    bad = t.fact.unionByName(t.fact.limit(1)).unionByName(
        t.fact.limit(1).withColumn("train_key", t.fact["train_key"] + 1)
        .withColumn("stop_id", t.fact["stop_id"].substr(1, 0)))
    rules = {(r.table, r.rule): r.n for r in star_violations(
        t.dim_station, t.dim_train, t.dim_time, bad).collect()}
    assert rules[("fact", "natural key")] >= 1
    assert rules[("fact", "fk train")] == 1


def test_report_limits(spark):
    ts = dt.datetime(2025, 9, 1, 7)
    mv = spark.createDataFrame(
        [(f"S{i}", ts, dt.date(2025, 9, 1), 7) for i in range(5)],
        "station_name string, planned_departure timestamp_ntz, date date, "
        "hour int")
    assert peak_hour_departures(mv, top=3).count() == 3


def test_empty_event_element_still_counts(spark, tmp):
    from trainyard.operators.fact import unpivot_events
    from trainyard.sources.xml import read_timetable_docs
    write(tmp, "w/2509021200/a.xml",
          '<timetable station="X"><s id="1"><ar/><dp pt="2509021200"/></s>'
          '<s id="2"><dp></dp></s><s id="3"/></timetable>')
    d = read_timetable_docs(spark, os.path.join(tmp, "w"))
    ev = unpivot_events(d.selectExpr("explode(s) AS stop")).select(
        "stop._id", "event_type").collect()
    assert sorted(tuple(r) for r in ev) == [("1", "A"), ("1", "D"),
                                            ("2", "D")]


def test_daily_report_and_run_analyses(spark, inputs, tmp):
    from trainyard.operators.analysis import daily_delay_table
    from trainyard.plans.lake import run_analyses
    mv = spark.createDataFrame(
        [("S", dt.date(2025, 9, d), float(d), False) for d in range(1, 8)],
        "station_name string, date date, arrival_delay_minutes double, "
        "is_cancelled boolean")
    rows = daily_delay_table(mv, "S", top=3).collect()
    assert [r.date.day for r in rows] == [1, 2, 3]
    p, c, _ = inputs
    out = os.path.join(tmp, "mv2")
    run_lake_pipeline(spark, p, c, out)
    daily, peak = run_analyses(spark, out, "Berlin Alexanderplatz", [12])
    assert daily.first().final_avg == 0.0
    assert peak.count() >= 1


def test_xml_files_are_bounded(spark, tmp, monkeypatch):
    """One file is read by one task."""
    from trainyard.sources import xml
    monkeypatch.setattr(xml, "FILE_DOCS", 5)
    docs = spark.range(23).coalesce(1).selectExpr(
        "concat('X', id) AS _station", "cast(null AS string) AS _eva",
        "array(named_struct('_id', cast(id AS string))) AS s")
    xml.write_timetable_xml(docs, os.path.join(tmp, "2509010800"))
    assert xml.list_timetable_files(spark, tmp).count() == 5
    assert xml.read_timetable_docs(spark, tmp).count() == 23


def test_the_fold_shuffles_and_sorts_rows_once(spark, inputs):
    """No row is shuffled for its rank, and the order is sorted with the key;
    the folders' order is that of their components."""
    from trainyard.operators.fact import (LOG_COLUMNS, upsert_fact,
                                          with_file_rank)
    p, c, sj = inputs
    row = build_star(spark, p, c, sj).rows.filter(
        "stop_id = '1' AND phase = 1 AND changed_platform = '5'").first()
    rows = spark.createDataFrame(
        [row.asDict() | {"folder": folder, "file": file,
                         "changed_platform": platform}
         for folder, file, platform in (
             ("w-/1", "b", "1"), ("w/1", "z", "2"), ("w-/1", "a", "3"),
             ("w-/1", None, "4"))],
        build_star(spark, p, c, sj).rows.schema).select(*LOG_COLUMNS)
    fact = upsert_fact(with_file_rank(rows))
    assert [r.changed_platform for r in fact.collect()] == ["1"]
    plan = fact._jdf.queryExecution().sparkPlan().toString()
    assert "Join" not in plan and "Window" not in plan
    plan = fact._jdf.queryExecution().executedPlan().initialPlan().toString()
    assert plan.count("Exchange ") == 1 and plan.count("Sort [") == 1


def test_a_load_leaves_no_copies(spark, inputs, tmp):
    """Rows of a batch are written where they will lie and moved there; no
    copy and no shuffle file outlives the load."""
    import glob
    from trainyard.session import DROP_SHUFFLES, ensure_checkpoint_dir
    p, c, sj = inputs
    out = os.path.join(tmp, "star")

    def shuffles():
        local = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get() \
            .blockManager().diskBlockManager().localDirsString()
        return {f for d in local for f in glob.glob(
            os.path.join(d, "*", "shuffle_*"))}

    for i in range(2):
        t = build_star(spark, p, c, sj)
        folder = ensure_checkpoint_dir(spark).removeprefix("file:")
        before = set(glob.glob(os.path.join(folder, "trainyard", "*")))
        seen = shuffles()
        write_star(t, out, incremental=i > 0)
        new = {os.path.basename(f).rsplit("-", 1)[0] for f in
               set(glob.glob(os.path.join(folder, "trainyard", "*"))) - before}
        assert new <= {"dim_station", "dim_time"}
        # the dimensions' own, which are small
        assert len(shuffles() - seen) < 60
        assert not os.path.exists(os.path.join(out, "_staged"))
    assert spark.conf.get(DROP_SHUFFLES, None) in (None, "false")
