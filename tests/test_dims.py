"""Dimension builders, later-load merges and the station JSON reader."""

import json
import os

from conftest import write

from trainyard.operators.dims import (build_dim_station, build_dim_time,
                                      build_dim_train, build_station_aliases,
                                      changed_stations, merge_dim_station,
                                      new_times, new_trains, train_parts)
from trainyard.sources.stations import read_station_entries

ENTRIES = [
    {"name": "Berlin Hbf", "evaNumbers": [{"number": 1, "isMain": True}]},
    {"name": "Hbf Neu", "evaNumbers": [{"number": 1}]},        # same EVA
    {"name": "Berlin_Zoo", "evaNumbers": [{"number": 2}]},
    {"name": "Zoo", "evaNumbers": [{"number": 3}]},            # alias clash
]


def test_json_forms_same_entries(spark, tmp):
    doc = write(tmp, "one.json", json.dumps({"result": ENTRIES}))
    lines = write(tmp, "lines/part.json", "\n".join(
        json.dumps({"result": [e]}) for e in ENTRIES))
    a = read_station_entries(spark, doc)
    b = read_station_entries(spark, os.path.dirname(lines), multi_line=False)
    key = ["name"]
    assert sorted(r.name for r in a.select(*key).collect()) == \
        sorted(r.name for r in b.select(*key).collect())
    for entries in (a, b):
        st = {r.eva: r.station_name
              for r in build_dim_station(entries).collect()}
        assert st == {1: "Hbf Neu", 2: "Berlin_Zoo", 3: "Zoo"}  # last wins
        al = {r.alias: r.eva
              for r in build_station_aliases(entries).collect()}
        assert al["berlin zoo"] == 3          # later entry overwrote it
        assert al["zoo"] == 3 and al["hbf"] == 1


def test_merges_keep_old_and_overwrite(spark):
    old = spark.createDataFrame([(1, 1, "A", 1.0, 2.0), (2, 2, "B", None,
                                                           None)],
                                "station_key long, eva long, "
                                "station_name string, lat double, lon double")
    new = spark.createDataFrame([(2, 2, "B2", 3.0, 4.0)], old.schema)
    m = {r.eva: r for r in merge_dim_station(old, new).collect()}
    assert m[1].station_name == "A" and m[2].station_name == "B2"
    assert changed_stations(old, old) is None
    assert changed_stations(old, new).count() == 2
    t_old = build_dim_time(spark.createDataFrame(
        [("2025-09-01 10:00:00",)], "ts string"))
    t_new = build_dim_time(spark.createDataFrame(
        [("2025-09-01 10:00:00",), ("2025-09-07 23:59:00",)], "ts string"))
    t = new_times(t_old, t_new).collect()
    assert [(r.time_key, r.is_weekend) for r in t] == [(202509072359, True)]
    tl = spark.createDataFrame([(("ICE", "5", None, "", None),),
                                ((None, "", "o", "t", "f"),)],
                               "tl struct<_c:string,_n:string,_o:string,"
                               "_t:string,_f:string>")
    trains = build_dim_train(tl.select(train_parts(tl["tl"]).alias("train")))
    got = sorted((r.category, r.train_number, r.owner) for r in
                 trains.collect())
    assert got == [("ICE", "5", ""), ("UNK", "UNK", ""), ("UNK", "UNK", "o")]
    assert new_trains(trains, trains).count() == 0
    assert new_trains(None, trains).count() == trains.count()
