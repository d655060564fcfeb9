"""Station lookups: single-text ILIKE, batch substring join, fuzzy
resolution rules."""

import random
import re

from trainyard.operators.analysis import (station_lookup,
                                          station_lookup_batch)
from trainyard.operators.graph import resolve_stations, static_graph
from trainyard.operators.textmatch import text_matches


def dim(spark):
    return spark.createDataFrame(
        [(1, 1, "Berlin Alexanderplatz", 52.52, 13.41),
         (2, 2, "Alexanderplatz Bus", 52.5, 13.4),
         (3, 3, "Berlin Hbf", 52.525, 13.369)],
        "station_key long, eva long, station_name string, lat double, "
        "lon double")


def test_lookup_single_and_batch(spark):
    d = dim(spark)
    r = station_lookup(d, "alexanderplatz").collect()
    assert [x.station_name for x in r] == ["Alexanderplatz Bus"]
    assert station_lookup(d, "a_e").collect()[0].identifier == 2  # wildcard
    req = spark.createDataFrame([(1, "ALEXANDER"), (2, "hbf"), (3, "zzz")],
                                "request_id long, text string")
    got = {x.request_id: x.station_name
           for x in station_lookup_batch(d, req).collect()}
    assert got == {1: "Alexanderplatz Bus", 2: "Berlin Hbf"}


def like(text):
    """The text as a regular expression, with LIKE's wildcards."""
    out, i = "", 0
    while i < len(text):
        c = text[i]
        if c == "\\" and text[i + 1:i + 2] in ("%", "_", "\\"):
            out, i = out + re.escape(text[i + 1]), i + 1
        else:
            out += {"%": ".*", "_": "."}.get(c) or re.escape(c)
        i += 1
    return re.compile(out, re.S)


def test_batch_lookup_with_wildcards(spark):
    """Every kind of text against a scan of all names."""
    names = ["Berlin Hbf", "Berlin Alexanderplatz", "S Hackescher Markt",
             "İstanbul Kapısı", "50%_Rabatt\\Weg", "Zoo", "zoo", "A", "Ü",
             "Straße des 17. Juni", "  "] + [f"Halt {i}" for i in range(40)]
    texts = ["berlin%platz", "_oo", "", "%", "__", "_" * 9, "_" * 40, "hbf",
             "H%t 3", "alt _", "i̇st", "İST", "kapısı", "\\%", "\\_", "\\\\w",
             "50\\%\\_r", "%%z", "ß", "ü", "17. j", "17._j", "x", "_", "lt 3_",
             "be\\rlin", None, "%3%9%", "Weg\\", "t\\\\"]
    d = spark.createDataFrame(
        [(i, i, n, 1.0, 2.0) for i, n in enumerate(names)],
        "station_key long, eva long, station_name string, lat double, "
        "lon double")
    req = spark.createDataFrame(list(enumerate(texts)),
                                "request_id long, text string")
    got = {r.request_id: r.identifier
           for r in station_lookup_batch(d, req).collect()}
    for i, t in enumerate(texts):
        want = None
        if t is not None:
            hits = [(n.encode(), k) for k, n in enumerate(names)
                    if like(t.lower()).search(n.lower())]
            want = min(hits)[1] if hits else None
        assert got.get(i) == want, t


def test_postings_reach_every_literal_match(spark):
    rnd = random.Random(2)
    names = sorted({"".join(rnd.choice("abcÄ ") for _ in range(
        rnd.randint(1, 9))) for _ in range(80)})
    texts = sorted({"".join(rnd.choice("abcä%_") for _ in range(
        rnd.randint(0, 4))) for _ in range(120)})
    n = spark.createDataFrame([(x,) for x in names], "station string")
    t = spark.createDataFrame([(x,) for x in texts], "text string")
    for wildcards in (False, True):
        got = {(r.text, r.name) for r in text_matches(
            n, "station", t, wildcards).collect()}
        assert got == {(x, y) for x in texts for y in names if (
            like(x) if wildcards else re.compile(re.escape(x))).search(
            y.lower())}


def test_fuzzy_resolution(spark):
    nodes = spark.createDataFrame(
        [("Berlin Hbf",), ("Hbf Nord",), ("Berlin Ostkreuz",),
         ("Ostkreuz",)], "station string")
    req = spark.createDataFrame(
        [(1, "hbf"), (2, "Ostkreuz"), (3, "ostkreuz"), (4, "nord"),
         (5, "x"), (6, "Berlin-Ostkreuz (S)")],
        "request_id long, text string")
    got = {r.request_id: r.station for r in
           resolve_stations(nodes, req).collect()}
    assert got == {1: "Berlin Hbf",          # ends with the text
                   2: "Ostkreuz",            # exact
                   3: "Berlin Ostkreuz",     # first ending with, by name
                   4: "Hbf Nord",            # single hit
                   6: "Berlin Ostkreuz"}     # normalised first


def test_static_graph_rules(spark):
    paths = spark.createDataFrame(
        [("A||B",), ("C|(S)|D",), ("E|E|F",), ("G",)], "planned_path string")
    nodes, edges = static_graph(paths)
    assert sorted((r.src, r.dst) for r in edges.collect()) == \
        [("A", "B"), ("E", "F")]
    assert sorted(r.station for r in nodes.collect()) == \
        ["A", "B", "C", "D", "E", "F", "G"]


def test_lookup_index_is_never_broadcast(spark):
    """The runs of the names are many times what the planner expects."""
    names = spark.range(2000).selectExpr(
        "id AS station_key", "id AS eva", "concat('Halt ', id) AS "
        "station_name", "1.0D AS lat", "2.0D AS lon")
    texts = spark.range(500).selectExpr(
        "id AS request_id", "concat('%', id * 3, '_') AS text")
    out = station_lookup_batch(names, texts)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" not in plan
    # 0_: the first of a digit behind a 0, in the order of names
    assert out.filter("request_id = 0").first().station_name == "Halt 100"
