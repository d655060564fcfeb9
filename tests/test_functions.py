"""Scalar expressions against the hand-worked fixture cases."""

import datetime as dt

from pyspark.sql import functions as F

from trainyard import functions as T


def one(spark, col, rows, schema):
    df = spark.createDataFrame(rows, schema)
    return [r[0] for r in df.select(col).collect()]


def test_signed_and_clamped_delay(spark):
    rows = [("2509021200", "2509021157", None),   # early: -3 / 0
            ("2509021200", None, None),           # no actual: NULL / 0
            (None, "2509021200", None),           # actual, no plan: NULL/NULL
            ("2509021200", "2509021210", "4"),    # delta wins: 4
            (None, None, "--5"),                  # odd delta: NULL
            ("2509021200", "2509021210", " 5")]   # blank-padded: not a delta
    schema = "pt string, ct string, dc string"
    pt, ct = T.parse_stamp("pt"), T.parse_stamp("ct")
    assert one(spark, T.signed_delay("dc", pt, ct), rows, schema) == \
        [-3, None, None, 4, None, 10]
    assert one(spark, T.clamped_delay(ct, pt), rows, schema) == \
        [0.0, 0.0, None, 10.0, 0.0, 10.0]


def test_parse_stamp_and_keys(spark):
    rows = [("2509021200",), ("2513021201",), ("25090212",), ("25090212ab",),
            ("2502301200",), ("9501011200",)]
    got = one(spark, T.parse_stamp("s"), rows, "s string")
    assert got == [dt.datetime(2025, 9, 2, 12, 0), None, None, None, None,
                   dt.datetime(2095, 1, 1, 12, 0)]
    keys = one(spark, T.lenient_time_key("s"), rows, "s string")
    assert keys[0] == 202509021200 and keys[1] is None
    assert one(spark, T.stamp_key("s"), [("2509021800",)], "s string") == \
        [202509021800]


def test_calendar_parts(spark):
    df = spark.createDataFrame([("2509061200",), ("2509081359",)], "s string")
    r = df.select(*T.calendar_columns(T.parse_stamp("s"))).collect()
    assert (r[0]["dow"], r[0]["is_weekend"]) == (6, True)     # Saturday
    assert (r[1]["dow"], r[1]["is_weekend"], r[1]["hour"], r[1]["minute"]) \
        == (1, False, 13, 59)


def test_normalize_station(spark):
    cases = {
        "Berlin-Spandau (S)": "Berlin Spandau",
        "Buch (S), Berlin": "Berlin Buch",
        "Berlin Zoo ": "Berlin Zoo",                 # padded: alias missed
        "Berlin Zoo": "Berlin Zoologischer Garten",
        "Berlin Yorckstr.(S1)": "Berlin Yorckstraße",
        "Berlin Hbf (S+U)": "Berlin Hbf",
        "(S)": "",
    }
    rows = [(k,) for k in cases]
    got = one(spark, T.normalize_station("n"), rows, "n string")
    assert got == list(cases.values())


def test_norm_name_and_file_name(spark):
    got = one(spark, T.norm_name("n"),
              [("  Berlin_Hbf  ",), ("_a  B",), ("X  y",)],
              "n string")
    assert got == ["berlin hbf", " a b", "x y"]
    got = one(spark, T.station_from_file("st", "f"),
              [(None, "Berlin_Hbf_timetable.xml"),
               ("", "Berlin_Hbf_TIMETABLE.XML"), ("Given", "x.xml")],
              "st string, f string")
    assert got == ["Berlin Hbf", "Berlin Hbf", "Given"]


def test_split_path(spark):
    rows = [("A||B",), ("A|(S)|B",), (" A | B ",)]
    got = one(spark, T.split_path("p"), rows, "p string")
    assert got == [["A", "B"], ["A", "(S)", "B"], [" A ", " B "]]
    got = one(spark, T.split_path("p", trimmed=True), rows, "p string")
    assert got[2] == ["A", "B"]


def test_strip_unicode(spark):
    got = one(spark, T.strip("s"), [("  x  ",)], "s string")
    assert got == ["x"]


def test_sq_distance(spark):
    got = one(spark, T.sq_distance("a", "b", F.lit(1.0), F.lit(2.0)),
              [(4.0, 6.0)], "a double, b double")
    assert got == [25.0]
