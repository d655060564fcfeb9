"""Property tests: closed-form upsert vs a row-by-row fold, graph searches
vs plain Python searches, grid nearest vs brute force."""

import datetime as dt
import heapq
import random
from collections import deque

import pytest
from pyspark.sql import functions as F

from trainyard.operators.fact import observed_times, upsert_fact
from trainyard.operators.graph import (connections, earliest_arrival,
                                       shortest_hops)
from trainyard.operators.nearest import nearest_station

UNK = ("UNK", "UNK", "", "", "")
ROW_T = ("phase int, seq long, snapshot_time_key long, station_key long, "
         "stop_id string, event_type string, train struct<category:string,"
         "train_number:string,owner:string,trip_type:string,"
         "filter_flags:string>, planned_time_key long, changed_time_key long, "
         "event_status string, planned_platform string, "
         "changed_platform string, line string, planned_path string, "
         "delay_minutes int, is_cancelled boolean")


def naive_fold(rows):
    """Row-by-row application of the two upsert statements (plans first)."""
    state = {}
    for r in sorted(rows, key=lambda r: (r[0], r[1])):
        phase, _, key, train, pt, ct, cs, pp, cp, line, path, dl, canc = r
        old = state.get(key)
        if old is None:
            state[key] = dict(train=train, pt=pt, ct=ct, cs=cs, pp=pp, cp=cp,
                              line=line, path=path, dl=dl, canc=canc)
            continue
        if phase == 0:
            old.update(train=train, pt=pt if pt is not None else old["pt"],
                       pp=pp if pp is not None else old["pp"],
                       line=line if line is not None else old["line"],
                       path=path if path is not None else old["path"])
        else:
            old.update(
                train=old["train"] if train == UNK else train,
                pt=old["pt"] if old["pt"] is not None else pt,
                pp=old["pp"] if old["pp"] is not None else pp,
                ct=ct if ct is not None else old["ct"],
                cs=cs if cs is not None else old["cs"],
                cp=cp if cp is not None else old["cp"],
                line=line if line is not None else old["line"],
                path=path if path is not None else old["path"],
                dl=dl if dl is not None else old["dl"],
                canc=old["canc"] or canc)
    return state


def test_upsert_matches_fold(spark):
    rnd = random.Random(7)
    rows, spark_rows = [], []

    def maybe(v):
        return v if rnd.random() < 0.6 else None
    for i in range(3000):
        phase = rnd.randint(0, 1)
        key = (1, rnd.randint(1, 3), str(rnd.randint(1, 40)),
               rnd.choice("AD"))
        seq = (phase << 62) + (rnd.randint(0, 999) << 20) + i
        train = UNK if rnd.random() < 0.4 else \
            ("ICE", str(rnd.randint(1, 3)), "", "", "")
        vals = (maybe(rnd.randint(1, 9)),
                maybe(rnd.randint(1, 9)) if phase else None,
                maybe(rnd.choice("pac")) if phase else None,
                maybe(str(rnd.randint(1, 9))),
                maybe(str(rnd.randint(1, 9))) if phase else None,
                maybe("L%d" % rnd.randint(1, 9)),
                maybe("P%d" % rnd.randint(1, 9)),
                maybe(rnd.randint(-5, 9)) if phase else None,
                bool(phase and rnd.random() < 0.2))
        rows.append((phase, seq, key, train, *vals))
        spark_rows.append((phase, seq, *key, train, vals[0], vals[1], vals[2],
                           vals[3], vals[4], vals[5], vals[6], vals[7],
                           vals[8]))
    expect = naive_fold(rows)
    df = spark.createDataFrame(spark_rows, ROW_T)
    got = {(r.snapshot_time_key, r.station_key, r.stop_id, r.event_type): r
           for r in upsert_fact(df).collect()}
    assert set(got) == set(expect)
    for k, e in expect.items():
        g = got[k]
        assert tuple(g.train) == e["train"], k
        assert (g.planned_time_key, g.changed_time_key, g.event_status,
                g.planned_platform, g.changed_platform, g.line,
                g.planned_path, g.delay_minutes, g.is_cancelled) == \
            (e["pt"], e["ct"], e["cs"], e["pp"], e["cp"], e["line"],
             e["path"], e["dl"], e["canc"]), k


def bfs(edges, s, t):
    adj = {}
    for a, b in edges:
        adj.setdefault(a, []).append(b)
    dist = {s: 0}
    q = deque([s])
    while q:
        u = q.popleft()
        for v in adj.get(u, []):
            if v not in dist:
                dist[v] = dist[u] + 1
                q.append(v)
    return dist.get(t)


def test_shortest_hops_vs_bfs(spark):
    rnd = random.Random(3)
    names = ["N%02d" % i for i in range(25)]
    edges = {(rnd.choice(names), rnd.choice(names)) for _ in range(45)}
    edges = {(a, b) for a, b in edges if a != b}
    nodes_df = spark.createDataFrame([(n,) for n in names], "station string")
    edges_df = spark.createDataFrame(sorted(edges), "src string, dst string")
    reqs = [(i, "N00", n) for i, n in enumerate(names)]
    req_df = spark.createDataFrame(reqs, "request_id long, source string, "
                                   "target string")
    got = {r.target_station: r for r in
           shortest_hops(nodes_df, edges_df, req_df).collect()}
    for _, s, t in reqs:
        d = bfs(edges, s, t)
        r = got[t]
        if d is None:
            assert (r.status, r.hops, r.path) == ("no path", None, None)
        else:
            assert r.hops == d and r.status == "found"
            assert r.path[0] == s and r.path[-1] == t
            assert all((a, b) in edges for a, b in zip(r.path, r.path[1:]))


def test_direction_and_same_station(spark):
    nodes = spark.createDataFrame([("A",), ("B",), ("C",)], "station string")
    edges = spark.createDataFrame([("A", "B"), ("B", "C")],
                                  "src string, dst string")
    req = spark.createDataFrame([(1, "A", "C"), (2, "C", "A"), (3, "B", "B")],
                                "request_id long, source string, "
                                "target string")
    got = {r.request_id: r for r in
           shortest_hops(nodes, edges, req).collect()}
    assert got[1].hops == 2 and got[1].path_text == "A → B → C"
    assert got[2].status == "no path" and got[2].path is None
    assert got[3].hops == 0 and got[3].path == ["B"]


def least_path(edges, s, t):
    """The least of the shortest paths, by levels of whole paths."""
    level, seen = {s: (s,)}, {s}
    while level:
        if t in level:
            return list(level[t])
        ahead = {}
        for u, path in level.items():
            for a, b in edges:
                if a == u and b not in seen:
                    ahead[b] = min(ahead.get(b, path + (b,)), path + (b,))
        seen |= set(ahead)
        level = ahead
    return None


@pytest.mark.parametrize("seed, n_pairs", [(1, 30), (2, 400)])
def test_hops_between_many_pairs(spark, seed, n_pairs):
    """From both ends (few pairs) and from one (many): the least path, and an
    answer of some kind for every request."""
    rnd = random.Random(seed)
    names = ["N%02d" % i for i in range(40)]
    edges = {(rnd.choice(names), rnd.choice(names)) for _ in range(75)}
    edges = sorted((a, b) for a, b in edges if a != b)
    nodes = spark.createDataFrame([(n,) for n in names], "station string")
    reqs = [(i, rnd.choice(names), rnd.choice(names))
            for i in range(n_pairs)]
    reqs += [(9001, "nowhere", "N01"), (9002, "N01", "nowhere"),
             (9003, "nowhere", "elsewhere"), (9004, None, "N01")]
    req = spark.createDataFrame(reqs, "request_id long, source string, "
                                "target string")
    got = {r.request_id: r for r in shortest_hops(
        nodes, spark.createDataFrame(edges, "src string, dst string"),
        req).collect()}
    assert len(got) == len(reqs)
    for i, s, t in reqs[:n_pairs]:
        path = least_path(edges, s, t)
        assert got[i].path == path, (s, t)
        assert got[i].status == ("found" if path else "no path")
        assert got[i].hops == (len(path) - 1 if path else None)
    assert [got[i].status for i in (9001, 9002, 9003, 9004)] == [
        "source not found", "target not found", "source not found",
        "source not found"]


def dijkstra(conns, s, t, t0):
    best = {s: t0}
    pq = [(t0, s)]
    while pq:
        tm, u = heapq.heappop(pq)
        if u == t:
            return tm
        if best.get(u, tm) < tm:
            continue
        for (a, b, dep, arr) in conns:
            if a == u and dep >= tm and (b not in best or arr < best[b]):
                best[b] = arr
                heapq.heappush(pq, (arr, b))
    return None


def test_earliest_arrival_vs_dijkstra(spark):
    rnd = random.Random(11)
    names = ["S%d" % i for i in range(12)]
    base = dt.datetime(2025, 9, 2, 12, 0)
    conns = []
    for _ in range(120):
        a, b = rnd.sample(names, 2)
        dep = base + dt.timedelta(minutes=rnd.randint(0, 300))
        arr = dep + dt.timedelta(minutes=rnd.randint(1, 60))
        conns.append((a, b, dep, arr))
    cdf = spark.createDataFrame(
        [(a, b, d, r, i) for i, (a, b, d, r) in enumerate(conns)],
        "from_station string, to_station string, "
        "departure_time timestamp_ntz, arrival_time timestamp_ntz, "
        "train_id long")
    stations = sorted({c[0] for c in conns} | {c[1] for c in conns})
    reqs = [(i, "S0", s, base) for i, s in enumerate(stations)]
    rdf = spark.createDataFrame(reqs, "request_id long, source string, "
                                "target string, departure timestamp_ntz")
    got = {r.target_station: r for r in earliest_arrival(cdf, rdf).collect()}
    for _, s, t, t0 in reqs:
        e = dijkstra(conns, s, t, t0)
        r = got[t]
        if e is None:
            assert (r.status, r.arrival, r.legs) == ("no path", None, None)
            continue
        assert r.arrival == e and r.status == "found"
        # itinerary is a valid chain from the source to the target
        legs = r.legs
        if t == s:
            assert legs == []
            continue
        assert legs[0].from_station == s and legs[-1].to_station == t
        assert legs[0].departure_time >= t0
        for x, y in zip(legs, legs[1:]):
            assert x.to_station == y.from_station
            assert y.departure_time >= x.arrival_time


@pytest.mark.parametrize("minutes", [7, 1440])
def test_earliest_arrival_from_many_sources(spark, minutes):
    """Labels equal the least (arrival, departure, from, train) of all
    connections that can be reached, whatever the bucket width."""
    rnd = random.Random(5)
    names = ["S%d" % i for i in range(9)]
    base = dt.datetime(2025, 9, 2, 22, 0)
    conns = []
    for i in range(200):
        a, b = rnd.sample(names, 2)
        dep = base + dt.timedelta(minutes=5 * rnd.randint(0, 60))
        conns.append((a, b, dep, dep + dt.timedelta(
            minutes=5 * rnd.randint(1, 12)), i))
    cdf = spark.createDataFrame(
        conns, "from_station string, to_station string, departure_time "
        "timestamp_ntz, arrival_time timestamp_ntz, train_id long")
    reqs = [(i, rnd.choice(names), rnd.choice(names),
             base + dt.timedelta(minutes=rnd.choice([0, 33, 120, 400])))
            for i in range(60)] + [(99, "S1", "nowhere", base),
                                   (98, "S1", "S1", None)]
    rdf = spark.createDataFrame(reqs, "request_id long, source string, "
                                "target string, departure timestamp_ntz")
    got = {r.request_id: r for r in earliest_arrival(
        cdf, rdf, bucket_minutes=minutes).collect()}
    assert len(got) == len(reqs) and got[99].status == "target not found"
    assert got[98].status == "no path"
    for i, s, t, t0 in reqs[:60]:
        arr = {s: t0}
        while True:
            more = {}
            for a, b, dep, at, _ in conns:
                if a in arr and dep >= arr[a] and at < arr.get(
                        b, more.get(b, dt.datetime.max)):
                    more[b] = at
            if not more:
                break
            arr.update(more)
        assert got[i].arrival == arr.get(t)
        if t == s or t not in arr:
            continue
        last = min((at, dep, a, k) for a, b, dep, at, k in conns
                   if b == t and a in arr and dep >= arr[a])
        leg = got[i].legs[-1]
        assert (leg.arrival_time, leg.departure_time, leg.from_station,
                leg.train_id) == last
        assert got[i].legs[0].from_station == s


def test_a_hub_makes_one_row_per_neighbour(spark):
    """A label meets one row of the profile for each neighbour, however many
    connections leave the hub behind it."""
    from trainyard.operators.graph import profile
    base = dt.datetime(2025, 9, 2, 0, 0)
    rows = [("hub", f"N{i % 7}", base + dt.timedelta(minutes=i % 1400),
             base + dt.timedelta(minutes=i % 1400 + 3 + i % 11), i)
            for i in range(6000)]
    conns = spark.createDataFrame(
        rows, "from_station string, to_station string, departure_time "
        "timestamp_ntz, arrival_time timestamp_ntz, train_id long")
    p = profile(conns, F.lit(base).cast("timestamp_ntz"), 60).cache()
    labels = spark.createDataFrame(
        [(i, base + dt.timedelta(minutes=i, seconds=30)) for i in
         range(0, 1380, 60)], "id long, ready timestamp_ntz")
    met = labels.join(p, (F.col("after").isNull() |
                          (F.col("ready") > F.col("after"))) &
                      (F.col("ready") <= F.col("dep")) &
                      (F.floor(F.unix_micros(F.col("ready").cast("timestamp"))
                               / F.lit(3600_000_000)) == F.col("bucket")))
    for r in met.collect():
        want = min((c[3], c[2], c[4]) for c in rows
                   if c[1] == r.to and c[2] >= r.ready)
        assert (r.arr, r.dep, r.train) == want
    per = met.groupBy("id").count().collect()
    assert {r["count"] for r in per} == {7} and len(per) == 23


def test_connection_pairing(spark):
    t = dt.datetime(2025, 9, 2, 12, 0)
    ev = spark.createDataFrame(
        [(1, "A", "D", t, "x"), (1, "B", "A", t, "y"),          # same time
         (2, "A", "D", t, "x"), (2, "B", "A", t.replace(minute=5), "y"),
         (2, "B", "D", t.replace(minute=10), "z"),
         (2, "C", "A", t.replace(hour=14), "w")],
        "train_key long, station string, event_type string, "
        "ts timestamp_ntz, stop_id string").withColumn("date", F.to_date("ts"))
    got = sorted((r.train_id, r.from_station, r.to_station)
                 for r in connections(ev, bucket_minutes=15).collect())
    # train 1: A sorts before D at equal times -> no D->A pair
    # train 2: pairs across 15-minute slices are still found
    assert got == [(2, "A", "B"), (2, "B", "C")]
    one_minute = sorted((r.train_id, r.from_station, r.to_station)
                        for r in connections(ev).collect())
    assert one_minute == got


def test_connections_run_their_input_once(spark, tmp):
    t = dt.datetime(2025, 9, 2, 12, 0)
    spark.createDataFrame(
        [(1, "A", "D", t, "x"), (1, "B", "A", t.replace(minute=9), "y"),
         (None, "A", "D", t, "x"), (None, "B", "A", t, "y"),
         (2, "A", "D", t, "x"), (2, "A", "D", t, "x"),
         (2, "B", "A", t, "y")],
        "train_key long, station string, event_type string, "
        "ts timestamp_ntz, stop_id string").withColumn(
        "date", F.to_date("ts")).write.parquet(tmp + "/events")
    events = spark.read.parquet(tmp + "/events")
    got = connections(events)
    assert [(r.train_id, r.from_station, r.to_station)
            for r in got.collect()] == [(1, "A", "B")]
    assert not set(got.inputFiles()) & set(events.inputFiles())


def test_observed_times_are_made_once_a_minute(spark, tmp):
    from trainyard.operators.dims import build_dim_time
    spark.createDataFrame(
        [(202509010000, 202509011200, None)] * 3
        + [(202509010000, None, 202402290001)],
        "snapshot_time_key long, planned_time_key long, "
        "changed_time_key long").write.parquet(tmp + "/rows")
    times = build_dim_time(observed_times(spark.read.parquet(tmp + "/rows")))
    plan = times._jdf.queryExecution().sparkPlan().toString()
    # in front of (in the text: below) the first aggregate nothing is parsed
    assert "gettimestamp" in plan
    assert "gettimestamp" not in plan[plan.index("Generate explode"):]
    assert "gettimestamp" not in plan[plan.rindex("HashAggregate("):]
    assert sorted(r.time_key for r in times.collect()) == [
        202402290001, 202509010000, 202509011200]


def test_runs_of_names_are_made_in_many_tasks(spark):
    from trainyard.operators.textmatch import text_matches
    names = spark.range(3000).select(F.concat(F.lit("Stop "), F.col("id"))
                                     .alias("name"))
    texts = spark.createDataFrame([("top 29",), ("nowhere",)], "text string")
    got = text_matches(names.distinct(), "name", texts)
    assert got.count() == 111
    # a shuffle of a given width is not made narrower for its few bytes
    assert "REPARTITION_BY_NUM" in \
        got._jdf.queryExecution().executedPlan().toString()


def test_static_graph_makes_names_once(spark, monkeypatch):
    from trainyard.operators import graph
    plans, cut = [], graph.cut_lineage

    def cut_lineage(df, name="round"):
        plans.append(df._jdf.queryExecution().optimizedPlan().toString())
        return cut(df, name)

    monkeypatch.setattr(graph, "cut_lineage", cut_lineage)
    paths = spark.createDataFrame(
        [("A| |B|A",), ("B|(S)|C",), ("D|D",), ("(S)",), (None,), ("",)],
        "planned_path string")
    nodes, edges = graph.static_graph(paths)
    assert sorted(r.station for r in nodes.collect()) == ["A", "B", "C", "D"]
    assert sorted(map(tuple, edges.collect())) == [("A", "B"), ("B", "A")]
    assert len(plans) == 1 and plans[0].count("posexplode") == 1
    lazy = graph.static_graph(paths, materialize=False)
    assert sorted(map(tuple, lazy[0].collect())) == \
        sorted(map(tuple, nodes.collect()))
    assert sorted(map(tuple, lazy[1].collect())) == \
        sorted(map(tuple, edges.collect()))


def test_nearest_vs_brute_force(spark):
    rnd = random.Random(5)
    st = [("st%03d" % i, round(rnd.uniform(0, 10), 1),
           round(rnd.uniform(0, 10), 1)) for i in range(60)]
    st += [("hot%02d" % i, 5.0, 5.0) for i in range(20)]      # a hot cell
    st += [("nocoord", None, None)]
    pts = [(i, rnd.uniform(-3, 13), rnd.uniform(-3, 13)) for i in range(200)]
    sdf = spark.createDataFrame(st, "station_name string, lat double, "
                                "lon double")
    pdf = spark.createDataFrame(pts, "request_id long, lat double, lon double")
    got = {r.request_id: r.station_name
           for r in nearest_station(sdf, pdf).collect()}
    for i, la, lo in pts:
        best = min((((a - la) ** 2 + (b - lo) ** 2), n) for n, a, b in st
                   if a is not None)
        assert got[i] == best[1]


@pytest.mark.parametrize("seed", [1])
def test_nearest_with_clusters_and_outliers(spark, seed):
    """A dense town, a line, twins and one station at 0/0 far away; points
    in the town, far off and on stations: exact, and no point looks at more
    than a few cells."""
    from trainyard.operators.nearest import open_cells, station_tree
    rnd = random.Random(seed)
    st = {(0.0, 0.0): "null island"}
    for i in range(900):
        st[52.5 + rnd.gauss(0, .01), 13.4 + rnd.gauss(0, .01)] = f"town{i}"
    for i in range(100):
        st[50 + i / 1000, 11.0] = f"line{i}"
        st[48.0, 9 + rnd.random() * 1e-9] = f"twin{i}"
    pts = [(i, *rnd.choice([
        (52.5 + rnd.gauss(0, .02), 13.4 + rnd.gauss(0, .02)),
        (rnd.uniform(-90, 90), rnd.uniform(-180, 180)),
        (50.05, 11 + rnd.gauss(0, 1)), (48.0, 9.0), (0.5, 0.5),
        rnd.choice(list(st))])) for i in range(300)] + [(999, None, 1.0)]
    sdf = spark.createDataFrame([(n, a, b) for (a, b), n in st.items()],
                                "station_name string, lat double, lon double")
    pdf = spark.createDataFrame(pts, "request_id long, lat double, lon double")
    got = {r.request_id: r for r in nearest_station(sdf, pdf).collect()}
    assert 999 not in got
    for i, la, lo in pts[:-1]:
        best = min(((a - la) * (a - la) + (b - lo) * (b - lo), n)
                   for (a, b), n in st.items())
        assert (got[i].d2, got[i].station_name) == best
    tree, placed = station_tree(sdf.toDF("station_name", "s_lat", "s_lon"))
    assert placed.count() == len(st)
    places = pdf.dropna().withColumnRenamed("request_id", "place")
    seen = open_cells(tree, places).join(placed, ["depth", "cell"]).groupBy(
        "place").count().agg(F.max("count"), F.avg("count")).first()
    # the twins alone are a hundred, closer than the finest cell
    assert seen[0] <= 180 and seen[1] < 60


def test_nearest_without_stations_or_points(spark):
    schema = "station_name string, lat double, lon double"
    none = spark.createDataFrame([("x", None, None)], schema)
    one = spark.createDataFrame([("x", 1.0, 2.0)], schema)
    pts = spark.createDataFrame([(1, 5.0, 5.0)], "request_id long, lat double,"
                                " lon double")
    assert nearest_station(none, pts).count() == 0
    assert nearest_station(one, pts.limit(0)).count() == 0
    assert nearest_station(one, pts).first().station_name == "x"


def test_upsert_shuffles_rows_not_aggregates(spark):
    """What the aggregates keep of a row is many times the row."""
    rows = spark.createDataFrame([], ROW_T)
    plan = upsert_fact(rows)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1
    assert "REPARTITION_BY_COL" in plan


def test_search_does_not_broadcast_many_labels(spark, monkeypatch):
    """A search gives the same answers where all its joins shuffle."""
    from trainyard.operators import graph
    few = spark.range(5).withColumnRenamed("id", "k")
    for n, broadcast in ((graph.FEW, True), (graph.FEW + 1, False)):
        plan = graph._dealt(few, n).join(few.withColumn("v", F.lit(1)), "k") \
            ._jdf.queryExecution().executedPlan().toString()
        assert ("BroadcastHashJoin" in plan) == broadcast
    t = dt.datetime(2025, 9, 1)
    conns = spark.createDataFrame(
        [(f"S{i}", f"S{i + 1}", t + dt.timedelta(minutes=10 * i),
          t + dt.timedelta(minutes=10 * i + 5), i) for i in range(6)],
        "from_station string, to_station string, departure_time "
        "timestamp_ntz, arrival_time timestamp_ntz, train_id long")
    req = spark.createDataFrame([(1, "S0", "S6", t), (2, "S2", "S5", t)],
                                "request_id long, source string, "
                                "target string, departure timestamp_ntz")
    monkeypatch.setattr(graph, "FEW", -1)
    got = {r.request_id: (r.arrival, len(r.legs))
           for r in earliest_arrival(conns, req).collect()}
    assert got == {1: (t + dt.timedelta(minutes=55), 6),
                   2: (t + dt.timedelta(minutes=45), 3)}


def test_small_groups_are_not_sliced(spark, monkeypatch):
    """One shuffle pairs the events of small groups; large ones, and groups
    or times that are NULL, come out alike, sliced or not."""
    from trainyard.operators import graph
    rng = random.Random(3)
    t = dt.datetime(2025, 9, 2, 12, 0)
    ev = spark.createDataFrame(
        [(rng.choice([1, 2, 3, None]), f"S{rng.randrange(9)}",
          rng.choice("AD"), None if i % 17 == 0 else
          t + dt.timedelta(seconds=rng.randrange(900)), str(i))
         for i in range(400)],
        "train_key long, station string, event_type string, "
        "ts timestamp_ntz, stop_id string").withColumn(
        "date", F.lit("2025-09-02").cast("date"))
    whole = connections(ev)
    plan = whole._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange ") == 1 and "Join" not in plan
    want = sorted(map(str, whole.collect()))
    for least in (-60, -10 ** 6):           # some groups are large, or all
        monkeypatch.setattr(graph, "LARGE", least + 160)
        assert sorted(map(str, connections(ev).collect())) == want
    assert len(want) > 50


def test_first_connections_are_kept_once(spark):
    from trainyard.operators.graph import profile
    t = dt.datetime(2025, 9, 2)
    conns = spark.createDataFrame(
        [("A", f"B{i}", t + dt.timedelta(hours=20), t + dt.timedelta(hours=21),
          i) for i in range(5)], "from_station string, to_station string, "
        "departure_time timestamp_ntz, arrival_time timestamp_ntz, "
        "train_id long")
    first = F.lit(t).cast("timestamp_ntz")
    assert profile(conns, first, 60, True).count() == 5
    assert profile(conns, first, 60).count() == 5 * 21
