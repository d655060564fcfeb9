"""Routing on the rail network as DataFrame jobs.

* static graph (nodes, edges) from the planned paths of departures;
* fuzzy resolution of request texts to graph stations;
* fewest-hop paths: level-synchronous BFS for a batch of requests;
* timetable connections: a departure followed by an arrival of the same
  train;
* earliest arrival: label-correcting search over the connections for a
  batch of requests, itineraries by back-tracking the labels.

Loops keep their state in DataFrames checkpointed into the shared folder
after every round; only "is the frontier empty" reaches the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from trainyard.functions.delay import minutes_between
from trainyard.functions.text import normalize_station, split_path, strip
from trainyard.operators.common import cut_and_count, cut_lineage
from trainyard.operators.textmatch import text_matches

ARROW = " → "


# ------------------------------------------------------------------ G1, G2
def departure_paths(fact: DataFrame) -> DataFrame:
    """Distinct non-empty planned paths of departure events."""
    return fact.filter((F.col("event_type") == "D") &
                       F.col("planned_path").isNotNull() &
                       (F.col("planned_path") != "")) \
        .select("planned_path").distinct()


def unique_path_stations(paths: DataFrame, normalize: bool = True
                         ) -> DataFrame:
    """Sorted distinct station names of the paths (segments stripped; with
    ``normalize`` also normalised, which may yield an empty name)."""
    ex = paths.select(F.explode(split_path("planned_path", trimmed=True))
                      .alias("station"))
    if normalize:
        ex = ex.select(normalize_station("station").alias("station"))
    return ex.distinct().orderBy("station")


def static_graph(paths: DataFrame, materialize: bool = True
                 ) -> tuple[DataFrame, DataFrame]:
    """(nodes(station), edges(src, dst)).  Edges join consecutive stations
    of one path after normalisation; blank segments are dropped before
    pairing, a name emptied by normalisation breaks the chain, self-loops
    are dropped and direction is kept.

    Segments are exploded with their positions and blank ones dropped as
    rows (no per-element lambda, so the normaliser runs in generated code);
    consecutive pairs come from a ``lead`` over
    the kept positions of each path (a path is short, so no group is
    large).  With ``materialize`` nodes and edges are computed in one pass
    and written once to the shared folder, so every search round reads the
    small tables."""
    seg = paths.select("planned_path", F.posexplode(
        F.split("planned_path", r"\|")).alias("i", "raw")) \
        .filter(strip("raw") != "") \
        .withColumn("station", normalize_station("raw"))
    w = Window.partitionBy("planned_path").orderBy("i")
    pairs = seg.select(F.col("station").alias("src"),
                       F.lead("station").over(w).alias("dst"))
    is_edge = F.col("dst").isNotNull() & (F.col("src") != "") & \
        (F.col("dst") != "") & (F.col("src") != F.col("dst"))
    edges = pairs.filter(is_edge).distinct()
    nodes = seg.filter(F.col("station") != "").select("station").distinct()
    if materialize:
        # every segment is the first of a pair, so the names are made once
        both = pairs.select(F.inline(F.array(
            F.struct(F.lit(True).alias("is_node"), "src",
                     F.lit(None).cast("string").alias("dst")),
            F.struct(F.lit(False).alias("is_node"), "src", "dst")))) \
            .filter(is_edge | (F.col("is_node") & (F.col("src") != ""))) \
            .distinct()
        both = cut_lineage(both, "graph")
        nodes = both.filter("is_node").select(F.col("src").alias("station"))
        edges = both.filter(~F.col("is_node")).select("src", "dst")
    return nodes, edges


# ---------------------------------------------------------------------- G3
def resolve_stations(nodes: DataFrame, requests: DataFrame,
                     text_col: str = "text",
                     nodes_materialized: bool = False) -> DataFrame:
    """``requests(request_id, text)`` -> ``(request_id, station)``.

    The text is normalised like a path station, then: an exact node name;
    else the nodes containing it case-insensitively -- a single one, else
    the first (by name) that ends with it, else the first by name.
    Unresolved requests are absent."""
    if not nodes_materialized:
        nodes = cut_lineage(nodes.select("station"), "resolve-nodes")
    r = requests.select("request_id",
                        normalize_station(F.col(text_col)).alias("q"))
    known = nodes.select("station").distinct()
    exact = r.join(known, r["q"] == known["station"]).select(
        "request_id", "station")
    rest = r.join(exact.select("request_id"), "request_id", "left_anti")
    hits = text_matches(known, "station", rest.select(F.col("q")
                                                      .alias("text")))
    ends = F.endswith(F.lower("name"), F.lower("text"))
    best = hits.groupBy("text").agg(F.min(F.struct(
        (~ends).alias("inside"), F.col("name").alias("station"))).alias("c"))
    return exact.unionByName(rest.join(best, rest["q"] == best["text"]).select(
        "request_id", "c.station"))


# ------------------------------------------------------- requests and answers
FOUND = "found"
NO_SOURCE, NO_TARGET = "source not found", "target not found"
NO_PATH = "no path"


def _resolved(nodes: DataFrame, requests: DataFrame, keep: list[str]
              ) -> DataFrame:
    """``requests`` (request_id, source, target, *keep) with source_station
    and target_station (NULL: no such station), written.  Equal texts are
    looked up once."""
    requests = cut_lineage(requests.select("request_id", "source", "target",
                                           *keep), "requests")
    texts = requests.select(F.col("source").alias("text")).unionByName(
        requests.select(F.col("target").alias("text"))).distinct()
    known = cut_lineage(resolve_stations(
        nodes, texts.select(F.col("text").alias("request_id"), "text"),
        nodes_materialized=True), "resolved")
    for side in ("source", "target"):
        requests = requests.join(known.toDF(side, f"{side}_station"), side,
                                 "left")
    return cut_lineage(requests, "requests")


def _status(found) -> F.Column:
    """What a request comes to, whether it has an answer or not."""
    return F.when(F.col("source_station").isNull(), NO_SOURCE) \
        .when(F.col("target_station").isNull(), NO_TARGET) \
        .when(found, FOUND).otherwise(NO_PATH)


# ---------------------------------------------------------------------- G4
COMPACT = 4     # levels kept as tables of their own
FEW = 50_000    # counted rows that a join may broadcast


def _dealt(df: DataFrame, n: int) -> DataFrame:
    """``df`` of ``n`` rows, marked for a join: broadcast while few, else
    shuffled.  A label takes so few bytes of a file that the planner, which
    goes by file sizes, would broadcast millions."""
    return F.broadcast(df) if n <= FEW else df.hint("merge")


class _Side:
    """One end of the search: the nodes reached from each distinct start, by
    level, as rows (start, node, level)."""

    def __init__(self, starts: DataFrame, step: DataFrame, name: str):
        self.step, self.name, self.depth = step, name, 0
        first = starts.select("start", F.col("start").alias("node"),
                              F.lit(0).alias("level"))
        self.last, self.size = cut_and_count(first, f"hops-{name}", F.lit(True))
        self.tables, self.old = [self.last], 0

    def visited(self) -> DataFrame:
        return _all(self.tables)

    def advance(self, wanted: DataFrame) -> None:
        """One level more, for the ``wanted`` starts."""
        if len(self.tables) - 1 > COMPACT:
            self.tables = [cut_lineage(self.visited(), f"hops-{self.name}")]
        ahead = self.last.join(wanted, "start", "left_semi").join(
            self.step, "node").select("start", F.col("next").alias("node")) \
            .distinct().join(self.visited(), ["start", "node"], "left_anti")
        self.depth += 1
        self.last, self.size = cut_and_count(
            ahead.withColumn("level", F.lit(self.depth)), f"hops-{self.name}",
            F.lit(True))
        self.tables.append(self.last)


def _all(tables: list[DataFrame]) -> DataFrame:
    out = tables[0]
    for t in tables[1:]:
        out = out.unionByName(t)
    return out


def shortest_hops(nodes: DataFrame, edges: DataFrame, requests: DataFrame,
                  inputs_materialized: bool = False, paths: bool = True
                  ) -> DataFrame:
    """Fewest-hop paths for ``requests(request_id, source, target)``: one row
    per request, ``(request_id, source_station, target_station, status,
    hops, path, path_text)``; see :func:`_status` for requests without an
    answer.  Of several shortest paths the lexicographically smallest is
    returned.  Without ``paths`` the last two columns are left out.

    Breadth-first from both ends, once per distinct source and once per
    distinct target.  Each round moves the side with the smaller frontier one
    level; a pair is found when the two sides' last levels share a node, and
    leaves the search.  Where pairs are many more than their ends (all
    targets of one source), only the side with fewer starts moves.  Levels
    hold (start, node) rows, no paths; the path is walked at the end, over
    the nodes that lie on a shortest one."""
    if not inputs_materialized:
        nodes = cut_lineage(nodes, "hops-nodes")
        edges = cut_lineage(edges, "hops-edges")
    req = _resolved(nodes, requests, [])
    pairs, n_open = cut_and_count(
        req.filter("source_station IS NOT NULL AND target_station IS NOT "
                   "NULL").select(F.col("source_station").alias("src"),
                                  F.col("target_station").alias("tgt"))
        .distinct(), "hops-pairs", F.lit(True))
    ahead = _Side(pairs.select(F.col("src").alias("start")).distinct(),
                  edges.toDF("node", "next"), "ahead")
    back = _Side(pairs.select(F.col("tgt").alias("start")).distinct(),
                 edges.select("dst", "src").toDF("node", "next"), "back")
    both = n_open <= 4 * max(ahead.size, back.size)
    fewer = ahead if ahead.size <= back.size else back
    met, open_ = [], pairs
    while n_open > 0:
        a = ahead.last.select(F.col("start").alias("src"), "node")
        b = back.last.select(F.col("start").alias("tgt"), "node")
        if ahead.depth and back.depth:
            hits = a.join(open_, "src").join(b, ["tgt", "node"])
        else:       # one side is at its starts: one row per node and start
            hits = a.join(b, "node").join(open_, ["src", "tgt"], "left_semi")
        hits, n_hits = cut_and_count(hits.select(
            "src", "tgt", "node", F.lit(ahead.depth).alias("a"),
            F.lit(back.depth).alias("b")), "hops-met", F.lit(True))
        if n_hits:
            met.append(hits)
            open_, n_open = cut_and_count(open_.join(
                hits, ["src", "tgt"], "left_anti"), "hops-open", F.lit(True))
        if not n_open:
            break
        side = (ahead if ahead.size <= back.size else back) if both else fewer
        side.advance(open_.select(F.col(
            "src" if side is ahead else "tgt").alias("start")).distinct())
        if not side.size:
            break
    columns = ["request_id", "source_station", "target_station", "status",
               "hops"] + (["path", "path_text"] if paths else [])
    if not met:
        empty = req.withColumn("hops", F.lit(None).cast("int")).withColumn(
            "path", F.lit(None).cast("array<string>"))
        return empty.select("*", _status(F.lit(False)).alias("status"),
                            F.lit(None).cast("string").alias("path_text")) \
            .select(*columns)
    met = _all(met)
    found = met.select("src", "tgt", (F.col("a") + F.col("b")).alias("hops")) \
        .distinct()
    if paths:
        found = found.join(_walked(met, edges, ahead, back), ["src", "tgt"])
    out = req.join(found.withColumnsRenamed(
        {"src": "source_station", "tgt": "target_station"}),
        ["source_station", "target_station"], "left").withColumn(
        "status", _status(F.col("hops").isNotNull()))
    if paths:
        out = out.withColumn("path_text", F.array_join("path", ARROW))
    return out.select(*columns)


def _walked(met: DataFrame, edges: DataFrame, ahead: _Side, back: _Side
            ) -> DataFrame:
    """(src, tgt, path) of the pairs in ``met`` (src, tgt, node, a, b: the
    nodes a hops behind the source and b before the target).

    The nodes of the source's side that lie on a shortest path are marked
    level by level, from the meeting nodes down; then all pairs walk together,
    each to the smallest next node that is marked, or, behind the meeting
    level, that the target's side has reached in as many hops as are left."""
    K = ["src", "tgt"]
    reached, marks = ahead.visited(), []
    for i in range(ahead.depth, 0, -1):
        here = met.filter(F.col("a") == i).select(*K, "node")
        if marks:
            up = marks[-1].drop("at").withColumnRenamed("node", "dst").join(
                edges.toDF("node", "dst"), "dst").join(
                reached.filter(F.col("level") == i).select(
                    F.col("start").alias("src"), "node"), ["src", "node"]) \
                .select(*K, "node")
            here = here.unionByName(up).distinct()
        marks.append(cut_lineage(here.withColumn("at", F.lit(i)),
                                 "hops-marked"))
    ends = met.select(*K, "a", (F.col("a") + F.col("b")).alias("hops")) \
        .distinct()
    longest = ends.agg(F.max("hops")).first()[0]
    on_way = back.visited().select(F.col("start").alias("tgt"), "node",
                                   F.col("level").alias("left"))
    steps = [cut_lineage(ends.select(*K, "a", "hops", F.lit(0).alias("at"),
                                     F.col("src").alias("node")), "hops-walk")]
    for i in range(1, longest + 1):
        out = steps[-1].filter(F.col("hops") >= i).join(
            edges.toDF("node", "next"), "node").select(
            *K, "a", "hops", F.col("next").alias("node"))
        behind = out.filter(F.col("a") < i).withColumn(
            "left", F.col("hops") - i).join(
            on_way, ["tgt", "node", "left"]).drop("left")
        if i <= ahead.depth:
            behind = behind.unionByName(out.filter(F.col("a") >= i).join(
                marks[ahead.depth - i].drop("at"), [*K, "node"])
                .select(*behind.columns))
        steps.append(cut_lineage(behind.groupBy(*K, "a", "hops").agg(
            F.min("node").alias("node")).withColumn("at", F.lit(i)),
            "hops-walk"))
    # a path is short
    return _all([s.select(*K, "at", "node") for s in steps]).groupBy(*K).agg(
        F.transform(F.sort_array(F.collect_list(F.struct("at", "node"))),
                    lambda x: x["node"]).alias("path"))


# ---------------------------------------------------------------------- G5
def timetable_events(fact: DataFrame, dim_station: DataFrame,
                     dim_time: DataFrame, date=None) -> DataFrame:
    """Non-cancelled A/D events with planned time (optionally of one date):
    ``(train_key, station, event_type, ts, stop_id, date)``, station names
    normalised.  A date is also a range of time keys, which reaches the scan
    of the fact."""
    t = dim_time.select("time_key", "ts", "date")
    f = fact.filter(F.col("event_type").isin("A", "D") &
                    ~F.col("is_cancelled"))
    if date is not None:
        t = t.filter(F.col("date") == F.lit(date).cast("date"))
        day = int(str(date).replace("-", "")[:8]) * 10_000
        f = f.filter(F.col("planned_time_key").between(day, day + 2359))
    st = dim_station.select("station_key", normalize_station(
        "station_name").alias("station"))
    j = f.join(st, "station_key") \
        .join(t, f["planned_time_key"] == t["time_key"])
    return j.select("train_key", "station", "event_type", "ts", "stop_id",
                    "date")


LARGE = 100_000     # rows of a group that one task may sort
GROUP_PARTS = 4096  # parts that groups are counted in


def _large_groups(table: DataFrame, part: list[str]) -> F.Column | None:
    """Whether a row's group may be large; None: no group is.  Groups are
    counted by parts of a hash, a part of many groups as one; at most
    ``GROUP_PARTS`` numbers reach the driver, however many groups there are.
    A part counts as large when it holds ``LARGE`` rows more than twice the
    mean, so a group that is sorted whole is small beside the table or small
    in itself."""
    key = F.pmod(F.xxhash64(*part), F.lit(GROUP_PARTS))
    sizes = {r[0]: r[1] for r in table.groupBy(key.alias("k")).count()
             .collect()}
    most = LARGE + 2 * sum(sizes.values()) / GROUP_PARTS
    large = [k for k, n in sizes.items() if n > most]
    return key.isin(large) if large else None


def next_in_sequence(events: DataFrame, part: list[str], order: list[str],
                     payload: list[str], bucket: F.Column,
                     written: bool = False) -> DataFrame:
    """Attach to every row the next row of its ``part`` group in
    ``order`` (columns ``next_<payload>``), without sorting a large group in
    one task: its rows are ordered inside (part, bucket) slices, and the last
    row of a slice takes the first row of the next non-empty slice.  Other
    groups are one slice.  ``bucket`` must be monotone in ``order``; a NULL
    bucket, or a NULL in ``part``, links no slices.  The rows are read several
    times, so they are written once (unless they are ``written``): what
    ``events`` comes from runs once."""
    ev = (events if written else cut_lineage(events, "events")) \
        .withColumn("_b", bucket)
    key = F.struct(*[F.col(c) for c in order + payload])
    no_part = F.lit(False)
    for c in part:
        no_part = no_part | F.col(c).isNull()
    large = _large_groups(ev, part)
    sliced = no_part if large is None else large | no_part
    ev = ev.withColumn("_slice", F.when(sliced, F.col("_b")))
    w = Window.partitionBy(*part, F.col("_b").isNull(), "_slice") \
        .orderBy(*order)
    out = [*events.columns, *[F.col(f"_next.{c}").alias(f"next_{c}")
                              for c in order + payload]]

    def followed(df: DataFrame) -> DataFrame:
        return df.withColumn("_next", F.lead(key).over(w))

    if large is None:
        return followed(ev).select(*out)
    small = followed(ev.filter(~large)).select(*out)
    ev = cut_lineage(followed(ev.filter(large)), "sequence")
    firsts = ev.groupBy(*part, "_b").agg(F.min(key).alias("_first"))
    wb = Window.partitionBy(*part).orderBy("_b")
    firsts = firsts.withColumn("_next_slice", F.lead("_first").over(wb)) \
        .select(*part, "_b", "_next_slice")
    ev = ev.join(firsts, [*part, "_b"], "left") \
        .withColumn("_next", F.coalesce("_next", "_next_slice"))
    return small.unionByName(ev.select(*out))


def connections(events: DataFrame, bucket_minutes: int = 1) -> DataFrame:
    """Departure followed directly by an arrival of the same train on the
    same date (events ordered by time, A before D at equal times, then
    station and stop id) -> ``(from_station, to_station, departure_time,
    arrival_time, train_id, date)``.

    Rows are ordered inside (train, date, ``bucket_minutes`` slice) groups,
    so even the shared unknown train is sorted in many small tasks; the
    slice summaries (at most 1,440 per train and day at one minute) link
    the slices."""
    bucket = F.floor(F.unix_micros(F.col("ts").cast("timestamp")) /
                     F.lit(bucket_minutes * 60_000_000))
    nxt = next_in_sequence(events, ["train_key", "date"],
                           ["ts", "event_type", "station", "stop_id"], [],
                           bucket)
    c = nxt.filter((F.col("event_type") == "D") &
                   (F.col("next_event_type") == "A"))
    return c.select(F.col("station").alias("from_station"),
                    F.col("next_station").alias("to_station"),
                    F.col("ts").alias("departure_time"),
                    F.col("next_ts").alias("arrival_time"),
                    F.col("train_key").alias("train_id"), "date")


# ---------------------------------------------------------------------- G6
def profile(conns: DataFrame, first: F.Column, bucket_minutes: int = 60,
            heads_once: bool = False) -> DataFrame:
    """What a traveller who is ready at some time takes from one station to
    the next: rows ``(station, bucket, after, dep, to, arr, train)``.  Ready
    later than ``after`` (NULL: any time) and no later than ``dep``, the
    connection that leaves at ``dep`` arrives first, and ``(arr, dep,
    train)`` is the least of all that still can be reached.

    Kept are the connections that no later one of the same two stations beats
    (the suffix minimum of ``(arr, dep, train)`` over departures is the
    connection itself).  Both steps work in (from, to, bucket) slices that
    small per-bucket summaries link, so two stations with most of the
    connections are not sorted in one task.  A row is repeated for each
    bucket its span touches, from that of ``first`` (the earliest ready
    time): a label then meets its rows by station and bucket.  With
    ``heads_once`` the first connections of two stations (no ``after``), one a
    pair, are not repeated but have no bucket: a label meets one for each
    neighbour by the station alone."""
    pair = ["from_station", "to_station"]
    width = bucket_minutes * 60_000_000

    def bucket(t):
        t = F.col(t) if isinstance(t, str) else t
        return F.floor(F.unix_micros(t.cast("timestamp")) / F.lit(width))

    one = conns.groupBy(*pair, F.col("departure_time").alias("dep")).agg(
        F.min(F.struct(F.col("arrival_time").alias("arr"),
                       F.col("departure_time").alias("dep"),
                       F.col("train_id").alias("train"))).alias("c")) \
        .withColumn("_b", bucket("dep"))
    inside = Window.partitionBy(*pair, "_b").orderBy(F.col("dep").desc()) \
        .rowsBetween(Window.unboundedPreceding, -1)
    behind = Window.partitionBy(*pair).orderBy(F.col("_b").desc()) \
        .rowsBetween(Window.unboundedPreceding, -1)
    later = one.groupBy(*pair, "_b").agg(F.min("c").alias("m")).select(
        *pair, "_b", F.min("m").over(behind).alias("later"))
    kept = one.withColumn("soon", F.min("c").over(inside)).join(
        later, [*pair, "_b"]).filter(
        (F.col("soon").isNull() | (F.col("c") < F.col("soon"))) &
        (F.col("later").isNull() | (F.col("c") < F.col("later")))).select(
        *pair, "dep", F.col("c.arr").alias("arr"),
        F.col("c.train").alias("train"))
    kept = cut_lineage(kept, "profile")
    nxt = next_in_sequence(kept, pair, ["dep"], ["arr", "train"],
                           bucket("dep"), written=True)
    spans = nxt.filter(F.col("next_dep").isNotNull()).select(
        *pair, F.col("dep").alias("after"), F.col("next_dep").alias("dep"),
        F.col("next_arr").alias("arr"), F.col("next_train").alias("train"))
    heads = kept.groupBy(*pair).agg(F.min(F.struct("dep", "arr", "train"))
                                    .alias("h")).select(
        *pair, F.lit(None).cast("timestamp_ntz").alias("after"), "h.*")
    low = F.greatest(bucket(first), F.coalesce(bucket("after"),
                                               bucket(first)))
    buckets = F.sequence(low, bucket("dep"))
    if heads_once:
        buckets = F.when(F.col("after").isNull(), F.array(
            F.lit(None).cast("bigint"))).otherwise(buckets)
    rows = spans.unionByName(heads).filter(F.col("dep") >= first).withColumn(
        "bucket", F.explode(buckets))
    return rows.select(F.col("from_station").alias("station"), "bucket",
                       "after", "dep", F.col("to_station").alias("to"), "arr",
                       "train")


def earliest_arrival(conns: DataFrame, requests: DataFrame,
                     itinerary: bool = True, bucket_minutes: int = 60
                     ) -> DataFrame:
    """Earliest arrival for ``requests(request_id, source, target,
    departure)`` over ``conns`` (no transfer time, any train change): one row
    per request, ``(request_id, source_station, target_station, departure,
    status, arrival, legs)`` where ``legs`` is the itinerary (array of
    structs from_station, departure_time, to_station, arrival_time,
    train_id).  Source = target gives the departure time and no legs; see
    :func:`_status` for requests without an answer.  Without ``itinerary``
    the legs column is left out (no back-tracking rounds).

    One search per distinct (source, departure).  A round sends each label
    whose arrival improved to its neighbours through the :func:`profile`, so
    it makes at most (labels x neighbours) rows however many connections a
    hub has, and appends the labels that improved.  Labels behind the latest
    of the search's targets are not sent on."""
    conns = cut_lineage(conns.select("from_station", "to_station",
                                     "departure_time", "arrival_time",
                                     "train_id"), "ea-conns")
    stations = cut_lineage(
        conns.select(F.col("from_station").alias("station")).unionByName(
            conns.select(F.col("to_station").alias("station"))).distinct(),
        "ea-stations")
    req = _resolved(stations, requests.withColumn(
        "departure", F.col("departure").cast("timestamp_ntz")),
        ["departure"])
    S = ["src", "dep0"]
    keyed = req.filter("source_station IS NOT NULL AND target_station IS NOT "
                       "NULL AND departure IS NOT NULL").select(
        "request_id", F.col("source_station").alias("src"),
        F.col("departure").alias("dep0"),
        F.col("target_station").alias("station"))
    goals = cut_lineage(keyed.select(*S, "station").distinct(), "ea-goals")
    label_t = "struct<arr:timestamp_ntz,dep:timestamp_ntz,from:string," \
              "train:bigint>"
    start, n_ahead = cut_and_count(goals.select(*S).distinct().select(
        *S, F.col("src").alias("station"), F.struct(
            F.col("dep0"), F.lit(None).cast("timestamp_ntz"),
            F.lit(None).cast("string"), F.lit(None).cast("bigint"))
        .cast(label_t).alias("lab"), F.lit(True).alias("ahead")),
        "ea-labels", "ahead")
    n_searches = n_ahead
    # appended tables of improved labels; the least of a station counts
    tables, last = [start], start

    def best() -> DataFrame:
        return _all(tables).groupBy(*S, "station").agg(
            F.min("lab").alias("lab"))

    if n_ahead:
        first = F.lit(goals.agg(F.min("dep0")).first()[0]) \
            .cast("timestamp_ntz")
        steps = cut_lineage(profile(conns, first, bucket_minutes, True),
                            "ea-profile")
        width = bucket_minutes * 60_000_000
    while n_ahead > 0:
        if len(tables) > COMPACT:
            tables = [cut_lineage(best().withColumn("ahead", F.lit(False)),
                                  "ea-labels")]
        known = best()
        # the latest of a search's targets; none while one is not reached
        bound = goals.join(known.hint("merge"), [*S, "station"],
                           "left").groupBy(*S).agg(
            F.when(F.count("lab") == F.count(F.lit(1)), F.max("lab.arr"))
            .alias("bound"))
        sent = last.filter("ahead").join(_dealt(bound, n_searches), S).filter(
            F.col("bound").isNull() |
            (F.col("lab.arr") <= F.col("bound"))).select(
            *S, "station", F.col("lab.arr").alias("ready"),
            F.floor(F.unix_micros(F.col("lab.arr").cast("timestamp"))
                    / F.lit(width)).alias("bucket"))
        near, n_sent = steps, n_ahead
        if n_ahead > FEW:
            # only what leaves from the labels' stations is dealt out with them
            sent, n_sent = cut_and_count(sent, "ea-sent", F.lit(True))
            at, n_at = cut_and_count(sent.select("station").distinct(),
                                     "ea-near", F.lit(True))
            if n_at <= FEW:
                near = steps.join(F.broadcast(at), "station", "left_semi")
        sent = _dealt(sent, n_sent)
        met = sent.join(near.filter("bucket IS NOT NULL"),
                        ["station", "bucket"]).drop("bucket")
        met = met.unionByName(sent.drop("bucket").join(
            near.filter("bucket IS NULL").drop("bucket"), "station"))
        new = met.filter(
            (F.col("ready") <= F.col("dep")) &
            (F.col("after").isNull() | (F.col("ready") > F.col("after")))) \
            .groupBy(*S, F.col("to").alias("station")).agg(F.min(F.struct(
                F.col("arr"), F.col("dep"), F.col("station").alias("from"),
                F.col("train"))).cast(label_t).alias("new"))
        old = new.join(known.hint("merge"), [*S, "station"], "left")
        last, n_ahead = cut_and_count(old.filter(
            F.col("lab").isNull() | (F.col("new") < F.col("lab"))).select(
            *S, "station", F.col("new").alias("lab"),
            (F.col("lab").isNull() | (F.col("new.arr") < F.col("lab.arr")))
            .alias("ahead")), "ea-labels", "ahead")
        tables.append(last)
    labels = cut_lineage(best(), "ea-labels")
    arrived = keyed.join(labels.hint("merge"), [*S, "station"]).select(
        "request_id", F.col("lab.arr").alias("arrival"))
    out = req.select("request_id", "source_station", "target_station",
                     "departure").join(arrived, "request_id", "left") \
        .withColumn("status", _status(F.col("arrival").isNotNull()))
    columns = ["request_id", "source_station", "target_station", "departure",
               "status", "arrival"]
    if not itinerary:
        return out.select(*columns)
    return out.join(_legs(keyed, goals, labels), "request_id", "left").select(
        *columns, F.when(F.col("arrival").isNotNull(), F.coalesce(
            "legs", F.array().cast(LEGS_T))).alias("legs"))


LEGS_T = ("array<struct<from_station:string,departure_time:timestamp_ntz,"
          "to_station:string,arrival_time:timestamp_ntz,train_id:bigint>>")


def _legs(keyed: DataFrame, goals: DataFrame, labels: DataFrame) -> DataFrame:
    """(request_id, legs): the labels' connections followed back from each
    target, once per distinct (source, departure, target)."""
    S = ["src", "dep0"]
    K = [*S, "target"]
    cur = goals.select(*S, F.col("station").alias("target"), "station",
                       F.lit(0).alias("step"))
    legs = []
    while True:
        step = cur.join(labels.hint("merge"), [*S, "station"]) \
            .filter(F.col("lab.from").isNotNull()) \
            .select(*K, "step", F.struct(
                F.col("lab.from").alias("from_station"),
                F.col("lab.dep").alias("departure_time"),
                F.col("station").alias("to_station"),
                F.col("lab.arr").alias("arrival_time"),
                F.col("lab.train").alias("train_id")).alias("leg"))
        step, n_steps = cut_and_count(step, "ea-legs", F.lit(True))
        legs.append(step)
        if n_steps == 0:
            break
        cur = step.select(*K, F.col("leg.from_station").alias("station"),
                          (F.col("step") + 1).alias("step"))
    # legs per target are bounded by the path length, not by data volume
    per_t = _all(legs).groupBy(*K).agg(
        F.sort_array(F.collect_list(F.struct(
            (-F.col("step")).alias("k"), "leg")), True).alias("l")) \
        .select(*S, F.col("target").alias("station"),
                F.transform("l", lambda x: x["leg"]).alias("legs"))
    return keyed.join(per_t, [*S, "station"]).select("request_id", "legs")


# ---------------------------------------------------------------------- G7
def itinerary_summary(result: DataFrame) -> DataFrame:
    """Arrival, duration (minutes), number of legs, distinct stations
    reached and a readable itinerary."""
    leg_txt = F.transform("legs", lambda l: F.concat(
        l["from_station"], F.lit(" ("),
        F.date_format(l["departure_time"], "HH:mm"), F.lit(")"),
        F.lit(ARROW), l["to_station"], F.lit(" ("),
        F.date_format(l["arrival_time"], "HH:mm"), F.lit(")")))
    return result.select(
        "request_id", "source_station", "target_station", "departure",
        "status", "arrival", minutes_between("departure", "arrival")
        .alias("duration_minutes"),
        F.size("legs").alias("segments"),
        F.size(F.array_distinct(F.transform(
            "legs", lambda l: l["to_station"]))).alias("stations"),
        F.array_join(leg_txt, "; ").alias("itinerary"))
