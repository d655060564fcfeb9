"""Movement fact: station resolution, event rows and the upsert.

Every stop element yields up to two event rows (``ar`` -> A, ``dp`` -> D).
Plan rows and change rows share one layout (:data:`EVENT_ROW_COLUMNS`) and
are merged per natural key ``(snapshot_time_key, station_key, stop_id,
event_type)`` by a single aggregation that reproduces the row-by-row upsert
(plans first, then changes; each phase in folder/file/document order):

* planned time / planned platform: last non-NULL plan value, else the
  first non-NULL change value (an earlier value is never replaced by a
  change);
* line / planned path: last non-NULL value of either phase;
* changed time, status, changed platform, delay: last non-NULL change value;
* train: last plan train or last change train that is not the unknown
  train; the unknown train only if nothing else exists;
* cancelled: sticky (OR over all rows).

A tree of documents is parsed once, into a written table of stops
(:func:`bronze_stops`, one row per stop, one per document without stops) that
everything else is derived from.

The rows are sorted by key and order, in runs that may spill, and the aggregates
take the first or last value that counts, one row after the other, so a key of
any number of rows fits in memory.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trainyard.functions.delay import cancelled_event, signed_delay
from trainyard.functions.text import norm_name, station_from_file
from trainyard.functions.times import (parse_stamp, parse_stamp_strict,
                                       stamp_key, time_key)
from trainyard.operators.dims import train_key, train_parts, unknown_train

NATURAL_KEY = ["snapshot_time_key", "station_key", "stop_id", "event_type"]
EVENT_ROW_COLUMNS = [
    "phase", "seq", *NATURAL_KEY, "train", "planned_time_key",
    "changed_time_key", "event_status", "planned_platform",
    "changed_platform", "line", "planned_path", "delay_minutes",
    "is_cancelled",
]
# What the event log keeps of a row: also the file it came from.
LOG_COLUMNS = [*EVENT_ROW_COLUMNS, "folder", "file"]
# Type of the order key ``seq`` of event rows.
ORDER_T = "struct<phase:int,first:bigint,second:bigint,third:bigint>"


# ---------------------------------------------------------------- resolution
def resolve_plan_docs(docs: DataFrame, aliases: DataFrame,
                      dim_station: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Plan documents -> station via name (root attribute or file name),
    normalised, through the alias map, then EVA -> station key.  Returns
    (resolved docs with ``station_key``, skipped docs)."""
    named = docs.withColumn(
        "alias", norm_name(station_from_file(F.col("_station"),
                                             F.col("file_name"))))
    dim = dim_station.select("eva", "station_key")
    j = named.join(aliases, "alias", "left").join(dim, "eva", "left")
    ok = j.filter(F.col("station_key").isNotNull()).drop("alias", "eva")
    skipped = j.filter(F.col("station_key").isNull()).select(
        "file_path", "snapshot", F.lit("unknown station").alias("reason"))
    return ok, skipped


def change_eva() -> F.Column:
    """The EVA number of a change document's root; NULL unless all digits."""
    return F.when(F.col("_eva").rlike(r"^[0-9]+$"),
                  F.col("_eva").try_cast("long"))


def resolve_change_docs(docs: DataFrame, dim_station: DataFrame
                        ) -> tuple[DataFrame, DataFrame]:
    """Change documents -> station via the root ``eva`` attribute."""
    dim = dim_station.select("eva", "station_key")
    j = docs.withColumn("eva", change_eva()).join(dim, "eva", "left")
    ok = j.filter(F.col("station_key").isNotNull()).drop("eva")
    skipped = j.filter(F.col("station_key").isNull()).select(
        "file_path", "snapshot", F.lit("unknown station").alias("reason"))
    return ok, skipped


# ---------------------------------------------------------------- event rows
def bronze_stops(docs: DataFrame, phase: int, dim_station: DataFrame,
                 aliases: DataFrame | None = None) -> DataFrame:
    """Documents of one phase (0 plan, 1 change) inside snapshot folders ->
    one row per stop: phase, file_path, snapshot, folder, file, bad,
    station_key (NULL: unknown station), stop_pos, stop.  A document without
    stops, and one that did not parse, is one row with NULL stop.  Written,
    this is the only thing that reads the XML."""
    docs = docs.filter(F.col("snapshot") != "")
    dim = dim_station.select("eva", "station_key")
    if phase == 0:
        name = norm_name(station_from_file(F.col("_station"),
                                           F.col("file_name")))
        known = docs.withColumn("alias", name).join(aliases, "alias", "left")
    else:
        known = docs.withColumn("eva", change_eva())
    known = known.join(dim, "eva", "left")
    bad = F.col("_bad").isNotNull()
    parts = F.col("path_order")
    return known.select(
        F.lit(phase).alias("phase"), "file_path", "snapshot",
        F.array_join(F.slice(parts, 1, F.size(parts) - 1), "/")
        .alias("folder"), F.element_at(parts, -1).alias("file"),
        bad.alias("bad"), F.when(~bad, F.col("station_key"))
        .alias("station_key"),
        F.posexplode_outer(F.when(~bad, F.col("s")))
        .alias("stop_pos", "stop"))


def bronze_rejects(bronze: DataFrame) -> DataFrame:
    """Documents that are no good: (file_path, snapshot, reason), one row
    each."""
    first = bronze.filter(F.coalesce("stop_pos", F.lit(0)) == 0)
    return first.filter(F.col("bad") | F.col("station_key").isNull()).select(
        "file_path", "snapshot", F.when(F.col("bad"), "malformed xml")
        .otherwise("unknown station").alias("reason"))


def resolved_stops(bronze: DataFrame, phase: int) -> DataFrame:
    return bronze.filter((F.col("phase") == phase) &
                         F.col("station_key").isNotNull() &
                         F.col("stop").isNotNull())


def unpivot_events(stops: DataFrame, stop_col: str = "stop") -> DataFrame:
    """One pass, up to two rows per stop: ``event_type`` A/D, ``ev_idx``
    0/1 and the event struct ``ev``; absent sides are skipped."""
    s = F.col(stop_col)
    both = F.array(
        F.struct(F.lit("A").alias("event_type"), F.lit(0).alias("ev_idx"),
                 s["ar"].alias("ev")),
        F.struct(F.lit("D").alias("event_type"), F.lit(1).alias("ev_idx"),
                 s["dp"].alias("ev")))
    present = F.filter(both, lambda x: x["ev"].isNotNull())
    return stops.select("*", F.explode(present).alias("e")).select(
        *[c for c in stops.columns], F.col("e.event_type"),
        F.col("e.ev_idx"), F.col("e.ev"))


def order_key(phase: int, first, second, third) -> F.Column:
    """Upsert order key: phase (plans before changes), then three numbers
    compared one by one, each with the whole range of a ``long``."""
    return F.struct(F.lit(phase), first, second, third).cast(ORDER_T)


def _doc_order(phase: int):
    # the stop's position in the document, A before D; the file's visiting
    # order comes before them (see with_file_rank)
    return order_key(phase, F.col("stop_pos"), F.col("ev_idx"), F.lit(0))


def with_file_rank(rows: DataFrame) -> DataFrame:
    """Add ``folder_rank`` and ``file_rank``: values that sort as a sorted
    directory walk visits the rows' files (folder components compared one by
    one, then the file name).  A separator below every character makes the
    folder's text sort as its components do, so nothing is numbered and no row
    is shuffled for its rank.  Rows without a file are left out."""
    return rows.filter("folder IS NOT NULL AND file IS NOT NULL").withColumns({
        "folder_rank": F.replace("folder", F.lit("/"), F.lit("\x00")),
        "file_rank": F.col("file")})


def plan_event_rows(stops: DataFrame) -> DataFrame:
    """Resolved plan stops (``snapshot``, ``station_key``, ``stop``,
    ``stop_pos``, ``folder``, ``file``) -> event rows.  A present ``pt`` that does
    not parse gives a NULL planned time (see :func:`plan_time_rejects`)."""
    ev = unpivot_events(stops)
    planned = parse_stamp_strict(F.col("ev._pt"))
    return ev.select(
        F.lit(0).alias("phase"), _doc_order(0).alias("seq"),
        stamp_key(F.col("snapshot")).alias("snapshot_time_key"),
        "station_key", F.col("stop._id").alias("stop_id"), "event_type",
        train_parts(F.col("stop.tl")).alias("train"),
        time_key(planned).alias("planned_time_key"),
        F.lit(None).cast("long").alias("changed_time_key"),
        F.lit(None).cast("string").alias("event_status"),
        F.col("ev._pp").alias("planned_platform"),
        F.lit(None).cast("string").alias("changed_platform"),
        F.col("ev._l").alias("line"),
        F.col("ev._ppth").alias("planned_path"),
        F.lit(None).cast("int").alias("delay_minutes"),
        F.lit(False).alias("is_cancelled"), "folder", "file",
    )


def plan_time_rejects(stops: DataFrame) -> DataFrame:
    ev = unpivot_events(stops)
    bad = F.col("ev._pt").isNotNull() & (F.col("ev._pt") != "") & \
        parse_stamp_strict(F.col("ev._pt")).isNull()
    return ev.filter(bad).select("file_path", "snapshot",
                                 F.col("stop._id").alias("stop_id"),
                                 "event_type", F.col("ev._pt").alias("value"))


def change_event_rows(stops: DataFrame) -> DataFrame:
    """Resolved change stops -> event rows.  Times are lenient (anything
    but ten digits forming a real date is NULL); a change without ``tl``
    carries the unknown train."""
    ev = unpivot_events(stops)
    pt = parse_stamp(F.col("ev._pt"))
    ct = parse_stamp(F.col("ev._ct"))
    train = F.when(F.col("stop.tl").isNull(), unknown_train()) \
        .otherwise(train_parts(F.col("stop.tl")))
    return ev.select(
        F.lit(1).alias("phase"), _doc_order(1).alias("seq"),
        stamp_key(F.col("snapshot")).alias("snapshot_time_key"),
        "station_key", F.col("stop._id").alias("stop_id"), "event_type",
        train.alias("train"),
        time_key(pt).alias("planned_time_key"),
        time_key(ct).alias("changed_time_key"),
        F.col("ev._cs").alias("event_status"),
        F.col("ev._pp").alias("planned_platform"),
        F.col("ev._cp").alias("changed_platform"),
        F.col("ev._l").alias("line"),
        F.col("ev._ppth").alias("planned_path"),
        signed_delay(F.col("ev._dc"), pt, ct).alias("delay_minutes"),
        cancelled_event(F.col("ev._cs")).alias("is_cancelled"),
        "folder", "file",
    )


def stop_trains(stops: DataFrame) -> DataFrame:
    """Distinct trains (``train``) of resolved plan or change stops, also of
    stops without any event; a stop without ``tl`` has the unknown train."""
    train = F.when(F.col("stop.tl").isNull(), unknown_train()) \
        .otherwise(train_parts(F.col("stop.tl")))
    return stops.select(train.alias("train")).distinct()


# -------------------------------------------------------------------- upsert
def movement_key() -> F.Column:
    """128 bits of the natural key, as 32 hex digits: wide enough for any
    number of movements."""
    halves = [F.lpad(F.hex(F.xxhash64(F.lit(i), *NATURAL_KEY)), 16, "0")
              for i in (0, 1)]
    return F.lower(F.concat(*halves))


def upsert_fact(rows: DataFrame, key=train_key) -> DataFrame:
    """Fold event rows into one fact row per natural key (see module doc).
    ``seq`` orders the rows (any orderable type whose leading part is the
    phase; the readers produce :func:`order_key`); rows of several files
    carry their ranks too (:func:`with_file_rank`)."""
    order = ["seq"]                        # phase is its leading part
    if "file_rank" in rows.columns:
        order = ["phase", "folder_rank", "file_rank", "seq"]
    is_plan = F.col("phase") == 0
    is_change = F.col("phase") == 1
    unk = unknown_train()
    real_train = is_plan | (F.col("train") != unk)

    def last(name, cond=F.lit(True)):
        return F.last(F.when(cond, F.col(name)), ignorenulls=True)

    def first(name, cond):
        return F.first(F.when(cond, F.col(name)), ignorenulls=True)

    # a key has few rows, and what an aggregate keeps of one is many times the
    # row: the rows are shuffled, not those.  They are sorted once, the key
    # first, so the aggregation finds them in order and takes them as they come
    agg = rows.repartition(*NATURAL_KEY) \
        .sortWithinPartitions(*NATURAL_KEY, *order) \
        .groupBy(*NATURAL_KEY).agg(
        F.coalesce(last("planned_time_key", is_plan),
                   first("planned_time_key", is_change))
        .alias("planned_time_key"),
        F.coalesce(last("planned_platform", is_plan),
                   first("planned_platform", is_change))
        .alias("planned_platform"),
        last("line").alias("line"), last("planned_path").alias("planned_path"),
        last("changed_time_key").alias("changed_time_key"),
        last("event_status").alias("event_status"),
        last("changed_platform").alias("changed_platform"),
        last("delay_minutes").alias("delay_minutes"),
        F.coalesce(last("train", real_train), unk).alias("train"),
        F.bool_or("is_cancelled").alias("is_cancelled"),
    )
    return agg.select(
        movement_key().alias("movement_key"),
        "station_key", key(F.col("train")).alias("train_key"),
        "snapshot_time_key", "stop_id", "event_type", "planned_time_key",
        "changed_time_key", "event_status", "planned_platform",
        "changed_platform", "line", "planned_path", "delay_minutes",
        "is_cancelled", "train")


def observed_times(rows: DataFrame, docs: DataFrame | None = None
                   ) -> DataFrame:
    """Every snapshot, planned and changed minute seen in the rows (one
    pass: the three keys are unpivoted, then de-duplicated), and the
    snapshot stamps of ``docs``, also where no row of them was accepted."""
    keys = F.array("snapshot_time_key", "planned_time_key",
                   "changed_time_key")
    k = rows.select(F.explode(keys).alias("k"))
    if docs is not None:
        k = k.unionByName(docs.select(stamp_key(F.col("snapshot"))
                                      .alias("k")).distinct())
    # the time is made from what the aggregate gives, not from its key: the
    # planner moves what hangs on the key alone in front of it, to all rows
    one = k.filter(F.col("k").isNotNull()).groupBy("k").agg(
        F.min("k").alias("minute"))
    return one.select(
        F.to_timestamp_ntz(F.col("minute").cast("string"),
                           F.lit("yyyyMMddHHmm")).alias("ts"))


def load_statistics(docs: DataFrame, rejects: DataFrame,
                    rows: DataFrame) -> DataFrame:
    """One-row load report: snapshots, files, event rows, documents of unknown
    stations, malformed documents and files without any document, from one
    aggregation over the three inputs tagged and unioned."""
    null_s = F.lit(None).cast("string")
    u = (docs.select(F.lit("doc").alias("kind"), "snapshot", "file_path",
                     null_s.alias("reason"))
         .unionByName(rejects.select(F.lit("reject").alias("kind"),
                                     "snapshot", "file_path", "reason"))
         .unionByName(rows.select(F.lit("row").alias("kind"),
                                  null_s.alias("snapshot"),
                                  null_s.alias("file_path"),
                                  null_s.alias("reason"))))
    kind = F.col("kind")
    return u.agg(
        F.count_distinct(F.when(kind == "doc", F.col("snapshot")))
        .alias("snapshots"),
        F.count_distinct(F.when(kind == "doc", F.col("file_path")))
        .alias("xml_files"),
        F.count(F.when(kind == "row", 1)).alias("event_rows"),
        F.count(F.when(F.col("reason") == "unknown station", 1))
        .alias("skipped_station"),
        F.count(F.when(F.col("reason") == "malformed xml", 1))
        .alias("bad_xml"),
        F.count(F.when(F.col("reason") == "no timetable", 1))
        .alias("no_document"))
