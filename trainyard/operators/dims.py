"""Dimension builders: station, station aliases, time, train.

Surrogate keys are derived from natural keys (no global row numbering, which
would need a single partition): ``station_key`` is the EVA number itself
(unique by definition), ``train_key`` is ``xxhash64`` of the five train
parts, ``time_key`` is ``yyyyMMddHHmm``.  :mod:`trainyard.operators.checks`
verifies uniqueness.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trainyard.functions.text import ALIAS_PREFIX, norm_name
from trainyard.functions.times import calendar_columns, time_key
from trainyard.schemas import DIM_TRAIN_PARTS

UNKNOWN_TRAIN = ("UNK", "UNK", "", "", "")


def main_eva(evas) -> F.Column:
    """First EVA entry flagged ``isMain`` (true, not just present), else
    the first entry."""
    flagged = F.filter(evas, lambda e: F.coalesce(e["isMain"], F.lit(False)))
    return F.coalesce(F.get(flagged, 0), F.get(evas, 0))


def station_records(entries: DataFrame) -> DataFrame:
    """Entries with at least one EVA number -> (eva, name, lat, lon,
    entry_order).  Coordinates only when exactly two values, (lon, lat)."""
    e = entries.filter(F.size("evaNumbers") > 0) \
        .withColumn("main", main_eva(F.col("evaNumbers")))
    coords = F.col("main.geographicCoordinates.coordinates")
    two = F.size(coords) == 2
    return e.select(
        F.col("main.number").cast("long").alias("eva"),
        F.col("name"),
        F.when(two, F.get(coords, 1)).alias("lat"),
        F.when(two, F.get(coords, 0)).alias("lon"),
        "entry_order",
    )


def build_dim_station(entries: DataFrame) -> DataFrame:
    """Upsert on EVA in entry order: the last entry wins name and
    coordinates.  One partial aggregation, so a hot EVA is combined
    map-side."""
    rec = station_records(entries)
    last = rec.groupBy("eva").agg(
        F.max_by(F.struct("name", "lat", "lon"), "entry_order").alias("v"))
    return last.select(
        F.col("eva").alias("station_key"), "eva",
        F.col("v.name").alias("station_name"),
        F.col("v.lat").alias("lat"), F.col("v.lon").alias("lon"))


def merge_dim_station(old: DataFrame, new: DataFrame) -> DataFrame:
    """Later loads overwrite name and coordinates of known EVAs."""
    both = old.withColumn("_load", F.lit(0)).unionByName(
        new.withColumn("_load", F.lit(1)))
    last = both.groupBy("eva").agg(
        F.max_by(F.struct("station_name", "lat", "lon"), "_load").alias("v"))
    return last.select(F.col("eva").alias("station_key"), "eva",
                       "v.station_name", "v.lat", "v.lon")


def changed_stations(old: DataFrame, new: DataFrame) -> DataFrame | None:
    """The merged stations, or None where the new ones change nothing."""
    cols = ["eva", "station_name", "lat", "lon"]
    if new.select(*cols).exceptAll(old.select(*cols)).isEmpty():
        return None
    return merge_dim_station(old, new)


def build_station_aliases(entries: DataFrame) -> DataFrame:
    """Normalised-name -> EVA map.  Each entry contributes its normalised
    name, plus the name without a leading ``berlin `` or with it added;
    later entries overwrite earlier ones, aliases can overwrite real
    names."""
    rec = station_records(entries).withColumn("n", norm_name("name"))
    plen = len(ALIAS_PREFIX)
    aliases = F.filter(F.array(
        F.struct(F.col("n").alias("alias"), F.lit(0).alias("ord")),
        F.struct(F.when(F.col("n").startswith(ALIAS_PREFIX),
                        F.substring("n", plen + 1, 1 << 30)).alias("alias"),
                 F.lit(1).alias("ord")),
        F.struct(F.when(~F.col("n").startswith(ALIAS_PREFIX.strip()),
                        F.concat(F.lit(ALIAS_PREFIX), "n")).alias("alias"),
                 F.lit(2).alias("ord")),
    ), lambda a: a["alias"].isNotNull())
    ex = rec.select("eva", "entry_order", F.explode(aliases).alias("a"))
    return ex.groupBy(F.col("a.alias").alias("alias")).agg(
        F.max_by("eva", F.struct("entry_order", "a.ord")).alias("eva"))


def build_dim_time(times: DataFrame, ts_col: str = "ts") -> DataFrame:
    """Distinct observed minutes -> time dimension rows."""
    ts = times.select(F.col(ts_col).cast("timestamp_ntz").alias("ts")) \
        .filter(F.col("ts").isNotNull()).distinct()
    return ts.select(time_key("ts").alias("time_key"), "ts",
                     *calendar_columns(F.col("ts")))


def new_times(old: DataFrame, new: DataFrame) -> DataFrame:
    """The minutes that ``old`` has not."""
    return new.join(old.select("time_key"), "time_key", "left_anti") \
        .select(*old.columns)


def train_parts(tl) -> F.Column:
    """Five-part train key from a ``tl`` struct: missing category/number ->
    'UNK', missing owner/type/flags -> ''."""
    def dflt(f, d):
        return F.coalesce(F.nullif(tl[f], F.lit("")), F.lit(d))
    return F.struct(dflt("_c", "UNK").alias("category"),
                    dflt("_n", "UNK").alias("train_number"),
                    dflt("_o", "").alias("owner"),
                    dflt("_t", "").alias("trip_type"),
                    dflt("_f", "").alias("filter_flags"))


def unknown_train() -> F.Column:
    return F.struct(*[F.lit(v).alias(n)
                      for n, v in zip(DIM_TRAIN_PARTS, UNKNOWN_TRAIN)])


def train_key(parts) -> F.Column:
    return F.xxhash64(*[parts[p] for p in DIM_TRAIN_PARTS])


def build_dim_train(trains: DataFrame, parts_col: str = "train",
                    key=train_key) -> DataFrame:
    """Distinct train keys plus the one unknown-train member."""
    spark = trains.sparkSession
    unk = spark.range(1).select(unknown_train().alias(parts_col))
    t = trains.select(parts_col).unionByName(unk).distinct()
    return t.select(key(F.col(parts_col)).alias("train_key"),
                    *[F.col(f"{parts_col}.{p}").alias(p)
                      for p in DIM_TRAIN_PARTS])


def new_trains(old: DataFrame | None, new: DataFrame) -> DataFrame:
    """The trains (told apart by their five parts) that ``old`` has not."""
    if old is None:
        return new
    return new.join(old.select(*DIM_TRAIN_PARTS), DIM_TRAIN_PARTS,
                    "left_anti").select(*old.columns)


def taken_keys(old: DataFrame | None, new: DataFrame) -> DataFrame:
    """Parts of the ``new`` trains whose key another train has: a stored one,
    else the unknown train, else the one with the smallest parts."""
    parts = F.struct(*DIM_TRAIN_PARTS)
    order = F.struct((parts != unknown_train()).alias("known"), *
                     DIM_TRAIN_PARTS)
    every = new.select("train_key", F.lit(1).alias("load"),
                       order.alias("train"))
    if old is not None:
        every = every.unionByName(old.join(
            new.select("train_key").distinct(), "train_key",
            "left_semi").select("train_key", F.lit(0).alias("load"),
                                order.alias("train")))
    first = every.groupBy("train_key").agg(
        F.min(F.struct("load", "train")).alias("f"),
        F.count(F.lit(1)).alias("n")).filter("n > 1")
    return new.join(first, "train_key").filter(
        (F.col("f.load") == 0) | (F.col("f.train") != order)) \
        .select(*DIM_TRAIN_PARTS)
