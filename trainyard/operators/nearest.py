"""Nearest station to each of a batch of points, exactly, without pairing
every point with every station.

Distance is the squared difference in raw degrees (no projection).  The
stations are cut into the cells of a quadtree that follows their density: a
cell is split until it holds few stations, however uneven they lie, and every
cell knows the box its stations really fill.  All points descend the tree
together, some levels a round: a point keeps the cells whose box is no farther
than the nearest box's far corner, so it never looks at more than a few cells
of a few stations each.  Both bounds are computed as the distance itself is, so
rounding loses no station.  Ties are broken by station name.

A round is one equi-join on the cell; its result is written into the shared
folder.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from trainyard.functions.delay import sq_distance
from trainyard.operators.common import cut_and_count, cut_lineage

DEPTH = 24      # finest cells: 2**24 by 2**24
STRIDE = 3      # tree levels a round
CELL = 16       # stations a cell may hold without being split


def _spread(x: Column) -> Column:
    """The bits of a whole number below 2**32, a zero in front of each."""
    for shift, mask in ((16, 0x0000FFFF0000FFFF), (8, 0x00FF00FF00FF00FF),
                        (4, 0x0F0F0F0F0F0F0F0F), (2, 0x3333333333333333),
                        (1, 0x5555555555555555)):
        x = x.bitwiseOR(F.shiftleft(x, shift)).bitwiseAND(F.lit(mask))
    return x


def _cell(lat: str, lon: str, box, depth: int = DEPTH) -> Column:
    """Number of the finest cell of a place in the square ``box`` (lowest
    lat, lowest lon, side): the cells that contain it are its prefixes."""
    def part(col, low):
        at = F.floor((F.col(col) - F.lit(low)) / F.lit(box[2])
                     * (1 << depth))
        return F.greatest(F.lit(0), F.least(at, F.lit((1 << depth) - 1))) \
            .cast("long")
    return _spread(part(lat, box[0])).bitwiseOR(
        F.shiftleft(_spread(part(lon, box[1])), 1))


def station_tree(stations: DataFrame, cell: int = CELL
                 ) -> tuple[DataFrame, DataFrame]:
    """``stations(s_lat, s_lon, ...)``, distinct places, written -> (cells,
    stations with their leaf).  Cells: depth, cell, up (the cell STRIDE levels
    above), n, leaf and the box lat0, lat1, lon0, lon1; cells inside a leaf
    are left out."""
    lo_lat, hi_lat, lo_lon, hi_lon = stations.agg(
        F.min("s_lat"), F.max("s_lat"), F.min("s_lon"), F.max("s_lon")).first()
    side = max(hi_lat - lo_lat, hi_lon - lo_lon, 1e-9)
    finest = stations.withColumn("z", _cell("s_lat", "s_lon",
                                            (lo_lat, lo_lon, side)))
    depths = list(range(0, DEPTH + 1, STRIDE))

    def at(depth: Column) -> Column:
        return F.call_function("shiftright", F.col("z"),
                               (2 * (DEPTH - depth)).cast("int"))

    cells = finest.withColumn("depth", F.explode(F.array(
        *map(F.lit, depths)))).groupBy(
        "depth", at(F.col("depth")).alias("cell")).agg(
        F.count(F.lit(1)).alias("n"), F.min("s_lat").alias("lat0"),
        F.max("s_lat").alias("lat1"), F.min("s_lon").alias("lon0"),
        F.max("s_lon").alias("lon1")).withColumn(
        "up", F.shiftright("cell", 2 * STRIDE)).withColumn(
        "leaf", (F.col("n") <= cell) | (F.col("depth") == DEPTH))
    cells = cut_lineage(cells, "nn-all-cells")
    split = cells.filter(~F.col("leaf")).select(
        (F.col("depth") + STRIDE).alias("depth"), F.col("cell").alias("up"))
    tree = cut_lineage(cells.filter("depth = 0").unionByName(
        cells.join(split, ["depth", "up"]).select(*cells.columns)),
        "nn-cells")
    leaves = tree.filter("leaf").select("depth", "cell")
    placed = finest.withColumn("depth", F.explode(F.array(
        *map(F.lit, depths)))).withColumn("cell", at(F.col("depth"))).join(
        leaves, ["depth", "cell"]).drop("z")
    return tree, cut_lineage(placed, "nn-placed")


def _bounds() -> tuple[Column, Column]:
    """Squared distance from a point to a cell's box, and to its far corner;
    by the same differences and sums as the distance to a station."""
    near_lat = F.greatest(F.lit(0.0), F.col("lat0") - F.col("lat"),
                          F.col("lat") - F.col("lat1"))
    near_lon = F.greatest(F.lit(0.0), F.col("lon0") - F.col("lon"),
                          F.col("lon") - F.col("lon1"))
    far_lat = F.greatest(F.col("lat1") - F.col("lat"),
                         F.col("lat") - F.col("lat0"))
    far_lon = F.greatest(F.col("lon1") - F.col("lon"),
                         F.col("lon") - F.col("lon0"))
    return (sq_distance(near_lat, near_lon, F.lit(0.0), F.lit(0.0)),
            sq_distance(far_lat, far_lon, F.lit(0.0), F.lit(0.0)))


def open_cells(tree: DataFrame, places: DataFrame) -> DataFrame:
    """The leaves that may hold the nearest station of each of the written
    ``places(place, lat, lon)``: (place, lat, lon, depth, cell)."""
    near, far = _bounds()
    root = tree.filter("depth = 0")
    at = [*places.columns, "depth", "cell", "leaf", "near", "far"]
    # the root is one row
    ahead, n_open = cut_and_count(
        places.crossJoin(F.broadcast(root)).withColumn("near", near)
        .withColumn("far", far).select(*at), "nn-cells", "NOT leaf")
    while n_open > 0:
        inside = ahead.filter("NOT leaf").select(
            *places.columns, (F.col("depth") + STRIDE).alias("depth"),
            F.col("cell").alias("up")).join(tree, ["depth", "up"]) \
            .withColumn("near", near).withColumn("far", far).select(*at)
        both = ahead.filter("leaf").unionByName(inside).withColumn(
            "least", F.min("far").over(Window.partitionBy("place")))
        ahead, n_open = cut_and_count(
            both.filter(F.col("near") <= F.col("least")).drop("least"),
            "nn-cells", "NOT leaf")
    return ahead.select(*places.columns, "depth", "cell")


def nearest_station(dim_station: DataFrame, points: DataFrame,
                    cell: int = CELL) -> DataFrame:
    """``points(request_id, lat, lon)`` -> ``(request_id, station_name,
    d2)``.  Stations without coordinates are ignored; points without
    coordinates or when no station has any give no row."""
    # Stations at the same coordinates tie on distance, and ties go to the
    # smallest name: keep only that one per coordinate (partial aggregate).
    st = dim_station.filter(F.col("lat").isNotNull() &
                            F.col("lon").isNotNull()) \
        .groupBy(F.col("lat").alias("s_lat"), F.col("lon").alias("s_lon")) \
        .agg(F.min("station_name").alias("station_name"))
    st = cut_lineage(st, "nn-stations")
    pts = points.filter(F.col("lat").isNotNull() & F.col("lon").isNotNull()) \
        .select("request_id", "lat", "lon")
    if st.isEmpty():
        return pts.select("request_id", F.lit(None).cast("string")
                          .alias("station_name"), F.lit(None).cast("double")
                          .alias("d2")).limit(0)
    # points at one place are asked once
    places = cut_lineage(pts.select("lat", "lon").distinct().withColumn(
        "place", F.monotonically_increasing_id()), "nn-places")
    tree, placed = station_tree(st, cell)
    best = open_cells(tree, places).join(placed, ["depth", "cell"]).groupBy(
        "place", "lat", "lon").agg(F.min(F.struct(
            sq_distance("s_lat", "s_lon", "lat", "lon").alias("d2"),
            F.col("station_name"))).alias("b"))
    return pts.join(best, ["lat", "lon"]).select(
        "request_id", F.col("b.station_name").alias("station_name"),
        F.col("b.d2").alias("d2"))
