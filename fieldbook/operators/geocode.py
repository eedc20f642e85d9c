"""Reverse geocoding as a join on grid cells.

The regions are cut along a world grid once (:func:`region_cells`).  A cell that no border comes
near answers for all of its points; a border cell keeps just the edges of its own rows, for an
exact test.  Points meet cells in an equi-join, so nothing is compared all against all."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldbook.functions.geo import (
    COUNTRY_LAYERS,
    haversine_m,
    pixel_x,
    pixel_y,
    ring_distance,
    valid_point,
)
from fieldbook.functions.shapes import banded, inside_piece, keep_east, read_rings, shape_edges, short_edges, split_east, turned_edges
from fieldbook.operators.joins import dimension_join

#: Grid of one cell per degree.
WIDTH, HEIGHT = 361, 181

#: A cell with more edges is quartered, up to so many times, and so many at once.
DENSE, DEPTH, STEP = 64, 4, 2

MAX_CENTROID_M = 5000.0


def with_rings(regions: DataFrame) -> DataFrame:
    """``region_id, type, name, iso2, rings``: the shape comes from a column ``rings`` (array of
    rings), ``wkt`` (text of a polygon or several) or ``ring`` (a single one)."""
    if "rings" in regions.columns:
        shape = F.col("rings")
    elif "wkt" in regions.columns:
        shape = read_rings(F.col("wkt"))
    else:
        shape = F.array("ring")
    return regions.select("region_id", "type", "name", "iso2", shape.alias("rings"))


def region_cells(
    regions: DataFrame, width: int = WIDTH, height: int = HEIGHT, buffer: float = 0.0, dense: int = DENSE, depth: int = DEPTH
) -> DataFrame:
    """Cells of the grid that a region reaches: ``level, x, y``, the region, ``whole`` (every point
    of the cell is inside) and, for the other cells, the piece of the border in the cell (``odd,
    cuts, edges``, see :mod:`fieldbook.functions.shapes`).

    The world is quartered down to the grid (level 0), and cells with more than ``dense`` edges up
    to ``depth`` times more (rounded up to ``STEP``), as long as they are wider than the buffer.
    Every quarter cuts the edges it was given to its own size, so an edge is stored in the cells it
    runs through and in no others, and the work is the number of edges times that of levels.

    A shape may have several parts and holes, cross the date line (its longitudes may go on beyond
    180 degrees, or jump) and hold a pole: the one nearer to a ring that goes round.  ``buffer`` is the
    distance in degrees up to which a point next to a region still finds it.  Build the table once
    per set of regions, and write it where it is large."""
    pad = float(buffer) + 1e-6
    half_x, half_y = 180.0 / (width - 1), 90.0 / (height - 1)
    top = max(width - 1, height - 1).bit_length()
    border = {"w": -180.0 - half_x - pad, "e": 180.0 + half_x + pad, "s": -90.0 - half_y - pad, "n": 90.0 + half_y + pad}

    edges = turned_edges(short_edges(shape_edges(F.col("rings"))), border["w"], border["e"])
    df = with_rings(regions).filter("rings is not null").select("region_id", "type", "name", "iso2", edges.alias("edges"))
    df = df.withColumn("_p", split_east(F.col("edges"), F.lit(border["e"]), F.lit(border["n"])))
    df = df.withColumn("cuts", F.filter(F.transform("_p", lambda p: p["cut"]), lambda y: y.isNotNull()))
    northern = F.aggregate("edges", F.lit(0.0), lambda s, e: s + e["y1"] + e["y2"]) > 0
    df = df.select(
        "region_id", "type", "name", "iso2", F.lit(-top).alias("level"), F.lit(0).cast("long").alias("x"), F.lit(0).cast("long").alias("s"),
        ((F.size("cuts") % 2 == 1) & northern).alias("odd"), "cuts", keep_east(F.col("_p"), F.lit(border["w"])).alias("edges"),
    )

    def side(name: str, level: int, place: Column) -> Column:
        """A side of a cell with its margin, at most the border of the grid."""
        at = (place if name in "ws" else place + 1) / float(2.0**level) - 0.5
        degrees = at / (width - 1) * 360.0 - 180.0 if name in "we" else at / (height - 1) * 180.0 - 90.0
        return F.greatest(F.lit(border[name]), degrees - pad) if name in "ws" else F.least(F.lit(border[name]), degrees + pad)

    keep = ["region_id", "type", "name", "iso2"]
    deep = [d for d in range(0, depth, STEP) if half_x / 2.0 ** (d + STEP - 1) > buffer]
    for level in [*range(-top, 0, 3), *deep]:
        step = STEP if level >= 0 else min(3, -level)
        to, n = level + step, 2**step
        # Rows first: what lies north or south of a row is cut off once for all its cells.
        split = (F.col("level") == level) & (F.size("edges") > dense) if level >= 0 else F.lit(True)
        parts = F.when(split, F.sequence(F.lit(0), F.lit(n - 1))).otherwise(F.array(F.lit(-1)))
        df = df.withColumn("_qs", F.explode(parts))
        stay, s = F.col("_qs") < 0, F.col("s") * n + F.col("_qs")
        df = df.withColumn("_s", F.when(~stay, s)).filter(stay | (F.col("_s") < height * 2.0**to))
        south, north = side("s", to, F.col("_s")), side("n", to, F.col("_s"))
        reach = df.withColumn("_b", F.when(~stay, banded(F.col("edges"), south, north)))
        df = reach.filter("_qs < 0 or odd or size(_b) > 0 or size(cuts) > 0").withColumn("_qx", F.explode(F.when(stay, F.array(F.lit(-1))).otherwise(F.sequence(F.lit(0), F.lit(n - 1)))))
        if level == -top:
            # From here on the work grows with cells; the count is given, as small tables grow most.
            df = df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), "region_id", "_s", "_qx")
        x = F.col("x") * n + F.col("_qx")
        df = df.withColumns({"_x": F.when(~stay, x), "_same": side("e", level, F.col("x")) == side("e", to, x)}).filter(stay | (F.col("_x") < width * 2.0**to))
        w, e = side("w", to, F.col("_x")), side("e", to, F.col("_x"))
        df = df.withColumn("_p", F.when(~stay, split_east(F.col("_b"), e, north)))
        far = F.size(F.filter("cuts", lambda y: y >= north)) + F.aggregate("_p", F.lit(0), lambda k, p: k + p["north"])
        near = F.when(F.col("_same"), F.filter("cuts", lambda y: (y >= south) & (y < north))).otherwise(F.array().cast("array<double>"))
        cuts = F.concat(near, F.filter(F.transform("_p", lambda p: p["cut"]), lambda y: y.isNotNull()))
        made = {
            "level": F.lit(to), "x": F.col("_x"), "s": F.col("_s"), "odd": F.col("odd") != (far % 2 == 1), "cuts": cuts, "edges": keep_east(F.col("_p"), w),
        }
        if level >= 0:
            made = {c: F.when(stay, F.col(c)).otherwise(v) for c, v in made.items()}
        df = df.select(*keep, *[v.alias(c) for c, v in made.items()]).filter("odd or size(edges) > 0 or size(cuts) > 0")
    whole = (F.size("edges") == 0) & (F.size("cuts") == 0)
    rows = (F.lit(height) * F.pow(F.lit(2.0), F.col("level"))).cast("long")
    return df.select(
        F.col("level").cast("int").alias("level"), F.col("x").cast("int").alias("x"), (rows - 1 - F.col("s")).cast("int").alias("y"),
        "region_id", "type", "name", "iso2", whole.alias("whole"),
        *[F.when(~whole, F.col(c)).alias(c) for c in ("odd", "cuts", "edges")],
    )


def with_pixel(points: DataFrame, lat: str = "lat", lng: str = "lng", width: int = WIDTH, height: int = HEIGHT) -> DataFrame:
    return points.withColumns(
        {"x": pixel_x(F.col(lng), width).cast("int"), "y": pixel_y(F.col(lat), height).cast("int")}
    )


def with_cells(points: DataFrame, width: int = WIDTH, height: int = HEIGHT, depth: int = DEPTH) -> DataFrame:
    """Every point once per level, with the cell it lies in."""
    scale = F.pow(F.lit(2.0), F.col("level"))
    x = F.floor(((F.col("lng") + 180.0) / 360.0 * float(width - 1) + 0.5) * scale)
    s = F.floor(((F.col("lat") + 90.0) / 180.0 * float(height - 1) + 0.5) * scale)
    y = (F.lit(height) * scale).cast("long") - 1 - s
    return points.withColumn("level", F.explode(F.sequence(F.lit(0), F.lit(depth), F.lit(STEP)))).withColumns({"x": x.cast("int"), "y": y.cast("int")})


def reverse_geocode(
    points: DataFrame,
    cells: DataFrame,
    width: int = WIDTH,
    height: int = HEIGHT,
    buffer: float = 0.0,
    small: bool | None = None,
    depth: int = DEPTH,
) -> DataFrame:
    """One row per point and region found: ``lat, lng``, the region and its distance in degrees
    (0 inside and on the border).

    Width, height, buffer and depth have to be those the cells were built with.  Points are taken
    distinct, so a place that holds a third of all records counts once."""
    distinct = points.filter(valid_point(F.col("lat"), F.col("lng"))).select("lat", "lng").distinct()
    joined = dimension_join(
        with_cells(distinct, width, height, depth),
        cells,
        ["level", "x", "y"],
        "inner",
        small=small,
        weight=F.lit(1) + F.coalesce(F.size("edges"), F.lit(0)),
    )
    inside = F.col("whole") | inside_piece(F.col("odd"), F.col("cuts"), F.col("edges"), F.col("lng"), F.col("lat"))
    distance = F.when(inside, 0.0).otherwise(ring_distance(F.col("edges"), F.col("lng"), F.col("lat")))
    return (
        joined.select("lat", "lng", "region_id", "type", "name", "iso2", distance.alias("distance"))
        .filter(F.col("distance") <= float(buffer))
    )


def geocode_cells(points: DataFrame, cells: DataFrame, width: int = WIDTH, height: int = HEIGHT, small: bool | None = None):
    """Split distinct points by the grid alone: rows answered by cells without a border, and the
    points for the exact test (those in border cells and in empty cells)."""
    distinct = with_pixel(points.filter(valid_point(F.col("lat"), F.col("lng"))).select("lat", "lng").distinct(), width=width, height=height)
    up = lambda c: F.floor(F.col(c) / F.pow(F.lit(2.0), F.col("level"))).cast("int").alias(c)
    states = cells.select(up("x"), up("y"), (F.col("whole") & (F.col("level") == 0)).alias("whole")).groupBy("x", "y").agg(F.bool_and("whole").alias("_sure"))
    told = dimension_join(distinct, states, ["x", "y"], "left", small=small)
    rest = told.filter(~F.coalesce(F.col("_sure"), F.lit(False))).select("lat", "lng")
    sure = dimension_join(
        told.filter(F.col("_sure")).drop("_sure"), cells.filter("whole and level = 0").select("x", "y", "region_id", "type", "name", "iso2"), ["x", "y"], "inner",
        small=small,
    ).select("lat", "lng", "region_id", "type", "name", "iso2", F.lit(0.0).alias("distance"))
    return sure, rest


def geocode_two_step(points: DataFrame, cells: DataFrame, width: int = WIDTH, height: int = HEIGHT, buffer: float = 0.0, small: bool | None = None, depth: int = DEPTH) -> DataFrame:
    """:func:`geocode_cells`, with the exact test for the rest.  Same rows as
    :func:`reverse_geocode`."""
    sure, rest = geocode_cells(points, cells, width, height, small)
    return sure.unionByName(reverse_geocode(rest, cells, width, height, buffer, small, depth))


def nearest(df: DataFrame, key, distance: str, *then: str) -> DataFrame:
    """Of each key the row with the smallest distance (ties go by the further columns)."""
    rest = [c for c in df.columns if c not in key]
    order = F.struct(distance, *then)
    return df.groupBy(*key).agg(F.min_by(F.struct(*rest), order).alias("_n")).select(*key, "_n.*")


def geocode_lists(hits: DataFrame) -> DataFrame:
    """Per point, everything the location view asks of its regions, in one aggregation.

    A point lies in a handful of regions, so the lists are short.  ``countries`` and ``continents``
    run from the nearest; the admin levels take the first region that contains the point."""

    def by_distance(cond: Column, value: Column) -> Column:
        item = F.struct("distance", "region_id", value.alias("v"))
        return F.transform(F.sort_array(F.collect_list(F.when(cond, item))), lambda e: e["v"])

    def level(n: int) -> Column:
        cond = (F.col("type") == f"GADM{n}") & (F.col("distance") == 0.0)
        return F.min_by(
            F.struct(F.col("region_id").alias("gid"), F.col("name").alias("name")), F.when(cond, F.col("region_id"))
        )

    levels = {n: level(n) for n in range(4)}
    out = hits.groupBy("lat", "lng").agg(
        by_distance(F.col("type").isin(*COUNTRY_LAYERS), F.col("iso2")).alias("countries"),
        by_distance(F.col("type") == "Continent", F.col("region_id")).alias("continents"),
        *[levels[n].alias(f"_g{n}") for n in levels],
    )
    gadm = F.struct(
        *[F.col(f"_g{n}.gid").alias(f"level{n}Gid") for n in levels],
        *[F.col(f"_g{n}.name").alias(f"level{n}Name") for n in levels],
    )
    return out.select("lat", "lng", "countries", "continents", gadm.alias("gadm"))


def admin_areas(hits: DataFrame) -> DataFrame:
    """Per point, id and name of its administrative areas of levels 0 to 3."""
    return geocode_lists(hits).select("lat", "lng", "gadm.*")


def centroid_distance(points: DataFrame, centroids: DataFrame, small: bool | None = None, limit_m: float = MAX_CENTROID_M) -> DataFrame:
    """Distance in metres to the nearest centroid (``lat, lng`` columns), where it is within the
    limit.  One row per distinct point with a centroid in reach."""
    # Cells of a tenth of a degree of latitude; a centroid goes to all cells in reach.
    step = 0.1
    reach_lat = limit_m / 111000.0 + 1e-9
    cy = lambda c: F.floor((c + 90.0) / step).cast("int")
    cx = lambda c: F.floor((c + 180.0) / step).cast("int")
    columns = int(round(360 / step))
    near_pole = F.greatest(F.cos(F.radians(F.least(F.abs(F.col("clat")) + reach_lat, F.lit(90.0)))), F.lit(1e-6))
    reach_lng = F.least(F.lit(180.0), F.lit(reach_lat) / near_pole)
    lo, hi = cx(F.col("clng") - reach_lng), cx(F.col("clng") + reach_lng)
    cells = (
        centroids.select(F.col("lat").alias("clat"), F.col("lng").alias("clng"))
        .select(
            "clat", "clng",
            F.explode(F.sequence(cy(F.col("clat") - reach_lat), cy(F.col("clat") + reach_lat))).alias("y"),
            lo.alias("_lo"), F.least(hi, lo + (columns - 1)).alias("_hi"),
        )
        .select("clat", "clng", "y", F.explode(F.sequence("_lo", "_hi")).alias("_x"))
        .select("clat", "clng", "y", F.pmod("_x", F.lit(columns)).alias("x"))
    )
    distinct = points.filter(valid_point(F.col("lat"), F.col("lng"))).select("lat", "lng").distinct()
    placed = distinct.withColumns({"y": cy(F.col("lat")), "x": F.pmod(cx(F.col("lng")), F.lit(columns))})
    metres = haversine_m(F.col("lat"), F.col("lng"), F.col("clat"), F.col("clng"))
    return (
        dimension_join(placed, cells, ["x", "y"], "inner", small=small)
        .select("lat", "lng", metres.alias("m"))
        .filter(F.col("m") <= limit_m)
        .groupBy("lat", "lng")
        .agg(F.min("m").alias("distanceFromCentroidInMeters"))
    )
