"""Nearest region on the sphere, at any distance.

Borders are cut into short pieces, which lie in a tree of cubes around the globe: cubes know neither
poles nor a date line.  A point goes down the tree from the eight largest cubes, and of the cubes
at each level keeps those whose least possible distance is not beyond the greatest possible
distance of another.  Only pieces in the last of them are measured."""

from __future__ import annotations

from dataclasses import dataclass
from math import radians

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fieldbook.functions.geo import EARTH_RADIUS_M, valid_point
from fieldbook.functions.shapes import shape_edges, short_edges
from fieldbook.operators.checkpoints import materialize
from fieldbook.operators.geocode import with_rings
from fieldbook.operators.joins import dimension_join

#: Greatest length of a piece, in degrees of either kind.
PIECE_DEGREES = 0.5

#: Levels of the tree below the eight cubes; each cube has ``SPLIT`` ** 3 children.
LEVELS, SPLIT = 3, 4

_AXES = "xyz"


@dataclass
class SphereIndex:
    """Pieces of borders with the cube of the last level they lie in, and the cubes of every level
    with their parents and the box of what they hold."""

    pieces: DataFrame
    cubes: list[DataFrame]
    reach: float


def unit_vector(lng: Column, lat: Column) -> list[Column]:
    flat = F.cos(F.radians(lat))
    return [flat * F.cos(F.radians(lng)), flat * F.sin(F.radians(lng)), F.sin(F.radians(lat))]


def border_pieces(regions: DataFrame, degrees: float = PIECE_DEGREES) -> DataFrame:
    """``region_id, type, iso2`` and the ends ``ax ... bz`` of every piece.  Borders are straight in
    degrees between their points, as regions are given; a piece is an arc of a great circle."""
    edges = with_rings(regions).filter("rings is not null").select("region_id", "type", "iso2", F.explode(short_edges(shape_edges(F.col("rings")))).alias("e"))
    n = F.ceil(F.greatest(F.abs(F.col("e.x2") - F.col("e.x1")), F.abs(F.col("e.y2") - F.col("e.y1"))) / degrees)
    cut = edges.withColumn("n", n).filter("n > 0").withColumn("i", F.explode(F.sequence(F.lit(1).cast("long"), F.col("n"))))
    at = lambda a, b, i: F.col(f"e.{a}") + (F.col(f"e.{b}") - F.col(f"e.{a}")) * i / F.col("n")
    ends = {s: unit_vector(at("x1", "x2", i), at("y1", "y2", i)) for s, i in (("a", F.col("i") - 1), ("b", F.col("i")))}
    return cut.select("region_id", "type", "iso2", *[v.alias(f"{s}{axis}") for s, vs in ends.items() for axis, v in zip(_AXES, vs)])


def sphere_index(regions: DataFrame, degrees: float = PIECE_DEGREES, levels: int = LEVELS) -> SphereIndex:
    """Index the borders of regions; build it once per set of regions."""
    pieces = border_pieces(regions, degrees)
    middle = {axis: (F.col(f"a{axis}") + F.col(f"b{axis}")) / 2.0 for axis in _AXES}
    pieces = pieces.withColumns({f"m{axis}": m for axis, m in middle.items()})
    pieces = materialize(pieces.withColumns({f"c{axis}": F.floor(F.col(f"m{axis}") * SPLIT**levels) for axis in _AXES}))
    key = [f"c{axis}" for axis in _AXES]
    box = lambda lo, hi: [f(src.format(axis)).alias(out.format(axis)) for axis in _AXES for f, src, out in ((F.min, lo, "lo{}"), (F.max, hi, "hi{}"))]
    cubes, below = [], pieces.groupBy(*key).agg(*box("m{}", "m{}"))
    for level in range(levels, 0, -1):
        parent = {f"p{axis}": F.floor(F.col(f"c{axis}") / SPLIT) for axis in _AXES}
        if level == 1:  # the point (1, 0, 0) is in the first cube, too
            parent = {c: F.least(v, F.lit(0).cast("long")) for c, v in parent.items()}
        below = materialize(below.withColumns(parent))
        cubes.append(below)
        below = below.select(*[F.col(f"p{axis}").alias(f"c{axis}") for axis in _AXES], *[f"{s}{axis}" for s in ("lo", "hi") for axis in _AXES]).groupBy(*key).agg(*box("lo{}", "hi{}"))
    return SphereIndex(pieces.drop(*[f"m{axis}" for axis in _AXES]), cubes[::-1], radians(degrees))


def arc_distance(p: list[Column], a: list[Column], b: list[Column]) -> Column:
    """Angle between a point and an arc of less than half a circle, all as unit vectors."""

    def cross(u, v):
        return [u[1] * v[2] - u[2] * v[1], u[2] * v[0] - u[0] * v[2], u[0] * v[1] - u[1] * v[0]]

    def dot(u, v):
        return u[0] * v[0] + u[1] * v[1] + u[2] * v[2]

    def apart(u, v):
        d = [x - y for x, y in zip(u, v)]
        return F.asin(F.least(F.lit(1.0), F.sqrt(dot(d, d)) / 2.0)) * 2.0

    n = cross(a, b)
    size = F.sqrt(dot(n, n))
    between = (size > 0) & (dot(cross(n, a), p) >= 0) & (dot(cross(b, n), p) >= 0)
    across = F.asin(F.least(F.lit(1.0), F.abs(dot(n, p)) / F.when(size > 0, size)))
    return F.when(between, across).otherwise(F.least(apart(p, a), apart(p, b)))


def nearest_border(points: DataFrame, index: SphereIndex, limit_m: float | None = None) -> DataFrame:
    """``lat, lng, region_id, type, iso2, metres``: for every distinct valid point the region with
    the nearest border by great-circle distance (those that agree to a millimetre by the least id).
    Points whose nearest border is beyond ``limit_m`` are left out; without regions all are."""
    point = ["lat", "lng", *[f"v{axis}" for axis in _AXES]]
    todo = points.filter(valid_point(F.col("lat"), F.col("lng"))).select("lat", "lng").distinct()
    todo = todo.select("lat", "lng", *[v.alias(f"v{axis}") for axis, v in zip(_AXES, unit_vector(F.col("lng"), F.col("lat")))])
    eight = [F.struct(*[F.lit(int(q)).cast("long").alias(f"p{axis}") for axis, q in zip(_AXES, (-(k & 1), -(k >> 1 & 1), -(k >> 2)))]) for k in range(8)]
    found = todo.withColumn("_q", F.explode(F.array(*eight))).select(*point, "_q.*")
    parent = [f"p{axis}" for axis in _AXES]
    of_point = Window.partitionBy("lat", "lng")
    for cubes in index.cubes:
        found = dimension_join(found, cubes, parent, "inner")
        near = far = F.lit(0.0)
        for axis in _AXES:
            v, lo, hi = F.col(f"v{axis}"), F.col(f"lo{axis}"), F.col(f"hi{axis}")
            out = F.greatest(lo - v, v - hi, F.lit(0.0))
            away = F.greatest(F.abs(v - lo), F.abs(v - hi))
            near, far = near + out * out, far + away * away
        # What lies in a cube is the middle of a piece; the piece reaches a little further.
        found = found.withColumns({"_near": F.sqrt(near), "_far": F.min(F.sqrt(far)).over(of_point)}).filter(F.col("_near") - index.reach <= F.col("_far"))
        found = found.select(*point, *[F.col(f"c{axis}").alias(f"p{axis}") for axis in _AXES])
    pieces = index.pieces.withColumnsRenamed({f"c{axis}": f"p{axis}" for axis in _AXES})
    measured = dimension_join(found, pieces, parent, "inner")
    angle = arc_distance(*[[F.col(f"{s}{axis}") for axis in _AXES] for s in "vab"])
    measured = measured.select("lat", "lng", "region_id", "type", "iso2", (angle * EARTH_RADIUS_M).alias("metres"))
    best = measured.groupBy("lat", "lng").agg(F.min_by(F.struct("region_id", "type", "iso2", "metres"), F.struct(F.round("metres", 3), "region_id")).alias("_b"))
    best = best.select("lat", "lng", "_b.*")
    return best if limit_m is None else best.filter(F.col("metres") <= limit_m)


def nearest_on_sphere(points: DataFrame, inside: DataFrame, index: SphereIndex, limit_m: float | None = None) -> DataFrame:
    """The region each point is in (several: the least id) at 0 metres, else the one with the nearest
    border.  ``inside``: what :func:`fieldbook.operators.geocode.reverse_geocode` found for them."""
    within = inside.filter("distance = 0").groupBy("lat", "lng").agg(F.min(F.struct("region_id", "type", "iso2")).alias("_b")).select("lat", "lng", "_b.*", F.lit(0.0).alias("metres"))
    rest = points.filter(valid_point(F.col("lat"), F.col("lng"))).select("lat", "lng").distinct().join(within, ["lat", "lng"], "left_anti")
    return within.unionByName(nearest_border(rest, index, limit_m))
