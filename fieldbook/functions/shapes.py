"""Shapes of several rings on columns: reading them, and cutting them to rectangles.

A shape is the set of points that a ray crosses an odd number of edges from, so holes, several
parts and rings in any direction need no extra care.  A piece of a shape that was cut to a rectangle
keeps what such a ray needs to know of everything east of it: ``odd``, the parity of its north-east
corner, and ``cuts``, the latitudes at which its east side changes parity."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from fieldbook.functions.geo import inside_ring, ring_edges

EDGE = "struct<x1:double,y1:double,x2:double,y2:double>"
RINGS = "array<array<struct<lng:double,lat:double>>>"

_NUMBER = r"[-+]?(?:\d+\.?\d*|\.\d+)(?:[eE][-+]?\d+)?"
_POSITION = rf"\s*{_NUMBER}\s+{_NUMBER}(?:\s+{_NUMBER}){{0,2}}\s*"
_RING = rf"\({_POSITION}(?:,{_POSITION})*+\)"
_POLYGON = rf"\(\s*{_RING}(?:\s*,\s*{_RING})*+\s*\)"
_AREA = rf"(?i)^\s*(?:POLYGON\s*(?:Z|M|ZM)?\s*{_POLYGON}|MULTIPOLYGON\s*(?:Z|M|ZM)?\s*\(\s*{_POLYGON}(?:\s*,\s*{_POLYGON})*+\s*\))\s*$"


def point_lists(wkt: Column) -> Column:
    """The lists of points in a geometry's text, each as an array of (lng, lat)."""
    bodies = F.regexp_extract_all(wkt, F.lit(r"\(([^()]*)\)"), F.lit(1))

    def point(text: Column) -> Column:
        parts = F.split(F.trim(text), r"\s+")
        return F.struct(F.try_element_at(parts, F.lit(1)).try_cast("double").alias("lng"), F.try_element_at(parts, F.lit(2)).try_cast("double").alias("lat"))

    return F.transform(bodies, lambda body: F.transform(F.split(body, ","), point))


def closed(ring: Column) -> Column:
    """True for a ring of at least four points that ends where it starts."""
    first, last = F.get(ring, F.lit(0)), F.get(ring, F.size(ring) - 1)
    return (F.size(ring) >= 4) & (first["lng"] == last["lng"]) & (first["lat"] == last["lat"])


def read_rings(wkt: Column) -> Column:
    """The rings of a POLYGON or MULTIPOLYGON, null for any other text and where a ring is open or
    has fewer than four points."""
    rings = F.when(wkt.rlike(_AREA), point_lists(wkt)).cast(RINGS)
    return F.when(F.forall(rings, closed), rings)


def shape_edges(rings: Column) -> Column:
    """The edges of all rings."""
    return F.flatten(F.transform(rings, ring_edges)).cast(f"array<{EDGE}>")


def _edge(x1: Column, y1: Column, x2: Column, y2: Column) -> Column:
    return F.struct(x1.alias("x1"), y1.alias("y1"), x2.alias("x2"), y2.alias("y2"))


def short_edges(edges: Column) -> Column:
    """Edges longer than half a turn run the other way round, over the date line; those of a full
    turn stay (shapes around a pole follow it)."""

    def short(e: Column) -> Column:
        dx = e["x2"] - e["x1"]
        turn = (F.abs(dx) > 180.0) & (F.abs(dx) < 360.0)
        return _edge(e["x1"], e["y1"], F.when(turn, e["x2"] - F.signum(dx) * 360.0).otherwise(e["x2"]), e["y2"])

    return F.transform(edges, short)


def turned_edges(edges: Column, west: float, east: float) -> Column:
    """All copies of the edges, whole turns apart, that reach into the given longitudes."""

    def copies(e: Column) -> Column:
        own = F.floor(((e["x1"] + e["x2"]) / 2.0 + 180.0) / 360.0)
        moved = [_edge(e["x1"] + (F.lit(m) - own) * 360.0, e["y1"], e["x2"] + (F.lit(m) - own) * 360.0, e["y2"]) for m in (-1, 0, 1)]
        return F.filter(F.array(*moved), lambda c: (F.greatest(c["x1"], c["x2"]) >= west) & (F.least(c["x1"], c["x2"]) <= east))

    return F.flatten(F.transform(edges, copies))


def banded(edges: Column, south: Column, north: Column) -> Column:
    """The parts of the edges between two latitudes."""

    def cut(e: Column) -> Column:
        def end(x: Column, y: Column) -> tuple[Column, Column]:
            to = F.greatest(south, F.least(north, y))
            return F.when(to == y, x).otherwise(x + (to - y) * (e["x2"] - e["x1"]) / (e["y2"] - e["y1"])), to

        (xa, ya), (xb, yb) = end(e["x1"], e["y1"]), end(e["x2"], e["y2"])
        return _edge(xa, ya, xb, yb)

    reach = F.filter(edges, lambda e: (F.greatest(e["y1"], e["y2"]) >= south) & (F.least(e["y1"], e["y2"]) <= north))
    return F.transform(reach, cut)


def split_east(edges: Column, east: Column, north: Column) -> Column:
    """Of edges within a band: the part up to a longitude (``edge``, or null), the latitude where
    it ends there (``cut``), and how many ends of the rest lie on the band's north side."""

    def part(e: Column) -> Column:
        a, b = e["x1"] > east, e["x2"] > east
        at = e["y1"] + (east - e["x1"]) * (e["y2"] - e["y1"]) / (e["x2"] - e["x1"])
        at = F.greatest(F.least(e["y1"], e["y2"]), F.least(F.greatest(e["y1"], e["y2"]), at))
        cut = F.when(a != b, at)
        inner = _edge(F.when(a, east).otherwise(e["x1"]), F.when(a, at).otherwise(e["y1"]), F.when(b, east).otherwise(e["x2"]), F.when(b, at).otherwise(e["y2"]))
        beyond = lambda out, y: F.when(out & (y >= north), 1).otherwise(0)
        # Both ends alike: nothing to divide.
        return F.struct(
            F.when(a & b, None).when(a | b, inner).otherwise(e).alias("edge"), cut.alias("cut"), (beyond(a, e["y1"]) + beyond(b, e["y2"])).alias("north")
        )

    return F.transform(edges, part)


def keep_east(parts: Column, west: Column) -> Column:
    """The edges of :func:`split_east` from a longitude on, without those of no length."""

    def cut(e: Column) -> Column:
        a, b = e["x1"] < west, e["x2"] < west
        at = e["y1"] + (west - e["x1"]) * (e["y2"] - e["y1"]) / (e["x2"] - e["x1"])
        inner = _edge(F.when(a, west).otherwise(e["x1"]), F.when(a, at).otherwise(e["y1"]), F.when(b, west).otherwise(e["x2"]), F.when(b, at).otherwise(e["y2"]))
        return F.when(a != b, inner).otherwise(e)

    inner = F.filter(F.transform(parts, lambda p: p["edge"]), lambda e: e.isNotNull() & ((e["x1"] >= west) | (e["x2"] >= west)))
    return F.filter(F.transform(inner, cut), lambda e: (e["x1"] != e["x2"]) | (e["y1"] != e["y2"]))


def inside_piece(odd: Column, cuts: Column, edges: Column, lng: Column, lat: Column) -> Column:
    """True where a point of a piece's rectangle is inside the shape."""
    flips = F.size(F.filter(cuts, lambda y: y > lat)) % 2 == 1
    return (odd != flips) != inside_ring(edges, lng, lat)
