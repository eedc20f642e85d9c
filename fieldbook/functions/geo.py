"""Plane and sphere geometry on columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


EARTH_RADIUS_M = 6371000.0

#: Layers that tell a country.
COUNTRY_LAYERS = ("Political", "EEZ", "PoliticalEEZ")
ANTARCTICA_LATITUDE = -60.0


def valid_point(lat: Column, lng: Column) -> Column:
    return F.coalesce(lat.between(-90.0, 90.0) & lng.between(-180.0, 180.0), F.lit(False))


def haversine_m(lat1: Column, lng1: Column, lat2: Column, lng2: Column) -> Column:
    """Great-circle distance in metres."""
    s1 = F.sin(F.radians(lat2 - lat1) / 2.0)
    s2 = F.sin(F.radians(lng2 - lng1) / 2.0)
    h = s1 * s1 + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * s2 * s2
    return F.asin(F.sqrt(F.least(h, F.lit(1.0)))) * (2.0 * EARTH_RADIUS_M)


def pixel_x(lng: Column, width: int) -> Column:
    """Column of the world grid: ``width`` columns from -180 to 180 degrees."""
    return F.floor((lng + 180.0) / 360.0 * float(width - 1) + 0.5)


def pixel_y(lat: Column, height: int) -> Column:
    """Row of the world grid, counted from the north."""
    return F.lit(height - 1) - F.floor((lat + 90.0) / 180.0 * float(height - 1) + 0.5)


def pixel_lng(x: Column, width: int, edge: float) -> Column:
    """Longitude of a grid column; ``edge`` -0.5 / 0 / 0.5 gives its west edge, centre, east edge."""
    return (x + edge) / float(width - 1) * 360.0 - 180.0


def pixel_lat(y: Column, height: int, edge: float) -> Column:
    """Latitude of a grid row; ``edge`` -0.5 / 0 / 0.5 gives its south edge, centre, north edge."""
    return (F.lit(height - 1) - y + edge) / float(height - 1) * 180.0 - 90.0


def ring_edges(ring: Column) -> Column:
    """The edges of a ring of (lng, lat) vertices; a closing vertex may be there or not."""
    n = F.size(ring)
    following = F.concat(F.slice(ring, F.lit(2), n - 1), F.slice(ring, 1, 1))
    pairs = F.zip_with(
        ring,
        following,
        lambda p, q: F.struct(
            p["lng"].alias("x1"), p["lat"].alias("y1"), q["lng"].alias("x2"), q["lat"].alias("y2")
        ),
    )
    return F.filter(pairs, lambda e: (e["x1"] != e["x2"]) | (e["y1"] != e["y2"]))


def inside_ring(edges: Column, lng: Column, lat: Column) -> Column:
    """Even-odd test: does a ray to the east cross an odd number of edges?"""
    crossings = F.aggregate(
        edges,
        F.lit(0),
        lambda acc, e: acc
        + F.when(
            ((e["y1"] > lat) != (e["y2"] > lat))
            & (lng < (e["x2"] - e["x1"]) * (lat - e["y1"]) / (e["y2"] - e["y1"]) + e["x1"]),
            1,
        ).otherwise(0),
    )
    return crossings % 2 == 1


def ring_distance(edges: Column, lng: Column, lat: Column) -> Column:
    """Distance in degrees from a point to the nearest edge."""

    def to_edge(e: Column) -> Column:
        dx, dy = e["x2"] - e["x1"], e["y2"] - e["y1"]
        t = ((lng - e["x1"]) * dx + (lat - e["y1"]) * dy) / (dx * dx + dy * dy)
        t = F.greatest(F.lit(0.0), F.least(F.lit(1.0), t))
        ex, ey = e["x1"] + t * dx - lng, e["y1"] + t * dy - lat
        return F.sqrt(ex * ex + ey * ey)

    return F.aggregate(
        edges, F.lit(float("inf")), lambda acc, e: F.least(acc, to_edge(e))
    )


def is_antarctica(lat: Column, country: Column) -> Column:
    """South of sixty degrees, unless some other country was given."""
    return F.coalesce(
        (country.isNull() | (country == "AQ")) & (lat >= -90.0) & (lat < ANTARCTICA_LATITUDE),
        F.lit(False),
    )


