"""Footprint geometries as text."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from fieldbook.functions.issues import collect_issues, flag
from fieldbook.functions.shapes import closed, point_lists
from fieldbook.functions.terms import has_value

TOLERANCE = 0.000001

_NUM = r"[-+]?(?:\d+\.?\d*|\.\d+)(?:[eE][-+]?\d+)?"
_POS = rf"\s*{_NUM}(?:\s+{_NUM}){{1,3}}\s*"
_TAG = r"\s*(?:Z|M|ZM)?\s*"
# A run of possessive repeats, so that long rings cannot make the matcher back-track.
_LINE = rf"\({_POS}(?:,{_POS})*+\)"
_POLY = rf"\(\s*{_LINE}(?:\s*,\s*{_LINE})*+\s*\)"
_SIMPLE = (
    rf"(?:POINT{_TAG}\({_POS}\)"
    rf"|(?:LINESTRING|LINEARRING){_TAG}{_LINE}"
    rf"|POLYGON{_TAG}{_POLY}"
    rf"|MULTIPOINT{_TAG}(?:{_LINE}|\(\s*\({_POS}\)(?:\s*,\s*\({_POS}\))*+\s*\))"
    rf"|MULTILINESTRING{_TAG}{_POLY}"
    rf"|MULTIPOLYGON{_TAG}\(\s*{_POLY}(?:\s*,\s*{_POLY})*+\s*\)"
    r"|(?:POINT|LINESTRING|POLYGON|MULTIPOINT|MULTILINESTRING|MULTIPOLYGON|GEOMETRYCOLLECTION)\s+EMPTY)"
)
_MEMBERS = rf"GEOMETRYCOLLECTION{_TAG}\(\s*{_SIMPLE}(?:\s*,\s*{_SIMPLE})*+\s*\)"
WKT = rf"(?i)^\s*(?:{_SIMPLE}|{_MEMBERS}|GEOMETRYCOLLECTION{_TAG}\(\s*(?:{_SIMPLE}|{_MEMBERS})(?:\s*,\s*(?:{_SIMPLE}|{_MEMBERS}))*+\s*\))\s*$"

# What follows the name of a kind of geometry, up to the next name.
_BODY = r"\s*(?:ZM?|M)?(?:[^A-Za-z]|(?<=[0-9.])[eE](?=[-+0-9]))*+"


def _all(c: Column, kind: str, rule: Callable[[Column], Column]) -> Column:
    """True where the rule holds for each list of points of the geometries of a kind."""
    return F.forall(F.flatten(F.transform(F.regexp_extract_all(c, F.lit(rf"(?i){kind}{_BODY}"), F.lit(0)), point_lists)), rule)


def valid_wkt(c: Column) -> Column:
    """True where the text is a geometry: it has the form of one, its rings end where they start
    and have at least four points, its lines at least two.  Collections may hold collections of
    simple geometries."""
    formed = c.rlike(WKT)
    whole = _all(c, "(?:POLYGON|LINEARRING)", closed) & _all(c, "LINESTRING", lambda line: F.size(line) >= 2)
    return F.when(c.isNotNull(), F.when(formed, whole).otherwise(False))


def footprint(wkt: Column, point: Column, srs: Column, srs_known: Column, lat: Column, lng: Column) -> Column:
    """Struct of the geometry to keep and the issue list.

    ``point`` is the footprint parsed as a POINT.  A point that repeats the coordinates is dropped,
    one that differs is a mismatch; other geometries are kept as they stand."""
    srs_bad = has_value(srs) & ~F.coalesce(srs_known, F.lit(False))
    given = has_value(wkt) & ~srs_bad
    same = (F.abs(lat - point["lat"]) <= TOLERANCE) & (F.abs(lng - point["lng"]) <= TOLERANCE)
    other = given & ~point["ok"]
    ok = F.coalesce(valid_wkt(wkt), F.lit(False))
    return F.struct(
        F.when(other & ok, wkt).alias("value"),
        collect_issues(
            flag(srs_bad, "FOOTPRINT_SRS_INVALID"),
            flag(given & point["ok"] & ~same, "FOOTPRINT_WKT_MISMATCH"),
            flag(other & ~ok, "FOOTPRINT_WKT_INVALID"),
        ).alias("issues"),
    )
