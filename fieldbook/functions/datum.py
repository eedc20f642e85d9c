"""Geodetic datums: aliases, shift parameters and the shift to WGS84 in closed form."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldbook.functions.binding import let
from fieldbook.functions.issues import collect_issues, flag
from fieldbook.functions.numbers import round_half_up

SUSPICIOUS_SHIFT = 0.1
DIGITS = 7

_WGS84_A = 6378137.0
_WGS84_INV_F = 298.257223563

# ---------------------------------------------------------------------------
# Datum aliases (upper case, letters and digits), EPSG code, semi-major axis,
# inverse flattening and mean shift to WGS84 in metres, from the public datum tables.
# ---------------------------------------------------------------------------
DATUMS = [
    ("WGS84 WORLDGEODETICSYSTEM1984 EPSG4326 4326", 4326, 6378137.0, 298.257223563, 0.0, 0.0, 0.0),
    ("WGS72 EPSG4322 4322", 4322, 6378135.0, 298.26, 0.0, 0.0, 4.5),
    ("NAD83 NORTHAMERICANDATUM1983 EPSG4269 4269", 4269, 6378137.0, 298.257222101, 0.0, 0.0, 0.0),
    ("NAD27 NORTHAMERICANDATUM1927 EPSG4267 4267", 4267, 6378206.4, 294.9786982, -8.0, 160.0, 176.0),
    ("ETRS89 EPSG4258 4258", 4258, 6378137.0, 298.257222101, 0.0, 0.0, 0.0),
    ("ED50 EUROPEAN1950 EPSG4230 4230", 4230, 6378388.0, 297.0, -87.0, -98.0, -121.0),
    ("OSGB36 OSGB1936 EPSG4277 4277", 4277, 6377563.396, 299.3249646, 375.0, -111.0, 431.0),
    ("TM65 IRELAND1965 EPSG4299 4299", 4299, 6377340.189, 299.3249646, 506.0, -122.0, 611.0),
    ("GDA94 EPSG4283 4283", 4283, 6378137.0, 298.257222101, 0.0, 0.0, 0.0),
    ("AGD66 AUSTRALIANGEODETIC1966 EPSG4202 4202", 4202, 6378160.0, 298.25, -133.0, -48.0, 148.0),
    ("AGD84 AUSTRALIANGEODETIC1984 EPSG4203 4203", 4203, 6378160.0, 298.25, -134.0, -48.0, 149.0),
    ("NZGD49 EPSG4272 4272", 4272, 6378388.0, 297.0, 84.0, -22.0, 209.0),
    ("TOKYO EPSG4301 4301", 4301, 6377397.155, 299.1528128, -148.0, 507.0, 685.0),
    ("SAD69 SOUTHAMERICAN1969 EPSG4618 4618", 4618, 6378160.0, 298.25, -57.0, 1.0, -41.0),
    ("PSAD56 EPSG4248 4248", 4248, 6378388.0, 297.0, -288.0, 175.0, -376.0),
    ("PULKOVO1942 EPSG4284 4284", 4284, 6378245.0, 298.3, 28.0, -130.0, -95.0),
    ("ARC1950 EPSG4209 4209", 4209, 6378249.145, 293.465, -143.0, -90.0, -294.0),
    ("CAPE EPSG4222 4222", 4222, 6378249.145, 293.465, -136.0, -108.0, -292.0),
]


def datum_table(spark: SparkSession) -> DataFrame:
    """One row per alias (a few dozen rows, fixed in code)."""
    rows = [
        f"('{alias}', {epsg}, {a}D, {inv_f}D, {dx}D, {dy}D, {dz}D)"
        for names, epsg, a, inv_f, dx, dy, dz in DATUMS
        for alias in names.split()
    ]
    return spark.sql(
        "SELECT * FROM VALUES " + ", ".join(rows) + " AS t(alias, epsg, a, inv_f, dx, dy, dz)"
    )


def normalise_datum(c: Column) -> Column:
    """Form in which datum names are compared."""
    return F.regexp_replace(F.upper(c), r"[^A-Z0-9]+", "")


def molodensky(lat: Column, lng: Column, a: Column, inv_f: Column, dx: Column, dy: Column, dz: Column):
    """Abridged shift of a geographic point to WGS84: new latitude and longitude."""
    f = F.lit(1.0) / inv_f
    da = F.lit(_WGS84_A) - a
    df = F.lit(1.0 / _WGS84_INV_F) - f
    phi, lam = F.radians(lat), F.radians(lng)
    e2 = f * 2.0 - f * f
    w = F.lit(1.0) - e2 * F.sin(phi) * F.sin(phi)
    m = a * (F.lit(1.0) - e2) / F.pow(w, F.lit(1.5))
    n = a / F.sqrt(w)
    d_phi = (
        -dx * F.sin(phi) * F.cos(lam)
        - dy * F.sin(phi) * F.sin(lam)
        + dz * F.cos(phi)
        + (a * df + f * da) * F.sin(phi * 2.0)
    ) / m
    d_lam = F.try_divide(-dx * F.sin(lam) + dy * F.cos(lam), n * F.cos(phi))
    return lat + F.degrees(d_phi), lng + F.degrees(d_lam)


def shift_to_wgs84(lat: Column, lng: Column, given: Column, datum: Column) -> Column:
    """Struct of lat, lng, issues and ok.  ``datum`` is the matching row of the datum table (null
    where there is none) and ``given`` the text it was looked up with.  The original point is kept
    where the datum is unknown or the shift too large."""
    blank = F.coalesce(given == "", F.lit(True))
    unknown = ~blank & datum.isNull()
    same = (
        (datum["a"] == _WGS84_A) & (datum["dx"] == 0) & (datum["dy"] == 0) & (datum["dz"] == 0)
        & (F.abs(datum["inv_f"] - _WGS84_INV_F) < 1e-3)
    )
    la, lo = molodensky(lat, lng, *[datum[k] for k in ("a", "inv_f", "dx", "dy", "dz")])
    keep = F.coalesce(same, F.lit(True))
    moved = F.struct(
        F.when(keep, lat).otherwise(round_half_up(la, DIGITS)).alias("lat"),
        F.when(keep, lng).otherwise(round_half_up(lo, DIGITS)).alias("lng"),
    )

    def judge(m: Column) -> Column:
        far = (F.abs(m["lat"] - lat) > SUSPICIOUS_SHIFT) | (F.abs(m["lng"] - lng) > SUSPICIOUS_SHIFT)
        return F.struct(
            F.when(far, lat).otherwise(m["lat"]).alias("lat"),
            F.when(far, lng).otherwise(m["lng"]).alias("lng"),
            collect_issues(
                flag(far, "COORDINATE_REPROJECTION_SUSPICIOUS"),
                flag(~far & ((m["lat"] != lat) | (m["lng"] != lng)), "COORDINATE_REPROJECTED"),
                flag(blank | unknown, "GEODETIC_DATUM_ASSUMED_WGS84"),
                flag(unknown, "GEODETIC_DATUM_INVALID"),
            ).alias("issues"),
            (blank | (~unknown & ~far)).alias("ok"),
        )

    return let(moved, judge)
