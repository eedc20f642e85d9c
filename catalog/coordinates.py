"""Coordinates, datums and footprints."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog.base import Tables, joined, query, sql_values
from fieldbook.functions import coords, footprint
from fieldbook.functions.datum import DATUMS
from fieldbook.operators import coordinates

#: Latitude -100..99 and longitude -200..199 of a key, in whole degrees; both engines.
LAT = "({k} * 37) % 200 - 100"
LNG = "({k} * 53) % 400 - 200"

_CHECKED = """
    , z AS (SELECT *, floor(lat0 * 1000000.0 + 0.5) / 1000000.0 AS la, floor(lng0 * 1000000.0 + 0.5) / 1000000.0 AS lo FROM c),
    v AS (SELECT *, la BETWEEN -90 AND 90 AND lo BETWEEN -180 AND 180 AS good,
             NOT la BETWEEN -90 AND 90 AND lo BETWEEN -90 AND 90 AND la BETWEEN -180 AND 180 AS swapped FROM z),
    w AS (SELECT *, good OR swapped AS ok, CASE WHEN good THEN la WHEN swapped THEN lo END AS lat, CASE WHEN good THEN lo WHEN swapped THEN la END AS lng,
      concat_ws('|', CASE WHEN NOT (good OR swapped) THEN 'COORDINATE_OUT_OF_RANGE' END, CASE WHEN la <> lat0 OR lo <> lng0 THEN 'COORDINATE_ROUNDED' END,
        CASE WHEN swapped THEN 'PRESUMED_SWAPPED_COORDINATE' END, CASE WHEN la = 0 AND lo = 0 THEN 'ZERO_COORDINATE' END) AS issues FROM v)
"""


@query(
    "decimal_coordinates",
    f"""
    WITH c AS (SELECT event_id, {LAT.format(k="event_id")} + CASE WHEN event_id % 5 = 0 THEN 0 ELSE value / 1000.0 END AS lat0,
                      {LNG.format(k="event_id")} + CASE WHEN event_id % 5 = 0 THEN 0.0 ELSE 0.12345675 END AS lng0 FROM events)
    {_CHECKED}
    SELECT event_id, lat, lng, ok, issues FROM w
    """,
)
def decimal_coordinates(t: Tables):
    lat = F.expr(LAT.format(k="event_id")) + F.when(F.col("event_id") % 5 == 0, 0.0).otherwise(F.col("value") / 1000.0)
    lng = F.expr(LNG.format(k="event_id")) + F.when(F.col("event_id") % 5 == 0, 0.0).otherwise(0.12345675)
    e = t.events.select("event_id", coords.parse_lat_lng(lat.cast("string"), lng.cast("string")).alias("c"))
    return e.select("event_id", "c.lat", "c.lng", "c.ok", joined(F.col("c.issues")).alias("issues"))


_DEG = "{k} % 90"
_MIN = "({k} * 7) % 60"
_SEC = "({k} * 11) % 60"


@query(
    "spelled_coordinates",
    f"""
    WITH p AS (SELECT o_orderkey, {_DEG.format(k="o_orderkey")} AS d, {_MIN.format(k="o_orderkey")} AS m, {_SEC.format(k="o_orderkey")} AS s, o_orderkey % 6 AS k FROM orders),
    a AS (SELECT o_orderkey, k, CASE WHEN k = 3 THEN -1 ELSE 1 END AS sy, CASE WHEN k IN (1, 3) THEN -1 ELSE 1 END AS sx,
             CASE WHEN k = 4 THEN d + m / 60.0 ELSE d + m / 60.0 + s / 3600.0 END AS y FROM p),
    b AS (SELECT o_orderkey, k, floor(sy * y * 1000000.0 + 0.5) / 1000000.0 AS la, floor(sx * (y + 10) * 1000000.0 + 0.5) / 1000000.0 AS lo FROM a)
    SELECT o_orderkey, CASE WHEN k <> 5 THEN la END AS lat, CASE WHEN k <> 5 THEN lo END AS lng, CASE WHEN k = 5 THEN 'COORDINATE_INVALID' ELSE '' END AS issues FROM b
    """,
)
def spelled_coordinates(t: Tables):
    def text(n: str) -> F.Column:
        return F.expr(n.format(k="o_orderkey")).cast("string")

    d, d2 = text(_DEG), (F.expr(_DEG.format(k="o_orderkey")) + 10).cast("string")
    m, s = text(_MIN), text(_SEC)
    k = F.col("o_orderkey") % 6
    c = F.concat

    def l(x: str):  # noqa: E741
        return F.lit(x)

    pair = (
        F.when(k == 0, c(d, l("°"), m, l("'"), s, l('"N '), d2, l("°"), m, l("'"), s, l('"E')))
        .when(k == 1, c(d2, l("° "), m, l("' "), s, l('" W '), d, l("° "), m, l("' "), s, l('" N')))
        .when(k == 2, c(d, l("d"), m, l("m"), s, l("s N,"), d2, l("d"), m, l("m"), s, l("s O")))
        .when(k == 3, c(l("S"), d, l("°"), m, l("'"), s, l('";W'), d2, l("°"), m, l("'"), s, l('"')))
        .when(k == 4, c(d, l("°"), m, l("'N/"), d2, l("°"), m, l("'E")))
        .otherwise(c(d, l(" "), m, l(" and nothing else")))
    )
    o = t.orders.select("o_orderkey", coords.parse_verbatim_pair(pair).alias("c"))
    return o.select("o_orderkey", "c.lat", "c.lng", joined(F.col("c.issues")).alias("issues"))


@query(
    "coordinate_sources",
    """
    SELECT c_custkey, cast(CASE c_custkey % 5 WHEN 0 THEN 10.5 WHEN 1 THEN 20.25 WHEN 2 THEN 30.5 WHEN 3 THEN 40.0 END + c_nationkey AS double) AS lat,
      CASE c_custkey % 5 WHEN 4 THEN NULL ELSE cast(c_nationkey - 5.0 AS double) END AS lng, c_custkey % 5 <> 4 AS ok, CASE c_custkey % 5 WHEN 4 THEN 'COORDINATE_INVALID' ELSE '' END AS issues
    FROM customer
    """,
)
def coordinate_sources(t: Tables):
    k, n = F.col("c_custkey") % 5, F.col("c_nationkey")
    lng = (n - 5.0).cast("string")

    def at(i: int, base: float):
        return F.when(k == i, (n + base).cast("string"))

    c = t.customer.select(
        "c_custkey",
        F.coalesce(at(0, 10.5), F.lit("unknown")).alias("a"),
        lng.alias("b"),
        at(1, 20.25).alias("c"),
        F.concat(at(2, 30.5), F.lit(","), lng).alias("d"),
        F.when(k == 3, F.concat(F.lit("POINT ("), lng, F.lit(" "), (n + 40.0).cast("string"), F.lit(")"))).otherwise("POLYGON((0 0))").alias("e"),
    ).select(
        "c_custkey",
        coords.pick_coordinates(
            coords.parse_lat_lng(F.col("a"), F.col("b")),
            coords.parse_lat_lng(F.col("c"), F.col("b")),
            coords.parse_verbatim_pair(F.col("d")),
            fallback=coords.parse_point(F.col("e")),
        ).alias("r"),
    )
    return c.select("c_custkey", "r.lat", "r.lng", "r.ok", joined(F.col("r.issues")).alias("issues"))


_DATUM_ROWS = [(alias, a, f, dx, dy, dz) for names, _, a, f, dx, dy, dz in DATUMS for alias in names.split()[:1]]
_DATUM_TEXT = "case {k} % 6 when 0 then 'NAD-27' when 1 then 'ed 50' when 2 then 'Tokyo' when 3 then 'wgs84' when 4 then 'UTM 33N' else '' end"


@query(
    "datum_shift",
    f"""
    WITH s AS (SELECT event_id, ({LAT.format(k="event_id")}) * 0.8 AS la, ({LNG.format(k="event_id")}) * 0.85 AS lo, {_DATUM_TEXT.format(k="event_id")} AS given FROM events),
    d AS (SELECT s.*, a, dx, dy, dz, alias, 1.0 / inv_f AS f FROM s LEFT JOIN {sql_values(_DATUM_ROWS, "alias, a, inv_f, dx, dy, dz").replace(" AS t(", " AS d(")} ON regexp_replace(upper(given), '[^A-Z0-9]+', '', 'g') = alias),
    e AS (SELECT *, radians(la) AS p, radians(lo) AS l, 2 * f - f * f AS e2, 6378137.0 - a AS da, 1.0 / 298.257223563 - f AS df FROM d),
    m AS (SELECT *, a * (1 - e2) / pow(1 - e2 * sin(p) * sin(p), 1.5) AS rm, a / sqrt(1 - e2 * sin(p) * sin(p)) AS rn FROM e),
    r AS (SELECT event_id, la, lo, given, alias,
       CASE WHEN alias IS NULL OR alias = 'WGS84' THEN la ELSE floor((la + degrees((-dx * sin(p) * cos(l) - dy * sin(p) * sin(l) + dz * cos(p) + (a * df + f * da) * sin(2 * p)) / rm)) * 1e7 + 0.5) / 1e7 END AS y,
       CASE WHEN alias IS NULL OR alias = 'WGS84' THEN lo ELSE floor((lo + degrees((-dx * sin(l) + dy * cos(l)) / (rn * cos(p)))) * 1e7 + 0.5) / 1e7 END AS x FROM m)
    SELECT event_id, round(y, 5) AS lat, round(x, 5) AS lng, alias IS NOT NULL OR given = '' AS ok,
      concat_ws('|', CASE WHEN y <> la OR x <> lo THEN 'COORDINATE_REPROJECTED' END, CASE WHEN alias IS NULL THEN 'GEODETIC_DATUM_ASSUMED_WGS84' END,
        CASE WHEN alias IS NULL AND given <> '' THEN 'GEODETIC_DATUM_INVALID' END) AS issues
    FROM r
    """,
)
def datum_shift(t: Tables):
    e = t.events.select(
        "event_id", (F.expr(LAT.format(k="event_id")) * 0.8).alias("la"), (F.expr(LNG.format(k="event_id")) * 0.85).alias("lo"),
        F.expr(_DATUM_TEXT.format(k="event_id")).alias("given"),
    )
    w = coordinates.to_wgs84(e, "la", "lo", "given", "w")
    return w.select(
        "event_id", F.round("w.lat", 5).alias("lat"), F.round("w.lng", 5).alias("lng"), "w.ok", joined(F.col("w.issues")).alias("issues")
    )


@query(
    "footprints",
    """
    SELECT s_suppkey, CASE s_suppkey % 9 WHEN 2 THEN 'POLYGON((0 0, 0 1, ' || s_nationkey || ' 1, 0 0))' WHEN 8 THEN 'GEOMETRYCOLLECTION(POINT(1 1), POLYGON((0 0, 0 1e0, ' || s_nationkey || ' 1, 0 0)))' END AS wkt,
      CASE s_suppkey % 9 WHEN 1 THEN 'FOOTPRINT_WKT_MISMATCH' WHEN 4 THEN 'FOOTPRINT_SRS_INVALID' WHEN 0 THEN '' WHEN 2 THEN '' WHEN 8 THEN '' ELSE 'FOOTPRINT_WKT_INVALID' END AS issues
    FROM supplier
    """,
)
def footprints(t: Tables):
    k, n = F.col("s_suppkey") % 9, F.col("s_nationkey").cast("string")
    wkt = (
        F.when(k == 0, F.concat(F.lit("POINT("), n, F.lit(" 7)")))
        .when(k == 1, F.concat(F.lit("POINT("), n, F.lit(" 8)")))
        .when(k == 2, F.concat(F.lit("POLYGON((0 0, 0 1, "), n, F.lit(" 1, 0 0))")))
        .when(k == 3, F.lit("POLYGON((0 0, 0 1"))
        .when(k == 5, F.concat(F.lit("POLYGON((0 0, 0 1, "), n, F.lit(" 1, 0 0.5))")))  # not closed
        .when(k == 6, F.concat(F.lit("MULTIPOLYGON(((0 0, 0 1, "), n, F.lit(" 1, 0 0)), ((2 2, 2 2)))")))  # two points
        .when(k == 7, F.concat(F.lit("MULTILINESTRING((0 0, "), n, F.lit(" 1), (3 3))")))
        .when(k == 8, F.concat(F.lit("GEOMETRYCOLLECTION(POINT(1 1), POLYGON((0 0, 0 1e0, "), n, F.lit(" 1, 0 0)))")))
        .otherwise("POINT(1 1)")
    )
    s = t.supplier.select("s_suppkey", wkt.alias("w"), F.when(k == 4, "EPSG:99").alias("srs"), F.col("s_nationkey").cast("double").alias("lng"))
    s = s.select(
        "s_suppkey",
        footprint.footprint(F.col("w"), coords.parse_point(F.col("w")), F.col("srs"), F.lit(False), F.lit(7.0), F.col("lng")).alias("f"),
    )
    return s.select("s_suppkey", F.col("f.value").alias("wkt"), joined(F.col("f.issues")).alias("issues"))
