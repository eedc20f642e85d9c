"""Regions, countries and continents."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog.base import Tables, joined, query, vocabulary
from fieldbook.functions.terms import trimmed
from fieldbook.operators import continent, country, geocode, lookup, nearest
from fieldbook.operators.checkpoints import materialize
from fieldbook.operators.joins import dimension_join, spread_null_join
from fieldbook.sources import dims

#: Countries of the fixture: the 25 nations, under codes that the pair list knows where it can.
CODES = (
    "AU CX CC DK GL FI AX FR GP GF GB IE IM CN HK MO US PR VI NO SJ NZ CK IL PS"
).split()
_CODE = "element_at(array(" + ", ".join(f"'{c}'" for c in CODES) + "), n_nationkey + 1)"
_CODE_SQL = "(['" + "', '".join(CODES) + "'])[n_nationkey + 1]"

#: Places of the fixture: points on a grid of twelfths of degrees, some of them on borders.
_LAT = "cast((event_id * 37) % 2160 as double) / 12 - 90"
_LNG = "cast((event_id * 53) % 4320 as double) / 12 - 180"

_BUFFER = 0.5

#: Boxes of 72 x 36 degrees tile the globe, one per nation.
_BOX = "-180.0 + 72.0 * (n_nationkey % 5) AS w, -108.0 + 72.0 * (n_nationkey % 5) AS e, -90.0 + 36.0 * floor(n_nationkey / 5) AS s, -54.0 + 36.0 * floor(n_nationkey / 5) AS n"


def nations(t: Tables):
    return t.nation.selectExpr("n_nationkey", "n_regionkey", "n_name", f"{_CODE} AS code")


def regions(t: Tables):
    """Four layers: countries, one sea zone, two admin levels and continents (columns of boxes)."""
    v = "struct(cast({x} as double) AS lng, cast({y} as double) AS lat)"
    ring = "array(" + ", ".join(v.format(x=x, y=y) for x, y in (("w", "s"), ("e", "s"), ("e", "n"), ("w", "n"))) + ") AS ring"
    boxes = nations(t).selectExpr("n_nationkey", "n_regionkey", "n_name", "code", *_BOX_COLS)
    political = boxes.selectExpr("code AS region_id", "'Political' AS type", "n_name AS name", "code AS iso2", ring)
    gadm = boxes.selectExpr("concat(code, '_1') AS region_id", "'GADM0' AS type", "n_name AS name", "code AS iso2", ring)
    west = boxes.selectExpr("n_nationkey", "n_name", "code", "w", "w + 36.0 AS e", "s", "n")
    gadm1 = west.selectExpr("concat(code, '.1_1') AS region_id", "'GADM1' AS type", "concat(n_name, ' West') AS name", "code AS iso2", ring)
    lands = boxes.join(t.region.withColumnRenamed("r_regionkey", "n_regionkey"), "n_regionkey").filter("n_nationkey >= 5")
    conts = lands.selectExpr("CASE WHEN r_name IN ('MIDDLE EAST') THEN 'EUROPE' WHEN r_name = 'AMERICA' THEN 'NORTH_AMERICA' ELSE r_name END AS region_id", "'Continent' AS type", "r_name AS name", "cast(null as string) AS iso2", ring)
    return political.unionByName(gadm).unionByName(gadm1).unionByName(conts)


_BOX_COLS = [c.strip() for c in _BOX.split(", ")]

_CONT_SQL = "CASE r_name WHEN 'MIDDLE EAST' THEN 'EUROPE' WHEN 'AMERICA' THEN 'NORTH_AMERICA' ELSE r_name END"

_REGIONS_SQL = f"""
    box AS (SELECT n_nationkey, n_regionkey, n_name, {_CODE_SQL} AS code, {_BOX} FROM nation),
    reg AS (SELECT code AS region_id, 'Political' AS type, n_name AS name, code AS iso2, w, e, s, n FROM box
            UNION ALL SELECT code || '_1', 'GADM0', n_name, code, w, e, s, n FROM box
            UNION ALL SELECT code || '.1_1', 'GADM1', n_name || ' West', code, w, w + 36.0, s, n FROM box
            UNION ALL SELECT {_CONT_SQL}, 'Continent', r_name, NULL, w, e, s, n FROM box JOIN region ON n_regionkey = r_regionkey WHERE n_nationkey >= 5)
"""

#: Degrees between a longitude and a box, either way round.
_DX = "least(greatest(w - {x}, 0, {x} - e), greatest(w - {x} - 360, 0, {x} + 360 - e), greatest(w - {x} + 360, 0, {x} - 360 - e))"

_HITS_SQL = f"""
    {_REGIONS_SQL},
    pt AS (SELECT DISTINCT {_LAT} AS lat, {_LNG} AS lng FROM events),
    hit AS (SELECT lat, lng, region_id, type, name, iso2,
              sqrt(pow({_DX.format(x="lng")}, 2) + pow(greatest(s - lat, 0, lat - n), 2)) AS distance FROM pt, reg
            WHERE {_DX.format(x="lng")} <= {_BUFFER} AND greatest(s - lat, 0, lat - n) <= {_BUFFER}),
    near AS (SELECT * FROM hit WHERE distance <= {_BUFFER})
"""


def cells(t: Tables):
    """The regions cut along the grid, stored once for all the joins of a query."""
    return materialize(geocode.region_cells(regions(t), buffer=_BUFFER))


def points(t: Tables):
    return t.events.selectExpr("event_id", f"{_LAT} AS lat", f"{_LNG} AS lng")


@query("reverse_geocode", f"WITH {_HITS_SQL} SELECT lat, lng, region_id, type, name, iso2, round(distance, 9) AS distance FROM near")
def reverse_geocode(t: Tables):
    found = geocode.reverse_geocode(points(t), cells(t), buffer=_BUFFER)
    return found.withColumn("distance", F.round("distance", 9))


#: Shapes within the boxes: an L, a ring with a hole, two parts, and two over the date line, one with
#: longitudes beyond 180 degrees and one that jumps.  Offsets from the box's corner, or longitudes.
_SHAPES = [
    ["6 3, 60 3, 60 12, 20 12, 20 30, 6 30, 6 3"],
    ["6 3, 60 3, 60 30, 6 30, 6 3", "20 10, 40 10, 40 20, 20 20, 20 10"],
    ["6 3, 20 3, 20 30, 6 30, 6 3", "30 5, 30 25, 60 25, 60 5, 30 5"],
    ["=150 3, =200 3, =200 30, =150 30, =150 3"],
    ["=170 3, =-170 3, =-170 30, =170 30, =170 3"],
]


def shapes(t: Tables):
    """One shape per nation as text."""

    def number(text: str, corner: str) -> str:
        return f"'{text[1:]}'" if text.startswith("=") else f"cast({corner} + {text} as string)"

    def ring(points: str) -> str:
        ends = ", ".join(f"concat({number(x, 'w')}, ' ', {number(y, 's')})" for x, y in (p.split() for p in points.split(", ")))
        return f"concat('(', concat_ws(', ', {ends}), ')')"

    def polygon(k: int, rings: list[str]) -> str:
        joint = "'), ('" if k == 2 else "', '"
        name, end = ("MULTIPOLYGON ((", "))") if k == 2 else ("POLYGON (", ")")
        return f"WHEN {k} THEN concat('{name}', concat_ws({joint}, {', '.join(ring(r) for r in rings)}), '{end}')"

    text = "CASE n_nationkey % 5 " + " ".join(polygon(k, r) for k, r in enumerate(_SHAPES)) + " END AS wkt"
    return nations(t).selectExpr("n_nationkey", "n_name", "code", *_BOX_COLS).selectExpr("code AS region_id", "'Shape' AS type", "n_name AS name", "code AS iso2", text)


#: The same shapes as rectangles and holes.
_RECTANGLES = f"""
    box AS (SELECT n_nationkey, {_CODE_SQL} AS code, {_BOX} FROM nation),
    rect AS (
      SELECT code, 0 AS hole, w + 6 AS w, w + 60 AS e, s + 3 AS s, s + 12 AS n FROM box WHERE n_nationkey % 5 = 0 UNION ALL SELECT code, 0, w + 6, w + 20, s + 3, s + 30 FROM box WHERE n_nationkey % 5 IN (0, 2)
      UNION ALL SELECT code, 0, w + 6, w + 60, s + 3, s + 30 FROM box WHERE n_nationkey % 5 = 1 UNION ALL SELECT code, 1, w + 20, w + 40, s + 10, s + 20 FROM box WHERE n_nationkey % 5 = 1
      UNION ALL SELECT code, 0, w + 30, w + 60, s + 5, s + 25 FROM box WHERE n_nationkey % 5 = 2
      UNION ALL SELECT code, 0, 150, 200, s + 3, s + 30 FROM box WHERE n_nationkey % 5 = 3 UNION ALL SELECT code, 0, 170, 190, s + 3, s + 30 FROM box WHERE n_nationkey % 5 = 4)
"""


@query(
    "region_shapes",
    f"""
    WITH {_RECTANGLES},
    pt AS (SELECT DISTINCT {_LAT} AS lat, {_LNG} AS lng FROM events),
    d AS (SELECT lat, lng, code, hole, CASE WHEN hole = 0 THEN sqrt(pow(greatest(w - x, 0, x - e), 2) + pow(greatest(s - lat, 0, lat - n), 2)) ELSE greatest(0, least(x - w, e - x, lat - s, n - lat)) END AS d
          FROM (SELECT *, lng + 360 * k AS x FROM pt, range(-1, 2) AS turn(k)), rect),
    per AS (SELECT lat, lng, code, min(d) FILTER (hole = 0) AS off, coalesce(max(d) FILTER (hole = 1), 0) AS deep FROM d GROUP BY 1, 2, 3)
    SELECT lat, lng, code AS region_id, round(greatest(off, deep), 9) AS distance FROM per WHERE greatest(off, deep) <= {_BUFFER}
    """,
)
def region_shapes(t: Tables):
    grid = materialize(geocode.region_cells(shapes(t), buffer=_BUFFER))
    found = geocode.reverse_geocode(points(t), grid, buffer=_BUFFER)
    return found.select("lat", "lng", "region_id", F.round("distance", 9).alias("distance"))


#: Customers live anywhere, on both poles and the date line, too.
_HOME_LAT, _HOME_LNG = "((c_custkey * 37) % 361 - 180) / 2.0D", "((c_custkey * 53) % 721 - 360) / 2.0D"


def _nearest_sql() -> str:
    """Every home against every piece of every border."""
    border = []
    for k, rings in enumerate(_SHAPES):
        for r in rings:
            ends = [[(x[1:] if x.startswith("=") else f"w + {x}") if n == 0 else f"s + {x}" for n, x in enumerate(p.split())] for p in r.split(", ")]
            border += [f"SELECT code, ({a[0]})::DOUBLE AS x1, ({a[1]})::DOUBLE AS y1, ({b[0]})::DOUBLE AS x2, ({b[1]})::DOUBLE AS y2 FROM box WHERE n_nationkey % 5 = {k}" for a, b in zip(ends, ends[1:])]
    v = lambda s, x, y: f"cos(radians({y})) * cos(radians({x})) AS {s}x, cos(radians({y})) * sin(radians({x})) AS {s}y, sin(radians({y})) AS {s}z"
    part = lambda i: (f"x1 + (x2 - x1) * {i} / n", f"y1 + (y2 - y1) * {i} / n")
    apart = lambda s: f"2 * asin(least(1, sqrt(({s}x - vx) * ({s}x - vx) + ({s}y - vy) * ({s}y - vy) + ({s}z - vz) * ({s}z - vz)) / 2))"
    return f"""
        WITH {_RECTANGLES},
        edge AS ({" UNION ALL ".join(border)}),
        short AS (SELECT code, x1, y1, CASE WHEN abs(x2 - x1) > 180 THEN x2 - sign(x2 - x1) * 360 ELSE x2 END AS x2, y2 FROM edge),
        cut AS (SELECT *, unnest(range(1, n + 1)) AS i FROM (SELECT *, ceil(greatest(abs(x2 - x1), abs(y2 - y1)) / {nearest.PIECE_DEGREES})::BIGINT AS n FROM short)),
        arc AS (SELECT code, {v("a", *part("(i - 1)"))}, {v("b", *part("i"))} FROM cut),
        norm AS MATERIALIZED (SELECT *, ay * bz - az * by_ AS nx, az * bx - ax * bz AS ny, ax * by_ - ay * bx AS nz FROM (SELECT code, ax, ay, az, bx, "by" AS by_, bz FROM arc)),
        home AS (SELECT DISTINCT {_HOME_LAT.replace("D", "")} AS lat, {_HOME_LNG.replace("D", "")} AS lng FROM customer),
        flat AS (SELECT lat, lng, code, hole, CASE WHEN hole = 0 THEN greatest(w - x, x - e, s - lat, lat - n, 0) ELSE greatest(0, least(x - w, e - x, lat - s, n - lat)) END AS d FROM (SELECT *, lng + 360 * k AS x FROM home, range(-1, 2) AS turn(k)), rect),
        held AS (SELECT lat, lng, code FROM flat GROUP BY 1, 2, 3 HAVING min(d) FILTER (hole = 0) = 0 AND coalesce(max(d) FILTER (hole = 1), 0) = 0),
        open_ AS (SELECT lat, lng, {v("v", "lng", "lat")} FROM home ANTI JOIN held USING (lat, lng)),
        dist AS (SELECT lat, lng, code, CASE WHEN (ny * az - nz * ay) * vx + (nz * ax - nx * az) * vy + (nx * ay - ny * ax) * vz >= 0 AND (by_ * nz - bz * ny) * vx + (bz * nx - bx * nz) * vy + (bx * ny - by_ * nx) * vz >= 0
              THEN asin(least(1, abs(nx * vx + ny * vy + nz * vz) / sqrt(nx * nx + ny * ny + nz * nz)))
              ELSE least({apart("a")}, {apart("b").replace("by ", "by_ ")}) END * 6371000.0 AS m FROM open_, norm)
        SELECT lat, lng, arg_min(code, (round(m, 3), code)) AS region_id, round(min(m), 1) AS metres FROM dist GROUP BY 1, 2
        UNION ALL SELECT lat, lng, min(code), 0 FROM held GROUP BY 1, 2
    """


@query("nearest_on_sphere", _nearest_sql())
def nearest_on_sphere(t: Tables):
    homes = t.customer.selectExpr(f"{_HOME_LAT} AS lat", f"{_HOME_LNG} AS lng")
    inside = geocode.reverse_geocode(homes, materialize(geocode.region_cells(shapes(t))))
    found = nearest.nearest_on_sphere(homes, inside, nearest.sphere_index(shapes(t)))
    return found.select("lat", "lng", "region_id", F.round("metres", 1).alias("metres"))


@query("geocode_two_step", f"WITH {_HITS_SQL} SELECT type, count(*) AS n, sum(CASE WHEN distance = 0 THEN 1 ELSE 0 END) AS inside, round(sum(distance), 6) AS total FROM near GROUP BY 1")
def geocode_two_step(t: Tables):
    found = geocode.geocode_two_step(points(t), cells(t), buffer=_BUFFER)
    return found.groupBy("type").agg(
        F.count("*").alias("n"), F.sum(F.when(F.col("distance") == 0, 1).otherwise(0)).alias("inside"), F.round(F.sum("distance"), 6).alias("total")
    )


@query(
    "nearest_region",
    f"""
    WITH {_HITS_SQL}
    SELECT lat, lng, arg_min(region_id, (distance, region_id)) AS region_id, round(min(distance), 9) AS distance FROM near WHERE type = 'Political' GROUP BY 1, 2
    """,
)
def nearest_region(t: Tables):
    found = geocode.reverse_geocode(points(t), cells(t), buffer=_BUFFER).filter("type = 'Political'")
    best = geocode.nearest(found, ["lat", "lng"], "distance", "region_id")
    return best.select("lat", "lng", "region_id", F.round("distance", 9).alias("distance"))


@query(
    "admin_areas",
    f"""
    WITH {_HITS_SQL}
    SELECT lat, lng, min(CASE WHEN type = 'GADM0' AND distance = 0 THEN region_id END) AS gid0, min(CASE WHEN type = 'GADM1' AND distance = 0 THEN region_id END) AS gid1,
      arg_min(name, region_id) FILTER (type = 'GADM1' AND distance = 0) AS name1
    FROM near GROUP BY 1, 2
    """,
)
def admin_areas(t: Tables):
    found = geocode.admin_areas(geocode.reverse_geocode(points(t), cells(t), buffer=_BUFFER))
    return found.select("lat", "lng", F.col("level0Gid").alias("gid0"), F.col("level1Gid").alias("gid1"), F.col("level1Name").alias("name1"))


_PAIRS_SQL = (
    "(VALUES "
    + ", ".join("('{}', '{}', {})".format(*line.split(",")) for line in dims.COUNTRY_PAIRS.split())
    + ") AS p(a, b, flagged)"
)
_PAIR_SETS = f"""
    raw AS (SELECT * FROM {_PAIRS_SQL}),
    pair AS (SELECT DISTINCT country, other, flagged FROM (
      SELECT a AS country, b AS other, flagged FROM raw UNION ALL SELECT b, a, flagged FROM raw UNION ALL SELECT a, a, flagged FROM raw UNION ALL SELECT b, b, flagged FROM raw))
"""


@query(
    "country_pairs",
    f"""
    WITH {_PAIR_SETS}, nat AS (SELECT {_CODE_SQL} AS code FROM nation)
    SELECT code, coalesce(string_agg(other, '|' ORDER BY other) FILTER (NOT flagged), '') AS equivalent,
      coalesce(string_agg(other, '|' ORDER BY other) FILTER (flagged), '') AS confused
    FROM nat LEFT JOIN pair ON code = country GROUP BY 1
    """,
)
def country_pairs(t: Tables):
    sets = country.pair_sets(dims.load_country_pairs(t.spark)).withColumnRenamed("country", "code")
    found = nations(t).select("code").join(F.broadcast(sets), "code", "left")  # a few dozen rows
    text = lambda c: F.coalesce(F.array_join(F.array_sort(c), "|"), F.lit(""))
    return found.select("code", text("equivalent").alias("equivalent"), text("confused").alias("confused"))


#: The country given for an event: that of another nation, or none.
_GIVEN_KEY = "CASE WHEN event_id % 6 = 0 THEN NULL ELSE (event_id * 7) % 25 END"


@query(
    "match_country",
    f"""
    WITH {_HITS_SQL}, {_PAIR_SETS},
    ev AS (SELECT event_id, {_LAT} AS lat, {_LNG} AS lng, {_GIVEN_KEY} AS nk FROM events),
    rec AS (SELECT ev.*, code AS given FROM ev LEFT JOIN box ON nk = n_nationkey),
    cand AS (SELECT event_id, given, 0 AS pos, lat AS y, lng AS x FROM rec UNION ALL SELECT event_id, given, 1, -lat, lng FROM rec UNION ALL SELECT event_id, given, 2, lat, -lng FROM rec
             UNION ALL SELECT event_id, given, 3, -lat, -lng FROM rec UNION ALL SELECT event_id, given, 4, lng, lat FROM rec),
    loc AS (SELECT event_id, given, pos, y, x, code, sqrt(pow({_DX.format(x="x")}, 2) + pow(greatest(s - y, 0, y - n), 2)) AS d
            FROM cand JOIN box ON y BETWEEN s - {_BUFFER} AND n + {_BUFFER} AND {_DX.format(x="x")} <= {_BUFFER}
            WHERE y BETWEEN -90 AND 90 AND x BETWEEN -180 AND 180 AND NOT (given IS NULL AND y < -60)
              AND sqrt(pow({_DX.format(x="x")}, 2) + pow(greatest(s - y, 0, y - n), 2)) <= {_BUFFER}
            UNION ALL SELECT event_id, given, pos, y, x, 'AQ', 0 FROM cand WHERE given IS NULL AND y >= -90 AND y < -60 AND x BETWEEN -180 AND 180),
    per AS (SELECT event_id,
       max(CASE WHEN pos = 0 AND code = given THEN 1 ELSE 0 END) AS same,
       arg_min(loc.code, (d, loc.code)) FILTER (pos = 0) AS nearest,
       arg_min(loc.code, (d, loc.code)) FILTER (pos = 0 AND EXISTS (SELECT 1 FROM pair WHERE country = given AND other = loc.code AND NOT flagged)) AS eq,
       arg_min(loc.code, (d, loc.code)) FILTER (pos = 0 AND EXISTS (SELECT 1 FROM pair WHERE country = given AND other = loc.code AND flagged)) AS conf,
       min(CASE WHEN pos > 0 AND loc.code = given THEN pos END) AS fix
       FROM loc GROUP BY 1),
    j AS (SELECT rec.*, coalesce(same, 0) = 1 AS same, nearest, eq, conf, CASE WHEN coalesce(same, 0) = 1 OR eq IS NOT NULL OR conf IS NOT NULL THEN NULL ELSE fix END AS fix FROM rec LEFT JOIN per USING (event_id))
    SELECT event_id, given, CASE WHEN given IS NULL THEN nearest WHEN same THEN given ELSE coalesce(eq, conf, given) END AS country,
      CASE WHEN given IS NOT NULL AND fix IN (1, 3) THEN -lat WHEN given IS NOT NULL AND fix = 4 THEN lng ELSE lat END AS lat,
      CASE WHEN given IS NOT NULL AND fix IN (2, 3) THEN -lng WHEN given IS NOT NULL AND fix = 4 THEN lat ELSE lng END AS lng,
      CASE WHEN given IS NULL THEN CASE WHEN nearest IS NOT NULL THEN 'COUNTRY_DERIVED_FROM_COORDINATES' ELSE '' END
           WHEN same OR eq IS NOT NULL THEN '' WHEN conf IS NOT NULL THEN 'COUNTRY_DERIVED_FROM_COORDINATES'
           WHEN fix = 1 THEN 'PRESUMED_NEGATED_LATITUDE' WHEN fix = 2 THEN 'PRESUMED_NEGATED_LONGITUDE' WHEN fix = 3 THEN 'PRESUMED_NEGATED_LATITUDE|PRESUMED_NEGATED_LONGITUDE'
           WHEN fix = 4 THEN 'PRESUMED_SWAPPED_COORDINATE' ELSE 'COUNTRY_COORDINATE_MISMATCH' END AS issues
    FROM j
    """,
)
def match_country(t: Tables):
    given = F.expr(_GIVEN_KEY)
    named = dimension_join(
        points(t).withColumn("n_nationkey", given.cast("int")), nations(t).select("n_nationkey", F.col("code").alias("given")), ["n_nationkey"], "left")
    # Countries come from three layers; the others are there, too, and tell none.
    layer = F.expr("CASE WHEN type <> 'Political' THEN type ELSE element_at(array('Political', 'EEZ', 'PoliticalEEZ'), ascii(region_id) % 3 + 1) END")
    grid = materialize(geocode.region_cells(regions(t).withColumn("type", layer), buffer=_BUFFER))

    def lookup_points(pts):
        return geocode.geocode_lists(geocode.reverse_geocode(pts, grid, buffer=_BUFFER))

    found = country.match_country(named, lookup_points, dims.load_country_pairs(t.spark), country="given")
    return found.select(
        "event_id", "given", F.col("m_country").alias("country"), (F.col("m_lat") + 0.0).alias("lat"), (F.col("m_lng") + 0.0).alias("lng"), joined(F.col("m_issues")).alias("issues")
    )


@query(
    "parse_country",
    f"""
    WITH nat AS (SELECT n_nationkey, {_CODE_SQL} AS code FROM nation),
    c AS (SELECT c_custkey, CASE WHEN c_custkey % 7 = 0 THEN 'nowhere' WHEN c_custkey % 7 = 1 THEN NULL ELSE a.code END AS by_name_given, a.code AS acode, b.code AS bcode,
             c_custkey % 7 AS k FROM customer JOIN nat a ON a.n_nationkey = c_nationkey JOIN nat b ON b.n_nationkey = c_custkey % 25)
    SELECT c_custkey, CASE WHEN k = 2 THEN acode WHEN k = 3 THEN acode ELSE bcode END AS country,
      concat_ws('|', CASE WHEN k IN (0, 3) THEN 'COUNTRY_INVALID' END, CASE WHEN k >= 4 AND acode <> bcode THEN 'COUNTRY_MISMATCH' END) AS issues
    FROM c
    """,
)
def parse_country(t: Tables):
    k = F.col("c_custkey") % 7
    nat = nations(t)
    aliases = nat.select(F.col("n_name").alias("alias"), F.col("code").alias("iso2")).unionByName(nat.select(F.col("code").alias("alias"), F.col("code").alias("iso2")))
    name = F.when(k == 0, "nowhere").when(k != 1, F.concat(F.lit("nation "), F.col("c_nationkey").cast("string")))
    c = t.customer.select("c_custkey", name.alias("country"), (F.col("c_custkey") % 25).cast("int").alias("n_nationkey"), k.alias("k"))
    c = dimension_join(c, nat.select("n_nationkey", F.lower("code").alias("code")), ["n_nationkey"], "left")
    c = c.withColumn("countryCode", F.when(F.col("k") == 2, None).when(F.col("k") == 3, "??").otherwise(F.col("code"))).drop("code", "n_nationkey")
    found = country.parse_country(c, aliases, out="p")
    return found.select("c_custkey", F.col("p").alias("country"), joined(F.col("p_issues")).alias("issues"))


_CONTINENT_TEXT = "CASE event_id % 7 WHEN 0 THEN 'Africa' WHEN 1 THEN 'asia ' WHEN 2 THEN 'Atlantis' WHEN 3 THEN 'EUROPE' END"

_OF_COUNTRY = f"""
    oc AS (SELECT {_CODE_SQL} AS code, list({_CONT_SQL} ORDER BY q) AS conts FROM
             (SELECT n_nationkey, r_name, 0 AS q FROM nation JOIN region ON n_regionkey = r_regionkey
              UNION ALL SELECT n_nationkey, r_name, 1 FROM nation JOIN region ON r_regionkey = (n_regionkey + 1) % 5 WHERE n_nationkey % 3 = 0) GROUP BY 1)
"""


def country_continents(t: Tables):
    """One continent per nation, two for every third, in a table keyed by codes of three letters."""
    code = nations(t).select("n_nationkey", "n_regionkey", "code")
    name = "CASE r_name WHEN 'MIDDLE EAST' THEN 'EUROPE' WHEN 'AMERICA' THEN 'NORTH_AMERICA' ELSE r_name END"
    r = t.region.selectExpr("r_regionkey", f"{name} AS continent")
    first = code.join(r, F.col("n_regionkey") == F.col("r_regionkey")).select("code", "continent", F.lit(0).alias("pos"))
    second = code.filter("n_nationkey % 3 = 0").join(r, (F.col("n_regionkey") + 1) % 5 == F.col("r_regionkey")).select("code", "continent", F.lit(1).alias("pos"))
    three = F.concat("code", F.lit("X"))
    aliases = code.select(three.alias("iso3"), F.col("code").alias("iso2"))
    return dims.country_continents(first.unionByName(second).withColumn("country", three).drop("code"), aliases)


@query(
    "continents",
    f"""
    WITH {_HITS_SQL}, {_OF_COUNTRY},
    ev AS (SELECT event_id, CASE WHEN event_id % 4 <> 0 THEN {_LAT} END AS lat, CASE WHEN event_id % 4 <> 0 THEN {_LNG} END AS lng, (event_id * 7) % 25 AS nk, {_CONTINENT_TEXT} AS txt FROM events),
    fnd AS (SELECT lat, lng, list(region_id ORDER BY distance, region_id) AS f FROM near WHERE type = 'Continent' GROUP BY 1, 2),
    j AS (SELECT event_id, ev.lat, txt, CASE WHEN event_id % 5 <> 0 THEN box.code END AS cc, CASE WHEN event_id % 5 <> 0 THEN conts END AS conts, f,
             CASE trim(lower(txt)) WHEN 'africa' THEN 'AFRICA' WHEN 'asia' THEN 'ASIA' WHEN 'europe' THEN 'EUROPE' END AS p
          FROM ev JOIN box ON nk = n_nationkey JOIN oc ON oc.code = box.code LEFT JOIN fnd ON ev.lat = fnd.lat AND ev.lng = fnd.lng)
    SELECT event_id, CASE WHEN lat IS NOT NULL THEN CASE WHEN f IS NULL THEN NULL ELSE coalesce(p, f[1]) END WHEN p IS NULL AND len(conts) = 1 THEN conts[1] ELSE p END AS continent,
      concat_ws('|', CASE WHEN lat IS NOT NULL AND p IS NOT NULL AND NOT coalesce(list_contains(f, p), false) THEN 'CONTINENT_COORDINATE_MISMATCH' END,
        CASE WHEN cc IS NOT NULL AND p IS NOT NULL AND NOT list_contains(conts, p) THEN 'CONTINENT_COUNTRY_MISMATCH' END,
        CASE WHEN lat IS NOT NULL AND f IS NOT NULL AND p IS NULL THEN 'CONTINENT_DERIVED_FROM_COORDINATES' END,
        CASE WHEN lat IS NULL AND cc IS NOT NULL AND p IS NULL AND len(conts) = 1 THEN 'CONTINENT_DERIVED_FROM_COUNTRY' END,
        CASE WHEN txt IS NOT NULL AND p IS NULL THEN 'CONTINENT_INVALID' END) AS issues
    FROM j
    """,
)
def continents(t: Tables):
    e = t.events.select(
        "event_id",
        F.when(F.col("event_id") % 4 != 0, F.expr(_LAT)).alias("lat"),
        F.when(F.col("event_id") % 4 != 0, F.expr(_LNG)).alias("lng"),
        ((F.col("event_id") * 7) % 25).cast("int").alias("n_nationkey"),
        F.expr(_CONTINENT_TEXT).alias("txt"),
    )
    e = dimension_join(e, nations(t).select("n_nationkey", "code"), ["n_nationkey"], "left")
    e = e.withColumn("country", F.when(F.col("event_id") % 5 != 0, F.col("code")))
    e = dimension_join(e, country_continents(t), ["country"], "left")
    e = lookup.lookup_enum(e, trimmed(F.col("txt")), vocabulary(t.spark), "continent", "parsed")
    grid = cells(t).filter("type = 'Continent'")
    here = geocode.geocode_lists(geocode.reverse_geocode(e.select("lat", "lng"), grid, buffer=_BUFFER)).select("lat", "lng", F.col("continents").alias("found"))
    e = spread_null_join(e, here, ["lat", "lng"], spread=["event_id"])
    r = continent.resolve_continent(F.col("txt"), F.col("parsed"), F.col("continents"), F.col("country"), F.col("lat").isNotNull(), F.col("found"))
    e = e.select("event_id", r.alias("r"))
    return e.select("event_id", F.col("r.value").alias("continent"), joined(F.col("r.issues")).alias("issues"))


@query(
    "centroid_distance",
    f"""
    WITH {_REGIONS_SQL}, cen AS (SELECT (s + n) / 2 AS clat, (w + e) / 2 AS clng FROM box),
    pt AS (SELECT DISTINCT (s + n) / 2 + ((event_id % 41) - 20) / 400.0 AS lat, (w + e) / 2 + ((event_id % 37) - 18) / 300.0 AS lng FROM events JOIN box ON event_id % 25 = n_nationkey),
    d AS (SELECT lat, lng, 2 * 6371000.0 * asin(sqrt(least(1, pow(sin(radians(clat - lat) / 2), 2) + cos(radians(lat)) * cos(radians(clat)) * pow(sin(radians(clng - lng) / 2), 2)))) AS m FROM pt, cen)
    SELECT lat, lng, round(min(m), 3) AS m FROM d WHERE m <= 5000 GROUP BY 1, 2
    """,
)
def centroid_distance(t: Tables):
    cen = nations(t).selectExpr("n_nationkey", *_BOX_COLS).selectExpr("n_nationkey", "(s + n) / 2 AS lat", "(w + e) / 2 AS lng")
    e = t.events.select("event_id", (F.col("event_id") % 25).cast("int").alias("n_nationkey"))
    e = dimension_join(e, cen, ["n_nationkey"], "inner").selectExpr(
        "lat + ((event_id % 41) - 20) / 400.0D AS lat", "lng + ((event_id % 37) - 18) / 300.0D AS lng"
    )
    found = geocode.centroid_distance(e, cen.select("lat", "lng"))
    return found.select("lat", "lng", F.round("distanceFromCentroidInMeters", 3).alias("m"))


@query(
    "repatriation",
    """
    SELECT sr.r_name AS region, cr.r_name AS published_region, cs.n_nationkey <> cc.n_nationkey AS repatriated, count(*) AS n
    FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
    JOIN nation cs ON s_nationkey = cs.n_nationkey JOIN nation cc ON c_nationkey = cc.n_nationkey
    JOIN region sr ON cs.n_regionkey = sr.r_regionkey JOIN region cr ON cc.n_regionkey = cr.r_regionkey GROUP BY 1, 2, 3
    """,
)
def repatriation(t: Tables):
    by_code = nations(t).join(t.region, F.col("n_regionkey") == F.col("r_regionkey")).select(
        F.col("n_nationkey"), F.col("code").alias("iso2"), F.col("r_name").alias("region")
    )
    code = by_code.select("n_nationkey", "iso2")
    sup = t.supplier.join(code, F.col("s_nationkey") == F.col("n_nationkey")).select(F.col("s_suppkey").alias("l_suppkey"), F.col("iso2").alias("countryCode"))
    cust = t.customer.join(code, F.col("c_nationkey") == F.col("n_nationkey")).select(F.col("c_custkey").alias("o_custkey"), F.col("iso2").alias("publishingCountry"))
    publisher = dimension_join(t.orders.select("o_orderkey", "o_custkey"), cust, ["o_custkey"], "inner").select(
        F.col("o_orderkey").alias("l_orderkey"), "publishingCountry"
    )
    l = dimension_join(t.lineitem.select("l_orderkey", "l_suppkey"), sup, ["l_suppkey"], "inner")
    l = l.join(publisher, "l_orderkey").select("l_orderkey", "countryCode", "publishingCountry")
    l = country.region_of(l, by_code.select("iso2", "region"), "countryCode", "region")
    l = country.region_of(l, by_code.select("iso2", "region"), "publishingCountry", "published_region")
    flag = country.repatriated(F.col("countryCode"), F.col("publishingCountry")).alias("repatriated")
    return l.groupBy("region", "published_region", flag).agg(F.count("*").alias("n"))
