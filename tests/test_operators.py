"""Operators on small tables, against what a brute-force reading gives."""

import json
import math
import random

import pytest
from pyspark.sql import functions as F

from fieldbook.functions import geo
from fieldbook.operators import country, enrich, geocode, identification, joins, lineage, lookup, nearest, records, taxonomy
from fieldbook import schema
from fieldbook.plans import prepare_session
from fieldbook.schema import DWC_NS, VOCABULARY, uri
from fieldbook.sources import dims, verbatim


def test_row_key_tells_nulls_apart(spark):
    df = spark.createDataFrame([(None, "a"), ("a", None), ("", "a"), ("null", "a"), ("a|", "b"), ("a", "|b")], "x string, y string")
    keys = [r[0] for r in df.select(enrich.row_key(["x", "y"])).collect()]
    assert len(set(keys)) == 6


def test_enrichment_keeps_rows(spark):
    # Two names that differ only in a rank are two keys, and no record is multiplied.
    rows = [(str(i), "Abies", "sp." if i % 2 else None) for i in range(40)]
    df = spark.createDataFrame(rows, "id string, name string, rank string")
    out = enrich.enrich_distinct(df, ["name", "rank"], lambda k: k.select(enrich.KEY, F.coalesce("rank", F.lit("none")).alias("r")), spread=["id"])
    got = {r["id"]: r["r"] for r in out.collect()}
    assert len(got) == 40 and got["1"] == "sp." and got["2"] == "none"


@pytest.mark.parametrize("how", ["left", "inner"])
def test_skew_join_is_the_plain_join(spark, how):
    random.seed(1)
    left = spark.createDataFrame([(i, random.choice([0, 0, 0, None, 1, 2, i])) for i in range(600)], "i int, k int")
    right = spark.createDataFrame([(k, f"v{k}{n}") for k in range(0, 300, 2) for n in range(2)] + [(None, "never")], "k int, v string")
    plain = left.join(right, "k", how).select("i", "k", "v").collect()
    split = joins.skew_join(left, right, ["k"], how, spread=["i"], hot_rows=50, buckets=7).select("i", "k", "v").collect()
    order = lambda rows: sorted(map(str, rows))
    assert order(plain) == order(split)


def test_size_check(spark):
    assert joins.fits_broadcast(spark.range(10), 10)
    assert not joins.fits_broadcast(spark.range(11), 10)
    small = joins.dimension_join(spark.range(5), spark.range(3).withColumn("v", F.lit(1)), ["id"])
    large = joins.dimension_join(spark.range(5), spark.range(3).withColumn("v", F.lit(1)), ["id"], small=False)
    assert sorted(map(tuple, small.collect())) == sorted(map(tuple, large.collect()))


def _record(core, ext=None):
    return ("1", "c", None, {uri(k): v for k, v in core.items()}, {DWC_NS + "Identification": [{uri(k): v for k, v in e.items()} for e in ext]} if ext else None)


def _names(spark, *recs):
    from fieldbook.schema import VERBATIM

    df = spark.createDataFrame(list(recs), VERBATIM)
    return [(r["scientificName"], r["genus"]) for r in identification.extract_identification(df).collect()]


def test_identification_source(spark):
    old, new = {"dateIdentified": "1999", "scientificName": "Old"}, {"dateIdentified": "2001-05", "scientificName": "New", "genus": "G"}
    got = _names(
        spark,
        _record({"locality": "x"}, [old, new]),
        _record({"locality": "x"}, [old, {"scientificName": "Undated"}]),
        _record({"locality": "x"}, [{"scientificName": "Only"}]),
        _record({"genus": "Core"}, [old, new]),
        _record({"genus": "null"}, [old, {**new, "dateIdentified": "1999"}]),
        _record({"locality": "x"}, [{"scientificName": "NULL", "verbatimIdentification": " raw "}]),
        _record({"locality": "x"}),
    )
    assert got == [("New", "G"), (None, None), ("Only", None), (None, "Core"), ("Old", None), (" raw ", None), (None, None)]


def test_gates(spark):
    from fieldbook.schema import VERBATIM

    df = spark.createDataFrame([_record({"country": "x"}), ("", None, None, {"a": "b"}, None), ("2", None, None, {}, None)], VERBATIM)
    good, bad = records.split_valid(df)
    assert [r["id"] for r in good.collect()] == ["1"]
    assert [r["reason"] for r in bad.collect()] == ["ID_MISSING", "CORE_TERMS_MISSING"]
    assert records.with_terms(df).count() == 2
    loc = records.extract_location(good).select(records.location_terms_map().alias("m")).first()["m"]
    assert loc == {uri("country"): "x"}


def test_vocabulary_needs_unique_labels(spark):
    rows = [("v", "A b", "X", None, None), ("v", "ab", "Y", None, None)]
    with pytest.raises(ValueError):
        lookup.prepare_vocabulary(spark.createDataFrame(rows, VOCABULARY))


def test_lookup_of_arrays_both_ways(spark):
    rows = [("t", "holotype", "Holotype", [("Type", [])], None), ("t", "para type", "Paratype", None, None)]
    vocab = lookup.prepare_vocabulary(spark.createDataFrame(rows, VOCABULARY))
    df = spark.createDataFrame([(1, ["Holotype", "x", "PARATYPE", "x"]), (2, None), (3, ["maybe"])], "i int, a array<string>")
    literal = lookup.lookup_values(df, "a", vocab, "t", "o", spread=["i"]).orderBy("i").collect()
    joined = lookup.lookup_values(df, "a", vocab, "t", "o", spread=["i"], literal_rows=1).orderBy("i").collect()
    assert [r["o"] for r in literal] == [r["o"] for r in joined]
    assert [e["concept"] and e["concept"]["lineage"] for e in literal[0]["o"]] == [["Type", "Holotype"], None, ["Paratype"], None]
    status = lookup.type_status(df, "a", vocab, "s", spread=["i"], vocab="t").orderBy("i").collect()
    assert [r["s_issues"] for r in status] == [["TYPE_STATUS_INVALID"], [], ["SUSPECTED_TYPE"]]


def _events(spark, pairs):
    return spark.createDataFrame([(i, p, f"t{i}") for i, p in pairs], "id string, parentId string, eventType string")


def test_lineage(spark):
    chain = [("n0", None)] + [(f"n{i}", f"n{i-1}") for i in range(1, 12)]
    pairs = [*chain, ("a", "b"), ("b", "a"), ("c", "a"), ("self", "self"), ("d", "self"), ("m", "missing"), ("k", "m")]
    got = {r["id"]: r for r in lineage.expand_lineage(_events(spark, pairs), hot_rows=1, buckets=3).collect()}
    assert len(got) == len(pairs)
    assert [(p["id"], p["eventType"], p["order"]) for p in got["n11"]["parentsLineage"]] == [(f"n{10-i}", f"tn{10-i}", i + 1) for i in range(11)]
    assert got["n0"]["parentsLineage"] is None and got["n0"]["issues"] == []
    for i in ("a", "b", "c", "self", "d"):
        assert got[i]["parentsLineage"] is None and got[i]["issues"] == [lineage.LOOP_ISSUE]
    assert got["m"]["parentsLineage"] == []
    assert [p["id"] for p in got["k"]["parentsLineage"]] == ["m"]


def test_geocode_against_brute_force(spark):
    random.seed(3)
    rings = {
        "star": [(0, 0), (10, 20), (20, 0), (-2, 13), (22, 13)],
        "bow": [(-30.5, -10), (-20, -10), (-20, 5.25), (-25, -4), (-30.5, 5)],
        "far": [(170, 60), (180, 60), (180, 90), (170, 90)],
    }
    regions = spark.createDataFrame(
        [(n, "Political", n, n[:2].upper(), [{"lng": float(x), "lat": float(y)} for x, y in r]) for n, r in rings.items()],
        "region_id string, type string, name string, iso2 string, ring array<struct<lng:double,lat:double>>",
    )
    pts = [(random.uniform(-12, 23), random.uniform(-32, 24)) for _ in range(300)] + [(90.0, 180.0), (60.0, 175.0), (75.0, 179.9), (0.0, 0.0)]
    points = spark.createDataFrame(pts, "lat double, lng double")
    buffer = 0.7
    cells = geocode.region_cells(regions, 73, 37, buffer)
    got = geocode.reverse_geocode(points, cells, 73, 37, buffer).collect()
    two = geocode.geocode_two_step(points, cells, 73, 37, buffer).collect()

    def inside(ring, x, y):
        odd = False
        for (x1, y1), (x2, y2) in zip(ring, ring[1:] + ring[:1]):
            if (y1 > y) != (y2 > y) and x < (x2 - x1) * (y - y1) / (y2 - y1) + x1:
                odd = not odd
        return odd

    def off(ring, x, y):
        best = float("inf")
        for (x1, y1), (x2, y2) in zip(ring, ring[1:] + ring[:1]):
            dx, dy = x2 - x1, y2 - y1
            t = max(0.0, min(1.0, ((x - x1) * dx + (y - y1) * dy) / (dx * dx + dy * dy)))
            best = min(best, ((x1 + t * dx - x) ** 2 + (y1 + t * dy - y) ** 2) ** 0.5)
        return best

    want = set()
    for lat, lng in pts:
        for n, ring in rings.items():
            d = 0.0 if inside(ring, lng, lat) else off(ring, lng, lat)
            if d <= buffer:
                want.add((lat, lng, n, round(d, 9)))
    assert {(r["lat"], r["lng"], r["region_id"], round(r["distance"], 9)) for r in got} == want
    assert {(r["lat"], r["lng"], r["region_id"], round(r["distance"], 9)) for r in two} == want and len(two) == len(want)


def _odd(rings, x, y):
    odd = False
    for ring in rings:
        for (x1, y1), (x2, y2) in zip(ring, ring[1:] + ring[:1]):
            if (y1 > y) != (y2 > y) and x < (x2 - x1) * (y - y1) / (y2 - y1) + x1:
                odd = not odd
    return odd


def _off(rings, x, y):
    best = float("inf")
    for ring in rings:
        for (x1, y1), (x2, y2) in zip(ring, ring[1:] + ring[:1]):
            dx, dy = x2 - x1, y2 - y1
            if dx or dy:
                t = max(0.0, min(1.0, ((x - x1) * dx + (y - y1) * dy) / (dx * dx + dy * dy)))
                best = min(best, ((x1 + t * dx - x) ** 2 + (y1 + t * dy - y) ** 2) ** 0.5)
    return best


@pytest.mark.parametrize("dense, depth, buffer", [(10_000, 0, 0.4), (3, 4, 0.4), (3, 4, 0.0), (8, 2, 0.01)])
def test_shapes_against_brute_force(spark, dense, depth, buffer):
    """Holes, parts, the date line and poles, in cells that are quartered again."""
    random.seed(4)

    def blob(x, y, r, n):
        return [(x + r * random.uniform(0.5, 1) * math.cos(6.2831853 * k / n), y + r * random.uniform(0.5, 1) * math.sin(6.2831853 * k / n)) for k in range(n)]

    line = blob(179, -20, 9, 40)  # goes on beyond 180 degrees
    shapes_ = {
        "L": [[(0, 0), (9, 0), (9, 3), (3, 3), (3, 9), (0, 9)]],
        "hole": [blob(30, 10, 14, 200), blob(30, 10, 4, 60), [(29, 9), (31, 9), (31, 11), (29, 11)]],
        "parts": [blob(-40, -30, 6, 30), blob(-25, -35, 7, 30)],
        "over": [line],
        "jump": [[(x - 360 if x > 180 else x, y + 50) for x, y in line]],
        "fiji": [[(177, 3), (180, 3), (180, 6), (177, 6)], [(-180, 3), (-178, 3), (-178, 6), (-180, 6)]],
    }
    polar = [(lng, -70 + 4 * math.sin(lng)) for lng in range(-180, 180, 7)]
    cap = [(lng, 80.0 + (lng % 3)) for lng in range(175, -180, -10)]
    followed = [(lng, -72.0) for lng in range(-180, 181, 12)] + [(180, -90), (-180, -90)]
    rows = {**shapes_, "south": [polar], "north": [cap], "followed": [followed]}
    regions = spark.createDataFrame(
        [(n, "Political", n, n[:2].upper(), [[{"lng": float(x), "lat": float(y)} for x, y in r] for r in rings]) for n, rings in rows.items()], schema.REGION
    )
    near = [(179.9, -20), (-179.9, -20), (180, -20), (-180, -20), (-179.99, 30), (179.99, 4), (-179.99, 4), (-180, 4), (12, -89.99), (0, 90), (0, -90), (30, 10), (29, 9), (3, 3), (0, 5)]
    pts = [(random.uniform(-92, 92), random.uniform(-180, 180)) for _ in range(400)] + [(y, x) for x, y in near]
    pts += [(random.uniform(-5, 25), random.uniform(-3, 46)) for _ in range(300)] + [(random.uniform(-32, 40), random.choice((-1, 1)) * random.uniform(165, 180)) for _ in range(300)]
    points = spark.createDataFrame([(float(a), float(b)) for a, b in pts], "lat double, lng double")
    cells = geocode.region_cells(regions, 73, 37, buffer, dense, depth).persist()
    want = set()
    for lat, lng in set((float(a), float(b)) for a, b in pts if -90 <= a <= 90):
        for n, rings in rows.items():
            if n in ("south", "north", "followed"):
                # As a shape of the plane: three turns of the border, closed far beyond the pole.
                open_ = sorted(rings[0][:31] if n == "followed" else rings[0])
                border = sorted({(x + 360 * k, y) for k in (-2, -1, 0, 1, 2) for x, y in open_})
                pole = 1000.0 if n == "north" else -1000.0
                flat, shifts = [[*border, (border[-1][0], pole), (border[0][0], pole)]], (0,)
            else:
                flat, shifts = [line] if n in ("over", "jump") else rings, (-360, 0, 360)
                flat = [[(x, y + 50) for x, y in line]] if n == "jump" else flat
            d = 0.0 if any(_odd(flat, lng + k, lat) for k in shifts) else min(_off(flat, lng + k, lat) for k in shifts)
            if d <= buffer:
                want.add((lat, lng, n, round(d, 7)))
    for found in (geocode.reverse_geocode(points, cells, 73, 37, buffer, depth=depth), geocode.geocode_two_step(points, cells, 73, 37, buffer, depth=depth)):
        got = [(r["lat"], r["lng"], r["region_id"], round(r["distance"], 7)) for r in found.collect()]
        assert len(got) == len(set(got)) and set(got) == want
    assert {r["level"] for r in cells.select("level").collect()} == {0} if depth == 0 else True
    cells.unpersist()


def test_nearest_on_sphere_against_brute_force(spark):
    """Every point against every arc, near the poles and the date line, too."""
    np = pytest.importorskip("numpy")
    random.seed(6)
    rings = {
        "far": [(-150, 10), (-140, 12), (-145, 20)], "line": [(175, -10), (-175, -12), (-178, -20), (178, -19)], "cap": [(lng, 86) for lng in range(-180, 180, 20)],
        "south": [(20, -60), (30, -62), (25, -70)], "small": [(0, 0), (0.2, 0), (0.1, 0.1)], "twin": [(0, 40), (10, 40), (5, 45)], "twin2": [(0, 40), (10, 40), (5, 45)],
    }
    regions = spark.createDataFrame([(n, "Political", n, "XX", [[{"lng": float(x), "lat": float(y)} for x, y in r]]) for n, r in rings.items()], schema.REGION)
    pts = [(random.uniform(-90, 90), random.uniform(-180, 180)) for _ in range(200)] + [(90.0, 0.0), (-90.0, 7.0), (0.0, 180.0), (0.0, -180.0), (89.9, 33.0), (-14.0, -179.99), (0.05, 0.1), (0.0, 0.0)]
    index = nearest.sphere_index(regions)
    got = {(r["lat"], r["lng"]): r for r in nearest.nearest_border(spark.createDataFrame([*pts, pts[0], (None, 1.0), (91.0, 0.0)], "lat double, lng double"), index).collect()}

    def vec(lng, lat):
        a, b = np.radians(lng), np.radians(lat)
        return np.array([np.cos(b) * np.cos(a), np.cos(b) * np.sin(a), np.sin(b)])

    arcs = []
    for n, r in rings.items():
        for (x1, y1), (x2, y2) in zip(r, r[1:] + r[:1]):
            x2 = x2 - 360 * np.sign(x2 - x1) if abs(x2 - x1) > 180 else x2
            k = int(np.ceil(max(abs(x2 - x1), abs(y2 - y1)) / 0.5))
            ends = [vec(x1 + (x2 - x1) * i / k, y1 + (y2 - y1) * i / k) for i in range(k + 1)]
            arcs += [(n, a, b) for a, b in zip(ends, ends[1:])]

    def angle(a, b):
        return np.arctan2(np.linalg.norm(np.cross(a, b)), a @ b)

    def off(p, a, b):
        n = np.cross(a, b)
        if np.cross(n, a) @ p >= 0 and np.cross(b, n) @ p >= 0:
            return abs(np.arcsin(np.clip(n @ p / np.linalg.norm(n), -1, 1)))
        return min(angle(p, a), angle(p, b))

    assert len(got) == len(pts)
    for lat, lng in pts:
        best = min((round(off(vec(lng, lat), a, b) * geo.EARTH_RADIUS_M, 3), n) for n, a, b in arcs)
        assert abs(got[lat, lng]["metres"] - best[0]) < 0.01 and got[lat, lng]["region_id"] == best[1]
    within = nearest.nearest_border(spark.createDataFrame(pts, "lat double, lng double"), index, 1e6).collect()
    assert all(r["metres"] <= 1e6 for r in within) and len(within) == sum(r["metres"] <= 1e6 for r in got.values())
    none = nearest.sphere_index(spark.createDataFrame([], schema.REGION))
    assert nearest.nearest_border(spark.createDataFrame(pts, "lat double, lng double"), none).count() == 0


def test_cells_hold_few_edges(spark):
    """Edges are cut to the cells they run through: a border of n edges that crosses k cells is
    stored as n + k pieces at most, whatever the size of the region."""
    n = 4000
    ring = [{"lng": 60 * math.cos(6.2831853 * k / n), "lat": 60 * math.sin(6.2831853 * k / n)} for k in range(n)]
    regions = spark.createDataFrame([("r", "Political", "r", "RR", [ring])], schema.REGION)
    cells = geocode.region_cells(regions).agg(F.sum(F.coalesce(F.size("edges"), F.lit(0))), F.count(F.when(~F.col("whole"), 1)), F.max(F.size("edges"))).first()
    assert n <= cells[0] <= n + 2 * cells[1] and cells[2] <= geocode.DENSE



def test_centroids(spark):
    points = spark.createDataFrame([(10.0, 179.99), (10.0, 10.0), (89.999, 0.0), (10.02, 10.0)], "lat double, lng double")
    cen = spark.createDataFrame([(10.0, -179.99), (10.0, 10.0), (89.999, 180.0)], "lat double, lng double")
    got = {(r[0], r[1]): r[2] for r in geocode.centroid_distance(points, cen).collect()}
    assert set(got) == {(10.0, 179.99), (10.0, 10.0), (89.999, 0.0), (10.02, 10.0)}
    assert got[(10.0, 10.0)] == 0.0 and 2100 < got[(10.0, 179.99)] < 2300


def test_pixels(spark):
    r = spark.range(1).select(
        geo.pixel_x(F.lit(-180.0), 361), geo.pixel_x(F.lit(180.0), 361), geo.pixel_y(F.lit(90.0), 181), geo.pixel_y(F.lit(-90.0), 181)
    ).first()
    assert list(r) == [0, 360, 0, 180]


def test_antarctica_and_repair(spark):
    lists = spark.createDataFrame([(10.0, 20.0, ["FR"]), (-10.0, 20.0, ["GB"])], "lat double, lng double, countries array<string>")

    def at(pts):
        return pts.distinct().join(lists, ["lat", "lng"])

    df = spark.createDataFrame(
        [(1, None, -70.0, 5.0), (2, "AQ", -70.0, 5.0), (3, "GB", 10.0, 20.0), (4, "IE", -10.0, 20.0), (5, "GP", 10.0, 20.0), (6, "US", 10.0, 20.0), (7, None, 10.0, 20.0), (8, "FR", None, None)],
        "i int, country string, lat double, lng double",
    )
    got = {r["i"]: (r["m_country"], r["m_lat"], r["m_issues"], r["m_ok"]) for r in country.match_country(df, at, dims.load_country_pairs(spark)).collect()}
    assert got[1] == ("AQ", -70.0, ["COUNTRY_DERIVED_FROM_COORDINATES"], True)
    assert got[2] == ("AQ", -70.0, [], True)
    assert got[3] == ("GB", -10.0, ["PRESUMED_NEGATED_LATITUDE"], True)
    assert got[4] == ("GB", -10.0, ["COUNTRY_DERIVED_FROM_COORDINATES"], True)
    assert got[5] == ("FR", 10.0, [], True)
    assert got[6] == ("US", 10.0, ["COUNTRY_COORDINATE_MISMATCH"], False)
    assert got[7] == ("FR", 10.0, ["COUNTRY_DERIVED_FROM_COORDINATES"], True)
    assert got[8] == ("FR", None, [], False)


def test_country_spellings_never_multiply_rows(spark):
    aliases = spark.createDataFrame([("U.S.A.", "US"), ("USA", "US"), ("us", "US"), ("Chile", "CL")], "alias string, iso2 string")
    df = spark.createDataFrame([(1, "usa", "US"), (2, "chile", "US"), (3, "Atlantis", None), (4, None, None)], "i int, country string, countryCode string")
    got = [(r["p"], r["p_issues"]) for r in country.parse_country(df, aliases, out="p").orderBy("i").collect()]
    assert got == [("US", []), ("US", ["COUNTRY_MISMATCH"]), (None, ["COUNTRY_INVALID"]), (None, [])]


def test_pairs_and_continents_from_files(spark, tmp_path):
    (tmp_path / "p.txt").write_text("# comment\n\naa, bb ,true\nCC,DD,false\n")
    rows = {tuple(r) for r in dims.load_country_pairs(spark, str(tmp_path / "p.txt")).collect()}
    assert ("BB", "AA", True) in rows and ("AA", "AA", True) in rows and ("CC", "DD", False) in rows and len(rows) == 8
    (tmp_path / "c.txt").write_text("# c\nAZE,ASIA\nAZE,EUROPE\nXZZ,ASIA\nFRA,EUROPE\n")
    got = {r[0]: r[1] for r in dims.load_country_continents(spark, str(tmp_path / "c.txt")).collect()}
    assert got == {"AZE": ["ASIA", "EUROPE"], "FRA": ["EUROPE"]}


@pytest.mark.parametrize("edits", [1, 2, 3])
def test_segments_find_all_near_names(spark, edits):
    random.seed(edits)
    words = {"".join(random.choice("ab c") for _ in range(random.randint(1, 9))) for _ in range(250)} | {"abies alba", "abise alba", "abiesalba", "xabies alb"}
    df = spark.createDataFrame([(w,) for w in words], "w string")
    probes = df.select("w", F.explode(taxonomy.segment_probes(F.col("w"), edits)).alias("s"))
    stored = df.select(F.col("w").alias("v"), F.explode(taxonomy.name_segments(F.col("w"), edits)).alias("s"))
    near = {(r[0], r[1]) for r in probes.join(stored, "s").select("w", "v").distinct().filter(F.levenshtein("w", "v") <= edits).collect()}
    brute = {(r[0], r[1]) for r in df.alias("a").crossJoin(df.alias("b")).filter(F.levenshtein("a.w", "b.w") <= edits).select("a.w", "b.w").collect()}
    assert near == brute


def _backbone(spark, rows):
    """``key, name, authorship, rank, status, kingdom, family``."""
    from catalog.names import complete

    return complete(spark.createDataFrame(rows, "key int, name string, authorship string, rank string, status string, kingdom string, family string"))


def _match(spark, backbone, asked, **more):
    fields = ["kingdom", "phylum", "clazz", "order", "family", "genus", "scientificName", "genericName", "specificEpithet", "infraspecificEpithet", "scientificNameAuthorship", "rank"]
    rows = [tuple([k, *[q.get(f) for f in fields]]) for k, q in asked.items()]
    names = spark.createDataFrame(rows, "_key string, " + ", ".join(f"`{f}` string" for f in fields))
    return {r["_key"]: (r["usage"]["key"], r["diagnostics"] and r["diagnostics"]["matchType"], r["diagnostics"] and r["diagnostics"]["confidence"]) for r in taxonomy.match_taxa(names, backbone, **more).collect()}


def test_homonyms_are_ranked(spark):
    backbone = _backbone(spark, [
        (1, "Oenanthe", "Vieillot, 1816", "GENUS", "ACCEPTED", "Animalia", "Muscicapidae"), (2, "Oenanthe", "L.", "GENUS", "ACCEPTED", "Plantae", "Apiaceae"),
        (3, "Aus bus", "Smith, 1900", "SPECIES", "ACCEPTED", "Animalia", None), (4, "Aus bus", "Jones, 1950", "SPECIES", "ACCEPTED", "Animalia", None),
        (5, "Cus", None, "GENUS", "ACCEPTED", "Animalia", None), (6, "Cus", None, "SUBGENUS", "ACCEPTED", "Animalia", None),
        (7, "Dus eus", "X", "SPECIES", "ACCEPTED", "Animalia", None), (8, "Dus eus", "X", "SPECIES", "SYNONYM", "Animalia", None),
        (9, "Animalia", None, "KINGDOM", "ACCEPTED", "Animalia", None), (10, "Fus gus", None, "SPECIES", "ACCEPTED", "Plantae", None),
        (11, "Hus lus", None, "SPECIES", "ACCEPTED", "Animalia", None), (12, "Hus mus", None, "SPECIES", "ACCEPTED", "Animalia", None),
    ])
    asked = {
        "bird": {"scientificName": "Oenanthe", "kingdom": "Animalia"}, "plant": {"scientificName": "Oenanthe", "scientificNameAuthorship": "Linnaeus"},
        "plant by family": {"scientificName": "Oenanthe", "family": "Apiaceae"}, "plant in full": {"scientificName": "Oenanthe L."}, "nothing tells": {"scientificName": "Oenanthe"},
        "smith": {"scientificName": "Aus bus Smith, 1900"}, "jones": {"scientificName": "Aus bus", "scientificNameAuthorship": "(Jones 1950)"}, "stripped": {"scientificName": "Aus bus Jones", "scientificNameAuthorship": "Jones"},
        "neither": {"scientificName": "Aus bus", "kingdom": "Animalia"}, "genus": {"scientificName": "Cus", "rank": "genus"}, "subgenus": {"scientificName": "Cus", "rank": "SUBGENUS"},
        "accepted": {"scientificName": "Dus eus"}, "other kingdom": {"scientificName": "Fus gus", "kingdom": "Animalia"}, "two near": {"scientificName": "Hus nus", "kingdom": "Animalia"},
    }
    got = _match(spark, backbone, asked)
    assert {k: v[0] for k, v in got.items()} == {
        "bird": 1, "plant": 2, "plant by family": 2, "plant in full": 2, "nothing tells": 0, "smith": 3, "jones": 4, "stripped": 4, "neither": 9, "genus": 5, "subgenus": 6,
        "accepted": 7, "other kingdom": 9, "two near": 9,
    }
    assert got["bird"][1:] == ("EXACT", 93) and got["accepted"][2] == 82 and got["neither"][1] == "HIGHERRANK" and got["other kingdom"][1] == "HIGHERRANK"


def test_crowded_segments_are_dealt_out(spark):
    """Thousands of names share their first half; parts of it hold few, and the result is the same."""
    rows = [(k, f"Commonus{chr(97 + k % 26)}{chr(97 + k // 26 % 26)}{chr(97 + k // 676)} albus", None, "SPECIES", "ACCEPTED", "Animalia", None) for k in range(3000)]
    backbone = _backbone(spark, rows)
    index = taxonomy.name_index(backbone, 1, crowd=50)
    assert index.segments.groupBy("_s", "_bucket").count().agg(F.max("count")).first()[0] < 120 and index.crowded.count() > 0
    asked = {"a": {"scientificName": "Commonusaab albu", "kingdom": "Animalia"}, "b": {"scientificName": "Komonusaaa albus", "kingdom": "Animalia"}}
    assert _match(spark, index, asked) == _match(spark, taxonomy.name_index(backbone, 1), asked) and _match(spark, index, asked)["a"][1] == "FUZZY"


def test_sources_round_trip(spark, tmp_path):
    from fieldbook.schema import VERBATIM

    df = spark.createDataFrame([_record({"country": "x"}, [{"genus": "G"}])], VERBATIM)
    verbatim.write_views({"a": df}, str(tmp_path))
    verbatim.write_json(df, str(tmp_path / "j"))
    for path, fmt in ((str(tmp_path / "a"), "parquet"), (str(tmp_path / "j"), "json")):
        assert verbatim.read_verbatim(spark, path, fmt).collect() == df.collect()
    doc = json.loads(verbatim.to_json_lines(df).first()["json"])
    assert doc["id"] == "1" and doc["coreTerms"] == {uri("country"): "x"}


def test_settings(spark):
    assert prepare_session(spark).conf.get("spark.sql.adaptive.skewJoin.enabled") == "true"


def test_every_hot_key_is_split(spark):
    """No cap: two thousand keys of thirty rows are all spread."""
    left = spark.range(60_000).select(F.col("id").alias("i"), (F.col("id") % 2000).alias("k"))
    right = spark.range(2000).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v"))
    out = joins.skew_join(left, right, ["k"], "left", spread=["i"], hot_rows=20, buckets=3)
    assert out.where("v = 2 * k").count() == 60_000
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "GlobalLimit" not in plan and "Sort [" not in plan


def test_broadcast_is_checked_by_bytes(spark):
    wide = spark.range(10).select(F.repeat(F.lit("x"), 1000).alias("t"))
    assert joins.fits_broadcast(wide, 10) and not joins.fits_broadcast(wide, 10, max_bytes=5000)


def test_long_chains_and_rings(spark):
    rows = [(str(i), str(i + 1) if i < 20 else None, "t") for i in range(21)]
    events = spark.createDataFrame(rows, "id string, parentId string, eventType string")
    assert lineage.expand_lineage(events).where("size(parentsLineage) = 20").count() == 1
    # A chain of 1,500 takes as many rounds as its length has bits, and rings never hold them up.
    n = 1500
    pairs = [(str(k), str(k - 1) if k else None) for k in range(n)] + [(f"r{k}", f"r{(k + 1) % 700}") for k in range(700)] + [("tail", "r3"), ("last", str(n - 1))]
    found = {r["id"]: (r["n"], r["far"], r["issues"]) for r in lineage.expand_lineage(_events(spark, pairs)).select("id", F.size("parentsLineage").alias("n"), F.element_at("parentsLineage", -1)["id"].alias("far"), "issues").collect() if r["id"] in ("last", "tail", "r5", "0", "7")}
    assert found["last"][:2] == (n, "0") and found["7"][:2] == (7, "0") and found["tail"][2] == found["r5"][2] == [lineage.LOOP_ISSUE]


def test_three_letter_codes(spark, tmp_path):
    (tmp_path / "c.txt").write_text("# country,continent\nTUR,ASIA\nTUR,EUROPE\nDE,EUROPE\nXZZ,AFRICA\n")
    aliases = spark.createDataFrame([("Turkey", "TR", "TUR", "Turkey", None), ("Türkiye", "TR", "TUR", "Turkey", None)], "alias string, iso2 string, iso3 string, title string, region string")
    got = {r["country"]: r["continents"] for r in dims.load_country_continents(spark, str(tmp_path / "c.txt"), aliases).collect()}
    assert got == {"TR": ["ASIA", "EUROPE"], "DE": ["EUROPE"]}


def test_spelling_of_two_countries_is_not_resolved(spark):
    aliases = spark.createDataFrame([("Congo", "CG"), ("congo", "CD"), ("Chad", "TD")], "alias string, iso2 string")
    df = spark.createDataFrame([("Congo", None), ("Chad", None)], "country string, countryCode string")
    got = {r["country"]: (r["parsed_country"], r["parsed_country_issues"]) for r in country.parse_country(df, aliases).collect()}
    assert got["Congo"] == (None, ["COUNTRY_INVALID"]) and got["Chad"][0] == "TD"


@pytest.mark.parametrize("literal_rows", [0, 1000])
def test_empty_and_null_arrays_come_out_alike(spark, literal_rows):
    vocab = lookup.prepare_vocabulary(spark.createDataFrame([("t", "a", "A", None, None)], VOCABULARY))
    df = spark.createDataFrame([(1, ["a"]), (2, []), (3, None)], "i int, a array<string>")
    got = {r["i"]: r["o"] for r in lookup.lookup_values(df, "a", vocab, "t", "o", spread=["i"], literal_rows=literal_rows).collect()}
    assert len(got[1]) == 1 and got[2] == [] and got[3] is None


def test_null_keys_are_spread(spark):
    left = spark.range(900).select(F.col("id").alias("i"), F.when(F.col("id") % 3 == 0, F.col("id") % 5).alias("k"))
    right = spark.range(5).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v"))
    out = joins.spread_null_join(left, right, ["k"], spread=["i"])
    assert out.count() == 900 and out.where("k is null and v is null").count() == 600 and out.where("v = 2 * k").count() == 300


def test_interpret_rejects_and_publishing_country(spark):
    """Repeated ids do not multiply rows, and the country of a dataset is that of its records."""
    from datetime import datetime, timezone

    from pyspark.sql import types as T

    from fieldbook.plans.location import LocationDims, location_view
    from fieldbook.schema import VERBATIM

    def record(i, terms=None):
        return (i, None, DWC_NS + "Occurrence", {uri(k): v for k, v in (terms or {"country": "Chad"}).items()}, None)

    rows = spark.createDataFrame([record("1"), record("2"), record("2"), record(""), ("3", None, None, {}, None)], VERBATIM)
    valid, bad = records.split_valid(rows)
    once, twice = records.split_repeated(valid)
    assert [r["id"] for r in once.collect()] == ["1"]
    assert sorted(r["reason"] for r in bad.unionByName(twice).collect()) == ["CORE_TERMS_MISSING", "ID_MISSING", "ID_REPEATED", "ID_REPEATED"]

    cells = geocode.region_cells(spark.createDataFrame([], schema.REGION))
    aliases = [("Chad", "TD", "TCD", "Chad", "AFRICA"), ("Mali", "ML", "MLI", "Mali", "AFRICA"), ("ML", "ML", "MLI", "Mali", "AFRICA")]
    where = LocationDims(
        aliases=spark.createDataFrame(aliases, "alias string, iso2 string, iso3 string, title string, region string"),
        pairs=dims.load_country_pairs(spark),
        continents=spark.createDataFrame([("TD", ["AFRICA"])], "country string, continents array<string>"),
        vocabulary=lookup.prepare_vocabulary(spark.createDataFrame([], VOCABULARY)),
        cells=cells,
        centroids=spark.createDataFrame([], "lat double, lng double"),
        datasets=spark.createDataFrame([("a", "ML"), ("b", "Chad")], "datasetKey string, publishingCountry string"),
    )
    fields = T.StructType([*VERBATIM.fields, T.StructField("datasetKey", T.StringType())])
    named = record("3", {"country": "Chad", "publishingCountry": "Mali"})
    keyed = spark.createDataFrame([(*record("1"), "a"), (*record("2"), "b"), (*named, "b")], fields)
    view = location_view(keyed, where, datetime(2025, 1, 1, tzinfo=timezone.utc))
    assert {r["id"]: r["publishingCountry"] for r in view.collect()} == {"1": "ML", "2": "TD", "3": "ML"}


def test_views_in_buckets(spark, tmp_path):
    """Views that lie in buckets are joined without a shuffle; a failed run changes nothing."""
    from fieldbook.plans.occurrence import occurrence_view

    shared = ["coreId", "parentId", "created"]
    base = spark.range(500).selectExpr("cast(id as string) as id", *[f"'{c}' as {c}" for c in shared])
    views = {n: base.withColumns({n[0]: F.col("id"), "issues": F.array(F.lit(n.upper()))}) for n in ("basic", "taxon", "location", "temporal")}
    out = str(tmp_path / "views")
    verbatim.write_views({"verbatim": base.select("id", "coreId"), **views}, out, buckets=4)
    stored = verbatim.read_views(spark, out, ["verbatim", *views], 4)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = occurrence_view(stored["verbatim"], **{n: stored[n] for n in views})
        rows = joined.collect()
        plan = joined._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert "Exchange" not in plan and plan.count("SortMergeJoin") >= 4
    assert len(rows) == 500 and all(r["b"] == r["t"] == r["l"] == r["id"] and set(r["issues"]) == {"BASIC", "TAXON", "LOCATION", "TEMPORAL"} for r in rows)
    broken = base.select("id", F.raise_error(F.lit("no")).alias("x"))
    with pytest.raises(Exception, match="no"):
        verbatim.write_views({"basic": base.limit(1), "taxon": broken}, out, buckets=4)
    assert verbatim.read_views(spark, out, ["basic"], 4)["basic"].count() == 500
    verbatim.write_views({"basic": base.limit(3)}, out)
    assert verbatim.read_views(spark, out, ["basic"])["basic"].count() == 3 and sorted(p.name for p in tmp_path.iterdir() if p.name.endswith(".old")) == []


def test_unreadable_records_are_rejects(spark, tmp_path):
    from fieldbook.plans.occurrence import split_readable

    good = json.dumps({"id": "1", "coreTerms": {"a": "b"}})
    (tmp_path / "in.json").write_text("\n".join([good, '{"id": "2", "coreTerms": {', '{"id": "3", "coreTerms": "none"}', "", '{"coreTerms": {"a": "b"}}']))
    read = verbatim.read_verbatim(spark, str(tmp_path), "json", unreadable=True)
    kept, bad = split_readable(read)
    assert sorted(r["id"] or "" for r in kept.collect()) == ["", "1"] and "raw" not in kept.columns
    assert {(r["reason"], r["raw"]) for r in bad.collect()} == {("RECORD_UNREADABLE", '{"id": "2", "coreTerms": {'), ("RECORD_UNREADABLE", '{"id": "3", "coreTerms": "none"}')}
    valid, missing = records.split_valid(kept)
    rejects = missing.unionByName(bad, allowMissingColumns=True)
    assert valid.count() == 1 and sorted(r["reason"] for r in rejects.collect()) == ["ID_MISSING", "RECORD_UNREADABLE", "RECORD_UNREADABLE"]
    again = verbatim.read_verbatim(spark, str(tmp_path), "json")
    assert split_readable(again)[1].count() == 0 and again.count() == 4
