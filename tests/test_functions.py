"""Edge rows of the scalar rules."""

import pytest
from pyspark.sql import functions as F

from fieldbook.functions import coords, dates, footprint, issues, numbers, shapes, status, terms, text


def test_null_aware(values):
    assert values(lambda c: terms.clean(terms.trimmed(c)), [" NULL ", "", "x ", None, "nullify"]) == [None, None, "x", None, "nullify"]
    # A blank that was not trimmed is a value.
    assert values(terms.clean, ["  "]) == ["  "]


def test_bounded(values):
    assert values(lambda c: F.length(terms.bounded(c)), ["a" * 31999, "a" * 32000, "é" * 16000]) == [31999, None, None]


def test_split(values):
    assert values(terms.split_values, ["a | | b", "b|a|b", " | ", "a;b"]) == [["a", "b"], ["b", "a", "b"], None, ["a;b"]]
    assert values(lambda c: terms.split_values(c, terms.PIPE_OR_SEMICOLON), ["a;b|c"]) == [["a", "b", "c"]]


def test_count(values):
    got = values(numbers.parse_count, ["3", "-1", "99999999999", None, "2147483648", "1.0", "0"])
    bad = "INDIVIDUAL_COUNT_INVALID"
    assert [tuple(r) for r in got] == [(3, None), (None, bad), (None, bad), (None, None), (None, bad), (None, bad), (0, None)]


def test_int_and_double(values):
    assert values(numbers.parse_int, ["-12", "+1", "12\n", "99999999999"]) == [-12, None, None, None]
    assert values(numbers.parse_double, ["1.5", "1,5", "1d", "1,234.5", "-.5", " 2 ", "1e3", "x", ""]) == [
        1.5, 1.5, None, 1234.5, -0.5, 2.0, 1000.0, None, None,
    ]
    assert values(numbers.finite_double, ["NaN", "Infinity", "7"]) == [None, None, 7.0]


def test_relative_quantity(values):
    def q(a, t, b, u):
        return numbers.relative_quantity(numbers.finite_double(a), t, numbers.finite_double(b), u)

    assert values(q, ["10", "10", "10"], ["g", "G", "g"], ["0", "4", "4"], ["g", "g", "m"]) == [None, 2.5, None]


def test_metres(values):
    assert values(numbers.parse_metres, ["100", "100 m", "100ft", "1.5 km", "-3", "x", "10-20", "12,5m", "ca. 5 metres"]) == [
        100.0, 100.0, 30.48, 1500.0, -3.0, None, 10.0, 12.5, 5.0,
    ]
    spans = ["10-20 m", "10 - 20ft", "1 km to 2 km", "ca. -10--5", "1.5–2,5 m", "10-20-30", "10-x", "5 m"]
    assert values(numbers.parse_metres, spans) == [10.0, 3.05, 1000.0, -10.0, 1.5, None, None, 5.0]
    assert values(lambda c: numbers.parse_metres(c, True), spans) == [20.0, 6.1, 2000.0, -5.0, 2.5, None, None, 5.0]
    got = values(lambda a, b: numbers.range_midpoint(a, b, "ELEVATION"), ["10-20 m", None, "10-20", "x", "100-200 ft"], [None, "10-30", "40", "10-20", None])
    assert [(r["value"], r["accuracy"], r["issues"]) for r in got] == [
        (15.0, 5.0, []), (20.0, 10.0, []), (25.0, 15.0, []), (20.0, 0.0, ["ELEVATION_NON_NUMERIC"]), (45.72, 15.24, ["ELEVATION_NOT_METRIC"]),
    ]
    got = values(lambda a, b: numbers.range_midpoint(a, b, "ELEVATION"), ["10", "20", None, "90000", "x"], ["20", "10", "7 ft", None, "4"])
    assert [(r and (r["value"], r["accuracy"], r["issues"])) for r in got] == [
        (15.0, 5.0, []),
        (15.0, 5.0, ["ELEVATION_MIN_MAX_SWAPPED"]),
        (2.13, 0.0, ["ELEVATION_NOT_METRIC"]),
        None,
        (4.0, 0.0, ["ELEVATION_NON_NUMERIC"]),
    ]


def test_uncertainty_and_precision(values):
    bad = "COORDINATE_UNCERTAINTY_METERS_INVALID"
    assert [tuple(r) for r in values(numbers.uncertainty, ["0", "-5", "20037509", None, "30"])] == [
        (None, bad), (5.0, None), (None, bad), (None, None), (30.0, None),
    ]
    bad = "COORDINATE_PRECISION_INVALID"
    assert [tuple(r) for r in values(numbers.precision, ["0", "1", "1.1", "x", None])] == [
        (0.0, None), (1.0, None), (None, bad), (None, bad), (None, None),
    ]


def test_names(values):
    assert values(text.clean_name, ["NORTH  SEA", "North Sea", "ÅLAND", "NO. 5", " a   b "]) == [
        "North sea", "North Sea", "Åland", "NO. 5", "a b",
    ]


def test_sex_and_life_stage(values):
    assert values(text.sex_from_text, ["sex: female; x", "male female", "Males", "sex=male; sex=female", "none", None]) == [
        "female", None, "males", None, None, None,
    ]
    assert values(text.life_stage_from_text, ["life stage: adult; x", "age class juvenile", "undetermined age: 3", "two chicks", "second year bird", ""]) == [
        "adult", "juvenile", None, "chicks", "second year", None,
    ]


def test_agents(values):
    got = values(text.agent_ids, ["https://orcid.org/0000-0001-2345-678x | Q12, https://www.wikidata.org/wiki/Q42", "", "a|a"])
    assert [r and [tuple(x) for x in r] for r in got] == [
        [
            ("ORCID", "https://orcid.org/0000-0001-2345-678X"),
            ("OTHER", "Q12"),
            ("WIKIDATA", "http://www.wikidata.org/entity/Q42"),
        ],
        None,
        [("OTHER", "a")],
    ]


def test_links_and_licences(values):
    got = values(text.reference_uri, ["http://a.org/x?y=1", "www.a.org/x", "not a link", "", None])
    assert [tuple(r) for r in got] == [
        ("http://a.org/x?y=1", None), ("http://www.a.org/x", None), (None, "REFERENCES_URI_INVALID"), (None, None), (None, None),
    ]
    assert values(text.license_name, [
        "http://creativecommons.org/licenses/by/4.0/legalcode", "https://creativecommons.org/publicdomain/zero/1.0/",
        "http://creativecommons.org/licenses/by-nc/4.0", "http://other.org/l", "free text", None,
    ]) == ["CC_BY_4_0", "CC0_1_0", "CC_BY_NC_4_0", "UNSUPPORTED", "UNSPECIFIED", "UNSPECIFIED"]


def test_typified_name(values):
    assert values(text.typified_name, [None, "Given name", None], ["Holotype of Dianthus fruticosus ssp. amorginus Runemark", "x", "Holotype"]) == [
        "Dianthus fruticosus ssp. amorginus Runemark", "Given name", None,
    ]


P, A = "PRESENT", "ABSENT"
UNPARSABLE = "OCCURRENCE_STATUS_UNPARSABLE"
BY_COUNT = "OCCURRENCE_STATUS_INFERRED_FROM_INDIVIDUAL_COUNT"
BY_BASIS = "OCCURRENCE_STATUS_INFERRED_FROM_BASIS_OF_RECORD"
CONFLICT = "INDIVIDUAL_COUNT_CONFLICTS_WITH_OCCURRENCE_STATUS"
BAD = "INDIVIDUAL_COUNT_INVALID"


@pytest.mark.parametrize(
    "count,stated,basis,want",
    [
        (None, None, "X", (P, [])),
        (None, "present", "X", (P, [])),
        (None, "absent", "X", (A, [])),
        (None, "??", "X", (P, [UNPARSABLE])),
        ("x", None, "X", (P, [BAD])),
        ("x", "absent", "X", (A, [BAD])),
        ("x", "??", "X", (P, [UNPARSABLE, BAD])),
        ("0", None, "PRESERVED_SPECIMEN", (P, [BY_BASIS])),
        ("0", None, "X", (A, [BY_COUNT])),
        ("0", "present", "X", (P, [CONFLICT])),
        ("0", "absent", "X", (A, [])),
        ("0", "??", "PRESERVED_SPECIMEN", (A, [UNPARSABLE, BY_COUNT])),
        ("2", None, "X", (P, [BY_COUNT])),
        ("2", "present", "X", (P, [])),
        ("2", "absent", "X", (A, [CONFLICT])),
        ("2", "??", "X", (P, [UNPARSABLE, BY_COUNT])),
    ],
)
def test_status(values, count, stated, basis, want):
    concept = {"present": P, "absent": A}.get(stated)
    got = values(status.occurrence_status, [count], [stated], [concept], [basis])[0]
    assert (got["value"], got["issues"]) == want


@pytest.mark.parametrize(
    "text_,iso",
    [
        ("2004", "2004"),
        ("2004-02", "2004-02"),
        ("2004-2", "2004-02"),
        ("2004/02", "2004-02"),
        ("2004-02-29", "2004-02-29"),
        ("2003-02-29", None),
        ("2004/2/9", "2004-02-09"),
        ("20040229", "2004-02-29"),
        ("2004-060", "2004-02-29"),
        ("2003-366", None),
        ("29.02.2004", "2004-02-29"),
        ("2/29/2004", "2004-02-29"),
        ("3/3/2004", "2004-03-03"),
        ("3/4/2004", None),
        ("29 February 2004", "2004-02-29"),
        ("Feb 29th, 2004", "2004-02-29"),
        ("Feb 2004", "2004-02"),
        ("Foo 2004", None),
        ("2004-02-29T10:11", "2004-02-29T10:11:00.000"),
        ("2004-02-29 10:11:12.12345", "2004-02-29T10:11:12.123"),
        ("2004-02-29T10:11:12Z", "2004-02-29T10:11:12.000"),
        ("2004-02-29T10:11:12+02:00", "2004-02-29T10:11:12.000"),
        ("2004-02-29T25:11:12", None),
        ("2004-13", None),
        ("nonsense", None),
        ("", None),
    ],
)
def test_parse_date(values, text_, iso):
    assert values(dates.parse_date, [text_]) == [iso]


def test_day_month_order(values):
    assert values(lambda c: dates.parse_date(c, ["DMY"]), ["3/4/2004", "2/29/2004"]) == ["2004-04-03", None]
    assert values(lambda c: dates.parse_date(c, ["DMY", "MDY"]), ["3/4/2004", "2/29/2004"]) == ["2004-04-03", "2004-02-29"]
    assert values(lambda c: dates.parse_date(c, ["MDY"]), ["3/4/2004"]) == ["2004-03-04"]


def _range(values, date=None, y=None, m=None, d=None, sd=None, ed=None):
    got = values(lambda *c: dates.parse_date_range(*c, upper="2026-01-01"), [y], [m], [d], [date], [sd], [ed])[0]
    return got["from"], got["to"], got["issues"]


def test_ranges(values):
    assert _range(values, "2003-04/2003-06") == ("2003-04", "2003-06", [])
    assert _range(values, "2003-04-01/15") == ("2003-04-01", "2003-04-15", [])
    assert _range(values, "2003-04-01/05-02") == ("2003-04-01", "2003-05-02", [])
    assert _range(values, "2003-04/06") == ("2003-04", "2003-06", [])
    assert _range(values, "2003/2004") == ("2003", "2004", [])
    assert _range(values, "2004/2003") == (None, None, ["RECORDED_DATE_INVALID"])
    assert _range(values, "2003-04-05", "2003", "4", "5") == ("2003-04-05", "2003-04-05", [])
    assert _range(values, "2003", "2003", "4", "5") == ("2003-04-05", "2003-04-05", [])
    assert _range(values, "2003-04-06", "2003", "4", "5") == (None, None, ["RECORDED_DATE_MISMATCH"])
    assert _range(values, "junk", "2003", "4", "5") == ("2003-04-05", "2003-04-05", ["RECORDED_DATE_INVALID"])
    assert _range(values, None, "2003", "13", "5") == (None, None, ["RECORDED_DATE_INVALID"])
    assert _range(values, None, "2003", None, None, "32", "60") == ("2003-02-01", "2003-03-01", [])
    assert _range(values, "1204-01-01") == (None, None, ["RECORDED_DATE_UNLIKELY"])
    assert _range(values, "2026-01-02") == (None, None, ["RECORDED_DATE_UNLIKELY"])
    assert _range(values, None) == (None, None, [])


def test_event_date(values):
    def full(a, b):
        return F.struct(dates.event_date(a, b).alias("e"), dates.common_ymd(a, b).alias("y"), dates.day_of_year(a).alias("n"))

    r = values(full, ["2003-04", "2004-02", "2004-02-29"], ["2003-06", "2004-02", "2004-02-29"])
    assert tuple(r[0]["e"]) == ("2003-04-01T00:00:00.000", "2003-06-30T23:59:59.999", "2003-04/2003-06")
    assert tuple(r[0]["y"]) == (2003, None, None)
    assert tuple(r[1]["e"]) == ("2004-02-01T00:00:00.000", "2004-02-29T23:59:59.999", "2004-02")
    assert (tuple(r[1]["y"]), r[1]["n"]) == ((2004, 2, None), None)
    assert (tuple(r[2]["y"]), r[2]["n"]) == ((2004, 2, 29), 60)
    r = values(lambda a, b: dates.event_date(a, b, explicit_end=False), ["2003-04", "2004"], ["2003-06", "2004"])
    assert [(x["gte"], x["lte"]) for x in r] == [("2003-04", "2003-06"), ("2004", None)]


def test_bounded_date(values):
    got = values(lambda c: dates.bounded_date(c, dates.EARLIEST_IDENTIFIED, "2026-01-01", "IDENTIFIED_DATE"), ["1752-12-31", "1753-01-01", "x", None, "2027"])
    assert [tuple(r) for r in got] == [
        (None, "IDENTIFIED_DATE_UNLIKELY"), ("1753-01-01", None), (None, "IDENTIFIED_DATE_INVALID"), (None, None), (None, "IDENTIFIED_DATE_UNLIKELY"),
    ]


def test_epochs(values):
    texts = ["1970", "0000", "1970-01-02", "1970-01-01T01:00:00+01:00", "1970-01", "x", ""]
    assert values(dates.earliest_epoch, texts) == [0, 0, 86400, 3600, 0, None, None]
    assert values(dates.latest_epoch, texts) == [31535999, 31535999, 172799, 3600, 2678399, None, None]
    assert values(lambda c: dates.earliest_epoch(c, False), ["1970-01-01T01:00:00+01:00"]) == [0]


def _pair(r):
    return r["lat"], r["lng"], r["issues"], r["ok"]


@pytest.mark.parametrize(
    "lat",
    ["43.63871944444445", "N43°38'19.39\"", "43°38'19.39\"N", "43d 38m 19.39s N", "43 38 19.39"],
)
def test_latitude_spellings(values, lat):
    lng = "10.5" if lat[0:3] == "43." else "10 30 0"
    r = values(coords.parse_lat_lng, [lat], [lng])[0]
    assert (r["lat"], r["lng"], r["ok"]) == (43.638719, 10.5, True)
    assert r["issues"] == (["COORDINATE_ROUNDED"] if lat[0:3] == "43." else [])


def test_coordinates(values):
    r = [_pair(x) for x in values(coords.parse_lat_lng, ["0", "120", "95", "x", "", None, "43°38.3232'N", "-2.0000005"], ["0", "40", "200", "1", "1", "1", "10°0'W", "1"])]
    assert r[0] == (0.0, 0.0, ["ZERO_COORDINATE"], True)
    assert r[1] == (40.0, 120.0, ["PRESUMED_SWAPPED_COORDINATE"], True)
    assert r[2] == (None, None, ["COORDINATE_OUT_OF_RANGE"], False)
    assert r[3] == (None, None, ["COORDINATE_INVALID"], False)
    assert r[4] == r[5] == (None, None, [], False)
    assert r[6] == (43.63872, -10.0, [], True)
    assert r[7] == (-2.0, 1.0, ["COORDINATE_ROUNDED"], True)


def test_pairs_and_points(values):
    r = [_pair(x) for x in values(coords.parse_verbatim_pair, ['02° 49\' 52" N 131° 47\' 03" E', '131° 47\' 03" E 02° 49\' 52" N', "12.5,30", "a b c", "12;30;40", None])]
    assert r[0][:2] == r[1][:2] == (2.831111, 131.784167)
    assert r[2] == (12.5, 30.0, [], True)
    assert r[3] == r[4] == (None, None, ["COORDINATE_INVALID"], False)
    assert r[5] == (None, None, [], False)
    r = [_pair(x) for x in values(coords.parse_point, ["POINT(30.29 -23.2)", "point ( 200 100 )", "POLYGON((1 1))", None])]
    assert r[0] == (-23.2, 30.29, [], True)
    assert r[1:] == [(None, None, [], False)] * 3


def test_pick(values):
    def pick(a, b, c):
        return coords.pick_coordinates(
            coords.parse_lat_lng(a, b), coords.parse_verbatim_pair(c), fallback=coords.parse_point(F.lit("POINT(1 2)"))
        )

    assert [_pair(x) for x in values(pick, ["1", "x"], ["1", "1"], ["5.0,6.0", "5.0,6.0"])] == [(1.0, 1.0, [], True), (5.0, 6.0, [], True)]
    assert _pair(values(pick, ["x"], ["y"], ["zzzzzz"])[0]) == (2.0, 1.0, [], True)


def test_wkt(values):
    texts = [
        "POLYGON((1 1, 2 2, 3 1, 1 1))", "polygon ((1 1,2 2,3 1,1 1),(1 1,2 2,3 1,1 1))", "LINESTRING(1 1, 2 2)", "MULTIPOLYGON(((1 1,2 2,3 1,1 1)))",
        "POLYGON((1 1", "POLYGON EMPTY", "foo", "GEOMETRYCOLLECTION(POINT(1 1),LINESTRING(1 1,2 2))",
        "POLYGON((1 1, 2 2, 3 1, 1 2))", "POLYGON((1 1, 1 1))", "POLYGON Z ((1 1 5, 2 2 5, 3e0 1 5, 1 1 5))", "MULTIPOLYGON(((1 1,2 2,3 1,1 1)), ((0 0, 1 1, 0 1)))",
        "LINESTRING(1 1)", "GEOMETRYCOLLECTION(POINT(1 1), GEOMETRYCOLLECTION(POLYGON((1 1, 2 2, 3 1, 1 1))))", "GEOMETRYCOLLECTION(POLYGON((1 1, 2 2, 3 1, 1 2)))",
        "MULTIPOINT(1 1, 2 2)", "GEOMETRYCOLLECTION(foo)", None,
    ]
    good = [True, True, True, True, False, True, False, True, False, False, True, False, False, True, False, True, False, None]
    assert values(footprint.valid_wkt, texts) == good


def test_read_rings(values):
    texts = ["MULTIPOLYGON(((0 0, 4 0, 4.5e0 4, 0 0), (1 1, 2 1, 2 2, 1 1)), ((9 9, 9 8, 8 8, 9 9)))", "polygon z ((0 0 1, 1 0 1, 1 1 1, 0 0 1))", "POLYGON((0 0, 1 0, 1 1, 0 1))", "POINT(1 1)", "x", None]
    rings = [None if r is None else [[tuple(p) for p in ring] for ring in r] for r in values(shapes.read_rings, texts)]
    assert rings[0] == [[(0, 0), (4, 0), (4.5, 4), (0, 0)], [(1, 1), (2, 1), (2, 2), (1, 1)], [(9, 9), (9, 8), (8, 8), (9, 9)]]
    assert rings[1:] == [[[(0, 0), (1, 0), (1, 1), (0, 0)]], None, None, None, None]


def test_issue_lists(values):
    assert values(lambda c: issues.collect_issues(issues.flag(c == "a", "A"), issues.flag(c == "a", "A"), F.lit("B")), ["a", "b"]) == [["A", "B"], ["B"]]
    assert values(lambda c: issues.has_geospatial_issue(F.array(c)), ["ZERO_COORDINATE", "X"]) == [True, False]


def test_metres_with_thousands(values):
    assert values(numbers.parse_metres, ["1,234.5 m", "1,000", "12,345.0", "2,5"]) == [1234.5, 1.0, 12345.0, 2.5]


def test_a_delimiter_at_the_edge_is_skipped(values):
    got = values(coords.parse_verbatim_pair, [",12 34", "12;34,", "/1"])
    assert got[0]["ok"] is False and "COORDINATE_INVALID" in got[0]["issues"]
    assert "COORDINATE_INVALID" in got[1]["issues"]


def test_blank_dates_are_not_given(values):
    got = values(lambda c: dates.bounded_date(c, dates.EARLIEST_IDENTIFIED, "2026-01-01", "D"), ["", "  ", "rubbish"])
    assert [g["issue"] for g in got] == [None, None, "D_INVALID"]
