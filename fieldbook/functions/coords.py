"""Coordinates out of text.  Results are structs of lat, lng, issues and ok."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from fieldbook.functions.binding import let
from fieldbook.functions.issues import collect_issues, flag, no_issues, union_issues
from fieldbook.functions.numbers import parse_double, round_half_up

# ---------------------------------------------------------------------------
# The spellings of degrees, minutes and seconds.
# ---------------------------------------------------------------------------

DMS = (
    r"\s*(\d{1,3})\s*[°dº go]"
    r"\s*([0-6]?\d)\s*['m ´’′]"
    r"\s*(?:([0-6]?\d(?:[,.]\d+)?)\s*(?:\"|''|s|´´|″)?)?\s*"
)
DM = r"\s*(\d{1,3})\s*[°dº go]\s*(?:([0-6]?\d(?:[,.]\d+)?)\s*['m ´’′]?)?\s*"
D = r"\s*(\d{1,3}(?:[,.]\d+)?)\s*(?:°|d|º| |g|o|)\s*"
POINT = r"(?i)^\s*POINT\s*\(\s*(-?\d{1,3}(?:[.]\d+)?)\s*[ ,;/]\s*\s*(-?\d{1,3}(?:[.]\d+)?)\s*\)\s*$"

_DMS_ONE = f"(?i)^{DMS}$"
_DM_ONE = f"(?i)^{DM}$"
_D_ONE = f"(?i)^{D}$"
_DMS_PAIR = f"(?i)^{DMS}([NSEOW])[ ,;/]?{DMS}([NSEOW])$"

DIGITS = 6


def result(lat: Column, lng: Column, issues: Column, ok: Column) -> Column:
    return F.struct(lat.alias("lat"), lng.alias("lng"), issues.alias("issues"), ok.alias("ok"))


def _failed(*names: str) -> Column:
    null = F.lit(None).cast("double")
    issues = F.array(*[F.lit(n) for n in names]) if names else no_issues()
    return result(null, null, issues, F.lit(False))


def _in_range(lat: Column, lng: Column) -> Column:
    return lat.between(-90.0, 90.0) & lng.between(-180.0, 180.0)


def validate_round(lat: Column, lng: Column) -> Column:
    """Round to six decimals and check the ranges; a pair that only fits swapped is swapped."""

    def check(r: Column) -> Column:
        la, lo = r["lat"], r["lng"]
        zero = (la == 0.0) & (lo == 0.0)
        good = _in_range(la, lo)
        swapped = ~good & ~la.between(-90.0, 90.0) & _in_range(lo, la)
        ok = F.coalesce(good | swapped, F.lit(False))
        return result(
            F.when(zero, 0.0).when(good, la).when(swapped, lo),
            F.when(zero, 0.0).when(good, lo).when(swapped, la),
            collect_issues(
                flag(~ok, "COORDINATE_OUT_OF_RANGE"),
                flag((la != r["lat0"]) | (lo != r["lng0"]), "COORDINATE_ROUNDED"),
                flag(swapped, "PRESUMED_SWAPPED_COORDINATE"),
                flag(zero, "ZERO_COORDINATE"),
            ),
            ok,
        )

    return let(
        F.struct(
            round_half_up(lat, DIGITS).alias("lat"), round_half_up(lng, DIGITS).alias("lng"),
            lat.alias("lat0"), lng.alias("lng0"),
        ),
        check,
    )


def _num(c: Column) -> Column:
    return F.coalesce(F.replace(c, F.lit(","), F.lit(".")).try_cast("double"), F.lit(0.0))


def _groups(c: Column, pattern: str, n: int) -> Column:
    """The groups of a text that matches as a whole, read in one pass; missing ones are empty."""
    return F.split(F.regexp_replace(c, pattern, "|".join(f"${i + 1}" for i in range(n))), r"\|")


def _degrees(parts: Column, start: int, n: int, sign: Column) -> Column:
    """Degrees out of ``n`` parts (degrees, minutes, seconds) from ``start`` on."""
    value = _num(F.get(parts, F.lit(start)))
    for i in range(1, n):
        value = value + _num(F.get(parts, F.lit(start + i))) / (60**i)
    return round_half_up(sign * value, DIGITS)


def _sign(letter: Column) -> Column:
    return F.when(letter.isin("N", "E", "O"), 1.0).otherwise(-1.0)


def parse_dms(c: Column, is_lat: bool) -> Column:
    """Degrees of one spelled coordinate, with an optional direction letter at either end."""
    letters = "NS" if is_lat else "EOW"

    def cut(v: Column) -> Column:
        first, last = F.substring(v, 1, 1), F.substring(v, -1, 1)
        front, back = F.contains(F.lit(letters), first), F.contains(F.lit(letters), last)
        return F.when(
            F.length(v) > 3,
            F.struct(
                F.when(front, first).when(back, last).otherwise("N").alias("dir"),
                F.when(front, F.substring(v, 2, 1 << 30))
                .when(back, F.substring(v, F.lit(1), F.length(v) - 1))
                .otherwise(v)
                .alias("body"),
            ),
        )

    def read(r: Column) -> Column:
        body, sign = r["body"], _sign(r["dir"])

        def value(pattern: str, n: int) -> Column:
            return let(_groups(body, pattern, n), lambda p: _degrees(p, 0, n, sign))

        return (
            F.when(body.rlike(_DMS_ONE), value(_DMS_ONE, 3))
            .when(body.rlike(_DM_ONE), value(_DM_ONE, 2))
            .when(body.rlike(_D_ONE), value(_D_ONE, 1))
        )

    return let(let(F.upper(F.trim(c)), cut), read)


def read_lat_lng(lat: Column, lng: Column) -> Column:
    """Struct of the two numbers as read, both plain or both spelled, not yet validated."""
    given = F.coalesce((lat != "") & (lng != ""), F.lit(False))

    def plain_or_spelled(p: Column) -> Column:
        plain = p["lat"].isNotNull() & p["lng"].isNotNull()
        # Most coordinates are plain numbers; the spelled forms are tried for the rest only.
        return F.when(plain, p).otherwise(
            F.struct(parse_dms(lat, True).alias("lat"), parse_dms(lng, False).alias("lng"))
        )

    numbers = F.struct(parse_double(lat).alias("lat"), parse_double(lng).alias("lng"))
    return let(
        F.when(given, let(numbers, plain_or_spelled)),
        lambda r: F.struct(r["lat"].alias("lat"), r["lng"].alias("lng"), given.alias("given")),
    )


def check_read(c: Column) -> Column:
    """Validate what :func:`read_lat_lng` or :func:`read_verbatim_pair` gave."""
    return let(
        c,
        lambda r: F.when(~r["given"], _failed())
        .when(F.coalesce(F.isnan(r["lat"]) | F.isnan(r["lng"]), F.lit(True)) | r["lat"].isNull() | r["lng"].isNull(), _failed("COORDINATE_INVALID"))
        .otherwise(validate_round(r["lat"], r["lng"])),
    )


def parse_lat_lng(lat: Column, lng: Column) -> Column:
    """A latitude and a longitude, as numbers or as degrees, minutes and seconds."""
    return check_read(read_lat_lng(lat, lng))


def read_verbatim_pair(c: Column) -> Column:
    """Both coordinates in one text: spelled in either order, or split at the one delimiter."""

    def half(parts: Column, start: int) -> Column:
        letter = F.upper(F.get(parts, F.lit(start + 3)))
        return F.struct(
            letter.isin("N", "S").alias("is_lat"), _degrees(parts, start, 3, _sign(letter)).alias("v")
        )

    def spelled(r: Column) -> Column:
        a, b = r["a"], r["b"]
        return F.struct(
            F.when(a["is_lat"] & ~b["is_lat"], a["v"]).when(~a["is_lat"] & b["is_lat"], b["v"]).alias("lat"),
            F.when(a["is_lat"] & ~b["is_lat"], b["v"]).when(~a["is_lat"] & b["is_lat"], a["v"]).alias("lng"),
            F.lit(True).alias("given"),
        )

    def leaves_two_parts(d: str) -> Column:
        once = F.length(c) - F.length(F.replace(c, F.lit(d), F.lit(""))) == 1
        return once & F.instr(c, F.lit(d)).between(F.lit(2), F.length(c) - 1)

    delimiter = F.coalesce(*[F.when(leaves_two_parts(d), F.lit(d)) for d in (",", ";", "/", " ")])
    cut = F.when(F.length(c) > 4, F.instr(c, delimiter))
    null = F.lit(None).cast("double")
    halves = let(
        cut,
        lambda at: let(
            F.struct(F.substring(c, F.lit(1), at - 1).alias("a"), F.substring(c, at + 1, F.length(c)).alias("b")),
            lambda h: F.when(at > 0, read_lat_lng(h["a"], h["b"])).otherwise(
                F.struct(null.alias("lat"), null.alias("lng"), F.lit(True).alias("given"))
            ),
        ),
    )
    pair = let(_groups(c, _DMS_PAIR, 8), lambda p: F.struct(half(p, 0).alias("a"), half(p, 4).alias("b")))
    return (
        F.when(F.coalesce(c == "", F.lit(True)), F.struct(null.alias("lat"), null.alias("lng"), F.lit(False).alias("given")))
        .when(c.rlike(_DMS_PAIR), let(pair, spelled))
        .otherwise(halves)
    )


def parse_verbatim_pair(c: Column) -> Column:
    return check_read(read_verbatim_pair(c))


def parse_point(c: Column) -> Column:
    """A POINT(lng lat) footprint; anything else fails without an issue."""
    read = validate_round(
        F.regexp_extract(c, POINT, 2).try_cast("double"), F.regexp_extract(c, POINT, 1).try_cast("double")
    )
    return F.when(c.rlike(POINT), let(read, lambda r: F.when(r["ok"], r).otherwise(_failed()))).otherwise(_failed())


def pick_coordinates(*candidates: Column, fallback: Column | None = None) -> Column:
    """The first candidate that succeeded; if none did, the issues of all of them.

    The fallback comes last and adds no issues of its own."""
    null = F.lit(None).cast("double")

    def choose(all_: Column) -> Column:
        pooled = union_issues(F.flatten(F.transform(all_, lambda c: c["issues"])))
        return F.coalesce(
            F.get(F.filter(all_, lambda c: c["ok"]), F.lit(0)),
            F.when(fallback["ok"], fallback) if fallback is not None else F.lit(None),
            result(null, null, pooled, F.lit(False)),
        )

    return let(F.array(*candidates), choose)
