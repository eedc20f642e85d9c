"""Numbers, counts, quantities and metre values out of text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from fieldbook.functions.binding import let
from fieldbook.functions.issues import collect_issues, flag
from fieldbook.functions.terms import trimmed

_PLAIN = r"^[+-]?(?:\d+\.?\d*|\.\d+)(?:[eE][+-]?\d{1,3})?$"
_DECIMAL_COMMA = r"^[+-]?\d+,\d+$"
_GROUPED = r"^[+-]?\d{1,3}(?:,\d{3})+\.\d+$"
_SPECIAL = r"^[+-]?(?:NaN|Infinity)$"

_LENGTH = r"[+-]?(?:\d{1,3}(?:,\d{3})+\.\d+|\d+(?:[.,]\d+)?|[.,]\d+)"
_UNIT = r"(?:m|mm|cm|km|metres?|meters?|metros?|mts?|mtrs?|ft|feet|foot|in|inch|inches|'|\")"
_ABOUT = r"(?i)^\s*(?:ca\.?|circa|c\.|~|about)?\s*"
_METRES = rf"{_ABOUT}({_LENGTH})\s*({_UNIT})?\s*\.?\s*$"
_SPAN = rf"{_ABOUT}({_LENGTH})\s*({_UNIT})?\s*(?:-|\x{{2013}}|to)\s*({_LENGTH})\s*({_UNIT})?\s*\.?\s*$"
_FOOT = 0.3048
_INCH = 0.0254

#: Bounds outside which a value cannot be a place on this planet, in metres.
ELEVATION_RANGE = (-11000.0, 17000.0)
DEPTH_RANGE = (0.0, 11000.0)

UNCERTAINTY_BOUNDS = (0.0, 20037509.0)
PRECISION_BOUNDS = (0.0, 1.0)


def round_half_up(c: Column, digits: int) -> Column:
    """Round with halves going towards positive infinity, as a double."""
    scale = float(10**digits)
    return F.floor(c * scale + 0.5) / F.lit(scale)


def parse_int(c: Column) -> Column:
    """Up to ten digits with an optional minus sign, as an int; null where it does not fit."""
    return F.when(F.regexp_like(c, F.lit(r"\A-?\d{1,10}\z")), c.try_cast("int"))


def parse_natural(c: Column) -> Column:
    """Up to ten digits, as an int; null where it does not fit."""
    return F.when(F.regexp_like(c, F.lit(r"\A\d{1,10}\z")), c.try_cast("int"))


def parse_count(c: Column) -> Column:
    """Struct of the count and, where text was given that is no count, the issue."""
    value = parse_natural(c)
    return F.struct(
        value.alias("value"),
        flag(c.isNotNull() & value.isNull(), "INDIVIDUAL_COUNT_INVALID").alias("issue"),
    )


def parse_double(c: Column) -> Column:
    """A double with a dot, a decimal comma, or thousands commas and a dot."""

    def read(v: Column) -> Column:
        return (
            F.when(v.rlike(_PLAIN), v.try_cast("double"))
            .when(v.rlike(_DECIMAL_COMMA), F.replace(v, F.lit(","), F.lit(".")).try_cast("double"))
            .when(v.rlike(_GROUPED), F.replace(v, F.lit(","), F.lit("")).try_cast("double"))
            .when(v.rlike(_SPECIAL), v.try_cast("double"))
        )

    return let(trimmed(c), read)


def finite(c: Column) -> Column:
    return F.when(~F.isnan(c) & (F.abs(c) != float("inf")), c)


def finite_double(c: Column) -> Column:
    """A double that is neither infinite nor NaN."""
    return let(parse_double(c), finite)


def relative_quantity(quantity: Column, quantity_type: Column, size: Column, unit: Column) -> Column:
    """Quantity over sample size where both are measured in the same unit."""
    same = (quantity_type != "") & (F.lower(quantity_type) == F.lower(unit))
    return F.when(same, finite(F.try_divide(quantity, size)))


def range_end(c: Column, high: bool) -> Column:
    """One end of a range of lengths (``10-20 m``) as the text of a length; other text as it is."""
    number, unit = (3, 4) if high else (1, 2)
    # The first unit may be left out: it is that of the second.
    units = F.regexp_extract(c, _SPAN, unit) if high else F.coalesce(F.nullif(F.regexp_extract(c, _SPAN, 2), F.lit("")), F.regexp_extract(c, _SPAN, 4))
    return F.when(c.rlike(_SPAN), F.concat(F.regexp_extract(c, _SPAN, number), units)).otherwise(c)


def parse_metres(c: Column, high: bool = False) -> Column:
    """A length as metres; feet, inches and metric multiples are converted.  The number may have
    a decimal comma, or thousands commas with a dot, as in ``parse_double``.  Of a range the lower
    end, or with ``high`` the upper one, is taken."""
    return let(range_end(c, high), _one_length)


def _one_length(c: Column) -> Column:
    text = F.regexp_extract(c, _METRES, 1)
    number = F.when(F.contains(text, F.lit(".")), F.replace(text, F.lit(","), F.lit(""))).otherwise(F.replace(text, F.lit(","), F.lit("."))).try_cast("double")
    unit = F.lower(F.regexp_extract(c, _METRES, 2))

    def convert(r: Column) -> Column:
        n, u = r["n"], r["u"]
        scaled = (
            F.when(u.isin("ft", "feet", "foot", "'"), n * _FOOT)
            .when(u.isin("in", "inch", "inches", '"'), n * _INCH)
            .when(u == "km", n * 1000.0)
            .when(u == "cm", n / 100.0)
            .when(u == "mm", n / 1000.0)
        )
        return F.when(u.isin("", "m") | n.isNull(), n).otherwise(F.coalesce(let(scaled, lambda v: round_half_up(v, 2)), n))

    return let(F.struct(number.alias("n"), unit.alias("u")), convert)


def not_metric(c: Column) -> Column:
    """True where a length was given in feet or inches."""
    return F.lower(F.regexp_extract(range_end(c, True), _METRES, 2)).isin(
        "ft", "feet", "foot", "'", "in", "inch", "inches", '"'
    )


def range_midpoint(low: Column, high: Column, kind: str) -> Column:
    """Midpoint and accuracy of a range given as text; ``kind`` is ELEVATION or DEPTH.  Where only one
    end is given, it may hold a whole range.

    Fails (null value, no issues) where neither end is a length or the midpoint is impossible."""
    bounds = ELEVATION_RANGE if kind == "ELEVATION" else DEPTH_RANGE
    foreign = F.coalesce(not_metric(low), F.lit(False)) | F.coalesce(not_metric(high), F.lit(False))

    def build(r: Column) -> Column:
        lo, hi = r["lo"], r["hi"]
        a = F.coalesce(lo, F.when(low.isNull(), r["other_lo"]), hi)
        b = F.coalesce(hi, F.when(high.isNull(), r["other_hi"]), lo)
        mid = (a + b) / 2.0
        issues = collect_issues(
            flag(lo > hi, f"{kind}_MIN_MAX_SWAPPED"),
            flag(foreign, f"{kind}_NOT_METRIC"),
            flag((low.isNotNull() & lo.isNull()) | (high.isNotNull() & hi.isNull()), f"{kind}_NON_NUMERIC"),
        )
        return F.when(
            mid.between(*bounds),
            F.struct(mid.alias("value"), (F.abs(b - a) / 2.0).alias("accuracy"), issues.alias("issues")),
        )

    ends = {"lo": parse_metres(low), "hi": parse_metres(high, True), "other_lo": parse_metres(high), "other_hi": parse_metres(low, True)}
    return let(F.struct(*[v.alias(n) for n, v in ends.items()]), build)


def uncertainty(c: Column) -> Column:
    """Absolute coordinate uncertainty within its exclusive bounds, else the issue."""
    given = F.coalesce(c != "", F.lit(False))

    def check(v: Column) -> Column:
        ok = F.coalesce((v > UNCERTAINTY_BOUNDS[0]) & (v < UNCERTAINTY_BOUNDS[1]), F.lit(False))
        return F.struct(
            F.when(ok, v).alias("value"),
            flag(given & ~ok, "COORDINATE_UNCERTAINTY_METERS_INVALID").alias("issue"),
        )

    return let(F.abs(_one_length(c)), check)


def precision(c: Column) -> Column:
    """Coordinate precision within its inclusive bounds, else the issue."""

    def check(v: Column) -> Column:
        ok = F.coalesce(v.between(*PRECISION_BOUNDS), F.lit(False))
        return F.struct(
            F.when(ok, v).alias("value"),
            flag(c.isNotNull() & ~ok, "COORDINATE_PRECISION_INVALID").alias("issue"),
        )

    return let(parse_double(c), check)
