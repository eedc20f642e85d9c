"""Partial dates and date ranges.

A partial date is held as *canonical ISO text*: ``yyyy``, ``yyyy-MM``, ``yyyy-MM-dd`` or
``yyyy-MM-ddTHH:mm:ss.SSS``.  Its length is its precision, text order is time order, and both
bounds are cheap text functions, so nothing has to be re-parsed downstream.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from fieldbook.functions.binding import let
from fieldbook.functions.issues import collect_issues, flag

#: Orders in which an all-digit day and month are tried.  Empty: only where there is no doubt.
DMY, MDY = "DMY", "MDY"

EARLIEST_RECORDED = "1600-01-01"
EARLIEST_MODIFIED = "1970-01-01"
EARLIEST_IDENTIFIED = "1753-01-01"

_MONTHS = "janfebmaraprmayjunjulaugsepoctnovdec"
_FILL_LOW = "0000-01-01T00:00:00.000"

_ISO = r"^(\d{4})(?:-(\d{2})(?:-(\d{2})(?:[T ](\d{2}):(\d{2})(?::(\d{2})(?:[.,](\d{1,9}))?)?)?)?)?\s*(?:Z|[+-]\d{2}(?::?\d{2}){0,2})?$"
_FULL_DATE = r"^\d{4}-\d{2}-\d{2}\z"
_YMD_LOOSE = r"^(\d{4})([-/.])(\d{1,2})(?:\2(\d{1,2}))?$"
_COMPACT = r"^(\d{4})(\d{2})(\d{2})$"
_ORDINAL = r"^(\d{4})-(\d{3})$"
_AB_YEAR = r"^(\d{1,2})([-/.])(\d{1,2})\2(\d{4})$"
# Both orders give the same day, or only one of them gives any.
_FIRST_IS_DAY = r"^(?:1[3-9]|[23]\d)[-/.]|^0?(\d{1,2})[-/.]0?\1[-/.]"
_SECOND_IS_DAY = r"^\d{1,2}[-/.](?:1[3-9]|[23]\d)[-/.]"
_DAY_NAME_YEAR = r"^(\d{1,2})(?:st|nd|rd|th)?[ .-]+([A-Za-z]{3,9})[ .,-]+(\d{4})$"
_NAME_DAY_YEAR = r"^([A-Za-z]{3,9})[ .-]+(\d{1,2})(?:st|nd|rd|th)?[ ,]+(\d{4})$"
_NAME_YEAR = r"^([A-Za-z]{3,9})[ .,-]+(\d{4})$"


def _pad2(c: Column) -> Column:
    return F.lpad(c, 2, "0")


def _part(parts: Column, i: int) -> Column:
    return F.nullif(F.get(parts, F.lit(i)), F.lit(""))


def _month(c: Column) -> Column:
    """Two digits of a month given as a number or by name."""
    by_name = F.lit(_MONTHS)
    at = F.instr(by_name, F.lower(F.substring(c, 1, 3)))
    return F.when(c.rlike("^[0-9]"), _pad2(c)).when(at % 3 == 1, _pad2(((at + 2) / 3).cast("int").cast("string")))


def _fields(s: Column, orderings: Sequence[str]) -> Column:
    """Any known spelling as ``y|m|d|H|M|S|fraction`` text; what is missing is empty."""
    if orderings:
        spelled = [F.regexp_replace(s, _AB_YEAR, "$4|$3|$1" if o == DMY else "$4|$1|$3") for o in orderings]
        day_month = F.coalesce(
            *[F.when(F.regexp_replace(x, r"\|", "-").try_cast("date").isNotNull(), x) for x in spelled]
        )
    else:
        day_month = (
            F.when(s.rlike(_FIRST_IS_DAY), F.regexp_replace(s, _AB_YEAR, "$4|$3|$1"))
            .when(s.rlike(_SECOND_IS_DAY), F.regexp_replace(s, _AB_YEAR, "$4|$1|$3"))
        )
    ordinal = ordinal_date(F.substring(s, 1, 4), F.substring(s, 6, 3).try_cast("int"))
    return (
        F.when(s.rlike(_ISO), F.regexp_replace(s, _ISO, "$1|$2|$3|$4|$5|$6|$7"))
        .when(s.rlike(_YMD_LOOSE), F.regexp_replace(s, _YMD_LOOSE, "$1|$3|$4"))
        .when(s.rlike(_COMPACT), F.regexp_replace(s, _COMPACT, "$1|$2|$3"))
        .when(s.rlike(_ORDINAL), F.regexp_replace(ordinal, "-", "|"))
        .when(s.rlike(_AB_YEAR), day_month)
        .when(s.rlike(_DAY_NAME_YEAR), F.regexp_replace(s, _DAY_NAME_YEAR, "$3|$2|$1"))
        .when(s.rlike(_NAME_DAY_YEAR), F.regexp_replace(s, _NAME_DAY_YEAR, "$3|$1|$2"))
        .when(s.rlike(_NAME_YEAR), F.regexp_replace(s, _NAME_YEAR, "$2|$1"))
    )


def _assembled(parts: Column) -> Column:
    """Canonical text of the fields, their values still unchecked."""
    y, m, d = _part(parts, 0), _part(parts, 1), _part(parts, 2)
    hour = _part(parts, 3)
    time = F.concat(
        F.lit("T"), hour, F.lit(":"), _part(parts, 4), F.lit(":"), F.coalesce(_part(parts, 5), F.lit("00")),
        F.lit("."), F.rpad(F.substring(F.coalesce(_part(parts, 6), F.lit("")), 1, 3), 3, "0"),
    )
    month = F.concat(F.lit("-"), _month(m))
    day = F.concat(F.lit("-"), _pad2(d))
    return (
        F.when(m.isNull(), y)
        .when(d.isNull(), F.concat(y, month))
        .when(hour.isNull(), F.concat(y, month, day))
        .otherwise(F.concat(y, month, day, time))
    )


def _checked(iso: Column) -> Column:
    """The canonical text, or null where it names no day or time that exists."""
    n = F.length(iso)
    return (
        F.when((n == 4) & (iso != "0000"), iso)
        .when((n == 7) & F.substring(iso, 6, 2).between("01", "12"), iso)
        .when((n == 10) & iso.try_cast("date").isNotNull(), iso)
        .when((n == 23) & iso.try_cast("timestamp_ntz").isNotNull(), iso)
    )


def parse_date(c: Column, orderings: Sequence[str] = ()) -> Column:
    """Any known spelling of a date as canonical text, else null.  Offsets are dropped."""

    def read(s: Column) -> Column:
        # Most dates are canonical as they stand, and need no more than the check.
        other = let(let(F.split(_fields(s, orderings), r"\|"), _assembled), _checked)
        return F.when(s.rlike(_FULL_DATE), F.when(s.try_cast("date").isNotNull(), s)).otherwise(other)

    return let(F.trim(c), read)


def ordinal_date(year: Column, day_of_year: Column) -> Column:
    """Canonical date of a day of a year; null where the year has no such day."""
    day = F.date_add(F.concat(year, F.lit("-01-01")).try_cast("date"), day_of_year - 1)
    return F.when(F.year(day) == year.try_cast("int"), F.date_format(day, "yyyy-MM-dd"))


def partial_from_parts(year: Column, month: Column, day: Column) -> Column:
    """Canonical text out of separate year, month and day; null where a given part is no part."""
    y, m, d = F.trim(year), F.trim(month), F.trim(day)
    has_m, has_d = F.coalesce(m != "", F.lit(False)), F.coalesce(d != "", F.lit(False))
    number = r"^\d{1,2}$"
    iso = F.when(
        y.rlike(r"^\d{4}$") & (~has_m | m.rlike(number)) & (~has_d | (has_m & d.rlike(number))),
        F.concat(
            y,
            F.when(has_m, F.concat(F.lit("-"), _pad2(m))).otherwise(""),
            F.when(has_d, F.concat(F.lit("-"), _pad2(d))).otherwise(""),
        ),
    )
    return let(iso, _checked)


def earliest(iso: Column) -> Column:
    """First instant of a partial date, as local date-time text with milliseconds."""
    return F.concat(iso, F.substring(F.lit(_FILL_LOW), F.length(iso) + 1, F.lit(23)))


def latest(iso: Column) -> Column:
    """Last instant of a partial date, as local date-time text with milliseconds."""
    end = "T23:59:59.999"
    n = F.length(iso)
    return (
        F.when(n == 4, F.concat(iso, F.lit("-12-31" + end)))
        .when(
            n == 7,
            F.concat(
                F.date_format(F.last_day(F.concat(iso, F.lit("-01")).try_cast("date")), "yyyy-MM-dd"),
                F.lit(end),
            ),
        )
        .when(n == 10, F.concat(iso, F.lit(end)))
        .when(n == 23, iso)
    )


# --- ranges ------------------------------------------------------------------------------------

_RANGE = r"^\s*\d{4}[^/]*/[^/]+$"


def _looks_like_range(s: Column) -> Column:
    # A bare year, a slash and one or two digits is a year and month.
    return s.rlike(_RANGE) & ~s.rlike(r"^\s*\d{4}/\d{1,2}\s*$")


def _full_end(left: Column, right: Column) -> Column:
    n = F.length(left)
    return (
        F.when(right.rlike(r"^\d{1,2}$") & (n == 10), F.concat(F.substring(left, 1, 8), _pad2(right)))
        .when(right.rlike(r"^\d{1,2}$") & (n == 7), F.concat(F.substring(left, 1, 5), _pad2(right)))
        .when(right.rlike(r"^\d{2}-\d{2}$") & (n == 10), F.concat(F.substring(left, 1, 5), right))
        .when(
            right.rlike(r"^\d{2}:\d{2}(?::\d{2}(?:\.\d{1,9})?)?Z?$") & (n > 10),
            F.concat(F.substring(left, 1, 11), right),
        )
        .otherwise(right)
    )


def range_parts(c: Column) -> Column:
    """Both ends of ``from/to`` text, as an array; the end may leave out what it shares with the
    start.  Text that is no range has one end."""
    ends = let(
        F.transform(F.split(c, "/"), lambda p: F.trim(p)),
        lambda p: F.array(F.get(p, F.lit(0)), _full_end(F.get(p, F.lit(0)), F.get(p, F.lit(1)))),
    )
    return F.when(F.contains(c, F.lit("/")) & _looks_like_range(c), ends).otherwise(F.array(c))


def read_date_range(
    year: Column,
    month: Column,
    day: Column,
    date: Column,
    start_day: Column,
    end_day: Column,
    *,
    orderings: Sequence[str] = (),
    preprocess: Callable[[Column], Column] | None = None,
) -> Column:
    """What the text and the separate parts say, unreconciled."""
    text = preprocess(date) if preprocess else date
    ends = F.transform(range_parts(text), lambda p: parse_date(p, orderings))
    parts = partial_from_parts(year, month, day)
    first, last = F.trim(start_day).try_cast("int"), F.trim(end_day).try_cast("int")
    days = let(
        parts,
        lambda p: F.when(
            (F.length(p) == 4) & first.isNotNull(),
            F.array(ordinal_date(p, first), ordinal_date(p, F.coalesce(last, first))),
        ),
    )
    return F.struct(
        ends.alias("text"),
        parts.alias("parts"),
        days.alias("days"),
        F.coalesce(F.trim(text) != "", F.lit(False)).alias("text_given"),
        F.coalesce(F.trim(F.concat_ws("", year, month, day)) != "", F.lit(False)).alias("parts_given"),
    )


def _ends(read: Column) -> Column:
    """From and to of the text and of the parts, each pair only where it is in order."""
    text, days, parts = read["text"], read["days"], read["parts"]
    t_from, t_to = F.get(text, F.lit(0)), F.element_at(text, -1)
    d_from, d_to = F.get(days, F.lit(0)), F.get(days, F.lit(1))
    t_ok = F.when(F.size(text) == 1, True).otherwise(earliest(t_from) <= latest(t_to))
    d_ok = F.coalesce(d_from <= d_to, F.lit(False))
    return F.struct(
        F.when(t_ok, t_from).alias("tf"),
        F.when(t_ok, t_to).alias("tt"),
        F.when(d_ok, d_from).otherwise(parts).alias("pf"),
        F.when(d_ok, d_to).otherwise(parts).alias("pt"),
        read["text_given"].alias("text_given"),
        read["parts_given"].alias("parts_given"),
    )


def _chosen(e: Column) -> Column:
    tf, tt, pf, pt = e["tf"], e["tt"], e["pf"], e["pt"]
    both = tf.isNotNull() & pf.isNotNull()
    apart = F.when(both, (earliest(pf) > latest(tt)) | (latest(pt) < earliest(tf))).otherwise(False)
    finer = F.coalesce(both & (tf == tt) & (F.length(pf) > F.length(tf)), F.lit(False))
    by_parts = tf.isNull() | finer
    bad = (e["text_given"] & tf.isNull()) | (e["parts_given"] & pf.isNull())
    return F.struct(
        F.when(~apart, F.when(by_parts, pf).otherwise(tf)).alias("from"),
        F.when(~apart, F.when(by_parts, pt).otherwise(tt)).alias("to"),
        apart.alias("apart"),
        bad.alias("bad"),
    )


def parse_date_range(
    year: Column,
    month: Column,
    day: Column,
    date: Column,
    start_day: Column,
    end_day: Column,
    *,
    upper: Column | str,
    lower: str = EARLIEST_RECORDED,
    orderings: Sequence[str] = (),
    preprocess: Callable[[Column], Column] | None = None,
) -> Column:
    """The event date as a struct of canonical ``from`` and ``to`` and the issue list.

    Text wins over separate parts where they agree and it is at least as precise; parts that
    contradict the text fail the whole.  Days of the year refine a bare year.  Dates outside
    ``[lower, upper]`` are unlikely and dropped."""
    top = F.lit(upper) if isinstance(upper, str) else upper

    def bounded(c: Column) -> Column:
        unlikely = F.coalesce(
            (F.substring(earliest(c["from"]), 1, 10) < lower) | (F.substring(earliest(c["to"]), 1, 10) > top),
            F.lit(False),
        )
        return F.struct(
            F.when(~unlikely, c["from"]).alias("from"),
            F.when(~unlikely, c["to"]).alias("to"),
            collect_issues(
                flag(c["apart"], "RECORDED_DATE_MISMATCH"),
                flag(c["bad"], "RECORDED_DATE_INVALID"),
                flag(unlikely, "RECORDED_DATE_UNLIKELY"),
            ).alias("issues"),
        )

    read = read_date_range(
        year, month, day, date, start_day, end_day, orderings=orderings, preprocess=preprocess
    )
    return let(let(let(read, _ends), _chosen), bounded)


def common_ymd(start: Column, end: Column) -> Column:
    """Year, month and day, each only where both ends agree on it and on what is above it."""

    def part(prefix: int, pos: int, n: int) -> Column:
        return F.when(
            (F.length(start) >= prefix)
            & (F.length(end) >= prefix)
            & (F.substring(start, 1, prefix) == F.substring(end, 1, prefix)),
            F.substring(start, pos, n).cast("int"),
        )

    return F.struct(part(4, 1, 4).alias("year"), part(7, 6, 2).alias("month"), part(10, 9, 2).alias("day"))


def day_of_year(iso: Column) -> Column:
    """Day of the year, for full dates only."""
    return F.when(F.length(iso) >= 10, F.dayofyear(F.substring(iso, 1, 10).try_cast("date")))


def event_date(start: Column, end: Column, explicit_end: bool = True) -> Column:
    """Struct of the first instant, the last instant and the interval text.

    Without ``explicit_end`` the ends stay partial, and the last is set only if it differs."""
    interval = F.when(start == end, start).otherwise(F.concat(start, F.lit("/"), end))
    interval = F.regexp_replace(interval, r"(T\d{2}:\d{2}:\d{2})\.000", "$1")
    if explicit_end:
        gte, lte = earliest(start), latest(end)
    else:
        gte, lte = start, F.when(start != end, end)
    return F.struct(gte.alias("gte"), lte.alias("lte"), interval.alias("interval"))


def bounded_date(
    c: Column, lower: str, upper: Column | str, prefix: str, orderings: Sequence[str] = ()
) -> Column:
    """Struct of a date within its bounds and an issue ``{prefix}_UNLIKELY`` or ``_INVALID``."""
    top = F.lit(upper) if isinstance(upper, str) else upper

    def check(iso: Column) -> Column:
        inside = F.substring(earliest(iso), 1, 10).between(F.lit(lower), top)
        return F.struct(
            F.when(inside, iso).alias("value"),
            F.when(~inside, f"{prefix}_UNLIKELY")
            .when((F.trim(c) != "") & iso.isNull(), f"{prefix}_INVALID")
            .alias("issue"),
        )

    return let(parse_date(c, orderings), check)


# --- plain ISO text ----------------------------------------------------------------------------

_STRICT = r"^\d{4}(?:-\d{2}(?:-\d{2}(?:T\d{2}:\d{2}(?::\d{2}(?:\.\d{1,9})?)?)?)?)? ?(?:Z|[+-]\d{2}(?::?\d{2}){0,2})?$"
_OFFSET = r"(Z|[+-]\d{2}(?::?\d{2}){0,2})$"


def parse_partial(c: Column) -> Column:
    """ISO text of any precision as canonical text; a leading 0000 stands for 1970."""
    return let(F.regexp_replace(c, r"^0000", "1970"), lambda s: F.when(s.rlike(_STRICT), parse_date(s)))


def _offset_seconds(c: Column) -> Column:
    off = F.when(F.contains(c, F.lit("T")), F.regexp_extract(c, _OFFSET, 1))
    digits = F.rpad(F.regexp_replace(off, r"[^0-9]", ""), 6, "0")
    secs = let(
        digits,
        lambda d: F.substring(d, 1, 2).cast("int") * 3600
        + F.substring(d, 3, 2).cast("int") * 60
        + F.substring(d, 5, 2).cast("int"),
    )
    return F.coalesce(F.when(F.startswith(off, F.lit("-")), -secs).otherwise(secs), F.lit(0))


def _epoch(instant: Column, c: Column, ignore_offset: bool) -> Column:
    secs = F.unix_timestamp(F.concat(F.substring(instant, 1, 19), F.lit("Z")).try_cast("timestamp"))
    return secs if ignore_offset else secs - _offset_seconds(c)


def earliest_epoch(c: Column, ignore_offset: bool = True) -> Column:
    """Epoch second (UTC) of the first instant of ISO text."""
    return _epoch(let(parse_partial(c), earliest), c, ignore_offset)


def latest_epoch(c: Column, ignore_offset: bool = True) -> Column:
    """Epoch second (UTC) of the last instant of ISO text."""
    return _epoch(let(parse_partial(c), latest), c, ignore_offset)


def iso_millis(c: Column) -> Column:
    """A timestamp as local date-time text with milliseconds."""
    return F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss.SSS")
