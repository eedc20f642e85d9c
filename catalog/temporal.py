"""Dates and date ranges."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog.base import Tables, joined, query
from fieldbook.functions import dates
from fieldbook.functions.dates import DMY

_UPPER = "2025-01-02"

#: A day in six spellings, for both engines: year, month, day and month name are given columns.
_SPELLINGS = (
    "case {k} % 6 when 0 then y || '-' || m || '-' || d when 1 then y || m || d when 2 then d || '/' || m || '/' || y"
    " when 3 then d || ' ' || mon || ' ' || y when 4 then y || '-' || m else y || '-' || m || '-' || d || 'T10:11:12Z' end"
)

_ORDER_PARTS = """
    SELECT o_orderkey, o_orderdate, strftime(o_orderdate, '%Y') AS y, strftime(o_orderdate, '%m') AS m, strftime(o_orderdate, '%d') AS d,
           strftime(o_orderdate, '%b') AS mon FROM orders
"""


def _dated(df, key: str, ts: str):
    return df.select(
        key, ts,
        *[F.date_format(ts, f).alias(n) for n, f in (("y", "yyyy"), ("m", "MM"), ("d", "dd"), ("mon", "MMM"))],
    )


@query(
    "date_spellings",
    f"""
    WITH p AS ({_ORDER_PARTS}), s AS (SELECT *, o_orderkey % 6 AS k FROM p)
    SELECT o_orderkey, CASE k WHEN 4 THEN y || '-' || m WHEN 5 THEN y || '-' || m || '-' || d || 'T10:11:12.000' ELSE y || '-' || m || '-' || d END AS iso,
      CASE k WHEN 4 THEN y || '-' || m || '-01T00:00:00.000' WHEN 5 THEN y || '-' || m || '-' || d || 'T10:11:12.000' ELSE y || '-' || m || '-' || d || 'T00:00:00.000' END AS earliest,
      CASE k WHEN 4 THEN strftime(last_day(o_orderdate), '%Y-%m-%d') || 'T23:59:59.999' WHEN 5 THEN y || '-' || m || '-' || d || 'T10:11:12.000' ELSE y || '-' || m || '-' || d || 'T23:59:59.999' END AS latest,
      CASE WHEN k <> 4 THEN dayofyear(o_orderdate) END AS day_of_year
    FROM s
    """,
)
def date_spellings(t: Tables):
    p = _dated(t.orders, "o_orderkey", "o_orderdate").select(
        "o_orderkey", dates.parse_date(F.expr(_SPELLINGS.format(k="o_orderkey")), [DMY]).alias("iso")
    )
    return p.select(
        "o_orderkey", "iso", dates.earliest(F.col("iso")).alias("earliest"), dates.latest(F.col("iso")).alias("latest"),
        dates.day_of_year(F.col("iso")).cast("bigint").alias("day_of_year"),
    )


@query(
    "event_date_ranges",
    f"""
    WITH p AS ({_ORDER_PARTS}), s AS (SELECT *, o_orderkey % 7 AS k, o_orderdate + INTERVAL 40 DAY AS e FROM p),
    r AS (SELECT o_orderkey, k, y, m, d,
      CASE k WHEN 0 THEN y || '-' || m || '-' || d WHEN 1 THEN y || '-' || m WHEN 2 THEN y || '-' || m || '-' || d WHEN 3 THEN NULL WHEN 4 THEN y || '-' || m || '-' || d
             WHEN 5 THEN strftime(o_orderdate, '%Y-%m-%d') ELSE NULL END AS f,
      CASE k WHEN 0 THEN strftime(e, '%Y-%m-%d') WHEN 1 THEN strftime(e, '%Y-%m') WHEN 2 THEN y || '-' || m || '-' || d WHEN 3 THEN NULL WHEN 4 THEN y || '-' || m || '-' || d
             WHEN 5 THEN strftime(o_orderdate, '%Y-%m-%d') ELSE NULL END AS t FROM s)
    SELECT o_orderkey, f || CASE WHEN k = 1 THEN '-01' ELSE '' END || 'T00:00:00.000' AS gte,
      CASE WHEN k = 1 THEN strftime(last_day(cast(t || '-01' AS date)), '%Y-%m-%d') ELSE t END || 'T23:59:59.999' AS lte,
      CASE WHEN f = t THEN f ELSE f || '/' || t END AS interval,
      CASE WHEN f[1:4] = t[1:4] THEN cast(f[1:4] AS integer) END AS year, CASE WHEN f[1:7] = t[1:7] THEN cast(f[6:7] AS integer) END AS month,
      CASE WHEN len(f) = 10 AND f = t THEN cast(f[9:10] AS integer) END AS day,
      CASE k WHEN 3 THEN 'RECORDED_DATE_MISMATCH' WHEN 4 THEN 'RECORDED_DATE_INVALID' WHEN 6 THEN 'RECORDED_DATE_UNLIKELY' ELSE '' END AS issues
    FROM r
    """,
)
def event_date_ranges(t: Tables):
    k = F.col("o_orderkey") % 7
    end = F.date_add(F.col("o_orderdate").cast("date"), 40)
    o = _dated(t.orders, "o_orderkey", "o_orderdate")
    full = F.date_format("o_orderdate", "yyyy-MM-dd")
    date = (
        F.when(k == 0, F.concat(full, F.lit("/"), F.date_format(end, "yyyy-MM-dd")))
        .when(k == 1, F.concat_ws("/", F.date_format("o_orderdate", "yyyy-MM"), F.date_format(end, "yyyy-MM")))
        .when(k == 2, F.col("y"))
        .when(k == 3, full)
        .when(k == 4, "some day")
        .when(k == 6, F.concat(F.lit("1068"), F.substring(full, 5, 6)))
    )
    # Text and parts agree, refine each other or contradict.
    year = F.when(k.isin(2, 4), F.col("y")).when(k == 3, "1704").when(k == 5, F.col("y"))
    month = F.when(k.isin(2, 3, 4), F.col("m"))
    day = F.when(k.isin(2, 3, 4), F.col("d"))
    doy = F.when(k == 5, F.dayofyear("o_orderdate").cast("string"))
    r = o.select("o_orderkey", dates.parse_date_range(year, month, day, date, doy, doy, upper=_UPPER).alias("r"))
    a, b = F.col("r.from"), F.col("r.to")
    r = r.select("o_orderkey", dates.event_date(a, b).alias("e"), dates.common_ymd(a, b).alias("y"), F.col("r.issues").alias("issues"))
    return r.select("o_orderkey", "e.gte", "e.lte", "e.interval", "y.year", "y.month", "y.day", joined(F.col("issues")).alias("issues"))


@query(
    "bounded_dates",
    """
    WITH s AS (SELECT l_orderkey, l_linenumber, l_partkey, l_linenumber % 5 AS k, strftime(l_shipdate, '%Y-%m-%d') AS v FROM lineitem)
    SELECT l_orderkey, l_linenumber, l_partkey, CASE WHEN k IN (0, 4) THEN v WHEN k = 3 THEN '1756' || v[5:] END AS identified,
      CASE k WHEN 1 THEN 'IDENTIFIED_DATE_UNLIKELY' WHEN 2 THEN 'IDENTIFIED_DATE_INVALID' END AS identified_issue,
      CASE WHEN k IN (0, 4) THEN v END AS modified, CASE k WHEN 1 THEN 'MODIFIED_DATE_UNLIKELY' WHEN 2 THEN 'MODIFIED_DATE_INVALID' WHEN 3 THEN 'MODIFIED_DATE_UNLIKELY' END AS modified_issue
    FROM s
    """,
)
def bounded_dates(t: Tables):
    k, v = F.col("l_linenumber") % 5, F.date_format("l_shipdate", "yyyy-MM-dd")
    text = F.when(k == 1, F.concat(F.lit("2099"), F.substring(v, 5, 3), F.lit("-28"))).when(k == 2, "n/a").when(k == 3, F.concat(F.lit("1756"), F.substring(v, 5, 6))).otherwise(v)
    s = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", text.alias("v")).select(
        "l_orderkey", "l_linenumber", "l_partkey",
        dates.bounded_date(F.col("v"), dates.EARLIEST_IDENTIFIED, _UPPER, "IDENTIFIED_DATE").alias("i"),
        dates.bounded_date(F.col("v"), dates.EARLIEST_MODIFIED, _UPPER, "MODIFIED_DATE").alias("m"),
    )
    return s.select(
        "l_orderkey", "l_linenumber", "l_partkey",
        F.col("i.value").alias("identified"), F.col("i.issue").alias("identified_issue"),
        F.col("m.value").alias("modified"), F.col("m.issue").alias("modified_issue"),
    )


@query(
    "epoch_bounds",
    """
    WITH s AS (SELECT event_id, event_id % 5 AS k, ts, date_trunc('second', ts) AS sec FROM events)
    SELECT event_id, strftime(ts, '%Y-%m-%dT%H:%M:%S.%g') AS millis,
      cast(epoch(CASE k WHEN 0 THEN date_trunc('year', ts) WHEN 1 THEN date_trunc('month', ts) WHEN 2 THEN date_trunc('day', ts) WHEN 3 THEN sec ELSE TIMESTAMP '1970-01-01' END) AS bigint) AS earliest,
      cast(epoch(CASE k WHEN 0 THEN date_trunc('year', ts) + INTERVAL 1 YEAR - INTERVAL 1 SECOND WHEN 1 THEN date_trunc('month', ts) + INTERVAL 1 MONTH - INTERVAL 1 SECOND
           WHEN 2 THEN date_trunc('day', ts) + INTERVAL 1 DAY - INTERVAL 1 SECOND WHEN 3 THEN sec ELSE TIMESTAMP '1970-12-31 23:59:59' END) AS bigint) AS latest,
      cast(epoch(CASE k WHEN 0 THEN date_trunc('year', ts) WHEN 1 THEN date_trunc('month', ts) WHEN 2 THEN date_trunc('day', ts) WHEN 3 THEN sec - INTERVAL 90 MINUTE ELSE TIMESTAMP '1970-01-01' END) AS bigint) AS exact
    FROM s
    """,
)
def epoch_bounds(t: Tables):
    k = F.col("event_id") % 5
    text = (
        F.when(k == 0, F.date_format("ts", "yyyy")).when(k == 1, F.date_format("ts", "yyyy-MM")).when(k == 2, F.date_format("ts", "yyyy-MM-dd"))
        .when(k == 3, F.concat(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss"), F.lit("+01:30"))).otherwise("0000")
    )
    return t.events.select("event_id", "ts", text.alias("v")).select(
        "event_id",
        dates.iso_millis(F.col("ts")).alias("millis"),
        dates.earliest_epoch(F.col("v")).alias("earliest"),
        dates.latest_epoch(F.col("v")).alias("latest"),
        dates.earliest_epoch(F.col("v"), ignore_offset=False).alias("exact"),
    )


@query(
    "preprocessed_dates",
    """
    SELECT o_orderpriority, strftime(o_orderdate, '%Y-%m') AS month, count(*) AS n FROM orders GROUP BY 1, 2
    """,
)
def preprocessed_dates(t: Tables):
    # A source that writes "ca. day.month.year".
    v = F.concat(F.lit("ca. "), F.date_format("o_orderdate", "d.M.yyyy"))
    nothing = F.lit(None).cast("string")
    r = dates.parse_date_range(
        nothing, nothing, nothing, F.col("v"), nothing, nothing,
        upper=_UPPER, orderings=[DMY], preprocess=lambda c: F.regexp_replace(c, r"^ca\.? *", ""),
    )
    o = t.orders.select("o_orderpriority", v.alias("v")).select("o_orderpriority", r["from"].alias("iso"))
    return o.groupBy("o_orderpriority", F.substring("iso", 1, 7).alias("month")).agg(F.count("*").alias("n"))
