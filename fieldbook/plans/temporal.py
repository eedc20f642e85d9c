"""The temporal view: event date, date modified and date identified.  Row-local, no shuffle."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldbook.functions.dates import (
    EARLIEST_IDENTIFIED,
    EARLIEST_MODIFIED,
    bounded_date,
    common_ymd,
    day_of_year,
    event_date,
    parse_date_range,
)
from fieldbook.functions.issues import collect_issues, merge_issues
from fieldbook.functions.terms import term
from fieldbook.operators.identification import identification_fallback
from fieldbook.operators.records import carry_ids, has_terms

_PARTS = ("year", "month", "day", "eventDate", "startDayOfYear", "endDayOfYear")


def created(run_ts: datetime) -> Column:
    """The run time as epoch milliseconds."""
    return F.lit(int(run_ts.timestamp() * 1000))


def temporal_view(
    verbatim: DataFrame,
    run_ts: datetime,
    *,
    orderings: Sequence[str] = (),
    preprocess: Callable[[Column], Column] | None = None,
    explicit_end: bool = True,
) -> DataFrame:
    """One row per record.  Dates after the day that follows ``run_ts`` are unlikely."""
    upper = (run_ts.date() + timedelta(days=1)).isoformat()
    pre = preprocess or (lambda c: c)
    df = verbatim.withColumn("_ident", identification_fallback())
    df = df.select(
        *carry_ids(),
        has_terms().alias("_terms"),
        *[term(t).alias(f"t_{t}") for t in _PARTS],
        pre(term("modified")).alias("t_modified"),
        pre(term("dateIdentified", identification="_ident")).alias("t_dateIdentified"),
    )
    df = df.withColumns(
        {
            "_r": parse_date_range(
                *[F.col(f"t_{t}") for t in _PARTS], upper=upper, orderings=orderings, preprocess=preprocess
            ),
            "_m": bounded_date(F.col("t_modified"), EARLIEST_MODIFIED, upper, "MODIFIED_DATE", orderings),
            "_i": bounded_date(F.col("t_dateIdentified"), EARLIEST_IDENTIFIED, upper, "IDENTIFIED_DATE", orderings),
        }
    )
    start, end = F.col("_r.from"), F.col("_r.to")
    ymd = common_ymd(start, end)
    return df.select(
        "id",
        "coreId",
        "parentId",
        created(run_ts).alias("created"),
        ymd["year"].alias("year"),
        ymd["month"].alias("month"),
        ymd["day"].alias("day"),
        event_date(start, end, explicit_end).alias("eventDate"),
        day_of_year(start).alias("startDayOfYear"),
        day_of_year(end).alias("endDayOfYear"),
        F.col("_m.value").alias("modified"),
        F.col("_i.value").alias("dateIdentified"),
        F.lit(None).cast("string").alias("datePrecision"),
        merge_issues(F.col("_r.issues"), collect_issues(F.col("_m.issue"), F.col("_i.issue"))).alias("issues"),
    )
