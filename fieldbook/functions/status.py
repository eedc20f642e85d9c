"""Occurrence status out of count, stated status and basis of record."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from fieldbook.functions.issues import collect_issues, flag
from fieldbook.functions.numbers import parse_natural

PRESENT, ABSENT = "PRESENT", "ABSENT"
SPECIMENS = ("PRESERVED_SPECIMEN", "FOSSIL_SPECIMEN", "LIVING_SPECIMEN")


def occurrence_status(count: Column, status: Column, concept: Column, basis: Column) -> Column:
    """Struct of the status and its issues.

    ``count`` and ``status`` are null-aware text, ``concept`` is the PRESENT or ABSENT the status
    was looked up as (null for a miss).

    A stated status wins.  Where none is stated, or it is not understood, a usable count decides:
    zero means absent, unless a specimen without a stated status shows it was there."""
    n = parse_natural(count)
    said = F.when(status.isNotNull(), concept)
    unstated = status.isNull()
    unparsable = status.isNotNull() & said.isNull()
    specimen = F.coalesce(basis.isin(*SPECIMENS), F.lit(False))
    by_count = F.when(n == 0, ABSENT).otherwise(PRESENT)
    by_specimen = F.coalesce((n == 0) & unstated & specimen, F.lit(False))
    value = F.when(by_specimen, PRESENT).otherwise(F.coalesce(said, by_count))
    return F.struct(
        value.alias("value"),
        collect_issues(
            flag(unparsable, "OCCURRENCE_STATUS_UNPARSABLE"),
            flag(count.isNotNull() & n.isNull(), "INDIVIDUAL_COUNT_INVALID"),
            flag(by_specimen, "OCCURRENCE_STATUS_INFERRED_FROM_BASIS_OF_RECORD"),
            flag(
                n.isNotNull() & said.isNull() & ~by_specimen,
                "OCCURRENCE_STATUS_INFERRED_FROM_INDIVIDUAL_COUNT",
            ),
            flag(
                n.isNotNull() & (said != by_count),
                "INDIVIDUAL_COUNT_CONFLICTS_WITH_OCCURRENCE_STATUS",
            ),
        ).alias("issues"),
    )
