"""Quality flags: arrays of issue names, in insertion order and without repeats."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from fieldbook.schema import GEOSPATIAL_ISSUES


def flag(condition: Column, name: str) -> Column:
    """The issue name where the condition holds, else null."""
    return F.when(condition, F.lit(name))


def no_issues() -> Column:
    return F.array().cast("array<string>")


def collect_issues(*flags: Column) -> Column:
    """One issue list out of single flags."""
    return F.array_distinct(F.array_compact(F.array(*flags)))


def merge_issues(*lists: Column) -> Column:
    """One issue list out of issue lists (null counts as empty)."""
    return F.array_distinct(F.array_compact(F.flatten(F.array(*[F.coalesce(c, no_issues()) for c in lists]))))


def union_issues(*lists: Column) -> Column:
    """Sorted set union of issue lists."""
    return F.array_sort(merge_issues(*lists))


def has_geospatial_issue(issues: Column, names=GEOSPATIAL_ISSUES) -> Column:
    return F.coalesce(F.arrays_overlap(issues, F.array(*[F.lit(n) for n in names])), F.lit(False))
