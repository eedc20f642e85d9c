"""Resolve each distinct key once, then join the answers back."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldbook.operators.checkpoints import materialize
from fieldbook.operators.joins import skew_join

KEY = "_key"


def row_key(cols: Sequence[str | Column]) -> Column:
    """128-bit digest of many nullable columns; a null, an empty text and a shifted value all
    differ."""
    return F.unhex(F.md5(F.to_json(F.struct(*cols), {"ignoreNullFields": "false"})))


def distinct_keys(df: DataFrame, key_cols: Sequence[str]) -> DataFrame:
    """The distinct combinations of the key columns and their ``count`` (grouped on the map side
    first)."""
    return df.groupBy(*key_cols).count()


def enrich_distinct(
    df: DataFrame,
    key_cols: Sequence[str],
    resolver: Callable[[DataFrame], DataFrame],
    *,
    spread: Sequence[str],
    keep: Sequence[str] | None = None,
    default: Mapping[str, Column] | None = None,
    resolver_partitions: int | None = None,
    **skew,
) -> DataFrame:
    """Run ``resolver`` over the distinct keys of ``df`` and left join its columns back.

    ``resolver`` gets the key columns and ``_key`` and has to return one row per ``_key`` with the
    columns to add.  ``keep`` are the columns of ``df`` to carry through the join (all of them if
    not given); carry few, since they are shuffled.  ``default`` fills columns on a miss.
    ``resolver_partitions`` spreads the keys over that many tasks, for costly resolvers.  Hot keys
    are handled as in :func:`skew_join`, with buckets taken from the ``spread`` columns.

    ``df`` is read twice: once for the keys and their counts, which are stored and tell hot keys,
    too, and once for the join."""
    keep = list(df.columns if keep is None else keep)
    keys = materialize(distinct_keys(df, key_cols).withColumn(KEY, row_key(list(key_cols))))
    counts, keys = keys.select(KEY, "count"), keys.drop("count")
    if resolver_partitions:
        keys = keys.repartition(resolver_partitions, KEY)
    answers = resolver(keys)
    answers = answers.drop(*[c for c in keep if c in answers.columns])
    left = df.select(*keep, row_key(list(key_cols)).alias(KEY))
    out = skew_join(left, answers, [KEY], "left", spread=spread, counts=counts, **skew).drop(KEY)
    for name, value in (default or {}).items():
        out = out.withColumn(name, F.coalesce(F.col(name), value))
    return out
