"""Joins that stay balanced whatever the key distribution."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Largest dimension, in rows (or weight) and in bytes of text, that is sent whole to every executor.
BROADCAST_ROWS = 200_000
BROADCAST_BYTES = 32 << 20

#: A key counts as hot from this many rows on, and from this part of all rows on; so there are never
#: more hot keys than ``HOT_PART``.
HOT_ROWS = 100_000
HOT_PART = 10_000
BUCKETS = 64


def fits_broadcast(df: DataFrame, max_rows: int = BROADCAST_ROWS, weight: Column | None = None, max_bytes: int = BROADCAST_BYTES) -> bool:
    """True where the whole table is within both bounds; reads at most ``max_rows + 1`` rows."""
    w = F.lit(1) if weight is None else weight
    rows = df.select(w.cast("long").alias("w"), F.octet_length(F.to_json(F.struct("*"))).alias("b")).limit(max_rows + 1)
    total, size = rows.agg(F.sum("w"), F.sum("b")).first()
    return (total or 0) <= max_rows and (size or 0) <= max_bytes


def skew_join(
    left: DataFrame,
    right: DataFrame,
    on: Sequence[str],
    how: str = "left",
    *,
    spread: Sequence[str],
    buckets: int = BUCKETS,
    hot_rows: int = HOT_ROWS,
    hot_part: int = HOT_PART,
    counts: DataFrame | None = None,
) -> DataFrame:
    """Shuffled join in which the rows of a hot key are spread over ``buckets`` tasks.

    Key counts come from a pre-aggregated pass over the left side.  A key is hot from ``hot_rows``
    rows on if these are at least one in ``hot_part`` of all rows.  Rows of a hot key get a bucket
    from the hash of the ``spread`` columns (so a re-run task gives the same bucket), and the right
    rows of that key are repeated once per bucket.  All other keys join as usual, so the result is
    that of the plain join.  Rows with a null key, which match nothing, are spread the same way.

    ``counts`` holds the left side's keys with their ``count``, where a caller has them; without it
    the left side is read twice, so it should be a plain scan or a stored table then.  Joins further
    down a plan are left to the run-time splitting of skewed partitions."""
    on = list(on)
    counted = left.groupBy(*on).count() if counts is None else counts
    total = counted.agg(F.sum("count").alias("n")).scalar()
    hot = counted.filter(F.col("count") >= F.greatest(F.lit(hot_rows), total / hot_part)).select(*on, F.lit(True).alias("_hot"))
    hot = F.broadcast(hot)  # at most hot_part rows
    bucket = F.pmod(F.xxhash64(*spread), F.lit(buckets)).cast("int")
    anywhere = F.col("_hot")
    for c in on:
        anywhere = anywhere | F.col(c).isNull()
    l = left.join(hot, on, "left").withColumn("_salt", F.when(anywhere, bucket).otherwise(F.lit(0)))
    repeated = F.when(F.col("_hot"), F.sequence(F.lit(0), F.lit(buckets - 1))).otherwise(F.array(F.lit(0)))
    r = right.join(hot, on, "left").withColumn("_salt", F.explode(repeated)).drop("_hot")
    return l.drop("_hot").join(r, [*on, "_salt"], how).drop("_salt")


def spread_null_join(left: DataFrame, right: DataFrame, on: Sequence[str], *, spread: Sequence[str], buckets: int = BUCKETS) -> DataFrame:
    """Left join in which the rows with a null key, which match nothing and may be most of them,
    are spread over ``buckets`` tasks by a hash of the ``spread`` columns."""
    on = list(on)
    missing = F.lit(False)
    for c in on:
        missing = missing | F.col(c).isNull()
    salted = left.withColumn("_salt", F.when(missing, F.pmod(F.xxhash64(*spread), F.lit(buckets)).cast("int")).otherwise(F.lit(0)))
    return salted.join(right.withColumn("_salt", F.lit(0)), [*on, "_salt"], "left").drop("_salt")


def dimension_join(
    left: DataFrame,
    dim: DataFrame,
    on: Sequence[str],
    how: str = "left",
    *,
    small: bool | None = None,
    weight: Column | None = None,
) -> DataFrame:
    """Join a dimension: broadcast where its size was checked and is small, else shuffled, with
    skewed partitions split at run time (``prepare_session`` turns that on).

    Pass ``small`` where the caller has already checked."""
    if small is None:
        small = fits_broadcast(dim, weight=weight)
    return left.join(F.broadcast(dim) if small else dim, list(on), how)
