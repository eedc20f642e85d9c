"""Connected components of an edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def components(edges: DataFrame) -> DataFrame:
    """``node, component`` (the least node of the component) for every node of ``edges`` (``a, b``
    bigint).

    Alternates two steps until nothing changes: every node's larger neighbours are tied to its
    least neighbour, then every node's smaller neighbours are.  Both only group by a node and keep
    a minimum, so a node with very many edges is aggregated before the shuffle, and the number of
    rounds grows with the logarithm of the longest chain.  An empty table gives an empty result;
    null ends are ignored."""
    pairs = edges.where("a is not null and b is not null and a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct().checkpoint()
    before = None
    while True:
        pairs = _tie(pairs, larger=True)
        pairs = _tie(pairs, larger=False).checkpoint()
        # A set of pairs is known by the number and the sum of its hashes; stable sets are stars.
        state = pairs.agg(F.count("*"), F.sum(F.xxhash64("a", "b") % (1 << 40))).first()
        if state == before:
            break
        before = state
    return pairs.select(F.col("a").alias("node"), F.col("b").alias("component")).union(pairs.select("b", "b").distinct())


def _tie(pairs: DataFrame, larger: bool) -> DataFrame:
    """Each node's larger (or smaller) neighbours, tied to the least of its neighbours and itself."""
    if larger:
        both = pairs.union(pairs.select("b", "a"))
    else:
        both = pairs
    least = both.groupBy("a").agg(F.min("b").alias("least")).select("a", F.least("a", "least").alias("least"))
    tied = both.join(least, "a")
    if larger:
        tied = tied.where(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("least").alias("b"))
    else:
        tied = tied.select("b", "least").union(least.select("a", "least")).toDF("a", "b")
    return tied.where("a <> b").distinct()
