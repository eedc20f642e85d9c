"""All views of a verbatim table, and the joined view."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldbook.functions.issues import union_issues
from fieldbook.operators.checkpoints import materialize
from fieldbook.operators.records import split_repeated, split_valid
from fieldbook.operators.taxonomy import MAX_EDITS
from fieldbook.plans.basic import basic_view
from fieldbook.plans.location import LocationDims, location_view
from fieldbook.plans.taxon import taxon_view
from fieldbook.plans.temporal import temporal_view
from fieldbook.sources.verbatim import split_readable

_SHARED = ("coreId", "parentId", "created", "issues")


def occurrence_view(verbatim: DataFrame, basic: DataFrame, taxon: DataFrame, location: DataFrame, temporal: DataFrame) -> DataFrame:
    """One row per verbatim record with the columns of the four views; issues are pooled.

    All joins are on the id, so the left side is shuffled once, and nothing is where all are read in
    buckets (``read_views``; the verbatim records may be one of the views)."""
    out = verbatim.select("id", "coreId")
    for name, view in (("basic", basic), ("taxon", taxon), ("location", location), ("temporal", temporal)):
        renamed = [F.col("issues").alias(f"_{name}_issues")]
        if name == "temporal":
            renamed += [F.col("parentId"), F.col("created")]
        out = out.join(view.select("id", *[c for c in view.columns if c not in ("id", *_SHARED)], *renamed), "id", "left")
    pools = [f"_{n}_issues" for n in ("basic", "taxon", "location", "temporal")]
    return out.withColumn("issues", union_issues(*[F.col(p) for p in pools])).drop(*pools)


def interpret(
    verbatim: DataFrame,
    vocabulary: DataFrame,
    backbone: DataFrame,
    dims: LocationDims,
    run_ts: datetime,
    edits: int = MAX_EDITS,
    **temporal_options,
) -> tuple[dict[str, DataFrame], DataFrame, DataFrame]:
    """The four views by name, ready for ``write_views``; the records they are made of; and the
    rejects with the reason: what could not be read (with its text as ``raw``), records without an
    id or core terms, and all records of an id that is not unique."""
    read, unread = split_readable(verbatim)
    valid, bad = split_valid(read)
    once, repeated = split_repeated(valid)
    verbatim = materialize(once)
    views = {
        "basic": basic_view(verbatim, vocabulary, run_ts),
        "taxon": taxon_view(verbatim, backbone, run_ts, edits),
        "location": location_view(verbatim, dims, run_ts),
        "temporal": temporal_view(verbatim, run_ts, **temporal_options),
    }
    return views, verbatim, bad.unionByName(repeated).unionByName(unread, allowMissingColumns=True)
