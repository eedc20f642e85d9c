"""The event view: the core columns of sampling events and their parents."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldbook.functions.issues import collect_issues, merge_issues
from fieldbook.functions.numbers import finite_double
from fieldbook.functions.terms import clean_term, split_values, term
from fieldbook.functions.text import license_name, reference_uri
from fieldbook.operators.lineage import expand_lineage
from fieldbook.operators.lookup import lookup_vocabulary
from fieldbook.operators.records import has_terms
from fieldbook.plans.temporal import created


def event_view(verbatim: DataFrame, vocabulary: DataFrame, run_ts: datetime, **skew) -> DataFrame:
    """One row per event, with the lineage of its parents.  A parent whose type is not in the
    vocabulary keeps its raw type."""
    df = verbatim.select(
        "id",
        has_terms().alias("_terms"),
        term("parentEventID").alias("_parent"),
        clean_term("parentEventID").alias("parentEventID"),
        clean_term("eventType").alias("_type"),
        finite_double(term("sampleSizeValue")).alias("sampleSizeValue"),
        term("sampleSizeUnit").alias("sampleSizeUnit"),
        reference_uri(term("references")).alias("_ref"),
        license_name(term("license")).alias("license"),
        *[split_values(term(t)).alias(t) for t in ("datasetID", "datasetName", "samplingProtocol")],
        term("locationID").alias("locationID"),
    )
    df = lookup_vocabulary(df, "_type", vocabulary, "eventType", "eventType")
    parents = expand_lineage(
        df.select(
            "id", F.col("_parent").alias("parentId"), F.coalesce(F.col("eventType.concept"), F.col("_type")).alias("eventType")
        ),
        **skew,
    ).select("id", "parentsLineage", F.col("issues").alias("_loop"))
    return df.join(parents, "id", "left").select(
        "id",
        "parentEventID",
        "eventType",
        created(run_ts).alias("created"),
        "sampleSizeValue",
        "sampleSizeUnit",
        F.col("_ref.value").alias("references"),
        F.when(F.col("_terms"), F.col("license")).alias("license"),
        "datasetID",
        "datasetName",
        "samplingProtocol",
        "parentsLineage",
        "locationID",
        merge_issues(collect_issues(F.col("_ref.issue")), F.col("_loop")).alias("issues"),
    )
