"""The taxon view: each distinct identification is matched once."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldbook.functions.issues import no_issues
from fieldbook.operators.enrich import enrich_distinct
from fieldbook.operators.identification import extract_identification
from fieldbook.operators.taxonomy import MAX_EDITS, NameIndex, match_taxa
from fieldbook.plans.temporal import created

COLUMNS = (
    "synonym", "usage", "classification", "acceptedUsage", "nomenclature", "diagnostics",
    "usageParsedName", "iucnRedListCategoryCode", "issues",
)


#: Columns of an identification that a match depends on.
KEY_COLUMNS = (
    "kingdom", "phylum", "clazz", "order", "family", "genus", "scientificName", "genericName", "specificEpithet",
    "infraspecificEpithet", "scientificNameAuthorship", "rank",
)


def taxon_view(verbatim: DataFrame, backbone: DataFrame | NameIndex, run_ts: datetime, edits: int = MAX_EDITS, **skew) -> DataFrame:
    """One row per record.  The key is all that a match depends on, so records never multiply.
    Names may be spelt wrong by up to ``edits`` letters."""
    found = enrich_distinct(
        extract_identification(verbatim),
        list(KEY_COLUMNS),
        lambda names: match_taxa(names, backbone, edits),
        keep=["id", "coreId", "parentId"],
        spread=["id"],
        default={"issues": no_issues()},
        **skew,
    )
    return found.select("id", "coreId", "parentId", created(run_ts).alias("created"), *COLUMNS)
