"""The basic view: everything that is neither taxon, place nor time.  Lookups aside, row-local."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldbook.functions.binding import let
from fieldbook.functions.issues import collect_issues, flag, merge_issues, no_issues
from fieldbook.functions.numbers import finite_double, parse_count, relative_quantity
from fieldbook.functions.status import occurrence_status as status_rule
from fieldbook.functions.terms import (
    PIPE_OR_SEMICOLON,
    clean,
    clean_term,
    has_extension,
    has_value,
    raw_term,
    split_values,
    term,
)
from fieldbook.functions.text import (
    agent_ids,
    life_stage_from_text,
    license_name,
    reference_uri,
    sex_from_text,
    typified_name,
)
from fieldbook.operators.geology import chronostratigraphy
from fieldbook.operators.identification import identification_fallback
from fieldbook.operators.joins import fits_broadcast
from fieldbook.operators.lookup import lookup_enum, lookup_vocabulary, type_status
from fieldbook.operators.records import has_terms
from fieldbook.plans.temporal import created
from fieldbook.schema import GEOLOGY_PAIRS, GEOLOGY_TEXT, SEQUENCE_EXTENSIONS

#: Terms looked up in the vocabulary of their own name.
VOCABULARY_TERMS = ("sex", "establishmentMeans", "lifeStage", "pathway", "degreeOfEstablishment")

LIST_TERMS = (
    "datasetID", "datasetName", "otherCatalogNumbers", "recordedBy", "identifiedBy", "preparations",
    "samplingProtocol", "projectId", "associatedSequences",
)
_WIDE = ("otherCatalogNumbers", "associatedSequences")

_TRIMMED = (
    "basisOfRecord", "typifiedName", "typeStatus", "references", "organismQuantity",
    "organismQuantityType", "sampleSizeUnit", "sampleSizeValue", "license", "identifiedByID",
    "recordedByID", *LIST_TERMS,
)
_CLEANED = ("individualCount", "occurrenceStatus", "dynamicProperties", *VOCABULARY_TERMS, *GEOLOGY_TEXT)


def is_sequenced(associated, extensions: str = "extensions"):
    """True where a sequence extension has rows or a sequence is named."""
    out = has_value(associated)
    for ext in SEQUENCE_EXTENSIONS:
        out = out | has_extension(ext, extensions)
    return out


def basic_view(
    verbatim: DataFrame,
    vocabulary: DataFrame,
    run_ts: datetime,
    *,
    use_dynamic_properties: bool = True,
    interpret_status: bool = False,
) -> DataFrame:
    """One row per record.  ``vocabulary`` comes from ``load_vocabulary``.  The occurrence status
    rules run only if asked for."""
    small = fits_broadcast(vocabulary)
    look = {"vocabulary": vocabulary, "small": small}
    ident = {"identification": "_ident"}
    geology = [t for _, early, late in GEOLOGY_PAIRS for t in (early, late)]

    # The term map is read once; everything after works on flat columns.
    df = verbatim.withColumn("_ident", identification_fallback())
    df = df.select(
        "id",
        "coreId",
        has_terms().alias("_terms"),
        *[term(t, **ident).alias(f"t_{t}") for t in _TRIMMED],
        raw_term("typeStatus").alias("r_typeStatus"),
        *[clean_term(t, **ident).alias(f"c_{t}") for t in (*_CLEANED, *geology)],
        is_sequenced(term("associatedSequences")).alias("isSequenced"),
    )
    df = df.withColumn("_types", split_values(F.col("t_typeStatus")))
    df = type_status(df, "_types", vocabulary, "typeStatus", spread=["id"])
    df = lookup_enum(df, "t_basisOfRecord", vocab="basisOfRecord", out="_basis", **look)
    if interpret_status:
        df = lookup_enum(df, "c_occurrenceStatus", vocab="occurrenceStatus", out="_status", **look)
    for t in VOCABULARY_TERMS:
        df = lookup_vocabulary(df, f"c_{t}", vocab=t, out=f"v_{t}", **look)
    if use_dynamic_properties:
        for t, reader in (("sex", sex_from_text), ("lifeStage", life_stage_from_text)):
            text = F.when(F.col(f"v_{t}").isNull(), let(reader(F.col("c_dynamicProperties")), clean))
            df = lookup_vocabulary(df, text, vocab=t, out="_more", **look)
            df = df.withColumn(f"v_{t}", F.coalesce(F.col(f"v_{t}"), F.col("_more"))).drop("_more")
    df = chronostratigraphy(
        df, [(r, f"c_{early}", f"c_{late}") for r, early, late in GEOLOGY_PAIRS], vocabulary, small=small
    )

    df = df.withColumns(
        {
            "_count": parse_count(F.col("c_individualCount")),
            "_ref": reference_uri(F.col("t_references")),
            "_quantity": finite_double(F.col("t_organismQuantity")),
            "_size": finite_double(F.col("t_sampleSizeValue")),
            "_bor": F.when(F.col("_terms"), F.coalesce("_basis", F.lit("OCCURRENCE"))),
        }
    )
    if interpret_status:
        df = df.withColumn(
            "_occ", status_rule(F.col("c_individualCount"), F.col("c_occurrenceStatus"), F.col("_status"), F.col("_bor"))
        )
        status, status_issues = F.when(F.col("_terms"), F.col("_occ.value")), F.col("_occ.issues")
    else:
        status, status_issues = F.lit(None).cast("string"), no_issues()

    context = F.struct(
        *[
            c
            for rank, early, late in GEOLOGY_PAIRS
            for c in (F.col(f"geology_{rank}.earliest").alias(early), F.col(f"geology_{rank}.latest").alias(late))
        ],
        *[F.col(f"c_{t}").alias(t) for t in GEOLOGY_TEXT],
        F.col("geology_range.start").alias("startAge"),
        F.col("geology_range.end").alias("endAge"),
    )
    issues = merge_issues(
        collect_issues(flag(F.col("_terms") & F.col("_basis").isNull(), "BASIS_OF_RECORD_INVALID")),
        F.col("typeStatus_issues"),
        collect_issues(F.col("_count.issue"), F.col("_ref.issue")),
        status_issues,
        F.col("geology_issues"),
    )
    return df.select(
        "id",
        "coreId",
        created(run_ts).alias("created"),
        F.col("_bor").alias("basisOfRecord"),
        *[F.col(f"v_{t}").alias(t) for t in ("sex", "lifeStage", "establishmentMeans", "degreeOfEstablishment", "pathway")],
        F.col("_count.value").alias("individualCount"),
        "typeStatus",
        typified_name(F.col("t_typifiedName"), F.col("r_typeStatus")).alias("typifiedName"),
        F.col("_size").alias("sampleSizeValue"),
        F.col("t_sampleSizeUnit").alias("sampleSizeUnit"),
        F.col("_quantity").alias("organismQuantity"),
        F.col("t_organismQuantityType").alias("organismQuantityType"),
        relative_quantity(F.col("_quantity"), F.col("t_organismQuantityType"), F.col("_size"), F.col("t_sampleSizeUnit")).alias("relativeOrganismQuantity"),
        F.col("_ref.value").alias("references"),
        F.when(F.col("_terms"), license_name(F.col("t_license"))).alias("license"),
        agent_ids(F.col("t_identifiedByID")).alias("identifiedByIds"),
        agent_ids(F.col("t_recordedByID")).alias("recordedByIds"),
        status.alias("occurrenceStatus"),
        *[split_values(F.col(f"t_{t}"), PIPE_OR_SEMICOLON).alias(t) if t in _WIDE else split_values(F.col(f"t_{t}")).alias(t) for t in LIST_TERMS],
        F.when(F.col("_terms"), context).alias("geologicalContext"),
        F.when(F.col("_terms"), F.col("isSequenced")).alias("isSequenced"),
        issues.alias("issues"),
    )
