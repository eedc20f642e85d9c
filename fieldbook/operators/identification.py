"""Which identification of a record counts, and its columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldbook.functions.binding import let
from fieldbook.functions.dates import earliest, parse_date
from fieldbook.functions.terms import clean, has_value
from fieldbook.operators.records import carry_ids
from fieldbook.schema import DWC_NS, IDENTIFICATION_EXTENSION, IDENTIFICATION_TERMS, TAXON_TERMS, uri

#: Output column → term.
IDENTIFICATION_COLUMNS = {
    "kingdom": "kingdom",
    "phylum": "phylum",
    "clazz": "class",
    "order": "order",
    "family": "family",
    "genus": "genus",
    "scientificName": "scientificName",
    "genericName": "genericName",
    "specificEpithet": "specificEpithet",
    "infraspecificEpithet": "infraspecificEpithet",
    "scientificNameAuthorship": "scientificNameAuthorship",
    "rank": "taxonRank",
    "verbatimRank": "verbatimTaxonRank",
    "scientificNameID": "scientificNameID",
    "taxonID": "taxonID",
    "taxonConceptID": "taxonConceptID",
}


def latest_extension(rows: Column, date_term: str = DWC_NS + "dateIdentified") -> Column:
    """The one row, or of several the newest by date; the first wins ties.  None where any of
    several rows has no usable date."""
    dated = F.transform(
        rows,
        lambda r, i: F.struct(
            earliest(parse_date(F.when(has_value(r[date_term]), r[date_term]))).alias("at"),
            (-i).alias("first"),
            i.alias("i"),
        ),
    )
    # Dates are read once, and only where there is a choice.
    newest = let(dated, lambda d: F.when(F.forall(d, lambda x: x["at"].isNotNull()), F.array_max(d)["i"]))
    return F.when(F.size(rows) == 1, F.get(rows, F.lit(0))).when(F.size(rows) > 1, F.get(rows, newest))


def core_has_identification(terms: str = "coreTerms") -> Column:
    """True where any identification or taxon term of the core has a value."""
    keys = [uri(t) for t in [*IDENTIFICATION_TERMS, *TAXON_TERMS]]
    return F.coalesce(
        F.exists(F.map_entries(F.col(terms)), lambda e: e["key"].isin(*keys) & has_value(e["value"])), F.lit(False)
    )


def identification_fallback(terms: str = "coreTerms", extensions: str = "extensions") -> Column:
    """The latest identification row where the core has no identification at all, else null."""
    rows = F.col(extensions)[IDENTIFICATION_EXTENSION]
    # Most records have no such rows, and nothing else is looked at then.
    return F.when(_some(rows), F.when(~core_has_identification(terms), latest_extension(rows)))


def _some(rows: Column) -> Column:
    return F.coalesce(F.size(rows) > 0, F.lit(False))


def identification_source(terms: str = "coreTerms", extensions: str = "extensions") -> Column:
    """The term map to take the identification from: all of it from the core or none."""
    empty = F.map_from_arrays(F.array().cast("array<string>"), F.array().cast("array<string>"))
    rows = F.col(extensions)[IDENTIFICATION_EXTENSION]
    # The core is looked through once: the second branch is only reached without an identification there.
    return F.when(core_has_identification(terms), F.col(terms)).otherwise(
        F.coalesce(F.when(_some(rows), latest_extension(rows)), empty)
    )


def extract_identification(df: DataFrame, terms: str = "coreTerms", extensions: str = "extensions") -> DataFrame:
    """Ids and the sixteen identification columns; a missing scientific name is taken from the
    verbatim identification."""
    staged = df.select(*carry_ids(), identification_source(terms, extensions).alias("_source"))
    src = F.col("_source")
    cols = {out: src[uri(t)] for out, t in IDENTIFICATION_COLUMNS.items()}
    cols["scientificName"] = F.coalesce(clean(src[uri("scientificName")]), src[uri("verbatimIdentification")])
    return staged.select("id", "coreId", "parentId", *[c.alias(n) for n, c in cols.items()])
