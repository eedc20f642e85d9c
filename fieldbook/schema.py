"""Schemas and term names shared by every operator."""

from __future__ import annotations

from pyspark.sql import types as T

_TERM_MAP = T.MapType(T.StringType(), T.StringType())

#: A verbatim record: the core terms by qualified name, and extension rows by row type.
VERBATIM = T.StructType(
    [
        T.StructField("id", T.StringType()),
        T.StructField("coreId", T.StringType()),
        T.StructField("coreRowType", T.StringType()),
        T.StructField("coreTerms", _TERM_MAP),
        T.StructField("extensions", T.MapType(T.StringType(), T.ArrayType(_TERM_MAP))),
    ]
)

#: One controlled-vocabulary label.  ``parents`` runs from the nearest ancestor to the root;
#: tags are ``name:value`` strings.
VOCABULARY = T.StructType(
    [
        T.StructField("vocab", T.StringType()),
        T.StructField("label", T.StringType()),
        T.StructField("concept", T.StringType()),
        T.StructField(
            "parents",
            T.ArrayType(
                T.StructType(
                    [
                        T.StructField("name", T.StringType()),
                        T.StructField("tags", T.ArrayType(T.StringType())),
                    ]
                )
            ),
        ),
        T.StructField("tags", T.ArrayType(T.StringType())),
    ]
)

#: One spelling of a country.
COUNTRY_ALIAS = T.StructType(
    [
        T.StructField("alias", T.StringType()),
        T.StructField("iso2", T.StringType()),
        T.StructField("iso3", T.StringType()),
        T.StructField("title", T.StringType()),
        T.StructField("region", T.StringType()),
    ]
)

#: One region: its rings (parts and holes in any order and direction; a first vertex may be repeated
#: or not).
REGION = T.StructType(
    [
        T.StructField("region_id", T.StringType()),
        T.StructField("type", T.StringType()),
        T.StructField("name", T.StringType()),
        T.StructField("iso2", T.StringType()),
        T.StructField(
            "rings",
            T.ArrayType(
                T.ArrayType(
                    T.StructType(
                        [T.StructField("lng", T.DoubleType()), T.StructField("lat", T.DoubleType())]
                    )
                )
            ),
        ),
    ]
)

RANKED_NAME = T.StructType(
    [
        T.StructField("key", T.IntegerType()),
        T.StructField("name", T.StringType()),
        T.StructField("rank", T.StringType()),
    ]
)

_AUTHORSHIP = T.StructType(
    [
        T.StructField("authors", T.ArrayType(T.StringType())),
        T.StructField("empty", T.BooleanType()),
        T.StructField("exAuthors", T.ArrayType(T.StringType())),
        T.StructField("year", T.StringType()),
    ]
)


def _fields(dtype: T.DataType, names: str) -> list[T.StructField]:
    return [T.StructField(n, dtype) for n in names.split()]


#: The atomised name, carried by the backbone table.
PARSED_NAME = T.StructType(
    _fields(
        T.BooleanType(),
        "abbreviated autonym binomial candidatus doubtful extinct incomplete indetermined"
        " phraseName trinomial",
    )
    + _fields(
        T.StringType(),
        "code cultivarEpithet genus infragenericEpithet infraspecificEpithet nomenclaturalNote"
        " nominatingParty notho phrase publishedIn rank sanctioningAuthor specificEpithet state"
        " terminalEpithet type uninomial unparsed voucher",
    )
    + [
        T.StructField("basionymAuthorship", _AUTHORSHIP),
        T.StructField("combinationAuthorship", _AUTHORSHIP),
        T.StructField("epithetQualifier", T.MapType(T.StringType(), T.StringType())),
        T.StructField("warnings", T.ArrayType(T.StringType())),
    ]
)

#: The name backbone.  ``classification`` runs from the kingdom down to the usage itself.
BACKBONE = T.StructType(
    [
        T.StructField("key", T.IntegerType()),
        T.StructField("name", T.StringType()),
        T.StructField("authorship", T.StringType()),
        T.StructField("rank", T.StringType()),
        T.StructField("status", T.StringType()),
        T.StructField("accepted_key", T.IntegerType()),
        T.StructField("kingdom", T.StringType()),
        T.StructField("phylum", T.StringType()),
        T.StructField("class", T.StringType()),
        T.StructField("order", T.StringType()),
        T.StructField("family", T.StringType()),
        T.StructField("genus", T.StringType()),
        T.StructField("classification", T.ArrayType(RANKED_NAME)),
        T.StructField(
            "nomenclature",
            T.StructType([T.StructField("id", T.StringType()), T.StructField("source", T.StringType())]),
        ),
        T.StructField("iucn", T.StringType()),
        T.StructField("parsed", PARSED_NAME),
    ]
)

#: Dataset metadata, used for the publishing country.
METADATA = T.StructType(
    [
        T.StructField("datasetKey", T.StringType()),
        T.StructField("publishingCountry", T.StringType()),
    ]
)

# ---------------------------------------------------------------------------
# Term names of the public Darwin Core and Dublin Core standards.
# ---------------------------------------------------------------------------

DWC_NS = "http://rs.tdwg.org/dwc/terms/"
DC_NS = "http://purl.org/dc/terms/"

DC_TERMS = frozenset(["references", "license", "modified"])

#: Terms outside the two standards: matched on the last part of the key, whatever the namespace.
LOCAL_TERMS = frozenset(["typifiedName", "projectId", "publishingCountry"])

IDENTIFICATION_TERMS = (
    "identificationID verbatimIdentification identificationQualifier typeStatus identifiedBy"
    " identifiedByID dateIdentified identificationReferences identificationVerificationStatus"
    " identificationRemarks"
).split()

TAXON_TERMS = (
    "taxonID scientificNameID acceptedNameUsageID parentNameUsageID originalNameUsageID"
    " nameAccordingToID namePublishedInID taxonConceptID scientificName acceptedNameUsage"
    " parentNameUsage originalNameUsage nameAccordingTo namePublishedIn namePublishedInYear"
    " higherClassification kingdom phylum class order superfamily family subfamily tribe subtribe"
    " genus genericName subgenus infragenericEpithet specificEpithet infraspecificEpithet"
    " cultivarEpithet taxonRank verbatimTaxonRank scientificNameAuthorship vernacularName"
    " nomenclaturalCode taxonomicStatus nomenclaturalStatus taxonRemarks"
).split()

LOCATION_TERMS = (
    "locationID higherGeographyID higherGeography continent waterBody islandGroup island country"
    " countryCode stateProvince county municipality locality verbatimLocality"
    " minimumElevationInMeters maximumElevationInMeters verbatimElevation verticalDatum"
    " minimumDepthInMeters maximumDepthInMeters verbatimDepth minimumDistanceAboveSurfaceInMeters"
    " maximumDistanceAboveSurfaceInMeters locationAccordingTo locationRemarks decimalLatitude"
    " decimalLongitude geodeticDatum coordinateUncertaintyInMeters coordinatePrecision"
    " pointRadiusSpatialFit verbatimCoordinates verbatimLatitude verbatimLongitude"
    " verbatimCoordinateSystem verbatimSRS footprintWKT footprintSRS footprintSpatialFit"
    " georeferencedBy georeferencedDate georeferenceProtocol georeferenceSources"
    " georeferenceRemarks"
).split()

GEOLOGY_PAIRS = [
    ("eon", "earliestEonOrLowestEonothem", "latestEonOrHighestEonothem"),
    ("era", "earliestEraOrLowestErathem", "latestEraOrHighestErathem"),
    ("period", "earliestPeriodOrLowestSystem", "latestPeriodOrHighestSystem"),
    ("epoch", "earliestEpochOrLowestSeries", "latestEpochOrHighestSeries"),
    ("age", "earliestAgeOrLowestStage", "latestAgeOrHighestStage"),
]

GEOLOGY_TEXT = (
    "lowestBiostratigraphicZone highestBiostratigraphicZone group formation member bed"
).split()

IDENTIFICATION_EXTENSION = DWC_NS + "Identification"

#: Extensions that mark a record as sequenced, by the last part of the row type.
SEQUENCE_EXTENSIONS = ("DNADerivedData", "Amplification", "Cloning", "GelImage")

#: Issues that make a record geospatially suspect.
GEOSPATIAL_ISSUES = (
    "ZERO_COORDINATE",
    "COORDINATE_OUT_OF_RANGE",
    "COORDINATE_INVALID",
    "COUNTRY_COORDINATE_MISMATCH",
)

#: Ranks of the higher classification, from the most specific.
HIGHER_RANKS = ("genus", "family", "order", "class", "phylum", "kingdom")


def uri(name: str) -> str:
    """Qualified name of a standard term."""
    return (DC_NS if name in DC_TERMS else DWC_NS) + name
