"""The location view: each distinct place is interpreted once."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldbook.functions.footprint import footprint
from fieldbook.functions.issues import collect_issues, has_geospatial_issue, merge_issues, no_issues, union_issues
from fieldbook.functions.numbers import parse_metres, precision, range_midpoint, uncertainty
from fieldbook.functions.terms import clean, split_values, trimmed
from fieldbook.functions.text import clean_name
from fieldbook.operators.checkpoints import materialize
from fieldbook.operators.continent import resolve_continent
from fieldbook.operators.coordinates import interpret_coordinates
from fieldbook.operators.country import lookup_country, match_country, parse_country, region_of, repatriated
from fieldbook.operators.enrich import KEY, enrich_distinct
from fieldbook.operators.geocode import HEIGHT, WIDTH, centroid_distance, geocode_lists, reverse_geocode
from fieldbook.operators.joins import dimension_join, fits_broadcast, spread_null_join
from fieldbook.operators.lookup import lookup_enum
from fieldbook.operators.records import extract_location
from fieldbook.plans.temporal import created
from fieldbook.schema import LOCATION_TERMS

_METRES = (
    "minimumElevationInMeters", "maximumElevationInMeters", "minimumDepthInMeters", "maximumDepthInMeters",
    "minimumDistanceAboveSurfaceInMeters", "maximumDistanceAboveSurfaceInMeters",
)
_NAMES = ("waterBody", "stateProvince", "locality")
_LISTS = ("higherGeography", "georeferencedBy")

#: Columns of the view behind the ids, in order.
COLUMNS = (
    "continent", "waterBody", "country", "countryCode", "publishingCountry", "region", "publishedByRegion",
    "stateProvince", "minimumElevationInMeters", "maximumElevationInMeters", "elevation", "elevationAccuracy",
    "minimumDepthInMeters", "maximumDepthInMeters", "depth", "depthAccuracy", "minimumDistanceAboveSurfaceInMeters",
    "maximumDistanceAboveSurfaceInMeters", "decimalLatitude", "decimalLongitude", "coordinateUncertaintyInMeters",
    "coordinatePrecision", "hasCoordinate", "repatriated", "hasGeospatialIssue", "locality", "georeferencedDate",
    "gadm", "footprintWKT", "biome", "distanceFromCentroidInMeters", "higherGeography", "georeferencedBy", "issues",
)


@dataclass
class LocationDims:
    """What the location view looks things up in.

    ``aliases``: spellings of countries (alias, iso2, title, region).  ``pairs``: confused
    countries.  ``continents``: iso2 ``country`` and its ``continents``.  ``vocabulary``: with the
    continent spellings under ``continent``.  ``cells``: regions cut by ``region_cells``.
    ``centroids``: ``lat, lng``.  ``publishing_country``: where nothing else names one.
    ``datasets``: ``datasetKey, publishingCountry``, for records with a column ``datasetKey`` that
    name no publishing country themselves."""

    aliases: DataFrame
    pairs: DataFrame
    continents: DataFrame
    vocabulary: DataFrame
    cells: DataFrame
    centroids: DataFrame
    publishing_country: str | None = None
    datasets: DataFrame | None = None
    width: int = WIDTH
    height: int = HEIGHT
    buffer: float = 0.0


def dataset_country(metadata: DataFrame, dataset_key: str) -> str | None:
    """Publishing country of one dataset."""
    row = metadata.filter(F.col("datasetKey") == dataset_key).select("publishingCountry").first()
    return row["publishingCountry"] if row else None


def _scalars() -> list[Column]:
    """Columns that come from the text of one term or two."""

    def t(name: str) -> Column:
        return clean(trimmed(F.col(name)))

    return [
        *[parse_metres(t(n), n.startswith("maximum")).alias(n) for n in _METRES],
        range_midpoint(t("minimumElevationInMeters"), t("maximumElevationInMeters"), "ELEVATION").alias("_elevation"),
        range_midpoint(t("minimumDepthInMeters"), t("maximumDepthInMeters"), "DEPTH").alias("_depth"),
        uncertainty(t("coordinateUncertaintyInMeters")).alias("_uncertainty"),
        precision(t("coordinatePrecision")).alias("_precision"),
        *[clean_name(t(n)).alias(n) for n in _NAMES],
        *[split_values(F.col(n)).alias(n) for n in _LISTS],
    ]


def resolve_locations(keys: DataFrame, dims: LocationDims) -> DataFrame:
    """The location columns of distinct places; ``keys`` has the location terms,
    ``publishingCountry`` and ``_key``."""
    small = fits_broadcast(dims.aliases)
    cells_small = fits_broadcast(dims.cells, weight=F.lit(1) + F.coalesce(F.size("edges"), F.lit(0)))
    centroids_small = fits_broadcast(dims.centroids, 50_000)

    df = interpret_coordinates(keys, "coords")
    df = df.withColumns({"_cname": trimmed(F.col("country")), "_ccode": trimmed(F.col("countryCode")), "_ctext": trimmed(F.col("continent"))})
    df = parse_country(df, dims.aliases, "_cname", "_ccode", out="_place", small=small)
    df = lookup_country(df, clean(trimmed(F.col("publishingCountry"))), dims.aliases, "_publisher", small=small)
    df = lookup_enum(df, "_ctext", dims.vocabulary, "continent", "_continent")
    # All parsing ends here; the joins below start from these few columns, stored once.
    df = materialize(
        df.select(
            KEY,
            F.col("coords.lat").alias("lat"),
            F.col("coords.lng").alias("lng"),
            F.col("coords.issues").alias("_coord_issues"),
            F.col("coords_point").alias("_point"),
            F.col("coords_srs_known").alias("_srs_known"),
            "footprintWKT", "footprintSRS",
            F.col("_place").alias("place"),
            F.col("_place_issues"),
            F.coalesce(F.col("_publisher"), F.lit(dims.publishing_country)).alias("publishingCountry"),
            "_ctext", "_continent",
            *_scalars(),
        )
    )

    def geocode(points: DataFrame) -> DataFrame:
        return geocode_lists(reverse_geocode(points, dims.cells, dims.width, dims.height, dims.buffer, cells_small))

    df = match_country(df, geocode, dims.pairs, country="place")
    df = materialize(df.drop("lat", "lng", "place").withColumnsRenamed({"m_lat": "lat", "m_lng": "lng", "m_country": "countryCode"}))

    points = df.select("lat", "lng")
    here = geocode(points).select("lat", "lng", "continents", "gadm")
    near = centroid_distance(points, dims.centroids, centroids_small)
    # Places without coordinates have one key, and may be many.
    df = spread_null_join(df, here, ["lat", "lng"], spread=[KEY])
    df = spread_null_join(df, near, ["lat", "lng"], spread=[KEY])
    # One row per country, whatever its spellings.
    countries = dims.aliases.groupBy("iso2").agg(F.min("title").alias("country"), F.min("region").alias("region"))
    df = dimension_join(df, countries.withColumnRenamed("iso2", "countryCode"), ["countryCode"], small=small)
    df = region_of(df, countries.select("iso2", "region"), "publishingCountry", "publishedByRegion", small=small)
    of_country = dims.continents.select(F.col("country").alias("countryCode"), F.col("continents").alias("_of_country"))
    df = dimension_join(df, of_country, ["countryCode"])

    located = F.col("lat").isNotNull() & F.col("lng").isNotNull()
    point_issues = union_issues(F.col("_place_issues"), F.col("_coord_issues"), F.col("m_issues"))
    df = df.withColumns(
        {
            "_where": resolve_continent(F.col("_ctext"), F.col("_continent"), F.col("_of_country"), F.col("countryCode"), located, F.col("continents")),
            "_fp": footprint(F.col("footprintWKT"), F.col("_point"), F.col("footprintSRS"), F.col("_srs_known"), F.col("lat"), F.col("lng")),
            "_point_issues": point_issues,
        }
    )
    issues = merge_issues(
        F.col("_point_issues"),
        F.col("_where.issues"),
        F.col("_elevation.issues"),
        F.col("_depth.issues"),
        collect_issues(F.col("_precision.issue"), F.col("_uncertainty.issue")),
        F.col("_fp.issues"),
    )
    made = {
        "continent": F.col("_where.value"),
        "elevation": F.col("_elevation.value"),
        "elevationAccuracy": F.col("_elevation.accuracy"),
        "depth": F.col("_depth.value"),
        "depthAccuracy": F.col("_depth.accuracy"),
        "decimalLatitude": F.col("lat"),
        "decimalLongitude": F.col("lng"),
        "coordinateUncertaintyInMeters": F.col("_uncertainty.value"),
        "coordinatePrecision": F.col("_precision.value"),
        "hasCoordinate": located,
        "repatriated": repatriated(F.col("countryCode"), F.col("publishingCountry")),
        "hasGeospatialIssue": has_geospatial_issue(F.col("_point_issues")),
        "georeferencedDate": F.lit(None).cast("string"),
        "footprintWKT": F.col("_fp.value"),
        "biome": F.lit(None).cast("string"),
        "issues": issues,
    }
    return df.select(KEY, *[made[c].alias(c) if c in made else F.col(c) for c in COLUMNS])


def location_view(verbatim: DataFrame, dims: LocationDims, run_ts: datetime, **skew) -> DataFrame:
    """One row per record."""
    if dims.datasets is None:
        places = extract_location(verbatim, "publishingCountry")
    else:
        published = dims.datasets.groupBy("datasetKey").agg(F.min("publishingCountry").alias("_published"))
        places = extract_location(verbatim, "publishingCountry", keep=("datasetKey",))
        places = dimension_join(places, published, ["datasetKey"])
        places = places.withColumn("publishingCountry", F.coalesce("publishingCountry", "_published")).drop("datasetKey", "_published")
    found = enrich_distinct(
        places,
        [*LOCATION_TERMS, "publishingCountry"],
        lambda keys: resolve_locations(keys, dims),
        keep=["id", "coreId", "parentId"],
        spread=["id"],
        default={"issues": no_issues()},
        **skew,
    )
    return found.select("id", "coreId", "parentId", created(run_ts).alias("created"), *COLUMNS)
