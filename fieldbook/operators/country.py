"""Country of a record: from its text, from its coordinates, and both against each other."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldbook.functions.geo import is_antarctica, valid_point
from fieldbook.functions.issues import collect_issues, flag
from fieldbook.functions.text import normalise_label
from fieldbook.operators.checkpoints import materialize
from fieldbook.operators.joins import dimension_join, spread_null_join

#: What may have gone wrong with a pair of coordinates, in the order it is tried:
#: (position, latitude, longitude, issues).
ALTERATIONS = [
    (1, lambda lat, lng: (-lat, lng), ("PRESUMED_NEGATED_LATITUDE",)),
    (2, lambda lat, lng: (lat, -lng), ("PRESUMED_NEGATED_LONGITUDE",)),
    (3, lambda lat, lng: (-lat, -lng), ("PRESUMED_NEGATED_LATITUDE", "PRESUMED_NEGATED_LONGITUDE")),
    (4, lambda lat, lng: (lng, lat), ("PRESUMED_SWAPPED_COORDINATE",)),
]


def lookup_country(df: DataFrame, text: Column, aliases: DataFrame, out: str, *, small: bool | None = None) -> DataFrame:
    """Add ``out``, the ISO code a spelling of a country stands for; a spelling that stands for two
    countries is not resolved."""
    # Spellings that only differ in punctuation are one label.
    one = F.when(F.min("iso2") == F.max("iso2"), F.min("iso2"))
    dim = aliases.groupBy(normalise_label(F.col("alias")).alias("_label")).agg(one.alias(out))
    staged = df.withColumn("_label", normalise_label(text))
    return dimension_join(staged, dim, ["_label"], "left", small=small).drop("_label")


def parse_country(df: DataFrame, aliases: DataFrame, name: str = "country", code: str = "countryCode", *, out: str = "parsed_country", small: bool | None = None) -> DataFrame:
    """Add the ISO code of the country, preferring the code over the name, and ``{out}_issues``."""
    keep = df.columns
    df = lookup_country(df, F.col(name), aliases, "_by_name", small=small)
    df = lookup_country(df, F.col(code), aliases, "_by_code", small=small)
    by_name, by_code = F.col("_by_name"), F.col("_by_code")
    invalid = (F.col(name).isNotNull() & by_name.isNull()) | (F.col(code).isNotNull() & by_code.isNull())
    return df.select(
        *keep,
        F.coalesce(by_code, by_name).alias(out),
        collect_issues(flag(invalid, "COUNTRY_INVALID"), flag(by_name != by_code, "COUNTRY_MISMATCH")).alias(f"{out}_issues"),
    )


def pair_sets(pairs: DataFrame) -> DataFrame:
    """One row per country: the countries accepted silently and those accepted with an issue."""
    return pairs.groupBy("country").agg(
        F.collect_set(F.when(~F.col("add_issue"), F.col("other"))).alias("equivalent"),
        F.collect_set(F.when(F.col("add_issue"), F.col("other"))).alias("confused"),
    )


def _countries_at(lat: Column, lng: Column, country: Column, found: Column) -> Column:
    return F.when(~valid_point(lat, lng), None).when(is_antarctica(lat, country), F.array(F.lit("AQ"))).otherwise(found)


def match_country(
    df: DataFrame,
    geocode,
    pairs: DataFrame,
    *,
    country: str = "country",
    lat: str = "lat",
    lng: str = "lng",
) -> DataFrame:
    """Check the country of each row against its coordinates.

    ``geocode`` takes distinct points (``lat, lng``) and gives ``countries`` per point, nearest
    first.  Adds ``m_country, m_lat, m_lng, m_issues, m_ok``.

    A given country is right where it is found; failing that an equivalent country is taken
    silently and an often confused one with an issue; failing that the coordinates are tried with
    signs changed and swapped.  Without a country the nearest one is taken.  Only the rows that
    miss are tried again, and each distinct point is resolved once."""
    place = F.col(country)
    here = (F.col(lat), F.col(lng))
    answers = geocode(df.select(F.col(lat).alias("lat"), F.col(lng).alias("lng"))).select(
        F.col("lat").alias("_plat"), F.col("lng").alias("_plng"), F.col("countries").alias("_found")
    )
    df = df.withColumns({"_plat": here[0], "_plng": here[1]})
    # Rows without coordinates all have the same key, and the rest of the row tells them apart.
    rest = df.columns
    df = spread_null_join(df, answers, ["_plat", "_plng"], spread=rest)
    df = dimension_join(df, pair_sets(pairs).withColumnRenamed("country", country), [country])
    df = df.withColumn("_at", _countries_at(*here, place, F.col("_found")))
    at = F.col("_at")

    def first_in(allowed: str) -> Column:
        return F.get(F.filter(at, lambda c: F.array_contains(F.col(allowed), c)), F.lit(0))

    df = df.withColumns(
        {
            "_same": F.coalesce(F.array_contains(at, place), F.lit(False)),
            "_eq": first_in("equivalent"),
            "_conf": first_in("confused"),
            "_missed": F.lit(False),
        }
    )
    hit = F.col("_same") | F.col("_eq").isNotNull() | F.col("_conf").isNotNull()
    missed = place.isNotNull() & here[0].isNotNull() & here[1].isNotNull() & ~hit
    # The misses are taken from here, and the repairs come back to here.
    df = materialize(df.withColumn("_missed", missed))

    tries = (
        df.filter("_missed")
        .select(F.col(country).alias("_c"), "_plat", "_plng")
        .distinct()
        .select(
            "_c", "_plat", "_plng",
            F.explode(
                F.array(
                    *[
                        F.struct(F.lit(n).alias("pos"), alter(F.col("_plat"), F.col("_plng"))[0].alias("lat"), alter(F.col("_plat"), F.col("_plng"))[1].alias("lng"))
                        for n, alter, _ in ALTERATIONS
                    ]
                )
            ).alias("_t"),
        )
        .select("_c", "_plat", "_plng", "_t.*")
    )
    resolved = geocode(tries.select("lat", "lng")).select("lat", "lng", "countries")
    fixed = (
        tries.join(resolved, ["lat", "lng"], "left")
        .withColumn("_at", _countries_at(F.col("lat"), F.col("lng"), F.col("_c"), F.col("countries")))
        .filter(F.array_contains("_at", F.col("_c")))
        .groupBy("_c", "_plat", "_plng")
        .agg(F.min("pos").alias("_pos"))
        .withColumnRenamed("_c", country)
    )
    df = spread_null_join(df, fixed, [country, "_plat", "_plng"], spread=rest)

    pos = F.col("_pos")
    new_lat, new_lng, fix_issues = here[0], here[1], F.lit(None).cast("array<string>")
    for n, alter, names in ALTERATIONS:
        a, o = alter(*here)
        new_lat = F.when(pos == n, a).otherwise(new_lat)
        new_lng = F.when(pos == n, o).otherwise(new_lng)
        fix_issues = F.when(pos == n, F.array(*[F.lit(i) for i in names])).otherwise(fix_issues)

    nearest_country = F.get(at, F.lit(0))
    located = here[0].isNotNull() & here[1].isNotNull()
    derived = (place.isNull() & nearest_country.isNotNull()) | (
        place.isNotNull() & ~F.col("_same") & F.col("_eq").isNull() & F.col("_conf").isNotNull()
    )
    resolved_country = (
        F.when(place.isNull(), nearest_country)
        .when(F.col("_same"), place)
        .otherwise(F.coalesce(F.col("_eq"), F.col("_conf"), place))
    )
    issues = F.when(F.col("_missed") & pos.isNotNull(), fix_issues).otherwise(
        collect_issues(
            flag(derived, "COUNTRY_DERIVED_FROM_COORDINATES"),
            flag(F.col("_missed") & pos.isNull(), "COUNTRY_COORDINATE_MISMATCH"),
        )
    )
    ok = located & F.when(place.isNull(), nearest_country.isNotNull()).otherwise(~F.col("_missed") | pos.isNotNull())
    temp = ["_plat", "_plng", "_found", "equivalent", "confused", "_at", "_same", "_eq", "_conf", "_missed", "_pos"]
    return df.withColumns(
        {
            "m_country": resolved_country,
            "m_lat": new_lat,
            "m_lng": new_lng,
            "m_issues": issues,
            "m_ok": F.coalesce(ok, F.lit(False)),
        }
    ).drop(*temp)


def region_of(df: DataFrame, regions: DataFrame, code: str, out: str, *, small: bool | None = None) -> DataFrame:
    """Add the region of a country code; ``regions`` has ``iso2, region``, one row per country."""
    dim = regions.select(F.col("iso2").alias(code), F.col("region").alias(out))
    return dimension_join(df, dim, [code], "left", small=small)


def repatriated(country_code: Column, publishing_country: Column) -> Column:
    """True where the two countries differ, null where one of them is missing."""
    return F.when(country_code.isNotNull() & publishing_country.isNotNull(), country_code != publishing_country)
