"""Coordinates of a record: parse every source, take the first that works, shift to WGS84."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldbook.functions.binding import let
from fieldbook.functions.coords import parse_lat_lng, parse_point, parse_verbatim_pair, pick_coordinates
from fieldbook.functions.datum import datum_table, normalise_datum, shift_to_wgs84
from fieldbook.functions.issues import no_issues, union_issues
from fieldbook.functions.terms import trimmed
from fieldbook.operators.joins import dimension_join


def parse_coordinates(df: DataFrame, out: str = "coords") -> DataFrame:
    """Add the struct ``out`` (lat, lng, issues, ok) and ``{out}_point`` (the footprint as a
    point) to rows with the location terms as columns."""

    def t(name: str):
        return trimmed(F.col(name))

    keep = df.columns
    df = df.withColumns(
        {
            "_c1": parse_lat_lng(t("decimalLatitude"), t("decimalLongitude")),
            "_c2": parse_lat_lng(t("verbatimLatitude"), t("verbatimLongitude")),
            "_c3": let(t("verbatimCoordinates"), parse_verbatim_pair),
            f"{out}_point": let(t("footprintWKT"), parse_point),
        }
    )
    picked = pick_coordinates(F.col("_c1"), F.col("_c2"), F.col("_c3"), fallback=F.col(f"{out}_point"))
    return df.select(*keep, f"{out}_point", picked.alias(out), (F.col("_c1.ok") | F.col("_c2.ok") | F.col("_c3.ok")).alias(f"{out}_own"))


def _with_datum(df: DataFrame, datums: DataFrame | None, text, out: str) -> DataFrame:
    # The built-in table has a few dozen rows; one that is passed in is checked.
    small = True if datums is None else None
    table = datum_table(df.sparkSession) if datums is None else datums
    rows = table.select(F.col("alias").alias("_alias"), F.struct("epsg", "a", "inv_f", "dx", "dy", "dz").alias(out))
    return dimension_join(df.withColumn("_alias", normalise_datum(text)), rows, ["_alias"], small=small).drop("_alias")


def to_wgs84(df: DataFrame, lat: str, lng: str, datum: str, out: str = "wgs84", datums: DataFrame | None = None) -> DataFrame:
    """Add the struct ``out`` (lat, lng, issues, ok) with the point shifted to WGS84."""
    keep = df.columns
    df = _with_datum(df, datums, F.col(datum), "_datum")
    return df.select(*keep, shift_to_wgs84(F.col(lat), F.col(lng), F.col(datum), F.col("_datum")).alias(out))


def interpret_coordinates(df: DataFrame, out: str = "coords", datums: DataFrame | None = None) -> DataFrame:
    """:func:`parse_coordinates`, then the datum shift.  The datum of a footprint is its own SRS.
    Adds ``{out}_srs_known`` for the footprint checks."""
    keep = df.columns
    df = parse_coordinates(df, "_p")
    df = df.withColumn(
        "_given", trimmed(F.when(F.col("_p_own"), F.col("geodeticDatum")).otherwise(F.col("footprintSRS")))
    )
    df = _with_datum(df, datums, F.col("_given"), "_datum")
    df = _with_datum(df, datums, F.col("footprintSRS"), "_srs")
    shifted = shift_to_wgs84(F.col("_p.lat"), F.col("_p.lng"), F.col("_given"), F.col("_datum"))
    ok = F.col("_p.ok")
    df = df.withColumn("_w", F.when(ok, shifted))
    return df.select(
        *keep,
        F.struct(
            F.col("_w.lat").alias("lat"),
            F.col("_w.lng").alias("lng"),
            union_issues(F.col("_p.issues"), F.coalesce(F.col("_w.issues"), no_issues())).alias("issues"),
            ok.alias("ok"),
        ).alias(out),
        F.col("_p_point").alias(f"{out}_point"),
        F.col("_srs").isNotNull().alias(f"{out}_srs_known"),
    )
