"""Continent of a record."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from fieldbook.functions.issues import collect_issues, flag


def resolve_continent(text: Column, parsed: Column, of_country: Column, country: Column, located: Column, found: Column) -> Column:
    """Struct of the continent and its issues.

    ``parsed`` is what the text was looked up as, ``of_country`` the continents of the country in
    file order (null without a country), ``located`` whether there are coordinates, ``found`` the
    continents at the coordinates, nearest first (null or empty at sea)."""
    known = F.coalesce(of_country, F.array().cast("array<string>"))
    given = parsed.isNotNull()
    on_land = F.coalesce(F.size(found) > 0, F.lit(False))
    against_country = country.isNotNull() & given & ~F.array_contains(known, parsed)
    only = F.size(known) == 1
    derived_point = located & on_land & ~given
    derived_country = ~located & country.isNotNull() & ~given & only
    against_point = located & given & ~F.coalesce(on_land & F.array_contains(found, parsed), F.lit(False))
    value = (
        F.when(located & on_land, F.coalesce(parsed, F.get(found, F.lit(0))))
        .when(located, None)
        .when(derived_country, F.get(known, F.lit(0)))
        .otherwise(parsed)
    )
    return F.struct(
        value.alias("value"),
        collect_issues(
            flag(against_point, "CONTINENT_COORDINATE_MISMATCH"),
            flag(against_country, "CONTINENT_COUNTRY_MISMATCH"),
            flag(derived_point, "CONTINENT_DERIVED_FROM_COORDINATES"),
            flag(derived_country, "CONTINENT_DERIVED_FROM_COUNTRY"),
            flag(text.isNotNull() & parsed.isNull(), "CONTINENT_INVALID"),
        ).alias("issues"),
    )
