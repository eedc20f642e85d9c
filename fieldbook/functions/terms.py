"""Reading terms out of the verbatim term maps."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from fieldbook.schema import IDENTIFICATION_TERMS, LOCAL_TERMS, TAXON_TERMS, uri

PIPE = r"\|"
PIPE_OR_SEMICOLON = r"[|;]"
PIPE_OR_COMMA = r"[|,]"

#: Byte length from which an indexed value is dropped.
MAX_BYTES = 32000

# Term values are trimmed of every leading and trailing control or blank character.
_EDGE = r"^[\x00-\x20]+|[\x00-\x20]+$"

_EXTENDED = frozenset(IDENTIFICATION_TERMS) | frozenset(TAXON_TERMS)


def trimmed(c: Column) -> Column:
    """Trim blanks and control characters at both ends."""
    return F.regexp_replace(c, _EDGE, "")


def has_value(c: Column) -> Column:
    """True unless null, empty or some spelling of the word null.  Never null itself."""
    return F.coalesce((c != "") & (F.lower(trimmed(c)) != "null"), F.lit(False))


def clean(c: Column) -> Column:
    """The value, or null where it is empty or some spelling of the word null."""
    return F.when(has_value(c), c)


def raw_term(name: str, terms: str | Column = "coreTerms") -> Column:
    """Value of a term in a term map, as it stands."""
    m = F.col(terms) if isinstance(terms, str) else terms
    if name in LOCAL_TERMS:
        # The end of a key tells nearly all others apart, and costs less than its last part.
        keys = F.filter(F.map_keys(m), lambda k: F.endswith(k, F.lit(name)) & (F.substring_index(k, "/", -1) == name))
        return m[F.get(keys, 0)]
    return m[uri(name)]


def term(name: str, terms: str = "coreTerms", identification: str | None = None) -> Column:
    """Trimmed core value; identification and taxon terms that are absent fall back to the
    record's latest identification row, a map column named by ``identification``."""
    value = trimmed(raw_term(name, terms))
    if identification and name in _EXTENDED:
        return F.coalesce(value, F.col(identification)[uri(name)])
    return value


def clean_term(name: str, terms: str = "coreTerms", identification: str | None = None) -> Column:
    """Null-aware form of :func:`term`."""
    value = clean(trimmed(raw_term(name, terms)))
    if identification and name in _EXTENDED:
        return F.coalesce(value, clean(F.col(identification)[uri(name)]))
    return value


def bounded(c: Column, max_bytes: int = MAX_BYTES) -> Column:
    """The value, or null from ``max_bytes`` bytes on."""
    return F.when(F.octet_length(c) < max_bytes, c)


def bounded_term(name: str, terms: str = "coreTerms", identification: str | None = None) -> Column:
    return bounded(clean_term(name, terms, identification))


def split_values(c: Column, sep: str = PIPE) -> Column:
    """Split, trim, drop empty parts; order and duplicates stay.  Nothing left gives null."""
    parts = F.filter(F.transform(F.split(c, sep), trimmed), lambda v: v != "")
    return F.when(F.size(parts) > 0, parts)


def value_set(c: Column) -> Column:
    """Distinct values of an array in a defined order."""
    return F.array_sort(F.array_distinct(c))


def has_term(name: str, terms: str = "coreTerms", identification: str | None = None) -> Column:
    return term(name, terms, identification).isNotNull()


def has_clean_term(name: str, terms: str = "coreTerms", identification: str | None = None) -> Column:
    return clean_term(name, terms, identification).isNotNull()


def has_extension(row_type: str, extensions: str = "extensions") -> Column:
    """True where the extension holds at least one row.  A plain name (no ``:``) matches the
    last part of the row type."""
    m = F.col(extensions)
    if ":" in row_type:
        found = F.size(m[row_type]) > 0
    else:
        found = F.exists(
            F.map_entries(m),
            lambda e: (F.substring_index(e["key"], "/", -1) == row_type) & (F.size(e["value"]) > 0),
        )
    return F.coalesce(found, F.lit(False))
