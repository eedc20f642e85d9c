"""Names, identifiers, links and phrases out of text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from fieldbook.functions.binding import let
from fieldbook.functions.issues import flag
from fieldbook.functions.terms import PIPE_OR_COMMA, split_values, value_set

# ---------------------------------------------------------------------------
# Phrases that give sex and life stage in free text (lower case).
# ---------------------------------------------------------------------------

SEX_PATTERNS = [
    r"\b(?<key>sex)\W+(?<value>[\w?.]+(?:\s+[\w?.]+){0,2})\s*(?:[:;,\"]|$)",
    r"\b(?<key>sex)\W+(?<value>\w+)",
    r"\b(?<value>(?:males?|females?)(?:\s*\?)?)\b",
]

LIFE_STAGE_EXCLUDED = "determin"

LIFE_STAGE_PATTERNS = [
    r"\b(?<key>(?:life\s*stage(?:\s*remarks)?|age(?:\s*class)?))\W+(?<value>[\w?./\-]+(?:\s+[\w?./\-]+){0,4})\s*(?:[:;,\"]|$)",
    r"\b(?<key>life\s*stage(?:\s*remarks)?|age\s*class|age\s*in\s*(?:hour|day)s?|age)\W+(?<value>[\w?./\-]+(?:\s+(?:year|recorded))?)",
    r"(?<value>(?:after\s+)?(?:first|second|third|fourth|hatching)\s+year)",
    r"(?<value>(?:yolk)\s+sac)",
    r"\b(?<value>(?:larves?|larvae?|larvals?|imagos?|neonates?|hatchlings?|hatched?|fry?|metamorphs?|premetamorphs"
    r"|tadpoles?|têtard?|young-of-the-year?|leptocephales?|leptocephalus?|immatures?|imms?|jeunes?"
    r"|young?|ygs?|fleglings?|fledgelings?|chicks?|nestlings?|juveniles?|juvéniles?|juvs?|subadults?"
    r"|subadultes?|subads?|sub-adults?|yearlings?|matures?|adults?|adulte?|ads?)(?:\s*\?)?)\b",
]

# Licences by a fragment of their address.
LICENSES = [
    ("CC0_1_0", r"^creativecommons\.org/publicdomain/zero/1\.0(?:/.*)?$"),
    ("CC_BY_4_0", r"^creativecommons\.org/licenses/by/4\.0(?:/.*)?$"),
    ("CC_BY_NC_4_0", r"^creativecommons\.org/licenses/by-nc/4\.0(?:/.*)?$"),
]

_ORCID = r"(?i)^(?:(?:https?:)?(?://)?(?:www\.)?orcid\.org/?(?:#)?/?|orcid:?\s*)?(\d{4})-?(\d{4})-?(\d{4})-?(\d{3}[\dX])/?$"
_WIKIDATA = (
    r"(?i)^(?:(?:https?:)?//)?(?:www\.)?wikidata\.org/(?:wiki|entity)/(?:property:)?([QP]\d+|L\d+(?:-[FS]\d+)?)/?$"
)
_URI = r"^(?i:https?|ftp|urn|doi|info|mailto)://?[^\s<>\"{}|\\^`]+$"
_BARE_HOST = r"^(?i:www\.)[^\s<>\"{}|\\^`]+\.[^\s<>\"{}|\\^`]+$"
_URN = r"^(?i:urn|doi|info|lsid):[^\s<>\"{}|\\^`/][^\s<>\"{}|\\^`]*$"

_TYPE_WORD = (
    r"(?i)^\s*(?:\w*type|type\w*|topotypical)\s*(?:of|for)?\s*:?\s+"
    r"(\p{Lu}[\p{L}-]+(?:\s+(?:[×xX]\s*)?[\p{Ll}-]+){1,3}.*?)\s*$"
)


def _value_group(pattern: str) -> int:
    return 2 if "(?<key>" in pattern else 1


def clean_name(c: Column) -> Column:
    """Collapse blanks; a name all in capitals keeps only its first one."""

    def shout(v: Column) -> Column:
        loud = F.regexp_like(F.replace(v, F.lit(" "), F.lit("")), F.lit(r"^\p{Lu}+$"))
        small = F.concat(F.upper(F.substring(v, 1, 1)), F.lower(F.substring(v, 2, 1 << 30)))
        return F.when(loud, small).otherwise(v)

    return let(F.trim(F.regexp_replace(c, r"[\s\x{A0}]+", " ")), shout)


def sex_from_text(c: Column) -> Column:
    """The sex named in a phrase.  The first pattern that matches decides, and gives nothing
    where its matches disagree."""

    def search(v: Column) -> Column:
        # Per pattern its distinct values; the first pattern that has any decides.
        found = F.array(
            *[
                F.array_distinct(F.regexp_extract_all(v, F.lit(p), F.lit(_value_group(p))))
                for p in SEX_PATTERNS
            ]
        )
        first = F.get(F.filter(found, lambda f: F.size(f) > 0), F.lit(0))
        return let(first, lambda f: F.when(F.size(f) == 1, F.get(f, F.lit(0))))

    # Every pattern holds one of these words.
    return F.when(F.lower(c).rlike("sex|male"), let(F.lower(c), search))


def life_stage_from_text(c: Column) -> Column:
    """The life stage named in a phrase; phrases on determination are left out."""

    def search(v: Column) -> Column:
        found = [F.nullif(F.regexp_extract(v, p, _value_group(p)), F.lit("")) for p in LIFE_STAGE_PATTERNS]
        return F.when(~F.contains(v, F.lit(LIFE_STAGE_EXCLUDED)), F.coalesce(*found))

    return let(F.lower(c), search)


def _agent(v: Column) -> Column:
    orcid = F.upper(F.regexp_replace(v, _ORCID, "$1-$2-$3-$4"))
    return (
        F.when(
            v.rlike(_ORCID),
            F.struct(F.lit("ORCID").alias("type"), F.concat(F.lit("https://orcid.org/"), orcid).alias("value")),
        )
        .when(
            v.rlike(_WIKIDATA),
            F.struct(
                F.lit("WIKIDATA").alias("type"),
                F.concat(
                    F.lit("http://www.wikidata.org/entity/"), F.upper(F.regexp_extract(v, _WIKIDATA, 1))
                ).alias("value"),
            ),
        )
        .otherwise(F.struct(F.lit("OTHER").alias("type"), v.alias("value")))
    )


def agent_ids(c: Column) -> Column:
    """Typed person identifiers as a set."""
    return value_set(F.transform(split_values(c, PIPE_OR_COMMA), _agent))


def reference_uri(c: Column) -> Column:
    """Struct of a valid link and, where text was given that is none, the issue."""
    uri = F.when(c.rlike(_URI) | c.rlike(_URN), c).when(c.rlike(_BARE_HOST), F.concat(F.lit("http://"), c))
    given = F.coalesce(c != "", F.lit(False))
    return F.struct(uri.alias("value"), flag(given & uri.isNull(), "REFERENCES_URI_INVALID").alias("issue"))


def license_name(c: Column) -> Column:
    """Licence constant of a licence address, else UNSPECIFIED."""

    def read(v: Column) -> Column:
        out = F.when(v.isNull(), "UNSPECIFIED")
        for name, pattern in LICENSES:
            out = out.when(v.rlike(pattern), name)
        # Any other well-formed address is a licence, though not one that is supported.
        return out.when(v.rlike(r"^[^\s<>\"{}|\\^`]+$"), "UNSUPPORTED").otherwise("UNSPECIFIED")

    return let(F.regexp_replace(F.lower(F.trim(c)), r"^https?://(?:www\.)?", ""), read)


def typified_name(name: Column, status: Column) -> Column:
    """The explicit name, else the one behind the type word of the type status."""
    return F.coalesce(name, F.nullif(F.regexp_extract(status, _TYPE_WORD, 1), F.lit("")))


def normalise_label(c: Column) -> Column:
    """Form in which labels are compared: lower case, letters and digits; a question mark stays,
    since it carries doubt."""
    return F.regexp_replace(F.lower(c), r"[^\p{L}\p{N}?]+", "")
