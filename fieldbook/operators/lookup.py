"""Lookups of text in controlled vocabularies."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldbook.functions.issues import flag
from fieldbook.functions.terms import PIPE, split_values
from fieldbook.functions.text import normalise_label
from fieldbook.operators.enrich import KEY, enrich_distinct
from fieldbook.operators.joins import dimension_join, fits_broadcast

# The words that make an unknown type status a suspected one, and the tags that are
# read as ``name:value`` pairs.
SUSPECTED_TYPE_WORDS = ("?", "possible", "possibly", "potential", "maybe", "perhaps")
TAG_NAMES = ("rank", "startage", "endage")

#: Largest vocabulary that is put into the plan as a literal.
LITERAL_ROWS = 1_000


def parse_tags(tags: Column, names=TAG_NAMES) -> Column:
    """The known ``name:value`` tags as a map, both sides lower case and trimmed."""
    pairs = F.transform(
        F.filter(F.transform(tags, lambda t: F.split(t, ":")), lambda p: F.size(p) == 2),
        lambda p: F.struct(
            F.lower(F.trim(F.get(p, F.lit(0)))).alias("key"), F.lower(F.trim(F.get(p, F.lit(1)))).alias("value")
        ),
    )
    return F.map_from_entries(F.filter(pairs, lambda e: e["key"].isin(*names)))


def prepare_vocabulary(vocabulary: DataFrame) -> DataFrame:
    """A vocabulary table ready for lookups: normalised label, lineage from the root down to the
    concept, and parsed tags.  Raises where a label is not unique within its vocabulary."""
    names = F.transform(F.coalesce(F.col("parents"), F.array()), lambda p: p["name"])
    out = vocabulary.select(
        "vocab",
        normalise_label(F.col("label")).alias("label"),
        "concept",
        F.concat(F.reverse(names), F.array("concept")).alias("lineage"),
        parse_tags(F.coalesce(F.col("tags"), F.array().cast("array<string>"))).alias("tags"),
        F.transform(
            F.coalesce(F.col("parents"), F.array()),
            lambda p: F.struct(
                p["name"].alias("name"),
                parse_tags(F.coalesce(p["tags"], F.array().cast("array<string>"))).alias("tags"),
            ),
        ).alias("parents"),
    )
    twice = out.groupBy("vocab", "label").count().filter("count > 1").limit(1).collect()
    if twice:
        raise ValueError(f"label {twice[0]['label']!r} occurs twice in vocabulary {twice[0]['vocab']!r}")
    return out


def concept_struct() -> Column:
    """The concept of a vocabulary row; tags stay out, as for the plain lookups."""
    return F.struct(
        F.col("concept"), F.col("lineage"), F.lit(None).cast("array<struct<name:string,value:string>>").alias("tags")
    )


def lookup_vocabulary(
    df: DataFrame,
    col: str | Column,
    vocabulary: DataFrame,
    vocab: str,
    out: str,
    *,
    issue: str | None = None,
    value: Column | None = None,
    small: bool | None = None,
) -> DataFrame:
    """Add the concept of a label as the struct ``out`` (or as ``value`` of the vocabulary row);
    with ``issue``, add ``{out}_issue`` where text was given and nothing was found."""
    text = F.col(col) if isinstance(col, str) else col
    dim = vocabulary.filter(F.col("vocab") == vocab).select(
        F.col("label").alias("_label"), (concept_struct() if value is None else value).alias(out)
    )
    staged = df.withColumn("_label", normalise_label(text))
    joined = dimension_join(staged, dim, ["_label"], "left", small=small)
    joined = joined.drop("_label")
    if issue:
        joined = joined.withColumn(f"{out}_issue", flag(text.isNotNull() & F.col(out).isNull(), issue))
    return joined


def lookup_enum(df: DataFrame, col: str | Column, vocabulary: DataFrame, vocab: str, out: str, **kw) -> DataFrame:
    """Add the constant that a spelling stands for."""
    return lookup_vocabulary(df, col, vocabulary, vocab, out, value=F.col("concept"), **kw)


_CONCEPT = "struct<concept:string,lineage:array<string>,tags:array<struct<name:string,value:string>>>"


def vocabulary_map(vocabulary: DataFrame, vocab: str, value: Column, kind: str, limit: int = LITERAL_ROWS) -> Column | None:
    """Label → value as a literal map of the plan, or None where the vocabulary is over the limit.

    ``kind`` is the type of the value as text.  A lookup in the map costs nothing where there is no
    label, and needs neither a join nor a copy of the row."""
    dim = vocabulary.filter(F.col("vocab") == vocab).select("label", F.to_json(F.struct(value.alias("v"))).alias("v"))
    if not fits_broadcast(dim, limit):
        return None
    entries = {r["label"]: json.loads(r["v"])["v"] for r in dim.collect()}  # at most ``limit`` rows
    return F.from_json(F.lit(json.dumps(entries)), f"map<string,{kind}>")


def lookup_values(
    df: DataFrame,
    col: str,
    vocabulary: DataFrame,
    vocab: str,
    out: str,
    *,
    spread: list[str],
    literal_rows: int = LITERAL_ROWS,
) -> DataFrame:
    """Look up every element of an array column, in order.  ``out`` gets one struct per element,
    of the raw ``value`` and its ``concept`` struct (null on a miss).

    A small vocabulary goes into the plan as a literal map, with no shuffle.  A larger one is
    joined once per distinct array."""
    entries = vocabulary_map(vocabulary, vocab, concept_struct(), _CONCEPT, literal_rows)
    if entries is not None:
        return df.withColumn(
            out,
            F.transform(
                col, lambda v: F.struct(v.alias("value"), entries[normalise_label(v)].alias("concept"))
            ),
        )

    dim = vocabulary.filter(F.col("vocab") == vocab).select("label", concept_struct().alias("_concept"))

    def resolve(keys: DataFrame) -> DataFrame:
        parts = keys.select(KEY, F.posexplode(col).alias("_pos", "_value")).withColumn(
            "label", normalise_label(F.col("_value"))
        )
        found = dimension_join(parts, dim, ["label"], "left")
        # One group is the elements of one array.
        return found.groupBy(KEY).agg(
            F.transform(
                F.sort_array(F.collect_list(F.struct("_pos", F.col("_value").alias("value"), F.col("_concept").alias("concept")))),
                lambda e: F.struct(e["value"].alias("value"), e["concept"].alias("concept")),
            ).alias(out)
        )

    found = enrich_distinct(df, [col], resolve, spread=spread)
    # An empty array has no element to look up, and stays empty.
    return found.withColumn(out, F.when(F.size(col) == 0, F.array().cast(found.schema[out].dataType)).otherwise(F.col(out)))


def lookup_enum_values(df: DataFrame, col: str, vocabulary: DataFrame, vocab: str, out: str, *, spread: list[str], sep: str = PIPE) -> DataFrame:
    """Constants of a multi-value text, as a set in a defined order."""
    staged = df.withColumn("_values", split_values(F.col(col), sep))
    found = lookup_values(staged, "_values", vocabulary, vocab, "_found", spread=spread)
    constants = F.array_compact(F.transform("_found", lambda e: e["concept"]["concept"]))
    return found.withColumn(out, F.array_sort(F.array_distinct(constants))).drop("_values", "_found")


def type_status(
    df: DataFrame, col: str, vocabulary: DataFrame, out: str, *, spread: list[str], vocab: str = "typeStatus", literal_rows: int = LITERAL_ROWS
) -> DataFrame:
    """Concepts of an array of type statuses as ``out``, and ``{out}_issues`` for the misses."""
    found = lookup_values(df, col, vocabulary, vocab, "_found", spread=spread, literal_rows=literal_rows)
    hits = F.transform(F.filter("_found", lambda e: e["concept"].isNotNull()), lambda e: e["concept"])
    misses = F.filter("_found", lambda e: e["concept"].isNull())

    def suspected(e: Column) -> Column:
        v = F.lower(e["value"])
        test = F.contains(v, F.lit(SUSPECTED_TYPE_WORDS[0]))
        for word in SUSPECTED_TYPE_WORDS[1:]:
            test = test | F.contains(v, F.lit(word))
        return test

    issues = F.transform(
        misses, lambda e: F.when(suspected(e), "SUSPECTED_TYPE").otherwise("TYPE_STATUS_INVALID")
    )
    return found.select(
        *df.columns,
        F.when(F.size(hits) > 0, hits).alias(out),
        F.array_distinct(F.coalesce(issues, F.array().cast("array<string>"))).alias(f"{out}_issues"),
    )
