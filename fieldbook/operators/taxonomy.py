"""Matching names against a backbone: exact, then misspelt, then by higher rank."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fieldbook.functions.binding import let
from fieldbook.functions.issues import collect_issues, flag
from fieldbook.functions.terms import has_value
from fieldbook.operators.checkpoints import materialize
from fieldbook.operators.enrich import KEY
from fieldbook.operators.joins import dimension_join, fits_broadcast, skew_join, spread_null_join
from fieldbook.schema import HIGHER_RANKS

#: Largest edit distance of a fuzzy match.
MAX_EDITS = 1

#: Points for and against a candidate.  ``edit`` is taken off per edit of a misspelt name;
#: ``authored`` is for a name given with the very authorship of the backbone.
SCORES = {
    "exact": 90, "fuzzy": 84, "edit": 8, "higher": 2, "higher_clash": -3, "kingdom_clash": -40,
    "rank": 4, "rank_clash": -8, "authored": 6, "accepted": 1,
}

#: What scores less is no match: above all, an exact name of another kingdom.
LEAST_SCORE = 55

#: Names of one part of a segment.
CROWD = 2_000

#: Identification column of a rank (``class`` is spelt ``clazz`` there).
_COLUMN = {r: ("clazz" if r == "class" else r) for r in HIGHER_RANKS}

_SYNONYMS = (
    "SYNONYM", "HETEROTYPIC_SYNONYM", "HOMOTYPIC_SYNONYM", "PROPARTE_SYNONYM", "MISAPPLIED",
    "INTERMEDIATE_RANK_SYNONYM", "DETERMINATION_SYNONYM",
)

_RANKED = "struct<key:int,name:string,rank:string>"
_DIAGNOSTIC = "struct<matchType:string,confidence:int,status:string,lineage:array<string>,note:string>"


def canonical_name(c: Column) -> Column:
    """Form in which names are compared: one blank between words, lower case."""
    return F.nullif(F.lower(F.trim(F.regexp_replace(c, r"\s+", " "))), F.lit(""))


def incertae_sedis() -> Column:
    """The usage of a record that matches nothing."""
    return F.struct(F.lit(0).alias("key"), F.lit("incertae sedis").alias("name"), F.lit("KINGDOM").alias("rank"))


def _query_name() -> Column:
    """Scientific name, or what the parts give."""

    def some(name: str) -> Column:
        return F.when(has_value(F.col(name)), F.trim(F.col(name)))

    genus = F.coalesce(some("genericName"), some("genus"))
    built = F.when(
        genus.isNotNull() & some("specificEpithet").isNotNull(),
        F.concat_ws(" ", genus, some("specificEpithet"), some("infraspecificEpithet")),
    )
    return F.coalesce(some("scientificName"), built, genus)


@dataclass
class NameIndex:
    """A backbone made ready for searching, stored once.

    ``names``: every form of every name.  ``segments``: the names again, once per segment (see
    :func:`segment_probes`).  ``crowded``: segments that many names share, and the parts they are
    dealt into.  ``higher``: the taxa of the higher ranks."""

    backbone: DataFrame
    names: DataFrame
    segments: DataFrame
    crowded: DataFrame
    higher: DataFrame
    edits: int


def segment_bounds(length: Column, part: int, parts: int) -> tuple[Column, Column]:
    """Start (from 0) and length of one of ``parts`` segments of a text, as equal as can be."""
    start = F.floor(length * part / parts)
    return start.cast("int"), (F.floor(length * (part + 1) / parts) - start).cast("int")


def name_segments(c: Column, edits: int) -> Column:
    """The ``edits + 1`` segments of a name, as (length of the name, number, text)."""
    size, out = F.length(c), []
    for part in range(edits + 1):
        start, length = segment_bounds(size, part, edits + 1)
        out.append(F.struct(size.alias("size"), F.lit(part).alias("part"), F.substring(c, start + 1, length).alias("text")))
    return F.array(*out)


def segment_probes(c: Column, edits: int) -> Column:
    """Where the segments of all names within ``edits`` can be in a text.

    That many edits touch that many segments at most, so one of ``edits + 1`` is left as it is, and
    no edit moves it by more places than there are edits.  The number of probes does not depend on
    the length of the text."""
    size, out = F.length(c), []
    for change in range(-edits, edits + 1):
        length = size + change
        for part in range(edits + 1):
            start, own = segment_bounds(length, part, edits + 1)
            # Edits before the segment move it; those left over after it make up the change in size.
            for move in range(-edits, edits + 1):
                if abs(move) + abs(move + change) <= edits:
                    at = start + move
                    text = F.when((length > 0) & (at >= 0) & (at + own <= size), F.substring(c, at + 1, own))
                    out.append(F.struct(length.alias("size"), F.lit(part).alias("part"), text.alias("text")))
    return F.array_distinct(F.filter(F.array(*out), lambda p: p["text"].isNotNull()))


def name_index(backbone: DataFrame, edits: int = MAX_EDITS, crowd: int = CROWD) -> NameIndex:
    """Build the index of a backbone; do it once for many calls."""
    slim = backbone.select(
        "key", F.upper("rank").alias("_rank"), F.when(F.col("status") == "ACCEPTED", 0).otherwise(1).alias("_order"),
        F.struct(*[F.lower(F.trim(r)).alias(r) for r in HIGHER_RANKS]).alias("_higher"), "authorship",
        canonical_name(F.col("name")).alias("_plain"),
        canonical_name(F.concat_ws(" ", "name", "authorship")).alias("_full"),
    )
    forms = F.explode(F.array_distinct(F.array("_plain", "_full")))
    names = materialize(slim.withColumn("_name", forms).filter("_name IS NOT NULL").withColumn("_authored", F.col("_name") != F.coalesce("_plain", F.lit(""))))
    cut = names.withColumn("_s", F.explode(name_segments(F.col("_name"), edits)))
    many = cut.groupBy("_s").agg(F.ceil(F.count("*") / crowd).cast("int").alias("_parts")).filter("_parts > 1")
    crowded = materialize(many)
    dealt = dimension_join(cut, crowded, ["_s"], "left").withColumn("_bucket", F.pmod(F.xxhash64("_name", "key"), F.coalesce("_parts", F.lit(1))).cast("int"))
    segments = materialize(dealt.drop("_parts").withColumnRenamed("_name", "_spelt"))
    higher = names.filter(F.col("_rank").isin(*[r.upper() for r in HIGHER_RANKS]) & ~F.col("_authored"))
    return NameIndex(backbone, names, segments, crowded, materialize(higher), edits)


def _authors(c: Column) -> Column:
    """The words of an authorship, without connecting ones."""
    return F.filter(F.regexp_extract_all(F.lower(c), F.lit(r"(\p{L}+)"), F.lit(1)), lambda w: ~w.isin("ex", "in", "et", "al", "and", "f"))


def authorship_score(given: Column, known: Column) -> Column:
    """4 where an author of the one begins like one of the other (``L.``, ``Linnaeus``), -6 where
    none does; 2 more for the same year, 2 less for years more than two apart."""

    def rule(ours: Column, theirs: Column) -> Column:
        alike = F.exists(ours, lambda a: F.exists(theirs, lambda b: F.startswith(a, b) | F.startswith(b, a)))
        words = F.when((F.size(ours) > 0) & (F.size(theirs) > 0), F.when(alike, 4).otherwise(-6)).otherwise(0)
        year = lambda c: F.nullif(F.regexp_extract(c, r"(?<!\d)(1[5-9]\d\d|20\d\d)(?!\d)", 1), F.lit("")).try_cast("int")
        apart = F.abs(year(given) - year(known))
        return words + F.coalesce(F.when(apart == 0, 2).when(apart > 2, -2), F.lit(0))

    return F.coalesce(let(_authors(given), lambda ours: let(_authors(known), lambda theirs: rule(ours, theirs))), F.lit(0))


def _score(distance: Column) -> Column:
    """How well a candidate fits a query, as a sum of :data:`SCORES`."""
    s = SCORES
    parts = [F.when(distance == 0, s["exact"]).otherwise(F.lit(s["fuzzy"]) - distance * s["edit"])]
    for r in HIGHER_RANKS:
        given = F.nullif(F.lower(F.trim(F.col(_COLUMN[r]))), F.lit(""))
        known = F.nullif(F.col(f"_higher.{r}"), F.lit(""))
        clash = s["kingdom_clash"] if r == "kingdom" else s["higher_clash"]
        parts.append(F.when(given == known, s["higher"]).when(given != known, clash).otherwise(0))
    given_rank = F.nullif(F.upper(F.trim(F.col("_given_rank"))), F.lit(""))
    parts.append(F.when(given_rank == F.col("_rank"), s["rank"]).when(given_rank != F.col("_rank"), s["rank_clash"]).otherwise(0))
    parts.append(F.when(F.col("_authored"), s["authored"]).otherwise(authorship_score(F.col("_author"), F.col("authorship"))))
    parts.append(F.when(F.col("_order") == 0, s["accepted"]).otherwise(0))
    total = parts[0]
    for p in parts[1:]:
        total = total + p
    return total


def _best(candidates: DataFrame, group: tuple[str, ...] = (KEY,)) -> DataFrame:
    """Per query the candidate with the highest ``_score``, and its ``_margin`` over the next taxon
    (null if there is none).  A candidate below :data:`LEAST_SCORE` is none, and two equally good
    ones that nothing tells apart are none either: the ``_taxon`` of such a query is null."""
    taxa = candidates.groupBy(*group, "key").agg(F.max("_score").alias("_score"))
    place = F.row_number().over(Window.partitionBy(*group).orderBy(F.desc("_score"), "key"))
    two = taxa.withColumn("_place", place).filter("_place <= 2")
    best = two.groupBy(*group).agg(
        F.max(F.when(F.col("_place") == 1, F.col("key"))).alias("key"),
        F.max("_score").alias("_score"),
        (F.max("_score") - F.max(F.when(F.col("_place") == 2, F.col("_score")))).alias("_margin"),
    )
    sure = (F.col("_score") >= LEAST_SCORE) & F.coalesce(F.col("_margin") > 0, F.lit(True))
    return best.select(*group, F.when(sure, F.col("key")).alias("_taxon"), "_score", "_margin")


def exact_matches(names: DataFrame, index: NameIndex) -> DataFrame:
    """``_key, _taxon, _score, _margin`` of the names that are spelt as in the backbone."""
    return _best(names.join(index.names, "_name").withColumn("_score", _score(F.lit(0))))


def fuzzy_matches(names: DataFrame, index: NameIndex) -> DataFrame:
    """``_key, _taxon, _score, _margin`` of the names within some edits of a backbone name.  A name
    without any higher taxon gets no fuzzy match.

    Names meet in segments that they share.  A segment of very many names lies in parts, and what
    asks for it goes to all of them."""
    some = F.lit(False)
    for r in ("kingdom", "phylum", "class", "order", "family"):
        some = some | F.coalesce(F.col(_COLUMN[r]) != "", F.lit(False))
    asked = names.filter(some & F.col("_name").isNotNull()).select(KEY, "_name", F.explode(segment_probes(F.col("_name"), index.edits)).alias("_s"))
    asked = dimension_join(asked, index.crowded, ["_s"], "left").withColumn("_bucket", F.explode(F.sequence(F.lit(0), F.coalesce("_parts", F.lit(1)) - 1))).drop("_parts")
    near = asked.join(index.segments, ["_s", "_bucket"]).withColumn("_d", F.levenshtein("_name", "_spelt", index.edits)).filter("_d >= 0").drop("_s", "_bucket", "_name")
    return _best(near.join(names, KEY).withColumn("_score", _score(F.col("_d"))))


def higher_matches(names: DataFrame, index: NameIndex) -> DataFrame:
    """``_key, _taxon, _score, _margin`` of the most specific higher taxon that the backbone knows
    without doubt."""
    tries = names.withColumn(
        "_t",
        F.explode(
            F.array_compact(
                F.array(
                    *[
                        F.when(
                            has_value(F.col(_COLUMN[r])),
                            F.struct(F.lit(i).alias("pos"), F.lit(r.upper()).alias("_rank"), canonical_name(F.col(_COLUMN[r])).alias("_name")),
                        )
                        for i, r in enumerate(HIGHER_RANKS)
                    ]
                )
            )
        ),
    ).select(KEY, *_COLUMN.values(), F.lit(None).cast("string").alias("_given_rank"), F.lit(None).cast("string").alias("_author"), "_t.*")
    # Most names that nothing else matches share a few kingdoms and classes.
    on = ["_rank", "_name"]
    if fits_broadcast(index.higher):
        found = tries.join(F.broadcast(index.higher), on)
    else:
        found = skew_join(materialize(tries), index.higher, on, "inner", spread=[KEY])
    best = _best(found.withColumn("_score", _score(F.lit(0))), (KEY, "pos")).filter("_taxon IS NOT NULL")
    return best.groupBy(KEY).agg(F.min_by(F.struct("_taxon", "_score", "_margin"), "pos").alias("_b")).select(KEY, "_b.*")


def confidence(score: Column, margin: Column) -> Column:
    """0 to 100: the score, less what the next best taxon comes closer than ten points."""
    near = F.greatest(F.lit(0), F.lit(10) - F.coalesce(margin, F.lit(10)))
    return F.greatest(F.lit(0), F.least(F.lit(100), score) - near).cast("int")


def _note(score: Column, margin: Column) -> Column:
    """What the decision rests on."""
    return F.concat(F.lit("score "), score.cast("string"), F.when(margin.isNull(), "; no other candidate").otherwise(F.concat(F.lit("; next best "), (score - margin).cast("string"))))


def taxon_record(matches: DataFrame, backbone: DataFrame) -> DataFrame:
    """Turn ``_key, _taxon, _match`` into taxon columns; an accepted usage that is not given is the
    usage itself."""
    rows = backbone.select(
        F.col("key").alias("_taxon"),
        F.struct("key", "name", "rank").cast(_RANKED).alias("usage"),
        "status", "accepted_key", "classification", "nomenclature", "iucn", "parsed",
    )
    accepted = backbone.select(
        F.col("key").alias("accepted_key"), F.struct("key", "name", "rank").cast(_RANKED).alias("_accepted")
    )
    # Accepted usages are found once per usage; most have none, and many names have no usage.
    rows = spread_null_join(rows, accepted, ["accepted_key"], spread=["_taxon"])
    found = spread_null_join(matches, rows, ["_taxon"], spread=[KEY])
    matched = F.col("usage").isNotNull()
    none = incertae_sedis().cast(_RANKED)
    return found.select(
        KEY,
        F.when(matched, F.col("status").isin(*_SYNONYMS)).alias("synonym"),
        F.when(matched, F.col("usage")).otherwise(none).alias("usage"),
        F.when(matched, F.col("classification")).otherwise(F.array(none)).alias("classification"),
        F.when(matched, F.coalesce("_accepted", "usage")).alias("acceptedUsage"),
        F.col("nomenclature"),
        F.when(
            matched,
            F.struct(
                F.col("_match").alias("matchType"),
                confidence(F.col("_score"), F.col("_margin")).alias("confidence"),
                F.col("status").alias("status"),
                F.transform("classification", lambda c: c["name"]).alias("lineage"),
                _note(F.col("_score"), F.col("_margin")).alias("note"),
            ),
        ).cast(_DIAGNOSTIC).alias("diagnostics"),
        F.col("parsed").alias("usageParsedName"),
        F.col("iucn").alias("iucnRedListCategoryCode"),
        collect_issues(
            flag(F.col("_match") == "NONE", "TAXON_MATCH_NONE"),
            flag(F.col("_match") == "FUZZY", "TAXON_MATCH_FUZZY"),
            flag(F.col("_match") == "HIGHERRANK", "TAXON_MATCH_HIGHERRANK"),
        ).alias("issues"),
    )


def match_taxa(names: DataFrame, backbone: DataFrame | NameIndex, edits: int = MAX_EDITS) -> DataFrame:
    """Resolve distinct identifications (with ``_key``) to taxon columns, one row per key.

    Each step only sees what the one before left over: names as spelt, names within ``edits``,
    higher taxa.  Pass a :func:`name_index` to use it for several calls.  Authorship and rank
    (``scientificNameAuthorship``, ``rank``) are used where the names have these columns."""
    index = backbone if isinstance(backbone, NameIndex) else name_index(backbone, edits)
    given = lambda c: (F.col(c) if c in names.columns else F.lit(None)).cast("string")
    author = F.nullif(F.trim(given("scientificNameAuthorship")), F.lit(""))
    # An authorship that is given by itself need not stand behind the name as well.
    stripped = let(
        canonical_name(_query_name()),
        lambda name: let(F.concat(F.lit(" "), canonical_name(author)), lambda end: F.when(F.endswith(name, end), F.left(name, F.length(name) - F.length(end))).otherwise(name)),
    )
    queries = names.select(KEY, *_COLUMN.values(), stripped.alias("_name"), given("rank").alias("_given_rank"), author.alias("_author"))

    def step(todo: DataFrame, found: DataFrame, match: str) -> DataFrame:
        return todo.join(found.filter("_taxon IS NOT NULL").withColumn("_match", F.lit(match)), KEY, "left")

    left = ["_taxon", "_match", "_score", "_margin"]
    # What a step leaves over is read by the next one and by the result, so it is stored.
    one = materialize(step(queries, exact_matches(queries.filter("_name IS NOT NULL"), index), "EXACT"))
    todo = one.filter("_match IS NULL").drop(*left)
    two = materialize(step(todo, fuzzy_matches(todo, index), "FUZZY"))
    todo = two.filter("_match IS NULL").drop(*left)
    three = step(todo, higher_matches(todo, index), "HIGHERRANK")
    matches = (
        one.filter("_match IS NOT NULL").unionByName(two.filter("_match IS NOT NULL")).unionByName(three)
        .select(KEY, "_taxon", "_score", "_margin", F.coalesce("_match", F.lit("NONE")).alias("_match"))
    )
    return taxon_record(matches, index.backbone)
