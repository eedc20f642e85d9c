"""Chronostratigraphy: five ranks from eon to age, each with an earliest and a latest concept."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldbook.functions.issues import collect_issues, flag, merge_issues
from fieldbook.functions.terms import clean
from fieldbook.functions.text import normalise_label
from fieldbook.operators.lookup import LITERAL_ROWS, lookup_vocabulary, vocabulary_map

RANKS = ("eon", "era", "period", "epoch", "age")

VOCAB = "geologicalContext"

_AT_RANK = (
    "struct<concept:struct<concept:string,lineage:array<string>,tags:array<struct<name:string,value:string>>>,"
    "start:float,end:float,issue:string>"
)

_NAMES = {
    "eon": "EON_OR_EONOTHEM",
    "era": "ERA_OR_ERATHEM",
    "period": "PERIOD_OR_SYSTEM",
    "epoch": "EPOCH_OR_SERIES",
    "age": "AGE_OR_STAGE",
}


def tag_list(tags: Column) -> Column:
    """A tag map as (name, value) structs in name order."""
    return F.transform(
        F.array_sort(F.map_entries(tags)), lambda e: F.struct(e["key"].alias("name"), e["value"].alias("value"))
    )


def concept_at_rank(hit: Column, rank: str) -> Column:
    """Struct of the concept at the wanted rank and an issue.

    ``hit`` is a vocabulary row (concept, lineage, tags, parents).  A finer concept gives way to
    its ancestor at that rank; a coarser one is a mismatch."""
    order = F.create_map(*[x for i, r in enumerate(RANKS) for x in (F.lit(r), F.lit(i))])
    own = hit["tags"]["rank"]
    level, wanted = F.coalesce(order[own], F.lit(-1)), RANKS.index(rank)
    parents = hit["parents"]
    ancestor = F.get(F.filter(parents, lambda p: p["tags"]["rank"] == rank), F.lit(0))
    # Parents run upwards, so what is above the ancestor comes after it.
    at = F.array_position(F.transform(parents, lambda p: p["name"]), ancestor["name"]).cast("int")
    above = F.transform(F.slice(parents, at + 1, F.size(parents)), lambda p: p["name"])
    exact = own == rank
    finer = ~exact & (level > wanted) & ancestor.isNotNull()
    tags_type = "array<struct<name:string,value:string>>"
    concept = F.when(
        exact,
        F.struct(hit["concept"].alias("concept"), hit["lineage"].alias("lineage"), tag_list(hit["tags"]).cast(tags_type).alias("tags")),
    ).when(
        finer,
        F.struct(
            ancestor["name"].alias("concept"),
            F.concat(F.reverse(above), F.array(ancestor["name"])).alias("lineage"),
            tag_list(ancestor["tags"]).cast(tags_type).alias("tags"),
        ),
    )
    age_tags = F.when(exact, hit["tags"]).when(finer, ancestor["tags"])
    issue = F.when(finer & F.lit(rank != "eon"), f"{_NAMES[rank]}_INFERRED_FROM_PARENT_RANK").when(
        hit.isNotNull() & ~F.coalesce(exact, F.lit(False)) & (level <= wanted), f"{_NAMES[rank]}_RANK_MISMATCH"
    )
    return F.struct(
        concept.alias("concept"),
        age_tags["startage"].try_cast("float").alias("start"),
        age_tags["endage"].try_cast("float").alias("end"),
        issue.alias("issue"),
    )


def check_range(early: Column, late: Column, parent: Column | None, rank: str) -> Column:
    """Struct of both concepts, the age range and the issues of one rank.

    A latest concept older than the earliest drops both; a range that leaves that of the coarser
    rank is flagged and kept."""
    has = early["concept"].isNotNull() | late["concept"].isNotNull()
    invalid = F.coalesce((late["start"] > early["start"]) | (late["end"] > early["end"]), F.lit(False))
    start = F.when(~invalid, F.coalesce(early["start"], late["start"]))
    end = F.when(~invalid, F.coalesce(late["end"], early["end"]))
    issues = [early["issue"], late["issue"], flag(has & invalid, f"{_NAMES[rank]}_INVALID_RANGE")]
    if parent is not None:
        outside = (start > parent["start"]) | (end < parent["end"])
        above = _NAMES[RANKS[RANKS.index(rank) - 1]]
        issues.append(flag(outside, f"{above}_AND_{_NAMES[rank]}_MISMATCH"))
    return F.struct(
        F.when(~invalid, early["concept"]).alias("earliest"),
        F.when(~invalid, late["concept"]).alias("latest"),
        start.alias("start"),
        end.alias("end"),
        collect_issues(*issues).alias("issues"),
    )


def most_specific(ranges: list[Column]) -> Column:
    """Start and end of the first range, from the finest rank, that has either."""
    return F.coalesce(
        *[
            F.when(
                r["start"].isNotNull() | r["end"].isNotNull(),
                F.struct(r["start"].alias("start"), r["end"].alias("end")),
            )
            for r in ranges
        ]
    )


def chronostratigraphy(
    df: DataFrame,
    pairs: list[tuple[str, str, str]],
    vocabulary: DataFrame,
    *,
    out: str = "geology",
    vocab: str = VOCAB,
    small: bool | None = None,
    literal_rows: int = LITERAL_ROWS,
) -> DataFrame:
    """Add ``{out}_{rank}`` per rank, ``{out}_range`` (the age range) and ``{out}_issues``.

    ``pairs`` lists (rank, earliest column, latest column) from the eon to the age."""
    keep = df.columns
    row = F.struct("concept", "lineage", "tags", "parents")
    # What a label gives at a rank depends on the vocabulary alone, so it is found there, not per record.
    at_rank = {rank: concept_at_rank(row, rank) for rank, _, _ in pairs}
    sides = [(f"_{side}_{rank}", rank, clean(F.col(col))) for rank, early, late in pairs for side, col in (("e", early), ("l", late))]
    # Few records have any of these terms, so a literal map beats ten joins.
    kind = "struct<" + ",".join(f"{rank}:{_AT_RANK}" for rank in at_rank) + ">"
    entries = vocabulary_map(vocabulary, vocab, F.struct(*[c.alias(rank) for rank, c in at_rank.items()]), kind, literal_rows)
    if entries is not None:
        df = df.withColumns({name: F.when(text.isNotNull(), entries[normalise_label(text)][rank]) for name, rank, text in sides})
    else:
        for name, rank, text in sides:
            df = lookup_vocabulary(df, text, vocabulary, vocab, name, value=at_rank[rank], small=small)
    done: list[str] = []
    for rank, _, _ in pairs:
        parent = most_specific([F.col(f"_r_{r}") for r in reversed(done)]) if done else None
        any_hit = F.col(f"_e_{rank}").isNotNull() | F.col(f"_l_{rank}").isNotNull()
        df = df.withColumn(f"_r_{rank}", F.when(any_hit, check_range(F.col(f"_e_{rank}"), F.col(f"_l_{rank}"), parent, rank)))
        done.append(rank)
    return df.select(
        *keep,
        *[
            F.struct(F.col(f"_r_{rank}.earliest").alias("earliest"), F.col(f"_r_{rank}.latest").alias("latest")).alias(f"{out}_{rank}")
            for rank in done
        ],
        most_specific([F.col(f"_r_{r}") for r in reversed(done)]).alias(f"{out}_range"),
        merge_issues(*[F.col(f"_r_{r}.issues") for r in done]).alias(f"{out}_issues"),
    )
