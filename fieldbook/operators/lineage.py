"""Parent chains of events."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldbook.functions.issues import collect_issues, flag
from fieldbook.operators.checkpoints import materialize
from fieldbook.operators.joins import skew_join

LOOP_ISSUE = "EVENT_ID_TO_PARENT_ID_LOOPING_ISSUE"

_CHAIN = "array<struct<id:string,eventType:string>>"


def _ancestors(events: DataFrame, **skew) -> DataFrame:
    """Per event that is some event's parent: ``id, eventType``, its ancestors from the nearest up
    (``chain``, with their types), and whether the walk never ends (``loop``).

    Every event points to an ancestor (``jump``) and knows all before it.  In a round it takes over
    the chain and the pointer of the one it points to, so chains double by one join, and finished
    ones leave the joins.  An event of finite depth has ancestors of every smaller depth; so if none
    finishes in a round, none will any more, and what is left runs in circles.  No chain is compared
    with itself for that, and none of those grows beyond twice the longest finite one."""
    # Parents only: far fewer rows than events, and the leaves below a hot parent are left out.
    parents = events.select(F.col("parentId").alias("id")).filter("id IS NOT NULL").distinct()
    nodes = materialize(events.join(parents, "id", "left_semi").select("id", "parentId", "eventType"))
    above = nodes.select(F.col("id").alias("parentId"), F.array(F.struct("id", "eventType")).cast(_CHAIN).alias("_above"))
    start = skew_join(nodes, above, ["parentId"], "left", spread=["id"], **skew)
    reached = materialize(
        start.select(
            "id", "eventType",
            F.coalesce("_above", F.array().cast(_CHAIN)).alias("chain"),
            F.when(F.col("_above").isNotNull(), F.col("parentId")).alias("jump"),
        )
    )
    ended, before = reached.filter("jump IS NULL").count(), -1
    while ended != before:
        way = reached.select(F.col("id").alias("jump"), F.col("chain").alias("_chain"), F.col("jump").alias("_jump"))
        grown = skew_join(reached.filter("jump IS NOT NULL"), way, ["jump"], "inner", spread=["id"], **skew).select(
            "id", "eventType", F.concat("chain", "_chain").alias("chain"), F.col("_jump").alias("jump")
        )
        reached = materialize(reached.filter("jump IS NULL").unionByName(grown))
        before, ended = ended, reached.filter("jump IS NULL").count()
    loop = F.col("jump").isNotNull()
    return reached.select("id", "eventType", F.when(~loop, F.col("chain")).alias("chain"), loop.alias("loop"))


def expand_lineage(events: DataFrame, **skew) -> DataFrame:
    """Add the parents of each event to ``id, parentId, eventType``.

    ``parentsLineage`` holds ``(id, eventType, order)`` from the nearest parent, numbered from 1,
    up to the last one that exists; it is null where no parent was named or the chain loops, and
    the latter is an issue.  Types come out as they are in ``eventType``."""
    events = materialize(events.select("id", "parentId", "eventType"))
    # The chain of a parent is built once and shared by its children.
    lineage = _ancestors(events, **skew).select(
        F.col("id").alias("parentId"), F.concat(F.array(F.struct("id", "eventType")).cast(_CHAIN), F.col("chain")).alias("_chain"), F.col("loop").alias("_loop")
    )
    out = skew_join(events, lineage, ["parentId"], "left", spread=["id"], **skew)
    loop = F.coalesce(F.col("_loop"), F.lit(False))
    chain = F.transform(
        F.coalesce(F.col("_chain"), F.array().cast(_CHAIN)),
        lambda e, i: F.struct(e["id"].alias("id"), e["eventType"].alias("eventType"), (i + 1).alias("order")),
    )
    return out.select(
        "id",
        "parentId",
        "eventType",
        F.when(F.col("parentId").isNotNull() & ~loop, chain).alias("parentsLineage"),
        collect_issues(flag(loop, LOOP_ISSUE)).alias("issues"),
    )
