"""Parent chains and chronostratigraphy."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog.base import ORACLES, Tables, VOCABULARY_ROWS, joined, query, sql_values, vocabulary
from fieldbook.operators import geology, lineage, lookup
from fieldbook.operators.records import spread_rows

#: Parents: a quarter of the id; event 0 has none, event 3 a missing one, and 1 and 5 are a loop.
_PARENT = "case when event_id = 0 then null when event_id = 1 then '5' when event_id = 3 then 'nowhere' else cast(floor(event_id / 4.0) as bigint) || '' end"

_WALK = f"""
    WITH RECURSIVE ev AS (SELECT cast(event_id AS varchar) AS id, {_PARENT} AS parent, coalesce(CASE event_type WHEN 'click' THEN 'Click' WHEN 'view' THEN 'View' WHEN 'purchase' THEN 'Purchase' WHEN 'signup' THEN 'Signup' END, event_type) AS kind FROM events),
    up AS (SELECT ev.id, p.id AS node, p.parent, p.kind, 1 AS pos, [p.id] AS path, false AS looped FROM ev JOIN ev p ON ev.parent = p.id
           UNION ALL SELECT up.id, p.id, p.parent, p.kind, pos + 1, list_append(path, p.id), list_contains(path, p.id) FROM up JOIN ev p ON up.parent = p.id WHERE NOT looped),
    agg AS (SELECT id, bool_or(looped) AS loop, string_agg(pos || ':' || node || ':' || kind, '|' ORDER BY pos) AS chain, count(*) AS n FROM up GROUP BY 1)
"""


def event_rows(t: Tables):
    """Events with the concept of their type, or the raw type where it has none."""
    e = t.events.selectExpr("cast(event_id as string) AS id", f"{_PARENT} AS parentId", "event_type")
    e = lookup.lookup_vocabulary(e, "event_type", vocabulary(t.spark), "eventType", "v")
    return e.select("id", "parentId", F.coalesce("v.concept", "event_type").alias("eventType"))


@query(
    "parent_lineage",
    f"""
    {_WALK}
    SELECT ev.id, ev.parent AS parent_id, CASE WHEN parent IS NOT NULL AND NOT coalesce(loop, false) THEN coalesce(chain, '') END AS lineage,
      CASE WHEN coalesce(loop, false) THEN 'EVENT_ID_TO_PARENT_ID_LOOPING_ISSUE' ELSE '' END AS issues
    FROM ev LEFT JOIN agg USING (id)
    """,
)
def parent_lineage(t: Tables):
    found = lineage.expand_lineage(event_rows(t))
    chain = F.transform("parentsLineage", lambda p: F.concat_ws(":", p["order"].cast("string"), p["id"], p["eventType"]))
    return found.select("id", F.col("parentId").alias("parent_id"), joined(chain).alias("lineage"), joined(F.col("issues")).alias("issues"))


_GEO = [
    (label, concept, above.split("/") if above else [], dict(x.split(":") for x in tags.split(";")))
    for v, label, concept, above, tags in VOCABULARY_ROWS
    if v == "geologicalContext"
]
_LEVEL = {r: i for i, r in enumerate(geology.RANKS)}


_RANK_NAMES = ("EON_OR_EONOTHEM", "ERA_OR_ERATHEM", "PERIOD_OR_SYSTEM", "EPOCH_OR_SERIES", "AGE_OR_STAGE")
_SHORT = [r[:3] for r in geology.RANKS]


def _at_rank_rows() -> list[tuple]:
    """For the SQL twin: what each label gives at each rank (label, rank, concept, start, end, issue)."""
    by_name = {concept: (above, tags) for _, concept, above, tags in _GEO}
    names = dict(zip(geology.RANKS, _RANK_NAMES))
    rows = []
    for label, concept, above, tags in _GEO:
        for rank, name in names.items():
            own = tags["rank"]
            if own == rank:
                rows.append((label, rank, concept, float(tags["startAge"]), float(tags["endAge"]), None))
            elif _LEVEL[own] > _LEVEL[rank]:
                hit = next(a for a in above if by_name[a][1]["rank"] == rank)
                t = by_name[hit][1]
                issue = None if rank == "eon" else f"{name}_INFERRED_FROM_PARENT_RANK"
                rows.append((label, rank, hit, float(t["startAge"]), float(t["endAge"]), issue))
            else:
                rows.append((label, rank, None, None, None, f"{name}_RANK_MISMATCH"))
    return rows


_LABELS = [r[0] for r in _GEO] + ["unheard of"]
_PICK = "element_at(array(" + ", ".join(f"'{x}'" for x in _LABELS) + "), cast({i} % " + str(len(_LABELS)) + " as int) + 1)"
_PICK_SQL = "(['" + "', '".join(_LABELS) + "'])[{i} % " + str(len(_LABELS)) + " + 1]"
#: Column → index into the labels, by part.
_CHOICES = {
    "e_eon": "p_partkey", "l_eon": "floor(p_partkey / 3)", "e_era": "floor(p_partkey / 5)", "l_era": "floor(p_partkey / 2)",
    "e_per": "floor(p_partkey / 7)", "l_per": "floor(p_partkey / 11)", "e_epo": "floor(p_partkey / 13)", "l_epo": "floor(p_partkey / 4)",
    "e_age": "floor(p_partkey / 6)", "l_age": "floor(p_partkey / 17)",
}


def _chronostratigraphy_sql() -> str:
    """Rank by rank; the parent of a rank is the nearest coarser one with a range."""
    of_rank = dict(zip(_SHORT, geology.RANKS))
    coarser = {x: _SHORT[:i][::-1] for i, x in enumerate(_SHORT)}
    first = lambda ranks, side: "CASE " + " ".join(f"WHEN s_{x} IS NOT NULL THEN {side}_{x}" for x in ranks) + " END"
    issues = [f"{c}_i" for c in _CHOICES]
    issues += [f"CASE WHEN bad_{x} THEN '{name}_INVALID_RANGE' END" for x, name in zip(_SHORT, _RANK_NAMES)]
    issues += [f"CASE WHEN s_{x} > ps_{x} OR t_{x} < pt_{x} THEN '{above}_AND_{name}_MISMATCH' END" for x, above, name in zip(_SHORT[1:], _RANK_NAMES, _RANK_NAMES[1:])]
    return f"""
    WITH r AS (SELECT * FROM {sql_values(_at_rank_rows(), "label, rank, concept, s, e, issue")}),
    p AS (SELECT p_partkey, {", ".join(f"{_PICK_SQL.format(i=f'cast({e} AS bigint)')} AS {c}" for c, e in _CHOICES.items())} FROM part),
    j AS (SELECT p_partkey, {", ".join(f"{c}_r.concept AS {c}_c, cast({c}_r.s AS float) AS {c}_s, cast({c}_r.e AS float) AS {c}_e, {c}_r.issue AS {c}_i" for c in _CHOICES)} FROM p
      {" ".join(f"LEFT JOIN r {c}_r ON {c}_r.label = {c} AND {c}_r.rank = '{of_rank[c[2:]]}'" for c in _CHOICES)}),
    k AS (SELECT *, {", ".join(f"coalesce(l_{x}_s > e_{x}_s OR l_{x}_e > e_{x}_e, l_{x}_s > e_{x}_s, l_{x}_e > e_{x}_e, false) AS bad_{x}" for x in _SHORT)} FROM j),
    m AS (SELECT *, {", ".join(f"CASE WHEN NOT bad_{x} THEN coalesce(e_{x}_s, l_{x}_s) END AS s_{x}, CASE WHEN NOT bad_{x} THEN coalesce(l_{x}_e, e_{x}_e) END AS t_{x}" for x in _SHORT)} FROM k),
    n AS (SELECT *, {", ".join(f"{first(coarser[x], 's')} AS ps_{x}, {first(coarser[x], 't')} AS pt_{x}" for x in _SHORT[1:])} FROM m)
    SELECT p_partkey, {", ".join(f"CASE WHEN NOT bad_{x} THEN e_{x}_c END AS earliest_{x}, CASE WHEN NOT bad_{x} THEN l_{x}_c END AS latest_{x}" for x in _SHORT)},
      {first(_SHORT[::-1], 's')} AS start_age, {first(_SHORT[::-1], 't')} AS end_age,
      array_to_string(list_sort(list_distinct(list_filter([{", ".join(issues)}], lambda x: x IS NOT NULL))), '|') AS issues
    FROM n
    """


@query("chronostratigraphy", _chronostratigraphy_sql())
def chronostratigraphy(t: Tables, **options):
    p = spread_rows(t.part).selectExpr("p_partkey", *[f"{_PICK.format(i=e)} AS {c}" for c, e in _CHOICES.items()])
    pairs = [(r, f"e_{r[:3]}", f"l_{r[:3]}") for r in geology.RANKS]
    g = geology.chronostratigraphy(p, pairs, vocabulary(t.spark), **options)
    return g.select(
        "p_partkey",
        *[F.col(f"geology_{r}.{side}.concept").alias(f"{side}_{r[:3]}") for r in geology.RANKS for side in ("earliest", "latest")],
        F.col("geology_range.start").alias("start_age"), F.col("geology_range.end").alias("end_age"),
        joined(F.array_sort("geology_issues")).alias("issues"),
    )


@query("chronostratigraphy_joined", ORACLES["chronostratigraphy"])
def chronostratigraphy_joined(t: Tables):
    """The path of vocabularies that are too large for a literal."""
    return chronostratigraphy(t, literal_rows=0)
