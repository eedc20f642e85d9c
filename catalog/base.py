"""Registration of queries, and the tables and fixtures they share."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldbook.plans import prepare_session

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

#: The run time of every query, so that results do not depend on the clock.
RUN_TS = datetime(2025, 1, 1, tzinfo=timezone.utc)


class Tables:
    """The given tables of one scale factor."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.dir = spark, sf_dir

    def __getattr__(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.dir}/{name}.parquet")


def query(name: str, oracle: str | None = None):
    """Register a query; the function gets the tables."""

    def register(fn: Callable[[Tables], DataFrame]):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            prepare_session(spark)
            return fn(Tables(spark, sf_dir))

        run.__name__ = name
        QUERIES[name] = run
        if oracle is not None:
            ORACLES[name] = oracle
        return fn

    return register


def joined(c) -> object:
    """An array as text, so that both engines compare it the same way; null stays null."""
    return F.when(c.isNotNull(), F.array_join(c, "|"))


def values(spark: SparkSession, rows: list[tuple], names: str) -> DataFrame:
    """A small dimension out of literals, with its size known to the planner."""

    def lit(v) -> str:
        if v is None:
            return "NULL"
        return "'" + v.replace("'", "\\'") + "'" if isinstance(v, str) else str(v)

    body = ", ".join("(" + ", ".join(lit(v) for v in r) + ")" for r in rows)
    return spark.sql(f"SELECT * FROM VALUES {body} AS t({names})")


def sql_values(rows: list[tuple], names: str) -> str:
    """The same rows for the SQL twin."""

    def lit(v) -> str:
        if v is None:
            return "NULL"
        return "'" + v.replace("'", "''") + "'" if isinstance(v, str) else str(v)

    body = ", ".join("(" + ", ".join(lit(v) for v in r) + ")" for r in rows)
    return f"(VALUES {body}) AS t({names})"


# --- vocabulary ----------------------------------------------------------------------------------

#: vocab, label, concept, lineage above the concept (nearest first, "/"-separated), tags (";").
VOCABULARY_ROWS = [
    ("eventType", "click", "Click", "Interaction/Activity", None),
    ("eventType", "view", "View", "Interaction/Activity", None),
    ("eventType", "purchase", "Purchase", "Activity", None),
    ("eventType", "sign-up", "Signup", None, None),
    ("priority", "1-URGENT", "Urgent", "High/Any", None),
    ("priority", "2-high", "High", "Any", None),
    ("priority", "3 MEDIUM", "Medium", "Any", None),
    ("basisOfRecord", "click", "HUMAN_OBSERVATION", None, None),
    ("basisOfRecord", "view", "MACHINE_OBSERVATION", None, None),
    ("basisOfRecord", "purchase", "PRESERVED_SPECIMEN", None, None),
    ("sex", "female", "Female", None, None),
    ("sex", "male", "Male", None, None),
    ("sex", "males", "Male", None, None),
    ("lifeStage", "adult", "Adult", None, None),
    ("lifeStage", "juvenile", "Juvenile", None, None),
    ("lifeStage", "larvae", "Larva", "Juvenile", None),
    ("occurrenceStatus", "present", "PRESENT", None, None),
    ("occurrenceStatus", "absent", "ABSENT", None, None),
    ("typeStatus", "small", "Holotype", "Type", None),
    ("typeStatus", "red", "Paratype", "Type", None),
    ("typeStatus", "widget", "Lectotype", "Type", None),
    ("typeStatus", "bolt", "Syntype", None, None),
    ("colour", "red", "RED", None, None),
    ("colour", "blue", "BLUE", None, None),
    ("colour", "green", "GREEN", None, None),
    ("colour", "crimson", "RED", None, None),
    ("continent", "africa", "AFRICA", None, None),
    ("continent", "asia", "ASIA", None, None),
    ("continent", "europe", "EUROPE", None, None),
    ("continent", "oceania", "OCEANIA", None, None),
    ("continent", "america", "NORTH_AMERICA", None, None),
    ("establishmentMeans", "native", "Native", None, None),
    ("degreeOfEstablishment", "managed", "Managed", "Captive", None),
    ("pathway", "escape", "Escape", "Unintended/Any", None),
    ("geologicalContext", "phanerozoic", "Phanerozoic", None, "rank:eon;startAge:538.8;endAge:0"),
    ("geologicalContext", "mesozoic", "Mesozoic", "Phanerozoic", "rank:era;startAge:251.9;endAge:66"),
    ("geologicalContext", "cenozoic", "Cenozoic", "Phanerozoic", "rank:era;startAge:66;endAge:0"),
    ("geologicalContext", "jurassic", "Jurassic", "Mesozoic/Phanerozoic", "rank:period;startAge:201.4;endAge:145"),
    ("geologicalContext", "cretaceous", "Cretaceous", "Mesozoic/Phanerozoic", "rank:period;startAge:145;endAge:66"),
    ("geologicalContext", "late jurassic", "Late Jurassic", "Jurassic/Mesozoic/Phanerozoic", "rank:epoch;startAge:161.5;endAge:145"),
    ("geologicalContext", "tithonian", "Tithonian", "Late Jurassic/Jurassic/Mesozoic/Phanerozoic", "rank:age;startAge:149.2;endAge:145"),
    ("geologicalContext", "neogene", "Neogene", "Cenozoic/Phanerozoic", "rank:period;startAge:23.03;endAge:2.58"),
]

_TAGS_OF = {c: (tags or "").split(";") for _, _, c, _, tags in VOCABULARY_ROWS if tags}


def vocabulary(spark: SparkSession) -> DataFrame:
    """The vocabulary fixture, prepared for lookups."""
    from fieldbook.operators.lookup import prepare_vocabulary

    def array(items) -> str:
        return "array(" + ", ".join(f"'{i}'" for i in items) + ")" if items else "cast(array() as array<string>)"

    def row(vocab, label, concept, above, tags) -> str:
        parents = ", ".join(
            f"named_struct('name', '{p}', 'tags', {array(_TAGS_OF.get(p, []))})" for p in (above or "").split("/") if p
        )
        kind = "array<struct<name:string,tags:array<string>>>"
        return (
            f"('{vocab}', '{label}', '{concept}', cast(array({parents}) as {kind}), {array((tags or '').split(';') if tags else [])})"
        )

    body = ", ".join(row(*r) for r in VOCABULARY_ROWS)
    return prepare_vocabulary(spark.sql(f"SELECT * FROM VALUES {body} AS t(vocab, label, concept, parents, tags)"))


def vocabulary_sql(vocab: str) -> str:
    """Label, concept and lineage text of one vocabulary for the SQL twin."""
    rows = [
        (
            "".join(ch for ch in label.lower() if ch.isalnum() or ch == "?"),
            concept,
            "|".join([*reversed((above or "").split("/") if above else []), concept]),
        )
        for v, label, concept, above, _ in VOCABULARY_ROWS
        if v == vocab
    ]
    return sql_values(rows, "label, concept, lineage")
