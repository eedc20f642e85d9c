"""Row-level gates and projections over verbatim records."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fieldbook.functions.terms import raw_term, term
from fieldbook.schema import LOCATION_TERMS, uri


def spread_rows(df: DataFrame) -> DataFrame:
    """The same rows, dealt out evenly over all cores.

    A task reads whole row groups, so a table of few large ones is read by few tasks, and all that is
    row-local runs in those.  Use it on plain tables, before records get wide.  Rows are dealt by
    the hash of all columns that have one, so null or repeated keys do not meet in a task."""
    spark = df.sparkSession
    tasks = max(spark.sparkContext.defaultParallelism, df.rdd.getNumPartitions())
    return df.repartition(tasks, *[F.col(f"`{f.name}`") for f in df.schema.fields if isinstance(f.dataType, T.AtomicType)])


def has_terms(terms: str = "coreTerms") -> Column:
    return F.coalesce(F.size(terms) > 0, F.lit(False))


def with_terms(df: DataFrame, terms: str = "coreTerms") -> DataFrame:
    """Only the records with a non-empty term map."""
    return df.filter(has_terms(terms))


def _valid(terms: str) -> Column:
    return F.coalesce(F.col("id") != "", F.lit(False)) & has_terms(terms)


def split_valid(df: DataFrame, terms: str = "coreTerms") -> tuple[DataFrame, DataFrame]:
    """Records with an id and core terms, and the rest with the reason."""
    reason = F.when(F.coalesce(F.col("id") == "", F.lit(True)), "ID_MISSING").otherwise("CORE_TERMS_MISSING")
    return df.filter(_valid(terms)), df.filter(~_valid(terms)).withColumn("reason", reason)


def split_repeated(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Records whose id occurs once, and all records of the other ids with the reason.  Ids are
    counted before the shuffle, so one that is repeated very often is no hot key."""
    twice = df.groupBy("id").count().filter("count > 1").select("id")
    return df.join(twice, "id", "left_anti"), df.join(twice, "id", "left_semi").withColumn("reason", F.lit("ID_REPEATED"))


def skip_when(df: DataFrame, *predicates: Column) -> DataFrame:
    """Drop the rows for which all of the predicates hold."""
    every = reduce(lambda a, b: a & b, [F.coalesce(p, F.lit(False)) for p in predicates])
    return df.filter(~every)


def carry_ids() -> list[Column]:
    """The id, core id and parent event id of a record."""
    return [F.col("id"), F.col("coreId"), term("parentEventID").alias("parentId")]


def extract_location(df: DataFrame, *more: str, terms: str = "coreTerms", keep: tuple[str, ...] = ()) -> DataFrame:
    """All location terms (and ``more``), untrimmed, as columns behind the ids; ``keep`` are columns
    of the table to carry along."""
    return df.select(*carry_ids(), *[raw_term(t, terms).alias(t) for t in (*LOCATION_TERMS, *more)], *keep)


def location_terms_map(cols=LOCATION_TERMS) -> Column:
    """The inverse of :func:`extract_location`: a term map of the location columns that are set."""
    entries = [
        F.when(F.col(c).isNotNull(), F.struct(F.lit(uri(c)).alias("key"), F.col(c).alias("value")))
        for c in cols
    ]
    return F.map_from_entries(F.array_compact(F.array(*entries)))
