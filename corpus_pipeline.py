"""The corpus pipeline: documents to packed training sequences."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldbook.llm.jaccard import one_of_each
from fieldbook.llm.packing import pack
from fieldbook.llm.quality import judge_quality
from fieldbook.llm.queries import vocabulary
from fieldbook.llm.shared import keep, ship
from fieldbook.llm.suffix_dedup import remove_repeats

#: SQL has no tokenizer; the pipeline is tested against a brute-force version.
ORACLE_SQL = None


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the quality rules keep, as they are."""
    return judge_quality(docs, whole_rows=True).where("kept").select("record.*")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: the one with the least id."""
    return one_of_each(docs)


def suffix_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the strings of 200 bytes that occur more than once; documents of which
    nothing is left go."""
    cut = remove_repeats(docs, 200, whole_rows=True).where("kept_text <> ''")
    new = {"text": F.col("kept_text"), "n_chars": F.length("kept_text").cast("bigint")}
    return cut.select(*[new.get(c, F.col(f"record.{c}")).alias(c) for c in docs.columns])


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of sequences of at most 1,024 ids: ``ids`` are unsigned 32-bit, little-endian."""
    return pack(docs, vocabulary("byte_bpe_50k.json"), 1024)


STAGES = [("quality rules", quality_rules), ("n-gram Jaccard join", near_duplicates), ("suffix-array dedup", suffix_dedup), ("packing", packing)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; every stage but the last is written and read again."""
    ship(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = keep(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
