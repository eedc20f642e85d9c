"""The registered queries of the operators: whole tables, production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .shared import ship

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, oracle: str | None = None):
    def register(fn: Callable[[SparkSession, str], DataFrame]):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return fn(ship(spark), sf_dir)

        run.__name__ = name
        QUERIES[name] = run
        if oracle is not None:
            ORACLES[name] = oracle
        return fn

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def vocabulary(name: str) -> str:
    """The place of a public tokenizer's file."""
    import public_tokenizers

    return public_tokenizers.path(name)


def pattern() -> str:
    import public_tokenizers

    return public_tokenizers.PATTERN


@query("op10_bpe_codec")
def op10_bpe_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .bpe_codec import decode, encode, with_digests

    ranks, split = vocabulary("byte_bpe_multi_50k.tiktoken"), pattern()
    return with_digests(decode(encode(table(spark, sf_dir, "documents"), ranks, split), ranks, split))


@query("op2_packing")
def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .packing import pack

    pieces = pack(table(spark, sf_dir, "documents"), vocabulary("byte_bpe_50k.json"), 1024)
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


#: The rules of the contract.
URL_RULES = [("allow", "com/"), ("block", "example.com/en/"), ("allow", "www.example.com/en/"), ("block", "net/es/"), ("block", "net/fr/")]


@query("op3_url_filter")
def op3_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .url_filter import judge_urls

    return judge_urls(table(spark, sf_dir, "pages"), URL_RULES)


@query("op7_token_counts")
def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .token_counts import section_counts

    return section_counts(table(spark, sf_dir, "documents"), vocabulary("byte_bpe_50k.json"))


@query("op9_jaccard_join")
def op9_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .jaccard import near_duplicates

    return near_duplicates(table(spark, sf_dir, "documents")).select("doc_id", "class_id", "n_links", "is_first")


@query("op8_suffix_dedup")
def op8_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .suffix_dedup import remove_repeats

    return remove_repeats(table(spark, sf_dir, "documents"), 200).select(
        "doc_id", "n_bytes", (F.col("n_bytes") - F.length("kept")).cast("bigint").alias("n_removed"), F.size("spans").cast("bigint").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256")
    )


@query("op4_quality_rules")
def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .quality import judge_quality

    return judge_quality(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "p_good", "votes"
    )


@query("op6_ann")
def op6_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .ann import neighbours

    return neighbours(table(spark, sf_dir, "embeddings"))


@query("op5_licence_scan")
def op5_licence_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .licence import by_document, licences

    docs = table(spark, sf_dir, "documents")
    return by_document(docs, licences(docs)).select("doc_id", "n_notices", F.array_join("licences", ",").alias("licences"), "probability")


@query("op1_lm_scoring")
def op1_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .maxent import score_texts

    return score_texts(table(spark, sf_dir, "documents"))


from . import queries_more  # noqa: E402, F401  (registers the queries of operators 11 to 13)
