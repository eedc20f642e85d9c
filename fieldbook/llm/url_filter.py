"""URL verdicts by rules and by logistic regression on character n-grams (operator 3)."""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import ship

ALLOW, BLOCK = "allow", "block"

#: Letters that count as upper case: ASCII only, on hosts.
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def split_url(url: Column) -> tuple[Column, Column]:
    """Host and path.  The host runs from the first ``://`` to ``/``, ``?``, ``#`` or the end, in
    ASCII lower case; the path from there to ``?``, ``#`` or the end.  A null url, or one without
    ``://``, has both empty."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))
    rest = F.coalesce(F.regexp_extract(rest, r"(?s)^([^?#]*)", 1), F.lit(""))
    return F.translate(F.regexp_extract(rest, r"(?s)^([^/]*)", 1), UPPER, LOWER), F.regexp_extract(rest, r"(?s)^[^/]*(.*)$", 1)


def matching_rule(host: Column, path: Column, rules: list[tuple[str, str]]) -> Column:
    """The longest of the rules ``(verdict, host/path)`` that fits, as a struct, or null.  A rule
    fits its host and all subdomains if the path starts with the rule's."""

    def fits(rule: str) -> Column:
        at = rule.index("/")
        return ((host == rule[:at]) | host.endswith("." + rule[:at])) & path.startswith(rule[at:])

    ordered = sorted(rules, key=lambda r: -len(r[1]))
    return reduce(lambda acc, r: acc.when(fits(r[1]), F.struct(F.lit(r[1]).alias("rule"), F.lit(r[0]).alias("verdict"))), ordered, F.when(F.lit(False), F.lit(None).cast("struct<rule:string,verdict:string>")))


def features(host: str, path: str, bits: int) -> np.ndarray:
    """Buckets of the distinct 2- to 5-grams of host and path, hashed apart."""
    out = []
    for field, text in ((1, host), (2, path)):
        raw = np.frombuffer(f"^{text}$".encode(), np.uint8).astype(np.uint64)
        h = np.full(len(raw), field, np.uint64)
        for n in range(5):
            if len(raw) <= n:
                break
            h = (h[: len(raw) - n] * np.uint64(0x9E3779B97F4A7C15)) ^ (raw[n:] * np.uint64(0xC2B2AE3D27D4EB4F))
            h ^= h >> np.uint64(29)
            if n:
                out.append((h * np.uint64(0xD6E8FEB86659FD93)) >> np.uint64(64 - bits))
    return np.unique(np.concatenate(out)).astype(np.int64)


def train(rows: list[tuple[str, str, bool]], bits: int = 16, epochs: int = 8, rate: float = 0.5, l2: float = 1e-6) -> np.ndarray:
    """Weights (the bias is last) by AdaGrad on the log loss, classes weighted to count alike; all
    zero, so undecided, if there are no rows."""
    weights, square = np.zeros((1 << bits) + 1), np.full((1 << bits) + 1, 1e-3)
    data = [(np.append(features(h, p, bits), 1 << bits), float(y)) for h, p, y in rows]
    positive = sum(y for _, y in data)
    share = {1.0: len(data) / (2 * max(positive, 1)), 0.0: len(data) / (2 * max(len(data) - positive, 1))}
    random = np.random.default_rng(0)
    for _ in range(epochs):
        for k in random.permutation(len(data)):
            f, y = data[k]
            scale = 1 / np.sqrt(len(f))
            g = (1 / (1 + np.exp(-weights[f].sum() * scale)) - y) * share[y] * scale + l2 * weights[f]
            square[f] += g * g
            weights[f] -= rate * g / np.sqrt(square[f])
    return weights


def labelled_sample(labelled: DataFrame, most: int) -> list[tuple[str, str, bool]]:
    """At most ``most`` distinct rows ``host, path, blocked`` of each class: those with the least
    hash, the same ones however the table is stored."""
    out = []
    for value in (True, False):
        rows = labelled.where(F.col("blocked") == value).select("host", "path").distinct()
        out += [(r["host"], r["path"], value) for r in rows.orderBy(F.xxhash64("host", "path"), "host", "path").limit(most).collect()]
    return out


def judge_urls(
    pages: DataFrame, rules: list[tuple[str, str]], labelled: DataFrame | None = None, most: int = 4000, threshold: float = 0.5, bits: int = 16, id_col: str = "page_id", url_col: str = "url"
) -> DataFrame:
    """``page_id, host, path, rule, verdict, p_block`` for every row of ``pages``.

    Where a rule fits, the longest one decides and ``p_block`` is null.  All other urls are judged
    by logistic regression on hashed character n-grams of host and path: blocked from
    ``threshold`` on.  It is trained on ``labelled`` (``host, path, blocked``), by default on what
    the rules say about the pages themselves, on at most ``most`` distinct urls of either class;
    that bound is all the driver ever holds.  Without labels of both classes the model is
    undecided and everything is allowed.

    Null urls and urls without ``://`` have an empty host and path and are judged like others.
    Null and repeated ids are kept row by row; an empty table gives an empty result; further
    columns are ignored."""
    ship(pages.sparkSession)
    host, path = split_url(F.col("url"))
    base = pages.select(pages[id_col].cast("bigint").alias("page_id"), pages[url_col].cast("string").alias("url"))
    ruled = base.select("page_id", host.alias("host"), path.alias("path")).withColumn("hit", matching_rule(F.col("host"), F.col("path"), rules))
    if labelled is None:
        labelled = ruled.where(F.col("hit").isNotNull()).select("host", "path", (F.col("hit.verdict") == BLOCK).alias("blocked"))
    rows = labelled_sample(labelled, most)
    weights = train(rows, bits) if len({r[2] for r in rows}) == 2 else np.full((1 << bits) + 1, -0.0)
    undecided = not weights.any()
    shared = pages.sparkSession.sparkContext.broadcast(weights)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w = shared.value
        for batch in batches:
            ps = []
            for h, p, rule in zip(*(batch.column(k).to_pylist() for k in (1, 2, 3))):
                if rule is not None:
                    ps.append(None)
                elif undecided:
                    ps.append(0.0)
                else:
                    f = np.append(features(h, p, bits), 1 << bits)
                    ps.append(float(1 / (1 + np.exp(-w[f].sum() / np.sqrt(len(f))))))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(ps, pa.float64())], [*batch.schema.names, "p_block"])

    scored = ruled.select("page_id", "host", "path", "hit.rule", F.col("hit.verdict").alias("said")).mapInArrow(
        run, "page_id bigint, host string, path string, rule string, said string, p_block double"
    )
    verdict = F.coalesce("said", F.when(F.col("p_block") >= threshold, BLOCK).otherwise(ALLOW))
    return scored.select("page_id", "host", "path", "rule", verdict.alias("verdict"), "p_block")
