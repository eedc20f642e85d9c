"""Approximate nearest neighbours by adaptive dimension scan (operator 6).

Vectors are rotated at random and cut into blocks of columns.  A list of an inverted file is
scanned block by block; after each block a hypothesis test on the partial distance abandons the
candidates that will not come near enough."""

from __future__ import annotations

from collections.abc import Iterator
from math import ceil, sqrt

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .shared import columns_as, keep, ship

#: Columns of a block, and the quantile of the test.
COLUMNS, QUANTILE = 16, 2.5

#: Vectors and queries that meet in one task, and the part of a query's lists that is scanned first.
BLOCK, FIRST = 4096, 0.1

#: Rows that centroids are fitted on, rows that give first thresholds, and queries that the number
#: of probed lists is chosen by.
SAMPLE, SEEDS, TRIALS = 20_000, 2_048, 64


def valid(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """``id, v`` (array of double) of the rows that take part: an id, and a vector that is not
    zero, has no null or non-finite components, and has the length that most of these have (the
    longest if there are several)."""
    v = columns_as(vectors, id=id_col, v=vector_col).select(F.col("id").cast("bigint").alias("id"), F.col("v").cast("array<double>").alias("v")).where("id is not null and v is not null")
    good = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    v = v.where(F.forall("v", good) & F.exists("v", lambda x: x != 0))
    most = v.groupBy(F.size("v").alias("dim")).count().orderBy(F.desc("count"), F.desc("dim")).first()
    return v.where(F.size("v") == (most["dim"] if most else 0))


def augmented(x: np.ndarray, norm: float, rotation: np.ndarray) -> np.ndarray:
    """One more component that gives all vectors the same norm, so that the nearest is the one
    with the largest inner product; then rotated."""
    rest = np.sqrt(np.maximum(norm * norm - np.einsum("ij,ij->i", x, x), 0))
    return np.concatenate((x, rest[:, None]), axis=1) @ rotation


def as_queries(x: np.ndarray, norm: float, rotation: np.ndarray) -> np.ndarray:
    """Queries have 0 there, and any length: it does not change the order of inner products."""
    unit = x * (norm / np.sqrt(np.einsum("ij,ij->i", x, x)))[:, None]
    return np.concatenate((unit, np.zeros((len(x), 1))), axis=1) @ rotation


def centroids(x: np.ndarray, k: int, rounds: int = 8) -> np.ndarray:
    """k-means on a sample."""
    random = np.random.default_rng(0)
    c = x[random.choice(len(x), k, replace=len(x) < k)]
    for _ in range(rounds):
        near = nearest(x, c)
        sums, n = np.zeros_like(c), np.bincount(near, minlength=k)
        np.add.at(sums, near, x)
        c = np.where(n[:, None] > 0, sums / np.maximum(n, 1)[:, None], x[random.choice(len(x), k)])
    return c


def nearest(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    return np.concatenate([(np.einsum("ij,ij->i", c, c) - 2 * x[at : at + 4096] @ c.T).argmin(axis=1) for at in range(0, len(x), 4096)])


def matrix(column: pa.Array) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1) if len(column) else flat.reshape(0, 1)


def scan(q: np.ndarray, x: np.ndarray, reach: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (query, candidate) that no test abandons.  ``reach``: squared distance per query that
    a candidate must not exceed.  After ``d`` of all ``n`` dimensions the partial distance, scaled
    to all, is held against it with a tolerance that shrinks as ``d`` grows."""
    n, qi, xi, partial = q.shape[1], None, None, None
    for at in range(0, n, COLUMNS):
        a, b = q[:, at : at + COLUMNS], x[:, at : at + COLUMNS]
        d = min(at + COLUMNS, n)
        if qi is None:
            part = np.einsum("ij,ij->i", a, a)[:, None] + np.einsum("ij,ij->i", b, b)[None, :] - 2 * a @ b.T
        else:
            diff = a[qi] - b[xi]
            part = partial + np.einsum("ij,ij->i", diff, diff)
        slack = (1 + QUANTILE / sqrt(d)) ** 2 * d / n if d < n else 1 + 1e-9
        if qi is None:
            qi, xi = np.nonzero(part <= slack * reach[:, None] + 1e-9)
            partial = part[qi, xi]
        else:
            stay = part <= slack * reach[qi] + 1e-9
            qi, xi, partial = qi[stay], xi[stay], part[stay]
    return qi, xi


def neighbours(vectors: DataFrame, k: int = 20, every: int = 20, recall: float = 0.97, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """``query_id, rank, vec_id, score``: for every row whose id is divisible by ``every``, its
    ``k`` neighbours with the largest inner product (in double precision on the vectors as they
    are) that were found among all other rows, ties to the smaller id.

    Vectors get one more component that turns inner products into distances, are rotated and put
    into the list of the nearest of about sqrt(n) centroids; centroids come from a k-means on at
    most ``SAMPLE`` rows, the index has every row.  How many lists a query probes is set by brute
    force: ``TRIALS`` queries are held against all rows, and the least number is taken that finds
    a part ``recall`` of their true neighbours.  Every query starts with the k-th best inner
    product on ``SEEDS`` rows as threshold, which the tests refer to.  Its nearest lists are scanned
    first, a part ``FIRST`` of those it probes; the k-th best product found there is the threshold of
    the rest, so that only what improves on it leaves a task.

    Lists of more than ``BLOCK`` vectors, and the queries of a list beyond that many, are split;
    every block of vectors meets every block of queries of its list, so no list is too large for a
    task.  Rows without id, and vectors that are null, zero, of another length or hold null or
    non-finite components take no part.  A query's own id is no candidate; rows that repeat id and
    vector are one.  Tables without valid vectors give an empty result; further columns are
    ignored."""
    spark = ship(vectors.sparkSession)
    rows = keep(valid(vectors, id_col, vector_col), "ann-vectors")
    result = "query_id bigint, rank int, vec_id bigint, score double"
    total, square = rows.agg(F.count("*"), F.max(F.aggregate("v", F.lit(0.0), lambda s, e: s + e * e))).first()
    if not total:
        return spark.createDataFrame([], result)
    norm = sqrt(square)

    def least_hash(df: DataFrame, n: int, salt: int) -> DataFrame:
        return df.orderBy(F.xxhash64("id", F.lit(salt)), "id").limit(n)

    sample = least_hash(rows, SAMPLE, 1).collect()
    data = np.array([r["v"] for r in sample])
    dim = data.shape[1]
    rotation = np.linalg.qr(np.random.default_rng(1).normal(size=(dim + 1, dim + 1)))[0]
    lists = int(min(max(ceil(sqrt(total)), 1), 4096, len(data)))
    seeds, seed_ids = data[:SEEDS], np.array([r["id"] for r in sample[:SEEDS]])
    shared = spark.sparkContext.broadcast((centroids(augmented(data, norm, rotation), lists), seeds, seed_ids))

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = shared.value[0]
        for batch in batches:
            if batch.num_rows:
                x = augmented(matrix(batch.column(1)), norm, rotation)
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(nearest(x, c).astype(np.int32))], ["id", "v", "list"])

    index = keep(rows.mapInArrow(assign, "id bigint, v array<double>, list int"), "ann-index")
    queries = rows.where(F.col("id") % every == 0)
    probes = _probes(index, least_hash(queries.dropDuplicates(["id"]), TRIALS, 2), shared.value[0], norm, rotation, k, recall)

    def seeded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _, seeds, seed_ids = shared.value
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                part = batch.slice(at, 1024)
                ids, v = part.column(0).to_numpy(), matrix(part.column(1))
                known = np.where(ids[:, None] == seed_ids[None, :], -np.inf, v @ seeds.T)
                floor = -np.sort(-known, axis=1)[:, k - 1] if known.shape[1] >= k else np.full(len(v), -np.inf)
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(np.where(np.isfinite(floor), floor, -1e300))], ["id", "v", "floor"])

    first = max(1, ceil(FIRST * probes))

    def route(low: int, high: int):
        """Queries with the lists that stand at these places in their order of nearness."""

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            c = shared.value[0]
            for batch in batches:
                for at in range(0, batch.num_rows, 1024):
                    part = batch.slice(at, 1024)
                    q = as_queries(matrix(part.column(1)), norm, rotation)
                    order = np.argsort(np.einsum("ij,ij->i", c, c) - 2 * q @ c.T, axis=1, kind="stable")[:, low:high]
                    floor = part.column(2).to_numpy()
                    floor = np.where(floor > -1e299, floor - 1e-9 * np.abs(floor) - 1e-12, floor)
                    take = pa.array(np.repeat(np.arange(part.num_rows), order.shape[1]))
                    yield pa.RecordBatch.from_arrays(
                        [part.column(0).take(take), part.column(1).take(take), pa.array(np.repeat(floor, order.shape[1])), pa.array(order.ravel().astype(np.int32))], ["id", "v", "floor", "list"]
                    )

        return run

    def split(df: DataFrame, blocks: DataFrame, own: str, n: str, other: str, m: str) -> DataFrame:
        cut = df.join(blocks, "list").withColumn(own, F.pmod(F.xxhash64("id"), F.col(n)).cast("int"))
        return cut.withColumn(other, F.explode(F.sequence(F.lit(0), F.col(m) - 1))).drop(n, m)

    def meet(queries: pd.DataFrame, candidates: pd.DataFrame) -> pd.DataFrame:
        none = pd.DataFrame({"query_id": [], "vec_id": [], "score": []}).astype({"query_id": "int64", "vec_id": "int64"})
        if queries.empty or candidates.empty:
            return none
        qv, xv = np.stack(queries["v"].to_list()), np.stack(candidates["v"].to_list())
        qid, xid = queries["id"].to_numpy(), candidates["id"].to_numpy()
        x = augmented(xv, norm, rotation)
        out = []
        for at in range(0, len(qv), 512):
            part, ids = qv[at : at + 512], qid[at : at + 512]
            length = np.sqrt(np.einsum("ij,ij->i", part, part))
            floor = queries["floor"].to_numpy()[at : at + 512]
            reach = np.maximum(2 * norm * norm - 2 * floor * norm / length, 0)
            qi, xi = scan(as_queries(part, norm, rotation), x, reach)
            other = ids[qi] != xid[xi]
            qi, xi = qi[other], xi[other]
            score = np.empty(len(qi))
            for s in range(0, len(qi), 100_000):
                score[s : s + 100_000] = (part[qi[s : s + 100_000]] * xv[xi[s : s + 100_000]]).sum(axis=1)
            order = np.lexsort((xid[xi], -score, qi))
            qi, xi, score = qi[order], xi[order], score[order]
            first = np.searchsorted(qi, qi, "left")
            best = np.arange(len(qi)) - first < k
            out.append(pd.DataFrame({"query_id": ids[qi[best]], "vec_id": xid[xi[best]], "score": score[best]}))
        return pd.concat(out) if out else none

    def start(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The best of the seeds: what the threshold comes from counts as found."""
        _, seeds, seed_ids = shared.value
        for batch in batches:
            if batch.num_rows:
                ids, v = batch.column(0).to_numpy(), matrix(batch.column(1))
                known = np.where(ids[:, None] == seed_ids[None, :], -np.inf, v @ seeds.T)
                qi, xi = np.nonzero(known >= -np.sort(-known, axis=1)[:, [min(k, known.shape[1]) - 1]])
                qi, xi = qi[np.isfinite(known[qi, xi])], xi[np.isfinite(known[qi, xi])]
                yield pa.RecordBatch.from_arrays([pa.array(ids[qi]), pa.array(seed_ids[xi]), pa.array((v[qi] * seeds[xi]).sum(axis=1))], ["query_id", "vec_id", "score"])

    # As many rows as lists.
    sizes = keep(index.groupBy("list").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("parts")), "ann-sizes")

    def search(asked: DataFrame, low: int, high: int) -> DataFrame:
        routed = asked.mapInArrow(route(low, high), "id bigint, v array<double>, floor double, list int")
        counts = routed.groupBy("list").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("asked"))
        blocks = F.broadcast(keep(sizes.join(counts, "list"), "ann-blocks"))
        left = split(routed, blocks, "qp", "asked", "xp", "parts").select("list", "qp", "xp", "id", "v", "floor")
        right = split(index, blocks, "xp", "parts", "qp", "asked").select("list", "qp", "xp", "id", "v")
        key = ["list", "qp", "xp"]
        return left.groupBy(*key).cogroup(right.groupBy(*key)).applyInPandas(meet, "query_id bigint, vec_id bigint, score double")

    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")

    def top(found: DataFrame) -> DataFrame:
        return found.distinct().withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)

    asked = keep(queries.mapInArrow(seeded, "id bigint, v array<double>, floor double"), "ann-queries")
    seen = queries.mapInArrow(start, "query_id bigint, vec_id bigint, score double")
    near = keep(top(search(asked, 0, first).union(seen)).drop("rank"), "ann-near")
    if first < probes:
        floors = near.groupBy(F.col("query_id").alias("id")).agg(F.min("score").alias("least"), F.count("*").alias("n")).where(F.col("n") == k)
        nearer = asked.join(floors, "id", "left").select("id", "v", F.greatest("floor", "least").alias("floor"))
        near = near.union(search(keep(nearer, "ann-thresholds"), first, probes))
    return top(near).select("query_id", "rank", "vec_id", "score")


def _probes(index: DataFrame, trials: DataFrame, c: np.ndarray, norm: float, rotation: np.ndarray, k: int, recall: float) -> int:
    """Lists to probe: the trial queries' true neighbours by brute force over the index, and where
    their lists stand in each query's order."""
    rows = trials.collect()
    if not rows:
        return 1
    ids, v = np.array([r["id"] for r in rows]), np.array([r["v"] for r in rows])
    order = np.argsort(np.einsum("ij,ij->i", c, c) - 2 * as_queries(v, norm, rotation) @ c.T, axis=1, kind="stable")
    place = np.argsort(order, axis=1)

    def brute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            xid, lists = batch.column(0).to_numpy(), batch.column(2).to_numpy()
            score = np.where(ids[:, None] == xid[None, :], -np.inf, v @ matrix(batch.column(1)).T)
            top = np.argsort(-score, axis=1, kind="stable")[:, :k]
            trial = np.repeat(np.arange(len(v)), top.shape[1])
            top = top.ravel()
            yield pa.RecordBatch.from_arrays([pa.array(trial), pa.array(score[trial, top]), pa.array(xid[top]), pa.array(place[trial, lists[top]])], ["trial", "score", "id", "place"])

    near = index.mapInArrow(brute, "trial bigint, score double, id bigint, place bigint").where(F.col("score") > float("-inf"))
    best = Window.partitionBy("trial").orderBy(F.desc("score"), "id")
    places = [r["place"] for r in near.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select("place").collect()]
    return int(np.sort(places)[min(ceil(recall * len(places)), len(places)) - 1]) + 1 if places else 1
