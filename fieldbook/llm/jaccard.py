"""Join of texts on the Jaccard similarity of their word n-grams (operator 9)."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .components import components
from .rolling import mix, shingles
from .shared import columns_as, keep, ship


def bands_and_rows(threshold: float, recall: float, most: int = 128) -> tuple[int, int]:
    """Bands and rows a band that find a pair at the threshold with at least the given probability;
    of all choices within ``most`` values, the one with the most rows, so the fewest false
    candidates."""
    best = (most, 1)
    for rows in range(1, most + 1):
        bands = int(np.ceil(np.log(1 - recall) / np.log1p(-(threshold**rows))))
        if bands * rows <= most:
            best = (bands, rows)
    return best


def signatures(sets: list[np.ndarray], bands: int, rows: int) -> np.ndarray:
    """One hash per set and band of its MinHash values; sets may not be empty."""
    random = np.random.default_rng(20_240_501)
    factor = random.integers(0, 1 << 63, bands * rows, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    add = random.integers(0, 1 << 63, bands * rows, dtype=np.uint64)
    flat, at = np.concatenate(sets), np.cumsum([0, *map(len, sets)])[:-1]
    out = np.zeros((len(sets), bands), np.uint64)
    work = np.empty_like(flat)
    for k in range(bands * rows):
        np.multiply(flat, factor[k], out=work)
        work += add[k]
        work ^= work >> np.uint64(31)
        low = np.minimum.reduceat(work, at)
        band = out[:, k // rows]
        out[:, k // rows] = mix(band * np.uint64(0x9E3779B97F4A7C15) + low)
    return out


SKETCH = "doc bigint, doc_id bigint, text_key bigint, set_key binary, n_shingles bigint, bands array<bigint>"


def sketch(texts: DataFrame, n: int, bands: int, rows: int) -> DataFrame:
    """For rows ``doc_id, text_key, text``: a number of the row (``doc``), a digest of the whole
    n-gram set and the band hashes; the last two are null for texts without words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from hashlib import blake2b

        from pyspark import TaskContext

        number = TaskContext.get().partitionId() << 33
        names = [c.split()[0] for c in SKETCH.split(", ")]
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                sets = [shingles(np.frombuffer(t.encode(), np.uint8), n) for t in part.column(2).to_pylist()]
                full = [k for k, s in enumerate(sets) if len(s)]
                keys: list = [None] * len(sets)
                hashes: list = [None] * len(sets)
                if full:
                    for k, row in zip(full, signatures([sets[k] for k in full], bands, rows).view(np.int64)):
                        keys[k] = blake2b(sets[k].tobytes(), digest_size=16).digest()
                        hashes[k] = row
                sizes = pa.array([len(s) for s in sets], pa.int64())
                numbers = pa.array(np.arange(number, number + len(sets)))
                number += len(sets)
                yield pa.RecordBatch.from_arrays([numbers, part.column(0), part.column(1), pa.array(keys, pa.binary()), sizes, pa.array(hashes, pa.list_(pa.int64()))], names)

    return texts.select("doc_id", "text_key", "text").mapInArrow(run, SKETCH)


#: Texts per side of a block of comparisons.
BLOCK = 512


def compare(left: list[np.ndarray], right: list[np.ndarray], threshold: float) -> np.ndarray:
    """Which pairs of sorted sets reach the threshold, as a boolean matrix.  Intersections are
    counted by products of 0/1 matrices, some columns at a time."""
    sizes = [np.array([len(s) for s in side], np.float32) for side in (left, right)]
    both = np.intersect1d(np.concatenate(left), np.concatenate(right))
    shared = np.zeros((len(left), len(right)), np.float32)
    for at in range(0, len(both), 4096):
        part = both[at : at + 4096]
        dense = []
        for side in (left, right):
            m = np.zeros((len(side), len(part)), np.float32)
            for k, s in enumerate(side):
                s = s[np.searchsorted(s, part[0]) : np.searchsorted(s, part[-1], "right")]
                j = np.searchsorted(part, s)
                m[k, j[part[np.minimum(j, len(part) - 1)] == s]] = 1
            dense.append(m)
        shared += dense[0] @ dense[1].T
    return shared >= threshold * (sizes[0][:, None] + sizes[1][None, :] - shared) - 1e-6


def spanning(links: np.ndarray) -> list[tuple[int, int]]:
    """A spanning forest of the links of a matrix, as row and column numbers: enough to know which
    rows and columns hang together, with fewer edges than rows and columns."""
    rows, cols = links.shape
    parent = list(range(rows + cols))

    def root(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    out = []
    for i in range(rows):
        for j in np.flatnonzero(links[i]):
            a, b = root(i), root(rows + int(j))
            if a != b:
                parent[a] = b
                out.append((i, int(j)))
    return out


def verify(members: DataFrame, n: int, threshold: float) -> DataFrame:
    """``doc, links, other``: for rows ``job, side, doc, weight, text``, clustered by job,
    the verified links of a text by weight (``other`` null), and the edges of a spanning forest
    (``links`` 0).  Side 0 holds the rows of a block, side 1 its columns; a job with one side is
    compared with itself."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        def job(rows: pd.DataFrame) -> pd.DataFrame:
            rows = rows.drop_duplicates(["side", "doc"])
            sets = [shingles(np.frombuffer(t.encode(), np.uint8), n) for t in rows["text"]]
            side, doc, weight = rows["side"].to_numpy(), rows["doc"].to_numpy(), rows["weight"].to_numpy()
            a = np.flatnonzero(side == 0)
            b = np.flatnonzero(side == 1)
            alone = not len(b)
            b = a if alone else b
            links = compare([sets[k] for k in a], [sets[k] for k in b], threshold)
            if alone:
                np.fill_diagonal(links, False)
            sums = [pd.DataFrame({"doc": doc[a], "links": links @ weight[b], "other": pd.array([None] * len(a), "Int64")})]
            if not alone:
                sums.append(pd.DataFrame({"doc": doc[b], "links": links.T @ weight[a], "other": pd.array([None] * len(b), "Int64")}))
            forest = spanning(np.triu(links) if alone else links)
            if forest:
                i, j = np.array(forest).T
                sums.append(pd.DataFrame({"doc": doc[a[i]], "links": 0, "other": pd.array(doc[b[j]], "Int64")}))
            return pd.concat(sums)

        rest = None
        for frame in batches:
            frame = frame if rest is None else pd.concat([rest, frame], ignore_index=True)
            if frame.empty:
                continue
            rest = frame[frame["job"] == frame["job"].iloc[-1]]
            done = frame[frame["job"] != frame["job"].iloc[-1]]
            for _, rows in done.groupby("job", sort=False):
                yield job(rows)
        if rest is not None and len(rest):
            yield job(rest)

    return members.mapInPandas(run, "doc bigint, links bigint, other bigint")


def near_duplicates(
    docs: DataFrame, n: int = 5, threshold: float = 0.8, recall: float = 0.9999, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``row, doc_id, text_key, class_id, n_links, is_first`` for every row of ``docs``.

    Two rows are linked when the Jaccard similarity of their sets of word n-grams is at least
    ``threshold``; ``n_links`` counts the other rows that a row is linked to, ``class_id`` is the
    least id of the rows that links connect, and ``is_first`` marks the one row of each class that
    stays.  Words are runs of anything but ASCII white space, as they stand; a text of fewer than
    ``n`` words has its words as the only n-gram; texts without words, null included, are linked
    to nothing.

    Rows with equal n-gram sets are one from the start, however many.  For the others MinHash
    values are banded, with as many bands as find a pair at the threshold with probability
    ``recall`` (more similar pairs surely more often).  A band's bucket is tied to its least
    member, an aggregation, so no bucket is ever expanded into pairs.  What hangs together is a
    cluster, and the full sets of all its pairs are compared inside tasks, clusters of more than
    ``BLOCK`` texts in blocks: a task emits sums of links and a spanning forest, never pairs.  The
    work on a cluster of texts that all differ grows with its square, as their number of links
    does; it is split over tasks.

    Null and repeated ids are rows like others (a null id counts as the least); an empty table
    gives an empty result; further columns are ignored."""
    ship(docs.sparkSession)
    bands, rows = bands_and_rows(threshold, recall)
    texts = columns_as(docs, doc_id=id_col, text=text_col).select(
        F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")
    )
    texts = texts.withColumn("text_key", F.xxhash64("text"))
    sketched = keep(sketch(texts, n, bands, rows), "jaccard")
    sets = keep(sketched.where("set_key is not null").groupBy("set_key").agg(F.min("doc").alias("doc"), F.count("*").alias("weight")), "jaccard-sets")
    firsts = sketched.join(sets.select("doc", "weight"), "doc")
    banded = firsts.select("doc", F.posexplode("bands").alias("band", "hash"))
    buckets = banded.groupBy("band", "hash").agg(F.min("doc").alias("least"), F.count("*").alias("size")).where("size > 1")
    edges = banded.join(buckets, ["band", "hash"]).select(F.col("doc").alias("a"), F.col("least").alias("b"))
    clusters = keep(components(edges), "jaccard-clusters")

    sizes = clusters.groupBy("component").agg(F.count("*").alias("size"))
    parts = F.ceil(F.col("size") / BLOCK).cast("int")
    numbered = clusters.join(sizes, "component").select("component", F.col("node").alias("doc"), parts.alias("parts"), F.pmod(F.xxhash64("node"), parts).cast("int").alias("part"))
    # Every two parts p <= q of a cluster make a job; the texts of p are its rows, those of q its columns.
    p, q = F.least("part", "other"), F.greatest("part", "other")
    jobs = numbered.select("*", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("other")).select(
        F.concat_ws("/", "component", p, q).alias("job"), F.when(F.col("part") == p, 0).otherwise(1).alias("side"), "doc"
    )
    # A row number is found again by id and digest; equal rows are dropped again by ``verify``.
    wanted = firsts.join(numbered.select("doc"), "doc").select("doc", "weight", F.col("doc_id").alias("id"), F.col("text_key").alias("key"))
    found_texts = texts.join(wanted, texts["doc_id"].eqNullSafe(F.col("id")) & (F.col("text_key") == F.col("key"))).select("doc", "weight", "text")
    members = jobs.join(found_texts, "doc").select("job", "side", "doc", "weight", "text").repartition("job").sortWithinPartitions("job")
    found = keep(verify(members, n, threshold), "jaccard-links")
    links = found.where("other is null").groupBy("doc").agg(F.sum("links").alias("links"))
    classes = components(found.where("other is not null").select(F.col("doc").alias("a"), F.col("other").alias("b")))
    by_set = (
        sets.join(links, "doc", "left")
        .join(classes.select(F.col("node").alias("doc"), F.col("component")), "doc", "left")
        .select("set_key", F.coalesce("component", "doc").alias("class"), (F.coalesce("links", F.lit(0)) + F.col("weight") - 1).alias("n_links"))
    )
    every = sketched.join(by_set, "set_key", "left").select(
        F.col("doc").alias("row"), "doc_id", "text_key", F.coalesce("class", "doc").alias("class"), F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links")
    )
    # Stored, so that a class with very many rows can be split in the join.
    names = keep(every.groupBy("class").agg(F.min(F.struct("doc_id", "row")).alias("first")), "jaccard-classes")
    return every.join(names, "class").select(
        "row", "doc_id", "text_key", F.col("first.doc_id").alias("class_id"), "n_links", (F.col("row") == F.col("first.row")).alias("is_first")
    )


def one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The rows of ``docs`` with all their columns, one of each class of ``near_duplicates``."""
    first = near_duplicates(docs, id_col=id_col, text_col=text_col, **options).where("is_first").select(F.col("doc_id").alias("_id"), F.col("text_key").alias("_key"))
    keyed = docs.withColumns({"_id_": docs[id_col].cast("bigint"), "_key_": F.xxhash64(F.coalesce(docs[text_col].cast("string"), F.lit("")))})
    found = keyed.join(first, F.col("_id_").eqNullSafe(F.col("_id")) & (F.col("_key_") == F.col("_key")), "left_semi")
    return found.dropDuplicates(["_id_", "_key_"]).drop("_id_", "_key_")
