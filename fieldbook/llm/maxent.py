"""Scoring of texts by a hashed maximum-entropy language model (operator 1).

The next token is predicted in three softmax steps, the class, the leaf within the class and the
word within the leaf, from hashed features: the word before, the word before that (a skip), and
both.  One of a leaf's words stands for all that are not in the head of the vocabulary; these have
add-one shares of its count.  The number of classes and leaves follows the number of words, the
number of weights that of pairs.  Weights are trained by rounds of gradient updates in parallel
shards, whose results are averaged."""

from __future__ import annotations

from bisect import bisect_right
from collections import Counter
from collections.abc import Iterator
from functools import cached_property
from itertools import repeat
from math import ceil, log2
from zlib import crc32

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .bpe import parts
from .shared import columns_as, keep, ship

#: Classes, leaves of a class and words of a leaf: so many at least, more for more words.
WAYS = 32

#: Softmax steps: class, leaf, word.
LEVELS = 3

#: Feature templates; rows of a weight table for each and each step: so many at least, more for
#: more distinct pairs of words.
FEATURES, ROW_BITS = 3, 15
ROWS = 1 << ROW_BITS

#: Words that are known to every task, and weights, at most: a task has both in memory.  Counts of
#: all other words are looked up by a join.
HEAD, WEIGHTS = 1 << 18, 40_000_000

#: One in so many distinct pairs is counted.
PAIRS = 256

#: Tokens of a gradient update.
BATCH = 1 << 13

#: Bytes of the texts that are split into words at once; a longer text is split alone.
PART = 1 << 20

#: Training tokens of a shard, at least: its weights are as many, however small its partitions are.
SHARD = 1 << 22

#: Rows of the weight tables that are averaged as one value.
SHEET = 256

#: Rows of a segment that are added one place after the other over all segments.
SHORT = 8


def split_words(texts: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """Words of some texts, with A-Z in lower case: the distinct ones, the place of each word
    there, and how many each text has.  Arrow's functions for ASCII know just its letters and
    white space."""
    lists = pc.ascii_split_whitespace(pc.ascii_lower(texts))
    coded = lists.flatten().dictionary_encode()
    words, which = coded.dictionary.cast(pa.binary()), coded.indices.to_numpy()
    real = (pc.binary_length(words).to_numpy() > 0)[which]  # white space at an end of a text makes empty ones
    n = np.diff(np.concatenate(([0], np.cumsum(real)))[lists.offsets.to_numpy()])
    return words, which[real].astype(np.int64), n


def ways_for(words: int) -> int:
    """Ways of a step, so that every leaf has room for its share of the words and one more."""
    ways = WAYS
    while ways * ways * (ways - 1) < words:
        ways += 1
    return ways


def head_of(counts: DataFrame) -> pa.Table:
    """All words (``word, n``) with at least the smallest count that not more than ``HEAD`` words have, the most
    frequent first.  The driver sees these, and a row for each different count."""
    room, least = HEAD, None
    for r in sorted(counts.groupBy("n").agg(F.count("*").alias("words")).collect(), reverse=True):
        room -= r["words"]
        if room < 0:
            break
        least = r["n"]
    if least is None:
        return as_head([])
    return counts.where(F.col("n") >= least).select("word", "n").toArrow().sort_by([("n", "descending"), ("word", "ascending")])


def as_head(pairs: list[tuple[str, int]]) -> pa.Table:
    return pa.table({"word": pa.array([w for w, _ in pairs], pa.string()), "n": pa.array([n for _, n in pairs], pa.int64())})


def row_bits_for(pairs: int, ways: int) -> int:
    """Rows of a weight table, as a power of two: one for each distinct pair, as far as ``WEIGHTS``
    allows."""
    most = int(log2(WEIGHTS / (LEVELS * FEATURES * ways)))
    return max(min(ceil(log2(max(pairs, 1))), most), ROW_BITS)


class Words:
    """The head of the vocabulary, and the leaf of any word.  Leaves are ranges of the words in
    the order of their reversed bytes, so words with like endings share one; they have about the
    same number of words.  ``slot``: place of the word in its leaf, from 1; 0 is for all words that
    are not in the head.  Token 0 is the end of a text, written as the empty word."""

    def __init__(self, head: pa.Table | list[tuple[str, int]], ends: int, ways: int | None = None):
        if not isinstance(head, pa.Table):
            head = as_head(head)
        # No Python objects for the words: the driver has no use for them, a task makes its own.
        self.names = pa.concat_arrays([pa.array([b""], pa.binary()), *(c.cast(pa.binary()) for c in head.column("word").chunks)])
        self.counts = np.concatenate(([ends], head.column("n").to_numpy())).astype(np.int64)
        n = len(self.names)
        self.ways = ways or ways_for(n)
        ending = pc.binary_reverse(self.names)
        order = pc.sort_indices(ending).to_numpy()
        leaf = np.arange(n) * self.ways**2 // n
        new = np.flatnonzero(np.diff(leaf)) + 1
        self.leaf, self.slot = np.zeros(n, np.int64), np.zeros(n, np.int64)
        self.leaf[order] = leaf
        self.slot[order] = np.arange(n) - np.searchsorted(leaf, leaf) + 1
        self.bounds = ending.take(pa.array(order[new])).to_pylist()
        self.bound_leaves = [int(leaf[0]), *leaf[new].tolist()]

    @cached_property
    def ids(self) -> dict[bytes, int]:
        return {w: k for k, w in enumerate(self.names.to_numpy(zero_copy_only=False).tolist())}

    def __getstate__(self) -> dict:
        return {k: v for k, v in self.__dict__.items() if k != "ids"}

    def leaf_of(self, word: bytes) -> int:
        return self.bound_leaves[bisect_right(self.bounds, word[::-1])]


def is_held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string")) % 7 == 2, F.lit(False))


def counted(texts: DataFrame) -> DataFrame:
    """``word, n`` over all rows of ``text``, and without ``word`` the hashes of one in ``PAIRS``
    distinct pairs of neighbours (``pair``); counted in tasks before the shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter = Counter()
        pairs: set = set()

        def out() -> pa.RecordBatch:
            words = [pa.array(list(seen), pa.binary()).cast(pa.string()), pa.nulls(len(pairs), pa.string())]
            hashes = [pa.nulls(len(seen), pa.int64()), pa.array(list(pairs), pa.int64())]
            n = pa.array([*seen.values(), *[1] * len(pairs)], pa.int64())
            seen.clear()
            pairs.clear()
            return pa.RecordBatch.from_arrays([pa.concat_arrays(words), pa.concat_arrays(hashes), n], ["word", "pair", "n"])

        for batch in batches:
            for part in parts(batch, 0, PART):
                words, which, n = split_words(part.column(0))
                names = words.to_numpy(zero_copy_only=False).tolist()
                seen.update({w: k for w, k in zip(names, np.bincount(which, minlength=len(names)).tolist()) if k})
                own = np.fromiter(map(crc32, names), np.uint64, len(names))[which]
                both = (own[:-1] * np.uint64(0x9E3779B97F4A7C15)) ^ (own[1:] * np.uint64(0xC2B2AE3D27D4EB4F))
                both = (both ^ (both >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
                chosen = (both >> np.uint64(40)) % np.uint64(PAIRS) == 0
                ends = np.cumsum(n)
                chosen[ends[(ends > 0) & (ends < len(own))] - 1] = False  # of two texts
                pairs.update(both[chosen].view(np.int64).tolist())
                if len(seen) + len(pairs) > 500_000:
                    yield out()
        yield out()

    return texts.select("text").mapInArrow(run, "word string, pair bigint, n bigint").groupBy("word", "pair").agg(F.sum("n").alias("n"))


class Tokens:
    """Texts as numbers: head words by their number, others by their leaf beyond the head."""

    def __init__(self, words: Words):
        self.words, self.others = words, {}
        leaves = words.ways**2
        self.leaf = np.concatenate((words.leaf, np.arange(leaves)))
        self.slot = np.concatenate((words.slot, np.zeros(leaves, np.int64)))
        self.head = len(words.leaf)

    def of(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, tuple[np.ndarray, np.ndarray, pa.Array]]:
        """The numbers, with an end after each text; the numbers as context, where words that are
        not in the head stand for themselves; how many each text has; and of the words that are not in the
        head the text and the place among the distinct words, with these."""
        words, which, n = split_words(texts)
        names = words.to_numpy(zero_copy_only=False).tolist()
        ids = np.fromiter(map(self.words.ids.get, names, repeat(-1)), np.int64, len(names))
        context, rare = ids.copy(), ids < 0
        for k in np.flatnonzero(rare).tolist():
            w = names[k]
            known = self.others.get(w)
            if known is None:
                if len(self.others) > 200_000:
                    self.others.clear()
                known = self.others[w] = self.head + self.words.leaf_of(w), (1 << 32) + crc32(w)
            ids[k], context[k] = known
        ends, other = np.cumsum(n), np.flatnonzero(rare[which])
        text = np.searchsorted(ends, other, "right")
        return np.insert(ids[which], ends, 0), np.insert(context[which], ends, 0), n + 1, (text, which[other], words)


def feature_rows(ids: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Per feature and token a 64-bit hash of the tokens before.  ``first``: where texts begin; there is an end before
    each, twice."""
    one = np.concatenate(([0], ids[:-1]))
    one[first] = 0
    two = np.concatenate(([0], one[:-1]))
    two[first] = 0
    a, b = (one + 1).astype(np.uint64), (two + 1).astype(np.uint64)
    h = np.stack([a * np.uint64(0x9E3779B97F4A7C15), b * np.uint64(0xC2B2AE3D27D4EB4F), (a * np.uint64(0xD6E8FEB86659FD93)) ^ (b * np.uint64(0x9FB21C651E98DF25))])
    h ^= h >> np.uint64(31)
    return h * np.uint64(0xBF58476D1CE4E5B9)


def rows_at(h: np.ndarray, known: np.ndarray | None, bits: int) -> np.ndarray:
    """Rows of the weight tables; after the first step they also depend on what is ``known``."""
    if known is not None:
        h = (h ^ ((known + 1).astype(np.uint64) * np.uint64(0x94D049BB133111EB))) * np.uint64(0x9E3779B97F4A7C15)
    return (h >> np.uint64(64 - bits)).astype(np.uint16 if bits <= 16 else np.uint32)


def segment_sums(values: np.ndarray, order: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Sums of the rows ``order[starts[k] : starts[k + 1]]`` for every k, as ``np.add.reduceat``
    gives them to the last bit.  Most segments are short; numpy's way is slow there."""
    n = np.diff(np.append(starts, len(order)))
    total = np.take(values, order[starts], axis=0)
    short = np.flatnonzero((n > 1) & (n <= SHORT))
    if len(short):
        short = short[np.argsort(-n[short], kind="stable")]
        size, at = n[short], starts[short]
        rest = np.take(values, order[at + 1], axis=0)
        for place in range(2, int(size[0])):
            k = np.count_nonzero(size > place)
            rest[:k] += np.take(values, order[at[:k] + place], axis=0)
        total[short] += rest
    long = np.flatnonzero(n > SHORT)
    if len(long):
        size = n[long]
        at = np.cumsum(size) - size
        rows = order[np.repeat(starts[long] - at, size) + np.arange(size.sum())]
        total[long] = np.add.reduceat(np.take(values, rows, axis=0), at, axis=0)
    return total


def packed(sheet: np.ndarray) -> bytes:
    """Rows of a weight table in half precision, compressed."""
    return pa.compress(sheet.astype(np.float16).tobytes(), codec="zstd", asbytes=True)


def unpacked(sheet: bytes, ways: int) -> np.ndarray:
    return np.frombuffer(pa.decompress(sheet, SHEET * ways * 2, codec="zstd", asbytes=True), np.float16).astype(np.float32).reshape(SHEET, ways)


def tables_of(sheets: dict[int, bytes], bits: int, ways: int) -> np.ndarray:
    """All weights; sheets that no shard has used are 0."""
    w = np.zeros((LEVELS, FEATURES, 1 << bits, ways), np.float32)
    flat = w.reshape(-1, SHEET, ways)
    for k, sheet in sheets.items():
        flat[k] = unpacked(sheet, ways)
    return w


class Model:
    """Weights ``w`` (steps, features, rows, ways) and the log shares of classes, of leaves and,
    from ``mass`` (leaves, ways) of the third step, of words."""

    def __init__(self, w: np.ndarray, mass: np.ndarray):
        self.w, ways = w, w.shape[3]
        self.bits, self.ways = w.shape[2].bit_length() - 1, ways
        if mass.ndim > 1:
            slots, mass = mass, mass.sum(axis=1)
            with np.errstate(divide="ignore"):
                # No word there: no probability.
                self.slots = np.maximum(np.log(slots) - np.log(np.maximum(mass, 1))[:, None], -1e4).astype(np.float32)
        share = np.maximum(mass.reshape(ways, ways), 1e-9)
        self.classes = np.log(share.sum(axis=1)).astype(np.float32)
        self.leaves = np.log(share / share.sum(axis=1, keepdims=True)).astype(np.float32)

    def steps(self, h: np.ndarray, leaf: np.ndarray, slot: np.ndarray | None = None) -> Iterator[tuple[int, list[np.ndarray], np.ndarray, np.ndarray]]:
        """The softmax steps: the level, rows of the tables, logits and the right answers.  The
        third is taken where ``slot`` is given."""
        cls = leaf // self.ways
        levels = [(None, self.classes, cls), (cls, self.leaves, leaf % self.ways)]
        if slot is not None:
            levels.append((leaf, self.slots, slot))
        for level, (known, shares, right) in enumerate(levels):
            rows = [rows_at(h[f], known, self.bits) for f in range(FEATURES)]
            z = np.take(self.w[level, 0], rows[0], axis=0)
            for f in range(1, FEATURES):
                z += np.take(self.w[level, f], rows[f], axis=0)
            z += shares if known is None else np.take(shares, known, axis=0)
            z -= z.max(axis=1, keepdims=True)
            yield level, rows, z, right

    def log_leaf(self, h: np.ndarray, leaf: np.ndarray, slot: np.ndarray | None = None) -> np.ndarray:
        """Log probability of the leaf, and of the place in it if that is given."""
        out = np.zeros(len(leaf))
        for at in range(0, len(leaf), BATCH):
            part = slice(at, at + BATCH)
            for _, _, z, right in self.steps(h[:, part], leaf[part], None if slot is None else slot[part]):
                out[part] += z[np.arange(len(right)), right]
                out[part] -= np.log(np.exp(z, out=z).sum(axis=1))
        return out

    def update(self, h: np.ndarray, leaf: np.ndarray, slot: np.ndarray, square: np.ndarray, used: np.ndarray, rate: float) -> None:
        """One gradient update; the step of a row shrinks with the gradients it has seen."""
        whole = np.dtype((np.void, self.w.itemsize * self.ways))  # rows are written as one value
        for level, rows, z, right in self.steps(h, leaf, slot):
            slope = np.exp(z, out=z)
            slope /= slope.sum(axis=1, keepdims=True)
            slope.reshape(-1)[np.arange(0, slope.size, self.ways) + right] -= 1
            for f in range(FEATURES):
                order = np.argsort(rows[f], kind="stable")
                sorted_rows = rows[f][order]
                starts = np.flatnonzero(np.concatenate(([True], sorted_rows[1:] != sorted_rows[:-1])))
                row = sorted_rows[starts]
                total = segment_sums(slope, order, starts)
                seen = square[level, f]
                seen[row] += np.einsum("ij,ij->i", total, total)
                used[level, f][row] += np.diff(np.append(starts, len(order)))
                total *= (rate / np.sqrt(seen[row] + 1))[:, None]
                new = np.take(self.w[level, f], row, axis=0)
                new -= total
                self.w[level, f].view(whole)[:, 0][row] = new.view(whole)[:, 0]


def shards_for(partitions: int, partitions_per_shard: int, tokens: int) -> int:
    """Shards of the training texts: a few partitions each, and not less than ``SHARD`` tokens."""
    return max(min(ceil(partitions / partitions_per_shard), tokens // SHARD), 1)


def train(texts: DataFrame, shared: Broadcast, ways: int, bits: int, rounds: int, rate: float, shards: int) -> Broadcast:
    """Weights, as packed sheets of the tables with ``2 ** bits`` rows, after one pass over the texts, in ``rounds`` parts.  In each, every shard goes on
    from the common weights over its texts of that part; then the rows of the tables are averaged,
    each weighted by how many tokens of the shard used it.  The number of shards follows the texts, so
    what is averaged grows with the input.  The driver has the packed sheets once, and a part of
    the averages on its way to them; tasks and driver have the weights of one round at a time."""
    spark = texts.sparkSession
    tables = (LEVELS, FEATURES, 1 << bits)
    sheets: dict[int, bytes] = {}
    common = spark.sparkContext.broadcast(sheets)
    for r in range(rounds):

        def shard(batches: Iterator[pa.RecordBatch], common: Broadcast = common) -> Iterator[pa.RecordBatch]:
            words, mass = shared.value
            tokens, model = Tokens(words), Model(tables_of(common.value, bits, ways), mass)
            square, used = np.zeros(tables, np.float32), np.zeros(tables, np.float32)
            waiting, n = [], 0

            def learn() -> None:
                ids, context = (np.concatenate(x) for x in zip(*waiting))
                first = np.cumsum([0, *(len(x) for x, _ in waiting[:-1])])
                h, leaf, slot = feature_rows(context, first), tokens.leaf[ids], tokens.slot[ids]
                for at in range(0, len(ids), BATCH):
                    part = slice(at, at + BATCH)
                    model.update(h[:, part], leaf[part], slot[part], square, used, rate)
                waiting.clear()

            for batch in batches:
                for part in parts(batch, 0, PART):
                    ids, context, size, _ = tokens.of(part.column(0))
                    ends = np.cumsum(size)
                    for a, b in zip((ends - size).tolist(), ends.tolist()):
                        waiting.append((ids[a:b], context[a:b]))
                        n += b - a
                        if n >= 8 * BATCH:
                            learn()
                            n = 0
            if waiting:
                learn()
            flat, counts = model.w.reshape(-1, SHEET, ways), used.reshape(-1, SHEET)
            for at in range(0, len(flat), 64):
                k = [j for j in range(at, at + 64) if counts[j].any()]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(k, pa.int32()), pa.array([packed(flat[j]) for j in k], pa.binary()), pa.array([counts[j].tobytes() for j in k], pa.binary())],
                    ["sheet", "w", "used"],
                )

        def average(sheet: pd.DataFrame) -> pd.DataFrame:
            total, n = np.zeros((SHEET, ways), np.float32), np.zeros(SHEET, np.float32)
            for weights, used in zip(sheet["w"], sheet["used"]):
                u = np.frombuffer(used, np.float32)
                total += unpacked(weights, ways) * u[:, None]
                n += u
            total /= np.maximum(n, 1)[:, None]
            total[n == 0] = unpacked(sheet["w"].iloc[0], ways)[n == 0]  # as it was before
            return pd.DataFrame({"sheet": sheet["sheet"].iloc[:1], "w": [packed(total)]})

        part = texts.where(F.pmod(F.xxhash64("text"), F.lit(rounds)) == r).select("text").coalesce(shards)
        averages = part.mapInArrow(shard, "sheet int, w binary, used binary").groupBy("sheet").applyInPandas(average, "sheet int, w binary")
        # As many rows as the tables have sheets, whatever the input; they come partition by partition.
        for row in keep(averages, "maxent-weights", shuffles=False).toLocalIterator():
            sheets[row["sheet"]] = bytes(row["w"])
        common.destroy(blocking=True)
        common = spark.sparkContext.broadcast(sheets)
    return common


def score_texts(
    docs: DataFrame, rounds: int = 2, rate: float = 0.5, partitions_per_shard: int = 3, id_col: str = "doc_id", text_col: str = "text", held_out=is_held_out
) -> DataFrame:
    """``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score`` for every row.

    Learns from the rows that are not held out and scores all, whole: ``score`` is the model's
    log10 probability of the text with its end, ``base_score`` that of an add-one unigram model.
    All counts are exact and over all training texts.  All words, or the most frequent
    ones up to ``HEAD``, are sent to all tasks; the counts of other words reach the texts by a join, a row for
    each text and word, so no word is frequent there.  Head words are predicted one by one; the
    others of a leaf as one, of which each has its share, and each leaf keeps one share for unknown
    words, so that probabilities add up to 1.  As context every word counts for itself.

    Null texts count as empty and have just their end; a null id is not held out; null and
    repeated ids are kept row by row.  Without any training text every count is 0 and a token has
    base probability 1.  An empty table gives an empty result; further columns are ignored."""
    spark = ship(docs.sparkSession)
    base = columns_as(docs, doc_id=id_col, text=text_col)
    base = base.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    base = base.withColumn("held_out", held_out(F.col("doc_id")))
    training = base.where(~F.col("held_out"))

    table = keep(counted(training), "maxent-counts", shuffles=False)
    counts = table.where(F.col("word").isNotNull()).select("word", "n")
    ends = training.count()
    total, distinct = counts.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()
    total, distinct = total + ends, distinct + (ends > 0)
    words = Words(head_of(counts), ends)
    bits = row_bits_for(table.where(F.col("word").isNull()).count() * PAIRS, words.ways)
    first = spark.sparkContext.broadcast(words)

    def leaves(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            tail = [(first.value.leaf_of(w), n) for w, n in ((w.encode(), n) for w, n in zip(*(c.to_pylist() for c in batch.columns))) if w not in first.value.ids]
            yield pa.RecordBatch.from_arrays([pa.array([x for x, _ in tail], pa.int32()), pa.array([n for _, n in tail], pa.int64())], ["leaf", "n"])

    mass = np.zeros((words.ways**2, words.ways))
    mass[words.leaf, words.slot] = words.counts + 1
    for r in counts.mapInArrow(leaves, "leaf int, n bigint").groupBy("leaf").agg((F.sum("n") + F.count("*")).alias("n")).collect():
        mass[r["leaf"], 0] += r["n"]
    mass[sorted(set(words.bound_leaves)), 0] += 1  # the unknown word of the leaf
    ways = words.ways
    shared = spark.sparkContext.broadcast((words, mass))
    first.destroy(blocking=True)
    weights = train(training, shared, ways, bits, rounds, rate, shards_for(training.rdd.getNumPartitions(), partitions_per_shard, total))

    everyone = np.log10(total + distinct + 1)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, mass = shared.value
        tokens, model = Tokens(words), Model(tables_of(weights.value, bits, ways), mass)
        log_count, log_tail = np.log10(words.counts + 1.0), np.log10(np.maximum(mass[:, 0], 1))
        for batch in batches:
            for part in parts(batch, 2, PART):
                ids, context, n, (text, which, names) = tokens.of(part.column(2))
                starts = np.cumsum(n) - n
                leaf, head = tokens.leaf[ids], ids < tokens.head
                log_leaf = model.log_leaf(feature_rows(context, starts), leaf, tokens.slot[ids]) / np.log(10)
                known = np.where(head, log_count[np.where(head, ids, 0)], 0.0)
                sums = [np.add.reduceat(x, starts) for x in (known - everyone, log_leaf - np.where(head, 0.0, log_tail[leaf]), (head & (words.counts[np.where(head, ids, 0)] > 0)).astype(np.int64))]
                # A row for each text and other word of it.
                pairs, times = np.unique(text * len(names) + which, return_counts=True)
                text, which = np.divmod(pairs, max(len(names), 1))
                row, own, rare = part.column(0), len(n), len(pairs)
                none = pa.array([f" {r}" for r in row.to_pylist()], pa.string())  # no word has a space: meets nothing
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.concat_arrays([row, row.take(pa.array(text))]),
                        pa.concat_arrays([part.column(1), pa.nulls(rare, pa.int64())]),
                        pa.concat_arrays([part.column(3), pa.nulls(rare, pa.bool_())]),
                        pa.concat_arrays([none, names.take(pa.array(which)).cast(pa.string())]),
                        pa.array(np.concatenate((np.zeros(own, np.int64), times))),
                        pa.concat_arrays([pa.array(n.astype(np.int64)), pa.nulls(rare, pa.int64())]),
                        pa.concat_arrays([pa.array(sums[2]), pa.nulls(rare, pa.int64())]),
                        pa.concat_arrays([pa.array(sums[0]), pa.nulls(rare, pa.float64())]),
                        pa.concat_arrays([pa.array(sums[1]), pa.nulls(rare, pa.float64())]),
                    ],
                    ["row", "doc_id", "held_out", "word", "times", "n_tokens", "n_known", "base", "score"],
                )

    schema = "row bigint, doc_id bigint, held_out boolean, word string, times bigint, n_tokens bigint, n_known bigint, base double, score double"
    scored = base.select(F.monotonically_increasing_id().alias("row"), "doc_id", "text", "held_out").mapInArrow(score, schema)
    tail = scored.join(counts, "word", "left")
    gained = F.coalesce(F.sum(F.col("times") * F.log10(F.coalesce("n", F.lit(0)) + 1)), F.lit(0.0))
    out = tail.groupBy("row").agg(
        F.max("doc_id").alias("doc_id"),
        F.max("held_out").alias("held_out"),
        F.sum("n_tokens").alias("n_tokens"),
        F.sum(F.coalesce("n_known", F.lit(0)) + F.when(F.col("n").isNotNull(), F.col("times")).otherwise(0)).alias("n_known"),
        (F.sum("base") + gained).alias("base_score"),
        (F.sum("score") + gained).alias("score"),
    )
    return out.select("doc_id", "held_out", "n_tokens", "n_known", F.lit(total).cast("bigint").alias("train_tokens"), "base_score", "score")
