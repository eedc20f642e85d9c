"""Removal of byte strings that occur more than once, by external induced sorting of sampled
suffixes (operator 8).

A suffix array of all bytes takes several times the size of the texts on disk.  Here the suffixes
are sampled first, as induced sorting does with the leftmost of its descents, but by a rule that
leaves far fewer of them: every window of ``length`` bytes has an anchor, the leftmost of its
substrings of ``SEED`` bytes with the least hash.  Equal windows have their anchors at the same
place, so it is enough to sort the suffixes at anchors and to induce the order of the suffixes in
front of them.  The anchors go through Spark's external sort, which keeps its queues on disk."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .rolling import Prefixes, mix
from .shared import doc_text, keep

#: Bytes of the substring that makes an anchor.
SEED = 32

#: Suffixes that are sorted and induced together at most; a larger group of equal seeds goes
#: window by window.
GROUP = 30_000

TEXT = "doc_id bigint, text_key bigint"


def windows_minimum(values: np.ndarray, width: int) -> np.ndarray:
    """The minimum of every ``width`` consecutive values, by minima from both ends of blocks."""
    n = len(values) - width + 1
    blocks = -(-len(values) // width)
    padded = np.full(blocks * width, np.iinfo(values.dtype).max, values.dtype)
    padded[: len(values)] = values
    forward = np.minimum.accumulate(padded.reshape(blocks, width), axis=1).ravel()
    backward = np.minimum.accumulate(padded.reshape(blocks, width)[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(backward[:n], forward[width - 1 : width - 1 + n])


def anchors(raw: np.ndarray, length: int) -> tuple[np.ndarray, ...]:
    """Runs of windows with the same anchor: first and last window start, anchor, seed hash and
    hash of all bytes that the run's windows cover."""
    prefixes = Prefixes(raw)
    at = np.arange(len(raw) - SEED + 1)
    seeds = prefixes.of(at, at + SEED)
    bits = np.uint64(max(int(len(seeds)).bit_length(), 1))
    # The place stands in the low bits, so that of equal values the leftmost is the least.
    places = (seeds >> bits << bits) | at.astype(np.uint64)
    best = windows_minimum(places, length - SEED + 1) & ((np.uint64(1) << bits) - np.uint64(1))
    change = np.flatnonzero(np.diff(best)) + 1
    first, last = np.concatenate(([0], change)), np.concatenate((change, [len(best)])) - 1
    anchor = best[first].astype(np.int64)
    return first, last, anchor, seeds[anchor], mix(prefixes.of(first, last + length) ^ np.uint64(0x5851F42D4C957F2D))


def merged(start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The union of intervals as disjoint ones that do not touch, in order."""
    if not len(start):
        return start, end
    order = np.argsort(start, kind="stable")
    start, reach = start[order], np.maximum.accumulate(end[order])
    new = np.concatenate(([True], start[1:] > reach[:-1]))
    return start[new], reach[np.concatenate((new[1:], [True]))]


def place(first, more, before):
    """Where a run lies, in one number: its first window, how many windows follow, and how many
    bytes the first window has before the anchor."""
    return first << 20 | more << 10 | before


SAMPLED = "doc_id bigint, text_key bigint, seed bigint, run bigint, place bigint, n bigint"


def sampled(texts: DataFrame, length: int) -> DataFrame:
    """The distinct runs of every text, how often each occurs in it (``n``), and its first place.
    Rows without a seed are stretches that a text repeats within itself: ``place`` is the first of
    ``n`` bytes.  Texts that are shorter than ``length`` have no row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [c.split()[0] for c in SAMPLED.split(", ")]
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                rows, runs, stretches = [], [], []
                for k, text in enumerate(part.column(2).to_pylist()):
                    raw = np.frombuffer(text.encode(), np.uint8)
                    if len(raw) < length:
                        continue
                    first, last, anchor, seed, whole = anchors(raw, length)
                    pairs = np.stack([seed, whole], axis=1).view([("s", np.uint64), ("w", np.uint64)]).ravel()
                    _, one, group, n = np.unique(pairs, return_index=True, return_inverse=True, return_counts=True)
                    runs.append((seed[one].view(np.int64), whole[one].view(np.int64), place(first, last - first, anchor - first)[one], n))
                    a, b = merged(first[n[group] > 1], last[n[group] > 1] + length)
                    stretches.append((a, b - a))
                    rows.append((np.full(len(one), k), np.full(len(a), k)))
                if not rows:
                    continue
                own, extra = (np.concatenate(x) for x in zip(*rows))
                seed, whole, where, n = (np.concatenate(x) for x in zip(*runs))
                a, size = (np.concatenate(x) for x in zip(*stretches))
                pick = pa.array(np.concatenate((own, extra)))
                none = pa.nulls(len(a), pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0).take(pick),
                        part.column(1).take(pick),
                        pa.concat_arrays([pa.array(seed), none]),
                        pa.concat_arrays([pa.array(whole), none]),
                        pa.array(np.concatenate((where, a))),
                        pa.array(np.concatenate((n, size))),
                    ],
                    names,
                )

    return texts.select("doc_id", "text_key", "text").mapInArrow(run, SAMPLED)


CONTEXTS = "doc_id bigint, text_key bigint, seed bigint, n bigint, first bigint, more int, before int, context binary, suffix binary"


def with_contexts(texts: DataFrame, length: int) -> DataFrame:
    """The bytes that a run's windows cover, and those from its anchor on, for rows ``doc_id,
    text_key, text, runs`` with arrays of ``(seed, n, place)``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        types = [pa.int64()] * 5 + [pa.int32()] * 2 + [pa.binary()] * 2
        names = [c.split()[0] for c in CONTEXTS.split(", ")]
        for batch in batches:
            rows = []
            for doc, key, text, runs in zip(*(c.to_pylist() for c in batch.columns)):
                raw = text.encode()
                for r in runs:
                    first, more, before = r["place"] >> 20, r["place"] >> 10 & 1023, r["place"] & 1023
                    context = raw[first : first + more + length]
                    rows.append((doc, key, r["seed"], r["n"], first, more, before, context, context[before:]))
            for at in range(0, len(rows), 10_000):
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows[at : at + 10_000]), types)], names)

    return texts.mapInArrow(run, CONTEXTS)


def induce(seed: np.ndarray, contexts: list[bytes], before: np.ndarray, more: np.ndarray, length: int) -> np.ndarray:
    """Which windows occur in another row, too: a boolean matrix by row and number of bytes before
    the anchor.  Rows come sorted by seed and by the suffix at the anchor.

    From the order of the suffixes that start ``d`` bytes before the anchors, the order of those
    that start one byte earlier is induced: a stable sort by the byte in front.  The common prefix
    of neighbours is carried along and only computed anew for rows that become neighbours."""
    m, width = len(contexts), length - SEED + 1
    right = np.zeros((m, length), np.uint8)
    left = np.zeros((m, width), np.uint8)
    size = np.zeros(m, np.int64)
    for k, (c, b) in enumerate(zip(contexts, before)):
        raw = np.frombuffer(c, np.uint8)
        size[k] = min(len(raw) - b, length)
        right[k, : size[k]] = raw[b : b + length]
        left[k, :b] = raw[:b][::-1]

    def common(i: np.ndarray, j: np.ndarray) -> np.ndarray:
        out = np.empty(len(i), np.int64)
        for at in range(0, len(i), 20_000):
            a, b = i[at : at + 20_000], j[at : at + 20_000]
            differ = right[a] != right[b]
            out[at : at + 20_000] = np.minimum(np.where(differ.any(axis=1), differ.argmax(axis=1), length), np.minimum(size[a], size[b]))
        return out

    found = np.zeros((m, width), bool)
    rows, group = np.arange(m), np.unique(seed, return_inverse=True)[1].astype(np.int64)
    prefix = np.zeros(m, np.int64)  # with the row before it in the same group
    same = np.flatnonzero(group[1:] == group[:-1]) + 1
    prefix[same] = common(rows[same - 1], rows[same])
    for d in range(width):
        enough = prefix >= length - d
        enough[:-1] |= enough[1:]
        valid = d >= before[rows] - more[rows]
        found[rows[enough & valid], d] = True
        stays = before[rows] > d
        key = np.where(stays, group * 256 + left[rows, min(d, width - 1)], -1)
        order = np.argsort(key, kind="stable")
        order = order[np.searchsorted(key[order], 0) :]
        key = key[order]
        twin = np.zeros(len(order), bool)
        twin[1:] = key[1:] == key[:-1]
        twin[:-1] |= twin[1:]
        order, key = order[twin], key[twin]
        if not len(order):
            break
        new_prefix = np.zeros(len(order), np.int64)
        same = np.flatnonzero(key[1:] == key[:-1]) + 1
        old = order[same] == order[same - 1] + 1
        new_prefix[same[old]] = prefix[order[same[old]]]
        fresh = same[~old]
        new_prefix[fresh] = common(rows[order[fresh - 1]], rows[order[fresh]])
        rows, prefix = rows[order], new_prefix
        group = np.cumsum(np.concatenate(([0], key[1:] != key[:-1])))
    return found


SPANS = "doc_id bigint, text_key bigint, start bigint, size bigint"


def induced(contexts: DataFrame, length: int) -> DataFrame:
    """Repeated stretches of the runs in ``contexts``, whose seeds lie together and in order."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        def stretches(f: pd.DataFrame) -> pd.DataFrame:
            before, more = f["before"].to_numpy().astype(np.int64), f["more"].to_numpy().astype(np.int64)
            found = induce(f["seed"].to_numpy(), f["context"].tolist(), before, more, length)
            edge = np.diff(np.pad(found, ((0, 0), (1, 1))).astype(np.int8), axis=1)
            (row, low), high = np.nonzero(edge == 1), np.nonzero(edge == -1)[1] - 1
            start = f["first"].to_numpy()[row] + before[row] - high
            out = f[["doc_id", "text_key"]].iloc[row].assign(start=start, size=high - low + length)
            return out[f["n"].to_numpy()[row] == 1]  # others are repeated as a whole

        rest = None
        for frame in batches:
            frame = frame if rest is None else pd.concat([rest, frame], ignore_index=True)
            if len(frame) < GROUP:
                rest = frame
                continue
            open_ = frame["seed"] == frame["seed"].iloc[-1]
            rest = frame[open_]
            if not open_.all():
                yield stretches(frame[~open_])
        if rest is not None and len(rest):
            yield stretches(rest)

    return contexts.mapInPandas(run, SPANS)


def single_windows(contexts: DataFrame, length: int) -> DataFrame:
    """``doc_id, text_key, n, start, window``: every window of the runs on its own, as a digest."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from hashlib import blake2b

        names = ["doc_id", "text_key", "n", "start", "window"]
        for batch in batches:
            more = batch.column("more").to_numpy().astype(np.int64)
            pick = np.repeat(np.arange(len(more)), more + 1)
            nth = np.arange(len(pick)) - np.repeat(np.cumsum(more + 1) - more - 1, more + 1)
            digests = [blake2b(c[k : k + length], digest_size=16).digest() for c, m in zip(batch.column("context").to_pylist(), more) for k in range(m + 1)]
            take = pa.array(pick)
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c).take(take) for c in names[:3]), pa.array(batch.column("first").to_numpy()[pick] + nth), pa.array(digests, pa.binary())], names
            )

    return contexts.mapInArrow(run, "doc_id bigint, text_key bigint, n bigint, start bigint, window binary")


def repeated_spans(texts: DataFrame, length: int) -> DataFrame:
    """``doc_id, text_key, start, size``: stretches made of windows that occur more than once;
    they may overlap, and together they are all such windows."""
    runs = keep(sampled(texts, length), "suffix-runs")
    alike = runs.where("seed is not null").groupBy("seed").agg(F.sum("n").alias("total"), F.min("run").alias("low"), F.max("run").alias("high")).where("total > 1")
    # Stored, like ``whole``, so that a seed with very many rows can be split in the join.
    alike = keep(alike.select("seed", (F.col("low") != F.col("high")).alias("mixed")), "suffix-seeds")
    some = keep(runs.join(alike, "seed"), "suffix-candidates")

    # Runs that occur as a whole more than once are settled; one of each stands for all.
    whole = some.groupBy("seed", "run").agg(F.sum("n").alias("n"), F.min(F.struct("doc_id", "text_key", "place")).alias("at"), F.first("mixed").alias("mixed"))
    whole = keep(whole, "suffix-whole")
    settled = some.join(whole.where("n > 1").select("seed", "run"), ["seed", "run"])
    first, more = F.shiftright("place", 20), F.shiftright("place", 10).bitwiseAND(1023)
    spans = settled.select("doc_id", "text_key", first.alias("start"), (more + length).alias("size"))
    spans = spans.union(runs.where("seed is null").select("doc_id", "text_key", "place", "n"))

    # The others share at most a part of their windows.
    open_ = whole.where("mixed").groupBy(F.col("at.doc_id").alias("id"), F.col("at.text_key").alias("key")).agg(
        F.collect_list(F.struct("seed", "n", "at.place")).alias("runs")  # bounded by the text's length
    )
    found = texts.join(open_, texts["doc_id"].eqNullSafe(F.col("id")) & (texts["text_key"] == F.col("key"))).select("doc_id", "text_key", "text", "runs")
    # Equal rows bring the same runs twice, which were settled before.
    contexts = keep(with_contexts(found, length), "suffix-contexts")
    large = contexts.groupBy("seed").count().where(F.col("count") > GROUP).select("seed")
    small = contexts.join(large, "seed", "left_anti").repartition("seed").sortWithinPartitions("seed", "suffix").drop("suffix")
    single = single_windows(contexts.join(large, "seed").drop("suffix"), length)
    twice = single.groupBy("window").agg(F.count("*").alias("count")).where("count > 1").select("window")
    by_window = single.join(twice, "window").where("n = 1").select("doc_id", "text_key", "start", F.lit(length).cast("bigint").alias("size"))
    return spans.union(induced(small, length)).union(by_window)


def remove_repeats(docs: DataFrame, length: int = 200, id_col: str = "doc_id", text_col: str = "text", whole_rows: bool = False) -> DataFrame:
    """``doc_id, n_bytes, spans, kept, kept_text`` for every row of ``docs``: the text's bytes
    without those that lie in a string of ``length`` bytes that starts at another place, too, in
    any text, and the removed stretches (``start, end``).  All copies go, the first included.
    With ``whole_rows`` also the row itself, as ``record``.

    Texts are judged as UTF-8 bytes, on the input; cuts may fall inside a character, so ``kept``
    is binary; ``kept_text`` has the whole characters of it.  A null text counts as empty.  Null
    and repeated ids are kept row by row (equal rows remove each other); an empty table gives an
    empty result; further columns are ignored."""
    texts = doc_text(docs, id_col, text_col).withColumn("text_key", F.xxhash64("text"))
    spans = repeated_spans(texts, length).groupBy(F.col("doc_id").alias("id"), F.col("text_key").alias("key")).agg(
        F.collect_list(F.struct("start", (F.col("start") + F.col("size")).alias("end"))).alias("found")  # bounded by the text's length
    )
    spans = keep(spans, "suffix-spans")
    record = F.struct(*[docs[c] for c in docs.columns]) if whole_rows else F.lit(None).cast("int")
    rows = docs.select(docs[id_col].cast("bigint").alias("doc_id"), F.coalesce(docs[text_col].cast("string"), F.lit("")).alias("text"), record.alias("record"))
    rows = rows.withColumn("text_key", F.xxhash64("text"))
    joined = rows.join(spans, rows["doc_id"].eqNullSafe(F.col("id")) & (rows["text_key"] == F.col("key")), "left").select("doc_id", "text", "found", "record")
    names = ["doc_id", "n_bytes", "spans", "kept", "kept_text", "record"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                sizes, spans, kept = [], [], []
                for text, found in zip(part.column(1).to_pylist(), part.column(2).to_pylist()):
                    raw = text.encode()
                    pairs = np.array([(f["start"], f["end"]) for f in found or []], np.int64).reshape(-1, 2)
                    a, b = merged(pairs[:, 0], pairs[:, 1])
                    sizes.append(len(raw))
                    spans.append([{"start": int(x), "end": int(y)} for x, y in zip(a, b)])
                    kept.append(b"".join(raw[x:y] for x, y in zip([0, *b], [*a, len(raw)])))
                kept_text = pa.array([k.decode(errors="ignore") for k in kept], pa.string())
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(sizes, pa.int64()), pa.array(spans, kind), pa.array(kept, pa.binary()), kept_text, part.column(3)], names)

    kind = joined.schema["record"].dataType.simpleString()
    out = joined.mapInArrow(run, f"doc_id bigint, n_bytes bigint, spans array<struct<start: bigint, end: bigint>>, kept binary, kept_text string, record {kind}")
    return out if whole_rows else out.drop("record")
