"""Packing of token ids into sequences by cutting-stock column generation (operator 2)."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .bpe import encoder, parts
from .shared import doc_text, keep

#: Id after every document.
END = 0

#: Ids of sequences that one document fills start here, those of shared ones at 0.
OWN_SEQUENCES = 1 << 62


# ---------------------------------------------------------------------------------------------
# The linear program: driver arithmetic on the histogram of lengths, at most ``size`` numbers.


def price(values: np.ndarray, lengths: np.ndarray, size: int) -> tuple[float, np.ndarray]:
    """Unbounded knapsack by dynamic programming: the most valuable multiset of lengths within
    ``size``, and how often it has each."""
    best, pick = np.zeros(size + 1), np.full(size + 1, -1)
    order = np.argsort(lengths)
    ls, vs = lengths[order], values[order]
    for c in range(1, size + 1):
        best[c] = best[c - 1]
        m = np.searchsorted(ls, c, "right")
        if m:
            got = best[c - ls[:m]] + vs[:m]
            j = int(got.argmax())
            if got[j] > best[c] + 1e-12:
                best[c], pick[c] = got[j], j
    pattern, c = np.zeros(len(lengths), dtype=np.int64), size
    while c > 0:
        if pick[c] < 0:
            c -= 1
        else:
            pattern[order[pick[c]]] += 1
            c -= ls[pick[c]]
    return best[size], pattern


def solve(lengths: np.ndarray, demand: np.ndarray, size: int, gap: float = 0.002, rounds: int = 400) -> tuple[np.ndarray, np.ndarray]:
    """Patterns (rows) and how often to use each, so that every length is used at least as often
    as it is demanded with few sequences: revised simplex, columns priced by ``price``.

    Prices are the dual values, drawn towards ``length / size`` (the dual values of a cutting
    without waste) as long as that finds a column that improves; without it the dual values swing
    for thousands of rounds.  It stops when a bound shows that at most a part ``gap`` more
    sequences are used than any solution needs, or after ``rounds``: any basis is a valid
    solution, and what it wastes is left to the steps that follow."""
    m = len(lengths)
    patterns = np.diag(size // lengths).astype(float)
    cost, inverse = np.ones(m), np.diag(1.0 / np.diag(patterns))
    x, flat = inverse @ demand, lengths / size
    for _ in range(rounds):
        dual = cost @ inverse
        if cost @ x <= (1 + gap) * (flat @ demand):
            break
        for pull in (0.9, 0.5, 0.0):
            _, pattern = price(np.maximum(pull * flat + (1 - pull) * dual, 0), lengths, size)
            if dual @ pattern > 1 + gap:
                column, c = pattern.astype(float), 1.0
                break
        else:
            j = int(dual.argmin())
            if dual[j] > -1e-7:
                break
            column, c = -np.eye(m)[j], 0.0  # more of a length than is demanded does no harm
        direction = inverse @ column
        up = direction > 1e-9
        if not up.any():
            break
        ratio = np.full(m, np.inf)
        ratio[up] = x[up] / direction[up]
        leaves = int(ratio.argmin())
        step = ratio[leaves]
        x = np.maximum(x - step * direction, 0)
        x[leaves] = step
        row = inverse[leaves] / direction[leaves]
        inverse -= np.outer(direction, row)
        inverse[leaves] = row
        patterns[leaves], cost[leaves] = column, c
    used = cost > 0
    return patterns[used].astype(np.int64), x[used]


def fill_up(left: np.ndarray, lengths: np.ndarray, size: int) -> np.ndarray | None:
    """A full sequence out of the lengths that are left, the longest of them included; None if
    there is none.  The set of reachable sums is a bit set, kept per item."""
    items = [j for j in np.argsort(-lengths, kind="stable") for _ in range(min(int(left[j]), size // int(lengths[j])))]
    if not items:
        return None
    full = (1 << (size + 1)) - 1
    sums = [1 << int(lengths[items[0]])]
    for j in items[1:]:
        sums.append((sums[-1] | sums[-1] << int(lengths[j])) & full)
        if sums[-1] >> size & 1:
            break
    else:
        return None if not sums[-1] >> size & 1 else _trace(items, sums, lengths, size, len(left))
    return _trace(items, sums, lengths, size, len(left))


def _trace(items: list[int], sums: list[int], lengths: np.ndarray, size: int, m: int) -> np.ndarray:
    pattern, at = np.zeros(m, dtype=np.int64), size
    for k in range(len(sums) - 1, 0, -1):
        if not sums[k - 1] >> at & 1:
            pattern[items[k]] += 1
            at -= int(lengths[items[k]])
    pattern[items[0]] += 1
    return pattern


def plan(histogram: dict[int, int], size: int) -> tuple[list[tuple], int]:
    """Slots ``(length, rank_from, rank_to, sequence, offset, stream)`` for documents ranked
    within their length, and the first position of the stream's end.

    Patterns that fill a sequence are used as often as the linear program has them, rounded down,
    then once more where what is left allows; what is left after that fills further sequences as
    far as a subset adds up.  All other documents form a stream in order of length and rank, which
    is cut at sequence ends (``stream``: position of the rank ``rank_from``)."""
    lengths = np.array(sorted(histogram), dtype=np.int64)
    left = np.array([histogram[int(n)] for n in lengths], dtype=np.int64)
    slots, used, sequence = [], np.zeros_like(left), 0

    def take(pattern: np.ndarray, times: int) -> None:
        nonlocal sequence
        at = 0
        for j in np.flatnonzero(pattern):
            for _ in range(pattern[j]):
                slots.append((int(lengths[j]), int(used[j]), int(used[j]) + times, sequence, at, False))
                used[j] += times
                at += int(lengths[j])
        left[:] = left - pattern * times
        sequence += times

    if len(lengths):
        patterns, x = solve(lengths, left.astype(float), size)
        full = patterns @ lengths == size
        for pattern, times in zip(patterns[full], np.floor(x[full] + 1e-9).astype(np.int64)):
            times = min(int(times), int((left[pattern > 0] // pattern[pattern > 0]).min()))
            if times:
                take(pattern, times)
        for k in np.argsort(-(x % 1), kind="stable"):
            if full[k] and (patterns[k] <= left).all():
                take(patterns[k], 1)
        rest = left.copy()
        while rest.any():
            pattern = fill_up(rest, lengths, size)
            if pattern is None:
                rest[np.flatnonzero(rest)[-1]] = 0  # the longest fits nowhere: for the stream
            else:
                times = int((rest[pattern > 0] // pattern[pattern > 0]).min())
                rest -= pattern * times
                take(pattern, times)
    at = sequence * size
    for j in np.flatnonzero(left):
        slots.append((int(lengths[j]), int(used[j]), int(used[j] + left[j]), -1, at, True))
        at += int(lengths[j] * left[j])
    return slots, at


# ---------------------------------------------------------------------------------------------

ENCODED = "doc_id bigint, start bigint, length bigint, doc_tokens bigint, sequence_id bigint, offset bigint, task bigint, seen bigint, ids binary"


def encoded(docs: DataFrame, vocabulary: str, size: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Every document's ids in blocks of ``size``.  A full block has a sequence of its own; the
    rest of a document (``sequence_id`` null) has the task that encoded it, and how many rests of
    the same length that task has ``seen`` before."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        enc, task = encoder(vocabulary), TaskContext.get().partitionId()
        own, seen, end = OWN_SEQUENCES + (task << 36), [0] * size, np.array([END], "<u4").tobytes()
        types = [pa.int64()] * 8 + [pa.binary()]
        for batch in batches:
            for part in parts(batch, 1):
                rows = []
                for doc, ids in zip(part.column(0).to_pylist(), enc.encode_all(part.column(1))):
                    ids += end
                    n = len(ids) // 4
                    for start in range(0, n, size):
                        piece = ids[4 * start : 4 * (start + size)]
                        length = len(piece) // 4
                        if length == size:
                            rows.append((doc, start, length, n, own, 0, None, None, piece))
                            own += 1
                        else:
                            rows.append((doc, start, length, n, None, None, task, seen[length], piece))
                            seen[length] += 1
                names = [c.split()[0] for c in ENCODED.split(", ")]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names)

    return doc_text(docs, id_col, text_col).mapInArrow(run, ENCODED)


def pack(docs: DataFrame, vocabulary: str, size: int = 1024, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The pieces of all documents, and where they lie: ``doc_id, start, length, doc_tokens,
    sequence_id, offset, ids`` (little-endian unsigned 32-bit).

    A document is encoded whole, without special tokens, and ends with id 0; a null or empty text
    has that id alone.  Blocks of ``size`` ids are sequences as they are.  For the rests, a linear
    program over the histogram of their lengths (at most ``size`` - 1 numbers, all the driver sees)
    is solved by column generation: the dual values price patterns in a knapsack.  The rounded
    patterns are laid over the documents in the order of their rank among the rests of equal
    length; ranks come from counts per task, so no length, however frequent, meets in one task.
    What no full pattern takes is laid end to end and cut where a sequence is full; only the last
    sequence of that stream would be short, so it is cut into sequences whose sizes are powers of
    two, which need no padding.

    Rows are independent of each other: null and repeated ids are kept.  An empty table gives an
    empty result; further columns are ignored."""
    table = keep(encoded(docs, vocabulary, size, id_col, text_col), "packing")
    rests = table.where(F.col("sequence_id").isNull()).drop("sequence_id", "offset")
    counts = rests.groupBy("length", "task").agg((F.max("seen") + 1).alias("n"))
    histogram = {r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    slots, stream_end = plan(histogram, size)

    spark = docs.sparkSession
    slot_table = spark.createDataFrame(slots, "length bigint, rank_from bigint, rank_to bigint, slot_sequence bigint, at bigint, stream boolean")
    before = counts.select(
        "length", "task", (F.sum("n").over(Window.partitionBy("length").orderBy("task")) - F.col("n")).alias("before")
    )
    rank = F.col("before") + F.col("seen")
    placed = (
        rests.join(before, ["length", "task"])
        .join(F.broadcast(slot_table), "length")  # bounded by the number of lengths and their patterns
        .where((rank >= F.col("rank_from")) & (rank < F.col("rank_to")))
        .withColumn("nth", rank - F.col("rank_from"))
    )
    whole = placed.where(~F.col("stream")).select(
        "doc_id", "start", "length", "doc_tokens", (F.col("slot_sequence") + F.col("nth")).alias("sequence_id"), F.col("at").alias("offset"), "ids"
    )
    return table.where(F.col("sequence_id").isNotNull()).drop("task", "seen").unionByName(whole).unionByName(_cut(placed.where("stream"), stream_end, size))


def _cut(placed: DataFrame, stream_end: int, size: int) -> DataFrame:
    """The documents of the stream, cut at the ends of its sequences."""
    last = stream_end // size * size
    starts = [last]  # of the sequences in the last, short part of the stream
    for k in reversed(range(size.bit_length())):
        if (stream_end - last) >> k & 1:
            starts.append(starts[-1] + (1 << k))
    tail = F.array(*[F.lit(s).cast("bigint") for s in starts])
    begin = F.col("at") + F.col("nth") * F.col("length")
    end = begin + F.col("length")
    next_full = F.least((F.floor(begin / size) + 1) * size, F.lit(last))
    bounds = F.array_sort(F.array_distinct(F.concat(F.array(begin, end), F.filter(F.concat(F.array(next_full), tail), lambda b: (b > begin) & (b < end)))))
    piece = F.explode(F.arrays_zip(F.slice("bounds", 1, F.size("bounds") - 1).alias("p"), F.slice("bounds", 2, F.size("bounds") - 1).alias("q")))
    p, q = F.col("piece.p"), F.col("piece.q")
    short = F.size(F.filter(F.col("tail"), lambda b: b <= p)) - 1
    return (
        placed.select("doc_id", "start", "doc_tokens", "ids", begin.alias("begin"), bounds.alias("bounds"), tail.alias("tail"))
        .select("*", piece.alias("piece"))
        .select(
            "doc_id",
            (F.col("start") + p - F.col("begin")).alias("start"),
            (q - p).alias("length"),
            "doc_tokens",
            F.when(p < last, F.floor(p / size)).otherwise(F.lit(last // size) + short).cast("bigint").alias("sequence_id"),
            F.when(p < last, p % size).otherwise(p - F.element_at("tail", short + 1)).cast("bigint").alias("offset"),
            F.expr("substring(ids, cast(4 * (piece.p - begin) + 1 as int), cast(4 * (piece.q - piece.p) as int))").alias("ids"),
        )
    )
