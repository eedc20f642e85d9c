"""Vector code compression with memoised grid cells (operator 13).

Vectors are cut into parts, and each part is replaced by the number of its nearest codebook entry.
Which entry is nearest is decided by coarse grid cells: the first part that falls into a cell finds
out which entries can be nearest to any point of the cell's box at all, and every later part of the
same cell is compared with these only."""

from __future__ import annotations

from collections.abc import Iterator
from decimal import Decimal
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldbook.operators.joins import fits_broadcast, skew_join

from .shared import columns_as, keep, ship

#: Bits of a cell's width, and cells that a task remembers per part before it starts afresh.
CELL_BITS, REMEMBERED = 8, 30_000

#: Components beyond this count as this; it keeps sums within 38 digits.
LARGEST = 10**27

LONG = 2**63 - 1


def whole_numbers(values: np.ndarray, scale: int) -> np.ndarray:
    """``floor(scale * x)``: int64 where squared distances fit, else Python integers."""
    floors = np.floor(np.clip(values * float(scale), -float(LARGEST), float(LARGEST)))
    if not floors.size or np.abs(floors).max() < 2**28:
        return floors.astype(np.int64)
    return np.array([int(x) for x in floors.ravel()], dtype=object).reshape(floors.shape)


def distinct(cells: np.ndarray) -> tuple[list, np.ndarray, np.ndarray]:
    """Keys of the distinct rows, the place of each one's first row, and each row's key number."""
    if cells.dtype == object:
        numbers: dict = {}
        inverse = np.array([numbers.setdefault(tuple(c), len(numbers)) for c in cells])
        return list(numbers), np.unique(inverse, return_index=True)[1], inverse
    rows = np.ascontiguousarray(cells).view(np.dtype((np.void, cells.dtype.itemsize * cells.shape[1]))).ravel()
    _, first, inverse = np.unique(rows, return_index=True, return_inverse=True)
    return [rows[i].tobytes() for i in first], first, inverse.ravel()


class Cells:
    """Nearest entries of one part's codebook, with a memory of cells."""

    def __init__(self, entries: list[list[int]], bits: int):
        self.exact = np.array(entries, dtype=object)
        self.small = self.exact.astype(np.int64) if np.abs(self.exact).max(initial=0) < 2**28 and self.exact.shape[1] <= 64 else None
        self.bits, self.known = bits, {}

    def possible(self, low: np.ndarray, entries: np.ndarray) -> np.ndarray:
        """Per cell, the entries that are not dominated: an entry is, if even its least distance to
        the cell's box is more than another entry's greatest.  Equal ones stay, for ties."""
        high = low + ((1 << self.bits) - 1)
        below, above = low[:, None, :] - entries[None], entries[None] - high[:, None, :]
        near = np.maximum(np.maximum(below, above), 0)
        far = np.maximum(-below, -above)
        far = np.maximum(far, -far)
        return (near * near).sum(axis=2) <= (far * far).sum(axis=2).min(axis=1)[:, None]

    def nearest(self, parts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Number of and squared distance to the nearest entry, ties to the lower number."""
        small = parts.dtype != object and self.small is not None
        entries = self.small if small else self.exact
        cells = parts >> self.bits
        keys, first, inverse = distinct(cells)
        if len(self.known) > REMEMBERED:
            self.known.clear()
        new = [n for n, key in enumerate(keys) if key not in self.known]
        for at in range(0, len(new), 1024):
            some = new[at : at + 1024]
            for n, mask in zip(some, self.possible(cells[first[some]] << self.bits, entries)):
                self.known[keys[n]] = mask
        masks = np.array([self.known[key] for key in keys])[inverse]
        row, entry = np.nonzero(masks)
        away = parts[row] - entries[entry]
        away = (away * away).sum(axis=1)
        start = np.searchsorted(row, np.arange(len(parts)))
        least = np.minimum.reduceat(away, start)
        hit = np.nonzero(away == least[row])[0]
        return entry[hit[np.unique(row[hit], return_index=True)[1]]], least


def take_part(vectors: DataFrame, parts: int, id_col: str, vector_col: str, label_col: str | None) -> DataFrame:
    """``id, v, label`` of the rows that take part."""
    rows = vectors.select(
        vectors[id_col].cast("bigint").alias("id"),
        vectors[vector_col].cast("array<double>").alias("v"),
        (vectors[label_col] if label_col else F.lit(None)).cast("string").alias("label"),
    )
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    rows = rows.where(F.col("v").isNotNull() & F.forall("v", finite) & (F.size("v") > 0) & (F.size("v") % parts == 0))
    most = rows.groupBy(F.size("v").alias("n")).count().orderBy(F.desc("count"), F.desc("n")).first()
    return rows.where(F.size("v") == (most["n"] if most else 0))


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def train_codebooks(rows: DataFrame, parts: int = 8, entries: int = 16, rounds: int = 6, scale: int = 4096, bits: int = CELL_BITS) -> list[list[list[int]]]:
    """Codebooks ``[part][entry][component]``.  They start as the parts of the ``entries`` rows
    with the least ids (null ids aside, equal ids by their vectors).  Every round each task adds up
    its own parts by entry; only these sums, ``parts * entries`` rows a task, are shuffled."""
    first = rows.where("id is not null").orderBy("id", "v").limit(entries).collect()
    if not first:
        return []
    start = np.array([[int(x) for x in v] for v in (whole_numbers(np.array([r["v"]]), scale)[0] for r in first)], dtype=object)
    books = [[list(e) for e in p] for p in start.reshape(len(first), parts, -1).transpose(1, 0, 2)]

    for _ in range(rounds):

        def sums(batches: Iterator[pa.RecordBatch], books=books) -> Iterator[pa.RecordBatch]:
            grids = [Cells(b, bits) for b in books]
            width = len(books[0][0])
            total = np.zeros((parts, len(books[0]), width), dtype=object)
            count = np.zeros((parts, len(books[0])), dtype=np.int64)
            for batch in batches:
                if not batch.num_rows:
                    continue
                x = whole_numbers(_matrix(batch.column(0)), scale).reshape(batch.num_rows, parts, width)
                for p, grid in enumerate(grids):
                    entry, _ = grid.nearest(x[:, p])
                    some = np.zeros((len(books[0]), width), dtype=x.dtype)
                    np.add.at(some, entry, x[:, p])
                    total[p] += some
                    count[p] += np.bincount(entry, minlength=len(books[0]))
            p, e = np.nonzero(count)
            values = [[Decimal(int(t)) for t in total[a, b]] for a, b in zip(p, e)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(p, pa.int32()), pa.array(e, pa.int32()), pa.array(count[p, e]), pa.array(values, pa.list_(pa.decimal128(38, 0)))], ["p", "e", "n", "sums"]
            )

        part_sums = rows.select("v").mapInArrow(sums, "p int, e int, n bigint, sums array<decimal(38,0)>")
        # As many rows as there are numbers in the codebooks.
        for r in part_sums.select("p", "e", "n", F.posexplode("sums").alias("i", "x")).groupBy("p", "e", "i").agg(F.sum("x").alias("x"), F.sum("n").alias("n")).collect():
            books[r["p"]][r["e"]][r["i"]] = int(r["x"]) // r["n"]
    return books


def encode_vectors(rows: DataFrame, books: list[list[list[int]]], scale: int = 4096, bits: int = CELL_BITS) -> DataFrame:
    """``id, code`` (one number per part) ``, error`` (sum of the squared distances, in whole
    numbers) ``, label``."""

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grids = [Cells(b, bits) for b in books]
        for batch in batches:
            if not batch.num_rows:
                continue
            x = whole_numbers(_matrix(batch.column(1)), scale).reshape(batch.num_rows, len(books), -1)
            found = [grid.nearest(x[:, p]) for p, grid in enumerate(grids)]
            code = np.stack([f[0] for f in found], axis=1).astype(np.int32)
            error = sum(f[1].astype(object) for f in found)
            codes = pa.ListArray.from_arrays(np.arange(0, code.size + 1, code.shape[1], dtype=np.int32), pa.array(code.ravel()))
            yield pa.RecordBatch.from_arrays([batch.column(0), codes, pa.array([min(int(e), LONG) for e in error], pa.int64()), batch.column(2)], ["id", "code", "error", "label"])

    return rows.select("id", "v", "label").mapInArrow(encode, "id bigint, code array<int>, error bigint, label string")


def digest(books: list[list[list[int]]]) -> str:
    return sha256(",".join(str(x) for p in books for e in p for x in e).encode()).hexdigest()


def hex_code(code: Column) -> Column:
    """Two hexadecimal digits per part."""
    return F.array_join(F.transform(code, lambda c: F.lpad(F.lower(F.hex(c)), 2, "0")), "")


def compress(
    vectors: DataFrame, parts: int = 8, entries: int = 16, rounds: int = 6, scale: int = 4096, bits: int = CELL_BITS,
    id_col: str = "vec_id", vector_col: str = "embedding", label_col: str | None = "label",
) -> DataFrame:
    """``vec_id, code`` (array of numbers) ``, error, label_error`` (error summed over equal labels,
    null labels together) ``, codebooks_sha256`` of every vector that takes part.

    Vectors that are null, hold null or non-finite components, or have another length than most
    (among lengths that ``parts`` divides; the longest of equally frequent ones) take no part; a
    zero vector does, and so does a row without id, though no codebook starts from it.  Rows that
    repeat are all returned.  Components are whole numbers, ``floor(scale * x)``; those beyond
    10^27 count as 10^27, and an error beyond the largest long is the largest long.  With fewer rows
    than ``entries`` the codebooks have as many entries as there are rows.  An empty table, or one
    without ids, gives an empty result; further columns are ignored.

    A cell is ``2 ** bits`` wide; its width changes the work and never the result."""
    spark = ship(vectors.sparkSession)
    rows = keep(take_part(vectors, parts, id_col, vector_col, label_col), "codes-vectors")
    books = train_codebooks(rows, parts, entries, rounds, scale, bits)
    if not books:
        return spark.createDataFrame([], "vec_id bigint, code array<int>, error bigint, label_error bigint, codebooks_sha256 string")
    coded = keep(encode_vectors(rows, books, scale, bits).withColumns({"_none": F.col("label").isNull(), "_label": F.coalesce("label", F.lit(""))}), "codes")
    total = F.least(F.sum(F.col("error").cast("decimal(38,0)")), F.lit(LONG).cast("decimal(38,0)")).cast("bigint")
    labels = keep(columns_as(coded, _none="_none", _label="_label", error="error").groupBy("_none", "_label").agg(total.alias("label_error")), "codes-labels")
    on = ["_none", "_label"]
    # A label may hold most rows: a few labels are broadcast, many are joined with hot ones spread.
    joined = coded.join(F.broadcast(labels), on) if fits_broadcast(labels) else skew_join(coded, labels, on, "inner", spread=["id", "code"])
    return joined.select(F.col("id").alias("vec_id"), "code", "error", "label_error", F.lit(digest(books)).alias("codebooks_sha256"))
