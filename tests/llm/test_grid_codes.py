"""Vector codes against plain k-means in Python integers."""

from hashlib import sha256
from math import floor, isfinite

import numpy as np
import pytest

from fieldbook.llm.grid_codes import Cells, compress, hex_code


def brute(rows, parts=8, entries=16, rounds=6, scale=4096):
    """``{(id, label, vector): [(code, error)]}`` and the digest."""
    kept = [(i, [floor(scale * x) for x in v], label) for i, v, label in rows if v is not None and all(x is not None and isfinite(x) for x in v)]
    cut = [[v[p * len(v) // parts : (p + 1) * len(v) // parts] for p in range(parts)] for _, v, _ in kept]
    first = sorted((n for n in range(len(kept)) if kept[n][0] is not None), key=lambda n: (kept[n][0], kept[n][1]))[:entries]
    books = [[cut[n][p] for n in first] for p in range(parts)]

    def nearest(x, book):
        return min((sum((a - b) ** 2 for a, b in zip(x, e)), n) for n, e in enumerate(book))

    for _ in range(rounds):
        for p, book in enumerate(books):
            mine = [nearest(c[p], book)[1] for c in cut]
            for n in range(len(book)):
                members = [c[p] for c, m in zip(cut, mine) if m == n]
                if members:
                    book[n] = [sum(x) // len(members) for x in zip(*members)]
    found = [[nearest(c[p], books[p]) for p in range(parts)] for c in cut]
    sums: dict = {}
    for (_, _, label), f in zip(kept, found):
        sums[label] = sums.get(label, 0) + sum(d for d, _ in f)
    digest = sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    return sorted((-1 if i is None else i, "".join(f"{n:02x}" for _, n in f), sum(d for d, _ in f), sums[label], digest) for (i, _, label), f in zip(kept, found))


def table(spark, rows):
    wide = [(i, v, label, "x", 1) for i, v, label in rows]
    return spark.createDataFrame(wide, "vec_id bigint, embedding array<double>, label int, code string, error int").repartition(3)


def result(df):
    rows = df.withColumn("code", hex_code(df["code"])).select("vec_id", "code", "error", "label_error", "codebooks_sha256").collect()
    return sorted((-1 if r[0] is None else r[0], *r[1:]) for r in rows)


@pytest.mark.parametrize("dim, n, size", [(16, 120, 0.2), (64, 60, 0.1), (8, 9, 0.5)])
def test_like_plain_rounds(spark, dim, n, size):
    rng = np.random.default_rng(dim)
    rows = [(int(k), [float(x) for x in np.float32(rng.normal(size=dim) * size)], int(k) % 3 or None) for k in rng.permutation(n)]
    rows += [rows[0], rows[0], (500, rows[1][1], 1), (None, rows[2][1], None), (501, [0.0] * dim, 2)]
    rows += [(502, None, 1), (1, [None] + [0.1] * (dim - 1), 1), (503, [float("nan")] + [0.1] * (dim - 1), 1), (504, [float("inf")] * dim, 1)]
    assert result(compress(table(spark, rows))) == brute(rows)


def test_large_components(spark):
    """Sums and distances are exact beyond 64 bits; only an error that no long holds is cut."""
    rows = [(k, [(-1.0) ** k * (k + 1) * 2e3] * 8, 1) for k in range(40)]
    assert result(compress(table(spark, rows))) == brute(rows)
    huge = [(k, [float(k) * 1e12] * 8, None) for k in range(40)]
    got = result(compress(table(spark, huge)))
    assert [r[1] for r in got] == [r[1] for r in brute(huge)] and all(r[2] == min(w[2], 2**63 - 1) for r, w in zip(got, brute(huge)))
    assert len(result(compress(table(spark, [(1, [1e308] * 8, None), (2, [-1e308] * 8, None)])))) == 2


def test_lengths_and_empty_tables(spark):
    rows = [(k, [k / 10.0] * 8, None) for k in range(20)]
    odd = [(100, [0.5] * 16, 1), (101, [0.5] * 9, 1), (102, [], 1)]
    assert result(compress(table(spark, rows + odd))) == brute(rows)
    assert result(compress(table(spark, odd[1:]))) == []
    assert result(compress(table(spark, []))) == []
    assert [r[0] for r in result(compress(table(spark, [(7, [0.0] * 8, 1)])))] == [7]


@pytest.mark.parametrize("bits", [0, 3, 7, 12])
def test_cells_change_nothing(bits):
    rng = np.random.default_rng(bits)
    entries, parts = rng.integers(-900, 900, (16, 4)), rng.integers(-1000, 1000, (3000, 4))
    entries[5], entries[9] = entries[2], entries[2]
    grid = Cells(entries.tolist(), bits)
    away = ((parts[:, None] - entries[None]) ** 2).sum(axis=2)
    for _ in range(2):  # the second time from memory
        entry, error = grid.nearest(parts)
        assert (entry == away.argmin(axis=1)).all() and (error == away.min(axis=1)).all()
    entry, error = grid.nearest(parts.astype(object))
    assert (entry == away.argmin(axis=1)).all() and (error == away.min(axis=1)).all()
