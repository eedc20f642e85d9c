"""Approximate nearest neighbours against brute force."""

import math

import numpy as np
import pytest

from fieldbook.llm import ann
from fieldbook.llm.ann import neighbours, scan

SCHEMA = "vec_id bigint, embedding array<float>, label int, list int, floor double"


def frame(spark, rows):
    return spark.createDataFrame([(i, v, 0, 1, 2.0) for i, v in rows], SCHEMA)


def brute(rows, i, k):
    v = np.array(dict(rows)[i], np.float64)
    scored = sorted((-float(np.dot(v, np.array(x, np.float32).astype(float))), j) for j, x in rows if j != i)
    return scored[:k]


@pytest.mark.parametrize("block", [4096, 50])
def test_recall(spark, block, monkeypatch):
    monkeypatch.setattr(ann, "BLOCK", block)
    monkeypatch.setattr(ann, "SEEDS", 100)
    rng = np.random.default_rng(0)
    centre = rng.normal(size=(8, 24))
    x = (centre[rng.integers(0, 8, 1500)] + rng.normal(size=(1500, 24))) * rng.uniform(0.5, 2, (1500, 1))
    x = x.astype(np.float32).astype(float)
    x[700:760] = x[700]
    rows = [(k, v.tolist()) for k, v in enumerate(x)]
    bad = [(2000, None), (2020, [0.0] * 24), (2040, [None] + [1.0] * 23), (2060, [math.nan] * 24), (2080, [math.inf] * 24), (None, rows[0][1]), (2100, [1.0])]
    got = neighbours(frame(spark, rows + bad)).collect()
    assert {r["query_id"] for r in got} == set(range(0, 1500, 20))
    hits = 0
    for q in range(0, 1500, 20):
        own = sorted((r["rank"], r["vec_id"], r["score"]) for r in got if r["query_id"] == q)
        scores = x @ x[q]
        assert [r for r, _, _ in own] == list(range(1, 21)) and q not in {v for _, v, _ in own}
        assert all(abs(scores[v] - s) < 1e-9 for _, v, s in own)
        assert own == [(r, v, s) for r, (s, v) in enumerate(sorted(((s, v) for _, v, s in own), key=lambda p: (-p[0], p[1])), 1)]
        scores[q] = -np.inf
        best = np.sort(scores)[-20]
        hits += sum(scores[v] >= best - 1e-9 for _, v, _ in own)
    assert hits / (75 * 20) >= 0.9


def test_few_and_none(spark):
    rows = [(k, [float(k + 1), 1.0]) for k in range(0, 50, 10)]
    got = neighbours(frame(spark, rows)).collect()
    for q in (0, 20, 40):
        assert [r["vec_id"] for r in sorted((r for r in got if r["query_id"] == q), key=lambda r: r["rank"])] == [j for _, j in brute(rows, q, 20)]
    assert neighbours(frame(spark, [(1, None)])).count() == 0
    assert neighbours(frame(spark, [(1, [1.0, 2.0])])).count() == 0
    assert neighbours(frame(spark, rows).where("false")).count() == 0


def test_scan_keeps_what_is_near():
    rng = np.random.default_rng(1)
    q, x = rng.normal(size=(5, 40)), rng.normal(size=(300, 40))
    distance = ((q[:, None] - x[None]) ** 2).sum(axis=2)
    reach = np.sort(distance, axis=1)[:, 10]
    qi, xi = scan(q, x, reach)
    found = set(zip(qi.tolist(), xi.tolist()))
    near = {(a, b) for a in range(5) for b in np.flatnonzero(distance[a] <= reach[a]).tolist()}
    assert found <= near and len(found) >= 0.95 * len(near)


def test_over_long_rows_take_no_part(spark):
    rows = [(k, [float(k + 1), 1.0]) for k in range(0, 50, 10)]
    odd = [(1000, [1.0] * 5), (1020, [1.0, None, 2.0, 3.0, 4.0, 5.0]), *((k, [None] * 7) for k in range(2000, 2010))]
    got = neighbours(frame(spark, rows + odd)).collect()
    assert {r["query_id"] for r in got} == {0, 20, 40} and {r["vec_id"] for r in got} == {k for k, _ in rows}
