"""Near duplicates and repeated byte strings against brute force."""

from collections import Counter
from itertools import combinations

import numpy as np
import pytest

from fieldbook.llm import jaccard, suffix_dedup
from fieldbook.llm.components import components
from fieldbook.llm.jaccard import bands_and_rows, near_duplicates, one_of_each
from fieldbook.llm.suffix_dedup import remove_repeats, windows_minimum


def brute_links(rows):
    sets = []
    for _, t in rows:
        w = (t or "").encode().split()
        sets.append({tuple(w[k : k + 5]) for k in range(len(w) - 4)} or ({tuple(w)} if w else set()))
    parent, links = list(range(len(rows))), [0] * len(rows)
    for a, b in combinations(range(len(rows)), 2):
        if sets[a] and len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b]):
            links[a] += 1
            links[b] += 1
            old, new = parent[b], parent[a]
            parent = [new if p == old else p for p in parent]
    return parent, links


def least(ids):
    return None if None in ids else min(ids)


@pytest.mark.parametrize("block", [512, 2])
def test_near_duplicates(docs, texts, empty, block, monkeypatch):
    monkeypatch.setattr(jaccard, "BLOCK", block)
    got = near_duplicates(docs).collect()
    parent, links = brute_links(texts)
    classes = {p: least([texts[k][0] for k, q in enumerate(parent) if q == p]) for p in parent}
    assert Counter((r["doc_id"], r["class_id"], r["n_links"]) for r in got) == Counter((i, classes[p], n) for (i, _), p, n in zip(texts, parent, links))
    assert sum(r["is_first"] for r in got) == len(set(parent))
    assert near_duplicates(empty).count() == 0


def test_one_of_each_keeps_columns(docs, texts):
    parent, _ = brute_links(texts)
    kept = one_of_each(docs)
    assert kept.columns == docs.columns and kept.count() == len(set(parent))


def test_bands_reach_the_recall():
    bands, rows = bands_and_rows(0.8, 0.9999)
    assert 1 - (1 - 0.8**rows) ** bands >= 0.9999


def test_components(spark):
    edges = [(k, k + 1) for k in range(50)] + [(100, k) for k in range(101, 160)] + [(7, 7), (None, 3), (201, 200)]
    got = {r["node"]: r["component"] for r in components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    assert got == {**{k: 0 for k in range(51)}, **{k: 100 for k in range(100, 160)}, 200: 200, 201: 200}
    assert components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


def brute_removed(rows, length):
    raw = [(t or "").encode() for _, t in rows]
    seen = Counter(r[k : k + length] for r in raw for k in range(len(r) - length + 1))
    out = []
    for r in raw:
        gone = np.zeros(len(r), bool)
        for k in range(len(r) - length + 1):
            if seen[r[k : k + length]] > 1:
                gone[k : k + length] = True
        edge = np.diff(np.concatenate(([0], gone.astype(int), [0])))
        spans = tuple(zip(np.flatnonzero(edge == 1).tolist(), np.flatnonzero(edge == -1).tolist()))
        out.append((len(r), spans, bytes(np.frombuffer(r, np.uint8)[~gone])))
    return out


@pytest.mark.parametrize("group, length", [(30_000, 200), (0, 200), (30_000, 60)])
def test_repeats(docs, texts, empty, group, length, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "GROUP", group)
    got = Counter((r["doc_id"], r["n_bytes"], tuple((s["start"], s["end"]) for s in r["spans"]), bytes(r["kept"])) for r in remove_repeats(docs, length).collect())
    assert got == Counter((i, *x) for (i, _), x in zip(texts, brute_removed(texts, length)))
    assert remove_repeats(empty).count() == 0


def test_kept_text_has_whole_characters(docs):
    rows = remove_repeats(docs, 200, whole_rows=True).collect()
    assert all(r["kept_text"] == bytes(r["kept"]).decode(errors="ignore") for r in rows)
    assert rows[0]["record"]["lang"] == "en"


def test_windows_minimum():
    x = np.random.default_rng(0).integers(0, 1000, 57).astype(np.uint64)
    for width in (1, 5, 57):
        assert windows_minimum(x, width).tolist() == [x[k : k + width].min() for k in range(57 - width + 1)]
