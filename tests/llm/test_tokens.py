"""Operators on token ids: packing, token counts, encoding and decoding."""

import hashlib
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import public_tokenizers as P
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from fieldbook.llm.bpe import PieceEncoder, codec, slices
from fieldbook.llm.bpe_codec import decode, encode, with_digests
from fieldbook.llm.packing import fill_up, pack, plan, price, solve
from fieldbook.llm.token_counts import FIRST, LAST, section_counts

VOCABULARY, RANKS = P.path("byte_bpe_50k.json"), P.path("byte_bpe_multi_50k.tiktoken")


@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(VOCABULARY)
    t.encode_special_tokens = True
    return t


@given(st.text(alphabet=st.sampled_from(list("ab.,!'s \n\t0é漢\x1c\xa0🙂|<>")), max_size=60))
@settings(max_examples=300, deadline=None)
def test_pieces_give_the_ids_of_the_whole_text(text):
    enc = test_pieces_give_the_ids_of_the_whole_text.__dict__.setdefault("enc", PieceEncoder(VOCABULARY, limit=50))
    want = enc.tokenizer.encode(text, add_special_tokens=False).ids
    assert np.frombuffer(enc.encode_text(text), "<u4").tolist() == want
    assert [np.frombuffer(x, "<u4").tolist() for x in enc.encode_all(pa.array(["a b", text, ""]).slice(1))] == [want, []]


@given(st.text(alphabet=st.sampled_from(list("ab. \n'é1")), max_size=80))
@settings(max_examples=200, deadline=None)
def test_slices_are_encoded_like_the_whole(text):
    c = codec(RANKS, P.PATTERN)
    assert "".join(slices(text, 3)) == text
    assert [i for s in slices(text, 3) for i in c.encode_ordinary(s)] == c.encode_ordinary(text)


def test_codec(docs, texts, empty):
    got = Counter(tuple(r) for r in with_digests(decode(encode(docs, RANKS, P.PATTERN), RANKS, P.PATTERN)).collect())
    c, want = codec(RANKS, P.PATTERN), Counter()
    for i, t in texts:
        ids = c.encode_ordinary(t or "")
        want[i, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest()] += 1
    assert got == want
    assert with_digests(decode(encode(empty, RANKS, P.PATTERN), RANKS, P.PATTERN)).count() == 0


@pytest.mark.parametrize("rule", [FIRST, LAST])
def test_token_counts(docs, texts, tokenizer, empty, rule):
    got = Counter(tuple(r) for r in section_counts(docs, VOCABULARY, rule).collect())
    want = Counter()
    for i, t in texts:
        t = t or ""
        starts = [0] + [k + 1 for k, ch in enumerate(t[:-1]) if ch == "\n"]
        n, crossing = [0] * len(starts), [0] * len(starts)
        for a, b in tokenizer.encode(t, add_special_tokens=False).offsets:
            first = sum(s <= a for s in starts) - 1
            last = sum(s <= b - 1 for s in starts) - 1
            own = first if rule == FIRST else last
            n[own] += 1
            crossing[own] += first != last
        for k, s in enumerate(starts):
            want[i, k, s, starts[k + 1] if k + 1 < len(starts) else len(t), n[k], crossing[k]] += 1
    assert got == want
    assert section_counts(empty, VOCABULARY).count() == 0
    with pytest.raises(ValueError):
        section_counts(docs, VOCABULARY, "middle")


def pieces_hold(rows, want, size):
    """Every id of every document lies in exactly one piece, sequences have no gap; the padding."""
    assert Counter((r["doc_id"], r["doc_tokens"]) for r in rows if r["start"] == 0) == Counter((i, len(x)) for i, x in want)
    got = Counter()
    for r in rows:
        ids = np.frombuffer(r["ids"], "<u4").tolist()
        assert len(ids) == r["length"]
        got.update((r["doc_id"], r["start"] + k, v) for k, v in enumerate(ids))
    assert got == Counter((i, k, v) for i, x in want for k, v in enumerate(x))
    sequences = {}
    for r in rows:
        sequences.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    padding = 0
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= size
        padding += 0 if at & (at - 1) == 0 else size - at
    return padding


@pytest.mark.parametrize("size", [64, 1024])
def test_packing(docs, texts, tokenizer, empty, size):
    want = [(i, tokenizer.encode(t or "", add_special_tokens=False).ids + [0]) for i, t in texts]
    assert pieces_hold(pack(docs, VOCABULARY, size).collect(), want, size) == 0
    assert pack(empty, VOCABULARY, size).count() == 0


def test_pricing_is_a_knapsack():
    rng = np.random.default_rng(3)
    for _ in range(20):
        lengths = np.unique(rng.integers(1, 30, 6))
        values = rng.random(len(lengths))
        best = [0.0] * 41
        for c in range(1, 41):
            best[c] = max([best[c - 1]] + [best[c - n] + v for n, v in zip(lengths, values) if n <= c])
        value, pattern = price(values, lengths, 40)
        assert abs(value - best[40]) < 1e-9 and pattern @ lengths <= 40 and abs(pattern @ values - value) < 1e-9


def test_the_linear_program_covers_the_demand():
    lengths, demand = np.array([3, 5, 7, 11]), np.array([40.0, 30, 20, 50])
    patterns, x = solve(lengths, demand, 20)
    assert (patterns @ lengths <= 20).all() and (patterns.T @ x >= demand - 1e-6).all()
    assert x.sum() >= lengths @ demand / 20 - 1e-6


def test_a_plan_places_every_rank_once():
    rng = np.random.default_rng(1)
    for n in (1, 7, 400):
        histogram = {int(k): int(v) for k, v in Counter(rng.integers(1, 64, n).tolist()).items()}
        slots, end = plan(histogram, 64)
        ranks = Counter((s[0], r) for s in slots for r in range(s[1], s[2]))
        assert ranks == Counter((k, r) for k, v in histogram.items() for r in range(v))
        assert end == sum(k * v for k, v in histogram.items())
    assert plan({}, 64) == ([], 0)


def test_fill_up_finds_exact_sums():
    lengths = np.array([2, 5, 9])
    assert fill_up(np.array([3, 1, 1]), lengths, 16) is not None  # 9 + 5 + 2
    assert fill_up(np.array([0, 1, 1]), lengths, 16) is None
    assert fill_up(np.array([0, 0, 0]), lengths, 16) is None


def test_digest_is_that_of_unsigned_ids(docs):
    from pyspark.sql import functions as F

    for r in pack(docs, VOCABULARY).select("ids", F.crc32("ids").alias("c")).limit(5).collect():
        assert r["c"] == zlib.crc32(bytes(r["ids"]))
