"""Language model, quality rules, licences and urls."""

import math
import random
import re
import zlib
from collections import Counter

import pytest

from fieldbook.llm.licence import OTHERS, TEMPLATES, Model, by_document, licences
from fieldbook.llm.maxent import score_texts
from fieldbook.llm.quality import RULES, estimate, judge_quality, posterior
from fieldbook.llm.queries import URL_RULES
from fieldbook.llm.url_filter import judge_urls, train

SPACE = r"[^\x20\x09-\x0D]+"


def test_language_model(docs, texts, empty):
    got = score_texts(docs).collect()
    tokens = [(i, (t or "").encode().lower().split() + [b""]) for i, t in texts]
    held = lambda i: i is not None and zlib.crc32(str(i).encode()) % 7 == 2
    counts = Counter(w for i, ws in tokens if not held(i) for w in ws)
    n, v = sum(counts.values()), len(counts)
    base = lambda ws: sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in ws)
    want = Counter((i, held(i), len(ws), sum(counts[w] > 0 for w in ws), n, round(base(ws), 6)) for i, ws in tokens)
    assert Counter((r["doc_id"], r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"], round(r["base_score"], 6)) for r in got) == want
    assert all(r["score"] < 0 for r in got)
    learned = [r for r in got if not r["held_out"]]
    assert sum(r["score"] for r in learned) > sum(r["base_score"] for r in learned)
    assert score_texts(empty).count() == 0


def test_probabilities_add_up():
    """Over all leaves after any context, and over the words of a leaf with its unknown word."""
    import numpy as np

    from fieldbook.llm.maxent import FEATURES, ROWS, WAYS, Model as Lm, Words, feature_rows

    head = [(f"w{k}", 50 - k) for k in range(50)]
    words = Words(head, 30)
    mass = np.bincount(words.leaf, words.counts + 1.0, WAYS * WAYS)
    mass[sorted(set(words.bound_leaves))] += 1
    rng = np.random.default_rng(0)
    model = Lm(rng.normal(size=(2, FEATURES, ROWS, WAYS)).astype(np.float32), mass)
    leaves = np.arange(WAYS * WAYS)
    for context in ([3, 4], [9, 0], [0, 0]):
        h = feature_rows(np.array([*context, 5]), np.array([0]))[:, 2:]
        logs = np.concatenate([model.log_leaf(h, leaves[k : k + 1]) for k in leaves])
        assert abs(np.exp(logs).sum() - 1) < 1e-3
    assert all(words.leaf_of(w.encode()) == words.leaf[k + 1] for k, (w, _) in enumerate(head))
    assert Words([], 0).leaf_of(b"any") == 0


def brute_counts(t):
    words = re.findall(SPACE, t or "")
    lines = [x for x in (t or "").split("\n") if re.search(SPACE, x)]
    places = {}
    for k in range(len(words) - 4):
        places.setdefault(tuple(words[k : k + 5]), []).append(k)
    covered = {j for ks in places.values() if len(ks) > 1 for k in ks for j in range(k, k + 5)}
    failed = len(words) < 10 or 100 * len(covered) > 20 * len(words)
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in t or ""), len(lines) - len(set(lines)), len(covered), failed


def test_quality(docs, texts, empty):
    got = judge_quality(docs, whole_rows=True).collect()
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]
    assert Counter((r["doc_id"], *(r[n] for n in names)) for r in got) == Counter((i, *brute_counts(t)) for i, t in texts)
    votes = Counter(r["votes"] for r in got)
    share, accuracy = estimate(votes)
    for r in got:
        assert abs(r["p_good"] - posterior(r["votes"], share, accuracy)) < 1e-9
        assert r["kept"] == (not r["base_failed"] and r["p_good"] >= 0.5) and r["record"]["lang"] == "en"
    kept = {r["doc_id"] for r in got if r["kept"]}
    assert {1, 2, 3} <= kept and len(texts) - 5 - 4 not in kept
    assert judge_quality(empty).count() == 0


def test_estimation_finds_the_better_rules():
    import random

    rng, patterns = random.Random(0), Counter()
    right = [0.95, 0.9, 0.9] + [0.6] * (len(RULES) - 3)
    for _ in range(5000):
        good = rng.random() < 0.7
        patterns["".join("0" if rng.random() < 0.2 else "+" if (rng.random() < a) == good else "-" for a in right)] += 1
    share, accuracy = estimate(patterns, strength=0.01)
    assert abs(share - 0.7) < 0.05 and min(a for a, _ in accuracy[:3]) > 0.85 > max(a for a, _ in accuracy[3:])
    assert estimate({})[0] == 0.5


def test_licences(spark, docs, empty):
    rows = [(1, "Some words.\nReleased under the MIT License.\nmore"), (2, "Licensed under CC BY-NC 4.0."), (3, OTHERS[0]), (4, None), (5, ""), (2, "x")]
    rows += [(6, "This work is licensed under the GNU General Public License, version 3.\nReleased under the MIT License."), (None, TEMPLATES["apache"][0])]
    table = spark.createDataFrame([(i, t, "f", 1.0) for i, t in rows], "doc_id bigint, text string, family string, hits double")
    model = Model(TEMPLATES, OTHERS, copies=12)
    got = by_document(table, licences(table, model)).collect()
    want = [(1, 1, ["mit"]), (2, 1, ["cc-by-nc"]), (2, 1, ["cc-by-nc"]), (3, 0, []), (4, 0, []), (5, 0, []), (6, 2, ["gpl", "mit"]), (None, 1, ["apache"])]
    assert sorted(((r["doc_id"], r["n_notices"], r["licences"]) for r in got), key=str) == sorted(want, key=str)
    assert licences(docs, model).count() == 0 and by_document(empty, licences(empty, model)).count() == 0
    held = [(f, t + " And more words follow here.") for f, ts in TEMPLATES.items() for t in ts]
    table = spark.createDataFrame(list(enumerate(t for _, t in held)), "doc_id bigint, text string")
    found = {r["doc_id"]: r["family"] for r in licences(table, model).collect()}
    assert sum(found.get(k) == f for k, (f, _) in enumerate(held)) >= 0.9 * len(held)


URLS = [
    ("https://www.Example.com/en/x?y#z", "www.example.com", "/en/x", "www.example.com/en/", "allow"),
    ("http://a.example.com/en/1", "a.example.com", "/en/1", "example.com/en/", "block"),
    ("http://example.com", "example.com", "", None, None),
    ("http://b.net/es/", "b.net", "/es/", "net/es/", "block"),
    ("http://b.net/fr/q", "b.net", "/fr/q", "net/fr/", "block"),
    ("http://x.org/fr/q://w", "x.org", "/fr/q://w", None, None),
    ("no scheme", "", "", None, None),
    (None, "", "", None, None),
    ("ftp://h?q/a", "h", "", None, None),
    ("http://notexample.com/en/", "notexample.com", "/en/", "com/", "allow"),
    ("://", "", "", None, None),
]


def test_urls(spark):
    schema = "page_id bigint, url string, host string, rule int"
    pages = spark.createDataFrame([(k, u[0], "h", 1) for k, u in enumerate(URLS)] + [(0, URLS[0][0], "h", 1), (None, None, None, None)], schema)
    got = judge_urls(pages, URL_RULES).collect()
    assert len(got) == len(URLS) + 2
    for r in got:
        if r["page_id"] is not None:
            _, host, path, rule, verdict = URLS[r["page_id"]]
            assert (r["host"], r["path"], r["rule"]) == (host, path, rule) and r["verdict"] == (verdict or r["verdict"])
            assert (r["p_block"] is None) == (rule is not None)
    empty = judge_urls(pages.where("false"), URL_RULES)
    assert empty.count() == 0
    assert {r["verdict"] for r in judge_urls(pages, []).collect()} == {"allow"}


def test_url_model_learns_held_out_urls():
    import numpy as np

    from fieldbook.llm.url_filter import features

    rows = [(f"{'casino' if k % 2 else 'news'}-{k}.example.org", f"/{'win' if k % 2 else 'story'}/{k}", bool(k % 2)) for k in range(200)]
    w = train(rows[:150], bits=14)
    right = [(w[np.append(features(h, p, 14), 1 << 14)].sum() > 0) == y for h, p, y in rows[150:]]
    assert np.mean(right) > 0.95


def test_labels_of_one_class_allow(spark):
    pages = spark.createDataFrame([(1, "http://a.org/x")], "page_id bigint, url string")
    labelled = spark.createDataFrame([("a", "/x", True)], "host string, path string, blocked boolean")
    assert judge_urls(pages, [], labelled).first()["verdict"] == "allow"


@pytest.mark.parametrize("name", ["documents"])
def test_quality_agrees_with_labels(spark, name):
    judged = judge_quality(spark.read.parquet(f"/root/testdata/sf0.01/{name}.parquet"))
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    rows = judged.join(labels, "doc_id").where("not base_failed").select("kept", "quality").collect()
    good = [r["kept"] for r in rows if r["quality"] == 1]
    bad = [r["kept"] for r in rows if r["quality"] == 0]
    assert sum(good) >= 0.97 * len(good) and sum(bad) <= 0.2 * len(bad)


def test_language_model_tells_words_of_a_leaf_apart(spark, monkeypatch):
    """Words that differ in nothing but what stands before them, also with more than the head holds."""
    from fieldbook.llm import maxent

    rng = random.Random(3)
    after = {f"a{k}": f"z{k}q" for k in range(40)}
    texts = [" ".join(f"{a} {after[a]}" for a in rng.choices(list(after), k=60)) for _ in range(150)]
    wrong = " ".join(f"a{k} z{(k + 1) % 40}q" for k in range(40))
    right = " ".join(f"a{k} z{k}q" for k in range(40))
    rows = list(enumerate([*texts, right, wrong]))
    table = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(2)
    monkeypatch.setattr(maxent, "WAYS", 6)  # leaves of several words
    held = lambda i: i >= len(texts)
    score = {r["doc_id"]: r["score"] for r in score_texts(table, held_out=held).collect()}
    assert score[len(texts)] > score[len(texts) + 1] + 40 * math.log10(4)


def test_all_words_and_the_tail_add_up():
    import numpy as np

    from fieldbook.llm.maxent import FEATURES, LEVELS, Model as Lm, Words, feature_rows

    words = Words([(f"w{k}", 250 - k) for k in range(200)], 30, 7)
    mass = np.zeros((49, 7))
    mass[words.leaf, words.slot] = words.counts + 1
    mass[sorted(set(words.bound_leaves)), 0] += 3
    model = Lm(np.random.default_rng(0).normal(size=(LEVELS, FEATURES, 64, 7)).astype(np.float32), mass)
    assert len(set(zip(words.leaf, words.slot))) == 201 and words.slot.min() == 1
    leaf, slot = np.repeat(np.arange(49), 7), np.tile(np.arange(7), 49)
    h = feature_rows(np.array([3, 4, 5]), np.array([0]))[:, 2:]
    assert abs(np.exp(model.log_leaf(np.repeat(h, len(leaf), axis=1), leaf, slot)).sum() - 1) < 1e-3


def test_capacity_follows_the_vocabulary():
    from fieldbook.llm.maxent import HEAD, LEVELS, FEATURES, ROW_BITS, WAYS, WEIGHTS, row_bits_for, ways_for

    assert ways_for(100) == WAYS >= 32
    assert ways_for(HEAD) ** 2 * (ways_for(HEAD) - 1) >= HEAD
    assert row_bits_for(10, WAYS) == ROW_BITS < row_bits_for(1 << 30, WAYS)
    assert LEVELS * FEATURES * ways_for(HEAD) << row_bits_for(1 << 30, ways_for(HEAD)) <= WEIGHTS


def test_driver_has_no_copy_of_what_it_sends(spark, docs, monkeypatch):
    """It never loads a broadcast, has no object for each word, and deletes the weights of a round
    before it sends those of the next; shuffle files are Spark's again afterwards."""
    from pyspark import Broadcast

    from fieldbook.llm.maxent import Words
    from fieldbook.llm.shared import CLEANUP

    sent, gone, vocabularies = [], [], []
    send, destroy = spark.sparkContext.broadcast, Broadcast.destroy

    def broadcast(value):
        vocabularies.extend([value] if isinstance(value, Words) else [])
        sent.append(send(value))
        assert len(sent) - len(gone) <= 2
        return sent[-1]

    def loaded(self):
        raise AssertionError("loaded by the driver")

    before = spark.conf.get(CLEANUP, "false")
    monkeypatch.setattr(spark.sparkContext, "broadcast", broadcast)
    monkeypatch.setattr(Broadcast, "destroy", lambda self, blocking=False: (gone.append(self), destroy(self, blocking))[1])
    monkeypatch.setattr(Broadcast, "value", property(loaded))
    assert score_texts(docs).count() == docs.count()
    assert len(sent) == 5 and len(gone) == 3 and "ids" not in vars(vocabularies[0])
    assert spark.conf.get(CLEANUP, "false") == before


def test_segments_add_up_as_numpy_does():
    import numpy as np

    from fieldbook.llm.maxent import segment_sums

    rng = np.random.default_rng(2)
    for n, rows in ((1, 1), (7, 2), (500, 400), (3000, 60), (3000, 2500)):
        at, values = rng.zipf(1.3, n) % rows, rng.normal(size=(n, 9)).astype(np.float32)
        order = np.argsort(at, kind="stable")
        starts = np.flatnonzero(np.append(True, np.diff(at[order]) != 0))
        assert np.array_equal(segment_sums(values, order, starts), np.add.reduceat(values[order], starts, axis=0))


def test_words_of_texts_against_plain_python(texts):
    import pyarrow as pa

    from fieldbook.llm.maxent import Tokens, Words, split_words

    plain = ["", *[t or "" for _, t in texts], "\u00a0X\x1cy\x85 \x0bZ\x0c", " "]
    want = [t.encode().lower().split() for t in plain]
    column = pa.array(["before", *plain]).slice(1)
    words, which, n = split_words(column)
    names = words.to_pylist()
    assert [names[k] for k in which] == [w for ws in want for w in ws] and n.tolist() == [len(ws) for ws in want]
    head = Words([("more", 3), ("and", 2), ("né", 1)], 5)
    ids, context, n, (text, which, _) = Tokens(head).of(column)
    assert [head.ids.get(w, -1) for ws in want for w in [*ws, b""]] == [k if k < 4 else -1 for k in ids.tolist()]
    assert n.sum() == len(ids) == len(context)
    assert Counter((k, names[w]) for k, w in zip(text, which)) == Counter((k, w) for k, ws in enumerate(want) for w in ws if w not in head.ids)


def test_shards_follow_the_texts():
    from fieldbook.llm.maxent import SHARD, shards_for

    assert shards_for(211, 3, 2 * SHARD + 1) == 2 and shards_for(9, 3, 100 * SHARD) == 3 and shards_for(0, 3, 0) == 1


WRAPPED = [
    ("bsd", "Redistribution and use in source and binary forms, with or without\nmodification, are permitted provided that the following conditions are met"),
    ("gpl", "# This program is free software: you can redistribute it and/or modify\n# it under the terms of the GNU General Public License as published by\n# the Free Software Foundation"),
    ("lgpl", "This work is licensed under the GNU Lesser General\nPublic License, version 3."),
    ("agpl", "This work is licensed under the GNU Affero General Public License, version 3."),
    ("cc-by-sa", "Licensed under CC BY-SA 4.0."),
]


def test_wrapped_notices_and_like_families(spark):
    texts = [f"Some words here.\n{t}\nmore" for _, t in WRAPPED] + ["\n".join(t for _, t in WRAPPED), "free\nsoftware\n" * 50]
    table = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    got = {r["doc_id"]: (r["n_notices"], r["licences"]) for r in by_document(table, licences(table, Model(TEMPLATES, OTHERS, copies=12))).collect()}
    want = {k: (1, [f]) for k, (f, _) in enumerate(WRAPPED)}
    assert got == want | {5: (5, sorted(f for f, _ in WRAPPED)), 6: (0, [])}


def test_url_probabilities_against_plain_python(spark):
    """Rules, n-grams and probabilities once more, with Python's own integers."""
    from fieldbook.llm.url_filter import labelled_sample

    rng = random.Random(8)
    names = ["www.example.com", "a.example.com", "x.net", "m.y.net", "shop.org", "cheap-pills.org", "É.org", ""]
    urls = [f"{rng.choice(('http', 'https'))}://{rng.choice(names)}/{rng.choice(('en', 'es', 'fr', 'x'))}/{rng.randint(0, 99)}{rng.choice(('', '?q=1', '#t'))}" for _ in range(150)] + [None, "nothing", "a://B.NET/es/1"]

    def split(url):
        if not url or "://" not in url:
            return "", ""
        rest = re.split(r"[?#]", url.split("://", 1)[1])[0]
        host, slash, path = rest.partition("/")
        return "".join(c.lower() if "A" <= c <= "Z" else c for c in host), slash + path

    def rule(host, path):
        hits = [(len(r), v, r) for v, r in URL_RULES if (host == r[: r.index("/")] or host.endswith("." + r[: r.index("/")])) and path.startswith(r[r.index("/") :])]
        return max(hits)[1:] if hits else None

    def buckets(host, path, bits=16):
        out, cut = set(), 2**64 - 1
        for field, text in ((1, host), (2, path)):
            raw = f"^{text}$".encode()
            for at in range(len(raw)):
                h = field
                for n in range(5):
                    if at + n < len(raw):
                        h = (h * 0x9E3779B97F4A7C15 & cut) ^ (raw[at + n] * 0xC2B2AE3D27D4EB4F & cut)
                        h ^= h >> 29
                        if n:
                            out.add((h * 0xD6E8FEB86659FD93 & cut) >> (64 - bits))
        return sorted(out)

    pages = spark.createDataFrame(list(enumerate(urls)), "page_id bigint, url string").repartition(3)
    ruled = [(*split(u), rule(*split(u))) for u in urls]
    labels = spark.createDataFrame([(h, p, r[0] == "block") for h, p, r in ruled if r], "host string, path string, blocked boolean")
    w = train(labelled_sample(labels, 4000))
    got = {r["page_id"]: r for r in judge_urls(pages, URL_RULES).collect()}
    assert len(got) == len(urls) and any(r is None for _, _, r in ruled)
    for k, (host, path, hit) in enumerate(ruled):
        assert (got[k]["host"], got[k]["path"], got[k]["rule"]) == (host, path, hit and hit[1])
        if hit:
            assert got[k]["verdict"] == hit[0] and got[k]["p_block"] is None
        else:
            f = buckets(host, path)
            p = 1 / (1 + math.exp(-(sum(w[i] for i in f) + w[-1]) / math.sqrt(len(f) + 1)))
            assert abs(got[k]["p_block"] - p) < 1e-9 and got[k]["verdict"] == ("block" if p >= 0.5 else "allow")
