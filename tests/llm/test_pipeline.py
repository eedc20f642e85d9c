"""The stages of the pipeline, each on its own input, and the registered queries."""

import numpy as np
import public_tokenizers as P
from test_dedup import brute_links, brute_removed
from test_tokens import pieces_hold

import corpus_pipeline


def pairs(df):
    return [(r["doc_id"], r["text"]) for r in df.select("doc_id", "text").collect()]


def test_stages(spark, docs):
    from tokenizers import Tokenizer

    names = ["doc_id", "text", "lang", "source", "n_chars"]
    before = docs.select(*names)
    steps = dict(corpus_pipeline.STAGES)
    quality = steps["quality rules"](spark, before, "").cache()
    assert quality.columns == names and set(pairs(quality)) <= set(pairs(before)) and 0 < quality.count() < before.count()

    single = steps["n-gram Jaccard join"](spark, quality, "").cache()
    rows, kept = pairs(quality), pairs(single)
    parent, _ = brute_links(rows)
    assert single.columns == names and len(kept) == len(set(parent))
    assert {parent[rows.index(r)] for r in kept} == set(parent)

    cut = steps["suffix-array dedup"](spark, single, "").cache()
    want = {i: k.decode(errors="ignore") for (i, _), (_, _, k) in zip(kept, brute_removed(kept, 200))}
    assert cut.columns == names and dict(pairs(cut)) == {i: t for i, t in want.items() if t}
    assert all(r["n_chars"] == len(r["text"]) for r in cut.collect())

    t = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    ids = [(i, t.encode(x, add_special_tokens=False).ids + [0]) for i, x in pairs(cut)]
    assert pieces_hold(steps["packing"](spark, cut, "").collect(), ids, 1024) == 0


def test_queries_are_registered():
    import __spark_entry__ as entry

    names = [n for n in entry.queries() if n.startswith("op") and n[2].isdigit()]
    assert sorted(int(n[2:].split("_")[0]) for n in names) == list(range(1, 14)) and "pipeline" in entry.queries()


def test_run_over_a_table(spark):
    rows = corpus_pipeline.run(spark, "/root/testdata/sf0.001").collect()
    assert len({(r["doc_id"], r["start"]) for r in rows}) == len(rows) > 50
    assert sum(len(np.frombuffer(r["ids"], "<u4")) for r in rows) == sum(r["length"] for r in rows)
