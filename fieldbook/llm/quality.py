"""Quality by weak supervision: rules vote or abstain, their accuracies are estimated by
expectation-maximisation, and the posterior probability decides (operator 4).

Only built-in functions; the driver sees no more than one count for each combination of votes."""

from __future__ import annotations

from math import exp, log

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import keep

SPACE = "\\x20\\x09-\\x0D"

#: Words in a window of the repetition count.
WINDOW = 5

#: When a rule votes for a text, and when against it, as SQL over the measured columns; it
#: abstains where neither holds.
RULES = {
    "length": ("n_words >= 30", "n_words < 10"),
    "word_length": ("word_chars between 3.5 * n_words and 7 * n_words", "word_chars < 2.5 * n_words or word_chars > 12 * n_words"),
    "symbols": ("n_symbols <= 0.02 * n_words", "n_symbols > 0.1 * n_words"),
    "repeated_lines": ("n_lines > 1 and n_dup_lines <= 0.1 * n_lines", "n_dup_lines > 0.3 * n_lines"),
    "repeated_words": ("n_repeat_words <= 0.05 * n_words", "n_repeat_words > 0.2 * n_words"),
    "letters": ("n_bare_words <= 0.05 * n_words", "n_bare_words > 0.2 * n_words"),
    "marks": ("n_marks <= 0.1 * word_chars", "n_marks > 0.2 * word_chars"),
    "line_ends": ("n_closed_lines >= 0.9 * n_lines", "n_closed_lines < 0.3 * n_lines"),
    "capitals": ("n_capitals <= 0.1 * word_chars", "n_capitals > 0.3 * word_chars"),
    "distinct_words": ("n_distinct_words >= 0.4 * n_words", "n_words >= 50 and n_distinct_words < 0.15 * n_words"),
}


def _repeated_words(words: Column, grams: Column) -> Column:
    """Words that lie in a window whose hash occurs twice: hashes are sorted with their places,
    neighbours compared, and the places found are widened to windows."""
    order = F.sort_array(F.transform(grams, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

    def places(s: Column) -> Column:
        last = F.size(s) - 1
        kept = F.filter(
            F.transform(s, lambda x, k: F.when((x["h"] == F.get(s, k - 1)["h"]) | ((k < last) & (x["h"] == F.get(s, k + 1)["h"])), x["i"])),
            lambda i: i.isNotNull(),
        )
        return F.sort_array(kept)

    def covered(p: Column) -> Column:
        parts = F.transform(p, lambda i, k: F.least(F.coalesce(F.get(p, k + 1) - i, F.lit(WINDOW)), F.lit(WINDOW)))
        return F.aggregate(parts, F.lit(0).cast("bigint"), lambda a, x: a + x)

    # ``transform`` over one value names it, so that it is computed once.
    return F.transform(F.array(order), lambda s: F.transform(F.array(places(s)), covered).getItem(0)).getItem(0)


def measures(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", whole_rows: bool = False) -> DataFrame:
    """Per document its counts; with ``whole_rows`` also the row itself, as ``record``.  Words are
    runs of anything but ASCII white space; lines are split at line feeds, and only those with a
    word count."""
    text = F.col("text")
    record = F.struct(*[docs[c] for c in docs.columns]) if whole_rows else F.lit(None)
    step = docs.select(
        docs[id_col].cast("bigint").alias("doc_id"), F.coalesce(docs[text_col].cast("string"), F.lit("")).alias("text"), record.alias("record")
    )
    inner = F.trim(text, F.lit(" \t\n\u000b\f\r"))
    words = F.when(inner == "", F.array().cast("array<string>")).otherwise(F.split(inner, f"[{SPACE}]+"))
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(f"[^{SPACE}]"))
    step = step.select(
        "doc_id",
        "record",
        words.alias("words"),
        lines.alias("lines"),
        F.length(F.translate(text, " \t\n\u000b\f\r", "")).cast("bigint").alias("word_chars"),
        (F.length(text) - F.length(F.translate(text, "#*$%&|<>", ""))).cast("bigint").alias("n_symbols"),
        F.regexp_count(text, F.lit("\\p{Lu}")).alias("n_capitals"),
        F.regexp_count(text, F.lit("[^\\p{L}\\p{N}\\s]")).alias("n_marks"),
        F.regexp_count(text, F.lit(f"(?<![^{SPACE}])[^\\p{{L}}{SPACE}]+(?![^{SPACE}])")).alias("n_bare_words"),
        F.regexp_count(text, F.lit("[^\\s\\p{L}\\p{N}|,;:][ \\t\\x0B-\\r]*(?:\\n|\\z)")).alias("n_closed_lines"),
    )
    gram = F.transform(
        F.slice("words", 1, F.greatest(F.size("words") - WINDOW + 1, F.lit(0))),
        lambda w, i: F.xxhash64(w, *[F.get("words", i + k) for k in range(1, WINDOW)]),
    )
    step = step.select(
        "*",
        F.size("words").cast("bigint").alias("n_words"),
        F.size("lines").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("bigint").alias("n_dup_lines"),
        F.size(F.array_distinct("words")).alias("n_distinct_words"),
        gram.alias("grams"),
    ).drop("lines")
    repeats = F.size("grams") > F.size(F.array_distinct("grams"))
    repeated = F.when(repeats, _repeated_words(F.col("words"), F.col("grams"))).otherwise(F.lit(0))
    step = step.withColumn("n_repeat_words", repeated.cast("bigint")).drop("words", "grams")
    return step if whole_rows else step.drop("record")


def votes(measured: DataFrame) -> DataFrame:
    """One text column ``votes`` with a letter per rule: ``+`` good, ``-`` bad, ``0`` abstains."""
    letters = [F.when(F.expr(bad), "-").when(F.expr(good), "+").otherwise("0") for good, bad in RULES.values()]
    return measured.withColumn("votes", F.concat(*letters))


def estimate(patterns: dict[str, int], rounds: int = 100, strength: float = 0.5) -> tuple[float, list[tuple[float, float]]]:
    """The share of good documents, and per rule its accuracy on good and on bad ones, where it
    votes: expectation-maximisation over the counts of vote patterns.  Accuracies have a prior of
    0.99 and 0.3 (rules seldom blame a good text and each sees one kind of badness), worth a part
    ``strength`` of the documents.  Without a strong one, a large group of texts that all fail the
    same rules becomes the bad class alone."""
    total = sum(patterns.values())
    if not total:
        return 0.5, [(0.99, 0.3)] * len(RULES)
    share, accuracy, prior = 0.8, [(0.99, 0.3)] * len(RULES), strength * total
    for _ in range(rounds):
        good_sum = prior * 0.8
        right = [[prior * 0.99, prior, prior * 0.3, prior] for _ in RULES]
        for pattern, n in patterns.items():
            g = posterior(pattern, share, accuracy)
            good_sum += n * g
            for r, v in zip(right, pattern):
                if v != "0":
                    r[0] += n * g * (v == "+")
                    r[1] += n * g
                    r[2] += n * (1 - g) * (v == "-")
                    r[3] += n * (1 - g)
        new = [(min(max(r[0] / r[1], 0.5), 0.999), min(max(r[2] / r[3], 0.01), 0.999)) for r in right]
        moved = max(abs(x - y) for a, b in zip(new, accuracy) for x, y in zip(a, b))
        share, accuracy = good_sum / (total + prior), new
        if moved < 1e-9:
            break
    return share, accuracy


def posterior(pattern: str, share: float, accuracy: list[tuple[float, float]]) -> float:
    """The probability that a document with these votes is good."""
    odds = log(share / (1 - share))
    for v, (on_good, on_bad) in zip(pattern, accuracy):
        if v == "+":
            odds += log(on_good / (1 - on_bad))
        elif v == "-":
            odds += log((1 - on_good) / on_bad)
    return 1 / (1 + exp(-max(min(odds, 500), -500)))


def judge_quality(docs: DataFrame, threshold: float = 0.5, id_col: str = "doc_id", text_col: str = "text", whole_rows: bool = False) -> DataFrame:
    """Counts, votes, ``p_good``, ``base_failed`` and ``kept`` for every row of ``docs``; with
    ``whole_rows`` also the row itself, as ``record``.

    ``base_failed``: fewer than 10 words, or more than a fifth of the words in repeated windows of
    five.  A document is kept if that does not hold and its posterior probability of being good is
    at least ``threshold``.  The posterior of all documents comes from their votes; accuracies
    are estimated over all of them, from at most 3 ** rules pattern counts.

    A null or empty text has no words and fails.  Null and repeated ids are kept row by row; an
    empty table gives an empty result; further columns are ignored.  Texts are read once and
    never shuffled; only counts and votes are kept."""
    voted = keep(votes(measures(docs, id_col, text_col, whole_rows)), "quality-votes")
    patterns = {r["votes"]: r["n"] for r in voted.groupBy("votes").agg(F.count("*").alias("n")).collect()}
    share, accuracy = estimate(patterns)
    odds = F.lit(log(share / (1 - share)))
    for k, (on_good, on_bad) in enumerate(accuracy):
        vote = F.substring("votes", k + 1, 1)
        odds = odds + F.when(vote == "+", log(on_good / (1 - on_bad))).when(vote == "-", log((1 - on_good) / on_bad)).otherwise(0.0)
    judged = voted.withColumn("p_good", 1 / (1 + F.exp(-odds)))
    failed = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    return judged.withColumn("base_failed", failed).withColumn("kept", ~F.col("base_failed") & (F.col("p_good") >= threshold))
