"""Conversation repair against a plain search over all edits, for each conversation by itself."""

import heapq
import random
import re
import zlib
from hashlib import sha256

import pytest

from fieldbook.llm.repair import END, apply_edits, audit, damaged, repair, rows_of, signature, solve, solve_signatures

AFTER = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("u", "a"): "a", ("a", "u"): "u"}


def search(rows):
    """Cheapest edits by Dijkstra on (rows done, last role), ASCII-least among equally cheap ones.
    ``rows``: (role, text, gone, truncated)."""
    heap, done = [(0, "", 0, "", ())], {}
    while heap:
        cost, edits, at, last, out = heapq.heappop(heap)
        if (at, last) in done:
            continue
        done[at, last] = True
        if at == len(rows) and last in ("", "a"):
            return cost, edits, list(out)
        def go(extra, edit, to, row, skip):
            heapq.heappush(heap, (cost + extra, edits + edit, at + skip, to, out + row))
        for role in ("user", "assistant"):
            to = AFTER.get((last, role[0]))
            if to:
                go(3, "I", to, ((role, ""),), 0)
        if at < len(rows):
            role, text, gone, cut = rows[at]
            go(4, "D", last, (), 1)
            if not gone:
                to = AFTER.get((last, role[:1]))
                if to:
                    go(3 * cut, "K", to, ((role, text),), 1)
                for new in ("user", "assistant"):
                    to = AFTER.get((last, new[0]))
                    if to:
                        go(3 + 3 * cut, "R", to, ((new, text),), 1)


def brute(table):
    """The contract's columns from the raw rows."""
    out = {}
    for conv, turn, role, text in table:
        out.setdefault(conv, [])
        role, text = " " if role is None else role, " " if text is None else text
        n = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        if n == 0:
            continue
        text = "" if n == 1 else re.sub("[.!?]", "", text) if n == 2 else text
        out[conv] += [(turn, "user" if n == 4 else role, text)] * (2 if n == 3 else 1)
    result = []
    for conv, rows in out.items():
        rows.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
        seen, known, counts = set(), [], [0, 0, 0]
        for _, role, text in rows:
            words = re.sub(r"[\x20\x09-\x0D]", "", text)
            blank, again = not words, (role, text) in seen
            cut = not blank and not again and words[-1] not in ".!?"
            for n, x in enumerate((blank, again and not blank, cut)):
                counts[n] += x
            seen.add((role, text))
            known.append((role, text, blank or again, cut))
        turns = {t for t, _, _ in rows if t is not None}
        gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
        illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:]))
        cost, edits, lines = search(known)
        result.append((-1 if conv is None else conv, gaps, *counts, illegal, cost, edits, sha256("\n".join(f"{r}:{t}" for r, t in lines).encode()).hexdigest()))
    return sorted(result)


def got(found):
    rows = found.collect()
    return sorted(
        (-1 if r["conv_id"] is None else r["conv_id"], r["gaps"], r["blank"], r["duplicate"], r["truncated"], r["illegal"], r["cost"], r["audit"],
         sha256("\n".join(f"{x['role']}:{x['text']}" for x in r["repaired"]).encode()).hexdigest())
        for r in rows
    )


def table(spark, rows):
    wide = [(*r, 7, "x") for r in rows]
    return spark.createDataFrame(wide, "conv_id bigint, turn bigint, role string, text string, signature int, audit string").repartition(3)


@pytest.fixture(scope="module")
def talks():
    rng, rows = random.Random(3), []
    says = ["Yes.", "No!", "Why?", "cut off", "one. ", "two.\n", "", " \t", "né à 漢字.", "x ", None]
    for conv in range(400):
        for turn in range(rng.randint(1, 9)):
            role = rng.choice(["user", "assistant"] * 6 + ["system", "tool", "User", "", None])
            rows.append((conv, turn + rng.choice((0, 0, 0, 2)), role, rng.choice(says[:6] * 2 + says) and rng.choice(says)))
    rows += [(None, t, r, s) for t, r, s in [(None, "user", "a."), (3, "assistant", "b."), (None, "user", "a."), (3, "assistant", "b.")]]
    rows += [(900, k, ("user", "assistant")[k % 2], f"turn {k}.") for k in range(1500)]
    rows += [(901, 0, "assistant", "word " * 200_000)]
    rows += [(k, 0, "user", "same.") for k in range(1000, 1040)] + [(1050, -(2**40), "user", "a."), (1050, 2**40, "assistant", "b.")]
    return rows


def test_like_search(spark, talks):
    assert got(repair(damaged(rows_of(table(spark, talks))))) == brute(talks)


def test_rows_as_they_are(spark):
    rows = [(1, 1, "assistant", "b."), (1, 0, "user", "a."), (2, 0, "system", "s."), (2, 1, "user", "u"), (3, None, None, None)]
    found = {r["conv_id"]: r for r in repair(rows_of(table(spark, rows))).collect()}
    assert (found[1]["cost"], found[1]["audit"]) == (0, "KK") and [x["role"] for x in found[1]["repaired"]] == ["user", "assistant"]
    assert (found[2]["audit"], found[2]["cost"]) == ("KKI", 6)
    assert (found[3]["audit"], found[3]["blank"], found[3]["repaired"]) == ("D", 1, [])
    assert repair(rows_of(table(spark, []))).count() == 0


def test_every_short_signature(spark):
    """All words of up to three letters: nodes solved once give what a search gives."""
    from itertools import product

    role = {"s": "system", "u": "user", "a": "assistant", "o": "tool"}
    words = ["".join(w) for n in range(4) for w in product("suaoSUAOx", repeat=n)]
    solved = {r["signature"]: r for r in solve_signatures(spark.createDataFrame([(w,) for w in words], "signature string").repartition(5)).collect()}
    assert len(solved) == len(words)
    for w in words:
        rows = [(role.get(c.lower(), "user"), str(n), c == "x", c.isupper()) for n, c in enumerate(w)]
        cost, edits, out = search(rows)
        assert (solved[w]["cost"], solved[w]["audit"]) == (cost, edits)
        assert [(x["role"], x["text"]) for x in apply_edits([(0, r[0], r[1]) for r in rows], edits)] == out


def test_long_signature():
    node = END
    for letter in "uaUxAsso" * 5000:
        node = solve(letter, node)
    assert len(audit(node)) >= 40_000
    assert signature([(0, "user", "a"), (0, "user", "a")])[0] == "Ux"
