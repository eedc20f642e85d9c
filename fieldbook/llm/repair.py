"""Conversation structure repair over a suffix-shared automaton (operator 11).

A row is known to the repair by its role's initial and its fault alone, so a conversation is a
short word, its signature.  Signatures are merged from their ends: equal endings are one node of an
automaton.  Each node is solved once: for every state of the grammar of roles, what the cheapest
repair of the rest costs and which edits it begins with.  Conversations read their edits off."""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldbook.operators.joins import fits_broadcast, skew_join

from .shared import columns_as, keep, ship

#: Costs of the edits; a truncated row that stays costs ``TRUNCATED`` more.
REROLE, DELETE, INSERT, TRUNCATED = 3, 4, 3, 3

#: States of the grammar ``(s?(ua)+)?``: nothing yet, after s, after u, after a.  A conversation may
#: end in the first and the last.  In each state one role can be inserted or given to a row; NEXT is
#: the state after it.  KEPT: the state after a row that keeps its role.
NEXT = (2, 2, 3, 2)
KEPT = {"s": {0: 1}, "u": {0: 2, 1: 2, 3: 2}, "a": {2: 3}}

#: A signature's letter for a row that has to go; others are the role's initial, or ``o`` for one
#: that no grammar knows, in upper case if the row is truncated.
GONE = "x"

ROWS = "array<struct<turn:bigint,role:string,text:string>>"
_WORD = regex.compile(r"[^\x20\x09-\x0D]")
_ENDS = regex.compile(r"[.!?][\x20\x09-\x0D]*\Z")


def signature(rows: list[tuple]) -> tuple[str, int, int, int, int, int]:
    """Signature of the rows ``(turn, role, text)`` of a conversation in order, its missing turns,
    blank, repeated and truncated rows, and neighbours whose roles cannot follow each other."""
    seen, out = set(), []
    blank = repeated = truncated = 0
    for _, role, text in rows:
        initial = role[:1] if role[:1] in KEPT else "o"
        if not _WORD.search(text):
            blank, letter = blank + 1, GONE
        elif (role, text) in seen:
            repeated, letter = repeated + 1, GONE
        elif not _ENDS.search(text):
            truncated, letter = truncated + 1, initial.upper()
        else:
            letter = initial
        seen.add((role, text))
        out.append(letter)
    turns = {t for t, _, _ in rows if t is not None}
    gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
    illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:]))
    return "".join(out), gaps, blank, repeated, truncated, illegal


class Node(NamedTuple):
    """Per grammar state: the cost of the rest, the edits up to and with this row's, the state
    after it, and how the audits of the four states compare (equal ones have equal ranks)."""

    cost: tuple
    edits: tuple
    to: tuple
    rank: tuple
    rest: "Node | None"


#: Behind the last row: only insertions are left.
END = Node((0, 2 * INSERT, INSERT, 0), ("", "II", "I", ""), (0, 3, 3, 3), (0, 2, 1, 0), None)


def solve(letter: str, rest: Node) -> Node:
    """The node of a row with this letter in front of ``rest``.

    No two candidates' edits begin alike and go on differently at the same place unless they are
    equal, so that audits compare by the edits first and the rank of what follows then.  More than
    two insertions in a row only return to a state that fewer reach."""
    stay = TRUNCATED if letter.isupper() else 0
    kept = KEPT.get(letter.lower(), {})
    best = []
    for state in range(4):
        options, at, before = [], state, ""
        for inserted in range(3):
            moves = [("D", DELETE, at)]
            if letter != GONE:
                moves.append(("R", REROLE + stay, NEXT[at]))
                if at in kept:
                    moves.append(("K", stay, kept[at]))
            options += [(inserted * INSERT + cost + rest.cost[to], before + edit, rest.rank[to], to) for edit, cost, to in moves]
            at, before = NEXT[at], before + "I"
        best.append(min(options))
    order = {key: n for n, key in enumerate(sorted({b[1:3] for b in best}))}
    return Node(tuple(b[0] for b in best), tuple(b[1] for b in best), tuple(b[3] for b in best), tuple(order[b[1:3]] for b in best), rest)


def audit(node: Node) -> str:
    """The cheapest edits from a first row on."""
    out, state = [], 0
    while node is not None:
        out.append(node.edits[state])
        state, node = node.to[state], node.rest
    return "".join(out)


def solve_signatures(signatures: DataFrame) -> DataFrame:
    """``signature, cost, audit`` of distinct signatures.

    They are range-partitioned and sorted by their reversed text, which puts equal endings next to
    each other: a task keeps the path of nodes of one signature, goes back to where the next one
    differs, and adds nodes from there.  So a task needs memory for its longest signature only,
    solves each node once, and shares no more than the path at its border with the next task."""
    ordered = signatures.select("signature", F.reverse("signature").alias("ends")).repartitionByRange("ends").sortWithinPartitions("ends")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        path, last = [END], ""
        for batch in batches:
            cost, audits = [], []
            for ends in batch.column(1).to_pylist():
                same, most = 0, min(len(ends), len(last))
                while same < most and ends[same] == last[same]:
                    same += 1
                del path[same + 1 :]
                for letter in ends[same:]:
                    path.append(solve(letter, path[-1]))
                last = ends
                cost.append(path[-1].cost[0])
                audits.append(audit(path[-1]))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(cost, pa.int64()), pa.array(audits, pa.string())], ["signature", "cost", "audit"])

    return ordered.mapInArrow(run, "signature string, cost bigint, audit string")


def apply_edits(rows: list[tuple], edits: str) -> list[dict]:
    """The repaired rows; which role a new or reroled row has follows from the one before."""
    out, at = [], 0
    for edit in edits:
        role = "assistant" if out and out[-1]["role"][:1] == "u" else "user"
        if edit == "K":
            out.append({"role": rows[at][1], "text": rows[at][2]})
        elif edit == "R":
            out.append({"role": role, "text": rows[at][2]})
        elif edit == "I":
            out.append({"role": role, "text": ""})
        at += edit != "I"
    return out


def rows_of(table: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """``conv_id, turn, role, text`` with null roles and texts as one space."""
    rows = columns_as(table, conv_id=conv_col, turn=turn_col, role=role_col, text=text_col)
    space = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" ")).alias(c)
    return rows.select("conv_id", F.col("turn").cast("bigint").alias("turn"), space("role"), space("text"))


def damaged(rows: DataFrame) -> DataFrame:
    """``conv_id, rows``: each row as a list of what the damage leaves of it (none, one or two)."""
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat(text("conv_id"), F.lit(":"), text("turn")).cast("binary")) % 20
    said = F.when(kind == 1, "").when(kind == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    row = F.struct("turn", F.when(kind == 4, "user").otherwise(F.col("role")).alias("role"), said.alias("text"))
    copies = F.when(kind == 0, 0).when(kind == 3, 2).otherwise(1)
    return rows.select("conv_id", F.array_repeat(row, copies).cast(ROWS).alias("rows"))


def repair(rows: DataFrame) -> DataFrame:
    """Per conversation: ``conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit`` and
    the ``repaired`` rows (array of role and text).

    ``rows`` holds ``conv_id`` and either ``turn, role, text`` (see :func:`rows_of`) or lists of
    these as ``rows``, which may be empty: a conversation without rows has zeros, no audit and no
    repaired rows.  Rows are taken by turn, null turns first, equal turns by role and text; rows
    that repeat stay and are faults.  Null ids are one conversation.  A role is known by its first
    character; an empty one fits nowhere.  An empty table gives an empty result; further columns
    are ignored.  A conversation is put together like a document, so it has to fit in a task; the
    work on the automaton does not depend on how often a signature occurs."""
    ship(rows.sparkSession)
    if "rows" not in rows.columns:
        rows = rows.select("conv_id", F.array(F.struct("turn", "role", "text")).cast(ROWS).alias("rows"))
    gathered = rows.groupBy("conv_id").agg(F.sort_array(F.flatten(F.collect_list("rows"))).alias("rows"))
    kind = gathered.schema["conv_id"].dataType.simpleString()
    counts = ("gaps", "blank", "duplicate", "truncated", "illegal")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [signature([tuple(r.values()) for r in c]) for c in batch.column(1).to_pylist()]
            columns = list(zip(*found)) or [()] * 6
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(columns[0], pa.string()), *(pa.array(c, pa.int64()) for c in columns[1:])], ["conv_id", "rows", "signature", *counts]
            )

    known = keep(gathered.mapInArrow(read, f"conv_id {kind}, rows {ROWS}, signature string, " + ", ".join(f"{c} bigint" for c in counts)), "repair-signatures")
    answers = keep(solve_signatures(known.select("signature").distinct()), "repair-answers")
    # A signature may be that of most conversations.
    if fits_broadcast(answers):
        joined = known.join(F.broadcast(answers), "signature")
    else:
        joined = skew_join(known, answers, ["signature"], "inner", spread=["conv_id"], hot_rows=1_000)
    joined = joined.select("conv_id", *counts, "cost", "audit", "rows")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, edits = batch.column(8).to_pylist(), batch.column(7).to_pylist()
            repaired = [apply_edits([tuple(r.values()) for r in c], e) for c, e in zip(rows, edits)]
            kind = pa.list_(pa.struct([("role", pa.string()), ("text", pa.string())]))
            yield pa.RecordBatch.from_arrays([*batch.columns[:8], pa.array(repaired, kind)], [*batch.schema.names[:8], "repaired"])

    return joined.mapInArrow(write, f"conv_id {kind}, " + ", ".join(f"{c} bigint" for c in (*counts, "cost")) + ", audit string, repaired array<struct<role:string,text:string>>")
