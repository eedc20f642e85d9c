"""The registered queries of operators 11 to 13, with their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .queries import query, table


def _grid_codes_sql(parts: int = 8, entries: int = 16, rounds: int = 6, scale: int = 4096) -> str:
    """The rounds one after the other; every part is compared with every entry."""
    far = "list_sum(list_transform(list_zip(part.v, c.v), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::BIGINT"
    steps = [
        f"""kept AS MATERIALIZED (SELECT row_number() OVER (ORDER BY vec_id, embedding) AS r, vec_id, label, list_transform(embedding, lambda x: CAST(floor({scale} * CAST(x AS DOUBLE)) AS BIGINT)) AS v
            FROM embeddings WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0)""",
        f"part AS MATERIALIZED (SELECT r, p, v[p * len(v) // {parts} + 1 : (p + 1) * len(v) // {parts}] AS v FROM kept, range({parts}) AS t(p))",
        f"c0 AS MATERIALIZED (SELECT p, r - 1 AS e, v FROM part WHERE r <= {entries})",
    ]
    for k in range(rounds + 1):
        steps.append(f"a{k} AS MATERIALIZED (SELECT r, p, arg_min(e, (d, e)) AS e, min(d) AS d FROM (SELECT r, part.p, e, {far} AS d FROM part JOIN c{k} c ON part.p = c.p) GROUP BY r, p)")
        if k < rounds:
            steps.append(
                f"""n{k} AS MATERIALIZED (SELECT p, e, list(((s - ((s % n) + n) % n) // n)::BIGINT ORDER BY i) AS v
                FROM (SELECT p, e, i, sum(x) AS s, count(*) AS n FROM (SELECT a.p, a.e, unnest(part.v) AS x, unnest(range(1, len(part.v) + 1)) AS i FROM a{k} a JOIN part USING (r, p)) GROUP BY p, e, i) GROUP BY p, e)"""
            )
            steps.append(f"c{k + 1} AS MATERIALIZED (SELECT c.p, c.e, coalesce(n.v, c.v) AS v FROM c{k} c LEFT JOIN n{k} n USING (p, e))")
    return f"""
        WITH {", ".join(steps)},
        digest AS (SELECT sha256(string_agg(array_to_string(v, ','), ',' ORDER BY p, e)) AS s FROM c{rounds}),
        coded AS (SELECT r, string_agg(printf('%02x', e), '' ORDER BY p) AS code, sum(d) AS error FROM a{rounds} GROUP BY r)
        SELECT vec_id, code, error::BIGINT AS error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error, s AS codebooks_sha256 FROM coded JOIN kept USING (r), digest
    """


@query("op13_vector_codes", _grid_codes_sql())
def op13_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .grid_codes import compress, hex_code

    return compress(table(spark, sf_dir, "embeddings")).withColumn("code", hex_code(F.col("code")))


def _repair_sql() -> str:
    """The repair of every conversation for itself, from its last row to its first: per grammar
    state the cheapest edits ``c``, their initials ``a`` and the repaired lines ``t``."""
    crc = "list_reduce(list_prepend(4294967295, list_transform(string_split(s, ''), lambda ch: ascii(ch)::BIGINT)), lambda c, b: xor(c >> 8, crc[(xor(c, b) & 255) + 1]))"
    then = {0: (2, "user:"), 1: (2, "user:"), 2: (3, "assistant:"), 3: (2, "user:")}
    kept = {"s": {0: 1}, "u": {0: 2, 1: 2, 3: 2}, "a": {2: 3}}
    states = []
    for q in range(4):
        options, at, lines = [], q, []
        for n in range(3):
            new = "[" + ", ".join(f"'{x}'" for x in lines) + "]::VARCHAR[]"

            def option(edit, cost, to, line, when, n=n, new=new):
                own = f"list_concat({new}, [{line}])" if line else new
                return f"CASE WHEN {when} THEN {{'c': s{to}.c + {3 * n} + {cost}, 'a': '{'I' * n + edit}' || s{to}.a, 't': list_concat({own}, s{to}.t)}} END"

            to, role = then[at]
            options.append(option("D", "4", at, None, "true"))
            options.append(option("R", "3 + extra", to, f"'{role}' || text", "NOT gone"))
            options += [option("K", "extra", after[at], "role || ':' || text", f"NOT gone AND ini = '{i}'") for i, after in kept.items() if at in after]
            at, lines = to, [*lines, role]
        states.append(f"list_sort(list_filter([{', '.join(options)}], lambda o: o IS NOT NULL))[1] AS s{q}")
    end = ["{'c': 0::BIGINT, 'a': '', 't': []::VARCHAR[]}", "{'c': 6::BIGINT, 'a': 'II', 't': ['user:', 'assistant:']}", "{'c': 3::BIGINT, 'a': 'I', 't': ['assistant:']}", "{'c': 0::BIGINT, 'a': '', 't': []::VARCHAR[]}"]
    return f"""
        WITH RECURSIVE poly AS (SELECT list_transform(range(256), lambda i: list_reduce(list_prepend(i, range(8)), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS crc),
        src AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS s FROM conversations),
        hit AS (SELECT conv_id, turn, role, text, xor({crc}, 4294967295) % 20 AS k FROM src, poly),
        dam AS (SELECT conv_id, turn, CASE WHEN k = 4 THEN 'user' ELSE role END AS role, CASE k WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
            unnest(range(CASE k WHEN 0 THEN 0 WHEN 3 THEN 2 ELSE 1 END)) AS copy FROM hit),
        num AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy) AS i, left(role, 1) AS ini FROM dam),
        flt AS MATERIALIZED (SELECT *, NOT regexp_matches(text, '[^\\x20\\x09-\\x0D]') AS blank, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 AS again,
            NOT regexp_matches(text, '[.!?][\\x20\\x09-\\x0D]*$') AS cut, lag(ini) OVER (PARTITION BY conv_id ORDER BY i) || ini AS pair FROM num),
        row_ AS MATERIALIZED (SELECT conv_id, i, role, text, ini, blank OR again AS gone, CASE WHEN cut THEN 3 ELSE 0 END AS extra FROM flt),
        per AS (SELECT conv_id, count(*) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (blank) AS blank, count(*) FILTER (again AND NOT blank) AS duplicate,
            count(*) FILTER (cut AND NOT blank AND NOT again) AS truncated, count(*) FILTER (pair NOT IN ('su', 'ua', 'au')) AS illegal FROM flt GROUP BY 1),
        rec AS (SELECT conv_id, n + 1 AS i, {", ".join(f"{e} AS s{q}" for q, e in enumerate(end))} FROM per
            UNION ALL SELECT rec.conv_id, row_.i, {", ".join(states)} FROM rec JOIN row_ ON row_.i = rec.i - 1 AND row_.conv_id IS NOT DISTINCT FROM rec.conv_id)
        SELECT ids.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal,
            coalesce(s0.c, 0) AS cost, coalesce(s0.a, '') AS audit, sha256(coalesce(array_to_string(s0.t, chr(10)), '')) AS repaired_sha256
        FROM (SELECT DISTINCT conv_id FROM conversations) ids LEFT JOIN per ON per.conv_id IS NOT DISTINCT FROM ids.conv_id
            LEFT JOIN (SELECT * FROM rec WHERE i = 1) first_ ON first_.conv_id IS NOT DISTINCT FROM ids.conv_id
    """


@query("op11_conversation_repair", _repair_sql())
def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .repair import damaged, repair, rows_of

    lines = F.transform("repaired", lambda r: F.concat(r["role"], F.lit(":"), r["text"]))
    found = repair(damaged(rows_of(table(spark, sf_dir, "conversations"))))
    return found.select("conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", F.sha2(F.array_join(lines, "\n"), 256).alias("repaired_sha256"))


@query("op12_main_text")
def op12_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .site_template import extract

    return extract(table(spark, sf_dir, "pages"))
