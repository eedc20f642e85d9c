"""Matching names against a backbone."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog.base import Tables, query
from fieldbook.operators import taxonomy
from fieldbook.operators.enrich import enrich_distinct
from fieldbook.schema import BACKBONE

#: The backbone of the fixture: part names as species, their first words as genera, one kingdom.
_BACKBONE_SQL = """
    sp AS (SELECT min(p_partkey) + 1000 AS key, p_name AS name, 'SPECIES' AS rank, string_split(p_name, ' ')[1] AS genus FROM part GROUP BY 2, 4),
    ge AS (SELECT min(p_partkey) + 2000000 AS key, string_split(p_name, ' ')[1] AS name, 'GENUS' AS rank, string_split(p_name, ' ')[1] AS genus FROM part GROUP BY 2, 4),
    ki AS (SELECT min(p_partkey) + 1 AS key, 'Parta' AS name, 'KINGDOM' AS rank, NULL AS genus FROM part),
    bb AS (SELECT * FROM sp UNION ALL SELECT * FROM ge UNION ALL SELECT * FROM ki)
"""


def complete(df):
    """Fill the backbone columns that a fixture leaves out."""
    have = set(df.columns)
    return df.select(*[(F.col(f.name) if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name) for f in BACKBONE])


def backbone(t: Tables):
    genus = F.substring_index("p_name", " ", 1)
    own = F.struct(F.col("key").cast("int").alias("key"), "name", "rank")
    top = F.struct(F.lit(1).alias("key"), F.lit("Parta").alias("name"), F.lit("KINGDOM").alias("rank"))
    sp = t.part.groupBy(F.col("p_name").alias("name"), genus.alias("genus")).agg((F.min("p_partkey") + 1000).alias("key")).withColumn("rank", F.lit("SPECIES"))
    ge = t.part.groupBy(genus.alias("name")).agg((F.min("p_partkey") + 2000000).alias("key")).select("name", F.col("name").alias("genus"), "key", F.lit("GENUS").alias("rank"))
    ki = t.part.agg((F.min("p_partkey") + 1).alias("key")).select(F.lit("Parta").alias("name"), F.lit(None).cast("string").alias("genus"), "key", F.lit("KINGDOM").alias("rank"))
    rows = sp.select("name", "genus", "key", "rank").unionByName(ge).unionByName(ki)
    status = F.when((F.col("rank") == "SPECIES") & (F.col("key") % 3 == 0), "SYNONYM").otherwise("ACCEPTED")
    return complete(
        rows.select(
            "key", "name", "rank", "genus", F.lit("Parta").alias("kingdom"), status.alias("status"),
            F.when(status == "SYNONYM", F.lit(1)).alias("accepted_key"), F.array(top, own).alias("classification"),
        )
    )


#: A name in six states, for both engines; ``g`` is the genus and ``sp`` the epithet.
_STATE = "p_partkey % 6"


@query(
    "match_taxa",
    f"""
    WITH {_BACKBONE_SQL},
    q AS (SELECT p_partkey, {_STATE} AS k, string_split(p_name, ' ')[1] AS g, p_name AS n FROM part),
    s AS (SELECT p_partkey, k, CASE k WHEN 0 THEN n WHEN 1 THEN n[1:1] || n[3:] WHEN 2 THEN n[1:1] || n[3:] WHEN 3 THEN g || ' zzzzzzz' WHEN 4 THEN 'qqqqqqqq zzzzzzz' ELSE n END AS v,
             CASE WHEN k = 3 THEN g WHEN k = 5 THEN g END AS genus, CASE WHEN k IN (1, 3, 4) THEN 'parta' END AS kingdom FROM q),
    d AS (SELECT s.*, bb.key, bb.name, bb.rank, levenshtein(s.v, lower(bb.name)) AS d, lower(bb.name) = s.genus AND bb.rank = 'GENUS' AS by_genus, lower(bb.name) = s.kingdom AND bb.rank = 'KINGDOM' AS by_kingdom,
             (CASE WHEN s.kingdom = 'parta' THEN 2 ELSE 0 END) + (CASE WHEN s.genus = bb.genus THEN 2 WHEN s.genus <> bb.genus THEN -3 ELSE 0 END) + (CASE WHEN bb.rank = 'SPECIES' AND bb.key % 3 = 0 THEN 0 ELSE 1 END) AS points FROM s, bb),
    n AS (SELECT *, CASE WHEN d = 0 THEN 90 ELSE 84 - 8 * d END + points AS score, CASE WHEN d = 0 THEN 'ex' WHEN d <= 1 AND kingdom IS NOT NULL THEN 'fu' END AS step FROM d),
    b AS (SELECT p_partkey, step, CASE WHEN max(score) FILTER (place = 2) = max(score) THEN NULL ELSE max(key) FILTER (place = 1) END AS key
          FROM (SELECT *, row_number() OVER (PARTITION BY p_partkey, step ORDER BY score DESC, key) AS place FROM n WHERE step IS NOT NULL) WHERE place <= 2 GROUP BY 1, 2),
    a AS (SELECT p_partkey, (SELECT b.key FROM b WHERE b.p_partkey = d.p_partkey AND step = 'ex') AS ex, (SELECT b.key FROM b WHERE b.p_partkey = d.p_partkey AND step = 'fu') AS fu,
             min(key) FILTER (by_genus) AS hg, min(key) FILTER (by_kingdom) AS hk FROM d GROUP BY 1)
    SELECT p_partkey, coalesce(ex, fu, hg, hk, 0) AS key, CASE WHEN ex IS NOT NULL THEN 'EXACT' WHEN fu IS NOT NULL THEN 'FUZZY' WHEN hg IS NOT NULL OR hk IS NOT NULL THEN 'HIGHERRANK' END AS match,
      CASE WHEN ex IS NOT NULL THEN '' WHEN fu IS NOT NULL THEN 'TAXON_MATCH_FUZZY' WHEN hg IS NOT NULL OR hk IS NOT NULL THEN 'TAXON_MATCH_HIGHERRANK' ELSE 'TAXON_MATCH_NONE' END AS issues,
      CASE WHEN coalesce(ex, fu, hg, hk) IS NULL THEN NULL WHEN bb.rank = 'SPECIES' AND bb.key % 3 = 0 THEN 1 ELSE bb.key END AS accepted
    FROM a LEFT JOIN bb ON bb.key = coalesce(ex, fu, hg, hk)
    """,
)
def match_taxa(t: Tables):
    k, name = F.expr(_STATE), F.col("p_name")
    genus = F.substring_index(name, " ", 1)
    typo = F.concat(F.substring(name, 1, 1), F.substring(name, 3, 99))
    spelled = (
        F.when(k == 0, F.concat(F.lit(" "), F.upper(F.replace(name, F.lit(" "), F.lit("  ")))))
        .when(k.isin(1, 2), typo)
        .when(k == 3, F.concat(genus, F.lit(" zzzzzzz")))
        .when(k == 4, "qqqqqqqq zzzzzzz")
    )
    nothing = F.lit(None).cast("string")
    cols = {
        "kingdom": F.when(k.isin(1, 3, 4), "parta"), "phylum": nothing, "clazz": nothing, "order": nothing, "family": nothing,
        "genus": F.when(k.isin(3, 5), genus), "scientificName": spelled, "genericName": nothing,
        "specificEpithet": F.when(k == 5, F.substring_index(name, " ", -1)), "infraspecificEpithet": nothing,
    }
    p = t.part.select("p_partkey", *[c.alias(n) for n, c in cols.items()])
    names = backbone(t)
    found = enrich_distinct(p, list(cols), lambda keys: taxonomy.match_taxa(keys, names), keep=["p_partkey"], spread=["p_partkey"])
    return found.select(
        "p_partkey", F.col("usage.key").cast("bigint").alias("key"), F.col("diagnostics.matchType").alias("match"),
        F.array_join("issues", "|").alias("issues"), F.col("acceptedUsage.key").cast("bigint").alias("accepted"),
    )


#: Homonyms of every part name: two animals by other authors, a plant, and a subspecies.  A query gives
#: what may tell them apart; author and year are numbers of the part.
_HOMONYMS = """
    src AS (SELECT p_name AS name, min(p_partkey) AS n FROM part GROUP BY 1),
    bb AS (SELECT n * 10 + 1 AS key, name, 'Lin, ' || (1800 + n % 100) AS author, 1800 + n % 100 AS year, 'lin' AS who, 'SPECIES' AS rank, 'animalia' AS kingdom, 1 AS acc FROM src
           UNION ALL SELECT n * 10 + 2, name, 'Mu', NULL, 'mu', 'SPECIES', 'animalia', CASE WHEN n % 2 = 0 THEN 1 ELSE 0 END FROM src
           UNION ALL SELECT n * 10 + 3, name, 'Mu', NULL, 'mu', 'SPECIES', 'plantae', 1 FROM src
           UNION ALL SELECT n * 10 + 4, name, NULL, NULL, NULL, 'SUBSPECIES', 'plantae', 1 FROM src)
"""


@query(
    "match_homonyms",
    f"""
    WITH {_HOMONYMS},
    q AS (SELECT p_partkey, p_name AS name, CASE WHEN p_partkey % 3 = 0 THEN 'animalia' WHEN p_partkey % 3 = 1 THEN 'plantae' END AS kingdom,
            CASE p_partkey % 5 WHEN 0 THEN 'linnaeus' WHEN 1 THEN 'mu' WHEN 2 THEN 'zu' END AS who, CASE WHEN p_partkey % 5 = 0 THEN 1800 + p_partkey % 100 END AS year, CASE p_partkey % 4 WHEN 0 THEN 'SPECIES' WHEN 1 THEN 'SUBSPECIES' END AS rank FROM part),
    c AS (SELECT p_partkey, key, 90 + CASE WHEN q.kingdom = bb.kingdom THEN 2 WHEN q.kingdom <> bb.kingdom THEN -40 ELSE 0 END + CASE WHEN q.rank = bb.rank THEN 4 WHEN q.rank <> bb.rank THEN -8 ELSE 0 END
             + CASE WHEN q.who IS NULL OR bb.who IS NULL THEN 0 WHEN starts_with(q.who, bb.who) OR starts_with(bb.who, q.who) THEN 4 ELSE -6 END
             + CASE WHEN q.year = bb.year THEN 2 WHEN abs(q.year - bb.year) > 2 THEN -2 ELSE 0 END + acc AS score FROM q JOIN bb USING (name)),
    o AS (SELECT *, row_number() OVER (PARTITION BY p_partkey ORDER BY score DESC, key) AS place FROM c),
    b AS (SELECT p_partkey, max(key) FILTER (place = 1) AS key, max(score) AS score, max(score) - max(score) FILTER (place = 2) AS margin FROM o WHERE place <= 2 GROUP BY 1)
    SELECT p_partkey, CASE WHEN margin > 0 AND score >= 55 THEN key ELSE 0 END AS key, CASE WHEN margin > 0 AND score >= 55 THEN least(100, score) - greatest(0, 10 - margin) END AS confidence,
      CASE WHEN margin > 0 AND score >= 55 THEN 'score ' || score || '; next best ' || (score - margin) END AS note
    FROM b
    """,
)
def match_homonyms(t: Tables):
    src = t.part.groupBy(F.col("p_name").alias("name")).agg(F.min("p_partkey").alias("n"))
    made = F.explode(
        F.array(
            *[
                F.struct(
                    (F.col("n") * 10 + k).alias("key"), author.alias("authorship"), F.lit(rank).alias("rank"), F.lit(kingdom).alias("kingdom"), F.when(accepted, "ACCEPTED").otherwise("SYNONYM").alias("status")
                )
                for k, author, rank, kingdom, accepted in (
                    (1, F.concat(F.lit("Lin, "), (F.col("n") % 100 + 1800).cast("string")), "SPECIES", "Animalia", F.lit(True)),
                    (2, F.lit("Mu"), "SPECIES", "Animalia", F.col("n") % 2 == 0),
                    (3, F.lit("Mu"), "SPECIES", "Plantae", F.lit(True)),
                    (4, F.lit(None).cast("string"), "SUBSPECIES", "Plantae", F.lit(True)),
                )
            ]
        )
    )
    rows = src.select("name", made.alias("b")).select("name", "b.*")
    own = F.array(F.struct(F.col("key").cast("int").alias("key"), "name", "rank"))
    names = complete(rows.withColumn("classification", own))
    k = F.col("p_partkey")
    nothing = F.lit(None).cast("string")
    author = F.when(k % 5 == 0, F.concat(F.lit("(Linnaeus, "), (k % 100 + 1800).cast("string"), F.lit(")"))).when(k % 5 == 1, "Mu").when(k % 5 == 2, "Zu")
    cols = {
        "kingdom": F.when(k % 3 == 0, "Animalia").when(k % 3 == 1, "plantae"), "phylum": nothing, "clazz": nothing, "order": nothing, "family": nothing, "genus": nothing,
        "scientificName": F.col("p_name"), "genericName": nothing, "specificEpithet": nothing, "infraspecificEpithet": nothing,
        "scientificNameAuthorship": author, "rank": F.when(k % 4 == 0, "species").when(k % 4 == 1, "SUBSPECIES"),
    }
    p = t.part.select("p_partkey", *[c.alias(n) for n, c in cols.items()])
    found = enrich_distinct(p, list(cols), lambda keys: taxonomy.match_taxa(keys, names), keep=["p_partkey"], spread=["p_partkey"])
    return found.select("p_partkey", F.col("usage.key").cast("bigint").alias("key"), "diagnostics.confidence", "diagnostics.note")
