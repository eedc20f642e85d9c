"""Distinct-key enrichment and extensions."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog.base import Tables, query
from fieldbook.operators import enrich, identification
from fieldbook.operators.joins import skew_join
from fieldbook.schema import DWC_NS, uri


@query(
    "enrich_distinct",
    """
    SELECT l_orderkey, l_linenumber, l_partkey, l_returnflag, coalesce(p_brand || ':' || p_type, 'none') AS label
    FROM lineitem LEFT JOIN part ON l_partkey = p_partkey AND l_returnflag <> 'N'
    """,
)
def enrich_distinct(t: Tables):
    part = t.part.select(F.col("p_partkey").alias("l_partkey"), F.concat_ws(":", "p_brand", "p_type").alias("label"))

    def resolve(keys):
        # A resolver that answers some keys only.
        return keys.filter("l_returnflag <> 'N'").join(part, "l_partkey").select(enrich.KEY, "label")

    return enrich.enrich_distinct(
        t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_returnflag"),
        ["l_partkey", "l_returnflag"],
        resolve,
        spread=["l_orderkey", "l_linenumber"],
        default={"label": F.lit("none")},
        resolver_partitions=8,
    )


@query(
    "skewed_key_join",
    """
    SELECT l_returnflag, l_linestatus, count(*) AS n, sum(cast(o AS bigint)) AS total
    FROM (SELECT l_returnflag, l_linestatus, CASE WHEN l_quantity > 20 THEN 0 ELSE l_partkey END AS k FROM lineitem)
    LEFT JOIN (SELECT p_partkey AS k, p_size AS o FROM part) USING (k) GROUP BY 1, 2
    """,
)
def skewed_key_join(t: Tables):
    # More than half of the rows share one key.
    l = t.lineitem.select(
        "l_returnflag", "l_linestatus", "l_orderkey", "l_linenumber",
        F.when(F.col("l_quantity") > 20, 0).otherwise(F.col("l_partkey")).alias("k"),
    )
    p = t.part.select(F.col("p_partkey").alias("k"), F.col("p_size").alias("o"))
    found = skew_join(l, p, ["k"], "left", spread=["l_orderkey", "l_linenumber"], hot_rows=5_000, buckets=16)
    return found.groupBy("l_returnflag", "l_linestatus").agg(F.count("*").alias("n"), F.sum("o").alias("total"))


@query(
    "distinct_keys",
    """
    SELECT o_orderpriority, o_orderstatus, count(*) AS n FROM
      (SELECT DISTINCT o_orderpriority, o_orderstatus, o_custkey FROM orders) GROUP BY 1, 2
    """,
)
def distinct_keys(t: Tables):
    d = enrich.distinct_keys(t.orders, ["o_orderpriority", "o_orderstatus", "o_custkey"])
    return d.groupBy("o_orderpriority", "o_orderstatus").agg(F.count("*").alias("n"))


_DATED = "CASE WHEN l_orderkey % 9 = 0 AND l_linenumber = 2 THEN 'undated' ELSE strftime(l_shipdate, '%Y-%m-%d') END"


def _order_records(t: Tables):
    """One record per order; its line items are identification rows, in line order."""
    date = F.when((F.col("l_orderkey") % 9 == 0) & (F.col("l_linenumber") == 2), "undated").otherwise(F.date_format("l_shipdate", "yyyy-MM-dd"))
    row = F.create_map(
        F.lit(uri("dateIdentified")), date,
        F.lit(uri("scientificName")), F.when(F.col("l_returnflag") == "R", " null").otherwise(F.concat(F.lit("Part "), F.col("l_partkey").cast("string"))),
        F.lit(uri("verbatimIdentification")), F.concat(F.lit("Supp "), F.col("l_suppkey").cast("string")),
        F.lit(uri("genus")), F.col("l_linestatus"),
    )
    # One group is the line items of one order.
    rows = t.lineitem.select("l_orderkey", F.struct("l_linenumber", "l_partkey", "l_suppkey", row.alias("m")).alias("r"))
    keyed = rows.select("l_orderkey", F.struct(F.col("r.l_linenumber").alias("a"), F.col("r.l_partkey").alias("b"), F.col("r.l_suppkey").alias("c")).alias("o"), F.col("r.m").alias("m"))
    lists = keyed.groupBy("l_orderkey").agg(F.collect_list(F.struct("o", F.map_entries("m").alias("m"))).alias("l"))
    ordered = F.transform(F.array_sort("l", lambda x, y: F.when(x["o"] < y["o"], -1).when(x["o"] > y["o"], 1).otherwise(0)), lambda e: F.map_from_entries(e["m"]))
    with_core = F.col("l_orderkey") % 10 == 0
    return lists.select(
        F.col("l_orderkey").cast("string").alias("id"),
        F.lit(None).cast("string").alias("coreId"),
        F.map_concat(
            F.create_map(F.lit(DWC_NS + "locality"), F.lit("x")),
            F.when(with_core, F.create_map(F.lit(uri("scientificName")), F.concat(F.lit("Core "), F.col("l_orderkey").cast("string")))).otherwise(
                F.create_map(F.lit(uri("genus")), F.lit("NULL"))
            ),
        ).alias("coreTerms"),
        F.create_map(F.lit(DWC_NS + "Identification"), ordered).alias("extensions"),
    )


@query(
    "latest_identification",
    f"""
    WITH l AS (SELECT *, {_DATED} AS dt FROM lineitem),
    g AS (SELECT l_orderkey, count(*) AS n, bool_or(dt = 'undated') AS undated FROM l GROUP BY 1),
    r AS (SELECT l.*, row_number() OVER (PARTITION BY l_orderkey ORDER BY dt DESC, l_linenumber, l_partkey, l_suppkey) AS rn FROM l),
    p AS (SELECT r.* FROM r JOIN g USING (l_orderkey) WHERE rn = 1 AND (n = 1 OR NOT undated)),
    o AS (SELECT l_orderkey AS k FROM g)
    SELECT cast(k AS varchar) AS id,
      CASE WHEN k % 10 = 0 THEN 'Core ' || k WHEN p.l_orderkey IS NULL THEN NULL WHEN l_returnflag = 'R' THEN 'Supp ' || l_suppkey ELSE 'Part ' || l_partkey END AS name,
      CASE WHEN k % 10 = 0 THEN NULL ELSE l_linestatus END AS genus
    FROM o LEFT JOIN p ON k = p.l_orderkey
    """,
)
def latest_identification(t: Tables):
    r = identification.extract_identification(_order_records(t))
    return r.select("id", F.col("scientificName").alias("name"), "genus")
