"""Terms, values, numbers and text."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog.base import ORACLES, Tables, joined, query, vocabulary, vocabulary_sql
from fieldbook.functions import issues, numbers, status, terms, text
from fieldbook.operators import lookup, records
from fieldbook.schema import DWC_NS


# --- P1-P4, P6-P8, P14 ------------------------------------------------------------------------------

_RAW_SEGMENT = "case when c_custkey % 7 = 0 then ' NULL ' when c_custkey % 7 = 1 then '' when c_custkey % 7 = 2 then ' ' || c_mktsegment || ' ' else c_mktsegment end"


def _customers(t: Tables):
    raw = F.expr(_RAW_SEGMENT)
    return t.customer.select(
        F.col("c_custkey").cast("string").alias("id"),
        F.lit(None).cast("string").alias("coreId"),
        F.create_map(
            F.lit(DWC_NS + "locality"), raw,
            F.lit(DWC_NS + "parentEventID"), F.col("c_nationkey").cast("string"),
        ).alias("coreTerms"),
        F.when(F.col("c_custkey") % 3 == 0, F.create_map(F.lit(DWC_NS + "Occurrence"), F.array(F.create_map(F.lit("k"), F.lit("v"))))).alias("extensions"),
    )


@query(
    "null_aware_terms",
    f"""
    SELECT cast(c_custkey AS varchar) AS id, {_RAW_SEGMENT} AS raw, trim({_RAW_SEGMENT}) AS trimmed,
           CASE WHEN trim({_RAW_SEGMENT}) <> '' AND lower(trim({_RAW_SEGMENT})) <> 'null' THEN trim({_RAW_SEGMENT}) END AS clean,
           CASE WHEN {_RAW_SEGMENT} <> '' AND lower(trim({_RAW_SEGMENT})) <> 'null' THEN {_RAW_SEGMENT} END AS raw_clean,
           CASE WHEN strlen(c_mktsegment) < 9 THEN c_mktsegment END AS bounded,
           c_custkey % 3 = 0 AS has_rows,
           CASE WHEN trim({_RAW_SEGMENT}) <> '' AND lower(trim({_RAW_SEGMENT})) <> 'null' THEN true ELSE false END AS has_clean
    FROM customer
    """,
)
def null_aware_terms(t: Tables):
    return _customers(t).join(
        t.customer.select(F.col("c_custkey").cast("string").alias("id"), "c_mktsegment"), "id"
    ).select(
        "id",
        terms.raw_term("locality").alias("raw"),
        terms.term("locality").alias("trimmed"),
        terms.clean_term("locality").alias("clean"),
        terms.clean(terms.raw_term("locality")).alias("raw_clean"),
        terms.bounded(F.col("c_mktsegment"), 9).alias("bounded"),
        terms.has_extension("Occurrence").alias("has_rows"),
        terms.has_clean_term("locality").alias("has_clean"),
    )


@query(
    "valid_and_rejected",
    """
    SELECT CASE WHEN c_custkey % 5 = 0 THEN '' ELSE cast(c_custkey AS varchar) END AS id,
           CASE WHEN c_custkey % 5 = 0 THEN 'ID_MISSING' WHEN c_custkey % 4 = 0 THEN 'CORE_TERMS_MISSING' END AS reason,
           count(*) AS n
    FROM customer
    WHERE NOT (c_custkey % 2 = 0 AND c_nationkey = 3 AND c_custkey % 5 <> 0 AND c_custkey % 4 <> 0)
    GROUP BY 1, 2
    """,
)
def valid_and_rejected(t: Tables):
    key = F.col("c_custkey")
    raw = t.customer.select(
        F.when(key % 5 == 0, "").otherwise(key.cast("string")).alias("id"),
        F.when(key % 4 != 0, F.create_map(F.lit(DWC_NS + "country"), F.col("c_nationkey").cast("string")))
        .otherwise(F.expr("cast(map() as map<string,string>)")).alias("coreTerms"),
        key, "c_nationkey",
    )
    valid, rejected = records.split_valid(raw)
    # Skipping after interpretation: rows for which every predicate holds.
    kept = records.skip_when(records.with_terms(valid), key % 2 == 0, F.col("c_nationkey") == 3)
    return (
        kept.select("id", F.lit(None).cast("string").alias("reason"))
        .unionByName(rejected.select("id", "reason"))
        .groupBy("id", "reason")
        .agg(F.count("*").alias("n"))
    )


@query(
    "repeated_ids",
    """
    WITH r AS (SELECT cast(l_orderkey AS varchar) AS id, l_linenumber AS line FROM lineitem WHERE l_linenumber IS NOT NULL),
    n AS (SELECT id, count(*) AS n FROM r GROUP BY 1)
    SELECT id, line, CASE WHEN n > 1 THEN 'ID_REPEATED' END AS reason FROM r JOIN n USING (id)
    """,
)
def repeated_ids(t: Tables):
    rows = t.lineitem.select(F.col("l_orderkey").cast("string").alias("id"), F.col("l_linenumber").alias("line"))
    once, repeated = records.split_repeated(rows)
    return once.withColumn("reason", F.lit(None).cast("string")).unionByName(repeated)


# --- P5, B9, B10, A7 -----------------------------------------------------------------------------------


@query(
    "split_values",
    r"""
    WITH s AS (SELECT p_partkey, replace(p_name, ' ', ' | | ') || CASE WHEN p_partkey % 3 = 0 THEN ';' || p_brand ELSE '' END AS v FROM part),
    p AS (SELECT p_partkey,
            list_filter(list_transform(string_split(v, '|'), lambda x: trim(x)), lambda x: x <> '') AS narrow,
            list_filter(list_transform(string_split_regex(v, '[|;]'), lambda x: trim(x)), lambda x: x <> '') AS wide FROM s)
    SELECT p_partkey, array_to_string(narrow, '|') AS narrow, array_to_string(wide, '|') AS wide,
           array_to_string(list_sort(list_distinct(wide)), '|') AS as_set, len(wide) AS n
    FROM p
    """,
)
def split_values(t: Tables):
    v = F.concat(F.replace("p_name", F.lit(" "), F.lit(" | | ")), F.when(F.col("p_partkey") % 3 == 0, F.concat(F.lit(";"), "p_brand")).otherwise(""))
    p = t.part.select(
        "p_partkey", terms.split_values(v).alias("narrow"), terms.split_values(v, terms.PIPE_OR_SEMICOLON).alias("wide")
    )
    return p.select(
        "p_partkey",
        joined(F.col("narrow")).alias("narrow"),
        joined(F.col("wide")).alias("wide"),
        joined(terms.value_set(F.col("wide"))).alias("as_set"),
        F.size("wide").cast("bigint").alias("n"),
    )


# --- P15, A5, A6 ------------------------------------------------------------------------------------------


@query(
    "issue_lists",
    """
    SELECT l_orderkey, l_linenumber,
           concat_ws('|', CASE WHEN l_quantity > 25 THEN 'LARGE' END, CASE WHEN l_discount = 0 THEN 'ZERO_COORDINATE' END,
                     CASE WHEN l_tax = 0 AND NOT l_quantity > 25 THEN 'LARGE' END) AS issues,
           concat_ws('|', CASE WHEN l_quantity > 25 OR l_tax = 0 THEN 'LARGE' END, CASE WHEN l_returnflag = 'R' THEN 'RETURNED' END,
                     CASE WHEN l_discount = 0 THEN 'ZERO_COORDINATE' END) AS pooled,
           coalesce(l_discount = 0, false) AS geospatial
    FROM lineitem
    """,
)
def issue_lists(t: Tables):
    own = issues.collect_issues(
        issues.flag(F.col("l_quantity") > 25, "LARGE"),
        issues.flag(F.col("l_discount") == 0, "ZERO_COORDINATE"),
        issues.flag(F.col("l_tax") == 0, "LARGE"),
    )
    other = issues.collect_issues(issues.flag(F.col("l_returnflag") == "R", "RETURNED"))
    return t.lineitem.select("l_orderkey", "l_linenumber", own.alias("own"), other.alias("other")).select(
        "l_orderkey",
        "l_linenumber",
        joined(F.col("own")).alias("issues"),
        joined(issues.union_issues(F.col("own"), F.col("other"))).alias("pooled"),
        issues.has_geospatial_issue(F.col("own")).alias("geospatial"),
    )


# --- B1, B2, B5-B7 ------------------------------------------------------------------------------------------

_COUNT_TEXT = (
    "case when event_id % 11 = 0 then 'many' when event_id % 13 = 0 then '-3' when event_id % 17 = 0 then '99999999999'"
    " when event_id % 19 = 0 then null else cast(cast(floor(value) as bigint) as {s}) end"
)


@query(
    "count_rules",
    f"""
    WITH s AS (SELECT event_id, {_COUNT_TEXT.format(s="varchar")} AS v FROM events)
    SELECT event_id, v AS given,
           CASE WHEN regexp_full_match(v, '[0-9]{{1,10}}') THEN try_cast(v AS integer) END AS n,
           CASE WHEN v IS NOT NULL AND (NOT regexp_full_match(v, '[0-9]{{1,10}}') OR try_cast(v AS integer) IS NULL) THEN 'INDIVIDUAL_COUNT_INVALID' END AS issue,
           CASE WHEN regexp_full_match(v, '-?[0-9]{{1,10}}') THEN try_cast(v AS integer) END AS signed
    FROM s
    """,
)
def count_rules(t: Tables):
    v = F.expr(_COUNT_TEXT.format(s="string"))
    return t.events.select("event_id", v.alias("given")).select(
        "event_id", "given",
        numbers.parse_count(F.col("given"))["value"].alias("n"),
        numbers.parse_count(F.col("given"))["issue"].alias("issue"),
        numbers.parse_int(F.col("given")).alias("signed"),
    )


_QUANTITY = "case when l_linenumber = 5 then 'NaN' when l_linenumber = 6 then replace(cast(l_quantity as {s}), '.', ',') else ' ' || cast(l_quantity as {s}) end"
_SIZE = "case when l_orderkey % 10 = 0 then '0' else cast(l_linenumber as {s}) end"


@query(
    "quantity_rules",
    f"""
    WITH s AS (SELECT l_orderkey, l_linenumber, l_partkey, l_quantity, CASE WHEN l_linenumber = 5 THEN NULL ELSE l_quantity END AS q,
                      CASE WHEN l_orderkey % 10 = 0 THEN 0.0 ELSE cast(l_linenumber AS double) END AS n,
                      CASE WHEN l_returnflag = 'R' THEN 'Grams' ELSE 'grams' END AS unit, CASE WHEN l_linestatus = 'F' THEN 'GRAMS' ELSE 'metres' END AS kind FROM lineitem)
    SELECT l_orderkey, l_linenumber, l_partkey, q AS quantity, n AS size,
           CASE WHEN lower(kind) = lower(unit) AND n <> 0 THEN q / n END AS relative
    FROM s
    """,
)
def quantity_rules(t: Tables):
    parsed = t.lineitem.select(
        "l_orderkey", "l_linenumber", "l_partkey",
        numbers.finite_double(F.expr(_QUANTITY.format(s="string"))).alias("quantity"),
        numbers.finite_double(F.expr(_SIZE.format(s="string"))).alias("size"),
        F.when(F.col("l_returnflag") == "R", "Grams").otherwise("grams").alias("unit"),
        F.when(F.col("l_linestatus") == "F", "GRAMS").otherwise("metres").alias("kind"),
    )
    return parsed.select(
        "l_orderkey", "l_linenumber", "l_partkey", "quantity", "size",
        numbers.relative_quantity(F.col("quantity"), F.col("kind"), F.col("size"), F.col("unit")).alias("relative"),
    )


# --- L9-L13 ---------------------------------------------------------------------------------------------------


@query(
    "metre_rules",
    """
    WITH s AS (SELECT p_partkey, p_size, CASE WHEN p_partkey % 4 = 0 THEN floor(p_size * 0.3048 * 100 + 0.5) / 100
                 WHEN p_partkey % 4 = 1 THEN p_size * 1000.0 WHEN p_partkey % 4 = 2 THEN cast(p_size AS double) END AS lo,
               p_retailprice AS hi FROM part)
    SELECT p_partkey, lo AS low, hi AS high,
           CASE WHEN (coalesce(lo, hi) + hi) / 2 BETWEEN -11000 AND 17000 THEN (coalesce(lo, hi) + hi) / 2 END AS midpoint,
           CASE WHEN (coalesce(lo, hi) + hi) / 2 BETWEEN -11000 AND 17000 THEN abs(hi - coalesce(lo, hi)) / 2 END AS accuracy,
           CASE WHEN (coalesce(lo, hi) + hi) / 2 BETWEEN -11000 AND 17000 THEN concat_ws('|', CASE WHEN lo > hi THEN 'ELEVATION_MIN_MAX_SWAPPED' END,
             CASE WHEN p_partkey % 4 = 0 THEN 'ELEVATION_NOT_METRIC' END, CASE WHEN lo IS NULL THEN 'ELEVATION_NON_NUMERIC' END) END AS issues,
           CASE WHEN lo > 0 AND lo < 20037509 THEN lo END AS uncertainty,
           CASE WHEN lo > 0 AND lo < 20037509 THEN NULL ELSE 'COORDINATE_UNCERTAINTY_METERS_INVALID' END AS uncertainty_issue,
           CASE WHEN p_size / 40.0 BETWEEN 0 AND 1 THEN p_size / 40.0 END AS precision,
           CASE WHEN p_size / 40.0 BETWEEN 0 AND 1 THEN NULL ELSE 'COORDINATE_PRECISION_INVALID' END AS precision_issue
    FROM s
    """,
)
def metre_rules(t: Tables):
    k, n = F.col("p_partkey") % 4, F.col("p_size").cast("string")
    low = F.when(k == 0, F.concat(n, F.lit(" ft"))).when(k == 1, F.concat(F.lit("ca. "), n, F.lit("km"))).when(k == 2, n).otherwise("unknown")
    high = F.concat(F.col("p_retailprice").cast("string"), F.lit(" m"))
    p = t.part.select(
        "p_partkey", low.alias("l"), high.alias("h"), (F.col("p_size") / 40.0).cast("string").alias("p")
    ).select(
        "p_partkey",
        numbers.parse_metres(F.col("l")).alias("low"),
        numbers.parse_metres(F.col("h")).alias("high"),
        numbers.range_midpoint(F.col("l"), F.col("h"), "ELEVATION").alias("r"),
        numbers.uncertainty(F.when(F.col("l").startswith("-"), F.col("l")).otherwise(F.concat(F.lit("-"), F.regexp_replace("l", "^ca. ", "")))).alias("u"),
        numbers.precision(F.col("p")).alias("p"),
    )
    return p.select(
        "p_partkey", "low", "high",
        F.col("r.value").alias("midpoint"), F.col("r.accuracy").alias("accuracy"), joined(F.col("r.issues")).alias("issues"),
        F.col("u.value").alias("uncertainty"), F.col("u.issue").alias("uncertainty_issue"),
        F.col("p.value").alias("precision"), F.col("p.issue").alias("precision_issue"),
    )


@query(
    "clean_names",
    r"""
    WITH s AS (SELECT p_partkey, CASE WHEN p_partkey % 2 = 0 THEN upper(p_name) ELSE p_name END AS v,
                      '  ' || CASE WHEN p_partkey % 2 = 0 THEN upper(p_name) ELSE p_name END || '   ' || CASE WHEN p_partkey % 3 = 0 THEN '7' ELSE 'NORTH' END AS w FROM part),
    c AS (SELECT p_partkey, trim(regexp_replace(w, '\s+', ' ', 'g')) AS v FROM s)
    SELECT p_partkey, CASE WHEN regexp_full_match(replace(v, ' ', ''), '[A-Z]+') THEN upper(v[1]) || lower(v[2:]) ELSE v END AS name FROM c
    """,
)
def clean_names(t: Tables):
    base = F.when(F.col("p_partkey") % 2 == 0, F.upper("p_name")).otherwise(F.col("p_name"))
    w = F.concat(F.lit("  "), base, F.lit("   "), F.when(F.col("p_partkey") % 3 == 0, "7").otherwise("NORTH"))
    return t.part.select("p_partkey", text.clean_name(w).alias("name"))


# --- B4, B8, B12, B13 ---------------------------------------------------------------------------------------------


@query(
    "typified_names",
    """
    SELECT p_partkey, CASE WHEN p_partkey % 3 = 0 THEN 'Given name' WHEN p_partkey % 3 = 1 THEN 'Abies ' || lower(p_type) || ' Mill.' END AS name
    FROM part
    """,
)
def typified_names(t: Tables):
    k = F.col("p_partkey") % 3
    name = F.when(k == 0, "Given name")
    stated = F.when(k == 1, F.concat(F.lit("Holotype of Abies "), F.lower("p_type"), F.lit(" Mill."))).otherwise("holotype")
    return t.part.select("p_partkey", text.typified_name(name, stated).alias("name"))


_ORCID_SQL = "lpad(cast(c_custkey % 10000 as {s}), 4, '0') || '-' || lpad(cast(c_nationkey as {s}), 4, '0') || '-0000-000x'"


@query(
    "agent_ids",
    f"""
    WITH s AS (SELECT c_custkey, upper({_ORCID_SQL.format(s="varchar")}) AS o FROM customer)
    SELECT c_custkey, 3 + (c_custkey % 2) AS n,
           'ORCID=https://orcid.org/' || o || CASE WHEN c_custkey % 2 = 0 THEN '' ELSE ';ORCID=https://orcid.org/9999-9999-9999-9999' END ||
           ';OTHER=someone ' || cast(c_custkey AS varchar) || ';WIKIDATA=http://www.wikidata.org/entity/Q' || cast(c_custkey AS varchar) AS agents
    FROM s
    """,
)
def agent_ids(t: Tables):
    key = F.col("c_custkey").cast("string")
    raw = F.concat(
        F.lit("https://orcid.org/"), F.expr(_ORCID_SQL.format(s="string")), F.lit(" | someone "), key,
        F.lit(",www.wikidata.org/wiki/q"), key, F.lit(" |someone "), key,
        F.when(F.col("c_custkey") % 2 == 1, "|orcid:9999999999999999").otherwise(""),
    )
    agents = t.customer.select("c_custkey", text.agent_ids(raw).alias("a"))
    return agents.select(
        "c_custkey", F.size("a").cast("bigint").alias("n"),
        F.array_join(F.transform("a", lambda a: F.concat(a["type"], F.lit("="), a["value"])), ";").alias("agents"),
    )


@query(
    "references_uri",
    r"""
    WITH s AS (SELECT page_id, CASE WHEN page_id % 5 = 0 THEN replace(url, '/', ' ') WHEN page_id % 5 = 1 THEN '' WHEN page_id % 5 = 2 THEN regexp_replace(url, '^https?://', 'www.') ELSE url END AS v FROM pages)
    SELECT page_id, CASE WHEN page_id % 5 = 2 THEN 'http://' || v WHEN page_id % 5 > 2 THEN v END AS link,
           CASE WHEN page_id % 5 = 0 THEN 'REFERENCES_URI_INVALID' END AS issue
    FROM s
    """,
)
def references_uri(t: Tables):
    k, url = F.col("page_id") % 5, F.col("url")
    v = F.when(k == 0, F.replace(url, F.lit("/"), F.lit(" "))).when(k == 1, "").when(k == 2, F.regexp_replace(url, "^https?://", "www.")).otherwise(url)
    p = t.pages.select("page_id", text.reference_uri(v).alias("r"))
    return p.select("page_id", F.col("r.value").alias("link"), F.col("r.issue").alias("issue"))


@query(
    "licences",
    """
    SELECT source, CASE doc_id % 5 WHEN 0 THEN 'CC0_1_0' WHEN 1 THEN 'CC_BY_4_0' WHEN 2 THEN 'CC_BY_NC_4_0' WHEN 3 THEN 'UNSUPPORTED' ELSE 'UNSPECIFIED' END AS license, count(*) AS n
    FROM documents GROUP BY 1, 2
    """,
)
def licences(t: Tables):
    k = F.col("doc_id") % 5
    v = (
        F.when(k == 0, "https://creativecommons.org/publicdomain/zero/1.0/")
        .when(k == 1, " http://creativecommons.org/licenses/by/4.0/legalcode")
        .when(k == 2, "http://www.creativecommons.org/licenses/by-nc/4.0")
        .when(k == 3, F.concat(F.lit("http://licences.example.org/"), F.col("lang")))
    )
    return t.documents.select("source", text.license_name(v).alias("license")).groupBy("source", "license").agg(F.count("*").alias("n"))


# --- J5, J6, J24, B3, B15-B19 ------------------------------------------------------------------------------------------


@query(
    "vocabulary_lookup",
    f"""
    SELECT o_orderkey, v.concept, v.lineage, CASE WHEN v.concept IS NULL THEN 'PRIORITY_INVALID' END AS issue
    FROM orders LEFT JOIN {vocabulary_sql("priority").replace(" AS t(", " AS v(")} ON regexp_replace(lower(o_orderpriority), '[^a-z0-9?]+', '', 'g') = v.label
    """,
)
def vocabulary_lookup(t: Tables):
    found = lookup.lookup_vocabulary(
        t.orders.select("o_orderkey", "o_orderpriority"), "o_orderpriority", vocabulary(t.spark), "priority", "p", issue="PRIORITY_INVALID"
    )
    return found.select("o_orderkey", F.col("p.concept").alias("concept"), joined(F.col("p.lineage")).alias("lineage"), F.col("p_issue").alias("issue"))


@query(
    "event_types",
    f"""
    SELECT event_id, v.concept, v.lineage, coalesce(b.concept, 'OCCURRENCE') AS basis, CASE WHEN b.concept IS NULL THEN 'BASIS_OF_RECORD_INVALID' END AS issue
    FROM events LEFT JOIN {vocabulary_sql("eventType").replace(" AS t(", " AS v(")} ON event_type = v.label
    LEFT JOIN {vocabulary_sql("basisOfRecord").replace(" AS t(", " AS b(")} ON event_type = b.label
    """,
)
def event_types(t: Tables):
    vocab = vocabulary(t.spark)
    found = lookup.lookup_vocabulary(t.events.select("event_id", "event_type"), "event_type", vocab, "eventType", "v")
    found = lookup.lookup_enum(found, "event_type", vocab, "basisOfRecord", "b", issue="BASIS_OF_RECORD_INVALID")
    return found.select(
        "event_id", F.col("v.concept").alias("concept"), joined(F.col("v.lineage")).alias("lineage"),
        F.coalesce("b", F.lit("OCCURRENCE")).alias("basis"), F.col("b_issue").alias("issue"),
    )


_PART_VALUES = "CASE WHEN p_partkey % 4 = 0 THEN replace(p_name, ' ', '|') || '|maybe ' || p_brand WHEN p_partkey % 4 = 1 THEN '' ELSE replace(p_name, ' ', ' | ') END"


@query(
    "multi_value_enum",
    f"""
    WITH p AS (SELECT p_partkey, unnest(string_split({_PART_VALUES}, '|')) AS v FROM part),
    h AS (SELECT p_partkey, list_sort(list_distinct(list(v.concept) FILTER (v.concept IS NOT NULL))) AS l
          FROM p JOIN {vocabulary_sql("colour").replace(" AS t(", " AS v(")} ON lower(trim(p.v)) = v.label GROUP BY 1)
    SELECT part.p_partkey, CASE WHEN p_partkey % 4 = 1 THEN NULL ELSE coalesce(array_to_string(l, '|'), '') END AS colours FROM part LEFT JOIN h USING (p_partkey)
    """,
)
def multi_value_enum(t: Tables):
    part = t.part.select("p_partkey", F.expr(_PART_VALUES).alias("v"))
    found = lookup.lookup_enum_values(part, "v", vocabulary(t.spark), "colour", "c", spread=["p_partkey"])
    return found.select("p_partkey", joined(F.col("c")).alias("colours"))


@query(
    "type_status",
    f"""
    WITH p AS (SELECT p_partkey, unnest(string_split({_PART_VALUES}, '|')) AS v, generate_subscripts(string_split({_PART_VALUES}, '|'), 1) AS pos FROM part),
    h AS (SELECT p_partkey, trim(p.v) AS raw, pos, v.concept, v.lineage FROM p LEFT JOIN {vocabulary_sql("typeStatus").replace(" AS t(", " AS v(")} ON lower(trim(p.v)) = v.label WHERE trim(p.v) <> ''),
    g AS (SELECT p_partkey, string_agg(concept, '|' ORDER BY pos) AS concepts, string_agg(lineage, ';' ORDER BY pos) AS lineages,
             bool_or(concept IS NULL AND contains(raw, 'maybe')) AS maybe, bool_or(concept IS NULL AND NOT contains(raw, 'maybe')) AS bad FROM h GROUP BY 1)
    SELECT part.p_partkey, concepts, lineages,
           array_to_string(list_sort(list_filter([CASE WHEN maybe THEN 'SUSPECTED_TYPE' END, CASE WHEN bad THEN 'TYPE_STATUS_INVALID' END], lambda x: x IS NOT NULL)), '|') AS issues
    FROM part LEFT JOIN g USING (p_partkey)
    """,
)
def type_status(t: Tables, **options):
    part = t.part.select("p_partkey", terms.split_values(F.expr(_PART_VALUES)).alias("v"))
    found = lookup.type_status(part, "v", vocabulary(t.spark), "ts", spread=["p_partkey"], **options)
    return found.select(
        "p_partkey",
        joined(F.transform("ts", lambda c: c["concept"])).alias("concepts"),
        F.array_join(F.transform("ts", lambda c: F.array_join(c["lineage"], "|")), ";").alias("lineages"),
        joined(F.array_sort("ts_issues")).alias("issues"),
    )


@query("type_status_joined", ORACLES["type_status"])
def type_status_joined(t: Tables):
    """The path of vocabularies that are too large for a literal."""
    return type_status(t, literal_rows=0)


_STATUS = "case event_type when 'click' then 'present' when 'view' then 'absent' when 'error' then 'dunno' end"
_STATUS_COUNT = "case when event_id % 11 = 0 then 'x' when event_id % 7 = 0 then '0' when event_id % 5 = 0 then null else cast(cast(floor(value) as bigint) as {s}) end"


@query(
    "occurrence_status",
    f"""
    WITH s AS (SELECT event_id, {_STATUS_COUNT.format(s="varchar")} AS c, {_STATUS} AS st, event_id % 3 = 0 AS spec FROM events),
    n AS (SELECT *, try_cast(c AS bigint) AS k, CASE st WHEN 'present' THEN 'PRESENT' WHEN 'absent' THEN 'ABSENT' END AS said FROM s)
    SELECT event_id,
      CASE WHEN c IS NULL OR k IS NULL THEN CASE WHEN said = 'ABSENT' THEN 'ABSENT' ELSE 'PRESENT' END
           WHEN k = 0 THEN CASE WHEN st IS NULL AND spec THEN 'PRESENT' WHEN said = 'PRESENT' THEN 'PRESENT' ELSE 'ABSENT' END
           ELSE CASE WHEN said = 'ABSENT' THEN 'ABSENT' ELSE 'PRESENT' END END AS status,
      concat_ws('|', CASE WHEN st IS NOT NULL AND said IS NULL THEN 'OCCURRENCE_STATUS_UNPARSABLE' END,
        CASE WHEN c IS NOT NULL AND k IS NULL THEN 'INDIVIDUAL_COUNT_INVALID' END,
        CASE WHEN k = 0 AND st IS NULL AND spec THEN 'OCCURRENCE_STATUS_INFERRED_FROM_BASIS_OF_RECORD' END,
        CASE WHEN k IS NOT NULL AND said IS NULL AND NOT (k = 0 AND st IS NULL AND spec) THEN 'OCCURRENCE_STATUS_INFERRED_FROM_INDIVIDUAL_COUNT' END,
        CASE WHEN (k = 0 AND said = 'PRESENT') OR (k > 0 AND said = 'ABSENT') THEN 'INDIVIDUAL_COUNT_CONFLICTS_WITH_OCCURRENCE_STATUS' END) AS issues
    FROM n
    """,
)
def occurrence_status(t: Tables):
    e = t.events.select(
        "event_id", F.expr(_STATUS_COUNT.format(s="string")).alias("c"), F.expr(_STATUS).alias("st"),
        F.when(F.col("event_id") % 3 == 0, "PRESERVED_SPECIMEN").otherwise("HUMAN_OBSERVATION").alias("basis"),
    )
    e = lookup.lookup_enum(e, "st", vocabulary(t.spark), "occurrenceStatus", "said")
    e = e.select("event_id", status.occurrence_status(F.col("c"), F.col("st"), F.col("said"), F.col("basis")).alias("s"))
    return e.select("event_id", F.col("s.value").alias("status"), joined(F.col("s.issues")).alias("issues"))


_TRAIT = (
    "case event_id % 8 when 0 then 'sex: Female; life stage: adult; ' || event_type when 1 then 'two MALES and a larvae'"
    " when 2 then 'male female' when 3 then 'age class juvenile' when 4 then 'undetermined adult; sex=male'"
    " when 5 then '{\"sex\":\"female\", \"lifeStage\":\"juvenile\"}' when 6 then 'weight 3 g' end"
)


@query(
    "traits_from_text",
    """
    WITH s AS (SELECT event_id, event_id % 8 AS k FROM events)
    SELECT event_id, CASE k WHEN 0 THEN 'female' WHEN 1 THEN 'males' WHEN 4 THEN 'male' WHEN 5 THEN 'female' END AS sex_text,
           CASE k WHEN 0 THEN 'adult' WHEN 1 THEN 'larvae' WHEN 3 THEN 'juvenile' WHEN 5 THEN 'juvenile' END AS stage_text,
           CASE k WHEN 0 THEN 'Female' WHEN 1 THEN 'Male' WHEN 4 THEN 'Male' WHEN 5 THEN 'Female' END AS sex,
           CASE k WHEN 0 THEN 'Adult' WHEN 1 THEN 'Juvenile|Larva' WHEN 3 THEN 'Juvenile' WHEN 5 THEN 'Juvenile' END AS stage
    FROM s
    """,
)
def traits_from_text(t: Tables):
    vocab = vocabulary(t.spark)
    e = t.events.select("event_id", F.expr(_TRAIT).alias("v")).select(
        "event_id", text.sex_from_text(F.col("v")).alias("sex_text"), text.life_stage_from_text(F.col("v")).alias("stage_text")
    )
    e = lookup.lookup_vocabulary(e, "sex_text", vocab, "sex", "s")
    e = lookup.lookup_vocabulary(e, "stage_text", vocab, "lifeStage", "l")
    return e.select("event_id", "sex_text", "stage_text", F.col("s.concept").alias("sex"), joined(F.col("l.lineage")).alias("stage"))


@query(
    "traits_in_documents",
    r"""
    WITH s AS (SELECT doc_id, lower(text) AS v FROM documents),
    f AS (SELECT doc_id, list_distinct(regexp_extract_all(v, '\b(?:sex)\W+([\w?.]+(?:\s+[\w?.]+){0,2})\s*(?:[:;,"]|$)', 1)) AS a,
                 list_distinct(regexp_extract_all(v, '\b(?:sex)\W+(\w+)', 1)) AS b,
                 list_distinct(regexp_extract_all(v, '\b((?:males?|females?)(?:\s*\?)?)\b', 1)) AS c FROM s),
    d AS (SELECT doc_id, CASE WHEN len(a) > 0 THEN a WHEN len(b) > 0 THEN b ELSE c END AS l FROM f)
    SELECT doc_id, CASE WHEN len(l) = 1 THEN l[1] END AS sex FROM d
    """,
)
def traits_in_documents(t: Tables):
    return t.documents.select("doc_id", text.sex_from_text(F.col("text")).alias("sex"))
