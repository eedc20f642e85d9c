"""The interpreted views over verbatim records made from the events."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F
from pyspark.sql import types as T

from catalog.base import ORACLES, RUN_TS, VOCABULARY_ROWS, Tables, joined, query, vocabulary
from catalog.geography import CODES, _BOX_COLS, _HITS_SQL, _PAIR_SETS, country_continents, nations, regions
from catalog.lineage import _PARENT, _WALK
from catalog.names import complete
from catalog.temporal import _SPELLINGS
from catalog.terms import _COUNT_TEXT, _TRAIT
from fieldbook.functions.dates import DMY
from fieldbook.operators import geocode
from fieldbook.operators.checkpoints import materialize, shared_folder
from fieldbook.operators.records import spread_rows
from fieldbook.plans import LocationDims, basic_view, event_view, interpret, location_view, occurrence_view, taxon_view, temporal_view
from fieldbook.schema import DWC_NS, uri
from fieldbook.sources import dims
from fieldbook.sources.verbatim import read_views, to_json_lines, write_views

#: Places on eighths of degrees, so that text and number agree; both engines.
_LAT = "cast((event_id * 37) % 1440 as double) / 8 - 90"
_LNG = "cast((event_id * 53) % 2880 as double) / 8 - 180"
_GIVEN = "element_at(array(" + ", ".join(f"'{c.lower()}'" for c in CODES) + "), cast((event_id * 7) % 25 as int) + 1)"
_GIVEN_SQL = "(['" + "', '".join(CODES) + "'])[(event_id * 7) % 25 + 1]"
_NAME = "case event_id % 4 when 0 then event_type when 1 then event_type || 'x' when 2 then 'zzzz' end"


#: Terms that give every column of the views a value in some records.
_MORE_TERMS = {
    "establishmentMeans": "case event_id % 3 when 0 then 'Native' when 1 then 'unheard of' end",
    "degreeOfEstablishment": "case when event_id % 4 = 0 then 'managed' end",
    "pathway": "case when event_id % 5 = 0 then 'escape' end",
    "typeStatus": "case when event_id % 6 = 0 then 'RED | bolt' end",
    "typifiedName": "case when event_id % 7 = 0 then 'Abies alba' end",
    "sampleSizeValue": "cast(event_id % 10 as string)",
    "sampleSizeUnit": "'m2'",
    "organismQuantity": "cast(event_id % 5 * 2 as string)",
    "organismQuantityType": "case when event_id % 2 = 0 then 'M2' else 'individuals' end",
    "references": "case when event_id % 4 = 1 then 'https://example.org/x' end",
    "license": "case when event_id % 3 = 0 then 'http://creativecommons.org/publicdomain/zero/1.0/legalcode' end",
    "identifiedByID": "case when event_id % 4 = 2 then 'https://orcid.org/0000-0002-1825-0097' end",
    "recordedByID": "case when event_id % 4 = 3 then 'someone' end",
    "datasetID": "'d1 | d2'",
    "datasetName": "case when event_id % 2 = 1 then 'set' end",
    "otherCatalogNumbers": "'a; b | c'",
    "identifiedBy": "case when event_id % 3 = 2 then 'Ann | | Bob' end",
    "preparations": "'skin'",
    "samplingProtocol": "'net|trap'",
    "projectId": "case when event_id % 2 = 0 then 'p1' end",
    "associatedSequences": "case when event_id % 9 = 0 then 's1; s2' end",
    "earliestEonOrLowestEonothem": "case when event_id % 4 = 0 then 'Phanerozoic' end",
    "earliestEraOrLowestErathem": "case when event_id % 4 = 0 then 'mesozoic' end",
    "latestEraOrHighestErathem": "case when event_id % 8 = 0 then 'mesozoic' end",
    "earliestPeriodOrLowestSystem": "case when event_id % 4 = 0 then 'jurassic' end",
    "earliestEpochOrLowestSeries": "case when event_id % 4 = 0 then 'late jurassic' end",
    "earliestAgeOrLowestStage": "case when event_id % 8 = 0 then 'tithonian' end",
    "lowestBiostratigraphicZone": "'zone a'",
    "highestBiostratigraphicZone": "case when event_id % 2 = 0 then ' zone b ' end",
    "group": "'group ' || event_id % 3",
    "formation": "case when event_id % 5 = 0 then 'null' else 'formation' end",
    "member": "'member'",
    "bed": "case when event_id % 2 = 1 then 'bed' end",
    "waterBody": "'NORTH  SEA'",
    "stateProvince": "'Oslo'",
    "locality": "case when event_id % 2 = 0 then 'by the  SHORE' end",
    "minimumElevationInMeters": "cast(event_id % 100 as string) || ' m'",
    "maximumElevationInMeters": "cast(event_id % 100 + 10 as string)",
    "minimumDepthInMeters": "case when event_id % 2 = 0 then cast(event_id % 30 as string) end",
    "minimumDistanceAboveSurfaceInMeters": "'2'",
    "maximumDistanceAboveSurfaceInMeters": "case when event_id % 2 = 0 then '3 m' end",
    "coordinatePrecision": "'0.01'",
    "footprintWKT": "case when event_id % 5 = 0 then 'POLYGON((0 0, 0 1, 1 1, 0 0))' end",
    "higherGeography": "'World | Europe'",
    "georeferencedBy": "case when event_id % 3 = 0 then 'Ann' end",
    "modified": "'2020-01-02'",
    "dateIdentified": "case when event_id % 3 = 0 then '2019-03-04' end",
}


def whole(view):
    """All columns of a view: lists of text joined, what is nested as JSON."""

    def flat(f):
        kind = f.dataType
        if isinstance(kind, T.ArrayType) and isinstance(kind.elementType, T.StringType):
            return joined(F.array_sort(f.name) if f.name == "issues" else F.col(f.name))
        return F.to_json(f.name) if isinstance(kind, (T.ArrayType, T.StructType, T.MapType)) else F.col(f.name)

    return view.select(*[flat(f).alias(f.name) for f in view.schema.fields])


def verbatim(t: Tables):
    """One record per event."""
    e = spread_rows(t.events).select(
        "*", *[F.date_format("ts", f).alias(n) for n, f in (("y", "yyyy"), ("m", "MM"), ("d", "dd"), ("mon", "MMM"))]
    )
    terms = {
        "eventDate": F.expr(f"case when event_id % 10 = 9 then 'unknown' else {_SPELLINGS.format(k='event_id')} end"),
        "individualCount": F.expr(_COUNT_TEXT.format(s="string")),
        "decimalLatitude": F.expr(f"cast({_LAT} as string)"),
        "decimalLongitude": F.expr(f"cast({_LNG} as string)"),
        "geodeticDatum": F.lit("WGS84"),
        "countryCode": F.expr(f"case when event_id % 6 > 0 then {_GIVEN} end"),
        "basisOfRecord": F.col("event_type"),
        "dynamicProperties": F.expr(_TRAIT),
        "recordedBy": F.concat(F.lit("user "), F.col("user_id").cast("string"), F.lit(" | someone")),
        "scientificName": F.expr(_NAME),
        "kingdom": F.expr("case when event_id % 4 = 1 then 'Acta' end"),
        "parentEventID": F.expr(_PARENT),
        "eventType": F.col("event_type"),
        "coordinateUncertaintyInMeters": F.expr("case when event_id % 3 = 0 then '-' || cast(event_id % 50 as string) || ' m' end"),
    }
    terms |= {name: F.expr(text) for name, text in _MORE_TERMS.items()}
    entries = [x for name, value in terms.items() for x in (F.lit(uri(name)), value)]
    return e.select(
        F.col("event_id").cast("string").alias("id"),
        F.lit(None).cast("string").alias("coreId"),
        F.lit(DWC_NS + "Occurrence").alias("coreRowType"),
        F.create_map(*entries).alias("coreTerms"),
        F.expr("cast(map() as map<string,array<map<string,string>>>)").alias("extensions"),
    )


def location_dims(t: Tables) -> LocationDims:
    nat = nations(t)
    named = nat.join(t.region, F.col("n_regionkey") == F.col("r_regionkey")).select("n_name", "code", F.col("r_name").alias("region"))
    alias = named.select(F.col("code").alias("alias"), F.col("code").alias("iso2"), F.col("code").alias("iso3"), F.col("n_name").alias("title"), "region")
    cen = nat.selectExpr(*_BOX_COLS).selectExpr("(s + n) / 2 AS lat", "(w + e) / 2 AS lng")
    return LocationDims(
        aliases=alias,
        pairs=dims.load_country_pairs(t.spark),
        continents=country_continents(t),
        vocabulary=vocabulary(t.spark),
        cells=materialize(geocode.region_cells(regions(t))),
        centroids=cen,
        publishing_country="AU",
    )


def backbone(t: Tables):
    """The event types as species of one kingdom."""
    own = F.struct(F.col("key").cast("int").alias("key"), "name", "rank")
    sp = t.events.groupBy(F.col("event_type").alias("name")).agg((F.min("event_id") + 100).alias("key")).withColumn("rank", F.lit("SPECIES"))
    ki = t.events.agg((F.min("event_id") + 1).alias("key")).select(F.lit("Acta").alias("name"), "key", F.lit("KINGDOM").alias("rank"))
    rows = sp.unionByName(ki)
    return complete(rows.select("key", "name", "rank", F.lit("Acta").alias("kingdom"), F.lit("ACCEPTED").alias("status"), F.array(own).alias("classification")))


_COUNTS = f"WITH c AS (SELECT *, {_COUNT_TEXT.format(s='varchar')} AS cnt FROM events)"
_BASIS = "CASE event_type WHEN 'click' THEN 'HUMAN_OBSERVATION' WHEN 'view' THEN 'MACHINE_OBSERVATION' WHEN 'purchase' THEN 'PRESERVED_SPECIMEN' END"
_DATE_OK = "(event_id % 10 <> 9)"


@query(
    "records_per_year_and_issue",
    f"""
    {_COUNTS},
    r AS (SELECT CASE WHEN {_DATE_OK} THEN year(ts) END AS year, CASE WHEN NOT {_DATE_OK} THEN 'RECORDED_DATE_INVALID' END AS i1, CASE WHEN {_BASIS} IS NULL THEN 'BASIS_OF_RECORD_INVALID' END AS i2,
            CASE WHEN cnt IS NOT NULL AND (NOT regexp_full_match(cnt, '[0-9]{{1,10}}') OR try_cast(cnt AS integer) IS NULL) THEN 'INDIVIDUAL_COUNT_INVALID' END AS i3 FROM c)
    SELECT year, issue, count(*) AS records FROM (
      SELECT year, i1 AS issue FROM r WHERE i1 IS NOT NULL UNION ALL SELECT year, i2 FROM r WHERE i2 IS NOT NULL UNION ALL SELECT year, i3 FROM r WHERE i3 IS NOT NULL
      UNION ALL SELECT year, NULL FROM r WHERE i1 IS NULL AND i2 IS NULL AND i3 IS NULL) GROUP BY 1, 2
    """,
)
def records_per_year_and_issue(t: Tables):
    v = verbatim(t)
    temporal = temporal_view(v, RUN_TS, orderings=[DMY]).select("id", "year", F.col("issues").alias("i1"))
    basic = basic_view(v, vocabulary(t.spark), RUN_TS).select("id", F.col("issues").alias("i2"))
    both = temporal.join(basic, "id").select("year", F.explode_outer(F.array_union("i1", "i2")).alias("issue"))
    return both.groupBy("year", "issue").agg(F.count("*").alias("records"))


@query(
    "temporal_view",
    f"""
    WITH p AS (SELECT event_id, ts, event_id % 6 AS k, strftime(ts, '%Y-%m-%d') AS day FROM events)
    SELECT cast(event_id AS varchar) AS id, NULL AS "coreId", {_PARENT} AS "parentId", {int(RUN_TS.timestamp() * 1000)} AS created, CASE WHEN {_DATE_OK} THEN year(ts) END AS year, CASE WHEN {_DATE_OK} THEN month(ts) END AS month,
      CASE WHEN {_DATE_OK} AND k <> 4 THEN day(ts) END AS day,
      CASE WHEN {_DATE_OK} THEN '{{"gte":"' || CASE k WHEN 4 THEN day[1:7] || '-01T00:00:00.000' WHEN 5 THEN day || 'T10:11:12.000' ELSE day || 'T00:00:00.000' END || '","lte":"'
        || CASE k WHEN 4 THEN strftime(last_day(ts), '%Y-%m-%d') || 'T23:59:59.999' WHEN 5 THEN day || 'T10:11:12.000' ELSE day || 'T23:59:59.999' END
        || '","interval":"' || CASE k WHEN 4 THEN day[1:7] WHEN 5 THEN day || 'T10:11:12' ELSE day END || '"}}' ELSE '{{}}' END AS "eventDate",
      CASE WHEN {_DATE_OK} AND k <> 4 THEN dayofyear(ts) END AS "startDayOfYear", CASE WHEN {_DATE_OK} AND k <> 4 THEN dayofyear(ts) END AS "endDayOfYear", '2020-01-02' AS modified,
      CASE WHEN event_id % 3 = 0 THEN '2019-03-04' END AS "dateIdentified", NULL AS "datePrecision", CASE WHEN {_DATE_OK} THEN '' ELSE 'RECORDED_DATE_INVALID' END AS issues
    FROM p
    """,
)
def temporal(t: Tables):
    return whole(temporal_view(verbatim(t), RUN_TS, orderings=[DMY]))


_CREATED = int(RUN_TS.timestamp() * 1000)


def _concept(name: str, *above: str) -> str:
    """A concept of the vocabulary as JSON."""
    return '{"concept":"%s","lineage":[%s]}' % (name, ",".join(f'"{x}"' for x in (*above, name)))


def _stage(concept: str) -> str:
    """A concept of the geological vocabulary as JSON, with its tags."""
    above, tags = next((above, tags) for v, _, c, above, tags in VOCABULARY_ROWS if v == "geologicalContext" and c == concept)
    pairs = sorted((k.lower(), x) for k, x in (tag.split(":") for tag in tags.split(";")))
    return _concept(concept, *reversed(above.split("/") if above else []))[:-1] + ',"tags":[' + ",".join(f'{{"name":"{k}","value":"{x}"}}' for k, x in pairs) + "]}"


def _json(*fields: tuple[str, str, str]) -> str:
    """SQL for a JSON object without the fields that are null: (name, condition, SQL of the value)."""
    parts = ", ".join(f"CASE WHEN {when} THEN '\"{name}\":' || {value} END" for name, when, value in fields)
    return f"'{{' || concat_ws(',', {parts}) || '}}'"


_quoted = "'\"' || {} || '\"'".format
_FIRST = "event_id % 4 = 0"
_CONTEXT = _json(
    ("earliestEonOrLowestEonothem", _FIRST, f"'{_stage('Phanerozoic')}'"), ("earliestEraOrLowestErathem", _FIRST, f"'{_stage('Mesozoic')}'"),
    ("latestEraOrHighestErathem", "event_id % 8 = 0", f"'{_stage('Mesozoic')}'"), ("earliestPeriodOrLowestSystem", _FIRST, f"'{_stage('Jurassic')}'"),
    ("earliestEpochOrLowestSeries", _FIRST, f"'{_stage('Late Jurassic')}'"), ("earliestAgeOrLowestStage", "event_id % 8 = 0", f"'{_stage('Tithonian')}'"),
    ("lowestBiostratigraphicZone", "true", _quoted("'zone a'")), ("highestBiostratigraphicZone", "event_id % 2 = 0", _quoted("'zone b'")), ("group", "true", _quoted("'group ' || event_id % 3")),
    ("formation", "event_id % 5 <> 0", _quoted("'formation'")), ("member", "true", _quoted("'member'")), ("bed", "event_id % 2 = 1", _quoted("'bed'")),
    ("startAge", _FIRST, "CASE WHEN event_id % 8 = 0 THEN '149.2' ELSE '161.5' END"), ("endAge", _FIRST, "'145.0'"),
)


@query(
    "basic_view",
    f"""
    {_COUNTS}
    SELECT cast(event_id AS varchar) AS id, NULL AS "coreId", {_CREATED} AS created, coalesce({_BASIS}, 'OCCURRENCE') AS "basisOfRecord",
      CASE event_id % 8 WHEN 0 THEN '{_concept("Female")}' WHEN 1 THEN '{_concept("Male")}' WHEN 4 THEN '{_concept("Male")}' WHEN 5 THEN '{_concept("Female")}' END AS sex,
      CASE event_id % 8 WHEN 0 THEN '{_concept("Adult")}' WHEN 1 THEN '{_concept("Larva", "Juvenile")}' WHEN 3 THEN '{_concept("Juvenile")}' WHEN 5 THEN '{_concept("Juvenile")}' END AS "lifeStage",
      CASE WHEN event_id % 3 = 0 THEN '{_concept("Native")}' END AS "establishmentMeans", CASE WHEN event_id % 4 = 0 THEN '{_concept("Managed", "Captive")}' END AS "degreeOfEstablishment",
      CASE WHEN event_id % 5 = 0 THEN '{_concept("Escape", "Any", "Unintended")}' END AS pathway,
      CASE WHEN regexp_full_match(cnt, '[0-9]{{1,10}}') THEN try_cast(cnt AS integer) END AS "individualCount",
      CASE WHEN event_id % 6 = 0 THEN '[{_concept("Paratype", "Type")},{_concept("Syntype")}]' END AS "typeStatus", CASE WHEN event_id % 7 = 0 THEN 'Abies alba' END AS "typifiedName",
      cast(event_id % 10 AS double) AS "sampleSizeValue", 'm2' AS "sampleSizeUnit", cast(event_id % 5 * 2 AS double) AS "organismQuantity", CASE WHEN event_id % 2 = 0 THEN 'M2' ELSE 'individuals' END AS "organismQuantityType",
      CASE WHEN event_id % 2 = 0 AND event_id % 10 > 0 THEN (event_id % 5 * 2) / cast(event_id % 10 AS double) END AS "relativeOrganismQuantity", CASE WHEN event_id % 4 = 1 THEN 'https://example.org/x' END AS "references",
      CASE WHEN event_id % 3 = 0 THEN 'CC0_1_0' ELSE 'UNSPECIFIED' END AS license, CASE WHEN event_id % 4 = 2 THEN '[{{"type":"ORCID","value":"https://orcid.org/0000-0002-1825-0097"}}]' END AS "identifiedByIds",
      CASE WHEN event_id % 4 = 3 THEN '[{{"type":"OTHER","value":"someone"}}]' END AS "recordedByIds", NULL AS "occurrenceStatus", 'd1|d2' AS "datasetID", CASE WHEN event_id % 2 = 1 THEN 'set' END AS "datasetName",
      'a|b|c' AS "otherCatalogNumbers", 'user ' || user_id || '|someone' AS "recordedBy", CASE WHEN event_id % 3 = 2 THEN 'Ann|Bob' END AS "identifiedBy", 'skin' AS preparations, 'net|trap' AS "samplingProtocol",
      CASE WHEN event_id % 2 = 0 THEN 'p1' END AS "projectId", CASE WHEN event_id % 9 = 0 THEN 's1|s2' END AS "associatedSequences", {_CONTEXT} AS "geologicalContext", event_id % 9 = 0 AS "isSequenced",
      concat_ws('|', CASE WHEN {_BASIS} IS NULL THEN 'BASIS_OF_RECORD_INVALID' END,
        CASE WHEN cnt IS NOT NULL AND (NOT regexp_full_match(cnt, '[0-9]{{1,10}}') OR try_cast(cnt AS integer) IS NULL) THEN 'INDIVIDUAL_COUNT_INVALID' END) AS issues
    FROM c
    """,
)
def basic(t: Tables):
    return whole(basic_view(verbatim(t), vocabulary(t.spark), RUN_TS))


@query(
    "event_view",
    f"""
    {_WALK},
    named AS (SELECT id, coalesce(CASE WHEN parent IS NOT NULL AND NOT coalesce(loop, false) THEN '[' || coalesce(chain, '') || ']' END, NULL) AS lineage, parent, loop, kind FROM ev LEFT JOIN
      (SELECT id, bool_or(looped) AS loop, string_agg('{{"id":"' || node || '","eventType":"' || kind || '","order":' || pos || '}}', ',' ORDER BY pos) AS chain FROM up GROUP BY 1) USING (id))
    SELECT id, parent AS "parentEventID",
      CASE kind WHEN 'Click' THEN '{_concept("Click", "Activity", "Interaction")}' WHEN 'View' THEN '{_concept("View", "Activity", "Interaction")}' WHEN 'Purchase' THEN '{_concept("Purchase", "Activity")}' WHEN 'Signup' THEN '{_concept("Signup")}' END AS "eventType",
      {_CREATED} AS created, cast(cast(id AS bigint) % 10 AS double) AS "sampleSizeValue", 'm2' AS "sampleSizeUnit", CASE WHEN cast(id AS bigint) % 4 = 1 THEN 'https://example.org/x' END AS "references",
      CASE WHEN cast(id AS bigint) % 3 = 0 THEN 'CC0_1_0' ELSE 'UNSPECIFIED' END AS license, 'd1|d2' AS "datasetID", CASE WHEN cast(id AS bigint) % 2 = 1 THEN 'set' END AS "datasetName", 'net|trap' AS "samplingProtocol",
      lineage AS "parentsLineage", NULL AS "locationID", CASE WHEN coalesce(loop, false) THEN 'EVENT_ID_TO_PARENT_ID_LOOPING_ISSUE' ELSE '' END AS issues
    FROM named
    """,
)
def event(t: Tables):
    return whole(event_view(verbatim(t), vocabulary(t.spark), RUN_TS))


@query(
    "taxon_view",
    f"""
    WITH sp AS (SELECT event_type AS name, min(event_id) + 100 AS key FROM events GROUP BY 1),
    n AS (SELECT event_id, {_PARENT} AS parent, event_id % 4 AS k, '{{"key":' || key || ',"name":"' || name || '","rank":"SPECIES"}}' AS own, name FROM events JOIN sp ON event_type = name),
    m AS (SELECT *, k IN (0, 1) AS hit, CASE k WHEN 0 THEN 91 ELSE 79 END AS score, '{{"key":0,"name":"incertae sedis","rank":"KINGDOM"}}' AS none FROM n)
    SELECT cast(event_id AS varchar) AS id, NULL AS "coreId", parent AS "parentId", {_CREATED} AS created, CASE WHEN hit THEN false END AS synonym, CASE WHEN hit THEN own ELSE none END AS usage,
      '[' || CASE WHEN hit THEN own ELSE none END || ']' AS classification, CASE WHEN hit THEN own END AS "acceptedUsage", NULL AS nomenclature,
      CASE WHEN hit THEN '{{"matchType":"' || CASE k WHEN 0 THEN 'EXACT' ELSE 'FUZZY' END || '","confidence":' || score || ',"status":"ACCEPTED","lineage":["' || name || '"],"note":"score ' || score || '; no other candidate"}}' END AS diagnostics,
      NULL AS "usageParsedName", NULL AS "iucnRedListCategoryCode", CASE k WHEN 0 THEN '' WHEN 1 THEN 'TAXON_MATCH_FUZZY' ELSE 'TAXON_MATCH_NONE' END AS issues
    FROM m
    """,
)
def taxon(t: Tables):
    return whole(taxon_view(verbatim(t), backbone(t), RUN_TS))


_RESOLVED = f"""
    WITH {_HITS_SQL}, {_PAIR_SETS},
    rec AS (SELECT event_id, {_LAT} AS lat, {_LNG} AS lng, CASE WHEN event_id % 6 > 0 THEN {_GIVEN_SQL} END AS given FROM events),
    cand AS (SELECT event_id, given, 0 AS pos, lat AS y, lng AS x FROM rec UNION ALL SELECT event_id, given, 1, -lat, lng FROM rec UNION ALL SELECT event_id, given, 2, lat, -lng FROM rec
             UNION ALL SELECT event_id, given, 3, -lat, -lng FROM rec UNION ALL SELECT event_id, given, 4, lng, lat FROM rec),
    loc AS (SELECT event_id, given, pos, code FROM cand JOIN box ON y BETWEEN s AND n AND (x BETWEEN w AND e OR x + 360 = e OR x - 360 = w) WHERE y BETWEEN -90 AND 90 AND NOT (given IS NULL AND y < -60)
            UNION ALL SELECT event_id, given, pos, 'AQ' FROM cand WHERE given IS NULL AND y >= -90 AND y < -60),
    per AS (SELECT event_id, bool_or(pos = 0 AND code = given) AS same, min(code) FILTER (pos = 0) AS nearest,
       min(loc.code) FILTER (pos = 0 AND EXISTS (SELECT 1 FROM pair WHERE country = given AND other = loc.code AND NOT flagged)) AS eq,
       min(loc.code) FILTER (pos = 0 AND EXISTS (SELECT 1 FROM pair WHERE country = given AND other = loc.code AND flagged)) AS conf,
       min(CASE WHEN pos > 0 AND loc.code = given THEN pos END) AS fix FROM loc GROUP BY 1),
    j AS (SELECT rec.*, coalesce(same, false) AS same, nearest, eq, conf, CASE WHEN given IS NULL OR coalesce(same, false) OR eq IS NOT NULL OR conf IS NOT NULL THEN NULL ELSE fix END AS fix FROM rec LEFT JOIN per USING (event_id)),
    f AS (SELECT *, CASE WHEN given IS NULL THEN nearest WHEN same THEN given ELSE coalesce(eq, conf, given) END AS country,
      CASE WHEN fix IN (1, 3) THEN -lat WHEN fix = 4 THEN lng ELSE lat END AS la, CASE WHEN fix IN (2, 3) THEN -lng WHEN fix = 4 THEN lat ELSE lng END AS lo FROM j),
    c AS (SELECT f.*, (SELECT min({{cont}}) FROM box JOIN region ON n_regionkey = r_regionkey WHERE n_nationkey >= 5 AND la BETWEEN s AND n AND (lo BETWEEN w AND e OR lo + 360 = e OR lo - 360 = w)) AS cont,
             (SELECT min([code || '.1_1', n_name || ' West']) FROM box WHERE la BETWEEN s AND n AND (lo BETWEEN w AND w + 36 OR lo - 360 = w)) AS g1,
             (SELECT min([code || '_1', n_name]) FROM box WHERE la BETWEEN s AND n AND (lo BETWEEN w AND e OR lo + 360 = e OR lo - 360 = w)) AS g0,
             (SELECT min(r_name) FROM box JOIN region ON n_regionkey = r_regionkey WHERE code = country) AS part,
             (SELECT min(m) FROM (SELECT 2 * 6371000.0 * asin(sqrt(least(1, pow(sin(radians((s + n) / 2 - la) / 2), 2) + cos(radians(la)) * cos(radians((s + n) / 2)) * pow(sin(radians((w + e) / 2 - lo) / 2), 2)))) AS m FROM box) WHERE m <= 5000) AS centre, (SELECT min(n_name) FROM box WHERE code = country) AS title FROM f)
""".replace("{cont}", "CASE r_name WHEN 'MIDDLE EAST' THEN 'EUROPE' WHEN 'AMERICA' THEN 'NORTH_AMERICA' ELSE r_name END")


@query(
    "location_view",
    f"""
    {_RESOLVED}
    SELECT cast(event_id AS varchar) AS id, NULL AS "coreId", {_PARENT} AS "parentId", {_CREATED} AS created, cont AS continent, 'North sea' AS "waterBody", title AS country, country AS "countryCode", 'AU' AS "publishingCountry",
      part AS region, (SELECT r_name FROM nation JOIN region ON n_regionkey = r_regionkey WHERE n_nationkey = 0) AS "publishedByRegion", 'Oslo' AS "stateProvince",
      cast(event_id % 100 AS double) AS "minimumElevationInMeters", cast(event_id % 100 + 10 AS double) AS "maximumElevationInMeters", cast(event_id % 100 + 5 AS double) AS elevation, 5.0::DOUBLE AS "elevationAccuracy",
      CASE WHEN event_id % 2 = 0 THEN cast(event_id % 30 AS double) END AS "minimumDepthInMeters", NULL AS "maximumDepthInMeters", CASE WHEN event_id % 2 = 0 THEN cast(event_id % 30 AS double) END AS depth,
      CASE WHEN event_id % 2 = 0 THEN 0.0::DOUBLE END AS "depthAccuracy", 2.0::DOUBLE AS "minimumDistanceAboveSurfaceInMeters", CASE WHEN event_id % 2 = 0 THEN 3.0::DOUBLE END AS "maximumDistanceAboveSurfaceInMeters",
      la AS "decimalLatitude", lo AS "decimalLongitude", CASE WHEN event_id % 3 = 0 AND event_id % 50 > 0 THEN cast(event_id % 50 AS double) END AS "coordinateUncertaintyInMeters", 0.01::DOUBLE AS "coordinatePrecision",
      true AS "hasCoordinate", country <> 'AU' AS repatriated, (given IS NOT NULL AND NOT same AND eq IS NULL AND conf IS NULL AND fix IS NULL) OR (lat = 0 AND lng = 0) AS "hasGeospatialIssue",
      CASE WHEN event_id % 2 = 0 THEN 'by the SHORE' END AS locality, NULL AS "georeferencedDate",
      CASE WHEN g0 IS NOT NULL THEN {_json(("level0Gid", "true", _quoted("g0[1]")), ("level1Gid", "g1 IS NOT NULL", _quoted("g1[1]")), ("level0Name", "true", _quoted("g0[2]")), ("level1Name", "g1 IS NOT NULL", _quoted("g1[2]")))} END AS gadm,
      CASE WHEN event_id % 5 = 0 THEN 'POLYGON((0 0, 0 1, 1 1, 0 0))' END AS "footprintWKT", NULL AS biome, round(centre, 3) AS "distanceFromCentroidInMeters", 'World|Europe' AS "higherGeography",
      CASE WHEN event_id % 3 = 0 THEN 'Ann' END AS "georeferencedBy",
      array_to_string(list_sort(list_filter([CASE WHEN (given IS NULL AND nearest IS NOT NULL) OR (given IS NOT NULL AND NOT same AND eq IS NULL AND conf IS NOT NULL) THEN 'COUNTRY_DERIVED_FROM_COORDINATES' END,
        CASE WHEN given IS NOT NULL AND NOT same AND eq IS NULL AND conf IS NULL AND fix IS NULL THEN 'COUNTRY_COORDINATE_MISMATCH' END,
        CASE WHEN fix IN (1, 3) THEN 'PRESUMED_NEGATED_LATITUDE' END, CASE WHEN fix IN (2, 3) THEN 'PRESUMED_NEGATED_LONGITUDE' END, CASE WHEN fix = 4 THEN 'PRESUMED_SWAPPED_COORDINATE' END,
        CASE WHEN lat = 0 AND lng = 0 THEN 'ZERO_COORDINATE' END, CASE WHEN cont IS NOT NULL THEN 'CONTINENT_DERIVED_FROM_COORDINATES' END,
        CASE WHEN event_id % 150 = 0 THEN 'COORDINATE_UNCERTAINTY_METERS_INVALID' END], lambda x: x IS NOT NULL)), '|') AS issues
    FROM c
    """,
)
def location(t: Tables):
    return _plain_numbers(whole(location_view(verbatim(t), location_dims(t), RUN_TS)))


def _plain_numbers(v):
    """No negative zeros, and distances to the millimetre."""
    return v.withColumns(
        {
            "decimalLatitude": F.col("decimalLatitude") + 0.0, "decimalLongitude": F.col("decimalLongitude") + 0.0,
            "distanceFromCentroidInMeters": F.round("distanceFromCentroidInMeters", 3),
        }
    )


@query(
    "occurrence_json",
    f"""
    {_RESOLVED}, sp AS (SELECT event_type AS name, min(event_id) + 100 AS key FROM events GROUP BY 1)
    SELECT cast(event_id AS varchar) AS id, coalesce({_BASIS}, 'OCCURRENCE') AS basis, CASE WHEN {_DATE_OK} THEN cast(year(ts) AS varchar) END AS year, country AS code,
      CASE WHEN event_id % 4 IN (0, 1) THEN cast(key AS varchar) ELSE '0' END AS taxon
    FROM c JOIN events USING (event_id) JOIN sp ON event_type = name
    """,
)
def occurrence_json(t: Tables):
    doc = to_json_lines(_stored_occurrence(t), "doc")
    return doc.select(
        "id",
        F.get_json_object("doc", "$.basisOfRecord").alias("basis"),
        F.get_json_object("doc", "$.year").alias("year"),
        F.get_json_object("doc", "$.countryCode").alias("code"),
        F.get_json_object("doc", "$.usage.key").alias("taxon"),
    )


def _stored_occurrence(t: Tables):
    """The whole way: interpreted, written in buckets, and joined from there."""
    views, kept, _ = interpret(verbatim(t), vocabulary(t.spark), backbone(t), location_dims(t), RUN_TS, orderings=[DMY])
    out, buckets = f"{shared_folder(t.spark)}/occurrence-{uuid.uuid4().hex}", int(t.spark.conf.get("spark.sql.shuffle.partitions"))
    write_views({"verbatim": kept.select("id", "coreId"), **views}, out, buckets=buckets)
    stored = read_views(t.spark, out, ["verbatim", *views], buckets)
    return occurrence_view(stored.pop("verbatim"), **stored)


def _joined_sql() -> str:
    """The four views' SQL, joined by id, with their issues pooled."""
    views = ("basic", "taxon", "location", "temporal")
    parts = ", ".join(f"{v} AS ({ORACLES[v + '_view']})" for v in views)
    pooled = ", ".join(f"string_split({v}.issues, '|')" for v in views)
    return f"""
        WITH {parts}
        SELECT id, NULL AS "coreId", basic.* EXCLUDE (id, "coreId", created, issues), taxon.* EXCLUDE (id, "coreId", "parentId", created, issues), location.* EXCLUDE (id, "coreId", "parentId", created, issues),
          temporal.* EXCLUDE (id, "coreId", issues), array_to_string(list_sort(list_distinct(list_filter(flatten([{pooled}]), lambda x: x <> ''))), '|') AS issues
        FROM basic JOIN taxon USING (id) JOIN location USING (id) JOIN temporal USING (id)
    """


@query("occurrence_view", _joined_sql())
def occurrence(t: Tables):
    """All columns of the joined view, from views written in buckets."""
    return _plain_numbers(whole(_stored_occurrence(t)))
