"""What keeps the views in proportion to their input: rows dealt out, and work done once."""

from pyspark.sql import functions as F

from catalog.base import vocabulary
from fieldbook.functions.dates import parse_date
from fieldbook.functions.terms import raw_term
from fieldbook.operators import geology
from fieldbook.operators.identification import latest_extension
from fieldbook.operators.records import spread_rows
from fieldbook.schema import DWC_NS

PAIRS = [(r, f"e_{r}", f"l_{r}") for r in geology.RANKS]


def plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_rows_of_one_partition_are_dealt_to_all_cores(spark):
    one = spark.range(4000).selectExpr("id", "if(id % 2 = 0, null, id) AS k", "map('a', id) AS m").coalesce(1)
    dealt = spread_rows(one)
    assert sorted(r.id for r in dealt.collect()) == list(range(4000))
    sizes = [len(p) for p in dealt.select("id").rdd.glom().collect()]
    assert len(sizes) >= spark.sparkContext.defaultParallelism
    assert max(sizes) < 2 * 4000 / len(sizes)


def test_equal_rows_stay_as_many(spark):
    rows = [(1, None), (1, None), (None, None), (None, None), (2, "x")]
    dealt = spread_rows(spark.createDataFrame(rows, "a int, b string"))
    assert sorted(map(tuple, dealt.collect()), key=str) == sorted(rows, key=str)


def test_ranks_are_found_in_the_vocabulary_not_per_record(spark):
    rows = spark.createDataFrame([(None, "tithonian", "Neogene", None, "unheard of", None, None, None, None, "")], ", ".join(f"{c} string" for _, e, l in PAIRS for c in (e, l)))
    both = [geology.chronostratigraphy(rows, PAIRS, vocabulary(spark), **o) for o in ({}, {"literal_rows": 0})]
    # No record carries the parents of its concept.
    assert "parents" not in plan(both[0])
    for g in both:
        r = g.first()
        assert r.geology_eon.latest.concept == "Phanerozoic" and r.geology_eon.earliest is None
        assert [(t.name, t.value) for t in r.geology_eon.latest.tags] == [("endage", "0"), ("rank", "eon"), ("startage", "538.8")]
        assert r.geology_era.earliest.concept == "Cenozoic" and r.geology_era.earliest.lineage == ["Phanerozoic", "Cenozoic"]
        assert (r.geology_range.start, r.geology_range.end) == (66.0, 0.0)
        assert r.geology_issues == ["ERA_OR_ERATHEM_INFERRED_FROM_PARENT_RANK"]


def test_dates_of_an_extension_are_read_once(spark):
    key = DWC_NS + "dateIdentified"
    lists = [["2020-01-02", "2021-03-04", "2021-03-04"], ["2020-01-02", None], ["no date"], [], ["2020", "2020-01-01\n", "2020-02-30"], ["1 May 2020", "2020-04-30"]]
    df = spark.createDataFrame([(i, [{key: d, "n": str(j)} for j, d in enumerate(l)]) for i, l in enumerate(lists)], "i int, rows array<map<string,string>>")
    out = df.select("i", latest_extension(F.col("rows"))["n"].alias("n"))
    assert [r.n for r in out.orderBy("i").collect()] == ["1", None, "0", None, None, "0"]
    assert plan(out).count("forall") == 1 and plan(out).count("dateIdentified") < 8


def test_canonical_dates_keep_their_checks(values):
    texts = ["2020-02-29", "2021-02-29", " 2020-01-02 ", "2020-01-02\n", "2020-13-01", "0000-01-01", "2020-1-2", "2020-01-02Z", None, ""]
    assert values(lambda c: parse_date(c), texts) == ["2020-02-29", None, "2020-01-02", "2020-01-02", None, values(lambda c: parse_date(c), ["0000-01-01Z"])[0], "2020-01-02", "2020-01-02", None, None]


def test_local_terms_by_their_last_part(spark):
    df = spark.sql("SELECT map('http://x/projectIdx', 'no', 'http://x/myprojectId', 'no', 'http://x/projectId', 'a', 'projectId', 'b') AS t UNION ALL SELECT map('projectId', 'c') UNION ALL SELECT map() UNION ALL SELECT null")
    assert sorted(str(r[0]) for r in df.select(raw_term("projectId", "t")).collect()) == ["None", "None", "a", "c"]
