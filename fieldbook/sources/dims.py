"""Dimension tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldbook.operators.lookup import prepare_vocabulary
from fieldbook.schema import VOCABULARY

# ---------------------------------------------------------------------------
# Countries that are taken for each other.  XX,YY,add_issue: true where the change is
# flagged, false where either code is accepted silently.
# ---------------------------------------------------------------------------
COUNTRY_PAIRS = """
CX,AU,true
CC,AU,true
HM,AU,true
NF,AU,true
HK,CN,true
MO,CN,true
GL,DK,true
AX,FI,true
FR,GP,false
FR,GF,false
FR,MQ,false
FR,RE,false
FR,YT,false
FR,PF,false
FR,PM,false
FR,WF,false
FR,MF,false
FR,BL,false
FR,NC,false
FR,TF,false
IE,GB,true
IL,PS,true
XK,RS,false
EH,MA,false
CK,NZ,true
NU,NZ,true
TK,NZ,true
SJ,NO,true
IM,GB,true
JE,GB,true
GG,GB,true
VI,US,true
PR,US,true
AS,US,true
MP,US,true
UM,US,true
GU,US,true
"""

#: No continent holds them.
INTERNATIONAL_WATERS = ("XZ", "XZZ")


def _upper(name: str):
    return F.upper(F.trim(F.col(name)))


def load_country_pairs(spark: SparkSession, path: str | None = None) -> DataFrame:
    """``country, other, add_issue`` in both directions and with the country itself.

    Without a path the built-in pairs are taken; a file has the same lines, with ``#`` comments."""
    if path is None:
        rows = [line.split(",") for line in COUNTRY_PAIRS.split()]
        values = ", ".join(f"('{a}', '{b}', '{flagged}')" for a, b, flagged in rows)
        raw = spark.sql(f"SELECT * FROM VALUES {values} AS t(a, b, add_issue)")
    else:
        raw = spark.read.csv(path, schema="a string, b string, add_issue string", comment="#")
    pair = raw.select(
        _upper("a").alias("a"), _upper("b").alias("b"), (F.lower(F.trim("add_issue")) == "true").alias("add_issue")
    )
    a, b = F.col("a"), F.col("b")
    both = F.array(*[F.struct(x.alias("country"), y.alias("other")) for x, y in ((a, b), (b, a), (a, a), (b, b))])
    return pair.select(F.explode(both).alias("p"), "add_issue").select("p.*", "add_issue").distinct()


def load_country_continents(spark: SparkSession, path: str, aliases: DataFrame | None = None) -> DataFrame:
    """``country, continents`` out of a file of ``country,continent`` lines with ``#`` comments.

    The order of the file is kept, since the first continent counts.  Countries may be written
    with three letters where ``aliases`` has their codes."""
    raw = spark.read.csv(path, schema="country string, continent string", comment="#")
    return country_continents(raw.withColumn("pos", F.monotonically_increasing_id()), aliases)


def country_continents(rows: DataFrame, aliases: DataFrame | None = None) -> DataFrame:
    """The same out of a table of ``country, continent, pos``.  The views look continents up by the
    code of two letters, so codes of three are replaced by it, through ``aliases``."""
    rows = rows.select(_upper("country").alias("country"), _upper("continent").alias("continent"), "pos")
    if aliases is not None:
        codes = aliases.select(_upper("iso3").alias("country"), _upper("iso2").alias("iso2")).where("country is not null and iso2 is not null")
        codes = codes.groupBy("country").agg(F.min("iso2").alias("iso2"))
        rows = rows.join(codes, "country", "left").select(F.coalesce("iso2", "country").alias("country"), "continent", "pos")
    return (
        rows.filter(~F.col("country").isin(*INTERNATIONAL_WATERS))
        .groupBy("country")
        .agg(F.sort_array(F.collect_list(F.struct("pos", "continent"))).alias("c"))
        .select("country", F.transform("c", lambda e: e["continent"]).alias("continents"))
    )


def load_vocabulary(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """Controlled vocabularies, one row per label, ready for lookups."""
    return prepare_vocabulary(spark.read.schema(VOCABULARY).format(fmt).load(path))
