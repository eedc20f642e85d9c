"""Verbatim records in, interpreted views out."""

from __future__ import annotations

import re
import uuid
from collections.abc import Mapping, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fieldbook.schema import VERBATIM


#: Column of the text of a record that could not be read.
UNREADABLE = "_unreadable"

_NAME = re.compile(r"[A-Za-z_]\w*")


def read_verbatim(spark: SparkSession, path: str, fmt: str = "parquet", unreadable: bool = False, **options) -> DataFrame:
    """Verbatim records in the fixed schema, as Parquet, JSON, ORC or, where the Avro module is on
    the class path, Avro.

    With ``unreadable``, a line of JSON that is none, or does not have the shape of a record, is a
    row with its text in :data:`UNREADABLE`, which ``interpret`` turns into a reject; without it,
    such a line is a record without id."""
    schema = VERBATIM
    if unreadable and fmt == "json":
        schema = T.StructType([*VERBATIM.fields, T.StructField(UNREADABLE, T.StringType())])
        options = {**options, "mode": "PERMISSIVE", "columnNameOfCorruptRecord": UNREADABLE}
    try:
        return spark.read.schema(schema).format(fmt).options(**options).load(path)
    except AnalysisException as e:
        if fmt == "avro":
            raise RuntimeError("reading Avro needs the spark-avro module on the class path") from e
        raise


def split_readable(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Records that were read, and the others with the reason and their text as ``raw``."""
    if UNREADABLE not in df.columns:
        return df, df.limit(0).withColumns({"reason": F.lit(""), "raw": F.lit(None).cast("string")})
    bad = df.filter(F.col(UNREADABLE).isNotNull())
    rejects = bad.withColumn("reason", F.lit("RECORD_UNREADABLE")).withColumnRenamed(UNREADABLE, "raw")
    return df.filter(F.col(UNREADABLE).isNull()).drop(UNREADABLE), rejects


def _files(spark: SparkSession, path: str):
    """The file system of a path, and the path as one of its own."""
    jvm = spark.sparkContext._jvm
    at = jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), at


def write_views(views: Mapping[str, DataFrame], out: str, fmt: str = "parquet", buckets: int | None = None) -> None:
    """Write each view to its own folder below ``out``, replacing all that is there.

    The views are written next to ``out`` first; once all of them are complete, the folder gets its
    name.  A run that fails before leaves the views of the run before it as they were.  With
    ``buckets``, the rows of an id lie in the same bucket of every view, in order, so that
    :func:`read_views` gives tables that are joined by id without being shuffled."""
    for name in views:
        if not _NAME.fullmatch(name):
            raise ValueError(f"a view needs a plain name, not {name!r}")
    spark = next(iter(views.values())).sparkSession
    run = uuid.uuid4().hex
    staged, former = f"{out.rstrip('/')}.{run}.new", f"{out.rstrip('/')}.{run}.old"
    for name, view in views.items():
        if buckets is None or "id" not in view.columns:
            view.write.format(fmt).save(f"{staged}/{name}")
            continue
        # One task per bucket, so one file per bucket.
        dealt = view.repartition(buckets, "id").sortWithinPartitions("id")
        made = f"staged_{name}_{run}"
        dealt.write.format(fmt).bucketBy(buckets, "id").sortBy("id").option("path", f"{staged}/{name}").saveAsTable(made)
        spark.sql(f"DROP TABLE {made}")  # the files stay
    fs, new = _files(spark, staged)
    _, target = _files(spark, out)
    _, old = _files(spark, former)
    if fs.exists(target):
        fs.rename(target, old)
    if not fs.rename(new, target):
        raise OSError(f"could not rename {staged} to {out}")
    fs.delete(old, True)


def read_views(spark: SparkSession, out: str, names: Sequence[str], buckets: int | None = None, fmt: str = "parquet") -> dict[str, DataFrame]:
    """The views that :func:`write_views` wrote, with the same ``buckets``."""
    found = {}
    for name in names:
        plain = spark.read.format(fmt).load(f"{out}/{name}")
        if buckets is None or "id" not in plain.columns:
            found[name] = plain
            continue
        table = f"view_{name}_{uuid.uuid4().hex}"
        fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in plain.schema.fields)
        spark.sql(f"CREATE TABLE {table} ({fields}) USING {fmt} CLUSTERED BY (id) SORTED BY (id) INTO {buckets} BUCKETS LOCATION '{out}/{name}'")
        found[name] = spark.table(table)
    return found


def to_json_lines(view: DataFrame, out: str = "json") -> DataFrame:
    """The id and the whole row as one JSON document."""
    return view.select("id", F.to_json(F.struct("*")).alias(out))


def write_json(view: DataFrame, path: str) -> None:
    """Write a view as JSON lines, replacing what is there."""
    view.write.mode("overwrite").json(path)
