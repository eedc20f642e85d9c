"""What the operators share: tables kept in the folder that all machines see, and row ids."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


#: Whether Spark deletes the shuffle files of a statement at its end.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def shared_folder(spark: SparkSession) -> str:
    """The checkpoint folder of the cluster (``spark.checkpoint.dir``).  Only a session that runs
    in one process and names none (a test) gets a folder of its own."""
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        folder = sc.getConf().get("spark.checkpoint.dir")
        if folder is None:
            if not sc.master.startswith("local["):
                raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
            folder = tempfile.mkdtemp(prefix="llm-checkpoints-")
        sc.setCheckpointDir(folder)
    return sc.getCheckpointDir()


def ship(spark: SparkSession) -> SparkSession:
    """Let Python workers import this package from where the driver found it.  Needed only where
    the package is not installed on the executors."""
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    paths = spark.sparkContext.environment.get("PYTHONPATH", "").split(os.pathsep)
    if root not in paths:
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join([root, *filter(None, paths)])
    return spark


def keep(df: DataFrame, name: str, shuffles: bool = True) -> DataFrame:
    """Write a table to the shared folder and read it again: later steps start from there, also
    after executors were lost.  Tables stay until the folder is cleared with its application.
    ``shuffles``: leave the files of the shuffles before it to Spark, which deletes them at some
    time; else they are deleted when the table is written."""
    spark = df.sparkSession
    path = os.path.join(shared_folder(spark), f"{name}-{uuid.uuid4().hex}")
    before = spark.conf.get(CLEANUP, "false")
    if not shuffles:
        spark.conf.set(CLEANUP, "true")
    try:
        df.write.option("compression", "zstd").parquet(path)
    finally:
        if not shuffles:
            spark.conf.set(CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path)


def columns_as(df: DataFrame, **names: str) -> DataFrame:
    """Only the named columns, under the names that an operator uses, whatever else the table has."""
    return df.select(*[df[source].alias(target) for target, source in names.items()])


def doc_text(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Ids as bigint and texts as string, null text as empty."""
    ship(df.sparkSession)
    return df.select(df[id_col].cast("bigint").alias("doc_id"), F.coalesce(df[text_col].cast("string"), F.lit("")).alias("text"))


def tokens(text: Column) -> Column:
    """The words of a text: runs of anything but ASCII white space; never holds empty words."""
    return F.filter(F.split(text, "[\\x20\\x09-\\x0D]+"), lambda w: w != "")
