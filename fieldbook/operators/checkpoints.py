"""Cutting lineage on reliable storage."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The folder the cluster names in ``spark.checkpoint.dir``, which every executor reaches.
    Without that setting it fails, except in a session of a single process (a test), which gets a
    folder of its own."""
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if folder is None and not context.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        context.setCheckpointDir(folder or tempfile.mkdtemp(prefix="run-"))
    return context.getCheckpointDir()


def materialize(df: DataFrame) -> DataFrame:
    """Compute once and go on from the rows stored in the shared folder, so that a lost executor
    costs a re-read and no re-run."""
    shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)
