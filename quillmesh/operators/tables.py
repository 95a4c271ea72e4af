"""Intermediate tables."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame


def kept(df: DataFrame) -> DataFrame:
    """``df`` checkpointed, so that later plans start from it and a lost executor costs a re-read.

    The folder is the one that ``spark.checkpoint.dir`` names.  Only a local session
    without one gets a folder of this machine; a cluster without one is refused.
    """
    spark = df.sparkSession
    sc, folder = spark.sparkContext, spark.conf.get("spark.checkpoint.dir", None)
    if sc.getCheckpointDir() is None:
        if folder is None and not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        sc.setCheckpointDir(folder or tempfile.mkdtemp(prefix="quillmesh-"))
    return df.checkpoint()


def scratch(spark) -> str:
    """The folder for what is not a table: as for :func:`kept`."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder is None and not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    return folder or tempfile.mkdtemp(prefix="quillmesh-")
