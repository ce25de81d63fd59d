"""Cutting lineage: tables in the folder that driver and executors share."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame


def checkpointed(df: DataFrame) -> DataFrame:
    """df from spark.checkpoint.dir, so that a lost executor costs nothing before it; a folder of our own only on a local master where it is unset."""
    spark = df.sparkSession
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        named = spark.conf.get("spark.checkpoint.dir", None)
        if named is None and not (context.master or "").startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        context.setCheckpointDir(named or f"file://{tempfile.mkdtemp(prefix='lodeframe-')}")
    return df.checkpoint()
