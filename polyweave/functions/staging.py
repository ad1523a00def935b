"""Cutting lineage in loops."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame


def materialised(df: DataFrame) -> DataFrame:
    """df from a checkpoint in the folder that spark.checkpoint.dir names. RuntimeError where it is unset, but for a local master, which gets a folder of its own."""
    sc = df.sparkSession.sparkContext
    if sc.getCheckpointDir() is None:
        folder = df.sparkSession.conf.get("spark.checkpoint.dir", None)
        if folder is None and not sc.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir is not set: checkpoints need a folder that all executors share")
        sc.setCheckpointDir(folder or tempfile.mkdtemp(prefix="polyweave-"))
    return df.checkpoint()
