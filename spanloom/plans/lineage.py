"""Cutting lineage through storage that every executor shares."""

from __future__ import annotations

import gc
import tempfile

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """Folder for checkpoints: the one the session names, or a temporary one on a single machine.

    A session on a cluster must name its folder in ``spark.checkpoint.dir``; a
    machine-local folder there would be lost with its executor, so this raises.
    """
    sc = spark.sparkContext
    named = sc.getCheckpointDir() or sc.getConf().get("spark.checkpoint.dir")
    if not named:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        named = tempfile.mkdtemp(prefix="spanloom-checkpoint-")
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(named)
    return named


def cut(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared folder and go on from there, so that no lost executor is needed again."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def forget(spark: SparkSession) -> None:
    """Have shuffle files of frames that are no longer used deleted now, and checkpoints where the session cleans them: Spark does it only after the driver collects its garbage."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()
