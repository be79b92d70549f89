"""Intermediate tables that outlive an executor."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The folder every node can reach, as named by ``spark.checkpoint.dir``.

    Only a session in one process (``local`` or ``local[...]``) without the
    setting gets a folder of its own.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if folder:
        return folder
    if not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all nodes share")
    spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="pairwright-"))
    return spark.sparkContext.getCheckpointDir()


def new_path(spark: SparkSession, label: str) -> str:
    return f"{shared_folder(spark).rstrip('/')}/pairwright/{label}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` as a table in the shared folder and read it back.

    Cuts the lineage: a lost executor costs a re-read, not a recomputation,
    and later readers get column pruning and real file sizes.
    """
    spark = df.sparkSession
    path = new_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
