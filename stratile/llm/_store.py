"""Tables and checkpoints in the shared folder that the session names in spark.checkpoint.dir."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The session's checkpoint folder. Where none is set, a temporary one serves a session of one machine; elsewhere that is an error."""
    context = spark.sparkContext
    folder = context.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if folder is None:
        if not re.match(r"local(\[|$)", context.master):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        folder = tempfile.mkdtemp(prefix="stratile-")
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(folder)
    return folder


def checkpointed(df: DataFrame) -> DataFrame:
    """Cut the lineage: the rows are written once to the shared folder, where every executor can read them."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def saved(df: DataFrame) -> DataFrame:
    """The same as a Parquet table, for results that several plans read column by column."""
    path = f"{shared_dir(df.sparkSession).rstrip('/')}/stratile-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
