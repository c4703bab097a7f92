"""Where intermediate results go when lineage has to be cut.

On a cluster the folder is the one in spark.checkpoint.dir, which every executor reaches. Only a local
session without that setting gets a folder of its own; a cluster session without it is refused, since a
machine-local folder would lose data with its machine.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def checkpoint_dir(spark: SparkSession) -> str:
    """The session's checkpoint folder, made known to the Spark context if it is not yet."""
    context = spark.sparkContext
    shared = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if shared is None:
        if not context.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        shared = tempfile.mkdtemp(prefix="spark-")
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared)
    return shared


def cut(df: DataFrame) -> DataFrame:
    """`df` written to the checkpoint folder and read from there: survives the loss of executors."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint()


def saved(df: DataFrame) -> DataFrame:
    """`df` as a parquet table in the checkpoint folder: like `cut`, smaller for wide or repetitive rows."""
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark).rstrip('/')}/table-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
