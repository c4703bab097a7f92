"""How many partitions a sort of a frame needs."""

from __future__ import annotations

from pyspark.sql import DataFrame

#: Bytes of input, as Spark estimates them from its files, for one partition.
PARTITION_BYTES = 8 << 20
#: Estimates beyond this are Spark's way to say that it does not know.
UNKNOWN_BYTES = 1 << 50


def sort_partitions(df: DataFrame) -> int:
    """Partitions for a sort of `df`: those of the session, more where its input is known to be larger than they hold well."""
    estimated = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    usual = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return usual if estimated > UNKNOWN_BYTES else max(usual, -(-estimated // PARTITION_BYTES))
