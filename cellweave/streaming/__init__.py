"""Files that keep arriving."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from ..sources.flatfiles import MOLECULES, slide_of_path


def arriving_molecules(spark: SparkSession, root: str, pattern: str = "*_tx_file*", files_per_batch: int = 100) -> DataFrame:
    """Molecule files as they are delivered, with the name of their slide's folder."""
    stream = spark.readStream.option("header", True).option("maxFilesPerTrigger", files_per_batch).schema(MOLECULES)
    return stream.csv(f"{root}/*/{pattern}").withColumn("Run_Tissue_name", slide_of_path())


def keep(stream: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Append a stream to a Parquet table partitioned by slide, each file once; ends when all present files are in."""
    writer = stream.writeStream.format("parquet").partitionBy("Run_Tissue_name").option("checkpointLocation", checkpoint)
    return writer.trigger(availableNow=True).start(path)
