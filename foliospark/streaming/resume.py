"""Incremental runs: files are read once, each batch appends its rows; a restart goes on from the checkpoint."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery


def archives(spark: SparkSession, folder: str, glob: str = "*.gz") -> DataFrame:
    return spark.readStream.format("binaryFile").option("pathGlobFilter", glob).schema("path string, modificationTime timestamp, length long, content binary").load(folder)


def process(stream: DataFrame, work: Callable[[DataFrame], DataFrame], out: str, checkpoint: str) -> StreamingQuery:
    """Runs work on each batch of new rows; a batch that is repeated after a failure overwrites its own folder."""

    def batch(df: DataFrame, epoch: int) -> None:
        work(df).write.mode("overwrite").parquet(f"{out}/batch={epoch}")

    return stream.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
