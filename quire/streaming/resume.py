"""Files as a stream: each is processed once, and a second run sees only what is new."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

BINARY = "path string, modificationTime timestamp, length bigint, content binary"


def process_new(spark: SparkSession, source: str, target: str, checkpoint: str, process: Callable[[DataFrame], DataFrame], glob: str = "*") -> None:
    """Run process over the files of source that no earlier run has seen; append its rows to target as Parquet.

    The checkpoint folder remembers what was seen; batches that fail are done again as a whole.
    """
    files = spark.readStream.format("binaryFile").schema(BINARY).option("pathGlobFilter", glob).load(source)
    query = process(files).writeStream.format("parquet").option("path", target).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()


def process_new_rows(spark: SparkSession, source: str, schema: str, target: str, checkpoint: str, process: Callable[[DataFrame], DataFrame]) -> None:
    """The same over Parquet files."""
    rows = spark.readStream.schema(schema).parquet(source)
    process(rows).writeStream.format("parquet").option("path", target).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()
