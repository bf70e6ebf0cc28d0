"""Landed files taken in micro-batches: each file once, each row once."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from chronodiff.sources.store import insert_absent


def landed(spark: SparkSession, folder: str, schema: T.StructType | str, files: int = 1000, form: str = "parquet") -> DataFrame:
    """The files of a folder as a stream, at most ``files`` a batch."""
    return spark.readStream.schema(schema).option("recursiveFileLookup", True).option("maxFilesPerTrigger", files).format(form).load(folder)


def ingest(stream: DataFrame, table: str, key: str, checkpoint: str) -> None:
    """Appends all that has landed so far to a table and returns; a row whose key is there isn't written again, so a batch that is
    repeated after a failure changes nothing. ``checkpoint`` remembers which files were read."""

    def one(batch: DataFrame, _: int) -> None:
        insert_absent(batch, table, key)

    stream.writeStream.foreachBatch(one).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()


def replay(stream: DataFrame, table: str, checkpoint: str) -> None:
    """Appends the rows of a (stateful) stream over all that has landed so far to a table and returns."""
    stream.writeStream.format("parquet").option("path", table).option("checkpointLocation", checkpoint).outputMode("append").trigger(availableNow=True).start().awaitTermination()
