"""Incremental loads: new files of a source folder, appended to a table by micro-batches."""

from __future__ import annotations

from pyspark.sql import SparkSession

from isthmus.sources.types import RemoteColumn
from isthmus.sources.writer import load


def follow(spark: SparkSession, source: str, schema: object, folder: str, target: list[RemoteColumn], checkpoint: str, name: str = "batch"):
    """A query that loads what has come since its last run; each micro-batch is loaded whole or not at all, and once: the load carries the
    query's name and the batch's number, so a batch that is replayed after a crash finds itself done."""
    stream = spark.readStream.schema(schema).parquet(source)
    return stream.writeStream.foreachBatch(lambda df, n: load(df, folder, target, job=f"{name}-{n}")).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
