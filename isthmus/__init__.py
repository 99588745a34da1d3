"""A relational bridge for Spark, with operators for training data."""

from __future__ import annotations

from typing import TYPE_CHECKING

if TYPE_CHECKING:
    from pyspark.sql import SparkSession


def driver_version(spark: SparkSession, url: str | None = None) -> str:
    """The engine that reads files, or the driver of a database by its URL, with versions."""
    if url is None:
        import pyarrow

        return f"Spark {spark.version}, Arrow {pyarrow.__version__}"
    from isthmus.sources.jdbc import JdbcSide

    return JdbcSide(spark, url).version()


def register_functions(spark: SparkSession) -> None:
    """Makes ``isthmus_driver_version()`` and the named format known to a session."""
    from isthmus.sources.datasource import register

    text = driver_version(spark)
    spark.udf.register("isthmus_driver_version", lambda: text, "string")
    register(spark)
