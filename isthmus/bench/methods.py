"""Ways to move a table: the bridge's, and plainer ones to compare it with. Each returns the table it made."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from isthmus.bench.cases import Case, read_case
from isthmus.bench.runner import Method
from isthmus.plans import predicates as P
from isthmus.plans.scan import scan
from isthmus.sources.datasource import NAME, register
from isthmus.sources.tables import ParquetSide
from isthmus.sources.writer import create


def write_methods(case: Case, folder: str) -> dict[str, Method]:
    """Into a new table each time: the bridge's load, a plain append, and text files that are read back and loaded."""
    spark = case.df.sparkSession
    new = lambda: f"{folder}/{case.name}-{uuid.uuid4().hex[:8]}"

    def bridge() -> DataFrame:
        place = new()
        create(case.df, place, list(case.target))
        return spark.read.parquet(place)

    def plain() -> DataFrame:
        place = new()
        case.df.write.parquet(place)
        return spark.read.parquet(place)

    def csv() -> DataFrame:
        place = new()
        shape = {"timestampNTZFormat": "yyyy-MM-dd HH:mm:ss.SSSSSS", "nullValue": "\\N"}
        case.df.write.options(**shape).csv(f"{place}-csv")
        spark.read.schema(case.df.schema).options(**shape).csv(f"{place}-csv").write.parquet(place)
        return spark.read.parquet(place)

    return {"bridge": bridge, "append": plain, "csv": csv}


def made(spark: SparkSession, rows: int, columns: int, folder: str) -> str:
    """A read case as a table partitioned by day and key."""
    place = f"{folder}/read_{rows}_{columns}.parquet"
    read_case(spark, rows, columns).write.mode("overwrite").partitionBy("part_date", "sub_key").parquet(place)
    return place


def read_methods(spark: SparkSession, side_folder: str, table: str, day: str, target: str, sessions: int = 8) -> dict[str, Method]:
    """One day's rows into a new table: a scan, the named format, a plain read, and rows through Python one by one."""
    new = lambda: f"{target}/copy-{uuid.uuid4().hex[:8]}"

    def copied(df: DataFrame) -> DataFrame:
        place = new()
        df.write.parquet(place)
        return spark.read.parquet(place)

    def bridge() -> DataFrame:
        return copied(scan(ParquetSide(spark, side_folder), f'"{table}"', where=P.Local(f"part_date = DATE '{day}'"), n_sessions=sessions)[0])

    def plain() -> DataFrame:
        return copied(spark.read.parquet(f"{side_folder}/{table}.parquet").filter(F.col("part_date") == F.lit(day).cast("date")))

    def by_rows() -> DataFrame:
        df = spark.read.parquet(f"{side_folder}/{table}.parquet").filter(F.col("part_date") == F.lit(day).cast("date"))
        return copied(spark.createDataFrame(df.rdd.map(tuple), df.schema))

    return {"bridge": bridge, "plain": plain, "rows": by_rows}


def format_copy(spark: SparkSession, folder: str, table: str, sessions: int) -> DataFrame:
    """A table through the named format."""
    register(spark)
    return spark.read.format(NAME).options(folder=folder, table=f'"{table}"', sessions=str(sessions)).load()


def segments(spark: SparkSession, days: int, keys: int, target_rows: int, folder: str) -> str:
    """A table of days x keys folders of one row, and one folder of many: what pruning must leave out."""
    n = F.col("id")
    small = spark.range(days * keys).select((n + target_rows).alias("id"), F.date_add(F.lit("2024-01-01").cast("date"), (n / keys).cast("int")).alias("part_date"), (n % keys).cast("string").alias("sub_key"))
    big = spark.range(target_rows).select("id", F.lit("2025-01-01").cast("date").alias("part_date"), F.lit("0").alias("sub_key"))
    place = f"{folder}/segments.parquet"
    small.unionAll(big).repartition("part_date", "sub_key").write.mode("overwrite").partitionBy("part_date", "sub_key").parquet(place)
    return place
