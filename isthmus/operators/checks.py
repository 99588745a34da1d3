"""Checksums of tables, and what two tables do not share."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def checksum(df: DataFrame) -> DataFrame:
    """One row: rows, and per column its nulls and a sum that does not depend on order, in one pass."""
    sums = [F.count("*").alias("n_rows")]
    for f in df.schema:
        c = F.col(f"`{f.name}`")
        sums.append(F.count_if(c.isNull()).alias(f"{f.name}_nulls"))
        if isinstance(f.dataType, (T.IntegralType, T.DecimalType)):
            sums.append(F.sum(c.cast("decimal(38,4)")).alias(f"{f.name}_sum"))
        elif isinstance(f.dataType, (T.FloatType, T.DoubleType)):
            # the bits of doubles are summed, as sums of doubles depend on their order
            sums.append(F.sum(F.xxhash64(c.cast("double")).cast("decimal(38,0)")).alias(f"{f.name}_sum"))
        elif isinstance(f.dataType, T.StringType):
            sums.append(F.sum(F.length(c).cast("long")).alias(f"{f.name}_sum"))
        elif isinstance(f.dataType, (T.DateType, T.TimestampNTZType)):
            sums.append(F.sum(F.unix_micros(c.cast("timestamp")).cast("decimal(38,0)")).alias(f"{f.name}_sum"))
    return df.agg(*sums)


def difference(a: DataFrame, b: DataFrame, duplicates: bool = True) -> DataFrame:
    """Rows of either table that the other has not (or, with duplicates, has less often)."""
    return a.exceptAll(b).unionAll(b.exceptAll(a)) if duplicates else a.subtract(b).unionAll(b.subtract(a))
