"""Remote column types and the Spark types that hold them exactly."""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import types as T

from isthmus.sources.names import BridgeError


@dataclass(frozen=True)
class RemoteColumn:
    """A column as the remote dictionary tells it; precision and scale are None where it has none."""

    name: str
    data_type: str
    length: int = 0
    precision: int | None = None
    scale: int | None = None
    nullable: bool = True
    national: bool = False
    collation: str = ""


def unconstrained(option: str) -> T.DataType:
    """Where NUMBER without precision goes: DOUBLE, VARCHAR or DECIMAL(p,s)."""
    o = option.strip().upper()
    if o == "DOUBLE":
        return T.DoubleType()
    if o == "VARCHAR":
        return T.StringType()
    m = re.fullmatch(r"DECIMAL\(\s*(\d+)\s*,\s*(\d+)\s*\)", o)
    if m and 1 <= int(m[1]) <= 38 and int(m[2]) <= int(m[1]):
        return T.DecimalType(int(m[1]), int(m[2]))
    raise BridgeError(f"unconstrained_number {option!r}: use DOUBLE, VARCHAR or DECIMAL(p,s)")


def _number(c: RemoteColumn, option: str) -> T.DataType:
    if c.precision is None and c.scale is None:
        return unconstrained(option)
    p, s = c.precision or 38, c.scale or 0
    if s == 0:
        return T.ShortType() if p <= 4 else T.IntegerType() if p <= 9 else T.LongType() if p <= 18 else T.DecimalType(p, 0)
    width, scale = (p - s, 0) if s < 0 else (max(p, s), s)
    return T.DecimalType(width, scale) if width <= 38 else T.DoubleType()


def read_type(c: RemoteColumn, option: str = "DOUBLE") -> T.DataType | None:
    """None for types that can be named but not read."""
    t = c.data_type.upper()
    if t == "NUMBER":
        return _number(c, option)
    if t == "FLOAT":
        return unconstrained(option)
    if t.startswith("TIMESTAMP"):
        return T.TimestampType() if "TIME ZONE" in t else T.TimestampNTZType()
    simple = {"BINARY_FLOAT": T.FloatType(), "BINARY_DOUBLE": T.DoubleType(), "DATE": T.TimestampNTZType(), "RAW": T.BinaryType(), "BLOB": T.BinaryType()}
    if t in simple:
        return simple[t]
    return T.StringType() if t in ("VARCHAR2", "CHAR", "NVARCHAR2", "NCHAR", "CLOB", "NCLOB", "ROWID", "UROWID") else None


def write_fits(source: T.DataType, target: RemoteColumn) -> bool:
    """Whether a Spark column may be loaded into a target column."""
    t = target.data_type.upper()
    if isinstance(source, (T.BooleanType, T.IntegralType, T.DecimalType)):
        return t in ("NUMBER", "FLOAT")
    if isinstance(source, (T.FloatType, T.DoubleType)):
        return t in ("BINARY_FLOAT", "BINARY_DOUBLE", "NUMBER")
    if isinstance(source, T.StringType):
        return t in ("VARCHAR2", "CHAR")
    return isinstance(source, (T.DateType, T.TimestampNTZType)) and (t == "DATE" or t.startswith("TIMESTAMP") and "TIME ZONE" not in t)


def number_limits(c: RemoteColumn) -> tuple[int, int] | None:
    """(digits before the point, digits after it, negative where they are rounded away) that a NUMBER column holds; None if any."""
    if c.precision is None and c.scale is None:
        return None
    scale = c.scale or 0
    return (c.precision or 38) - scale, scale
