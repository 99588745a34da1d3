"""How a stored column is told as its remote type's Spark type: exact or an error that names the column."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from isthmus.functions.numeric import canonical_text, exact_decimal, rounded_decimal
from isthmus.functions.text import valid_utf8
from isthmus.sources.types import RemoteColumn, read_type

WIDTHS = {"short": 4, "integer": 9, "long": 18}


def loose(c: RemoteColumn) -> bool:
    """NUMBER without precision and scale, and FLOAT: numbers that only an option gives a type."""
    return c.data_type.upper() == "FLOAT" or c.data_type.upper() == "NUMBER" and c.precision is None and c.scale is None


def decoded(c: RemoteColumn, physical: T.DataType, unconstrained_number: str = "DOUBLE") -> Column | None:
    """The column as read_type() says, by kind: loose numbers are rounded or written out as the option asks, other numbers must fit
    exactly, CHAR is padded, text must be UTF-8, dates become timestamps without zone. None where it is so as it is stored."""
    target, value = read_type(c, unconstrained_number), F.col(f"`{c.name}`")
    if loose(c):
        return _loose(value, physical, target, c.name)
    if physical == target:
        return F.rpad(value, c.length, " ") if c.data_type.upper() in ("CHAR", "NCHAR") and c.length else None
    if isinstance(physical, T.BinaryType) and isinstance(target, T.StringType):
        return valid_utf8(value, c.name)
    if isinstance(target, T.DecimalType):
        return exact_decimal(value, target.precision, target.scale, c.name)
    if isinstance(target, T.IntegralType) and c.data_type.upper() == "NUMBER":
        return exact_decimal(value, WIDTHS[target.typeName()], 0, c.name).cast(target)
    return value.cast(target)


def _loose(value: Column, physical: T.DataType, target: T.DataType, name: str) -> Column | None:
    if physical == target:
        return None
    if isinstance(target, T.StringType):
        return canonical_text(value if isinstance(physical, (T.DecimalType, T.IntegralType)) else value.cast("string").cast("decimal(38,18)"))
    if isinstance(target, T.DecimalType):
        exact = value.cast("decimal(38,0)") if isinstance(physical, T.IntegralType) else value if isinstance(physical, T.DecimalType) else value.cast("string").cast("decimal(38,18)")
        return rounded_decimal(exact, target.precision, target.scale, name)
    return value.cast(target)
