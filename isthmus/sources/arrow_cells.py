"""Arrow columns as a target column holds them, or an error that names the column: what writer.checked() does for Spark columns."""

from __future__ import annotations

import pyarrow as pa
import pyarrow.compute as pc

from isthmus.sources.names import BridgeError
from isthmus.sources.types import RemoteColumn, number_limits

YEAR_1, YEAR_10000 = -62_135_596_800_000_000, 253_402_300_800_000_000


def fitted(values: pa.Array, target: RemoteColumn, stored: pa.DataType) -> pa.Array:
    t, kind = target.data_type.upper(), values.type

    def fail(what: str, bad: pa.Array) -> None:
        if pc.any(bad).as_py():
            raise BridgeError(f"column {target.name}: {what}: {values.filter(pc.fill_null(bad, False))[0].as_py()!r}")

    if pa.types.is_string(kind) or pa.types.is_large_string(kind):
        values = pc.if_else(pc.equal(values, ""), pa.scalar(None, kind), values)
        if target.length:
            fail(f"longer than {target.length} bytes", pc.greater(pc.binary_length(values), target.length))
        if t in ("CHAR", "NCHAR") and target.length:
            values = pc.utf8_rpad(values, target.length, " ")
    elif pa.types.is_boolean(kind):
        values = values.cast(pa.int8())
    elif pa.types.is_floating(kind) and t in ("NUMBER", "FLOAT"):
        fail("not finite", pc.invert(pc.is_finite(values)))
    elif pa.types.is_timestamp(kind):
        us = values.cast(pa.timestamp("us")).cast(pa.int64())
        fail("year outside 1 to 9999", pc.or_(pc.less(us, YEAR_1), pc.greater_equal(us, YEAR_10000)))
        if t == "DATE":
            values = pc.floor_temporal(values, unit="second")
    elif pa.types.is_date(kind):
        us = values.cast(pa.timestamp("s")).cast(pa.int64())
        fail("year outside 1 to 9999", pc.or_(pc.less(us, YEAR_1 // 10**6), pc.greater_equal(us, YEAR_10000 // 10**6)))
    if t == "NUMBER" and (limits := number_limits(target)):
        whole, scale = limits
        numbers = values.cast(pa.decimal128(38, max(0, scale))) if not pa.types.is_floating(values.type) and not pa.types.is_decimal(values.type) else values
        try:
            if pa.types.is_decimal(numbers.type) and scale >= 0:
                numbers = pc.round(numbers, scale, "half_towards_infinity")
            values = numbers.cast(pa.decimal128(min(38, max(1, whole + max(scale, 0))), max(0, scale)))
        except pa.ArrowInvalid as e:
            raise BridgeError(f"column {target.name}: out of range for NUMBER({target.precision or '*'},{scale}): {e}") from e
    try:
        values = values.cast(stored)
    except pa.ArrowInvalid as e:
        raise BridgeError(f"column {target.name}: {e}") from e
    if not target.nullable:
        fail("null", pc.is_null(values))
    return values
