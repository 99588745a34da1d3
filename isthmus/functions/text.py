"""Text: bytes that must be UTF-8, and padding."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def first_invalid(raw: bytes) -> int | None:
    """The place of the first byte that is not UTF-8, or None."""
    try:
        raw.decode("utf-8")
    except UnicodeDecodeError as e:
        return e.start
    return None


def valid_utf8(value: Column, name: str) -> Column:
    """Binary as text, or an error with the column and the byte where the text first fails."""
    text = value.cast("string")
    made = F.make_valid_utf8(text)  # a replacement character stands where bytes are wrong
    before = F.octet_length(F.substring(made, F.lit(1), F.instr(made, "\ufffd") - 1))
    fail = F.raise_error(F.concat(F.lit(f"column {name}: invalid UTF-8 at byte "), before.cast("string")))
    return F.when(value.isNull() | F.is_valid_utf8(text), text).otherwise(fail.cast("string"))
