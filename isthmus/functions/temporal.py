"""Dates and timestamps without a time zone, to the microsecond; and the remote side's bytes of them."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import Column
from pyspark.sql import functions as F

DAY = 86_400_000_000
EPOCH = datetime(1970, 1, 1)


def as_micros(ts: Column) -> Column:
    """Microseconds since 1970; sessions run in UTC."""
    return F.unix_micros(ts.cast("timestamp"))


def from_micros(us: Column) -> Column:
    return F.timestamp_micros(us).cast("timestamp_ntz")


def whole_seconds(ts: Column) -> Column:
    return F.date_trunc("SECOND", ts).cast("timestamp_ntz")


def text_of(ts: Column) -> Column:
    """26 characters, with six decimals."""
    return F.date_format(ts, "yyyy-MM-dd HH:mm:ss.SSSSSS")


def days(ts: Column) -> Column:
    """Days since 1970 in the proleptic Gregorian calendar."""
    return F.unix_date(ts.cast("date")).cast("long")


def date_of_days(n: Column) -> Column:
    """The inverse of days()."""
    return F.date_from_unix_date(n.cast("int"))


def split_micros(us: Column) -> tuple[Column, Column]:
    """Whole days since 1970 (rounded down) and the microseconds of that day."""
    return F.floor(us / F.lit(DAY)).cast("long"), F.pmod(us, F.lit(DAY)).cast("long")


def in_range(ts: Column) -> Column:
    """True for the years 1 to 9999, which targets hold."""
    return F.year(ts).between(1, 9999)


def encode_date(value: datetime) -> bytes:
    """Seven bytes: century and year of it plus 100, month, day, and hour, minute, second plus 1. Parts of a second are lost."""
    return bytes([value.year // 100 + 100, value.year % 100 + 100, value.month, value.day, value.hour + 1, value.minute + 1, value.second + 1])


def decode_date(raw: bytes) -> datetime:
    if len(raw) != 7:
        raise ValueError(f"a date has 7 bytes, not {len(raw)}")
    century, year, month, day, hour, minute, second = raw
    if not (1 <= century - 100 <= 99 or century == 100) or not 0 <= year - 100 <= 99:
        raise ValueError("date outside the years 1 to 9999")
    return datetime((century - 100) * 100 + year - 100, month, day, hour - 1, minute - 1, second - 1)


def encode_timestamp(value: datetime) -> bytes:
    """The seven bytes of a date, and four of nanoseconds unless they are zero."""
    return encode_date(value) + ((value.microsecond * 1000).to_bytes(4, "big") if value.microsecond else b"")


def decode_timestamp(raw: bytes) -> datetime:
    """Seven or eleven bytes; nanoseconds are cut to microseconds."""
    if len(raw) not in (7, 11):
        raise ValueError(f"a timestamp has 7 or 11 bytes, not {len(raw)}")
    nanos = int.from_bytes(raw[7:], "big")
    if nanos >= 10**9:
        raise ValueError(f"{nanos} nanoseconds")
    return decode_date(raw[:7]) + timedelta(microseconds=nanos // 1000)
