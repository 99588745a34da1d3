"""Exact numbers: canonical text, rounding, checked casts, and the base-100 number format of the remote side."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

MAX_DIGITS = 20  # base-100 digits of a remote number


def canonical_text(value: Column) -> Column:
    """A decimal without exponent, trailing zeros or a bare leading point."""
    text = value.cast("string")
    plain = F.when(text.contains("."), F.regexp_replace(F.regexp_replace(text, "0+$", ""), r"\.$", "")).otherwise(text)
    return F.when(plain == "-0", F.lit("0")).otherwise(plain)


def half_away(value: Column, precision: int, scale: int) -> Column:
    """Rounded half away from zero to decimal(precision, scale)."""
    return F.round(value, scale).try_cast(f"decimal({precision},{scale})")


def exact_decimal(value: Column, precision: int, scale: int, name: str) -> Column:
    """A cast that raises, naming the column, where the value does not fit or loses digits."""
    kind = f"decimal({precision},{scale})"
    cast = value.try_cast(kind)
    fail = F.raise_error(F.concat(F.lit(f"column {name}: "), value.cast("string"), F.lit(f" is not exact in DECIMAL({precision},{scale})")))
    return F.when(value.isNull() | (cast == value), cast).otherwise(fail.cast(kind))


def rounded_decimal(value: Column, precision: int, scale: int, name: str) -> Column:
    """As exact_decimal, but digits beyond the scale are rounded half away from zero."""
    return exact_decimal(half_away(value, 38, scale), precision, scale, name)


def encode_number(value: int, scale: int = 0) -> bytes:
    """value / 10**scale in the remote format: an exponent byte and base-100 digits; b'' if it needs more than MAX_DIGITS."""
    if value == 0:
        return b"\x80"
    digits, power = abs(value), -scale
    if power % 2:
        digits, power = digits * 10, power - 1
    pairs: list[int] = []
    while digits:
        digits, d = divmod(digits, 100)
        pairs.append(d)
    while pairs[0] == 0:
        pairs.pop(0)
        power += 2
    if len(pairs) > MAX_DIGITS:
        return b""
    exponent = len(pairs) + power // 2 - 1
    if not -65 <= exponent <= 62:
        return b""
    pairs.reverse()
    if value > 0:
        return bytes([exponent + 193, *(d + 1 for d in pairs)])
    return bytes([62 - exponent, *(101 - d for d in pairs)]) + (b"\x66" if len(pairs) < MAX_DIGITS else b"")


def decode_number(raw: bytes) -> Decimal | None:
    """The inverse of encode_number; None for a null, an infinity raises."""
    if not raw:
        return None
    if raw == b"\x80":
        return Decimal(0)
    if raw in (b"\xff\x65", b"\x00"):
        raise ValueError("infinite number")
    head, tail = raw[0], raw[1:]
    if head & 0x80:
        exponent, pairs, sign = head - 193, [b - 1 for b in tail], 1
    else:
        exponent, pairs, sign = 62 - head, [101 - b for b in (tail[:-1] if tail[-1:] == b"\x66" else tail)], -1
    if not pairs or len(pairs) > MAX_DIGITS or any(not 0 <= d <= 99 for d in pairs):
        raise ValueError("malformed number")
    n = 0
    for d in pairs:
        n = n * 100 + d
    return sign * Decimal(n).scaleb(2 * (exponent - len(pairs) + 1))


def scaled(raw: bytes, scale: int, digits: int, rounds: bool = False) -> tuple[int, str]:
    """A remote number as value * 10**scale and a status: ok, inexact (digits beyond the scale, if they may not be rounded), overflow (more
    digits than that) or infinity. With ``rounds`` half goes away from zero."""
    if raw in (b"\xff\x65", b"\x00"):
        return 0, "infinity"
    value = decode_number(raw)
    if value is None:
        return 0, "ok"
    sign, figures, exponent = value.as_tuple()
    n, shift = int("".join(map(str, figures))), exponent + scale
    if shift >= 0:
        n *= 10**shift
    else:
        whole, rest = divmod(n, 10**-shift)
        if rest and not rounds:
            return 0, "inexact"
        n = whole + (2 * rest >= 10**-shift)
    return (0, "overflow") if n >= 10**digits else (-n if sign else n, "ok")
