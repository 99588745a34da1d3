"""Filters as trees, the rules of which may be pushed, their SQL text with binds, and their Spark columns.

A term is pushed only if the remote side gives the same rows for certain: constants that the column's own type holds exactly, columns
compared bare, binary string order, no empty strings (which the remote side takes for nulls). And, Or and In are pushed whole or not at
all; top-level And terms are judged one by one.
"""

from __future__ import annotations

import math
import operator
from collections.abc import Callable
from dataclasses import dataclass
from datetime import date, datetime, timedelta
from decimal import Decimal
from functools import reduce
from typing import Any

from pyspark.sql import Column
from pyspark.sql import functions as F

from isthmus.sources.names import literal, quote
from isthmus.sources.tables import TableInfo
from isthmus.sources.types import RemoteColumn

COMPARE = {"=": "=", "<>": "<>", "<": "<", "<=": "<=", ">": ">", ">=": ">="}
FLIP = {"=": "=", "<>": "<>", "<": ">", "<=": ">=", ">": "<", ">=": "<="}
MAX_IN, MAX_TEXT = 1000, 4000


class Term:
    def __and__(self, other: Term) -> Term:
        return All((self, other))

    def __or__(self, other: Term) -> Term:
        return Any_((self, other))


@dataclass(frozen=True)
class Compare(Term):
    column: str
    op: str
    value: Any

    @staticmethod
    def flipped(value: Any, op: str, column: str) -> Compare:
        return Compare(column, FLIP[op], value)


@dataclass(frozen=True)
class In(Term):
    column: str
    values: tuple


@dataclass(frozen=True)
class IsNull(Term):
    column: str
    negated: bool = False


@dataclass(frozen=True)
class OnDate(Term):
    """CAST(column AS DATE) = day."""

    column: str
    day: date


@dataclass(frozen=True)
class All(Term):
    terms: tuple[Term, ...]


@dataclass(frozen=True)
class Any_(Term):
    terms: tuple[Term, ...]


@dataclass(frozen=True)
class Local(Term):
    """Any Spark condition, never pushed."""

    condition: str


def between(column: str, low: Any, high: Any, inclusive: tuple[bool, bool] = (True, True)) -> Term:
    return All((Compare(column, ">=" if inclusive[0] else ">", low), Compare(column, "<=" if inclusive[1] else "<", high)))


@dataclass(frozen=True)
class Side:
    """What decides string comparisons on the remote side."""

    charset: str = "AL32UTF8"
    #: Whether blanks at the end of texts do not count when they are compared there.
    pads: bool = False


def kind_of(c: RemoteColumn) -> str:
    t = c.data_type.upper()
    if t == "NUMBER":
        return "number" if c.precision is not None or c.scale is not None else "loose"
    if t in ("BINARY_FLOAT", "BINARY_DOUBLE"):
        return "float"
    if t == "DATE":
        return "date"
    if t.startswith("TIMESTAMP") and "TIME ZONE" not in t:
        digits = t[t.find("(") + 1 : t.find(")")] if "(" in t else "6"
        return "timestamp" if digits.isdigit() and int(digits) <= 6 else "other"
    return {"VARCHAR2": "text", "CHAR": "text", "NVARCHAR2": "text", "NCHAR": "text", "CLOB": "lob", "NCLOB": "lob", "BLOB": "lob"}.get(t, "other")


def exact_in(v: Any, precision: int, scale: int) -> bool:
    """Whether a number is an integer or decimal that NUMBER(precision, scale) holds as it is."""
    if isinstance(v, bool) or not isinstance(v, (int, Decimal)) or not Decimal(v).is_finite():
        return False
    _, digits, exponent = Decimal(v).as_tuple()
    number = int("".join(map(str, digits)))
    while number and number % 10 == 0:
        number, exponent = number // 10, exponent + 1
    return number == 0 or exponent >= -scale and len(str(number)) + exponent + scale <= precision


def constant_fits(c: RemoteColumn, op: str, v: Any, side: Side) -> bool:
    kind = kind_of(c)
    if v is None or isinstance(v, bool):
        return False
    if kind == "number":
        return exact_in(v, c.precision or 38, c.scale or 0)
    if kind == "float":
        return isinstance(v, (int, float, Decimal)) and math.isfinite(v)
    if kind == "date":
        return (isinstance(v, datetime) and v.tzinfo is None and not v.microsecond) or (isinstance(v, date) and not isinstance(v, datetime))
    if kind == "timestamp":
        return isinstance(v, date) and getattr(v, "tzinfo", None) is None
    if kind != "text" or not isinstance(v, str) or not v or "\0" in v or len(v.encode()) > MAX_TEXT:
        return False
    if side.pads or c.collation.upper() not in ("", "BINARY", "USING_NLS_COMP"):
        return False
    national = c.national or c.data_type.upper().startswith("N")
    if side.charset not in ("AL32UTF8", "UTF8") and not v.isascii():
        return False
    return op in ("=", "<>") or side.charset == "AL32UTF8" and not national


def pushable(t: Term, info: TableInfo, side: Side = Side()) -> bool:  # noqa: B008  a frozen default
    if isinstance(t, (All, Any_)):
        return bool(t.terms) and all(pushable(x, info, side) for x in t.terms)
    if isinstance(t, Local):
        return False
    c = info.column(t.column)
    if isinstance(t, Compare):
        return t.op in COMPARE and constant_fits(c, t.op, t.value, side)
    if isinstance(t, In):
        return 1 <= len(t.values) <= MAX_IN and all(constant_fits(c, "=", v, side) for v in t.values)
    if isinstance(t, IsNull):
        return kind_of(c) != "other"
    return isinstance(t, OnDate) and kind_of(c) == "date" and t.day < date(9999, 12, 31)


def terms_of(t: Term | None) -> list[Term]:
    if t is None:
        return []
    return [y for x in t.terms for y in terms_of(x)] if isinstance(t, All) else [t]


def divided(t: Term | None, info: TableInfo, side: Side = Side()) -> tuple[list[Term], list[Term]]:  # noqa: B008
    """The top-level terms that are pushed, and those that stay."""
    every = terms_of(t)
    return [x for x in every if pushable(x, info, side)], [x for x in every if not pushable(x, info, side)]


def sql(t: Term, info: TableInfo, binds: list[Any]) -> str:
    """SQL text with :bN places; their values are added to binds. Timestamps are bound as text through TO_TIMESTAMP, with microseconds;
    constants of a DATE column as whole-second dates."""

    def put(v: Any, c: RemoteColumn) -> str:
        kind = kind_of(c)
        if kind == "timestamp":
            v = v if isinstance(v, datetime) else datetime(v.year, v.month, v.day)
            binds.append(v.isoformat(" ", "microseconds"))
            return f"TO_TIMESTAMP(:b{len(binds)}, 'YYYY-MM-DD HH24:MI:SS.FF6')"
        if kind == "date" and not isinstance(v, datetime):
            v = datetime(v.year, v.month, v.day)
        binds.append(float(v) if kind == "float" else v)
        return f":b{len(binds)}"

    if isinstance(t, (All, Any_)):
        return "(" + (" AND " if isinstance(t, All) else " OR ").join(sql(x, info, binds) for x in t.terms) + ")"
    c = info.column(t.column)
    name = quote(c.name)
    if isinstance(t, Compare):
        return f"{name} {t.op} {put(t.value, c)}"
    if isinstance(t, In):
        return f"{name} IN ({', '.join(put(v, c) for v in t.values)})"
    if isinstance(t, IsNull):
        return f"{name} IS {'NOT ' if t.negated else ''}NULL"
    return f"({name} >= {put(t.day, c)} AND {name} < {put(t.day + timedelta(days=1), c)})"


def shown_value(v: Any) -> str:
    """A bound value as a literal."""
    if isinstance(v, (int, float, Decimal)):
        return str(v)
    if isinstance(v, datetime):
        return f"TIMESTAMP {literal(v.isoformat(' '))}"
    return f"DATE {literal(str(v))}" if isinstance(v, date) else literal(str(v))


def with_values(text: str, binds: list[Any], value: Callable[[Any], str] = shown_value) -> str:
    """text with its binds written in; quoted parts are left alone."""
    out, i, quoted = [], 0, ""
    while i < len(text):
        c = text[i]
        if quoted:
            quoted = "" if c == quoted else quoted
        elif c in "'\"":
            quoted = c
        elif text.startswith(":b", i):
            j = i + 2
            while j < len(text) and text[j].isdigit():
                j += 1
            out.append(value(binds[int(text[i + 2 : j]) - 1]))
            i = j
            continue
        out.append(c)
        i += 1
    return "".join(out)


def shown(text: str, binds: list[Any]) -> str:
    return with_values(text, binds)


def literal_of(v: Any, c: RemoteColumn) -> Column:
    """A constant in Spark, of the column's own type where it holds the constant, so that columns are compared bare."""
    if kind_of(c) == "float" and isinstance(v, (int, float, Decimal)) and not isinstance(v, bool):
        return F.lit(float(v)).cast("float" if c.data_type.upper() == "BINARY_FLOAT" else "double")
    if isinstance(v, int) and not isinstance(v, bool) and not -(2**63) <= v < 2**63:
        v = Decimal(v)
    if isinstance(v, Decimal):
        _, digits, exponent = v.as_tuple()
        scale = max(0, -exponent)
        return F.lit(str(v)).cast(f"decimal({min(38, max(len(digits), scale, 1))},{scale})")
    return F.lit(v)


def column(t: Term, info: TableInfo) -> Column:
    """The term in Spark: Catalyst takes it to the file scan where it can."""
    if isinstance(t, (All, Any_)):
        return reduce(lambda a, b: a & b if isinstance(t, All) else a | b, (column(x, info) for x in t.terms))
    if isinstance(t, Local):
        return F.expr(t.condition)
    told = info.column(t.column)
    c = F.col(f"`{told.name}`")
    if isinstance(t, Compare):
        return getattr(operator, {"=": "eq", "<>": "ne", "<": "lt", "<=": "le", ">": "gt", ">=": "ge"}[t.op])(c, literal_of(t.value, told))
    if isinstance(t, In):
        return c.isin([literal_of(v, told) for v in t.values])
    if isinstance(t, IsNull):
        return c.isNotNull() if t.negated else c.isNull()
    return c.cast("date") == F.lit(t.day)
