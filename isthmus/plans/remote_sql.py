"""The SELECT of a scan for a remote side: columns, one snapshot, pushed filters and one unit's slice, with binds numbered through."""

from __future__ import annotations

from dataclasses import dataclass
from typing import Any

from isthmus.plans import predicates as P
from isthmus.plans import units as U
from isthmus.sources.names import BridgeError, quote
from isthmus.sources.tables import TableInfo
from isthmus.sources.types import RemoteColumn

@dataclass(frozen=True)
class Statement:
    text: str
    binds: tuple[Any, ...]

    def shown(self) -> str:
        """For people, with the binds written in."""
        return P.shown(self.text, list(self.binds))


def column_sql(c: RemoteColumn) -> str:
    """How a column is selected: values with a time zone as UTC, row addresses as text."""
    name, t = quote(c.name), c.data_type.upper()
    if "TIME ZONE" in t:
        return f"SYS_EXTRACT_UTC({name})"
    return f"ROWIDTOCHAR({name})" if t in ("ROWID", "UROWID") else name


def slice_sql(unit: Any, binds: list[Any]) -> str:
    """The predicate of a unit: none, a range of row addresses (open at the end where it is an object's last), or a hash bucket."""

    def put(v: Any) -> str:
        binds.append(v)
        return f":b{len(binds)}"

    if unit is None:
        return ""
    if isinstance(unit, U.Range):
        low = put(U.rowid(unit.data_object, *unit.start, 0))
        end = unit.end
        high = put(U.rowid(unit.data_object, *end, 0) if end else U.rowid(unit.data_object, U.LAST_FILE, U.LAST_BLOCK, U.LAST_ROW))
        return f"ROWID >= CHARTOROWID({low}) AND ROWID {'<' if end else '<='} CHARTOROWID({high})"
    bucket, buckets = unit
    return f"ORA_HASH(ROWID, {put(buckets - 1)}) = {put(bucket)}"


def scan_sql(info: TableInfo, columns: list[RemoteColumn], where: P.Term | None = None, unit: Any = None, change_number: int | None = None, schema: str | None = None, side: P.Side = P.Side(), tag: str = "") -> Statement:  # noqa: B008
    """Without columns a constant is selected, so that rows can be counted. Only terms that may be pushed are in the text. A tag is a comment that a
    server's statistics show."""
    binds: list[Any] = []
    table = (f"{quote(schema)}." if schema else "") + quote(info.name)
    text = f"SELECT {f'/* {tag} */ ' if tag else ''}{', '.join(map(column_sql, columns)) or '1'} FROM {table}"
    if change_number is not None:
        if change_number < 0:
            raise BridgeError(f"change number {change_number}: negative")
        binds.append(change_number)
        text += f" AS OF SCN TO_NUMBER(:b{len(binds)})"
    terms = [P.sql(t, info, binds) for t in P.divided(where, info, side)[0]]
    if part := slice_sql(unit, binds):
        terms.append(part)
    return Statement(text + (f" WHERE {' AND '.join(terms)}" if terms else ""), tuple(binds))
