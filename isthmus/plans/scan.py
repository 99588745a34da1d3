"""Scans: description, projection, pushed filters, units and one snapshot, with a report of what was done.

The DataFrame reads native files, so Catalyst prunes columns and pushes every filter it can; the division into pushed and kept terms
is that of the remote rules, for the SQL text of the report. However it is split, a table of files is read once: extents are ranges of
its files, and a hash split deals its rows to as many partitions. (A remote side without files is read once for each unit: see jdbc.py.)
"""

from __future__ import annotations

import time
from dataclasses import asdict, dataclass, field
from typing import Any

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from isthmus.functions.decode import decoded
from isthmus.plans import predicates as P
from isthmus.plans import units as U
from isthmus.plans.conditions import condition
from isthmus.plans.remote_sql import scan_sql
from isthmus.sources.names import BridgeError, parse_name, unique_names
from isthmus.sources.tables import ParquetSide, TableInfo
from isthmus.sources.types import RemoteColumn, read_type


@dataclass(frozen=True)
class ScanKey:
    """What makes two scans the same relation."""

    place: str
    table: str
    columns: tuple[str, ...]
    where: str
    split: str
    snapshot: str
    unconstrained_number: str


@dataclass
class Report:
    table: str
    columns: list[str]
    strategy: str
    units: int
    sessions: int
    snapshot: str
    where: str
    kept: list[str]
    sql: str
    planning_ms: float
    notes: list[str] = field(default_factory=list)
    key: ScanKey | None = None

    def explained(self) -> dict[str, Any]:
        """Before a run: the table, the WHERE that the remote side gets, the split and the snapshot."""
        return {"Table": self.table, "Remote WHERE": self.where, "Kept": "; ".join(self.kept), "Split": self.strategy, "Snapshot": self.snapshot}

    def analyzed(self, df: DataFrame) -> dict[str, Any]:
        """Runs a DataFrame of this scan to the end, and tells what was planned with what was seen: rows and seconds."""
        seen, began = Observation(), time.perf_counter()
        df.observe(seen, F.count(F.lit(1)).alias("rows")).write.format("noop").mode("overwrite").save()
        return {**asdict(self), "rows": seen.get["rows"], "seconds": time.perf_counter() - began}


def unreadable(c: RemoteColumn) -> Column:
    """A column that may be there but not be read: the error comes when it is selected, not before."""
    return F.raise_error(F.lit(f"column {c.name}: type {c.data_type} cannot be read")).cast("string")


def scan(side: ParquetSide, name: str, columns: list[str] | None = None, where: P.Term | str | None = None, n_sessions: int = 1, split: str = "auto", snapshot: str = "auto", unconstrained_number: str = "DOUBLE") -> tuple[DataFrame, Report]:
    """Rows of a table, and the report. Options are checked before anything is read. A column of a type that cannot be read is an error
    if it is asked for: at once if it is in ``columns``, else when a query selects it."""
    began = time.perf_counter()
    n, split, snapshot = U.sessions(n_sessions), U.choice("split", split, U.SPLITS), U.choice("snapshot", snapshot, U.SNAPSHOTS)
    target = parse_name(name)
    info = side.describe(target.table, side.schema(target.schema))
    if info is None:
        raise BridgeError(f"no table {name}")
    if not info.columns:
        raise BridgeError(f"table {name} has no visible column")
    if snapshot == "scn":
        raise BridgeError("snapshot scn: files have no change number; use auto")
    term = condition(where, info) if isinstance(where, str) else where
    picked = [info.column(c) for c in columns] if columns is not None else list(info.columns)
    types = [read_type(c, unconstrained_number) for c in picked]
    for c, t in zip(picked, types, strict=True):
        if t is None and columns is not None:
            raise BridgeError(f"column {c.name}: type {c.data_type} cannot be read")
    files = side.frozen(info) if snapshot == "auto" else None
    why = U.why_not_extents(info.organization)
    extents = U.whole_bytes(side.sizes(files or side.frozen(info)), n) if n > 1 and split in ("auto", "extents") and not why else None
    work = U.plan(split, n, info.kind == "table", extents, why)
    pushed, kept = P.divided(term, info)
    base = parts(side, info, work, files, n)
    base = readable(base, info, unconstrained_number)
    for t in P.terms_of(term):
        base = base.filter(P.column(t, info))
    names = unique_names([c.name for c in picked])
    out = base.select(*(F.col(f"`{c.name}`").alias(a) for c, a in zip(picked, names, strict=True)))
    binds: list = []
    text = " AND ".join(P.sql(t, info, binds) for t in pushed)
    query = scan_sql(info, picked, term, None, None, info.schema_name).shown()
    key = ScanKey(side.place(info.schema_name), info.name, tuple(c.name for c in picked), str(term), split, snapshot, unconstrained_number)
    report = Report(info.name, names, work.strategy, len(work.units), min(n, len(work.units)), f"{len(files)} files" if files else "none", P.shown(text, binds), [str(t) for t in kept], query, 1000 * (time.perf_counter() - began), list(work.notes), key)
    return out, report


def readable(base: DataFrame, info: TableInfo, unconstrained_number: str) -> DataFrame:
    """base with every column as its read type; as it is if all are stored so."""
    told, changed = [], False
    for f in info.schema:
        c = info.column(f.name)
        made = unreadable(c) if read_type(c, unconstrained_number) is None else decoded(c, f.dataType, unconstrained_number)
        changed |= made is not None
        told.append(F.col(f"`{f.name}`") if made is None else made.alias(f.name))
    return base.select(*told) if changed else base


def parts(side: ParquetSide, info: TableInfo, work: U.WorkPlan, files: list[str] | None, n: int) -> DataFrame:
    """The table in one read; a hash split deals the rows by all columns that can be hashed."""
    whole = side.read(info, files)
    if work.strategy == "hash":
        keys = [F.col(f"`{f.name}`") for f in info.schema if f.dataType.typeName() not in ("map", "variant")]
        return whole.repartition(n, *keys)
    return whole
