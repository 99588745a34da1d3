"""An attached, read-only catalog over a side: schemas, look-ups, listings, and one refusal for every write."""

from __future__ import annotations

import difflib
import re
import warnings

from pyspark.sql import DataFrame

from isthmus.plans import units as U
from isthmus.plans.predicates import Term
from isthmus.plans.scan import Report, scan
from isthmus.sources.names import BridgeError, RemoteError, parse_name
from isthmus.sources.tables import TableInfo
from isthmus.sources.types import unconstrained

#: What a Spark user may ask of a catalog that changes it, as methods; none is ever done.
WRITES = (
    "create_namespace drop_namespace alter_namespace "
    "create_table create_table_as replace_table alter_table drop_table purge_table rename_table truncate_table "
    "insert_into insert_overwrite update delete merge load "
    "create_view alter_view drop_view create_function drop_function create_index drop_index analyze_table"
).split()
#: First words of statements that change a catalog, or what is in it.
REFUSED = re.compile(r"\s*(?:--[^\n]*\n\s*|/\*.*?\*/\s*)*(INSERT|UPDATE|DELETE|MERGE|CREATE|DROP|ALTER|TRUNCATE|REPLACE|COPY|LOAD|ANALYZE|VACUUM|OPTIMIZE|REFRESH|MSCK|GRANT|REVOKE)\b", re.I | re.S)


class ReadOnlyError(BridgeError):
    pass


def refused(what: str) -> ReadOnlyError:
    return ReadOnlyError(f"{what}: an attached catalog is read-only")


class Catalog:
    """attach(side): tables by name; every method of WRITES raises, as does every statement of sql() that would write."""

    def __init__(self, side, n_sessions: int = 1, split: str = "auto", snapshot: str = "auto", unconstrained_number: str = "DOUBLE", secret: str | None = None, default_schema: str | None = None) -> None:
        """Options are checked, and the side is asked once for its schema, before anything is read."""
        U.sessions(n_sessions), U.choice("split", split, U.SPLITS), U.choice("snapshot", snapshot, U.SNAPSHOTS), unconstrained(unconstrained_number)
        if hasattr(side, "secret_name"):
            side.secret_name = secret or side.secret_name
            default_schema = default_schema or side.default_schema()
        elif secret is not None:
            raise BridgeError("secret: this side takes none")
        self.side, self.default = side, default_schema
        self.options = {"n_sessions": n_sessions, "split": split, "snapshot": snapshot, "unconstrained_number": unconstrained_number}

    def __getattr__(self, name: str):
        if name in WRITES:
            def refuse(*_: object, **__: object) -> None:
                raise refused(name)
            return refuse
        raise AttributeError(name)

    def schemas(self) -> list[str]:
        return self.side.schemas()

    def tables(self, schema: str | None = None) -> list[str]:
        """Names in a schema (the default one without a name); none, with a warning, if the side cannot be reached."""
        try:
            return self.side.list(self.side.schema(schema or self.default))
        except RemoteError as e:
            warnings.warn(f"schema {schema or self.default}: {e}", stacklevel=2)
            return []

    def info(self, name: str) -> TableInfo:
        """A table by T or S.T, quoted or not; names that are not found are kept until refresh()."""
        target = parse_name(name)
        schema = self.side.schema(target.schema or self.default)
        found = self.side.describe(target.table, schema)
        if found is None:
            near = difflib.get_close_matches(target.table.lower(), [v.name.lower() for v in self.side.known.values() if v], 1)
            raise BridgeError(f"no table {name}" + (f"; did you mean {near[0]}?" if near else ""))
        return found

    def storage(self, name: str) -> dict[str, object]:
        """What is known of a table without reading it: kind, organization, rows, columns. There are no row ids and no column statistics."""
        info = self.info(name)
        return {"kind": info.kind, "organization": info.organization, "rows": self.side.rows(info), "columns": len(info.columns)}

    def table(self, name: str, columns: list[str] | None = None, where: Term | str | None = None) -> DataFrame:
        return self.scan(name, columns, where)[0]

    def scan(self, name: str, columns: list[str] | None = None, where: Term | str | None = None) -> tuple[DataFrame, Report]:
        info = self.info(name)
        full = f'"{info.schema_name}"."{info.name}"' if info.schema_name else f'"{info.name}"'
        if hasattr(self.side, "scan"):
            return self.side.scan(full, columns, where, **self.options)
        return scan(self.side, full, columns, where, **self.options)

    def sql(self, text: str, **views: str) -> DataFrame:
        """A query in which {name} stands for a table: views gives the tables by their names. Statements that write are refused."""
        if m := REFUSED.match(text):
            raise refused(m[1].upper())
        return self.side.spark.sql(text, **{k: self.table(v) for k, v in views.items()})

    def refresh(self) -> None:
        self.side.refresh()

    detach = refresh
