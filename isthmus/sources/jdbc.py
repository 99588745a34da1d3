"""A database behind JDBC as a remote side: sessions, dictionary, scans of many units in one snapshot, and loads in one transaction.

Dictionary look-ups go through the driver's own connection; rows are read by Spark's JDBC source, one task a unit, from a subquery that this
module writes: its own conservative WHERE, never Spark's pushdown of predicates, limits or aggregates. Credentials come from a secret by
name, and no error shows them. Tested against the Derby that Spark ships; other databases need their driver on the classpath.
"""

from __future__ import annotations

import time
import uuid
import warnings
from dataclasses import dataclass, field
from datetime import date, datetime
from datetime import time as time_of_day
from decimal import Decimal
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from isthmus.functions.decode import decoded
from isthmus.plans import predicates as P
from isthmus.plans import units as U
from isthmus.plans.conditions import condition
from isthmus.plans.scan import Report, ScanKey
from isthmus.sources.names import BridgeError, RemoteError, literal, parse_name, quote, unique_names
from isthmus.sources.secrets import redacted, secret
from isthmus.sources.tables import TableInfo
from isthmus.sources.types import RemoteColumn, read_type
from isthmus.sources.writer import PartialLoadError, checked, matched

# Drivers by the start of their URLs, tried in this order.
DRIVERS = {"jdbc:derby:": ("org.apache.derby.iapi.jdbc.AutoloadedDriver", "org.apache.derby.jdbc.EmbeddedDriver"), "jdbc:oracle:": ("oracle.jdbc.OracleDriver", "oracle.jdbc.driver.OracleDriver")}
#: Pushdowns of Spark's source that are left to this module.
OURS = ("pushDownPredicate", "pushDownAggregate", "pushDownLimit", "pushDownOffset", "pushDownTableSample")
#: Rows a fetch of at most so many bytes holds.
FETCH_BYTES, FETCH_ROWS = 64 << 20, 8192


def remote_type(jdbc: int, name: str, size: int, digits: int) -> tuple[str, int | None, int | None]:
    """data_type, precision and scale of a JDBC column."""
    whole = {-6: 3, 5: 4, 4: 9, -5: 18}  # tinyint, smallint, integer, bigint: the widths that read as the same types
    if jdbc in whole:
        return "NUMBER", whole[jdbc], 0
    if jdbc in (2, 3):
        return "NUMBER", size, digits
    kinds = {7: "BINARY_FLOAT", 6: "BINARY_DOUBLE", 8: "BINARY_DOUBLE", 12: "VARCHAR2", -1: "CLOB", 1: "CHAR", 2005: "CLOB", 2004: "BLOB", -2: "RAW", -3: "RAW", -4: "BLOB", 91: "DATE", 93: "TIMESTAMP(6)", 16: "BOOLEAN", -15: "NCHAR", -9: "NVARCHAR2", 2011: "NCLOB", -8: "ROWID"}
    return kinds.get(jdbc, name), None, None


@dataclass
class JdbcSide:
    """A remote side by URL; the secret's user and password are used, if it has a name."""

    spark: SparkSession
    url: str
    secret_name: str | None = None
    session_settings: str | None = None
    known: dict[tuple[str, str], TableInfo | None] = field(default_factory=dict)
    users: list[str] | None = None

    # ------------------------------------------------------------ sessions

    def driver(self) -> str:
        """The class of the driver: the first candidate on the classpath."""
        names = next((v for k, v in DRIVERS.items() if self.url.startswith(k)), ())
        loader = self.spark.sparkContext._jvm.java.lang.Thread.currentThread().getContextClassLoader()
        for n in names:
            try:
                loader.loadClass(n)
                return n
            except Exception:  # noqa: BLE001, S112  not on the classpath
                continue
        raise BridgeError(f"no driver for {redacted(self.url)}: put one of {', '.join(names) or 'its classes'} on spark.jars")

    def connect(self):
        jvm = self.spark.sparkContext._jvm
        props = jvm.java.util.Properties()
        for k, v in self._credentials().items():
            props.setProperty(k, v)
        jvm.java.lang.Class.forName(self.driver())
        connection = self._asked(lambda: jvm.java.sql.DriverManager.getConnection(self.url, props))
        if self.session_settings:
            self._asked(lambda: connection.createStatement().execute(self.session_settings))
        return connection

    def _credentials(self) -> dict[str, str]:
        if not self.secret_name:
            return {}
        s = secret(self.secret_name)
        return {"user": s.user, "password": s.password}

    def _asked(self, what):
        from py4j.protocol import Py4JJavaError

        try:
            return what()
        except Py4JJavaError as e:
            java = e.java_exception
            code = java.getErrorCode() if hasattr(java, "getErrorCode") and "SQL" in java.getClass().getName() else 0
            raise RemoteError(redacted(str(java.getMessage())), code) from None

    def strings(self, sql: str, binds: tuple[str, ...] = (), fetch: int = 1024) -> list[tuple[str | None, ...]]:
        """All rows of a small query as text; binds are bound as text."""
        connection = self.connect()
        try:
            statement = self._asked(lambda: connection.prepareStatement(sql))
            statement.setFetchSize(fetch)
            for i, b in enumerate(binds, 1):
                statement.setString(i, b)
            rows = self._asked(statement.executeQuery)
            width, out = rows.getMetaData().getColumnCount(), []
            while rows.next():
                out.append(tuple(rows.getString(i) for i in range(1, width + 1)))
            return out
        finally:
            _closed(connection)

    def execute(self, *statements: str) -> list[int]:
        """Statements in one transaction: all or none; the rows that each changed."""
        connection = self.connect()
        try:
            connection.setAutoCommit(False)
            counts = [self._asked(lambda s=s: connection.createStatement().executeUpdate(s)) for s in statements]
            self._asked(connection.commit)
            return counts
        except BridgeError:
            connection.rollback()
            raise
        finally:
            _closed(connection)

    def version(self) -> str:
        """The driver's name and version."""
        connection = self.connect()
        try:
            m = connection.getMetaData()
            return f"{m.getDriverName()} {m.getDriverVersion()}"
        finally:
            _closed(connection)

    # ------------------------------------------------------------ dictionary

    def default_schema(self) -> str:
        connection = self.connect()
        try:
            return connection.getSchema()
        finally:
            _closed(connection)

    def schemas(self) -> list[str]:
        """All schemas, asked once until refresh()."""
        if self.users is None:
            connection = self.connect()
            try:
                rows, out = connection.getMetaData().getSchemas(), []
                while rows.next():
                    out.append(rows.getString(1))
                self.users = sorted(out)
            finally:
                _closed(connection)
        return self.users

    def schema(self, name: str | None) -> str:
        """A schema by exact name, else in upper case; the session's own without a name."""
        if name is None:
            return self.default_schema()
        found = next((n for n in (name, name.upper()) if n in self.schemas()), None)
        if found is None:
            raise BridgeError(f"no schema {name}")
        return found

    def list(self, schema: str | None = None) -> list[str]:
        owner, connection = self.schema(schema), self.connect()
        try:
            rows, out = connection.getMetaData().getTables(None, owner, "%", None), []
            while rows.next():
                if rows.getString(4) in ("TABLE", "VIEW", "SYNONYM"):
                    out.append(rows.getString(3))
            return sorted(out)
        finally:
            _closed(connection)

    def describe(self, table: str, schema: str | None = None) -> TableInfo | None:
        """A table's or view's description by exact name, then upper case; synonyms up to eight deep. Hits and misses are kept."""
        owner = self.schema(schema)
        if (owner, table) not in self.known:
            self.known[owner, table] = next((t for n in dict.fromkeys((table, table.upper())) if (t := self._described(owner, n, 8))), None)
        return self.known[owner, table]

    def describe_all(self, schema: str | None = None) -> list[TableInfo]:
        """Every table of a schema; a side that cannot be reached has none, with a warning."""
        try:
            return [t for n in self.list(schema) if (t := self.describe(n, schema))]
        except RemoteError as e:
            warnings.warn(f"schema {schema}: {e}", stacklevel=2)
            return []

    def _described(self, owner: str, name: str, depth: int) -> TableInfo | None:
        connection = self.connect()
        try:
            meta = connection.getMetaData()
            found, kind = meta.getTables(None, owner, name.replace("_", "\\_") if meta.getSearchStringEscape() == "\\" else name, None), None
            while found.next():
                if found.getString(3) == name:
                    kind = found.getString(4)
            if kind is None:
                return None
            if kind == "SYNONYM":
                if not depth:
                    raise BridgeError(f"synonym {name}: more than eight deep")
                target = parse_name(self.synonym(owner, name))
                return self._described(target.schema or owner, target.table, depth - 1)
            columns, rows = [], meta.getColumns(None, owner, name, "%")
            while rows.next():
                if rows.getString(3) == name:
                    kind_, p, s = remote_type(rows.getInt(5), rows.getString(6), rows.getInt(7), rows.getInt(9))
                    columns.append(RemoteColumn(rows.getString(4), kind_, rows.getInt(7), p, s, rows.getInt(11) != 0))
            fields = [T.StructField(c.name, read_type(c) or T.StringType()) for c in columns]
            return TableInfo(name, T.StructType(fields), tuple(columns), "view" if kind == "VIEW" else "table", "HEAP", None, owner)
        finally:
            _closed(connection)

    def synonym(self, owner: str, name: str) -> str:
        """What a synonym stands for, as quoted text (Derby's dictionary)."""
        rows = self.strings("SELECT CAST(a.ALIASINFO AS VARCHAR(300)) FROM SYS.SYSALIASES a JOIN SYS.SYSSCHEMAS s ON a.SCHEMAID = s.SCHEMAID WHERE a.ALIASTYPE = 'S' AND s.SCHEMANAME = ? AND a.ALIAS = ?", (owner, name))
        if not rows:
            raise BridgeError(f"synonym {name}: not found")
        return rows[0][0]

    def describe_target(self, table: str, schema: str | None = None) -> tuple[TableInfo, int]:
        """A table to load into and how many indexes it has; an error for views and what is not there."""
        info = self.describe(table, schema)
        if info is None or info.kind != "table":
            raise BridgeError(f"no table {table} to load into")
        connection = self.connect()
        try:
            rows, names = connection.getMetaData().getIndexInfo(None, info.schema_name, info.name, False, True), set()
            while rows.next():
                names.add(rows.getString(6))
            return info, len(names - {None})
        finally:
            _closed(connection)

    def rows(self, info: TableInfo) -> int:
        """The rows of a table now: an estimate for planners, exact when it is taken."""
        return int(self.strings(f"SELECT CAST(count(*) AS CHAR(20)) FROM {self._name(info)}")[0][0])

    def refresh(self) -> None:
        self.known.clear()
        self.users = None

    # ------------------------------------------------------------ scans

    @staticmethod
    def _name(info: TableInfo) -> str:
        return f"{quote(info.schema_name)}.{quote(info.name)}" if info.schema_name else quote(info.name)

    def scan(self, name: str, columns: list[str] | None = None, where: P.Term | str | None = None, n_sessions: int = 1, split: str = "auto", snapshot: str = "auto", unconstrained_number: str = "DOUBLE", hash_by: str | None = None) -> tuple[DataFrame, Report]:
        """As plans.scan.scan, from the database. A hash split needs an integer column to deal rows by (``hash_by``, or the first that may
        not be null); there are no extents here, so ``auto`` falls to hash and then to one unit. JDBC has no common snapshot: with more than
        one unit ``auto`` warns, ``scn`` is an error."""
        began = time.perf_counter()
        n, split, snapshot = U.sessions(n_sessions), U.choice("split", split, U.SPLITS), U.choice("snapshot", snapshot, U.SNAPSHOTS)
        target = parse_name(name)
        info = self.describe(target.table, target.schema)
        if info is None:
            raise BridgeError(f"no table {name}")
        if snapshot == "scn":
            raise BridgeError("snapshot scn: this side cannot read as of a change number")
        picked = [info.column(c) for c in columns] if columns is not None else [c for c in info.columns if read_type(c, unconstrained_number) is not None]
        for c in picked:
            if read_type(c, unconstrained_number) is None:
                raise BridgeError(f"column {c.name}: type {c.data_type} cannot be read")
        term = condition(where, info) if isinstance(where, str) else where
        key = info.column(hash_by) if hash_by else next((c for c in info.columns if c.data_type == "NUMBER" and not c.scale and not c.nullable), None)
        work = U.plan(split, n, info.kind == "table", None, "this side has no extents", key is not None)
        notes = list(work.notes)
        if len(work.units) > 1 and snapshot == "auto":
            notes.append("units read at different moments")
            warnings.warn(f"{name}: {len(work.units)} units without a common snapshot", stacklevel=2)
        pushed, kept = P.divided(term, info, P.Side(pads=self.url.startswith("jdbc:derby:")))
        # a date of this side has no time of day, so a term that asks for one stays in Spark
        timed = [t for t in pushed if has_time(t, info)]
        pushed, kept = [t for t in pushed if t not in timed], kept + timed
        needed = list(dict.fromkeys([*picked, *(info.column(c) for t in kept for c in used(t, info))]))
        text = self.select(info, needed, pushed)
        slices = [self.slice(key, u) for u in work.units]
        options = {"driver": self.driver(), "fetchsize": str(fetch_rows(needed)), "preferTimestampNTZ": "true", **dict.fromkeys(OURS, "false"), **self._credentials()}
        if self.session_settings:
            options["sessionInitStatement"] = self.session_settings
        df = self.spark.read.jdbc(self.url, f"({text}) s", predicates=slices, properties=options)
        for t in kept:
            df = df.filter(P.column(t, info))
        stored = {f.name: f.dataType for f in df.schema}
        out = []
        for c, alias in zip(picked, unique_names([c.name for c in picked]), strict=True):
            made = decoded(c, stored[c.name], unconstrained_number)
            out.append((F.col(f"`{c.name}`") if made is None else made).alias(alias))
        report = Report(info.name, [c.name for c in picked], work.strategy, len(work.units), min(n, len(work.units)), "none", " AND ".join(self.condition(t, info) for t in pushed), [str(t) for t in kept], text, 1000 * (time.perf_counter() - began), notes, ScanKey(redacted(self.url), info.name, tuple(c.name for c in picked), str(term), split, snapshot, unconstrained_number))
        return df.select(*out), report

    def select(self, info: TableInfo, columns: list[RemoteColumn], pushed: list[P.Term]) -> str:
        """The subquery: literals in place of binds, as JDBC subqueries take none."""
        text = f"SELECT {', '.join(quote(c.name) for c in columns) or '1 AS ONE'} FROM {self._name(info)}"
        return text + (f" WHERE {' AND '.join(self.condition(t, info) for t in pushed)}" if pushed else "")

    @staticmethod
    def condition(t: P.Term, info: TableInfo) -> str:
        """The term with literals that this side takes; a column that JDBC calls a date has no time of day."""
        binds: list[Any] = []
        text = P.sql(t, info, binds).replace("TO_TIMESTAMP(", "TIMESTAMP(").replace(", 'YYYY-MM-DD HH24:MI:SS.FF6')", ")")
        return P.with_values(text, binds, jdbc_literal)

    @staticmethod
    def slice(key: RemoteColumn | None, unit: Any) -> str:
        if unit is None:
            return "1 = 1"
        k, n = unit
        name = quote(key.name)
        return f"MOD({name}, {n}) = {k}" if k == 0 else f"(MOD({name}, {n}) = {k} OR MOD({name}, {n}) = {k - n})"

    # ------------------------------------------------------------ loads

    def load(self, df: DataFrame, name: str, skip_index_maintenance: bool = False) -> int:
        """Appends df to a table, whole or not at all: rows are checked and staged in a table of the load's own, then moved in one
        transaction; on any error nothing is visible and the stage is dropped."""
        target = parse_name(name)
        info, indexes = self.describe_target(target.table, target.schema)
        if indexes and skip_index_maintenance:
            raise BridgeError("skip_index_maintenance: this side always keeps its indexes")
        pairs = matched(df, list(info.columns))
        stage = f"ISTHMUS_{uuid.uuid4().hex[:16].upper()}"
        place = f"{quote(info.schema_name)}.{quote(stage)}"
        names = ", ".join(quote(c.name) for _, c in pairs)
        # Spark makes the stage with types of its own (text is a CLOB there), so text is cast where it moves
        moved = ", ".join(f"CAST({quote(c.name)} AS {'CHAR' if c.data_type == 'CHAR' else 'VARCHAR'}({c.length}))" if c.data_type in ("VARCHAR2", "CHAR") else quote(c.name) for _, c in pairs)
        made = False
        try:
            rows = df.select(*(checked(n, df.schema[n].dataType, c).alias(c.name) for n, c in pairs))
            made = True
            rows.write.format("jdbc").options(url=self.url, driver=self.driver(), dbtable=place, batchsize="5000", **self._credentials()).mode("errorifexists").save()
            staged = int(self.strings(f"SELECT CAST(count(*) AS CHAR(20)) FROM {place}")[0][0])
            done = self.execute(f"INSERT INTO {self._name(info)} ({names}) SELECT {moved} FROM {place}")[0]
            if done != staged:
                raise PartialLoadError(f"PARTIAL load: {done} of {staged} rows of {name}")
            return done
        finally:
            if made and stage in self.list(info.schema_name):
                self.execute(f"DROP TABLE {place}")


def _closed(connection) -> None:
    if not connection.getAutoCommit():
        connection.rollback()
    connection.close()


def used(t: P.Term, info: TableInfo) -> list[str]:
    """The columns that a kept term may use: those whose names are in its text."""
    if isinstance(t, (P.All, P.Any_)):
        return [c for x in t.terms for c in used(x, info)]
    if isinstance(t, P.Local):
        return [c.name for c in info.columns if c.name.lower() in t.condition.lower()]
    return [info.column(t.column).name]


def has_time(t: P.Term, info: TableInfo) -> bool:
    """Whether a term compares a DATE column with a time of day."""
    if isinstance(t, (P.All, P.Any_)):
        return any(has_time(x, info) for x in t.terms)
    values = (t.value,) if isinstance(t, P.Compare) else t.values if isinstance(t, P.In) else ()
    return any(isinstance(v, datetime) and P.kind_of(info.column(t.column)) == "date" and v.time() != time_of_day() for v in values)


def fetch_rows(columns: list[RemoteColumn]) -> int:
    """Rows of a fetch, by the columns' greatest widths."""
    return max(1, min(FETCH_ROWS, FETCH_BYTES // max(1, sum(min(c.length or 22, 4000) for c in columns))))


def jdbc_literal(v: Any) -> str:
    if isinstance(v, bool) or v is None:
        raise BridgeError(f"no literal for {v!r}")
    if isinstance(v, datetime) and (v.hour or v.minute or v.second or v.microsecond):
        raise BridgeError(f"{v}: a date of this side has no time of day")
    if isinstance(v, date):
        return f"DATE({literal(str(date(v.year, v.month, v.day)))})"
    return format(v, "f") if isinstance(v, Decimal) else repr(v) if isinstance(v, float) else str(v) if isinstance(v, int) else literal(str(v))
