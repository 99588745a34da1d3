"""The bridge as a data source that Spark can name: ``spark.read.format("isthmus")``, ``df.write.format("isthmus")`` and SQL's USING.

The reader plans units by the rules of units.py: ranges of a file's blocks (a row group belongs to the range its first byte is in), or one
unit; a partition reads its row groups as Arrow batches, the asked-for columns only, with the pushed filters applied exactly. Spark pushes
AND terms; a condition with OR may be given as the option ``where``. The writer checks every value against the table's types in the tasks,
stages files under the name of the job, and publishes those that the commit messages name; it takes them back on any error.

Options: folder, table; reading also columns, where, sessions, split, snapshot, unconstrained_number. Nothing of a secret is an option.
"""

from __future__ import annotations

import posixpath
import uuid
from collections.abc import Iterator
from dataclasses import dataclass, field
from datetime import datetime, timedelta
from functools import reduce
from operator import and_, or_
from typing import Any

import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.dataset as ds
import pyarrow.parquet as pq
from pyarrow import fs as arrow_fs
from pyspark.sql import SparkSession
from pyspark.sql import datasource as api
from pyspark.sql import types as T
from pyspark.sql.pandas.types import from_arrow_schema, to_arrow_type

from isthmus.plans import predicates as P
from isthmus.plans import units as U
from isthmus.plans.conditions import condition
from isthmus.sources.arrow_cells import fitted
from isthmus.sources.names import BridgeError, parse_name
from isthmus.sources.tables import TableInfo, remote_column
from isthmus.sources.types import read_type
from isthmus.sources.writer import REFUSED, PartialLoadError, matched_columns

NAME, BLOCK = "isthmus", 8192
READ_OPTIONS = ("folder", "table", "path", "columns", "where", "sessions", "split", "snapshot", "unconstrained_number")
#: Bytes of one Arrow batch, and its rows at most.
BATCH_BYTES, BATCH_ROWS = 64 << 20, 8192


def register(spark: SparkSession) -> None:
    """Makes the format known to a session, and lets Spark push filters to it."""
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(BridgeSource)


def store(folder: str) -> tuple[arrow_fs.FileSystem, str]:
    if "://" in folder or folder.startswith("file:"):
        return arrow_fs.FileSystem.from_uri(folder)
    return arrow_fs.LocalFileSystem(), folder


@dataclass
class Place:
    """A table's folder or file."""

    folder: str
    table: str

    def path(self) -> tuple[arrow_fs.FileSystem, str]:
        target = parse_name(self.table)
        fs, root = store(self.folder)
        if target.schema:
            root = posixpath.join(root, target.schema)
        for name in dict.fromkeys((target.table, target.table.upper(), target.table.lower())):
            path = f"{root.rstrip('/')}/{name}.parquet"
            if fs.get_file_info(path).type != arrow_fs.FileType.NotFound:
                return fs, path
        raise BridgeError(f"no table {self.table}")

    def files(self) -> list[tuple[str, int]]:
        """Data files with their bytes, now: stages and files in the making have names with _ or a dot first."""
        fs, path = self.path()
        info = fs.get_file_info(path)
        if info.type == arrow_fs.FileType.File:
            return [(path, info.size)]
        found = fs.get_file_info(arrow_fs.FileSelector(path, recursive=True))
        return sorted((f.path, f.size) for f in found if f.type == arrow_fs.FileType.File and not any(p[:1] in "_." for p in f.path[len(path) + 1 :].split("/")))

    def schema(self) -> pa.Schema:
        files = self.files()
        if not files:
            raise BridgeError(f"table {self.table} has no file to read a schema from")
        with self.path()[0].open_input_file(files[0][0]) as f:
            return pq.read_schema(f).remove_metadata()


def described(place: Place) -> TableInfo:
    schema = from_arrow_schema(place.schema(), prefer_timestamp_ntz=True)
    return TableInfo(parse_name(place.table).table, schema, tuple(map(remote_column, schema)))


class BridgeSource(api.DataSource):
    @classmethod
    def name(cls) -> str:
        return NAME

    def place(self) -> Place:
        folder, table = self.options.get("folder"), self.options.get("table")
        if not folder or not table:
            raise BridgeError("options folder and table are needed")
        return Place(folder, table)

    def checked_options(self) -> None:
        """Options before anything is opened."""
        for o in self.options:
            if o.lower() not in READ_OPTIONS:
                raise BridgeError(f"option {o}: not known; use {', '.join(READ_OPTIONS)}")
        U.sessions(int(self.options.get("sessions", "1")))
        U.choice("split", self.options.get("split", "auto"), U.SPLITS)
        if U.choice("snapshot", self.options.get("snapshot", "auto"), U.SNAPSHOTS) == "scn":
            raise BridgeError("snapshot scn: files have no change number; use auto")

    def picked(self, info: TableInfo) -> list[str]:
        asked = self.options.get("columns")
        names = [info.column(c.strip()).name for c in asked.split(",") if c.strip()] if asked else [c.name for c in info.columns]
        for n in names:
            if asked and read_type(info.column(n)) is None:
                raise BridgeError(f"column {n}: type {info.column(n).data_type} cannot be read")
        return [n for n in names if read_type(info.column(n)) is not None]

    def schema(self) -> T.StructType:
        self.checked_options()
        info = described(self.place())
        return T.StructType([info.schema[n] for n in self.picked(info)])

    def reader(self, schema: T.StructType) -> BridgeReader:
        self.checked_options()
        info = described(self.place())
        where = self.options.get("where")
        return BridgeReader(self.place(), info, [f.name for f in schema], condition(where, info) if where else None, int(self.options.get("sessions", "1")), self.options.get("split", "auto"))

    def writer(self, schema: T.StructType, overwrite: bool) -> BridgeWriter:
        for o in self.options:
            if o.lower() in REFUSED or o.lower() not in ("folder", "table", "path"):
                raise BridgeError(f"option {o}: " + ("is for files" if o.lower() in REFUSED else "is not known"))
        if overwrite:
            raise BridgeError("loads append; overwrite is not supported")
        info = described(self.place())
        pairs = matched_columns(schema, list(info.columns))
        return BridgeWriter(self.place(), info, [(source, target.name) for source, target in pairs], uuid.uuid4().hex)


@dataclass
class Part(api.InputPartition):
    """Row groups of a file whose first byte is in [begin, end), or every file where path is None."""

    path: str | None
    begin: int = 0
    end: int | None = None
    files: list[str] = field(default_factory=list)


class BridgeReader(api.DataSourceReader):
    def __init__(self, place: Place, info: TableInfo, columns: list[str], where: P.Term | None, sessions: int, split: str) -> None:
        self.place, self.info, self.columns, self.sessions, self.split = place, info, columns, sessions, split
        self.pushed, self.kept = P.divided(where, info)
        if self.kept:
            raise BridgeError(f"option where: {', '.join(map(str, self.kept))} cannot be pushed; filter the DataFrame")

    def pushFilters(self, filters: list[api.Filter]) -> Iterator[api.Filter]:  # noqa: N802
        for f in filters:
            t = term(f)
            if t is not None and P.pushable(t, self.info):
                self.pushed.append(t)
            else:
                yield f

    def partitions(self) -> list[Part]:
        files = self.place.files()
        if U.choice("split", self.split, U.SPLITS) == "hash":
            raise BridgeError("split hash: files are read once; use extents, or repartition")
        work = U.plan(self.split, self.sessions, True, U.whole_bytes(files, self.sessions) if self.sessions > 1 else None, can_hash=False)
        if work.strategy == "extents":
            return [Part(files[r.data_object][0], r.start[1] * BLOCK, r.end[1] * BLOCK if r.end else None) for r in work.units]
        return [Part(None, files=[f for f, _ in files])]

    def read(self, part: Part) -> Iterator[pa.RecordBatch]:
        fs, _ = self.place.path()
        expression = reduce(and_, (arrow_filter(t, self.info) for t in self.pushed)) if self.pushed else None
        kinds = pa.schema([pa.field(c, to_arrow_type(self.info.schema[c].dataType)) for c in self.columns])
        for path in [part.path] if part.path else part.files:
            with fs.open_input_file(path) as f:
                meta = pq.ParquetFile(f).metadata
            starts = [first_byte(meta.row_group(i)) for i in range(meta.num_row_groups)]
            groups = [i for i, s in enumerate(starts) if part.path is None or s >= part.begin and (part.end is None or s < part.end)]
            if not groups:
                continue
            width = max(1, sum(meta.row_group(i).total_byte_size for i in groups) // max(1, sum(meta.row_group(i).num_rows for i in groups)))
            piece = ds.ParquetFileFormat().make_fragment(path, fs, row_groups=groups)
            for batch in piece.scanner(columns=self.columns, filter=expression, batch_size=max(1, min(BATCH_ROWS, BATCH_BYTES // width))).to_batches():
                if batch.num_rows:
                    yield batch.cast(kinds) if self.columns else batch


def first_byte(group: pq.RowGroupMetaData) -> int:
    c = group.column(0)
    return min(x for x in (c.dictionary_page_offset, c.data_page_offset) if x is not None)


def term(f: api.Filter) -> P.Term | None:
    """A filter of Spark's as a tree, or None."""
    ops = {api.EqualTo: "=", api.LessThan: "<", api.LessThanOrEqual: "<=", api.GreaterThan: ">", api.GreaterThanOrEqual: ">="}
    if isinstance(f, api.Not):
        inner = term(f.child)
        if isinstance(inner, P.IsNull):
            return P.IsNull(inner.column, not inner.negated)
        return P.Compare(inner.column, "<>", inner.value) if isinstance(inner, P.Compare) and inner.op == "=" else None
    if len(getattr(f, "attribute", ())) != 1:
        return None
    column = f.attribute[0]
    if type(f) in ops:
        return P.Compare(column, ops[type(f)], f.value)
    if isinstance(f, api.In):
        return P.In(column, tuple(f.value))
    return P.IsNull(column, isinstance(f, api.IsNotNull)) if isinstance(f, (api.IsNull, api.IsNotNull)) else None


def arrow_filter(t: P.Term, info: TableInfo) -> pc.Expression:
    """A pushed term in Arrow, with Spark's order of numbers: what is not a number is above all others."""
    if isinstance(t, (P.All, P.Any_)):
        return reduce(and_ if isinstance(t, P.All) else or_, (arrow_filter(x, info) for x in t.terms))
    c = info.column(t.column)
    f, kind = pc.field(c.name), to_arrow_type(info.schema[c.name].dataType)
    if isinstance(t, P.IsNull):
        return f.is_valid() if t.negated else ~f.is_valid()
    value = lambda v: pa.scalar(v, kind) if not pa.types.is_floating(kind) else pa.scalar(float(v), kind)
    if isinstance(t, P.In):
        return f.isin(pa.array([value(v).as_py() for v in t.values], kind))
    if isinstance(t, P.OnDate):
        low = datetime(t.day.year, t.day.month, t.day.day)
        return (f >= pa.scalar(low, kind)) & (f < pa.scalar(low + timedelta(days=1), kind))
    v = value(t.value)
    out = {"=": f == v, "<>": f != v, "<": f < v, "<=": f <= v, ">": f > v, ">=": f >= v}[t.op]
    return out | pc.is_nan(f) if pa.types.is_floating(kind) and t.op in (">", ">=", "<>") else out


@dataclass
class Staged(api.WriterCommitMessage):
    path: str | None
    rows: int


class BridgeWriter(api.DataSourceArrowWriter):
    def __init__(self, place: Place, info: TableInfo, pairs: list[tuple[str, str]], job: str) -> None:
        self.place, self.info, self.pairs, self.job = place, info, pairs, job

    def stage(self) -> tuple[arrow_fs.FileSystem, str, str]:
        fs, path = self.place.path()
        if fs.get_file_info(path).type == arrow_fs.FileType.File:
            raise BridgeError(f"table {self.place.table} is one file; loads need a folder")
        return fs, path, f"{path}/_stage-{self.job}"

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Staged:
        """A file under a name of its own for every attempt, so a repeated task never touches another's."""
        fs, _, stage = self.stage()
        source = dict(self.pairs)
        target = {c.name: c for c in self.info.columns}
        kinds = pa.schema([pa.field(f.name, to_arrow_type(f.dataType)) for f in self.info.schema])
        out, rows, path = None, 0, f"{stage}/part-{uuid.uuid4().hex}.parquet"
        given = {t: s for s, t in source.items()}
        for batch in iterator:
            cells = [fitted(batch.column(given[f.name]), target[f.name], f.type) if f.name in given else pa.nulls(batch.num_rows, f.type) for f in kinds]
            if out is None:
                fs.create_dir(stage, recursive=True)
                sink = fs.open_output_stream(path)
                out = pq.ParquetWriter(sink, kinds)
            out.write_batch(pa.RecordBatch.from_arrays(cells, schema=kinds))
            rows += batch.num_rows
        if out is None:
            return Staged(None, 0)
        out.close()
        sink.close()
        return Staged(path, rows)

    def commit(self, messages: list[Any]) -> None:
        fs, path, stage = self.stage()
        done: list[str] = []
        staged = [m.path for m in messages if m is not None and m.path]
        try:
            for p in staged:
                fs.move(p, final := f"{path}/{posixpath.basename(p)}")
                done.append(final)
        except Exception as e:
            left = taken_back(fs, done)
            raise (PartialLoadError if left else BridgeError)(f"{'PARTIAL load' if left else 'load failed'}: {len(left)} of {len(staged)} files stay in {path}: {e}") from e
        finally:
            dropped(fs, stage)

    def abort(self, messages: list[Any]) -> None:
        fs, _, stage = self.stage()
        dropped(fs, stage)


def taken_back(fs: arrow_fs.FileSystem, files: list[str]) -> list[str]:
    """Deletes published files; those that stay all the same."""
    left = []
    for f in files:
        try:
            fs.delete_file(f)
        except OSError:
            left.append(f)
    return left


def dropped(fs: arrow_fs.FileSystem, folder: str) -> None:
    if fs.get_file_info(folder).type == arrow_fs.FileType.Directory:
        fs.delete_dir(folder)
