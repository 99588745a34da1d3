"""A folder of Parquet tables as a remote side: schemas, descriptions, synonyms, files frozen at planning, native reads.

The folder's own tables are those of the default schema; each subfolder that holds tables is a schema.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from isthmus.sources.names import BridgeError
from isthmus.sources.types import RemoteColumn


def remote_column(f: T.StructField) -> RemoteColumn:
    """The remote type that reads back as a field's type."""
    t = f.dataType
    whole = {T.ShortType: 4, T.ByteType: 4, T.IntegerType: 9, T.LongType: 18}
    if type(t) in whole:
        return RemoteColumn(f.name, "NUMBER", 22, whole[type(t)], 0, f.nullable)
    if isinstance(t, T.DecimalType):
        return RemoteColumn(f.name, "NUMBER", 22, t.precision, t.scale, f.nullable)
    names = {T.FloatType: "BINARY_FLOAT", T.DoubleType: "BINARY_DOUBLE", T.StringType: "VARCHAR2", T.BinaryType: "BLOB", T.DateType: "DATE", T.TimestampNTZType: "TIMESTAMP(6)", T.TimestampType: "TIMESTAMP(6) WITH TIME ZONE"}
    return RemoteColumn(f.name, names.get(type(t), "OBJECT"), 4000, nullable=f.nullable)


@dataclass(frozen=True)
class TableInfo:
    name: str
    schema: T.StructType
    columns: tuple[RemoteColumn, ...]
    kind: str = "table"
    organization: str = "HEAP"
    rows: int | None = None
    schema_name: str | None = None

    def column(self, name: str) -> RemoteColumn:
        """By exact name, else by a unique name without regard to case."""
        same = [c for c in self.columns if c.name == name] or [c for c in self.columns if c.name.lower() == name.lower()]
        if len(same) != 1:
            raise BridgeError(f"table {self.name}: {'no' if not same else 'more than one'} column {name!r}")
        return same[0]


@dataclass
class ParquetSide:
    """Tables under a folder of any file system that Spark reads. synonyms: names (schema or None for a public one, name) to names.
    declared: remote columns of a table (schema, name) where they differ from those that its files' types stand for."""

    spark: SparkSession
    folder: str
    synonyms: dict[tuple[str | None, str], tuple[str | None, str]] = field(default_factory=dict)
    declared: dict[tuple[str | None, str], tuple[RemoteColumn, ...]] = field(default_factory=dict)
    known: dict[tuple[str | None, str], TableInfo | None] = field(default_factory=dict)
    users: list[str] | None = None

    def _fs(self):
        jvm, conf = self.spark.sparkContext._jvm, self.spark.sparkContext._jsc.hadoopConfiguration()
        path = lambda p: jvm.org.apache.hadoop.fs.Path(p)
        return path(self.folder).getFileSystem(conf), path

    def schemas(self) -> list[str]:
        """The subfolders that hold tables, listed once until refresh()."""
        if self.users is None:
            fs, path = self._fs()
            folders = [s.getPath() for s in fs.listStatus(path(self.folder)) if s.isDirectory() and not s.getPath().getName().endswith(".parquet")]
            self.users = sorted(p.getName() for p in folders if any(s.getPath().getName().endswith(".parquet") for s in fs.listStatus(p)))
        return self.users

    def schema(self, name: str | None) -> str | None:
        """A schema by exact name, else by its name in upper, then lower case."""
        if name is None:
            return None
        found = next((n for n in (name, name.upper(), name.lower()) if n in self.schemas()), None)
        if found is None:
            raise BridgeError(f"no schema {name}")
        return found

    def place(self, schema: str | None) -> str:
        return f"{self.folder.rstrip('/')}/{schema}" if schema else self.folder.rstrip("/")

    def describe(self, table: str, schema: str | None = None) -> TableInfo | None:
        """A table's description, kept with its misses until refresh(): by exact name, then upper and lower case; then synonyms of the
        schema and public ones, up to eight deep."""
        key = (schema, table)
        if key not in self.known:
            self.known[key] = self._find(schema, table, 8)
        return self.known[key]

    def _find(self, schema: str | None, table: str, depth: int) -> TableInfo | None:
        names = list(dict.fromkeys((table, table.upper(), table.lower())))
        for n in names:
            if found := self._read(schema, n):
                return found
        for owner in dict.fromkeys((schema, None)):
            for n in names:
                if (target := self.synonyms.get((owner, n))) is not None:
                    if not depth:
                        raise BridgeError(f"synonym {table}: more than eight deep")
                    return self._find(*target, depth - 1)
        return None

    def _read(self, schema: str | None, name: str) -> TableInfo | None:
        from pyspark.errors import AnalysisException

        path = f"{self.place(schema)}/{name}.parquet"
        fs, at = self._fs()
        if not fs.exists(at(path)):
            return None
        try:
            df = self.spark.read.parquet(path)
        except AnalysisException:
            return None
        said = {c.name: c for c in self.declared.get((schema, name), ())}
        return TableInfo(name, df.schema, tuple(said.get(f.name) or remote_column(f) for f in df.schema), schema_name=schema)

    def list(self, schema: str | None = None) -> list[str]:
        fs, path = self._fs()
        return sorted(n.removesuffix(".parquet") for s in fs.listStatus(path(self.place(schema))) if (n := s.getPath().getName()).endswith(".parquet"))

    def describe_all(self, schema: str | None = None) -> list[TableInfo]:
        """Every table of a schema that can be read."""
        return [t for n in self.list(schema) if (t := self.describe(n, schema))]

    def frozen(self, info: TableInfo) -> list[str]:
        """The files of a table now: all partitions of a scan read these and no later ones."""
        return sorted(self.spark.read.parquet(f"{self.place(info.schema_name)}/{info.name}.parquet").inputFiles())

    def sizes(self, files: list[str]) -> list[tuple[str, int]]:
        """Files with their bytes."""
        fs, path = self._fs()
        return [(f, fs.getFileStatus(path(f)).getLen()) for f in files]

    def rows(self, info: TableInfo) -> int:
        """How many rows a table has by its files' footers; no column is read."""
        return self.read(info).count()

    def read(self, info: TableInfo, files: list[str] | None = None) -> DataFrame:
        root = f"{self.place(info.schema_name)}/{info.name}.parquet"
        fs, path = self._fs()
        reader = self.spark.read.schema(info.schema)
        # columns that are names of folders, not in the files
        reader = reader.option("basePath", root) if files and fs.getFileStatus(path(root)).isDirectory() else reader
        return reader.parquet(*(files or [root]))

    def refresh(self) -> None:
        self.known.clear()
        self.users = None
