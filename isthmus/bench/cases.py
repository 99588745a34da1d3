"""Tables of a stated size from row numbers alone: the same values wherever they are made."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from isthmus.sources.types import RemoteColumn

SEED, NULL_SHARE = 42, 20  # one cell in twenty is null, but for keys
WRITE_COLUMNS, WRITE_ROWS = (5, 20, 50), (100_000, 1_000_000, 10_000_000)
DAY_ZERO = "2020-01-01"
NAMES = ("Ada", "Bela", "Chloe", "Dov", "Edda", "Femi", "Gul", "Hana")


@dataclass(frozen=True)
class Case:
    name: str
    df: DataFrame
    target: tuple[RemoteColumn, ...]

    def ddl(self) -> str:
        """The table's columns as a CREATE TABLE would list them."""

        def kind(c: RemoteColumn) -> str:
            if c.data_type == "NUMBER":
                return "NUMBER" if c.precision is None else f"NUMBER({c.precision},{c.scale or 0})"
            return f"{c.data_type}({c.length})" if c.data_type in ("VARCHAR2", "CHAR") else c.data_type

        return ", ".join(f'"{c.name}" {kind(c)}{"" if c.nullable else " NOT NULL"}' for c in self.target)


def drawn(i: int, of: int) -> Column:
    """A number in 0..of-1 for column i of a row: a hash of the row's number, so no state is needed."""
    return F.pmod(F.xxhash64(F.col("id"), F.lit(SEED), F.lit(i)), F.lit(of))


def some_null(i: int, value: Column) -> Column:
    return F.when(F.pmod(F.xxhash64(F.col("id"), F.lit(SEED), F.lit(i), F.lit("null")), F.lit(NULL_SHARE)) != 0, value)


def text(i: int, low: int, high: int) -> Column:
    """Letters and digits, low to high of them."""
    return F.substring(F.concat(F.md5(F.concat_ws("-", "id", F.lit(i))), F.md5(F.concat_ws("+", "id", F.lit(i)))), F.lit(1), (drawn(i, high - low + 1) + low).cast("int"))


def status(i: int) -> Column:
    """Of ten rows six are active, two suspended, one closed and one pending."""
    d = drawn(i, 10)
    return F.when(d < 6, "ACTIVE").when(d < 8, "SUSPENDED").when(d < 9, "CLOSED").otherwise("PENDING")


def day(i: int) -> Column:
    return F.date_add(F.lit(DAY_ZERO).cast("date"), drawn(i, 2000).cast("int"))


def moment(i: int) -> Column:
    return F.timestamp_micros(F.lit(1_577_836_800_000_000) + drawn(i, 10**14)).cast("timestamp_ntz")


def write_cycle(i: int) -> tuple[str, Column, RemoteColumn]:
    """Column i of a write case beyond its five first: ten kinds in turn."""
    kinds = [
        ("i32", (drawn(i, 2**31) - 2**30).cast("int"), ("NUMBER", 22, 10, 0)),
        ("f64", drawn(i, 10**9).cast("double") / 1024, ("BINARY_DOUBLE",)),
        ("dec", (drawn(i, 10**12).cast("decimal(18,0)") / 100).cast("decimal(15,2)"), ("NUMBER", 22, 15, 2)),
        ("alnum", text(i, 8, 24), ("VARCHAR2", 40)),
        ("email", F.concat(text(i, 5, 12), F.lit("@example.org")), ("VARCHAR2", 60)),
        ("fname", F.element_at(F.array(*map(F.lit, NAMES)), (drawn(i, len(NAMES)) + 1).cast("int")), ("VARCHAR2", 20)),
        ("date", day(i), ("DATE",)),
        ("ts", moment(i), ("TIMESTAMP(6)",)),
        ("bool", drawn(i, 2) == 1, ("NUMBER", 22, 1, 0)),
        ("status", status(i), ("VARCHAR2", 12)),
    ]
    name, value, target = kinds[i % len(kinds)]
    return f"{name}_{i}", value, RemoteColumn(f"{name}_{i}", *target)


def write_case(spark: SparkSession, rows: int, columns: int, parts: int | None = None) -> Case:
    """rows x columns to be loaded: id, amount, label, operation_date, event_time, then the cycle."""
    first = [
        ("id", F.col("id").cast("int"), RemoteColumn("id", "NUMBER", 22, 10, 0, nullable=False)),
        ("amount", (drawn(1001, 10**11).cast("decimal(15,0)") / 100).cast("decimal(15,2)"), RemoteColumn("amount", "NUMBER", 22, 15, 2)),
        ("label", text(1002, 5, 30), RemoteColumn("label", "VARCHAR2", 30)),
        ("operation_date", day(1003), RemoteColumn("operation_date", "DATE")),
        ("event_time", moment(1004), RemoteColumn("event_time", "TIMESTAMP(6)")),
    ]
    every = (first + [write_cycle(i) for i in range(max(0, columns - 5))])[:columns]
    df = spark.range(1, rows + 1, 1, parts) if parts else spark.range(1, rows + 1)
    return Case(f"write_{rows}_{columns}", df.select(*((v if n == "id" else some_null(k, v)).alias(n) for k, (n, v, _) in enumerate(every))), tuple(t for _, _, t in every))


def read_cycle(i: int) -> tuple[str, Column]:
    """Column i of a read case beyond its keys: eleven kinds in turn, and a long text every 250 columns."""
    if i % 250 == 249:
        long = F.when(drawn(i, 50) == 0, F.when(drawn(i + 10**6, 5) == 0, F.repeat(text(i, 20, 20), 1000)).otherwise(text(i, 20, 60)))
        return f"clob_{i}", long
    k = i % 11
    if k < 3:
        return f"v_{i}", text(i, 4, 40)
    if k < 5:
        return f"n_{i}", drawn(i, 10**15).cast("decimal(38,0)")
    if k < 7:
        return f"d_{i}", (drawn(i, 10**16).cast("decimal(25,0)") / 10**6).cast("decimal(25,9)")
    return (f"dt_{i}", day(i).cast("timestamp_ntz")) if k == 7 else (f"c_{i}", F.when(drawn(i, 10) < 8, "Y").otherwise("N")) if k == 8 else (f"ts_{i}", moment(i)) if k == 9 else (f"u_{i}", drawn(i, 10**9).cast("double") / 7)


def read_case(spark: SparkSession, rows: int, columns: int) -> DataFrame:
    """A target day of rows rows and two neighbours of a twentieth each; part_date and sub_key (A, B, C as 6 : 3 : 1) are to be the
    folders of a partitioned table."""
    side = max(1, rows // 20)
    n = F.col("id")
    date = F.when(n <= rows, "2024-05-07").when(n <= rows + side, "2024-05-06").otherwise("2024-05-08").cast("date")
    d = drawn(2001, 10)
    keys = [date.alias("part_date"), F.when(d < 6, "A").when(d < 9, "B").otherwise("C").alias("sub_key"), n.cast("decimal(38,0)").alias("id")]
    return spark.range(1, rows + 2 * side + 1).select(*keys, *(some_null(k, v).alias(c) for k, (c, v) in enumerate(map(read_cycle, range(max(0, columns - 3))))))
