"""The bridge: every query against DuckDB, and the rules of names, types, predicates, units, catalog and loads."""

from collections import Counter
from datetime import date, datetime
from decimal import Decimal

import duckdb
import pytest
from hypothesis import given
from hypothesis import strategies as st

from isthmus.functions import numeric
from isthmus.operators.queries import QUERIES, SQL
from isthmus.plans import predicates as P
from isthmus.plans import units as U
from isthmus.plans.scan import scan
from isthmus.sources.catalog import WRITES, Catalog, ReadOnlyError
from isthmus.sources.names import BridgeError, RemoteName, parse_name, unique_names
from isthmus.sources.tables import ParquetSide, TableInfo
from isthmus.sources.types import RemoteColumn, read_type
from isthmus.sources.writer import load

D = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents".split()


def plain(v):
    return v.normalize() if isinstance(v, Decimal) else v


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{D}/{t}.parquet'")
    df = QUERIES[name](spark, D)
    cols = sorted(df.columns)
    want = con.execute(f"SELECT {', '.join(cols)} FROM ({SQL[name]})").fetchall()
    assert Counter(tuple(map(plain, r)) for r in df.select(cols).collect()) == Counter(tuple(map(plain, r)) for r in want)


def test_names():
    assert parse_name("s.t") == RemoteName("S", "T")
    assert parse_name('"a.b"."C d"') == RemoteName("a.b", "C d")
    for bad in ("", "a.b.c", '"x', "1a", "a..b"):
        with pytest.raises(BridgeError):
            parse_name(bad)
    assert unique_names(["Id", "ID", "Id_1"]) == ["Id", "ID_2", "Id_1"]


def test_types():
    n = lambda p, s: read_type(RemoteColumn("c", "NUMBER", 22, p, s)).simpleString()
    assert [n(4, 0), n(9, 0), n(18, 0), n(38, 0), n(10, 2), n(5, -2), n(3, 5), n(38, -2)] == ["smallint", "int", "bigint", "decimal(38,0)", "decimal(10,2)", "decimal(7,0)", "decimal(5,5)", "double"]
    assert read_type(RemoteColumn("c", "XMLTYPE")) is None


@given(st.integers(-(10**38) + 1, 10**38 - 1), st.integers(0, 12))
def test_number_round_trip(value, scale):
    raw = numeric.encode_number(value, scale)
    assert raw and numeric.decode_number(raw).compare(Decimal(value).scaleb(-scale)) == 0 or not raw


COLUMNS = tuple(RemoteColumn(*c) for c in (("I", "NUMBER", 22, 9, 0), ("D", "NUMBER", 22, 10, 2), ("L", "NUMBER"), ("F", "BINARY_DOUBLE"), ("DT", "DATE"), ("TS", "TIMESTAMP(6)"), ("T9", "TIMESTAMP(9)"), ("V", "VARCHAR2", 40), ("N", "NVARCHAR2", 40), ("C", "CLOB"), ("R", "RAW", 16)))
INFO = TableInfo("t", None, COLUMNS)
A = P.Compare


@pytest.mark.parametrize(
    ("term", "pushed"),
    [(A("i", "=", 3), True), (A("I", "<", 1.5), False), (A("D", ">=", Decimal("1.25")), True), (A("I", "=", Decimal("1.5")), False), (A("L", "=", 1), False), (P.IsNull("L"), True), (A("F", "=", float("nan")), False), (A("F", "<", 2.0), True), (A("DT", "=", datetime(2024, 1, 1, 0, 0, 0, 5)), False), (A("DT", "=", datetime(2024, 1, 1)), True), (A("TS", "<=", datetime(2024, 1, 1, 0, 0, 0, 5)), True), (P.IsNull("T9"), False), (A("V", "<>", ""), False), (A("V", ">", "é"), True), (A("N", "=", "ü"), True), (A("N", ">", "ü"), False), (A("C", "=", "x"), False), (P.IsNull("C", True), True), (P.IsNull("R"), False), (P.In("I", (1, 2)), True), (P.In("I", ()), False), (P.In("I", tuple(range(1001))), False), (A("I", "=", 1) | A("V", "=", ""), False), (P.OnDate("DT", date(2024, 1, 5)), True), (P.OnDate("DT", date(9999, 12, 31)), False), (P.Local("true"), False)],
)
def test_pushable(term, pushed):
    assert P.pushable(term, INFO) is pushed


def test_sql_and_parts():
    pushed, kept = P.divided(A("V", "=", "it's :b1") & A("V", "<>", "") & P.OnDate("DT", date(2024, 1, 5)), INFO)
    binds = []
    text = " AND ".join(P.sql(t, INFO, binds) for t in pushed)
    assert text == '"V" = :b1 AND ("DT" >= :b2 AND "DT" < :b3)' and len(kept) == 1
    assert P.shown(text, binds).startswith("\"V\" = 'it''s :b1' AND")


def test_units():
    assert U.unit_blocks(100, 8) == 1024 and U.unit_blocks(10**6, 8) == 31250
    e = [U.Extent(1, 4, 8, 3000), U.Extent(1, 5, 0, 100), U.Extent(2, 4, 9000, 10)]
    r = U.ranges(e, 1024)
    assert sum(x.blocks for x in r) == 3110 and [x.blocks for x in r] == sorted((x.blocks for x in r), reverse=True)
    assert sum(x.end is None for x in r) == 2
    assert U.rowid(0, 0, 0, 0) == "A" * 18 and len(U.rowid(73000, 4, 131, 0)) == 18
    with pytest.raises(BridgeError):
        U.plan("extents", 4, False, None)
    assert U.plan("auto", 4, False, None).strategy == "hash" and U.plan("auto", 1, True, [1]).strategy == "none"


def test_scan_plan_is_pruned_and_pushed(spark):
    df, report = scan(ParquetSide(spark, D), "lineitem", ["l_orderkey"], A("l_quantity", ">", 49.0))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThan(l_quantity,49.0)" in plan and "l_extendedprice" not in plan
    assert report.where == '"l_quantity" > 49.0' and report.sql.startswith('SELECT "l_orderkey" FROM "lineitem"')
    with pytest.raises(BridgeError):
        scan(ParquetSide(spark, D), "lineitem", n_sessions=0)


def test_catalog_is_read_only(spark):
    c = Catalog(ParquetSide(spark, D))
    assert "orders" in c.tables() and c.table("ORDERS").count() == 1500 and len(WRITES) == 25
    for w in WRITES:
        with pytest.raises(ReadOnlyError):
            getattr(c, w)()
    with pytest.raises(BridgeError, match="did you mean"):
        c.table("order")


def test_load_is_whole_or_nothing(spark, tmp_path):
    target = [RemoteColumn("ID", "NUMBER", 22, 18, 0, nullable=False), RemoteColumn("S", "VARCHAR2", 3)]
    folder = str(tmp_path / "t")
    (tmp_path / "t").mkdir()
    assert load(spark.createDataFrame([(1, ""), (2, "ab")], "id long, s string"), folder, target) == 2
    assert sorted(map(tuple, spark.read.parquet(folder).collect())) == [(1, None), (2, "ab")]
    for bad in ([(3, "toolong")], [(None, "a")]):
        with pytest.raises(Exception, match="column"):
            load(spark.createDataFrame([(9, "ok"), *bad], "id long, s string").repartition(2), folder, target)
    assert spark.read.parquet(folder).count() == 2 and not list((tmp_path / "t").glob("_stage*"))
    with pytest.raises(BridgeError, match="convert with CAST"):
        load(spark.createDataFrame([(1, [1])], "id long, s array<int>"), folder, target)
