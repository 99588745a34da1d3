"""Sides, sources and sinks: the filter battery, splits, types, loads, the named format, a database behind JDBC, catalogs and streams."""

import math
import random
import struct
import warnings
from collections import Counter
from datetime import date, datetime, timedelta
from decimal import Decimal

import duckdb
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql import types as T

from isthmus.functions import numeric, temporal
from isthmus.functions.text import first_invalid, valid_utf8
from isthmus.plans import predicates as P
from isthmus.plans import units as U
from isthmus.plans.conditions import condition
from isthmus.plans.remote_sql import scan_sql
from isthmus.plans.scan import scan
from isthmus.sources import datasource, writer
from isthmus.sources.catalog import Catalog, ReadOnlyError
from isthmus.sources.jdbc import JdbcSide, fetch_rows
from isthmus.sources.names import BridgeError, RemoteError, quote
from isthmus.sources.secrets import create_secret, drop_secret, redacted, secret
from isthmus.sources.tables import ParquetSide, TableInfo
from isthmus.sources.types import RemoteColumn, read_type
from isthmus.streaming import follow

D = "/root/testdata/sf0.001"

# ---------------------------------------------------------------- the filter battery

REMOTE = {
    "id": ("NUMBER", 22, 10, 0), "part_date": ("DATE",), "sub_key": ("VARCHAR2", 8), "n9": ("NUMBER", 22, 9, 0), "n18": ("NUMBER", 22, 18, 0), "n38": ("NUMBER", 22, 38, 0),
    "dec": ("NUMBER", 22, 10, 2), "amount": ("NUMBER",), "bf": ("BINARY_FLOAT",), "bd": ("BINARY_DOUBLE",), "ts": ("TIMESTAMP(6)",), "name": ("VARCHAR2", 40), "nname": ("NVARCHAR2", 20),
    "flag": ("CHAR", 3), "note": ("CLOB",),
}
COLUMNS = tuple(RemoteColumn(n, *t) for n, t in REMOTE.items())


def battery_table(spark):
    """30,000 rows with nulls, odd numbers, padding and text of several alphabets, from row numbers."""
    exprs = [
        "id", "CASE WHEN id % 97 = 0 THEN NULL WHEN id % 5 < 3 THEN timestamp_ntz'2024-05-06' + make_dt_interval(CAST(id % 5 AS INT)) WHEN id % 5 = 3 THEN timestamp_ntz'2024-05-09' + make_dt_interval(CAST(id % 3 AS INT)) ELSE timestamp_ntz'2024-05-07 10:20:30' END AS part_date",
        "CASE id % 4 WHEN 0 THEN 'A' WHEN 1 THEN 'B' WHEN 2 THEN 'C' || id % 7 END AS sub_key", "CASE WHEN id % 11 > 0 THEN CAST(id % 1000 - 500 AS INT) END AS n9", "id * 1000000 AS n18",
        "CASE WHEN id % 17 > 0 THEN CAST((id % 100 - 50) AS DECIMAL(38,0)) * CAST('100000000000000000000' AS DECIMAL(38,0)) END AS n38", "CASE WHEN id % 13 > 0 THEN CAST((id % 2000 - 1000) / 4.0BD AS DECIMAL(10,2)) END AS dec",
        "CASE WHEN id % 19 = 0 THEN NULL WHEN id % 3 = 0 THEN id % 7 / 2D WHEN id % 3 = 1 THEN 0.1D ELSE id / 3D END AS amount",
        "CASE WHEN id % 1001 = 0 THEN float('NaN') WHEN id % 1003 = 0 THEN float('Infinity') WHEN id % 23 = 0 THEN NULL WHEN id % 29 = 0 THEN CAST(0.1 AS FLOAT) ELSE CAST((id % 100) / 4.0 AS FLOAT) END AS bf",
        "CASE WHEN id % 1009 = 0 THEN double('-Infinity') WHEN id % 31 = 0 THEN NULL ELSE (id % 50 - 25) / 8D END AS bd", "CASE WHEN id % 37 > 0 THEN timestamp_ntz'2024-01-01' + make_dt_interval(0, 0, 0, CAST((id % 1000) * 3600.5BD AS DECIMAL(18,6))) END AS ts",
        "CASE id % 6 WHEN 0 THEN 'é' || id % 9 WHEN 1 THEN 'Z' || id % 9 WHEN 2 THEN element_at(array('abc', 'Abc', 'abc ', 'ab'), CAST(id % 4 + 1 AS INT)) WHEN 3 THEN '😀' || id % 5 WHEN 4 THEN 'a b' || id % 3 END AS name",
        "CASE WHEN id % 7 > 0 THEN 'ü' || id % 20 END AS nname", "CASE id % 3 WHEN 0 THEN 'A  ' WHEN 1 THEN 'AB ' END AS flag", "CASE WHEN id % 2 = 0 THEN 'x' || id END AS note",
    ]
    n38 = "CASE WHEN id % 17 > 0 THEN CAST(concat(CAST(id % 100 - 50 AS STRING), CASE WHEN id % 100 = 50 THEN '' ELSE '00000000000000000000' END) AS DECIMAL(38,0)) END AS n38"
    exprs[5] = n38  # without a product, whose type would be wider
    return spark.range(1, 30_001).selectExpr(*exprs)


@pytest.fixture(scope="module")
def battery(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("battery"))
    df = battery_table(spark)
    df.coalesce(3).write.parquet(f"{folder}/t.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE TABLE t AS SELECT * FROM '{folder}/t.parquet/*.parquet'")
    return ParquetSide(spark, folder, declared={(None, "t"): COLUMNS}), con


PUSHED, KEPT, PARTIAL = "pushed", "kept", "partial"
TS = "TIMESTAMP '2024-05-07 10:20:30"
BATTERY = {
    PUSHED: [
        "n9 = 7", "n9 <> 7", "n9 != 7", "n9 < -100", "n9 <= 0", "n9 > 400", "n9 >= 499", "n9 BETWEEN -10 AND 10", "n9 IN (1, 2, 3, -500)", "n9 IS NULL", "n9 IS NOT NULL", "7 = n9", "100 > n9", "-3 <= n9",
        "n18 >= 9000000000", "n18 = 5000000", "n38 > 1000000000000000000000", "n38 = 0", "n38 IS NULL", "dec = 12.25", "dec < -100.5", "dec BETWEEN -1 AND 1.5", "dec IN (0.00, 0.25, -250.00)", "dec IN (0, 0.25, -250)", "dec > 3",
        "amount IS NULL", "amount IS NOT NULL", "bf = 2.5", "bf = 0.1", "bf > 20", "bf <> 0.25", "bf < 3", "bd < -1.5", "bd >= 0", "bd IN (0.125, 1)",
        "part_date = DATE '2024-05-07'", f"part_date = {TS}'", "part_date > DATE '2024-05-07'", "part_date BETWEEN DATE '2024-05-06' AND DATE '2024-05-07'", "part_date IN (DATE '2024-05-06', DATE '2024-05-08')",
        "CAST(part_date AS DATE) = DATE '2024-05-07'", "DATE '2024-05-07' = CAST(part_date AS DATE)", "part_date IS NULL", "ts >= TIMESTAMP '2024-01-10 12:00:00.5'", "ts < TIMESTAMP '2024-01-02'", "ts = TIMESTAMP '2024-01-01 01:00:00.5'",
        "sub_key = 'A'", "sub_key IN ('A', 'B')", "sub_key <> 'A'", "name > 'Z'", "name < 'é'", "name BETWEEN 'a' AND 'abc'", "name >= '😀'", "name = 'abc'", "name = 'abc '", "nname = 'ü3'", "nname IN ('ü1', 'ü2')",
        "flag = 'A  '", "flag = 'A'", "flag IN ('AB ', 'A  ')", "flag > 'A'", "note IS NULL", "note IS NOT NULL", "n9 = 1 OR sub_key = 'B'", "(part_date = DATE '2024-05-07' AND sub_key = 'A') OR n9 < 0", "part_date = DATE '2024-05-07' AND sub_key = 'A'",
    ],
    KEPT: [
        "n9 = 1.5", "n9 NOT IN (1, 2)", "n9 IS DISTINCT FROM 5", "amount = 1.5", "amount > 0.1", "bd = 'infinity'::DOUBLE", f"part_date = {TS}.5'", "CAST(part_date AS DATE) >= DATE '2024-05-07'", "CAST(ts AS DATE) = DATE '2024-01-05'", "TRY_CAST(name AS INTEGER) = 3",
        "sub_key <> ''", "sub_key = ''", "length(name) > 3", "name LIKE 'Z%'", "nname > 'ü1'", "note = 'x2'", "n9 = 1 OR length(name) > 3", "NOT (n9 = 5)", "n9 + 1 = 5", "n9 = id",
    ],
    PARTIAL: ["part_date = DATE '2024-05-07' AND length(name) > 3", "n9 > 0 AND (sub_key = 'A' OR name LIKE 'a%')"],
}


@pytest.mark.parametrize(("where", "place"), [(w, p) for p, ws in BATTERY.items() for w in ws])
def test_battery(spark, battery, where, place):
    """Every predicate through a scan and on a full copy elsewhere; and where each of its terms ran."""
    side, con = battery
    df, report = scan(side, '"t"', ["id"], where)
    if "infinity" in where:
        df = scan(side, '"t"', ["id"], where.replace("'infinity'::DOUBLE", "double('infinity')"))[0]
    want = [r[0] for r in con.execute(f"SELECT id FROM t WHERE {where} ORDER BY id").fetchall()]
    assert sorted(r.id for r in df.collect()) == want
    assert {PUSHED: bool(report.where) and not report.kept, KEPT: not report.where and bool(report.kept), PARTIAL: bool(report.where) and bool(report.kept)}[place]


def test_battery_is_selective(battery):
    _, con = battery
    counts = [con.execute(f"SELECT count(*) FROM t WHERE {w}").fetchone()[0] for ws in BATTERY.values() for w in ws]
    assert len(counts) >= 76 and sum(0 < n < 15_000 for n in counts) >= 40


@pytest.mark.parametrize("seed", range(12))
def test_random_predicates(spark, battery, seed):
    """Random trees over the battery's columns, against DuckDB."""
    side, con = battery
    r = random.Random(seed)
    plain = [w for w in BATTERY[PUSHED] + BATTERY[KEPT] if "infinity" not in w]

    def tree(depth):
        if depth == 0 or r.random() < 0.3:
            return f"({r.choice(plain)})"
        return f"({tree(depth - 1)} {r.choice(['AND', 'OR'])} {tree(depth - 1)})"

    for _ in range(4):
        where = tree(3)
        df, _ = scan(side, '"t"', ["id"], where)
        assert sorted(x.id for x in df.collect()) == [x[0] for x in con.execute(f"SELECT id FROM t WHERE {where} ORDER BY id").fetchall()], where


SHAPES = [
    "SELECT (SELECT max(ts) FROM {t} WHERE sub_key = 'A') IS NULL AS a, (SELECT max(ts) FROM {t} WHERE sub_key = 'NONE') IS NULL AS b",
    "SELECT (SELECT max(id) FROM {t} WHERE n9 = 7) AS a, (SELECT max(id) FROM {t} WHERE n9 = 8) AS b",
    "SELECT id, sub_key, count(*) OVER (PARTITION BY sub_key) AS n FROM {t} WHERE part_date = DATE '2024-05-07'",
    "SELECT id, flag, count(*) OVER (PARTITION BY flag) AS n FROM {t} WHERE n9 IN (1, 2, 3)",
    "WITH c AS (SELECT * FROM {t}) SELECT (SELECT count(*) FROM c WHERE n9 = 7) AS x, (SELECT max(id) FROM c WHERE sub_key = 'B') AS y",
    "WITH c AS (SELECT * FROM {t}) (SELECT id FROM c WHERE n9 = 7 ORDER BY id LIMIT 3) UNION ALL (SELECT id FROM c WHERE n9 = 8 ORDER BY id LIMIT 3)",
    "SELECT id FROM {t} WHERE sub_key = 'A' AND n9 > 0 ORDER BY id LIMIT 7",
    "SELECT count(*) AS n, bool_and(sub_key = 'A' AND n9 > 0) AS ok FROM (SELECT * FROM {t} WHERE sub_key = 'A' AND n9 > 0 LIMIT 50)",
]


@pytest.mark.parametrize("query", SHAPES)
def test_plan_shapes_keep_each_scans_filter(spark, battery, query):
    side, con = battery
    df = scan(side, '"t"')[0]
    got = spark.sql(query, t=df)
    assert Counter(map(tuple, got.collect())) == Counter(con.execute(query.format(t="t")).fetchall())
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [" in plan and "PushedFilters: []" not in plan


def test_conditions_are_read_or_left():
    info = TableInfo("t", None, COLUMNS)
    assert condition("n9 = 1 AND \"sub_key\" <> 'it''s'", info) == P.All((P.Compare("n9", "=", 1), P.Compare("sub_key", "<>", "it's")))
    assert condition("n9 BETWEEN 1 AND 2 OR length(name) BETWEEN 1 AND 2", info).terms[1] == P.Local("length(name) BETWEEN 1 AND 2")
    assert condition("lower(name) = 'a' AND n9 IN (1, -2)", info) == P.All((P.Local("lower(name) = 'a'"), P.In("n9", (1, -2))))
    for odd in ("", "((", "n9 =", "n9 = DATE '2024-13-01'", "unknown = 3"):
        assert isinstance(condition(odd, info), P.Local)


def test_constants_must_fit_the_column():
    info = TableInfo("t", None, COLUMNS)
    for v, fits in ((10**9, False), (10**9 - 1, True), (Decimal("1E+3"), True), (Decimal("0.5"), False), (True, False), (Decimal("NaN"), False)):
        assert P.pushable(P.Compare("n9", "=", v), info) is fits
    for v, fits in ((Decimal("0.125"), False), (Decimal("99999999.99"), True), (Decimal("100000000"), False), (3, True)):
        assert P.pushable(P.Compare("dec", "=", v), info) is fits
    assert not P.pushable(P.OnDate("ts", date(2024, 1, 5)), info) and P.pushable(P.OnDate("part_date", date(2024, 1, 5)), info)
    for side, column, op, value, pushed in (
        (P.Side("UTF8"), "name", "=", "é", True), (P.Side("UTF8"), "name", ">", "é", False), (P.Side("WE8ISO8859P1"), "name", "=", "abc", True), (P.Side("WE8ISO8859P1"), "name", "=", "é", False),
        (P.Side(), "name", "=", "x" * 4001, False), (P.Side(), "name", "=", "a\0", False), (P.Side(), "nname", "<", "a", False),
    ):
        assert P.pushable(P.Compare(column, op, value), info, side) is pushed
    ci = TableInfo("t", None, (RemoteColumn("v", "VARCHAR2", 10, collation="BINARY_CI"),))
    assert not P.pushable(P.Compare("v", "=", "a"), ci) and P.pushable(P.IsNull("v"), ci)


# ---------------------------------------------------------------- scan SQL, units, reports


def test_scan_sql_numbers_its_binds_through():
    info = TableInfo("T", None, (RemoteColumn("A", "NUMBER", 22, 9, 0), RemoteColumn("Z", "TIMESTAMP(6) WITH TIME ZONE"), RemoteColumn("R", "ROWID"), RemoteColumn("TS", "TIMESTAMP(6)")))
    where = P.Compare("A", ">", 5) & P.Compare("TS", "=", datetime(2024, 1, 2, 3, 4, 5, 6)) & P.Local("f(A)")
    s = scan_sql(info, list(info.columns[:3]), where, U.Range(7, (4, 8), (4, 1032), 1024), 99, "S", tag="x")
    assert s.text == """SELECT /* x */ "A", SYS_EXTRACT_UTC("Z"), ROWIDTOCHAR("R") FROM "S"."T" AS OF SCN TO_NUMBER(:b1) WHERE "A" > :b2 AND "TS" = TO_TIMESTAMP(:b3, 'YYYY-MM-DD HH24:MI:SS.FF6') AND ROWID >= CHARTOROWID(:b4) AND ROWID < CHARTOROWID(:b5)"""
    assert s.binds == (99, 5, "2024-01-02 03:04:05.000006", U.rowid(7, 4, 8, 0), U.rowid(7, 4, 1032, 0))
    assert scan_sql(info, [], None, (1, 4)).text == 'SELECT 1 FROM "T" WHERE ORA_HASH(ROWID, :b1) = :b2'
    last = scan_sql(info, [], None, U.Range(7, (4, 8), None, 10))
    assert "<= CHARTOROWID(:b2)" in last.text and last.binds[1] == U.rowid(7, 1023, 2**22 - 1, 65535)
    assert "> 5 AND" in s.shown() and "99" in s.shown()
    with pytest.raises(BridgeError):
        scan_sql(info, [], change_number=-1)


def test_row_addresses():
    assert U.rowid(1, 1, 1, 1) == "AAAAABAABAAAAABAAB" and U.rowid(2**32 - 1, 1023, 2**22 - 1, 65535) == "D/////AP/AAP///P//"
    assert U.rowid(7, 1024, (5 << 22) | 9, 0, bigfile=True) == "AAAAAHAAFAAAAAJAAA"
    for n, sessions, blocks in ((100_000, 8, 3125), (100, 8, 1024), (1024, 8, 1024), (32_768, 8, 1024), (32_800, 8, 1025)):
        assert U.unit_blocks(n, sessions) == blocks


@settings(max_examples=60, deadline=None)
@given(st.lists(st.tuples(st.integers(1, 3), st.integers(1, 3), st.integers(1, 4000)), max_size=12), st.integers(1, 3000))
def test_ranges_cover_every_block_once(given_extents, unit):
    extents, at = [], {}
    for obj, file, blocks in given_extents:
        begin = at.get(file, 8)
        at[file] = begin + blocks + 3
        extents.append(U.Extent(obj, file, begin, blocks))
    ranges = U.ranges(extents, unit)
    assert [r.blocks for r in ranges] == sorted((r.blocks for r in ranges), reverse=True) and all(r.blocks <= unit for r in ranges)
    for obj in {e.data_object for e in extents}:
        mine = sorted((r for r in ranges if r.data_object == obj), key=lambda r: r.start)
        assert sum(r.end is None for r in mine) == 1 and mine[-1].end is None
        assert all(a.end == b.start for a, b in zip(mine, mine[1:], strict=False))
        places = [(e.file, b) for e in extents if e.data_object == obj for b in range(e.block, e.block + e.blocks)]
        assert all(sum(r.start <= p and (r.end is None or p < r.end) for r in mine) == 1 for p in places[:: max(1, len(places) // 50)])
    assert sum(r.blocks for r in ranges) == sum(e.blocks for e in extents)


def test_organizations_without_extents():
    assert U.why_not_extents("HEAP") == "" and "IOT" in U.why_not_extents("IOT") and "not listed" in U.why_not_extents("NEW")
    with pytest.raises(BridgeError, match="EXTERNAL"):
        U.plan("extents", 4, True, None, U.why_not_extents("EXTERNAL"))


def test_reports(spark):
    side = ParquetSide(spark, D)
    df, report = scan(side, '"orders"', ["o_orderkey"], "o_orderstatus = 'F' AND length(o_orderpriority) > 3", 4)
    assert report.explained() == {"Table": "orders", "Remote WHERE": "\"o_orderstatus\" = 'F'", "Kept": "Local(condition='length(o_orderpriority) > 3')", "Split": "extents", "Snapshot": "1 files"}
    ran = report.analyzed(df)
    assert ran["rows"] == df.count() and ran["seconds"] > 0 and ran["columns"] == ["o_orderkey"]
    again = scan(side, '"orders"', ["o_orderkey"], "o_orderstatus = 'F' AND length(o_orderpriority) > 3", 4)[1]
    assert report.key == again.key != scan(side, '"orders"', ["o_orderkey"])[1].key


def test_hash_split_reads_files_once(spark):
    df = scan(ParquetSide(spark, D), '"lineitem"', ["l_orderkey"], n_sessions=4, split="hash")[0]
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and df.count() == spark.read.parquet(f"{D}/lineitem.parquet").count() and df.rdd.getNumPartitions() == 4


def test_snapshot_is_the_files_of_planning(spark, tmp_path):
    spark.range(10).write.parquet(f"{tmp_path}/t.parquet")
    side = ParquetSide(spark, str(tmp_path))
    frozen, _ = scan(side, '"t"')
    later, _ = scan(side, '"t"', snapshot="none")
    spark.range(5).write.mode("append").parquet(f"{tmp_path}/t.parquet")
    assert frozen.count() == 10 and scan(side, '"t"')[0].count() == 15
    with pytest.raises(BridgeError, match="change number"):
        scan(side, '"t"', snapshot="scn")
    assert later.columns == ["id"]


# ---------------------------------------------------------------- types and codecs

P15 = Decimal("1234567890123.45")
READ = [  # remote type, stored as, rows, read type, rows read
    (("NUMBER", 22, 4, 0), "smallint", [-9999, None, 1234], "smallint", None), (("NUMBER", 22, 9, 0), "int", [999999999, None, -5], "int", None), (("NUMBER", 22, 18, 0), "bigint", [-(10**18) + 1, None, 3], "bigint", None),
    (("NUMBER", 22, 9, 0), "decimal(12,0)", [Decimal(7), None, Decimal(-999999999)], "int", [7, None, -999999999]), (("NUMBER", 22, 15, 2), "decimal(15,2)", [P15, None, Decimal("-0.01")], "decimal(15,2)", None),
    (("NUMBER", 22, 15, 2), "decimal(20,4)", [Decimal("1.2500"), None, Decimal("0")], "decimal(15,2)", [Decimal("1.25"), None, Decimal("0.00")]), (("NUMBER", 22, 25, 9), "decimal(25,9)", [Decimal("1234567890123456.123456789"), None, Decimal("-0.000000001")], "decimal(25,9)", None),
    (("NUMBER", 22, 38, 0), "decimal(38,0)", [Decimal(10**38 - 1), None, Decimal(-(10**38) + 1)], "decimal(38,0)", None), (("NUMBER", 22, 38, 10), "decimal(38,10)", [Decimal("-1844674407.3709551616"), None, Decimal("1")], "decimal(38,10)", None),
    (("NUMBER", 22, None, 3), "decimal(38,3)", [Decimal("1.5"), None, Decimal("2")], "decimal(38,3)", None), (("NUMBER", 22, 5, -2), "decimal(7,0)", [Decimal(1234500), None, Decimal(-9999900)], "decimal(7,0)", None), (("NUMBER", 22, 3, 5), "decimal(5,5)", [Decimal("0.00123"), None, Decimal("-0.00999")], "decimal(5,5)", None),
    (("NUMBER",), "decimal(20,4)", [Decimal("0.1"), None, Decimal("-1234.5")], "double", [0.1, None, -1234.5]), (("FLOAT", 10), "double", [2.5, None, 1e20], "double", None), (("BINARY_FLOAT",), "float", [1.5, None, -0.25], "float", None), (("BINARY_DOUBLE",), "double", [1e300, None, math.inf], "double", None),
    (("DATE",), "timestamp_ntz", [datetime(2024, 5, 7, 10, 20, 30), None, datetime(1969, 12, 31, 23, 59, 59)], "timestamp_ntz", None), (("DATE",), "date", [date(1, 1, 1), None, date(9999, 12, 31)], "timestamp_ntz", [datetime(1, 1, 1), None, datetime(9999, 12, 31)]),
    (("TIMESTAMP(6)",), "timestamp_ntz", [datetime(2024, 5, 7, 10, 20, 30, 123456), None, datetime(1582, 10, 4)], "timestamp_ntz", None), (("TIMESTAMP(0)",), "timestamp_ntz", [datetime(9999, 12, 31, 23, 59, 59), None, datetime(2000, 2, 29)], "timestamp_ntz", None),
    (("VARCHAR2", 4000), "string", ["é漢字😀 text", None, "x"], "string", None), (("NVARCHAR2", 20), "string", ["Ünïcødé 漢字😀", None, "n"], "string", None), (("CHAR", 1), "string", ["Y", None, "N"], "string", None), (("CHAR", 3), "string", ["A", None, "abc"], "string", ["A  ", None, "abc"]),
    (("NCHAR", 4), "string", ["é", None, "漢字"], "string", ["é   ", None, "漢字  "]), (("CLOB",), "string", ["clob é漢字😀" * 9000, None, ""], "string", None), (("VARCHAR2", 40), "binary", [b"caf\xc3\xa9", None, b""], "string", ["café", None, ""]),
    (("RAW", 16), "binary", [b"\xde\xad", None, b"\x00A."], "binary", None), (("BLOB",), "binary", [b"\x00\x01AK\xff" * 15000, None, b""], "binary", None), (("ROWID",), "string", ["AAAAABAABAAAAABAAB", None, "x"], "string", None),
]


@pytest.mark.parametrize("case", READ, ids=lambda c: f"{c[0][0]}{c[0][1:]}-{c[1]}")
def test_read_types(spark, tmp_path, case):
    remote, stored, values, kind, want = case
    spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, c {stored}").write.parquet(f"{tmp_path}/t.parquet")
    side = ParquetSide(spark, str(tmp_path), declared={(None, "t"): (RemoteColumn("c", *remote),)})
    df = scan(side, '"t"', ["i", "c"])[0].orderBy("i")
    assert dict(df.dtypes)["c"] == kind and read_type(RemoteColumn("c", *remote)).simpleString() == kind
    got = [bytes(r.c) if isinstance(r.c, bytearray) else r.c for r in df.collect()]
    assert got == (values if want is None else want)


@pytest.mark.parametrize(("remote", "stored", "value", "says"), [(("NUMBER", 22, 4, 0), "int", 10_000, "not exact"), (("NUMBER", 22, 5, 2), "decimal(10,4)", Decimal("1.005"), "not exact"), (("VARCHAR2", 9), "binary", b"ok\xff", "UTF-8 at byte 2")])
def test_values_that_do_not_fit_name_their_column(spark, tmp_path, remote, stored, value, says):
    spark.createDataFrame([(value,)], f"odd {stored}").write.parquet(f"{tmp_path}/t.parquet")
    side = ParquetSide(spark, str(tmp_path), declared={(None, "t"): (RemoteColumn("odd", *remote),)})
    with pytest.raises(Exception, match=f"column odd.*{says}"):
        scan(side, '"t"', ["odd"])[0].collect()


def test_unconstrained_numbers(spark, tmp_path):
    spark.createDataFrame([(Decimal("0.0500"),), (Decimal("-2.5000"),), (Decimal("1234.0000"),), (None,)], "n decimal(20,4)").write.parquet(f"{tmp_path}/t.parquet")
    side = ParquetSide(spark, str(tmp_path), declared={(None, "t"): (RemoteColumn("n", "NUMBER"),)})
    read = lambda o: [r.n for r in scan(side, '"t"', unconstrained_number=o)[0].collect()]
    assert set(read("DOUBLE")) == {0.05, -2.5, 1234.0, None} and set(read("varchar")) == {"0.05", "-2.5", "1234", None}
    assert set(read("DECIMAL(9,0)")) == {Decimal(0), Decimal(-3), Decimal(1234), None} and set(read("decimal(9, 1)")) == {Decimal("0.1"), Decimal("-2.5"), Decimal("1234.0"), None}
    with pytest.raises(Exception, match="column n"):
        read("DECIMAL(3,0)")
    for bad in ("DECIMAL(39,0)", "DECIMAL(3,4)", "INT", ""):
        with pytest.raises(BridgeError, match="DOUBLE, VARCHAR or DECIMAL"):
            read(bad)


def test_unreadable_columns_fail_when_selected(spark, tmp_path):
    spark.createDataFrame([(1, [1.0])], "i int, a array<double>").write.parquet(f"{tmp_path}/t.parquet")
    df = scan(ParquetSide(spark, str(tmp_path)), '"t"')[0]
    assert df.columns == ["i", "a"] and df.select("i").collect()[0].i == 1 and df.count() == 1
    with pytest.raises(Exception, match="column a: type OBJECT cannot be read"):
        df.select("a").collect()
    with pytest.raises(BridgeError, match="cannot be read"):
        scan(ParquetSide(spark, str(tmp_path)), '"t"', ["a"])


NUMBERS = {0: "80", 1: "c102", -1: "3e6466", 100: "c202", 123: "c20218", -123: "3d644e66", 10**20: "cb02"}


def test_number_bytes():
    for v, raw in NUMBERS.items():
        assert numeric.encode_number(v).hex() == raw and numeric.decode_number(bytes.fromhex(raw)) == v
    assert numeric.encode_number(12345, 2).hex() == "c202182e" and numeric.encode_number(-5, 2).hex() == "3f6066" and numeric.encode_number(10**40 + 1) == b""
    for raw, scale, digits, rounds, want in (("c202182e", 2, 18, False, (12345, "ok")), ("c202182e", 1, 18, False, (0, "inexact")), ("c202182e", 1, 18, True, (1235, "ok")), ("3d644e66", 0, 2, False, (0, "overflow")), ("ff65", 0, 9, False, (0, "infinity")), ("00", 0, 9, False, (0, "infinity")), ("80", 3, 9, False, (0, "ok"))):
        assert numeric.scaled(bytes.fromhex(raw), scale, digits, rounds) == want
    for bad in ("c1", "c100", "c1ff", "3e6700", "c1" + "02" * 21):
        with pytest.raises(ValueError, match="number"):
            numeric.decode_number(bytes.fromhex(bad))


@given(st.datetimes(datetime(1, 1, 1), datetime(9999, 12, 31, 23, 59, 59)))
def test_date_and_timestamp_bytes(value):
    assert temporal.decode_date(temporal.encode_date(value)) == value.replace(microsecond=0) and len(temporal.encode_date(value)) == 7
    raw = temporal.encode_timestamp(value)
    assert temporal.decode_timestamp(raw) == value and len(raw) == (11 if value.microsecond else 7)


def test_odd_date_bytes():
    assert temporal.encode_date(datetime(2024, 5, 7, 10, 20, 30)).hex() == "787c05070b151f"
    assert temporal.decode_timestamp(bytes.fromhex("787c05070b151f") + struct.pack(">I", 999_999_999)) == datetime(2024, 5, 7, 10, 20, 30, 999_999)
    for bad in (b"", b"\x78" * 6, bytes([100, 100, 1, 1, 1, 1, 1])[:5], bytes([90, 100, 1, 1, 1, 1, 1]), bytes([120, 124, 13, 1, 1, 1, 1]), bytes([120, 124, 2, 30, 1, 1, 1])):
        with pytest.raises(ValueError):
            temporal.decode_date(bad)
    with pytest.raises(ValueError):
        temporal.decode_timestamp(temporal.encode_date(datetime(2024, 1, 1)) + b"\xff\xff\xff\xff")


def test_calendar_edges(spark):
    edges = [datetime(1, 1, 1), datetime(1582, 10, 4), datetime(1582, 10, 15), datetime(1969, 12, 31, 23, 59, 59, 999999), datetime(1970, 1, 1), datetime(2000, 2, 29), datetime(9999, 12, 31, 23, 59, 59)]
    us = temporal.as_micros(F.col("t"))
    day, rest = temporal.split_micros(us)
    rows = spark.createDataFrame([(t,) for t in edges], "t timestamp_ntz").select("t", temporal.days(F.col("t")).alias("d"), temporal.date_of_days(temporal.days(F.col("t"))).alias("back"), day.alias("day"), rest.alias("rest"), temporal.text_of(F.col("t")).alias("s"), temporal.from_micros(us).alias("same")).collect()
    for r in rows:
        n = (r.t.date() - date(1970, 1, 1)).days
        assert r.d == r.day == n and r.back == r.t.date() and r.same == r.t and r.s == r.t.strftime("%H:%M:%S.%f").join((f"{r.t.year:04d}-{r.t.month:02d}-{r.t.day:02d} ", ""))
        assert timedelta(days=n, microseconds=r.rest) + temporal.EPOCH == r.t


def test_utf8(spark):
    assert first_invalid("é漢".encode()) is None and first_invalid(b"ab\xc3(") == 2
    df = spark.createDataFrame([(b"\xe6\xbc\xa2",), (None,), (b"",)], "b binary").select(valid_utf8(F.col("b"), "c").alias("t"))
    assert [r.t for r in df.collect()] == ["漢", None, ""]
    with pytest.raises(Exception, match="column c: invalid UTF-8 at byte 4"):
        spark.createDataFrame([("é漢"[:1].encode() + b"ab\xc3(",)], "b binary").select(valid_utf8(F.col("b"), "c")).collect()


# ---------------------------------------------------------------- loads

BIG = Decimal("1234567890123456789012345678.0123456789")
WRITE = [  # source, target, values, values stored
    ("tinyint", ("NUMBER", 22, 3, 0), [-128, 127, None], None), ("smallint", ("NUMBER", 22, 5, 0), [-32768, 32767], None), ("int", ("NUMBER", 22, 10, 0), [-(2**31), 2**31 - 1, 0], None), ("bigint", ("NUMBER", 22, 19, 0), [-(2**63), 2**63 - 1, 1, -1], None),
    ("smallint", ("NUMBER", 22, 3, 0), [0, 255], None), ("int", ("NUMBER", 22, 5, 0), [65535], None), ("bigint", ("NUMBER", 22, 10, 0), [4294967295], None), ("decimal(20,0)", ("NUMBER", 22, 20, 0), [Decimal(2**64 - 1), None], None), ("boolean", ("NUMBER", 22, 1, 0), [True, False, None], [1, 0, None]),
    ("decimal(15,2)", ("NUMBER", 22, 15, 2), [Decimal("0.00"), Decimal("-0.01"), Decimal("9999999999999.99"), None], None), ("decimal(4,1)", ("NUMBER", 22, 4, 1), [Decimal("-999.9"), Decimal("0.5")], None), ("decimal(38,10)", ("NUMBER", 22, 38, 10), [BIG, -BIG, Decimal("-1E-10"), Decimal("-1844674407.3709551616")], None),
    ("double", ("BINARY_DOUBLE",), [0.0, -1.5, 1e300, 2.2250738585072014e-308, math.inf, None], None), ("float", ("BINARY_FLOAT",), [1.5, -0.25], None), ("float", ("NUMBER",), [1.5, -0.25, 1024.0], None), ("double", ("BINARY_FLOAT",), [1.5, -0.25], None), ("float", ("BINARY_DOUBLE",), [1.5, -0.25], None), ("double", ("NUMBER",), [0.5, -123.25, 1e20], None),
    ("string", ("VARCHAR2", 40), ["a", "", "exactly12chr", "é漢字😀", None], ["a", None, "exactly12chr", "é漢字😀", None]), ("string", ("CHAR", 5), ["ab"], ["ab   "]), ("date", ("DATE",), [date(1, 1, 1), date(1969, 12, 31), date(2024, 2, 29), date(9999, 12, 31), None], [datetime(1, 1, 1), datetime(1969, 12, 31), datetime(2024, 2, 29), datetime(9999, 12, 31), None]),
    ("timestamp_ntz", ("TIMESTAMP(6)",), [datetime(1969, 12, 31, 23, 59, 59, 999999), datetime(1, 1, 1), datetime(9999, 12, 31, 23, 59, 59, 999999), None], None), ("timestamp_ntz", ("TIMESTAMP(3)",), [datetime(2024, 2, 29, 13, 45, 7, 123456)], [datetime(2024, 2, 29, 13, 45, 7, 123000)]),
    ("timestamp_ntz", ("DATE",), [datetime(2024, 2, 29, 13, 45, 7, 999000)], [datetime(2024, 2, 29, 13, 45, 7)]), ("date", ("TIMESTAMP(6)",), [date(2024, 2, 29)], [datetime(2024, 2, 29)]), ("decimal(10,4)", ("NUMBER", 22, 5, 2), [Decimal("1.0050"), Decimal("-1.0050"), Decimal("999.9949")], [Decimal("1.01"), Decimal("-1.01"), Decimal("999.99")]),
    ("int", ("NUMBER", 22, 3, -2), [12345, -1250, 49], [Decimal(12300), Decimal(-1300), Decimal(0)]),
]


@pytest.mark.parametrize("case", WRITE, ids=lambda c: f"{c[0]}-{c[1]}")
@pytest.mark.parametrize("way", ["load", "format"])
def test_write_types(spark, tmp_path, case, way):
    source, remote, values, want = case
    target = [RemoteColumn("ID", "NUMBER", 22, 5, 0), RemoteColumn("C", *remote)]
    df = spark.createDataFrame(list(enumerate(values)), f"id int, c {source}")
    if way == "load":
        writer.create(df, f"{tmp_path}/t.parquet", target)
    else:
        if remote[0] in ("CHAR", "DATE") or remote[0].startswith("TIMESTAMP(3") or remote[-1] == -2 or remote == ("NUMBER",) or remote[0] == "BINARY_FLOAT" and source == "double":
            pytest.skip("a table of files does not tell these types")
        writer.create(df.limit(0), f"{tmp_path}/t.parquet", target)
        datasource.register(spark)
        df.write.format("isthmus").options(folder=str(tmp_path), table='"t"').mode("append").save()
    got = [r.C for r in spark.read.parquet(f"{tmp_path}/t.parquet").orderBy("ID").collect()]
    assert got == (values if want is None else want)


@pytest.mark.parametrize(
    ("source", "remote", "value", "says"),
    [("int", ("NUMBER", 22, 3, 0), 12345, "out of range"), ("decimal(10,2)", ("NUMBER", 22, 5, 2), Decimal("1000.00"), "out of range"), ("double", ("NUMBER", 22, 5, 2), 1e9, "out of range"), ("double", ("NUMBER", 22, 5, 2), math.nan, "not finite"), ("float", ("NUMBER",), math.inf, "not finite"), ("string", ("VARCHAR2", 3), "ééé", "longer than 3 bytes"), ("decimal(38,0)", ("NUMBER", 22, 3, -2), Decimal(10**6), "out of range"), ("date", ("DATE",), None, "null")],
)
def test_values_that_a_target_cannot_hold(spark, tmp_path, source, remote, value, says):
    """Nothing is loaded, whichever row is bad, and the error names the column."""
    target = [RemoteColumn("ID", "NUMBER", 22, 9, 0), RemoteColumn("C", *remote, **({} if value is not None else {"nullable": False}))]
    fine = {"int": 1, "decimal(10,2)": Decimal(1), "double": 1.0, "float": 1.0, "string": "a", "decimal(38,0)": Decimal(100), "date": date(2024, 1, 1)}[source]
    folder = f"{tmp_path}/t"
    writer.create(spark.createDataFrame([(0, fine)], f"id int, c {source}"), folder, target)
    with pytest.raises(Exception, match=f"column C.*{says}"):
        writer.load(spark.createDataFrame([(i, fine) for i in range(1, 50)] + [(50, value)], f"id int, c {source}").repartition(3), folder, target)
    assert spark.read.parquet(folder).count() == 1


def test_a_load_keeps_the_tables_types(spark, tmp_path):
    folder, target = f"{tmp_path}/t", [RemoteColumn("N", "NUMBER", 22, 18, 0)]
    writer.create(spark.createDataFrame([(1,)], "n bigint"), folder, target)
    for kind, v in (("int", 2), ("smallint", 3), ("decimal(9,0)", Decimal(4))):
        writer.load(spark.createDataFrame([(v,)], f"n {kind}"), folder, target)
    df = spark.read.parquet(folder)
    assert df.dtypes == [("N", "bigint")] and sorted(r.N for r in df.collect()) == [1, 2, 3, 4]


@pytest.mark.parametrize("broken", ["raise", "false"])
@pytest.mark.parametrize("stuck", [False, True])
def test_a_load_that_fails_while_it_publishes(spark, tmp_path, monkeypatch, broken, stuck):
    """Published files are taken back; only if that fails too the load is partial, and says so."""
    folder, target = f"{tmp_path}/t", [RemoteColumn("N", "NUMBER", 22, 18, 0)]
    writer.create(spark.range(1).toDF("n"), folder, target)
    real, calls = writer.publish, []

    def publish(fs, staged, final):
        calls.append(1)
        if len(calls) == 2:
            if broken == "raise":
                raise OSError("store is gone")
            return False
        return real(fs, staged, final)

    monkeypatch.setattr(writer, "publish", publish)
    if stuck:
        monkeypatch.setattr(writer, "taken_back", lambda fs, file: False)
    with pytest.raises(BridgeError) as e:
        writer.load(spark.range(30).toDF("n").repartition(3), folder, target)
    assert isinstance(e.value, writer.PartialLoadError) is stuck and ("PARTIAL" in str(e.value)) is stuck
    if not stuck:
        assert spark.read.parquet(folder).count() == 1
    assert not list((tmp_path / "t").glob("_stage*"))


def test_a_batch_that_comes_again_is_loaded_once(spark, tmp_path):
    folder, target = f"{tmp_path}/t", [RemoteColumn("N", "NUMBER", 22, 18, 0)]
    writer.create(spark.range(0).toDF("n"), folder, target)
    assert writer.load(spark.range(5).toDF("n"), folder, target, job="b-7") == 5
    assert writer.load(spark.range(5).toDF("n"), folder, target, job="b-7") == 0
    (tmp_path / "t" / "_done-b-7").unlink()  # as if the driver had died before it said so
    assert writer.load(spark.range(5).toDF("n"), folder, target, job="b-7") == 5
    assert spark.read.parquet(folder).count() == 5


def test_follow(spark, tmp_path):
    source, folder, target = f"{tmp_path}/s", f"{tmp_path}/t", [RemoteColumn("N", "NUMBER", 22, 18, 0)]
    writer.create(spark.range(0).toDF("n"), folder, target)
    for k in range(2):
        spark.range(k * 10, k * 10 + 10).toDF("n").write.mode("append").parquet(source)
        follow(spark, source, "n long", folder, target, f"{tmp_path}/c").awaitTermination()
    assert sorted(r.N for r in spark.read.parquet(folder).collect()) == list(range(20))


def test_options_and_columns_of_loads(spark, tmp_path):
    target = [RemoteColumn("A", "NUMBER", 22, 9, 0, nullable=False), RemoteColumn("B", "VARCHAR2", 9)]
    df = spark.createDataFrame([(1, "x")], "a int, b string")
    for o in writer.REFUSED:
        with pytest.raises(BridgeError, match="is for files"):
            writer.load(df, str(tmp_path), target, **{o: True})
    with pytest.raises(BridgeError, match="not known"):
        writer.load(df, str(tmp_path), target, colour=1)
    for bad, says in ((df.withColumn("c", F.lit(1)), "no target"), (df.select("b"), "may not be null"), (df.select("a", F.col("a").alias("A2")).toDF("a", "A"), "given twice"), (df.withColumn("b", F.array("a")), "convert with CAST")):
        with pytest.raises(BridgeError, match=says):
            writer.load(bad, str(tmp_path), target)
    with pytest.raises(BridgeError, match="exists"):
        writer.create(df, str(tmp_path), target)


# ---------------------------------------------------------------- the named format


@pytest.fixture
def table(spark, battery):
    datasource.register(spark)
    side, con = battery
    return lambda **o: spark.read.format("isthmus").options(folder=side.folder, table='"t"', **o).load(), con


def test_format_reads_in_units(spark, table, monkeypatch):
    read, con = table
    want = sorted(con.execute("SELECT id, n9 FROM t").fetchall(), key=str)
    for o, parts in (({}, 1), ({"sessions": "4"}, 3), ({"sessions": "4", "split": "none"}, 1)):
        df = read(columns="id, n9", **o)
        assert sorted(map(tuple, df.collect()), key=str) == want and df.rdd.getNumPartitions() == parts and df.columns == ["id", "n9"]
    assert read().count() == 30_000


@pytest.mark.parametrize("where", [w for w in BATTERY[PUSHED] if "flag" not in w and "CAST" not in w and "DATE '" not in w and "DATE(" not in w])
def test_format_filters(spark, table, where):
    read, con = table
    want = [r[0] for r in con.execute(f"SELECT id FROM t WHERE {where} ORDER BY id").fetchall()]
    assert sorted(r.id for r in read(columns="id,n9,n18,n38,dec,amount,bf,bd,part_date,ts,sub_key,name,nname,note").filter(where.replace("bf = 0.1", "bf = float(0.1)")).select("id").collect()) == want


def test_format_row_groups_belong_to_one_unit(spark, tmp_path):
    """A file of many row groups, over several ranges."""
    import pyarrow as pa
    import pyarrow.parquet as pq

    r = random.Random(1)
    pq.write_table(pa.table({"i": list(range(400_000)), "s": [r.randbytes(40).hex() for _ in range(400_000)]}), f"{tmp_path}/t.parquet", row_group_size=10_000, compression="none")
    datasource.register(spark)
    df = spark.read.format("isthmus").options(folder=str(tmp_path), table='"t"', sessions="8").load()
    assert df.rdd.getNumPartitions() > 3 and df.select(F.count("*"), F.count_distinct("i"), F.sum("i")).first() == (400_000, 400_000, 399_999 * 200_000)


def test_format_options(spark, table, tmp_path):
    read, _ = table
    for o, says in (({"sessions": "0"}, "1 to 1024"), ({"split": "odd"}, "auto, extents, hash, none"), ({"snapshot": "scn"}, "change number"), ({"colour": "red"}, "not known"), ({"columns": "nope"}, "no column")):
        with pytest.raises(Exception, match=says):
            read(**o)
    with pytest.raises(Exception, match="cannot be pushed"):
        read(where="length(name) > 3").count()
    with pytest.raises(Exception, match="no table"):
        spark.read.format("isthmus").options(folder=str(tmp_path), table="x").load()
    spark.range(3).write.parquet(f"{tmp_path}/t.parquet")
    writes = lambda **o: spark.range(2).write.format("isthmus").options(folder=str(tmp_path), table='"t"', **o).mode("append").save()
    with pytest.raises(Exception, match="is for files"):
        writes(partition_by="id")
    with pytest.raises(Exception, match="not supported"):
        spark.range(2).write.format("isthmus").options(folder=str(tmp_path), table='"t"').mode("overwrite").save()
    writes()
    assert spark.read.parquet(f"{tmp_path}/t.parquet").count() == 5


def test_format_in_sql(spark, tmp_path):
    datasource.register(spark)
    spark.range(4).write.parquet(f"{tmp_path}/t.parquet")
    spark.read.format("isthmus").options(folder=str(tmp_path), table='"t"').load().createOrReplaceTempView("isthmus_v")
    assert spark.sql("SELECT sum(id) FROM isthmus_v WHERE id > 1").first()[0] == 5


def test_format_write_is_whole_or_nothing(spark, tmp_path):
    datasource.register(spark)
    writer.create(spark.createDataFrame([(0, "a")], "id int, s string"), f"{tmp_path}/t.parquet", [RemoteColumn("id", "NUMBER", 22, 9, 0), RemoteColumn("s", "VARCHAR2", 40)])
    bad = spark.range(2_000_000_000, 2_000_000_050).select(F.when(F.col("id") < 2_000_000_049, F.lit(5).cast("long")).otherwise(F.lit(2**40)).alias("id"), F.lit("x").alias("s")).repartition(3)
    with pytest.raises(Exception, match="column id"):
        bad.write.format("isthmus").options(folder=str(tmp_path), table='"t"').mode("append").save()
    assert spark.read.parquet(f"{tmp_path}/t.parquet").count() == 1 and not list((tmp_path / "t.parquet").glob("_stage*"))
    spark.createDataFrame([(1, ""), (2, None)], "id int, s string").write.format("isthmus").options(folder=str(tmp_path), table='"t"').mode("append").save()
    assert sorted(map(tuple, spark.read.parquet(f"{tmp_path}/t.parquet").collect())) == [(0, "a"), (1, None), (2, None)]


def test_published_files_are_taken_back(tmp_path):
    import pyarrow.fs as fs

    place = datasource.Place(str(tmp_path), '"t"')
    (tmp_path / "t.parquet" / "_stage-j").mkdir(parents=True)
    (tmp_path / "t.parquet" / "_stage-j" / "a.parquet").write_text("x")
    w = datasource.BridgeWriter(place, TableInfo("t", T.StructType(), ()), [], "j")
    stage = f"{tmp_path}/t.parquet/_stage-j"
    with pytest.raises(BridgeError, match="load failed: 0 of 2"):
        w.commit([datasource.Staged(f"{stage}/a.parquet", 1), datasource.Staged(f"{stage}/gone.parquet", 1), None])
    assert fs.LocalFileSystem().get_file_info(fs.FileSelector(f"{tmp_path}/t.parquet")) == []


# ---------------------------------------------------------------- a database behind JDBC


@pytest.fixture(scope="module")
def derby(spark):
    create_secret("derby", "app", "s3cret-pw", "memory", replace=True)
    side = JdbcSide(spark, "jdbc:derby:memory:isthmus;create=true", "derby")
    side.execute("CREATE TABLE T (ID INTEGER NOT NULL PRIMARY KEY, N DECIMAL(10,2), S VARCHAR(12), C CHAR(3), D DATE, TS TIMESTAMP, B DOUBLE, L CLOB)")
    side.execute('CREATE SCHEMA OTHER', 'CREATE TABLE OTHER."mixed Case" (X BIGINT)', "CREATE VIEW V AS SELECT ID, S FROM T", "CREATE SYNONYM ONE FOR T", "CREATE SYNONYM TWO FOR ONE")
    rows = [(i, Decimal(i) / 4 if i % 7 else None, ("", "abc", "abc ", "é", "it's")[i % 5], ("A", "AB", None)[i % 3], date(2024, 5, 1) + timedelta(days=i % 9), datetime(2024, 1, 1, 0, 0, 0, 500) + timedelta(seconds=i), i / 8) for i in range(3000)]
    df = spark.createDataFrame(rows, "id int, n decimal(10,2), s string, c string, d date, ts timestamp_ntz, b double").repartition(3)
    assert side.load(df, "t") == 3000
    return side, rows


def test_derby_dictionary(derby):
    side, _ = derby
    assert side.version().startswith("Apache Derby") and side.default_schema() == "APP" and {"APP", "OTHER"} <= set(side.schemas())
    assert side.list() == ["ONE", "T", "TWO", "V"] and side.list("other") == ["mixed Case"]
    t = side.describe("t")
    assert (t.name, t.kind, [c.data_type for c in t.columns]) == ("T", "table", ["NUMBER", "NUMBER", "VARCHAR2", "CHAR", "DATE", "TIMESTAMP(6)", "BINARY_DOUBLE", "CLOB"]) and not t.column("id").nullable
    assert side.describe("V").kind == "view" and side.describe("two").name == "T" and side.describe("mixed case", "OTHER") is None and side.describe("mixed Case", "OTHER").name == "mixed Case"
    assert side.describe("none") is None and ("APP", "none") in side.known and side.rows(t) == 3000 and [i.name for i in side.describe_all()] == ["T", "T", "T", "V"]
    assert side.describe_target("T")[1] == 1 and side.strings("SELECT S, C FROM T WHERE S = ?", ("é",))[0][0] == "é"
    with pytest.raises(BridgeError, match="to load into"):
        side.describe_target("V")
    with pytest.raises(BridgeError, match="no schema"):
        side.describe("T", "nowhere")


def test_derby_scans(spark, derby):
    side, rows = derby
    with warnings.catch_warnings(record=True) as said:
        warnings.simplefilter("always")
        df, report = side.scan("T", ["ID", "S", "TS"], n_sessions=4)
    assert df.rdd.getNumPartitions() == 4 and df.count() == df.select("ID").distinct().count() == 3000 and report.strategy == "hash" and any("common snapshot" in str(w.message) for w in said)
    assert dict(df.dtypes)["TS"] == "timestamp_ntz" and {r.S for r in df.collect()} == {None, "abc", "abc ", "é", "it's"}
    assert side.scan("V", ["ID"], n_sessions=4, split="auto", hash_by="ID")[1].strategy == "hash" and side.scan("V", ["ID"], n_sessions=4)[1].strategy in ("hash", "none")
    assert side.scan("T")[0].drop("L").orderBy("ID").first()[:2] == (0, None)
    with pytest.raises(BridgeError, match="no extents"):
        side.scan("T", n_sessions=4, split="extents")
    with pytest.raises(BridgeError, match="change number"):
        side.scan("T", snapshot="scn")


@pytest.mark.parametrize(
    ("where", "test", "kept"),
    [
        ("ID BETWEEN 10 AND 19", lambda r: 10 <= r[0] <= 19, 0), ("N = 12.25", lambda r: r[1] == Decimal("12.25"), 0), ("S = 'it''s'", lambda r: r[2] == "it's", 1), ("S IN ('é', 'abc')", lambda r: r[2] in ("é", "abc"), 1), ("S <> ''", lambda r: r[2] != "", 1), ("S = 'abc'", lambda r: r[2] == "abc", 1),
        ("TS >= TIMESTAMP '2024-01-01 00:49:00.5'", lambda r: r[5] >= datetime(2024, 1, 1, 0, 49, 0, 500000), 0), ("D = DATE '2024-05-03'", lambda r: r[4] == date(2024, 5, 3), 0), ("B > 374.5", lambda r: r[6] > 374.5, 0), ("N IS NULL", lambda r: r[1] is None, 0),
        ("L IS NULL AND ID < 5", lambda r: r[0] < 5, 0), ("ID = 3 OR S = 'é'", lambda r: r[0] == 3 or r[2] == "é", 1), ("ID = 3 OR B = 0.5", lambda r: r[0] in (3, 4), 0), ("D IN (DATE '2024-05-03', DATE '2024-05-04')", lambda r: r[4].day in (3, 4), 0), ("S LIKE 'a%' AND ID < 100", lambda r: r[2].startswith("a") and r[0] < 100, 1),
    ],
)
def test_derby_filters(derby, where, test, kept):
    """The database gets the WHERE of this module, and Spark's own pushdown is off. Texts are compared in Spark, as Derby pads them."""
    side, rows = derby
    df, report = side.scan("T", ["ID"], where)
    assert sorted(r.ID for r in df.collect()) == sorted(r[0] for r in rows if test(r)) and len(report.kept) == kept


def test_derby_limits_are_not_pushed(derby):
    side, _ = derby
    df = side.scan("T", ["ID"])[0].orderBy("ID").limit(3)
    assert [r.ID for r in df.collect()] == [0, 1, 2] and "PushedTopN" not in df._jdf.queryExecution().executedPlan().toString()


def test_derby_loads_are_whole_or_nothing(spark, derby):
    side, _ = derby
    before = side.list()
    for bad, says in (([(5000, "ok"), (1, "again")], "duplicate key"), ([(5001, "ok"), (5002, "x" * 13)], "column S: longer"), ([(5003, "ok"), (None, "y")], "column ID: null")):
        with pytest.raises(Exception, match=says):
            side.load(spark.createDataFrame(bad, "id int, s string").repartition(2), "T")
    assert side.rows(side.describe("T")) == 3000 and side.list() == before
    with pytest.raises(BridgeError, match="keeps its indexes"):
        side.load(spark.createDataFrame([(1, "x")], "id int, s string"), "T", skip_index_maintenance=True)
    with pytest.raises(RemoteError) as e:
        side.execute("INSERT INTO T (ID) VALUES (9000)", "INSERT INTO T (ID) VALUES (1)")
    assert e.value.code and side.rows(side.describe("T")) == 3000


def test_derby_errors_show_no_secret(spark, derby):
    with pytest.raises(RemoteError) as e:
        JdbcSide(spark, "jdbc:derby:memory:none;password=s3cret-pw", "derby").version()
    assert "s3cret" not in str(e.value)
    with pytest.raises(BridgeError, match="spark.jars"):
        JdbcSide(spark, "jdbc:oracle:thin:@x").version()
    with pytest.raises(BridgeError, match="no driver"):
        JdbcSide(spark, "jdbc:odd:x").version()


# ---------------------------------------------------------------- catalogs and secrets


def test_secrets():
    create_secret("one", "u", "pässword", "dsn")
    assert "pässword" not in repr(secret("one")) and redacted("login u/pässword password=abc") == "login u/*** password=***"
    with pytest.raises(BridgeError, match="exists"):
        create_secret("one", "u", "p", "d")
    with pytest.raises(BridgeError, match="needs user"):
        create_secret("two", "u", "", "d")
    drop_secret("one")
    with pytest.raises(BridgeError, match="no secret"):
        secret("one")


@pytest.fixture
def folders(spark, tmp_path):
    spark.range(3).write.parquet(f"{tmp_path}/root.parquet")
    spark.range(4).write.parquet(f"{tmp_path}/APP/T.parquet")
    spark.range(5).write.parquet(f"{tmp_path}/other/low.parquet")
    (tmp_path / "empty").mkdir()
    return ParquetSide(spark, str(tmp_path), synonyms={(None, "PUB"): ("APP", "T"), ("APP", "S1"): ("APP", "S2"), ("APP", "S2"): ("other", "low"), (None, "LOOP"): (None, "LOOP")})


def test_catalog_schemas(folders):
    c = Catalog(folders)
    assert c.schemas() == ["APP", "other"] and c.tables() == ["root"] and c.tables("app") == ["T"] and c.table("app.t").count() == 4 and c.table('"other"."low"').count() == 5 and c.table("OTHER.LOW").count() == 5
    assert c.table("pub").count() == 4 and c.table("app.s1").count() == 5 and c.table("app.pub").count() == 4
    assert c.storage("app.t") == {"kind": "table", "organization": "HEAP", "rows": 4, "columns": 1}
    assert [i.name for i in folders.describe_all("APP")] == ["T"]
    with pytest.raises(BridgeError, match="no schema"):
        c.table("nowhere.t")
    with pytest.raises(BridgeError, match="eight deep"):
        c.table("loop")
    with pytest.raises(BridgeError, match="did you mean root"):
        c.table("root"), c.table("roots")
    assert Catalog(folders, default_schema="APP").table("t").count() == 4


def test_catalog_keeps_what_it_knows_until_refresh(spark, folders):
    c = Catalog(folders)
    with pytest.raises(BridgeError):
        c.table("later")
    spark.range(2).write.parquet(f"{folders.folder}/later.parquet")
    with pytest.raises(BridgeError):
        c.table("later")
    c.refresh()
    assert c.table("later").count() == 2


STATEMENTS = ["INSERT INTO {t} VALUES (99)", "CREATE TABLE x (i INT)", "CREATE TABLE x AS SELECT 1 AS i", "DROP TABLE {t}", "DELETE FROM {t}", "UPDATE {t} SET id = id + 1", "ALTER TABLE {t} ADD COLUMN j INT", "CREATE VIEW v AS SELECT 1 AS i", "CREATE SCHEMA x", "DROP SCHEMA app", "CREATE INDEX i ON {t} (id)", " /* x */ merge INTO {t} USING s ON 1 = 1 WHEN MATCHED THEN DELETE", "-- c\nTRUNCATE TABLE {t}", "ANALYZE TABLE {t} COMPUTE STATISTICS", "VACUUM {t}"]


@pytest.mark.parametrize("text", STATEMENTS)
def test_catalog_refuses_statements(folders, text):
    c = Catalog(folders)
    with pytest.raises(ReadOnlyError, match="read-only"):
        c.sql(text, t="app.t")
    assert c.sql("SELECT count(*) AS n FROM {t}", t="app.t").first().n == 4


def test_catalog_of_a_database(derby):
    side, _ = derby
    c = Catalog(side, secret="derby", n_sessions=2, snapshot="none")
    assert c.default == "APP" and c.table("t", ["ID"]).count() == 3000 and c.table('other."mixed Case"').count() == 0 and c.storage("T")["rows"] == 3000
    with pytest.raises(ReadOnlyError):
        c.drop_table("T")
    for bad in ({"n_sessions": 0}, {"split": "x"}, {"snapshot": "x"}, {"unconstrained_number": "x"}):
        with pytest.raises(BridgeError):
            Catalog(side, **bad)
    with pytest.raises(BridgeError, match="takes none"):
        Catalog(ParquetSide(side.spark, D), secret="derby")


def test_a_catalog_whose_side_is_gone_lists_nothing(derby, monkeypatch):
    side, _ = derby
    c = Catalog(side)

    def gone(*_):
        raise RemoteError("connection refused", 8006)

    monkeypatch.setattr(side, "list", gone)
    with pytest.warns(UserWarning, match="refused"):
        assert c.tables() == [] and side.describe_all() == []


def test_session_settings_and_fetches(spark, derby):
    side = JdbcSide(spark, "jdbc:derby:memory:isthmus", "derby", session_settings="SET SCHEMA OTHER")
    assert side.default_schema() == "OTHER" and side.scan('"mixed Case"')[0].count() == 0
    assert fetch_rows([RemoteColumn("a", "NUMBER", 22)]) == 8192 and fetch_rows([RemoteColumn(str(i), "VARCHAR2", 4000) for i in range(550)]) == 30


def test_quote():
    assert quote("a b") == '"a b"'
    with pytest.raises(BridgeError):
        quote('a"b')
