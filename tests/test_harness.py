"""The bench: generated tables, the checksum gate, rankings and the command line; and the version function."""

import math
import time
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

import isthmus
from isthmus.bench import __main__ as command
from isthmus.bench import cases, methods, runner
from isthmus.sources.datasource import register


def test_cases_are_the_same_wherever_they_are_made(spark):
    a, b = cases.write_case(spark, 2000, 20), cases.write_case(spark, 2000, 20, parts=7)
    assert runner.differing(runner.sums(a.df), runner.sums(b.df)) == [] and len(a.target) == len(a.df.columns) == 20
    nulls = a.df.agg(*(F.count_if(F.col(c).isNull()).alias(c) for c in a.df.columns)).first().asDict()
    assert nulls["id"] == 0 and all(50 < nulls[c] < 160 for c in a.df.columns[1:])
    share = {r.status_9: r["count"] for r in a.df.groupBy("status_9").count().collect()}
    assert 1000 < share["ACTIVE"] < 1300 and 250 < share["SUSPENDED"] < 500
    assert a.ddl().startswith('"id" NUMBER(10,0) NOT NULL, "amount" NUMBER(15,2), "label" VARCHAR2(30), "operation_date" DATE')


def test_read_case(spark, tmp_path):
    place = methods.made(spark, 2000, 260, str(tmp_path))
    df = spark.read.parquet(place)
    assert len(df.columns) == 260 and df.count() == 2200 and {c.split("_")[0] for c in df.columns} == {"part", "sub", "id", "v", "n", "d", "dt", "c", "ts", "u", "clob"}
    day = df.filter("part_date = DATE '2024-05-07'")
    assert day.count() == 2000 and "PartitionFilters: [isnotnull(part_date" in day._jdf.queryExecution().executedPlan().toString()
    keys = {r.sub_key: r["count"] for r in day.groupBy("sub_key").count().collect()}
    assert keys["A"] > keys["B"] > keys["C"] and df.agg(F.max(F.length("clob_249"))).first()[0] == 20_000


def test_read_methods_agree(spark, tmp_path):
    methods.made(spark, 1000, 12, str(tmp_path))
    every = methods.read_methods(spark, str(tmp_path), "read_1000_12", "2024-05-07", str(tmp_path))
    want = runner.sums(every["plain"]())
    found = runner.run_case(every, want, runs=1, warm=0)
    assert [r.state for r in found] == ["ok"] * 3 and want["n_rows"] == 1000
    register(spark)


def test_write_methods_agree(spark, tmp_path):
    case = cases.write_case(spark, 500, 13)  # without booleans, which the target stores as numbers
    found = runner.run_case(methods.write_methods(case, str(tmp_path)), runner.sums(case.df), runs=1, warm=0)
    assert {r.name: (r.state, r.note) for r in found} == dict.fromkeys(("bridge", "append", "csv"), ("ok", ""))


def test_gate_timeouts_and_ranks(spark):
    good, bad = spark.range(100), spark.range(1, 101)

    def slow():
        time.sleep(30)

    def broken():
        raise ValueError("password=abc")

    calls = []
    ways = {"ours": lambda: calls.append("o") or good, "other": lambda: calls.append("p") or time.sleep(0.2) or good, "wrong": lambda: bad, "slow": slow, "broken": broken}
    found = runner.run_case(ways, runner.sums(good), runs=2, warm=1, timeout=1.0)
    assert {r.name: r.state for r in found} == {"ours": "ok", "other": "ok", "wrong": "incorrect", "slow": "too slow", "broken": "failed"}
    assert calls == ["o", "p"] * 3 and "abc" not in found[-1].note and "id_sum" in found[2].note
    rows = runner.ranked(found, "ours", 100, 800)
    assert [r["method"] for r in rows[:2]] == ["ours", "other"] and rows[1]["speedup"] > 1 and math.isnan(rows[-1]["median_s"])
    assert "reached" in runner.verdict(rows, "ours") and "missed" in runner.verdict(rows, "ours", 1e9) and "incorrect" in runner.verdict(rows, "wrong") and "not run" in runner.verdict(rows, "x")
    assert runner.table(rows).count("\n") == 6 and runner.utilisation(8, 2, 8) == 0.5
    assert "nothing to compare" in runner.verdict(rows[:1], "ours")


def test_comparison():
    assert runner.same(1.0, 1.0 + 1e-13) and not runner.same(1.0, 1.0 + 1e-9) and runner.same(Decimal("1.50"), Decimal("1.5")) and not runner.same(Decimal("1.5"), Decimal("1.51")) and runner.same(None, None) and not runner.same(None, 0)


def test_segments_are_pruned(spark, tmp_path):
    place = methods.segments(spark, 6, 4, 300, str(tmp_path))
    df = spark.read.parquet(place).filter("part_date = DATE '2025-01-01'")
    assert df.count() == 300 and len(df.inputFiles()) == 25 and "PartitionFilters: [isnotnull(part_date" in df._jdf.queryExecution().executedPlan().toString()


def test_command_line(spark, tmp_path, capsys):
    say = lambda *argv: (command.main([*argv, "--folder", str(tmp_path)], spark), capsys.readouterr().out)[1]
    assert "NUMBER(10,0)" in say("ddl", "--columns", "6")
    assert "read_50_5" in say("make", "--rows", "50", "--columns", "5") and '"n_rows": 54' in say("sums", f"{tmp_path}/read_50_5.parquet")
    assert "bridge: " in say("write", "--rows", "200", "--columns", "6", "--runs", "1") and "| plain | ok |" in say("read", "--rows", "200", "--columns", "6", "--runs", "1")
    spark.range(3).write.parquet(f"{tmp_path}/a")
    spark.range(4).write.parquet(f"{tmp_path}/b")
    assert '"rows_apart": 0' in say("compare", f"{tmp_path}/a", f"{tmp_path}/a")
    with pytest.raises(SystemExit):
        say("compare", f"{tmp_path}/a", f"{tmp_path}/b")
    assert '"read": "pruned"' in say("pruning", "--rows", "50") and say("scaling", "--rows", "100", "--columns", "5").count("seconds") == 4
    for bad in (["odd"], ["compare", "x"], ["write", "--rows", "x"]):
        with pytest.raises(SystemExit):
            command.arguments(bad)


def test_version(spark):
    assert isthmus.driver_version(spark).startswith("Spark 4") and "Derby" in isthmus.driver_version(spark, "jdbc:derby:memory:version;create=true")
    isthmus.register_functions(spark)
    assert spark.sql("SELECT isthmus_driver_version() AS v").first().v.startswith("Spark 4")
