"""python -m isthmus.bench COMMAND: makes tables, runs cases, compares tables and writes reports."""

from __future__ import annotations

import argparse
import json
import sys
import tempfile
import time

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from isthmus.bench import cases, methods, runner
from isthmus.operators.checks import difference
from isthmus.plans.units import sessions


def session(cores: int) -> SparkSession:
    spark = SparkSession.builder.master(f"local[{cores}]").config("spark.sql.session.timeZone", "UTC").config("spark.ui.enabled", "false").config("spark.sql.shuffle.partitions", str(cores)).config("spark.driver.memory", "8g").config("spark.ui.showConsoleProgress", "false").getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def show(rows: list[dict], ours: str, least: float) -> None:
    print(runner.table(rows))
    print(runner.verdict(rows, ours, least))


def write(a: argparse.Namespace, spark: SparkSession) -> None:
    case = cases.write_case(spark, a.rows, a.columns)
    df = case.df.cache()
    every = methods.write_methods(cases.Case(case.name, df, case.target), a.folder)
    want = runner.sums(df)
    # booleans are numbers in the target, so they have no sum to compare
    want = {k: v for k, v in want.items() if not k.startswith("bool_")}
    found = runner.run_case({n: m for n, m in every.items() if not a.only or n in a.only}, want, a.runs, 1, a.timeout)
    show(runner.ranked(found, "bridge", a.rows), "bridge", a.least)


def read(a: argparse.Namespace, spark: SparkSession) -> None:
    methods.made(spark, a.rows, a.columns, a.folder)
    every = methods.read_methods(spark, a.folder, f"read_{a.rows}_{a.columns}", "2024-05-07", a.folder, a.sessions)
    want = runner.sums(every["plain"]())
    found = runner.run_case({n: m for n, m in every.items() if not a.only or n in a.only}, want, a.runs, 1, a.timeout)
    show(runner.ranked(found, "bridge", a.rows), "bridge", a.least)


def scaling(a: argparse.Namespace, spark: SparkSession) -> None:
    case = cases.write_case(spark, a.rows, a.columns)
    for n in (1, 2, 4, 8):
        part = cases.Case(f"{case.name}_{n}", case.df.repartition(n).cache(), case.target)
        part.df.count()
        began = time.perf_counter()
        methods.write_methods(part, a.folder)["bridge"]()
        print(json.dumps({"parts": n, "seconds": round(time.perf_counter() - began, 3)}))


def pruning(a: argparse.Namespace, spark: SparkSession) -> None:
    place = methods.segments(spark, 75, 4, a.rows, a.folder)
    alone = spark.read.parquet(f"{place}/part_date=2025-01-01/sub_key=0")
    for name, df in (("alone", alone), ("pruned", spark.read.parquet(place).filter(F.col("part_date") == F.lit("2025-01-01").cast("date")))):
        began = time.perf_counter()
        n = df.count()
        print(json.dumps({"read": name, "rows": n, "seconds": round(time.perf_counter() - began, 3)}))


def compare(a: argparse.Namespace, spark: SparkSession) -> None:
    one, two = (spark.read.parquet(p) for p in (a.first, a.second))
    bad, apart = runner.differing(runner.sums(one), runner.sums(two)), difference(one, two).count()
    print(json.dumps({"checksums_differ": bad, "rows_apart": apart}))
    if bad or apart:
        sys.exit(1)


def sums(a: argparse.Namespace, spark: SparkSession) -> None:
    print(json.dumps(runner.sums(spark.read.parquet(a.first)), default=str))


def make(a: argparse.Namespace, spark: SparkSession) -> None:
    print(methods.made(spark, a.rows, a.columns, a.folder))


def ddl(a: argparse.Namespace, spark: SparkSession) -> None:
    print(cases.write_case(spark, 1, a.columns).ddl())


COMMANDS = {f.__name__: f for f in (write, read, scaling, pruning, compare, sums, make, ddl)}


def arguments(argv: list[str] | None = None) -> argparse.Namespace:
    p = argparse.ArgumentParser(prog="python -m isthmus.bench", description=__doc__)
    p.add_argument("command", choices=sorted(COMMANDS))
    p.add_argument("first", nargs="?")
    p.add_argument("second", nargs="?")
    p.add_argument("--rows", type=int, default=100_000)
    p.add_argument("--columns", type=int, default=20)
    p.add_argument("--runs", type=int, default=runner.RUNS)
    p.add_argument("--timeout", type=float, default=runner.TIMEOUT_S)
    p.add_argument("--least", type=float, default=1.0)
    p.add_argument("--only", nargs="*", default=None)
    p.add_argument("--sessions", type=int, default=8)
    p.add_argument("--cores", type=int, default=8)
    p.add_argument("--folder", default=None)
    a = p.parse_args(argv)
    sessions(a.sessions)
    if a.command in ("compare", "sums") and not a.first or a.command == "compare" and not a.second:
        p.error(f"{a.command} needs {'two tables' if a.command == 'compare' else 'a table'}")
    return a


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> None:
    a = arguments(argv)
    with tempfile.TemporaryDirectory() as scratch:
        a.folder = a.folder or scratch
        COMMANDS[a.command](a, spark or session(a.cores))


if __name__ == "__main__":
    main()
