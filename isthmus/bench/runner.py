"""Runs of several methods on one case, in turn, each behind the same checksums; and what the times say."""

from __future__ import annotations

import math
import statistics
import threading
import time
from collections.abc import Callable
from dataclasses import dataclass, field
from decimal import Decimal
from typing import Any

from pyspark.sql import DataFrame

from isthmus.operators.checks import checksum
from isthmus.sources.secrets import redacted

TIMEOUT_S, RUNS, RELATIVE = 900.0, 5, 1e-12
Method = Callable[[], DataFrame]


@dataclass
class Result:
    name: str
    seconds: list[float] = field(default_factory=list)
    state: str = "ok"
    note: str = ""

    @property
    def median(self) -> float:
        return statistics.median(self.seconds) if self.seconds else math.nan

    @property
    def spread(self) -> tuple[float, float]:
        return (min(self.seconds), max(self.seconds)) if self.seconds else (math.nan, math.nan)


def same(a: Any, b: Any) -> bool:
    """Whether two checksums are equal: floats to one part in 10**12, all else exactly."""
    if isinstance(a, float) or isinstance(b, float):
        return a is not None and b is not None and (a == b or math.isclose(float(a), float(b), rel_tol=RELATIVE))
    if isinstance(a, (int, Decimal)) and isinstance(b, (int, Decimal)):
        return Decimal(a) == Decimal(b)
    return a == b


def sums(df: DataFrame) -> dict[str, Any]:
    return checksum(df).first().asDict()


def differing(got: dict[str, Any], want: dict[str, Any]) -> list[str]:
    return [k for k in want if k not in got or not same(got[k], want[k])]


def timed(method: Method, timeout: float) -> tuple[float, DataFrame | None, str]:
    """Seconds, the table that the method made, and what went wrong. A method beyond the timeout is left to end by itself."""
    out: dict[str, Any] = {}

    def run() -> None:
        try:
            out["df"] = method()
        except Exception as e:  # noqa: BLE001  any failure is a result of the bench
            out["error"] = redacted(f"{type(e).__name__}: {e}")

    began = time.perf_counter()
    t = threading.Thread(target=run, daemon=True)
    t.start()
    t.join(timeout)
    took = time.perf_counter() - began
    if t.is_alive():
        return took, None, f"more than {timeout:g} s"
    return took, out.get("df"), out.get("error", "")


def run_case(methods: dict[str, Method], want: dict[str, Any], runs: int = RUNS, warm: int = 1, timeout: float = TIMEOUT_S) -> list[Result]:
    """Every method once uncounted, then all in turn, runs times. A method whose table's checksums differ, or that fails or takes too long,
    is not run again and not ranked."""
    results = {n: Result(n) for n in methods}
    for turn in range(warm + runs):
        for name, method in methods.items():
            r = results[name]
            if r.state != "ok":
                continue
            took, df, error = timed(method, timeout)
            if error or df is None:
                r.state, r.note = ("too slow" if df is None and error.startswith("more than") else "failed"), error
            elif bad := differing(sums(df), want):
                r.state, r.note = "incorrect", f"checksums differ: {', '.join(bad)}"
            elif turn >= warm:
                r.seconds.append(took)
            if r.state != "ok":
                r.seconds.clear()
    return list(results.values())


def ranked(results: list[Result], ours: str, rows: int, size: int | None = None) -> list[dict[str, Any]]:
    """A row for each method, fastest first: median, spread, rows and MB a second, and how many times slower than ours it is."""
    base = next((r.median for r in results if r.name == ours), math.nan)
    out = []
    for r in sorted(results, key=lambda r: (not r.seconds, r.median if r.seconds else 0)):
        low, high = r.spread
        out.append({"method": r.name, "state": r.state, "median_s": r.median, "min_s": low, "max_s": high, "rows_s": rows / r.median if r.seconds else math.nan, "mb_s": size / r.median / 1e6 if r.seconds and size else math.nan, "speedup": r.median / base if r.seconds else math.nan, "note": r.note})
    return out


def verdict(rows: list[dict[str, Any]], ours: str, least: float = 1.0) -> str:
    """Whether ours is correct and at least so many times as fast as the best of the others."""
    mine = next((r for r in rows if r["method"] == ours), None)
    if mine is None or mine["state"] != "ok":
        return f"{ours}: {mine['state'] if mine else 'not run'}"
    others = [r for r in rows if r["method"] != ours and r["state"] == "ok"]
    if not others:
        return f"{ours}: correct, nothing to compare with"
    best = min(others, key=lambda r: r["median_s"])
    return f"{ours}: {'reached' if best['speedup'] >= least else 'missed'}, {best['speedup']:.2f} x {best['method']} (asked: {least:g} x)"


def utilisation(cpu_seconds: float, wall_seconds: float, cores: int) -> float:
    return cpu_seconds / (wall_seconds * cores) if wall_seconds else 0.0


def table(rows: list[dict[str, Any]]) -> str:
    """The ranking as a Markdown table."""
    show = lambda v: f"{v:.3f}" if isinstance(v, float) else str(v)
    keys = ["method", "state", "median_s", "min_s", "max_s", "rows_s", "mb_s", "speedup", "note"]
    return "\n".join(["| " + " | ".join(keys) + " |", "|" + "-|" * len(keys), *("| " + " | ".join(show(r[k]) for k in keys) + " |" for r in rows)])
