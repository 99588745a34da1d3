"""Work units: how a scan is split into parts that together read every row once."""

from __future__ import annotations

from dataclasses import dataclass
from typing import Any

from pyspark.sql import Column
from pyspark.sql import functions as F

from isthmus.sources.names import BridgeError

SPLITS, SNAPSHOTS = ("auto", "extents", "hash", "none"), ("auto", "scn", "none")
MIN_BLOCKS, UNITS_PER_SESSION = 1024, 4
# The greatest parts of a row address; kinds of tables whose rows have no addresses that can be cut.
LAST_FILE, LAST_BLOCK, LAST_ROW = 1023, 2**22 - 1, 2**16 - 1
NO_ADDRESSES = ("IOT", "CLUSTER", "EXTERNAL", "HYBRID")
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"


def why_not_extents(organization: str) -> str:
    """Why a table cannot be cut by extents, or ''. Kinds that are not known are refused too."""
    kind = organization.upper()
    if kind == "HEAP":
        return ""
    return f"a table of organization {kind or 'unknown'} has no extents of its own" + ("" if kind in NO_ADDRESSES else "; it is not listed as a heap table")


def choice(option: str, value: str, allowed: tuple[str, ...]) -> str:
    if (v := value.lower()) not in allowed:
        raise BridgeError(f"{option} {value!r}: use one of {', '.join(allowed)}")
    return v


def sessions(value: int) -> int:
    if not 1 <= value <= 1024:
        raise BridgeError(f"sessions {value}: use 1 to 1024")
    return value


def rowid(data_object: int, file: int, block: int, row: int, bigfile: bool = False) -> str:
    """An 18-character row address; big files have no file number and longer block numbers."""
    if bigfile:
        file, block = block >> 22, block & ((1 << 22) - 1)
    out = ""
    for n, width in ((data_object, 6), (file, 3), (block, 6), (row, 3)):
        if not 0 <= n < 64**width:
            raise BridgeError(f"row address part {n} is out of range")
        out += "".join(ALPHABET[n >> 6 * i & 63] for i in reversed(range(width)))
    return out


def unit_blocks(largest: int, n_sessions: int) -> int:
    return max(-(-largest // (UNITS_PER_SESSION * n_sessions)), MIN_BLOCKS)


@dataclass(frozen=True)
class Extent:
    data_object: int
    file: int
    block: int
    blocks: int


@dataclass(frozen=True)
class Range:
    """Rows of one data object from (file, block) up to another, which is open where None."""

    data_object: int
    start: tuple[int, int]
    end: tuple[int, int] | None
    blocks: int


def ranges(extents: list[Extent], unit: int) -> list[Range]:
    """Disjoint ranges that cover every extent, at block boundaries, largest first; an object's last range has no end."""
    out: list[Range] = []
    for o in dict.fromkeys(e.data_object for e in extents):
        cuts, filled = [], 0
        mine = sorted((e for e in extents if e.data_object == o), key=lambda e: (e.file, e.block))
        for e in mine:
            at = 0
            while at < e.blocks:
                if filled in (0, unit):
                    cuts.append([(e.file, e.block + at), 0])
                    filled = 0
                step = min(unit - filled, e.blocks - at)
                cuts[-1][1] += step
                filled += step
                at += step
        out += [Range(o, s, cuts[i + 1][0] if i + 1 < len(cuts) else None, n) for i, (s, n) in enumerate(cuts)]
    return sorted(out, key=lambda r: -r.blocks)


@dataclass(frozen=True)
class WorkPlan:
    strategy: str
    units: tuple[Any, ...]
    notes: tuple[str, ...] = ()


def plan(split: str, n_sessions: int, is_table: bool, extents: list[Any] | None, why_no_extents: str = "", can_hash: bool = True) -> WorkPlan:
    """auto tries extents (tables only), then hash, then one unit, and notes why; an explicit split that cannot be is an error."""
    split, n = choice("split", split, SPLITS), sessions(n_sessions)
    if n == 1 or split == "none":
        return WorkPlan("none", (None,))
    notes = []
    if split in ("auto", "extents"):
        if is_table and extents:
            return WorkPlan("extents", tuple(extents))
        notes.append(why_no_extents or ("no extents" if is_table else "a view has no extents"))
        if split == "extents":
            raise BridgeError(f"split extents: {notes[-1]}")
    if can_hash:
        return WorkPlan("hash", tuple((k, n) for k in range(n)), tuple(notes))
    notes.append("rows cannot be hashed")
    if split == "hash":
        raise BridgeError(f"split hash: {notes[-1]}")
    return WorkPlan("none", (None,), tuple(notes))


def whole_bytes(files: list[tuple[str, int]], n_sessions: int, block: int = 8192) -> list[Range]:
    """Files (path, bytes) as segments of blocks, cut by the rule of extents: ranges of file blocks, largest first. data_object is the
    file's number; the last range of a file has no end."""
    extents = [Extent(i, 0, 0, max(1, -(-size // block))) for i, (_, size) in enumerate(files)]
    return ranges(extents, unit_blocks(max((e.blocks for e in extents), default=1), n_sessions))


def bucket(columns: list[str], k: int, n: int) -> Column:
    """Rows of hash bucket k of n."""
    return F.pmod(F.xxhash64(*(F.col(f"`{c}`") for c in columns)), F.lit(n)) == k
