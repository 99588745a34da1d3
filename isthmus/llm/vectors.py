"""Embedding near-duplicates by sorted projection passes (operator 9).

Equal vectors are one class first. In each pass every class is keyed by the signs of 64 random projections and the classes are
ordered by key; each is compared with the WINDOW before it. Rows of a pass carry no vectors but a code of 12 bits a component, whose
rounding error is bounded: products beyond the bound are links or none for certain, and the few pairs within it are verified in double
precision by one join with the vectors. A task reports only the certain pairs that join what it has not joined yet, so a group of any
size gives as many rows as it has members. Passes run some at a time, so that their shuffles stay within BATCH times the vectors.

The number of passes follows the measured crowding: after one sort, the bits that each class shares with the one a window on tell how
many bits a pair must agree in, and among the most crowded tenth of the classes a pair at the threshold is missed with the stated
probability on average. An exact check follows at every size: classes in different components are compared block by block, so what the
passes never met is linked too, and no link depends on how many classes there are. It is quadratic in the classes, with a small constant
(README); EXACT = 0 leaves the passes alone, whose recall is measured in tests. Inside a component all pairs are then counted, in blocks:
quadratic in the distinct vectors of one component. Pairs within rounding of the threshold are decided by one sum wherever they are met.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from isthmus.llm.common import Scratch, connected_components, joined_evenly, partitions, read, tidy

WINDOW, BITS = 1024, 64
MISS = 0.01
#: Whether the exact check follows the passes. If so a pass is run for so many classes, at most those that the crowding asks for: on smaller
#: tables the check costs less than more passes before it.
EXACT, PER_PASS = 1, 2**14
#: Classes up to which one task orders a whole pass: a bound on its memory (a code each). More are dealt by ranges of the key.
PASS_ROWS = 2**17
#: Passes run at once shuffle at most so many times the vectors' bytes, or SMALL_BYTES.
BATCH, SMALL_BYTES = 2, 2**26
#: Components of vectors in one block, and vectors at most.
BLOCK_VALUES, BLOCK = 2**19, 8192
#: Files of blocks that the exact check pairs, and their bytes: more files where they would be larger.
FILES, FILE_BYTES = 64, 2**26
#: Components that screen products of longer vectors.
SCREEN = 32
#: Rows multiplied at once, and float32 rounding of such a product, to which each component adds.
STEP, SLACK, SLACK_EACH = 512, 1e-5, 2.0**-23


def passes_for(shared: np.ndarray, threshold: float, miss: float = MISS) -> int:
    """Passes after which a pair at the threshold, over the classes whose counts by bits needed are given, has been within a window of
    each other but with probability ``miss``."""
    apart = 1 - (1 - math.acos(threshold) / math.pi) ** np.maximum(1.0, np.arange(len(shared)))
    share = shared / max(1, shared.sum())
    low, high = 1, 2
    while share @ apart**high > miss:
        low, high = high, high * 2
    while high - low > 1:
        mid = (low + high) // 2
        low, high = (mid, high) if share @ apart**mid > miss else (low, mid)
    return high


def most_crowded(shared: np.ndarray, share: float = 0.1) -> np.ndarray:
    """Of counts by bits needed, those of the given share of all with most bits."""
    left, out = math.ceil(share * shared.sum()), np.zeros_like(shared)
    for bits in range(len(shared) - 1, -1, -1):
        out[bits] = min(left, shared[bits])
        left -= out[bits]
    return out


# ---------------------------------------------------------------- vectors, classes and codes


def scaled(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows in double precision, by powers of two so that no square overflows, and which rows are vectors that can link: finite and not zero."""
    x = x.astype(np.float64)
    top = np.abs(x).max(1)
    fine = np.isfinite(x).all(1) & (top > 0)
    x = np.where(fine[:, None], x, 1.0)
    return np.ldexp(x, -np.frexp(np.where(fine, top, 1.0))[1][:, None]), fine


def units(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows of length 1, as scaled."""
    x, fine = scaled(x)
    return x / np.linalg.norm(x, axis=1, keepdims=True) + 0.0, fine


def vectors_of(raws: list[bytes], kind: str) -> np.ndarray:
    return units(np.frombuffer(b"".join(raws), kind).reshape(len(raws), -1))[0]


def reach(x: np.ndarray, y: np.ndarray, i: np.ndarray, j: np.ndarray, threshold: float) -> np.ndarray:
    """Which of x[i] and y[j], vectors as given, have a cosine of at least the threshold: summed in double precision component by
    component, as SQL does, so that a pair's answer does not depend on what is compared beside it."""
    out, step = np.empty(len(i), np.bool_), max(1, BLOCK_VALUES // x.shape[1])
    for k in range(0, len(i), step):
        u, v = scaled(x[i[k : k + step]])[0], scaled(y[j[k : k + step]])[0]
        dot, a, b = (np.add.accumulate(p, axis=1)[:, -1] for p in (u * v, u * u, v * v))
        out[k : k + step] = dot / np.sqrt(a * b) >= threshold
    return out


class Vectors:
    """Vectors of one length as given, of length 1 in single precision, and their heads: components up to SCREEN and the length of the
    rest, so that a product of heads is never below that of the vectors."""

    def __init__(self, raw: bytes, n: int, kind: str) -> None:
        self.raw = np.frombuffer(raw, kind).reshape(n, -1)
        self.unit = units(self.raw)[0].astype(np.float32)
        self.slack = SLACK + self.raw.shape[1] * SLACK_EACH
        self.screens = self.raw.shape[1] > 1.5 * SCREEN
        self.head = np.concatenate([self.unit[:, :SCREEN], np.linalg.norm(self.unit[:, SCREEN:], axis=1, keepdims=True)], 1) if self.screens else self.unit


def close(x: Vectors, y: Vectors, rows: slice | np.ndarray, cols: slice | np.ndarray, threshold: float) -> np.ndarray:
    """Which of x[rows] and y[cols] reach the threshold."""
    if x.screens:
        out = x.head[rows] @ y.head[cols].T >= threshold - x.slack
        r, c = np.divmod(np.flatnonzero(out), out.shape[1])
        x.screens = len(r) <= out.size // 64  # else whole products are cheaper, here and likely for the rest
    if x.screens:
        at, to = np.arange(len(x.raw))[rows][r], np.arange(len(y.raw))[cols][c]
        dots = np.einsum("ij,ij->i", x.unit[at], y.unit[to])
        out[r, c] = dots >= threshold - x.slack
        some = np.flatnonzero(out[r, c] & (dots < threshold + x.slack))
        out[r[some], c[some]] = reach(x.raw, y.raw, at[some], to[some], threshold)
        return out
    dots = x.unit[rows] @ y.unit[cols].T
    out = dots >= threshold - x.slack
    if out.any():
        r, c = np.nonzero(out & (dots < threshold + x.slack))
        out[r, c] = reach(x.raw, y.raw, np.arange(len(x.raw))[rows][r], np.arange(len(y.raw))[cols][c], threshold)
    return out


def classes(vectors: DataFrame) -> tuple[DataFrame, str]:
    """vec_id, key and vec (components as bytes) of the rows of vectors (vec_id, embedding), and the components' kind; key is null where
    nothing links. Floats stay floats, all else is read as doubles."""
    element = getattr(vectors.schema["embedding"].dataType, "elementType", None)
    kind, name = ("<f4", "float") if isinstance(element, T.FloatType) else ("<f8", "double")

    @tidy
    def run(batches):
        for batch in batches:
            column = batch.column(1)
            flat, offsets = column.values.to_numpy(zero_copy_only=False), column.offsets.to_numpy()
            there = (column.is_valid().to_numpy(zero_copy_only=False)) & batch.column(0).is_valid().to_numpy(zero_copy_only=False)
            size = np.where(there, np.diff(offsets), 0)
            keys: list = [None] * len(size)
            vecs: list = [None] * len(size)
            for dim in np.unique(size[size > 0]).tolist():
                some = np.flatnonzero(size == dim)
                x = flat[offsets[some][:, None] + np.arange(dim)].astype(kind)  # a null component is not a number here
                u, fine = units(x)
                for i, r in zip(some[fine].tolist(), np.flatnonzero(fine).tolist(), strict=True):
                    keys[i], vecs[i] = xxhash.xxh3_128_digest(u[r].tobytes()), x[r].tobytes()
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(keys, pa.binary()), pa.array(vecs, pa.binary())], ["vec_id", "key", "vec"])

    typed = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast(f"array<{name}>").alias("embedding"))
    return typed.mapInArrow(run, "vec_id long, key binary, vec binary"), kind


def coded(u: np.ndarray) -> list[bytes]:
    """Each unit vector as a step (float32) and 12-bit multiples of it, two in three bytes."""
    step = (np.abs(u).max(1) / 2047).astype(np.float32)
    q = np.clip(np.rint(u / step[:, None].astype(np.float64)), -2047, 2047).astype(np.int32) + 2048
    q = np.concatenate([q, np.full((len(q), q.shape[1] % 2), 2048)], 1)
    a, b = q[:, 0::2], q[:, 1::2]
    packed = np.stack([a & 255, a >> 8 | (b & 15) << 4, b >> 4], 2).astype(np.uint8).reshape(len(q), -1)
    return [s + p for s, p in zip((step[i : i + 1].tobytes() for i in range(len(step))), map(bytes, packed), strict=True)]


def decoded(codes: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Vectors (float32) of codes of one length, and for each how far it may lie from the true one."""
    raw = np.frombuffer(b"".join(codes), np.uint8).reshape(len(codes), -1)
    step = np.ascontiguousarray(raw[:, :4]).view(np.float32).ravel()
    p = raw[:, 4:].reshape(len(codes), -1, 3).astype(np.int32)
    q = np.stack([p[:, :, 0] | (p[:, :, 1] & 15) << 8, p[:, :, 1] >> 4 | p[:, :, 2] << 4], 2).reshape(len(codes), -1) - 2048
    # a component is off by half a step, or a whole one at the greatest, whose multiple may be clipped
    return q.astype(np.float32) * step[:, None], step * np.float32(math.sqrt(q.shape[1] + 4) / 2 * 1.001)


# ---------------------------------------------------------------- windows


class Joined:
    """A small union-find over the rows of one task."""

    def __init__(self) -> None:
        self.up: dict[int, int] = {}

    def root(self, x: int) -> int:
        while (p := self.up.get(x, x)) != x:
            self.up[x] = x = self.up.get(p, p)
        return x

    def join(self, a: int, b: int) -> bool:
        a, b = self.root(a), self.root(b)
        if a != b:
            self.up[max(a, b)] = min(a, b)
        return a != b


class Sorted:
    """Rows of a pass in order: pass, cid, vector, error; and their codes, for what a later task must see again."""

    def __init__(self, group: list[int], ids: list[int], codes: list[bytes]) -> None:
        self.group, self.ids = np.array(group, np.int64), np.array(ids, np.int64)
        self.x, self.error = decoded(codes)

    def after(self, before: Sorted | None) -> Sorted:
        if before is None or before.x.shape[1] != self.x.shape[1]:
            return self
        out = object.__new__(Sorted)
        for c in ("group", "ids", "x", "error"):
            setattr(out, c, np.concatenate([getattr(before, c), getattr(self, c)]))
        return out

    def last(self, n: int) -> Sorted:
        out = object.__new__(Sorted)
        for c in ("group", "ids", "x", "error"):
            setattr(out, c, getattr(self, c)[-n:])
        return out


def window_links(rows: Sorted, begin: int, threshold: float, window: int, joined: Joined) -> list[tuple[int, int, bool]]:
    """(a, b, sure) of rows[begin:] with the window before each: sure pairs that join anything new, and pairs that must be verified."""
    out = []
    for a in range(begin, len(rows.ids), STEP):
        b, lo = min(a + STEP, len(rows.ids)), max(0, a - window)
        error = float(rows.error[lo:b].max())
        band = error * (2 + error) + SLACK + rows.x.shape[1] * SLACK_EACH
        r, c = np.nonzero(rows.x[a:b] @ rows.x[lo:b].T >= threshold - band)
        r, c = r + a, c + lo
        fine = (c < r) & (r - c <= window)
        r, c = r[fine], c[fine]
        fine = rows.group[r] == rows.group[c]
        r, c = r[fine], c[fine]
        if not len(r):
            continue
        dots = np.einsum("ij,ij->i", rows.x[r], rows.x[c])
        sure = dots >= threshold + band
        label = np.array([joined.root(i) for i in rows.ids[lo:b].tolist()])
        at, first = np.unique(r[sure], return_index=True)
        for i, partners in zip(at.tolist(), np.split(c[sure], first[1:]) if len(at) else [], strict=True):
            theirs = label[partners - lo]
            if (theirs != label[i - lo]).any():
                names, k = np.unique(theirs, return_index=True)
                for j in partners[k].tolist():
                    if joined.join(int(rows.ids[i]), int(rows.ids[j])):
                        out.append((int(rows.ids[i]), int(rows.ids[j]), True))
                label[np.isin(label, np.append(names, label[i - lo]))] = joined.root(int(rows.ids[i]))
        r, c = r[~sure], c[~sure]
        apart = label[r - lo] != label[c - lo]
        out += zip(rows.ids[r[apart]].tolist(), rows.ids[c[apart]].tolist(), [False] * int(apart.sum()), strict=True)
    return out


def keyed(reps: DataFrame, low: int, high: int, kind: str) -> DataFrame:
    """pass, key, cid and code of reps (cid, vec) for the passes low to high."""
    weights = (1 << np.arange(63, -1, -1, dtype=np.uint64)).astype(np.uint64)

    @tidy
    def run(batches):
        planes: dict[tuple[int, int], np.ndarray] = {}
        for whole in batches:
            for lo in range(0, whole.num_rows, 2000):
                batch = whole.slice(lo, 2000)
                raws = batch.column(1).to_pylist()
                for size in {len(v) for v in raws}:
                    some = [i for i, v in enumerate(raws) if len(v) == size]
                    u = vectors_of([raws[i] for i in some], kind)
                    codes, cids = pa.array(coded(u), pa.binary()), batch.column(0).take(pa.array(some))
                    for p in range(low, high):
                        if (size, p) not in planes:
                            planes[size, p] = np.random.default_rng([size // int(kind[-1]), 9, p]).standard_normal((u.shape[1], BITS))
                        key = ((u @ planes[size, p] > 0).astype(np.uint64) * weights).sum(1, dtype=np.uint64).view(np.int64) ^ np.int64(-(2**63))
                        yield pa.RecordBatch.from_arrays([pa.array(np.full(len(some), size * 2**20 + p)), pa.array(key), cids, codes], ["pass", "key", "cid", "code"])

    return reps.select("cid", "vec").mapInArrow(run, "pass long, key long, cid long, code binary")


ORDER = ("pass", "key", "cid")
FOUND = "a long, b long, sure boolean"


def told(found: list[tuple[int, int, bool]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([p[i] for p in found], t) for i, t in enumerate((pa.int64(), pa.int64(), pa.bool_()))], ["a", "b", "sure"])


def whole_passes(dealt: DataFrame, threshold: float, window: int) -> DataFrame:
    """Pairs of passes that one task can order, each whole in its task."""

    @tidy
    def run(batches):
        held, joined = None, Joined()
        for batch in batches:
            group, ids, codes = (batch.column(i).to_pylist() for i in (0, 2, 3))
            for a, b in runs(np.array([len(c) for c in codes])):
                part = Sorted(group[a:b], ids[a:b], codes[a:b])
                held = part.after(held)
                yield told(window_links(held, len(held.ids) - (b - a), threshold, window, joined))
                held = held.last(window)

    return dealt.repartition("pass").sortWithinPartitions(*ORDER).mapInArrow(run, FOUND)


def ranged_passes(dealt: DataFrame, n: int, threshold: float, window: int, scratch: Scratch) -> DataFrame:
    """Pairs of passes of n rows in all, in ranges of the key. The last rows of a task meet the first of the next in a second step, so
    that no window ends with a task; ranges hold several windows each."""
    dealt = dealt.repartitionByRange(max(1, min(partitions(dealt.sparkSession), n // (8 * window))), *ORDER).sortWithinPartitions(*ORDER)
    kinds = (pa.int64(), pa.int64(), pa.bool_(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary())
    names = ["a", "b", "sure", "edge", "pass", "key", "cid", "code"]

    def rows(found: list, ends: list) -> pa.RecordBatch:
        k, m = len(found), len(ends)
        cols = [[p[i] for p in found] + [None] * m for i in range(3)] + [[None] * k + [e[i] for e in ends] for i in range(5)]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds, strict=True)], names)

    @tidy
    def compare(batches):
        held, joined, pid, seen, last = None, Joined(), TaskContext.get().partitionId(), 0, []
        for batch in batches:
            group, key, ids, codes = (batch.column(i).to_pylist() for i in range(4))
            every = list(zip(group, key, ids, codes, strict=True))
            if seen < window:
                yield rows([], [(pid - 1, *r) for r in every[: window - seen]])
            seen += len(ids)
            last = (last + every[-window:])[-window:]
            for a, b in runs(np.array([len(c) for c in codes])):
                part = Sorted(group[a:b], ids[a:b], codes[a:b])
                held = part.after(held)
                yield rows(window_links(held, len(held.ids) - (b - a), threshold, window, joined), [])
                held = held.last(window)
        if last:
            yield rows([], [(pid, *r) for r in last])

    first = scratch.table(dealt.mapInArrow(compare, ", ".join(f"{c} {'boolean' if c == 'sure' else 'binary' if c == 'code' else 'long'}" for c in names)), "windows")
    ends = first.filter("edge is not null").select("edge", *ORDER, "code").repartition("edge").sortWithinPartitions("edge", *ORDER)

    @tidy
    def across(batches):
        at, held = None, []
        for batch in batches:
            for edge, *row in zip(*(batch.column(i).to_pylist() for i in (0, 1, 3, 4)), strict=True):
                if edge != at:
                    yield from done(held)
                    at, held = edge, []
                held.append(row)
        yield from done(held)

    def done(held):
        for a, b in runs(np.array([len(r[2]) for r in held])):
            part = Sorted([r[0] for r in held[a:b]], [r[1] for r in held[a:b]], [r[2] for r in held[a:b]])
            yield told(window_links(part, 0, threshold, window, Joined()))

    return first.filter("a is not null").select("a", "b", "sure").unionAll(ends.mapInArrow(across, FOUND))


def verified(pairs: DataFrame, reps: DataFrame, threshold: float, kind: str) -> DataFrame:
    """Those of pairs (a, b) whose cosine in double precision reaches the threshold."""

    @tidy
    def run(batches):
        for batch in batches:
            a, b = (batch.column(i).to_pylist() for i in (2, 3))
            near = np.zeros(len(a), np.bool_)
            for size in {len(v) for v in a}:
                some = [i for i, v in enumerate(a) if size == len(v) == len(b[i])]
                x, y = (np.frombuffer(b"".join([c[i] for i in some]), kind).reshape(-1, size // int(kind[-1])) for c in (a, b))
                near[some] = reach(x, y, np.arange(len(x)), np.arange(len(x)), threshold)
            yield pa.RecordBatch.from_arrays([batch.column(i).filter(pa.array(near)) for i in (0, 1)], ["a", "b"])

    one = reps.select(F.col("cid").alias("a"), F.col("vec").alias("va"))
    two = reps.select(F.col("cid").alias("b"), F.col("vec").alias("vb"))
    return pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct().join(one, "a").join(two, "b").select("a", "b", "va", "vb").mapInArrow(run, "a long, b long")


def measured_passes(reps: DataFrame, n: int, threshold: float, window: int, miss: float, kind: str) -> int:
    """The passes that the crowding of one pass asks for. BITS + 1 numbers reach the driver."""

    @tidy
    def crowding(batches):
        """Classes by the leading bits that must agree so that no more than a window shares them."""
        count, held = np.zeros(BITS + 1, np.int64), np.empty((0, 2), np.int64)
        for batch in batches:
            held = np.concatenate([held, np.stack([batch.column(c).to_numpy() for c in (0, 1)], 1)])
            if len(held) > window:
                a, b = held[:-window], held[window:]
                bits = np.array([BITS - int(x).bit_length() for x in (a[:, 1] ^ b[:, 1]).view(np.uint64).tolist()], np.int64)
                count += np.bincount(np.where(a[:, 0] == b[:, 0], np.minimum(bits + 1, BITS), 1), minlength=BITS + 1)
                held = held[-window:]
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(BITS + 1)), pa.array(count)], ["bits", "n"])

    one = keyed(reps, 0, 1, kind).select("pass", "key")
    one = one.repartition("pass") if n <= PASS_ROWS else one.repartitionByRange(max(1, min(partitions(reps.sparkSession), n // (8 * window))), "pass", "key")
    found = one.sortWithinPartitions("pass", "key").mapInArrow(crowding, "bits long, n long")
    shared = {r.bits: r.n for r in found.groupBy("bits").agg(F.sum("n").alias("n")).collect()}
    return passes_for(most_crowded(np.array([shared.get(i, 0) for i in range(BITS + 1)])), threshold, miss)


def links(reps: DataFrame, threshold: float, kind: str, scratch: Scratch, window: int = WINDOW, miss: float = MISS) -> DataFrame:
    """Pairs (a, b) of classes whose components are those of all pairs at the threshold; without the exact check, of all pairs that the
    passes met. reps: cid, vec."""
    n, size = reps.agg(F.count("*"), F.sum(F.length("vec"))).first()
    most = max(1, n // PER_PASS) if EXACT and PER_PASS else n
    n_passes = min(most, measured_passes(reps, n, threshold, window, miss, kind)) if most > 1 and n > window else 1
    row = size / n * 1.5 / int(kind[-1]) + 40
    some, parts = max(1, int(max(BATCH * size, SMALL_BYTES) / (n * row))), []
    for low in range(0, n_passes, some):
        high = min(n_passes, low + some)
        dealt = keyed(reps, low, high, kind)
        found = whole_passes(dealt, threshold, window) if n <= PASS_ROWS else ranged_passes(dealt, n * (high - low), threshold, window, scratch)
        parts.append(scratch.table(found, "pairs"))
    found = parts[0]
    for p in parts[1:]:
        found = found.unionAll(p)
    pairs = found.filter("sure").select("a", "b").unionAll(verified(found.filter("not sure"), reps, threshold, kind))
    if not EXACT:
        return pairs
    comps = scratch.table(connected_components(scratch.table(pairs, "links"), scratch), "components")
    rooted = reps.join(comps, F.col("cid") == F.col("node"), "left").select("cid", F.coalesce("root", "cid").alias("root"), "vec")
    return comps.select(F.col("node").alias("a"), F.col("root").alias("b")).unionAll(unmet(rooted, n, size, threshold, kind, scratch))


# ---------------------------------------------------------------- blocks


def block_size(rows: Column, vec: Column, kind: str) -> Column:
    """Rows of a block: an eighth of them all, so that several tasks share a component, between 256 and what BLOCK and BLOCK_VALUES allow."""
    most = F.least(F.lit(BLOCK), F.floor(F.lit(BLOCK_VALUES * int(kind[-1])) / F.length(vec)))
    return F.greatest(F.lit(256), F.least(most, F.ceil(rows / F.lit(8)))).cast("int")


def in_blocks(rows: DataFrame, size: Column, kind: str, *by: str) -> DataFrame:
    """rows (cid, vec and others) once for every pair of blocks that its block meets: by, i <= j, mine. size: rows that by has."""
    blocks = F.ceil(size / block_size(size, F.col("vec"), kind)).cast("int")
    mine = F.pmod(F.xxhash64("cid"), blocks).cast("int")
    dealt = rows.withColumn("mine", mine).withColumn("other", F.explode(F.sequence(F.lit(0), blocks - 1)))
    return dealt.withColumns({"i": F.least("mine", "other"), "j": F.greatest("mine", "other")}).drop("other")


class Rooted(Vectors):
    """A block of the exact check: cid and root of its vectors too, in order of the root."""

    def __init__(self, cids: bytes, roots: bytes, vecs: bytes, kind: str) -> None:
        self.ids = np.frombuffer(cids, np.int64)
        self.names, self.at = np.unique(np.frombuffer(roots, np.int64), return_inverse=True)
        super().__init__(vecs, len(self.ids), kind)

    def labels(self, joined: Joined) -> np.ndarray:
        return np.array([joined.root(i) for i in self.names.tolist()], np.int64)[self.at]


def unmet_links(x: Rooted, y: Rooted, threshold: float, joined: Joined) -> list[tuple[int, int]]:
    """Pairs of x and y that join anything new, as many as join all that reaches the threshold."""
    one = x is y
    mine, out = x.labels(joined), []
    theirs = mine if one else y.labels(joined)
    for a in range(0, len(mine), STEP):
        for b in range(a if one else 0, len(theirs), 4 * STEP):
            rows, cols = slice(a, a + STEP), slice(b, b + 4 * STEP)
            if (mine[rows] == mine[a]).all() and (theirs[cols] == mine[a]).all():
                continue
            met = close(x, y, rows, cols, threshold)
            for r in np.flatnonzero(met.any(1)).tolist():
                partners = b + np.flatnonzero(met[r])
                partners = partners[theirs[partners] != mine[a + r]]
                if not len(partners):
                    continue
                names, first = np.unique(theirs[partners], return_index=True)
                out += [(int(x.ids[a + r]), i) for i in y.ids[partners[first]].tolist()]
                names = np.append(names, mine[a + r])
                for i in names[:-1].tolist():
                    joined.join(i, int(names[-1]))
                root = joined.root(int(names[-1]))
                for label in (mine,) if one else (mine, theirs):
                    label[np.isin(label, names)] = root
    return out


def unmet(reps: DataFrame, n: int, size: int, threshold: float, kind: str, scratch: Scratch) -> DataFrame:
    """Pairs (a, b) that join the components of n classes (cid, root, vec; of size bytes) into those of all pairs at the threshold.

    Blocks are written once and read again for every pair of files, so nothing quadratic is shuffled or kept."""
    width = int(kind[-1])
    rows_of = lambda length: max(1, min(BLOCK, BLOCK_VALUES * width // length))

    @tidy
    def pack(batches):
        held, number = {}, TaskContext.get().partitionId() << 32

        def block(length: int) -> pa.RecordBatch:
            rows = sorted(held.pop(length), key=lambda r: r[1])
            cols = [np.array([r[i] for r in rows], np.int64).tobytes() for i in (0, 1)] + [b"".join([r[2] for r in rows])]
            return pa.RecordBatch.from_arrays([pa.array([number]), pa.array([length]), *(pa.array([c], pa.binary()) for c in cols)], ["block", "length", "cids", "roots", "vecs"])

        for batch in batches:
            for row in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                length = len(row[2])
                held.setdefault(length, []).append(row)
                if len(held[length]) >= rows_of(length):
                    yield block(length)
                    number += 1
        for length in list(held):
            yield block(length)
            number += 1

    @tidy
    def check(batches):
        joined, seen = Joined(), {}

        def block(number: pa.Scalar, *packed: pa.Scalar) -> Rooted:
            number = number.as_py()
            seen[number] = seen.pop(number, None) or Rooted(*(p.as_py() for p in packed), kind)
            if len(seen) > 8:  # the one used longest ago
                del seen[next(iter(seen))]
            return seen[number]

        for batch in batches:
            for row in zip(*batch.columns, strict=True):
                found = unmet_links(block(*row[:4]), block(*row[4:]), threshold, joined)
                yield pa.RecordBatch.from_arrays([pa.array([p[i] for p in found], pa.int64()) for i in (0, 1)], ["a", "b"])

    files = min(math.ceil(n / rows_of(math.ceil(size / n))), max(FILES, partitions(reps.sparkSession), math.ceil(size / FILE_BYTES)))
    table = scratch.table(reps.select("cid", "root", "vec").repartition(files).mapInArrow(pack, "block long, length long, cids binary, roots binary, vecs binary"), "blocks")
    i, j = (table.select(*(F.col(c).alias(f"{c}_{s}") for c in table.columns)) for s in "ij")
    pairs = i.join(j.hint("shuffle_replicate_nl"), (F.col("block_i") <= F.col("block_j")) & (F.col("length_i") - F.col("length_j") == 0))
    return pairs.select(*(f"{c}_{s}" for s in "ij" for c in ("block", "cids", "roots", "vecs"))).mapInArrow(check, "a long, b long")


def runs(x: np.ndarray):
    """(from, to) of the runs of equal neighbours."""
    cut = np.flatnonzero(x[1:] != x[:-1]) + 1
    return list(zip([0, *cut.tolist()], [*cut.tolist(), len(x)], strict=True)) if len(x) else []


def counted(members: DataFrame, threshold: float, kind: str) -> DataFrame:
    """cid and n_links of members (root, cid, copies, vec, size): all pairs inside a component, block by block."""

    def block(table: pa.Table) -> pa.Table:
        mine, cid, copies = (table.column(c).to_numpy() for c in ("mine", "cid", "copies"))
        x = Vectors(b"".join(table.column("vec").to_pylist()), len(cid), kind)
        out = np.zeros(len(cid), np.int64)
        lo = mine == mine.min()
        one = lo.all()
        a, b = np.flatnonzero(lo), np.flatnonzero(lo if one else ~lo)
        for k in range(0, len(a), STEP):
            near = close(x, x, a[k : k + STEP], b, threshold)
            out[a[k : k + STEP]] += near @ copies[b]
            if not one:
                out[b] += copies[a[k : k + STEP]] @ near
        # within one block a class meets itself: its copies but one are links, whatever rounding says of its own product
        if one:
            out += np.where(reach(x.raw, x.raw, a, a, threshold), -1, copies - 1)
        return pa.table({"cid": pa.array(cid), "n": pa.array(out)})

    # a pair of different blocks holds no pair inside a block: those are at i = j
    dealt = in_blocks(members, F.col("size"), kind).select("root", "i", "j", "mine", "cid", "copies", "vec")
    sent = dealt.groupBy("root", "i", "j").applyInArrow(block, "cid long, n long")
    return sent.groupBy("cid").agg(F.sum("n").alias("n_links"))


def near_duplicates(vectors: DataFrame, threshold: float, scratch: Scratch) -> DataFrame:
    """vec_id, n_links, component_id and kept for every row of vectors (vec_id, embedding).

    Vectors that are null, empty, zero or hold null or non-finite components, and rows without an id, link with nothing and are kept.
    Vectors of different lengths do not link. Rows that repeat an id are vectors of their own with the same id. Classes are known by
    64-bit hashes. An empty table gives none.
    """
    typed, kind = classes(vectors)
    rows = scratch.table(typed, "rows")
    known = rows.filter("key is not null")
    reps = scratch.table(known.groupBy("key").agg(F.min("vec_id").alias("low"), F.count("*").alias("copies"), F.first("vec").alias("vec")).withColumn("cid", F.xxhash64("key")), "reps")
    pairs = links(reps, threshold, kind, scratch) if not reps.isEmpty() else reps.select(F.col("cid").alias("a"), F.col("cid").alias("b"))
    comps = scratch.table(connected_components(scratch.table(pairs, "links"), scratch), "components")
    known = comps.join(reps.select("cid", "low"), F.col("node") == F.col("cid")).select("cid", "root", "low")
    roots = scratch.table(known.groupBy("root").agg(F.count("*").alias("size"), F.count("*").alias("classes"), F.min("low").alias("component_id")), "roots")
    placed = scratch.table(joined_evenly(known.select("cid", "root"), roots, "root", "classes"), "placed")
    n = counted(placed.join(reps, "cid").select("root", "cid", "copies", "vec", "size"), threshold, kind)
    told = reps.select("key", "cid", "low", "copies").join(n, "cid", "left").join(placed.select("cid", "component_id"), "cid", "left")
    told = scratch.table(told.select("key", "copies", F.coalesce("n_links", F.col("copies") - 1).alias("n_links"), F.coalesce("component_id", "low").alias("component_id")), "told", keep=True)
    out = joined_evenly(rows.select("vec_id", "key"), told, "key", "copies").select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), F.coalesce("component_id", "vec_id").alias("component_id"))
    return scratch.table(out.withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id"))), "result", keep=True)


def op9_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every vector, at cosine 0.9."""
    with Scratch(spark, "op9") as scratch:
        return near_duplicates(read(spark, sf_dir, "embeddings").select("vec_id", "embedding"), 0.9, scratch)


OP9_SQL = """
WITH RECURSIVE v AS (SELECT vec_id, embedding::double[] AS e FROM embeddings WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
  AND list_sum(list_transform(embedding, lambda x: CASE WHEN x IS NULL OR NOT isfinite(x) THEN 1 ELSE 0 END)) = 0 AND list_sum(list_transform(embedding, lambda x: abs(x))) > 0),
p AS (SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.vec_id <> b.vec_id AND len(a.e) = len(b.e) WHERE list_cosine_similarity(a.e, b.e) >= 0.9),
c AS (SELECT vec_id AS n, vec_id AS r FROM embeddings UNION SELECT p.b, c.r FROM c JOIN p ON p.a = c.n WHERE c.r < p.b),
m AS (SELECT n, min(r) AS r FROM c GROUP BY n),
k AS (SELECT a, count(*) AS n FROM p GROUP BY a)
SELECT e.vec_id, coalesce(k.n, 0)::bigint AS n_links, m.r AS component_id, e.vec_id = m.r AS kept
FROM embeddings e LEFT JOIN m ON m.n = e.vec_id LEFT JOIN k ON k.a = e.vec_id"""
