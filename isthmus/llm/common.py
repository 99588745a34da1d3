"""What the operators of this subpackage share: words, hashes, scratch tables, the hash census and connected components.

Words are runs of bytes other than the six ASCII white-space characters (0x20, 0x09-0x0D), which is what ``bytes.split``
cuts at. Nothing here holds state of a corpus on the driver but bitmaps of bounded size.
"""

from __future__ import annotations

import contextlib
import ctypes
import math
import os
import tempfile
import uuid

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: White space between words, as a class of Java's and DuckDB's regular expressions.
SPACE = r"[\x20\x09-\x0D]"


# ---------------------------------------------------------------- scratch tables


class Scratch:
    """Tables written in the folder that spark.checkpoint.dir names, so that every executor can read them again and a lost
    executor costs no more than the stage that was running. ``keep`` marks those that a result still reads; the others are
    deleted when the block ends, and the kept ones by drop_kept() once the result has been written."""

    #: Paths of kept tables of ended blocks, oldest first.
    left: list[str] = []  # noqa: RUF012  of the whole driver

    def __init__(self, spark: SparkSession, name: str) -> None:
        self.spark, self.root, self.kept = spark, f"{shared_folder(spark)}/isthmus/{name}-{uuid.uuid4().hex[:12]}", set()
        self.names: list[str] = []

    def __enter__(self) -> Scratch:
        return self

    def path(self, name: str) -> str:
        self.names.append(f"{name}-{len(self.names)}")
        return f"{self.root}/{self.names[-1]}"

    def table(self, df: DataFrame, name: str, keep: bool = False) -> DataFrame:
        path = self.path(name)
        df.write.parquet(path)
        if keep:
            self.kept.add(path)
        out = self.spark.read.schema(df.schema).parquet(path)
        out._scratch = path
        return out

    def drop(self, df: DataFrame) -> None:
        delete(self.spark, df._scratch)

    def __exit__(self, *_: object) -> None:
        for n in self.names:
            if (path := f"{self.root}/{n}") in self.kept:
                Scratch.left.append(path)
            else:
                delete(self.spark, path)


def drop_kept(spark: SparkSession, since: int = 0) -> None:
    """Deletes kept tables, from number ``since`` of Scratch.left on. Results that read them are lost."""
    while len(Scratch.left) > since:
        delete(spark, Scratch.left.pop())


def shared_folder(spark: SparkSession) -> str:
    """The cluster's shared folder, as the session's spark.checkpoint.dir names it; where none is set, a folder of this machine if all of
    Spark runs on it (tests, a laptop), else an error."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir: set a folder that the driver and all executors share")
        folder = getattr(spark, "_isthmus_folder", None)
        if not folder:
            folder = spark._isthmus_folder = f"file://{tempfile.mkdtemp(prefix='isthmus-')}"
    return folder.rstrip("/")


def delete(spark: SparkSession, path: str) -> None:
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    with contextlib.suppress(Exception):
        p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: Tables of up to so many bytes are dealt to all cores before they are worked on.
SMALL_INPUT = 24 << 20


def dealt(df: DataFrame) -> DataFrame:
    """A table as it was read (all columns, so that its size is that of its files), or, if it is small, dealt round robin: a small file is
    often one row group, which one task alone would read."""
    size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    return df.repartition(max(1, df.sparkSession.sparkContext.defaultParallelism)) if size <= SMALL_INPUT else df


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def release() -> None:
    """Gives memory that nothing holds any more back to the machine: idle Python workers else keep what their last task took."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # a C library of another kind
        ctypes.CDLL(None).malloc_trim(0)


def tidy(run):
    """A mapInArrow function that gives its memory back at the end."""

    def wrapped(batches):
        yield from run(batches)
        release()

    return wrapped


# ---------------------------------------------------------------- words and shingles


def raw(column: pa.Array) -> list[bytes | None]:
    """The UTF-8 bytes of a string column, without making str objects."""
    return column.cast(pa.large_binary()).to_pylist()


_RANDOM = np.random.default_rng(20260807)
_CODE = _RANDOM.integers(1, 2**64, 256, np.uint64)
_LOWER = np.where((np.arange(256) >= 65) & (np.arange(256) <= 90), _CODE[np.arange(256) + 32 * ((np.arange(256) >= 65) & (np.arange(256) <= 90))], _CODE)
_SPACE = np.isin(np.arange(256), [32, 9, 10, 11, 12, 13])
#: Bytes hashed at once.
STRETCH = 1 << 19
_BASE = 0x9E3779B97F4A7C15 | 1
_POWERS: list[np.ndarray] = []


def _powers() -> list[np.ndarray]:
    """Powers of an odd number modulo 2**64, and of its inverse, one for each byte of a stretch; made once a worker."""
    if not _POWERS:
        for base in (_BASE, pow(_BASE, -1, 2**64)):
            x = np.empty(STRETCH + 1, np.uint64)
            x[0], n = 1, 1
            while n <= STRETCH:
                m = min(n, STRETCH + 1 - n)
                x[n : n + m] = x[:m] * np.uint64(pow(base, n, 2**64))
                n += m
            _POWERS.append(x)
    return _POWERS


def word_hashes(column: pa.Array, lower: bool = False):
    """For each text of a column the 64-bit hashes of its words, or None for a null. Texts are hashed many at a time; those longer
    than a stretch in parts that end at white space (a longer word in one part of its own)."""
    if not len(column):
        return
    column = column.cast(pa.large_string()) if not pa.types.is_large_string(column.type) else column
    offsets = np.frombuffer(column.buffers()[1], np.int64, len(column) + 1, column.offset * 8)
    data = np.frombuffer(column.buffers()[2] or b"", np.uint8)
    valid = column.is_valid().to_numpy(zero_copy_only=False)
    i, n = 0, len(column)
    while i < n:
        j = i + 1
        while j < n and offsets[j + 1] - offsets[i] < STRETCH:
            j += 1
        low, high = int(offsets[i]), int(offsets[j])
        if high - low <= STRETCH:
            # the last word of a text must not run into the next one
            h, begin = _split(data[low:high], offsets[i : j + 1] - low, lower)
            at = np.searchsorted(begin, offsets[i : j + 1] - low)
            for k in range(j - i):
                yield h[at[k] : at[k + 1]] if valid[i + k] else None
        else:
            parts = []
            while low < high:
                end = min(high, low + STRETCH)
                if end < high:
                    back = np.flatnonzero(_SPACE[data[low:end]])
                    if len(back):
                        end = low + int(back[-1]) + 1
                    else:
                        ahead = np.flatnonzero(_SPACE[data[end:high]])
                        end = end + int(ahead[0]) if len(ahead) else high
                if end - low <= STRETCH:
                    parts.append(_split(data[low:end], np.empty(0, np.int64), lower)[0])
                else:
                    word = data[low:end].tobytes()
                    parts.append(np.array([xxhash.xxh3_64_intdigest(word.lower() if lower else word)], np.uint64))
                low = end
            yield np.concatenate(parts) if valid[i] else None
        i = j


def _split(data: np.ndarray, bounds: np.ndarray, lower: bool) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of the words of up to STRETCH bytes, and where each begins: prefix sums of random codes times powers of a
    base give every word's polynomial at once. A word also ends where its text does, at one of bounds."""
    up, down = _powers()
    inside = ~_SPACE[data]
    if not len(inside):
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    cut = bounds[(bounds > 0) & (bounds < len(data))]
    cut = cut[inside[cut] & inside[cut - 1]]
    first = inside & np.r_[True, ~inside[:-1]]
    last = inside & np.r_[~inside[1:], True]
    first[cut] = True
    last[cut - 1] = True
    begin, end = np.flatnonzero(first), np.flatnonzero(last) + 1
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((_LOWER if lower else _CODE)[data] * up[: len(data)], out=sums[1:])
    return mix((sums[end] - sums[begin]) * down[begin] + (end - begin).astype(np.uint64)), begin


def distinct(h: np.ndarray) -> np.ndarray:
    """np.unique for short arrays."""
    s = np.sort(h)
    return s[np.r_[True, s[1:] != s[:-1]]] if len(s) > 1 else s


def mix(h: np.ndarray) -> np.ndarray:
    """A finalizer that spreads every bit over all 64."""
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xFF51AFD7ED558CCD)
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


def grams(ids: np.ndarray, k: int) -> np.ndarray:
    """Hashes of the runs of k ids; fewer ids give none."""
    n = len(ids) - k + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    h = np.full(n, 0x9E3779B97F4A7C15 + k, np.uint64)
    for i in range(k):
        h = h * np.uint64(0xD6E8FEB86659FD93) + ids[i : i + n]
    return mix(h)


# ---------------------------------------------------------------- census of hashes

#: A bitmap by leading bits of a hash has so many bits at least and at most (16 MB; 128 MB where a caller says so). It has ROOM bits a hash
#: as long as it may grow, and counts as sparse down to FILL. A false entry costs time, never a result.
LEAST_BITS, BITMAP_BITS, WIDE_BITS, ROOM, FILL = 20, 27, 30, 64, 8
#: Hashes that a task gathers before it sorts and sends them.
CENSUS_FLUSH = 1_000_000
COUNT_MAX = 65_535


def pack_sorted(x: np.ndarray) -> bytes:
    """Sorted 32-bit numbers as differences, byte planes, zstandard."""
    d = np.diff(x, prepend=np.uint32(0)).astype("<u4")
    return zstandard.ZstdCompressor(level=1).compress(d.view(np.uint8).reshape(-1, 4).T.tobytes())


def unpack_sorted(b: bytes) -> np.ndarray:
    d = np.frombuffer(zstandard.ZstdDecompressor().decompress(b), np.uint8).reshape(4, -1).T
    return np.cumsum(np.ascontiguousarray(d).view("<u4").ravel(), dtype=np.uint32)


def census_mapper(hashes_of, bits: int):
    """A mapInArrow function: hashes_of(batch) yields arrays of 64-bit hashes, each distinct within its document."""

    def flush(parts: list[np.ndarray]):
        h, n = np.unique(np.concatenate(parts) >> np.uint64(32 - bits), return_counts=True)  # bits + 32 leading bits
        n = np.minimum(n, COUNT_MAX).astype(np.uint16)
        edges = np.searchsorted(h, np.arange(2**bits + 1, dtype=np.uint64) << np.uint64(32))
        rows = [(b, pack_sorted((h[i:j] & np.uint64(0xFFFFFFFF)).astype(np.uint32)), zstandard.compress(n[i:j].tobytes(), 1)) for b, (i, j) in enumerate(zip(edges, edges[1:], strict=False)) if j > i]
        return pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int32()), pa.array([r[1] for r in rows], pa.binary()), pa.array([r[2] for r in rows], pa.binary())], ["bucket", "codes", "counts"])

    @tidy
    def run(batches):
        parts, size = [], 0
        for batch in batches:
            for h in hashes_of(batch):
                if len(h):
                    parts.append(h)
                    size += len(h)
                if size >= CENSUS_FLUSH:
                    yield flush(parts)
                    parts, size = [], 0
        if size:
            yield flush(parts)

    return run


def census(docs: DataFrame, hashes_of, over: tuple[int, ...], scratch: Scratch, most: int = BITMAP_BITS, choose=None) -> list[bytes]:
    """For each bound in ``over`` a bitmap of the hashes that more than that many documents hold.

    A hash counts once for each document; a task's count stops at COUNT_MAX, so bounds are below that. Counts are merged bucket by bucket
    of hashes and written; ``choose`` may pick bounds (a list) by how many hashes are over each, and only their bitmaps come to the driver,
    each of 2**most bits at most.
    """
    spark = docs.sparkSession
    bits = min(16, most - 3, max(6, math.ceil(math.log2(partitions(spark)))))  # a byte of the bitmap for each bucket at least
    width = 2 ** (most - bits)

    @tidy
    def merge(batches):
        codes: dict[int, list] = {}
        for batch in batches:
            for b, c, n in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                codes.setdefault(b, []).append((unpack_sorted(c), np.frombuffer(zstandard.decompress(n), np.uint16)))
                if len(codes[b]) >= 16:  # merge as they come, so memory follows the distinct hashes of a bucket
                    codes[b] = [joined(codes[b])]
        for b, parts in codes.items():
            c, n = joined(parts)
            counts, maps = [], []
            for bound in over:
                some = c[n > bound]
                bit = np.zeros(width, np.uint8)
                bit[some >> np.uint32(32 - most + bits)] = 1
                counts.append(len(some))
                maps.append(zstandard.compress(np.packbits(bit, bitorder="little").tobytes(), 1))
            yield pa.RecordBatch.from_arrays([pa.array([b], pa.int32()), *(pa.array([x], pa.int64()) for x in counts), *(pa.array([x], pa.binary()) for x in maps)], ["bucket", *(f"n{i}" for i in range(len(over))), *(f"m{i}" for i in range(len(over)))])

    def joined(parts):
        c, n = np.concatenate([p[0] for p in parts]), np.concatenate([p[1].astype(np.int64) for p in parts])
        order = np.argsort(c, kind="stable")
        c, n = c[order], n[order]
        first = np.flatnonzero(np.r_[True, c[1:] != c[:-1]]) if len(c) else np.empty(0, np.int64)
        return c[first], (np.add.reduceat(n, first) if len(first) else n)

    sent = docs.mapInArrow(census_mapper(hashes_of, bits), "bucket int, codes binary, counts binary").repartition("bucket")
    kinds = [f"n{i} long" for i in range(len(over))] + [f"m{i} binary" for i in range(len(over))]
    table = scratch.table(sent.mapInArrow(merge, "bucket int, " + ", ".join(kinds)), "census")
    counts = dict(zip(over, (n or 0 for n in table.agg(*(F.sum(f"n{i}") for i in range(len(over)))).first()), strict=True))
    picked = choose(counts) if choose else list(over)
    sizes = [min(most, max(LEAST_BITS, (ROOM * counts[b]).bit_length())) for b in picked]
    names = [f"m{over.index(b)}" for b in picked]

    @tidy
    def fold(batches):
        for batch in batches:
            cols = []
            for i, size in enumerate(sizes, 1):
                bits_of = (np.unpackbits(np.frombuffer(zstandard.decompress(m), np.uint8), bitorder="little") for m in batch.column(i).to_pylist())
                cols.append([zstandard.compress(np.packbits(x.reshape(-1, 2 ** (most - size)).max(1), bitorder="little").tobytes(), 1) for x in bits_of])
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(c, pa.binary()) for c in cols)], ["bucket", *(f"f{i}" for i in range(len(sizes)))])

    out = [np.zeros(2**size // 8, np.uint8) for size in sizes]
    folded = table.select("bucket", *(F.col(n).alias(f"f{i}") for i, n in enumerate(names))).mapInArrow(fold, "bucket int, " + ", ".join(f"f{i} binary" for i in range(len(sizes))))
    for row in folded.collect():  # bitmaps of bounded size
        for m, packed in zip(out, row[1:], strict=True):
            part = np.frombuffer(zstandard.decompress(bytes(packed)), np.uint8)
            m[row[0] * len(part) : (row[0] + 1) * len(part)] = part
    scratch.drop(table)
    return [m.tobytes() for m in out]


def in_bitmap(bitmap: np.ndarray, h: np.ndarray) -> np.ndarray:
    """Which hashes a bitmap (uint8 array) marks."""
    at = h >> np.uint64(64 - (8 * len(bitmap)).bit_length() + 1)
    return (bitmap[(at >> np.uint64(3)).astype(np.int64)] >> (at & np.uint64(7)).astype(np.uint8)) & 1 == 1


# ---------------------------------------------------------------- joins and connected components


def joined_evenly(rows: DataFrame, one: DataFrame, key: str, count: str) -> DataFrame:
    """rows with the other columns of ``one``, which has a row for each key and the number of rows that meet it (null where none does).

    Keys that more than a task's share of the rows meet are fewer than there are tasks: those are joined by broadcast. Their rows, and
    rows without a key, go through the shuffle under random keys, so no task gets a key whole. The key must be a long or binary."""
    columns, values = rows.columns, [c for c in one.columns if c not in (key, count)]
    mean = (one.agg(F.sum(count)).first()[0] or 0) // max(1, partitions(rows.sparkSession))
    hot = one.filter(F.col(count) > max(1, mean)).select(key, F.struct(*values).alias("_hot"))
    salt = F.xxhash64(F.monotonically_increasing_id())
    salt = F.md5(salt.cast("string").cast("binary")).cast("binary") if dict(rows.dtypes)[key] == "binary" else salt
    salted = rows.join(F.broadcast(hot), key, "left").withColumn("_key", F.when(F.col("_hot").isNotNull() | F.col(key).isNull(), salt).otherwise(F.col(key)))
    both = salted.join(one.select(F.col(key).alias("_key"), F.struct(*values).alias("_one")), "_key", "left")
    told = F.when(F.col("_hot").isNotNull(), F.col("_hot")).when(F.col(key).isNotNull(), F.col("_one"))
    return both.withColumn("_told", told).select(*columns, *(F.col("_told").getField(v).alias(v) for v in values))



#: Edges up to which one task joins them: a bound on its memory, not on the input. More take the distributed rounds.
SMALL_EDGES = 500_000


def joined_at_once(batches):
    """(node, root) of all edges (u, v) of one task, by union-find."""
    up: dict[int, int] = {}

    def root(x: int) -> int:
        while (p := up.setdefault(x, x)) != x:
            up[x] = x = up[p]
        return x

    for batch in batches:
        for u, v in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            u, v = root(u), root(v)
            if u != v:
                up[max(u, v)] = min(u, v)
    nodes = list(up)
    for i in range(0, len(nodes), 10_000):
        part = nodes[i : i + 10_000]
        yield pa.RecordBatch.from_arrays([pa.array(part, pa.int64()), pa.array([root(x) for x in part], pa.int64())], ["node", "root"])


def connected_components(edges: DataFrame, scratch: Scratch) -> DataFrame:
    """(node, root) for every node of edges (a, b): root is the smallest node that links reach.

    Up to SMALL_EDGES one task joins them. Beyond, alternating large-star and small-star steps: each replaces edges by edges to the smallest neighbour, so a component of
    any size or shape becomes a star in a logarithmic number of rounds. Only minima per node are aggregated; nothing is
    gathered. Nulls and loops are left out.
    """
    e = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).filter("u > v").distinct()
    e = scratch.table(e, "edges")
    if e.count() <= SMALL_EDGES:
        return e.coalesce(1).mapInArrow(joined_at_once, "node long, root long")
    seen = None
    while True:
        both = e.unionAll(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.filter("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u > v").distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(F.explode(F.array(F.struct(F.col("v").alias("u"), F.col("m").alias("v")), F.struct("u", F.col("m").alias("v")))).alias("x")).select("x.*").filter("u > v").distinct()
        new = scratch.table(small, "edges")
        scratch.drop(e)
        e = new
        now = e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == seen:
            break
        seen = now
    return e.select(F.col("u").alias("node"), F.col("v").alias("root")).unionAll(e.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())


def crc_not_held(column: str = "doc_id"):
    """True for rows that labels may be learnt from: crc32 of the id as text, mod 3, is not 1. A null id counts as ''."""
    return F.crc32(F.coalesce(F.col(column).cast("string"), F.lit("")).cast("binary")) % 3 != 1


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name) if not os.path.isabs(name) else name
