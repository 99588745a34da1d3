"""Token ids by the tokenizers library, and their files of independent zstandard frames (operator 3).

A document's text is cut at white space where the tokenizer's own pre-tokenization always cuts, and the ids of each cut are kept
per worker. A new cut of Latin letters is cut on by the tokenizer's pattern, and its library's model encodes the pieces;
any other cut goes through the whole tokenizer. The ids are those of the whole text, for a fraction of the time (tests compare both).

Shard format, after the public seekable format of zstandard: one frame with checksum per document (ids as little-endian
unsigned 32-bit), a skippable frame with the document ids (magic 0x184D2A50), and one with the seek table (0x184D2A5E): per frame
compressed size, raw size, xxh64 & 0xFFFFFFFF of the raw bytes; footer: frames (u32), flags 0x80, magic 0x8F92EAB1. Any zstandard
decoder reads a shard as a stream of ids; a reader of some documents opens the table and fetches their frames only.

Shards are files that tasks write and read through Arrow's file systems (local and shared folders, HDFS, S3, GCS). The input may lie in any
store that Spark reads. A null text is empty; rows without an id come first; repeated rows are documents each, by content; an empty
table has no shard.
"""

from __future__ import annotations

import functools
import gc
import itertools
import os
import string
import struct
import threading
import zlib
from array import array
from collections.abc import Callable

import numpy as np
import pyarrow as pa
import regex
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from isthmus.llm.common import Scratch, dealt, partitions, read, release, shared_folder, tidy, tokenizer_path

CACHE_CUTS = 700_000
IDS_FRAME, SEEK_FRAME, SEEK_MAGIC = 0x184D2A50, 0x184D2A5E, 0x8F92EAB1
# How byte-level vocabularies write bytes that are no printable characters, and their patterns for Latin text.
_PRINTED = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
_BYTE_CHARS = {**{b: b for b in _PRINTED}, **{b: 256 + i for i, b in enumerate(b for b in range(256) if b not in _PRINTED)}}
SHOWN_SPACE = "\u0120"
LATIN_END = "\u0250"
MARKS = string.punctuation
SPACED = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")
SPACELESS = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|\p{L}+|\p{N}|[^\s\p{L}\p{N}]+")


#: Seconds after which an encoder that no task uses forgets what it kept.
IDLE_S = 10.0


class Kept(dict):
    """Results of a function by its argument; begins anew when full."""

    def __init__(self, make: Callable[[str], bytes]) -> None:
        super().__init__()
        self.make = make

    def __missing__(self, key: str) -> bytes:
        made = self.make(key)
        if len(self) >= CACHE_CUTS:
            self.clear()
        self[key] = made
        return made


class Encoder:
    """ids(text): little-endian unsigned 32-bit ids of a whole text."""

    def __init__(self, path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        # texts that may hold an added token's string go through the whole tokenizer
        self.added = sorted({t.content[:2] for t in self.tokenizer.get_added_tokens_decoder().values()})
        self.drops_space = "Removed" in (str(self.tokenizer.pre_tokenizer) or "")
        self.cuts, self.pieces = Kept(self.cut_ids), Kept(self.model_ids)
        self.model = self.tokenizer.model
        self.lock, self.users, self.timer = threading.Lock(), 0, None
        # the shortcut for Latin cuts is taken for the two patterns it knows
        shape = str(self.tokenizer.pre_tokenizer)
        known = "[\\p{L}]+|[\\p{N}]|" in shape.replace("\\\\", "\\") if self.drops_space else shape == 'ByteLevel(add_prefix_space=False, trim_offsets=True, use_regex=True)'
        self.pattern = (SPACELESS if self.drops_space else SPACED) if known else None

    def begins(self) -> None:
        """A task begins to use this encoder."""
        with self.lock:
            self.users += 1
            if self.timer is not None:
                self.timer.cancel()
                self.timer = None

    def ends(self) -> None:
        """A task ends; if no other begins for a while, the memory is given back."""
        with self.lock:
            self.users -= 1
            if not self.users:
                self.timer = threading.Timer(IDLE_S, self.forget)
                self.timer.daemon = True
                self.timer.start()

    def forget(self) -> None:
        with self.lock:
            if not self.users:
                self.cuts.clear()
                self.pieces.clear()
                release()

    def cut(self, text: str) -> list[str]:
        """Pieces that the tokenizer would encode one by one: at white space if it drops it; else before single spaces and line ends
        between other characters, since only there its pattern is sure to begin a new match. Those spaces are left out here: every
        piece but the first has one before it, unless it begins with its line end."""
        if self.drops_space:
            parts = text.replace("\n", " ").split(" ")
            return [x for x in parts if x] if "" in parts else parts
        parts = text.replace("\n", " ").split(" ")
        if parts == text.split():
            return text.replace("\n", " \n").split(" ") if "\n" in text else parts
        if not text:
            return []
        out, last = [], ""
        for i, p in enumerate(text.split(" ")):
            if i and (not last or last[-1].isspace() or not p or p[0].isspace()):
                out[-1] += " " + p
            else:
                out.append(p)
            last = p
        return out

    def model_ids(self, piece: str) -> bytes:
        """Ids of a piece that the pattern leaves whole."""
        shown = piece.replace(" ", SHOWN_SPACE) if piece.isascii() and piece.isprintable() else piece.encode().decode("latin-1").translate(_BYTE_CHARS)
        return array("I", [t.id for t in self.model.tokenize(shown)]).tobytes()

    def cut_ids(self, c: str) -> bytes:
        """Ids of a cut. Most are a word, or a word and marks after it: the pattern leaves both whole."""
        drops = self.drops_space
        if self.pattern is None or not (c.isascii() or max(c, default="") < LATIN_END):
            return array("I", self.tokenizer.encode(c if drops or c[:1] == "\n" else " " + c, add_special_tokens=False).ids).tobytes()
        low = c.lower() if drops else c
        word = low.rstrip(MARKS)
        if word.isalpha():
            if word != c:
                return self.cuts[word] + self.pieces[low[len(word) :]] if word != low else self.cuts[word]
            return self.model_ids(word if drops else " " + word)
        if c[:1] == "\n" and not drops:
            return self.pieces["\n"] + self.first(c[1:])
        return b"".join(map(self.pieces.__getitem__, self.pattern.findall(low if drops else " " + c)))

    def first(self, cut: str) -> bytes:
        """Ids of a text's or line's first piece, which has no space before it."""
        if self.pattern is not None and max(cut, default="") < LATIN_END:
            return b"".join(map(self.pieces.__getitem__, self.pattern.findall(cut)))
        return array("I", self.tokenizer.encode(cut, add_special_tokens=False).ids).tobytes()

    def ids(self, text: str) -> bytes:
        if any(a in text for a in self.added):
            return array("I", self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()
        cuts = self.cut(text)
        if self.drops_space or not cuts:
            return b"".join(map(self.cuts.__getitem__, cuts))
        return self.first(cuts[0]) + b"".join(map(self.cuts.__getitem__, itertools.islice(cuts, 1, None)))


@functools.lru_cache(2)
def encoder(path: str) -> Encoder:
    gc.set_threshold(50_000, 20, 100)  # what is kept here has no cycles, and walking it again and again costs a tenth of the time
    return Encoder(path)


def encoded(batch: pa.RecordBatch, path: str, end: int):
    """(id, ids with the end id) for each row of (doc_id, text); a null text is empty."""
    tail, enc = struct.pack("<I", end), encoder(path)
    enc.begins()
    try:
        for i in range(0, batch.num_rows, 256):
            part = batch.slice(i, 256)
            for d, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), strict=True):
                yield d, enc.ids(text or "") + tail
    finally:
        enc.ends()


def shard_bounds(docs: DataFrame, n: int) -> np.ndarray:
    """First ids of n shards at most, but the first, with about as many rows each: approximate quantiles, which are all that reaches the
    driver. Ids from a bound on are in its shard; rows without an id are in the first."""
    bounds = docs.stat.approxQuantile("doc_id", [i / n for i in range(1, n)], 0.2 / n) if n > 1 else []
    return np.unique(np.array(bounds, np.float64).astype(np.int64))


def write_token_store(docs: DataFrame, folder: str, tokenizer: str, end_id: int, scratch: Scratch) -> DataFrame:
    """Encodes docs (doc_id, text) and writes shards in ascending doc_id order (null ids first, repeated rows by content).

    folder: a URI that Arrow and all executors can reach. A task writes a shard under a name of its own and renames it at the end, so
    a repeated task leaves one whole shard. Returns the manifest: shard, path, n_docs, n_tokens. Empty tables give no shard.
    """
    path = tokenizer_path(tokenizer)

    @tidy
    def frames(batches):
        packer = zstandard.ZstdCompressor(level=1, write_checksum=True)
        for batch in batches:
            ids = batch.column(0)
            first = np.searchsorted(bounds, ids.fill_null(0).to_numpy(zero_copy_only=False), side="right")
            shard = np.where(ids.is_valid().to_numpy(zero_copy_only=False), first, 0).astype(np.int32)
            rows = [(d, packer.compress(x), len(x) // 4, xxhash.xxh64_intdigest(x) & 0xFFFFFFFF) for d, x in encoded(batch, path, end_id)]
            yield pa.RecordBatch.from_arrays([pa.array(shard), *(pa.array([r[i] for r in rows], t) for i, t in enumerate((pa.int64(), pa.binary(), pa.int64(), pa.int64())))], ["shard", "doc_id", "frame", "n", "sum"])

    @tidy
    def shards(batches):
        from pyarrow import fs

        attempt = TaskContext.get().taskAttemptId()
        store, root = fs.FileSystem.from_uri(folder)
        open_shard: OpenShard | None = None
        for batch in batches:
            for k, d, frame, n, check in zip(*(batch.column(i).to_pylist() for i in range(5)), strict=True):
                if open_shard is None or open_shard.number != k:
                    if open_shard is not None:
                        yield open_shard.closed()
                    open_shard = OpenShard(store, root, k, attempt)
                open_shard.add(d, frame, n, check)
        if open_shard is not None:
            yield open_shard.closed()

    n = max(1, partitions(docs.sparkSession))
    typed = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    bounds = shard_bounds(typed, n)
    made = typed.mapInArrow(frames, "shard int, doc_id long, frame binary, n long, sum long")
    dealt_out = made.repartition(n, "shard").sortWithinPartitions("shard", "doc_id", "n", "frame")
    return scratch.table(dealt_out.mapInArrow(shards, "shard int, path string, n_docs long, n_tokens long"), "manifest", keep=True)


class OpenShard:
    """A shard being written, under a name of its own until it is whole."""

    def __init__(self, store, root: str, number: int, attempt: int) -> None:
        self.store, self.number, self.name = store, number, f"{root}/shard-{number:06d}.zst"
        self.part = f"{self.name}.{attempt}.part"
        store.create_dir(root, recursive=True)
        self.out = store.open_output_stream(self.part)
        self.ids: list[int | None] = []
        self.table: list[bytes] = []
        self.tokens = 0

    def add(self, doc_id: int | None, frame: bytes, n: int, check: int) -> None:
        self.out.write(frame)
        self.ids.append(doc_id)
        self.table.append(struct.pack("<III", len(frame), 4 * n, check))
        self.tokens += n

    def closed(self) -> pa.RecordBatch:
        n = len(self.ids)
        body = struct.pack(f"<{n}?", *(d is None for d in self.ids)) + struct.pack(f"<{n}q", *(d or 0 for d in self.ids))
        self.out.write(struct.pack("<II", IDS_FRAME, len(body)) + body)
        self.out.write(struct.pack("<II", SEEK_FRAME, 12 * n + 9) + b"".join(self.table) + struct.pack("<IBI", n, 0x80, SEEK_MAGIC))
        self.out.close()
        self.store.move(self.part, self.name)
        return pa.RecordBatch.from_arrays([pa.array([self.number], pa.int32()), pa.array([self.name]), pa.array([n], pa.int64()), pa.array([self.tokens], pa.int64())], ["shard", "path", "n_docs", "n_tokens"])


class Shard:
    """Random access to one shard."""

    def __init__(self, folder: str, path: str) -> None:
        from pyarrow import fs

        self.file = fs.FileSystem.from_uri(folder)[0].open_input_file(path)
        size = self.file.size()
        n, flags, magic = struct.unpack("<IBI", self.file.read_at(9, size - 9))
        if magic != SEEK_MAGIC or flags != 0x80:
            raise ValueError(f"{path}: no seek table")
        table = np.frombuffer(self.file.read_at(12 * n, size - 9 - 12 * n), "<u4").reshape(n, 3).astype(np.int64)
        self.packed, self.sizes, self.sums = table.T
        self.starts = np.cumsum(self.packed) - self.packed
        body = self.file.read_at(9 * n, size - 17 - 12 * n - 9 * n)
        self.null = np.frombuffer(body, np.bool_, n)
        self.doc_ids = np.frombuffer(body, "<i8", n, n)

    def __len__(self) -> int:
        return len(self.sizes)

    def ids(self, i: int) -> bytes:
        """The i-th document's ids, with both checksums tested."""
        raw = zstandard.ZstdDecompressor().decompress(self.file.read_at(int(self.packed[i]), int(self.starts[i])), max_output_size=int(self.sizes[i]))
        if xxhash.xxh64_intdigest(raw) & 0xFFFFFFFF != self.sums[i]:
            raise ValueError(f"document {self.doc_ids[i]}: checksum differs")
        return raw


def read_token_store(manifest: DataFrame, folder: str, wanted: frozenset[int] | None = None) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 and ids (binary) of all documents, or of a stated set of ids."""
    based = manifest.withColumn("base", F.sum("n_tokens").over(Window.orderBy("shard")) - F.col("n_tokens"))  # a row per shard

    @tidy
    def rows(batches):
        for batch in batches:
            for path, base in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                shard = Shard(folder, path)
                starts = base + np.cumsum(shard.sizes // 4) - shard.sizes // 4
                some = [i for i in range(len(shard)) if wanted is None or (not shard.null[i] and int(shard.doc_ids[i]) in wanted)]
                for k in range(0, len(some), 500):
                    part = some[k : k + 500]
                    raws = [shard.ids(i) for i in part]
                    yield pa.RecordBatch.from_arrays([pa.array([None if shard.null[i] else int(shard.doc_ids[i]) for i in part], pa.int64()), pa.array([int(starts[i]) for i in part], pa.int64()), pa.array([len(x) // 4 for x in raws], pa.int64()), pa.array([zlib.crc32(x) for x in raws], pa.int64()), pa.array(raws, pa.binary())], ["doc_id", "start", "n_tokens", "ids_crc32", "ids"])

    n = max(1, manifest.count())
    return based.select("path", "base").repartition(n).mapInArrow(rows, "doc_id long, start long, n_tokens long, ids_crc32 long, ids binary")


def op3_token_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Writes the whole table with ``word_bpe_49k.json`` and end id 1, and reads every document back."""
    with Scratch(spark, "op3") as scratch:
        folder = f"{shared_folder(spark)}/isthmus/{scratch.root.rsplit('/', 1)[1]}-store"
        Scratch.left.append(folder)  # with the other tables that the result reads
        manifest = write_token_store(dealt(read(spark, sf_dir, "documents")), folder, "word_bpe_49k.json", 1, scratch)
        return read_token_store(manifest, folder).drop("ids")
