"""Substring deduplication with FM-indexes (operator 7).

A window of W words that another document holds too shares its minimizer, the least hash of its runs of GRAM words. A census marks
minimizers of two or more documents in a bitmap sized by the data; runs of windows with one such minimizer are segments, and all equal
windows come to one shard. Equal segments of a batch are one row, with all places they stand at. Each shard builds a compressed
FM-index of its distinct segments (Burrows-Wheeler transform in a wavelet matrix of packed bits) and streams the segments through
it: backward search gives the matching statistics, for each word the longest run ending there that stands elsewhere too, up to W, with
its interval of suffixes. Where a statistic reaches the threshold W, the least document id of the interval says which places repeat an
earlier document; those intervals of words are reported and cut.

Windows with a minimizer of many documents are dealt out one by one, by a hash of the whole window, and send only the least id of a
batch, so no shard grows with a passage's popularity. Their least ids come back to the places by broadcast, or, where they are too many
for that, by a salted join.
"""

from __future__ import annotations

import hashlib
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from isthmus.llm.common import WIDE_BITS, Scratch, census, dealt, distinct, grams, in_bitmap, partitions, raw, read, tidy, word_hashes
from isthmus.llm.ngram_join import plain

WINDOW, GRAM = 13, 4
#: Documents above which a minimizer's windows are dealt out one by one.
POPULAR = 20_000
#: Windows of such minimizers whose least ids are broadcast (16 bytes each); more are joined, a window's places in SALTS parts.
BROADCAST_LOWS, SALTS = 500_000, 16
#: Words of an FM-index, but for one minimizer's segments, which stay together.
SHARD_WORDS = 300_000
WORD = re.compile(rb"[^\x20\x09-\x0D]+")


class FmIndex:
    """An FM-index of texts (arrays of 64-bit symbols), for patterns of up to 16 symbols.

    Suffixes are sorted by their first 16 symbols, which makes the intervals of patterns up to that length exact."""

    DEPTH = 16

    def __init__(self, texts: list[np.ndarray]) -> None:
        joined = np.concatenate(texts) if texts else np.empty(0, np.uint64)
        self.symbols, coded = np.unique(joined, return_inverse=True)
        sizes = np.array([len(t) for t in texts], np.int64)
        self.starts = np.cumsum(sizes + 1) - sizes - 1
        self.text = np.zeros(int(sizes.sum()) + len(texts) + 1, np.int64)  # 0 ends every text
        inside = np.arange(len(joined)) + np.repeat(np.arange(len(texts)), sizes)
        self.text[inside] = coded + 1
        self.owner = np.repeat(np.arange(len(texts) + 1), np.r_[sizes + 1, 1])
        rank, n, step = self.text, len(self.text), 1
        self.suffixes = np.argsort(rank, kind="stable")
        while step < self.DEPTH:
            key = rank * (rank.max() + 1) + np.roll(rank, -step)
            self.suffixes = np.argsort(key, kind="stable")
            new = np.empty(n, np.int64)
            new[self.suffixes] = np.cumsum(np.r_[0, np.diff(key[self.suffixes]) > 0])
            rank, step = new, 2 * step
        bwt = self.text[self.suffixes - 1]
        self.first = first = np.r_[0, np.cumsum(np.bincount(bwt, minlength=len(self.symbols) + 1))]
        self.depth = max(1, int(len(self.symbols)).bit_length())
        self.bits, self.counts, self.zeros = [], [], []
        at, begin, code = bwt, np.zeros(len(self.symbols) + 1, np.int64), np.arange(len(self.symbols) + 1)
        for level in range(self.depth - 1, -1, -1):
            bit = (at >> level) & 1
            packed = np.packbits(np.r_[bit, np.zeros(-n % 64 + 64, np.int64)].astype(np.uint8), bitorder="little").view(np.uint64)
            self.bits.append(packed)
            self.counts.append((np.cumsum(np.bitwise_count(packed), dtype=np.int64) - np.bitwise_count(packed)).astype(np.int32))
            self.zeros.append(int(n - bit.sum()))
            begin = self._down(len(self.bits) - 1, (code >> level) & 1 == 1, begin)
            at = np.concatenate([at[bit == 0], at[bit == 1]])
        self.shift = first[:-1] - begin  # from a place in the last level to a row

    def _down(self, level: int, one: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Places on the next level of the places ``at`` for symbols whose bit is one."""
        word = at >> 6
        ones = self.counts[level][word] + np.bitwise_count(self.bits[level][word] & ((np.uint64(1) << (at & 63).astype(np.uint64)) - np.uint64(1)))
        return np.where(one, self.zeros[level] + ones, at - ones)

    def extend(self, symbol: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """One step of backward search for many patterns: the intervals of symbol + pattern. Symbols are codes from 1; 0 for one
        that the index has not."""
        a, b = low, high
        for i, level in enumerate(range(self.depth - 1, -1, -1)):
            one = (symbol >> level) & 1 == 1
            a, b = self._down(i, one, a), self._down(i, one, b)
        shift = self.shift[symbol]
        a, b = a + shift, b + shift
        return a, np.where(symbol > 0, b, a)

    def codes(self, text: np.ndarray) -> np.ndarray:
        if not len(self.symbols):
            return np.zeros(len(text), np.int64)
        i = np.minimum(np.searchsorted(self.symbols, text), len(self.symbols) - 1)
        return np.where(self.symbols[i] == text, i + 1, 0)

    def statistics(self, coded: np.ndarray, ends: np.ndarray, cap: int, rows: int = 1) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Matching statistics of a coded text: for each of the places ``ends`` the length, up to cap, of the longest run of words ending
        there that stands at ``rows`` places of the index at least, and that run's interval of suffixes."""
        n, cap = len(ends), min(cap, self.DEPTH)
        length, at_low, at_high = np.full(n, cap), np.zeros(n, np.int64), np.full(n, len(self.text), np.int64)
        before = np.r_[np.zeros(cap, np.int64), coded]  # no run goes beyond the begin of the text
        alive, low, high, at = np.arange(n), at_low.copy(), at_high.copy(), ends + cap
        for k in range(cap):
            symbol = before[at - k]
            if k:
                a, b = self.extend(symbol, low, high)
            else:
                a, b = self.first[symbol], np.where(symbol > 0, self.first[symbol + 1], self.first[symbol])
            enough = b - a >= rows
            if not enough.all():
                ended = alive[~enough]
                length[ended], at_low[ended], at_high[ended] = k, low[~enough], high[~enough]
                alive, at, a, b = alive[enough], at[enough], a[enough], b[enough]
            low, high = a, b
        at_low[alive], at_high[alive] = low, high
        return length, at_low, at_high

    def matching_statistics(self, text: np.ndarray, cap: int) -> np.ndarray:
        """For each place of text the length, up to cap, of the longest run of words ending there that the index holds."""
        return self.statistics(self.codes(text), np.arange(len(text)), cap)[0]


def least_in(values: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """The least of values[low : high] for intervals that are equal or disjoint and not empty."""
    start, back = np.unique(low, return_inverse=True)
    end = np.zeros(len(start), np.int64)
    end[back] = high
    cuts = np.stack([start, end], 1).ravel()
    return np.minimum.reduceat(np.r_[values, np.iinfo(np.int64).max], cuts)[::2][back]


def minimizers(ids: np.ndarray, window: int) -> np.ndarray:
    """The least hash of the runs of GRAM words in each window."""
    if ids is None:
        return np.empty(0, np.uint64)
    g = grams(ids, min(GRAM, window))
    k = window - min(GRAM, window) + 1
    if len(g) < k:
        return np.empty(0, np.uint64)
    out, width = g, 1
    while width < k:  # doubling: the least of 1, 2, 4, ... neighbours
        step = min(width, k - width)
        out = np.minimum(out[:-step], out[step:])
        width += step
    return out


#: Bytes of a word's hash that are sent; what is lost is made good by equal minimizers of full hashes.
SENT = 5


def narrow(ids: np.ndarray) -> bytes:
    return ids.astype("<u8").view(np.uint8).reshape(-1, 8)[:, 8 - SENT :].tobytes()


def widen(words: bytes) -> np.ndarray:
    x = np.zeros((len(words) // SENT, 8), np.uint8)
    x[:, 8 - SENT :] = np.frombuffer(words, np.uint8).reshape(-1, SENT)
    return x.view("<u8").ravel().astype(np.uint64)


def segments_of(words: bytes, key: np.ndarray, fine: np.ndarray, window: int):
    """(first word, words) of the runs of windows of one key, where fine; words as from narrow()."""
    change = key[1:] != key[:-1]
    begins = np.flatnonzero(fine & np.r_[True, change | ~fine[:-1]])
    ends = np.flatnonzero(fine & np.r_[change | ~fine[1:], True])
    for i, j in zip(begins.tolist(), ends.tolist(), strict=True):
        yield i, words[SENT * i : SENT * (j + window)]


def cut(docs: DataFrame, window: int, maps: object) -> DataFrame:
    """Segments of docs (doc_id, text, row), equal ones of a batch in one row: shard key, words, least doc_id, and places (doc_id,
    row, first word) as bytes; no places for windows of popular minimizers."""
    place = np.dtype([("doc", "<i8"), ("row", "<i8"), ("at", "<i4")])

    @tidy
    def run(batches):
        two, many = (np.frombuffer(b, np.uint8) for b in maps.value)
        for whole in batches:
            for lo in range(0, whole.num_rows, 2000):
                batch = whole.slice(lo, 2000)
                known: dict[tuple[int, bytes], list] = {}
                for d, ids, row in zip(batch.column(0).to_pylist(), word_hashes(batch.column(1)), batch.column(2).to_pylist(), strict=True):
                    key = minimizers(ids, window)
                    if not len(key) or not (fine := in_bitmap(two, key)).any():
                        continue
                    hot, all_words = fine & in_bitmap(many, key), narrow(ids)
                    for i, words in segments_of(all_words, key, fine & ~hot, window):
                        known.setdefault((int(key[i]), words), []).append((d, row, i))
                    if hot.any():
                        each = grams(ids, window)
                        for i in np.flatnonzero(hot).tolist():
                            least = known.setdefault((int(each[i]), all_words[SENT * i : SENT * (i + window)]), [d])
                            least[0] = min(least[0], d)
                if known:
                    rows = [(int(np.uint64(k).view(np.int64)), w, v[0] if isinstance(v[0], int) else min(p[0] for p in v), b"" if isinstance(v[0], int) else np.array(v, place).tobytes()) for (k, w), v in known.items()]
                    yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate((pa.int64(), pa.binary(), pa.int64(), pa.binary()))], ["shard", "words", "low", "places"])

    return docs.mapInArrow(run, "shard long, words binary, low long, places binary")


def searched(segments: DataFrame, window: int) -> DataFrame:
    """From segments: doc_id, row and windows (first words) of the places that repeat an earlier document; and for windows without
    places their key and the least id."""
    place = np.dtype([("doc", "<i8"), ("row", "<i8"), ("at", "<i4")])
    kinds = (pa.int64(), pa.int64(), pa.list_(pa.int32()), pa.int64(), pa.int64())

    def index(held: dict[bytes, list]) -> pa.RecordBatch:
        texts = [widen(w) for w in held]
        values = list(held.values())
        fm = FmIndex(texts)
        n = np.array([len(t) - window + 1 for t in texts])
        first = np.repeat(fm.starts, n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        ids = np.r_[np.array([v[0] for v in values], np.int64), np.iinfo(np.int64).max]
        mins = np.repeat(ids[:-1], n)
        length, low, high = fm.statistics(fm.text, first + window - 1, window, rows=2)
        more = np.flatnonzero(length >= window)
        if len(more):
            mins[more] = least_in(ids[fm.owner[fm.suffixes]], low[more], high[more])
        cols: list[list] = [[] for _ in kinds]
        upto = np.cumsum(n)
        for v, a, b in zip(values, (upto - n).tolist(), upto.tolist(), strict=True):
            m = mins[a:b]
            if not v[2]:
                row = [None, None, None, v[1], int(m[0])]
                for c, x in zip(cols, row, strict=True):
                    c.append(x)
                continue
            at = np.frombuffer(b"".join(v[2]), place)
            for k in np.flatnonzero(at["doc"] > m.min()).tolist():
                row = [int(at["doc"][k]), int(at["row"][k]), np.flatnonzero(m < at["doc"][k]).astype(np.int32) + at["at"][k], None, None]
                for c, x in zip(cols, row, strict=True):
                    c.append(x)
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], ["doc_id", "row", "windows", "key", "low"])

    @tidy
    def run(batches):
        held, size, at = {}, 0, None
        for batch in batches:
            for shard, words, low, places in zip(*(batch.column(i).to_pylist() for i in range(4)), strict=True):
                if shard != at and size >= SHARD_WORDS:
                    yield index(held)
                    held, size = {}, 0
                v = held.get(words)
                if v is None:
                    held[words] = v = [low, shard, []]
                    size += len(words) // SENT
                v[0] = min(v[0], low)
                if places:
                    v[2].append(places)
                at = shard
        if held:
            yield index(held)

    n = max(1, partitions(segments.sparkSession))
    return segments.repartition(n, "shard").sortWithinPartitions("shard").mapInArrow(run, "doc_id long, row long, windows array<int>, key long, low long")


def popular_places(docs: DataFrame, window: int, maps: object):
    """Batches of docs (doc_id, text, row) as (doc_id, row, places, keys) of the windows with a popular minimizer, for each row with one."""

    def places(batch: pa.RecordBatch):
        two, many = (np.frombuffer(b, np.uint8) for b in maps.value)
        for d, ids, row in zip(batch.column(0).to_pylist(), word_hashes(batch.column(1)), batch.column(2).to_pylist(), strict=True):
            key = minimizers(ids, window)
            at = np.flatnonzero(in_bitmap(two, key) & in_bitmap(many, key)) if len(key) else []
            if len(at):
                yield d, row, at.astype(np.int32), grams(ids, window)[at].view(np.int64)

    return places


def popular_hits(docs: DataFrame, lows: DataFrame, window: int, maps: object) -> DataFrame:
    """doc_id, row and windows of the places of popular windows that an earlier document holds, by lows (key, low)."""
    places = popular_places(docs, window, maps)
    if (n := lows.count()) <= BROADCAST_LOWS:
        table = lows.orderBy("key").collect() if n else []
        sent = docs.sparkSession.sparkContext.broadcast(np.array([[r.key for r in table], [r.low for r in table]], np.int64))

        @tidy
        def hits(batches):
            keys, low = sent.value
            for batch in batches:
                out = []
                for d, row, at, key in places(batch):
                    i = np.minimum(np.searchsorted(keys, key), max(0, len(keys) - 1))
                    found = at[(keys[i] == key) & (low[i] < d)] if len(keys) else at[:0]
                    if len(found):
                        out.append((d, row, found))
                yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], t) for i, t in enumerate((pa.int64(), pa.int64(), pa.list_(pa.int32())))], ["doc_id", "row", "windows"])

        return docs.mapInArrow(hits, "doc_id long, row long, windows array<int>")

    @tidy
    def each(batches):
        for batch in batches:
            for d, row, at, key in places(batch):
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(at), d)), pa.array(np.full(len(at), row)), pa.array(at), pa.array(key)], ["doc_id", "row", "at", "key"])

    salted = docs.mapInArrow(each, "doc_id long, row long, at int, key long").withColumn("salt", F.pmod(F.xxhash64("doc_id", "row"), F.lit(SALTS)).cast("int"))
    all_lows = lows.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return salted.join(all_lows, ["key", "salt"]).filter("low < doc_id").groupBy("doc_id", "row").agg(F.collect_set("at").alias("windows"))


def repeats(docs: DataFrame, window: int, scratch: Scratch) -> DataFrame:
    """doc_id, row and windows (first words) of the rows of docs (doc_id, text, row) that hold windows which a document of a smaller
    id holds too. Rows without an id neither give nor lose words."""
    if not 1 <= window <= FmIndex.DEPTH:
        raise ValueError(f"window: 1 to {FmIndex.DEPTH} words")
    known = docs.filter("doc_id is not null and text is not null")

    def values(batch: pa.RecordBatch):
        for ids in word_hashes(batch.column(1)):
            yield distinct(minimizers(ids, window))

    maps = docs.sparkSession.sparkContext.broadcast(census(known, values, (1, POPULAR), scratch, WIDE_BITS))  # two bitmaps of bounded size
    found = scratch.table(searched(cut(known, window, maps), window), "found")
    hits = found.filter("windows is not null").select("doc_id", "row", "windows")
    if any(maps.value[1]):
        lows = found.filter("key is not null").select("key", "low")
        hits = hits.unionAll(popular_hits(known, lows, window, maps))
    return hits.groupBy("doc_id", "row").agg(F.flatten(F.collect_list("windows")).alias("windows"))


def covered(windows: list[int] | None, window: int, n: int) -> np.ndarray:
    mark = np.zeros(n + 1, np.int64)
    if windows is not None and len(windows):
        w = np.unique(np.asarray(windows, np.int64))
        np.add.at(mark, w, 1)
        np.add.at(mark, np.minimum(w + window, n), -1)
    return np.cumsum(mark[:n]) > 0


def joined(docs: DataFrame, found: DataFrame) -> DataFrame:
    d, f = docs.alias("d"), found.alias("f")
    return d.join(f, F.expr("d.doc_id = f.doc_id and d.row = f.row"), "left").select("d.*", "f.windows")


def digests(docs: DataFrame, found: DataFrame, window: int) -> DataFrame:
    """doc_id, n_words, n_removed and kept_sha256 of every row of docs (doc_id, text, row)."""

    @tidy
    def run(batches):
        for batch in batches:
            n, lost, sha = [], [], []
            for t, w in zip(raw(batch.column(1)), batch.column(3).to_pylist(), strict=True):
                words = t.split() if t else []
                if w:
                    gone = covered(w, window, len(words))
                    lost.append(int(gone.sum()))
                    kept = [x for x, g in zip(words, gone.tolist(), strict=True) if not g]
                else:
                    lost.append(0)
                    kept = words
                n.append(len(words))
                sha.append(hashlib.sha256(b" ".join(kept)).hexdigest())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n, pa.int64()), pa.array(lost, pa.int64()), pa.array(sha, pa.string())], ["doc_id", "n_words", "n_removed", "kept_sha256"])

    return joined(docs, found).mapInArrow(run, "doc_id long, n_words long, n_removed long, kept_sha256 string")


def without_repeats(docs: DataFrame, window: int, scratch: Scratch) -> DataFrame:
    """docs with the repeated words, and the white space after each, cut out of their texts; other texts as they are. n_chars, if
    there is such a column, is counted anew where words were cut. Columns may have any names: they travel in a struct."""
    found = scratch.table(repeats(plain(docs), window, scratch), "found", keep=True)

    @F.pandas_udf("string")
    def cleaned(texts, windows):
        import pandas as pd

        out = []
        for t, w in zip(texts, windows, strict=True):
            if t is not None and w is not None and len(w):
                b = t.encode()
                at = [m.span() for m in WORD.finditer(b)]
                gone = covered(w, window, len(at))
                ends = [s for s, _ in at[1:]] + [len(b)]
                t = (b[: at[0][0]] + b"".join(b[s:e] for (s, _), e, g in zip(at, ends, gone.tolist(), strict=True) if not g)).decode()
            out.append(t)
        return pd.Series(out, dtype=object)

    text = F.col("text").cast("string")
    rows = docs.select(F.struct("*").alias("doc"), F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"), F.xxhash64(text).alias("row")).alias("d")
    both = rows.join(found.alias("f"), F.expr("d.doc_id = f.doc_id and d.row = f.row"), "left").select("doc", "text", "windows")
    lost = F.col("windows").isNotNull()
    both = both.withColumn("text", F.when(lost, cleaned("text", "windows")).otherwise(F.col("text")))
    said = {"text": F.col("text"), "n_chars": F.when(lost, F.length("text").cast(docs.schema["n_chars"].dataType if "n_chars" in docs.columns else "long")).otherwise(F.col("doc").getField("n_chars") if "n_chars" in docs.columns else F.lit(None))}
    return both.select(*((said[c] if c in said else F.col("doc").getField(c)).alias(c) for c in docs.columns))


def op7_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Windows of 13 words."""
    with Scratch(spark, "op7") as scratch:
        docs = plain(dealt(read(spark, sf_dir, "documents")))
        found = scratch.table(repeats(docs, WINDOW, scratch), "found", keep=True)
        return digests(docs, found, WINDOW)


OP7_SQL = r"""
WITH w AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
g AS (SELECT doc_id, i, array_to_string(w[i : i + 12], ' ') AS t FROM (SELECT doc_id, w, unnest(range(1, len(w) - 11)) AS i FROM w WHERE len(w) > 12)),
m AS (SELECT t, min(doc_id) AS low FROM g GROUP BY t),
h AS (SELECT DISTINCT doc_id, i + o AS p FROM g JOIN m USING (t), (SELECT unnest(range(0, 13)) AS o) WHERE low < doc_id),
u AS (SELECT doc_id, unnest(w) AS x, unnest(range(1, len(w) + 1)) AS p FROM w),
k AS (SELECT u.doc_id, string_agg(x, ' ' ORDER BY u.p) AS kept FROM u LEFT JOIN h ON h.doc_id = u.doc_id AND h.p = u.p WHERE h.p IS NULL GROUP BY u.doc_id),
r AS (SELECT doc_id, count(*) AS n FROM h GROUP BY doc_id)
SELECT w.doc_id, len(w)::bigint AS n_words, coalesce(r.n, 0)::bigint AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM w LEFT JOIN k USING (doc_id) LEFT JOIN r USING (doc_id)"""
