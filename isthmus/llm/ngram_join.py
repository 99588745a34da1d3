"""N-gram Jaccard join (operator 6): an exact similarity join on word shingles, for components and representatives.

The document by n-gram incidence matrix is multiplied with its transpose block by block, and the accumulated overlap counts decide:

* Documents with equal shingle sets are one row, a class.
* A census orders shingles from rare to frequent by bitmaps of bounded size, whose bounds rise with the corpus so that they stay sparse.
  Each class keeps the first n - ceil(t n) + 1 shingles of that order (then by hash): classes that link share one of these, so passages
  that many documents share seldom come into it. Where the bitmap tells, shingles of one document are not kept.
* The product of these columns says where overlaps can reach the bound at all. First each n-gram's rows are multiplied with one of them
  only, its pivot, so a group of copies gives as many pairs as members; pairs outside the size bounds are discarded. Then n-grams whose
  classes are still in different components are multiplied in full, the classes outside its largest component with all, block against
  block: a parity sketch of as many bits as the set has shingles bounds the symmetric difference from below.
* At the places that are left, whole rows are multiplied (a masked product): a block is a row with about SHARE partners at most, its overlap
  counts accumulate over all shingles, and a pair is a link if den * overlap >= num * (n + m - overlap). This goes on until no place is
  left that could join two components, so no link is lost.

Rows are sent as packed texts, a fraction of their shingles' size, and hashed again where they are multiplied. Shingles, sets and classes
are known by 64-bit hashes.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from isthmus.llm.common import BITMAP_BITS, FILL, Scratch, census, connected_components, dealt, distinct, grams, in_bitmap, joined_evenly, mix, raw, read, tidy, word_hashes

#: Bounds of document counts that may order shingles from rare to frequent, and how the next bounds follow from the first.
LADDER, STEPS = tuple(2**i for i in range(16)), (8, 128)
#: Rows of an n-gram that are multiplied at once; partners of one row in one task; rounds in which a class reports its nearest foreign
#: partner only.
BLOCK, SHARE, NEAREST_ROUNDS = 2000, 256, 1


def shingles(ids: np.ndarray | None, k: int) -> np.ndarray:
    """Sorted distinct hashes of the k-word shingles of words given as hashes; of fewer words, of the whole sequence; of none, nothing."""
    if ids is None or not len(ids):
        return np.empty(0, np.uint64)
    if len(ids) < k:
        return mix(grams(ids, len(ids)) + np.uint64(len(ids)))
    return distinct(grams(ids, k))


def class_id(s: np.ndarray) -> int:
    return int(np.uint64(xxhash.xxh3_64_intdigest(s.tobytes())).view(np.int64))


def least(n, num: int, den: int):
    """The least overlap of a set of n with any set it links to: ceil(num n / den)."""
    return -(-num * n // den)


def sketch(s: np.ndarray) -> np.ndarray:
    """Parities of the set's elements over the power of two of bits next to its size, at least 64."""
    bits = 1 << max(6, int(len(s) - 1).bit_length())
    odd = np.bincount((s & np.uint64(bits - 1)).astype(np.int64), minlength=bits) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").view(np.uint64)


def folded(x: np.ndarray, words: int) -> np.ndarray:
    while len(x) > words:
        x = x[: len(x) // 2] ^ x[len(x) // 2 :]
    return x


def bounds(counts: dict[int, int]) -> list[int]:
    """The least bound of LADDER that leaves a bitmap sparse, and those STEPS times as high."""
    first = next((b for b in LADDER if FILL * counts[b] <= 2**BITMAP_BITS), LADDER[-1])
    return [min(first * s, LADDER[-1]) for s in (1, *STEPS)]


def profiles(docs: DataFrame, k: int, num: int, den: int, scratch: Scratch) -> DataFrame:
    """Per row of docs (doc_id, text, row): doc_id, row, n, cid; and for the first of its class in a batch that could link at all,
    its sketch and prefix shingles."""

    def once(batch: pa.RecordBatch):
        seen = set()
        for ids in word_hashes(batch.column(1), lower=True):
            s = shingles(ids, k)
            if len(s) and (c := class_id(s)) not in seen:
                seen.add(c)
                yield s

    picked: list[int] = []

    def choose(counts: dict[int, int]) -> list[int]:
        picked.extend(bounds(counts))
        return picked

    sent = docs.sparkSession.sparkContext.broadcast(census(docs, once, LADDER, scratch, BITMAP_BITS, choose))  # three bitmaps of bounded size
    alone = picked[0] == 1  # what the first bitmap does not mark is in one document only

    @tidy
    def run(batches):
        maps = [np.frombuffer(b, np.uint8) for b in sent.value]
        for batch in batches:
            seen, cols = set(), [[] for _ in range(4)]
            for ids in word_hashes(batch.column(1), lower=True):
                s = shingles(ids, k)
                row = [len(s), None, None, None]
                if len(s):
                    row[1] = c = class_id(s)
                    if c not in seen:
                        seen.add(c)
                        rank = sum(in_bitmap(m, s).astype(np.int8) for m in maps)
                        first = np.argsort(rank, kind="stable")[: len(s) - least(len(s), num, den) + 1]
                        if alone:
                            first = first[rank[first] > 0]
                        if len(first):
                            row[2:] = sketch(s).tobytes(), s[first].view(np.int64)
                for col, v in zip(cols, row, strict=True):
                    col.append(v)
            types = (pa.int64(), pa.int64(), pa.binary(), pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), *(pa.array(c, t) for c, t in zip(cols, types, strict=True))], ["doc_id", "row", "n", "cid", "sketch", "prefix"])

    return docs.mapInArrow(run, "doc_id long, row long, n long, cid long, sketch binary, prefix array<long>")


def texts_of(docs: DataFrame, wanted: DataFrame, k: int, scratch: Scratch) -> DataFrame:
    """cid and packed text of the classes in wanted (cid), and by chance of a few others: a bitmap tells the tasks which."""

    def ids(batch: pa.RecordBatch):
        yield mix(batch.column(0).to_numpy().view(np.uint64))

    (bitmap,) = census(wanted.select("cid"), ids, (0,), scratch)
    sent = docs.sparkSession.sparkContext.broadcast(bitmap)

    @tidy
    def run(batches):
        marks, packer = np.frombuffer(sent.value, np.uint8), zstandard.ZstdCompressor(level=3)
        for batch in batches:
            out, seen = [], set()
            for i, h in enumerate(word_hashes(batch.column(1), lower=True)):
                s = shingles(h, k)
                if len(s) and (c := class_id(s)) not in seen and in_bitmap(marks, mix(np.array([c]).view(np.uint64)))[0]:
                    seen.add(c)
                    out.append((c, packer.compress(raw(batch.column(1).slice(i, 1))[0])))
            yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in out], pa.int64()), pa.array([r[1] for r in out], pa.binary())], ["cid", "packed"])

    return docs.mapInArrow(run, "cid long, packed binary").groupBy("cid").agg(F.first("packed").alias("packed"))


def overlaps(docs: DataFrame, pairs: DataFrame, k: int, scratch: Scratch) -> DataFrame:
    """The product of whole rows at the places pairs (a, b): a, b, their sizes n and m, and overlap. A class with many partners is split
    in blocks of about SHARE, each with its own copy of the row."""
    wanted = pairs.select(F.explode(F.array("a", "b")).alias("cid"))
    texts = scratch.table(texts_of(docs, wanted, k, scratch), "texts")
    shares = F.ceil(F.count("*").over(Window.partitionBy("a")) / F.lit(SHARE)).cast("int")
    dealt = pairs.select("a", "b").withColumn("share", F.pmod(F.xxhash64("b"), shares).cast("int"))
    centre = dealt.select("a", "share").distinct().select("a", "share", F.lit(None).cast("long").alias("b"), F.col("a").alias("cid"))
    # one row per use of a text, so that texts are joined once
    uses = centre.unionAll(dealt.select("a", "share", "b", F.col("b").alias("cid")))
    rows = uses.join(texts, "cid").select("a", "share", "b", "packed")

    @tidy
    def run(batches):
        at, base, reader = None, None, zstandard.ZstdDecompressor()
        for batch in batches:
            out: list[list[int]] = [[] for _ in range(5)]
            for lo in range(0, batch.num_rows, 256):
                part = batch.slice(lo, 256)
                hashed = word_hashes(pa.array([reader.decompress(x) for x in part.column(3).to_pylist()], pa.large_binary()).cast(pa.large_string()), lower=True)
                for a, share, b, ids in zip(*(part.column(i).to_pylist() for i in range(3)), hashed, strict=True):
                    s = shingles(ids, k)
                    if b is None:
                        at, base = (a, share), s
                    elif at == (a, share):
                        i = np.searchsorted(base, s)
                        i[i == len(base)] = 0
                        for c, v in zip(out, (a, b, len(base), len(s), int((base[i] == s).sum())), strict=True):
                            c.append(v)
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in out], ["a", "b", "n", "m", "overlap"])

    return rows.repartition("a", "share").sortWithinPartitions("a", "share", F.col("b").asc_nulls_first()).mapInArrow(run, "a long, b long, n long, m long, overlap long")


def linked(counts: DataFrame, num: int, den: int) -> DataFrame:
    """counts (as from overlaps) with ok: whether the overlap makes the pair a link."""
    return counts.select("a", "b", "overlap", (F.lit(den) * F.col("overlap") >= F.lit(num) * (F.col("n") + F.col("m") - F.col("overlap"))).alias("ok"))


def contested(posts: DataFrame, sketches: DataFrame, num: int, den: int, nearest: bool) -> DataFrame:
    """(a, b, cut) of classes in different components that an n-gram and the bounds allow, from posts (gram, cid, comp, n) and
    sketches (cid, sketch).

    An n-gram's classes outside its largest component look for partners among all its classes, block against block: up to BLOCK or so of
    either in a task. With nearest, each reports the nearest one of a block only, and cut where others were left for later."""
    shares = posts.groupBy("gram", "comp").agg(F.count("*").alias("n"))
    sizes = shares.groupBy("gram").agg(F.max(F.struct("n", "comp")).alias("most"), F.sum("n").alias("all"), F.count("*").alias("comps")).filter("comps > 1")
    blocks = lambda n: F.ceil(n / F.lit(BLOCK)).cast("int")
    sizes = sizes.select("gram", F.col("most.comp").alias("main"), blocks(F.col("all") - F.col("most.n")).alias("lookers"), blocks(F.col("all")).alias("parts"))
    placed = posts.join(sizes, "gram").withColumn("looks", F.col("comp") != F.col("main"))
    looker, part = F.pmod(F.xxhash64("cid"), F.col("lookers")).cast("int"), F.pmod(F.xxhash64("cid", F.lit(1)), F.col("parts")).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    partners = placed.select("gram", every("lookers").alias("looker"), part.alias("part"), F.lit(False).alias("asks"), "looks", "cid", "comp", "n")
    lookers = placed.filter("looks").select("gram", looker.alias("looker"), every("parts").alias("part"), F.lit(True).alias("asks"), "looks", "cid", "comp", "n")
    dealt = partners.unionAll(lookers).join(sketches, "cid").select("gram", "looker", "part", "asks", "looks", "cid", "comp", "n", "sketch")

    def group(rows: list[tuple]):
        asking, asked = ([r for r in rows if r[3] is asks] for asks in (True, False))
        if not asking or not asked:
            return
        asked.sort(key=lambda r: (r[7], r[5]))
        looks, cid, comp, n = (np.array([r[c] for r in asked]) for c in (4, 5, 6, 7))
        raws = [np.frombuffer(r[8], np.uint64) for r in asked]
        width = np.array([len(r) for r in raws])
        at: dict[int, np.ndarray] = {}
        for _, _, _, _, _, mine, home, size, packed in asking:
            some = np.arange(np.searchsorted(n, least(size, num, den)), np.searchsorted(n, size * den // num, side="right"))
            fine = comp[some] != home
            if not nearest:
                fine &= ~looks[some] | (cid[some] > mine)  # from one side, if both look
            some = some[fine]
            if not len(some):
                continue
            own, apart = np.frombuffer(packed, np.uint64), np.empty(len(some), np.int64)
            for w in np.unique(width[some]).tolist():
                v, here = min(w, len(own)), width[some] == w
                if v not in at:
                    at[v] = np.stack([folded(x, v) if len(x) >= v else np.zeros(v, np.uint64) for x in raws])
                apart[here] = np.bitwise_count(at[v][some[here]] ^ folded(own, v)).sum(1)
            near = apart * (den + num) <= (den - num) * (n[some] + size)
            some, apart = some[near], apart[near]
            cut = nearest and len(some) > 1
            if cut:
                some = some[[np.lexsort((cid[some], apart))[0]]]
            for s in some.tolist():
                yield min(mine, cid[s]), max(mine, cid[s]), cut

    @tidy
    def run(batches):
        held: list[tuple] = []
        for batch in batches:
            cols = [batch.column(i).to_pylist() for i in range(9)]
            out = []
            for row in zip(*cols, strict=True):
                if held and held[0][:3] != row[:3]:
                    out += group(held)
                    held = []
                held.append(row)
            yield told(out)
        if held:
            yield told(list(group(held)))

    def told(out: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([int(r[0]) for r in out], pa.int64()), pa.array([int(r[1]) for r in out], pa.int64()), pa.array([bool(r[2]) for r in out], pa.bool_())], ["a", "b", "cut"])

    found = dealt.repartition("gram", "looker", "part").sortWithinPartitions("gram", "looker", "part").mapInArrow(run, "a long, b long, cut boolean")
    return found.groupBy("a", "b").agg(F.max("cut").alias("cut"))


def named(prof: DataFrame, comps: DataFrame, scratch: Scratch) -> DataFrame:
    """doc_id, row, n_shingles and component_id of prof (doc_id, row, n, cid) by comps (node, root)."""
    classes = prof.filter("cid is not null").groupBy("cid").agg(F.min("doc_id").alias("low"), F.count("*").alias("copies")).join(comps, F.col("cid") == F.col("node"), "left")
    classes = scratch.table(classes.select("cid", "low", "copies", F.coalesce("root", "cid").alias("root")), "lows")
    roots = scratch.table(classes.groupBy("root").agg(F.min("low").alias("component_id"), F.count("*").alias("members")), "roots")
    names = scratch.table(joined_evenly(classes, roots, "root", "members").select("cid", "copies", "component_id"), "names")
    out = joined_evenly(prof.select("doc_id", "row", "n", "cid"), names, "cid", "copies")
    return out.select("doc_id", "row", F.col("n").alias("n_shingles"), F.coalesce("component_id", "doc_id").alias("component_id"))


def components(docs: DataFrame, k: int, num: int, den: int, scratch: Scratch) -> DataFrame:
    """doc_id, row, n_shingles and component_id of every row of docs (doc_id, text, row).

    Nulls and texts without a word have no shingles, link with nothing and are components of their own. The smallest id of a
    component is its id; rows without an id take part but name no component, unless it has no other (then it is null).
    """
    prof = scratch.table(profiles(docs, k, num, den, scratch), "profiles")
    reps = prof.filter("prefix is not null").groupBy("cid").agg(F.first("n").alias("n"), F.first("sketch").alias("sketch"), F.first("prefix").alias("prefix"))
    reps = scratch.table(reps, "classes")
    posts = reps.select("cid", "n", F.size("prefix").alias("own"), F.explode("prefix").alias("gram"))
    # a class with most shared shingles has fewest of its own, and is nearest to the others
    pivots = posts.groupBy("gram").agg(F.max(F.struct("own", "cid", "n")).alias("p"), F.count("*").alias("m")).filter("m > 1").select("gram", F.col("p.cid").alias("pivot"), F.col("p.n").alias("pn"))
    product = posts.join(pivots, "gram").filter(F.col("cid") != F.col("pivot")).filter(F.least("n", "pn") * den >= F.greatest("n", "pn") * num)
    partial = product.groupBy("pivot", "cid").agg(F.count("*").alias("overlap"))
    pairs = partial.groupBy("cid").agg(F.max(F.struct("overlap", "pivot")).alias("m")).select(F.col("m.pivot").alias("a"), F.col("cid").alias("b"))
    known = scratch.table(linked(overlaps(docs, scratch.table(pairs, "pairs"), k, scratch), num, den), "counts")
    turn = 0
    while True:
        comps = scratch.table(connected_components(known.filter("ok").select("a", "b"), scratch), "components")
        placed = reps.join(comps, reps.cid == comps.node, "left").select("cid", "n", F.coalesce("root", "cid").alias("comp"), F.explode("prefix").alias("gram"))
        again = contested(placed, reps.select("cid", "sketch"), num, den, turn < NEAREST_ROUNDS)
        seen = known.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"), F.lit(True).alias("seen")).distinct()
        again = scratch.table(again.join(seen, ["a", "b"], "left"), "contested")
        # a nearest partner counted before still hides the others of its class, so its cut counts
        count, cut = again.agg(F.count_if(F.col("seen").isNull()), F.max("cut")).first()
        turn += 1
        if not count:
            if cut:
                continue
            break
        more = scratch.table(linked(overlaps(docs, again.filter("seen is null").select("a", "b"), k, scratch), num, den), "counts")
        known = known.unionAll(more)
        if not cut:  # every place that could join two components has been counted
            comps = scratch.table(connected_components(known.filter("ok").select("a", "b"), scratch), "components")
            break
    return scratch.table(named(prof, comps, scratch), "result", keep=True)


def plain(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), F.xxhash64(F.col("text").cast("string")).alias("row"))


def packed_text(texts: pa.Array) -> pa.Array:
    packer = zstandard.ZstdCompressor(level=1)
    return pa.array([None if x is None else packer.compress(x) for x in raw(texts)], pa.binary())


def unpacked_text(packed: pa.Array) -> pa.Array:
    reader = zstandard.ZstdDecompressor()
    return pa.array([None if x is None else reader.decompress(x) for x in packed.to_pylist()], pa.binary()).view(pa.string())


def representatives(docs: DataFrame, k: int, num: int, den: int, scratch: Scratch) -> DataFrame:
    """The rows of docs of which one stays for each component: the smallest id's; of its rows with that id, the one of the smallest
    text hash; of repeated rows one. Rows without a word all stay. Texts go through the one shuffle packed, and come out as they were.
    Columns may have any names: they travel in a struct."""
    columns = docs.columns
    found = components(plain(docs), k, num, den, scratch)
    stay = found.filter("n_shingles > 0 and doc_id <=> component_id").groupBy("component_id").agg(F.min("row").alias("h"))
    key = lambda c: (F.coalesce(c.cast("long"), F.lit(0)), c.isNull())  # noqa: E731  plain columns, so that join and dropDuplicates share one shuffle
    stay = scratch.table(stay.select("h", *(x.alias(n) for x, n in zip(key(F.col("component_id")), ("d", "none"), strict=True))), "stay", keep=True)
    text = F.col("text").cast("string")
    rest = F.struct(*(F.col(f"`{c}`") for c in columns if c != "text")).alias("rest")
    worded = F.coalesce(text.rlike(r"[^\x20\x09-\x0D]"), F.lit(False))
    # not deterministic for the optimizer, which would else move the join below the packing
    pack, unpack = F.arrow_udf(packed_text, "binary").asNondeterministic(), F.arrow_udf(unpacked_text, "string")
    keyed = docs.filter(worded).select(F.xxhash64(text).alias("h"), *(x.alias(n) for x, n in zip(key(F.col("doc_id")), ("d", "none"), strict=True)), pack(text).alias("packed"), rest)
    one = keyed.join(stay, ["h", "d", "none"], "left_semi").dropDuplicates(["h", "d", "none"]).withColumn("packed", unpack("packed"))
    one = one.select(*((F.col("packed") if c == "text" else F.col("rest").getField(c)).alias(c) for c in columns))
    return one.unionAll(docs.filter(~worded))


def op6_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Four-word shingles, similarity 0.85."""
    with Scratch(spark, "op6") as scratch:
        return components(plain(dealt(read(spark, sf_dir, "documents"))), 4, 85, 100, scratch).select("doc_id", "n_shingles", "component_id")


OP6_SQL = r"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, array_to_string(w[i : i + 3], ' ') AS g FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 3, 1) + 1)) AS i FROM w WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY ALL),
e AS (SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 85 * (x.n + y.n - c)),
c AS (SELECT doc_id AS n, doc_id AS r FROM documents UNION SELECT e.b, c.r FROM c JOIN e ON e.a = c.n WHERE c.r < e.b)
SELECT d.doc_id, coalesce(n.n, 0)::bigint AS n_shingles, m.r AS component_id
FROM documents d LEFT JOIN n USING (doc_id) LEFT JOIN (SELECT n AS doc_id, min(r) AS r FROM c GROUP BY n) m USING (doc_id)"""
