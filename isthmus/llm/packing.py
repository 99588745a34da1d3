"""Best-fit packing of documents into sequences (operator 1).

Only a histogram of piece lengths, of at most max_len rows, reaches the driver. Best-fit decreasing runs over its counts: a
group of equal bins takes as many pieces of a length as fit, so the plan has at most about 11 rows per bin group and four
groups per length, whatever the corpus. Pieces then take planned slots by joining on their rank within their length.
"""

from __future__ import annotations

import bisect
import zlib

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from isthmus.llm.common import Scratch, dealt, partitions, read, tidy, tokenizer_path
from isthmus.llm.tokens import encoded

MAX_LEN = 2048


def pieces(docs: DataFrame, tokenizer: str, end_id: int, max_len: int, with_ids: bool = False) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 (and ids): the documents with their end id, in pieces of max_len where they
    are longer, of which the first may be shorter. A null text is empty and has the end id alone."""
    path = tokenizer_path(tokenizer)
    schema = "doc_id long, piece int, start long, length long, ids_crc32 long" + ", ids binary" * with_ids

    @tidy
    def run(batches):
        for batch in batches:
            cols: list[list] = [[] for _ in range(6)]
            for d, ids in encoded(batch, path, end_id):
                n = len(ids) // 4
                at, piece, end = 0, 0, n % max_len or max_len
                while at < n:
                    part = ids[4 * at : 4 * end]
                    for c, v in zip(cols, (d, piece, at, end - at, zlib.crc32(part), part), strict=True):
                        c.append(v)
                    at, piece, end = end, piece + 1, end + max_len
            types = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary())
            names = ["doc_id", "piece", "start", "length", "ids_crc32", "ids"]
            k = 6 if with_ids else 5
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols[:k], types[:k], strict=True)], names[:k])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(run, schema)


def plan_bins(histogram: dict[int, int], max_len: int) -> list[tuple[int, int, int, int, int, int]]:
    """Best-fit decreasing over counts. Rows: length, rank from, rank to, first sequence, pieces a sequence, offset.

    The piece of that length and of rank r in [from, to) goes to sequence first + (r - from) // k, at offset + ((r - from) % k)
    * length.
    """
    rows, rooms, groups, bins = [], [], {}, 0  # rooms: sorted free space; groups: by free space, (first sequence, sequences)

    def put(room: int, first: int, n: int) -> None:
        if n and room:
            if room not in groups:
                bisect.insort(rooms, room)
            groups.setdefault(room, []).append((first, n))

    for length in sorted(histogram, reverse=True):
        left, rank = histogram[length], 0
        while left:
            at = bisect.bisect_left(rooms, length)
            if at < len(rooms):
                room = rooms[at]
                first, n = groups[room].pop()
                if not groups[room]:
                    del groups[room], rooms[at]
            else:
                room, first = max_len, bins
                n = -(-left // (max_len // length))
                bins += n
            k = room // length
            full, rest = divmod(min(left, n * k), k)
            rows.append((length, rank, rank + full * k + rest, first, k, max_len - room))
            put(room - k * length, first, full)
            put(room - rest * length, first + full, 1 if rest else 0)
            put(room, first + full + bool(rest), n - full - bool(rest))
            left -= full * k + rest
            rank += full * k + rest
    return rows


def pack(made: DataFrame, max_len: int, scratch: Scratch) -> DataFrame:
    """Adds sequence_id and offset to a table of pieces. Repeated rows are packed each; an empty table gives none.

    Ranks are counted within (length, salt) and the salts' counts summed up, so a length that many pieces share is spread
    over all tasks.
    """
    spark = made.sparkSession
    salted = made.withColumn("salt", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(partitions(spark))).cast("int"))
    counts = scratch.table(salted.groupBy("length", "salt").agg(F.count("*").alias("n")), "counts")
    histogram = {int(r[0]): int(r[1]) for r in counts.groupBy("length").agg(F.sum("n")).collect()}  # at most max_len rows
    plan = spark.createDataFrame(plan_bins(histogram, max_len), "length long, lo long, hi long, first long, k long, at long")
    before = counts.withColumn("before", F.sum("n").over(Window.partitionBy("length").orderBy("salt")) - F.col("n")).drop("n")
    rank = F.row_number().over(Window.partitionBy("length", "salt").orderBy("doc_id", "piece", "ids_crc32")) - 1
    ranked = salted.withColumn("rank", rank).join(before, ["length", "salt"]).withColumn("rank", F.col("rank") + F.col("before"))
    slots = ranked.join(F.broadcast(plan), "length").filter("rank >= lo and rank < hi")  # the plan's size is bounded by max_len
    step = F.col("rank") - F.col("lo")
    return slots.select(*made.columns, (F.col("first") + F.floor(step / F.col("k"))).cast("long").alias("sequence_id"), (F.col("at") + step % F.col("k") * F.col("length")).cast("long").alias("offset"))


def op1_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Packs the whole table with ``byte_bpe_50k.json`` and end id 0 into sequences of 2048 tokens."""
    with Scratch(spark, "op1") as scratch:
        made = scratch.table(pieces(dealt(read(spark, sf_dir, "documents")), "byte_bpe_50k.json", 0, MAX_LEN), "pieces")
        out = pack(made, MAX_LEN, scratch)
        return scratch.table(out, "slots", keep=True)
