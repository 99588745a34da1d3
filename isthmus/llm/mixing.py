"""Mixing sources to target weights (operator 4).

Each row gets a hash-random key of its id; rows are ranged into buckets by the key's leading bits, sizes are summed per
(source, bucket) and prefix sums over those sums find the one bucket of each source in which its budget ends. Only that bucket
is sorted, and its prefix sums give the row at the cut. A hot source has as many buckets as its rows need.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from isthmus.llm.common import SPACE, Scratch, read

SEED = 20260
#: Rows that a bucket of a source holds at most on average.
BUCKET_ROWS = 20_000
#: Sources whose cuts are broadcast; more are joined by a shuffle.
BROADCAST_SOURCES = 50_000


def n_words(text: Column) -> Column:
    """Words of a text; a null text has none."""
    return F.size(F.filter(F.split(F.coalesce(text, F.lit("")), SPACE + "+"), lambda w: w != "")).cast("long")


def targets(sizes: DataFrame, weights: tuple[int, ...], share: float, cap: float) -> DataFrame:
    """sizes (source, source_size) with target: weights go round the sources in code-point order, null last; the targets are
    share * all sizes, none above cap * its source's size, the excess reshared by weight. One row per source."""
    every = Window.orderBy(F.col("source").asc_nulls_last())
    cycle = F.array(*map(F.lit, weights))
    w = sizes.withColumn("weight", F.element_at(cycle, ((F.row_number().over(every) - 1) % len(weights) + 1).cast("int")).cast("double"))
    w = w.withColumn("cap", F.col("source_size") * F.lit(float(cap))).withColumn("ratio", F.col("cap") / F.col("weight"))
    whole, upto = Window.partitionBy(), Window.orderBy("ratio", F.col("source").asc_nulls_last()).rowsBetween(Window.unboundedPreceding, -1)
    w = w.withColumn("pool", F.sum("source_size").over(whole) * F.lit(float(share)))
    left = F.col("pool") - F.coalesce(F.sum("cap").over(upto), F.lit(0.0))
    w = w.withColumn("capped", F.col("ratio") <= left / (F.sum("weight").over(whole) - F.coalesce(F.sum("weight").over(upto), F.lit(0.0))))
    rest = F.col("pool") - F.coalesce(F.sum(F.when(F.col("capped"), F.col("cap"))).over(whole), F.lit(0.0))
    level = F.try_divide(rest, F.sum(F.when(~F.col("capped"), F.col("weight"))).over(whole))
    return w.select("source", "source_size", F.when(F.col("capped"), F.col("cap")).otherwise(F.col("weight") * level).alias("target"))


def cuts(sized: DataFrame, weights: tuple[int, ...], share: float, cap: float, scratch: Scratch) -> DataFrame:
    """From sized (doc_id, source, size): per source source_size, target, epochs (whole passes) and the cut of the last pass:
    rows before (cut_key, cut_id, cut_size) are taken once more, rows equal to it give cut_words each, later rows nothing."""
    rows = sized.count()
    bits = max(0, math.ceil(math.log2(max(1, rows / BUCKET_ROWS))))
    keyed = sized.withColumn("key", key()).withColumn("bucket", F.shiftrightunsigned("key", 64 - bits) if bits else F.lit(0).cast("long"))
    parts = scratch.table(keyed.groupBy("source", "bucket").agg(F.sum("size").alias("n")), "parts")
    goal = targets(parts.groupBy("source").agg(F.sum("n").alias("source_size")), weights, share, cap)
    goal = goal.withColumn("budget", F.floor(F.col("target") + 1e-9)).withColumn("epochs", F.coalesce(F.try_divide("budget", "source_size").cast("long"), F.lit(0).cast("long")))
    goal = scratch.table(goal.withColumn("rest", F.col("budget") - F.col("epochs") * F.col("source_size")), "goal")
    before = parts.withColumn("before", F.sum("n").over(Window.partitionBy("source").orderBy("bucket")) - F.col("n"))
    g, b = goal.alias("g"), before.alias("b")
    ends = b.join(g, F.expr("g.source <=> b.source")).filter("rest > 0 and before < rest and rest <= before + n").select("b.source", "bucket", "before", "rest")
    k, e = keyed.alias("k"), ends.alias("e")
    inside = k.join(e, F.expr("k.source <=> e.source and k.bucket = e.bucket")).groupBy("k.source", "rest", "before", "key", "doc_id", "size").agg(F.count("*").alias("m"))
    order = Window.partitionBy("source").orderBy("key", F.col("doc_id").asc_nulls_first(), "size")
    inside = inside.withColumn("upto", F.col("before") + F.sum(F.col("size") * F.col("m")).over(order))
    cut = inside.filter("upto >= rest and upto - size * m < rest").select("source", F.col("key").alias("cut_key"), F.col("doc_id").alias("cut_id"), F.col("size").alias("cut_size"), F.expr("(rest - (upto - size * m)) div m").alias("cut_words"))
    g, c = goal.alias("g"), cut.alias("c")
    return scratch.table(g.join(c, F.expr("g.source <=> c.source"), "left").select("g.*", "cut_key", "cut_id", "cut_size", "cut_words"), "cuts", keep=True)


def key() -> Column:
    return F.xxhash64(F.coalesce(F.col("doc_id").cast("long"), F.lit(-1)), F.lit(SEED))


def with_taken(sized: DataFrame, cut: DataFrame) -> DataFrame:
    """Adds source_size, target and taken to every row."""
    few = cut.limit(BROADCAST_SOURCES + 1).count() <= BROADCAST_SOURCES
    s, c = sized.alias("s"), (F.broadcast(cut) if few else cut).alias("c")
    at = lambda k, i, n: F.struct(k, F.coalesce(i.cast("long"), F.lit(-(2**63))).alias("i"), n)  # noqa: E731  null ids first, as in the order above
    mine = at(key(), F.col("s.doc_id"), F.col("s.size"))
    theirs = at(F.col("cut_key"), F.col("cut_id"), F.col("cut_size"))
    more = F.when(F.col("cut_key").isNull(), F.lit(0)).when(mine < theirs, F.col("size")).when(mine == theirs, F.col("cut_words")).otherwise(F.lit(0))
    return s.join(c, F.expr("s.source <=> c.source")).select("s.*", "source_size", "target", (F.col("epochs") * F.col("size") + more).cast("long").alias("taken"))


def mixed_documents(docs: DataFrame, weights: tuple[int, ...], share: float, cap: float, scratch: Scratch) -> DataFrame:
    """The mix itself, with the columns of docs: each document as often as it is taken whole, and once more, cut after its
    last word taken, if its source's budget ends in it. Documents without a word are not in the mix."""
    columns = docs.columns
    base = docs.select(F.struct("*").alias("doc"), F.col("doc_id").cast("long").alias("doc_id"), "source", F.col("text").cast("string").alias("text"))
    sized = base.withColumn("size", n_words(F.col("text")))
    cut = cuts(scratch.table(sized.select("doc_id", "source", "size"), "sized"), weights, share, cap, scratch)
    t = with_taken(sized, cut).filter("taken > 0")
    t = t.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.expr("(taken + size - 1) div size"))))
    part = F.col("taken") - (F.col("copy") - 1) * F.col("size")
    words = F.filter(F.split("text", SPACE + "+"), lambda w: w != "")
    text = F.when(part >= F.col("size"), F.col("text")).otherwise(F.array_join(F.slice(words, F.lit(1), F.least(part, F.col("size")).cast("int")), " "))
    return t.select(*(text.alias(c) if c == "text" else F.col("doc").getField(c).alias(c) for c in columns))


def op4_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weights 3, 1, 2 round the sources, 150 % of all sizes, at most twice a source. A null source is a source, the last;
    a null text has size 0; rows equal in id and size share what is left at a cut."""
    with Scratch(spark, "op4") as scratch:
        docs = read(spark, sf_dir, "documents")
        sized = scratch.table(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "source", n_words(F.col("text")).alias("size")), "sized", keep=True)
        return with_taken(sized, cuts(sized, (3, 1, 2), 1.5, 2.0, scratch)).select("doc_id", "size", "source_size", "target", "taken", "source")
