"""A corpus in five stages: quality rules, near-duplicate join, substring dedup, source mix, packing.

Each stage works on all rows that the stage before kept, written as Parquet and read again. All but the last return the columns of
documents; the last returns the pieces and their places in sequences.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from isthmus.llm.common import Scratch, drop_kept, read
from isthmus.llm.mixing import mixed_documents
from isthmus.llm.ngram_join import representatives
from isthmus.llm.packing import MAX_LEN, pack, pieces
from isthmus.llm.quality import kept_documents
from isthmus.llm.substring import WINDOW, without_repeats


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rules reject go."""
    with Scratch(spark, "quality") as scratch:
        return kept_documents(docs, read(spark, sf_dir, "labels"), scratch)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of texts alike by 0.8 or more in shingles of five words stays."""
    with Scratch(spark, "near") as scratch:
        return representatives(docs, 5, 80, 100, scratch)


def passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages of 13 words or more that a document of a smaller id holds are cut out."""
    with Scratch(spark, "passages") as scratch:
        return without_repeats(docs, WINDOW, scratch)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources in turn weigh 3, 1 and 2 and give 1.5 times all words, none more than twice its own."""
    with Scratch(spark, "mix") as scratch:
        return mixed_documents(docs, (3, 1, 2), 1.5, 2.0, scratch)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces and their places in sequences of 2048."""
    with Scratch(spark, "packed") as scratch:
        made = scratch.table(pieces(docs, "byte_bpe_50k.json", 0, MAX_LEN), "pieces")
        return scratch.table(pack(made, MAX_LEN, scratch), "slots", keep=True)


STAGES = [("quality_rules", quality), ("ngram_jaccard_join", near_copies), ("substring_dedup", passages), ("source_mix", mix), ("best_fit_packing", packed)]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on ``documents`` of sf_dir. What a stage kept for its result is deleted once the result is written."""
    with Scratch(spark, "pipeline") as scratch:
        docs = read(spark, sf_dir, "documents")
        for i, (name, stage) in enumerate(STAGES):
            since = len(Scratch.left)
            docs = scratch.table(stage(spark, docs, sf_dir), name, keep=i == len(STAGES) - 1)
            drop_kept(spark, since)
        return docs
