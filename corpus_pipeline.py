"""From documents to packed training sequences: five stages, each written as Parquet and read again.

Cases, for every stage: null and empty texts are scored like a text without words and stay, have no
near copies and no repeats, weigh nothing in the mix (a source's whole repetitions keep them) and
are packed as an end token; a null id is a document like others; rows that repeat an id and a text
are one to the stages that drop or change documents; empty tables give empty tables; columns of any
name go through all stages but the last, which returns pieces.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from decisionloom.llm import minhash, mixing, packing, substrings, toxicity
from decisionloom.llm.common import release, stash, table


#: Similarity of word shingles in per cent from which documents are near copies.
NEAR = 80


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity stays below the threshold of their language."""
    return toxicity.keep_clean(docs, table(spark, sf_dir, "labels"))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates."""
    return minhash.keep_one(docs, NEAR)


def drop_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the passages that stand earlier in the corpus."""
    return substrings.remove_repeats(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources at their target weights: documents repeated, left out or cut."""
    return mixing.mix_documents(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents and their places in sequences."""
    return packing.pack(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("minhash_neardup", drop_near_copies),
    ("substring_dedup", drop_repeated_passages),
    ("mixing", mix),
    ("packing", pack),
]

#: The stages train a model, and cut and pack texts: beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in turn; a stage's table is deleted when the next one's is written.  Empty tables and null texts go through every stage."""
    docs, last = table(spark, sf_dir, "documents"), None
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = stash(docs)
            if last is not None:
                release(last)
            last = docs
    return docs
