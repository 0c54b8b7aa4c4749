"""Token counts by an exact histogram of encoded lengths.

Documents are aggregated by their number of tokens, on the map side first, so what is shuffled is
a row per length.  Sums over all lengths from one on (suffix sums) then answer, for every context
limit that equals a length: how many documents reach it, how many tokens a cut there keeps, and
where the limit stands among the quantiles.  Limits between two lengths follow from the next
larger one, since nothing happens between them.  Suffix sums run inside ranges of lengths, and
over the ranges' totals, so no sort is in one task.

Cases: null and empty texts have length 0 and count as documents; repeated rows count each; an
empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from decisionloom.llm.common import by_value, settled, stash, table
from decisionloom.llm.packing import Ids, default_tokenizer

by_value(__name__)

RANGE = 1024


def lengths(docs: DataFrame, path: str | None = None) -> DataFrame:
    """docs(text) -> n_tokens of every whole text."""
    path = path or default_tokenizer()

    def run(batches):
        ids = Ids(path)
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([len(ids(x.as_py() or b"")) // 4 for x in batch.column(0)], pa.int64())], names=["n_tokens"])

    return docs.select(F.col("text").cast("binary")).mapInArrow(run, "n_tokens long")


def histogram(docs: DataFrame, path: str | None = None) -> DataFrame:
    """n_tokens, n_docs."""
    return lengths(docs, path).groupBy("n_tokens").agg(F.count("*").alias("n_docs"))


def suffix_sums(hist: DataFrame) -> DataFrame:
    """hist(n_tokens, n_docs) -> + docs_reaching, tokens_reaching (of documents that long or longer), tokens_kept (all documents cut at that length), quantile (share of documents that are no longer)."""
    rows = stash(hist.withColumn("_r", F.floor(F.col("n_tokens") / RANGE)).withColumn("_t", F.col("n_tokens") * F.col("n_docs")))
    inside = Window.partitionBy("_r").orderBy(F.desc("n_tokens")).rowsBetween(Window.unboundedPreceding, 0)
    above = Window.orderBy(F.desc("_r")).rowsBetween(Window.unboundedPreceding, -1)
    ranges = rows.groupBy("_r").agg(F.sum("n_docs").alias("_d"), F.sum("_t").alias("_s"))
    ranges = ranges.select("_r", F.coalesce(F.sum("_d").over(above), F.lit(0)).alias("_docs"), F.coalesce(F.sum("_s").over(above), F.lit(0)).alias("_tokens"))  # a row per range
    total = rows.agg(F.sum("n_docs").alias("_all"), F.sum("_t").alias("_sum"))
    docs, tokens = F.sum("n_docs").over(inside) + F.col("_docs"), F.sum("_t").over(inside) + F.col("_tokens")
    out = rows.join(ranges, "_r").crossJoin(total).withColumn("docs_reaching", docs).withColumn("tokens_reaching", tokens)
    kept = F.col("_sum") - F.col("tokens_reaching") + F.col("n_tokens") * F.col("docs_reaching")
    share = (F.col("_all") - F.col("docs_reaching") + F.col("n_docs")) / F.col("_all")
    return out.select("n_tokens", "n_docs", "docs_reaching", "tokens_reaching", kept.alias("tokens_kept"), share.alias("quantile"))


def answer(sums: DataFrame, limit: int) -> DataFrame:
    """For a context limit: documents, tokens, documents longer than the limit and tokens that a cut there keeps."""
    longer = F.col("n_tokens") > limit
    return sums.agg(
        F.sum("n_docs").alias("documents"), F.sum(F.col("n_tokens") * F.col("n_docs")).alias("tokens"), F.coalesce(F.sum(F.when(longer, F.col("n_docs"))), F.lit(0)).alias("longer"),
        F.sum(F.least("n_tokens", F.lit(limit)) * F.col("n_docs")).alias("kept"),
    )


def at_quantile(sums: DataFrame, share: float) -> DataFrame:
    """The least length that at least this share of documents doesn't pass."""
    return sums.filter(F.col("quantile") >= share).agg(F.min("n_tokens").alias("n_tokens"))


def op3_token_counts(spark, sf_dir: str) -> DataFrame:
    return settled(lambda: suffix_sums(histogram(table(spark, sf_dir, "documents"))))
