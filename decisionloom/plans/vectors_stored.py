"""Vectors from a cache that grows, and a store read by pages; and the SQL that repeats them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from decisionloom.functions import ids
from decisionloom.plans.tables import table
from decisionloom.sources import cache, folders, pages

#: Tokens that are seen of a document with a label, and of others.
FULL, SHORT = 8192, 2048
MODEL = "letters"


def _letters(batches: DataFrame) -> DataFrame:
    """In place of a model: the direction of a text's counts of four letters."""
    counts = F.array(*[(F.length("text") - F.length(F.replace("text", F.lit(x), F.lit("")))).cast("double") for x in "etao"])
    return batches.select("key", ids.normalised(counts).alias("vector"))


def embed_cache_growth(spark, d) -> DataFrame:
    """Three runs over one store: documents with a label, all documents, all again; what each found, embedded, in how many batches, and the vectors then there."""
    labelled = table(spark, d, "labels").select("doc_id", F.lit(FULL).alias("full")).distinct()
    docs = table(spark, d, "documents").join(labelled, "doc_id", "left").select(F.col("doc_id").alias("id"), F.coalesce("text", F.lit("")).alias("text"), F.coalesce("full", F.lit(SHORT)).alias("ceiling"))
    path, out = folders.shared_folder(spark, "vectors"), None
    for run, rows in enumerate((docs.filter(F.col("ceiling") == FULL), docs, docs), 1):
        vectors, report = cache.embedded(rows, path, MODEL, _letters)
        there = vectors.agg(F.count("vector").alias("vectors"), F.countDistinct("key").alias("keys"))
        one = report.crossJoin(there).select(F.lit(run).alias("run"), "*")
        out = one if out is None else out.unionByName(one)
    return out


GROWTH = f"""WITH t AS (SELECT doc_id, coalesce(text, '') AS text, CASE WHEN doc_id IN (SELECT doc_id FROM labels) THEN {FULL} ELSE {SHORT} END AS c FROM documents),
k AS (SELECT *, sha256('{MODEL}|' || c || '|' || text) AS k, least(greatest(ceil(length(text) / 4.11), 1), c) AS n FROM t),
p AS (SELECT *, CAST(ceil(n / 64) * 64 AS BIGINT) AS pad FROM k), f AS (SELECT DISTINCT k FROM p WHERE c = {FULL}),
r AS (SELECT 1 AS run, *, false AS hit FROM p WHERE c = {FULL} UNION ALL SELECT 2, *, k IN (SELECT k FROM f) FROM p UNION ALL SELECT 3, *, true FROM p),
m AS (SELECT DISTINCT run, k, c, pad, greatest(1500000000 // (64 * pad * pad), 1) AS cap FROM r WHERE NOT hit),
b AS (SELECT run, pad, cap, count(*) AS n FROM m GROUP BY run, pad, cap, c, left(k, 1)),
x AS (SELECT run, CAST(sum(n) AS BIGINT) AS misses, CAST(sum((n + cap - 1) // cap) AS BIGINT) AS batches, CAST(max(least(n, cap) * pad * pad * 64) AS BIGINT) AS peak FROM b GROUP BY run)
SELECT CAST(r.run AS INTEGER) AS run, count(*) AS texts, count(*) FILTER (hit) AS hits, coalesce(any_value(misses), 0) AS misses, coalesce(any_value(batches), 0) AS batches, coalesce(any_value(peak), 0) AS peak, count(*) AS vectors, count(DISTINCT k) AS keys
FROM r LEFT JOIN x ON x.run = r.run GROUP BY r.run"""


def paged_scan(spark, d) -> DataFrame:
    """Points of the even labels from two on, read by pages: how many, and their least and largest number."""
    rows = pages.scan(spark, f"{d}/embeddings.parquet", ["vec_id", "label"]).filter((F.col("label") >= 2) & (F.col("label") % 2 == 0))
    return rows.groupBy("label").agg(F.count("*").alias("points"), F.min("vec_id").alias("least"), F.max("vec_id").alias("largest"))


PAGED = "SELECT label, count(*) AS points, min(vec_id) AS least, max(vec_id) AS largest FROM embeddings WHERE label >= 2 AND label % 2 = 0 GROUP BY label"

QUERIES = {f.__name__: f for f in (embed_cache_growth, paged_scan)}
ORACLE_SQL = {"embed_cache_growth": GROWTH, "paged_scan": PAGED}
