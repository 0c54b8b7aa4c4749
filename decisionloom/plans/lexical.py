"""Queries of lexical retrieval and its evaluation, and the SQL that repeats them."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from decisionloom.functions import ids, text, vocab
from decisionloom.operators import lexical as L
from decisionloom.operators import patterns
from decisionloom.plans.tables import table

STOP = {"stop": vocab.ALL_STOPWORDS}
_STOP = ", ".join(f"'{w}'" for w in vocab.ALL_STOPWORDS)


def tok(column: str) -> str:
    """SQL of the tokens of a column."""
    return f"list_filter(regexp_extract_all(lower({column}), '{vocab.TOKEN}'), lambda x: length(x) > 1 AND x NOT IN ({_STOP}))"


def bm25_sql(units: str, unit: str, queries: str, query: str, pool: str = "") -> str:
    """CTEs that end in scores(query, unit, [pool,] score); units and queries are relations with a text column."""
    p = f"{pool}, " if pool else ""
    using = f"({p}term)" if pool else "(term)"
    total = f"JOIN total USING ({pool})" if pool else "CROSS JOIN total"
    return f"""
units AS (SELECT {p}{unit}, {tok("text")} AS w FROM {units}),
post AS (SELECT {p}{unit}, len(w) AS dl, unnest(w) AS term FROM units),
tf AS (SELECT {p}{unit}, dl, term, count(*) AS tf FROM post GROUP BY ALL),
df AS (SELECT {p}term, count(*) AS df FROM tf GROUP BY ALL),
total AS (SELECT {p}count(*) AS n, avg(len(w)) AS avgdl FROM units {f"GROUP BY {pool}" if pool else ""}),
asked AS (SELECT DISTINCT {p}{query}, term FROM (SELECT {p}{query}, unnest({tok("text")}) AS term FROM {queries})),
scores AS (SELECT {query}, {unit}, {p}round(sum(ln(1 + (n - df + 0.5) / (df + 0.5)) * tf * 2.5 / (tf + 1.5 * (0.25 + 0.75 * dl / avgdl))), 6) AS score
  FROM tf JOIN asked USING {using} JOIN df USING {using} {total} GROUP BY ALL)"""


def bm25_topk(spark: SparkSession, d: str) -> DataFrame:
    scores = L.bm25(table(spark, d, "documents"), table(spark, d, "benchmark"), "doc_id", "item_id", options=STOP)
    return L.ranked(scores, "item_id", "doc_id", 3).select("item_id", "doc_id", "score", "rank")


BM25_TOPK = f"""WITH {bm25_sql("documents", "doc_id", "benchmark", "item_id")}
SELECT item_id, doc_id, score, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM scores QUALIFY rank <= 3"""


def bm25_corpus_stats(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents")
    terms = text.tokens(F.col("text"), **STOP)
    post = L.postings(docs, terms, ["doc_id"])
    n = L.statistics(docs, terms, [])
    out = post.groupBy("term").agg(F.count("*").alias("df"), F.sum("tf").alias("cf")).crossJoin(n)
    return out.select("term", "df", "cf", F.round(L.inverse_frequency(F.col("n"), F.col("df")), 6).alias("idf"), F.round("avgdl", 6).alias("avgdl"))


BM25_STATS = f"""WITH u AS (SELECT doc_id, {tok("text")} AS w FROM documents),
t AS (SELECT doc_id, term, count(*) AS tf FROM (SELECT doc_id, unnest(w) AS term FROM u) GROUP BY ALL),
n AS (SELECT count(*) AS n, avg(len(w)) AS avgdl FROM u)
SELECT term, count(*) AS df, CAST(sum(tf) AS BIGINT) AS cf, round(ln(1 + (any_value(n) - count(*) + 0.5) / (count(*) + 0.5)), 6) AS idf, round(any_value(avgdl), 6) AS avgdl
FROM t CROSS JOIN n GROUP BY term"""


def bm25_filtered_pool(spark: SparkSession, d: str) -> DataFrame:
    """Each item searched inside each source, whose statistics are its own."""
    docs = table(spark, d, "documents").select("source", "doc_id", "text")
    asked = table(spark, d, "benchmark").crossJoin(docs.select("source").distinct())
    scores = L.bm25(docs, asked, "doc_id", "item_id", ["source"], STOP)
    order = Window.partitionBy("item_id", "source").orderBy(F.desc("score"), "doc_id")
    return scores.withColumn("rank", F.row_number().over(order).cast("long")).filter("rank <= 2").select("item_id", "source", "doc_id", "score", "rank")


BM25_POOL = f"""WITH {bm25_sql("documents", "doc_id", "(SELECT * FROM benchmark CROSS JOIN (SELECT DISTINCT source FROM documents))", "item_id", "source")}
SELECT item_id, source, doc_id, score, row_number() OVER (PARTITION BY item_id, source ORDER BY score DESC, doc_id) AS rank FROM scores QUALIFY rank <= 2"""


def distinctive_terms(spark: SparkSession, d: str) -> DataFrame:
    return L.distinctive(table(spark, d, "documents"), table(spark, d, "benchmark"), "doc_id", "item_id")


_T = f"list_filter(regexp_extract_all(lower(text), '{vocab.TOKEN}'), lambda x: length(x) > 1)"
DISTINCTIVE = f"""WITH q AS (SELECT DISTINCT item_id, term FROM (SELECT item_id, unnest({_T}) AS term FROM benchmark)),
f AS (SELECT term, count(DISTINCT doc_id) AS df FROM (SELECT doc_id, unnest({_T}) AS term FROM documents) GROUP BY term)
SELECT item_id, term, coalesce(df, 0) AS df, coalesce(df, 0) > 0 AND 2 * coalesce(df, 0) < (SELECT count(*) FROM documents) AS distinctive
FROM q LEFT JOIN f USING (term)"""


def guarded_search_silence(spark: SparkSession, d: str) -> DataFrame:
    """Top document of each item, kept only with a distinctive term; the verdict on silence."""
    docs, items = table(spark, d, "documents"), table(spark, d, "benchmark")
    counts = L.term_counts(docs, L.asked_terms(items), ["doc_id"], STOP)
    scores = L.ranked(L.bm25(docs, items, "doc_id", "item_id", options=STOP, counts=counts), "item_id", "doc_id", 1)
    guard = L.distinctive(docs, items, "doc_id", "item_id", counts=counts).filter("distinctive").select("item_id", F.col("term").alias("hit"))
    held = counts.join(scores.select("item_id", "doc_id"), "doc_id").join(guard, ["item_id", "hit"], "left_semi").groupBy("item_id").agg(F.count("*").alias("matched"))
    out = items.select("item_id").join(scores.select("item_id", "doc_id", "score"), "item_id", "left").join(held, "item_id", "left")
    matched = F.coalesce("matched", F.lit(0))
    verdict = F.when(F.coalesce("score", F.lit(0.0)) <= 0, "SILENT").when(matched > 0, "PASS").otherwise("WARN")
    return out.select("item_id", "doc_id", "score", matched.alias("matched"), verdict.alias("verdict"))


GUARDED = f"""WITH {bm25_sql("documents", "doc_id", "benchmark", "item_id")},
top AS (SELECT item_id, doc_id, score FROM scores QUALIFY row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) = 1),
g AS (SELECT item_id, term FROM ({DISTINCTIVE}) WHERE distinctive),
dt AS (SELECT DISTINCT doc_id, term FROM (SELECT doc_id, unnest({_T}) AS term FROM documents)),
m AS (SELECT item_id, count(*) AS matched FROM top JOIN dt USING (doc_id) JOIN g USING (item_id, term) GROUP BY item_id)
SELECT b.item_id, doc_id, score, coalesce(matched, 0) AS matched,
  CASE WHEN coalesce(score, 0) <= 0 THEN 'SILENT' WHEN coalesce(matched, 0) > 0 THEN 'PASS' ELSE 'WARN' END AS verdict
FROM benchmark b LEFT JOIN top USING (item_id) LEFT JOIN m USING (item_id)"""


def doc_rank_from_unit_rank(spark: SparkSession, d: str) -> DataFrame:
    """Conversations by their best turn."""
    turns = table(spark, d, "conversations").withColumn("unit", F.col("conv_id") * 1000 + F.col("turn"))
    ranks = L.ranked(L.bm25(turns, table(spark, d, "benchmark"), "unit", "item_id", options=STOP), "item_id", "unit")
    ranks = ranks.withColumn("conv_id", F.expr("unit div 1000"))
    return L.unit_to_document(ranks, "item_id", "conv_id").filter("rank <= 5")


DOC_RANK = f"""WITH {bm25_sql("(SELECT conv_id * 1000 + turn AS unit, text FROM conversations)", "unit", "benchmark", "item_id")},
r AS (SELECT item_id, unit // 1000 AS conv_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, unit) AS rank FROM scores),
b AS (SELECT item_id, conv_id, min(rank) AS best FROM r GROUP BY ALL)
SELECT item_id, conv_id, best, row_number() OVER (PARTITION BY item_id ORDER BY best, conv_id) AS rank FROM b QUALIFY rank <= 5"""


def rrf_fusion(spark: SparkSession, d: str) -> DataFrame:
    """BM25 with stop words and without, fused."""
    docs, items = table(spark, d, "documents"), table(spark, d, "benchmark")
    counts = L.term_counts(docs, L.asked_terms(items), ["doc_id"], STOP)  # once for both
    one, two = (L.ranked(L.bm25(docs, items, "doc_id", "item_id", options=o, counts=counts, length=n), "item_id", "doc_id", 10) for o, n in ((STOP, "dl"), ({}, "all_dl")))
    return L.fuse(one, two, "item_id", "doc_id").filter("rank <= 10").select("item_id", "doc_id", "rrf", "source", "rank")


_LISTS = bm25_sql("documents", "doc_id", "benchmark", "item_id")
_PLAIN = re.sub(r"\b(units|post|tf|df|total|asked|scores)\b(?= AS \()|(?<=FROM )(units|post|tf)\b|(?<=JOIN )(asked|df|total)\b", lambda m: f"{m[0]}2", _LISTS.replace(tok("text"), _T))
RRF = f"""WITH {_LISTS}, {_PLAIN},
a AS (SELECT item_id, doc_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM scores QUALIFY rank <= 10),
b AS (SELECT item_id, doc_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM scores2 QUALIFY rank <= 10),
f AS (SELECT coalesce(a.item_id, b.item_id) AS item_id, coalesce(a.doc_id, b.doc_id) AS doc_id, round(coalesce(1.0 / (60 + a.rank), 0) + coalesce(1.0 / (60 + b.rank), 0), 9) AS rrf,
  CASE WHEN b.rank IS NULL THEN 'lexical' WHEN a.rank IS NULL THEN 'vector' ELSE 'both' END AS source, a.rank AS ra, b.rank AS rb
  FROM a FULL JOIN b ON a.item_id = b.item_id AND a.doc_id = b.doc_id)
SELECT item_id, doc_id, CAST(rrf AS DOUBLE) AS rrf, source, row_number() OVER (PARTITION BY item_id ORDER BY rrf DESC, ra NULLS LAST, rb NULLS LAST, doc_id) AS rank FROM f QUALIFY rank <= 10"""


def retrieval_summary(spark: SparkSession, d: str) -> DataFrame:
    """Top-1, top-5, mean reciprocal rank and never found, where a document that quotes the item is right."""
    docs, items = table(spark, d, "documents"), table(spark, d, "benchmark")
    right = L.quoting(items, docs, "item_id", "doc_id")
    ranks = L.ranked(L.bm25(docs, items, "doc_id", "item_id", options=STOP), "item_id", "doc_id").select("item_id", "doc_id", "rank")
    first = ranks.join(right, ["item_id", "doc_id"]).groupBy("item_id").agg(F.min("rank").alias("first"))
    rows = right.select("item_id").distinct().join(first, "item_id", "left")
    return rows.agg(F.count("*").alias("queries"), F.count_if(F.col("first") == 1).alias("top1"), F.count_if(F.col("first") <= 5).alias("top5"), F.round(F.sum(F.coalesce(1 / F.col("first"), F.lit(0.0))) / F.count("*"), 6).alias("mrr"), F.count_if(F.col("first").isNull()).alias("never"))


SUMMARY = f"""WITH {_LISTS},
r AS (SELECT item_id, doc_id FROM benchmark b JOIN documents d ON contains(d.text, b.text)),
k AS (SELECT item_id, doc_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM scores),
f AS (SELECT item_id, min(rank) AS first FROM k JOIN r USING (item_id, doc_id) GROUP BY item_id),
x AS (SELECT item_id, first FROM (SELECT DISTINCT item_id FROM r) LEFT JOIN f USING (item_id))
SELECT count(*) AS queries, count(*) FILTER (first = 1) AS top1, count(*) FILTER (first <= 5) AS top5, round(sum(coalesce(1.0 / first, 0)) / count(*), 6) AS mrr, count(*) FILTER (first IS NULL) AS never FROM x"""


def ngram_leakage(spark: SparkSession, d: str) -> DataFrame:
    """Items whose word 5-grams stand in documents: pairs, shared 5-grams, and the share of the item's words that the document has."""
    docs, items = table(spark, d, "documents"), table(spark, d, "benchmark")
    words = text.tokens(F.col("text"), least=1)
    grams = lambda df, key: df.select(key, words.alias("_w")).select(key, F.explode(text.ngrams(F.col("_w"), 5)).alias("gram"))
    shared = grams(items, "item_id").join(grams(docs, "doc_id"), "gram").groupBy("item_id", "doc_id").agg(F.count("*").alias("shared"))
    own = items.select("item_id", F.array_distinct(words).alias("q"))
    body = docs.select("doc_id", F.array_distinct(words).alias("b"))
    out = shared.join(own, "item_id").join(body, "doc_id")
    return out.select("item_id", "doc_id", "shared", F.round(F.size(F.array_intersect("q", "b")) / F.size("q"), 6).alias("overlap"))


_W = f"regexp_extract_all(lower(text), '{vocab.TOKEN}')"
_G = "SELECT DISTINCT {k}, array_to_string(w[i:i+4], ' ') AS gram FROM (SELECT {k}, w, unnest(range(1, len(w) - 3)) AS i FROM {t})"
LEAKAGE = f"""WITH d AS (SELECT doc_id, {_W} AS w FROM documents), b AS (SELECT item_id, {_W} AS w FROM benchmark),
dg AS ({_G.format(k="doc_id", t="d")}), bg AS ({_G.format(k="item_id", t="b")}),
s AS (SELECT item_id, doc_id, count(*) AS shared FROM bg JOIN dg USING (gram) GROUP BY ALL)
SELECT item_id, doc_id, shared, round(len(list_intersect(list_distinct(b.w), list_distinct(d.w))) / len(list_distinct(b.w)), 6) AS overlap
FROM s JOIN b USING (item_id) JOIN d USING (doc_id)"""


def topic_ground_truth(spark: SparkSession, d: str) -> DataFrame:
    """Documents that hold one of an item's three longest terms, and how many sources they come from."""
    items, docs = table(spark, d, "benchmark"), table(spark, d, "documents")
    terms = F.array_distinct(text.tokens(F.col("text"), **STOP))
    order = Window.partitionBy("item_id").orderBy(F.desc(F.length("term")), "term")
    chosen = items.select("item_id", F.explode(terms).alias("term")).withColumn("r", F.row_number().over(order)).filter("r <= 3")
    held = patterns.holding(docs.select("doc_id", "source", F.lower("text").alias("body")), chosen.select("item_id", "term"), "doc_id", "body", "term")
    hits = held.select("item_id", "doc_id").distinct().join(docs.select("doc_id", "source"), "doc_id")
    return items.select("item_id").join(hits, "item_id", "left").groupBy("item_id").agg(F.count("doc_id").alias("documents"), F.countDistinct("source").alias("sources"))


TOPIC = f"""WITH t AS (SELECT DISTINCT item_id, term FROM (SELECT item_id, unnest({tok("text")}) AS term FROM benchmark)),
c AS (SELECT * FROM t QUALIFY row_number() OVER (PARTITION BY item_id ORDER BY length(term) DESC, term) <= 3),
h AS (SELECT DISTINCT item_id, doc_id, source FROM c JOIN documents ON contains(lower(text), term))
SELECT item_id, count(doc_id) AS documents, count(DISTINCT source) AS sources FROM benchmark LEFT JOIN h USING (item_id) GROUP BY item_id"""


def language_detect(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents")
    return docs.groupBy("lang", text.main_language(F.col("text")).alias("detected")).agg(F.count("*").alias("documents"))


def _share(lang: str) -> str:
    listed = ", ".join(f"'{w}'" for w in vocab.STOPWORDS[lang])
    return f"len(list_filter(w, lambda x: x IN ({listed}))) / greatest(len(w), 1)"


LANGUAGE = f"""WITH s AS (SELECT lang, {", ".join(f"{_share(x)} AS {x}" for x in vocab.STOPWORDS)} FROM (SELECT lang, {_W} AS w FROM documents)),
b AS (SELECT *, greatest({", ".join(vocab.STOPWORDS)}) AS best FROM s)
SELECT lang, CASE WHEN best < 0.02 THEN NULL {" ".join(f"WHEN {x} = best THEN '{x}'" for x in vocab.STOPWORDS)} END AS detected, count(*) AS documents FROM b GROUP BY ALL"""


def hit_probability(spark: SparkSession, d: str) -> DataFrame:
    """Chance that 1, 3 or 5 documents, drawn from those with a quality label, hold a toxic one."""
    pools = table(spark, d, "labels").groupBy("quality").agg(F.count("*").alias("pool"), F.count_if(F.col("toxic") == 1).alias("accepted"))
    rows = pools.withColumn("k", F.explode(F.array(*[F.lit(k).cast("long") for k in (1, 3, 5)])))
    return rows.select("quality", "pool", "accepted", "k", F.round(ids.hit_probability(F.col("pool"), F.col("accepted"), F.col("k")), 6).alias("chance"))


HIT = """WITH p AS (SELECT quality, count(*) AS pool, count(*) FILTER (toxic = 1) AS accepted FROM labels GROUP BY quality),
r AS (SELECT *, CAST(unnest([1, 3, 5]) AS BIGINT) AS k FROM p)
SELECT quality, pool, accepted, k, round(CASE WHEN k >= pool THEN CASE WHEN accepted > 0 THEN 1.0 ELSE 0.0 END
  ELSE 1 - list_reduce(list_transform(range(0, k), lambda i: greatest(pool - accepted - i, 0) / (pool - i)), lambda x, y: x * y, 1.0) END, 6) AS chance FROM r"""

QUERIES = {
    "bm25_topk": bm25_topk,
    "bm25_corpus_stats": bm25_corpus_stats,
    "bm25_filtered_pool": bm25_filtered_pool,
    "distinctive_terms": distinctive_terms,
    "guarded_search_silence": guarded_search_silence,
    "doc_rank_from_unit_rank": doc_rank_from_unit_rank,
    "rrf_fusion": rrf_fusion,
    "retrieval_summary": retrieval_summary,
    "ngram_leakage": ngram_leakage,
    "topic_ground_truth": topic_ground_truth,
    "language_detect": language_detect,
    "hit_probability": hit_probability,
}
ORACLE_SQL = {
    "bm25_topk": BM25_TOPK,
    "bm25_corpus_stats": BM25_STATS,
    "bm25_filtered_pool": BM25_POOL,
    "distinctive_terms": DISTINCTIVE,
    "guarded_search_silence": GUARDED,
    "doc_rank_from_unit_rank": DOC_RANK,
    "rrf_fusion": RRF,
    "retrieval_summary": SUMMARY,
    "ngram_leakage": LEAKAGE,
    "topic_ground_truth": TOPIC,
    "language_detect": LANGUAGE,
    "hit_probability": HIT,
}
