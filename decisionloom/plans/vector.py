"""Queries of vector retrieval and the SQL that repeats them.  Queries are the vectors whose id is divisible by 100."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from decisionloom.functions import ids
from decisionloom.operators import vector as V
from decisionloom.plans.tables import table


def points(spark: SparkSession, d: str) -> DataFrame:
    """Vectors as points: id, parent, unit, year, role."""
    e = table(spark, d, "embeddings")
    return e.select(F.col("vec_id").alias("id"), (F.col("vec_id") + 1_000_000).alias("parent"), F.col("label").cast("long").alias("role"), (2014 + F.col("vec_id") % 12).cast("int").alias("year"), F.col("embedding").alias("vector"))


def asked(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "embeddings").filter("vec_id % 100 = 0").select(F.col("vec_id").alias("query_id"), F.col("embedding").alias("vector"))


_SIMS = """p AS (SELECT vec_id AS id, vec_id + 1000000 AS parent, CAST(label AS BIGINT) AS role, CAST(2014 + vec_id % 12 AS INTEGER) AS year, CAST(embedding AS DOUBLE[]) AS v FROM embeddings),
s AS (SELECT q.id AS query_id, p.id, p.parent, p.role, p.year, round(list_dot_product(q.v, p.v), 6) AS score FROM p CROSS JOIN p q WHERE q.id % 100 = 0)"""
_RANK = "row_number() OVER (PARTITION BY query_id ORDER BY score DESC, id)"


def vector_topk(spark, d):
    return V.top_k(V.nearest(points(spark, d), asked(spark, d), 10), 10).select("query_id", "id", "score", "rank")


VECTOR_TOPK = f"WITH {_SIMS} SELECT query_id, id, score, {_RANK} AS rank FROM s QUALIFY rank <= 10"


def vector_filtered_topk(spark, d):
    keep = V.build_filter({"role": [1, 3, 5], "year_from": 2015, "year_to": 2024, "chamber": "none"})
    return V.top_k(V.nearest(points(spark, d).filter(keep), asked(spark, d), 10), 10).select("query_id", "id", "role", "score", "rank")


FILTERED = f"WITH {_SIMS} SELECT query_id, id, role, score, {_RANK} AS rank FROM s WHERE role IN (1, 3, 5) AND year > 2015 AND year < 2024 QUALIFY rank <= 10"


def two_bucket_search(spark, d):
    recent, older = V.bucket_limits(1)
    p = points(spark, d).filter("year IS NOT NULL").withColumn("bucket", V.bucket("year", 2023))
    return V.two_buckets(V.nearest(p, asked(spark, d), max(recent, older), ["bucket"]), "year", 2023, recent, older).select("query_id", "bucket", "id", "score", "rank")


BUCKETS = f"""WITH {_SIMS}, b AS (SELECT *, CASE WHEN year >= 2023 THEN 'recent' ELSE 'older' END AS bucket FROM s)
SELECT query_id, bucket, id, score, row_number() OVER (PARTITION BY query_id, bucket ORDER BY score DESC, id) AS rank FROM b QUALIFY rank <= CASE bucket WHEN 'recent' THEN 10 ELSE 5 END"""


def freshness_rescale(spark, d):
    o = table(spark, d, "orders")
    year = F.year("o_orderdate")
    return o.select("o_orderkey", year.alias("year"), F.round(ids.freshness(year, 1998), 9).alias("multiplier"), F.round(F.col("o_totalprice") * ids.freshness(year, 1998), 4).alias("rescaled"))


FRESHNESS = """WITH o AS (SELECT *, CAST(year(o_orderdate) AS INTEGER) AS year FROM orders),
m AS (SELECT *, CASE WHEN year >= 1998 THEN 1 + 0.25 * (year - 1998) ELSE pow(0.1, (1998 - year) / 3) END AS f FROM o)
SELECT o_orderkey, year, CAST(round(f, 9) AS DOUBLE) AS multiplier, CAST(round(o_totalprice * f, 4) AS DOUBLE) AS rescaled FROM m"""


def collapse_best_per_key(spark, d):
    sims = V.nearest(points(spark, d), asked(spark, d), 3, ["role"])
    one, three = (V.collapsed(sims, F.col("role"), n).withColumn("per_key", F.lit(n)) for n in (1, 3))
    return one.unionByName(three).select("query_id", "role", "per_key", "id", "score")


COLLAPSE = f"""WITH {_SIMS}, r AS (SELECT *, row_number() OVER (PARTITION BY query_id, role ORDER BY score DESC, id) AS n FROM s)
SELECT query_id, role, CAST(k AS INTEGER) AS per_key, id, score FROM r, (VALUES (1), (3)) t(k) WHERE n <= k"""


def units(spark, d):
    """Texts by id: labelled documents under their own; every document under its parent's."""
    docs, labelled = table(spark, d, "documents"), table(spark, d, "labels").select("doc_id")
    own = docs.join(labelled, "doc_id", "left_semi").select(F.col("doc_id").alias("id"), F.lit(None).cast("long").alias("parent"), F.lit("chunk").alias("unit"), "text")
    whole = docs.select((F.col("doc_id") + 2_000_000).alias("id"), (F.col("doc_id") + 1_000_000).alias("parent"), F.lit("document").alias("unit"), "text")
    return own.unionByName(whole)


_STORE = """st AS (SELECT doc_id AS id, text FROM documents SEMI JOIN labels USING (doc_id) UNION ALL SELECT doc_id + 2000000, text FROM documents UNION ALL SELECT doc_id + 1000000, text FROM documents)"""


def hydrate_fallback(spark, d):
    store = V.text_store(units(spark, d))
    p = points(spark, d).select("id", "parent")
    flag = lambda on: V.hydrated(p, store, on).groupBy(F.lit(on).alias("parents")).agg(F.count("text").alias("kept"), F.count_if(F.col("text").isNull()).alias("dropped"), F.sum(F.length("text")).alias("chars"))
    return flag(False).unionByName(flag(True))


HYDRATE = f"""WITH {_STORE}, p AS (SELECT vec_id AS id, vec_id + 1000000 AS parent FROM embeddings),
h AS (SELECT a.text AS own, coalesce(a.text, b.text) AS found FROM p LEFT JOIN st a ON p.id = a.id LEFT JOIN st b ON p.parent = b.id)
SELECT false AS parents, count(own) AS kept, count(*) - count(own) AS dropped, CAST(sum(length(own)) AS BIGINT) AS chars FROM h
UNION ALL SELECT true, count(found), count(*) - count(found), CAST(sum(length(found)) AS BIGINT) FROM h"""

OPTIONS = V.SearchOptions(group_by_parent=True, hydrate_parents=True, min_score=0.05, max_docs=5, filters={"role": [0, 1, 2, 3, 4, 5]})


def agent_search(spark, d):
    hits, _ = V.staged_search(points(spark, d), asked(spark, d), lambda wanted: V.text_store(units(spark, d), wanted), OPTIONS, F.col("role"))
    return hits.select("query_id", "id", "raw_score", "score", F.length("text").cast("long").alias("chars"), "rank")


def agent_trace(spark, d):
    _, trace = V.staged_search(points(spark, d), asked(spark, d), lambda wanted: V.text_store(units(spark, d), wanted), OPTIONS, F.col("role"))
    return trace


_STAGES = f"""{_SIMS}, {_STORE},
a AS (SELECT *, CASE WHEN year >= 2023 THEN 'recent' ELSE 'older' END AS bucket FROM s WHERE role IN (0, 1, 2, 3, 4, 5)),
b AS (SELECT * FROM a QUALIFY row_number() OVER (PARTITION BY query_id, bucket ORDER BY score DESC, id) <= CASE bucket WHEN 'recent' THEN 10 ELSE 5 END),
c AS (SELECT query_id, id, parent, role, score AS raw_score, round(score * CASE WHEN year >= 2023 THEN 1 + 0.25 * (year - 2023) ELSE pow(0.1, (2023 - year) / 3) END, 6) AS score FROM b),
k AS (SELECT * FROM c QUALIFY row_number() OVER (PARTITION BY query_id, role ORDER BY score DESC, id) <= 1),
l AS (SELECT * FROM k QUALIFY {_RANK} <= 10),
h AS (SELECT l.*, coalesce(x.text, y.text) AS text FROM l LEFT JOIN st x ON l.id = x.id LEFT JOIN st y ON l.parent = y.id),
r AS (SELECT *, {_RANK} AS rank FROM h WHERE text IS NOT NULL AND score >= 0.05 QUALIFY rank <= 5)"""
AGENT = f"WITH {_STAGES} SELECT query_id, id, raw_score, CAST(score AS DOUBLE) AS score, length(text) AS chars, rank FROM r"
TRACE = f"""WITH {_STAGES} SELECT query_id, 'retrieved' AS stage, count(*) AS n FROM b GROUP BY 1 UNION ALL SELECT query_id, 'collapsed', count(*) FROM l GROUP BY 1
UNION ALL SELECT query_id, 'hydrated', count(*) FROM h WHERE text IS NOT NULL GROUP BY 1 UNION ALL SELECT query_id, 'returned', count(*) FROM r GROUP BY 1"""


def role_filter_delta(spark, d):
    """Queries whose own role's filter wins or loses a same-role hit at the top."""
    sims = V.nearest(points(spark, d), asked(spark, d), 1, ["role"], apart=True)  # the best of each role
    own = points(spark, d).select(F.col("id").alias("query_id"), F.col("role").alias("want"))
    rows = sims.join(own, "query_id")
    best = lambda df, name: V.top_k(df, 1).select("query_id", F.col("id").alias(name), (F.col("role") == F.col("want")).alias(f"{name}_ok"))
    out = own.join(asked(spark, d).select("query_id"), "query_id", "left_semi").join(best(rows, "plain"), "query_id", "left").join(best(rows.filter("role = want"), "filtered"), "query_id", "left")
    return out.select("query_id", "plain", "filtered", (F.coalesce("filtered_ok", F.lit(False)) & ~F.coalesce("plain_ok", F.lit(False))).alias("gained"), (F.coalesce("plain_ok", F.lit(False)) & ~F.coalesce("filtered_ok", F.lit(False))).alias("lost"))


ROLE = f"""WITH {_SIMS}, w AS (SELECT s.*, o.role AS want FROM s JOIN p o ON s.query_id = o.id WHERE s.id <> s.query_id),
a AS (SELECT query_id, id, role = want AS ok FROM w QUALIFY {_RANK} = 1), f AS (SELECT query_id, id FROM w WHERE role = want QUALIFY {_RANK} = 1)
SELECT q.id AS query_id, a.id AS plain, f.id AS filtered, f.id IS NOT NULL AND NOT coalesce(ok, false) AS gained, coalesce(ok, false) AND f.id IS NULL AS lost
FROM p q LEFT JOIN a ON a.query_id = q.id LEFT JOIN f ON f.query_id = q.id WHERE q.id % 100 = 0"""


def two_level_search(spark, d):
    """Best role centres first, then vectors of these roles; and how often plain search agrees."""
    p, q = points(spark, d), asked(spark, d)
    centre = p.select("role", F.posexplode("vector").alias("i", "x")).groupBy("role", "i").agg(F.round(F.avg(F.col("x").cast("double")), 9).alias("x"))
    centre = centre.groupBy("role").agg(F.transform(F.array_sort(F.collect_list(F.struct("i", "x"))), lambda s: s["x"]).alias("vector")).withColumnRenamed("role", "id")  # as long as a vector
    roles = V.top_k(V.similarities(centre, q), 2).select("query_id", F.col("id").alias("role"))
    best = V.nearest(p, q, 5, ["role"])
    hits = V.top_k(best.join(roles, ["query_id", "role"], "left_semi"), 5)
    plain = V.top_k(best, 5).select("query_id", "id")
    both = hits.join(plain, ["query_id", "id"], "left_semi").groupBy("query_id").agg(F.count("*").alias("agree"))
    return hits.groupBy("query_id").agg(F.count("*").alias("found"), F.min("id").alias("least"), F.max("score").alias("best")).join(both, "query_id", "left").select("query_id", "found", "least", "best", F.coalesce("agree", F.lit(0)).alias("agree"))


TWO_LEVEL = f"""WITH {_SIMS}, x AS (SELECT role, unnest(v) AS x, unnest(range(1, len(v) + 1)) AS i FROM p),
c AS (SELECT role, list(x ORDER BY i) AS v FROM (SELECT role, i, round(avg(x), 9) AS x FROM x GROUP BY ALL) GROUP BY role),
r AS (SELECT q.id AS query_id, c.role FROM c CROSS JOIN p q WHERE q.id % 100 = 0 QUALIFY row_number() OVER (PARTITION BY q.id ORDER BY round(list_dot_product(q.v, c.v), 6) DESC, c.role) <= 2),
h AS (SELECT * FROM s SEMI JOIN r USING (query_id, role) QUALIFY {_RANK} <= 5), f AS (SELECT query_id, id FROM s QUALIFY {_RANK} <= 5)
SELECT query_id, count(*) AS found, min(id) AS least, max(score) AS best, count(f.id) AS agree FROM h LEFT JOIN f USING (query_id, id) GROUP BY query_id"""


def upsert_delete_stale(spark, d):
    """Even labels are written again without every third vector: those go, the rest is overwritten; then the store's checks."""
    e = table(spark, d, "embeddings").select("vec_id", "label", F.lit(1).alias("version"), F.size("embedding").alias("dim"))
    new = e.filter("label % 2 = 0 AND vec_id % 3 <> 0").withColumn("version", F.lit(2))
    out = V.upsert(e, new, "vec_id", ["label"])
    return out.groupBy("label", "version").agg(F.count("*").alias("points"), F.countDistinct("vec_id").alias("ids"), F.min("dim").alias("least_dim"), F.max("dim").alias("most_dim"))


UPSERT = """SELECT label, CAST(CASE WHEN label % 2 = 0 THEN 2 ELSE 1 END AS INTEGER) AS version, count(*) AS points, count(DISTINCT vec_id) AS ids,
CAST(min(len(embedding)) AS INTEGER) AS least_dim, CAST(max(len(embedding)) AS INTEGER) AS most_dim FROM embeddings WHERE label % 2 <> 0 OR vec_id % 3 <> 0 GROUP BY label"""


def embed_cache_join(spark, d):
    """Texts whose vector is in the cache, by a key over model, ceiling and text; misses would be embedded.  Lengths are normalised."""
    key = lambda c: F.sha2(F.concat_ws("|", F.lit("model"), F.lit("2048"), c), 256)
    docs = table(spark, d, "documents").select("doc_id", key(F.col("text")).alias("k"))
    cache = table(spark, d, "documents").join(table(spark, d, "labels").select("doc_id"), "doc_id", "left_semi").select(key(F.col("text")).alias("k")).distinct().withColumn("cached", F.lit(True))
    norms = table(spark, d, "embeddings").select(F.col("vec_id").alias("doc_id"), F.round(ids.dot(ids.normalised(F.col("embedding")), ids.normalised(F.col("embedding"))), 6).alias("norm"))
    out = docs.join(cache, "k", "left").join(norms, "doc_id", "left")
    return out.groupBy(F.coalesce("cached", F.lit(False)).alias("hit")).agg(F.count("*").alias("texts"), F.countDistinct("k").alias("keys"), F.count("norm").alias("vectors"), F.round(F.avg("norm"), 4).alias("norm"))


CACHE = """WITH t AS (SELECT doc_id, sha256('model|2048|' || text) AS k FROM documents), c AS (SELECT DISTINCT k FROM t SEMI JOIN labels USING (doc_id))
SELECT c.k IS NOT NULL AS hit, count(*) AS texts, count(DISTINCT t.k) AS keys, count(vec_id) AS vectors, CASE WHEN count(vec_id) > 0 THEN 1.0::DOUBLE END AS norm
FROM t LEFT JOIN c ON t.k = c.k LEFT JOIN embeddings ON vec_id = doc_id GROUP BY 1"""


def gate_then_index(spark, d):
    """Nothing is indexed if any record has a problem; else both arms, by unit."""
    docs = table(spark, d, "documents")
    records = docs.select("doc_id", F.when(F.trim("text") == "", "empty text").when(F.col("doc_id").isNull(), "no id").alias("problem"))
    bad = records.agg(F.count("problem").alias("problems"))
    ready = docs.join(table(spark, d, "embeddings").select(F.col("vec_id").alias("doc_id")), "doc_id", "left_semi").crossJoin(bad)
    return ready.filter("problems = 0").groupBy("source").agg(F.count("*").alias("indexed"), F.max("problems").alias("problems"))


GATE = """SELECT source, count(*) AS indexed, CAST(0 AS BIGINT) AS problems FROM documents SEMI JOIN (SELECT vec_id AS doc_id FROM embeddings) USING (doc_id)
WHERE NOT EXISTS (SELECT 1 FROM documents WHERE trim(text) = '' OR doc_id IS NULL) GROUP BY source"""


def permutation_expectation(spark, d):
    """Expected top-1 and top-3 hits when wanted roles are dealt at random, with and without a query's own."""
    p = points(spark, d)
    ranks = V.top_k(V.nearest(p, asked(spark, d), 3, apart=True), 3).select("query_id", "role", "rank")
    want = p.join(asked(spark, d).select(F.col("query_id").alias("id")), "id", "left_semi").select(F.col("id").alias("w"), F.col("role").alias("want"))
    n = want.agg(F.count("*").alias("n"))
    wanted = want.groupBy("want").agg(F.count("*").alias("c"))  # a row per role
    top = ranks.groupBy("query_id", "role").agg(F.min("rank").alias("r"))
    own = top.join(want, (F.col("query_id") == F.col("w")) & (F.col("role") == F.col("want"))).agg(F.count_if(F.col("r") == 1).alias("own1"))
    hits = top.join(wanted, top["role"] == wanted["want"]).agg(F.coalesce(F.sum(F.when(F.col("r") == 1, F.col("c"))), F.lit(0)).alias("h1"), F.coalesce(F.sum("c"), F.lit(0)).alias("h3"))
    out = hits.crossJoin(own).crossJoin(n)
    return out.select(F.round(F.col("h1") / (F.col("n") * F.col("n")), 6).alias("top1"), F.round(F.col("h3") / (F.col("n") * F.col("n")), 6).alias("top3"), F.round((F.col("h1") - F.col("own1")) / (F.col("n") * F.col("n")), 6).alias("top1_without_own"))


PERMUTATION = f"""WITH {_SIMS}, t AS (SELECT query_id, role, {_RANK} AS rank FROM s WHERE id <> query_id QUALIFY rank <= 3),
w AS (SELECT id, role AS want FROM p WHERE id % 100 = 0),
x AS (SELECT t.query_id, w.id, min(rank) AS r FROM t JOIN w ON t.role = w.want GROUP BY ALL), n AS (SELECT CAST(count(*) AS DOUBLE) AS n FROM w)
SELECT round(count(*) FILTER (r = 1) / (n * n), 6) AS top1, round(count(*) FILTER (r IS NOT NULL) / (n * n), 6) AS top3, round(count(*) FILTER (r = 1 AND query_id <> id) / (n * n), 6) AS top1_without_own
FROM n LEFT JOIN x ON true GROUP BY n"""


def ab_report(spark, d):
    """Arm A (all roles) against arm B (even roles): top-1 and top-5 of the query's own role, mean reciprocal rank."""
    p, q = points(spark, d), asked(spark, d)
    own = p.select(F.col("id").alias("query_id"), F.col("role").alias("want"))

    def arm(name, df):
        ranks = V.top_k(V.nearest(df, q, 10, apart=True), 10).join(own, "query_id")
        first = ranks.filter("role = want").groupBy("query_id").agg(F.min("rank").alias("first"))
        rows = q.select("query_id").join(first, "query_id", "left")
        return rows.agg(F.count("*").alias("queries"), F.count_if(F.col("first") == 1).alias("top1"), F.count_if(F.col("first") <= 5).alias("top5"), F.round(F.sum(F.coalesce(1 / F.col("first"), F.lit(0.0))) / F.count("*"), 6).alias("mrr"), F.count_if(F.col("first").isNull()).alias("never")).withColumn("arm", F.lit(name))

    return arm("A", p).unionByName(arm("B", p.filter("role % 2 = 0")))


_ARM = """SELECT '{a}' AS arm, count(*) AS queries, count(*) FILTER (first = 1) AS top1, count(*) FILTER (first <= 5) AS top5, round(sum(coalesce(1.0::DOUBLE / first, 0)) / count(*), 6) AS mrr, count(*) FILTER (first IS NULL) AS never
FROM (SELECT q.id, min(rank) FILTER (r.role = q.role) AS first FROM p q LEFT JOIN (SELECT query_id, role, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, id) AS rank FROM s WHERE id <> query_id AND {w} QUALIFY rank <= 10) r ON r.query_id = q.id WHERE q.id % 100 = 0 GROUP BY q.id)"""
AB = f"WITH {_SIMS} {_ARM.format(a='A', w='true')} UNION ALL {_ARM.format(a='B', w='role % 2 = 0')}"

QUERIES = {f.__name__: f for f in (vector_topk, vector_filtered_topk, two_bucket_search, freshness_rescale, collapse_best_per_key, hydrate_fallback, agent_search, agent_trace, role_filter_delta, two_level_search, upsert_delete_stale, embed_cache_join, gate_then_index, permutation_expectation, ab_report)}
ORACLE_SQL = dict(zip(QUERIES, (VECTOR_TOPK, FILTERED, BUCKETS, FRESHNESS, COLLAPSE, HYDRATE, AGENT, TRACE, ROLE, TWO_LEVEL, UPSERT, CACHE, GATE, PERMUTATION, AB), strict=True))
