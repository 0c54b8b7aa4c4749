"""Further reports: merge sweep, source health, topic verdicts; and the SQL that repeats them."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from decisionloom.functions import ids
from decisionloom.operators import chunking as C
from decisionloom.operators import histograms as H
from decisionloom.operators import lexical as L
from decisionloom.plans.chunking import LENGTHS, paras
from decisionloom.plans.lexical import STOP, bm25_sql
from decisionloom.plans.tables import table

TARGETS = (1, 1000, 3000)


def merge_sweep(spark, d):
    """Units that each merge target makes: how many, their median and largest size, and how many paragraphs they hold."""
    arrays = C.ordered(paras(spark, d).withColumn("chars", F.length("text")), ["doc_id"], "para", "chars")
    out = None
    for target in TARGETS:
        rows = arrays.withColumn("g", C.merge_groups(F.col("values"), target)).select("doc_id", F.explode(F.arrays_zip("values", "g")).alias("x"))
        units = rows.groupBy("doc_id", F.col("x.g").alias("g")).agg(F.sum("x.values").alias("chars"), F.count("*").alias("paras"))
        lengths = H.counted(units.withColumn("target", F.lit(target)), ["target"], "chars")
        level = units.agg(F.count("*").alias("units"), F.max("chars").alias("largest"), F.max("paras").alias("most_paras")).withColumn("target", F.lit(target)).join(H.medians(lengths, ["target"], "chars"), "target")
        level = level.select("units", "median", "largest", "most_paras", "target")
        out = level if out is None else out.unionByName(level)
    return out


SWEEP = f"""WITH RECURSIVE {LENGTHS}, t AS (SELECT unnest([1, 1000, 3000]) AS target),
f AS (SELECT doc_id, l, target, 1 AS i, l[1] AS x, 1 AS g, CASE WHEN l[1] >= target THEN 2 ELSE 1 END AS nx, CASE WHEN l[1] >= target THEN 0 ELSE l[1] END AS nu FROM ln, t WHERE len(l) > 0
  UNION ALL SELECT doc_id, l, target, i, x, nx, CASE WHEN nu + x >= target THEN nx + 1 ELSE nx END, CASE WHEN nu + x >= target THEN 0 ELSE nu + x END FROM (SELECT doc_id, l, target, i + 1 AS i, l[i + 1] AS x, nx, nu FROM f WHERE i < len(l))),
u AS (SELECT target, doc_id, g, CAST(sum(x) AS BIGINT) AS chars, count(*) AS paras FROM f GROUP BY ALL)
SELECT CAST(target AS INTEGER) AS target, count(*) AS units, median(chars) AS median, max(chars) AS largest, max(paras) AS most_paras FROM u GROUP BY target"""


def source_health(spark, d):
    """By source: usable documents, those left out as reserved and as unusable, apart, and the first three picked."""
    rows = table(spark, d, "documents").join(table(spark, d, "labels").filter("quality = 0").select("doc_id", F.lit(True).alias("reserved")), "doc_id", "left")
    usable = F.col("lang").isin("en", "de") & (F.trim("text") != "")
    reserved = F.coalesce("reserved", F.lit(False))
    picked = rows.filter(usable & ~reserved).withColumn("n", F.row_number().over(Window.partitionBy("source").orderBy("doc_id"))).filter("n <= 3").groupBy("source").agg(F.array_join(F.array_sort(F.collect_list("doc_id")).cast("array<string>"), ",").alias("picked"))
    counts = rows.groupBy("source").agg(F.count("*").alias("documents"), F.count_if(usable & ~reserved).alias("usable"), F.count_if(usable & reserved).alias("reserved"), F.count_if(~usable).alias("unusable"))
    return counts.join(picked, "source", "left")


HEALTH = """WITH r AS (SELECT d.doc_id, source, lang IN ('en', 'de') AND trim(text) <> '' AS u, l.doc_id IS NOT NULL AS res FROM documents d LEFT JOIN (SELECT doc_id FROM labels WHERE quality = 0) l USING (doc_id)),
p AS (SELECT source, string_agg(doc_id::VARCHAR, ',' ORDER BY doc_id) AS picked FROM (SELECT * FROM r WHERE u AND NOT res QUALIFY row_number() OVER (PARTITION BY source ORDER BY doc_id) <= 3) GROUP BY source)
SELECT source, count(*) AS documents, count(*) FILTER (u AND NOT res) AS usable, count(*) FILTER (u AND res) AS reserved, count(*) FILTER (NOT u) AS unusable, any_value(picked) AS picked FROM r LEFT JOIN p USING (source) GROUP BY source"""


def topic_report(spark, d):
    """Items, the rank of the first document that quotes them, the chance of that by luck, and a verdict; items that none quotes should be met with silence."""
    docs, items = table(spark, d, "documents"), table(spark, d, "benchmark")
    right = L.quoting(items, docs, "item_id", "doc_id")
    ranks = L.ranked(L.bm25(docs, items, "doc_id", "item_id", options=STOP), "item_id", "doc_id").select("item_id", "doc_id", "rank")
    first = ranks.join(right, ["item_id", "doc_id"]).groupBy("item_id").agg(F.min("rank").alias("first"))
    pool = docs.agg(F.count("*").alias("pool"))
    rows = items.select("item_id").join(right.groupBy("item_id").agg(F.count("*").alias("accepted")), "item_id", "left").join(first, "item_id", "left").crossJoin(pool)
    accepted = F.coalesce("accepted", F.lit(0).cast("long"))
    verdict = F.when(accepted == 0, "SKIP").when(F.col("first") == 1, "PASS").when(F.col("first") <= 3, "WARN").otherwise("FAIL")
    return rows.select("item_id", accepted.alias("accepted"), "first", F.round(ids.hit_probability(F.col("pool"), accepted, F.lit(3).cast("long")), 6).alias("chance"), verdict.alias("verdict"))


TOPICS = f"""WITH {bm25_sql("documents", "doc_id", "benchmark", "item_id")},
r AS (SELECT item_id, doc_id FROM benchmark b JOIN documents d ON contains(d.text, b.text)), k AS (SELECT item_id, doc_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM scores),
f AS (SELECT item_id, min(rank) AS first FROM k JOIN r USING (item_id, doc_id) GROUP BY item_id), a AS (SELECT item_id, count(*) AS accepted FROM r GROUP BY item_id),
x AS (SELECT b.item_id, coalesce(accepted, 0) AS accepted, first, (SELECT count(*) FROM documents) AS n FROM benchmark b LEFT JOIN a USING (item_id) LEFT JOIN f USING (item_id))
SELECT item_id, accepted, first, round(1 - (greatest(n - accepted, 0) / n) * (greatest(n - accepted - 1, 0) / (n - 1)) * (greatest(n - accepted - 2, 0) / (n - 2)), 6) AS chance,
  CASE WHEN accepted = 0 THEN 'SKIP' WHEN first = 1 THEN 'PASS' WHEN first <= 3 THEN 'WARN' ELSE 'FAIL' END AS verdict FROM x"""

QUERIES = {f.__name__: f for f in (merge_sweep, source_health, topic_report)}
ORACLE_SQL = {"merge_sweep": SWEEP, "source_health": HEALTH, "topic_report": TOPICS}
