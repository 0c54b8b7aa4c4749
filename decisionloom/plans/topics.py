"""Topics in three scorings, arms with their paragraphs, sets of articles, rounded prices, token ceilings; and the SQL that repeats them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from decisionloom.functions import ids, text, vocab
from decisionloom.functions.numbers import round_exact
from decisionloom.functions.token_lengths import with_token_lengths
from decisionloom.operators import evaluation as E
from decisionloom.operators import histograms as H
from decisionloom.operators import lexical as L
from decisionloom.operators import patterns, sets
from decisionloom.operators import records as R
from decisionloom.plans.chunking import PARAS, paras
from decisionloom.plans.evaluation import _WANTED, _capsules, _named, _wanted
from decisionloom.plans.lexical import _LISTS, _PLAIN, STOP, TOPIC, bm25_sql
from decisionloom.plans.tables import table
from decisionloom.sources.folders import kept


def _topics(spark, d) -> DataFrame:
    """Every item in three scorings: all terms as written, those of the topic (no stop words), and the same guarded by a distinctive one; right are documents that hold one of its three longest terms."""
    docs, items = table(spark, d, "documents"), table(spark, d, "benchmark")
    chosen = L.ranked(items.select("item_id", F.explode(F.array_distinct(text.tokens(F.col("text"), **STOP))).alias("term")).withColumn("n", F.length("term")), "item_id", "term", 3, "n")
    truth = patterns.holding(docs.select("doc_id", F.lower("text").alias("body")), chosen.select("item_id", "term"), "doc_id", "body", "term").select("item_id", "doc_id").distinct()
    counts = kept(L.term_counts(docs, L.asked_terms(items), ["doc_id"], STOP))  # texts are read once for all scorings
    written = L.bm25(docs, items, "doc_id", "item_id", counts=counts, length="all_dl")
    topic = L.bm25(docs, items, "doc_id", "item_id", options=STOP, counts=counts)
    out = None
    for name, scores in (("as_written", written), ("topic_only", topic), ("guarded", topic.filter("guarded"))):
        one = E.topic_scoring(items, scores, truth, name, "item_id", "doc_id")
        out = one if out is None else out.unionByName(one)
    return out


def topic_harness(spark, d) -> DataFrame:
    return _topics(spark, d)


def topic_tally(spark, d) -> DataFrame:
    """Verdicts of each scoring, items that the corpus holds and absent ones together."""
    return _topics(spark, d).groupBy("scoring", "verdict").agg(F.count("*").alias("items"))


_TOPICS = f"""{_LISTS}, {_PLAIN}, {TOPIC[5 : TOPIC.index("SELECT item_id, count(doc_id)")].rstrip().replace("t AS (", "tt AS (", 1).replace("FROM t ", "FROM tt ")},
g AS (SELECT DISTINCT item_id, doc_id FROM asked JOIN tf USING (term) JOIN df USING (term) CROSS JOIN total WHERE 2 * df < n),
al AS (SELECT 'as_written' AS scoring, item_id, doc_id, score FROM scores2 UNION ALL SELECT 'topic_only', item_id, doc_id, score FROM scores UNION ALL SELECT 'guarded', item_id, doc_id, score FROM scores SEMI JOIN g USING (item_id, doc_id)),
rk AS (SELECT *, row_number() OVER (PARTITION BY scoring, item_id ORDER BY score DESC, doc_id) AS r FROM al),
by_item AS (SELECT scoring, item_id, count(*) AS n_scored, max(score) AS top_score, min(r) FILTER (h.doc_id IS NOT NULL) AS rank FROM rk LEFT JOIN h USING (item_id, doc_id) GROUP BY ALL),
verdicts AS (SELECT b.item_id, s.scoring, coalesce(n_scored, 0) AS n_scored, coalesce(top_score, 0) AS top_score, rank,
  CASE WHEN b.item_id NOT IN (SELECT item_id FROM h) THEN CASE WHEN coalesce(n_scored, 0) = 0 THEN 'PASS' ELSE 'FAIL' END WHEN rank = 1 THEN 'PASS' WHEN rank <= 3 THEN 'WARN' ELSE 'FAIL' END AS verdict
  FROM benchmark b CROSS JOIN (VALUES ('as_written'), ('topic_only'), ('guarded')) s(scoring) LEFT JOIN by_item x ON x.item_id = b.item_id AND x.scoring = s.scoring)"""
HARNESS = f"WITH {_TOPICS} SELECT * FROM verdicts"
TALLY = f"WITH {_TOPICS} SELECT scoring, verdict, count(*) AS items FROM verdicts GROUP BY ALL"


def arm_pinpoint(spark, d) -> DataFrame:
    """Documents against paragraphs as units: ranks of the right document, and how often its first hit is the paragraph that was asked for."""
    asked, own, units = _wanted(spark, d)
    queries = asked.select("item_id", "doc_id").join(own.groupBy("item_id").agg(F.min(F.col("unit") % 1_000_000).alias("para")), "item_id", "left")
    docs, items = table(spark, d, "documents"), asked.select("item_id", "text")
    first = lambda rows, unit: L.few(kept(L.ranked(L.bm25(rows, items, unit, "item_id", options=STOP), "item_id", unit, 10)))  # noqa: E731  ten rows an item
    whole = first(docs, "doc_id").join(docs.select("doc_id", F.length("text").alias("chars")), "doc_id").withColumn("paras", F.array().cast("array<long>"))
    parts = first(units, "unit").join(units.select("unit", "doc_id", F.length("text").alias("chars"), F.array(F.col("para").cast("long")).alias("paras")), "unit")
    arm = lambda name, hits: E.arm_summary(E.arm_rows(queries, hits.select("item_id", "doc_id", "rank", "paras", "chars"), "item_id", "doc_id")).withColumn("arm", F.lit(name))
    return arm("documents", whole).unionByName(arm("paragraphs", parts))


_ARM = """SELECT '{arm}' AS arm, count(*) AS queries, count(*) FILTER (rank = 1) AS top1, count(*) FILTER (rank <= 5) AS top5, round(sum(coalesce(1.0 / rank, 0)) / count(*), 6) AS mrr, count(*) FILTER (rank IS NULL) AS never,
  count(*) FILTER (coalesce(returned, 0) = 0) AS dropped, (count(*) FILTER (pin AND para IS NOT NULL))::VARCHAR || '/' || count(para)::VARCHAR AS pinpoint, CAST(floor(sum(coalesce(chars, 0)) / count(*)) AS BIGINT) AS chars
FROM q LEFT JOIN (SELECT item_id, count(*) AS returned, sum(chars) AS chars FROM {h} GROUP BY item_id) USING (item_id)
LEFT JOIN (SELECT item_id, min(rank) AS rank, arg_min(coalesce({h}.para = q.para, false), rank) AS pin FROM {h} JOIN q USING (item_id, doc_id) GROUP BY item_id) USING (item_id)"""
PINPOINT = f"""WITH {_WANTED}, {bm25_sql("documents", "doc_id", "a", "item_id")}, {_named(bm25_sql("paru", "unit", "a", "item_id"), "2")},
q AS (SELECT a.item_id, a.doc_id, min(unit % 1000000) AS para FROM a LEFT JOIN own ON own.item_id = a.item_id GROUP BY ALL),
ha AS (SELECT item_id, doc_id, NULL::BIGINT AS para, length(documents.text) AS chars, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM scores JOIN documents USING (doc_id) QUALIFY rank <= 10),
hb AS (SELECT item_id, paru.doc_id, paru.para, length(paru.text) AS chars, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, unit) AS rank FROM scores2 JOIN paru USING (unit) QUALIFY rank <= 10)
{_ARM.format(arm="documents", h="ha")} UNION ALL {_ARM.format(arm="paragraphs", h="hb")}"""


def capsule_against_text(spark, d) -> DataFrame:
    """The right document's rank by its capsule (first and last paragraph) against that by all its paragraphs: what the capsules lose and gain among the first five."""
    asked, _, units = _wanted(spark, d)
    items = asked.select("item_id", "text")
    right = asked.select("item_id", "doc_id")

    def rank(scores):
        own = kept(scores.join(L.few(right), ["item_id", "doc_id"], "left_semi").select("item_id", F.col("at_unit").alias("at"), F.col("score").alias("own")))
        return L.better(scores, own, "item_id", "at_unit").select("item_id", "rank")

    terms = kept(L.asked_terms(items, STOP))
    counted = lambda rows, keys: kept(L.term_counts(rows, terms, keys, STOP))  # noqa: E731  texts are read once, not for each use of their scores
    by_capsule = L.bm25(_capsules(units), items, "doc_id", "item_id", options=STOP, counts=counted(_capsules(units), ["doc_id"])).withColumn("at_unit", F.col("doc_id"))
    by_unit = L.bm25(units, items, "unit", "item_id", options=STOP, within=["doc_id"], counts=counted(units, ["doc_id", "unit"]))
    best = by_unit.groupBy("item_id", "doc_id").agg(F.min(F.struct((-F.col("score")).alias("s"), "unit")).alias("x"))  # a document's first unit
    best = best.select("item_id", "doc_id", F.col("x.unit").alias("at_unit"), (-F.col("x.s")).alias("score"))
    return E.compared_ranks(asked, {"capsule": rank(by_capsule), "text": rank(best)}, "item_id")


CAPSULE = f"""WITH {_WANTED}, {bm25_sql("caps", "doc_id", "a", "item_id")}, {_named(bm25_sql("paru", "unit", "a", "item_id"), "2")},
rc AS (SELECT item_id, doc_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM scores),
ru AS (SELECT item_id, unit // 1000000 AS doc_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, unit) AS rank FROM scores2),
rb AS (SELECT item_id, doc_id, min(rank) AS best FROM ru GROUP BY ALL), rt AS (SELECT item_id, doc_id, row_number() OVER (PARTITION BY item_id ORDER BY best, doc_id) AS rank FROM rb),
x AS (SELECT a.item_id, rc.rank AS c, rt.rank AS t FROM a LEFT JOIN rc ON rc.item_id = a.item_id AND rc.doc_id = a.doc_id LEFT JOIN rt ON rt.item_id = a.item_id AND rt.doc_id = a.doc_id)
SELECT count(*) AS queries, count(*) FILTER (c = 1) AS capsule_top1, count(*) FILTER (c <= 5) AS capsule_near, count(*) FILTER (c IS NULL) AS capsule_never, count(*) FILTER (t = 1) AS text_top1, count(*) FILTER (t <= 5) AS text_near, count(*) FILTER (t IS NULL) AS text_never,
count(*) FILTER (t <= 5 AND NOT coalesce(c <= 5, false)) AS lost, count(*) FILTER (c <= 5 AND NOT coalesce(t <= 5, false)) AS gained FROM x"""


def chunk_counts_by_source(spark, d) -> DataFrame:
    """Paragraphs as chunks: by source, how many there are and which fields they state."""
    source = table(spark, d, "documents").select("doc_id", "source")
    rows = paras(spark, d).join(source, "doc_id").withColumns({"title": F.col("text"), "case_no": F.regexp_extract("text", r"\d+/\d+", 0), "karar_no": F.regexp_extract("text", r"[0-9]{4}", 0), "refs": F.array("para")})
    return R.source_counts(rows)


BY_SOURCE = rf"""WITH {PARAS}, r AS (SELECT d.source, p.doc_id, p.text, try_cast(regexp_extract(p.text, '{ids.CHAMBER}', 1) AS INTEGER) AS n FROM paras p JOIN documents d ON p.doc_id = d.doc_id)
SELECT source, count(DISTINCT doc_id) AS documents, count(*) AS chunks, count(*) FILTER (trim(text) <> '' AND length(text) <= 2000) AS ok, count(*) FILTER (n BETWEEN 1 AND 50) AS has_chamber,
count(*) FILTER (regexp_matches(text, '\d+/\d+')) AS has_esas_no, count(*) FILTER (regexp_matches(text, '[0-9]{{4}}')) AS has_karar_no, count(*) AS paras FROM r GROUP BY source"""


def article_sets(spark, d) -> DataFrame:
    """Sets of words that a document's first paragraph states together, with its verdict (short or long), that no later paragraph covers with the same outcome."""
    items = F.array_sort(F.array_intersect(text.tokens(F.col("text")), F.array(*[F.lit(w) for w in vocab.ALL_STOPWORDS])))
    rows = paras(spark, d).select("doc_id", "para", items.alias("items"), F.when(F.length("text") < 200, "short").otherwise("long").alias("kind"))
    capsules = rows.filter("para > 1").select("doc_id", F.col("para").alias("capsule"), "items", F.col("kind").alias("outcome"))
    out = sets.unshared_verdicts(rows.filter("para = 1").select("doc_id", "items", F.col("kind").alias("verdict")), capsules)
    return out.select("doc_id", F.array_join("items", " ").alias("items"), "verdict", "capsules", F.array_join("outcomes", ",").alias("outcomes"))


_T = f"list_filter(regexp_extract_all(lower(text), '{vocab.TOKEN}'), lambda x: length(x) > 1)"
SETS = f"""WITH {PARAS}, r AS (SELECT doc_id, para, list_sort(list_distinct(list_filter({_T}, lambda x: x IN ({", ".join(f"'{w}'" for w in vocab.ALL_STOPWORDS)})))) AS i, CASE WHEN length(text) < 200 THEN 'short' ELSE 'long' END AS k FROM paras),
x AS (SELECT v.doc_id, v.i, v.k, count(c.doc_id) AS n, list_sort(list_distinct(list(c.k) FILTER (c.k IS NOT NULL))) AS o FROM r v LEFT JOIN r c ON c.doc_id = v.doc_id AND c.para > 1 AND len(v.i) > 0 AND list_has_all(c.i, v.i) WHERE v.para = 1 GROUP BY v.doc_id, v.i, v.k)
SELECT doc_id, array_to_string(i, ' ') AS items, k AS verdict, n AS capsules, coalesce(array_to_string(o, ','), '') AS outcomes FROM x WHERE NOT coalesce(list_contains(o, k), false)"""


def rounded_prices(spark, d) -> DataFrame:
    """Prices rounded by their exact binary values: discounted to 2 digits, a two-hundredth (ties) to 2, an eighth to 1, taxed to 4."""
    price, off, tax = (F.col(f"l_{c}").cast("double") for c in ("extendedprice", "discount", "tax"))
    of = lambda c, n, name: round_exact(c, n).alias(name)
    return table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", of(price * (1 - off), 2, "charged"), of(price / 200, 2, "share"), of(F.col("l_quantity").cast("double") / 8, 1, "eighth"), of(price * (1 - off) * (1 + tax), 4, "taxed"))


_ROUND = "CAST(printf('%.{n}f', {x}) AS DOUBLE)".format
_PRICE = "CAST(l_extendedprice AS DOUBLE)"
_OFF = f"({_PRICE} * (1 - CAST(l_discount AS DOUBLE)))"
PRICES = f"""SELECT l_orderkey, l_linenumber, {_ROUND(n=2, x=_OFF)} AS charged, {_ROUND(n=2, x=f"({_PRICE} / 200)")} AS share, {_ROUND(n=1, x="(CAST(l_quantity AS DOUBLE) / 8)")} AS eighth,
{_ROUND(n=4, x=f"({_OFF} * (1 + CAST(l_tax AS DOUBLE)))")} AS taxed FROM lineitem"""

#: Tokens that an embedding sees of a text.
CEILING = 512


def token_ceilings(spark, d, path: str | None = None) -> DataFrame:
    """By source: documents, those over the ceiling, the median and longest length in tokens, the share of tokens under the ceiling, characters a token.  From two histograms that merge."""
    if path is None:
        import public_tokenizers

        path = public_tokenizers.path("word_bpe_49k.json")
    docs = table(spark, d, "documents").select("source", F.coalesce(F.length("text"), F.lit(0)).alias("chars"), "text")
    rows = with_token_lengths(docs, path)
    by = rows.groupBy("source", "n_tokens").agg(F.count("*").alias("n"), F.sum("chars").alias("chars"))
    lengths = by.select("source", "n_tokens", "n")
    seen = H.under_ceiling(lengths, ["source"], "n_tokens", CEILING)
    chars = by.groupBy(F.col("source").alias("_c")).agg(F.sum("chars").alias("chars"))
    middle = H.medians(lengths, ["source"], "n_tokens").withColumnRenamed("source", "_s")
    out = seen.join(middle, F.col("source").eqNullSafe(F.col("_s"))).join(chars, F.col("source").eqNullSafe(F.col("_c")))
    share = lambda a, b: F.when(b > 0, F.round(a / b, 6))
    return out.select("source", F.col("rows").alias("documents"), "over", "median", "longest", share(F.col("visible"), F.col("total")).alias("visible"), share(F.col("chars"), F.col("total")).alias("chars_per_token"))


QUERIES = {f.__name__: f for f in (topic_harness, topic_tally, arm_pinpoint, capsule_against_text, chunk_counts_by_source, article_sets, rounded_prices, token_ceilings)}
ORACLE_SQL = {"topic_harness": HARNESS, "topic_tally": TALLY, "arm_pinpoint": PINPOINT, "capsule_against_text": CAPSULE, "chunk_counts_by_source": BY_SOURCE, "article_sets": SETS, "rounded_prices": PRICES}
