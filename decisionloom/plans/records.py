"""Queries over records, checks and merges, and the SQL that repeats them."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from decisionloom.functions import html, ids, text, vocab
from decisionloom.operators import histograms as H
from decisionloom.operators import records as R
from decisionloom.plans.chunking import PARAS, paras
from decisionloom.plans.tables import table


def _scalars(docs, t):
    c = F.col("head")
    rows = docs.select("doc_id", "source", t.alias("head"))
    return rows.select(
        "doc_id", F.md5(text.tr_upper(F.replace(c, F.lit("ß"), F.lit("ss")))).alias("upper"), F.md5(text.tr_lower(c)).alias("lower"), F.md5(text.norm_ws(c)).alias("ws"), F.md5(text.deaccent(c)).alias("plain"), text.title_shape(F.concat_ws(" ", "source", F.col("doc_id").cast("string"))).alias("shape"),
        F.md5(text.slug(c)).alias("slug"), F.format_string("%d/%d", F.length(c), F.lit(1000)).alias("part"), F.round(text.share_of(c, vocab.STOPWORDS["en"]), 6).alias("english"), ids.paragraph_range(F.col("doc_id"), F.col("doc_id") + F.col("doc_id") % 2).alias("range"),
    )


def text_scalars(spark, d):
    return _scalars(table(spark, d, "documents"), F.col("text"))


_LOW = "lower(translate(h, 'İI', 'iı'))"
TEXT = f"""WITH t AS (SELECT doc_id, source, text AS h FROM documents),
w AS (SELECT *, regexp_extract_all(lower(h), '{vocab.TOKEN}') AS w FROM t)
SELECT doc_id, md5(upper(translate(replace(h, 'ß', 'ss'), 'iı', 'İI'))) AS upper, md5({_LOW}) AS lower, md5(trim(regexp_replace(h, '\\s+', ' ', 'g'))) AS ws, md5(translate(h, '{vocab.DEACCENT_FROM}', '{vocab.DEACCENT_TO}')) AS plain,
  regexp_replace(source || ' ' || doc_id::VARCHAR, '\\d+', '#', 'g') AS shape,
  md5(trim(regexp_replace(regexp_replace(replace({_LOW}, '̇', ''), '[''’‘`.]', '', 'g'), '[^0-9a-zçğıöşüâîûêôß-öø-ÿ]+', '_', 'g'), '_')) AS slug,
  length(h)::VARCHAR || '/1000' AS part, round(len(list_filter(w, lambda x: x IN ({", ".join(f"'{x}'" for x in vocab.STOPWORDS["en"])}))) / greatest(len(w), 1), 6) AS english,
  CASE WHEN doc_id % 2 = 0 THEN 'p' || doc_id::VARCHAR ELSE 'p' || doc_id::VARCHAR || '_to_p' || (doc_id + 1)::VARCHAR END AS range FROM w"""

WHOLE = TEXT.replace("text AS h", "text AS h")

def canonical_and_refs(spark, d):
    """Parts as laws: the number is the key, the brand the abbreviation, the size the article."""
    p = table(spark, d, "part")
    no = F.when(F.col("p_partkey") % 3 == 0, F.col("p_partkey").cast("string"))
    kind = F.when(F.col("p_partkey") % 3 == 1, "constitution").otherwise("statute")
    article = F.when(F.col("p_partkey") % 5 > 0, F.col("p_size").cast("string"))
    canonical = ids.canonical_id(kind, no, F.lit(None).cast("string"), F.col("p_brand"), article)
    return p.select("p_partkey", canonical.alias("canonical"), F.array_join(ids.law_refs(canonical, no, F.lit("HMK"), article), " ").alias("refs"))


CANONICAL = """WITH p AS (SELECT p_partkey, CASE WHEN p_partkey % 3 = 0 THEN p_partkey::VARCHAR END AS no, CASE WHEN p_partkey % 5 > 0 THEN p_size::VARCHAR END AS art, p_partkey % 3 = 1 AS con,
  trim(regexp_replace(lower(translate(p_brand, 'İI', 'iı')), '[^0-9a-zçğıöşü]+', '-', 'g'), '-') AS slug FROM part),
c AS (SELECT *, CASE WHEN no IS NOT NULL THEN no WHEN con THEN 'constitution' ELSE slug END || '/' || coalesce(art, 'unknown') AS canonical FROM p)
SELECT p_partkey, canonical, array_to_string(list_sort(list_distinct(list_filter([canonical, no, no || '/' || art, 'HMK', 'HMK/' || art], lambda x: x IS NOT NULL))), ' ') AS refs FROM c"""

#: Patterns of text that says nothing on the matter, by reason, in order.
PROCEDURAL = {"license": r"(?i)licensed under|released under", "shouting": r"(?:[A-Z]{2,}!! ?){3,}", "table": r"(?:[^|\n]{1,30}\|){3,}"}


def procedural_flags(rows):
    reason = F.lit(None).cast("string")
    density = F.lit(0.0)
    for k, p in reversed(PROCEDURAL.items()):
        reason = F.when(F.col("text").rlike(p), F.lit(k)).otherwise(reason)
        density = F.when(F.col("text").rlike(p), F.length(F.regexp_extract("text", p, 0)) / F.length("text")).otherwise(density)
    return rows.withColumn("reason", reason).withColumn("density", F.round(density, 6)).withColumn("score", F.when(F.col("reason").isNotNull(), F.lit(vocab.PENALTY)).otherwise(F.lit(1.0)))


def procedural_penalty(spark, d):
    return procedural_flags(table(spark, d, "documents")).filter("reason is not null").select("doc_id", "reason", "density", "score")


_REASON = "CASE " + " ".join(f"WHEN regexp_matches(text, '{p}') THEN '{k}'" for k, p in PROCEDURAL.items()) + " END"
_DENSITY = "CASE " + " ".join(f"WHEN regexp_matches(text, '{p}') THEN length(regexp_extract(text, '{p}', 0)) / length(text)" for k, p in PROCEDURAL.items()) + " ELSE 0 END"
PENALTY = f"SELECT doc_id, {_REASON} AS reason, round({_DENSITY}, 6) AS density, 0.4::DOUBLE AS score FROM documents WHERE {_REASON} IS NOT NULL"


def new_penalty_by_unit(spark, d):
    """Documents flagged as a whole against those with a flagged paragraph; paragraphs newly flagged."""
    whole = procedural_flags(table(spark, d, "documents")).select("doc_id", F.col("reason").isNotNull().alias("flagged"))
    units = procedural_flags(paras(spark, d)).groupBy("doc_id").agg(F.count("*").alias("units"), F.count_if(F.col("reason").isNotNull()).alias("hit"))
    return whole.join(units, "doc_id").groupBy("flagged").agg(F.count("*").alias("documents"), F.sum("units").alias("units"), F.sum("hit").alias("flagged_units"), F.sum(F.when(~F.col("flagged"), F.col("hit")).otherwise(0)).alias("newly"))


NEW_PENALTY = f"""WITH {PARAS}, u AS (SELECT doc_id, count(*) AS units, count(*) FILTER ({_REASON} IS NOT NULL) AS hit FROM paras GROUP BY doc_id),
w AS (SELECT doc_id, {_REASON} IS NOT NULL AS flagged FROM documents)
SELECT flagged, count(*) AS documents, CAST(sum(units) AS BIGINT) AS units, CAST(sum(hit) AS BIGINT) AS flagged_units, CAST(sum(CASE WHEN flagged THEN 0 ELSE hit END) AS BIGINT) AS newly FROM w JOIN u USING (doc_id) GROUP BY flagged"""


def title_shape_profile(spark, d):
    """Shapes of addresses: how many pages, their share, the most common length of the path."""
    p = table(spark, d, "pages").select("page_id", text.title_shape(F.col("url")).alias("shape"), F.size(F.split("url", "/")).alias("depth"))
    n = p.agg(F.count("*").alias("n"))
    return p.groupBy("shape").agg(F.count("*").alias("pages"), F.min("page_id").alias("example"), F.max("depth").alias("depth")).crossJoin(n).select("shape", "pages", "example", "depth", F.round(F.col("pages") / F.col("n"), 6).alias("share"))


SHAPES = """SELECT left(regexp_replace(url, '\\d+', '#', 'g'), 70) AS shape, count(*) AS pages, min(page_id) AS example, CAST(max(len(string_split(url, '/'))) AS INTEGER) AS depth, round(count(*) / sum(count(*)) OVER (), 6) AS share FROM pages GROUP BY 1"""


def _preflight(spark, d):
    docs = table(spark, d, "documents").withColumn("p", text.lines(F.col("text")))
    docs = docs.select("doc_id", "source", "text", "p", F.size("p").alias("n_paras"), F.length("text").alias("chars"))
    problems = R.named({"no paragraphs": F.col("n_paras") == 0, "hollow": text.hollow(F.col("p")), "too long": F.col("chars") > 15_000})
    warnings = R.named({"one paragraph": F.col("n_paras") == 1, "short": F.col("chars") < 300, "repeats": F.size(F.array_distinct("p")) < F.col("n_paras")})
    return docs.withColumn("problems", problems).withColumn("warnings", warnings).withColumn("verdict", F.when(F.size("problems") > 0, "RED").when(F.size("warnings") > 0, "AMBER").otherwise("GREEN"))


def preflight_verdict(spark, d):
    """Verdicts by source, the upper median of characters, predicted tokens; medians by counts of each length, so no source is gathered."""
    rows = _preflight(spark, d)
    keys = ["source", "verdict"]
    counts = rows.groupBy(*keys, "chars").agg(F.count("*").alias("n"))
    placed = counts.withColumn("upto", F.sum("n").over(Window.partitionBy(*keys).orderBy("chars"))).withColumn("all", F.sum("n").over(Window.partitionBy(*keys)))
    median = F.min(F.when(F.col("upto") >= F.floor(F.col("all") / 2) + 1, F.col("chars")))
    tokens = F.sum(F.col("chars") * F.col("n"))
    return placed.groupBy(*keys).agg(F.sum("n").alias("documents"), median.alias("upper_median"), F.round(tokens * vocab.OUTPUT_PER_CHAR, 3).alias("tokens_out"), F.round(tokens / vocab.CHARS_PER_TOKEN, 3).alias("tokens_in"))


_PRE = f"""{PARAS}, x AS (SELECT d.doc_id, d.source, length(d.text) AS chars, count(p.para) AS n, count(DISTINCT p.text) AS k, coalesce(sum(length(p.text)), 0) AS body, count(*) FILTER (regexp_matches(p.text, '[;:]\\s*$')) AS open
  FROM documents d LEFT JOIN paras p USING (doc_id) GROUP BY ALL),
v AS (SELECT *, n = 0 AS none, body < 700 AND open >= 2 AS hollow, chars > 15000 AS long, n = 1 AS one, chars < 300 AS short, k < n AS repeats FROM x),
pf AS (SELECT *, CASE WHEN none OR hollow OR long THEN 'RED' WHEN one OR short OR repeats THEN 'AMBER' ELSE 'GREEN' END AS verdict FROM v)"""
PREFLIGHT = f"""WITH {_PRE} SELECT source, verdict, count(*) AS documents, CAST(list_sort(list(chars))[count(*) // 2 + 1] AS INTEGER) AS upper_median, CAST(round(sum(chars) * 0.35, 3) AS DOUBLE) AS tokens_out, CAST(round(sum(chars) / 4.11, 3) AS DOUBLE) AS tokens_in FROM pf GROUP BY ALL"""


def preflight_histogram(spark, d):
    rows = _preflight(spark, d)
    each = lambda c: rows.select(F.lit(c).alias("level"), F.explode(c).alias("name"))
    return each("problems").unionByName(each("warnings")).groupBy("level", "name").agg(F.count("*").alias("documents"))


HISTOGRAM = f"""WITH {_PRE} SELECT * FROM (SELECT 'problems' AS level, unnest(['no paragraphs', 'hollow', 'too long']) AS name, unnest([count(*) FILTER (none), count(*) FILTER (hollow), count(*) FILTER (long)]) AS documents FROM pf
UNION ALL SELECT 'warnings', unnest(['one paragraph', 'short', 'repeats']), unnest([count(*) FILTER (one), count(*) FILTER (short), count(*) FILTER (repeats)]) FROM pf) WHERE documents > 0"""


def riskiest(spark, d):
    rows = _preflight(spark, d).select("doc_id", F.size("problems").alias("problems"), F.size("warnings").alias("warnings"), "chars")
    return rows.orderBy(F.desc("problems"), F.desc("warnings"), F.desc("chars"), "doc_id").limit(10)


RISKIEST = f"""WITH {_PRE} SELECT doc_id, CAST(none AS INTEGER) + CAST(hollow AS INTEGER) + CAST(long AS INTEGER) AS problems, CAST(one AS INTEGER) + CAST(short AS INTEGER) + CAST(repeats AS INTEGER) AS warnings, CAST(chars AS INTEGER) AS chars FROM pf ORDER BY 2 DESC, 3 DESC, chars DESC, doc_id LIMIT 10"""


def truncation_loss(spark, d):
    """Share of tokens that an embedding with a ceiling would see, by source."""
    t = F.floor(F.length("text") / vocab.CHARS_PER_TOKEN)
    lengths = H.counted(table(spark, d, "documents").select("source", t.cast("long").alias("t")), ["source"], "t")
    seen = H.under_ceiling(lengths, ["source"], "t", 512).join(H.medians(lengths, ["source"], "t").withColumnRenamed("source", "_s"), F.col("source").eqNullSafe(F.col("_s")))
    return seen.select("source", F.col("rows").alias("documents"), "over", "median", "longest", F.round(F.col("visible") / F.col("total"), 6).alias("visible"))


TRUNCATION = """WITH t AS (SELECT source, CAST(floor(length(text) / 4.11) AS BIGINT) AS t FROM documents)
SELECT source, count(*) AS documents, count(*) FILTER (t > 512) AS over, median(t) AS median, max(t) AS longest, round(sum(least(t, 512)) / sum(t), 6) AS visible FROM t GROUP BY source"""


def acceptance_report(spark, d):
    """Criteria over the whole run and their verdicts."""
    rows = table(spark, d, "documents").join(table(spark, d, "labels"), "doc_id", "left")
    a = rows.agg(F.count("*").alias("n"), F.count_if(F.trim("text") == "").alias("empty"), F.count_if(F.col("quality") == 0).alias("junk"), F.count_if(F.col("toxic") == 1).alias("toxic"), F.count_if(F.col("quality").isNull()).alias("unread"), F.countDistinct("doc_id").alias("ids"))
    checks = [("empty texts", F.col("empty"), F.col("empty") == 0), ("unique ids", F.col("n") - F.col("ids"), F.col("ids") == F.col("n")), ("junk share", F.col("junk"), F.col("junk") * 10 <= F.col("n")), ("toxic share", F.col("toxic"), F.col("toxic") * 50 <= F.col("n"))]
    out = F.array(*[F.struct(F.lit(k).alias("criterion"), v.cast("long").alias("count"), F.when(ok, "PASS").otherwise("FAIL").alias("verdict")) for k, v, ok in checks], F.struct(F.lit("unread").alias("criterion"), F.col("unread").alias("count"), F.lit("MANUAL").alias("verdict")))
    return a.select(F.explode(out).alias("x")).select("x.*")


ACCEPTANCE = """WITH a AS (SELECT count(*) AS n, count(*) FILTER (trim(text) = '') AS empty, count(*) FILTER (quality = 0) AS junk, count(*) FILTER (toxic = 1) AS toxic, count(*) FILTER (quality IS NULL) AS unread, count(DISTINCT doc_id) AS ids FROM documents LEFT JOIN labels USING (doc_id))
SELECT 'empty texts' AS criterion, empty AS count, CASE WHEN empty = 0 THEN 'PASS' ELSE 'FAIL' END AS verdict FROM a UNION ALL SELECT 'unique ids', n - ids, CASE WHEN ids = n THEN 'PASS' ELSE 'FAIL' END FROM a
UNION ALL SELECT 'junk share', junk, CASE WHEN junk * 10 <= n THEN 'PASS' ELSE 'FAIL' END FROM a UNION ALL SELECT 'toxic share', toxic, CASE WHEN toxic * 50 <= n THEN 'PASS' ELSE 'FAIL' END FROM a UNION ALL SELECT 'unread', unread, 'MANUAL' FROM a"""


def _records(spark, d):
    docs = table(spark, d, "documents")
    esas, karar = (F.when(F.col("doc_id") % m > 0, (2000 + F.col("doc_id") % 25).cast("int")) for m in (7, 11))
    return R.index_records(docs.select("doc_id", "source", "text", F.concat((F.col("doc_id") % 60).cast("string"), F.lit(". Hukuk Dairesi")).alias("title"), esas.alias("esas_year"), karar.alias("karar_year")))


def contract_validate(spark, d):
    rows = _records(spark, d).withColumn("problems", R.contract_problems())
    notes = F.array_join("derivation_notes", ",")
    return rows.select("filename", "uuid", "chamber", "esas_year", "karar_year", notes.alias("notes"), F.array_join("problems", ",").alias("problems"))


_REC = f"""r AS (SELECT doc_id, source, text, CASE WHEN doc_id % 60 BETWEEN 1 AND 50 THEN CAST(doc_id % 60 AS INTEGER) END AS chamber, CASE WHEN doc_id % 7 > 0 THEN CAST(2000 + doc_id % 25 AS INTEGER) END AS e, CASE WHEN doc_id % 11 > 0 THEN CAST(2000 + doc_id % 25 AS INTEGER) END AS k,
  sha1(unhex('{vocab.NAMESPACE_DNS.replace("-", "")}') || encode(source || ':' || doc_id::VARCHAR)) AS h FROM documents)"""
CONTRACT = f"""WITH {_REC} SELECT '__' || doc_id::VARCHAR || '.txt' AS filename, h[1:8] || '-' || h[9:12] || '-5' || h[14:16] || '-' || translate(h[17:17], '0123456789abcdef', '89ab89ab89ab89ab') || h[18:20] || '-' || h[21:32] AS uuid, chamber, coalesce(e, k) AS esas_year, coalesce(k, e) AS karar_year,
  CASE WHEN e IS NULL AND k IS NOT NULL THEN 'esas_year from karar_year' WHEN k IS NULL AND e IS NOT NULL THEN 'karar_year from esas_year' ELSE '' END AS notes,
  CASE WHEN trim(text) = '' THEN 'empty_text' || CASE WHEN coalesce(e, k) IS NULL THEN ',no_year' ELSE '' END WHEN coalesce(e, k) IS NULL THEN 'no_year' ELSE '' END AS problems FROM r"""


def contract_gap_rollup(spark, d):
    """Records, chambers, notes and missing years, by source and in total."""
    rows = _records(spark, d)
    return rows.rollup("source_type").agg(F.count("*").alias("records"), F.count("chamber").alias("chambers"), F.count_if(F.size("derivation_notes") > 0).alias("noted"), F.count_if(F.col("esas_year").isNull()).alias("no_year"), F.countDistinct("uuid").alias("ids"))


ROLLUP = f"""WITH {_REC} SELECT source AS source_type, count(*) AS records, count(chamber) AS chambers, count(*) FILTER ((e IS NULL) <> (k IS NULL)) AS noted, count(*) FILTER (e IS NULL AND k IS NULL) AS no_year, count(DISTINCT h) AS ids FROM r GROUP BY ROLLUP (source)"""


def value_audit(spark, d):
    rows = table(spark, d, "documents").join(table(spark, d, "labels"), "doc_id").select("lang", "quality", "toxic")
    field = F.when(F.grouping("lang") == 0, "lang").when(F.grouping("quality") == 0, "quality").otherwise("toxic")
    value = F.coalesce("lang", F.col("quality").cast("string"), F.col("toxic").cast("string"))
    sets = rows.groupingSets([["lang"], ["quality"], ["toxic"]], "lang", "quality", "toxic")
    return sets.agg(field.alias("field"), value.alias("value"), F.count("*").alias("n")).select("field", "value", "n")


AUDIT = "SELECT CASE WHEN grouping(lang) = 0 THEN 'lang' WHEN grouping(quality) = 0 THEN 'quality' ELSE 'toxic' END AS field, coalesce(lang, quality::VARCHAR, toxic::VARCHAR) AS value, count(*) AS n FROM documents JOIN labels USING (doc_id) GROUP BY GROUPING SETS ((lang), (quality), (toxic))"


def arms_anti_union(spark, d):
    """Arm B: documents without a label, and the paragraphs of those with one."""
    docs, chunked = table(spark, d, "documents"), table(spark, d, "labels").select("doc_id")
    whole = docs.join(chunked, "doc_id", "left_anti").select("doc_id", F.lit("document").alias("unit"), F.length("text").alias("chars"))
    parts = paras(spark, d).join(chunked, "doc_id", "left_semi").select("doc_id", F.lit("chunk").alias("unit"), F.length("text").alias("chars"), "para")
    return whole.unionByName(parts, allowMissingColumns=True).groupBy("unit").agg(F.count("*").alias("records"), F.countDistinct("doc_id").alias("documents"), F.sum("chars").alias("chars"), F.count("para").alias("with_para"))


ARMS = f"""WITH {PARAS} SELECT 'document' AS unit, count(*) AS records, count(DISTINCT doc_id) AS documents, CAST(sum(length(text)) AS BIGINT) AS chars, CAST(0 AS BIGINT) AS with_para FROM documents ANTI JOIN labels USING (doc_id)
UNION ALL SELECT 'chunk', count(*), count(DISTINCT doc_id), CAST(sum(length(text)) AS BIGINT), count(*) FROM paras SEMI JOIN labels USING (doc_id)"""


def export_merge(spark, d):
    """Labelled documents are there already; an export of all documents comes in."""
    docs, labelled = table(spark, d, "documents").select("doc_id", "source", "n_chars"), table(spark, d, "labels").select("doc_id")
    return R.merge_new(docs.join(labelled, "doc_id", "left_semi"), docs.withColumn("n_chars", F.lit(0).cast("long")), "doc_id")


EXPORT = "SELECT doc_id, source, CASE WHEN doc_id IN (SELECT doc_id FROM labels) THEN n_chars ELSE 0 END AS n_chars FROM documents"


def targeted_merge(spark, d):
    """All documents are stored; the labelled ones ran again, and those of good quality came back, twice."""
    docs, labels = table(spark, d, "documents").select("doc_id", "source", F.lit(1).alias("version")), table(spark, d, "labels")
    ran = docs.join(labels.select("doc_id"), "doc_id", "left_semi")
    new = docs.join(labels.filter("quality = 1").select("doc_id"), "doc_id", "left_semi").withColumn("version", F.lit(2))
    once = R.merge_targeted(docs, ran, new, "doc_id")
    return R.merge_targeted(once, ran, new, "doc_id").groupBy("source", "version").agg(F.count("*").alias("rows"))


TARGETED = """WITH d AS (SELECT source, doc_id IN (SELECT doc_id FROM labels) AS ran, doc_id IN (SELECT doc_id FROM labels WHERE quality = 1) AS good FROM documents)
SELECT source, CAST(CASE WHEN good THEN 2 ELSE 1 END AS INTEGER) AS version, count(*) AS rows FROM d WHERE NOT ran OR good GROUP BY ALL"""


def scorecard_compare(spark, d):
    """Run A (labelled good) against run B (labelled bad), by source: which is better."""
    rows = table(spark, d, "documents").join(table(spark, d, "labels"), "doc_id")
    card = lambda q, c: rows.filter(f"quality = {q}").groupBy("source").agg(F.count("*").alias(c))
    out = card(1, "a").join(card(0, "b"), "source", "full_outer").select("source", F.coalesce("a", F.lit(0)).alias("a"), F.coalesce("b", F.lit(0)).alias("b"))
    return out.withColumn("verdict", F.when(F.col("a") > F.col("b"), "better").when(F.col("a") < F.col("b"), "WORSE").otherwise("same"))


SCORECARD = "SELECT source, count(*) FILTER (quality = 1) AS a, count(*) FILTER (quality = 0) AS b, CASE WHEN a > b THEN 'better' WHEN a < b THEN 'WORSE' ELSE 'same' END AS verdict FROM documents JOIN labels USING (doc_id) WHERE quality IN (0, 1) GROUP BY source"


def metadata_json(spark, d):
    """Keys of the events' property strings, and how often each comes."""
    e = table(spark, d, "events").select("event_type", F.explode(F.json_object_keys("props")).alias("key"))
    return e.groupBy("event_type", "key").agg(F.count("*").alias("n"))


METADATA = "SELECT event_type, key, count(*) AS n FROM (SELECT event_type, unnest(json_keys(props)) AS key FROM events) GROUP BY ALL"


def dissent_longest_prefix(spark, d):
    """The longest prefix of a part's type, at a word's end, that is another part's type cut to two words or one."""
    p = table(spark, d, "part").select("p_partkey", "p_type")
    short = p.select(F.array_join(F.slice(F.split("p_type", " "), F.lit(1), (F.col("p_partkey") % 3 + 1).cast("int")), " ").alias("subject"))
    return R.longest_prefix(p, short, "p_type", "subject")


PREFIX = """WITH s AS (SELECT DISTINCT array_to_string(string_split(p_type, ' ')[1:p_partkey % 3 + 1], ' ') AS subject FROM part)
SELECT p_partkey, p_type, max_by(subject, length(subject)) AS prefix FROM part LEFT JOIN s ON p_type = subject OR starts_with(p_type, subject || ' ') GROUP BY ALL"""


def array_any_match_probe(spark, d):
    """Most common words of more than five letters, with their documents, and whether a probe for any of three finds as many."""
    rows = table(spark, d, "documents").select("doc_id", F.array_distinct(text.tokens(F.col("text"), least=6)).alias("refs"))
    top = rows.select("doc_id", F.explode("refs").alias("ref")).groupBy("ref").agg(F.count("*").alias("documents")).orderBy(F.desc("documents"), "ref").limit(10)
    probe = rows.agg(F.count_if(F.arrays_overlap("refs", F.array(F.lit("license"), F.lit("licensed"), F.lit("released")))).alias("probe"))
    return top.crossJoin(probe)


PROBE = f"""WITH r AS (SELECT doc_id, list_distinct(list_filter(regexp_extract_all(lower(text), '{vocab.TOKEN}'), lambda x: length(x) >= 6)) AS refs FROM documents)
SELECT ref, count(*) AS documents, (SELECT count(*) FROM r WHERE list_has_any(refs, ['license', 'licensed', 'released'])) AS probe FROM (SELECT unnest(refs) AS ref FROM r) GROUP BY ref ORDER BY documents DESC, ref LIMIT 10"""


def duplicate_and_consistency(spark, d):
    """Texts that several documents share, and whether they agree on language and source."""
    rows = table(spark, d, "documents").groupBy(F.md5("text").alias("hash")).agg(F.count("*").alias("n"), F.countDistinct("lang").alias("langs"), F.countDistinct("source").alias("sources"), F.min("doc_id").alias("first"))
    return rows.filter("n > 1")


DUPLICATES = "SELECT md5(text) AS hash, count(*) AS n, count(DISTINCT lang) AS langs, count(DISTINCT source) AS sources, min(doc_id) AS first FROM documents GROUP BY 1 HAVING count(*) > 1"


def attempt_selection(spark, d):
    docs = table(spark, d, "documents").select("doc_id")
    tries = docs.select("doc_id", F.explode(F.array(F.lit(1), F.lit(2))).alias("attempt")).withColumn("problems", F.when(F.col("attempt") == 1, F.col("doc_id") % 3).otherwise(F.col("doc_id") % 2))
    return R.best_attempt(tries, ["doc_id"])


ATTEMPT = "SELECT doc_id, CAST(CASE WHEN doc_id % 2 < doc_id % 3 THEN 2 ELSE 1 END AS INTEGER) AS attempt, least(doc_id % 3, doc_id % 2) AS problems FROM documents"


def replay_diff(spark, d):
    docs = table(spark, d, "documents").select("doc_id", "source", "lang", "n_chars")
    again = docs.withColumn("lang", F.when(F.col("doc_id") % 10 == 0, F.lit(None).cast("string")).otherwise(F.col("lang"))).withColumn("n_chars", F.when(F.col("doc_id") % 25 == 0, F.col("n_chars") + 1).otherwise(F.col("n_chars")))
    return R.replay(docs, again, ["doc_id"], ["source", "lang", "n_chars"])


REPLAY = """SELECT doc_id, 'lang' AS field, lang AS stored, NULL::VARCHAR AS again FROM documents WHERE doc_id % 10 = 0 AND lang IS NOT NULL
UNION ALL SELECT doc_id, 'n_chars', n_chars::VARCHAR, (n_chars + 1)::VARCHAR FROM documents WHERE doc_id % 25 = 0"""


def run_totals(spark, d):
    rows = paras(spark, d).join(table(spark, d, "documents").select("doc_id", "source"), "doc_id")
    return rows.rollup("source").agg(F.countDistinct("doc_id").alias("documents"), F.count("*").alias("paragraphs"), F.sum(F.length("text")).alias("chars"), F.round(F.sum(F.length("text")) / vocab.CHARS_PER_TOKEN * 0.1 / 1e6, 9).alias("cost"))


TOTALS = f"WITH {PARAS} SELECT source, count(DISTINCT doc_id) AS documents, count(*) AS paragraphs, CAST(sum(length(p.text)) AS BIGINT) AS chars, round(CAST(sum(length(p.text)) AS DOUBLE) / 4.11 * 0.1 / 1e6, 9) AS cost FROM paras p JOIN documents USING (doc_id) GROUP BY ROLLUP (source)"


def verification_report(spark, d):
    """Violations by kind: short paragraphs, text above the cap, headings at the end, documents without a long paragraph; found in one pass, inside each document's row."""
    p = table(spark, d, "documents").select("doc_id", text.lines(F.col("text")).alias("p")).filter(F.size("p") > 0)
    heading = lambda x: text.is_heading(x)
    fragments = F.size(F.filter("p", lambda x: (F.length(x) < 40) & ~heading(x)))
    over = F.size(F.filter("p", lambda x: F.length(x) > vocab.SIZE_CAP))
    last = heading(F.element_at("p", -1)).cast("int")
    empty = (F.array_max(F.transform("p", lambda x: F.length(x))) < 40).cast("int")
    kinds = [("fragment", "soft", fragments), ("over_cap", "hard", over), ("heading_last", "soft", last), ("no_content", "hard", empty)]
    found = F.array(*[F.struct(F.lit(k).alias("kind"), F.lit(s).alias("severity"), n.cast("long").alias("n")) for k, s, n in kinds])
    rows = p.select(F.explode(F.filter(found, lambda x: x["n"] > 0)).alias("x")).select("x.*")
    return rows.groupBy("kind", "severity").agg(F.sum("n").alias("rows"), F.count("*").alias("documents"))


_HEAD = "length(text) <= 80 AND NOT regexp_matches(text, '[a-zçğıöşüâîûß-öø-ÿ]')"
VERIFY = f"""WITH {PARAS}, p AS (SELECT *, max(para) OVER (PARTITION BY doc_id) AS last FROM paras),
v AS (SELECT 'fragment' AS kind, 'soft' AS severity, doc_id FROM p WHERE length(text) < 40 AND NOT ({_HEAD}) UNION ALL SELECT 'over_cap', 'hard', doc_id FROM p WHERE length(text) > 2000
UNION ALL SELECT 'heading_last', 'soft', doc_id FROM p WHERE para = last AND {_HEAD} UNION ALL SELECT 'no_content', 'hard', doc_id FROM p GROUP BY doc_id HAVING max(length(text)) < 40)
SELECT kind, severity, count(*) AS rows, count(DISTINCT doc_id) AS documents FROM v GROUP BY ALL"""


def stratified_pick(spark, d):
    docs = table(spark, d, "documents").select("doc_id", "lang", "source", "n_chars")
    return R.stratified(docs, "lang", "source", "n_chars", "doc_id", 40, 3)


QUERIES = {f.__name__: f for f in (text_scalars, canonical_and_refs, procedural_penalty, new_penalty_by_unit, title_shape_profile, preflight_verdict, preflight_histogram, riskiest, truncation_loss, acceptance_report, contract_validate, contract_gap_rollup, value_audit, arms_anti_union, export_merge, targeted_merge, scorecard_compare, metadata_json, dissent_longest_prefix, array_any_match_probe, duplicate_and_consistency, attempt_selection, replay_diff, run_totals, verification_report)}
ORACLE_SQL = dict(zip(QUERIES, (TEXT, CANONICAL, PENALTY, NEW_PENALTY, SHAPES, PREFLIGHT, HISTOGRAM, RISKIEST, TRUNCATION, ACCEPTANCE, CONTRACT, ROLLUP, AUDIT, ARMS, EXPORT, TARGETED, SCORECARD, METADATA, PREFIX, PROBE, DUPLICATES, ATTEMPT, REPLAY, TOTALS, VERIFY), strict=True))
PICK = """WITH d AS (SELECT doc_id, lang, source, n_chars FROM documents), l AS (SELECT * FROM d QUALIFY row_number() OVER (PARTITION BY lang ORDER BY n_chars DESC, doc_id) = 1),
r AS (SELECT *, row_number() OVER (PARTITION BY lang, source ORDER BY md5('3:' || doc_id), doc_id) AS turn, md5('3:' || coalesce(lang, '') || ':' || coalesce(source, '')) AS o FROM d ANTI JOIN l USING (doc_id)),
p AS (SELECT * FROM r QUALIFY row_number() OVER (ORDER BY turn, o, lang, source) <= 40 - (SELECT count(*) FROM l))
SELECT doc_id, lang, source, n_chars FROM l UNION ALL SELECT doc_id, lang, source, n_chars FROM p"""
QUERIES["stratified_pick"] = stratified_pick
ORACLE_SQL["stratified_pick"] = PICK
