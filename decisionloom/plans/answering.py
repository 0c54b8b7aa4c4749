"""Requests and stored answers over all documents, and the SQL that repeats them.  Answers are made from the document's number, right and wrong."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from decisionloom.operators import chunking as C
from decisionloom.operators import requests as Q
from decisionloom.operators import verification as V
from decisionloom.plans import stored
from decisionloom.plans.chunking import LENGTHS, PARAS, paras
from decisionloom.plans.tables import table
from decisionloom.sources import answers as A
from decisionloom.sources.folders import kept


def request_table(spark, d) -> DataFrame:
    """What would be sent for each document: structure, capsules, and windows of laws of at most 20 paragraphs and 4,000 characters."""
    p = paras(spark, d)
    listed = C.ordered(p, ["doc_id"], "para", "text").withColumnRenamed("values", "paragraphs")
    docs = listed.join(table(spark, d, "documents").select("doc_id", "source", F.col("lang").alias("kind"), F.col("doc_id").cast("string").alias("case_no")), "doc_id")
    out = Q.prepared(docs, 20, 4000)
    return out.select("doc_id", "request_key", "window_lo", "window_hi", F.length("content").cast("long").alias("chars"), "predicted")


REQUESTS = f"""WITH RECURSIVE {LENGTHS},
f AS (SELECT doc_id, l, 1 AS i, 1 AS g, 1 AS n, l[1] AS used FROM ln
  UNION ALL SELECT doc_id, l, i + 1, CASE WHEN n >= 20 OR used + l[i + 1] > 4000 THEN g + 1 ELSE g END, CASE WHEN n >= 20 OR used + l[i + 1] > 4000 THEN 1 ELSE n + 1 END, CASE WHEN n >= 20 OR used + l[i + 1] > 4000 THEN l[i + 1] ELSE used + l[i + 1] END FROM f WHERE i < len(l)),
x AS (SELECT doc_id, i, g, l[i] AS c, l[i] + length('[p' || i::VARCHAR || '] ') AS line FROM f),
w AS (SELECT doc_id, 'laws_' || g::VARCHAR AS request_key, min(i) AS lo, max(i) AS hi, sum(c) AS c, sum(line) + count(*) - 1 AS lines FROM x GROUP BY doc_id, g
  UNION ALL SELECT doc_id, k, 1, max(i), sum(c), sum(line) + count(*) - 1 FROM x, (VALUES ('structure'), ('capsules')) v(k) GROUP BY doc_id, k)
SELECT w.doc_id, request_key, CAST(lo AS INTEGER) AS window_lo, CAST(hi AS INTEGER) AS window_hi,
  CAST(lines + 2 + length(chr(10) || '## This document' || chr(10) || chr(10) || 'source_type: ' || source || chr(10) || 'kind: ' || lang || chr(10) || 'case_no: ' || w.doc_id::VARCHAR) AS BIGINT) AS chars, CAST(ceil(c * 0.35) AS INTEGER) AS predicted
FROM w JOIN documents d ON d.doc_id = w.doc_id"""


def _attempts(spark, d) -> DataFrame:
    """Up to three attempts at one request: good, unreadable, truncated or refused, by the document's number."""
    doc = F.col("doc_id")
    one = lambda n, raw, finish, error: F.struct(F.lit(n).alias("attempt"), F.lit(raw).cast("string").alias("raw_json"), F.lit(finish).cast("string").alias("finish"), F.lit(error).cast("string").alias("error"))
    good, bad, cut, refused = ('{"a":1}', "STOP", None), ("{not", "STOP", None), ('{"a":', "MAX_TOKENS", None), (None, None, "500 server error")
    forms = [(good,), (bad, good), (bad, cut, good), (bad, bad, good), (refused, refused), (cut, cut, cut)]
    made = [F.array(*[one(i, *f) for i, f in enumerate(form, 1)]) for form in forms]
    chosen = made[-1]
    for k, m in enumerate(made[:-1]):
        chosen = F.when(doc % 6 == k, m).otherwise(chosen)
    return table(spark, d, "documents").select("doc_id", F.lit("structure").alias("request_key"), F.explode(chosen).alias("x")).select("doc_id", "request_key", "x.*")


def attempt_outcomes(spark, d) -> DataFrame:
    """The attempt that counts, the last error where none does, and how many retries were noted."""
    out = Q.outcomes(_attempts(spark, d))
    return out.select("doc_id", "attempt", "raw_json", "error", F.size("notes").alias("retries"))


OUTCOMES = """SELECT doc_id, CAST(CASE doc_id % 6 WHEN 0 THEN 1 WHEN 1 THEN 2 WHEN 2 THEN 3 END AS INTEGER) AS attempt, CASE WHEN doc_id % 6 < 3 THEN '{"a":1}' END AS raw_json,
  CASE doc_id % 6 WHEN 3 THEN 'no answer' WHEN 4 THEN '500 server error' WHEN 5 THEN 'truncated' END AS error, CAST(CASE doc_id % 6 WHEN 0 THEN 0 WHEN 1 THEN 1 WHEN 2 THEN 2 WHEN 3 THEN 2 WHEN 4 THEN 2 ELSE 3 END AS INTEGER) AS retries FROM documents"""


def failed_call_issues(spark, d) -> DataFrame:
    """What documents lack for want of an answer."""
    return Q.failed_calls(Q.outcomes(_attempts(spark, d)))


FAILED = """SELECT doc_id, 'fallback_no_model' AS kind, 'hard' AS severity, 'structure:' || CASE doc_id % 6 WHEN 3 THEN 'no answer' WHEN 4 THEN '500 server error' ELSE 'truncated' END AS detail FROM documents WHERE doc_id % 6 >= 3"""


def _sizes(spark, d) -> DataFrame:
    return paras(spark, d).groupBy("doc_id").agg(F.max("para").alias("n"))


def laws_answers(spark, d) -> DataFrame:
    """Windows of five paragraphs: each answer names its first paragraph, one outside the window and one that can't be read; references that don't fit, paragraphs not answered, and citations."""
    n = _sizes(spark, d)
    lo = F.explode(F.transform(F.sequence(F.lit(0), F.floor((F.col("n") - 1) / 5).cast("int")), lambda k: 5 * k + 1))
    rows = n.select("doc_id", "n", lo.alias("window_lo")).withColumn("window_hi", F.least(F.col("window_lo") + 4, F.col("n")))
    ref = lambda c: F.concat(F.lit('{"ref":"p'), c.cast("string"), F.lit('","cited_legislations":[{"law_no":"6100"},{"law_no":"6098"}]}'))
    raw = F.concat(F.lit('{"paragraphs":['), F.concat_ws(",", ref(F.col("window_lo")), ref(F.col("window_hi") + 1), F.lit('{"ref":"zz"}')), F.lit("]}"))
    parsed = A.parsed(rows.select("doc_id", "window_lo", "window_hi", raw.alias("raw_json")))
    cites, counts = A.laws_by_paragraph(parsed, n)
    found = cites.groupBy("doc_id").agg(F.count("*").alias("citations"), F.countDistinct("para").alias("paragraphs"))
    return counts.groupBy("doc_id").agg(F.sum("invalid").alias("invalid"), F.sum("unanswered").alias("unanswered")).join(found, "doc_id", "left")


LAWS = f"""WITH {PARAS}, n AS (SELECT doc_id, max(para) AS n FROM paras GROUP BY doc_id), k AS (SELECT doc_id, n, (n + 4) // 5 AS w FROM n)
SELECT doc_id, CAST(2 * w AS BIGINT) AS invalid, CAST(n - w AS BIGINT) AS unanswered, CAST(2 * w AS BIGINT) AS citations, CAST(w AS BIGINT) AS paragraphs FROM k"""


def saved_answers(spark, d) -> DataFrame:
    """Capsules saved in their own answer or, by older runs, inside the structure answer: how many, and the paragraphs they rest on."""
    doc = F.col("doc_id")
    docs = table(spark, d, "documents").select("doc_id")
    segments = '"segments":[{"local_id":"a","paragraph_refs":["p1","p2"]},{"local_id":"b","paragraph_refs":["p3"]}]'
    older = f'{{{segments},"capsules":[{{"outcome":"denied","supporting_local_ids":["b","a"]}},{{"outcome":"other","supporting_local_ids":["none"]}}]}}'
    structures = A.parsed(docs.select("doc_id", F.when(doc % 3 == 0, F.lit(older)).otherwise(F.lit(f"{{{segments}}}")).alias("raw_json")))
    own = '{"capsules":[{"outcome":"granted","supporting_paragraph_refs":["p1"]}]}'
    capsules = A.parsed(docs.select("doc_id", F.when(doc % 3 == 1, F.lit(own)).otherwise(F.lit("{broken")).alias("raw_json")))
    return A.saved_capsules(structures, capsules).select("doc_id", "pos", "capsule.outcome", F.array_join("capsule.supporting_paragraph_refs", ",").alias("refs"))


SAVED = "SELECT doc_id, CAST(0 AS INTEGER) AS pos, CASE WHEN doc_id % 3 = 0 THEN 'denied' ELSE 'granted' END AS outcome, CASE WHEN doc_id % 3 = 0 THEN 'p3,p1,p2' ELSE 'p1' END AS refs FROM documents WHERE doc_id % 3 < 2"


def corrective_requests(spark, d) -> DataFrame:
    """Corrective requests for the broken run: by request, documents and remarks; documents whose structure call failed get none."""
    rows = kept(stored.decisions(spark, d))  # texts are cut once
    issues = V.document_issues(*stored.broken(stored.stored_chunks(rows), stored.stored_capsules(rows)), rows)
    fell = Q.failed_calls(Q.outcomes(_attempts(spark, d)))
    return Q.corrections(issues, fell).groupBy("request_key", "note").agg(F.count("*").alias("documents"))


_REMARKS = ", ".join(f"('{k}', '{key}', '{note.replace(chr(39), chr(39) * 2)}')" for k, (key, note) in Q.CORRECTIONS.items())
CORRECTIVE = f"""WITH {stored._BASE}{stored._ISSUES.rstrip()}, r(kind, request_key, note) AS (VALUES {_REMARKS}),
said AS (SELECT DISTINCT doc_id, request_key, note FROM (SELECT doc_id, CASE WHEN kind LIKE '%not_in_decision_language' THEN 'not_in_decision_language' ELSE kind END AS kind FROM i WHERE run = 'broken' AND issues > 0) JOIN r USING (kind) WHERE doc_id % 6 < 3),
o AS (SELECT doc_id, request_key, string_agg(note, ' ' ORDER BY note) AS note FROM said GROUP BY ALL)
SELECT request_key, note, count(*) AS documents FROM o GROUP BY ALL"""


def token_costs(spark, d) -> DataFrame:
    """Requests, tokens and cost by kind of request, and in total."""
    r = request_table(spark, d).select("request_key", F.floor(F.col("chars") / 4).cast("long").alias("tokens_in"), F.col("predicted").cast("long").alias("tokens_out"))
    return Q.costs(r, A.Settings.of(spark).cost)


COSTS = f"""SELECT CASE WHEN grouping(request) = 0 THEN request END AS request, count(*) AS requests, CAST(sum(tokens_in) AS BIGINT) AS tokens_in, CAST(sum(tokens_out) AS BIGINT) AS tokens_out, round((sum(tokens_in) * 0.1::DOUBLE + sum(tokens_out) * 0.4::DOUBLE) / 1e6, 9) AS cost
FROM (SELECT regexp_replace(request_key, '_[0-9]+$', '') AS request, CAST(floor(chars / 4) AS BIGINT) AS tokens_in, CAST(predicted AS BIGINT) AS tokens_out FROM ({REQUESTS})) GROUP BY ROLLUP (request)"""


def capsule_repair(spark, d) -> DataFrame:
    """Capsules of the broken run whose support doesn't fit: a majority without dissents, a dissent on dissents alone; what is left of it."""
    rows = stored.decisions(spark, d)
    c, k = stored.broken(stored.stored_chunks(rows), stored.stored_capsules(rows))
    return Q.repaired_support(k, c).select("doc_id", "capsule_index", F.size("supporting_chunk_ids").alias("support"), "repair")


REPAIR = f"""WITH {PARAS}, b AS (SELECT doc_id, doc_id % 20 AS m, doc_id % 4 = 0 AS dis FROM paras WHERE para = 1),
k AS (SELECT doc_id, m, 0 AS capsule_index FROM b WHERE m <> 16 UNION ALL SELECT doc_id, m, 1 FROM b WHERE dis AND m <> 12)
SELECT doc_id, CAST(capsule_index AS INTEGER) AS capsule_index, CAST(CASE WHEN capsule_index = 1 THEN 1 WHEN m = 0 THEN 1 WHEN m = 2 THEN 0 ELSE 2 END AS INTEGER) AS support, CAST(CASE WHEN capsule_index = 0 AND m = 0 THEN 1 ELSE 0 END AS INTEGER) AS repair FROM k"""


def merged_claims(spark, d) -> DataFrame:
    """Capsules written twice, with white space and authors apart: one each."""
    doc = F.col("doc_id")
    one = lambda pos, conclusion, author, ref: F.struct(F.lit(pos).alias("pos"), F.lit(conclusion).alias("conclusion"), F.array(F.lit(author)).alias("authors"), F.array(F.lit(ref), F.lit("p1")).alias("refs"))
    claims = table(spark, d, "documents").select("doc_id", F.explode(F.array(one(0, "a  b", "X", "p2"), one(1, "a b ", "Y", "p3"), one(2, "c", "X", "p2"))).alias("x"))
    claims = claims.select("doc_id", "x.*", F.when(doc % 2 == 0, "denied").otherwise(F.concat(F.lit("o"), F.col("x.pos").cast("string"))).alias("outcome"))
    out = Q.merged_capsules(claims)
    return out.select("doc_id", "pos", "outcome", "conclusion", F.array_join("authors", ",").alias("authors"), F.array_join("refs", ",").alias("refs"), "merged")


MERGED = """WITH f(k, pos, conclusion, authors, refs, merged) AS (VALUES (0, 0, 'a  b', 'X,Y', 'p2,p1,p3', 1), (0, 2, 'c', 'X', 'p2,p1', 0), (1, 0, 'a  b', 'X', 'p2,p1', 0), (1, 1, 'a b ', 'Y', 'p3,p1', 0), (1, 2, 'c', 'X', 'p2,p1', 0))
SELECT doc_id, CAST(pos AS INTEGER) AS pos, CASE WHEN k = 0 THEN 'denied' ELSE 'o' || pos::VARCHAR END AS outcome, conclusion, authors, refs, CAST(merged AS INTEGER) AS merged FROM documents JOIN f ON doc_id % 2 = k"""


def points_verified(spark, d) -> DataFrame:
    """Checks of the stored vectors: count, keys, length, norm, and a probe for a field's most common value."""
    e = table(spark, d, "embeddings").select(F.col("vec_id").alias("id"), F.col("embedding").alias("vector"), "label")
    width = F.size("vector")
    return A.verify_points(e, e.count(), e.select(width.alias("w")).first()["w"], ["label"])


POINTS = """WITH s AS (SELECT count(*) AS n, count(DISTINCT vec_id) AS k, count(*) FILTER (len(embedding) <> (SELECT len(embedding) FROM embeddings LIMIT 1)) AS odd, count(*) FILTER (abs(sqrt(list_dot_product(embedding::DOUBLE[], embedding::DOUBLE[])) - 1) > 1e-3) AS long FROM embeddings),
l AS (SELECT count(*) AS c FROM embeddings GROUP BY label ORDER BY c DESC, label LIMIT 1)
SELECT 'count' AS "check", true AS ok, n AS detail FROM s UNION ALL SELECT 'unique keys', k = n, k FROM s UNION ALL SELECT 'vector size', odd = 0, odd FROM s UNION ALL SELECT 'unit vectors', long = 0, long FROM s UNION ALL SELECT 'field label', c > 0, c FROM l"""


def normalised_segments(spark, d) -> DataFrame:
    """Segments of faulty answers, put right: ownership, order, fragments and rulings joined, and where the absorbed ones went."""
    p = paras(spark, d)
    return Q.normalised(answered_segments(p), p).select("doc_id", "seg", "role", F.array_join("refs", ",").alias("refs"), F.array_join("absorbed", ",").alias("absorbed"))


def answered_segments(p: DataFrame) -> DataFrame:
    """A paragraph a segment, every fourth also listed by the next; roles in runs."""
    seg = (F.col("para") - 1).cast("long")
    roles = F.element_at(F.array(*[F.lit(r) for r in ("facts", "facts", "conclusion", "conclusion", "issue")]), (seg % 5 + 1).cast("int"))
    own = p.select("doc_id", seg.alias("seg"), roles.alias("role"), "para")
    again = own.filter("para % 4 = 0").withColumn("seg", F.col("seg") + 1).withColumn("role", F.element_at(F.array(*[F.lit(r) for r in ("facts", "facts", "conclusion", "conclusion", "issue")]), (F.col("seg") % 5 + 1).cast("int")))
    return own.unionByName(again)


QUERIES = {f.__name__: f for f in (request_table, attempt_outcomes, failed_call_issues, laws_answers, saved_answers, corrective_requests, token_costs, capsule_repair, merged_claims, points_verified, normalised_segments)}
ORACLE_SQL = {
    "request_table": REQUESTS, "attempt_outcomes": OUTCOMES, "failed_call_issues": FAILED, "laws_answers": LAWS, "saved_answers": SAVED, "corrective_requests": CORRECTIVE, "token_costs": COSTS, "capsule_repair": REPAIR, "merged_claims": MERGED,
    "points_verified": POINTS,
}
