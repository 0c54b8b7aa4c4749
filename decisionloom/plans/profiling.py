"""Pre-flight, profiles and penalties over all documents, and the SQL that repeats them.  A document gets a record whose fields its number chooses."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from decisionloom.functions import text, vocab
from decisionloom.operators import lexical as L
from decisionloom.operators import preflight as P

from decisionloom.plans.citing import _case, _raw
from decisionloom.plans.tables import table

SOURCES = ["aym", "bam", "danistay", "first_degree", "kvkk", "rekabet", "uyusmazlik", "yargitay"]
STATUS = ["fetched", "completed", "failed"]
HEADINGS = ["", "Olay ve olgular\nHüküm", "DAVA\nCEVAP\nGEREKÇE", "İSTEMİN KONUSU:"]
PHRASES = ["Davanın görevsizlik kararı ile", "Dilekçenin reddine", "dosyanın uzun süre bekletilmesine", "esastan kabulüne", "x"]


def _records(spark, d) -> DataFrame:
    """Raw records: the document's text after headings, by its number, and the fields of _raw."""
    docs = table(spark, d, "documents").select("doc_id", "text")
    doc = F.col("doc_id")
    pick = lambda n, values: F.element_at(F.array(*[F.lit(v) for v in values]), (doc % n + 1).cast("int"))
    fields = _raw(spark, d).drop("paragraphs")
    rows = docs.select("doc_id", F.concat(pick(4, HEADINGS), F.lit("\n"), "text").alias("whole"), pick(3, STATUS).alias("status")).join(fields, "doc_id")
    rows = rows.withColumn("content_text", F.when(doc % 10 > 0, F.col("whole"))).withColumn("html_content", F.when(doc % 20 == 0, F.lit("<p>x</p>")))
    return rows.withColumn("paragraphs", F.coalesce(text.lines(F.col("content_text")), F.array().cast("array<string>")))


def preflight_records(spark, d) -> DataFrame:
    """Problems, warnings and verdict of each record."""
    out = P.examined(_records(spark, d))
    return out.select("doc_id", "verdict", F.array_join("problems", ",").alias("problems"), F.array_join("warnings", ",").alias("warnings"), "output_tokens", "input_tokens")


_HEAD = _case(4, [h.replace("\n", "\\n") for h in HEADINGS]).replace("\\n", "' || chr(10) || '")
_FOLD = f"upper(translate(body, '{vocab.DEACCENT_FROM}', '{vocab.DEACCENT_TO}'))"
_FOUND = "CASE s " + " ".join(f"WHEN '{k}' THEN list_filter([{', '.join(repr(m) for m in v)}], lambda m: contains({_FOLD}, m))" for k, v in P.MARKERS.items()) + " END"
_RAW = f"""w AS (SELECT doc_id, {_HEAD} || chr(10) || text AS whole, {_case(3, STATUS)} AS status, {_case(8, SOURCES)} AS s, doc_id % 6 AS m, CASE WHEN doc_id % 3 = 0 THEN 2020 WHEN doc_id % 3 = 2 THEN 0 END AS ey, CASE WHEN doc_id % 2 = 0 THEN 2022 END AS ky FROM documents),
v AS (SELECT *, CASE WHEN doc_id % 10 > 0 THEN whole END AS t FROM w),
q AS (SELECT *, list_filter(list_transform(string_split(t, chr(10)), lambda x: trim(regexp_replace(x, '\\s+', ' ', 'g'))), lambda x: x <> '') AS p FROM v),
b AS (SELECT *, coalesce(trim(t), '') <> '' AS there, array_to_string(p, ' ') AS body, len(p) AS n, len(list_filter(p, lambda x: regexp_matches(x, '[;:]\\s*$'))) AS o, coalesce(list_sum(list_transform(p, lambda x: length(x))), 0) AS c, length(t) * 0.35::DOUBLE AS out FROM q),
f AS (SELECT *, {_FOUND} AS found, there AND n > 0 AND c < 700 AND o >= 2 AS hollow,
  CASE WHEN s = 'kvkk' THEN m IN (2, 3, 5) OR ky IS NOT NULL WHEN s = 'rekabet' THEN m IN (2, 3, 5) ELSE coalesce(ey, 0) <> 0 END AS has_case, m IN (2, 3) OR regexp_matches(coalesce(t, ''), '(?i)[0-9]{{1,2}}[./][0-9]{{1,2}}[./][0-9]{{4}}\\s*(?:tarihinde|gününde)') AS has_date FROM b)"""
PREFLIGHT = f"""WITH {_RAW}, g AS (SELECT *, list_filter([CASE WHEN status = 'failed' THEN 'status' END, CASE WHEN NOT there AND doc_id % 20 = 0 THEN 'wrong column' END, CASE WHEN NOT there AND doc_id % 20 <> 0 THEN 'no text' END, CASE WHEN there AND n <= 1 THEN 'one paragraph' END, CASE WHEN hollow THEN 'hollow' END,
    CASE WHEN there AND ey IS NULL AND ky IS NULL THEN 'no year' END, CASE WHEN there AND out > 65535 THEN 'output too long' END], lambda x: x IS NOT NULL) AS problems,
  list_filter([CASE WHEN there AND n BETWEEN 2 AND 3 THEN 'few paragraphs' END, CASE WHEN there AND n > 0 AND NOT hollow AND o >= greatest(3, n // 2) THEN 'open ends' END, CASE WHEN there AND len(found) = 0 THEN 'no marker' END, CASE WHEN there AND len(found) = 1 THEN 'one marker' END,
    CASE WHEN there AND s NOT IN ('aym', 'kvkk') AND doc_id % 5 IN (2, 4) THEN 'no chamber' END, CASE WHEN there AND out > 49151.25 AND out <= 65535 THEN 'long output' END, CASE WHEN there AND NOT has_date THEN 'no date' END, CASE WHEN there AND NOT has_case THEN 'no case number' END], lambda x: x IS NOT NULL) AS warnings FROM f)
SELECT doc_id, CASE WHEN len(problems) > 0 THEN 'RED' WHEN len(warnings) > 0 THEN 'AMBER' ELSE 'GREEN' END AS verdict, coalesce(array_to_string(problems, ','), '') AS problems, coalesce(array_to_string(warnings, ','), '') AS warnings, CAST(floor(coalesce(out, 0)) AS BIGINT) AS output_tokens, CAST(floor(coalesce(length(t), 0) / 4.11) AS BIGINT) AS input_tokens FROM g"""


def preflight_findings(spark, d) -> DataFrame:
    """The twelve most common problems and warnings."""
    return P.common_findings(P.examined(_records(spark, d))).select("level", "name", "documents")


FINDINGS = f"""WITH x AS ({PREFLIGHT}), y AS (SELECT 'problems' AS level, unnest(string_split(problems, ',')) AS name FROM x WHERE problems <> '' UNION ALL SELECT 'warnings', unnest(string_split(warnings, ',')) FROM x WHERE warnings <> ''),
z AS (SELECT level, name, count(*) AS documents FROM y GROUP BY ALL) SELECT level, name, documents FROM z QUALIFY row_number() OVER (PARTITION BY level ORDER BY documents DESC, name) <= 12"""


def archetype_profile(spark, d) -> DataFrame:
    """Documents by title shape and headings, within their source."""
    return P.archetypes(_records(spark, d))


_TITLES = ["#. Hukuk Dairesi", "#. Ceza Dairesi Başkanlığı", "Vergi Dava Daireleri Kurulu #/# E. ,#/# K.", "#. Daire", "(no title)"]
_KEYS = ["", "", "decision_date,decision_number_raw", "decision_number_raw,examined_norms", "examination_results", "application_type,decision_number_raw"]
_NEED = "CASE s " + " ".join(f"WHEN '{k}' THEN {max(2, len(v) // 3)}" for k, v in P.MARKERS.items()) + " END"
ARCHETYPES = f"""WITH {_RAW}, g AS (SELECT doc_id, s, {_case(5, _TITLES)} AS shape, coalesce(array_to_string(coalesce(found, []), ', '), '') AS markers, {_case(6, _KEYS)} AS keys, coalesce(ky, ey) AS y, found, {_NEED} AS need FROM f),
k AS (SELECT s, shape, markers, keys, count(*) AS n, min(doc_id) AS e FROM g GROUP BY ALL), m AS (SELECT s, shape, markers, keys FROM k QUALIFY row_number() OVER (PARTITION BY s, shape, markers ORDER BY n DESC, e) = 1),
a AS (SELECT s, shape, markers, count(*) AS documents, min(y) AS least, max(y) AS last, min(doc_id) AS example, any_value(need) IS NULL OR coalesce(max(len(found)), -1) >= any_value(need) AS covered FROM g GROUP BY ALL)
SELECT s AS source, shape, markers, documents, keys, CAST(least AS INTEGER) AS least, CAST(last AS INTEGER) AS last, example, CAST(floor(documents * 100 / sum(documents) OVER (PARTITION BY s)) AS INTEGER) AS share, covered FROM a JOIN m USING (s, shape, markers)"""


def metadata_audit(spark, d) -> DataFrame:
    """What metadata alone gives for each source."""
    return P.metadata_checks(_records(spark, d))


METADATA = f"""WITH {_RAW}, c AS (SELECT *, CASE WHEN s = 'kvkk' THEN CASE WHEN m = 2 THEN '2020/55' ELSE coalesce(CASE WHEN ky IS NOT NULL THEN '2022/9' END, CASE m WHEN 3 THEN '06-90/1142-338' WHEN 5 THEN '...' END) END WHEN s = 'rekabet' THEN CASE m WHEN 2 THEN ': 2020/55' WHEN 3 THEN '06-90/1142-338' WHEN 5 THEN '...' END WHEN ey = 2020 THEN '2020/7' END AS cn FROM f),
g AS (SELECT s, count(*) FILTER (cn IS NULL) AS a, count(cn) - count(DISTINCT cn) AS b, count(*) FILTER (cn IS NOT NULL AND NOT (CASE WHEN s = 'rekabet' THEN cn = '06-90/1142-338' ELSE regexp_full_match(cn, '[0-9]{{4}}/[0-9]+') END)) AS c, count(*) FILTER (m NOT IN (2, 3)) AS e, count(*) FILTER (there OR doc_id % 20 = 0) AS t FROM c GROUP BY s)
SELECT s AS source, unnest(['case_no_missing', 'case_no_repeated', 'case_no_malformed', 'date_missing', 'date_malformed', 'with_text']) AS "check", unnest([a, b, c, e, 0, t]) AS count FROM g"""


def procedural_texts(spark, d) -> DataFrame:
    """Documents with a phrase before them: why they rule on procedure alone, how much of the text the phrase is, and the score left of 1."""
    doc = F.col("doc_id")
    said = F.element_at(F.array(*[F.lit(p) for p in PHRASES]), (doc % 5 + 1).cast("int"))
    rows = table(spark, d, "documents").select("doc_id", F.concat(said, F.lit(" "), "text").alias("text"), F.lit(1.0).alias("score"))
    return P.penalised(rows).select("doc_id", "procedural_reason", F.round(P.phrase_density(F.col("text")), 9).alias("density"), "score")


PROCEDURAL = f"""WITH p AS (SELECT doc_id, doc_id % 5 AS k, length({_case(5, PHRASES)}) + 1 + length(text) AS n FROM documents)
SELECT doc_id, CASE WHEN k = 0 THEN 'jurisdictional' WHEN k < 3 THEN 'procedural' END AS procedural_reason, round(CASE k WHEN 0 THEN length('görevsizlik kararı') WHEN 1 THEN length('dilekçenin reddine') WHEN 2 THEN length('dosyanın uzun süre bekletilmesine') ELSE 0 END / n, 9) AS density, CASE WHEN k < 3 THEN 0.4::DOUBLE ELSE 1.0::DOUBLE END AS score FROM p"""


def turkish_terms(spark, d) -> DataFrame:
    """Terms of whole texts by the Turkish rules: lower case with both i, no stop words, no single letters."""
    docs = table(spark, d, "documents").select("doc_id", F.concat("text", F.lit(" İLE ILIK hâlâ mahkûm o VE için")).alias("text"))
    terms = text.tokens(F.col("text"), vocab.TURKISH_TOKEN, vocab.TURKISH_STOP, turkish=True)
    return docs.select("doc_id", terms.alias("t")).select("doc_id", F.size("t").alias("terms"), F.size(F.array_distinct("t")).alias("distinct"), F.md5(F.array_join("t", " ")).alias("hash"))


_STOP = ", ".join(f"'{w}'" for w in vocab.TURKISH_STOP)
TURKISH = f"""WITH t AS (SELECT doc_id, list_filter(regexp_extract_all(regexp_replace(lower(translate(text || ' İLE ILIK hâlâ mahkûm o VE için', 'İI', 'iı')), '\\p{{M}}', '', 'g'), '{vocab.TURKISH_TOKEN}'), lambda x: length(x) > 1 AND x NOT IN ({_STOP})) AS t FROM documents)
SELECT doc_id, CAST(len(t) AS INTEGER) AS terms, CAST(len(list_distinct(t)) AS INTEGER) AS distinct, md5(array_to_string(t, ' ')) AS hash FROM t"""


def longest_shared_runs(spark, d) -> DataFrame:
    """For each item and the least document that quotes it: the longest run of words that both hold, up to eight words, and of distinct words, stopping at the first length that none shares."""
    docs, items = table(spark, d, "documents"), table(spark, d, "benchmark")
    right = L.quoting(items, docs, "item_id", "doc_id").groupBy("item_id").agg(F.min("doc_id").alias("doc_id"))
    words = lambda c: text.tokens(F.col(c), least=1)
    rows = items.join(right, "item_id").join(docs.select("doc_id", F.col("text").alias("body")), "doc_id").select("item_id", words("text").alias("a"), words("body").alias("b"))
    rows = rows.withColumn("q", F.array_distinct("a"))
    return rows.select("item_id", text.longest_shared(F.col("a"), F.col("b"), 8, stop_early=False).alias("run"), text.longest_shared(F.col("q"), F.col("b"), 12).alias("distinct_run"))


_GRAMS = lambda w, n: f"list_distinct(list_transform(range(1, greatest(len({w}) - {n} + 2, 1)), lambda i: array_to_string({w}[i:i + {n} - 1], ' ')))"
_HIT = lambda w, n: f"coalesce(list_has_any({_GRAMS(w, n)}, {_GRAMS('b', n)}), false)"
SHARED = f"""WITH r AS (SELECT item_id, any_value(x.text) AS t, min(doc_id) AS doc_id FROM benchmark x JOIN documents d ON contains(d.text, x.text) GROUP BY item_id),
w AS (SELECT item_id, regexp_extract_all(lower(t), '{vocab.TOKEN}') AS a, regexp_extract_all(lower(d.text), '{vocab.TOKEN}') AS b FROM r JOIN documents d USING (doc_id)),
q AS (SELECT *, list_transform(list_filter(list_zip(a, range(1, len(a) + 1)), lambda z: list_position(a, z[1]) = z[2]), lambda z: z[1]) AS q FROM w)
SELECT item_id, CAST(CASE {" ".join(f"WHEN {_HIT('a', n)} THEN {n}" for n in range(8, 0, -1))} ELSE 0 END AS INTEGER) AS run, CAST(CASE {" ".join(f"WHEN NOT {_HIT('q', n)} THEN {n - 1}" for n in range(1, 13))} ELSE 12 END AS INTEGER) AS distinct_run FROM q"""

QUERIES = {f.__name__: f for f in (preflight_records, preflight_findings, archetype_profile, metadata_audit, procedural_texts, turkish_terms, longest_shared_runs)}
ORACLE_SQL = dict(zip(QUERIES, (PREFLIGHT, FINDINGS, ARCHETYPES, METADATA, PROCEDURAL, TURKISH, SHARED), strict=True))
