"""Citations and record fields over all documents, and the SQL that repeats them.

Documents hold no laws, so each gets a sentence, an answer or metadata of a form that its number
chooses; the SQL says for each form what must come of it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from decisionloom.functions import ids, legal, legislation, text, vocab
from decisionloom.operators import chunking as K
from decisionloom.operators import citations as C
from decisionloom.plans.chunking import PARAS
from decisionloom.plans.stored import DISSENTING, RULING, decisions
from decisionloom.plans.tables import table

#: A sentence for each residue by 8; {n} is a number of four digits.
SENTENCES = [
    "3/7/2005 tarihli ve {n} sayılı Belediye Kanunu'nun 15. maddesinin (2) numaralı fıkrası", "{n} sayılı Türk Borçlar Kanunu'nun Geçici Madde 3 hükmü", "{n} sayılı Kanun'un 141/A maddesi",
    "{n} sayılı Kanun'un 23'üncü maddesinin ikinci fıkrası", "{n} sayılı Kanun Hükmünde Kararname'nin 7. maddesi", "Anayasa'nın 36. maddesinin (1) numaralı fıkrası", "{n} sayılı Dernekler Kanunu uyarınca", "hiçbir atıf yok",
]


def _number(doc):
    return (1000 + doc % 9000).cast("string")


def citation_extract(spark, d) -> DataFrame:
    """Laws that whole texts cite, each followed by its sentence."""
    docs = table(spark, d, "documents")
    forms = F.array(*[F.lit(s) for s in SENTENCES])
    said = F.replace(F.element_at(forms, (F.col("doc_id") % 8 + 1).cast("int")), F.lit("{n}"), _number(F.col("doc_id")))
    rows = legislation.cited(docs, ["doc_id"], F.concat(F.col("text"), F.lit(". "), said))
    return rows.select("doc_id", "canonical_id", "legislation_type", "law_no", "law_name", "article_no", "paragraph_no", "law_date", "confidence")


EXTRACT = """WITH d AS (SELECT doc_id, doc_id % 8 AS k, (1000 + doc_id % 9000)::VARCHAR AS n FROM documents),
f(k, tail, type, has_no, name, article, para, date, conf) AS (VALUES
  (0, 'art-15-p2', 'statute', true, 'Belediye', '15', '2', '2005-07-03', 'high'), (1, 'art-geçici-3', 'statute', true, 'Türk Borçlar', 'Geçici 3', NULL, NULL, 'high'),
  (2, 'art-141-a', 'statute', true, NULL, '141/A', NULL, NULL, 'high'), (3, 'art-23-p2', 'statute', true, NULL, '23', '2', NULL, 'high'), (4, 'art-7', 'decree_law', true, NULL, '7', NULL, NULL, 'high'),
  (5, 'constitution-art-36-p1', 'constitution', false, 'Türkiye Cumhuriyeti Anayasası', '36', '1', NULL, 'high'), (6, 'unknown-article', 'statute', true, 'Dernekler', NULL, NULL, NULL, 'low'))
SELECT doc_id, CASE WHEN has_no THEN 'law-' || n || '-' || tail ELSE tail END AS canonical_id, type AS legislation_type, CASE WHEN has_no THEN n END AS law_no, name AS law_name, article AS article_no, para AS paragraph_no, date AS law_date, conf AS confidence FROM d JOIN f USING (k)"""


def _answers(rows: DataFrame) -> DataFrame:
    """A citation of the law's paragraph for each decision, right or wrong in one of twelve ways."""
    doc = F.col("doc_id")
    no, art = _number(doc), (1 + doc % 40).cast("string")
    quote = F.concat(no, F.lit(" sayılı Örnek Kanunu'nun "), art, F.lit(". maddesi"))
    none = F.lit(None).cast("string")
    forms = [
        ("statute", no, none, F.lit("Örnek Kanunu"), art, quote), ("not_legislation", no, none, none, art, quote), ("treaty", none, none, none, art, quote), ("statute", none, none, none, F.lit("999999"), none),
        ("statute", no, none, none, art, F.lit("başka bir söz")), ("constitution", art, none, none, none, quote), ("statute", none, none, none, art, quote), ("statute", F.lit("99999999"), none, none, art, none),
        ("statute", no, F.lit("xyz"), none, art, F.lit("  ")), ("statute", no, none, F.lit("Olmayan Bir Kanun"), art, none), ("constitution", none, none, none, none, F.concat(no, F.lit(" sayılı"))), ("statute", none, none, none, none, F.lit("inceleme yapıldı.")),
    ]
    names = ["legislation_type", "law_no", "law_short", "law_name", "article_no", "verbatim_mention"]
    made = F.array(*[F.struct(*[(F.lit(v) if isinstance(v, str) else v).alias(k) for k, v in zip(names, form, strict=True)]) for form in forms])
    one = F.element_at(made, (doc % 12 + 1).cast("int"))
    return rows.filter("place = 'law'").select("doc_id", "para", one.alias("x")).select("doc_id", "para", "x.*", none.alias("paragraph_no"), none.alias("law_date"))


def citation_cleaning(spark, d) -> DataFrame:
    """What the eleven rules make of an answer's citations, each checked against its paragraph and its document."""
    rows = decisions(spark, d)
    out = C.clean(_answers(rows), rows.select("doc_id", "para", "text"))
    shown = lambda c: F.when(F.col("kept"), F.col(c)).alias(c)
    return out.select("doc_id", F.array_join("rules", ",").alias("rules"), "kept", *[shown(c) for c in ("canonical_id", "law_no", "law_name", "article_no", "verbatim_mention", "confidence")])


CLEANING = f"""WITH {PARAS}, d AS (SELECT DISTINCT doc_id, doc_id % 12 AS k, (1000 + doc_id % 9000)::VARCHAR AS n, (1 + doc_id % 40)::VARCHAR AS a FROM paras),
r(k, rules, kept, has_no, name, has_art, exact) AS (VALUES (0, '', true, true, 'Örnek Kanunu', true, true), (1, 'dropped_non_legislation', false, false, NULL, false, false), (2, 'dropped_treaty', false, false, NULL, false, false),
  (3, 'citation_not_in_its_paragraph', false, false, NULL, false, false), (4, 'verbatim_not_exact_cleared', true, true, NULL, true, false), (5, 'constitution_law_no_cleared', true, false, NULL, true, true), (6, 'law_no_from_quote', true, true, NULL, true, true),
  (7, 'law_no_not_in_document_cleared', true, false, NULL, true, false), (8, 'law_short_rejected', true, true, NULL, true, false), (9, 'law_name_cleared', true, true, NULL, true, false), (10, 'constitution_without_article_dropped', false, false, NULL, false, false),
  (11, 'citation_without_law_or_article_dropped', false, false, NULL, false, false))
SELECT doc_id, rules, kept, CASE WHEN k = 5 THEN 'constitution/' || a WHEN has_no THEN n || '/' || a END AS canonical_id, CASE WHEN has_no THEN n END AS law_no, name AS law_name, CASE WHEN has_art THEN a END AS article_no,
  CASE WHEN exact THEN n || ' sayılı Örnek Kanunu''nun ' || a || '. maddesi' END AS verbatim_mention, CASE WHEN kept THEN 'high' END AS confidence FROM d JOIN r USING (k)"""


def citation_rules(spark, d) -> DataFrame:
    """How often each rule applies."""
    rows = decisions(spark, d)
    out = C.clean(_answers(rows), rows.select("doc_id", "para", "text"))
    return out.select("kept", F.explode("rules").alias("rule")).groupBy("rule", "kept").agg(F.count("*").alias("citations"))


RULES = f"SELECT rules AS rule, kept, count(*) AS citations FROM ({CLEANING}) WHERE rules <> '' GROUP BY ALL"


def laws_named_not_cited(spark, d) -> DataFrame:
    """Laws that decisions name by number and whose citations were dropped, or never given."""
    rows = decisions(spark, d)
    kept = C.clean(_answers(rows), rows.select("doc_id", "para", "text")).filter("kept")
    return C.named_not_cited(rows, kept)


NAMED = f"SELECT doc_id, (1000 + doc_id % 9000)::VARCHAR AS law_no FROM ({CLEANING}) WHERE law_no IS NULL"


def stated_numbers(spark, d) -> DataFrame:
    """Articles, laws and case numbers that the law's paragraph of each decision states, and one in words."""
    rows = decisions(spark, d).filter("place = 'law'")
    said = F.concat("text", F.when(F.col("doc_id") % 3 == 0, F.lit(" Üçüncü madde ve MADDE 7 hükmü.")).otherwise(F.lit("")))
    return rows.select("doc_id", F.array_join(legal.stated_numbers(said), " ").alias("numbers"))


NUMBERS = f"""WITH {PARAS}, d AS (SELECT DISTINCT doc_id FROM paras)
SELECT doc_id, array_to_string(list_sort(list_distinct(['m' || (1 + doc_id % 40)::VARCHAR, 'k' || (1000 + doc_id % 9000)::VARCHAR, 'e' || (2000 + doc_id % 25)::VARCHAR || '/' || doc_id::VARCHAR] || CASE WHEN doc_id % 3 = 0 THEN ['m3', 'm7'] ELSE [] END)), ' ') AS numbers FROM d"""


def legislation_cross_check(spark, d) -> DataFrame:
    """What the pattern finds in each decision against what the answers keep: provisions of one side only."""
    rows = decisions(spark, d)
    kept = C.clean(_answers(rows), rows.select("doc_id", "para", "text")).filter("kept").select("doc_id", F.concat_ws("/", F.coalesce("law_no", "legislation_type"), "article_no").alias("canonical_id"))
    found = legislation.cited(rows.filter("place = 'law'"), ["doc_id"], F.col("text")).select("doc_id", F.concat_ws("/", "law_no", "article_no").alias("canonical_id"))
    out = C.cross_check(found, kept)
    return out.select("doc_id", F.array_join("only_found", ",").alias("only_found"), F.array_join("only_given", ",").alias("only_given"))


CROSS = f"""WITH c AS ({CLEANING}), k AS (SELECT doc_id, (1000 + doc_id % 9000)::VARCHAR || '/' || (1 + doc_id % 40)::VARCHAR AS f, CASE WHEN kept THEN coalesce(law_no, CASE WHEN rules = 'constitution_law_no_cleared' THEN 'constitution' ELSE 'statute' END) || '/' || article_no END AS g FROM c)
SELECT doc_id, CASE WHEN g IS NULL OR g <> f THEN f ELSE '' END AS only_found, CASE WHEN g <> f THEN g ELSE '' END AS only_given FROM k"""

def legislation_coverage(spark, d) -> DataFrame:
    """What of all decisions' paragraphs an index of law references covers, its ten most common ones, and false hits among these."""
    rows = decisions(spark, d).select("doc_id", "para", "text")
    return C.coverage(rows, C.references(rows, ["doc_id", "para"]), ["doc_id", "para"])


COVERAGE = f"""WITH {PARAS}, d AS (SELECT DISTINCT doc_id, (1000 + doc_id % 9000)::VARCHAR AS n, (1 + doc_id % 40)::VARCHAR AS a FROM paras),
r AS (SELECT doc_id, unnest(['law-' || n || '-art-' || a, n, n || '/' || a]) AS ref FROM d), c AS (SELECT ref, count(*) AS k, count(DISTINCT doc_id) AS docs FROM r GROUP BY ref)
SELECT '*' AS ref, (SELECT count(*) FROM d) AS chunks, (SELECT count(*) FROM d) AS documents, (SELECT count(*) FROM c) AS "references", NULL::BIGINT AS false_positives
UNION ALL SELECT * FROM (SELECT ref, k, docs, NULL::BIGINT, 0 FROM c ORDER BY k DESC, ref LIMIT 10)"""

CAP = 300


def citation_pieces(spark, d) -> DataFrame:
    """Citations dealt out to the pieces of segments: a decision is one segment, cut at 300 characters at paragraphs; each provision once a piece."""
    rows = decisions(spark, d).select("doc_id", "para", "text", "place")
    cites = C.clean(_answers(rows), rows.select("doc_id", "para", "text")).filter("kept")
    cites = cites.withColumn("pos", F.explode(F.array(F.lit(0), F.lit(1))))  # every citation twice: one entry a provision stays
    arrays = K.ordered(rows.withColumn("chars", F.length("text")), ["doc_id"], "para", "chars").withColumn("g", K.pack_groups(F.col("values"), CAP))
    groups = arrays.select("doc_id", F.posexplode("g").alias("i", "piece")).select("doc_id", (F.col("i") + 1).alias("para"), "piece")
    joined = rows.join(groups, ["doc_id", "para"]).groupBy("doc_id", "piece").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("para", "text"))), lambda x: x["text"]), " ").alias("text"))
    out = C.to_pieces(cites, joined, rows.select("doc_id", "para", "text"), ["doc_id"])
    last = groups.groupBy("doc_id").agg(F.max("piece").alias("pieces"))
    return out.join(last, "doc_id").groupBy("doc_id", "pieces").agg(F.count("*").alias("citations"), F.max("piece").alias("piece"))


PIECES = f"""WITH RECURSIVE own AS ({CLEANING}), {PARAS}, n AS (SELECT doc_id, max(para) AS n FROM paras GROUP BY doc_id),
more AS (SELECT doc_id, para, length(text) AS x FROM paras
  UNION ALL SELECT doc_id, n + 1, length('ESAS NO: ' || (2000 + doc_id % 25)::VARCHAR || '/' || doc_id::VARCHAR || ' dosyada ' || (1000 + doc_id % 9000)::VARCHAR || ' sayılı Örnek Kanunu''nun ' || (1 + doc_id % 40)::VARCHAR || '. maddesi uyarınca inceleme yapıldı.') FROM n
  UNION ALL SELECT doc_id, n + 2, length('{RULING}') FROM n UNION ALL SELECT doc_id, n + 3, length('{DISSENTING}') FROM n WHERE doc_id % 4 = 0),
l AS (SELECT doc_id, list(x ORDER BY para) AS l FROM more GROUP BY doc_id),
f AS (SELECT doc_id, l, 1 AS i, 1 AS g, l[1] AS used FROM l UNION ALL SELECT doc_id, l, i + 1, CASE WHEN used + 1 + l[i + 1] > {CAP} THEN g + 1 ELSE g END, CASE WHEN used + 1 + l[i + 1] > {CAP} THEN l[i + 1] ELSE used + 1 + l[i + 1] END FROM f WHERE i < len(l))
SELECT doc_id, CAST(max(g) AS INTEGER) AS pieces, CAST(1 AS BIGINT) AS citations, CAST(max(CASE WHEN i = n + 1 THEN g END) AS INTEGER) AS piece FROM f JOIN n USING (doc_id) JOIN own USING (doc_id) WHERE kept GROUP BY doc_id"""


def record_fields(spark, d) -> DataFrame:
    """Fields of raw records, of eight sources and six forms of metadata: case number, date, kind, subject, rights, norms, court."""
    rows = _raw(spark, d)
    kind = legal.kind_of(F.col("source"), F.col("metadata"), F.col("chamber_id"), F.col("title"))
    case = legal.case_no(F.col("source"), F.col("metadata"), F.col("esas_year"), F.col("esas_no"), F.col("karar_year"), F.col("karar_no"))
    content, stage = legal.derived(F.col("role"))
    subject = legal.candidate_subject(F.col("paragraphs"))
    return rows.select(
        "doc_id", case.alias("case_no"), legal.wellformed_case_no(case, F.col("source")).alias("wellformed"), legal.decision_date(F.col("metadata"), F.col("paragraphs")).alias("decision_date"),
        kind.alias("kind"), legal.subject_type(F.col("source"), kind).alias("subject_type"), F.array_join(legal.candidate_rights(F.col("metadata")), ",").alias("rights"), F.coalesce(F.size(legal.examined_norms(F.col("metadata"))), F.lit(0)).alias("norms"),
        F.array_join(legal.metadata_keys(F.col("metadata")), ",").alias("keys"), legal.court(F.col("title"), F.col("source")).alias("court"), ids.chamber(F.col("title")).alias("chamber"),
        legal.legacy_outcome(F.col("outcome")).alias("outcome"), content.alias("content_type"), stage.alias("stage"), subject["value"].alias("subject"), F.array_join(legal.header_cases(F.col("paragraphs")), ",").alias("header"),
        legal.language_of(F.col("said")).alias("language"), ids.article_key(F.col("article")).alias("article"), ids.law_short(F.col("short")).alias("short"), ids.iso_date(F.col("dated")).alias("iso"), ids.fold_opinion(F.lit("dissent"), F.col("authors")).alias("opinion"),
    )


def _raw(spark, d) -> DataFrame:
    docs = table(spark, d, "documents").select("doc_id")
    doc = F.col("doc_id")
    pick = lambda n, values, kind="string": F.element_at(F.array(*[F.lit(v).cast(kind) for v in values]), (doc % n + 1).cast("int"))
    source = pick(8, ["aym", "bam", "danistay", "first_degree", "kvkk", "rekabet", "uyusmazlik", "yargitay"])
    metadata = pick(
        6,
        [
            None, "{bad", '{"data":{"decision_date":"2021-05-06T00:00","decision_number_raw":": 2020/55"}}', '{"decision_date":"7.8.2019","data":{"decision_number_raw":"06-90/1142-338","examined_norms":[{"norm_code_name":" K ","articles":[{"article_no":"1"},{"article_no":"2"}]}]}}',
            '{"data":{"examination_results":[{"right":"Mülkiyet hakkı (genel)"},{"right":"Adil yargılanma"},{"right":"Mülkiyet hakkı"}]}}', '{"data":{"application_type":"itiraz","decision_number_raw":"..."}}',
        ],
    )
    title = pick(5, ["11. Hukuk Dairesi", "3. Ceza Dairesi Başkanlığı", "Vergi Dava Daireleri Kurulu 2021/895 E. ,2022/1662 K.", "77. Daire", None])
    paragraphs = F.array(pick(4, ["ESAS NO : 2016/1359", "Suç : Yaralama", "DAVA TÜRÜ: Alacak", "x"]), pick(3, ["son 5.6.2018 tarihinde karar", "y", "z"]))
    outcome = pick(7, ["red", "granted", "geri_cevirme", "Claim_granted", "nothing known", None, "affirmed"])
    role = pick(6, ["facts", "conclusion", "dissent", "outcome", "rule", "unknown"])
    said = pick(4, ["Davanın reddine karar verilmiştir.", "the court of the state and the applicant", "xyz qrs", ""])
    return docs.select(
        "doc_id", source.alias("source"), metadata.alias("metadata"), title.alias("title"), paragraphs.alias("paragraphs"), outcome.alias("outcome"), role.alias("role"), said.alias("said"), pick(3, [2020, None, 0], "int").alias("esas_year"), F.lit(7).alias("esas_no"),
        pick(2, [2022, None], "int").alias("karar_year"), F.lit(9).alias("karar_no"), pick(4, [None, 22, 23, 30], "int").alias("chamber_id"), pick(4, ["Geçici 3", "GEÇİCİ MADDE 3", "141 / A", None]).alias("article"), pick(3, ["T.B.K.", "hmk", "A"]).alias("short"),
        pick(3, ["3/7/2005", "15.09.2021 günü", "yok"]).alias("dated"), F.when(doc % 2 == 0, F.array(F.lit("Ali Veli"), F.lit("Can"))).otherwise(F.array().cast("array<string>")).alias("authors"),
    )


def _case(n: int, values: list) -> str:
    lit = lambda v: "NULL" if v is None else str(v) if isinstance(v, int) and not isinstance(v, bool) else "'" + str(v).replace("'", "''") + "'"
    return f"CASE doc_id % {n} " + " ".join(f"WHEN {i} THEN {lit(v)}" for i, v in enumerate(values)) + " END"


FIELDS = f"""WITH r AS (SELECT doc_id, doc_id % 6 AS m, {_case(8, ["aym", "bam", "danistay", "first_degree", "kvkk", "rekabet", "uyusmazlik", "yargitay"])} AS s, CASE WHEN doc_id % 3 = 0 THEN '2020/7' END AS ey, CASE WHEN doc_id % 2 = 0 THEN '2022/9' END AS ky FROM documents),
c AS (SELECT *, CASE WHEN s = 'kvkk' THEN CASE WHEN m = 2 THEN '2020/55' ELSE coalesce(ky, CASE m WHEN 3 THEN '06-90/1142-338' WHEN 5 THEN '...' END) END WHEN s = 'rekabet' THEN CASE m WHEN 2 THEN ': 2020/55' WHEN 3 THEN '06-90/1142-338' WHEN 5 THEN '...' END ELSE ey END AS case_no,
  CASE WHEN s = 'aym' THEN CASE WHEN m IN (3, 5) THEN 'aym_norm_review' ELSE 'aym_individual_application' END WHEN s = 'yargitay' THEN CASE WHEN coalesce({_case(4, [None, 22, 23, 30])} >= 23, doc_id % 5 = 1) THEN 'yargitay_ceza' ELSE 'yargitay_hukuk' END ELSE s END AS kind FROM r)
SELECT doc_id, case_no, CASE WHEN s = 'rekabet' THEN coalesce(case_no = '06-90/1142-338', false) ELSE coalesce(case_no IN ('2020/7', '2022/9', '2020/55'), false) END AS wellformed,
  CASE WHEN m = 2 THEN '2021-05-06' WHEN m = 3 THEN '2019-08-07' WHEN doc_id % 3 = 0 THEN '2018-06-05' END AS decision_date, kind,
  CASE WHEN kind = 'yargitay_ceza' THEN 'criminal_offence' WHEN kind = 'aym_norm_review' THEN 'constitutional_norm_review' ELSE {_case(8, list(legal.SUBJECT_TYPES[x] for x in ("aym", "bam", "danistay", "first_degree", "kvkk", "rekabet", "uyusmazlik", "yargitay")))} END AS subject_type,
  CASE WHEN m = 4 THEN 'mülkiyet_hakkı,adil_yargılanma' ELSE '' END AS rights, CAST(CASE WHEN m = 3 THEN 2 ELSE 0 END AS INTEGER) AS norms,
  CASE m WHEN 2 THEN 'decision_date,decision_number_raw' WHEN 3 THEN 'decision_number_raw,examined_norms' WHEN 4 THEN 'examination_results' WHEN 5 THEN 'application_type,decision_number_raw' ELSE '' END AS keys,
  CASE doc_id % 5 WHEN 0 THEN '11. Hukuk Dairesi' WHEN 1 THEN '3. Ceza Dairesi Başkanlığı' WHEN 3 THEN '77. Daire' ELSE coalesce(CASE s WHEN 'aym' THEN 'Anayasa Mahkemesi' WHEN 'kvkk' THEN 'Kişisel Verileri Koruma Kurulu' WHEN 'rekabet' THEN 'Rekabet Kurulu' WHEN 'uyusmazlik' THEN 'Uyuşmazlık Mahkemesi' END, CASE WHEN doc_id % 5 = 2 THEN 'Vergi Dava Daireleri Kurulu' END) END AS court,
  CAST(CASE doc_id % 5 WHEN 0 THEN 11 WHEN 1 THEN 3 END AS INTEGER) AS chamber, {_case(7, ["denied", "granted", "remanded", "granted", None, None, "affirmed"])} AS outcome, {_case(6, ["reasoning", "ruling", "reasoning", "ruling", "reasoning", "reasoning"])} AS content_type,
  {_case(6, ["background", "outcome", "analysis", "outcome", "analysis", "background"])} AS stage, {_case(4, [None, "Yaralama", "Alacak", None])} AS subject, {_case(4, ["2016/1359", "", "", ""])} AS header, {_case(4, ["tr", "en", None, None])} AS language,
  {_case(4, ["geçici-3", "geçici-3", "141/a", "unknown"])} AS article, {_case(3, ["TBK", "HMK", None])} AS short, {_case(3, ["2005-07-03", "2021-09-15", None])} AS iso, CASE WHEN doc_id % 2 = 0 THEN 'dissent:ali_veli+can' ELSE 'dissent' END AS opinion FROM c"""


def text_language(spark, d) -> DataFrame:
    """Language by the rule for decisions (Turkish, English or none), and slugs of the first words, by documents."""
    docs = table(spark, d, "documents")
    return docs.select("doc_id", legal.language_of(F.col("text")).alias("language"), F.md5(text.ground_form(F.replace("text", F.lit("ß"), F.lit("ss")))).alias("ground"), F.round(ids.token_estimate(F.col("text")), 3).alias("tokens"), F.size(text.without_junk(text.lines(F.col("text")), JUNK)).alias("lines"))


JUNK = r"^(?:Karar İçeriği|ee3|0|\d{4}/1999999|[.:;\-–…]+)$"
_EN = ", ".join(f"'{w}'" for w in legal.ENGLISH_WORDS)
_TR = ", ".join(f"'{w}'" for w in legal.TURKISH_WORDS)
LANGUAGE = f"""WITH t AS (SELECT doc_id, text, regexp_extract_all(lower(translate(text, 'İI', 'iı')), '[a-zçğıöşü]+') AS tw, regexp_extract_all(lower(text), '[a-z]+') AS ew, length(regexp_replace(text, '[^\\p{{L}}]', '', 'g')) AS letters, length(regexp_replace(text, '[^çğıöşüÇĞİÖŞÜ]', '', 'g')) AS own FROM documents),
s AS (SELECT *, CASE WHEN len(tw) = 0 THEN 0 ELSE len(list_filter(tw, lambda w: w IN ({_EN}))) / len(tw) END AS e, CASE WHEN len(ew) = 0 THEN 0 ELSE len(list_filter(ew, lambda w: w IN ({_EN}))) / len(ew) END AS e2 FROM t)
SELECT doc_id, CASE WHEN letters > 0 AND len(tw) > 0 AND e < 0.08 AND (own >= 0.01 * letters OR len(list_filter(tw, lambda w: w IN ({_TR}))) > 0) THEN 'tr' WHEN e2 >= 0.08 THEN 'en' END AS language,
  md5(upper(translate(trim(regexp_replace(translate(replace(text, 'ß', 'ss'), '’‘`´“”«»', repeat(chr(39), 4) || repeat(chr(34), 4)), '\\s+', ' ', 'g')), 'iı', 'İI'))) AS ground, round(length(text) / {vocab.CHARS_PER_TOKEN}, 3) AS tokens,
  CAST(len(list_filter(string_split(text, chr(10)), lambda x: trim(x) <> '' AND NOT regexp_matches(trim(regexp_replace(x, '\\s+', ' ', 'g')), '^(?:Karar İçeriği|ee3|0|[0-9]{{4}}/1999999|[.:;\\-–…]+)$'))) AS INTEGER) AS lines FROM s"""

QUERIES = {f.__name__: f for f in (citation_extract, citation_cleaning, citation_rules, laws_named_not_cited, stated_numbers, legislation_cross_check, legislation_coverage, citation_pieces, record_fields, text_language)}
ORACLE_SQL = {"citation_extract": EXTRACT, "citation_cleaning": CLEANING, "citation_rules": RULES, "laws_named_not_cited": NAMED, "stated_numbers": NUMBERS, "legislation_cross_check": CROSS, "legislation_coverage": COVERAGE, "citation_pieces": PIECES, "record_fields": FIELDS, "text_language": LANGUAGE}
