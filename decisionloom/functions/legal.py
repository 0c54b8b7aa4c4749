"""Legal texts and record fields as Column expressions: numbers a text states, case numbers, courts, kinds, roles, outcomes, languages."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from decisionloom.functions import ids, text

# Word lists, patterns and tables that results depend on.
ENGLISH_WORDS = "the and of was were that this court applicant with which from have been".split()
TURKISH_WORDS = (
    "ve ile bu bir için icin göre gore olarak karar kararı dava mahkeme hakkı hakki başvuru basvuru ihlal reddine kabul "
    "verilmiştir verilmistir kanun madde sayılı sayili idari para cezası cezasi kurul nedeniyle uyarınca"
).split()
ORDINALS = {"BIRINCI": 1, "IKINCI": 2, "UCUNCU": 3, "DORDUNCU": 4, "BESINCI": 5, "ALTINCI": 6, "YEDINCI": 7, "SEKIZINCI": 8, "DOKUZUNCU": 9, "ONUNCU": 10}
ARTICLE_STATED = r"\b(\d+)\s*(?:\.|['’ʼ]?\s*[IU]NC[IU]|['’ʼ]?\s*NC[IU])?\s*(?:/\s*[A-Z]\s*)?MADDE|\bMADDE\s+(\d+)"
LAW_STATED = r"(?<![\d/])\b(\d{2,5})\s+SAYILI\s+(?:[^\s.;,]+\s+){0,12}?(?:KANUN|YASA|KHK|KARARNAME)"
LAW_NAMED = r"(?iu)(?<![\d/])\b(\d{3,5})\s+sayılı\s+(?:[^\s.;,]+\s+){0,12}?(?:Kanun|Yasa|KHK|Kararname)"
CASE_STATED = r"\b(\d{4}/\d+)\b"
COURT_PHRASE = r"(\d{1,2}\s*\.\s*(?:[A-Za-zÇĞİÖŞÜçğıöşü]+\s+){0,3}?(?:Daire(?:si)?|Mahkemesi)(?:\s+Başkanlığı)?)"
TRAILING_CASES = r"\s*\d{4}/\d+\s*E\.?\s*,?\s*\d{4}/\d+\s*K\.?\s*$"
INSTITUTIONS = {"aym": "Anayasa Mahkemesi", "kvkk": "Kişisel Verileri Koruma Kurulu", "rekabet": "Rekabet Kurulu", "uyusmazlik": "Uyuşmazlık Mahkemesi"}
HEADER_CASE = r"(?iu)(?:ESAS|DOSYA)\s*(?:NO)?\s*[:\.]?\s*(\d{4}\s*/\s*\d+)"
CASE_FORMS = {"rekabet": r"^\d{2}-\d+/\d+-\w+$"}
CASE_FORM = r"^\d{4}/\d+$"
SUBJECT_LABEL = r"(?iu)^\s*(suç(?:lar)?|dava\s+türü|dava)\s*:\s*(.+)$"
STAGES = {
    "facts": "background", "issue": "background", "other": "background", "unknown": "background", "background": "background",
    "rule": "analysis", "application": "analysis", "rule_application": "analysis", "dissent": "analysis", "analysis": "analysis",
    "conclusion": "outcome", "outcome": "outcome",
}
RULING, DISSENT = ["conclusion", "outcome"], ["dissent"]
CATCH_ALL = {"aym": "unknown", "kvkk": "background", "rekabet": "background"}
VOCABULARIES = {"firac_role": "firac", "court_reasoning_role": "court_reasoning", "regulatory_role": "regulatory"}
SUBJECT_TYPES = {
    "aym": "right", "bam": "civil_or_administrative_case", "danistay": "administrative_or_tax_dispute", "first_degree": "civil_or_administrative_case",
    "kvkk": "data_controller_violation", "yargitay": "civil_or_administrative_case", "rekabet": "other_competition_matter", "uyusmazlik": "jurisdictional_dispute",
}
OUTCOMES = (
    "violation no_violation inadmissible abated annulled denied granted partially_granted affirmed corrected_affirmed reversed remanded remitted "
    "no_jurisdiction dismissed_procedural transferred no_decision_needed fine_imposed instruction_issued disciplinary_referral no_action "
    "procedural_objection other"
).split()
RULING_WORDS = {
    "no_violation": r"İHL[ÂA]L\s+EDİLMEDİĞİNE", "violation": r"İHL[ÂA]L\s+EDİLDİĞİNE", "denied": "REDDİNE",
    "affirmed": "ONANMASINA", "reversed": "BOZULMASINA", "remanded": r"GERİ\s+ÇEVRİLMESİNE",
}
OUTCOME_FORMS = {
    "no_violation": ["ihlal_yok", "ihlal_olmad", "ihlal_edilmedi", "no_violation", "ihlal_bulunmad"],
    "violation": ["ihlal", "violation"],
    "denied": ["red", "denied", "dismiss", "kabul_edilemez"],
    "affirmed": ["onan", "onama", "affirm", "onandi"],
    "reversed": ["bozma", "bozul", "reversed", "bozuldu"],
    "remanded": ["geri_cevir", "geri_çevir", "geri_cevr", "geri_çevr", "remand", "return", "iade"],
}
# Older free-text outcomes and what they became, by kind of court; others became none.  A parameter, more can be given.
LEGACY_OUTCOMES = {
    "red": "denied",
    "iptal": "annulled", "onama": "affirmed", "bozma": "reversed",
    "yetkisizlik_nedeniyle_red": "no_jurisdiction", "yetkisizlik": "no_jurisdiction", "yetki_yönünden_red": "no_jurisdiction", "yetki_yonunden_red": "no_jurisdiction",
    "dava_reddine_karar_verildi": "denied", "iptal_gerekliliği": "annulled", "iptal_gerekliligi": "annulled", "usule_muhalefet": "procedural_objection",
    "yontemine_uygun_degil": "dismissed_procedural", "ihlal_yok": "no_violation", "ihlal": "violation",
    "kabul_edilemezlik": "inadmissible", "istem_reddine": "denied", "itiraz_reddi": "denied", "iptal_talebinin_reddi": "denied", "iptal_talebi_reddi": "denied",
    "dosya_geri_cevirme": "remanded", "görev_ve_yetki_itirazi": "procedural_objection", "gorev_ve_yetki_itirazi": "procedural_objection", "iptal_edilmemesi": "denied",
    "yer_olmadığı": "no_decision_needed", "yer_olmadigi": "no_decision_needed", "basvurunun_geri_cevrilmesi": "remanded", "basvurunun_reddi": "denied",
    "basvuru_reddi": "denied", "dosya_iadesi": "remanded", "işin_geri_çevrilmesi": "remanded", "isin_geri_cevrilmesi": "remanded",
    "iptal_karsi_oy": "annulled", "esastan_inceleme_gerekliliği": "procedural_objection", "esastan_inceleme_gerekliligi": "procedural_objection",
    "yeniden_karar_verilmesine_yer_olmadigi": "no_decision_needed", "anayasa_denetimi_yapilmali": "procedural_objection",
    "konusu_kalmayan_istem": "no_decision_needed", "iade": "remanded", "anayasa_aykirilik": "annulled", "yontemde_ayrisik_oy": "procedural_objection",
    "yöntemine_uygun_olmayan_basvuru": "dismissed_procedural", "yontemine_uygun_olmayan_basvuru": "dismissed_procedural", "yontemine_uygun_olmama": "dismissed_procedural",
    "denied_on_merits": "denied", "appeal_dismissed": "denied", "appeal_upheld": "granted", "case_transferred": "transferred", "transfer_to_another_court": "transferred",
    "partially_upheld": "partially_granted", "partially_upheld_partially_reversed": "partially_granted", "remanded_for_further_investigation": "remanded",
    "appeal_denied_lower_ruling_affirmed": "affirmed", "appeal_granted_lower_ruling_reversed": "reversed",
    "competent_court_determined_as_ankara_administrative_court": "transferred", "jurisdiction_denied_case_remanded": "no_jurisdiction",
    "license_revocation_and_fine_upheld": "affirmed", "tax_penalty_cancellation": "reversed",
    "denied_procedural": "dismissed_procedural", "claim_granted": "granted", "accept_partially": "partially_granted", "partial_acceptance": "partially_granted",
    "denied_claim": "denied", "denied_no_fault": "denied", "denied_loss_certificate": "denied",
    "administrative_fine_imposed": "fine_imposed", "administrative_fine_for_data_security_breach": "fine_imposed", "administrative_fine_for_data_security_violations": "fine_imposed",
    "data_security_measures_required": "instruction_issued", "data_deletion_request_denied": "denied", "no_action_needed": "no_action",
    "geri_cevirme": "remanded", "dosyanin_yerel_mahkemeye_geri_cevrilmesi": "remanded", "görev_belirleme": "transferred", "gorev_belirleme": "transferred",
    "red_ve_onama": "affirmed", "reddetme": "denied", "reddi_takdiren_para_cezasi": "denied", "vazgecme_nedeniyle_incelemeksizin_iade": "remitted",
}


def _map(values: dict) -> Column:
    return F.create_map(*[F.lit(x) for pair in values.items() for x in pair])


def _all(c: Column, pattern: str, group: int) -> Column:
    return F.filter(F.regexp_extract_all(c, F.lit(pattern), F.lit(group)), lambda x: x != "")


def stated_numbers(c: Column) -> Column:
    """Distinct articles (m33), law numbers (k6698) and case numbers (e2019/12951) that a text states.  The text is folded once, and each pattern looked up once, where a word or mark that it needs stands."""
    return text.let(text.let(text.norm_upper(F.coalesce(c, F.lit(""))), _ordinals_as_digits), _numbers_stated)


def _ordinals_as_digits(up: Column) -> Column:
    out = up
    for word, n in ORDINALS.items():
        out = F.regexp_replace(out, rf"\b{word}\s+(MADDE|FIKRA)", f"{n}. $1")
    ending = F.contains(up, F.lit("NCI")) | F.contains(up, F.lit("NCU"))  # of each of them
    return F.when(ending & up.rlike(rf"\b(?:{'|'.join(ORDINALS)})\s+(?:MADDE|FIKRA)"), out).otherwise(up)


def _numbers_stated(up: Column) -> Column:
    found = lambda word, pattern, group: F.when(F.contains(up, F.lit(word)), _all(up, pattern, group)).otherwise(F.array().cast("array<string>"))
    named = lambda letter, x: F.concat(F.lit(letter), x)
    articles = F.transform(found("MADDE", ARTICLE_STATED, 0), lambda x: named("m", F.regexp_extract(x, r"\d+", 0)))
    laws, cases = F.transform(found("SAYILI", LAW_STATED, 1), lambda x: named("k", x)), F.transform(found("/", CASE_STATED, 1), lambda x: named("e", x))
    return F.array_sort(F.array_distinct(F.concat(articles, laws, cases)))


def laws_named(c: Column) -> Column:
    """Distinct numbers of the laws that a text names."""
    return F.array_sort(F.array_distinct(_all(F.coalesce(c, F.lit("")), LAW_NAMED, 1)))


def _lower(c: Column) -> Column:
    """Lower case, letter by letter: a dotted capital I is one letter, not an i and a combining dot that would cut its word."""
    return F.lower(F.replace(c, F.lit("İ"), F.lit("i")))


def _english(own: Column) -> Column:
    return F.when(F.size(own) > 0, F.size(F.filter(own, lambda x: x.isin(*ENGLISH_WORDS))) / F.size(own)).otherwise(F.lit(0.0))


def english_share(c: Column, word: str = "[a-z]+", lower=_lower) -> Column:
    return text.let(F.regexp_extract_all(lower(c), F.lit(word), F.lit(0)), _english)


def looks_turkish(c: Column) -> Column:
    """No share of English stop words of 8 per cent; then Turkish letters of one per cent of all letters, or a marker word."""
    return text.let(F.coalesce(c, F.lit("")), _turkish)


def _turkish(body: Column) -> Column:
    words = F.regexp_extract_all(text.tr_lower(body), F.lit("[a-zçğıöşü]+"), F.lit(0))
    letters = F.length(F.regexp_replace(body, r"[^\p{L}]+", ""))
    turkish = F.length(F.regexp_replace(body, "[^çğıöşüÇĞİÖŞÜ]+", ""))
    marked = lambda own: F.exists(own, lambda w: w.isin(*TURKISH_WORDS))
    return text.let(words, lambda own: (F.size(own) > 0) & (_english(own) < 0.08) & (marked(own) | (turkish >= 0.01 * letters)))  # letters are counted only where no marker word stands


def language_of(c: Column) -> Column:
    """tr, en or null."""
    return text.let(F.coalesce(c, F.lit("")), lambda body: F.when(_turkish(body), "tr").when(english_share(body) >= 0.08, "en"))


def court(title: Column, source: Column) -> Column:
    """The chamber's phrase of a title; else the institution's name; else the title without case numbers at its end."""
    phrase = F.nullif(F.trim(F.regexp_extract(title, COURT_PHRASE, 1)), F.lit(""))
    rest = F.nullif(F.trim(F.regexp_replace(title, TRAILING_CASES, ""), F.lit(" ,.")), F.lit(""))
    return F.coalesce(phrase, F.element_at(_map(INSTITUTIONS), source), rest)


def derived(role: Column) -> tuple[Column, Column]:
    """Content type and stage of a role."""
    return F.when(role.isin(*RULING), "ruling").otherwise("reasoning"), F.element_at(_map(STAGES), role)


def first_role(*fields: Column) -> Column:
    """The first of several fields that holds a role."""
    return F.coalesce(*[F.nullif(f, F.lit("")) for f in fields])


def catch_all(source: Column) -> Column:
    return F.coalesce(F.element_at(_map(CATCH_ALL), source), F.lit("other"))


def legacy_outcome(c: Column, table: dict[str, str] | None = None) -> Column:
    """An older outcome as one of the list, or null; outcomes of the list stay."""
    v = F.trim(text.strip_dot(c))
    known = _map(table or LEGACY_OUTCOMES)
    return F.when(v.isin(*OUTCOMES), v).otherwise(F.coalesce(F.element_at(known, v), F.element_at(known, text.tr_lower(v))))


def wellformed_case_no(c: Column, source: Column) -> Column:
    out = F.coalesce(c, F.lit("")).rlike(CASE_FORM)
    for k, pattern in CASE_FORMS.items():
        out = F.when(source == k, F.coalesce(c, F.lit("")).rlike(pattern)).otherwise(out)
    return out


def _inner(metadata: Column, path: str) -> Column:
    return F.get_json_object(metadata, f"$.data.{path}")


def case_no(source: Column, metadata: Column, esas_year: Column, esas_no: Column, karar_year: Column, karar_no: Column) -> Column:
    """Case number by source: as the metadata writes it, or year and number; null where there is none."""
    raw = F.trim(F.coalesce(_inner(metadata, "decision_number_raw"), F.lit("")))
    cut = F.trim(F.regexp_replace(raw, "^[:-]+", ""))
    kvkk = F.coalesce(F.when(~cut.rlike(CASE_FORM), ids.year_no(karar_year, karar_no)), F.nullif(cut, F.lit("")))
    return F.when(source == "kvkk", kvkk).when(source == "rekabet", F.nullif(raw, F.lit(""))).otherwise(ids.year_no(esas_year, esas_no))


def decision_date(metadata: Column, paragraphs: Column) -> Column:
    """The metadata's ISO date; else its date in day order; else the date of the last paragraph that rules on one."""
    inner = F.substring(_inner(metadata, "decision_date"), 1, 10)
    top = F.coalesce(F.get_json_object(metadata, "$.decision_date"), F.get_json_object(metadata, "$.karar_tarihi"))
    dated = r"(?iu)(\d{1,2}[./]\d{1,2}[./]\d{4})\s*(?:tarihinde|gününde)"
    last = F.get(F.reverse(F.filter(paragraphs, lambda p: p.rlike(dated))), 0)
    plain = F.when(top.rlike(r"^\s*\d{1,2}[./]\d{1,2}[./]\d{4}\s*$"), ids.iso_date(top))
    return F.coalesce(F.when(inner.rlike(r"^\d{4}-\d{2}-\d{2}$"), inner), plain, ids.iso_date(F.nullif(F.regexp_extract(last, dated, 1), F.lit(""))))


def metadata_keys(metadata: Column) -> Column:
    """Sorted keys of the metadata's data; none where it can't be read."""
    return F.coalesce(F.array_sort(F.json_object_keys(F.get_json_object(metadata, "$.data"))), F.array().cast("array<string>"))


def variant(metadata: Column) -> Column:
    """An application of a person, or the review of a norm."""
    filled = lambda path: ~F.coalesce(_inner(metadata, path), F.lit("")).isin("", "[]", "{}", "false", "0")
    return F.when(filled("examination_results"), "individual_application").when(filled("examined_norms") | filled("application_type"), "norm_review").otherwise("individual_application")


def kind_of(source: Column, metadata: Column, chamber_id: Column, title: Column) -> Column:
    criminal = F.when(chamber_id.isNotNull(), chamber_id >= 23).otherwise(F.coalesce(title, F.lit("")).rlike(r"(?iu)\bCeza\s+Dairesi"))
    return F.when(source == "aym", F.concat(F.lit("aym_"), variant(metadata))).when(source == "yargitay", F.when(criminal, "yargitay_ceza").otherwise("yargitay_hukuk")).otherwise(source)


def subject_type(source: Column, kind: Column) -> Column:
    return F.when(kind == "yargitay_ceza", "criminal_offence").when(kind == "aym_norm_review", "constitutional_norm_review").otherwise(F.element_at(_map(SUBJECT_TYPES), source))


def candidate_rights(metadata: Column) -> Column:
    """Distinct rights under examination, as slugs, in their order."""
    found = F.from_json(_inner(metadata, "examination_results"), "array<struct<right:string>>")
    slugs = F.transform(found, lambda x: text.slug_right(F.coalesce(x["right"], F.lit(""))))
    return F.coalesce(F.array_distinct(F.filter(slugs, lambda s: s != "")), F.array().cast("array<string>"))


NORMS = "array<struct<norm_code_name:string,articles:array<struct<article_no:string,clause:string,review_type_result:string>>>>"


def examined_norms(metadata: Column) -> Column:
    """An entry for each article of each norm under review: law, article, clause, result."""
    found = F.from_json(_inner(metadata, "examined_norms"), NORMS)
    entry = lambda norm, a: F.struct(F.trim(F.coalesce(norm["norm_code_name"], F.lit(""))).alias("law"), F.trim(F.coalesce(a["article_no"], F.lit(""))).alias("article"), a["clause"].alias("clause"), a["review_type_result"].alias("result"))
    return F.flatten(F.transform(found, lambda norm: F.transform(F.coalesce(norm["articles"], F.array().cast("array<struct<article_no:string,clause:string,review_type_result:string>>")), lambda a: entry(norm, a))))


def candidate_subject(paragraphs: Column) -> Column:
    """(label, value) of the first of eight header lines that names the subject; null if none does."""
    line = F.get(F.filter(F.slice(paragraphs, 1, 8), lambda p: p.rlike(SUBJECT_LABEL)), 0)
    label = F.regexp_replace(text.tr_lower(F.regexp_extract(line, SUBJECT_LABEL, 1)), r"\s+", "_")
    return F.when(line.isNotNull(), F.struct(label.alias("label"), F.trim(F.regexp_extract(line, SUBJECT_LABEL, 2)).alias("value")))


def header_cases(paragraphs: Column) -> Column:
    """Case numbers that the first twelve paragraphs state."""
    return F.array_distinct(F.transform(_all(F.array_join(F.slice(paragraphs, 1, 12), " "), HEADER_CASE, 1), lambda x: F.regexp_replace(x, r"\s", "")))


def ruling_outcomes(ruling: Column) -> Column:
    """Outcomes that the words of a ruling speak for."""
    up = text.tr_upper(F.coalesce(ruling, F.lit("")))
    return F.filter(F.array(*[F.when(up.rlike(p), F.lit(k)) for k, p in RULING_WORDS.items()]), lambda x: x.isNotNull())


def outcome_contradicted(outcome: Column, ruling: Column) -> Column:
    """Whether the ruling's words speak for outcomes, not for both violation and none, and for none that the label could mean."""
    hits = ruling_outcomes(ruling)
    label = text.tr_lower(outcome)
    meant = F.lit(False)
    for k, forms in OUTCOME_FORMS.items():
        form = F.lit(False)
        for f in forms:
            form = form | F.contains(label, F.lit(f))
        meant = meant | (F.array_contains(hits, k) & form)
    both = F.array_contains(hits, "violation") & F.array_contains(hits, "no_violation")
    return F.coalesce((F.size(hits) > 0) & ~both & (F.coalesce(outcome, F.lit("")) != "") & ~meant, F.lit(False))


def article_in(article: Column, body: Column) -> Column:
    """Whether a text states the article, as it is written or by the number it begins with."""
    lead = F.nullif(F.regexp_extract(article, r"^\d+", 0), F.lit(""))
    return F.coalesce(ids.number_in(body, article), F.lit(False)) | F.coalesce(ids.number_in(body, lead), F.lit(False))


def loosely_grounded(body: Column, article: Column, law_no: Column, short: Column, name: Column, kind: Column) -> Column:
    """The article's number, and the law's number, abbreviation, longest name word of more than five letters or, for the constitution, its name stand in the text."""
    flat = text.norm_ws(F.coalesce(body, F.lit("")))
    low = F.lower(flat)
    has = lambda c: F.when(F.coalesce(F.trim(c), F.lit("")) != "", F.contains(low, F.lower(F.trim(c))))
    words = F.filter(F.split(name, r"[^\p{L}\p{N}_]+"), lambda w: F.length(w) > 5)
    longest = F.aggregate(words, F.lit(""), lambda best, w: F.when(F.length(w) > F.length(best), w).otherwise(best))
    stated = F.coalesce(has(law_no), F.lit(False)) | F.coalesce(has(short), F.lit(False)) | F.coalesce(has(longest), F.lit(False))
    constitution = F.coalesce(kind == "constitution", F.lit(False)) & F.contains(low, F.lit("anayasa"))
    own = F.when(F.coalesce(F.trim(article), F.lit("")) == "", F.lit(True)).otherwise(F.coalesce(ids.number_in(flat, F.trim(article)), F.lit(False)))
    return (flat != "") & own & (stated | constitution)
