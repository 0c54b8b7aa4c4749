"""Before anything is sent: verdicts on raw records, procedural texts, archetypes of documents, checks of metadata alone."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from decisionloom.functions import ids, legal, text, vocab
from decisionloom.operators.records import computed, named

# Phrases of rulings on jurisdiction and procedure, headings that prompts describe, the output limit.
JURISDICTIONAL = ["görevsizlik kararı", "yetkisizlik kararı", "görev uyuşmazlığı"]
PROCEDURAL = ["dilekçenin reddine", "duruşma ertelendi", "süre verilmesine", "dosyanın.*bekletilmesine", "işlemden kaldırılmasına"]
MARKERS = {
    "aym": ["OLAY VE OLGULAR", "ILGILI HUKUK", "GENEL ILKELER", "DEGERLENDIRME", "HUKUM", "KARSIOY", "KARSI OY", "INCELEME VE GEREKCE"],
    "bam": ["DAVA", "CEVAP", "ILK DERECE", "ISTINAF", "GEREKCE", "HUKUM"],
    "danistay": ["ISTEMIN KONUSU", "YARGILAMA SURECI", "TEMYIZ EDEN", "HUKUKI DEGERLENDIRME", "KARAR SONUCU", "KARSI OY"],
    "first_degree": ["DAVA", "GEREGI DUSUNULDU", "HUKUM", "GEREKCE"],
}
USABLE = ["fetched", "completed"]
MOST_OUTPUT = 65_535


def _phrases() -> list[tuple[str, str]]:
    return [("jurisdictional", f"(?iu){p}") for p in JURISDICTIONAL] + [("procedural", f"(?iu){p}") for p in PROCEDURAL]


def procedural_reason(c: Column) -> Column:
    """Why a text rules on procedure alone: the first phrase that stands anywhere in it; null if none does."""
    out = F.lit(None).cast("string")
    for reason, pattern in reversed(_phrases()):
        out = F.when(F.coalesce(c, F.lit("")).rlike(pattern), F.lit(reason)).otherwise(out)
    return out


def phrase_density(c: Column) -> Column:
    """Share of a text that the first phrase found in it takes up."""
    out = F.lit(0.0)
    for _, pattern in reversed(_phrases()):
        found = F.regexp_extract(c, pattern, 0)
        out = F.when(F.length(found) > 0, F.length(found) / F.length(c)).otherwise(out)
    return F.coalesce(out, F.lit(0.0))


def penalised(hits: DataFrame, penalty: float = vocab.PENALTY) -> DataFrame:
    """hits(score, text) with procedural texts' scores cut; what it was stays in original_score."""
    reason = procedural_reason(F.col("text"))
    return hits.withColumn("original_score", F.col("score")).withColumn("procedural_reason", reason).withColumn("score", F.when(F.col("procedural_reason").isNotNull(), F.col("score") * penalty).otherwise(F.col("score")))


def markers(paragraphs: Column, source: Column) -> Column:
    """Headings of the source's list that stand in the text; null for a source without a list."""
    known = F.create_map(*[x for k, v in MARKERS.items() for x in (F.lit(k), F.array(*[F.lit(m) for m in v]))])
    body = F.upper(text.deaccent(F.array_join(paragraphs, " ")))
    return F.get(F.transform(F.array(body), lambda b: F.filter(F.element_at(known, source), lambda m: F.contains(b, m))), 0)  # folded once, not for each heading


def examined(records: DataFrame) -> DataFrame:
    """records(doc_id, source, status, title, content_text, html_content, paragraphs, metadata, years and numbers) + problems, warnings, verdict, predicted output and input tokens.

    A record without status or text is not looked at further.
    """
    empty = lambda c: F.trim(F.coalesce(c, F.lit(""))) == ""
    field, other = F.col("content_text"), F.col("html_content")
    p = F.col("paragraphs")
    case = legal.case_no(F.col("source"), F.col("metadata"), F.col("esas_year"), F.col("esas_no"), F.col("karar_year"), F.col("karar_no"))
    facts = {
        "n": F.size(p), "body": F.aggregate(p, F.lit(0), lambda a, x: a + F.length(x)), "open": F.size(F.filter(p, lambda x: x.rlike(r"[;:]\s*$"))), "found": F.size(markers(p, F.col("source"))),
        "text_there": ~empty(field), "undated": legal.decision_date(F.col("metadata"), p).isNull(), "unnumbered": case.isNull(),
    }
    rows = computed(records)
    rows = computed(rows.withColumn("_facts", F.struct(*[c.alias(k) for k, c in facts.items()])))  # each text is read once, not for each check
    n, body, open_, text_there = (F.col(f"_facts.{k}") for k in ("n", "body", "open", "text_there"))
    found = F.col("_facts.found")
    output = F.length(F.coalesce(field, F.lit(""))) * vocab.OUTPUT_PER_CHAR
    hollow = (n > 0) & (body < 700) & (open_ >= 2)
    problems = {
        "status": ~F.coalesce(F.col("status").isin(*USABLE), F.lit(False)), "wrong column": ~text_there & ~empty(other), "no text": ~text_there & empty(other), "one paragraph": text_there & (n <= 1), "hollow": text_there & hollow,
        "no year": text_there & F.col("esas_year").isNull() & F.col("karar_year").isNull(), "output too long": text_there & (output > MOST_OUTPUT),
    }
    warnings = {
        "few paragraphs": text_there & n.between(2, 3), "open ends": text_there & (n > 0) & ~hollow & (open_ >= F.greatest(F.lit(3), F.floor(n / 2))), "no marker": text_there & (found == 0), "one marker": text_there & (found == 1),
        "no chamber": text_there & ~F.col("source").isin("aym", "kvkk") & (F.regexp_extract(F.coalesce("title", F.lit("")), ids.CHAMBER, 1) == ""), "long output": text_there & (output > 0.75 * MOST_OUTPUT) & (output <= MOST_OUTPUT),
        "no date": text_there & F.col("_facts.undated"), "no case number": text_there & F.col("_facts.unnumbered"),
    }
    rows = rows.withColumn("problems", named(problems)).withColumn("warnings", named(warnings)).drop("_facts")
    verdict = F.when(F.size("problems") > 0, "RED").when(F.size("warnings") > 0, "AMBER").otherwise("GREEN")
    return rows.withColumn("verdict", verdict).withColumn("output_tokens", F.floor(output).cast("long")).withColumn("input_tokens", F.floor(F.length(F.coalesce(field, F.lit(""))) / vocab.CHARS_PER_TOKEN).cast("long"))


def common_findings(rows: DataFrame, most: int = 12) -> DataFrame:
    """level, name, documents: the most common problems and warnings, each by what stands before its details."""
    each = lambda c: F.transform(c, lambda x: F.struct(F.lit(c).alias("level"), x.alias("x")))
    counts = rows.select(F.explode(F.concat(each("problems"), each("warnings"))).alias("f")).select("f.*").groupBy("level", F.substring(F.substring_index("x", " -- ", 1), 1, 64).alias("name")).agg(F.count("*").alias("documents"))
    return counts.withColumn("rank", F.row_number().over(Window.partitionBy("level").orderBy(F.desc("documents"), "name"))).filter(F.col("rank") <= most)


def archetypes(records: DataFrame) -> DataFrame:
    """source, shape, markers, documents, share, covered, keys, least and last year, example: documents of one title shape and set of headings.

    covered: a source without a list of headings, or one of whose headings enough are there.
    keys: the most common set of metadata keys, of equal ones the first.
    """
    shape = F.coalesce(F.nullif(text.title_shape(text.norm_ws(F.col("title"))), F.lit("")), F.lit("(no title)"))
    rows = records.withColumn("shape", shape).withColumn("found", markers(F.col("paragraphs"), F.col("source"))).withColumn("markers", F.coalesce(F.array_join("found", ", "), F.lit("")))
    rows = rows.withColumn("keys", F.array_join(legal.metadata_keys(F.col("metadata")), ",")).withColumn("year", F.coalesce("karar_year", "esas_year"))
    sizes = F.create_map(*[F.lit(x) for k, v in MARKERS.items() for x in (k, max(2, len(v) // 3))])
    group = ["source", "shape", "markers"]
    counted = rows.groupBy(*group, "keys").agg(F.count("*").alias("n"), F.min("year").alias("a"), F.max("year").alias("b"), F.min("doc_id").alias("e"), F.max(F.coalesce(F.size("found"), F.lit(-1))).alias("hits"))
    out = counted.groupBy(*group).agg(F.sum("n").alias("documents"), F.max_by("keys", F.struct("n", (-F.col("e")).alias("early"))).alias("keys"), F.min("a").alias("least"), F.max("b").alias("last"), F.min("e").alias("example"), F.max("hits").alias("hits"))
    share = F.floor(F.col("documents") * 100 / F.sum("documents").over(Window.partitionBy("source"))).cast("int")
    enough = F.element_at(sizes, F.col("source"))
    return out.withColumn("share", share).withColumn("covered", enough.isNull() | (F.col("hits") >= enough)).drop("hits")


def metadata_checks(records: DataFrame) -> DataFrame:
    """source, check, count: what metadata alone gives: case numbers missing, repeated or of another form, dates missing or malformed, and texts where none should be yet."""
    none = F.array().cast("array<string>")
    case = legal.case_no(F.col("source"), F.col("metadata"), F.col("esas_year"), F.col("esas_no"), F.col("karar_year"), F.col("karar_no"))
    rows = records.withColumn("case_no", case).withColumn("date", legal.decision_date(F.col("metadata"), none))
    filled = lambda c: F.trim(F.coalesce(F.col(c), F.lit(""))) != ""
    counts = rows.groupBy("source").agg(
        F.count_if(F.col("case_no").isNull()).alias("case_no_missing"), (F.count("case_no") - F.countDistinct("case_no")).alias("case_no_repeated"), F.count_if(F.col("case_no").isNotNull() & ~legal.wellformed_case_no(F.col("case_no"), F.col("source"))).alias("case_no_malformed"),
        F.count_if(F.col("date").isNull()).alias("date_missing"), F.count_if(F.col("date").isNotNull() & ~F.col("date").rlike(r"^\d{4}-\d{2}-\d{2}$")).alias("date_malformed"), F.count_if(filled("content_text") | filled("html_content")).alias("with_text"),
    )
    names = ["case_no_missing", "case_no_repeated", "case_no_malformed", "date_missing", "date_malformed", "with_text"]
    return counts.select("source", F.explode(F.array(*[F.struct(F.lit(n).alias("check"), F.col(n).cast("long").alias("count")) for n in names])).alias("x")).select("source", "x.*")


def with_injected(records: DataFrame, body: str, markup: str) -> DataFrame:
    """The first record of each source with a text put in: whether its fields come through, and its paragraphs."""
    first = records.withColumn("n", F.row_number().over(Window.partitionBy("source").orderBy("doc_id"))).filter("n = 1").drop("n")
    rows = first.withColumn("content_text", F.lit(body)).withColumn("html_content", F.lit(markup)).withColumn("status", F.lit("completed"))
    case = legal.case_no(F.col("source"), F.col("metadata"), F.col("esas_year"), F.col("esas_no"), F.col("karar_year"), F.col("karar_no"))
    date = legal.decision_date(F.col("metadata"), text.lines(F.col("content_text")))
    kind = legal.kind_of(F.col("source"), F.col("metadata"), F.col("chamber_id"), F.col("title"))
    subject = legal.subject_type(F.col("source"), kind)
    ready = case.isNotNull() & date.isNotNull() & subject.isNotNull()
    return rows.select("source", "doc_id", case.alias("case_no"), date.alias("decision_date"), subject.alias("subject_type"), F.size(text.lines(F.col("content_text"))).alias("paragraphs"), ready.alias("ready"))
