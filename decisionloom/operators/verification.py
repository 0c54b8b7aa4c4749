"""Checks of stored output: issues of each document, checks of the whole storage, score cards and acceptance.

Inputs are rows.  chunks: doc, source_type, chunk_id, chunk_label, chunk_index, refs (paragraph
numbers), text, char_length, role, content_type, reasoning_stage, confidence, case_no,
decision_date, cited_legislations (array of citations).  capsules: doc, capsule_index,
source_type, case_no, decision_date, subject_id, opinion_type, outcome, conclusion_sentence,
reasoning_summary, reasoning_summary_method, supporting_chunk_ids.  paragraphs: doc, para, text.
Everything is gathered by document at most.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from decisionloom.functions import ids, legal, text, vocab
from decisionloom.operators.records import computed

#: Characters below which a chunk is a fragment, and from which uncovered paragraphs are a fault.
FRAGMENT, UNCOVERED, UNCOVERED_ONE, LONG_CONCLUSION = 40, 200, 100, 400
#: Fields of a capsule that are written in a language.
WRITTEN = ("reasoning_summary", "conclusion_sentence")
ISSUE = "array<struct<kind:string,severity:string,detail:string>>"


def _issue(kind: str, severity: str | Column, when: Column, detail: Column) -> Column:
    """An array with the issue, or none."""
    one = F.array(F.struct(F.lit(kind).alias("kind"), (F.lit(severity) if isinstance(severity, str) else severity).alias("severity"), detail.cast("string").alias("detail")))
    return F.when(F.coalesce(when, F.lit(False)), one).otherwise(F.array().cast(ISSUE))


def _numbers(c: Column) -> Column:
    return F.array_join(F.transform(c, lambda i: F.concat(F.lit("p"), i.cast("string"))), ",")


def _of_paragraphs(paragraphs: DataFrame, doc: str) -> DataFrame:
    """doc, body (whole text), what it states, names and is written in, own (its paragraphs: number, size, whether it is content)."""
    size = F.length("text")
    rows = paragraphs.select(doc, "para", "text", F.when((size >= FRAGMENT) & ~text.is_heading(F.col("text")), size).alias("content"))
    listed = F.array_sort(F.collect_list(F.struct("para", "text", "content")))
    out = computed(rows.groupBy(doc).agg(listed.alias("own")))
    out = computed(out.select(doc, F.array_join(F.transform("own", lambda x: x["text"]), " ").alias("body"), F.transform("own", lambda x: F.struct(x["para"].alias("para"), x["content"].alias("content"))).alias("own")))
    body = F.col("body")
    return computed(out.withColumns({"numbers": legal.stated_numbers(body), "language": legal.language_of(body), "named": legal.laws_named(body)}))  # once, not wherever they are read


def _paragraph_issues(rows: DataFrame) -> DataFrame:
    """rows + issues of paragraphs held twice or by no chunk, and how many there are of both."""
    refs = F.array_sort(F.coalesce(F.transform("c", lambda x: x["refs"]), F.array().cast("array<array<int>>")))
    next_to = lambda all_, other: F.filter(all_, lambda x, i: other((i > 0) & x.eqNullSafe(F.get(all_, i - 1))))
    held = text.let(refs, lambda all_: F.array_sort(F.flatten(F.filter(next_to(all_, lambda same: ~same), lambda x: x.isNotNull()))))  # chunks of equal references hold a paragraph once
    rows = computed(rows.withColumn("held", held))
    paras = F.transform("own", lambda x: x["para"])
    again = text.let(F.col("held"), lambda all_: next_to(all_, lambda same: same))
    rows = computed(rows.withColumns({"again": F.array_intersect(paras, again), "free": F.array_except(paras, "held")}))
    among = lambda name: F.filter("own", lambda x: F.array_contains(F.col(name), x["para"]))
    rows = computed(rows.withColumns({"again": F.transform(among("again"), lambda x: x["para"]), "free": F.when(F.size("free") > 0, among("free")).otherwise(F.slice("own", 1, 0))}))
    missing, minor = F.filter("free", lambda x: x["content"].isNotNull()), F.filter("free", lambda x: x["content"].isNull())
    sizes = F.transform(missing, lambda x: x["content"].cast("long"))
    rows = computed(rows.withColumns({"missing": F.size(missing), "minor": F.transform(minor, lambda x: x["para"]), "chars": F.aggregate(sizes, F.lit(0).cast("long"), lambda n, x: n + x), "longest": F.coalesce(F.array_max(sizes), F.lit(0))}))
    severity = F.when((F.col("chars") > UNCOVERED) | (F.col("longest") >= UNCOVERED_ONE), "hard").otherwise("soft")
    issues = F.concat(
        _issue("paragraph_overlap", "hard", F.size("again") > 0, _numbers(F.col("again"))),
        _issue("uncovered_content", severity, F.col("missing") > 0, F.concat_ws(" ", F.col("missing").cast("string"), F.lit("paragraphs"), F.col("chars").cast("string"), F.lit("chars"))),
        _issue("uncovered_minor", "soft", F.size("minor") > 0, _numbers(F.col("minor"))),
    )
    rows = rows.withColumns({"of_paragraphs": issues, "duplicated": F.size("again"), "missing": F.col("missing") + F.size("minor")})
    return rows.drop("own", "held", "again", "free", "minor", "chars", "longest")


def _of_chunks(chunks: DataFrame, doc: str) -> DataFrame:
    """doc, its chunks of all runs in order, without their texts."""
    fragment = (F.col("char_length") < FRAGMENT) & ~text.is_heading(F.col("text"))
    g = lambda x: x["legislation_type"] != "constitution"
    digits = lambda x: F.coalesce(F.nullif(F.regexp_replace(x["law_no"], r"\D", ""), F.lit("")), x["law_no"])
    stated = F.transform(F.filter("cited_legislations", lambda x: g(x) & x["law_no"].isNotNull()), digits)
    one = F.struct(
        F.array_min("refs").alias("first"), "chunk_index", "chunk_label", "role", F.coalesce(fragment, F.lit(False)).alias("fragment"), F.transform("cited_legislations", lambda x: F.trim(x["law_no"])).alias("laws"),
        "run", F.col("refs").cast("array<int>").alias("refs"), "source_type", stated.alias("cited"),
    )
    return chunks.groupBy(doc).agg(F.array_sort(F.collect_list(one)).alias("c"))


def ruling_before_content(c: Column, catch_all: Column) -> Column:
    """Labels of ruling chunks that are followed by content and then by the last ruling; c: a document's chunks in order."""
    ruling = lambda x: x["role"].isin(*legal.RULING)
    content = lambda x: ~x["role"].isin(*legal.RULING, *legal.DISSENT) & (x["role"] != catch_all)
    at = F.transform(c, lambda x, i: F.when(ruling(x), i))
    last = F.coalesce(F.array_max(at), F.lit(-1))
    last_content = F.coalesce(F.array_max(F.transform(c, lambda x, i: F.when(content(x) & (i < last), i))), F.lit(-1))
    return F.transform(F.filter(F.transform(c, lambda x, i: F.struct(ruling(x).alias("r"), i.alias("i"), x["chunk_label"].alias("label"))), lambda y: y["r"] & (y["i"] < last_content)), lambda y: y["label"])


def _capsules(capsules: DataFrame, chunks: DataFrame, doc: str) -> DataFrame:
    """doc, k: its capsules of all runs with the roles of their support, what they and it state, and their languages."""
    links = capsules.select("run", doc, "capsule_index", F.posexplode("supporting_chunk_ids").alias("pos", "chunk_id"))
    held = links.join(chunks.select("run", "chunk_id", F.col("role").alias("chunk_role"), F.col("text").alias("chunk_text")), ["run", "chunk_id"])
    support = held.groupBy("run", doc, "capsule_index").agg(F.collect_set("chunk_role").alias("roles"), F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("pos", "chunk_text"))), lambda x: x["chunk_text"]), " ").alias("support"))
    rows = capsules.join(support, ["run", doc, "capsule_index"], "left")
    facts = {
        "stated": legal.stated_numbers(F.concat_ws(" ", "reasoning_summary", "conclusion_sentence")), "supported": legal.stated_numbers(F.coalesce("support", F.lit(""))),
        **{f"{field}_language": legal.language_of(F.col(field)) for field in WRITTEN},
    }
    rows = rows.select("run", doc, "capsule_index", "opinion_type", "outcome", "subject_id", *WRITTEN, F.size("supporting_chunk_ids").alias("links"), F.coalesce("roles", F.array().cast("array<string>")).alias("roles"), *[c.alias(name) for name, c in facts.items()])
    return rows.groupBy(doc).agg(F.array_sort(F.collect_list(F.struct(*[c for c in rows.columns if c not in ("run", doc)], "run"))).alias("k"))


def _same_outcome(k: Column, majority: Column) -> Column:
    """Whether a dissent reaches the outcome of the majority on its subject: the longest subject that it extends or that extends it, else the only outcome of all."""
    sid = k["subject_id"]
    starts = lambda a, b: F.startswith(a, F.concat(b, F.lit("_")))
    related = F.filter(majority, lambda x: (x["subject_id"] == sid) | starts(sid, x["subject_id"]) | starts(x["subject_id"], sid))
    longest = F.array_max(F.transform(related, lambda x: F.length(x["subject_id"])))
    near = F.transform(F.filter(related, lambda x: F.length(x["subject_id"]) == longest), lambda x: x["outcome"])
    every = F.array_distinct(F.transform(majority, lambda x: x["outcome"]))
    return F.array_contains(F.when(F.size(related) > 0, near).when(F.size(every) == 1, every).otherwise(F.array().cast("array<string>")), k["outcome"])


def _of_capsule(k: Column, majority: Column, numbers: Column, body: Column, language: Column) -> Column:
    """Issues of one capsule."""
    separate, dissent = ids.is_separate(k["opinion_type"]), F.arrays_overlap(k["roles"], F.array(*[F.lit(x) for x in legal.DISSENT]))
    parts = [
        _issue("capsule_without_support", "hard", k["links"] == 0, k["opinion_type"]),
        _issue("separate_opinion_unsupported", "hard", separate & ~dissent, k["opinion_type"]),
        _issue("majority_on_dissent", "hard", ~separate & dissent, k["outcome"]),
    ]
    for field in WRITTEN:
        empty = F.coalesce(F.trim(k[field]), F.lit("")) == ""
        parts.append(_issue(f"{field}_empty", "hard", empty, k["opinion_type"]))
        parts.append(_issue(f"{field}_not_in_decision_language", "hard", ~empty & language.isNotNull() & ~k[f"{field}_language"].eqNullSafe(language), k["opinion_type"]))
    stated, supported = k["stated"], k["supported"]
    letter, number = (lambda t: F.substring(t, 1, 1)), (lambda t: F.substring(t, 2, 100))
    there = lambda t: F.array_contains(numbers, t) | ((letter(t) == "m") & F.coalesce(ids.number_in(body, number(t)), F.lit(False)))
    strange = F.transform(F.filter(stated, lambda t: ~there(t)), lambda t: F.struct(F.lit("number_not_in_document").alias("kind"), F.when(letter(t).isin("k", "e"), "hard").otherwise("soft").alias("severity"), t.alias("detail")))
    loose = F.transform(F.filter(stated, lambda t: ~F.array_contains(supported, t) & there(t)), lambda t: F.struct(F.lit("number_not_in_support").alias("kind"), F.lit("soft").alias("severity"), t.alias("detail")))
    parts += [
        strange, loose, _issue("outcome_other", "soft", k["outcome"] == "other", k["opinion_type"]),
        _issue("conclusion_sentence_long", "soft", F.length(k["conclusion_sentence"]) > LONG_CONCLUSION, F.length(k["conclusion_sentence"])),
        _issue("dissent_same_outcome_as_majority", "soft", F.startswith(k["opinion_type"], F.lit("dissent")) & _same_outcome(k, majority), F.concat_ws(":", k["outcome"], k["subject_id"])),
        _issue("subject_id_unspecified", "hard", k["subject_id"] == "unspecified", F.lit(None)),
    ]
    return F.concat(*parts)


def _together(runs: dict[str, tuple[DataFrame, DataFrame]], side: int) -> DataFrame:
    out = None
    for name, run in runs.items():
        one = run[side].withColumn("run", F.lit(name))
        out = one if out is None else out.unionByName(one)
    return out


def by_run(runs: dict[str, tuple[DataFrame, DataFrame]], paragraphs: DataFrame, doc: str = "doc_id") -> DataFrame:
    """runs: chunks and capsules by name -> a row per document and run: doc, run, source_type, body, c and k (its chunks and capsules), duplicated and missing paragraphs, issues.

    What a document itself says is worked out once for all runs.
    """
    chunks, capsules = (_together(runs, side) for side in (0, 1))
    rows = _of_paragraphs(paragraphs, doc).join(_of_chunks(chunks, doc), doc, "left").join(_capsules(capsules, chunks, doc), doc, "left")
    rows = rows.withColumn("run", F.explode(F.array(*[F.lit(name) for name in runs])))
    own = lambda name: F.when(F.exists(name, lambda x: x["run"] == F.col("run")), F.filter(name, lambda x: x["run"] == F.col("run")))
    rows = computed(rows.withColumns({"c": own("c"), "k": own("k")}))
    rows = _paragraph_issues(rows.withColumn("source_type", F.get(F.transform("c", lambda x: x["source_type"]), F.lit(0))))
    c, k = F.col("c"), F.col("k")
    some, said = F.coalesce(F.size(c), F.lit(0)) > 0, F.coalesce(F.size(k), F.lit(0)) > 0
    any_role = lambda roles: F.coalesce(F.exists(c, lambda x: x["role"].isin(*roles)), F.lit(False))
    separate = F.coalesce(F.exists(k, lambda x: ids.is_separate(x["opinion_type"])), F.lit(False))
    majority = F.filter(k, lambda x: ~ids.is_separate(x["opinion_type"]))
    missed = F.array_except(F.col("named"), F.coalesce(F.flatten(F.transform(c, lambda x: x["laws"])), F.array().cast("array<string>")))
    early = ruling_before_content(c, legal.catch_all(F.col("source_type")))
    none = F.array().cast(ISSUE)
    issues = F.concat(
        F.col("of_paragraphs"),
        F.coalesce(F.transform(F.filter("c", lambda x: x["fragment"]), lambda x: F.struct(F.lit("fragment_chunk").alias("kind"), F.lit("soft").alias("severity"), x["chunk_label"].alias("detail"))), none),
        _issue("laws_named_not_cited", "soft", F.size(missed) > 0, F.array_join(F.array_sort(missed), ",")),
        _issue("no_majority_capsule", "hard", some & said & F.forall(k, lambda x: ids.is_separate(x["opinion_type"])), F.lit(None)),
        _issue("no_ruling_chunk", "hard", some & ~any_role(legal.RULING), F.lit(None)),
        _issue("dissent_chunk_without_opinion_capsule", "hard", any_role(legal.DISSENT) & ~separate, F.size(F.filter(c, lambda x: x["role"].isin(*legal.DISSENT)))),
        F.coalesce(F.transform(early, lambda x: F.struct(F.lit("ruling_chunk_before_content").alias("kind"), F.lit("soft").alias("severity"), x.alias("detail"))), none),
        F.coalesce(F.flatten(F.transform(k, lambda x: _of_capsule(x, majority, F.col("numbers"), F.col("body"), F.col("language")))), none),
    )
    return computed(rows.withColumn("issues", issues).drop("of_paragraphs", "numbers", "language", "named"))


def by_document(chunks: DataFrame, capsules: DataFrame, paragraphs: DataFrame, doc: str = "doc_id") -> DataFrame:
    """by_run() of one run."""
    return by_run({"": (chunks, capsules)}, paragraphs, doc).drop("run")


def issues_by_run(runs: dict[str, tuple[DataFrame, DataFrame]], paragraphs: DataFrame, doc: str = "doc_id") -> DataFrame:
    """run, doc, kind, severity, detail."""
    return by_run(runs, paragraphs, doc).select("run", doc, F.explode("issues").alias("x")).select("run", doc, "x.*")


def document_issues(chunks: DataFrame, capsules: DataFrame, paragraphs: DataFrame, doc: str = "doc_id") -> DataFrame:
    """doc, kind, severity, detail: what is wrong (hard) or odd (soft) with each document."""
    return by_document(chunks, capsules, paragraphs, doc).select(doc, F.explode("issues").alias("x")).select(doc, "x.*")


def word_loss(raw: DataFrame, kept: DataFrame, doc: str = "doc_id") -> DataFrame:
    """doc, word, lost: words of raw(doc, text) that kept(doc, text) holds less often."""
    side = lambda df, n: df.select(doc, "text", F.lit(n).alias("n"))
    apart = side(raw, 1).unionByName(side(kept, -1)).groupBy(doc, "text").agg(F.sum("n").alias("n")).filter("n <> 0")  # a text that both hold loses nothing: its words are not looked at
    words = apart.select(doc, "n", F.explode(F.regexp_extract_all("text", F.lit(r"(?U)\w+"), F.lit(0))).alias("word"))
    return words.groupBy(doc, "word").agg(F.sum("n").alias("lost")).filter("lost > 0").select(doc, "word", "lost")


def _checks(rows: DataFrame, checks: dict[str, Column]) -> list[Column]:
    return [F.struct(F.lit(name).alias("check"), F.count_if(F.coalesce(when, F.lit(False))).alias("items")) for name, when in checks.items()]


#: Checks that ask for a second look; the others mean that what is stored is wrong.
WARNINGS = [
    "paragraph_refs_have_no_gaps", "content_type_consistent_with_role", "opinion_matches_dissent_support", "outcome_not_contradicted", "confidence_not_contradicted",
    "legislation_type_known", "citation_identifiable", "decision_date_present", "case_no_matches_metadata", "case_no_matches_header",
]


def _tabulated(rows: DataFrame, checks: dict[str, Column]) -> DataFrame:
    """check, items: rows for which a predicate holds, counted in one pass."""
    return rows.agg(F.array(*_checks(rows, checks)).alias("x")).select(F.explode("x").alias("x")).select("x.*")


def storage_checks(chunks: DataFrame, capsules: DataFrame, raw: DataFrame, vocabularies: dict[str, list[str]], doc: str = "doc_id") -> DataFrame:
    """check, items, status: 27 checks of all that is stored.  raw(doc, paragraphs array, case_no): what the records themselves say.

    A check passes with no item; else it warns or fails.
    """
    known = F.create_map(*[x for k, v in vocabularies.items() for x in (F.lit(k), F.array(*[F.lit(r) for r in v]))])
    source, role = F.col("source_type"), F.col("role")
    chunk_side = chunks.join(raw.select(doc, F.col("paragraphs").alias("own")), doc, "left")
    refs, own = F.col("refs"), F.col("own")
    built = F.array_join(F.transform(refs, lambda i: F.get(own, i - 1)), " ")
    usable = (F.size(refs) > 0) & (F.array_max(refs) <= F.size(own))
    cites = F.col("cited_legislations")
    flat = text.norm_ws(F.coalesce("text", F.lit("")))
    ungrounded = F.exists(cites, lambda g: (F.coalesce(text.norm_ws(g["verbatim_mention"]), F.lit("")) != "") & ~F.contains(flat, text.norm_ws(g["verbatim_mention"])) & ~legal.loosely_grounded(F.col("text"), g["article_no"], g["law_no"], g["law_short"], g["law_name"], g["legislation_type"]))
    iso = lambda c: c.rlike(r"^\d{4}-\d{2}-\d{2}$")
    stage_ok = F.col("reasoning_stage").isin("background", "analysis", "outcome") & F.col("content_type").isin("reasoning", "ruling")
    role_ok = F.coalesce(F.array_contains(F.element_at(known, source), role), F.lit(False))
    kinds = ["statute", "decree_law", "constitution", "regulation", "directive"]
    again = lambda g: ids.canonical_id(g["legislation_type"], g["law_no"], F.lit(None).cast("string"), g["law_name"], g["article_no"])
    of_chunks = _tabulated(
        chunk_side,
        {
            "chunk_schema": F.col("chunk_id").isNull() | F.col("chunk_label").isNull() | role.isNull() | ((source == "aym") & role.isNull()),
            "text_built_from_paragraphs": own.isNull() | ~usable | ~F.contains(text.norm_ws(built), flat),
            "mentions_grounded": ungrounded,
            "paragraph_refs_have_no_gaps": usable & (F.array_max(refs) - F.array_min(refs) + 1 > F.size(F.array_distinct(refs))),
            "char_length_equals_text": ~F.col("char_length").eqNullSafe(F.length("text")),
            "char_length_within_cap": F.col("char_length") > vocab.SIZE_CAP,
            "vocabularies": ~F.coalesce(stage_ok, F.lit(False)) | ~role_ok,
            "content_type_consistent_with_role": (F.col("content_type") == "ruling") & ~role.isin(*legal.RULING),
            "confidence_not_contradicted": F.exists(cites, lambda g: g["article_no"].isNotNull() & (g["confidence"] == "low")),
            "legislation_type_known": F.exists(cites, lambda g: ~F.coalesce(g["legislation_type"].isin(*kinds), F.lit(False))),
            "citation_identifiable": F.exists(cites, lambda g: g["canonical_id"].isNull() & g["law_short"].isNull()),
            "citation_schema": F.exists(cites, lambda g: g["legislation_type"].isNull() | g["confidence"].isNull()),
            "law_short_normalised": F.exists(cites, lambda g: g["law_short"].isNotNull() & ~g["law_short"].eqNullSafe(ids.law_short(g["law_short"]))),
            "canonical_id_recomputed": F.exists(cites, lambda g: ~g["canonical_id"].eqNullSafe(again(g))),
            "decision_date_is_iso": F.col("decision_date").isNotNull() & ~iso(F.col("decision_date")),
        },
    )
    repeated = chunks.groupBy("chunk_id").agg(F.count("*").alias("n"))
    held = capsules.select(doc, "capsule_index", F.explode_outer("supporting_chunk_ids").alias("chunk_id")).join(chunks.select("chunk_id", F.col(doc).alias("holder"), F.col("role").alias("held_role")), "chunk_id", "left")
    links = held.groupBy(doc, "capsule_index").agg(F.count_if(F.col("chunk_id").isNotNull() & F.col("holder").isNull()).alias("dangling"), F.count("chunk_id").alias("links"), F.countDistinct("holder").alias("documents"), F.coalesce(F.bool_or(F.col("held_role").isin(*legal.DISSENT)), F.lit(False)).alias("on_dissent"))
    ruling = chunks.filter("content_type = 'ruling'").groupBy(doc).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("chunk_index", "text"))), lambda x: x["text"]), " ").alias("ruling"))
    capsule_side = capsules.join(links, [doc, "capsule_index"], "left").join(ruling, doc, "left")
    needed = ["case_no", "source_type", "subject_id", "opinion_type", "outcome"]
    of_capsules = _tabulated(
        capsule_side,
        {
            "capsule_schema": F.exists(F.array(*[F.col(c) for c in needed]), lambda x: x.isNull()),
            "opinion_matches_dissent_support": F.startswith("opinion_type", F.lit("dissent")) != F.coalesce("on_dissent", F.lit(False)),
            "outcome_not_contradicted": legal.outcome_contradicted(F.col("outcome"), F.col("ruling")),
            "reasoning_summary_turkish": ~legal.looks_turkish(F.col("reasoning_summary")),
            "conclusion_sentence_turkish": ~legal.looks_turkish(F.col("conclusion_sentence")),
            "summary_method": ~F.col("reasoning_summary_method").eqNullSafe(F.lit("llm_generated")),
            "support_resolves": (F.col("dangling") > 0) | (F.col("documents") > 1),
            "capsules_supported": F.col("links") == 0,
        },
    )
    dates = chunks.select(doc, "decision_date").unionByName(capsules.select(doc, "decision_date")).groupBy(doc).agg(F.countDistinct("decision_date").alias("n"), F.bool_or(F.col("decision_date").isNull()).alias("unknown"))
    stored = chunks.groupBy(doc).agg(F.max("case_no").alias("stored")).join(raw, doc).withColumn("header", legal.header_cases(F.col("paragraphs")))
    of_documents = [
        _tabulated(repeated, {"chunk_id_unique": F.col("n") > 1}),
        _tabulated(dates, {"decision_date_consistent": (F.col("n") > 1) | ((F.col("n") == 1) & F.col("unknown")), "decision_date_present": F.col("n") == 0}),
        _tabulated(stored, {"case_no_matches_metadata": F.col("stored") != F.col("case_no"), "case_no_matches_header": (F.size("header") > 0) & ~F.array_contains("header", F.col("stored"))}),
    ]
    out = of_chunks.unionByName(of_capsules)
    for part in of_documents:
        out = out.unionByName(part)
    return out.withColumn("status", F.when(F.col("items") == 0, "PASS").when(F.col("check").isin(*WARNINGS), "WARN").otherwise("FAIL"))


#: Measures of a score card and which way is better (0: neither).
SCORES = {
    "documents": 1, "chunks": 0, "capsules": 0, "citations": 1, "distinct_articles": 1, "segments_law_uncited": -1, "laws_named_not_cited": -1, "no_ruling": -1,
    "dissent_without_capsule": -1, "separate_without_dissent": -1, "tiny_chunks": -1, "header_not_catchall": -1, "capsule_language": -1, "outcome_other": -1,
    "paragraphs_missing": -1, "paragraphs_duplicated": -1, "raw_words_missing": -1, "fallback": -1, "laws_failed": -1, "with_issues": -1,
}


def score_card(chunks: DataFrame, capsules: DataFrame, paragraphs: DataFrame, losses: DataFrame, reviews: DataFrame, doc: str = "doc_id") -> DataFrame:
    """source_type and the 20 measures of SCORES.  losses: word_loss(); reviews(doc, fallback, laws_failed)."""
    return score_cards({"": (chunks, capsules)}, paragraphs, {"": losses}, reviews, doc).drop("run")


def score_cards(runs: dict[str, tuple[DataFrame, DataFrame]], paragraphs: DataFrame, losses: dict[str, DataFrame], reviews: DataFrame, doc: str = "doc_id") -> DataFrame:
    """run, source_type and the 20 measures of SCORES, what documents themselves say being worked out once for all runs."""
    chunks = _together(runs, 0)
    rows = by_run(runs, paragraphs, doc).drop("body").filter(F.col("c").isNotNull())
    cites = chunks.select("run", doc, F.explode("cited_legislations").alias("g"))
    lead = F.coalesce(F.nullif(F.regexp_extract("g.article_no", r"^\d+", 0), F.lit("")), F.col("g.article_no"))
    per_doc = cites.groupBy("run", doc).agg(F.count("g.legislation_type").alias("cited"), F.count_distinct(F.when(F.col("g.article_no").isNotNull(), F.struct((F.col("g.legislation_type") == "constitution").alias("c"), lead.alias("a")))).alias("articles"))
    segments = chunks.groupBy("run", doc, "refs").agg(F.array_join(F.collect_list("text"), " ").alias("t"), F.max(F.size("cited_legislations")).alias("n")).filter((F.col("n") == 0) & F.col("t").rlike(legal.LAW_NAMED)).groupBy("run", doc).agg(F.count("*").alias("uncited"))
    lost = _together({name: (df,) for name, df in losses.items()}, 0).groupBy("run", doc).agg(F.sum("lost").alias("lost"))
    kinds = lambda *names: F.filter("issues", lambda x: x["kind"].isin(*names))
    has = lambda name: (F.size(kinds(name)) > 0).cast("long")
    separate = F.coalesce(F.exists("k", lambda x: ids.is_separate(x["opinion_type"])), F.lit(False))
    dissent = F.exists("c", lambda x: x["role"].isin(*legal.DISSENT))
    named = F.aggregate(kinds("laws_named_not_cited"), F.lit(0), lambda n, x: n + F.size(F.split(x["detail"], ",")))
    zero = lambda c: F.coalesce(c, F.lit(0)).cast("long")
    one = {
        "documents": F.lit(1), "chunks": F.size("c"), "capsules": F.greatest(F.size("k"), F.lit(0)), "citations": F.col("cited"), "distinct_articles": F.col("articles"),
        "segments_law_uncited": F.col("uncited"), "laws_named_not_cited": named, "no_ruling": has("no_ruling_chunk"), "dissent_without_capsule": (dissent & ~separate).cast("int"),
        "separate_without_dissent": (separate & ~dissent).cast("int"), "tiny_chunks": F.size(kinds("fragment_chunk")),
        "header_not_catchall": (F.col("c")[0]["role"] != legal.catch_all(F.col("source_type"))).cast("int"),
        "capsule_language": F.size(kinds("reasoning_summary_not_in_decision_language", "conclusion_sentence_not_in_decision_language")), "outcome_other": F.size(kinds("outcome_other")),
        "paragraphs_missing": F.col("missing"), "paragraphs_duplicated": F.col("duplicated"), "raw_words_missing": F.col("lost"), "fallback": F.col("fallback").cast("int"), "laws_failed": F.col("laws_failed").cast("int"),
        "with_issues": (F.col("hard") | (zero(F.col("lost")) > 0)).cast("int"),
    }
    joined = ("citations", "distinct_articles", "segments_law_uncited", "raw_words_missing", "fallback", "laws_failed", "with_issues")
    rows = computed(rows.select("run", doc, "source_type", F.exists("issues", lambda x: x["severity"] == "hard").alias("hard"), *[v.alias(f"_{name}") for name, v in one.items() if name not in joined]))  # numbers alone are joined
    rows = rows.join(per_doc, ["run", doc], "left").join(segments, ["run", doc], "left").join(lost, ["run", doc], "left").join(reviews, doc, "left")
    return rows.groupBy("run", "source_type").agg(*[F.sum(zero(v if name in joined else F.col(f"_{name}"))).alias(name) for name, v in one.items()])


def total(card: DataFrame) -> DataFrame:
    """The measures over all sources."""
    return card.agg(*[F.sum(m).alias(m) for m in SCORES])


def compared(a: DataFrame, b: DataFrame) -> DataFrame:
    """measure, a, b, verdict: two score cards over all sources, a source that one lacks counting as 0."""
    both = total(a).select(F.struct("*").alias("a")).crossJoin(total(b).select(F.struct("*").alias("b")))  # a row each
    lines = F.array(*[F.struct(F.lit(m).alias("measure"), F.coalesce(F.col(f"a.{m}"), F.lit(0)).alias("a"), F.coalesce(F.col(f"b.{m}"), F.lit(0)).alias("b"), F.lit(way).alias("way")) for m, way in SCORES.items()])
    rows = both.select(F.explode(lines).alias("x")).select("x.*")
    gain = F.signum((F.col("a") - F.col("b")) * F.col("way"))
    return rows.select("measure", "a", "b", F.when(gain > 0, "better").when(gain < 0, "WORSE").otherwise("").alias("verdict"))


#: Roles that say little, and the share of chunks, in per cent, from which they are too many.
VAGUE, VAGUE_SHARE = ["other", "unknown"], 40


def acceptance(chunks: DataFrame, capsules: DataFrame, reviews: DataFrame, index_problems: DataFrame) -> DataFrame:
    """criterion (1 to 11), name, count, verdict (PASS, FAIL, MANUAL).  reviews(doc, reason, failed_checks array of 'flag:detail'); index_problems: records with an array `problems`."""
    flags = reviews.select(F.explode("failed_checks").alias("f")).agg(*[F.count_if(F.substring_index("f", ":", 1).isin(*names)).alias(alias) for alias, names in {"ungrounded": ["segment_has_no_valid_refs", "invalid_paragraph_ref"], "differs": ["model_text_differs"], "unspecified": ["subject_id_unspecified"], "unsupported": ["capsule_has_no_resolvable_support"]}.items()])
    failed = F.col("reason").isNotNull() & (F.col("reason") != "") & (F.col("reason") != "validation_flags")
    calls = reviews.agg(F.count_if(failed & (F.col("reason") == "api_or_parse_failed")).alias("failed"), F.count_if(failed & F.contains("reason", F.lit("truncat"))).alias("truncated"))
    of_chunks = chunks.agg(F.count("*").alias("chunks"), F.count_if(F.col("role").isNull() | F.col("role").isin(*VAGUE)).alias("vague"), F.count_if(F.size("cited_legislations") > 0).alias("cited"))
    empty = lambda c: F.coalesce(F.trim(c), F.lit("")) == ""
    of_capsules = capsules.agg(F.count_if(empty("reasoning_summary") | empty("conclusion_sentence")).alias("empty"))
    records = index_problems.agg(F.count_if(F.size("problems") > 0).alias("invalid"))
    all_ = calls.crossJoin(flags).crossJoin(of_chunks).crossJoin(of_capsules).crossJoin(records)  # a row each
    share = F.floor(F.col("vague") * 100 / F.greatest(F.col("chunks"), F.lit(1)))
    lines = [
        ("the call succeeded", F.col("failed"), F.col("failed") == 0), ("nothing truncated", F.col("truncated"), F.col("truncated") == 0), ("segments grounded", F.col("ungrounded"), F.col("ungrounded") == 0),
        ("text matches the source", F.col("differs"), F.col("differs") == 0), ("subject named", F.col("unspecified"), F.col("unspecified") == 0), ("roles meaningful", F.col("vague"), share < VAGUE_SHARE),
        ("summaries present", F.col("empty"), F.col("empty") == 0), ("citations extracted", F.col("cited"), F.col("cited") > 0), ("capsules supported", F.col("unsupported"), F.col("unsupported") == 0),
        ("index records valid", F.col("invalid"), F.col("invalid") == 0), ("norm review reads correctly", F.lit(0), F.lit(None).cast("boolean")),
    ]
    rows = F.array(*[F.struct(F.lit(i).alias("criterion"), F.lit(name).alias("name"), n.cast("long").alias("count"), F.when(ok.isNull(), "MANUAL").when(ok, "PASS").otherwise("FAIL").alias("verdict")) for i, (name, n, ok) in enumerate(lines, 1)])
    return all_.select(F.explode(rows).alias("x")).select("x.*")


def before_after(stored: DataFrame, rebuilt: DataFrame) -> DataFrame:
    """measure, stored, rebuilt: counters of two runs, each a row of equal columns."""
    both = stored.select(F.struct("*").alias("s")).crossJoin(rebuilt.select(F.struct("*").alias("r")))  # a row each
    lines = F.array(*[F.struct(F.lit(c).alias("measure"), F.col(f"s.{c}").cast("long").alias("stored"), F.col(f"r.{c}").cast("long").alias("rebuilt")) for c in stored.columns])
    return both.select(F.explode(lines).alias("x")).select("x.*")


def measures(chunks: DataFrame, capsules: DataFrame, paragraphs: DataFrame, losses: DataFrame, merges: DataFrame, doc: str = "doc_id") -> DataFrame:
    """One row of 13 counters of a run.  merges(doc, from_role, to_role, citations_dropped): its log of joined fragments."""
    return measures_by_run({"": (chunks, capsules)}, paragraphs, {"": losses}, merges, doc).drop("run")


def measures_by_run(runs: dict[str, tuple[DataFrame, DataFrame]], paragraphs: DataFrame, losses: dict[str, DataFrame], merges: DataFrame, doc: str = "doc_id") -> DataFrame:
    """run and its 13 counters, a row a run; what documents themselves say is worked out once for all runs."""
    chunks = _together(runs, 0)
    rows = by_run(runs, paragraphs, doc)
    unsaid = F.aggregate(F.coalesce(F.flatten(F.transform("c", lambda x: x["cited"])), F.array().cast("array<string>")), F.lit(0), lambda n, x: n + F.coalesce((~ids.number_in(F.col("body"), x)).cast("int"), F.lit(0)))
    of_docs = rows.groupBy("run").agg(
        F.count("*").alias("documents"), F.sum("missing").alias("paragraphs_missing"), F.sum("duplicated").alias("paragraphs_duplicated"),
        F.count_if(F.exists("issues", lambda x: x["severity"] == "hard")).alias("documents_with_issues"), F.count_if(F.exists("issues", lambda x: x["kind"] == "no_ruling_chunk")).alias("documents_without_ruling"),
        F.sum(unsaid).alias("law_no_never_stated"),
    )
    ordered = chunks.select("run", doc, "char_length", F.array_min("refs").alias("at"), F.size(F.filter("cited_legislations", lambda g: (g["legislation_type"] == "constitution") & g["law_no"].isNotNull())).alias("constitution"), "chunk_index")
    ordered = ordered.withColumn("before", F.lag("at").over(Window.partitionBy("run", doc).orderBy("chunk_index")))
    apart = F.col("from_role") != F.col("to_role")
    lost = F.col("from_role").isin(*legal.RULING) & ~F.col("to_role").isin(*legal.RULING)
    of_merges = merges.agg(F.count_if(apart).alias("cross_role_merges"), F.count_distinct(F.when(lost, F.col(doc))).alias("documents_losing_a_ruling"), F.coalesce(F.sum("citations_dropped"), F.lit(0)).alias("citations_dropped"))
    of_chunks = ordered.groupBy("run").agg(F.coalesce(F.sum("constitution"), F.lit(0)).alias("constitution_with_law_no"), F.count_if(F.col("char_length") > vocab.SIZE_CAP).alias("chunks_over_cap"), F.count_distinct(F.when(F.col("before") > F.col("at"), F.col(doc))).alias("documents_out_of_order"))
    words = _together({name: (df,) for name, df in losses.items()}, 0).groupBy("run").agg(F.sum("lost").alias("raw_words_missing"))
    names = paragraphs.sparkSession.createDataFrame([(name,) for name in runs], "run string")
    out = names.join(of_docs, "run", "left").join(of_chunks, "run", "left").join(words, "run", "left").crossJoin(of_merges)  # a row a run
    summed = ("paragraphs_missing", "paragraphs_duplicated")  # null, as before, over no document
    return out.select("run", *[F.col(c) if c in summed else F.coalesce(c, F.lit(0)).alias(c) for c in MEASURES])


#: Counters of measures(), in their order.
MEASURES = [
    "documents", "paragraphs_missing", "paragraphs_duplicated", "documents_with_issues", "documents_without_ruling", "cross_role_merges", "documents_losing_a_ruling", "citations_dropped",
    "constitution_with_law_no", "law_no_never_stated", "chunks_over_cap", "documents_out_of_order", "raw_words_missing",
]
