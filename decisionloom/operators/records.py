"""Index records, their contract, checks as violation rows, score cards and merges."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from decisionloom.functions import ids, vocab
from decisionloom.operators import sets


def named(problems: dict[str, Column]) -> Column:
    """Names of the problems whose predicate holds."""
    return F.filter(F.array(*[F.when(c, F.lit(k)) for k, c in problems.items()]), lambda x: x.isNotNull())


def computed(rows: DataFrame) -> DataFrame:
    """rows, whose columns what follows reads as they are: else they would be worked out anew wherever they are read, or become one expression too long to be compiled."""
    return rows.select(F.explode(F.array(F.struct(*rows.columns))).alias("x")).select("x.*")


def violations(rows: DataFrame, kind: str, severity: str, where: Column, keys: Iterable[str], detail: Column) -> DataFrame:
    """kind, severity, keys, detail of the rows that break a rule."""
    return rows.filter(where).select(F.lit(kind).alias("kind"), F.lit(severity).alias("severity"), *keys, detail.cast("string").alias("detail"))


def all_violations(parts: list[DataFrame]) -> DataFrame:
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def filled_years(esas: Column, karar: Column) -> tuple[Column, Column, Column]:
    """Both years, each taken from the other where it is missing, and the note that says so."""
    note = F.when(esas.isNull() & karar.isNotNull(), F.lit("esas_year from karar_year")).when(karar.isNull() & esas.isNotNull(), F.lit("karar_year from esas_year"))
    return F.coalesce(esas, karar), F.coalesce(karar, esas), note


def merge_new(existing: DataFrame, incoming: DataFrame, key: str) -> DataFrame:
    """Existing rows, then incoming ones whose key is new; the first of a repeated key."""
    order = Window.partitionBy(key).orderBy(*incoming.columns)
    first = incoming.withColumn("_n", F.row_number().over(order)).filter("_n = 1").drop("_n")
    return existing.unionByName(first.join(existing.select(key), key, "left_anti"))


def merge_targeted(stored: DataFrame, ran: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """Rows of the documents that ran are replaced by new ones, others kept; doing it twice changes nothing."""
    return stored.join(ran.select(key).distinct(), key, "left_anti").unionByName(new.join(ran.select(key).distinct(), key, "left_semi"))


def best_attempt(attempts: DataFrame, keys: list[str]) -> DataFrame:
    """The attempt with the fewest problems; a later one only if it has strictly fewer."""
    order = Window.partitionBy(*keys).orderBy("problems", "attempt")
    return attempts.withColumn("_n", F.row_number().over(order)).filter("_n = 1").drop("_n")


def replay(stored: DataFrame, again: DataFrame, keys: list[str], fields: list[str]) -> DataFrame:
    """keys, field, stored, again: fields that a second computation gives otherwise."""
    a, b = stored.select(*keys, *[F.col(f).cast("string").alias(f"a_{f}") for f in fields]), again.select(*keys, *[F.col(f).cast("string").alias(f"b_{f}") for f in fields])
    pairs = F.array(*[F.struct(F.lit(f).alias("field"), F.col(f"a_{f}").alias("stored"), F.col(f"b_{f}").alias("again")) for f in fields])
    rows = a.join(b, keys, "inner").select(*keys, F.explode(F.filter(pairs, lambda x: ~x["stored"].eqNullSafe(x["again"]))).alias("x"))
    return rows.select(*keys, "x.field", "x.stored", "x.again")


def rebuilt(stored: DataFrame, again: DataFrame, keys: list[str], fields: list[str]) -> DataFrame:
    """field, compared, differing, first: a stored run against the one made again from its answers, all fields in one join and one aggregate.

    first is the least key (its parts joined by /) where a field differs, null where none does.  Rows of one side only are the fields
    "missing" (only made again) and "extra" (only stored); these are compared in no other field.
    """
    side = lambda df, name: df.select(*keys, F.struct(*fields).alias(name))
    both = side(stored, "_a").join(side(again, "_b"), keys, "full_outer")
    key = F.struct(*keys)
    there = F.col("_a").isNotNull() & F.col("_b").isNotNull()
    differs = {f: there & ~F.col(f"_a.{f}").eqNullSafe(F.col(f"_b.{f}")) for f in fields} | {"missing": F.col("_a").isNull(), "extra": F.col("_b").isNull()}
    sums = [x for i, c in enumerate(differs.values()) for x in (F.count_if(c).alias(f"n{i}"), F.min(F.when(c, key)).alias(f"k{i}"))]
    one = both.agg(F.count_if(there).alias("same"), F.count("*").alias("all"), *sums)
    named_ = [
        F.struct(F.lit(f).alias("field"), F.col("same" if f in fields else "all").alias("compared"), F.col(f"n{i}").alias("differing"), F.when(F.col(f"k{i}").isNotNull(), F.concat_ws("/", *[F.col(f"k{i}.{k}").cast("string") for k in keys])).alias("first"))
        for i, f in enumerate(differs)
    ]
    return one.select(F.explode(F.array(*named_)).alias("x")).select("x.*")


def longest_prefix(left: DataFrame, right: DataFrame, a: str, b: str) -> DataFrame:
    """left rows with the longest right value that is a prefix of theirs at a word's end, or equal.

    Prefixes are looked up by equality, one row per word of the value, not by comparing all pairs.
    """
    words = F.split(F.col(a), " ")
    starts = F.transform(F.sequence(F.lit(1), F.size(words)), lambda n: F.array_join(F.slice(words, F.lit(1), n), " "))
    rows = left.withColumn("_p", F.explode(starts)).join(right.select(F.col(b).alias("_p")).distinct(), "_p", "left_semi")
    best = rows.groupBy(*left.columns).agg(F.max_by("_p", F.length("_p")).alias("prefix"))
    return left.join(best, left.columns, "left")


def stratified(docs: DataFrame, kind: str, year: str, size: str, key: str, n: int, seed: int) -> DataFrame:
    """n documents: the largest of each kind, then the others, dealt round robin over kinds and years, in a seeded order inside each.

    The largest are found by an aggregate, the others ranked inside their stratum; there is no sort over all documents.
    """
    largest = docs.groupBy(kind).agg(F.min_by(key, F.struct(-F.col(size), F.col(key))).alias("_key"))
    chosen = largest.withColumn("_r", F.row_number().over(Window.partitionBy(F.lit(0)).orderBy(sets.seeded(seed, kind), kind))).filter(F.col("_r") <= n)  # a row a kind
    first = docs.join(F.broadcast(chosen.select("_key")), docs[key] == F.col("_key"), "left_semi")
    rest = docs.join(F.broadcast(largest.select("_key")), docs[key] == F.col("_key"), "left_anti")
    kinds = largest.count()
    return first if kinds >= n else first.unionByName(sets.spread(rest, [kind, year], key, n - kinds, seed))



def index_records(docs: DataFrame) -> DataFrame:
    """Whole-document index records of rows (doc_id, source, title, text, esas_year, karar_year): the 28 fields of the index."""
    from decisionloom.functions import ids, vocab

    esas, karar, note = filled_years(F.col("esas_year"), F.col("karar_year"))
    uuid = ids.uuid5(vocab.NAMESPACE_DNS, F.concat_ws(":", "source", F.col("doc_id").cast("string")))
    none = lambda kind: F.lit(None).cast(kind)
    return docs.select(
        uuid.alias("uuid"), F.concat(F.lit("__"), F.col("doc_id").cast("string"), F.lit(".txt")).alias("filename"), "title", F.col("source").alias("court"), none("string").alias("high_court"), ids.chamber(F.col("title")).alias("chamber"),
        ids.year_no(F.col("esas_year"), F.lit(1)).alias("E_no"), ids.year_no(F.col("karar_year"), F.lit(1)).alias("K_no"), esas.alias("esas_year"), karar.alias("karar_year"), none("int").alias("esas_series"), none("int").alias("karar_series"),
        uuid.alias("parent_uuid"), F.lit("document").alias("unit"), F.lit(1).alias("schema_version"), "text", F.array().cast("array<string>").alias("paragraph_ids"), F.lit(0).alias("chunk_index"), none("string").alias("role"), none("string").alias("role_vocabulary"),
        none("string").alias("content_type"), none("string").alias("confidence"), none("string").alias("case_no"), none("string").alias("decision_date"), F.col("source").alias("source_type"), F.array().cast("array<string>").alias("cited_legislations"), F.array().cast("array<string>").alias("law_refs"),
        F.filter(F.array(note), lambda x: x.isNotNull()).alias("derivation_notes"),
    )


def contract_problems() -> Column:
    """Problems of an index record, by name."""
    return named(
        {
            "missing_uuid": F.coalesce(F.col("uuid"), F.lit("")) == "",
            "missing_parent": F.coalesce(F.col("parent_uuid"), F.lit("")) == "",
            "empty_text": F.coalesce(F.trim("text"), F.lit("")) == "",
            "no_year": F.col("esas_year").isNull() | F.col("karar_year").isNull(),
            "chamber_out_of_range": F.col("chamber").isNotNull() & ~F.col("chamber").between(1, 50),
            "unknown_unit": ~F.coalesce(F.col("unit").isin("chunk", "document", "capsule"), F.lit(False)),
            "chunk_without_paragraphs": (F.col("unit") == "chunk") & (F.size("paragraph_ids") == 0),
            "chunk_without_role": (F.col("unit") == "chunk") & F.col("role").isNull(),
        }
    )


#: Fields that the index is searched by, the courts it knows, and the namespace of parents' identifiers.
PRODUCTION_FIELDS = ["uuid", "filename", "title", "court", "high_court", "chamber", "E_no", "K_no", "esas_year", "karar_year", "esas_series", "karar_series"]
HIGH_COURTS = ["bam", "yargitay", "danistay", "first_degree", "aym", "kvkk", "rekabet", "uyusmazlik"]
PARENT_NAMESPACE = "6f2b7c31-9d84-4a1e-bd0c-3e5f8a7d2c46"


def chunk_records(chunks: DataFrame, raw: DataFrame, doc: str = "doc_id") -> DataFrame:
    """Index records of chunks with their raw records (title, esas_year, esas_no, karar_year, karar_no), and their `problems` and `gap`.

    chunks without a raw record are left out; unmatched() tells which.
    """
    from decisionloom.functions import ids, legal

    rows = chunks.join(raw, doc)
    esas, karar, _ = filled_years(F.col("esas_year"), F.col("karar_year"))
    source, title = F.col("source_type"), F.col("title")
    chamber = ids.chamber(title)
    notes = {
        "esas_year_from_karar_year": F.col("esas_year").isNull() & F.col("karar_year").isNotNull(),
        "karar_year_from_esas_year": F.col("karar_year").isNull() & F.col("esas_year").isNotNull(),
        "no_chamber_in_title": chamber.isNull(),
    }
    field = F.when(source == "aym", "firac").when(source.isin("kvkk", "rekabet"), "regulatory").otherwise("court_reasoning")
    keys = F.flatten(F.transform("cited_legislations", lambda g: ids.law_refs(g["canonical_id"], g["law_no"], g["law_short"], g["article_no"])))
    records = rows.select(
        doc, F.col("chunk_id").alias("uuid"), F.concat(F.lit("__"), F.col(doc).cast("string"), F.lit(".txt")).alias("filename"), F.nullif(title, F.lit("")).alias("title"), legal.court(title, source).alias("court"), source.alias("high_court"), chamber.alias("chamber"),
        ids.year_no(esas, F.col("esas_no")).alias("E_no"), ids.year_no(karar, F.col("karar_no")).alias("K_no"), esas.alias("esas_year"), karar.alias("karar_year"), F.col("esas_no").alias("esas_series"), F.col("karar_no").alias("karar_series"),
        ids.uuid5(PARENT_NAMESPACE, F.concat_ws(":", source, F.col(doc).cast("string"))).alias("parent_uuid"), F.lit("chunk").alias("unit"), F.lit(1).alias("schema_version"), "text",
        F.transform("refs", lambda i: F.concat(F.lit("p"), i.cast("string"))).alias("paragraph_ids"), "chunk_index", "role", field.alias("role_vocabulary"), "content_type", "confidence", "case_no", "decision_date", "source_type", "cited_legislations",
        F.array_sort(F.array_distinct(keys)).alias("law_refs"), named(notes).alias("derivation_notes"),
    )
    return records.withColumn("problems", record_problems()).withColumn("gap", production_gap())


def record_problems() -> Column:
    """Every way in which an index record would fail: what raises, what is never found, what can't be joined, what is empty."""
    blank = lambda c: F.coalesce(F.trim(c), F.lit("")) == ""
    chunk = F.col("unit") == "chunk"
    return named(
        {
            "esas_year_not_int": F.col("esas_year").isNull(), "karar_year_not_int": F.col("karar_year").isNull(), "esas_year_null": F.col("esas_year").isNull(),
            "uuid_missing": blank("uuid"), "parent_uuid_missing": blank("parent_uuid"), "high_court_unknown": ~F.coalesce(F.col("high_court").isin(*HIGH_COURTS), F.lit(False)),
            "text_empty": blank("text"), "paragraph_ids_empty": chunk & (F.size("paragraph_ids") == 0), "role_null": chunk & F.col("role").isNull(),
        }
    )


def production_gap() -> Column:
    """Fields that the index is searched by and that are null or empty."""
    return named({f: F.coalesce(F.col(f).cast("string"), F.lit("")) == "" for f in PRODUCTION_FIELDS})


def unmatched(chunks: DataFrame, raw: DataFrame, keys: list[str]) -> DataFrame:
    """keys and chunks: documents of stored chunks, by the identifier in their label, that have no raw record."""
    return chunks.join(raw.select(*keys), keys, "left_anti").groupBy(*keys).agg(F.count("*").alias("chunks"))


def usable_first(records: DataFrame, reserved: DataFrame, n: int, key: str = "doc_id", order: str = "doc_id", statuses: tuple[str, ...] = ("fetched", "completed")) -> tuple[DataFrame, DataFrame]:
    """The first n usable records that aren't reserved, and one row of counts: reserved, without text, usable."""
    flagged = records.join(reserved.select(key).distinct().withColumn("held", F.lit(True)), key, "left").withColumn("held", F.coalesce("held", F.lit(False)))
    body = F.concat(F.coalesce("content_text", F.lit("")), F.coalesce("html_content", F.lit("")))
    flagged = flagged.withColumn("usable", F.coalesce(F.col("status").isin(*statuses), F.lit(False)) & (F.trim(body) != ""))
    counts = flagged.agg(F.count_if("held").alias("reserved"), F.count_if(~F.col("held") & ~F.col("usable")).alias("unusable"), F.count_if(~F.col("held") & F.col("usable")).alias("usable"))
    return flagged.filter(~F.col("held") & F.col("usable")).orderBy(order).limit(n).drop("held", "usable"), counts


def picked(records: DataFrame, wanted: DataFrame, key: str = "doc_id") -> DataFrame:
    """Records of a list (pos, key), in its order."""
    return records.join(wanted, key).orderBy("pos")


def without_examples(records: DataFrame, examples: DataFrame) -> DataFrame:
    """Records that no worked example (source, case_no or doc_id) was made of."""
    by_case = examples.filter("case_no IS NOT NULL").select("source", "case_no").distinct()
    by_doc = examples.filter("doc_id IS NOT NULL").select("source", "doc_id").distinct()
    return records.join(by_case, ["source", "case_no"], "left_anti").join(by_doc, ["source", "doc_id"], "left_anti")


def null_fields_by_source(records: DataFrame, source: str = "source_type") -> DataFrame:
    """field, sources: where each searched field is null or empty."""
    return records.select(source, F.explode(production_gap()).alias("field")).groupBy("field").agg(F.array_sort(F.collect_set(source)).alias("sources"))


def source_counts(chunks: DataFrame, source: str = "source", doc: str = "doc_id") -> DataFrame:
    """chunks(source, doc, title, case_no, karar_no, refs, text) -> by source: documents, chunks, those that are usable (text under the cap), with a chamber in their title, with either number, and paragraphs."""
    has = lambda c: F.coalesce(F.trim(F.col(c).cast("string")), F.lit("")) != ""
    ok = has("text") & (F.length("text") <= vocab.SIZE_CAP)
    return chunks.groupBy(source).agg(
        F.countDistinct(doc).alias("documents"), F.count("*").alias("chunks"), F.count_if(ok).alias("ok"), F.count_if(ids.chamber(F.col("title")).isNotNull()).alias("has_chamber"),
        F.count_if(has("case_no")).alias("has_esas_no"), F.count_if(has("karar_no")).alias("has_karar_no"), F.sum(F.size("refs")).alias("paras"),
    )


def text_columns(records: DataFrame) -> DataFrame:
    """One row: records, those with plain text, those with HTML."""
    filled = lambda c: F.coalesce(F.trim(c), F.lit("")) != ""
    return records.agg(F.count("*").alias("records"), F.count_if(filled("content_text")).alias("content"), F.count_if(filled("html_content")).alias("html"))


def failed_reviews(reviews: DataFrame) -> DataFrame:
    """Reviews of documents that were not stored; those that only carry flags are no failures."""
    return reviews.filter(F.col("reason").isNotNull() & (F.col("reason") != "") & (F.col("reason") != "validation_flags"))


def produced(chunks: DataFrame, expected: DataFrame, doc: str = "doc_id") -> DataFrame:
    """One row: documents that were expected, those produced, and those of both."""
    made = chunks.select(doc).distinct().withColumn("made", F.lit(1))
    rows = expected.select(doc).distinct().withColumn("wanted", F.lit(1)).join(made, doc, "full_outer")
    return rows.agg(F.count("wanted").alias("expected"), F.count("made").alias("produced"), F.count_if(F.col("wanted").isNotNull() & F.col("made").isNotNull()).alias("both"))


def uncovered_archetypes(profile: DataFrame) -> DataFrame:
    """profile(source, shape, documents, covered) -> source, archetypes, uncovered documents and their share."""
    missed = F.sum(F.when(~F.col("covered"), F.col("documents")).otherwise(0))
    return profile.groupBy("source").agg(F.count("*").alias("archetypes"), missed.alias("uncovered"), F.round(missed / F.sum("documents"), 6).alias("share"))


def second_read(chunks: DataFrame, capsules: DataFrame, fixes: DataFrame, doc: str = "doc_id") -> tuple[DataFrame, DataFrame, DataFrame]:
    """Chunks and capsules with the roles and outcomes that a second reader gave, and by document how many were changed and how many capsules it misses.

    fixes(doc, kind 'role', 'outcome' or 'missing', key, value): key is the chunk's label or the capsule's index as text.
    """
    of = lambda kind: fixes.filter(F.col("kind") == kind).groupBy(doc, "key").agg(F.max("value").alias("value"))
    roles = chunks.join(of("role").withColumnRenamed("key", "chunk_label"), [doc, "chunk_label"], "left").withColumn("changed", F.col("value").isNotNull() & (F.col("value") != F.col("role")))
    outcomes = capsules.withColumn("key", F.col("capsule_index").cast("string")).join(of("outcome"), [doc, "key"], "left").withColumn("changed", F.col("value").isNotNull() & (F.col("value") != F.col("outcome")))
    missing = fixes.filter("kind = 'missing'").groupBy(doc).agg(F.count("*").alias("missing"))
    changed = roles.filter("changed").select(doc).unionAll(outcomes.filter("changed").select(doc)).groupBy(doc).agg(F.count("*").alias("changed"))
    counts = changed.join(missing, doc, "full_outer").select(doc, F.coalesce("changed", F.lit(0)).alias("changed"), F.coalesce("missing", F.lit(0)).alias("missing"))
    c = roles.withColumn("role", F.coalesce("value", "role")).drop("value", "changed")
    k = outcomes.withColumn("outcome", F.coalesce("value", "outcome")).drop("value", "changed", "key")
    return c, k, counts


def rights_against_capsules(verdicts: DataFrame, capsules: DataFrame, doc: str = "doc_id") -> DataFrame:
    """doc, right, verdict, outcomes: verdicts(doc, right slug, verdict) of the court's own metadata that no capsule on the right shares."""
    by = capsules.select(doc, "subject_id", "outcome")
    same = (verdicts["right"] == by["subject_id"]) & (verdicts[doc] == by[doc])
    rows = verdicts.join(by, same, "left").groupBy(verdicts[doc], verdicts["right"], verdicts["verdict"]).agg(F.array_sort(F.collect_set("outcome")).alias("outcomes"))
    return rows.filter(~F.array_contains("outcomes", F.col("verdict")))
