"""Stored answers of a model, reviews and worked examples, and files that a run leaves: reading and writing them.  No model is called."""

from __future__ import annotations

import os
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from decisionloom.functions import ids, text
from decisionloom.sources import schema


@dataclass(frozen=True)
class Settings:
    """What a run can be told by the session's settings decisionloom.*: prices of a million tokens, and whether requests went as a batch at half the price."""

    price_input: float = 0.10
    price_output: float = 0.40
    batch: bool = False

    @classmethod
    def of(cls, spark: SparkSession) -> Settings:
        read = lambda key, default: spark.conf.get(f"decisionloom.{key}", str(default))
        return cls(float(read("price_input", cls.price_input)), float(read("price_output", cls.price_output)), read("batch", cls.batch).lower() == "true")

    def cost(self, tokens_in: Column, tokens_out: Column) -> Column:
        return (tokens_in * self.price_input + tokens_out * self.price_output) / 1e6 * (0.5 if self.batch else 1.0)


REVIEW = T.StructType(
    [T.StructField(c, T.StringType()) for c in ("doc_id", "case_no", "reason", "error", "fallback")]
    + [T.StructField(c, T.ArrayType(T.StringType())) for c in ("failed_checks", "issues", "soft", "log")]
)


def _source() -> Column:
    return F.regexp_extract(F.col("_metadata.file_name"), r"^(.*)\.json$", 1)


def run_folder(base: str, name: str) -> str:
    """A run's folder: a path as it is, a name below the base."""
    return name if os.path.isabs(name) or "://" in name else f"{base.rstrip('/')}/{name}"


def read_reviews(spark: SparkSession, folder: str) -> DataFrame:
    """Reviews (one array for each source, in <source>_review.json), with their source."""
    files = spark.read.schema(REVIEW).option("multiLine", True).option("pathGlobFilter", "*_review.json").json(folder)
    return files.select(F.regexp_replace(_source(), "_review$", "").alias("source"), "*")


def read_examples(spark: SparkSession, folder: str) -> DataFrame:
    """source, case_no or doc_id of every document that a worked example was made from; the source is the entry's, else the file's."""
    files = spark.read.schema(schema.OUTPUT).option("multiLine", True).option("pathGlobFilter", "*.json").json(folder).withColumn("file", _source())
    chunks = files.select("file", F.explode("chunks").alias("x")).select(F.coalesce("x.source_type", "file").alias("source"), "x.case_no", "x.chunk_label")
    capsules = files.select("file", F.explode("reasoning_capsules").alias("x")).select(F.coalesce("x.source_type", "file").alias("source"), "x.case_no", F.lit(None).cast("string").alias("chunk_label"))
    all_ = chunks.unionByName(capsules)
    labelled = all_.filter(F.contains("chunk_label", F.lit("-p"))).select("source", F.lit(None).cast("string").alias("case_no"), ids.doc_of_label(F.col("chunk_label")).alias("doc_id"))
    cased = all_.filter("case_no IS NOT NULL").select("source", "case_no", F.lit(None).cast("string").alias("doc_id"))
    return cased.unionByName(labelled).distinct()


def read_answers(spark: SparkSession, path: str) -> DataFrame:
    """Stored answers: doc_id, request_key, attempt, window_lo, window_hi, raw_json."""
    return spark.read.schema(schema.ANSWERS).json(path)


REFS = T.ArrayType(T.StringType())
_SEGMENT = T.StructType([T.StructField("local_id", T.StringType()), T.StructField("paragraph_refs", REFS), T.StructField("role", T.StringType()), T.StructField("confidence", T.StringType()), T.StructField("rights", REFS)])
_CAPSULE = T.StructType(
    [T.StructField(c, T.StringType()) for c in ("outcome", "opinion_type", "subject_id", "conclusion_sentence", "reasoning_summary")]
    + [T.StructField(c, REFS) for c in ("dissent_authors", "supporting_paragraph_refs", "supporting_local_ids")]
)
_LAW = T.StructType([T.StructField(c, T.StringType()) for c in ("legislation_type", "law_no", "law_short", "law_name", "article_no", "paragraph_no", "law_date", "verbatim_mention")])
ANSWER = T.StructType(
    [
        T.StructField("segments", T.ArrayType(_SEGMENT)),
        T.StructField("capsules", T.ArrayType(_CAPSULE)),
        T.StructField("paragraphs", T.ArrayType(T.StructType([T.StructField("ref", T.StringType()), T.StructField("cited_legislations", T.ArrayType(_LAW))]))),
    ]
)


def parsed(answers: DataFrame) -> DataFrame:
    """answers + answer, a struct of segments, capsules and paragraphs: null where the JSON can't be read."""
    return answers.withColumn("answer", F.from_json("raw_json", ANSWER, {"mode": "PERMISSIVE"}))


def saved_capsules(structures: DataFrame, capsules: DataFrame, doc: str = "doc_id") -> DataFrame:
    """doc, pos, capsule: from an answer of their own, or, where there is none, from inside an older structure answer, whose capsules point at segments: these become the segments' paragraphs; capsules without any are left out.

    Both inputs are parsed() answers of one request each.
    """
    own = capsules.select(doc, F.posexplode("answer.capsules").alias("pos", "capsule"))
    older = structures.join(own.select(doc).distinct(), doc, "left_anti").select(doc, "answer.segments", F.posexplode("answer.capsules").alias("pos", "c"))
    none = F.array().cast("array<string>")
    of = lambda local: F.flatten(F.transform(F.filter("segments", lambda s: s["local_id"] == local), lambda s: F.coalesce(s["paragraph_refs"], none)))
    pointed = F.flatten(F.transform(F.coalesce("c.supporting_local_ids", none), of))
    moved = older.withColumn("capsule", F.col("c").withField("supporting_paragraph_refs", F.coalesce("c.supporting_paragraph_refs", pointed)))
    moved = moved.filter(F.size("capsule.supporting_paragraph_refs") > 0).select(doc, "pos", "capsule")
    return own.unionByName(moved)


def laws_by_paragraph(answers: DataFrame, sizes: DataFrame, doc: str = "doc_id") -> tuple[DataFrame, DataFrame]:
    """Citations (doc, para, pos, fields of a law) of windowed answers, and by window: references that are invalid or outside it, and paragraphs not answered.

    answers: parsed(), with window_lo and window_hi; sizes(doc, n).
    """
    items = answers.join(sizes, doc).select(doc, "window_lo", "window_hi", "n", F.posexplode_outer("answer.paragraphs").alias("item", "x"))
    para = F.nullif(F.regexp_extract(F.trim("x.ref"), r"^p(\d+)$", 1), F.lit("")).try_cast("int")
    items = items.withColumn("para", F.when(para.between(1, F.col("n")) & para.between(F.col("window_lo"), F.col("window_hi")), para))
    span = F.col("window_hi") - F.col("window_lo") + 1
    counts = items.groupBy(doc, "window_lo", "window_hi").agg(F.count_if(F.col("x").isNotNull() & F.col("para").isNull()).alias("invalid"), F.count_distinct("para").alias("answered")).withColumn("unanswered", span - F.col("answered"))
    cites = items.filter("para IS NOT NULL").select(doc, "para", "item", F.posexplode("x.cited_legislations").alias("at", "law"))
    return cites.select(doc, "para", (F.col("item") * 1000 + F.col("at")).alias("pos"), "law.*"), counts


def write_report(report: DataFrame, path: str) -> None:
    """A report (bounded: a row a measure or finding) as one JSON file in a folder."""
    report.coalesce(1).write.mode("overwrite").json(path)


def write_index(records: DataFrame, path: str) -> DataFrame:
    """Index records as JSON, split by unit; returns one row for each unit: records, documents, invalid ones."""
    records.write.mode("overwrite").partitionBy("unit").json(path)
    return records.groupBy("unit").agg(F.count("*").alias("records"), F.countDistinct("parent_uuid").alias("documents"), F.count_if(F.size("problems") > 0).alias("invalid"))


def create_points(points: DataFrame, path: str, partition: str, recreate: bool = False) -> None:
    """A collection of vectors as a table split by its most used filter; an existing one stays unless it is to be made anew."""
    points.write.mode("overwrite" if recreate else "ignore").partitionBy(partition).parquet(path)


def verify_points(stored: DataFrame, expected: int, width: int, fields: list[str], key: str = "id", vector: str = "vector") -> DataFrame:
    """check, ok, detail after a write: how many points, their keys, their vectors' length and norm, and for each field, whether a probe for its most common value finds as many points as hold it."""
    norm = F.sqrt(ids.dot(F.col(vector), F.col(vector)))
    top = [F.mode(f, True).alias(f"top_{f}") for f in fields]
    one = stored.agg(F.count("*").alias("n"), F.countDistinct(key).alias("keys"), F.count_if(F.size(vector) != width).alias("odd"), F.count_if(F.abs(norm - 1) > 1e-3).alias("long"), *top)
    probes = stored.crossJoin(F.broadcast(one.select(*[f"top_{f}" for f in fields]))).agg(*[F.count_if(F.col(f) == F.col(f"top_{f}")).alias(f"hit_{f}") for f in fields]) if fields else None  # a row
    rows = one.crossJoin(probes) if fields else one
    checks = [("count", F.col("n") == expected, F.col("n")), ("unique keys", F.col("keys") == F.col("n"), F.col("keys")), ("vector size", F.col("odd") == 0, F.col("odd")), ("unit vectors", F.col("long") == 0, F.col("long"))]
    checks += [(f"field {f}", F.col(f"hit_{f}") > 0, F.col(f"hit_{f}")) for f in fields]
    return rows.select(F.explode(F.array(*[F.struct(F.lit(n).alias("check"), ok.alias("ok"), d.cast("long").alias("detail")) for n, ok, d in checks])).alias("x")).select("x.*")


def example_answer(output: DataFrame, outcomes: list[str], legacy: dict[str, str]) -> DataFrame:
    """A worked example in the shape of an answer: output(chunks, reasoning_capsules) -> segments, capsules.

    Paragraph ids lose their document, segments get local numbers, outcomes become those of the
    list (an older name by the table, else 'other'), and support becomes paragraph references.
    """
    short = lambda refs: F.transform(refs, lambda r: F.concat(F.lit("p"), F.regexp_extract(r, r"p(\d+)$", 1)))
    known = F.create_map(*[F.lit(x) for pair in legacy.items() for x in pair])
    role = lambda c: F.coalesce(c["firac_role"], c["court_reasoning_role"], c["regulatory_role"], c["role"])
    segments = F.transform("chunks", lambda c, i: F.struct(F.concat(F.lit("seg_"), (i + 1).cast("string")).alias("local_id"), short(c["source_paragraph_ids"]).alias("paragraph_refs"), role(c).alias("role"), F.coalesce(c["confidence"], F.lit("high")).alias("confidence")))

    def capsule(k):
        named = F.coalesce(F.element_at(known, text.strip_dot(k["outcome"])), k["outcome"])
        held = F.filter("chunks", lambda c: F.array_contains(k["supporting_chunk_ids"], c["chunk_id"]))
        refs = F.array_distinct(F.flatten(F.transform(held, lambda c: short(c["source_paragraph_ids"]))))
        author = F.nullif(F.substring_index(k["opinion_type"], ":", -1), k["opinion_type"])
        return F.struct(
            F.when(named.isin(*outcomes), named).otherwise("other").alias("outcome"), F.substring_index(F.coalesce(k["opinion_type"], F.lit("majority")), ":", 1).alias("opinion_type"),
            F.filter(F.array(author), lambda a: a.isNotNull()).alias("dissent_authors"), F.coalesce(k["subject_id"], F.lit("unspecified")).alias("subject_id"), k["conclusion_sentence"].alias("conclusion_sentence"), k["reasoning_summary"].alias("reasoning_summary"), refs.alias("supporting_paragraph_refs"),
        )

    return output.select(segments.alias("segments"), F.transform("reasoning_capsules", capsule).alias("capsules"))
