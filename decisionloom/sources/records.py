"""Reading and writing records: raw sources, exports, outputs, worksheets.  Paths are Spark's, so any store it reads will do."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from decisionloom.functions import text
from decisionloom.operators.records import merge_new
from decisionloom.sources import schema
from decisionloom.streaming.flush import _note, versions


def _source() -> Column:
    return F.regexp_extract(F.col("_metadata.file_name"), r"^(.*)\.json$", 1)


def read_raw(spark: SparkSession, folder: str, sources: list[str] | None = None) -> DataFrame:
    """Raw records of one JSON array per source, named after it; backups and unknown sources are skipped."""
    files = spark.read.schema(schema.RAW).option("multiLine", True).option("pathGlobFilter", "*.json").json(folder)
    rows = files.withColumn("source", _source()).filter(~F.col("source").startswith("documents_document"))
    return rows.filter(F.col("source").isin(sources)) if sources else rows


def wanted(raw: DataFrame, keys: DataFrame) -> DataFrame:
    """Raw records of the wanted (source, doc_id)."""
    return raw.join(keys, ["source", "doc_id"], "left_semi")


def usable(raw: DataFrame, statuses: list[str]) -> DataFrame:
    """Records of an allowed status with text in either column."""
    has = lambda c: F.trim(F.coalesce(F.col(c), F.lit(""))) != ""
    return raw.filter(F.col("status").isin(statuses) & (has("content_text") | has("html_content")))


def documents(raw: DataFrame, limit: int | None = None) -> DataFrame:
    """raw + paragraphs, without records that have none; the first of them in the order of file and id, where there is a limit."""
    from decisionloom.functions import html

    rows = raw.withColumn("paragraphs", html.extractor()("content_text", "html_content")["paragraphs"]).filter(F.size("paragraphs") > 0)
    return rows if limit is None else rows.orderBy("source", "doc_id").limit(limit)


def of_document(chunks: DataFrame, source: str, doc_id: str) -> DataFrame:
    """Stored chunks of one document, by the identifier in their label."""
    return chunks.filter((F.col("source") == source) & (F.substring_index("chunk_label", "-p", 1) == doc_id)).orderBy("pos")


def raw_column(raw: DataFrame) -> Column:
    """The longer of the two text columns."""
    a, b = F.coalesce("content_text", F.lit("")), F.coalesce("html_content", F.lit(""))
    return F.when(F.length(a) >= F.length(b), a).otherwise(b)


def ground_text() -> Column:
    """All text of a record in one, for looking topics up."""
    return text.tr_lower(F.concat_ws(" ", "content_text", "html_content", "title"))


def unwrap_export(spark: SparkSession, path: str) -> DataFrame:
    """Rows (raw JSON strings) of an export: a bare list, or one object of one key that holds the list; anything else is refused."""
    whole = spark.read.text(path, wholetext=True).select("value")
    bare = F.from_json("value", T.ArrayType(T.StringType()))
    keyed = F.from_json("value", T.MapType(T.StringType(), T.ArrayType(T.StringType())))
    one = F.when(F.col("value").rlike(r"^\s*\["), bare).when(F.size(F.map_keys(keyed)) == 1, F.element_at(F.map_values(keyed), 1))
    return whole.select(F.explode(F.coalesce(one, F.raise_error(F.lit("an export is a list, or an object of one key")).cast("array<string>"))).alias("row"))


def merge_export(incoming: DataFrame, path: str, source: str, key: str = "doc_id") -> DataFrame:
    """Add an export's rows of new keys to the table of a source at path; one row: existing, incoming, added, duplicates, backup.

    Rows of another court_type refuse the whole export before anything is written.  The merged table is written beside the one that
    is there and becomes current by a rename of its note; the one before stays as the backup, whose folder is returned (null at first).
    """
    spark = incoming.sparkSession
    wrong = [r[0] for r in incoming.filter(~F.col("court_type").eqNullSafe(F.lit(source))).select("court_type").distinct().limit(5).collect()]
    if wrong:
        raise ValueError(f"rows carry court_type {sorted(map(str, wrong))}, not {source}")
    current = versions(spark, f"{path}/{source}")
    backup = current["parts"]["whole"] if current else None
    existing = spark.read.schema(incoming.schema).parquet(backup) if backup else incoming.limit(0)
    name, number = f"{path}/{source}/v-{uuid.uuid4().hex}", current["number"] + 1 if current else 1
    merge_new(existing, incoming, key).write.parquet(name)
    before, came, after = existing.count(), incoming.count(), spark.read.schema(incoming.schema).parquet(name).count()
    _note(spark, f"{path}/{source}", {"number": number, "parts": {"whole": name}, "batches": []})
    return spark.createDataFrame([(before, came, after - before, came - after + before, backup)], "existing long, incoming long, added long, duplicates long, backup string")


def read_export(spark: SparkSession, path: str, source: str, rows: T.StructType) -> DataFrame:
    """The current table of a source."""
    current = versions(spark, f"{path}/{source}")
    return spark.read.schema(rows).parquet(current["parts"]["whole"]) if current else spark.createDataFrame([], rows)


def schema_faults(rows: DataFrame, column: str = "row") -> DataFrame:
    """row, missing, extra: rows whose keys aren't exactly those of a raw record."""
    want = F.array(*[F.lit(c) for c in schema.RAW.fieldNames()])
    keys = F.json_object_keys(column)
    return rows.select(column, F.array_except(want, keys).alias("missing"), F.array_except(keys, want).alias("extra")).filter((F.size("missing") > 0) | (F.size("extra") > 0))


def read_output(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    """Chunks and capsules of generated outputs, with their source and their place in the file."""
    files = spark.read.schema(schema.OUTPUT).option("multiLine", True).option("pathGlobFilter", "*.json").json(folder).withColumn("source", _source())
    files = files.filter(~F.col("source").endswith("_review"))
    part = lambda c: files.select("source", F.posexplode(c).alias("pos", "x")).select("source", "pos", "x.*")
    return part("chunks"), part("reasoning_capsules")


def read_queries(spark: SparkSession, path: str, stage: str | None = None) -> DataFrame:
    """query, source, stage, expect_doc_id, expect_paragraph of a query file; doc_id counts as expect_doc_id."""
    fields = ["query", "source", "stage", "expect_doc_id", "doc_id", "expect_case_no", "expect_paragraph"]
    one = T.StructType([T.StructField(c, T.StringType()) for c in fields])
    rows = spark.read.schema(T.StructType([T.StructField("queries", T.ArrayType(one))])).option("multiLine", True).json(path)
    out = rows.select(F.explode("queries").alias("q")).select("q.*").withColumn("expect_doc_id", F.coalesce("expect_doc_id", "doc_id")).drop("doc_id")
    return out.filter(F.col("stage") == stage) if stage else out


def file_hash(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.format("binaryFile").load(path).select("path", F.sha2("content", 256).alias("sha256"))


def write_by_source(rows: DataFrame, path: str) -> bool:
    """Overwrite the sources that rows hold, and no others; an empty result replaces nothing.  Whether anything was written."""
    if rows.isEmpty():
        return False
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("source").parquet(path)
    return True


def worksheets(paragraphs: DataFrame) -> DataFrame:
    """(source, doc_id, value): one text per document, its paragraphs numbered."""
    rows = paragraphs.groupBy("source", "doc_id").agg(F.array_sort(F.collect_list(F.struct("para", "text"))).alias("p"))
    return rows.select("source", "doc_id", text.numbered(F.transform("p", lambda x: x["text"])).alias("value"))


def run_set(docs: DataFrame) -> DataFrame:
    """source, doc_ids: what a run is to cover."""
    return docs.groupBy("source").agg(F.array_sort(F.collect_list("doc_id")).alias("doc_ids"))
