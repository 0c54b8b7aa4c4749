"""Schemas of stored records: explicit, never inferred."""

from pyspark.sql import types as T

#: The columns of a raw record.
_STRINGS = ["id", "doc_id", "court_type", "title", "content_text", "html_content", "subjects", "metadata", "status", "finalization_status", "failure_reason", "extraction_status", "meili_status", "qdrant_status", "sync_failure_reason", "next_retry_at", "last_finalization_check_at", "next_finalization_check_at", "created_at", "updated_at"]
_INTS = ["esas_year", "esas_no", "karar_year", "karar_no", "chamber_id", "retry_count"]
RAW = T.StructType([T.StructField(c, T.StringType()) for c in _STRINGS] + [T.StructField(c, T.IntegerType()) for c in _INTS])

#: The fields of a citation, a chunk and a capsule.
CITATION = T.StructType([T.StructField(c, T.StringType()) for c in ["canonical_id", "legislation_type", "law_no", "law_short", "law_name", "article_no", "paragraph_no", "verbatim_mention", "law_date", "confidence"]])
CHUNK = T.StructType(
    [T.StructField(c, T.StringType()) for c in ["chunk_id", "chunk_label", "source_type", "case_no", "decision_date", "citation_granularity"]]
    + [T.StructField("source_paragraph_ids", T.ArrayType(T.StringType())), T.StructField("text", T.StringType()), T.StructField("char_length", T.IntegerType())]
    + [T.StructField(c, T.StringType()) for c in ["content_type", "firac_role", "court_reasoning_role", "regulatory_role", "reasoning_stage"]]
    + [T.StructField("rights", T.ArrayType(T.StringType()))]
    + [T.StructField(c, T.StringType()) for c in ["confidence", "role", "role_vocabulary"]]
    + [T.StructField("schema_version", T.IntegerType()), T.StructField("cited_legislations", T.ArrayType(CITATION))]
)
CAPSULE = T.StructType([T.StructField(c, T.StringType()) for c in ["case_no", "source_type", "decision_date", "subject_type", "subject_id", "opinion_type", "outcome", "conclusion_sentence", "reasoning_summary", "reasoning_summary_method"]] + [T.StructField("supporting_chunk_ids", T.ArrayType(T.StringType()))])
OUTPUT = T.StructType([T.StructField("chunks", T.ArrayType(CHUNK)), T.StructField("reasoning_capsules", T.ArrayType(CAPSULE))])
ANSWERS = T.StructType([T.StructField("doc_id", T.StringType()), T.StructField("request_key", T.StringType()), T.StructField("attempt", T.IntegerType()), T.StructField("window_lo", T.IntegerType()), T.StructField("window_hi", T.IntegerType()), T.StructField("raw_json", T.StringType())])
#: Parts of an answer to the structure request.
STRUCTURE = T.StructType([T.StructField("segments", T.ArrayType(T.StructType([T.StructField("local_id", T.StringType()), T.StructField("paragraph_refs", T.ArrayType(T.StringType())), T.StructField("confidence", T.StringType()), T.StructField("role", T.StringType())])))])
