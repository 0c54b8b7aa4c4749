"""Round trips of sources, sinks and the streaming flush in a scratch folder."""

import json

import pytest
from pyspark.sql import functions as F

from decisionloom.sources import records, schema
from decisionloom.streaming import flush


def raw(doc, **more):
    return {c: None for c in schema.RAW.fieldNames()} | {"doc_id": doc, "status": "completed", "content_text": "a\nb", "html_content": ""} | more


def test_raw_export_and_schema(spark, tmp_path):
    (tmp_path / "kvkk.json").write_text(json.dumps([raw("1"), raw("2", content_text="")]))
    (tmp_path / "kvkk.json.bak-x").write_text("[]")
    got = records.read_raw(spark, str(tmp_path))
    assert sorted((r["source"], r["doc_id"]) for r in got.collect()) == [("kvkk", "1"), ("kvkk", "2")]
    assert [r["doc_id"] for r in records.usable(got, ["completed"]).collect()] == ["1"]
    export = tmp_path / "export.txt"
    export.write_text(json.dumps({"SELECT 1": [raw("3"), {"doc_id": "4"}]}))
    rows = records.unwrap_export(spark, str(export))
    assert rows.count() == 2
    assert records.schema_faults(rows).count() == 1
    export.write_text(json.dumps({"a": [], "b": []}))
    with pytest.raises(Exception, match="one key"):
        records.unwrap_export(spark, str(export)).collect()


def test_output_queries_worksheets(spark, tmp_path):
    (tmp_path / "out").mkdir()
    (tmp_path / "out/kvkk.json").write_text(json.dumps({"chunks": [{"chunk_label": "1-p1", "text": "a"}], "reasoning_capsules": [{"supporting_chunk_ids": ["x"]}]}))
    chunks, capsules = records.read_output(spark, str(tmp_path / "out"))
    assert (chunks.first()["chunk_label"], chunks.first()["source"], capsules.count()) == ("1-p1", "kvkk", 1)
    (tmp_path / "q.json").write_text(json.dumps({"queries": [{"query": "a", "stage": "case", "doc_id": "7"}, {"query": "b", "stage": "chunk"}]}))
    assert [r["expect_doc_id"] for r in records.read_queries(spark, str(tmp_path / "q.json"), "case").collect()] == ["7"]
    paras = spark.createDataFrame([("s", 1, 2, "b"), ("s", 1, 1, "a")], "source string, doc_id int, para int, text string")
    assert records.worksheets(paras).first()["value"] == "[p1] a\n[p2] b"


def test_write_keeps_other_sources_and_never_empties(spark, tmp_path):
    rows = lambda *x: spark.createDataFrame(x, "doc_id int, source string")
    path = str(tmp_path / "t")
    assert records.write_by_source(rows((1, "a"), (2, "b")), path)
    assert records.write_by_source(rows((3, "a")), path)
    assert not records.write_by_source(rows((4, "a")).filter("false"), path)
    assert sorted(r["doc_id"] for r in spark.read.parquet(path).collect()) == [2, 3]


def test_flush_twice_changes_nothing(spark, tmp_path):
    path = str(tmp_path / "t")
    first = spark.createDataFrame([(1, "a", "x"), (2, "a", "x"), (3, "b", "x")], "doc_id int, source string, v string")
    again = spark.createDataFrame([(2, "a", "y")], "doc_id int, source string, v string")
    for batch in (first, again, again):
        flush.flush(batch, path)
    read = lambda: sorted((r["doc_id"], r["v"]) for r in flush.read_table(spark, path, first.schema).collect())
    assert read() == [(1, "x"), (2, "y"), (3, "x")]
    flush.flush(spark.createDataFrame([(3, "b", "z")], first.schema), path, 7)
    before = flush.versions(spark, path)
    flush.flush(spark.createDataFrame([(3, "b", "other")], first.schema), path, 7)  # the same batch once more
    assert flush.versions(spark, path) == before and read() == [(1, "x"), (2, "y"), (3, "z")]
    flush.flush(first.limit(0), path, 8)
    assert read() == [(1, "x"), (2, "y"), (3, "z")]


def test_a_crash_inside_a_flush_leaves_the_last_version(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    rows = spark.createDataFrame([(1, "a", "x"), (2, "b", "x")], "doc_id int, source string, v string")
    flush.flush(rows, path, 0)

    def crash(*_):
        raise OSError("lost")

    monkeypatch.setattr(flush, "_note", crash)
    with pytest.raises(OSError):
        flush.flush(rows.withColumn("v", F.lit("y")), path, 1)
    assert {r["v"] for r in flush.read_table(spark, path, rows.schema).collect()} == {"x"}


def test_stream(spark, tmp_path):
    spark.range(5).select(F.col("id").cast("int").alias("doc_id"), F.lit("a").alias("source")).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema("doc_id int, source string").parquet(str(tmp_path / "in"))
    flush.start(stream, str(tmp_path / "out"), str(tmp_path / "cp")).awaitTermination(60)
    assert flush.read_table(spark, str(tmp_path / "out"), stream.schema).count() == 5
