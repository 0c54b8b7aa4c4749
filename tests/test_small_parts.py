"""Sources, fields and reports that no registered query needs."""

import hashlib
import json

import pytest
from pyspark.sql import functions as F

from decisionloom.functions import html, ids, legal
from decisionloom.operators import citations as C
from decisionloom.operators import evaluation as E
from decisionloom.operators import records as R
from decisionloom.operators import requests as Q
from decisionloom.sources import answers, records


def values(df, column):
    return [r[0] for r in df.select(column).collect()]


def test_export_merges_with_backup_and_refuses_other_courts(spark, tmp_path):
    rows = lambda *x: spark.createDataFrame(list(x), "doc_id long, court_type string, title string")
    path = str(tmp_path)
    one = records.merge_export(rows((1, "aym", "a"), (2, "aym", "b"), (2, "aym", "c")), path, "aym").first()
    assert one.asDict() == {"existing": 0, "incoming": 3, "added": 2, "duplicates": 1, "backup": None}
    for other in ("kvkk", None):
        with pytest.raises(ValueError, match="court_type"):
            records.merge_export(rows((3, "aym", "x"), (4, other, "x")), path, "aym")
    two = records.merge_export(rows((2, "aym", "new"), (3, "aym", "d")), path, "aym").first()
    assert (two["existing"], two["added"], two["duplicates"]) == (2, 1, 1)
    kind = rows((0, "", "")).schema
    assert sorted(tuple(r) for r in records.read_export(spark, path, "aym", kind).collect()) == [(1, "aym", "a"), (2, "aym", "b"), (3, "aym", "d")]
    assert spark.read.parquet(two["backup"]).count() == 2 and records.read_export(spark, path, "bam", kind).count() == 0


def test_texts_of_raw_records(spark):
    raw = spark.createDataFrame([("İLK", "<p>uzun metin</p>", "Ad"), (None, "<p>x</p>", None), ("aynı boy", "12345678", ""), (None, None, None)], "content_text string, html_content string, title string")
    assert values(raw, records.raw_column(raw)) == ["<p>uzun metin</p>", "<p>x</p>", "aynı boy", ""]
    assert values(raw, records.ground_text()) == ["ilk <p>uzun metin</p> ad", "<p>x</p>", "aynı boy 12345678 ", ""]
    assert values(raw.select(F.col("html_content").alias("h")).filter("h LIKE '<p>%'"), html.plain_text(F.col("h"))) == ["uzun metin", "x"]


def test_runs_answers_and_hashes(spark, tmp_path):
    docs = spark.createDataFrame([("b", 2), ("a", 9), ("b", 1)], "source string, doc_id long")
    assert {r["source"]: r["doc_ids"] for r in records.run_set(docs).collect()} == {"a": [9], "b": [1, 2]}
    stored = {"doc_id": 1, "request_key": "laws_1", "attempt": 2, "window_lo": 1, "window_hi": 60, "raw_json": "{}"}
    (tmp_path / "answers.json").write_text(json.dumps(stored) + "\n")
    row = answers.read_answers(spark, str(tmp_path / "answers.json")).first()
    assert row["request_key"] == "laws_1" and row["raw_json"] == "{}" and int(row["window_hi"]) == 60
    assert records.file_hash(spark, str(tmp_path / "answers.json")).first()["sha256"] == hashlib.sha256((tmp_path / "answers.json").read_bytes()).hexdigest()


def test_fields(spark):
    df = spark.createDataFrame([("12", None, ""), ("x", "", "facts"), (None, "ruling", "facts")], "a string, b string, c string")
    assert values(df, ids.int_or_null(F.col("a"))) == [12, None, None]
    assert values(df, legal.first_role(F.col("b"), F.col("c"))) == [None, "facts", "ruling"]
    capsule = spark.createDataFrame([("Sonuç.", "Özet", "adil_yargilanma_hakki"), (None, "Özet", "x")], "a string, b string, c string")
    assert values(capsule, E.capsule_text(F.col("a"), F.col("b"), F.col("c"))) == ["Sonuç. Özet adil yargilanma hakki", "Özet x"]


def test_null_fields_failures_and_problem_counts(spark):
    fields = R.PRODUCTION_FIELDS
    rows = spark.createDataFrame([("aym", *["v"] * len(fields)), ("bam", *[None, "", *["v"] * (len(fields) - 2)])], "source_type string, " + ", ".join(f"{f} string" for f in fields))
    assert {r["field"]: r["sources"] for r in R.null_fields_by_source(rows).collect()} == {fields[0]: ["bam"], fields[1]: ["bam"]}
    results = spark.createDataFrame([("case", "s", 1, 7, False), ("case", "s", 2, 8, True)], "stage string, source string, q int, expected int, top3 boolean")
    ranked = spark.createDataFrame([("case", 1, 3, 30), ("case", 1, 1, 10), ("case", 1, 2, 20), ("case", 1, 4, 7)], "stage string, q int, rank int, unit int")
    assert [tuple(r) for r in E.failures(results, ranked, "q", "unit").collect()] == [("case", "s", 1, 7, [10, 20, 30])]
    issues = spark.createDataFrame([(1, "a", "hard"), (1, "b", "soft"), (1, "dissent_same_outcome_as_majority", "soft"), (2, "b", "soft")], "doc_id long, kind string, severity string")
    assert {r["doc_id"]: r["problems"] for r in Q.problem_count(issues).collect()} == {1: 2, 2: 0}


def test_rebuilt_runs_are_compared_field_by_field(spark):
    kind = "d int, i int, text string, refs array<int>"
    stored = spark.createDataFrame([(1, 0, "a", [1]), (1, 1, "b", [2]), (2, 0, None, None), (9, 0, "x", [])], kind)
    again = spark.createDataFrame([(1, 0, "a", [1]), (1, 1, "c", [2, 3]), (2, 0, None, None), (3, 0, "y", [])], kind)
    got = {r["field"]: (r["compared"], r["differing"], r["first"]) for r in R.rebuilt(stored, again, ["d", "i"], ["text", "refs"]).collect()}
    assert got == {"text": (3, 1, "1/1"), "refs": (3, 1, "1/1"), "missing": (5, 1, "3/0"), "extra": (5, 1, "9/0")}
    assert {r["differing"] for r in R.rebuilt(again, again, ["d", "i"], ["text", "refs"]).collect()} == {0}


def test_coverage_probes_find_false_hits(spark):
    chunks = spark.createDataFrame([(1, 1, "5393 sayılı Kanun'un 15. maddesi"), (1, 2, "5393 sayılı Kanun'un 15. maddesi"), (2, 1, "hiçbir atıf"), (3, 1, "6098 sayılı Kanun'un 7. maddesi")], "doc_id long, para int, text string")
    index = C.references(chunks, ["doc_id", "para"])
    assert {(r["doc_id"], r["para"]): r["refs"] for r in index.collect()}[3, 1] == ["6098", "6098/7", "law-6098-art-7"]
    rows = {r["ref"]: tuple(r)[1:] for r in C.coverage(chunks, index, ["doc_id", "para"], most=4).collect()}
    assert rows["*"] == (3, 2, 6, None) and rows["5393"] == (2, 1, None, 0) and len(rows) == 5
    wrong = index.unionByName(spark.createDataFrame([(2, 1, ["5393"])], index.schema))
    assert {r["ref"]: r["false_positives"] for r in C.coverage(chunks, wrong, ["doc_id", "para"]).collect()}["5393"] == 1


def test_flags_of_the_staged_search(spark):
    from decisionloom.operators import vector as V

    points = spark.createDataFrame([(1, 100, 2024, [1.0, 0.0], ["p1"]), (2, 100, 2024, [0.9, 0.0], ["p2"]), (3, 200, 2020, [0.8, 0.0], ["p3"]), (4, 300, None, [1.0, 0.0], ["p4"])], "id long, parent long, year int, vector array<double>, paragraph_ids array<string>")
    queries = spark.createDataFrame([(7, [1.0, 0.0])], "query_id long, vector array<double>")
    store = V.text_store(spark.createDataFrame([(1, None, "chunk", "one"), (2, None, "chunk", "two"), (5, 200, "document", "whole")], "id long, parent long, unit string, text string"))
    search = lambda **o: V.staged_search(points, queries, store, V.SearchOptions(**o), F.col("parent"))[0]
    assert values(search().orderBy("rank"), "id") == [1, 2] and "paragraph_ids" not in search().columns
    assert values(search(group_by_parent=True).orderBy("rank"), "id") == [1]
    assert sorted(values(search(hydrate_parents=True), "text")) == ["one", "two", "whole"]
    assert values(search(emit_paragraph_ids=True, max_docs=1), "paragraph_ids") == [["p1"]]


def test_two_rankings_side_by_side(spark):
    queries = spark.createDataFrame([(i,) for i in range(5)], "q int")
    one = spark.createDataFrame([(0, 1), (1, 9), (2, 3), (2, 1)], "q int, rank int")
    two = spark.createDataFrame([(0, 2), (1, 4), (3, 1)], "q int, rank int")
    row = E.compared_ranks(queries, {"a": one, "b": two}, "q").first().asDict()
    assert row == {"queries": 5, "a_top1": 2, "a_near": 2, "a_never": 2, "b_top1": 1, "b_near": 3, "b_never": 2, "lost": 2, "gained": 1}
