"""Micro-cases of functions, with values worked out from the formulas."""

import uuid

import pytest
from pyspark.sql import functions as F

from decisionloom.functions import html, ids, text, vocab
from decisionloom.operators import chunking, lexical, records, vector


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first()["x"]


def test_turkish_case(spark):
    assert one(spark, text.tr_lower(F.lit("IŞIK İZ"))) == "ışık iz"
    assert one(spark, text.tr_upper(F.lit("ışık iz"))) == "IŞIK İZ"


def test_white_space_and_lines(spark):
    assert one(spark, text.norm_ws(F.lit(" a \tb\x1cc\n"))) == "a b c"
    assert one(spark, text.lines(F.lit("a\r\n\n b c\x0bd"))) == ["a", "b", "c", "d"]
    assert one(spark, text.blank(F.lit(" \n"))) is None


def test_uuid5_equals_the_standard(spark):
    for name in ("kvkk:1", "é-ß:2", ""):
        assert one(spark, ids.uuid5(vocab.NAMESPACE_DNS, F.lit(name))) == str(uuid.uuid5(uuid.NAMESPACE_DNS, name))


@pytest.mark.parametrize(("pool", "accepted", "k", "expected"), [(10, 1, 1, 0.1), (10, 1, 3, 0.3), (3, 1, 3, 1.0), (10, 0, 3, 0.0), (35, 2, 3, 0.166387)])
def test_hit_probability(spark, pool, accepted, k, expected):
    assert one(spark, F.round(ids.hit_probability(F.lit(pool), F.lit(accepted), F.lit(k)), 6)) == expected


def test_freshness(spark):
    got = [one(spark, F.round(ids.freshness(F.lit(y).cast("int")), 9)) for y in (2025, 2023, 2022, 2020, 2013, None)]
    assert got == [1.5, 1.0, 0.464158883, 0.1, 0.000464159, 1.0]


def test_folds(spark):
    lengths = lambda *x: F.array(*[F.lit(v) for v in x])
    assert one(spark, chunking.pack_groups(lengths(900, 900, 300, 2500, 10), 2000)) == [1, 1, 2, 3, 4]
    assert one(spark, chunking.window_groups(lengths(10, 10, 10, 50, 5, 5), 2, 40)) == [1, 1, 2, 3, 4, 4]
    assert one(spark, chunking.merge_groups(lengths(500, 600, 2000, 100, 100), 1000)) == [1, 1, 2, 3, 3]
    assert one(spark, chunking.batch_groups(lengths(100, 10, 10, 50, 90), 20_000, 3)) == [1, 1, 1, 2, 2]


def test_bm25_by_hand(spark):
    units = spark.createDataFrame([(1, "a b a"), (2, "b c"), (3, "c c d e")], "u int, text string")
    asked = spark.createDataFrame([(1, "a b"), (2, "c")], "q int, text string")
    got = {(r["q"], r["u"]): r["score"] for r in lexical.bm25(units, asked, "u", "q", options={"least": 1}).collect()}
    assert got == {(1, 1): 1.871188, (1, 2): 0.552945, (2, 2): 0.552945, (2, 3): 0.606456}


def test_fusion(spark):
    lists = lambda rows: spark.createDataFrame(rows, "q int, id string, rank int")
    got = lexical.fuse(lists([(1, "a", 1), (1, "b", 2)]), lists([(1, "b", 1)]), "q", "id").orderBy("rank").collect()
    assert [(r["id"], r["source"]) for r in got] == [("b", "both"), ("a", "lexical")]
    assert got[0]["rrf"] == pytest.approx(1 / 62 + 1 / 61)
    tie = lexical.fuse(lists([(1, "x", 1)]), lists([(1, "y", 1)]), "q", "id").orderBy("rank").collect()
    assert [r["id"] for r in tie] == ["x", "y"]


def test_bucket_limits():
    assert vector.bucket_limits(1) == (10, 5)
    assert vector.bucket_limits(3) == (30, 5)


def test_upsert_deletes_stale_keys(spark):
    store = spark.createDataFrame([(1, "a"), (2, "a")], "k int, s string")
    new = spark.createDataFrame([(2, "a"), (3, "a")], "k int, s string")
    assert sorted(r["k"] for r in vector.upsert(store, new, "k", ["s"]).collect()) == [2, 3]


def test_merges(spark):
    rows = lambda *k: spark.createDataFrame([(x,) for x in k], "k int")
    assert sorted(r["k"] for r in records.merge_new(rows(1, 2), rows(2, 3, 3), "k").collect()) == [1, 2, 3]


def test_gaps_and_ranges(spark):
    covered = spark.createDataFrame([(1, 10, p) for p in (1, 2, 5, 6, 7, 10)], "d int, n int, para int")
    gaps = chunking.gaps(covered, ["d"])
    assert sorted((r["lo"], r["hi"]) for r in gaps.collect()) == [(3, 4), (8, 9)]
    assert chunking.range_text(gaps, ["d"]).first()["ranges"] == "3-4, 8-9"


def test_first_owner(spark):
    rows = spark.createDataFrame([(1, 1, 1), (1, 1, 2), (1, 2, 2), (1, 2, 3), (1, 3, 1)], "d int, seg int, para int")
    owned = chunking.first_owner(rows, ["d"])
    assert sorted((r["seg"], r["para"]) for r in owned.filter("seg = owner").collect()) == [(1, 1), (1, 2), (2, 3)]
    assert [(r["seg"], r["alias"]) for r in chunking.aliases(owned, ["d"]).collect()] == [(3, 1)]


def test_html():
    assert html.paragraphs_of("<p>a &amp; b<br>c</p><table><tr><td>1</td><td>2</td></tr></table><!-- x -->d") == ["a & b", "c", "1 2", "d"]
    assert html.paragraphs_of("<p>a<script>var x</script></p>", skip=("script",)) == ["a"]
    assert html.paragraphs_of(None) == []
    assert html.paragraphs_of("<div>" * 5000 + "deep" + "</div>" * 5000) == ["deep"]


def test_html_strategies():
    """What each older extractor makes of nested lists, lines by breaks, and one p that holds all."""
    nested = "<div>intro <em>said</em><ul><li>one</li><li>two <b>bold</b><ul><li>deep</li></ul>tail</li></ul></div>"
    assert html.by_blocks(nested) == ["intro said", "one", "two bold", "deep", "tail"]
    assert html.only_p("<p>a</p>x<div><p>b <i>c</i></p></div>") == ["a", "b c"]
    assert html.by_breaks("<p>a<br>b <b>c</b>d</p>e") == ["a", "b cd", "e"]
    assert html.plain_of("x <b>y</b>") == "x y" and html.plain_of(" a  b ") == "a b" and html.plain_of(None) == ""
    assert html.rescued("a b", "<p>x</p><p>y</p>", "html_p") == (["x", "y"], "html_p")
    assert html.rescued("l1\nl2\nl3", "<p>x</p>", "html_p") == (["l1", "l2", "l3"], "html_br")
    assert html.rescued(None, "x<br>y", "html_p") == (["x", "y"], "html_br")
    assert html.rescued(None, None, "lines") == ([], "lines")


def test_extraction_keeps_the_reading_that_loses_less(spark):
    five = "a\nb\nc\nd\ne"
    assert html.chosen(five, "<p>a b c d e</p>")[::2] == (["a", "b", "c", "d", "e"], "lines")
    kept, lost, taken = html.chosen("one\ntwo", "<p>one</p><p>two three</p>")
    assert (kept, dict(lost), taken) == (["one", "two three"], {}, "walk")
    kept, lost, taken = html.chosen(five, "<p>a b c d e</p><p>only here</p>")
    assert (kept, dict(lost), taken) == (["a b c d e", "only here"], {}, "walk")
    kept, lost, _ = html.chosen("ee3\nx\n0\ny\n…\nz", None)
    assert kept == ["x", "y", "z"] and not lost
    assert html.coverage("short", "<p>a much longer text than that</p>", ["short"]) < html.LEAST_COVERAGE
    rows = spark.createDataFrame([(five, None), (None, None), ("", "<p>p</p><p>q</p>")], "c string, h string").select(html.extractor()("c", "h").alias("x")).select("x.*").collect()
    assert [(len(r["paragraphs"]), r["taken"], r["refused"]) for r in rows] == [(5, "lines", False), (0, "lines", True), (2, "walk", False)]
    assert rows[2]["found"] == {"lines": 0, "html_p": 2, "html_br": 2, "html_blocks": 2}


def test_size_split():
    body = "Bir cümle. " * 30 + "x" * 900
    pieces = html.pieces_of(body, 200)
    assert max(map(len, pieces)) <= 200
    assert "".join(pieces).replace(" ", "") == body.replace(" ", "")


def test_labels_and_canonical(spark):
    assert [one(spark, ids.doc_of_label(F.lit(x))) for x in ("123-p18_p1", "123-p6_to_p8", "123")] == ["123"] * 3
    none = F.lit(None).cast("string")
    call = lambda kind, no, short, name, art: one(spark, ids.canonical_id(F.lit(kind), *[F.lit(x) if x is not None else none for x in (no, short, name, art)]))
    assert call("statute", "6100", None, None, "353") == "6100/353"
    assert call("constitution", None, None, None, "35") == "constitution/35"
    assert call("statute", None, "HMK", None, "353") == "hmk/353"
    assert call("statute", None, None, None, None) is None


def test_contract_finds_planted_faults(spark):
    docs = spark.createDataFrame([(1, "s", "t", "1. Daire", 2020, None), (2, "s", " ", "77. Daire", None, None)], "doc_id long, source string, text string, title string, esas_year int, karar_year int")
    got = {r["filename"]: r["p"] for r in records.index_records(docs).withColumn("p", records.contract_problems()).collect()}
    assert got == {"__1.txt": [], "__2.txt": ["empty_text", "no_year"]}
    assert len(records.index_records(docs).columns) == 28


def test_text_scalars_see_the_end(spark, tmp_path):
    from decisionloom.plans import catalogue

    head = "word " * 300
    spark.createDataFrame([(1, "s", head + "Ğ the"), (2, "s", head + "x")], "doc_id long, source string, text string").write.parquet(f"{tmp_path}/documents.parquet")
    one, two = sorted(catalogue.QUERIES["text_scalars"](spark, str(tmp_path)).collect(), key=lambda r: r["doc_id"])
    assert all(one[c] != two[c] for c in ("upper", "lower", "ws", "plain", "slug", "part", "english"))


def test_pages_are_read_a_few_at_a_time(spark):
    """Whatever the size of the batches, as many rows as came in, each with its own reading."""
    pages = spark.range(0, 300, 1, 1).select("id", F.concat(F.lit("<p>page "), "id", F.lit("</p><p>two</p>")).alias("html"))
    rows = html.extracted(pages, "id", F.lit(None).cast("string"), F.col("html")).collect()
    assert [(r["id"], r["x"]["paragraphs"]) for r in rows] == [(i, [f"page {i}", "two"]) for i in range(300)]
