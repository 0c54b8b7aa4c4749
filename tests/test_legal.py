"""Legal functions, citations and checks on invented rows."""

import pytest
from pyspark.sql import functions as F

from decisionloom.functions import ids, legal, legislation
from decisionloom.operators import citations as C
from decisionloom.operators import records as R
from decisionloom.operators import verification as V
from tests.conftest import DATA


def one(spark, column, **values):
    """The value of a column over one row of strings."""
    row = spark.createDataFrame([tuple(values.values())], ", ".join(f"{k} {'array<string>' if isinstance(v, list) else 'string'}" for k, v in values.items())) if values else spark.range(1)
    return row.select(column.alias("x")).first()["x"]


@pytest.mark.parametrize(
    ("text", "expected"),
    [
        ("6698 sayılı Kişisel Verilerin Korunması Kanunu'nun 12. maddesi", ["k6698", "m12"]),
        ("üçüncü madde, MADDE 4 ve 2019/12951 esas", ["e2019/12951", "m3", "m4"]),
        ("2020/935 sayılı Karar, 12345 sayılı Resmî Gazete", ["e2020/935"]),
        ("", []),
        (None, []),
    ],
)
def test_stated_numbers(spark, text, expected):
    assert one(spark, legal.stated_numbers(F.col("t")), t=text) == expected


@pytest.mark.parametrize(("text", "expected"), [("Davanın reddine karar verilmiştir", "tr"), ("the court of the state", "en"), ("xyz qrs", None), ("", None), ("the karar of the court and ğ", "en")])
def test_language(spark, text, expected):
    assert one(spark, legal.language_of(F.col("t")), t=text) == expected


@pytest.mark.parametrize(("title", "source", "expected"), [("İzmir 11. Hukuk Dairesi", "bam", "11. Hukuk Dairesi"), ("Birinin Başvurusu", "aym", "Anayasa Mahkemesi"), ("Kurul Başkanlığı 2021/895 E. ,2022/1662 K.", "danistay", "Kurul Başkanlığı"), (None, "bam", None)])
def test_court(spark, title, source, expected):
    assert one(spark, legal.court(F.col("t"), F.col("s")), t=title, s=source) == expected


def test_chamber_is_the_first_number_of_a_court(spark):
    titles = {"7. Asliye Ticaret Mahkemesi": 7, "11. Hukuk Dairesi": 11, "77. Daire": None, "Genel Kurul": None}
    assert {t: one(spark, ids.chamber(F.col("t")), t=t) for t in titles} == titles


def test_outcomes(spark):
    known = {"red": "denied", "Granted": None, "granted": "granted", "geri_cevirme": "remanded", "?": None}
    assert {k: one(spark, legal.legacy_outcome(F.col("t")), t=k) for k in known} == known
    says = lambda outcome, ruling: one(spark, legal.outcome_contradicted(F.col("o"), F.col("r")), o=outcome, r=ruling)
    assert says("affirmed", "davanın reddine") and not says("denied", "davanın reddine") and not says("denied", "")
    assert not says("violation", "ihlal edildiğine ve ihlal edilmediğine")


def test_wellformed_case_numbers(spark):
    good = lambda no, source: one(spark, legal.wellformed_case_no(F.col("n"), F.col("s")), n=no, s=source)
    assert good("2019/2035", "bam") and good("06-90/1142-338", "rekabet")
    assert not good("06-90/1142-338", "bam") and not good("...", "bam") and not good(None, "kvkk")


def test_loose_grounding(spark):
    def grounded(body, article=None, no=None, name=None, kind="statute"):
        return one(spark, legal.loosely_grounded(F.col("b"), F.col("a"), F.col("n"), F.lit(None).cast("string"), F.col("m"), F.col("k")), b=body, a=article, n=no, m=name, k=kind)

    assert grounded("Anayasa'nın 2., 6., 10. maddeleri", "6", kind="constitution")
    assert not grounded("1985 yılında Anayasa", "8", kind="constitution")
    assert grounded("Borçlar hukukunda 49. madde", "49", name="Türk Borçlar Kanunu")
    assert not grounded("49. madde", "49", no="6098") and not grounded("", "49", no="6098")


def citations(spark, *texts):
    """For each text its citations in their order."""
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = sorted(legislation.cited(df, ["doc_id"], F.col("text")).collect(), key=lambda r: (r["doc_id"], r["kind"], r["place"]))
    return [[r for r in rows if r["doc_id"] == i] for i in range(len(texts))]


def test_cited_laws(spark):
    found, *none = citations(spark, "3/7/2005 tarihli ve 5393 sayılı Belediye Kanunu'nun 15. maddesinin (2) numaralı fıkrası. " + "x " * 80 + "5393 sayılı Kanun'un Ek 5. maddesi. Anayasa'nın 36. maddesi", None, "hiçbir atıf yok", "")
    assert [c["canonical_id"] for c in found] == ["constitution-art-36", "law-5393-art-15-p2", "law-5393-art-ek-5"]
    assert found[1]["law_date"] == "2005-07-03" and found[1]["law_name"] == "Belediye" and found[1]["verbatim_mention"].endswith("15. madde")
    assert none == [[], [], []]
    names = spark.createDataFrame([('ve  Türk "  ',), ("ab",), (None,), ("'Belediye'",)], "n string").select(legislation.law_name(F.col("n"))).collect()
    assert [r[0] for r in names] == ["Türk", None, None, "Belediye"]


@pytest.mark.parametrize(
    ("text", "expected"),
    [
        ("6098 sayılı Türk Borçlar Kanunu'nun Geçici Madde 3 hükmü", "law-6098-art-geçici-3"),
        ("5271 sayılı Kanun'un 141/A maddesi", "law-5271-art-141-a"),
        ("5271 sayılı Kanun'un 141/a.maddesi", "law-5271-art-141-a"),
        ("5271 sayılı Kanun'un 23'üncü maddesinin ikinci fıkrası", "law-5271-art-23-p2"),
        ("5271 sayılı KANUN'UN 23 . MADDESİ", "law-5271-art-23"),
        ("5271 sayılı Kanunun 23.maddesinin 3. fıkrası", "law-5271-art-23-p3"),
        ("5271 sayılı Kanun'un 12. maddesi ve Ek Madde 7", "law-5271-art-ek-7"),  # the more particular form first
        ("375 sayılı Kanun Hükmünde Kararname'nin 7. maddesi", "law-375-art-7"),
        ("375 sayılı KHK'nın Ek 9. maddesi", "law-375-art-ek-9"),
        ("4721 sayılı Dernekler Kanunu uyarınca", "law-4721-unknown-article"),
        ("4721 sayılı karar, sonra Kanun", None),  # another clause
        ("47 sayılı Kanun'un 3. maddesi", None),  # no number of a law
        ("4721 sayılı " + "çok " * 40 + "Kanun", None),  # too far
        ("4721 sayılı Kanun " + "x " * 90 + "3. maddesi", "law-4721-unknown-article"),
        ("Anayasanın 36. maddesinin (1) numaralı fıkrası", "constitution-art-36-p1"),
        ("Anayasa`nın 36 maddesi uyarınca. Ayrıca (1) numaralı fıkra", "constitution-art-36"),
        ("Anayasa'nın 2., 6., 10. maddeleri", None),
    ],
)
def test_forms_of_citations(spark, text, expected):
    (found,) = citations(spark, text)
    assert [c["canonical_id"] for c in found] == ([] if expected is None else [expected])
    assert all(c["verbatim_mention"] in text for c in found)


def test_repeated_citations_and_long_texts(spark):
    text = "5393 sayılı Belediye Kanunu'nun 15. maddesi. " * 30
    once, many = citations(spark, text, "".join(f"{5000 + i} sayılı Kanun'un {i + 1}. maddesi; " for i in range(400)))
    assert [c["canonical_id"] for c in once] == ["law-5393-art-15"]
    assert [c["canonical_id"] for c in many] == [f"law-{5000 + i}-art-{i + 1}" for i in range(400)]


CITED = "doc_id long, para int, legislation_type string, law_no string, law_short string, law_name string, article_no string, paragraph_no string, law_date string, verbatim_mention string"


def test_clean_citations(spark):
    paragraphs = spark.createDataFrame([(1, 1, "T.B.K. ve 6098 sayılı Türk Borçlar Kanunu’nun  49. maddesi"), (1, 2, "Anayasa'nın 36. maddesi")], "doc_id long, para int, text string")
    rows = [
        (1, 1, "statute", "6098", "T.B.K.", "Türk Borçlar Kanunu", "49", None, None, "Türk Borçlar Kanunu'nun 49. maddesi"),
        (1, 2, "constitution", "36", None, "Anayasa", None, None, None, "Anayasa'nın 36. maddesi"),
        (1, 2, "statute", "6098", None, None, "49", None, None, None),
        (1, 1, "treaty", None, None, None, None, None, None, None),
    ]
    got = {(r["para"], r["legislation_type"]): r for r in C.clean(spark.createDataFrame(rows, CITED), paragraphs).collect()}
    first = got[1, "statute"]
    assert first["kept"] and first["rules"] == [] and (first["canonical_id"], first["law_short"], first["law_name"]) == ("6098/49", "TBK", "Türk Borçlar Kanunu")
    second = got[2, "constitution"]
    assert second["kept"] and second["rules"] == ["constitution_law_no_cleared", "law_name_cleared"] and second["canonical_id"] == "constitution/36"
    assert not got[2, "statute"]["kept"] and got[2, "statute"]["rules"] == ["citation_not_in_its_paragraph"]
    assert got[1, "treaty"]["rules"] == ["dropped_treaty"]


def test_first_of_repeated_citations(spark):
    rows = [(1, 1, "statute", "1", None, None, "2", None, None, "a  b"), (1, 1, "statute", "1", None, None, "2", None, None, "a b"), (1, 2, "statute", "1", None, None, "2", None, None, "a b")]
    df = spark.createDataFrame([(*r, i) for i, r in enumerate(rows)], CITED + ", pos int")
    assert sorted(r["pos"] for r in C.first_of_each(df).collect()) == [0, 2]


def test_pieces_by_quote_start_article_and_paragraph(spark):
    paragraphs = spark.createDataFrame([(1, 1, "aaaa bbbb cccc dddd"), (1, 2, "eeee 12. madde ffff gggg")], "doc_id long, para int, text string")
    pieces = spark.createDataFrame([(1, 1, "aaaa bbbb cccc"), (1, 2, "dddd eeee 12. madde"), (1, 3, "ffff gggg")], "doc_id long, piece int, text string")
    forms = [(1, "bbbb cccc", None, 1), (1, "cccc dddd", None, 1), (2, None, "12", 2), (2, None, None, 2), (2, "ffff gggg", None, 3), (1, None, None, 1)]
    rows = [(1, para, i, str(i), None, None, article, None, quote) for i, (para, quote, article, _) in enumerate(forms)]
    df = spark.createDataFrame(rows, "doc_id long, para int, pos int, canonical_id string, law_short string, law_name string, article_no string, paragraph_no string, verbatim_mention string")
    got = {r["pos"]: r["piece"] for r in C.to_pieces(df, pieces, paragraphs, ["doc_id"]).collect()}
    assert got == {i: piece for i, (*_, piece) in enumerate(forms)}


def test_usable_picked_and_examples(spark):
    raw = spark.createDataFrame([(1, "fetched", "x", None, "bam", "1/1"), (2, "failed", "x", None, "bam", "1/2"), (3, "completed", None, " ", "bam", "1/3"), (4, "completed", None, "<p>y</p>", "aym", "1/4"), (5, "fetched", "z", None, "bam", "1/5")], "doc_id long, status string, content_text string, html_content string, source string, case_no string")
    first, counts = R.usable_first(raw, spark.createDataFrame([(1,)], "doc_id long"), 1)
    assert [r["doc_id"] for r in first.collect()] == [4] and tuple(counts.first()) == (1, 2, 2)
    wanted = spark.createDataFrame([(0, 5), (1, 2)], "pos int, doc_id long")
    assert [r["doc_id"] for r in R.picked(raw, wanted).collect()] == [5, 2]
    examples = spark.createDataFrame([("bam", "1/5", None), ("aym", None, 4)], "source string, case_no string, doc_id long")
    assert sorted(r["doc_id"] for r in R.without_examples(raw, examples).collect()) == [1, 2, 3]
    assert tuple(R.text_columns(raw).first()) == (5, 3, 1)
    assert [r["doc_id"] for r in R.failed_reviews(spark.createDataFrame([(1, "validation_flags"), (2, ""), (3, None), (4, "api")], "doc_id long, reason string")).collect()] == [4]
    assert tuple(R.produced(raw.filter("doc_id < 3"), raw.filter("doc_id > 1")).first()) == (4, 2, 1)


def test_second_read(spark):
    chunks = spark.createDataFrame([(1, "1-p1", "facts"), (1, "1-p2", "other")], "doc_id long, chunk_label string, role string")
    capsules = spark.createDataFrame([(1, 0, "denied")], "doc_id long, capsule_index int, outcome string")
    fixes = spark.createDataFrame([(1, "role", "1-p2", "facts"), (1, "outcome", "0", "granted"), (1, "missing", "2", None), (2, "missing", "0", None)], "doc_id long, kind string, key string, value string")
    c, k, counts = R.second_read(chunks, capsules, fixes)
    assert sorted(r["role"] for r in c.collect()) == ["facts", "facts"] and [r["outcome"] for r in k.collect()] == ["granted"]
    assert sorted(map(tuple, counts.collect())) == [(1, 2, 1), (2, 0, 1)]


def test_rights_against_capsules(spark):
    verdicts = spark.createDataFrame([(1, "mülkiyet_hakkı", "violation"), (1, "adil_yargılanma", "violation"), (2, "x", "abated")], "doc_id long, right string, verdict string")
    capsules = spark.createDataFrame([(1, "mülkiyet_hakkı", "violation"), (1, "adil_yargılanma", "no_violation")], "doc_id long, subject_id string, outcome string")
    got = sorted(tuple(r) for r in R.rights_against_capsules(verdicts, capsules).collect())
    assert got == [(1, "adil_yargılanma", "violation", ["no_violation"]), (2, "x", "abated", [])]


def test_word_loss_counts_each_word(spark):
    raw = spark.createDataFrame([(1, "ç a a b"), (2, "x")], "doc_id long, text string")
    kept = spark.createDataFrame([(1, "a"), (2, "x"), (2, "y")], "doc_id long, text string")
    assert sorted(map(tuple, V.word_loss(raw, kept).collect())) == [(1, "a", 1), (1, "b", 1), (1, "ç", 1)]


def test_clean_output_has_no_fault_of_its_own(spark):
    from decisionloom.plans import stored

    found = {r["kind"] for r in stored.document_verification(spark, DATA).filter("run = 'clean'").collect()}
    assert found <= {"fragment_chunk", "reasoning_summary_not_in_decision_language", "conclusion_sentence_not_in_decision_language"}
    broken = {r["kind"] for r in stored.document_verification(spark, DATA).filter("run = 'broken'").collect()}
    assert len(broken) >= 21


def test_procedural_texts(spark):
    from decisionloom.operators import preflight as P

    reason = lambda t: one(spark, P.procedural_reason(F.col("t")), t=t)
    assert reason("Dosyanın bir süre bekletilmesine") == "procedural" and reason("dilekçenin reddine, görevsizlik kararı") == "jurisdictional"
    assert reason("davanın reddine") is None and reason(None) is None
    assert one(spark, P.phrase_density(F.col("t")), t="xx duruşma ertelendi") == 17 / 20
    assert one(spark, P.phrase_density(F.col("t")), t=None) == 0.0


def test_injected_records_come_through(spark):
    from decisionloom.operators import preflight as P

    rows = [("rekabet", 1, '{"data":{"decision_number_raw":"06-90/1142-338","decision_date":"2021-01-02"}}', "t"), ("rekabet", 2, None, "t"), ("bam", 3, None, "t")]
    df = spark.createDataFrame(rows, "source string, doc_id long, metadata string, title string")
    for c in ("esas_year", "esas_no", "karar_year", "karar_no", "chamber_id"):
        df = df.withColumn(c, F.lit(None).cast("int"))
    got = {r["source"]: r for r in P.with_injected(df.withColumn("content_text", F.lit("")).withColumn("html_content", F.lit("")).withColumn("status", F.lit("x")), "A\nB", "<p>A</p>").collect()}
    assert got["rekabet"]["ready"] and got["rekabet"]["doc_id"] == 1 and got["rekabet"]["paragraphs"] == 2
    assert not got["bam"]["ready"]


def test_fusion_labels(spark):
    from decisionloom.operators import lexical as L

    lex = spark.createDataFrame([(1, "a", 1), (1, "b", 2), (1, "", 3)], "q int, item string, rank long")
    vec = spark.createDataFrame([(1, "b", 1), (1, "c", 2), (1, "c", 3), (1, "d", 4)], "q int, item string, rank long")
    got = {r["item"]: r["source"] for r in L.fuse(lex, vec, "q", "item").collect()}
    assert got == {"a": "lexical", "b": "both", "c": "both", "d": "vector"}


def test_small_projections(spark):
    from decisionloom.operators import vector as V
    from decisionloom.sources import records

    hits = spark.createDataFrame([(1, "x", 2.0)], "id int, title string, score double")
    assert V.payload(hits, ["id", "title"], ["score", "missing", "id"]).columns == ["id", "title", "score"]
    chunks = spark.createDataFrame([("bam", "7-p2", 1), ("bam", "7-p1", 0), ("bam", "71-p1", 2), ("aym", "7-p1", 3)], "source string, chunk_label string, pos int")
    assert [r["chunk_label"] for r in records.of_document(chunks, "bam", "7").collect()] == ["7-p1", "7-p2"]
    raw = spark.createDataFrame([("bam", "2", "a\nb", None), ("bam", "1", "", "<p>x</p><p>y</p>"), ("aym", "3", None, None)], "source string, doc_id string, content_text string, html_content string")
    assert [r["doc_id"] for r in records.documents(raw, 1).collect()] == ["1"] and records.documents(raw).count() == 2
    assert tuple(R.unmatched(chunks.withColumn("doc_id", F.substring_index("chunk_label", "-p", 1)), spark.createDataFrame([("bam", "7")], "source string, doc_id string"), ["source", "doc_id"]).orderBy("source").first()) == ("aym", "7", 1)
    profile = spark.createDataFrame([("bam", "s", 3, True), ("bam", "t", 1, False)], "source string, shape string, documents int, covered boolean")
    assert tuple(R.uncovered_archetypes(profile).first()) == ("bam", 2, 1, 0.25)


def test_queries_in_blocks_meet_all_points(spark, monkeypatch):
    from decisionloom.operators import vector as V

    points = spark.createDataFrame([(i, [float(i), 1.0]) for i in range(9)], "id int, vector array<double>")
    queries = points.select(F.col("id").alias("query_id"), "vector")
    whole = sorted(map(tuple, V.similarities(points, queries).select("query_id", "id", "score").collect()))
    monkeypatch.setattr(V, "BLOCK", 2)
    assert sorted(map(tuple, V.similarities(points, queries).select("query_id", "id", "score").collect())) == whole and len(whole) == 81


def test_a_dotted_capital_is_one_letter_of_an_english_share(spark):
    assert one(spark, legal.english_share(F.col("t")), t="the REDDİNE") == 0.5
    said = "the and of was were " + " ".join(["xx"] * 56) + " REDDİNE"  # 5 of 62 words; cut in two there are 63, under 8 per cent
    assert one(spark, legal.language_of(F.col("t")), t=said) == "en"


def test_score_cards_count_a_decision_on_the_line_of_a_language(spark, tmp_path):
    import re

    import duckdb

    from decisionloom.plans import stored as S

    added = "ESAS NO: 2001/1 dosyada 1001 sayılı Örnek Kanunu'nun 2. maddesi uyarınca inceleme yapıldı. " + S.RULING
    more = 75 - len(re.findall("[a-z]+", added.replace("İ", "i").lower()))
    spark.createDataFrame([(1, "the " * 6 + "xx " * (more - 6))], "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")  # 6 of 75 words
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet/*.parquet'")
    got = sorted(map(tuple, S.score_compared(spark, str(tmp_path)).collect()))
    assert got == sorted(con.execute(S.COMPARED).fetchall()) and ("capsule_language", 2, 2, "") in got


def test_nearest_equals_all_similarities_ranked(spark, monkeypatch):
    from decisionloom.operators import vector as V

    rows = [(i, i % 3 if i % 7 else None, [float(i % 5), 1.0, float(i % 2)] if i % 11 else None) for i in range(60)] + [(5, 1, [9.0, 1.0, 1.0]), (60, 1, [1.0, None, 1.0]), (61, 2, [1.0]), (62, 0, [float("nan"), 1.0, 1.0])]
    points = spark.createDataFrame(rows, "id long, role int, vector array<double>")
    queries = points.filter("id % 10 = 5").select(F.col("id").alias("query_id"), "vector")
    got = lambda df: sorted((r["query_id"], r["id"], r["role"] is None, r["role"] or 0, repr(r["score"])) for r in df.select("query_id", "id", "role", "score").collect())
    for asked, size, at_once in ((V.ASKED, V.POINTS, V.SCORES), (2, 16, 32)):  # broadcast; dealt out in blocks
        monkeypatch.setattr(V, "ASKED", asked)
        monkeypatch.setattr(V, "POINTS", size)
        monkeypatch.setattr(V, "SCORES", at_once)
        for by in ([], ["role"]):
            for apart in (False, True):
                every = V.similarities(points, queries).filter("id <> query_id" if apart else "true")
                assert got(V.nearest(points, queries, 4, by, apart=apart)) == got(V.top_k(every, 4, more=by))


def test_only_wanted_texts_are_put_in_order(spark):
    from decisionloom.operators import vector as V

    units = spark.createDataFrame([(1, None, "chunk", "own"), (2, 9, "document", "whole"), (3, 9, "document", "a"), (4, None, "chunk", "other")], "id long, parent long, unit string, text string")
    wanted = spark.createDataFrame([(1,), (9,)], "id long")
    assert sorted(map(tuple, V.text_store(units, wanted).collect())) == [(1, "own"), (9, "a")]


def test_findings_read_each_text_once(spark):
    from decisionloom.plans import profiling

    plan = profiling.preflight_findings(spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("upper(") == 1


def test_a_text_is_cut_into_paragraphs_once(spark, tmp_path):
    from decisionloom.plans import chunking, stored

    rows = [(3, "one\n\ntwo  words"), (4, None), (8, "\n \n"), (12, "x"), (None, "y")]
    spark.createDataFrame(rows, "doc_id long, text string").coalesce(1).write.parquet(f"{tmp_path}/documents.parquet")
    for df in (chunking.paras(spark, str(tmp_path)), stored.decisions(spark, str(tmp_path))):
        assert df._jdf.queryExecution().optimizedPlan().toString().count("split(text") == 1  # no inferred filter, no join
    assert sorted(tuple(r) for r in chunking.paras(spark, str(tmp_path)).filter("doc_id > 0").collect()) == [(3, 1, "one"), (3, 2, "two words"), (12, 1, "x")]
    got = sorted((r["doc_id"], r["para"], r["n"], r["place"]) for r in stored.decisions(spark, str(tmp_path)).collect())
    assert got == [(3, 1, 2, "own"), (3, 2, 2, "own"), (3, 3, 2, "law"), (3, 4, 2, "ruling"), (12, 1, 1, "own"), (12, 2, 1, "law"), (12, 3, 1, "ruling"), (12, 4, 1, "dissent")]


def _optimised(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_a_text_is_folded_once_for_all_numbers_that_it_states(spark):
    plan = _optimised(spark.range(1).select(legal.stated_numbers(F.col("id").cast("string")).alias("n")))
    assert plan.count("upper(") == 1
    assert one(spark, legal.stated_numbers(F.col("t")), t="12/A maddesi, MADDE 5, üçüncü fıkra, 2019/12 sayılı") == ["e2019/12", "m12", "m5"]


def test_what_a_document_says_is_worked_out_once_for_all_runs(spark):
    from decisionloom.plans import stored as S

    rows, runs = S._runs(spark, DATA)
    plan = _optimised(V.score_cards(runs, rows, {name: S._losses(rows, c) for name, (c, _) in runs.items()}, S._reviews(rows)))
    assert plan.count(legal.LAW_STATED) == 3  # of a body, and of a capsule and its support


def test_counters_read_the_laws_a_body_states_without_making_it_twice(spark):
    from decisionloom.plans import stored as S

    rows, runs = S._runs(spark, DATA)
    plan = _optimised(V.measures_by_run(runs, rows, {name: S._losses(rows, c) for name, (c, _) in runs.items()}, S._merges(rows)))
    assert plan.count(legal.LAW_STATED) == 3


def test_corrective_requests_cut_texts_once(spark):
    from decisionloom.plans import answering

    assert "split(text" not in _optimised(answering.corrective_requests(spark, DATA))


def test_held_paragraphs_are_told_by_chunks_of_different_references(spark):
    chunk = "doc_id long, chunk_id string, chunk_label string, chunk_index int, refs array<int>, text string, char_length int, role string, source_type string, cited_legislations array<struct<legislation_type:string,law_no:string,article_no:string>>"
    c = spark.createDataFrame([(1, f"c{i}", f"l{i}", i, refs, "x" * 50, 50, "facts", "bam", []) for i, refs in enumerate([[1, 2], [1, 2], [2, 3], [9]])], chunk)
    k = spark.createDataFrame([], "doc_id long, capsule_index int, opinion_type string, outcome string, subject_id string, conclusion_sentence string, reasoning_summary string, supporting_chunk_ids array<string>")
    p = spark.createDataFrame([(1, i, "y" * n) for i, n in ((1, 50), (2, 50), (3, 50), (4, 150), (5, 10), (6, 45))] + [(2, 1, "z" * 60)], "doc_id long, para int, text string")
    got = {(r["doc_id"], r["kind"]): (r["severity"], r["detail"]) for r in V.document_issues(c, k, p).collect()}
    assert got[1, "paragraph_overlap"] == ("hard", "p2") and got[1, "uncovered_content"] == ("hard", "2 paragraphs 195 chars") and got[1, "uncovered_minor"] == ("soft", "p5")
    assert got[2, "uncovered_content"] == ("soft", "1 paragraphs 60 chars")


def test_pieces_meet_their_citations_by_document(spark):
    from decisionloom.plans import assembly

    plan = _optimised(assembly._assembled(spark, DATA)[1])
    assert not [line for line in plan.splitlines() if "Join LeftOuter" in line and "piece" in line]  # their texts would be dealt out once more
