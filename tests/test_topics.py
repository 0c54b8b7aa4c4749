"""Patterns, containment, choices, histograms, arms, rounding and token lengths against brute force."""

import hashlib
import math
import random
import statistics

import pytest
from pyspark.sql import functions as F

from decisionloom.operators import lexical as L
from decisionloom.functions.numbers import round_exact
from decisionloom.functions.token_lengths import with_token_lengths
from decisionloom.operators import evaluation as E
from decisionloom.operators import histograms as H
from decisionloom.operators import patterns, sets
from decisionloom.operators import records as R


@pytest.mark.parametrize("digits", [0, 1, 2, 4, 12])
def test_rounding_equals_exact_rounding_of_doubles(spark, digits):
    r = random.Random(digits)
    edges = [0.5, 1.5, 2.5, -2.5, 2.675, 1.005, 0.125, 0.375, -0.125, 5e-324, 1e-300, 4503599627370496.5, 2.0**53, 1e300, math.inf, -math.inf, 0.0, 4.35, 9007199254740991.0]
    xs = edges + [r.uniform(-1e6, 1e6) for _ in range(25_000)] + [r.randrange(-(10**7), 10**7) / 8 for _ in range(25_000)] + [round(r.uniform(0, 1e5), 3) for _ in range(25_000)] + [10 ** r.uniform(-20, 15) * r.choice([1, -1]) for _ in range(25_000)]
    df = spark.createDataFrame(list(enumerate(xs)), "i int, x double")
    got = dict(df.select("i", round_exact(F.col("x"), digits)).collect())
    assert [(x, got[i]) for i, x in enumerate(xs) if got[i] != (round(x, digits) if math.isfinite(x) else x)] == []
    none, nan = (r[0] for r in spark.createDataFrame([(None,), (math.nan,)], "x double").select(round_exact(F.col("x"), digits)).collect())
    assert none is None and math.isnan(nan)


@pytest.mark.parametrize("most", [patterns.PATTERNS, 7])
def test_patterns_equal_comparing_all(spark, monkeypatch, most):
    monkeypatch.setattr(patterns, "PATTERNS", most)
    r = random.Random(4)
    texts = [(i, "".join(r.choice("ab ç") for _ in range(r.randrange(60)))) for i in range(80)] + [(80, None), (81, ""), (81, "ab ab")]
    said = [(i, "".join(r.choice("ab ç") for _ in range(r.randrange(1, 6)))) for i in range(40)] + [(40, None), (41, ""), (42, "nowhere"), (43, "ab"), (44, "ab")]
    units, asked = spark.createDataFrame(texts, "unit long, body string"), spark.createDataFrame(said, "item int, said string")
    got = sorted(tuple(x) for x in patterns.holding(units, asked, "unit", "body", "said").select("item", "unit").collect())
    assert got == sorted((i, u) for u, t in texts if t is not None for i, s in said if s is not None and s in t)
    assert patterns.holding(units, asked.filter("false"), "unit", "body", "said").count() == 0
    assert patterns.holding(units.filter("false"), asked, "unit", "body", "said").count() == 0


def test_containment_equals_comparing_all(spark):
    r = random.Random(5)
    some = lambda n: r.sample("abcdefghij", r.randrange(n))
    want = [(i % 3, i, some(5)) for i in range(60)] + [(0, 60, None), (1, 61, ["z"]), (1, 62, ["a", "a", None])]
    hold = [(i % 4, i, some(11)) for i in range(80)] + [(1, 80, None)]
    w, h = spark.createDataFrame(want, "g int, w int, items array<string>"), spark.createDataFrame(hold, "g int, h int, items array<string>")
    inside = lambda a, b: bool(set(a or []) - {None}) and set(a) - {None} <= set(b or [])
    assert sorted(tuple(x) for x in sets.covering(w, h, ["w"], ["h"], ["g"]).select("w", "h").collect()) == sorted((b, y) for a, b, c in want for x, y, z in hold if a == x and inside(c, z))
    assert sorted(tuple(x) for x in sets.covering(w.drop("g"), h.drop("g"), ["w"], ["h"]).select("w", "h").collect()) == sorted((b, y) for _, b, c in want for _, y, z in hold if inside(c, z))


def test_verdicts_that_no_covering_capsule_shares(spark):
    verdicts = spark.createDataFrame([(1, ["2", "6"], "violation"), (1, ["6"], "violation"), (1, ["9"], "none"), (2, ["6"], "none"), (2, ["6"], "none")], "doc_id long, items array<string>, verdict string")
    capsules = spark.createDataFrame([(1, 0, ["2", "6", "8"], "none"), (1, 1, ["6"], "violation"), (2, 0, ["6", "7"], "violation")], "doc_id long, capsule int, items array<string>, outcome string")
    got = sorted(tuple(x) for x in sets.unshared_verdicts(verdicts, capsules).collect())
    assert got == [(1, ["2", "6"], "violation", 1, ["none"]), (1, ["9"], "none", 0, []), (2, ["6"], "none", 1, ["violation"])]


@pytest.mark.parametrize("n", [0, 1, 5, 17, 40, 1000])
def test_spread_deals_round_robin(spark, n):
    r = random.Random(6)
    rows = [(i, r.choice("aaaaaaab") if i % 9 else None, r.randrange(3)) for i in range(120)]
    df = spark.createDataFrame(rows, "k int, a string, b int")
    md5 = lambda *x: hashlib.md5(":".join(["3", *["" if v is None else str(v) for v in x]]).encode()).hexdigest()
    turns, seen = [], {}
    for k, a, b in sorted(rows, key=lambda x: (md5(x[0]), x[0])):
        seen[a, b] = seen.get((a, b), 0) + 1
        turns.append((seen[a, b], md5(a, b), k))
    assert sorted(x["k"] for x in sets.spread(df, ["a", "b"], "k", n, 3).collect()) == sorted(k for *_, k in sorted(turns)[:n])


def test_the_largest_of_each_kind_are_picked_first(spark):
    df = spark.createDataFrame([(i, "xyz"[i % 3], 2000 + i % 4, (i * 37) % 101) for i in range(90)], "id int, kind string, year int, size int")
    largest = {max((r for r in df.collect() if r["kind"] == k), key=lambda r: (r["size"], -r["id"]))["id"] for k in "xyz"}
    picked = [r["id"] for r in R.stratified(df, "kind", "year", "size", "id", 20, 3).collect()]
    assert len(set(picked)) == 20 and largest <= set(picked)
    assert {r["id"] for r in R.stratified(df, "kind", "year", "size", "id", 2, 3).collect()} < largest


def test_medians_from_histograms_that_merge(spark):
    r = random.Random(7)
    rows = [("abc"[min(2, i % 5)], r.randrange(40)) for i in range(501)] + [("d", 3), ("d", 8), ("e", None)]
    df = spark.createDataFrame(rows, "k string, v int")
    parts = [H.counted(df.filter(F.pmod(F.xxhash64("v"), F.lit(3)) == i), ["k"], "v") for i in range(3)]
    of = {k: [v for x, v in rows if x == k and v is not None] for k in "abcd"}
    assert {x["k"]: x["median"] for x in H.medians(H.merged(*parts), ["k"], "v").collect()} == {k: statistics.median(v) for k, v in of.items()}
    seen = {x["k"]: x for x in H.under_ceiling(H.merged(*parts), ["k"], "v", 10).collect()}
    assert all((seen[k]["over"], seen[k]["visible"], seen[k]["total"], seen[k]["longest"]) == (sum(x > 10 for x in v), sum(min(x, 10) for x in v), sum(v), max(v)) for k, v in of.items())


def test_a_paragraph_counts_in_the_first_hit_of_its_document_only(spark):
    queries = spark.createDataFrame([(1, 10, 3), (2, 10, 4), (3, 20, None), (4, 30, 1), (5, 40, 1)], "q int, doc int, para long")
    hits = spark.createDataFrame([(1, 1, 99, [3], 5), (1, 2, 10, [2], 5), (1, 3, 10, [3], 5), (2, 1, 10, [3, 4], 7), (3, 6, 20, [], 9), (4, 1, 99, [1], 2)], "q int, rank long, doc int, paras array<long>, chars long")
    rows = E.arm_rows(queries, hits, "q", "doc")
    assert sorted(tuple(r) for r in rows.collect()) == [(1, 2, False, True, 3, 15), (2, 1, True, True, 1, 7), (3, 6, False, False, 1, 9), (4, None, False, True, 1, 2), (5, None, False, True, 0, 0)]
    assert E.arm_summary(rows).first().asDict() == {"queries": 5, "top1": 1, "top5": 2, "mrr": round((1 / 2 + 1 + 1 / 6) / 5, 6), "never": 2, "dropped": 1, "pinpoint": "1/4", "chars": 6}


@pytest.mark.parametrize(("file", "apart"), [("word_bpe_49k.json", True), ("byte_bpe_50k.json", False)])
def test_token_lengths_equal_the_tokenizer(spark, monkeypatch, file, apart):
    import public_tokenizers
    from tokenizers import Tokenizer

    from decisionloom.functions import token_lengths

    monkeypatch.setattr(token_lengths, "KEPT", 50)
    path = public_tokenizers.path(file)
    texts = ["Hello, world!", None, "", "  spaces\n and lines ", "naïve café 日本", "word " * 3000] + [f"w{i} x{i * 7} y" for i in range(200)]
    df = spark.createDataFrame([(i, t, "z") for i, t in enumerate(texts)], "id int, text string, `a b` string")
    own = Tokenizer.from_file(path)
    rows = with_token_lengths(df, path, apart=apart)
    assert rows.columns == ["id", "a b", "n_tokens"]
    assert {r["id"]: r["n_tokens"] for r in rows.collect()} == {i: len(own.encode(t or "", add_special_tokens=False).ids) for i, t in enumerate(texts)}


def test_levels_are_merged_in_one_pass(spark):
    rows = [(1, [10, 10], [0.5, 0.25]), (1, [11, 10], [0.1, 0.7]), (1, [12, 12], [-0.3333335, 1.0]), (2, [20, 20], [0.0, 0.0])]
    members = spark.createDataFrame(rows, "doc long, ids array<long>, vector array<double>")
    got = sorted((r["level"], r["id"], [round(x, 9) for x in r["vector"]]) for r in E.merged_levels(members, ["doc"], "id", 2).collect())
    want = []
    for level in (0, 1):
        one = E.merged_vectors(members.select(F.col("ids")[level].alias("id"), "vector"), ["id"])
        want += [(level, r["id"], [round(x, 9) for x in r["vector"]]) for r in one.collect()]
    assert got == sorted(want)


def test_ranks_are_counted_as_they_would_be_sorted(spark):
    scores = spark.createDataFrame([(q, u, float((u * 7 + q) % 5)) for q in range(3) for u in range(20)], "item long, unit long, score double")
    own = scores.filter("unit % 4 = 1").select("item", F.col("unit").alias("at"), F.col("score").alias("own"))
    counted = sorted((r["item"], r["at"], r["rank"]) for r in L.better(scores, own, "item", "unit").collect())
    assert counted == sorted((r["item"], r["unit"], r["rank"]) for r in L.ranked(scores, "item", "unit").filter("unit % 4 = 1").collect())


def test_terms_of_a_unit_are_dealt_out_once_for_its_scores(spark):
    units = spark.createDataFrame([(i, f"alpha beta gamma{i % 3}") for i in range(30)], "doc long, text string")
    items = spark.createDataFrame([(1, "alpha gamma1"), (2, "beta gamma2 alpha")], "item long, text string")
    counts = L.term_counts(units, L.asked_terms(items), ["doc"])
    scores = L.bm25(units, items, "doc", "item", counts=counts)
    plan = scores._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(item" not in plan and scores.count() == 60
    assert {(r["doc"], r["guarded"]) for r in scores.filter("item = 1").collect()} == {(i, i % 3 == 1) for i in range(30)}


def test_searches_of_two_stages_count_the_words_of_texts_once(spark):
    from decisionloom.plans import evaluation, topics
    from tests.conftest import DATA

    for query in (evaluation.two_stage_search, topics.capsule_against_text):
        plan = query(spark, DATA)._jdf.queryExecution().optimizedPlan().toString()
        assert "n_chars" not in plan, query.__name__  # a column of documents, whose texts were read anew for each use of a score
