"""Infilling, alignment of tokenizers and context trees against brute force."""

import bisect
import hashlib
import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from decisionloom.llm import alignment, context_trees, infilling
from tests.conftest import DATA, compared
from tests.llm.test_operators import ROWS, SCHEMA, prose

ODD = ["", None, " ", "  ", "a  b", " lead", "trail ", "trail  ", "tab\there", "nl\n x", "　x", "a 　b", "a\x1c b", "<|endoftext|> yes", "</s> <s> <unk> <0x41>", "a▁b here", "ﬁ é", "don't we'll 's", "日本語 \U0001f642\U0001f642 ok", "a\r\nb {\r\n }", " \n ", "\x00 nul \x00", "word  <|endoftext|>  word", "x" * 5000, "a\xa0 b \xa0c", "<P> here", "x <S", "M> <"]
MORE = [(100 + i, t, "en", "a", "x") for i, t in enumerate(ODD)] + [(100, "the same", "en", "a", "x")] * 2 + [(200, prose(9, 40_000), None, None, None)]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(ROWS + MORE, SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


def in_order(rows):
    return sorted((tuple(r) for r in rows), key=lambda r: tuple((x is None, str(x)) for x in r))


UNIT = re.compile(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+")


def infilled(doc, text):
    text = text or ""
    units, h = UNIT.findall(text), hashlib.sha256(f"42:{'' if doc is None else doc}".encode()).hexdigest()
    assert "".join(units) == text
    h1, h2, h3, h4 = (int(h[8 * k : 8 * k + 8], 16) for k in range(4))
    n = len(units)
    low, high = sorted((h1 % (n + 1), h2 % (n + 1)))
    p, m, s = ("".join(x) for x in (units[:low], units[low:high], units[high:]))
    if not text or any(x in text for x in ("<P>", "<S>", "<M>")) or h3 % 100 >= 50:
        return doc, n, "plain", None, None, text
    whole = f"<S>{s}<P>{p}<M>{m}" if h4 % 100 < 80 else f"<P>{p}<S>{s}<M>{m}"
    return doc, n, "spm" if h4 % 100 < 80 else "psm", len(p), len(m), whole


def test_infilling_equals_brute_force_and_can_be_undone(spark, docs, none):
    rows = infilling.transform(docs)
    assert in_order(rows.collect()) == in_order(infilled(r[0], r[1]) for r in ROWS + MORE)
    back = rows.select("doc_id", infilling.restored(F.col("form"), F.col("output")).alias("text"))
    assert in_order(back.collect()) == in_order((r[0], r[1] or "") for r in ROWS + MORE)
    assert infilling.transform(none).count() == 0
    assert infilling.transform(docs, rate=0).filter("form <> 'plain'").count() == 0


def test_infilling_query_equals_sql(spark):
    got, expected = compared(spark, infilling.op11_fill_in_middle, infilling.OP11_SQL, DATA)
    assert got == expected


def test_ranked_bits():
    rng = np.random.default_rng(1)
    for _ in range(50):
        at = sorted(rng.choice(3000, 200, replace=False).tolist())
        bits = sum(1 << k for k in at)
        assert [infilling.ranked(bits, k + 1) for k in range(200)] == at


def aligned(rows):
    tokens, per, counts = alignment.Tokens(alignment.default_tokenizers()), [], Counter()
    for doc, text in rows:
        whole = " " + (text or "")
        a, b = tokens.a.encode(whole, add_special_tokens=False).ids, tokens.b.encode(text or "")
        if not text or not tokens.agree([whole], [a], [b])[0]:
            per.append((doc, None))
            continue
        ends = [np.cumsum([len(sizes[i]) for i in ids]).tolist() for ids, sizes in ((a, tokens.a_bytes), (b, tokens.b_bytes))]
        shared = sorted(set(ends[0]) & set(ends[1]))
        split = [[[] for _ in shared], [[] for _ in shared]]
        for side, (ids, own) in enumerate(zip((a, b), ends, strict=True)):
            for i, e in zip(ids, own, strict=True):
                split[side][bisect.bisect_left(shared, e)].append(i)
        links = [(x[-1], y[-1]) for x, y in zip(*split, strict=True)]
        groups = [f"{','.join(map(str, x))}|{','.join(map(str, y))}" for x, y in zip(*split, strict=True)]
        counts.update(links)
        starts = [[0, *own[:-1]] for own in ends]
        overlaps = sum(s < f and t < e for s, e in zip(starts[0], ends[0], strict=True) for t, f in zip(starts[1], ends[1], strict=True)) if len(a) < 3000 else len(a) + len(b) - len(links)
        per.append((doc, (len(a), len(b), len(groups), links, overlaps, hashlib.sha256(";".join(groups).encode()).hexdigest())))
    most = Counter()
    for (_, y), n in counts.items():
        most[y] = max(most[y], n)
    for doc, x in per:
        yield (doc, 0, 0, 0, 0, "", 0, 0, 0) if x is None else (doc, x[0], x[1], x[2], x[4], x[5], len(x[3]), sum(counts[p] == most[p[1]] for p in x[3]), sum(counts[p] for p in x[3]))


@pytest.mark.parametrize(("runs", "tokens"), [(alignment.RUNS, alignment.TOKENS), (20, 10)])
def test_alignment_equals_brute_force(spark, monkeypatch, docs, none, runs, tokens):
    monkeypatch.setattr(alignment, "RUNS", runs)
    monkeypatch.setattr(alignment, "TOKENS", tokens)
    rows = [r[:2] for r in ROWS + MORE] if runs > 20 else [r[:2] for r in ROWS + MORE if r[0] != 200]
    expected = in_order(aligned(rows))
    assert any(r[1] == 0 for r in expected) and any(r[6] != r[7] for r in expected)
    got = alignment.align(docs if runs > 20 else docs.filter("doc_id is null or doc_id <> 200"))
    assert in_order(got.collect()) == expected
    assert alignment.align(none).count() == 0


def test_runs_are_cut_alike_on_both_ways():
    for text in [t for t in ODD if t] + ["plain words here", "two\nlines and\nmore", "a\tb c", "x\x85y z", "e\x1c f"]:
        assert alignment.runs_of(text) == alignment.CUT.split(" " + text)


def context_tree(texts, depth):
    """Counts by (context, node) of training texts, and by definition the mixed probability of a byte after a context."""
    streams = lambda text: b"\n" * depth + b" ".join((text or "").encode().lower().split()) + b"\n"
    counts, longer = Counter(), {}
    path = lambda byte: [((256 | byte) >> (8 - j), byte >> (7 - j) & 1) for j in range(8)]
    for text in texts:
        s = streams(text)
        for i in range(depth, len(s)):
            for d in range(depth + 1):
                context = s[i - d : i]
                for node, bit in path(s[i]):
                    counts[context, node, bit] += 1
                    if d:
                        longer.setdefault((context[1:], node), set()).add(context)
    own = lambda c, v: math.lgamma(counts[c, v, 0] + 0.5) + math.lgamma(counts[c, v, 1] + 0.5) - math.lgamma(counts[c, v, 0] + counts[c, v, 1] + 1) - math.log(math.pi)
    coded = {}

    def weighted(c, v):
        if (c, v) not in coded:
            if len(c) == depth:
                coded[c, v] = own(c, v)
            else:
                below = sum(weighted(x, v) for x in longer.get((c, v), ()))
                coded[c, v] = np.logaddexp(own(c, v), below) - math.log(2)
        return coded[c, v]

    def predicted(c, v, bit, whole):
        p = (counts[c, v, bit] + 0.5) / (counts[c, v, 0] + counts[c, v, 1] + 1)
        if len(c) == depth:
            return p
        w = math.exp(own(c, v) - math.log(2) - weighted(c, v))
        return w * p + (1 - w) * predicted(whole[len(whole) - len(c) - 1 :], v, bit, whole)

    def score(text):
        s = streams(text)
        return sum(math.log10(predicted(b"", v, bit, s[i - depth : i])) for i in range(depth, len(s)) for v, bit in path(s[i]))

    return score


def test_context_trees_equal_brute_force(spark, docs, none):
    rows = [r[:2] for r in ROWS + MORE if r[0] not in (11, 200)]
    trained = [t for d, t in rows if d is None or zlib.crc32(str(d).encode()) % 10]
    words = lambda t: (t or "").encode().lower().split()
    counts = Counter(w for t in trained for w in [*words(t), b""])
    total, distinct = sum(counts.values()), len(counts)
    score = context_tree(trained, 3)
    expected = []
    for d, t in rows:
        own = [*words(t), b""]
        base = sum(math.log10((counts[w] + 0.1) / (total + 0.1 * (distinct + 1))) for w in own)
        expected.append((d, d is not None and zlib.crc32(str(d).encode()) % 10 == 0, len(own), sum(counts[w] > 0 for w in own), total, base, score(t)))
    key = lambda r: (r[0] is None, r[0] or 0, r[2], round(r[5], 6))
    got = sorted((tuple(r) for r in context_trees.language_model_scores(docs.filter("doc_id is null or doc_id not in (11, 200)"), 3).collect()), key=key)
    expected.sort(key=key)
    assert [r[:5] for r in got] == [r[:5] for r in expected]
    assert np.allclose([r[5:] for r in got], [r[5:] for r in expected], rtol=1e-9, atol=1e-7)
    assert any(r[1] for r in got)
    assert context_trees.language_model_scores(none).count() == 0


def test_context_trees_do_not_depend_on_blocks(spark, monkeypatch, docs):
    whole = [tuple(r) for r in context_trees.language_model_scores(docs).collect()]
    monkeypatch.setattr(context_trees, "BLOCK", 1000)
    monkeypatch.setattr(context_trees, "STRIP", 500)
    parts = [tuple(r) for r in context_trees.language_model_scores(docs).collect()]
    key = lambda r: (r[0] is None, r[0] or 0, r[2], round(r[5], 6))
    whole.sort(key=key)
    parts.sort(key=key)
    assert [r[:5] for r in whole] == [r[:5] for r in parts]
    assert np.allclose([r[5:] for r in whole], [r[5:] for r in parts], rtol=1e-9)


def test_nothing_learnt_means_one_half_a_bit(spark):
    held = next(i for i in range(100) if zlib.crc32(str(i).encode()) % 10 == 0)
    (row,) = context_trees.language_model_scores(spark.createDataFrame([(held, "Ab c")], "doc_id long, text string")).collect()
    assert (row["n_tokens"], row["n_known"], row["train_tokens"]) == (3, 0, 0) and abs(row["base_score"]) < 1e-12
    assert math.isclose(row["score"], 5 * 8 * math.log10(0.5))


def test_context_trees_code_held_out_texts_better_than_word_counts(spark):
    rows = context_trees.op13_context_trees(spark, DATA.replace("0.001", "0.01")).filter("held_out")
    total = rows.agg(F.sum("score").alias("score"), F.sum("base_score").alias("base")).first()
    assert total["score"] > total["base"]
