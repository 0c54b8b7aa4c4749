"""Operators on small fixtures with nulls, empty texts, ties, repeated rows and clashing names, against brute force."""

import hashlib
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from decisionloom.llm import hnsw, licences, minhash, mixing, nndescent, packing, quality, substrings, token_counts, toxicity
from decisionloom.llm.graph import components
from decisionloom.llm.queries import ORACLE_SQL, QUERIES
from tests.conftest import DATA, compared

WORDS = [f"w{i}" for i in range(400)]


def prose(seed, n):
    rng = np.random.default_rng(seed)
    return " ".join(rng.choice(WORDS, n))


BASE = prose(1, 120)
TEXTS = [BASE, BASE, BASE.upper(), BASE + " tail", prose(2, 60), "", None, "one two", "one  two", prose(3, 30) + " " + " ".join(BASE.split()[20:80]), "same " * 60, prose(4, 3000)]
ROWS = [(i, t, "en" if i % 2 else None, ["a", "b", None][i % 3], "x") for i, t in enumerate(TEXTS)] + [(4, TEXTS[4], "en", "b", "x"), (None, BASE, "en", "a", "x")]
SCHEMA = "doc_id long, text string, lang string, source string, node string"


@pytest.fixture(scope="module")
def docs(spark):
    """Documents with a column whose name some operators use themselves."""
    return spark.createDataFrame(ROWS, SCHEMA)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


def test_substrings_equal_brute_force(spark, docs, none):
    order = sorted(ROWS, key=lambda r: (r[0] is None, r[0] or 0))
    seen, expected, done = set(), [], {}
    for doc, text, *_ in order:
        words = (text or "").encode().split()
        if (doc, text) not in done:
            gone = set()
            for p in range(len(words) - 19):
                key = tuple(words[p : p + 20])
                if key in seen:
                    gone |= set(range(p, p + 20))
                seen.add(key)
            done[doc, text] = (doc, len(words), len(gone), hashlib.sha256(b" ".join(w for i, w in enumerate(words) if i not in gone)).hexdigest())
        expected.append(done[doc, text])
    got = [tuple(r) for r in substrings.repeated_windows(docs).select("doc_id", "n_words", "n_removed", "kept_sha256").collect()]
    key = lambda r: (r[0] is None, r[0] or 0, r[1:])
    assert sorted(got, key=key) == sorted(expected, key=key)
    assert substrings.repeated_windows(none).count() == 0


@pytest.mark.parametrize(("memory", "block"), [(1, 1 << 20), (10, 100), (8000, 1000)])
def test_substrings_by_longer_prefixes_and_blocks_are_the_same(spark, monkeypatch, memory, block):
    rng = np.random.default_rng(21)
    passages = [prose(300 + i, 25 + 3 * i) for i in range(6)]
    rows = []
    for i in range(70):  # passages that many documents share, whole and in part, between words of their own
        some = [passages[j] if rng.random() < 0.7 else " ".join(passages[j].split()[5:-2]) for j in rng.integers(0, 6, 3)]
        rows.append((int(i % 60), f" {prose(400 + i, 3 + i)} ".join(some) + (" again and again" * 40 if i % 9 == 0 else "")))
    expected = by_windows(rows)
    monkeypatch.setattr(substrings, "BLOCK", block)
    monkeypatch.setattr(substrings, "SIDE_BY_SIDE", 50)
    monkeypatch.setattr(substrings, "BYTES", 64)
    got = substrings.repeated_windows(spark.createDataFrame(rows, "doc_id long, text string"), memory=memory)
    assert sorted(tuple(r) for r in got.select("doc_id", "n_words", "n_removed", "kept_sha256").collect()) == sorted(expected)


def by_windows(rows):
    """Removed words by definition, for rows (doc_id, text); of one id's texts the order is that of a digest."""
    order = sorted({(doc, tuple((text or "").encode().split())) for doc, text in rows}, key=lambda r: (r[0] is None, r[0] or 0, hashlib.sha256(b" ".join(r[1])).digest()))
    seen, found = set(), {}
    for doc, words in order:
        gone = set()
        for p in range(len(words) - 19):
            if words[p : p + 20] in seen:
                gone |= set(range(p, p + 20))
            seen.add(words[p : p + 20])
        found[doc, words] = (doc, len(words), len(gone), hashlib.sha256(b" ".join(w for i, w in enumerate(words) if i not in gone)).hexdigest())
    return [found[doc, tuple((text or "").encode().split())] for doc, text in rows]


def test_remove_repeats_keeps_columns(spark, docs):
    out = substrings.remove_repeats(docs)
    assert out.columns == docs.columns
    assert out.count() == len(ROWS)


def shingles(text):
    w = (text or "").encode().lower().split()
    return frozenset(tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))) if w else frozenset()


def test_minhash_equals_brute_force(spark, docs, none):
    rng = np.random.default_rng(9)
    rows = list(ROWS)
    for i in range(60):  # a group of near copies whose pairs lie on both sides of the threshold
        w = BASE.split()
        for at in rng.integers(0, len(w), i % 4):
            w[at] = f"new{i}_{at}"
        rows.append((100 + i, " ".join(w), "en", "a", "x"))
    df = spark.createDataFrame(rows, SCHEMA)
    sets = [(r[0], shingles(r[1])) for r in rows]
    parent = list(range(len(sets)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(sets)):
        for j in range(i):
            a, b = sets[i][1], sets[j][1]
            if a and b and 100 * len(a & b) >= 85 * len(a | b):
                parent[root(i)] = root(j)
    least = {}
    for i, (doc, _) in enumerate(sets):
        if doc is not None:
            least[root(i)] = min(least.get(root(i), doc), doc)
    expected = sorted((str(doc), len(s), least.get(root(i)) if s else doc) for i, (doc, s) in enumerate(sets))
    got = sorted((str(r["doc_id"]), r["n_shingles"], r["component_id"]) for r in minhash.near_duplicates(df).collect())
    assert got == expected
    kept = minhash.keep_one(df)
    assert kept.columns == df.columns
    assert kept.filter(F.col("text") != "").select("text").distinct().count() == kept.filter(F.col("text") != "").count()
    assert minhash.near_duplicates(none).count() == 0


def test_near_copies_of_the_pipeline_link_at_80(spark):
    import corpus_pipeline

    rng, rows = np.random.default_rng(12), []
    for g in range(12):  # pairs of 0.77 to 1, many of them between 0.80 and 0.85
        words = prose(50 + g, 100 + 5 * g).split()
        for k in range(4):
            w = list(words)
            for at in rng.integers(0, len(w), k):
                w[at] = f"new{k}_{at}"
            rows.append((10 * g + k, " ".join(w)))
    sets = [shingles(t) for _, t in rows]
    least = list(range(len(rows)))
    between = 0
    for i in range(len(rows)):
        for j in range(i):
            both, all_ = len(sets[i] & sets[j]), len(sets[i] | sets[j])
            between += 80 * all_ <= 100 * both < 85 * all_
            if 100 * both >= 80 * all_:
                least = [min(least[i], least[j]) if x in (least[i], least[j]) else x for x in least]
    assert between >= 3
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted(r["doc_id"] for r in corpus_pipeline.drop_near_copies(spark, df, DATA).collect())
    assert got == [rows[i][0] for i in sorted(set(least))]
    assert len(got) < minhash.keep_one(df).count()
    bands, width = minhash.bands_for(80)
    assert bands * width <= minhash.HASHES and (1 - 0.8**width) ** bands <= 1e-6
    assert minhash.bands_for(85) == (24, 5)


def test_blocks_lose_nothing(spark, monkeypatch):
    """Small blocks and groups give the same links."""
    rows = [(i, " ".join(BASE.split()[: 119 - i % 3] + [f"t{i}"])) for i in range(12)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    one = sorted(map(repr, minhash.near_duplicates(df).select("doc_id", "component_id").collect()))
    monkeypatch.setattr(minhash, "BLOCK", 2)
    monkeypatch.setattr(minhash, "GROUP", 2)
    assert sorted(map(repr, minhash.near_duplicates(df).select("doc_id", "component_id").collect())) == one


def test_pruning_keeps_pairs_at_the_threshold():
    rng, least = np.random.default_rng(3), minhash.least_matches()
    same = rng.random((4000, minhash.HASHES)) < 0.85
    alive, _ = minhash.survive(same.astype(np.uint32), np.ones_like(same, dtype=np.uint32), least)
    assert len(alive) >= 3990
    low = rng.random((4000, minhash.HASHES)) < 0.5
    alive, _ = minhash.survive(low.astype(np.uint32), np.ones_like(low, dtype=np.uint32), least)
    assert len(alive) <= 40


def test_components(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(0, 30)] + [(50, 40), (40, 60), (7, 7)], "a long, b long")
    got = {r["node"]: r["component"] for r in components(edges).collect()}
    assert got == {**dict.fromkeys(range(31), 0), 40: 40, 50: 40, 60: 40}
    assert components(edges.filter("false")).count() == 0


def unpacked(rows, out, capacity):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(packing.default_tokenizer())
    by_seq: dict = {}
    by_doc: dict = {}
    for r in out:
        by_seq.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
        by_doc.setdefault(r["doc_id"], []).append((r["start"], r["length"], r["ids_crc32"]))
    padding = 0
    for pieces in by_seq.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= capacity
        padding += 0 if at & (at - 1) == 0 else capacity - at
    for doc, text in rows:
        ids = np.array(tokenizer.encode(text or "", add_special_tokens=False).ids + [2], dtype="<u4")
        left = by_doc[doc]
        at = 0
        while at < len(ids):
            piece = next(p for p in left if p[0] == at and zlib.crc32(ids[at : at + p[1]].tobytes()) == p[2])
            left.remove(piece)
            at += piece[1]
    assert not any(by_doc.values())
    return padding


@pytest.mark.parametrize("capacity", [4096, 64])
def test_packing_round_trip(spark, docs, none, capacity):
    extra = ["It's don't 12ab ÉCOLE Straße! x<|endoftext|>y  ́a é İstanbul ΣΑΣ a\u0085b ﬁ 中文 😀", "...!? a.b.c ÿ Ÿ µ ª"]
    df = docs.select("doc_id", "text").unionByName(spark.createDataFrame([(900 + i, t) for i, t in enumerate(extra)], "doc_id long, text string"))
    out = packing.pack(df, capacity=capacity).collect()
    assert unpacked([tuple(r) for r in df.collect()], out, capacity) == 0
    assert packing.pack(none).count() == 0


def test_words_with_any_marks_are_learnt_by_their_letters(monkeypatch):
    from tokenizers import Tokenizer

    path = packing.default_tokenizer()
    tokenizer, asked = Tokenizer.from_file(path), []

    class Counted:
        model = tokenizer.model

        def encode_batch_fast(self, texts, **kw):
            asked.extend(texts)
            return tokenizer.encode_batch_fast(texts, **kw)

    plain = "word*** Word### WORD&&&. \u00c9cole%%% \u00e9cole*** word' word'! a_b a_ x<|y x<| word\u0301. j\u030c J\u030c! don't 's ''s word's*** \u017dena*** 12*** a1*** <|endoftext|>*** ***"
    want = np.array(tokenizer.encode(plain, add_special_tokens=False).ids, dtype="<u4").tobytes()
    for most in (packing.CACHE, 2):  # kept, and forgotten in the middle of a text
        monkeypatch.setattr(packing, "CACHE", most)
        ids = packing.Ids(path)
        assert ids(plain.encode()) == want == ids(plain.encode())
    monkeypatch.undo()
    ids = packing.Ids(path)
    ids.tokenizer = Counted()
    ids(b"word*** Word### word### worD*** two***")
    assert sorted(asked) == ["###", "***"]  # not the words that they end


def test_token_counts_equal_brute_force(spark, docs, none):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(packing.default_tokenizer())
    n = [len(tokenizer.encode(r[1] or "", add_special_tokens=False).ids) for r in ROWS]
    sums = token_counts.suffix_sums(token_counts.histogram(docs))
    expected = sorted((k, n.count(k), sum(x >= k for x in n), sum(x for x in n if x >= k), sum(min(x, k) for x in n), sum(x <= k for x in n) / len(n)) for k in set(n))
    assert sorted(map(tuple, sums.collect())) == expected
    assert tuple(token_counts.answer(sums, 100).first()) == (len(n), sum(n), sum(x > 100 for x in n), sum(min(x, 100) for x in n))
    assert token_counts.at_quantile(sums, 0.5).first()[0] == sorted(n)[-(-len(n) // 2) - 1]
    assert token_counts.suffix_sums(token_counts.histogram(none)).count() == 0


@pytest.mark.parametrize("histogram", [{3000: 500}, {}, {1: 1}, {4095: 10}, {2049: 100, 3: 5}, {i: 2 for i in range(1, 600)}])
def test_places_hold_every_rank_once(histogram):
    places, sequences = packing.place(histogram)
    filled = np.zeros(sequences, np.int64)
    for length, n in histogram.items():
        whole = np.zeros(n, np.int64)
        for origin, part, lo, have, k, m, first, _ in places.tolist():
            if origin == length:
                size = length if part < 0 else [1 << b for b in range(length.bit_length() - 1, -1, -1) if length >> b & 1][part]
                whole[lo : lo + have] += size
                np.add.at(filled, first + (k + np.arange(have)) // m, size)
        assert (whole == length).all()
    assert (filled <= 4096).all()
    assert all(f == 4096 or f & (f - 1) == 0 for f in filled.tolist())


def test_best_fill_is_the_best():
    rng = np.random.default_rng(0)
    for _ in range(30):
        sizes = {int(s): int(n) for s, n in zip(rng.integers(1, 60, 4), rng.integers(1, 4, 4), strict=True)}
        room = int(rng.integers(1, 120))
        sums = {0}
        for s, n in sizes.items():
            sums = {a + s * k for a in sums for k in range(n + 1)}
        used = packing.best_fill(sorted(sizes.items(), reverse=True), room)
        assert sum(s * n for s, n in used.items()) == max(x for x in sums if x <= room)
        assert all(n <= sizes[s] for s, n in used.items())


def test_mixing_meets_targets(spark, docs, none):
    rows = mixing.mixing_plan(docs).collect()
    by: dict = {}
    for r in rows:
        assert 0 <= r["taken"] <= 3 * r["size"]
        by.setdefault(r["source_size"], []).append(r)
    for group in by.values():
        assert abs(sum(r["taken"] for r in group) - group[0]["target"]) <= max(r["size"] for r in group)
    assert sorted(map(repr, rows)) == sorted(map(repr, mixing.mixing_plan(docs).collect()))
    mixed = mixing.mix_documents(docs)
    assert mixed.columns == docs.columns
    words = mixed.select(F.sum(F.regexp_count("text", F.lit(r"[^\x20\x09-\x0D]+")))).first()[0]
    assert words == sum(r["taken"] for r in rows)
    assert mixing.mixing_plan(none).count() == 0


def test_water_filling_reshares(spark):
    s = spark.createDataFrame([("a", 1, 1), ("b", 100, 1), ("c", 0, 1)], "source string, source_size long, weight long")
    got = {r["source"]: r["target"] for r in mixing.water_fill(s, 3).collect()}
    assert got == {"a": 3.0, "b": 98.0, "c": 0.0}


def by_rules(text):
    """Labels and score of a text by the rules alone: no gate, no zones, no keywords."""
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    starts = sorted((i, len(p.split())) for i in range(len(words)) for p in licences.BASE if words[i : i + len(p.split())] == p.split())
    body = " " + " ".join(words) + " "
    base = {x for p, x in licences.BASE.items() if f" {p} " in body}
    found = sorted((-r.priority, -(m.end() - m.start()), m.start(), r.label, r.weight) for r in licences.RULES for m in re.finditer(rf"(?<= )(?:{r.pattern})(?= )", body))
    taken = []
    for d in found:
        if all(d[2] - d[1] <= t[2] or t[2] - t[1] <= d[2] for t in taken):
            taken.append(d)
    labels = base | {t[3] for t in taken}
    return len(words), len(starts), starts[0][0] if starts else None, starts[-1][0] if starts else None, ",".join(sorted(base)), ",".join(sorted(labels)), max([0.6 * bool(base), *(t[4] for t in taken)])


def least_text(pattern):
    """The shortest text that a rule's pattern matches, by walking its parse."""
    import re._parser as parser

    def walk(tree):
        out = ""
        for kind, value in tree:
            name = str(kind)
            if name == "LITERAL":
                out += chr(value)
            elif name == "SUBPATTERN":
                out += walk(value[-1])
            elif name == "BRANCH":
                out += min(map(walk, value[1]), key=len)
            elif name in ("MAX_REPEAT", "MIN_REPEAT"):
                out += walk(value[2]) * value[0]
            elif name == "IN":
                out += {"LITERAL": lambda v: chr(v), "RANGE": lambda v: chr(v[0]), "CATEGORY": lambda v: "1"}[str(value[0][0])](value[0][1])
            elif name == "ANY":
                out += "y"
            else:
                raise AssertionError(name)
        return out

    return walk(parser.parse(pattern))


def test_licences_equal_the_rules_alone(spark, none):
    far = " " + prose(3, 400) + " "
    texts = ["Licensed under CC BY-NC-SA 4.0 and the MIT License. mit license MIT LICENSE", "GNU Lesser General Public License v2.1 or later; see GNU General Public License version 3", "", None, "SPDX-License-Identifier: Apache-2.0", "cc by é cc by", "mit der license", "Kelvin K İ mit license x mit license"]
    texts += ["Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License", "https://www.gnu.org/licenses/gpl-3.0.html" + far + "All rights reserved. Copyright 2020 2021 Some One. All Rights Reserved" + far + "MIT License", "under the MIT license under the Apache license" * 30, far + "see the GNU General Public License for more details" + far]
    texts += [least_text(r.pattern) for r in licences.RULES]
    texts += [far.join(least_text(r.pattern) for r in licences.RULES[i::20]) for i in range(3)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string")
    columns = ["n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"]
    got = {r["doc_id"]: tuple(r[c] for c in columns) for r in licences.scan(df).collect()}
    assert got == {i: by_rules(t) for i, t in enumerate(texts)}
    assert licences.scan(none).count() == 0


def test_every_rule_passes_the_gates():
    """The least text of each rule is matched by it, holds one of its keywords and passes both gates; none reaches further than a zone."""
    assert len(licences.RULES) > 300
    for rule in licences.RULES:
        text = least_text(rule.pattern)
        assert re.search(rf"(?<= )(?:{rule.pattern})(?= )", f" {text} "), rule
        assert any(k in text for k in rule.keywords), rule
        assert all(any(g in k for g in licences.GATE) for k in rule.keywords), rule
        assert len(text) < licences.AROUND
    assert all(any(r in g for r in licences.RAW_GATE) for g in licences.GATE)


def vectors(spark, n=300, dim=16):
    rng = np.random.default_rng(5)
    x = rng.standard_normal((n, dim))
    x[100:140] = x[100] + 0.02 * rng.standard_normal((40, dim))
    x[7] = x[8] = x[9]
    x /= np.sqrt((x * x).sum(1))[:, None]
    rows = [(i, v.astype(np.float32).tolist(), "x") for i, v in enumerate(x)] + [(1000, None, "x"), (1001, [0.0] * dim, "x"), (1002, [float("nan")] * dim, "x"), (1003, [None] * dim, "x"), (1004, [1.0, 0.0], "x"), (1005, [], "x"), (None, x[7].tolist(), "x")]
    return x.astype(np.float32).astype(np.float64), spark.createDataFrame(rows, "vec_id long, embedding array<float>, node string")


def test_nn_descent_equals_brute_force(spark):
    x, df = vectors(spark)
    unit = x / np.sqrt((x * x).sum(1))[:, None]
    near = unit @ unit.T >= 0.95
    got = {r["vec_id"]: (r["n_links"], r["component_id"], r["kept"]) for r in nndescent.near_duplicates(df).collect()}
    for i in range(len(x)):
        assert got[i][0] == near[i].sum() - 1
        assert got[i][1] == np.flatnonzero(near[i]).min()
    assert all(got[k] == (0, k, True) for k in range(1000, 1006))
    assert got[None][0] == 0
    assert nndescent.near_duplicates(df.filter("false")).count() == 0


def two_groups(spark):
    """Two dense groups of 20 vectors whose only link is one between vectors with full lists."""
    rng = np.random.default_rng(4)
    at = lambda deg: np.array([np.cos(np.radians(deg)), np.sin(np.radians(deg)), 0, 0, 0, 0, 0, 0])
    x = np.array([at(-d) for d in np.linspace(0.3, 1, 19)] + [at(0.0)] + [at(18.0)] + [at(18.0 + d) for d in np.linspace(0.3, 1, 19)])
    x[:, 3:] += 1e-3 * rng.standard_normal((40, 5))
    unit = x / np.sqrt((x * x).sum(1))[:, None]
    links = np.argwhere(np.triu(unit @ unit.T >= 0.95, 1))
    assert [(i, j) for i, j in links if (i < 20) != (j < 20)] == [(19, 20)]
    return spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")


def test_nn_descent_keeps_links_that_full_lists_refuse(spark):
    nodes = nndescent.unit_vectors(two_groups(spark)).cache()
    links = nndescent.confirmed(nndescent.descend(nndescent.forest(nodes, 40, 1), nodes, 0.95), nodes, 0.95)
    assert {r["component"] for r in components(links).collect()} == {0}
    near = [(19, i, 0.9999) for i in range(10, 16)] + [(20, i, 0.9999) for i in range(21, 27)] + [(0, 19, 0.5), (0, 20, 0.5)]
    graph = spark.createDataFrame(near, nndescent.EDGES)
    joined = nndescent._joined(graph, nodes, spark.createDataFrame([], "node long, k int"), 0.95)
    assert joined.filter("least(a, b) = 19 AND greatest(a, b) = 20").count() > 0


def test_nn_descent_makes_up_for_a_search_that_finds_little(spark, monkeypatch):
    """One group of a third of the rows and lone pairs; the search finds the group alone, so the audits fail and all is compared."""
    rng = np.random.default_rng(8)
    x = rng.standard_normal((300, 16))
    x[:100] = x[0] + 0.02 * rng.standard_normal((100, 16))
    x[200:] = x[100:200] + 0.05 * rng.standard_normal((100, 16))
    unit = x / np.sqrt((x * x).sum(1))[:, None]
    near = unit @ unit.T >= 0.95
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    monkeypatch.setattr(nndescent, "descend", lambda graph, nodes, cosine: graph.filter("a < 100 AND b < 100"))
    monkeypatch.setattr(nndescent, "AUDIT", 20)
    monkeypatch.setattr(nndescent, "WHOLE", 64)
    got = {r["vec_id"]: (r["n_links"], r["component_id"]) for r in nndescent.near_duplicates(df).collect()}
    assert got == {i: (near[i].sum() - 1, np.flatnonzero(near[i]).min()) for i in range(300)}
    assert nndescent.trees_for(1_000_000, 0.95) > nndescent.trees_for(20_000, 0.95) > nndescent.TREES


def test_hnsw_recall_and_scores(spark):
    x, df = vectors(spark)
    out: dict = {}
    for r in hnsw.nearest(df, df.filter("vec_id % 20 = 0"), k=20, shard=100).collect():
        out.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    hit = 0
    assert set(out) == set(range(0, 300, 20))
    for q, rows in out.items():
        s = x @ x[q]
        s[q] = -9
        rows.sort()
        assert [r[0] for r in rows] == list(range(1, 21))
        assert all(abs(r[2] - s[r[1]]) < 1e-12 for r in rows)
        assert all(a[2] > b[2] or (a[2] == b[2] and a[1] < b[1]) for a, b in zip(rows, rows[1:], strict=False))
        hit += len({r[1] for r in rows} & set(np.argsort(-s, kind="stable")[:20].tolist()))
    assert hit >= 0.9 * 20 * len(out)
    assert hnsw.nearest(df.filter("false"), df.filter("false")).count() == 0


def test_hnsw_cases(spark):
    """Copies tie by id, few candidates all come back, and an id that repeats is searched and found as each."""
    x = np.eye(4)
    rows = [(0, x[0]), (20, x[0]), (5, x[0]), (3, x[1]), (40, x[2]), (40, x[3]), (7, x[2] + x[3])]
    df = spark.createDataFrame([(i, v.tolist()) for i, v in rows], "vec_id long, embedding array<double>")
    got = [tuple(r)[:4] for r in hnsw.nearest(df, df.filter("vec_id % 20 = 0"), k=3).orderBy("query_id", "rank").collect()]
    assert got[:6] == [(0, 1, 5, 1.0), (0, 2, 20, 1.0), (0, 3, 3, 0.0), (20, 1, 0, 1.0), (20, 2, 5, 1.0), (20, 3, 3, 0.0)]
    few = hnsw.nearest(df.filter("vec_id IN (0, 3)"), df.filter("vec_id = 0"), k=20).collect()
    assert [(r["vec_id"], r["rank"]) for r in few] == [(3, 1)]


def test_hnsw_graph_by_insertion():
    rng = np.random.default_rng(3)
    x = rng.standard_normal((2500, 24)) * rng.uniform(0.5, 2, (2500, 1))
    g = hnsw.Graph(np.arange(2500), x)
    assert all(a.shape[0] == 2500 for a in g.levels) and len(g.levels) > 1
    near = np.argsort(-(x[:200] @ x.T), axis=1)[:, :20]
    found = g.search(x[:200], 128)
    assert np.mean([len(set(a) & set(b)) / 20 for a, b in zip(near.tolist(), found.tolist(), strict=True)]) >= 0.95


def test_hnsw_audit_widens_the_beam(spark):
    """A search with a beam of one misses most; the audit sees it and doubles the beam."""
    rng = np.random.default_rng(4)
    x = rng.standard_normal((600, 32))
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    rows = hnsw.nearest(df, df.filter("vec_id % 20 = 0"), k=5, beam=1, recall=0.99).collect()
    hits = 0
    for q in range(0, 600, 20):
        s = x @ x[q]
        s[q] = -99
        hits += len(set(np.argsort(-s)[:5].tolist()) & {r["vec_id"] for r in rows if r["query_id"] == q})
    assert hits >= 0.99 * 150 and {r["recall"] >= 0.99 for r in rows} == {True}


def labelled(spark, bad):
    rng = np.random.default_rng(2)
    rows, labels = [], []
    for i in range(400):
        words = rng.choice(WORDS, 40).tolist()
        y = int(rng.random() < 0.4)
        if y:
            words = bad(words, rng)
        rows.append((i, " ".join(words), "en" if i % 2 else "de"))
        labels.append((i, 1 - y, y))
    rows += [(1000, None, None), (1001, "", "xx"), (0, rows[0][1], "de"), (None, "a b", "en")]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string"), spark.createDataFrame(labels + [(5, None, None), (None, 1, 1)], "doc_id long, quality int, toxic int"), {i: y for i, _, y in labels}


def test_quality_on_held_out(spark):
    docs, labels, y = labelled(spark, lambda w, rng: [x + "%%%" for x in w])
    rows = quality.classify(docs, labels).collect()
    assert len(rows) == 404
    for r in rows:
        assert 0 <= r["score"] <= 1
        assert r["predicted"] == int(r["score"] >= 0.3)
        if r["doc_id"] is not None:
            assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0)
    held = [r for r in rows if r["held_out"] and r["doc_id"] in y]
    assert np.mean([r["predicted"] != y[r["doc_id"]] for r in held]) >= 0.95
    assert quality.classify(docs, labels.filter("false")).count() == 404


def test_toxicity_on_held_out(spark):
    docs, labels, y = labelled(spark, lambda w, rng: [*w[:20], str(rng.choice(["nastyone", "nastytwo"])), *w[20:]])
    rows = toxicity.classify(docs, labels).collect()
    held = [r for r in rows if r["held_out"] and r["doc_id"] in y]
    assert np.mean([r["predicted"] == y[r["doc_id"]] for r in held]) >= 0.9
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1) for r in rows if r["doc_id"] is not None)
    assert toxicity.keep_clean(docs, labels).columns == docs.columns
    assert {r["predicted"] for r in toxicity.classify(docs, labels.filter("false")).collect()} == {0}


def test_toxicity_rounds_write_no_tables_and_send_learnt_rows_alone(spark, monkeypatch):
    docs, labels, _ = labelled(spark, lambda w, rng: [*w[:20], "nasty", *w[20:]])
    made, stash, learnt, sent = [], toxicity.stash, toxicity._learnt, []
    monkeypatch.setattr(toxicity, "SHARD_CHARS", 8_000)
    monkeypatch.setattr(toxicity, "EPOCHS", 2)
    monkeypatch.setattr(toxicity, "stash", lambda df: made.append(df.columns) or stash(df))
    monkeypatch.setattr(toxicity, "_learnt", lambda *m: sent.append((learnt(*m), *m)) or sent[-1][0])
    toxicity.fit(docs, labels)
    assert len(made) == 2  # what is labelled, and what is dealt out: none for a round
    assert [len(x[0][0]) for x in sent][0] == 0 < len(sent[1][0][0]) < 2_000
    model, speed = toxicity.fresh()
    model["E"][7], speed["v"][:], model["E"][9, 0] = 2, 3, 4
    for own, back in zip((model, speed), toxicity._restored(*learnt(model, speed)), strict=True):
        assert all((own[k] == back[k]).all() for k in own)


def test_toxicity_is_learnt_from_every_labelled_document(spark, monkeypatch):
    """Whatever the number of shards: each fitted document once, the rest for the thresholds, the same again."""
    docs, labels, y = labelled(spark, lambda w, rng: [*w[:20], str(rng.choice(["nastyone", "nastytwo"])), *w[20:]])
    docs = docs.withColumn("text", F.concat("text", F.lit(" everywhere")))
    seen, held = [], toxicity._held
    monkeypatch.setattr(toxicity, "SHARD_CHARS", 8_000)
    monkeypatch.setattr(toxicity, "_held", lambda shards: seen.append((shards.select("shard").distinct().count(), held(shards))) or seen[-1][1])
    rows = toxicity.classify(docs, labels).collect()
    fitted = toxicity._labelled(docs, labels, 3, 1).filter("pmod(h, 5) > 0").count()
    assert seen[0][0] > 3 and seen[0][1][list(toxicity.buckets_of("everywhere"))].tolist() == [fitted] * 2 and 180 < fitted < 260
    of_held = [r for r in rows if r["held_out"] and r["doc_id"] in y]
    assert np.mean([r["predicted"] == y[r["doc_id"]] for r in of_held]) >= 0.9
    assert sorted(map(repr, toxicity.classify(docs, labels).collect())) == sorted(map(repr, rows))


def test_scorer_equals_convolution():
    model = toxicity.train([(i % 2, prose(i, 30) + (" nasty" if i % 2 else ""), "en") for i in range(60)], epochs=2)
    score, text = toxicity.Scorer(model), prose(77, 50) + " nasty, Nasty!"
    ids = np.array([toxicity.buckets_of(w) for w in text.split()])
    x = model["E"][ids[:, 0]] + model["E"][ids[:, 1]]
    pooled = []
    for w in toxicity.WIDTHS:
        a = [sum(x[t + j] @ model[f"W{w}"][j] for j in range(w)) + model[f"c{w}"] for t in range(len(x) - w + 1)]
        pooled.append(np.maximum(np.max(a, 0), 0))
    z = np.concatenate(pooled) @ model["v"] + model["b"]
    assert score(text.encode()) == pytest.approx(1 / (1 + np.exp(-z)), abs=1e-4)


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_equals_sql(spark, name):
    got, expected = compared(spark, QUERIES[name], ORACLE_SQL[name])
    assert got == expected


def linked_least(rows, percent):
    """Least id of each row's component, by comparing all shingle sets; None where a row has no words."""
    sets = [shingles(t) for _, t in rows]
    least = [doc for doc, _ in rows]
    changed = True
    while changed:
        changed = False
        for i in range(len(rows)):
            for j in range(i):
                a, b = sets[i], sets[j]
                if a and b and least[i] != least[j] and 100 * len(a & b) >= percent * len(a | b):
                    least[i] = least[j] = min(least[i], least[j])
                    changed = True
    return least, sets


def test_pipeline_stage_by_stage(spark, tmp_path):
    """Each stage against what it must do to its own input, by definition, over null and empty texts, copies, near copies and shared passages."""
    import corpus_pipeline

    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "minhash_neardup", "substring_dedup", "mixing", "packing"]
    shared = prose(900, 60)
    texts = [prose(500 + i, 60 + i) for i in range(40)]
    texts += [f"{prose(600 + i, 30)} {shared} {prose(700 + i, 20 + i)}" for i in range(6)] + [texts[0], texts[0] + " tail", texts[3].upper(), "", None, "one", shared]
    bad = [f"{prose(800 + i, 30)} nastyone {prose(850 + i, 20)}" for i in range(30)]
    rows = [(i, t, "en", ["a", "b", None][i % 3], len(t or "")) for i, t in enumerate(texts + bad)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    labels = spark.createDataFrame([(i, 1, int(i >= len(texts))) for i in range(len(rows))], "doc_id long, quality int, toxic int")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    labels.write.parquet(f"{tmp_path}/labels.parquet")
    stage = dict(corpus_pipeline.STAGES)
    of = lambda df: sorted((r["doc_id"], r["text"]) for r in df.collect())
    clean = stage["toxicity"](spark, docs, str(tmp_path))
    scored = {r["doc_id"]: r["lang_toxic"] for r in toxicity.classify(docs, labels).collect()}
    assert sorted(r["doc_id"] for r in clean.collect()) == [i for i in sorted(scored) if not scored[i]]
    assert {i for i in scored if scored[i]} >= set(range(len(texts), len(rows), 2)) - set(range(len(texts)))
    one = stage["minhash_neardup"](spark, clean, str(tmp_path))
    given = sorted(((r["doc_id"], r["text"]) for r in clean.collect()), key=lambda r: r[0])
    least, sets = linked_least(given, 80)
    assert sorted(r["doc_id"] for r in one.collect()) == [doc for (doc, _), low, s in zip(given, least, sets, strict=True) if not s or doc == low]
    cut = stage["substring_dedup"](spark, one, str(tmp_path))
    given = sorted(((r["doc_id"], r["text"]) for r in one.collect()), key=lambda r: r[0])
    expected = {doc: (removed, digest) for doc, _, removed, digest in by_windows(given)}
    got = {r["doc_id"]: r for r in cut.collect()}
    assert set(got) == set(expected) and sum(n > 0 for n, _ in expected.values()) >= 5
    for doc, text in given:
        kept = (got[doc]["text"] or "").encode().split()
        assert hashlib.sha256(b" ".join(kept)).hexdigest() == expected[doc][1]
        assert got[doc]["text"] == text if not expected[doc][0] else got[doc]["n_chars"] == len(got[doc]["text"])
    mixed = stage["mixing"](spark, cut, str(tmp_path))
    plan = {r["doc_id"]: r for r in mixing.mixing_plan(cut).collect()}
    taken: dict = {}
    for r in mixed.collect():
        taken[r["doc_id"]] = taken.get(r["doc_id"], 0) + len((r["text"] or "").split())
    assert taken == {doc: r["taken"] for doc, r in plan.items() if r["taken"] > 0 or taken.get(doc) == 0}
    mixed = mixed.persist()
    pieces = stage["packing"](spark, mixed, str(tmp_path)).collect()
    tokens = token_counts.lengths(mixed).agg(F.sum(F.col("n_tokens") + 1)).first()[0]
    assert sum(r["length"] for r in pieces) == tokens
    mixed.unpersist()
    whole = corpus_pipeline.run(spark, str(tmp_path))
    assert sum(r["length"] for r in whole.collect()) == tokens
    nothing = tmp_path / "none"
    docs.filter("false").write.parquet(f"{nothing}/documents.parquet")
    labels.filter("false").write.parquet(f"{nothing}/labels.parquet")
    assert corpus_pipeline.run(spark, str(nothing)).count() == 0


def test_quality_scores_equal_a_plain_forward_pass(spark):
    rows = [(1, prose(1, 50)), (0, "same same same word"), (1, prose(2, 40)), (0, "again " * 30)] * 5
    model = quality.train(rows, epochs=2)
    texts = [*{t for _, t in rows}, "never seen", "x x y x", "", None, " one "]
    got = {r["doc_id"]: r["score"] for r in quality.scores(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), model).collect()}
    for i, t in enumerate(texts):
        words = (t or "").split()
        ids = np.concatenate([np.zeros(0, np.int64), *[quality.features([quality.AGAIN if k and words[k - 1] == w else w])[0] for k, w in enumerate(words)]])
        mean = model["vectors"][ids].astype(float).mean(0) if len(ids) else np.zeros(model["vectors"].shape[1])
        z = mean @ model["out"] + model["bias"]
        assert abs(got[i] - np.exp(z[1]) / np.exp(z).sum()) < 1e-5, t
    assert got[texts.index("")] == got[texts.index(None)]


def test_thresholds_are_calibrated_by_language(spark):
    """Nulls and empty texts are scored alike; a language without calibration, or null, has the default threshold."""
    docs, labels, _ = labelled(spark, lambda w, rng: [*w[:20], "nastyone", *w[20:]])
    rows = toxicity.classify(docs, labels).collect()
    by = {r["doc_id"]: r for r in rows}
    assert by[1000]["score"] == by[1001]["score"] and by[1000]["lang_threshold"] == by[1001]["lang_threshold"] == toxicity.THRESHOLD
    assert {r["lang_toxic"] == int(r["score"] >= r["lang_threshold"]) for r in rows} == {True}
    assert {r["predicted"] == int(r["score"] >= 0.7) for r in rows} == {True}
    model, thresholds = toxicity.fit(docs, labels)
    assert set(thresholds) == {"de", "en"} and all(toxicity.LEAST <= t <= toxicity.MOST for t in thresholds.values())


CLASHES = "_id _y _key _score _digest _kept _node _d _text id y did raw doc key score node component digest kept lang_threshold band word size target _mix_size _mix_key _mix_text _mix_copy _mix_source one first".split()


def test_columns_of_any_name_go_through(spark):
    """Extra columns under names that operators use themselves neither crash nor change."""
    rows = [(r[0], r[1], r[2], r[3], *[f"{c}-{i}" for c in CLASHES]) for i, r in enumerate(ROWS)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, " + ", ".join(f"`{c}` string" for c in CLASHES))
    labels = spark.createDataFrame([(i, i % 2, i % 2, "x") for i in range(12)], "doc_id long, quality int, toxic int, _id string")
    plain = df.select("doc_id", "text", "lang", "source")
    for whole in (lambda d: toxicity.keep_clean(d, labels), minhash.keep_one, substrings.remove_repeats, mixing.mix_documents):
        got, expected = whole(df), whole(plain)
        assert got.columns == df.columns
        assert sorted(map(repr, got.select(plain.columns).collect())) == sorted(map(repr, expected.collect()))
        assert all(r[c].startswith(f"{c}-") for r in got.collect() for c in CLASHES)
    for thin in (lambda d: quality.classify(d, labels), lambda d: toxicity.classify(d, labels), minhash.near_duplicates, substrings.repeated_windows, licences.scan, packing.pack, mixing.mixing_plan):
        assert sorted(map(repr, thin(df).collect())) == sorted(map(repr, thin(plain).collect()))


def test_words_are_split_alike_in_training_and_scoring(spark):
    """Unicode spaces are parts of words, as in scoring, so what was trained scores as it was fitted."""
    wide = "\u3000".join(prose(5, 31).split())
    rows = [(1, wide), (0, prose(6, 30))] * 20
    scored = spark.createDataFrame([(0, wide), (1, prose(6, 30))], "doc_id long, text string")
    got = {r["doc_id"]: r["score"] for r in quality.scores(scored, quality.train(rows)).collect()}
    assert got[0] > 0.9 > 0.1 > got[1]
    model = toxicity.train(rows, epochs=40)
    got = {r["doc_id"]: r["score"] for r in toxicity.scores(scored.withColumn("lang", F.lit("en")), model).collect()}
    assert got[0] > 0.9 > 0.1 > got[1]


def test_a_text_too_long_for_the_sample_is_skipped_alone(spark, caplog):
    from decisionloom.llm.common import labelled_sample

    docs = spark.createDataFrame([(i, "word " * (10 if i % 4 else 1000)) for i in range(40)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(40)], "doc_id long, quality int")
    rows = labelled_sample(docs, labels, "quality", 5, 0, {0: 50, 1: 50}, most=2000)
    kept = [i for i in range(40) if i % 4 and zlib.crc32(str(i).encode()) % 5]
    assert sorted(y for y, _ in rows) == sorted(i % 2 for i in kept)
    assert f"{sum(zlib.crc32(str(i).encode()) % 5 > 0 for i in range(0, 40, 4))} labelled documents" in caplog.text
    assert labelled_sample(docs, labels, "quality", 5, 0, {0: 50, 1: 50}, most=10) == []


def test_classifiers_on_no_documents_and_a_very_long_one(spark, none):
    labels = spark.createDataFrame([(i, i % 2, i % 2) for i in range(12)], "doc_id long, quality int, toxic int")
    assert quality.classify(none, labels).count() == toxicity.classify(none, labels).count() == 0
    long_ = spark.createDataFrame([(0, prose(1, 300_000), "en"), (1, prose(2, 50), "de"), (2, prose(3, 60), None)], "doc_id long, text string, lang string")
    for rows in (quality.classify(long_, labels).collect(), toxicity.classify(long_, labels).collect()):
        assert all(0 <= r["score"] <= 1 for r in rows) and len(rows) == 3


def test_many_null_ids_are_looked_up_by_their_text(spark):
    texts = [prose(50 + i, 30) for i in range(300)] + [prose(50 + i, 30) + " end" for i in range(150)]
    df = spark.createDataFrame([(None, t) for t in texts] + [(7, texts[0]), (7, texts[5])], "doc_id long, text string")
    rows = minhash.near_duplicates(df).collect()
    assert len(rows) == len(texts) + 2
    by = {}
    for r in rows:
        by.setdefault(r["node"], set()).add((r["component_id"], r["n_shingles"]))
    assert all(len(x) == 1 for x in by.values())
    assert sum(r["component_id"] == 7 for r in rows) == 6  # the two rows of id 7, both texts' null rows and their near copies
    nodes = minhash.signed(df).filter("node is not null").groupBy("node").agg(F.min(F.struct("did", "raw")).alias("one")).select("node", "one.*")
    assert minhash._sets(df, nodes).count() == len(set(texts))


def test_one_weak_bridge_among_many_vectors(spark):
    """Two groups hang together by one pair; all other vectors have no link, and none is compared with all for that."""
    rng = np.random.default_rng(8)
    n, dim = 4000, 48
    x = rng.standard_normal((n, dim))
    x /= np.linalg.norm(x, axis=1)[:, None]
    step = np.arccos(0.955)
    for k in range(1, 40):  # a chain: each links with the next only
        x[k] = np.cos(k * step) * x[0] + np.sin(k * step) * (x[n - 1] - (x[n - 1] @ x[0]) * x[0]) / np.linalg.norm(x[n - 1] - (x[n - 1] @ x[0]) * x[0]) if k < 4 else x[k]
    x[10:20] = x[10] + 0.01 * rng.standard_normal((10, dim))
    x /= np.linalg.norm(x, axis=1)[:, None]
    sims = x @ x.T
    np.fill_diagonal(sims, 0)
    links = sims >= 0.95
    df = spark.createDataFrame([(i, v) for i, v in enumerate(x.tolist())], "vec_id long, embedding array<double>")
    got = {r["vec_id"]: r for r in nndescent.near_duplicates(df).collect()}
    assert [got[i]["n_links"] for i in range(n)] == links.sum(1).tolist()
    label = np.arange(n)
    while True:
        new = np.minimum(label, np.where(links, label[None, :], n).min(1))
        if (new == label).all():
            break
        label = new
    assert [got[i]["component_id"] for i in range(n)] == label.tolist()
    assert got[0]["n_audited"] > 1000 and 0 < got[0]["unsure_share"] < 0.003


def test_no_links_are_no_reason_to_compare_all(spark, monkeypatch):
    rng = np.random.default_rng(9)
    df = spark.createDataFrame([(i, v) for i, v in enumerate(rng.standard_normal((3000, 32)).tolist())], "vec_id long, embedding array<double>")
    monkeypatch.setattr(nndescent, "everywhere", lambda *a: pytest.fail("all vectors were compared"))
    assert nndescent.near_duplicates(df).filter("n_links > 0 or not kept").count() == 0
