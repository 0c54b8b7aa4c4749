"""Scoring of texts by context-tree weighting over bytes.

A text is its lower-case words, a space between them and an end byte after them.  Each byte is eight binary decisions, a node of
a binary tree each; every node has a tree of contexts, the bytes before from none to DEPTH.  A context's zeros and ones give a
Krichevsky-Trofimov estimate; the weight of a context against all longer ones below it follows bottom-up from how well each
would have coded the training texts, and the prediction mixes the estimates of all depths top-down with these weights.

Spark counts (DEPTH + 1)-byte strings of the whole corpus, folds them level by level into shorter contexts (sums, which combine
before each shuffle, so a frequent context is no hot key), and gives each string its code length.  Texts never meet the whole
table: documents lie in blocks by hash, each block asks for its distinct strings and words, and gets these back beside its
texts.  Strings that only scored texts hold have no counts and an estimate of one half, as in the method.

Learning leaves a hashed fold of documents out.  Beside the score stands a base: smoothed frequencies of words.

Cases: null and empty texts hold the end alone; a null id is learnt from and scored; rows that repeat are learnt from and
scored each; without any training document all estimates are one half; an empty table gives an empty result; other columns
are ignored.
"""

from __future__ import annotations

from collections import Counter
from math import log, pi

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from decisionloom.llm.common import by_value, held_out, row_key, settled, stash, table

by_value(__name__)

#: Bytes of the longest context (at most 6, so that a string and a node fit a long).
DEPTH = 5
#: The end of a text, which no word holds; also stands before its first byte.
END = b"\n"
#: Bytes of text of a block, and how many a task takes at a time.
BLOCK, STRIP = 32 << 20, 4 << 20
#: Documents whose remainder is HELD are not learnt from; what is added to each word's count in the base.
FOLDS, HELD, ADDED = 10, 0, 0.1
#: Rows of a batch of strings and values (fixed width but for words); batches of texts are bounded by bytes.
RECORDS = 50_000

STRINGS, WORDS, DOCUMENTS = 0, 1, 2
ASKED = "block int, kind int, gram long, word binary, n long"


def byte_stream(text: bytes | None) -> tuple[list[bytes], bytes]:
    """Words of a text, and its bytes as they are coded."""
    words = (text or b"").lower().split()  # bytes: A-Z alone, and ASCII white space
    return words, b" ".join(words) + END


def strings(streams: list[bytes], depth: int) -> np.ndarray:
    """For each byte of each stream: the bytes before it, the last one highest, and the byte itself, in a long."""
    pad = END * depth
    x = np.frombuffer(b"".join([pad + s for s in streams]), np.uint8).astype(np.int64)
    out = x[depth:].copy()
    for d in range(1, depth + 1):
        out |= x[depth - d : len(x) - d] << (8 * (depth + 1 - d))
    if len(streams) == 1:
        return out
    size = np.fromiter(map(len, streams), np.int64, len(streams)) + depth
    inside = np.ones(len(x), bool)
    starts = np.cumsum(size) - size
    for d in range(depth):
        inside[starts + d] = False
    return out[inside[depth:]]


def merged(keys: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys and the sums of their counts."""
    k, where = np.unique(np.concatenate(keys), return_inverse=True)
    return k, np.bincount(where, np.concatenate(counts), len(k)).astype(np.int64)


class Asked:
    """Distinct strings and words of a block, and how often training texts hold each."""

    def __init__(self, depth: int):
        self.depth, self.keys, self.counts = depth, [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        self.words, self.waiting, self.size = Counter(), ([], []), [0, 0]

    def add(self, text: bytes | None, train: bool) -> None:
        words, stream = byte_stream(text)
        if train:
            self.words.update(words)
            self.words[b""] += 1
        else:
            for w in words:
                self.words[w] += 0
            self.words[b""] += 0
        self.waiting[train].append(stream)
        self.size[train] += len(stream)
        if self.size[train] >= STRIP:
            self.fold(train)

    def fold(self, train: bool) -> None:
        if self.waiting[train]:
            k, n = np.unique(strings(self.waiting[train], self.depth), return_counts=True)
            self.keys.append(k)
            self.counts.append(n if train else np.zeros(len(k), np.int64))
            self.waiting[train].clear()
            self.size[train] = 0
            if sum(map(len, self.keys[1:])) > len(self.keys[0]) + STRIP:
                k, n = merged(self.keys, self.counts)
                self.keys, self.counts = [k], [n]

    def rows(self, block: int) -> pa.RecordBatch:
        for train in (False, True):
            self.fold(train)
        keys, counts = merged(self.keys, self.counts)
        words, often = list(self.words), list(self.words.values())
        many, few = len(keys), len(words)
        kind = np.repeat(np.array([STRINGS, WORDS], np.int32), [many, few])
        gram = pa.concat_arrays([pa.array(keys, pa.int64()), pa.nulls(few, pa.int64())])
        word = pa.concat_arrays([pa.nulls(many, pa.binary()), pa.array(words, pa.binary())])
        n = np.concatenate([counts, np.array(often, np.int64)])
        return pa.RecordBatch.from_arrays([pa.array(np.full(many + few, block, np.int32)), pa.array(kind), gram, word, pa.array(n)], names=["block", "kind", "gram", "word", "n"])


class Values:
    """Numbers by string, in a table of open addressing."""

    def __init__(self, keys: np.ndarray, values: np.ndarray):
        bits = max(4, int(2 * len(keys)).bit_length())
        self.shift, self.mask = np.uint64(64 - bits), (1 << bits) - 1
        self.keys, self.values = np.full(1 << bits, -1, np.int64), np.zeros(1 << bits)
        at = self.slot(keys)
        while len(keys):
            free = self.keys[at] == -1
            self.keys[at[free]] = keys[free]
            own = self.keys[at] == keys
            self.values[at[own]] = values[own]
            keys, values, at = keys[~own], values[~own], (at[~own] + 1) & self.mask

    def slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> self.shift).astype(np.int64)

    def total(self, keys: np.ndarray) -> float:
        """Sum over keys, all of which are there."""
        at, out = self.slot(keys), 0.0
        while True:
            own = self.keys[at] == keys
            out += float(self.values[at[own]].sum())
            if own.all():
                return out
            if (self.keys[at[~own]] == -1).any():
                raise KeyError("a string that its block didn't ask for")
            keys, at = keys[~own], (at[~own] + 1) & self.mask


def runs(values: np.ndarray) -> list[tuple[int, int]]:
    """Where equal neighbours start and end."""
    cuts = np.flatnonzero(values[1:] != values[:-1]) + 1
    edges = [0, *cuts.tolist(), len(values)]
    return list(zip(edges, edges[1:], strict=False)) if len(values) else []


def in_blocks(docs: DataFrame, blocks: int) -> DataFrame:
    """docs(doc_id, text) with the block of each row, by a hash of its id and text."""
    did, raw = row_key(docs)
    block = F.pmod(F.xxhash64(did, raw), F.lit(blocks)).cast("int")
    return docs.select(block.alias("block"), F.col("doc_id"), F.col("text").cast("binary").alias("text"))


def asked(placed: DataFrame, depth: int) -> DataFrame:
    """What each block asks for, a row per distinct string or word, with its count in training texts."""
    train = ~held_out(F.col("doc_id"), FOLDS, HELD)
    rows = placed.select("block", train.alias("train"), "text").repartition("block").sortWithinPartitions("block")

    def run(batches):
        block, own = None, None
        for batch in batches:
            blocks = np.asarray(batch.column(0))
            for lo, hi in runs(blocks):
                if blocks[lo] != block:
                    if own:
                        yield own.rows(block)
                    block, own = int(blocks[lo]), Asked(depth)
                for train, text in zip(batch.column(1)[lo:hi], batch.column(2)[lo:hi], strict=True):
                    own.add(text.as_py(), train.as_py())
        if own:
            yield own.rows(block)

    return rows.mapInArrow(run, ASKED)


def log_gamma(x):
    """ln of the gamma function of a positive column, by Stirling's series eight places further up."""
    y = x + 8
    low = x
    for k in range(1, 8):
        low = low * (x + k)
    series = 1 / (12 * y) - 1 / (360 * y * y * y) + 1 / (1260 * y * y * y * y * y) - 1 / (1680 * y * y * y * y * y * y * y)
    return (y - 0.5) * F.log(y) - y + 0.5 * log(2 * pi) + series - F.log(low)


def estimate(zeros, ones):
    """ln of the Krichevsky-Trofimov probability of so many zeros and ones."""
    return log_gamma(zeros + F.lit(0.5)) + log_gamma(ones + F.lit(0.5)) - log_gamma(zeros + ones + F.lit(1.0)) - log(pi)


def decisions(grams: DataFrame) -> DataFrame:
    """grams(gram, n) -> gram, n, key (the context, and the node of one of eight decisions), bit."""
    byte = F.col("gram").bitwiseAND(F.lit(255))
    rows = grams.select("gram", "n", F.explode(F.sequence(F.lit(0), F.lit(7))).alias("j"))
    node = F.expr("shiftright((gram & 255) + 256, 8 - j)")
    return rows.select("gram", "n", (F.col("gram") - byte + node).alias("key"), F.expr("shiftright(gram & 255, 7 - j) & 1").alias("bit"))


def shorter(depth: int, longest: int):
    """The key at a depth, from a key of a longer context."""
    return F.col("key").bitwiseAND(F.lit(255 | ((1 << (8 * depth)) - 1) << (8 * (longest + 1 - depth))))


def weighted(bits: DataFrame, depth: int) -> list[DataFrame]:
    """For each depth from none on: key, zeros, ones, and weight, what the context's own estimate counts against longer contexts."""
    own = estimate(F.col("zeros"), F.col("ones"))
    count = lambda bit: F.sum(F.when(F.col("bit") == bit, F.col("n")).otherwise(0)).alias("zeros" if bit == 0 else "ones")
    level = bits.groupBy("key").agg(count(0), count(1)).select("key", "zeros", "ones", own.alias("coded"), F.lit(1.0).alias("weight"))
    levels = [stash(level)]
    for d in range(depth - 1, -1, -1):
        up = levels[-1].groupBy(shorter(d, depth).alias("key")).agg(F.sum("zeros").alias("zeros"), F.sum("ones").alias("ones"), F.sum("coded").alias("below"))
        up = up.withColumn("own", own).withColumn("coded", F.greatest("own", "below") + F.log1p(F.exp(-F.abs(F.col("own") - F.col("below")))) - log(2))
        levels.append(stash(up.select("key", "zeros", "ones", "coded", F.exp(F.col("own") - F.col("coded") - log(2)).alias("weight"))))
    return levels[::-1]


def mixed(levels: list[DataFrame]) -> DataFrame:
    """For each longest context and node: key, zero, one, the mixed probabilities of both bits."""
    depth = len(levels) - 1
    rows = None
    for d, level in enumerate(levels):
        total = F.col("zeros") + F.col("ones") + 1.0
        zero, one = (F.col("zeros") + 0.5) / total, (F.col("ones") + 0.5) / total
        if rows is None:
            before, joined = (F.lit(0.0), F.lit(0.0), F.lit(1.0)), level
        else:
            up = rows.select(F.col("key").alias("_up"), F.col("zero").alias("_zero"), F.col("one").alias("_one"), F.col("rest").alias("_rest"))
            before, joined = (F.col("_zero"), F.col("_one"), F.col("_rest")), level.join(up, shorter(d - 1, depth) == F.col("_up"))
        part = before[2] * F.col("weight")
        rows = joined.select("key", (before[0] + part * zero).alias("zero"), (before[1] + part * one).alias("one"), (before[2] - part).alias("rest"))
    return rows.select("key", "zero", "one")


def code_lengths(grams: DataFrame, depth: int = DEPTH) -> DataFrame:
    """grams(gram, n), n the count in training texts -> gram, value: log10 of the byte's probability after its context."""
    bits = decisions(grams)
    leaves = mixed(weighted(bits, depth))
    p = F.when(F.col("bit") == 1, F.col("one")).otherwise(F.col("zero"))
    return bits.join(leaves, "key").groupBy("gram").agg(F.sum(F.log10(p)).alias("value"))


SCORED = "n_tokens long, n_known long, train_tokens long, base_score double, score double"


def scored(placed: DataFrame, values: DataFrame, total: int, distinct: int, depth: int) -> DataFrame:
    """placed(block, doc_id, text) and values(block, kind, gram, word, value) -> a row per document."""
    kind = placed.schema["doc_id"].dataType.simpleString()
    nothing = lambda t, name: F.lit(None).cast(t).alias(name)
    texts = placed.select("block", F.lit(DOCUMENTS).alias("kind"), nothing("long", "gram"), nothing("binary", "word"), nothing("double", "value"), "doc_id", "text")
    both = texts.unionByName(values.withColumns({"doc_id": F.lit(None).cast(kind), "text": F.lit(None).cast("binary")}))
    rows = both.repartition("block").sortWithinPartitions("block", "kind")
    bottom = float(np.log10(total + ADDED * (distinct + 1)))

    def run(batches):
        block, grams, sums, counts, ready = None, [], [], {}, False
        for batch in batches:
            blocks, kinds = np.asarray(batch.column(0)), np.asarray(batch.column(1))
            out = []
            for lo, hi in runs(blocks.astype(np.int64) * 4 + kinds):
                if blocks[lo] != block:
                    block, grams, sums, counts, ready = blocks[lo], [], [], {}, False
                part = batch.slice(lo, hi - lo)
                if kinds[lo] == STRINGS:
                    grams.append(np.asarray(part.column(2)))
                    sums.append(np.asarray(part.column(4)))
                    continue
                if kinds[lo] == WORDS:
                    counts.update(zip(part.column(3).to_pylist(), part.column(4).to_pylist(), strict=True))
                    continue
                if not ready:
                    code, ready = Values(np.concatenate(grams), np.concatenate(sums)), True
                    grams, sums = [], []
                    known = {w: complex(np.log10(c + ADDED), c > 0) for w, c in counts.items()}
                    counts = {}
                for doc, text in zip(part.column(5).to_pylist(), part.column(6), strict=True):
                    words, stream = byte_stream(text.as_py())
                    base = sum(map(known.__getitem__, words), known[b""])
                    n = len(words) + 1
                    score = sum(code.total(strings([stream[max(0, at - depth) : at + STRIP]], depth)[min(at, depth) :]) for at in range(0, len(stream), STRIP))
                    out.append((doc, n, int(base.imag), total, base.real - n * bottom, score))
            if out:
                columns = list(zip(*out, strict=True))
                types = [batch.schema.field(5).type, pa.int64(), pa.int64(), pa.int64(), pa.float64(), pa.float64()]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=["doc_id", *[x.split()[0] for x in SCORED.split(", ")]])

    return rows.mapInArrow(run, f"doc_id {kind}, {SCORED}")


def language_model_scores(docs: DataFrame, depth: int = DEPTH) -> DataFrame:
    """docs(doc_id, text) -> doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score, for every whole text."""
    return settled(lambda: _scores(docs, depth), RECORDS)


def _scores(docs: DataFrame, depth: int) -> DataFrame:
    size = docs.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0)).alias("n")).first()["n"]
    placed = in_blocks(docs, max(8, -(-size // BLOCK)))
    rows = stash(asked(placed, depth))
    grams, words = rows.filter(F.col("kind") == STRINGS), rows.filter(F.col("kind") == WORDS)
    lengths = code_lengths(grams.groupBy("gram").agg(F.sum("n").alias("n")), depth)
    often = stash(words.groupBy("word").agg(F.sum("n").alias("n")))
    seen = often.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("total"), F.count_if(F.col("n") > 0).alias("distinct")).first()
    value = grams.select("block", "kind", "gram").join(stash(lengths), "gram").select("block", "kind", "gram", F.lit(None).cast("binary").alias("word"), "value")
    count = words.select("block", "kind", "word").join(often, "word").select("block", "kind", F.lit(None).cast("long").alias("gram"), "word", F.col("n").cast("double").alias("value"))
    out = scored(placed, value.unionByName(count), seen["total"], seen["distinct"], depth)
    return out.select("doc_id", held_out(F.col("doc_id"), FOLDS, HELD).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


def op13_context_trees(spark, sf_dir: str) -> DataFrame:
    return language_model_scores(table(spark, sf_dir, "documents"))
