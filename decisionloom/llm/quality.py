"""A quality classifier of supervised subword embeddings.

Each word stands for one hashed vector of its own and for those of its character n-grams; a word
that follows itself is read as a mark of repetition, a word like others.  A document is the mean of
all its vectors, a softmax layer over two classes follows, and all of it is trained by stochastic
gradient descent in numpy on a bounded sample of labelled documents.
Since the model is linear in the mean, a word adds one number and one count to its document, and
workers keep these by word; texts are scored whole.

Cases: null and empty texts get the score of an all-zero mean; labels other than 0 and 1 are not
learnt from; where one class or both have no document, every score is the share of label 1 (0.5
without any label); repeated documents are scored alike; other columns are ignored.
"""

from __future__ import annotations

from collections import Counter
from itertools import islice
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from decisionloom.llm.common import by_value, held_out, labelled_sample, stash, table

by_value(__name__)

#: Bounds of the sample that is fitted, by label.
PER_CLASS = {0: 2000, 1: 4000}
BUCKETS, DIMENSION, GRAMS = 1 << 16, 16, (3, 4)
EPOCHS, RATE = 4, 2.0
#: What a word that follows itself is read as: no text holds such a word.
AGAIN = "\x01 again"
#: Words whose sums a worker keeps; beyond it starts anew.
CACHE = 300_000


_M1, _M2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)


def _bucket(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * _M1
    h = (h ^ (h >> np.uint64(29))) * _M2
    return ((h ^ (h >> np.uint64(32))) % np.uint64(BUCKETS)).astype(np.int64)


def features(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of words and of their character n-grams, these in a half of their own, and which of the words each belongs to."""
    padded = [f"<{w}>" for w in words]
    codes = np.frombuffer("".join(padded).encode("utf-32-le"), np.uint32).astype(np.uint64)
    size = np.fromiter(map(len, padded), np.int64, len(padded))
    ends = np.cumsum(size)
    owner = np.repeat(np.arange(len(words)), size)
    left = ends[owner] - np.arange(len(codes))
    place = (size[owner] - left).astype(np.uint64)
    whole = np.add.reduceat((codes + np.uint64(1)) * _mixed(place), ends - size) if len(words) else codes
    buckets, owners = [_bucket(whole)], [np.arange(len(words))]
    for n in GRAMS:
        at = np.flatnonzero(left >= n)
        h = np.full(len(at), n, np.uint64)
        for j in range(n):
            h = (h ^ codes[at + j]) * _M1
            h ^= h >> np.uint64(29)
        buckets.append(BUCKETS + _bucket(h))
        owners.append(owner[at])
    return np.concatenate(buckets), np.concatenate(owners)


def _mixed(place: np.ndarray) -> np.ndarray:
    """An odd factor for each place of a letter in its word."""
    x = (place + np.uint64(1)) * _M2
    return (x ^ (x >> np.uint64(32))) | np.uint64(1)


def repeated(words: list) -> list:
    """The words that follow themselves."""
    if not any(map(eq, words, islice(words, 1, None))):
        return []
    return [w for w, last in zip(islice(words, 1, None), words) if w == last]


def tokens(words: list[str]) -> list[str]:
    """Words as they are read."""
    return words[:1] + [AGAIN if w == last else w for w, last in zip(islice(words, 1, None), words)]


def train(rows: list[tuple[int, str]], epochs: int = EPOCHS, rate: float = RATE, seed: int = 11) -> dict:
    """rows of (label, text) -> vectors, output layer and bias."""
    ys = np.array([y for y, _ in rows])
    if len(set(ys.tolist())) < 2:
        p = float(np.clip(ys.mean(), 1e-3, 1 - 1e-3)) if len(ys) else 0.5
        return {"vectors": np.zeros((2 * BUCKETS, 1), np.float32), "out": np.zeros((1, 2), np.float32), "bias": np.array([0.0, np.log(p / (1 - p))], np.float32)}
    rng = np.random.default_rng(seed)
    docs = []
    for _, text in rows:
        counts = Counter(tokens([w.decode() for w in text.encode().split()]))  # at ASCII white space, as texts are scored
        buckets, owner = features(list(counts))
        ids, which = np.unique(buckets, return_inverse=True)
        n = np.bincount(which, np.fromiter(counts.values(), np.float64, len(counts))[owner], len(ids))
        docs.append((ids, (n / max(1, n.sum())).astype(np.float32)))
    vectors = rng.uniform(-1 / DIMENSION, 1 / DIMENSION, (2 * BUCKETS, DIMENSION)).astype(np.float32)
    out, bias = np.zeros((DIMENSION, 2), np.float32), np.zeros(2, np.float32)
    steps, done = epochs * len(docs), 0
    for _ in range(epochs):
        for i in rng.permutation(len(docs)):
            ids, weight = docs[i]
            lr = rate * (1 - done / steps)
            done += 1
            mean = weight @ vectors[ids] if len(ids) else np.zeros(DIMENSION, np.float32)
            z = mean @ out + bias
            p = np.exp(z - z.max())
            p /= p.sum()
            p[ys[i]] -= 1
            back = out @ p
            out -= lr * 0.1 * np.outer(mean, p)
            bias -= lr * 0.02 * p
            if len(ids):
                vectors[ids] -= (lr * 10 * weight)[:, None] * back
    return {"vectors": vectors, "out": out, "bias": bias}


def scores(docs: DataFrame, model: dict) -> DataFrame:
    """docs(doc_id, text) -> doc_id, score: the softmax output of label 1."""
    along = (model["vectors"] @ (model["out"][:, 1] - model["out"][:, 0])).astype(np.float64)
    shared = docs.sparkSession.sparkContext.broadcast((along, float(model["bias"][1] - model["bias"][0])))  # a number per bucket

    def run(batches):
        along, bias = shared.value
        known: dict[bytes, complex] = {}
        get = known.__getitem__

        def learn(words: list[bytes]) -> None:
            buckets, owner = features([w.decode() for w in words])
            total, n = np.bincount(owner, along[buckets], len(words)), np.bincount(owner, minlength=len(words))
            known.update(zip(words, (total + 1j * n).tolist(), strict=True))

        learn([AGAIN.encode()])
        again = known.pop(AGAIN.encode())

        def one(text: bytes | None) -> float:
            words = (text or b"").split()
            try:
                total = sum(map(get, words), 0j)
            except KeyError:
                if len(known) > CACHE:
                    known.clear()
                learn([w for w in set(words) if w not in known])
                total = sum(map(get, words), 0j)
            twice = repeated(words)
            if twice:
                total += len(twice) * again - sum(map(get, twice), 0j)
            z = (total.real / total.imag if words else 0.0) + bias
            return float(1 / (1 + np.exp(-np.clip(z, -60, 60))))

        for batch in batches:
            score = [one(x.as_py()) for x in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(score, pa.float64())], names=["doc_id", "score"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", F.col("text").cast("binary")).mapInArrow(run, f"doc_id {kind}, score double")


def classify(docs: DataFrame, labels: DataFrame, folds: int = 5, fold: int = 0, threshold: float = 0.3) -> DataFrame:
    """docs(doc_id, text), labels(doc_id, quality) -> doc_id, held_out, score, predicted."""
    model = train(labelled_sample(docs, labels, "quality", folds, fold, PER_CLASS))
    out = stash(scores(docs, model))
    return out.select("doc_id", held_out(F.col("doc_id"), folds, fold).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))


def op6_quality_classifier(spark, sf_dir: str) -> DataFrame:
    return classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
