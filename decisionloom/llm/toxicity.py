"""A toxicity classifier: a convolutional network over hashed word embeddings, trained in numpy.

A word (lower case, without outer punctuation) is the sum of two hashed embeddings.  Filters of
several widths run over the words, each filter's largest response over the whole text passes a
rectifier, and a logistic layer follows.  The gradient of a maximum reaches the words of its
window alone.  Every labelled document outside the held-out fold counts: four fifths are fitted, the
rest calibrates a threshold for each language; the language never enters a score.  Words of few
documents are read as padding in training, so that the model doesn't learn single documents by heart.

What is fitted is dealt out to shards of bounded size.  In each round every shard goes on from the
common model by itself, and the models are averaged: an embedding over the shards that hold its
words, by the number of their documents, the rest over all.  They meet in slices, so nothing but one
model reaches the driver.

For scoring, the filters' products with a word are kept by word, so a text costs a table look-up
and a few additions a word; texts are scored whole.

Cases: null and empty texts hold one padding word; labels other than 0 and 1 are not learnt from;
where a class has no document, every score is the share of toxic ones (0 without any label);
repeated documents are scored alike; a language without calibration, or null, gets the default
threshold; other columns are ignored.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from decisionloom.llm.common import by_value, fetched, few, held_out, keyed, release, row_key, stash, table, without

by_value(__name__)

#: Characters of a shard's texts, about, and slices in which the shards' models meet.
SHARD_CHARS, SLICES = 16_000_000, 256
BUCKETS, DIMENSION, WIDTHS, FILTERS = 1 << 17, 8, (1, 2, 3), 8
EPOCHS, RATE, BATCH = 14, 0.02, 32
#: Epochs over many documents: as many as make about so many readings, but no fewer than LEAST_EPOCHS.
READINGS, LEAST_EPOCHS = 120_000, 4
#: Documents that must hold a word for it to be learnt; rarer ones would only mark single documents.
HELD_BY = 4
THRESHOLD, LEAST, MOST = 0.7, 0.5, 0.9
#: Words whose products a worker keeps, and whose buckets training does; beyond it they start anew.
CACHE, WORDS = 150_000, 50_000
PUNCTUATION = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"


def buckets_of(word: str) -> tuple[int, int]:
    plain = (word.lower().strip(PUNCTUATION) or word).encode()
    return zlib.crc32(plain) % BUCKETS, BUCKETS + zlib.crc32(b"\1" + plain) % BUCKETS


def _windows(n: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """First words of all windows in a batch whose documents, padded to the largest width, have n words; and where each document's windows start."""
    ends = np.cumsum(n)
    starts = ends - n
    many = n - width + 1
    first = np.concatenate([np.arange(s, s + m) for s, m in zip(starts, many, strict=True)])
    return first, np.cumsum(many) - many


def fresh(p: float | None = None, seed: int = 5) -> tuple[dict, dict]:
    """A model before training and the sums of its squared gradients; p: its score of everything, where there is nothing to learn."""
    rng = np.random.default_rng(seed)
    F_, D = FILTERS, DIMENSION
    model = {"E": (rng.standard_normal((2 * BUCKETS, D)) * 0.02).astype(np.float32), "b": np.zeros(1, np.float32), "v": np.full(len(WIDTHS) * F_, 0.3, np.float32) * rng.choice([-1, 1], len(WIDTHS) * F_, p=[0.25, 0.75]).astype(np.float32)}
    model["E"][[0, BUCKETS]] = 0
    for w in WIDTHS:
        model[f"W{w}"] = (rng.standard_normal((w, D, F_)) * (0.5 / np.sqrt(w * D))).astype(np.float32)
        model[f"c{w}"] = np.zeros(F_, np.float32)
    if p is not None:
        p = float(np.clip(p, 1e-6, 1 - 1e-6))
        model["v"][:] = 0
        model["b"][:] = np.log(p / (1 - p))
    return model, {k: np.full_like(x, 1e-6) for k, x in model.items()}


def _ready(model: dict) -> dict:
    """A trained model, its last bias a number."""
    model["b"] = model["b"][0]
    return model


def buckets_of_text(text: bytes, known: dict) -> np.ndarray:
    """The two buckets of each word, cut at ASCII white space, as texts are scored; padded to the largest width."""
    ids = []
    for w in map(bytes.decode, text.split()):
        if w not in known:
            if len(known) > WORDS:
                known.clear()
            known[w] = buckets_of(w)
        ids.append(known[w])
    ids += [(0, BUCKETS)] * (max(WIDTHS) - len(ids))
    return np.asarray(ids, dtype=np.int32)


def holders(docs: list[np.ndarray]) -> np.ndarray:
    """How many documents hold a word of each bucket."""
    often = np.zeros(2 * BUCKETS, np.int64)
    for ids in docs:
        often[np.unique(ids)] += 1
    return often


def without_rare(docs: list[np.ndarray], often: np.ndarray) -> list[np.ndarray]:
    """The documents, rare words as padding; by the rarer of a word's two buckets, since few words share both."""
    return [np.where((often[ids].min(1) < HELD_BY)[:, None], np.array([[0, BUCKETS]], np.int32), ids) for ids in docs]


def learn(model: dict, speed: dict, docs: list[np.ndarray], ys: np.ndarray, rng, epochs: int, rate: float = RATE) -> None:
    """Epochs over the documents, in place."""
    F_, D = FILTERS, DIMENSION

    def step(key: str, grad, at=...):
        speed[key][at] += grad * grad
        model[key][at] -= rate * grad / np.sqrt(speed[key][at])

    for _ in range(epochs):
        order = rng.permutation(len(docs))
        for lo in range(0, len(order), BATCH):
            pick = order[lo : lo + BATCH]
            ids = np.concatenate([docs[i] for i in pick])
            n = np.array([len(docs[i]) for i in pick])
            x = model["E"][ids[:, 0]] + model["E"][ids[:, 1]]
            pooled, best = [], []
            for w in WIDTHS:
                first, starts = _windows(n, w)
                a = sum(x[first + j] @ model[f"W{w}"][j] for j in range(w)) + model[f"c{w}"]
                top = np.maximum.reduceat(a, starts)
                ends = np.append(starts[1:], len(first))
                best.append(np.stack([first[s + a[s:e].argmax(0)] for s, e in zip(starts, ends, strict=True)]))
                pooled.append(top)
            h = np.concatenate(pooled, 1)
            r = np.maximum(h, 0)
            p = 1 / (1 + np.exp(-np.clip(r @ model["v"] + model["b"], -30, 30)))
            d = ((p - ys[pick]) / len(pick)).astype(np.float32)
            gh = d[:, None] * model["v"] * (h > 0)
            gx: dict = {}
            grads = {}
            for k, w in enumerate(WIDTHS):
                g = gh[:, k * F_ : (k + 1) * F_]
                gw = np.zeros_like(model[f"W{w}"])
                for j in range(w):
                    at = best[k] + j
                    gw[j] = np.einsum("bfd,bf->df", x[at], g)
                    gx.setdefault("at", []).append(at.ravel())
                    gx.setdefault("g", []).append((g[:, :, None] * model[f"W{w}"][j].T[None]).reshape(-1, D))
                grads[f"W{w}"], grads[f"c{w}"] = gw, g.sum(0)
            at, g = np.concatenate(gx["at"]), np.concatenate(gx["g"])
            for half in (0, 1):
                u, inverse = np.unique(ids[at, half], return_inverse=True)
                total = np.zeros((len(u), D), np.float32)
                np.add.at(total, inverse, g)
                total[(u == 0) | (u == BUCKETS)] = 0
                step("E", total, u)
            for key, grad in grads.items():
                step(key, grad)
            step("v", r.T @ d)
            step("b", d.sum(keepdims=True))


def train(rows: list[tuple], epochs: int = EPOCHS, rate: float = RATE, seed: int = 5) -> dict:
    """rows of (label, text, ...) -> the model's arrays, learnt in one place."""
    ys = np.array([r[0] for r in rows], dtype=np.float32)
    if len(set(ys.tolist())) < 2:
        return _ready(fresh(ys.mean() if len(ys) else 0, seed)[0])
    known: dict = {}
    docs = [buckets_of_text(r[1].encode(), known) for r in rows]
    model, speed = fresh(None, seed)
    learn(model, speed, without_rare(docs, holders(docs)), ys, np.random.default_rng(seed), epochs, rate)
    return _ready(model)


class Scorer:
    """Scores texts; keeps each word's products with all filters."""

    def __init__(self, model: dict):
        self.model, self.known = model, {}
        self.weights = np.concatenate([model[f"W{w}"][j] for w in WIDTHS for j in range(w)], 1)
        self.bias = np.concatenate([model[f"c{w}"] for w in WIDTHS])
        self.table = np.zeros((1024, self.weights.shape[1]), np.float32)

    def rows(self, words: list[bytes]) -> np.ndarray:
        get = self.known.__getitem__
        try:
            return np.fromiter(map(get, words), np.int32, len(words))
        except KeyError:
            pass
        if len(self.known) > CACHE:
            self.known.clear()
        new = [w for w in set(words) if w not in self.known]
        at = len(self.known) + 1
        ids = np.array([buckets_of(w.decode()) for w in new], dtype=np.int32)
        if at + len(new) > len(self.table):
            grown = np.zeros((max(2 * len(self.table), at + len(new)), self.table.shape[1]), np.float32)
            grown[:at] = self.table[:at]
            self.table = grown
        E = self.model["E"]
        self.table[at : at + len(new)] = (E[ids[:, 0]] + E[ids[:, 1]]) @ self.weights
        self.known.update(zip(new, range(at, at + len(new)), strict=True))
        return np.fromiter(map(get, words), np.int32, len(words))

    def __call__(self, text: bytes) -> float:
        ids = self.rows(text.split())
        if len(ids) < max(WIDTHS):
            ids = np.concatenate([ids, np.zeros(max(WIDTHS) - len(ids), np.int32)])
        top = np.full(len(self.bias), -np.inf, np.float32)
        for lo in range(0, len(ids) - max(WIDTHS) + 1, 4096):  # in blocks that overlap, to bound memory
            g, at = self.table[ids[lo : lo + 4096 + max(WIDTHS) - 1]], 0
            for k, w in enumerate(WIDTHS):
                n = len(g) - w + 1
                a = g[:n, at : at + FILTERS]
                for j in range(1, w):
                    a = a + g[j : j + n, at + j * FILTERS : at + (j + 1) * FILTERS]
                at += w * FILTERS
                np.maximum(top[k * FILTERS : (k + 1) * FILTERS], a.max(0), out=top[k * FILTERS : (k + 1) * FILTERS])
        z = np.maximum(top + self.bias, 0) @ self.model["v"] + self.model["b"]
        return float(1 / (1 + np.exp(-np.clip(float(z), -60, 60))))


def _labelled(docs: DataFrame, labels: DataFrame, folds: int, fold: int) -> DataFrame:
    """id, y, text, lang of every labelled document outside the held-out fold; one that is labelled twice counts with its larger label; null ids, labels and texts are left out."""
    own = labels.select(F.col("doc_id").alias("id"), F.col("toxic").cast("int").alias("y")).filter(F.col("id").isNotNull() & F.col("y").isin(0, 1))
    own = own.filter(~held_out(F.col("id"), folds, fold)).groupBy("id").agg(F.max("y").alias("y"))
    texts = docs.select(F.col("doc_id").alias("id"), F.col("text"), F.col("lang").cast("string").alias("lang")).filter(F.col("text").isNotNull())
    return texts.join(few(own), "id").select("id", "y", "text", "lang", F.xxhash64(F.col("id").cast("string")).alias("h"))


def _encoded(rows: DataFrame) -> DataFrame:
    """id, y, text (as bytes), h -> h, key (a hash of the text), y, ids: each text as its words' buckets."""

    def run(batches):
        known: dict = {}
        for batch in batches:
            ids = [buckets_of_text(x.as_py(), known).tobytes() for x in batch.column(3)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(ids, pa.binary())], names=["h", "key", "y", "ids"])

    return rows.select("h", F.xxhash64("text").alias("key"), "y", F.col("text").cast("binary")).mapInArrow(run, "h long, key long, y int, ids binary")


def _shard(table: pa.Table) -> tuple[list[np.ndarray], np.ndarray]:
    table = table.sort_by([("h", "ascending"), ("key", "ascending")])
    return [np.frombuffer(x.as_py(), np.int32).reshape(-1, 2) for x in table["ids"]], table["y"].to_numpy().astype(np.float32)


def _slices(at: np.ndarray) -> list[tuple[int, np.ndarray]]:
    """Sorted buckets -> number of a slice and which of them it holds."""
    edges = np.searchsorted(at, np.arange(SLICES + 1) * (2 * BUCKETS // SLICES))
    return [(k, np.arange(lo, hi)) for k, (lo, hi) in enumerate(zip(edges, edges[1:])) if hi > lo]  # noqa: B905


def _merged(parts: DataFrame) -> list[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """parts(k, shard, at, weight, vector) -> rows (k, at, weight, vector): a slice's vectors, averaged by weight where they stand."""

    def merge(table: pa.Table) -> pa.Table:
        rows = sorted(table.to_pylist(), key=lambda r: r["shard"])
        ats = [np.frombuffer(r["at"], np.int32) for r in rows]
        every = np.unique(np.concatenate(ats))
        weight, total = np.zeros(len(every)), None
        for r, at in zip(rows, ats, strict=True):
            w = np.frombuffer(r["weight"], np.float64)
            x = np.frombuffer(r["vector"], np.float32).reshape(len(at), -1)
            total = np.zeros((len(every), x.shape[1])) if total is None else total
            place = np.searchsorted(every, at)
            weight[place] += w
            total[place] += w[:, None] * x
        mean = (total / weight[:, None]).astype(np.float32)
        return pa.table({"k": pa.array([rows[0]["k"]], pa.int32()), "at": [every.astype(np.int32).tobytes()], "weight": [weight.tobytes()], "vector": [mean.tobytes()]})

    found = fetched(parts.groupBy("k").applyInArrow(merge, "k int, at binary, weight binary, vector binary"))  # one model at most
    columns = [[np.frombuffer(x.as_buffer(), kind) for x in found[c]] for c, kind in (("at", np.int32), ("weight", np.float64), ("vector", np.float32))]
    return list(zip(found["k"].to_pylist(), *columns, strict=True))


PART = "k int, shard long, at binary, weight binary, vector binary"


def _part(rows: list[tuple], shard: int) -> pa.Table:
    """(k, at, weight, vector) as rows of PART."""
    return pa.table({"k": pa.array([r[0] for r in rows], pa.int32()), "shard": pa.array([shard] * len(rows), pa.int64()), "at": [r[1].astype(np.int32).tobytes() for r in rows], "weight": [r[2].astype(np.float64).tobytes() for r in rows], "vector": [r[3].astype(np.float32).tobytes() for r in rows]})


def _held(shards: DataFrame) -> np.ndarray:
    """holders() of all shards."""

    def count(table: pa.Table) -> pa.Table:
        often = holders(_shard(table)[0])
        at = np.flatnonzero(often)
        return _part([(k, at[own], often[at[own]], np.zeros((len(own), 1))) for k, own in _slices(at)], table["shard"][0].as_py())

    often = np.zeros(2 * BUCKETS, np.int64)
    for _, at, weight, _ in _merged(shards.groupBy("shard").applyInArrow(count, PART)):
        often[at] = weight
    return often


def _learnt(model: dict, speed: dict) -> tuple[np.ndarray, dict, dict]:
    """What training has changed: buckets, and both parts with the rows of these alone."""
    at = np.flatnonzero(np.any([m["E"] != own["E"] for m, own in zip((model, speed), fresh(), strict=True)], axis=(0, 2)))
    return at, model | {"E": model["E"][at]}, speed | {"E": speed["E"][at]}


def _restored(at: np.ndarray, *learnt: dict) -> tuple[dict, dict]:
    """Undoes _learnt(); arrays of its own."""
    out = fresh()
    for own, m in zip(out, learnt, strict=True):
        own["E"][at] = m["E"]
        own.update({k: x.copy() for k, x in m.items() if k != "E"})
    return out


def _round(shards: DataFrame, model: dict, speed: dict, often: np.ndarray, turn: int, epochs: int) -> None:
    """Epochs within each shard, then the average of the shards' models, in place."""
    shared = shards.sparkSession.sparkContext.broadcast((_learnt(model, speed), often))  # bounded by the number of buckets
    small = sorted(k for k in model if k != "E")

    def go(table: pa.Table) -> pa.Table:
        learnt, often = shared.value
        model, speed = _restored(*learnt)
        docs, ys = _shard(table)
        docs, shard = without_rare(docs, often), table["shard"][0].as_py()
        learn(model, speed, docs, ys, np.random.default_rng([5, turn, shard]), epochs)
        own = holders(docs)
        at = np.flatnonzero(own)
        both = np.concatenate([model["E"][at], speed["E"][at]], 1)
        dense = np.concatenate([m[k].ravel() for m in (model, speed) for k in small])[None]
        return _part([(k, at[i], own[at[i]], both[i]) for k, i in _slices(at)] + [(-1, np.zeros(1), np.full(1, len(docs)), dense)], shard)

    for k, at, _, x in _merged(shards.groupBy("shard").applyInArrow(go, PART)):
        if k >= 0:
            x = x.reshape(len(at), -1)
            model["E"][at], speed["E"][at] = x[:, :DIMENSION], x[:, DIMENSION:]
            continue
        for m in (model, speed):
            for c in small:
                m[c], x = x[: m[c].size].reshape(m[c].shape).copy(), x[m[c].size :]
    shared.destroy()


def calibrate(model: dict, rows: DataFrame) -> dict[str, float]:
    """rows(id, y, text, lang), not fitted on: for each language the threshold, within bounds, that errs least on them."""
    docs = rows.filter("lang IS NOT NULL").select(F.col("y").alias("doc_id"), "text", "lang")
    grid = np.arange(LEAST, MOST + 1e-9, 0.02)
    wrong = [F.count_if((F.col("score") >= float(t)) != (F.col("doc_id") == 1)) for t in grid]
    out = {}
    for r in scores(docs, model).groupBy("lang").agg(F.array(*wrong).alias("wrong")).collect():  # a row a language
        best = grid[np.array(r["wrong"]) == min(r["wrong"])]
        out[r["lang"]] = float(best[np.abs(best - THRESHOLD).argmin()])
    return out


def fit(docs: DataFrame, labels: DataFrame, folds: int = 3, fold: int = 1) -> tuple[dict, dict[str, float]]:
    """The model, fitted on four fifths of all labelled documents, and the languages' thresholds from the rest."""
    rows = stash(_labelled(docs, labels, folds, fold))
    fitted, rest = rows.filter("pmod(h, 5) > 0"), rows.filter("pmod(h, 5) = 0")
    size = fitted.agg(F.count("*").alias("n"), F.coalesce(F.sum("y"), F.lit(0)).alias("toxic"), F.coalesce(F.sum(F.length("text")), F.lit(0)).alias("chars")).first()
    if size["toxic"] in (0, size["n"]):
        model = fresh(size["toxic"] / max(size["n"], 1))[0]
    else:
        many = -(-size["chars"] // SHARD_CHARS)
        dealt = stash(_encoded(fitted).withColumn("shard", F.pmod(F.expr("h div 5"), F.lit(many))))
        shards = dealt.repartition(4 * many, "shard").persist(StorageLevel.DISK_ONLY)  # so many parts that few shards share one
        model, speed = fresh()
        often = _held(shards)
        epochs = min(EPOCHS, max(LEAST_EPOCHS, -(-READINGS // size["n"])))
        for turn in range(epochs if many > 1 else 1):
            _round(shards, model, speed, often, turn, 1 if many > 1 else epochs)
        shards.unpersist()
        release(dealt)
    thresholds = calibrate(_ready(model), rest)
    release(rows)
    return model, thresholds


def scores(docs: DataFrame, model: dict) -> DataFrame:
    """docs(doc_id, text, lang) -> doc_id, did and raw (the row's key), lang, score, for every whole text."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # bounded by the number of buckets

    def run(batches):
        score = Scorer(shared.value)
        for batch in batches:
            got = [score(x.as_py() or b"") for x in batch.column(4)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:4], pa.array(got, pa.float64())], names=["doc_id", "did", "raw", "lang", "score"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    rows = docs.select(F.col("doc_id"), *row_key(docs), F.col("lang").cast("string"), F.col("text").cast("binary"))
    return rows.mapInArrow(run, f"doc_id {kind}, did long, raw long, lang string, score double")


def threshold_for(lang, thresholds: dict[str, float]):
    out = F.lit(THRESHOLD)
    for k, t in sorted(thresholds.items()):
        out = F.when(lang == k, F.lit(t)).otherwise(out)
    return out


def classify(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """docs(doc_id, text, lang), labels(doc_id, toxic) -> doc_id, held_out, score, predicted, lang_threshold, lang_toxic."""
    model, thresholds = fit(docs, labels)
    own = threshold_for(F.col("lang"), thresholds)
    return stash(scores(docs, model)).select("doc_id", held_out(F.col("doc_id"), 3, 1).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"), own.alias("lang_threshold"), (F.col("score") >= own).cast("int").alias("lang_toxic"))


def keep_clean(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """docs without those whose score reaches their language's threshold; only keys and texts pass through Python."""
    model, thresholds = fit(docs, labels)
    found = scores(docs, model).filter(F.col("score") >= threshold_for(F.col("lang"), thresholds))
    toxic = stash(found.select("did", "raw", F.coalesce("lang", F.lit("")).alias("lang")).distinct())
    rows = keyed(docs).withColumn("lang", F.coalesce(F.col("doc.lang").cast("string"), F.lit("")))
    return without(rows, toxic, "lang").select("doc.*")


def op10_toxicity(spark, sf_dir: str) -> DataFrame:
    return classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
