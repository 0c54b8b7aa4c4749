"""Near-duplicate documents by MinHash with sequential Bayesian verification.

Documents of one word sequence are one node.  Nodes get MinHash signatures, cut into bands;
nodes of an equal band are candidates.  The signatures of a candidate pair are compared batch by
batch: the pair is dropped as soon as the posterior probability (uniform prior) that its
similarity reaches the threshold falls below the chosen miss probability.  Survivors are
confirmed on their full shingle sets.

A bucket of m nodes is never expanded into its m * m pairs.  First all its nodes are compared
with its least one.  Where a bucket's nodes then lie in several components, its nodes are compared
across them in blocks inside tasks, and a pair that a task's links have joined already is skipped;
so a bucket needs no cap, and no link that would join two components is lost.

Cases: null texts and texts without words have no shingles and link with nothing; a null id is a
node like others, its component is the least id in it (null if there is none); repeated rows share
their component; ids that repeat with other texts are linked by text; other columns are ignored.
"""

from __future__ import annotations

from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from decisionloom.llm.common import by_value, few, keyed, release, row_key, settled, stash, table, without
from decisionloom.llm.graph import components

by_value(__name__)

SHINGLE, PERCENT = 5, 85
#: 24 bands of 5 find a pair at a threshold of 85 % with a probability of 1 - 1e-6; lower ones take more bands of fewer rows.
BANDS, ROWS, HASHES, BATCH, MISS, UNBANDED = 24, 5, 128, 32, 1e-5, 1e-6
#: Words whose hashes a worker keeps; beyond it starts anew.
CACHE = 150_000
#: Nodes of a bucket that one task compares with as many others.
BLOCK = 256
#: Partners of a node that one task confirms.
GROUP = 1000

_M1, _M2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * _M1
    x = (x ^ (x >> np.uint64(29))) * _M2
    return x ^ (x >> np.uint64(32))


class Shingles:
    """Distinct 64-bit hashes of a text's shingles, and a digest of its words."""

    def __init__(self, width: int = SHINGLE):
        from hashlib import blake2b

        self.width, self.known, self.digest = width, {}, blake2b

    def words(self, text: bytes | None) -> list[bytes]:
        return (text or b"").lower().split()  # bytes: A-Z alone, and ASCII white space

    def sequence(self, words: list[bytes]) -> bytes:
        return self.digest(b" ".join(words), digest_size=16).digest()

    def hashes(self, words: list[bytes]) -> np.ndarray:
        if not words:
            return np.zeros(0, np.uint64)
        get = self.known.__getitem__
        try:
            h = np.fromiter(map(get, words), np.uint64, len(words))
        except KeyError:
            if len(self.known) > CACHE:
                self.known.clear()
            for w in set(words):
                if w not in self.known:
                    self.known[w] = int.from_bytes(self.digest(w, digest_size=8).digest(), "little")
            h = np.fromiter(map(get, words), np.uint64, len(words))
        k = min(self.width, len(h))
        out = np.zeros(len(h) - k + 1, np.uint64)
        for j in range(k):
            out = _mixed(out + h[j : j + len(out)] + np.uint64(j + 1))
        return np.unique(out + np.uint64(k))


def permutations(n: int) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(20240229)
    return rng.integers(0, 1 << 31, n).astype(np.uint32) * np.uint32(2) + np.uint32(1), rng.integers(0, 1 << 32, n, dtype=np.uint64).astype(np.uint32)


def signature(hashes: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    low, best = (hashes >> np.uint64(32)).astype(np.uint32), np.full(len(a), 0xFFFFFFFF, np.uint32)
    for lo in range(0, len(low), 2048):
        part = low[lo : lo + 2048]
        np.minimum(best, (part[None, :] * a[:, None] + b[:, None]).min(1), out=best)
    return best


def least_matches(percent: int = PERCENT, hashes: int = HASHES, batch: int = BATCH, miss: float = MISS) -> list[int]:
    """For each number of compared hashes, the fewest matches at which the pair isn't pruned.

    With a uniform prior, P(similarity >= t | m of n) is the binomial tail P(X <= m), X ~ B(n + 1, t).
    """
    t, out = percent / 100, []
    for n in range(batch, hashes + 1, batch):
        tail, m = 0.0, 0
        while m <= n:
            tail += comb(n + 1, m) * t**m * (1 - t) ** (n + 1 - m)
            if tail >= miss:
                break
            m += 1
        out.append(m)
    return out


def survive(x: np.ndarray, y: np.ndarray, least: list[int], batch: int = BATCH) -> tuple[np.ndarray, np.ndarray]:
    """Rows of signatures x and y compared in turn -> indices of the surviving rows, and their matches."""
    alive, matches = np.arange(len(x)), np.zeros(len(x), np.int64)
    for k, m in enumerate(least):
        cut = slice(k * batch, (k + 1) * batch)
        matches[alive] += (x[alive, cut] == y[alive, cut]).sum(1)
        alive = alive[matches[alive] >= m]
    return alive, matches[alive]


def alike(x: np.ndarray, y: np.ndarray, percent: int) -> bool:
    """Whether two sorted sets reach the threshold."""
    small, large = (x, y) if len(x) <= len(y) else (y, x)
    if 100 * len(small) < percent * len(large):
        return False
    at = np.searchsorted(large, small)
    both = int((large[np.minimum(at, len(large) - 1)] == small).sum())
    return 100 * both >= percent * (len(x) + len(y) - both)


def signed(docs: DataFrame) -> DataFrame:
    """docs(doc_id, text) -> doc_id, did and raw (the row's key), node (digest of the words, null without any), n_shingles, signature."""

    def run(batches):
        s, (a, b) = Shingles(), permutations(HASHES)
        for batch in batches:
            nodes, counts, signatures = [], [], []
            for text in batch.column(3):
                words = s.words(text.as_py())
                h = s.hashes(words)
                nodes.append(s.sequence(words) if words else None)
                counts.append(len(h))
                signatures.append(signature(h, a, b).tobytes() if words else None)
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(nodes, pa.binary()), pa.array(counts, pa.int64()), pa.array(signatures, pa.binary())], names=["doc_id", "did", "raw", "node", "n_shingles", "signature"])

    return docs.select(F.col("doc_id").cast("long"), *row_key(docs), F.col("text").cast("binary")).mapInArrow(run, "doc_id long, did long, raw long, node binary, n_shingles long, signature binary")


def bands_for(percent: int) -> tuple[int, int]:
    """How many bands of how many rows share none at the threshold with a probability of UNBANDED at most."""
    bands, rows = BANDS, ROWS
    while rows > 1 and (1 - (percent / 100) ** rows) ** bands > UNBANDED:
        rows -= 1
        bands = HASHES // rows
    return bands, rows


def _banded(nodes: DataFrame, percent: int) -> DataFrame:
    """A row per node and band."""
    bands, rows = bands_for(percent)
    width = 4 * rows
    keys = F.transform(F.sequence(F.lit(0), F.lit(bands - 1)), lambda i: F.xxhash64(i, F.substring("signature", i * width + 1, F.lit(width))))
    return nodes.select("node", F.explode(keys).alias("band"))


def _posterior(pairs: DataFrame, nodes: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) that the sequential comparison of their signatures leaves."""
    sigs = nodes.select("node", "signature")
    rows = few(pairs).join(sigs.select(F.col("node").alias("b"), F.col("signature").alias("y")), "b").join(sigs.select(F.col("node").alias("a"), F.col("signature").alias("x")), "a").select("a", "b", "x", "y")
    least = least_matches(percent)

    def run(batches):
        for batch in batches:
            if batch.num_rows:
                x, y = (np.frombuffer(b"".join(batch.column(i).to_pylist()), np.uint32).reshape(-1, HASHES) for i in (2, 3))
                alive, _ = survive(x, y, least)
                yield batch.select([0, 1]).take(pa.array(alive))

    return rows.mapInArrow(run, "a binary, b binary")


def _sets(docs: DataFrame, needed: DataFrame) -> DataFrame:
    """The shingle sets of the needed nodes (node, and did and raw of one of its documents): node, hashes."""

    def run(batches):
        s = Shingles()
        for batch in batches:
            nodes, sets = [], []
            for node, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                words = s.words(text.as_py())
                if words and s.sequence(words) == node:
                    nodes.append(node)
                    sets.append(s.hashes(words).tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(nodes, pa.binary()), pa.array(sets, pa.binary())], names=["node", "hashes"])

    texts = docs.select(*row_key(docs), F.col("text").cast("binary").alias("_text"))
    found = needed.join(texts, ["did", "raw"]).select("node", "_text").mapInArrow(run, "node binary, hashes binary")
    return stash(found.dropDuplicates(["node"]))


def _confirmed(pairs: DataFrame, sets: DataFrame, percent: int = PERCENT) -> DataFrame:
    """Pairs (a, b) whose full sets reach the threshold.

    The partners of a node stream past its set in groups of bounded size, so it travels once a group.
    """
    counts = pairs.groupBy("a").agg(F.count("*").alias("n")).withColumn("groups", F.ceil(F.col("n") / GROUP).cast("int"))
    heads = counts.withColumn("salt", F.explode(F.sequence(F.lit(0), F.col("groups") - 1))).select("a", "salt", F.col("a").alias("node"))
    tails = pairs.join(counts.select("a", "groups"), "a").select("a", F.pmod(F.xxhash64("b"), F.col("groups")).cast("int").alias("salt"), F.col("b").alias("node"))
    rows = few(stash(heads.withColumn("tail", F.lit(0)).unionByName(tails.withColumn("tail", F.lit(1))))).join(sets, "node")
    rows = rows.select("a", "salt", "tail", "node", "hashes").repartition("a", "salt").sortWithinPartitions("a", "salt", "tail")

    def run(batches):
        head, own = None, None
        for batch in batches:
            out = []
            for a, salt, tail, node, hashes in zip(*(batch.column(i) for i in range(5)), strict=True):
                h = np.frombuffer(hashes.as_py(), np.uint64)
                key = (a.as_py(), salt.as_py())
                if not tail.as_py():
                    head, own = key, h
                elif key == head:
                    if alike(own, h, percent):
                        out.append((key[0], node.as_py()))
            cols = list(zip(*out, strict=True)) or [[], []]
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.binary()) for c in cols], names=["a", "b"])

    return rows.mapInArrow(run, "a binary, b binary")


def _across(members: DataFrame, percent: int) -> DataFrame:
    """members(band, node, component, signature, hashes) -> links (a, b) between components that share a band.

    A band's nodes are cut into blocks by hash; a task compares two blocks, and skips pairs that
    its own links have joined already, so it returns fewer links than it has nodes.
    """
    sizes = members.groupBy("band").agg(F.count("*").alias("n")).withColumn("blocks", F.ceil(F.col("n") / BLOCK).cast("int"))
    placed = members.join(sizes, "band").withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    both = F.transform(F.sequence(F.lit(0), F.col("blocks") - 1), lambda o: F.struct(F.least(o, F.col("block")).alias("i"), F.greatest(o, F.col("block")).alias("j")))
    rows = placed.withColumn("pair", F.explode(both)).select("band", "pair.i", "pair.j", "block", "node", "component", "signature", "hashes").repartition("band", "i", "j").sortWithinPartitions("band", "i", "j")
    least = least_matches(percent)

    def compare(i, j, rows):
        block, node, comp, sig, hashes = zip(*rows, strict=True)
        x = np.frombuffer(b"".join(sig), np.uint32).reshape(-1, HASHES)
        sets = [np.frombuffer(h, np.uint64) for h in hashes]
        codes: dict = {}
        label = np.array([codes.setdefault(c, len(codes)) for c in comp])
        block = np.array(block)
        left, right = np.flatnonzero(block == i), np.flatnonzero(block == j)
        for u in left:
            v = right[label[right] != label[u]]
            v = v[v > u] if i == j else v
            if not len(v):
                continue
            alive, matches = survive(np.broadcast_to(x[u], (len(v), HASHES)), x[v], least)
            for w in v[alive[np.argsort(-matches, kind="stable")]]:
                if label[w] != label[u] and alike(sets[u], sets[w], percent):
                    label[label == label[w]] = label[u]
                    yield min(node[u], node[w]), max(node[u], node[w])

    def run(batches):
        key, rows = None, []

        def done():
            cols = list(zip(*compare(key[1], key[2], rows), strict=True)) or [[], []]
            return pa.RecordBatch.from_arrays([pa.array(c, pa.binary()) for c in cols], names=["a", "b"])

        for batch in batches:
            for band, i, j, *rest in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if (band, i, j) != key:
                    if len(rows) > 1:
                        yield done()
                    key, rows = (band, i, j), []
                rows.append(tuple(rest))
        if len(rows) > 1:
            yield done()

    return rows.mapInArrow(run, "a binary, b binary").distinct()


def near_duplicates(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """docs(doc_id, text) -> a row per document: doc_id, did and raw (the row's key), node, n_shingles, component_id, kept."""
    return settled(lambda: _near_duplicates(docs, percent))


def _near_duplicates(docs: DataFrame, percent: int) -> DataFrame:
    rows = stash(signed(docs))
    one = F.min(F.struct("did", "raw"))
    nodes = rows.filter(F.col("node").isNotNull()).groupBy("node").agg(one.alias("one"), F.min("doc_id").alias("first"), F.first("signature").alias("signature"))
    nodes = stash(nodes.select("node", "one.did", "one.raw", "first", "signature"))
    narrow = stash(rows.select("doc_id", "did", "raw", "node", "n_shingles"))
    release(rows)  # the signatures, of which one a node stays
    bands = _banded(nodes, percent)
    hubs = bands.groupBy("band").agg(F.min("node").alias("hub"), F.count("*").alias("n")).filter("n > 1").select("band", "hub")
    members = stash(bands.join(hubs, "band").select("band", "node", "hub"))
    involved = members.select("node").distinct().join(nodes.select("node", "did", "raw"), "node")
    sets = _sets(docs, involved)
    first = members.filter("node <> hub").select(F.col("hub").alias("a"), F.col("node").alias("b")).distinct()
    pairs = stash(_posterior(stash(first), nodes, percent))
    links = stash(_confirmed(pairs, sets, percent))
    found = stash(components(links))
    placed = members.join(few(found), "node", "left").select("band", "node", F.coalesce("component", "node").alias("component"))
    open_ = placed.groupBy("band").agg(F.min("component").alias("lo"), F.max("component").alias("hi")).filter("lo < hi").select("band")
    unresolved = stash(placed.join(few(stash(open_)), "band"))
    contents = few(stash(unresolved.select("node").distinct())).join(nodes.select("node", "signature"), "node").join(sets, "node")
    links = stash(links.unionByName(_across(unresolved.join(contents, "node"), percent)))
    whole = components(links)
    labelled = nodes.select("node", "first").join(few(whole), "node", "left").select("node", "first", F.coalesce("component", "node").alias("component"))
    least = labelled.groupBy("component").agg(F.min("first").alias("component_id"))
    ids = labelled.join(least, "component").select("node", "component_id")
    out = narrow.join(ids, "node", "left")
    component = F.when(F.col("node").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    return out.select("doc_id", "did", "raw", "node", "n_shingles", component.alias("component_id"), component.eqNullSafe(F.col("doc_id")).alias("kept"))


def keep_one(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """docs with one document of each group: that of the least id, if this id repeats that of the least text hash, and one row of it.  Documents without words all stay.

    Only keys of rows decide: rows to be dropped go by an anti join, and rows are compared whole only where a key of a kept one repeats.
    """
    groups = near_duplicates(docs, percent)
    worded = groups.filter(F.col("node").isNotNull())
    chosen = worded.filter("kept").groupBy("did").agg(F.min("raw").alias("best"))
    chosen = stash(chosen)
    marked = worded.join(few(chosen), "did", "left")
    lost = stash(marked.filter(~F.col("kept") | (F.col("raw") != F.col("best"))).select("did", "raw").distinct())
    again = stash(worded.filter("kept").groupBy("did", "raw").agg(F.count("*").alias("n")).filter("n > 1").select("did", "raw").join(few(lost), ["did", "raw"], "left_anti"))
    release(groups, chosen)
    rows = keyed(docs)
    single = without(rows, lost.unionByName(again)).select("doc.*")
    repeated = rows.join(few(again), ["did", "raw"]).dropDuplicates(["did", "raw"]).select("doc.*")
    return single.unionByName(repeated)


def op8_minhash_neardup(spark, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id", "kept")
