"""Approximate nearest neighbours: a hierarchical navigable small world per shard.

Vectors are dealt into shards of bounded size.  Each task builds its shard's graph by insertion: a
node draws a level, descends greedily from the entry to that level, finds its neighbours on each
level below by a search with a beam in the graph so far, keeps a diverse choice of them, and is
linked back.  Nodes are inserted in batches that grow with the graph, and all searches of a batch
take their steps side by side.  Lists are flat integer arrays, stored in slices.  Largest inner
product becomes nearest direction by one more component, which gives all vectors of a shard one
length.  Queries meet each shard once, in blocks, and the shards' results are merged.

Recall is audited by each run: a sample of queries is compared with all vectors, and the beam is
doubled until the wanted share of the nearest is found (in the end it holds a whole shard).  The
measured recall is returned with the rows.

Equal vectors are one node; the least ids of each, as many as a result can hold, come back at the
end, so copies crowd nothing out.  Scores are sums in the order of the components, in double precision.

Cases: vectors that are null, empty or zero, or hold null or non-finite components, take no part,
neither as queries; vectors of different lengths don't meet; null ids take no part; an id that
repeats with other vectors is searched and found as each; a query with fewer candidates gets them all;
an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from decisionloom.llm.common import by_value, release, stash, table
from decisionloom.llm.vectors import usable

by_value(__name__)

#: Links that a node chooses on a level, room of its list there (twice as much on the lowest) and what a full list is cut to.
LINKS, ROOM, CUT = 16, 24, 16
#: Beams of insertion and search, nodes that a search expands at a time, and nodes inserted at a time at most.
BUILD_BEAM, BEAM, STEP, BATCH = 64, 160, 4, 1024
#: Vectors of a shard: a 64th of all, but this many at least, and no more than fit these bytes in single precision.
SHARD, SHARDS, SHARD_BYTES = 16_384, 64, 96 << 20
#: Nodes of a row of the stored index, and queries that meet a shard at a time.
SLICE, QUERIES = 4096, 16_384
#: Marks of seen nodes that one search holds.
SEEN = 32 << 20
#: Queries of an audit, and the share of their nearest that must be found.
AUDIT, RECALL = 200, 0.95


def shard_size(n: int, width: int) -> int:
    return max(1, min(max(SHARD, -(-n // SHARDS)), SHARD_BYTES // (4 * max(1, width))))


def diverse(own: np.ndarray, near: np.ndarray, x: np.ndarray, most: int) -> np.ndarray:
    """Of each row of near (nodes, nearest first, -1 where none; own: their products with the row's node), those nearer to the node than to any chosen one, then the nearest of the rest: most at most, -1 where none."""
    n, c = near.shape
    there = near >= 0
    v = x[np.maximum(near, 0)]
    among = v @ v.transpose(0, 2, 1)
    free, chosen, count = there.copy(), np.zeros((n, c), bool), np.zeros(n, np.int64)
    for i in range(c):
        take = free[:, i] & (count < most)
        chosen[:, i] = take
        count += take
        free &= ~(take[:, None] & (among[:, i, :] >= own))
    order = np.argsort(np.where(chosen, 0, np.where(there, 1, 2)), axis=1, kind="stable")[:, :most]
    return np.take_along_axis(near, order, 1)


class Graph:
    """A shard: ids, vectors, one flat neighbour array (-1 where none) per level, and the entry node."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, levels: list[np.ndarray] | None = None, entry: int = 0):
        self.ids, self.vectors, self.entry = ids, vectors, entry
        norms = (vectors * vectors).sum(1)
        extra = np.sqrt(np.maximum(norms.max() - norms, 0)) if len(norms) else norms
        self.x = np.concatenate([vectors, extra[:, None]], 1).astype(np.float32)
        self.levels = levels if levels is not None else self.build()

    def build(self) -> list[np.ndarray]:
        n, rng = len(self.ids), np.random.default_rng(7)
        level = np.minimum((-np.log(rng.random(n) + 1e-12) / np.log(LINKS)).astype(int), 6)
        self.levels = [np.full((n, ROOM * 2 if k == 0 else ROOM), -1, np.int32) for k in range(int(level.max(initial=0)) + 1)]
        order = rng.permutation(n)
        self.entry, done = int(order[0]) if n else 0, 1
        while done < n:
            batch = order[done : done + min(BATCH, max(1, done // 4))]
            self._insert(batch, level[batch], int(level[self.entry]))
            highest = int(batch[level[batch].argmax()])
            if level[highest] > level[self.entry]:
                self.entry = highest
            done += len(batch)
        return self.levels

    def _insert(self, batch: np.ndarray, level: np.ndarray, top: int) -> None:
        q = self.x[batch]
        at = np.full(len(batch), self.entry)
        for k in range(max(top, int(level.max())), -1, -1):
            here = level >= k
            if k > top:
                near = np.full((int(here.sum()), 1), -1, np.int32)
                sims = np.full(near.shape, -np.inf, np.float32)
            else:
                if (~here).any():
                    at[~here] = self._greedy(q[~here], at[~here], k)
                if not here.any():
                    continue
                near, sims = self._beam(q[here], at[here], k, BUILD_BEAM)
                at[here] = near[:, 0]
            near, sims = self._with_batch(batch[here], near, sims)
            mine = diverse(sims, near, self.x, LINKS)
            self.levels[k][batch[here], : mine.shape[1]] = mine
            self._link_back(batch[here], mine, k)

    def _with_batch(self, nodes: np.ndarray, near: np.ndarray, sims: np.ndarray):
        """The nodes found, together with the nearest of the batch itself."""
        own = self.x[nodes] @ self.x[nodes].T
        np.fill_diagonal(own, -np.inf)
        k = min(LINKS, len(nodes) - 1)
        if k < 1:
            return near, sims
        best = np.argpartition(-own, k - 1, axis=1)[:, :k]
        near = np.concatenate([near, nodes[best].astype(np.int32)], 1)
        sims = np.concatenate([sims, np.take_along_axis(own, best, 1)], 1)
        order = np.argsort(-sims, axis=1, kind="stable")[:, :BUILD_BEAM]
        return np.take_along_axis(near, order, 1), np.take_along_axis(sims, order, 1)

    def _link_back(self, nodes: np.ndarray, lists: np.ndarray, k: int) -> None:
        flat, x = self.levels[k], self.x
        r, c = np.nonzero(lists >= 0)
        source, target = nodes[r], lists[r, c]
        fresh = ~(flat[target] == source[:, None]).any(1)
        source, target = source[fresh], target[fresh]
        order = np.lexsort((-(x[source] * x[target]).sum(1), target))
        source, target = source[order], target[order]
        rank = np.arange(len(target)) - np.searchsorted(target, target)
        room = flat.shape[1]
        held = (flat[target] >= 0).sum(1)
        fits = held + rank < room
        flat[target[fits], (held + rank)[fits]] = source[fits]
        full = np.unique(target[~fits])
        cut = CUT * (2 if k == 0 else 1)
        for lo in range(0, len(full), 512):
            part = full[lo : lo + 512]
            where = (~fits) & (rank - (room - held) < cut) & np.isin(target, part)
            more = np.full((len(part), cut), -1, np.int32)
            row = np.searchsorted(part, target[where])
            more[row, (rank - (room - held))[where]] = source[where]
            near = np.concatenate([flat[part], more], 1)
            sims = np.einsum("nd,ncd->nc", x[part], x[np.maximum(near, 0)])
            sims[near < 0] = -np.inf
            by = np.argsort(-sims, axis=1, kind="stable")
            kept = diverse(np.take_along_axis(sims, by, 1), np.take_along_axis(near, by, 1), x, cut)
            flat[part] = -1
            flat[part, : kept.shape[1]] = kept

    def _greedy(self, q: np.ndarray, at: np.ndarray, k: int) -> np.ndarray:
        """For each query the node of level k from which no neighbour is nearer."""
        flat, x, at = self.levels[k], self.x, at.copy()
        best, moving = (x[at] * q).sum(1), np.arange(len(q))
        while len(moving):
            near = flat[at[moving]]
            sims = np.einsum("nd,ncd->nc", q[moving], x[np.maximum(near, 0)])
            sims[near < 0] = -np.inf
            i = sims.argmax(1)
            top = np.take_along_axis(sims, i[:, None], 1)[:, 0]
            better = top > best[moving]
            at[moving[better]] = np.take_along_axis(near, i[:, None], 1)[better, 0]
            best[moving[better]] = top[better]
            moving = moving[better]
        return at

    def _beam(self, q: np.ndarray, at: np.ndarray, k: int, beam: int) -> tuple[np.ndarray, np.ndarray]:
        """For each query the nearest nodes found from its start on level k, nearest first (-1 where fewer), and their products."""
        flat, x, n = self.levels[k], self.x, len(self.x)
        m, step, fits = len(q), min(STEP, beam), max(1, SEEN // max(1, n))
        if m > fits:
            parts = [self._beam(q[lo : lo + fits], at[lo : lo + fits], k, beam) for lo in range(0, m, fits)]
            return np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts])
        seen = np.zeros((m, n), bool)
        seen[np.arange(m), at] = True
        nodes, sims, open_ = np.full((m, beam), -1, np.int32), np.full((m, beam), -np.inf, np.float32), np.zeros((m, beam), bool)
        nodes[:, 0], sims[:, 0], open_[:, 0] = at, (x[at] * q).sum(1), True
        active = np.arange(m)
        while len(active):
            o = open_[active]
            pick = np.argsort(~o, axis=1, kind="stable")[:, :step]
            taken = np.take_along_axis(o, pick, 1)
            np.put_along_axis(o, pick, False, 1)
            open_[active] = o
            froms = np.take_along_axis(nodes[active], pick, 1)
            near = np.where(taken[:, :, None], flat[np.maximum(froms, 0)], -1).reshape(len(active), step * flat.shape[1])
            row, col = np.nonzero(near >= 0)
            found = near[row, col]
            new = ~seen[active[row], found]
            row, found = row[new], found[new]
            pair = np.unique(row * n + found)
            row, found = pair // n, pair % n
            seen[active[row], found] = True
            place = np.arange(len(row)) - np.searchsorted(row, row)
            wide = int(place.max(initial=-1)) + 1
            if wide:
                s = np.full((len(active), wide), -np.inf, np.float32)
                s[row, place] = (x[found] * q[active[row]]).sum(1)
                more = np.full((len(active), wide), -1, np.int32)
                more[row, place] = found
                s = np.concatenate([sims[active], s], 1)
                by = np.argsort(-s, axis=1, kind="stable")[:, :beam]
                sims[active] = np.take_along_axis(s, by, 1)
                nodes[active] = np.take_along_axis(np.concatenate([nodes[active], more], 1), by, 1)
                open_[active] = np.take_along_axis(np.concatenate([open_[active], more >= 0], 1), by, 1)
            active = active[open_[active].any(1)]
        return nodes, sims

    def search(self, queries: np.ndarray, beam: int = BEAM) -> np.ndarray:
        """Nodes of the largest products found for each query, at most beam, -1 where fewer."""
        beam = min(beam, len(self.x))
        queries = np.concatenate([queries, np.zeros((len(queries), 1))], 1).astype(np.float32)
        at = np.full(len(queries), self.entry)
        for k in range(len(self.levels) - 1, 0, -1):
            at = self._greedy(queries, at, k)
        return self._beam(queries, at, 0, beam)[0]


INDEX = "shard long, slice int, ids binary, vectors binary, lists binary, upper binary, n_upper int, entry int"


def build_index(vectors: DataFrame, shard: int | None = None) -> DataFrame:
    """vectors(node long, vector array<double>) -> the graphs of all shards, a row per slice of nodes; the first slice holds the upper levels."""
    got = vectors.agg(F.count("*").alias("n"), F.max(F.size("vector")).alias("width")).first()
    shards = max(1, -(-got["n"] // (shard or shard_size(got["n"], got["width"] or 1))))
    rows = vectors.select((F.size("vector").cast("long") * (1 << 32) + F.pmod(F.xxhash64("node"), F.lit(shards))).alias("shard"), "node", "vector")
    rows = rows.repartition(shards, "shard").sortWithinPartitions("shard", "node")
    names = [x.split()[0] for x in INDEX.split(", ")]
    kinds = [pa.int64(), pa.int32(), pa.binary(), pa.binary(), pa.binary(), pa.binary(), pa.int32(), pa.int32()]

    def sliced(key, ids, vecs):
        g = Graph(np.concatenate(ids), np.concatenate(vecs))
        upper = np.concatenate(g.levels[1:]).tobytes() if len(g.levels) > 1 else b""
        for i, lo in enumerate(range(0, len(g.ids), SLICE)):
            at = slice(lo, lo + SLICE)
            row = (key, i, g.ids[at].tobytes(), g.vectors[at].tobytes(), g.levels[0][at].tobytes(), b"" if i else upper, len(g.levels) - 1, g.entry)
            yield pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(row, kinds, strict=True)], names=names)

    def run(batches):
        key, ids, vecs = None, [], []
        for batch in batches:
            shard = np.asarray(batch.column(0))
            for lo, hi in zip(*(lambda cuts: (cuts[:-1], cuts[1:]))([0, *(np.flatnonzero(shard[1:] != shard[:-1]) + 1).tolist(), len(shard)]), strict=True):
                if lo == hi:
                    continue
                if shard[lo] != key and ids:
                    yield from sliced(key, ids, vecs)
                    ids, vecs = [], []
                key = int(shard[lo])
                ids.append(np.asarray(batch.column(1))[lo:hi])
                vecs.append(np.asarray(batch.column(2).slice(lo, hi - lo).flatten(), dtype=np.float64).reshape(hi - lo, -1))
        if ids:
            yield from sliced(key, ids, vecs)

    return stash(rows.mapInArrow(run, INDEX))


def search_index(index: DataFrame, queries: DataFrame, k: int, beam: int = BEAM) -> DataFrame:
    """queries(query_id, vector) against every shard of their length -> (query_id, node, score), k of each shard."""
    blocks = max(1, -(-queries.count() // QUERIES))
    asked = queries.withColumn("block", F.pmod(F.xxhash64("query_id"), F.lit(blocks)).cast("int"))
    to = index.select("shard", F.shiftright("shard", 32).alias("d")).distinct()
    asked = asked.withColumn("d", F.size("vector").cast("long")).join(F.broadcast(to), "d").select("shard", "block", F.lit(1).alias("kind"), "query_id", "vector")  # a number per shard
    heads = index.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))).withColumn("kind", F.lit(0))
    rows = heads.unionByName(asked, allowMissingColumns=True).repartition("shard", "block").sortWithinPartitions("shard", "block", "kind", "slice")
    rows = rows.select("kind", "slice", "ids", "vectors", "lists", "upper", "n_upper", "entry", "query_id", "vector")

    def run(batches):
        parts, graph, ids, vecs = [], None, [], []

        def answered():
            q = np.stack(vecs)
            out = [[], [], []]
            for lo in range(0, len(q), 1024):
                part = q[lo : lo + 1024]
                for query, v, found in zip(ids[lo : lo + 1024], part, graph.search(part, max(beam, k)), strict=True):
                    found = found[found >= 0]
                    score = (graph.vectors[found] * v).cumsum(1)[:, -1]
                    top = np.lexsort((graph.ids[found], -score))[:k]
                    out[0] += [query] * len(top)
                    out[1] += graph.ids[found[top]].tolist()
                    out[2] += score[top].tolist()
            return pa.RecordBatch.from_arrays([pa.array(out[0], pa.int64()), pa.array(out[1], pa.int64()), pa.array(out[2], pa.float64())], names=["query_id", "node", "score"])

        def assembled():
            got = np.concatenate([np.frombuffer(p[0], np.int64) for p in parts])
            x = np.concatenate([np.frombuffer(p[1], np.float64) for p in parts]).reshape(len(got), -1)
            low = np.concatenate([np.frombuffer(p[2], np.int32) for p in parts]).reshape(len(got), -1)
            upper = np.frombuffer(parts[0][3], np.int32).reshape(parts[0][4], len(got), ROOM)
            return Graph(got, x, [low, *upper], parts[0][5])

        for batch in batches:
            columns = [batch.column(i) for i in range(8)]
            for i, kind in enumerate(batch.column(0).to_pylist()):
                if not kind:
                    if columns[1][i].as_py() == 0:
                        if vecs:
                            yield answered()
                        parts, graph, ids, vecs = [], None, [], []
                    parts.append(tuple(columns[j][i].as_py() for j in range(2, 8)))
                    continue
                if graph is None:
                    graph, parts = assembled(), []
                ids.append(batch.column(8)[i].as_py())
                vecs.append(np.array(batch.column(9)[i].as_py(), dtype=np.float64))
        if vecs:
            yield answered()

    return rows.mapInArrow(run, "query_id long, node long, score double")


def exact(vectors: DataFrame, sample: list[tuple], k: int) -> DataFrame:
    """vectors(vec_id, vector) and a bounded sample of (query_id, vector) -> query_id, vec_id, score: k nearest by comparing all."""
    shared = vectors.sparkSession.sparkContext.broadcast(sample)  # AUDIT vectors at most

    def run(batches):
        asked: dict[int, list] = {}
        for query, v in shared.value:
            asked.setdefault(len(v), []).append((query, np.array(v, dtype=np.float64)))
        for batch in batches:
            out = [[], [], []]
            ids, size = np.asarray(batch.column(0)), np.asarray(batch.column(1).value_lengths())
            for width, queries in asked.items():
                at = np.flatnonzero(size == width)
                if not len(at):
                    continue
                x = np.asarray(batch.column(1).take(pa.array(at)).flatten(), dtype=np.float64).reshape(len(at), width)
                sims = np.stack([v for _, v in queries]) @ x.T
                for (query, v), s in zip(queries, sims, strict=True):
                    near = np.argpartition(-s, k + 4)[: k + 5] if len(s) > k + 5 else np.arange(len(s))
                    near = near[ids[at[near]] != query]
                    out[0] += [query] * len(near)
                    out[1] += ids[at[near]].tolist()
                    out[2] += (x[near] * v).cumsum(1)[:, -1].tolist() if len(near) else []
            yield pa.RecordBatch.from_arrays([pa.array(out[0], pa.int64()), pa.array(out[1], pa.int64()), pa.array(out[2], pa.float64())], names=["query_id", "vec_id", "score"])

    found = vectors.select("vec_id", "vector").mapInArrow(run, "query_id long, vec_id long, score double")
    return _ranked(found, k)


def _ranked(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def nearest(vectors: DataFrame, queries: DataFrame, k: int = 20, beam: int = BEAM, shard: int | None = None, recall: float = RECALL) -> DataFrame:
    """vectors, queries (vec_id, embedding) -> query_id, rank, vec_id, score, recall (of the audit): k nearest, without the query's own row."""
    wide = lambda df: usable(df).filter(F.col("vec_id").isNotNull()).select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("vector"))
    same = Window.partitionBy("vector").orderBy("vec_id")
    ranked = wide(vectors).withColumn("copy", F.row_number().over(same)).filter(F.col("copy") <= k + 1)
    ranked = stash(ranked.withColumn("node", F.first("vec_id").over(same)))
    members = ranked.select("node", "vec_id")
    asked = stash(wide(queries).withColumnRenamed("vec_id", "query_id"))
    index = build_index(ranked.filter("copy = 1").select("node", "vector"), shard)
    sample = [(r[0], r[1]) for r in asked.select("query_id", "vector").orderBy(F.xxhash64("query_id"), "query_id").limit(AUDIT).collect()]
    truth = stash(exact(ranked, sample, k))
    largest = index.groupBy("shard").agg(F.sum(F.length("ids") / 8).alias("n")).agg(F.max("n")).first()[0] or 0
    while True:
        found = search_index(index, asked, k + 1, beam).join(members, "node").filter("vec_id <> query_id")
        out = stash(_ranked(found, k).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score"))
        hits = truth.join(out.select("query_id", "vec_id"), ["query_id", "vec_id"], "left_semi").count()
        measured = hits / max(1, truth.count()) if sample else 1.0
        if measured >= recall or beam >= largest:
            break
        release(out)
        beam *= 2
    release(ranked, asked, index, truth)
    return out.withColumn("recall", F.lit(float(min(1.0, measured))))


def op7_hnsw_neighbours(spark, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return nearest(vectors, vectors.filter("vec_id % 20 = 0")).select("query_id", "rank", "vec_id", "score", "recall")
