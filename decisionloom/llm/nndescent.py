"""Near-duplicate embeddings by NN-descent.

A neighbour graph starts from leaves of random hyperplane trees and is refined by joining each
node's neighbours (its own and those that point to it) with one another; a node whose list is full
of links keeps a longer one next time.  Rounds end when one brings no new link, and only then.  Two
samples, one node of each of many components and nodes without a link, are then compared with all
vectors; while a node of them has a link that isn't joined, more trees and rounds follow.  If the
last audit finds one too, all vectors are compared in blocks.  Edges at the threshold are confirmed
in double precision and give the components.  Each row says how many nodes the last audit compared
with all vectors, and which share of all nodes may, at 95 per cent, still have a link that isn't
joined: none where the audit saw all nodes or all were compared, else 3 in the number of them.

Links are counted inside components, in pairs of blocks of bounded size, so neither a list's bound
nor a group of thousands costs a link or makes a row per pair.  Equal vectors are one node with a
count.

Cases: vectors that are null, empty or zero, or hold null or non-finite components, link with
nothing and are their own component; vectors of different lengths don't link; rows that repeat an
id count as vectors of their own, under that id; rows of null ids come back unlinked; an empty
table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from math import acos, ceil, log, log2, pi

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from decisionloom.llm.common import by_value, release, settled, stash, table
from decisionloom.llm.graph import components
from decisionloom.llm.vectors import usable

by_value(__name__)

COSINE = 0.95
#: Trees of one pass at least and at a time, and the chance that the pair at the threshold shares no leaf of a pass.
TREES, LEAF, CHUNK, APART = 10, 48, 512, 1e-3
#: Length of a neighbour list at first and at most; longer lists are made up for by the count inside components.
NEIGHBOURS, MOST = 6, 24
#: Nodes of each of an audit's two samples, and audits at most before all is compared.
AUDIT, AUDITS = 1024, 3
#: Nodes of a block that links are counted in, nodes of a block where all is compared, and rows compared at a time.
BLOCK, WHOLE, STRIP = 1024, 8192, 512
#: Single-precision products this far below the threshold are still confirmed.
SLACK = 1e-4

EDGES = "a long, b long, s float"


def _edges(out_a, out_b, out_s) -> pa.RecordBatch:
    joined = [np.concatenate(x) if x else np.zeros(0) for x in (out_a, out_b, out_s)]
    return pa.RecordBatch.from_arrays([pa.array(joined[0].astype(np.int64)), pa.array(joined[1].astype(np.int64)), pa.array(joined[2].astype(np.float32))], names=["a", "b", "s"])


def unit_vectors(vectors: DataFrame) -> DataFrame:
    """vectors(vec_id, embedding) -> node (least id of equal vectors), copies, dim, x (unit vector, single), y (double)."""

    def run(batches):
        for batch in batches:
            xs, ys = [], []
            for v in batch.column(2):
                y = np.array(v.as_py(), dtype=np.float64)
                y /= np.sqrt((y * y).sum())
                ys.append(y.tobytes())
                xs.append(y.astype(np.float32).tobytes())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array([len(y) // 8 for y in ys], pa.int32()), pa.array(xs, pa.binary()), pa.array(ys, pa.binary())], names=["node", "copies", "dim", "x", "y"])

    one = usable(vectors).filter(F.col("vec_id").isNotNull()).groupBy(F.col("embedding").cast("array<double>").alias("v")).agg(F.min(F.col("vec_id").cast("long")).alias("node"), F.count("*").alias("copies"))
    return one.select("node", "copies", "v").mapInArrow(run, "node long, copies long, dim int, x binary, y binary")


def spanning(sims: np.ndarray, cosine: float) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (i, j) that join what all links of a square matrix of products join: trees of the sure links, and all unsure ones between trees."""
    sure = sims >= cosine + SLACK
    np.fill_diagonal(sure, False)
    open_, tree = sure.any(1), np.arange(len(sims))
    i, j = [], []
    while open_.any():
        root = int(open_.argmax())
        open_[root], todo = False, [root]
        while todo:
            u = todo.pop()
            new = np.flatnonzero(sure[u] & open_)
            open_[new], tree[new] = False, root
            i += [u] * len(new)
            j += new.tolist()
            todo += new.tolist()
    p, q = np.nonzero(np.triu((sims >= cosine - SLACK) & ~sure, 1))
    between = tree[p] != tree[q]
    return np.array(i + p[between].tolist(), np.int64), np.array(j + q[between].tolist(), np.int64)


def _top(nodes: list[int], x: np.ndarray, k: int, cosine: float, a: list, b: list, s: list) -> None:
    ids = np.array(nodes, dtype=np.int64)
    sims = x @ x.T
    np.fill_diagonal(sims, -2)
    i, j = spanning(sims, cosine)
    a.append(ids[i])
    b.append(ids[j])
    s.append(sims[i, j])
    k = min(k, len(ids) - 1)
    near = np.argpartition(-sims, k - 1, axis=1)[:, :k]
    a.append(np.repeat(ids, k))
    b.append(ids[near.ravel()])
    s.append(np.take_along_axis(sims, near, 1).ravel())


def trees_for(n: int, cosine: float) -> int:
    """How many trees leave a pair at the threshold apart with a probability of APART at most."""
    bits = max(0, ceil(log2(max(1, n / LEAF))))
    together = (1 - acos(cosine) / pi) ** bits
    return TREES if together >= 1 else max(TREES, ceil(log(APART) / log(1 - together)))


def planted(nodes: DataFrame, n: int, seed: int, cosine: float) -> DataFrame:
    """The edges of as many forests as n nodes need, one written after the other."""
    out = None
    for k in range(ceil(trees_for(n, cosine) / TREES)):
        edges = stash(forest(nodes, n, seed * 100 + k, cosine))
        out = edges if out is None else out.unionByName(edges)
    return out


def forest(nodes: DataFrame, n: int, seed: int, cosine: float = COSINE) -> DataFrame:
    """Edges (a, b, s): the nearest nodes of each node within its leaf, and links that join what the leaf's links join, for every tree.  Leaves are taken in chunks."""
    bits = max(0, ceil(log2(max(1, n / LEAF))))

    def leaves(batches):
        planes: dict[int, np.ndarray] = {}
        for batch in batches:
            if not batch.num_rows:
                continue
            ids, dims = np.asarray(batch.column(0)), np.asarray(batch.column(1))
            raw = batch.column(2).to_pylist()
            for dim in np.unique(dims):
                at = np.flatnonzero(dims == dim)
                if dim not in planes:
                    planes[dim] = np.random.default_rng(seed * 1000 + int(dim)).standard_normal((TREES * bits, dim)).astype(np.float32)
                x = np.frombuffer(b"".join([raw[i] for i in at]), np.float32).reshape(len(at), dim)
                signs = (x @ planes[dim].T > 0).reshape(len(at), TREES, bits)
                codes = (signs * (1 << np.arange(bits, dtype=np.int64))).sum(2)
                for t in range(TREES):
                    leaf = codes[:, t] + (t << 40) + (int(dim) << 46)
                    yield pa.RecordBatch.from_arrays([pa.array(leaf.astype(np.int64)), pa.array(ids[at]), pa.array([raw[i] for i in at], pa.binary())], names=["leaf", "node", "x"])

    rows = nodes.select("node", "dim", "x").mapInArrow(leaves, "leaf long, node long, x binary")
    rows = rows.repartition("leaf").sortWithinPartitions("leaf", F.xxhash64("node", "leaf"))

    def run(batches):
        key, ids, raw = None, [], []
        a, b, s = [], [], []

        def flush():
            if len(ids) > 1:
                _top(ids, np.frombuffer(b"".join(raw), np.float32).reshape(len(ids), -1), NEIGHBOURS, cosine, a, b, s)

        for batch in batches:
            for leaf, node, x in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if leaf != key or len(ids) == CHUNK:
                    flush()
                    key, ids, raw = leaf, [], []
                ids.append(node)
                raw.append(x)
            yield _edges(a, b, s)
            a, b, s = [], [], []
        flush()
        yield _edges(a, b, s)

    return rows.mapInArrow(run, EDGES)


def _best(edges: DataFrame, lengths: DataFrame) -> DataFrame:
    """For each node its best edges, as many as its list is long."""
    once = edges.groupBy("a", "b").agg(F.max("s").alias("s"))
    placed = once.withColumn("r", F.row_number().over(Window.partitionBy("a").orderBy(F.desc("s"), "b"))).filter(F.col("r") <= MOST)
    return placed.join(lengths, placed["a"] == lengths["node"], "left").filter(F.col("r") <= F.coalesce("k", F.lit(NEIGHBOURS))).select("a", "b", "s")


def _joined(graph: DataFrame, nodes: DataFrame, lengths: DataFrame, cosine: float) -> DataFrame:
    """Edges between neighbours of a node that better one end's list or find room in it, and links that join what all links between the neighbours join."""
    held = graph.groupBy("a").agg(F.min("s").alias("worst"), F.count("*").alias("n"))
    worst = held.join(lengths, held["a"] == lengths["node"], "left").filter(F.col("n") >= F.coalesce("k", F.lit(NEIGHBOURS))).select("a", "worst")
    reverse = graph.select(F.col("b").alias("w"), F.col("a").alias("u"), "s").withColumn("r", F.row_number().over(Window.partitionBy("w").orderBy(F.desc("s"), "u"))).filter(F.col("r") <= MOST).drop("r", "s")
    around = graph.select(F.col("a").alias("w"), F.col("b").alias("u")).unionByName(reverse).distinct()
    rows = around.join(worst, around["u"] == worst["a"], "left").join(nodes.select(F.col("node").alias("u"), "x"), "u").select("w", "u", F.coalesce("worst", F.lit(-1.0)).cast("float").alias("worst"), "x")
    rows = rows.repartition("w").sortWithinPartitions("w")

    def run(batches):
        key, ids, worst, raw = None, [], [], []
        a, b, s = [], [], []

        def flush():
            if len(ids) > 1:
                x = np.frombuffer(b"".join(raw), np.float32).reshape(len(ids), -1)
                i, j = np.triu_indices(len(ids), 1)
                whole = x @ x.T
                sims = whole[i, j]
                u, low = np.array(ids), np.array(worst)
                p, q = spanning(whole, cosine)
                a.append(u[p])
                b.append(u[q])
                s.append(whole[p, q])
                for p, q in ((i, j), (j, i)):
                    good = sims > low[p]
                    a.append(u[p[good]])
                    b.append(u[q[good]])
                    s.append(sims[good])

        for batch in batches:
            for w, u, low, x in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if w != key:
                    flush()
                    key, ids, worst, raw = w, [], [], []
                ids.append(u)
                worst.append(low)
                raw.append(x)
            yield _edges(a, b, s)
            a, b, s = [], [], []
        flush()
        yield _edges(a, b, s)

    return rows.mapInArrow(run, EDGES)


def descend(graph: DataFrame, nodes: DataFrame, cosine: float) -> DataFrame:
    """Refine the graph (a, b, s) until a round brings no new link; return links that join what all links seen join, and keep lists of bounded length."""
    empty = graph.sparkSession.createDataFrame([], "node long, k int")
    link = F.col("s") >= cosine - SLACK
    edges = stash(graph.groupBy("a", "b").agg(F.max("s").alias("s")))
    graph, links = stash(_best(edges, empty)), stash(edges.filter(link))
    release(edges)
    lengths, known = empty, None
    while True:  # links only ever grow
        full = graph.groupBy("a").agg(F.count("*").alias("n"), F.count_if(link).alias("m")).filter("m = n").select(F.col("a").alias("node"), F.least(F.col("n") * 2, F.lit(MOST)).cast("int").alias("k"))
        lengths = stash(full.unionByName(lengths).groupBy("node").agg(F.max("k").alias("k")))
        found = stash(_joined(graph, nodes, lengths, cosine))
        graph = stash(_best(graph.unionByName(found), lengths))
        links = stash(links.unionByName(found.filter(link)).unionByName(graph.filter(link)).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"), "s").dropDuplicates(["a", "b"]))
        n = links.count()
        if n == known:
            return links
        known = n


def confirmed(links: DataFrame, nodes: DataFrame, cosine: float) -> DataFrame:
    """Links (a, b) that reach the threshold in double precision."""
    y = nodes.select("node", "y", "dim")
    rows = links.select("a", "b").join(y.select(F.col("node").alias("a"), F.col("y").alias("p"), F.col("dim").alias("d")), "a").join(y.select(F.col("node").alias("b"), F.col("y").alias("q"), F.col("dim").alias("e")), "b").filter("d = e").select("a", "b", "p", "q")

    def run(batches):
        for batch in batches:
            keep = [float((np.frombuffer(p, np.float64) * np.frombuffer(q, np.float64)).sum()) >= cosine for p, q in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True)]
            yield batch.select([0, 1]).filter(pa.array(keep, pa.bool_()))

    return rows.mapInArrow(run, "a long, b long")


def audited(nodes: DataFrame, found: DataFrame, cosine: float, seed: int) -> tuple[int, int]:
    """Of two samples of at most AUDIT nodes, one of each component and nodes without a link: how many were compared with all, and how many have a link that isn't joined."""
    placed = nodes.select("node", "y").join(found, "node", "left").withColumn("component", F.coalesce("component", "node"))
    order = F.xxhash64("node", F.lit(seed))
    linked = found.groupBy("component").agg(F.min_by("node", order).alias("node")).orderBy(order).limit(AUDIT)
    alone = nodes.join(found, "node", "left_anti").select("node").orderBy(order).limit(AUDIT)
    sample = [tuple(r) for r in placed.join(F.broadcast(stash(linked.select("node").unionByName(alone))), "node").select("node", "component", "y").collect()]
    shared = nodes.sparkSession.sparkContext.broadcast(sample)  # at most twice AUDIT vectors

    def run(batches):
        by: dict[int, list] = {}
        for node, comp, y in shared.value:
            by.setdefault(len(y), []).append((node, comp, np.frombuffer(y, np.float64)))
        ready = {k: (np.array([n for n, _, _ in v]), np.array([c for _, c, _ in v]), np.stack([y for *_, y in v])) for k, v in by.items()}
        for batch in batches:
            out = []
            raw, own, comp = batch.column(1).to_pylist(), np.asarray(batch.column(0)), np.asarray(batch.column(2))
            for size in set(map(len, raw)) & set(ready):
                all_ = [i for i, y in enumerate(raw) if len(y) == size]
                ids, comps, q = ready[size]
                for lo in range(0, len(all_), STRIP):
                    at = all_[lo : lo + STRIP]
                    sims = np.frombuffer(b"".join([raw[i] for i in at]), np.float64).reshape(len(at), -1) @ q.T
                    near = (sims >= cosine) & (own[at][:, None] != ids[None, :])
                    apart = (near & (comp[at][:, None] != comps[None, :])).any(0)
                    out += [(int(ids[i]), bool(apart[i])) for i in np.flatnonzero(near.any(0))]
            yield pa.RecordBatch.from_arrays([pa.array([n for n, _ in out], pa.int64()), pa.array([m for _, m in out], pa.bool_())], names=["node", "missed"])

    seen = placed.select("node", "y", "component").mapInArrow(run, "node long, missed boolean").groupBy("node").agg(F.max("missed").alias("missed"))
    return len(sample), seen.agg(F.count_if("missed").alias("missed")).first()["missed"]


def everywhere(nodes: DataFrame, found: DataFrame, cosine: float) -> DataFrame:
    """Links (a, b) that join what all links between different components join: every two vectors compared, in blocks."""
    placed = nodes.select("node", "dim", "x").join(found, "node", "left").withColumn("component", F.coalesce("component", "node"))
    sizes = nodes.groupBy("dim").agg(F.ceil(F.count("*") / WHOLE).cast("int").alias("blocks"))
    placed = placed.join(F.broadcast(sizes), "dim").withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    both = F.transform(F.sequence(F.lit(0), F.col("blocks") - 1), lambda o: F.struct(F.least(o, F.col("block")).alias("i"), F.greatest(o, F.col("block")).alias("j")))
    rows = placed.withColumn("pair", F.explode(both)).select("dim", "pair.i", "pair.j", "block", "node", "component", "x").repartition("dim", "i", "j").sortWithinPartitions("dim", "i", "j")

    def compare(i, j, members):
        block, ids, comp, x = (list(c) for c in zip(*members, strict=True))
        block, ids, comp = np.array(block), np.array(ids), np.array(comp)
        x = np.frombuffer(b"".join(x), np.float32).reshape(len(ids), -1)
        left, right = np.flatnonzero(block == i), np.flatnonzero(block == j)
        a, b = [], []
        for lo in range(0, len(left), STRIP):
            at = left[lo : lo + STRIP]
            sims = x[at] @ x[right].T
            p, q = np.nonzero(sims >= cosine - SLACK)
            sure, p, q = sims[p, q] >= cosine + SLACK, at[p], right[q]
            while True:
                apart = comp[p] != comp[q]
                sure, p, q = sure[apart], p[apart], q[apart]
                if not sure.any():
                    break
                k = int(sure.argmax())
                a.append(ids[p[k]])
                b.append(ids[q[k]])
                comp[comp == comp[q[k]]] = comp[p[k]]
            a += ids[p].tolist()
            b += ids[q].tolist()
        return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

    def run(batches):
        key, members = None, []
        for batch in batches:
            for dim, i, j, *rest in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if (dim, i, j) != key:
                    if members:
                        yield compare(*key[1:], members)
                    key, members = (dim, i, j), []
                members.append(tuple(rest))
        if members:
            yield compare(*key[1:], members)

    links = rows.mapInArrow(run, "a long, b long").filter("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    return confirmed(links, nodes, cosine)


def counted(found: DataFrame, nodes: DataFrame, cosine: float) -> DataFrame:
    """(node, n): copies of all nodes that each node of a component links with, its own not counted."""
    sizes = found.groupBy("component").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks"))
    placed = found.join(sizes, "component").join(nodes.select("node", "copies", "dim", "y"), "node").withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    both = F.transform(F.sequence(F.lit(0), F.col("blocks") - 1), lambda o: F.struct(F.least(o, F.col("block")).alias("i"), F.greatest(o, F.col("block")).alias("j")))
    rows = placed.withColumn("pair", F.explode(both)).select("component", "pair.i", "pair.j", "block", "node", "copies", "y").repartition("component", "i", "j").sortWithinPartitions("component", "i", "j")

    def run(batches):
        key, members = None, []

        def done():
            (_, i, j), (block, ids, copies, y) = key, (list(c) for c in zip(*members, strict=True))
            block, ids, copies = np.array(block), np.array(ids), np.array(copies)
            x = np.frombuffer(b"".join(y), np.float64).reshape(len(ids), -1)
            left, right = np.flatnonzero(block == i), np.flatnonzero(block == j)
            out = np.zeros(len(ids), np.int64)
            if len(left) and len(right):
                linked = x[left] @ x[right].T
                near = np.argwhere(np.abs(linked - cosine) < 1e-9)  # products differ in the last digits by the way they are summed
                linked = linked >= cosine
                for p, q in near:
                    linked[p, q] = (x[left[p]] * x[right[q]]).sum() >= cosine
                if i == j:
                    np.fill_diagonal(linked, False)
                else:
                    out[right] += linked.T @ copies[left]
                out[left] += linked @ copies[right]
            return pa.RecordBatch.from_arrays([pa.array(ids), pa.array(out)], names=["node", "n"])

        for batch in batches:
            for comp, i, j, *rest in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if (comp, i, j) != key:
                    if members:
                        yield done()
                    key, members = (comp, i, j), []
                members.append(tuple(rest))
        if members:
            yield done()

    return rows.mapInArrow(run, "node long, n long").groupBy("node").agg(F.sum("n").alias("n"))


def near_duplicates(vectors: DataFrame, cosine: float = COSINE) -> DataFrame:
    """vectors(vec_id, embedding) -> vec_id, n_links, component_id, kept, n_audited, unsure_share."""
    return settled(lambda: _near_duplicates(vectors, cosine))


def _near_duplicates(vectors: DataFrame, cosine: float) -> DataFrame:
    nodes = stash(unit_vectors(vectors))
    n = nodes.count()
    links = found = None
    for seed in range(1, AUDITS + 1):
        more = confirmed(descend(planted(nodes, n, seed, cosine), nodes, cosine), nodes, cosine)
        links = stash(more if links is None else links.unionByName(more).distinct())
        found = stash(components(links))
        tested, missed = audited(nodes, found, cosine, seed)
        if not missed:
            break
    doubt = 0.0 if missed or tested >= n else min(1.0, 3 / tested)
    if missed:
        found = stash(components(links.unionByName(everywhere(nodes, found, cosine))))
    counts = counted(found, nodes, cosine)
    ids = stash(nodes.select("node", "copies").join(found, "node", "left").join(counts, "node", "left").select("node", F.coalesce("component", "node").alias("component_id"), (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n_links")))
    own = usable(vectors).filter(F.col("vec_id").isNotNull()).select("vec_id", F.col("embedding").cast("array<double>").alias("v"))
    first = own.groupBy("v").agg(F.min("vec_id").alias("node"))
    linked = own.join(first, "v").join(ids, "node").select("vec_id", "n_links", "component_id")
    rest = _unusable(vectors).select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").cast("long").alias("component_id"))
    out = linked.unionByName(rest)
    measured = [F.lit(tested).cast("long").alias("n_audited"), F.lit(doubt).alias("unsure_share")]
    return out.select("vec_id", "n_links", "component_id", F.col("vec_id").eqNullSafe(F.col("component_id")).alias("kept"), *measured)


def _unusable(vectors: DataFrame) -> DataFrame:
    v = F.col("embedding")
    bad = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return vectors.filter(F.col("vec_id").isNull() | v.isNull() | (F.size(v) <= 0) | F.coalesce(bad | ~F.exists(v, lambda x: x != 0), F.lit(True)))


def op1_nn_descent(spark, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "embeddings"))
