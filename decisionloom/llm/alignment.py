"""Alignment of two tokenizers over the same texts.

Both tokenizers treat a run alone (a space or line end between two characters that are no white space, and what follows up to the
next such place), so a document is a list of runs, and each distinct run of an Arrow partition is tokenised and aligned once.
There DuckDB holds the tokens' byte intervals as two tables: tokens that end together are links, a window sum over the links
numbers the groups, and ASOF joins find the group that each token lies in.  Documents add up their runs.

Each partition's counts of linked id pairs are merged in Spark.  Documents, runs and the merged counts that a block of runs needs
are then brought together by block, so no document's links are ever written out and no count table is broadcast.

Cases: null and empty texts, and those whose joined bytes differ from space and text under either tokenizer, have no tokens: all
zeros and an empty digest, and their links count nowhere; a null id is a document like others; rows that repeat count each; an
empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import os
import re
from array import array
from hashlib import sha256
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from decisionloom.llm.common import by_value, settled, stash, table
from decisionloom.llm.packing import BYTE_LETTERS

by_value(__name__)

#: Distinct runs of a block, and bytes of their texts, beyond which the next document starts another.
RUNS, BYTES = 400_000, 64 << 20
#: Tokens that one DuckDB statement aligns at a time, or those of a single run; runs that are tokenised at a time; characters of
#: documents (or a single one) that are cut into runs at a time.
TOKENS, LEARNT, CHARS = 200_000, 20_000, 2_000_000
RECORDS = 5_000
#: Runs whose links are one row.
TOGETHER = 20_000

#: Where a text is cut into runs.
CUT = re.compile(r"(?<=\S)(?=[ \n]\S)")
DOUBLE = re.compile(r"\s\s")
PAIRS, LINKS, DOCUMENTS = 0, 1, 2


def runs_of(text: str) -> list[str]:
    """The runs of a space and a text that isn't empty."""
    if "\0" in text or text[0].isspace() or text[-1].isspace() or DOUBLE.search(text):
        return CUT.split(" " + text)
    return f" {text}".replace(" ", "\0 ").replace("\n", "\0\n").split("\0")[1:]  # each is a place to cut

#: Ends e count from the first run on, so that they are places of all runs' bytes.
LINKED = "SELECT a.id AS x, b.id AS y, a.e, CAST(sum(1) OVER (ORDER BY a.e ROWS UNBOUNDED PRECEDING) AS BIGINT) - 1 AS g FROM a JOIN b ON a.e = b.e"
GROUPED = "SELECT t.e, s.g FROM {} t ASOF JOIN s ON t.e <= s.e ORDER BY t.e"


def default_tokenizers() -> tuple[str, str]:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


class Tokens:
    """Ids and byte lengths of runs under both tokenizers."""

    def __init__(self, paths: tuple[str, str]):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(paths[0])
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=paths[1])
        letters = {chr(v): k for k, v in ({b: b for b in range(256)} | BYTE_LETTERS).items()}
        names = {i: t for t, i in self.a.get_vocab(with_added_tokens=False).items()}
        self.a_bytes = [bytes(map(letters.__getitem__, names[i])) if i in names else b"" for i in range(max(names) + 1)]
        self.b_bytes = []
        for i in range(self.b.vocab_size()):
            piece = self.b.id_to_piece(i)
            self.b_bytes.append(bytes([int(piece[3:5], 16)]) if self.b.is_byte(i) else piece.replace("▁", " ").encode())
        pieces = list(map(self.b.id_to_piece, range(self.b.vocab_size())))
        if any("▁" in p.lstrip("▁") or "\n" in p for p in pieces):
            raise ValueError("a piece reaches over a space or a line end, so runs can't be cut there")

    def encoded(self, runs: list[str]) -> tuple[list, list]:
        """Ids of runs, each of which starts with a space or a line end; the second tokenizer puts a space before a text itself."""
        first = [e.ids for e in self.a.encode_batch_fast(runs, add_special_tokens=False)]
        second = self.b.encode([r[1:] if r[0] == " " else r for r in runs], num_threads=1)
        lone = self.b.piece_to_id("▁")
        return first, [[lone] if r == " " else ids if r[0] == " " else ids[1:] for r, ids in zip(runs, second, strict=True)]

    def agree(self, runs: list[str], first: list[list[int]], second: list[list[int]]) -> list[bool]:
        """Whether both lists of ids stand for exactly their run: all runs at once, and one by one only where that fails."""
        wholes = [r.encode() for r in runs]
        sizes, joined = list(map(len, wholes)), b"".join(wholes)
        for lists, of in ((first, self.a_bytes), (second, self.b_bytes)):
            parts = [b"".join(map(of.__getitem__, ids)) for ids in lists]
            if list(map(len, parts)) != sizes or b"".join(parts) != joined:
                return [all(b"".join(map(of.__getitem__, ids)) == w for ids, of in ((x, self.a_bytes), (y, self.b_bytes))) for w, x, y in zip(wholes, first, second, strict=True)]
        return [True] * len(runs)


def intervals(lists: list[list[int]], sizes: np.ndarray) -> tuple[pa.Table, np.ndarray]:
    """A table of id and e, where each token's bytes end, over all lists; and how many tokens each has."""
    many = np.fromiter(map(len, lists), np.int64, len(lists))
    ids = np.fromiter(chain.from_iterable(lists), np.int64, int(many.sum()))
    return pa.table({"id": ids, "e": np.cumsum(sizes[ids])}), many


class Aligner:
    """Runs by their text: number, what they add to a document, and their links."""

    def __init__(self, paths: tuple[str, str]):
        import duckdb

        self.tokens = Tokens(paths)
        self.a_sizes, self.b_sizes = (np.array(list(map(len, x)), np.int64) for x in (self.tokens.a_bytes, self.tokens.b_bytes))
        self.a_names, self.b_names = (list(map(str, range(len(x)))) for x in (self.a_sizes, self.b_sizes))
        self.con = duckdb.connect(config={"threads": 1, "memory_limit": "400MB", "temp_directory": ""})
        self.start()

    def start(self) -> None:
        self.numbers: dict[str, int] = {}
        self.groups: list[bytes | None] = []
        self.adds, self.links, self.many = array("q"), array("q"), array("q")  # four numbers a run; links of all runs; how many of each
        self.size = 0

    def learn(self, runs: list[str]) -> None:
        for at in range(0, len(runs), LEARNT):
            part = runs[at : at + LEARNT]
            first, second = self.tokens.encoded(part)
            good = self.tokens.agree(part, first, second)
            lo = 0
            while lo < len(part):
                hi, n = lo, 0
                while hi < len(part) and (hi == lo or n < TOKENS):
                    n += len(first[hi]) + len(second[hi])
                    hi += 1
                self.align(part[lo:hi], first[lo:hi], second[lo:hi], good[lo:hi])
                lo = hi

    def align(self, runs: list[str], first: list, second: list, good: list[bool]) -> None:
        at = [i for i, ok in enumerate(good) if ok]
        (a, a_many), (b, b_many) = intervals([first[i] for i in at], self.a_sizes), intervals([second[i] for i in at], self.b_sizes)
        self.con.register("a", a)
        self.con.register("b", b)
        self.con.execute("CREATE OR REPLACE TEMP TABLE s AS " + LINKED)
        s = self.con.execute("SELECT x, y, e FROM s ORDER BY g").fetchnumpy()
        a_group, b_group = (self.con.execute(GROUPED.format(t)).fetchnumpy()["g"] for t in "ab")
        self.con.unregister("a")
        self.con.unregister("b")
        links = np.asarray(s["x"], np.int64) << 32 | np.asarray(s["y"], np.int64)
        texts = list(map("|".join, zip(self.joined(a, a_group, self.a_names), self.joined(b, b_group, self.b_names), strict=True)))
        upto = np.searchsorted(np.asarray(s["e"]), a["e"].to_numpy()[np.cumsum(a_many) - 1], "right") if at else np.zeros(0, np.int64)  # links of each run and those before
        many = np.diff(upto, prepend=0)
        adds, links_of = np.zeros((len(runs), 4), np.int64), np.zeros(len(runs), np.int64)
        adds[at] = np.stack([a_many, b_many, many, a_many + b_many - many], 1)  # an overlap ends where a token of either ends, a link where both do
        links_of[at] = many
        ends = upto.tolist()
        found = dict(zip(at, [";".join(texts[lo:hi]).encode() for lo, hi in zip([0, *ends], ends, strict=False)], strict=True))
        self.numbers.update(zip(runs, range(len(self.groups), len(self.groups) + len(runs)), strict=True))
        self.groups += map(found.get, range(len(runs)))
        for own, values in ((self.adds, adds), (self.links, links), (self.many, links_of)):
            own.frombytes(values.tobytes())
        self.size += sum(map(len, runs)) + 8 * len(links)

    def joined(self, tokens: pa.Table, group: np.ndarray, names: list[str]) -> list[str]:
        """The ids of each group's tokens."""
        ids = list(map(names.__getitem__, tokens["id"].to_pylist()))
        ends = (np.flatnonzero(np.diff(group, append=-1)) + 1).tolist()
        return [ids[lo] if hi == lo + 1 else ",".join(ids[lo:hi]) for lo, hi in zip([0, *ends], ends, strict=False)]

    def numbered(self, texts: list[str | None]) -> list[array]:
        """Numbers of each text's runs."""
        cut = [runs_of(t) if t else [] for t in texts]
        new = list(dict.fromkeys(r for runs in cut for r in runs if r not in self.numbers))
        if new:
            self.learn(new)
        return [array("i", map(self.numbers.__getitem__, runs)) for runs in cut]


def portions(column: pa.Array) -> list[tuple[int, int]]:
    """Rows of a column of texts, cut where they pass CHARS bytes."""
    ends, at, out = np.cumsum([len(x.as_buffer()) if x.is_valid else 0 for x in column]), 0, []
    while at < len(column):
        before = ends[at - 1] if at else 0
        to = max(at + 1, int(np.searchsorted(ends, before + CHARS, "right")))
        out.append((at, to))
        at = to
    return out


ROWS = "block long, kind int, pair long, n long, run int, links array<long>, many array<int>, doc_id {}, runs array<int>, times array<int>, n_a long, n_b long, n_groups long, n_overlaps long, groups_sha256 string"


def _batch(schema: pa.Schema, n: int, columns: dict) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([columns[f.name].cast(f.type) if f.name in columns else pa.nulls(n, f.type) for f in schema], schema=schema)


def aligned(docs: DataFrame, paths: tuple[str, str]) -> DataFrame:
    """Three kinds of rows by block: documents (their distinct runs, how often each stands there, and sums), runs (many at a time: their links, and how many each has), pairs (how many links of the block hold them)."""
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = to_arrow_schema(StructType.fromDDL(ROWS.format(kind)))

    def run(batches):
        own, part, k, often = Aligner(paths), TaskContext.get().partitionId(), 0, np.zeros(0, np.int64)

        def name() -> int:
            return (part << 32) + k

        def closed():
            """The block's runs, and counts of their pairs by how often runs stand in documents."""
            lengths, flat = np.array(own.many, np.int64), np.array(own.links, np.int64)
            same = lambda value, n, t: pa.array(np.full(n, value), t)
            starts = np.arange(0, len(lengths), TOGETHER)
            n, upto = len(starts), np.concatenate([[0], np.cumsum(lengths)])
            links = pa.ListArray.from_arrays(pa.array(upto[np.append(starts, len(lengths))], pa.int32()), pa.array(flat))
            many = pa.ListArray.from_arrays(pa.array(np.append(starts, len(lengths)), pa.int32()), pa.array(lengths, pa.int32()))
            yield _batch(schema, n, {"block": same(name(), n, pa.int64()), "kind": same(LINKS, n, pa.int32()), "run": pa.array(starts, pa.int32()), "links": links, "many": many})
            pairs, where = np.unique(flat, return_inverse=True)
            counts = np.bincount(where, np.repeat(often, lengths), len(pairs)).astype(np.int64)
            n = len(pairs)
            yield _batch(schema, n, {"block": same(name(), n, pa.int64()), "kind": same(PAIRS, n, pa.int32()), "pair": pa.array(pairs), "n": pa.array(counts)})

        def documents(texts: pa.Array, ids: pa.Array):
            nonlocal often
            numbers = own.numbered([None if t is None else t.decode() for t in texts.to_pylist()])
            often = np.concatenate([often, np.zeros(len(own.groups) - len(often), np.int64)])
            adds = np.frombuffer(own.adds, np.int64).reshape(-1, 4).copy() if own.adds else np.zeros((0, 4), np.int64)
            out = {f: [] for f in ("runs", "times", "n_a", "n_b", "n_groups", "n_overlaps", "groups_sha256")}
            for doc in numbers:
                texts = list(map(own.groups.__getitem__, doc))
                if None in texts:
                    doc, texts = array("i"), []
                runs, times = np.unique(np.array(doc, np.int64), return_counts=True)
                often[runs] += times
                sums = (adds[runs] * times[:, None]).sum(0).tolist()
                for f, x in zip(out, (runs, times, *sums, sha256(b";".join(texts)).hexdigest() if texts else ""), strict=True):
                    out[f].append(x)
            n = len(numbers)
            columns = {f: pa.array(x, schema.field(f).type) for f, x in out.items()}
            columns |= {"block": pa.array(np.full(n, name()), pa.int64()), "kind": pa.array(np.full(n, DOCUMENTS), pa.int32()), "doc_id": ids}
            return _batch(schema, n, columns)

        for batch in batches:
            for lo, hi in portions(batch.column(1)):
                if len(own.groups) > RUNS or own.size > BYTES:
                    yield from closed()
                    k, often = k + 1, np.zeros(0, np.int64)
                    own.start()
                yield documents(batch.column(1)[lo:hi], batch.column(0)[lo:hi])
        if own.groups:
            yield from closed()

    return docs.select("doc_id", F.col("text").cast("binary")).mapInArrow(run, ROWS.format(kind))


def pair_counts(rows: DataFrame) -> DataFrame:
    """pair (first id * 2^32 + second id), n over the whole corpus, and best, whether no pair of its second id has more."""
    merged = rows.filter(F.col("kind") == PAIRS).groupBy("pair").agg(F.sum("n").alias("n")).withColumn("second", F.col("pair").bitwiseAND(F.lit(0xFFFFFFFF)))
    merged = stash(merged)
    most = merged.groupBy("second").agg(F.max("n").alias("most"))
    return merged.join(most, "second").select("pair", "n", (F.col("n") == F.col("most")).alias("best"))


def valued(rows: DataFrame, pairs: DataFrame) -> DataFrame:
    """The documents among rows with n_links, n_best and count_sum, from the pairs' counts of the whole corpus."""
    kind = rows.schema["doc_id"].dataType.simpleString()
    asked = rows.filter(F.col("kind") == PAIRS).select("block", "pair").join(pairs, "pair").select("block", "pair", "n", "best")
    own = rows.filter(F.col("kind") != PAIRS).drop("pair", "n")
    both = own.unionByName(asked.withColumn("kind", F.lit(PAIRS)), allowMissingColumns=True)
    columns = ["block", "kind", "pair", "n", "best", "run", "links", "many", "runs", "times", "doc_id", "n_a", "n_b", "n_groups", "n_overlaps", "groups_sha256"]
    both = both.select(*columns).repartition("block").sortWithinPartitions("block", "kind", "run")
    passed = ["doc_id", "n_a", "n_b", "n_groups", "n_overlaps", "groups_sha256"]

    def edges(values):
        cuts = np.flatnonzero(values[1:] != values[:-1]) + 1
        at = [0, *cuts.tolist(), len(values)]
        return list(zip(at, at[1:], strict=False)) if len(values) else []

    def run(batches):
        block, pairs, table_, values, ready = None, [], None, [], False
        for batch in batches:
            blocks, kinds = np.asarray(batch.column(0)), np.asarray(batch.column(1))
            for lo, hi in edges(blocks * 4 + kinds):
                if blocks[lo] != block:
                    block, pairs, table_, values, ready = blocks[lo], [], None, [], False
                part = batch.slice(lo, hi - lo)
                if kinds[lo] == PAIRS:
                    pairs.append((np.asarray(part.column(2)), np.asarray(part.column(3)), part.column(4).to_numpy(zero_copy_only=False).astype(np.int64)))
                    continue
                if kinds[lo] == LINKS:
                    if table_ is None:
                        keys, n, best = (np.concatenate(x) for x in zip(*pairs, strict=True)) if pairs else (np.zeros(0, np.int64),) * 3
                        order = np.argsort(keys)
                        table_, pairs = (keys[order], np.stack([best[order], n[order]], 1)), []
                    flat, lengths = (part.column(i).flatten().to_numpy().astype(np.int64) for i in (6, 7))
                    each = table_[1][np.searchsorted(table_[0], flat)] if len(flat) else np.zeros((0, 2), np.int64)
                    sums = np.concatenate([np.zeros((1, 2), np.int64), np.cumsum(each, 0)])
                    ends = np.cumsum(lengths)
                    values.append(np.concatenate([sums[ends] - sums[ends - lengths], lengths[:, None]], 1))
                    continue
                if not ready:
                    values, table_, ready = np.concatenate(values) if values else np.zeros((0, 3), np.int64), None, True
                lengths = part.column(8).value_lengths().to_numpy()
                runs, times = part.column(8).flatten().to_numpy(), part.column(9).flatten().to_numpy().astype(np.int64)
                sums = np.concatenate([np.zeros((1, 3), np.int64), np.cumsum(values[runs] * times[:, None], 0)])
                ends = np.cumsum(lengths)
                got = sums[ends] - sums[ends - lengths]
                yield pa.RecordBatch.from_arrays([*[part.column(columns.index(c)) for c in passed], *[pa.array(got[:, j]) for j in (2, 0, 1)]], names=[*passed, "n_links", "n_best", "count_sum"])

    return both.mapInArrow(run, f"doc_id {kind}, n_a long, n_b long, n_groups long, n_overlaps long, groups_sha256 string, n_links long, n_best long, count_sum long")


def align(docs: DataFrame, paths: tuple[str, str] | None = None) -> DataFrame:
    """docs(doc_id, text) -> doc_id, n_a, n_b, n_groups, n_overlaps, groups_sha256, n_links, n_best, count_sum."""

    def make() -> DataFrame:
        rows = stash(aligned(docs, paths or default_tokenizers()))
        return valued(rows, pair_counts(rows))

    return settled(make, RECORDS)


def op12_tokenizer_alignment(spark, sf_dir: str) -> DataFrame:
    out = align(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256", "n_overlaps")
