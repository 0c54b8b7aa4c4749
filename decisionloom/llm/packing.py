"""Packing documents into windows by minimum bin slack.

Documents are cut at every full window; what remains (shorter than a window) is counted by
length.  Over that histogram, at most one row per length, a bitset subset-sum program picks the
multiset of lengths that fills a window closest to its capacity, the longest length always
being one of them, and the counts are read back from the bitsets.  A multiset is used as often
as its counts allow, so each step uses up a length and the number of steps does not grow with
the corpus.  Where no multiset fills the window, a document is broken into pieces of powers of
two, whose checksums were taken when it was tokenised; windows of the last pieces get power-of-two lengths,
so nothing is padded.

Documents find their places by their rank among those of their length; ranks come from hashed
buckets and prefix sums over them, so a length that holds a third of the corpus is never in one
task.  The driver sees the histogram and the table of places, both bounded by the window.

Cases: null text is an empty one, and holds the end token alone; documents whose id, tokens and
checksums are equal are interchangeable; an empty table gives an empty result; other columns are
ignored.
"""

from __future__ import annotations

import heapq
import re
import zlib
from array import array
from collections import deque

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from decisionloom.llm.common import by_value, parts_for, settled, stash, table

by_value(__name__)

CAPACITY, END = 4096, 2
#: Words whose ids a worker keeps; beyond it starts anew.
CACHE = 500_000
PER_BUCKET = 50_000


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


#: A run of Latin letters and the ASCII marks that may end it: the tokenizer treats the two alone, and the letters' case alike.
PLAIN = re.compile(r"([A-Za-z\u00C0-\u00D6\u00D8-\u00F6\u00F8-\u00FF]+)([!-/:-@\[-`{-~]*)")


#: Byte-level tokenizers write bytes that have no letter of their own as those from 256 on.
BYTE_LETTERS = {x: 256 + i for i, x in enumerate([*range(33), *range(127, 161), 173])}


class Runs(dict):
    """Ids by run of lower-case letters, straight by the model: its bytes' letters, then its merges."""

    def __init__(self, merge):
        self.merge = merge

    def __missing__(self, run: str) -> bytes:
        if len(self) > CACHE:
            self.clear()
        text = run if run.isascii() else run.encode().decode("latin-1").translate(BYTE_LETTERS)
        got = self[run] = array("I", [t.id for t in self.merge(text)]).tobytes()
        return got


class Ids(dict):
    """Token ids of whole texts as little-endian 32-bit words.

    The tokenizer drops white space and treats each run between it alone, so ids are kept by run,
    and those of runs of letters by the run in lower case.  A run is learnt where it is first
    looked up, so a text is gone through once.
    """

    def __init__(self, path: str):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.runs = Runs(self.tokenizer.model.tokenize)

    def __missing__(self, word: bytes) -> bytes:
        if len(self) > CACHE:
            self.clear()
        text = word.decode()
        plain = PLAIN.fullmatch(text)
        if plain is None:
            got = np.asarray(self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, dtype="<u4").tobytes()
        else:
            got = self.runs[plain[1].lower()]
            if plain[2]:
                got += self[plain[2].encode()]
        self[word] = got
        return got

    def __call__(self, text: bytes) -> bytes:
        return b"".join(map(self.__getitem__, text.split()))


TOKENISED = "doc_id long, doc_tokens long, full array<long>, rest long, rest_crc long, parts array<long>"


def tokenised(docs: DataFrame, path: str, capacity: int = CAPACITY, end: int = END) -> DataFrame:
    """A row per document: checksums of its full windows, of what remains, and of that in powers of two, the largest first."""
    tail = np.asarray([end], dtype="<u4").tobytes()

    def run(batches):
        ids = Ids(path)
        for batch in batches:
            rows = []
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                got = ids(text.as_py() or b"") + tail
                n = len(got) // 4
                k = n // capacity
                rest = memoryview(got)[k * capacity * 4 :]
                m, at, parts = n - k * capacity, 0, []
                while at < m:
                    step = 1 << ((m - at).bit_length() - 1)
                    parts.append(zlib.crc32(rest[at * 4 : (at + step) * 4]))
                    at += step
                rows.append((doc, n, [zlib.crc32(got[i * capacity * 4 : (i + 1) * capacity * 4]) for i in range(k)], m, zlib.crc32(rest), parts))
            cols = list(zip(*rows, strict=True)) or [[]] * 6
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, [pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.int64(), pa.int64(), pa.list_(pa.int64())], strict=True)], names=["doc_id", "doc_tokens", "full", "rest", "rest_crc", "parts"])

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("binary")).mapInArrow(run, TOKENISED)


def best_fill(sizes: list[tuple[int, int]], room: int) -> dict[int, int]:
    """How many of each (size, count), sizes falling, come closest to room without passing it."""
    mask, bits, steps = (1 << (room + 1)) - 1, 1, []
    for size, count in sizes:
        if size > room:
            continue
        left, k = min(count, room // size), 1
        while left:
            k = min(k, left)
            steps.append((size, k, bits))
            bits |= (bits << (size * k)) & mask
            left -= k
            k *= 2
        if bits >> room & 1:
            break
    at, used = bits.bit_length() - 1, {}
    for size, k, before in reversed(steps):
        if not before >> at & 1:
            at -= size * k
            used[size] = used.get(size, 0) + k
    return used


def place(histogram: dict[int, int], capacity: int = CAPACITY) -> tuple[np.ndarray, int]:
    """Places of the remainders, and the number of sequences.

    A row: length, part (-1: whole), first rank, ranks, then k, m, sequence, offset: the i-th of
    them stands in sequence + (k + i) // m at offset + (k + i) % m * size.
    """
    lots = {s: deque([(s, -1, 0, n)]) for s, n in histogram.items() if n}
    count = {s: n for s, n in histogram.items() if n}
    heap = [-s for s in count]
    heapq.heapify(heap)
    places: list[tuple] = []
    sequence = 0

    def put(size: int, n: int, m: int, first: int, offset: int) -> None:
        """The next n of this size, m to a sequence."""
        count[size] -= n
        k = 0
        while k < n:
            origin, part, lo, have = lots[size].popleft()
            use = min(have, n - k)
            places.append((origin, part, lo, use, k, m, first, offset))
            if use < have:
                lots[size].appendleft((origin, part, lo + use, have - use))
            k += use

    def broken(size: int, n: int) -> bool:
        """Break n whole ones of this size into powers of two."""
        for i in range(len(lots[size])):
            origin, part, lo, have = lots[size][i]
            if part < 0:
                n = min(n, have)
                del lots[size][i]
                if have > n:
                    lots[size].insert(i, (origin, part, lo, have - n))
                count[size] -= n
                for j, b in enumerate(b for b in range(size.bit_length() - 1, -1, -1) if size >> b & 1):
                    lots.setdefault(1 << b, deque()).append((size, j, lo + have - n, n))
                    if not count.get(1 << b):
                        heapq.heappush(heap, -(1 << b))
                    count[1 << b] = count.get(1 << b, 0) + n
                return True
        return False

    while True:
        while heap and not count.get(-heap[0]):
            heapq.heappop(heap)
        if not heap:
            return np.asarray(places, dtype=np.int64).reshape(-1, 8), sequence
        top = -heap[0]
        count[top] -= 1
        used = best_fill(sorted(((s, n) for s, n in count.items() if n), reverse=True), capacity - top)
        count[top] += 1
        fill = top + sum(s * n for s, n in used.items())
        used[top] = used.get(top, 0) + 1
        times = min(count[s] // n for s, n in used.items())
        if fill < capacity and fill & (fill - 1):
            whole = [s for s, n in count.items() if n and s & (s - 1) and any(x[1] < 0 for x in lots[s])]
            spare = [s for s in whole if s != top]
            if whole and broken(max(spare or whole), times):
                continue
            used, fill, times = {top: 1}, top, count[top]  # only powers of two are left
        offset = 0
        for size in sorted(used, reverse=True):
            put(size, used[size] * times, used[size], sequence, offset)
            offset += used[size] * size
        sequence += times


def _ranked(rows: DataFrame) -> DataFrame:
    """rows + rank among those of equal rest, and the number of full windows before."""
    n = rows.count()
    rows = rows.withColumn("bucket", F.pmod(F.xxhash64("doc_id", "doc_tokens", "rest_crc"), F.lit(parts_for(n, PER_BUCKET))))
    order = [F.col(c).asc_nulls_last() for c in ("doc_id", "doc_tokens", "rest_crc")]
    inside = rows.repartition("bucket").withColumn("rank", F.row_number().over(Window.partitionBy("bucket", "rest").orderBy(*order)) - 1).withColumn("ahead", F.sum(F.size("full")).over(Window.partitionBy("bucket").orderBy(*order, "rest").rowsBetween(Window.unboundedPreceding, -1)))
    counts = stash(rows.groupBy("bucket", "rest").agg(F.count("*").alias("n"), F.sum(F.size("full")).alias("w")))
    before = Window.orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    ranks = counts.select("bucket", "rest", F.coalesce(F.sum("n").over(Window.partitionBy("rest").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("rank0"))
    windows = counts.groupBy("bucket").agg(F.sum("w").alias("w")).select("bucket", F.coalesce(F.sum("w").over(before), F.lit(0)).alias("ahead0"))  # a row per bucket
    out = inside.join(ranks, ["bucket", "rest"]).join(windows, "bucket")
    return out.withColumn("rank", F.col("rank") + F.col("rank0")).withColumn("ahead", F.coalesce("ahead", F.lit(0)) + F.col("ahead0"))


PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


def pack(docs: DataFrame, path: str | None = None, capacity: int = CAPACITY, end: int = END) -> DataFrame:
    """docs(doc_id, text) -> a row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset."""
    return settled(lambda: _packed(docs, path, capacity, end))


def _packed(docs: DataFrame, path: str | None, capacity: int, end: int) -> DataFrame:
    rows = stash(tokenised(docs, path or default_tokenizer(), capacity, end))
    histogram = {r["rest"]: r["n"] for r in rows.filter("rest > 0").groupBy("rest").agg(F.count("*").alias("n")).collect()}  # at most one row per length
    places, packed = place(histogram, capacity)
    places = places[np.lexsort((places[:, 2], places[:, 1], places[:, 0]))]
    shared = docs.sparkSession.sparkContext.broadcast(places)  # bounded: lengths times pieces of a multiset

    def run(batches):
        p = shared.value
        kinds: dict[int, list] = {}
        bounds = np.flatnonzero(np.any(p[1:, :2] != p[:-1, :2], axis=1)) + 1 if len(p) else []
        for part in np.split(p, bounds) if len(p) else []:
            kinds.setdefault(int(part[0, 0]), []).append((int(part[0, 1]), part[:, 2].copy(), part))
        for batch in batches:
            out = []
            for doc, n, full, rest, crc, parts, rank, ahead in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                for i, x in enumerate(full):
                    out.append((doc, i * capacity, capacity, x, n, packed + ahead + i, 0))
                sizes = [1 << b for b in range(rest.bit_length() - 1, -1, -1) if rest >> b & 1]
                for part, lows, at in kinds.get(rest, ()) if rest else ():
                    i = int(np.searchsorted(lows, rank, "right")) - 1
                    if i < 0 or rank >= lows[i] + at[i, 3]:
                        continue
                    _, _, lo, _, k, m, first, offset = map(int, at[i])
                    q, size = k + rank - lo, rest if part < 0 else sizes[part]
                    out.append((doc, len(full) * capacity + (0 if part < 0 else sum(sizes[:part])), size, crc if part < 0 else parts[part], n, first + q // m, offset + q % m * size))
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in (zip(*out, strict=True) if out else [[]] * 7)], names=[x.split()[0] for x in PIECES.split(", ")])

    return _ranked(rows).select("doc_id", "doc_tokens", "full", "rest", "rest_crc", "parts", "rank", "ahead").mapInArrow(run, PIECES)


def op4_packing(spark, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"))
