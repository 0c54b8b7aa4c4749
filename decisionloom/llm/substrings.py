"""Removing passages that repeat, by suffix trees partitioned by prefixes of variable length.

Words covered by a window (20 words) that also stands earlier are removed.  The corpus's suffix
tree is never built whole:

* Suffixes begin at anchors: the anchor of a window is the least hash among its seven-word grams,
  so equal windows have equal anchors at equal places, and every repeat of a window's length holds
  one.  The words before an anchor are kept with its suffix, as a repeat may begin up to 13 words
  before it.  Suffixes whose first seven words stand once in the corpus are leaves and go no further.
* Suffixes are dealt out by a prefix: the words that all their windows share, seven of them at
  first.  A prefix with more suffixes than memory should hold is cut at random into parts; each
  part's tree settles what repeats inside it, and only the first place of each of its windows goes
  on, under longer prefixes (half of the windows each, up to whole windows), until all groups fit.
* A group's tree is built from the root by levels: at each depth, suffixes of one node are parted by
  their next word.  The nodes' leaves are parted by the words before the anchor in the same way, so
  that a node of depth d and l words on the left, d + l = 20, is a window; with two leaves or more it
  is a repeat.  Neighbouring ones of a document join to the maximal repeats.

Words are compared as words.  Hashes only choose candidates and, as 128 bits of SHA-256, tell which
documents are one word sequence; those are one node of the input: the first keeps what its windows
say, every later one is covered whole by it.

Cases: null texts have no words; a document of fewer words than a window loses nothing; the order
is by doc_id, null last, then (ids that repeat with other words) by a digest of the words, then by
start; rows that repeat an id and its text share a result; other columns are ignored, whatever
their names; an empty table gives an empty result; texts of any length are taken whole.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from decisionloom.llm.common import LAST, by_value, few, keyed, release, row_key, stash, table

by_value(__name__)

WINDOW, GRAM = 20, 7
#: Suffixes of a prefix that one tree holds at most, and suffixes whose trees are built side by side.
MEMORY, SIDE_BY_SIDE = 8_000, 16_000
#: Words whose grams are searched for the least one at a time.
BLOCK, PLACE = 1 << 20, np.uint64(24)
#: Bytes of texts whose words are hashed at a time.
BYTES = 1 << 20

_M1, _M2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)
_BASE, _LONG = 0xD6E8FEB86659FD93, 1 << 12


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * _M1
    x = (x ^ (x >> np.uint64(29))) * _M2
    return x ^ (x >> np.uint64(32))


def _powers() -> np.ndarray:
    factors = np.full(_LONG, _BASE, np.uint64)
    factors[0] = 1
    return factors.cumprod(dtype=np.uint64)


def word_hashes(joined: bytes, powers: np.ndarray) -> np.ndarray:
    """A hash of each word of a text whose words are joined by one space; a polynomial of its bytes."""
    data = np.frombuffer(joined, np.uint8)
    space = data == 32
    starts = np.concatenate([[0], np.flatnonzero(space) + 1])
    place = np.arange(len(data)) - np.repeat(starts, np.diff(np.append(starts, len(data))))
    terms = (data.astype(np.uint64) + np.uint64(1)) * powers[place % _LONG] + (place // _LONG).astype(np.uint64)
    terms[space] = 0
    return _mixed(np.add.reduceat(terms, starts))


def hashes_of(joined: bytes, powers: np.ndarray) -> np.ndarray:
    """word_hashes of a text of any length, in pieces that end at a space."""
    if len(joined) <= BYTES:
        return word_hashes(joined, powers)
    out, at = [], 0
    while at < len(joined):
        end = joined.rfind(b" ", at, at + BYTES) if at + BYTES < len(joined) else len(joined)
        if end <= at:
            end = joined.find(b" ", at)
            end = len(joined) if end < 0 else end
        out.append(word_hashes(joined[at:end], powers))
        at = end + 1
    return np.concatenate(out)


def anchors(h: np.ndarray, window: int):
    """Blocks of (start of the block, gram of the anchor, place of the anchor, first window, windows) arrays of a document's word hashes."""
    gram = min(GRAM, window)
    for lo in range(0, len(h) - window + 1, BLOCK):
        part = h[lo : lo + BLOCK + window - 1]
        n = len(part) - window + 1
        g = np.zeros(len(part) - gram + 1, np.uint64)
        for j in range(gram):
            g = _mixed(g + part[j : j + len(g)])
        low = (g >> PLACE << PLACE) | np.arange(len(g), dtype=np.uint64)
        span, have = window - gram + 1, 1
        while have * 2 <= span:
            low = np.minimum(low[:-have], low[have:])
            have *= 2
        if have < span:
            low = np.minimum(low[:n], low[span - have : span - have + n])
        at = (low[:n] & np.uint64((1 << 24) - 1)).astype(np.int64)
        first = np.flatnonzero(np.concatenate([[True], at[1:] != at[:-1]]))
        yield lo, g[at[first]].view(np.int64), at[first], first, np.diff(np.append(first, n))


def _twice_at_most(grams: np.ndarray) -> np.ndarray:
    u, n = np.unique(grams, return_counts=True)
    return np.concatenate([u, u[n > 1]])


def measured(docs: DataFrame, window: int) -> DataFrame:
    """doc_id, did (null last), raw (hash of the text), n_words, sha and digest (128 bits of it) of the words, grams of the anchors (one that a document holds more than once stands twice)."""

    def run(batches):
        powers = _powers()
        for batch in batches:
            out = []
            for text in batch.column(3):
                words = (text.as_py() or b"").split()
                joined = b" ".join(words)
                grams = [g for _, g, *_ in anchors(hashes_of(joined, powers), window)] if len(words) >= window else []
                out.append((len(words), hashlib.sha256(joined).digest(), _twice_at_most(np.concatenate(grams)) if grams else np.zeros(0, np.int64)))
            n, sha, grams = list(zip(*out, strict=True)) or [[]] * 3
            offsets = np.cumsum([0, *map(len, grams)])
            flat = pa.array(np.concatenate(grams) if len(grams) else np.zeros(0, np.int64), pa.int64())
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(n, pa.int64()), pa.array(sha, pa.binary()), pa.array([s[:16] for s in sha], pa.binary()), pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), flat)], names=["doc_id", "did", "raw", "n_words", "sha", "digest", "grams"])

    return docs.select(F.col("doc_id").cast("long"), *row_key(docs), F.col("text").cast("binary")).mapInArrow(run, "doc_id long, did long, raw long, n_words long, sha binary, digest binary, grams array<long>")


SUFFIX = "key long, did long, digest binary, start long, ahead int, windows int, words binary"


def _suffixes(hot: DataFrame, window: int) -> DataFrame:
    """hot(did, digest, grams, text) -> the suffixes whose first words repeat.

    key: their gram; start: first window; ahead: words of it before the anchor; windows: how many,
    the first at start; words: those of all these windows.
    """

    def run(batches):
        powers = _powers()
        for batch in batches:
            for did, digest, grams, text in zip(*(batch.column(i) for i in range(4)), strict=True):
                wanted = np.sort(np.asarray(grams.values.to_numpy(zero_copy_only=False), dtype=np.int64))
                joined = b" ".join(text.as_py().split())
                begin = None
                out: list[list] = [[], [], [], [], []]
                for lo, g, at, first, many in anchors(hashes_of(joined, powers), window):
                    hits = np.flatnonzero(wanted[np.minimum(np.searchsorted(wanted, g), len(wanted) - 1)] == g)
                    if not len(hits):
                        continue
                    if begin is None:
                        spaces = np.flatnonzero(np.frombuffer(joined, np.uint8) == 32)
                        begin = np.concatenate([[0], spaces + 1, [len(joined) + 1]])
                    f, m = first[hits], many[hits]
                    left, right = begin[lo + f].tolist(), (begin[lo + f + m + window - 1] - 1).tolist()
                    for column, values in zip(out, (g[hits], lo + f, at[hits] - f, m, [joined[a:b] for a, b in zip(left, right, strict=True)]), strict=True):
                        column.extend(values if isinstance(values, list) else values.tolist())
                n = len(out[0])
                if n:
                    key, start, ahead, many, words = out
                    yield pa.RecordBatch.from_arrays([pa.array(key, pa.int64()), pa.array([did.as_py()] * n, pa.int64()), pa.array([digest.as_py()] * n, pa.binary()), pa.array(start, pa.int64()), pa.array(ahead, pa.int32()), pa.array(many, pa.int32()), pa.array(words, pa.binary())], names=["key", "did", "digest", "start", "ahead", "windows", "words"])

    return hot.select("did", "digest", "grams", "text").mapInArrow(run, SUFFIX)


class Trees:
    """Suffix trees of many prefixes side by side, by levels."""

    def __init__(self, group, ahead, windows, words: list[bytes], window: int):
        """Rows in the order of their group and, within it, of their place."""
        self.window = window
        codes: dict[bytes, int] = {}
        split = [w.split(b" ") for w in words]
        flat = np.fromiter((codes.setdefault(x, len(codes)) for w in split for x in w), np.int64)
        size = np.fromiter(map(len, split), np.int64, len(split))
        begin = np.cumsum(size) - size
        self.codes, self.flat, self.group = len(codes) + 1, flat, group
        self.ahead, self.least = ahead, ahead - windows + 1
        self.anchor, self.left, self.right = begin + ahead, ahead, size - ahead

    def _part(self, node: np.ndarray, word: np.ndarray) -> np.ndarray:
        """Nodes of the next level: those of equal parents and words."""
        return np.unique(node * self.codes + word, return_inverse=True)[1]

    def repeats(self, low: int, high: int) -> tuple[np.ndarray, np.ndarray]:
        """Whether the window with l words before the anchor, l from low to high, is a suffix's own, and whether it stands at an earlier place."""
        n, reach = len(self.group), min(high, int(self.ahead.max(initial=0)))
        own, again = np.zeros((n, high + 1), bool), np.zeros((n, high + 1), bool)
        before = [np.zeros(n, np.int64)]
        for l in range(reach):
            got, node = self.left > l, np.full(n, -1, np.int64)
            node[got] = self._part(before[-1][got], self.flat[self.anchor[got] - 1 - l])
            before.append(node)
        rows, node = np.arange(n), self.group.astype(np.int64)
        for depth in range(1, self.window - low + 1):
            fit = self.right[rows] >= depth
            rows = rows[fit]
            if not len(rows):
                break
            node = self._part(node[fit], self.flat[self.anchor[rows] + depth - 1])
            l = self.window - depth
            if l <= reach:
                held = (self.least[rows] <= l) & (l <= self.ahead[rows])
                mine = rows[held]
                own[mine, l] = True
                if len(mine):
                    _, first, which = np.unique(node[held] * n + before[l][mine], return_index=True, return_inverse=True)
                    again[mine, l] = first[which] != np.arange(len(mine))
        return own, again


def _grown(rows: DataFrame, low: int, high: int, window: int) -> DataFrame:
    """rows(key, part, open, did, digest, start, ahead, windows, words) -> what their trees tell.

    kind 0: a covered range (digest, start, end).  kind 1, for suffixes of open prefixes: the windows
    that come first in their tree, under the longer prefixes of the two halves of low..high.
    """
    middle = (low + high) // 2
    halves = [(low, middle), (middle + 1, high)] if low < high else [(low, high)]

    def prefix(words: list[bytes], anchor: int, least: int, most: int) -> int:
        name = b" ".join([b"%d" % least, *words[anchor - least : anchor + window - most]])
        return int.from_bytes(hashlib.blake2b(name, digest_size=8).digest(), "little", signed=True)

    def settle(columns):
        key, part, open_, did, digest, start, ahead, windows, words = columns
        start, ahead, windows = (np.array(x, np.int64) for x in (start, ahead, windows))
        group = np.cumsum([i > 0 and (key[i], part[i]) != (key[i - 1], part[i - 1]) for i in range(len(key))])
        own, again = Trees(group, ahead, windows, words, window).repeats(low, high)
        out: list[list] = [[] for _ in range(9)]

        def put(*row):
            for column, value in zip(out, row, strict=True):
                column.append(value)

        hit = np.flatnonzero(again.any(1))
        if len(hit):
            least, most = again[hit].argmax(1), high - again[hit, ::-1].argmax(1)
            lo, hi = (start[hit] + ahead[hit] - most).tolist(), (start[hit] + ahead[hit] - least + window).tolist()
            for i, a, b in zip(hit.tolist(), lo, hi, strict=True):  # any two windows of one anchor overlap
                put(0, b, None, None, digest[i], a, None, None, None)
        for i in np.flatnonzero(open_).tolist():
            split = None
            for a, b in halves:
                first = [l for l in range(a, b + 1) if own[i, l] and not again[i, l]]
                if first:
                    split = split or words[i].split(b" ")
                    l0, l1, at = first[0], first[-1], int(ahead[i])
                    put(1, None, prefix(split, at, a, b), did[i], digest[i], int(start[i]) + at - l1, l1, l1 - l0 + 1, b" ".join(split[at - l1 : at - l0 + window]))
        kinds = [pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int32(), pa.int32(), pa.binary()]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, kinds, strict=True)], names=["kind", "end", "key", "did", "digest", "start", "ahead", "windows", "words"])

    def run(batches):
        held, last = [[] for _ in range(9)], None
        for batch in batches:
            columns = [c.to_pylist() for c in batch.columns]
            begin, n = 0, batch.num_rows
            for i in range(n):
                now = (columns[0][i], columns[1][i])
                if now != last and len(held[0]) + i - begin >= SIDE_BY_SIDE:
                    for h, c in zip(held, columns, strict=True):
                        h += c[begin:i]
                    yield settle(held)
                    held, begin = [[] for _ in range(9)], i
                last = now
            for h, c in zip(held, columns, strict=True):
                h += c[begin:]
        if held[0]:
            yield settle(held)

    ordered = rows.repartition("key", "part").sortWithinPartitions("key", "part", "did", "digest", "start")
    return ordered.select("key", "part", "open", "did", "digest", "start", "ahead", "windows", "words").mapInArrow(run, f"kind int, end long, {SUFFIX}")


def covered(suffixes: DataFrame, window: int, memory: int) -> list[DataFrame]:
    """Stashes of covered ranges (digest, start, end) from the trees of all prefixes, lengthened until each fits memory."""
    out, spans, memory = [], [(suffixes, 0, window - min(GRAM, window))], max(2, memory)
    turn = 0
    while spans:
        rows, low, high = spans.pop()
        turn += 1
        many = stash(rows.groupBy("key").agg(F.count("*").alias("n")).filter(F.col("n") > memory).select("key", F.ceil(F.col("n") / memory).cast("int").alias("parts")))
        again = not many.isEmpty()
        placed = rows.join(few(many), "key", "left").withColumn("part", F.coalesce(F.pmod(F.xxhash64(F.lit(turn), "did", "digest", "start"), F.col("parts")), F.lit(0)).cast("int")) if again else rows.withColumn("part", F.lit(0)).withColumn("parts", F.lit(None).cast("int"))
        told = stash(_grown(placed.withColumn("open", F.col("parts").isNotNull()), low, high, window))
        out.append(told)
        release(rows, many)
        if again:
            middle = (low + high) // 2
            for a, b in [(low, middle), (middle + 1, high)] if low < high else [(low, high)]:
                inside = (F.col("ahead") >= a) & (F.col("ahead") <= b)
                spans.append((stash(told.filter("kind = 1").filter(inside).select("key", "did", "digest", "start", "ahead", "windows", "words")), a, b))
    return out


def _cut(rows: DataFrame) -> DataFrame:
    """rows(digest, text, ranges) -> digest, n_removed, kept_sha, kept."""

    def run(batches):
        for batch in batches:
            out = []
            for digest, text, ranges in zip(*(batch.column(i) for i in range(3)), strict=True):
                words = text.as_py().split()
                gone = np.zeros(len(words) + 1, np.int64)
                lo, hi = (np.asarray(ranges.values.field(i)) for i in (0, 1))
                np.add.at(gone, lo, 1)
                np.add.at(gone, hi, -1)
                keep = np.flatnonzero(gone.cumsum()[:-1] == 0)
                kept = b" ".join([words[i] for i in keep])
                out.append((digest.as_py(), len(words) - len(keep), hashlib.sha256(kept).digest(), kept.decode()))
            cols = list(zip(*out, strict=True)) or [[]] * 4
            yield pa.RecordBatch.from_arrays([pa.array(cols[0], pa.binary()), pa.array(cols[1], pa.int64()), pa.array(cols[2], pa.binary()), pa.array(cols[3], pa.string())], names=["digest", "n_removed", "kept_sha", "kept"])

    return rows.select("digest", "text", "ranges").mapInArrow(run, "digest binary, n_removed long, kept_sha binary, kept string")


def _found(docs: DataFrame, window: int, texts_too: bool, memory: int) -> tuple[DataFrame, DataFrame]:
    """What was measured of each document, and (digest, n_removed, kept_sha, kept) of each first document that loses something."""
    rows = stash(measured(docs, window))
    firsts = rows.groupBy("digest").agg(F.min(F.struct("did", "raw")).alias("first"))
    own = rows.filter(F.size("grams") > 0).join(firsts, "digest").filter(F.struct("did", "raw") == F.col("first")).dropDuplicates(["digest"])
    grams = stash(own.select("digest", "did", "raw", F.explode("grams").alias("gram")))
    twice = stash(grams.groupBy("gram").agg(F.count("*").alias("n")).filter("n > 1").select("gram"))
    repeated = stash(grams.join(twice, "gram").groupBy("digest", "did", "raw").agg(F.collect_set("gram").alias("grams")))  # within one document
    release(grams, twice)
    texts = docs.select(*row_key(docs), F.col("text").cast("binary").alias("text"))
    hot = stash(texts.join(repeated, ["did", "raw"]).dropDuplicates(["did", "raw"]))
    release(repeated)
    told = covered(stash(_suffixes(hot, window)), window, memory)
    ranges = None
    for part in told:
        one = part.filter("kind = 0").select("digest", F.col("start").alias("lo"), F.col("end").alias("hi"))
        ranges = one if ranges is None else ranges.unionByName(one)
    ranges = ranges.groupBy("digest").agg(F.collect_list(F.struct("lo", "hi")).alias("ranges"))  # within one document
    cut = _cut(hot.join(ranges, "digest"))
    cut = stash(cut if texts_too else cut.withColumn("kept", F.lit(None).cast("string")))
    narrow = stash(rows.drop("grams"))
    release(rows, hot, *told)
    return narrow, cut


EMPTY = hashlib.sha256(b"").hexdigest()


def repeated_windows(docs: DataFrame, window: int = WINDOW, texts_too: bool = True, memory: int = MEMORY) -> DataFrame:
    """docs(doc_id, text) -> a row per document: doc_id, did, raw, n_words, n_removed, kept_sha256, kept (null: the words as they are, or texts aren't asked for)."""
    rows, cut = _found(docs, window, texts_too, memory)
    firsts = rows.groupBy("digest").agg(F.min("did").alias("first"))
    out = rows.join(firsts, "digest").join(cut, "digest", "left")
    later = (F.col("did") > F.col("first")) & (F.col("n_words") >= window)
    sha = F.lower(F.hex(F.coalesce("kept_sha", "sha")))
    return out.select("doc_id", "did", "raw", "n_words", F.when(later, F.col("n_words")).otherwise(F.coalesce("n_removed", F.lit(0))).cast("long").alias("n_removed"), F.when(later, F.lit(EMPTY)).otherwise(sha).alias("kept_sha256"), F.when(later, F.lit("")).otherwise(F.col("kept")).alias("kept"))


def remove_repeats(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """docs with the kept words as text where words were removed, their text elsewhere; n_chars, where there is one, follows."""
    changed = stash(repeated_windows(docs, window).filter("n_removed > 0").select("did", "raw", "kept").dropDuplicates(["did", "raw"]))
    out = keyed(docs).join(changed, ["did", "raw"], "left")
    text = F.coalesce("kept", "doc.text")
    columns = [F.col(f"doc.`{c}`") for c in docs.columns]
    for i, c in enumerate(docs.columns):
        if c == "text":
            columns[i] = text.alias("text")
        elif c == "n_chars":
            columns[i] = F.when(F.col("kept").isNotNull(), F.length(text)).otherwise(F.col("doc.n_chars")).cast(docs.schema["n_chars"].dataType).alias("n_chars")
    return out.select(*columns)


def op2_substring_dedup(spark, sf_dir: str) -> DataFrame:
    return repeated_windows(table(spark, sf_dir, "documents"), texts_too=False).select("doc_id", "n_words", "n_removed", "kept_sha256")
