"""Helpers that the operators of this subpackage share."""

from __future__ import annotations

import contextlib
import logging
import sys
import tempfile
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Word of a raw text: a run of anything but ASCII white space.
RAW_WORD = r"[^\x20\x09-\x0D]+"


def by_value(module: str) -> None:
    """Pickle a module's functions by value, so executors need no copy of this package."""
    cloudpickle.register_pickle_by_value(sys.modules[module])


by_value(__name__)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir; where that is unset, a folder in the warehouse, or in local mode (tests) a temporary one."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if found is None:
        local = spark.sparkContext.master.split("[")[0] == "local"
        found = tempfile.mkdtemp(prefix="decisionloom-") if local else f"{spark.conf.get('spark.sql.warehouse.dir')}/decisionloom-work"
        spark.sparkContext.setCheckpointDir(found)
    return found


#: Settings while a stash is written: its shuffle files go when it ends, and texts reach Python in batches of bounded size.
WHILE_WRITING = {
    "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
    "spark.sql.execution.arrow.maxRecordsPerBatch": "1000",
    "spark.sql.execution.arrow.maxBytesPerBatch": str(8 << 20),
}


#: Stashes made inside each settled() that is under way.
_MADE: list[list[DataFrame]] = []


@contextlib.contextmanager
def _while_writing(spark: SparkSession, records: int | None = None) -> Iterator[None]:
    settings = WHILE_WRITING | ({"spark.sql.execution.arrow.maxRecordsPerBatch": str(records)} if records else {})
    before = {k: spark.conf.get(k) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def stash(df: DataFrame, records: int | None = None) -> DataFrame:
    """Write df once to the shared folder and read it back: cuts the lineage, survives lost executors, and fixes the rows that later steps see.  records: rows of a batch for Python, where rows are small."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/stash-{uuid.uuid4().hex}"
    with _while_writing(spark, records):
        df.write.option("compression", "zstd").parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._stash = path
    if _MADE:
        _MADE[-1].append(out)
    return out


def fetched(df: DataFrame) -> pa.Table:
    """The rows of df, which are bounded, on the driver: as Arrow batches that only pass through the JVM; their shuffle files go when it ends."""
    with _while_writing(df.sparkSession):
        return df.select("*").toArrow()  # planned anew, under these settings


def settled(make: Callable[[], DataFrame], records: int | None = None) -> DataFrame:
    """The rows that make() returns, written once; every other stash that it made is deleted."""
    _MADE.append([])
    out = None
    try:
        out = stash(make(), records)
    finally:
        release(*[x for x in _MADE.pop() if x is not out])
    if _MADE:
        _MADE[-1].append(out)
    return out


def release(*stashed: DataFrame) -> None:
    """Delete stashes that nothing reads any more."""
    for df in stashed:
        spark = df.sparkSession
        path = spark._jvm.org.apache.hadoop.fs.Path(df._stash)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def row_key(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> list:
    """Columns did (the id, the largest number for null) and raw (a 64-bit hash of the text): rows that agree in both hold one document."""
    return [F.coalesce(docs[id_column].cast("long"), F.lit(LAST)).alias("did"), F.xxhash64(docs[text_column].cast("binary")).alias("raw")]


def keyed(docs: DataFrame) -> DataFrame:
    """doc (a struct of all columns of docs, so that none clashes with ours), did and raw."""
    return docs.select(F.struct(*[docs[f"`{c}`"] for c in docs.columns]).alias("doc"), *row_key(docs))


def without(rows: DataFrame, keys: DataFrame, *more: str) -> DataFrame:
    """Rows of keyed() whose key (did, raw and more) is not among the keys."""
    return rows.join(few(keys), ["did", "raw", *more], "left_anti")


#: Stands for a null id in keys; after all others.
LAST = (1 << 63) - 1

#: Rows of a few fixed-width columns (tens of bytes each) up to which one side of a join is broadcast; beyond it both are shuffled.
FEW = 100_000


def few(df: DataFrame) -> DataFrame:
    """df, to be broadcast if it is counted to have few rows."""
    return F.broadcast(df) if df.limit(FEW + 1).count() <= FEW else df


def ascii_lower(col):
    """Lower-case A-Z and nothing else."""
    return F.translate(col, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def parts_for(rows: int, per_part: int, least: int = 8) -> int:
    """How many parts keep each at about per_part rows."""
    return max(least, -(-rows // per_part))


def held_out(doc_id, folds: int, fold: int):
    """Whether a document is kept from training: crc32 of its id as text, modulo folds, is fold; a null id is not held out."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % folds == fold, F.lit(False))


#: Characters of all texts of a sample together.
SAMPLE_CHARS = 32_000_000


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, folds: int, fold: int, per_class: dict[int, int], columns: tuple[str, ...] = (), most: int = SAMPLE_CHARS) -> list:
    """At most per_class labelled documents outside the held-out fold, in a hashed order, without those whose text would pass `most` characters in all (counted in a warning): rows (label, text, *columns) on the driver.

    A document that is labelled twice counts with its larger label; null ids, labels and texts are left out.
    """
    own = labels.select(F.col("doc_id").alias("id"), F.col(label).cast("int").alias("y")).filter(F.col("id").isNotNull() & F.col("y").isin(*per_class))
    own = own.filter(~held_out(F.col("id"), folds, fold)).groupBy("id").agg(F.max("y").alias("y"))
    kept = None
    for y, n in sorted(per_class.items()):
        one = own.filter(F.col("y") == y).orderBy(F.xxhash64("id"), "id").limit(n)
        kept = one if kept is None else kept.unionByName(one)
    kept = stash(kept)  # a bounded number of ids
    texts = docs.select(F.col("doc_id").alias("id"), F.col("text"), *[F.col(c).alias(f"with_{c}") for c in columns]).filter(F.col("text").isNotNull())
    found = stash(texts.join(F.broadcast(kept), "id").withColumn("chars", F.length("text")).withColumn("h", F.xxhash64("id")))
    total, chosen, skipped = 0, [], 0
    for r in found.groupBy("h").agg(F.sum("chars").alias("n")).orderBy("h").collect():  # a row per document of the sample
        if total + r["n"] > most:
            skipped += 1
            continue
        total += r["n"]
        chosen.append((r["h"],))
    if skipped:
        logging.getLogger(__name__).warning("%d labelled documents of %d left out of the sample, which holds %d characters of at most %d", skipped, skipped + len(chosen), total, most)
    own = docs.sparkSession.createDataFrame(chosen, "h long")
    rows = found.join(F.broadcast(own), "h").select("id", "y", "text", *[f"with_{c}" for c in columns]).collect()
    release(kept, found)
    return [tuple(r)[1:] for r in sorted(rows, key=lambda r: (r["id"], r["text"]))]
