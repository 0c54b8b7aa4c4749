"""Output that grows while documents finish: each micro-batch replaces the rows of its documents, so delivering one twice changes nothing."""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from decisionloom.operators.records import merge_targeted


def flush(batch: DataFrame, path: str, batch_id: int | None = None, key: str = "doc_id", partition: str = "source") -> None:
    """Merge a batch into the table at path: its documents' rows are replaced, those of others in its partitions kept.

    The table is a chain of whole versions, each a folder of partitions with a note of what it holds.
    A version is written beside the current one and becomes current by one rename of its note, so a
    crash leaves the last version as it was; partitions that a batch doesn't touch are read from
    where they are.  A batch that was delivered before (by its id) changes nothing.
    """
    spark = batch.sparkSession
    current = versions(spark, path)
    if batch_id is not None and current and batch_id in current["batches"]:
        return
    batch = batch.persist()
    try:
        touched = [r[0] for r in batch.select(partition).distinct().collect()]  # the sources of a batch
        if not touched:
            return
        held = dict(current["parts"]) if current else {}
        old = [held[p] for p in map(str, touched) if p in held]
        stored = spark.read.schema(batch.schema).parquet(*old) if old else batch.limit(0)
        merged = merge_targeted(stored.select(*batch.columns), batch, batch, key)
        name = f"{path}/v-{uuid.uuid4().hex}"
        merged.withColumn("part", F.col(partition).cast("string")).write.partitionBy("part").parquet(name)
        held |= {str(p): f"{name}/part={p}" for p in touched}
        number = current["number"] + 1 if current else 1
        batches = [*(current["batches"] if current else [])[-KEPT:], *([] if batch_id is None else [batch_id])]
        _note(spark, path, {"number": number, "parts": held, "batches": batches})
    finally:
        batch.unpersist()


#: Ids of delivered batches that a version remembers; a stream delivers again the last one at most.
KEPT = 100


def _fs(spark, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place, place.getFileSystem(spark._jsc.hadoopConfiguration())


def _note(spark, path: str, version: dict) -> None:
    """Write a version's note beside and rename it: the rename makes the version current."""
    beside, fs = _fs(spark, f"{path}/_notes/.{uuid.uuid4().hex}")
    out = fs.create(beside, True)
    out.write(bytearray(json.dumps(version).encode()))
    out.close()
    place, _ = _fs(spark, f"{path}/_notes/{version['number']:012d}.json")
    if not fs.rename(beside, place):
        raise RuntimeError(f"version {version['number']} of {path} was written by another flush")


def versions(spark, path: str) -> dict | None:
    """The current version's note: number, parts (folder of each partition), batches."""
    place, fs = _fs(spark, f"{path}/_notes")
    if not fs.exists(place):
        return None
    names = sorted(str(f.getPath().toString()) for f in fs.listStatus(place) if f.getPath().getName().endswith(".json"))
    return json.loads(spark.read.text(names[-1], wholetext=True).first()[0]) if names else None


def read_table(spark, path: str, schema) -> DataFrame:
    """The current version's rows."""
    current = versions(spark, path)
    return spark.read.schema(schema).parquet(*current["parts"].values()) if current else spark.createDataFrame([], schema)


def start(finished: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Flush a stream of finished rows into the table at path."""
    return finished.writeStream.option("checkpointLocation", checkpoint).trigger(availableNow=True).foreachBatch(lambda df, n: flush(df, path, n)).start()
