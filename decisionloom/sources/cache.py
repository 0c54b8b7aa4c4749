"""A store of vectors by key that grows by versions: texts whose vector is there are hits, the rest is embedded in batches and written back once.

A key is a hash of the model, the ceiling and the text, so a vector is never used under another ceiling.  A version is a folder of
new vectors beside the old ones; it counts as soon as its note is renamed into place, so a crash before that loses nothing that was
there, and a second run over the same texts finds them all.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from decisionloom.functions import vocab
from decisionloom.streaming.flush import _note, versions

STORED = "key string, vector array<double>"
#: Bytes that the attention of one batch may take, heads of the model, and the step to which lengths are padded.
BUDGET, HEADS, PAD = 1_500_000_000, 16, 64


def key(model: str, ceiling: Column, text: Column) -> Column:
    return F.sha2(F.concat_ws("|", F.lit(model), ceiling.cast("string"), F.coalesce(text, F.lit(""))), 256)


def stored(spark: SparkSession, path: str) -> DataFrame:
    """The current version's vectors."""
    current = versions(spark, path)
    return spark.read.schema(STORED).parquet(*current["parts"].values()) if current else spark.createDataFrame([], STORED)


def grow(path: str, new: DataFrame) -> None:
    """Add vectors (key, vector) as the next version; of a key that comes twice one is kept, keys that are there already stay as they are."""
    spark = new.sparkSession
    current = versions(spark, path)
    fresh = new.dropDuplicates(["key"]).join(stored(spark, path).select("key"), "key", "left_anti")
    name = f"{path}/v-{uuid.uuid4().hex}"
    fresh.select("key", "vector").write.parquet(name)
    number = current["number"] + 1 if current else 1
    _note(spark, path, {"number": number, "parts": (current["parts"] if current else {}) | {str(number): name}, "batches": []})


def tokens(text: Column, ceiling: Column) -> Column:
    """Tokens that the model sees of a text, estimated from its characters."""
    return F.least(F.greatest(F.ceil(F.length(F.coalesce(text, F.lit(""))) / vocab.CHARS_PER_TOKEN), F.lit(1)), ceiling).cast("long")


def capacity(padded: Column, budget: int = BUDGET, heads: int = HEADS) -> Column:
    """Texts of a padded length that fit one batch: attention takes heads x texts x length^2 x 4 bytes; one text always goes."""
    return F.greatest(F.floor(F.lit(budget) / (F.lit(4 * heads) * padded * padded)), F.lit(1)).cast("long")


def batched(misses: DataFrame, budget: int = BUDGET) -> DataFrame:
    """misses(key, text, ceiling) -> + padded, batch: texts of like length together, as many as the budget holds.

    Lengths and a digit of the key deal the texts out, so no length is gathered in one task.
    """
    n = tokens(F.col("text"), F.col("ceiling"))
    rows = misses.withColumn("padded", (F.ceil(n / PAD) * PAD).cast("long")).withColumn("_part", F.substring("key", 1, 1))
    place = F.row_number().over(Window.partitionBy("padded", "ceiling", "_part").orderBy("key")) - 1
    number = F.floor(place / capacity(F.col("padded"), budget))
    return rows.withColumn("batch", F.concat_ws("-", "padded", "ceiling", "_part", number.cast("string"))).drop("_part")


def looked_up(texts: DataFrame, path: str, model: str) -> DataFrame:
    """texts(id, text, ceiling) + key and vector, null where the store has none."""
    own = texts.withColumn("key", key(model, F.col("ceiling"), F.col("text")))
    return own.join(stored(texts.sparkSession, path), "key", "left")


def embedded(texts: DataFrame, path: str, model: str, embed: Callable[[DataFrame], DataFrame], budget: int = BUDGET) -> tuple[DataFrame, DataFrame]:
    """texts(id, text, ceiling) -> their vectors (id, key, vector), all from the store, and one row of what it took: texts, hits, misses, batches, peak.

    embed takes the batches (key, text, ceiling, padded, batch) and returns (key, vector); it is called once, for distinct misses.
    """
    spark = texts.sparkSession
    before = looked_up(texts, path, model)
    misses = batched(before.filter("vector IS NULL").dropDuplicates(["key"]).select("key", "text", "ceiling"), budget)
    plan = misses.groupBy("batch").agg(F.count("*").alias("n"), F.max("padded").alias("padded"))
    plan = plan.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("misses"), F.count("*").alias("batches"), F.coalesce(F.max(F.col("n") * F.col("padded") * F.col("padded") * 4 * HEADS), F.lit(0)).alias("peak"))
    took = before.agg(F.count("*").alias("texts"), F.count("vector").alias("hits")).crossJoin(plan).first()  # a row
    if took["misses"]:
        grow(path, embed(misses))
    report = spark.createDataFrame([tuple(took)], "texts long, hits long, misses long, batches long, peak long")
    return looked_up(texts, path, model).select("id", "key", "vector"), report
