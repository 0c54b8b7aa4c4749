"""The vector cache and the paginated source."""

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from decisionloom.sources import cache, pages


def counted(calls):
    """An embedder that notes how many texts it was given."""

    def embed(batches):
        calls.append(batches.count())
        return batches.select("key", F.array(F.length("text").cast("double")).alias("vector"))

    return embed


def test_a_second_run_has_no_miss_and_a_crash_loses_nothing(spark, tmp_path):
    path, calls = str(tmp_path / "store"), []
    texts = spark.createDataFrame([(i, f"text {i % 7}" if i else None, 2048 if i % 2 else 512) for i in range(20)], "id int, text string, ceiling int")
    keys = texts.select(cache.key("m", F.col("ceiling"), F.col("text"))).distinct().count()
    vectors, took = cache.embedded(texts, path, "m", counted(calls))
    assert took.first()["misses"] == keys == calls[0] and vectors.filter("vector IS NULL").count() == 0
    vectors, took = cache.embedded(texts, path, "m", counted(calls))
    assert (took.first()["hits"], took.first()["misses"], took.first()["batches"], len(calls)) == (20, 0, 0, 1)
    spark.createDataFrame([("x", [1.0])], cache.STORED).write.parquet(f"{path}/v-lost")  # written, but its note never was
    assert cache.stored(spark, path).count() == keys
    more = texts.unionByName(texts.limit(0)).unionByName(spark.createDataFrame([(99, "new", 512)], "id int, text string, ceiling int"))

    def broken(batches):
        raise RuntimeError("the model is away")

    with pytest.raises(RuntimeError):
        cache.embedded(more, path, "m", broken)
    assert cache.stored(spark, path).count() == keys
    vectors, took = cache.embedded(more, path, "m", counted(calls))
    assert calls[-1] == took.first()["misses"] == 1 and {r["id"]: r["vector"] for r in vectors.collect()}[99] == [3.0]
    assert cache.embedded(more, path, "other", counted(calls))[1].first()["misses"] == keys + 1
    cache.grow(path, spark.createDataFrame([("k", [1.0]), ("k", [1.0])], cache.STORED))
    cache.grow(path, spark.createDataFrame([("k", [2.0])], cache.STORED))
    assert [r["vector"] for r in cache.stored(spark, path).filter("key = 'k'").collect()] == [[1.0]]


def test_batches_hold_the_budget(spark):
    rows = [(f"{i:x}" * 8, "x" * (37 * i % 40_000), 8192 if i % 3 else 2048) for i in range(400)]
    budget = 200_000_000
    made = cache.batched(spark.createDataFrame(rows, "key string, text string, ceiling int"), budget)
    by = made.groupBy("batch").agg(F.count("*").alias("n"), F.max("padded").alias("most"), F.min("padded").alias("least"), F.max("ceiling").alias("c"), F.countDistinct("ceiling").alias("cs")).collect()
    assert sum(r["n"] for r in by) == 400 and all(r["most"] == r["least"] and r["cs"] == 1 and r["most"] <= r["c"] for r in by)
    assert all(r["n"] == 1 or r["n"] * r["most"] ** 2 * 4 * cache.HEADS <= budget for r in by)
    assert any(r["n"] > 1 for r in by)


def test_pages_read_each_row_once_and_the_same_again(spark, tmp_path):
    table = pa.table({"id": pa.array([i if i % 50 else None for i in range(5000)], pa.int64()), "kind": [["a", "b", None][i % 3] for i in range(5000)], "text": ["t"] * 5000})
    (tmp_path / "s").mkdir()
    pq.write_table(table.slice(0, 3000), tmp_path / "s" / "0.parquet", row_group_size=700)
    pq.write_table(table.slice(3000), tmp_path / "s" / "1.parquet", row_group_size=5000)
    df = pages.scan(spark, str(tmp_path / "s"), ["id", "kind"], 512)
    assert df.columns == ["id", "kind"] and df.rdd.getNumPartitions() == 6
    assert sorted(map(repr, df.collect())) == sorted(map(repr, spark.createDataFrame(table.select(["id", "kind"]).to_pandas().astype({"id": "Int64"}).replace({float("nan"): None}).values.tolist(), "id long, kind string").collect()))
    assert df.filter("id >= 4990 AND kind = 'a'").count() == sum(i % 3 == 0 and i % 50 > 0 for i in range(4990, 5000))
    assert df.filter("kind IN ('a', 'b') AND id < 10").count() == sum(i % 3 < 2 and i % 50 > 0 for i in range(10))
    assert df.filter("id IS NULL").count() == 100 and df.filter("id > 10000").count() == 0
    reader = pages.PageReader(str(tmp_path / "s"), ["id"], 512)
    cursor = reader.partitions()[0]
    sizes = [b.num_rows for b in reader.read(cursor)]
    assert sizes == [512, 188] and [b.to_pylist() for b in reader.read(cursor)] == [b.to_pylist() for b in reader.read(cursor)]
    reader.filters = [pages.GreaterThan(("id",), 4000)]
    assert [c.file[-9:] for c in reader.partitions()] == ["1.parquet"]
