"""From paragraphs to chunks: ownership, runs, gaps, packing folds, offsets, fragments.

Paragraphs are rows (doc, para, text).  Folds over a document run inside its row, on an array in
order, so a document is the unit of work and nothing is gathered beyond it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from decisionloom.functions import text, vocab


def paragraphs(docs: DataFrame, keys: list[str], column: str = "text") -> DataFrame:
    """keys, para (from 1), text."""
    rows = docs.select(*keys, text.lines(F.col(column)).alias("_p")).select(*keys, F.posexplode_outer("_p").alias("para", "text"))  # outer: else Spark adds a filter that cuts the text twice more
    return rows.filter("para IS NOT NULL").withColumn("para", F.col("para") + 1)


def ordered(df: DataFrame, keys: list[str], order: str, value: str) -> DataFrame:
    """keys, values: an array in order, one document a row."""
    return df.groupBy(*keys).agg(F.transform(F.array_sort(F.collect_list(F.struct(order, value))), lambda s: s[value]).alias("values"))


def pack_groups(lengths: Column, cap: int) -> Column:
    """Group number (from 1) of each length: a group is closed when the next, with one separator, would pass the cap."""
    start = F.struct(F.lit(0).alias("g"), F.lit(0).cast("long").alias("used"), F.array().cast("array<int>").alias("all"))

    def step(acc, n):
        n = n.cast("long")
        fresh = (acc["g"] == 0) | (acc["used"] + 1 + n > cap)
        g = F.when(fresh, acc["g"] + 1).otherwise(acc["g"])
        return F.struct(g.alias("g"), F.when(fresh, n).otherwise(acc["used"] + 1 + n).alias("used"), F.concat(acc["all"], F.array(g)).alias("all"))

    return F.aggregate(lengths, start, step)["all"]


def window_groups(lengths: Column, paragraphs: int = vocab.WINDOW_PARAGRAPHS, chars: int = vocab.WINDOW_CHARS) -> Column:
    """Request windows: at most so many paragraphs and characters; a long paragraph stands alone."""
    start = F.struct(F.lit(0).alias("g"), F.lit(0).alias("n"), F.lit(0).cast("long").alias("used"), F.array().cast("array<int>").alias("all"))

    def step(acc, x):
        x = x.cast("long")
        fresh = (acc["g"] == 0) | (acc["n"] >= paragraphs) | (acc["used"] + x > chars)
        g = F.when(fresh, acc["g"] + 1).otherwise(acc["g"])
        return F.struct(g.alias("g"), F.when(fresh, F.lit(1)).otherwise(acc["n"] + 1).alias("n"), F.when(fresh, x).otherwise(acc["used"] + x).alias("used"), F.concat(acc["all"], F.array(g)).alias("all"))

    return F.aggregate(lengths, start, step)["all"]


def merge_groups(lengths: Column, target: int) -> Column:
    """A group is closed once it reaches the target."""
    start = F.struct(F.lit(1).alias("g"), F.lit(0).cast("long").alias("used"), F.array().cast("array<int>").alias("all"))

    def step(acc, n):
        used = acc["used"] + n.cast("long")
        return F.struct(F.when(used >= target, acc["g"] + 1).otherwise(acc["g"]).alias("g"), F.when(used >= target, F.lit(0).cast("long")).otherwise(used).alias("used"), F.concat(acc["all"], F.array(acc["g"])).alias("all"))

    return F.aggregate(lengths, start, step)["all"]


def batch_groups(lengths: Column, budget: int, most: int) -> Column:
    """Batches of sorted lengths: size times the longest squared stays within the budget, and at most so many."""
    start = F.struct(F.lit(0).alias("g"), F.lit(0).cast("long").alias("n"), F.array().cast("array<int>").alias("all"))

    def step(acc, x):
        x = x.cast("long")
        fresh = (acc["g"] == 0) | (acc["n"] >= most) | ((acc["n"] + 1) * x * x > budget)
        g = F.when(fresh, acc["g"] + 1).otherwise(acc["g"])
        return F.struct(g.alias("g"), F.when(fresh, F.lit(1).cast("long")).otherwise(acc["n"] + 1).alias("n"), F.concat(acc["all"], F.array(g)).alias("all"))

    return F.aggregate(F.array_sort(lengths), start, step)["all"]


def first_owner(segments: DataFrame, keys: list[str], para: str = "para", position: str = "seg") -> DataFrame:
    """segments(keys, seg, para) -> + owner: the first segment that lists the paragraph."""
    return segments.withColumn("owner", F.min(position).over(Window.partitionBy(*keys, para)))


def aliases(owned: DataFrame, keys: list[str]) -> DataFrame:
    """Segments that own nothing, and the segment their first paragraph went to."""
    per = owned.groupBy(*keys, "seg").agg(F.count_if(F.col("owner") == F.col("seg")).alias("own"), F.min_by("owner", "para").alias("alias"))
    return per.filter("own = 0").drop("own")


def gaps(covered: DataFrame, keys: list[str], last: str = "n", para: str = "para") -> DataFrame:
    """covered(keys, n, para) -> keys, lo, hi: runs of paragraphs 1..n that nothing covers."""
    docs = covered.select(*keys, last).distinct()
    every = docs.select(*keys, F.explode(F.sequence(F.lit(1), F.col(last).cast("int"))).alias(para))
    return islands(every.join(covered.filter(F.col(para).isNotNull()).select(*keys, para).distinct(), [*keys, para], "left_anti"), keys, para)


def islands(rows: DataFrame, keys: list[str], para: str = "para") -> DataFrame:
    """keys, lo, hi of runs of consecutive numbers."""
    numbered = rows.withColumn("_i", F.col(para) - F.row_number().over(Window.partitionBy(*keys).orderBy(para)))
    return numbered.groupBy(*keys, "_i").agg(F.min(para).alias("lo"), F.max(para).alias("hi")).drop("_i")


def range_text(ranges: DataFrame, keys: list[str]) -> DataFrame:
    """keys, ranges: '1-3, 5' in order."""
    one = F.when(F.col("lo") == F.col("hi"), F.col("lo").cast("string")).otherwise(F.concat_ws("-", F.col("lo").cast("string"), F.col("hi").cast("string")))
    return ranges.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct("lo", one.alias("s")))).alias("_r")).select(*keys, F.array_join(F.transform("_r", lambda r: r["s"]), ", ").alias("ranges"))


def runs(rows: DataFrame, keys: list[str], order: str, value: str) -> DataFrame:
    """Runs of equal values: keys, run, value, lo, hi, n."""
    w = Window.partitionBy(*keys).orderBy(order)
    broken = F.when(F.lag(value).over(w).eqNullSafe(F.col(value)) & (F.lag(order).over(w) == F.col(order) - 1), F.lit(0)).otherwise(F.lit(1))
    return rows.withColumn("_b", broken).withColumn("run", F.sum("_b").over(w)).groupBy(*keys, "run", value).agg(F.min(order).alias("lo"), F.max(order).alias("hi"), F.count("*").alias("n"))


def offsets(rows: DataFrame, keys: list[str], order: str, length: Column) -> DataFrame:
    """rows + start, end of each piece in the joined text, with one separator between pieces."""
    w = Window.partitionBy(*keys).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    return rows.withColumn("start", F.coalesce(F.sum(length + 1).over(w), F.lit(0)).cast("long")).withColumn("end", (F.col("start") + length).cast("long"))
