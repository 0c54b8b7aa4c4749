"""Containment of sets: which holders hold all of a wanted set, and choices spread over strata."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def covering(wanted: DataFrame, holders: DataFrame, want: list[str], hold: list[str], within: list[str] | None = None) -> DataFrame:
    """wanted(want, within, items), holders(hold, within, items) -> want, within, hold: holders whose items hold all that is wanted.

    A wanted set meets only the holders of its rarest item, and these are then verified; an item's frequency is that among the
    holders (of the same within).  An empty or null wanted set is held by none.
    """
    within = within or []
    w = wanted.select(*want, *within, F.array_distinct(F.array_compact("items")).alias("_wanted")).filter(F.size("_wanted") > 0)
    h = holders.select(*hold, *within, F.array_distinct("items").alias("_held"))
    each = h.select(*hold, *within, F.explode("_held").alias("_item"))
    frequency = each.groupBy(*within, "_item").agg(F.count("*").alias("_df"))
    asked = w.select(*want, *within, "_wanted", F.explode("_wanted").alias("_item"))
    rarest = asked.join(frequency, [*within, "_item"], "left").groupBy(*want, *within, "_wanted").agg(F.min(F.struct(F.coalesce("_df", F.lit(0)).alias("_df"), "_item")).alias("_r"))
    keyed = rarest.filter("_r._df > 0").select(*want, *within, "_wanted", F.col("_r._item").alias("_item"))
    found = keyed.join(each, [*within, "_item"]).join(h, [*hold, *within])
    return found.filter(F.size(F.array_except("_wanted", "_held")) == 0).select(*want, *within, *hold)


def unshared_verdicts(verdicts: DataFrame, capsules: DataFrame, doc: str = "doc_id") -> DataFrame:
    """verdicts(doc, items, verdict) of sets of articles, capsules(doc, capsule, items, outcome) -> doc, items, verdict, capsules (how many cover the set), outcomes: verdicts that no capsule which covers their set shares."""
    named = verdicts.withColumn("_v", F.xxhash64(doc, "items", "verdict")).dropDuplicates([doc, "items", "verdict"])
    found = covering(named, capsules, ["_v"], ["capsule"], [doc]).join(capsules.select(doc, "capsule", "outcome"), [doc, "capsule"])
    by = found.groupBy(doc, "_v").agg(F.count("*").alias("capsules"), F.array_sort(F.collect_set("outcome")).alias("outcomes"))
    rows = named.join(by, [doc, "_v"], "left").withColumns({"capsules": F.coalesce("capsules", F.lit(0)), "outcomes": F.coalesce("outcomes", F.array().cast("array<string>"))})
    return rows.filter(~F.array_contains("outcomes", F.col("verdict"))).select(doc, "items", "verdict", "capsules", "outcomes")


def quotas(sizes: DataFrame, n: int, strata: list[str], order: str) -> DataFrame:
    """sizes(strata, size, order) -> + quota: n rows dealt round robin, a stratum that has no more being passed over; the last, incomplete round goes by order.

    A row a stratum: all strata together are few.
    """
    up = Window.partitionBy(F.lit(0)).orderBy("size", order, *strata)
    rows = sizes.withColumn("_i", F.row_number().over(up) - 1).withColumn("_before", F.sum("size").over(up.rowsBetween(Window.unboundedPreceding, 0)) - F.col("size"))
    rows = rows.withColumn("_level", F.floor((F.lit(n) - F.col("_before")) / (F.count("*").over(Window.partitionBy(F.lit(0))) - F.col("_i"))))
    rounds = rows.withColumn("_rounds", F.greatest(F.coalesce(F.max(F.when(F.col("_level") < F.col("size"), F.col("_level"))).over(Window.partitionBy(F.lit(0))), F.lit(n)), F.lit(0)))
    dealt = rounds.withColumn("quota", F.least("size", "_rounds"))
    more = F.lit(n) - F.sum("quota").over(Window.partitionBy(F.lit(0)))
    open_ = F.row_number().over(Window.partitionBy(F.lit(0)).orderBy(F.col("size") <= F.col("_rounds"), order, *strata))
    return dealt.withColumn("quota", (F.col("quota") + F.when((F.col("size") > F.col("_rounds")) & (open_ <= more), 1).otherwise(0)).cast("long")).select(*sizes.columns, "quota")


def seeded(seed: int, *columns: str):
    """A seeded order that other engines repeat."""
    return F.md5(F.concat_ws(":", F.lit(str(seed)), *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in columns]))


def spread(rows: DataFrame, strata: list[str], key: str, n: int, seed: int) -> DataFrame:
    """n rows, dealt round robin over the strata; inside a stratum in a seeded order.  Rows are ranked inside strata, up to n, and nowhere else."""
    sizes = rows.groupBy(*strata).agg(F.count("*").alias("size")).withColumn("_order", seeded(seed, *strata))
    dealt = quotas(sizes, n, strata, "_order").select(*[F.col(c).alias(f"_{c}") for c in strata], "quota")
    inside = rows.withColumn("_turn", F.row_number().over(Window.partitionBy(*strata).orderBy(seeded(seed, key), key))).filter(F.col("_turn") <= n)
    same = None
    for c in strata:
        one = F.col(c).eqNullSafe(F.col(f"_{c}"))
        same = one if same is None else same & one
    return inside.join(F.broadcast(dealt), same).filter(F.col("_turn") <= F.col("quota")).select(*rows.columns)
