"""Mixing sources to target weights by capped water-filling; DataFrame functions only.

A source's size is the number of words of its documents.  All words of the corpus are
shared out over the sources by weight; a source is clamped at `max_epochs` times its size
and what it can't take is reshared over the others by weight until none is above.  Each
source then takes its documents `whole` times, and the rest of its target as a prefix of a
seeded order of its documents; the last document of that prefix is taken in part, so a
source's words meet its target to the word.

Skew: sources are only ever pre-aggregated; the seeded order is cut by histograms of the
order key (two digits of 4096 values), so no source is gathered in one task.

Cases: null text has size 0; a null source is a source of its own and comes last; documents
of one source with equal order keys (repeated or null ids) share what is left at the cut in
proportion to their sizes, rounded down; an empty table gives an empty result; other columns
are left alone.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from decisionloom.llm.common import RAW_WORD, settled, stash

DIGIT = 4096


def order_key(doc_id, seed: int):
    """60 bits of a seeded hash, as SQL engines with md5 can repeat them."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("")))
    return F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("long")


def source_weights(sources: DataFrame, weights: tuple[int, ...], order: str = "source") -> DataFrame:
    """Add `weight`: the given weights, repeating, over the sources in code-point order, null last.

    The rank is built from ranks within ranges, so it needs no single-partition sort.
    """
    ranged = stash(sources.repartitionByRange(8, F.col(order).asc_nulls_last()).withColumn("_part", F.spark_partition_id()))
    ranked = ranged.withColumn("_in", F.row_number().over(Window.partitionBy("_part").orderBy(F.col(order).asc_nulls_last())))
    before = ranged.groupBy("_part").agg(F.count("*").alias("_n"))
    offsets = before.alias("a").join(before.alias("b"), F.col("b._part") < F.col("a._part"), "left").groupBy(F.col("a._part").alias("_part")).agg(F.coalesce(F.sum("b._n"), F.lit(0)).alias("_before"))  # at most 8 rows a side
    rank = F.col("_in") - 1 + F.col("_before")
    values = F.array(*[F.lit(int(w)) for w in weights])
    return ranked.join(offsets, "_part").withColumn("weight", F.element_at(values, (rank % len(weights) + 1).cast("int"))).drop("_part", "_in", "_n", "_before")


def water_fill(sources: DataFrame, max_epochs: int) -> DataFrame:
    """sources(source, source_size, weight) -> + target.

    Each round clamps the sources above their cap and raises the level of the others; only the
    round's sums reach the driver.
    """
    cap = F.col("source_size") * max_epochs
    total = sources.agg(F.coalesce(F.sum("source_size"), F.lit(0)).alias("t")).first()["t"]
    level, clamped = 0.0, -1
    while True:
        over = F.lit(level) * F.col("weight") > cap
        s = sources.agg(F.count_if(over).alias("n"), F.coalesce(F.sum(F.when(over, cap)), F.lit(0)).alias("c"), F.coalesce(F.sum(F.when(~over, F.col("weight"))), F.lit(0)).alias("w")).first()
        if s["n"] == clamped or not s["w"]:
            break
        clamped, level = s["n"], float(total - s["c"]) / float(s["w"])
    return sources.withColumn("target", F.least(cap.cast("double"), F.lit(level) * F.col("weight")))


def _at(run: DataFrame, need: DataFrame) -> DataFrame:
    """The row of each source whose running sum reaches the source's need; need becomes what was missing before it."""
    run = run.withColumn("upto", F.sum("words").over(Window.partitionBy("source").orderBy("place").rowsBetween(Window.unboundedPreceding, 0)))
    need = need.select(F.col("source").alias("_s"), "need")
    before = F.col("upto") - F.col("words")
    hit = run.join(need, run["source"].eqNullSafe(F.col("_s"))).filter((F.col("upto") >= F.col("need")) & (before < F.col("need")))
    return hit.select("source", "place", "words", (F.col("need") - before).alias("need"))


def _cut(sizes: DataFrame, sources: DataFrame) -> DataFrame:
    """For each source: cut, rest, tied.  Documents whose key is below cut are taken once more; those at it share rest words of tied."""
    need = sources.filter(F.col("need") > 0).select("source", "need")
    rows = sizes.filter(F.col("size") > 0)
    for digit in (F.shiftright("key", 48), F.shiftright("key", 36).bitwiseAND(F.lit(DIGIT - 1))):
        keyed = rows.withColumn("place", digit)
        need = stash(_at(keyed.groupBy("source", "place").agg(F.sum("size").alias("words")), need))
        here = need.select(F.col("source").alias("_s"), F.col("place").alias("_p"))
        rows = keyed.join(here, keyed["source"].eqNullSafe(F.col("_s")) & (F.col("place") == F.col("_p")), "left_semi").drop("place")
    ties = rows.groupBy("source", F.col("key").alias("place")).agg(F.sum("size").alias("words"))
    return _at(ties, need).select(F.col("source").alias("_s"), F.col("place").alias("cut"), F.col("need").alias("rest"), F.col("words").alias("tied"))


def plan_sources(sizes: DataFrame, weights: tuple[int, ...], max_epochs: int) -> DataFrame:
    """sizes(source, size, key) -> source, source_size, weight, target, whole, need, cut, rest, tied."""
    sources = source_weights(sizes.groupBy("source").agg(F.sum("size").alias("source_size")), weights)
    filled = water_fill(stash(sources), max_epochs)
    size = F.col("source_size")
    whole = F.when(size > 0, F.floor(F.col("target") / size)).otherwise(F.lit(0)).cast("long")
    filled = stash(filled.withColumn("whole", whole).withColumn("need", F.floor(F.col("target") - F.col("whole") * size + F.lit(0.5)).cast("long")))
    return stash(filled.join(cut := _cut(sizes, filled), filled["source"].eqNullSafe(cut["_s"]), "left").drop("_s"))


def measured(docs: DataFrame, seed: int) -> DataFrame:
    return docs.select("doc_id", "source", F.coalesce(F.regexp_count("text", F.lit(RAW_WORD)), F.lit(0)).cast("long").alias("size"), order_key(F.col("doc_id"), seed).alias("key"))


#: Words of a document in the seeded prefix of its source, from the plan's columns under a prefix that clashes with no other name.
ONCE_MORE = "CASE WHEN _mix_key < _mix_cut THEN _mix_size WHEN _mix_key = _mix_cut THEN _mix_rest * _mix_size div _mix_tied ELSE 0 END"


def _joined(rows: DataFrame, sources: DataFrame) -> DataFrame:
    """rows(..., source, _mix_size, _mix_key) with their source's plan and _mix_more."""
    plan = sources.select(*[F.col(c).alias(f"_mix_{c}") for c in sources.columns])
    out = rows.join(plan, rows["source"].eqNullSafe(F.col("_mix_source")))
    return out.withColumn("_mix_more", F.expr(ONCE_MORE).cast("long"))


def mixing_plan(docs: DataFrame, weights: tuple[int, ...] = (1, 2, 3), max_epochs: int = 3, seed: int = 17) -> DataFrame:
    """docs(doc_id, text, source) -> one row per document: doc_id, size, source_size, target, taken."""
    return settled(lambda: _planned(docs, weights, max_epochs, seed))


def _planned(docs: DataFrame, weights: tuple[int, ...], max_epochs: int, seed: int) -> DataFrame:
    sizes = stash(measured(docs, seed))
    sources = plan_sources(sizes, weights, max_epochs)
    out = _joined(sizes.withColumnsRenamed({"size": "_mix_size", "key": "_mix_key"}), sources)
    taken = F.col("_mix_whole") * F.col("_mix_size") + F.col("_mix_more")
    return out.select("doc_id", F.col("_mix_size").alias("size"), F.col("_mix_source_size").alias("source_size"), F.col("_mix_target").alias("target"), taken.alias("taken"))


def mix_documents(docs: DataFrame, weights: tuple[int, ...] = (1, 2, 3), max_epochs: int = 3, seed: int = 17) -> DataFrame:
    """The mix itself: docs' columns, a row for each whole repetition and one more, with the first words, for a part.  n_chars, where there is one, follows the text."""
    sources = settled(lambda: plan_sources(stash(measured(docs, seed)), weights, max_epochs))
    doc = F.struct(*[docs[f"`{c}`"] for c in docs.columns]).alias("doc")  # so that no column clashes with the plan's
    size = F.coalesce(F.regexp_count(docs["text"], F.lit(RAW_WORD)), F.lit(0)).cast("long")
    sized = docs.select(doc, docs["source"].alias("source"), size.alias("_mix_size"), order_key(docs["doc_id"], seed).alias("_mix_key"))
    rows = _joined(sized, sources)
    copies = F.col("_mix_whole") + F.when(F.col("_mix_more") > 0, F.lit(1)).otherwise(F.lit(0))
    rows = rows.filter(copies > 0).withColumn("_mix_copy", F.explode(F.sequence(F.lit(1), copies.cast("int"))))
    part = (F.col("_mix_copy") > F.col("_mix_whole")) & (F.col("_mix_more") < F.col("_mix_size"))
    first = F.array_join(F.slice(F.regexp_extract_all("doc.text", F.lit(RAW_WORD), F.lit(0)), F.lit(1), F.col("_mix_more").cast("int")), " ")
    rows = rows.withColumn("_mix_text", F.when(part, first).otherwise(F.col("doc.text")))
    changed = {"text": F.col("_mix_text")}
    if "n_chars" in docs.columns:
        changed["n_chars"] = F.length("_mix_text").cast(docs.schema["n_chars"].dataType)
    return rows.select(*[changed.get(c, F.col(f"doc.`{c}`")).alias(c) for c in docs.columns])


def op9_mixing(spark, sf_dir: str) -> DataFrame:
    from decisionloom.llm.common import table

    return mixing_plan(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


OP9_SQL = r"""
WITH sizes AS (
  SELECT doc_id, source, CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size,
         CAST('0x' || substr(md5('17:' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 15) AS BIGINT) AS k
  FROM documents),
src AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size, (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS w
  FROM sizes GROUP BY source),
sorted AS (
  SELECT *, 3 * source_size AS cap,
         sum(3 * source_size) OVER s - 3 * source_size AS cap_before, sum(w) OVER s - w AS w_before,
         sum(source_size) OVER () AS t, sum(w) OVER () AS w_all
  FROM src WINDOW s AS (ORDER BY 3.0 * source_size / w, source NULLS LAST ROWS UNBOUNDED PRECEDING)),
level AS (
  SELECT max(CAST(t - cap_before AS DOUBLE) / CAST(w_all - w_before AS DOUBLE)) AS lam
  FROM sorted WHERE CAST(t - cap_before AS DOUBLE) / CAST(w_all - w_before AS DOUBLE) * w <= cap),
goal AS (
  SELECT source, source_size, least(CAST(cap AS DOUBLE), lam * w) AS target FROM sorted, level),
parts AS (
  SELECT *, CASE WHEN source_size > 0 THEN CAST(floor(target / source_size) AS BIGINT) ELSE 0 END AS whole FROM goal),
needs AS (SELECT *, CAST(floor(target - whole * source_size + 0.5) AS BIGINT) AS need FROM parts),
ties AS (SELECT source, k, sum(size) AS words FROM sizes GROUP BY source, k),
run AS (SELECT *, sum(words) OVER (PARTITION BY source ORDER BY k ROWS UNBOUNDED PRECEDING) AS upto FROM ties)
SELECT d.doc_id, d.size, n.source_size, n.target,
       CAST(n.whole * d.size + CASE WHEN r.upto <= n.need THEN d.size
            WHEN r.upto - r.words < n.need THEN (n.need - (r.upto - r.words)) * d.size // r.words ELSE 0 END AS BIGINT) AS taken
FROM sizes d JOIN needs n ON d.source IS NOT DISTINCT FROM n.source
JOIN run r ON r.source IS NOT DISTINCT FROM d.source AND r.k = d.k
"""
