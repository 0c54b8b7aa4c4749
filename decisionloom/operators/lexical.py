"""Lexical retrieval: postings, Okapi BM25, ranking, fusion and guarded search.

Units are rows (unit, text); an optional pool column keeps statistics apart, so that a search
inside one pool sees only its own document frequencies.  Units are tokenised once: tokens meet the
distinct query terms, which are broadcast if they are counted to be few, and only those that match go
on, with one row that marks the unit; lengths are sizes of arrays.  Document frequencies, lengths and
scores come from the same grouped rows, so that Spark reuses their exchange instead of a cache.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from decisionloom.functions import text, vocab
from decisionloom.operators import patterns
from decisionloom.sources.folders import kept


def postings(units: DataFrame, terms: Column, keys: list[str]) -> DataFrame:
    """keys, term, tf, dl: one row per unit and term."""
    words = units.select(*keys, terms.alias("_terms"))
    return words.select(*keys, F.size("_terms").cast("long").alias("dl"), F.explode("_terms").alias("term")).groupBy(*keys, "dl", "term").agg(F.count("*").alias("tf"))


def statistics(units: DataFrame, terms: Column, pool: list[str]) -> DataFrame:
    """pool, n, avgdl."""
    return units.select(*pool, F.size(terms).alias("dl")).groupBy(*pool).agg(F.count("*").alias("n"), F.avg("dl").alias("avgdl"))


def inverse_frequency(n: Column, df: Column) -> Column:
    return F.log(1 + (n - df + 0.5) / (df + 0.5))


def term_score(tf: Column, dl: Column, avgdl: Column, k1: float = vocab.K1, b: float = vocab.B) -> Column:
    return tf * (k1 + 1) / (tf + k1 * (1 - b + b * dl / avgdl))


#: Rows of a few columns up to which one side of a join is broadcast; beyond it both sides are shuffled.
FEW = 200_000


def is_few(df: DataFrame) -> bool:
    return df.limit(FEW + 1).count() <= FEW


def few(df: DataFrame) -> DataFrame:
    """df, to be broadcast if it is counted to have few rows."""
    return F.broadcast(df) if is_few(df) else df


#: Stands for the unit itself among its terms; no token is empty.
UNIT = ""


def term_counts(units: DataFrame, terms: DataFrame, keys: list[str], options: dict | None = None) -> DataFrame:
    """keys, dl (tokens without stop words), all_dl, hit, tf: how often each unit holds each of the terms, and a row of each unit under UNIT."""
    options = dict(options or {})
    stop = options.pop("stop", None)
    tokens = F.coalesce(text.tokens(F.col("text"), **options), F.array().cast("array<string>"))
    length = F.size(F.filter("_t", lambda x: ~x.isin(*stop))) if stop else F.size("_t")
    own = units.select(*keys, tokens.alias("_t")).select(*keys, length.cast("long").alias("dl"), F.size("_t").cast("long").alias("all_dl"), "_t")  # before the rows of tokens, not for each
    rows = own.select(*keys, "dl", "all_dl", F.explode(F.concat("_t", F.array(F.lit(UNIT)))).alias("hit"))
    wanted = terms.select(F.col("term").alias("hit")).unionByName(terms.sparkSession.createDataFrame([(UNIT,)], "hit string"))
    return rows.join(few(wanted), "hit").groupBy(*keys, "dl", "all_dl", "hit").agg(F.count("*").alias("tf"))


def asked_terms(queries: DataFrame, options: dict | None = None) -> DataFrame:
    """The distinct terms of all queries."""
    return queries.select(F.explode(F.array_distinct(text.tokens(F.col("text"), **(options or {})))).alias("term")).distinct()


def frequencies(counts: DataFrame, pool: list[str] | None = None, length: str = "dl") -> DataFrame:
    """pool, hit, df, n, avgdl: in how many units each term stands, how many units there are and how long they are."""
    pool = pool or []
    by = counts.groupBy(*pool, "hit").agg(F.count("*").alias("df"), F.sum(length).alias("total"), F.sum("tf").alias("cf")).filter("cf > 0")  # true of all; with it the exchange is the same as for scores
    whole = Window.partitionBy(*(pool or [F.lit(0)]))  # a row per asked term
    of_units = lambda c: F.max(F.when(F.col("hit") == UNIT, F.col(c))).over(whole)
    return by.withColumn("n", of_units("df")).withColumn("avgdl", of_units("total") / F.col("n")).drop("total", "cf")


def bm25(units: DataFrame, queries: DataFrame, unit: str, query: str, pool: list[str] | None = None, options: dict | None = None, counts: DataFrame | None = None, length: str = "dl", within: list[str] | None = None) -> DataFrame:
    """units(unit, text), queries(query, text) -> query, unit, [within,] score, guarded (whether a term stands in fewer than half of the units); only units with a query term.

    Queries and units share the pool columns, if there are any.  counts: term_counts() of the units that hold all these terms, for
    searches that share them; length says which of its lengths counts.  Scores are rounded to 6 places.  Terms are dealt out by unit (or
    by within, columns of units that hold several), so a unit's scores are summed where its terms are and rows of a query and a term
    are never shuffled.
    """
    pool, options, within = pool or [], options or {}, within or []
    keys = [*pool, *within, unit]
    asked = queries.select(*pool, query, F.explode(F.array_distinct(text.tokens(F.col("text"), **options))).alias("hit"))
    if counts is None:
        counts = term_counts(units, asked_terms(queries, options), keys, options)
    weights = asked.join(frequencies(counts, pool, length), [*pool, "hit"])
    if is_few(asked):
        rows = counts.repartition(parts(counts), *(within or keys)).join(F.broadcast(weights), [*pool, "hit"])
    else:
        rows = counts.join(weights, [*pool, "hit"])
    score = inverse_frequency(F.col("n"), F.col("df")) * term_score(F.col("tf"), F.col(length), F.col("avgdl"))
    return rows.groupBy(query, unit, *pool, *within).agg(F.round(F.sum(score), 6).alias("score"), F.max(2 * F.col("df") < F.col("n")).alias("guarded"))


def parts(df: DataFrame) -> int:
    """Partitions of units that are scored: more than usual, since a unit has a row for every query."""
    return 2 * int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def better(scores: DataFrame, own: DataFrame, query: str, unit: str, pool: list[str] | None = None) -> DataFrame:
    """own(query, [pool,] at, own): a unit and its score, a few -> query, [pool,] at, rank: counted, so that no scores are put in order; ties to the smaller unit."""
    pool = pool or []
    ahead = (F.col("score") > F.col("own")) | ((F.col("score") == F.col("own")) & (F.col(unit) <= F.col("at")))
    return scores.join(few(own), [query, *pool]).filter(ahead).groupBy(query, *pool, "at").agg(F.count("*").alias("rank"))


def quoting(quotes: DataFrame, units: DataFrame, quote: str, unit: str) -> DataFrame:
    """quote, unit: units whose text holds a quote's text: one automaton over all quotes, in one pass over the texts, which are not shuffled."""
    own = quotes.select(quote, F.col("text").alias("said"))
    return patterns.holding(units, own, unit, "text", "said").select(quote, unit).distinct()


def ranked(scores: DataFrame, query: str, unit: str, k: int | None = None, by: str = "score") -> DataFrame:
    """scores + rank from 1, ties to the smaller unit; at most k a query."""
    order = Window.partitionBy(query).orderBy(F.desc(by), unit)
    out = scores.withColumn("rank", F.row_number().over(order).cast("long"))
    return out if k is None else out.filter(F.col("rank") <= k)


def distinctive(units: DataFrame, queries: DataFrame, unit: str, query: str, options: dict | None = None, counts: DataFrame | None = None) -> DataFrame:
    """query, term, df, distinctive: the term occurs, but in fewer than half of the units.  Only the queries' terms are counted."""
    asked = queries.select(query, F.explode(F.array_distinct(text.tokens(F.col("text"), **(options or {})))).alias("term"))
    if counts is None:
        counts = term_counts(units, asked.select("term").distinct(), [unit], options)
    seen = counts.groupBy("hit").agg(F.count("*").alias("df"))
    n = units.agg(F.count("*").alias("n"))
    out = asked.join(seen.withColumnRenamed("hit", "term"), "term", "left").crossJoin(n).withColumn("df", F.coalesce("df", F.lit(0)))
    return out.select(query, "term", "df", ((F.col("df") > 0) & (2 * F.col("df") < F.col("n"))).alias("distinctive"))


def fuse(lexical: DataFrame, vector: DataFrame, query: str, item: str, k: int = vocab.RRF, weights: tuple[float, float] = (1.0, 1.0)) -> DataFrame:
    """Reciprocal-rank fusion of two ranked lists (query, item, rank from 1): + rrf, source, rank.

    Items that a list repeats add up; empty items are skipped; ties go to the better lexical, then
    vector rank.  An item that only the vector list holds, but more than once, counts as "both".
    """

    def one(df: DataFrame, w: float, name: str) -> DataFrame:
        held = df.filter(F.col(item).isNotNull() & (F.col(item).cast("string") != ""))
        return held.groupBy(query, item).agg(F.sum(F.lit(w) / (F.lit(k) + F.col("rank"))).alias(f"s_{name}"), F.min("rank").alias(f"r_{name}"), F.count("*").alias(f"n_{name}"))

    both = one(lexical, weights[0], "lex").join(one(vector, weights[1], "vec"), [query, item], "full_outer")
    score = F.coalesce("s_lex", F.lit(0.0)) + F.coalesce("s_vec", F.lit(0.0))
    source = F.when(F.col("s_vec").isNull(), "lexical").when(F.col("s_lex").isNull() & (F.col("n_vec") == 1), "vector").otherwise("both")
    out = both.select(query, item, F.round(score, 9).alias("rrf"), source.alias("source"), "r_lex", "r_vec")
    order = Window.partitionBy(query).orderBy(F.desc("rrf"), F.asc_nulls_last("r_lex"), F.asc_nulls_last("r_vec"), item)
    return out.withColumn("rank", F.row_number().over(order).cast("long"))


def unit_to_document(ranks: DataFrame, query: str, document: str) -> DataFrame:
    """Ranks of units -> ranks of their documents, each at its best unit."""
    best = ranks.groupBy(query, document).agg(F.min("rank").alias("best"))
    return best.withColumn("rank", F.row_number().over(Window.partitionBy(query).orderBy("best", document)).cast("long"))
