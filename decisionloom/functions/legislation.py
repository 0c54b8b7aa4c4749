"""Laws that texts cite, by the places of words: all Spark expressions.

A text is a list of words, each with the white space before it, so that any stretch of words joins to what stands there.  A law
is anchored at its word "sayılı" after a number, the constitution at its genitive.  An anchor takes along only the words around
it; the law's word, the article and the paragraph are then looked for among these by their places: the law's word is the nearest
after the anchor in the same clause, an article is a word for one with a number beside it, and of several articles in reach the
more particular form comes first, then the nearer.

A null text cites nothing.  Of one provision that a text cites more than once the first place stays.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

FIELDS = ["canonical_id", "legislation_type", "law_no", "law_name", "article_no", "paragraph_no", "verbatim_mention", "law_date", "confidence"]

# Words of citations, in small letters, and what the constitution is called.
NUMBERED, DATED, AND = "sayılı", "tarihli", "ve"
LAW, DECREE, DECREE_WORDS = "kanun", "khk", ("hükmünde", "kararname")
CONSTITUTION, CONSTITUTION_NAME = "anayasa", "Türkiye Cumhuriyeti Anayasası"
GENITIVES = ["nın", "nin", "'nın", "'nin", "`nın", "`nin"]
ARTICLE, PARAGRAPH, OF_NUMBER = "madde", "fıkra", "numaralı"
ADDED = {"geçici": "Geçici", "ek": "Ek"}
CONNECTING = ["ve", "ile", "olan", "adlı"]
ORDINAL_ENDINGS = ["inci", "ıncı", "uncu", "üncü", "nci", "ncı"]
ORDINALS = ["birinci", "ikinci", "üçüncü", "dördüncü", "beşinci", "altıncı", "yedinci", "sekizinci", "dokuzuncu", "onuncu"]

#: Words before an anchor that it may need, and words after it that are taken along.
BEFORE, AFTER = 4, 150
#: Characters between an anchor and its law's word, from that to its article, from there to its paragraph, and to one of the constitution.
NAME, REACH, NEXT, CLOSE = 120, 150, 80, 30

#: A word with the white space before it; a number that is written together with an article's word is a word of its own.
WORD = r"\s*(?:\d+(?:/\p{L})?\s*\.?(?=\s*(?i:madde))|\S+)"


def small(c: Column) -> Column:
    """In small letters by Turkish rules, without white space around."""
    return F.lower(F.translate(F.trim(F.regexp_replace(c, r"\s+", " ")), "İI", "iı"))


def words_of(c: Column) -> Column:
    return F.regexp_extract_all(c, F.lit(WORD), F.lit(0))


def places(a: Column) -> Column:
    """0, 1, ... for each element; none for an empty or null array."""
    return F.filter(F.sequence(F.lit(0), F.greatest(F.coalesce(F.size(a), F.lit(0)), F.lit(1)) - 1), lambda i: i < F.size(a))


def number(c: Column, digits: str = r"\d+", rest: str = r"\s*\.?") -> Column:
    """The number that a word is, a point after it or not; null if it is none."""
    found = F.regexp_extract(c, rf"^({digits}){rest}$", 1)
    return F.when(found != "", found)


def upto(a: Column, n: Column) -> Column:
    """The first n elements, joined."""
    return F.array_join(F.slice(a, F.lit(1), F.greatest(n, F.lit(0)).cast("int")), "")


def law_name(raw: Column) -> Column:
    """A law's name without quotes, double spaces and the connecting word before it; null if nothing is left of it."""
    name = F.trim(F.regexp_replace(F.regexp_replace(raw, r"^[\s\"'`,;:]+|[\s\"'`,;:]+$", ""), r"\s+", " "))
    linked = small(F.substring_index(name, " ", 1)).isin(*CONNECTING) & name.contains(" ")
    name = F.when(linked, F.regexp_replace(name, r"^\S+ ", "")).otherwise(name)
    return F.when(F.length(name) > 2, name)


def is_ordinal(c: Column) -> Column:
    """The number before an ordinal ending, with an apostrophe or without."""
    return F.coalesce(*[number(c, rest=rf"['’ʼ]?{e}") for e in ORDINAL_ENDINGS])


def articles(w: Column, p: Column) -> Column:
    """Words and the same in small letters -> candidates (form, at, article): the words for an article that have its number beside them."""

    def at(i: Column) -> Column:
        last, next_ = F.get(p, i - 1), F.get(p, i + 1)
        kind = lambda c: reduce(lambda out, x: F.when(c == x[0], x[1]).otherwise(out), ADDED.items(), F.lit(None).cast("string"))
        lettered = F.regexp_extract(F.trim(F.get(w, i - 1)), r"^(\d+)\s*/", 1), F.upper(F.regexp_extract(F.trim(F.get(w, i - 1)), r"/\s*(\p{L})\s*\.?$", 1))
        forms = [
            F.concat_ws(" ", kind(last), F.regexp_extract(next_, r"^\d+", 0)), F.concat_ws(" ", kind(F.get(p, i - 2)), number(last)),
            F.concat_ws("/", *lettered), is_ordinal(last), number(last),
        ]
        holds = [kind(last).isNotNull() & next_.rlike(r"^\d"), kind(F.get(p, i - 2)).isNotNull() & number(last).isNotNull(), (lettered[0] != "") & (lettered[1] != ""), is_ordinal(last).isNotNull(), number(last).isNotNull()]
        form = reduce(lambda out, k: F.when(holds[k], k).otherwise(out), reversed(range(len(forms))), F.lit(None).cast("int"))
        article = reduce(lambda out, k: F.when(holds[k], forms[k]).otherwise(out), reversed(range(len(forms))), F.lit(None).cast("string"))
        return F.struct(form.alias("form"), F.when(form == 0, i + 1).otherwise(i).alias("at"), article.alias("article"))

    named = F.filter(places(p), lambda i: F.startswith(F.get(p, i), F.lit(ARTICLE)))
    return F.filter(F.transform(named, at), lambda x: x["form"].isNotNull())


def counted_paragraph(p: Column, i: Column) -> Column:
    """The number of "(2) numaralı fıkra" from word i on; null if it doesn't stand there."""
    found = F.regexp_extract(F.get(p, i), r"^\((\d+)\)$", 1)
    return F.when((found != "") & (F.get(p, i + 1) == OF_NUMBER) & F.startswith(F.get(p, i + 2), F.lit(PARAGRAPH)), found)


def paragraph(p: Column) -> Column:
    """The first paragraph that stands right after a word for an article: by number in brackets, by number, or by an ordinal word."""

    def at(i: Column) -> Column:
        ordinal = F.array_position(F.array(*map(F.lit, ORDINALS)), F.get(p, i))
        plain = F.coalesce(number(F.get(p, i)), F.when(ordinal > 0, ordinal.cast("string")))
        return F.coalesce(counted_paragraph(p, i), F.when(F.startswith(F.get(p, i + 1), F.lit(PARAGRAPH)), plain))

    named = F.filter(places(p), lambda i: F.startswith(F.get(p, i), F.lit(ARTICLE)))
    return F.get(F.filter(F.transform(named, lambda i: at(i + 1)), lambda x: x.isNotNull()), 0)


def anchored(rows: DataFrame, keys: list[str], text: Column) -> DataFrame:
    """keys, place, at (the anchor in w), w and p: the words around each anchor, and these in small letters."""
    words = rows.filter(F.contains(F.lower(text), F.lit("sayıl")) | F.contains(F.lower(text), F.lit("nayasa"))).select(*keys, words_of(text).alias("_w"))
    words = words.withColumn("_p", F.transform("_w", small))
    law = lambda i: (F.get("_p", i) == NUMBERED) & number(F.get("_p", i - 1), r"\d{3,5}", "").isNotNull()
    constitution = lambda i: F.get("_p", i).isin(*[CONSTITUTION + g for g in GENITIVES]) & F.startswith(F.get("_p", i + 2), F.lit(ARTICLE)) & number(F.get("_p", i + 1)).isNotNull()
    found = F.filter(places(F.col("_w")), lambda i: law(i) | constitution(i))
    first = lambda i: F.greatest(i - BEFORE, F.lit(0))
    around = F.transform(found, lambda i: F.struct(i.alias("place"), (i - first(i)).alias("at"), F.slice("_w", first(i) + 1, F.lit(BEFORE + AFTER)).alias("w")))
    return words.select(*keys, F.explode(around).alias("_a")).select(*keys, "_a.*").withColumn("p", F.transform("w", small))


def _laws(found: DataFrame, keys: list[str]) -> DataFrame:
    w, p, at = F.col("w"), F.col("p"), F.col("at")
    date = F.get(p, at - 4)
    dated = date.rlike(r"^\d{1,2}/\d{1,2}/\d{4}$") & (F.get(p, at - 3) == DATED) & (F.get(p, at - 2) == AND)
    days = F.split(date, "/")
    iso = F.concat_ws("-", F.get(days, 2), F.lpad(F.get(days, 1), 2, "0"), F.lpad(F.get(days, 0), 2, "0"))
    rest = found.filter(F.get(p, at) == NUMBERED).select(
        *keys, "place", F.get(p, at - 1).alias("law_no"), F.when(dated, iso).alias("law_date"),
        F.array_join(F.slice(w, F.when(dated, at - 3).otherwise(at), F.when(dated, F.lit(5)).otherwise(F.lit(2))), "").alias("head"),
        F.slice(w, at + 2, F.lit(AFTER)).alias("w"), F.slice(p, at + 2, F.lit(AFTER)).alias("p"),
    )
    is_law = F.transform("p", lambda x: F.startswith(x, F.lit(LAW)) | F.startswith(x, F.lit(DECREE)))
    rest = rest.withColumn("law", (F.array_position(is_law, True) - 1).cast("int"))
    clause = F.slice("p", F.lit(1), F.col("law"))
    rest = rest.filter((F.col("law") >= 0) & ~F.exists(clause, lambda x: x.rlike("[,;:]")) & (F.length(upto(F.col("w"), F.col("law"))) <= NAME + 1))
    decree = (F.get("p", F.col("law") + 1) == DECREE_WORDS[0]) & F.startswith(F.get("p", F.col("law") + 2), F.lit(DECREE_WORDS[1]))
    rest = rest.withColumn("name", upto(F.col("w"), F.col("law"))).withColumn("long", F.coalesce(decree, F.lit(False))).withColumn("last", F.when(F.col("long"), F.col("law") + 3).otherwise(F.col("law") + 1))
    rest = rest.withColumn("decree", F.col("long") | F.startswith(F.get("p", F.col("law")), F.lit(DECREE))).withColumn("named", upto(F.col("w"), F.col("last"))).withColumn("after", F.array_join(F.slice("w", F.col("last") + 1, F.lit(AFTER)), ""))
    rest = rest.withColumn("w", words_of(F.substring("after", 1, REACH))).withColumn("p", F.transform("w", small))
    rest = rest.withColumn("article", F.array_min(articles(F.col("w"), F.col("p"))))
    stem = F.regexp_extract(F.get("w", F.col("article.at")), r"^\s*(?:\d+|.{5})", 0)  # the article's word without its endings, or the number after it
    rest = rest.withColumn("to", F.when(F.col("article").isNull(), "").otherwise(F.concat(upto(F.col("w"), F.col("article.at")), stem)))
    near = F.transform(words_of(F.expr(f"substring(after, 1, length(to) + {NEXT})")), small)
    article = F.col("article.article")
    rest = rest.withColumn("paragraph_no", paragraph(near)).withColumn("article_no", article)
    key = F.concat(F.lit("law-"), F.col("law_no"), F.when(article.isNull(), "-unknown-article").otherwise(F.concat(F.lit("-art-"), F.regexp_replace(small(article), "[ /]", "-"))), F.coalesce(F.concat(F.lit("-p"), F.col("paragraph_no")), F.lit("")))
    return rest.select(
        *keys, F.lit(1).alias("kind"), "place", key.alias("canonical_id"), F.when(F.col("decree"), "decree_law").otherwise("statute").alias("legislation_type"), "law_no", law_name(F.col("name")).alias("law_name"),
        "article_no", "paragraph_no", F.trim(F.regexp_replace(F.concat("head", "named", "to"), r"^\s+", "")).alias("verbatim_mention"), "law_date", F.when(article.isNull(), "low").otherwise("high").alias("confidence"),
    )


def _constitution(found: DataFrame, keys: list[str]) -> DataFrame:
    at = F.col("at")
    rest = found.filter(F.get("p", at) != NUMBERED).select(*keys, "place", number(F.get("p", at + 1)).alias("article_no"), F.array_join(F.slice("w", at + 1, F.lit(3)), "").alias("named"), F.slice("w", at + 4, F.lit(CLOSE)).alias("w"), F.slice("p", at + 4, F.lit(CLOSE)).alias("p"))
    close = lambda i: (F.length(upto(F.col("w"), i)) <= CLOSE) & ~F.exists(F.slice("p", F.lit(1), i), lambda x: x.contains("."))
    hits = F.filter(places(F.col("p")), lambda i: counted_paragraph(F.col("p"), i).isNotNull() & close(i))
    rest = rest.withColumn("hit", F.get(hits, 0)).withColumn("paragraph_no", counted_paragraph(F.col("p"), F.col("hit")))
    mention = F.concat(F.col("named"), F.when(F.col("hit").isNull(), "").otherwise(upto(F.col("w"), F.col("hit") + 3)))
    key = F.concat(F.lit("constitution-art-"), F.col("article_no"), F.coalesce(F.concat(F.lit("-p"), F.col("paragraph_no")), F.lit("")))
    none = F.lit(None).cast("string")
    return rest.select(
        *keys, F.lit(0).alias("kind"), "place", key.alias("canonical_id"), F.lit("constitution").alias("legislation_type"), none.alias("law_no"), F.lit(CONSTITUTION_NAME).alias("law_name"),
        "article_no", "paragraph_no", F.regexp_replace(mention, r"^\s+", "").alias("verbatim_mention"), none.alias("law_date"), F.lit("high").alias("confidence"),
    )


def cited(rows: DataFrame, keys: list[str], text: Column) -> DataFrame:
    """keys, FIELDS, kind and place: each provision that a text cites, at its first place; kind 0, the constitution, comes before kind 1, statutes and decrees."""
    found = anchored(rows, keys, text)
    both = _constitution(found, keys).unionByName(_laws(found, keys))
    one = both.groupBy(*keys, "canonical_id").agg(F.min(F.struct("kind", "place", *FIELDS)).alias("_x"))
    return one.select(*keys, "_x.*")
