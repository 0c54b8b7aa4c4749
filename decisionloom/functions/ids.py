"""Identifiers, citations, dates and other record fields as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from decisionloom.functions import text, vocab


def uuid5(namespace: str, name: Column) -> Column:
    """Name-based identifier, version 5."""
    h = F.sha1(F.concat(F.unhex(F.lit(namespace.replace("-", ""))), F.encode(name, "UTF-8")))
    variant = F.translate(F.substring(h, 17, 1), "0123456789abcdef", "89ab89ab89ab89ab")
    return F.concat_ws("-", F.substring(h, 1, 8), F.substring(h, 9, 4), F.concat(F.lit("5"), F.substring(h, 14, 3)), F.concat(variant, F.substring(h, 18, 3)), F.substring(h, 21, 12))


def doc_of_label(c: Column) -> Column:
    return F.substring_index(c, "-p", 1)


def paragraph_range(first: Column, last: Column) -> Column:
    return F.when(first == last, F.concat(F.lit("p"), first.cast("string"))).otherwise(F.concat(F.lit("p"), first.cast("string"), F.lit("_to_p"), last.cast("string")))


def int_or_null(c: Column) -> Column:
    return c.try_cast("int")


# Fixed value: how titles write a chamber's number.
CHAMBER = r"(\d{1,2})\s*\.\s*(?:[A-Za-zÇĞİÖŞÜçğıöşü]+\s+){0,3}?(?:Daire|Dairesi|Mahkemesi)"


def chamber(title: Column) -> Column:
    """First chamber number of a title, 1 to 50."""
    n = F.nullif(F.regexp_extract(title, CHAMBER, 1), F.lit("")).try_cast("int")
    return F.when(n.between(1, 50), n)


def year_no(year: Column, no: Column) -> Column:
    return F.when((year != 0) & (no != 0), F.concat_ws("/", year.cast("string"), no.cast("string")))


def article_key(c: Column) -> Column:
    """GEÇİCİ MADDE 3 and Geçici 3 -> geçici-3; 141 / A -> 141/a; nothing -> unknown."""
    s = text.tr_lower(text.norm_ws(F.coalesce(c, F.lit(""))))
    s = F.regexp_replace(s, r"\s*(?:maddesi|madde|md\.?|m\.)\s*", " ")
    s = F.regexp_replace(F.trim(s), r"\s*/\s*", "/")
    s = F.regexp_replace(F.trim(s), r"\s+", "-")
    return F.coalesce(F.nullif(s, F.lit("")), F.lit("unknown"))


def law_short(c: Column) -> Column:
    s = text.tr_upper(F.regexp_replace(c, r"[.\s]", ""))
    return F.when(s.rlike("^[A-ZÇĞİÖŞÜ]{2,8}$"), s)


def canonical_id(law_type: Column, law_no: Column, short: Column, name: Column, article: Column) -> Column:
    """Key of a provision: by the law's number, the constitution, the law's name, or its abbreviation; null without any."""
    key = article_key(article)
    has = lambda c: text.blank(c).isNotNull()
    number = F.coalesce(F.nullif(F.regexp_replace(law_no, "[^0-9]", ""), F.lit("")), law_no)
    named = F.trim(F.regexp_replace(text.tr_lower(name), "[^a-zçğıöşü0-9]+", "-"), F.lit("-"))
    out = F.when(has(law_no), number).when(law_type == "constitution", F.lit("constitution")).when(has(name), named).when(has(short), text.tr_lower(short))
    return F.concat(out, F.lit("/"), key)


def law_refs(canonical: Column, law_no: Column, short: Column, article: Column) -> Column:
    """Sorted distinct keys by which a citation can be found."""
    with_article = lambda c: F.when(article.isNotNull(), F.concat(c, F.lit("/"), article))
    keys = F.array(canonical, law_no, with_article(law_no), short, with_article(short))
    return F.array_sort(F.array_distinct(F.filter(keys, lambda x: x.isNotNull())))


def fold_opinion(kind: Column, authors: Column) -> Column:
    names = F.array_join(F.filter(F.transform(authors, text.slug), lambda x: x != ""), "+")
    return F.when(kind.isin("dissent", "concurring") & (names != ""), F.concat(kind, F.lit(":"), names)).otherwise(kind)


def is_separate(opinion: Column) -> Column:
    return F.substring_index(opinion, ":", 1).isin("dissent", "concurring")


def number_in(body: Column, number: Column) -> Column:
    """Whether the number stands in the text on its own."""
    return F.regexp_count(body, F.concat(F.lit(r"(?<!\d)\Q"), number, F.lit(r"\E(?!\d)"))) > 0


def iso_date(c: Column) -> Column:
    """d.m.y, d/m/y or d-m-y -> y-m-d, not validated against a calendar; ISO dates as they are."""
    p = r"(\d{1,2})[./-](\d{1,2})[./-](\d{4})"
    turned = F.when(c.rlike(p), F.concat_ws("-", F.regexp_extract(c, p, 3), F.lpad(F.regexp_extract(c, p, 2), 2, "0"), F.lpad(F.regexp_extract(c, p, 1), 2, "0")))
    return F.coalesce(F.nullif(F.regexp_extract(c, r"^(\d{4}-\d{2}-\d{2})", 1), F.lit("")), turned)


def ref_indices(refs: Column, n: Column) -> Column:
    """Sorted distinct paragraph numbers within 1..n of references such as p3."""
    ints = F.transform(refs, lambda r: F.nullif(F.regexp_extract(r, r"^p(\d+)$", 1), F.lit("")).try_cast("int"))
    return F.array_sort(F.array_distinct(F.filter(ints, lambda i: i.isNotNull() & (i >= 1) & (i <= n))))


def token_estimate(c: Column) -> Column:
    return F.length(c) / vocab.CHARS_PER_TOKEN


def hit_probability(pool: Column, accepted: Column, k: Column) -> Column:
    """Chance that k of a pool, drawn at random, hold an accepted one."""
    misses = F.aggregate(F.sequence(F.lit(0), k - 1), F.lit(1.0), lambda p, i: p * F.greatest(pool - accepted - i, F.lit(0)) / (pool - i))
    return F.when(k >= pool, F.when(accepted > 0, F.lit(1.0)).otherwise(F.lit(0.0))).otherwise(1 - misses)


def freshness(year: Column, pivot: int = vocab.PIVOT_YEAR) -> Column:
    y = F.coalesce(year, F.lit(pivot))
    return F.when(y >= pivot, 1 + 0.25 * (y - pivot)).otherwise(F.pow(F.lit(0.1), (pivot - y) / 3))


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x)


def normalised(v: Column) -> Column:
    norm = F.greatest(F.sqrt(dot(v, v)), F.lit(1e-12))
    return F.transform(v, lambda x: x.cast("double") / norm)
