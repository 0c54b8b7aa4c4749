"""String functions as Column expressions: case, white space, tokens, slugs, languages, shapes, n-grams."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from decisionloom.functions import vocab


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body(value), the value worked out once however often the body reads it: Spark shares nothing inside lambdas."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def tr_upper(c: Column) -> Column:
    """Upper case with the dotted and the dotless i kept apart."""
    return F.upper(F.replace(F.replace(c, F.lit("i"), F.lit("İ")), F.lit("ı"), F.lit("I")))


def tr_lower(c: Column) -> Column:
    return F.lower(F.replace(F.replace(c, F.lit("İ"), F.lit("i")), F.lit("I"), F.lit("ı")))


def norm_ws(c: Column) -> Column:
    """One space for each run of Unicode white space, none at the ends."""
    return F.trim(F.regexp_replace(c, r"(?U) [\s\x1c-\x1f]+|[\s\x1c-\x1f&&[^ ]][\s\x1c-\x1f]*", " "))  # a space on its own is not replaced by itself


def blank(c: Column) -> Column:
    return F.nullif(norm_ws(c), F.lit(""))


def strip_dot(c: Column) -> Column:
    """Without the combining dot above that case mapping may leave."""
    return F.replace(c, F.lit("̇"), F.lit(""))


def slug(c: Column) -> Column:
    s = strip_dot(tr_lower(c))
    s = F.regexp_replace(s, "['’‘`.]", "")
    return F.trim(F.regexp_replace(s, "[^0-9a-zçğıöşüâîûêôß-öø-ÿ]+", "_"), F.lit("_"))


def slug_right(c: Column) -> Column:
    return slug(F.regexp_replace(c, r"\(.*?\)", ""))


def deaccent(c: Column) -> Column:
    return F.translate(c, vocab.DEACCENT_FROM, vocab.DEACCENT_TO)


def norm_upper(c: Column) -> Column:
    return deaccent(tr_upper(c))


def ground_form(c: Column) -> Column:
    """Text as citations are looked up in it: one apostrophe, one quote, upper case, single spaces."""
    return tr_upper(norm_ws(F.translate(c, "’‘`´“”«»", "''''\"\"\"\"")))


def tokens(c: Column, pattern: str = vocab.TOKEN, stop: list[str] | None = None, turkish: bool = False, least: int = 2) -> Column:
    """Tokens in order: lower case, marks dropped, of the class, long enough, no stop words."""
    low = F.regexp_replace(tr_lower(c) if turkish else F.lower(c), r"\p{M}", "")
    found = F.filter(F.regexp_extract_all(low, F.lit(pattern), F.lit(0)), lambda x: F.length(x) >= least)
    return found if not stop else F.filter(found, lambda x: ~x.isin(*stop))


def share_of(c: Column, words: list[str], pattern: str = vocab.TOKEN) -> Column:
    """Share of a text's words that are in the list."""
    own = F.regexp_extract_all(F.lower(c), F.lit(pattern), F.lit(0))
    return F.size(F.filter(own, lambda x: x.isin(*words))) / F.greatest(F.size(own), F.lit(1))


def main_language(c: Column, lists: dict[str, list[str]] | None = None, least: float = 0.02) -> Column:
    """Language whose stop words have the largest share, ties to the first; null below the least share."""
    lists = lists or vocab.STOPWORDS
    best = F.greatest(*[share_of(c, w) for w in lists.values()])
    out = F.lit(None).cast("string")
    for name in reversed(lists):
        out = F.when(share_of(c, lists[name]) == best, F.lit(name)).otherwise(out)
    return F.when(best >= least, out)


def title_shape(c: Column) -> Column:
    return F.substring(F.regexp_replace(c, r"\d+", "#"), 1, 70)


def lines(c: Column) -> Column:
    """Paragraphs of a plain text: its lines, white space normalised, without empty ones."""
    split = F.split(c, "\\r\\n|[\\n\\r\\x0b\\f\\x1c-\\x1e\\x85\\u2028\\u2029]")
    return F.filter(F.transform(split, norm_ws), lambda x: x != "")


def without_junk(paragraphs: Column, junk: str) -> Column:
    return F.filter(paragraphs, lambda x: ~x.rlike(junk))


def is_heading(c: Column) -> Column:
    return (F.length(c) <= 80) & ~c.rlike("[a-zçğıöşüâîûß-öø-ÿ]")


def ngrams(words: Column, n: int) -> Column:
    """Distinct n-grams of an array of words, as strings."""
    return F.when(F.size(words) >= n, F.array_distinct(F.transform(F.sequence(F.lit(1), F.size(words) - n + 1), lambda i: F.array_join(F.slice(words, i, n), " ")))).otherwise(F.array().cast("array<string>"))


def longest_shared(a: Column, b: Column, cap: int, stop_early: bool = True) -> Column:
    """Largest n up to cap with a shared n-gram; stop_early: the run of shared lengths from 1."""
    hit = [F.arrays_overlap(ngrams(a, n), ngrams(b, n)) for n in range(1, cap + 1)]
    out = F.lit(0)
    if stop_early:
        for n in range(cap, 0, -1):
            out = F.when(hit[n - 1], F.greatest(F.lit(n), out)).otherwise(F.lit(0))
        return out
    for n in range(1, cap + 1):
        out = F.when(hit[n - 1], F.lit(n)).otherwise(out)
    return out


def hollow(paragraphs: Column, least_chars: int = 700) -> Column:
    """A short document whose paragraphs announce what isn't there."""
    open_ = F.size(F.filter(paragraphs, lambda p: p.rlike(r"[;:]\s*$")))
    return (F.aggregate(paragraphs, F.lit(0), lambda a, p: a + F.length(p)) < least_chars) & (open_ >= 2)


def numbered(paragraphs: Column) -> Column:
    return F.array_join(F.transform(paragraphs, lambda p, i: F.concat(F.lit("[p"), (i + 1).cast("string"), F.lit("] "), p)), "\n")
