"""Lexical functions as column expressions. Null text is empty text everywhere.

Everything but Unicode compatibility normalisation runs inside the JVM; that one step goes to Python only for rows
with characters beyond ASCII.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from millrace.functions import vocabulary as V

#: White space as Python sees it, for trimming and splitting.
SPACE = r"(?U)[\s\x1c-\x1f]"
_STRIP = " .,:;()[]{}\"'`"
#: Joins strings for one call of normalised() over an array; it doesn't occur in text.
_MARK = "\u0001"


def _c(x: Column | str) -> Column:
    return F.coalesce(F.col(x) if isinstance(x, str) else x, F.lit(""))


def let(body: Callable[..., Column], **values: Column) -> Column:
    """body(**values) with every value worked out once. A column that a lambda refers to from outside may be inlined
    into it by the optimiser and then be worked out again for every element; a bound variable can't.
    """
    bound = F.transform(F.array(F.struct(*[c.alias(k) for k, c in values.items()])), lambda v: body(**{k: v[k] for k in values}))
    return F.element_at(bound, 1)


def stripped(x: Column | str) -> Column:
    """Without white space of any kind at both ends."""
    return F.regexp_replace(_c(x), rf"^{SPACE}+|{SPACE}+$", "")


@F.pandas_udf(StringType())
def _compatible(s: pd.Series) -> pd.Series:
    return s.map(lambda t: None if t is None else unicodedata.normalize("NFKC", t).lower())


def normalised(x: Column | str) -> Column:
    """Compatibility form, long dashes as '-', lower case."""
    c = _c(x)
    ascii_only = c.rlike(r"^\p{ASCII}*$")
    low = F.coalesce(F.when(ascii_only, F.lower(c)), _compatible(F.when(~ascii_only, c)), F.lit(""))
    return F.translate(low, "—–", "--")


def normalised_all(x: Column) -> Column:
    """normalised() of every element of an array, in one call."""
    return F.when(F.size(x) > 0, F.split(normalised(F.array_join(F.transform(x, lambda e: F.coalesce(e, F.lit(""))), _MARK)), _MARK)).otherwise(F.array().cast("array<string>"))


def words(x: Column | str) -> Column:
    """Words with inner dots, slashes and dashes, lower-cased, ASCII letters only."""
    return F.transform(F.regexp_extract_all(_c(x), F.lit(V.WORD), 0), F.lower)


def content_words(x: Column | str) -> Column:
    """words() without stop-words and single characters; repeats stay."""
    return F.filter(words(x), lambda t: (F.length(t) > 1) & ~t.isin(V.STOPWORDS))


def _all(c: Column, pattern: str, group: int = 0) -> Column:
    return F.regexp_extract_all(c, F.lit("(?U)" + pattern), group)


def _clean(found: Column) -> Column:
    return F.filter(
        F.transform(found, lambda t: F.rtrim(F.btrim(t, F.lit(_STRIP)), F.lit("/"))),
        lambda t: (F.length(t) >= 2) & ~F.lower(t).isin(V.GENERIC) & ~F.lower(t).isin(V.STOPWORDS),
    )


def identifiers(x: Column | str) -> Column:
    """Distinct project-looking symbols: mixed case, snake case, dotted, paths, capitals, and short code spans."""
    c = _c(x)
    spans = F.filter(F.transform(_all(c, V.CODE_SPAN, 1), stripped), lambda t: (t != "") & (F.size(F.split(t, rf"{SPACE}+")) <= 3))
    return F.array_distinct(_clean(F.concat(*[_all(c, p) for p in V.IDENTIFIERS], spans)))


def technical_words(x: Column | str) -> Column:
    """identifiers() and every word with a digit, '_', '.', '/' or a capital behind its first letter."""
    c = _c(x)
    plain = F.filter(
        F.transform(F.regexp_extract_all(c, F.lit(V.WORD), 0), lambda t: F.btrim(t, F.lit("./-"))),
        lambda t: (F.length(t) >= 2) & ~F.lower(t).isin(V.GENERIC) & ~F.lower(t).isin(V.STOPWORDS) & (t.rlike("[0-9_./]") | F.substring(t, 2, 1 << 30).rlike("[A-Z]")),
    )
    return F.array_distinct(F.concat(identifiers(c), plain))


def _singular(t: Column) -> Column:
    return F.rtrim(t, F.lit("s"))


def missing_identifiers(found: Column, haystack: Column) -> Column:
    """Those of an array of identifiers that don't stand in normalised text, not even without trailing s; sorted."""
    pairs = F.arrays_zip(found.alias("t"), normalised_all(found).alias("n"))
    absent = let(lambda pairs, hay: F.filter(pairs, lambda p: ~F.contains(hay, p["n"]) & ~((_singular(p["n"]) != "") & F.contains(hay, _singular(p["n"])))), pairs=pairs, hay=haystack)
    return F.array_sort(F.transform(absent, lambda p: p["t"]))


def share(part: Column, whole: Column, empty: float) -> Column:
    """part / whole, or `empty` where whole is 0."""
    return F.coalesce(F.try_divide(part, whole), F.lit(empty))


def technical_share(tokens: Column, haystack: Column) -> Column:
    """Share of technical words that stand in normalised text, trailing s aside; 1 without any. A word of nothing but s counts as found."""
    count = lambda n, hay: F.size(F.filter(n, lambda t: F.contains(hay, t) | F.contains(hay, _singular(t))))
    return share(let(count, n=normalised_all(tokens), hay=haystack), F.size(tokens), 1.0)


def lexical_share(answer: Column, context: Column) -> Column:
    """Share of an array of content words, repeats counted, that is among another's; 0 without any."""
    return let(lambda a, c: share(F.size(F.filter(a, lambda t: F.array_contains(c, t))), F.size(a), 0.0), a=answer, c=context)


def citations(x: Column | str) -> Column:
    """Array of (source, heading) of every `[source — heading]`, in order, repeats kept."""
    c = _c(x)
    trim = lambda a: F.transform(a, stripped)
    return F.arrays_zip(trim(_all(c, V.CITATION, 1)).alias("source"), trim(_all(c, V.CITATION, 2)).alias("heading"))


def has_any(normal: Column, phrases: list[str]) -> Column:
    """Whether one of the phrases stands in normalised text."""
    return normal.rlike("|".join(f"\\Q{p}\\E" for p in phrases))


def declines(normal: Column) -> Column:
    return has_any(normal, V.REFUSALS)


def names_conflict(normal: Column) -> Column:
    return has_any(normal, V.CONFLICTS)


def first_sentence(x: Column | str, least: int = 60, most: int = 400) -> Column:
    """Text up to the first sentence or line end at `least` characters or later, the whole text without one, at most `most` characters."""
    c = stripped(x)
    found = F.regexp_extract(c, rf"(?s)^(.{{{least},}}?)(?:(?<=[.!?]){SPACE}+|(?<![.!?]{SPACE}{{1,20}})\n)".replace("(?U)", ""), 1)
    return F.substring(F.when(found != "", found).otherwise(c), 1, most)


def jaccard(a: Column, b: Column) -> Column:
    """Likeness of two arrays as sets; 0 where one is empty."""
    return let(lambda a, b: F.when((F.size(a) > 0) & (F.size(b) > 0), F.size(F.array_intersect(a, b)) / F.size(F.array_union(a, b))).otherwise(F.lit(0.0)), a=a, b=b)


def token_f1(a: Column, b: Column) -> Column:
    """F1 of two arrays of words, counting each word as often as both have it; 0 where one is empty."""
    count = lambda arr, t: F.size(arr) - F.size(F.array_remove(arr, t))
    common = lambda a, b: F.aggregate(F.array_intersect(a, b), F.lit(0), lambda acc, t: acc + F.least(count(a, t), count(b, t)))
    return let(lambda a, b: share(2.0 * common(a, b), F.size(a) + F.size(b), 0.0), a=a, b=b)


def phrase_recall(normal: Column, phrases: Column) -> Column:
    """Share of an array of phrases that stands in normalised text; 1 without any."""
    count = lambda p, n: F.size(F.filter(p, lambda x: F.contains(n, x)))
    return share(let(count, p=normalised_all(phrases), n=normal), F.size(phrases), 1.0)


def containing(phrases: Column, normal: Column) -> Column:
    """Those of an array of phrases that stand in normalised text."""
    pairs = F.arrays_zip(phrases.alias("t"), normalised_all(phrases).alias("n"))
    return F.transform(let(lambda p, n: F.filter(p, lambda x: F.contains(n, x["n"])), p=pairs, n=normal), lambda x: x["t"])


def among(items: Column, pool: Column, wanted: bool = True, part: str | None = None) -> Column:
    """Those items of an array that are in another array (or, not wanted, aren't), by the item or a field of it."""
    key = (lambda i: i[part]) if part else (lambda i: i)
    inside = (lambda p, i: F.array_contains(p, key(i))) if wanted else (lambda p, i: ~F.array_contains(p, key(i)))
    return let(lambda i, p: F.filter(i, lambda x: inside(p, x)), i=items, p=pool)


def question_words(x: Column | str) -> Column:
    """A question's content in no order: lower-cased, punctuation dropped, stop-words dropped, sorted distinct words."""
    plain = F.regexp_replace(F.lower(_c(x)), r"(?U)[^\w\s/.:_-]+", " ")
    return F.array_sort(F.array_distinct(F.filter(words(plain), lambda t: ~t.isin(V.STOPWORDS))))


def word_count(x: Column | str) -> Column:
    """Words between white space of any kind."""
    return F.size(F.filter(F.split(_c(x), rf"{SPACE}+"), lambda t: t != ""))


def stable_id(prefix: Column | str, *parts: Column | str) -> Column:
    """prefix-<first 10 hex digits of SHA-1 over the parts joined by '||'>."""
    as_col: Callable = lambda p: F.col(p) if isinstance(p, str) else p
    return F.concat(as_col(prefix), F.lit("-"), F.substring(F.sha1(F.concat_ws("||", *[F.coalesce(as_col(p), F.lit("")) for p in parts])), 1, 10))


def content_hash(x: Column | str) -> Column:
    """First 16 hex digits of SHA-256."""
    return F.substring(F.sha2(_c(x), 256), 1, 16)
