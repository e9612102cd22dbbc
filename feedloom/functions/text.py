"""Text as column expressions.  Null stays null unless a function says otherwise."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from feedloom.functions.udfs import html_unescape

def strip(c: Column) -> Column:
    return F.regexp_replace(c, r"(?U)^\s+|\s+$", "")


def squeeze(c: Column) -> Column:
    """White space of any kind as single blanks, none outside."""
    return F.trim(F.regexp_replace(c, r"(?U)\s+", " "))


def strip_html(c: Column, max_length: int | None = None, gap: str = " ") -> Column:
    """Without tags, then without entities of any kind; cut at ``max_length`` and back to the last whole word."""
    t = squeeze(html_unescape(F.regexp_replace(F.coalesce(c, F.lit("")), "<[^>]+>", gap)))
    if not max_length:
        return t
    return F.when(F.length(t) <= max_length, t).otherwise(F.regexp_replace(F.substring(t, 1, max_length), " [^ ]*$", ""))


def comparable_title(c: Column) -> Column:
    """Lower case, single blanks, without one leading notice."""
    return F.regexp_replace(squeeze(F.lower(F.coalesce(c, F.lit("")))), r"^(?:breaking|exclusive|update|correction|retraction):\s*", "")


def legacy_title(c: Column) -> Column:
    t = F.trim(F.lower(F.coalesce(c, F.lit(""))))
    for notice in ("breaking:", "breaking news:", "exclusive:", "exclusive news:"):
        t = F.replace(t, F.lit(notice), F.lit(""))
    return F.trim(t)


def tokens(c: Column, least: int = 4) -> Column:
    """Distinct words of letters, digits and underscores with ``least`` characters or more."""
    return F.array_distinct(F.regexp_extract_all(F.lower(F.coalesce(c, F.lit(""))), F.lit(r"([\p{L}\p{N}_]{" + str(least) + ",})"), F.lit(1)))


def overlap(a: Column, b: Column) -> Column:
    """Common words by the larger of two word lists; 0 if either is empty."""
    return F.coalesce(F.size(F.array_intersect(a, b)) / F.nullif(F.greatest(F.size(a), F.size(b)), F.lit(0)), F.lit(0.0))


def containment(a: Column, b: Column) -> Column:
    """The share of ``b`` that is in ``a``; 0 if ``b`` is empty."""
    return F.coalesce(F.size(F.array_intersect(a, b)) / F.nullif(F.size(b), F.lit(0)), F.lit(0.0))


def numbers(c: Column) -> Column:
    """Distinct numbers as they are written."""
    return F.array_distinct(F.regexp_extract_all(F.coalesce(c, F.lit("")), F.lit(r"(\b\d+(?:[.,]\d+)?%?\b)"), F.lit(1)))


def sentences(c: Column) -> Column:
    return F.filter(F.transform(F.split(F.coalesce(c, F.lit("")), r"(?<=[.!?])\s+"), strip), lambda s: s != "")


def first_sentences(c: Column, n: int) -> Column:
    return F.array_join(F.slice(sentences(c), 1, n), " ")


def without_headers(c: Column) -> Column:
    return F.regexp_replace(c, r"\*\*[^*]+\*\*:\s*", "")


def source_family(c: Column) -> Column:
    """A source's name without what follows a spaced dash."""
    return F.lower(F.trim(F.regexp_replace(F.coalesce(c, F.lit("")), r"\s+[-–—]\s+.*", "")))


def contains_any(c: Column, phrases: list[str]) -> Column:
    """Whether lower-cased text holds any phrase; false for null."""
    low = F.lower(F.coalesce(c, F.lit("")))
    return reduce(lambda x, p: x | F.contains(low, F.lit(p)), phrases, F.lit(False))


def phrases_in(c: Column, phrases: list[str]) -> Column:
    """The phrases that lower-cased text holds, in the order of the list."""
    low = F.lower(F.coalesce(c, F.lit("")))
    return F.filter(F.array(*[F.lit(p) for p in phrases]), lambda p: F.contains(low, p))


def has_word(c: Column, word: str) -> Column:
    """Whether lower-cased text holds ``word`` between word boundaries; the pattern runs only where the letters occur."""
    low = F.lower(F.coalesce(c, F.lit("")))
    return F.contains(low, F.lit(word.lower())) & low.rlike(r"(^|[^\p{L}\p{N}_])" + _quoted(word) + r"($|[^\p{L}\p{N}_])")


def _quoted(text: str) -> str:
    return "".join("\\" + c if c in r"\.^$|?*+()[]{}" else c for c in text.lower())


def for_copy(c: Column, forbidden: list[str]) -> Column:
    """Text without headers, or null if it is blank or holds a forbidden phrase."""
    return F.when((F.trim(F.coalesce(c, F.lit(""))) != "") & ~contains_any(c, forbidden), F.trim(without_headers(c)))


def prefix_key(c: Column, n: int = 60) -> Column:
    return F.lower(F.trim(F.substring(F.coalesce(c, F.lit("")), 1, n)))


def first_words(c: Column, n: int = 4) -> Column:
    return F.array_join(F.slice(F.split(F.coalesce(c, F.lit("")), " "), 1, n), " ")


def truthy(c: Column) -> Column:
    return F.lower(F.trim(F.coalesce(c, F.lit("")))).isin("true", "1", "yes")


def attributed(c: Column, source: Column, position: Column, phrases: list[str], subjects: list[tuple[str, str]]) -> Column:
    """An opening sentence whose generic subject names its source; phrases rotate with the position.

    ``subjects`` are ordered (pattern, noun) pairs; ``{}`` in a phrase stands for the source.
    """
    wording = F.element_at(F.array(*[F.lit(p) for p in phrases]), (F.pmod(position - 1, F.lit(len(phrases))) + 1).cast("int"))
    by = F.replace(wording, F.lit("{}"), F.coalesce(F.nullif(source, F.lit("")), F.lit("the journal")))
    tail = lambda p: F.regexp_replace(c, "(?i)" + p, "")
    changed = F.coalesce(*[F.when(c.rlike("(?i)" + p), F.concat(F.lit(noun + " "), by, tail(p))) for p, noun in subjects])
    return F.coalesce(changed, F.concat(F.lit("A study "), by, F.lit(": "), F.lower(F.substring(c, 1, 1)), F.substring(c, 2, 1_000_000)))


def label(c: Column) -> Column:
    """A key as words: underscores are blanks."""
    return F.replace(c, F.lit("_"), F.lit(" "))


def acceptable(c: Column, rejected: list[str], least: int = 30) -> Column:
    """Whether text is long enough and holds none of the phrases; false for null."""
    return (F.length(F.coalesce(c, F.lit(""))) >= least) & ~contains_any(c, rejected)
