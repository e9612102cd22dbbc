"""Identifiers, URLs and keys as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from feedloom.functions.text import comparable_title, squeeze, strip

# URL parameters that are dropped.
TRACKING = ("utm_source", "utm_medium", "utm_campaign", "utm_content", "utm_term", "ref", "source", "rss", "cmp", "mc_cid", "mc_eid")
URL = r"^(?:([^:/?#]+):)?(?://([^/?#]*))?([^?#]*)(?:\?([^#]*))?(?:#.*)?$"


def doi(c: Column) -> Column:
    """The first DOI in a text without trailing punctuation, or null."""
    return F.nullif(F.regexp_replace(F.regexp_extract(F.coalesce(c, F.lit("")), r"(?i)\b(10\.\d{4,9}/[^\s\"'<>]+)", 1), r"[.,;:)>\]'\"]+$", ""), F.lit(""))


def pmid(c: Column) -> Column:
    """A PubMed identifier from a link, else after ``pmid:``, or null."""
    t = F.coalesce(c, F.lit(""))
    link = F.regexp_extract(t, r"(?i)(?:pubmed\.ncbi\.nlm\.nih\.gov|ncbi\.nlm\.nih\.gov/pubmed)/(\d{1,8})", 1)
    return F.coalesce(F.nullif(link, F.lit("")), F.nullif(F.regexp_extract(t, r"(?i)\bpmid:(\d{1,8})\b", 1), F.lit("")))


def first_of(texts: list[Column], find) -> Column:
    """The first hit of ``find`` in an ordered list of texts."""
    return F.coalesce(*[find(t) for t in texts])


def url(c: Column) -> Column:
    """Lower scheme and host, no closing slashes, no fragment; only ``key=value`` parts that do not track; ``''`` for null."""
    u = strip(F.coalesce(c, F.lit("")))
    scheme, host, path, query = (F.regexp_extract(u, URL, i) for i in range(1, 5))
    kept = F.array_join(F.filter(F.split(query, "&"), lambda p: F.contains(p, F.lit("=")) & ~F.substring_index(p, "=", 1).isin(*TRACKING)), "&")
    return F.concat(F.when(scheme != "", F.concat(F.lower(scheme), F.lit(":"))).otherwise(""), F.when(host != "", F.concat(F.lit("//"), F.lower(host))).otherwise(""), F.regexp_replace(path, "/+$", ""), F.when(kept != "", F.concat(F.lit("?"), kept)).otherwise(""))


def legacy_url(c: Column) -> Column:
    return F.lower(F.regexp_replace(F.regexp_replace(F.trim(F.coalesce(c, F.lit(""))), "[?#].*$", ""), "/+$", ""))


def domain(c: Column) -> Column:
    """The lower-case authority of a URL, ``unknown`` if there is none."""
    return F.coalesce(F.nullif(F.lower(F.regexp_extract(strip(F.coalesce(c, F.lit(""))), URL, 2)), F.lit("")), F.lit("unknown"))


def short_hash(c: Column) -> Column:
    return F.substring(F.sha2(c, 256), 1, 16)


def dedupe_key(doi_: Column, pmid_: Column, url_: Column, title: Column, day: Column) -> Column:
    """doi, else pmid, else a hash of the URL, else of title and day."""
    full = lambda c: F.nullif(F.trim(F.coalesce(c, F.lit(""))), F.lit(""))
    clean = F.nullif(url(url_), F.lit(""))
    return F.coalesce(
        F.concat(F.lit("doi:"), F.lower(full(doi_))), F.concat(F.lit("pmid:"), full(pmid_)), F.concat(F.lit("url:"), short_hash(clean)),
        F.concat(F.lit("title:"), short_hash(F.concat(squeeze(F.lower(F.coalesce(title, F.lit("")))), F.lit("|"), F.coalesce(day, F.lit("nodate"))))),
    )


def fingerprint(title: Column, summary: Column) -> Column:
    t, s = F.coalesce(title, F.lit("")), F.substring(F.coalesce(summary, F.lit("")), 1, 200)
    return short_hash(F.concat(squeeze(F.lower(t)), F.lit("|"), squeeze(F.lower(s))))


def raw_fingerprint(title: Column, url_: Column) -> Column:
    return short_hash(F.concat(F.coalesce(title, F.lit("")), F.lit("|"), F.coalesce(url_, F.lit(""))))


def content_hash(c: Column) -> Column:
    return F.md5(squeeze(F.lower(F.coalesce(c, F.lit("")))))


def legacy_key(url_: Column, title: Column, content: Column) -> Column:
    """URL, else title, else content, else a hash of nothing: the first that is there."""
    u, t = F.nullif(legacy_url(url_), F.lit("")), F.nullif(comparable_title(title), F.lit(""))
    c = F.when(F.trim(F.coalesce(content, F.lit(""))) != "", content_hash(content))
    return F.coalesce(F.concat(F.lit("url:"), u), F.concat(F.lit("title:"), t), F.concat(F.lit("content:"), c), F.lit("fallback:"))


def article_id(url_: Column, title: Column) -> Column:
    """The URL, or the title where there is none."""
    return F.coalesce(F.nullif(url_, F.lit("")), title)
