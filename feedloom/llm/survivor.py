"""One surviving record for each group of duplicates: field by field, by Bayesian fusion with copy detection.

Groups are the connected components of records and keys.  Every source provides values; a value that cannot be
true (a cut text, a page notice, a placeholder, a list of initials where another source has names) is a false one, and so
is a value that lost against the fused one.  From all groups the accuracy of each source is estimated, and for each pair of
sources, from the true and false values that they share, the chance that the later one copies: to agree on a false value is
unlikely for independent sources.  The vote of a value is the sum of the log odds of its providers, each discounted by the
chance that it copied from the first provider of the value or from the one before it; accuracies, dependences and fused
values are estimated from each other in rounds.  The value of the largest posterior wins; where the data model's own
order (complete, then recent; most persons, then full names) tells values apart, that order comes first.

All aggregates are combined map-side: a group with a third of all rows is never gathered.  Defined results: null and
blank keys link nothing; a field that no record fills is ``''`` (doi) or null; records are compared by the value they
hold, and of several that hold it the smallest ``seq`` survives; groups of one record give no row.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from feedloom.llm.common import cut, small, strip
from feedloom.llm.truncation import verdict
from feedloom.operators.components import components
from feedloom.operators.timestamps import to_utc_us

#: Rounds in which accuracies and votes are estimated from each other.
ROUNDS = 3
#: A source is taken to be right, and a pair of sources to be dependent, with these chances before values are seen; the first
#: counts as so many values.
PRIOR_RIGHT, PRIOR_COPY, PRIOR_WEIGHT = 0.8, 0.2, 4.0
#: The share of its values that a copying source copies, and how many false values there are for one item.
COPIED, FALSE_VALUES = 0.8, 10

# Names that stand for no person.
NOBODY = ("editorial team", "editorial staff", "editor", "editors", "staff", "staff writer", "staff reporter", "admin", "administrator", "anonymous", "anon", "unknown", "unknown author", "n/a", "na", "none", "null", "various", "various authors", "newsroom", "press office", "author", "authors", "tba", "redaktion", "rédaction", "redacción", "et al", "al", "-")

_NOTICE = re.compile(r"\bcookies?\b.*\b(?:agree|accept|consent|settings)\b|\b(?:agree|accept|consent)\b.*\bcookies?\b|\bterms of (?:use|service)\b.*\baccounts?\b|\b(?:enable|disable) javascript\b|\b(?:log|sign) in to (?:read|continue|view)\b|\bsubscribe to (?:read|continue)\b|\baccess denied\b|\bpage not found\b", re.I | re.S)


def bare_doi(doi: Column) -> Column:
    """``10.…/…`` in lower case without resolver, prefix or trailing punctuation; ``''`` for placeholders and stubs."""
    x = F.regexp_extract(F.lower(F.regexp_replace(F.coalesce(doi, F.lit("")), "%2[fF]", "/")), r"(10\.\d{4,9}/[^\s\"'<>]*[^\s\"'<>.,;:)\]}])", 1)
    return F.regexp_replace(x, r"[?#].*$", "")


def key_of(key: Column) -> Column:
    """A key without case and outer blanks; null if nothing is left."""
    return F.nullif(F.lower(strip(key)), F.lit(""))


def group_records(df: DataFrame, row_id: str, key: str, doi: str) -> DataFrame:
    """``df`` with ``_grp``: records share it if their keys (``key``: null links nothing) or identifiers (``doi``: ``''`` links
    nothing) agree, also through others.

    Only keys that one identifier joins become edges, so the iteration runs over a small part of the table.
    """
    df = df.withColumn("_key", F.coalesce(F.concat(F.lit("key:"), key), F.concat(F.lit("seq:"), F.col(row_id).cast("string"))))
    pairs = df.filter(F.col(doi) != "").select("_key", F.col(doi).alias("_hub")).distinct()
    hub = pairs.groupBy("_hub").agg(F.min("_key").alias("a"), F.count("*").alias("n")).filter("n > 1").drop("n")
    edges = pairs.join(hub, "_hub").filter("_key != a").select("a", F.col("_key").alias("b"))
    roots = components(edges).withColumnRenamed("node", "_key")
    return df.join(roots, "_key", "left").withColumn("_grp", F.coalesce("root", "_key")).drop("root", "_key")


def _person(name: str) -> tuple[str, str, bool] | None:
    n = re.sub(r"(?i)[\s,;]*\bet\.?\s+al\.?\s*$", "", name)
    n = re.sub(r"\s+", " ", re.sub(r"(?i)^(?:by|dr|prof)\.?\s+", "", n)).strip(" ,;.")
    if not n or n.casefold() in NOBODY or not re.search(r"[^\W\d_]", n):
        return None
    if "," in n:
        last, first = (x.strip() for x in n.split(",", 1))
    else:
        first, _, last = n.rpartition(" ")
    given = re.findall(r"[^\W\d_]+", first)
    return last.casefold(), given[0].casefold() if given else "", bool(given) and len(given[0]) > 1


def people(names: list[str | None] | None) -> tuple[int, int, str]:
    """Different persons of a list, those named in full, and the list as one comparable value."""
    found: dict[str, list[tuple[str, bool]]] = {}
    for name in names or []:
        p = _person(name or "")
        if p is None:
            continue
        last, first, full = p
        same = found.setdefault(last, [])
        for k, (other, was_full) in enumerate(same):
            if other == first or (not (full and was_full) and other[:1] == first[:1]):
                if full and not was_full:
                    same[k] = (first, full)
                break
        else:
            same.append((first, full))
    flat = sorted((last, f, full) for last, x in found.items() for f, full in x)
    return len(flat), sum(full for *_, full in flat), "|".join(f"{last},{f}" for last, f, _ in flat)


def assess(df: DataFrame) -> DataFrame:
    """``(row, grp, group_seq, doi, src, at, whole, text, persons, full, list)``: what the fields of each record are worth.  ``whole`` tells
    a complete summary, ``text`` is a hash of the summary (null if blank), ``persons`` and ``full`` count the authors."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = b.column(6).to_pylist()
            whole = [verdict(t) == "whole" and not _NOTICE.search(t) for t in texts]
            marks = [hashlib.sha256(x.encode("utf-8", "surrogatepass")).hexdigest() if (x := (t or "").strip()) else None for t in texts]
            persons, full, list_ = zip(*map(people, b.column(7).to_pylist())) if b.num_rows else ((), (), ())
            yield pa.RecordBatch.from_arrays([*b.columns[:6], pa.array(whole, pa.bool_()), pa.array(marks, pa.string()), pa.array(persons, pa.int32()), pa.array(full, pa.int32()), pa.array(list_, pa.string())], ["row", "grp", "group_seq", "doi", "src", "at", "whole", "text", "persons", "full", "list"])

    return df.mapInArrow(each, "row bigint, grp string, group_seq bigint, doi string, src string, at bigint, whole boolean, text string, persons int, full int, list string")


def _odds(p: Column) -> Column:
    p = F.greatest(F.least(p, F.lit(0.99)), F.lit(0.01))
    return F.log(p / (1 - p))


def _accuracy(judged: DataFrame) -> DataFrame:
    return judged.groupBy("src").agg(((F.count_if("ok") + PRIOR_RIGHT * PRIOR_WEIGHT) / (F.count("*") + PRIOR_WEIGHT)).alias("right"))


def dependence(judged: DataFrame, accuracy: DataFrame) -> DataFrame:
    """``(src, other, copies)``: the chance that a source depends on another one that gave the same values before it, from how
    many true and how many false values they share (Bayes' rule over independent and copying sources)."""
    pair = F.explode(F.array_distinct(F.array_compact(F.array("origin", "before")))).alias("other")
    n = judged.select("src", "ok", pair).filter("src != other").groupBy("src", "other").agg(F.count_if("ok").alias("good"), F.count_if(~F.col("ok")).alias("bad"))
    rights = small(accuracy)
    n = n.join(rights, "src").join(rights.select(F.col("src").alias("other"), F.col("right").alias("theirs")), "other")
    # how often a shared value is false, for two independent sources and for one that copies the other
    true, false = F.col("right") * F.col("theirs"), (1 - F.col("right")) * (1 - F.col("theirs")) / FALSE_VALUES
    copied_true, copied_false = F.col("theirs") * COPIED + true * (1 - COPIED), (1 - F.col("theirs")) * COPIED + false * (1 - COPIED)
    apart, close = false / (false + true), copied_false / (copied_false + copied_true)
    log = F.lit(math.log(PRIOR_COPY / (1 - PRIOR_COPY))) + F.col("bad") * F.log(close / apart) + F.col("good") * F.log((1 - close) / (1 - apart))
    return n.select("src", "other", (1 / (1 + F.exp(-log))).alias("copies"))


def fuse(claims: DataFrame, rounds: int = ROUNDS) -> DataFrame:
    """``(field, grp, value, votes)`` of claims ``(field, grp, value, src, row, possible)``.

    ``possible`` is false for values known to be false; they only teach how good and how dependent their sources are.
    Of a value only pairs of neighbouring providers, and of each with the first one, are compared: no group gives all pairs.
    """
    given = claims.groupBy("field", "grp", "value", "src").agg(F.min("row").alias("row"), F.max("possible").alias("possible"))
    order = Window.partitionBy("field", "grp", "value").orderBy("row", "src")
    given = cut(given.withColumn("origin", F.first("src").over(order)).withColumn("before", F.lag("src").over(order)))
    judged, votes = given.withColumn("ok", F.col("possible")), None
    for k in range(rounds):
        accuracy = cut(_accuracy(judged))
        copies = small(cut(dependence(judged, accuracy)))
        known = given.filter("possible").join(small(accuracy), "src")
        for c in ("origin", "before"):
            known = known.join(copies.select("src", F.col("other").alias(c), F.col("copies").alias(f"from_{c}")), ["src", c], "left")
        own = (1 - COPIED * F.coalesce("from_origin", F.lit(0.0))) * F.when(F.col("before") == F.col("origin"), 1.0).otherwise(1 - COPIED * F.coalesce("from_before", F.lit(0.0)))
        votes = cut(known.groupBy("field", "grp", "value").agg(F.sum(own * _odds(F.col("right"))).alias("votes")))
        if k + 1 < rounds:
            best = votes.groupBy("field", "grp").agg(F.max_by("value", F.struct(F.round("votes", 9), "value")).alias("best"))
            judged = given.join(best, ["field", "grp"], "left").withColumn("ok", F.coalesce(F.col("value") == F.col("best"), F.lit(False)))
    return votes


def survivors(items: DataFrame, feeds: DataFrame) -> DataFrame:
    """``(group_seq, doi, summary_seq, authors_seq)`` of every article with two or more records.  Texts are read once, of these
    records only."""
    f = feeds.filter("url is not null").groupBy(F.col("url").alias("_url")).agg(F.min_by("tz_name", "feed_id").alias("_tz"), F.min_by("date_order", "feed_id").alias("_order"))
    keys = items.select(F.col("seq").cast("bigint").alias("row"), key_of(F.col("dedupe_key")).alias("key"), bare_doi(F.col("doi")).alias("doi"))
    grouped = group_records(cut(keys), "row", "key", "doi").select("row", F.col("_grp").alias("grp"), "doi")
    groups = grouped.groupBy("grp").agg(F.min("row").alias("group_seq"), F.count("*").alias("_n")).filter("_n > 1").drop("_n")
    members = cut(grouped.join(groups, "grp"))
    # only records of groups are read as texts; whether they are few enough to be broadcast, Spark decides at run time
    df = items.select("seq", "feed_url", "summary", "authors", "updated_at", "published_at").join(members, F.col("seq") == F.col("row")).join(small(f), F.col("feed_url") == F.col("_url"), "left")
    df = to_utc_us(to_utc_us(df, "updated_at", "_tz", "_order", "_upd"), "published_at", "_tz", "_order", "_pub")
    rows = cut(assess(df.select("row", "grp", "group_seq", "doi", F.coalesce("feed_url", F.lit("")).alias("src"), F.coalesce("_upd", "_pub", F.lit(-(2**62))).alias("at"), "summary", "authors")))
    # each field's claims: the value, whether it may be true, and its place in the data model's order (null if it cannot stand)
    rank = lambda x, y: F.struct(x.cast("bigint").alias("x"), y.cast("bigint").alias("y"))
    zero, claim = F.lit(0), lambda field, value, possible, r: F.struct(F.lit(field).alias("field"), value.alias("value"), possible.alias("possible"), r.alias("rank"))
    claims = rows.select("grp", "row", "src", F.explode(F.array(
        claim("doi", F.nullif("doi", F.lit("")), F.lit(True), rank(zero, zero)),
        claim("summary", F.col("text"), F.col("whole"), F.when(F.col("whole"), rank(zero, F.col("at")))),
        claim("authors", F.when(F.col("persons") > 0, F.col("list")), F.col("full") == F.col("persons"), rank(F.col("persons"), F.col("full"))),
    )).alias("c")).select("grp", "row", "src", "c.*").filter("value is not null")
    votes = fuse(claims.drop("rank"))
    values = claims.filter("rank is not null").groupBy("field", "grp", "value").agg(F.min("row").alias("row"), F.max("rank").alias("rank"))
    best = F.max(F.struct("rank", F.round(F.coalesce("votes", F.lit(0.0)), 9).alias("votes"), (-F.col("row")).alias("minus"), "value"))
    chosen = values.join(votes, ["field", "grp", "value"], "left").groupBy("grp").pivot("field", ["doi", "summary", "authors"]).agg(best)
    out = rows.select("grp", "group_seq").distinct().join(chosen, "grp", "left")
    return out.select("group_seq", F.coalesce("doi.value", F.lit("")).alias("doi"), (-F.col("summary.minus")).alias("summary_seq"), (-F.col("authors.minus")).alias("authors_seq"))
