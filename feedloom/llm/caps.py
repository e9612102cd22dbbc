"""Capping the records of each contributor: mergeable bounded heaps.

Each task keeps, for each contributor and run it meets, a heap of at most ``cap`` (score, id) pairs; the heaps of
the tasks are merged in two levels, salted first, so that a contributor with a third of all rows sends at most
``cap`` pairs from each task and no task merges the heaps of every other one alone.  The last level reads its pairs
ordered by group, so that a task may hold any number of groups and none is passed on before it ends.  Full records are then
matched with the kept identifiers, which are unique and thus never skewed.

Names are resolved by joins (exact key, host, abbreviated words, initials, misspellings by the segments that two close
names share), so that neither the names nor the contributors need fit into one task.

Defined results: null scores are lowest; ties keep the smaller id; rows of no known contributor are never
capped; a null run is a run of its own; an empty table gives no rows.
"""

from __future__ import annotations

import heapq
import html
import re
import unicodedata
from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from feedloom.llm.common import MAX_DIMENSION, cut, host_of, small

#: Groups whose heaps a task holds at once; beyond that it passes them on and begins anew (where groups come in order, all
#: but the one that may go on).
HELD = 100_000
#: The most misspellings of a name.
MISSPELT = 2

_PAIRS = T.StructType([T.StructField("grp", T.StringType()), T.StructField("score", T.DoubleType()), T.StructField("id", T.LongType())])


def _heaps(cap: int, ordered: bool = False):
    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        heaps: dict[str, list] = {}

        def out() -> Iterator[pa.RecordBatch]:
            rows = [(g, s, -i) for g, heap in heaps.items() for s, i in heap]
            heaps.clear()
            for k in range(0, len(rows), 10_000):
                g, s, i = zip(*rows[k : k + 10_000])
                yield pa.RecordBatch.from_arrays([pa.array(g, pa.string()), pa.array(s, pa.float64()), pa.array(i, pa.int64())], ["grp", "score", "id"])

        for b in batches:
            for g, s, i in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2).to_pylist()):
                pair = (float("-inf") if s is None or s != s else s, -i)
                heap = heaps.setdefault(g, [])
                if len(heap) < cap:
                    heapq.heappush(heap, pair)
                elif pair > heap[0]:
                    heapq.heapreplace(heap, pair)
            if len(heaps) > HELD:
                last = {g: heaps.pop(g)} if ordered else {}
                yield from out()
                heaps.update(last)
        yield from out()

    return keep


def kept_ids(rows: DataFrame, group: str, score: str, row_id: str, cap: int, salts: int = 16) -> DataFrame:
    """``(id)`` of the rows that each group keeps: the ``cap`` highest scores, smaller ids first."""
    if cap <= 0:
        return rows.select(F.col(row_id).cast("bigint").alias("id")).limit(0)
    pairs = rows.select(F.col(group).cast("string").alias("grp"), F.col(score).cast("double").alias("score"), F.col(row_id).cast("bigint").alias("id")).filter("grp is not null")
    pairs = pairs.mapInArrow(_heaps(cap), _PAIRS)
    pairs = pairs.repartition("grp", F.pmod("id", F.lit(salts))).mapInArrow(_heaps(cap), _PAIRS)
    return pairs.repartition("grp").sortWithinPartitions("grp").mapInArrow(_heaps(cap, ordered=True), _PAIRS).select("id")


def beyond_cap(rows: DataFrame, group: str, score: str, row_id: str, cap: int) -> DataFrame:
    """The rows of known groups that lie beyond the cap."""
    keep = kept_ids(rows, group, score, row_id, cap)
    return rows.filter(F.col(group).isNotNull()).join(keep.withColumnRenamed("id", "_kept"), F.col(row_id) == F.col("_kept"), "left_anti")


# ---------------------------------------------------------------- who contributed a row

# What feeds add to a contributor's name.
_ADDED = re.compile(r"(?i)\s*(?:[-–—|:]\s*(?:articles in press|editors?['’]? choice|home|latest|current issue|rss)|\((?:rss|online|feed)\))\s*$")


def name_key(name: str | None) -> str:
    """Letters and digits of a name without accents, case, a leading article and what feeds add."""
    s = html.unescape(unicodedata.normalize("NFKC", name or "")).strip()
    s = re.sub(r"(?i)^the\s+", "", _ADDED.sub("", s))
    s = unicodedata.normalize("NFKD", s.replace("&", " ").replace("ß", "ss"))
    return "".join(c for c in s.casefold() if c.isalnum())


def _words(name: str) -> list[str]:
    s = unicodedata.normalize("NFKD", re.sub(r"(?i)^the\s+", "", _ADDED.sub("", html.unescape(name).strip())))
    return re.findall(r"[a-z0-9]+", "".join(c for c in s.casefold() if not unicodedata.combining(c)))


def _features(df: DataFrame) -> DataFrame:
    """``df (id, name)`` with what names are compared by: ``key``, ``host``, ``short`` (the words), ``shape`` (their number and
    first letters) and ``initials``."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            names = [n or "" for n in b.column(1).to_pylist()]
            words = [_words(n) for n in names]
            first = ["".join(x[0] for x in w) for w in words]
            hosts = [re.sub(r"^(?:https?://)?", "", n.strip().lower()).split("/")[0] for n in names]
            cols = [[name_key(n) for n in names], hosts, first, [f"{len(w)} {i}" if len(w) > 1 else None for w, i in zip(words, first)]]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), *[pa.array(c, pa.string()) for c in cols], pa.array(words, pa.list_(pa.string()))], ["id", "name", "key", "host", "initials", "shape", "short"])

    return df.mapInArrow(each, "id bigint, name string, key string, host string, initials string, shape string, short array<string>")


def _segments(key: Column) -> Column:
    """``(n, part, text)`` of a key's equal parts, one more than misspellings: a close name holds one of them, near its place."""
    n = F.length(key)
    at = lambda i: F.floor(n * i / (MISSPELT + 1)).cast("int")
    return F.array(*[F.struct(n.alias("n"), F.lit(i).alias("part"), F.substring(key, at(i) + 1, at(i + 1) - at(i)).alias("text")) for i in range(MISSPELT + 1)])


def _places(key: Column) -> Column:
    """The parts that keys within ``MISSPELT`` edits can share with ``key``: of each length and part, the texts near its place."""
    out = []
    for dn in range(-MISSPELT, MISSPELT + 1):
        n = F.length(key) + dn
        for i in range(MISSPELT + 1):
            start, stop = F.floor(n * i / (MISSPELT + 1)).cast("int"), F.floor(n * (i + 1) / (MISSPELT + 1)).cast("int")
            for shift in range(-MISSPELT, MISSPELT + 1):
                out.append(F.when((start + shift >= 0) & (stop + shift <= F.length(key)) & (n > 0), F.struct(n.alias("n"), F.lit(i).alias("part"), F.substring(key, start + shift + 1, stop - start).alias("text"))))
    return F.array_distinct(F.array_compact(F.array(*out)))


def _suffixes(host: Column) -> Column:
    labels = F.split(host, r"\.")
    return F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))


def _only(hits: DataFrame) -> DataFrame:
    """``(name, by)`` of the names that fit one contributor only."""
    return hits.groupBy("name").agg(F.min("by").alias("by"), F.max("by").alias("_top")).filter("by = _top").drop("_top")


def resolved(names: DataFrame, contributor: DataFrame, feeds: DataFrame) -> DataFrame:
    """``(name, by)``: the contributor that each name means, by the first rule that finds one: the same letters and digits, a
    host, abbreviated words or initials that fit one contributor only, at most two misspellings of its or its feeds' names.
    Names that no rule resolves have no row."""
    known = contributor.select(F.col("contributor_id").cast("bigint").alias("id"), "name").filter("name is not null")
    alias = feeds.filter("contributor_id is not null and name is not null").select(F.col("contributor_id").cast("bigint").alias("id"), "name")
    people, others = cut(_features(known)), _features(alias)
    keys = cut(people.select("key", "id", F.lit(0).alias("rank")).union(others.select("key", "id", F.lit(1))).filter("key != ''").groupBy("key").agg(F.min(F.struct("rank", "id")).alias("x")).select("key", F.col("x.id").alias("by")))
    asked = cut(_features(names.select(F.lit(0).cast("bigint"), "name").distinct()).filter("key != ''").drop("id"))
    domains = contributor.filter("domain is not null").select(F.lower("domain").alias("domain"), F.col("contributor_id").cast("bigint").alias("by"))
    hint = F.broadcast if keys.count() <= MAX_DIMENSION else (lambda df: df)  # the keys number the contributors and their aliases
    initials = _only(people.select(F.col("initials").alias("name"), F.col("id").alias("by"))).withColumnRenamed("name", "key")
    rules = [
        asked.join(hint(keys), "key").select("name", "by"),
        asked.select("name", F.explode(_suffixes(F.col("host"))).alias("domain")).join(hint(domains), "domain").groupBy("name").agg(F.max_by("by", F.length("domain")).alias("by")),
        _only(asked.join(hint(people.select("shape", F.col("short").alias("full"), F.col("id").alias("by"))), "shape").filter(F.forall(F.zip_with("full", "short", lambda a, b: a.startswith(b)), lambda x: x))),
        asked.join(hint(initials), "key").select("name", "by"),
    ]

    def near(df: DataFrame) -> DataFrame:
        parts = keys.select(F.col("key").alias("other"), "by", F.explode(_segments(F.col("key"))).alias("s")).filter("s.text != ''")
        pairs = df.select("name", "key", F.explode(_places(F.col("key"))).alias("s")).join(hint(parts), "s").select("name", "key", "other", "by").distinct()
        # keys shorter than their parts share none: they are few, and every name of their length is compared
        short = keys.filter(F.length("key") <= MISSPELT).select(F.col("key").alias("other"), "by")
        pairs = pairs.union(df.filter(F.length("key") <= 2 * MISSPELT).select("name", "key", F.explode(F.sequence(F.lit(1), F.lit(MISSPELT))).alias("n")).join(hint(short.withColumn("n", F.length("other"))), "n").select("name", "key", "other", "by"))
        hits = pairs.withColumn("d", F.levenshtein("key", "other")).filter(F.col("d") <= MISSPELT)
        best = hits.groupBy("name").agg(F.min("d").alias("least"))
        return _only(hits.join(best, "name").filter("d = least"))

    hits = reduce(DataFrame.union, [r.select("name", "by", F.lit(k).alias("rule")) for k, r in enumerate([*rules, near(asked)])])
    return cut(hits.groupBy("name").agg(F.min_by("by", "rule").alias("by")))


def with_contributor(tables: list[tuple[DataFrame, str, str]], contributor: DataFrame, feeds: DataFrame) -> list[DataFrame]:
    """Add ``contributor_id`` to each of ``tables`` (rows, URL, name): the contributor whose domain holds the host of the
    URL, otherwise the one that the name means.  Hosts and names are resolved once each, for all tables together: their
    distinct values are counted map-side and joined back."""
    known = small(contributor.filter("domain is not null").select(F.lower("domain").alias("_domain"), F.col("contributor_id").cast("bigint").alias("_by_host")))
    out = []
    for rows, url, name in tables:
        rows = rows.withColumn("_host", F.regexp_replace(host_of(F.col(url)), r"\.$", ""))
        hosts = rows.select("_host").distinct().filter("_host != ''").select("_host", F.explode(_suffixes(F.col("_host"))).alias("_domain"))
        hosts = hosts.join(known, "_domain").groupBy("_host").agg(F.max_by("_by_host", F.length("_domain")).alias("_by_host"))
        rows = rows.join(hosts, "_host", "left").drop("_host")
        out.append(rows.withColumn("_asks", F.when(F.col("_by_host").isNull(), F.col(name))))
    names = reduce(DataFrame.union, [rows.select(F.col("_asks").alias("name")).filter("name is not null").distinct() for rows in out]).distinct()
    names = resolved(names, contributor, feeds).select(F.col("name").alias("_asks"), F.col("by").alias("_by_name"))
    return [rows.join(names, "_asks", "left").withColumn("contributor_id", F.coalesce("_by_host", "_by_name")).drop("_asks", "_by_host", "_by_name") for rows in out]
