"""Entity resolution: exact keys, fuzzy titles near in time, their closure, and the richest record of each cluster."""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from feedloom.functions.text import comparable_title
from feedloom.functions.udfs import close_letters, letter_bits, letter_codes, ratio_from
from feedloom.operators.components import components
from feedloom.session import cut

#: The most titles, about, that one side of a block holds.
BLOCK = 24_576


def key_edges(df: DataFrame, row_id: str, keys: list[Column]) -> DataFrame:
    """``(a, b)``: every record linked to the first one that shares a key; a star for each key, never all pairs."""
    each = df.select(F.col(row_id).alias("b"), F.explode(F.array_compact(F.array(*[F.when(k != "", F.concat(F.lit(f"{i}:"), k)) for i, k in enumerate(keys)]))).alias("key"))
    first = each.groupBy("key").agg(F.min("b").alias("a"), F.count("*").alias("n")).filter("n > 1").drop("n")
    return each.join(first, "key").filter("a < b").select("a", "b").distinct()


def clusters(df: DataFrame, row_id: str, edges: DataFrame) -> DataFrame:
    """``df`` with ``cluster_id``: the smallest record id that a record is linked to, directly or not."""
    roots = components(edges).select(F.col("node").alias(row_id), F.col("root"))
    return df.join(roots, row_id, "left").withColumn("cluster_id", F.coalesce("root", row_id)).drop("root")


def richness(doi: Column, pmid: Column, authors: Column, summary: Column, published: Column, tags: Column) -> Column:
    """How complete a record is."""
    filled = lambda c: F.coalesce(F.trim(c), F.lit("")) != ""
    some = lambda c, n: F.when(c, n).otherwise(0)
    size = lambda c: F.coalesce(F.size(c), F.lit(0))
    return (some(filled(doi), 10) + some(filled(pmid), 8) + size(authors) + F.least(F.floor(F.length(F.coalesce(summary, F.lit(""))) / 50), F.lit(10)) + some(filled(published), 5) + size(tags)).cast("bigint")


def best_of(df: DataFrame, cluster: str, score: str, row_id: str) -> DataFrame:
    """One row a cluster: the highest score, then the smallest id.  The aggregate is combined map-side, so that a large
    cluster is never gathered."""
    others = [c for c in df.columns if c != cluster]
    best = F.max_by(F.struct(*others), F.struct(F.col(score), -F.col(row_id)))
    return df.groupBy(cluster).agg(best.alias("_best"), F.count("*").alias("cluster_size")).select(cluster, "cluster_size", "_best.*")


def fuzzy_titles(df: DataFrame, row_id: str, title: str, at: str, threshold: float = 0.85, days: int = 7, ready: bool = False) -> DataFrame:
    """``(x, y, a, b, similarity)``: different titles with a matching-block ratio of at least ``threshold``, the first record of
    each, and their ratio, the earlier record's title first.  Only titles with records in neighbouring periods of ``days``
    are compared; a record without a date is near all.  With ``ready``, ``title`` is a comparable one already.

    Every title is compared once, however many records carry it.  Exact pruning: lengths must satisfy min/max >= t / (2 - t),
    letters bound the matching blocks from above, then the longest common subsequences of parts of the alphabet do, then that
    of all letters.  Titles meet in blocks of at most about ``BLOCK`` on either side, each held by one task.
    """
    spark = df.sparkSession
    day = F.floor(F.unix_micros(F.col(at).cast("timestamp")) / F.lit(86_400_000_000.0) / days).cast("bigint")
    seen = df.select(F.col(row_id).cast("bigint").alias("id"), (F.col(title) if ready else comparable_title(F.col(title))).alias("t"), day.alias("cell")).filter("t != ''")
    titles = seen.groupBy("t").agg(F.min("id").alias("id")).withColumn("n", F.length("t")).withColumn("bits", letter_bits("t")).withColumn("code", letter_codes("t"))
    titles = cut(titles.select("t", "id", "n", "code", *[F.get("bits", F.lit(k)).alias(f"k{k}") for k in range(4)]).withColumn("other", F.col("n") - reduce(lambda x, y: x + y, [F.bit_count(f"k{k}") for k in range(4)])))
    brief = titles.drop("t")
    cells = cut(seen.select("t", "cell").distinct().join(titles.select("t", "id"), "t").select("id", "cell"))
    # what is left of either step costs far more a row than moving it: over all cores, whatever its size in bytes
    cores = max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    part = lambda k: F.pmod(F.xxhash64("id"), k)
    every = lambda k: F.explode(F.sequence(F.lit(0).cast("bigint"), k - 1))

    def side(rows: DataFrame, left: bool, own: Column, *key: Column) -> DataFrame:
        """``rows`` at one side of the groups of ``key``."""
        return rows.select(*[k.alias(f"g{i}") for i, k in enumerate(key)], F.lit(left).alias("left"), own.alias("own"), *brief.columns)

    when = cells.filter("cell is not null")
    blocks = cut(when.groupBy("cell").agg(F.ceil(F.count("*") / BLOCK).alias("k")))
    when = when.join(brief, "id")
    here, after = when.join(blocks, "cell"), when.withColumn("cell", F.col("cell") - 1).join(blocks, "cell")
    dated = [
        side(here.withColumn("r", every(F.col("k"))), True, F.lit(True), F.col("cell"), part(F.col("k")), F.col("r")),
        side(here.withColumn("l", every(F.col("k"))), False, F.lit(True), F.col("cell"), F.col("l"), part(F.col("k"))),
        side(after.withColumn("l", every(F.col("k"))), False, F.lit(False), F.col("cell"), F.col("l"), part(F.col("k"))),
    ]
    without = cells.filter("cell is null").select("id")
    few = max(1, math.ceil(without.count() / BLOCK))
    all_ = max(math.ceil(cores / few), math.ceil(titles.count() / BLOCK))  # each block is prepared anew wherever it meets others
    wide, few, all_, none = 2 * cores, F.lit(few).cast("bigint"), F.lit(all_).cast("bigint"), F.lit(None).cast("bigint")
    undated = [
        side(brief.join(without, "id", "left_semi").withColumn("r", every(all_)), True, F.lit(True), none, part(few), F.col("r")),
        side(brief.join(without.withColumn("own", F.lit(True)), "id", "left").withColumn("l", every(few)), False, F.coalesce("own", F.lit(False)), none, F.col("l"), part(all_)),
    ]
    met = reduce(DataFrame.union, dated + undated).repartition(8 * cores, "g0", "g1", "g2")  # large blocks seldom share a task
    pairs = cut(met.groupBy("g0", "g1", "g2").applyInArrow(close_letters(threshold), "a bigint, b bigint").distinct())
    pairs = pairs.join(titles.select(F.col("id").alias("a"), F.col("t").alias("x")), "a").join(titles.select(F.col("id").alias("b"), F.col("t").alias("y")), "b")
    pairs = pairs.repartition(wide, "a", "b")
    return pairs.withColumn("similarity", F.round(ratio_from(threshold)("x", "y"), 6)).filter("similarity is not null").select("x", "y", "a", "b", "similarity")


def title_edges(df: DataFrame, row_id: str, title: str, at: str, links: DataFrame, days: int = 7, ready: bool = False) -> DataFrame:
    """``(a, b)``: edges whose closure is that of all records with equal or linked titles (``links``: x, y) within ``days`` of each
    other, or without a date.

    A title, and each pair of linked ones, is a group of records; in a group a period of ``days`` is a star, neighbouring
    periods are joined by their nearest records, and a group with an undated record is one star.  So a common title
    gives one edge a record and is never gathered.
    """
    own = df.select(F.col(row_id).alias("id"), (F.col(title) if ready else comparable_title(F.col(title))).alias("t"), F.unix_micros(F.col(at).cast("timestamp")).alias("at")).filter("t != ''")
    group = F.concat_ws("\n", "x", "y")
    member = links.select(F.col("x").alias("t"), group.alias("g")).union(links.select(F.col("y").alias("t"), group.alias("g")))
    rows = cut(own.withColumn("g", F.col("t")).union(own.join(member, "t").select("id", "t", "at", "g")).select("g", "id", "at", F.floor(F.col("at") / F.lit(86_400_000_000.0) / days).cast("bigint").alias("cell")))
    whole = rows.groupBy("g").agg(F.min("id").alias("a"), F.max(F.col("at").isNull()).alias("undated"))
    star = rows.join(whole.filter("undated").select("g", "a"), "g").select("a", F.col("id").alias("b"))
    dated = rows.join(whole.filter("undated").select("g"), "g", "left_anti")
    cells = dated.groupBy("g", "cell").agg(F.min("id").alias("a"), F.min(F.struct("at", "id")).alias("first"), F.max(F.struct("at", "id")).alias("last"))
    within = dated.join(cells.select("g", "cell", "a"), ["g", "cell"]).select("a", F.col("id").alias("b"))
    following = cells.select("g", (F.col("cell") - 1).alias("cell"), F.col("first").alias("then"))
    across = cells.join(following, ["g", "cell"]).filter(F.col("then.at") - F.col("last.at") <= days * 86_400_000_000).select(F.col("last.id").alias("a"), F.col("then.id").alias("b"))
    edges = star.union(within).union(across)
    return edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).filter("a < b").distinct()


def occurrences(df: DataFrame, key: Column, row_id: str) -> DataFrame:
    """The first record of each key and how often the key occurs."""
    return df.withColumn("_key", key).groupBy("_key").agg(F.min(row_id).alias("first_id"), F.count("*").alias("occurrences")).withColumnRenamed("_key", "article_key")


def duplicates_in_order(df: DataFrame, row_id: str, keys: list[Column]) -> DataFrame:
    """Records that repeat an earlier record by any key."""
    return key_edges(df, row_id, keys).select(F.col("b").alias(row_id)).distinct()


def first_window(df: DataFrame, by: list[str], order: list[Column]) -> DataFrame:
    """The first row of each key: distinct with an order."""
    return df.withColumn("_rn", F.row_number().over(Window.partitionBy(*by).orderBy(*order))).filter("_rn = 1").drop("_rn")
