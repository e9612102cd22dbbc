"""Profiles, histograms and diagnostics as aggregates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def top_values(df: DataFrame, value: Column, order: str, k: int) -> DataFrame:
    """The most common values; ties by first appearance."""
    n = df.groupBy(value.alias("value")).agg(F.count("*").alias("n"), F.min(order).alias("first_id"))
    return n.orderBy(F.desc("n"), "first_id").limit(k)


def profile(df: DataFrame, at: str, domain: Column, length: Column) -> DataFrame:
    """One row of counts, range, distinct domains and mean length (rounded down)."""
    return df.agg(F.count("*").alias("articles"), F.min(at).alias("first_at"), F.max(at).alias("last_at"), F.count_distinct(domain).alias("domains"), F.floor(F.avg(length)).cast("bigint").alias("mean_length"), F.count_if(F.col(at).isNull()).alias("missing_date"))


def peak_hour(df: DataFrame, at: str) -> DataFrame:
    n = df.filter(F.col(at).isNotNull()).groupBy(F.hour(at).cast("bigint").alias("hour")).agg(F.count("*").alias("n"))
    return n.orderBy(F.desc("n"), "hour").limit(1)


def histogram(df: DataFrame, value: Column, name: str) -> DataFrame:
    return df.groupBy(value.alias(name)).agg(F.count("*").alias("n"))


def repeated_phrases(df: DataFrame, text: Column, phrases: list[str], share: float) -> DataFrame:
    """Phrases that occur in at least ``max(2, share of the rows)``."""
    low = F.lower(F.coalesce(text, F.lit("")))
    counts = df.agg(F.count("*").alias("rows"), *[F.count_if(F.contains(low, F.lit(p))).alias(f"n{i}") for i, p in enumerate(phrases)])
    long = counts.select("rows", F.explode(F.array(*[F.struct(F.lit(p).alias("phrase"), F.col(f"n{i}").alias("n")) for i, p in enumerate(phrases)])).alias("e"))
    return long.filter(F.col("e.n") >= F.greatest(F.lit(2), F.floor(F.col("rows") * share))).select("e.phrase", "e.n")


def grouped_openings(df: DataFrame, key: Column, least: int = 3) -> DataFrame:
    """``df`` with ``is_grouped``: whether at least so many rows open alike; blank openings never do.

    Openings are counted map-side and joined back, so that a common one is not gathered in a window.
    """
    df = df.withColumn("_k", F.nullif(key, F.lit("")))
    often = df.filter("_k is not null").groupBy("_k").agg(F.count("*").alias("_n")).filter(F.col("_n") >= least)
    return df.join(often, "_k", "left").withColumn("is_grouped", F.col("_n").isNotNull()).drop("_k", "_n")


def diagnostics(df: DataFrame, flags: dict[str, Column], reason: Column, source: Column, words: int = 4) -> DataFrame:
    """``(name, n)``: all rows, the rows of each flag, of each reason (by its first words) and of each source, in one pass:
    every row gives the names it counts for, which are added up map-side."""
    names = [F.lit("total"), F.concat(F.lit("source:"), F.coalesce(source, F.lit("unknown"))), F.concat(F.lit("reason:"), F.array_join(F.slice(F.split(reason, " "), 1, words), " "))]
    names += [F.when(c, F.lit(f"flag:{name}")) for name, c in flags.items()]
    return df.select(F.explode(F.array_compact(F.array(*names))).alias("name")).groupBy("name").agg(F.count("*").alias("n"))
