"""Queries of problem 2: one UTC instant for every timestamp of the feeds."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedloom.operators import timestamps as ts
from feedloom.plans.instants_sql import INSTANTS_SQL
from feedloom.session import load


def _feeds(spark: SparkSession, sf: str, key: str) -> DataFrame:
    """The writers' zones and digit orders; one row a key."""
    feeds = load(spark, sf, "feed_config").filter(F.col(key).isNotNull())
    return feeds.groupBy(F.col(key).alias("feed")).agg(F.min_by("tz_name", "feed_id").alias("tz"), F.min_by("date_order", "feed_id").alias("date_order"))


def _candidates(spark: SparkSession, sf: str) -> list[str]:
    """The zones that the configuration names: no more than there are zones."""
    found = load(spark, sf, "feed_config").select("tz_name").distinct().dropna().orderBy("tz_name").collect()
    return [r[0] for r in found]


def _values(spark: SparkSession, sf: str) -> DataFrame:
    """``source_table, row_id, field_name, feed, value``, those that are canonical already left out."""
    items = load(spark, sf, "normalized_item").select(F.col("seq").alias("row_id"), F.col("feed_url").alias("feed"), "published_at", "updated_at", "fetched_at")
    items = items.select("row_id", "feed", "fetched_at", F.explode(F.create_map(F.lit("published_at"), F.col("published_at"), F.lit("updated_at"), F.col("updated_at"))).alias("field_name", "value"))
    old = load(spark, sf, "history").select(F.col("id").alias("row_id"), F.col("source_name").alias("feed"), F.col("last_seen_at").try_cast("timestamp").alias("fetched_at"), F.lit("first_seen_at").alias("field_name"), F.col("first_seen_at").alias("value"))
    both = items.withColumn("source_table", F.lit("normalized_item")).unionByName(old.withColumn("source_table", F.lit("history")))
    return both.filter(F.col("value").isNotNull() & ~F.col("value").rlike(ts.CANONICAL))


def _with_zones(spark: SparkSession, sf: str, values: DataFrame) -> DataFrame:
    """Declared zones, and estimates for the writers that have none."""
    feeds = _feeds(spark, sf, "url").unionByName(_feeds(spark, sf, "name")).groupBy("feed").agg(F.min("tz").alias("tz"), F.min("date_order").alias("date_order"))
    known = values.join(feeds, "feed", "left")
    guess = ts.estimate_zones(known.filter("tz is null and field_name != 'updated_at'"), "feed", "value", "date_order", "fetched_at", _candidates(spark, sf))
    return known.join(guess.select("feed", "zone_estimate"), "feed", "left").withColumn("tz", F.coalesce("tz", "zone_estimate"))


def p2_found(spark: SparkSession, sf: str) -> DataFrame:
    """One row for each value that names an instant and is not written canonically already."""
    at = ts.to_utc_us(_with_zones(spark, sf, _values(spark, sf)), "value", "tz", "date_order")
    return at.filter("utc_us is not null").select("source_table", "row_id", "field_name", "utc_us")


def p2_zone_estimates(spark: SparkSession, sf: str) -> DataFrame:
    """For each feed the zone that its local times and their ingestion suggest, beside the declared one."""
    feeds = _feeds(spark, sf, "url")
    values = _values(spark, sf).filter("field_name = 'published_at'").join(feeds, "feed")
    guess = ts.estimate_zones(values, "feed", "value", "date_order", "fetched_at", _candidates(spark, sf))
    return guess.join(feeds.select("feed", F.col("tz").alias("declared")), "feed", "left").select(F.col("feed").alias("feed_url"), "declared", "zone_estimate", "violations", "values_used")


QUERIES = {"p2_found": p2_found, "p2_zone_estimates": p2_zone_estimates}
SQL = {"p2_found": f"with {INSTANTS_SQL} select source_table, row_id, field_name, us as utc_us from instants where us is not null and not regexp_matches(v, '^\\d{{4}}-\\d{{2}}-\\d{{2}}T\\d{{2}}:\\d{{2}}:\\d{{2}}\\+00:00$')"}
