"""Ages, freshness and periods as column expressions; ``as_of`` is always a parameter."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def age_days(at: Column, as_of: Column) -> Column:
    """Fractional days before ``as_of``."""
    return (F.unix_micros(as_of.cast("timestamp")) - F.unix_micros(at.cast("timestamp"))) / F.lit(86_400_000_000.0)


def whole_days(at: Column, as_of: Column) -> Column:
    """Days of 86,400 seconds, rounded down, so that one second ahead is day -1."""
    return F.floor(age_days(at, as_of)).cast("bigint")


def freshness(published: Column, updated: Column, fetched: Column) -> Column:
    """The date that counts, where it comes from, whether it stands in for another and how far it is trusted."""
    known = lambda c: c.isNotNull()
    made = lambda c, name, other, trust: F.struct(c.alias("at"), F.lit(name).alias("date_source"), F.lit(other).alias("used_fallback_date"), F.lit(trust).alias("freshness_confidence"))
    return F.when(known(published), made(published, "published_at", False, "high")).when(known(updated), made(updated, "updated_at", True, "medium")).otherwise(made(fetched, "fetched_at", True, "low"))


def close(a: Column, b: Column, days: int = 7) -> Column:
    """Within so many days, or unknown on either side."""
    return F.coalesce(F.abs(F.unix_micros(a.cast("timestamp")) - F.unix_micros(b.cast("timestamp"))) <= days * 86_400_000_000, F.lit(True))


def period(at: Column, first: Column, last: Column, periods: int) -> Column:
    """The equal period between first and last that a date falls in; the last date opens one more, a null one is -1."""
    us = lambda c: F.unix_micros(c.cast("timestamp"))
    days = lambda c: F.floor((us(c) - us(first)) / F.lit(86_400_000_000.0))
    width = F.nullif(days(last) / F.lit(float(periods)), F.lit(0.0))
    return F.when(at.isNull(), F.lit(-1)).otherwise(F.coalesce(F.floor(days(at) / width), F.lit(0))).cast("bigint")


def long_date(at: Column) -> Column:
    return F.date_format(at, "MMMM dd, yyyy")


def default_range(as_of: Column, days: int) -> tuple[Column, Column]:
    """From so many days ago until now."""
    return as_of - F.make_dt_interval(F.lit(days)), as_of


def recent(at: Column, as_of: Column, days: int) -> Column:
    """Not older than so many days; rows without a date pass."""
    return F.coalesce(at.cast("timestamp") >= as_of - F.make_dt_interval(F.lit(days)), F.lit(True))


def rederived(source: Column, trust: Column, published: Column, updated: Column, fetched: Column) -> Column:
    """``(date_source, used_fallback_date, freshness_confidence)`` for records that may not name their date's source."""
    named = F.when(F.coalesce(source, F.lit("")).isin("", "unknown", "none"), F.when(published.isNotNull(), "published_at").when(updated.isNotNull(), "updated_at").otherwise("fetched_at")).otherwise(source)
    fallback = published.isNull() & F.coalesce(updated.cast("string"), fetched.cast("string")).isNotNull()
    sure = F.coalesce(F.nullif(trust, F.lit("")), F.when(named == "published_at", "high").when(named == "updated_at", "medium").otherwise("low"))
    return F.struct(named.alias("date_source"), fallback.alias("used_fallback_date"), sure.alias("freshness_confidence"))


def first_known(dates: list[tuple[str, Column]], trusted: set[str]) -> Column:
    """``(date_source, freshness_confidence)`` of the first date of an ordered list that is there."""
    made = [F.when(c.isNotNull(), F.struct(F.lit(name).alias("date_source"), F.lit("medium" if name in trusted else "low").alias("freshness_confidence"))) for name, c in dates]
    return F.coalesce(*made, F.struct(F.lit("unknown").alias("date_source"), F.lit("low").alias("freshness_confidence")))
