"""State across runs: prioritised lookups, novelty, and snapshots that are upserted by outer joins.

A snapshot is a DataFrame; the caller writes the next version to a new directory and swaps it.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedloom.functions.dates import whole_days

NEW, SEEN, EMITTED, REAPPEARED, UPDATED = "new", "seen_not_emitted", "previously_emitted", "reappeared_after_threshold", "updated_existing_item"


def lookup(items: DataFrame, item_id: str, item_keys: list[Column], known: DataFrame, known_id: str, known_keys: list[Column]) -> DataFrame:
    """``items`` with ``match_id`` and ``match_priority``: the known row of the first key that hits, smallest id first.

    All keys of a row become one table of (priority, key), joined once; the best hit is a map-side combined minimum.
    """
    exploded = lambda df, i, keys, name: df.select(F.col(i).alias(name), F.posexplode(F.array(*[F.nullif(F.trim(k), F.lit("")) for k in keys])).alias("p", "k")).filter("k is not null")
    mine, theirs = exploded(items, item_id, item_keys, "_i"), exploded(known, known_id, known_keys, "_m")
    best = mine.join(theirs, ["p", "k"]).groupBy("_i").agg(F.min(F.struct("p", "_m")).alias("_hit"))
    out = items.join(best, F.col(item_id) == F.col("_i"), "left")
    return out.withColumn("match_id", F.col("_hit._m")).withColumn("match_priority", F.col("_hit.p").cast("bigint")).drop("_i", "_hit")


def novelty(times_emitted: Column, last_emitted: Column, as_of: Column, allow_after_days: int, changed: Column | None = None) -> Column:
    """The novelty of an item from its stored row; a null count means that there is none."""
    state = F.when(times_emitted.isNull(), NEW)
    if changed is not None:
        state = state.when(changed, UPDATED)
    return state.when(times_emitted == 0, SEEN).when(whole_days(last_emitted, as_of) >= allow_after_days, REAPPEARED).otherwise(EMITTED)


def upsert(snapshot: DataFrame, batch: DataFrame, key: str, keep: list[str], refresh: dict[str, Column], counters: dict[str, Column]) -> DataFrame:
    """The next snapshot: stored columns stay (``keep``), ``refresh`` is overwritten if the batch has the key, ``counters``
    are added.  ``batch`` has one row a key, with the same column names and the values for new rows."""
    b = batch.select(F.col(key).alias("_k"), *[F.col(c).alias(f"_b_{c}") for c in [*keep, *refresh, *counters]])
    out = snapshot.join(b, F.col(key) == F.col("_k"), "full_outer")
    cols = [F.coalesce(key, "_k").alias(key)]
    cols += [F.when(F.col(key).isNull(), F.col(f"_b_{c}")).otherwise(F.col(c)).alias(c) for c in keep]
    cols += [F.coalesce(F.col(f"_b_{c}"), F.col(c)).alias(c) for c in refresh]
    cols += [(F.coalesce(F.col(c), F.lit(0)) + F.coalesce(F.col(f"_b_{c}"), F.lit(0))).alias(c) for c in counters]
    return out.select(*cols)


def mark_emitted(snapshot: DataFrame, emitted: DataFrame, key: str, at: Column) -> DataFrame:
    """Add one to ``times_emitted`` for each occurrence of a key and set ``last_emitted_at``."""
    n = emitted.filter(F.col(key).isNotNull()).groupBy(F.col(key).alias("_k")).agg(F.count("*").alias("_n"))
    out = snapshot.join(n, F.col(key) == F.col("_k"), "left")
    return out.withColumn("times_emitted", F.col("times_emitted") + F.coalesce("_n", F.lit(0))).withColumn("last_emitted_at", F.when(F.col("_n").isNotNull(), at).otherwise(F.col("last_emitted_at"))).drop("_k", "_n")


def changes(df: DataFrame, pairs: dict[str, tuple[str, str]]) -> Column:
    """The names of the fields whose two values differ, both being there, white space and case aside."""
    norm = lambda c: F.lower(F.trim(F.regexp_replace(F.coalesce(F.col(c), F.lit("")), r"\s+", " ")))
    return F.array_compact(F.array(*[F.when((norm(a) != "") & (norm(b) != "") & (norm(a) != norm(b)), F.lit(name)) for name, (a, b) in pairs.items()]))


def stats(snapshot: DataFrame) -> DataFrame:
    return snapshot.agg(F.count("*").alias("total"), F.count_if(F.col("times_emitted") > 0).alias("emitted"), F.count_if(F.col("times_seen") > 1).alias("seen_again"), F.max("last_seen_at").alias("last_seen_at"))


def union_all(frames: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), frames)


def suppressed(state: Column, emitted: bool, seen: bool) -> Column:
    """Whether an item of this novelty is held back; updated and reappeared items never are."""
    held = [s for s, on in ((EMITTED, emitted), (SEEN, seen)) if on]
    return state.isin(*held) if held else F.lit(False)


def window_state(known: Column, seen_days: Column, emitted_days: Column, allow_after_days: int, emitted: bool, seen: bool) -> Column:
    """``(status, seen_days, emitted_days, suppressed)`` of an article and its stored row: within the window after its
    emission, or after its first sighting if it never was emitted, it is held back where that is switched on."""
    was = emitted_days.isNotNull()
    held = F.when(was, (emitted_days < allow_after_days) & emitted).otherwise((seen_days < allow_after_days) & seen)
    status = F.when(~known, NEW).when(was, "emitted").otherwise("seen")
    return F.struct(status.alias("status"), seen_days.alias("seen_days"), emitted_days.alias("emitted_days"), F.coalesce(held, F.lit(False)).alias("suppressed"))


def mark_published(snapshot: DataFrame, chosen: DataFrame, key: str, at: str, update_history: bool = False) -> DataFrame:
    """Set ``emitted_at`` of the chosen rows; nothing changes unless ``update_history`` is on."""
    if not update_history:
        return snapshot
    marks = chosen.select(F.col(key).alias("_k")).distinct()
    return snapshot.join(marks, F.col(key) == F.col("_k"), "left").withColumn("emitted_at", F.when(F.col("_k").isNotNull(), F.lit(at)).otherwise(F.col("emitted_at"))).drop("_k")
