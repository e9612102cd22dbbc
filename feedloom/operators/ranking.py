"""Top rows under caps, overflow of tiers, and the ordered selection in which several caps interact."""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from feedloom.session import cut


def capped_top(df: DataFrame, group: str, order: list[Column], cap: int, n: int, existing: DataFrame | None = None) -> DataFrame:
    """The first ``n`` rows in order with at most ``cap`` of each group, those of ``existing`` (group, n) counted before.  The
    cap is a row number, whose limit Spark applies before the shuffle, so that a dominant group sends at most ``cap`` rows
    from each task."""
    kept = df.withColumn("_rn", F.row_number().over(Window.partitionBy(group).orderBy(*order))).filter(F.col("_rn") <= cap)
    if existing is not None:
        before = existing.select(F.col(group).alias("_g"), F.col("n").alias("_n"))
        kept = kept.join(before, F.col(group) == F.col("_g"), "left").filter(F.col("_rn") + F.coalesce("_n", F.lit(0)) <= cap).drop("_g", "_n")
    return kept.drop("_rn").orderBy(*order).limit(n)


def first_rows(df: DataFrame, order: list[Column], n: int) -> DataFrame:
    """The first ``n`` rows in order; 0 means all."""
    return df.orderBy(*order).limit(n) if n else df.orderBy(*order)


def ranked(df: DataFrame, order: list[Column]) -> DataFrame:
    """``df`` with ``rank`` from 1.  Rows are range-partitioned, numbered in their partition, and moved by the sizes of the
    partitions before; no task sees all rows.  ``order`` must tell all rows apart."""
    parts = cut(df.orderBy(*order).withColumn("_part", F.spark_partition_id()))
    sizes = parts.groupBy("_part").agg(F.count("*").alias("_size"))  # one row a partition
    offset = sizes.select("_part", F.coalesce(F.sum("_size").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_offset"))
    own = F.row_number().over(Window.partitionBy("_part").orderBy(*order)) + F.col("_offset")
    return parts.join(F.broadcast(offset), "_part").withColumn("rank", own.cast("bigint")).drop("_part", "_offset")


def first_distinct(df: DataFrame, group: str, order: str, label: str, n: int) -> DataFrame:
    """``(group, labels)``: the first ``n`` different labels of each group in order; repeats are removed map-side first."""
    once = df.filter(F.col(label).isNotNull()).groupBy(group, label).agg(F.min(order).alias("_o"))
    first = once.withColumn("_rn", F.row_number().over(Window.partitionBy(group).orderBy("_o"))).filter(F.col("_rn") <= n)
    return first.groupBy(group).agg(F.transform(F.array_sort(F.collect_list(F.struct("_o", F.col(label).alias("l")))), lambda x: x["l"]).alias("labels"))


def cap_audit(df: DataFrame, row_id: str, order: str, source: str, roles: list[tuple[str, str, int]], regimes: dict[str, int | None]) -> DataFrame:
    """``(regime, role, n)``: how many rows fill each role if one source may have so many of it (None: any number)."""
    out = []
    for regime, cap in regimes.items():
        made = select_ordered(df, row_id, order, {}, roles, role_caps={r: {source: cap} for r, *_ in roles} if cap else None)
        out.append(made.filter("role != 'rejected'").groupBy("role").agg(F.count("*").alias("n")).select(F.lit(regime).alias("regime"), "role", "n"))
    return reduce(DataFrame.union, out)


def overflow(df: DataFrame, row_id: str, tier: str, order: list[Column], cap: int, full: str, to: str) -> DataFrame:
    """Rows of tier ``full`` beyond the first ``cap`` in order move to tier ``to``; only ``cap`` ids are kept aside."""
    top = df.filter(F.col(tier) == full).orderBy(*order).limit(cap).select(F.col(row_id).alias("_id"), F.lit(True).alias("_top"))
    out = df.join(top, F.col(row_id) == F.col("_id"), "left")
    return out.withColumn(tier, F.when((F.col(tier) == full) & F.col("_top").isNull(), to).otherwise(F.col(tier))).drop("_id", "_top")


def select_ordered(df: DataFrame, row_id: str, order: str, caps: dict[str, int], roles: list[tuple[str, str, int]], role_caps: dict[str, dict[str, int]] | None = None, periods: tuple[str, str, int] | None = None) -> DataFrame:
    """``(row_id, role)``: one pass in order; a row takes the first role whose gate it passes, whose ceiling is not met and
    whose caps leave room; other rows get ``rejected``.

    ``roles`` are (name, gate column, ceiling), ``caps`` are columns and their limits over all chosen rows, ``role_caps`` limits
    within a role.  ``periods`` (role, column, number of periods) spreads a role over time: a period takes at most its share
    of the ceiling, at least one; rows without a period (negative) enter while fewer than 0.8 of the ceiling are dated.

    Rows that pass no gate never enter the pass.  Of those that do, of one combination of gates and capped values at most
    the sum of the ceilings can be chosen; only so many of each go on, from each task and again from each combination,
    which is exact.  The pass itself goes through what is left in order, a batch of rows at a time, and stops once every
    role is full.
    """
    wanted, role_caps = sum(n for *_, n in roles), role_caps or {}
    gates, capped = [g for _, g, _ in roles], list(dict.fromkeys([*caps, *(c for x in role_caps.values() for c in x), *([periods[1]] if periods else [])]))
    some = df.select(F.col(row_id).cast("bigint").alias("id"), F.col(order).cast("double").alias("o"), *gates, *capped).filter(" or ".join(gates))
    mine = Window.partitionBy(*gates, *capped).orderBy(F.desc("o"), "id")
    some = some.withColumn("_rn", F.row_number().over(mine)).filter(F.col("_rn") <= wanted).drop("_rn")

    def choose(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        room, used, own = {r: n for r, _, n in roles}, {}, {}
        for rows in batches:
            out = []
            for row in rows.to_dict("records") if any(room.values()) else ():
                for role, gate, ceiling in roles:
                    if not row[gate] or room[role] <= 0 or any(used.get((c, row[c]), 0) >= n for c, n in caps.items()):
                        continue
                    if any(own.get((role, c, row[c]), 0) >= n for c, n in role_caps.get(role, {}).items()):
                        continue
                    if periods and periods[0] == role:
                        _, column, count = periods
                        when = row[column]
                        if when is not None and when >= 0:
                            if own.get((role, "period", when), 0) >= max(1, ceiling // count):
                                continue
                            own[role, "period", when] = own.get((role, "period", when), 0) + 1
                            own[role, "dated"] = own.get((role, "dated"), 0) + 1
                        elif own.get((role, "dated"), 0) >= ceiling * 0.8:
                            continue
                    room[role] -= 1
                    for c in caps:
                        used[c, row[c]] = used.get((c, row[c]), 0) + 1
                    for c in role_caps.get(role, {}):
                        own[role, c, row[c]] = own.get((role, c, row[c]), 0) + 1
                    out.append((row["id"], role))
                    break
            if out:
                yield pd.DataFrame(out, columns=["id", "role"])

    # sorted by range over all cores, then read in order by one task, which holds a batch at a time
    chosen = some.orderBy(F.desc("o"), "id").coalesce(1).mapInPandas(choose, "id bigint, role string")
    return df.select(F.col(row_id).cast("bigint").alias(row_id)).join(chosen, F.col(row_id) == F.col("id"), "left").select(row_id, F.coalesce("role", F.lit("rejected")).alias("role"))
