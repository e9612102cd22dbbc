"""Near-duplicate records: an exact set-similarity join with index lists, block skipping and shared answers.

A record is the set of words of its fields.  Words in more than a fixed share of the records are *frequent* (at most
``MAX_FREQUENT`` of them, counted over all records), the others *rare*.  With threshold t, two sets x and y match only
if ``|x ^ y| <= b (|x| + |y|)`` where ``b = (1 - t) / (1 + t)``.  Every matching pair meets in one of two indexes:

* it shares a rare word: the index list of that word.  Lists are joined whole: entries that cannot reach the threshold are
  passed over pair by pair, by size, by the position of the word in both sets, and by a 128-bit parity sketch, whose
  difference never exceeds ``|x ^ y|``.  A list holds at most ``FREQUENT_SHARE`` of the records, so over a closed vocabulary
  the pairs grow with the square of the records;
* it shares none: then its frequent words differ by at most ``c(x) + c(y)`` with ``c = b |x| - rare words``, a few words.
  Frequent words fall into more hash groups than that, so that at least one group is the same on both sides, and a
  prefix of the groups, those of most words first, is enough.  Records are kept in levels by ``c``.

Sets that are equal share their answers: only the smallest identifier of such a class is joined, its answers hold for
the class.  Candidates are verified by the true overlap.  No word, list or candidate is capped or dropped.

Defined results: records with a null or blank field, or without words, match nothing; ties do not occur; repeated rows
are members of one class; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedloom.llm.common import cut, stored, word_hash, words
from feedloom.operators.components import components

#: A word in more than this share of the records is frequent; so many are the most, by their number of records.
FREQUENT_SHARE, MAX_FREQUENT = 0.002, 32_000
#: Hash groups of the lowest level; each level has twice as many.
LEAST_GROUPS = 4
#: What rounding may take from a bound that is a whole number.
EPSILON = 1e-9
_MASK = (1 << 64) - 1


def _blank(x: str | None) -> bool:
    return x is None or not x.strip()


def _hashes(fields: list[list[str | None]]) -> Iterator[tuple[int, list[int]]]:
    """The distinct word hashes of each row whose fields are all filled."""
    for k, row in enumerate(zip(*fields)):
        if not any(map(_blank, row)):
            found = {word_hash(w) for w in words("\n".join(row))}
            if found:
                yield k, sorted(found)


def _columns(df: DataFrame, row_id: str, fields: list[str]) -> DataFrame:
    return df.select(F.col(row_id).cast("bigint").alias("id"), *[F.col(f).cast("string").alias(f"f{i}") for i, f in enumerate(fields)])


def hashed(df: DataFrame, row_id: str, fields: list[str]) -> DataFrame:
    """``(id, words array<bigint>, s0, s1, k0, k1)``: the sets of all records with their sketches and the keys of equal sets.
    Texts are read and hashed here, once."""
    import xxhash

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows: list[tuple] = []
            for k, found in _hashes([c.to_pylist() for c in b.columns[1:]]):
                s = [0, 0]
                for w in found:
                    s[w & 1] ^= 1 << (w >> 1 & 63)
                key = xxhash.xxh3_128_intdigest(np.array(found, np.int64).tobytes())
                rows.append((k, found, s[0], s[1], key >> 64, key & _MASK))
            if rows:
                k, found, *longs = zip(*rows)
                yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(k)), pa.array(found, pa.list_(pa.int64())), *[pa.array(np.array(x, np.uint64).view(np.int64)) for x in longs]], ["id", "words", "s0", "s1", "k0", "k1"])

    return _columns(df, row_id, fields).mapInArrow(each, "id bigint, words array<bigint>, s0 bigint, s1 bigint, k0 bigint, k1 bigint")


def frequent_words(sets: DataFrame, share: float = FREQUENT_SHARE) -> list[int]:
    """The words of ``hashed`` in more than a share of the records: counted over all records; at most ``MAX_FREQUENT``."""
    n = sets.select(F.explode("words").alias("word")).groupBy("word").agg(F.count("*").alias("n")).filter(F.col("n") > share * sets.count())
    return [r.word for r in n.orderBy(F.desc("n"), "word").limit(MAX_FREQUENT).collect()]


def word_sets(sets: DataFrame, frequent: list[int]) -> DataFrame:
    """``(id, size, common array<smallint>, rare array<bigint>, s0, s1)``: the sets of ``hashed`` with frequent words by number."""
    order = np.argsort(np.array(frequent, np.int64))
    names = np.array(frequent, np.int64)[order]

    def lists(values: np.ndarray, row: np.ndarray, n: int, kind: pa.DataType) -> pa.ListArray:
        return pa.ListArray.from_arrays(pa.array(np.r_[0, np.bincount(row, minlength=n).cumsum()].astype(np.int32)), pa.array(values, kind))

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            offsets = np.asarray(b.column(1).offsets)
            words = np.asarray(b.column(1).values)[offsets[0] : offsets[-1]]
            row = np.repeat(np.arange(b.num_rows), np.diff(offsets))
            at = np.minimum(np.searchsorted(names, words), max(len(names) - 1, 0))
            known = names[at] == words if len(names) else np.zeros(len(words), bool)
            common = lists(order[at[known]].astype(np.int16), row[known], b.num_rows, pa.int16())
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(np.diff(offsets).astype(np.int32)), common, lists(words[~known], row[~known], b.num_rows, pa.int64()), b.column(2), b.column(3)], ["id", "size", "common", "rare", "s0", "s1"])

    return sets.select("id", "words", "s0", "s1").mapInArrow(each, "id bigint, size int, common array<smallint>, rare array<bigint>, s0 bigint, s1 bigint")


def _slack(t: float) -> float:
    return (1 - t) / (1 + t)


def _differ(x: str, y: str) -> Column:
    """At most the number of words that are in one of two sets only."""
    return F.bit_count(F.col(f"{x}.s0").bitwiseXOR(F.col(f"{y}.s0"))) + F.bit_count(F.col(f"{x}.s1").bitwiseXOR(F.col(f"{y}.s1")))


def _rare_pairs(sets: DataFrame, t: float) -> DataFrame:
    """Pairs that meet in the index list of a rare word and pass its skipping rules."""
    need = t / (1 + t)
    entry = sets.select("id", "size", "s0", "s1", F.size("rare").alias("r"), F.posexplode("rare").alias("at", "word"))
    left, right = entry.alias("l"), entry.alias("r")
    total = F.col("l.size") + F.col("r.size")
    # the word is the first that both share: of each set's rare words, those before it are in no common part
    reach = 1 + F.least(F.col("l.size") - F.col("l.at"), F.col("r.size") - F.col("r.at")) - 1
    on = (F.col("l.word") == F.col("r.word")) & (F.col("l.id") < F.col("r.id")) & (_differ("l", "r") <= _slack(t) * total + EPSILON) & (reach >= need * total - EPSILON)
    return left.join(right, on).select(F.col("l.id").alias("a"), F.col("r.id").alias("b"))


def _level(c: Column) -> Column:
    """The groups of the lowest level with more than twice ``c``."""
    k = F.ceil(F.log2((F.floor(F.greatest(c, F.lit(0.0)) * 2 + EPSILON) + 1) / LEAST_GROUPS))
    return (F.lit(LEAST_GROUPS) * F.pow(F.lit(2), F.greatest(k, F.lit(0)))).cast("int")


def _group_keys(levels: list[int]):
    """Keys of the groups of frequent words that a record shows at each level, those of most words first."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids, c, own, size, s0, s1 = (b.column(i).to_numpy() for i in range(6))
            lists = b.column(6)
            offsets = np.asarray(lists.offsets)
            common = np.asarray(lists.values)[offsets[0] : offsets[-1]].astype(np.uint64)
            row = np.repeat(np.arange(len(ids)), np.diff(offsets))
            with np.errstate(over="ignore"):
                mixed = (common + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
                mixed = (mixed ^ (mixed >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
                mixed ^= mixed >> np.uint64(32)
                for m in levels:
                    p = np.floor(c + m / 2 + EPSILON).astype(np.int64) + 1
                    shown = (own <= m) & (p > 0)
                    if not shown.any():
                        continue
                    cell = row * m + (mixed % np.uint64(m)).astype(np.int64)
                    sums, sizes = np.zeros(len(ids) * m, np.uint64), np.bincount(cell, minlength=len(ids) * m).astype(np.int64)
                    np.add.at(sums, cell, (mixed * np.uint64(0x94D049BB133111EB)) ^ (mixed >> np.uint64(17)))
                    group = np.tile(np.arange(m, dtype=np.uint64), len(ids))
                    key = (sums ^ (group + np.uint64(m)) * np.uint64(0xD6E8FEB86659FD93)) * np.uint64(0xCA5A826395121157)
                    key ^= key >> np.uint64(31)
                    whose = np.repeat(np.arange(len(ids)), m)
                    order = np.lexsort((key, -sizes, whose))
                    rank = np.tile(np.arange(m), len(ids))
                    kept = (rank < p[whose[order]]) & shown[whose[order]]
                    take, at = order[kept], whose[order[kept]]
                    # of a pair the record with the larger c asks, so that twice its own c bounds what differs
                    asks = (own[at] == m) & (rank[kept] <= np.floor(2 * np.maximum(c[at], 0) + EPSILON))
                    yield pa.RecordBatch.from_arrays([pa.array(key[take].view(np.int64)), pa.array(ids[at]), pa.array((size[at] * 2 + asks).astype(np.int32)), pa.array(s0[at]), pa.array(s1[at])], ["key", "id", "flag", "s0", "s1"])

    return each


def _common_pairs(sets: DataFrame, t: float) -> DataFrame | None:
    """Pairs without a common rare word: they show an equal group of frequent words."""
    c = _slack(t) * F.col("size") - F.size("rare")
    shown = sets.select("id", c.alias("c"), _level(c).alias("own"), "size", "s0", "s1", "common")
    levels = [r.own for r in shown.select("own").distinct().orderBy("own").collect()]  # powers of two: a few dozen at most
    if not levels:
        return None
    keys = shown.mapInArrow(_group_keys(levels), "key bigint, id bigint, flag int, s0 bigint, s1 bigint")
    left, right = keys.filter("flag % 2 = 1").alias("l"), keys.alias("r")
    total = F.shiftright("l.flag", 1) + F.shiftright("r.flag", 1)
    on = (F.col("l.key") == F.col("r.key")) & (F.col("l.id") != F.col("r.id")) & (_differ("l", "r") <= _slack(t) * total + EPSILON)
    return left.join(right, on).select(F.least("l.id", "r.id").alias("a"), F.greatest("l.id", "r.id").alias("b"))


def similar_sets(sets: DataFrame, t: float) -> DataFrame:
    """``(a, b)``, a < b: every pair of different sets of ``word_sets`` whose Jaccard similarity is at least ``t``."""
    pairs, rest = _rare_pairs(sets, t), _common_pairs(sets, t)
    if rest is not None:
        pairs = pairs.union(rest)
    pairs = pairs.distinct()
    side = sets.select("id", "size", "common", "rare")
    x, y = side.alias("x"), side.alias("y")
    both = pairs.join(x, F.col("a") == F.col("x.id")).join(y, F.col("b") == F.col("y.id"))
    total = F.col("x.size") + F.col("y.size")
    shared = F.size(F.array_intersect("x.common", "y.common")) + F.size(F.array_intersect("x.rare", "y.rare"))
    return both.filter(shared / (total - shared) >= t - EPSILON).select("a", "b")


class NearDuplicates:
    """The join of one table: ``classes`` (id, rep) and ``links`` (a, b) between representatives."""

    def __init__(self, df: DataFrame, row_id: str, fields: list[str], t: float):
        self.all = stored(hashed(df, row_id, fields))
        reps = self.all.groupBy("k0", "k1").agg(F.min("id").alias("rep"), F.count("*").alias("n"))
        many = reps.filter("n > 1").drop("n")
        self.copies = cut(self.all.select("id", "k0", "k1").join(many, ["k0", "k1"]).select("rep", "id"))  # of classes of two and more, the representative too
        sets = self.all.join(self.copies.filter("id != rep").select("id"), "id", "left_anti")
        self.links = cut(similar_sets(cut(word_sets(sets, frequent_words(self.all))), t))

    def pairs(self) -> DataFrame:
        """``(seq_a, seq_b)`` of all matching records: the answers of each class hold for all its members."""
        l, r = self.copies.select(F.col("rep").alias("a"), F.col("id").alias("ia")), self.copies.select(F.col("rep").alias("b"), F.col("id").alias("ib"))
        wide = self.links.join(l, "a", "left").join(r, "b", "left").select(F.coalesce("ia", "a").alias("x"), F.coalesce("ib", "b").alias("y"))
        within = self.copies.alias("p").join(self.copies.alias("q"), (F.col("p.rep") == F.col("q.rep")) & (F.col("p.id") < F.col("q.id"))).select(F.col("p.id").alias("x"), F.col("q.id").alias("y"))
        return wide.union(within).select(F.least("x", "y").alias("seq_a"), F.greatest("x", "y").alias("seq_b"))

    def groups(self) -> DataFrame:
        """``(id, class_id, links)`` of every record with a near-duplicate: its group, and its links to other sets."""
        roots = components(self.links)
        degree = self.links.select(F.col("a").alias("rep")).union(self.links.select("b")).groupBy("rep").agg(F.count("*").alias("links"))
        one = roots.select(F.col("node").alias("rep"), F.col("root")).join(degree, "rep", "left")
        copies = self.copies.join(one, "rep", "left").select("id", F.coalesce("root", "rep").alias("class_id"), F.coalesce("links", F.lit(0)).alias("links"))
        alone = one.join(self.copies.select(F.col("id").alias("rep")), "rep", "left_anti").select(F.col("rep").alias("id"), F.col("root").alias("class_id"), "links")
        return copies.union(alone)
