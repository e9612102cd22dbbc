"""New batches against everything accepted: exact keys and a pivot-distance table of titles, to which batches are appended.

What has been accepted is kept as three tables (:class:`Accepted`): the keys of every row (dedupe key, doi, pmid,
fingerprint, URL, title), the distances of every title to fixed pivots, and how often a title carries each identifier.
They are written once, partitioned by hash and by pivot cell; a batch reads the partitions it touches, and appending
it writes its own rows only.  Nothing is worked out again from the accepted rows themselves.

Titles live in the metric space of letter counts: the distance of two titles is the number of letters that one has
more than the other.  It does not see the order of words, so two parts may change places, and is at most twice the
number of edits.  The pivots are the empty text and long runs of fixed letter groups.  By the triangle inequality two
titles within ``RADIUS`` differ by no more than that in each pivot distance: rows are range-partitioned into cells of
the first pivot's distance, a new title visits the cells in reach, the other pivots and a parity sketch bound the distance
from below, and the true distance and the words decide.  Two titles of one article share all but ``MISSPELT`` of their
words, so within a cell only those meet that share two of their longest words.

Defined results: null, blank, placeholder and stub keys match nothing, and neither do titles that stand for none; titles
of recurring columns (:func:`columns_of`) name no article; titles of fewer than ``LEAST_WORDS`` words match when they are
equal, not by edits; an item that repeats something is not accepted and so matches no later one; repeated rows match the
smallest accepted one; empty tables give no rows.
"""

from __future__ import annotations

import re
import unicodedata
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache, reduce
from itertools import combinations, permutations

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from feedloom.llm.common import cut, plain, strip
from feedloom.llm.survivor import bare_doi, key_of
from feedloom.llm.truncation import is_missing
from feedloom.operators.components import components

#: The largest letter distance of two titles of one article, and the misspelt words it may hold.
RADIUS, MISSPELT = 6, 3
#: Of so many of its longest words two titles of one article share two: each may lack ``MISSPELT`` of the other's.
LONGEST = MISSPELT + 2
#: Partitions of the stored keys and identifiers, by hash; cells and partitions of a batch that are named to the scan.
BUCKETS, NAMED = 256, 1000
#: Rows (item and key) of one group of linked items that one task settles; larger groups are settled round by round.
GROUP_ROWS = 200_000
#: Shorter titles are compared for equality only: an edit makes another title of them.
LEAST_WORDS = 6
# What stands where a title is missing, as sorted words.
UNTITLED = {" ".join(sorted(t.split())) for t in ("untitled", "title", "no title", "untitled document", "title not available", "title unavailable", "missing title", "no title available")}
# Fixed value: letters from the most to the least frequent in English.
LETTERS = "etaoinshrdlcumwfgypbvkjxqz"
#: The letter groups of the pivots beside the empty text: about half of a text's letters each, and half of every other
#: group's, so that no distance tells another one. A group holds the letters whose rank has an even number of bits in a mask.
PIVOT_LETTERS = tuple("".join(c for i, c in enumerate(LETTERS) if (i & mask).bit_count() % 2 == 0) for mask in (1, 2, 4, 3))
#: The columns of pivot distances: to the empty text, and to a long run of each letter group (but for a constant).
PIVOTS = [f"d{i}" for i in range(len(PIVOT_LETTERS) + 1)]
# Notices that stand before or after a title.
NOTICES = ("update", "updated", "breaking", "breaking news", "new", "exclusive", "in press", "corrected", "correction", "corrected proof", "online first", "abstract only", "article in press", "articles in press", "ahead of print", "early view", "full text", "free access", "open access", "news", "alert", "reposted", "press release", "accepted manuscript", "preprint", "just published", "in brief", "video", "podcast", "watch", "read")
# URL parameters that track a reader.
TRACKING = r"^(?:utm_[^=]*|mc_[^=]*|cmp|cmpid|ref|ref_src|referrer|source|src|fbclid|gclid|dclid|msclkid|igshid|spm|feed|rss|campaign|trk)(?:=|$)"

_NUMBER = re.compile(r"(?<=\d)[,  ](?=\d{3}(?!\d))")
_WORD = re.compile(r"[^\W_]+")
_NOTICE = "(?:" + "|".join(sorted(NOTICES, key=len, reverse=True)) + ")"
_BRACKETED = re.compile(r"[\[(]\s*" + _NOTICE + r"\s*[\])]", re.I)
_BEFORE = re.compile(r"^\W*" + _NOTICE + r"\s*(?:[:\]\)]|\s[-–—|]\s)\s*", re.I)
_ALONE = re.compile(_NOTICE + r"\W*$", re.I)
_PART = re.compile(r"\s+[-–—|]\s+")
_PARTS = re.compile(r":\s+|\s+[-–—|:]\s*")


def _fold(text: str) -> str:
    if text.isascii():
        return text
    return "".join(c for c in unicodedata.normalize("NFKD", text.replace("ß", "ss")) if not unicodedata.combining(c))


def name_of(text: str) -> str:
    return " ".join(_WORD.findall(_fold(plain(text.replace("&", " and ")))))


def title_words(title: str | None, names: set[str] = frozenset()) -> list[str]:
    """The words of a title in sorted order, without mark-up, notices before, after or between its parts, and the name of
    the place that carries it."""
    t = re.sub(r"\s+", " ", plain(title or "")).strip()
    if "[" in t or "(" in t:
        t = _BRACKETED.sub(" ", t).strip()
    for _ in range(3):
        before = t
        t = _BEFORE.sub("", t).strip()
        parts = _PART.split(t)
        if len(parts) > 1 and name_of(parts[-1]) in names:
            t = t[: t.rfind(parts[-1])].rstrip(" -–—|")
        if t == before:
            break
    parts = _PARTS.split(t)
    if len(parts) > 1:
        t = " ".join([x for x in parts if not _ALONE.match(x.strip())] or parts)
    return sorted(_WORD.findall(_fold(_NUMBER.sub("", t.replace("&", " and ")))))


def _near(a: str, b: str) -> bool:
    """One edit or exchange of neighbours apart; words of eight letters and more may have two edits, too."""
    if a == b:
        return True
    most = 2 if min(len(a), len(b)) >= 8 else 1
    if abs(len(a) - len(b)) > most or min(len(a), len(b)) < 3:
        return False
    two, one = None, list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row = [i]
        for j, y in enumerate(b, 1):
            v = min(one[j] + 1, row[j - 1] + 1, one[j - 1] + (x != y))
            if i > 1 and j > 1 and x == b[j - 2] and a[i - 2] == y:
                v = min(v, two[j - 2] + 1)
            row.append(v)
        two, one = one, row
    return one[-1] <= (1 if most == 1 else 2) and (one[-1] <= 1 or a[:1] == b[:1])


def same_title(a: list[str], b: list[str]) -> bool:
    """Whether two word lists differ by misspelt words only: no number, name or word is exchanged, added or missing."""
    x, y = Counter(a), Counter(b)
    left, right = list((x - y).elements()), list((y - x).elements())
    if len(left) != len(right):  # a word may have been split or joined
        return abs(len(left) - len(right)) == 1 and "".join(sorted("".join(left))) == "".join(sorted("".join(right))) and len(left) + len(right) <= 3
    if len(left) > MISSPELT or any(c.isdigit() for w in left + right for c in w):
        return False
    return any(all(map(_near, left, order)) for order in permutations(right))


@lru_cache(maxsize=1 << 14)
def _parity(letter: str, times: int) -> tuple[int, int]:
    """The bits that so many of a letter flip in a sketch."""
    s = [0, 0]
    for i in range(times):
        h = hash_of(ord(letter) * 1009 + i)
        s[h & 1] ^= 1 << (h >> 1 & 63)
    return s[0], s[1]


def _signatures(words: list[str], numbers: str) -> list[int]:
    """Hashes of all pairs of the longest words, each with the numbers; the order of words depends on nothing else."""
    import xxhash

    seen: Counter = Counter()
    longest = sorted(words, key=lambda w: (-len(w), w))[:LONGEST]
    for k, w in enumerate(longest):
        seen[w] += 1
        longest[k] = f"{w} {seen[w]}"
    return [x - (1 << 64) if x >> 63 else x for x in (xxhash.xxh3_64_intdigest(f"{a}|{b}|{numbers}") for a, b in combinations(longest, 2))]


def url_key(url: Column) -> Column:
    """A URL without scheme, ``www.``/``m.``, case, fragment, tracking parameters and closing slashes; null if blank."""
    u = F.regexp_replace(F.lower(strip(F.coalesce(url, F.lit("")))), r"#.*$", "")
    u = F.regexp_replace(F.regexp_replace(u, r"^[a-z][a-z0-9+.\-]*://", ""), r"^(?:www|m|mobile|amp)\.", "")
    base, query = F.regexp_replace(F.substring_index(u, "?", 1), r"(?:/index\.html?|/amp)?/*$", ""), F.when(F.instr(u, "?") > 0, F.regexp_replace(u, r"^[^?]*\?", ""))
    kept = F.array_sort(F.filter(F.split(F.coalesce(query, F.lit("")), "&"), lambda p: (p != "") & ~p.rlike(TRACKING)))
    return F.nullif(F.concat_ws("?", F.nullif(base, F.lit("")), F.nullif(F.array_join(kept, "&"), F.lit(""))), F.lit(""))


def _digits(pmid: Column) -> Column:
    return F.nullif(F.regexp_replace(F.regexp_extract(F.coalesce(pmid, F.lit("")), r"(\d{4,})", 1), "^0+", ""), F.lit(""))


def rows_of(df: DataFrame, table: str, row_id: str, key: str | None, doi: str, pmid: str, fingerprint: str, url: str, title: str) -> DataFrame:
    """The columns that identify an article, under common names."""
    named = lambda kind, c: F.concat(F.lit(kind + ":"), c)
    mark = key_of(F.col(fingerprint))
    keys = F.array_compact(F.array(named("k", key_of(F.col(key))) if key else F.lit(None).cast("string"), named("d", F.nullif(bare_doi(F.col(doi)), F.lit(""))), named("p", _digits(F.col(pmid))), named("f", F.when(F.length(mark) >= 8, mark)), named("u", url_key(F.col(url)))))
    return df.select(F.lit(table).alias("tbl"), F.col(row_id).cast("bigint").alias("id"), F.col(title).cast("string").alias("title"), keys.alias("keys"))


def identified(rows: DataFrame, names: set[str]) -> DataFrame:
    """``rows`` of :func:`rows_of` with what their titles give: ``name`` (the sorted words; null for none), ``numbers``, pivot
    distances ``d0, d1, …``, the sketch ``s0, s1`` and, for long titles, the ``pairs`` of their longest words."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = [pa.string(), pa.string(), *[pa.int32()] * len(PIVOTS), pa.int64(), pa.int64(), pa.list_(pa.int64())]
        for b in batches:
            out = []
            for t in b.column(2).to_pylist():
                w = title_words(t, names)
                if not w or len(w) < LEAST_WORDS and (is_missing(t) or " ".join(w) in UNTITLED or name_of(t) in names):
                    out.append((None,) * len(kinds))
                    continue
                numbers = " ".join(x for x in w if any(c.isdigit() for c in x))
                n, s0, s1 = Counter("".join(w)), 0, 0
                for c in [c for c in n if c.isdigit()]:
                    del n[c]
                for c, times in n.items():
                    x, y = _parity(c, times)
                    s0, s1 = s0 ^ x, s1 ^ y
                size = sum(n.values())
                far = [size - 2 * sum(n[c] for c in group) for group in PIVOT_LETTERS]
                out.append((" ".join(w), numbers, size, *far, *(x - (1 << 64) if x >> 63 else x for x in (s0, s1)), _signatures(w, numbers) if len(w) >= LEAST_WORDS else []))
            if out:
                yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), b.column(3), *[pa.array(c, t) for c, t in zip(zip(*out), kinds)]], ["tbl", "id", "keys", "name", "numbers", *PIVOTS, "s0", "s1", "pairs"])

    return rows.select("tbl", "id", "title", "keys").mapInArrow(each, f"tbl string, id bigint, keys array<string>, name string, numbers string, {', '.join(p + ' int' for p in PIVOTS)}, s0 bigint, s1 bigint, pairs array<bigint>")


def hash_of(x: int) -> int:
    x = (x * 0x9E3779B97F4A7C15) & ((1 << 64) - 1)
    x = ((x ^ (x >> 30)) * 0xBF58476D1CE4E5B9) & ((1 << 64) - 1)
    return x ^ (x >> 31)


_WIDTH = 2 * RADIUS + 1


def _cell(d: Column) -> Column:
    return F.floor(d / _WIDTH).cast("bigint")


def _reach(d: str) -> Column:
    return F.sequence(_cell(F.col(d) - RADIUS), _cell(F.col(d) + RADIUS))


def _place(one: Column, two: Column) -> Column:
    """The number of a stored cell: of the first two pivots' cells."""
    return F.shiftleft(one, 20) + two


def _bucket(c: str) -> Column:
    return F.pmod(F.xxhash64(c), F.lit(BUCKETS)).cast("int")


class Accepted:
    """What has been accepted, as three tables.

    ``keys (bucket, tbl, id, key)``: what identifies each row, its title included.  ``pivots (cell, name, …)``: the
    pivot-distance table of the different long titles.  ``marks (bucket, name, key, n)``: the identifiers that the rows of a
    title carry.
    """

    TABLES = ("keys", "pivots", "marks")

    def __init__(self, keys: DataFrame, pivots: DataFrame, marks: DataFrame):
        self.keys, self.pivots, self.marks = keys, pivots, marks

    @classmethod
    def of(cls, rows: DataFrame, names: set[str]) -> "Accepted":
        """The tables of rows of :func:`rows_of`; each row is read once."""
        return cls.made(cut(identified(rows, names)))

    @classmethod
    def made(cls, found: DataFrame) -> "Accepted":
        title = F.when(F.col("name").isNotNull(), F.concat(F.lit("t:"), "name"))
        keys = found.select("tbl", "id", F.explode(F.array_compact(F.array_append("keys", title))).alias("key")).withColumn("bucket", _bucket("key"))
        pivots = found.filter(F.size("pairs") > 0).groupBy("name").agg(*[F.first(c).alias(c) for c in ("numbers", *PIVOTS, "s0", "s1", "pairs")]).withColumn("cell", _place(_cell(F.col("d0")), _cell(F.col("d1"))))
        marks = found.filter("name is not null").select("name", F.explode("keys").alias("key")).filter(F.substring("key", 1, 2).isin("d:", "p:"))
        marks = marks.groupBy("name", "key").agg(F.count("*").alias("n")).withColumn("bucket", _bucket("name"))
        return cls(keys, pivots, marks)

    def _partition(self, name: str) -> str:
        return "cell" if name == "pivots" else "bucket"

    def write(self, path: str, mode: str = "errorifexists") -> None:
        """Store the tables in a shared folder; ``mode='append'`` adds files with these rows and reads nothing."""
        for name in self.TABLES:
            by = self._partition(name)
            getattr(self, name).repartition(by).write.mode(mode).partitionBy(by).parquet(f"{path}/{name}")

    @classmethod
    def read(cls, spark: SparkSession, path: str) -> "Accepted":
        return cls(*[spark.read.parquet(f"{path}/{name}") for name in cls.TABLES])

    def union(self, other: "Accepted") -> "Accepted":
        return Accepted(*[getattr(self, t).unionByName(getattr(other, t)) for t in self.TABLES])

    def only(self, table: str, parts: DataFrame) -> DataFrame:
        """The rows of the partitions that ``parts`` names.  Few partitions (``NAMED`` at most) are named to the scan, which
        reads no others; more are left to the join that follows."""
        found = parts.distinct().limit(NAMED + 1).collect()
        df = getattr(self, table)
        return df if len(found) > NAMED else df.filter(F.col(self._partition(table)).isin([r[0] for r in found]))

    def in_reach(self, pivots: DataFrame) -> DataFrame:
        """The pivot-distance table in the cells that the titles of a batch can meet."""
        cells = pivots.select(_reach("d0").alias("one"), _reach("d1").alias("two")).distinct()
        cells = cells.withColumn("one", F.explode("one")).withColumn("two", F.explode("two"))
        return self.only("pivots", cells.select(_place(F.col("one"), F.col("two")).alias("cell")))


def near_titles(new: DataFrame, known: DataFrame) -> DataFrame:
    """``(name, other)``: different titles of ``new`` and ``known`` (pivot-distance tables) that name one article."""
    # titles meet by a hash of their words, and their words are looked up for what is left
    cols = [F.xxhash64("name").alias("n"), *PIVOTS, "s0", "s1", F.explode("pairs").alias("pair")]
    x = new.select(*cols).withColumn("cell", F.explode(_reach("d0"))).alias("x")
    y = known.select(*cols).withColumn("cell", _cell(F.col("d0"))).alias("y")
    on = (F.col("x.pair") == F.col("y.pair")) & (F.col("x.cell") == F.col("y.cell")) & (F.col("x.n") != F.col("y.n"))
    for d in PIVOTS:
        on = on & (F.abs(F.col(f"x.{d}") - F.col(f"y.{d}")) <= RADIUS)
    least = F.bit_count(F.col("x.s0").bitwiseXOR(F.col("y.s0"))) + F.bit_count(F.col("x.s1").bitwiseXOR(F.col("y.s1")))
    pairs = x.join(y, on & (least <= RADIUS)).select(F.col("x.n").alias("a"), F.col("y.n").alias("b")).distinct()
    named = lambda df, n, name: df.select(F.xxhash64("name").alias(n), F.col("name").alias(name)).distinct()
    pairs = pairs.join(named(new, "a", "name"), "a").join(named(known, "b", "other"), "b").select("name", "other")

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            good = [k for k, (p, q) in enumerate(zip(b.column(0).to_pylist(), b.column(1).to_pylist())) if same_title(p.split(" "), q.split(" "))]
            yield b.take(pa.array(good, pa.int32()))

    return pairs.mapInArrow(verify, "name string, other string")


def columns_of(marks: DataFrame) -> DataFrame:
    """``name`` of the titles of recurring columns: their rows carry different identifiers.

    Copies of an article agree in DOI or PMID however many they are, the issues of a column do not: no DOI, or no PMID,
    holds half of the rows of its title that have one.  A short title is a column already if none holds more than half.
    """
    each = marks.groupBy("name", "key").agg(F.sum("n").alias("n")).groupBy("name", F.substring("key", 1, 2).alias("kind"))
    each = each.agg(F.sum("n").alias("n"), F.max("n").alias("top"))
    half = F.when(F.size(F.split("name", " ")) < LEAST_WORDS, 2 * F.col("top") <= F.col("n")).otherwise(2 * F.col("top") < F.col("n"))
    return each.filter(half).select("name").distinct()


def _settled(open_: DataFrame) -> DataFrame:
    """``(id)`` of the items that repeat an earlier accepted one, of ``(id, key)`` of items that share keys with each other.

    Items are accepted in the order of their ids, and one that shares a key with an accepted one is not.  A round settles
    the items that come first in all their keys, and those behind them; what is left falls into groups of linked items,
    which are settled at once, each in one task, so that a long chain takes no round for each link.  A group of more than
    ``GROUP_ROWS`` rows goes on round by round.
    """

    def in_order(rows: pd.DataFrame) -> pd.DataFrame:
        taken: set[str] = set()
        again = []
        for i, keys in rows.groupby("id", sort=True)["key"]:
            if taken.isdisjoint(keys):
                taken.update(keys)
            else:
                again.append(i)
        return pd.DataFrame({"id": pd.Series(again, dtype="int64")})

    out, rounds = [], 0
    while not open_.isEmpty():
        rounds += 1
        if rounds % 3 == 0:
            first = open_.groupBy("key").agg(F.min("id").alias("a"))
            roots = components(open_.join(first, "key").select("a", F.col("id").alias("b"))).select(F.col("node").alias("id"), "root")
            grouped = open_.join(roots, "id", "left").withColumn("root", F.coalesce("root", "id"))
            fits = cut(grouped.groupBy("root").agg(F.count("*").alias("n")).filter(F.col("n") <= GROUP_ROWS).select("root"))
            out.append(cut(grouped.join(fits, "root", "left_semi").groupBy("root").applyInPandas(in_order, "id bigint")))
            open_ = cut(grouped.join(fits, "root", "left_anti").select("id", "key"))
            continue
        first = open_.groupBy("key").agg(F.min("id").alias("first"))
        state = open_.join(first, "key").groupBy("id").agg(F.min(F.col("first") == F.col("id")).alias("ok"))
        taken = open_.join(state.filter("ok").select("id"), "id", "left_semi")
        behind = cut(open_.join(taken.select("key").distinct(), "key", "left_semi").select("id").distinct().join(state.filter("not ok"), "id", "left_semi").select("id"))
        out.append(behind)
        open_ = cut(open_.join(state.filter("ok").select("id").union(behind), "id", "left_anti"))
    return reduce(DataFrame.union, out) if out else open_.select("id")


def repeats_of(known: Accepted, batch: Accepted) -> tuple[DataFrame, DataFrame]:
    """``(item_id, match_table, match_id)`` of every item of ``batch`` and each accepted row that it repeats, and ``(id)`` of the
    items that repeat something.  Items are accepted in the order of their ids."""
    pivots = cut(batch.pivots)
    links = cut(near_titles(pivots, known.in_reach(pivots).unionByName(pivots)))
    others = known.only("keys", batch.keys.select("bucket").union(links.select(F.concat(F.lit("t:"), "other").alias("key")).select(_bucket("key"))))
    titles = batch.keys.filter("key like 't:%'").select(F.substring("key", 3, 1 << 30).alias("name")).union(links.select("other")).distinct().withColumn("bucket", _bucket("name"))
    marks = known.only("marks", titles.select("bucket")).unionByName(batch.marks)
    columns = cut(columns_of(marks.join(titles.select("name"), "name", "left_semi")))
    # two titles that differ by small edits become one more key of the rows of both
    good = links.join(columns, "name", "left_anti").join(columns.select(F.col("name").alias("other")), "other", "left_anti")
    one = F.concat(F.lit("l:"), F.sha2(F.concat_ws("|", F.least("name", "other"), F.greatest("name", "other")), 256))
    linked = cut(good.select(F.explode(F.array(F.struct(F.concat(F.lit("t:"), "name").alias("title"), one.alias("more")), F.struct(F.concat(F.lit("t:"), "other").alias("title"), one.alias("more")))).alias("e")).select("e.*").distinct())
    barred = columns.select(F.concat(F.lit("t:"), "name").alias("key"))

    def keyed(keys: DataFrame) -> DataFrame:
        keys = keys.select("tbl", "id", "key").join(barred, "key", "left_anti")
        return keys.unionByName(keys.join(linked, F.col("key") == F.col("title")).select("tbl", "id", F.col("more").alias("key")))

    ours = cut(keyed(batch.keys).select("id", "key").distinct())
    found = cut(ours.join(keyed(others).withColumnRenamed("id", "match_id"), "key").select(F.col("id").alias("item_id"), F.col("tbl").alias("match_table"), "match_id").distinct())
    free = ours.join(found.select(F.col("item_id").alias("id")).distinct(), "id", "left_anti")
    shared = free.groupBy("key").agg(F.count("*").alias("n")).filter("n > 1").select("key")
    again = cut(_settled(cut(free.join(shared, "key", "left_semi"))))
    accepted = free.join(again, "id", "left_anti")
    within = ours.alias("x").join(accepted.alias("y"), (F.col("x.key") == F.col("y.key")) & (F.col("x.id") > F.col("y.id")))
    within = within.select(F.col("x.id").alias("item_id"), F.lit("incoming_item").alias("match_table"), F.col("y.id").alias("match_id")).distinct()
    return found.unionByName(within), found.select(F.col("item_id").alias("id")).union(again).distinct()


def repeats(old: DataFrame, new: DataFrame, names: set[str]) -> DataFrame:
    """``(item_id, match_table, match_id)`` for rows of :func:`rows_of`: all batches at once, in the order of arrival."""
    found = cut(identified(old.unionByName(new), names))
    return repeats_of(Accepted.made(found.filter("tbl != 'incoming_item'")), Accepted.made(found.filter("tbl = 'incoming_item'")))[0]


def accept(path: str, new: DataFrame, names: set[str]) -> DataFrame:
    """Check one batch against what is stored at ``path`` and append the items that repeat nothing.  Reads the partitions
    that the batch touches, writes its accepted rows only; returns the rows of :func:`repeats_of`."""
    found = cut(identified(new, names))
    links, again = repeats_of(Accepted.read(new.sparkSession, path), Accepted.made(found))
    links = cut(links)
    Accepted.made(found.join(again, "id", "left_anti")).write(path, "append")
    return links
