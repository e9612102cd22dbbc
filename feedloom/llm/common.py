"""What several operators of this package share."""

from __future__ import annotations

import html
import re
import unicodedata
import uuid
from functools import lru_cache

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedloom.session import checkpoint_dir, cut, load

__all__ = ["cut", "host_of", "load", "plain", "small", "spread", "stored", "strip", "word_hash", "words"]

#: The most rows of a dimension table that are broadcast; a larger one is joined by shuffle.
MAX_DIMENSION = 10_000


def small(df: DataFrame, limit: int = MAX_DIMENSION) -> DataFrame:
    """A broadcast hint, given only once the table is known to hold at most ``limit`` rows."""
    return F.broadcast(df) if df.limit(limit + 1).count() <= limit else df


def spread(df: DataFrame, key: str) -> DataFrame:
    """Over all cores, by a unique key, if the files give fewer partitions than there are cores: for work that costs far
    more a row than moving it."""
    n = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(n, key) if df.rdd.getNumPartitions() < n else df


def stored(df: DataFrame) -> DataFrame:
    """``df`` written to a table in the shared folder and read from it: like a checkpoint, but compressed and by columns."""
    path = f"{checkpoint_dir(df.sparkSession)}/table-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def strip(c: Column) -> Column:
    """Without outer white space of any kind."""
    return F.regexp_replace(c, r"(?U)^\s+|\s+$", "")


def host_of(url: Column) -> Column:
    """The lower-case host of a URL, ``''`` where there is none."""
    return F.regexp_extract(F.lower(strip(F.coalesce(url, F.lit("")))), r"^(?:[a-z][a-z0-9+.\-]*:)?//(?:[^/?#@]*@)?([^/:?#]+)", 1)


_TAG = re.compile(r"</?[A-Za-z!][^<>]*>")
_INVISIBLE = re.compile("[­​-‏‪-‮⁠-⁤﻿︀-️]")
_WORD = re.compile(r"[^\W_]+")


def plain(text: str) -> str:
    """Lower case without mark-up, entities, invisible and compatibility characters."""
    if "&" in text:
        text = html.unescape(text)
    if "<" in text:
        text = _TAG.sub(" ", text)
    if not text.isascii():
        text = unicodedata.normalize("NFKC", _INVISIBLE.sub("", text))
    return text.lower()


def words(text: str) -> list[str]:
    return _WORD.findall(plain(text))


@lru_cache(maxsize=1 << 17)
def word_hash(word: str) -> int:
    """A signed 64-bit hash; the cache is bounded."""
    import xxhash

    h = xxhash.xxh3_64_intdigest(word)
    return h - (1 << 64) if h >> 63 else h
