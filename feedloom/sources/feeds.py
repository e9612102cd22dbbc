"""Feeds as a Spark data source: conditional requests, bounded retries, errors as rows.

Each feed is a partition of its own; option ``workers`` bounds how many are read at once, ``delay`` is the pause in seconds
between the feeds of one worker.

``spark.dataSource.register(FeedSource)`` and then ``spark.read.format("feedloom_feed").option("feeds", json).load()``.
A feed's ``url`` may be ``http(s)://`` or a file path, so that saved feeds are read in the same way.
"""

from __future__ import annotations

import json
import time
import urllib.error
import urllib.request
import xml.etree.ElementTree as ET
from collections.abc import Callable, Iterator

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from feedloom.functions.lists import first_filled

SCHEMA = (
    "feed_url string, feed_name string, feed_tags array<string>, status string, http_status int, error string, etag string, last_modified string, entry bigint, "
    "title string, link string, id string, published string, updated string, summary string, contents array<string>, authors array<string>, tags array<string>, doi_text array<string>"
)
ENTRY_FIELDS = 11


def wait_s(attempt: int, multiplier: float = 2.0, low: float = 2.0, high: float = 60.0) -> float:
    """Seconds before the attempt after ``attempt``: doubling, within bounds."""
    return min(high, max(low, multiplier * 2 ** (attempt - 1)))


def fetch(url: str, etag: str | None, modified: str | None, timeout: float, attempts: int, sleep: Callable[[float], None] = time.sleep, opener=urllib.request.urlopen) -> tuple[int, bytes, dict]:
    """(status, body, headers); server errors and broken connections are tried again, client errors are not."""
    if "://" not in url:
        with open(url, "rb") as f:
            return 200, f.read(), {}
    headers = {k: v for k, v in (("If-None-Match", etag), ("If-Modified-Since", modified)) if v}
    for attempt in range(1, attempts + 1):
        try:
            with opener(urllib.request.Request(url, headers=headers), timeout=timeout) as r:
                return r.status, r.read(), dict(r.headers)
        except urllib.error.HTTPError as e:
            if e.code < 500 or attempt == attempts:
                return e.code, b"", {}
        except OSError:
            if attempt == attempts:
                raise
        sleep(wait_s(attempt))
    return 0, b"", {}


def _name(tag: str) -> str:
    return tag.rpartition("}")[2].lower()


def entries(body: bytes) -> tuple[list[dict], bool]:
    """The entries of RSS or Atom, and whether the document was whole; of a broken one those before the break."""
    out, events, whole = [], [], True
    parser = ET.XMLPullParser(["end"])
    for step in (lambda: parser.feed(body), parser.close):
        try:
            step()
            for event in parser.read_events():
                events.append(event)
        except ET.ParseError:
            whole = False
            break
    for _, node in events:
        if _name(node.tag) not in ("item", "entry"):
            continue
        e: dict = {"contents": [], "authors": [], "tags": [], "doi_text": []}
        for x in node:
            n, text = _name(x.tag), "".join(x.itertext()).strip()
            if n == "link":
                href = x.get("href") or text
                if href and (x.get("rel", "alternate") == "alternate" or "link" not in e):
                    e["link"] = href
            elif n in ("title", "id", "updated"):
                e[n] = text
            elif n == "guid":
                e["id"] = text
            elif n in ("published", "pubdate", "date", "publicationdate"):
                e.setdefault("published", text)
            elif n == "modified":
                e.setdefault("updated", text)
            elif n in ("summary", "description"):
                e.setdefault("summary", text)
            elif n in ("content", "encoded"):
                e["contents"].append(text)
            elif n in ("author", "creator"):
                name = next((y.text for y in x if _name(y.tag) == "name"), None) or text
                if name:
                    e["authors"].append(name.strip())
            elif n in ("category", "subject"):
                e["tags"].append(x.get("term") or text)
            elif n in ("identifier", "doi", "source"):
                e["doi_text"].append(text)
        out.append(e)
    return out, whole


class _Feeds(InputPartition):
    def __init__(self, feeds: list[dict]):
        self.feeds = feeds


class _Reader(DataSourceReader):
    def __init__(self, options: dict):
        self.feeds = json.loads(options.get("feeds", "[]"))
        self.force = str(options.get("force", "false")).lower() == "true"
        self.timeout, self.attempts = float(options.get("timeout", 30)), int(options.get("attempts", 3))

        self.workers, self.delay = int(options.get("workers", 0)), float(options.get("delay", 0))

    def partitions(self) -> list[InputPartition]:
        feeds = [f for f in self.feeds if f.get("enabled", True)]
        n = min(self.workers or len(feeds), len(feeds))
        return [_Feeds(feeds[k::n]) for k in range(n)]

    def read(self, partition: InputPartition) -> Iterator[tuple]:
        for k, feed in enumerate(partition.feeds):
            if k and self.delay:
                time.sleep(self.delay)
            yield from self._one(feed)

    def _one(self, f: dict) -> Iterator[tuple]:
        head = (f["url"], f.get("name"), f.get("tags") or [])
        try:
            status, body, headers = fetch(f["url"], None if self.force else f.get("etag"), None if self.force else f.get("last_modified"), self.timeout, self.attempts)
        except OSError as e:
            yield (*head, "failed", None, str(e)[:500], None, None, *[None] * ENTRY_FIELDS)
            return
        kept = (headers.get("ETag"), headers.get("Last-Modified"))
        if status == 304 or status >= 400:
            yield (*head, "not_modified" if status == 304 else "failed", status, None if status == 304 else f"HTTP {status}", *kept, *[None] * ENTRY_FIELDS)
            return
        found, whole = entries(body)
        state = "ok" if whole else "partial"
        if not found:
            yield (*head, state, status, None, *kept, *[None] * ENTRY_FIELDS)
        for k, e in enumerate(found):
            yield (*head, state, status, None, *kept, k, e.get("title"), e.get("link"), e.get("id"), e.get("published"), e.get("updated"), e.get("summary"), e["contents"], e["authors"], e["tags"], e["doi_text"])


class FeedSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "feedloom_feed"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> DataSourceReader:
        return _Reader(self.options)


def diagnostics(rows: DataFrame) -> DataFrame:
    """One row a feed: its status and the entries it gave."""
    return rows.groupBy("feed_url").agg(F.max("status").alias("status"), F.max("http_status").alias("http_status"), F.max("error").alias("error"), F.count("entry").alias("entries"))


def merged_cache(old: DataFrame, rows: DataFrame) -> DataFrame:
    """The state of conditional requests, new values over old ones."""
    new = rows.groupBy("feed_url").agg(F.max("etag").alias("_e"), F.max("last_modified").alias("_m"))
    return old.join(new, "feed_url", "full_outer").select("feed_url", F.coalesce("_e", "etag").alias("etag"), F.coalesce("_m", "last_modified").alias("last_modified"))


def canonical_url(link: Column, found_doi: Column) -> Column:
    """The link of an entry, else the resolver's link of its DOI, else ``''``."""
    return F.coalesce(F.nullif(F.trim(link), F.lit("")), F.concat(F.lit("https://doi.org/"), found_doi), F.lit(""))


def with_defaults(rows: DataFrame, as_of: Column) -> DataFrame:
    """Entries as the older format has them: a title that stands for none, the first date that is there, else ``as_of`` as text,
    and the first text of contents and summary."""
    filled = lambda c: F.nullif(F.trim(F.coalesce(c, F.lit(""))), F.lit(""))
    body = first_filled(F.concat(F.coalesce("contents", F.array().cast("array<string>")), F.array("summary")))
    return rows.filter("entry is not null").select("feed_url", "entry", F.coalesce(filled("title"), F.lit("No title available")).alias("title"), "link", F.coalesce(filled("published"), filled("updated"), as_of.cast("string")).alias("date"), F.coalesce(body, F.lit("")).alias("content"))
