"""Queries over duplicates and the state across runs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedloom.functions import dates, ids
from feedloom.functions.text import comparable_title
from feedloom.operators import history, resolve
from feedloom.plans.ingest import AS_OF, as_of, doi_sql, items, url_sql
from feedloom.operators.timestamps import to_utc_us
from feedloom.session import cut, load


def _keys(df: DataFrame) -> list:
    full = lambda c: F.lower(F.trim(F.coalesce(c, F.lit(""))))
    return [F.lower(F.coalesce(ids.doi(F.col("doi")), F.lit(""))), full("pmid"), ids.url(F.col("canonical_url"))]


def exact_clusters(spark: SparkSession, sf: str) -> DataFrame:
    df = items(spark, sf).select("seq", "doi", "pmid", "canonical_url")
    edges = resolve.key_edges(df, "seq", _keys(df))
    return resolve.clusters(df.select("seq"), "seq", edges).groupBy("cluster_id").agg(F.count("*").alias("n")).filter("n > 1")


def richest_records(spark: SparkSession, sf: str) -> DataFrame:
    df = items(spark, sf)
    df = df.select("seq", F.lower(F.trim("dedupe_key")).alias("key"), resolve.richness(F.col("doi"), F.col("pmid"), F.col("authors"), F.col("summary"), F.col("published_at"), F.col("tags")).alias("richness"))
    return resolve.best_of(df, "key", "richness", "seq").select("key", "seq", "richness", "cluster_size")


def _dated(spark: SparkSession, sf: str) -> DataFrame:
    """Items with the instant of their publication, in whatever notation; null where there is none."""
    feeds = load(spark, sf, "feed_config").select(F.col("url").alias("feed_url"), "tz_name", "date_order")
    df = items(spark, sf).join(feeds, "feed_url", "left")
    return to_utc_us(df, "published_at", "tz_name", "date_order", "us").withColumn("at", F.timestamp_micros("us"))


def fuzzy_title_pairs(spark: SparkSession, sf: str) -> DataFrame:
    """Similar titles, by the first record of each; no SQL engine here has the similarity, so tests use brute force."""
    df = cut(_dated(spark, sf).select("seq", "title", "at"))
    return resolve.fuzzy_titles(df, "seq", "title", "at").select("a", "b", "similarity")


def article_clusters(spark: SparkSession, sf: str) -> DataFrame:
    """Clusters over identifiers, URLs and similar titles near in time together, and the richest record of each."""
    df = _dated(spark, sf).select("seq", "doi", "pmid", "canonical_url", "title", "at", resolve.richness(F.col("doi"), F.col("pmid"), F.col("authors"), F.col("summary"), F.col("published_at"), F.col("tags")).alias("richness"))
    keys = [f"key{k}" for k in range(3)]
    df = cut(df.select("seq", comparable_title(F.col("title")).alias("title"), "at", "richness", *[k.alias(c) for c, k in zip(keys, _keys(df))]))
    links = cut(resolve.fuzzy_titles(df, "seq", "title", "at", ready=True).select("x", "y"))
    edges = resolve.key_edges(df, "seq", [F.col(c) for c in keys]).union(resolve.title_edges(df, "seq", "title", "at", links, ready=True))
    best = resolve.best_of(resolve.clusters(df.select("seq", "richness"), "seq", edges), "cluster_id", "richness", "seq")
    return best.filter("cluster_size > 1").select("cluster_id", "seq", "richness", "cluster_size")


def ordered_duplicates(spark: SparkSession, sf: str) -> DataFrame:
    df = items(spark, sf).select("seq", "canonical_url", "title")
    return resolve.duplicates_in_order(df, "seq", [ids.url(F.col("canonical_url")), comparable_title(F.col("title"))])


def _matched(spark: SparkSession, sf: str) -> DataFrame:
    new, old = load(spark, sf, "incoming_item"), load(spark, sf, "history")
    low = lambda c: F.lower(F.trim(c))
    keys = lambda: [low(F.col("doi")), F.trim("pmid"), ids.url(F.col("canonical_url")), low(F.col("dedupe_key")), F.trim("content_fingerprint")]
    return history.lookup(new, "item_id", keys(), old, "id", keys())


def history_matches(spark: SparkSession, sf: str) -> DataFrame:
    return _matched(spark, sf).filter("match_id is not null").select("item_id", "match_id", "match_priority")


def history_novelty(spark: SparkSession, sf: str) -> DataFrame:
    old = load(spark, sf, "history").select(F.col("id").alias("match_id"), "times_emitted", "last_emitted_at", F.col("content_fingerprint").alias("old_print"))
    df = _matched(spark, sf).join(old, "match_id", "left")
    at = F.when(F.col("last_emitted_at").rlike(r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}\+00:00$"), F.to_timestamp(F.substring("last_emitted_at", 1, 19), "yyyy-MM-dd'T'HH:mm:ss"))
    state = history.novelty(F.col("times_emitted"), at, as_of(), 365, F.col("content_fingerprint") != F.col("old_print"))
    return df.groupBy(state.alias("novelty")).agg(F.count("*").alias("n"))


def history_next(spark: SparkSession, sf: str) -> DataFrame:
    """The snapshot after all batches: one row a key, the newest sighting, all sightings counted."""
    new = load(spark, sf, "incoming_item").filter("dedupe_key is not null")
    batch = new.groupBy(F.lower(F.trim("dedupe_key")).alias("dedupe_key")).agg(F.min_by("title", "item_id").alias("title"), F.max(F.date_format("fetched_at", "yyyy-MM-dd'T'HH:mm:ss+00:00")).alias("last_seen_at"), F.count("*").alias("times_seen"))
    old = load(spark, sf, "history").select("dedupe_key", "title", "last_seen_at", "times_seen")
    return history.upsert(old, batch, "dedupe_key", ["title"], {"last_seen_at": F.col("last_seen_at")}, {"times_seen": F.col("times_seen")})


def history_stats(spark: SparkSession, sf: str) -> DataFrame:
    return history.stats(load(spark, sf, "history"))


def emitted_marks(spark: SparkSession, sf: str) -> DataFrame:
    chosen = load(spark, sf, "selection_history").filter("emitted_at is not null").select(F.lower(F.concat(F.lit("doi:"), F.trim("doi"))).alias("dedupe_key"))
    out = history.mark_emitted(load(spark, sf, "history"), chosen, "dedupe_key", F.lit(AS_OF))
    return out.select("id", "times_emitted", "last_emitted_at")


def selection_lookup(spark: SparkSession, sf: str) -> DataFrame:
    """What items were chosen before, and how many whole days ago they were seen first."""
    keys = lambda u, d: [ids.url(F.col(u)), F.lower(F.trim(d))]
    sel = load(spark, sf, "selection_history")
    df = history.lookup(load(spark, sf, "incoming_item").select("item_id", "canonical_url", "doi"), "item_id", keys("canonical_url", "doi"), sel, "id", keys("url", "doi"))
    first = F.to_timestamp(F.substring("first_seen_at", 1, 19), "yyyy-MM-dd'T'HH:mm:ss")
    seen = sel.select(F.col("id").alias("match_id"), dates.whole_days(first, as_of()).alias("days"), F.col("emitted_at").isNotNull().alias("was_emitted"))
    return df.join(seen, "match_id").select("item_id", "match_id", "days", "was_emitted")


def selection_next(spark: SparkSession, sf: str) -> DataFrame:
    """Chosen articles by URL after the incoming ones were seen: first title stays, last sighting moves, emission is kept."""
    sel = load(spark, sf, "selection_history").select(ids.url(F.col("url")).alias("url"), "title", "last_seen_at", "emitted_at").groupBy("url").agg(F.min("title").alias("title"), F.max("last_seen_at").alias("last_seen_at"), F.max("emitted_at").alias("emitted_at"))
    new = load(spark, sf, "incoming_item").select(ids.url(F.col("canonical_url")).alias("url"), "title", F.date_format("fetched_at", "yyyy-MM-dd'T'HH:mm:ss+00:00").alias("last_seen_at"))
    new = new.groupBy("url").agg(F.min("title").alias("title"), F.max("last_seen_at").alias("last_seen_at")).withColumn("emitted_at", F.lit(None).cast("string"))
    return history.upsert(sel, new, "url", ["title"], {"last_seen_at": F.col("last_seen_at"), "emitted_at": F.col("emitted_at")}, {})


def title_urls(spark: SparkSession, sf: str) -> DataFrame:
    """The URL of each incoming title in the history; of several rows with the title the last one, and null without one."""
    known = load(spark, sf, "history").filter("title is not null").groupBy("title").agg(F.max_by("canonical_url", "id").alias("url"))
    return load(spark, sf, "incoming_item").select("item_id", "title").join(known, "title", "left").select("item_id", "title", "url")


def changed_fields(spark: SparkSession, sf: str) -> DataFrame:
    """Fields in which an incoming item contradicts the stored row of its key."""
    old = load(spark, sf, "history").select("dedupe_key", F.col("title").alias("old_title"), F.col("doi").alias("old_doi"), F.col("canonical_url").alias("old_url"), F.col("pmid").alias("old_pmid"))
    df = load(spark, sf, "incoming_item").join(old, "dedupe_key")
    found = history.changes(df, {"title": ("title", "old_title"), "doi": ("doi", "old_doi"), "url": ("canonical_url", "old_url"), "pmid": ("pmid", "old_pmid")})
    return df.select("item_id", F.array_join(found, ",").alias("changed"))


def key_overlap(spark: SparkSession, sf: str) -> DataFrame:
    """Set operations on keys: in both tables, in one only."""
    a = load(spark, sf, "history").select(F.lower(F.trim("dedupe_key")).alias("key")).distinct().withColumn("h", F.lit(1))
    b = load(spark, sf, "incoming_item").select(F.lower(F.trim("dedupe_key")).alias("key")).distinct().withColumn("i", F.lit(1))
    both = a.join(b, "key", "full_outer")
    side = F.when(F.col("h").isNull(), "incoming").when(F.col("i").isNull(), "history").otherwise("both")
    return both.filter("key is not null").groupBy(side.alias("side")).agg(F.count("*").alias("n"))


def last_emission(spark: SparkSession, sf: str) -> DataFrame:
    """Extension, as-of join: for each chosen article the latest earlier emission of its source.

    Days before are one running maximum over (source, day) aggregates, the day itself a window of one source and day, so
    that a source with many rows is split by its days.
    """
    from pyspark.sql.window import Window

    sel = load(spark, sf, "selection_history").filter("source is not null").select("id", "source", "first_seen_at", "emitted_at")
    asks = sel.select("id", "source", F.col("first_seen_at").alias("at"), F.lit(1).alias("asks"), F.lit(None).cast("string").alias("emitted"))
    points = asks.union(sel.filter("emitted_at is not null").select("id", "source", "emitted_at", F.lit(0), "emitted_at")).withColumn("day", F.substring("at", 1, 10))
    daily = points.groupBy("source", "day").agg(F.max("emitted").alias("d"))
    before = daily.withColumn("before", F.max("d").over(Window.partitionBy("source").orderBy("day").rowsBetween(Window.unboundedPreceding, -1))).drop("d")
    today = points.withColumn("today", F.max("emitted").over(Window.partitionBy("source", "day").orderBy("at", "asks").rowsBetween(Window.unboundedPreceding, -1)))
    return today.filter("asks = 1").join(before, ["source", "day"], "left").select("id", F.coalesce("today", "before").alias("previous"))


_DOI = f"lower(coalesce({doi_sql('doi')}, ''))"
_TITLE = "regexp_replace(trim(regexp_replace(lower(coalesce(title, '')), '[\\s\\x{0B}\\x{85}\\p{Z}]+', ' ', 'g')), '^(?:breaking|exclusive|update|correction|retraction):\\s*', '')"
_EDGES = "k as ({keys}), f as (select key, min(seq) as a from k group by key having count(*) > 1), e as (select distinct a, seq as b from k join f using (key) where a < seq)"


def _hkeys(t: str, i: str) -> str:
    keys = ("lower(trim(doi))", "trim(pmid)", url_sql("canonical_url"), "lower(trim(dedupe_key))", "trim(content_fingerprint)")
    return " union all ".join(f"select {i} as id, {p} as p, {k} as k from {t}" for p, k in enumerate(keys))


_MATCH = f"i as ({_hkeys('incoming_item', 'item_id')}), h as ({_hkeys('history', 'id')}), m as (select i.id as item_id, min(struct_pack(p := i.p, m := h.id)) as hit from i join h on i.p = h.p and i.k = h.k and i.k <> '' group by i.id)"

SQL = {
    "exact_clusters": f"""with recursive {_EDGES.format(keys=f"select seq, '0:' || {_DOI} as key from normalized_item where {_DOI} <> '' union all select seq, '1:' || lower(trim(pmid)) from normalized_item where trim(coalesce(pmid, '')) <> '' union all select seq, '2:' || {url_sql('canonical_url')} from normalized_item where {url_sql('canonical_url')} <> ''")},
        u as (select a as x, b as y from e union select b, a from e), r(x, y) as (select x, y from u union select r.x, u.y from r join u on r.y = u.x), c as (select x, min(y) as root from r group by x)
        select least(x, root) as cluster_id, count(*) as n from (select x, least(x, root) as root from c) group by 1 having count(*) > 1""".replace("select least(x, root) as cluster_id, count(*) as n from (select x, least(x, root) as root from c)", "select root as cluster_id, count(*) as n from (select x, least(x, root) as root from c)"),
    "richest_records": """select key, seq, richness, cluster_size from (select *, row_number() over (partition by key order by richness desc, seq) as rn, count(*) over (partition by key) as cluster_size from (
        select seq, lower(trim(dedupe_key)) as key, cast(case when trim(coalesce(doi, '')) <> '' then 10 else 0 end + case when trim(coalesce(pmid, '')) <> '' then 8 else 0 end + coalesce(len(authors), 0) + least(length(coalesce(summary, '')) // 50, 10)
        + case when trim(coalesce(published_at, '')) <> '' then 5 else 0 end + coalesce(len(tags), 0) as bigint) as richness from normalized_item)) where rn = 1""",
    "ordered_duplicates": f"with {_EDGES.format(keys=f'''select seq, '0:' || {url_sql('canonical_url')} as key from normalized_item where {url_sql('canonical_url')} <> '' union all select seq, '1:' || {_TITLE} from normalized_item where {_TITLE} <> ''  ''')} select distinct b as seq from e",
    "history_matches": f"with {_MATCH} select item_id, hit.m as match_id, cast(hit.p as bigint) as match_priority from m",
    "history_novelty": rf"""with {_MATCH}, j as (select n.item_id, h.times_emitted as te, n.content_fingerprint <> h.content_fingerprint as ch,
        case when regexp_matches(h.last_emitted_at, '^\d{{4}}-\d{{2}}-\d{{2}}T\d{{2}}:\d{{2}}:\d{{2}}\+00:00$') then floor((epoch_us(timestamp '{AS_OF}') - epoch_us(cast(substr(h.last_emitted_at, 1, 19) as timestamp))) / 86400000000.0) end as d
        from incoming_item n left join m on m.item_id = n.item_id left join history h on h.id = m.hit.m)
        select case when te is null then 'new' when ch then 'updated_existing_item' when te = 0 then 'seen_not_emitted' when d >= 365 then 'reappeared_after_threshold' else 'previously_emitted' end as novelty, count(*) as n from j group by 1""",
    "history_next": """with b as (select lower(trim(dedupe_key)) as k, arg_min(title, item_id) as title, max(strftime(fetched_at, '%Y-%m-%dT%H:%M:%S+00:00')) as last_seen_at, count(*) as times_seen from incoming_item where dedupe_key is not null group by 1)
        select coalesce(h.dedupe_key, b.k) as dedupe_key, case when h.dedupe_key is null then b.title else h.title end as title, coalesce(b.last_seen_at, h.last_seen_at) as last_seen_at, coalesce(h.times_seen, 0) + coalesce(b.times_seen, 0) as times_seen from history h full join b on h.dedupe_key = b.k""",
    "history_stats": "select count(*) as total, count(*) filter (times_emitted > 0) as emitted, count(*) filter (times_seen > 1) as seen_again, max(last_seen_at) as last_seen_at from history",
    "emitted_marks": f"""with e as (select lower('doi:' || trim(doi)) as k, count(*) as n from selection_history where emitted_at is not null and doi is not null group by 1)
        select h.id, h.times_emitted + coalesce(e.n, 0) as times_emitted, case when e.n is not null then '{AS_OF}' else h.last_emitted_at end as last_emitted_at from history h left join e on h.dedupe_key = e.k""",
    "selection_lookup": f"""with i as (select item_id as id, 0 as p, {url_sql('canonical_url')} as k from incoming_item union all select item_id, 1, lower(trim(doi)) from incoming_item),
        s as (select id, 0 as p, {url_sql('url')} as k from selection_history union all select id, 1, lower(trim(doi)) from selection_history), m as (select i.id as item_id, min(struct_pack(p := i.p, m := s.id)) as hit from i join s on i.p = s.p and i.k = s.k and i.k <> '' group by i.id)
        select m.item_id, s.id as match_id, cast(floor((epoch_us(timestamp '{AS_OF}') - epoch_us(cast(substr(s.first_seen_at, 1, 19) as timestamp))) / 86400000000.0) as bigint) as days, s.emitted_at is not null as was_emitted from m join selection_history s on s.id = m.hit.m""",
    "selection_next": f"""with s as (select {url_sql('url')} as url, min(title) as title, max(last_seen_at) as last_seen_at, max(emitted_at) as emitted_at from selection_history group by 1), i as (select {url_sql('canonical_url')} as url, min(title) as title, max(strftime(fetched_at, '%Y-%m-%dT%H:%M:%S+00:00')) as last_seen_at from incoming_item group by 1)
        select coalesce(s.url, i.url) as url, case when s.url is null then i.title else s.title end as title, coalesce(i.last_seen_at, s.last_seen_at) as last_seen_at, s.emitted_at from s full join i on s.url = i.url""",
    "title_urls": "select n.item_id, n.title, k.url from incoming_item n left join (select title, arg_max(canonical_url, id) as url from history where title is not null group by title) k on n.title = k.title",
    "changed_fields": """with j as (select n.item_id, {0} from incoming_item n join history h on n.dedupe_key = h.dedupe_key)
        select item_id, array_to_string(list_filter([case when t1 <> '' and t2 <> '' and t1 <> t2 then 'title' end, case when d1 <> '' and d2 <> '' and d1 <> d2 then 'doi' end, case when u1 <> '' and u2 <> '' and u1 <> u2 then 'url' end, case when p1 <> '' and p2 <> '' and p1 <> p2 then 'pmid' end], lambda x: x is not null), ',') as changed from j""".replace(
        "{0}", ", ".join(rf"lower(trim(regexp_replace(coalesce({t}.{c}, ''), '\s+', ' ', 'g'))) as {a}{k}" for c, a in (("title", "t"), ("doi", "d"), ("canonical_url", "u"), ("pmid", "p")) for k, t in ((1, "n"), (2, "h")))
    ),
    "key_overlap": "select case when h is null then 'incoming' when i is null then 'history' else 'both' end as side, count(*) as n from (select distinct lower(trim(dedupe_key)) as h from history) a full join (select distinct lower(trim(dedupe_key)) as i from incoming_item) b on a.h = b.i where coalesce(h, i) is not null group by 1",
    "last_emission": "select a.id, max(b.emitted_at) as previous from selection_history a left join selection_history b on a.source = b.source and b.emitted_at <= a.first_seen_at where a.source is not null group by a.id",
}
QUERIES = {f.__name__: f for f in (exact_clusters, richest_records, fuzzy_title_pairs, article_clusters, ordered_duplicates, history_matches, history_novelty, history_next, history_stats, emitted_marks, selection_lookup, selection_next, title_urls, changed_fields, key_overlap, last_emission)}
