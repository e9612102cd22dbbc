"""Queries over items as they arrive: URLs, keys, texts, tags, dates and profiles."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedloom.functions import dates, ids, lists, text
from feedloom.operators import profile, resolve, score
from feedloom.operators.timestamps import to_utc_us
from feedloom.plans.instants_sql import INSTANTS_SQL
from feedloom.session import load
from feedloom.sources import blocks

AS_OF = "2026-01-01 00:00:00"


def items(spark: SparkSession, sf: str) -> DataFrame:
    return load(spark, sf, "normalized_item")


def as_of():
    return F.to_timestamp(F.lit(AS_OF))


def canonical_urls(spark: SparkSession, sf: str) -> DataFrame:
    return items(spark, sf).select("seq", ids.url(F.col("canonical_url")).alias("url"))


def dedupe_keys(spark: SparkSession, sf: str) -> DataFrame:
    day = F.date_format("fetched_at", "yyyy-MM-dd")
    return items(spark, sf).select("seq", ids.dedupe_key(ids.doi(F.col("doi")), F.col("pmid"), F.col("canonical_url"), F.col("title"), day).alias("key"), ids.fingerprint(F.col("title"), F.col("summary")).alias("fingerprint"), ids.raw_fingerprint(F.col("title"), F.col("canonical_url")).alias("raw_fingerprint"))


def legacy_keys(spark: SparkSession, sf: str) -> DataFrame:
    return items(spark, sf).select("seq", ids.legacy_url(F.col("canonical_url")).alias("url"), ids.content_hash(F.col("content_snippet")).alias("content_hash"), ids.legacy_key(F.col("canonical_url"), F.col("title"), F.col("content_snippet")).alias("key"), text.legacy_title(F.col("title")).alias("title"))


def plain_snippets(spark: SparkSession, sf: str) -> DataFrame:
    return items(spark, sf).select("seq", text.strip_html(F.col("content_snippet"), 200).alias("snippet"), text.strip_html(F.col("summary"), gap="").alias("summary"))


def domain_top_k(spark: SparkSession, sf: str) -> DataFrame:
    return profile.top_values(items(spark, sf), ids.domain(F.col("canonical_url")), "seq", 10)


def author_counts(spark: SparkSession, sf: str) -> DataFrame:
    return items(spark, sf).select(F.explode(lists.names(F.col("authors"))).alias("author")).groupBy("author").agg(F.count("*").alias("n"))


def merged_tags(spark: SparkSession, sf: str) -> DataFrame:
    feeds = load(spark, sf, "feed_config").select(F.col("url").alias("feed_url"), F.col("tags").alias("feed_tags"))
    df = items(spark, sf).select("seq", "feed_url", "tags").join(feeds, "feed_url", "left")
    return df.select("seq", F.posexplode(lists.merged_tags(F.col("tags"), F.col("feed_tags"))).alias("place", "tag")).select("seq", F.col("place").cast("bigint").alias("place"), "tag")


def freshness_attribution(spark: SparkSession, sf: str) -> DataFrame:
    """The date that counts; published and updated dates are read in every notation, in the zone of their feed."""
    feeds = load(spark, sf, "feed_config").select(F.col("url").alias("feed_url"), "tz_name", "date_order")
    df = items(spark, sf).select("seq", "feed_url", "published_at", "updated_at", "fetched_at").join(feeds, "feed_url", "left")
    df = to_utc_us(to_utc_us(df, "published_at", "tz_name", "date_order", "p"), "updated_at", "tz_name", "date_order", "u")
    f = dates.freshness(F.timestamp_micros("p"), F.timestamp_micros("u"), F.col("fetched_at").cast("timestamp"))
    return df.withColumn("f", f).select("seq", "f.date_source", "f.used_fallback_date", "f.freshness_confidence", dates.whole_days(F.col("f.at"), as_of()).alias("age_days"))


def recent_items(spark: SparkSession, sf: str) -> DataFrame:
    return items(spark, sf).filter(F.col("fetched_at") >= F.lit("2025-10-01").cast("timestamp_ntz")).select("seq", "run_id")


def corrections(spark: SparkSession, sf: str) -> DataFrame:
    """Which texts and titles speak of a correction, retraction or erratum."""
    texts = load(spark, sf, "documents").select(F.lit("documents").alias("source_table"), F.col("doc_id").alias("row_id"), F.col("text").alias("t"))
    titles = items(spark, sf).select(F.lit("normalized_item").alias("source_table"), F.col("seq").alias("row_id"), F.concat_ws(" ", "title", "summary").alias("t"))
    return texts.union(titles).groupBy("source_table").agg(F.count("*").alias("n"), F.count_if(score.is_correction(F.col("t"))).alias("n_corrections"))


def date_range_profile(spark: SparkSession, sf: str) -> DataFrame:
    df = items(spark, sf).filter(F.to_date("fetched_at").between("2023-01-01", "2024-06-30"))
    return profile.profile(df, "fetched_at", ids.domain(F.col("canonical_url")), F.length(F.coalesce("content_snippet", F.lit("")))).select("articles", F.date_format("first_at", "yyyy-MM-dd HH:mm:ss").alias("first_at"), F.date_format("last_at", "yyyy-MM-dd HH:mm:ss").alias("last_at"), "domains", "mean_length", "missing_date")


def peak_hour(spark: SparkSession, sf: str) -> DataFrame:
    return profile.peak_hour(items(spark, sf), "fetched_at")


def occurrence_histogram(spark: SparkSession, sf: str) -> DataFrame:
    n = resolve.occurrences(items(spark, sf), ids.legacy_key(F.col("canonical_url"), F.col("title"), F.col("content_snippet")), "seq")
    return profile.histogram(n, F.col("occurrences"), "occurrences")


def feed_diagnostics(spark: SparkSession, sf: str) -> DataFrame:
    feeds = load(spark, sf, "feed_config").select(F.col("url").alias("feed_url"), F.col("name").alias("feed_name"), "enabled")
    n = items(spark, sf).groupBy("feed_url").agg(F.count("*").alias("n_items"), F.count_if(F.coalesce("doi", F.lit("")) == "").alias("n_without_doi"), F.count_if(F.trim(F.coalesce("title", F.lit(""))) == "").alias("n_without_title"), F.count_if(F.col("retrieval_status") == "ok").alias("n_ok"))
    return feeds.join(n, "feed_url", "left").select("feed_name", "enabled", *[F.coalesce(c, F.lit(0)).alias(c) for c in ("n_items", "n_without_doi", "n_without_title", "n_ok")])


def run_summary(spark: SparkSession, sf: str) -> DataFrame:
    df = items(spark, sf)
    viable = (F.trim(F.coalesce("title", F.lit(""))) != "") | (F.trim(F.coalesce("canonical_url", F.lit(""))) != "")
    return df.groupBy("run_id").agg(F.count("*").alias("n_raw"), F.count_if(viable).alias("n_viable"), F.count_if(~viable).alias("n_dropped"), F.count_distinct("dedupe_key").alias("n_keys"), F.count_distinct("feed_url").alias("n_feeds"))


def temporal_periods(spark: SparkSession, sf: str) -> DataFrame:
    df = items(spark, sf).select("fetched_at")
    ends = df.agg(F.min("fetched_at").alias("first"), F.max("fetched_at").alias("last"))
    return df.crossJoin(F.broadcast(ends)).groupBy(dates.period(F.col("fetched_at"), F.col("first"), F.col("last"), 4).alias("period")).agg(F.count("*").alias("n"))


def text_blocks(spark: SparkSession, sf: str) -> DataFrame:
    df = items(spark, sf).select("seq", "title", "canonical_url", "content_snippet")
    made = blocks.write_blocks(df, "seq", {"Title": F.col("title"), "URL": F.col("canonical_url")}, F.col("content_snippet"))
    return blocks.parse_blocks(made, "block", ("Title", "URL")).select(F.col("number").alias("seq"), "title", "url", "content")


def json_records(spark: SparkSession, sf: str) -> DataFrame:
    packed = items(spark, sf).select(F.to_json(F.struct("seq", "title", "tags", "quality_score")).alias("j"))
    back = packed.select(F.from_json(lists.json_object(F.concat(F.lit("```json\n"), "j", F.lit("\n```"))), "seq bigint, title string, tags array<string>, quality_score double").alias("r"))
    return back.select("r.seq", "r.title", F.coalesce(F.size("r.tags"), F.lit(0)).cast("bigint").alias("n_tags"), F.round("r.quality_score", 3).alias("quality_score"))


def script_sections(spark: SparkSession, sf: str) -> DataFrame:
    """How many lines each section of a script has."""
    docs = load(spark, sf, "documents").filter("doc_type = 'script' and text is not null").select("doc_id", F.posexplode(F.split("text", "\n")).alias("line", "t"))
    return blocks.in_sections(docs, "t", "line", "doc_id").groupBy("doc_id", "section").agg(F.count("*").alias("n_lines"))


def script_titles(spark: SparkSession, sf: str) -> DataFrame:
    """The titles of scripts that are made of articles: stories first, the others as quick hits."""
    df = items(spark, sf).select("run_id", "seq", F.nullif(F.trim(F.regexp_replace("title", r"[\r\n]+", " ")), F.lit("")).alias("title"), (F.col("quality_score") >= 8).alias("main")).filter("title is not null")
    lines = df.select("run_id", F.when(F.col("main"), F.concat(F.lit("Story "), "seq", F.lit(": "), "title")).otherwise(F.concat(F.lit("• "), "title")).alias("t"), (F.col("seq") * 2 + F.when(F.col("main"), 0).otherwise(1 << 40)).alias("line"))
    heads = df.select("run_id").distinct().select("run_id", F.lit("=== QUICK HITS ===").alias("t"), F.lit((1 << 40) - 1).alias("line"))
    return blocks.script_titles(lines.unionByName(heads), "t", "line", "run_id").groupBy("run_id").agg(F.count("*").alias("n_titles"), F.sum(F.length("title")).alias("n_chars"))


def diagnostics_rollup(spark: SparkSession, sf: str) -> DataFrame:
    """Extension: counts on every level of source type and language."""
    return items(spark, sf).rollup("source_type", "language").agg(F.count("*").alias("n"), F.round(F.avg("quality_score"), 6).alias("mean_quality"))


WS = r"[\s\x{0B}\x{85}\p{Z}]+"
_TRACK = ", ".join(f"'{t}'" for t in ids.TRACKING)


def squeeze_sql(x: str) -> str:
    return f"trim(regexp_replace({x}, '{WS}', ' ', 'g'))"


def strip_sql(x: str) -> str:
    return rf"regexp_replace({x}, '^{WS}|{WS}$', '', 'g')"


def url_sql(c: str) -> str:
    u = strip_sql(f"coalesce({c}, '')")
    part = lambda i: f"regexp_extract({u}, '{ids.URL}', {i})"
    kept = f"array_to_string(list_filter(string_split({part(4)}, '&'), lambda x: contains(x, '=') and split_part(x, '=', 1) not in ({_TRACK})), '&')"
    return f"(case when {part(1)} <> '' then lower({part(1)}) || ':' else '' end || case when {part(2)} <> '' then '//' || lower({part(2)}) else '' end || regexp_replace({part(3)}, '/+$', '') || case when {kept} <> '' then '?' || {kept} else '' end)"


def doi_sql(c: str) -> str:
    return rf"nullif(regexp_replace(regexp_extract(coalesce({c}, ''), '(?i)\b(10\.\d{{4,9}}/[^\s\"''<>]+)', 1), '[.,;:)>\]''\"]+$', ''), '')"


def domain_sql(c: str) -> str:
    return f"coalesce(nullif(lower(regexp_extract({strip_sql(f'coalesce({c}, {chr(39) * 2})')}, '{ids.URL}', 2)), ''), 'unknown')"


def hash_sql(x: str) -> str:
    return f"substr(sha256({x}), 1, 16)"


def _entities_sql() -> str:
    """Named entities of Latin-1 and punctuation and their numbers, the ampersand last; SQL has no function for them."""
    from html.entities import name2codepoint

    pairs = [(f"&{name};", chr(n)) for name, n in sorted(name2codepoint.items()) if name != "amp"]
    pairs += [(f"&#{n};", chr(n)) for n in [*range(33, 256), *range(8208, 8240), 8364, 8722] if n != 38 and not 127 <= n < 160] + [("&#x27;", "'"), ("&#x2F;", "/"), ("&LT;", "<"), ("&GT;", ">"), ("&QUOT;", '"')]
    pairs += [(f"&#{n}", chr(n)) for n in range(33, 100) if n != 38]  # numbers that lost their end
    pairs += [(x, "&") for x in ("&AMP;", "&#38;", "&amp;")]
    quoted = lambda x: x.replace("'", "''")
    return "[" + ", ".join(f"struct_pack(a := '{quoted(a)}', b := '{quoted(b)}')" for a, b in pairs) + "]"


_ENTITIES = _entities_sql()


def html_sql(c: str, gap: str = " ") -> str:
    t = f"regexp_replace(coalesce({c}, ''), '<[^>]+>', '{gap}', 'g')"
    return squeeze_sql(f"list_reduce(list_prepend(struct_pack(a := {t}, b := ''), {_ENTITIES}), lambda x, e: struct_pack(a := replace(x.a, e.a, e.b), b := '')).a")


def legacy_url_sql(c: str) -> str:
    return f"lower(regexp_replace(regexp_replace(trim(coalesce({c}, '')), '[?#].*$', ''), '/+$', ''))"


_TITLE_CMP = "regexp_replace(" + squeeze_sql("lower(coalesce(title, ''))") + r", '^(?:breaking|exclusive|update|correction|retraction):\s*', '')"
_CONTENT_HASH = "md5(" + squeeze_sql("lower(coalesce(content_snippet, ''))") + ")"
_LEGACY_KEY = f"coalesce('url:' || nullif({legacy_url_sql('canonical_url')}, ''), 'title:' || nullif({_TITLE_CMP}, ''), 'content:' || case when trim(coalesce(content_snippet, '')) <> '' then {_CONTENT_HASH} end, 'fallback:')"
_FULL = "nullif(trim(coalesce({0}, '')), '')"

SQL = {
    "canonical_urls": f"select seq, {url_sql('canonical_url')} as url from normalized_item",
    "dedupe_keys": f"""select seq, coalesce('doi:' || lower({doi_sql('doi')}), 'pmid:' || {_FULL.format('pmid')}, 'url:' || {hash_sql(f"nullif({url_sql('canonical_url')}, '')")},
        'title:' || {hash_sql(squeeze_sql("lower(coalesce(title, ''))") + " || '|' || coalesce(strftime(fetched_at, '%Y-%m-%d'), 'nodate')")}) as key,
        {hash_sql(squeeze_sql("lower(coalesce(title, ''))") + " || '|' || " + squeeze_sql("lower(substr(coalesce(summary, ''), 1, 200))"))} as fingerprint,
        {hash_sql("coalesce(title, '') || '|' || coalesce(canonical_url, '')")} as raw_fingerprint from normalized_item""",
    "legacy_keys": f"""select seq, {legacy_url_sql('canonical_url')} as url, {_CONTENT_HASH} as content_hash, {_LEGACY_KEY} as key,
        trim(replace(replace(replace(replace(trim(lower(coalesce(title, ''))), 'breaking:', ''), 'breaking news:', ''), 'exclusive:', ''), 'exclusive news:', '')) as title from normalized_item""",
    "plain_snippets": f"""select seq, case when length(t) <= 200 then t else regexp_replace(substr(t, 1, 200), ' [^ ]*$', '') end as snippet, s as summary
        from (select seq, {html_sql('content_snippet')} as t, {html_sql('summary', '')} as s from normalized_item)""",
    "domain_top_k": f"select {domain_sql('canonical_url')} as value, count(*) as n, min(seq) as first_id from normalized_item group by 1 order by n desc, first_id limit 10",
    "author_counts": "select author, count(*) as n from (select unnest(list_filter(list_transform(authors, lambda a: trim(a)), lambda a: a is not null and a <> '')) as author from normalized_item) group by author",
    "merged_tags": """with t as (select i.seq, list_concat(coalesce(i.tags, []), coalesce(f.tags, [])) as tags from normalized_item i left join feed_config f on i.feed_url = f.url),
        e as (select seq, trim(unnest(tags)) as tag, generate_subscripts(tags, 1) as k from t), d as (select * from e where tag is not null and tag <> '' qualify row_number() over (partition by seq, lower(tag) order by k) = 1)
        select seq, row_number() over (partition by seq order by k) - 1 as place, tag from d""",
    "freshness_attribution": f"""with {INSTANTS_SQL}, p as (select i.seq, a.us as p, b.us as u, epoch_us(i.fetched_at) as f from normalized_item i left join instants a on a.row_id = i.seq and a.field_name = 'published_at' and a.source_table = 'normalized_item' left join instants b on b.row_id = i.seq and b.field_name = 'updated_at' and b.source_table = 'normalized_item')
        select seq, case when p is not null then 'published_at' when u is not null then 'updated_at' else 'fetched_at' end as date_source, p is null as used_fallback_date,
        case when p is not null then 'high' when u is not null then 'medium' else 'low' end as freshness_confidence,
        cast(floor((epoch_us(timestamp '{AS_OF}') - coalesce(p, u, f)) / 86400000000.0) as bigint) as age_days from p""",
    "recent_items": "select seq, run_id from normalized_item where fetched_at >= timestamp '2025-10-01'",
    "corrections": f"select source_table, count(*) as n, count(*) filter (regexp_matches(lower(coalesce(t, '')), '{score.CORRECTION}')) as n_corrections from (select 'documents' as source_table, text as t from documents union all select 'normalized_item', concat_ws(' ', title, summary) from normalized_item) group by 1",
    "date_range_profile": f"""select count(*) as articles, strftime(min(fetched_at), '%Y-%m-%d %H:%M:%S') as first_at, strftime(max(fetched_at), '%Y-%m-%d %H:%M:%S') as last_at, count(distinct {domain_sql('canonical_url')}) as domains,
        cast(floor(avg(length(coalesce(content_snippet, '')))) as bigint) as mean_length, count(*) - count(fetched_at) as missing_date
        from normalized_item where cast(fetched_at as date) between date '2023-01-01' and date '2024-06-30'""",
    "peak_hour": "select hour(fetched_at) as hour, count(*) as n from normalized_item where fetched_at is not null group by 1 order by n desc, hour limit 1",
    "occurrence_histogram": f"select occurrences, count(*) as n from (select {_LEGACY_KEY} as k, count(*) as occurrences from normalized_item group by 1) group by 1",
    "feed_diagnostics": """select f.name as feed_name, f.enabled, coalesce(n_items, 0) as n_items, coalesce(n_without_doi, 0) as n_without_doi, coalesce(n_without_title, 0) as n_without_title, coalesce(n_ok, 0) as n_ok from feed_config f left join
        (select feed_url, count(*) as n_items, count(*) filter (coalesce(doi, '') = '') as n_without_doi, count(*) filter (trim(coalesce(title, '')) = '') as n_without_title, count(*) filter (retrieval_status = 'ok') as n_ok from normalized_item group by 1) n on f.url = n.feed_url""",
    "run_summary": """select run_id, count(*) as n_raw, count(*) filter (v) as n_viable, count(*) filter (not v) as n_dropped, count(distinct dedupe_key) as n_keys, count(distinct feed_url) as n_feeds
        from (select *, trim(coalesce(title, '')) <> '' or trim(coalesce(canonical_url, '')) <> '' as v from normalized_item) group by run_id""",
    "temporal_periods": """with e as (select min(fetched_at) as a, max(fetched_at) as b from normalized_item)
        select cast(case when fetched_at is null then -1 else floor(floor((epoch_us(fetched_at) - epoch_us(a)) / 86400000000.0) / (floor((epoch_us(b) - epoch_us(a)) / 86400000000.0) / 4.0)) end as bigint) as period, count(*) as n from normalized_item, e group by 1""",
    "text_blocks": rf"""select seq, nullif({strip_sql("regexp_replace(title, '[\r\n]+', ' ', 'g')")}, '') as title, nullif({strip_sql("regexp_replace(canonical_url, '[\r\n]+', ' ', 'g')")}, '') as url, regexp_replace(coalesce(content_snippet, ''), '\s+$', '') as content from normalized_item""",
    "json_records": "select seq, title, coalesce(len(tags), 0) as n_tags, round(quality_score, 3) as quality_score from normalized_item",
    "script_sections": r"""with l as (select doc_id, unnest(string_split(text, chr(10))) as t, generate_subscripts(string_split(text, chr(10)), 1) as line from documents where doc_type = 'script' and text is not null),
        s as (select doc_id, last_value(case when regexp_matches(trim(t), '^={3} .* ={3}$') then trim(t) end ignore nulls) over (partition by doc_id order by line rows between unbounded preceding and current row) as section from l)
        select doc_id, coalesce(section, '') as section, count(*) as n_lines from s group by 1, 2""",
    "script_titles": r"""with t as (select run_id, seq, coalesce(quality_score >= 8, false) as main, trim(regexp_replace(title, '[\r\n]+', ' ', 'g')) as t from normalized_item), k as (select * from t where t <> '')
        select run_id, count(*) as n_titles, cast(sum(length(t)) as bigint) as n_chars from k group by 1""",
    "diagnostics_rollup": "select source_type, language, count(*) as n, round(avg(quality_score), 6) as mean_quality from normalized_item group by rollup (source_type, language)",
}
QUERIES = {f.__name__: f for f in (canonical_urls, dedupe_keys, legacy_keys, plain_snippets, domain_top_k, author_counts, merged_tags, freshness_attribution, recent_items, corrections, date_range_profile, peak_hour, occurrence_histogram, feed_diagnostics, run_summary, temporal_periods, text_blocks, json_records, script_sections, script_titles, diagnostics_rollup)}
