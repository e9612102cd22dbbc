"""Queries over articles on their way to an issue: identifiers, dates, types, novelty, the ingest run, ranks and diagnostics."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedloom.functions import dates, ids, lists, text
from feedloom.operators import history, profile, ranking, resolve, score
from feedloom.plans.entities import _matched
from feedloom.plans.ingest import AS_OF, as_of, doi_sql, items, strip_sql
from feedloom.plans.texts import TOPICS, _any_sql
from feedloom.session import checkpoint_dir, load
from feedloom.sources import files

# Parameters: what these queries look for in the articles, and the windows and caps they apply.
SOURCE_TYPES = {"news": "commentary", "journal": "original_research", "annals": "original_research", "review": "review"}
HINTS = {"editorial": ["editorial", "letter to the editor"], "commentary": ["commentary", "viewpoint", "argued"], "review": ["systematic review", "pooled"], "original_research": ["randomised", "randomized", "cohort", "enrolled", "recruited"]}
EXPLICIT = [(r"\bregistry\b", "registry_report")]
NOT_FOR_COPY = ["not available", "click here", "to follow", "cookies"]
NO_EDITORIAL = ["abstract", "cookies", "click here"]
LOOKBACK_DAYS, ALLOW_AFTER_DAYS = 365, 90


def article_ids(spark: SparkSession, sf: str) -> DataFrame:
    """Identifiers by probe order; each of DOI and PMID has its own first hit."""
    probes = [F.col("canonical_url"), F.col("raw_item_id"), F.col("doi"), F.col("pmid"), F.substring("summary", 1, 500), F.substring("content_snippet", 1, 500)]
    return items(spark, sf).select(
        "seq", ids.article_id(F.col("canonical_url"), F.col("title")).alias("article_id"), ids.first_of(probes, ids.doi).alias("found_doi"), ids.first_of(probes, ids.pmid).alias("found_pmid"),
        text.first_words(F.col("title")).alias("first_words"), lists.first_filled(F.array("summary", "content_snippet")).alias("first_text"), text.truthy(F.col("used_fallback_date").cast("string")).alias("is_fallback"),
    )


def display_fields(spark: SparkSession, sf: str) -> DataFrame:
    """How fields are shown: labels, long dates, authors as one line and split again, text fit for copy."""
    line = F.array_join(lists.names(F.col("authors")), ", ")
    return items(spark, sf).select(
        "seq", text.label(F.concat_ws("_", "source_type", "language")).alias("label"), dates.long_date(F.col("fetched_at")).alias("day"), line.alias("authors_line"),
        F.size(lists.split_names(line)).cast("bigint").alias("n_split"), text.for_copy(F.col("summary"), NOT_FOR_COPY).alias("copy"), text.acceptable(F.col("summary"), NO_EDITORIAL).alias("acceptable"),
    )


def heuristic_types(spark: SparkSession, sf: str) -> DataFrame:
    """Type by source, else by hints; the tier that length and type suggest; the topic of most hits."""
    kind = score.type_by_hints(F.col("title"), F.col("content_snippet"), F.col("source_name"), SOURCE_TYPES, HINTS)
    tier = score.tier_estimate(F.length(F.coalesce("content_snippet", F.lit(""))), F.col("kind"))
    return items(spark, sf).withColumn("kind", kind).select("seq", "kind", tier.alias("tier"), score.tier_penalty(tier).alias("penalty"), score.top_topic(F.concat_ws(" ", F.coalesce("title", F.lit("")), F.coalesce("content_snippet", F.lit(""))), TOPICS).alias("topic"))


def staged_types(spark: SparkSession, sf: str) -> DataFrame:
    """The whole cascade: configured patterns, the title, title and text, what was known before, a default."""
    return items(spark, sf).select("seq", score.staged_type(F.col("title"), F.col("content_snippet"), EXPLICIT, score.TITLE_TYPES, F.col("source_type"), "unknown").alias("article_type"))


def raw_richness(spark: SparkSession, sf: str) -> DataFrame:
    """Richness over tags as they are concatenated, without removing repeats."""
    feeds = load(spark, sf, "feed_config").select(F.col("url").alias("feed_url"), F.col("tags").alias("feed_tags"))
    none = F.array().cast("array<string>")
    df = items(spark, sf).join(feeds, "feed_url", "left").withColumn("tags", F.concat(F.coalesce("tags", none), F.coalesce("feed_tags", none)))
    return df.select("seq", F.size("tags").cast("bigint").alias("n_tags"), resolve.richness(F.col("doi"), F.col("pmid"), F.col("authors"), F.col("summary"), F.col("published_at"), F.col("tags")).alias("richness"))


def freshness_walk(spark: SparkSession, sf: str) -> DataFrame:
    """The source of the date that counts for records that name none, and the first filled one of an ordered list."""
    full = lambda c: F.nullif(F.trim(F.coalesce(c, F.lit(""))), F.lit(""))
    known = dates.rederived(F.col("date_source"), F.col("freshness_confidence"), full("published_at"), full("updated_at"), F.col("fetched_at"))
    walk = dates.first_known([("doi_date", F.lit(None).cast("string")), ("updated_at", full("updated_at")), ("fetched_at", F.col("fetched_at").cast("string"))], {"updated_at"})
    return items(spark, sf).select("seq", known["date_source"].alias("date_source"), known["used_fallback_date"].alias("used_fallback"), known["freshness_confidence"].alias("confidence"), walk["date_source"].alias("walked"), walk["freshness_confidence"].alias("walk_confidence"))


def age_cutoff(spark: SparkSession, sf: str) -> DataFrame:
    """Articles within the look-back; those without a date pass.  Also whether they lie in the default range of a report."""
    at = F.to_timestamp("published_date", "yyyy-MM-dd")
    start, end = dates.default_range(as_of(), 7)
    return load(spark, sf, "selection_history").filter(dates.recent(at, as_of(), LOOKBACK_DAYS)).select("id", F.coalesce(at.between(start, end), F.lit(False)).alias("in_default_range"), dates.close(at, F.to_timestamp(F.substring("first_seen_at", 1, 10), "yyyy-MM-dd")).alias("is_close"))


def _novelty(spark: SparkSession, sf: str) -> DataFrame:
    old = load(spark, sf, "history").select(F.col("id").alias("match_id"), "times_seen", "times_emitted", "last_emitted_at", F.col("content_fingerprint").alias("old_print"))
    at = F.when(F.col("last_emitted_at").rlike(r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}\+00:00$"), F.to_timestamp(F.substring("last_emitted_at", 1, 19), "yyyy-MM-dd'T'HH:mm:ss"))
    df = _matched(spark, sf).join(old, "match_id", "left")
    return df.withColumn("novelty", history.novelty(F.col("times_emitted"), at, as_of(), LOOKBACK_DAYS, F.col("content_fingerprint") != F.col("old_print")))


def novelty_split(spark: SparkSession, sf: str) -> DataFrame:
    """The annotated batch: what is kept and what is suppressed, with the state as the run found and left it."""
    df = _novelty(spark, sf).withColumn("suppressed", history.suppressed(F.col("novelty"), emitted=True, seen=False))
    seen = F.col("match_id").isNotNull()
    return df.select("item_id", "novelty", "suppressed", seen.alias("is_previously_seen"), F.coalesce(F.col("times_emitted") > 0, F.lit(False)).alias("is_previously_emitted"), F.when(seen, F.lit(AS_OF)).alias("previous_last_seen_at"))


def selection_novelty(spark: SparkSession, sf: str) -> DataFrame:
    """Windows of the selection: emitted within the window is suppressed, seen only if asked for."""
    keys = lambda doi, pmid, url, mark: [F.lower(F.trim(doi)), F.trim(pmid), ids.url(F.col(url)), F.trim(mark)]
    sel = load(spark, sf, "selection_history")
    df = history.lookup(load(spark, sf, "incoming_item").select("item_id", "doi", "pmid", "canonical_url", "content_fingerprint"), "item_id", keys("doi", "pmid", "canonical_url", "content_fingerprint"), sel, "id", keys("doi", "pmid", "url", "fingerprint"))
    at = lambda c: F.to_timestamp(F.substring(c, 1, 19), "yyyy-MM-dd'T'HH:mm:ss")
    state = history.window_state(F.col("match_id").isNotNull(), dates.whole_days(at("first_seen_at"), as_of()), dates.whole_days(at("emitted_at"), as_of()), ALLOW_AFTER_DAYS, emitted=True, seen=True)
    known = sel.select(F.col("id").alias("match_id"), "first_seen_at", "emitted_at")
    return df.join(known, "match_id", "left").select("item_id", state["status"].alias("status"), state["seen_days"].alias("seen_days"), state["emitted_days"].alias("emitted_days"), state["suppressed"].alias("suppressed"), "match_priority")


def published_marks(spark: SparkSession, sf: str) -> DataFrame:
    """Emission on publication: only if it is switched on are chosen articles marked."""
    sel = load(spark, sf, "selection_history")
    chosen = sel.filter("impact_score >= 7").select("id")
    on = history.mark_published(sel, chosen, "id", AS_OF, update_history=True).select("id", F.col("emitted_at").alias("marked"))
    return on.join(history.mark_published(sel, chosen, "id", AS_OF, update_history=False).select("id", "emitted_at"), "id")


def ingest_summary(spark: SparkSession, sf: str) -> DataFrame:
    """The counters of an ingest run, from raw items to what is emitted; every stage is counted in one plan."""
    raw = items(spark, sf).select("seq", "title", "canonical_url", "dedupe_key", "fetched_at", "doi", "pmid", "authors", "summary", "published_at", "tags", "content_fingerprint")
    filled = lambda c: F.trim(F.coalesce(c, F.lit(""))) != ""
    viable = (filled("title") | filled("canonical_url")) & ~score.is_correction(F.col("title")) & dates.recent(F.col("fetched_at"), as_of(), LOOKBACK_DAYS)
    normal = raw.filter(viable).withColumn("richness", resolve.richness(F.col("doi"), F.col("pmid"), F.col("authors"), F.col("summary"), F.col("published_at"), F.col("tags")))
    kept = resolve.best_of(normal.select(F.lower(F.trim("dedupe_key")).alias("key"), "seq", "richness", "content_fingerprint"), "key", "richness", "seq")
    old = load(spark, sf, "history").select(F.col("dedupe_key").alias("key"), "times_emitted", F.col("content_fingerprint").alias("old_print"))
    state = history.novelty(F.col("times_emitted"), F.lit(None).cast("timestamp"), as_of(), LOOKBACK_DAYS, F.col("content_fingerprint") != F.col("old_print"))
    seen = kept.join(old, "key", "left").withColumn("novelty", state)
    counts = seen.agg(
        F.count("*").alias("after_dedupe"), F.count("times_emitted").alias("previously_seen"), F.count_if(F.col("times_emitted") > 0).alias("previously_emitted"), F.count_if(F.col("novelty") == history.NEW).alias("novel"),
        F.count_if(history.suppressed(F.col("novelty"), emitted=True, seen=False)).alias("suppressed"), F.count_if(F.col("novelty") == history.UPDATED).alias("updated"),
    )
    return raw.agg(F.count("*").alias("raw_items"), F.count_if(viable).alias("after_normalization"), F.count_if(~viable).alias("dropped")).crossJoin(F.broadcast(counts))  # one row each


def evidence_next(spark: SparkSession, sf: str) -> DataFrame:
    """The evidence cache after a batch: what a field holds and what supports it as one text; the first time stays."""
    old = load(spark, sf, "history").filter("canonical_url != ''").groupBy(F.col("canonical_url").alias("article_id")).agg(F.min("title").alias("evidence"), F.min("first_seen_at").alias("created_at"), F.min("last_seen_at").alias("updated_at"))
    found = lists.evidence_text([(F.col("title"), F.array("doi", "pmid")), (F.col("summary"), F.array(F.lit(None).cast("string")))])
    new = load(spark, sf, "incoming_item").filter("canonical_url != ''").groupBy(F.col("canonical_url").alias("article_id")).agg(F.max_by(F.struct(found.alias("t")), "item_id").alias("e")).select("article_id", F.col("e.t").alias("evidence"), F.lit(AS_OF).alias("created_at"), F.lit(AS_OF).alias("updated_at"))
    return history.upsert(old, new, "article_id", ["created_at"], {"evidence": F.col("evidence"), "updated_at": F.col("updated_at")}, {})


def selection_diagnostics(spark: SparkSession, sf: str) -> DataFrame:
    """Conditional counts over all candidates, the histogram of reasons by their first words, and that of sources."""
    df = items(spark, sf).withColumn("kind", score.staged_type(F.col("title"), F.col("content_snippet"), EXPLICIT, score.TITLE_TYPES, F.col("source_type"), "unknown"))
    low, no_date = F.coalesce("quality_score", F.lit(0.0)) < 4, F.trim(F.coalesce("published_at", F.lit(""))) == ""
    reason = F.when(F.col("kind") == "registry_report", F.concat(F.lit("article type is excluded: "), "kind")).when(low, F.lit("quality score is below the floor")).when(no_date, F.lit("no date of publication"))
    flags = {"suppressed_type": F.col("kind") == "registry_report", "below_floor": low, "missing_date": no_date, "main": F.col("quality_score") >= 8, "quick": F.col("quality_score").between(4, 8)}
    return profile.diagnostics(df, flags, reason, F.col("source_type"))


def trends(spark: SparkSession, sf: str) -> DataFrame:
    """The three topics of most articles, and from how many sources each comes."""
    topic = score.top_topic(F.concat_ws(" ", F.coalesce("title", F.lit("")), F.coalesce("content_snippet", F.lit(""))), TOPICS)
    return items(spark, sf).groupBy(topic.alias("topic")).agg(F.count("*").alias("n"), F.count_distinct("feed_url").alias("n_sources"), F.min("seq").alias("first_seq")).orderBy(F.desc("n"), "first_seq").limit(3)


def issue_durations(spark: SparkSession, sf: str) -> DataFrame:
    main, quick = F.count_if(F.col("quality_score") >= 8), F.count_if((F.col("quality_score") >= 4) & (F.col("quality_score") < 8))
    return items(spark, sf).groupBy("run_id").agg((main * 180 + quick * 20).alias("seconds"), main.alias("n_main"), quick.alias("n_quick"))


def ranked_scores(spark: SparkSession, sf: str) -> DataFrame:
    """Every item with its place by score (a distributed rank, no single task)."""
    df = items(spark, sf).select("seq", F.coalesce("quality_score", F.lit(-1.0)).alias("score"))
    return ranking.ranked(df, [F.desc("score"), F.asc("seq")])


def newest_items(spark: SparkSession, sf: str) -> DataFrame:
    """The first hundred by date; a limit of 0 means all."""
    df = items(spark, sf).select("seq", F.date_format("fetched_at", "yyyy-MM-dd HH:mm:ss").alias("at"))
    return ranking.first_rows(df, [F.desc("at"), F.asc("seq")], 100)


def capped_again(spark: SparkSession, sf: str) -> DataFrame:
    """A capped top list that counts what was chosen before."""
    before = load(spark, sf, "selection_history").join(load(spark, sf, "feed_config").select(F.col("name").alias("source"), F.col("url").alias("feed_url")), "source").groupBy("feed_url").agg(F.count("*").alias("n"))
    df = items(spark, sf).select("seq", "feed_url", F.coalesce("quality_score", F.lit(-1.0)).alias("score"))
    return ranking.capped_top(df, "feed_url", [F.desc("score"), F.asc("seq")], 40, 50, existing=before)


def topic_summaries(spark: SparkSession, sf: str) -> DataFrame:
    """The first eight different topics (titles where there is none) of each run, in order."""
    topic = F.nullif(score.top_topic(F.col("title"), TOPICS), F.lit("general"))
    df = items(spark, sf).select("run_id", "seq", F.coalesce(topic, F.nullif(F.substring(F.coalesce("title", F.lit("")), 1, 80), F.lit(""))).alias("label"))
    return ranking.first_distinct(df, "run_id", "seq", "label", 8).select("run_id", F.array_join("labels", "\n").alias("summary"))


def article_blocks(spark: SparkSession, sf: str) -> DataFrame:
    """Articles in texts, counted by their blocks and not by a phrase; several fields are read back."""
    from feedloom.sources import blocks

    df = items(spark, sf).select("seq", "title", "source_name", "authors", "fetched_at", "content_snippet")
    made = blocks.write_blocks(df, "seq", {"Title": F.col("title"), "Source": F.col("source_name"), "Authors": F.array_join(lists.names(F.col("authors")), ", "), "Fetched At": F.date_format("fetched_at", "yyyy-MM-dd HH:mm:ss")}, F.col("content_snippet"))
    back = blocks.parse_blocks(made, "block", ("Title", "Source", "Authors", "Fetched At"))
    return back.agg(F.count("*").alias("n_articles"), F.count("source").alias("n_sources"), F.count("authors").alias("n_authors"), F.count("fetched_at").alias("n_dated"), F.sum(F.length("content")).alias("n_chars"))


def cap_audit(spark: SparkSession, sf: str) -> DataFrame:
    """How many articles fill the roles under the caps, twice the caps, and none."""
    df = items(spark, sf).select("seq", "quality_score", "feed_url", (F.coalesce("quality_score", F.lit(0.0)) >= 8).alias("is_main"), (F.coalesce("quality_score", F.lit(0.0)) >= 4).alias("is_quick"))
    return ranking.cap_audit(df, "seq", "quality_score", "feed_url", [("main", "is_main", 40), ("quick", "is_quick", 60)], {"strict": 1, "relaxed": 2, "off": None})


def first_titles(spark: SparkSession, sf: str) -> DataFrame:
    """Where each title was accepted first, over both tables of accepted articles."""
    part = lambda name, k: load(spark, sf, name).filter("title is not null").select("title", F.lit(k).alias("place"), "id")
    both = history.union_all([part("history", 0), part("selection_history", 1)])
    return resolve.first_window(both, ["title"], [F.asc("place"), F.asc("id")]).select("title", F.col("place").cast("bigint").alias("place"), "id")


def overlaid_metadata(spark: SparkSession, sf: str) -> DataFrame:
    """The metadata of each item with the values of its columns over it."""
    over = F.create_map(F.lit("language"), F.coalesce("language", F.lit("")), F.lit("doi"), F.coalesce("doi", F.lit("")))
    made = lists.overlay(F.coalesce("raw_metadata", F.create_map().cast("map<string,string>")), over)
    return items(spark, sf).select("seq", F.array_join(F.array_sort(F.map_keys(made)), ",").alias("names"), F.try_element_at(made, F.lit("language")).alias("language"))


def stored_items(spark: SparkSession, sf: str) -> DataFrame:
    """Items written as lines of JSON to the shared folder and read back."""
    path = f"{checkpoint_dir(spark)}/lines-{uuid.uuid4().hex}"
    files.write_lines(items(spark, sf).select("seq", "title", "tags"), path)
    return files.read_items(spark, path, "seq bigint, title string, tags array<string>").select("seq", "title", F.coalesce(F.size("tags"), F.lit(0)).cast("bigint").alias("n_tags"))


def stored_versions(spark: SparkSession, sf: str) -> DataFrame:
    """Two versions of a stored state; readers see the one named last."""
    state = files.Snapshots(spark, f"{checkpoint_dir(spark)}/state-{uuid.uuid4().hex}")
    old = load(spark, sf, "history").select("dedupe_key", "times_seen")
    state.write(old)
    state.write(state.read("dedupe_key string, times_seen bigint").withColumn("times_seen", F.col("times_seen") + 1))
    return state.read("dedupe_key string, times_seen bigint")


_TEXT = "lower(coalesce(title, '') || ' ' || coalesce(content_snippet, ''))"
def _topic_sql(x: str) -> str:
    """The topic of most keyword hits; the first of equals."""
    n = [" + ".join(f"(case when contains({x}, '{w}') then 1 else 0 end)" for w in words) for words in TOPICS.values()]
    best = f"greatest({', '.join(n)})"
    return "case " + f"when {best} = 0 then 'general' " + " ".join(f"when {a} = {best} then '{t}'" for t, a in zip(TOPICS, n)) + " end"


def _cascade(x: str) -> str:
    return " ".join(f"when regexp_matches({x}, '{p}') then '{label}'" for p, label in score.TITLE_TYPES)


_FULL = "nullif(trim(coalesce({0}, '')), '')"
_NAMES = "list_filter(list_transform(coalesce(authors, []), lambda a: trim(a)), lambda a: a is not null and a <> '')"
_PROBES = ("canonical_url", "raw_item_id", "doi", "pmid", "substr(summary, 1, 500)", "substr(content_snippet, 1, 500)")
_RICH = "cast(case when trim(coalesce(doi, '')) <> '' then 10 else 0 end + case when trim(coalesce(pmid, '')) <> '' then 8 else 0 end + coalesce(len(authors), 0) + least(length(coalesce(summary, '')) // 50, 10) + case when trim(coalesce(published_at, '')) <> '' then 5 else 0 end + {tags} as bigint)"
_STAGED = f"case {' '.join(f'when regexp_matches({{p}}, {chr(39)}{p}{chr(39)}) then {chr(39)}{label}{chr(39)}' for p, label in EXPLICIT)} {_cascade('{t}')} {_cascade('{p}')} when trim(lower(coalesce(source_type, ''))) not in ('', 'unknown') then trim(lower(source_type)) else 'unknown' end".replace("{t}", "lower(coalesce(title, ''))").replace("{p}", "(lower(coalesce(title, '')) || ' ' || lower(substr(coalesce(content_snippet, ''), 1, 500)))")
_KIND = "case " + " ".join(f"when contains(lower(coalesce(source_name, '')), '{k}') then '{v}'" for k, v in SOURCE_TYPES.items()) + " " + " ".join(f"when {_any_sql(_TEXT, words)} then '{k}'" for k, words in HINTS.items()) + " else 'unknown' end"


def _pmid_sql(c: str) -> str:
    return rf"coalesce(nullif(regexp_extract(coalesce({c}, ''), '(?i)(?:pubmed\.ncbi\.nlm\.nih\.gov|ncbi\.nlm\.nih\.gov/pubmed)/(\d{{1,8}})', 1), ''), nullif(regexp_extract(coalesce({c}, ''), '(?i)\bpmid:(\d{{1,8}})\b', 1), ''))"


def _match_cte() -> str:
    from feedloom.plans.entities import _MATCH

    return _MATCH


def _selection_keys(t: str, i: str, doi: str, url: str, mark: str) -> str:
    from feedloom.plans.ingest import url_sql

    return " union all ".join(f"select {i} as id, {p} as p, {k} as k from {t}" for p, k in enumerate((f"lower(trim({doi}))", "trim(pmid)", url_sql(url), f"trim({mark})")))


_STATE = rf"""case when te is null then 'new' when ch then 'updated_existing_item' when te = 0 then 'seen_not_emitted' when d >= {LOOKBACK_DAYS} then 'reappeared_after_threshold' else 'previously_emitted' end"""
SQL = {
    "first_titles": "select title, place, id from (select *, row_number() over (partition by title order by place, id) as rn from (select title, 0 as place, id from history union all select title, 1, id from selection_history) where title is not null) where rn = 1",
    "overlaid_metadata": "select seq, array_to_string(list_sort(list_distinct(list_concat(coalesce(map_keys(raw_metadata), []), ['doi', 'language']))), ',') as names, coalesce(language, '') as language from normalized_item",
    "stored_items": "select seq, title, coalesce(len(tags), 0) as n_tags from normalized_item",
    "stored_versions": "select dedupe_key, times_seen + 1 as times_seen from history",
    "article_ids": f"""select seq, coalesce(nullif(canonical_url, ''), title) as article_id, coalesce({', '.join(doi_sql(p) for p in _PROBES)}) as found_doi, coalesce({', '.join(_pmid_sql(p) for p in _PROBES)}) as found_pmid,
        array_to_string(string_split(coalesce(title, ''), ' ')[1:4], ' ') as first_words, coalesce(nullif(summary, ''), nullif(content_snippet, '')) as first_text, coalesce(used_fallback_date, false) as is_fallback from normalized_item""",
    "display_fields": f"""with l as (select *, array_to_string({_NAMES}, ', ') as authors_line, {strip_sql("regexp_replace(summary, '\\*\\*[^*]+\\*\\*:\\s*', '', 'g')")} as bare from normalized_item)
        select seq, replace(concat_ws('_', source_type, language), '_', ' ') as label, strftime(fetched_at, '%B %d, %Y') as day, authors_line, len(list_filter(list_transform(string_split(authors_line, ','), lambda a: trim(a)), lambda a: a <> '')) as n_split,
        case when trim(coalesce(summary, '')) <> '' and not {_any_sql("lower(coalesce(summary, ''))", NOT_FOR_COPY)} then trim(regexp_replace(summary, '\\*\\*[^*]+\\*\\*:\\s*', '', 'g')) end as copy,
        length(coalesce(summary, '')) >= 30 and not {_any_sql("lower(coalesce(summary, ''))", NO_EDITORIAL)} as acceptable from l""",
    "heuristic_types": f"""with k as (select *, {_KIND} as kind, length(coalesce(content_snippet, '')) as n from normalized_item), t as (select *, case when n < 100 then 'titles_to_watch' when n < 300 or kind in ('editorial', 'commentary') then 'short_blurb' else 'full' end as tier from k)
        select seq, kind, tier, case tier when 'full' then 0.0::double when 'short_blurb' then -2.0::double else -6.0::double end as penalty, {_topic_sql(_TEXT)} as topic from t""",
    "staged_types": f"select seq, {_STAGED} as article_type from normalized_item",
    "raw_richness": f"select i.seq, coalesce(len(i.tags), 0) + coalesce(len(f.tags), 0) as n_tags, {_RICH.replace('{tags}', 'coalesce(len(i.tags), 0) + coalesce(len(f.tags), 0)')} as richness from normalized_item i left join feed_config f on i.feed_url = f.url",
    "freshness_walk": f"""with p as (select seq, {_FULL.format('published_at')} as p, {_FULL.format('updated_at')} as u, coalesce(nullif(nullif(date_source, 'unknown'), 'none'), '') as s, fetched_at as f, freshness_confidence as c, used_fallback_date as b from normalized_item),
        d as (select *, case when s <> '' then s when p is not null then 'published_at' when u is not null then 'updated_at' else 'fetched_at' end as source from p)
        select seq, source as date_source, p is null and coalesce(p, u, cast(f as varchar)) is not null as used_fallback, coalesce(nullif(c, ''), case source when 'published_at' then 'high' when 'updated_at' then 'medium' else 'low' end) as confidence,
        case when u is not null then 'updated_at' when f is not null then 'fetched_at' else 'unknown' end as walked, case when u is not null then 'medium' else 'low' end as walk_confidence from d""",
    "age_cutoff": f"""with s as (select id, cast(published_date as timestamp) as p, cast(substr(first_seen_at, 1, 10) as timestamp) as f from selection_history)
        select id, coalesce(p between timestamp '{AS_OF}' - interval 7 day and timestamp '{AS_OF}', false) as in_default_range, coalesce(abs(epoch_us(p) - epoch_us(f)) <= 7 * 86400000000, true) as is_close from s where p is null or p >= timestamp '{AS_OF}' - interval {LOOKBACK_DAYS} day""",
    "novelty_split": rf"""with {_match_cte()}, j as (select n.item_id, m.hit.m as match, h.times_emitted as te, n.content_fingerprint <> h.content_fingerprint as ch,
        case when regexp_matches(h.last_emitted_at, '^\d{{4}}-\d{{2}}-\d{{2}}T\d{{2}}:\d{{2}}:\d{{2}}\+00:00$') then floor((epoch_us(timestamp '{AS_OF}') - epoch_us(cast(substr(h.last_emitted_at, 1, 19) as timestamp))) / 86400000000.0) end as d
        from incoming_item n left join m on m.item_id = n.item_id left join history h on h.id = m.hit.m), s as (select *, {_STATE} as novelty from j)
        select item_id, novelty, novelty = 'previously_emitted' as suppressed, match is not null as is_previously_seen, coalesce(te > 0, false) as is_previously_emitted, case when match is not null then '{AS_OF}' end as previous_last_seen_at from s""",
    "selection_novelty": f"""with i as ({_selection_keys('incoming_item', 'item_id', 'doi', 'canonical_url', 'content_fingerprint')}), s as ({_selection_keys('selection_history', 'id', 'doi', 'url', 'fingerprint')}),
        m as (select i.id as item_id, min(struct_pack(p := i.p, m := s.id)) as hit from i join s on i.p = s.p and i.k = s.k and i.k <> '' group by i.id),
        d as (select n.item_id, m.hit.p as p, s.id as sid, {', '.join(f"cast(floor((epoch_us(timestamp '{AS_OF}') - epoch_us(cast(substr(s.{c}, 1, 19) as timestamp))) / 86400000000.0) as bigint) as {a}" for c, a in (('first_seen_at', 'f'), ('emitted_at', 'e')))} from incoming_item n left join m on m.item_id = n.item_id left join selection_history s on s.id = m.hit.m)
        select item_id, case when sid is null then 'new' when e is not null then 'emitted' else 'seen' end as status, f as seen_days, e as emitted_days, coalesce(case when e is not null then e < {ALLOW_AFTER_DAYS} else f < {ALLOW_AFTER_DAYS} end, false) as suppressed, cast(p as bigint) as match_priority from d""",
    "published_marks": f"select id, case when impact_score >= 7 then '{AS_OF}' else emitted_at end as marked, emitted_at from selection_history",
    "ingest_summary": f"""with r as (select *, (trim(coalesce(title, '')) <> '' or trim(coalesce(canonical_url, '')) <> '') and not regexp_matches(lower(coalesce(title, '')), '{score.CORRECTION}') and (fetched_at is null or fetched_at >= timestamp '{AS_OF}' - interval {LOOKBACK_DAYS} day) as ok from normalized_item),
        b as (select lower(trim(dedupe_key)) as key, content_fingerprint as p from r where ok qualify row_number() over (partition by lower(trim(dedupe_key)) order by {_RICH.replace('{tags}', 'coalesce(len(tags), 0)')} desc, seq) = 1),
        j as (select h.times_emitted as te, b.p <> h.content_fingerprint as ch, null::double as d from b left join history h on h.dedupe_key = b.key), s as (select *, {_STATE} as novelty from j)
        select (select count(*) from r) as raw_items, (select count(*) from r where ok) as after_normalization, (select count(*) from r where not ok) as dropped, count(*) as after_dedupe, count(te) as previously_seen, count(*) filter (te > 0) as previously_emitted,
        count(*) filter (novelty = 'new') as novel, count(*) filter (novelty = 'previously_emitted') as suppressed, count(*) filter (novelty = 'updated_existing_item') as updated from s""",
    "evidence_next": f"""with o as (select canonical_url as article_id, min(title) as evidence, min(first_seen_at) as created_at, min(last_seen_at) as updated_at from history where canonical_url <> '' group by 1),
        n as (select canonical_url as article_id, array_to_string(list_filter([nullif(title, ''), nullif(doi, ''), nullif(pmid, ''), nullif(summary, '')], lambda x: x is not null), ' ') as evidence from incoming_item where canonical_url <> '' qualify row_number() over (partition by canonical_url order by item_id desc) = 1)
        select coalesce(o.article_id, n.article_id) as article_id, coalesce(o.created_at, '{AS_OF}') as created_at, coalesce(n.evidence, o.evidence) as evidence, case when n.article_id is not null then '{AS_OF}' else o.updated_at end as updated_at from o full join n on o.article_id = n.article_id""",
    "selection_diagnostics": f"""with k as (select *, {_STAGED} as kind from normalized_item), f as (select *, kind = 'registry_report' as a, coalesce(quality_score, 0) < 4 as b, trim(coalesce(published_at, '')) = '' as c from k),
        e as (select 'flag:suppressed_type' as name from f where a union all select 'flag:below_floor' from f where b union all select 'flag:missing_date' from f where c union all select 'flag:main' from f where quality_score >= 8 union all select 'flag:quick' from f where quality_score between 4 and 8
        union all select 'total' from f union all select 'source:' || coalesce(source_type, 'unknown') from f union all select 'reason:' || case when a then 'article type is excluded:' when b then 'quality score is below' else 'no date of publication' end from f where a or b or c) select name, count(*) as n from e group by 1""",
    "trends": f"select topic, count(*) as n, count(distinct feed_url) as n_sources, min(seq) as first_seq from (select *, {_topic_sql(_TEXT)} as topic from normalized_item) group by 1 order by n desc, first_seq limit 3",
    "issue_durations": "select run_id, 180 * n_main + 20 * n_quick as seconds, n_main, n_quick from (select run_id, count(*) filter (quality_score >= 8) as n_main, count(*) filter (quality_score >= 4 and quality_score < 8) as n_quick from normalized_item group by 1)",
    "ranked_scores": "select seq, coalesce(quality_score, -1.0) as score, row_number() over (order by coalesce(quality_score, -1.0) desc, seq) as rank from normalized_item",
    "newest_items": """select seq, strftime(fetched_at, '%Y-%m-%d %H:%M:%S') as "at" from normalized_item order by 2 desc, seq limit 100""",
    "capped_again": """with b as (select f.url as feed_url, count(*) as n from selection_history s join feed_config f on s.source = f.name group by 1), r as (select seq, i.feed_url, coalesce(quality_score, -1.0) as score, row_number() over (partition by i.feed_url order by coalesce(quality_score, -1.0) desc, seq) + coalesce(b.n, 0) as rn from normalized_item i left join b on i.feed_url = b.feed_url)
        select seq, feed_url, score from r where rn <= 40 order by score desc, seq limit 50""",
    "topic_summaries": f"""with l as (select run_id, seq, coalesce(nullif({_topic_sql("lower(coalesce(title, ''))")}, 'general'), nullif(substr(coalesce(title, ''), 1, 80), '')) as label from normalized_item),
        f as (select run_id, label, min(seq) as s from l where label is not null group by 1, 2 qualify row_number() over (partition by run_id order by min(seq)) <= 8) select run_id, string_agg(label, chr(10) order by s) as summary from f group by 1""",
    "article_blocks": rf"""select count(*) as n_articles, count(nullif({strip_sql("regexp_replace(source_name, '[\r\n]+', ' ', 'g')")}, '')) as n_sources, count(nullif({strip_sql(f"array_to_string({_NAMES}, ', ')")}, '')) as n_authors, count(fetched_at) as n_dated,
        cast(sum(length(regexp_replace(coalesce(content_snippet, ''), '\s+$', ''))) as bigint) as n_chars from normalized_item""",
}
QUERIES = {f.__name__: f for f in (article_ids, display_fields, heuristic_types, staged_types, raw_richness, freshness_walk, age_cutoff, novelty_split, selection_novelty, published_marks, ingest_summary, evidence_next, selection_diagnostics, trends, issue_durations, ranked_scores, newest_items, capped_again, topic_summaries, article_blocks, cap_audit, first_titles, overlaid_metadata, stored_items, stored_versions)}
