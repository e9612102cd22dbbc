"""Queries over texts: scores, labels, topics, claims, sections, and the flagship issue."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedloom.functions import dates, text
from feedloom.operators import profile, ranking, score, verify
from feedloom.plans.ingest import as_of, items, strip_sql
from feedloom.session import load

# Parameters: what these queries look for in the articles.
WEIGHTS = {"embryo": 4.0, "transfer": 3.0, "sperm": 2.5, "pregnancy": 2.0, "registry": 1.5, "endometrial": 1.0, "vitamin": 0.5}
BUCKETS = {"treatment": ["embryo transfer", "ivf", "letrozole"], "diagnosis": ["endometri", "polycystic"], "mind": ["anxiety", "stress"]}
TOPICS = {"embryology": ["embryo", "blastocyst", "incubation"], "andrology": ["sperm", "azoospermia"], "outcomes": ["pregnancy", "birth", "miscarriage"], "access": ["costs", "cost", "insurance"], "mental": ["anxiety"]}
PRIORITY = ["outcomes", "embryology"]
PENALTIES = {"saved search": -2.0, "in brief": -1.0, "reposted": -1.5, "cookies": -3.0}
PHRASES = ["said", "a point that", "in line with the", "dispute", "as the", "trial registration"]
WORDING = ["published in {}", "appearing in {}", "reported by {}", "carried by {}", "from {}", "featured in {}"]
SUBJECTS = [(r"^The authors\b", "Authors writing"), (r"^The confidence interval\b", "An interval"), (r"^Investigators\b", "Investigators reporting"), (r"^Interviews\b", "Interviews"), (r"^Data\b", "Data"), (r"^Costs\b", "Costs")]


def _body(df: DataFrame) -> DataFrame:
    return df.withColumn("body", F.concat_ws(" ", F.coalesce("title", F.lit("")), F.coalesce("content_snippet", F.lit("")))).withColumn("n_chars", F.length(F.coalesce("content_snippet", F.lit(""))))


def article_types(spark: SparkSession, sf: str) -> DataFrame:
    docs = load(spark, sf, "documents")
    return docs.select("doc_id", score.first_match(F.col("text"), score.TITLE_TYPES, "unknown").alias("article_type"))


def impact_scores(spark: SparkSession, sf: str) -> DataFrame:
    df = _body(items(spark, sf).select("seq", "title", "content_snippet", "fetched_at"))
    rigour, rel = score.rigour(F.col("body"), F.col("n_chars")), score.relevance(F.col("body"), WEIGHTS, BUCKETS)
    age = dates.whole_days(F.col("fetched_at"), as_of())
    return df.select("seq", F.round(rigour, 6).alias("rigour"), F.round(rel, 6).alias("relevance"), F.round(score.impact(rigour, rel, F.lit(1), F.col("n_chars"), age), 6).alias("impact"), F.round(score.hits(F.concat_ws(" ", F.coalesce("title", F.lit("")), F.substring(F.coalesce("content_snippet", F.lit("")), 1, 300)), PENALTIES), 6).alias("penalty"))


def topic_assignment(spark: SparkSession, sf: str) -> DataFrame:
    t = score.topics(F.col("body"), TOPICS, PRIORITY)
    return _body(items(spark, sf).select("seq", "title", "content_snippet")).select("seq", t.alias("t")).select("seq", F.col("t.primary").alias("topic"), F.array_join("t.others", ",").alias("others"))


def text_quality(spark: SparkSession, sf: str) -> DataFrame:
    return load(spark, sf, "documents").groupBy("doc_type", score.text_quality(F.length(F.coalesce("text", F.lit("")))).alias("quality")).agg(F.count("*").alias("n"))


def evidence_scores(spark: SparkSession, sf: str) -> DataFrame:
    has = lambda c: F.trim(F.coalesce(c, F.lit(""))) != ""
    some = lambda c: F.coalesce(F.size(c), F.lit(0)) > 0
    filled = {"population": has("language"), "sample_size": has("doi"), "study_design": has("pmid"), "intervention": some("tags"), "outcomes": some("authors"), "findings": has("summary"), "limitations": has("updated_at")}
    value = score.evidence_sufficiency(score.text_quality(F.length(F.coalesce("content_snippet", F.lit("")))), filled, F.size(text.numbers(F.col("summary"))) > 0)
    return items(spark, sf).select("seq", F.round(value, 6).alias("sufficiency"), F.when(value >= 0.5, "full").when(value >= 0.2, "short").otherwise("watch").alias("tier"))


def unsupported_numbers(spark: SparkSession, sf: str) -> DataFrame:
    bad = verify.unsupported_numbers(F.col("summary"), F.col("content_snippet"))
    return items(spark, sf).select("seq", F.array_join(bad, " ").alias("numbers"), F.size(bad).cast("bigint").alias("n"))


def claim_checks(spark: SparkSession, sf: str) -> DataFrame:
    made = verify.checks(F.col("content_snippet"), F.col("summary"), F.lit("original_research"), F.when(F.col("doi").isNull(), "low").otherwise("high"))
    each = items(spark, sf).select("seq", F.explode(made).alias("c"))
    return each.groupBy("c.rule").agg(F.count("*").alias("n"), F.count_if("c.passed").alias("n_passed"))


def sentence_labels(spark: SparkSession, sf: str) -> DataFrame:
    made = verify.labelled_sentences(F.col("content_snippet"), F.col("summary"), F.col("title"), F.lit(""))
    return items(spark, sf).select("seq", F.posexplode(made).alias("place", "s")).select("seq", F.col("place").cast("bigint").alias("place"), "s.label", "s.rule")


def filtered_texts(spark: SparkSession, sf: str) -> DataFrame:
    made = verify.labelled_sentences(F.col("content_snippet"), F.col("summary"), F.col("title"), F.lit(""))
    return items(spark, sf).select("seq", verify.filtered(F.col("content_snippet"), made).alias("text"))


def generic_summaries(spark: SparkSession, sf: str) -> DataFrame:
    why = verify.generic_reasons(F.col("title"), F.col("content_snippet"), F.col("summary"), F.lit(False))
    return items(spark, sf).select("seq", F.explode(why).alias("reason"))


def repeated_phrases(spark: SparkSession, sf: str) -> DataFrame:
    return profile.repeated_phrases(items(spark, sf), F.col("content_snippet"), PHRASES, 0.35)


def grouped_openings(spark: SparkSession, sf: str) -> DataFrame:
    df = profile.grouped_openings(items(spark, sf).select("seq", "summary"), text.prefix_key(F.col("summary")))
    return df.select("seq", "is_grouped")


def attributed_openings(spark: SparkSession, sf: str) -> DataFrame:
    df = items(spark, sf).filter("summary is not null and summary != ''")
    return df.select("seq", text.attributed(text.first_sentences(F.col("summary"), 1), F.col("source_name"), F.col("seq"), WORDING, SUBJECTS).alias("opening"))


def title_overlaps(spark: SparkSession, sf: str) -> DataFrame:
    a, b = text.tokens(F.col("title")), text.tokens(F.col("content_snippet"))
    return items(spark, sf).select("seq", F.round(text.overlap(a, b), 6).alias("overlap"), F.round(text.containment(b, a), 6).alias("contained"))


def source_families(spark: SparkSession, sf: str) -> DataFrame:
    return items(spark, sf).groupBy(text.source_family(F.col("source_name")).alias("family")).agg(F.count("*").alias("n"))


def capped_top(spark: SparkSession, sf: str) -> DataFrame:
    df = items(spark, sf).select("seq", "feed_url", F.coalesce("quality_score", F.lit(-1.0)).alias("score"))
    return ranking.capped_top(df, "feed_url", [F.desc("score"), F.asc("seq")], 3, 50)


def tier_overflow(spark: SparkSession, sf: str) -> DataFrame:
    tier = F.when(F.col("quality_score") >= 8, "featured").when(F.col("quality_score") >= 4, "brief").otherwise("watch")
    df = items(spark, sf).select("seq", "quality_score", tier.alias("tier"))
    return ranking.overflow(df, "seq", "tier", [F.desc("quality_score"), F.asc("seq")], 5, "featured", "watch").groupBy("tier").agg(F.count("*").alias("n"), F.sum("seq").alias("seq_sum"))


def selection_history_windows(spark: SparkSession, sf: str) -> DataFrame:
    """Extension: emissions by month of the first sighting."""
    sel = load(spark, sf, "selection_history")
    return sel.groupBy(F.substring("first_seen_at", 1, 7).alias("month")).agg(F.count("*").alias("n"), F.count("emitted_at").alias("n_emitted"), F.round(F.avg("impact_score"), 6).alias("mean_impact"))


def hourly_events(spark: SparkSession, sf: str) -> DataFrame:
    """Extension: tumbling windows over the event table."""
    w = load(spark, sf, "events").groupBy(F.date_format(F.date_trunc("hour", "ts"), "yyyy-MM-dd HH:mm:ss").alias("hour"), "event_type")
    return w.agg(F.count("*").alias("n"), F.round(F.sum("value"), 4).alias("total"))


def _scored(spark: SparkSession, sf: str) -> DataFrame:
    df = _body(items(spark, sf).select("seq", "title", "content_snippet", "fetched_at", "feed_url", "source_name", "quality_score"))
    rigour, rel = score.rigour(F.col("body"), F.col("n_chars")), score.relevance(F.col("body"), WEIGHTS, BUCKETS)
    age = dates.whole_days(F.col("fetched_at"), as_of())
    t = score.topics(F.col("body"), TOPICS, PRIORITY)
    return df.select("seq", "title", "source_name", "feed_url", t["primary"].alias("topic"), score.first_match(F.col("title"), score.TITLE_TYPES, "unknown").alias("article_type"), F.round(score.impact(rigour, rel, F.lit(1), F.col("n_chars"), age) + score.hits(F.col("body"), PENALTIES), 6).alias("score"))


def ordered_selection(spark: SparkSession, sf: str) -> DataFrame:
    """Main and quick roles in one ordered pass under caps of feed and topic; tests compare it with a plain loop."""
    df = _scored(spark, sf).select("seq", "score", "feed_url", "topic", (F.col("score") >= 8).alias("is_main"), (F.col("score") >= 4).alias("is_quick"))
    return ranking.select_ordered(df, "seq", "score", {"feed_url": 2, "topic": 6}, [("main", "is_main", 8), ("quick", "is_quick", 15)])


def flagship(spark: SparkSession, sf: str) -> DataFrame:
    """The ranked issue: scored, typed, with topics, at most three articles of a feed."""
    return ranking.capped_top(_scored(spark, sf), "feed_url", [F.desc("score"), F.asc("seq")], 3, 30)


def _hits_sql(x: str, weights: dict[str, float]) -> str:
    return "(0.0::double" + "".join(f" + case when contains({x}, '{k}') then {w!r}::double else 0.0::double end" for k, w in weights.items()) + ")"


def _any_sql(x: str, words: list[str]) -> str:
    return "(" + " or ".join(f"contains({x}, '{w}')" for w in words) + ")"


_BODY = "with b as (select *, lower(coalesce(title, '') || ' ' || coalesce(content_snippet, '')) as body, length(coalesce(content_snippet, '')) as n_chars from normalized_item)"
_RIGOUR = "least(" + _hits_sql("body", dict.fromkeys(score.RIGOUR, 1.5)) + " + case when n_chars > 1000 then 2.0::double when n_chars > 400 then 0.5::double else 0.0::double end, 10.0::double)"
_RELEVANCE = "least(" + _hits_sql("body", {k: w * 0.3 for k, w in WEIGHTS.items()}) + " + (0.0::double" + "".join(f" + case when {_any_sql('body', w)} then 1.0::double else 0.0::double end" for w in BUCKETS.values()) + "), 10.0::double)"
_AGE = "floor((epoch_us(timestamp '2026-01-01 00:00:00') - epoch_us(fetched_at)) / 86400000000.0)"
_IMPACT = f"0.4::double * {_RIGOUR} + 0.6::double * {_RELEVANCE} + 2.0::double + case when n_chars > 300 then 1.0::double else 0.0::double end + case when {_AGE} <= 1 then 2.0::double when {_AGE} <= 3 then 1.0::double else 0.0::double end"
_WORD = r"(case when regexp_matches(body, '(^|[^\p{L}\p{N}_])" + "{0}" + r"($|[^\p{L}\p{N}_])') then 1 else 0 end)"
_TOPICS = "[" + ", ".join(f"struct_pack(minus := -({' + '.join(_WORD.replace('{0}', w) for w in words)}), rank := {PRIORITY.index(n) if n in PRIORITY else 9999}, place := {k}, topic := '{n}')" for k, (n, words) in enumerate(TOPICS.items())) + "]"
_TYPE = "case " + " ".join(f"when regexp_matches(lower(coalesce({{c}}, '')), '{p}') then '{label}'" for p, label in score.TITLE_TYPES).replace("{c}", "text").replace("editor.?s note", "editor.?s note") + " else 'unknown' end"
# every letter counts as one for the word boundary, not only those of ASCII
_NUMBERS = r"list_distinct(regexp_extract_all(regexp_replace(coalesce({0}, ''), '\p{L}', 'x', 'g'), '\b\d+(?:[.,]\d+)?%?\b'))"
_TOKENS = r"list_distinct(regexp_extract_all(lower(coalesce({0}, '')), '[\p{L}\p{N}_]{{1},}'))"
_SENTENCES = r"list_filter(list_transform(string_split(regexp_replace(coalesce({0}, ''), '([.!?])\s+', '\1' || chr(1), 'g'), chr(1)), lambda s: " + strip_sql("s") + r"), lambda s: s <> '')"
_HEADERS = r"regexp_replace(content_snippet, '\*\*[^*]+\*\*:\s*', '', 'g')"


def _tokens_sql(c: str, least: int = 4) -> str:
    return _TOKENS.replace("{0}", c).replace("{1}", str(least))


def _phrases_sql(c: str, phrases: list[str]) -> str:
    return "list_filter([" + ", ".join(f"'{p}'" for p in phrases) + f"], lambda p: contains(lower(coalesce({c}, '')), p))"


def _except_sql(a: str, b: str) -> str:
    return f"list_filter({a}, lambda x: not list_contains({b}, x))"


_LABELS = f"""with s as (select seq, title, summary, unnest({_SENTENCES.replace('{0}', _HEADERS)}) as s, generate_subscripts({_SENTENCES.replace('{0}', _HEADERS)}, 1) - 1 as place from normalized_item),
    l as (select seq, place, case when len({_except_sql(_NUMBERS.replace('{0}', 's'), _NUMBERS.replace('{0}', 'summary'))}) > 0 then 'number' when len({_except_sql(_phrases_sql('s', verify.DESIGNS), _phrases_sql('summary', verify.DESIGNS))}) > 0 then 'design'
    when coalesce(title, '') <> '' and coalesce(len(list_intersect({_tokens_sql('s', 3)}, {_tokens_sql('title', 3)})) / nullif(len({_tokens_sql('title', 3)}), 0), 0.0) >= 0.60 then 'finding' else 'unverified' end as rule, s from s)"""
_LABEL = "case rule when 'number' then 'unsupported' when 'design' then 'unsupported' when 'finding' then 'supported' else 'weakly_supported' end"

_SCORED = f"""{_BODY}, z as (select *, list_transform(list_sort(list_filter({_TOPICS}, lambda e: e.minus < 0)), lambda e: e.topic) as t from b),
    s as (select seq, title, source_name, feed_url, coalesce(t[1], 'general') as topic, {_TYPE.replace("coalesce(text, '')", "coalesce(title, '')")} as article_type, round({_IMPACT} + {_hits_sql("body", PENALTIES)}, 6) as score from z)"""

SQL = {
    "flagship_issue": f"{_SCORED} select * exclude rn from (select *, row_number() over (partition by feed_url order by score desc, seq) as rn from s) where rn <= 3 order by score desc, seq limit 30",
    "article_types": f"select doc_id, {_TYPE} as article_type from documents",
    "impact_scores": f"""{_BODY} select seq, round({_RIGOUR}, 6) as rigour, round({_RELEVANCE}, 6) as relevance, round({_IMPACT}, 6) as impact, round({_hits_sql("lower(coalesce(title, '') || ' ' || substr(coalesce(content_snippet, ''), 1, 300))", PENALTIES)}, 6) as penalty from b""",
    "topic_assignment": f"{_BODY}, t as (select seq, list_transform(list_sort(list_filter({_TOPICS}, lambda e: e.minus < 0)), lambda e: e.topic) as t from b) select seq, coalesce(t[1], 'general') as topic, coalesce(array_to_string(t[2:3], ','), '') as others from t",
    "text_quality": "select doc_type, case when n < 300 then 'snippet_only' when n < 2000 then 'abstract' else 'full_text' end as quality, count(*) as n from (select doc_type, length(coalesce(text, '')) as n from documents) group by 1, 2",
    "evidence_scores": f"""with f as (select seq, length(coalesce(content_snippet, '')) as n, trim(coalesce(language, '')) <> '' as a, trim(coalesce(doi, '')) <> '' as b, trim(coalesce(pmid, '')) <> '' as c, coalesce(len(tags), 0) > 0 as d, coalesce(len(authors), 0) > 0 as e, trim(coalesce(summary, '')) <> '' as f, trim(coalesce(updated_at, '')) <> '' as g, len({_NUMBERS.replace('{0}', 'summary')}) > 0 as h from normalized_item),
        v as (select seq, least(0.0::double + case when n < 300 then 0.0::double when n < 2000 then 0.30::double else 0.50::double end + case when a then 0.05::double else 0 end + case when b then 0.10::double else 0 end + case when c then 0.05::double else 0 end + case when d then 0.05::double else 0 end + case when e then 0.05::double else 0 end + case when f then 0.10::double else 0 end + case when f and h then 0.05::double else 0 end + case when g then 0.05::double else 0 end, 1.0::double) as v from f)
        select seq, round(v, 6) as sufficiency, case when v >= 0.5 then 'full' when v >= 0.2 then 'short' else 'watch' end as tier from v""",
    "unsupported_numbers": f"select seq, array_to_string(x, ' ') as numbers, len(x) as n from (select seq, list_sort({_except_sql(_NUMBERS.replace('{0}', 'summary'), _NUMBERS.replace('{0}', 'content_snippet'))}) as x from normalized_item)",
    "claim_checks": f"""with c as (select unnest([struct_pack(rule := 'numbers', ok := len({_except_sql(_NUMBERS.replace('{0}', 'content_snippet'), _NUMBERS.replace('{0}', 'summary'))}) = 0), struct_pack(rule := 'designs', ok := len({_except_sql(_phrases_sql('content_snippet', verify.DESIGNS), _phrases_sql('summary', verify.DESIGNS))}) = 0),
        struct_pack(rule := 'causal', ok := not (len({_phrases_sql('content_snippet', verify.CAUSAL)}) > 0 and doi is null)), struct_pack(rule := 'inference', ok := len({_except_sql(_phrases_sql('content_snippet', verify.SPECULATIVE), _phrases_sql('summary', verify.SPECULATIVE))}) = 0 or doi is not null)]) as c from normalized_item)
        select c.rule as rule, count(*) as n, count(*) filter (c.ok) as n_passed from c group by 1""",
    "sentence_labels": f"{_LABELS} select seq, place, {_LABEL} as label, rule from l",
    "filtered_texts": f"""{_LABELS}, g as (select seq, list(s) as good from l where {_LABEL} <> 'unsupported' group by seq), k as (select i.seq, i.content_snippet, list_filter({_SENTENCES.replace('{0}', 'i.content_snippet')}, lambda s: list_contains(coalesce(g.good, []), s)) as kept from normalized_item i left join g on i.seq = g.seq)
        select seq, case when len(kept) > 0 then array_to_string(kept, ' ') else content_snippet end as text from k""",
    "generic_summaries": f"""with t as (select seq, {_tokens_sql('title')} as a, {_tokens_sql('content_snippet')} as b, lower(coalesce(content_snippet, '')) as f, lower(coalesce(summary, '')) as m from normalized_item)
        select seq, reason from (select seq, unnest([case when len(a) > 0 and len(b) > 0 and len(list_intersect(a, b)) / greatest(len(a), len(b)) >= 0.65 then 'restates_title' end, case when {_any_sql('m', verify.GENERIC)} then 'generic_relevance' end, case when {_any_sql('f', verify.NO_FINDING)} then 'no_finding' end, case when trim(f) = '' then 'empty_finding' end]) as reason from t) where reason is not null""",
    "repeated_phrases": "select phrase, n from (select unnest([" + ", ".join(f"struct_pack(phrase := '{p}', n := count(*) filter (contains(lower(coalesce(content_snippet, '')), '{p}')), rows := count(*))" for p in PHRASES) + "], recursive := true) from normalized_item) where n >= greatest(2, floor(rows * 0.35))",
    "grouped_openings": "with k as (select seq, nullif(lower(trim(substr(coalesce(summary, ''), 1, 60))), '') as k from normalized_item) select seq, coalesce(n >= 3, false) as is_grouped from k left join (select k as g, count(*) as n from k where k is not null group by k) on k = g",
    "attributed_openings": f"""with o as (select seq, {_SENTENCES.replace('{0}', 'summary')}[1] as o, replace([{', '.join(f"'{w}'" for w in WORDING)}][cast((seq - 1) % {len(WORDING)} + 1 as bigint)], '{{}}', coalesce(nullif(source_name, ''), 'the journal')) as src from normalized_item where summary is not null and summary <> '')
        select seq, coalesce({', '.join(f"case when regexp_matches(coalesce(o, ''), '(?i){p}') then '{noun} ' || src || regexp_replace(o, '(?i){p}', '') end" for p, noun in SUBJECTS)}, 'A study ' || src || ': ' || lower(substr(coalesce(o, ''), 1, 1)) || substr(coalesce(o, ''), 2)) as opening from o""",
    "title_overlaps": f"with t as (select seq, {_tokens_sql('title')} as a, {_tokens_sql('content_snippet')} as b from normalized_item) select seq, round(coalesce(len(list_intersect(a, b)) / nullif(greatest(len(a), len(b)), 0), 0.0), 6) as overlap, round(coalesce(len(list_intersect(a, b)) / nullif(len(a), 0), 0.0), 6) as contained from t",
    "source_families": r"select lower(trim(regexp_replace(coalesce(source_name, ''), '\s+[-–—]\s+.*', ''))) as family, count(*) as n from normalized_item group by 1",
    "capped_top": "select seq, feed_url, score from (select seq, feed_url, coalesce(quality_score, -1.0) as score, row_number() over (partition by feed_url order by coalesce(quality_score, -1.0) desc, seq) as rn from normalized_item) where rn <= 3 order by score desc, seq limit 50",
    "tier_overflow": """with t as (select seq, quality_score, case when quality_score >= 8 then 'featured' when quality_score >= 4 then 'brief' else 'watch' end as tier from normalized_item), r as (select *, row_number() over (partition by tier order by quality_score desc, seq) as rn from t)
        select case when tier = 'featured' and rn > 5 then 'watch' else tier end as tier, count(*) as n, cast(sum(seq) as bigint) as seq_sum from r group by 1""",
    "selection_history_windows": "select substr(first_seen_at, 1, 7) as month, count(*) as n, count(emitted_at) as n_emitted, round(avg(impact_score), 6) as mean_impact from selection_history group by 1",
    "hourly_events": "select strftime(date_trunc('hour', ts), '%Y-%m-%d %H:%M:%S') as hour, event_type, count(*) as n, round(sum(value), 4) as total from events group by 1, 2",
}
QUERIES = {f.__name__: f for f in (article_types, impact_scores, topic_assignment, text_quality, evidence_scores, unsupported_numbers, claim_checks, sentence_labels, filtered_texts, generic_summaries, repeated_phrases, grouped_openings, attributed_openings, title_overlaps, source_families, capped_top, tier_overflow, selection_history_windows, hourly_events, ordered_selection)} | {"flagship_issue": flagship}
