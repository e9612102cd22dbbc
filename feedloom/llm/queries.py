"""The queries of this package: whole tables, production parameters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedloom.llm import batchdedup, bpe, caps, langid, leakage, neardup, survivor, truncation
from feedloom.llm.common import load


def _near(spark: SparkSession, sf: str) -> neardup.NearDuplicates:
    return neardup.NearDuplicates(load(spark, sf, "normalized_item"), "seq", ["title", "content_snippet"], 0.7)


def p4_found(spark: SparkSession, sf: str) -> DataFrame:
    return _near(spark, sf).pairs()


def p4_groups(spark: SparkSession, sf: str) -> DataFrame:
    return _near(spark, sf).groups().withColumnRenamed("id", "seq")


def batch_tables(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame, set[str]]:
    """What has been accepted, the new items, and the names of the places that carry articles (a dimension: configured)."""
    places = load(spark, sf, "contributor").select("name").union(load(spark, sf, "feed_config").select("name")).distinct()
    known = {batchdedup.name_of(r.name) for r in places.toLocalIterator() if r.name}
    old = batchdedup.rows_of(load(spark, sf, "history"), "history", "id", "dedupe_key", "doi", "pmid", "content_fingerprint", "canonical_url", "title")
    old = old.unionByName(batchdedup.rows_of(load(spark, sf, "selection_history"), "selection_history", "id", None, "doi", "pmid", "fingerprint", "url", "title"))
    new = batchdedup.rows_of(load(spark, sf, "incoming_item"), "incoming_item", "item_id", "dedupe_key", "doi", "pmid", "content_fingerprint", "canonical_url", "title")
    return old, new, known


def p5_found(spark: SparkSession, sf: str) -> DataFrame:
    return batchdedup.repeats(*batch_tables(spark, sf))


def p6_found(spark: SparkSession, sf: str) -> DataFrame:
    """The rows beyond 10 of each run and contributor in normalized_item, and beyond 3 in selection_history."""
    tables = [("normalized_item", "seq", "canonical_url", "source_name", "quality_score", 10), ("selection_history", "id", "url", "source", "impact_score", 3)]
    rows = [(load(spark, sf, table).select(row_id, url, name, score, "run_id"), url, name) for table, row_id, url, name, score, _ in tables]
    out = []
    for df, (table, row_id, _, _, score, cap) in zip(caps.with_contributor(rows, load(spark, sf, "contributor"), load(spark, sf, "feed_config")), tables):
        df = df.withColumn("grp", F.when(F.col("contributor_id").isNotNull(), F.concat_ws("|", F.col("contributor_id").cast("string"), F.when(F.col("run_id").isNull(), "n").otherwise(F.concat(F.lit("r"), "run_id")))))
        out.append(caps.beyond_cap(df, "grp", score, row_id, cap).select(F.lit(table).alias("source_table"), F.col(row_id).alias("row_id")))
    return out[0].unionByName(out[1])


def p7_ids(spark: SparkSession, sf: str) -> DataFrame:
    return bpe.encode(load(spark, sf, "documents"), "doc_id", "text")


def p1_found(spark: SparkSession, sf: str) -> DataFrame:
    return survivor.survivors(load(spark, sf, "normalized_item"), load(spark, sf, "feed_config"))


def p3_found(spark: SparkSession, sf: str) -> DataFrame:
    found = truncation.truncated(load(spark, sf, "normalized_item"), "seq", "feed_url", ["summary", "content_snippet"])
    return found.select(F.col("row_id").alias("seq"), "field_name")


def p3_source_report(spark: SparkSession, sf: str) -> DataFrame:
    return truncation.report(load(spark, sf, "normalized_item"), "seq", "feed_url", ["summary", "content_snippet"])


def _leaks(spark: SparkSession, sf: str) -> DataFrame:
    return leakage.leaks(load(spark, sf, "documents"), "doc_id", "text", load(spark, sf, "eval_item"), "item_id", "passage", "prompt", "answer")


def p8_found(spark: SparkSession, sf: str) -> DataFrame:
    return _leaks(spark, sf).select("doc_id", "item_id")


def p8_items(spark: SparkSession, sf: str) -> DataFrame:
    return leakage.item_report(_leaks(spark, sf))


def p9_found(spark: SparkSession, sf: str) -> DataFrame:
    return langid.corrected(load(spark, sf, "documents"), "doc_id", "text", "lang").select("doc_id", "lang")


def p9_segments(spark: SparkSession, sf: str) -> DataFrame:
    docs = load(spark, sf, "documents")
    return langid.segments(docs, "doc_id", "text", langid.fit(docs, "doc_id", "text", "lang"))


QUERIES = {"p1_found": p1_found, "p3_found": p3_found, "p3_source_report": p3_source_report, "p4_found": p4_found, "p4_groups": p4_groups, "p5_found": p5_found, "p6_found": p6_found, "p7_ids": p7_ids, "p8_found": p8_found, "p8_items": p8_items, "p9_found": p9_found, "p9_segments": p9_segments}

# Contributors by host or exact name; the fixture's names without a host are exact.
_P6 = """
select '{table}' as source_table, {id} as row_id from (
  select r.{id}, row_number() over (partition by r.run_id, coalesce(h.contributor_id, n.contributor_id) order by r.{score} desc nulls last, r.{id}) as rn
  from (select *, regexp_extract(lower(trim({url})), '^[a-z]+://(?:www\\.|m\\.)?([^/:?#]+)', 1) as host from {table}) r
  left join contributor h on r.host = h.domain
  left join contributor n on h.contributor_id is null and lower(trim(r.{name})) = lower(n.name)
  where coalesce(h.contributor_id, n.contributor_id) is not null) where rn > {cap}"""
# Words without the entities and broken entities that the texts hold; pairs by the words they share, then the exact share.
_P4 = r"""
with t as (select seq, title || chr(10) || content_snippet as x from normalized_item where regexp_matches(title, '[^\s\x{85}\p{Z}]') and regexp_matches(content_snippet, '[^\s\x{85}\p{Z}]')),
 p as (select seq, regexp_replace(replace(replace(replace(replace(regexp_replace(x, '&hellip;', ' ', 'gi'), '&#82', 'R'), '&AMP;', '&'), '&Amp;', '&amp;'), '&amp;', '&'), '</?[A-Za-z!][^<>]*>', ' ', 'g') as x from t),
 w as (select distinct seq, unnest(regexp_extract_all(lower(x), '[\p{L}\p{N}]+')) as w from p),
 n as (select seq, count(*) as n from w group by seq),
 c as (select a.seq as seq_a, b.seq as seq_b, count(*) as c from w a join w b on a.w = b.w and a.seq < b.seq group by 1, 2)
select seq_a, seq_b, c / (x.n + y.n - c) as j from c join n x on x.seq = seq_a join n y on y.seq = seq_b where c / (x.n + y.n - c) >= 0.7 - 1e-9"""
# The groups of those pairs: the smallest record that one is linked to, and the different other texts that it is linked to.
_P4_GROUPS = f"""with recursive pairs as materialized (select * from ({_P4})), both_ways as (select seq_a as x, seq_b as y, j from pairs union all select seq_b, seq_a, j from pairs),
 reach(x, y) as (select x, y from both_ways union select r.x, b.y from reach r join both_ways b on b.x = r.y), roots as (select x, least(x, min(y)) as class_id from reach group by x),
 same as (select x, least(x, min(y)) as rep from both_ways where j > 1 - 1e-9 group by x), links as (select b.x, count(distinct coalesce(s.rep, b.y)) as links from both_ways b left join same s on s.x = b.y where b.j <= 1 - 1e-9 group by b.x)
 select r.x as seq, r.class_id, coalesce(l.links, 0) as links from roots r left join links l on l.x = r.x"""
# Letters and digits of texts and of all runs of 12 words; SQL has no compatibility forms, so ligatures and wide letters are named.
_P8 = r"""
with plain as (select doc_id, regexp_replace(regexp_replace(text, '([\p{L}\p{N}_])(?:</?[A-Za-z][^<>]*>|[*_`~]+)([\p{L}\p{N}_])', '\1\2', 'g'), '</?[A-Za-z!][^<>]*>', ' ', 'g') as t from documents where text is not null and text <> ''),
 folded as (select doc_id, regexp_replace(lower(replace(replace(replace(replace(replace(translate({WIDE}), 'ﬁ', 'fi'), 'ﬂ', 'fl'), 'ﬀ', 'ff'), 'ﬃ', 'ffi'), 'ﬄ', 'ffl')), '[^\p{L}\p{N}]', '', 'g') as t from plain),
 words as (select item_id, regexp_extract_all(lower(passage), '[\p{L}\p{N}]+') as w from eval_item where passage is not null),
 runs as (select item_id, list_transform(range(1, len(w) - 10), lambda k: array_to_string(w[k:k + 11], '')) as runs from words where len(w) >= 12)
select doc_id, item_id from folded, runs where len(list_filter(runs, lambda r: contains(t, r))) > 0""".replace("\\1\\2", "\1\2").replace("{WIDE}", "t, '" + "".join(chr(0xFF00 + k) for k in range(0x21, 0x7F) if chr(k).isalnum()) + "', '" + "".join(chr(k) for k in range(0x21, 0x7F) if chr(k).isalnum()) + "'")
SQL = {
    "p4_found": f"select seq_a, seq_b from ({_P4})",
    "p4_groups": _P4_GROUPS,
    "p8_found": _P8,
    "p6_found": _P6.format(table="normalized_item", id="seq", score="quality_score", url="canonical_url", name="source_name", cap=10) + "\nunion all\n" + _P6.format(table="selection_history", id="id", score="impact_score", url="url", name="source", cap=3),
}
