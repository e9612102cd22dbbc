"""Survivors against a plain reading of the statement, and the defined edge cases."""

from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from feedloom.llm import survivor
from feedloom.llm.truncation import verdict
from feedloom.operators.timestamps import to_utc_us

FEEDS = "feed_id bigint, url string, tz_name string, date_order string"
ITEMS = "seq bigint, feed_url string, dedupe_key string, doi string, summary string, authors array<string>, updated_at string, published_at string"


def feeds(spark):
    return spark.createDataFrame([(1, "f", "UTC", "dmy")], FEEDS)


def found(spark, rows, schema=ITEMS):
    return {r.group_seq: (r.doi, r.summary_seq, r.authors_seq) for r in survivor.survivors(spark.createDataFrame(rows, schema), feeds(spark)).collect()}


def test_groups_go_through_keys_and_identifiers(spark):
    rows = [
        (1, "f", " K1 ", None, "A whole text.", ["Ann Lee"], "2024-01-01T00:00:00Z", None),
        (2, "f", "k1", "https://doi-resolver.example/10.1234/AbC.", "A later text.", ["A. Lee", "Bo Ray"], "2024-02-01T00:00:00Z", None),
        (3, "f", "k2", "doi:10.1234/abc", "Cut in the mid", ["Staff"], "2025-01-01T00:00:00Z", None),
        (4, "f", "k3", "10.1234", "Alone.", None, None, None),
        (5, "f", "k4", "pending", "Alone.", [], None, None),
        (6, "f", "k5", "pending", "Alone.", [], None, None),
    ]
    assert found(spark, rows) == {1: ("10.1234/abc", 2, 2)}


def test_full_names_before_initials_and_repeats_do_not_count(spark):
    rows = [
        (1, "f", "k", None, "Text.", ["A. Lee", "B. Ray"], None, "2024-01-01"),
        (2, "f", "k", None, "Text.", ["Ann Lee", "Bo Ray et al."], None, "2024-01-01"),
        (3, "f", "k", None, "Text.", ["Ann Lee"] * 9, None, "2024-01-01"),
        (4, "f", "k", None, "Text.", ["Editorial team", None, ""], None, "2024-01-01"),
    ]
    assert found(spark, rows)[1] == ("", 1, 2)


def test_nulls_ties_repeats_empty_tables_and_long_texts(spark):
    rows = [
        (1, None, None, None, None, None, None, None),
        (2, None, "", "", "", [], "", ""),
        (3, "f", "k", None, "x" * 200_000 + ".", None, None, None),
        (4, "f", "k", None, "x" * 200_000 + ".", None, None, None),
        (5, "f", "k", None, None, None, None, None),
    ]
    assert found(spark, rows) == {3: ("", 3, None)}
    assert found(spark, []) == {}


def test_extra_columns_do_not_clash(spark):
    df = spark.createDataFrame([(1, "f", "k", None, "A.", ["Ann Lee"], None, None), (2, "f", "k", None, "A.", None, None, None)], ITEMS)
    for c in ("_grp", "root", "node", "votes", "value", "row", "src", "_doi"):
        df = df.withColumn(c, F.lit(1))
    assert survivor.survivors(df, feeds(spark)).count() == 1


def test_page_notices_are_no_texts(spark):
    rows = [(1, "f", "k", None, "By using Some Journal you agree that cookies may be kept.", None, "2025-01-01", None), (2, "f", "k", None, "The text.", None, "2024-01-01", None)]
    assert found(spark, rows)[1][1] == 2


def test_against_brute_force(spark, sf):
    items, conf = spark.read.parquet(f"{sf}/normalized_item.parquet"), spark.read.parquet(f"{sf}/feed_config.parquet")
    got = {r.group_seq: r for r in survivor.survivors(items, conf).collect()}
    at = to_utc_us(to_utc_us(items.join(conf.select(F.col("url").alias("feed_url"), "tz_name", "date_order"), "feed_url", "left"), "updated_at", "tz_name", "date_order", "u"), "published_at", "tz_name", "date_order", "p")
    rows = at.select("seq", "dedupe_key", survivor.bare_doi(F.col("doi")).alias("doi"), "summary", "authors", F.coalesce("u", "p").alias("at")).collect()
    parent = {}

    def top(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for r in rows:
        for k in ([("k", r.dedupe_key.strip().lower())] if r.dedupe_key else []) + ([("d", r.doi)] if r.doi else []):
            parent[top(("s", r.seq))] = top(k)
    groups = defaultdict(list)
    for r in rows:
        groups[top(("s", r.seq))].append(r)
    want = {min(r.seq for r in g): g for g in groups.values() if len(g) > 1}
    assert set(want) == set(got)
    for seq, g in want.items():
        assert got[seq].doi == max(r.doi for r in g)
        texts = [r for r in g if verdict(r.summary) == "whole" and not survivor._NOTICE.search(r.summary)]
        if texts:
            best = max(texts, key=lambda r: (r.at or -(2**62)))
            assert got[seq].summary_seq == min(r.seq for r in texts if r.summary.strip() == best.summary.strip())
        lists = [r for r in g if survivor.people(r.authors)[0]]
        if lists:
            best = max(survivor.people(r.authors)[:2] for r in lists)
            assert survivor.people(next(r for r in g if r.seq == got[seq].authors_seq).authors)[:2] == best


def test_copied_votes_count_less(spark):
    claims = [("summary", f"g{i}", "false", s, 10 * i + k, False) for i in range(6) for k, s in enumerate(("a", "copy"))]
    claims += [("summary", "x", "one", "a", 900, True), ("summary", "x", "one", "copy", 901, True), ("summary", "x", "two", "b", 902, True), ("summary", "x", "two", "c", 903, True)]
    claims += [("summary", f"h{i}", f"t{s}", s, 1000 + i, True) for i in range(6) for s in ("b", "c")]
    votes = {r.value: r.votes for r in survivor.fuse(spark.createDataFrame(claims, "field string, grp string, value string, src string, row bigint, possible boolean")).filter("grp = 'x'").collect()}
    assert votes["two"] > votes["one"]


@pytest.mark.parametrize("name, person", [("Ann B. Lee", ("lee", "ann", True)), ("A. Lee", ("lee", "a", False)), ("Lee, Ann", ("lee", "ann", True)), ("et al.", None), ("Staff", None), ("", None)])
def test_person(name, person):
    assert survivor._person(name) == person


def copied_dois():
    """Sources a, d, e are independent; c copies b, false values too.  In the last group b and c stand against a."""
    rows, seq = [], 10
    for i in range(24):
        true = f"10.1234/true{i}"
        said = {"b": f"10.1234/false{i}" if i < 7 else true, "a": f"10.1234/slip{i}" if i >= 22 else true, "d": true, "e": true}
        said["c"] = said["b"]
        for src in "bcade":
            seq += 1
            rows.append((seq, src, f"k{i}", said[src], "A text.", None, None, None))
    return [(1, "b", "last", "10.1234/wrong", "A text.", None, None, None), (2, "c", "last", "10.1234/wrong", "A text.", None, None, None), (3, "a", "last", "10.1234/right", "A text.", None, None, None), *rows]


def test_the_posterior_decides_the_identifier(spark, monkeypatch):
    rows = copied_dois()
    assert found(spark, rows)[1][0] == "10.1234/right"
    independent = survivor.dependence
    monkeypatch.setattr(survivor, "dependence", lambda judged, accuracy: independent(judged, accuracy).withColumn("copies", F.lit(0.0)))
    assert found(spark, rows)[1][0] == "10.1234/wrong"  # two votes against one, if nobody copied
    monkeypatch.setattr(survivor, "fuse", lambda claims: spark.createDataFrame([], "field string, grp string, value string, votes double"))
    assert found(spark, rows)[1][0] == "10.1234/wrong"  # the smallest row, without any votes


def test_dependence_is_estimated_between_pairs(spark):
    rows = copied_dois()
    claims = spark.createDataFrame([("doi", r[2], r[3], r[1], r[0], True) for r in rows], "field string, grp string, value string, src string, row bigint, possible boolean")
    order = survivor.Window.partitionBy("field", "grp", "value").orderBy("row", "src")
    judged = claims.withColumn("origin", F.first("src").over(order)).withColumn("before", F.lag("src").over(order)).withColumn("ok", F.col("value").startswith("10.1234/true"))
    copies = {(r.src, r.other): r.copies for r in survivor.dependence(judged, survivor._accuracy(judged)).collect()}
    assert copies["c", "b"] > 0.9 > copies["d", "a"] and copies["e", "d"] < 0.9
