"""Functions and operators against CPython and plain loops."""

import difflib
import html
import json
import random
import urllib.error

import numpy as np
import pytest
from pyspark.sql import functions as F

from feedloom.functions import ids, lists, text, udfs
from feedloom.operators import history, profile, ranking, resolve, score, verify
from feedloom.operators.components import components
from feedloom.sources import blocks, config, feeds, files


def column(spark, values, kind="string"):
    return spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")


def applied(spark, values, f, kind="string"):
    return [r.o for r in column(spark, values, kind).select("i", f(F.col("v")).alias("o")).orderBy("i").collect()]


def test_html(spark):
    assert applied(spark, ["<p>a&amp;b</p>  c d", None, "", "one two three"], lambda c: text.strip_html(c, 9)) == ["a&b c d", "", "", "one two"]
    values = ["&eacute; &#8217; &lt;", "&am", None, "no"]
    assert applied(spark, values, udfs.html_unescape) == [None if v is None else html.unescape(v) for v in values]


def test_urls(spark):
    values = ["HTTPS://A.Example/Path/?utm_source=x&id=1&flag#f", " http://a.example// ", "a b|c", None, "", "https://a.example?id=1&ref=2"]
    assert applied(spark, values, ids.url) == ["https://a.example/Path?id=1", "http://a.example", "a b|c", "", "", "https://a.example?id=1"]
    assert applied(spark, values[:2] + [None], ids.domain) == ["a.example", "a.example", "unknown"]


def test_identifiers(spark):
    assert applied(spark, ["see doi:10.1234/ab.c).", "10.1/x", None], ids.doi) == ["10.1234/ab.c", None, None]
    assert applied(spark, ["https://pubmed.ncbi.nlm.nih.gov/123/", "PMID:77", "77", None], ids.pmid) == ["123", "77", None, None]


def test_tags_and_lists(spark):
    assert applied(spark, [["IVF", "ivf ", "", None, "Lab"], None], lists.merged_tags, "array<string>") == [["IVF", "Lab"], []]
    assert applied(spark, ['x {"a": {"b": 1}} y', "none", None], lists.json_object) == ['{"a": {"b": 1}}', None, None]


def test_sentences_and_numbers(spark):
    assert applied(spark, ["One. Two!  Three", "", None], text.sentences) == [["One.", "Two!", "Three"], [], []]
    assert applied(spark, ["42% of 5.5%x and 42", None], text.numbers) == [["42", "5.5%"], []]


def test_topics_rank_by_hits_then_priority(spark):
    words = {"a": ["x"], "b": ["y", "z"], "c": ["w"]}
    got = applied(spark, ["x y z", "x w", "nothing", None, "xx"], lambda c: score.topics(c, words, ["c"])["primary"])
    assert got == ["b", "c", "general", "general", "general"]


def test_rule_cascade(spark):
    got = applied(spark, ["Retraction: x", "Correction of y", "Correction", "A review", "A systematic review and meta-analysis", None], lambda c: score.first_match(c, score.TITLE_TYPES, "unknown"))
    assert got == ["retraction", "unknown", "correction", "review", "meta_analysis", "unknown"]


def test_claims(spark):
    df = spark.createDataFrame([("It rose by 5% in a randomized trial. It fell.", "It rose by 5% in 10 women.", "rose by 5%")], "s string, e string, f string")
    r = df.select(verify.checks(F.col("s"), F.col("e"), F.lit("review"), F.lit("low")).alias("c"), verify.labelled_sentences(F.col("s"), F.col("e"), F.col("f"), F.lit("")).alias("l")).first()
    assert [x.passed for x in r.c] == [True, False, True, True]
    assert [x.label for x in r.l] == ["unsupported", "weakly_supported"]
    out = df.select(verify.filtered(F.col("s"), verify.labelled_sentences(F.col("s"), F.col("e"), F.col("f"), F.lit(""))).alias("o")).first().o
    assert out == "It fell."


def test_components_against_union_find(spark):
    rng = random.Random(3)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(220)] + [(500 + i, 501 + i) for i in range(64)] + [(None, 1), (2, 2)]
    parent = {}

    def top(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in edges:
        if a is not None and a != b:
            x, y = sorted((top(a), top(b)))
            parent[y] = x
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    assert got == {x: top(x) for x in parent}
    assert components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


def near_records(rows):
    """All pairs of records with similar titles within a week, or without a date, one by one."""
    out = set()
    for x in rows:
        for y in rows:
            if x.seq < y.seq and x.t and y.t and (x.at is None or y.at is None or abs((x.at - y.at).total_seconds()) <= 7 * 86400):
                if x.t == y.t or difflib.SequenceMatcher(None, x.t, y.t).ratio() >= 0.85:
                    out.add((x.seq, y.seq))
    return out


def test_fuzzy_titles_and_their_closure(spark, sf):
    df = spark.read.parquet(f"{sf}/normalized_item.parquet").filter("seq <= 130").select("seq", "title", F.when(F.col("seq") % 9 != 0, F.col("fetched_at")).alias("at"))
    rows = df.withColumn("t", text.comparable_title(F.col("title"))).collect()
    want = near_records(rows)
    first = {}
    for r in sorted(rows, key=lambda r: r.seq):
        first.setdefault(r.t, r.seq)
    of = {r.seq: r.t for r in rows}
    links = resolve.fuzzy_titles(df, "seq", "title", "at")
    got = {(r.a, r.b) for r in links.collect()}
    assert {tuple(sorted((first[of[x]], first[of[y]]))) for x, y in want if of[x] != of[y]} <= got
    assert all(difflib.SequenceMatcher(None, of[a], of[b]).ratio() >= 0.85 for a, b in got) and got

    def closure(edges):
        parent = {}

        def top(x):
            while parent.setdefault(x, x) != x:
                x = parent[x]
            return x

        for a, b in edges:
            x, y = sorted((top(a), top(b)))
            parent[y] = x
        return {x: top(x) for x in parent}

    edges = [(r.a, r.b) for r in resolve.title_edges(df, "seq", "title", "at", links.select("x", "y")).collect()]
    assert closure(edges) == closure(want)


def test_close_letters_lose_no_pair_and_leave_few():
    """Titles of one vocabulary share most letters; their order has to tell them before each pair is read letter by letter."""
    from collections import Counter

    import pandas as pd
    import pyarrow as pa

    from feedloom.functions import udfs

    rng = random.Random(5)
    vocabulary = ["".join(rng.choices("etaoinsrlhdcumpfgyvbwk", weights=range(22, 0, -1), k=rng.randint(3, 12))) for _ in range(60)]
    texts = [" ".join(rng.choices(vocabulary, k=17)) for _ in range(150)]
    for k in range(60):
        t = list(rng.choice(texts))
        for _ in range(rng.randrange(1, 30)):
            t[rng.randrange(len(t))] = rng.choice("etaoin \u00e9z(7")
        texts.append("".join(t))
    texts += ["e" * 300 + "xyz", "e" * 290 + "xyz", "k" * 100, "k" * 95, "ab", "abc", "kz" * 20_000, "kz" * 19_999]
    s = pd.Series(texts)
    bits = udfs.letter_bits.func(s)
    rows = [{"id": i, "n": len(t), "code": c, "other": len(t) - sum(int(x % (1 << 64)).bit_count() for x in b), **{f"k{k}": b[k] for k in range(4)}} for i, (t, b, c) in enumerate(zip(texts, bits, udfs.letter_codes.func(s)))]
    table = pa.Table.from_pylist([r | {"left": True, "own": True} for r in rows] + [r | {"left": False, "own": r["id"] % 2 == 0} for r in rows])
    met = udfs.close_letters(0.85)(table).to_pylist()
    got = {(r["a"], r["b"]) for r in met}
    pairs = [(i, j) for j in range(len(texts)) for i in range(j)]
    near = {(i, j) for i, j in pairs if min(len(texts[i]), len(texts[j])) >= 0.85 / 1.15 * max(len(texts[i]), len(texts[j])) and 2 * udfs.common_length(texts[i], texts[j]) >= 0.85 * (len(texts[i]) + len(texts[j]))}
    letters = sum(2 * sum((Counter(texts[i]) & Counter(texts[j])).values()) >= 0.85 * (len(texts[i]) + len(texts[j])) for i, j in pairs)
    assert near <= got and len(near) > 60 and all(a < b for a, b in got)
    assert len(got) < 2 * len(near) + 20 < letters / 10
    assert all(r["a"] % 2 or r["b"] % 2 or met.count(r) == 1 for r in met)


def test_counts_leave_few_pairs_to_the_subsequences(sf, monkeypatch):
    """Titles of one vocabulary: counts of letters and of their pairs have to tell most of them apart, and lose none."""
    import pandas as pd
    import pyarrow as pa

    titles = pd.read_parquet(f"{sf}/normalized_item.parquet", columns=["title"]).title
    texts = sorted({t.lower() for t in titles.dropna() if len(t) > 60})
    texts += [t[:9] + "x" + t[12:] for t in texts[:40]] + [texts[0] * 5, texts[0] * 5 + "y", texts[1] * 12, texts[1] * 12 + "y"]
    s = pd.Series(texts)
    bits = udfs.letter_bits.func(s)
    rows = [{"id": i, "n": len(t), "code": c, "other": len(t) - sum(int(x % (1 << 64)).bit_count() for x in b), **{f"k{k}": b[k] for k in range(4)}} for i, (t, b, c) in enumerate(zip(texts, bits, udfs.letter_codes.func(s)))]
    table = pa.Table.from_pylist([r | {"left": left, "own": True} for left in (True, False) for r in rows])
    shared, met = udfs._Part.shared, []
    monkeypatch.setattr(udfs._Part, "shared", lambda part, i, j: (met.append((id(part), len(i))), shared(part, i, j))[1])
    got = {(r["a"], r["b"]) for r in udfs.close_letters(0.85)(table).to_pylist()}
    pairs = [(i, j) for j in range(len(texts)) for i in range(j)]
    near = {(i, j) for i, j in pairs if 2 * udfs.common_length(texts[i], texts[j]) >= 0.85 * (len(texts[i]) + len(texts[j]))}
    first = sum(k for part, k in met if part == met[0][0])
    assert near <= got and len(near) > 40 and first < len(pairs) / 20


def test_matching_letters_are_those_of_difflib():
    rng = random.Random(6)
    xs, ys = (["".join(rng.choices("ab c\u00e9\U0001f600", k=rng.randrange(low, 70))) for _ in range(400)] for low in (0, 0))
    ys[:150] = [x[:7] + y[:3] + x[12:] for x, y in zip(xs, ys[:150])]
    want = [sum(m.size for m in difflib.SequenceMatcher(None, x, y).get_matching_blocks()) for x, y in zip(xs, ys)]
    assert udfs.matching_letters(xs, ys, np.zeros(400)).tolist() == want
    least = np.array([0.4 * (len(x) + len(y)) for x, y in zip(xs, ys)])
    got = udfs.matching_letters(xs, ys, least)
    assert all(g == w if w >= n else g < n for g, w, n in zip(got, want, least)) and sum(w >= n for w, n in zip(want, least)) > 50
    assert udfs.matching_letters([], [], np.zeros(0)).tolist() == []


def test_titles_without_dates_meet_in_blocks(spark, monkeypatch):
    """Clusters need each link once, also where titles fill several blocks."""
    rng = random.Random(8)
    monkeypatch.setattr(resolve, "BLOCK", 7)
    base = [" ".join("".join(rng.choices("etaoinsrlhdcum", k=6)) for _ in range(6)) for _ in range(25)]
    rows = [(k, b[:j] + "q" + b[j:], day) for k, (b, j, day) in enumerate((b, rng.randrange(40), rng.choice([None, 1, 9, 16])) for b in base * 3)]
    df = spark.createDataFrame(rows, "i bigint, t string, d int").select("i", "t", F.timestamp_seconds(F.col("d") * 86400).alias("at"))
    first, days = {}, {}
    for i, t, d in rows:
        first.setdefault(t, i)
        days.setdefault(t, set()).add(None if d is None else d // 7)
    near = lambda x, y: any(a is None or b is None or abs(a - b) <= 1 for a in days[x] for b in days[y])
    ordered = sorted(first, key=first.get)
    want = sorted((first[x], first[y]) for k, y in enumerate(ordered) for x in ordered[:k] if near(x, y) and difflib.SequenceMatcher(None, x, y).ratio() >= 0.85)
    assert sorted((r.a, r.b) for r in resolve.fuzzy_titles(df, "i", "t", "at").collect()) == want and len(want) > 30


def test_letter_bits_and_common_length_bound_the_ratio(spark):
    from feedloom.functions import udfs

    rng = random.Random(3)
    texts = ["".join(rng.choices("aeionst rzß-1", k=rng.randrange(1, 40))) for _ in range(60)]
    df = spark.createDataFrame([(t,) for t in texts], "t string").withColumn("b", udfs.letter_bits("t"))
    bits = {r.t: sum((x & (1 << 64) - 1) << 64 * k for k, x in enumerate(r.b)) for r in df.collect()}
    for a in texts:
        for b in texts[:20]:
            m = difflib.SequenceMatcher(None, a, b).ratio() * (len(a) + len(b)) / 2
            free = min(len(a) - bits[a].bit_count(), len(b) - bits[b].bit_count())
            assert m <= udfs.common_length(a, b) + 1e-9 and m <= (bits[a] & bits[b]).bit_count() + free + 1e-9
    assert udfs.common_length("", "abc") == 0 and udfs.common_length("xaybzc", "abc") == 3
    got = spark.createDataFrame([("abcd", "abcx"), ("abcd", "zzzz"), ("q", "q")], "x string, y string").select(udfs.ratio_from(0.7)("x", "y").alias("r")).collect()
    assert [r.r for r in got] == [0.75, None, 1.0]


def test_best_of_a_cluster(spark):
    df = spark.createDataFrame([(1, "a", 5), (2, "a", 9), (3, "a", 9), (4, None, 1)], "i bigint, k string, s bigint")
    assert {(r.k, r.i, r.cluster_size) for r in resolve.best_of(df, "k", "s", "i").collect()} == {("a", 2, 3), (None, 4, 1)}


def test_ordered_selection_against_a_loop(spark):
    rng = random.Random(5)
    rows = [(i, float(rng.randrange(40)), rng.choice("abcdef"), rng.choice("xyz"), rng.random() < 0.3, rng.random() < 0.6) for i in range(400)]
    caps, roles = {"f": 4, "t": 7}, [("main", "m", 5), ("quick", "q", 9)]
    df = spark.createDataFrame(rows, "i bigint, s double, f string, t string, m boolean, q boolean")
    got = {r.i: r.role for r in ranking.select_ordered(df, "i", "s", caps, roles).collect()}
    used, room, want = {"f": {}, "t": {}}, {"main": 5, "quick": 9}, {}
    for i, _, f, t, m, q in sorted(rows, key=lambda r: (-r[1], r[0])):
        role = next((n for n, ok in (("main", m), ("quick", q)) if ok and room[n] and used["f"].get(f, 0) < 4 and used["t"].get(t, 0) < 7), "rejected")
        want[i] = role
        if role != "rejected":
            room[role] -= 1
            used["f"][f] = used["f"].get(f, 0) + 1
            used["t"][t] = used["t"].get(t, 0) + 1
    assert got == want


def test_period_caps_role_caps_and_audit(spark):
    rng = random.Random(8)
    rows = [(i, float(rng.randrange(60)), rng.choice("abcde"), rng.choice([-1, 0, 1, 2, 3, None]), rng.random() < 0.5, True) for i in range(300)]
    df = spark.createDataFrame(rows, "i bigint, s double, f string, p int, m boolean, q boolean")
    roles = [("main", "m", 12), ("quick", "q", 7)]
    got = {r.i: r.role for r in ranking.select_ordered(df, "i", "s", {}, roles, role_caps={"main": {"f": 4}}, periods=("main", "p", 4)).collect()}
    room, of_source, of_period, dated, want = {"main": 12, "quick": 7}, {}, {}, 0, {}
    for i, _, f, p, m, _ in sorted(rows, key=lambda r: (-r[1], r[0])):
        want[i] = "rejected"
        open_ = p is not None and p >= 0
        if m and room["main"] and of_source.get(f, 0) < 4 and (of_period.get(p, 0) < 3 if open_ else dated < 12 * 0.8):
            want[i], of_source[f] = "main", of_source.get(f, 0) + 1
            if open_:
                of_period[p], dated = of_period.get(p, 0) + 1, dated + 1
        elif room["quick"]:
            want[i] = "quick"
        if want[i] != "rejected":
            room[want[i]] -= 1
    assert got == want and {"main", "quick"} <= set(want.values())
    audit = {(r.regime, r.role): r.n for r in ranking.cap_audit(df, "i", "s", "f", roles, {"strict": 1, "off": None}).collect()}
    assert audit == {("strict", "main"): 5, ("strict", "quick"): 5, ("off", "main"): 12, ("off", "quick"): 7}


def test_ranks_over_many_partitions(spark):
    df = spark.createDataFrame([(i, i % 7) for i in range(500)], "i bigint, s int").repartition(6)
    got = [r.i for r in ranking.ranked(df, [F.desc("s"), F.asc("i")]).orderBy("rank").collect()]
    assert got == [i for i, _ in sorted(((i, i % 7) for i in range(500)), key=lambda r: (-r[1], r[0]))]
    assert ranking.ranked(df.limit(0), [F.asc("i")]).count() == 0
    assert ranking.first_rows(df, [F.asc("i")], 0).count() == 500 and ranking.first_rows(df, [F.asc("i")], 3).count() == 3


def test_entities_of_all_kinds(spark):
    got = [r.t for r in spark.createDataFrame([("<p>Fish &amp; chips</p>",), ("caf&eacute; &#8217;s &ndash; &#x41;",), ("&amp;lt;",), (None,), ("",)], "x string").select(text.strip_html(F.col("x")).alias("t")).collect()]
    assert got == ["Fish & chips", "café ’s – A", "&lt;", "", ""]


def test_a_cluster_needs_a_shared_checkpoint_folder(monkeypatch):
    from types import SimpleNamespace as N

    from feedloom import session

    unset = N(getCheckpointDir=lambda: N(isDefined=lambda: False, get=lambda: None))
    context = N(getConf=lambda: N(get=lambda k: None), _jsc=N(sc=lambda: unset), master="spark://host:7077", setCheckpointDir=lambda d: None)
    with pytest.raises(ValueError, match="shared folder"):
        session.checkpoint_dir(N(sparkContext=context, conf=N(get=lambda k, d: d)))


def test_overflow_and_openings(spark):
    df = spark.createDataFrame([(i, float(i), "featured") for i in range(8)], "i bigint, s double, tier string")
    assert sorted(r.i for r in ranking.overflow(df, "i", "tier", [F.desc("s")], 5, "featured", "watch").filter("tier = 'watch'").collect()) == [0, 1, 2]
    df = spark.createDataFrame([(1, "same"), (2, "same"), (3, "same"), (4, ""), (5, ""), (6, None), (7, "")], "i int, t string")
    assert sorted(r.i for r in profile.grouped_openings(df, text.prefix_key(F.col("t"))).filter("is_grouped").collect()) == [1, 2, 3]


def test_lookup_prefers_the_first_key(spark):
    new = spark.createDataFrame([(1, "d1", "u9"), (2, None, "u1"), (3, "", None)], "i bigint, d string, u string")
    old = spark.createDataFrame([(7, "d1", "x"), (8, "z", "u9"), (9, None, "u1"), (5, None, "u1")], "id bigint, d string, u string")
    keys = lambda: [F.col("d"), F.col("u")]
    got = {r.i: (r.match_id, r.match_priority) for r in history.lookup(new, "i", keys(), old, "id", keys()).collect()}
    assert got == {1: (7, 0), 2: (5, 1), 3: (None, None)}


@pytest.mark.parametrize("emitted, days, changed, state", [(None, None, None, "new"), (0, None, False, "seen_not_emitted"), (1, 10, False, "previously_emitted"), (1, 90, False, "reappeared_after_threshold"), (1, 10, True, "updated_existing_item")])
def test_novelty(spark, emitted, days, changed, state):
    df = spark.createDataFrame([(emitted, changed)], "e bigint, c boolean")
    last = F.lit("2024-03-01").cast("timestamp") - F.make_interval(days=F.lit(days)) if days is not None else F.lit(None).cast("timestamp")
    assert df.select(history.novelty(F.col("e"), last, F.lit("2024-03-01").cast("timestamp"), 90, F.col("c")).alias("s")).first().s == state


def test_snapshots(spark, tmp_path):
    store = files.Snapshots(spark, str(tmp_path / "state"))
    assert store.read("k string, n bigint").count() == 0
    store.write(spark.createDataFrame([("a", 1)], "k string, n bigint"))
    after = history.upsert(store.read("k string, n bigint"), spark.createDataFrame([("a", 2), ("b", 5)], "k string, n bigint"), "k", [], {}, {"n": F.col("n")})
    store.write(after)
    assert {(r.k, r.n) for r in store.read("k string, n bigint").collect()} == {("a", 3), ("b", 5)}


def test_blocks(spark):
    doc = "profile\nARTICLE DETAILS\n====\n\nArticle 1\n-----\nTitle: One\nURL: u1\nContent:\nline one\nline two\n========\nArticle 2\n-----\nTitle: Two\nContent: inline\n"
    got = [(r.number, r.title, r.url, r.content) for r in blocks.parse_blocks(spark.createDataFrame([(doc,), (None,)], "t string"), "t", ("Title", "URL")).collect()]
    assert got == [(1, "One", "u1", "line one\nline two"), (2, "Two", None, "inline")]
    made = blocks.write_blocks(spark.createDataFrame([(1, "T", "c")], "n bigint, t string, c string"), "n", {"Title": F.col("t")}, F.col("c"))
    assert blocks.parse_blocks(blocks.document(made), "text", ("Title",)).first().title == "T"


def test_script_titles(spark):
    lines = ["Story 1: First", "• no", "=== QUICK HITS ===", "• Second", "Story 2: no", "=== END ===", "• no"]
    df = spark.createDataFrame([(1, i, t) for i, t in enumerate(lines)], "d int, n int, t string")
    assert [r.title for r in blocks.script_titles(df, "t", "n", "d").orderBy("n").collect()] == ["First", "Second"]


RSS = """<rss xmlns:dc="http://purl.org/dc/elements/1.1/"><channel><title>f</title>
<item><title>One</title><link>https://a.example/1</link><guid>g1</guid><pubDate>Mon, 04 Mar 2024 10:00:00 GMT</pubDate><dc:creator>Ann Lee</dc:creator><category>IVF</category><description>d</description></item>
<item><title>Two</title><link>https://a.example/2</link></item></channel></rss>"""


def test_feed_source(spark, tmp_path):
    good, broken = tmp_path / "good.xml", tmp_path / "broken.xml"
    good.write_text(RSS)
    broken.write_text(RSS[: RSS.index("<title>Two")])
    spark.dataSource.register(feeds.FeedSource)
    listed = [{"url": str(good), "name": "g"}, {"url": str(broken)}, {"url": str(tmp_path / "missing.xml")}, {"url": "x", "enabled": False}]
    rows = spark.read.format("feedloom_feed").option("feeds", json.dumps(listed)).load()
    got = {r.feed_url.rsplit("/", 1)[1]: (r.status, r.entries) for r in feeds.diagnostics(rows).collect()}
    assert got == {"good.xml": ("ok", 2), "broken.xml": ("partial", 1), "missing.xml": ("failed", 0)}
    one = rows.filter("title = 'One' and status = 'ok'").first()
    assert (one.link, one.authors, one.tags, one.published) == ("https://a.example/1", ["Ann Lee"], ["IVF"], "Mon, 04 Mar 2024 10:00:00 GMT")


def test_retries():
    waits, calls = [], []

    def opener(request, timeout):
        calls.append(dict(request.header_items()))
        raise urllib.error.HTTPError(request.full_url, 503 if len(calls) < 3 else 404, "no", {}, None)

    assert feeds.fetch("http://a.example", "tag", None, 1, 5, waits.append, opener)[0] == 404
    assert waits == [2.0, 4.0] and calls[0]["If-none-match"] == "tag"
    assert [feeds.wait_s(k) for k in (1, 3, 9)] == [2.0, 8.0, 60.0]


def test_configuration(tmp_path):
    p = tmp_path / "c.json"
    p.write_text('{"ingest": {"attempts": 5, "other": 1}, "feeds": [{"url": "u"}]}')
    c = config.load(str(p))
    assert (c.ingest.attempts, c.ingest.timeout_s, c.feeds[0]["url"]) == (5, 30.0, "u")
    assert config.override(c, "ingest", attempts=None, max_workers=2).ingest.max_workers == 2
    assert config.effective_days(0, 14) == 14
    with pytest.raises(ValueError):
        config.load(str(tmp_path / "c.txt"))
    with pytest.raises(ValueError):
        config.Dedupe(title_threshold=2)


def test_json_files(spark, tmp_path):
    (tmp_path / "a.json").write_text('[{"k": 1}, {"k": 2}]')
    (tmp_path / "l.json").write_text('{"k": 1}\n{"k": 3}\n')
    assert sorted(r.k for r in files.read_items(spark, str(tmp_path / "a.json")).collect()) == [1, 2]
    assert sorted(r.k for r in files.read_items(spark, str(tmp_path / "l.json")).collect()) == [1, 3]
    assert files.as_array(spark.createDataFrame([(2,), (1,)], "k bigint"), "k").first().json == '[{"k":1},{"k":2}]'


def test_streaming(spark, tmp_path):
    from feedloom import streaming

    source = tmp_path / "in"
    spark.createDataFrame([("a",), ("b",), ("a",)], "k string").coalesce(1).write.json(str(source))
    keys = streaming.SeenKeys(spark, str(tmp_path / "state"), "k")
    seen = []
    items = spark.readStream.schema("k string").json(str(source))
    q = streaming.novelty_stream(items, "k", keys, lambda df, n: seen.extend(r.k for r in df.collect()), str(tmp_path / "cp"))
    q.awaitTermination(60)
    assert sorted(seen) == ["a", "b"] and keys.before(-1).count() == 2
    again = spark.createDataFrame([("a",), ("b",)], "k string")  # the same batch once more: the same keys, still once
    assert again.join(keys.before(0), "k", "left_anti").count() == 2
    keys.add(again, 0)
    assert keys.before(-1).count() == 2 and again.join(keys.before(1), "k", "left_anti").count() == 0


def test_sequence_ratio_and_wrap(spark):
    df = spark.createDataFrame([("tide", "diet"), ("diet", "tide"), ("a", "a"), (None, "x")], "a string, b string")
    got = [r.o for r in df.select(udfs.sequence_ratio("a", "b").alias("o")).collect()]
    assert got == [difflib.SequenceMatcher(None, a or "", b or "").ratio() if a != b else 1.0 for a, b in (("tide", "diet"), ("diet", "tide"), ("a", "a"), (None, "x"))]
    assert applied(spark, ["one two three"], lambda c: udfs.wrap_text(c, F.lit(7))) == ["one two\nthree"]


def test_workers_defaults_and_summary(spark, tmp_path):
    from feedloom.sources import feeds, files

    for k in range(3):
        (tmp_path / f"{k}.xml").write_text(f"<rss><channel><item><title>{'T' if k else ' '}</title><description>Text {k}</description></item></channel></rss>")
    reader = feeds._Reader({"feeds": json.dumps([{"url": str(tmp_path / f"{k}.xml")} for k in range(3)] + [{"url": "x", "enabled": False}]), "workers": "2"})
    assert [len(p.feeds) for p in reader.partitions()] == [2, 1] and len(feeds._Reader({"feeds": "[]"}).partitions()) == 0
    spark.dataSource.register(feeds.FeedSource)
    rows = spark.read.format("feedloom_feed").option("feeds", json.dumps([{"url": str(tmp_path / f"{k}.xml")} for k in range(3)])).option("workers", "1").load()
    got = {(r.title, r.date, r.content) for r in feeds.with_defaults(rows, F.lit("2026-01-01")).collect()}
    assert got == {("No title available", "2026-01-01", "Text 0"), ("T", "2026-01-01", "Text 1"), ("T", "2026-01-01", "Text 2")}
    links = spark.createDataFrame([("http://a", "10.1/x"), (" ", "10.1/x"), (None, None)], "l string, d string").select(feeds.canonical_url(F.col("l"), F.col("d")).alias("u")).collect()
    assert [r.u for r in links] == ["http://a", "https://doi.org/10.1/x", ""]
    files.write_summary(spark.createDataFrame([(3, 2)], "raw int, kept int"), str(tmp_path / "summary"))
    assert files.read_items(spark, str(tmp_path / "summary")).first().asDict() == {"kept": 2, "raw": 3}
