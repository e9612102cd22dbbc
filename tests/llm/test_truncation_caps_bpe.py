"""Truncation by structure and baseline, caps against a plain sort, encoding against the libraries."""

from collections import Counter
import os

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from feedloom.llm import bpe, caps, truncation
from feedloom.llm import queries as Q

WHOLE = ["A sentence.", "Is it?", "It was said (Lee, 2010).", "<p>Text.</p>", "Said it. Keywords: one; two; three", "Said it. https://a.example/b", "Said it. Funding: none", "Said it. Trial registration: ABC12345", "He said “no.”", "We shall see … and wait.", "Counted. 12 345"]
CUT = ["A sentence that sto", "A sentence. And then the", "Text with a t&#82", "Text with &am", "Text <stron", 'Text <a href="http', "Text wo�", "Text woâ€", "Said it. As wro…", "Said it. As wro [...]", "Said it. As wro... [more]", "Said it. As wro... Read more", "said (Lee and", "Said it. In the ABC-"]
MISSING = [None, "", "  ", "N/A", "[No summary]", "(none)", "-", "Abstract not available", "See full text.", "null"]


@pytest.mark.parametrize("text", WHOLE)
def test_whole(text):
    assert truncation.verdict(text) == "whole"


@pytest.mark.parametrize("text", CUT)
def test_cut(text):
    assert truncation.verdict(text).startswith("cut") or truncation.verdict(text) == "bare"


@pytest.mark.parametrize("text", MISSING)
def test_missing(text):
    assert truncation.verdict(text) == "missing"


def test_omission_after_a_whole_sentence_is_none():
    assert truncation.verdict("A sentence. […]") == "whole"


@given(st.text())
@settings(max_examples=200, deadline=None)
def test_any_text_has_a_verdict(text):
    assert truncation.verdict(text)


def test_very_long_text():
    assert truncation.verdict("(" * 100_000 + "word. ") in ("whole", "cut:open")
    assert truncation.verdict("word " * 200_000) == "bare"


def test_source_that_writes_no_terminators(spark):
    rows = [(i, "bare", f"headline number {i} of many") for i in range(30)] + [(100 + i, "full", "A sentence.") for i in range(30)] + [(200, "full", "A sentence that sto"), (201, None, "Cut in the mid"), (202, "bare", "Cut wo�")]
    df = spark.createDataFrame(rows, "seq bigint, source string, t string").withColumn("verdict", F.lit(1)).withColumn("row_id", F.lit(2))
    assert {r.row_id for r in truncation.truncated(df, "seq", "source", ["t"]).collect()} == {200, 201, 202}
    report = {r.source: r for r in truncation.report(df, "seq", "source", ["t"]).collect()}
    assert report["full"].n_truncated == 1 and report["full"].n_values == 31 and report["bare"].n_truncated == 1
    assert truncation.truncated(df.limit(0), "seq", "source", ["t"]).count() == 0


@pytest.mark.parametrize("n", [10, 40])
def test_source_that_cuts_most_values_at_a_limit(spark, rng, n):
    text = lambda: "It was seen. " + " ".join("".join(rng.choices("abcdefgh", k=rng.randrange(2, 9))) for _ in range(40))
    rows = [(i, "tight", text()[:120].strip()) for i in range(n)] + [(1000 + i, "tight", "A short sentence.") for i in range(n // 4)]
    # no terminators as a rule, and a limit on top: short values are whole, those at the limit are cut
    rows += [(2000 + i, "both", text()[13 : 33 + 2 * i].strip()) for i in range(40)] + [(3000 + i, "both", text()[13:213].strip()) for i in range(60)]
    df = spark.createDataFrame(rows, "seq bigint, source string, t string")
    assert {r.row_id for r in truncation.truncated(df, "seq", "source", ["t"]).collect()} == {*range(n), *range(3000, 3060)}
    report = {r.source: r.n_truncated for r in truncation.report(df, "seq", "source", ["t"]).collect()}
    assert report == {"tight": n, "both": 60}


def test_caps_against_a_plain_sort(spark, rng):
    rows = [(i, rng.choice(["big"] * 5 + ["b", "c", None]), rng.choice([None, 1.0, 2.0, rng.random()])) for i in range(3000)]
    df = spark.createDataFrame(rows, "i bigint, g string, s double").repartition(7).withColumn("score", F.lit("x")).withColumn("id", F.lit("y")).withColumn("grp", F.lit("z"))
    got = {r.i for r in caps.beyond_cap(df, "g", "s", "i", 10).collect()}
    want = set()
    for g in ("big", "b", "c"):
        own = sorted((r for r in rows if r[1] == g), key=lambda r: (-(r[2] if r[2] is not None else float("-inf")), r[0]))
        want |= {r[0] for r in own[10:]}
    assert got == want
    assert caps.beyond_cap(df.limit(0), "g", "s", "i", 10).count() == 0
    assert caps.beyond_cap(df, "g", "s", "i", 0).count() == sum(r[1] is not None for r in rows)


PEOPLE = [(1, "Garul Reproductive Medicine", "garul-rm.example"), (2, "Renyor Fertility Review", "renyorfr.example"), (3, "Rudvol Fertility Review", "rudvol.example")]


NAMES = [("garul reproductive medicine", 1), ("The Garul Reproductive Medicine", 1), ("Garul Reproductive Medicine – Articles in Press", 1), ("Garul Reproductive Medicine | Home", 1), ("Garul Repr. Medi.", 1), ("www.garul-rm.example", 1),
         ("GRM", 1), ("RFR", None), ("Renyor Fertility Rview", 2), ("Renyor-Fertility-Review", 2), ("", None), (None, None), ("Somebody Else", None)]


def named(spark, names, people, aliases=()):
    people = spark.createDataFrame(people, "contributor_id bigint, name string, domain string")
    feeds = spark.createDataFrame(list(aliases), "contributor_id bigint, name string")
    return {r.name: r.by for r in caps.resolved(spark.createDataFrame([(n,) for n in names], "name string"), people, feeds).collect()}


def test_contributors(spark):
    got = named(spark, [n for n, _ in NAMES], PEOPLE)
    assert [got.get(n) for n, _ in NAMES] == [who for _, who in NAMES]
    assert named(spark, ["x"], []) == {} and named(spark, ["anything"], PEOPLE, [(3, "Any thing")]) == {"anything": 3}


def test_misspellings_against_all_keys(spark, rng):
    def distance(a, b):
        row = list(range(len(b) + 1))
        for i, x in enumerate(a, 1):
            last, row[0] = row[0], i
            for j, y in enumerate(b, 1):
                last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
        return row[-1]

    people = [(i, "".join(rng.choices("abc", k=rng.randrange(1, 9))), None) for i in range(60)]
    names = {"".join(rng.choices("abc", k=rng.randrange(1, 11))) for _ in range(120)}
    keys = {}
    for i, n, _ in people:
        keys.setdefault(n, i)
    want = {}
    for n in names:
        d = {k: distance(n, k) for k in keys}
        best = {keys[k] for k in d if d[k] == min(d.values())} if min(d.values()) <= 2 else set()
        # one word has one initial: a name of one letter that begins one contributor only means that one
        begins = [i for i, p, _ in people if p[0] == n]
        want[n] = keys[n] if n in keys else begins[0] if len(begins) == 1 else best.pop() if len(best) == 1 else None
    got = named(spark, names, people)
    assert {n: got.get(n) for n in names} == want and sum(x is not None for x in want.values()) > 30


def test_heaps_passed_on_early(spark, rng, monkeypatch):
    rows = [(i, f"g{i % 50}", rng.random()) for i in range(1000)]
    df = spark.createDataFrame(rows, "i bigint, g string, s double")
    want = {r.id for r in caps.kept_ids(df, "g", "s", "i", 3).collect()}
    monkeypatch.setattr(caps, "HELD", 2)
    assert {r.id for r in caps.kept_ids(df, "g", "s", "i", 3).collect()} == want and len(want) == 150


def test_more_groups_in_a_task_than_heaps(spark, rng, monkeypatch):
    rows = [(i, f"g{rng.randrange(50)}", rng.random()) for i in range(1000)]
    df = spark.createDataFrame(rows, "i bigint, g string, s double")
    of = {}
    for i, g, s in rows:
        of.setdefault(g, []).append((-s, i))
    monkeypatch.setattr(caps, "HELD", 2)
    size = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(size)
    spark.conf.set(size, "7")  # groups go on from one Arrow batch to the next
    try:
        got = [r.id for r in caps.kept_ids(df, "g", "s", "i", 3).collect()]
    finally:
        spark.conf.set(size, before)
    assert sorted(got) == sorted(i for pairs in of.values() for _, i in sorted(pairs)[:3])


def test_contributor_of_rows(spark):
    rows = [(1, "https://m.garul-rm.example/x?y#z", "whatever"), (2, "HTTPS://WWW.RENYORFR.EXAMPLE", None), (3, None, "Rudvol Fertility Review."), (4, "https://other.example/a", "nobody"), (5, "", " "), (6, "garul-rm.example/x", None)]
    df = spark.createDataFrame(rows, "i bigint, url string, name string")
    people = spark.createDataFrame(PEOPLE, "contributor_id bigint, name string, domain string")
    feeds = spark.createDataFrame([], "contributor_id bigint, name string")
    assert {r.i: r.contributor_id for r in caps.with_contributor([(df, "url", "name")], people, feeds)[0].collect()} == {1: 1, 2: 2, 3: 3, 4: None, 5: None, 6: None}


PATH = f"{bpe.TOKENIZERS}/byte_bpe_50k.tiktoken"
needs_vocabulary = pytest.mark.skipif(not os.path.exists(PATH), reason="no vocabulary files")


@needs_vocabulary
@given(st.text(max_size=300))
@settings(max_examples=300, deadline=None)
def test_encoding_equals_the_library_and_decodes(text):
    book = bpe.vocabulary(PATH)
    text = text.encode("utf-8", "ignore").decode()
    ids = book.encode(text)
    assert ids == library().encode_ordinary(text)
    assert book.decode(ids) == text


_LIBRARY = []


def library():
    if not _LIBRARY:
        import tiktoken

        _LIBRARY.append(tiktoken.Encoding("own", pat_str=bpe.PATTERN, mergeable_ranks=bpe.vocabulary(PATH).rank, special_tokens={}))
    return _LIBRARY[0]


@needs_vocabulary
def test_encoding_of_rows(spark, sf):
    rows = [(1, None), (2, ""), (3, "a" * 50_000), (4, "<|endoftext|>"), (5, " \n\t"), (6, "x"), (7, "x")]
    df = spark.createDataFrame(rows, "d bigint, t string").withColumn("ids", F.lit(1)).withColumn("text", F.lit("no")).withColumn("doc_id", F.lit(9))
    got = {r.doc_id: r.ids for r in bpe.encode(df, "d", "t").collect()}
    assert got == {i: library().encode_ordinary(t or "") for i, t in rows}
    assert bpe.encode(df.limit(0), "d", "t").count() == 0
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    ids = Q.p7_ids(spark, sf)
    assert {r.doc_id: r.ids for r in ids.collect()} == {i: library().encode_ordinary(t or "") for i, t in docs.items()}
    assert {r.doc_id: r.text for r in bpe.decode(ids, "doc_id", "ids").collect()} == {i: t or "" for i, t in docs.items()}


OPEN = ['He said "the trial was stopped early.', "The rate rose (from 4 to 5 per cent.", "They wrote “it is not over.", "One of them [the second.", "It <b>was seen."]
HALF = [r"The caf\u00", r"The caf\u", "The caf%C3%A", "Two &am", "See <a href='x", "It was caf�"]
WHOLE = ['He said "the trial was stopped early."', "The 5\" needle was used.", "An earlier (slip of the pen. The rest is whole.", "2013), as they wrote. The others agreed (Voss and Lowe.", "<p>One paragraph.<p>Another one.", "Costs rose by 5%.", "Fish &amp; chips."]


def test_the_automaton_decides(monkeypatch):
    assert [truncation.verdict(t) for t in OPEN] == ["cut:open"] * len(OPEN)
    assert [truncation.verdict(t) for t in HALF] == ["cut:escape", "cut:escape", "cut:escape", "cut:entity", "cut:markup", "cut:bytes"]
    assert [truncation.verdict(t) for t in WHOLE] == ["whole"] * len(WHOLE)
    monkeypatch.setattr(truncation, "scan", lambda t: (None, [], Counter()))  # without it none of these is told from the others
    assert not any(truncation.verdict(t).startswith("cut") for t in OPEN + HALF)


def test_broken_escapes_are_cut_in_every_source(spark):
    """A source that leaves terminators out does not excuse a value that ends within an escape."""
    rows = [(i, "s", f"A note without a stop {'x' * i}") for i in range(60)] + [(100 + k, "s", t) for k, t in enumerate(HALF)]
    df = spark.createDataFrame(rows, "seq bigint, source string, t string")
    assert {r.row_id for r in truncation.truncated(df, "seq", "source", ["t"]).collect()} == {100 + k for k in range(len(HALF))}
