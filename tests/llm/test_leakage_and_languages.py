"""Leaks against a search for every run of words; languages on held-out rows."""

import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from feedloom.llm import langid, leakage

ITEM = "Two technicians, Rudmi and Selru, disagreed on 45.8 per cent of slides until the WIMREN-62 key was shown. The protocol asks for 1,246 grams of salt per litre of warm-up water."
WORDS = ITEM.split()


def leaks(spark, texts, items=((1, ITEM), (2, None), (3, ""), (4, "too short to leak"))):
    docs = spark.createDataFrame(list(enumerate(texts)), "d bigint, t string").withColumn("item_id", F.lit(5)).withColumn("text", F.lit("x"))
    found = leakage.leaks(docs, "d", "t", spark.createDataFrame(list(items), "item_id bigint, passage string"), "item_id", "passage")
    return {(r.doc_id, r.item_id) for r in found.collect()}


def test_forms_of_a_leak(spark):
    run = " ".join(WORDS[3:20])
    texts = [ITEM, "before " * 500 + run + " after" * 500, run.upper(), run.replace(" ", "\n"), run.replace("technicians", "tech-\nnicians"), run.replace("slides", "sl­i​des"), run.replace("until", "<em>un</em>til"), "\n\n".join(["x", run]), run.replace("fi", "ﬁ"), " ".join(WORDS[3:10]), " ".join(WORDS[0:9] + ["other"] + WORDS[10:19]), None, "", "word " * 50_000]
    assert leaks(spark, texts) == {(i, 1) for i in range(9)}
    assert leaks(spark, []) == set()
    assert leaks(spark, [ITEM], ()) == set()


def test_against_every_run(spark, sf):
    docs, items = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/eval_item.parquet")
    got = {(r.doc_id, r.item_id) for r in leakage.leaks(docs, "doc_id", "text", items, "item_id", "passage").collect()}
    text = {r.doc_id: leakage.letters(leakage.clean(r.text)) for r in docs.filter("text is not null").collect()}
    want = set()
    for r in items.collect():
        w = re.findall(r"[^\W_]+", leakage.clean(r.passage))
        runs = ["".join(w[k : k + leakage.RUN]) for k in range(len(w) - leakage.RUN + 1)]
        want |= {(d, r.item_id) for d, t in text.items() if any(x in t for x in runs)}
    assert got == want and got


def test_blocks_of_items(spark, monkeypatch):
    monkeypatch.setattr(leakage, "MAX_ITEMS", 1)
    assert leaks(spark, [ITEM], ((1, ITEM), (2, ITEM))) == {(0, 1), (0, 2)}


def test_search_scores_every_item_like_a_plain_sum(rng):
    vocabulary = [f"w{k}" for k in range(60)]
    items = [(i, " ".join(rng.choices(vocabulary, weights=range(1, 61), k=rng.randrange(12, 60)))) for i in range(90)]
    index = leakage.Items(items)
    for _ in range(40):
        text = rng.choice(items)[1].split()[:20] + rng.choices(vocabulary, k=10)
        pairs = [(index.word[a], index.word[b]) for a, b in zip(text, text[1:]) if a in index.word and b in index.word]
        where = [(a * len(index.word) + b) for a, b in pairs]
        terms = np.array([index.named[np.searchsorted(index.name, x)] for x in where if x in index.name], np.int64)
        score = np.zeros(len(items))
        for t in set(terms.tolist()):
            mine = (index.posting // len(items)) == t
            score[index.at[mine]] += index.part[mine]
        _, found = index.search(terms, np.zeros(len(terms), np.int64))
        assert sorted(found.tolist()) == np.flatnonzero(score >= 1 - 1e-9).tolist()


def test_every_place_of_a_run(spark):
    """Runs of exactly twelve words at every place of a passage, one by one, also with a broken word in them."""
    runs = [" ".join(w for w in re.findall(r"[^\W_]+", ITEM)[k : k + 12]) for k in range(len(re.findall(r"[^\W_]+", ITEM)) - 11)]
    broken = [re.sub(r"\b(\w{2})(\w{2,})", "\\1-\n\\2", r, count=n) for n, r in zip([1, 2, 3, 12] * 20, runs)]
    assert leaks(spark, runs + broken) == {(i, 1) for i in range(2 * len(runs))}
    assert leaks(spark, [" ".join(r.split()[:11]) for r in runs]) == set()


def test_an_index_is_built_once_in_a_worker():
    one, again = leakage._built("a", [(1, ITEM)]), leakage._built("a", [(2, ITEM)])
    assert one is again and leakage._built("b", [(2, ITEM)]).ids == [2]


def test_labels(spark):
    labels = ["en", "EN-gb", "en_US", "English", "français", "deu", "xx", "und", "", " ", None, "bg", "Русский"]
    got = [r.l for r in spark.createDataFrame([(x,) for x in labels], "x string").select(langid.label_of(F.col("x")).alias("l")).collect()]
    assert got == ["en", "en", "en", "en", "fr", "de", None, None, None, None, None, "other", "ru"]


def test_held_out_accuracy(spark, sf):
    docs = spark.read.parquet(f"{sf.replace('0.001', '0.01')}/documents.parquet").withColumn("l", langid.label_of(F.col("lang")))
    seen, held = docs.filter("doc_id % 2 = 0"), docs.filter("doc_id % 2 = 1 and l in ('de','en','es','fr','it','nl','pt','ru') and n_chars > 80")
    profiles = langid.fit(seen, "doc_id", "text", "lang")
    rows = held.select("text", "l").collect()
    found = langid.judge(profiles, [r.text for r in rows])
    right = sum(bool(f) and max(f, key=lambda s: s[1])[0] == r.l for f, r in zip(found, rows))
    assert right / len(rows) > 0.9  # about one label in twenty is wrong


def test_mixed_wordless_and_long_texts(spark, sf):
    docs = spark.read.parquet(f"{sf.replace('0.001', '0.01')}/documents.parquet")
    profiles = langid.fit(docs, "doc_id", "text", "lang")
    en = "Secondary outcomes such as implantation and pregnancy were recorded during the first trimester of the study."
    de = "Die Forschenden berichten, dass die Beratung per Video während der ersten Wochen kaum einen Unterschied machte."
    texts = [en, de, f"{en} {de}", None, "", "123 456", "🤰🔬", en * 2000, f"{en} Guten Tag."]
    got = [sorted({s[0] for s in f}) for f in langid.judge(profiles, texts)]
    assert got == [["en"], ["de"], ["de", "en"], [], [], [], [], ["en"], ["en"]]
    df = spark.createDataFrame([(1, en, "en"), (2, en, "de"), (3, en, None), (4, de + " " + en, "de"), (5, None, None), (6, "", "en")], "d bigint, t string, l string").withColumn("confidence", F.lit(1)).withColumn("lang", F.lit("q"))
    parts = langid.segments(df, "d", "t", profiles).collect()
    assert {(r.doc_id, r.lang) for r in parts} == {(1, "en"), (2, "en"), (3, "en"), (4, "de"), (4, "en")} and all(0 <= r.confidence <= 1 for r in parts)
    assert langid.segments(df.limit(0), "d", "t", profiles).count() == 0
    assert langid.corrected(df.limit(0), "d", "t", "l").count() == 0


def test_corrected_documents(spark, sf):
    docs = spark.read.parquet(f"{sf.replace('0.001', '0.01')}/documents.parquet")
    extra = spark.createDataFrame([(10**6 + 1, "Data were gathered in a national registry between two and three years ago, covering many cycles.", "de"), (10**6 + 2, "Data were gathered in a national registry between two and three years ago, covering many cycles.", "English")], "doc_id bigint, text string, lang string")
    got = {(r.doc_id, r.lang) for r in langid.corrected(docs.select("doc_id", "text", "lang").union(extra), "doc_id", "text", "lang").filter("doc_id > 1000000").collect()}
    assert got == {(10**6 + 1, "en")}


EN = "Secondary outcomes such as implantation and pregnancy were recorded during the first trimester of the study."
GREEK = "Αυτή είναι μια πρόταση στα ελληνικά που δεν ανήκει σε καμία από τις γνωστές γλώσσες."
JAPANESE = "これは 日本 語 の 文章 で あり 既知 の 言語 に は 属して いません。"


@pytest.fixture(scope="module")
def profiles(spark, sf):
    return langid.fit(spark.read.parquet(f"{sf.replace('0.001', '0.01')}/documents.parquet"), "doc_id", "text", "lang")


def test_other_scripts_have_no_language(profiles):
    assert langid.judge(profiles, [GREEK, JAPANESE]) == [[], []]  # a batch in which no n-gram is profiled
    assert [[s[0] for s in f] for f in langid.judge(profiles, [EN, GREEK, f"{EN} {GREEK}"])] == [["en"], [], ["en"]]


def test_right_foreign_labels_are_no_cases(spark, sf):
    docs = spark.read.parquet(f"{sf.replace('0.001', '0.01')}/documents.parquet").select("doc_id", "text", "lang")
    extra = spark.createDataFrame([(10**6 + k, t, l) for k, (t, l) in enumerate([(GREEK, "el"), (JAPANESE, "ja"), (GREEK, None), (GREEK, "de"), (f"{EN} {GREEK}", "en"), (EN, "el")])], "doc_id bigint, text string, lang string")
    got = {(r.doc_id - 10**6, r.lang) for r in langid.corrected(docs.union(extra), "doc_id", "text", "lang").filter("doc_id >= 1000000").collect()}
    assert got == {(4, "en"), (5, "en")}


def test_whole_words_and_large_counts(profiles):
    tail = "x" * 200 + "the" * 30
    assert len(profiles._codes([tail])) == 1 and profiles.span[profiles.words[tail]][2] == len(langid.grams(tail))
    one, many = profiles.distances([EN.lower().split()])[0], profiles.distances([EN.lower().split() * 2000])[0]
    assert (one == many).all()  # counts beyond any small field keep the ranking


def test_scored_in_one_pass(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    plan = langid.corrected(docs, "doc_id", "text", "lang")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("MapInArrow") == 1


def test_split_of_a_batch_changes_nothing(spark, sf, profiles, monkeypatch):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    texts = [r.text for r in docs.orderBy("doc_id").collect()]
    whole = langid.judge(profiles, texts)
    assert whole == [langid.judge(profiles, [t])[0] for t in texts]
