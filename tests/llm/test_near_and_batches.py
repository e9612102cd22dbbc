"""Near-duplicates and batches against brute force."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

from feedloom.llm import batchdedup as B
from feedloom.llm import neardup
from feedloom.llm.common import words


def brute(rows, t):
    sets = {i: set(words("\n".join(f))) for i, *f in rows if all(x is not None and x.strip() for x in f)}
    sets = {i: s for i, s in sets.items() if s}
    ids = sorted(sets)
    return {(a, b) for k, a in enumerate(ids) for b in ids[k + 1 :] if len(sets[a] & sets[b]) >= t * len(sets[a] | sets[b]) - 1e-9}


def pairs(df, t, row_id="i", fields=("x", "y")):
    return {(r.seq_a, r.seq_b) for r in neardup.NearDuplicates(df, row_id, list(fields), t).pairs().collect()}


@pytest.mark.parametrize("share, t", [(0.002, 0.7), (0.05, 0.7), (0.3, 0.7), (0.05, 0.8), (0.9, 0.5)])
def test_edited_texts(spark, rng, share, t, monkeypatch):
    monkeypatch.setattr(neardup, "FREQUENT_SHARE", share)
    monkeypatch.setattr(neardup.frequent_words, "__defaults__", (share,))
    vocabulary = [f"w{i}" for i in range(400)]
    rows = []
    for i in range(120):
        base = rng.choices(vocabulary[:40] if i % 3 else vocabulary, k=rng.choice([4, 12, 40]))
        for _ in range(rng.choice([1, 1, 2, 4])):
            copy = [rng.choice(vocabulary) if rng.random() < rng.choice([0, 0.05, 0.2]) else w for w in base]
            rng.shuffle(copy)
            rows.append((len(rows), " ".join(copy[:2]), " ".join(copy[2:])))
    df = spark.createDataFrame(rows, "i bigint, x string, y string")
    assert pairs(df, t) == brute(rows, t)


def test_real_rows(spark, sf):
    df = spark.read.parquet(f"{sf}/normalized_item.parquet")
    rows = [(r.seq, r.title, r.content_snippet) for r in df.collect()]
    assert pairs(df, 0.7, "seq", ("title", "content_snippet")) == brute(rows, 0.7)


def test_copies_share_one_class(spark):
    rows = [(i, "Same title", "same words here") for i in range(60)] + [(100, "same TITLE here!", "<b>words</b> &amp; same"), (101, None, "same"), (102, " ", "same"), (103, "…", "!!"), (104, "long", "z" * 100_000)]
    df = spark.createDataFrame(rows, "i bigint, x string, y string").withColumn("id", F.lit(1)).withColumn("word", F.lit(1)).withColumn("rep", F.lit(1))
    near = neardup.NearDuplicates(df, "i", ["x", "y"], 0.7)
    assert near.pairs().count() == 61 * 60 // 2
    assert {(r.class_id, r.links) for r in near.groups().collect()} == {(0, 0)}
    assert pairs(df.limit(0), 0.7) == set()


def test_groups_join_chains(spark):
    rows = [(k, " ".join(f"w{i}" for i in range(k, k + 20)), "same end words") for k in range(0, 9, 2)]
    near = neardup.NearDuplicates(spark.createDataFrame(rows, "i bigint, x string, y string"), "i", ["x", "y"], 0.7)
    assert {r.id: r.class_id for r in near.groups().collect()} == dict.fromkeys(range(0, 9, 2), 0)


OLD = "tbl string, id bigint, title string, keys array<string>"
TITLE = "Does embryo glue alter anxiety scores among oocyte donors? The WIMREN-12 study in Zankel and Garcen"


def repeats(spark, old, new):
    frame = lambda rows: spark.createDataFrame(rows, OLD)
    return {(r.item_id, r.match_table, r.match_id) for r in B.repeats(frame(old), frame(new), {"garul medicine"}).collect()}


@pytest.mark.parametrize(
    "title, same",
    [(TITLE.upper(), True), ("Update: " + TITLE, True), (TITLE + " (online first)", True), (TITLE + " | Garul Medicine", True), ("<b>" + TITLE.replace(" and ", " &amp; ") + "</b>", True), (TITLE.replace("embryo", "embyro"), True),
     ("The WIMREN-12 study in Zankel and Garcen: does embryo glue alter anxiety scores among oocyte donors", True), (TITLE.replace("12", "13"), False), (TITLE + ", volume 4", False), (TITLE.replace("Zankel", "Ovrist"), False), (TITLE.replace("WIMREN", "FALTOR"), False), ("Meeting calendar", False), (None, False), ("", False)],
)
def test_titles(spark, title, same):
    assert (repeats(spark, [("history", 7, TITLE, [])], [("incoming_item", 1, title, [])]) == {(1, "history", 7)}) is same


def test_hot_article_and_recurring_columns(spark):
    column, short = "Letters to the editor of this journal", "Meeting calendar"
    old = [("history", i, TITLE, ["d:10.1234/one"] if i % 2 else []) for i in range(30)]
    old += [("history", 100 + i, column, [f"d:10.1234/c{i}"]) for i in range(20)] + [("history", 200 + i, short, [f"p:{i}"] if i % 2 else []) for i in range(4)]
    old += [("history", 300, "Embryo glue revisited", ["d:10.1234/e"]), ("history", 301, "Embryo glue revisited!", []), ("history", 302, "Untitled", []), ("history", 303, "Garul Medicine", [])]
    new = [("incoming_item", i, t, []) for i, t in enumerate([TITLE, TITLE.replace("embryo", "embyro"), column, column + " ", short, "EMBRYO glue revisited", "Embryo glue revisitd", "untitled", "Garul medicine"])]
    want = {(i, "history", k) for i in (0, 1) for k in range(30)} | {(5, "history", 300), (5, "history", 301)}
    assert repeats(spark, old, new) == want


def test_accepted_items_only(spark):
    new = [("incoming_item", 1, None, ["a"]), ("incoming_item", 2, None, ["a", "b"]), ("incoming_item", 3, None, ["b", "c"]), ("incoming_item", 4, None, ["c"]), ("incoming_item", 5, None, ["h"]), ("incoming_item", 6, None, ["h", "z"]), ("incoming_item", 7, None, ["z"]), ("incoming_item", 8, None, [])]
    assert repeats(spark, [("history", 1, None, ["h"])], new) == {(2, "incoming_item", 1), (4, "incoming_item", 3), (5, "history", 1), (6, "history", 1)}
    assert repeats(spark, [], []) == set()
    assert repeats(spark, [("history", 1, TITLE, ["h"])], []) == set()


def test_hot_key_and_order(spark):
    new = [("incoming_item", i, None, ["hot"]) for i in range(1, 300)]
    assert repeats(spark, [], new) == {(i, "incoming_item", 1) for i in range(2, 300)}


def test_pruning_loses_no_pair(spark, rng):
    names = [f"{a}{b}" for a in ("zan", "kel", "tor", "vol", "mi") for b in ("gar", "dre", "lum", "os", "fru")]
    base = [" ".join(["results", "from", "the", "registry", "of", *rng.sample(names, 5), "and", rng.choice(["aspirin", "vitamin", "glue"])]) for _ in range(60)]

    def misspelt(t):
        k = rng.randrange(1, len(t) - 1)
        return rng.choice([t[:k] + t[k + 1 :], t[:k] + t[k] + t[k:], t[: k - 1] + t[k] + t[k - 1] + t[k + 1 :]])

    texts = base + [misspelt(t) for t in base]
    rows = spark.createDataFrame([("incoming_item", i, t, []) for i, t in enumerate(texts)], OLD)
    table = B.Accepted.of(rows, set()).pivots
    got = {(r.name, r.other) for r in B.near_titles(table, table).collect()}
    w = {" ".join(B.title_words(t)): B.title_words(t) for t in texts}
    letters = lambda words: Counter(c for x in words for c in x if not c.isdigit())
    want = {(a, b) for a in w for b in w if a != b and B.same_title(w[a], w[b]) and sum(((letters(w[a]) - letters(w[b])) + (letters(w[b]) - letters(w[a]))).values()) <= B.RADIUS}
    assert len(want) > 20 and got == want


def test_url_writing(spark):
    urls = ["https://www.A.example/x/?utm_source=q#top", "HTTP://a.example/x", " https://m.a.example/x?ref=alert ", "https://a.example/x?id=2&cmp=weekly", "", None, "https://a.example/X?id=2"]
    got = [r.k for r in spark.createDataFrame([(u,) for u in urls], "u string").select(B.url_key(F.col("u")).alias("k")).collect()]
    assert got == ["a.example/x", "a.example/x", "a.example/x", "a.example/x?id=2", None, None, "a.example/x?id=2"]


def test_a_chain_takes_few_rounds(spark, monkeypatch):
    """Each item repeats its neighbour: two items a round would take hundreds of rounds."""
    jobs = []
    monkeypatch.setattr(B, "cut", lambda df, f=B.cut: (jobs.append(1), f(df))[1])
    new = [("incoming_item", i, None, [f"k{i}", f"k{i + 1}"]) for i in range(1, 601)]
    assert repeats(spark, [], new) == {(i, "incoming_item", j) for i in range(2, 601, 2) for j in (i - 1, i + 1) if j < i}
    assert len(jobs) < 20
    monkeypatch.setattr(B, "GROUP_ROWS", 4)  # too large for one task: round by round, with the same result
    small = [("incoming_item", i, None, [f"k{i}", f"k{i + 1}"]) for i in range(1, 8)]
    assert repeats(spark, [], small) == {(2, "incoming_item", 1), (4, "incoming_item", 3), (6, "incoming_item", 5)}


def test_all_assignments_of_misspelt_words():
    rest = ["one", "six", "ten", "two"]
    assert B.same_title(sorted(["bat", "bed", *rest]), sorted(["bad", "cat", *rest]))  # the first near word is not the right one
    assert not B.same_title(sorted(["bat", "dog", *rest]), sorted(["bad", "cat", *rest]))


@pytest.mark.parametrize("title", [TITLE + ": Update", TITLE + ": CORRECTED", "In Zankel and Garcen [abstract only]: " + TITLE.replace(" in Zankel and Garcen", ""), "[Video] " + TITLE, TITLE + " – Breaking"])
def test_notices_anywhere(title):
    assert B.title_words(title) == B.title_words(TITLE)
    assert B.title_words(TITLE + ": part 2") != B.title_words(TITLE) and B.title_words("News") == ["news"]


def test_stored_batches_give_what_all_at_once_give(spark, tmp_path, rng):
    old = [("history", i, TITLE.replace("12", str(i)), [f"d:10.1234/{i}"]) for i in range(100, 140)]
    new = []
    for i in range(1, 61):
        k = rng.randrange(100, 170)
        title = TITLE.replace("12", str(k))
        new.append(("incoming_item", i, rng.choice([title, title.replace("embryo", "embyro"), None]), rng.choice([[f"d:10.1234/{k}"], [], [f"u:{k % 7}.example"]])))
    frame = lambda rows: spark.createDataFrame(rows, OLD)
    whole = repeats(spark, old, new)
    path = str(tmp_path / "accepted")
    B.Accepted.of(frame(old), {"garul medicine"}).write(path)
    got = set()
    for k in range(0, 60, 20):
        got |= {(r.item_id, r.match_table, r.match_id) for r in B.accept(path, frame(new[k : k + 20]), {"garul medicine"}).collect()}
    assert got == whole and whole
    repeated = {i for i, *_ in whole}
    stored = B.Accepted.read(spark, path).keys.filter("tbl = 'incoming_item'").select("id").distinct().collect()
    assert {r.id for r in stored} == {r[1] for r in new if r[2] or r[3]} - repeated


def test_a_batch_reads_the_partitions_it_touches(spark, tmp_path, sf):
    from feedloom.llm import queries

    old, new, names = queries.batch_tables(spark, sf)
    path = str(tmp_path / "accepted")
    B.Accepted.of(old, names).write(path)
    stored = B.Accepted.read(spark, path)
    batch = B.Accepted.of(new.orderBy("id").limit(3), names)
    files = lambda df: len(set(df.inputFiles()))
    for name, part in (("pivots", stored.in_reach(batch.pivots)), ("keys", stored.only("keys", batch.keys.select("bucket")))):
        plan = part._jdf.queryExecution().executedPlan().toString()
        assert "PartitionFilters: [" in plan and "PartitionFilters: []" not in plan
        assert part.count() < getattr(stored, name).count()
    before = files(stored.keys)
    links = {(r.item_id, r.match_table, r.match_id) for r in B.accept(path, new.orderBy("id").limit(3), names).collect()}
    assert links == {(r.item_id, r.match_table, r.match_id) for r in B.repeats(old, new.orderBy("id").limit(3), names).collect()}
    assert 0 <= files(B.Accepted.read(spark, path).keys) - before <= 30
