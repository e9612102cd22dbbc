"""Every query of the package runs over whole tables and keeps its columns."""

import pytest
from pyspark.sql import functions as F

from feedloom.llm import registry

COLUMNS = {
    "p1_found": "group_seq doi summary_seq authors_seq", "p3_found": "seq field_name", "p4_found": "seq_a seq_b", "p5_found": "item_id match_table match_id",
    "p6_found": "source_table row_id", "p7_ids": "doc_id ids", "p8_found": "doc_id item_id", "p9_found": "doc_id lang",
}


@pytest.mark.parametrize("name", sorted(registry.QUERIES))
def test_query(spark, sf, name):
    df = registry.QUERIES[name](spark, sf)
    assert df.count() > 0
    if name in COLUMNS:
        assert df.columns == COLUMNS[name].split()
        assert df.count() == df.distinct().count()


def test_item_report(spark):
    from feedloom.llm import leakage

    passage = "one two three four five six seven eight nine ten eleven twelve thirteen"
    docs = spark.createDataFrame([(1, f"Read it. {passage} The key was 42."), (2, f"{passage} 421 of them"), (3, None), (4, f"{passage} nothing")], "doc_id bigint, text string")
    items = spark.createDataFrame([(7, "read it.", passage, "42"), (8, None, passage, None), (9, "x", None, "y")], "item_id bigint, prompt string, passage string, answer string")
    found = leakage.leaks(docs, "doc_id", "text", items, "item_id", "passage", "prompt", "answer")
    got = {r.item_id: (r.documents, r.with_answer, r.with_question) for r in leakage.item_report(found).collect()}
    assert got == {7: (3, 1, 1), 8: (3, 0, 0)}


def test_report_adds_up(spark, sf):
    report = registry.QUERIES["p3_source_report"](spark, sf).agg(F.sum("n_truncated")).first()[0]
    assert report == registry.QUERIES["p3_found"](spark, sf).count()
