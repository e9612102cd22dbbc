"""The text interchange format: one block an article, ``Key: value`` lines and a content that runs to a line of ``=``."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from feedloom.functions.text import strip

FIELDS = ("Title", "URL", "Source", "Authors", "Published", "Updated", "Freshness Date", "Fetched At", "First Seen", "Date Source", "Used Fallback Date", "Freshness Confidence", "Occurrences", "Content Length")
RULE = "=" * 80


def write_blocks(df: DataFrame, number: str, fields: dict[str, Column], content: Column) -> DataFrame:
    """``(number, block)``: the text of each article; null values are left out."""
    lines = [F.when(c.isNotNull(), F.concat(F.lit(f"{name}: "), F.regexp_replace(c.cast("string"), r"[\r\n]+", " "))) for name, c in fields.items()]
    head = F.concat(F.lit("Article "), F.col(number).cast("string"), F.lit("\n" + "-" * 40))
    return df.select(F.col(number).cast("bigint").alias("number"), F.concat_ws("\n", head, *lines, F.concat(F.lit("Content:\n"), F.coalesce(content, F.lit(""))), F.lit(RULE)).alias("block"))


def document(blocks: DataFrame, header: str = "") -> DataFrame:
    """All blocks as one text, in order: for export of a bounded issue."""
    ordered = F.transform(F.array_sort(F.collect_list(F.struct("number", "block"))), lambda x: x["block"])
    return blocks.agg(F.concat(F.lit(header + "\nARTICLE DETAILS\n" + RULE + "\n"), F.array_join(ordered, "\n")).alias("text"))


def parse_blocks(df: DataFrame, text: str, fields: tuple[str, ...] = FIELDS) -> DataFrame:
    """One row an article from texts that hold blocks: ``number``, a column for each field, and ``content``."""
    body = F.regexp_replace(F.coalesce(F.col(text), F.lit("")), r"(?s)^.*?ARTICLE DETAILS\s*\n=+\n", "")
    each = df.select(F.explode(F.split(F.concat(F.lit("\n"), body), r"\n(?=Article \d+\n-{3,})")).alias("_b")).filter(F.col("_b").rlike(r"(?s)^\s*Article \d+\n-{3,}"))
    head = F.regexp_extract("_b", r"(?s)^(.*?)(?:\nContent:|$)", 1)
    name = lambda f: f.lower().replace(" ", "_")
    found = [F.nullif(strip(F.regexp_extract(head, rf"(?m)^{f}: (.*)$", 1)), F.lit("")).alias(name(f)) for f in fields]
    content = F.regexp_extract("_b", r"(?s)\nContent:[ \t]*\n?(.*?)(?:\n[ \t]*=.*)?$", 1)
    return each.select(F.regexp_extract("_b", r"Article (\d+)", 1).cast("bigint").alias("number"), *found, F.regexp_replace(content, r"\s+$", "").alias("content"))


def read_blocks(spark: SparkSession, path: str, fields: tuple[str, ...] = FIELDS) -> DataFrame:
    return parse_blocks(spark.read.text(path, wholetext=True), "value", fields)


def in_sections(lines: DataFrame, text: str, line: str, key: str) -> DataFrame:
    """``lines`` with ``section``: the last heading (``=== … ===``) before a line of a document, ``''`` before the first."""
    from pyspark.sql.window import Window

    head = F.when(F.trim(F.col(text)).rlike("^={3} .* ={3}$"), F.trim(F.col(text)))
    running = F.last(head, ignorenulls=True).over(Window.partitionBy(key).orderBy(line))
    return lines.withColumn("section", F.coalesce(running, F.lit("")))


def script_titles(lines: DataFrame, text: str, line: str, key: str) -> DataFrame:
    """Titles of a script: ``Story N: t`` before the quick hits, ``• t`` in them, until the next section."""
    tagged = in_sections(lines, text, line, key).withColumn("_t", F.trim(F.col(text)))
    story = F.nullif(F.regexp_extract("_t", r"^Story \d+: (.+)$", 1), F.lit(""))
    quick = F.nullif(F.regexp_extract("_t", r"^• (.+)$", 1), F.lit(""))
    title = F.when(F.col("section") == "=== QUICK HITS ===", quick).otherwise(story)
    return tagged.select(key, line, title.alias("title")).filter("title is not null")
