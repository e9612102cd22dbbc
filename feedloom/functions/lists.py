"""Lists, maps and JSON as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def merged_tags(*lists: Column) -> Column:
    """All tags in order without blanks; of spellings that differ in case only the first stays."""
    flat = F.filter(F.transform(F.flatten(F.array(*[F.coalesce(x, F.array().cast("array<string>")) for x in lists])), lambda t: F.trim(t)), lambda t: t.isNotNull() & (t != ""))
    return F.aggregate(flat, F.array().cast("array<string>"), lambda acc, t: F.when(F.exists(acc, lambda y: F.lower(y) == F.lower(t)), acc).otherwise(F.concat(acc, F.array(t))))


def names(authors: Column, single: Column | None = None) -> Column:
    """Non-blank names, else the single author."""
    clean = F.filter(F.transform(F.coalesce(authors, F.array().cast("array<string>")), lambda a: F.trim(a)), lambda a: a.isNotNull() & (a != ""))
    if single is None:
        return clean
    return F.when(F.size(clean) > 0, clean).otherwise(F.filter(F.array(F.trim(single)), lambda a: a.isNotNull() & (a != "")))


def first_filled(blocks: Column) -> Column:
    return F.get(F.filter(blocks, lambda x: F.coalesce(x, F.lit("")) != ""), F.lit(0))


def json_object(c: Column) -> Column:
    """The text from the first brace to the last one, without code fences; null if there is none."""
    return F.nullif(F.regexp_extract(F.regexp_replace(F.coalesce(c, F.lit("")), r"```(?:json)?", ""), r"(?s)(\{.*\})", 1), F.lit(""))


def overlay(base: Column, over: Column) -> Column:
    """A map whose keys are replaced by those of another."""
    return F.map_concat(F.map_filter(base, lambda k, _: ~F.map_contains_key(over, k)), over)


def split_names(line: Column) -> Column:
    """The names of a line that commas separate; names that hold a comma fall apart."""
    return F.filter(F.transform(F.split(line, ","), lambda a: F.trim(a)), lambda a: a != "")


def evidence_text(fields: list[tuple[Column, Column]]) -> Column:
    """All values and what supports them as one text, in order, blanks and nulls left out."""
    parts = F.concat(*[F.concat(F.array(value), F.coalesce(support, F.array().cast("array<string>"))) for value, support in fields])
    return F.array_join(F.filter(parts, lambda x: F.coalesce(x, F.lit("")) != ""), " ")
