"""Weighted scores, topic rankings and rule cascades, generated from ordered lists."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from feedloom.functions.text import has_word

# Terms of methodical rigour.
RIGOUR = ("randomized", "randomised", "clinical trial", "prospective", "cohort", "systematic review", "meta-analysis", "longitudinal", "peer-reviewed", "placebo", "double-blind", "multicenter", "statistical significance", "odds ratio", "relative risk", "hazard ratio", "confidence interval", "p-value", "p <", "pubmed", "doi:")

# Title patterns in order, and the type of the first that matches.
TITLE_TYPES = (
    (r"\bretraction\b|\bretracted\b", "retraction"), (r"\bcorrigendum\b|\berratum\b|\berrata\b", "erratum"),
    (r"\bcorrection\b($|[^ ]| ($|[^o])| o($|[^f]))", "correction"), (r"\bexpression of concern\b", "retraction"),
    (r"\bsystematic review\b.*\bmeta.?analysis\b|\bmeta.?analysis\b.*\bsystematic review\b", "meta_analysis"), (r"\bsystematic review\b", "systematic_review"),
    (r"\bmeta.?analysis\b", "meta_analysis"), (r"\brandomized controlled trial\b|\brct\b", "rct"), (r"\bprospective cohort\b|\bcohort study\b", "cohort_study"),
    (r"\bretrospective\b.*\bstudy\b|\bcase.control\b", "observational_study"), (r"\bcase report\b|\bcase series\b", "case_report"),
    (r"\bguidelines?\b|\bclinical practice\b", "guideline"), (r"\bletter to the editor\b|\bletter:\s", "letter"), (r"\beditorial\b|\beditor.?s note\b", "editorial"),
    (r"\bcommentary\b|\bperspective\b|\bviewpoint\b", "commentary"), (r"\breview article\b|\bnarrative review\b", "review"), (r"\breview\b", "review"),
)

# What marks a correction.
CORRECTION = r"\b(correction|erratum|errata|retraction|retracted|corrigendum|expression\s+of\s+concern|publisher.s\s+note)\b"


def total(parts: list[Column]) -> Column:
    """A sum from left to right in double precision."""
    return reduce(lambda a, b: a + b, parts, F.lit(0.0))


def hits(text: Column, weights: dict[str, float]) -> Column:
    """The weights of all keywords that lower-cased text holds, added in the order of the dictionary."""
    low = F.lower(F.coalesce(text, F.lit("")))
    return total([F.when(F.contains(low, F.lit(k.lower())), F.lit(float(w))).otherwise(F.lit(0.0)) for k, w in weights.items()])


def rigour(text: Column, length: Column) -> Column:
    bonus = F.when(length > 1000, 2.0).when(length > 400, 0.5).otherwise(0.0)
    return F.least(hits(text, dict.fromkeys(RIGOUR, 1.5)) + bonus, F.lit(10.0))


def relevance(text: Column, weights: dict[str, float], buckets: dict[str, list[str]]) -> Column:
    low = F.lower(F.coalesce(text, F.lit("")))
    any_of = lambda words: reduce(lambda a, w: a | F.contains(low, F.lit(w)), words, F.lit(False))
    return F.least(hits(text, {k: w * 0.3 for k, w in weights.items()}) + total([F.when(any_of(w), 1.0).otherwise(0.0) for w in buckets.values()]), F.lit(10.0))


def impact(rigour_: Column, relevance_: Column, occurrences: Column, length: Column, age: Column, multiplier: float = 2.0, long_enough: int = 300) -> Column:
    recent = F.when(age <= 1, 2.0).when(age <= 3, 1.0).otherwise(0.0)
    return F.lit(0.4) * rigour_ + F.lit(0.6) * relevance_ + occurrences * F.lit(multiplier) + F.when(length > long_enough, 1.0).otherwise(0.0) + recent


def topics(text: Column, dictionary: dict[str, list[str]], priority: list[str], least: int = 1, most: int = 3) -> Column:
    """``(primary, others)``: topics by word hits, then by priority, then by the order of the dictionary."""
    entries = []
    for place, (name, words) in enumerate(dictionary.items()):
        n = reduce(lambda a, w: a + F.when(has_word(text, w), 1).otherwise(0), words, F.lit(0))
        rank = priority.index(name) if name in priority else 9999
        entries.append(F.struct((-n).alias("minus"), F.lit(rank).alias("rank"), F.lit(place).alias("place"), F.lit(name).alias("topic")))
    ranked = F.transform(F.array_sort(F.filter(F.array(*entries), lambda e: -e["minus"] >= least)), lambda e: e["topic"])
    return F.struct(F.coalesce(F.get(ranked, F.lit(0)), F.lit("general")).alias("primary"), F.slice(ranked, 2, most - 1).alias("others"))


def first_match(text: Column, rules: list[tuple[str, str]] | tuple, default: str | None = None) -> Column:
    """The label of the first pattern that lower-cased text matches."""
    low = F.lower(F.coalesce(text, F.lit("")))
    return F.coalesce(*[F.when(low.rlike(p), F.lit(label)) for p, label in rules], F.lit(default))


def evidence_sufficiency(quality: Column, filled: dict[str, Column], numeric: Column) -> Column:
    """Additive score of what an evidence record holds; the order of the additions is part of the result."""
    weight = {"population": 0.05, "sample_size": 0.10, "study_design": 0.05, "intervention": 0.05, "outcomes": 0.05, "findings": 0.10}
    parts = [F.when(quality == "full_text", 0.50).when(quality == "abstract", 0.30).otherwise(0.0)]
    parts += [F.when(filled[k], w).otherwise(0.0) for k, w in weight.items()]
    parts += [F.when(filled["findings"] & numeric, 0.05).otherwise(0.0), F.when(filled["limitations"], 0.05).otherwise(0.0)]
    return F.least(total(parts), F.lit(1.0))


def text_quality(length: Column) -> Column:
    return F.when(length < 300, "snippet_only").when(length < 2000, "abstract").otherwise("full_text")


def is_correction(title: Column) -> Column:
    return F.lower(F.coalesce(title, F.lit(""))).rlike(CORRECTION)


def staged_type(title: Column, content: Column, explicit: list[tuple[str, str]], rules: tuple, prior: Column, default: str) -> Column:
    """The first stage that knows a type: configured patterns over title and text, the rules over the title, the rules over
    both, the type known before, the default."""
    probe = F.concat(F.coalesce(title, F.lit("")), F.lit(" "), F.substring(F.coalesce(content, F.lit("")), 1, 500))
    before = F.lower(F.trim(F.coalesce(prior, F.lit(""))))
    stages = ([first_match(probe, explicit)] if explicit else []) + [first_match(title, rules), first_match(probe, rules), F.when(~before.isin("", "unknown"), before)]
    return F.coalesce(*stages, F.lit(default))


def type_by_hints(title: Column, content: Column, source: Column, sources: dict[str, str], hints: dict[str, list[str]]) -> Column:
    """A type by the first name that the source holds, else by the first list with a phrase in the text, else ``unknown``."""
    low, body = F.lower(F.coalesce(source, F.lit(""))), F.lower(F.concat(F.coalesce(title, F.lit("")), F.lit(" "), F.coalesce(content, F.lit(""))))
    rules = [F.when(F.contains(low, F.lit(name)), F.lit(kind)) for name, kind in sources.items()]
    rules += [F.when(reduce(lambda a, w: a | F.contains(body, F.lit(w)), words, F.lit(False)), F.lit(kind)) for kind, words in hints.items()]
    return F.coalesce(*rules, F.lit("unknown"))


def tier_estimate(length: Column, kind: Column) -> Column:
    """The tier that length and type suggest before anything is known of the evidence."""
    return F.when(length < 100, "titles_to_watch").when((length < 300) | kind.isin("editorial", "commentary"), "short_blurb").otherwise("full")


def tier_penalty(tier: Column) -> Column:
    return F.when(tier == "full", 0.0).when(tier == "short_blurb", -2.0).otherwise(-6.0)


def top_topic(text: Column, dictionary: dict[str, list[str]]) -> Column:
    """The topic with the most keywords in lower-cased text, the first of equals; ``general`` without any."""
    low = F.lower(F.coalesce(text, F.lit("")))
    hit = [F.struct(reduce(lambda a, w: a + F.when(F.contains(low, F.lit(w)), 1).otherwise(0), words, F.lit(0)).alias("n"), F.lit(-k).alias("place"), F.lit(name).alias("topic")) for k, (name, words) in enumerate(dictionary.items())]
    best = F.array_max(F.array(*hit))
    return F.when(best["n"] > 0, best["topic"]).otherwise("general")
