"""Whether a summary is borne out by its evidence: row-local checks without Python."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from feedloom.functions.text import containment, contains_any, numbers, phrases_in, sentences, tokens, without_headers

# Study designs, causal claims and inferences that need support.
DESIGNS = ["randomized", "randomised", "prospective", "retrospective", "multicenter", "multicentre", "multi-center", "multi-centre", "single-center", "single-centre", "double-blind", "double blind", "placebo-controlled", "placebo controlled", "crossover", "cross-over", "case-control", "case control"]
CAUSAL = ["causes ", "caused by", "leads to", "results in", "we recommend", "clinicians should", "patients should", "the guideline", "standard of care", "should be offered", "should be considered first-line", "proves that", "demonstrates that", "confirms that"]
SPECULATIVE = ["strong inverse relationship", "strong positive relationship", "strong association", "could negatively impact", "could positively impact", "resulting in fewer transferable", "resulting in reduced", "significantly impair", "significantly reduce", "significantly increase", "dramatically reduc", "dramatically increas", "markedly improv", "markedly reduc", "clearly demonstrat", "unequivocally", "directly causes", "definitively shows"]


def unsupported_numbers(summary: Column, evidence: Column) -> Column:
    return F.array_sort(F.array_except(numbers(summary), numbers(evidence)))


def unsupported_phrases(summary: Column, evidence: Column, phrases: list[str]) -> Column:
    return F.array_except(phrases_in(summary, phrases), phrases_in(evidence, phrases))


def causal_fails(summary: Column, article_type: Column, confidence: Column) -> Column:
    return contains_any(summary, CAUSAL) & ((confidence == "low") | ~article_type.isin("original_research", "unknown"))


def checks(summary: Column, evidence: Column, article_type: Column, confidence: Column) -> Column:
    """Four results ``(rule, passed, items)``."""
    number, design, guess = unsupported_numbers(summary, evidence), unsupported_phrases(summary, evidence, DESIGNS), unsupported_phrases(summary, evidence, SPECULATIVE)
    made = lambda rule, passed, items: F.struct(F.lit(rule).alias("rule"), passed.alias("passed"), items.alias("items"))
    return F.array(
        made("numbers", F.size(number) == 0, number), made("designs", F.size(design) == 0, design),
        made("causal", ~causal_fails(summary, article_type, confidence), phrases_in(summary, CAUSAL)),
        made("inference", (F.size(guess) == 0) | ~confidence.isin("low", "medium"), guess),
    )


def labelled_sentences(summary: Column, evidence: Column, finding: Column, subject: Column) -> Column:
    """``(sentence, label, rule)`` of each sentence; the first rule that applies decides."""
    known = F.struct(numbers(evidence).alias("n"), phrases_in(evidence, DESIGNS).alias("d"), tokens(finding, 3).alias("t"))

    def label(s: Column, e: Column) -> Column:
        bad_number = F.size(F.array_except(numbers(s), e["n"])) > 0
        bad_design = F.size(F.array_except(phrases_in(s, DESIGNS), e["d"])) > 0
        found = (F.size(e["t"]) > 0) & (containment(tokens(s, 3), e["t"]) >= 0.60)
        named = (F.coalesce(subject, F.lit("")) != "") & F.contains(F.lower(s), F.lower(F.coalesce(subject, F.lit(""))))
        made = lambda name, rule: F.struct(s.alias("sentence"), F.lit(name).alias("label"), F.lit(rule).alias("rule"))
        return F.when(bad_number, made("unsupported", "number")).when(bad_design, made("unsupported", "design")).when(found, made("supported", "finding")).when(named, made("weakly_supported", "subject")).otherwise(made("weakly_supported", "unverified"))

    # what is known of the evidence is worked out once for each row, not once for each sentence
    return F.get(F.transform(F.array(known), lambda e: F.transform(sentences(without_headers(summary)), lambda s: label(s, e))), F.lit(0))


def filtered(text: Column, labels: Column) -> Column:
    """A text without its unsupported sentences, or unchanged if none would be left."""
    good = F.transform(F.filter(labels, lambda x: x["label"] != "unsupported"), lambda x: x["sentence"])
    kept = F.filter(sentences(text), lambda s: F.array_contains(good, s))
    return F.when(F.size(kept) > 0, F.array_join(kept, " ")).otherwise(text)


# What says nothing about a finding.
GENERIC = ["the topic is relevant", "readers are encouraged to consult", "relevant to fertility and reproductive medicine", "relevant to fertility"]
NO_FINDING = ["not available in the retrieved", "not reported in available text", "findings were not available", "could not be extracted", "detailed findings were not"]


def generic_reasons(title: Column, found: Column, matters: Column, is_fallback: Column) -> Column:
    """Why a summary says too little; an empty list if it does not."""
    a, b = tokens(title), tokens(found)
    same = (F.size(a) > 0) & (F.size(b) > 0) & (F.size(F.array_intersect(a, b)) / F.nullif(F.greatest(F.size(a), F.size(b)), F.lit(0)) >= 0.65)
    blank = F.trim(F.coalesce(found, F.lit(""))) == ""
    return F.array_compact(F.array(F.when(same, F.lit("restates_title")), F.when(contains_any(matters, GENERIC), F.lit("generic_relevance")), F.when(contains_any(found, NO_FINDING), F.lit("no_finding")), F.when(~is_fallback & blank, F.lit("empty_finding"))))
