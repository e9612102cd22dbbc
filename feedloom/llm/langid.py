"""Languages of texts and of their parts: rank-order n-gram profiles and the out-of-place distance.

A profile is the ranking of a language's most frequent letter n-grams.  Profiles are fitted on a bounded sample of
labelled rows (``SAMPLE`` for each language, by a hash of the identifier) in two rounds: the second one counts only
sentences that the first profiles give the language of their label, so that wrong labels and foreign passages leave
no trace.  Everything else covers every row: each sentence is ranked and compared with every profile, sentences form
segments, and a document holds the languages of its segments.

Texts are scored once: languages of a document, the comparison with its label and the output all come from one pass
over Arrow batches, without a shuffle of the result.

Defined results: null and empty texts and texts without words have no language; neither has a sentence of which
fewer than ``LEAST_KNOWN`` of the n-grams occur in any profile (another script), so that such a text is no case whatever
its label names; a label is missing if it is null, blank or a code for unknown, whatever its writing; a language without
labelled rows cannot be recognised, and one that is written in the letters of a profiled one is taken for it; sentences
that lie equally far from two languages follow the main language of their text; ties go to the language that comes first
by name; repeated rows are judged alike, each by itself; texts are read whole, whatever the length of their words.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from feedloom.llm.common import cut, plain, spread

# The languages and how labels write them.
LANGUAGES = {
    "de": "de deu ger german deutsch", "en": "en eng english", "es": "es spa spanish español espanol castellano", "fr": "fr fra fre french français francais",
    "it": "it ita italian italiano", "nl": "nl nld dut dutch nederlands", "pt": "pt por portuguese português portugues", "ru": "ru rus russian русский",
}
# Codes for an unknown language.
UNKNOWN = ("", "und", "unknown", "xx", "zxx", "mul", "mis", "n/a", "na", "none", "null", "-", "?", "??", "other", "undefined", "undetermined", "auto")

#: Labelled rows of each language that the profiles are fitted on, and the n-grams of a profile.
SAMPLE, PROFILE, LONGEST = 300, 600, 3
#: Words of a sentence that is judged by itself, and of a passage that counts.
LEAST_WORDS, PASSAGE = 6, 10
#: A sentence of which a smaller share of the n-grams is in any profile is in none of the languages.
LEAST_KNOWN = 0.5
#: Texts, and letters, that are scored together.
TEXTS, LETTERS = 250, 1_500_000
#: The bits that number the n-grams of all profiles.
GRAM_BITS = (len(LANGUAGES) * PROFILE).bit_length()
#: Words whose n-grams are remembered.
CACHED = 1 << 17
#: By this share the distance to the document's main language must exceed that to another one.
MARGIN = 0.06

_WORD = re.compile(r"[^\W\d_]+(?:['’][^\W\d_]+)*")
_BREAK = re.compile(r"<br\s*/?>|</?(?:p|div|li|h\d)[^<>]*>", re.I)
_NOISE = re.compile(r"https?://\S+|www\.\S+|[#@]\w+|\S+@\S+")
_WRAPPED = re.compile(r"(?<![.!?…:\s])[ \t]*\r?\n(?=[^\W\dA-ZÀ-ÞА-Я_])")
_SENTENCE = re.compile(r"(?<=[.!?…])[\"'”’»)\]]*\s+|[\n\r  ]+|\s[|•·]\s")


def label_of(label: Column) -> Column:
    """The language that a label names: a code of ``LANGUAGES``, ``other``, or null if it is missing."""
    x = F.lower(F.regexp_replace(F.coalesce(label, F.lit("")), r"(?U)^\s+|\s+$", ""))
    base = F.regexp_extract(x, r"^([\p{L}?/]+|-)", 1)
    known = F.create_map(*[F.lit(v) for code, names in LANGUAGES.items() for name in names.split() for v in (name, code)])
    return F.when(x.isin(*UNKNOWN) | base.isin(*UNKNOWN), F.lit(None)).otherwise(F.coalesce(F.try_element_at(known, x), F.try_element_at(known, base), F.lit("other")))


def sentences(text: str | None) -> list[list[str]]:
    """The words of each sentence or line, in lower case, without mark-up, links, tags and numbers."""
    if not text:
        return []
    # a pattern runs only where what it needs occurs
    if "<" in text:
        text = _BREAK.sub("\n", text)
    if "\n" in text:
        text = _WRAPPED.sub(" ", text)
    t = plain(text)
    if "#" in t or "@" in t or "http" in t or "www." in t:
        t = _NOISE.sub(" ", t)
    return [w for s in _SENTENCE.split(t) if (w := _WORD.findall(s))]


def grams(word: str) -> list[str]:
    w = f"_{word}_"
    return [w[i : i + n] for n in range(1, LONGEST + 1) for i in range(len(w) - n + 1) if w[i : i + n] != "_"]


class Profiles:
    """The rankings of all languages as one matrix, and the vectorised distance of many sentences to them."""

    def __init__(self, ranked: dict[str, list[str]]):
        self.langs = sorted(ranked)
        names = sorted({g for r in ranked.values() for g in r})
        self.index = {g: i for i, g in enumerate(names)}
        # an n-gram that a language does not rank lies beyond every rank: its distance is the largest one
        self.ranks = np.full((len(self.langs), len(names)), 3 * PROFILE, np.int32)
        for k, lang in enumerate(self.langs):
            self.ranks[k, [self.index[g] for g in ranked[lang]]] = np.arange(len(ranked[lang]))
        self.lead = self.ranks.min(0, initial=PROFILE).astype(np.int64)
        self._forget()

    def _forget(self) -> None:
        """An empty cache: for each word where its profiled n-grams lie in one array, and how many it has of all kinds."""
        self.words: dict[str, int] = {}
        self.flat, self.span = np.zeros(0, np.int32), np.zeros((0, 3), np.int64)

    def _codes(self, words: list[str]) -> np.ndarray:
        if len(self.words) > CACHED:
            self._forget()
        known = self.words
        if missing := set(words).difference(known):
            flat, span, at = [self.flat], [], len(self.flat)
            for w in missing:
                all_ = grams(w)
                found = [i for g in all_ if (i := self.index.get(g)) is not None]
                known[w] = len(known)
                span.append((at, len(found), len(all_)))
                flat.append(np.array(found, np.int32))
                at += len(found)
            self.flat, self.span = np.concatenate(flat), np.concatenate([self.span, np.array(span, np.int64)])
        return np.fromiter(map(known.__getitem__, words), np.int64, len(words))

    def distances(self, units: list[list[str]]) -> tuple[np.ndarray, np.ndarray]:
        """(sentences, languages): the mean out-of-place distance of the n-grams that any profile ranks; and for each
        sentence the share of its n-grams that one does."""
        out, share = np.full((len(units), len(self.langs)), float(PROFILE)), np.zeros(len(units))
        words = [w for u in units for w in u]
        if not words or not self.index:
            return out, share
        codes = self._codes(words)
        start, size, of_all = self.span[codes].T
        at = np.repeat(np.arange(len(units)), [len(u) for u in units])
        share = np.bincount(at, size, len(units)) / np.maximum(np.bincount(at, of_all, len(units)), 1)
        ids = self.flat[np.arange(size.sum()) + np.repeat(start - (size.cumsum() - size), size)]
        key = np.sort(np.repeat(at.astype(np.int32 if len(units) < 1 << 18 else np.int64) << GRAM_BITS, size) | ids)
        if not len(key):
            return out, share
        first = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
        n, key = np.diff(np.r_[first, len(key)]), key[first].astype(np.int64)
        of, gram = key >> GRAM_BITS, key & ((1 << GRAM_BITS) - 1)
        # by sentence, then the most frequent first, then the best ranked
        if len(units) < 1 << 20 and n.max() < 1 << 20:  # one integer for each n-gram of a sentence
            packed = np.sort(((of << 20 | ((1 << 20) - 1 - n)) << 10 | self.lead[gram]) << GRAM_BITS | gram)
            of, gram = packed >> (30 + GRAM_BITS), packed & ((1 << GRAM_BITS) - 1)
        else:
            order = np.lexsort((gram, self.lead[gram], -n, of))
            of, gram = of[order], gram[order]
        first = np.flatnonzero(np.r_[True, of[1:] != of[:-1]])
        count = np.diff(np.r_[first, len(of)])
        rank = np.minimum(np.arange(len(of)) - np.repeat(first, count), 2 * PROFILE).astype(np.int32)
        here = of[first]
        for k in range(len(self.langs)):
            out[here, k] = np.add.reduceat(np.minimum(np.abs(self.ranks[k, gram] - rank), PROFILE), first) / count
        return out, share


def judged(profiles: Profiles, texts: list[str | None]) -> tuple[np.ndarray, ...]:
    """The segments of many texts in order: text, language (one more than there are for none), words, confidence, and the
    main language of each text.  Neighbours of one language are one segment; short ones of another language are left out."""
    units, own = [], []
    for k, t in enumerate(texts):
        found = sentences(t)
        units += found
        own += [k] * len(found)
    none = len(profiles.langs)
    if not units or not none:
        return (*(np.zeros(0, np.int64) for _ in range(3)), np.zeros(0), np.full(len(texts), none))
    own, (d, share) = np.array(own), profiles.distances(units)
    words, row = np.array([len(u) for u in units]), np.arange(len(units))
    best = d.argmin(1)
    two = np.partition(d, 1, axis=1)[:, :2] if none > 1 else np.c_[d, np.full(len(d), float(PROFILE))]
    foreign, unsure = share < LEAST_KNOWN, two[:, 0] >= two[:, 1]
    lang, long = np.where(foreign | unsure, none, best), words >= LEAST_WORDS
    weight = words * np.where(np.bincount(own, long, len(texts))[own] > 0, long, 1)
    main = np.bincount(own * (none + 1) + lang, weight, len(texts) * (none + 1)).reshape(len(texts), none + 1).argmax(1)
    to = main[own]
    d = np.c_[d, np.full(len(d), np.inf)]
    follows = ~long | (unsure & ~foreign) | (~foreign & (d[row, to] < d[row, lang] * (1 + MARGIN)))
    lang = np.where(follows, to, lang)
    other = np.where(lang == best, two[:, 1], two[:, 0])
    sure = np.where(lang < none, np.clip(1 - np.minimum(d[row, lang], PROFILE) / np.maximum(other, 1e-9), 0, 1), 0.0)
    first = np.flatnonzero(np.r_[True, (own[1:] != own[:-1]) | (lang[1:] != lang[:-1])])
    n = np.add.reduceat(words, first)
    sure = np.add.reduceat(sure * words, first) / n
    own, lang = own[first], lang[first]
    keep = (lang == main[own]) | (n >= PASSAGE)
    return own[keep], lang[keep], n[keep], sure[keep], main


def judge(profiles: Profiles, texts: list[str | None]) -> list[list[tuple[str, int, float]]]:
    """For each text its segments ``(language, words, confidence)`` in order."""
    out: list[list[tuple[str, int, float]]] = [[] for _ in texts]
    own, lang, n, sure, _ = judged(profiles, texts)
    for o, l, k, s in zip(own.tolist(), lang.tolist(), n.tolist(), sure.tolist()):
        if l < len(profiles.langs):
            out[o].append((profiles.langs[l], k, round(s, 6)))
    return out


def fit(docs: DataFrame, doc_id: str, text: str, label: str, sample: int = SAMPLE) -> Profiles:
    """Profiles from at most ``sample`` labelled rows of each language."""
    rows = docs.select(F.col(doc_id).cast("bigint").alias("i"), F.col(text).cast("string").alias("t"), label_of(F.col(label)).alias("l")).filter(F.col("l").isin(*LANGUAGES) & F.col("t").isNotNull())
    order = Window.partitionBy("l").orderBy(F.xxhash64("i"), "i")
    rows = cut(rows.withColumn("k", F.row_number().over(order)).filter(F.col("k") <= sample).select("l", "t"))

    def ranked(before: Profiles | None) -> Profiles:
        def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            seen: dict[str, Counter] = {}
            for b in batches:
                for lang, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                    units = sentences(t)
                    if before is not None and units and lang in before.langs:
                        best = before.distances(units)[0].argmin(1)
                        units = [u for u, x in zip(units, best) if before.langs[x] == lang]
                    seen.setdefault(lang, Counter()).update(w for u in units for w in u)
            for lang, n_words in seen.items():
                n: Counter = Counter()
                for w, times in n_words.items():
                    for g in grams(w):
                        n[g] += times
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(n), pa.string()), pa.array(list(n.keys()), pa.string()), pa.array(list(n.values()), pa.int64())], ["l", "g", "n"])

        n = rows.mapInArrow(count, "l string, g string, n bigint").groupBy("l", "g").agg(F.sum("n").alias("n"))
        top = n.withColumn("k", F.row_number().over(Window.partitionBy("l").orderBy(F.desc("n"), "g"))).filter(F.col("k") <= PROFILE).select("l", "k", "g").collect()
        ranking: dict[str, list[str]] = {}
        for r in sorted(top):
            ranking.setdefault(r.l, []).append(r.g)
        return Profiles(ranking)

    return ranked(ranked(None))


def _scored(docs: DataFrame, doc_id: str, text: str, label: str | None, profiles: Profiles, rows, schema: str) -> DataFrame:
    """Each text once through :func:`judged`, a bounded number of texts and letters at a time; ``rows`` makes the columns
    after ``doc_id`` from its result: the place of the text, then one array for each."""
    shared = docs.sparkSession.sparkContext.broadcast(profiles)  # at most PROFILE n-grams of each language
    names, kinds = zip(*(c.split() for c in schema.split(", ")))
    types = {"bigint": pa.int64(), "int": pa.int32(), "string": pa.string(), "double": pa.float64()}

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts, labels, begin, size = b.column(1).to_pylist(), b.column(2).to_pylist(), 0, 0
            for k in range(len(texts)):
                size += len(texts[k] or "")
                if k + 1 == len(texts) or k + 1 - begin == TEXTS or size >= LETTERS:
                    at, *cols = rows(shared.value, judged(shared.value, texts[begin : k + 1]), labels[begin : k + 1])
                    if len(at):
                        yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(at + begin)), *[pa.array(c, types[t]) for c, t in zip(cols, kinds[1:])]], list(names))
                    begin, size = k + 1, 0

    docs = docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).cast("string").alias("text"), (label_of(F.col(label)) if label else F.lit(None).cast("string")).alias("label"))
    return spread(docs, "doc_id").mapInArrow(each, schema)


def segments(docs: DataFrame, doc_id: str, text: str, profiles: Profiles) -> DataFrame:
    """``(doc_id, segment, lang, n_words, confidence)`` of every part of every text; row-local."""

    def rows(p: Profiles, found: tuple, _) -> tuple:
        own, lang, n, sure, _ = (x[found[1] < len(p.langs)] if k < 4 else x for k, x in enumerate(found))
        first = np.searchsorted(own, own)
        return own, np.arange(len(own)) - first, [p.langs[k] for k in lang], n, np.round(sure, 6)

    return _scored(docs, doc_id, text, None, profiles, rows, "doc_id bigint, segment int, lang string, n_words int, confidence double")


def corrected(docs: DataFrame, doc_id: str, text: str, label: str) -> DataFrame:
    """``(doc_id, lang, n_words, confidence)``: the languages of every text whose label is missing or names another
    language than its own, or that holds more than one."""

    def rows(p: Profiles, found: tuple, labels: list[str | None]) -> tuple:
        own, lang, n, sure, _ = found
        none, size = len(p.langs), (len(labels), len(p.langs) + 1)
        words = np.bincount(own * (none + 1) + lang, n, size[0] * size[1]).reshape(size)
        total = np.bincount(own * (none + 1) + lang, sure * n, size[0] * size[1]).reshape(size)
        place = {x: k for k, x in enumerate(p.langs)} | {None: -2}
        own_label, main = np.array([place.get(x, -1) for x in labels]), words.argmax(1)
        wrong = np.where(main < none, own_label != main, own_label == -2)
        case = wrong | ((words > 0).sum(1) > 1)
        at, which = np.nonzero((words > 0) & case[:, None] & (np.arange(none + 1) < none))
        return at, [p.langs[k] for k in which], words[at, which].astype(np.int64), np.round(total[at, which] / words[at, which], 6)

    return _scored(docs, doc_id, text, label, fit(docs, doc_id, text, label), rows, "doc_id bigint, lang string, n_words bigint, confidence double")
