"""Test items that occur in a corpus: a BM25 inverted index of the items, searched with block-max upper bounds.

The items are the indexed side, every passage of the corpus is a query.  Terms are pairs of neighbouring words: lists of
single words grow with the number of items, those of pairs hardly do.  A passage that holds ``RUN`` consecutive words
of an item scores at least the smallest score that any such run of the item has by itself; that is the item's threshold,
so all passages above it are a superset of the true cases.  Contributions are stored divided by the item's threshold:
one bound, 1, serves all.

Skipping is that of WAND with block maxima, for all passages of a batch of texts at once: of the terms of a passage, those
with the smallest upper bounds that together stay below 1 cannot make a candidate by themselves, and their lists are not
walked; of the lists of the others the blocks are looked at first, and only postings of blocks whose maxima can reach 1
are scored; what is left is looked up in the lists of the first terms.  So the work follows the lists of a passage's rare
terms and not the number of items.  Blocks are ranges of items common to all terms, so that their maxima add up.

Candidates are verified on letters alone, so that hyphens at line ends, mark-up within words and spacing make no
difference; whether a text also holds the item's answer and question is told of each verified pair.

Items are searched in blocks of at most ``MAX_ITEMS`` of them, so what is shipped to the tasks stays bounded; an index
is built once in each Python worker.

Defined results: null and empty texts hold nothing; an item whose passage has fewer than ``RUN`` words cannot leak;
repeated texts are reported alike, and rows with the same identifiers once; texts are read whole.
"""

from __future__ import annotations

import math
import re
import uuid
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedloom.llm.common import plain, spread

#: Consecutive words of a passage that count as a leak.
RUN = 12
#: Words of a query passage, and those that it shares with its neighbour: every run lies within one.
SPAN, SHARED = 36, RUN
#: Items of a block, items of one index, characters of its passages.
BLOCK, MAX_ITEMS, MAX_CHARS = 16, 20_000, 20_000_000
#: Texts, and letters, that are searched together.
TEXTS, LETTERS = 250, 1_500_000
#: Words of the pieces by which a run is looked for before it is compared as a whole: every run holds one.
PIECE = RUN // 2
K1, B = 1.2, 0.75
#: What rounding may take from a bound.
ENOUGH = 1 - 1e-9

_WORD = re.compile(r"[^\W_]+")
_INLINE = re.compile(r"(?<=\w)(?:</?[A-Za-z][^<>]*>|[*_`~]+)(?=\w)")
_BROKEN = re.compile(r"(\w+)[-‐‑]\s*\n\s*(\w+)")


def clean(text: str) -> str:
    return plain(_INLINE.sub("", text))


def letters(text: str) -> str:
    """Letters and digits alone."""
    return "".join(_WORD.findall(text))


def _ranges(first: np.ndarray, n: np.ndarray) -> np.ndarray:
    """``first[k], first[k] + 1, …`` of ``n[k]`` numbers each, one after the other."""
    return np.arange(n.sum()) + np.repeat(first - (n.cumsum() - n), n)


class Items:
    """The index: for each term its items in order, their contributions, and the largest of each block.

    Terms are numbered by their largest contribution, the smallest first.
    """

    def __init__(self, items: list[tuple]):
        docs = [(row, w) for row in sorted(items, key=lambda r: r[0]) if len(w := _WORD.findall(clean(row[1] or ""))) >= RUN]
        self.ids = [row[0] for row, _ in docs]
        self.asked = [(self._words(row[2]), self._words(row[3])) if len(row) > 3 else ("", "") for row, _ in docs]
        self.word = {t: k for k, t in enumerate(sorted({t for _, w in docs for t in w}))}
        pairs = [list(zip(w, w[1:])) for _, w in docs]
        n, mean = len(docs), sum(map(len, pairs)) / max(1, len(docs))
        df = Counter(t for x in pairs for t in set(x))
        idf = {t: math.log(1 + (n - k + 0.5) / (k + 0.5)) for t, k in df.items()}
        lists: dict[tuple[str, str], list[tuple[int, float]]] = {}
        self.text: list[tuple[str, list[int]]] = []  # letters, and where each word begins
        for at, ((_, w), terms) in enumerate(zip(docs, pairs)):
            part = {t: idf[t] * k * (K1 + 1) / (k + K1 * (1 - B + B * len(terms) / mean)) for t, k in Counter(terms).items()}
            # the least score of a run, of one run after the other
            inside = Counter(terms[: RUN - 1])
            least = score = sum(part[t] for t in inside)
            for new, old in zip(terms[RUN - 1 :], terms):
                inside[new] += 1
                score += part[new] if inside[new] == 1 else 0.0
                inside[old] -= 1
                score -= part[old] if not inside[old] else 0.0
                least = min(least, score)
            for t, x in part.items():
                lists.setdefault(t, []).append((at, x / (least - 1e-12)))
            self.text.append(("".join(w), np.cumsum([0, *map(len, w)]).tolist()))
        order = sorted(lists, key=lambda t: (max(x for _, x in lists[t]), t))
        names = np.array([self.word[a] * len(self.word) + self.word[b] for a, b in order], np.int64)
        by_name = names.argsort()
        self.name, self.named = np.r_[names[by_name], np.iinfo(np.int64).max], np.r_[by_name, len(order)]
        size = np.array([len(lists[t]) for t in order], np.int64)
        self.at = np.array([i for t in order for i, _ in lists[t]], np.int64)
        self.part = np.array([x for t in order for _, x in lists[t]])
        self.most = np.array([max(x for _, x in lists[t]) for t in order] + [0.0])  # the last one is that of unknown pairs
        whose = np.repeat(np.arange(len(order)), size)
        self.posting = whose * max(n, 1) + self.at
        blocks = n // BLOCK + 1
        key = whose * blocks + self.at // BLOCK
        first = np.flatnonzero(np.r_[True, key[1:] != key[:-1]]) if len(key) else np.zeros(0, np.int64)
        self.block, self.block_at = key[first] % blocks, np.r_[first, len(key)]
        self.block_most = np.maximum.reduceat(self.part, first) if len(first) else np.zeros(0)
        self.blocks = np.searchsorted(key[first] // blocks, np.arange(len(order) + 1))
        self.n_blocks = blocks

    @staticmethod
    def _words(text: str | None) -> str:
        w = _WORD.findall(clean(text or ""))
        return f" {' '.join(w)} " if w else ""

    def search(self, terms: np.ndarray, passage: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """``(passage, item)`` of every item that the terms of a passage give a score of 1 or more."""
        none = np.zeros(0, np.int64)
        n, n_terms = max(len(self.ids), 1), len(self.most)
        key = np.unique(passage[terms < n_terms - 1] * n_terms + terms[terms < n_terms - 1])
        if not len(key):
            return none, none
        who, term = key // n_terms, key % n_terms
        # the terms of a passage in the order of their bounds: those before the sum reaches 1 make no candidate
        first = np.flatnonzero(np.r_[True, who[1:] != who[:-1]])
        count = np.diff(np.r_[first, len(who)])
        most = self.most[term]
        total = most.cumsum()
        total -= np.repeat(total[first] - most[first], count)
        asks = total >= ENOUGH
        idle = np.add.reduceat(~asks, first)
        at = np.repeat(np.arange(len(first)), count)
        rest = np.where(idle > 0, total[first + np.maximum(idle, 1) - 1], 0.0)
        # blocks first
        own, t = at[asks], term[asks]
        n_b = self.blocks[t + 1] - self.blocks[t]
        b, own = _ranges(self.blocks[t], n_b), np.repeat(own, n_b)
        if not len(b):
            return none, none
        cell, back = np.unique(own * self.n_blocks + self.block[b], return_inverse=True)
        live = np.bincount(back, self.block_most[b], len(cell))[back] + rest[own] >= ENOUGH
        b, own = b[live], own[live]
        # postings of live blocks
        n_p = self.block_at[b + 1] - self.block_at[b]
        p, own = _ranges(self.block_at[b], n_p), np.repeat(own, n_p)
        if not len(p):
            return none, none
        pair, back = np.unique(own * n + self.at[p], return_inverse=True)
        score = np.bincount(back, self.part[p], len(pair))
        left = score + rest[pair // n] >= ENOUGH
        pair, score = pair[left], score[left]
        # the other terms of what is left
        own, item = pair // n, pair % n
        k = _ranges(first[own], idle[own])
        mine = np.repeat(np.arange(len(pair)), idle[own])
        wanted = term[k] * n + item[mine]
        where = np.minimum(np.searchsorted(self.posting, wanted), len(self.posting) - 1)
        score = score + np.bincount(mine, np.where(self.posting[where] == wanted, self.part[where], 0.0), len(pair))
        hit = score >= ENOUGH
        return who[first][own[hit]], item[hit]

    def _holds(self, run: str, item: int) -> bool:
        """Whether letters hold ``RUN`` consecutive words of an item: pieces that every run holds one of come first."""
        text, begin = self.text[item]
        for k in range(0, len(begin) - PIECE, PIECE):
            if text[begin[k] : begin[k + PIECE]] in run:
                for j in range(max(0, k - PIECE), min(k, len(begin) - 1 - RUN) + 1):
                    if text[begin[j] : begin[j + RUN]] in run:
                        return True
        return False

    def _lattice(self, words: list[str], ids: list[int], pairs: set[tuple[str, str]], left: list[int], right: list[int]) -> list[int]:
        """Add the word pairs of a text whose line ends may have broken words: two pieces are read as one word, too, so
        that whatever they are the pairs of every run are there.  Returns where each place of the text begins."""
        places, k = [], 0
        while k < len(words):
            if k + 1 < len(words) and (words[k], words[k + 1]) in pairs:
                one = self.word.get(words[k] + words[k + 1], -1)
                places.append(((ids[k], one), (ids[k + 1], one), (ids[k], ids[k + 1])))
                k += 2
            else:
                places.append(((ids[k],), (ids[k],), None))
                k += 1
        begins = []
        for (_, ends, inner), after in zip(places, [*places[1:], None]):
            begins.append(len(left))
            for a, b in [inner] * (inner is not None) + [(a, b) for a in ends for b in (after[0] if after else ())]:
                left.append(a)
                right.append(b)
        return begins

    def leaked(self, texts: list[str | None]) -> list[tuple[int, int, bool, bool]]:
        """``(text, item, with_answer, with_question)`` of all items that the texts give away."""
        words: dict[int, list[str]] = {}
        left, right, first, last, owner = [], [], [], [], []
        for k, text in enumerate(texts):
            if not text:
                continue
            text = clean(text)
            words[k] = w = _WORD.findall(text)
            ids, at = [self.word.get(t, -1) for t in w], len(left)
            if "\n" in text and (pairs := set(_BROKEN.findall(text))):
                begins = self._lattice(w, ids, pairs, left, right)
            else:
                left += ids
                right += ids[1:]
                right.append(-1)
                begins = range(at, at + len(ids))
                if not ids:
                    right.pop()
            for s in range(0, max(len(begins) - SHARED, 0) + 1, SPAN - SHARED):
                if len(begins) > s:
                    first.append(begins[s])
                    last.append(begins[s + SPAN] if len(begins) > s + SPAN else len(left))
                    owner.append(k)
        if not first:
            return []
        left, right, begin, end, owner = (np.array(x, np.int64) for x in (left, right, first, last, owner))
        name = np.where((left >= 0) & (right >= 0), left * len(self.word) + right, -1)
        where = np.searchsorted(self.name, name)
        stream, span = np.where(self.name[where] == name, self.named[where], len(self.most) - 1), end - begin
        bound = np.r_[0.0, self.most[stream].cumsum()]
        live = np.flatnonzero(bound[begin + span] - bound[begin] >= ENOUGH - 1e-9)
        who, item = self.search(stream[_ranges(begin[live], span[live])], np.repeat(live, span[live]))
        out = []
        for pair in np.unique(owner[who] * max(len(self.ids), 1) + item).tolist():
            k, i = divmod(pair, max(len(self.ids), 1))
            w = words[k]
            if self._holds("".join(w), i):
                whole = f" {' '.join(w)} "
                question, answer = self.asked[i]
                out.append((k, self.ids[i], bool(answer) and answer in whole, bool(question) and question in whole))
        return out


_BUILT: dict[str, Items] = {}


def _built(name: str, items: list[tuple]) -> Items:
    """The index of one block of items, once in each Python worker; a worker keeps the two used last."""
    if name not in _BUILT:
        while len(_BUILT) > 1:
            _BUILT.pop(next(iter(_BUILT)))
        _BUILT[name] = Items(items)
    return _BUILT[name]


def _blocks(items: DataFrame, columns: list[str]) -> Iterator[list[tuple]]:
    """The stated query set in blocks of bounded size."""
    block, size = [], 0
    rows = items.select(F.col(columns[0]).cast("bigint").alias("i"), *[F.col(c).cast("string").alias(f"c{k}") for k, c in enumerate(columns[1:])]).filter("c0 is not null")
    for r in rows.orderBy("i", "c0").toLocalIterator():
        n = sum(len(x or "") for x in r[1:])
        if block and (len(block) >= MAX_ITEMS or size + n > MAX_CHARS):
            yield block
            block, size = [], 0
        block.append(tuple(r))
        size += n
    yield block


def leaks(docs: DataFrame, doc_id: str, text: str, items: DataFrame, item_id: str, passage: str, question: str | None = None, answer: str | None = None) -> DataFrame:
    """``(doc_id, item_id, with_answer, with_question)`` of every document that holds ``RUN`` consecutive words of an item's
    passage, and whether it holds the words of the item's answer and question, too (false without these columns)."""
    source = spread(docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).cast("string").alias("text")), "doc_id")
    columns, out = [item_id, passage, *([question, answer] if question and answer else [])], None
    for block in _blocks(items, columns):
        shared, name = docs.sparkSession.sparkContext.broadcast(block), uuid.uuid4().hex

        def each(batches: Iterator[pa.RecordBatch], shared=shared, name=name) -> Iterator[pa.RecordBatch]:
            index = _built(name, shared.value)
            for b in batches:
                ids, texts, begin, size = b.column(0).to_pylist(), b.column(1).to_pylist(), 0, 0
                for k in range(len(texts)):
                    size += len(texts[k] or "")
                    if k + 1 == len(texts) or k + 1 - begin == TEXTS or size >= LETTERS:
                        rows = index.leaked(texts[begin : k + 1])
                        if rows:
                            at, item, a, q = zip(*rows)
                            yield pa.RecordBatch.from_arrays([pa.array([ids[begin + j] for j in at], pa.int64()), pa.array(item, pa.int64()), pa.array(a, pa.bool_()), pa.array(q, pa.bool_())], ["doc_id", "item_id", "with_answer", "with_question"])
                        begin, size = k + 1, 0

        part = source.mapInArrow(each, "doc_id bigint, item_id bigint, with_answer boolean, with_question boolean")
        out = part if out is None else out.union(part)
    return out.groupBy("doc_id", "item_id").agg(F.max("with_answer").alias("with_answer"), F.max("with_question").alias("with_question"))


def item_report(found: DataFrame) -> DataFrame:
    """For each leaked item of :func:`leaks` the documents that hold it, and how many of them hold its answer and its
    question, too."""
    return found.groupBy("item_id").agg(F.count("*").alias("documents"), F.count_if("with_answer").alias("with_answer"), F.count_if("with_question").alias("with_question"))
