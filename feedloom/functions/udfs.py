"""The functions that need Python: Arrow-batched, never one row at a time."""

from __future__ import annotations

import difflib
import html
import textwrap
from collections import Counter

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


@F.pandas_udf(T.StringType())
def html_unescape(s: pd.Series) -> pd.Series:
    """All named and numeric entities."""
    return s.map(lambda x: (html.unescape(x) if "&" in x else x) if isinstance(x, str) else None)


@F.pandas_udf(T.DoubleType())
def sequence_ratio(a: pd.Series, b: pd.Series) -> pd.Series:
    """The share of matching blocks of two texts; the order of the arguments matters."""
    return pd.Series([1.0 if x == y else difflib.SequenceMatcher(None, x or "", y or "").ratio() for x, y in zip(a, b)])


#: How many of each letter :func:`letter_bits` tells apart, from the most frequent ones down: 256 in all.
LETTER_ROOM = {c: n for letters, n in ((" e", 16), ("tainosr", 14), ("lhdcump", 9), ("fgyvbw", 6), ("kz-,0123456789", 2)) for c in letters}
_FIRST_BIT = dict(zip(LETTER_ROOM, [sum(list(LETTER_ROOM.values())[:k]) for k in range(len(LETTER_ROOM))]))
_RUNS = {c: [((1 << n) - 1) << _FIRST_BIT[c] for n in range(room + 1)] for c, room in LETTER_ROOM.items()}


@F.pandas_udf(T.ArrayType(T.LongType()))
def letter_bits(s: pd.Series) -> pd.Series:
    """The letters of a text as 256 bits, one for each occurrence: the bits that two texts share number the letters that they
    share, as far as there is room."""

    def bits(text: str) -> list[int]:
        x = 0
        for c, n in Counter(text or "").items():
            if c in LETTER_ROOM:
                x |= _RUNS[c][min(n, LETTER_ROOM[c])]
        parts = [x >> 64 * k & (1 << 64) - 1 for k in range(4)]
        return [p - (1 << 64) if p >> 63 else p for p in parts]

    return s.map(bits)


#: The letters with the first 60, the next 70 and the next 63 bits; what is left are the rare ones.
_PARTS = (" eta", "inosr", "lhdcump")
_PART_BITS = [[np.uint64(((1 << to) - (1 << at)) >> 64 * k & 2**64 - 1) for k in range(4)] for at, to in ((0, 60), (60, 130), (130, 193), (193, 256))]
_LETTER_CODE = {c: 33 + k for k, c in enumerate("".join(_PARTS))}
_CODES = [bytes(_LETTER_CODE[c] for c in part) for part in _PARTS] + [bytes(range(1, 32))]
#: The letters of one part that a word of bits has room for.
_ROOM = 64
#: The order in which parts tell pairs apart, by what a letter of them tells; and the pairs that meet a part at once.
_ORDER, _AT_ONCE = (1, 2, 3, 0), 1 << 13


@F.pandas_udf(T.BinaryType())
def letter_codes(s: pd.Series) -> pd.Series:
    """A byte for each letter of a text: common letters have their own, rare ones one of 31, which several may share."""

    class Codes(dict):
        def __missing__(self, c: int) -> int:
            return self.setdefault(c, c % 31 + 1)

    code = Codes({ord(c): k for c, k in _LETTER_CODE.items()})
    return s.map(lambda text: (text or "").translate(code).encode("latin-1"))


class _Part:
    """The letters of one part, in their order, in all texts of a group; how many of them a left and another text share."""

    def __init__(self, texts: list[bytes], codes: bytes, ls: np.ndarray, rs: np.ndarray):
        others = bytes(set(range(256)) - set(codes))
        own = [x.translate(None, others) for x in texts]
        self.ls, self.rs, self.n = ls, rs, np.array([len(x) for x in own], np.int32)
        letters = np.frombuffer(b"".join(x[:_ROOM].ljust(_ROOM, b"\0") for x in own), np.uint8).reshape(-1, _ROOM) & 31
        place = np.zeros((len(ls), 32), np.uint64)
        for k in range(_ROOM):
            c = letters[ls, k]
            at = np.flatnonzero(c)
            place[at, c[at]] |= np.uint64(1 << k)
        self.place, self.text = place.reshape(-1), np.ascontiguousarray(letters[rs].T)

    def shared(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """The length of the longest common subsequence; if there is no room for one of the texts, the lesser number of letters."""
        a, b = self.n[self.ls[i]], self.n[self.rs[j]]
        at, free = i * 32, np.full(len(i), 2**64 - 1, np.uint64)
        for c in self.text[: b.max(initial=0)]:
            u = self.place.take(at + c.take(j))
            u &= free
            rest = free - u
            free += u
            free |= rest
        return np.where(np.maximum(a, b) > _ROOM, np.minimum(a, b), _ROOM - np.bitwise_count(free).astype(np.int32))


#: Bits of a text that tell its letters and its pairs of neighbouring letters apart; texts longer than the last have no bits for pairs.
_LETTERS, _PAIRS, _LONG = 256, 1024, 512


def _bits(chosen: np.ndarray) -> np.ndarray:
    """A row of words of 64 bits for each row of ``chosen``."""
    return np.packbits(np.pad(chosen, ((0, 0), (0, -chosen.shape[1] % 64))), axis=1).view(np.uint64)


def _telling(share: np.ndarray, most: int) -> np.ndarray:
    """The ``most`` features in which two rows differ most often; any choice counts no difference that there isn't."""
    return np.argsort(share * (share - 1), kind="stable")[:most]


def _letter_words(texts: list[bytes]) -> np.ndarray:
    """Bits for the first, second, ... occurrence of letters: texts that differ in some of them have as many letters without partner."""
    rows = np.repeat(np.arange(len(texts)), [len(x) for x in texts])
    counts = np.bincount(rows * 64 + np.frombuffer(b"".join(texts), np.uint8), minlength=len(texts) * 64).reshape(-1, 64)
    each = [(c, k) for c in range(64) for k in range(1, min(32, counts[:, c].max(initial=0)) + 1)]
    best = _telling(np.array([np.mean(counts[:, c] >= k) for c, k in each]), _LETTERS)
    return _bits(np.stack([counts[:, each[f][0]] >= each[f][1] for f in best], axis=1) if len(best) else np.zeros((len(texts), 1), bool))


def _pair_words(texts: list[bytes]) -> np.ndarray:
    """The same for pairs of neighbouring letters."""
    width = max([2, *map(len, texts)])
    at = np.frombuffer(b"".join(x.ljust(width, b"\0") for x in texts), np.uint8).reshape(-1, width).astype(np.int16)
    found = np.where(at[:, 1:] > 0, at[:, :-1] * 64 + at[:, 1:], 0)
    found.sort(axis=1)
    place = np.broadcast_to(np.arange(width - 1, dtype=np.int16), found.shape)
    first = np.where(np.pad(found[:, 1:] != found[:, :-1], ((0, 0), (1, 0)), constant_values=True), place, 0)
    nth = place - np.maximum.accumulate(first, axis=1, out=first)
    which = found.astype(np.int32) * 8 + nth
    which[(found == 0) | (nth > 7)] = 0
    best = _telling(np.bincount(which[which > 0], minlength=8 * 4096) / max(1, len(texts)), _PAIRS)
    bit = np.zeros(8 * 4096, np.int32)
    bit[best[best > 0]] = np.flatnonzero(best > 0) + 1
    chosen = np.zeros((len(texts), _PAIRS + 1), bool)
    chosen[np.arange(len(texts))[:, None], bit[which]] = True
    return _bits(chosen[:, 1:])


def close_letters(threshold: float):
    """For groups of ``left, own, id, n, k0..k3, other, code``: the pairs ``(a, b)`` of a left and another row whose letters may give
    a ratio of ``threshold``; pairs with an ``own`` row once.

    A letter that isn't in the common subsequence changes one count of letters and at most three of pairs of neighbouring letters;
    so texts with too many different counts aren't close.  Of each part of the alphabet the common subsequence holds no more than
    that of the part's letters.  Every pair of the group with fitting lengths meets the bounds by counts, for which one left row is
    compared with all others at once; what passes is gathered and meets the bounds by parts, a word of 64 bits for each pair, part
    after part, each with what the parts before it left of many rows.
    """
    low = threshold / (2 - threshold)

    def pairs(t: pa.Table) -> pa.Table:
        col = lambda name: t.column(name).to_numpy()
        left = col("left").astype(bool)
        n, ids, own = col("n").astype(np.int32), col("id"), col("own").astype(bool)
        ls, rs = (x[np.argsort(n[x], kind="stable")] for x in (np.flatnonzero(left), np.flatnonzero(~left)))
        words, texts = [col(f"k{k}").view(np.uint64) for k in range(4)], t.column("code").to_pylist()
        parts = [_Part(texts, _CODES[p], ls, rs) for p in _ORDER]
        bits = [[w & m for w, m in zip(words, _PART_BITS[p]) if m] for p in _ORDER]
        # letters of this part and those after it without room, of which any may match
        over = np.cumsum([part.n - sum(np.bitwise_count(w).astype(np.int32) for w in own_bits) for part, own_bits in zip(parts[::-1], bits[::-1])], axis=0)[::-1]
        out: list[tuple[np.ndarray, np.ndarray]] = []
        held: list[list[tuple[np.ndarray, ...]]] = [[] for _ in parts]

        def verify(level: int) -> None:
            """Pairs that wait for a part: those that may still give the ratio go on to the next one."""
            i, j, known = (np.concatenate(x) for x in zip(*held[level]))
            held[level].clear()
            known = known + parts[level].shared(i, j)
            a, b = ls[i], rs[j]
            may = known + (np.minimum(over[level + 1][a], over[level + 1][b]) if level + 1 < len(parts) else 0)
            for w in (w for part in bits[level + 1 :] for w in part):
                may += np.bitwise_count(w[a] & w[b])
            good = 2 * may >= threshold * (n[a] + n[b]) - 1e-9
            if level + 1 == len(parts):
                out.append((ids[a[good]], ids[b[good]]))
            elif good.any():
                wait(level + 1, i[good], j[good], known[good])

        def wait(level: int, *rows: np.ndarray) -> None:
            held[level].append(rows)
            if sum(len(x) for x, *_ in held[level]) >= _AT_ONCE:
                verify(level)

        long, (_, once, row) = n > _LONG, np.unique(ids, return_index=True, return_inverse=True)
        counts = _letter_words([texts[k] for k in once])[row]
        pairs_of = _pair_words([b"" if long[k] else texts[k] for k in once])[row]
        rw, rp, rn, rid, rown, rlong = [np.ascontiguousarray(w) for w in counts[rs].T], pairs_of[rs], n[rs], ids[rs], own[rs], long[rs]
        ones = np.ones(rp.shape[1], np.float32)
        both, far, more, near, last = np.empty(len(rs), np.uint64), np.empty(len(rs), np.uint8), np.empty(len(rs), np.uint8), np.empty(len(rs), bool), None
        for k, i in enumerate(ls):
            if n[i] != last:
                last = n[i]
                at, to = np.searchsorted(rn, [np.ceil(low * last - 1e-9), np.floor(last / low + 1e-9) + 1])
                fits, x, f, m, ok = [w[at:to] for w in rw], both[at:to], far[at:to], more[at:to], near[at:to]
                # the letters without partner that a pair may have; if 255 or more, all pass, as do sums beyond 255, which begin anew
                most = np.minimum(np.floor((1 - threshold) * (rn[at:to] + last) + 1e-6), 255).astype(np.uint8)
            np.bitwise_count(np.bitwise_xor(fits[0], counts[i, 0], out=x), out=f)
            for w, own_word in zip(fits[1:], counts[i, 1:]):
                np.bitwise_xor(w, own_word, out=x)
                np.bitwise_count(x, out=m)
                np.add(f, m, out=f)
            hit = np.flatnonzero(np.less_equal(f, most, out=ok))
            if not long[i]:
                may = most[hit]
                hit += at
                two = rp.take(hit, axis=0)
                apart = np.bitwise_count(np.bitwise_xor(two, pairs_of[i], out=two)).astype(np.float32) @ ones
                hit = hit[(apart <= 3 * may.astype(np.float32)) | (may == 255) | rlong[hit]]
            else:
                hit += at
            hit = hit[np.where(rown[hit], rid[hit] > ids[i], rid[hit] != ids[i])]
            if len(hit):
                wait(0, np.full(len(hit), k), hit, np.zeros(len(hit), np.int32))
        for level in range(len(parts)):
            if held[level]:
                verify(level)
        a, b = (np.concatenate([x[s] for x in out]) if out else np.empty(0, np.int64) for s in (0, 1))
        return pa.table({"a": pa.array(np.minimum(a, b), pa.int64()), "b": pa.array(np.maximum(a, b), pa.int64())})

    return pairs


def common_length(a: str, b: str) -> int:
    """The length of the longest common subsequence: one addition of whole numbers for each letter of ``b``."""
    place: dict[str, int] = {}
    for k, c in enumerate(a):
        place[c] = place.get(c, 0) | 1 << k
    full = free = (1 << len(a)) - 1
    for c in b:
        u = free & place.get(c, 0)
        free = (free + u) | (free - u)
    return len(a) - (free & full).bit_count()


#: From this length on :mod:`difflib` leaves out frequent letters; and the letters of a batch that are compared at once.
_AUTOJUNK, _LETTERS_AT_ONCE = 200, 1 << 18


def _longest_blocks(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of each row, the end of the longest common block in ``a`` and in ``b``, and its length: the first one in ``a``, then in ``b``."""
    run, after, same = (np.zeros((len(b), b.shape[1] + 1), np.uint8) for _ in range(3))
    size, i, j = (np.zeros(len(a), np.int64) for _ in range(3))
    for k in range(a.shape[1]):
        np.equal(b, a[:, k, None], out=same[:, 1:].view(bool))
        np.add(run[:, :-1], 1, out=after[:, 1:])
        np.multiply(after, same, out=after)
        top = after.max(axis=1)
        more = np.flatnonzero(top > size)
        if len(more):
            size[more], i[more], j[more] = top[more], k + 1, after[more].argmax(axis=1)
        run, after = after, run
    return i, j, size


def matching_letters(xs: list[str], ys: list[str], least: np.ndarray) -> np.ndarray:
    """The letters in the matching blocks of ``xs`` and ``ys`` as :class:`difflib.SequenceMatcher` finds them, for ``ys`` shorter
    than ``_AUTOJUNK``; fewer where ``least`` are out of reach.  All pairs of a batch are taken at once, block after block."""
    (a, alo, ahi), (b, blo, bhi) = (
        (np.frombuffer("".join(t).encode("utf-32-le", "surrogatepass"), np.uint32), np.cumsum([0, *n[:-1]]), np.cumsum(n)) for t in (xs, ys) for n in [list(map(len, t))]
    )
    found, of = np.zeros(len(xs), np.int64), np.arange(len(xs))
    known = np.zeros(max(a.max(initial=0), b.max(initial=0)) + 1, bool)
    known[a] = known[b] = True
    kind = np.uint8 if known.sum() <= 253 else np.uint32
    a, b, none = *((np.cumsum(known) - 1).astype(kind)[x] for x in (a, b)), np.iinfo(kind).max

    def part(text: np.ndarray, lo: np.ndarray, hi: np.ndarray, none: int) -> np.ndarray:
        at = lo[:, None] + np.arange((hi - lo).max())
        return np.where(at < hi[:, None], text[np.minimum(at, len(text) - 1)], kind(none))

    while True:
        room = np.minimum(ahi - alo, bhi - blo)
        go = (room > 0) & (found + np.bincount(of, room, len(xs)) >= least)[of]
        order = np.flatnonzero(go)[np.argsort((ahi - alo)[go], kind="stable")]
        if not len(order):
            return found
        of, alo, ahi, blo, bhi = (x[order] for x in (of, alo, ahi, blo, bhi))
        step, ends = max(1, _LETTERS_AT_ONCE // int((bhi - blo).max())), []
        for k in range(0, len(of), step):
            s = slice(k, k + step)
            ends.append(_longest_blocks(part(a, alo[s], ahi[s], none), part(b, blo[s], bhi[s], none - 1)))
        i, j, size = (np.concatenate(x) for x in zip(*ends))
        found += np.bincount(of, size, len(xs)).astype(np.int64)
        i, j, some = i + alo, j + blo, size > 0
        of, alo, ahi, blo, bhi = (np.concatenate([x[some], y[some]]) for x, y in ((of, of), (alo, i), (i - size, ahi), (blo, j), (j - size, bhi)))


def ratio_from(threshold: float):
    """:func:`sequence_ratio` where it reaches ``threshold``, else null.  Pairs are left as soon as the letters between the blocks
    found so far are too few; of long texts, whose matching blocks are a common subsequence too, most are told by its length."""

    @F.pandas_udf(T.DoubleType())
    def ratio(a: pd.Series, b: pd.Series) -> pd.Series:
        xs, ys = list(a), list(b)
        both = np.array([len(x) + len(y) for x, y in zip(xs, ys)], np.int64)
        out = np.array([1.0 if x == y else 0.0 for x, y in zip(xs, ys)])
        at = [k for k, y in enumerate(ys) if not out[k] and len(y) < _AUTOJUNK]
        if at:
            out[at] = 2.0 * matching_letters([xs[k] for k in at], [ys[k] for k in at], threshold * both[at] / 2 - 1e-6) / both[at]
        for k, (x, y) in enumerate(zip(xs, ys)):
            if not out[k] and len(y) >= _AUTOJUNK and 2 * common_length(x, y) >= threshold * both[k]:
                out[k] = difflib.SequenceMatcher(None, x, y).ratio()
        return pd.Series([r if r >= threshold else None for r in out], dtype="float64")

    return ratio


@F.pandas_udf(T.StringType())
def wrap_text(s: pd.Series, width: pd.Series) -> pd.Series:
    return pd.Series([None if t is None else "\n".join(textwrap.wrap(t, int(w))) for t, w in zip(s, width)])


def register(spark: SparkSession) -> None:
    """Make the functions available to SQL."""
    for name, f in (("html_unescape", html_unescape), ("sequence_ratio", sequence_ratio), ("wrap_text", wrap_text)):
        spark.udf.register(name, f)
