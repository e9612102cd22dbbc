"""Text that lost its end: a stack automaton over quotes, brackets, mark-up, entities and bytes, and a baseline for each source.

One pass of the automaton over the structural characters of a value keeps a stack of what is open, and comes first.  What
it is in the middle of at the end is a cut by itself: a multibyte sequence, an entity, an escape, a tag, and a quote or
bracket that the last sentence opened, whether or not a full stop follows, unless its closing part stands elsewhere.
Brackets that an earlier sentence left open are a slip of its writer.  Then a sign of omission is a cut if what precedes it is not a whole sentence; and a value without a
terminator is one unless it closes with a label, a link or a number, or its source leaves terminators out as a rule: the
share of such values of each source is counted over all rows that lie below the length limit of their field, and only
values below it are excused.  A limit shows in lengths that pile up.

Defined results: null, blank and placeholder values are no cases and do not count as values of a source; repeated
rows are judged alike; texts are read whole, however long.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from feedloom.llm.common import cut

# What feeds write where a text is missing.
PLACEHOLDERS = (
    "n/a", "na", "null", "none", "no summary", "no abstract", "abstract not available", "summary not available", "not available", "summary to follow",
    "abstract to follow", "see full text", "click here to view the abstract", "tba", "tbd", "n.d", "pending", "unknown", "no description",
)
_MISSING = {"".join(c for c in x if c.isalnum()) for x in PLACEHOLDERS}

#: A source that surely (so many standard deviations) leaves the terminator out of more than this share of its values below
#: the length limit closes texts without one.
BARE_SHARE, SURE = 0.5, 3.0
#: Lengths are counted in cells of so many letters; a field whose values without terminator lie by more than ``BARE_SHARE``
#: within so many cells, and do not end in one word, is cut there.
CELL, PILE = 8, 3

_OMITTED = re.compile(r"(?:\s*(?:…|\.\s?\.\s?\.|&hellip;|\[\s*(?:…|\.\.\.|more)\s*\]|\((?:continued|more)\)|\b(?:read more|continue reading)\b\W*))+\s*[»›]?\s*$", re.I)
_CLOSING = re.compile(r"(?:\s|</[a-z][\w-]*\s*>|<br\s*/?>)+$", re.I)
_LABEL = re.compile(r"(?:^(?=keywords|key words|funding|trial registration|conflict)|[.!?:…)\]»”\"'>]\s+|\n\s*)[^\W\d_][\w’'-]*(?: [\w’'-]+){0,2}:\s+\S[^.!?]*$", re.I)
_LINK = re.compile(r"(?:https?://|www\.)[\w-]+(?:\.[\w-]+)+(?:[/?#]\S*)?$", re.I)
_FIGURE = re.compile(r"(?:^|[.!?…)\]»”>]\s+)[\W\d_]*\d[\W\d_]*$")
#: What the automaton reads: complete tags, and what opens and closes.
_STRUCTURE = re.compile(r"[()\[\]{}«»“”\"]|</?[A-Za-z][^<>]*>")
#: Its states in which a value may end: within bytes, a tag or comment, an entity, an escape.
_UNFINISHED = (
    ("bytes", re.compile(r"(?:�+|[ÂÃ]|â(?:€.?)?)$")),
    ("markup", re.compile(r"<(?:/?[a-z][^<>]*|!--(?:(?!-->).)*|/)?$", re.I | re.S)),
    ("entity", re.compile(r"&(?:#\d*|#x[0-9a-f]*|[a-z]{1,8})$", re.I)),
    ("escape", re.compile(r"(?:\\(?:u[0-9a-f]{0,3}|x[0-9a-f]?)?|(?<=%[0-9a-f]{2})%[0-9a-f]?)$", re.I)),
)
_STOP = re.compile(r"[.!?。؟][\"'”’»)\]]*\s+")
_PARTNER = {")": "(", "]": "[", "}": "{", "»": "«", "”": "“"}
_VOID = ("br", "hr", "img", "input", "meta", "wbr")
# Fixed value: tags whose end may be left out in HTML.
_OPTIONAL = ("p", "li", "dt", "dd", "td", "th", "tr", "option", "tbody", "thead")
_ENDS = ".!?。؟"


def is_missing(text: str | None) -> bool:
    """Null, blank or a placeholder."""
    t = (text or "").strip()
    return not t or (len(t) < 60 and "".join(c for c in t.casefold() if c.isalnum()) in _MISSING | {""})


def scan(text: str) -> tuple[str | None, list[tuple[str, int]], Counter]:
    """What the automaton is in the middle of at the end of a text, what its stack holds with the places, and how many closers
    found nothing to close, by what they would have closed; a quote after a digit (inches) opens nothing."""
    unfinished = next((name for name, state in _UNFINISHED if state.search(text, max(0, text.rfind("<")) if name == "markup" else max(0, len(text) - 12))), None)
    stack: list[tuple[str, int]] = []
    spare: Counter = Counter()

    def close(x: str) -> bool:
        for k in range(len(stack) - 1, -1, -1):
            if stack[k][0] == x:
                del stack[k:]
                return True
        return False

    for m in _STRUCTURE.finditer(text):
        x, at = m.group(), m.start()
        if x == '"':
            if not close(x) and not text[at - 1 : at].isdigit():
                stack.append((x, at))
        elif x in _PARTNER:
            if not close(_PARTNER[x]):
                spare[_PARTNER[x]] += 1
        elif len(x) == 1:
            stack.append((x, at))
        else:
            name = re.match(r"</?([A-Za-z][\w-]*)", x).group(1).lower()
            if x[1] == "/":
                close("<" + name)
            elif name not in _VOID and not x.endswith("/>"):
                stack.append(("<" + name, at))
    return unfinished, stack, spare


def _left_open(text: str, stack: list[tuple[str, int]], spare: Counter) -> bool:
    """Whether the last sentence opened something that is closed nowhere."""
    if not stack:
        return False
    last = max((m.end() for m in _STOP.finditer(text)), default=0)
    opened = Counter(x for x, at in stack if at >= last and x[1:] not in _OPTIONAL)
    return any(n > spare[x] for x, n in opened.items())


def open_at_end(text: str) -> list[str]:
    """What the automaton's stack holds at the end of a text."""
    return [x for x, _ in scan(text)[1]]


def verdict(text: str | None) -> str:
    """``missing``, ``whole``, ``bare`` (whole only if its source leaves terminators out) or ``cut:`` and the reason."""
    if is_missing(text):
        return "missing"
    t = text.strip()
    unfinished, stack, spare = scan(t)
    if unfinished:
        return "cut:" + unfinished
    if _left_open(t, stack, spare):
        return "cut:open"
    t = _CLOSING.sub("", t)
    rest = _OMITTED.sub("", t)
    if rest != t:
        rest = _CLOSING.sub("", rest)
        return "whole" if rest.rstrip("\"'”’»)] ")[-1:] in tuple(_ENDS) else "cut:omission"
    core = t.rstrip("\"'”’»)] ")
    if core[-1:] in tuple(_ENDS) or not core:
        return "whole"
    if t[-1] in ")]»”" and not re.search(r"[^\W\d_]", t[t.rfind(_PARTNER[t[-1]]) + 1 :] if _PARTNER[t[-1]] in t else "x"):
        return "whole"
    if _LABEL.search(t) or _LINK.search(t) or _FIGURE.search(t):
        return "whole"
    return "cut:open" if stack else "bare"


def judged(df: DataFrame, row_id: str, source: str, fields: list[str]) -> DataFrame:
    """``(row_id, source, field_name, verdict, cell, last, total, n)``: every value that is cut or bare with its last word, and, where
    ``total``, how many values of each verdict and length a source has in each batch.  One row-local
    pass serves the cases and the baseline."""
    schema = "row_id bigint, source string, field_name string, verdict string, cell int, last string, total boolean, n bigint"
    kinds = (pa.int64(), pa.string(), pa.string(), pa.string(), pa.int32(), pa.string(), pa.bool_(), pa.int64())

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids, src = b.column(0).to_pylist(), b.column(1).to_pylist()
            rows, counts = [], Counter()
            for k, f in enumerate(fields):
                for i, s, t in zip(ids, src, b.column(2 + k).to_pylist()):
                    v = verdict(t)
                    if v != "missing":
                        t = t.strip()
                        counts[s, f, v, len(t) // CELL] += 1
                        if v != "whole":
                            rows.append((i, s, f, v, len(t) // CELL, t[-40:].rsplit(None, 1)[-1].lower() if v == "bare" else None, False, 1))
            rows += [(None, s, f, v, c, None, True, n) for (s, f, v, c), n in counts.items()]
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], [x.split()[0] for x in schema.split(", ")])

    return df.select(F.col(row_id).cast("bigint").alias("row_id"), F.col(source).cast("string").alias("source"), *[F.col(f).cast("string").alias(f) for f in fields]).mapInArrow(each, schema)


def limits(verdicts: DataFrame) -> DataFrame:
    """``(_source, _field, edge)``: the first cell of lengths at which a field of a source is cut; none for fields without limit."""
    bare = verdicts.filter("verdict = 'bare' and not total").groupBy(F.col("source").alias("_source"), F.col("field_name").alias("_field"), "cell", "last").agg(F.sum("n").alias("n"))
    cells = bare.groupBy("_source", "_field", "cell").agg(F.sum("n").alias("n"))
    near = Window.partitionBy("_source", "_field").orderBy("cell").rangeBetween(1 - PILE, 0)
    top = cells.withColumn("pile", F.sum("n").over(near)).groupBy("_source", "_field").agg(F.max(F.struct("pile", "cell")).alias("top"), F.sum("n").alias("n"))
    top = top.filter(F.col("top.pile") > BARE_SHARE * F.col("n")).select(F.col("_source").alias("s"), F.col("_field").alias("f"), F.col("top.pile").alias("pile"), (F.col("top.cell") + 1 - PILE).alias("edge"))
    # a text that always closes with the same word is not cut there
    ends = bare.join(top, F.col("_source").eqNullSafe(F.col("s")) & (F.col("_field") == F.col("f")) & F.col("cell").between(F.col("edge"), F.col("edge") + PILE - 1))
    ends = ends.groupBy("_source", "_field", "edge", "pile", "last").agg(F.sum("n").alias("n")).groupBy("_source", "_field", "edge", "pile").agg(F.max("n").alias("most"))
    return ends.filter((F.col("most") <= BARE_SHARE * F.col("pile")) | (F.col("pile") == 1)).select("_source", "_field", "edge")


def _below(verdicts: DataFrame, edges: DataFrame) -> DataFrame:
    """``verdicts`` with ``below``: whether a value lies below the length limit of its field."""
    out = verdicts.join(edges, F.col("source").eqNullSafe(F.col("_source")) & (F.col("field_name") == F.col("_field")), "left")
    return out.withColumn("below", F.coalesce(F.col("cell") < F.col("edge"), F.lit(True))).drop("_source", "_field", "edge")


def baseline(verdicts: DataFrame) -> DataFrame:
    """For each source: its values, those judged cut, those without a terminator and those of them below the length limit, added
    up from the batches, and whether it leaves terminators out as a rule: over all values, and surely (Wilson's lower bound)
    below the limit, where few values of a source that cuts long texts lie."""
    part = lambda c: F.sum(F.when(c, F.col("n")).otherwise(0))
    bare = F.col("verdict") == "bare"
    n = _below(verdicts.filter("total"), limits(verdicts)).groupBy("source").agg(F.sum("n").alias("n_values"), part(F.col("verdict").startswith("cut")).alias("n_marked"), part(bare).alias("n_bare"), part(F.col("below")).alias("n_below"), part(bare & F.col("below")).alias("n_bare_below"))
    m, p, z = F.col("n_below"), F.col("n_bare_below") / F.nullif(F.col("n_below"), F.lit(0)), SURE
    least = (p + z * z / (2 * m) - z * F.sqrt(p * (1 - p) / m + z * z / (4 * m * m))) / (1 + z * z / m)
    return n.withColumn("bare_is_usual", F.when(m > 0, (least > BARE_SHARE) & (F.col("n_bare") > BARE_SHARE * F.col("n_values"))).otherwise(False))


def truncated(df: DataFrame, row_id: str, source: str, fields: list[str]) -> DataFrame:
    """``(row_id, field_name, reason)`` of the values that lost their end; rows without an identifier have no row."""
    v = cut(judged(df, row_id, source, fields))
    usual = baseline(v).filter("bare_is_usual").select(F.col("source").alias("_usual"))
    rows = _below(v.filter("row_id is not null and not total"), limits(v))
    excused = (F.col("verdict") == "bare") & F.col("below") & F.col("source").eqNullSafe(F.col("_usual"))
    return rows.join(usual, excused, "left_anti").select("row_id", "field_name", F.col("verdict").alias("reason"))


def report(df: DataFrame, row_id: str, source: str, fields: list[str]) -> DataFrame:
    """The share of damaged values for each source."""
    b = baseline(cut(judged(df, row_id, source, fields)))
    damaged = F.col("n_marked") + F.col("n_bare") - F.when(F.col("bare_is_usual"), F.col("n_bare_below")).otherwise(0)
    return b.select("source", "n_values", damaged.alias("n_truncated"), F.round(damaged / F.col("n_values"), 6).alias("truncated_share"))
