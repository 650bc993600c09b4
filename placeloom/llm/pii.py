"""Personal data in texts, disguised or not, as spans of source characters.

Plain identifiers are matched on the text as it stands. Then three transducers
rewrite a text (look-alike characters, "at"/"dot" disguises, spelled digits)
while every output character keeps the source range it stands for; what is
detected only in the rewritten text is mapped back to that range. Plain matches
stay; what the transducers add is apart from those of its kind, or holds them.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import from_arrow_type
from pyspark.sql.types import StringType

from placeloom.llm.common import bounded_batches, spans_text

KINDS = ("email", "ip", "card", "phone")

# Each pattern is linear in the text: what a failed run of characters rules out is not tried again inside it.
_DOMAIN = re.compile(r"@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_IP = re.compile(r"(?<![0-9])([0-9]++)\.([0-9]++)\.([0-9]++)\.([0-9]++)")
_CARD = re.compile(r"[0-9]++(?:[ -][0-9]++)*+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")


def _luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (1 + i % 2)
        total += n - 9 * (n > 9)
    return total % 10 == 0


def _small(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) <= 3 and int(part or 0) <= 255


def plain_spans(text: str) -> list[tuple[int, int, int]]:
    """(kind's number, start, end) of undisguised identifiers, by kind, then start."""
    out = []
    after = 0
    if "@" in text:
        for m in _DOMAIN.finditer(text):
            start = m.start()
            while start > after and text[start - 1] in _LOCAL:
                start -= 1
            if start < m.start():
                after = m.end()
                out.append((0, start, after))
    for m in _IP.finditer(text):
        if all(map(_small, m.groups())):
            out.append((1, *m.span()))
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 13:
            digits = m[0].replace(" ", "").replace("-", "")
            if 13 <= len(digits) <= 19 and _luhn(digits):
                out.append((2, *m.span()))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 9 <= sum(map(str.isdigit, m[0])) <= 15:
                out.append((3, *m.span()))
    return out


# ---- transducers ----------------------------------------------------------------------------------------------------

# Letters of other scripts that look like Latin ones, and marks that look like a dot, hyphen or space.
_ALIKE = dict(
    zip(
        "АВЕКМНОРСТУХаеорсухіјѕԁһІЈЅΑΒΕΖΗΙΚΜΝΟΡΤΥΧοναρ‐‑‒–—−﹣․。｡·•∙",
        "ABEKMHOPCTYXaeopcyxijsdhIJSABEZHIKMNOPTYXovap-------......",
        strict=True,
    )
)
#: Drawn with no width; they go.
_HIDDEN = "​‌‍⁠﻿­"
_ODD = re.compile(r"[^\x00-\xac\xae-ɏ]|\xad|\xb7|\xa0")

# Names of digits, and of the signs, in English, German, French and Spanish.
_DIGITS = {
    **dict(zip("zero one two three four five six seven eight nine".split(), "0123456789", strict=True)),
    **dict(zip("null eins zwei drei vier fünf sechs sieben acht neun".split(), "0123456789", strict=True)),
    **dict(zip("zéro un deux trois quatre cinq six sept huit neuf".split(), "0123456789", strict=True)),
    **dict(zip("cero uno dos tres cuatro cinco seis siete ocho nueve".split(), "0123456789", strict=True)),
    "oh": "0",
}
_AT_NAMES, _DOT_NAMES = "at|arobase|arroba|ät", "dot|punkt|point|punto"
_D = "(?:" + "|".join(sorted(_DIGITS, key=len, reverse=True)) + ")"
# Runs of blanks and of figures are taken whole, so that none is looked at from each of its places.
_SEP = rf"(?:[ \t,\n-]++|[ \t]*+(?:[\[({{<][ \t]*+)?(?:{_DOT_NAMES}|\.)[ \t]*+(?:[\])}}>][ \t]*+)?)"
_SPELLED = re.compile(rf"(?:{_D}|(?<![0-9])[0-9]++)(?:{_SEP}(?:{_D}|[0-9]++))+(?!\w)", re.I)
_TOKEN = re.compile(rf"(?P<d>{_D})|(?P<n>[0-9]+)|(?P<p>{_DOT_NAMES}|\.)", re.I)
_WORDS, _BETWEEN = re.compile(r"\w+"), frozenset(_DOT_NAMES.split("|"))

# Blanks only count from the first of a run on, so that a run of any length is looked at once.
_OPEN, _CLOSE = r"(?<![ \t])[ \t]*+[\[({<][ \t]*+", r"[ \t]*+[\])}>][ \t]*+"
_AT = re.compile(rf"[\[({{<][ \t]*+(?:{_AT_NAMES}|@){_CLOSE}|[ \t](?:{_AT_NAMES})[ \t]++|@", re.I)
_DOT = rf"(?:{_OPEN}(?:{_DOT_NAMES}|\.){_CLOSE}|(?<![ \t])[ \t]++(?:{_DOT_NAMES})[ \t]++|\.)"
_HOST = re.compile(rf"[A-Za-z0-9-]++(?:{_DOT}[A-Za-z0-9-]++)+", re.I)
_DOTS = re.compile(_DOT, re.I)
_NAME_CHARS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789_%+-")
_BLANK, _OPENING, _CLOSING = frozenset(" \t"), frozenset("[({<"), frozenset("])}>")
_DOT_WORDS = tuple(sorted(_DOT_NAMES.split("|"), key=len, reverse=True))


def _alike(text: str) -> list[tuple[int, int, str]]:
    if text.isascii():
        return []
    out = []
    for m in _ODD.finditer(text):
        c = m[0]
        if c in _HIDDEN:
            out.append((m.start(), m.end(), ""))
        elif (x := _ALIKE.get(c) or unicodedata.normalize("NFKC", c)) != c and len(x) == 1 and x.isascii():
            out.append((m.start(), m.end(), x))
    return out


def _dot_before(text: str, end: int, low: int) -> int:
    """Where a dot, plain or disguised, that ends at `end` starts; -1 if there is none after `low`."""
    i = end
    if i > low and text[i - 1] == "." and not (i - 1 > low and text[i - 2] in _BLANK):
        return i - 1
    while i > low and text[i - 1] in _BLANK:
        i -= 1
    closed = i > low and text[i - 1] in _CLOSING
    if closed:
        i -= 1
        while i > low and text[i - 1] in _BLANK:
            i -= 1
    elif i == end:
        return -1  # a bare word needs blanks on both sides
    tail = text[max(low, i - len(_DOT_WORDS[0])) : i].lower()
    if closed and tail.endswith("."):
        i -= 1
    elif word := next((w for w in _DOT_WORDS if tail.endswith(w)), None):
        i -= len(word)
    else:
        return -1
    j = i
    while i > low and text[i - 1] in _BLANK:
        i -= 1
    if not closed:
        return i if i < j else -1
    if i == low or text[i - 1] not in _OPENING:
        return -1
    i -= 1
    while i > low and text[i - 1] in _BLANK:
        i -= 1
    return i


def _name_before(text: str, end: int, low: int) -> tuple[int, list[tuple[int, int, str]]]:
    """Where the name of a mail address that ends at `end` starts, after `low`, and the edits of its disguised dots."""
    start, edits = end, []
    while True:
        i = start
        while i > low and text[i - 1] in _NAME_CHARS:
            i -= 1
        if i == start:
            return (end, []) if start == end else (edits[-1][1], edits[:-1]) if edits and edits[-1][1] == start else (start, edits)
        start, dot = i, _dot_before(text, i, low)
        if dot <= low or text[dot - 1] not in _NAME_CHARS:
            return start, edits
        if text[dot:start] != ".":
            edits.append((dot, start, "."))
        start = dot


def _mails(text: str) -> list[tuple[int, int, str]]:
    """Edits of "at" and "dot" disguises: a plain word " at " counts only before a disguised dot."""
    out: list[tuple[int, int, str]] = []
    for m in _AT.finditer(text):
        host = _HOST.match(text, m.end())
        if not host:
            continue
        start = m.start()
        low = max((x[1] for x in out[-1:]), default=0)
        while m[0] != "@" and start > low and text[start - 1] in " \t":
            start -= 1
        name, edits = _name_before(text, start, low)
        dots = [(d, d[0] != ".") for d in _DOTS.finditer(text, host.start(), host.end())]
        if name == start or m[0].strip()[0].isalpha() and not any(odd for _, odd in dots):
            continue
        out += reversed(edits)
        if m[0] != "@":
            out.append((start, m.end(), "@"))
        out += [(d.start(), d.end(), ".") for d, odd in dots if odd]
    return out


def _plus_before(text: str, end: int) -> int:
    """Where a plus, or the word, starts that only blanks part from `end`; -1 if there is none."""
    while end and text[end - 1] in _BLANK:
        end -= 1
    if end and text[end - 1] == "+":
        return end - 1
    start = end - len("plus")
    return start if start >= 0 and text[start:end].lower() == "plus" and not (start and (text[start - 1].isalnum() or text[start - 1] == "_")) else -1


def _spelled(text: str) -> list[tuple[int, int, str]]:
    """Edits of runs of named digits: four or more, or fewer beside figures or after a plus."""
    words = _WORDS.findall(text.lower())
    named = [i for i, w in enumerate(words) if w in _DIGITS]
    run = most = min(len(named), 1)
    for i, j in zip(named, named[1:], strict=False):
        run = run + 1 if j == i + 1 or all(w in _BETWEEN or w.isdecimal() for w in words[i + 1 : j]) else 1
        most = max(most, run)
    beside = any((i and words[i - 1].isdecimal()) or (i + 1 < len(words) and words[i + 1].isdecimal()) or (i and words[i - 1] == "plus") for i in named)
    if most < 4 and not beside and not ("+" in text and named):
        return []
    out = []
    for m in _SPELLED.finditer(text):
        if m.start() and (text[m.start() - 1].isalnum() or text[m.start() - 1] == "_"):
            continue
        parts = [(t.lastgroup, t[0].lower()) for t in _TOKEN.finditer(m[0])]
        n_named = sum(g == "d" for g, _ in parts)
        plus = _plus_before(text, m.start())
        if not n_named or n_named < 4 and plus < 0 and not any(g == "n" for g, _ in parts):
            continue
        digits = "".join(_DIGITS[t] if g == "d" else t if g == "n" else "." for g, t in parts)
        if plus >= 0:
            out.append((plus, m.end(), f"+{digits}"))
        else:
            out.append((m.start(), m.end(), digits))
    return out


def _apply(text: str, start: list[int], end: list[int], edits: list[tuple[int, int, str]]):
    """The rewritten text, and for each of its characters where its source starts and ends."""
    parts, s, e, at = [], [], [], 0
    for a, b, x in edits:
        if a < at:
            continue
        parts += [text[at:a], x]
        s += start[at:a] + [start[a]] * len(x)
        e += end[at:a] + [end[b - 1]] * len(x)
        at = b
    return "".join([*parts, text[at:]]), s + start[at:], e + end[at:]


def find_spans(text: str | None) -> list[tuple[int, int, int, bool]]:
    """(kind's number, start, end, undisguised?), by kind, then start; code points, end exclusive."""
    if not text:
        return []
    base = plain_spans(text)
    out = [(*x, True) for x in base]
    now, start, end = text, None, None
    for transducer in (_alike, _mails, _spelled):
        if edits := transducer(now):
            if start is None:
                start, end = list(range(len(text))), list(range(1, len(text) + 1))
            now, start, end = _apply(now, start, end, edits)
    if start is not None:
        for k, a, b in plain_spans(now):
            x, y = start[a], end[b - 1]
            if text[x:y] != now[a:b] and all(k != q or f <= x or y <= s or x <= s and f <= y and (x, y) != (s, f) for q, s, f in base):
                out.append((k, x, y, False))
    return sorted(out)


_TYPE = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("base", pa.bool_())]))


@F.arrow_udf(from_arrow_type(_TYPE))
def _spans(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
    for texts in batches:
        rows = ([{"kind": KINDS[k], "start": s, "end": e, "base": b} for k, s, e, b in find_spans(t.as_py())] for t in texts)
        yield pa.array(list(rows), _TYPE)


@F.arrow_udf(StringType())
def _redacted(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
    for texts, spans in batches:
        out = []
        for t, found in zip(texts.to_pylist(), spans.to_pylist(), strict=True):
            if t is None or not found:
                out.append(t)
                continue
            parts, at = [], 0
            for x in sorted(found, key=lambda x: (x["start"], -x["end"])):
                if x["start"] >= at:
                    parts += [t[at : x["start"]], f"[{x['kind'].upper()}]"]
                    at = x["end"]
                elif x["end"] > at:  # overlaps the last one: the rest goes too
                    at = x["end"]
            out.append("".join([*parts, t[at:]]))
        yield pa.array(out, pa.string())


def pii_spans(text: Column) -> Column:
    """array<struct<kind,start,end,base>> of a text column, by kind as listed in KINDS, then start.

    Null and empty texts give an empty array. Nothing is cut off: whole texts are scanned, in linear time.
    """
    return _spans(text)


def detect(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row for each row of docs: id_col and pii, the spans of text_col.

    Repeated rows stay repeated, a null id stays null, further columns are not read; an empty table gives an empty one.
    """
    bounded_batches(docs.sparkSession)
    return docs.select(F.col(id_col), pii_spans(F.col(text_col)).alias("pii"))


def redact(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """docs with each span in text_col replaced by its kind in brackets; a null text stays null."""
    bounded_batches(docs.sparkSession)
    text = F.col(text_col)
    return docs.withColumn(text_col, _redacted(text, pii_spans(text)))


def summary(found: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Counts of undisguised spans by kind, their digest, all spans, and how many the transducers added."""
    base = F.filter("pii", lambda s: s["base"])
    n = lambda kind: F.size(F.filter("pii", lambda s: s["base"] & (s["kind"] == kind))).cast("long")
    return found.select(
        id_col,
        *[n(k).alias(f"n_{k}") for k in KINDS],
        F.sha2(spans_text(base), 256).alias("base_sha256"),
        spans_text(F.col("pii")).alias("spans"),
        F.size(F.filter("pii", lambda s: ~s["base"])).cast("long").alias("n_disguised"),
    )
