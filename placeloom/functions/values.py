"""Messy public-file values to typed ones: all are expressions on columns."""

from __future__ import annotations

from collections.abc import Sequence
from functools import partial

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

# What stands for no value, and for a suppressed one; umlauts folded.
NULL_TOKENS = ("", "nan", "none", "n/a", "-")
SUPPRESSED = ("–", ".", "...", "x", "/", "<5")
UMLAUTS = (("ä", "ae"), ("ö", "oe"), ("ü", "ue"), ("ß", "ss"))


def blank_to_null(c: Column, tokens: Sequence[str] = NULL_TOKENS) -> Column:
    return F.when(F.lower(F.trim(c)).isin(*tokens), None).otherwise(F.trim(c))


def parse_number(c: Column, comma: bool = True) -> Column:
    """A double from text, null for null tokens, suppression marks and what is no number.

    Blanks, apostrophes and a per cent sign go. If comma, a comma is the decimal mark; where dots come too, the last of the
    two is the decimal mark and the other groups digits. Dots alone group digits if there are several, each before three
    digits; a single one is a decimal mark.
    """
    text = F.regexp_replace(blank_to_null(c, NULL_TOKENS + SUPPRESSED), "[\\s\u00a0'%]", "")
    if comma:
        dot, mark = F.lit("."), F.lit(",")
        english = text.contains(",") & text.contains(".") & (F.length(text) - F.locate(".", F.reverse(text)) > F.length(text) - F.locate(",", F.reverse(text)))
        text = F.when(english, F.replace(text, mark, F.lit(""))).when(text.contains(","), F.replace(F.replace(text, dot, F.lit("")), mark, dot)).when(text.rlike(r"^[+-]?[0-9]{1,3}(\.[0-9]{3}){2,}$"), F.replace(text, dot, F.lit(""))).otherwise(text)
    return text.try_cast("double")


def parse_int(c: Column, comma: bool = True) -> Column:
    return parse_number(c, comma).try_cast("bigint")


def coerce(c: Column, kind: str) -> Column:
    """Text for a sink's field: int by way of a double, float, or text without a trailing ".0"."""
    text = blank_to_null(c)
    if kind == "int":
        return text.try_cast("double").try_cast("bigint")
    if kind == "float":
        return text.try_cast("double")
    return F.regexp_replace(text, r"^(-?[0-9]+)\.0$", "$1")


def pad_code(c: Column, width: int) -> Column:
    """A code without ".0", zeros in front up to width; longer codes stay as they are."""
    code = F.regexp_replace(F.trim(c), r"\.0$", "")
    return F.when(F.length(code) >= width, code).otherwise(F.lpad(code, width, "0"))


def canonical_id(c: Column) -> Column:
    """Digits without zeros in front and ".0" behind; other ids trimmed and upper-case. Text throughout, so no digit is lost."""
    text = F.trim(c)
    return F.when(text.rlike(r"^[0-9]+(\.0+)?$"), F.regexp_replace(F.regexp_replace(text, r"\.0+$", ""), r"^0+(?=[0-9])", "")).otherwise(F.upper(text))


def postcode(c: Column) -> Column:
    return F.nullif(F.regexp_extract(c, r"\b([0-9]{5})\b", 1), F.lit(""))


def clean_url(c: Column) -> Column:
    """https, whatever the case of the scheme; no citation marks, no trailing slash or punctuation; null tokens are null."""
    url = F.regexp_replace(blank_to_null(c), r"\[[0-9]+\]", "")
    url = F.regexp_replace(url, r"[.,;)\s/]+$", "")
    return F.concat(F.lit("https://"), F.regexp_replace(url, r"(?i)^https?://", ""))


def join_parts(*parts: Column, sep: str = " ") -> Column:
    """The non-empty parts joined; null if there are none."""
    return F.nullif(F.concat_ws(sep, *[F.nullif(F.trim(p), F.lit("")) for p in parts]), F.lit(""))


def phone(area: Column, number: Column) -> Column:
    return join_parts(F.coalesce(area.try_cast("double").try_cast("bigint").cast("string"), F.trim(area)), number, sep=" / ")


def strip_label(c: Column, pattern: str) -> Column:
    return F.trim(F.regexp_replace(c, pattern, ""))


def decode(c: Column, codes: dict[str, str], default: str | None = None) -> Column:
    """The value of a code. The mapping is a literal: for long code lists join a table instead."""
    pairs = F.create_map(*[F.lit(x) for kv in codes.items() for x in kv])
    return F.coalesce(F.try_element_at(pairs, c), F.lit(default))


def classify(c: Column, rules: Sequence[tuple[str, str]], default: str | None = None) -> Column:
    """The label of the first (pattern, label) whose pattern is in the lower-case text."""
    out, low = None, F.lower(c)
    for pattern, label in rules:
        out = F.when(low.rlike(pattern), label) if out is None else out.when(low.rlike(pattern), label)
    return out.otherwise(F.lit(default))


def classify_tags(tags: Column, rules: Sequence[tuple[str, str, str]], default: str | None = None) -> Column:
    """The label of the first (key, value, label) that a map has."""
    out = F.lit(default)
    for key, value, label in reversed(rules):
        out = F.when(F.try_element_at(tags, F.lit(key)) == value, label).otherwise(out)
    return out


def largest_family(families: dict[str, Sequence[str]], default: str | None = None) -> Column:
    """The first family whose columns sum to most; default if all sums are 0."""
    sums = {k: sum((F.coalesce(parse_number(F.col(c).cast("string")), F.lit(0.0)) for c in cs), F.lit(0.0)) for k, cs in families.items()}
    most = F.greatest(*sums.values(), F.lit(0.0))
    out = F.when(most == 0, F.lit(default))
    for k, s in sums.items():
        out = out.when(s == most, k)
    return out


def canonical_name(c: Column, stop: Sequence[str] = ()) -> Column:
    """Lower case, umlauts folded, no parentheses, punctuation or stop words, single spaces."""
    name = F.regexp_replace(F.lower(c), r"\([^)]*\)", " ")
    for a, b in UMLAUTS:
        name = F.replace(name, F.lit(a), F.lit(b))
    name = F.regexp_replace(F.translate(name, "éèêáàâóòôíìîúùûñç", "eeeaaaoooiiiuuunc"), r"[^a-z0-9]+", " ")
    if stop:
        name = F.regexp_replace(name, rf"\b(?:{'|'.join(stop)})\b", " ")
    return F.trim(F.regexp_replace(name, r" +", " "))


def peel_suffix(c: Column, suffixes: Sequence[str]) -> tuple[Column, Column]:
    """(text before, suffix) for the longest of the suffixes that the text ends with."""
    pattern = rf"^(.*?)({'|'.join(sorted(suffixes, key=lambda s: (-len(s), s)))})$"
    end = F.regexp_extract(c, pattern, 2)
    return F.when(end == "", c).otherwise(F.regexp_extract(c, pattern, 1)), F.nullif(end, F.lit(""))


def items(c: Column, sep: str = "[,;]", ordered: bool = True) -> Column:
    """Distinct trimmed items of delimited text, sorted or as first seen."""
    each = F.array_distinct(F.filter(F.transform(F.split(c, sep), F.trim), lambda x: x != ""))
    return F.array_sort(each) if ordered else each


def first_number(c: Column, patterns: Sequence[str], low: float, high: float) -> Column:
    """The first pattern's number (group 1) that lies in the range."""
    found = [F.nullif(F.regexp_extract(c, p, 1), F.lit("")).try_cast("double") for p in patterns]
    return F.coalesce(*[F.when(x.between(low, high), x) for x in found])


def first_valid(columns: Sequence[Column], low: float, high: float) -> Column:
    return F.coalesce(*[F.when(c.between(low, high), c) for c in columns])


def indicator(condition: Column) -> Column:
    """1.0, 0.0, or null where the condition is null."""
    return F.when(condition, 1.0).when(~condition, 0.0)


def unless_generic(c: Column, other: Column, generic: Sequence[str]) -> Column:
    return F.when(F.lower(F.trim(c)).isin(*generic) | c.isNull(), other).otherwise(c)


def namespaced(source: str, c: Column) -> Column:
    return F.concat_ws("_", F.lit(source), F.trim(c))


def url_key(c: Column) -> Column:
    return F.sha1(F.lower(F.trim(c)))


def is_fresh(c: Column, now: Column, days: int) -> Column:
    return F.coalesce(now - c < F.make_dt_interval(F.lit(days)), F.lit(False))


def pattern_score(c: Column, rules: Sequence[tuple[str, float]]) -> Column:
    """The sum of the weights of the patterns found."""
    return sum((F.when(F.lower(c).rlike(p), F.lit(float(w))).otherwise(0.0) for p, w in rules), F.lit(0.0))


def _or_default(field: str, value: str, d: Column) -> Column:
    return d.withField(field, F.coalesce(F.nullif(F.trim(d[field]), F.lit("")), F.lit(value)))


def _with_value(field: str, value: str, d: Column) -> Column:
    return d.withField(field, F.lit(value))


def coming_days(days: Column, today: Column, kind: str = "date", defaults: dict[str, str] | None = None, lacking: dict[str, str] | None = None) -> Column:
    """Structs with a well-formed date that is not past, by date.

    defaults: values of fields where they are null or blank; lacking: fields that the structs do not have, with their value.
    """
    good = F.filter(days, lambda d: F.try_to_date(d[kind]) >= today)
    for field, value in (defaults or {}).items():
        good = F.transform(good, partial(_or_default, field, value))
    for field, value in (lacking or {}).items():
        good = F.transform(good, partial(_with_value, field, value))
    return F.array_sort(good, lambda a, b: F.when(a[kind] < b[kind], -1).when(a[kind] > b[kind], 1).otherwise(0))


def parsed_json(c: Column, schema: str, default: Column) -> Column:
    """The record in JSON text; default for null, empty and malformed text. Fields the text lacks are null."""
    read = F.from_json(c, f"{schema}, _malformed string", {"columnNameOfCorruptRecord": "_malformed"})
    record = F.struct(*[read[f].alias(f) for f in StructType.fromDDL(schema).names])
    return F.when(read.isNull() | read["_malformed"].isNotNull() | (F.trim(c) == ""), default).otherwise(record)


def merged_arrays(old: Column, new: Column, fields: Sequence[str]) -> Column:
    """Structs merged by position; a field of new wins where it has a value."""
    return F.zip_with(old, new, lambda x, y: F.struct(*[F.coalesce(y[f], x[f]).alias(f) for f in fields]))


def brackets(keys: Sequence[str], base: Column, step: float) -> Column:
    """A map from each key to base, grown by step for each position."""
    return F.map_from_arrays(F.array(*map(F.lit, keys)), F.array(*[base * (1 + step * i) for i in range(len(keys))]))


def valid_brackets(m: Column, keys: Sequence[str]) -> Column:
    """The map where it has all keys and no negative value, else null."""
    whole = F.size(F.array_except(F.array(*map(F.lit, keys)), F.map_keys(m))) == 0
    return F.when(whole & F.forall(F.map_values(m), lambda v: F.coalesce(v >= 0, F.lit(False))), m)


def is_flat(m: Column) -> Column:
    return F.size(F.array_distinct(F.map_values(m))) == 1


def refined_status(status: Column, *payload: Column) -> Column:
    """status, but "empty" where all of the payload (arrays or text) is missing, empty or blank."""
    missing = F.lit(True)
    for p in payload:
        missing = missing & F.coalesce(p.cast("string").isin("", "[]", "{}") | (F.trim(p.cast("string")) == ""), F.lit(True))
    return F.when(missing, F.lit("empty")).otherwise(status)


def fee_text(amount: Column, summary: Column, flags: dict[str, Column], private: Column) -> Column:
    """The amount, else the summary, with the names of the flags that hold; else what the ownership suggests."""
    first = F.coalesce(F.when(amount > 0, F.concat(F.format_string("%.2f", amount.cast("double")), F.lit(" a month"))), F.nullif(F.trim(summary), F.lit("")))
    text = F.concat_ws(" | ", first, *[F.when(c, F.lit(name)) for name, c in flags.items()])
    return F.coalesce(F.nullif(text, F.lit("")), F.when(private, F.lit("on request")).otherwise(F.lit("free")))


def modes(labels: dict[str, Column], fallback: Column) -> Column:
    """All labels whose condition holds, as an array; where none does, the fallback alone, if it has a value."""
    found = F.array_compact(F.array(*[F.when(c, F.lit(k)) for k, c in labels.items()]))
    return F.when(F.size(found) > 0, found).otherwise(F.array_compact(F.array(fallback)))


def by_id_prefix(c: Column, width: int, codes: dict[str, str], default: str | None = None) -> Column:
    """The value that the first characters of an id stand for."""
    return decode(F.substring(F.trim(c), 1, width), codes, default)


def by_id_character(c: Column, at: int, codes: dict[str, str], fallback: Column) -> Column:
    """The value of one upper-case character of an id; where it has none, the fallback."""
    return F.coalesce(decode(F.substring(F.upper(F.trim(c)), at, 1), codes), fallback)


def item_count(*columns: Column, sep: str = "[,;]") -> Column:
    """Distinct items of several columns of delimited text together."""
    return F.size(F.array_distinct(F.flatten(F.array(*[F.coalesce(items(c, sep, ordered=False), F.array().cast("array<string>")) for c in columns]))))
