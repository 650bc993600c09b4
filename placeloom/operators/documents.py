"""Texts for search from pages and rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from placeloom.functions.scores import bands


# Named characters of HTML; the ampersand last, so that nothing is read twice.
ENTITIES = (("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&apos;", "'"), ("&auml;", "ä"), ("&ouml;", "ö"), ("&uuml;", "ü"), ("&Auml;", "Ä"), ("&Ouml;", "Ö"), ("&Uuml;", "Ü"), ("&szlig;", "ß"), ("&euro;", "€"), ("&copy;", "©"), ("&middot;", "·"), ("&amp;", "&"))


def unescaped(text: Column) -> Column:
    """Character references as what they stand for: numbers of any size, decimal or hexadecimal, and the names in ENTITIES.

    0, surrogates and what is beyond Unicode give U+FFFD. What one reference gives is not read as part of another.
    """
    parts = F.split(text, "&#")

    def number(part: Column) -> Column:
        dec, hexa = F.regexp_extract(part, r"^0*([0-9]{1,7});", 1), F.regexp_extract(part, r"^[xX]0*([0-9A-Fa-f]{1,6});", 1)
        code = F.when(dec != "", dec.cast("int")).when(hexa != "", F.conv(hexa, 16, 10).cast("int"))
        some = part.rlike(r"^([0-9]+|[xX][0-9A-Fa-f]+);")
        good = code.between(1, 0x10FFFF) & ~code.between(0xD800, 0xDFFF)
        found = F.when(good, F.decode(F.unhex(F.lpad(F.hex(code), 8, "0")), "UTF-32")).otherwise(F.lit("\ufffd"))
        # an ampersand of its own waits for the names to be read
        found = F.when(code == 38, F.lit("&amp;")).otherwise(found)
        return F.when(some, F.concat(found, F.regexp_replace(part, r"^([0-9]+|[xX][0-9A-Fa-f]+);", ""))).otherwise(F.concat(F.lit("&#"), part))

    text = F.concat(parts[0], F.array_join(F.transform(F.slice(parts, 2, F.greatest(F.size(parts), F.lit(1))), number), ""))
    for name, c in ENTITIES:
        text = F.replace(text, F.lit(name), F.lit(c))
    return text


#: A tag; quoted values may hold ">". What has an odd quote ends at its first ">".
_TAG = r"""<[A-Za-z/!?](?:[^'">]++|"[^"]*+"|'[^']*+')*+>"""


def html_to_text(html: Column, most: int | None = None) -> Column:
    """Without comments, scripts, styles and tags, references read, single spaces, at most so many characters if the sink asks for it."""
    text = F.regexp_replace(html, r"(?s)<!--.*?-->", " ")
    text = F.regexp_replace(text, r"(?is)<(script|style)\b[^>]*>.*?</(script|style)\s*>", " ")
    text = F.regexp_replace(F.regexp_replace(text, _TAG, " "), r"(?s)<[A-Za-z/!?][^>]*>", " ")
    text = F.trim(F.regexp_replace(unescaped(text), r"[\s\u00a0]+", " "))
    return F.substring(text, 1, most) if most else text


def page_document(title: Column, markdown: Column, cleaned: Column, tables: Column, least: int = 1) -> Column:
    """Title, the markdown or where that is blank the cleaned text, and the tables as text."""
    filled = lambda c: F.when(F.length(F.trim(c)) >= least, F.trim(c))
    rows = F.array_join(F.transform(tables, table_text), "\n\n")
    return assembled([("# ", title), ("", F.coalesce(filled(markdown), filled(cleaned))), ("Tables:\n", rows)])


def element_documents(df: DataFrame, key: str, elements: str, url: str, text: str) -> DataFrame:
    """One document for each struct of an array: id from the last part of its URL, else the key and the position; content from its text."""
    each = df.select(key, F.posexplode(elements).alias("_at", "_e"))
    slug = F.nullif(F.regexp_extract(F.col(f"_e.{url}"), r"([^/?#]+)/?(?:[?#].*)?$", 1), F.lit(""))
    return each.select(F.coalesce(slug, F.concat_ws("_", F.col(key).cast("string"), F.col("_at"))).alias("id"), F.col(f"_e.{url}").alias("url"), F.trim(F.col(f"_e.{text}")).alias("content")).where(F.length("content") > 0)


def metric_narrative(name: Column, values: Sequence[tuple[str, Column, Column]]) -> Column:
    """"name: label now (+x.x %); ..." from (label, now, change in per cent); a value without a change stands alone."""
    sign = lambda p: F.concat(F.lit(" ("), F.when(p >= 0, "+").otherwise(""), F.format_string("%.1f", p), F.lit(" %)"))
    parts = [F.when(now.isNotNull(), F.concat(F.lit(f"{label} "), now.cast("bigint").cast("string"), F.when(p.isNotNull(), sign(p)).otherwise(""))) for label, now, p in values]
    return F.concat(name, F.lit(": "), F.concat_ws("; ", *parts))


def station_document(name: Column, place: Column, counts: Sequence[tuple[str, Column]]) -> Column:
    """What a counting station is, where, and its mean counts, whole numbers; measures without a value go."""
    said = F.concat_ws(", ", *[F.when(c.isNotNull(), F.concat(F.round(c).cast("bigint").cast("string"), F.lit(f" {label}"))) for label, c in counts])
    return F.concat_ws(" ", F.concat(F.lit("Counting station "), name, F.lit(".")), F.when(F.trim(place) != "", F.concat(F.lit("It is in "), place, F.lit("."))), F.when(said != "", F.concat(F.lit("On average: "), said, F.lit(" an hour."))))


def description(sentences: Sequence[Column]) -> Column:
    """Those sentences that have a value, one after the other."""
    return F.concat_ws(" ", *sentences)


def size_phrase(n: Column, bounds: Sequence[tuple[float, str]], above: str) -> Column:
    return bands(n, bounds, above)


def ratio_sentence(name: Column, pupils: Column, teachers: Column) -> Column:
    """"name has p pupils and t teachers, a ratio of r to 1."; what is unknown is left out."""
    ratio = F.try_divide(pupils.cast("double"), teachers.cast("double"))
    both = F.when(ratio.isNotNull(), F.concat(F.lit(", a ratio of "), F.format_string("%.1f", ratio), F.lit(" to 1")))
    has = F.concat_ws(" and ", F.concat(pupils.cast("string"), F.lit(" pupils")), F.concat(teachers.cast("string"), F.lit(" teachers")))
    return F.when(has != "", F.concat(name, F.lit(" has "), has, F.coalesce(both, F.lit("")), F.lit(".")))


# A street's name: capitalised words and abbreviations, with small words and ordinal numbers between them.
_NAME = r"(?:[A-ZÄÖÜ][A-Za-zÄÖÜäöüß-]*str\.|(?:Str|St|Dr|Prof)\.|[A-ZÄÖÜ][A-Za-zÄÖÜäöüß-]*+(?!\.))"
_SMALL = r"(?:de[rsmn]|a[mn]|auf|i[mn]|zu[mr]?|vo[nrm]|und|unter|[0-9]{1,2}\.)"
_STREET = rf"{_NAME}(?: {_NAME}| {_SMALL})*"


def address_of(text: Column) -> Column:
    """The first "Street 12a, 12345 Town" of a page's text, else the first postcode with the word after it.

    A street may have several words, such as "Am Alten Markt" or "Straße des 17. Juni"; capitalised words right before it
    count as part of it, since nothing tells them apart. Numbers may be "12", "12a", "12 a" or "12-14".
    """
    full = F.regexp_extract(text, rf"(?<![A-Za-zÄÖÜäöüß-])({_STREET} [0-9]+ ?[a-z]?(?:-[0-9]+[a-z]?)?, [0-9]{{5}} [A-ZÄÖÜ][A-Za-zäöüß-]+)", 1)
    short = F.regexp_extract(text, r"\b([0-9]{5} [A-ZÄÖÜ][A-Za-zäöüß-]+)", 1)
    return F.coalesce(F.nullif(full, F.lit("")), F.nullif(short, F.lit("")))


def website_of(text: Column) -> Column:
    """The first address with a scheme, else the first that begins with www."""
    return F.coalesce(*[F.nullif(F.regexp_extract(text, p, 1), F.lit("")) for p in (r"(https?://[A-Za-z0-9./_-]*[A-Za-z0-9/])", r"\b(www\.[A-Za-z0-9./_-]*[A-Za-z0-9/])")])


def assembled(parts: Sequence[tuple[str, Column]], sep: str = "\n\n") -> Column:
    """The non-empty parts, each after its label."""
    return F.concat_ws(sep, *[F.when(F.trim(c) != "", F.concat(F.lit(label), c)) for label, c in parts])


def table_text(table: Column) -> Column:
    return F.array_join(F.transform(table, lambda row: F.array_join(row, " | ")), "\n")


def trend_sentence(name: Column, pct: Column) -> Column:
    way = F.when(pct > 10, "rose clearly").when(pct < -10, "fell clearly").otherwise("stayed about the same")
    return F.concat(name, F.lit(" "), way)


def fenced_json(text: Column, schema: str, defaults: dict[str, object] | None = None) -> Column:
    """The record in the first fenced block of JSON; trailing commas are repaired, missing keys take their defaults."""
    body = F.regexp_extract(text, r"(?s)```(?:json)?\s*(\{.*?\})\s*```", 1)
    record = F.from_json(F.nullif(F.regexp_replace(body, r",\s*([}\]])", "$1"), F.lit("")), schema)
    for k, x in (defaults or {}).items():
        record = F.when(record.isNotNull(), record.withField(k, F.coalesce(record[k], F.lit(x))))
    return record


def ranked_list(text: Column, low: float = 1.0, high: float = 6.0) -> Column:
    """array<struct<rank,name,grade>> of "1. Name 1,9" items in running text, grades in range only."""
    p = r"([0-9]{1,3})\. ([^0-9]+?) ([0-9][.,][0-9]{1,2})"
    parts = F.arrays_zip(F.regexp_extract_all(text, F.lit(p), F.lit(1)).alias("rank"), F.regexp_extract_all(text, F.lit(p), F.lit(2)).alias("name"), F.regexp_extract_all(text, F.lit(p), F.lit(3)).alias("grade"))
    rows = F.transform(parts, lambda x: F.struct(x["rank"].cast("int").alias("rank"), x["name"].alias("name"), F.replace(x["grade"], F.lit(","), F.lit(".")).cast("double").alias("grade")))
    return F.filter(rows, lambda x: x["grade"].between(low, high))
