"""Byte-level BPE by Spark expressions: distinct words are folded by higher-order functions, with a literal rank map.

A word is a string with a character for each of its bytes. The map is an array
of small maps, by a check sum of the key, so that a look-up reads a dozen entries
and not all of the vocabulary. Folded words are joined back to the documents
that have them; decoding concatenates the bytes that ids stand for.
"""

from __future__ import annotations

import json
import zlib

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from placeloom.llm.bpe import LONG, Tokenizer, load_ranks
from placeloom.llm.common import stage

#: Small maps that the rank map is cut into.
BUCKETS = 4096
#: The White_Space property.
_SPACE = r"\t-\r \x85\xa0\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"


def java_pattern(pattern: str) -> str:
    """The tokenizer's pattern for Java's matcher, whose \\s knows ASCII only."""
    return pattern.replace(r"[^\s\p{L}\p{N}]", rf"[^{_SPACE}\p{{L}}\p{{N}}]").replace(r"\s", f"[{_SPACE}]").replace(r"\S", f"[^{_SPACE}]")


def _bucketed(pairs: dict[str, object], kind: str) -> Column:
    buckets: list[dict] = [{} for _ in range(BUCKETS)]
    for k, v in pairs.items():
        buckets[zlib.crc32(k.encode()) % BUCKETS][k] = v
    return F.from_json(F.lit(json.dumps(buckets)), f"array<map<string,{kind}>>")


def _look_up(buckets: Column, key: Column) -> Column:
    return F.try_element_at(F.get(buckets, F.pmod(F.crc32(key.cast("binary")), F.lit(BUCKETS)).cast("int")), key)


def folded(word: Column, ranks: Column) -> Column:
    """array<int> of the ids of a word (a character for each byte). Of pairs with equal rank the leftmost merges first."""
    one = lambda p: _look_up(ranks, p)

    def merged(a: Column, _) -> Column:
        pairs = F.transform(F.sequence(F.lit(0), F.size(a["parts"]) - 2), lambda i: one(F.concat(F.get(a["parts"], i), F.get(a["parts"], i + 1))))
        found = F.transform(F.array(F.struct(pairs.alias("r"))), lambda x: F.struct((F.array_position(x["r"], F.array_min(x["r"])) - 1).cast("int").alias("at")))[0]["at"]
        both = lambda at: F.concat(F.slice(a["parts"], F.lit(1), at), F.array(F.concat(F.get(a["parts"], at), F.get(a["parts"], at + 1))), F.slice(a["parts"], at + 3, F.greatest(F.size(a["parts"]) - at - 2, F.lit(0))))
        step = F.transform(F.array(found), lambda at: F.struct(F.when(at.isNull() | (at < 0), a["parts"]).otherwise(both(at)).alias("parts"), (at.isNull() | (at < 0)).alias("done")))[0]
        return F.when(a["done"] | (F.size(a["parts"]) < 2), a).otherwise(step)

    n = F.length(word)
    start = F.struct(F.transform(F.sequence(F.lit(1), n), lambda i: F.substr(word, i, F.lit(1))).alias("parts"), F.lit(False).alias("done"))
    parts = F.aggregate(F.sequence(F.lit(1), F.greatest(n - 1, F.lit(1))), start, merged)["parts"]
    return F.when(one(word).isNotNull(), F.array(one(word))).otherwise(F.transform(parts, one))


def encode_by_words(docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """As bpe.encode_table: id_col, ids (decimal, joined by spaces) and decoded for each row of docs.

    Null and empty texts have no ids; repeated rows, null ids and further columns as there. Words of more than LONG bytes
    are folded by bpe's heap, as a fold over all pairs takes their length squared.
    """
    spark = docs.sparkSession
    ranks = load_ranks(path)
    by_piece = _bucketed({k.decode("latin-1"): v for k, v in ranks.items()}, "int")
    by_id = _bucketed({str(v): k.hex() for k, v in ranks.items()}, "string")
    pieces = F.regexp_extract_all(F.coalesce(F.col(text_col), F.lit("")), F.lit(java_pattern(pattern)), F.lit(0))
    rows = stage(docs.select(F.col(id_col).alias("id"), pieces.alias("pieces")).withColumn("row", F.monotonically_increasing_id()), "pieces")
    each = rows.select("row", F.explode(F.array_distinct("pieces")).alias("word"))
    words = each.select("word").distinct()
    short = words.where(F.octet_length("word") <= LONG).select("word", F.array_join(folded(F.decode(F.encode("word", "utf-8"), "iso-8859-1"), by_piece).cast("array<string>"), " ").alias("ids"))
    tokenizer = Tokenizer(spark, path, pattern)
    long = words.where(F.octet_length("word") > LONG).select("word", tokenizer.encode(F.col("word")).alias("ids"))
    known = stage(short.union(long), "words")
    mine = each.join(known, "word").groupBy("row").agg(F.map_from_entries(F.collect_list(F.struct("word", "ids"))).alias("known"))
    joined = rows.join(mine, "row", "left")
    out = joined.select("id", F.coalesce(F.array_join(F.transform("pieces", lambda w: F.try_element_at(F.col("known"), w)), " "), F.lit("")).alias("ids"))
    pieces_of = F.transform(F.filter(F.split("ids", " "), lambda x: x != ""), lambda x: _look_up(by_id, x))
    return out.select(F.col("id").alias(id_col), "ids", F.unhex(F.array_join(pieces_of, "")).alias("decoded"))
