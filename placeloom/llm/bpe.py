"""Byte-level BPE by a table of ranks: texts to ids and back.

A text is split into pieces by the tokenizer's pattern. Each distinct word of a
task is split and folded once: the neighbouring parts with the lowest rank merge until
none has a rank. Ids go out as decimal numbers joined by spaces; decoding
concatenates the byte strings that they stand for.
"""

from __future__ import annotations

import base64
import heapq
import re
from collections.abc import Callable, Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, StringType, StructField, StructType

from placeloom.llm.common import bounded_batches
from placeloom.llm.merges import Pairs, merge
from placeloom.llm.words import Remembered, between_visible, distinct, joined, nowhere, slices

#: Pieces over as many bytes are merged by a heap instead of by looking through all pairs.
LONG = 64
#: Characters of the White_Space property.
_SPACE = r"\t-\r \x85\xa0  -     　"


def load_ranks(path: str) -> dict[bytes, int]:
    """Lines of base64 bytes and rank. The file has a fixed size: it's the tokenizer's vocabulary."""
    return {base64.b64decode(a): int(b) for a, b in map(bytes.split, Path(path).read_bytes().splitlines()) if b}


def splitter(pattern: str):
    """A function from a text to its pieces.

    In texts of Latin letters only, the classes of the pattern are short enough to be written out for the faster
    matcher of the standard library; \\s is the White_Space property in both.
    """
    general = regex.compile(pattern.replace(r"[^\s\p{L}\p{N}]", rf"[^{_SPACE}\p{{L}}\p{{N}}]").replace(r"\s", f"[{_SPACE}]").replace(r"\S", f"[^{_SPACE}]"))
    letters, numbers, white = "A-Za-z\xaa\xb5\xba\xc0-\xd6\xd8-\xf6\xf8-ɏ", "0-9\xb2\xb3\xb9\xbc-\xbe", "\t-\r \x85\xa0"
    latin = pattern.replace(r"[^\s\p{L}\p{N}]", f"[^{white}{letters}{numbers}]").replace(r"\p{L}", f"[{letters}]").replace(r"\p{N}", f"[{numbers}]").replace(r"\S", f"[^{white}]").replace(r"\s", f"[{white}]")
    try:
        quick, other = re.compile(latin), re.compile("[^\x00-ɏ]")
    except re.error:
        return general.findall
    return lambda text: (general if other.search(text) else quick).findall(text)


def fold(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """The ids of one piece. Of pairs with equal rank the leftmost merges first."""
    if piece in ranks:
        return [ranks[piece]]
    parts = [piece[i : i + 1] for i in range(len(piece))]
    if len(parts) > LONG:
        return _fold_long(parts, ranks)
    get = ranks.get
    pairs = [get(a + b) for a, b in zip(parts, parts[1:], strict=False)]
    while True:
        best, at = None, -1
        for k, r in enumerate(pairs):
            if r is not None and (best is None or r < best):
                best, at = r, k
        if best is None:
            return [ranks[p] for p in parts]
        parts[at : at + 2] = [parts[at] + parts[at + 1]]
        del pairs[at]
        if at < len(pairs):
            pairs[at] = get(parts[at] + parts[at + 1])
        if at:
            pairs[at - 1] = get(parts[at - 1] + parts[at])


def _fold_long(parts: list, ranks: dict[bytes, int]) -> list[int]:
    n = len(parts)
    after, before = [*range(1, n), -1], [-1, *range(n - 1)]
    heap = [(r, i, parts[i] + parts[i + 1]) for i in range(n - 1) if (r := ranks.get(parts[i] + parts[i + 1])) is not None]
    heapq.heapify(heap)
    while heap:
        _, i, both = heapq.heappop(heap)
        j = after[i]
        if parts[i] is None or j < 0 or parts[i] + parts[j] != both:
            continue  # one of the two has merged meanwhile
        parts[i], parts[j], after[i] = both, None, after[j]
        if after[j] >= 0:
            before[after[j]] = i
            if (r := ranks.get(both + parts[after[j]])) is not None:
                heapq.heappush(heap, (r, i, both + parts[after[j]]))
        if (h := before[i]) >= 0 and (r := ranks.get(parts[h] + both)) is not None:
            heapq.heappush(heap, (r, h, parts[h] + both))
    return [ranks[p] for p in parts if p is not None]


def _learner(vocabulary: Vocabulary, pieces) -> Callable[[list[str]], list[str]]:
    """A function that gives words the ids of their pieces; pieces that are no token are merged in rounds, all together.

    A word of letters only, behind a blank or not, is one piece of any pattern for which blanks part words.
    """
    names = {t: str(r) for t, r in vocabulary.ranks.items()}

    def merged(some: list[bytes]) -> list[str]:
        if not some:
            return []
        symbols, sizes = merge(vocabulary.pairs, vocabulary.single[np.frombuffer(b"".join(some), np.uint8)], np.array(list(map(len, some))))
        return joined(sizes, pa.array(symbols).cast(pa.large_string()), " ").to_pylist()

    def learn(words: list[str]) -> list[str]:
        out: list = [None] * len(words)
        alone, at, several, unknown = [], [], [], {}
        for i, w in enumerate(words):
            if (w[1:] if w[:1] == " " else w).isalpha():
                one = w.encode()
                if (x := names.get(one)) is None:
                    at.append(i)
                    alone.append(one)
                else:
                    out[i] = x
            else:
                ps = [p.encode() for p in pieces(w)]
                several.append((i, ps))
                unknown.update((p, "") for p in ps if p not in names)
        found = merged([*alone, *unknown])
        for i, x in zip(at, found, strict=False):
            out[i] = x
        unknown = dict(zip(unknown, found[len(alone) :], strict=True))
        for i, ps in several:
            out[i] = " ".join([names.get(p) or unknown[p] for p in ps])
        return out

    return learn


def _encoded(known: Remembered, texts: pa.Array, starts) -> pa.Array:
    words, counts = distinct(texts.cast(pa.large_string()).fill_null(""), starts)
    return joined(counts, pa.array(known.all_of(words.dictionary.to_pylist()), pa.large_string()).take(words.indices), " ")


def _decoded(table: dict[str, bytes], ids: pa.Array) -> pa.Array:
    lists = pc.split_pattern(ids.cast(pa.large_string()), " ")
    flat = lists.flatten().dictionary_encode()
    pieces = pa.array([table[x] if x else b"" for x in flat.dictionary.to_pylist()], pa.large_binary()).take(flat.indices)
    return joined(pc.list_value_length(lists).to_numpy(zero_copy_only=False), pieces, b"")


class Vocabulary:
    """The ranks, and the rank of each pair of tokens that makes a token; of fixed size."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.single = np.array([ranks[bytes([b])] for b in range(256)], np.int64)
        self.pairs = Pairs((ranks[a], ranks[b], r, r) for t, r in ranks.items() for k in range(1, len(t)) if (a := t[:k]) in ranks and (b := t[k:]) in ranks)


def _table(ranks: dict[bytes, int]) -> dict[str, bytes]:
    return {str(r): p for p, r in ranks.items()}


def _encoder(vocabulary, pattern: str, starts):
    @F.arrow_udf(StringType())
    def encode(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        known = Remembered(_learner(vocabulary.value, splitter(pattern)))
        for texts in batches:
            yield pa.concat_arrays([_encoded(known, some, starts).cast(pa.string()) for some in slices(texts)])

    return encode


def _round(vocabulary, pattern: str, starts):
    @F.arrow_udf(StructType([StructField("ids", StringType()), StructField("decoded", BinaryType())]))
    def there_and_back(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        known, table = Remembered(_learner(vocabulary.value, splitter(pattern))), _table(vocabulary.value.ranks)
        for texts in batches:
            done = []
            for some in slices(texts):
                ids = _encoded(known, some, starts)
                done.append(pa.StructArray.from_arrays([ids.cast(pa.string()), _decoded(table, ids).cast(pa.binary())], ["ids", "decoded"]))
            yield pa.concat_arrays(done)

    return there_and_back


def _decoder(vocabulary):
    @F.arrow_udf(BinaryType())
    def decode(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        table = _table(vocabulary.value.ranks)
        for ids in batches:
            yield pa.concat_arrays([_decoded(table, some.fill_null("")).cast(pa.binary()) for some in slices(ids)])

    return decode


class Tokenizer:
    """Column functions for one vocabulary. The ranks, of fixed size, reach the executors once, as a broadcast.

    blanks_part: whether the pattern never lets a piece go over the place before a blank that stands between two visible
    ASCII characters; words begin there then, each split and folded once while it is remembered. Else a text is one word.
    """

    def __init__(self, spark: SparkSession, path: str, pattern: str, blanks_part: bool = False):
        vocabulary = spark.sparkContext.broadcast(Vocabulary(load_ranks(path)))
        starts = between_visible if blanks_part else nowhere
        self._encode, self._both, self._decode = _encoder(vocabulary, pattern, starts), _round(vocabulary, pattern, starts), _decoder(vocabulary)

    def encode(self, text: Column) -> Column:
        """Decimal ids joined by one space; for null and empty texts the empty string. Special tokens are plain text."""
        return self._encode(text)

    def round_trip(self, text: Column) -> Column:
        """A struct of ids, as encode gives them, and decoded, what decode gives for them."""
        return self._both(text)

    def decode(self, ids: Column) -> Column:
        """The bytes that ids stand for."""
        return self._decode(ids)


def ids_array(ids: Column) -> Column:
    """ids as array<int>."""
    return F.when(ids == "", F.array().cast("array<int>")).otherwise(F.split(ids, " ").cast("array<int>"))


def encode_table(docs: DataFrame, tokenizer: Tokenizer, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row for each row of docs: id_col, ids, decoded.

    Whole texts; repeated rows stay repeated; null ids stay; further columns are not read; an empty table gives an
    empty one.
    """
    bounded_batches(docs.sparkSession)
    return docs.select(F.col(id_col), tokenizer.round_trip(F.col(text_col)).alias("_e")).select(id_col, "_e.ids", "_e.decoded")


def summary(encoded: DataFrame, id_col: str = "doc_id") -> DataFrame:
    n = F.when(F.col("ids") == "", 0).otherwise(F.length("ids") - F.length(F.translate("ids", " ", "")) + 1)
    return encoded.select(id_col, n.cast("long").alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))
