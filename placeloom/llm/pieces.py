"""BPE over pieces with byte fallback (SentencePiece models): texts to ids and back.

White space becomes a mark in front of the next word, and no piece goes on beyond a word, so each distinct word of a
task is merged once while it is remembered. The symbols of all its words lie in one flat array. A round finds each word's least rank
of neighbouring pairs and merges its leftmost pairs of that rank in all words at once; words without a pair left are
taken out, until none remains.
"""

from __future__ import annotations

import codecs
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType
from sentencepiece import SentencePieceProcessor

from placeloom.llm.common import bounded_batches
from placeloom.llm.merges import Pairs, merge
from placeloom.llm.words import Remembered, at_blanks, distinct, joined, slices

#: The mark that stands for a blank inside pieces.
MARK = "▁"
#: Characters that no piece has are their code point from here on.
OTHER = 1 << 21

_EACH_BYTE = "placeloom_each_byte"
codecs.register_error(_EACH_BYTE, lambda e: ("�", e.start + 1))


class Pieces(Pairs):
    """The tables of one model, of fixed size: the symbol of each character, the rank and result of each pair, the bytes of each id."""

    def __init__(self, path: str):
        model = SentencePieceProcessor(model_file=path)
        names = [model.id_to_piece(i) for i in range(model.get_piece_size())]
        plain = [i for i in range(len(names)) if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i))]
        if any(model.is_unused(i) for i in plain) or any(MARK in names[i].lstrip(MARK) for i in plain):
            raise ValueError("models with unused pieces, or with pieces that go on beyond a word, are not supported")
        symbol = {names[i]: i for i in plain}
        for c in sorted({c for i in plain for c in names[i]} - symbol.keys()):
            symbol[c] = len(names) + len(symbol)
        scores = sorted({model.get_score(i) for i in plain}, reverse=True)
        rank = dict(zip(scores, range(len(scores)), strict=True))
        pairs = ((symbol[a], symbol[b], rank[model.get_score(i)], i) for i in plain for k in range(1, len(names[i])) if (a := names[i][:k]) in symbol and (b := names[i][k:]) in symbol)
        super().__init__(pairs)
        self.characters = np.arange(0x110000, dtype=np.int64) + OTHER
        for c, i in symbol.items():
            if len(c) == 1:
                self.characters[ord(c)] = i
        self.characters[ord(" ")] = self.characters[ord(MARK)]
        self.is_id = np.zeros(len(names) + len(symbol), bool)
        self.is_id[plain] = True
        self.letters = {symbol[c]: ord(c) for c in symbol if len(c) == 1}
        self.bytes = np.array([model.piece_to_id(f"<0x{b:02X}>") for b in range(256)], np.int64)
        fallback = dict(zip(self.bytes.tolist(), range(256), strict=True))
        self.text = [bytes([fallback[i]]) if i in fallback else b"" if model.is_control(i) else " ⁇ ".encode() if model.is_unknown(i) else names[i].replace(MARK, " ").encode() for i in range(len(names))]
        self.marked = np.zeros(len(names), bool)
        self.marked[[i for i in plain if names[i].startswith(MARK)]] = True
        self.control = np.array([model.is_control(i) for i in range(len(names))])


def ids_of(p: Pieces, symbols: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The ids of merged words and how many each has: characters that are no piece become the ids of their UTF-8 bytes."""
    plain = np.zeros(len(symbols), bool)
    inside = symbols < len(p.is_id)
    plain[inside] = p.is_id[symbols[inside]]
    if plain.all():
        return symbols, lengths
    other = np.flatnonzero(~plain)
    spelt = [p.bytes[np.frombuffer(chr(p.letters.get(s, s - OTHER)).encode(), np.uint8)] for s in symbols[other].tolist()]
    size = np.ones(len(symbols), np.int64)
    size[other] = [len(s) for s in spelt]
    out = np.repeat(symbols, size)
    out[np.repeat(~plain, size)] = np.concatenate(spelt)
    return out, np.bincount(np.repeat(np.arange(len(lengths)), lengths), weights=size, minlength=len(lengths)).astype(np.int64)


def learner(p: Pieces) -> Callable[[list[str]], list[str]]:
    """A function that gives words their ids, comma-joined."""

    def learn(words: list[str]) -> list[str]:
        letters = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32)
        ids, sizes = ids_of(p, *merge(p, p.characters[letters], np.array(list(map(len, words)))))
        return joined(sizes, pa.array(ids).cast(pa.large_string()), ",").to_pylist()

    return learn


def encode_batch(known: Remembered, texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """For each text its ids, comma-joined, and how many they are."""
    texts = pc.replace_substring(texts.cast(pa.large_string()).fill_null(""), MARK, " ")
    none, blank = (pa.scalar(x, pa.large_string()) for x in ("", " "))
    empty = pc.equal(texts, none)
    texts = pc.if_else(empty, texts, pc.binary_join_element_wise(blank, texts, none))
    words, counts = distinct(texts, at_blanks)
    ids = joined(counts, pa.array(known.all_of(words.dictionary.to_pylist()), pa.large_string()).take(words.indices), ",")
    return ids, np.where(pc.equal(ids, none).to_numpy(zero_copy_only=False), 0, pc.count_substring(ids, ",").to_numpy() + 1)


def decode_batch(p: Pieces, ids: pa.Array) -> pa.Array:
    """For each text of comma-joined ids the text that they stand for; bytes that are no UTF-8 give U+FFFD each."""
    lists = pc.split_pattern(ids.cast(pa.large_string()).fill_null(""), ",")
    flat = lists.flatten().dictionary_encode()
    known = np.array([int(x) if x else 1 for x in flat.dictionary.to_pylist()], np.int64)
    numbers = known[flat.indices.to_numpy()]
    sizes = pc.list_value_length(lists).to_numpy()
    pieces = pa.array([b"" if not x else p.text[i] for x, i in zip(flat.dictionary.to_pylist(), known.tolist(), strict=True)], pa.large_binary()).take(flat.indices)
    whole = joined(sizes, pieces, b"")
    # the first piece that is no control piece loses the mark that stands for no blank of the text
    of = np.repeat(np.arange(len(sizes)), sizes)
    real = np.flatnonzero(~p.control[numbers])
    which, first = np.unique(of[real], return_index=True)
    lead = np.zeros(len(sizes), bool)
    lead[which] = p.marked[numbers[real[first]]]
    whole = pc.if_else(pa.array(lead), pc.binary_replace_slice(whole, 0, 1, b""), whole)
    try:
        return whole.cast(pa.string())
    except pa.ArrowInvalid:
        return pa.array([x.decode("utf-8", _EACH_BYTE) for x in whole.to_pylist()], pa.string())


def _encoder(pieces, back: bool):
    """ids and n_tokens of texts; with `back` also what the ids decode to, so that a text goes to Python and back once."""
    fields = [StructField("ids", StringType()), StructField("n_tokens", LongType()), *([StructField("decoded", StringType())] if back else [])]

    @F.arrow_udf(StructType(fields))
    def encode(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        known = Remembered(learner(pieces.value))
        for texts in batches:
            done = []
            for some in slices(texts):
                ids, n = encode_batch(known, some)
                columns = [ids.cast(pa.string()), pa.array(n, pa.int64())] + ([decode_batch(pieces.value, ids).cast(pa.string())] if back else [])
                done.append(pa.StructArray.from_arrays(columns, [f.name for f in fields]))
            yield pa.concat_arrays(done)

    return encode


def _decoder(pieces):
    @F.arrow_udf(StringType())
    def decode(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for ids in batches:
            yield decode_batch(pieces.value, ids)

    return decode


class PieceTokenizer:
    """Column functions for one model. Its tables, of fixed size, reach the executors once, as a broadcast."""

    def __init__(self, spark: SparkSession, path: str):
        pieces = spark.sparkContext.broadcast(Pieces(path))
        self._encode, self._round, self._decode = _encoder(pieces, False), _encoder(pieces, True), _decoder(pieces)

    def encode(self, text: Column) -> Column:
        """A struct of ids, decimal and comma-joined, and n_tokens; no begin or end ids; empty for null and empty texts."""
        return self._encode(text)

    def round_trip(self, text: Column) -> Column:
        """As encode, and decoded, what decode gives for the ids."""
        return self._round(text)

    def decode(self, ids: Column) -> Column:
        """The text that comma-joined ids stand for, the blank in front of the first word left out."""
        return self._decode(ids)


def encode_table(docs: DataFrame, tokenizer: PieceTokenizer, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row for each row of docs: id_col, n_tokens, ids, decoded.

    Whole texts, a null one as the empty text, which has no ids. The model knows one mark for blanks: U+2581 in a text
    comes back as a blank, all else as it was. Repeated rows stay repeated; null ids stay; further columns are not read;
    an empty table gives an empty one.
    """
    bounded_batches(docs.sparkSession)
    encoded = docs.select(F.col(id_col), tokenizer.round_trip(F.col(text_col)).alias("_e"))
    return encoded.select(id_col, "_e.n_tokens", "_e.ids", "_e.decoded")


def summary(encoded: DataFrame, id_col: str = "doc_id") -> DataFrame:
    return encoded.select(id_col, "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))
