"""BPE against the tokenizer library, FLAC by exact round trips."""

import hashlib
import random
import sys
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
import tiktoken

from placeloom.llm import bpe, bpe_words, flac, queries, words

PATH = public_tokenizers.path(queries.VOCABULARY)


@pytest.fixture(scope="module")
def ranks():
    return bpe.load_ranks(PATH)


@pytest.fixture(scope="module")
def library(ranks):
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def ids(text, ranks, pieces):
    return [i for p in pieces(text) for i in bpe.fold(p.encode(), ranks)]


def test_ids_equal_the_library(ranks, library):
    pieces, rng = bpe.splitter(public_tokenizers.PATTERN), random.Random(5)
    alphabets = ["ab '’sStlldD\n\t  é1²x!?", " \x1c\x1d\x85\xa0 　a\nß9½", "абв中文🎉́ a'll 𝟘"]
    texts = ["".join(rng.choices(a, k=rng.randrange(40))) for a in alphabets for _ in range(700)]
    texts += ["a" * 5000, "!" * 700, "ab" * 400, "<|endoftext|>", "  \n\n  x", "µªǅʰ"]
    for t in texts:
        assert ids(t, ranks, pieces) == library.encode_ordinary(t), repr(t)


def test_every_character(ranks, library):
    pieces = bpe.splitter(public_tokenizers.PATTERN)
    odd = [c for c in map(chr, range(sys.maxunicode + 1)) if not "\ud800" <= c <= "\udfff" and ids(f"a{c}1 {c}!{c}", ranks, pieces) != library.encode_ordinary(f"a{c}1 {c}!{c}")]
    assert not [c for c in odd if ord(c) < 0x250]
    assert len(odd) == 0, [hex(ord(c)) for c in odd[:50]]


def test_words_parted_at_blanks_equal_the_library(ranks, library):
    """Texts as one word each, and parted where a blank stands between two visible characters."""
    rng = random.Random(8)
    texts = ["".join(rng.choices(a, k=rng.randrange(60))) for a in ["ab c'l 1!\n\t", "ab \xa0é 中\u2003x", "a  b   \r\n c"] for _ in range(400)] + ["", " ", "  ", " a", "a ", "x" * 500 + " y", "".join(rng.choices("abehlst", k=3000)), "".join(rng.choices("абв中🎉", k=400))]
    for starts in (words.between_visible, words.nowhere):
        got = bpe._encoded(words.Remembered(bpe._learner(bpe.Vocabulary(ranks), bpe.splitter(public_tokenizers.PATTERN))), pa.array(texts), starts)
        assert got.to_pylist() == [" ".join(map(str, library.encode_ordinary(t))) for t in texts]
        assert bpe._decoded(bpe._table(ranks), got).to_pylist() == [t.encode() for t in texts]


def test_query_equals_the_library(spark, sf, library):
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    for r in queries.op4_byte_bpe(spark, sf).collect():
        want = library.encode_ordinary(texts[r.doc_id])
        assert (r.n_tokens, r.ids_sha256) == (len(want), hashlib.sha256(" ".join(map(str, want)).encode()).hexdigest())
        assert r.decoded_sha256 == hashlib.sha256(texts[r.doc_id].encode()).hexdigest()


def test_bpe_awkward(spark, awkward, nothing):
    t = queries.tokenizer(spark)
    got = bpe.encode_table(awkward, t).collect()
    assert len(got) == 10
    assert sorted(bytes(r.decoded) for r in got) == sorted((r.text or "").encode() for r in awkward.collect())
    assert bpe.summary(bpe.encode_table(nothing, t)).count() == 0


def test_flac_round_trips():
    rng = np.random.default_rng(3)
    payloads = [bytes([7]) * 64, rng.integers(0, 256, 4096 + 64, np.uint8).tobytes(), (128 + 100 * np.sin(np.arange(6400) / 9)).astype(np.uint8).tobytes(), b"A quick text. " * 640, bytes(range(256)) * 8, bytes(1000) + b"\xff" + bytes(23)]
    for lpc in (None, flac.TEXT_LPC, ([3, -3, 1], 0), ([7, -2], 2)):
        streams = flac.encode_all(payloads, lpc)
        assert [b"".join(pcm for _, pcm in x) for x in flac.decode_all(streams)] == payloads
        assert [s for s, _ in flac.decode_all(streams)[1]] == list(range(0, 4160, flac.BLOCK))


def test_prose_takes_the_linear_predictor(sf):
    """Frames with it decode to the same samples and are smaller than those of the format's own predictors."""
    import pyarrow.parquet as pq

    payloads = [flac.payload(t) for t in pq.read_table(f"{sf}/documents.parquet", columns=["text"])["text"].to_pylist()]
    with_, without = flac.encode_all(payloads), flac.encode_all(payloads, None)
    assert [b"".join(pcm for _, pcm in x) for x in flac.decode_all(with_)] == payloads
    assert sum(map(len, with_)) < 0.98 * sum(map(len, without))
    kinds = {m[at + 6 + (m[at + 2] >> 4 == 7) * 2] >> 1 for m in with_ for _, at, _ in flac._open(m)[2][:1]}
    assert any(k >= 32 for k in kinds)


@pytest.mark.parametrize("at", [30, 60, 200, -1, -40])
def test_a_damaged_stream_is_found(at):
    stream = bytearray(flac.encode_all([b"some text to be stored, twice over. " * 64])[0])
    stream[at] ^= 4
    with pytest.raises(flac.Broken):
        flac.decode_all([bytes(stream)])


@pytest.mark.parametrize("length", [0, 3, 6, 40, 70, 200])
def test_a_short_stream_is_found(length):
    stream = flac.encode_all([b"some text to be stored, twice over. " * 64])[0]
    with pytest.raises(flac.Broken):
        flac.decode_all([stream[:length]])


def test_flac_query(spark, sf):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    rows = queries.op5_flac(spark, sf).collect()
    media = dict(zip(texts, flac.encode_all([flac.payload(t) for t in texts.values()]), strict=True))
    by_text: dict = {}
    for r in rows:
        assert (r.media_bytes, r.media_sha256) == (len(media[r.doc_id]), hashlib.sha256(media[r.doc_id]).hexdigest())
        x = np.frombuffer(flac.payload(texts[r.doc_id]), np.uint8).astype(int) - 128
        assert r.feature == f"mean_square={int((x * x).sum()) // len(x)};crossings={int(np.sum((x[1:] < 0) != (x[:-1] < 0)))};peak={int(abs(x).max())}"
        assert by_text.setdefault(texts[r.doc_id], r[1:]) == r[1:]
    for r in rows:
        p = flac.payload(texts[r.doc_id])
        assert (r.n_bytes, r.payload_bytes, r.payload_sha256) == (len((texts[r.doc_id] or "").encode()), len(p), hashlib.sha256(p).hexdigest())
        assert r.tail_crc32 == zlib.crc32(p[-64:])


def test_flac_awkward(awkward, nothing):
    stored = flac.store(awkward)
    assert flac.summary(stored).count() == 10
    assert flac.summary(flac.store(nothing)).count() == 0
    joined = {}
    for r in sorted(flac.blocks(stored.where("doc_id = 5")).collect(), key=lambda r: r.sample_offset):
        assert len(joined.get(5, b"")) == r.sample_offset
        joined[5] = joined.get(5, b"") + bytes(r.pcm)
    assert joined[5] == b"x" * 200_000
    read = stored.select("doc_id", flac.from_flac(F.when(F.col("doc_id") != 1, F.col("media"))).alias("r"))
    assert read.where("doc_id = 1 and r is null").count() == 1
    block = read.where("doc_id = 5").select(flac.seek(F.col("r.blocks"), F.lit(150_000)).alias("b")).first().b
    assert block.sample_offset <= 150_000 < block.sample_offset + len(block.pcm)


def test_bpe_by_words_equals_the_fold_by_pieces(spark, sf, awkward, nothing):
    """The fold by higher-order functions, joined back to the documents, against the Arrow one; long words, null and empty texts."""
    path = public_tokenizers.path(queries.VOCABULARY)
    docs = spark.read.parquet(f"{sf}/documents.parquet").where("doc_id < 40").select("doc_id", "text").union(awkward.select("doc_id", "text"))
    rows = lambda df: sorted(((r.doc_id or 0, r.ids, bytes(r.decoded)) for r in df.collect()))
    assert rows(bpe_words.encode_by_words(docs, path, public_tokenizers.PATTERN)) == rows(bpe.encode_table(docs, queries.tokenizer(spark)))
    assert bpe_words.encode_by_words(nothing, path, public_tokenizers.PATTERN).count() == 0
