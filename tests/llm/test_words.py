"""Pieces against the tokenizer library, spelling variants against every edit of every word."""

import hashlib
import random
import re
import zlib
from collections import Counter

import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from sentencepiece import SentencePieceProcessor

from placeloom.llm import merges, pieces, queries, variants, words

PATH = public_tokenizers.path(queries.PIECES)


@pytest.fixture(scope="module")
def tables():
    return pieces.Pieces(PATH)


@pytest.fixture(scope="module")
def library():
    return SentencePieceProcessor(model_file=PATH)


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def assert_as_library(tables, library, texts):
    ids, n = pieces.encode_batch(words.Remembered(pieces.learner(tables)), pa.array(texts, pa.string()))
    want = [library.encode(t or "") for t in texts]
    assert ids.to_pylist() == [",".join(map(str, w)) for w in want]
    assert n.tolist() == list(map(len, want))
    assert pieces.decode_batch(tables, ids).to_pylist() == [library.decode(w) for w in want]


def test_pieces_equal_library_on_chosen_texts(tables, library):
    assert_as_library(tables, library, ["", None, " ", "  ", "a", "  a b  ", "x\x00y\t\nz", "▁a ▁▁ b", "é😀ﬁ①Å", "<s>", "<unk>", "<0x41>", " " * 37, "▁", "\r\n", "a b"])
    assert_as_library(tables, library, [])
    assert_as_library(tables, library, ["", None])


def test_pieces_equal_library_on_random_texts(tables, library):
    rnd = random.Random(1)
    assert_as_library(tables, library, ["".join(rnd.choice("aab ehlost ▁\nX1é①") for _ in range(rnd.randint(0, 40))) for _ in range(5000)])


@pytest.mark.parametrize("word", ["a" * 500, "a" * 40_000, "ha" * 300, " " * 3000, "ab" * 20_000, "aab ehlostX1é①".replace(" ", "") * 2000])
def test_words_of_any_length(tables, library, word):
    assert_as_library(tables, library, [word, "x " + word])


def test_long_words_by_heap_equal_rounds(tables, monkeypatch):
    rnd = random.Random(2)
    texts = pa.array([" ".join("".join(rnd.choice("aehlostn") for _ in range(rnd.randint(1, 300))) for _ in range(50))])
    by_rounds = pieces.encode_batch(words.Remembered(pieces.learner(tables)), texts)[0].to_pylist()
    monkeypatch.setattr(merges, "LONG", 3)
    assert pieces.encode_batch(words.Remembered(pieces.learner(tables)), texts)[0].to_pylist() == by_rounds


def test_words_forgotten_and_seen_again(tables, library, monkeypatch):
    monkeypatch.setattr(words, "REMEMBERED", 20)
    known, rnd = words.Remembered(pieces.learner(tables)), random.Random(4)
    for _ in range(60):
        text = " ".join(f"w{rnd.randint(0, 60)}" for _ in range(30))
        assert pieces.encode_batch(known, pa.array([text]))[0].to_pylist() == [",".join(map(str, library.encode(text)))]
        assert len(known) + len(known.before) <= 80


def test_decoding_of_ids_that_are_no_text(tables, library):
    rnd = random.Random(3)
    for _ in range(300):
        ids = [rnd.choice([rnd.randint(3, 31_999), rnd.randint(3, 258)]) for _ in range(rnd.randint(1, 8))]
        assert pieces.decode_batch(tables, pa.array([",".join(map(str, ids))])).to_pylist() == [library.decode(ids)]


def test_pieces_query_equals_library(spark, sf, library):
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    got = {r.doc_id: r for r in queries.op12_pieces(spark, sf).collect()}
    assert got.keys() == texts.keys()
    for i, t in texts.items():
        ids = library.encode(t)
        assert (got[i].n_tokens, got[i].ids_sha256, got[i].decoded_sha256) == (len(ids), sha(",".join(map(str, ids))), sha(library.decode(ids)))


def test_pieces_of_awkward_rows(spark, awkward, nothing, library):
    tokenizer = pieces.PieceTokenizer(spark, PATH)
    got = pieces.encode_table(awkward, tokenizer).collect()
    apart = awkward.select(tokenizer.encode(F.col("text")).alias("e")).select("e.ids", tokenizer.decode(F.col("e.ids")).alias("decoded")).collect()
    assert Counter(map(tuple, apart)) == Counter((r.ids, r.decoded) for r in got)
    assert Counter((r.doc_id, r.ids, r.decoded) for r in got) == Counter((r.doc_id, ",".join(map(str, ids := library.encode(r.text or ""))), library.decode(ids)) for r in awkward.collect())
    assert pieces.encode_table(nothing, tokenizer).count() == 0


def every_edit(rows):
    counts = Counter()
    for i, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(chr(ord(x) + 32) if "A" <= x <= "Z" else x for x in run)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % 199 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += 1
    n = {w: k for w, k in counts.items() if len(w) >= 6 and k >= 5}
    letters = {x for w in n for x in w}
    near, form = {}, {}
    for w in n:
        cut = [(w[:i], w[i:]) for i in range(len(w) + 1)]
        edits = {a + x + b for a, b in cut for x in letters} | {a + b[1:] for a, b in cut if b} | {a + x + b[1:] for a, b in cut if b for x in letters}
        near[w] = [v for v in edits - {w} if v in n]
        best = min(near[w], key=lambda v: (-n[v], v), default=None)
        form[w] = best if best and n[best] >= 5 * n[w] else None
    out = set()
    for w in n:
        root = w
        while form[root]:
            root = form[root]
        out.add((w, form[w], root, n[w], len(near[w]), n.get(form[w])))
    return out


def found(df):
    rows = df.collect()
    out = {(r.word, r.form, r.root, r.n, r.n_near, r.form_n) for r in rows}
    assert len(out) == len(rows)
    return out


def test_variants_equal_every_edit(spark):
    rnd = random.Random(3)
    words = ["".join(rnd.choice("aabbÉéX") for _ in range(rnd.choice([5, 6, 6, 7, 7, 8]))) for _ in range(1000)]
    rows = [(i, " ".join(rnd.choice(words[: 1 + int(1000 * rnd.random() ** 3)]) for _ in range(150))) for i in range(300)]
    rows += [(None, "aaaaaa " * 9), (None, "aaaaaa " * 9), (5, None), (6, "")]
    assert found(variants.spelling(spark.createDataFrame(rows, "doc_id long, text string"))) == every_edit(rows)


def test_variants_query_equals_every_edit(spark, sf):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    assert found(queries.op13_spelling(spark, sf)) == every_edit(rows)


def test_roots_follow_chains_and_ties_go_by_letter(spark):
    counts = [("aaaaaa", 5), ("aaaaab", 25), ("aaaabb", 125), ("aaabbb", 625), ("aabbbb", 3125), ("abbbbb", 15_625), ("zzzzzz", 5), ("zzzzzy", 25), ("zzzzyz", 25), ("lonely", 9)]
    got = {r.word: (r.form, r.root, r.n_near) for r in variants.forms(spark.createDataFrame(counts, "word string, n long")).collect()}
    assert got["aaaaaa"] == ("aaaaab", "abbbbb", 1)
    assert got["aaaabb"] == ("aaabbb", "abbbbb", 2)
    assert got["abbbbb"] == (None, "abbbbb", 1)
    assert got["zzzzzz"] == ("zzzzyz", "zzzzyz", 2)
    assert got["lonely"] == (None, "lonely", 0)


def test_variants_of_awkward_rows(spark, awkward, nothing):
    assert found(variants.spelling(awkward)) == every_edit([(r.doc_id, r.text) for r in awkward.collect()])
    assert variants.spelling(nothing).count() == 0
