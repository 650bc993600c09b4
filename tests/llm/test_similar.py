"""Linked documents and shared passages against all pairs."""

import random

import numpy as np
import pytest

from placeloom.llm import jaccard, passages, shingles
from placeloom.llm.graph import components


def words(text):
    lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    for c in "\t\n\x0b\f\r":
        lower = lower.replace(c, " ")
    return [w for w in lower.split(" ") if w]


def shingle_set(text):
    w = words(text)
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def brute(docs):
    """id: (number of shingles, least id reached), for ids that do not repeat."""
    sets = {i: shingle_set(t) for i, t in docs.items()}
    root = {i: i for i in docs}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    by_shingle = {}
    for i, s in sets.items():
        for x in s:
            by_shingle.setdefault(x, []).append(i)
    pairs = {(min(i, group[0]), max(i, group[0])) for group in by_shingle.values() for i in group}
    pairs |= {(i, j) for group in by_shingle.values() if len(group) < 60 for i in group for j in group if i < j}
    for i, j in pairs:
        both = len(sets[i] & sets[j])
        if i != j and both and 100 * both >= 75 * (len(sets[i]) + len(sets[j]) - both):
            a, b = sorted((find(i), find(j)))
            root[b] = a
    return {i: (len(sets[i]), find(i)) for i in docs}


@pytest.mark.parametrize("size", ["sf0.001", "sf0.01"])
def test_links_equal_all_pairs(spark, size):
    docs = spark.read.parquet(f"/root/testdata/{size}/documents.parquet")
    want = brute({r.doc_id: r.text for r in docs.collect()})
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard.link(docs).collect()}
    assert got == want


def test_chains_and_templates(spark):
    """Near copies of near copies, and many texts that are alike but mostly below the threshold."""
    rng = random.Random(1)
    word = lambda: f"w{rng.randrange(10**6)}"
    docs, base = {}, [word() for _ in range(120)]
    for i in range(40):  # each differs a little from the one before
        base = base[:]
        for _ in range(2):
            base[rng.randrange(120)] = word()
        docs[i] = " ".join(base)
    shape = [word() for _ in range(100)]
    for i in range(100, 400):
        own = shape[:]
        for _ in range(rng.choice([2, 4, 5, 6])):
            own[rng.randrange(100)] = word()
        docs[i] = " ".join(own)
    docs |= {1000 + i: docs[100 + i] for i in range(20)} | {2000: "one", 2001: "ONE", 2002: "one two", 2003: "", 2004: "One\ttwo"}
    df = spark.createDataFrame([*docs.items()], "doc_id long, text string")
    sets = {i: shingle_set(t) for i, t in docs.items()}
    root = {i: i for i in docs}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in docs:
        for j in docs:
            if i < j and (both := len(sets[i] & sets[j])) and 100 * both >= 75 * (len(sets[i]) + len(sets[j]) - both):
                a, b = sorted((find(i), find(j)))
                root[b] = a
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard.link(df).collect()}
    assert got == {i: (len(sets[i]), find(i)) for i in docs}


def test_long_texts_are_compared_by_their_least_hashes(spark):
    """A chain of texts with more shingles than are kept of each; its ends are too different to link directly."""
    rng = random.Random(2)
    base, docs = [f"w{rng.randrange(10**6)}" for _ in range(3000)], {}
    for i in range(12):
        base = base[:]
        for _ in range(60):
            base[rng.randrange(3000)] = f"w{rng.randrange(10**6)}"
        docs[i] = " ".join(base)
    docs[50] = " ".join(f"w{rng.randrange(10**6)}" for _ in range(3000))
    df = spark.createDataFrame([*docs.items()], "doc_id long, text string")
    got = {r.doc_id: r.component_id for r in jaccard.link(df).collect()}
    assert got == {i: 0 for i in range(12)} | {50: 50}


def test_similar_sets_share_prefix_tokens():
    """Whatever the order, two linked sets share as many tokens in their prefixes as the index asks for."""
    rng = np.random.default_rng(0)
    for _ in range(3000):
        n = int(rng.integers(1, 60))
        x = rng.permutation(200)[:n]
        drop, add = rng.integers(0, n // 4 + 1, 2)
        y = np.concatenate([x[drop:], 1000 + np.arange(add)])
        order = rng.permutation(2000)
        both = len(set(x) & set(y))
        if not both or 100 * both < 75 * (len(x) + len(y) - both):
            continue
        p, q = (set(sorted(z, key=lambda t: order[t])[: jaccard.prefix_size(len(z))]) for z in (x, y))
        assert len(p & q) >= max(-(-len(z) * 75 // 100) // jaccard.LONGER + 1 for z in (x, y)) or len(p & q) == both


def test_shingles_are_those_of_the_words():
    texts = ["a b c d e f", "A b C d e F", "a  b\tc\nd e f ", "", "x", "x y", "é\xa0ü b c d e", "ab c", "a bc", "\x1cq r s t u v", "a\x1cb"]
    lists = shingles.shingle_lists([t.encode() for t in texts])
    for x, t in zip(lists, texts):
        assert len(set(x.tolist())) == len(shingle_set(t))
    assert lists[0].tolist() == lists[1].tolist() == lists[2].tolist()
    assert lists[7].tolist() != lists[8].tolist()


def test_compact_windows_are_those_of_the_cartesian_tree():
    rng = np.random.default_rng(2)
    for n in (1, 5, 6, 40, 333):
        v = rng.integers(0, 1 << 63, n).astype(np.uint64)
        want = set()
        for c in range(n):
            a, b = c, c
            while a and v[a - 1] > v[c]:
                a -= 1
            while b + 1 < n and v[b + 1] > v[c]:
                b += 1
            if b - a + 1 >= 6:
                want.add((c, a, b))
        assert set(passages.compact_windows(v, 6)) == want


def test_shared_passages_are_found(spark):
    rng = random.Random(4)
    text = lambda n: [f"v{rng.randrange(10**6)}" for _ in range(n)]
    passage, other = text(55), text(80)
    near = other[:]
    near[40] = "changed"
    docs = {1: text(200) + passage + text(90), 2: text(30) + passage, 3: passage + text(300), 4: text(400), 5: text(70) + other + text(10), 6: text(10) + near + text(60), 7: text(30)}
    docs[8] = docs[4][:]
    docs[9] = passage[:40] + text(200)
    df = spark.createDataFrame([(i, " ".join(t)) for i, t in docs.items()], "doc_id long, text string")
    got = {(r.doc_id, r.other_id): r for r in passages.shared_passages(df).collect()}
    # the earliest of each has a row too
    assert {a for a, _ in got} == {1, 2, 3, 4, 5, 6, 8}
    assert got[1, 2].class_id == got[2, 1].class_id == 1 and got[1, 2].first_word == 200
    assert got[2, 1].first_word == 30 and got[2, 1].end_word == 85 and got[2, 1].other_first == 200
    assert got[3, 1].end_word == 55
    assert got[8, 4].end_word == 400
    assert got[6, 5].percent >= 75


def partners(texts):
    """Which texts have a partner by comparing all pairs."""
    lists = shingles.shingle_lists([t.encode() for t in texts])
    return {x for i in range(len(texts)) for j in range(i) if passages.matched(lists[j], lists[i]) for x in (i, j)}


def vocabulary(rng):
    text = lambda n: [f"v{rng.randrange(10**6)}" for _ in range(n)]
    return text, lambda words, *at: [f"c{rng.randrange(10**9)}" if k in at else w for k, w in enumerate(words)]


@pytest.mark.parametrize("kind", ["alone", "beside a phrase that all have", "group of 60", "group of 200"])
def test_passages_against_all_pairs(spark, kind):
    """Of each kind of near copies: nine of ten that have a partner by all pairs get a row. In the groups, whose members differ by
    one word each, most fail the comparison with one another."""
    rng = random.Random(5)
    text, changed = vocabulary(rng)
    docs, phrase, base = [], text(30), text(58)
    if kind.startswith("group"):
        docs = [text(20) + changed(base, rng.randrange(10, 48)) + text(30) for _ in range(int(kind.split()[-1]))]
    else:
        for _ in range(60):
            core, at = (text(74), (24, 49)) if kind == "alone" else (phrase + text(28), (40,))
            docs += [text(30) + core + text(30), text(20) + changed(core, *at) + text(40)]
    texts = [" ".join(t) for t in docs]
    want = partners(texts)
    found = passages.shared_passages(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()
    got = {r.doc_id for r in found}
    assert len(want) >= 50 and all(r.percent >= 75 for r in found)
    assert len(want & got) >= 0.9 * len(want) and not got - want


def test_exact_passages_are_found_in_every_document(spark):
    """60 passages of 55 to 70 words in 6 documents each; one of repeated lines; all documents that have one get a row."""
    rng = random.Random(6)
    text = lambda n: [f"v{rng.randrange(10**6)}" for _ in range(n)]
    docs, line = [], text(12)
    for k in range(60):
        passage = line * 6 if k == 0 else text(rng.randrange(55, 71))
        docs += [text(rng.randrange(20, 90)) + passage + text(rng.randrange(20, 90)) for _ in range(6)]
    clean = [text(200) for _ in range(100)]
    rows = [(i, " ".join(t)) for i, t in enumerate(docs + clean)]
    found = passages.shared_passages(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r.doc_id for r in found} == set(range(len(docs)))
    assert all(r.doc_id // 6 == r.other_id // 6 for r in found)
    assert all(r.class_id == r.doc_id // 6 * 6 for r in found)


def test_components(spark):
    edges = spark.createDataFrame([(1, 2), (2, 3), (9, 8), (5, 5), (None, 4), (3, 1)] + [(i, i + 1) for i in range(100, 150)] + [(500, i) for i in range(501, 560)], "a int, b int")
    got = {r.node: r.component for r in components(edges, "a", "b").collect()}
    assert got == {1: 1, 2: 1, 3: 1, 8: 8, 9: 8} | {i: 100 for i in range(100, 151)} | {i: 500 for i in range(500, 560)}
    assert components(edges.limit(0), "a", "b").count() == 0


def test_awkward(awkward, nothing):
    rows = sorted(((r.doc_id or 0, r.n_shingles, r.component_id) for r in jaccard.link(awkward).collect()), key=str)
    assert rows == sorted([(1, 0, 1), (2, 0, 2), (3, 0, 3), (4, 977, 4), (4, 977, 4), (5, 1, 5), (0, 2, 6), (6, 2, 6), (7, 2, 6), (7, 1, 7)], key=str)
    assert jaccard.link(nothing).count() == 0
    assert jaccard.deduplicated(awkward).columns == awkward.columns
    kept = jaccard.deduplicated(awkward).select("doc_id", "text").collect()
    assert sorted(r.doc_id or 0 for r in kept) == [1, 2, 3, 4, 5, 6, 7]
    long = passages.shared_passages(awkward).collect()
    assert {r.doc_id for r in long} <= {4}
    assert passages.shared_passages(nothing).count() == 0


def test_links_past_the_head_of_a_class(spark):
    """Documents that are like a later member of their class, but not like the earliest, or that the earliest is no fellow of at all."""
    rng = random.Random(11)
    text, changed = vocabulary(rng)
    docs = []
    for _ in range(12):
        # a chain: the third is like the second only, which is like the first
        base, lead = text(64), text(30)
        second = changed(base, 24)
        docs += [text(20) + base + text(30), text(20) + second + text(30), text(20) + changed(second, 40) + text(30)]
        # a head that has a part of the passage and no more, and two that share the passage and other passages with the head of another class
        shared, mine, other = lead + text(30), text(60), text(60)
        docs += [text(20) + lead[:22] + text(60) + shared[38:], mine + text(30), other + text(30)]
        docs += [text(10) + mine + text(20) + shared, text(10) + other + text(20) + changed(shared, 8)]
    texts = [" ".join(t) for t in docs]
    lists = shingles.shingle_lists([t.encode() for t in texts])
    links = [(i, j) for i in range(len(texts)) for j in range(i) if passages.matched(lists[j], lists[i])]
    found = passages.shared_passages(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()
    classes = {r.doc_id: r.class_id for r in found}
    assert len(links) >= 12 * 5 and all(classes.get(i, i) == classes.get(j, -1) for i, j in links)


def test_similar_stretches_have_two_places_in_common():
    """Two neighbouring leasts of windows are there for every stretch that has as many changed words as a passage may have."""
    rng = random.Random(12)
    text, changed = vocabulary(rng)
    for _ in range(300):
        n = rng.choice([1, 2, 3])
        base = text(30 * n + 5 * n + 4 + rng.randrange(8) + 6)
        one, two = text(20) + base + text(20), text(33) + changed(base, *rng.sample(range(5, len(base) - 5), n)) + text(9)
        a, b = shingles.shingle_lists([" ".join(t).encode() for t in (one, two)])
        if passages.matched(a, b):
            assert len(np.intersect1d(passages._found(a)[0], passages._found(b)[0])) >= 1


def edited(rng):
    """150 texts that differ by a word in 24 at nearly the same places, so that all share places and none are similar; five near copies of some."""
    text, changed = vocabulary(rng)
    base, docs = text(140), []
    for _ in range(150):
        docs.append(text(8) + changed(base, *range(rng.randrange(5), 140, 24)) + text(8))
    return [" ".join(d) for d in docs + [text(8) + changed(docs[k][8:148], 70) + text(8) for k in range(20, 120, 20)]]


def test_unlinked_members_of_a_large_class_make_no_pairs(spark, monkeypatch):
    """They meet by blocks: links are those of all pairs, and the last pairs compared one by one stay in proportion to the members."""
    texts = edited(random.Random(13))
    counts, compare = [], passages._compare
    monkeypatch.setattr(passages, "_compare", lambda rows, pairs: counts.append(pairs.count()) or compare(rows, pairs))
    found = passages.shared_passages(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()
    assert {(r.doc_id, r.class_id) for r in found} == {(x, 20 * k) for k in range(1, 6) for x in (20 * k, 149 + k)}
    # what comes after the earliest of each class and the rounds of heads
    assert sum(counts[len(passages.HEADS) + 1 :]) < 5 * len(texts)


def test_dense_keeps_all_that_match():
    """What bits tell apart does not match, with repeated lines and short texts too."""
    rng = random.Random(14)
    text, changed = vocabulary(rng)
    base, line, docs = text(120), text(9), [text(20), text(51)]
    for rate in (0.0, 0.01, 0.02, 0.03, 0.05) * 14:
        docs.append(text(rng.randrange(30)) + changed(base, *(k for k in range(120) if rng.random() < rate)) + text(30))
        docs.append(text(9) + (line * 7 + text(40) + changed(line * 7, *(k for k in range(63) if rng.random() < rate))) + text(9))
    lists, n = passages._coded(shingles.shingle_lists([" ".join(d).encode() for d in docs]))
    may = passages._dense(lists, lists, n)
    want = {(i, j) for i in range(len(lists)) for j in range(len(lists)) if i != j and passages.matched(lists[i].astype("u8"), lists[j].astype("u8"))}
    assert len(want) > 1000 and all(may[i, j] or may[j, i] for i, j in want)
    assert may.sum() < may.size
