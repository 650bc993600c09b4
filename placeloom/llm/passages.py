"""Passages that documents share, exactly or nearly, by compact windows.

For a hash function, the stretches of a text that have the same minimal shingle
form one compact window: from just after the smaller one on the left to just
before the smaller one on the right, as in the text's Cartesian tree. Texts that
have the minimal shingles of two neighbouring windows in common belong to one
class. The members of a class are compared exactly with its earliest document;
places that no passage covers after that go on, two by two, with the other
members, the earliest first, and at last with all that no chain of passages
links with them yet: in a small class by pairs, in a large one by blocks of
members, whose texts meet in one task and are told apart there by bits.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import from_arrow_type, to_arrow_type

from placeloom.llm.common import small_batches, stage, unstage
from placeloom.llm.graph import components
from placeloom.llm.shingles import WIDTH, chunks, mix, shingle_lists

#: Words that a passage must have; the Jaccard similarity of its shingles, in per cent.
LEAST, PERCENT = 50, 75
#: Shingles in the shortest passage, and the unmatched ones that may stand inside one.
SPAN = LEAST - WIDTH + 1
GAP = SPAN // 2
#: Shingles in the least window. A similar passage has 16 shingles in a row in common: each changed word takes 5 of them on
#: both sides, so one that has e changes has 30 e or more in common. In 16 the least of each 8 are two, next to each other in both texts.
BAND = 8
#: Places of a text that no passage covers are taken two by two, this far from each other and with so many of those that follow:
#: two documents that have but a common line of fewer words do not meet.
NEXT, FAR, FOLLOWING = 12, 64, 3
#: How many members of a class the others have been compared with after each round.
HEADS = (1, 4, 16)
#: Members of a class that meet by pairs if they are not linked yet; the members of one block of a larger class, about.
PAIRED, BLOCKED = 32, 48
#: Bytes of text shingled at once, and shingles that a task keeps between batches.
PIECE, KEPT = 256 << 10, 2 << 20
#: Windows looked at together in a task, and the parts into which those of a frequent key are dealt.
BLOCK, LANES = 1 << 20, 64


def leasts(values: np.ndarray, span: int) -> np.ndarray:
    """Places, in order, of the values that are the least of some stretch of span: those of the compact windows so long. Of equal values the leftmost counts as least."""
    n = len(values)
    if n < span:
        return np.zeros(0, np.int64)
    # least of each stretch, from those of stretches half as long: key holds the value's high bits and the position
    bits = np.uint64(max(1, int(n - 1).bit_length()))
    least, width = ((values >> bits) << bits) | np.arange(n, dtype=np.uint64), 1
    while width < span:
        step = min(width, span - width)
        least, width = np.minimum(least[:-step], least[step:]), width + step
    # a value that is the least of several stretches is so of neighbouring ones
    return (least[np.flatnonzero(np.append(True, least[1:] != least[:-1]))] & ((np.uint64(1) << bits) - np.uint64(1))).astype(np.int64)


def compact_windows(values: np.ndarray, span: int) -> list[tuple[int, int, int]]:
    """(least, first, last) of the compact windows of at least span values.

    Only values that are the least of some stretch of span can have one, and so have their nearest smaller neighbours:
    a stack over those values finds them all.
    """
    n, chosen = len(values), leasts(values, span)
    bits = np.uint64(max(1, int(n - 1).bit_length())) if n else np.uint64(1)
    keys, out, stack = (((values[chosen] >> bits) << bits) | chosen.astype(np.uint64)).tolist(), [], []
    for at, k in zip([*chosen.tolist(), n], [*keys, -1], strict=True):
        while stack and stack[-1][1] > k:
            c, _, first = stack.pop()
            if at - first >= span:
                out.append((c, first, at - 1))
        stack.append((at, k, stack[-1][0] + 1 if stack else 0))
    return out


def _found(tokens: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(keys, places) of the least shingles of windows, each with the next one; a key that is there twice counts at the first place."""
    if len(tokens) < SPAN:
        return np.zeros(0, np.int64), np.zeros(0, np.int32)
    at = leasts(mix(tokens), BAND)
    two = tokens[at]
    keys, first = np.unique(mix(two[:-1] * np.uint64(0x9E3779B97F4A7C15) + two[1:]), return_index=True)
    return keys.view(np.int64), at[first].astype(np.int32)


def _windower(schema: pa.Schema) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """For batches of (id, text): rows of class (the key), lane, known, id, at, one for each window.

    A key that two documents of a block have is known to be shared. One row of it stays in lane -1, for documents of
    other blocks to see; the others are dealt into lanes, so that a frequent key does not meet in one task.
    """

    def rows(ids: list, parts: list[tuple[int, np.ndarray, np.ndarray]]) -> pa.RecordBatch:
        whose = np.repeat([p[0] for p in parts], [len(p[1]) for p in parts])
        keys, places = (np.concatenate([p[k] for p in parts]) for k in (1, 2))
        _, first, at = np.unique(keys, return_index=True, return_inverse=True)
        one = whose[first][at] == whose
        several = np.zeros(len(first), bool)
        several[at[~one]] = True
        lane = np.where(several[at] & ~one, whose % LANES, -1).astype(np.int8)
        each = pa.array(ids, schema.field("id").type).take(pa.array(whose))
        return pa.RecordBatch.from_arrays([pa.array(keys), pa.array(lane), pa.array(several[at]), each, pa.array(places)], schema=schema)

    def windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids: list = []
        parts: list = []
        held = 0
        for batch in batches:
            names, k = batch.column(0).to_pylist(), 0
            for some in chunks(batch.column(1), PIECE):
                for tokens in shingle_lists(some):
                    keys, places = _found(tokens)
                    if len(keys):
                        parts.append((len(ids), keys, places))
                        held += len(keys)
                    ids.append(names[k])
                    k += 1
                if held >= BLOCK:
                    yield rows(ids, parts)
                    ids, parts, held = [], [], 0
        if parts:
            yield rows(ids, parts)

    return windows


def _stretches(hit: np.ndarray, gap: int) -> list[tuple[int, int]]:
    """(first, last) of the runs of hits with at most gap others between two, SPAN long at least."""
    at = np.flatnonzero(hit)
    if not len(at) or at[-1] - at[0] + 1 < SPAN:
        return []
    cuts = np.flatnonzero(at[1:] - at[:-1] > gap + 1)
    return [(int(a), int(b)) for a, b in zip(at[np.append(0, cuts + 1)], at[np.append(cuts, len(at) - 1)], strict=True) if b - a + 1 >= SPAN]


def _coded(lists: list[np.ndarray]) -> tuple[list[np.ndarray], int]:
    """The lists with small numbers in place of their shingles, and how many those are."""
    coded = pa.array(np.concatenate([np.zeros(0, np.uint64), *lists])).dictionary_encode()
    return np.split(coded.indices.to_numpy(), np.cumsum([len(x) for x in lists])[:-1]), len(coded.dictionary)


def _within(x: np.ndarray, y: np.ndarray, mark: np.ndarray) -> np.ndarray:
    """Which of the numbers of x are in y. mark: a False for each number; is so again afterwards."""
    mark[y] = True
    found = mark[x]
    mark[y] = False
    return found


def _percent(x: np.ndarray, y: np.ndarray, mark: np.ndarray) -> int:
    x, y = np.unique(x), np.unique(y)
    shared = int(np.count_nonzero(_within(x, y, mark)))
    return 100 * shared // (len(x) + len(y) - shared)


def _similar(a: np.ndarray, b: np.ndarray, mark: np.ndarray, gaps: tuple[int, ...] = (GAP, WIDTH, 0)) -> list[tuple[int, int, int, int, int]]:
    """matched() for lists of numbers."""
    found = []
    for b0, b1 in _stretches(_within(b, a, mark), gaps[0]):
        part, mine = b[b0 : b1 + 1], []
        for a0, a1 in _stretches(_within(a, part, mark), gaps[0]):
            other = a[a0 : a1 + 1]
            for c0, c1 in _stretches(_within(part, other, mark), gaps[0]):
                percent = _percent(other, part[c0 : c1 + 1], mark)
                if percent >= PERCENT:
                    mine.append((a0, a1, b0 + c0, b0 + c1, percent))
        if not mine and len(gaps) > 1:
            mine = [(c, d, b0 + e, b0 + f, p) for c, d, e, f, p in _similar(a, part, mark, gaps[1:])]
        found += mine
    return found


def matched(a: np.ndarray, b: np.ndarray) -> list[tuple[int, int, int, int, int]]:
    """(first and last in a, first and last in b, per cent) of the similar stretches of two lists of shingles.

    A stretch of b goes on while its shingles are anywhere in a, with few others between; its counterparts in a are
    stretches of its shingles, whatever their order, so a passage of repeated lines is one. What is not similar
    enough as a whole is tried again with fewer others between.
    """
    (x, y), n = _coded([a, b])
    return _similar(x, y, np.zeros(n, bool))


def _dense(lists: list[np.ndarray], others: list[np.ndarray], n: int) -> np.ndarray:
    """For each list and each of the others, of numbers below n: may they be similar, by what the list has of the other.

    Two stretches with s shingles in common are similar if both together have s / 3 more at most, so one of them has s / 6 more
    at most. Hence lists that match have, one or the other, a stretch of SPAN or longer where 6 is lost for each
    shingle that the other list lacks, 1 is won for each that it has, and the sum is not below 0. What is lacking and repeats
    counts nothing, since it may be one shingle many times.
    """
    out = np.zeros((len(lists), len(others)), bool)
    for first in range(0, len(others), 64):
        some = others[first : first + 64]
        bits = np.zeros(n, np.uint64)
        for k, y in enumerate(some):
            bits[y] |= np.uint64(1 << k)
        for i, x in enumerate(lists):
            if len(x) < SPAN:
                continue
            has = np.unpackbits(bits[x].astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, count=len(some), bitorder="little")
            _, place, times = np.unique(x, return_inverse=True, return_counts=True)
            lost = np.where(times[place] == 1, PERCENT * 2 // (100 - PERCENT), 0).astype(np.int32)[:, None]
            sums = np.zeros((len(x) + 1, len(some)), np.int32)
            np.cumsum(has * (lost + 1) - lost, axis=0, out=sums[1:])
            out[i, first : first + 64] = (sums[SPAN:] >= np.minimum.accumulate(sums[:-SPAN], axis=0)).any(axis=0)
    return out


_NAMES = ("a_first", "a_last", "b_first", "b_last", "percent")
_MATCH = pa.list_(pa.struct([(n, pa.int32()) for n in _NAMES]))


def _shingled(texts: list[str], kept: dict[str, np.ndarray]) -> list[np.ndarray]:
    """The shingles of texts: those in kept as they are, new ones are kept, KEPT shingles in all beside these texts at most."""
    if sum(map(len, kept.values())) > KEPT:
        kept.clear()
    new = [x for x in dict.fromkeys(texts) if x not in kept]
    lists = (x for some in chunks(pa.array(new, pa.string()), PIECE) for x in shingle_lists(some))
    kept.update(zip(new, lists, strict=True))
    return [kept[x] for x in texts]


@F.arrow_udf(from_arrow_type(_MATCH))
def _compared(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
    kept: dict[str, np.ndarray] = {}
    for left, right in batches:
        texts = pa.chunked_array([left, right]).combine_chunks().dictionary_encode()
        index, n = texts.indices.to_pylist(), len(left)
        lists, size = _coded(_shingled(texts.dictionary.to_pylist(), kept))
        mark, out = np.zeros(size, bool), []
        for i, j in zip(index[:n], index[n:], strict=True):
            # words, end exclusive, of shingles from first to last
            out.append([dict(zip(_NAMES, (a, b + WIDTH, c, d + WIDTH, p), strict=True)) for a, b, c, d, p in sorted(set(_similar(lists[i], lists[j], mark)))])
        yield pa.array(out, _MATCH)


def _compare(rows: DataFrame, pairs: DataFrame) -> DataFrame:
    """id, other and the passages of pairs that have some, written down."""
    # Texts are joined by sorting at every size, so that a plan that holds on little data holds on much.
    wanted = pairs.select("id").union(pairs.select("other")).distinct()
    n_words = F.regexp_count("text", F.lit(r"[^\x20\x09-\x0D]+")).alias("n")
    texts = stage(rows.join(wanted.hint("merge"), "id").select("id", "text", F.md5("text").alias("key"), n_words), "texts")
    keys = texts.select("id", "key", "n").distinct()
    keyed = pairs.select("id", "other").join(keys, "id").join(keys.select(F.col("id").alias("other"), F.col("key").alias("_k")), "other")
    keyed = stage(keyed.groupBy("id", "other").agg(F.max(F.col("key") == F.col("_k")).alias("same"), F.max("n").alias("n")), "keyed")

    zero, n, full = F.lit(0), F.col("n"), F.lit(100)
    whole = keyed.where(F.col("same") & (n >= LEAST)).select("id", "other", zero.alias("first_word"), n.alias("end_word"), zero.alias("other_first"), n.alias("other_end"), full.alias("percent"))
    left, right = texts.select(F.col("id").alias("other"), F.col("text").alias("_l")).hint("merge"), texts.select("id", F.col("text").alias("_r")).hint("merge")
    found = keyed.where("not same").select("id", "other").join(left, "other").join(right, "id").select("id", "other", F.explode(_compared(F.col("_l"), F.col("_r"))).alias("p"))
    parts = found.select("id", "other", F.col("p.b_first").alias("first_word"), F.col("p.b_last").alias("end_word"), F.col("p.a_first").alias("other_first"), F.col("p.a_last").alias("other_end"), F.col("p.percent").alias("percent"))
    with small_batches(rows.sparkSession):
        both = stage(parts.union(whole), "passages")
    unstage(texts, keyed)
    return both


def _uncovered(places: DataFrame, passages: DataFrame) -> DataFrame:
    """places (id, at and more) with open: whether none of the passages of id covers the shingle at at."""
    sides = passages.select("id", "first_word", "end_word").union(passages.select("other", "other_first", "other_end"))
    # by the words where they begin: no more than the text has, however many documents share them
    longest = sides.groupBy("id", "first_word").agg(F.max("end_word").alias("end_word"))
    each = longest.groupBy("id").agg(F.collect_list(F.struct("first_word", "end_word")).alias("_s"))
    covers = lambda s: (s["first_word"] <= F.col("at")) & (F.col("at") + WIDTH <= s["end_word"])
    return places.join(each.hint("merge"), "id", "left").withColumn("open", ~F.coalesce(F.exists("_s", covers), F.lit(False))).drop("_s")


def _two_by_two(places: DataFrame) -> DataFrame:
    """class, id, at: classes of two places each, at one that is open, of classes that more documents have. places: class, id, at, open."""
    live = places.join(places.where("open").select("class").distinct().hint("merge"), "class")
    ahead = Window.partitionBy("id").orderBy("at").rangeBetween(NEXT, FAR - 1)
    several = live.withColumn("_n", F.slice(F.collect_list(F.struct("class", "at", "open")).over(ahead), 1, FOLLOWING))
    both = several.select("id", "class", "at", "open", F.explode("_n").alias("n"))
    both = both.select(F.xxhash64("class", "n.class").alias("class"), "id", F.when(F.col("open"), F.col("at")).otherwise(F.col("n.at")).alias("at"), (F.col("open") | F.col("n.open")).alias("open"))
    both = stage(both, "two")
    wanted = both.groupBy("class").agg(F.min("id").alias("_a"), F.max("id").alias("_b"), F.bool_or("open").alias("_o")).where("_o and _a <> _b").select("class")
    out = stage(both.join(wanted.hint("merge"), "class"), "two")
    unstage(both)
    return out


def _blocks_met(schema: pa.Schema) -> Callable[[pa.Table], pa.Table]:
    """For the members (second, id, component, text) of two blocks: the passages of pairs between them that link components.

    Components that a pair of these blocks has linked count as one from then on. A block that meets itself is there twice.
    """

    def met(table: pa.Table) -> pa.Table:
        ids, components_of, second, texts = (table.column(x).to_pylist() for x in ("id", "component", "second", "text"))
        lists, n = _coded(_shingled(texts, {}))
        one, two = ([k for k, s in enumerate(second) if s is want] for want in (False, True))
        mine, other = ([lists[k] for k in side] for side in (one, two))
        may = _dense(mine, other, n) | _dense(other, mine, n).T
        up = {c: c for c in components_of}

        def top(c):
            while up[c] != c:
                up[c] = up[up[c]]
                c = up[c]
            return c

        itself = table.column("left")[0] == table.column("right")[0] if len(table) else False
        out, mark = [], np.zeros(n, bool)
        for i, j in np.argwhere(may).tolist():
            x, y = one[i], two[j]
            if ids[x] == ids[y] or itself and ids[x] < ids[y]:
                continue
            a, b = top(components_of[x]), top(components_of[y])
            if a == b:
                continue
            x, y = (x, y) if ids[x] > ids[y] else (y, x)
            found = sorted(set(_similar(lists[y], lists[x], mark)))
            if found:
                up[max(a, b)] = min(a, b)
                out += [(ids[x], ids[y], e, f + WIDTH, c, d + WIDTH, p) for c, d, e, f, p in found]
        return pa.Table.from_arrays([pa.array([r[k] for r in out], f.type) for k, f in enumerate(schema)], schema=schema)

    return met


def _named(rows: DataFrame, links: DataFrame) -> DataFrame:
    """rows (class, id and more) with component, of those classes that have several. links: node, component."""
    named = rows.join(links.select(F.col("node").alias("id"), "component").hint("merge"), "id", "left").withColumn("component", F.coalesce("component", "id"))
    named = stage(named, "named")
    several = named.groupBy("class").agg(F.min("component").alias("main"), F.max("component").alias("_b")).where("main <> _b").select("class", "main")
    out = stage(named.join(several.hint("merge"), "class"), "named")
    unstage(named)
    return out


def _apart(members: DataFrame, links: DataFrame) -> DataFrame:
    """id, other: pairs of members (class, id) that links do not join yet.

    Members of a class's first component meet only those of the others, so that a large one makes no pairs with itself.
    """
    named = _named(members, links)
    others = named.select("class", F.col("id").alias("other"), F.col("component").alias("_c"))
    met = named.where("component <> main").join(others.hint("merge"), "class").where("component <> _c")
    pairs = stage(met.select(F.greatest("id", "other").alias("id"), F.least("id", "other").alias("other")).distinct(), "apart")
    unstage(named)
    return pairs


def _by_blocks(rows: DataFrame, members: DataFrame, links: DataFrame) -> DataFrame:
    """The passages that link members (class, id) of large classes which links do not join yet: as from _compare, of at least one pair
    for any two components of two blocks.

    A document has its block, by a hash, among those of its largest class; those outside the first component have their own. Blocks
    that have members of one class meet if members of one of them are outside the class's first component. However many classes
    two blocks have in common, they meet once.
    """
    named = _named(members, links)
    odd = F.col("component") != F.col("main")
    sizes = named.groupBy("class").agg(F.count(F.lit(1)).alias("_k"))
    home = named.join(sizes.hint("merge"), "class").groupBy("id", "component").agg(F.max(F.struct("_k", "class", odd.alias("odd"))).alias("h"))
    home = stage(home.select("id", "component", F.col("h.class").alias("home"), F.col("h.odd").alias("odd")), "home")
    parts = home.groupBy("home", "odd").agg(F.ceil(F.count(F.lit(1)) / BLOCKED).alias("_p"))
    block = F.xxhash64("home", "odd", F.pmod(F.xxhash64("id"), F.col("_p"))).alias("block")
    dealt = stage(home.join(parts.hint("merge"), ["home", "odd"]).select("id", "component", block), "dealt")
    there = stage(named.join(dealt.select("id", "block").hint("merge"), "id").groupBy("class", "block").agg(F.bool_or(odd).alias("odd")), "there")
    pairs = there.where("odd").select("class", F.col("block").alias("_b")).join(there.hint("merge"), "class")
    pairs = stage(pairs.select(F.least("_b", "block").alias("left"), F.greatest("_b", "block").alias("right")).distinct(), "pairs")
    texts = stage(rows.join(dealt.hint("merge"), "id").select("id", "component", "block", "text"), "texts")
    sides = [pairs.join(texts.withColumnRenamed("block", side).hint("merge"), side).select("left", "right", F.lit(side == "right").alias("second"), "id", "component", "text") for side in ("left", "right")]
    kind = to_arrow_type(rows.schema["id"].dataType)
    names = ("first_word", "end_word", "other_first", "other_end", "percent")
    schema = pa.schema([("id", kind), ("other", kind), *((x, pa.int32()) for x in names)])
    sql = rows.schema["id"].dataType.simpleString()
    found = sides[0].union(sides[1]).groupBy("left", "right").applyInArrow(_blocks_met(schema), f"id {sql}, other {sql}, " + ", ".join(f"{x} int" for x in names))
    found = stage(found, "passages")
    unstage(named, home, dealt, there, pairs, texts)
    return found


def shared_passages(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Passages of at least LEAST words that a document shares with another: one row for each document and passage.

    id_col, first_word, end_word (exclusive): the passage; other_id, other_first, other_end: where else it is; percent:
    the Jaccard similarity of their shingles; class_id: the earliest document that it is linked with by shared passages, of
    its own or of those that it is linked with; itself where it is the earliest. Every member of a class of windows meets the
    earliest of the class. Members with a place that no passage covers meet the next HEADS of those that have two such places
    in common with them. At last all members that have two places in common and are not linked yet meet: two documents that are
    known to have the same class_id are not compared any more, so a further place that only they share may have no row; nor are
    those that share one such place only, unless one of them is the earliest of its class. The earliest has a row of its own.
    Texts that are equal share all of them, without comparison: the earliest stands for the others, which have one row for the
    whole text. Null and short texts have no passages. Rows that repeat an id are one document, and those with a null id take
    no part. Further columns are not read; no rows give no rows.
    """
    rows = docs.where(F.col(id_col).isNotNull()).select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    kind = rows.schema["id"].dataType
    keyed = rows.withColumn("key", F.md5("text"))
    firsts = keyed.groupBy("key").agg(F.min("id").alias("other"), F.max("id").alias("_most"))
    copies = stage(keyed.select("id", "key").join(firsts.where("other <> _most").hint("merge"), "key").where("id <> other").select("id", "other", "key").distinct(), "copies")
    distinct = keyed.join(copies.select("id", "key").hint("merge"), ["id", "key"], "left_anti").select("id", "text")
    schema = pa.schema([("class", pa.int64()), ("lane", pa.int8()), ("known", pa.bool_()), ("id", to_arrow_type(kind)), ("at", pa.int32())])
    windows = distinct.mapInArrow(_windower(schema), f"class bigint, lane tinyint, known boolean, id {kind.simpleString()}, at int")
    # A window matters if another document has its key too: next to it, in the order of ids.
    by = Window.partitionBy("class", "lane").orderBy("id")
    near = windows.withColumn("p", F.lag("id").over(by)).withColumn("n", F.lead("id").over(by)).where("known or p <> id or n <> id")
    classes = stage(near.select("class", "id", "at"), "classes")

    # Heads are written down, so that the join shuffles both sides as they are and a class of very many can be split.
    heads = stage(classes.groupBy("class").agg(F.min("id").alias("other"), F.max("id").alias("_most")).where("other <> _most").select("class", "other"), "heads")
    pairs = classes.join(heads.hint("merge"), "class").where("id <> other").select("id", "other").union(copies.select("id", "other"))
    seen = [stage(pairs.distinct(), "pairs")]
    rounds = [_compare(rows, seen[0])]
    unstage(heads)
    places = stage(_uncovered(classes, rounds[0]), "places")
    left = _two_by_two(places)
    unstage(classes)
    # Members are numbered within their class by id: in each round, those that are open meet the next of them.
    numbered = lambda r: stage(r.select("class", "id").distinct().withColumn("n", F.row_number().over(Window.partitionBy("class").orderBy("id"))), "members")
    members = numbered(left)
    sizes = members.groupBy("class").agg(F.max("n").alias("k"))
    left, first = stage(left.where("open").select("class", "id", "at").join(sizes.hint("merge"), "class"), "left"), 0
    new = lambda p: stage(p.join(reduce(DataFrame.union, seen).hint("merge"), ["id", "other"], "left_anti"), "pairs")
    for most in HEADS:
        if left.isEmpty():
            break
        # A document meets the heads of all its classes, most of which are the same: each head once.
        heads = members.where(F.col("n").between(first + 1, most)).groupBy("class").agg(F.sort_array(F.collect_list("id")).alias("_h"))
        each = left.select("class", "id").join(heads.hint("merge"), "class").groupBy("id").agg(F.collect_set("_h").alias("_h"))
        met = each.select("id", F.explode(F.array_distinct(F.flatten("_h"))).alias("other")).where("id <> other")
        pairs = met.select(F.greatest("id", "other").alias("id"), F.least("id", "other").alias("other"))
        seen.append(new(pairs.distinct()))
        rounds.append(_compare(rows, seen[-1]))
        rest = stage(_uncovered(left.where(F.col("k") > most), rounds[-1]).where("open").drop("open"), "left")
        unstage(left)
        left, first = rest, most
    unstage(left, members)
    # Classes that have members of several components, covered or not.
    links = components(reduce(DataFrame.union, [r.select("id", "other") for r in rounds]), "id", "other")
    mixed = _named(places.select("class", "id", "at"), links)
    two = _two_by_two(mixed.select("class", "id", "at", F.lit(True).alias("open")))
    members = stage(two.select("class", "id").distinct(), "members")
    unstage(places, mixed, two)
    sizes = stage(members.groupBy("class").agg(F.count(F.lit(1)).alias("k")), "sizes")
    few, many = (members.join(sizes.where(x).select("class").hint("merge"), "class") for x in (f"k <= {PAIRED}", f"k > {PAIRED}"))
    apart = _apart(few, links)
    seen.append(new(apart))
    if not seen[-1].isEmpty():
        rounds.append(_compare(rows, seen[-1]))
        links = components(links.union(rounds[-1].select("id", "other")), "node", "component")
    if not many.isEmpty():
        rounds.append(_by_blocks(rows, many, links))
        links = components(links.union(rounds[-1].select("id", "other")), "node", "component")
    unstage(apart, sizes)
    unstage(members, copies, *seen)
    linked = links.select(F.col("node").alias("id"), F.col("component").alias("class_id"))
    both = reduce(DataFrame.union, rounds)
    # Both sides have the passage; of several documents that a passage was compared with, the earliest is named.
    sides = both.select("id", "first_word", "end_word", F.struct(F.col("other").alias("other_id"), "other_first", "other_end", "percent").alias("o"))
    sides = sides.union(both.select("other", "other_first", "other_end", F.struct("id", "first_word", "end_word", "percent")))
    named = sides.groupBy("id", "first_word", "end_word").agg(F.min("o").alias("o")).select("id", "first_word", "end_word", "o.*")
    return named.join(linked.hint("merge"), "id").withColumnRenamed("id", id_col)
