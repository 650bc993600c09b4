"""Documents linked by the Jaccard similarity of their word shingles, and what these links connect.

Equal shingle sets are one node. Tokens are shingle hashes, ordered from rare to
common: two similar sets share k tokens among their first ones (the prefix of
size - ceil(0.75 size) + k), whatever the order is, so long as it is the same
for all. Nodes whose prefix holds enough tokens that others have are partitioned
into groups of similar ones, and each group's token union is stored (a row of
the token-group matrix for each token). A node meets the matrix by its prefix:
sizes and the overlap with a group's union bound how alike it can be to any
member, and only groups that qualify are opened. The node is then compared
exactly with all of the members in one step; no row is made for a pair that differs.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import from_arrow_type, to_arrow_type
from pyspark.sql.types import BinaryType, BooleanType

from placeloom.llm.common import small_batches, stage, unstage
from placeloom.llm.graph import components
from placeloom.llm.shingles import chunks, shingle_lists

#: Linked if 100 * shared >= PERCENT * together.
PERCENT = 75
#: A prefix is longer than it must be by one token in as many; similar sets share as many more in their prefixes.
LONGER = 8
#: Tokens counted together in a task, and how often one must come there for its count to go on.
BLOCK, SEEN = 1 << 21, 4
#: A token that comes so often in all blocks is common. The table of common ones has at most MOST_COMMON rows, the least
#: common left out: it only orders tokens, so results do not depend on it.
COMMON, MOST_COMMON = 16, 1 << 20
#: Parts into which a common token's nodes are dealt.
LANES = 64
#: Nodes, and tokens of all of them, in a group or in what asks it in one step, about.
GROUP, GROUP_TOKENS = 256, 400_000

_PREFIX = pa.struct([("node", pa.int64()), ("tokens", pa.list_(pa.struct([("token", pa.int64()), ("lane", pa.int8())])))])
_FOUND = pa.list_(pa.struct([("a", pa.int64()), ("b", pa.int64())]))


def _sets(texts: pa.Array) -> Iterator[list[np.ndarray]]:
    for some in chunks(texts):
        yield [np.unique(x) for x in shingle_lists(some)]


def _digest(tokens: np.ndarray) -> bytes:
    return hashlib.blake2b(tokens.tobytes(), digest_size=16).digest()


def _node(digest: bytes) -> int:
    return int.from_bytes(digest[:8], "little", signed=True)


def _signer(schema: pa.Schema) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """For batches of (id, text): rows of id, key, n, set, node; and rows of token, times: what comes often in a block of sets."""

    def rows(columns: dict) -> pa.RecordBatch:
        n = len(next(iter(columns.values())))
        return pa.RecordBatch.from_arrays([columns[f.name] if f.name in columns else pa.nulls(n, f.type) for f in schema], schema=schema)

    def often(block: dict[bytes, np.ndarray]) -> pa.RecordBatch:
        tokens, times = np.unique(np.concatenate(list(block.values())), return_counts=True)
        often = times >= SEEN
        return rows({"token": pa.array(tokens[often].view(np.int64)), "times": pa.array(times[often])})

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block: dict[bytes, np.ndarray] = {}
        held = 0
        for batch in batches:
            keys, n, sets = [], [], []
            for some in chunks(batch.column(1)):
                keys += [hashlib.md5(t).digest() for t in some]
                for tokens in map(np.unique, shingle_lists(some)):
                    digest = _digest(tokens) if len(tokens) else None
                    n.append(len(tokens))
                    sets.append(digest)
                    if digest and digest not in block:
                        block[digest] = tokens
                        held += len(tokens)
                if held >= BLOCK:
                    yield often(block)
                    block, held = {}, 0
            yield rows({"id": batch.column(0), "key": pa.array(keys, pa.binary()), "n": pa.array(n, pa.int64()), "set": pa.array(sets, pa.binary()), "node": pa.array([s and _node(s) for s in sets], pa.int64())})
        if block:
            yield often(block)

    return sign


def _common(spark: SparkSession, counted: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """The common tokens, sorted, and of each the logarithm of its count: MOST_COMMON at most."""
    known = stage(counted.where("token is not null").groupBy("token").agg(F.sum("times").alias("times")).where(f"times >= {COMMON}").select("token", F.log2("times").cast("byte").alias("level")), "common")
    levels, least, total = sorted(((r["level"], r["count"]) for r in known.groupBy("level").count().collect()), reverse=True), 127, 0
    for level, count in levels:
        if (total := total + count) > MOST_COMMON:
            break
        least = level
    found = known.where(F.col("level") >= least).toArrow()
    unstage(known)
    tokens, level = found.column("token").to_numpy().view(np.uint64), found.column("level").to_numpy()
    order = np.argsort(tokens)
    return tokens[order], level[order]


def prefix_size(n: int) -> int:
    """How many of n ordered tokens a set shows, to share n // LONGER + 1 with any similar set that shows as many of its own."""
    return min(n, n + (-PERCENT * n) // 100 + n // LONGER + 1)


def shared_least(n: Column) -> Column:
    """Tokens in the prefix of a set of n that any similar set has in its own: the smaller of the two has PERCENT of n at least."""
    return F.floor(F.ceil(n * PERCENT / 100) / LONGER) + 1


def _prefixes(table):
    """A UDF: each text's node and the first tokens of its set, from rare to common. lane: -1 for one that is not common."""

    @F.arrow_udf(from_arrow_type(_PREFIX))
    def prefixes(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        common, level = table.value
        for texts in batches:
            nodes, sizes, tokens, lanes = [], [], [np.zeros(0, np.uint64)], [np.zeros(0, np.int8)]
            for sets in _sets(texts):
                all_ = np.concatenate(sets)
                levels = np.zeros(len(all_), np.int8)
                if len(common):
                    at = np.searchsorted(common, all_)
                    at[at == len(common)] = 0
                    levels = np.where(common[at] == all_, level[at], 0)
                low = 0
                for x in sets:
                    mine, low = levels[low : low + len(x)], low + len(x)
                    if not len(x):
                        nodes.append(None)
                        sizes.append(0)
                        continue
                    node, p = _node(_digest(x)), prefix_size(len(x))
                    nodes.append(node)
                    sizes.append(p)
                    if mine.any():
                        order = np.argsort(mine, kind="stable")[:p]
                        x, lane = x[order], np.where(mine[order] > 0, np.int8(node % LANES), np.int8(-1))
                    else:
                        x, lane = x[:p], np.full(p, -1, np.int8)
                    tokens.append(x)
                    lanes.append(lane)
            offsets = pa.array(np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32))
            each = pa.StructArray.from_arrays([pa.array(np.concatenate(tokens).view(np.int64)), pa.array(np.concatenate(lanes))], ["token", "lane"])
            yield pa.StructArray.from_arrays([pa.array(nodes, pa.int64()), pa.ListArray.from_arrays(offsets, each)], ["node", "tokens"])

    return prefixes


@F.arrow_udf(BinaryType())
def _tokens(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
    """Each text's whole set, sorted, as bytes."""
    for texts in batches:
        yield pa.array([x.tobytes() for sets in _sets(texts) for x in sets], pa.binary())


def _shared(a: np.ndarray, b: np.ndarray) -> int:
    """How many numbers two sorted arrays without repeats share."""
    if len(a) > len(b):
        a, b = b, a
    if not len(a):
        return 0
    at = np.searchsorted(b, a)
    at[at == len(b)] = 0
    return int((b[at] == a).sum())


@F.arrow_udf(BooleanType())
def _linked(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
    for left, right in batches:
        out = []
        for x, y in zip(left, right, strict=True):
            a, b = (np.frombuffer(z.as_buffer(), np.uint64) for z in (x, y))
            shared = _shared(a, b) if 100 * min(len(a), len(b)) >= PERCENT * max(len(a), len(b)) else 0
            out.append(shared > 0 and 100 * shared >= PERCENT * (len(a) + len(b) - shared))
        yield pa.array(out, pa.bool_())


def _links(some: list[tuple[int, int, np.ndarray]], members: list[tuple[int, int, np.ndarray]]) -> Iterator[tuple[int, int]]:
    """Links between similar sets, one of those that ask and one of a group's members: (node, component, tokens).

    Only links that join components not joined yet: as few as connect all that the pairs of both sides connect.
    """
    root: dict[int, int] = {}

    def find(c: int) -> int:
        while root.get(c, c) != c:
            root[c] = c = root.get(root[c], root[c])
        return c

    node, component = (np.array([m[k] for m in members]) for k in (0, 1))
    n = np.array([len(m[2]) for m in members])
    tokens, whose = np.concatenate([m[2] for m in members]), np.repeat(np.arange(len(members)), n)
    order = np.argsort(tokens, kind="stable")
    tokens, whose = tokens[order], whose[order]
    union, first = np.unique(tokens, return_index=True)
    held = np.diff(np.append(first, len(tokens)))
    inside = set(node.tolist())
    for q, c, x in some:
        # a member that asks its own group meets each pair once
        other = (component != c) & (100 * np.minimum(n, len(x)) >= PERCENT * np.maximum(n, len(x)))
        if q in inside:
            other &= node > q
        if not other.any():
            continue
        at = np.searchsorted(union, x)
        at[at == len(union)] = 0
        at = at[union[at] == x]
        # the overlap with the union bounds that with any member
        if 100 * len(at) < PERCENT * max(len(x), int(n[other].min())):
            continue
        starts, counts = first[at], held[at]
        rows = np.repeat(starts - np.concatenate([[0], np.cumsum(counts)[:-1]]), counts) + np.arange(counts.sum())
        shared = np.bincount(whose[rows], minlength=len(members))
        for k in np.flatnonzero(other & (100 * shared >= PERCENT * (n + len(x) - shared))):
            one, two = find(c), find(int(component[k]))
            if one != two:
                root[one] = two
                yield q, int(node[k])


@F.arrow_udf(from_arrow_type(_FOUND))
def _opened(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
    def listed(x) -> list[tuple[int, int, np.ndarray]]:
        node, component, tokens = (x.values.field(k) for k in ("v", "component", "tokens"))
        return list(zip(node.to_pylist(), component.to_pylist(), (np.frombuffer(t.as_buffer(), np.uint64) for t in tokens), strict=True))

    for asking, held in batches:
        yield pa.array([[{"a": a, "b": b} for a, b in _links(listed(some), listed(members))] for some, members in zip(asking, held, strict=True)], _FOUND)


def _key(text: Column) -> Column:
    """The MD5 of a text, null being the empty text."""
    return F.unhex(F.md5(F.coalesce(text, F.lit(""))))


def _signed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """id, key, n, set, node, row of every row of docs, then token, times of tokens that come often; staged."""
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    schema = f"id {kind}, key binary, n bigint, set binary, node bigint, token bigint, times bigint"
    arrow = pa.schema([("id", to_arrow_type(rows.schema["id"].dataType)), ("key", pa.binary()), ("n", pa.int64()), ("set", pa.binary()), ("node", pa.int64()), ("token", pa.int64()), ("times", pa.int64())])
    return stage(rows.mapInArrow(_signer(arrow), schema).withColumn("row", F.monotonically_increasing_id()), "signed")


def _components(docs: DataFrame, signed: DataFrame, text_col: str) -> DataFrame:
    """(set, component) of the sets that links reach."""
    spark = docs.sparkSession
    table = spark.sparkContext.broadcast(_common(spark, signed))
    each = docs.select(_prefixes(table)(F.col(text_col)).alias("p")).select("p.node", F.explode("p.tokens").alias("t")).select("node", "t.token", "t.lane")
    # A token matters if another node has it too: next to it, in the order of nodes. A common one needs no look, and its nodes are dealt into lanes.
    by = Window.partitionBy("token", "lane").orderBy("node")
    near = each.withColumn("before", F.lag("node").over(by)).withColumn("after", F.lead("node").over(by)).where("lane >= 0 or before <> node or after <> node")
    shared = stage(near.select("token", "node", (F.col("lane") >= 0).alias("common")).distinct(), "shared")

    held = shared.groupBy("node").agg(F.count(F.lit(1)).alias("held"))
    sets = signed.where("set is not null").select("node", "set", "row", "key", "n").join(held, "node").where(F.col("held") >= shared_least(F.col("n")))
    sets = stage(sets.groupBy("node", "set").agg(F.min(F.struct("row", "key", "n")).alias("m")).select("node", "set", F.col("m.row").alias("v"), "m.key", "m.n"), "sets")
    texts = docs.select(_key(F.col(text_col)).alias("key"), F.col(text_col).alias("_t")).join(sets.select("key", "v").hint("merge"), "key").select("v", "_t").dropDuplicates(["v"])
    with small_batches(spark, 2000):
        tokens = stage(texts.select("v", _tokens(F.col("_t")).alias("tokens")), "tokens")

    # Groups of similar nodes: those with the same first common token, else the same first token; large ones are split.
    tokened = shared.join(sets.select("node", "v", "n"), "node").select("token", "common", "v", "n")
    placed = tokened.groupBy("v", "n").agg(F.coalesce(F.min(F.when(F.col("common"), F.col("token"))), F.min("token")).alias("near"))
    of_near = placed.groupBy("near").agg(F.min("v").alias("head"), F.greatest(F.ceil(F.count(F.lit(1)) / GROUP), F.ceil(F.sum("n") / GROUP_TOKENS)).alias("parts"))
    placed = stage(placed.join(of_near, "near").select("v", "n", "head", F.xxhash64("near", F.pmod(F.xxhash64("v"), "parts")).alias("group")), "placed")

    # Texts and tokens are joined by sorting at every size, so that a plan that holds on little data holds on much.
    # First each node and the first one near it: what this links needs no comparison any more.
    pairs = placed.where("v <> head").select("v", "head")
    left, right = tokens.select("v", F.col("tokens").alias("_l")), tokens.select(F.col("v").alias("head"), F.col("tokens").alias("_r"))
    with small_batches(spark):
        first = stage(pairs.join(left.hint("merge"), "v").join(right.hint("merge"), "head").where(_linked(F.col("_l"), F.col("_r"))).select(F.col("v").alias("a"), F.col("head").alias("b")), "links")
    found = components(first, "a", "b")

    members = placed.join(found.withColumnRenamed("node", "v"), "v", "left").select("v", "n", "group", F.coalesce("component", "v").alias("component"))
    members = stage(members, "members")
    rows = tokened.select("token", "v").join(members, "v")
    matrix = rows.groupBy("token", "group").agg(F.min("component").alias("x"), F.max("component").alias("y"), F.min("n").alias("least"), F.max("n").alias("most"))
    asks = rows.select("token", "v", "n", "component", F.col("group").alias("own")).join(matrix, "token").where("own >= group and not (x = component and y = component)").where(f"100 * n >= {PERCENT} * least and 100 * most >= {PERCENT} * n")
    asks = asks.groupBy("v", "n", "group").agg(F.count(F.lit(1)).alias("overlap")).where(F.col("overlap") >= shared_least(F.col("n")))
    asks = stage(asks.select("v", "group"), "asks")

    whole = members.join(tokens.hint("merge"), "v").select("v", "n", "group", "component", "tokens")
    one = F.struct("v", "component", "tokens")
    held = whole.join(asks.select("group").distinct(), "group", "left_semi").groupBy("group").agg(F.collect_list(one).alias("held"))
    asking = asks.join(whole.drop("group").hint("merge"), "v")
    steps = asks.join(members.select("v", "n"), "v").groupBy("group").agg(F.greatest(F.ceil(F.count(F.lit(1)) / GROUP), F.ceil(F.sum("n") / GROUP_TOKENS)).alias("steps"))
    asking = asking.join(steps, "group").groupBy("group", F.pmod(F.xxhash64("v"), "steps").alias("step")).agg(F.collect_list(one).alias("asking"))
    with small_batches(spark, 8):
        more = stage(asking.join(held, "group").select(F.explode(_opened(F.col("asking"), F.col("held"))).alias("p")).select("p.*"), "links")
    if not more.isEmpty():
        found = components(first.union(more), "a", "b")
    out = stage(sets.select("set", F.col("v").alias("node")).join(found, "node").select("set", "component"), "found")
    unstage(shared, sets, tokens, placed, first, members, asks, more)
    return out


def _named(docs: DataFrame, id_col: str, text_col: str) -> tuple[DataFrame, DataFrame]:
    """signed, and (set, name, component): the least id that a set reaches."""
    signed = _signed(docs, id_col, text_col)
    found = _components(docs, signed, text_col)
    rows = signed.where("set is not null").groupBy("set").agg(F.min("id").alias("least"))
    rows = rows.join(found, "set", "left")
    names = rows.where("component is not null").groupBy("component").agg(F.min("least").alias("name"))
    return signed, stage(rows.join(names, "component", "left").select("set", F.coalesce("name", "least").alias("name"), "component"), "names")


def link(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row for each row of docs: id_col, n_shingles, component_id.

    component_id is the smallest id that links reach, the row's own included. Texts without words, and null ones, have
    no shingles and are linked with nothing. Copies of any number are one node; no group of similar documents comes
    together in one task, and no pairs of all its members are made. Links are exact: none is lost, whatever the length
    of the texts. Rows that repeat an id stay, and each row follows its own text; a null id stays null and is nobody's
    smallest. Further columns are not read. No rows give no rows.
    """
    signed, names = _named(docs, id_col, text_col)
    return signed.where("n is not null").join(names, "set", "left").select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"), F.coalesce("name", "id").alias("component_id"))


def deduplicated(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """docs with one row of each component: that with the smallest id, null last, and of those with the least hash of its text.

    Of rows that repeat the id and the text one stays. Rows without words, null texts among them, all stay. All columns
    are kept, whatever their names. An empty table gives an empty one.
    """
    signed, names = _named(docs, id_col, text_col)
    group = F.coalesce(F.concat(F.lit("c"), F.col("component").cast("string")), F.hex("set"))
    rows = signed.where("set is not null").join(names, "set").groupBy(group.alias("group"), "id", "key").agg(F.count(F.lit(1)).alias("times"))
    first = rows.groupBy("group").agg(F.min(F.struct(F.col("id").isNull().alias("none"), "id", "key", "times")).alias("m"))
    first = stage(first.select(F.col("m.id").alias("_id"), F.col("m.key").alias("_key"), "m.times"), "first")
    text = F.col(text_col)
    whole = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col(id_col).alias("id"), _key(text).alias("key"), F.coalesce(text, F.lit("")).rlike(r"[^\x20\x09-\x0D]").alias("has_words"))
    same = (F.col("key") == F.col("_key")) & F.col("id").eqNullSafe(F.col("_id"))
    out = whole.join(first.where("times = 1"), same, "left_semi").select("row").union(whole.where("not has_words").select("row"))
    often = first.where("times > 1")
    if not often.isEmpty():
        out = out.union(whole.join(often, same, "left_semi").dropDuplicates(["id", "key"]).select("row"))
    return out.select("row.*")
