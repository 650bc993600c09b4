"""Hard negatives by a vertical scan: rows as columns of one dimension each, read until the rest cannot change the answer.

The rows lie in blocks, in order of label, a block as a matrix with a row for each dimension and its least and greatest
value. For each anchor a task reads the dimensions in the order of the anchor's descending magnitude. What the remaining
ones can add at least and at most bounds each candidate's score; who can no longer be among those asked for leaves the
candidates' bitmap. Scores that decide are whole, so that windows of scores resolve exactly.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from placeloom.llm.common import stage, unstage

#: Values in a block at most, and rows in a block at least, whatever the number of tasks.
BLOCK, LEAST_ROWS = 1 << 21, 1024
#: Reads of dimensions between two looks at the bounds: an eighth of all each.
LOOKS = 8
#: Above and below all scores of the exact kinds.
_TOP = float("inf")
_LONG = (1 << 63) - 1


def quantised(vector: Column, scale: int = 256) -> Column:
    """floor(scale * x) of each component as long; null if there is no vector, or a null or non-finite component."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.when(~bad, F.transform(vector, lambda x: F.floor(F.lit(scale) * x.cast("double")).cast("long")))


class Block:
    """The rows of one block as a matrix with a row for each dimension."""

    def __init__(self, ids: np.ndarray, labels: np.ndarray, columns: np.ndarray):
        order = np.argsort(ids, kind="stable")
        self.ids, self.labels, self.columns = ids[order], labels[order], columns[:, order]
        self.low, self.high = (f(self.columns, axis=1) for f in (np.min, np.max))

    def scan(self, anchor: np.ndarray, rows: np.ndarray, low: np.ndarray, high: np.ndarray, k: int) -> list[tuple[np.ndarray, np.ndarray]]:
        """For each window of scores low..high the first k of the given rows with a score in it: their numbers and scores.

        Rows come in order of id, so that of equal scores the smaller id is first.
        """
        dims = np.argsort(-np.abs(anchor), kind="stable")
        dims = dims[anchor[dims] != 0]
        q = anchor[dims]
        # what the dimensions from each place on add at least and at most
        ends = np.sort(np.stack([q * self.low[dims], q * self.high[dims]]), axis=0)
        least, most = (np.r_[np.cumsum(e[::-1])[::-1], np.zeros(1, e.dtype)] for e in ends)
        score = np.zeros(len(rows), self.columns.dtype)
        step = max(1, -(-len(dims) // LOOKS))
        whole = len(rows) == self.columns.shape[1]
        for at in range(0, len(dims) + 1, step):
            a, b = score + least[at], score + most[at]
            alive = np.zeros(len(rows), bool)
            for lo, hi in zip(low, high, strict=True):
                may = (b >= lo) & (a <= hi)
                sure = a[may & (a >= lo) & (b <= hi)]
                if len(sure) >= k:  # the k-th best of those surely inside: who cannot reach it is out
                    may &= b >= np.partition(sure, len(sure) - k)[len(sure) - k]
                alive |= may
            if not alive.any():
                rows, score = rows[:0], score[:0]
                break
            if alive.mean() < 0.75:
                rows, score, whole = rows[alive], score[alive], False
            for d, v in zip(dims[at : at + step], q[at : at + step], strict=True):
                score = score + v * (self.columns[d] if whole else self.columns[d][rows])
        out = []
        for lo, hi in zip(low, high, strict=True):
            inside = np.flatnonzero((score >= lo) & (score <= hi))
            first = inside[np.argsort(-score[inside], kind="stable")[:k]]
            out.append((rows[first], score[first]))
        return out


def _matrix(vectors: pa.Array) -> np.ndarray:
    """Lists of long as a matrix, short ones filled with 0."""
    sizes = vectors.value_lengths().to_numpy()
    width = int(sizes.max()) if len(sizes) else 0
    flat = vectors.flatten().to_numpy()
    if (sizes == width).all():
        return flat.reshape(len(sizes), width)
    out = np.zeros((len(sizes), width), np.int64)
    out[np.repeat(np.arange(len(sizes)), sizes), np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = flat
    return out


def _wide(m: np.ndarray, width: int) -> np.ndarray:
    return np.pad(m, ((0, 0), (0, width - m.shape[1])))


def _exact(rows: np.ndarray, anchors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Both as numbers whose sums of products are exact: double below 2^53, else long below 2^62, else of any size."""
    top = max((max(abs(int(m.min())), abs(int(m.max()))) for m in (rows, anchors) if m.size), default=0)
    bound = 4 * top * top * max(1, rows.shape[1])
    kind = np.float64 if bound < 1 << 53 else np.int64 if bound < 1 << 62 else object
    return rows.astype(kind), anchors.astype(kind)


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, int, pa.RecordBatch]]:
    """The rows of each block and kind that follow one another in a batch."""
    for batch in batches:
        block, kind = (batch.column(c).to_numpy() for c in ("block", "kind"))
        cuts = [0, *(np.flatnonzero((block[1:] != block[:-1]) | (kind[1:] != kind[:-1])) + 1).tolist(), len(block)]
        for a, b in zip(cuts, cuts[1:], strict=False):
            if a < b:
                yield int(block[a]), int(kind[a]), batch.slice(a, b - a)


def _scanner(k: int, same: bool, low: int, high: int):
    """Rows of a block, then the anchors that look through it: for each the first k of its label, or of others in a window around each of its positives' scores."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, gathered, blocks = None, [], {}
        for block, kind, part in _runs(batches):
            if block != at:
                at, gathered, blocks = block, [], {}
            if kind == 0:
                gathered.append(part)
                continue
            if not gathered:
                continue
            if not blocks:
                raw = [_matrix(p.column("v")) for p in gathered]
                width = max(m.shape[1] for m in raw)
                blocks["raw"] = np.concatenate([_wide(m, width) for m in raw])
                blocks["ids"], blocks["labels"] = (np.concatenate([p.column(c).to_numpy() for p in gathered]) for c in ("id", "label"))
            anchors, raw = _matrix(part.column("v")), blocks["raw"]
            width = max(anchors.shape[1], raw.shape[1])
            x, q = _exact(_wide(raw, width), _wide(anchors, width))
            if (key := (x.dtype, width)) not in blocks:
                blocks[key] = Block(blocks["ids"], blocks["labels"], np.ascontiguousarray(x.T))
            yield _found(blocks[key], q, part, k, same, low, high)

    return scan


def _found(block: Block, q: np.ndarray, part: pa.RecordBatch, k: int, same: bool, low: int, high: int) -> pa.RecordBatch:
    out: list[tuple] = []
    for vector, anchor, label, positives in zip(q, part.column("id").to_pylist(), part.column("label").to_pylist(), part.column("positives").to_pylist(), strict=True):
        rows = np.flatnonzero((block.labels == label) & (block.ids != anchor) if same else block.labels != label)
        if not len(rows) or not (same or positives):
            continue
        if same:
            wanted, windows = [(None, None)], ([-_TOP], [_TOP])
        else:
            wanted = [(p["id"], p["score"]) for p in positives]
            windows = [-(-low * s // 100) for _, s in wanted], [high * s // 100 for _, s in wanted]
        for (positive, its), (found, scores) in zip(wanted, block.scan(vector, rows, *windows, k), strict=True):
            out += [(anchor, positive, its, i, max(-_LONG, min(_LONG, int(s)))) for i, s in zip(block.ids[found].tolist(), scores.tolist(), strict=True)]
    columns = zip(*out, strict=True) if out else [[]] * len(_FOUND)
    return pa.RecordBatch.from_arrays([pa.array(list(c), pa.int64()) for c in columns], _FOUND)


_FOUND = ["anchor_id", "positive_id", "positive_score", "other", "score"]
_SCHEMA = StructType([StructField(c, LongType()) for c in _FOUND])
_POSITIVES = "array<struct<score: bigint, id: bigint>>"


def blocked(rows: DataFrame) -> DataFrame:
    """rows(id, label, v) with the number of their block, in order of label and id, written down. One row for each id: the least label and vector.

    Blocks are as many as keep a block within BLOCK values, or as give each core two if that is more.
    """
    n, width = rows.agg(F.count(F.lit(1)), F.max(F.size("v"))).first()
    most = max(LEAST_ROWS, -(-n // (2 * rows.sparkSession.sparkContext.defaultParallelism)))
    size = max(1, min(BLOCK // max(1, width or 1), most))
    one = rows.groupBy("id").agg(F.min(F.struct("label", "v")).alias("_r")).select("id", "_r.*")
    return stage(one.repartitionByRange(max(1, -(-n // size)), "label", "id").select(F.spark_partition_id().alias("block"), "*"), "blocks")


def _scanned(blocks: DataFrame, anchors: DataFrame, k: int, same: bool, low: int = 0, high: int = 0) -> DataFrame:
    """Rows and anchors(block, id, label, v, positives) come together by block, the rows first; anchors stream past them."""
    both = blocks.select("block", F.lit(0).alias("kind"), "id", "label", "v", F.lit(None).cast(_POSITIVES).alias("positives")).unionByName(anchors.select("block", F.lit(1).alias("kind"), "id", "label", "v", "positives"))
    return both.repartition("block").sortWithinPartitions("block", "kind", "id").mapInArrow(_scanner(k, same, low, high), _SCHEMA)


def _first(found: DataFrame, by: list[str], k: int) -> DataFrame:
    w = Window.partitionBy(*by).orderBy(F.desc("score"), "other")
    return found.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


def mine(rows: DataFrame, anchor: Column, positives: int = 5, negatives: int = 3, low: int = 50, high: int = 95) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    rows(id long, label, v array<long>); anchor is a condition on id and label. A score is the inner product. For each
    anchor and each of the first so many other rows of its label, the first so many rows of other labels whose score is
    from low to high per cent of the positive's. Ties go by id.

    Rows with a null take no part; rows of one id count once, the least label and vector; short vectors end in zeros;
    scores beyond a long are given as its ends. An empty table, or one without anchors, gives an empty one.
    """
    kept = rows.select(F.col("id").cast("long").alias("id"), F.col("label").cast("long").alias("label"), "v").where("id is not null and label is not null and v is not null")
    blocks = blocked(kept)
    anchors = blocks.where(anchor).select("id", "label", "v")
    places = blocks.groupBy("label", "block").agg(F.count(F.lit(1)).alias("_n")).select("label", "block")
    near = _scanned(blocks, anchors.join(places, "label").withColumn("positives", F.lit(None).cast(_POSITIVES)), positives, True)
    best = _first(near, ["anchor_id"], positives).groupBy(F.col("anchor_id").alias("id")).agg(F.collect_list(F.struct("score", F.col("other").alias("id"))).alias("positives"))
    asking = stage(anchors.join(best, "id"), "anchors")
    last = blocks.agg(F.max("block")).first()[0] or 0
    everywhere = asking.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(last))))
    found = stage(_scanned(blocks, everywhere, negatives, False, low, high), "found")
    unstage(blocks, asking)
    return _first(found, ["anchor_id", "positive_id"], negatives).select("anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), F.col("other").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))
