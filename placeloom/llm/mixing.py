"""Mixing sources to target weights along a time-varying curriculum.

Each source has a target in words and a weight schedule over training time. The
integral of the schedule, scaled to the target, is the source's cumulative
demand; inverting it at the place of a document in its source's stream gives
the document's training position. The mix is sorted by position, by range.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from placeloom.llm.common import WORD, text_of

#: Weights of the sources by name, repeating; their share of all words; how often a source or document may come.
WEIGHTS, SHARE, MOST = (5, 2, 1), 1.5, 2
#: Weight schedules, repeating likewise: (training time from 0 to 1, weight), linear in between. The first fades, the last grows.
SCHEDULES = (((0.0, 1.5), (1.0, 0.5)), ((0.0, 1.0), (1.0, 1.0)), ((0.0, 0.5), (0.5, 0.5), (1.0, 2.5)))
#: Documents in a part, about, if a source had them all: what is sorted in one task.
PART = 4096


def n_words(text_col: str = "text") -> Column:
    return F.regexp_count(text_of(text_col), F.lit(WORD)).cast("long")


def _integral(knots) -> list[tuple[float, float, float, float]]:
    """(share of the integral before, time, weight, slope) of each segment; the integral over all time is 1."""
    area = sum((b[0] - a[0]) * (a[1] + b[1]) / 2 for a, b in zip(knots, knots[1:], strict=False))
    out, done = [], 0.0
    for (t, w), (u, v) in zip(knots, knots[1:], strict=False):
        out.append((done, t, w / area, (v - w) / area / (u - t)))
        done += (u - t) * (w + v) / 2 / area
    return out


def training_time(x: Column, rank: Column, schedules=SCHEDULES) -> Column:
    """When a source's cumulative demand reaches the share x of its target: the schedule's integral, inverted."""
    out = None
    for k, knots in enumerate(schedules):
        one = None
        for done, t, w, slope in _integral(knots):
            d = F.greatest(x - done, F.lit(0.0))
            # w s + slope s^2 / 2 = d, in the form that holds for a slope of 0
            s = F.lit(t) + F.coalesce(F.try_divide(2 * d, F.lit(w) + F.sqrt(F.greatest(F.lit(w * w) + 2 * slope * d, F.lit(0.0)))), F.lit(0.0))
            one = s if one is None else F.when(x >= done, s).otherwise(one)
        out = F.when(rank % len(schedules) == k, one) if out is None else out.when(rank % len(schedules) == k, one)
    return out


def targets(sizes: DataFrame, weights=WEIGHTS, share: float = SHARE, most: int = MOST) -> DataFrame:
    """sizes(source, source_size) with rank, weight and target.

    One row for each source comes together here, after aggregation, and nothing else. Sources go by code point, null last. A target is weight times one common level, at most `most` times the source's
    size; the level that spends `share` of all words is the greatest of the levels with the first k sources held at
    their most, by size over weight.
    """
    ranked = sizes.withColumn("rank", F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1)
    ranked = ranked.withColumn("weight", F.get(F.array(*map(F.lit, weights)), F.col("rank") % len(weights)))
    full = F.col("source_size") * most
    by = Window.orderBy(full / F.col("weight"), "rank")
    before, everything = by.rowsBetween(Window.unboundedPreceding, -1), Window.partitionBy()
    level = F.try_divide(share * F.sum("source_size").over(everything) - F.coalesce(F.sum(full).over(before), F.lit(0)), F.sum("weight").over(by.rowsBetween(0, Window.unboundedFollowing)))
    levels = ranked.withColumn("level", level).withColumn("level", F.max("level").over(everything))
    return levels.withColumn("target", F.least(full.cast("double"), F.col("weight") * F.col("level"))).drop("level")


def plan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", weights=WEIGHTS, share: float = SHARE, most: int = MOST, schedules=SCHEDULES, keep=()) -> DataFrame:
    """One row for each row of docs, sorted by first position: id, size, source_size, target, taken, positions.

    positions are the training times, from 0 to 1, at which the mix takes the document; at most `most`. Within a source
    documents come by a hash of their id, once for each pass over the source; a document is taken where at least half
    of it lies before the target. Repeated rows are documents of their own; a null text has no words; null ids and
    sources are allowed; a document without words costs nothing. Documents of equal id and size go by the hash of their
    text, so reruns agree; what is equal in all of this is taken in any order, with equal results. An empty table gives
    an empty one. `keep` names further columns to carry. A source is dealt into parts by the hash, more of them the more
    rows there are; running totals go over its parts first, and then inside each.
    """
    digits = max(1, math.ceil(math.log(max(docs.count(), 1) / PART + 1, 16)))
    id_ = F.col(id_col)
    rows = docs.select(
        id_.alias("_id"), F.col(source_col).alias("_source"), n_words(text_col).alias("size"), F.md5(F.coalesce(id_.cast("string"), F.lit(""))).alias("_order"), F.xxhash64(text_col).alias("_tie"), F.struct(*map(F.col, keep)).alias("_keep") if keep else F.lit(None).alias("_keep")
    )
    rows = rows.withColumn("_none", F.col("_source").isNull()).withColumn("_name", F.coalesce("_source", F.lit(""))).withColumn("_part", F.substring("_order", 1, digits))
    parts = rows.groupBy("_none", "_name", "_part").agg(F.sum("size").alias("words"))
    sizes = parts.groupBy("_none", "_name").agg(F.sum("words").alias("source_size"))
    goal = targets(sizes.withColumn("source", F.when(~F.col("_none"), F.col("_name"))), weights, share, most).select("_none", "_name", "source_size", "rank", "target")
    earlier = Window.partitionBy("_none", "_name").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = parts.select("_none", "_name", "_part", F.coalesce(F.sum("words").over(earlier), F.lit(0)).alias("before")).join(goal, ["_none", "_name"])
    inside = Window.partitionBy("_none", "_name", "_part").orderBy("_order", "_id", "size", "_tie").rowsBetween(Window.unboundedPreceding, -1)
    placed = rows.withColumn("_inside", F.coalesce(F.sum("size").over(inside), F.lit(0))).join(starts, ["_none", "_name", "_part"])
    start = F.col("before") + F.col("_inside")
    offsets = F.filter(F.transform(F.sequence(F.lit(0), F.lit(most - 1)), lambda k: start + k * F.col("source_size")), lambda o: o + F.col("size") / 2 <= F.col("target"))
    placed = placed.withColumn("offsets", offsets)
    share_of = lambda o: F.coalesce(F.try_divide(o.cast("double"), F.col("target")), F.lit(0.0))
    out = placed.select(
        F.col("_id").alias(id_col), "size", "source_size", "target", (F.col("size") * F.size("offsets")).alias("taken"), F.transform("offsets", lambda o: training_time(share_of(o), F.col("rank"), schedules)).alias("positions"), *(["_keep"] if keep else [])
    )
    return out


def by_position(mix: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """The plan's rows sorted by their first position, then by id; those that are not taken last. Null ids first among equals."""
    return mix.withColumn("first_position", F.get("positions", F.lit(0))).orderBy(F.col("first_position").asc_nulls_last(), id_col)


def mixed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", **more) -> DataFrame:
    """The mix itself: docs' columns, a row for each time that a document is taken, sorted by training position, then by id.

    Nulls, ties and repeated rows as in plan; column names may be any. An empty table gives an empty one."""
    names = docs.columns
    rows = plan(docs, id_col, text_col, source_col, keep=tuple(names), **more)
    out = rows.select("_keep", F.explode("positions").alias("_position")).orderBy("_position", F.col(f"_keep.{id_col}"))
    return out.select(*[F.col("_keep").getField(n).alias(n) for n in names])
