"""Ranks, percentiles, deduplication, changes over time."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from placeloom.functions.values import pattern_score


#: Ranges that distinct values are dealt into, to be sorted side by side.
RANGES = 200


def ranked(df: DataFrame, value: str, ascending: bool = True) -> DataFrame:
    """df with rank_min, rank_dense and pct_rank (average rank of ties over all values) of a number; null stays unranked.

    Distinct values, each with how often it comes, are dealt into ranges by approximate quantiles and sorted inside
    them; only one row a range meets in one task, to say how many values lie before it.
    """
    counts = df.where(F.col(value).isNotNull()).groupBy(value).agg(F.count(F.lit(1)).alias("_n"))
    bounds = counts.agg(F.percentile_approx(F.col(value).cast("double"), [i / RANGES for i in range(1, RANGES)], 10_000).alias("_b"))
    x = F.col(value).cast("double")
    placed = counts.crossJoin(F.broadcast(bounds)).withColumn("_range", F.size(F.filter("_b", lambda b: b < x)) * (1 if ascending else -1)).drop("_b")
    by = Window.partitionBy("_range").orderBy(F.col(value) if ascending else F.col(value).desc())
    of_range = placed.groupBy("_range").agg(F.sum("_n").alias("_rows"), F.count(F.lit(1)).alias("_values"))
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    starts = of_range.select("_range", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_before"), F.coalesce(F.sum("_values").over(before), F.lit(0)).alias("_dense"), F.sum("_rows").over(Window.partitionBy()).alias("_all"))
    inside = placed.withColumn("_inside", F.coalesce(F.sum("_n").over(by.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).withColumn("_nth", F.row_number().over(by))
    first = F.col("_before") + F.col("_inside") + 1
    places = inside.join(F.broadcast(starts), "_range").select(value, first.alias("rank_min"), (F.col("_dense") + F.col("_nth")).cast("long").alias("rank_dense"), ((first + (F.col("_n") - 1) / 2) / F.col("_all")).alias("pct_rank"))
    return df.join(places, value, "left")


def keep_first(df: DataFrame, keys: Sequence[str], order: Sequence[Column], keep_blank: bool = False) -> DataFrame:
    """The first row of each key in the given order; with keep_blank, all rows of a blank key."""
    n = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    blank = F.lit(False)
    for k in keys:
        blank = blank | F.col(k).isNull() | (F.trim(F.col(k).cast("string")) == "")
    return df.withColumn("_n", n).where((F.col("_n") == 1) | (blank if keep_blank else F.lit(False))).drop("_n")


def changes(df: DataFrame, keys: Sequence[str], period: str, value: str) -> DataFrame:
    """df with the difference to the period that comes before among its rows, and in per cent where that was above 0."""
    before = F.lag(value).over(Window.partitionBy(*keys).orderBy(period))
    return df.withColumn("difference", F.col(value) - before).withColumn("change_pct", F.when(before > 0, (F.col(value) - before) / before * 100))


def latest(df: DataFrame, period: str) -> DataFrame:
    """Rows of the latest period: the period is worked out first, so scans can skip the others."""
    return df.join(F.broadcast(df.agg(F.max(period).alias(period))), period, "left_semi")


def first_seen(sources: Sequence[DataFrame], keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """Of all sources, the row of the first one that has a key; rows with a blank key all stay. source_no says which."""
    rows = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), [t.withColumn("source_no", F.lit(i)) for i, t in enumerate(sources)])
    return keep_first(rows, keys, [F.col("source_no"), *order], keep_blank=True)


def extremes(df: DataFrame, column: str, n: int, largest: bool = False, tie: str | None = None) -> DataFrame:
    """The n smallest or largest rows, nulls never: each task keeps n, so nothing else is sorted."""
    c = F.col(column)
    return df.where(c.isNotNull()).orderBy(c.desc() if largest else c.asc(), *([tie] if tie else [])).limit(n)


def sorted_last(df: DataFrame, columns: Sequence[tuple[str, bool]]) -> DataFrame:
    """A full sort by range, (column, ascending) each, nulls last whichever way."""
    return df.orderBy(*[F.col(c).asc_nulls_last() if up else F.col(c).desc_nulls_last() for c, up in columns])


def best_candidates(df: DataFrame, keys: Sequence[str], score: str, tie: str, k: int, least: float = 0.0) -> DataFrame:
    """The k best of each group among those that score above `least`, with rank."""
    w = Window.partitionBy(*keys).orderBy(F.desc(score), tie)
    return df.where(F.col(score) > least).withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


def best_address(df: DataFrame, key: str, urls: str, rules: Sequence[tuple[str, float]], excluded: Sequence[str], least: float) -> DataFrame:
    """The best-scoring address of each row's array, of equals the first by text; those on listed domains, or below them, never."""
    each = df.select(key, F.explode(F.array_distinct(urls)).alias("url")).withColumn("_host", F.lower(F.regexp_extract("url", r"^[a-z]+://([^/:?#]+)", 1)))
    listed = F.lit(False)
    for domain in excluded:
        listed = listed | (F.col("_host") == domain) | F.col("_host").endswith("." + domain)
    scored = each.where(~listed).withColumn("score", pattern_score(F.col("url"), rules)).where(F.col("score") >= least)
    return scored.groupBy(key).agg(F.min(F.struct((-F.col("score")).alias("s"), "url")).alias("m")).select(key, "m.url", (-F.col("m.s")).alias("score"))


def modal(df: DataFrame, column: str) -> DataFrame:
    """Rows with the most frequent value, of equals the smallest."""
    top = df.groupBy(column).count().orderBy(F.desc("count"), column).limit(1).select(column)
    return df.join(F.broadcast(top), column, "left_semi")


def top_entries(m: Column, k: int) -> Column:
    """The k entries of a map with the largest absolute values, ties by key."""
    order = lambda a, b: F.when(F.abs(a["value"]) > F.abs(b["value"]), -1).when(F.abs(a["value"]) < F.abs(b["value"]), 1).when(a["key"] < b["key"], -1).otherwise(1)
    return F.slice(F.array_sort(F.map_entries(m), order), 1, k)
