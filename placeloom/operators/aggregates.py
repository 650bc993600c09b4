"""Aggregates by key, area and year, and what is derived from them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from placeloom.functions.scores import bands, rate


def means_with_override(first: DataFrame, second: DataFrame, key: str, measures: Sequence[str], override: str) -> DataFrame:
    """Means of several measures for each key; where the second source has the key, its mean of `override` counts."""
    a = first.groupBy(key).agg(*[F.avg(m).alias(m) for m in measures])
    b = second.groupBy(key).agg(F.avg(override).alias("_override"))
    joined = a.join(b, key, "full")
    return joined.select(key, *[F.coalesce("_override", m).alias(m) if m == override else F.col(m) for m in measures])


def summed(df: DataFrame, key: str, columns: Sequence[str], total: str = "total") -> DataFrame:
    """Sums of many columns for each key, 0 where all are null, and the sum across them."""
    sums = df.groupBy(key).agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in columns])
    return sums.withColumn(total, sum((F.col(c) for c in columns[1:]), F.col(columns[0])))


def sorted_lists(df: DataFrame, keys: Sequence[str], column: str, sep: str = ",") -> DataFrame:
    """The distinct values of each key, sorted and joined."""
    return df.groupBy(*keys).agg(F.array_join(F.array_sort(F.collect_set(column)), sep).alias(column))


def by_priority(df: DataFrame, keys: Sequence[str], column: str, order: Sequence[str]) -> DataFrame:
    """Of each key's values the one that comes first in order; others come last, the smallest of them first."""
    place = F.coalesce(F.nullif(F.array_position(F.array(*map(F.lit, order)), F.col(column)), F.lit(0)), F.lit(len(order) + 1))
    return df.where(F.col(column).isNotNull()).groupBy(*keys).agg(F.min(F.struct(place.alias("p"), F.col(column).alias("v"))).alias("m")).select(*keys, F.col("m.v").alias(column))


def tally(df: DataFrame, key: str, items: str, sums: dict[str, Sequence[str]]) -> DataFrame:
    """For each row of key how often each named group of categories is in its array, and the number of items."""
    inside = lambda names: F.size(F.filter(items, lambda x: x.isin(*names)))
    whole = F.when(F.col(items).isNull(), 0).otherwise(F.size(items))
    return df.select(key, whole.alias("n_items"), *[F.when(F.col(items).isNull(), 0).otherwise(inside(names)).alias(name) for name, names in sums.items()])


def wide(df: DataFrame, keys: Sequence[str], column: str, value: str, names: Sequence[str], order: str | None = None) -> DataFrame:
    """Long to wide: for each key and name its first value by order (else its smallest), null where there is none."""
    first = lambda n: F.min(F.when(F.col(column) == n, F.struct(F.col(order or value).alias("o"), F.col(value).alias("v"))))["v"]
    return df.groupBy(*keys).agg(*[first(n).alias(str(n)) for n in names])


def newest_filled(df: DataFrame, columns: Sequence[str], more_than: int = 5) -> DataFrame:
    """newest: the name of the last of the columns that has more than so many values, null if none has."""
    counts = df.agg(*[F.count(c).alias(c) for c in columns])
    return counts.select(F.coalesce(*[F.when(F.col(c) > more_than, F.lit(c)) for c in reversed(columns)], F.lit(None).cast("string")).alias("newest"))


def latest_totals(df: DataFrame, regions: DataFrame, region: str, year: str, count: str, cleared: str, population: str) -> DataFrame:
    """Totals of each region in the latest year of all, per 100,000 people, and how many per cent were cleared."""
    last = df.join(F.broadcast(df.agg(F.max(year).alias(year))), year, "left_semi")
    sums = last.groupBy(region).agg(F.sum(count).alias("total"), F.sum(cleared).alias("_cleared"))
    joined = sums.join(regions.select(region, population), region, "left")
    return joined.select(region, "total", rate(F.col("total"), F.col(population), 100_000).alias("rate"), rate(F.col("_cleared"), F.col("total"), 100).alias("cleared_pct"))


def of_maximum(df: DataFrame, column: str, out: str, scale: float = 10.0) -> DataFrame:
    """column as a share of its maximum in the table, from 0 to scale; null without a maximum above 0."""
    return df.crossJoin(F.broadcast(df.agg(F.max(column).alias("_most")))).withColumn(out, F.when(F.col("_most") > 0, F.col(column) / F.col("_most") * scale)).drop("_most")


def inverted_range(df: DataFrame, column: str, out: str, uppers: Sequence[tuple[float, str]], above: str) -> DataFrame:
    """100 at the column's minimum, 0 at its maximum, 50 where all are equal; and a band of that score."""
    low, high, x = F.col("_low"), F.col("_high"), F.col(column)
    score = F.when(x.isNull(), None).when(high == low, 50.0).otherwise((high - x) / (high - low) * 100)
    both = df.crossJoin(F.broadcast(df.agg(F.min(column).alias("_low"), F.max(column).alias("_high"))))
    return both.withColumn(out, score).withColumn(f"{out}_band", bands(F.col(out), uppers, above)).drop("_low", "_high")


def z_scores(df: DataFrame, columns: Sequence[str], cuts: Sequence[tuple[float, str]], above: str, least: int = 5) -> DataFrame:
    """metric, z and band: z-scores of the first of the columns that has at least so many values, bands by z."""
    stats = df.agg(*[f(c).alias(f"_{n}_{c}") for c in columns for n, f in (("n", F.count), ("m", F.avg), ("s", F.stddev_samp))])
    joined = df.crossJoin(F.broadcast(stats))
    choose = lambda f: F.coalesce(*[F.when(F.col(f"_n_{c}") >= least, f(c)) for c in columns])
    metric = F.coalesce(*[F.when(F.col(f"_n_{c}") >= least, F.lit(c)) for c in columns], F.lit(None).cast("string"))
    out = joined.withColumn("metric", metric).withColumn("z", F.try_divide(choose(lambda c: F.col(c) - F.col(f"_m_{c}")), choose(lambda c: F.col(f"_s_{c}"))))
    return out.withColumn("band", bands(F.col("z"), cuts, above, right_closed=False)).drop(*stats.columns)


def averages(df: DataFrame, area: str, columns: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """Means by area, and over all, of the same columns: what a cascade falls back to."""
    means = [F.avg(c).alias(c) for c in columns]
    return df.groupBy(area).agg(*means), df.agg(*means)


def summary(df: DataFrame, keys: Sequence[str], **named: Column) -> DataFrame:
    """One row for each combination of keys: n, and the named aggregates."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), *[c.alias(k) for k, c in named.items()])


def cross_tab(df: DataFrame, rows: str, columns: str, names: Sequence[str]) -> DataFrame:
    return df.groupBy(rows).agg(*[F.count_if(F.col(columns) == n).alias(n) for n in names])


def manifest(df: DataFrame, groups: Sequence[str]) -> DataFrame:
    """kind, name, n: rows by each of the groups, and non-null values of every column, in one pass over the table each."""
    filled = df.agg(*[F.count(c).alias(c) for c in df.columns])
    cells = F.array(*[F.struct(F.lit("filled").alias("kind"), F.lit(c).alias("name"), F.col(c).alias("n")) for c in df.columns])
    out = filled.select(F.explode(cells).alias("x")).select("x.*")
    for g in groups:
        out = out.union(df.groupBy(g).agg(F.count(F.lit(1)).alias("n")).select(F.lit(g), F.coalesce(F.col(g).cast("string"), F.lit("")), "n"))
    return out
