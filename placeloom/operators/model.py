"""Ridge regression from one pass of sufficient statistics."""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


#: Values of a column that the driver looks through at once, and ranges into which one pass cuts a column.
FEW, RANGES = 10_000, 1024


def exact_medians(rows: DataFrame, columns: Sequence[str]) -> dict[str, float | None]:
    """The median of each column as SQL gives it, null where a column has no value; NaN and infinities count as numbers do in order.

    Each pass counts the values of all columns by ranges and goes on in the range that holds the middle one, until that
    has FEW values or one distinct value: some three passes, whatever the number of rows, and no task or driver sees a whole column.
    """
    cast = rows.select(*[F.col(c).cast("double").alias(f"c{i}") for i, c in enumerate(columns)])
    first = cast.agg(*[f(f"c{i}").alias(f"{n}{i}") for i in range(len(columns)) for n, f in (("n", F.count), ("a", F.min), ("b", F.max))]).first()
    # (column, rank from 0): the range it lies in, how many values it has and how many come before it
    found: dict[tuple[int, int], float] = {}
    open_: dict[tuple[int, int], tuple[float, float, int, int]] = {}
    for i in range(len(columns)):
        if n := first[f"n{i}"]:
            for rank in {(n - 1) // 2, n // 2}:
                open_[i, rank] = first[f"a{i}"], first[f"b{i}"], n, 0
    while open_:
        for at, (lo, hi, n, before) in list(open_.items()):
            if lo == hi or n <= FEW:
                c = F.col(f"c{at[0]}")
                found[at] = lo if lo == hi else sorted(r[0] for r in cast.where((c >= lo) & (c <= hi)).select(c).collect())[at[1] - before]
                del open_[at]
        if not open_:
            break
        asks = sorted(set((i, lo, hi) for (i, _), (lo, hi, _, _) in open_.items()))
        number = lambda i, lo, hi: F.floor((F.col(f"c{i}") / 2 - lo / 2) / (hi / 2 - lo / 2) * RANGES)
        each = F.array(*[F.when((F.col(f"c{i}") >= lo) & (F.col(f"c{i}") <= hi), F.struct(F.lit(j).alias("j"), F.least(F.coalesce(number(i, lo, hi), F.lit(RANGES - 1)), F.lit(RANGES - 1)).alias("r"), F.col(f"c{i}").alias("v"))) for j, (i, lo, hi) in enumerate(asks)])
        counts = cast.select(F.explode(F.filter(each, lambda x: x.isNotNull())).alias("x")).groupBy("x.j", "x.r").agg(F.count(F.lit(1)).alias("n"), F.min("x.v").alias("lo"), F.max("x.v").alias("hi")).collect()
        by_ask: dict[int, list] = {}
        for r in sorted(counts, key=lambda r: (r.j, r.lo)):
            by_ask.setdefault(r.j, []).append(r)
        for at, (lo, hi, _, before) in list(open_.items()):
            for r in by_ask[asks.index((at[0], lo, hi))]:
                if at[1] < before + r.n:
                    open_[at] = r.lo, r.hi, r.n, before
                    break
                before += r.n
    return {c: (found[i, (n - 1) // 2] + found[i, n // 2]) / 2 if (n := first[f"n{i}"]) else None for i, c in enumerate(columns)}


def standardised(df: DataFrame, features: Sequence[str], least: int = 5, reference: Column | None = None) -> tuple[DataFrame, list[str]]:
    """Features with at least `least` values and some spread: gaps get the median, then z-scores within 10.

    What holds for all is worked out over the reference rows (all, unless a condition is given). The median is the exact
    one, and only looked for where a feature has gaps.
    """
    rows = df if reference is None else df.where(reference)
    s = rows.agg(*[f(F.col(c)).alias(f"{n}_{c}") for c in features for n, f in (("n", F.count), ("m", F.avg), ("s", F.stddev_pop))]).first()
    used = [c for c in features if s[f"n_{c}"] >= least and (s[f"s_{c}"] or 0) >= 1e-9]
    gaps = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in used]).first() if used else {}
    middle = exact_medians(rows, open_) if (open_ := [c for c in used if gaps[c]]) else {}
    z = {c: F.greatest(F.least((F.coalesce(F.col(c), F.lit(middle.get(c))) - s[f"m_{c}"]) / s[f"s_{c}"], F.lit(10.0)), F.lit(-10.0)) for c in used}
    return df.withColumns(z), used


#: Features in a block of the matrix of sums, and parts into which the tasks' sums of one block are dealt first.
BLOCK, PARTS = 64, 32


def _added(d: pd.DataFrame) -> pd.DataFrame:
    return pd.DataFrame({**{c: d[c].iloc[:1] for c in d.columns if c != "g"}, "g": [np.sum(np.stack(d["g"]), axis=0)]})


def gram(df: DataFrame, features: Sequence[str], label: str, fold: Column | None = None) -> dict[int, np.ndarray]:
    """For each fold the sums of products of (1, features, label), gaps as 0.

    A task holds the sums of one fold at a time, p x p doubles, as its rows are in order of fold, and gives them out as
    blocks of BLOCK x BLOCK. The tasks' blocks are added by parts and then as a whole, so no row is as wide as the matrix and
    no task gets more than a part of the blocks of one place. The driver gets p x p doubles for each fold.
    """
    names = ["_one", *features, label]
    p = len(names)
    starts = range(0, p, BLOCK)
    rows = df.where(F.col(label).isNotNull()).withColumn("_one", F.lit(1.0)).withColumn("_fold", F.lit(0) if fold is None else fold)
    value = F.array(*[F.coalesce(F.col(c).cast("double"), F.lit(0.0)) for c in names])

    def blocks(fold: int, g: np.ndarray, part: int) -> pd.DataFrame:
        places = [(i, j) for i in starts for j in starts if i <= j]
        return pd.DataFrame({"f": fold, "i": [x for x, _ in places], "j": [x for _, x in places], "part": part, "g": [g[i : i + BLOCK, j : j + BLOCK].ravel() for i, j in places]})

    def sums(batches):
        at, total, part = None, None, 0
        for b in batches:
            for f, d in b.groupby("f", sort=True):
                if f != at:
                    if total is not None:
                        yield blocks(at, total, part)
                    at, total = f, np.zeros((p, p))
                x = np.stack(d["x"])
                total += x.T @ x
                part = int(d["part"].iloc[0])
        if total is not None:
            yield blocks(at, total, part)

    cast = rows.select(F.col("_fold").cast("long").alias("f"), F.pmod(F.spark_partition_id(), F.lit(PARTS)).alias("part"), value.alias("x")).sortWithinPartitions("f")
    schema = "f long, i int, j int, part int, g array<double>"
    each = cast.mapInPandas(sums, schema).groupBy("f", "i", "j", "part").applyInPandas(_added, schema)
    found: dict[int, np.ndarray] = {}
    for r in each.groupBy("f", "i", "j").applyInPandas(_added, schema).collect():
        g = found.setdefault(int(r.f), np.zeros((p, p)))
        block = np.array(r.g).reshape(min(BLOCK, p - r.i), min(BLOCK, p - r.j))
        g[r.i : r.i + BLOCK, r.j : r.j + BLOCK] = block
        g[r.j : r.j + BLOCK, r.i : r.i + BLOCK] = block.T
    return found


@dataclass
class Ridge:
    features: list[str]
    coefficients: np.ndarray
    intercept: float
    r2: float
    rmse: float
    n: int
    inverse: np.ndarray
    freedom: float
    means: np.ndarray

    def prediction(self) -> Column:
        return sum((F.col(f) * float(b) for f, b in zip(self.features, self.coefficients, strict=True)), F.lit(float(self.intercept)))

    def contributions(self) -> Column:
        return F.create_map(*[x for f, b in zip(self.features, self.coefficients, strict=True) for x in (F.lit(f), F.col(f) * float(b))])

    def half_width(self, z: float = 1.2816) -> Column:
        """Half of the prediction interval: z * sqrt(s2 * (1 + x' W x))."""
        x = F.array(*[F.col(f) - float(m) for f, m in zip(self.features, self.means, strict=True)])
        dot = lambda a, b: F.aggregate(F.zip_with(a, b, lambda p, q: p * q), F.lit(0.0), lambda s, v: s + v)
        rows = F.array(*[F.array(*[F.lit(float(v)) for v in row]) for row in self.inverse])
        quad = 1.0 + 1.0 / self.n + dot(x, F.transform(rows, lambda row: dot(row, x)))
        s2 = self.rmse**2 * self.n / max(1.0, self.n - self.freedom)
        return z * F.sqrt(F.greatest(quad, F.lit(0.0)) * float(s2))


def solve(g: np.ndarray, features: Sequence[str], alpha: float = 50.0) -> Ridge:
    """Centred ridge with a free intercept."""
    n, p = g[0, 0], len(features)
    mean, my = g[0, 1 : p + 1] / n, g[0, p + 1] / n
    xx, xy = g[1 : p + 1, 1 : p + 1] - n * np.outer(mean, mean), g[1 : p + 1, p + 1] - n * mean * my
    yy = g[p + 1, p + 1] - n * my * my
    inverse = np.linalg.inv(xx + alpha * np.eye(p))
    b = inverse @ xy
    rss = yy - 2 * b @ xy + b @ xx @ b
    return Ridge([*features], b, my - b @ mean, 1 - rss / yy if yy else 0.0, float(np.sqrt(max(rss, 0) / n)), int(n), inverse, float(np.trace(inverse @ xx)) + 1, mean)


def cross_validated(df: DataFrame, features: Sequence[str], label: str, key: str, k: int = 5, alpha: float = 50.0, fold: Column | None = None) -> list[tuple[int, float, float, float]]:
    """(fold, R2, RMSE, MAE): what trains on the others is the total of the folds' sums less the fold.

    R2 and RMSE follow from the sums alone; MAE takes one pass more, with the folds' k models at hand. With fewer than k
    rows each is a fold of its own; a fold given as a column is taken instead.
    """
    if fold is None:
        few = df.where(F.col(label).isNotNull()).limit(k).count() < k
        fold = F.dense_rank().over(Window.orderBy(key)) if few else F.pmod(F.xxhash64(key), F.lit(k))
    rows = df.where(F.col(label).isNotNull()).withColumn("_k", fold)
    grams = gram(rows, features, label, F.col("_k"))
    total, out, p, models = sum(grams.values()), [], len(features), {}
    for f, g in sorted(grams.items()):
        m = solve(total - g, features, alpha)
        w = np.concatenate([[m.intercept], m.coefficients, [-1.0]])
        rss, n = float(w @ g @ w), g[0, 0]
        tss = g[p + 1, p + 1] - g[0, p + 1] ** 2 / n
        out.append((f, float(1 - rss / tss) if tss > 0 else 0.0, float(np.sqrt(max(rss, 0) / n))))
        models[f] = F.array(*[F.lit(float(x)) for x in w[:-1]])
    if not out:
        return []
    x = F.array(F.lit(1.0), *[F.coalesce(F.col(c).cast("double"), F.lit(0.0)) for c in features])
    weights = F.element_at(F.create_map(*[y for f, m in models.items() for y in (F.lit(f).cast("long"), m)]), F.col("_k").cast("long"))
    prediction = F.aggregate(F.zip_with(x, weights, lambda a, b: a * b), F.lit(0.0), lambda s, v: s + v)
    mae = {r["_k"]: r.mae for r in rows.groupBy("_k").agg(F.avg(F.abs(F.col(label).cast("double") - prediction)).alias("mae")).collect()}
    return [(f, r2, rmse, float(mae[f])) for f, r2, rmse in out]


def importance(m: Ridge, g: np.ndarray) -> list[tuple[str, float]]:
    n, p = g[0, 0], len(m.features)
    sd = np.sqrt(np.maximum(np.diag(g)[1:] / n - (g[0, 1:] / n) ** 2, 0))
    return sorted(((f, float(b * s / sd[p])) for f, b, s in zip(m.features, m.coefficients, sd[:p], strict=True)), key=lambda x: (-abs(x[1]), x[0]))


def rebased(df: DataFrame, targets: DataFrame, by: Sequence[str], prediction: str = "prediction") -> DataFrame:
    """Predictions shifted so that each group's mean is its official value; groups without one stay."""
    shift = df.groupBy(*by).agg(F.avg(prediction).alias("_mean")).join(targets, list(by)).select(*by, (F.col("official") - F.col("_mean")).alias("shift"))
    return df.join(shift, list(by), "left").fillna(0.0, ["shift"]).withColumn("rebased", F.col(prediction) + F.col("shift"))


def impute(df: DataFrame, target: str, features: Sequence[str], least: int = 20, r2: float = 0.10, low: float = 1.0, high: float = 5.0) -> DataFrame:
    """Gaps of target from least squares over the complete rows, if these are enough and explain enough."""
    whole = df.dropna(subset=[target, *features])
    g = gram(whole, features, target)
    if not g or g[0][0, 0] < least or (m := solve(g[0], features, 1e-9)).r2 < r2:
        return df
    return df.withColumn(target, F.coalesce(F.col(target), F.greatest(F.least(m.prediction(), F.lit(high)), F.lit(low))))


def feature_rows(tables: dict[str, tuple[DataFrame, str, dict[str, Column]]], dimensions: Sequence[str]) -> DataFrame:
    """id, source and one double for each dimension, null where a source has none: (table, key, {dimension: column}) for each source."""
    out = None
    for source, (t, key, columns) in tables.items():
        rows = t.select(F.concat_ws("_", F.lit(source), F.trim(F.col(key).cast("string"))).alias("id"), F.lit(source).alias("source"), *[columns.get(d, F.lit(None)).cast("double").alias(d) for d in dimensions])
        out = rows if out is None else out.unionByName(rows)
    return out


def confidence(features: Sequence[str]) -> Column:
    """1 for a row at the means, 0 from a mean distance of five deviations on."""
    far = sum((F.abs(F.coalesce(F.col(f), F.lit(0.0))) for f in features), F.lit(0.0)) / len(features)
    return F.greatest(F.lit(0.0), F.least(F.lit(1.0), 1 - far / 5))


def partial_r2(g: np.ndarray, features: Sequence[str], alpha: float = 50.0) -> list[tuple[str, float, float]]:
    """(feature, R2 lost without it, approximate p-value) from the sums alone: each refit takes a part of the matrix."""
    whole = solve(g, features, alpha)
    n, p = g[0, 0], len(features)
    s2 = whole.rmse**2 * n / max(1.0, n - whole.freedom)
    mean = g[0, 1 : p + 1] / n
    xx = g[1 : p + 1, 1 : p + 1] - n * np.outer(mean, mean)
    spread = np.sqrt(np.maximum(np.diag(whole.inverse @ xx @ whole.inverse) * s2, 1e-300))
    out = []
    for j, f in enumerate(features):
        rest = [0, *(1 + i for i in range(p) if i != j), p + 1]
        without = solve(g[np.ix_(rest, rest)], [x for x in features if x != f], alpha)
        out.append((f, float(whole.r2 - without.r2), math.erfc(abs(whole.coefficients[j]) / spread[j] / math.sqrt(2))))
    return out


def fit_figures(df: DataFrame, label: str, prediction: str, n_features: int) -> DataFrame:
    """n, r2, adjusted_r2, rmse, mae of predictions over the labelled rows, in one pass."""
    y, e = F.col(label).cast("double"), F.col(label).cast("double") - F.col(prediction)
    sums = df.where(F.col(label).isNotNull()).agg(F.count(F.lit(1)).alias("n"), F.sum(e * e).alias("rss"), (F.var_pop(y) * F.count(F.lit(1))).alias("tss"), F.avg(F.abs(e)).alias("mae"))
    r2 = F.when(F.col("tss") > 0, 1 - F.col("rss") / F.col("tss")).otherwise(0.0)
    free = F.col("n") - n_features - 1
    return sums.select("n", r2.alias("r2"), F.when(free > 0, 1 - (1 - r2) * (F.col("n") - 1) / free).alias("adjusted_r2"), F.sqrt(F.col("rss") / F.col("n")).alias("rmse"), "mae")


def is_reliable(folds: Sequence[tuple]) -> bool:
    """Whether the folds' R2 is above 0.3 on average and deviates by less than 0.3."""
    r2 = np.array([f[1] for f in folds])
    return bool(len(r2) and r2.mean() > 0.3 and r2.std() < 0.3)


def official_shift(df: DataFrame, targets: DataFrame, trained: DataFrame, prediction: str = "prediction", city: str = "city", kind: str = "type") -> DataFrame:
    """df with shift and rebased: each city's official value less its mean prediction.

    targets(city, type or null, official): where a city has values by type, each type is shifted to its own, else the
    city as a whole. Cities in trained(city) are not shifted, nor are those without a value.
    """
    typed = targets.where(F.col(kind).isNotNull()).groupBy(city, kind).agg(F.max("official").alias("_typed"))
    whole = targets.where(F.col(kind).isNull()).groupBy(city).agg(F.max("official").alias("_whole"))
    has = targets.groupBy(city).agg(F.max(F.col(kind).isNotNull()).alias("_by_type"))
    means = df.groupBy(city, kind).agg(F.sum(prediction).alias("s"), F.count(prediction).alias("n"))
    of_city = means.groupBy(city).agg((F.sum("s") / F.sum("n")).alias("_city_mean"))
    table = means.select(city, kind, (F.col("s") / F.col("n")).alias("_mean")).join(of_city, city).join(has, city, "left").join(typed, [city, kind], "left").join(whole, city, "left")
    table = table.join(trained.select(city, F.lit(True).alias("_trained")).distinct(), city, "left")
    shift = F.when(F.col("_trained"), 0.0).when(F.col("_by_type"), F.col("_typed") - F.col("_mean")).otherwise(F.col("_whole") - F.col("_city_mean"))
    table = table.select(city, kind, F.coalesce(shift, F.lit(0.0)).alias("shift"))
    return df.join(table, [city, kind], "left").withColumn("rebased", F.col(prediction) + F.col("shift"))


def back_test(df: DataFrame, actual: str, columns: Sequence[str], half_width: str | None = None) -> DataFrame:
    """measure, n, mae, bias of each column where the actual value is known, and the intervals' mean width."""
    known = df.where(F.col(actual).isNotNull())
    cells = known.agg(F.count(F.lit(1)).alias("n"), *[f.alias(f"{k}_{c}") for c in columns for k, f in (("m", F.avg(F.abs(F.col(c) - F.col(actual)))), ("b", F.avg(F.col(c) - F.col(actual))))], (F.avg(F.col(half_width) * 2) if half_width else F.lit(None).cast("double")).alias("width"))
    rows = F.array(*[F.struct(F.lit(c).alias("measure"), F.col("n"), F.col(f"m_{c}").alias("mae"), F.col(f"b_{c}").alias("bias"), F.col("width")) for c in columns])
    return cells.select(F.explode(rows).alias("x")).select("x.*")


def fold_correlations(df: DataFrame, vector: str, label: str, key: str, k: int = 5) -> DataFrame:
    """fold, dim, r: the correlation of each dimension with the label over all rows but those of the fold.

    One pass gives the sums of each fold and dimension; those of the others are the total less these.
    """
    each = df.where(F.col(label).isNotNull()).select(F.pmod(F.xxhash64(key), F.lit(k)).cast("int").alias("fold"), F.posexplode(vector).alias("dim", "x"), F.col(label).cast("double").alias("y"))
    x, y = F.col("x").cast("double"), F.col("y")
    parts = {"n": F.count(F.lit(1)), "x": F.sum(x), "y": F.sum(y), "xx": F.sum(x * x), "yy": F.sum(y * y), "xy": F.sum(x * y)}
    sums = each.groupBy("fold", "dim").agg(*[f.alias(f"s_{c}") for c, f in parts.items()])
    by = Window.partitionBy("dim")
    rest = sums.select("fold", "dim", *[(F.sum(f"s_{c}").over(by) - F.col(f"s_{c}")).cast("double").alias(c) for c in parts])
    n, a, b = F.col("n"), F.col("x"), F.col("y")
    r = F.try_divide(n * F.col("xy") - a * b, F.sqrt(F.greatest((n * F.col("xx") - a * a) * (n * F.col("yy") - b * b), F.lit(0.0))))
    return rest.select("fold", "dim", r.alias("r"))


def selected_dimensions(correlations: DataFrame, n: int) -> DataFrame:
    """fold, dim, r of the n dimensions that correlate most in each fold, ties by number."""
    w = Window.partitionBy("fold").orderBy(F.abs("r").desc_nulls_last(), "dim")
    return correlations.withColumn("_n", F.row_number().over(w)).where(F.col("_n") <= n).drop("_n")


def stable_dimensions(selected: DataFrame, least: int = 2) -> DataFrame:
    """dim, n_folds, mean_abs_r of dimensions selected in at least so many folds."""
    return selected.groupBy("dim").agg(F.count(F.lit(1)).alias("n_folds"), F.avg(F.abs("r")).alias("mean_abs_r")).where(F.col("n_folds") >= least)


def cross_validated_selection(df: DataFrame, vector: str, label: str, key: str, n: int, k: int = 5, alpha: float = 50.0) -> list[tuple[int, list[int], float, float]]:
    """(fold, dimensions, R2, RMSE): in each fold the n dimensions are chosen, and the model fitted, without that fold.

    Two passes: the correlations by fold, then the sums of products of all dimensions that any fold chose.
    """
    chosen: dict[int, list[int]] = {}
    for r in selected_dimensions(fold_correlations(df, vector, label, key, k), n).select("fold", "dim").collect():
        chosen.setdefault(r["fold"], []).append(r["dim"])
    dims = sorted({d for ds in chosen.values() for d in ds})
    rows = df.select(key, label, *[F.get(vector, F.lit(d)).cast("double").alias(f"d{d}") for d in dims])
    grams = gram(rows, [f"d{d}" for d in dims], label, F.pmod(F.xxhash64(key), F.lit(k)))
    total, out = sum(grams.values()), []
    for fold, g in sorted(grams.items()):
        mine = sorted(chosen[fold])
        at = [0, *(1 + dims.index(d) for d in mine), len(dims) + 1]
        m = solve((total - g)[np.ix_(at, at)], [f"d{d}" for d in mine], alpha)
        test, w = g[np.ix_(at, at)], np.concatenate([[m.intercept], m.coefficients, [-1.0]])
        rss, count = float(w @ test @ w), test[0, 0]
        tss = test[-1, -1] - test[0, -1] ** 2 / count
        out.append((fold, mine, float(1 - rss / tss) if tss > 0 else 0.0, float(np.sqrt(max(rss, 0) / count))))
    return out
