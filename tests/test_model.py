"""The model's parts against numpy, and streams batch by batch."""

import math
import random
import statistics

import numpy as np
import pytest
from pyspark.sql import functions as F

from placeloom.operators import model
from placeloom.streaming import rolling


@pytest.mark.parametrize("seed", range(3))
def test_exact_medians(spark, monkeypatch, seed):
    """Skewed, repeated, huge, negative and missing values, by several passes; even and odd numbers of them."""
    monkeypatch.setattr(model, "FEW", 5)
    monkeypatch.setattr(model, "RANGES", 7)
    rnd = random.Random(seed)
    n = 200 + seed
    columns = {"a": [rnd.gauss(0, 1) for _ in range(n)], "b": [float(rnd.randint(0, 3)) for _ in range(n)], "c": [rnd.choice([-1e300, 1e300, 1e-300, 0.0]) for _ in range(n)], "d": [None if rnd.random() < 0.5 else math.exp(rnd.gauss(0, 20)) for _ in range(n)], "e": [None] * n, "f": [7.0] * n}
    df = spark.createDataFrame(list(zip(*columns.values(), strict=True)), ", ".join(f"{c} double" for c in columns))
    got = model.exact_medians(df, list(columns))
    for c, values in columns.items():
        known = [v for v in values if v is not None]
        assert got[c] == (statistics.median(known) if known else None), c


def test_gram_of_many_features_equals_numpy(spark):
    """1,024 features in two folds: blocks of 64 x 64, a task holds one fold's 8 MB of sums at a time."""
    rng = np.random.default_rng(3)
    x = rng.normal(size=(60, 1024)).round(3)
    y = rng.normal(size=60)
    rows = spark.createDataFrame([(i, float(y[i]), x[i].tolist()) for i in range(60)], "k long, y double, v array<double>").repartition(3)
    names = [f"x{i}" for i in range(1024)]
    got = model.gram(rows.select("k", "y", *[F.col("v")[i].alias(n) for i, n in enumerate(names)]), names, "y", F.col("k") % 2)
    for f in (0, 1):
        m = np.column_stack([np.ones(30), x[f::2], y[f::2]])
        assert np.allclose(got[f], m.T @ m)


def folds_of(spark, e, k=5):
    return {r.vec_id: r.f for r in e.select("vec_id", F.pmod(F.xxhash64("vec_id"), F.lit(k)).alias("f")).collect()}


def test_selection_by_fold_equals_refits(spark, sf):
    """Dimensions chosen, and models fitted, without the fold: correlations, choice, ridge and errors by numpy."""
    e = spark.read.parquet(f"{sf}/embeddings.parquet")
    fold = folds_of(spark, e)
    rows = e.collect()
    x, y, f = np.array([r.embedding for r in rows], float), np.array([r.label for r in rows], float), np.array([fold[r.vec_id] for r in rows])
    chosen = {}
    for g, dims, r2, rmse in model.cross_validated_selection(e, "embedding", "label", "vec_id", 8):
        train, test = f != g, f == g
        r = np.array([np.corrcoef(x[train, d], y[train])[0, 1] for d in range(x.shape[1])])
        want = sorted(np.lexsort((np.arange(len(r)), -np.abs(r)))[:8].tolist())
        chosen[g] = {d: r[d] for d in want}
        assert dims == want
        xt, yt = x[train][:, want], y[train]
        c = xt - xt.mean(0)
        b = np.linalg.solve(c.T @ c + 50 * np.eye(8), c.T @ (yt - yt.mean()))
        error = y[test] - (yt.mean() + (x[test][:, want] - xt.mean(0)) @ b)
        assert np.isclose(rmse, np.sqrt((error**2).mean())) and np.isclose(r2, 1 - (error**2).sum() / ((y[test] - y[test].mean()) ** 2).sum())
    got = {r.dim: (r.n_folds, r.mean_abs_r) for r in model.stable_dimensions(model.selected_dimensions(model.fold_correlations(e, "embedding", "label", "vec_id"), 8)).collect()}
    counts = {d: [abs(c[d]) for c in chosen.values() if d in c] for d in {d for c in chosen.values() for d in c}}
    assert got.keys() == {d for d, v in counts.items() if len(v) >= 2}
    for d, (n, mean) in got.items():
        assert n == len(counts[d]) and np.isclose(mean, np.mean(counts[d]))


def test_partial_r2_and_p_values_equal_refits(spark):
    rng = np.random.default_rng(4)
    x = rng.normal(size=(300, 3))
    y = x @ [1.0, 0.1, 0.0] + rng.normal(size=300)
    df = spark.createDataFrame([(*map(float, v), float(z)) for v, z in zip(x, y, strict=True)], "a double, b double, c double, y double")
    names = ["a", "b", "c"]
    c, z = x - x.mean(0), y - y.mean()
    w = np.linalg.inv(c.T @ c + 50 * np.eye(3))
    b = w @ c.T @ z
    s2 = ((z - c @ b) ** 2).sum() / (300 - np.trace(w @ c.T @ c) - 1)
    t = b / np.sqrt(np.diag(w @ c.T @ c @ w) * s2)
    for j, (name, lost, p) in enumerate(model.partial_r2(model.gram(df, names, "y")[0], names)):
        rest = [i for i in range(3) if i != j]
        d = c[:, rest]
        without = ((z - d @ np.linalg.solve(d.T @ d + 50 * np.eye(2), d.T @ z)) ** 2).sum()
        assert name == names[j] and np.isclose(lost, (without - ((z - c @ b) ** 2).sum()) / (z @ z)) and np.isclose(p, math.erfc(abs(t[j]) / math.sqrt(2)))


def test_folds_of_no_rows(spark):
    assert model.cross_validated(spark.createDataFrame([], "x double, y double, k long"), ["x"], "y", "k") == []


def test_late_rows_are_dropped_and_state_goes(spark, tmp_path):
    stamp = lambda day, hour: f"2024-01-{day:02d} {hour:02d}:30:00"
    for rows in ([(stamp(d, h), "a", 1.0) for d in range(1, 6) for h in range(24)], [(stamp(d, h), "a", 3.0) for d in range(6, 11) for h in range(24)], [(stamp(1, h), "a", 99.0) for h in range(24)]):
        spark.createDataFrame(rows, "ts string, k string, v double").select(F.col("ts").cast("timestamp").alias("ts"), "k", "v").coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
    stream = spark.readStream.schema("ts timestamp, k string, v double").option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/in")
    q = rolling.hourly_stream(rolling.hourly(stream, "ts", "k", "v"), f"{tmp_path}/out", f"{tmp_path}/c", once=True)
    q.awaitTermination()
    states = [p["stateOperators"][0] for p in q.recentProgress if p["stateOperators"]]
    assert sum(s["numRowsDroppedByWatermark"] for s in states) >= 24
    assert states[-1]["numRowsTotal"] <= 3
    got = spark.read.parquet(f"{tmp_path}/out")
    assert {r.mean_value for r in got.collect()} == {1.0, 3.0} and got.groupBy("hour").count().where("count > 1").isEmpty()
