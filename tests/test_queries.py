"""Every query with SQL against DuckDB, and the shape of the joins' plans."""

import duckdb
import numpy as np
import pytest

from placeloom.queries import QUERIES, SQL
from placeloom.plans.sites import events, sites
from placeloom.operators import conform, joins, model, ranks, vectors
from placeloom.operators.spatial import nearest_uncapped, radius_join

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def norm(rows):
    out = []
    for r in rows:
        out.append(tuple("" if v is None else f"{float(v):.6g}" if isinstance(v, (int, float)) and not isinstance(v, bool) else str(v) for v in r))
    return sorted(out)


@pytest.fixture(scope="module")
def con(sf):
    c = duckdb.connect()
    for t in TABLES:
        c.sql(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    return c


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, sf, con, name):
    got = QUERIES[name](spark, sf)
    cols = sorted(got.columns)
    rows = got.select(*cols).collect()
    if name in SQL:
        want = con.sql(SQL[name])
        assert sorted(want.columns) == cols
        assert norm(rows) == norm(want.select(*[f'"{c}"' for c in cols]).fetchall())


def test_radius_joins_are_equi_joins(spark, sf):
    plan = radius_join(sites(spark, sf), events(spark, sf), 1000)._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan


def test_ranks_have_no_window_over_all_rows(spark, sf):
    """Only one row of each range meets in one task."""
    plan = ranks.ranked(sites(spark, sf), "lat")._jdf.queryExecution().executedPlan().toString()
    # bounds, starts and their total come together in one task: one row a range; values are dealt by range
    assert plan.count("SinglePartition") <= 3
    assert "hashpartitioning(_range" in plan


def test_ridge_equals_numpy(spark, sf):
    """Sums by blocks, solution, intervals and folds against the closed form in one process."""
    rows = spark.read.parquet(f"{sf}/lineitem.parquet").selectExpr("l_quantity x", "l_discount * 100 z", "l_extendedprice y", "l_orderkey * 10 + l_linenumber k")
    df = rows.toPandas()
    x = df[["x", "z"]].to_numpy(float)
    y = df["y"].to_numpy(float)
    g = model.gram(rows, ["x", "z"], "y")[0]
    m = model.solve(g, ["x", "z"])
    c = x - x.mean(axis=0)
    b = np.linalg.solve(c.T @ c + 50 * np.eye(2), c.T @ (y - y.mean()))
    assert np.allclose(m.coefficients, b) and np.isclose(m.intercept, y.mean() - b @ x.mean(axis=0))
    inverse = np.linalg.inv(c.T @ c + 50 * np.eye(2))
    s2 = ((y - y.mean() - c @ b) ** 2).sum() / (len(y) - np.trace(inverse @ c.T @ c) - 1)
    got = rows.select("x", "z", m.half_width().alias("w")).toPandas()
    d = got[["x", "z"]].to_numpy(float) - x.mean(axis=0)
    assert np.allclose(got["w"], 1.2816 * np.sqrt(s2 * (1 + 1 / len(y) + np.einsum("ij,jk,ik->i", d, inverse, d))))
    lost = dict((f, r) for f, r, _ in model.partial_r2(g, ["x", "z"]))
    without = model.solve(model.gram(rows, ["x"], "y")[0], ["x"])
    assert np.isclose(lost["z"], m.r2 - without.r2)
    few = spark.createDataFrame(df.head(4).assign(k=range(4)))
    assert len(model.cross_validated(few, ["x"], "y", "k")) == few.count()


def test_fold_correlations_leave_the_fold_out(spark, sf):
    e = spark.read.parquet(f"{sf}/embeddings.parquet")
    got = {(r.fold, r.dim): r.r for r in model.fold_correlations(e, "embedding", "label", "vec_id").collect()}
    pdf = e.selectExpr("vec_id", "embedding", "label", "int(pmod(xxhash64(vec_id), 5)) fold").toPandas()
    for fold, dim in ((0, 0), (3, 17), (4, 63)):
        rest = pdf[pdf.fold != fold]
        assert np.isclose(got[fold, dim], np.corrcoef([v[dim] for v in rest.embedding], rest.label)[0, 1], atol=1e-6)


def test_constants_of_several_rows_fail(spark, sf):
    n = spark.read.parquet(f"{sf}/nation.parquet")
    with pytest.raises(Exception, match="more than one row"):
        joins.with_constants(n, n.select("n_name")).collect()


def test_strict_types(spark):
    df = spark.createDataFrame([("a",), ("b",), (None,)], "kind string")
    assert conform.strict(df.where("kind = 'a'"), "kind", ["a"]).count() == 1
    with pytest.raises(Exception, match="kind"):
        conform.strict(df, "kind", ["a", "b"]).collect()


def test_nearest_uncapped_finds_k_for_all(spark, sf):
    s = sites(spark, sf).limit(20)
    found = nearest_uncapped(s, events(spark, sf), 3, 200, "event_id")
    assert found.groupBy("site_id").count().where("count = 3").count() == 20


def test_cosine_works_in_slices_and_keeps_ties(spark, monkeypatch):
    """No product of a block with a block as a whole, blocks by the number of rows; equal rows go by id."""
    rows = [(i, [float(i % 7 + 1), float(i % 3), 1.0]) for i in range(100)]
    df = spark.createDataFrame(rows, "id long, embedding array<double>")
    monkeypatch.setattr(vectors, "BLOCK", 16)
    monkeypatch.setattr(vectors, "SLICE", 5)
    got = vectors.top_cosine(df, df, 3)
    v = {i: np.array(x) / np.linalg.norm(x) for i, x in rows}
    want = {(i, rank, j) for i in v for rank, j in enumerate(sorted((j for j in v if j != i), key=lambda j: (-round(float(v[i] @ v[j]), 9), j))[:3], 1)}
    assert {(r.id, r["rank"], r.neighbour) for r in got.collect()} == want
    assert "array(0, 1, 2, 3, 4, 5, 6)" in got._jdf.queryExecution().analyzed().toString()
