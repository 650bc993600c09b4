"""Sums and nearest points over discs, against all pairs."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from placeloom.operators import discs, spatial
from placeloom.queries import QUERIES

PLACES = {"city": (52.5, 13.4, 0.03, 1000), "pole": (89.6, 0, None, 60_000), "date line": (1, 180, 0.8, 60_000), "globe": (0, 0, 60, 2e6), "yard": (10, 10, 1e-5, 0.5)}


def spread(rng, where, n):
    lat, lon, wide, _ = PLACES[where]
    return np.clip(lat + rng.uniform(-1, 1, n) * (wide or 0.4), -90, 90), (lon + rng.uniform(-1, 1, n) * (wide or 180) + 180) % 360 - 180


@pytest.mark.parametrize("where", PLACES)
def test_ground_equals_all_pairs(where):
    rng, r = np.random.default_rng(5), PLACES[where][3]
    s, p = spread(rng, where, 150), spread(rng, where, 3000)
    d = discs.metres(s[0][:, None], s[1][:, None], p[0], p[1])
    inside, v, c = d <= r, rng.uniform(0, 1, 3000), rng.integers(0, 9, 3000)
    v[7], v[8] = math.nan, math.inf
    ground = discs.Ground(s, p)
    n, total, whole = ground.sums(r, [v, c])
    assert (n == inside.sum(1)).all() and (whole == np.where(inside, c, 0).sum(1)).all()
    assert np.allclose(total.astype(float), np.where(inside, v, 0).sum(1), rtol=1e-12, equal_nan=True)
    for k in (1, 3, 40):
        i, j, m = ground.nearest(k, r)
        for x in range(150):
            want = np.sort(d[x][inside[x]])[:k]
            got = np.sort(m[i == x])
            assert np.array_equal(got[: len(want)], want) and np.array_equal(got, np.sort(d[x, j[i == x]]))


def test_sums_of_numbers_of_very_different_size():
    rng = np.random.default_rng(6)
    s, p = spread(rng, "city", 100), spread(rng, "city", 2000)
    v = np.full(2000, 1e-3)
    v[0] = 1e17
    inside = discs.metres(s[0][:, None], s[1][:, None], p[0], p[1]) <= 1000
    got = discs.Ground(s, p).sums(1000, [v])[1].astype(float)
    assert np.allclose(got, np.where(inside, v, 0).sum(1), rtol=1e-9)


def globe(spark, n, seed, *names):
    rng = np.random.default_rng(seed)
    rows = []
    for where in PLACES:
        lat, lon = spread(rng, where, n)
        rows += [(float(a), float(b)) for a, b in zip(lat, lon, strict=True)]
    rows += [(90.0, 5.0), (-90.0, 7.0), (52.5, 13.4), (52.5, 13.4), (52.5, 13.4), (None, 1.0)]
    return spark.createDataFrame([(i, *r, "abc"[i % 3] if i % 7 else None) for i, r in enumerate(rows)], f"{names[0]} long, {names[1]} double, {names[2]} double, kind string")


def test_parts_of_tiles_meet_once(spark, monkeypatch):
    """Tiles dealt into parts of few sites and points give the same as whole ones and as all pairs."""
    s, p = globe(spark, 40, 1, "site_id", "lat", "lon"), globe(spark, 200, 2, "point_id", "p_lat", "p_lon").withColumnRenamed("kind", "what")
    s = s.drop("kind").cache()
    a, b = s.where("lat is not null").collect(), p.where("p_lat is not null").collect()
    d = discs.metres(np.array([x.lat for x in a])[:, None], np.array([x.lon for x in a])[:, None], np.array([x.p_lat for x in b]), np.array([x.p_lon for x in b]))
    for few in (False, True):
        if few:
            monkeypatch.setattr(discs, "SITES", 9)
            monkeypatch.setattr(discs, "POINTS", 50)
        got = {r.site_id: r for r in spatial.radius_counts(s, p, 60_000, {"n_a": F.col("what") == "a"}).collect()}
        assert len(got) == s.count()
        for i, x in enumerate(a):
            near = [(m, y) for m, y in zip(d[i], b, strict=True) if m <= 60_000]
            r = got[x.site_id]
            assert (r.n, r.n_a) == (len(near), sum(y.what == "a" for _, y in near))
            assert r.nearest_m is None if not near else math.isclose(r.nearest_m, min(m for m, _ in near), rel_tol=1e-12)
        found = {}
        for r in spatial.nearest_k(s, p, 2, 60_000, "what", "point_id").collect():
            found.setdefault((r.site_id, r.what), {})[r["rank"]] = r.point_id
        want = {}
        for i, x in enumerate(a):
            for kind in (None, "a", "b", "c"):
                near = sorted((round(m, 6), y.point_id) for m, y in zip(d[i], b, strict=True) if m <= 60_000 and y.what == kind)[:2]
                if near:
                    want[x.site_id, kind] = {k + 1: y for k, (_, y) in enumerate(near)}
        assert found == want


def test_no_row_for_each_pair(spark):
    """Counts and nearest points go by discs: no join of sites with points."""
    s = spark.range(3).select(F.col("id").alias("site_id"), F.lit(1.0).alias("lat"), F.lit(2.0).alias("lon"))
    p = spark.range(3).select(F.col("id").alias("point_id"), F.lit(1.0).alias("p_lat"), F.lit(2.0).alias("p_lon"), F.lit("a").alias("kind"))
    for df in (spatial.radius_counts(s, p, 500, {}), spatial.nearest_k(s, p, 2, 500, "kind", "point_id")):
        assert "FlatMapCoGroupsInArrow" in df._jdf.queryExecution().executedPlan().toString()
    assert [(r["rank"], r.point_id) for r in spatial.nearest_k(s.limit(1), p, 2, 500, "kind", "point_id").collect()] == [(1, 0), (2, 1)]


@pytest.mark.parametrize("name", ["e05_stops_around", "e06_places_around", "a02_sensor_means", "a02_by_family", "e07_catchment", "m00_whole_build", "e03_accidents", "e03_site_safety", "e04_two_radii", "x02_access_by_density"])
def test_queries_go_by_discs(spark, sf, name):
    assert "FlatMapCoGroupsInArrow" in QUERIES[name](spark, sf)._jdf.queryExecution().executedPlan().toString()


def test_pairs_of_crowded_cells_are_dealt(spark, monkeypatch):
    """Pairs of one cell go to several tasks, which few bytes do not put together, and each pair comes once."""
    monkeypatch.setattr(spatial, "SITES", 30)
    monkeypatch.setattr(spatial, "POINTS", 20)
    s = spark.range(100).select(F.col("id").alias("site_id"), (89.9 + F.col("id") * 0.0).alias("lat"), (180.0 + F.col("id") * 0.0).alias("lon"))
    p = spark.range(150).select(F.col("id").alias("point_id"), (89.9 + F.col("id") * 0.0).alias("p_lat"), (-180.0 + F.col("id") * 0.0).alias("p_lon"))
    near = spatial.radius_join(s, p, 1000)
    found = near.select("site_id", "point_id", F.spark_partition_id().alias("task"), "distance_m").collect()
    assert len(found) == 15_000 == len({(r.site_id, r.point_id) for r in found}) and max(r.distance_m for r in found) < 1e-6
    assert len({r.task for r in found}) > 2


def test_names_of_the_site_go_in_whole_tiles(spark):
    """Places of one spot and other names stand before the k-th that counts."""
    s = spark.createDataFrame([(1, 10.0, 10.0, "Oak")], "site_id long, lat double, lon double, name string")
    at = [(i, 10.001, 10.0, f"The oak {i}", "a") for i in range(30)] + [(30 + i, 10.001, 10.0, f"Elm {i}", "a") for i in range(9)] + [(50, 10.0, 10.0, "x", "a"), (51, 10.0, 10.0, "x", "b")]
    p = spark.createDataFrame(at, "place_id long, p_lat double, p_lon double, place string, kind string")
    got = spatial.places_around(s, p, 500, 3, "kind", "place", "place_id", own=["a"]).collect()
    assert sorted((r.kind, r["rank"], r.place_id, r.n_around) for r in got) == [("a", 1, 30, 9), ("a", 2, 31, 9), ("a", 3, 32, 9), ("b", 1, 51, 1)]
