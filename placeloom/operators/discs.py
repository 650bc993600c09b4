"""What lies within a distance of sites, without a row for each pair.

Points are dealt into tiles of the globe some times as wide as the distance, sites into all tiles that they reach; tiles of very many
rows are dealt further. In a task, points stand in cells of a plane that touches the globe amid them: cells that are surely within
reach of a site count as a whole, by differences of running sums, and only points of cells at the rim are compared one by one. Nearest
points are looked for in growing discs. So the work of a site grows with the rim of its disc, not with its area.
"""

from __future__ import annotations

import math
import sys
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import ArrayType, DoubleType, LongType, StringType, StructField, StructType

from placeloom.functions.geo import DEGREE_M, RADIUS_M, band, cell, cells_in_band

# tasks get this code with the query, wherever the library lies
cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Points and sites of a tile that meet in one task, at most; rows of cells and pairs worked on at once.
POINTS, SITES, SLICE = 1 << 20, 1 << 14, 1 << 20


def tiles_around(lat: Column, lon: Column, radius_m: float, size_m: float) -> Column:
    """The tiles, as structs (_ci, _cj), that places within the radius may lie in, at any latitude and across the date line."""
    d, high = radius_m / DEGREE_M + 1e-9, size_m / DEGREE_M
    reach = math.sin(min(math.pi, radius_m / RADIUS_M) / 2) * (1 + 1e-9)

    def beside(b: Column) -> Column:
        n = cells_in_band(b, size_m)
        polar = F.least(F.lit(90.0), F.greatest(F.abs(lat), F.abs(b * high - 90), F.abs((b + 1) * high - 90)))
        half = F.degrees(2 * F.asin(F.least(F.lit(1.0), F.lit(reach) / F.greatest(F.cos(F.radians(polar)), F.lit(1e-12))))) + 1e-9
        at = lambda x: F.floor(x / 360 * n).cast("int")
        east = F.pmod(lon + 180, F.lit(360.0))
        low = at(east - half)
        last = F.least(at(east + half), low + n - 1)
        return F.transform(F.array_distinct(F.transform(F.sequence(low, last), lambda j: F.pmod(j, n))), lambda j: F.struct(b.alias("_ci"), j.alias("_cj")))

    bands = F.sequence(band(F.greatest(lat - d, F.lit(-90.0)), size_m), band(F.least(lat + d, F.lit(90.0)), size_m))
    return F.flatten(F.transform(bands, beside))


def dealt(sites: DataFrame, points: DataFrame, radius_m: float, size_m: float, most_sites: int, most_points: int, on: tuple[str, ...] = ()) -> tuple[DataFrame, DataFrame, list[str]]:
    """sites(lat, lon, ...) and points(p_lat, p_lon, ...) with the columns they meet by: tile, part of its points, part of its sites.

    Every pair within the radius meets once. A tile (of equal `on`) of more sites or points than told is dealt into parts by
    hashes of whole rows, and each part meets each of the other side: only numbers of such tiles go to all tasks. Both are spread by
    those columns over a set number of partitions, since few bytes may mean many pairs: they are not put together by size.
    """
    tile = ["_ci", "_cj", *on]
    near = sites.where("lat is not null and lon is not null").withColumn("_c", F.explode(tiles_around(F.col("lat"), F.col("lon"), radius_m, size_m))).select("*", "_c.*").drop("_c")
    dots = points.where("p_lat is not null and p_lon is not null").withColumn("_ci", band(F.col("p_lat"), size_m))
    dots = dots.withColumn("_cj", cell(F.col("p_lon"), cells_in_band(F.col("_ci"), size_m)))
    parts = lambda df, most, to: df.groupBy(*tile).agg(F.ceil(F.count(F.lit(1)) / most).cast("int").alias(to)).where(F.col(to) > 1)
    many = F.broadcast(parts(near, most_sites, "_ns").join(parts(dots, most_points, "_np"), tile, "full"))
    part = lambda df, n: F.pmod(F.xxhash64(*df.columns), F.coalesce(F.col(n), F.lit(1)))
    every = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.coalesce(F.col(n), F.lit(1)).cast("long") - 1))
    near = near.join(many, tile, "left").withColumn("_sp", part(near, "_ns")).withColumn("_pp", every("_np")).drop("_ns", "_np")
    dots = dots.join(many, tile, "left").withColumn("_pp", part(dots, "_np")).withColumn("_sp", every("_ns")).drop("_ns", "_np")
    by, spark = [*tile, "_pp", "_sp"], sites.sparkSession
    n = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 2 * spark.sparkContext.defaultParallelism)
    return near.repartition(n, *by), dots.repartition(n, *by), by


def met(sites: DataFrame, points: DataFrame, radius_m: float, f: Callable[[pa.Table, pa.Table], dict], schema: StructType, tiles: float = 4.0) -> DataFrame:
    """The columns that f makes of the sites and points of each tile; a site may meet some of its points in one and some in another."""
    near, dots, by = dealt(sites, points, radius_m, tiles * radius_m, SITES, POINTS)
    kinds = to_arrow_schema(schema)

    def both(a: pa.Table, b: pa.Table) -> pa.Table:
        return pa.table(f(a, b)).select(kinds.names).cast(kinds) if len(a) and len(b) else kinds.empty_table()

    return near.groupBy(*by).cogroup(dots.groupBy(*by)).applyInArrow(both, schema)


def numbers(table: pa.Table, column: str) -> np.ndarray:
    return table[column].to_numpy(zero_copy_only=False)


def positions(a: pa.Table, b: pa.Table) -> tuple[tuple[np.ndarray, np.ndarray], tuple[np.ndarray, np.ndarray]]:
    """Latitudes and longitudes of sites and of points."""
    return (numbers(a, "lat"), numbers(a, "lon")), (numbers(b, "p_lat"), numbers(b, "p_lon"))


def coded(column: pa.ChunkedArray) -> tuple[np.ndarray, pa.Array]:
    """The values' numbers in an array of the distinct ones; nulls are a value."""
    if pa.types.is_null(column.type):
        return np.zeros(len(column), np.int64), pa.nulls(1)
    found = pc.dictionary_encode(column, null_encoding="encode").combine_chunks()
    if isinstance(found, pa.ChunkedArray):
        found = found.chunk(0)
    return found.indices.to_numpy(zero_copy_only=False).astype(np.int64), found.dictionary


def by_code(codes: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """Each number, and where it stands."""
    order = np.argsort(codes, kind="stable")
    edges = np.nonzero(np.diff(codes[order]))[0] + 1
    for part in np.split(order, edges):
        if len(part):
            yield int(codes[part[0]]), part


def first_of_place(table: pa.Table, by: list[str], k: int, tie: list[str]) -> np.ndarray:
    """The rows without those that stand behind k others of the same place and the same `by`, in order of tie: none of the k nearest."""
    keys = [*by, "p_lat", "p_lon"]
    order = pc.sort_indices(table, [(c, "ascending") for c in [*keys, *tie]], null_placement="at_start").to_numpy()
    new = np.zeros(len(order), bool)
    new[:1] = True
    for c in keys:
        x = coded(table[c])[0][order]
        new[1:] |= x[1:] != x[:-1]
    began = np.maximum.accumulate(np.where(new, np.arange(len(order)), 0))
    return np.sort(order[np.arange(len(order)) - began < k])


def _sphere(lat: np.ndarray, lon: np.ndarray) -> np.ndarray:
    a, b = np.radians(lat), np.radians(lon)
    return np.stack([np.cos(a) * np.cos(b), np.cos(a) * np.sin(b), np.sin(a)])


def metres(lat1, lon1, lat2, lon2) -> np.ndarray:
    a = np.sin(np.radians(lat2 - lat1) / 2) ** 2 + np.cos(np.radians(lat1)) * np.cos(np.radians(lat2)) * np.sin(np.radians(lon2 - lon1) / 2) ** 2
    return 2 * RADIUS_M * np.arctan2(np.sqrt(a), np.sqrt(np.maximum(1 - a, 0)))


def chord(radius_m: float) -> float:
    return 2 * math.sin(min(math.pi, radius_m / RADIUS_M) / 2)


def _spread(i: np.ndarray, low: np.ndarray, high: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(i, every number from low to high) of each run, some SLICE at once."""
    some = high > low
    i, low, n = i[some], low[some], (high - low)[some]
    ends = np.cumsum(n)
    at = 0
    while at < len(i):
        to = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + SLICE, "right")))
        k = n[at:to]
        before = np.cumsum(k) - k
        yield np.repeat(i[at:to], k), np.arange(int(k.sum())) + np.repeat(low[at:to] - before, k)
        at = to


class Ground:
    """Points of a tile in cells, and sites that look for them. Distances between places are straight ones on the unit sphere."""

    def __init__(self, sites: tuple[np.ndarray, np.ndarray], points: tuple[np.ndarray, np.ndarray]):
        self.sites, self.points, self.n = sites, points, len(points[0])
        x, y = _sphere(*sites), _sphere(*points)
        up = y.mean(axis=1)
        length = np.linalg.norm(up)
        # few points, or places too far round the globe for a plane: all are compared
        self.flat = self.n > 16 and length > 0.1
        if self.flat:
            up = up / length
            east = np.cross(up, np.eye(3)[np.abs(up).argmin()])
            east = east / np.linalg.norm(east)
            turn = np.stack([east, np.cross(up, east), up])
            least = min((turn[2] @ x).min(), (turn[2] @ y).min()) if x.shape[1] else 0
            self.flat = least > 0.5
        if self.flat:
            x, y = turn @ x, turn @ y
            # a straight distance is at most so many times the one in the plane, squared
            self.stretch = 1 / least**2
            self.at = y[:2].min(axis=1)
            wide, high = y[:2].max(axis=1) - self.at
            self.side = max(math.sqrt(wide * high / self.n), max(wide, high) / self.n, 1e-12)
            column, row = (np.floor((y[k] - self.at[k]) / self.side).astype(np.int64) for k in (0, 1))
            self.columns, self.rows = int(column.max()) + 1, int(row.max()) + 1
            place = row * self.columns + column
            self.order = np.argsort(place, kind="stable")
            self.start = np.concatenate([[0], np.cumsum(np.bincount(place, minlength=self.columns * self.rows))])
        else:
            self.order = np.arange(self.n)
        self.x, self.y = x, np.ascontiguousarray(y[:, self.order])

    def runs(self, at: np.ndarray, reach: np.ndarray) -> tuple[np.ndarray, ...]:
        """i, low, high, from, to: for the site at[i] and a row of cells the points that may be within reach, and of them those that surely are."""
        if not self.flat:
            zero = np.zeros(len(at), np.int64)
            return np.arange(len(at)), zero, zero + self.n, zero, zero
        u, v, out = self.x[0, at], self.x[1, at], reach * (1 + 1e-9) + 1e-15
        index = lambda d, most: np.clip(np.floor(d / self.side), -1, most).astype(np.int64)
        first = np.maximum(index(v - out - self.at[1], self.rows), 0)
        n = np.maximum(np.minimum(index(v + out - self.at[1], self.rows) + 1, self.rows) - first, 0)
        i = np.repeat(np.arange(len(at)), n)
        row = np.arange(len(i)) - np.repeat(np.cumsum(n) - n, n) + first[i]
        low = self.at[1] + row * self.side - v[i]
        high = low + self.side
        u = u[i] - self.at[0]
        half = np.sqrt(np.maximum(out[i] ** 2 - np.maximum(0, np.maximum(low, -high)) ** 2, 0))
        c0 = np.maximum(index(u - half, self.columns), 0)
        c1 = np.maximum(np.minimum(index(u + half, self.columns) + 1, self.columns), c0)
        left = reach[i] ** 2 * (1 - 4e-9) / self.stretch - np.maximum(-low, high) ** 2
        half = np.sqrt(np.maximum(left, 0))
        k0 = np.clip(index(u - half, self.columns) + 1, c0, c1)
        k1 = np.where(left > 0, np.clip(index(u + half, self.columns), k0, c1), k0)
        base = row * self.columns
        return i, self.start[base + c0], self.start[base + c1], self.start[base + k0], self.start[base + k1]

    def slices(self, at: np.ndarray, reach: np.ndarray) -> Iterator[slice]:
        """Sites of which each has some rows of cells, SLICE rows at once."""
        rows = np.minimum(2 * reach / self.side + 3, self.rows + 1) if self.flat else np.ones(len(at))
        ends = np.cumsum(rows)
        lo = 0
        while lo < len(at):
            hi = max(lo + 1, int(np.searchsorted(ends, (ends[lo - 1] if lo else 0) + SLICE, "right")))
            yield slice(lo, hi)
            lo = hi

    def squares(self, s: np.ndarray, p: np.ndarray) -> np.ndarray:
        return sum((self.x[k, s] - self.y[k, p]) ** 2 for k in range(3))

    def close(self, s: np.ndarray, p: np.ndarray, radius_m: float) -> np.ndarray:
        """Whether the points p are within the radius of the sites s; by sines where straight distances do not tell."""
        r = chord(radius_m)
        d, unsure = self.squares(s, p), r * r * 4e-9 + r * 4e-15 + 1e-30
        yes = d <= r * r
        j = np.nonzero(np.abs(d - r * r) <= unsure)[0]
        yes[j] = self.metres(s[j], p[j]) <= radius_m
        return yes

    def metres(self, s: np.ndarray, p: np.ndarray) -> np.ndarray:
        q = self.order[p]
        return metres(self.sites[0][s], self.sites[1][s], self.points[0][q], self.points[1][q])

    def sums(self, radius_m: float, values: list[np.ndarray]) -> list[np.ndarray]:
        """For each site the number of points within the radius, then the sum of each of the values."""
        n = len(self.sites[0])
        odd = [(i, [np.isnan(v), np.isposinf(v), np.isneginf(v)]) for i, v in enumerate(values) if v.dtype.kind == "f" and not np.isfinite(v).all()]
        if odd:
            plain = list(values)
            for i, _ in odd:
                plain[i] = np.where(np.isfinite(values[i]), values[i], 0.0)
            out = self.sums(radius_m, plain + [c for _, three in odd for c in three])
            for at, (i, _) in enumerate(odd):
                nan, more, less = (x > 0 for x in out[1 + len(values) + 3 * at :][:3])
                out[1 + i][:] = np.where(nan | (more & less), np.nan, np.where(more, np.inf, np.where(less, -np.inf, out[1 + i])))
            return out[: 1 + len(values)]
        values = [np.ascontiguousarray(v[self.order]) for v in values]
        running = [np.concatenate([[0], np.cumsum(v, dtype=np.int64 if v.dtype.kind in "bi" else np.longdouble)]) for v in values]
        # of numbers of very different size, differences of running sums would lose the small ones
        far = [v.dtype.kind == "f" and np.abs(v).max(initial=0) * self.n * np.finfo(np.longdouble).eps > 1e-10 * np.abs(v[v != 0]).min(initial=np.inf) for v in values]
        out = [np.zeros(n, np.int64), *[np.zeros(n, r.dtype) for r in running]]
        reach = np.full(n, chord(radius_m))
        for part in self.slices(np.arange(n), reach):
            at = np.arange(n)[part]
            i, low, high, a, b = self.runs(at, reach[part])
            whole = lambda x: np.bincount(i, x, minlength=len(at))
            out[0][at] += whole(b - a).astype(np.int64)
            if values:
                some = np.nonzero(b > a)[0]
                for o, r in [x for x, one in zip(zip(out[1:], running, strict=True), far, strict=True) if not one]:
                    np.add.at(o, at[i[some]], r[b[some]] - r[a[some]])
                if any(far):
                    for j, p in _spread(i, a, b):
                        for o, v in [x for x, one in zip(zip(out[1:], values, strict=True), far, strict=True) if one]:
                            o[at] += np.bincount(j, v[p], minlength=len(at))
            for j, p in _spread(np.concatenate([i, i]), np.concatenate([low, b]), np.concatenate([a, high])):
                yes = self.close(at[j], p, radius_m)
                j, p = j[yes], p[yes]
                out[0][at] += np.bincount(j, minlength=len(at))
                for o, v in zip(out[1:], values, strict=True):
                    add = np.bincount(j, v[p], minlength=len(at))
                    o[at] += add.astype(np.int64) if o.dtype == np.int64 else add
        return out

    def nearest(self, k: int, radius_m: float, names: np.ndarray | None = None, allowed: Callable[[np.ndarray, np.ndarray], np.ndarray] | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """site, point, metres of at least the k nearest points of each site within the radius, or k names'; of equal distances all.

        allowed(sites, points) tells which pairs count at all.
        """
        r = chord(radius_m)
        todo, found = np.arange(len(self.sites[0])), []
        reach = np.full(len(todo), min(r, self.side * max(1.0, math.sqrt(k))) if self.flat else r)
        while len(todo):
            done = np.zeros(len(todo), bool)
            for part in self.slices(todo, reach):
                at, far = todo[part], reach[part]
                i, low, high, *_ = self.runs(at, far)
                count = np.bincount(i, high - low, minlength=len(at))
                enough = (count >= k) | (far >= r)
                some = enough[i]
                got = np.zeros(len(at), np.int64)
                pairs = []
                for j, p in _spread(i[some], low[some], high[some]):
                    yes = self.squares(at[j], p) <= far[j] ** 2 * (1 + 4e-9) + 1e-30
                    j, p = j[yes], p[yes]
                    if allowed is not None:
                        yes = allowed(at[j], self.order[p])
                        j, p = j[yes], p[yes]
                    pairs.append((j, p))
                j, p = (np.concatenate([x[c] for x in pairs]) if pairs else np.zeros(0, np.int64) for c in (0, 1))
                m = self.metres(at[j], p)
                p = self.order[p]
                yes = m <= radius_m
                j, p, m = j[yes], p[yes], m[yes]
                order = np.lexsort((m, j))
                j, p, m = j[order], p[order], m[order]
                if names is None:
                    got = np.bincount(j, minlength=len(at))
                    first = np.searchsorted(j, np.arange(len(at)))
                    kth = first + k - 1
                else:
                    # the first of each name, and the k-th of those
                    key = j * (int(names.max(initial=0)) + 1) + names[p]
                    lead = np.sort(np.unique(key, return_index=True)[1])
                    got = np.bincount(j[lead], minlength=len(at))
                    kth = np.searchsorted(j[lead], np.arange(len(at))) + k - 1
                    kth = lead[np.minimum(kth, len(lead) - 1)] if len(lead) else kth
                ok = enough & ((got >= k) | (far >= r))
                last = np.full(len(at), np.inf)
                full = got >= k
                last[full] = m[kth[full]]
                keep = ok[j] & (m <= last[j] * (1 + 1e-12) + 1e-12)
                found.append((at[j[keep]], p[keep], m[keep]))
                done[part] = ok
            todo, reach = todo[~done], np.minimum(reach[~done] * 1.6, r)
        s, p, m = (np.concatenate([f[c] for f in found]) if found else np.zeros(0, np.int64) for c in range(3))
        return s, p, m


def listing(at: tuple[np.ndarray, np.ndarray], to: tuple[np.ndarray, np.ndarray], values: pa.ChunkedArray, of: np.ndarray, radius_m: float, nulls: bool = True) -> pa.ListArray:
    """For each site the distinct values that points within the radius have: values[i] is one of the point of[i]."""
    kinds, known = coded(values)
    pairs = [(np.unique(Ground(at, (to[0][of[j]], to[1][of[j]])).nearest(1, radius_m)[0]), c) for c, j in by_code(kinds) if nulls or known[c].is_valid]
    s = np.concatenate([x for x, _ in pairs] or [np.zeros(0, np.int64)])
    c = np.concatenate([np.full(len(x), c) for x, c in pairs] or [np.zeros(0, np.int64)])
    order = np.argsort(s, kind="stable")
    ends = np.concatenate([[0], np.cumsum(np.bincount(s, minlength=len(at[0])))])
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), known.take(pa.array(c[order], pa.int64())))


def around(sites: DataFrame, points: DataFrame, key: str, sums: dict[str, tuple[float, Column]], nearest: dict[str, tuple[float, Column]] | None = None, listed: Column | None = None, tiles: float = 4.0) -> DataFrame:
    """key, `_n`, the points within the widest radius, and for each of sums the sum of a number, or how often a condition holds, within
    its radius; for each of nearest the metres to the nearest point that fulfils the condition, null if none does within the radius;
    `_listed`, an array of the distinct values of a text within the widest radius. Nulls count as nothing. Only sites with points have rows.
    """
    nearest = nearest or {}
    radius = max(r for r, _ in [*sums.values(), *nearest.values()])
    whole = {c: points.select(v).schema[0].dataType.simpleString() in ("boolean", "tinyint", "smallint", "int", "bigint") for c, (_, v) in sums.items()}
    numbered = [F.coalesce(v.cast("long" if whole[c] else "double"), F.lit(0).cast("long" if whole[c] else "double")).alias(f"_v{i}") for i, (c, (_, v)) in enumerate(sums.items())]
    asked = [F.coalesce(v, F.lit(False)).alias(f"_w{i}") for i, (_, v) in enumerate(nearest.values())]
    dots = points.select("p_lat", "p_lon", *numbered, *asked, *([] if listed is None else [listed.cast("string").alias("_x")]))
    schema = StructType([sites.schema[key], StructField("_n", LongType())])
    schema = StructType([*schema, *[StructField(f"_s{i}", LongType() if whole[c] else DoubleType()) for i, c in enumerate(sums)], *[StructField(f"_m{i}", DoubleType()) for i in range(len(nearest))], StructField("_x", ArrayType(StringType()))])
    of_sums, of_nearest, lists = [r for r, _ in sums.values()], [r for r, _ in nearest.values()], listed is not None

    def f(a: pa.Table, b: pa.Table) -> dict:
        at, to = positions(a, b)
        ground, out = Ground(at, to), {}
        for r in {radius, *of_sums}:
            mine = [i for i, x in enumerate(of_sums) if x == r]
            n, *found = ground.sums(r, [numbers(b, f"_v{i}") for i in mine])
            out |= {f"_s{i}": x.astype(np.int64 if x.dtype.kind == "i" else np.float64) for i, x in zip(mine, found, strict=True)}
            if r == radius:
                out["_n"] = n
        some = np.nonzero(out["_n"])[0]
        out = {c: pa.array(x[some]) for c, x in out.items()} | {key: a[key].take(pa.array(some))}
        at = (at[0][some], at[1][some])
        for i, r in enumerate(of_nearest):
            mine = np.nonzero(numbers(b, f"_w{i}"))[0]
            least = np.full(len(some), np.inf)
            if len(mine):
                s, _, m = (ground if len(mine) == len(b) and len(some) == len(a) else Ground(at, (to[0][mine], to[1][mine]))).nearest(1, r)
                np.minimum.at(least, s, m)
            out[f"_m{i}"] = pa.array(least, mask=np.isinf(least))
        out["_x"] = pa.nulls(len(some), pa.list_(pa.string()))
        if lists:
            kinds, names = coded(b["_x"])
            out["_x"] = listing(at, to, b["_x"], np.arange(len(b)), radius, nulls=False).cast(pa.list_(pa.string()))
        return out

    some = met(sites.select(key, "lat", "lon"), dots, radius, f, schema, tiles)
    totals = [F.sum("_n").alias("_n"), *[F.sum(f"_s{i}").alias(c) for i, c in enumerate(sums)], *[F.min(f"_m{i}").alias(c) for i, c in enumerate(nearest)]]
    return some.groupBy(key).agg(*totals, *([F.array_distinct(F.flatten(F.collect_list("_x"))).alias("_listed")] if lists else []))
