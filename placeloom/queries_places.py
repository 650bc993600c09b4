"""Queries of sources and sinks, spatial operators, the model, documents and streams."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, LongType, StringType, StructField, StructType

from placeloom.functions.values import first_valid
from placeloom.operators import documents, model, ranks, spatial, vectors
from placeloom.plans import features
from placeloom.plans.sites import events, latitude, longitude, read, sites
from placeloom.registry import query
from placeloom.sources import files
from placeloom.sources.scratch import shared_folder
from placeloom.streaming import rolling


def scratch(spark) -> str:
    """A new folder for a round trip through files, in the one that driver and executors share."""
    return f"{shared_folder(spark)}/files-{uuid.uuid4().hex}"


def _named(df, path: str, names, column: str, **options):
    """Writes one folder of delimited text for each value of a column, named after it; returns the folders."""
    out = []
    for name in names:
        df.where(F.col(column) == name).drop(column).write.options(header=True, **options).csv(f"{path}/{name}")
        out.append(f"{path}/{name}")
    return out


# ---- sources and sinks: what is written is read back


@query("s01_text_table", "SELECT c_custkey::VARCHAR AS id, 'Ä ' || c_name AS name FROM customer")
def s01(spark, sf_dir):
    path = scratch(spark)
    read(spark, sf_dir, "customer").select(F.concat(F.lit("  "), F.col("c_custkey").cast("string"), F.lit(" ")).alias(" id "), F.concat(F.lit("Ä "), "c_name").alias("name")).write.csv(path, sep=";", header=True, encoding="ISO-8859-1", ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False)
    return files.read_text_table(spark, path, ";", "ISO-8859-1")


@query("s02_by_suffix", "SELECT c_custkey::VARCHAR AS k, 'csv' AS kind FROM customer UNION ALL SELECT c_custkey::VARCHAR, 'parquet' FROM customer")
def s02(spark, sf_dir):
    path, c = scratch(spark), read(spark, sf_dir, "customer").select(F.col("c_custkey").cast("string").alias("k"))
    c.write.csv(f"{path}/a.csv", header=True)
    c.write.parquet(f"{path}/a.parquet")
    return files.read_any(spark, f"{path}/a.csv").withColumn("kind", F.lit("csv")).union(files.read_any(spark, f"{path}/a.parquet").withColumn("kind", F.lit("parquet")))


@query("s03_year_files", "SELECT o_orderkey::VARCHAR AS o_orderkey, 1997 AS file_year FROM orders WHERE year(o_orderdate) = 1997")
def s03(spark, sf_dir):
    """Files of 1996 and 1997 there are; 1999 is asked for. Part files have no year in their names, so they are renamed by Spark's own file system."""
    path = scratch(spark)
    o = read(spark, sf_dir, "orders").select("o_orderkey", F.year("o_orderdate").alias("y"))
    fs = spark._jvm.org.apache.hadoop.fs.Path(path).getFileSystem(spark._jsc.hadoopConfiguration())
    at = spark._jvm.org.apache.hadoop.fs.Path
    for folder, y in zip(_named(o, path, [1996, 1997], "y"), (1996, 1997), strict=True):
        for i, f in enumerate(fs.listStatus(at(folder))):
            if f.getPath().getName().startswith("part-"):
                fs.rename(f.getPath(), at(f"{path}/counts-{y}-{i}.csv"))
        fs.delete(at(folder), True)
    return files.read_year(spark, f"{path}/*.csv", 1999).select("o_orderkey", "file_year")


@query("s04_grid_in_box", "SELECT p_partkey AS cell, p_size AS population FROM part WHERE p_size BETWEEN 10 AND 30 AND p_retailprice BETWEEN 900 AND 1300")
def s04(spark, sf_dir):
    path = scratch(spark)
    read(spark, sf_dir, "part").select("p_partkey", "p_size", "p_retailprice").write.csv(path, header=True)
    grid = spark.read.schema("p_partkey bigint, p_size int, p_retailprice double").csv(path, header=True)
    return files.read_in_box(grid, "p_size", "p_retailprice", (10, 900, 30, 1300)).select(F.col("p_partkey").alias("cell"), F.col("p_size").alias("population"))


@query("s05_yearly_events", "SELECT o_orderkey::INT AS id, o_orderstatus AS region, round(o_totalprice / 1000, 6) AS lat, CASE WHEN year(o_orderdate) = 1997 THEN (o_orderkey % 3)::INT END AS bicycle FROM orders WHERE year(o_orderdate) IN (1996, 1997) AND o_orderstatus IN ('F', 'P')")
def s05(spark, sf_dir):
    path = scratch(spark)
    o = read(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", F.replace(F.round(F.col("o_totalprice") / 1000, 6).cast("decimal(20,6)").cast("string"), F.lit("."), F.lit(",")).alias("YGCS"), (F.col("o_orderkey") % 3).alias("IstRad"), F.year("o_orderdate").alias("y"))
    folders = _named(o.drop("IstRad"), path, [1996], "y", sep=";") + _named(o, path, [1997], "y", sep=";")
    found = files.read_events(spark, folders, ["F", "P"], {"id": "o_orderkey", "region": "o_orderstatus", "lat": "YGCS", "bicycle": "IstRad"})
    return found.select("id", "region", F.round("lat", 6).alias("lat"), "bicycle")


@query("s06_transit_feed", "SELECT DISTINCT (l_suppkey)::VARCHAR AS stop_id, (o_custkey % 40)::VARCHAR AS route_id, 'Line ' || (o_custkey % 40) AS route_short_name FROM lineitem JOIN orders ON l_orderkey = o_orderkey")
def s06(spark, sf_dir):
    from placeloom.operators.joins import stop_routes

    path, o = scratch(spark), read(spark, sf_dir, "orders")
    read(spark, sf_dir, "lineitem").select(F.col("l_suppkey").alias("stop_id"), F.col("l_orderkey").alias("trip_id"), F.col("l_linenumber").alias("stop_sequence")).write.csv(f"{path}/stop_times.txt", header=True)
    o.select(F.col("o_orderkey").alias("trip_id"), (F.col("o_custkey") % 40).alias("route_id"), F.lit("x").alias("service_id")).write.csv(f"{path}/trips.txt", header=True)
    o.select((F.col("o_custkey") % 40).alias("route_id")).distinct().select("route_id", F.concat(F.lit("Line "), F.col("route_id")).alias("route_short_name"), F.lit("3").alias("route_type")).write.csv(f"{path}/routes.txt", header=True)
    feed = files.read_transit(spark, path, {"stop_times": ["stop_id", "trip_id"], "trips": ["trip_id", "route_id"], "routes": ["route_id", "route_short_name"]})
    return stop_routes(feed["stop_times"], feed["trips"], feed["routes"]).select("stop_id", "route_id", "route_short_name")


@query("s07_geojson", "SELECT s_suppkey::VARCHAR AS segment_id, CASE WHEN s_suppkey % 3 = 2 THEN NULL ELSE s_suppkey + 0.5 END::DOUBLE AS lat, CASE WHEN s_suppkey % 3 = 2 THEN NULL WHEN s_suppkey % 3 = 0 THEN s_suppkey ELSE -s_suppkey END::DOUBLE AS lon FROM supplier")
def s07(spark, sf_dir):
    """A feature is a point, a line of three vertices of which the middle one counts, or has no geometry."""
    path, k = scratch(spark), F.col("s_suppkey").cast("double")
    at = lambda lon, lat: F.array(lon, lat)
    line = F.array(at(F.lit(0.0), F.lit(0.0)), at(-k, k + 0.5), at(F.lit(9.0), F.lit(9.0)))
    geometry = F.when(k % 3 != 2, F.struct(F.when(k % 3 == 0, at(k, k + 0.5)).alias("point"), F.when(k % 3 == 1, line).alias("line")))
    feature = F.struct(F.struct(F.col("s_suppkey").cast("string").alias("segment_id")).alias("properties"), geometry.alias("geometry"))
    read(spark, sf_dir, "supplier").groupBy((F.col("s_suppkey") % 7).alias("g")).agg(F.collect_list(feature).alias("features")).select(F.to_json(F.struct("features")).alias("value")).write.text(path)
    numbers = ArrayType(DoubleType())
    geo = StructType([StructField("point", numbers), StructField("line", ArrayType(numbers))])
    schema = StructType([StructField("features", ArrayType(StructType([StructField("properties", StructType([StructField("segment_id", StringType())])), StructField("geometry", geo)])))])
    return files.geojson_points(spark, path, schema, multi_line=False).select("segment_id", "lat", "lon")


@query("s08_json_lines", "SELECT CASE WHEN page_id % 5 <> 0 THEN page_id END AS page_id, CASE WHEN page_id % 5 <> 0 THEN url END AS url, page_id % 5 = 0 AS malformed FROM pages")
def s08(spark, sf_dir):
    path = scratch(spark)
    good = F.to_json(F.struct("page_id", "url"))
    read(spark, sf_dir, "pages").select(F.when(F.col("page_id") % 5 != 0, good).otherwise(F.concat(F.lit("{broken "), F.col("page_id"))).alias("value")).write.text(path)
    found = files.read_documents(spark, path, StructType([StructField("page_id", LongType()), StructField("url", StringType())]))
    return found.select("page_id", "url", F.col("_malformed").isNotNull().alias("malformed"))


@query("s09_first_stage", "SELECT s_suppkey, 'middle' AS stage FROM supplier")
def s09(spark, sf_dir):
    s, run = read(spark, sf_dir, "supplier").select("s_suppkey"), uuid.uuid4().hex
    for name in ("raw", "middle"):
        s.withColumn("stage", F.lit(name)).createOrReplaceTempView(f"{name}_{run}")
    return files.first_table(spark, [f"final_{run}", f"middle_{run}", f"raw_{run}"])


@query("s10_wide_sink", "SELECT vec_id::VARCHAR AS vec_id, label::VARCHAR AS label, '[' || label || ',' || vec_id || ']' AS pair FROM embeddings")
def s10(spark, sf_dir):
    path = scratch(spark)
    files.write_wide(read(spark, sf_dir, "embeddings").withColumn("pair", F.array(F.col("label").cast("long"), F.col("vec_id"))), path)
    kept = spark.read.parquet(f"{path}/parquet").where("embedding is not null").select(F.col("vec_id").cast("string").alias("vec_id"))
    return spark.read.csv(f"{path}/csv", header=True, escape='"').join(kept, "vec_id", "left_semi")


@query("s11_document_sink", "SELECT page_id, url FROM pages")
def s11(spark, sf_dir):
    path = scratch(spark)
    files.write_documents(read(spark, sf_dir, "pages").select("page_id", "url"), path)
    return spark.read.schema("page_id bigint, url string").json(path)


@query("s12_split_sink", "SELECT o_orderkey, o_orderstatus FROM orders WHERE o_orderstatus = 'F'")
def s12(spark, sf_dir):
    path = scratch(spark)
    files.write_by_class(read(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus"), path, "o_orderstatus")
    return spark.read.parquet(path).where("o_orderstatus = 'F'").select("o_orderkey", "o_orderstatus")


@query("s13_wide_predictions", "SELECT p_partkey, p_retailprice AS prediction, p_size * 2.0::DOUBLE AS contrib_size, NULL::DOUBLE AS contrib_none FROM part")
def s13(spark, sf_dir):
    p = read(spark, sf_dir, "part").select("p_partkey", F.col("p_retailprice").alias("prediction"), F.create_map(F.lit("size"), F.col("p_size") * 2.0).alias("contributions"))
    return files.contributions_wide(p, ["size", "none"])


# ---- spatial


def _globe(spark, sf_dir, table, key, name):
    """Places all over the globe, many near the poles and the date line."""
    k = F.col(key).cast("long")
    lat = F.when(k % 3 == 0, 89.5 - (k % 97) / 97.0).when(k % 3 == 1, -85 + (k % 89) / 89.0).otherwise((k % 101) / 101.0)
    lon = F.when(k % 2 == 0, 179.0 + (k % 53) / 53.0).otherwise(-180 + (k % 59) / 59.0)
    return read(spark, sf_dir, table).select(F.col(key).alias(name), lat.alias("lat"), lon.alias("lon"))


def _globe_sql(key: str, name: str, table: str) -> str:
    return f"SELECT {key} AS {name}, CASE {key} % 3 WHEN 0 THEN 89.5 - ({key} % 97) / 97.0::DOUBLE WHEN 1 THEN -85 + ({key} % 89) / 89.0::DOUBLE ELSE ({key} % 101) / 101.0::DOUBLE END::DOUBLE AS lat, CASE {key} % 2 WHEN 0 THEN 179.0 + ({key} % 53) / 53.0::DOUBLE ELSE -180 + ({key} % 59) / 59.0::DOUBLE END::DOUBLE AS lon FROM {table}"


_H = "pow(sin(radians(e.lat - s.lat) / 2), 2) + cos(radians(s.lat)) * cos(radians(e.lat)) * pow(sin(radians(e.lon - s.lon) / 2), 2)"
_M = "2 * 6371000.0 * atan2(sqrt(h), sqrt(1 - h))"


@query("e02_poles_and_date_line", f"WITH s AS ({_globe_sql('s_suppkey', 'site_id', 'supplier')}), e AS ({_globe_sql('c_custkey', 'event_id', 'customer')}), p AS (SELECT site_id, event_id, least(1.0::DOUBLE, {_H}) AS h FROM s, e) SELECT site_id, event_id FROM p WHERE {_M} <= 60000")
def e02_globe(spark, sf_dir):
    points = _globe(spark, sf_dir, "customer", "c_custkey", "event_id").withColumnsRenamed({"lat": "p_lat", "lon": "p_lon"})
    return spatial.radius_join(_globe(spark, sf_dir, "supplier", "s_suppkey", "site_id"), points, 60_000).select("site_id", "event_id")


def _at(k: str) -> str:
    return f"52.3 + (({k}::BIGINT * 7919) % 10007) / 10007.0::DOUBLE * 0.4 AS lat, 13.0 + (({k}::BIGINT * 104729) % 10009) / 10009.0::DOUBLE * 0.7 AS lon"


_SUPPLIERS = f"s AS (SELECT s_suppkey AS site_id, s_name AS name, s_nationkey, {_at('s_suppkey')} FROM supplier)"


def _suppliers(spark, sf_dir):
    return read(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("site_id"), F.col("s_name").alias("name"), "s_nationkey", latitude("s_suppkey").alias("lat"), longitude("s_suppkey").alias("lon"))


_ACCIDENTS = f"e AS (SELECT o_orderkey AS event_id, (o_orderkey % 3 + 1) AS severity, o_orderkey % 4 = 0 AS bicycle, o_orderkey % 5 = 0 AS walker, o_orderkey % 24 AS hour, o_orderkey % 7 + 1 AS weekday, {_at('o_orderkey')} FROM orders)"


@query("e03_accidents", f"WITH {_SUPPLIERS}, {_ACCIDENTS}, p AS (SELECT site_id, e.*, {_H} AS h FROM s JOIN e ON abs(e.lat - s.lat) < 0.03), n AS (SELECT *, {_M} AS m FROM p WHERE {_M} <= 1000) SELECT s.site_id, count(event_id) AS n, count(*) FILTER (severity = 1) AS n_fatal, count(*) FILTER (severity = 2) AS n_serious, count(*) FILTER (severity = 3) AS n_minor, count(*) FILTER (bicycle) AS n_bicycle, count(*) FILTER (walker) AS n_walker, count(*) FILTER (hour BETWEEN 7 AND 17 AND weekday BETWEEN 2 AND 6) AS n_school_hours, round(count(event_id) / 3.0::DOUBLE, 2) AS per_year, round(min(m), 3) AS nearest_m FROM s LEFT JOIN n ON n.site_id = s.site_id GROUP BY 1")
def e03_accidents(spark, sf_dir):
    k = F.col("o_orderkey")
    accidents = read(spark, sf_dir, "orders").select((k % 3 + 1).alias("severity"), (k % 4 == 0).cast("int").alias("bicycle"), (k % 5 == 0).cast("int").alias("walker"), (k % 24).alias("hour"), (k % 7 + 1).alias("weekday"), latitude("o_orderkey").alias("p_lat"), longitude("o_orderkey").alias("p_lon"))
    found = spatial.accidents_around(_suppliers(spark, sf_dir).select("site_id", "lat", "lon"), accidents, 1000, 3)
    return found.drop("lat", "lon").withColumn("nearest_m", F.round("nearest_m", 3))


_STOPS = f"e AS (SELECT o_orderpriority AS mode, 'stop ' || (o_orderkey % 400) AS name, o_orderkey % 30 AS line, {_at('o_orderkey')} FROM orders)"


@query("e05_stops_around", f"WITH {_SUPPLIERS}, {_STOPS}, p AS (SELECT site_id, e.mode, e.name, e.line, {_H} AS h FROM s JOIN e ON abs(e.lat - s.lat) < 0.03), n AS (SELECT *, {_M} AS m FROM p WHERE {_M} <= 1500), d AS (SELECT site_id, mode, name, min(m) AS m FROM n GROUP BY 1, 2, 3), r AS (SELECT *, row_number() OVER (PARTITION BY site_id, mode ORDER BY m, name) AS rank FROM d), c AS (SELECT site_id, mode, count(*) AS n_stops, count(DISTINCT line)::INT AS n_lines FROM n GROUP BY 1, 2) SELECT site_id, mode, rank, name, round(m, 3) AS distance_m, n_stops, n_lines FROM r JOIN c USING (site_id, mode) WHERE rank <= 3")
def e05_stops(spark, sf_dir):
    k = F.col("o_orderkey")
    stops = read(spark, sf_dir, "orders").select(F.col("o_orderpriority").alias("mode"), F.concat(F.lit("stop "), k % 400).alias("name"), F.array(k % 30).alias("lines"), latitude("o_orderkey").alias("p_lat"), longitude("o_orderkey").alias("p_lon"))
    found = spatial.stops_around(_suppliers(spark, sf_dir), stops, 1500, 3)
    return found.withColumn("distance_m", F.round("distance_m", 3)).withColumn("rank", F.col("rank").cast("long"))


_POIS = f"e AS (SELECT c_custkey AS place_id, c_mktsegment AS category, CASE WHEN c_custkey % 9 = 0 THEN 'Cafe Supplier#00000000' || (c_custkey % 10) ELSE c_name END AS place, {_at('c_custkey')} FROM customer)"


@query("e06_places_around", f"WITH {_SUPPLIERS}, {_POIS}, p AS (SELECT site_id, s.name, e.category, e.place_id, e.place, {_H} AS h FROM s JOIN e ON abs(e.lat - s.lat) < 0.03), n AS (SELECT *, {_M} AS m FROM p WHERE {_M} <= 2000), k AS (SELECT *, count(*) OVER (PARTITION BY site_id, category) AS n_around, row_number() OVER (PARTITION BY site_id, category ORDER BY m, place_id) AS rank FROM n WHERE NOT (category IN ('BUILDING', 'MACHINERY') AND (m <= 50 OR contains(lower(place), lower(name))))) SELECT site_id, category, rank, place_id, round(m, 3) AS distance_m, n_around FROM k WHERE rank <= 3")
def e06(spark, sf_dir):
    k = F.col("c_custkey")
    places = read(spark, sf_dir, "customer").select(k.alias("place_id"), F.col("c_mktsegment").alias("category"), F.when(k % 9 == 0, F.concat(F.lit("Cafe Supplier#00000000"), k % 10)).otherwise(F.col("c_name")).alias("place"), latitude("c_custkey").alias("p_lat"), longitude("c_custkey").alias("p_lon"))
    found = spatial.places_around(_suppliers(spark, sf_dir), places, 2000, 3, "category", "place", "place_id", own=["BUILDING", "MACHINERY"])
    return found.select("site_id", "category", F.col("rank").cast("long").alias("rank"), "place_id", F.round("distance_m", 3).alias("distance_m"), "n_around")


@query("e08_supply", f"WITH {_SUPPLIERS}, p AS (SELECT s.site_id, {_H} AS h FROM s JOIN s e ON s.s_nationkey % 5 = e.s_nationkey % 5 AND s.site_id <> e.site_id AND abs(e.lat - s.lat) < 0.06), n AS (SELECT site_id, count(*) AS k FROM p WHERE {_M} <= 5000 GROUP BY 1) SELECT s.site_id, coalesce(k, 0) AS competitors, round((1000 + s.site_id) / (coalesce(k, 0) + 1)::DOUBLE, 2) AS population_per_site, round((coalesce(k, 0) + 1) * 10000.0::DOUBLE / (1000 + s.site_id), 4) AS supply_ratio FROM s LEFT JOIN n ON n.site_id = s.site_id")
def e08_supply(spark, sf_dir):
    s = _suppliers(spark, sf_dir).withColumn("type", F.col("s_nationkey") % 5).withColumn("people", 1000 + F.col("site_id"))
    return spatial.competition(s, 5000, population="people").select("site_id", "competitors", "population_per_site", "supply_ratio")


@query("e05_uncapped_by_mode", f"WITH {_SUPPLIERS}, {_STOPS.replace('% 400', '% 90')}, p AS (SELECT site_id, e.mode, e.name, {_H} AS h FROM s, e), d AS (SELECT site_id, mode, name, min({_M}) AS m FROM p GROUP BY 1, 2, 3), r AS (SELECT *, row_number() OVER (PARTITION BY site_id, mode ORDER BY m, name) AS rank FROM d) SELECT site_id, mode, rank, name, round(m, 3) AS distance_m FROM r WHERE rank <= 3")
def e05_uncapped(spark, sf_dir):
    """The three nearest stops of different names of each mode, however far."""
    k = F.col("o_orderkey")
    stops = read(spark, sf_dir, "orders").select(F.col("o_orderpriority").alias("mode"), F.concat(F.lit("stop "), k % 90).alias("stop"), latitude("o_orderkey").alias("p_lat"), longitude("o_orderkey").alias("p_lon"))
    found = spatial.nearest_uncapped(_suppliers(spark, sf_dir).select("site_id", "lat", "lon"), stops, 3, 250, "stop", category="mode", name="stop")
    return found.select("site_id", "mode", F.col("rank").cast("long").alias("rank"), F.col("stop").alias("name"), F.round("distance_m", 3).alias("distance_m"))


@query("e09_nearest_per_type", f"WITH {_SUPPLIERS}, e AS (SELECT c_custkey AS place_id, c_mktsegment AS kind, {_at('c_custkey')} FROM customer), p AS (SELECT site_id, kind, place_id, {_H} AS h FROM s, e), r AS (SELECT *, {_M} AS m, row_number() OVER (PARTITION BY site_id, kind ORDER BY {_M}, place_id) AS n FROM p) SELECT s.site_id, a.place_id AS \"BUILDING_id\", round(a.m, 3) AS \"BUILDING_m\", b.place_id AS \"MACHINERY_id\", round(b.m, 3) AS \"MACHINERY_m\" FROM s LEFT JOIN (SELECT * FROM r WHERE kind = 'BUILDING' AND n = 1) a ON a.site_id = s.site_id LEFT JOIN (SELECT * FROM r WHERE kind = 'MACHINERY' AND n = 1) b ON b.site_id = s.site_id")
def e09(spark, sf_dir):
    places = read(spark, sf_dir, "customer").select(F.col("c_custkey").alias("place_id"), F.col("c_mktsegment").alias("kind"), latitude("c_custkey").alias("p_lat"), longitude("c_custkey").alias("p_lon"))
    found = spatial.nearest_per_type(_suppliers(spark, sf_dir).select("site_id", "lat", "lon"), places, ["BUILDING", "MACHINERY"], "kind", "place_id", 2000)
    return found.select("site_id", "BUILDING_id", F.round("BUILDING_m", 3).alias("BUILDING_m"), "MACHINERY_id", F.round("MACHINERY_m", 3).alias("MACHINERY_m"))


@query("a02_by_family", f"WITH {_SUPPLIERS}, e AS (SELECT p_brand AS family, p_size::DOUBLE AS cars, {_at('p_partkey')} FROM part), p AS (SELECT site_id, e.*, {_H} AS h FROM s JOIN e ON abs(e.lat - s.lat) < 0.06), n AS (SELECT site_id, round(avg(cars) FILTER (family = 'Brand#1'), 6) AS a, count(*) FILTER (family = 'Brand#1') AS b, round(min({_M}) FILTER (family = 'Brand#1'), 3) AS c, round(avg(cars) FILTER (family = 'Brand#2'), 6) AS d, count(*) FILTER (family = 'Brand#2') AS f, count(*) AS k FROM p WHERE {_M} <= 3000 GROUP BY 1) SELECT s.site_id, a AS first_mean, coalesce(b, 0) AS first_n, c AS first_nearest, d AS second_mean, coalesce(f, 0) AS second_n, coalesce(k, 0) AS n_sensors FROM s LEFT JOIN n ON n.site_id = s.site_id")
def a02_by_family(spark, sf_dir):
    sensors = read(spark, sf_dir, "part").select(F.col("p_partkey").alias("sensor_id"), F.col("p_brand").alias("family"), F.col("p_size").cast("double").alias("cars"), latitude("p_partkey").alias("p_lat"), longitude("p_partkey").alias("p_lon"))
    found = spatial.sensor_means(_suppliers(spark, sf_dir).select("site_id", "lat", "lon"), sensors, 3000, ["cars"], "family", split=["Brand#1", "Brand#2"])
    return found.select("site_id", F.round("mean_cars_Brand#1", 6).alias("first_mean"), F.col("n_sensors_Brand#1").alias("first_n"), F.round("nearest_m_Brand#1", 3).alias("first_nearest"), F.round("mean_cars_Brand#2", 6).alias("second_mean"), F.col("n_sensors_Brand#2").alias("second_n"), "n_sensors")


@query("a02_sensor_means", f"WITH {_SUPPLIERS}, e AS (SELECT p_partkey AS sensor_id, p_brand AS family, p_size::DOUBLE AS cars, CASE WHEN p_partkey % 3 <> 0 THEN p_retailprice END AS bikes, {_at('p_partkey')} FROM part), p AS (SELECT site_id, e.*, {_H} AS h FROM s JOIN e ON abs(e.lat - s.lat) < 0.06), n AS (SELECT site_id, avg(cars) AS c, avg(bikes) AS b, count(*) AS k, min({_M}) AS m, string_agg(DISTINCT family, ',' ORDER BY family) AS f FROM p WHERE {_M} <= 3000 GROUP BY 1) SELECT s.site_id, round(c, 6) AS mean_cars, round(b, 6) AS mean_bikes, coalesce(k, 0) AS n_sensors, round(m, 3) AS nearest_m, f AS families FROM s LEFT JOIN n ON n.site_id = s.site_id")
def a02(spark, sf_dir):
    sensors = read(spark, sf_dir, "part").select(F.col("p_partkey").alias("sensor_id"), F.col("p_brand").alias("family"), F.col("p_size").cast("double").alias("cars"), F.when(F.col("p_partkey") % 3 != 0, F.col("p_retailprice")).alias("bikes"), latitude("p_partkey").alias("p_lat"), longitude("p_partkey").alias("p_lon"))
    found = spatial.sensor_means(_suppliers(spark, sf_dir).select("site_id", "lat", "lon"), sensors, 3000, ["cars", "bikes"], "family")
    return found.select("site_id", F.round("mean_cars", 6).alias("mean_cars"), F.round("mean_bikes", 6).alias("mean_bikes"), "n_sensors", F.round("nearest_m", 3).alias("nearest_m"), "families")


# ---- model


def _orders(spark, sf_dir):
    lines = read(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.sum("l_quantity").alias("quantity"), F.avg("l_discount").alias("discount"), F.count(F.lit(1)).cast("double").alias("n_lines"))
    return read(spark, sf_dir, "orders").join(lines, "o_orderkey")


@query("m00_features", "SELECT 'cust_' || c_custkey AS id, 'cust' AS source, c_acctbal AS balance, n_regionkey::DOUBLE AS area FROM customer JOIN nation ON c_nationkey = n_nationkey UNION ALL SELECT 'supp_' || s_suppkey, 'supp', s_acctbal * 2, NULL FROM supplier")
def m00(spark, sf_dir):
    c = read(spark, sf_dir, "customer").join(read(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    tables = {"cust": (c, "c_custkey", {"balance": F.col("c_acctbal"), "area": F.col("n_regionkey")}), "supp": (read(spark, sf_dir, "supplier"), "s_suppkey", {"balance": F.col("s_acctbal") * 2})}
    return model.feature_rows(tables, ["balance", "area"])


@query("m00_whole_build", f"""WITH {_SUPPLIERS}, w AS (SELECT s.*, s.site_id * 1.5 AS own, CASE WHEN s_acctbal BETWEEN 1 AND 3000 THEN s_acctbal WHEN site_id % 3 = 0 THEN 2.5 END AS label FROM s JOIN supplier ON s_suppkey = site_id),
e AS (SELECT p_size, {_at('p_partkey')} FROM part),
p AS (SELECT site_id, p_size, {_H} AS h FROM s JOIN e ON abs(e.lat - s.lat) < 0.03), c AS (SELECT site_id, sum(p_size)::DOUBLE AS v FROM p WHERE {_M} <= 1000 GROUP BY 1),
q AS (SELECT s.site_id, {_H} AS h FROM s JOIN s e ON s.s_nationkey % 5 = e.s_nationkey % 5 AND s.site_id <> e.site_id AND abs(e.lat - s.lat) < 0.06), r AS (SELECT site_id, count(*) AS n, min({_M}) AS m FROM q WHERE {_M} <= 5000 GROUP BY 1),
i AS (SELECT c_nationkey, round(avg(c_acctbal), 6) AS v FROM customer WHERE c_nationkey % 4 <> 0 GROUP BY 1)
SELECT w.site_id AS id, own::DOUBLE AS own, c.v AS catchment, round(c.v / 3.141592653589793::DOUBLE, 4) AS density, coalesce(r.n, 0) AS competitors, round(r.m, 3) AS nearest_m, i.v AS area_index, label::DOUBLE AS label
FROM w LEFT JOIN c ON c.site_id = w.site_id LEFT JOIN r ON r.site_id = w.site_id LEFT JOIN i ON i.c_nationkey = w.s_nationkey""")
def m00_whole(spark, sf_dir):
    """Own figures, catchment, competition, area index by postcode and label of each site, in one job."""
    s = read(spark, sf_dir, "supplier").select("s_suppkey", "s_acctbal")
    s = _suppliers(spark, sf_dir).join(s, F.col("s_suppkey") == F.col("site_id"))
    s = s.select(F.col("site_id").alias("id"), (F.col("s_nationkey") % 5).alias("type"), (F.col("s_nationkey") + 10000).alias("postcode"), "lat", "lon", "s_acctbal")
    cells = read(spark, sf_dir, "part").select("p_size", latitude("p_partkey").alias("p_lat"), longitude("p_partkey").alias("p_lon"))
    areas = read(spark, sf_dir, "customer").where("c_nationkey % 4 <> 0").groupBy((F.col("c_nationkey") + 10000).alias("postcode")).agg(F.round(F.avg("c_acctbal"), 6).alias("area_index"))
    label = first_valid([F.col("s_acctbal"), F.when(F.col("id") % 3 == 0, F.lit(2.5))], 1, 3000)
    found = features.built(s, cells, areas, {"own": F.col("id") * 1.5}, label, "p_size", 1000, 5000)
    return found.withColumn("density", F.round("density", 4)).withColumn("nearest_m", F.round("nearest_m", 3))


@query("m01_standardised", "WITH r AS (SELECT avg(c_acctbal) AS m, stddev_pop(c_acctbal) AS s FROM customer WHERE c_custkey % 2 = 0) SELECT c_custkey, round(greatest(least((c_acctbal - m) / s, 10), -10), 6)::DOUBLE AS z FROM customer, r")
def m01(spark, sf_dir):
    c = read(spark, sf_dir, "customer").select("c_custkey", F.col("c_acctbal").alias("z"), F.lit(1.0).alias("flat"))
    return model.standardised(c, ["z", "flat"], reference=F.col("c_custkey") % 2 == 0)[0].select("c_custkey", F.round("z", 6).alias("z"))


@query("m01_gaps", "WITH g AS (SELECT o_orderkey, CASE WHEN o_orderkey % 7 <> 0 THEN o_totalprice END AS x, CASE WHEN o_orderkey % 5 <> 0 THEN (o_orderkey % 3)::DOUBLE END AS y FROM orders), r AS (SELECT avg(x) AS mx, stddev_pop(x) AS sx, median(x) AS qx, avg(y) AS my, stddev_pop(y) AS sy, median(y) AS qy FROM g) SELECT o_orderkey, round(greatest(least((coalesce(x, qx) - mx) / sx, 10), -10), 6)::DOUBLE AS x, round(greatest(least((coalesce(y, qy) - my) / sy, 10), -10), 6)::DOUBLE AS y FROM g, r")
def m01_gaps(spark, sf_dir):
    """Gaps take the exact median, of a column of distinct values and of one with three."""
    k = F.col("o_orderkey")
    o = read(spark, sf_dir, "orders").select(k, F.when(k % 7 != 0, F.col("o_totalprice")).alias("x"), F.when(k % 5 != 0, (k % 3).cast("double")).alias("y"))
    return model.standardised(o, ["x", "y"])[0].select("o_orderkey", F.round("x", 6).alias("x"), F.round("y", 6).alias("y"))


_ONE = "WITH r AS (SELECT count(*) AS n, avg(p_size) AS mx, avg(p_retailprice) AS my, var_pop(p_size) * count(*) AS sxx, covar_pop(p_retailprice, p_size) * count(*) AS sxy FROM part), b AS (SELECT *, sxy / (sxx + 50) AS b FROM r)"


@query("m02_one_feature", _ONE + " SELECT p_partkey, round(my + b * (p_size - mx), 6) AS prediction, round(b * p_size, 6) AS contribution FROM part, b")
def m02_one(spark, sf_dir):
    p = read(spark, sf_dir, "part").withColumn("size", F.col("p_size").cast("double"))
    m = model.solve(model.gram(p, ["size"], "p_retailprice")[0], ["size"])
    return p.select("p_partkey", F.round(m.prediction(), 6).alias("prediction"), F.round(F.element_at(m.contributions(), "size"), 6).alias("contribution"))


@query("m03_intervals", _ONE + ", f AS (SELECT *, (SELECT sum(pow(p_retailprice - my - b * (p_size - mx), 2)) FROM part) AS rss FROM b), v AS (SELECT *, rss / greatest(1, n - (sxx / (sxx + 50) + 1)) AS s2 FROM f) SELECT p_partkey, round(1.2816 * sqrt(s2 * (1 + 1.0::DOUBLE / n + pow(p_size - mx, 2) / (sxx + 50))), 4) AS half_width FROM part, v")
def m03(spark, sf_dir):
    p = read(spark, sf_dir, "part").withColumn("size", F.col("p_size").cast("double"))
    m = model.solve(model.gram(p, ["size"], "p_retailprice")[0], ["size"])
    return p.select("p_partkey", F.round(m.half_width(), 4).alias("half_width"))


@query("m04_importance", _ONE + " SELECT 'size' AS feature, round(b * (SELECT stddev_pop(p_size) FROM part) / (SELECT stddev_pop(p_retailprice) FROM part), 6) AS importance FROM b")
def m04(spark, sf_dir):
    g = model.gram(read(spark, sf_dir, "part").withColumn("size", F.col("p_size").cast("double")), ["size"], "p_retailprice")[0]
    return spark.createDataFrame(model.importance(model.solve(g, ["size"]), g), "feature string, importance double").select("feature", F.round("importance", 6).alias("importance"))


@query("m05_folds")
def m05(spark, sf_dir):
    folds = model.cross_validated(_orders(spark, sf_dir), ["quantity", "discount", "n_lines"], "o_totalprice", "o_orderkey")
    return spark.createDataFrame(folds, "fold int, r2 double, rmse double, mae double")


_FOLD_ONE = "WITH e AS (SELECT *, p_partkey % 4 AS f FROM part), t AS (SELECT a.f, count(*) AS n, avg(b.p_size) AS mx, avg(b.p_retailprice) AS my, var_pop(b.p_size) * count(*) AS sxx, covar_pop(b.p_retailprice, b.p_size) * count(*) AS sxy FROM (SELECT DISTINCT f FROM e) a JOIN e b ON a.f <> b.f GROUP BY 1), m AS (SELECT f, sxy / (sxx + 50) AS b, my - mx * sxy / (sxx + 50) AS a FROM t)"


@query("m05_fold_errors", _FOLD_ONE + " SELECT e.f::INT AS fold, round(1 - sum((p_retailprice - a - b * p_size) ** 2) / (var_pop(p_retailprice) * count(*)), 6)::DOUBLE AS r2, round(sqrt(avg((p_retailprice - a - b * p_size) ** 2)), 4)::DOUBLE AS rmse, round(avg(abs(p_retailprice - a - b * p_size)), 4)::DOUBLE AS mae FROM e JOIN m ON e.f = m.f GROUP BY 1")
def m05_errors(spark, sf_dir):
    """Folds given as a column, so that SQL can make the same ones."""
    p = read(spark, sf_dir, "part").withColumn("f", F.col("p_partkey") % 4)
    folds = model.cross_validated(p, ["p_size"], "p_retailprice", "p_partkey", fold=F.col("f"))
    return spark.createDataFrame([(f, round(r2, 6), round(rmse, 4), round(mae, 4)) for f, r2, rmse, mae in folds], "fold int, r2 double, rmse double, mae double")


@query("m07_confidence", "WITH r AS (SELECT avg(c_acctbal) AS m, stddev_pop(c_acctbal) AS s, avg(c_nationkey) AS mn, stddev_pop(c_nationkey) AS sn FROM customer) SELECT c_custkey, round(greatest(0, least(1, 1 - (abs((c_acctbal - m) / s) + abs((c_nationkey - mn) / sn)) / 2 / 5)), 6)::DOUBLE AS confidence FROM customer, r")
def m07(spark, sf_dir):
    c = read(spark, sf_dir, "customer").select("c_custkey", F.col("c_acctbal").alias("a"), F.col("c_nationkey").cast("double").alias("b"))
    z, used = model.standardised(c, ["a", "b"])
    return z.select("c_custkey", F.round(model.confidence(used), 6).alias("confidence"))


@query("m08_partial_r2")
def m08(spark, sf_dir):
    z, used = model.standardised(_orders(spark, sf_dir), ["quantity", "discount", "n_lines"])
    return spark.createDataFrame(model.partial_r2(model.gram(z, used, "o_totalprice")[0], used), "feature string, r2_lost double, p_value double")


@query("m09_imputed", "WITH w AS (SELECT p_size::DOUBLE AS x, p_retailprice / 500 AS y FROM part WHERE p_partkey % 4 <> 0), r AS (SELECT regr_slope(y, x) AS b, regr_intercept(y, x) AS a, regr_r2(y, x) AS r2, count(*) AS n FROM w) SELECT p_partkey, round(CASE WHEN p_partkey % 4 <> 0 THEN p_retailprice / 500 WHEN n >= 20 AND r2 >= 0.0 THEN greatest(least(a + b * p_size, 5), 1) END, 6)::DOUBLE AS score FROM part, r")
def m09(spark, sf_dir):
    p = read(spark, sf_dir, "part").select("p_partkey", F.col("p_size").cast("double").alias("size"), F.when(F.col("p_partkey") % 4 != 0, F.col("p_retailprice") / 500).alias("score"))
    return model.impute(p, "score", ["size"], r2=0.0).select("p_partkey", F.round("score", 6).alias("score"))


@query("m10_fit_figures", "WITH e AS (SELECT p_retailprice AS y, p_retailprice - (900 + p_size) AS e FROM part), s AS (SELECT count(*) AS n, 1 - sum(e * e) / (var_pop(y) * count(*)) AS r2, sqrt(sum(e * e) / count(*)) AS rmse, avg(abs(e)) AS mae FROM e) SELECT n, round(r2, 6) AS r2, round(1 - (1 - r2) * (n - 1) / (n - 2), 6) AS adjusted_r2, round(rmse, 6) AS rmse, round(mae, 6) AS mae FROM s")
def m10(spark, sf_dir):
    p = read(spark, sf_dir, "part").withColumn("prediction", (900 + F.col("p_size")).cast("double"))
    found = model.fit_figures(p, "p_retailprice", "prediction", 1)
    return found.select("n", *[F.round(c, 6).alias(c) for c in ("r2", "adjusted_r2", "rmse", "mae")])


@query("m11_drivers", "SELECT p_partkey, CASE WHEN p_size > 20 THEN '{\"size\":' || p_size || '.0}' ELSE '{\"base\":-20.0}' END AS drivers FROM part WHERE p_size <> 20")
def m11(spark, sf_dir):
    m = F.create_map(F.lit("size"), F.col("p_size").cast("double"), F.lit("base"), F.lit(-20.0))
    return read(spark, sf_dir, "part").where("p_size <> 20").select("p_partkey", F.to_json(F.map_from_entries(ranks.top_entries(m, 1))).alias("drivers"))


@query("m12_official_shift", "WITH d AS (SELECT c_custkey, c_nationkey AS city, c_mktsegment AS type, c_acctbal AS p FROM customer), m AS (SELECT city, type, avg(p) AS m FROM d GROUP BY 1, 2), w AS (SELECT city, avg(p) AS m FROM d GROUP BY 1) SELECT c_custkey, round(p + CASE WHEN d.city % 5 = 0 THEN 0 WHEN d.city % 3 = 0 THEN CASE WHEN d.type IN ('BUILDING', 'FURNITURE') THEN 4000 - m.m ELSE 0 END WHEN d.city % 3 = 1 THEN 5000 - w.m ELSE 0 END, 9) AS rebased FROM d JOIN m ON m.city = d.city AND m.type = d.type JOIN w ON w.city = d.city")
def m12(spark, sf_dir):
    d = read(spark, sf_dir, "customer").select("c_custkey", F.col("c_nationkey").alias("city"), F.col("c_mktsegment").alias("type"), F.col("c_acctbal").alias("prediction"))
    n = read(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("city"))
    typed = n.where("city % 3 = 0").select("city", F.explode(F.array(F.lit("BUILDING"), F.lit("FURNITURE"))).alias("type"), F.lit(4000.0).alias("official"))
    whole = n.where("city % 3 = 1").select("city", F.lit(None).cast("string").alias("type"), F.lit(5000.0).alias("official"))
    return model.official_shift(d, typed.union(whole), n.where("city % 5 = 0")).select("c_custkey", F.round("rebased", 9).alias("rebased"))


@query("m13_strongest", "WITH c AS (SELECT i::INT AS dim, corr(embedding[i + 1]::DOUBLE, label::DOUBLE) AS r FROM embeddings, range(64) t(i) GROUP BY 1) SELECT dim, round(r, 6) AS r FROM c ORDER BY abs(r) DESC, dim LIMIT 10")
def m13_strongest(spark, sf_dir):
    return vectors.dimension_correlations(read(spark, sf_dir, "embeddings"), "embedding", "label", 10).select("dim", F.round("r", 6).alias("r"))


@query("m14_selection_by_fold")
def m14(spark, sf_dir):
    found = model.cross_validated_selection(read(spark, sf_dir, "embeddings"), "embedding", "label", "vec_id", 8)
    return spark.createDataFrame(found, "fold int, dims array<int>, r2 double, rmse double")


@query("m15_stable_dimensions")
def m15(spark, sf_dir):
    correlations = model.fold_correlations(read(spark, sf_dir, "embeddings"), "embedding", "label", "vec_id")
    return model.stable_dimensions(model.selected_dimensions(correlations, 8)).select("dim", "n_folds", F.round("mean_abs_r", 6).alias("mean_abs_r"))


@query("m16_back_test", "WITH d AS (SELECT CASE WHEN p_size > 10 THEN p_retailprice END AS y, 900.0 + p_size AS raw, 950.0 + p_size AS reb, p_size AS w FROM part) SELECT 'raw' AS measure, count(y) AS n, round(avg(abs(raw - y)), 6)::DOUBLE AS mae, round(avg(raw - y), 6)::DOUBLE AS bias, round(avg(w * 2) FILTER (y IS NOT NULL), 6)::DOUBLE AS width FROM d UNION ALL SELECT 'rebased', count(y), round(avg(abs(reb - y)), 6), round(avg(reb - y), 6), round(avg(w * 2) FILTER (y IS NOT NULL), 6) FROM d")
def m16(spark, sf_dir):
    p = read(spark, sf_dir, "part").select(F.when(F.col("p_size") > 10, F.col("p_retailprice")).alias("y"), (F.col("p_size") + 900.0).alias("raw"), (F.col("p_size") + 950.0).alias("rebased"), "p_size")
    return model.back_test(p, "y", ["raw", "rebased"], "p_size").select("measure", "n", *[F.round(c, 6).alias(c) for c in ("mae", "bias", "width")])


@query("v02_lengths", "SELECT CASE WHEN vec_id % 10 = 0 THEN NULL WHEN vec_id % 10 = 1 THEN 3 ELSE len(embedding) END::INT AS length, count(*) AS n FROM embeddings GROUP BY 1")
def v02(spark, sf_dir):
    k = F.col("vec_id") % 10
    return vectors.lengths(read(spark, sf_dir, "embeddings").select(F.when(k == 1, F.slice("embedding", 1, 3)).when(k != 0, F.col("embedding")).alias("e")), "e")


# ---- documents


@query("d01_html_edges", "SELECT page_id, 'a & b é \"q\" < ' || page_id AS text FROM pages")
def d01_edges(spark, sf_dir):
    html = F.concat(F.lit("<p>a &amp; b</p><!-- x > y --><SCRIPT type='t'>var a = '</p>';</script ><style>p{}</style>\n&#233;&nbsp;&quot;q&quot; &lt;\t<br/>"), F.col("page_id").cast("string"))
    return read(spark, sf_dir, "pages").select("page_id", documents.html_to_text(html).alias("text"))


@query("d01_references", "SELECT page_id, 'ä€😀 &#x; �&#y7; &amp; & <b> ' || page_id || ' x' AS text FROM pages")
def d01_references(spark, sf_dir):
    """References of any size and base, those that are none, and tags whose attributes hold a closing mark."""
    html = F.concat(F.lit("<a title=\"x > y\" href='>'>&#228;&#x20AC;&#x1F600; &#x; &#55296;&#y7; &#38;amp; &#x26; &lt;b&gt; </a >"), F.col("page_id").cast("string"), F.lit("<p class='a>b'\n>&#160;x</p>"))
    return read(spark, sf_dir, "pages").select("page_id", documents.html_to_text(html).alias("text"))


_REFERENCES = r"""replace(replace(replace(replace(replace(replace(x, '&nbsp;', ' '), '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&copy;', '©'), '&middot;', '·')"""


@query("d01_whole_pages", rf"""WITH t AS (SELECT page_id, regexp_replace(regexp_replace(regexp_replace(html, '(?s)<!--.*?-->', ' ', 'g'), '(?is)<(script|style)\b[^>]*>.*?</(script|style)\s*>', ' ', 'g'), '(?s)<[A-Za-z/!?](?:[^''">]|"[^"]*"|''[^'']*'')*>', ' ', 'g') AS x FROM pages)
SELECT page_id, trim(regexp_replace(replace({_REFERENCES}, '&amp;', '&'), '[\s\x{{00a0}}]+', ' ', 'g')) AS text FROM t""")
def d01_whole(spark, sf_dir):
    """The whole text of each page."""
    return read(spark, sf_dir, "pages").select("page_id", documents.html_to_text(F.col("html")).alias("text"))


@query("d01_pages_as_text", r"SELECT page_id, length(replace(trim(regexp_replace(regexp_replace(regexp_replace(regexp_replace(html, '(?s)<!--.*?-->', ' ', 'g'), '(?is)<(script|style)\b[^>]*>.*?</(script|style)\s*>', ' ', 'g'), '(?s)<[^>]*>', ' ', 'g'), '[\s\x{00a0}]+', ' ', 'g')), '&', '')) > 0 AS has_text FROM pages")
def d01_pages(spark, sf_dir):
    return read(spark, sf_dir, "pages").select("page_id", (F.length(documents.html_to_text(F.col("html"))) > 0).alias("has_text"))


@query("d02_page_documents", "SELECT page_id, '# T' || page_id || chr(10) || chr(10) || CASE WHEN page_id % 2 = 0 THEN 'md' ELSE 'clean' END || CASE WHEN page_id % 3 = 0 THEN chr(10) || chr(10) || 'Tables:' || chr(10) || 'a | ' || page_id || chr(10) || 'c | d' ELSE '' END AS content FROM pages")
def d02_pages(spark, sf_dir):
    k = F.col("page_id")
    tables = F.when(k % 3 == 0, F.array(F.array(F.array(F.lit("a"), k.cast("string")), F.array(F.lit("c"), F.lit("d")))))
    return read(spark, sf_dir, "pages").select("page_id", documents.page_document(F.concat(F.lit("T"), k), F.when(k % 2 == 0, "md").otherwise(" "), F.lit("clean"), tables).alias("content"))


@query("d03_element_documents", "WITH o AS (SELECT o_custkey, o_orderkey, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) - 1 AS pos FROM orders) SELECT CASE WHEN o_orderkey % 4 = 0 THEN o_custkey || '_' || pos ELSE 'order-' || o_orderkey END AS id, 'text ' || o_orderkey AS content FROM o WHERE o_orderkey % 5 <> 0")
def d03(spark, sf_dir):
    k = F.col("o_orderkey")
    one = F.struct(k.alias("k"), F.when(k % 4 != 0, F.concat(F.lit("https://x.org/kita/order-"), k, F.lit("/?a=1"))).alias("url"), F.when(k % 5 != 0, F.concat(F.lit(" text "), k)).otherwise(" ").alias("text"))
    o = read(spark, sf_dir, "orders").groupBy("o_custkey").agg(F.array_sort(F.collect_list(one)).alias("all"))
    return documents.element_documents(o, "o_custkey", "all", "url", "text").select("id", "content")


@query("d04_narratives", "SELECT s_suppkey, s_name || ': theft ' || (s_suppkey % 50) || ' (' || CASE WHEN s_suppkey % 30 >= 15 THEN '+' ELSE '' END || printf('%.1f', (s_suppkey % 30 - 15)::DOUBLE) || ' %)' || CASE WHEN s_suppkey % 4 <> 0 THEN '; fraud ' || s_nationkey ELSE '' END AS narrative, 'theft ' || CASE WHEN s_suppkey % 30 - 15 > 10 THEN 'rose clearly' WHEN s_suppkey % 30 - 15 < -10 THEN 'fell clearly' ELSE 'stayed about the same' END AS trend FROM supplier")
def d04(spark, sf_dir):
    k = F.col("s_suppkey")
    pct = (k % 30 - 15).cast("double")
    return read(spark, sf_dir, "supplier").select("s_suppkey", documents.metric_narrative(F.col("s_name"), [("theft", k % 50, pct), ("fraud", F.when(k % 4 != 0, F.col("s_nationkey")), F.lit(None).cast("double"))]).alias("narrative"), documents.trend_sentence(F.lit("theft"), pct).alias("trend"))


@query("d05_station_documents", "SELECT p_partkey, 'Counting station ' || p_name || '.' || CASE WHEN p_size % 2 = 0 THEN ' It is in ' || p_brand || '.' ELSE '' END || ' On average: ' || p_size || ' cars' || CASE WHEN p_size % 3 = 0 THEN ', 7 bikes' ELSE '' END || ' an hour.' AS content FROM part")
def d05(spark, sf_dir):
    n = F.col("p_size")
    return read(spark, sf_dir, "part").select("p_partkey", documents.station_document(F.col("p_name"), F.when(n % 2 == 0, F.col("p_brand")), [("cars", n.cast("double")), ("bikes", F.when(n % 3 == 0, 7.2))]).alias("content"))


@query("d06_descriptions", "SELECT p_partkey, concat_ws(' ', p_name || ' is a ' || CASE WHEN p_size <= 15 THEN 'small' WHEN p_size <= 35 THEN 'middling' ELSE 'large' END || ' school.', CASE WHEN p_size % 2 = 0 THEN 'It is run by ' || p_brand || '.' END) AS text FROM part")
def d06(spark, sf_dir):
    n = F.col("p_size")
    first = F.concat("p_name", F.lit(" is a "), documents.size_phrase(n, [(15, "small"), (35, "middling")], "large"), F.lit(" school."))
    return read(spark, sf_dir, "part").select("p_partkey", documents.description([first, F.when(n % 2 == 0, F.concat(F.lit("It is run by "), "p_brand", F.lit(".")))]).alias("text"))


@query("d07_ratio_sentences", "SELECT p_partkey, CASE WHEN p_size % 3 = 0 THEN p_name || ' has ' || p_size * 10 || ' pupils.' WHEN p_size % 3 = 1 THEN p_name || ' has ' || p_size * 10 || ' pupils and 13 teachers, a ratio of ' || printf('%.1f', p_size * 10 / 13.0::DOUBLE) || ' to 1.' END AS text FROM part")
def d07(spark, sf_dir):
    n = F.col("p_size")
    return read(spark, sf_dir, "part").select("p_partkey", documents.ratio_sentence(F.col("p_name"), F.when(n % 3 != 2, n * 10), F.when(n % 3 == 1, F.lit(13))).alias("text"))


@query("d08_fenced_json", "SELECT o_orderkey, CASE WHEN o_orderkey % 3 <> 0 THEN o_orderkey END AS fee, CASE WHEN o_orderkey % 3 <> 0 THEN 'EUR' END AS currency FROM orders")
def d08(spark, sf_dir):
    k = F.col("o_orderkey").cast("string")
    text = F.when(F.col("o_orderkey") % 3 == 0, "no json here").otherwise(F.concat(F.lit("So:\n```json\n{\"fee\": "), k, F.lit(",\n}\n```\nthat is it")))
    record = documents.fenced_json(text, "fee bigint, currency string", {"currency": "EUR"})
    return read(spark, sf_dir, "orders").select("o_orderkey", record.alias("r")).select("o_orderkey", "r.fee", "r.currency")


_STREETS = "CASE c_custkey % 4 WHEN 0 THEN 'Langer Weg' WHEN 1 THEN 'Am Alten Markt' WHEN 2 THEN 'Straße des 17. Juni' ELSE 'Berliner Str.' END || ' ' || c_custkey || CASE WHEN c_custkey % 5 = 0 THEN 'a' ELSE '' END || ', 10115 Berlin'"


@query("d09_addresses", f"SELECT c_custkey, CASE c_custkey % 3 WHEN 0 THEN {_STREETS} WHEN 1 THEN '28195 Bremen' END AS address, CASE c_custkey % 3 WHEN 0 THEN 'https://x.org/a-b/' WHEN 1 THEN 'www.y.de/z' END AS website FROM customer")
def d09(spark, sf_dir):
    k = F.col("c_custkey")
    text = F.when(k % 3 == 0, F.concat(F.lit("Kita. "), F.expr(_STREETS), F.lit(", see www.no.de or https://x.org/a-b/."))).when(k % 3 == 1, "in 28195 Bremen, www.y.de/z, 12 rooms").otherwise("nothing 123")
    return read(spark, sf_dir, "customer").select("c_custkey", documents.address_of(text).alias("address"), documents.website_of(text).alias("website"))


@query("d10_ranked_lists", "SELECT s_suppkey, unnest([1, 3]) AS rank, unnest(['Alpha Schule', 'Beta']) AS name, unnest([1.9, 2.25])::DOUBLE AS grade FROM supplier")
def d10(spark, sf_dir):
    text = F.concat(F.lit("Best: 1. Alpha Schule 1,9 2. Odd 9,9 3. Beta 2.25 of "), F.col("s_name"))
    return read(spark, sf_dir, "supplier").select("s_suppkey", F.explode(documents.ranked_list(text)).alias("r")).select("s_suppkey", "r.rank", "r.name", "r.grade")


# ---- streams


@query("r01_stream", "SELECT date_trunc('hour', ts) AS hour, event_type, round(avg(value), 6) AS mean_value, count(*) AS n FROM events GROUP BY 1, 2")
def r01_stream(spark, sf_dir):
    """The hourly means as a file stream that has read all there is."""
    path, name = scratch(spark), f"hourly_{uuid.uuid4().hex}"
    read(spark, sf_dir, "events").select(F.col("ts").cast("timestamp").alias("ts"), "event_type", "value").write.parquet(f"{path}/in")
    stream = spark.readStream.schema("ts timestamp, event_type string, value double").parquet(f"{path}/in")
    q = rolling.hourly(stream, "ts", "event_type", "value").writeStream.outputMode("complete").format("memory").queryName(name).option("checkpointLocation", f"{path}/c").trigger(availableNow=True).start()
    q.awaitTermination()
    return spark.table(name).select(F.col("hour").cast("timestamp_ntz").alias("hour"), "event_type", F.round("mean_value", 6).alias("mean_value"), "n")


@query("r01_append", "WITH b AS (SELECT max(ts) AS last FROM events), h AS (SELECT date_trunc('hour', ts) AS hour, event_type, round(avg(value), 6) AS mean_value, count(*) AS n FROM events GROUP BY 1, 2) SELECT h.* FROM h, b WHERE hour + INTERVAL 1 HOUR <= last - INTERVAL 2 HOUR")
def r01_append(spark, sf_dir):
    """Three files, one batch each: the first half of the events; the second; the first day's again, with other values, by then too
    late. Hours go to a folder of files once the watermark has passed them, and their state with them."""
    path = scratch(spark)
    e = read(spark, sf_dir, "events").select(F.col("ts").cast("timestamp").alias("ts"), "event_type", "value")
    ends = e.agg(F.min("ts").alias("_a"), F.timestamp_seconds((F.min("ts").cast("double") + F.max("ts").cast("double")) / 2).alias("_m"))
    e = e.join(F.broadcast(ends))
    early = e.where(F.col("ts") < F.col("_a") + F.expr("interval 1 day")).withColumn("value", F.col("value") + 1000)
    for part in (e.where("ts < _m"), e.where("ts >= _m"), early):
        part.select("ts", "event_type", "value").coalesce(1).write.mode("append").parquet(f"{path}/in")
    stream = spark.readStream.schema("ts timestamp, event_type string, value double").option("maxFilesPerTrigger", 1).parquet(f"{path}/in")
    rolling.hourly_stream(rolling.hourly(stream, "ts", "event_type", "value"), f"{path}/out", f"{path}/c", once=True).awaitTermination()
    out = spark.read.schema("hour timestamp, event_type string, mean_value double, n bigint").parquet(f"{path}/out")
    return out.select(F.col("hour").cast("timestamp_ntz").alias("hour"), "event_type", F.round("mean_value", 6).alias("mean_value"), "n")


@query("r02_upsert_stream", "SELECT c_custkey, 'c_name' AS field, CASE WHEN c_custkey % 2 = 0 THEN 'first' ELSE 'second' END AS value FROM customer WHERE c_custkey % 3 = 0")
def r02(spark, sf_dir):
    """Two files, one batch each: the first fills the even keys, the second would fill all, but only odd ones are still empty."""
    path, c = scratch(spark), read(spark, sf_dir, "customer").select("c_custkey", "c_name")
    target = c.withColumn("c_name", F.when(F.col("c_custkey") % 3 != 0, F.col("c_name")))
    for part, value in ((c.where("c_custkey % 2 = 0"), "first"), (c, "second")):
        part.withColumn("c_name", F.lit(value)).coalesce(1).write.mode("append").parquet(f"{path}/in")
        stream = spark.readStream.schema("c_custkey bigint, c_name string").parquet(f"{path}/in")
        rolling.upsert_stream(stream, target, "c_custkey", ["c_name"], f"{path}/out", f"{path}/c", once=True).awaitTermination()
    return spark.read.option("basePath", f"{path}/out").parquet(f"{path}/out").select("c_custkey", "field", "value")
