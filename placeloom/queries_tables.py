"""Queries of joins, aggregates, ranks, sets of rows, filling and conforming."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType, StringType, StructField, StructType

from placeloom.operators import aggregates, conform, fill, joins, ranks, rows
from placeloom.plans.sites import read
from placeloom.queries_values import Given
from placeloom.registry import query

# ---- joins


@query("j02_additive", "SELECT c_custkey, c_name, c_acctbal, n_name, n_regionkey FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey")
def j02(spark, sf_dir):
    c = read(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_acctbal", F.col("c_nationkey").alias("n_nationkey"))
    return joins.additive(c, read(spark, sf_dir, "nation").withColumn("c_name", F.lit("never taken")), ["n_nationkey"]).drop("n_nationkey")


@query("j03_replacing", "SELECT s_suppkey, n_name AS area_n_name, n_regionkey AS area_n_regionkey FROM supplier LEFT JOIN nation ON s_nationkey = n_nationkey")
def j03(spark, sf_dir):
    s = read(spark, sf_dir, "supplier").select("s_suppkey", F.col("s_nationkey").alias("n_nationkey"), F.lit("old").alias("area_n_name"), F.lit(1).alias("area_old"))
    return joins.replacing(s, read(spark, sf_dir, "nation"), ["n_nationkey"], "area_").drop("n_nationkey")


@query("j04_full_periods", "WITH y AS (SELECT o_custkey, year(o_orderdate) AS y, count(*) AS n, round(sum(o_totalprice), 2) AS v FROM orders GROUP BY 1, 2) SELECT coalesce(a.o_custkey, b.o_custkey) AS o_custkey, a.n AS n_1996, a.v AS v_1996, b.n AS n_1997, b.v AS v_1997 FROM (SELECT * FROM y WHERE y = 1996) a FULL JOIN (SELECT * FROM y WHERE y = 1997) b ON a.o_custkey = b.o_custkey")
def j04(spark, sf_dir):
    o = read(spark, sf_dir, "orders")
    by_year = lambda y: o.where(F.year("o_orderdate") == y).groupBy("o_custkey").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("o_totalprice"), 2).alias("v"))
    return joins.full_periods({"1996": by_year(1996), "1997": by_year(1997)}, ["o_custkey"])


@query("j05_better_key", "SELECT c_custkey, n_name FROM customer LEFT JOIN nation ON c_custkey % 25 = n_nationkey")
def j05_better(spark, sf_dir):
    c = read(spark, sf_dir, "customer").withColumn("k1", F.when(F.col("c_custkey") % 4 == 0, F.col("c_nationkey"))).withColumn("k2", F.col("c_custkey") % 25)
    return joins.better_key(c, read(spark, sf_dir, "nation"), ("k1", "n_nationkey"), ("k2", "n_nationkey"), ["n_name"]).select("c_custkey", "n_name")


_TOKENS = "WITH p AS (SELECT p_partkey, p_brand, p_name, string_split(p_name, ' ') AS w FROM part), m AS (SELECT a.p_partkey, b.p_partkey AS match_key, CASE WHEN contains(a.p_name, b.p_name) OR contains(b.p_name, a.p_name) THEN 1.0 ELSE len(list_intersect(a.w, b.w)) / least(len(list_distinct(a.w)), len(list_distinct(b.w)))::DOUBLE END AS score FROM p a JOIN p b ON a.p_brand = b.p_brand AND a.p_partkey < b.p_partkey), r AS (SELECT *, row_number() OVER (PARTITION BY p_partkey ORDER BY score DESC, match_key) AS n FROM m WHERE score >= 0.7) SELECT p_partkey, match_key, round(score, 6)::DOUBLE AS score FROM r WHERE n = 1"


@query("j06_token_match", _TOKENS)
def j06(spark, sf_dir):
    p = read(spark, sf_dir, "part").select("p_partkey", "p_brand", "p_name")
    other = p.select("p_brand", F.col("p_partkey").alias("match_key"), F.col("p_name").alias("match_name"))
    found = joins.token_match(p, other, ["p_brand"], "p_name", "match_name", "p_partkey", "match_key", 0.7, joins.LATER)
    return found.select("p_partkey", "match_key", F.round("score", 6).alias("score"))


@query("j09_dual_grain", "WITH f AS (SELECT c_nationkey AS k, count(*) AS n FROM customer WHERE c_nationkey % 2 = 0 GROUP BY 1), g AS (SELECT n_regionkey AS r, count(*) AS n_nations FROM nation GROUP BY 1) SELECT s_suppkey, f.n, n_nations AS area_n_nations, f.n IS NOT NULL AS has_fine FROM supplier JOIN nation ON s_nationkey = n_nationkey LEFT JOIN f ON f.k = s_nationkey LEFT JOIN g ON g.r = n_regionkey")
def j09(spark, sf_dir):
    s, n, c = (read(spark, sf_dir, t) for t in ("supplier", "nation", "customer"))
    base = s.select("s_suppkey", F.col("s_nationkey").alias("n_nationkey")).join(n.select("n_nationkey", "n_regionkey"), "n_nationkey")
    fine = c.where("c_nationkey % 2 = 0").groupBy(F.col("c_nationkey").alias("n_nationkey")).agg(F.count(F.lit(1)).alias("n"))
    coarse = n.groupBy("n_regionkey").agg(F.count(F.lit(1)).alias("n_nations"))
    return joins.dual_grain(base, fine, ["n_nationkey"], coarse, ["n_regionkey"]).select("s_suppkey", "n", "area_n_nations", "has_fine")


@query("j10_constants", "SELECT s_suppkey, g.n AS city_n, round(g.m, 6) AS city_m FROM supplier CROSS JOIN (SELECT count(*) AS n, avg(c_acctbal) AS m FROM customer) g")
def j10(spark, sf_dir):
    row = read(spark, sf_dir, "customer").agg(F.count(F.lit(1)).alias("n"), F.round(F.avg("c_acctbal"), 6).alias("m"))
    return joins.with_constants(read(spark, sf_dir, "supplier").select("s_suppkey"), row, "city_")


@query("j11_stop_routes", "SELECT DISTINCT l_suppkey AS stop_id, c_nationkey AS route_id, n_name AS route_name FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey")
def j11(spark, sf_dir):
    """Stops are suppliers, trips orders, routes the nations of those who order."""
    trips = read(spark, sf_dir, "orders").join(read(spark, sf_dir, "customer"), F.col("o_custkey") == F.col("c_custkey")).select(F.col("o_orderkey").alias("trip_id"), F.col("c_nationkey").alias("route_id"))
    times = read(spark, sf_dir, "lineitem").select(F.col("l_suppkey").alias("stop_id"), F.col("l_orderkey").alias("trip_id"))
    routes = read(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("route_id"), F.col("n_name").alias("route_name"))
    return joins.stop_routes(times, trips, routes).select("stop_id", "route_id", "route_name")


_CELL = "p_partkey % 40 AS e, p_partkey // 40 AS n"


@query("j12_aligned_grid", f"WITH c AS (SELECT {_CELL}, p_size, p_retailprice FROM part) SELECT c.e, c.n, c.p_size AS population, CASE WHEN c.p_size % 3 = 0 THEN c.p_retailprice END AS rent, CASE WHEN c.p_size % 2 = 0 THEN c.p_size * 2 END AS age FROM c")
def j12(spark, sf_dir):
    c = read(spark, sf_dir, "part").selectExpr("p_partkey % 40 AS e", "p_partkey div 40 AS n", "p_size", "p_retailprice")
    rent = c.where("p_size % 3 = 0").select("e", "n", F.col("p_retailprice").alias("rent"))
    age = c.where("p_size % 2 = 0").select("e", "n", (F.col("p_size") * 2).alias("age"))
    return joins.aligned([rent, c.select("e", "n", F.col("p_size").alias("population")), age], ["e", "n"]).select("e", "n", "population", "rent", "age")


_OFFERED = "CASE c_custkey % 4 WHEN 0 THEN c_name WHEN 1 THEN 'Very HOT bolt ' || c_custkey WHEN 2 THEN 'late' ELSE 'ot bolt' END"


@query("j13_append_unlike", f"WITH b AS (SELECT DISTINCT lower(p_name) AS x FROM part), m AS (SELECT c_custkey AS k, {_OFFERED} AS nm FROM customer), d AS (SELECT DISTINCT lower(nm) AS y FROM m), w AS (SELECT DISTINCT y FROM d JOIN b ON x = y OR (length(x) >= 5 AND contains(y, x)) OR (length(y) >= 5 AND contains(x, y))) SELECT p_partkey AS k, p_name AS nm FROM part UNION ALL SELECT k, nm FROM m WHERE lower(nm) NOT IN (SELECT y FROM w)")
def j13_unlike(spark, sf_dir):
    base = read(spark, sf_dir, "part").select(F.col("p_partkey").alias("k"), F.col("p_name").alias("nm"))
    return joins.append_unlike(base, read(spark, sf_dir, "customer").select(F.col("c_custkey").alias("k"), F.expr(_OFFERED).alias("nm")), "nm")


@query("j14_same_period_before", "WITH y AS (SELECT c_nationkey AS region, year(o_orderdate) AS y, count(*) AS v FROM orders JOIN customer ON o_custkey = c_custkey WHERE (c_nationkey + year(o_orderdate)) % 7 <> 0 GROUP BY 1, 2) SELECT a.region, a.y::INT AS y, a.v - b.v AS change, CASE WHEN b.v > 0 THEN round((a.v - b.v) / b.v::DOUBLE * 100, 6) END AS change_pct FROM y a LEFT JOIN y b ON a.region = b.region AND a.y = b.y + 1")
def j14(spark, sf_dir):
    o = read(spark, sf_dir, "orders").join(read(spark, sf_dir, "customer"), F.col("o_custkey") == F.col("c_custkey"))
    years = o.groupBy(F.col("c_nationkey").alias("region"), F.year("o_orderdate").alias("y")).agg(F.count(F.lit(1)).alias("v")).where("(region + y) % 7 <> 0")
    return joins.change_on(years, ["region"], "y", "v").select("region", "y", "change", F.round("change_pct", 6).alias("change_pct"))


@query("j15_known_in_all", "SELECT c_custkey FROM customer WHERE c_custkey IN (SELECT o_custkey FROM orders) AND c_custkey IN (SELECT vec_id FROM embeddings)")
def j15(spark, sf_dir):
    o, e = read(spark, sf_dir, "orders").select(F.col("o_custkey").alias("c_custkey")), read(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("c_custkey"))
    return joins.known_in_all(read(spark, sf_dir, "customer").select("c_custkey"), [o, e], "c_custkey")


@query("j16_updated_columns", "SELECT vec_id, CASE WHEN vec_id % 3 = 0 THEN (vec_id % 10)::INT ELSE label END AS label, embedding[1] AS first_number FROM embeddings")
def j16(spark, sf_dir):
    e = read(spark, sf_dir, "embeddings")
    news = e.select("vec_id", F.when(F.col("vec_id") % 3 == 0, (F.col("vec_id") % 10).cast("int")).alias("label"))
    return fill.updated_columns(e, news.union(news), "vec_id", ["label"]).select("vec_id", "label", F.get("embedding", F.lit(0)).alias("first_number"))


@query("j17_latest_value", "SELECT p_partkey, CASE WHEN p_size % 2 = 0 THEN p_size WHEN p_size % 3 = 0 THEN p_size + 1000 END AS value, CASE WHEN p_size % 2 = 0 THEN 2024 WHEN p_size % 3 = 0 THEN 2019 END AS year FROM part")
def j17(spark, sf_dir):
    p = read(spark, sf_dir, "part").select("p_partkey", F.when(F.col("p_size") % 2 == 0, F.col("p_size")).alias("v2024"), F.when(F.col("p_size") % 3 == 0, F.col("p_size") + 1000).alias("v2019"))
    value, year = joins.latest_value([(2019, "v2019"), (2024, "v2024")])
    return p.select("p_partkey", value.alias("value"), year.alias("year"))


@query("j08_empty_constants", "SELECT s_suppkey, n.v AS mean_balance, CASE WHEN n.v IS NOT NULL THEN 'nation' END AS data_source FROM supplier LEFT JOIN (SELECT c_nationkey, round(avg(c_acctbal), 6) AS v FROM customer WHERE c_nationkey % 3 = 0 GROUP BY 1) n ON n.c_nationkey = s_nationkey")
def j08_empty(spark, sf_dir):
    """A level for all that has no row leaves the base's rows as they are."""
    c = read(spark, sf_dir, "customer").withColumnRenamed("c_nationkey", "s_nationkey")
    mean = F.round(F.avg("c_acctbal"), 6).alias("mean_balance")
    levels = [("nation", c.where("s_nationkey % 3 = 0").groupBy("s_nationkey").agg(mean), ["s_nationkey"]), ("all", c.agg(mean).where("false"), [])]
    return joins.cascade(read(spark, sf_dir, "supplier"), levels, ["mean_balance"]).select("s_suppkey", "mean_balance", "data_source")


# ---- aggregates


@query("a01_override", "WITH a AS (SELECT l_suppkey, avg(l_quantity) AS q, avg(l_discount) AS d FROM lineitem GROUP BY 1), b AS (SELECT l_suppkey, avg(l_quantity) AS q FROM lineitem WHERE l_suppkey % 2 = 0 AND l_returnflag = 'R' GROUP BY 1) SELECT l_suppkey, round(coalesce(b.q, a.q), 6) AS q, round(a.d, 6) AS d FROM a LEFT JOIN b USING (l_suppkey)")
def a01(spark, sf_dir):
    lines = read(spark, sf_dir, "lineitem").select("l_suppkey", F.col("l_quantity").alias("q"), F.col("l_discount").alias("d"), "l_returnflag")
    out = aggregates.means_with_override(lines, lines.where("l_suppkey % 2 = 0 and l_returnflag = 'R'"), "l_suppkey", ["q", "d"], "q")
    return out.select("l_suppkey", F.round("q", 6).alias("q"), F.round("d", 6).alias("d"))


@query("a03_sums", "SELECT l_suppkey, sum(l_linenumber)::BIGINT AS a, coalesce(sum(CASE WHEN l_suppkey % 2 = 0 THEN l_linenumber END), 0)::BIGINT AS b, (sum(l_linenumber) + coalesce(sum(CASE WHEN l_suppkey % 2 = 0 THEN l_linenumber END), 0))::BIGINT AS total FROM lineitem GROUP BY 1")
def a03(spark, sf_dir):
    lines = read(spark, sf_dir, "lineitem").select("l_suppkey", F.col("l_linenumber").alias("a"), F.when(F.col("l_suppkey") % 2 == 0, F.col("l_linenumber")).alias("b"))
    return aggregates.summed(lines, "l_suppkey", ["a", "b"])


@query("a05_priority", "SELECT o_custkey, arg_min(o_orderpriority, CASE o_orderpriority WHEN '2-HIGH' THEN '1' WHEN '1-URGENT' THEN '2' ELSE '3' || o_orderpriority END) AS o_orderpriority FROM orders GROUP BY 1")
def a05_priority(spark, sf_dir):
    return aggregates.by_priority(read(spark, sf_dir, "orders"), ["o_custkey"], "o_orderpriority", ["2-HIGH", "1-URGENT"])


@query("a07_tally", "SELECT o_custkey, count(*)::INT AS n_items, count(*) FILTER (o_orderstatus IN ('F', 'P'))::INT AS done, count(*) FILTER (o_orderstatus = 'O')::INT AS open FROM orders GROUP BY 1")
def a07(spark, sf_dir):
    kinds = read(spark, sf_dir, "orders").groupBy("o_custkey").agg(F.collect_list("o_orderstatus").alias("kinds"))
    return aggregates.tally(kinds, "o_custkey", "kinds", {"done": ["F", "P"], "open": ["O"]})


@query("a08_first_value", "SELECT o_custkey, min(o_orderkey) FILTER (o_orderstatus = 'F') AS \"F\", min(o_orderkey) FILTER (o_orderstatus = 'O') AS \"O\" FROM orders GROUP BY 1")
def a08_first(spark, sf_dir):
    return aggregates.wide(read(spark, sf_dir, "orders"), ["o_custkey"], "o_orderstatus", "o_orderkey", ["F", "O"], order="o_orderkey")


@query("a08_newest_filled", "SELECT 'y2023' AS newest, count(*) AS n FROM customer")
def a08_newest(spark, sf_dir):
    c = read(spark, sf_dir, "customer").select(F.col("c_acctbal").alias("y2022"), F.when(F.col("c_custkey") >= 0, 1).alias("y2023"), F.when(F.col("c_custkey") < 5, 1).alias("y2024"))
    return aggregates.newest_filled(c, ["y2022", "y2023", "y2024"]).crossJoin(c.agg(F.count(F.lit(1)).alias("n")))


@query("a09_latest_totals", "WITH l AS (SELECT c_nationkey AS region, count(*) AS total, count(*) FILTER (o_orderstatus = 'F') AS cleared FROM orders JOIN customer ON o_custkey = c_custkey WHERE year(o_orderdate) = (SELECT max(year(o_orderdate)) FROM orders) GROUP BY 1) SELECT region, total, CASE WHEN region % 5 <> 0 THEN round(total * 100000.0::DOUBLE / (1000 + region * 10), 2) END AS rate, round(cleared * 100.0::DOUBLE / total, 2) AS cleared_pct FROM l")
def a09(spark, sf_dir):
    o = read(spark, sf_dir, "orders").join(read(spark, sf_dir, "customer"), F.col("o_custkey") == F.col("c_custkey"))
    years = o.groupBy(F.col("c_nationkey").alias("region"), F.year("o_orderdate").alias("y")).agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("o_orderstatus") == "F").alias("done"))
    people = read(spark, sf_dir, "nation").where("n_nationkey % 5 <> 0").select(F.col("n_nationkey").alias("region"), (1000 + F.col("n_nationkey") * 10).alias("people"))
    return aggregates.latest_totals(years, people, "region", "y", "n", "done", "people")


@query("a10_of_maximum", "SELECT s_suppkey, round(s_acctbal / (SELECT max(s_acctbal) FROM supplier) * 10, 6) AS share FROM supplier")
def a10(spark, sf_dir):
    return aggregates.of_maximum(read(spark, sf_dir, "supplier"), "s_acctbal", "share").select("s_suppkey", F.round("share", 6).alias("share"))


@query("a11_inverted_range", "WITH s AS (SELECT s_suppkey, round((max(s_acctbal) OVER () - s_acctbal) / (max(s_acctbal) OVER () - min(s_acctbal) OVER ()) * 100, 6) AS score FROM supplier) SELECT *, CASE WHEN score <= 33 THEN 'low' WHEN score <= 66 THEN 'middle' ELSE 'high' END AS score_band, 50.0::DOUBLE AS flat FROM s")
def a11(spark, sf_dir):
    s = aggregates.inverted_range(read(spark, sf_dir, "supplier"), "s_acctbal", "score", [(33, "low"), (66, "middle")], "high")
    s = aggregates.inverted_range(s.withColumn("one", F.lit(1)), "one", "flat", [(50, "x")], "y")
    return s.select("s_suppkey", F.round("score", 6).alias("score"), "score_band", "flat")


@query("a12_five_bands", "WITH s AS (SELECT avg(c_acctbal) AS m, stddev_samp(c_acctbal) AS d FROM customer), z AS (SELECT c_custkey, (c_acctbal - m) / d AS z FROM customer, s) SELECT c_custkey, 'c_acctbal' AS metric, round(z, 6) AS z, CASE WHEN z < -1.5 THEN 'very low' WHEN z < -0.5 THEN 'low' WHEN z < 0.5 THEN 'middle' WHEN z < 1.5 THEN 'high' ELSE 'very high' END AS band FROM z")
def a12_bands(spark, sf_dir):
    c = read(spark, sf_dir, "customer").withColumn("rare", F.when(F.col("c_custkey") < 3, F.col("c_acctbal")))
    out = aggregates.z_scores(c, ["rare", "c_acctbal"], [(-1.5, "very low"), (-0.5, "low"), (0.5, "middle"), (1.5, "high")], "very high")
    return out.select("c_custkey", "metric", F.round("z", 6).alias("z"), "band")


@query("a13_averages", "SELECT c_nationkey AS area, round(avg(c_acctbal), 6) AS mean FROM customer GROUP BY 1 UNION ALL SELECT NULL, round(avg(c_acctbal), 6) FROM customer")
def a13(spark, sf_dir):
    of_area, of_all = aggregates.averages(read(spark, sf_dir, "customer"), "c_nationkey", ["c_acctbal"])
    return of_area.select(F.col("c_nationkey").alias("area"), F.round("c_acctbal", 6).alias("mean")).union(of_all.select(F.lit(None).cast("int"), F.round("c_acctbal", 6)))


@query("a14_summary", "SELECT o_orderstatus, o_orderpriority, count(*) AS n, count(DISTINCT o_custkey) AS customers, min(o_orderkey) AS first_order FROM orders GROUP BY 1, 2")
def a14(spark, sf_dir):
    return aggregates.summary(read(spark, sf_dir, "orders"), ["o_orderstatus", "o_orderpriority"], customers=F.count_distinct("o_custkey"), first_order=F.min("o_orderkey"))


@query("a14_cross_tab", "SELECT o_orderpriority, count(*) FILTER (o_orderstatus = 'F') AS \"F\", count(*) FILTER (o_orderstatus = 'O') AS \"O\" FROM orders GROUP BY 1")
def a14_tab(spark, sf_dir):
    return aggregates.cross_tab(read(spark, sf_dir, "orders"), "o_orderpriority", "o_orderstatus", ["F", "O"])


@query("a15_manifest", "SELECT 'filled' AS kind, 's_suppkey' AS name, count(s_suppkey) AS n FROM supplier UNION ALL SELECT 'filled', 'kind', count(*) FILTER (s_suppkey % 3 <> 0) FROM supplier UNION ALL SELECT 'kind', CASE s_suppkey % 3 WHEN 0 THEN '' WHEN 1 THEN 'a' ELSE 'b' END, count(*) FROM supplier GROUP BY 2")
def a15(spark, sf_dir):
    s = read(spark, sf_dir, "supplier").select("s_suppkey", F.when(F.col("s_suppkey") % 3 == 1, "a").when(F.col("s_suppkey") % 3 == 2, "b").alias("kind"))
    return aggregates.manifest(s, ["kind"])


# ---- ranks, sorts, candidates


@query("w01_rank_with_nulls", "SELECT c_custkey, CASE WHEN x IS NOT NULL THEN rank() OVER (ORDER BY x DESC NULLS LAST) END AS rank_min, CASE WHEN x IS NOT NULL THEN dense_rank() OVER (ORDER BY x DESC NULLS LAST) END AS rank_dense FROM (SELECT c_custkey, CASE WHEN c_custkey % 4 <> 0 THEN c_nationkey END AS x FROM customer)")
def w01(spark, sf_dir):
    c = read(spark, sf_dir, "customer").select("c_custkey", F.when(F.col("c_custkey") % 4 != 0, F.col("c_nationkey")).alias("x"))
    return ranks.ranked(c, "x", ascending=False).select("c_custkey", "rank_min", "rank_dense")


@query("w04_blank_and_rounded", "WITH k AS (SELECT s_suppkey, CASE WHEN s_suppkey % 3 = 0 THEN ' ' ELSE (s_nationkey % 5)::VARCHAR END AS k, round(s_acctbal / 1000)::BIGINT AS r, s_acctbal FROM supplier), n AS (SELECT *, row_number() OVER (PARTITION BY k, r ORDER BY s_acctbal DESC, s_suppkey) AS n FROM k) SELECT s_suppkey FROM n WHERE n = 1 OR trim(k) = ''")
def w04_blank(spark, sf_dir):
    s = read(spark, sf_dir, "supplier").withColumn("k", F.when(F.col("s_suppkey") % 3 == 0, " ").otherwise((F.col("s_nationkey") % 5).cast("string"))).withColumn("r", F.round(F.col("s_acctbal") / 1000).cast("long"))
    return ranks.keep_first(s, ["k", "r"], [F.desc("s_acctbal"), F.col("s_suppkey")], keep_blank=True).select("s_suppkey")


@query("w05_first_seen", "WITH a AS (SELECT 0 AS src, CASE WHEN s_suppkey % 4 = 0 THEN '' ELSE s_suppkey::VARCHAR END AS id, s_suppkey AS k FROM supplier UNION ALL SELECT 1, c_custkey::VARCHAR, c_custkey FROM customer), n AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY src, k) AS n FROM a) SELECT id, src AS source_no, k FROM n WHERE n = 1 OR id = ''")
def w05(spark, sf_dir):
    s = read(spark, sf_dir, "supplier").select(F.when(F.col("s_suppkey") % 4 == 0, "").otherwise(F.col("s_suppkey").cast("string")).alias("id"), F.col("s_suppkey").alias("k"))
    c = read(spark, sf_dir, "customer").select(F.col("c_custkey").cast("string").alias("id"), F.col("c_custkey").alias("k"))
    return ranks.first_seen([s, c], ["id"], [F.col("k")]).select("id", "source_no", "k")


@query("w07_rank_in_category", "SELECT p_partkey, row_number() OVER (PARTITION BY p_brand ORDER BY p_retailprice DESC, p_partkey) AS rank FROM part QUALIFY rank <= 5")
def w07(spark, sf_dir):
    return ranks.best_candidates(read(spark, sf_dir, "part"), ["p_brand"], "p_retailprice", "p_partkey", 5).select("p_partkey", F.col("rank").cast("long").alias("rank"))


@query("t01_extremes", "(SELECT o_orderkey, 'low' AS kind FROM orders ORDER BY o_totalprice, o_orderkey LIMIT 5) UNION ALL (SELECT o_orderkey, 'high' FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 5)")
def t01(spark, sf_dir):
    o = read(spark, sf_dir, "orders")
    return ranks.extremes(o, "o_totalprice", 5, tie="o_orderkey").select("o_orderkey", F.lit("low").alias("kind")).union(ranks.extremes(o, "o_totalprice", 5, largest=True, tie="o_orderkey").select("o_orderkey", F.lit("high")))


@query("t02_sorted_last", "SELECT o_orderkey, CASE WHEN o_orderkey % 5 <> 0 THEN o_totalprice END AS price FROM orders ORDER BY price DESC NULLS LAST, o_orderkey")
def t02(spark, sf_dir):
    o = read(spark, sf_dir, "orders").select("o_orderkey", F.when(F.col("o_orderkey") % 5 != 0, F.col("o_totalprice")).alias("price"))
    return ranks.sorted_last(o, [("price", False), ("o_orderkey", True)])


@query("t03_top_entries", "SELECT p_partkey, CASE WHEN p_size > 20 THEN 'size,low' ELSE 'low,size' END AS entries FROM part")
def t03(spark, sf_dir):
    m = F.create_map(F.lit("size"), F.col("p_size").cast("double"), F.lit("low"), F.lit(-20.0), F.lit("none"), F.lit(0.0))
    return read(spark, sf_dir, "part").select("p_partkey", F.array_join(F.transform(ranks.top_entries(m, 2), lambda e: e["key"]), ",").alias("entries"))


@query("t04_positive_candidates", "WITH s AS (SELECT page_id % 50 AS g, page_id, (CASE WHEN contains(lower(url), '/en/') THEN 3 ELSE 0 END - CASE WHEN contains(lower(url), '7') THEN 1 ELSE 0 END)::DOUBLE AS score FROM pages) SELECT page_id, row_number() OVER (PARTITION BY g ORDER BY score DESC, page_id) AS rank FROM s WHERE score > 0 QUALIFY rank <= 3")
def t04(spark, sf_dir):
    from placeloom.functions.values import pattern_score

    p = read(spark, sf_dir, "pages").select((F.col("page_id") % 50).alias("g"), "page_id", pattern_score(F.col("url"), [("/en/", 3), ("7", -1)]).alias("score"))
    return ranks.best_candidates(p, ["g"], "score", "page_id", 3).select("page_id", F.col("rank").cast("long").alias("rank"))


@query("t05_best_address", r"WITH h AS (SELECT page_id, url, lower(regexp_extract(url, '^[a-z]+://([^/:?#]+)', 1)) AS host FROM pages), s AS (SELECT page_id % 20 AS g, url, (CASE WHEN contains(lower(url), 'http') THEN 3 ELSE 0 END + CASE WHEN contains(lower(url), 'utm') THEN 2 ELSE 0 END)::DOUBLE AS score FROM h WHERE NOT (host = 'example.com' OR host LIKE '%.example.com')), r AS (SELECT *, row_number() OVER (PARTITION BY g ORDER BY score DESC, url) AS n FROM s WHERE score >= 3) SELECT g, url, score FROM r WHERE n = 1")
def t05(spark, sf_dir):
    p = read(spark, sf_dir, "pages").groupBy((F.col("page_id") % 20).alias("g")).agg(F.collect_set("url").alias("urls"))
    return ranks.best_address(p, "g", "urls", [("http", 3), ("utm", 2)], ["example.com"], 3.0)


# ---- sets of rows


@query("u01_union", "SELECT s_suppkey AS k, s_name AS name, NULL::VARCHAR AS segment FROM supplier UNION ALL SELECT c_custkey, NULL, c_mktsegment FROM customer")
def u01(spark, sf_dir):
    return rows.union_all(read(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("k"), F.col("s_name").alias("name")), read(spark, sf_dir, "customer").select(F.col("c_custkey").alias("k"), F.col("c_mktsegment").alias("segment")))


@query("u03_constant_rows", "SELECT n_nationkey, n_name FROM nation UNION ALL SELECT 99, 'ATLANTIS'")
def u03(spark, sf_dir):
    n = read(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    return rows.with_constants_rows(n, [(3, "never"), (99, "ATLANTIS")], ["n_nationkey", "n_name"], "n_nationkey")


@query("u04_two_classes", "SELECT p_partkey, 'primary' AS class, p_size BETWEEN 20 AND 30 AS shared FROM part WHERE p_size <= 30 UNION ALL SELECT p_partkey, 'secondary', p_size BETWEEN 20 AND 30 FROM part WHERE p_size BETWEEN 20 AND 45")
def u04(spark, sf_dir):
    return rows.one_row_per_class(read(spark, sf_dir, "part"), {"primary": F.col("p_size") <= 30, "secondary": F.col("p_size").between(20, 45)}).select("p_partkey", "class", "shared")


@query("u05_split", "SELECT p_partkey, p_size > 25 AS large FROM part WHERE p_size <> 25 UNION ALL SELECT p_partkey, false FROM part WHERE p_size = 25")
def u05(spark, sf_dir):
    large, other = rows.split_by(read(spark, sf_dir, "part"), F.when(F.col("p_size") != 25, F.col("p_size") > 25))
    return large.select("p_partkey", F.lit(True).alias("large")).union(other.select("p_partkey", F.lit(False)))


@query("u06_id_sets", "SELECT coalesce(a.k, b.k) AS k, CASE WHEN b.k IS NULL THEN 'left' WHEN a.k IS NULL THEN 'right' ELSE 'both' END AS place FROM (SELECT DISTINCT o_custkey AS k FROM orders) a FULL JOIN (SELECT c_custkey AS k FROM customer WHERE c_custkey % 2 = 0) b ON a.k = b.k")
def u06(spark, sf_dir):
    return rows.id_sets(read(spark, sf_dir, "orders").select(F.col("o_custkey").alias("k")), read(spark, sf_dir, "customer").where("c_custkey % 2 = 0").select(F.col("c_custkey").alias("k")), "k")


# ---- filling


GAPS = Given("customer", "c_custkey", "CASE WHEN c_custkey % 7 <> 0 THEN c_mktsegment END AS c_mktsegment", "CASE WHEN c_custkey % 5 = 0 THEN ' ' ELSE c_name END AS c_name")


def _twice(spark, sf_dir):
    """Each customer twice, the second with a larger segment text."""
    c = read(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment", "c_name")
    return c.union(c.withColumn("c_mktsegment", F.concat(F.col("c_mktsegment"), F.lit("2"))))


@query("k01_repeated_source", f"WITH g AS ({GAPS.sql}) SELECT g.c_custkey, coalesce(g.c_mktsegment, c.c_mktsegment) AS c_mktsegment, c.c_name, concat_ws(',', CASE WHEN g.c_custkey % 7 = 0 THEN 'raw:c_mktsegment' END, CASE WHEN g.c_custkey % 5 = 0 THEN 'second:c_name' END) AS filled_from FROM g JOIN customer c USING (c_custkey)")
def k01_twice(spark, sf_dir):
    first = fill.fill_gaps(GAPS.rows(spark, sf_dir), _twice(spark, sf_dir), "c_custkey", ["c_mktsegment"], "raw")
    return fill.fill_gaps(first, _twice(spark, sf_dir), "c_custkey", ["c_name", "c_mktsegment"], "second")


@query("k01_fill_counts", "SELECT 'raw' AS source, 'c_mktsegment' AS field, count(*) FILTER (c_custkey % 7 = 0) AS n FROM customer UNION ALL SELECT 'raw', 'c_name', count(*) FILTER (c_custkey % 5 = 0) FROM customer")
def k01_counts(spark, sf_dir):
    return fill.fill_counts(fill.fill_gaps(GAPS.rows(spark, sf_dir), _twice(spark, sf_dir), "c_custkey", ["c_mktsegment", "c_name"], "raw"))


@query("k02_overwrite", f"WITH g AS ({GAPS.sql}) SELECT c_custkey, CASE WHEN c_custkey % 2 = 0 THEN 'new' ELSE c_mktsegment END AS c_mktsegment, c_name FROM g")
def k02(spark, sf_dir):
    news = read(spark, sf_dir, "customer").select("c_custkey", F.when(F.col("c_custkey") % 2 == 0, "new").alias("c_mktsegment"))
    return fill.overwrite(GAPS.rows(spark, sf_dir), news, "c_custkey", ["c_mktsegment"])


@query("k03_consolidated", f"WITH g AS ({GAPS.sql}) SELECT c_custkey, coalesce(c_mktsegment, nullif(trim(c_name), '')) AS label FROM g")
def k03(spark, sf_dir):
    return fill.consolidated(GAPS.rows(spark, sf_dir), {"label": ["c_mktsegment", "c_name"]})


@query("k04_own_or_area", "WITH a AS (SELECT n_nationkey, n_regionkey * 1.5::DOUBLE AS v FROM nation WHERE n_nationkey % 4 <> 0) SELECT c_custkey, CASE WHEN c_custkey % 3 = 0 THEN c_acctbal ELSE v END AS rate, CASE WHEN c_custkey % 3 = 0 THEN 'own' WHEN v IS NOT NULL THEN 'area' END AS rate_source FROM customer LEFT JOIN a ON c_nationkey = n_nationkey")
def k04(spark, sf_dir):
    c = read(spark, sf_dir, "customer").select("c_custkey", F.col("c_nationkey").alias("n_nationkey"), F.when(F.col("c_custkey") % 3 == 0, F.col("c_acctbal")).alias("own"))
    areas = read(spark, sf_dir, "nation").where("n_nationkey % 4 <> 0").select("n_nationkey", (F.col("n_regionkey") * F.lit(1.5)).alias("v"))
    return fill.own_or_area(c, areas, "n_nationkey", "own", "v", "rate").select("c_custkey", "rate", "rate_source")


@query("k05_newest_pass", "SELECT event_id, CASE WHEN event_id % 3 = 0 THEN -1 WHEN event_id % 5 = 0 THEN NULL ELSE (props::JSON->>'k')::BIGINT END AS k FROM events")
def k05(spark, sf_dir):
    e = read(spark, sf_dir, "events").select("event_id", F.when(F.col("event_id") % 5 != 0, F.col("props")).otherwise("").alias("pass2"), F.when(F.col("event_id") % 3 == 0, '{"k": -1}').otherwise(" ").alias("pass3"))
    return fill.newest_pass(e, "event_id", ["pass2", "pass3"], "k bigint")


@query("k05_apply_cache", "SELECT event_id, CASE WHEN event_id % 4 = 0 THEN 7 WHEN event_id % 3 = 0 THEN event_id * 10 WHEN event_id % 5 = 0 THEN NULL ELSE event_id END::BIGINT AS fee, CASE WHEN event_id % 3 <> 0 AND event_id % 5 = 0 THEN NULL ELSE 'EUR' END AS currency, event_type FROM events")
def k05_apply(spark, sf_dir):
    """A fee that the table has stays; else that of the last pass that can be read; the currency is a new column. Rows without a cache stay."""
    e, k = read(spark, sf_dir, "events"), F.col("event_id")
    record = lambda n: F.concat(F.lit('{"fee": "'), n.cast("string"), F.lit('", "currency": "EUR"}'))
    cache = e.where("event_id % 3 = 0 or event_id % 5 <> 0").select("event_id", F.when(k % 3 != 0, record(k)).alias("pass2"), F.when(k % 3 == 0, record(k * 10)).when(k % 2 == 0, "{broken").alias("pass3"), F.lit(1).alias("event_type"))
    table = e.select("event_id", F.when(k % 4 == 0, F.lit(7)).cast("bigint").alias("fee"), "event_type")
    return fill.apply_cache(table, cache, "event_id", ["pass2", "pass3"], "fee string, currency string").select("event_id", "fee", "currency", "event_type")


@query("k06_planned_counts", "SELECT unnest(['c_mktsegment', 'c_name', 'c_acctbal']) AS field, unnest([count(*) FILTER (c_custkey % 7 = 0), count(*) FILTER (c_custkey % 5 = 0), 0]) AS n FROM customer")
def k06_counts(spark, sf_dir):
    c = read(spark, sf_dir, "customer")
    empty = c.withColumn("c_mktsegment", F.when(F.col("c_custkey") % 7 != 0, F.col("c_mktsegment"))).withColumn("c_name", F.when(F.col("c_custkey") % 5 != 0, F.col("c_name")))
    fields = ["c_mktsegment", "c_name", "c_acctbal"]
    return fill.planned_counts(fill.upsert_plan(empty, c, "c_custkey", fields), fields)


@query("k06_untouched", "SELECT c_custkey FROM customer WHERE c_custkey % 35 = 0")
def k06_untouched(spark, sf_dir):
    return fill.untouched(GAPS.rows(spark, sf_dir), read(spark, sf_dir, "customer"), "c_custkey", ["c_mktsegment", "c_name"]).select("c_custkey")


@query("k06_repeated_rows", "SELECT c_custkey, 'c_mktsegment' AS field, c_mktsegment AS value FROM customer WHERE c_custkey % 7 = 0")
def k06_twice(spark, sf_dir):
    g = GAPS.rows(spark, sf_dir)
    return fill.upsert_plan(g.union(g), _twice(spark, sf_dir), "c_custkey", ["c_mktsegment"])


@query("k07_rich_text", "SELECT page_id, length(html) > 3000 AS rich FROM pages")
def k07(spark, sf_dir):
    text = fill.rich_or_generated(F.col("html"), F.lit("generated"), 3000)
    return read(spark, sf_dir, "pages").select("page_id", (text != "generated").alias("rich"))


# ---- conforming


_CORE = StructType([StructField("s_suppkey", LongType()), StructField("country", StringType()), StructField("s_nationkey", DoubleType())])


@query("c01_registry", "SELECT 'de' AS country, 's_suppkey,country,s_nationkey,stop_rail_01_m,stop_rail_02_m,stop_bus_01_m,stop_bus_02_m,land' AS columns, count(*) AS n FROM supplier UNION ALL SELECT 'nl', 's_suppkey,country,s_nationkey,stop_rail_01_m,stop_rail_02_m,stop_bus_01_m,stop_bus_02_m,gemeente,brin', count(*) FROM supplier")
def c01(spark, sf_dir):
    family = conform.family("stop", ["rail", "bus"], 2, [StructField("m", DoubleType())])
    schemas = conform.registry(_CORE, {"de": [StructField("land", StringType())], "nl": [StructField("gemeente", StringType()), StructField("brin", StringType())]}, family)
    s = read(spark, sf_dir, "supplier")
    each = [conform.conform(s, schema, keep_extra=False) for schema in schemas.values()]
    return rows.union_all(*[t.groupBy(F.lit(k).alias("country"), F.lit(",".join(t.columns)).alias("columns")).agg(F.count(F.lit(1)).alias("n")) for k, t in zip(schemas, each, strict=True)])


@query("c02_conform", "SELECT s_suppkey, NULL::VARCHAR AS country, s_nationkey::DOUBLE AS s_nationkey, s_name FROM supplier")
def c02(spark, sf_dir):
    return conform.conform(read(spark, sf_dir, "supplier").select("s_name", "s_suppkey", "s_nationkey"), _CORE)


@query("c03_preferred_order", "SELECT s_suppkey, 's_nationkey,s_suppkey,s_name,s_acctbal' AS columns FROM supplier")
def c03(spark, sf_dir):
    t = conform.preferred_order(read(spark, sf_dir, "supplier"), ["s_nationkey", "missing", "s_suppkey"])
    return t.select("s_suppkey", F.lit(",".join(t.columns)).alias("columns"))


@query("c04_guarded_rename", "SELECT s_suppkey, s_name, s_nationkey AS nation FROM supplier")
def c04(spark, sf_dir):
    return conform.guarded_rename(read(spark, sf_dir, "supplier"), {"s_nationkey": "nation", "s_acctbal": "s_name", "missing": "x"})


@query("c05_mapped_copy", "SELECT s_suppkey, s_nationkey, s_nationkey AS nation, CASE WHEN s_suppkey % 2 = 0 THEN 'own' ELSE s_name END AS label, s_name AS s_name, s_name IS NOT NULL OR s_nationkey IS NOT NULL AS any_s FROM supplier")
def c05(spark, sf_dir):
    s = read(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey", "s_name", F.when(F.col("s_suppkey") % 2 == 0, "own").alias("label"))
    t = conform.mapped(s, {"s_nationkey": "nation", "s_name": "label", "missing": "x"})
    return conform.passed_through(t, ["s_"], ["nation", "label", "s_suppkey"]).withColumn("any_s", conform.populated(t, "s_n"))


@query("c06_harmonised", "SELECT 'customer' AS origin, c_custkey AS id, CASE c_mktsegment WHEN 'BUILDING' THEN 'B' ELSE c_mktsegment END AS kind FROM customer UNION ALL SELECT 'supplier', s_suppkey, 'B' FROM supplier")
def c06(spark, sf_dir):
    tables = {"customer": read(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment"), "supplier": read(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("id"), F.lit("BUILDING").alias("kind"))}
    return conform.harmonised(tables, {"customer": {"c_custkey": "id", "c_mktsegment": "kind"}}, {"kind": {"BUILDING": "B"}})


@query("c07_schema_check", "SELECT false AS valid, 'country' AS missing, 's_name,s_acctbal' AS extra, count(*) AS n FROM supplier")
def c07(spark, sf_dir):
    s = read(spark, sf_dir, "supplier")
    return conform.schema_check(s, _CORE).select("valid", F.array_join("missing", ",").alias("missing"), F.array_join("extra", ",").alias("extra")).crossJoin(s.agg(F.count(F.lit(1)).alias("n")))


@query("c08_bad_values", "SELECT o_orderkey, s AS status FROM (SELECT o_orderkey, CASE WHEN o_orderkey % 9 <> 0 THEN o_orderstatus END AS s FROM orders) WHERE s IS NULL OR s NOT IN ('F', 'O')")
def c08(spark, sf_dir):
    o = read(spark, sf_dir, "orders").select("o_orderkey", F.when(F.col("o_orderkey") % 9 != 0, F.col("o_orderstatus")).alias("status"))
    return conform.bad_values(o, "status", ["F", "O"])


@query("c09_by_group", "WITH g AS (SELECT c_mktsegment, count(*) AS k, count(*) FILTER (c_custkey % 7 <> 0) AS a, count(*) FILTER (c_custkey % 2 = 0) AS b FROM customer GROUP BY 1), l AS (SELECT c_mktsegment, k, 'most' AS column_name, a AS n_filled FROM g UNION ALL SELECT c_mktsegment, k, 'half', b FROM g UNION ALL SELECT c_mktsegment, k, 'never', 0 FROM g), p AS (SELECT c_mktsegment, column_name, n_filled, round(n_filled * 100.0::DOUBLE / k, 2) AS pct FROM l) SELECT *, CASE WHEN pct >= 80 THEN '+' WHEN pct >= 40 THEN '~' WHEN pct > 0 THEN '-' ELSE 'X' END AS status FROM p")
def c09_group(spark, sf_dir):
    c = read(spark, sf_dir, "customer").select("c_mktsegment", F.when(F.col("c_custkey") % 7 != 0, "x1").alias("most"), F.when(F.col("c_custkey") % 2 == 0, 1).alias("half"), F.lit("nan").alias("never"))
    return conform.coverage_by(c, "c_mktsegment", ["most", "half", "never"])


@query("c10_all_checks", "SELECT 'range c_acctbal' AS check_name, count(*) FILTER (c_acctbal NOT BETWEEN 0 AND 9000) AS n FROM customer UNION ALL SELECT 'duplicate keys', (count(*) - count(DISTINCT c_nationkey * 10000 + floor(c_acctbal / 1000)))::BIGINT FROM customer UNION ALL SELECT 'coordinates', count(*) FILTER (NOT (c_nationkey BETWEEN 1 AND 20 AND c_acctbal BETWEEN 0 AND 5000)) FROM customer")
def c10_all(spark, sf_dir):
    c = read(spark, sf_dir, "customer").withColumn("thousands", F.floor(F.col("c_acctbal") / 1000))
    return conform.sanity(c, {"c_acctbal": (0, 9000)}, ["c_nationkey", "thousands"], ("c_nationkey", "c_acctbal"), (1, 0, 20, 5000))


@query("c11_drift", "SELECT 'a' AS table_name, 4 AS n_common, 0 AS n_missing, 0 AS n_extra, 0 AS n_other_type, true AS same_order, count(*) AS n FROM supplier UNION ALL SELECT 'b', 3, 1, 1, 1, false, count(*) FROM supplier")
def c11(spark, sf_dir):
    s = read(spark, sf_dir, "supplier")
    other = s.select("s_name", F.col("s_suppkey").cast("string").alias("s_suppkey"), "s_nationkey", F.lit(1).alias("more"))
    return conform.drift_report({"a": s, "b": other}, "a").crossJoin(s.agg(F.count(F.lit(1)).alias("n")))
