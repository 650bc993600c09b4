"""The operators as queries over the given tables, each with its SQL where SQL can express it."""

from __future__ import annotations

from pyspark.sql import functions as F

from placeloom.functions import scores, values
from placeloom.functions.geo import to_millimetres
from placeloom.operators import aggregates, conform, discs, documents, fill, joins, model, ranks, rows, spatial, vectors
from placeloom.registry import QUERIES, SQL, query  # noqa: F401
from placeloom.plans.sites import events, latitude, longitude, read, safety, sites
from placeloom.sources.files import read_in_box
from placeloom.streaming.rolling import hourly

def _at(k: str) -> str:
    return f"52.3 + (({k}::BIGINT * 7919) % 10007) / 10007.0::DOUBLE * 0.4 AS lat, 13.0 + (({k}::BIGINT * 104729) % 10009) / 10009.0::DOUBLE * 0.7 AS lon"


_DIST = "2 * 6371000.0 * atan2(sqrt(h), sqrt(1 - h))"
_H = "pow(sin(radians(e.lat - s.lat) / 2), 2) + cos(radians(s.lat)) * cos(radians(e.lat)) * pow(sin(radians(e.lon - s.lon) / 2), 2) AS h"
_SITES = f"s AS (SELECT c_custkey AS site_id, c_mktsegment AS type, {_at('c_custkey')} FROM customer)"
_EVENTS = f"e AS (SELECT o_orderkey AS event_id, o_orderstatus AS severity, o_orderpriority AS category, {_at('o_orderkey')} FROM orders)"
_NEAR = f"WITH {_SITES}, {_EVENTS}, p AS (SELECT site_id, event_id, severity, category, {_H} FROM s JOIN e ON abs(e.lat - s.lat) < 0.03), d AS (SELECT *, {_DIST} AS m FROM p), near AS (SELECT * FROM d WHERE m <= 1000)"


@query("e03_site_safety", _NEAR + """, c AS (SELECT s.site_id, count(event_id) AS n, count(*) FILTER (severity = 'P') AS n_fatal, count(*) FILTER (severity = 'F') AS n_serious, count(*) FILTER (severity = 'O') AS n_minor, round(min(m), 3) AS nearest_m FROM s LEFT JOIN near ON near.site_id = s.site_id GROUP BY 1),
x AS (SELECT *, round(100 * exp(-(10 * n_fatal + 3 * n_serious + n_minor) / 40.0::DOUBLE), 6) AS score FROM c),
r AS (SELECT *, rank() OVER (ORDER BY score DESC) AS rank_min, count(*) OVER (PARTITION BY score) AS ties, count(*) OVER () AS k FROM x)
SELECT site_id, n, n_fatal, n_serious, n_minor, nearest_m, score, rank_min, CASE WHEN (rank_min + (ties - 1) / 2.0::DOUBLE) / k <= 0.33 THEN 'safe' WHEN (rank_min + (ties - 1) / 2.0::DOUBLE) / k <= 0.66 THEN 'moderate' ELSE 'exposed' END AS band FROM r""")
def e03(spark, sf_dir):
    return safety(spark, sf_dir)


@query("e02_radius_match", _NEAR + " SELECT site_id, event_id, round(m, 3) AS distance_m FROM near")
def e02(spark, sf_dir):
    near = spatial.radius_join(sites(spark, sf_dir), events(spark, sf_dir), 1000)
    return near.select("site_id", "event_id", to_millimetres(F.col("distance_m")).alias("distance_m"))


@query("e04_two_radii", _NEAR + " SELECT site_id, count(*) FILTER (m <= 500) AS n500, count(*) AS n1000, count(*) FILTER (severity = 'P') AS fatal1000 FROM near GROUP BY 1")
def e04(spark, sf_dir):
    sums = {"n500": (500, F.lit(1)), "n1000": (1000, F.lit(1)), "fatal1000": (1000, F.col("severity") == "P")}
    return discs.around(sites(spark, sf_dir), events(spark, sf_dir), "site_id", sums).drop("_n")


@query("e05_nearest_3_by_category", _NEAR + ", r AS (SELECT *, row_number() OVER (PARTITION BY site_id, category ORDER BY m, event_id) AS rank FROM near) SELECT site_id, category, rank, event_id, round(m, 3) AS distance_m FROM r WHERE rank <= 3")
def e05(spark, sf_dir):
    near = spatial.nearest_k(sites(spark, sf_dir).drop("type"), events(spark, sf_dir).drop("severity"), 3, 1000, "category", "event_id")
    return near.select("site_id", "category", F.col("rank").cast("long").alias("rank"), "event_id", F.round("distance_m", 3).alias("distance_m"))


@query("e07_catchment", f"WITH {_SITES}, e AS (SELECT p_size, p_retailprice, {_at('p_partkey')} FROM part), p AS (SELECT site_id, p_size, p_retailprice, {_H} FROM s JOIN e ON abs(e.lat - s.lat) < 0.03), n AS (SELECT site_id, sum(p_size) AS total, sum(p_size * p_retailprice::DECIMAL(12, 2))::DOUBLE / sum(p_size) AS mean FROM p WHERE {_DIST} <= 1000 GROUP BY 1) SELECT s.site_id, total::BIGINT AS total, round(mean, 4) AS mean_price FROM s LEFT JOIN n ON n.site_id = s.site_id")
def e07(spark, sf_dir):
    cells = read(spark, sf_dir, "part").select("p_size", "p_retailprice", latitude("p_partkey").alias("p_lat"), longitude("p_partkey").alias("p_lon"))
    return spatial.catchment(sites(spark, sf_dir), cells, 1000, "p_size", ["p_retailprice"]).select("site_id", "total", F.round("mean_p_retailprice", 4).alias("mean_price"))


@query("e08_competition", f"WITH {_SITES}, p AS (SELECT s.site_id, {_H} FROM s JOIN s e ON s.type = e.type AND s.site_id <> e.site_id AND abs(e.lat - s.lat) < 0.03), n AS (SELECT site_id, count(*) AS competitors, min({_DIST}) AS m FROM p WHERE {_DIST} <= 1500 GROUP BY 1) SELECT s.site_id, coalesce(competitors, 0) AS competitors, round(m, 3) AS nearest_competitor_m FROM s LEFT JOIN n ON n.site_id = s.site_id")
def e08(spark, sf_dir):
    return spatial.competition(sites(spark, sf_dir), 1500).select("site_id", "competitors", F.round("nearest_competitor_m", 3).alias("nearest_competitor_m"))


@query("f05_bounding_box", f"WITH {_SITES} SELECT site_id FROM s WHERE lat BETWEEN 52.4 AND 52.5 AND lon BETWEEN 13.2 AND 13.5")
def f05(spark, sf_dir):
    return read_in_box(sites(spark, sf_dir), "lat", "lon", (52.4, 13.2, 52.5, 13.5)).select("site_id")


@query("p01_locale_numbers", "SELECT c_custkey, c_acctbal AS balance FROM customer")
def p01(spark, sf_dir):
    text = F.replace(F.col("c_acctbal").cast("string"), F.lit("."), F.lit(","))
    return read(spark, sf_dir, "customer").select("c_custkey", values.parse_number(text).alias("balance"))


@query("p03_codes", "SELECT c_custkey, CASE WHEN length(c_custkey::VARCHAR) >= 5 THEN c_custkey::VARCHAR ELSE lpad(c_custkey::VARCHAR, 5, '0') END AS code, c_custkey::VARCHAR AS id, 'x_' || c_custkey AS spaced FROM customer")
def p03(spark, sf_dir):
    k = F.concat(F.col("c_custkey").cast("string"), F.lit(".0"))
    return read(spark, sf_dir, "customer").select("c_custkey", values.pad_code(k, 5).alias("code"), values.canonical_id(k).alias("id"), values.namespaced("x", F.col("c_custkey").cast("string")).alias("spaced"))


@query("p06_urls", r"SELECT page_id, regexp_replace(CASE WHEN url LIKE 'http://%' THEN 'https://' || substr(url, 8) WHEN url LIKE 'https://%' THEN url ELSE 'https://' || url END, '[.,;)\s/]+$', '') AS url, sha1(lower(trim(url))) AS key FROM pages")
def p06(spark, sf_dir):
    return read(spark, sf_dir, "pages").select("page_id", values.clean_url(F.col("url")).alias("url"), values.url_key(F.col("url")).alias("key"))


@query("p11_decode", "SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN 'filled' WHEN 'O' THEN 'open' ELSE 'other' END AS status FROM orders")
def p11(spark, sf_dir):
    return read(spark, sf_dir, "orders").select("o_orderkey", values.decode(F.col("o_orderstatus"), {"F": "filled", "O": "open"}, "other").alias("status"))


@query("p12_classify", "SELECT p_partkey, CASE WHEN contains(lower(p_type), 'steel') THEN 'steel' WHEN contains(lower(p_type), 'brass') THEN 'brass' ELSE 'other' END AS kind FROM part")
def p12(spark, sf_dir):
    return read(spark, sf_dir, "part").select("p_partkey", values.classify(F.col("p_type"), [("steel", "steel"), ("brass", "brass")], "other").alias("kind"))


@query("p15_canonical_names", "SELECT s_suppkey, trim(regexp_replace(regexp_replace(lower(s_name), '[^a-z0-9]+', ' ', 'g'), '\\bsupplier\\b', ' ', 'g')) AS name FROM supplier")
def p15(spark, sf_dir):
    return read(spark, sf_dir, "supplier").select("s_suppkey", values.canonical_name(F.col("s_name"), ["supplier"]).alias("name"))


@query("p17_items", "SELECT p_partkey, array_to_string(list_sort(list_distinct(list_filter(string_split(p_type, ' '), lambda x: x <> ''))), ',') AS items FROM part")
def p17(spark, sf_dir):
    return read(spark, sf_dir, "part").select("p_partkey", F.array_join(values.items(F.col("p_type"), " "), ",").alias("items"))


@query("p23_json", "SELECT event_id, coalesce((props::JSON->>'k')::BIGINT, -1) AS k FROM events")
def p23(spark, sf_dir):
    return read(spark, sf_dir, "events").select("event_id", values.parsed_json(F.col("props"), "k bigint", F.struct(F.lit(-1).cast("long").alias("k")))["k"].alias("k")).fillna(-1, ["k"])


@query("f01_latest_period", "SELECT o_orderkey FROM orders WHERE date_trunc('month', o_orderdate) = (SELECT max(date_trunc('month', o_orderdate)) FROM orders)")
def f01(spark, sf_dir):
    return ranks.latest(read(spark, sf_dir, "orders").withColumn("month", F.date_trunc("month", "o_orderdate")), "month").select("o_orderkey")


@query("f04_modal_value", "SELECT o_orderkey, o_orderpriority FROM orders WHERE o_orderpriority = (SELECT o_orderpriority FROM orders GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1)")
def f04(spark, sf_dir):
    return ranks.modal(read(spark, sf_dir, "orders"), "o_orderpriority").select("o_orderkey", "o_orderpriority")


@query("f06_first_valid", "SELECT c_custkey, CASE WHEN c_acctbal BETWEEN 0 AND 5000 THEN c_acctbal WHEN c_acctbal / 2 BETWEEN 0 AND 5000 THEN c_acctbal / 2 END AS label FROM customer")
def f06(spark, sf_dir):
    return read(spark, sf_dir, "customer").select("c_custkey", values.first_valid([F.col("c_acctbal"), F.col("c_acctbal") / 2], 0, 5000).alias("label"))


@query("j01_mixed_grains", "SELECT c_custkey, n_name, r_name FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey LEFT JOIN region ON n_regionkey = r_regionkey")
def j01(spark, sf_dir):
    c, n, r = (read(spark, sf_dir, t) for t in ("customer", "nation", "region"))
    out = joins.additive(c.withColumnRenamed("c_nationkey", "n_nationkey"), n, ["n_nationkey"])
    return joins.additive(out, r.withColumnRenamed("r_regionkey", "n_regionkey"), ["n_regionkey"]).select("c_custkey", "n_name", "r_name")


@query("j05_either_key", "SELECT c_custkey, coalesce(a.n_name, b.n_name) AS n_name FROM customer LEFT JOIN nation a ON c_nationkey = a.n_nationkey AND c_nationkey < 5 LEFT JOIN nation b ON c_custkey % 25 = b.n_nationkey")
def j05(spark, sf_dir):
    c = read(spark, sf_dir, "customer").withColumn("k1", F.when(F.col("c_nationkey") < 5, F.col("c_nationkey"))).withColumn("k2", F.col("c_custkey") % 25)
    return joins.by_either_key(c, read(spark, sf_dir, "nation"), ("k1", "n_nationkey"), ("k2", "n_nationkey"), ["n_name"]).select("c_custkey", "n_name")


@query("j07_best_match", "WITH p AS (SELECT p_partkey, p_brand, p_name FROM part), m AS (SELECT a.p_partkey, b.p_partkey AS match_key, 1 - levenshtein(a.p_name, b.p_name) / greatest(length(a.p_name), length(b.p_name), 1)::DOUBLE AS score FROM p a JOIN p b ON a.p_brand = b.p_brand AND a.p_partkey <> b.p_partkey), r AS (SELECT *, row_number() OVER (PARTITION BY p_partkey ORDER BY score DESC, match_key) AS n FROM m WHERE score >= 0.4) SELECT p_partkey, match_key, round(score, 6) AS score FROM r WHERE n = 1")
def j07(spark, sf_dir):
    p = read(spark, sf_dir, "part").select("p_partkey", "p_brand", "p_name")
    other = p.select("p_brand", F.col("p_partkey").alias("match_key"), F.col("p_name").alias("match_name"))
    found = joins.best_match(p, other, ["p_brand"], "p_name", "match_name", "p_partkey", "match_key", 0.4, joins.OTHER)
    return found.select("p_partkey", "match_key", F.round("score", 6).alias("score"))


_CASCADE = "WITH n AS (SELECT c_nationkey, round(avg(c_acctbal), 6) AS v FROM customer WHERE c_nationkey % 3 = 0 GROUP BY 1), r AS (SELECT n_regionkey, round(avg(c_acctbal), 6) AS v FROM customer JOIN nation ON c_nationkey = n_nationkey WHERE n_regionkey < 3 GROUP BY 1), g AS (SELECT round(avg(c_acctbal), 6) AS v FROM customer) SELECT s_suppkey, coalesce(n.v, r.v, g.v) AS mean_balance, CASE WHEN n.v IS NOT NULL THEN 'nation' WHEN r.v IS NOT NULL THEN 'region' ELSE 'all' END AS data_source FROM supplier JOIN nation k ON s_nationkey = k.n_nationkey LEFT JOIN n ON n.c_nationkey = s_nationkey LEFT JOIN r ON r.n_regionkey = k.n_regionkey CROSS JOIN g"


@query("j08_cascade", _CASCADE)
def j08(spark, sf_dir):
    s, n, c = (read(spark, sf_dir, t) for t in ("supplier", "nation", "customer"))
    base = s.withColumnRenamed("s_nationkey", "n_nationkey").join(n.select("n_nationkey", "n_regionkey"), "n_nationkey")
    rows = c.withColumnRenamed("c_nationkey", "n_nationkey").join(n, "n_nationkey")
    mean = F.round(F.avg("c_acctbal"), 6).alias("mean_balance")
    levels = [("nation", rows.where("n_nationkey % 3 = 0").groupBy("n_nationkey").agg(mean), ["n_nationkey"]), ("region", rows.where("n_regionkey < 3").groupBy("n_regionkey").agg(mean), ["n_regionkey"]), ("all", rows.agg(mean), [])]
    return joins.cascade(base, levels, ["mean_balance"]).select("s_suppkey", "mean_balance", "data_source")


@query("j13_append_new", "SELECT n_nationkey::BIGINT AS k FROM nation UNION ALL SELECT c_custkey FROM customer WHERE c_custkey NOT IN (SELECT n_nationkey FROM nation)")
def j13(spark, sf_dir):
    return joins.append_new(read(spark, sf_dir, "nation").select(F.col("n_nationkey").cast("long").alias("k")), read(spark, sf_dir, "customer").select(F.col("c_custkey").alias("k")), ["k"])


_YEARS = "WITH y AS (SELECT o_orderpriority AS p, year(o_orderdate) AS y, round(sum(o_totalprice), 2) AS v FROM orders GROUP BY 1, 2)"


@query("w06_changes", _YEARS + ", b AS (SELECT *, lag(v) OVER (PARTITION BY p ORDER BY y) AS w FROM y) SELECT p, y, round(v - w, 2) AS difference, CASE WHEN w > 0 THEN round((v - w) / w * 100, 6) END AS change_pct FROM b")
def w06(spark, sf_dir):
    years = read(spark, sf_dir, "orders").groupBy(F.col("o_orderpriority").alias("p"), F.year("o_orderdate").alias("y")).agg(F.round(F.sum("o_totalprice"), 2).alias("v"))
    return ranks.changes(years, ["p"], "y", "v").select("p", "y", F.round("difference", 2).alias("difference"), F.round("change_pct", 6).alias("change_pct"))


@query("w03_percentiles", "WITH r AS (SELECT c_custkey, rank() OVER (ORDER BY c_acctbal) AS rank_min, dense_rank() OVER (ORDER BY c_acctbal) AS rank_dense, count(*) OVER (PARTITION BY c_acctbal) AS t, count(*) OVER () AS n FROM customer) SELECT c_custkey, rank_min, rank_dense, round((rank_min + (t - 1) / 2.0::DOUBLE) / n, 9) AS pct_rank FROM r")
def w03(spark, sf_dir):
    return ranks.ranked(read(spark, sf_dir, "customer"), "c_acctbal").select("c_custkey", "rank_min", "rank_dense", F.round("pct_rank", 9).alias("pct_rank"))


@query("w04_keep_first", "SELECT o_custkey, o_orderkey FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) AS n FROM orders) WHERE n = 1")
def w04(spark, sf_dir):
    return ranks.keep_first(read(spark, sf_dir, "orders"), ["o_custkey"], [F.desc("o_totalprice"), F.col("o_orderkey")]).select("o_custkey", "o_orderkey")


@query("a04_guarded_ratio", "SELECT l_suppkey, sum(l_quantity) AS quantity, round(avg(l_discount), 9) AS mean_discount, round(count(*) FILTER (l_returnflag = 'R') * 100.0 / count(*), 2) AS returned_pct FROM lineitem GROUP BY 1")
def a04(spark, sf_dir):
    return read(spark, sf_dir, "lineitem").groupBy("l_suppkey").agg(F.coalesce(F.sum("l_quantity"), F.lit(0.0)).alias("quantity"), F.round(F.avg("l_discount"), 9).alias("mean_discount"), scores.rate(F.count_if(F.col("l_returnflag") == "R"), F.count(F.lit(1)), 100).alias("returned_pct"))


@query("a05_lists", "SELECT o_custkey, string_agg(DISTINCT o_orderpriority, ',' ORDER BY o_orderpriority) AS priorities FROM orders GROUP BY 1")
def a05(spark, sf_dir):
    return aggregates.sorted_lists(read(spark, sf_dir, "orders"), ["o_custkey"], "o_orderpriority").withColumnRenamed("o_orderpriority", "priorities")


@query("a08_pivot", "SELECT year(o_orderdate) AS y, count(*) FILTER (o_orderstatus = 'F') AS filled, count(*) FILTER (o_orderstatus = 'O') AS open FROM orders GROUP BY 1")
def a08(spark, sf_dir):
    return read(spark, sf_dir, "orders").groupBy(F.year("o_orderdate").alias("y")).pivot("o_orderstatus", ["F", "O"]).count().select("y", F.coalesce("F", F.lit(0)).alias("filled"), F.coalesce("O", F.lit(0)).alias("open"))


@query("a12_z_scores", "WITH s AS (SELECT avg(c_acctbal) AS m, stddev_samp(c_acctbal) AS d FROM customer) SELECT c_custkey, round((c_acctbal - m) / d, 6) AS z, CASE WHEN (c_acctbal - m) / d < -1 THEN 'low' WHEN (c_acctbal - m) / d < 1 THEN 'middle' ELSE 'high' END AS band FROM customer, s")
def a12(spark, sf_dir):
    c = read(spark, sf_dir, "customer")
    z = (F.col("c_acctbal") - F.col("m")) / F.col("d")
    return c.crossJoin(F.broadcast(c.agg(F.avg("c_acctbal").alias("m"), F.stddev_samp("c_acctbal").alias("d")))).select("c_custkey", F.round(z, 6).alias("z"), scores.bands(z, [(-1, "low"), (1, "middle")], "high", right_closed=False).alias("band"))


@query("u02_both_lists", "SELECT coalesce(a.k, b.k) AS k, CASE WHEN a.k IS NOT NULL AND b.k IS NOT NULL THEN 'both' WHEN b.k IS NULL THEN 'customer' ELSE 'supplier' END AS kind FROM (SELECT DISTINCT c_custkey AS k FROM customer) a FULL JOIN (SELECT DISTINCT s_suppkey * 2 AS k FROM supplier) b ON a.k = b.k")
def u02(spark, sf_dir):
    a, b = read(spark, sf_dir, "customer").select(F.col("c_custkey").alias("k")), read(spark, sf_dir, "supplier").select((F.col("s_suppkey") * 2).alias("k"))
    return rows.both_lists(a, b, "k", ("customer", "supplier"), "both")


@query("x10_bands", "SELECT p_partkey, CASE WHEN p_size <= 10 THEN 'small' WHEN p_size <= 30 THEN 'medium' ELSE 'large' END AS band FROM part")
def x10(spark, sf_dir):
    return read(spark, sf_dir, "part").select("p_partkey", scores.bands(F.col("p_size"), [(10, "small"), (30, "medium")], "large").alias("band"))


@query("x02_access_by_density", _NEAR + " SELECT site_id, least(100, least(5 * count(*) FILTER (m <= 500), 30) + least(2 * count(*), 20)) AS score FROM near GROUP BY 1")
def x02(spark, sf_dir):
    near = discs.around(sites(spark, sf_dir), events(spark, sf_dir), "site_id", {"n500": (500, F.lit(1)), "n1000": (1000, F.lit(1))})
    return near.select("site_id", scores.access_by_density(F.col("n500"), F.col("n1000"), F.lit(0)).cast("long").alias("score"))


def _gaps(spark, sf_dir):
    return read(spark, sf_dir, "customer").select("c_custkey", F.when(F.col("c_custkey") % 7 != 0, F.col("c_mktsegment")).alias("c_mktsegment"), F.when(F.col("c_custkey") % 5 != 0, F.col("c_name")).alias("c_name"))


@query("k01_fill_gaps", "SELECT c_custkey, c_mktsegment, c_name, concat_ws(',', CASE WHEN c_custkey % 7 = 0 THEN 'raw:c_mktsegment' END, CASE WHEN c_custkey % 5 = 0 THEN 'raw:c_name' END) AS filled_from FROM customer")
def k01(spark, sf_dir):
    return fill.fill_gaps(_gaps(spark, sf_dir), read(spark, sf_dir, "customer"), "c_custkey", ["c_mktsegment", "c_name"], "raw")


@query("k06_upsert_plan", "SELECT c_custkey, 'c_mktsegment' AS field, c_mktsegment AS value FROM customer WHERE c_custkey % 7 = 0 UNION ALL SELECT c_custkey, 'c_name', c_name FROM customer WHERE c_custkey % 5 = 0")
def k06(spark, sf_dir):
    return fill.upsert_plan(_gaps(spark, sf_dir), read(spark, sf_dir, "customer"), "c_custkey", ["c_mktsegment", "c_name"])


@query("c09_coverage", "WITH n AS (SELECT count(*) AS k, count(*) FILTER (c_custkey % 7 <> 0) AS a, count(*) FILTER (c_custkey % 5 <> 0) AS b FROM customer) SELECT 'c_custkey' AS column_name, k AS n_filled, 100.0::DOUBLE AS pct FROM n UNION ALL SELECT 'c_mktsegment', a, round(a * 100.0 / k, 2) FROM n UNION ALL SELECT 'c_name', b, round(b * 100.0 / k, 2) FROM n")
def c09(spark, sf_dir):
    return conform.coverage(_gaps(spark, sf_dir))


@query("c10_sanity", "SELECT 'c_acctbal' AS column_name, count(*) FILTER (c_acctbal NOT BETWEEN 0 AND 9000) AS n_outside FROM customer")
def c10(spark, sf_dir):
    return conform.out_of_range(read(spark, sf_dir, "customer"), {"c_acctbal": (0, 9000)})


@query("m13_correlations", "SELECT i::INT AS dim, round(corr(embedding[i + 1]::DOUBLE, label::DOUBLE), 6) AS r FROM embeddings, range(64) t(i) GROUP BY 1")
def m13(spark, sf_dir):
    return vectors.dimension_correlations(read(spark, sf_dir, "embeddings"), "embedding", "label").select("dim", F.round("r", 6).alias("r"))


@query("v01_top_cosine", "WITH p AS (SELECT a.vec_id, b.vec_id AS neighbour, list_cosine_similarity(a.embedding::DOUBLE[], b.embedding::DOUBLE[]) AS c FROM embeddings a, embeddings b WHERE a.vec_id <> b.vec_id), r AS (SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY round(c, 9) DESC, neighbour) AS rank FROM p) SELECT vec_id, neighbour, round(round(c, 9), 6) AS cosine, rank FROM r WHERE rank <= 3")
def v01(spark, sf_dir):
    e = vectors.valid(read(spark, sf_dir, "embeddings"), "embedding", 64)
    return vectors.top_cosine(e, e, 3, key="vec_id").select("vec_id", "neighbour", F.round("cosine", 6).alias("cosine"), F.col("rank").cast("long").alias("rank"))


@query("v01_wide", "WITH p AS (SELECT a.vec_id, b.vec_id AS neighbour, list_cosine_similarity(a.embedding::DOUBLE[], b.embedding::DOUBLE[]) AS c FROM embeddings a, embeddings b WHERE a.vec_id <> b.vec_id), r AS (SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY round(c, 9) DESC, neighbour) AS rank FROM p) SELECT vec_id, max(neighbour) FILTER (rank = 1) AS similar_1, max(neighbour) FILTER (rank = 2) AS similar_2, max(neighbour) FILTER (rank = 3) AS similar_3 FROM r GROUP BY 1")
def v01_wide(spark, sf_dir):
    e = vectors.valid(read(spark, sf_dir, "embeddings"), "embedding", 64)
    return vectors.wide(vectors.top_cosine(e, e, 3, key="vec_id"), 3, "vec_id")


@query("v01_index_search")
def v01_index(spark, sf_dir):
    """Neighbours of every fiftieth row by the index over all rows: not all of them, so without SQL; the tests measure recall."""
    e = vectors.valid(read(spark, sf_dir, "embeddings"), "embedding", 64)
    found = vectors.top_cosine_indexed(e.where("vec_id % 50 = 0"), e, 3, key="vec_id")
    return found.select("vec_id", "neighbour", F.round("cosine", 6).alias("cosine"), F.col("rank").cast("long").alias("rank"))


@query("m02_ridge")
def m02(spark, sf_dir):
    """Order value from line item figures, by ridge on z-scores: prediction, interval and contributions for each order."""
    lines = read(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.sum("l_quantity").alias("quantity"), F.avg("l_discount").alias("discount"), F.count(F.lit(1)).cast("double").alias("n_lines"))
    rows, used = model.standardised(read(spark, sf_dir, "orders").join(lines, "o_orderkey"), ["quantity", "discount", "n_lines"])
    m = model.solve(model.gram(rows, used, "o_totalprice")[0], used)
    return rows.select("o_orderkey", F.round(m.prediction(), 3).alias("prediction"), F.round(m.half_width(), 3).alias("half_width"), F.to_json(m.contributions()).alias("contributions"))


@query("d01_html_to_text")
def d01(spark, sf_dir):
    return read(spark, sf_dir, "pages").select("page_id", documents.html_to_text(F.col("html")).alias("text"))


@query("d02_documents", "SELECT c_custkey, 'Name: ' || c_name || chr(10) || chr(10) || 'Segment: ' || c_mktsegment AS content FROM customer")
def d02(spark, sf_dir):
    return read(spark, sf_dir, "customer").select("c_custkey", documents.assembled([("Name: ", F.col("c_name")), ("Segment: ", F.col("c_mktsegment"))]).alias("content"))


@query("r01_hourly", "SELECT date_trunc('hour', ts) AS hour, event_type, round(avg(value), 6) AS mean_value, count(*) AS n FROM events GROUP BY 1, 2")
def r01(spark, sf_dir):
    return hourly(read(spark, sf_dir, "events"), "ts", "event_type", "value").select(F.col("hour").cast("timestamp_ntz").alias("hour"), "event_type", F.round("mean_value", 6).alias("mean_value"), "n")


# the other queries register themselves
from placeloom import queries_matching, queries_places, queries_tables, queries_values  # noqa: E402, F401
