"""Queries of matching names and of sites with their nearest places."""

from __future__ import annotations

from pyspark.sql import functions as F

from placeloom.operators import joins
from placeloom.plans.sites import read
from placeloom.registry import query

# ---- fuzzy names

_VARIED = "CASE p_partkey % 4 WHEN 0 THEN p_name || ' no ' || (p_partkey * 7919 % 1009) WHEN 1 THEN replace(p_name, 'o', '0') || ' no ' || (p_partkey * 7919 % 1009) WHEN 2 THEN p_name || (p_partkey % 50) ELSE 'x' || (p_partkey * 31 % 997) || ' ' || p_name END"


@query("j07_descending", f"WITH p AS (SELECT p_partkey, p_brand, {_VARIED} AS nm FROM part), m AS (SELECT a.p_partkey, b.p_partkey AS match_key, 1 - levenshtein(a.nm, b.nm) / greatest(length(a.nm), length(b.nm), 1)::DOUBLE AS score FROM p a JOIN p b ON a.p_brand = b.p_brand AND a.p_partkey <> b.p_partkey), r AS (SELECT *, row_number() OVER (PARTITION BY p_partkey ORDER BY score DESC, match_key) AS n FROM m WHERE score >= 0.6) SELECT p_partkey, match_key, round(score, 6) AS score FROM r WHERE n = 1")
def j07_descending(spark, sf_dir):
    """Names that differ nearly all: most rows find theirs at 0.9 or 0.8, few are left for the bands of length."""
    p = read(spark, sf_dir, "part").select("p_partkey", "p_brand", F.expr(_VARIED).alias("nm"))
    other = p.select("p_brand", F.col("p_partkey").alias("match_key"), F.col("nm").alias("match_name"))
    found = joins.best_match(p, other, ["p_brand"], "nm", "match_name", "p_partkey", "match_key", 0.6, joins.OTHER)
    return found.select("p_partkey", "match_key", F.round("score", 6).alias("score"))


_KNOWN = "lpad(c_custkey::VARCHAR, 6, '0') || ' ' || lower(c_mktsegment) || ' haus ' || c_nationkey"
_ASKED = "CASE s_suppkey % 5 WHEN 0 THEN substr(nm, 1, 12) WHEN 1 THEN 'haus ' || substr(nm, 1, 6) || ' ' || seg WHEN 2 THEN substr(nm, 1, 15) || 'zz qqq www' WHEN 3 THEN 'neu ' || substr(nm, 1, 15) || 'yy vvv' ELSE 'ganz anders genannt' END"


@query("j06_three_rules", f"WITH k AS (SELECT c_custkey, c_nationkey, lower(c_mktsegment) AS seg, {_KNOWN} AS nm FROM customer), "
    f"""a AS (SELECT s_suppkey, c_nationkey, {_ASKED} AS nm FROM supplier JOIN k ON c_custkey = s_suppkey * 3),
m AS (SELECT s_suppkey, c_custkey, CASE WHEN contains(a.nm, k.nm) OR contains(k.nm, a.nm) THEN 1.0 ELSE len(list_intersect(string_split(a.nm, ' '), string_split(k.nm, ' '))) / least(len(list_distinct(string_split(a.nm, ' '))), len(list_distinct(string_split(k.nm, ' '))))::DOUBLE END AS score FROM a JOIN k ON a.c_nationkey = k.c_nationkey),
r AS (SELECT *, row_number() OVER (PARTITION BY s_suppkey ORDER BY score DESC, c_custkey) AS n FROM m WHERE score >= 0.7),
u AS (SELECT * FROM a WHERE s_suppkey NOT IN (SELECT s_suppkey FROM r)),
f AS (SELECT s_suppkey, count(*) AS n, min(c_custkey) AS c_custkey FROM u JOIN k ON u.c_nationkey = k.c_nationkey AND contains(k.nm, substr(u.nm, 1, 15)) GROUP BY 1),
b AS (SELECT s_suppkey, min(c_custkey) AS c_custkey FROM u JOIN k ON u.c_nationkey = k.c_nationkey AND contains(u.nm, substr(k.nm, 1, 15)) WHERE s_suppkey NOT IN (SELECT s_suppkey FROM f) GROUP BY 1)
SELECT s_suppkey, c_custkey, round(score, 6)::DOUBLE AS score, 1 AS rule FROM r WHERE n = 1 UNION ALL SELECT s_suppkey, c_custkey, NULL, 2 FROM f WHERE n = 1 UNION ALL SELECT s_suppkey, c_custkey, NULL, 2 FROM b""")
def j06_three(spark, sf_dir):
    """Containment, shared words, and the only name with the same first 15 characters, either way."""
    known = read(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", F.lower("c_mktsegment").alias("seg"), F.expr(_KNOWN.replace("::VARCHAR", "")).alias("nm"))
    named = read(spark, sf_dir, "supplier").join(known, F.col("c_custkey") == F.col("s_suppkey") * 3)
    asked = named.select("s_suppkey", "c_nationkey", F.expr(_ASKED).alias("asked"))
    found = joins.token_match(asked, known.drop("seg"), ["c_nationkey"], "asked", "nm", "s_suppkey", "c_custkey", prefix=15)
    return found.select("s_suppkey", "c_custkey", F.round("score", 6).alias("score"), "rule")


# ---- district figures by five levels

_TEXT = "CASE c_custkey % 6 WHEN 0 THEN n_name WHEN 1 THEN 'Am ' || lower(n_name) || ' Ring' WHEN 2 THEN substr(n_name, 3, 6) ELSE 'Hauptstr. 1' END"


@query("j08_five_levels", f"""WITH c AS (SELECT * FROM customer JOIN nation ON c_nationkey = n_nationkey),
stat AS (SELECT n_name, CASE WHEN n_nationkey % 4 <> 0 THEN round(avg(c_acctbal), 6) END AS v FROM c WHERE n_nationkey % 3 <> 1 GROUP BY n_name, n_nationkey),
reg AS (SELECT n_regionkey, round(avg(c_acctbal), 6) AS v FROM c GROUP BY 1), city AS (SELECT round(avg(c_acctbal), 6) AS v FROM c),
b AS (SELECT c_custkey, {_TEXT} AS txt, CASE WHEN c_custkey % 6 = 3 THEN 10000 + c_nationkey END AS postcode, CASE WHEN c_custkey % 6 = 4 THEN n_regionkey END AS region FROM c),
p AS (SELECT c_custkey, n_name, row_number() OVER (PARTITION BY c_custkey ORDER BY CASE WHEN contains(lower(txt), lower(n_name)) THEN -length(n_name) ELSE length(n_name) END, lower(n_name)) AS k FROM b, nation WHERE contains(lower(txt), lower(n_name)) OR contains(lower(n_name), lower(txt)))
SELECT b.c_custkey, coalesce(e.v, s.v, z.v, reg.v, city.v) AS mean_balance, CASE WHEN e.v IS NOT NULL THEN 'name' WHEN s.v IS NOT NULL THEN 'part of name' WHEN z.v IS NOT NULL THEN 'postcode' WHEN reg.v IS NOT NULL THEN 'region' ELSE 'all' END AS data_source
FROM b LEFT JOIN stat e ON e.n_name = b.txt LEFT JOIN p ON p.c_custkey = b.c_custkey AND p.k = 1 LEFT JOIN stat s ON s.n_name = p.n_name
LEFT JOIN nation ON n_nationkey = b.postcode - 10000 LEFT JOIN stat z ON z.n_name = nation.n_name LEFT JOIN reg ON reg.n_regionkey = b.region CROSS JOIN city""")
def j08_five(spark, sf_dir):
    """The area by its whole name, by a part of it, by postcode; the region's and the whole mean; areas without a figure are passed over."""
    nations = read(spark, sf_dir, "nation")
    c = read(spark, sf_dir, "customer").join(nations, F.col("c_nationkey") == F.col("n_nationkey"))
    mean = F.round(F.avg("c_acctbal"), 6)
    stat = c.where("n_nationkey % 3 <> 1").groupBy("n_name", "n_nationkey").agg(mean.alias("m")).select("n_name", F.when(F.col("n_nationkey") % 4 != 0, F.col("m")).alias("mean_balance"))
    by = lambda k: stat.withColumnRenamed("n_name", k)
    base = c.select("c_custkey", F.expr(_TEXT).alias("txt"), F.when(F.col("c_custkey") % 6 == 3, 10000 + F.col("c_nationkey")).alias("postcode"), F.when(F.col("c_custkey") % 6 == 4, F.col("n_regionkey")).alias("region"))
    base = joins.partial_names(base, "txt", nations, "n_name", "area")
    by_code = nations.select((F.col("n_nationkey") + 10000).alias("postcode"), "n_name").join(stat, "n_name").drop("n_name")
    levels = [("name", by("txt"), ["txt"]), ("part of name", by("area"), ["area"]), ("postcode", by_code, ["postcode"]), ("region", c.groupBy(F.col("n_regionkey").alias("region")).agg(mean.alias("mean_balance")), ["region"]), ("all", c.agg(mean.alias("mean_balance")), [])]
    return joins.cascade(base, levels, ["mean_balance"]).select("c_custkey", "mean_balance", "data_source")
