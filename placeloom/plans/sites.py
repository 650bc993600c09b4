"""Sites with what lies around them, scored and ranked: the flagship job."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from placeloom.functions.scores import bands, traffic_safety
from placeloom.operators.ranks import ranked
from placeloom.operators.spatial import radius_counts


def latitude(k: str):
    return 52.3 + F.pmod(F.col(k).cast("long") * 7919, F.lit(10007)) / F.lit(10007.0) * 0.4


def longitude(k: str):
    return 13.0 + F.pmod(F.col(k).cast("long") * 104729, F.lit(10009)) / F.lit(10009.0) * 0.7


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def sites(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "customer").select(F.col("c_custkey").alias("site_id"), F.col("c_mktsegment").alias("type"), latitude("c_custkey").alias("lat"), longitude("c_custkey").alias("lon"))


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("event_id"), F.col("o_orderstatus").alias("severity"), F.col("o_orderpriority").alias("category"), latitude("o_orderkey").alias("p_lat"), longitude("o_orderkey").alias("p_lon"))


def safety(spark: SparkSession, sf_dir: str, radius_m: float = 1000.0) -> DataFrame:
    """For each site: events around it by severity, the nearest, a safety score, its rank and band."""
    severe = F.col("severity")
    counted = radius_counts(sites(spark, sf_dir).drop("type"), events(spark, sf_dir), radius_m, {"n_fatal": severe == "P", "n_serious": severe == "F", "n_minor": severe == "O"})
    scored = counted.withColumn("score", F.round(traffic_safety(F.col("n_fatal"), F.col("n_serious"), F.col("n_minor"), F.lit(0)), 6))
    out = ranked(scored, "score", ascending=False).withColumn("band", bands(F.col("pct_rank"), [(0.33, "safe"), (0.66, "moderate")], "exposed"))
    return out.select("site_id", "n", "n_fatal", "n_serious", "n_minor", F.round("nearest_m", 3).alias("nearest_m"), "score", "rank_min", "band")
