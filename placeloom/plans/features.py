"""Model features of sites in one job: own figures, catchment, competition, area index and label."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from placeloom.operators.discs import around
from placeloom.operators.spatial import rivals


def built(sites: DataFrame, cells: DataFrame, areas: DataFrame, dimensions: dict[str, Column], label: Column, weight: str, catchment_m: float = 1000.0, rivals_m: float = 1500.0, key: str = "id", kind: str = "type", postcode: str = "postcode") -> DataFrame:
    """key, one double for each dimension, catchment, density (a square kilometre), competitors, nearest_m, area_index, label.

    sites(key, kind, postcode, lat, lon, ...), cells(p_lat, p_lon, weight), areas(postcode, area_index). Cells and rival
    sites are summed up over discs of their own reach, without a row for each pair.
    The area index goes by postcode; of areas that repeat one the least counts. Sites without a place have nulls and no competitors.
    """
    held = around(sites, cells, key, {"catchment": (catchment_m, F.col(weight).cast("double")), "_weighed": (catchment_m, F.col(weight).isNotNull())})
    held = held.select(key, F.when(F.col("_weighed") > 0, F.col("catchment")).alias("catchment"))
    beside = rivals(sites, rivals_m, kind, key).withColumnRenamed("nearest_competitor_m", "nearest_m")
    index = areas.groupBy(postcode).agg(F.min("area_index").alias("area_index"))
    own = sites.select(key, postcode, *[c.cast("double").alias(n) for n, c in dimensions.items()], label.cast("double").alias("label"))
    out = own.join(held, key, "left").join(beside, key, "left").join(index, postcode, "left")
    density = F.col("catchment") / (3.141592653589793 * (catchment_m / 1000) ** 2)
    return out.select(key, *dimensions, "catchment", density.alias("density"), F.coalesce("competitors", F.lit(0)).alias("competitors"), "nearest_m", "area_index", "label")
