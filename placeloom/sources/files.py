"""Scans of public files, and sinks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from placeloom.functions.values import parse_number


def read_text_table(spark: SparkSession, path: str, sep: str = ";", encoding: str = "UTF-8") -> DataFrame:
    """All columns as trimmed text under trimmed names."""
    raw = spark.read.csv(path, sep=sep, header=True, encoding=encoding, inferSchema=False)
    return raw.select(*[F.trim(F.col(f"`{c}`")).alias(c.strip().lstrip("﻿")) for c in raw.columns])


def read_any(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path) if path.rstrip("/").endswith(".parquet") else read_text_table(spark, path, ",")


def read_year(spark: SparkSession, paths: str, year: int, **options: str) -> DataFrame:
    """The files whose name has the year, or else the latest year before it that there is; all columns as text."""
    # names only: the column of the contents is not read
    listed = spark.read.format("binaryFile").load(paths).select("path", F.regexp_extract(F.element_at(F.split("path", "/"), -1), r"((?:19|20)[0-9]{2})", 1).try_cast("int").alias("y")).where(F.col("y") <= year)
    newest = listed.groupBy("y").agg(F.collect_list("path").alias("paths")).orderBy(F.desc("y")).first()
    reader = spark.read.options(header=True, inferSchema=False, **options)
    if newest is None:
        return reader.csv(paths).limit(0).withColumn("file_year", F.lit(None).cast("int"))
    return reader.csv(newest.paths).withColumn("file_year", F.lit(newest.y))


def read_events(spark: SparkSession, paths: Sequence[str], regions: Sequence[str], columns: dict[str, str], sep: str = ";") -> DataFrame:
    """Yearly event files of some regions, one below the other, read as text: ids as they are, coordinates with a decimal comma.

    columns: {out: source}; lat and lon become doubles, the others whole numbers; event_year is in the file's name.
    """
    out = None
    for path in paths:
        raw = spark.read.csv(path, sep=sep, header=True, inferSchema=False)
        rows = raw.where(F.col(columns["region"]).isin(*regions)).select(
            F.regexp_extract(F.col("_metadata.file_name"), r"((?:19|20)[0-9]{2})", 1).cast("int").alias("event_year"),
            *[F.col(c).alias(k) if k == "region" else parse_number(F.col(c)).alias(k) if k in ("lat", "lon") else F.col(c).try_cast("int").alias(k) for k, c in columns.items() if c in raw.columns],
        )
        out = rows if out is None else out.unionByName(rows, allowMissingColumns=True)
    return out


def read_transit(spark: SparkSession, folder: str, needed: dict[str, Sequence[str]]) -> dict[str, DataFrame]:
    """The tables of a transit feed (stops.txt, routes.txt, ...), only the needed columns, as text."""
    return {name: spark.read.csv(f"{folder}/{name}.txt", header=True, inferSchema=False).select(*columns) for name, columns in needed.items()}


def read_documents(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """JSON lines with a schema; lines that are no JSON are in _malformed, and all else there is null."""
    return spark.read.schema(StructType([*schema.fields, StructField("_malformed", StringType())])).option("columnNameOfCorruptRecord", "_malformed").json(path)


def read_in_box(df: DataFrame, lat: str, lon: str, box: tuple[float, float, float, float]) -> DataFrame:
    """Rows from south, west to north, east; the ranges reach the scan."""
    south, west, north, east = box
    return df.where(F.col(lat).between(south, north) & F.col(lon).between(west, east))


def geojson_points(spark: SparkSession, path: str, schema: StructType, multi_line: bool = True) -> DataFrame:
    """Features with lat and lon: a point's, or the middle vertex of a line; null without a geometry."""
    each = spark.read.schema(schema).json(path, multiLine=multi_line).select(F.explode("features").alias("f"))
    line = F.col("f.geometry.line")
    at = F.coalesce(F.col("f.geometry.point"), F.try_element_at(line, (F.size(line) / 2).cast("int") + 1))
    return each.select("f.properties.*", F.get(at, F.lit(1)).alias("lat"), F.get(at, F.lit(0)).alias("lon"))


def first_table(spark: SparkSession, names: Sequence[str]) -> DataFrame:
    """The first of the named tables that exists: the most enriched stage so far."""
    return next(spark.table(n) for n in names if spark.catalog.tableExists(n))


def write_wide(df: DataFrame, path: str, vector: str = "embedding") -> None:
    """Parquet as it is, and CSV without the vector and with nested columns as JSON."""
    df.write.mode("overwrite").parquet(f"{path}/parquet")
    flat = [F.to_json(c).alias(c) if t.startswith(("array", "map", "struct")) else F.col(c) for c, t in df.dtypes if c != vector]
    df.select(*flat).write.mode("overwrite").csv(f"{path}/csv", header=True)


def write_documents(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)


def write_by_class(df: DataFrame, path: str, column: str) -> None:
    df.write.mode("overwrite").partitionBy(column).parquet(path)


def contributions_wide(df: DataFrame, features: Sequence[str], map_col: str = "contributions") -> DataFrame:
    return df.select("*", *[F.try_element_at(F.col(map_col), F.lit(f)).alias(f"contrib_{f}") for f in features]).drop(map_col).orderBy(F.desc("prediction"))
