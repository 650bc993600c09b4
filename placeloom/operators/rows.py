"""Filters, and sets of rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from placeloom.operators.fill import is_empty


def in_codes(df: DataFrame, codes: dict[str, Sequence[str]]) -> DataFrame:
    """Rows whose columns all have one of the listed codes; the lists reach the scan."""
    for c, allowed in codes.items():
        df = df.where(F.col(c).isin(*allowed))
    return df


def matching_or(df: DataFrame, patterns: dict[str, str], name: str, exception: str) -> DataFrame:
    """Rows that match all patterns, or whose name matches the exception."""
    every = F.lit(True)
    for c, p in patterns.items():
        every = every & F.coalesce(F.col(c).rlike(p), F.lit(False))
    return df.where(every | F.coalesce(F.col(name).rlike(exception), F.lit(False)))


def needing_work(df: DataFrame, keys: Sequence[str], text: str, least: int, private: Column, fee: str) -> DataFrame:
    """Rows with an empty key column, a text under so many characters, or private ones without a fee; reasons as an array."""
    reasons = [F.when(is_empty(F.col(c)), F.lit(f"no {c}")) for c in keys]
    reasons += [F.when(F.coalesce(F.length(text), F.lit(0)) < least, F.lit("short text")), F.when(private & F.col(fee).isNull(), F.lit("no fee"))]
    return df.withColumn("reasons", F.array_compact(F.array(*reasons))).where(F.size("reasons") > 0)


def valid_names(df: DataFrame, name: str, least: int, needed: str, excluded: str) -> DataFrame:
    """Rows whose trimmed name is long enough, has a needed keyword and none of what is excluded."""
    low = F.lower(F.trim(F.col(name)))
    return df.where((F.length(low) >= least) & low.rlike(needed) & ~low.rlike(excluded))


def eligible(df: DataFrame, kinds: DataFrame, column: str) -> DataFrame:
    """Rows whose type a table of types has."""
    return df.join(kinds.select(column), column, "left_semi")


def union_all(*tables: DataFrame) -> DataFrame:
    """All rows of tables with different columns; a missing one is null."""
    out = tables[0]
    for t in tables[1:]:
        out = out.unionByName(t, allowMissingColumns=True)
    return out


def both_lists(a: DataFrame, b: DataFrame, key: str, names: tuple[str, str], both: str) -> DataFrame:
    """The distinct keys of two lists, each once, with the list that has it or the combined name."""
    x, y = a.select(key, F.lit(True).alias("_a")).distinct(), b.select(key, F.lit(True).alias("_b")).distinct()
    kind = F.when(F.col("_a") & F.col("_b"), both).when(F.col("_a"), names[0]).otherwise(names[1])
    return x.join(y, key, "full").select(key, kind.alias("kind"))


def with_constants_rows(df: DataFrame, rows: Sequence[tuple], columns: Sequence[str], key: str) -> DataFrame:
    """df and those of the given rows whose key it lacks."""
    literal = df.sparkSession.createDataFrame([tuple(r) for r in rows], df.select(*columns).schema)
    return df.unionByName(literal.join(df.select(key), key, "left_anti"), allowMissingColumns=True)


def one_row_per_class(df: DataFrame, classes: dict[str, Column], out: str = "class") -> DataFrame:
    """A row for each class whose condition holds, tagged with it; shared marks rows of several. Rows of none go."""
    held = F.array_compact(F.array(*[F.when(c, F.lit(k)) for k, c in classes.items()]))
    return df.withColumn("_held", held).withColumn("shared", F.size("_held") > 1).withColumn(out, F.explode("_held")).drop("_held")


def split_by(df: DataFrame, condition: Column) -> tuple[DataFrame, DataFrame]:
    """Rows for which the condition holds, and all others, those where it is null among them."""
    holds = F.coalesce(condition, F.lit(False))
    return df.where(holds), df.where(~holds)


def id_sets(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    """key, place: "both", "left" or "right", each distinct key once."""
    return both_lists(a, b, key, ("left", "right"), "both").withColumnRenamed("kind", "place")
