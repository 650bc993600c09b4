"""Conforming to a schema, and reports on what is there."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from placeloom.functions.values import decode
from placeloom.operators.fill import is_empty


def family(prefix: str, categories: Sequence[str], k: int, fields: Sequence[StructField]) -> list[StructField]:
    """Fields prefix_category_01_field ... of a repeating family of columns."""
    return [StructField(f"{prefix}_{c}_{i:02d}_{f.name}", f.dataType) for c in categories for i in range(1, k + 1) for f in fields]


def conform(df: DataFrame, schema: StructType, keep_extra: bool = True) -> DataFrame:
    """One select: the schema's columns in order, missing ones as typed nulls, then the others."""
    has = set(df.columns)
    wanted = [(F.col(f.name).try_cast(f.dataType) if f.name in has else F.lit(None).cast(f.dataType)).alias(f.name) for f in schema]
    return df.select(*wanted, *[c for c in df.columns if keep_extra and c not in schema.names])


def registry(core: StructType, extensions: dict[str, Sequence[StructField]], families: Sequence[StructField] = ()) -> dict[str, StructType]:
    """A schema for each extension: the core, the generated families, the extension's own fields; no name twice."""
    out = {}
    for name, own in extensions.items():
        fields = [*core.fields, *families, *own]
        if len({f.name for f in fields}) < len(fields):
            raise ValueError(f"{name}: a field comes twice")
        out[name] = StructType(fields)
    return out


def mapped(df: DataFrame, names: dict[str, str]) -> DataFrame:
    """df with copies of columns under other names, where there is no such column with a value yet; sources stay."""
    new = {b: F.col(a) if b not in df.columns else F.coalesce(F.when(~is_empty(F.col(b)), F.col(b)), F.col(a)) for a, b in names.items() if a in df.columns}
    return df.withColumns(new)


def passed_through(df: DataFrame, prefixes: Sequence[str], populated_columns: Sequence[str]) -> DataFrame:
    """The populated columns, and those with a prefix that are not populated already."""
    extra = [c for c in df.columns if c not in populated_columns and c.startswith(tuple(prefixes))]
    return df.select(*populated_columns, *extra)


def harmonised(tables: dict[str, DataFrame], names: dict[str, dict[str, str]], values: dict[str, dict[str, str]]) -> DataFrame:
    """Tables under common column names and common values of columns, one below the other; origin says which."""
    out = None
    for origin, t in tables.items():
        t = guarded_rename(t, names.get(origin, {}))
        for c, codes in values.items():
            if c in t.columns:
                t = t.withColumn(c, F.coalesce(decode(F.col(c), codes), F.col(c)))
        t = t.withColumn("origin", F.lit(origin))
        out = t if out is None else out.unionByName(t, allowMissingColumns=True)
    return out


def schema_check(df: DataFrame, schema: StructType) -> DataFrame:
    """valid, missing, extra: whether df has all of the schema's columns, and the names of those missing and besides."""
    missing, extra = ([c for c in x if c not in y] for x, y in ((schema.names, df.columns), (df.columns, schema.names)))
    row = (not missing, missing, extra)
    return df.sparkSession.createDataFrame([row], "valid boolean, missing array<string>, extra array<string>")


def strict(df: DataFrame, column: str, allowed: Sequence[str]) -> DataFrame:
    """df; a row with another value, or none, fails the job."""
    good = F.coalesce(F.col(column).isin(*allowed), F.lit(False))
    return df.withColumn(column, F.when(good, F.col(column)).otherwise(F.raise_error(F.concat(F.lit(f"{column}: "), F.coalesce(F.col(column), F.lit("no value"))))))


def coverage_by(df: DataFrame, group: str, columns: Sequence[str]) -> DataFrame:
    """group, column_name, n_filled, pct, status for each group and column: + from 80, ~ from 40, - above 0, else X."""
    counts = df.groupBy(group).agg(F.count(F.lit(1)).alias("_all"), *[F.count_if(~is_empty(F.col(c))).alias(f"_{c}") for c in columns])
    cells = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(f"_{c}").alias("n_filled")) for c in columns])
    pct = F.round(F.col("n_filled") * 100.0 / F.col("_all"), 2)
    status = F.when(F.col("pct") >= 80, "+").when(F.col("pct") >= 40, "~").when(F.col("pct") > 0, "-").otherwise("X")
    return counts.select(group, "_all", F.explode(cells).alias("x")).select(group, "x.*", "_all").withColumn("pct", pct).withColumn("status", status).drop("_all")


def sanity(df: DataFrame, ranges: dict[str, tuple[float, float]], keys: Sequence[str], place: tuple[str, str], box: tuple[float, float, float, float]) -> DataFrame:
    """check_name, n: values out of range, rows beyond the first of a key, coordinates outside south, west, north, east."""
    outside = out_of_range(df, ranges).select(F.concat(F.lit("range "), "column_name").alias("check_name"), F.col("n_outside").alias("n"))
    again = duplicates(df, keys).agg(F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("n")).select(F.lit("duplicate keys"), "n")
    south, west, north, east = box
    lost = df.agg(F.count_if(~(F.col(place[0]).between(south, north) & F.col(place[1]).between(west, east))).alias("n")).select(F.lit("coordinates"), "n")
    return outside.union(again).union(lost)


def drift_report(tables: dict[str, DataFrame], reference: str) -> DataFrame:
    """For each table against one of them: columns in common, missing, extra, of another type, and whether the common ones have the same order."""
    rows = []
    for name, t in tables.items():
        d = drift(tables[reference].schema, t.schema)
        order = [c for c in t.columns if c in d["common"]] == d["common"]
        rows.append((name, len(d["common"]), len(d["missing"]), len(d["extra"]), len(d["other_type"]), order))
    spark = tables[reference].sparkSession
    return spark.createDataFrame(rows, "table_name string, n_common int, n_missing int, n_extra int, n_other_type int, same_order boolean")


def preferred_order(df: DataFrame, first: Sequence[str]) -> DataFrame:
    return df.select(*[c for c in first if c in df.columns], *[c for c in df.columns if c not in first])


def guarded_rename(df: DataFrame, names: dict[str, str]) -> DataFrame:
    """Renames where the target is absent; else drops the source."""
    gone = [a for a, b in names.items() if a in df.columns and b in df.columns]
    return df.drop(*gone).withColumnsRenamed({a: b for a, b in names.items() if a in df.columns and b not in df.columns})


def coverage(df: DataFrame) -> DataFrame:
    """column_name, n_filled, pct: one pass over all columns."""
    counts = df.agg(F.count(F.lit(1)).alias("_all"), *[F.count_if(~is_empty(F.col(c))).alias(c) for c in df.columns])
    cells = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).alias("n_filled"), F.round(F.coalesce(F.try_divide(F.col(c) * 100.0, F.col("_all").cast("double")), F.lit(0.0)), 2).alias("pct")) for c in df.columns])
    return counts.select(F.explode(cells).alias("x")).select("x.*")


def out_of_range(df: DataFrame, ranges: dict[str, tuple[float, float]]) -> DataFrame:
    cells = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).alias("n_outside")) for c in ranges])
    return df.agg(*[F.count_if(~F.col(c).between(*r)).alias(c) for c, r in ranges.items()]).select(F.explode(cells).alias("x")).select("x.*")


def duplicates(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where("n > 1")


def bad_values(df: DataFrame, column: str, allowed: Sequence[str]) -> DataFrame:
    return df.where(F.col(column).isNull() | ~F.col(column).isin(*allowed))


def drift(a: StructType, b: StructType) -> dict[str, list[str]]:
    """Columns in common, missing from b, extra in b, and of another type."""
    x, y = ({f.name: f.dataType for f in s} for s in (a, b))
    return {"common": [c for c in x if c in y], "missing": [c for c in x if c not in y], "extra": [c for c in y if c not in x], "other_type": [c for c in x if c in y and x[c] != y[c]]}


def populated(df: DataFrame, prefix: str) -> Column:
    """Whether a row has any value in the columns with a prefix."""
    return F.coalesce(*[F.col(c).cast("string") for c in df.columns if c.startswith(prefix)]).isNotNull()
