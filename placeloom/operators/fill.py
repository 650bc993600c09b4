"""Filling gaps without overwriting, with provenance."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from placeloom.functions.values import NULL_TOKENS, parsed_json


def is_empty(c: Column) -> Column:
    return c.isNull() | F.lower(F.trim(c.cast("string"))).isin(*NULL_TOKENS)


def one_row(source: DataFrame, key: str, fields: Sequence[str], order: Sequence[str] = ()) -> DataFrame:
    """key and fields under "_" names, one row for each key: the first by order, and by the fields."""
    cells = F.struct(*[F.col(c).alias(f"_o{i}") for i, c in enumerate(order)], *[F.col(f).alias(f"_{f}") for f in fields])
    return source.where(F.col(key).isNotNull()).groupBy(key).agg(F.min(cells).alias("_r")).select(key, *[F.col(f"_r._{f}").alias(f"_{f}") for f in fields])


def fill_gaps(base: DataFrame, source: DataFrame, key: str, fields: Sequence[str], name: str, order: Sequence[str] = ()) -> DataFrame:
    """Empty cells from source; filled_from names it and the fields it filled, added to what base has there.

    Non-empty cells never change. Of source rows that repeat a key the first by order counts, so base rows never multiply.
    Several sources: one call after the other.
    """
    right = one_row(source, key, fields, order)
    taken = {f: is_empty(F.col(f)) & ~is_empty(F.col(f"_{f}")) for f in fields}
    joined = base.join(right, key, "left")
    before = [F.nullif(F.col("filled_from"), F.lit(""))] if "filled_from" in base.columns else []
    note = F.concat_ws(",", *before, *[F.when(t, F.lit(f"{name}:{f}")) for f, t in taken.items()])
    return joined.select(*[F.when(taken[c], F.col(f"_{c}")).otherwise(F.col(c)).alias(c) if c in taken else F.col(c) for c in base.columns if c != "filled_from"], note.alias("filled_from"))


def fill_counts(filled: DataFrame) -> DataFrame:
    """source, field, n: how many cells each source filled."""
    each = filled.select(F.explode(F.split("filled_from", ",")).alias("x")).where("x <> ''")
    return each.groupBy(F.split_part("x", F.lit(":"), F.lit(1)).alias("source"), F.split_part("x", F.lit(":"), F.lit(2)).alias("field")).agg(F.count(F.lit(1)).alias("n"))


def consolidated(df: DataFrame, pairs: dict[str, Sequence[str]]) -> DataFrame:
    """For each target its first non-empty column, in place of all of them."""
    gone = {c for cs in pairs.values() for c in cs} - set(pairs)
    return df.withColumns({t: F.coalesce(*[F.when(~is_empty(F.col(c)), F.col(c)) for c in cs]) for t, cs in pairs.items()}).drop(*gone)


def own_or_area(df: DataFrame, areas: DataFrame, area: str, own: str, proxy: str, out: str) -> DataFrame:
    """A row's own value, else its area's (one row for each area), as column out, with out_source: "own", "area" or null."""
    right = one_row(areas, area, [proxy])
    joined = df.join(right, area, "left")
    return joined.select(*df.columns, F.coalesce(own, f"_{proxy}").alias(out), F.when(F.col(own).isNotNull(), "own").when(F.col(f"_{proxy}").isNotNull(), "area").alias(f"{out}_source"))


def updated_columns(table: DataFrame, news: DataFrame, key: str, fields: Sequence[str], order: Sequence[str] = ()) -> DataFrame:
    """table with the fields of news wherever that has a value; all other columns, vectors too, as they are."""
    right = one_row(news, key, fields, order)
    return table.join(right, key, "left").select(*[F.coalesce(F.col(f"_{c}"), F.col(c)).alias(c) if c in fields else F.col(c) for c in table.columns])


def overwrite(base: DataFrame, source: DataFrame, key: str, fields: Sequence[str]) -> DataFrame:
    """Cells from source wherever it has a value."""
    return updated_columns(base, source, key, fields)


def upsert_plan(target: DataFrame, local: DataFrame, key: str, fields: Sequence[str]) -> DataFrame:
    """(key, field, value) for each cell that target lacks and local has: a change set, the same when made again.

    Of local rows that repeat a key the first by the fields counts; a target that repeats a key gets each change once.
    """
    right = one_row(local.select(key, *[F.col(f).cast("string").alias(f) for f in fields]), key, fields)
    cells = F.array(*[F.struct(F.lit(f).alias("field"), F.when(is_empty(F.col(f)) & ~is_empty(F.col(f"_{f}")), F.col(f"_{f}")).alias("value")) for f in fields])
    return target.join(right, key).select(key, F.explode(F.filter(cells, lambda c: c["value"].isNotNull())).alias("c")).select(key, "c.field", "c.value").distinct()


def newest_pass(cache: DataFrame, key: str, passes: Sequence[str], schema: str) -> DataFrame:
    """The fields of the last pass (JSON text) that can be read."""
    parsed = F.coalesce(*[parsed_json(F.col(p), schema, F.lit(None)) for p in reversed(passes)])
    return cache.select(key, parsed.alias("_p")).select(key, "_p.*")


def apply_cache(table: DataFrame, cache: DataFrame, key: str, passes: Sequence[str], schema: str) -> DataFrame:
    """table with its empty cells filled from the newest readable pass of its row in the cache, typed by the schema.

    Fields of the schema that table lacks are added. What table has is never changed; rows without a cache stay as they are.
    Of cache rows that repeat a key the first by the passes counts; columns of the cache other than the passes are not read.
    """
    one = one_row(cache.select(key, *passes), key, list(passes)).select(key, *[F.col(f"_{p}").alias(p) for p in passes])
    found = newest_pass(one, key, passes, schema)
    fields = [c for c in found.columns if c != key]
    right = found.select(F.col(key).alias("_key"), *[F.col(c).alias(f"_new_{c}") for c in fields])
    kinds = dict(table.dtypes)
    value = lambda c: F.when(is_empty(F.col(c)), F.col(f"_new_{c}").cast(kinds[c])).otherwise(F.col(c)) if c in kinds else F.col(f"_new_{c}")
    joined = table.join(right, table[key] == F.col("_key"), "left")
    return joined.select(*[(value(c) if c in fields else F.col(c)).alias(c) for c in table.columns], *[value(c).alias(c) for c in fields if c not in kinds])


def planned_counts(plan: DataFrame, fields: Sequence[str]) -> DataFrame:
    """field, n: how many cells of each field a change set fills, 0 where none."""
    counts = plan.groupBy("field").agg(F.count(F.lit(1)).alias("n"))
    every = plan.sparkSession.range(1).select(F.explode(F.array(*map(F.lit, fields))).alias("field"))
    return every.join(counts, "field", "left").select("field", F.coalesce("n", F.lit(0)).alias("n"))


def untouched(target: DataFrame, local: DataFrame, key: str, fields: Sequence[str]) -> DataFrame:
    """Whole-record variant: local rows for targets that have no value in any of the fields."""
    none = F.lit(True)
    for f in fields:
        none = none & is_empty(F.col(f))
    bare = target.groupBy(key).agg(F.min(none).alias("_bare")).where("_bare").select(key)
    return local.join(bare, key, "left_semi")


def rich_or_generated(text: Column, generated: Column, least: int = 200) -> Column:
    return F.when(F.length(text) > least, text).otherwise(generated)
