"""Joins of sources of different grain."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from placeloom.sources.scratch import staged


def additive(base: DataFrame, other: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Left join that brings only the columns that base lacks."""
    return base.join(other.select(*keys, *[c for c in other.columns if c not in base.columns]), list(keys), "left")


def replacing(base: DataFrame, other: DataFrame, keys: Sequence[str], prefix: str) -> DataFrame:
    """Left join whose columns get the prefix, in place of those base has with it."""
    kept = base.drop(*[c for c in base.columns if c.startswith(prefix) and c not in keys])
    return kept.join(other.select(*keys, *[F.col(c).alias(prefix + c) for c in other.columns if c not in keys]), list(keys), "left")


def by_either_key(base: DataFrame, other: DataFrame, first: tuple[str, str], second: tuple[str, str], values: Sequence[str]) -> DataFrame:
    """Left join by the first (base, other) pair of columns; rows without a match by the second.

    Of rows of other with one key the first by the values counts.
    """
    one = lambda c, k, v: other.where(F.col(c).isNotNull()).groupBy(F.col(c).alias(k)).agg(F.min(F.struct(*values)).alias(v))
    a, b = one(first[1], "_k1", "_v1"), one(second[1], "_k2", "_v2")
    both = base.join(a, base[first[0]] == F.col("_k1"), "left").join(b, base[second[0]] == F.col("_k2"), "left")
    return both.select(*base.columns, F.coalesce("_v1", "_v2").alias("_v")).select(*base.columns, *[F.col(f"_v.{v}").alias(v) for v in values])


def better_key(base: DataFrame, other: DataFrame, first: tuple[str, str], second: tuple[str, str], values: Sequence[str], least: float = 0.5) -> DataFrame:
    """Left join of the whole table by one pair of columns: the first, unless it matches under `least` of base's rows and the second more.

    One aggregate counts the matches of both; the choice is made by the plan, row by row alike.
    """
    one = lambda c, k, v: other.where(F.col(c).isNotNull()).groupBy(F.col(c).alias(k)).agg(F.min(F.struct(*values)).alias(v))
    joined = base.join(one(first[1], "_k1", "_v1"), base[first[0]] == F.col("_k1"), "left").join(one(second[1], "_k2", "_v2"), base[second[0]] == F.col("_k2"), "left")
    chosen = joined.agg(F.count("_k1").alias("a"), F.count("_k2").alias("b"), F.count(F.lit(1)).alias("n")).select(((F.col("a") < F.lit(least) * F.col("n")) & (F.col("b") > F.col("a"))).alias("_second"))
    both = joined.crossJoin(F.broadcast(chosen)).withColumn("_v", F.when(F.col("_second"), F.col("_v2")).otherwise(F.col("_v1")))
    return both.select(*base.columns, *[F.col(f"_v.{v}").alias(v) for v in values])


def full_periods(tables: dict[str, DataFrame], keys: Sequence[str]) -> DataFrame:
    """Full outer join of one aggregate for each period; their other columns get the period as suffix."""
    out = None
    for period, t in tables.items():
        t = t.select(*keys, *[F.col(c).alias(f"{c}_{period}") for c in t.columns if c not in keys])
        out = t if out is None else out.join(t, list(keys), "full")
    return out


def dual_grain(base: DataFrame, fine: DataFrame, fine_keys: Sequence[str], coarse: DataFrame, coarse_keys: Sequence[str], prefix: str = "area_") -> DataFrame:
    """Left joins with a fine table, whose figures may be missing, and a coarse one for context, under a prefix; both stay."""
    context = coarse.select(*coarse_keys, *[F.col(c).alias(prefix + c) for c in coarse.columns if c not in coarse_keys])
    return base.join(fine, list(fine_keys), "left").join(context, list(coarse_keys), "left").withColumn("has_fine", F.coalesce(*[F.col(c).isNotNull() for c in fine.columns if c not in fine_keys][:1]))


def with_constants(base: DataFrame, row: DataFrame, prefix: str = "") -> DataFrame:
    """base with the columns of a table of one row; nulls if it has none, an error if it has several."""
    return base.crossJoin(F.broadcast(_only(row, "_v"))).select(*base.columns, *[F.col(f"_v.{c}").alias(prefix + c) for c in row.columns])


def _only(row: DataFrame, name: str) -> DataFrame:
    """One row always: the struct of a table's only row, null without rows; more than one fail the job."""
    found = row.select(F.struct(*row.columns).alias("_s")).agg(F.first("_s").alias("_s"), F.count(F.lit(1)).alias("_n"))
    return found.select(F.when(F.col("_n") > 1, F.raise_error(F.lit("a table of constants has more than one row"))).otherwise(F.col("_s")).alias(name))


def aligned(tables: Sequence[DataFrame], keys: Sequence[str]) -> DataFrame:
    """Left joins of grid attributes onto the table with the most cells (of equals the first)."""
    sizes = [t.count() for t in tables]
    first = sizes.index(max(sizes))
    out = tables[first]
    for i, t in enumerate(tables):
        if i != first:
            out = out.join(t, list(keys), "left")
    return out


def known_in_all(base: DataFrame, others: Sequence[DataFrame], key: str) -> DataFrame:
    """Rows of base whose key all the others have."""
    for t in others:
        base = base.join(t.select(key), key, "left_semi")
    return base


def stop_routes(stop_times: DataFrame, trips: DataFrame, routes: DataFrame) -> DataFrame:
    """Distinct stop and route, with the route's columns: trips of a route at a stop count once, before the routes are joined."""
    served = stop_times.select("stop_id", "trip_id").join(trips.select("trip_id", "route_id"), "trip_id").select("stop_id", "route_id").distinct()
    return served.join(routes, "route_id")


def change_on(df: DataFrame, keys: Sequence[str], period: str, value: str) -> DataFrame:
    """df with the value one period before (that very period, gaps have none), the change, and per cent where the base is above 0."""
    before = df.select(*keys, (F.col(period) + 1).alias(period), F.col(value).alias("before"))
    out = df.join(before, [*keys, period], "left")
    return out.withColumn("change", F.col(value) - F.col("before")).withColumn("change_pct", F.when(F.col("before") > 0, (F.col(value) - F.col("before")) / F.col("before") * 100))


def append_unlike(base: DataFrame, more: DataFrame, name: str, least: int = 5) -> DataFrame:
    """base and those rows of more whose name neither contains a name of base nor is part of one, wherever in it; names under
    `least` characters only match as a whole. Names are compared lower-cased and trimmed; rows without a name are appended."""
    clean = lambda df, to: df.where(F.col(name).isNotNull()).select(F.lower(F.trim(F.col(name))).alias(to)).distinct()
    long = lambda df, c: df.where(F.length(c) >= least)
    parts = gram_pairs(clean(more, "_whole"), long(clean(base, "_part"), "_part"), []).select(F.col("_whole").alias("_b"))
    wholes = gram_pairs(clean(base, "_whole"), long(clean(more, "_part"), "_part"), []).select(F.col("_part").alias("_b"))
    known = parts.union(wholes).union(clean(more, "_b").join(clean(base, "_b"), "_b", "left_semi")).distinct()
    keyed = more.withColumn("_b", F.lower(F.trim(F.col(name))))
    return base.unionByName(keyed.join(known, "_b", "left_anti").select(*more.columns), allowMissingColumns=True)


def partial_names(base: DataFrame, text: str, names: DataFrame, name: str, to: str, least: int = 4) -> DataFrame:
    """base with the known name that its text contains, the longest; if it contains none, the shortest one that contains the text.

    Both without case and trimmed; of equal lengths the first in order. What is looked for has at least so many characters.
    """
    clean = lambda df, c, k: df.where(F.col(c).isNotNull()).select(F.lower(F.trim(F.col(c))).alias(k)).where(F.length(k) > 0).distinct()
    texts, known = clean(base, text, "_x"), clean(names, name, "_x")
    long = lambda df: df.where(F.length("_x") >= least).withColumnRenamed("_x", "_part")
    whole = lambda df: df.withColumnRenamed("_x", "_whole")
    inside = gram_pairs(whole(texts), long(known), []).groupBy(F.col("_whole").alias("_x")).agg(F.min(F.struct((-F.length("_part")).alias("n"), F.col("_part").alias("name"))).alias("_in"))
    around = gram_pairs(whole(known), long(texts), []).groupBy(F.col("_part").alias("_x")).agg(F.min(F.struct(F.length("_whole").alias("n"), F.col("_whole").alias("name"))).alias("_out"))
    original = names.where(F.col(name).isNotNull()).groupBy(F.lower(F.trim(F.col(name))).alias("_name")).agg(F.min(name).alias(to))
    found = inside.join(around, "_x", "full").select("_x", F.coalesce("_in.name", "_out.name").alias("_name")).join(original, "_name").select("_x", to)
    return base.withColumn("_x", F.lower(F.trim(F.col(text)))).join(found, "_x", "left").select(*base.columns, to)


def cascade(base: DataFrame, levels: Sequence[tuple[str, DataFrame, Sequence[str]]], values: Sequence[str]) -> DataFrame:
    """Values from the first level that has any of them for the row's key, and data_source, that level's name.

    levels: (name, table, keys); a table without keys has one row and holds for all; without rows it holds for none,
    and more than one fail the job. A level whose values are all null is passed over. Levels by name parts take their keys
    from partial_names, by postcode from a join with the map.
    """
    out = base
    some = F.when(F.greatest(*[F.col(v).isNotNull() for v in values], F.lit(False)), F.struct(*values))
    for i, (_, t, keys) in enumerate(levels):
        right = t.select(*keys, some.alias(f"_v{i}")) if keys else _only(t.select(*values), f"_v{i}").select(F.when(F.greatest(*[F.col(f"_v{i}.{v}").isNotNull() for v in values], F.lit(False)), F.col(f"_v{i}")).alias(f"_v{i}"))
        out = out.join(right, list(keys), "left") if keys else out.crossJoin(F.broadcast(right))
    found = F.coalesce(*[F.col(f"_v{i}") for i in range(len(levels))])
    source = F.coalesce(*[F.when(F.col(f"_v{i}").isNotNull(), name) for i, (name, _, _) in enumerate(levels)])
    return out.select(*base.columns, found.alias("_v"), source.alias("data_source")).select(*base.columns, *[F.col(f"_v.{v}").alias(v) for v in values], "data_source")


def append_new(base: DataFrame, more: DataFrame, keys: Sequence[str]) -> DataFrame:
    return base.unionByName(more.join(base.select(*keys), list(keys), "left_anti"), allowMissingColumns=True)


def similarity(a: Column, b: Column) -> Column:
    """1 for equal texts, 0 for texts with nothing in place: edit distance over the longer length."""
    return 1 - F.levenshtein(a, b) / F.greatest(F.length(a), F.length(b), F.lit(1))


#: Which rows of the right may be a row's match: any, any of another key, or those of a greater key.
ANY, OTHER, LATER = "any", "other", "later"


def _names(df: DataFrame, block: Sequence[str], name: str, to: str) -> DataFrame:
    return df.where(F.col(name).isNotNull()).select(*block, F.col(name).alias(to)).distinct()


def _by_name(right: DataFrame, block: Sequence[str], name: str, tie: str) -> DataFrame:
    """The two smallest keys of each name in a block: no group of equal names is ever paired out."""
    rows = right.where(F.col(name).isNotNull()).select(*block, F.col(name).alias("_b"), F.col(tie).alias("_t"))
    ranked = rows.withColumn("_i", F.row_number().over(Window.partitionBy(*block, "_b").orderBy("_t"))).where("_i <= 2")
    return ranked.groupBy(*block, "_b").agg(F.min("_t").alias("_t1"), F.max(F.when(F.col("_i") == 2, F.col("_t"))).alias("_t2"))


def near_names(left: DataFrame, right: DataFrame, block: Sequence[str], percent: int) -> DataFrame:
    """(block, _a, _b) of distinct names of left(block, _a) and right(block, _b) whose similarity is at least so many per cent.

    A pair that similar differs by k edits at most, k a share of a length; of k + 1 segments of one name, then, one is whole
    in the other, shifted by no more than the edits before and after it allow. So the join is one of equal segments.
    """
    la, lb = F.length("_a"), F.length("_b")
    edits = lambda n: F.floor(n * F.lit(100 - percent) / F.lit(percent) + 1e-9).cast("int")
    start = lambda i, n, k: F.floor(i * n / (k + 1)).cast("int")

    def segments(n: Column) -> Column:
        k = edits(n)
        return F.transform(F.sequence(F.lit(0), k), lambda i: F.struct(n.alias("n"), i.alias("i"), k.alias("k"), start(i, n, k).alias("at"), (start(i + 1, n, k) - start(i, n, k)).alias("size")))

    def probes(s: Column) -> Column:
        shift = la - s["n"]
        low = F.greatest(F.lit(0), s["at"] - s["i"], s["at"] + shift - (s["k"] - s["i"]))
        high = F.least(la - s["size"], s["at"] + s["i"], s["at"] + shift + (s["k"] - s["i"]))
        cut = F.transform(F.when(low <= high, F.sequence(low, high)).otherwise(F.array().cast("array<int>")), lambda p: F.substring(F.col("_a"), p + 1, s["size"]))
        return F.transform(F.array_distinct(cut), lambda x: F.struct(s["n"].alias("n"), s["i"].alias("i"), x.alias("x")))

    lengths = F.sequence(F.ceil(la * percent / 100 - 1e-9).cast("int"), F.floor(la * 100 / F.lit(percent) + 1e-9).cast("int"))
    asking = left.where(la > 0).withColumn("_n", F.explode(lengths)).where("_n > 0").withColumn("_k", F.explode(F.flatten(F.transform(segments(F.col("_n")), probes))))
    known = right.where(lb > 0).withColumn("_s", F.explode(segments(lb))).select(*block, "_b", F.col("_s.n").alias("n"), F.col("_s.i").alias("i"), F.substring(F.col("_b"), F.col("_s.at") + 1, F.col("_s.size")).alias("x"))
    pairs = asking.select(*block, "_a", "_k.*").join(_merged(known), [*block, "n", "i", "x"]).select(*block, "_a", "_b").distinct()
    return pairs.where(similarity(F.col("_a"), F.col("_b")) >= percent / 100 - 1e-12)


def best_match(left: DataFrame, right: DataFrame, block: Sequence[str], a: str, b: str, key: str, tie: str, least: float, which: str = ANY, levels: Sequence[int] = (90, 80)) -> DataFrame:
    """left with the most similar row of right in the same block, from `least` on: its columns, and score; ties by the key `tie`.

    which: ANY row of right, or, where both sides are the same table, OTHER than the row itself. Keys of right are distinct.

    Names are compared, not rows: equal ones by a join, then the rows still without a match by descending levels of
    similarity in per cent, each a join of equal segments (near_names), the rest by bands of length. What is found at
    a level is the best, since all that is as good is found there; a row leaves with it. Null names match nothing.
    """
    if which not in (ANY, OTHER):
        raise ValueError("best_match is for any or for other rows")
    groups = staged(_by_name(right, block, b, tie))
    rows = left.where(F.col(a).isNotNull()).select(*block, F.col(a).alias("_a"), F.col(key).alias("_key"))
    same = rows.join(groups.withColumnRenamed("_b", "_a"), [*block, "_a"])
    own = F.when(F.col("_t1") == F.col("_key"), F.col("_t2")).otherwise(F.col("_t1")) if which == OTHER else F.col("_t1")
    found = staged(same.select(*block, "_key", own.alias("_t"), F.lit(1.0).alias("score")).where("_t is not null"))
    parts, rest = [found], staged(rows.join(found.select("_key").distinct(), "_key", "left_anti"))
    for percent in [x for x in levels if x / 100 >= least] + [None]:
        asked = rest.select(*block, "_a").distinct()
        names = groups.select(*block, "_b")
        if percent is not None:
            pairs = near_names(asked, names, block, percent)
        else:
            la, lb = F.length("_a"), F.length("_b")
            by_length = names.withColumn("_n", lb)
            bands = F.sequence(F.ceil(la * least - 1e-9).cast("int"), F.floor(la / F.lit(max(least, 0.01)) + 1e-9).cast("int"))
            pairs = asked.withColumn("_n", F.explode(bands)).join(by_length, [*block, "_n"]).drop("_n")
        scored = pairs.where("_a <> _b").withColumn("score", similarity(F.col("_a"), F.col("_b"))).where(F.col("score") >= least)
        best = scored.join(groups, [*block, "_b"]).groupBy(*block, "_a").agg(F.min(F.struct((-F.col("score")).alias("s"), F.col("_t1").alias("t"))).alias("_m"))
        found = staged(rest.join(best, [*block, "_a"]).select(*block, "_key", F.col("_m.t").alias("_t"), (-F.col("_m.s")).alias("score")))
        parts.append(found)
        if percent is not None:
            rest = staged(rest.join(found.select("_key").distinct(), "_key", "left_anti"))
            if rest.isEmpty():
                break
    matches = reduce(DataFrame.unionByName, parts)
    chosen = left.join(matches.withColumnRenamed("_key", key), [*block, key]).withColumnRenamed("_t", tie)
    return chosen.join(right, [*block, tie])


def _merged(df: DataFrame) -> DataFrame:
    """df to be joined by sorting: exploded texts are many times what their size on disk promises, so they must not go through the driver."""
    return df.hint("merge")


def gram_pairs(wholes: DataFrame, parts: DataFrame, block: Sequence[str], size: int = 5) -> DataFrame:
    """(block, _whole, _part) of wholes(block, _whole) and parts(block, _part), both distinct, where the whole contains the part.

    A part is looked for by the one of its stretches of `size` characters that the fewest wholes have; parts shorter than
    that by themselves. Empty parts are in nothing.
    """
    stretches = lambda c, n: F.transform(F.sequence(F.lit(1), F.length(c) - n + 1), lambda i: F.substring(F.col(c), i, F.lit(n)))
    every = F.array_distinct(F.flatten(F.array(*[F.when(F.length("_whole") >= n, stretches("_whole", n)).otherwise(F.array().cast("array<string>")) for n in range(1, size + 1)])))
    grams = wholes.where(F.length("_whole") > 0).withColumn("_g", F.explode(every))
    asked = parts.where(F.length("_part") > 0)
    own = F.when(F.length("_part") < size, F.array("_part")).otherwise(F.array_distinct(stretches("_part", size)))
    counts = grams.groupBy(*block, "_g").agg(F.count(F.lit(1)).alias("_n"))
    # a stretch that no whole has rules the part out
    rare = asked.withColumn("_g", F.explode(own)).join(_merged(counts), [*block, "_g"], "left").groupBy(*block, "_part").agg(F.min(F.struct(F.coalesce("_n", F.lit(0)).alias("n"), F.col("_g").alias("g"))).alias("_r"))
    rare = rare.where("_r.n > 0").select(*block, "_part", F.col("_r.g").alias("_g"))
    return grams.join(_merged(rare), [*block, "_g"]).where(F.contains(F.col("_whole"), F.col("_part"))).select(*block, "_whole", "_part")


def _shared_words(short: DataFrame, long: DataFrame, block: Sequence[str], x: str, y: str, least: float) -> DataFrame:
    """(block, x, y) where y has at least a share `least` of x's distinct words, and as many words or more.

    x must share one of its rarest words, as many as it can lack and one more: only those are looked up.
    """
    words = lambda c: F.array_distinct(F.filter(F.split(c, " "), lambda w: w != ""))
    theirs = long.withColumn("_w", F.explode(words(y)))
    counts = theirs.groupBy(*block, "_w").agg(F.count(F.lit(1)).alias("_n"))
    mine = short.withColumn("_size", F.size(words(x))).withColumn("_w", F.explode(words(x))).join(_merged(counts), [*block, "_w"], "left")
    ordered = mine.groupBy(*block, x, "_size").agg(F.array_sort(F.collect_list(F.struct(F.coalesce("_n", F.lit(0)).alias("n"), F.col("_w").alias("w")))).alias("_o"))
    may_lack = F.col("_size") - F.ceil(F.col("_size") * F.lit(least) - 1e-9).cast("int")
    asked = ordered.withColumn("_w", F.explode(F.transform(F.slice("_o", 1, may_lack + 1), lambda o: o["w"]))).select(*block, x, "_size", "_w")
    return asked.join(_merged(theirs), [*block, "_w"]).where(F.size(words(y)) >= F.col("_size")).select(*block, x, y).distinct()


def matching_names(left: DataFrame, right: DataFrame, block: Sequence[str], least: float = 0.7) -> DataFrame:
    """(block, _a, _b, score) of left(block, _a) and right(block, _b), distinct names: 1 where one contains the other, else the share
    of the shorter one's distinct words that both have, from `least` on."""
    x, y = F.split("_a", " "), F.split("_b", " ")
    share = F.size(F.array_intersect(x, y)) / F.least(F.size(F.array_distinct(x)), F.size(F.array_distinct(y)))
    inside = gram_pairs(left.withColumnRenamed("_a", "_whole"), right.withColumnRenamed("_b", "_part"), block).select(*block, F.col("_whole").alias("_a"), F.col("_part").alias("_b"))
    around = gram_pairs(right.withColumnRenamed("_b", "_whole"), left.withColumnRenamed("_a", "_part"), block).select(*block, F.col("_part").alias("_a"), F.col("_whole").alias("_b"))
    words = _shared_words(left, right, block, "_a", "_b", least).unionByName(_shared_words(right, left, block, "_b", "_a", least))
    pairs = inside.unionByName(around).unionByName(words).distinct()
    score = F.when(F.contains(F.col("_a"), F.col("_b")) | F.contains(F.col("_b"), F.col("_a")), 1.0).otherwise(share)
    return pairs.withColumn("score", score).where(F.col("score") >= least)


def token_match(left: DataFrame, right: DataFrame, block: Sequence[str], a: str, b: str, key: str, tie: str, least: float = 0.7, which: str = ANY, prefix: int | None = None) -> DataFrame:
    """left with the best row of right in its block: score and rule, the best score first, ties by the key `tie`.

    Rule 1: one name contains the other, or both share words (matching_names). Rule 2, where a prefix length is given and
    rule 1 finds nothing: the only row whose name contains the first so many characters of the row's; if no row does, the first row,
    by key, whose own first characters are inside the row's name. Its score is null.

    which: ANY row of right, OTHER than itself, or only LATER ones, of greater keys. Distinct names are matched, and rows of a
    name are then taken in order of key: groups of equal names are not paired out. Null and empty names match nothing.
    """
    names = staged(matching_names(_names(left, block, a, "_a").where("_a <> ''"), _names(right, block, b, "_b").where("_b <> ''"), block, least))
    rows = left.where(F.col(a).isNotNull()).select(*block, F.col(a).alias("_a"), F.col(key).alias("_key"))
    if which == LATER:
        # the rows of both names in order of key: of each row of left the next one of right
        mine = rows.join(_merged(names), [*block, "_a"]).select(*block, "_a", "_b", "score", F.col("_key").alias("_k"), F.lit(None).cast(right.schema[tie].dataType).alias("_t"))
        others = right.where(F.col(b).isNotNull()).select(*block, F.col(b).alias("_b"), F.col(tie).alias("_t")).join(_merged(names), [*block, "_b"])
        both = mine.unionByName(others.select(*block, "_a", "_b", "score", F.col("_t").alias("_k"), "_t"))
        after = Window.partitionBy(*block, "_a", "_b").orderBy(F.desc("_k")).rangeBetween(Window.unboundedPreceding, -1)
        found = both.withColumn("_next", F.min("_t").over(after)).where("_t is null and _next is not null").select(*block, F.col("_k").alias("_key"), F.col("_next").alias("_t"), "score")
    else:
        found = rows.join(_merged(names.join(_merged(_by_name(right, block, b, tie)), [*block, "_b"])), [*block, "_a"])
        own = F.when(F.col("_t1") == F.col("_key"), F.col("_t2")).otherwise(F.col("_t1")) if which == OTHER else F.col("_t1")
        found = found.select(*block, "_key", own.alias("_t"), "score").where("_t is not null")
    best = found.groupBy(*block, "_key").agg(F.min(F.struct((-F.col("score")).alias("s"), F.col("_t").alias("t"))).alias("_m"))
    best = best.select(*block, "_key", F.col("_m.t").alias("_t"), (-F.col("_m.s")).alias("score"), F.lit(1).alias("rule"))
    if prefix:
        best = staged(best)
        best = best.unionByName(_by_prefix(rows.join(_merged(best.select("_key")), "_key", "left_anti"), right, block, b, tie, prefix))
    return left.join(_merged(best.withColumnRenamed("_key", key)), [*block, key]).withColumnRenamed("_t", tie).join(_merged(right), [*block, tie])


def _by_prefix(rows: DataFrame, right: DataFrame, block: Sequence[str], b: str, tie: str, prefix: int) -> DataFrame:
    """Rule 2 of token_match for rows(block, _a, _key)."""
    asked = rows.where("_a <> ''").withColumn("_p", F.substring("_a", 1, prefix))
    theirs = right.where((F.col(b).isNotNull()) & (F.col(b) != "")).select(*block, F.col(b).alias("_b"), F.col(tie).alias("_t"))
    named = theirs.groupBy(*block, "_b").agg(F.count(F.lit(1)).alias("_n"), F.min("_t").alias("_t"))
    inside = gram_pairs(named.select(*block, F.col("_b").alias("_whole")), asked.select(*block, F.col("_p").alias("_part")).distinct(), block)
    single = inside.withColumnRenamed("_whole", "_b").join(_merged(named), [*block, "_b"]).groupBy(*block, F.col("_part").alias("_p")).agg(F.sum("_n").alias("_n"), F.min("_t").alias("_t"))
    first = asked.join(_merged(single), [*block, "_p"], "left")
    heads = theirs.groupBy(*block, F.substring("_b", 1, prefix).alias("_h")).agg(F.min("_t").alias("_t"))
    left_over = first.where("_n is null").select(*block, "_a", "_key")
    back = gram_pairs(left_over.select(*block, F.col("_a").alias("_whole")).distinct(), heads.select(*block, F.col("_h").alias("_part")), block)
    back = back.withColumnRenamed("_part", "_h").join(_merged(heads), [*block, "_h"]).groupBy(*block, F.col("_whole").alias("_a")).agg(F.min("_t").alias("_t"))
    found = first.where("_n = 1").select(*block, "_key", "_t").unionByName(left_over.join(_merged(back), [*block, "_a"]).select(*block, "_key", "_t"))
    return found.select("*", F.lit(None).cast("double").alias("score"), F.lit(2).alias("rule"))


def latest_value(columns: Sequence[tuple[int, str]]) -> tuple[Column, Column]:
    """(value, year) of the latest year's column that has a value."""
    order = sorted(columns, reverse=True)
    return F.coalesce(*[F.col(c) for _, c in order]), F.coalesce(*[F.when(F.col(c).isNotNull(), y) for y, c in order])
