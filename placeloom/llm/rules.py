"""Quality rules: a decision list learnt from labelled statistics.

Measures of every text are worked out by array functions. Labelled rows are
counted by their vector of bins, so what reaches the driver is bounded by the
number of vectors, not of rows. Sequential covering then grows a conjunction of
thresholds, prunes it on held-out counts, takes out what it covers, and so on;
one that fails on the counts is set aside, and the next best begins elsewhere.
The list becomes one conditional expression.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from placeloom.llm.common import SPACE, let, stage, text_of, unstage

#: Words in a window that may repeat; what a text must have, and may repeat, to pass the base rules.
WINDOW, LEAST_WORDS, MOST_REPEATED = 5, 10, 20
#: Thresholds tried for each measure; conditions in a rule; rules; share of bad rows a rule must catch among all it catches.
BINS, CONDITIONS, RULES, PRECISION, LEAST_CAUGHT = 8, 3, 12, 0.9, 8
#: Shares of all rows at which thresholds lie besides, for kinds that are rare; shares of the bad and of the good rows likewise.
TAILS, OF_BAD, OF_GOOD = (0.01, 0.9, 0.99), (0.1, 0.25, 0.5, 0.75, 0.9), (0.001, 0.999, 1.0)


#: Rows of counts that the driver learns from, at most.
VECTORS = 200_000
MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_stutters")


def measures(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep=()) -> DataFrame:
    """id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words and n_stutters (words equal to the
    one before) of every whole text; a null text has no words.

    One row for each row of docs: repeated rows are measured alike, null ids stay, an empty table gives an empty one. Only
    the columns in keep are carried besides; they must not have a measure's name. Other columns may have any name.
    """
    if set(keep) & {id_col, *MEASURES}:
        raise ValueError(f"columns to keep may not be named {sorted(set(keep) & {id_col, *MEASURES})}")
    blank = " \t\n\x0b\f\r"
    text = text_of(text_col)
    rows = docs.select(F.col(id_col).alias("_id"), F.struct(*keep).alias("_kept") if keep else F.lit(None).alias("_kept"), text.alias("_text")).withColumn("_trim", F.btrim("_text", F.lit(blank)))
    words = F.when(F.col("_trim") == "", F.array().cast("array<string>")).otherwise(F.split("_trim", SPACE))
    n = lambda c: F.length(c).cast("long")
    lines = F.filter(F.split("_text", "\n"), lambda x: F.btrim(x, F.lit(blank)) != "")
    return rows.select(
        "_id",
        "_kept",
        let(words, lambda w: F.struct(F.size(w).cast("long").alias("n"), _repeated(w).alias("r"), F.size(F.filter(w, lambda x, k: F.coalesce(F.get(w, k - 1) == x, F.lit(False)))).cast("long").alias("s"))).alias("_w"),
        n(F.regexp_replace("_text", SPACE, "")).alias("word_chars"),
        (n("_text") - n(F.translate("_text", "#*$%&|<>", ""))).alias("n_symbols"),
        let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines"),
    ).select(F.col("_id").alias(id_col), *[F.col("_kept").getField(c).alias(c) for c in keep], F.col("_w.n").alias("n_words"), "word_chars", "n_symbols", "n_dup_lines", F.col("_w.r").alias("n_repeat_words"), F.col("_w.s").alias("n_stutters"))


def _repeated(words: Column) -> Column:
    """Words in windows that the text has twice or more. Equal windows meet by sorting their hashes."""

    def counted(hashes: Column) -> Column:
        pairs = F.sort_array(F.transform(hashes, lambda h, k: F.struct(h.alias("h"), k.alias("k"))))
        twice = lambda ps: F.filter(ps, lambda p, k: (F.coalesce(F.get(ps, k - 1)["h"] == p["h"], F.lit(False))) | F.coalesce(F.get(ps, k + 1)["h"] == p["h"], F.lit(False)))
        starts = let(pairs, lambda ps: F.sort_array(F.transform(twice(ps), lambda p: p["k"])))
        covered = let(starts, lambda s: F.aggregate(F.transform(s, lambda x, k: F.least(F.lit(WINDOW), F.coalesce(F.get(s, k + 1), x + WINDOW) - x)), F.lit(0), lambda a, b: a + b))
        return F.when(F.size(F.array_distinct(hashes)) == F.size(hashes), F.lit(0)).otherwise(covered)

    windows = F.transform(F.sequence(F.lit(1), F.size(words) - (WINDOW - 1)), lambda k: F.xxhash64(F.slice(words, k, WINDOW)))
    return F.when(F.size(words) <= WINDOW, F.lit(0)).otherwise(let(windows, counted)).cast("long")


def scaled(measured: DataFrame) -> dict[str, Column]:
    """The measures that rules speak of, free of the text's length but for the first."""
    per = lambda c, k: F.coalesce(F.try_divide(F.col(c) * k, F.col("n_words").cast("double")), F.lit(0.0))
    return {"words": F.col("n_words").cast("double"), "word_length": per("word_chars", 1), "symbols": per("n_symbols", 100), "same_lines": per("n_dup_lines", 100), "repeated": per("n_repeat_words", 100), "stutters": per("n_stutters", 100)}


def base_failed() -> Column:
    return (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words"))


@dataclass(frozen=True)
class Condition:
    measure: str
    above: bool
    threshold: float

    def column(self, cols: dict[str, Column]) -> Column:
        c = cols[self.measure]
        return c > self.threshold if self.above else c <= self.threshold

    def __str__(self) -> str:
        return f"{self.measure} {'>' if self.above else '<='} {self.threshold:g}"


Rule = tuple[Condition, ...]


def statistics(measured: DataFrame, labels: DataFrame, id_col: str = "doc_id", label_col: str = "quality", bins: int = BINS) -> tuple[dict[str, list[float]], list[tuple]]:
    """Thresholds of each measure, and (vector of bins, held out?, bad rows, good rows) of what the base rules let pass.

    Thresholds are quantiles of all rows, of the bad ones, and the ends of the good ones. Where they part the labelled rows
    into more than VECTORS different vectors, each measure keeps every other threshold, until they do not: so at most
    VECTORS rows come to the driver, and each labelled row counts in one of them.
    """
    cols = scaled(measured)
    labelled = stage(measured.where(~base_failed()).join(labels.where(F.col(label_col).isNotNull()).select(F.col(id_col), F.col(label_col).alias("_label")), id_col).select(*[c.alias(k) for k, c in cols.items()], "_label", (F.pmod(F.xxhash64(id_col), F.lit(3)) == 0).alias("_held")), "labelled")
    cols = {k: F.col(k) for k in cols}
    at = sorted({*(i / bins for i in range(1, bins)), *TAILS})
    shares = {"": (F.lit(True), at), "bad_": (F.col("_label") == 0, list(OF_BAD)), "good_": (F.col("_label") != 0, list(OF_GOOD))}
    cuts = labelled.agg(*[F.percentile_approx(F.when(of, F.col(k)), q, 10_000).alias(p + k) for p, (of, q) in shares.items() for k in cols]).first()
    thresholds = {k: sorted({x for p in shares for x in cuts[p + k] or []}) for k in cols}

    def counted() -> DataFrame:
        bins = [sum(((F.col(k) > t).cast("int") for t in thresholds[k]), F.lit(0)) for k in cols]
        return labelled.groupBy(*[b.alias(f"b_{k}") for b, k in zip(bins, cols, strict=True)], "_held").agg(F.count_if(F.col("_label") == 0).alias("bad"), F.count_if(F.col("_label") != 0).alias("good"))

    while len(rows := counted().limit(VECTORS + 1).collect()) > VECTORS:
        thresholds = {k: t[1::2] for k, t in thresholds.items()}
    unstage(labelled)
    return thresholds, sorted((tuple(r[f"b_{k}"] for k in cols), r["_held"], r["bad"], r["good"]) for r in rows)


def learn(thresholds: dict[str, list[float]], counts: list[tuple], conditions: int = CONDITIONS, rules: int = RULES, precision: float = PRECISION, least: int = LEAST_CAUGHT) -> list[Rule]:
    """The decision list: each rule rejects; what no rule catches is kept. Empty without labelled rows."""
    names = list(thresholds)
    bins = np.array([r[0] for r in counts], np.int64).reshape(-1, len(names))
    held = np.array([r[1] for r in counts], bool)
    tallies = np.array([r[2:] for r in counts], np.int64).reshape(-1, 2)

    def holds(rule) -> np.ndarray:
        out = np.ones(len(bins), bool)
        for j, above, i in rule:
            out &= (bins[:, j] > i) == above
        return out

    def tally(rows, rule) -> tuple[int, int]:
        bad, good = tallies[rows & holds(rule)].sum(axis=0).tolist()
        return bad, good

    pure = lambda bad, good: (bad + 1) / (bad + good + 2)

    def grown(rows, failed) -> list:
        rule: list = []
        while len(rule) < conditions:
            caught = rows & holds(rule)
            bad, good = tallies[caught].sum(axis=0).tolist()
            options = []
            for j, k in enumerate(names):
                below = [np.cumsum(np.bincount(bins[caught, j], tallies[caught, c], len(thresholds[k]) + 1)).astype(int).tolist() for c in (0, 1)]
                for i in range(len(thresholds[k])):
                    for above in (True, False):
                        b, g = (bad - below[0][i], good - below[1][i]) if above else (below[0][i], below[1][i])
                        if b >= least and (rule or (j, above, i) not in failed):
                            options.append((b * (pure(b, g) - pure(bad, good)), (j, above, i)))
            best = max(options, default=(0, None))
            if best[0] <= 0 or good == 0:
                break
            rule.append(best[1])
        return rule

    out: list[Rule] = []
    rest = np.ones(len(bins), bool)
    # First conditions whose rules failed; tried again once a rule has taken rows away.
    failed: set = set()
    while len(out) < rules:
        rule = grown(rest & ~held, failed)
        if not rule:
            break
        first = rule[0]
        while len(rule) > 1 and pure(*tally(rest & held, rule[:-1])) >= pure(*tally(rest & held, rule)):
            rule = rule[:-1]
        bad, good = tally(rest, rule)
        held_bad, held_good = tally(rest & held, rule)
        if bad < least or bad < precision * (bad + good) or held_bad < max(1, precision * (held_bad + held_good)):
            failed.add(first)
            continue
        out.append(tuple(Condition(names[j], above, thresholds[names[j]][i]) for j, above, i in rule))
        rest &= ~holds(rule)
        failed.clear()
    return out


def verdict(rules: list[Rule], cols: dict[str, Column]) -> Column:
    """True where no rule rejects: WHEN rule THEN false ... ELSE true."""
    out = None
    for rule in rules:
        all_hold = rule[0].column(cols)
        for c in rule[1:]:
            all_hold = all_hold & c.column(cols)
        out = F.when(all_hold, F.lit(False)) if out is None else out.when(all_hold, F.lit(False))
    return F.lit(True) if out is None else out.otherwise(F.lit(True))


def judged(measured: DataFrame, rules: list[Rule]) -> DataFrame:
    """measured with base_failed and kept, n_stutters last: a row for each row, alike for rows with like measures; null ids
    and tables without rows are fine."""
    judged_ = measured.withColumn("base_failed", base_failed()).withColumn("kept", ~F.col("base_failed") & verdict(rules, scaled(measured)))
    return judged_.select(*[c for c in judged_.columns if c != "n_stutters"], "n_stutters")
