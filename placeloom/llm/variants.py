"""Spelling variants: words one inserted, deleted or replaced character apart, by permuterm rotations.

The rotations of a word followed by a terminator, sorted, bring words together that agree in all but one place: a
rotation that begins behind the place ends with its character, so what goes before it is a prefix of the rotations of
all words that have another character there, and it is the whole rotation of the word that lacks it. A group of one
prefix holds at most one word for each letter and the one without; counts and the commonest neighbours come from the
group as a whole, so that no pairs are made.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from placeloom.llm.common import stage, text_of, unstage

#: Behind the last character of a word; not a letter.
END = "$"
LEAST_LENGTH, LEAST_COUNT, TIMES = 6, 5, 5
_UPPER = "".join(map(chr, range(65, 91)))


def ascii_lower(word: Column) -> Column:
    """A-Z lower-cased, other letters as they are."""
    return F.when(F.octet_length(word) == F.length(word), F.lower(word)).otherwise(F.translate(word, _UPPER, _UPPER.lower()))


def runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: int = LEAST_LENGTH) -> DataFrame:
    """id_col, word: each maximal run of letters of at least so many characters, lower-cased. Null texts have none."""
    found = F.explode(F.regexp_extract_all(text_of(text_col), F.lit(rf"[A-Za-zÀ-ÿ]{{{least},}}"), F.lit(0)))
    return docs.select(F.col(id_col), found.alias("_run")).select(id_col, ascii_lower(F.col("_run")).alias("word"))


def misspelt(words: DataFrame, id_col: str = "doc_id", one_in: int = 199) -> DataFrame:
    """words with a character less in one of so many: where one_in divides h = crc32(id:word), that at h % length. A null id is the empty text."""
    h = F.crc32(F.concat(F.coalesce(F.col(id_col).cast("string"), F.lit("")), F.lit(":"), F.col("word")).cast("binary"))
    at = F.pmod(h, F.length("word")).cast("int")
    less = F.concat(F.substring(F.col("word"), F.lit(1), at), F.substring(F.col("word"), at + 2, F.length("word")))
    return words.select(id_col, F.when(F.pmod(h, F.lit(one_in)) == 0, less).otherwise(F.col("word")).alias("word"))


def counted(words: DataFrame, least_length: int = LEAST_LENGTH, least_count: int = LEAST_COUNT) -> DataFrame:
    """word, n of the words long and frequent enough."""
    return words.where(F.length("word") >= least_length).groupBy("word").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= least_count)


def neighbours(counts: DataFrame) -> DataFrame:
    """word, n_near, form_n, best: how many words of counts(word, n) are near each, and the commonest of them (of equals the first).

    Only words with a near one have a row. A word with a double letter gives the same word whichever of the two goes:
    only the first counts.
    """
    size = F.length("word")
    turned = lambda i: F.concat(F.substring(F.col("word"), i + 1, size), F.lit(END), F.substring(F.col("word"), F.lit(1), i))
    # (prefix, last): the whole rotation, or all but its last character where that is a letter
    whole = F.transform(F.sequence(F.lit(0), size), lambda i: F.struct(turned(i).alias("prefix"), F.lit("").alias("last")))
    cut = F.transform(F.sequence(F.lit(1), size), lambda i: F.struct(F.substring(turned(i), F.lit(1), size).alias("prefix"), F.substring(F.col("word"), i, F.lit(1)).alias("last")))
    rotations = counts.where(size > 0).select("word", "n", F.explode(F.concat(whole, cut)).alias("_r")).select("word", "n", "_r.*")
    group = Window.partitionBy("prefix")
    # which members a member is near: the others with a letter; and the whole one, unless the letter repeats the one before it
    doubled = F.col("last") == F.substring(F.col("prefix"), -1, 1)
    letters, singles, wholes = (F.count_if(c).over(group) for c in (F.col("last") != "", (F.col("last") != "") & ~doubled, F.col("last") == ""))
    order = group.orderBy("last").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    key = F.struct((-F.col("n")).alias("_less"), F.col("word").alias("_word"))
    mine = F.col("last") == ""
    firsts = lambda c: F.slice(F.array_sort(F.collect_list(F.when(c, key)).over(order)), 1, 2)
    seen = rotations.select(
        "word", "last", doubled.alias("_doubled"), letters.alias("_letters"), singles.alias("_singles"), wholes.alias("_wholes"),
        firsts(F.col("last") != "").alias("_by_letter"), firsts((F.col("last") != "") & ~doubled).alias("_by_single"), firsts(mine).alias("_whole"),
    ).where("_letters + _wholes > 1")
    near = F.when(mine, F.col("_singles")).otherwise(F.col("_letters") - 1 + F.when(F.col("_doubled"), 0).otherwise(F.col("_wholes")))
    others = F.filter("_by_letter", lambda x: x["_word"] != F.col("word"))
    best = F.when(mine, F.get("_by_single", F.lit(0))).otherwise(F.least(F.get(others, F.lit(0)), F.when(~F.col("_doubled"), F.get("_whole", F.lit(0)))))
    found = seen.select("word", near.alias("_near"), best.alias("_best")).where("_near > 0").groupBy("word").agg(F.sum("_near").alias("n_near"), F.min("_best").alias("_best"))
    return found.select("word", "n_near", (-F.col("_best._less")).alias("best_n"), F.col("_best._word").alias("best"))


def forms(counts: DataFrame, times: int = TIMES) -> DataFrame:
    """word, form, root, n, n_near, form_n for every word of counts(word, n).

    form: the commonest near word (of equals the first in code-point order) if it comes at least so many times as often,
    else null. root: the last word reached by following forms. As counts grow with each step, steps double until no root
    moves: some five rounds, each a join of the words that have a form, written down. An empty table gives an empty one.
    """
    far = F.col("best_n") >= times * F.col("n")
    joined = stage(counts.join(neighbours(counts), "word", "left").select("word", F.when(far, F.col("best")).alias("form"), "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.when(far, F.col("best_n")).alias("form_n")), "forms")
    links = stage(joined.where("form is not null").select("word", F.col("form").alias("root")), "roots")
    while True:
        further = links.select(F.col("word").alias("root"), F.col("root").alias("_next"))
        moved = stage(links.join(further, "root", "left").select("word", F.coalesce("_next", "root").alias("root"), F.col("_next").isNotNull().alias("_moved")), "roots")
        unstage(links)
        links = moved
        if moved.where("_moved").isEmpty():
            break
    return joined.join(links.select("word", "root"), "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def spelling(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """forms of the words of whole texts, one in 199 with a character less.

    Null and empty texts have no words; repeated rows count as often as they are there; null ids are the empty text;
    further columns are not read.
    """
    return forms(stage(counted(misspelt(runs(docs, id_col, text_col), id_col)), "words"))
