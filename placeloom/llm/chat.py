"""Conversations as one training text each, with a loss mask, and back.

The turns of a conversation are collected as structs and sorted. A turn whose
role is that of the turn before it continues that block; the decision looks at
the neighbour only, so the whole is one pass of array functions, however long a
conversation is. Control strings inside texts are escaped, reversibly.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from placeloom.llm.common import let

START, NEXT, END = "<|start|>", "<|next|>", "<|end|>\n"
# What may stand for control in this and other chat templates.
CONTROL = ("<|", "|>", "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>")
#: The role whose texts are trained on.
LEARNT = "assistant"


def escape(text: Column) -> Column:
    """text without any control string: "~" becomes "~0" first, so what follows a "~" is always ours."""
    text = F.replace(text, F.lit("~"), F.lit("~0"))
    for k, x in enumerate(CONTROL, 1):
        text = F.replace(text, F.lit(x), F.lit(f"~{k}"))
    return text


def unescape(text: Column) -> Column:
    for k, x in enumerate(CONTROL, 1):
        text = F.replace(text, F.lit(f"~{k}"), F.lit(x))
    return F.replace(text, F.lit("~0"), F.lit("~"))


def _head(turns: Column, turn: Column, k: Column) -> Column:
    role = F.replace(escape(turn["role"]), F.lit("\n"), F.lit("~n"))
    begin = F.concat(F.lit(START), role, F.lit("\n"))
    same = F.get(turns, k - 1)["role"] == turn["role"]
    return F.when(k == 0, begin).when(same, F.lit(NEXT)).otherwise(F.concat(F.lit(END), begin))


def format_chats(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """One row for each conversation: conv_col, formatted, mask.

    mask is the run lengths of formatted in code points, each with whether the loss counts there; it covers texts of
    assistant turns and nothing else. Turns go by turn number, then role, then text; repeated rows stay. A null text or
    role is the empty string, a null turn number comes first, rows with a null conversation form one. Further columns
    are not read. Tables without rows give none.
    """
    rows = turns.select(
        F.col(conv_col),
        F.struct(F.col(turn_col).alias("turn"), F.coalesce(F.col(role_col), F.lit("")).alias("role"), F.coalesce(F.col(text_col), F.lit("")).alias("text")).alias("_t"),
    )
    sorted_turns = rows.groupBy(conv_col).agg(F.sort_array(F.collect_list("_t")).alias("turns"))
    pieces = let(F.col("turns"), lambda ts: F.transform(ts, lambda t, k: F.struct(_head(ts, t, k).alias("head"), escape(t["text"]).alias("text"), (t["role"] == LEARNT).alias("loss"))))
    run = lambda text, loss: F.struct(F.length(text).alias("n_chars"), loss.alias("loss"))
    return sorted_turns.select(conv_col, pieces.alias("pieces")).select(
        conv_col,
        F.concat(F.array_join(F.transform("pieces", lambda p: F.concat(p["head"], p["text"])), ""), F.lit(END)).alias("formatted"),
        F.concat(F.flatten(F.transform("pieces", lambda p: F.array(run(p["head"], F.lit(False)), run(p["text"], p["loss"])))), F.array(run(F.lit(END), F.lit(False)))).alias("mask"),
    )


def parse_chats(formatted: Column) -> Column:
    """array<struct<role,text,head_chars,text_chars>> of all turns in a formatted text, as they were; and how many
    characters of it the head before a turn and its escaped text take."""
    blocks = F.filter(F.split(formatted, r"<\|start\|>"), lambda b: b != "")

    def turns(block: Column, k: Column) -> Column:
        raw = F.substring_index(block, "\n", 1)
        role = unescape(F.replace(raw, F.lit("~n"), F.lit("\n")))
        body = F.substr(block, F.length(raw) + 2, F.length(block) - F.length(raw) - 1 - len(END))
        head = F.length(raw) + len(START) + 1 + F.when(k > 0, len(END)).otherwise(0)
        return F.transform(F.split(body, r"<\|next\|>"), lambda t, i: F.struct(role.alias("role"), unescape(t).alias("text"), F.when(i > 0, len(NEXT)).otherwise(head).alias("head_chars"), F.length(t).alias("text_chars")))

    return F.flatten(F.transform(blocks, turns))


def under_mask(formatted: Column, mask: Column, turns: Column) -> Column:
    """What of formatted is under the mask, unescaped.

    Where every run is as long as the head or text that stands there, the texts are what the runs cut out. Where one
    is not, formatted is cut by the running sum of the runs, piece by piece.
    """
    fits = lambda t, k: (F.get(mask, 2 * k)["n_chars"] == t["head_chars"]) & ~F.get(mask, 2 * k)["loss"] & (F.get(mask, 2 * k + 1)["n_chars"] == t["text_chars"])
    aligned = (F.size(mask) == 2 * F.size(turns) + 1) & ~F.element_at(mask, -1)["loss"] & F.forall(F.transform(turns, fits), lambda x: F.coalesce(x, F.lit(False)))
    texts = F.array_join(F.transform(F.filter(turns, lambda t, k: F.get(mask, 2 * k + 1)["loss"]), lambda t: t["text"]), "")
    start = F.struct(F.lit(1).alias("at"), F.lit("").alias("cut"))
    cut = F.aggregate(mask, start, lambda a, m: F.struct((a["at"] + m["n_chars"]).alias("at"), F.when(m["loss"], F.concat(a["cut"], unescape(F.substr(formatted, a["at"], m["n_chars"])))).otherwise(a["cut"]).alias("cut")))["cut"]
    return F.when(aligned, texts).otherwise(cut)


def summary(chats: DataFrame, conv_col: str = "conv_id") -> DataFrame:
    """What is read back from formatted: turns and their digest, the texts under the loss mask and their digest."""
    read = chats.select(conv_col, "formatted", "mask", parse_chats(F.col("formatted")).alias("back"))
    all_turns = F.array_join(F.transform("back", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    learnt = under_mask(F.col("formatted"), F.col("mask"), F.col("back"))
    return read.select(conv_col, "formatted", "back", all_turns.alias("all_turns"), learnt.alias("learnt")).select(
        conv_col,
        F.size("back").cast("long").alias("n_turns"),
        F.sha2("all_turns", 256).alias("turns_sha256"),
        F.length("learnt").cast("long").alias("loss_chars"),
        F.sha2("learnt", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )
