"""Documents to training tokens in five stages, each written and read again."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from placeloom.llm import bpe, jaccard, mixing, pii, rules
from placeloom.llm.common import shared_dir, stage, table, unstage
from placeloom.llm.queries import learnt_rules, tokenizer


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that neither the base rules nor the learnt list rejects. The list is learnt from the labelled ones.

    Each text is measured once: rows and measures are staged, and both the learning and the verdict read them. Repeated
    rows are judged alike; null and empty texts fail the base rules and go; null ids are judged but not learnt from; an
    empty table gives an empty one.
    """
    rows = docs.select("doc_id", "text", F.struct(*docs.columns).alias("_row"))
    measured = stage(rules.measures(rows, keep=("_row",)), "measured")
    learnt = learnt_rules(measured, table(spark, sf_dir, "labels"))
    out = rules.judged(measured, learnt).where("kept").select("_row.*")
    out.reads = [measured]
    return out


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each group of linked ones; rows without words all stay, repeated rows once."""
    return jaccard.deduplicated(docs)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data replaced by its kind, n_chars anew; null texts stay null. Each row by itself, whatever repeats."""
    return pii.redact(docs).withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them, in training order; null ids and sources are mixed too. An empty table gives an empty one."""
    return mixing.mixed(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, the number of tokens and digests of ids and decoded text, a row for each time a document is taken."""
    return bpe.summary(bpe.encode_table(docs, tokenizer(spark)))


STAGES = [("quality", quality), ("near_duplicates", near_duplicates), ("personal_data", personal_data), ("mix", mix), ("encode", encode)]

#: SQL can express neither the learnt list nor the ids.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows. Each stage is written and read again; what it read is deleted once the next one is written.

    Documents may have nulls in any column, repeated rows and further columns, or be none at all: see the stages.
    """
    docs, before = table(spark, sf_dir, "documents"), None
    for name, function in STAGES:
        path = f"{shared_dir(spark)}/pipeline-{name}-{uuid.uuid4().hex}"
        out = function(spark, docs, sf_dir)
        out.write.parquet(path)
        docs = spark.read.parquet(path)
        docs.staged_at = path
        unstage(*getattr(out, "reads", []), *([before] if before is not None else []))
        before = docs
    return docs
