"""The corpus operators as queries over the given tables."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from placeloom.llm import bpe, chat, flac, jaccard, licenses, mixing, negatives, passages, pieces, pii, rules, secrets, variants
from placeloom.llm.common import stage, table

VOCABULARY = "byte_bpe_50k.tiktoken"
PIECES = "piece_bpe_32k.model"
#: What conversation -1 says, both turns: control strings as plain text.
PROBE = "</s>[INST] ok [/INST]"


def op1_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.summary(pii.detect(table(spark, sf_dir, "documents")))


def op2_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mix = mixing.by_position(mixing.plan(table(spark, sf_dir, "documents")))
    return mix.select("doc_id", "size", "source_size", "target", "taken")


def learnt_rules(measured: DataFrame, labels: DataFrame) -> list[rules.Rule]:
    return rules.learn(*rules.statistics(measured, labels))


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    measured = stage(rules.measures(table(spark, sf_dir, "documents")), "measures")
    return rules.judged(measured, learnt_rules(measured, table(spark, sf_dir, "labels")))


def tokenizer(spark: SparkSession) -> bpe.Tokenizer:
    return bpe.Tokenizer(spark, public_tokenizers.path(VOCABULARY), public_tokenizers.PATTERN, blanks_part=True)


def op4_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.summary(bpe.encode_table(table(spark, sf_dir, "documents"), tokenizer(spark)))


def op5_flac(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flac.summary(flac.store(table(spark, sf_dir, "documents")))


def op6_compact_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return passages.shared_passages(table(spark, sf_dir, "documents"))


def op7_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.summary(secrets.scan(table(spark, sf_dir, "documents")))


def op8_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    probe = spark.range(2).select(F.lit(-1).cast("long").alias("conv_id"), F.col("id").cast("int").alias("turn"), F.when(F.col("id") == 0, "user").otherwise(chat.LEARNT).alias("role"), F.lit(PROBE).alias("text"))
    return chat.summary(chat.format_chats(turns.union(probe)))


def op9_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.link(table(spark, sf_dir, "documents"))


def op10_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.summary(licenses.scan(table(spark, sf_dir, "documents"), best_only=True))


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return negatives.mine(rows.select(F.col("vec_id").alias("id"), moved.alias("label"), negatives.quantised(F.col("embedding")).alias("v")), F.col("id") % 50 == 0)


def op12_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    tokenizer = pieces.PieceTokenizer(spark, public_tokenizers.path(PIECES))
    return pieces.summary(pieces.encode_table(table(spark, sf_dir, "documents"), tokenizer))


def op13_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return variants.spelling(table(spark, sf_dir, "documents"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_pii": op1_pii,
        "op2_mixing": op2_mixing,
        "op3_quality_rules": op3_quality_rules,
        "op4_byte_bpe": op4_byte_bpe,
        "op5_flac": op5_flac,
        "op6_compact_windows": op6_compact_windows,
        "op7_secrets": op7_secrets,
        "op8_chat_format": op8_chat_format,
        "op9_jaccard_join": op9_jaccard_join,
        "op10_licenses": op10_licenses,
        "op11_hard_negatives": op11_hard_negatives,
        "op12_pieces": op12_pieces,
        "op13_spelling": op13_spelling,
        "pipeline": pipeline,
    }


_WORDS = r"len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))"
OP2 = rf"""
WITH d AS (SELECT doc_id, source, {_WORDS}::BIGINT AS size, md5(coalesce(doc_id::VARCHAR, '')) AS o FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source),
w AS (SELECT *, CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS weight FROM s),
l AS (
  SELECT *, (1.5 * sum(source_size) OVER () - coalesce(sum(2 * source_size) OVER (b ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))::DOUBLE
    / sum(weight) OVER (b ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)::DOUBLE AS level
  FROM w WINDOW b AS (ORDER BY 2 * source_size / weight::DOUBLE, source NULLS LAST)),
t AS (SELECT source, source_size, least(2.0 * source_size, weight * max(level) OVER ())::DOUBLE AS target FROM l),
p AS (SELECT d.*, coalesce(sum(size) OVER (PARTITION BY source ORDER BY o, doc_id, size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS a FROM d)
SELECT p.doc_id, p.size, t.source_size, t.target,
  (p.size * ((a + p.size / 2.0::DOUBLE <= target)::INT + (a + source_size + p.size / 2.0::DOUBLE <= target)::INT))::BIGINT AS taken
FROM p JOIN t ON p.source IS NOT DISTINCT FROM t.source
"""


def _escaped(text: str) -> str:
    text = f"replace({text}, '~', '~0')"
    for k, x in enumerate(chat.CONTROL, 1):
        text = f"replace({text}, '{x}', '~{k}')"
    return text


OP8 = f"""
WITH c AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '{PROBE}' UNION ALL SELECT -1, 1, '{chat.LEARNT}', '{PROBE}'),
t AS (SELECT *, lag(role) OVER (PARTITION BY conv_id ORDER BY turn, role, text) AS before FROM c),
f AS (SELECT *, CASE WHEN before IS NOT DISTINCT FROM role THEN {len(chat.NEXT)}
    ELSE {len(chat.START) + 1} + length(replace({_escaped("role")}, chr(10), '~n')) + {len(chat.END)} END + length({_escaped("text")}) AS chars FROM t)
SELECT conv_id, count(*)::BIGINT AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (role = '{chat.LEARNT}'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = '{chat.LEARNT}'), '')) AS loss_sha256,
  sum(chars)::BIGINT AS formatted_chars
FROM f GROUP BY conv_id
"""


OP11 = """
WITH e AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
  FROM embeddings WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT a.vec_id AS anchor_id, b.vec_id AS other, a.label = b.label AS same, list_inner_product(a.v, b.v)::BIGINT AS score
  FROM e a JOIN e b ON a.vec_id % 50 = 0 AND a.vec_id <> b.vec_id),
p AS (SELECT anchor_id, other AS positive_id, score AS positive_score FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other) <= 5),
r AS (SELECT anchor_id, positive_id, row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, other)::INT AS rank,
    other AS negative_id, positive_score, score AS negative_score
  FROM p JOIN s USING (anchor_id) WHERE NOT same AND 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score)
SELECT * FROM r WHERE rank <= 3
"""


def oracle_sql() -> dict[str, str]:
    """Where SQL can express the query; the others are tested against brute force, round trips and held-out labels."""
    return {"op2_mixing": OP2, "op8_chat_format": OP8, "op11_hard_negatives": OP11}
