"""Registered queries of this subpackage and their DuckDB SQL.

Each opN_<name> applies its operator, with production parameters, to its whole
table; the digest columns of the query contracts are derived here.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline

from . import chat, codebooks, mixing, resample, wordcodes
from .common import fold_of, table
from .embed_dedup import embedding_duplicates
from .jaccard import near_duplicates
from .licenses import scan_licenses
from .packing import pack
from .quality import score_quality
from .warczip import through_archives
from .trie_dedup import exact_groups
from .toxicity import score_toxicity


def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of every document; labels with crc32(doc_id) mod 5 = 0 are held out."""
    scored = score_quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"),
                           usable=fold_of("doc_id", 5) != 0)
    return scored.select("doc_id", F.coalesce(fold_of("doc_id", 5) == 0, F.lit(False)).alias("held_out"), "score",
                         (F.col("score") >= 0.3).cast("int").alias("predicted"))


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity score of every document; labels with crc32(doc_id) mod 3 = 1 are held out."""
    scored = score_toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"),
                            usable=fold_of("doc_id", 3) != 1)
    return scored.select("doc_id", F.coalesce(fold_of("doc_id", 3) == 1, F.lit(False)).alias("held_out"), "score",
                         (F.col("score") >= 0.7).cast("int").alias("predicted"))


def op6_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Owner of every document's group of equal texts (white space ignored)."""
    return (exact_groups(table(spark, sf_dir, "documents"))
            .select("doc_id", "keep_id", "group_size", "kept", "text_sha256"))


def op3_warc_zip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page as a WARC record in ZIP archives, read back by byte ranges."""
    return through_archives(table(spark, sf_dir, "pages"))


def op4_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate component of every embedding: cosine of 0.95 or more."""
    return embedding_duplicates(table(spark, sf_dir, "embeddings"))


def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token pieces of every document packed into sequences of at most 4096."""
    return pack(table(spark, sf_dir, "documents"))


def op7_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate component of every document: Jaccard of 5-word shingles of 0.8 or more."""
    return near_duplicates(table(spark, sf_dir, "documents"))


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents selected, epoch by epoch, so that domains, languages and sources meet their weights."""
    return mixing.mix(table(spark, sf_dir, "documents"))


PLANTED_TURN = "\\### Assistant: </turn> ok"


def op9_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations and conversation -7, formatted and read back."""
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    planted = spark.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(PLANTED_TURN).alias("text"))
    formatted = chat.format_conversations(turns.unionByName(planted))
    return chat.read_back(formatted).drop("n_ids")


def op10_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """License phrases and notices of every document."""
    return (scan_licenses(table(spark, sf_dir, "documents"))
            .select("doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", F.col("all_labels").alias("labels"),
                    F.col("best_score").alias("score"), (F.size("matches") + F.size("passages")).alias("n_matches")))


def op11_codebooks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Code of every embedding under product codebooks learned by Lloyd rounds."""
    coded, books = codebooks.compress(table(spark, sf_dir, "embeddings"))
    return (codebooks.with_label_error(coded).drop("label")
            .withColumn("codebooks_sha256", F.lit(codebooks.codebooks_digest(books))))


def op12_resample(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A tenth of the documents drawn by importance towards the benchmark texts."""
    return (resample.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
            .select("doc_id", "n_features", "weight", "score", "rank"))


def op13_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token ids of every document, and the text they decode to."""
    encoded = wordcodes.encode(table(spark, sf_dir, "documents"))
    ids = F.array_join(F.col("ids").cast("array<string>"), " ")
    encoded = encoded.select("doc_id", "ids", F.size("ids").cast("long").alias("n_tokens"), F.sha2(ids, 256).alias("ids_sha256"))
    decoded = wordcodes.decode(encoded, keep=("doc_id", "n_tokens", "ids_sha256"))
    return decoded.select("doc_id", "n_tokens", "ids_sha256", F.sha2("text", 256).alias("decoded_sha256"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages of the corpus pipeline over `documents`."""
    return corpus_pipeline.run(spark, sf_dir)


QUERIES = {
    "op1_quality": op1_quality,
    "op2_toxicity": op2_toxicity,
    "op3_warc_zip": op3_warc_zip,
    "op4_embedding_dedup": op4_embedding_dedup,
    "op5_packing": op5_packing,
    "op6_exact_dedup": op6_exact_dedup,
    "op7_jaccard_join": op7_jaccard_join,
    "op8_mixing": op8_mixing,
    "op9_chat_format": op9_chat_format,
    "op10_licenses": op10_licenses,
    "op11_codebooks": op11_codebooks,
    "op12_resample": op12_resample,
    "op13_bpe": op13_bpe,
    "pipeline": pipeline,
}

ORACLE: dict[str, str] = {
    "op9_chat_format": r"""
        WITH t AS (
            SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
            UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
            UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok')
        SELECT conv_id, count(*) AS n_turns,
               sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, sha256(text))) AS turns_sha256,
               coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0)::BIGINT AS loss_chars,
               sha256(coalesce(string_agg(text, '' ORDER BY turn, role, sha256(text)) FILTER (WHERE role = 'assistant'), ''))
                   AS loss_sha256,
               sum(length(regexp_replace(text, '(\\|#|</)', '\\\1', 'g')) + 9 + CASE role
                   WHEN 'user' THEN 10 WHEN 'assistant' THEN 15 WHEN 'system' THEN 12
                   ELSE 19 + length(regexp_replace(role, '(\\|#|</)', '\\\1', 'g')) END)::BIGINT AS formatted_chars
        FROM t GROUP BY conv_id""",
    "op8_mixing": mixing.oracle_sql(mixing.Params()),
    "op12_resample": resample.oracle_sql(resample.Params()),
    "op11_codebooks": codebooks.oracle_sql(codebooks.Params()),
    "op6_exact_dedup": r"""
        WITH t AS (
            SELECT doc_id, length(coalesce(text, '')) AS points,
                   sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) AS text_sha256
            FROM documents)
        SELECT doc_id, first_value(doc_id) OVER w AS keep_id,
               count(*) OVER (PARTITION BY text_sha256) AS group_size,
               row_number() OVER w = 1 AS kept, text_sha256
        FROM t WINDOW w AS (PARTITION BY text_sha256 ORDER BY points DESC, doc_id NULLS LAST
                            ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)""",
}
