"""The queries of this subpackage: each applies its operator, with production parameters, to its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scriptorium.llm import chat, embedding_dedup, exact_dedup, hmm, mixing, near_dedup, packing, substring_dedup, toxicity, warc
from scriptorium.llm.common import read


def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    left = substring_dedup.remove_repeats(read(spark, sf_dir, "documents"), k=35)
    return left.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


def op2_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = warc.archive(read(spark, sf_dir, "pages"))
    return records.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op3_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.group_near(read(spark, sf_dir, "documents"), similarity=0.85).drop("k1", "k2")


def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(read(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def op5_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = read(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    said = "</s>[INST] ok [/INST]"
    odd = spark.createDataFrame([(-7, 0, "user", said), (-7, 1, "assistant", said)], "conv_id long, turn long, role string, text string")
    return chat.digest(chat.format_chats(chat.as_events(turns.unionByName(odd))))


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score_documents(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def op7_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.group_vectors(read(spark, sf_dir, "embeddings"), cosine=0.93)


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(read(spark, sf_dir, "documents"))


def op9_hmm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hmm.score_documents(read(spark, sf_dir, "documents"))


def op10_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = exact_dedup.classify(exact_dedup.digest_rows(read(spark, sf_dir, "documents")))
    return rows.select("doc_id", "keep_id", "group_size", "kept", F.col("digest").alias("text_sha256"))


QUERIES = {f.__name__: f for f in (op1_substring_dedup, op2_warc, op3_near_dedup, op4_mixing, op5_chat, op6_toxicity, op7_embedding_dedup, op8_packing, op9_hmm, op10_exact_dedup)}

ORACLES = {
    "op10_exact_dedup": """
        WITH d AS (SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\\x20\\x09-\\x0D]+', ' ', 'g')) AS text_sha256 FROM documents)
        SELECT doc_id, min(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size, doc_id = min(doc_id) OVER w AS kept, text_sha256
        FROM d WINDOW w AS (PARTITION BY text_sha256)""",
    "op2_warc": """
        WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
        w AS (SELECT page_id, html, max(page_id) OVER (PARTITION BY html) AS top FROM p)
        SELECT page_id, CAST(octet_length(encode(html)) AS BIGINT) AS payload_bytes, s.payload_digest,
               CASE WHEN page_id = top THEN 'response' ELSE 'revisit' END AS record_type, CASE WHEN page_id = top THEN NULL ELSE top END AS refers_to
        FROM w JOIN (SELECT page_id, sha1(html) AS hexes FROM p) h USING (page_id), LATERAL (
            SELECT string_agg(substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + (('0x' || substr(hexes, 1 + 5 * (i // 4), 5))::BIGINT >> (15 - 5 * (i % 4))) % 32, 1), '' ORDER BY i) AS payload_digest
            FROM range(32) r(i)) s""",
}
