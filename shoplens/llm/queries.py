"""Registered queries of the corpus operators, and SQL for those SQL can express."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shoplens.llm import (
    attention_lm, exact_dedup, hard_negatives, licenses, line_dedup, packing, periodic_runs, quality,
    sentencepiece_scan, sharding, simhash, topk, warc,
)
from shoplens.llm.common import table, written


def op1_sentencepiece_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    encoded = written(sentencepiece_scan.encode(table(spark, sf_dir, "documents")), "zstd")  # ids have two zero bytes
    return sentencepiece_scan.decode(encoded).select(
        "doc_id", "n_chunks", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.crc32("ids").alias("ids_crc32"), "score", (F.crc32("decoded") == F.col("text_crc32")).alias("round_trip"))


def op2_simhash_neardup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", simhash.fingerprint_hex(F.col("fp")).alias("fingerprint"), "component_id")


def op3_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return topk.top_k(vectors, vectors.filter(F.col("vec_id") % topk.QUERY_MOD == 0))


def op4_warc_derivatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = warc.derive(warc.responses(table(spark, sf_dir, "pages")))
    return made.select(F.col("source_key").cast("long").alias("page_id"), "record_type", "record_id", "refers_to",
                       "target_uri", "date", "content_type", F.octet_length("block").cast("long").alias("content_length"),
                       "block_digest", "payload_digest", "outlinks")


def op5_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(table(spark, sf_dir, "documents"))


def op6_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.duplicate_groups(table(spark, sf_dir, "documents")).drop("_uid")


def op7_attention_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return attention_lm.score_documents(table(spark, sf_dir, "documents"))


def op8_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"))


def op9_bounded_ring(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = sharding.shard_documents(table(spark, sf_dir, "documents"))
    return placed.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
                         F.lit(None).cast("int").alias("grown_shard"))


def op10_quality_qda(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.score_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periodic_runs.report(periodic_runs.find_runs(periodic_runs.planted(table(spark, sf_dir, "documents"))))


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    shifted = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    vectors = table(spark, sf_dir, "embeddings").withColumn("label", shifted)
    return hard_negatives.mine(vectors, vectors.filter(F.col("vec_id") % hard_negatives.ANCHOR_MOD == 0))


def op13_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.line_report(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_lines", "n_dropped", F.sha2("kept_text", 256).alias("kept_sha256"))


QUERIES = {f.__name__: f for f in (
    op1_sentencepiece_scan, op2_simhash_neardup, op3_exact_topk, op4_warc_derivatives, op5_license_scan,
    op6_exact_dedup, op7_attention_lm, op8_best_fit_packing, op9_bounded_ring, op10_quality_qda,
    op11_periodic_runs, op12_hard_negatives, op13_line_dedup)}

SQL = {
    "op3_exact_topk": f"""
        WITH v AS (
            SELECT vec_id, list_transform(embedding, lambda x: floor({topk.SCALE} * x::DOUBLE)) AS v FROM embeddings
            WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
              AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
        ), s AS (
            SELECT q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(q.v, c.v) AS BIGINT) AS score
            FROM v q JOIN v c ON q.vec_id <> c.vec_id AND len(q.v) = len(c.v) WHERE q.vec_id % {topk.QUERY_MOD} = 0
        ), r AS (
            SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s
        )
        SELECT query_id, rank, vec_id, score FROM r WHERE rank <= {topk.K}""",
    "op5_license_scan": licenses.oracle_sql(),
    "op6_exact_dedup": """
        WITH d AS (
            SELECT doc_id, sha256(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'))
                   AS text_sha256
            FROM documents
        ), g AS (SELECT text_sha256, max(doc_id) AS keep_id, count(*) AS group_size FROM d GROUP BY text_sha256)
        SELECT d.doc_id, g.keep_id, g.group_size, d.doc_id = g.keep_id AS kept, d.text_sha256
        FROM d JOIN g USING (text_sha256)""",
    "op12_hard_negatives": hard_negatives.ORACLE,
    "op13_line_dedup": line_dedup.ORACLE,
}
