"""The registered queries of this package: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from shelfwise.llm import (
    chat, fingerprints, language, manifest, mixing, near_dedup, negatives, packing, privacy, scoring, secret_scan, topk, warc,
)
from shelfwise.llm.common import table


def op1_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    found = near_dedup.near_duplicates(table(spark, folder, "documents"), words=2, threshold=0.8)
    return found.select("doc_id", "n_shingles", "component_id", "kept")


def op2_lm_scoring(spark: SparkSession, folder: str) -> DataFrame:
    return scoring.scores(table(spark, folder, "documents"))


def op3_mixing(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.taken(*mixing.mix(table(spark, folder, "documents")))


def op4_fingerprints(spark: SparkSession, folder: str) -> DataFrame:
    return fingerprints.against_next(table(spark, folder, "documents"))


def op5_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.packed(table(spark, folder, "documents"))


def op6_language(spark: SparkSession, folder: str) -> DataFrame:
    found = language.identify(table(spark, folder, "documents"))
    return found.select("doc_id", "held_out", "lang_pred", "score", "rejected")


def op7_warc(spark: SparkSession, folder: str) -> DataFrame:
    index = warc.capture_index(table(spark, folder, "pages"))
    return index.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "urlkey", "time", "range", "place")


def op8_topk(spark: SparkSession, folder: str) -> DataFrame:
    vectors = topk.whole_vectors(table(spark, folder, "embeddings"))
    return topk.top(vectors, vectors.where(F.col("vec_id") % topk.EVERY == 0), topk.K)


def op9_chat(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    said = "</s>[INST] ok [/INST]"
    more = spark.createDataFrame([(-1, 0, "user", said), (-1, 1, "assistant", said)], rows.schema)
    return chat.read_back(chat.conversations(chat.as_messages(rows.unionByName(more))))


def op10_privacy(spark: SparkSession, folder: str) -> DataFrame:
    found = privacy.findings(table(spark, folder, "documents"))
    return found.select(
        "doc_id", *[F.size(kind).cast("bigint").alias(f"n_{kind}") for kind in privacy.KINDS],
        F.sha2(privacy.span_text(privacy.KINDS), 256).alias("base_sha256"),
        privacy.span_text((*privacy.KINDS, "term")).alias("spans"))


def op11_negatives(spark: SparkSession, folder: str) -> DataFrame:
    return negatives.hard_negatives(table(spark, folder, "embeddings"))


def op12_secret_scan(spark: SparkSession, folder: str) -> DataFrame:
    found = secret_scan.findings(table(spark, folder, "documents"))
    base, guessed = F.col("base"), F.col("guessed")
    weak = F.size(F.filter("costs", lambda c: c < secret_scan.STRONG)).cast("bigint")
    return found.select(
        "doc_id", *[secret_scan.count(base, kind).alias(f"n_{kind}") for kind in secret_scan.KINDS[:3]],
        F.sha2(secret_scan.span_text(base), 256).alias("base_sha256"),
        secret_scan.span_text(F.concat(base, guessed)).alias("spans"),
        secret_scan.count(guessed, "guess").alias("n_guess"), weak.alias("n_weak"))


def op13_manifest(spark: SparkSession, folder: str) -> DataFrame:
    found = manifest.proven(table(spark, folder, "documents"))
    proof = F.sha2(F.array_join("proof", ""), 256)
    return found.select("doc_id", "leaf", "subroot", "root", proof.alias("proof_sha256"), "folded_root", "verified")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (
        op1_near_dedup, op2_lm_scoring, op3_mixing, op4_fingerprints, op5_packing, op6_language, op7_warc, op8_topk, op9_chat, op10_privacy,
        op11_negatives, op12_secret_scan, op13_manifest)
}

def _whole(scale: int) -> str:
    """Vectors as whole numbers, in doubles that hold them exactly; null and non-finite ones are left out."""
    return f"""
vectors AS (
  SELECT vec_id, label, list_transform(embedding, lambda x: floor({scale} * CAST(x AS DOUBLE))) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0)"""


ORACLE: dict[str, str] = {
    "op8_topk": f"""
WITH {_whole(topk.SCALE)},
scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.v, c.v) AS BIGINT) AS score
  FROM vectors q JOIN vectors c ON q.vec_id <> c.vec_id AND len(q.v) = len(c.v) WHERE q.vec_id % {topk.EVERY} = 0)
SELECT query_id, CAST(place AS INTEGER) AS rank, vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS place FROM scored)
WHERE place <= {topk.K}""",
    "op11_negatives": f"""
WITH {_whole(negatives.SCALE)},
labelled AS (
  SELECT vec_id, v, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label FROM vectors WHERE label IS NOT NULL),
scored AS (
  SELECT a.vec_id AS anchor_id, c.vec_id, a.label = c.label AS same, CAST(list_inner_product(a.v, c.v) AS BIGINT) AS score
  FROM labelled a JOIN labelled c ON a.vec_id <> c.vec_id AND len(a.v) = len(c.v) WHERE a.vec_id % {negatives.EVERY} = 0),
positives AS (
  SELECT * FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= {negatives.POSITIVES}),
inside AS (
  SELECT anchor_id, p.vec_id AS positive_id, n.vec_id AS negative_id, p.score AS positive_score, n.score AS negative_score,
         row_number() OVER (PARTITION BY anchor_id, p.vec_id ORDER BY n.score DESC, n.vec_id) AS place
  FROM positives p JOIN scored n USING (anchor_id)
  WHERE NOT n.same AND 50 * p.score <= 100 * n.score AND 100 * n.score <= 95 * p.score)
SELECT anchor_id, positive_id, CAST(place AS INTEGER) AS rank, negative_id, positive_score, negative_score
FROM inside WHERE place <= {negatives.NEGATIVES}""",
}
