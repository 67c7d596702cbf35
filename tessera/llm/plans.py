"""Registered queries of the training-data operators and, where SQL can say it, their DuckDB oracles."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.functions.ordered import join_small
from tessera.llm.common import read
from tessera.llm.decontaminate import leaks
from tessera.llm.forest import nearest
from tessera.llm.html import main_text
from tessera.llm.katz import katz_scores
from tessera.llm.manifest import manifest
from tessera.llm.mixing import mixed_documents
from tessera.llm.oracles import ORACLES  # noqa: F401 - read by the driver contract
from tessera.llm.parity import jaccard_components
from tessera.llm.pieces import encoded
from tessera.llm.quality import quality_scores
from tessera.llm.repair import digests, repair
from tessera.llm.toxicity import toxicity_scores
from tessera.llm.urls import judge
from tessera.llm.warc import archived

QUERIES = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


@query
def op2_katz_backoff(spark: SparkSession, sf_dir: str) -> DataFrame:
    return katz_scores(read(spark, sf_dir, "documents"))


@query
def op1_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labelled pages: those whose id has a row in `labels`; low quality or toxic means block."""
    labels = read(spark, sf_dir, "labels").select(
        F.col("doc_id").alias("page_id"),
        F.when((F.col("quality") == 0) | (F.col("toxic") == 1), "block")
        .when(F.col("quality").isNotNull() | F.col("toxic").isNotNull(), "allow").alias("verdict"))
    return judge(read(spark, sf_dir, "pages"), labels)


@query
def op4_warc_revisits(spark: SparkSession, sf_dir: str) -> DataFrame:
    return archived(read(spark, sf_dir, "pages"), min_bytes=0)


@query
def op8_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixed_documents(read(spark, sf_dir, "documents"))


@query
def op3_quality_pu(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_scores(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


@query
def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity_scores(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


@query
def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return leaks(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


@query
def op5_prefix_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = read(spark, sf_dir, "embeddings")
    return nearest(vectors, vectors.where(F.col("vec_id") % 100 == 0), k=10)


@query
def op6_page_differencing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return main_text(read(spark, sf_dir, "pages"))


@query
def op9_parity_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_components(read(spark, sf_dir, "documents"))


@query
def op12_piece_encoding(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers
    return encoded(read(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model")).select(
        "doc_id", F.size("ids").cast("bigint").alias("n_tokens"), F.sha2(F.array_join("ids", ","), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"))


@query
def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return manifest(read(spark, sf_dir, "documents")).select(
        "doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")


@query
def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    report, pieces = repair(read(spark, sf_dir, "conversations"))
    return join_small(report, digests(pieces), ["conv_id"]).select(
        "conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")
