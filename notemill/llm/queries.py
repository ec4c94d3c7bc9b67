"""Registered queries of this package over the whole test tables, and their SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from notemill.llm import bm25, bpe, centroids, ego, extraction, language, manifest, mixing, rans, simhash, suffix, toxicity, warc


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/labels.parquet")


def op1_rans_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rans.stored_tokens(documents(spark, sf_dir), public_tokenizers.path("word_bpe_49k.json"), end_id=2)


def op2_warc_revisits(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.deduplicated(spark.read.parquet(f"{sf_dir}/pages.parquet"))


def op3_systematic_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(documents(spark, sf_dir))
    return mixed.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"))


def op4_suffix_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix.digests(documents(spark, sf_dir))


def op5_ego_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ego.near_duplicates(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), least=0.95)


def op6_language_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    filters = language.fit(docs, ~language.held_out())
    return language.predict(docs, filters).select("doc_id", language.held_out().alias("held_out"), "lang_pred", "score")


def op7_bm25_top10(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document whose id is divisible by 100 is a query against all documents, itself included."""
    docs = documents(spark, sf_dir)
    asked = docs.filter(F.col("doc_id") % 100 == 0).select(F.col("doc_id").alias("query_id"), "text")
    return bm25.search(docs, asked, k=10).withColumn("score", F.round("score", 9))


def op8_toxic_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    model = toxicity.fit(docs, labels(spark, sf_dir), ~toxicity.held_out())
    return toxicity.score(docs, model).select(
        "doc_id", toxicity.held_out().alias("held_out"), "score", "predicted", F.size("passages").alias("n_passages")
    )


def op9_simhash_components(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(documents(spark, sf_dir), words=4, distance=4)
    return found.select("doc_id", simhash.hex_digits("fp").alias("fingerprint"), "component_id")


def op10_bpe_digests(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digests(documents(spark, sf_dir), public_tokenizers.path("byte_bpe_50k.json"))


def op11_centroid_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    found, centres, _ = centroids.cluster(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), k=8, rounds=10, seed=3)
    return centroids.with_inertia(found, centres)


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every row proved against the root; where 2 divides the CRC-32 of the id, against a text that lost its line feeds."""
    docs = documents(spark, sf_dir)
    tampered = F.crc32(F.col("doc_id").cast("string")) % 2 == 0
    found = F.when(tampered, F.translate("text", "\n", "")).otherwise(F.col("text"))
    proved = manifest.proofs(manifest.manifest(manifest.leaves(docs, found)))
    return proved.select("doc_id", "leaf", "subroot", "root", F.sha2(F.array_join("siblings", ""), 256).alias("proof_sha256"), "folded_root", "verified")


def op13_density_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extraction.extract(spark.read.parquet(f"{sf_dir}/pages.parquet"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_rans_tokens": op1_rans_tokens,
    "op2_warc_revisits": op2_warc_revisits,
    "op3_systematic_mix": op3_systematic_mix,
    "op4_suffix_repeats": op4_suffix_repeats,
    "op5_ego_links": op5_ego_links,
    "op6_language_filters": op6_language_filters,
    "op7_bm25_top10": op7_bm25_top10,
    "op8_toxic_segments": op8_toxic_segments,
    "op9_simhash_components": op9_simhash_components,
    "op10_bpe_digests": op10_bpe_digests,
    "op11_centroid_clusters": op11_centroid_clusters,
    "op12_merkle_manifest": op12_merkle_manifest,
    "op13_density_extraction": op13_density_extraction,
}

ORACLES: dict[str, str] = {
    "op2_warc_revisits": warc.REVISIT_SQL,
    "op3_systematic_mix": mixing.MIX_SQL,
    "op11_centroid_clusters": centroids.lloyd_sql(k=8, rounds=10, seed=3),
    "op12_merkle_manifest": manifest.MANIFEST_SQL,
}
