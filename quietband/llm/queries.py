"""Registered queries of this subpackage and their oracle SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quietband.llm.bpe import encode_documents
from quietband.llm.centroids import cluster_vectors
from quietband.llm.common import table
from quietband.llm.exact_dedup import exact_dedup
from quietband.llm.fingerprints import compare_with_edit_and_next
from quietband.llm.importance import importance_resample
from quietband.llm.license_scan import scan_licenses
from quietband.llm.line_dedup import dedup_lines
from quietband.llm.ngram_join import jaccard_components
from quietband.llm.packing import pack_along_curve
from quietband.llm.sharding import kd_shards
from quietband.llm.token_counts import longest_prefix, prefix_counts, tokens_up_to
from quietband.llm.toxicity import score_toxicity, training_model
from quietband.llm.warc import round_trip


def op1_kd_tree_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in eight shards of nearly equal bytes."""
    return kd_shards(table(spark, sf_dir, "documents"), shards=8)


def op2_gzip_normaliser(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages through archives: written, normalised to a gzip member per record, read back by index."""
    return round_trip(table(spark, sf_dir, "pages"))


def op3_hilbert_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in sequences of 4096 ids, neighbours along a Hilbert curve together."""
    return pack_along_curve(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op4_positional_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licence phrases and notices in all documents."""
    return scan_licenses(table(spark, sf_dir, "documents"))


def op5_radix_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups of equal texts, the largest doc_id staying."""
    return exact_dedup(table(spark, sf_dir, "documents"))


def op6_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of documents whose sets of three-word shingles have a Jaccard similarity of 0.9 or more."""
    return jaccard_components(table(spark, sf_dir, "documents"), words=3, percent=90)


def op7_bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token ids of all documents, and what they decode to."""
    return encode_documents(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op8_minhash_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents without their repeated and near-repeated lines."""
    return dedup_lines(table(spark, sf_dir, "documents").select("doc_id", "text")).select(
        "doc_id", "lines_before", "lines_gone", F.sha2(F.col("text").cast("binary"), 256).alias("text_sha256")
    )


def op9_invertible_sketch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of all documents, of their edited texts, and likenesses recovered from them."""
    return compare_with_edit_and_next(table(spark, sf_dir, "documents"))


def op10_compression_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity scores of all documents, learnt from the labelled rows that are not held out."""
    docs = table(spark, sf_dir, "documents")
    return score_toxicity(docs, training_model(docs, table(spark, sf_dir, "labels")))


def op11_prefix_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token counts of all documents; from the counts of their prefixes, where 2048 tokens end and how many the first half has."""
    counts = prefix_counts(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))
    half = tokens_up_to(counts.withColumn("half", F.floor(F.col("n_chars") / 2)), "half", "half_tokens")
    return longest_prefix(half, 2048, "fitting_chars").select(
        "doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > 2048).alias("over_limit"), "fitting_chars", "half_tokens"
    )


def op12_centroid_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All 64-dimensional vectors in eight clusters after ten rounds, in integers."""
    return cluster_vectors(table(spark, sf_dir, "embeddings")).drop("measured")


def op13_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A tenth of the documents drawn towards the words of the benchmark."""
    return importance_resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_kd_tree_shards, op2_gzip_normaliser, op3_hilbert_packing, op4_positional_license_scan, op5_radix_exact_dedup, op6_ngram_jaccard_join,
        op7_bpe_round_trip, op8_minhash_line_dedup, op9_invertible_sketch, op10_compression_toxicity, op11_prefix_token_counts,
        op12_centroid_clusters, op13_importance_resampling,
    )
}

def _clustering_sql(clusters: int = 8, rounds: int = 10, size: int = 64, scale: int = 1024) -> str:
    """Lloyd's rounds one after the other, each with all distances."""
    nearest = """a{i} AS MATERIALIZED (
            SELECT row, vec_id, w, unnest(min({{'d': d, 'c': c}})) FROM (
                SELECT v.*, c.c, list_sum(list_transform(list_zip(v.w, c.w), lambda p: (p[1] - p[2]) * (p[1] - p[2])))::BIGINT AS d FROM v, c{i} c
            ) GROUP BY row, vec_id, w
        )"""
    # Integer division cuts towards zero.
    moved = """c{j} AS MATERIALIZED (
            SELECT c, coalesce(q, w) AS w FROM c{i} LEFT JOIN (
                SELECT c, list(CASE WHEN s >= 0 THEN s // n ELSE -((n - 1 - s) // n) END ORDER BY k)::BIGINT[] AS q FROM (
                    SELECT c, k, sum(w[k]) AS s, count(*) AS n FROM a{i}, range(1, {end}) t(k) GROUP BY c, k
                ) GROUP BY c
            ) USING (c)
        )"""
    steps = [nearest.format(i=0)]
    for i in range(rounds):
        steps += [moved.format(i=i, j=i + 1, end=size + 1), nearest.format(i=i + 1)]
    return f"""
        WITH v AS MATERIALIZED (
            SELECT row_number() OVER () AS row, vec_id, list_transform(embedding, lambda x: floor({scale} * x::DOUBLE)::BIGINT) AS w FROM embeddings
            WHERE len(embedding) = {size} AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = {size}
        ), c0 AS MATERIALIZED (
            SELECT row_number() OVER (ORDER BY sha256('3:' || vec_id)) - 1 AS c, w FROM v ORDER BY c LIMIT {clusters}
        ), {", ".join(steps)}
        SELECT vec_id, a.c::INTEGER AS cluster, d AS distance, (sum(d) OVER (PARTITION BY a.c))::BIGINT AS cluster_inertia,
               (sum(d) OVER ())::BIGINT AS inertia, sha256(array_to_string(c.w, ',')) AS centroid_sha256
        FROM a{rounds} a JOIN c{rounds} c ON a.c = c.c
    """


ORACLES: dict[str, str] = {
    "op12_centroid_clusters": _clustering_sql(),
    "op2_gzip_normaliser": """
        WITH p AS (
            SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest FROM pages
        ), f AS (
            SELECT *, CASE WHEN payload_bytes >= 100 THEN min(page_id) OVER (PARTITION BY payload_digest) END AS first FROM p
        )
        SELECT page_id, payload_bytes, payload_digest,
               CASE WHEN first < page_id THEN 'revisit' ELSE 'response' END AS record_type,
               CASE WHEN first < page_id THEN first END AS refers_to
        FROM f
    """,
    "op5_radix_exact_dedup": """
        SELECT doc_id,
               max(doc_id) OVER same AS keep_id,
               count(*) OVER same AS group_size,
               doc_id = max(doc_id) OVER same AS kept,
               sha256(coalesce(text, '')) AS text_sha256
        FROM documents
        WINDOW same AS (PARTITION BY coalesce(text, ''))
    """,
}
