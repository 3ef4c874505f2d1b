"""Registered queries of this subpackage, and their DuckDB twins where SQL can express them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

import public_tokenizers

from dialoom.llm.byte_bpe import encode_texts, read_ranks, round_trip_digests
from dialoom.llm.centroids import cluster_vectors
from dialoom.llm.centroids import oracle as centroid_oracle
from dialoom.llm.common import table
from dialoom.llm.exact_dedup import find_copies
from dialoom.llm.id_shards import read_documents, write_ids
from dialoom.llm.interpolation import score_texts
from dialoom.llm.license_scan import oracle as license_oracle
from dialoom.llm.license_scan import scan_licenses
from dialoom.llm.metric_search import top_k
from dialoom.llm.mixing import mix
from dialoom.llm.ngram_join import jaccard_components
from dialoom.llm.privacy import find_private
from dialoom.llm.quality import score_quality
from dialoom.llm.token_counts import count_tokens
from dialoom.llm.whitening import whiten
from dialoom.session import work_path

RANKS, BYTE_BPE, WORD_BPE = map(
    public_tokenizers.path, ("byte_bpe_50k.tiktoken", "byte_bpe_50k.json", "word_bpe_49k.json")
)


def op1_metric_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return top_k(vectors, vectors.where("vec_id % 50 = 0"))


def op2_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_copies(table(spark, sf_dir, "documents")).marks


def op3_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks, pattern = read_ranks(RANKS), public_tokenizers.PATTERN
    return round_trip_digests(encode_texts(table(spark, sf_dir, "documents"), ranks, pattern), ranks, pattern)


def op4_token_id_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = work_path(spark, "ids")
    write_ids(table(spark, sf_dir, "documents"), path, WORD_BPE)
    return read_documents(spark, path)


def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(table(spark, sf_dir, "documents"))


def op6_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_licenses(table(spark, sf_dir, "documents"))


def op7_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op8_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_private(table(spark, sf_dir, "documents"))


def op9_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_components(table(spark, sf_dir, "documents")).drop("text_hash")


def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_tokens(table(spark, sf_dir, "documents"), BYTE_BPE)


def op11_interpolated_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_texts(table(spark, sf_dir, "documents"))


def op12_centroid_clustering(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cluster_vectors(table(spark, sf_dir, "embeddings"))


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whiten(table(spark, sf_dir, "embeddings"))


QUERIES = {f.__name__: f for f in (op1_metric_search, op2_exact_dedup, op3_byte_bpe, op4_token_id_output, op5_mixing, op6_license_scan, op7_quality_classifier, op8_pii, op9_ngram_jaccard_join, op10_token_counts, op11_interpolated_scores, op12_centroid_clustering, op13_whitening)}

ORACLE = {
    "op1_metric_search": """
        with v as (
          select vec_id, list_transform(embedding, lambda x: floor(256 * cast(x as double))) as x
          from embeddings
          where embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
        s as (
          select q.vec_id as query_id, v.vec_id, cast(list_inner_product(q.x, v.x) as bigint) as score
          from v as q join v on q.vec_id % 50 = 0 and q.vec_id <> v.vec_id)
        select query_id, cast(row_number() over w as integer) as rank, vec_id, score
        from s window w as (partition by query_id order by score desc, vec_id)
        qualify row_number() over w <= 5
    """,
    "op2_exact_dedup": """
        with d as (
          select doc_id, sha256(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'))
            as text_sha256
          from documents)
        select doc_id, max(doc_id) over w as keep_id, count(*) over w as group_size,
          doc_id = max(doc_id) over w as kept, text_sha256
        from d window w as (partition by text_sha256)
    """,
    "op6_license_scan": license_oracle(),
    "op12_centroid_clustering": centroid_oracle(),
}
