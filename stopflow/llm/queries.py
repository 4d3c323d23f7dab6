"""The registered queries of the training-data operators."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from stopflow.session import scratch_path

from .common import table
from .decontaminate import CONTAMINATION_SQL, contamination
from .embed_dedup import EMBEDDING_SQL, embedding_duplicates
from .filter_audit import AUDIT_SQL, filter_audit
from .fingerprint import edited_fingerprints
from .hard_negatives import HARD_NEGATIVES_SQL, hard_negatives, shifted_labels
from .line_dedup import LINE_DEDUP_SQL, PASSAGE_DEDUP_SQL, dedup_lines
from .mixing import MIX_SQL, mix_sources
from .ngram_join import NGRAM_SQL, ngram_components
from .orc_ids import id_digests, write_ids
from .packing import pack_documents
from .quality import classify
from .secret_scan import scan_versions, span_digests
from .token_counts import count_tokens


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup_lines(table(spark, sf_dir, "documents"))


def passage_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup_lines(table(spark, sf_dir, "documents"), whole=True)


def op2_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_duplicates(table(spark, sf_dir, "embeddings"))


def op3_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return edited_fingerprints(table(spark, sf_dir, "documents"))


def op4_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix_sources(table(spark, sf_dir, "documents"))


def op5_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_components(table(spark, sf_dir, "documents"), words=4, share=(85, 100)).drop("x")


def op6_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")).drop("x")


def op7_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return span_digests(scan_versions(docs, scratch_path(spark, "blob-ledger")))


def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op9_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), end_id=2)


def op10_token_id_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "token-ids")
    write_ids(table(spark, sf_dir, "documents"), path, public_tokenizers.path("word_bpe_49k.json"), end_id=1)
    return id_digests(spark, path)


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hard_negatives(shifted_labels(table(spark, sf_dir, "embeddings")))


def op12_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).drop("spans")


def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


QUERIES = {f.__name__: f for f in (op1_line_dedup, op2_embedding_dedup, op3_fingerprints, op4_source_mix, op5_ngram_join, op6_quality_classifier, op7_secret_scan, op8_token_counts,
                                   op9_best_fit_packing, op10_token_id_output, passage_dedup, op11_hard_negatives, op12_decontamination, op13_filter_audit)}
# Tokenizers, hashes of Spark's own and the language model have no SQL form:
# those queries are compared with brute force in the tests.
ORACLE: dict[str, str] = {"op1_line_dedup": LINE_DEDUP_SQL, "op2_embedding_dedup": EMBEDDING_SQL, "op4_source_mix": MIX_SQL,
                          "op5_ngram_join": NGRAM_SQL, "passage_dedup": PASSAGE_DEDUP_SQL,
                          "op11_hard_negatives": HARD_NEGATIVES_SQL, "op12_decontamination": CONTAMINATION_SQL, "op13_filter_audit": AUDIT_SQL}
