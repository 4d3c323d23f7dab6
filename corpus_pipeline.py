"""Corpus pipeline over ``documents``: each stage applies one of the training-data operators."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from stopflow.llm.common import importable, table
from stopflow.llm.line_dedup import dedup_lines
from stopflow.llm.mixing import mix_sources
from stopflow.llm.ngram_join import keep_one
from stopflow.llm.packing import pack_documents
from stopflow.llm.quality import keep_good
from stopflow.session import materialize


def _same_columns(df: DataFrame, docs: DataFrame) -> DataFrame:
    """``df`` with the columns of ``docs`` only, whatever their names."""
    return df.select(*("`" + c.replace("`", "``") + "`" for c in docs.columns))


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the perplexity model of trusted text doesn't reject.

    Null and empty texts stay, as do documents of languages without trusted
    text; a null language is one of its own.  Rows that repeat an id are
    judged each by its own text.  No documents, or no labels: nothing goes.
    """
    return keep_good(docs, table(spark, sf_dir, "labels"))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without repeated multi-line passages; n_chars follows the new text.

    A null text stays null, a text may become empty, and rows that repeat
    doc_id and text stay alike; a null doc_id comes after all others.  Other
    columns stay, but for ones named n_lines or n_removed, which get the
    operator's counts.  An empty table gives an empty one.
    """
    importable(spark)
    return _same_columns(dedup_lines(docs), docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that shares at least 0.8 of its five-word shingles.

    Null, empty and blank texts all stay; of rows that repeat doc_id and text
    one stays; rows of one doc_id in different groups are documents of their
    own.  An empty table gives an empty one.
    """
    importable(spark)
    return keep_one(docs, words=5, share=(4, 5))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeated so that all sources weigh the same, in a global random order.

    A null source is a source of its own; sources without text keep one copy
    on average.  Rows that repeat an id draw the same count.  Other columns
    stay, but for ones named copy or shuffle_key, which get the operator's
    values.  An empty table gives an empty one.
    """
    importable(spark)
    return _same_columns(mix_sources(docs), docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The places of all documents' pieces in sequences of 1024 tokens.

    A null or empty text is a document of the end id alone; each row is a
    document, copies too; a null doc_id stays null.  An empty table gives no
    rows; other columns are ignored.
    """
    importable(spark)
    return pack_documents(docs, public_tokenizers.path("byte_bpe_50k.json"), end_id=2)


STAGES = [("quality", quality), ("line_dedup", line_dedup), ("near_dedup", near_dedup), ("mix", mix), ("pack", pack)]

# Perplexities, component search and packing have no SQL form; tests/llm
# compares the stages with brute force.
ORACLE_SQL = None
PIPELINE_SQL = {} if ORACLE_SQL is None else {"pipeline": ORACLE_SQL}


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order; each one's rows are written as Parquet and read again by the next."""
    docs = table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k + 1 < len(STAGES):
            docs = materialize(docs, f"stage-{name}")
    return docs


pipeline = run
