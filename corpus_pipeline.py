"""A training corpus from raw documents: good texts, each once, mixed by source, as token ids.

Each stage takes (spark, docs, sf_dir) and returns a data frame, which is written and read back as the next
one's documents. All but the last return the columns of `documents`, under any further columns' names too.

In every stage a null text is empty, an empty table stays empty, rows that repeat whole count as one document
and texts are read whole, however long. A document with a null id is trained on, kept and mixed like any other.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from dialoom.llm.byte_bpe import encode_texts, read_ranks, round_trip_digests
from dialoom.llm.common import table, written
from dialoom.llm.exact_dedup import drop_copies
from dialoom.llm.mixing import mixed_documents
from dialoom.llm.ngram_join import keep_one
from dialoom.llm.quality import keep_good

NEAR_WORDS, NEAR_PERCENT = 5, 80


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, fitted on the labels of documents at hand, does not reject."""
    return keep_good(docs, table(spark, sf_dir, "labels"))


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the document with the largest id."""
    return drop_copies(docs)


def ngram_jaccard_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents joined by links, 0.8 of their five-word shingles or more, the one with the smallest id."""
    return keep_one(docs, n=NEAR_WORDS, percent=NEAR_PERCENT)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mixture of sources: a row for each document and pass over its source, with the words taken."""
    return mixed_documents(docs)


def byte_bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each row, with digests of the ids and of what they decode to."""
    ranks = read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    encoded = encode_texts(docs, ranks, public_tokenizers.PATTERN)
    return round_trip_digests(encoded, ranks, public_tokenizers.PATTERN, with_ids=True)


STAGES = [
    ("quality classifier", quality_classifier),
    ("exact dedup", exact_dedup),
    ("n-gram Jaccard join", ngram_jaccard_join),
    ("mixing sources to target weights", mixing),
    ("byte-level BPE encoding and decoding", byte_bpe),
]

ORACLE_SQL = None  # no stage but the second can be said in SQL


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`, one after the other."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
