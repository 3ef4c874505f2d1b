"""Exact removal of copies, with the frequent texts split off from the rest.

Misra-Gries counters (the algorithm behind `freqItems`) find every text that makes up more than one in
`counters` rows, besides some that don't. An exact count verifies them. The verified ones, fewer than
`counters`, are broadcast with their winners, so that their rows are settled where they are read; all other
texts have few rows each and are grouped by an ordinary shuffle of digests.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dialoom.llm.common import ascii_lower, free_names, only_rows, written

COUNTERS = 256


class Copies(NamedTuple):
    """`marks`: one row for each document; `winners`: the frequent texts and the rows that stay of them."""

    marks: DataFrame
    winners: DataFrame


def text_digest(text: Column) -> Column:
    """SHA-256 of the text with A-Z lower-cased, in hex; null counts as empty."""
    return F.sha2(ascii_lower(F.coalesce(text, F.lit(""))), 256)


def _groups(digests: DataFrame) -> DataFrame:
    return digests.groupBy("text_sha256").agg(
        F.max("doc_id").alias("keep_id"),
        F.coalesce(F.max_by("_row", "doc_id"), F.max("_row")).alias("_keep_row"),
        F.count("*").alias("group_size"),
    )


def find_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", counters: int = COUNTERS) -> Copies:
    """Marks of all rows: doc_id, keep_id, group_size, kept, text_sha256.

    Of equal texts the row with the largest id stays, and a null id is smaller than any other. A null text
    equals an empty one. Of rows that repeat the winning id, one stays. An empty table gives no rows; other
    columns of `docs` are not read.
    """
    digests = written(
        docs.select(
            F.col(id_col).alias("doc_id"),
            text_digest(F.col(text_col)).alias("text_sha256"),
            F.monotonically_increasing_id().alias("_row"),
        ),
        "digests",
    )
    rows = digests.count()
    frequent = digests.stat.freqItems(["text_sha256"], 1 / counters).select(
        F.explode("text_sha256_freqItems").alias("text_sha256")
    )
    candidates = digests.join(F.broadcast(frequent), "text_sha256", "left_semi")
    winners = written(_groups(candidates).where(F.col("group_size") * counters > rows), "winners")

    heavy = digests.join(F.broadcast(winners), "text_sha256")
    light = digests.join(F.broadcast(winners.select("text_sha256")), "text_sha256", "left_anti")
    light = light.join(_groups(light), "text_sha256")
    marks = heavy.unionByName(light).select(
        "doc_id",
        "keep_id",
        "group_size",
        (F.col("_row") == F.col("_keep_row")).alias("kept"),
        "text_sha256",
    )
    return Copies(marks, winners)


def drop_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", counters: int = COUNTERS) -> DataFrame:
    """`docs` with the rows that `find_copies` keeps, all columns as they were.

    Rows of frequent texts that do not win go before any text is shuffled.
    """
    marks, winners = find_copies(docs, id_col, text_col, counters)
    own, won, keep = free_names(docs, "_own", "_won", "_keep")

    def key(digest: Column, doc_id: Column) -> Column:
        return F.concat_ws(":", digest, doc_id.cast("string"))

    best = winners.select(F.col("text_sha256").alias(won), F.col("keep_id").alias(keep))
    left = (
        docs.withColumn(own, text_digest(F.col(text_col)))
        .join(F.broadcast(best), F.col(own) == F.col(won), "left")
        .where(F.col(won).isNull() | F.col(id_col).eqNullSafe(F.col(keep)))
    )
    stay = marks.where("kept").select(key(F.col("text_sha256"), F.col("doc_id")))
    return only_rows(left, key(F.col(own), F.col(id_col)), stay).select(*docs.columns)
