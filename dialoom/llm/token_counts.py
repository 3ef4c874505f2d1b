"""Token counts of whole texts, without their tokens leaving the Python worker.

Arrow functions encode a batch at a time and return lengths only. Batches are cut anew by bytes, so that a
batch of long texts costs what a batch of short ones does, and texts are split at places that no token spans
(see `pieces`), so a very long text is no heavier than many short ones.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dialoom.llm.common import limit_batches, text_slices
from dialoom.llm.pieces import SPLIT_BYTES, encoder, read_file, split_column

LIMIT = 1024


def count_tokens(
    docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text", limit: int = LIMIT
) -> DataFrame:
    """doc_id, n_bytes, n_tokens and over_limit of every row of `docs`.

    No begin, end or other token is added; special strings inside a text are what the tokenizer takes them for.
    Null and empty texts have no tokens. Repeated rows are counted each; an empty table gives no rows; other
    columns are not read.
    """
    limit_batches(docs)
    definition = read_file(tokenizer_path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        results = encoder(definition, len).results
        for batch in batches:
            for part in text_slices(batch, "text", SPLIT_BYTES):
                split = split_column(part["text"])
                length = results(split.pieces).__getitem__
                lengths = np.fromiter(map(length, split.pieces), np.int64, len(split.pieces))
                before = np.append(0, np.cumsum(lengths[split.numbers]))
                n_tokens = pa.array(np.diff(before[split.rows]))
                n_bytes = pc.fill_null(pc.binary_length(part["text"]), 0).cast(pa.int64())
                yield pa.RecordBatch.from_arrays([part["doc_id"], n_bytes, n_tokens], ["doc_id", "n_bytes", "n_tokens"])

    kind = docs.schema[id_col].dataType.simpleString()
    named = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    counted = named.mapInArrow(run, f"doc_id {kind}, n_bytes long, n_tokens long")
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
