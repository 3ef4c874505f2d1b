"""Quality of documents by a regularised quadratic discriminant.

Each text is reduced to a short vector of transformed statistics. Each class has a normal density with its own
covariance, shrunk towards its diagonal, and the score is the posterior chance of label 1. The densities are
evaluated through Cholesky factors that are computed once, when the model is made.

The model is fitted on all labelled rows that the caller passes: Spark adds up their moments, so only one
matrix for each class reaches the driver.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dialoom.llm.common import limit_batches, text_bytes, text_slices, written
from dialoom.llm.textbytes import LOWER, row_counts, span_hashes, spans, words

SHRINKAGE = 0.1
RIDGE = 1e-3
THRESHOLD = 0.7

# Byte classes of the statistics.
KINDS = {
    "upper": range(0x41, 0x5B),
    "lower": range(0x61, 0x7B),
    "digit": range(0x30, 0x3A),
    "stop": b".,;:?'\"()-",
    "bang": b"!",
    "symbol": b"#$%&*+/<=>@[\\]^_`{|}~",
    "tail": range(0x80, 0xC0),
    "lead": range(0xC0, 0x100),
}
STATISTICS = "word_length upper digit stop bang symbol foreign distinct repeated lines same_lines longest".split()
PRIOR = 20  # characters or words of evidence that every share is diluted with, so that short texts are no outliers


def statistics(column: pa.Array) -> np.ndarray:
    """A row of transformed statistics for each text, in the order of STATISTICS; finite for any text."""
    data, offsets = text_bytes(column)
    rows = len(offsets) - 1
    low = LOWER[data]
    kind = np.zeros(256, np.uint8)
    for i, codes in enumerate(KINDS.values(), 1):
        kind[list(codes)] = i
    kind = kind[data]
    n = {name: row_counts(np.flatnonzero(kind == i), offsets).astype(float) for i, name in enumerate(KINDS, 1)}
    chars = np.diff(offsets) - n["tail"]

    start, end = words(low, offsets)
    n_words = row_counts(start, offsets).astype(float)
    of_word = np.repeat(np.arange(rows), n_words.astype(np.int64))
    hashes = span_hashes(low, start, end)
    again = np.flatnonzero((hashes[1:] == hashes[:-1]) & (of_word[1:] == of_word[:-1]))
    repeated = np.bincount(of_word[again], minlength=rows)
    distinct = _distinct(of_word, hashes, rows)
    longest = np.zeros(rows)
    np.maximum.at(longest, of_word, end - start)

    start, end = spans(low != 0x0A, offsets)
    n_lines = row_counts(start, offsets).astype(float)
    of_line = np.repeat(np.arange(rows), n_lines.astype(np.int64))
    distinct_lines = _distinct(of_line, span_hashes(low, start, end), rows)

    def share(part: np.ndarray, whole: np.ndarray) -> np.ndarray:
        return np.sqrt(part / (whole + PRIOR))

    return np.column_stack(
        [
            np.log1p((chars + 6 * PRIOR) / (n_words + PRIOR)),
            share(n["upper"], chars),
            share(n["digit"], chars),
            share(n["stop"], chars),
            share(n["bang"], n_words),
            share(n["symbol"], n_words),
            share(n["lead"], chars),
            share(n_words - distinct, n_words),
            share(repeated, n_words),
            share(n_lines, n_words),
            share(n_lines - distinct_lines, n_lines),
            np.log(np.clip(longest, 16, None)),
        ]
    )


def _distinct(row: np.ndarray, hashes: np.ndarray, rows: int) -> np.ndarray:
    order = np.lexsort((hashes, row))
    row, hashes = row[order], hashes[order]
    new = np.ones(len(row), bool)
    new[1:] = (row[1:] != row[:-1]) | (hashes[1:] != hashes[:-1])
    return np.bincount(row[new], minlength=rows).astype(float)


@dataclass(frozen=True)
class Discriminant:
    """Class means, inverse Cholesky factors and log weights; `plain` is the score where a class is missing."""

    means: tuple[np.ndarray, ...]
    whiten: tuple[np.ndarray, ...]
    weights: tuple[float, ...]
    plain: float | None = None

    def scores(self, x: np.ndarray) -> np.ndarray:
        if self.plain is not None:
            return np.full(len(x), self.plain)
        log = [
            w - 0.5 * (((x - m) @ a.T) ** 2).sum(axis=1)
            for m, a, w in zip(self.means, self.whiten, self.weights, strict=True)
        ]
        return 1 / (1 + np.exp(np.clip(log[0] - log[1], -500, 500)))


def discriminant(moments: dict[int, np.ndarray], shrinkage: float = SHRINKAGE, ridge: float = RIDGE) -> Discriminant:
    """The model from sums of (1, x) (1, x)' by class. With fewer than two rows of a class every score is the
    share of label 1, or a half without rows."""
    counts = [moments[k][0, 0] if k in moments else 0.0 for k in (0, 1)]
    if min(counts) < 2:
        return Discriminant((), (), (), counts[1] / sum(counts) if sum(counts) else 0.5)
    means, whiten, weights = [], [], []
    for k in (0, 1):
        m = moments[k]
        mean = m[0, 1:] / counts[k]
        cov = m[1:, 1:] / counts[k] - np.outer(mean, mean)
        spread = np.diag(np.maximum(np.diag(cov), 0) + ridge)
        factor = np.linalg.cholesky((1 - shrinkage) * (cov + ridge * np.eye(len(cov))) + shrinkage * spread)
        means.append(mean)
        whiten.append(np.linalg.inv(factor))
        weights.append(float(np.log(counts[k] / sum(counts)) - np.log(np.diag(factor)).sum()))
    return Discriminant(tuple(means), tuple(whiten), tuple(weights))


def with_statistics(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and the statistics of each whole text; a null text is empty."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in text_slices(batch, "text"):
                x = statistics(part["text"])
                flat = pa.FixedSizeListArray.from_arrays(pa.array(x.ravel()), x.shape[1])
                yield pa.RecordBatch.from_arrays(
                    [part["doc_id"], flat.cast(pa.list_(pa.float64()))], ["doc_id", "x"]
                )

    limit_batches(docs)
    kind = docs.schema[id_col].dataType.simpleString()
    named = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    return named.mapInArrow(run, f"doc_id {kind}, x array<double>")


def fit(labelled: DataFrame) -> Discriminant:
    """The model of `labelled` (label, x), over all its rows; rows with another label than 0 or 1 are left out."""

    def sums(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            for label, part in batch.groupby("label"):
                x = np.column_stack([np.ones(len(part)), np.stack(part["x"].to_numpy())])
                total[label] = total.get(label, 0) + x.T @ x
        for label, m in total.items():
            i, j = np.indices(m.shape)
            yield pd.DataFrame({"label": label, "i": i.ravel(), "j": j.ravel(), "s": m.ravel()})

    known = labelled.where(F.col("label").isin(0, 1)).select(F.col("label").cast("int"), "x")
    rows = (
        known.mapInPandas(sums, "label int, i int, j int, s double")
        .groupBy("label", "i", "j")
        .agg(F.sum("s").alias("s"))
        .collect()  # (statistics + 1) squared rows for each class
    )
    size = len(STATISTICS) + 1
    moments: dict[int, np.ndarray] = {}
    for row in rows:
        moments.setdefault(row.label, np.zeros((size, size)))[row.i, row.j] = row.s
    return discriminant(moments)


def with_scores(features: DataFrame, model: Discriminant) -> DataFrame:
    """`features` (doc_id, x) with `score` in place of x."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = np.asarray(batch["x"].flatten()).reshape(len(batch), len(STATISTICS))
            yield pa.RecordBatch.from_arrays([batch["doc_id"], pa.array(model.scores(x))], ["doc_id", "score"])

    kind = features.schema["doc_id"].dataType.simpleString()
    return features.select("doc_id", "x").mapInArrow(run, f"doc_id {kind}, score double")


def held_out(doc_id: Column) -> Column:
    """Rows never learned from: crc32 of the id as text, modulo 4, is 2. A null id counts as held out."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(True))


def score_quality(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, held_out, score and predicted of every row of `docs`.

    `labels` has doc_id and quality; labels of held-out rows, null labels and labels of unknown documents are
    not learned from. Repeated documents or labels count as often as they come. Empty and null texts have
    statistics of zero and a score like any other; an empty table gives no rows.
    """
    features = written(with_statistics(docs, id_col, text_col), "statistics")
    known = labels.where(~held_out(F.col("doc_id"))).select("doc_id", F.col("quality").alias("label"))
    model = fit(features.join(known, "doc_id").select("label", "x"))
    score = F.col("score")
    return with_scores(features, model).select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (score >= THRESHOLD).cast("int").alias("predicted")
    )


def keep_good(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """`docs` without the rows that the classifier rejects, all columns as they were.

    The decision is taken where the text is read, with the fitted model, so no text is shuffled.
    """
    known = labels.where(~held_out(F.col("doc_id"))).select("doc_id", F.col("quality").alias("label"))
    model = fit(with_statistics(docs, id_col, text_col).join(known, "doc_id").select("label", "x"))
    names = docs.columns
    at = names.index(text_col)

    def kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            named = batch.rename_columns([f"{i}" for i in range(batch.num_columns)])
            for part in text_slices(named, f"{at}"):
                good = model.scores(statistics(part[at])) >= THRESHOLD
                yield part.filter(pa.array(good)).rename_columns(names)

    return docs.mapInArrow(kept, docs.schema)
