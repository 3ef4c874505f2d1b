"""Whitening of vectors on distributed block matrices.

Components become whole numbers, so that sums, means and deviations are exact. The distinct vectors, centred, are
cut into blocks of rows, each numbered, and make a BlockMatrix A; its transpose times itself, added up block by
block, is the scatter, whose eigenvectors are found on the driver (it is as wide as a vector is long). All rows
make a second BlockMatrix, and its product with the whitening matrix projects them. The result's blocks meet
their rows again by the number of the block.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.mllib.linalg import DenseMatrix
from pyspark.mllib.linalg.distributed import BlockMatrix
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dialoom.llm.common import written

SCALE, SHIFT = 64, 1_000_000
COMPONENTS = 16
BLOCK_ROWS = 1024
BLOCKS_A_SPLIT = 16  # blocks that one task multiplies
LONG = 2.0**62


def whole_numbers(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(vec_id, x) of the vectors that take part, components floor(64 c) + 1000000."""
    c = F.col(vector_col)
    wrong = F.exists(c, lambda e: e.isNull() | F.isnan(e) | (F.abs(e.cast("double")) == float("inf")))
    x = F.transform(c, lambda e: F.floor(SCALE * e.cast("double")).cast("bigint") + SHIFT)
    return vectors.where(c.isNotNull() & ~wrong).select(F.col(id_col).alias("vec_id"), x.alias("x"))


def row_blocks(rows: DataFrame, n: int, sums: np.ndarray, block_rows: int) -> DataFrame:
    """(vec_ids, deviations, centred) of consecutive rows, at most `block_rows` to a block."""
    width, kind = len(sums), rows.schema["vec_id"].dataType

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, len(batch), block_rows):
                part = batch.slice(start, block_rows)
                x = np.asarray(part["x"].flatten(), np.int64).reshape(-1, width)
                off = n * x - sums  # n times the centred components
                if (off.astype(np.float64) ** 2).sum(axis=1).max(initial=0) >= LONG:
                    raise ValueError("a deviation is too large for a long")
                deviations = pa.array([(off**2).sum(axis=1).tolist()], pa.list_(pa.int64()))
                ids = pa.ListArray.from_arrays(pa.array([0, len(part)], pa.int32()), part["vec_id"])
                centred = pa.array([(off / n).tobytes()], pa.binary())
                yield pa.RecordBatch.from_arrays([ids, deviations, centred], ["vec_ids", "deviations", "centred"])

    fields = [
        T.StructField("vec_ids", T.ArrayType(kind)),
        T.StructField("deviations", T.ArrayType(T.LongType())),
        T.StructField("centred", T.BinaryType()),
    ]
    return rows.mapInArrow(run, T.StructType(fields))


def numbered(blocks: DataFrame, name: str) -> DataFrame:
    """`blocks` with consecutive numbers, written once so that a number stays with its rows."""
    schema = T.StructType([T.StructField("block", T.LongType()), *blocks.schema.fields])
    return written(blocks.rdd.zipWithIndex().map(lambda r: (r[1], *r[0])).toDF(schema), name)


def block_matrix(blocks: DataFrame, count: int, block_rows: int, width: int) -> BlockMatrix:
    """The centred rows as a matrix; blocks with fewer rows end in rows of zeros, which add nothing to a scatter."""

    def dense(row) -> tuple:
        values = np.frombuffer(row.centred).reshape(-1, width)
        full = np.zeros((block_rows, width))
        full[: len(values)] = values
        return (int(row.block), 0), DenseMatrix(block_rows, width, full.ravel(order="F"))

    return BlockMatrix(blocks.select("block", "centred").rdd.map(dense), block_rows, width, count * block_rows, width)


def scatter(matrix: BlockMatrix, blocks: int) -> np.ndarray:
    """Transpose times matrix. The rows that meet in a product are split, so that no task gets all blocks."""
    splits = max(1, blocks // BLOCKS_A_SPLIT)
    left, right = matrix.transpose()._java_matrix_wrapper, matrix._java_matrix_wrapper._java_model
    return BlockMatrix(left.call("multiply", right, splits), matrix.colsPerBlock, matrix.colsPerBlock).toLocalMatrix().toArray()


def projected(matrix: BlockMatrix, whitening: np.ndarray) -> BlockMatrix:
    """Rows times the whitening matrix, which is one block."""
    width, components = whitening.shape
    one = [((0, 0), DenseMatrix(width, components, whitening.ravel(order="F")))]
    sc = matrix.blocks.context
    return matrix.multiply(BlockMatrix(sc.parallelize(one, 1), width, components, width, components))


def eigen(covariance: np.ndarray, components: int) -> tuple[np.ndarray, np.ndarray]:
    """Largest eigenvalues and unit eigenvectors, without those that are zero but for rounding."""
    values, vectors = np.linalg.eigh((covariance + covariance.T) / 2)
    values, vectors = values[::-1], vectors[:, ::-1]
    kept = int((values > max(values[0], 0.0) * len(values) * 1e-13).sum())
    values, vectors = values[: min(kept, components)], vectors[:, : min(kept, components)]
    sign = np.sign(vectors[np.abs(vectors).argmax(axis=0), np.arange(len(values))]) if len(values) else 1.0
    return values, vectors * sign


RESULT = (
    "component int, n long, deviation long, whitened double, explained double, identity_error double"
)


def whiten(
    vectors: DataFrame,
    components: int = COMPONENTS,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """vec_id, component, n, deviation, whitened, explained and identity_error for every vector and component.

    The covariance is taken over the distinct vectors (n of them). Vectors that are null or hold a component that
    is null or not finite take no part. Vectors of different lengths are filled up with components of 0. Repeated
    rows come out each and count once in the covariance; a null id stays null. Components whose eigenvalue is
    zero but for rounding cannot be scaled and are left out, so that one distinct vector, or vectors without
    components, give no rows; nor does an empty table. Equal eigenvalues keep the order in which they are found.
    Other columns are not read. Components too large for exact longs raise an error.
    """
    spark = vectors.sparkSession
    kind = vectors.schema[id_col].dataType.simpleString()
    empty = spark.createDataFrame([], f"vec_id {kind}, {RESULT}")
    rows = written(whole_numbers(vectors, id_col, vector_col), "whole")
    width = rows.agg(F.max(F.size("x"))).first()[0] or 0
    if not width:
        return empty
    filled = F.concat("x", F.array_repeat(F.lit(SHIFT).cast("bigint"), width - F.size("x")))
    rows = rows.select("vec_id", filled.alias("x"))
    fit = written(rows.select("x").distinct(), "fit")
    facts = fit.agg(F.count("*"), *[F.sum(F.col("x")[i]) for i in range(width)]).first()
    n, sums = facts[0], np.array(facts[1:], np.int64)
    if n * float(np.abs(sums / n).max() + SHIFT) >= LONG:
        raise ValueError("sums are too large for longs")

    fit_blocks = numbered(row_blocks(fit.select(F.lit(None).cast(kind).alias("vec_id"), "x"), n, sums, block_rows), "fit-blocks")
    count = fit_blocks.count()
    fitted = block_matrix(fit_blocks, count, block_rows, width)
    covariance = scatter(fitted, count) / n
    values, axes = eigen(covariance, components)
    if not len(values):
        return empty
    whitening = axes / np.sqrt(values)
    explained = (values / np.trace(covariance)).tolist()
    spread = scatter(projected(fitted, whitening), count) / n
    error = float(np.abs(spread - np.eye(len(values))).max())

    all_blocks = numbered(row_blocks(rows, n, sums, block_rows), "blocks")
    matrix = projected(block_matrix(all_blocks, all_blocks.count(), block_rows, width), whitening)
    values_of = matrix.blocks.map(lambda b: (int(b[0][0]), bytearray(np.asarray(b[1].toArray()).tobytes())))
    meeting = spark.createDataFrame(values_of, "block long, whitened binary")
    k = len(values)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(len(batch)):
                part = batch.slice(i, 1)
                ids, deviations = part["vec_ids"].flatten(), part["deviations"].flatten()
                white = np.frombuffer(part["whitened"][0].as_py()).reshape(-1, k)[: len(ids)]
                row = pa.array(np.repeat(np.arange(len(ids)), k))
                size = len(row)
                yield pa.RecordBatch.from_arrays(
                    [
                        ids.take(row),
                        pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(ids))),
                        pa.array(np.full(size, n)),
                        deviations.take(row),
                        pa.array(white.ravel()),
                        pa.array(np.tile(explained, len(ids))),
                        pa.array(np.full(size, error)),
                    ],
                    ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"],
                )

    joined = all_blocks.drop("centred").join(meeting, "block")
    return joined.mapInArrow(run, f"vec_id {kind}, {RESULT}")
