"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from dialoom.session import work_path

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
SLICE_BYTES = 1 << 20
BATCH_ROWS = 1000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ascii_lower(text: Column) -> Column:
    """`text` with A-Z lower-cased and every other character as it is."""
    plain = F.octet_length(text) == F.length(text)
    return F.when(plain, F.lower(text)).otherwise(F.translate(text, UPPER, UPPER.lower()))


def written(df: DataFrame, name: str) -> DataFrame:
    """`df` computed once into the shared folder, and read back from there."""
    path = work_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def limit_batches(df: DataFrame) -> None:
    """Has Arrow batches of the session hold no more than BATCH_ROWS rows, as texts may be long."""
    conf, key = df.sparkSession.conf, "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(conf.get(key)) <= BATCH_ROWS:
        conf.set(key, BATCH_ROWS)


def free_names(df: DataFrame, *names: str) -> list[str]:
    """`names`, lengthened where `df` has such a column already."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name = f"_{name}"
        out.append(name)
    return out


def text_slices(batch: pa.RecordBatch, column: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Consecutive rows of `batch` with at most `limit` bytes of text together, or one row of any length."""
    lengths = np.asarray(pc.fill_null(pc.binary_length(batch[column]), 0), dtype=np.int64)
    ends = np.cumsum(lengths)
    start = 0
    while start < len(lengths):
        before = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, before + limit, "right")))
        yield batch.slice(start, stop - start)
        start = stop
    pa.default_memory_pool().release_unused()


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of a string column and the offsets of its rows in them; nulls are empty."""
    kind = pa.large_string() if pa.types.is_large_string(column.type) else pa.string()
    column = pa.concat_arrays([pc.fill_null(column.cast(kind), "")])  # starts at offset 0
    width = np.int64 if kind == pa.large_string() else np.int32
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, width)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def row_keys(df: DataFrame) -> list[Column]:
    """Two 64-bit hashes of a whole row; rows that repeat have the same."""
    every = [F.col(f"`{c}`") for c in df.columns]
    return [F.xxhash64(*every), F.xxhash64(F.lit("salt"), *every)]


def only_rows(df: DataFrame, key: Column, keys: DataFrame) -> DataFrame:
    """Rows of `df` whose `key` is in the one column of `keys`, one row for each key, all columns as they were."""
    (name,) = free_names(df, "_key")
    keys = keys.toDF(name)
    return df.withColumn(name, key).join(keys, name, "left_semi").dropDuplicates([name]).select(*df.columns)
