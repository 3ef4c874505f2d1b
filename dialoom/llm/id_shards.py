"""Token ids in binary shards, in the order of the document keys, with keyed access through a perfect hash.

File format: a folder of Parquet files whose rows are pieces of shards.

| column | content |
| --- | --- |
| shard, piece | shards hold ranges of keys, in ascending order; a shard of many ids has several pieces |
| first_key, last_key | smallest and largest key of the piece |
| n_docs, n_ids | documents and ids in the piece |
| width | bytes of an id, 2 or 4 |
| ids | the ids of the documents in their order, little-endian and unsigned, nothing in between |
| nulls | documents at the start of the piece whose key is null |
| keys | keys of the other documents in their order, 64 bits each |
| levels, level_sizes | bit tables of a minimal perfect hash over the documents of the piece |
| fingerprints | 32 bits of another hash for each slot, so that a foreign key is refused |
| starts, lengths | first id and number of ids for each slot |

A key is looked up in constant time: the hash gives its slot, the fingerprint says whether it is this key, and
start and length cut its ids out of the payload. A key that repeats in a piece is hashed with its number, from 0.
"""

from __future__ import annotations

import math
import zlib
from array import array
from collections.abc import Iterator, Sequence
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from dialoom.llm.common import limit_batches, text_slices
from dialoom.llm.pieces import SPLIT_BYTES, encoder, read_file, split_column
from dialoom.llm.textbytes import mixed

END_ID = 2
SHARD_DOCS = 8192
PIECE_BYTES = 8 << 20
MOST_TABLES = 200  # keys that differ are told apart by a few dozen
SCHEMA = (
    "shard long, piece long, first_key long, last_key long, n_docs long, n_ids long, width int, ids binary, "
    "keys binary, nulls long, levels binary, level_sizes binary, fingerprints binary, starts binary, lengths binary"
)


# ---- minimal perfect hash


class PerfectHash(NamedTuple):
    """Bit tables, one after the other; the slot of a key is the number of bits set before the one it hits in the
    first table where its bit is set."""

    levels: np.ndarray
    sizes: np.ndarray

    @property
    def tables(self) -> list[np.ndarray]:
        return np.split(self.levels, np.cumsum(self.sizes)[:-1]) if len(self.sizes) else []


def _hash(keys: np.ndarray, level: int) -> np.ndarray:
    return mixed(keys ^ mixed(np.full(1, level + 1, np.uint64)))


def perfect_hash(keys: np.ndarray) -> PerfectHash:
    """The hash of distinct 64-bit keys: each table takes the keys that are alone on their bit, the rest goes on."""
    tables = []
    while len(keys):
        if len(tables) == MOST_TABLES:
            raise ValueError(f"{len(keys)} keys are still together after {MOST_TABLES} tables: they hash alike")
        at = (_hash(keys, len(tables)) % np.uint64(len(keys))).astype(np.int64)
        table = np.bincount(at, minlength=len(keys)) == 1
        tables.append(table)
        keys = keys[~table[at]]
    sizes = np.array([len(t) for t in tables], np.int64)
    return PerfectHash(np.concatenate(tables) if tables else np.zeros(0, bool), sizes)


def slots_of(hashed: PerfectHash, keys: np.ndarray) -> np.ndarray:
    """Slot of each key, or -1 for a key that is in no table."""
    out = np.full(len(keys), -1, np.int64)
    left, before = np.arange(len(keys)), 0
    for level, table in enumerate(hashed.tables):
        at = (_hash(keys[left], level) % np.uint64(len(table))).astype(np.int64)
        rank = np.cumsum(table)
        hit = table[at]
        out[left[hit]] = before + rank[at[hit]] - 1
        left, before = left[~hit], before + int(rank[-1])
    return out


def fingerprints(keys: np.ndarray) -> np.ndarray:
    return (mixed(keys * np.uint64(0xD6E8FEB86659FD93) + np.uint64(1)) >> np.uint64(32)).astype(np.uint32)


class Index(NamedTuple):
    """Keyed access to one piece."""

    hashed: PerfectHash
    fingerprints: np.ndarray
    starts: np.ndarray
    lengths: np.ndarray

    @staticmethod
    def build(entries: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> Index:
        hashed = perfect_hash(entries)
        slot = slots_of(hashed, entries)
        marks, at, length = np.zeros(len(slot), np.uint32), np.zeros(len(slot), np.int64), np.zeros(len(slot), np.int64)
        marks[slot], at[slot], length[slot] = fingerprints(entries), starts, lengths
        return Index(hashed, marks, at, length)

    @staticmethod
    def read(row: dict) -> Index:
        bits, sizes = np.frombuffer(row["levels"], np.uint8), np.frombuffer(row["level_sizes"], "<i8")
        levels = np.unpackbits(bits)[: int(sizes.sum())].astype(bool)
        return Index(
            PerfectHash(levels, sizes),
            np.frombuffer(row["fingerprints"], "<u4"),
            np.frombuffer(row["starts"], "<i8"),
            np.frombuffer(row["lengths"], "<i8"),
        )

    def columns(self) -> dict:
        return {
            "levels": np.packbits(self.hashed.levels).tobytes(),
            "level_sizes": self.hashed.sizes.astype("<i8").tobytes(),
            "fingerprints": self.fingerprints.astype("<u4").tobytes(),
            "starts": self.starts.astype("<i8").tobytes(),
            "lengths": self.lengths.astype("<i8").tobytes(),
        }

    def find(self, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Whether each entry is here, its start and its length."""
        slot = slots_of(self.hashed, entries)
        here = slot >= 0
        here[here] = self.fingerprints[slot[here]] == fingerprints(entries[here])
        start, length = np.full(len(entries), -1, np.int64), np.zeros(len(entries), np.int64)
        start[here], length[here] = self.starts[slot[here]], self.lengths[slot[here]]
        return here, start, length


def entries_of(keys: np.ndarray, nulls: int = 0) -> np.ndarray:
    """What is hashed for `nulls` documents without a key and those with the ascending `keys`: the key and how
    often it came before."""
    new = np.concatenate([[True], keys[1:] != keys[:-1]]) if len(keys) else np.zeros(0, bool)
    first = np.flatnonzero(new)
    number = np.arange(len(keys)) - np.repeat(first, np.diff(np.append(first, len(keys))))
    named = mixed(keys.astype(np.int64).view(np.uint64)) + number.astype(np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F)
    nameless = mixed(np.arange(nulls, dtype=np.uint64) + np.uint64(0x165667B19E3779F9))
    return np.concatenate([nameless, mixed(named)])


# ---- writing


def _raw(ids: Sequence[int]) -> bytes:
    return array("I", ids).tobytes()  # 32 bits each


def _rows(raw: list[bytes], numbers: np.ndarray, rows: np.ndarray) -> tuple[pa.Array, pa.Array]:
    """Width and ids of each row, none without an id: row i has raw[numbers[j]], j from rows[i] to rows[i + 1]."""
    sizes = np.fromiter(map(len, raw), np.int64, len(raw)) // 4
    of_piece = pa.LargeListArray.from_arrays(np.append(0, np.cumsum(sizes)), np.frombuffer(b"".join(raw), np.uint32))
    ids = np.asarray(of_piece.take(pa.array(numbers)).flatten())
    ends = np.append(0, np.cumsum(sizes[numbers]))[rows]
    width = np.where(np.maximum.reduceat(ids, ends[:-1]) > 0xFFFF, 4, 2).astype(np.int32)
    if (width == 2).all():
        bounds = pa.py_buffer((ends * 2).astype(np.int32))
        packed = pa.Array.from_buffers(pa.binary(), len(width), [None, bounds, pa.py_buffer(ids.astype("<u2"))])
    else:
        cut = zip(np.split(ids, ends[1:-1]), width.tolist(), strict=True)
        packed = pa.array([x.astype(f"<u{w}").tobytes() for x, w in cut], pa.binary())
    return pa.array(width), packed


def _bounds(docs: DataFrame, shard_docs: int) -> np.ndarray:
    """Smallest keys of the shards but the first. Only the key column is read; a number for each shard comes back."""
    shards = math.ceil(docs.count() / shard_docs)
    if shards < 2:
        return np.zeros(0, np.int64)
    ranges = docs.select("doc_id").repartitionByRange(shards, "doc_id")
    firsts = ranges.groupBy(F.spark_partition_id().alias("p")).agg(F.min("doc_id").alias("first")).collect()
    return np.array(sorted(r.first for r in firsts if r.first is not None)[1:], np.int64)


def write_ids(
    docs: DataFrame,
    path: str,
    tokenizer_path: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    end_id: int = END_ID,
    shard_docs: int = SHARD_DOCS,
) -> None:
    """Writes the ids of every whole text of `docs`, `end_id` after each, in ascending order of the keys.

    Keys are whole numbers; null keys come first and cannot be looked up. Rows that repeat a key are all
    written, in the order of their ids, and the key leads to the first. Null and empty texts have the end id
    alone. An empty table gives a folder without rows; other columns are not read.
    """
    limit_batches(docs)
    named = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    bounds = _bounds(named, shard_docs)
    definition = read_file(tokenizer_path)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        results = encoder(definition, _raw).results
        end = np.array([end_id], np.uint32).tobytes()
        for batch in batches:
            for part in text_slices(batch, "text", SPLIT_BYTES):
                split = split_column(part["text"])
                raw = [*map(results(split.pieces).__getitem__, split.pieces), end]
                ended = np.insert(split.numbers, split.rows[1:], len(raw) - 1)
                width, ids = _rows(raw, ended, split.rows + np.arange(len(split.rows)))
                keys = part["doc_id"]
                shard = np.searchsorted(bounds, np.asarray(keys.fill_null(np.iinfo(np.int64).min)), "right")
                yield pa.RecordBatch.from_arrays([pa.array(shard), keys, width, ids], ["shard", "key", "width", "ids"])

    encoded = named.mapInArrow(encode, "shard long, key long, width int, ids binary")
    ordered = encoded.repartition(max(1, len(bounds) + 1), "shard").sortWithinPartitions("shard", "key", "ids")
    ordered.mapInArrow(_packed, SCHEMA).write.option("compression", "zstd").parquet(path)


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pieces of the shards in a sorted partition."""
    encoder.cache_clear()  # encoding is over: a worker that did it has its results' memory back
    shard, piece, rows, held = None, 0, [], 0

    def close() -> pa.RecordBatch:
        wide = max(width for _, width, _ in rows)
        arrays = [np.frombuffer(ids, "<u4" if width == 4 else "<u2") for _, width, ids in rows]
        lengths = np.array([len(a) for a in arrays], np.int64)
        starts = np.cumsum(lengths) - lengths
        nulls = sum(key is None for key, _, _ in rows)
        keys = np.array([key for key, _, _ in rows[nulls:]], np.int64)
        index = Index.build(entries_of(keys, nulls), starts, lengths)
        columns = {
            "shard": shard,
            "piece": piece,
            "first_key": int(keys[0]) if len(keys) else None,
            "last_key": int(keys[-1]) if len(keys) else None,
            "n_docs": len(rows),
            "n_ids": int(lengths.sum()),
            "width": wide,
            "ids": np.concatenate(arrays).astype("<u4" if wide == 4 else "<u2", copy=False).tobytes(),
            "keys": keys.astype("<i8").tobytes(),
            "nulls": nulls,
            **index.columns(),
        }
        kinds = {"width": pa.int32()} | dict.fromkeys(
            ("ids", "keys", "levels", "level_sizes", "fingerprints", "starts", "lengths"), pa.binary()
        )
        return pa.RecordBatch.from_arrays(
            [pa.array([v], kinds.get(name, pa.int64())) for name, v in columns.items()], list(columns)
        )

    for batch in batches:
        for at, key, width, ids in zip(*(batch[c].to_pylist() for c in ("shard", "key", "width", "ids")), strict=True):
            if rows and (at != shard or held + len(ids) > PIECE_BYTES):
                yield close()
                piece, rows, held = (piece + 1 if at == shard else 0), [], 0
            shard = at
            rows.append((key, width, ids))
            held += len(ids)
    if rows:
        yield close()


# ---- reading


def read_ids(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(SCHEMA).parquet(path)


def _payload(row: dict) -> np.ndarray:
    return np.frombuffer(row["ids"], "<u4" if row["width"] == 4 else "<u2")


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start, n_tokens and ids_crc32 of every document in the files, `start` being the ids of all before.

    Each piece is read once, and each of its documents is looked up in its index and cut out of the payload.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(len(batch)):
                (row,) = batch.slice(i, 1).to_pylist()
                payload, keys = _payload(row), np.frombuffer(row["keys"], "<i8")
                here, start, length = Index.read(row).find(entries_of(keys, row["nulls"]))
                if not here.all():
                    raise ValueError(f"shard {row['shard']}, piece {row['piece']}: a document is not in the index")
                sums = [
                    zlib.crc32(payload[a : a + n].astype("<u4").tobytes())
                    for a, n in zip(start.tolist(), length.tolist(), strict=True)
                ]
                yield pa.RecordBatch.from_pydict(
                    {
                        "shard": pa.array(np.full(len(sums), row["shard"])),
                        "piece": pa.array(np.full(len(sums), row["piece"])),
                        "doc_id": pa.array([None] * row["nulls"] + keys.tolist(), pa.int64()),
                        "at": pa.array(start),
                        "n_tokens": pa.array(length),
                        "ids_crc32": pa.array(sums, pa.int64()),
                    }
                )

    pieces = read_ids(spark, path)
    schema = "shard long, piece long, doc_id long, at long, n_tokens long, ids_crc32 long"
    found = pieces.drop("first_key", "last_key").mapInArrow(run, schema)
    order = Window.orderBy("shard", "piece")  # over a row for each piece
    bases = pieces.select("shard", "piece", (F.sum("n_ids").over(order) - F.col("n_ids")).alias("base"))
    return found.join(bases, ["shard", "piece"]).select(
        "doc_id", (F.col("base") + F.col("at")).alias("start"), "n_tokens", "ids_crc32"
    )


def look_up(keys: DataFrame, path: str) -> DataFrame:
    """(key, ids) of those `keys` (one column of whole numbers) that the files have, each once; of a key that
    repeats in the files, the first document.

    The smallest key of each shard is read by the driver, a number for some thousand documents.
    """
    spark = keys.sparkSession
    pieces = read_ids(spark, path)
    firsts = pieces.where("first_key is not null").groupBy("shard").agg(F.min("first_key").alias("first"))
    known = sorted((r["first"], r.shard) for r in firsts.collect())
    bounds, shards = np.array([k for k, _ in known], np.int64), np.array([s for _, s in known], np.int64)

    def route(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            at = np.searchsorted(bounds, frame["key"], "right") - 1
            frame = frame[at >= 0]
            yield frame.assign(shard=shards[at[at >= 0]])

    def find(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        out = []
        asked = left["key"].to_numpy(np.int64)
        entries = mixed(mixed(asked.view(np.uint64)))
        for row in right.sort_values("piece").to_dict("records"):
            here, start, length = Index.read(row).find(entries)
            payload = _payload(row)
            ids = [payload[a : a + n].astype(np.int64) for a, n in zip(start[here], length[here], strict=True)]
            out.append(pd.DataFrame({"key": asked[here], "ids": pd.Series(ids, dtype=object)}))
            asked, entries = asked[~here], entries[~here]
        return pd.concat(out) if out else pd.DataFrame({"key": [], "ids": []}, dtype=object)

    asked = keys.toDF("key").select(F.col("key").cast("long")).where("key is not null").distinct()
    routed = asked.mapInPandas(route, "key long, shard long")
    return routed.groupBy("shard").cogroup(pieces.groupBy("shard")).applyInPandas(find, "key long, ids array<long>")
