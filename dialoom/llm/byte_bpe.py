"""Byte-level BPE encoding and decoding of texts of any length.

Texts are cut into chunks that overlap. Each chunk is pre-tokenised on its own, in parallel; where the matches
of a chunk and of the next one first start at the same place, the two have resynchronised, as what follows a
start depends only on what comes after it. Cutting each text at these places gives pieces that are encoded on
their own; their ids in order are the ids of the text. Where two chunks never agree inside their overlap (a run of
hundreds of characters of one kind), nothing is known of the chunks after it: the rest of that text is one
piece. A text of one chunk has nothing to stitch and is encoded where it is read. Decoding concatenates the
raw bytes of the tokens.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from dialoom.llm.common import limit_batches, text_slices, written

CHUNK_CHARS = 32_768
OVERLAP_CHARS = 512
MARGIN = 4  # a match that starts nearer to a cut may not have seen all that it depends on


def read_ranks(path: str) -> bytes:
    with open(path, "rb") as file:
        return file.read()


class Codec:
    """An encoding by ranks and a pattern, with tables for ids."""

    def __init__(self, ranks: bytes, pattern: str):
        import regex
        import tiktoken

        by_bytes = {base64.b64decode(a): int(b) for a, b in (line.split() for line in ranks.splitlines() if line)}
        self.encoding = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=by_bytes, special_tokens={})
        self.pattern = regex.compile(pattern)
        top = max(by_bytes.values()) + 1
        self.raw = [b""] * top
        for token, rank in by_bytes.items():
            self.raw[rank] = token
        self.digits = [str(i) for i in range(top)]

    def encode(self, texts: list[str]) -> pa.Array:
        ids = [self.encoding.encode_to_numpy(text, disallowed_special=()) for text in texts]
        offsets = np.zeros(len(ids) + 1, np.int32)
        np.cumsum([len(x) for x in ids], out=offsets[1:])
        flat = np.concatenate(ids).astype(np.int32) if ids else np.zeros(0, np.int32)
        return pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat))

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.raw.__getitem__, ids))

    def ids_text(self, ids: list[int]) -> str:
        return " ".join(map(self.digits.__getitem__, ids))

    def starts(self, text: str) -> list[int]:
        """Where matches start, but for those too close to the end to be sure of, and those after white space,
        which would be matched otherwise if the text ended there."""
        last = len(text) - MARGIN
        places = (m.start() for m in self.pattern.finditer(text))
        return [p for p in places if p <= last and not (p and text[p - 1].isspace())]


@lru_cache(maxsize=2)
def codec(ranks: bytes, pattern: str) -> Codec:
    return Codec(ranks, pattern)


def encode_texts(
    docs: DataFrame,
    ranks: bytes,
    pattern: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    chunk: int = CHUNK_CHARS,
    overlap: int = OVERLAP_CHARS,
) -> DataFrame:
    """doc_id and ids of the whole text of every row of `docs`, without special tokens.

    Null and empty texts have no ids. Repeated rows are encoded each; an empty table gives no rows; other
    columns are not read.
    """
    limit_batches(docs)
    kind = docs.schema[id_col].dataType.simpleString()
    text = F.coalesce(F.col(text_col), F.lit(""))
    named = docs.select(F.col(id_col).alias("doc_id"), text.alias("text"))
    short = _encoded(named.where(F.length("text") <= chunk), f"doc_id {kind}", ranks, pattern)

    long = named.where(F.length("text") > chunk).withColumn("row", F.monotonically_increasing_id())
    chunks = written(_cut(long, f"row long, doc_id {kind}", chunk, overlap).repartition("row", "k"), "chunks")
    pieces = _stitched(chunks, _starts(chunks, ranks, pattern, chunk, overlap), chunk)
    ids = _encoded(pieces, f"row long, doc_id {kind}, piece long", ranks, pattern)
    whole = ids.groupBy("row").agg(
        F.first("doc_id").alias("doc_id"), F.sort_array(F.collect_list(F.struct("piece", "ids"))).alias("pieces")
    )
    return short.unionByName(whole.select("doc_id", F.flatten("pieces.ids").alias("ids")))


def _encoded(texts: DataFrame, keys: str, ranks: bytes, pattern: str) -> DataFrame:
    """`texts` (keys, text) with ids in place of text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(ranks, pattern)
        for batch in batches:
            for part in text_slices(batch, "text"):
                names = [name for name in part.schema.names if name != "text"]
                ids = own.encode(part["text"].to_pylist())
                yield pa.RecordBatch.from_arrays([*(part[name] for name in names), ids], [*names, "ids"])

    return texts.mapInArrow(run, f"{keys}, ids array<int>")


def _cut(long: DataFrame, keys: str, chunk: int, overlap: int) -> DataFrame:
    """Chunks k of each text; chunk k starts at character k * chunk and runs `overlap` characters into the next."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, text in enumerate(batch["text"]):
                text = text.as_py()
                at = range(0, len(text), chunk)
                row = batch.slice(i, 1).select(["row", "doc_id"])
                for k, start in enumerate(at):
                    yield pa.RecordBatch.from_arrays(
                        [*row.columns, pa.array([k]), pa.array([text[start : start + chunk + overlap]])],
                        ["row", "doc_id", "k", "text"],
                    )

    return long.select("row", "doc_id", "text").mapInArrow(run, f"{keys}, k long, text string")


def _starts(chunks: DataFrame, ranks: bytes, pattern: str, chunk: int, overlap: int) -> DataFrame:
    """Places, counted from the start of the text, at which matches of a chunk start in its overlap with the chunk
    before (`head`) and in that with the chunk after (`tail`)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(ranks, pattern)
        for batch in batches:
            heads, tails = [], []
            for k, text in zip(batch["k"].to_pylist(), batch["text"].to_pylist(), strict=True):
                places = own.starts(text)
                heads.append([k * chunk + p for p in places if p < overlap])
                tails.append([k * chunk + p for p in places if p >= chunk])
            kind = pa.list_(pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch["row"], batch["k"], pa.array(heads, kind), pa.array(tails, kind)], ["row", "k", "head", "tail"]
            )

    return chunks.select("row", "k", "text").mapInArrow(run, "row long, k long, head array<long>, tail array<long>")


def _stitched(chunks: DataFrame, starts: DataFrame, chunk: int) -> DataFrame:
    """Pieces (row, doc_id, piece, text) of the chunked texts, cut at the first start that both sides of a seam share.

    Chunk 0 starts a piece at its own start. From the first seam without a shared start on, there are no cuts.
    """
    seam = Window.partitionBy("row").orderBy("k")
    shared = F.array_min(F.array_intersect(F.lag("tail").over(seam), F.col("head")))
    found = starts.select("row", "k", F.when(F.col("k") == 0, 0).otherwise(shared).alias("cut"))
    intact = F.count(F.when(F.col("cut").isNull(), 1)).over(seam) == 0
    cuts = found.select("row", "k", F.when(intact, F.col("cut")).alias("cut")).select(
        "row",
        "k",
        "cut",
        F.count("cut").over(seam).alias("piece"),
        F.lead("k").over(seam).isNull().alias("is_last"),
        F.lead("cut").over(seam).alias("next_cut"),
    )
    begin = F.coalesce(F.col("cut") - F.col("k") * chunk, F.lit(0))
    end = F.when(~F.col("is_last"), F.coalesce(F.col("next_cut") - F.col("k") * chunk, F.lit(chunk)))
    part = F.substr(
        "text", (begin + 1).cast("int"), F.coalesce(end - begin, F.lit((1 << 31) - 1)).cast("int")
    )
    return (
        chunks.join(cuts, ["row", "k"])
        .select("row", "doc_id", "piece", F.struct("k", part.alias("part")).alias("part"))
        .groupBy("row", "piece")
        .agg(F.first("doc_id").alias("doc_id"), F.sort_array(F.collect_list("part")).alias("parts"))
        .select("row", "doc_id", "piece", F.array_join("parts.part", "").alias("text"))
    )


def decode_ids(encoded: DataFrame, ranks: bytes, pattern: str) -> DataFrame:
    """doc_id and the raw bytes that the ids of each row of `encoded` (doc_id, ids) stand for; null ids are none."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(ranks, pattern)
        for batch in batches:
            raw = [own.decode(ids or []) for ids in batch["ids"].to_pylist()]
            yield pa.RecordBatch.from_arrays([batch["doc_id"], pa.array(raw, pa.binary())], ["doc_id", "bytes"])

    kind = encoded.schema["doc_id"].dataType.simpleString()
    return encoded.select("doc_id", "ids").mapInArrow(run, f"doc_id {kind}, bytes binary")


def round_trip_digests(encoded: DataFrame, ranks: bytes, pattern: str, with_ids: bool = False) -> DataFrame:
    """doc_id, n_tokens, ids_sha256 (of the decimal ids with spaces between) and decoded_sha256 of `encoded`
    (doc_id, ids), and the ids themselves if asked for. Null ids are none."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(ranks, pattern)
        for batch in batches:
            for i in range(0, len(batch), 64):
                part = batch.slice(i, 64)
                rows = [ids or [] for ids in part["ids"].to_pylist()]
                columns = {
                    "doc_id": part["doc_id"],
                    "n_tokens": pa.array([len(ids) for ids in rows], pa.int64()),
                    "ids_sha256": pa.array([hashlib.sha256(own.ids_text(ids).encode()).hexdigest() for ids in rows]),
                    "decoded_sha256": pa.array([hashlib.sha256(own.decode(ids)).hexdigest() for ids in rows]),
                }
                if with_ids:
                    columns["ids"] = part["ids"]
                yield pa.RecordBatch.from_pydict(columns)

    kind = encoded.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string"
    return encoded.select("doc_id", "ids").mapInArrow(run, schema + (", ids array<int>" if with_ids else ""))
