"""Language-model scores of documents by deleted interpolation.

The chance of a token after a context mixes relative frequencies: of the n-gram in its context, of the shorter
n-gram in its shorter context, and so on down to the token alone and to a uniform chance,

    p_k(w) = a_k * count(context w) / count(context) + (1 - a_k) * p_(k-1)(w),

where the weight a_k depends on k and on the power of two in which count(context) falls. The weights are learned
by expectation-maximisation: a part of the training documents is deleted, n-grams are counted without it, and the
weights make that part likely. Scores then use the counts of all training documents.

Counts of n-grams reach the tokens without a row for each token. Documents are cut into blocks of about
`block_tokens` tokens, written once as numbers of words. A block asks for its distinct n-grams, sorted by their
64-bit hashes, in one request to each range of hashes; a range adds up the counts of all blocks and answers each
request with counts in the order asked. Groups come to Python in batches of about 1 MB and leave in such, as whole ones
would take the executor's memory outside of its heap. Requests number (tokens / block_tokens)**2 for each length of n-gram, so
they are fewer than the tokens up to block_tokens**2 of them (2e13). An n-gram comes once from a block however
often it occurs, so that no frequent one makes a range large.
"""

from __future__ import annotations

import ctypes
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from dialoom.llm.common import limit_batches, text_bytes, text_slices, written
from dialoom.llm.textbytes import LOWER, PRIME, mixed, row_counts, span_hashes, words

ORDER = 3
BLOCK_TOKENS = 1 << 22
CHUNK_TOKENS = 1 << 18
BATCH_BYTES = 1 << 20
STRIP_BITS = 4
FOLDS, HELD_OUT, DELETED = 7, 2, 3
ROUNDS, SETTLED = 20, 1e-5
BUCKETS = 64
END, START = np.uint64(0x5851F42D4C957F2D), np.uint64(0x14057B7EF767814F)
KEPT_KIND, DELETED_KIND, HELD_OUT_KIND = 0, 1, 2


# ---- numbers as bytes


def shrunk(values: np.ndarray) -> bytes:
    """Whole numbers as bytes, those of the same weight side by side and compressed."""
    columns = np.ascontiguousarray(values).view(np.uint8).reshape(len(values), -1).T
    return zstandard.ZstdCompressor(1).compress(columns.tobytes())


def unshrunk(data: bytes, kind: type) -> np.ndarray:
    columns = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8)
    return np.ascontiguousarray(columns.reshape(np.dtype(kind).itemsize, -1).T).view(kind).ravel()


def sorted_shrunk(values: np.ndarray) -> bytes:
    """Ascending uint64 by their differences."""
    return shrunk(np.diff(values, prepend=np.uint64(0)))


def sorted_unshrunk(data: bytes) -> np.ndarray:
    return np.cumsum(unshrunk(data, np.uint64), dtype=np.uint64)


def in_order(values: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Where the values are in ascending order, the values in that order, and which of these are new."""
    order = np.argsort(values)
    ordered = values[order]
    return order, ordered, new_ones(ordered)


def new_ones(ordered: np.ndarray) -> np.ndarray:
    first = np.ones(len(ordered), bool)
    np.not_equal(ordered[1:], ordered[:-1], out=first[1:])
    return first


def placed(order: np.ndarray, first: np.ndarray) -> np.ndarray:
    place = np.empty(len(order), np.uint32)
    place[order] = np.cumsum(first, dtype=np.uint32)
    place -= np.uint32(1)
    return place


def joined(parts: list[np.ndarray]) -> np.ndarray:
    """The parts one after the other; takes them out of the list, so that they go as they are copied."""
    out = np.empty(sum(map(len, parts)), parts[0].dtype)
    at = len(out)
    while parts:
        part = parts.pop()
        at -= len(part)
        out[at : at + len(part)] = part
    return out


def strips(values: np.ndarray, bits: int = STRIP_BITS) -> Iterator[np.ndarray]:
    """Where the values with each number in their first bits are, in ascending order of these; temporaries stay small."""
    strip = np.zeros(len(values), np.uint8)
    for at in range(0, len(values) if bits else 0, CHUNK_TOKENS):
        strip[at : at + CHUNK_TOKENS] = values[at : at + CHUNK_TOKENS] >> np.uint64(64 - bits)
    for number in range(1 << bits):
        yield np.flatnonzero(strip == number)


def ranked(values: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct values in order, how often each occurs, and the place of each value among them."""
    distinct, often, place, done = [], [], np.empty(len(values), np.uint32), 0
    for where in strips(values):
        order, ordered, first = in_order(values[where])
        distinct.append(ordered[first])
        often.append(np.diff(np.flatnonzero(first), append=len(ordered)))
        place[where] = placed(order, first) + np.uint32(done)
        done += len(distinct[-1])
    return np.concatenate(distinct), np.concatenate(often), place


def release() -> None:
    """Gives the memory that a block took back to the machine, where the C library can."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def limit_batch_bytes(df: DataFrame) -> None:
    """Has Arrow batches of the session end once they hold BATCH_BYTES, unless it sets a limit of its own."""
    conf, key = df.sparkSession.conf, "spark.sql.execution.arrow.maxBytesPerBatch"
    if conf.get(key, None) is None:
        conf.set(key, BATCH_BYTES)


# ---- blocks of documents


def token_hashes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all tokens of the texts one after the other, an end after each, and how many each text has."""
    data, offsets = text_bytes(column)
    data = LOWER[data]
    starts, ends = words(data, offsets)
    counts = row_counts(starts, offsets)
    hashes = np.insert(span_hashes(data, starts, ends), np.cumsum(counts), END)
    return hashes, counts + 1


class Block:
    """Documents gathered until there are enough tokens."""

    def __init__(self) -> None:
        self.ids: list = []
        self.counts: list[np.ndarray] = []
        self.hashes: list[np.ndarray] = []
        self.size = 0

    def add(self, ids: pa.Array, hashes: np.ndarray, counts: np.ndarray) -> None:
        self.ids.append(ids)
        self.hashes.append(hashes)
        self.counts.append(counts)
        self.size += len(hashes)

    def row(self, number: int, kind: int) -> pa.RecordBatch:
        vocabulary, often, place = ranked(joined(self.hashes))
        frequent = np.argsort(-often, kind="stable")
        rank = np.empty(len(frequent), np.uint32)
        rank[frequent] = np.arange(len(frequent), dtype=np.uint32)
        ids = pa.concat_arrays(self.ids)
        lists = pa.ListArray.from_arrays(pa.array([0, len(ids)], pa.int32()), ids)
        return pa.RecordBatch.from_arrays(
            [
                pa.array([number], pa.int64()),
                pa.array([kind], pa.int32()),
                pa.array([self.size], pa.int64()),
                lists,
                pa.array([shrunk(np.concatenate(self.counts).astype(np.int64))], pa.binary()),
                pa.array([sorted_shrunk(vocabulary)], pa.binary()),
                pa.array([shrunk(rank)], pa.binary()),
                pa.array([shrunk(rank[place])], pa.binary()),
            ],
            ["block", "kind", "n_tokens", "ids", "counts", "vocabulary", "ranks", "tokens"],
        )


class Tokens:
    """Hashes of the tokens of a block, made where they are asked for."""

    def __init__(self, vocabulary: bytes, ranks: bytes, tokens: bytes):
        self.by_rank = np.empty(len(order := unshrunk(ranks, np.uint32)), np.uint64)
        self.by_rank[order] = sorted_unshrunk(vocabulary)
        self.ranks = unshrunk(tokens, np.uint32)

    def __len__(self) -> int:
        return len(self.ranks)

    def __getitem__(self, some: slice) -> np.ndarray:
        return self.by_rank[self.ranks[some]]


def fold_of(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % FOLDS, F.lit(-1))


def encoded(docs: DataFrame, id_col: str, text_col: str, block_tokens: int) -> DataFrame:
    """Blocks of documents of one kind each (kept, deleted, held out), with their tokens as numbers of words."""
    limit_batches(docs)
    kind = docs.schema[id_col].dataType
    fold = fold_of(F.col(id_col))
    role = F.when(fold == HELD_OUT, HELD_OUT_KIND).when(fold == DELETED, DELETED_KIND).otherwise(KEPT_KIND)
    named = docs.select(
        F.spark_partition_id().alias("task"),
        role.alias("kind"),
        F.col(id_col).alias("doc_id"),
        F.coalesce(F.col(text_col), F.lit("")).alias("text"),
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_blocks: dict[int, Block] = {}
        task, done = 0, 0
        for batch in batches:
            for part in text_slices(batch, "text", BATCH_BYTES // 4):
                if not len(part):
                    continue
                task = part["task"][0].as_py()
                kinds = np.asarray(part["kind"])
                for k in np.unique(kinds).tolist():
                    own = part.filter(pa.array(kinds == k))
                    block = open_blocks.setdefault(k, Block())
                    block.add(own["doc_id"], *token_hashes(own["text"]))
                    if block.size >= block_tokens:
                        yield open_blocks.pop(k).row((task << 32) + done, k)
                        done += 1
                        release()
        for k in list(open_blocks):
            yield open_blocks.pop(k).row((task << 32) + done, k)
            done += 1
        release()

    fields = [
        T.StructField("block", T.LongType()),
        T.StructField("kind", T.IntegerType()),
        T.StructField("n_tokens", T.LongType()),
        T.StructField("ids", T.ArrayType(kind)),
        *[T.StructField(c, T.BinaryType()) for c in ("counts", "vocabulary", "ranks", "tokens")],
    ]
    return written(named.mapInArrow(run, T.StructType(fields)), "blocks")


# ---- counts of n-grams


def starts_of(counts: np.ndarray) -> np.ndarray:
    """Where each document of a block starts."""
    return np.cumsum(counts) - counts


def grams(tokens: np.ndarray | Tokens, starts: np.ndarray, order: int) -> Iterator[np.ndarray]:
    """For each length up to `order` the hashes of the n-grams that end at each token, filled up in front of a text.
    Longer ones take the place of those before, in the same array."""
    gram = np.empty(len(tokens), np.uint64)
    for at in range(0, len(gram), CHUNK_TOKENS):
        gram[at : at + CHUNK_TOKENS] = tokens[at : at + CHUNK_TOKENS]
    yield gram
    for k in range(2, order + 1):
        for at in reversed(range(0, len(gram), CHUNK_TOKENS)):  # from the back, as a token needs the n-gram before it
            some = slice(at, min(at + CHUNK_TOKENS, len(gram)))
            context = np.empty(some.stop - at, np.uint64)
            context[0] = gram[at - 1]
            context[1:] = gram[at : some.stop - 1]
            context[starts[slice(*np.searchsorted(starts, [at, some.stop]))] - at] = START + np.uint64(k)
            gram[some] = mixed(context * np.uint64(PRIME) + tokens[some] + np.uint64(k))
        yield gram


ASKED = pa.schema({"length": pa.int32(), "range": pa.int64(), "block": pa.int64(), "kind": pa.int32(), "grams": pa.binary(), "counts": pa.binary()})
ANSWERED = pa.schema(
    {
        **{c: ASKED.field(c).type for c in ("length", "range", "block", "kind")},
        **{"kept": pa.binary(), "trained": pa.binary(), "distinct": pa.int64(), "distinct_kept": pa.int64()},
    }
)


def batch_of(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), schema.types, strict=True)]
    return pa.RecordBatch.from_arrays(columns, schema=schema)


def ranges(gram: np.ndarray, bits: int) -> Iterator[tuple[int, np.ndarray]]:
    """The number of each range that hashes are in, and the hashes there in ascending order."""
    wide = min(bits, STRIP_BITS)
    each = 1 << (bits - wide)
    for strip, where in enumerate(strips(gram, wide)):
        ordered = np.sort(gram[where])
        del where
        inner = np.arange(strip * each + 1, (strip + 1) * each, dtype=np.uint64) << np.uint64(64 - bits) if each > 1 else []
        for number, part in enumerate(np.split(ordered, np.searchsorted(ordered, inner) if each > 1 else []), strip * each):
            if len(part):
                yield number, part


def requests(blocks: DataFrame, order: int, bits: int) -> DataFrame:
    """(length, range, block, kind, grams, counts): the distinct n-grams of a block in a range of hashes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(len(batch)):
                block, kind = batch["block"][i].as_py(), batch["kind"][i].as_py()
                counts = unshrunk(batch["counts"][i].as_py(), np.int64)
                tokens = Tokens(*(batch[c][i].as_py() for c in ("vocabulary", "ranks", "tokens")))
                for length, gram in enumerate(grams(tokens, starts_of(counts), order), 1):
                    rows, held = [], 0
                    for number, part in ranges(gram, bits):
                        first = new_ones(part)
                        often = np.diff(np.flatnonzero(first), append=len(part)).astype(np.uint32)
                        rows.append((length, number, block, kind, sorted_shrunk(part[first]), None if kind == HELD_OUT_KIND else shrunk(often)))
                        held += len(rows[-1][4])
                        if held > BATCH_BYTES:
                            yield batch_of(rows, ASKED)
                            rows, held = [], 0
                    if rows:
                        yield batch_of(rows, ASKED)
                del tokens, gram
                release()

    used = blocks.select("block", "kind", "counts", "vocabulary", "ranks", "tokens")
    return used.mapInArrow(run, "length int, range long, block long, kind int, grams binary, counts binary")


ANSWER = "length int, range long, block long, kind int, kept binary, trained binary, distinct long, distinct_kept long"


def answers(asked: DataFrame) -> DataFrame:
    """For each request the counts in kept and in all training documents; and for each range how many n-grams are known."""

    def run(key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        length, number = (k.as_py() for k in key)
        asked, lists = [], []
        for batch in batches:
            asked += batch.select(["block", "kind", "counts"]).to_pylist()
            lists += [sorted_unshrunk(g.as_py()) for g in batch["grams"]]
        ends = np.cumsum([len(x) for x in lists])
        values = joined(lists)
        order, ordered, first = in_order(values)
        del values, ordered
        places = np.split(placed(order, first), ends[:-1])
        known = int(first.sum())
        del order, first
        kept, trained = np.zeros(known, np.int64), np.zeros(known, np.int64)
        for where, request in zip(places, asked, strict=True):
            if request["kind"] != HELD_OUT_KIND:
                own = unshrunk(request.pop("counts"), np.uint32)
                trained[where] += own
                if request["kind"] == KEPT_KIND:
                    kept[where] += own
        rows, held = [(length, number, -1, -1, None, None, int((trained > 0).sum()), int((kept > 0).sum()))], 0
        for where, request in zip(places, asked, strict=True):
            before = shrunk(kept[where]) if request["kind"] == DELETED_KIND else None
            rows.append((length, number, request["block"], request["kind"], before, shrunk(trained[where]), 0, 0))
            held += len(before or b"") + len(rows[-1][5])
            if held > BATCH_BYTES:
                yield batch_of(rows, ANSWERED)
                rows, held = [], 0
        if rows:
            yield batch_of(rows, ANSWERED)
        del places, kept, trained, asked
        release()

    return written(asked.groupBy("length", "range").applyInArrow(run, ANSWER), "answers")


class Totals:
    """Numbers of tokens, documents and distinct tokens in all training documents or in those kept."""

    def __init__(self, tokens: int, documents: int, distinct: int):
        self.tokens, self.documents, self.distinct = tokens, documents, distinct

    def ratios(self, counts: list[np.ndarray], starts: np.ndarray) -> tuple[list[np.ndarray], list[np.ndarray], np.ndarray]:
        """For each length above 1 the relative frequency and the context's bucket (0: unseen); for 1 the frequency."""
        shares, buckets = [], []
        for shorter, longer in zip(counts[:-1], counts[1:], strict=True):
            context = np.empty_like(shorter)
            context[1:] = shorter[:-1]
            context[starts] = self.documents
            shares.append(longer / np.maximum(context, 1))
            buckets.append(np.frexp(context.astype(np.float64))[1])  # bits of the count
        return shares, buckets, counts[0] / max(self.tokens, 1)


def meet(blocks: DataFrame, replies: DataFrame, run, schema: str) -> DataFrame:
    """`run` over each block and its replies, as batches of rows of both that `gathered` reads."""
    met = blocks.unionByName(replies.toDF("block", "length", "range", "reply"), allowMissingColumns=True)
    return met.groupBy("block").applyInArrow(run, schema)


def gathered(batches: Iterator[pa.RecordBatch], order: int) -> tuple[dict, list[list[bytes]]]:
    """The row of a block, with its ids as an array, and for each length the replies in ascending order of the ranges."""
    block, replies = {}, [[] for _ in range(order)]
    for batch in batches:
        for i, length in enumerate(batch["length"].to_pylist()):
            if length is None:
                block = {c: batch[c][i].as_py() for c in batch.schema.names if c != "ids"}
                if "ids" in batch.schema.names:
                    block["ids"] = pa.concat_arrays([batch["ids"][i].values])
            else:
                replies[length - 1].append((batch["range"][i].as_py(), batch["reply"][i].as_py()))
    return block, [[reply for _, reply in sorted(of_length)] for of_length in replies]


def spread(gram: np.ndarray, replies: list[bytes]) -> np.ndarray:
    """The count of each n-gram from the counts of the distinct ones in order; found for a strip of the hashes at a time."""
    parts = (unshrunk(reply, np.int64) for reply in replies)
    known = np.concatenate([part.astype(np.min_scalar_type(part.max())) for part in parts])
    counts, done = np.empty(len(gram), known.dtype), 0
    for where in strips(gram):
        order, _, first = in_order(gram[where])
        stop = done + int(first.sum())
        counts[where] = known[done:stop][placed(order, first)]
        done = stop
    return counts


def looked_up(block: dict, replies: list[list[bytes]]) -> Iterator[tuple[slice, list[np.ndarray], np.ndarray]]:
    """For some documents of a block at a time: which they are, the counts by length of the n-grams that end at each
    of their tokens, and where each document starts among those tokens. Takes the tokens and replies out of what it is given."""
    sizes = unshrunk(block["counts"], np.int64)
    starts = starts_of(sizes)
    tokens = Tokens(*(block.pop(c) for c in ("vocabulary", "ranks", "tokens")))
    release()
    counts = []
    for gram in grams(tokens, starts, len(replies)):
        counts.append(spread(gram, replies[len(counts)]))
        replies[len(counts) - 1] = []
        release()
    del tokens, gram
    first = 0
    while first < len(sizes):
        last = max(first + 1, int(np.searchsorted(starts + sizes, starts[first] + CHUNK_TOKENS, "right")))
        tokens = slice(starts[first], starts[last - 1] + sizes[last - 1])
        yield slice(first, last), [c[tokens].astype(np.int64) for c in counts], starts[first:last] - starts[first]
        first = last


# ---- weights


class Weights:
    """The share of the longer n-gram by length and bucket of its context, and of the token's own frequency."""

    def __init__(self, order: int):
        self.longer = np.full((order - 1, BUCKETS + 2), 0.5)
        self.longer[:, 0] = 0  # a context never seen says nothing
        self.own = 0.5

    def chances(self, shares: list, buckets: list, own: np.ndarray, uniform: float) -> list[np.ndarray]:
        """Chances of the tokens by models of growing length."""
        out = [self.own * own + (1 - self.own) * uniform]
        for weights, share, bucket in zip(self.longer, shares, buckets, strict=True):
            w = weights[bucket]
            out.append(w * share + (1 - w) * out[-1])
        return out


def held_out_events(blocks: DataFrame, answered: DataFrame, order: int, kept: Totals) -> DataFrame:
    """Distinct events in deleted documents, by column: how often each was seen, its shares, own frequency and buckets."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, counts, starts in looked_up(*gathered(batches, order)):
            shares, buckets, own = kept.ratios(counts, starts)
            _, first, often = np.unique(mixed_columns([*shares, *buckets, own]), return_index=True, return_counts=True)
            columns = [often.astype(np.uint32), *(x[first] for x in (*shares, own)), *(b[first].astype(np.uint8) for b in buckets)]
            yield pa.RecordBatch.from_arrays([pa.array([[shrunk(c) for c in columns]], pa.list_(pa.binary()))], ["event"])
        release()

    own = blocks.where(F.col("kind") == DELETED_KIND).select("block", "counts", "vocabulary", "ranks", "tokens")
    replies = answered.where(F.col("kind") == DELETED_KIND).select("block", "length", "range", "kept")
    return written(meet(own, replies, run, "event array<binary>"), "events")


def mixed_columns(columns: list[np.ndarray]) -> np.ndarray:
    """A 64-bit hash of each row of the columns."""
    out = np.zeros(len(columns[0]), np.uint64)
    for column in columns:
        out = mixed(out * np.uint64(PRIME) + column.astype(np.float64).view(np.uint64) + np.uint64(1))
    return out


def read_event(columns: list[bytes], order: int) -> tuple[np.ndarray, list, list, np.ndarray]:
    often = unshrunk(columns[0], np.uint32).astype(np.float64)
    *shares, own = (unshrunk(c, np.float64) for c in columns[1 : order + 1])
    return often, shares, [unshrunk(c, np.uint8) for c in columns[order + 1 :]], own


def expected(weights: Weights, often: np.ndarray, shares: list, buckets: list, own: np.ndarray, uniform: float) -> list[tuple]:
    """(length, bucket, part taken by the longer n-gram, all that reached this length) and the log chance as length 0."""
    chances = weights.chances(shares, buckets, own, uniform)
    out = [(0, 0, float((often * np.log(chances[-1])).sum()), float(often.sum()))]
    reached = often
    for length in range(len(shares) + 1, 1, -1):
        share, bucket = shares[length - 2], buckets[length - 2]
        taken = reached * weights.longer[length - 2][bucket] * share / chances[length - 1]
        part = np.bincount(bucket, taken, BUCKETS + 2)
        every = np.bincount(bucket, reached, BUCKETS + 2)
        out += [(length, int(b), float(part[b]), float(every[b])) for b in np.flatnonzero(every)]
        reached = reached - taken
    taken = reached * weights.own * own / chances[0]
    return [*out, (1, 0, float(taken.sum()), float(reached.sum()))]


def learned(events: DataFrame, order: int, uniform: float, rounds: int = ROUNDS) -> Weights:
    """Weights by expectation-maximisation, until the mean log chance of a token settles."""
    weights, last = Weights(order), -math.inf
    for _ in range(rounds):
        now = weights

        def run(batches: Iterator[pa.RecordBatch], now: Weights = now) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for columns in batch["event"]:
                    rows = expected(now, *read_event(columns.as_py(), order), uniform)
                    kinds = (pa.int32(), pa.int32(), pa.float64(), pa.float64())
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)],
                        ["length", "bucket", "taken", "reached"],
                    )
            release()

        parts = events.mapInArrow(run, "length int, bucket int, taken double, reached double")
        sums = parts.groupBy("length", "bucket").agg(F.sum("taken").alias("taken"), F.sum("reached").alias("reached"))
        likely, weights = -math.inf, Weights(order)
        for row in sums.collect():  # one for each length and bucket at most
            if row.length == 0:
                likely = row.taken / max(row.reached, 1)
            elif row.length == 1:
                weights.own = min(row.taken / row.reached, 1 - 1e-6) if row.reached else 0.5
            elif row.bucket and row.reached:
                weights.longer[row.length - 2, row.bucket] = min(row.taken / row.reached, 1 - 1e-6)
        if likely - last < SETTLED:
            break
        last = likely
    return weights


# ---- scores


def score_texts(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    order: int = ORDER,
    block_tokens: int = BLOCK_TOKENS,
) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score of every row of `docs`.

    A null text is empty and has one token, the end. Texts are read whole, however long; one text is never cut
    between blocks. Rows that repeat count each, in training too. A null id belongs to the training documents.
    Without training documents every count is 0 and chances are uniform; without deleted ones the weights stay at
    one half. An empty table gives no rows; other columns are not read. Buckets that no deleted text reached keep
    a weight of one half. N-grams are told apart by 64-bit hashes.
    """
    if order < 2:
        raise ValueError("order must be 2 or more")
    limit_batch_bytes(docs)
    kind = docs.schema[id_col].dataType
    blocks = encoded(docs, id_col, text_col, block_tokens)
    size = {r.kind: (r.tokens, r.documents) for r in blocks.groupBy("kind").agg(F.sum("n_tokens").alias("tokens"), F.sum(F.size("ids")).alias("documents")).collect()}  # three rows
    bits = max(0, math.ceil(math.log2(max(1, sum(tokens for tokens, _ in size.values())) / block_tokens)))
    answered = answers(requests(blocks, order, bits))
    known = answered.where((F.col("block") == -1) & (F.col("length") == 1)).agg(F.sum("distinct"), F.sum("distinct_kept")).first()
    own, gone = size.get(KEPT_KIND, (0, 0)), size.get(DELETED_KIND, (0, 0))
    every = Totals(own[0] + gone[0], own[1] + gone[1], known[0] or 0)
    kept = Totals(*own, known[1] or 0)
    weights = learned(held_out_events(blocks, answered, order, kept), order, 1 / (kept.distinct + 1))
    if not every.tokens:
        weights.own = 0  # nothing was counted
    return scored(blocks, answered, order, every, weights, kind)


RESULT = "held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"


def scored(blocks: DataFrame, answered: DataFrame, order: int, every: Totals, weights: Weights, kind: T.DataType) -> DataFrame:
    names = ["doc_id", *[c.split()[0] for c in RESULT.split(", ")]]
    id_type = to_arrow_type(kind)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, replies = gathered(batches, order)
        sizes, held_out = unshrunk(block["counts"], np.int64), block["kind"] == HELD_OUT_KIND
        for some, counts, starts in looked_up(block, replies):
            chances = weights.chances(*every.ratios(counts, starts), 1 / (every.distinct + 1))
            base = np.log10((counts[0] + 1) / (every.tokens + every.distinct + 1))
            columns = [
                np.full(len(starts), held_out),
                sizes[some],
                np.add.reduceat((counts[0] > 0).astype(np.int64), starts),
                np.full(len(starts), every.tokens, np.int64),
                np.add.reduceat(base, starts),
                np.add.reduceat(np.log10(chances[-1]), starts),
            ]
            yield pa.RecordBatch.from_arrays([block["ids"][some].cast(id_type), *map(pa.array, columns)], names)
        release()

    own = blocks.select("block", "kind", "ids", "counts", "vocabulary", "ranks", "tokens")
    replies = answered.where(F.col("block") >= 0).select("block", "length", "range", "trained")
    return meet(own, replies, run, f"doc_id {kind.simpleString()}, {RESULT}")
