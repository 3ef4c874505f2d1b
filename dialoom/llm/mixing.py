"""Mixing of sources to target weights, by blocks of words.

The words of each source, documents dealt to lots by a hash of their ids, are packed into blocks of fixed length. The
mixture is a row of slots, dealt to output shards. How many slots of a shard each source gets is drawn from
a multinomial. The j-th slot of a source holds its block number p(j), p being a pseudorandom permutation of
the source's block numbers, a new one for each pass over the source; so no block is used twice in a pass, and
no table of permutations exists. Joining blocks and slots by block number makes the mixture.

Multinomial totals scatter around the targets. A source that is drawn too often gives its last slots to the
sources drawn too rarely, so every source gets its target to the word.

Everything is a function of ids, sizes and the seed: reruns agree.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dialoom.llm.common import free_names, limit_batches, row_keys, text_slices, written
from dialoom.llm.textbytes import mixed

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (5, 2, 1)
SHARE, LIMIT = 1.5, 2
BLOCK_WORDS = 256
SHARD_SLOTS = 4096
LOT_ROWS = 4096
STRETCH = 4096
FILL_SHARDS = 16
MOST_SOURCES = 100_000  # a mixture has a weight for each source, so their number is that of a setting
SEED = 20


@dataclass(frozen=True)
class Source:
    """A source in the mixture: `words` of its own, `target` words asked for, `taken` words given (a whole number)."""

    name: str | None
    words: int
    target: float
    taken: int
    number: int
    block: int

    @property
    def blocks(self) -> int:
        return -(-self.words // self.block)

    def key(self, turn: int) -> int:
        return SEED * 1_000_003 + self.number * 16 + turn

    @property
    def slots(self) -> int:
        return self._tail[0]

    @property
    def last_take(self) -> int:
        """Words taken of the block in the last slot."""
        return self._tail[1]

    @property
    def _tail(self) -> tuple[int, int]:
        if not self.taken:
            return 0, 0
        turns, rest = divmod(self.taken, self.words)
        if not rest:
            turns, rest = turns - 1, self.words
        short_at = int(permuted(np.array([self.blocks - 1]), self.blocks, self.key(turns), back=True)[0])
        short = self.block * self.blocks - self.words

        def first(k: int) -> int:
            return k * self.block - (short if short_at < k else 0)

        k = -(-rest // self.block)
        k += first(k) < rest
        return turns * self.blocks + k, rest - first(k - 1)


def targets(words: list[int], weights: list[float], share: float = SHARE, limit: float = LIMIT) -> list[float]:
    """Target of each source: `share` of all words by weight, but at most `limit` times its own, what is above
    going to the others by weight until none is above."""
    out = [0.0] * len(words)
    left, open_ = share * sum(words), list(range(len(words)))
    while open_:
        scale = left / sum(weights[i] for i in open_)
        full = [i for i in open_ if scale * weights[i] > limit * words[i]]
        for i in full or open_:
            out[i] = float(limit * words[i]) if full else scale * weights[i]
        if not full:
            break
        left -= sum(out[i] for i in full)
        open_ = [i for i in open_ if i not in set(full)]
    return out


def permuted(x: np.ndarray, n: int, key: int, back: bool = False) -> np.ndarray:
    """Images of `x` under the permutation of 0..n-1 that `key` names; with `back`, the numbers whose images they are.

    A Feistel network over the next even number of bits, walked until it lands inside.
    """
    half = max(1, (max(n - 1, 1).bit_length() + 1) // 2)
    mask = np.uint64((1 << half) - 1)
    keys = mixed(np.arange(4, dtype=np.uint64) + np.uint64(key * 8))

    def turn(y: np.ndarray) -> np.ndarray:
        a, b = y >> np.uint64(half), y & mask
        for k in keys[::-1] if back else keys:
            if back:
                a, b = b ^ (mixed(a + k) & mask), a
            else:
                a, b = b, a ^ (mixed(b + k) & mask)
        return (a << np.uint64(half)) | b

    y = turn(x.astype(np.uint64))
    while (out := y >= n).any():
        y[out] = turn(y[out])
    return y.astype(np.int64)


def _sizes(docs: DataFrame, keys: list[Column], id_col: str, text_col: str, source_col: str) -> DataFrame:
    size = F.coalesce(F.regexp_count(F.col(text_col), F.lit(WORD)), F.lit(0)).cast("bigint")
    return docs.select(
        *keys,
        F.monotonically_increasing_id().alias("row"),
        F.col(id_col).alias("doc_id"),
        F.col(source_col).alias("source"),
        size.alias("size"),
    )


def plan(sizes: DataFrame, weights: tuple[float, ...], block: int) -> list[Source]:
    """The sources by code point, null last; weights repeat in that order."""
    rows = sizes.groupBy("source").agg(F.sum("size").alias("words")).limit(MOST_SOURCES + 1).collect()
    if len(rows) > MOST_SOURCES:
        raise ValueError(f"more than {MOST_SOURCES} sources")
    rows.sort(key=lambda r: (r.source is None, r.source))
    goals = targets([r.words for r in rows], [weights[i % len(weights)] for i in range(len(rows))])
    return [
        Source(r.source, r.words, goal, min(round(goal), LIMIT * r.words), i, block)
        for i, (r, goal) in enumerate(zip(rows, goals, strict=True))
    ]


def _with_before(rows: DataFrame, order: str, value: str) -> DataFrame:
    """`rows`, one for each number and `order`, with the sum of `value` in earlier rows of the number in `before`.

    A number is cut into stretches of 4,096 in `order`; only one row for each stretch is sorted in one task.
    """
    cut = rows.withColumn("stretch", F.floor(F.col(order) / STRETCH))
    inside = Window.partitionBy("number", "stretch").orderBy(order)
    over = Window.partitionBy("number").orderBy("stretch")
    sums = cut.groupBy("number", "stretch").agg(F.sum(value).alias("sum"))
    earlier = sums.select("number", "stretch", (F.sum("sum").over(over) - F.col("sum")).alias("earlier"))
    return (
        cut.withColumn("before", F.sum(value).over(inside) - F.col(value))
        .join(earlier, ["number", "stretch"])
        .withColumn("before", F.col("before") + F.col("earlier"))
        .drop("stretch", "earlier")
    )


def _placed(sizes: DataFrame, block: int, rows: int) -> DataFrame:
    """Parts (row, number, block, lo, hi) of documents in the blocks of their source; lo and hi count from the
    start of the block, `at` from the start of the document.

    A source is dealt out by ids to lots of some 4,096 rows; the words before a document are those of earlier
    lots and those before it in its lot.
    """
    lots = math.ceil(rows / LOT_ROWS)
    dealt = sizes.where("size > 0").withColumn("lot", F.pmod(F.xxhash64("doc_id"), F.lit(lots)))
    inside = Window.partitionBy("number", "lot").orderBy("doc_id", "size", "row")
    totals = written(dealt.groupBy("number", "lot").agg(F.sum("size").alias("words")), "lots")
    offsets = _with_before(totals, "lot", "words").select("number", "lot", F.col("before").alias("offset"))
    ends = dealt.withColumn("end", F.sum("size").over(inside)).join(offsets, ["number", "lot"])
    ends = ends.select("row", "number", "size", (F.col("offset") + F.col("end")).alias("end"))
    start = F.col("end") - F.col("size")
    part = ends.withColumn("start", start).withColumn(
        "block", F.explode(F.sequence(F.floor(F.col("start") / block), F.floor((F.col("end") - 1) / block)))
    )
    lo = F.greatest(F.col("start") - F.col("block") * block, F.lit(0))
    hi = F.least(F.col("end") - F.col("block") * block, F.lit(block))
    at = F.col("block") * block + lo - F.col("start")
    return part.select("row", "number", "block", lo.alias("lo"), hi.alias("hi"), at.alias("at"))


def _slots(spark, sources: list[Source], shard_slots: int) -> DataFrame:
    """Slots (shard, place, number, block, turn, take) of the mixture, in the shards they are drawn for."""
    wanted = np.array([s.slots for s in sources], np.int64)
    total = int(wanted.sum())
    shards = math.ceil(total / shard_slots)

    def draw(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for shard in frame["id"].tolist():
                here = min(shard_slots, total - shard * shard_slots)
                drawn = np.random.default_rng([SEED, shard]).multinomial(here, wanted / total)
                some = np.flatnonzero(drawn)
                yield pd.DataFrame({"shard": shard, "number": some, "drawn": drawn[some]})

    schema = "shard long, number int, drawn long"
    drawn = spark.range(shards).mapInPandas(draw, schema) if total else spark.createDataFrame([], schema)
    drawn = written(drawn, "drawn")
    got = np.zeros(len(sources), np.int64)
    for row in drawn.groupBy("number").agg(F.sum("drawn").alias("n")).collect():  # a row for each source
        got[row.number] = row.n
    surplus_before = np.cumsum(np.maximum(got - wanted, 0)) - np.maximum(got - wanted, 0)
    lacking_until = np.cumsum(np.maximum(wanted - got, 0))

    def owners(shard: int, number: int, n: int, before: int) -> tuple[np.ndarray, ...]:
        """(shard, source, number of the slot in it) of the `n` slots drawn for `number` in `shard`."""
        slot = np.arange(before, before + n)
        owner = np.full(n, number)
        extra = slot >= wanted[number]
        rank = surplus_before[number] + slot[extra] - wanted[number]
        owner[extra] = np.searchsorted(lacking_until, rank, "right")
        heir = owner[extra]
        slot[extra] = wanted[heir] - (lacking_until[heir] - rank)
        return np.full(n, shard), owner, slot

    def filled(parts: list[tuple[np.ndarray, ...]]) -> pd.DataFrame:
        shard, owner, slot = (np.concatenate(column) for column in zip(*parts, strict=True))
        turn, block, take = np.empty_like(slot), np.empty_like(slot), np.empty_like(slot)
        by_owner = np.argsort(owner, kind="stable")
        for mine in np.split(by_owner, np.flatnonzero(np.diff(owner[by_owner])) + 1):
            source, own = sources[owner[mine[0]]], slot[mine]
            turns, index = np.divmod(own, source.blocks)
            blocks = np.empty_like(own)
            for t in np.unique(turns):
                blocks[turns == t] = permuted(index[turns == t], source.blocks, source.key(int(t)))
            turn[mine], block[mine] = turns, blocks
            take[mine] = np.where(own == source.slots - 1, source.last_take, source.block)
        place = mixed(slot.astype(np.uint64) * np.uint64(len(sources)) + owner.astype(np.uint64)).view(np.int64)
        return pd.DataFrame(
            {"shard": shard, "place": place, "number": owner, "block": block, "turn": turn, "take": take}
        )

    def fill(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        parts, held = [], 0
        for frame in frames:
            for row in frame[["shard", "number", "drawn", "before"]].itertuples(index=False):
                parts.append(owners(*row))
                held += row.drawn
                if held >= FILL_SHARDS * SHARD_SLOTS:
                    yield filled(parts)
                    parts, held = [], 0
        if parts:
            yield filled(parts)

    # a small row becomes up to `shard_slots` slots, so the number of tasks goes by slots and not by bytes
    lanes = max(1, math.ceil(shards / FILL_SHARDS))
    before = _with_before(drawn, "shard", "drawn").repartition(lanes, "shard")
    slots = before.mapInPandas(fill, "shard long, place long, number int, block long, turn long, take long")
    return written(slots, "slots")  # many more rows than the plan can know, which would broadcast them


@dataclass(frozen=True)
class Mixture:
    """`sizes`: row, doc_id, source, size, number; `parts`: documents' parts in blocks; `slots`: the mixture."""

    sizes: DataFrame
    parts: DataFrame
    slots: DataFrame
    sources: DataFrame

    @property
    def takes(self) -> DataFrame:
        """Parts of documents in the mixture: row, shard, place, turn, at (words of the document before), words."""
        words = F.least("hi", "take") - F.col("lo")
        return (
            self.parts.join(self.slots, ["number", "block"])
            .select("row", "shard", "place", "turn", "at", words.alias("words"))
            .where("words > 0")
        )


def _mixture(docs, keys, id_col, text_col, source_col, weights, block, shard_slots) -> Mixture:
    limit_batches(docs)
    sizes = written(_sizes(docs, keys, id_col, text_col, source_col), "sizes")
    spark = docs.sparkSession
    sources = plan(sizes, weights, block)
    table = spark.createDataFrame(
        [(s.name, s.number, s.words, s.target) for s in sources],
        "source string, number int, source_size long, target double",
    )
    numbered = sizes.join(
        F.broadcast(table.select(F.col("source").alias("_source"), "number")),  # at most MOST_SOURCES rows
        F.col("source").eqNullSafe(F.col("_source")),
    ).drop("_source")
    parts = _placed(numbered, block, sizes.count())
    return Mixture(numbered, parts, _slots(spark, sources, shard_slots), table)


def mix(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    weights: tuple[float, ...] = WEIGHTS,
    block: int = BLOCK_WORDS,
    shard_slots: int = SHARD_SLOTS,
) -> DataFrame:
    """doc_id, size, source_size, target and taken of every row of `docs`.

    The sources share SHARE of all words by weight, none more than LIMIT times its own. A null text has no
    words and a null source is a source, the last one. Of a row no word is taken more than LIMIT times. Rows
    that repeat are rows of their own. An empty table gives no rows; other columns are not read.
    """
    mixture = _mixture(docs, [], id_col, text_col, source_col, weights, block, shard_slots)
    taken = mixture.takes.groupBy("row").agg(F.sum("words").alias("taken"))
    known = F.broadcast(mixture.sources.select("number", "source_size", "target"))
    return (
        mixture.sizes.join(known, "number")
        .join(taken, "row", "left")
        .select("doc_id", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).alias("taken"))
    )


def mixed_documents(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    weights: tuple[float, ...] = WEIGHTS,
    block: int = BLOCK_WORDS,
    shard_slots: int = SHARD_SLOTS,
) -> DataFrame:
    """The mixture as documents: for each row and pass over its source, the row with the words taken in that pass.

    A text taken whole is as it was; of others the taken stretches stand on lines of their own. A column n_chars
    follows the text, all other columns are as they were. Rows of which nothing is taken go.
    """
    key, salted, passing = free_names(docs, "_key", "_salted", "_pass")
    every = [F.col(f"`{c}`") for c in docs.columns]
    keys = [k.alias(name) for k, name in zip(row_keys(docs), (key, salted), strict=True)]
    mixture = _mixture(docs, keys, id_col, text_col, source_col, weights, block, shard_slots)
    stretches = mixture.takes.groupBy("row", "turn").agg(
        F.sort_array(F.collect_list(F.struct("at", "words"))).alias("stretches"), F.sum("words").alias("words")
    )
    whole = F.col("words") == F.col("size")
    passes = (
        stretches.join(mixture.sizes, "row")
        .select(key, salted, "row", "turn", F.when(~whole, F.col("stretches")).alias("stretches"))
        .groupBy(key, salted)
        .agg(F.collect_list(F.struct("row", "turn", "stretches")).alias(passing))
    )

    joined = docs.select("*", *keys).join(passes, [key, salted]).dropDuplicates([key, salted])
    passes_of = joined.select(*every, F.explode(passing).alias(passing)).select(*every, F.col(f"{passing}.stretches"))
    names = docs.columns
    at = names.index(text_col)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            named = batch.rename_columns([f"{i}" for i in range(batch.num_columns)])
            for part in text_slices(named, f"{at}"):
                columns = part.columns
                stretches = columns.pop().to_pylist()
                partly = [i for i, s in enumerate(stretches) if s is not None]
                texts = columns[at].take(pa.array(partly, pa.int64())).to_pylist()
                new = dict(zip(partly, (_cut(t, stretches[i]) for i, t in zip(partly, texts, strict=True)), strict=True))
                mask = pa.array([i in new for i in range(len(part))])
                replaced = pa.array(list(new.values()), columns[at].type)
                columns[at] = pc.replace_with_mask(columns[at], mask, replaced)
                yield pa.RecordBatch.from_arrays(columns, names)

    out = passes_of.mapInArrow(cut, docs.schema)
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.length(text_col).cast(docs.schema["n_chars"].dataType))
    return out.select(*docs.columns)


def _cut(text: str, stretches: list[dict]) -> str:
    """The words of `text` in the given stretches; those that adjoin are one."""
    bounds = [m.span() for m in re.finditer(WORD, text)]
    joined: list[list[int]] = []
    for part in stretches:
        at, end = part["at"], part["at"] + part["words"]
        if joined and joined[-1][1] == at:
            joined[-1][1] = end
        else:
            joined.append([at, end])
    return "\n".join(text[bounds[a][0] : bounds[b - 1][1]] for a, b in joined)
