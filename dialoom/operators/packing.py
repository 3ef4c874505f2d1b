"""Token counts, packing into blocks, batches and length order."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dialoom.functions.text import token_count
from dialoom.operators.ordered import in_ranges, part_of
from dialoom.operators.prepare import key_hash

# Sequence limit and batch size of the default run.
SEQUENCE_LIMIT = 2048
BATCH_SIZE = 4


def with_token_count(df: DataFrame, text: str = "text") -> DataFrame:
    """Adds `n`, the number of whitespace-separated tokens."""
    return df.withColumn("n", token_count(F.col(text)))


def turn_shard(conversations: int = 64) -> Column:
    """Shard of a turn row: a range of conversation ids times a part of the conversation.

    Its size is bounded by the ranges and the number of shards grows with the data.
    """
    return F.concat_ws("-", F.floor(F.col("conv_id") / conversations), part_of(F.col("turn")))


def truncate_tokens(tokens: Column, limit: int = SEQUENCE_LIMIT) -> Column:
    """The first `limit` tokens."""
    return F.slice(tokens, 1, limit)


def _cut(df: DataFrame, block: int) -> DataFrame:
    """First and last block touched by the token range that ends at `end_token`."""
    first = F.floor((F.col("end_token") - F.col("n")) / block)
    last = F.floor((F.col("end_token") - 1) / block)
    return df.withColumn("first_block", first).withColumn("last_block", F.greatest(first, last))


def pack_wrapped(df: DataFrame, block: int, shard: str, order: list[str]) -> DataFrame:
    """Rows of each shard laid end to end by `order` and cut every `block` tokens.

    Shards should be ranges of bounded size, as `turn_shard` makes them: a shard is packed by one task.
    """
    so_far = Window.partitionBy(shard).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    return _cut(df.withColumn("end_token", F.sum("n").over(so_far)), block)


def pack_wrapped_global(df: DataFrame, block: int, order: list[str], partitions: int | None = None) -> DataFrame:
    """The same in one exact order over all rows, without a window over all rows.

    The (key, n) table is written in ranges of the order (`in_ranges`), whose totals, one row each, give the
    offsets. Range bounds include the whole key, so a hot leading key is split as well. Lengths are computed
    once, before the ranges are drawn.
    """
    ranged = in_ranges(df.select(*order, "n"), order, partitions)
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        ranged.groupBy("_range")
        .agg(F.sum("n").alias("_sum"))
        .select("_range", F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_offset"))
    )
    so_far = Window.partitionBy("_range").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    local = ranged.withColumn("_local", F.sum("n").over(so_far))
    placed = local.join(offsets, "_range").withColumn("end_token", F.col("_local") + F.col("_offset"))
    return _cut(placed.select(*order, "n", "end_token"), block)


def pack_stats(packed: DataFrame, block: int, shard: str) -> DataFrame:
    """Blocks, tokens, fill ratio and cut sequences over all shards."""
    per_shard = packed.groupBy(shard).agg(
        (F.max("last_block") + 1).alias("_blocks"),
        F.sum("n").alias("_tokens"),
        F.count_if(F.col("last_block") > F.col("first_block")).alias("_cut"),
        F.count("*").alias("_rows"),
    )
    return per_shard.agg(
        F.sum("_rows").alias("sequences"),
        F.sum("_blocks").alias("blocks"),
        F.sum("_tokens").alias("tokens"),
        F.sum("_cut").alias("cut_sequences"),
        (F.sum("_tokens") / (F.sum("_blocks") * block)).alias("fill_ratio"),
    )


def batch_ids(df: DataFrame, size: int, shard: str, order: list[str], by_length: bool = False) -> DataFrame:
    """Adds `batch`, the batch number inside the shard, plain or with like lengths together."""
    by = [F.col("n").desc()] if by_length else []
    rank = F.row_number().over(Window.partitionBy(shard).orderBy(*by, *order))
    return df.withColumn("batch", F.floor((rank - 1) / size))


def padding_waste(batched: DataFrame, shard: str) -> DataFrame:
    """Padded cells minus real tokens of each batch."""
    return batched.groupBy(shard, "batch").agg(
        F.count("*").alias("rows"),
        F.max("n").alias("width"),
        (F.max("n") * F.count("*") - F.sum("n")).alias("waste"),
    )


def length_order(df: DataFrame, order: list[str], partitions: int | None = None) -> DataFrame:
    """`position` of each row, from 0, with the longest rows first.

    Keys and lengths alone are put in ranges, which are written once; the key in the bounds splits a crowded
    length. Numbers inside a range and the sizes of earlier ranges, one row each, make the position.
    """
    negative = F.col("n") * -1
    ranged = in_ranges(df.select(*order, "n", negative.alias("_minus")), ["_minus", *order], partitions)
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    sizes = ranged.groupBy("_range").agg(F.count("*").alias("_rows"))
    offsets = sizes.select("_range", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_offset"))
    inside = F.row_number().over(Window.partitionBy("_range").orderBy("_minus", *order))
    placed = ranged.withColumn("_local", inside).join(offsets, "_range")
    return placed.select(*order, "n", (F.col("_offset") + F.col("_local") - 1).alias("position"))


MEGABATCH = 50  # batches in which lengths are grouped, a fixed value


def group_by_length(
    df: DataFrame, order: list[str], size: int = BATCH_SIZE, seed: str = "0", megabatch: int = MEGABATCH
) -> DataFrame:
    """`position` and `batch` of each row (`order` is its key, `n` its length) as trainers group by length.

    Rows are put in a pseudorandom order, which the seed alone decides, and cut into megabatches of `megabatch`
    batches; each is sorted by length, longest first. The first row of all is then the longest one: it changes
    places with the first row of its megabatch. Only keys and lengths are moved; the order is that of ranges
    written once, and a megabatch is sorted by one task.
    """
    hashed = key_hash(F.concat_ws(":", *order), seed)
    ranged = in_ranges(df.select(*order, "n", hashed.alias("_hash")), ["_hash", *order])
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    sizes = ranged.groupBy("_range").agg(F.count("*").alias("_rows"))
    offsets = sizes.select("_range", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_offset"))
    inside = F.row_number().over(Window.partitionBy("_range").orderBy("_hash", *order))
    drawn = ranged.withColumn("_local", inside).join(offsets, "_range")
    mega = F.floor((F.col("_offset") + F.col("_local") - 1) / (size * megabatch))
    by_length = Window.partitionBy("_mega").orderBy(F.desc("n"), "_hash", *order)
    sorted_ = drawn.withColumn("_mega", mega).withColumn("_at", F.row_number().over(by_length) - 1)
    longest = drawn.select(mega.alias("_mega"), "n").agg(F.max_by("_mega", F.struct("n", -F.col("_mega"))))
    first = F.lit(longest.first()[0] or 0)  # one number: the megabatch with the longest row
    place = F.col("_mega") * size * megabatch + F.col("_at")
    swapped = (
        F.when((F.col("_at") == 0) & (F.col("_mega") == first), 0)
        .when((F.col("_at") == 0) & (F.col("_mega") == 0), first * size * megabatch)
        .otherwise(place)
    )
    placed = sorted_.withColumn("position", swapped.cast("bigint"))
    return placed.select(*order, "n", "position", F.floor(F.col("position") / size).alias("batch"))


def length_profile(df: DataFrame, by: list[str], limit: int = SEQUENCE_LIMIT) -> DataFrame:
    """Length statistics of `n` and what a limit would cut. The percentiles keep one counter per length."""
    over = F.col("n") > limit
    return df.groupBy(*by).agg(
        F.count("*").alias("rows"),
        F.min("n").alias("min_n"),
        F.max("n").alias("max_n"),
        (F.sum("n") / F.count("*")).alias("mean_n"),
        F.percentile("n", 0.5).alias("median_n"),
        F.percentile("n", 0.95).alias("p95_n"),
        (F.count_if(over) / F.count("*")).alias("over_share"),
        F.sum(F.greatest(F.col("n") - limit, F.lit(0))).alias("tokens_lost"),
    )
