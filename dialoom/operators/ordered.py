"""Running values and neighbours over keyed, ordered rows, without one task per key.

A window over the bare key would put a whole key into one task, however large it is. Here each key is cut into
blocks: ranges of turn numbers, which are a function of the row, or the ranges of an order over all rows, which
are written down once. The window runs inside a block; one small row per block carries the totals; a window over
those rows gives each block its start; the start is joined back on (key, block). Only the local window moves the
wide rows, and the join reuses its partitioning. Recomputing a lost partition gives the same rows.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dialoom.session import work_path

TURNS_PER_PART = 512


class Running(NamedTuple):
    """`kind` is sum, max or last (the last non-null value so far)."""

    name: str
    kind: str
    value: Column


def part_of(turn: Column, size: int | None = None) -> Column:
    """Part of a conversation that a turn belongs to; at most `size` turns, as turns are numbered from 0."""
    return F.floor(F.greatest(turn, F.lit(0)) / (size or TURNS_PER_PART))


def in_ranges(df: DataFrame, order: list[str], ranges: int | None = None) -> DataFrame:
    """`df` with `_range`, the number of the range it falls into when all rows are put in `order`.

    The ranges are of like size, by default as many as there are shuffle partitions, so a key with most of the
    rows has most of the ranges. They are written once, as the bounds are drawn from a sample and must not change.
    """
    path = work_path(df.sparkSession, "ranges")
    ranges = ranges or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    df.repartitionByRange(ranges, *order).withColumn("_range", F.spark_partition_id()).write.parquet(path)
    schema = T.StructType([*df.schema.fields, T.StructField("_range", T.IntegerType())])
    return df.sparkSession.read.schema(schema).parquet(path)


def written(df: DataFrame, name: str) -> DataFrame:
    """`df` computed once into the shared folder, and read back from there."""
    path = work_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def with_running(
    df: DataFrame,
    keys: list[str],
    block: Column,
    order: list[str],
    values: list[Running],
) -> DataFrame:
    """Running values per key in the given order, each including its own row. Blocks follow the order."""
    blocked = df.withColumn("_block", block)
    for i, v in enumerate(values):
        blocked = blocked.withColumn(f"_in{i}", v.value)

    inside = Window.partitionBy(*keys, "_block").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    before = Window.partitionBy(*keys).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    position = F.struct(*order)

    local, total, start, combined = [], [], [], []
    for i, v in enumerate(values):
        source = F.col(f"_in{i}")
        if v.kind == "sum":
            local.append(F.sum(source).over(inside))
            total.append(F.sum(source))
            start.append(F.sum(f"_all{i}").over(before))
            combined.append(F.coalesce(F.col(f"_run{i}"), F.lit(0)) + F.coalesce(F.col(f"_at{i}"), F.lit(0)))
        elif v.kind == "max":
            local.append(F.max(source).over(inside))
            total.append(F.max(source))
            start.append(F.max(f"_all{i}").over(before))
            combined.append(F.greatest(f"_run{i}", f"_at{i}"))
        elif v.kind == "last":
            local.append(F.last(source, ignorenulls=True).over(inside))
            total.append(F.max_by(source, F.when(source.isNotNull(), position)))
            start.append(F.last(f"_all{i}", ignorenulls=True).over(before))
            combined.append(F.coalesce(f"_run{i}", f"_at{i}"))
        else:
            raise ValueError(f"unknown kind: {v.kind}")

    n = range(len(values))
    rows = blocked.select(*df.columns, "_block", *[local[i].alias(f"_run{i}") for i in n])
    totals = blocked.groupBy(*keys, "_block").agg(*[total[i].alias(f"_all{i}") for i in n])
    starts = totals.select(*keys, "_block", *[start[i].alias(f"_at{i}") for i in n])
    return rows.join(starts, [*keys, "_block"], "left").select(
        *df.columns, *[combined[i].alias(values[i].name) for i in n]
    )


def as_of(left: DataFrame, right: DataFrame, by: str, on: str) -> DataFrame:
    """`left` with `matched`, the columns of the row of `right` with the same `by` and the greatest `on` up to its own.

    Null where there is none, as for a null key. Of rows of `right` with the same `by` and `on` the greatest counts. Both tables are
    put in one order of ranges and the last row of `right` is carried along, so that a key with most of the rows
    is several tasks and no row meets more than one other.
    """
    own = F.struct(*[c for c in left.columns if c not in (by, on)]).alias("_own")
    value = F.struct(*[c for c in right.columns if c not in (by, on)]).alias("_value")
    lefts = left.select(by, on, F.lit(1).alias("_side"), own)
    rights = right.where(F.col(by).isNotNull() & F.col(on).isNotNull()).select(by, on, F.lit(0).alias("_side"), value)
    ranged = in_ranges(lefts.unionByName(rights, allowMissingColumns=True), [by, on])
    carried = with_running(ranged, [by], F.col("_range"), [on, "_side", "_value"], [Running("matched", "last", F.col("_value"))])
    return carried.where(F.col("_side") == 1).select(by, on, "_own.*", "matched")


def with_next(df: DataFrame, key: str, order: str, columns: list[str], size: int | None = None) -> DataFrame:
    """Adds `next_<column>` from the following row of the key for each of `columns`, null on its last row.

    Only rows from number `size` on can start a later part, so for ordinary keys the second read of `df` is a
    filter that the file statistics answer.
    """
    size = size or TURNS_PER_PART
    inside = Window.partitionBy(key, "_part").orderBy(order)
    rows = df.withColumn("_part", part_of(F.col(order), size)).select(
        "*",
        F.lead(order).over(inside).isNull().alias("_tail"),
        *[F.lead(c).over(inside).alias(f"_next_{c}") for c in columns],
    )
    heads = (
        df.where(F.col(order) >= size)
        .groupBy(key, part_of(F.col(order), size).alias("_own"))
        .agg(F.min_by(F.struct(*columns), order).alias("_head"))
    )
    previous = F.lag("_own", 1, 0).over(Window.partitionBy(key).orderBy("_own"))
    heads = heads.select(key, previous.alias("_part"), "_head")
    return rows.join(heads, [key, "_part"], "left").select(
        *df.columns,
        *[
            F.when(F.col("_tail"), F.col(f"_head.{c}")).otherwise(F.col(f"_next_{c}")).alias(f"next_{c}")
            for c in columns
        ],
    )
