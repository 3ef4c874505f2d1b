import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from dialoom.operators import packing as pk
from dialoom.operators import prepare as pp
from dialoom.operators import scoring as sc


@pytest.fixture(scope="module")
def rows(spark):
    random.seed(6)
    data = [(0 if i < 200 else i % 9, i, random.choice([0, 1, 5, 40, 300])) for i in range(600)]
    return spark.createDataFrame(data, "conv_id long, turn long, n long").repartition(5).cache()


def rows_of(df):
    return sorted(map(tuple, df.collect()))


def packed_plainly(rows, block):
    out, end = [], 0
    for conv, turn, n in sorted(map(tuple, rows)):
        end += n
        first = (end - n) // block
        out.append((conv, turn, n, end, first, max(first, (end - 1) // block)))
    return sorted(out)


@pytest.mark.parametrize("partitions", [None, 1, 7])
def test_global_packing(rows, partitions):
    found = pk.pack_wrapped_global(rows, 64, ["conv_id", "turn"], partitions)
    assert rows_of(found) == packed_plainly(rows.collect(), 64)


def test_shard_packing_and_stats(rows):
    sharded = rows.withColumn("shard", F.lit("only"))
    packed = pk.pack_wrapped(sharded, 64, "shard", ["conv_id", "turn"])
    expected = packed_plainly(rows.collect(), 64)
    assert rows_of(packed.drop("shard")) == expected
    stats = pk.pack_stats(packed, 64, "shard").first()
    assert stats.sequences == 600 and stats.blocks == expected[-1][5] + 1
    assert stats.cut_sequences == sum(r[5] > r[4] for r in expected)


def test_shards_are_bounded(spark):
    df = spark.range(5000).select(F.lit(7).alias("conv_id"), F.col("id").alias("turn"))
    sizes = df.groupBy(pk.turn_shard()).count().collect()
    assert max(r["count"] for r in sizes) <= 512 and sum(r["count"] for r in sizes) == 5000


def test_batches(rows):
    sharded = rows.withColumn("shard", F.lit("only"))
    plain = pk.padding_waste(pk.batch_ids(sharded, 4, "shard", ["conv_id", "turn"]), "shard")
    grouped = pk.padding_waste(pk.batch_ids(sharded, 4, "shard", ["conv_id", "turn"], True), "shard")
    total = [df.agg(F.sum("waste"), F.sum("rows")).first() for df in (plain, grouped)]
    assert total[1][0] < total[0][0] and total[0][1] == total[1][1] == 600


def test_length_order(rows):
    found = sorted(pk.length_order(rows, ["conv_id", "turn"], 4).collect(), key=lambda r: r.position)
    expected = sorted(map(tuple, rows.collect()), key=lambda r: (-r[2], r[0], r[1]))
    assert [tuple(r) for r in found] == [(*row, i) for i, row in enumerate(expected)]


def test_holdout_split(rows):
    split = pp.holdout_split(rows, F.concat_ws("-", "conv_id", "turn"), 0.1)
    assert 20 < split.where("split = 'test'").count() < 110
    assert rows_of(split) == rows_of(pp.holdout_split(rows.repartition(2), F.concat_ws("-", "conv_id", "turn"), 0.1))


def test_families(spark):
    df = spark.createDataFrame([("a", {"model_family": "phi-4"}), ("b", {"model_family": "none"}), ("c", {})],
                               "config string, settings map<string,string>")
    assert sorted(r.config for r in pp.family_rejects(df).collect()) == ["b", "c"]
    assert pp.require_family(df.where("config = 'a'")).first().model_family == "phi-4"
    with pytest.raises(Exception, match="unsupported or missing model family"):
        pp.require_family(df).collect()


def test_pairs_without_a_counterpart(spark):
    samples = spark.createDataFrame(
        [("m", "base", "t", 1, 0, "x #### 5", "5"), ("m", "base", "t", 1, 1, "x #### 5", "6"),
         ("m", "fine_tune", "t", 2, 0, "x #### 7", "<output>7</output>")],
        "model string, variant string, task string, doc_id long, repeat_no long, answer string, response string",
    )
    paired = {r.doc_id: (r.base_response, r.tuned_response) for r in sc.pair_runs(samples).collect()}
    assert paired == {1: ("5", None), 2: (None, "<output>7</output>")}
    flips = sc.flip_counts(sc.judge_runs(sc.score(samples))).first()
    assert (flips.both_right, flips.only_base, flips.only_tuned, flips.neither) == (0, 1, 1, 0)
    stacked = sc.union_runs([("a", "base", samples.drop("model", "variant")), ("b", "base", samples.drop("model", "variant"))])
    assert stacked.count() == 6
