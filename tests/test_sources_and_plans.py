import pytest
from compare import plan
from pyspark.sql import functions as F

from dialoom.plans import inputs, jobs
from dialoom.plans.queries import QUERIES
from dialoom.session import work_path
from dialoom.sources import files

SF = "/root/testdata/sf0.001"


def test_bad_lines_fail(spark):
    folder = work_path(spark, "bad")
    spark.createDataFrame([('{"user": "u", "assistant": "a", "id": "7"}',), ("{broken",)], "value string").write.text(folder)
    with pytest.raises(Exception):
        files.read_pairs(spark, folder).collect()
    good = work_path(spark, "good")
    spark.createDataFrame([('{"user": "u", "assistant": "a", "id": "7"}',)], "value string").write.text(good)
    from pyspark.sql import types as T

    extra = T.StructType([T.StructField("id", T.StringType())])
    assert tuple(files.read_pairs(spark, good, extra).first()) == ("u", "a", "7")
    assert tuple(files.read_pairs(spark, good).first()) == ("u", "a")


def test_prepared_folder(spark):
    text = spark.createDataFrame([("x",)], "text string")
    root = work_path(spark, "outputs")
    assert files.write_prepared(text, root, "phi-4") == f"{root}/phi-4"
    assert files.write_prepared(text, root, "phi-4", f"{root}/own") == f"{root}/own"
    assert spark.read.json(f"{root}/own").first().text == "x"


def test_sample_filters_prune_folders(spark):
    samples = inputs.samples(inputs.orders(spark, SF))
    root = files.write_samples(samples, work_path(spark, "samples"))
    read = files.read_samples(spark, root).where(F.col("variant") == "base")
    assert "PartitionFilters: [isnotnull(variant" in plan(read)
    assert read.count() == samples.where("variant = 'base'").count()


def test_reads_are_pruned_and_pushed_down(spark):
    pairs = plan(QUERIES["turn_pairs"](spark, SF))
    assert "GreaterThanOrEqual(turn,512)" in pairs
    counts = plan(QUERIES["exact_match_mean"](spark, SF))
    assert "ReadSchema: struct<o_orderkey:bigint,o_custkey:bigint>" in counts


def test_family_join_is_a_broadcast(spark):
    text = plan(QUERIES["family_lookup"](spark, SF))
    assert "BroadcastHashJoin" in text and "SortMergeJoin" not in text


def test_one_shuffle_of_marks_and_no_texts(spark):
    text = plan(jobs.compare_all(inputs.samples(inputs.table(spark, SF, "orders"))))
    assert text.count("Arguments: hashpartitioning") == 2 and "SortAggregate" not in text
    exchanged = [part.split("\n")[1] for part in text.split("\n(") if ") Exchange\n" in part]
    assert len(exchanged) == 2 and not any("response" in line or "answer" in line for line in exchanged)
