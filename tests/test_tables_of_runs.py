import collections
import os
import random
import subprocess
import sys

import pytest
from pyspark.sql import functions as F

from dialoom.functions.text import append_eos, render_pair
from dialoom.operators import ordered, packing, prepare
from dialoom.plans import jobs, queries
from dialoom.session import work_path
from dialoom.sources import files


def test_a_run_written_again_replaces_itself_alone(spark):
    row = "model string, variant string, task string, doc_id long, repeat_no long, question string, answer string, response string"

    def run(variant, response):
        return spark.createDataFrame([("m", variant, "t", i, 0, "q", "a", response) for i in range(3)], row)

    root = work_path(spark, "test_runs")
    for variant, response in [("base", "old"), ("fine_tune", "kept"), ("base", "new")]:
        files.write_samples(run(variant, response), root)
    found = collections.Counter((r.variant, r.response) for r in files.read_samples(spark, root).collect())
    assert found == {("base", "new"): 3, ("fine_tune", "kept"): 3}


@pytest.mark.parametrize("a_task", [1, 3, 10_000])
def test_texts_for_a_table_of_configs(spark, monkeypatch, a_task):
    monkeypatch.setattr(prepare, "CONFIGS_A_TASK", a_task)
    settings = [{"model_family": "qwen-2.5"}, {"model_family": "mistral", "format_with_eos_token": "True"}, {"x": "y"},
                {"model_family": "qwen-2.5", "format_with_eos_token": "true"}, {"model_family": "none"}, {},
                {"model_family": "qwen-2.5", "format_with_eos_token": None}, {"model_family": "qwen-2.5"}]
    configs = spark.createDataFrame([(f"c{i}", s) for i, s in enumerate(settings)], "config string, settings map<string,string>")
    pairs = spark.createDataFrame([(i, 0, f"u{i}", f"a{i}") for i in range(4)], "conv_id long, turn long, user string, assistant string")
    ends = {"qwen-2.5": "<E>", "mistral": "<M>"}
    found = prepare.per_config_table(pairs, configs, ends)
    assert found.columns == ["conv_id", "turn", "config", "text"]
    expected = set()
    for i, s in enumerate(settings):
        if s.get("model_family") in ends:
            text = render_pair(F.col("user"), F.col("assistant"), s["model_family"])
            text = append_eos(text, ends[s["model_family"]]) if (s.get("format_with_eos_token") or "").lower() == "true" else text
            expected |= {(r.conv_id, 0, f"c{i}", r.t) for r in pairs.select("conv_id", text.alias("t")).collect()}
    assert sorted(map(tuple, found.collect())) == sorted(expected)
    assert prepare.per_config_table(pairs, configs.limit(0), ends).collect() == []


@pytest.mark.parametrize("n", [0, 300])
def test_sums_by_config_make_a_text_once_for_each_class_of_configs(spark, monkeypatch, n):
    kinds = [{"model_family": f} for f in ("qwen-2.5", "mistral", "none")] + [{}, None]
    kinds += [{"model_family": f, "format_with_eos_token": e} for f in ("qwen-2.5", "phi-4") for e in ("TRUE", "no", None)]
    rows = [(f"c{i // 2}" if i % 10 else None, kinds[i % len(kinds)]) for i in range(n)]  # names repeat
    configs = spark.createDataFrame(rows, "config string, settings map<string,string>")
    pairs = spark.createDataFrame([(i, 0, "u" * i if i else None, f"a{i}") for i in range(5)], "conv_id long, turn long, user string, assistant string")
    monkeypatch.setattr(queries.inputs, "pairs", lambda *_: pairs)
    monkeypatch.setattr(queries.inputs, "configs", lambda *_: configs)
    made, whole = [], prepare.per_config_table

    def spied(*args):
        made.append(whole(*args))
        return made[-1]

    monkeypatch.setattr(prepare, "per_config_table", spied)
    found = queries.QUERIES["config_texts"](spark, "").collect()
    ends = {name: t.assistant_close.strip() for name, t in queries.TEMPLATES.items()}
    sums = F.count("*").alias("texts"), F.sum(F.length("text")).alias("chars"), F.max("text").alias("last_text")
    expected = whole(pairs, configs, ends).groupBy("config").agg(*sums).collect()
    assert found[:1] == [] or found[0].asDict().keys() == expected[0].asDict().keys()
    assert sorted(map(repr, found)) == sorted(map(repr, expected)) and bool(found) == bool(n)
    assert made[0].count() == (5 * 5 if n else 0)  # five classes, however many configs


@pytest.mark.parametrize("share", [0.0, 0.1, 0.25, 0.5, 1.0])
def test_a_split_has_exactly_its_share_of_keys(spark, share):
    rows = [(k, i) for k in range(203) for i in range(k % 4 + 1)] + [(None, 0)] * 3
    df = spark.createDataFrame(rows, "k long, i int").repartition(3)
    sides = collections.defaultdict(set)
    for r in prepare.exact_split(df, "k", share, "s").collect():
        sides[r.split].add(r.k)
    assert not sides["test"] & sides["train"] and len(sides["test"]) == int(share * 204 + 0.5)
    again = prepare.exact_split(df, "k", share, "s").where("split = 'test'").select("k").distinct().count()
    assert again == len(sides["test"])
    assert prepare.exact_split(df.limit(0), "k", share).collect() == []


def test_keys_of_one_hash_are_split_too(spark, monkeypatch):
    monkeypatch.setattr(prepare, "key_hash", lambda key, seed="": F.lit(7).cast("bigint") + F.length(key.cast("string")) * 0)
    df = spark.createDataFrame([(k,) for k in range(10)], "k long")
    found = sorted(r.k for r in prepare.exact_split(df, "k", 0.3).where("split = 'test'").collect())
    assert found == [0, 1, 2]


@pytest.mark.parametrize("ranges", ["1", "4", "30"])
def test_as_of_takes_the_latest_row_up_to_each(spark, ranges):
    rnd = random.Random(5)
    left = [(rnd.choice([1, 1, 1, 2, None]), rnd.randrange(60), i) for i in range(150)]
    right = [(rnd.choice([1, 1, 2, 3, None]), rnd.randrange(60), f"v{i}") for i in range(60)]
    spark.conf.set("spark.sql.shuffle.partitions", ranges)
    try:
        found = ordered.as_of(
            spark.createDataFrame(left, "k int, t int, id int"), spark.createDataFrame(right, "k int, t int, v string"), "k", "t"
        ).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    expected = []
    for k, t, i in left:
        best = max(((rt, v) for rk, rt, v in right if k is not None and rk == k and rt <= t), default=(None, None))
        expected.append((k, t, i, best[1]))
    got = [(r.k, r.t, r.id, r.matched.v if r.matched else None) for r in found]
    assert sorted(got, key=repr) == sorted(expected, key=repr)


def test_lengths_grouped_as_trainers_do(spark):
    rnd = random.Random(6)
    rows = [(i, rnd.randrange(20)) for i in range(101)]
    df = spark.createDataFrame(rows, "k long, n long").repartition(3)
    found = sorted(packing.group_by_length(df, ["k"], size=2, seed="a", megabatch=5).collect(), key=lambda r: r.position)
    assert [r.position for r in found] == list(range(101)) and [r.batch for r in found] == [i // 2 for i in range(101)]
    assert found[0].n == max(n for _, n in rows) and {(r.k, r.n) for r in found} == set(rows)
    for at in range(10, 101, 10):  # all but the row that changed places
        lengths = [r.n for r in found[at + 1 : at + 10]]
        assert lengths == sorted(lengths, reverse=True)
    again = packing.group_by_length(df.repartition(5), ["k"], size=2, seed="a", megabatch=5).collect()
    other = packing.group_by_length(df, ["k"], size=2, seed="b", megabatch=5).collect()
    assert set(map(tuple, again)) == set(map(tuple, found)) != set(map(tuple, other))


def test_metrics_of_raw_responses(spark):
    said = ["a b c", "d", "", "e f", "g h i j", "k"]
    rows = [("qwen-2.5", f"<|im_start|>assistant\n{s}<|im_end|>") for s in said] + [("qwen-2.5", "nothing"), ("qwen-2.5", None)]
    rows += [("mistral", "unread")]
    found = {r.model_family: r for r in jobs.response_metrics(spark.createDataFrame(rows, "model_family string, text string")).collect()}
    r = found["qwen-2.5"]
    assert (r.responses, r.extraction_rate, r.empty, r.min_tokens, r.median_tokens, r.p95_tokens, r.max_tokens) == (8, 5 / 8, 1, 1, 2, 4, 4)
    assert found["mistral"].extraction_rate == 0 and found["mistral"].median_tokens is None


@pytest.mark.parametrize("missing", ["dialoom.llm", "tokenizers", "corpus_pipeline"])
def test_other_queries_do_not_need_what_the_corpus_operators_need(missing):
    code = f"import sys; sys.modules['{missing}'] = None; import __spark_entry__ as e; print('NAMES', *e.queries())"
    said = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, cwd=os.path.dirname(os.path.dirname(os.path.abspath(__file__))), timeout=120)
    assert "NAMES" in said.stdout and "sft_text" in said.stdout, said.stderr[-2000:]
