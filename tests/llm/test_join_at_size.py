"""Operator 9 where n-grams and clusters outgrow what one table or task holds."""

import math
import random

import numpy as np
import pytest

import corpus_pipeline
from dialoom.llm import ngram_join


def spy(monkeypatch, name, seen):
    real = getattr(ngram_join, name)

    def run(*args):
        seen.append(args)
        return real(*args)

    monkeypatch.setattr(ngram_join, name, run)


def test_ngrams_of_one_text_are_no_prefixes_however_many_share_a_slot(spark, monkeypatch):
    monkeypatch.setattr(ngram_join, "SLOT_BITS", 8)  # some hundred n-grams share one
    rows = [(i, " ".join(f"w{i}-{k}" for k in range(200))) for i in range(100)]
    df = spark.createDataFrame([*rows, (100, rows[0][1] + " more")], "doc_id long, text string")
    seen = []
    spy(monkeypatch, "_clusters", seen)
    got = {r.doc_id: r.component_id for r in ngram_join.jaccard_components(df).collect()}
    assert got == {i: i % 100 for i in range(101)}
    assert seen[0][0].select("gram").distinct().count() < 200  # of 2,000 in the prefixes of all


def test_the_stage_of_the_pipeline_sends_no_ngrams_of_one_text_out(spark, monkeypatch):
    monkeypatch.setattr(ngram_join, "SLOT_BITS", 8)
    rows = [(i, " ".join(f"w{i}-{k}" for k in range(200)), "en") for i in range(100)]
    rows += [(100, rows[0][1] + " some more words", "de"), (101, None, "en"), (102, None, "fr")]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    seen = []
    spy(monkeypatch, "_clusters", seen)
    kept = corpus_pipeline.ngram_jaccard_join(spark, df, "")
    assert sorted(map(tuple, kept.collect())) == sorted(rows[:100] + rows[101:])
    assert seen[0][0].select("gram").distinct().count() < 400  # of 4,000 in the prefixes of all


def test_a_chain_of_texts_that_do_not_link_is_parted(spark, monkeypatch):
    monkeypatch.setattr(ngram_join, "CELL_NGRAMS", 1000)
    words = [" ".join(f"w{i}-{k}" for k in range(60)) for i in range(81)]
    rows = [(i, f"{words[i]} {words[i + 1]}") for i in range(80)] + [(90, f"{words[7]} {words[8]} more")]
    seen = []
    spy(monkeypatch, "_verified", seen)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r.component_id for r in ngram_join.jaccard_components(df).collect()}
    assert got == {**{i: i for i in range(80)}, 90: 7}
    assert seen[0][1].groupBy("label").count().agg({"count": "max"}).first()[0] < 10


@pytest.mark.parametrize("percent", [80, 90])
def test_linked_sets_have_a_part_in_common(percent):
    rnd = np.random.default_rng(percent)
    width = ngram_join._step_width(percent)
    for _ in range(3000):
        n = int(2 ** rnd.uniform(0, 10))
        m = rnd.integers(math.ceil(n * percent / 100), n + 1)
        both = min(m, math.ceil(percent * (n + m) / (100 + percent)))
        if not ngram_join.linked(both, n, m, percent):
            continue
        grams = rnd.integers(0, 2**64, n + m - both, dtype=np.uint64)
        found = []
        for one in (grams[:n], np.concatenate([grams[:both], grams[n:]])):
            step = math.floor(math.log(len(one)) / math.log(width))
            keys = [ngram_join.part_keys(np.sort(one), np.array([0, len(one)]), np.array([5]), np.array([step + k]), percent) for k in (0, 1)]
            found.append({int(x) for k in keys for x in k[0]})
        assert found[0] & found[1], (n, m, both)


def test_few_random_sets_take_the_key_of_sets_with_many_empty_parts():
    rnd = random.Random(1)
    for percent in (80, 90):
        for size in (20, 100, 1000):
            offsets = np.arange(201) * size
            grams = np.array([rnd.getrandbits(64) for _ in range(offsets[-1])], np.uint64)
            step = np.full(200, math.floor(math.log(size) / math.log(ngram_join._step_width(percent))))
            keys, _ = ngram_join.part_keys(grams, offsets, np.zeros(200), step, percent)
            assert len(keys) - len(np.unique(keys)) < 10
