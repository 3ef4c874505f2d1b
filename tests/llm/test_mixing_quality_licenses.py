"""Operators 5, 6 and 7, the pipeline, and the queries against DuckDB."""

import re
import zlib

import compare
import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from dialoom.llm import license_scan, mixing
from dialoom.llm.byte_bpe import Codec, read_ranks
from dialoom.llm.mixing import WORD, mix, mixed_documents, permuted, targets
from dialoom.llm.quality import keep_good, score_quality, statistics
from dialoom.llm.queries import ORACLE, QUERIES

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_its_twin(spark, name):
    assert compare.differences(compare.duck(SF), QUERIES[name](spark, SF), ORACLE[name]) is None


@pytest.mark.parametrize("n", [1, 2, 3, 7, 64, 100, 1000])
def test_permutations(n):
    images = permuted(np.arange(n), n, 5)
    assert sorted(images) == list(range(n))
    assert (permuted(images, n, 5, back=True) == np.arange(n)).all()


def test_targets_stop_at_the_limit_and_pass_the_rest_on():
    assert targets([100, 100, 100], [5, 2, 1]) == [200.0, pytest.approx(500 / 3), pytest.approx(250 / 3)]
    assert targets([10, 0, 1000], [5, 2, 1]) == [20.0, 0.0, pytest.approx(1495.0)]
    assert targets([], []) == []


def test_each_source_gets_its_target(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    got = mix(docs).collect()
    sources = {r.doc_id: r.source for r in docs.collect()}
    taken: dict = {}
    for r in got:
        taken.setdefault((sources[r.doc_id], r.target), []).append(r.taken)
        assert r.taken <= 2 * r.size
    assert all(abs(sum(t) - target) <= 0.5 for (_, target), t in taken.items())
    assert sorted(map(tuple, mix(docs).collect())) == sorted(map(tuple, got))


def test_mixed_documents_hold_the_words_taken(spark):
    rows = [(1, None, "a"), (2, "x y  z", "b"), (2, "x y  z", "b"), (3, "p q", None), (None, "q r\ns t", "a"), (4, "k " * 500, "c")]
    df = spark.createDataFrame([(*r, 0, len(r[1] or ""), "w") for r in rows], "doc_id long, text string, source string, row int, n_chars long, words string")
    marks = mix(df, block=2, shard_slots=3)
    out = mixed_documents(df, block=2, shard_slots=3)
    assert out.columns == df.columns

    def counts(frame, column):
        return {r.doc_id: r.n for r in frame.groupBy("doc_id").agg(F.sum(column).alias("n")).collect() if r.n}

    assert counts(out, F.regexp_count("text", F.lit(WORD))) == counts(marks, F.col("taken"))
    assert all(r.n_chars == len(r.text) for r in out.collect())
    assert mix(df.limit(0)).collect() == [] and mixed_documents(df.limit(0)).collect() == []
    nothing = df.where("doc_id = 1")
    assert [(r.size, r.taken) for r in mix(nothing).collect()] == [(0, 0)] and mixed_documents(nothing).collect() == []


@pytest.mark.parametrize("stretch", [2, 4096])
def test_words_taken_of_each_document(spark, monkeypatch, stretch):
    """Every slot of a source once, its block by the same permutation, words counted one by one."""
    monkeypatch.setattr(mixing, "STRETCH", stretch)
    monkeypatch.setattr(mixing, "LOT_ROWS", 40)
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text", "source")
    sizes = mixing._sizes(docs, [], "doc_id", "text", "source")
    rows = sizes.withColumn("hash", F.xxhash64("doc_id")).orderBy("row").collect()
    lots = -(-len(rows) // 40)
    expected = {r.doc_id: 0 for r in rows}
    for source in mixing.plan(sizes, mixing.WEIGHTS, 32):
        own = [r for r in rows if r.source == source.name]
        own.sort(key=lambda r: (r.hash % lots, r.doc_id))
        words = [r.doc_id for r in own for _ in range(r.size)]
        for slot in range(source.slots):
            turn, index = divmod(slot, source.blocks)
            block = int(permuted(np.array([index]), source.blocks, source.key(turn))[0])
            last = slot == source.slots - 1
            for doc in words[block * 32 : (block + 1) * 32][: source.last_take if last else None]:
                expected[doc] += 1
    got = mix(docs, block=32, shard_slots=16)
    assert {r.doc_id: r.taken for r in got.collect()} == expected


def words_of(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


BSD = "Redistribution and use in source and binary forms, with or without\n modification, are permitted"
MPL = "This Source Code Form is subject to the terms of the Mozilla Public\n# License, v. 2.0."
GPL = "This program is free software: you can redistribute it and/or modify\n * it under the terms of the GNU\n * Lesser"


@pytest.mark.parametrize("step", [5, 128])
def test_licenses_against_all_windows_and_templates(spark, monkeypatch, step):
    monkeypatch.setattr(license_scan, "STEP", step)
    texts = [
        None,
        "",
        " -- ",
        "Licensed under CC BY-NC 4.0.\nThe MIT\nLicense and the mit license",
        "GNU, General; Public (License) apache license Apache License",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of software",
        "Permission is hereby granted, to any person",
        "Éa all RIGHTS\xa0reserved. é",
        "rights reserved all\nall rights",
        "word " * 30_000 + "mit license",
        BSD,
        "x " * 120 + MPL,
        "y " * 250 + GPL + " General Public License " + BSD,
        "all " + "z " * 9 + "rights " + "z " * 9 + "reserved",  # scattered words are no notice
        "forms " * 40 + BSD.replace("and", "and also").replace("forms", ""),
        "\n".join(license_scan.TEMPLATES),
        "\n".join(license_scan.TEMPLATES),
    ]
    df = spark.createDataFrame([(i, t, "x", 1) for i, t in enumerate(texts)], "doc_id long, text string, words string, row int")
    got = {r.doc_id: r for r in license_scan.scan_licenses(df).collect()}
    for i, text in enumerate(texts):
        words = words_of(text)
        places, own = [], set()
        for phrase, label in license_scan.PHRASES.items():
            p = phrase.split()
            at = [k for k in range(len(words)) if words[k : k + len(p)] == p]
            places += at
            own |= {label} if at else set()
        found, score = set(), 0.0
        for template, label in license_scan.TEMPLATES.items():
            t, reach = set(template.split()), int(len(template.split()) / license_scan.CONTAINED + 1e-9)
            near = [k for k, w in enumerate(words) if w in t]
            share = max((len(t & set(words[k : k + reach])) / len(t) for k in near), default=0)
            if share >= license_scan.CONTAINED:
                found.add(label)
                score = max(score, share)
        r = got[i]
        assert (r.n_words, r.n_base) == (len(words), len(places))
        assert (r.first_word, r.last_word) == ((min(places), max(places)) if places else (None, None))
        assert (r.base_labels, r.labels) == (",".join(sorted(own)), ",".join(sorted(own | found)))
        assert r.score == pytest.approx(1.0 if places else score)
    assert [got[i].labels for i in (10, 11, 13)] == ["bsd", "mpl", ""]
    assert got[12].labels == "bsd,gpl" and got[15].labels == got[16].labels
    assert license_scan.scan_licenses(df.limit(0)).collect() == []


def test_quality_of_held_out_documents(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    got = {r.doc_id: r for r in score_quality(docs, labels).collect()}
    known = {r.doc_id: r.quality for r in labels.collect()}
    assert len(got) == docs.count()
    out = [(r.score, known[i], r.predicted) for i, r in got.items() if r.held_out and i in known]
    assert all(r.held_out == (zlib.crc32(str(i).encode()) % 4 == 2) for i, r in got.items())
    good, bad = ([s for s, q, _ in out if q == k] for k in (1, 0))
    assert np.mean([[g > b for b in bad] for g in good]) > 0.97
    assert np.mean([p == q for _, q, p in out]) > 0.95


def test_quality_without_labels_text_or_rows(spark):
    df = spark.createDataFrame([(1, None, 0.1), (2, "", 0.1), (None, "a b", 0.1)], "doc_id long, text string, score double")
    none = spark.createDataFrame([], "doc_id long, quality int")
    assert [r.score for r in score_quality(df, none).collect()] == [0.5] * 3
    one = spark.createDataFrame([(1, 1), (2, 1), (3, None)], "doc_id long, quality int")
    assert keep_good(df, one).columns == df.columns and keep_good(df, one).count() == 3
    assert score_quality(df.limit(0), one).collect() == []


def test_statistics_are_finite():
    import pyarrow as pa

    assert np.isfinite(statistics(pa.array(["", None, "a", "\n", "A!! " * 1000, "é"]))).all()


def test_stages_by_hand(spark):
    """Every stage of the pipeline against a plain statement of it, on a small table."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    current = docs
    ids = {name: [] for name, _ in corpus_pipeline.STAGES}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        current = stage(spark, current, SF).cache()
        assert current.columns == docs.columns
        ids[name] = current.collect()
    scored = score_quality(docs, spark.read.parquet(f"{SF}/labels.parquet"))
    assert {r.doc_id for r in ids["quality classifier"]} == {r.doc_id for r in scored.where("predicted = 1").collect()}
    best: dict = {}
    for r in ids["quality classifier"]:
        low = re.sub("[A-Z]", lambda m: m[0].lower(), r.text or "")
        best[low] = max(best.get(low, r.doc_id), r.doc_id)
    assert sorted(r.doc_id for r in ids["exact dedup"]) == sorted(best.values())
    from test_search_and_join import brute_components

    pairs = brute_components([(r.doc_id, r.text) for r in ids["exact dedup"]], n=5, percent=80)
    assert sorted(r.doc_id for r in ids["n-gram Jaccard join"]) == sorted(i for i, _, c, _ in pairs if i == c)
    words = {r.doc_id: len(re.findall(WORD, r.text or "")) for r in ids["n-gram Jaccard join"]}
    mixed = sum(len(re.findall(WORD, r.text)) for r in ids["mixing sources to target weights"])
    assert abs(mixed - 1.5 * sum(words.values())) <= 20
    ranks = read_ranks(corpus_pipeline.public_tokenizers.path("byte_bpe_50k.tiktoken"))
    own = Codec(ranks, corpus_pipeline.public_tokenizers.PATTERN)
    texts = sorted(r.text for r in ids["mixing sources to target weights"])
    last = corpus_pipeline.STAGES[-1][1](spark, current, SF).collect()
    assert sorted(own.decode(r.ids).decode() for r in last) == texts


def test_stages_take_nulls_repeats_and_further_columns(spark):
    """Texts that say the same word for word stay once, near copies by five words and 0.8 too; names may clash."""
    words = [f"w{i}" for i in range(60)]
    near = [*words[:50], "other", *words[51:]]  # 51 of 61 shingles of five words, 55 of 61 of three
    rows = [(1, " ".join(words)), (2, " ".join(near)), (3, " ".join(words).upper()), (4, None), (5, ""), (6, "a b"), (6, "a b")]
    df = spark.createDataFrame([(*r, "en", "s", 0, "x") for r in rows], "doc_id long, text string, lang string, source string, n_chars long, node string")
    deduped = corpus_pipeline.exact_dedup(spark, df, SF)
    assert deduped.columns == df.columns
    assert sorted(r.doc_id for r in deduped.collect()) == [2, 3, 5, 6]
    joined = corpus_pipeline.ngram_jaccard_join(spark, deduped, SF)
    assert joined.columns == df.columns and sorted(r.doc_id for r in joined.collect()) == [2, 5, 6]
    mixed = corpus_pipeline.mixing(spark, joined, SF)
    assert mixed.columns == df.columns and "" not in {r.text for r in mixed.where("doc_id = 2").collect()}
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, df.limit(0), SF).collect() == []
