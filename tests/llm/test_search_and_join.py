"""Operators 1 and 9 against brute force."""

import math
import random
import re

import numpy as np
import pandas as pd
import pytest

from dialoom.llm import ngram_join
from dialoom.llm.components import components
from dialoom.llm.metric_search import Tree, build_pages, top_k

ASCII = {code: code + 32 for code in range(65, 91)}


def test_tree_finds_what_a_scan_finds_and_computes_less():
    rng = np.random.default_rng(0)
    centres = rng.normal(size=(10, 16))[rng.integers(0, 10, 2000)]
    points = rng.normal(size=(2000, 16)) + 2 * centres
    vectors = np.floor(256 * points / np.linalg.norm(points, axis=1, keepdims=True))
    vectors[100:400] = vectors[5]
    ids = rng.permutation(100_000)[:2000].astype(np.int64)
    longest = float((vectors**2).sum(axis=1).max())
    tree = Tree(pd.DataFrame(build_pages(vectors, ids, longest)), longest)
    for i in range(0, 2000, 20):
        scores = vectors @ vectors[i]
        expected = sorted((-s, v) for s, v, j in zip(scores, ids, range(2000), strict=True) if j != i)[:5]
        assert tree.search(vectors[i], int(ids[i]), 5, -math.inf) == [(-s, v) for s, v in expected]
    assert tree.computed < 0.5 * 100 * 2000


def test_top_k_with_nulls_ties_repeats_and_clashing_columns(spark):
    rows = [(i, [float(i % 4), float(i % 3)]) for i in range(60)]
    odd = [(100, None), (101, [1.0, None]), (102, [float("nan"), 1.0]), (103, [float("inf"), 1.0]), (None, [9.0, 9.0])]
    repeated = [(7, [3.0, 1.0]), (104, [5.0]), (105, [])]
    df = spark.createDataFrame([(*r, 0, "x") for r in rows + odd + repeated], "vec_id long, embedding array<float>, score int, tree string")
    got = top_k(df, df.where("vec_id % 10 = 0"), tree_rows=16).collect()
    whole = {(i, tuple(math.floor(256 * x) for x in v)) for i, v in rows + repeated}
    expected = []
    for q, x in sorted(whole):
        if q % 10 == 0:
            near = sorted((-sum(a * b for a, b in zip(x, y, strict=False)), v) for v, y in whole if v != q)[:5]
            expected += [(q, rank, v, -s) for rank, (s, v) in enumerate(near, 1)]
    assert sorted(map(tuple, got)) == sorted(expected)
    assert top_k(df.limit(0), df.limit(0)).collect() == []


def word_sets(rows, n=3):
    sets = []
    for _, text in rows:
        words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(ASCII))
        grams = {tuple(words[i : i + n]) for i in range(len(words) - n + 1)} if len(words) >= n else {tuple(words)}
        sets.append(grams if words else set())
    return sets


def brute_components(rows, n=3, percent=90):
    sets, parent = word_sets(rows, n), list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    links = [0] * len(rows)
    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= percent * (len(sets[i]) + len(sets[j]) - both):
                links[i] += 1
                links[j] += 1
                a, b = root(i), root(j)
                parent[max(a, b)] = min(a, b)
    smallest = {}
    for i, (doc_id, _) in enumerate(rows):
        if doc_id is not None:
            smallest[root(i)] = min(smallest.get(root(i), doc_id), doc_id)
    return [(rows[i][0], len(sets[i]), smallest.get(root(i)), links[i]) for i in range(len(rows))]


def families(seed):
    rnd = random.Random(seed)
    words = [f"w{i}" for i in range(300)]
    rows = []
    for _ in range(24):
        base = [rnd.choice(words) for _ in range(rnd.randint(1, 120))]
        for _ in range(rnd.randint(1, 12)):
            own = list(base)
            for _ in range(rnd.choice([0, 0, 1, 1, 2, 3])):
                own[rnd.randrange(len(own))] = rnd.choice(words).upper()
            rows.append((len(rows) * 7 % 1009, " ".join(own)))
    edge = [(2000, None), (2001, ""), (2002, " \n"), (2003, "a b"), (2004, "A  b"), (2005, "a"), (None, "a b")]
    return rows + edge + [rows[0], (rows[1][0], rows[5][1])]


def key(row):
    return tuple((x is not None, x or 0) for x in row)


@pytest.mark.parametrize("cell", [1_000_000, 300])
def test_jaccard_components_are_those_of_all_pairs(spark, monkeypatch, cell):
    monkeypatch.setattr(ngram_join, "CELL_NGRAMS", cell)
    rows = families(cell)
    df = spark.createDataFrame([(*r, 1, "b") for r in rows], "doc_id long, text string, size int, cls string")
    got = [tuple(r)[:4] for r in ngram_join.jaccard_components(df).collect()]
    assert sorted(got, key=key) == sorted(brute_components(rows), key=key)


def test_keep_one_of_each_component_and_the_empty_table(spark):
    rows = [(3, "a b c d"), (1, "A b c d"), (2, "x y z"), (2, "x y z"), (5, None), (6, None)]
    df = spark.createDataFrame([(*r, i) for i, r in enumerate(rows)], "doc_id long, text string, label int")
    kept = ngram_join.keep_one(df)
    assert kept.columns == df.columns
    assert sorted(r.doc_id for r in kept.collect()) == [1, 2, 5, 6]
    assert ngram_join.jaccard_components(df.limit(0)).collect() == []


def test_components_of_paths_stars_and_circles(spark):
    edges = [(i, i + 1) for i in range(0, 40)] + [(100, 100 + i) for i in range(1, 9)] + [(200, 201), (201, 202), (202, 200)]
    df = spark.createDataFrame([*edges, (7, 7)], "a long, b long")
    labels = {r.node: r.label for r in components(df).collect()}
    assert labels == {n: 0 if n < 100 else n // 100 * 100 for e in edges for n in e}
