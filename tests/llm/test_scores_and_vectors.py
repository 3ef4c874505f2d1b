"""Operators 11 to 13 against plain computations: nulls, empty and long texts, ties, repeats, clashing columns."""

import hashlib
import math
import random
import re
import tracemalloc
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from dialoom.llm import centroids, interpolation, whitening

LOW = {code: code + 32 for code in range(65, 91)}


# ---- deleted interpolation


def brute_scores(rows, order):
    """The model with plain counters: (held_out, n_tokens, n_known, train_tokens, base_score, score) by place."""
    docs = []
    for doc_id, text in rows:
        tokens = [*re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOW)), " end"]
        docs.append((zlib.crc32(str(doc_id).encode()) % 7 if doc_id is not None else -1, tokens))

    def counted(folds):
        grams, documents = Counter(), 0
        for fold, tokens in docs:
            if fold in folds:
                documents += 1
                padded = [" start"] * (order - 1) + tokens
                for j in range(order - 1, len(padded)):
                    grams.update(tuple(padded[j - k + 1 : j + 1]) for k in range(1, order + 1))
        single = [n for g, n in grams.items() if len(g) == 1]
        return grams, documents, sum(single), len(single)

    def events(model, tokens):
        grams, documents, total, _ = model
        padded = [" start"] * (order - 1) + tokens
        for j in range(order - 1, len(padded)):
            shares, buckets = [], []
            for k in range(2, order + 1):
                context = documents if j == order - 1 else grams[tuple(padded[j - k + 1 : j])]
                shares.append(grams[tuple(padded[j - k + 1 : j + 1])] / max(context, 1))
                buckets.append(context.bit_length())
            yield shares, buckets, grams[(padded[j],)] / max(total, 1), grams[(padded[j],)]

    def chances(weights, event, uniform):
        shares, buckets, own, _ = event
        out = [weights.get("own", 0.5) * own + (1 - weights.get("own", 0.5)) * uniform]
        for k, (share, bucket) in enumerate(zip(shares, buckets)):
            w = weights.get((k, bucket), 0.5) if bucket else 0
            out.append(w * share + (1 - w) * out[-1])
        return out

    kept, every = counted({-1, 0, 1, 4, 5, 6}), counted({-1, 0, 1, 3, 4, 5, 6})
    seen = [e for fold, tokens in docs if fold == 3 for e in events(kept, tokens)]
    weights, last, uniform = {}, -math.inf, 1 / (kept[3] + 1)
    for _ in range(interpolation.ROUNDS if seen else 0):
        taken, reached, likely = Counter(), Counter(), 0
        for event in seen:
            p, left = chances(weights, event, uniform), 1.0
            likely += math.log(p[-1]) / len(seen)
            for k in range(order - 2, -1, -1):
                bucket = event[1][k]
                part = left * (weights.get((k, bucket), 0.5) if bucket else 0) * event[0][k] / p[k + 1]
                taken[k, bucket] += part
                reached[k, bucket] += left
                left -= part
            taken["own"] += left * weights.get("own", 0.5) * event[2] / p[0]
            reached["own"] += left
        weights = {k: min(taken[k] / n, 1 - 1e-6) for k, n in reached.items() if n and (k == "own" or k[1])}
        if likely - last < interpolation.SETTLED:
            break
        last = likely
    total, distinct = every[2], every[3]
    out = []
    for fold, tokens in docs:
        own = list(events(every, tokens))
        base = sum(math.log10((e[3] + 1) / (total + distinct + 1)) for e in own)
        score = sum(math.log10(chances(weights, e, 1 / (distinct + 1))[-1]) for e in own)
        out.append((fold == 2, len(tokens), sum(e[3] > 0 for e in own), total, base, score))
    return out


def some_texts():
    rnd = random.Random(11)
    words = [f"w{int(rnd.paretovariate(0.8))}" for _ in range(400)] + ["The", "é", "end", "x" * 300]
    rows = [(i, " \n".join(rnd.choices(words, k=rnd.randint(0, 60)))) for i in range(120)]
    rows += [(i, rows[5][1]) for i in range(500, 540)]  # copies
    return [*rows, rows[3], rows[3], (700, None), (701, " \t"), (None, "the nameless"), (702, "w1 w2 " * 9000)]


@pytest.mark.parametrize("order, block_tokens, chunk", [(2, 1 << 22, 1 << 18), (3, 300, 64), (4, 5000, 1 << 18)])
def test_scores_equal_plain_counts(spark, monkeypatch, order, block_tokens, chunk):
    monkeypatch.setattr(interpolation, "CHUNK_TOKENS", chunk)
    rows = some_texts()
    df = spark.createDataFrame([(*r, 0, "b") for r in rows], "doc_id long, text string, kind int, block string").repartition(3)
    got = interpolation.score_texts(df, order=order, block_tokens=block_tokens).collect()
    expected = Counter((r[0], *p[:4], round(p[4], 6), round(p[5], 6)) for r, p in zip(rows, brute_scores(rows, order)))
    found = Counter((*r[:5], round(r.base_score, 6), round(r.score, 6)) for r in got)
    assert found == expected


def test_scores_of_nothing_and_without_training(spark):
    df = spark.createDataFrame(some_texts(), "doc_id long, text string")
    assert interpolation.score_texts(df.limit(0)).collect() == []
    held = df.where("pmod(crc32(cast(cast(doc_id as string) as binary)), 7) = 2")
    for r in interpolation.score_texts(held).collect():
        assert (r.held_out, r.n_known, r.train_tokens, r.base_score, r.score) == (True, 0, 0, 0, 0)
    with pytest.raises(ValueError):
        interpolation.score_texts(df, order=1)


def test_the_model_gains_on_texts_it_did_not_see(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    sums = interpolation.score_texts(docs).where("held_out").selectExpr("sum(base_score) b", "sum(score) s").first()
    assert sums.s > 0.95 * sums.b and sums.s < 0


def test_chances_add_up_to_one():
    """Over all known tokens and the one unknown, after contexts that were seen and others."""
    counts, every = Counter("a a b c a b".split()), interpolation.Totals(6, 2, 3)
    weights = interpolation.Weights(2)
    weights.longer[0, 2], weights.own = 0.7, 0.4
    after = {"a": 1, "b": 2, "c": 0, None: 0}
    total = 0
    for word, n in after.items():
        own, longer = np.array([2, counts.get(word, 0)]), np.array([0, n])
        shares, buckets, single = every.ratios([np.where([True, False], 3, own), longer], np.array([0]))
        total += weights.chances(shares, buckets, single, 1 / 4)[-1][1]
    assert abs(total - 1) < 1e-12


class Asked:
    """Stands for blocks, and gives the function that a task runs."""

    def select(self, *_):
        return self

    def mapInArrow(self, run, _):
        return run


@pytest.mark.parametrize("bits", [0, 5])
def test_requests_of_a_block_take_little_memory(bits):
    tokens = np.random.default_rng(1).integers(0, 1 << 64, 1 << 21, np.uint64)
    tokens[::3] = 7
    block = interpolation.Block()
    block.add(pa.array([1, 2]), tokens, np.array([5, len(tokens) - 5]))
    row = block.row(3, interpolation.KEPT_KIND)
    found = defaultdict(lambda: ([], []))
    tracemalloc.start()
    most, shrunk = 0, []
    for batch in interpolation.requests(Asked(), 2, bits)(iter([row])):
        shrunk.append(batch)
        most = max(most, tracemalloc.get_traced_memory()[1])
    tracemalloc.stop()
    for r in pa.Table.from_batches(shrunk).to_pylist():
        grams, often = interpolation.sorted_unshrunk(r["grams"]), interpolation.unshrunk(r["counts"], np.uint32)
        assert (r["block"], r["kind"]) == (3, 0) and (not bits or (grams >> np.uint64(64 - bits) == r["range"]).all())
        found[r["length"]][0].append(grams)
        found[r["length"]][1].append(often)
    for length, gram in enumerate(interpolation.grams(tokens, np.array([0, 5]), 2), 1):
        distinct, often = np.unique(gram, return_counts=True)
        assert (np.concatenate(found[length][0]) == distinct).all() and (np.concatenate(found[length][1]) == often).all()
    assert not bits or most < 5 * tokens.nbytes


class Grouped:
    """Stands for requests, and gives the function that a task runs on a group."""

    def groupBy(self, *_):
        return self

    def applyInArrow(self, run, _):
        return run


def most_traced(run):
    tracemalloc.start()
    try:
        return run(), tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()


def test_counts_meet_a_block_in_little_memory():
    tokens = np.random.default_rng(2).integers(0, 1 << 64, 1 << 21, np.uint64)
    tokens[::3], tokens[1 << 20 :] = 7, tokens[: 1 << 20]
    sizes = np.array([5, 1 << 20, len(tokens) - (1 << 20) - 5])
    block = interpolation.Block()
    block.add(pa.array([1, 2, 3]), tokens, sizes)
    row = block.row(3, interpolation.KEPT_KIND).to_pylist()[0]
    replies, expected = [], []
    for gram in interpolation.grams(tokens, interpolation.starts_of(sizes), 3):
        _, place, often = np.unique(gram, return_inverse=True, return_counts=True)
        replies.append([interpolation.shrunk(part) for part in np.split(often, [1000, len(often) // 2])])
        expected.append(often[place])
    del gram, place, often

    def run():
        found = [[] for _ in replies]
        for _, counts, _ in interpolation.looked_up(row, list(replies)):
            for of_length, some in zip(found, counts, strict=True):
                of_length.append(some.astype(np.uint8) if some.max() < 256 else some)
        return found

    found, most = most_traced(run)
    assert all((np.concatenate(f) == e).all() for f, e in zip(found, expected, strict=True))
    assert most < 5 * tokens.nbytes


def test_answers_of_a_large_group_leave_in_batches(monkeypatch):
    monkeypatch.setattr(interpolation, "written", lambda df, _: df)
    rnd, kinds = np.random.default_rng(3), [interpolation.KEPT_KIND, interpolation.DELETED_KIND, interpolation.HELD_OUT_KIND]
    lists = [np.unique(rnd.integers(0, 1 << 18, 1 << 17, np.uint64)) for _ in range(30)]
    often = [rnd.integers(1, 1 << 30, len(x)).astype(np.uint32) for x in lists]
    rows = [
        (2, 5, i, kinds[i % 3], interpolation.sorted_shrunk(x), None if i % 3 == 2 else interpolation.shrunk(n))
        for i, (x, n) in enumerate(zip(lists, often, strict=True))
    ]
    asked = (interpolation.batch_of([row], interpolation.ASKED) for row in rows)
    out = list(interpolation.answers(Grouped())((pa.scalar(2), pa.scalar(5)), asked))
    assert len(out) > 5 and max(batch.nbytes for batch in out) < 3 * interpolation.BATCH_BYTES
    kept, trained = np.zeros(1 << 18, np.int64), np.zeros(1 << 18, np.int64)
    for i, (x, n) in enumerate(zip(lists, often, strict=True)):
        kept[x] += n if i % 3 == 0 else 0
        trained[x] += n if i % 3 < 2 else 0
    fact, *answers = pa.Table.from_batches(out).to_pylist()
    assert (fact["block"], fact["distinct"], fact["distinct_kept"]) == (-1, (trained > 0).sum(), (kept > 0).sum())
    assert [r["block"] for r in answers] == list(range(30))
    for r, x in zip(answers, lists, strict=True):
        assert (interpolation.unshrunk(r["trained"], np.int64) == trained[x]).all()
        assert (r["kept"] is None) == (r["kind"] != 1)
        assert r["kept"] is None or (interpolation.unshrunk(r["kept"], np.int64) == kept[x]).all()


# ---- centroids


def brute_clusters(rows, clusters, rounds):
    kept = [(i, [math.floor(256 * float(c)) for c in v]) for i, v in rows
            if v is not None and len(v) == 64 and all(c is not None and math.isfinite(c) for c in v)]
    order = sorted(kept, key=lambda r: (r[0] is None, hashlib.sha256(f"2:{r[0]}".encode()).hexdigest()))
    centres = [v for _, v in order[:clusters]]

    def nearest(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c)), i) for i, c in enumerate(centres))

    for _ in range(rounds):
        groups = {}
        for _, v in kept:
            groups.setdefault(nearest(v)[1], []).append(v)
        centres = [[sum(c) // len(groups[i]) for c in zip(*groups[i])] if i in groups else c for i, c in enumerate(centres)]
    found = [(i, *nearest(v)) for i, v in kept]
    inertia = Counter()
    for _, distance, cluster in found:
        inertia[cluster] += distance
    sha = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centres]
    return Counter((i, c, d, inertia[c], sum(inertia.values()), sha[c]) for i, d, c in found)


def odd_vectors(n=90):
    rnd = random.Random(12)
    rows = [(i, [rnd.gauss(0, 0.2) * (1 + 40 * (i % 17 == 0)) for _ in range(64)]) for i in range(n)]
    hot = rows[4][1]
    rows += [(1000 + i, hot) for i in range(40)] + [rows[7], rows[7], (None, rows[9][1])]
    rows += [(2000, None), (2001, [0.0] * 63), (2002, []), (2003, [None] + [0.0] * 63), (2004, [math.nan] + [0.0] * 63)]
    return [*rows, (2005, [math.inf] + [0.0] * 63), (2006, [0.0] * 64), (2007, [-4000.0] + [5.5] * 63)]


def vectors(spark, rows, kind="double"):
    return spark.createDataFrame([(*r, "c") for r in rows], f"vec_id long, embedding array<{kind}>, cluster string").repartition(3)


@pytest.mark.parametrize("clusters, rounds", [(40, 5), (3, 2), (500, 1)])
def test_clusters_equal_plain_sums(spark, clusters, rounds):
    got = centroids.cluster_vectors(vectors(spark, odd_vectors()), clusters, rounds).collect()
    assert Counter(map(tuple, got)) == brute_clusters(odd_vectors(), clusters, rounds)


def test_clusters_of_nothing_and_of_too_much(spark):
    df = vectors(spark, odd_vectors())
    assert centroids.cluster_vectors(df.limit(0)).collect() == []
    assert centroids.cluster_vectors(df.where("vec_id between 2000 and 2005")).collect() == []
    with pytest.raises(Exception, match="too large"):
        centroids.cluster_vectors(vectors(spark, [(1, [1e9] * 64)])).collect()


def test_planes_keep_numbers_and_products():
    rng = np.random.default_rng(13)
    for high in (1, 2, 100, 1 << 20):
        x, y = rng.integers(-high, high, (20, 64)), rng.integers(-3, 3, (7, 64))
        planes, other = centroids.to_planes(x), centroids.to_planes(y)
        assert (centroids.from_planes(planes) == x).all()
        assert (centroids.dot_products(planes, other) == x @ y.T).all()
        assert (centroids.squares(planes) == (x * x).sum(axis=1)).all()
        mixed = centroids.stacked([planes[0].tobytes(), other[0].tobytes()])
        assert (centroids.from_planes(mixed) == np.array([x[0], y[0]])).all()


# ---- whitening


def check_whitened(df, rows, components=16, **options):
    kept = [(i, v) for i, v in rows if v is not None and all(c is not None and math.isfinite(c) for c in v)]
    width = max(len(v) for _, v in kept)
    x = np.array([[math.floor(64 * float(c)) + 1_000_000 for c in v] + [1_000_000] * (width - len(v)) for _, v in kept])
    fit = np.unique(x, axis=0)
    n, sums = len(fit), fit.sum(axis=0)
    centred = (n * fit - sums) / n
    values, axes = np.linalg.eigh(centred.T @ centred / n)
    values, axes = values[::-1], axes[:, ::-1]
    count = min(components, int((values > values[0] * width * 1e-13).sum()))
    white = ((n * x - sums) / n) @ axes[:, :count] / np.sqrt(values[:count])
    got = df if isinstance(df, list) else whitening.whiten(df, components, **options).collect()
    assert len(got) == len(kept) * count
    expected = Counter()
    for (i, _), row, w in zip(kept, x, white):
        for c in range(count):
            expected[i, c + 1, n, sum((n * int(a) - int(s)) ** 2 for a, s in zip(row, sums)), round(abs(w[c]), 6) + 0.0] += 1
    found = Counter((r.vec_id, r.component, r.n, r.deviation, round(abs(r.whitened), 6) + 0.0) for r in got)
    assert found == expected
    assert all(abs(r.explained - values[r.component - 1] / values.sum()) < 1e-9 and r.identity_error < 1e-4 for r in got)


@pytest.mark.parametrize("block_rows", [7, 1024])
def test_whitened_rows_equal_a_plain_eigendecomposition(spark, block_rows):
    rows = [r for r in odd_vectors() if r[1] is None or len(r[1]) != 0]
    check_whitened(vectors(spark, rows), rows, block_rows=block_rows)


def test_few_vectors_and_short_ones(spark):
    rows = [(1, [0.0, 1.0, 2.0]), (2, [3.0, 1.0]), (3, [0.0, 1.0, 2.0]), (None, [9.0]), (5, [])]
    check_whitened(vectors(spark, rows, "float"), rows)
    df = vectors(spark, rows)
    assert whitening.whiten(df.limit(0)).collect() == []
    assert whitening.whiten(df.where("vec_id in (1, 3)")).collect() == []  # one distinct vector has no spread
    assert whitening.whiten(df.where("vec_id = 5")).collect() == []
