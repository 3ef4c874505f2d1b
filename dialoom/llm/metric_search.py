"""Exact top-k search by inner product in M-trees, best node first.

Inner products become distances: with one more component, each vector gets the length of the longest, and then
the vector nearest to a query is the one of the largest product. Vectors are dealt to trees of bounded size by
their ids. A tree is a set of pages. An entry of an inner page has a routing vector, the radius that covers all
below it, and its distance from the routing vector of the page it stands in; an entry of a leaf has a vector,
its ids and that same distance. A search takes the page with the smallest possible distance first and ends when
none can hold anything better. An entry whose stored distances and the triangle inequality rule it out costs no
computation.

Each query is first searched in the tree of its own id, whose k-th score then bounds its search in all others.
Trees and queries meet in blocks, each a part of the queries against one tree.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from dialoom.llm.common import written

TREE_ROWS = 8192
LANE_QUERIES = 8192
LEAF, FANOUT = 512, 32
SCALE = 256
SLACK = 1e-6  # distances are floats; scores are exact
PAGES = "tree long, page int, leaf boolean, vectors binary, radii binary, to_parent binary, below binary, ids binary"


# ---- the tree


def build_pages(vectors: np.ndarray, ids: np.ndarray, longest: float) -> list[dict]:
    """Pages of the tree over `vectors` (whole numbers as floats); page 0 is the root. Equal vectors are one entry."""
    distinct, place = np.unique(vectors, axis=0, return_inverse=True)
    order = np.lexsort((ids, place.ravel()))
    bounds = np.searchsorted(place.ravel()[order], np.arange(len(distinct) + 1))
    own_ids = [np.unique(ids[order[a:b]]) for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
    lift = np.sqrt(np.maximum(longest - (distinct**2).sum(axis=1), 0))
    lifted = np.column_stack([distinct, lift])
    rng = np.random.default_rng(len(distinct))
    pages: list[dict] = []

    def distances(rows: np.ndarray, centre: int) -> np.ndarray:
        return np.sqrt(((lifted[rows] - lifted[centre]) ** 2).sum(axis=1))

    def page(rows: np.ndarray, centre: int | None) -> int:
        number = len(pages)
        pages.append({})
        leaf = len(rows) <= LEAF
        if leaf:
            entries, radii = rows, np.zeros(len(rows))
        else:
            seeds = rng.choice(rows, FANOUT, replace=False)
            nearest = (lifted[rows] @ lifted[seeds].T).argmax(axis=1)  # all have the same length
            parts = [rows[nearest == i] for i in range(FANOUT)]
            some = [i for i, part in enumerate(parts) if len(part)]
            if len(some) < 2:
                parts, some = np.array_split(rows, FANOUT), list(range(FANOUT))
                seeds = np.array([part[0] for part in parts])
            entries, parts = seeds[some], [parts[i] for i in some]
            radii = np.array([distances(part, c).max() for part, c in zip(parts, entries, strict=True)])
        to_parent = distances(entries, centre) if centre is not None else np.zeros(len(entries))
        if leaf:
            below = np.cumsum([0, *(len(own_ids[e]) for e in entries)])
        else:
            below = np.array([page(part, c) for part, c in zip(parts, entries, strict=True)], np.int64)
        pages[number] = {
            "page": number,
            "leaf": leaf,
            "vectors": distinct[entries].tobytes(),
            "radii": radii.tobytes(),
            "to_parent": to_parent.tobytes(),
            "below": below.tobytes(),
            "ids": np.concatenate([own_ids[e] for e in entries]).tobytes() if leaf and len(entries) else b"",
        }
        return number

    page(np.arange(len(distinct)), None)
    return pages


class Tree:
    """The pages of a tree, read back."""

    def __init__(self, pages: pd.DataFrame, longest: float):
        self.longest = longest
        self.pages = {}
        for row in pages.to_dict("records"):
            radii = np.frombuffer(row["radii"])
            self.pages[row["page"]] = (
                row["leaf"],
                np.frombuffer(row["vectors"]).reshape(len(radii), -1) if len(radii) else np.zeros((0, 1)),
                radii,
                np.frombuffer(row["to_parent"]),
                np.frombuffer(row["below"], np.int64),
                np.frombuffer(row["ids"], np.int64),
            )
        self.computed = 0

    def search(self, query: np.ndarray, own: int, k: int, bound: float) -> list[tuple[float, int]]:
        """Up to k pairs (score, id), best first: all of the k best whose score is at least `bound`."""
        length = float(query @ query) + self.longest
        best: list[tuple[float, int]] = []  # a heap of (score, -id), the worst of the k best first
        least = bound

        def reach() -> float:
            return math.sqrt(max(length - 2 * least, 0)) * (1 + SLACK) + SLACK if least > -math.inf else math.inf

        queue: list[tuple[float, int, float | None]] = [(0.0, 0, None)]
        limit = reach()
        while queue:
            nearest, number, centre = heapq.heappop(queue)
            if nearest > limit:
                break
            leaf, vectors, radii, to_parent, below, ids = self.pages[number]
            entries = np.arange(len(radii))
            if centre is not None:  # what the triangle inequality rules out is not computed
                entries = entries[np.abs(centre - to_parent) - radii <= limit]
            scores = vectors[entries] @ query
            self.computed += len(entries)
            if leaf:
                for e, score in zip(entries[scores >= least].tolist(), scores[scores >= least].tolist(), strict=True):
                    taken = 0
                    for vec_id in ids[below[e] : min(below[e] + k + 1, below[e + 1])].tolist():
                        if vec_id == own or taken == k:
                            continue
                        taken += 1
                        if len(best) < k:
                            heapq.heappush(best, (score, -vec_id))
                        elif (score, -vec_id) > best[0]:
                            heapq.heapreplace(best, (score, -vec_id))
                    if len(best) == k and best[0][0] > least:
                        least = best[0][0]
                limit = reach()
            else:
                distance = np.sqrt(np.maximum(length - 2 * scores, 0))
                lower = np.maximum(distance - radii[entries], 0)
                for e, d, low in zip(entries.tolist(), distance.tolist(), lower.tolist(), strict=True):
                    if low <= limit:
                        heapq.heappush(queue, (low, int(below[e]), d))
        return sorted(((score, -minus) for score, minus in best), key=lambda x: (-x[0], x[1]))


# ---- in Spark


def scaled(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(vec_id, vector, square) of the vectors that take part: components floor(256 x) as float64 in a binary."""
    x = F.col(vector_col)
    whole = F.exists(x, lambda c: c.isNull() | F.isnan(c) | (F.abs(c.cast("double")) == float("inf")))
    kept = vectors.where(F.col(id_col).isNotNull() & x.isNotNull() & ~whole)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch["x"]
            flat = np.floor(SCALE * np.asarray(column.flatten(), np.float64))
            ends = np.cumsum(np.asarray(column.value_lengths(), np.int64)) if len(batch) else np.zeros(0, np.int64)
            rows = np.split(flat, ends[:-1]) if len(batch) else []
            yield pa.RecordBatch.from_arrays(
                [
                    batch["vec_id"],
                    pa.array([r.tobytes() for r in rows], pa.binary()),
                    pa.array([float(r @ r) for r in rows], pa.float64()),
                ],
                ["vec_id", "vector", "square"],
            )

    named = kept.select(F.col(id_col).cast("long").alias("vec_id"), x.cast("array<double>").alias("x"))
    return named.mapInArrow(run, "vec_id long, vector binary, square double")


def build_index(data: DataFrame, trees: int, width: int, longest: float) -> DataFrame:
    """Pages of all trees; a vector goes to the tree of its id."""

    def run(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        pages = build_pages(_matrix(pdf["vector"], width), pdf["vec_id"].to_numpy(np.int64), longest)
        return pd.DataFrame(pages).assign(tree=key[0])

    dealt = data.select("vec_id", "vector", F.pmod(F.xxhash64("vec_id"), F.lit(trees)).alias("tree"))
    return written(dealt.groupBy("tree").applyInPandas(run, PAGES), "pages")


def _matrix(vectors: pd.Series, width: int) -> np.ndarray:
    out = np.zeros((len(vectors), width))
    for i, raw in enumerate(vectors):
        row = np.frombuffer(raw)
        out[i, : len(row)] = row
    return out


def _searched(pages: DataFrame, queries: DataFrame, lanes: int, width: int, longest: float, k: int) -> DataFrame:
    """(query_id, vector, vec_id, score) of `queries` (query_id, vector, lane, tree, bound) in their trees."""

    def run(key: tuple, left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        out: list[tuple] = []
        if len(left) and len(right):
            tree = Tree(left, longest)
            vectors = _matrix(right["vector"], width)
            for vector, raw, query_id, bound in zip(
                vectors, right["vector"], right["query_id"].tolist(), right["bound"].tolist(), strict=True
            ):
                found = tree.search(vector, query_id, k, bound)
                out += [(query_id, raw, vec_id, int(score)) for score, vec_id in found]
        return pd.DataFrame(out, columns=["query_id", "vector", "vec_id", "score"])

    every = pages.withColumn("lane", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(lanes - 1).cast("bigint"))))
    return (
        every.groupBy("tree", "lane")
        .cogroup(queries.groupBy("tree", "lane"))
        .applyInPandas(run, "query_id long, vector binary, vec_id long, score long")
    )


def top_k(
    vectors: DataFrame,
    queries: DataFrame,
    k: int = 5,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    tree_rows: int = TREE_ROWS,
) -> DataFrame:
    """(query_id, rank, vec_id, score): for each of `queries` the k largest integer inner products with `vectors`.

    Components are floor(256 x). Ties go to the smaller id; a query does not find vectors of its own id. Rows
    with a null id, a null vector or a component that is null or not finite take no part. Vectors of different
    lengths are filled up with zeros. Rows that repeat count once. Without vectors, or for a query without
    others, there are no rows. Products are exact as long as they stay below 2**53.
    """
    data = written(scaled(vectors, id_col, vector_col), "vectors")
    facts = data.agg(
        F.count("*").alias("n"), F.max("square").alias("longest"), F.max(F.length("vector")).alias("bytes")
    ).first()  # one row
    longest, width = facts.longest or 0.0, max(1, (facts.bytes or 0) // 8)
    trees = max(1, math.ceil(facts.n / tree_rows))
    pages = build_index(data, trees, width, longest)

    asked = scaled(queries, id_col, vector_col).select(F.col("vec_id").alias("query_id"), "vector").distinct()
    home = F.pmod(F.xxhash64("query_id"), F.lit(trees))
    asked = written(asked.withColumn("home", home), "queries")
    lanes = max(1, math.ceil(asked.count() / LANE_QUERIES))
    lane = F.pmod(F.xxhash64("query_id", F.lit(1)), F.lit(lanes)).alias("lane")

    first = asked.select("query_id", "vector", lane, F.col("home").alias("tree"), F.lit(-math.inf).alias("bound"))
    near = written(_searched(pages, first, lanes, width, longest, k), "near")
    kth = near.groupBy("query_id", "vector").agg(F.count("*").alias("n"), F.min("score").alias("least"))
    bound = F.when(F.col("n") >= k, F.col("least").cast("double")).otherwise(-math.inf)
    every = F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(trees - 1).cast("bigint")))
    rest = (
        asked.join(kth, ["query_id", "vector"], "left")
        .select("query_id", "vector", lane, every.alias("tree"), bound.alias("bound"), "home")
        .where("tree <> home")
        .drop("home")
    )
    found = near.unionByName(_searched(pages, rest, lanes, width, longest, k))
    best = Window.partitionBy("query_id", "vector").orderBy(F.desc("score"), "vec_id")
    return (
        found.withColumn("rank", F.row_number().over(best))
        .where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )
