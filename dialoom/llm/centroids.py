"""Centroid clustering of integer vectors by bit planes.

Components become integers floor(256 x) in two's complement. Bit plane b of a vector holds bit b of each of its
64 components in one 64-bit number; the last plane is the sign's and weighs -2**b. A dot product is then the sum
over pairs of planes of weight times weight times the number of common bits, and a squared distance is made of
three dot products, all exact. Planes are written once and are all that later passes read. A pass sends up the
sums of each task's clusters, so that a round costs one row for each task and centroid, and the driver holds the
centroids alone, whose number is a parameter.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dialoom.llm.common import written

DIMENSIONS = 64
SCALE = 256
CLUSTERS, ROUNDS = 40, 5
MOST_PLANES = 28  # beyond it a distance could pass the range of a long


# ---- planes


def to_planes(x: np.ndarray) -> np.ndarray:
    """Bit planes (rows, planes) of whole numbers (rows, 64), as many as the largest of them needs."""
    size = int(np.where(x < 0, ~x, x).max(initial=0)).bit_length() + 1
    bits = (x[:, None, :] >> np.arange(size)[None, :, None]) & 1
    return np.packbits(bits.astype(np.uint8), axis=2, bitorder="little").view("<u8")[:, :, 0]


def from_planes(planes: np.ndarray) -> np.ndarray:
    """The whole numbers (rows, 64) behind bit planes."""
    bits = np.unpackbits(planes.astype("<u8")[:, :, None].view(np.uint8), axis=2, bitorder="little")
    return np.tensordot(weights(planes.shape[1]), bits.astype(np.int64), axes=(0, 1))


def weights(size: int) -> np.ndarray:
    """What a bit of each plane counts."""
    out = np.left_shift(np.int64(1), np.arange(size, dtype=np.int64))
    out[-1] *= -1
    return out


def squares(planes: np.ndarray) -> np.ndarray:
    """Dot product of each vector with itself."""
    w = weights(planes.shape[1])
    total = np.zeros(len(planes), np.int64)
    for i, wi in enumerate(w):
        for j, wj in enumerate(w):
            total += wi * wj * np.bitwise_count(planes[:, i] & planes[:, j]).astype(np.int64)
    return total


def dot_products(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Dot products (left rows, right rows) of two sets of vectors."""
    total = np.zeros((len(left), len(right)), np.int64)
    for i, wi in enumerate(weights(left.shape[1])):
        for j, wj in enumerate(weights(right.shape[1])):
            total += wi * wj * np.bitwise_count(left[:, i, None] & right[None, :, j]).astype(np.int64)
    return total


def nearest(planes: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Number and squared distance of the nearest centroid of each vector, the smaller number among equals."""
    distance = squares(planes)[:, None] + squares(centroids)[None, :] - 2 * dot_products(planes, centroids)
    cluster = distance.argmin(axis=1)
    return cluster, distance[np.arange(len(planes)), cluster]


def stacked(rows: list[bytes]) -> np.ndarray:
    """Planes of stored vectors; those with fewer planes repeat their sign plane, which leaves them the same."""
    sizes = np.array([len(r) // 8 for r in rows])
    flat = np.frombuffer(b"".join(rows), "<u8")
    place = np.minimum(np.arange(sizes.max(initial=1))[None, :], sizes[:, None] - 1)
    return flat[(np.cumsum(sizes) - sizes)[:, None] + place].astype(np.uint64)


# ---- in Spark


def packed(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(vec_id, planes) of the vectors that take part."""
    x = F.col(vector_col)
    wrong = F.exists(x, lambda c: c.isNull() | F.isnan(c) | (F.abs(c.cast("double")) == float("inf")))
    kept = vectors.where(x.isNotNull() & (F.size(x) == DIMENSIONS) & ~wrong)
    kind = vectors.schema[id_col].dataType

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if len(batch):
                scaled = np.floor(SCALE * np.asarray(batch["x"].flatten(), np.float64)).reshape(-1, DIMENSIONS)
                if np.abs(scaled).max() >= 2.0 ** (MOST_PLANES - 1):
                    raise ValueError("a component is too large for exact distances")
                planes = [row.tobytes() for row in to_planes(scaled.astype(np.int64)).astype("<u8")]
                yield pa.RecordBatch.from_arrays([batch["vec_id"], pa.array(planes, pa.binary())], ["vec_id", "planes"])

    named = kept.select(F.col(id_col).alias("vec_id"), x.cast("array<double>").alias("x"))
    return named.mapInArrow(run, T.StructType([T.StructField("vec_id", kind), T.StructField("planes", T.BinaryType())]))


def first_centroids(data: DataFrame, clusters: int) -> np.ndarray:
    """Vectors with the smallest hashes of their ids, as whole numbers; at most `clusters` rows reach the driver."""
    order = F.sha2(F.concat(F.lit("2:"), F.col("vec_id").cast("string")), 256)
    rows = data.orderBy(order.asc_nulls_last(), "planes").limit(clusters).select("planes").collect()
    return from_planes(stacked([bytes(r.planes) for r in rows])) if rows else np.zeros((0, DIMENSIONS), np.int64)


def next_centroids(data: DataFrame, centroids: np.ndarray) -> np.ndarray:
    """Centroids after one round: floor of the mean of each cluster, empty ones as they were."""
    planes = to_planes(centroids)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((len(planes), DIMENSIONS), np.int64)
        counts = np.zeros(len(planes), np.int64)
        for batch in batches:
            if len(batch):
                vectors = stacked(batch["planes"].to_pylist())
                cluster, _ = nearest(vectors, planes)
                np.add.at(sums, cluster, from_planes(vectors))
                counts += np.bincount(cluster, minlength=len(planes))
        some = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(some, pa.int64()),
                pa.array(counts[some], pa.int64()),
                pa.array(sums[some].tolist(), pa.list_(pa.int64())),
            ],
            ["cluster", "n", "sums"],
        )

    parts = data.select("planes").mapInArrow(run, "cluster long, n long, sums array<long>")
    total = parts.groupBy("cluster").agg(
        F.sum("n").alias("n"), F.array(*[F.sum(F.col("sums")[i]) for i in range(DIMENSIONS)]).alias("sums")
    )
    out = centroids.copy()
    for row in total.collect():  # one for each centroid at most
        out[row.cluster] = [s // row.n for s in row.sums]
    return out


def assigned(data: DataFrame, centroids: np.ndarray) -> DataFrame:
    """(vec_id, cluster, distance) of every vector."""
    planes = to_planes(centroids)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if len(batch):
                cluster, distance = nearest(stacked(batch["planes"].to_pylist()), planes)
                columns = [batch["vec_id"], pa.array(cluster, pa.int32()), pa.array(distance, pa.int64())]
                yield pa.RecordBatch.from_arrays(columns, ["vec_id", "cluster", "distance"])

    fields = [data.schema["vec_id"], T.StructField("cluster", T.IntegerType()), T.StructField("distance", T.LongType())]
    return data.mapInArrow(run, T.StructType(fields))


def cluster_vectors(
    vectors: DataFrame,
    clusters: int = CLUSTERS,
    rounds: int = ROUNDS,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
) -> DataFrame:
    """vec_id, cluster, distance, cluster_inertia, inertia and centroid_sha256 of every vector of 64 components.

    Centroids start as the vectors whose ids have the smallest hashes and move `rounds` times to the floor of
    their cluster's mean. Vectors that are null, of another length or with a component that is null or not finite
    take no part; an empty vector is of another length. A vector with a null id takes part under that id and comes
    last among the starts. Repeated rows count each and come out each; ties of hashes go by the vector, ties of
    distance to the smaller cluster. With fewer vectors than `clusters` there are as many clusters as vectors,
    some perhaps empty; without any there are no rows. Other columns are not read. Components of 2**27 and more
    after scaling raise an error, as distances would not fit a long.
    """
    data = written(packed(vectors, id_col, vector_col), "planes")
    centroids = first_centroids(data, clusters)
    if len(centroids):
        for _ in range(rounds):
            centroids = next_centroids(data, centroids)
    found = written(assigned(data, centroids), "assigned")
    digests = [
        (i, hashlib.sha256(",".join(map(str, row)).encode()).hexdigest()) for i, row in enumerate(centroids.tolist())
    ]
    names = vectors.sparkSession.createDataFrame(digests, "cluster int, centroid_sha256 string")
    inertia = found.groupBy("cluster").agg(F.sum("distance").alias("cluster_inertia"))
    total = found.agg(F.sum("distance").alias("inertia"))
    # a row for each centroid, and one row: bounded by the parameter
    facts = inertia.join(F.broadcast(names), "cluster").join(F.broadcast(total))
    return found.join(F.broadcast(facts), "cluster").select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"
    )


def oracle(clusters: int = CLUSTERS, rounds: int = ROUNDS) -> str:
    """The same in DuckDB, with products of components for dot products."""
    steps = [
        f"""v as materialized (
          select row_number() over () as r, vec_id, list_transform(embedding, lambda c: floor({SCALE} * cast(c as double))) as x
          from embeddings
          where len(embedding) = {DIMENSIONS} and len(list_filter(embedding, lambda c: c is null or not isfinite(c))) = 0)""",
        f"""c0 as materialized (
          select row_number() over (order by sha256('2:' || vec_id)) - 1 as cluster, x from v
          qualify row_number() over (order by sha256('2:' || vec_id)) <= {clusters})""",
    ]
    for i in range(rounds + 1):
        steps.append(
            f"""a{i} as materialized (
          select r, vec_id, x, cluster, distance from (
            select v.r, v.vec_id, v.x, c.cluster, cast(list_inner_product(v.x, v.x) + list_inner_product(c.x, c.x)
              - 2 * list_inner_product(v.x, c.x) as bigint) as distance
            from v cross join c{i} as c)
          qualify row_number() over (partition by r order by distance, cluster) = 1)"""
        )
        if i < rounds:
            steps.append(
                f"""c{i + 1} as materialized (
          select c.cluster, coalesce(n.x, c.x) as x from c{i} as c left join (
            select cluster, list(cast((s - ((s % n) + n) % n) // n as double) order by i) as x from (
              select cluster, i, count(*) as n, cast(sum(e) as bigint) as s
              from (select cluster, unnest(x) as e, generate_subscripts(x, 1) as i from a{i}) group by cluster, i)
            group by cluster) as n on c.cluster = n.cluster)"""
            )
    return f"""
        with {", ".join(steps)}
        select a.vec_id, cast(a.cluster as integer) as cluster, a.distance,
          cast(sum(a.distance) over (partition by a.cluster) as bigint) as cluster_inertia,
          cast(sum(a.distance) over () as bigint) as inertia,
          sha256(array_to_string(list_transform(c.x, lambda e: cast(e as bigint)), ',')) as centroid_sha256
        from a{rounds} as a join c{rounds} as c on a.cluster = c.cluster
    """
