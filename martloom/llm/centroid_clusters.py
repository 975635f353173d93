"""Clusters around centroids, in exact integers: nearest centroids by progressive Walsh-Hadamard coefficients.

The Walsh-Hadamard transform of 64 integers consists of integers, and squared distances between transforms are 64 times
those between the vectors. Coefficients are taken from coarse (few changes of sign) to fine. After some of them the summed
squares are a lower bound of a distance; the centroid that leads is measured in full, and every centroid whose bound lies
strictly above that distance is out. What is left goes on to finer coefficients, at last to all 64, so the nearest centroid
and ties are exact.

Vectors stay where they are: a round reads them once, each task sends one sum for each centroid and batch, and k rows come
to the driver, which makes the next k centroids.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martloom.llm.common import arrow_map, stored

SIZE, SCALE = 64, 64
CENTROIDS, ROUNDS, SEED = 16, 3, 1
STEPS = (4, 8, 16, 32, 64)  # coefficients looked at before each elimination
BATCH = 4096
# Components up to here keep every sum of squares of 64 coefficients below 2**63; larger ones are worked out in Python's
# own integers.
SAFE = 1 << 23


def integers(values: np.ndarray) -> np.ndarray:
    """floor(64 * x) of each component, exactly: 64-bit numbers where they are safe, else Python integers."""
    scaled = np.floor(values * float(SCALE))
    if not len(values) or np.abs(scaled).max() <= SAFE:
        return scaled.astype(np.int64)
    # 64 * x of a finite double may not be one: multiplied after it is made an integer ratio.
    exact = [[(SCALE * a) // b for a, b in (float(x).as_integer_ratio() for x in row)] for row in values]
    return np.array(exact, dtype=object).reshape(values.shape)


def walsh_hadamard(rows: np.ndarray) -> np.ndarray:
    """The transform of each row (a power of two in length), in natural order."""
    rows = rows.copy()
    width, half = rows.shape[1], 1
    while half < width:
        blocks = rows.reshape(len(rows), width // (2 * half), 2, half)
        low, high = blocks[:, :, 0] + blocks[:, :, 1], blocks[:, :, 0] - blocks[:, :, 1]
        rows = np.stack([low, high], axis=2).reshape(len(rows), width)
        half *= 2
    return rows


def coarse_to_fine(width: int) -> np.ndarray:
    """Coefficients by the number of sign changes of their basis vector."""
    basis = walsh_hadamard(np.eye(width, dtype=np.int64))
    return np.argsort((np.diff(basis, axis=0) != 0).sum(axis=0), kind="stable")


ORDER = coarse_to_fine(SIZE)


def nearest(vectors: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Number of the nearest centroid of each vector (the smaller one of equals) and the squared distance."""
    v, c = walsh_hadamard(vectors)[:, ORDER], walsh_hadamard(centroids)[:, ORDER]
    count, many = len(v), len(c)
    row, centre = np.repeat(np.arange(count), many), np.tile(np.arange(many), count)
    so_far = np.zeros(count * many, dtype=v.dtype)
    begin = 0
    bound = None
    for end in STEPS:
        gap = v[row, begin:end] - c[centre, begin:end]
        so_far = so_far + (gap * gap).sum(axis=1)
        begin = end
        if end == SIZE:
            break
        if bound is None:
            lead = so_far.reshape(count, many).argmin(axis=1)
            gap = v - c[lead]
            bound = (gap * gap).sum(axis=1)
        left = so_far <= bound[row]
        row, centre, so_far = row[left], centre[left], so_far[left]
    # Pairs are in the order of rows and centroids: the first least one of each row wins.
    first = np.flatnonzero(np.diff(row, prepend=-1))
    least = np.minimum.reduceat(so_far, first)
    hit = np.flatnonzero(so_far == np.repeat(least, np.diff(np.append(first, len(row)))))
    pick = hit[np.unique(row[hit], return_index=True)[1]]
    return centre[pick], so_far[pick] // SIZE


def batches_of(batch: pa.RecordBatch, column: str) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    """Runs of rows with their vectors as rows of integers."""
    for at in range(0, batch.num_rows, BATCH):
        part = batch.slice(at, BATCH)
        flat = part.column(column).flatten()
        yield part, integers(np.asarray(flat, dtype=np.float64).reshape(part.num_rows, SIZE))


def kept_vectors(vectors: DataFrame, vec_id: str, embedding: str) -> DataFrame:
    """vec_id and the components, as doubles, of vectors with 64 components, none NULL, NaN or infinite."""
    doubles = F.transform(F.col(embedding), lambda x: x.cast("double")).alias("vector")
    plain = vectors.select(F.col(vec_id).alias("vec_id"), doubles)
    finite = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return plain.where((F.size("vector") == SIZE) & finite)


def first_centroids(kept: DataFrame, many: int, seed: int) -> np.ndarray:
    """The vectors with the smallest hashes of seed and id, in ascending order; of equal ids the smaller vector first."""
    code = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("vec_id").cast("string"), F.lit(""))).cast("binary"), 256)
    rows = kept.select(code.alias("code"), "vector").orderBy("code", "vector").limit(many).collect()
    return integers(np.array([r["vector"] for r in rows], dtype=np.float64).reshape(len(rows), SIZE))


def cluster_sums(kept: DataFrame, centroids: np.ndarray) -> dict[int, tuple[int, list[int]]]:
    """Members and component sums of every cluster that has any: at most one row for each centroid."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, v in batches_of(batch, "vector"):
                cluster, _ = nearest(v, centroids)
                present = np.unique(cluster)
                # Sums as decimal text: they are exact however large the components are.
                sums = [[str(x) for x in v[cluster == c].sum(axis=0)] for c in present]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(present.astype(np.int32)), pa.array(np.bincount(cluster)[present].astype(np.int64)), pa.array(sums)],
                    names=["cluster", "members", "sums"],
                )

    partial = arrow_map(kept.select("vector"), run, "cluster int, members long, sums array<string>")
    added = [F.sum(F.element_at("sums", k + 1).cast("decimal(38,0)")).alias(f"s{k}") for k in range(SIZE)]
    rows = partial.groupBy("cluster").agg(F.sum("members").alias("members"), *added).collect()
    return {r["cluster"]: (r["members"], [int(r[f"s{k}"]) for k in range(SIZE)]) for r in rows}


def moved(centroids: np.ndarray, sums: dict[int, tuple[int, list[int]]]) -> np.ndarray:
    """Centroids after a round: the floor of the mean of their vectors; one without vectors stays."""
    new = centroids.copy()
    for c, (members, total) in sums.items():
        mean = [s // members for s in total]
        if max(map(abs, mean)) > SAFE:
            new = new.astype(object)
        new[c] = mean
    return new


@dataclass
class Clusters:
    """Fitted centroids, one row of integers each."""

    centroids: np.ndarray

    def digest(self, c: int) -> str:
        return hashlib.sha256(",".join(str(int(x)) for x in self.centroids[c]).encode()).hexdigest()


def fit(kept: DataFrame, many: int = CENTROIDS, rounds: int = ROUNDS, seed: int = SEED) -> Clusters:
    """Centroids after some rounds over vectors as kept_vectors gives them; fewer than ``many`` vectors are a centroid each."""
    centroids = first_centroids(kept, many, seed)
    for _ in range(rounds if len(centroids) else 0):
        centroids = moved(centroids, cluster_sums(kept, centroids))
    return Clusters(centroids)


def assigned(kept: DataFrame, clusters: Clusters) -> DataFrame:
    """vec_id, cluster and squared distance of every vector. A distance beyond a long is an error."""
    centroids = clusters.centroids

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, v in batches_of(batch, "vector"):
                cluster, distance = nearest(v, centroids)
                columns = [part.column("vec_id"), pa.array(cluster.astype(np.int32)), pa.array(distance.tolist(), pa.int64())]
                yield pa.RecordBatch.from_arrays(columns, names=["vec_id", "cluster", "distance"])

    kind = kept.schema["vec_id"].dataType.simpleString()
    return arrow_map(kept.select("vec_id", "vector"), run, f"vec_id {kind}, cluster int, distance long")


def clustered(
    vectors: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding", many: int = CENTROIDS, rounds: int = ROUNDS,
    seed: int = SEED,
) -> DataFrame:
    """vec_id, cluster, distance, cluster_inertia, inertia and centroid_sha256 for every vector that is kept.

    Vectors that are NULL, of another length, or with a NULL, NaN or infinite component are left out. Rows with equal ids or
    vectors count each; a NULL id is hashed as empty text. Equal distances go to the smaller centroid. An empty table gives an
    empty result. Other columns are not read.
    """
    kept = kept_vectors(vectors, vec_id, embedding)
    clusters = fit(kept, many, rounds, seed)
    found = stored(assigned(kept, clusters), "assigned")
    # One row for each centroid.
    sums = {r["cluster"]: int(r["d"]) for r in found.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("d")).collect()}
    facts = [(c, total, sum(sums.values()), clusters.digest(c)) for c, total in sums.items()]
    spark = vectors.sparkSession
    about = spark.createDataFrame(facts, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return found.join(F.broadcast(about), "cluster").select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"
    )
