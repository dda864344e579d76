"""Centroid clustering of integer vectors by a tournament of bisectors.

Components become integers, so every step is exact and independent of the order
of rows. For each pair of centroids a < b the bisector is held as an integer
normal ``2 (b - a)`` and threshold ``|b|^2 - |a|^2``: x lies nearer to b where
``normal . x > threshold``. A vector is tried against one bisector per centroid:
the winner so far meets the next number, and zero favours the smaller one, so k - 1
sign tests leave the nearest centroid. Only its distance is computed.

Scale: a round reads the vectors once and sends sums per task, cluster and
component through one small shuffle; the driver holds k centroids, whose table of
bisectors is checked against ``MAX_BISECTOR_BYTES``. No vector is shuffled. The final
assignment is written once to the shared folder and read twice. A lost task reads
its part of the table again; a round's result lives in the driver.

Defined results: vectors of another number of components, null ones, and those
that hold null or non-finite components are left out; vectors with a null id are
assigned, but start no centroid; of equal hashes (repeated ids) the smaller vector
comes first; with fewer vectors than k there are as many centroids; with none of
them the cluster is null. Integers of any size are exact; a distance or sum that a
long can't hold is null. Other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from oreflow.session import work_dir

SCALE = 256
MAX_BISECTOR_BYTES = 64 << 20
#: Below this size of components no product or sum over a vector leaves int64.
SMALL = 1 << 24
CHUNK = 1024
#: Sums travel in pieces of this many bits, so that adding them up in a long can't overflow.
LIMB_BITS = 40
MAX_LONG = (1 << 63) - 1


def to_integers(vectors: np.ndarray, scale: int = SCALE) -> np.ndarray:
    """floor(scale * x) of each component: int64, or Python integers where one is large."""
    with np.errstate(over="ignore"):
        scaled = np.floor(vectors * float(scale))
    if not scaled.size or np.abs(scaled).max() < SMALL:
        return scaled.astype(np.int64)
    whole = 2.0**53  # a double of this size is an integer
    exact = [[int(x) * scale if abs(x) >= whole else math.floor(x * scale) for x in row] for row in vectors.tolist()]
    return np.array(exact, object).reshape(vectors.shape)


@dataclass
class Bisectors:
    """Centroids (k x d) with the normal and threshold of each pair."""

    centroids: np.ndarray
    normals: np.ndarray
    thresholds: np.ndarray

    @classmethod
    def of(cls, centroids: np.ndarray) -> Bisectors:
        k, d = centroids.shape
        if 8 * k * k * d > MAX_BISECTOR_BYTES:
            raise ValueError(f"bisectors of {k} centroids are more than {MAX_BISECTOR_BYTES} bytes for every task")
        norms = (centroids * centroids).sum(axis=1)
        return cls(centroids, 2 * (centroids[None, :, :] - centroids[:, None, :]), norms[None, :] - norms[:, None])

    def nearest(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Number of the nearest centroid of each vector, the smaller one of equals, and the squared distance."""
        cluster, distance = [], []
        for low in range(0, len(vectors), CHUNK):
            part = vectors[low : low + CHUNK]
            winner = np.zeros(len(part), np.int64)
            for rival in range(1, len(self.centroids)):
                side = (self.normals[winner, rival] * part).sum(axis=1) - self.thresholds[winner, rival]
                winner[side > 0] = rival
            gap = part - self.centroids[winner]
            cluster.append(winner)
            distance.append((gap * gap).sum(axis=1))
        return np.concatenate(cluster), np.concatenate(distance)


def _limbs(value: int) -> Iterator[tuple[int, int]]:
    """(place, piece) with value = sum of piece * 2**(LIMB_BITS * place)."""
    place = 0
    while value not in (0, -1):
        yield place, value & ((1 << LIMB_BITS) - 1)
        value >>= LIMB_BITS
        place += 1
    if value:
        yield place, value


def usable_vectors(batch: pa.RecordBatch, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Row numbers and components of the vectors with exactly ``size`` finite components."""
    column = batch.column("embedding")
    offsets = column.offsets.to_numpy()
    values = column.values.to_numpy(zero_copy_only=False).astype(np.float64, copy=False)
    rows = np.flatnonzero(column.is_valid().to_numpy(zero_copy_only=False) & (np.diff(offsets) == size))
    vectors = values[offsets[rows][:, None] + np.arange(size)]
    finite = np.isfinite(vectors).all(axis=1)
    return rows[finite], vectors[finite]


def _kept(batches: Iterable[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows, _ = usable_vectors(batch, size)
        yield batch.take(pa.array(rows))


def _sums(batches: Iterable[pa.RecordBatch], size: int, bisectors: Bisectors) -> Iterator[pa.RecordBatch]:
    """Sum of every cluster's components in this task, and at place ``size`` the number of its vectors."""
    k = len(bisectors.centroids)
    totals = np.zeros((k, size + 1), object)
    for batch in batches:
        _, vectors = usable_vectors(batch, size)
        vectors = to_integers(vectors)
        if not len(vectors):
            continue
        cluster, _ = bisectors.nearest(vectors)
        part = np.zeros((k, size + 1), vectors.dtype)
        np.add.at(part[:, :size], cluster, vectors)
        part[:, size] = np.bincount(cluster, minlength=k)
        totals = totals + part
    rows = [(c, p, limb, piece) for (c, p), value in np.ndenumerate(totals) for limb, piece in _limbs(int(value))]
    names, kinds = ["cluster", "place", "limb", "total"], [pa.int32(), pa.int32(), pa.int32(), pa.int64()]
    if rows:
        yield pa.RecordBatch.from_arrays([pa.array(list(x), kind) for x, kind in zip(zip(*rows), kinds)], names)


def _assigned(batches: Iterable[pa.RecordBatch], size: int, bisectors: Bisectors | None) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows, vectors = usable_vectors(batch, size)
        ids = batch.column("vec_id").take(pa.array(rows))
        if bisectors is None or not len(rows):
            cluster, distance = pa.nulls(len(rows), pa.int32()), pa.nulls(len(rows), pa.int64())
        else:
            found, far = bisectors.nearest(to_integers(vectors))
            cluster = pa.array(found.astype(np.int32))
            distance = pa.array([x if x <= MAX_LONG else None for x in far.tolist()], pa.int64())
        yield pa.RecordBatch.from_arrays([ids, cluster, distance], ["vec_id", "cluster", "distance"])


def _vectors(embeddings: DataFrame) -> DataFrame:
    kind = dict(embeddings.dtypes)["embedding"]
    vector = F.col("embedding") if kind in ("array<float>", "array<double>") else F.col("embedding").cast("array<double>")
    return embeddings.select(F.col("vec_id").cast("long").alias("vec_id"), vector.alias("embedding"))


def starting_centroids(embeddings: DataFrame, size: int, k: int, seed: int) -> np.ndarray:
    """The k kept vectors with the smallest SHA-256 of ``seed:vec_id``, as integers."""
    rows = _vectors(embeddings)
    kept = rows.mapInArrow(lambda batches: _kept(batches, size), rows.schema).filter("vec_id IS NOT NULL")
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256)
    found = kept.orderBy(digest, "embedding").limit(k).collect()
    return to_integers(np.array([r["embedding"] for r in found], np.float64).reshape(len(found), size))


def next_centroids(embeddings: DataFrame, centroids: np.ndarray) -> np.ndarray:
    """One round: every non-empty centroid becomes the floor of its vectors' mean."""
    size, bisectors = centroids.shape[1], Bisectors.of(centroids)
    sums = _vectors(embeddings).mapInArrow(
        lambda batches: _sums(batches, size, bisectors), "cluster int, place int, limb int, total long"
    )
    totals = np.zeros((len(centroids), size + 1), object)
    for row in sums.groupBy("cluster", "place", "limb").agg(F.sum("total").alias("total")).collect():
        totals[row["cluster"], row["place"]] += row["total"] << (LIMB_BITS * row["limb"])
    out = centroids.astype(object)
    for cluster in np.flatnonzero(totals[:, size]):
        out[cluster] = totals[cluster, :size] // totals[cluster, size]
    return out.astype(np.int64) if np.abs(out).max() < SMALL else out


def cluster_vectors(embeddings: DataFrame, size: int = 64, k: int = 40, rounds: int = 5, seed: int = 2) -> DataFrame:
    """(vec_id, cluster, distance, cluster_inertia, inertia, centroid) of every kept vector after ``rounds`` rounds."""
    spark = embeddings.sparkSession
    centroids = starting_centroids(embeddings, size, k, seed)
    for _ in range(rounds if len(centroids) else 0):
        centroids = next_centroids(embeddings, centroids)
    bisectors = Bisectors.of(centroids) if len(centroids) else None
    path = work_dir(spark, "clusters")
    assigned = _vectors(embeddings).mapInArrow(
        lambda batches: _assigned(batches, size, bisectors), "vec_id long, cluster int, distance long"
    )
    assigned.write.parquet(path)
    stored = spark.read.schema("vec_id long, cluster int, distance long").parquet(path)
    if bisectors is None:
        nothing = [F.lit(None).cast("long").alias(x) for x in ("cluster_inertia", "inertia")]
        return stored.select("*", *nothing, F.lit(None).cast("string").alias("centroid"))
    inertia = {}
    unknown = F.count_if(F.col("distance").isNull()) > 0
    exact = F.sum(F.col("distance").cast("decimal(19,0)"))
    for row in stored.groupBy("cluster").agg(F.when(~unknown, exact).alias("total")).collect():  # at most k rows
        inertia[row["cluster"]] = None if row["total"] is None else int(row["total"])
    whole = None if None in inertia.values() else sum(inertia.values())
    inertia = {c: x if x is not None and x <= MAX_LONG else None for c, x in inertia.items()}
    per_cluster = F.array(*[F.lit(inertia.get(c, 0)).cast("long") for c in range(len(centroids))])
    names = F.array(*[F.lit(",".join(map(str, row))) for row in centroids.tolist()])
    return stored.select(
        "*", F.get(per_cluster, F.col("cluster")).alias("cluster_inertia"),
        F.lit(whole if whole is not None and whole <= MAX_LONG else None).cast("long").alias("inertia"),
        F.get(names, F.col("cluster")).alias("centroid"),
    )


def with_digests(clustered: DataFrame) -> DataFrame:
    return clustered.select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", F.sha2("centroid", 256).alias("centroid_sha256")
    )


def clustering_sql(size: int = 64, k: int = 40, rounds: int = 5, seed: int = 2) -> str:
    """The same rows in SQL (DuckDB), each distance computed in full."""
    parts = [f"""
WITH kept AS MATERIALIZED (
    SELECT row_number() OVER () AS row_id, vec_id,
           list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
    FROM embeddings WHERE len(embedding) = {size}
      AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0
), cells AS MATERIALIZED (
    SELECT row_id, place, v[place + 1] AS x FROM kept, (SELECT unnest(range({size})) AS place)
), centroids0 AS MATERIALIZED (
    SELECT cluster, place, v[place + 1] AS c FROM (
        SELECT row_number() OVER (ORDER BY sha256('{seed}:' || vec_id), v) - 1 AS cluster, v FROM kept WHERE vec_id IS NOT NULL
    ), (SELECT unnest(range({size})) AS place) WHERE cluster < {k}
)"""]
    for i in range(rounds + 1):
        parts.append(f""", distances{i} AS (
    SELECT row_id, cluster, sum((x - c) * (x - c)) AS distance FROM cells JOIN centroids{i} USING (place) GROUP BY 1, 2
), nearest{i} AS MATERIALIZED (
    SELECT row_id, cluster, distance FROM distances{i}
    QUALIFY row_number() OVER (PARTITION BY row_id ORDER BY distance, cluster) = 1
)""")
        if i < rounds:
            parts.append(f""", sums{i} AS (
    SELECT cluster, place, sum(x) AS s, count(*) AS n FROM cells JOIN nearest{i} USING (row_id) GROUP BY 1, 2
), centroids{i + 1} AS MATERIALIZED (
    SELECT o.cluster, o.place, CASE WHEN n IS NULL THEN c ELSE (s - ((s % n) + n) % n) // n END AS c
    FROM centroids{i} o LEFT JOIN sums{i} USING (cluster, place)
)""")
    parts.append(f"""
SELECT vec_id, CAST(cluster AS INTEGER) AS cluster, CAST(distance AS BIGINT) AS distance,
       CAST(sum(distance) OVER (PARTITION BY cluster) AS BIGINT) AS cluster_inertia,
       CAST(sum(distance) OVER () AS BIGINT) AS inertia, centroid_sha256
FROM kept JOIN nearest{rounds} USING (row_id)
JOIN (SELECT cluster, sha256(string_agg(CAST(c AS VARCHAR), ',' ORDER BY place)) AS centroid_sha256
      FROM centroids{rounds} GROUP BY 1) USING (cluster)""")
    return "".join(parts)
