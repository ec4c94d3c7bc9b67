"""Centroid clustering with bounds that are loosened by geometry instead of by full drift.

Lloyd's rounds in exact integers. Every vector carries an upper bound on the
distance to its own centroid and a lower bound on the distance to any other.
When centroids move, the upper bound grows by the drift of the own centroid. The
lower bound shrinks, but by less than the largest drift: all vectors of a cluster
lie in a sphere around its old centroid, and the distance from a point of that
sphere to a centroid moving from p to q can shrink by at most |pq| times the
cosine of the smallest angle, seen from the middle of p and q, between the way
of the move and a point of the sphere. By symmetry around the line through p and
q this is plane geometry (:func:`loosening`). Only vectors whose bounds don't
settle them are compared with all centroids, exactly.

Vectors lie in blocks in a table bucketed by block, written once. A round joins
them, bucket by bucket and without a shuffle, with the bounds of the last round,
which are a small table of the same buckets, and writes new ones. The driver
sees k times (dimension + 1) numbers a round: what each cluster gained and lost.
"""

from __future__ import annotations

import hashlib
import math
import uuid
from collections.abc import Iterator
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from notemill.llm.common import released
from notemill.session import saved, scratch_path

BLOCK = 1024                 # vectors of a block
BUCKET_BYTES = 64 << 20      # vectors of a bucket, about
LIMIT = 1 << 27              # integer components beyond this are refused: their squares would not fit
SLACK = 1e-15                # relative rounding error of one step on a bound
ANGLE_SLACK = 1e-7           # the same of a cosine from square roots

STATE = "block bigint, near binary, upper binary, lower binary, scanned bigint, moves array<struct<cluster int, radius double, sums array<bigint>>>"


def kept(vectors: DataFrame, dim: int = 64, scale: int = 1024, id_col: str = "vec_id", column: str = "embedding") -> DataFrame:
    """(_id, _x array<bigint>): floor(scale * x) of vectors with exactly ``dim`` components, none NULL or non-finite."""
    finite = F.forall("_own", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(float("inf"))))
    rows = vectors.select(F.col(id_col).cast("bigint").alias("_id"), F.col(column).cast("array<double>").alias("_own"))
    good = rows.filter(F.col("_own").isNotNull() & (F.size("_own") == dim) & finite)
    return good.select("_id", F.transform("_own", lambda x: F.floor(x * F.lit(float(scale)))).cast("array<bigint>").alias("_x"))


def starts(rows: DataFrame, k: int, seed: int) -> list[list[int]]:
    """The vectors of the ``k`` smallest sha256 of ``seed:id``; equal ids follow their components, NULL ids come last."""
    key = F.coalesce(F.sha2(F.concat(F.lit(f"{seed}:"), F.col("_id").cast("string")), 256), F.lit("~"))
    return [list(r["_x"]) for r in rows.orderBy(key, "_x").limit(k).select("_x").collect()]


def _write_bucketed(df: DataFrame, buckets: int, label: str) -> str:
    """Write ``df`` as a table of ``buckets`` buckets by block below the shared folder; returns its name."""
    name = f"{label}_{uuid.uuid4().hex}"
    df.write.bucketBy(buckets, "block").format("parquet").option("path", scratch_path(df.sparkSession, name)).saveAsTable(name)
    return name


def blocks(rows: DataFrame, size: int = BLOCK) -> DataFrame:
    """(block, ids, x): vectors packed by task, as 32-bit integers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 33
        for batch in batches:
            flat = batch.column(1).flatten().to_numpy(zero_copy_only=False)
            if len(flat) and np.abs(flat).max() > LIMIT:
                raise ValueError(f"a component lies beyond {LIMIT} after scaling: squared distances would not fit in 64 bits")
            x = flat.astype("<i4").reshape(batch.num_rows, -1) if batch.num_rows else flat
            for cut in range(0, batch.num_rows, size):
                ids = pa.array([batch.column(0).slice(cut, size).to_pylist()], pa.list_(pa.int64()))
                yield pa.RecordBatch.from_pydict({"block": pa.array([number], pa.int64()), "ids": ids, "x": [x[cut:cut + size].tobytes()]})
                number += 1

    return rows.mapInArrow(released(run), "block bigint, ids array<bigint>, x binary")


def squared(x: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """Exact squared distances of all ``x`` to all centroids, 64-bit integers."""
    out = np.empty((len(x), len(centroids)), np.int64)
    for j, c in enumerate(centroids):
        apart = x - c
        out[:, j] = np.einsum("ij,ij->i", apart, apart)
    return out


def loosening(before: np.ndarray, after: np.ndarray, radius: np.ndarray) -> np.ndarray:
    """By how much, at most, the distance from any vector of cluster i to any other centroid shrank: one number per cluster.

    The vectors of cluster i lie within ``radius[i]`` of ``before[i]``. For a point at
    angle a (seen from the middle m of p and q) to the way from p to q,
    |xp| - |xq| = 2 |xm| |pq| cos a / (|xp| + |xq|) <= |pq| cos a, as the two sides
    sum to at least 2 |xm|. The sphere takes up the angles within asin(r / |cm|)
    of its centre's.
    """
    k = len(before)
    drift = np.sqrt(((after - before) ** 2).sum(axis=1))
    worst = np.zeros(k)
    for i in range(k):
        for j in range(k):
            if j == i or drift[j] == 0:
                continue
            to_centre = before[i] - (before[j] + after[j]) / 2
            away = math.sqrt(to_centre @ to_centre)
            cosine = 1.0
            if radius[i] < away:
                along = float(to_centre @ (after[j] - before[j])) / (away * drift[j])
                across, sine = math.sqrt(max(0.0, 1 - along * along)), radius[i] / away
                spread = math.sqrt(max(0.0, 1 - sine * sine))
                if along < spread:  # the sphere does not reach the way itself
                    cosine = max(0.0, along * spread + across * sine + ANGLE_SLACK)
            worst[i] = max(worst[i], drift[j] * min(1.0, cosine))
    return worst


def _settle(x: np.ndarray, centroids: np.ndarray, state: tuple | None, drift: np.ndarray, loose: np.ndarray) -> tuple:
    """(near, upper, lower, scanned, near before) of one block after the centroids moved."""
    if state is None:
        near, upper, lower = np.full(len(x), -1, np.int32), np.zeros(len(x)), np.zeros(len(x))
        open_ = np.arange(len(x))
    else:
        near, upper, lower = (a.copy() for a in state)
        upper = (upper + drift[near]) * (1 + SLACK)
        lower = lower - loose[near] - (lower + loose[near]) * SLACK
        open_ = np.flatnonzero(upper >= lower)
        apart = x[open_] - centroids[near[open_]]
        upper[open_] = np.sqrt(np.einsum("ij,ij->i", apart, apart)) * (1 + SLACK)
        open_ = open_[upper[open_] >= lower[open_]]
    old = near.copy()
    if len(open_):
        every = squared(x[open_], centroids)
        near[open_] = every.argmin(axis=1)
        rows = np.arange(len(open_))
        upper[open_] = np.sqrt(every[rows, near[open_]]) * (1 + SLACK)
        lower[open_] = np.inf
        if every.shape[1] > 1:
            every[rows, near[open_]] = np.iinfo(np.int64).max
            lower[open_] = np.sqrt(every.min(axis=1)) * (1 - SLACK)
    return near, upper, lower, len(open_), old


def _moves(x: np.ndarray, near: np.ndarray, old: np.ndarray, upper: np.ndarray, k: int) -> list[dict]:
    """Per cluster of a block: radius of its sphere, and the sums and number of vectors gained less those lost."""
    changed, out = np.flatnonzero(near != old), []
    for c in range(k):
        own = near == c
        gained, lost = changed[near[changed] == c], changed[old[changed] == c]
        if own.any() or len(lost):
            sums = x[gained].sum(axis=0) - x[lost].sum(axis=0)
            out.append({"cluster": c, "radius": float(upper[own].max()) if own.any() else 0.0, "sums": [*sums.tolist(), len(gained) - len(lost)]})
    return out


def _state_row(block: int, settled: tuple, moves: list[dict]) -> pa.Table:
    near, upper, lower, scanned, _ = settled
    return pa.table({
        "block": pa.array([block], pa.int64()), "near": [near.astype("<i4").tobytes()], "upper": [upper.tobytes()], "lower": [lower.tobytes()],
        "scanned": pa.array([scanned], pa.int64()),
        "moves": pa.array([moves], pa.list_(pa.struct([("cluster", pa.int32()), ("radius", pa.float64()), ("sums", pa.list_(pa.int64()))]))),
    })


def _unpacked(vectors: pa.Table, dim: int) -> np.ndarray:
    return np.frombuffer(vectors["x"][0].as_py(), "<i4").reshape(-1, dim).astype(np.int64)


def _bounds(state: pa.Table) -> tuple:
    return tuple(np.frombuffer(state[c][0].as_py(), t) for c, t in (("near", "<i4"), ("upper", np.float64), ("lower", np.float64)))


def assign(vectors: DataFrame, state: DataFrame | None, centroids: list[list[int]], drift: np.ndarray, loose: np.ndarray) -> DataFrame:
    """The state after one assignment; ``state`` is None in the first round."""
    held = np.array(centroids, np.int64)
    dim = held.shape[1]

    def step(block: pa.Table, bounds: tuple | None) -> pa.Table:
        x = _unpacked(block, dim)
        settled = _settle(x, held, bounds, drift, loose)
        return _state_row(block["block"][0].as_py(), settled, _moves(x, settled[0], settled[4], settled[1], len(held)))

    if state is None:
        return vectors.groupBy("block").applyInArrow(lambda block: step(block, None), STATE)
    return vectors.groupBy("block").cogroup(state.drop("moves").groupBy("block")).applyInArrow(lambda block, before: step(block, _bounds(before)), STATE)


def distances(vectors: DataFrame, state: DataFrame, centroids: list[list[int]]) -> DataFrame:
    """(_id, cluster, distance) of every vector: its squared distance to its centroid."""
    held = np.array(centroids, np.int64)

    def own(block: pa.Table, before: pa.Table) -> pa.Table:
        near = _bounds(before)[0]
        apart = _unpacked(block, held.shape[1]) - held[near]
        return pa.table({"_id": block["ids"][0].values, "cluster": pa.array(near, pa.int32()), "distance": pa.array(np.einsum("ij,ij->i", apart, apart), pa.int64())})

    return vectors.groupBy("block").cogroup(state.drop("moves").groupBy("block")).applyInArrow(own, "_id bigint, cluster int, distance bigint")


def _gains(state: DataFrame, k: int, dim: int) -> tuple[list[list[int]], np.ndarray]:
    """Sums (and, last, counts) gained by each cluster, and the radius of its sphere."""
    moves = state.select(F.explode("moves").alias("m")).select("m.cluster", "m.radius", F.posexplode("m.sums").alias("at", "value"))
    gained, radius = [[0] * (dim + 1) for _ in range(k)], np.zeros(k)
    for r in moves.groupBy("cluster", "at").agg(F.sum(F.col("value").cast("decimal(38,0)")).alias("total"), F.max("radius").alias("radius")).collect():
        gained[r["cluster"]][r["at"]] = int(r["total"])
        radius[r["cluster"]] = max(radius[r["cluster"]], r["radius"])
    return gained, radius


def _drop(spark: SparkSession, name: str | None) -> None:
    if name:
        spark.sql(f"DROP TABLE IF EXISTS {name}")


def cluster(
    vectors: DataFrame, k: int = 8, rounds: int = 10, seed: int = 3, dim: int = 64, scale: int = 1024,
    id_col: str = "vec_id", column: str = "embedding", block: int = BLOCK,
) -> tuple[DataFrame, list[list[int]], list[int]]:
    """(rows, centroids, scans): the clusters after ``rounds`` rounds and one more assignment.

    ``rows`` has (vec_id, cluster, distance) of each kept vector; ``scans`` tells
    how many vectors each assignment compared with all centroids. Ties go to the
    smaller number; an empty cluster keeps its centroid. Fewer kept vectors than
    ``k`` give as many centroids as vectors; none give an empty result. Equal rows
    are vectors of their own, so two may start equal centroids, of which the
    second stays empty. NULL ids stay NULL. Components are limited to ``LIMIT``
    after scaling; beyond, an error is raised.
    """
    spark = vectors.sparkSession
    rows = kept(vectors, dim, scale, id_col, column)
    centroids = starts(rows, k, seed)
    if not centroids:
        return spark.createDataFrame([], "vec_id bigint, cluster int, distance bigint"), [], []
    parallel = spark.sparkContext.defaultParallelism
    buckets = max(parallel, -(-vectors.count() * dim * 4 // BUCKET_BYTES))
    packed = _write_bucketed(blocks(rows, block).repartition(buckets, "block"), buckets, "kmeans_blocks")
    count, scans = len(centroids), []
    sums, drift, loose, state = [[0] * (dim + 1) for _ in centroids], np.zeros(count), np.zeros(count), None
    for turn in range(rounds + 1):
        last = state
        state = _write_bucketed(assign(spark.table(packed), spark.table(last) if last else None, centroids, drift, loose), buckets, "kmeans_bounds")
        _drop(spark, last)
        scans.append(spark.table(state).agg(F.sum("scanned")).first()[0])
        if turn == rounds:
            break
        gained, radius = _gains(spark.table(state), count, dim)
        sums = [[a + b for a, b in zip(s, g, strict=True)] for s, g in zip(sums, gained, strict=True)]
        moved = [[v // s[dim] for v in s[:dim]] if s[dim] else c for s, c in zip(sums, centroids, strict=True)]
        if moved == centroids:  # nothing moves from here on, so every later round repeats this one
            break
        before, after = np.array(centroids, float), np.array(moved, float)
        drift, loose, centroids = np.sqrt(((after - before) ** 2).sum(axis=1)) * (1 + SLACK), loosening(before, after, radius) * (1 + SLACK), moved
    found = saved(distances(spark.table(packed), spark.table(state), centroids).withColumnRenamed("_id", "vec_id"), "kmeans-found")
    _drop(spark, state)
    _drop(spark, packed)
    return found, centroids, scans


def with_inertia(found: DataFrame, centroids: list[list[int]]) -> DataFrame:
    """``found`` with the distances summed over cluster and all, and the hash of the cluster's centroid: k rows are joined."""
    spark = found.sparkSession
    totals = {r["cluster"]: int(r["total"]) for r in found.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("total")).collect()}
    digest = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    known = spark.createDataFrame(
        [(c, Decimal(n), digest[c]) for c, n in sorted(totals.items())], "cluster int, cluster_inertia decimal(38,0), centroid_sha256 string"
    )
    # At most k rows.
    return found.join(F.broadcast(known), "cluster").select(
        "vec_id", "cluster", "distance", F.col("cluster_inertia").cast("bigint").alias("cluster_inertia"),
        F.lit(Decimal(sum(totals.values()))).cast("bigint").alias("inertia"), "centroid_sha256",
    )


def lloyd_sql(k: int = 8, rounds: int = 10, seed: int = 3, dim: int = 64, scale: int = 1024) -> str:
    """The same clustering in DuckDB, every distance computed in every round."""
    head = f"""
WITH kept AS MATERIALIZED (
    SELECT row_number() OVER () AS row_id, vec_id, [floor({scale} * x::DOUBLE)::BIGINT for x in embedding] AS v FROM embeddings
    WHERE len(embedding) = {dim} AND len([x for x in embedding if x IS NULL OR NOT isfinite(x::DOUBLE)]) = 0
), c0 AS MATERIALIZED (
    SELECT row_number() OVER (ORDER BY sha256('{seed}:' || vec_id) NULLS LAST, v) - 1 AS cluster, v FROM kept ORDER BY 1 LIMIT {k}
)"""
    steps = []
    for i in range(rounds + 1):
        steps.append(f"""a{i} AS MATERIALIZED (
    SELECT row_id, min(struct_pack(d := list_sum([(p[1] - p[2]) * (p[1] - p[2]) for p in list_zip(k.v, c.v)])::BIGINT, cluster := c.cluster)) AS best
    FROM kept k CROSS JOIN c{i} c GROUP BY row_id
)""")
        if i < rounds:
            steps.append(f"""s{i} AS (
    SELECT cluster, list(f ORDER BY pos) AS v FROM (
        SELECT best.cluster AS cluster, pos, ((sum(x) - ((sum(x) % count(*)) + count(*)) % count(*)) // count(*))::BIGINT AS f
        FROM (SELECT a.best, unnest(k.v) AS x, unnest(range({dim})) AS pos FROM a{i} a JOIN kept k USING (row_id)) GROUP BY 1, 2
    ) GROUP BY cluster
), c{i + 1} AS MATERIALIZED (SELECT c.cluster, coalesce(s.v, c.v) AS v FROM c{i} c LEFT JOIN s{i} s USING (cluster))""")
    return head + ", " + ", ".join(steps) + f"""
SELECT vec_id, best.cluster::INTEGER AS cluster, best.d AS distance, (sum(best.d) OVER (PARTITION BY best.cluster))::BIGINT AS cluster_inertia,
       (sum(best.d) OVER ())::BIGINT AS inertia, sha256(array_to_string(c.v, ',')) AS centroid_sha256
FROM a{rounds} a JOIN kept k USING (row_id) JOIN c{rounds} c ON c.cluster = a.best.cluster
"""
