"""Centroid clustering of integer vectors with an incremental distance matrix.

Each vector is stored with its exact integer dot product with every centroid. A round takes the nearest centroid from these
products (the squared distance is |v|^2 - 2 v.c + |c|^2), sums the vectors of each cluster, and corrects the stored products
by the components in which a centroid has changed: v.c' = v.c + the sum of v_j (c'_j - c_j) over the j that differ. No distance
is computed anew from whole vectors.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._store import drop, save

COMPONENTS, CENTROIDS, ROUNDS, SCALE, SEED = 64, 16, 3, 64, 1
#: Largest size of an integer component: squared distances of 64 components then fit a long.
LARGEST = 1 << 27
_STATE = "vec_id long, v array<long>, dots array<long>"


def quantised(vectors: DataFrame, components: int = COMPONENTS, scale: int = SCALE) -> DataFrame:
    """vec_id and v, the integers floor(scale * x), of the vectors with exactly ``components`` finite components.

    Null vectors, shorter and longer ones, and vectors with a null, NaN or infinite component are not kept. Repeated rows and
    null ids stay. A component of more than 2**27 in size ends the job with an error, as distances might not fit a long.
    """
    x = F.transform("embedding", lambda c: c.cast("double"))
    finite = F.forall(x, lambda c: F.coalesce((c > float("-inf")) & (c < float("inf")), F.lit(False)))  # NaN is above all
    small = F.transform("_x", lambda c: F.when(F.abs(c) * scale <= LARGEST, F.floor(c * float(scale))).otherwise(F.raise_error(F.lit(f"a component is larger than {LARGEST} after scaling"))).cast("long"))
    kept = vectors.where((F.size("embedding") == components) & finite).select(F.col("vec_id").cast("long").alias("vec_id"), x.alias("_x"))
    return kept.select("vec_id", small.alias("v"))


def first_centroids(kept: DataFrame, k: int = CENTROIDS, seed: int = SEED) -> list[list[int]]:
    """The vectors of the k smallest SHA-256 of ``seed:vec_id``; null ids come last, equal ids in the order of their components."""
    key = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256)
    return [list(r.v) for r in kept.orderBy(key.asc_nulls_last(), "v").limit(k).select("v").collect()]


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, width)


def _corrected(table: DataFrame, old: list[list[int]], new: list[list[int]]) -> DataFrame:
    """``table`` with the dot products of ``new`` in place of those of ``old``."""
    width = len(new[0])
    changes = []
    for k, (a, b) in enumerate(zip(old, new, strict=True)):
        at = [j for j in range(width) if a[j] != b[j]]
        if at:
            changes.append((k, np.array(at), np.array([b[j] - a[j] for j in at], dtype=np.int64)))
    count = len(new)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            v, dots = _matrix(batch.column("v"), width), _matrix(batch.column("dots"), count).copy()
            for k, at, by in changes:
                dots[:, k] += v[:, at] @ by
            ends = pa.array(np.arange(batch.num_rows + 1, dtype=np.int32) * count)
            yield pa.RecordBatch.from_arrays([batch.column("vec_id"), batch.column("v"), pa.ListArray.from_arrays(ends, pa.array(dots.ravel()))], ["vec_id", "v", "dots"])

    return table.mapInArrow(rows, _STATE)


def _nearest(dots: np.ndarray, norms: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Number of the nearest centroid, the smaller of equals, and its squared distance less |v|^2."""
    part = norms[None, :] - 2 * dots
    best = part.argmin(axis=1)
    return best, part[np.arange(len(part)), best]


def _norms(centroids: list[list[int]]) -> np.ndarray:
    return np.array([sum(x * x for x in c) for c in centroids], dtype=np.int64)


def _moved(table: DataFrame, centroids: list[list[int]]) -> list[list[int]]:
    """The floors of the means of each centroid's vectors; a centroid without vectors stays."""
    width, count, norms = len(centroids[0]), len(centroids), _norms(centroids)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, n = np.zeros((count, width), dtype=np.int64), np.zeros(count, dtype=np.int64)
        for batch in batches:
            v = _matrix(batch.column("v"), width)
            best, _ = _nearest(_matrix(batch.column("dots"), count), norms)
            np.add.at(sums, best, v)
            n += np.bincount(best, minlength=count)
        full = np.flatnonzero(n)
        ends = pa.array(np.arange(len(full) + 1, dtype=np.int32) * width)
        yield pa.RecordBatch.from_arrays([pa.array(full.astype(np.int32)), pa.array(n[full]), pa.ListArray.from_arrays(ends, pa.array(sums[full].ravel()))], ["cluster", "n", "sums"])

    parts = table.mapInArrow(rows, "cluster int, n long, sums array<long>")
    found = parts.groupBy("cluster").agg(F.sum("n").alias("n"), F.array(*[F.sum(F.col("sums")[j]) for j in range(width)]).alias("sums"))
    out = list(centroids)
    for r in found.collect():  # one row for each centroid
        out[r.cluster] = [s // r.n for s in r.sums]
    return out


def cluster(vectors: DataFrame, k: int = CENTROIDS, rounds: int = ROUNDS, seed: int = SEED, components: int = COMPONENTS, scale: int = SCALE) -> DataFrame:
    """``vectors`` (vec_id, embedding) → vec_id, cluster, distance (squared), cluster_inertia, inertia and centroid (its components).

    Centroids start as the vectors of ``first_centroids`` (fewer than k vectors: as many centroids), move ``rounds`` times to the
    floors of their vectors' means, and all vectors are assigned once more. Ties go to the smaller number. Rows that
    ``quantised`` does not keep have no result; repeated rows and null ids have one each; equal starting vectors leave the
    later centroid empty, and it stays where it is. An empty table gives an empty one. Other columns are not read. The driver and
    every task hold k centroids; all else stays in the table, which each round writes anew to the shared folder.
    """
    spark = vectors.sparkSession
    kept = quantised(vectors.select("vec_id", "embedding"), components, scale)
    centroids = first_centroids(kept, k, seed)
    if not centroids:
        return spark.createDataFrame([], "vec_id long, cluster int, distance long, cluster_inertia long, inertia long, centroid array<long>")
    blank = kept.withColumn("dots", F.array_repeat(F.lit(0).cast("long"), len(centroids)))
    table = save(_corrected(blank, [[0] * components] * len(centroids), centroids), "dots")
    for _ in range(rounds):
        moved = _moved(table, centroids)
        if moved != centroids:
            after = save(_corrected(table, centroids, moved), "dots")
            drop(table)
            table, centroids = after, moved
    norms, count = _norms(centroids), len(centroids)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            v = _matrix(batch.column("v"), components)
            best, part = _nearest(_matrix(batch.column("dots"), count), norms)
            yield pa.RecordBatch.from_arrays([batch.column("vec_id"), pa.array(best.astype(np.int32)), pa.array((v * v).sum(axis=1) + part)], ["vec_id", "cluster", "distance"])

    assigned = save(table.mapInArrow(rows, "vec_id long, cluster int, distance long"), "clusters")
    drop(table)
    inertia = {r.cluster: r.s for r in assigned.groupBy("cluster").agg(F.sum("distance").alias("s")).collect()}  # a row for each centroid
    own = F.create_map(*[F.lit(x) for c in range(count) for x in (c, inertia.get(c, 0))])
    places = F.array(*[F.array(*[F.lit(x).cast("long") for x in c]) for c in centroids])
    return assigned.select("vec_id", "cluster", "distance", own[F.col("cluster")].cast("long").alias("cluster_inertia"), F.lit(sum(inertia.values())).cast("long").alias("inertia"), F.element_at(places, F.col("cluster") + 1).alias("centroid"))


def op13_query(spark, sf_dir: str) -> DataFrame:
    """Every row of ``embeddings`` that ``quantised`` keeps, as ``cluster`` assigns it, with the digest of its centroid."""
    found = cluster(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
    digest = F.sha2(F.array_join(F.transform("centroid", lambda x: x.cast("string")), ","), 256)
    return found.select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", digest.alias("centroid_sha256"))


def _round(i: int) -> str:
    return f"""
d{i} AS (SELECT w.rid, w.v, c.k, list_sum([(w.v[i] - c.c[i]) * (w.v[i] - c.c[i]) FOR i IN range(1, {COMPONENTS + 1})]) AS d FROM kept w, c{i} c),
a{i} AS (SELECT rid, any_value(v) AS v, min(struct_pack(d := CAST(d AS BIGINT), k := k)) AS best FROM d{i} GROUP BY rid)"""


def _move(i: int) -> str:
    return f""",
m{i} AS (SELECT k, list(CAST((s - ((s % n) + n) % n) // n AS BIGINT) ORDER BY i) AS c
  FROM (SELECT best.k AS k, i, CAST(sum(v[i]) AS BIGINT) AS s, CAST(count(*) AS BIGINT) AS n FROM a{i}, range(1, {COMPONENTS + 1}) t(i) GROUP BY 1, 2) GROUP BY k),
c{i + 1} AS (SELECT c.k, coalesce(m.c, c.c) AS c FROM c{i} c LEFT JOIN m{i} m ON m.k = c.k),"""


ORACLE = f"""
WITH kept AS (SELECT row_number() OVER () AS rid, vec_id, [CAST(floor({SCALE} * CAST(x AS DOUBLE)) AS BIGINT) FOR x IN embedding] AS v FROM embeddings
  WHERE len(embedding) = {COMPONENTS} AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
c0 AS (SELECT CAST(r - 1 AS INT) AS k, v AS c FROM (SELECT v, row_number() OVER (ORDER BY sha256('{SEED}:' || vec_id) NULLS LAST, v) AS r FROM kept) WHERE r <= {CENTROIDS}),
{"".join(_round(i) + _move(i) for i in range(ROUNDS))}{_round(ROUNDS)},
sums AS (SELECT best.k AS k, sum(best.d) AS s FROM a{ROUNDS} GROUP BY 1)
SELECT w.vec_id, a.best.k AS cluster, a.best.d AS distance, CAST(s.s AS BIGINT) AS cluster_inertia, CAST((SELECT sum(s) FROM sums) AS BIGINT) AS inertia, sha256(array_to_string(c.c, ',')) AS centroid_sha256
FROM kept w JOIN a{ROUNDS} a ON a.rid = w.rid JOIN sums s ON s.k = a.best.k JOIN c{ROUNDS} c ON c.k = a.best.k
"""
