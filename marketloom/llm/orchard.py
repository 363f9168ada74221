"""Centroid clustering of embeddings in exact integers, its nearest centroids found by Orchard's search.

Each centroid has the list of all centroids by distance from it. A search holds a current centroid and walks its list;
a closer centroid (or an equally close one of a smaller number) becomes the current one and the walk starts anew on its list.
Centroids already measured are marked and not measured again. The walk stops where the list is strictly beyond twice
the current distance: by the triangle inequality what follows is farther than the current centroid, ties included. The walks
of all vectors of a batch are made in step, so each step is a few numpy operations.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketloom.llm.common import stored

#: What an embedding must have, how many centroids there are, rounds of moving them, and the grid that components are put on.
DIMENSIONS, CENTROIDS, ROUNDS, GRID = 64, 16, 3, 64
#: Components beyond this would not have a squared distance in 64 bits.
LARGEST = 1 << 27
#: Vectors that walk in step.
STEP = 4096


def quantise(vectors: DataFrame, id_column: str = "vec_id", column: str = "embedding", dimensions: int = DIMENSIONS, grid: int = GRID) -> DataFrame:
    """vec_id and point (array of int, floor(grid * x)) of the vectors with exactly `dimensions` components, none null or non-finite.
    A component beyond LARGEST after that is an error: distances would not fit in 64 bits."""
    x = F.col(column)
    sound = F.coalesce(F.size(x) == dimensions, F.lit(False)) & F.forall(x, lambda v: F.coalesce(~F.isnan(v) & (F.abs(v) < F.lit(float("inf"))), F.lit(False)))
    scaled = F.transform(F.when(sound, x), lambda v: F.floor(F.lit(float(grid)) * v.cast("double")).cast("int"))
    held = vectors.filter(sound).select(F.col(id_column).cast("long").alias("vec_id"), scaled.alias("point"))
    fits = F.forall("point", lambda v: F.abs(v) < LARGEST)
    return held.withColumn("point", F.when(fits, F.col("point")).otherwise(F.raise_error(F.lit("a component is too large"))))


def first_centroids(points: DataFrame, count: int = CENTROIDS) -> np.ndarray:
    """The points of the ids with the least SHA-256 of `1:<id>` (of a null id: `1:`), in that order; points of one id by their components. Fewer where there are fewer points."""
    seeded = points.select(F.sha2(F.concat(F.lit("1:"), F.coalesce(F.col("vec_id").cast("string"), F.lit(""))), 256).alias("seed"), "point")
    rows = seeded.orderBy("seed", "point").limit(count).collect()
    return np.array([r.point for r in rows], np.int64)


class Search:
    """Centroids with their lists of neighbours."""

    def __init__(self, centroids: np.ndarray):
        self.centroids = centroids
        gaps = centroids[:, None, :] - centroids[None, :, :]
        between = (gaps * gaps).sum(axis=2)
        self.near = np.argsort(between, axis=1, kind="stable")
        self.away = np.take_along_axis(between, self.near, axis=1)  # squared, along the lists

    def nearest(self, points: np.ndarray, measured: list[int] | None = None) -> tuple[np.ndarray, np.ndarray]:
        """Number and squared distance of the nearest centroid of each point; of equally near ones the smallest number.
        measured gets how many distances were computed."""
        k, n = len(self.centroids), len(points)
        here, at = np.zeros(n, np.int64), np.zeros(n, np.int64)
        gap = points - self.centroids[0]
        best = (gap * gap).sum(axis=1)
        marked = np.zeros((n, k), bool)
        marked[:, 0] = True
        count = n
        walking = np.arange(n)
        while len(walking):
            on = here[walking]
            walking = walking[self.away[on, at[walking]] <= 4 * best[walking]]  # beyond twice the distance, in squares
            on = here[walking]
            other = self.near[on, at[walking]]
            at[walking] += 1
            new = ~marked[walking, other]
            who, other = walking[new], other[new]
            marked[who, other] = True
            gap = points[who] - self.centroids[other]
            far = (gap * gap).sum(axis=1)
            count += len(who)
            closer = (far < best[who]) | ((far == best[who]) & (other < here[who]))
            who, other = who[closer], other[closer]
            here[who], best[who], at[who] = other, far[closer], 0
            walking = walking[at[walking] < k]
        if measured is not None:
            measured.append(count)
        return here, best


def _points(batch: pa.RecordBatch):
    """The points of a batch, in steps: (from, matrix)."""
    column = batch.column(batch.schema.get_field_index("point"))
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(batch.num_rows, -1)
    for lo in range(0, batch.num_rows, STEP):
        yield lo, flat[lo : lo + STEP]


def assign(points: DataFrame, centroids: np.ndarray) -> DataFrame:
    """vec_id, cluster and distance (squared) of every point."""
    sent = points.sparkSession.sparkContext.broadcast(centroids)  # a bounded number of rows, whatever the table

    def run(batches):
        search = Search(sent.value)
        for batch in batches:
            ids = batch.column(0)
            for lo, matrix in _points(batch):
                cluster, distance = search.nearest(matrix)
                yield pa.RecordBatch.from_arrays([ids.slice(lo, len(matrix)), pa.array(cluster, pa.int32()), pa.array(distance, pa.int64())], names=["vec_id", "cluster", "distance"])

    return points.select("vec_id", "point").mapInArrow(run, "vec_id long, cluster int, distance long")


def moved(points: DataFrame, centroids: np.ndarray) -> np.ndarray:
    """Each centroid at the componentwise floor of the mean of its points; one without points stays. Tasks send a sum a
    centroid and component, so no point is shuffled; sums are exact beyond 64 bits."""
    sent = points.sparkSession.sparkContext.broadcast(centroids)

    def run(batches):
        search = Search(sent.value)
        k, d = sent.value.shape
        total, count = np.zeros((k, d), object), [0] * k
        for batch in batches:
            for _, matrix in _points(batch):
                cluster, _ = search.nearest(matrix)
                for c in np.unique(cluster):
                    own = matrix[cluster == c]
                    total[c] += own.sum(axis=0).astype(object)
                    count[c] += len(own)
        for c in range(k):
            if count[c]:
                yield pa.RecordBatch.from_pydict({"cluster": [c] * d, "axis": list(range(d)), "total": [str(x) for x in total[c]], "n": [count[c]] * d},
                                                 schema=pa.schema([("cluster", pa.int32()), ("axis", pa.int32()), ("total", pa.string()), ("n", pa.int64())]))

    sums = points.select("point").mapInArrow(run, "cluster int, axis int, total string, n long")
    out = centroids.copy()
    for r in sums.groupBy("cluster", "axis").agg(F.sum(F.col("total").cast("decimal(38,0)")).alias("total"), F.sum("n").alias("n")).collect():  # k * dimensions rows
        out[r.cluster, r.axis] = int(r.total) // r.n
    return out


def centroid_digest(centroid: np.ndarray) -> str:
    return hashlib.sha256(",".join(map(str, centroid.tolist())).encode()).hexdigest()


def cluster_vectors(vectors: DataFrame, id_column: str = "vec_id", column: str = "embedding", dimensions: int = DIMENSIONS, count: int = CENTROIDS, rounds: int = ROUNDS) -> tuple[DataFrame, np.ndarray]:
    """The assignment of every kept vector after `rounds` moves of the centroids, stored, and the final centroids.

    Vectors that are null, of another length or with a null or non-finite component are left out. Repeated vectors and ids are kept row by
    row, and equal vectors go to the same cluster; ties go to the smaller number. With fewer vectors than centroids there are as
    many centroids as vectors; no kept vector gives no rows. Further columns are not read, whatever their names.
    """
    points = stored(quantise(vectors, id_column, column, dimensions))
    centroids = first_centroids(points, count)
    if not len(centroids):
        return points.select("vec_id", F.lit(0).alias("cluster"), F.lit(0).cast("long").alias("distance")), centroids
    for _ in range(rounds):
        centroids = moved(points, centroids)
    return stored(assign(points, centroids)), centroids


def cluster_report(vectors: DataFrame) -> DataFrame:
    """vec_id, cluster, distance, cluster_inertia, inertia and centroid_sha256 of every kept vector."""
    assigned, centroids = cluster_vectors(vectors)
    spark = assigned.sparkSession
    sums = {r.cluster: r.s for r in assigned.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).cast("long").alias("s")).collect()}  # a row a centroid
    facts = spark.createDataFrame([(c, int(s), centroid_digest(centroids[c])) for c, s in sums.items()], "cluster int, cluster_inertia long, centroid_sha256 string")
    return assigned.join(F.broadcast(facts), "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", F.lit(sum(map(int, sums.values()))).cast("long").alias("inertia"), "centroid_sha256")


def _oracle() -> str:
    """The rounds written out: every vector against every centroid."""
    nearest = """SELECT vec_id, point, cluster, distance FROM (
        SELECT v.vec_id, v.point, c.cluster, CAST(v.norm - 2 * list_dot_product(v.point, c.point) + c.norm AS BIGINT) AS distance,
            row_number() OVER (PARTITION BY v.row_id ORDER BY v.norm - 2 * list_dot_product(v.point, c.point) + c.norm, c.cluster) AS place
        FROM points v CROSS JOIN {c} c) WHERE place = 1"""
    move = """SELECT c.cluster, coalesce(m.point, c.point) AS point, list_dot_product(coalesce(m.point, c.point), coalesce(m.point, c.point)) AS norm
        FROM {c} c LEFT JOIN (
            SELECT cluster, list(mean ORDER BY axis) AS point FROM (
                SELECT cluster, axis, floor(sum(x) / count(*)) AS mean FROM (SELECT cluster, unnest(point) AS x, generate_subscripts(point, 1) AS axis FROM {a}) GROUP BY cluster, axis)
            GROUP BY cluster) m USING (cluster)"""
    steps = [f"""points AS (
        SELECT vec_id, point, row_id, list_dot_product(point, point) AS norm FROM (
            SELECT vec_id, row_number() OVER () AS row_id, list_transform(embedding, lambda x: floor({GRID} * CAST(x AS DOUBLE))) AS point FROM embeddings
            WHERE len(embedding) = {DIMENSIONS} AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0))""",
             f"c0 AS (SELECT row_number() OVER (ORDER BY sha256('1:' || vec_id)) - 1 AS cluster, point, norm FROM points ORDER BY sha256('1:' || vec_id) LIMIT {CENTROIDS})"]
    for i in range(ROUNDS):
        steps += [f"a{i} AS ({nearest.format(c=f'c{i}')})", f"c{i + 1} AS ({move.format(c=f'c{i}', a=f'a{i}')})"]
    steps.append(f"a{ROUNDS} AS ({nearest.format(c=f'c{ROUNDS}')})")
    return "WITH " + ",\n".join(steps) + f"""
    SELECT a.vec_id, CAST(a.cluster AS INTEGER) AS cluster, a.distance,
        CAST(sum(a.distance) OVER (PARTITION BY a.cluster) AS BIGINT) AS cluster_inertia, CAST(sum(a.distance) OVER () AS BIGINT) AS inertia,
        sha256(array_to_string(list_transform(c.point, lambda x: CAST(CAST(x AS BIGINT) AS VARCHAR)), ',')) AS centroid_sha256
    FROM a{ROUNDS} a JOIN c{ROUNDS} c USING (cluster)"""


ORACLE = _oracle()
