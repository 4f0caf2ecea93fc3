"""Centroid clustering with an n-simplex filter (operator 12).

Vectors are placed by their distances to some pivots they have in common: these are turned into coordinates of the apex of a simplex over
the pivots. Of two apexes, the Euclidean distance is at most that of the
vectors, and with one of them mirrored in the pivots' plane at least that. The
apex of a row never changes, so it is computed once and written with the row;
a centroid's apex is computed once a round. A centroid whose lower bound
exceeds another's upper bound is not the nearest one; the others are compared
exactly, in integers.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import give_back
from quarry.llm.vectors import LONG_MAX, as_long, integer_vectors, matrix, squares
from quarry.session import materialize


def simplex(pivots):
    """(rows of pivots used, their coordinates): a base simplex, pivot by pivot; such as hardly leave the others' plane are left out.

    Coordinates are divided by a pivot's height over the plane of those before it,
    so a small one would cost digits.
    """
    import numpy as np

    p = np.asarray(pivots, float)
    used = [0]
    base = np.zeros((1, 0))
    for i in range(1, len(p)):
        apex = apexes(np.linalg.norm(p[used] - p[i], axis=1)[None], base)[0]
        if apex[-1] > max(1.0, 0.01 * np.linalg.norm(p[i] - p[0])):
            base = np.vstack([np.hstack([base, np.zeros((len(base), 1))]), apex])
            used.append(i)
    return used, base


def apexes(distances, base):
    """Apex coordinates (m, k) over ``base`` (k pivots in k - 1 dimensions) from distances to the pivots (m, k).

    The last coordinate is the height over the pivots' plane, never negative.
    """
    import numpy as np

    k = len(base)
    out = np.zeros((len(distances), k))
    sq = distances**2
    for i in range(1, k):  # pivot i has its last coordinate in dimension i - 1
        own = base[i, :i]
        # |x - b_0|^2 - |x - b_i|^2 = 2 x . b_i - |b_i|^2, as b_0 is the origin
        out[:, i - 1] = (sq[:, 0] - sq[:, i] + own @ own - 2 * out[:, : i - 1] @ own[: i - 1]) / (2 * own[i - 1])
    out[:, k - 1] = np.sqrt(np.maximum(sq[:, 0] - (out[:, : k - 1] ** 2).sum(axis=1), 0))
    return out


def distances(x, pivots):
    """Euclidean distances (m, k) as doubles."""
    import numpy as np

    d2 = np.stack([((x - p) ** 2).sum(axis=1) for p in np.asarray(pivots, float)], axis=1)
    return np.sqrt(d2)


class Nearest:
    """The nearest of a round's centroids, ties to the smaller number."""

    def __init__(self, centroids, pivots, base):
        import numpy as np

        self.centroids = np.asarray(centroids, np.int64)
        self.apex = apexes(distances(self.centroids.astype(float), pivots), base)
        self.most = int(max(abs(int(self.centroids.min())), abs(int(self.centroids.max()))))

    def candidates(self, apex):
        """Boolean (m, centroids): those that the bounds leave."""
        import numpy as np

        c = self.apex
        flat = (apex[:, :-1] ** 2).sum(axis=1)[:, None] + (c[:, :-1] ** 2).sum(axis=1) - 2 * apex[:, :-1] @ c[:, :-1].T
        a, b = apex[:, -1:], c[:, -1]
        size = (apex**2).sum(axis=1)[:, None] + (c**2).sum(axis=1)
        # apexes are kept as 32-bit floats: what rounding can change is granted to every centroid
        slack = 1e-6 * size + 1e-3
        low = flat + (a - b) ** 2 - slack
        high = flat + (a + b) ** 2 + slack
        return low <= high.min(axis=1, keepdims=True)

    def assign(self, x, apex):
        """(centroid, squared distance) of each row."""
        import numpy as np

        row, at = np.nonzero(self.candidates(apex))
        most = max(self.most, int(max(abs(int(x.min())), abs(int(x.max()))))) if len(x) else 0
        best = np.full(len(x), -1, np.int64)
        found = np.zeros(len(x), np.int64 if 4 * most * most * x.shape[1] <= LONG_MAX else object)
        first = np.flatnonzero(np.concatenate([[True], row[1:] != row[:-1]])) if len(row) else np.zeros(0, np.int64)
        step = 1 << 17
        d = [
            squares(x[row[i : i + step]] - self.centroids[at[i : i + step]], 2 * most)
            if most < 1 << 62
            else squares(x[row[i : i + step]].astype(object) - self.centroids[at[i : i + step]], 2 * most)
            for i in range(0, len(row), step)
        ]
        if not d:
            return best, found
        d = np.concatenate(d)
        if d.dtype == object:
            for r, a, v in zip(row, at, d, strict=True):  # at rises within a row
                if best[r] < 0 or v < found[r]:
                    best[r], found[r] = a, v
            return best, found
        least = np.minimum.reduceat(d, first)
        hit = np.flatnonzero(d == np.repeat(least, np.diff(np.concatenate([first, [len(d)]]))))
        rows, where = np.unique(row[hit], return_index=True)  # the first of a row's nearest
        best[rows], found[rows] = at[hit[where]], d[hit[where]]
        return best, found


def first_by_hash(vectors: DataFrame, key: str, k: int, seed: int):
    """The ``k`` vectors of least sha256 of ``seed:key``, in that order; among equal keys by their packed bytes."""
    h = F.sha2(F.concat(F.lit(f"{seed}:"), F.col(key).cast("string")).cast("binary"), 256)
    top = vectors.select(h.alias("h"), "size", "x").orderBy(F.asc_nulls_last("h"), "x").limit(k).toArrow()  # k rows
    return matrix(top.column("x"), top.column("size")[0].as_py()) if top.num_rows else None


def cluster(rows: DataFrame, key: str = "vec_id", vector: str = "embedding", size: int = 64, scale: int = 256, k: int = 40, rounds: int = 5, pivots: int = 56, seed: int = 2):
    """(rows with cluster and distance, final centroids): Lloyd's rounds in exact integers.

    Takes vectors of exactly ``size`` entries, none null or non-finite, as
    floor(scale * entry). Centroids start as the ``k`` vectors of least sha256 of
    ``seed:key``; each round assigns every vector to the nearest (squared
    distance, ties to the smaller number) and replaces each centroid that has
    vectors by the floor of their mean; then all are assigned once more. The
    returned rows are (key, cluster, distance) and have been written.

    Fewer vectors than ``k`` are as many centroids. Repeated keys and vectors
    count each; a null key's hash ranks last; an empty table gives no rows and
    no centroids. Distances beyond a long are held at its end. Only the first
    vectors and ``k`` sums ever reach the driver. The result does not depend on
    ``pivots``, the vectors of least hash that span the simplex: the more there are,
    the closer the bounds.
    """
    import numpy as np

    spark = rows.sparkSession
    given = materialize(integer_vectors(rows, key, vector, scale, size), "cluster-vectors")
    first = first_by_hash(given, key, max(k, pivots), seed)
    if first is None:
        return given.select(key, F.lit(0).alias("cluster"), F.lit(0).cast("bigint").alias("distance")), np.zeros((0, size), np.int64)
    centroids = first[:k]
    used, base = simplex(first[:pivots])
    pivot = spark.sparkContext.broadcast((first[used].astype(float), base))

    def project(batches: Iterator) -> Iterator:
        import pyarrow as pa

        p, b0 = pivot.value
        for b in batches:
            a = apexes(distances(matrix(b.column(1), size).astype(float), p), b0)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array([r.tobytes() for r in a.astype("<f4")], pa.binary())], ["k", "x", "apex"])

    x = given.select(F.col(key).alias("k"), "x").mapInArrow(project, "k bigint, x binary, apex binary")
    x = materialize(x, "cluster-apexes")
    for _ in range(rounds):
        centroids = moved(x, centroids, pivot, size)
    got = assigned(x, spark.sparkContext.broadcast(centroids), pivot, size)
    out = materialize(got.withColumnRenamed("k", key), "cluster-rows")
    pivot.unpersist()
    return out, centroids


def _batches(batches: Iterator, centroids, pivot, size: int) -> Iterator:
    import numpy as np

    near = Nearest(centroids.value, *pivot.value)
    for b in batches:
        if b.num_rows:
            x = matrix(b.column(1), size)
            apex = np.frombuffer(b"".join(b.column(2).to_pylist()), "<f4").astype(float).reshape(len(x), -1)
            yield b, x, *near.assign(x, apex)


def moved(x: DataFrame, centroids, pivot, size: int):
    """The centroids after one round: exact sums per task, then over all tasks."""
    import numpy as np

    held = x.sparkSession.sparkContext.broadcast(centroids)

    def sums(batches: Iterator) -> Iterator:
        import pyarrow as pa

        total, count = np.zeros((len(centroids_shape), size), object), np.zeros(len(centroids_shape), np.int64)
        for _, v, own, _ in _batches(batches, held, pivot, size):
            order = np.argsort(own, kind="stable")
            own, v = own[order], v[order]
            first = np.flatnonzero(np.concatenate([[True], own[1:] != own[:-1]]))
            count += np.bincount(own, minlength=len(count))
            # 32-bit halves, so that no sum of a batch leaves a long
            low, high = v & 0xFFFFFFFF, v >> 32
            total[own[first]] += np.add.reduceat(low, first).astype(object) + (np.add.reduceat(high, first).astype(object) << 32)
        c, d = np.divmod(np.arange(total.size), size)
        some = count[c] > 0
        c, d = c[some], d[some]
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, pa.int32()), pa.array(d, pa.int32()), pa.array([str(i) for i in total.ravel()[some]], pa.string()), pa.array(count[c], pa.int64())], ["c", "d", "s", "n"]
        )
        give_back()

    centroids_shape = range(len(centroids))
    per = x.mapInArrow(sums, "c int, d int, s string, n bigint").withColumn("s", F.col("s").cast("decimal(38,0)"))
    new = centroids.copy()
    for r in per.groupBy("c", "d").agg(F.sum("s").alias("s"), F.sum("n").alias("n")).collect():  # k x size rows
        new[r["c"], r["d"]] = int(r["s"]) // r["n"]
    held.destroy()
    return new


def assigned(x: DataFrame, centroids, pivot, size: int) -> DataFrame:
    """(k, cluster, distance) of every row."""

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for b, _, own, d in _batches(batches, centroids, pivot, size):
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(own, pa.int32()), as_long(d)], ["k", "cluster", "distance"])

    return x.mapInArrow(run, "k bigint, cluster int, distance bigint")


def with_totals(clustered: DataFrame, centroids) -> DataFrame:
    """``clustered`` with cluster_inertia, inertia and the centroid's sha256; one row per cluster is broadcast."""
    import hashlib

    total = clustered.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("s")).collect()  # k rows
    whole = sum(int(r["s"]) for r in total)
    held = lambda v: min(int(v), LONG_MAX)
    named = [(r["cluster"], held(r["s"]), held(whole), hashlib.sha256(",".join(map(str, centroids[r["cluster"]].tolist())).encode()).hexdigest()) for r in total]
    per = clustered.sparkSession.createDataFrame(named, "cluster int, cluster_inertia bigint, inertia bigint, centroid_sha256 string")
    return clustered.join(F.broadcast(per), "cluster")
