"""Embedding whitening by incremental eigendecomposition (operator 13).

A task keeps mean, eigenvalues and eigenvectors of the scatter of the vectors
it has met. A new vector, centred on the mean so far, is a rank-one update:
with z, its coordinates in the eigenvectors, the new eigenvalues are the roots
of the secular equation 1 + sum z_i^2 / (d_i - t) = 0, one between any two of
the old ones. Directions that z does not touch are deflated, and so are all
but one of each group of equal eigenvalues. Eigenvectors come from the z that
belongs to the computed roots exactly (by the product of their differences),
which keeps them orthogonal over any number of updates. Several such chains
run side by side in a task, as one array operation.

Two spectra are combined by the same update, once per eigenvector of the one
and once for the distance of the means; the tasks' spectra meet pairwise, in
rounds of small groups. Last, a pass over all vectors gives their covariance in
the basis found (Rayleigh-Ritz), whose small eigenproblem removes what
rounding has left.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import give_back
from quarry.llm.vectors import LONG_MAX, as_long, integer_vectors, matrix, squares
from quarry.session import materialize

#: Spectra combined by one task; vectors that one task updates with.
FAN = 8
TASK_ROWS = 4096


class Spectra:
    """Side by side: count, mean, eigenvalues (rising) and eigenvectors (columns) of the scatter of each chain."""

    def __init__(self, chains: int, size: int):
        import numpy as np

        self.n = np.zeros(chains)
        self.mean = np.zeros((chains, size))
        self.value = np.zeros((chains, size))
        self.vector = np.tile(np.eye(size), (chains, 1, 1))

    def part(self, a: int, b: int) -> Spectra:
        out = Spectra(0, self.mean.shape[1])
        out.n, out.mean, out.value, out.vector = (x[a:b].copy() for x in (self.n, self.mean, self.value, self.vector))
        return out

    def add(self, x) -> None:
        """One vector to each of the first ``len(x)`` chains."""
        import numpy as np

        m = len(x)
        n = self.n[:m]
        delta = x - self.mean[:m]
        self._update(m, delta * np.sqrt(n / (n + 1))[:, None])
        self.mean[:m] += delta / (n + 1)[:, None]
        self.n[:m] += 1

    def merge(self, other: Spectra) -> None:
        """``other``'s chains into the first of these, by successive rank-one updates."""
        import numpy as np

        m, size = len(other.n), self.mean.shape[1]
        for j in range(size):
            if (other.value[:, j] > np.finfo(float).eps * other.value[:, -1]).any():
                self._update(m, other.vector[:, :, j] * np.sqrt(np.maximum(other.value[:, j], 0))[:, None])
        n, k = self.n[:m], other.n
        both = np.maximum(n + k, 1)
        delta = other.mean - self.mean[:m]
        self._update(m, delta * np.sqrt(n * k / both)[:, None])
        self.mean[:m] += delta * (k / both)[:, None]
        self.n[:m] += k

    def fold(self) -> None:
        """All chains into one."""
        while len(self.n) > 1:
            half = -(-len(self.n) // 2)
            rest = self.part(half, len(self.n))
            self.n, self.mean, self.value, self.vector = (x[:half] for x in (self.n, self.mean, self.value, self.vector))
            self.merge(rest)

    def _update(self, m: int, v) -> None:
        """Scatter of the first ``m`` chains plus v v'."""
        import numpy as np

        d, q = self.value[:m], self.vector[:m]
        z = np.matmul(v[:, None, :], q)[:, 0]
        eps = np.finfo(float).eps
        top = np.maximum(np.abs(d).max(axis=1), (z * z).sum(axis=1))
        near = 8 * eps * top
        for c in np.flatnonzero((np.diff(d, axis=1) <= near[:, None]).any(axis=1)):
            _deflate_equal(d[c], z[c], q[c], near[c])
        live = np.abs(z) * np.sqrt((z * z).sum(axis=1))[:, None] > near[:, None]
        z = np.where(live, z, 0.0)
        value, vector = _roots(d, z, live)
        q = np.matmul(q, vector)
        order = np.argsort(value, axis=1, kind="stable")
        if (order[:, 1:] < order[:, :-1]).any():
            value = np.take_along_axis(value, order, axis=1)
            q = np.take_along_axis(q, order[:, None, :], axis=2)
        self.value[:m], self.vector[:m] = value, q


def _deflate_equal(d, z, q, near) -> None:
    """Turns the eigenvectors of each group of equal eigenvalues so that z touches the last of them only; in place."""
    import numpy as np

    cuts = np.flatnonzero(np.diff(d) > near) + 1
    for group in np.split(np.arange(len(d)), cuts):
        if len(group) < 2:
            continue
        a, b = group[0], group[-1] + 1
        size = np.linalg.norm(z[a:b])
        d[a:b] = d[a:b].mean()
        if size == 0:
            continue
        # Householder: the reflection that takes z's part to size * e_last
        u = z[a:b].copy()
        u[-1] += size if u[-1] >= 0 else -size
        u /= np.linalg.norm(u)
        sign = -1.0 if z[b - 1] >= 0 else 1.0
        q[:, a:b] -= 2 * np.outer(q[:, a:b] @ u, u)
        z[a:b] = 0
        z[b - 1] = sign * size


def _roots(d, z, live):
    """Eigenvalues and eigenvectors of diag(d) + z z' per chain; where not ``live``, z is 0 and nothing changes.

    A root is found as its distance to the nearer one of the two poles around it,
    so that the differences to all poles keep their leading digits.
    """
    import numpy as np

    m, size = d.shape
    # the next live pole above each one; above the last there is none
    above = np.full((m, size + 1), np.inf)
    above[:, :size] = np.where(live, d, np.inf)
    above = np.minimum.accumulate(above[:, ::-1], axis=1)[:, ::-1][:, 1:]
    c, j = np.nonzero(live)
    if not len(c):
        return d.copy(), np.tile(np.eye(size), (m, 1, 1))
    z2 = (z * z)[c]
    pole, up = d[c, j], above[c, j]
    last = ~np.isfinite(up)
    up = np.where(last, pole + z2.sum(axis=1), up)
    from_pole = d[c] - pole[:, None]
    mid = (up - pole) / 2

    with np.errstate(divide="ignore", invalid="ignore"):
        f_mid = 1 + np.where(live[c], z2 / (from_pole - mid[:, None]), 0).sum(axis=1)
    # f rises from -inf to +inf between the poles: a negative value at the middle puts the root in the upper half
    use_up = (f_mid < 0) & ~last
    origin = np.where(use_up, up, pole)
    gap = d[c] - origin[:, None]  # poles as seen from the origin
    low = np.where(use_up, -mid, np.where(last & (f_mid < 0), mid, 0.0))
    high = np.where(use_up, 0.0, np.where(last & (f_mid < 0), up - pole, mid))
    t = (low + high) / 2
    # per open root: poles that add something, their weights, which lie below it; bracket, poles on both sides
    every = bool(live.all())
    at = np.arange(len(c))
    w = z2 if every else np.where(live[c], z2, 0.0)
    seen = gap if every else np.where(live[c], gap, np.inf)
    below = (np.arange(size)[None, :] <= j[:, None]).astype(float)
    x, p_low, p_up, top = t.copy(), pole - origin, up - origin, last
    eps = np.finfo(float).eps
    with np.errstate(divide="ignore", invalid="ignore", over="ignore"):
        for _ in range(100):
            s = seen - x[:, None]
            ratio = w / s
            slope = ratio / s
            both, left = ratio.sum(axis=1), np.einsum("ij,ij->i", ratio, below)
            s_all, s_low = slope.sum(axis=1), np.einsum("ij,ij->i", slope, below)
            f = 1 + both
            low, high = np.where(f < 0, x, low), np.where(f >= 0, x, high)
            done = np.abs(f) <= 4 * eps * (1 + 2 * np.abs(left) + np.abs(both)) * np.sqrt(size)
            done |= high - low <= 2 * eps * np.maximum(np.abs(low), np.abs(high))
            t[at[done]] = x[done]
            if done.all():
                break
            # rational interpolation with the poles on both sides; above the last pole with that alone
            d_low, d_up = p_low - x, p_up - x
            s_up = s_all - s_low
            c0 = f - d_low * s_low - d_up * s_up
            a = (d_low + d_up) * f - d_low * d_up * s_all
            b = d_low * d_up * f
            root = np.sqrt(np.maximum(a * a - 4 * b * c0, 0))
            step = np.where(a <= 0, (a - root) / (2 * c0), 2 * b / (a + root))
            step = np.where(top, d_low + d_low * d_low * s_low / (f - d_low * s_low), step)
            new = x + step
            new = np.where(np.isfinite(new) & (new >= low) & (new <= high), new, (low + high) / 2)
            x = np.where(done, x, new)
            if 2 * done.sum() >= len(done):
                at, w, seen, below, x, low, high, p_low, p_up, top = (y[~done] for y in (at, w, seen, below, x, low, high, p_low, p_up, top))
        else:
            t[at] = x
    diff = np.ones((m, size, size))  # diff[c, j, i] = d_i - root_j
    diff[c, j] = gap - t[:, None]
    value = d.copy()
    value[c, j] = origin + t
    # the z whose exact roots these are: z_i^2 = prod_j (root_j - d_i) / prod_{j != i} (d_j - d_i)
    poles = d[:, :, None] - d[:, None, :]
    poles[:, np.arange(size), np.arange(size)] = 1.0
    own = np.eye(size, dtype=bool)[None]
    with np.errstate(divide="ignore", invalid="ignore", over="ignore"):
        if every:
            zz = np.sqrt(np.maximum(np.prod(-diff / poles, axis=1), 0)) * np.sign(z)
            vec = zz[:, None, :] / diff  # [c, j, i]
        else:
            pair = live[:, :, None] & live[:, None, :]
            zz = np.sqrt(np.maximum(np.prod(np.where(pair, -diff / np.where(poles == 0, 1, poles), 1.0), axis=1), 0)) * np.sign(z)
            vec = np.where(pair, zz[:, None, :] / diff, 0.0)
        vec /= np.maximum(np.sqrt(np.einsum("cji,cji->cj", vec, vec))[:, :, None], 1e-300)
    if not every:
        vec = np.where(live[:, :, None], vec, np.where(own, 1.0, 0.0))
    return value, np.swapaxes(vec, 1, 2)


def _packed(*arrays) -> bytes:
    import numpy as np

    return b"".join(np.ascontiguousarray(a, "<f8").tobytes() for a in arrays)


def _spectrum(raw: bytes, size: int) -> Spectra:
    import numpy as np

    x = np.frombuffer(raw, "<f8")
    s = Spectra(1, size)
    s.n[0] = x[0]
    s.mean[0], s.value[0] = x[1 : 1 + size], x[1 + size : 1 + 2 * size]
    s.vector[0] = x[1 + 2 * size :].reshape(size, size)
    return s


def _together(parts: DataFrame, merge, name: str) -> bytes:
    """Rows (i, raw) merged in groups of ``FAN`` until one is left; merge: list of bytes -> bytes."""
    count = parts.count()
    while count > 1:
        def run(key, table):
            import pyarrow as pa

            raws = [r for _, r in sorted(zip(table.column("i").to_pylist(), table.column("raw").to_pylist(), strict=True))]
            return pa.table({"i": pa.array([key[0].as_py()], pa.int64()), "raw": pa.array([merge(raws)], pa.binary())})

        # parts are numbered without gaps by rank in a small table of numbers
        order = {r["i"]: at for at, r in enumerate(parts.select("i").orderBy("i").collect())}
        groups = parts.sparkSession.createDataFrame([(i, at // FAN) for i, at in order.items()], "i bigint, g bigint")
        parts = materialize(parts.join(F.broadcast(groups), "i").groupBy("g").applyInArrow(run, "i bigint, raw binary"), name)
        count = -(-count // FAN)
    row = parts.first()
    return bytes(row["raw"])


class Whitening:
    """What ``fit`` found: n, exact sums, mean, eigenvalues (falling), components (columns), trace, identity_error."""

    def __init__(self, n: int, sums: list[int], mean, value, vector, trace: float):
        self.n, self.sums, self.mean, self.value, self.vector, self.trace = n, sums, mean, value, vector, trace
        self.identity_error = 0.0

    def scale(self, components: int):
        """Columns that project on the first components over sqrt(e); zero where the vectors do not vary."""
        import numpy as np

        e = self.value[:components]
        full = e > max(self.trace, 0) * 1e-13
        return self.vector[:, :components] * np.where(full, 1 / np.sqrt(np.where(full, e, 1)), 0.0), full


def vectors_of(rows: DataFrame, key: str = "vec_id", vector: str = "embedding", scale: int = 256) -> tuple[DataFrame, int]:
    """(written integer vectors (key, x), their length): of lengths that differ, the most frequent is taken, the shorter among equally frequent ones."""
    x = materialize(integer_vectors(rows, key, vector, scale), "whiten-vectors")
    top = x.groupBy("size").count().orderBy(F.desc("count"), "size").first()
    size = top["size"] if top else 0
    return x.filter(F.col("size") == size).select(key, "x"), size


def fit(vectors: DataFrame, size: int, components: int = 4) -> Whitening | None:
    """Principal components of the distinct vectors ``x``; None where there is no vector.

    Every covariance is over the distinct vectors, divisor n, centred first.
    Only one matrix of ``size`` x ``size`` and one count per task reach the driver.
    """
    import numpy as np

    if not size:
        return None
    # a repeated vector is met once, however often it is there
    distinct = materialize(vectors.groupBy("x").agg(F.lit(1).alias("_")).select("x"), "whiten-fit")
    n = distinct.count()
    if not n:
        return None
    tasks = -(-n // TASK_ROWS)

    def sums(batches: Iterator) -> Iterator:
        import pyarrow as pa

        total, met = np.zeros(size, object), 0
        for b in batches:
            if b.num_rows:
                v = matrix(b.column(0), size)
                total += (v & 0xFFFFFFFF).sum(axis=0).astype(object) + ((v >> 32).sum(axis=0).astype(object) << 32)
                met += len(v)
        if met:
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(size), pa.int32()), pa.array([str(t) for t in total], pa.string())], ["d", "s"])

    per = distinct.mapInArrow(sums, "d int, s string").groupBy("d").agg(F.sum(F.col("s").cast("decimal(38,0)")).alias("s"))
    exact = [int(r["s"]) for r in per.orderBy("d").collect()]  # one row per dimension
    mean = np.array([s / n for s in exact])

    def eigen(batches: Iterator) -> Iterator:
        import pyarrow as pa
        from pyspark import TaskContext

        s, at = None, 0
        for b in batches:
            v = matrix(b.column(0), size).astype(float)
            if s is None:
                s = Spectra(max(1, min(len(v) // (4 * size), 32, (1 << 18) // (size * size))), size)
            i = 0
            while i < len(v):  # one vector to each chain in turn
                m = min(len(s.n), len(v) - i)
                s.add(v[i : i + m])
                i += m
        if s is not None:
            s.fold()
            at = TaskContext.get().partitionId()
            yield pa.RecordBatch.from_arrays([pa.array([at], pa.int64()), pa.array([_packed(s.n, s.mean, s.value, s.vector)], pa.binary())], ["i", "raw"])
        give_back()

    def merge(raws: list) -> bytes:
        s = _spectrum(raws[0], size)
        for r in raws[1:]:
            s.merge(_spectrum(r, size))
        return _packed(s.n, s.mean, s.value, s.vector)

    spectra = materialize(distinct.repartition(tasks, "x").mapInArrow(eigen, "i bigint, raw binary"), "whiten-spectra")
    found = _spectrum(_together(spectra, merge, "whiten-spectra"), size)
    basis, _ = np.linalg.qr(found.vector[0][:, ::-1])
    # Rayleigh-Ritz: the covariance in that basis, over all vectors
    inside = _covariance(distinct, size, mean, basis)
    value, turn = np.linalg.eigh((inside + inside.T) / (2 * n))
    value, vector = np.maximum(value[::-1], 0), basis @ turn[:, ::-1]
    side = vector[np.abs(vector).argmax(axis=0), np.arange(size)]
    vector = vector * np.where(side < 0, -1.0, 1.0)  # the entry of most weight is positive
    w = Whitening(n, exact, mean, value, vector, float(value.sum()))
    columns, full = w.scale(components)
    c = _covariance(distinct, size, mean, columns) / n
    w.identity_error = float(np.abs((c - np.eye(c.shape[0]))[np.ix_(full, full)]).max()) if full.any() else 0.0
    return w


def _covariance(vectors: DataFrame, size: int, mean, columns):
    """Sum over all vectors of y y', y = columns' (x - mean)."""
    import numpy as np

    width = columns.shape[1]

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa
        from pyspark import TaskContext

        total, met = np.zeros((width, width)), False
        for b in batches:
            if b.num_rows:
                y = (matrix(b.column(0), size) - mean) @ columns
                total += y.T @ y
                met = True
        if met:
            yield pa.RecordBatch.from_arrays([pa.array([TaskContext.get().partitionId()], pa.int64()), pa.array([_packed(total)], pa.binary())], ["i", "raw"])

    def merge(raws: list) -> bytes:
        return _packed(sum(np.frombuffer(r, "<f8") for r in raws))

    parts = materialize(vectors.mapInArrow(run, "i bigint, raw binary"), "whiten-covariance")
    return np.frombuffer(_together(parts, merge, "whiten-covariance"), "<f8").reshape(width, width)


def whiten(vectors: DataFrame, size: int, fitted: Whitening | None, key: str = "vec_id", components: int = 4) -> DataFrame:
    """One row per row of ``vectors`` and component: (key, component, n, deviation, whitened, explained, identity_error).

    ``deviation`` is the sum over the dimensions of (n x - S)^2, exact, held at a
    long's end beyond it. Components are numbered from 1 by falling eigenvalue;
    there are as many as dimensions at most. Where the vectors do not vary along
    one (fewer distinct vectors than that), ``whitened`` and ``explained`` are 0 and it
    does not count in ``identity_error``. Repeated rows are whitened each; null keys
    stay null; no vectors give no rows.
    """
    import numpy as np

    schema = "k bigint, component int, n bigint, deviation bigint, whitened double, explained double, identity_error double"
    src = vectors.select(F.col(key).alias("k"), "x")
    if fitted is None:
        return vectors.sparkSession.createDataFrame([], schema).withColumnRenamed("k", key)
    m = min(components, size)
    columns, full = fitted.scale(m)
    share = np.where(full, fitted.value[:m] / (fitted.trace or 1.0), 0.0)
    n, sums, mean, error = fitted.n, fitted.sums, fitted.mean, fitted.identity_error
    most = max(abs(s) for s in sums)

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for b in batches:
            x = matrix(b.column(1), size)
            if not len(x):
                continue
            bound = n * max(abs(int(x.min())), abs(int(x.max()))) + most
            d = n * x - np.array(sums, np.int64) if bound <= LONG_MAX else n * x.astype(object) - np.array(sums, object)
            y = (x - mean) @ columns
            rows = np.repeat(np.arange(len(x)), m)
            many = len(rows)
            yield pa.RecordBatch.from_arrays(
                [
                    b.column(0).take(pa.array(rows)),
                    pa.array(np.tile(np.arange(1, m + 1), len(x)), pa.int32()),
                    pa.array(np.full(many, n), pa.int64()),
                    as_long(squares(d, bound)).take(pa.array(rows)),
                    pa.array(y.ravel(), pa.float64()),
                    pa.array(np.tile(share, len(x)), pa.float64()),
                    pa.array(np.full(many, error), pa.float64()),
                ],
                ["k", "component", "n", "deviation", "whitened", "explained", "identity_error"],
            )

    return src.mapInArrow(run, schema).withColumnRenamed("k", key)
