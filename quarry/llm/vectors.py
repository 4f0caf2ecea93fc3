"""Integer vectors from embeddings: each entry c becomes floor(scale * c), packed."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Largest long; what does not fit is held at it.
LONG_MAX = (1 << 63) - 1


def integer_vectors(rows: DataFrame, key: str, vector: str, scale: int = 256, size: int | None = None) -> DataFrame:
    """(key, size, x): one row per vector without null or non-finite entries, in file order of ``rows``.

    ``x`` holds the entries as little-endian integers of the least of 2, 4 or 8
    bytes that fits all of them, so equal vectors are equal bytes. Null and
    empty vectors are dropped, and with ``size`` all of another length; entries
    whose product leaves the range of a long are held at its ends.
    """
    v = F.col(vector)
    good = F.forall(v, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c.cast("double")) != float("inf")))
    of_size = F.size(v) == size if size else F.size(v) > 0

    def run(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        for b in batches:
            lists = b.column(1)
            off = lists.offsets.to_numpy().astype(np.int64)
            off = off - off[0]
            flat = np.floor(lists.flatten().to_numpy(zero_copy_only=False) * float(scale))
            wide = np.clip(flat, -(2.0**63), 2.0**63 - 1024).astype(np.int64)
            wide[flat >= 2.0**63] = LONG_MAX
            out = []
            most = np.maximum.reduceat(np.maximum(wide, -1 - wide), off[:-1]) if len(b) else []
            for i in range(len(b)):
                kind = "<i2" if most[i] < 1 << 15 else "<i4" if most[i] < 1 << 31 else "<i8"
                out.append(wide[off[i] : off[i + 1]].astype(kind).tobytes())
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(np.diff(off), pa.int32()), pa.array(out, pa.binary())], ["k", "size", "x"])

    src = rows.filter(v.isNotNull()).filter(of_size).filter(good)
    src = src.select(F.col(key).cast("bigint").alias("k"), F.transform(v, lambda c: c.cast("double")).alias("v"))
    return src.mapInArrow(run, "k bigint, size int, x binary").withColumnRenamed("k", key)


def matrix(packed, size: int):
    """int64 matrix of an Arrow binary array of packed vectors of ``size`` entries."""
    import numpy as np

    raws = packed.to_pylist()
    out = np.empty((len(raws), size), np.int64)
    width = np.array([len(r) // size for r in raws], np.int64)
    for w in (2, 4, 8):
        at = np.flatnonzero(width == w)
        if len(at):
            out[at] = np.frombuffer(b"".join(raws[i] for i in at), f"<i{w}").reshape(-1, size)
    return out


def squares(d, bound: int):
    """Sum over the last axis of the squares of int64 ``d`` whose entries are at most ``bound``; exact.

    An int64 array where it fits, else an object array of Python integers.
    """
    import numpy as np

    if bound * bound * d.shape[-1] <= LONG_MAX:
        return np.einsum("...i,...i->...", d, d)
    if bound < 1 << 47 and d.shape[-1] <= 1 << 14:
        high, low = d >> 24, d & 0xFFFFFF
        a, b, c = (np.einsum("...i,...i->...", x, y).astype(object) for x, y in ((high, high), (high, low), (low, low)))
        return (a << 48) + (b << 25) + c
    d = d.astype(object)
    return (d * d).sum(axis=-1)


def as_long(x):
    """Arrow longs of what ``squares`` gave; values beyond the range are held at its end."""
    import pyarrow as pa

    return pa.array(x if x.dtype != object else [min(int(i), LONG_MAX) for i in x], pa.int64())
