"""Best-fit packing by sum of squares (operator 2).

Documents are cut only where they exceed the capacity. Every piece goes to
the open sequence, or a new one, after which the squared counts of open
sequences per residual gap add up to the least. Pieces are spread over
shards by hash, each shard packed on its own in decreasing length; what a
shard leaves in poorly filled sequences is packed again in fewer shards, until
one shard's worth is left or a round dissolves nearly all it was given, so
that no task holds more than a fixed number of pieces (on average) and the
number of sequences stays near the lower bound.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import give_back, text_slices
from quarry.llm.tokens import ChunkEncoder, read_spec
from quarry.session import materialize

PIECE_SCHEMA = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint, tie bigint"


def cut_pieces(docs: DataFrame, path: str, capacity: int = 2048, end_id: int = 0, ids: bool = False) -> DataFrame:
    """One row per piece of every document: (doc_id, piece, start, length, ids_crc32[, ids]).

    A document is its token ids followed by ``end_id``; a null text is empty
    (only ``end_id``). Longer documents are cut every ``capacity`` ids.
    """
    spec = docs.sparkSession.sparkContext.broadcast(read_spec(path))

    def run(batches: Iterator) -> Iterator:
        import zlib

        import numpy as np
        import pyarrow as pa

        enc = ChunkEncoder(spec.value)
        end = np.array([end_id], np.uint32)
        for b in batches:
            keys, ties = b.column(0), b.column(2).to_pylist()
            for first, part in text_slices(b.column(1)):
                flat, n = enc.encode(part)
                at = np.concatenate([[0], np.cumsum(n)])
                row, piece, start, length, crc, whole = [], [], [], [], [], []
                for i in range(len(n)):
                    doc = np.concatenate([flat[at[i] : at[i + 1]], end]).astype("<u4", copy=False)
                    for k in range(0, len(doc), capacity):
                        x = doc[k : k + capacity]
                        row.append(first + i)
                        piece.append(k // capacity)
                        start.append(k)
                        length.append(len(x))
                        crc.append(zlib.crc32(x.data))
                        if ids:
                            whole.append(x.astype(np.int64))
                cols = [keys.take(pa.array(row)), pa.array(piece, pa.int32()), pa.array(start, pa.int64()), pa.array(length, pa.int64()), pa.array(crc, pa.int64()), pa.array([ties[r] for r in row], pa.int64())]
                names = ["doc_id", "piece", "start", "length", "ids_crc32", "tie"]
                if ids:
                    cols.append(pa.array(whole, pa.list_(pa.int64())))
                    names.append("ids")
                yield pa.RecordBatch.from_arrays(cols, names)
        del enc
        give_back()

    src = docs.select(F.col("doc_id").cast("bigint"), F.coalesce("text", F.lit("")).alias("t"), F.xxhash64("doc_id", "text").alias("tie"))
    return src.mapInArrow(run, PIECE_SCHEMA + (", ids array<bigint>" if ids else ""))


def sum_of_squares(lengths, capacity: int):
    """(bin, offset) for each length in the order given, by the sum-of-squares rule.

    Ties go to the open sequence with the smallest gap that fits, then to a
    new one. Lengths are 1..capacity.
    """
    import numpy as np

    count = np.zeros(capacity + 1, np.int64)  # open bins by gap; gaps 0 and capacity never count
    stacks: list[list[int]] = [[] for _ in range(capacity + 1)]
    bins = np.empty(len(lengths), np.int64)
    offsets = np.empty(len(lengths), np.int64)
    opened = 0
    for i, s in enumerate(lengths):
        s = int(s)
        gap = capacity
        # change of the sum of squares for each open gap g >= s, gap after it g - s
        if s < capacity:
            held = count[s:capacity]
            if held.any():
                delta = 2 * (count[0 : capacity - s] - held) + 2
                delta[0] = 1 - 2 * held[0]  # fills the sequence: no gap is left
                delta[held == 0] = np.iinfo(np.int64).max
                k = int(delta.argmin())
                if delta[k] <= 2 * count[capacity - s] + 1:
                    gap = s + k
        if gap == capacity:
            b, opened = opened, opened + 1
        else:
            b = stacks[gap].pop()
            count[gap] -= 1
        bins[i], offsets[i] = b, capacity - gap
        if 0 < gap - s < capacity:
            stacks[gap - s].append(b)
            count[gap - s] += 1
    return bins, offsets


def _packer(capacity: int, level: int, last: bool, full: float):
    """Arrow function that packs one shard; ``kept`` marks pieces whose sequence is final."""

    def run(key, shard):
        import numpy as np
        import pyarrow as pa

        col = {c: shard.column(c).to_numpy() for c in ("length", "tie", "piece")}
        order = np.lexsort((col["piece"], col["tie"], -col["length"]))
        shard, lengths = shard.drop_columns("_shard").take(pa.array(order)), col["length"][order]
        bins, offsets = sum_of_squares(lengths, capacity)
        fill = np.bincount(bins, weights=lengths)
        first = (level << 56) | (int(key[0].as_py()) << 24)
        kept = np.full(len(bins), True) if last else fill[bins] >= full * capacity
        return shard.append_column("sequence_id", pa.array(first + bins)).append_column("offset", pa.array(offsets)).append_column("kept", pa.array(kept))

    return run


def pack(pieces: DataFrame, capacity: int = 2048, shard_pieces: int = 4096, full: float = 0.97) -> DataFrame:
    """Adds sequence_id and offset to ``pieces`` (must be a written table).

    Ties and repeated rows are spread by a hash of the whole piece; a piece
    of full length is a sequence by itself. Every round packs shards of about
    ``shard_pieces``; sequences filled below ``full`` are dissolved into the
    next round, which has fewer shards. Ends when one shard is left, or with
    a round in which every shard keeps its sequences, once a round has
    dissolved nine tenths of its pieces or more.
    """
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in pieces.schema.fields)
    done: list[DataFrame] = []
    rest, level, stuck = pieces, 0, False
    n = rest.count()
    while True:
        shards = max(1, -(-n // shard_pieces))
        last = stuck or shards == 1

        out = rest.withColumn("_shard", F.pmod(F.xxhash64("tie", "piece", F.lit(level)), F.lit(shards)))
        out = out.groupBy("_shard").applyInArrow(_packer(capacity, level, last, full), schema + ", sequence_id bigint, offset bigint, kept boolean")
        out = materialize(out, f"pack-{level}")
        done.append(out.filter("kept").drop("kept"))
        if last:
            break
        rest = out.filter("not kept").select(*pieces.columns)
        n_next = rest.count()
        if n_next == 0:
            break
        # after a round that dissolves nearly all, every shard keeps what it has
        stuck, n, level = n_next >= 0.9 * n, n_next, level + 1
    res = done[0]
    for d in done[1:]:
        res = res.unionByName(d)
    return res
