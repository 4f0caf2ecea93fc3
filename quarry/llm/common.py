"""Helpers shared by the training-data operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: ASCII white space of the contracts, as a Java/RE2 character class body.
SPACES = "\\x20\\x09-\\x0D"
WORD_TOKENIZER = "word_bpe_49k.json"
BYTE_TOKENIZER = "byte_bpe_multi_50k.tiktoken"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer_path(name: str = WORD_TOKENIZER) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def held_out(key: str | Column, folds: int, fold: int) -> Column:
    """True where crc32(key as text) mod ``folds`` is ``fold``; a null key is not held out."""
    k = F.col(key) if isinstance(key, str) else key
    return F.coalesce(F.crc32(k.cast("string").cast("binary")) % folds == fold, F.lit(False))


def may_learn(key: str | Column, folds: int, fold: int) -> Column:
    """True only where the key is known and outside the held-out fold."""
    k = F.col(key) if isinstance(key, str) else key
    return F.coalesce(F.crc32(k.cast("string").cast("binary")) % folds != fold, F.lit(False))


def suspects(rows: DataFrame, key: str, wanted: DataFrame, bits: int = 1 << 24) -> DataFrame:
    """``rows`` with a boolean ``_maybe``: false only where ``key`` is in no row of ``wanted``.

    A bitmap of key hashes, broadcast: at most ``bits``/64 rows whatever the
    tables hold. A key that shares a bit is a suspect too, so an exact join of
    the suspects follows; all other rows need not move with their texts.
    ``wanted`` has ``key`` under the name ``_w``; null keys count as equal.
    """
    bit = lambda c: F.pmod(F.xxhash64(c), F.lit(bits))
    mask = lambda c: F.expr(f"shiftleft(1L, cast(pmod(xxhash64({c}), {bits}L) % 64 AS int))")
    seen = wanted.groupBy(F.floor(bit("_w") / 64).alias("_sus_word")).agg(F.bit_or(mask("_w")).alias("_sus_mask"))
    x = rows.withColumn("_sus_k", F.col(key).cast(wanted.schema["_w"].dataType))  # one type, one hash
    x = x.withColumn("_sus_at", F.floor(bit("_sus_k") / 64)).join(F.broadcast(seen), F.col("_sus_at") == F.col("_sus_word"), "left")
    hit = F.coalesce(mask("_sus_k").bitwiseAND(F.col("_sus_mask")) != 0, F.lit(False))
    return x.withColumn("_maybe", hit).drop("_sus_k", "_sus_at", "_sus_word", "_sus_mask")


def give_back() -> None:
    """Returns freed memory of this Python worker to the system.

    Workers outlive a task and may stand idle beside those of later stages;
    called at the end of a task that held much.
    """
    import ctypes
    import gc

    import pyarrow as pa

    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (OSError, AttributeError):  # another C library: the allocator decides
        pass


def text_slices(texts, max_bytes: int = 4_000_000):
    """Yield (first row, slice) of an Arrow string array, about ``max_bytes`` of text each.

    Bounds the temporary arrays of a vectorised kernel whatever the batch
    holds; a single longer text is its own slice, whole.
    """
    import numpy as np
    import pyarrow as pa

    texts = texts.cast(pa.large_string())
    n = len(texts)
    ends = np.frombuffer(texts.buffers()[1], dtype=np.int64)[texts.offset : texts.offset + n + 1]
    at = 0
    while at < n:
        to = int(np.searchsorted(ends, ends[at] + max_bytes, side="right")) - 1
        to = min(n, max(to, at + 1))
        yield at, texts.slice(at, to - at)
        at = to


def bytes_of(texts):
    """(uint8 buffer, int64 offsets from 0) of an Arrow large_string array without nulls."""
    import numpy as np

    off = np.frombuffer(texts.buffers()[1], dtype=np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = texts.buffers()[2]
    raw = np.frombuffer(data, dtype=np.uint8)[off[0] : off[-1]] if data is not None else np.zeros(0, np.uint8)
    return raw, off - off[0]


def rebuilt(cls, state: dict):
    """An object of ``cls`` from its broadcast attributes.

    Broadcasts are pickled by reference, and executors need not have this
    package installed; the class itself travels with the function.
    """
    obj = cls.__new__(cls)
    obj.__dict__.update(state)
    return obj
