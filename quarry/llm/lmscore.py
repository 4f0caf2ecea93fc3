"""Language-model scoring with a log-frequency Bloom filter (operator 10).

The filter holds, for every bigram of the training tokens, the pairs
(bigram, 1) .. (bigram, q), q = 1 + floor(log2 of its count), so that one seen
once has a level too. A look-up probes level after level until one is missing,
which gives the quantised count back. Bigrams are counted per slice of a task,
then summed in shards by hash, each shard makes its own part of the filter,
and the parts are broadcast: all at once while they are small enough, else in
several passes over the texts, each with a bounded segment; a token's score
needs one part only, so passes add up to the same result.

Texts are taken apart once: their tokens are written as numbers, with the rows'
numbers, and every pass reads those. Unigram counts are exact: frequent tokens
are broadcast (a bounded number), the others are joined by their 64-bit hash.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import give_back, text_slices
from quarry.llm.ngram_join import mix64
from quarry.session import materialize, release

#: The token that closes every text. Words are never empty.
END = ""
HASHES = 6
#: Classes of history counts: 0 for tokens outside the broadcast, else 1 + floor(log2 c).
CLASSES = 48


def token_stream(texts):
    """Tokens of all texts in a row: (distinct tokens, token numbers, offsets); each text ends with END.

    A-Z is lower-cased; words are the runs of anything but ASCII white space.
    """
    import numpy as np
    import pyarrow as pa
    import pyarrow.compute as pc

    # a closing space leaves an empty chunk at the end of every text, which serves as END
    lists = pc.ascii_split_whitespace(pc.binary_join_element_wise(pc.ascii_lower(texts), pa.scalar(" ", texts.type), pa.scalar("", texts.type)))
    enc = lists.flatten().dictionary_encode()
    words = enc.dictionary.to_pylist()
    at = enc.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    off = lists.offsets.to_numpy().astype(np.int64)
    off = off - off[0]
    blank = np.array([w == END for w in words], bool)
    last = np.zeros(len(at), bool)
    last[off[1:] - 1] = True
    keep = ~blank[at] | last  # a leading empty chunk goes
    before = np.concatenate([[0], np.cumsum(keep)])
    return words, at[keep], before[off]


def token_hashes(words):
    import numpy as np
    import pandas as pd

    return pd.util.hash_array(np.array(words, dtype=object), categorize=False)


def bigram_hashes(own, off):
    """uint64 hash of (token before, token) from the tokens' hashes; before the first token stands a start mark."""
    import numpy as np

    before = np.empty(len(own), np.uint64)
    before[1:] = own[:-1]
    before[off[:-1]] = np.uint64(0x51A7)
    return mix64(mix64(before) * np.uint64(3) + own)


def token_totals(texts: DataFrame) -> DataFrame:
    """(token, h, c): exact counts over all rows of (t), and the token's hash; END is a token."""

    def run(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        for b in batches:
            for _, part in text_slices(b.column(0), 3_000_000):
                words, at, _ = token_stream(part)
                c = np.bincount(at, minlength=len(words))
                some = np.flatnonzero(c)
                own = token_hashes(words)[some].view(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(words, pa.string()).take(pa.array(some)), pa.array(own), pa.array(c[some])], ["token", "h", "c"])
        give_back()

    return texts.mapInArrow(run, "token string, h bigint, c bigint").groupBy("token").agg(F.min("h").alias("h"), F.sum("c").alias("c"))


def broadcast_from(vocab: DataFrame, frequent: int) -> int:
    """A count that at most ``frequent`` tokens reach, as low as the classes of counts allow.

    Each count below 4,096 is a class, and from there on each power of two,
    so the driver sees at most 4,147 rows. Where the top class alone is too
    large, no token reaches the result.
    """
    power = F.expr("shiftleft(1L, length(bin(c)) - 1)")
    per = vocab.groupBy(F.when(F.col("c") < 1 << 12, F.col("c")).otherwise(power).alias("c")).agg(F.count(F.lit(1)).alias("k"))
    least, held = (1 << 63) - 1, 0
    for r in per.orderBy(F.desc("c")).collect():
        held += r["k"]
        if held > frequent:
            break
        least = r["c"]
    return least


def probe_places(keys, level: int, size):
    """HASHES bit places below ``size`` for (key, level), by double hashing."""
    import numpy as np

    a = mix64(keys + np.uint64(level * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF))
    b = mix64(a) | np.uint64(1)
    for i in range(HASHES):
        yield (a + np.uint64(i) * b) % size


def bigram_counts(texts: DataFrame, shards: int, slice_tokens: int = 2_000_000) -> DataFrame:
    """(shard, hash, c): the bigrams of about ``slice_tokens`` tokens of a task at a time, each once with its count."""

    def counted(held: list) -> Iterator:
        import numpy as np
        import pyarrow as pa

        u, c = np.unique(np.concatenate(held), return_counts=True)
        for i in range(0, len(u), 1 << 17):
            h = u[i : i + (1 << 17)]
            cols = [pa.array((h % np.uint64(shards)).astype(np.int32)), pa.array(h.view(np.int64)), pa.array(c[i : i + (1 << 17)].astype(np.int64))]
            yield pa.RecordBatch.from_arrays(cols, ["shard", "hash", "c"])

    def run(batches: Iterator) -> Iterator:
        held, n = [], 0
        for b in batches:
            for _, part in text_slices(b.column(0), 3_000_000):
                words, at, off = token_stream(part)
                held.append(bigram_hashes(token_hashes(words)[at], off))
                n += len(held[-1])
                if n >= slice_tokens:
                    yield from counted(held)
                    held, n = [], 0
        if held:
            yield from counted(held)
        del held
        give_back()

    return texts.mapInArrow(run, "shard int, hash bigint, c bigint")


def filter_parts(texts: DataFrame, shards: int, bits_per_entry: int, min_count: int) -> DataFrame:
    """(shard, size, bits, once, twice, level_n, level_c): one part of the filter per shard, ``size`` bits each.

    once/twice: bigrams seen so often; level_n/level_c: bigrams per level and
    the sum of their counts. Only counts move, and a group holds every bigram
    once however frequent it is.
    """

    def build(key, t):
        import numpy as np
        import pyarrow as pa

        u, c = t.column("hash").to_numpy().view(np.uint64), t.column("c").to_numpy()
        once, twice = int((c == 1).sum()), int((c == 2).sum())
        u, c = u[c >= min_count], c[c >= min_count]
        levels = 1 + np.floor(np.log2(c)).astype(np.int64) if len(c) else np.zeros(0, np.int64)
        size = max(64, int(levels.sum()) * bits_per_entry)
        bits = np.zeros(-(-size // 8), np.uint8)
        for level in range(1, int(levels.max()) + 1 if len(levels) else 1):
            for p in probe_places(u[levels >= level], level, np.uint64(size)):
                np.bitwise_or.at(bits, (p >> np.uint64(3)).astype(np.int64), (1 << (p & np.uint64(7))).astype(np.uint8))
        per = lambda w: pa.array([np.bincount(levels, weights=w, minlength=64).astype(np.int64)], pa.list_(pa.int64()))
        one = lambda x, t: pa.array([x], t)
        give_back()
        return pa.table(
            {"shard": one(key[0].as_py(), pa.int32()), "size": one(size, pa.int64()), "bits": one(bits.tobytes(), pa.binary()), "once": one(once, pa.int64()), "twice": one(twice, pa.int64()), "level_n": per(None), "level_c": per(c)}
        )

    # one shuffle by shard serves the sums and the groups; wide enough that few shards share a task
    width = max(int(texts.sparkSession.conf.get("spark.sql.shuffle.partitions")), 2 * shards)
    sums = bigram_counts(texts, shards).repartition(width, "shard").groupBy("shard", "hash").agg(F.sum("c").alias("c"))
    return sums.groupBy("shard").applyInArrow(
        build, "shard int, size bigint, bits binary, once bigint, twice bigint, level_n array<bigint>, level_c array<bigint>"
    )


def laid_out(parts: dict, shards: int):
    """(bits in a row, first byte per shard, size in bits per shard; 0 where the part is not here)."""
    import numpy as np

    size, start, at = np.zeros(shards, np.uint64), np.zeros(shards, np.int64), 0
    bits = np.empty(sum(len(x) for _, x in parts.values()), np.uint8)
    for s in sorted(parts):
        size[s], start[s] = parts[s][0], at
        bits[at : at + len(parts[s][1])] = np.frombuffer(parts[s][1], np.uint8)
        at += len(parts[s][1])
    return bits, start, size


def probed_levels(keys, shard, bits, start, size):
    """Quantised count of each bigram key: levels found in a row; -1 where its part is not here."""
    import numpy as np

    level = np.where(size[shard] > 0, 0, -1)
    alive = np.flatnonzero(size[shard] > 0)
    j = 1
    while len(alive):
        hit = np.ones(len(alive), bool)
        k, sh = keys[alive], shard[alive]
        live = np.arange(len(alive))
        for i, p in enumerate(probe_places(k, j, size[sh])):
            live = live[hit[live]] if i else live
            q = p[live]
            hit[live] = (bits[start[sh[live]] + (q >> np.uint64(3)).astype(np.int64)] >> (q & np.uint64(7)).astype(np.uint8)) & 1
        alive = alive[hit]
        level[alive] = j
        j += 1
    return level


def score(
    docs: DataFrame,
    learn,
    key: str = "doc_id",
    text: str = "text",
    min_count: int = 1,
    bits_per_entry: int = 16,
    frequent: int = 1 << 17,
    segment_bytes: int = 96 << 20,
    shard_tokens: int = 2_000_000,
) -> DataFrame:
    """(key, n_tokens, n_known, train_tokens, base_score, score), one row per row of ``docs``.

    ``learn`` is the condition of the rows to learn from. base_score sums
    log10((c + 1) / (N + V + 1)) over the tokens, c being a token's exact
    training count, N all tokens and V the distinct ones. score backs off
    with an absolute discount D = n1 / (n1 + 2 n2) from the numbers of
    bigrams seen once and twice (n2 at least 1): a bigram in the filter has probability
    (m - D) / c(before), m being the mean count of its level; any other has
    its token's base probability times the share that histories of that count
    leave (bigrams not in the filter, and the discounts), measured over all
    training tokens. Null texts are empty (only END is scored); repeated rows
    are scored each; without training rows every token is unknown. An empty
    table gives no rows.
    """
    spark = docs.sparkSession
    texts = docs.filter(learn).select(F.coalesce(F.col(text), F.lit("")).alias("t"))
    vocab = materialize(token_totals(texts), "lm-vocab")
    tot = vocab.agg(F.coalesce(F.sum("c"), F.lit(0)).alias("n"), F.count(F.lit(1)).alias("v")).first()
    n, v = int(tot["n"]), int(tot["v"])
    n_texts = texts.count()
    least = broadcast_from(vocab, frequent)
    top = vocab.filter(F.col("c") >= least).toArrow()
    numbers = spark.sparkContext.broadcast({w: i for i, w in enumerate(top.column("token").to_pylist())})
    common = spark.sparkContext.broadcast((top.column("h").to_numpy().astype("<i8").view("<u8"), top.column("c").to_numpy()))
    rare = vocab.filter(F.col("c") < least).select("h", "c")

    shards = max(1, -(-n // shard_tokens))
    parts = materialize(filter_parts(texts, shards, bits_per_entry, min_count), "lm-filter")
    sizes = {r["shard"]: r["size"] // 8 + 1 for r in parts.select("shard", "size").collect()}
    seen = parts.agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("once", "twice")]).first()
    # below 1, so that bigrams seen once keep a share where none is seen twice
    discount = seen["once"] / (seen["once"] + 2 * max(seen["twice"], 1)) if seen["once"] else 0.5
    by_level = parts.select(F.posexplode("level_n").alias("q", "n"), "level_c").groupBy("q").agg(F.sum("n").alias("n"), F.sum(F.get("level_c", F.col("q"))).alias("c"))
    mean = [1.0, *(float(2**q) for q in range(63))]
    for r in by_level.filter("n > 0").collect():  # at most 64 rows
        mean[r["q"]] = r["c"] / r["n"]
    segments: list[list[int]] = [[]]
    room = segment_bytes
    for s in range(shards):
        if sizes.get(s, 0) > room and segments[-1]:
            segments.append([])
            room = segment_bytes
        segments[-1].append(s)
        room -= sizes.get(s, 0)

    rows = docs.select(F.col(key).cast("bigint").alias("k"), F.monotonically_increasing_id().alias("r"), F.coalesce(F.col(text), F.lit("")).alias("t"), learn.alias("l"))
    rows = materialize(packed_tokens(rows, numbers), "lm-tokens")  # also fixes the rows' numbers for all passes
    numbers.destroy()
    done = []
    for i, seg in enumerate(segments):
        got = parts.filter(F.col("shard").isin(seg)).toArrow()
        data = {s: (z, x) for s, z, x in zip(*(got.column(c).to_pylist() for c in ("shard", "size", "bits")), strict=True)}
        data |= {s: (64, bytes(8)) for s in seg if s not in data}
        held_parts = spark.sparkContext.broadcast(laid_out(data, shards))
        done.append(materialize(_partial(rows, common, held_parts, shards, n, v, n_texts, mean, discount, i == 0), f"lm-pass-{i}"))
        held_parts.destroy()
    common.destroy()
    release(rows, parts)
    p = done[0]
    for d in done[1:]:
        p = p.unionByName(d)
    # what histories of each class leave to bigrams outside the filter: one row per class
    left = p.filter("r < 0").select(F.posexplode("mass").alias("b", "m"), "met").groupBy("b").agg(F.sum("m").alias("m"), F.sum(F.get("met", F.col("b"))).alias("met"))
    share = [1.0] * CLASSES
    for r in left.collect():
        if r["met"]:
            share[r["b"]] = min(1.0, max(1e-6, r["m"] / r["met"]))
    logs = F.array(*[F.log10(F.lit(x)) for x in share])
    # tokens outside the broadcast: their terms come by a join on the token's hash
    x = p.filter("h is not null").join(rare, "h", "left")
    c = F.coalesce("c", F.lit(0))
    log_base = F.log10((c + 1) / F.lit(float(n + v + 1)))
    x = x.select(
        "r",
        F.lit(None).cast("bigint").alias("k"),
        F.lit(0).cast("bigint").alias("n_tokens"),
        F.when(c > 0, F.col("tf")).otherwise(F.lit(0)).alias("n_known"),
        (F.col("tf") * log_base).alias("base"),
        (F.col("tf_backed") * log_base - F.col("tf_before") * F.log10(F.greatest(c, F.lit(min_count)))).alias("lm"),
    )
    backed = F.aggregate(F.zip_with("backed", logs, lambda m, lg: m * lg), F.lit(0.0), lambda a, y: a + y)
    d = p.filter("h is null and r >= 0").select("r", "k", "n_tokens", "n_known", "base", (F.col("lm") + backed).alias("lm"))
    out = d.unionByName(x).groupBy("r").agg(F.max("k").alias(key), F.sum("n_tokens").alias("n_tokens"), F.sum("n_known").alias("n_known"), F.sum("base").alias("base_score"), F.sum("lm").alias("score"))
    return out.select(key, "n_tokens", "n_known", F.lit(n).cast("bigint").alias("train_tokens"), "base_score", "score")


def packed_tokens(rows: DataFrame, numbers) -> DataFrame:
    """(k, r, l, ids, rare) of rows (k, r, t, l): the tokens of every whole text as numbers.

    ``ids`` are 32 bits each: a broadcast token's number, or -1 - i for the i-th
    of the text's other tokens, whose hashes are ``rare``.
    """

    def run(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        number = numbers.value
        for b in batches:
            for at0, part in text_slices(b.column(2), 1_500_000):
                words, at, off = token_stream(part)
                known = np.fromiter((number.get(w, -1) for w in words), np.int64, len(words))
                ids = known[at]
                own = np.repeat(np.arange(len(part)), np.diff(off))
                here = ids < 0
                u, inv = np.unique(own[here] * len(words) + at[here], return_inverse=True)
                first = np.searchsorted(u // max(1, len(words)), np.arange(len(part) + 1))
                ids[here] = -1 - (inv - first[own[here]])
                rare = token_hashes(words)[u % len(words)] if len(u) else np.zeros(0, np.uint64)
                cols = [pa.Array.from_buffers(pa.large_binary(), len(part), [None, pa.py_buffer(np.ascontiguousarray(o * w, np.int64)), pa.py_buffer(np.ascontiguousarray(x))]).cast(pa.binary()) for x, o, w in ((ids.astype("<i4"), off, 4), (rare.astype("<u8"), first, 8))]
                yield pa.RecordBatch.from_arrays([*(b.column(i).slice(at0, len(part)) for i in (0, 1, 3)), *cols], ["k", "r", "l", "ids", "rare"])
        give_back()

    return rows.select("k", "r", "t", "l").mapInArrow(run, "k bigint, r bigint, l boolean, ids binary, rare binary")


def _partial(rows: DataFrame, common, parts, shards: int, n: int, v: int, n_texts: int, mean: list, discount: float, first: bool) -> DataFrame:
    """One pass over packed tokens: a row per document with what is known here, rows (r, h, tf, tf_backed, tf_before), and sums.

    backed: tokens whose bigram is not in the filter, per class of the token
    before. The rows with r < 0 hold, per class, training tokens (met) and
    the mass left to others (mass).
    tf: occurrences (first pass only), tf_backed: those whose bigram is not
    in the filter, tf_before: how often the token stands before one that is.
    """

    def slices(b) -> Iterator:
        """(first row, token numbers, their offsets, rare hashes, their offsets) of about 100,000 tokens each."""
        import numpy as np

        ids, rare = b.column(3).to_pylist(), b.column(4).to_pylist()
        i = 0
        while i < len(ids):
            j, held = i, 0
            while j < len(ids) and (j == i or held + len(ids[j]) // 4 <= 100_000):
                held += len(ids[j]) // 4
                j += 1
            ends = lambda xs, w: np.concatenate([[0], np.cumsum([len(x) // w for x in xs])]).astype(np.int64)
            yield i, np.frombuffer(b"".join(ids[i:j]), "<i4").astype(np.int64), ends(ids[i:j], 4), np.frombuffer(b"".join(rare[i:j]), "<u8"), ends(rare[i:j], 8)
            i = j

    def run(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        (top_hash, top_count), held = common.value, parts.value
        # what depends on a token or a level alone is looked up; the last entry is for tokens outside the broadcast
        class_of = lambda c: np.where(c > 0, np.minimum(1 + np.floor(np.log2(np.maximum(c, 1))), CLASSES - 1), 0).astype(np.int64)
        counts = np.append(top_count, -1)
        base_of = np.append(np.log10(top_count + 1) - np.log10(n + v + 1), 0.0)
        log_of, kind_of = np.where(counts > 0, np.log10(np.maximum(counts, 1)), 0.0), class_of(counts)
        start_log, start_kind = float(np.log10(max(n_texts, 1))), int(class_of(np.array([n_texts]))[0])
        level_mean = np.asarray(mean)
        level_log = np.log10(np.maximum(level_mean - discount, 1e-9))
        for b in batches:
            keys, numbers = b.column(0), b.column(1)
            learns = b.column(2).to_numpy(zero_copy_only=False)
            for at0, ids, off, rare, rare_off in slices(b):
                docs = len(off) - 1
                own = np.repeat(np.arange(docs), np.diff(off))
                known = ids >= 0
                spot = np.where(known, 0, rare_off[own] - 1 - ids)  # of a rare token: its place among the slice's
                at = np.where(known, ids, len(top_count))
                hashes = np.empty(len(ids), np.uint64)
                hashes[known] = top_hash[ids[known]]
                hashes[~known] = rare[spot[~known]]
                h = bigram_hashes(hashes, off)
                level = probed_levels(h, (h % np.uint64(shards)).astype(np.int64), *held)
                seen, backed = level > 0, level == 0
                before_log, kind = np.empty(len(ids)), np.empty(len(ids), np.int64)
                before_log[1:], kind[1:] = log_of[at[:-1]], kind_of[at[:-1]]
                before_log[off[:-1]], kind[off[:-1]] = start_log, start_kind  # the start mark, seen once per training text
                base = base_of[at]
                reached = np.maximum(level, 0)
                m_q = level_mean[reached]
                lm = np.where(seen, level_log[reached] - before_log, np.where(backed, base, 0.0))
                by_class = np.bincount(own[backed] * CLASSES + kind[backed], minlength=docs * CLASSES)
                used = (seen | backed) & learns[at0 : at0 + docs][own]
                met = np.bincount(kind[used], minlength=CLASSES)
                mass = np.bincount(kind[used], weights=np.where(backed, 1.0, discount / m_q)[used], minlength=CLASSES)
                total = lambda x: np.bincount(own, weights=x, minlength=docs)
                none = np.zeros(docs)
                own_rows = numbers.slice(at0, docs)
                whole = {"r": own_rows, "k": keys.slice(at0, docs), "n_tokens": np.diff(off) if first else none.astype(np.int64), "n_known": (total(known) if first else none).astype(np.int64)}
                whole |= {"base": total(base) if first else none, "lm": total(lm)}
                whole["backed"] = pa.FixedSizeListArray.from_arrays(pa.array(by_class), CLASSES).cast(pa.list_(pa.int64()))
                yield _rows(docs, whole)
                yield _rows(1, {"r": np.array([-1]), "met": pa.array([met], pa.list_(pa.int64())), "mass": pa.array([mass], pa.list_(pa.float64()))})
                # rare tokens, once per text
                per = lambda at: np.bincount(at, minlength=len(rare))
                before = np.zeros(len(ids), bool)  # tokens that stand before a seen bigram's second one
                before[:-1] = seen[1:]
                before[off[1:] - 1] = False
                tf = per(spot[~known]) if first else np.zeros(len(rare), np.int64)
                tf_backed, tf_before = per(spot[~known & backed]), per(spot[~known & before])
                some = np.flatnonzero((tf > 0) | (tf_backed > 0) | (tf_before > 0))
                if len(some):
                    of = np.searchsorted(rare_off, some, side="right") - 1
                    yield _rows(len(some), {"r": own_rows.take(pa.array(of)), "h": rare[some].view(np.int64), "tf": tf[some], "tf_backed": tf_backed[some], "tf_before": tf_before[some]})
        give_back()

    return rows.select("k", "r", "l", "ids", "rare").mapInArrow(run, ", ".join(f"{c} {t}" for c, t in PARTIAL.items()))


#: Columns of a pass: of documents, of the sums over training tokens, of tokens.
PARTIAL = {
    "r": "bigint", "k": "bigint", "n_tokens": "bigint", "n_known": "bigint", "base": "double", "lm": "double", "backed": "array<bigint>",
    "met": "array<bigint>", "mass": "array<double>", "h": "bigint", "tf": "bigint", "tf_backed": "bigint", "tf_before": "bigint",
}


def _rows(n: int, given: dict):
    """A record batch of PARTIAL's columns, null where not given."""
    import pyarrow as pa

    kinds = {"bigint": pa.int64(), "double": pa.float64(), "array<bigint>": pa.list_(pa.int64()), "array<double>": pa.list_(pa.float64())}
    cols = []
    for c, t in PARTIAL.items():
        x = given.get(c)
        cols.append(pa.nulls(n, kinds[t]) if x is None else x if isinstance(x, pa.Array) else pa.array(x, kinds[t]))
    return pa.RecordBatch.from_arrays(cols, list(PARTIAL))
