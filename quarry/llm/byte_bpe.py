"""Byte-level BPE encoding and decoding (operator 11).

Texts are cut into the matches of the tokenizers' pattern without a regular
expression: every code point has a class (letter, number, white space, other),
a symbol adds what the next characters tell (does the white space end here, is
this the apostrophe of a contraction), and a symbol is a function from states
to states. Such functions compose associatively, so a block's function is
found independently of what stands before it, the functions of the blocks are
scanned, and then all blocks find their boundaries at once.

The slices between boundaries repeat: each distinct one is merged once per
task, all missing ones of a batch together, and gathered from a bounded cache
afterwards. Ids keep the byte offset of their first byte in the text.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import bytes_of, give_back, text_slices
from quarry.llm.tokens import _ranges

#: Classes of code points.
OTHER, LETTER, NUMBER, SPACE = range(4)
#: States: at a boundary, in letters, numbers, others, white space, after a joined space, one or two letters of a contraction to come.
START, IN_L, IN_N, IN_O, IN_W, JOINED, LEFT_1, LEFT_2 = range(8)
STATES = 8
#: Symbols: three classes; an apostrophe before s, t, m, d and before re, ve, ll; white space that goes on or ends the text,
#: white space that ends, and the space that ends and so joins what follows. FIRST is added at the first character of a text.
S_L, S_N, S_O, S_Q2, S_Q3, S_W, S_WL, S_SP = range(8)
FIRST = 8
#: Slices kept per task before the cache starts anew, and their bytes.
CACHE_SLICES = 400_000
CACHE_BYTES = 32 << 20
#: Slices up to so many bytes are merged together, longer ones each by a heap.
SHORT = 48


def code_point_classes():
    """uint8 class of each code point, as the tokenizer library's own Unicode tables have it.

    Those differ from Python's by some thousand letters, so they are read off
    the library once: a vocabulary of the 256 bytes returns what a class matches.
    """
    import numpy as np
    import tiktoken

    every = np.concatenate([np.arange(0xD800), np.arange(0xE000, 0x110000)]).astype("<u4").tobytes().decode("utf-32-le")
    single = {bytes([i]): i for i in range(256)}
    out = np.full(0x110000, OTHER, np.uint8)
    for kind, pattern in ((LETTER, r"\p{L}"), (NUMBER, r"\p{N}"), (SPACE, r"\s")):
        got = tiktoken.Encoding("class", pat_str=pattern, mergeable_ranks=single, special_tokens={}).encode_ordinary(every)
        out[np.frombuffer(bytes(got).decode().encode("utf-32-le"), "<u4")] = kind
    return out


def transitions():
    """(next state, 1 where a slice begins) per symbol and state."""
    import numpy as np

    to = np.zeros((2 * FIRST, STATES), np.uint8)
    cut = np.ones((2 * FIRST, STATES), np.uint8)
    for sym, state in {S_L: IN_L, S_N: IN_N, S_O: IN_O, S_Q2: LEFT_1, S_Q3: LEFT_2, S_W: IN_W, S_WL: START, S_SP: JOINED}.items():
        to[sym] = state
        for left, then in ((LEFT_2, LEFT_1), (LEFT_1, START)):
            to[sym, left], cut[sym, left] = then, 0
        if state in (IN_L, IN_N, IN_O, IN_W):
            cut[sym, state] = 0
        if sym in (S_L, S_N, S_O):
            cut[sym, JOINED] = 0
        if sym in (S_Q2, S_Q3):  # inside a run of others the apostrophe is one of them
            for run in (IN_O, JOINED):
                to[sym, run], cut[sym, run] = IN_O, 0
    to[FIRST:] = to[:FIRST, START][:, None]  # the first character of a text forgets what was before
    return to, cut


def monoid(to):
    """All functions that runs of symbols can be: (each as its states, by symbol the number of the function that follows, products).

    There are a few hundred, so that a function is a small number and
    composing two is one look-up: after[f, s] is f then symbol s, product[f, g]
    is f then g. Function 0 changes nothing.
    """
    import numpy as np

    found = {tuple(range(STATES)): 0}
    queue, after = [tuple(range(STATES))], []
    for f in queue:
        row = []
        for sym in range(len(to)):
            g = tuple(int(to[sym, s]) for s in f)
            if g not in found:
                found[g] = len(queue)
                queue.append(g)
            row.append(found[g])
        after.append(row)
    table = np.array(queue, np.uint8)
    product = np.array([[found[tuple(int(g[s]) for s in f)] for g in queue] for f in queue], np.uint16)
    return table, np.array(after, np.uint16), product


def scan_states(sym, m, block: int = 64):
    """State before each symbol, from START, by an associative scan over the symbols' functions."""
    import numpy as np

    table, after, product = m
    return table[scanned(after[0][sym], product, block), START]


def scanned(fn, product, block: int):
    """For each function the product of all before it: blocks first, then the same over the blocks' products, then inside all blocks."""
    import numpy as np

    n = len(fn)
    rows = -(-n // block)
    grid = np.zeros(rows * block, np.uint16)
    grid[:n] = fn
    grid = np.ascontiguousarray(grid.reshape(rows, block).T)
    flat, wide = product.ravel(), product.shape[1]
    if rows > 1:
        whole = grid[0]
        for j in range(1, block):
            whole = flat[whole.astype(np.int32) * wide + grid[j]]
        state = scanned(whole, product, block)
    else:
        state = np.zeros(rows, np.uint16)
    out = np.empty((block, rows), np.uint16)
    for j in range(block):
        out[j] = state
        state = flat[state.astype(np.int32) * wide + grid[j]]
    return out.T.ravel()[:n]


def code_points(raw):
    """(code point, byte position) of each character of UTF-8 bytes."""
    import numpy as np

    at = np.flatnonzero((raw & 0xC0) != 0x80)
    cp = raw[at].astype(np.int32)
    wide = np.flatnonzero(cp >= 0x80)
    if len(wide):
        x, p = cp[wide], at[wide]
        more = (x >= 0xC0).astype(np.int64) + (x >= 0xE0) + (x >= 0xF0)
        v = np.where(more == 3, x & 0x07, np.where(more == 2, x & 0x0F, x & 0x1F))
        for j in (1, 2, 3):
            has = more >= j
            v = np.where(has, (v << 6) | (raw[np.minimum(p + j, len(raw) - 1)] & 0x3F), v)
        cp[wide] = np.minimum(v, 0x10FFFF)
    return cp, at


def slice_starts(raw, ends, classes, m, cut):
    """Byte positions at which the pattern's matches begin; ``ends``: where the texts in ``raw`` end."""
    import numpy as np

    cp, at = code_points(raw)
    n = len(cp)
    if not n:
        return np.zeros(0, np.int64)
    kind = classes[cp]
    first = np.zeros(n, bool)
    begin = np.concatenate([[0], ends[:-1]])[np.diff(ends, prepend=0) > 0]
    first[np.searchsorted(at, begin)] = True
    last = np.concatenate([first[1:], [True]])
    ahead = np.concatenate([kind[1:], [SPACE]])
    sym = np.array([S_O, S_L, S_N, S_W], np.uint8)[kind]
    ends_run = (kind == SPACE) & (ahead != SPACE) & ~last
    sym[ends_run] = S_WL
    sym[ends_run & (cp == 0x20)] = S_SP
    q = np.flatnonzero((cp == 0x27) & ~last)
    if len(q):
        a = cp[q + 1]
        b = np.where(last[q + 1], 0, cp[np.minimum(q + 2, n - 1)])
        two = (a == ord("s")) | (a == ord("t")) | (a == ord("m")) | (a == ord("d"))
        three = (a == ord("r")) & (b == ord("e")) | (a == ord("v")) & (b == ord("e")) | (a == ord("l")) & (b == ord("l"))
        sym[q[two]] = S_Q2
        sym[q[three]] = S_Q3
    sym[first] += FIRST
    return at[cut[sym, scan_states(sym, m)].astype(bool)]


def read_ranks(path: str) -> dict[bytes, int]:
    """The vocabulary of a rank file."""
    with open(path, "rb") as f:
        return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in f if line.strip())}


def hashed(pairs: dict[int, int], none: int):
    """(keys, ranks) as an open hash table: a key is at its place or, without a gap, after it; -1 and ``none`` are free."""
    import numpy as np

    room = 1 << max(4, int(4 * len(pairs)).bit_length())
    keys, ranks = np.full(room, -1, np.int64), np.full(room, none, np.int64)
    left, value = np.array(list(pairs), np.int64), np.array(list(pairs.values()), np.int64)
    at = place(left, room)
    while len(left):
        free = keys[at] < 0
        first = np.zeros(len(left), bool)
        first[np.unique(at[free], return_index=True)[1]] = True  # one of those that want the same free place
        put = np.flatnonzero(free)[first[: free.sum()]]
        keys[at[put]], ranks[at[put]] = left[put], value[put]
        stay = np.ones(len(left), bool)
        stay[put] = False
        left, value, at = left[stay], value[stay], (at[stay] + 1) % room
    return keys, ranks


def place(keys, room: int):
    import numpy as np

    h = keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    return (h >> np.uint64(65 - int(room).bit_length())).astype(np.int64)


def token_bytes(ranks: dict[bytes, int]) -> dict:
    """The bytes of all tokens in a row, by id, and where they end."""
    import numpy as np

    of = [b""] * (max(ranks.values()) + 1)
    for token, rank in ranks.items():
        of[rank] = token
    return {"bytes": np.frombuffer(b"".join(of), np.uint8), "ends": np.cumsum([0, *map(len, of)])}


def tables(ranks: dict[bytes, int]) -> dict:
    """What encoding and decoding look up, of a size that the vocabulary fixes.

    Besides classes and transitions: for every way to put a token together
    from two tokens the key (left, right) with its rank, sorted; and the bytes of
    all tokens in a row, by id.
    """
    import numpy as np

    size = max(ranks.values()) + 1
    pairs = {}
    for token, rank in ranks.items():
        for i in range(1, len(token)):
            a, b = ranks.get(token[:i]), ranks.get(token[i:])
            if a is not None and b is not None:
                pairs[a * size + b] = rank
    to, cut = transitions()
    single = np.array([ranks.get(bytes([i]), -1) for i in range(256)], np.int64)
    if (single < 0).any():
        raise ValueError("the vocabulary lacks single bytes, so not every text can be encoded")
    return {
        "classes": code_point_classes(),
        "monoid": monoid(to),
        "cut": cut,
        "size": size,
        "pairs": hashed(pairs, size),
        "known": pairs,
        "single": single,
        "whole": ranks,
    } | token_bytes(ranks)


class Merger:
    """Slices -> ids by pair merging, with a cache of what has been merged."""

    def __init__(self, t: dict):
        self.t = t
        self.clear()

    def clear(self) -> None:
        import numpy as np

        self.slot: dict[bytes, int] = {}
        self.flat = np.zeros(1 << 14, np.int32)
        self.ends = np.zeros(1 << 12, np.int64)  # of slot i: flat[ends[i]:ends[i + 1]]
        self.held = 0

    def pair_ranks(self, left, right):
        """Rank of what each two neighbours make; the vocabulary's size where that is no token."""
        import numpy as np

        keys, ranks = self.t["pairs"]
        key = left * self.t["size"] + right
        at = place(key, len(keys))
        out = ranks[at]
        open_ = np.flatnonzero((keys[at] != key) & (keys[at] >= 0))
        out[keys[at] != key] = self.t["size"]
        while len(open_):
            at[open_] = (at[open_] + 1) % len(keys)
            there = keys[at[open_]]
            out[open_] = np.where(there == key[open_], ranks[at[open_]], self.t["size"])
            open_ = open_[(there != key[open_]) & (there >= 0)]
        return out

    def merge_many(self, words: list[bytes]):
        """(ids in a row, ids per word): all words a round at a time, each merging its leftmost pair of least rank."""
        import numpy as np

        size = self.t["size"]
        n = np.array([len(w) for w in words], np.int64)
        ids = self.t["single"][np.frombuffer(b"".join(words), np.uint8)]
        own = np.repeat(np.arange(len(words)), n)
        done_ids, done_own = [], []
        # rank of each id with its right neighbour in the same word
        r = np.full(len(ids), size, np.int64)
        r[:-1] = np.where(own[:-1] == own[1:], self.pair_ranks(ids[:-1], ids[1:]), size)
        while len(ids):
            total = len(ids)
            first = np.flatnonzero(np.concatenate([[True], own[1:] != own[:-1]]))
            best = np.minimum.reduceat(r * total + np.arange(total), first)
            ended = best // total >= size
            keep = np.ones(total, bool)
            if ended.any():
                keep = ~np.repeat(ended, np.diff(np.concatenate([first, [total]])))
                done_ids.append(ids[~keep])
                done_own.append(own[~keep])
            live = best[~ended]
            at = live % total
            ids[at] = live // total
            keep[at + 1] = False
            ids, own, r = ids[keep], own[keep], r[keep]
            at = (np.cumsum(keep) - 1)[at]
            # only what stands beside a merged pair has a new rank
            near = np.concatenate([at, at[at > 0] - 1])
            near = near[near < len(ids) - 1]
            r[near] = np.where(own[near] == own[near + 1], self.pair_ranks(ids[near], ids[near + 1]), size)
            r[-1:] = size
        got, of = np.concatenate(done_ids), np.concatenate(done_own)
        order = np.argsort(of, kind="stable")
        return got[order], np.bincount(of, minlength=len(words))

    def merge_long(self, word: bytes) -> list[int]:
        """The same for one long word: a heap of its pairs over linked parts."""
        import heapq

        import numpy as np

        size = self.t["size"]
        ids = self.t["single"][np.frombuffer(word, np.uint8)]
        r = self.pair_ranks(ids[:-1], ids[1:])
        some = np.flatnonzero(r < size)
        heap = list(zip(r[some].tolist(), some.tolist(), ids[some].tolist(), ids[some + 1].tolist(), strict=True))
        heapq.heapify(heap)
        known = self.t["known"]
        ids = ids.tolist()
        after, before = list(range(1, len(ids) + 1)), list(range(-1, len(ids) - 1))
        while heap:
            rank, i, a, b = heapq.heappop(heap)
            j = after[i]
            if ids[i] != a or j >= len(ids) or ids[j] != b:  # one of the two has been merged since
                continue
            ids[i], ids[j], after[i] = rank, -1, after[j]
            if after[j] < len(ids):
                before[after[j]] = i
            for x, y in ((before[i], i), (i, after[i])):
                if x >= 0 and y < len(ids):
                    k = known.get(ids[x] * size + ids[y])
                    if k is not None:
                        heapq.heappush(heap, (k, x, ids[x], ids[y]))
        return [i for i in ids if i >= 0]

    def learn(self, words: list[bytes]) -> None:
        import numpy as np

        whole = self.t["whole"]
        for kind in (0, 1, 2):
            if kind == 0:  # a slice that is a token stays one, however it would be merged
                part = [w for w in words if w in whole]
                ids, sizes = np.array([whole[w] for w in part], np.int64), np.ones(len(part), np.int64)
            elif kind == 1:
                part = [w for w in words if len(w) <= SHORT and w not in whole]
                ids, sizes = self.merge_many(part) if part else (np.zeros(0, np.int64), np.zeros(0, np.int64))
            else:
                part = [w for w in words if len(w) > SHORT and w not in whole]
                many = [self.merge_long(w) for w in part]
                ids, sizes = np.array([i for x in many for i in x], np.int64), np.array([len(x) for x in many], np.int64)
            at, used = len(self.slot), int(self.ends[len(self.slot)])
            while used + len(ids) > len(self.flat):
                self.flat = np.concatenate([self.flat, np.zeros_like(self.flat)])
            while at + len(part) >= len(self.ends):
                self.ends = np.concatenate([self.ends, np.zeros_like(self.ends)])
            self.flat[used : used + len(ids)] = ids
            self.ends[at + 1 : at + 1 + len(part)] = used + np.cumsum(sizes)
            self.slot.update(zip(part, range(at, at + len(part)), strict=True))
            self.held += sum(map(len, part))

    def encode(self, texts):
        """(ids, byte offset in its text of each, ids per text) of an Arrow large_string array."""
        import numpy as np
        import pyarrow as pa

        raw, off = bytes_of(texts)
        starts = slice_starts(raw, off[1:], self.t["classes"], self.t["monoid"], self.t["cut"])
        if not len(starts):
            return np.zeros(0, np.int32), np.zeros(0, np.int64), np.zeros(len(texts), np.int64)
        bounds = np.concatenate([starts, [off[-1]]]).astype(np.int64)
        slices = pa.Array.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(bounds), pa.py_buffer(raw)])
        enc = slices.dictionary_encode()
        words = enc.dictionary.to_pylist()
        if len(self.slot) + len(words) > CACHE_SLICES or self.held > CACHE_BYTES:
            self.clear()
        missing = [w for w in words if w not in self.slot]
        if missing:
            self.learn(missing)
        slot = np.fromiter(map(self.slot.__getitem__, words), np.int64, len(words))[enc.indices.to_numpy(zero_copy_only=False)]
        n = self.ends[slot + 1] - self.ends[slot]
        ids = self.flat[_ranges(self.ends[slot], n)]
        upto = np.concatenate([[0], np.cumsum(n)])
        counts = np.diff(upto[np.searchsorted(starts, off)])
        size = np.diff(self.t["ends"])[ids]
        at = np.cumsum(size) - size  # ids cover the bytes without a gap
        return ids, at - np.repeat(off[:-1], counts), counts


def encode(docs: DataFrame, path: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, n_tokens, ids, starts), one row per row of ``docs``.

    ``ids`` and ``starts`` are binary: little-endian unsigned 32-bit ids, and as
    unsigned 64-bit numbers the byte offset of each id's first byte in the UTF-8
    text. Whole texts, without special tokens: their strings are ordinary text.
    Null texts are empty and have no ids; repeated rows and keys are encoded
    each; an empty table gives no rows; other columns are not read.
    """
    t = docs.sparkSession.sparkContext.broadcast(tables(read_ranks(path)))

    def run(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        merger = Merger(t.value)
        for b in batches:
            for first, part in text_slices(b.column(1), 1_500_000):
                ids, at, n = merger.encode(part)
                ends = np.concatenate([[0], np.cumsum(n)])
                packed = [
                    pa.Array.from_buffers(pa.large_binary(), len(part), [None, pa.py_buffer(np.ascontiguousarray(ends * x.itemsize, np.int64)), pa.py_buffer(x)]).cast(pa.binary())
                    for x in (np.ascontiguousarray(ids, "<u4"), np.ascontiguousarray(at, "<u8"))
                ]
                yield pa.RecordBatch.from_arrays([b.column(0).slice(first, len(part)), pa.array(n, pa.int64()), *packed], ["k", "n_tokens", "ids", "starts"])
        del merger
        give_back()

    src = docs.select(F.col(key).cast("bigint").alias("k"), F.coalesce(F.col(text), F.lit("")).alias("t"))
    return src.mapInArrow(run, "k bigint, n_tokens bigint, ids binary, starts binary").withColumnRenamed("k", key)


def decode(encoded: DataFrame, path: str, ids: str = "ids", out: str = "decoded") -> DataFrame:
    """``encoded`` with the bytes of its packed ids as ``out`` (replaced where it is there already).

    Null ids decode to no bytes; an id outside the vocabulary is an error.
    """
    t = encoded.sparkSession.sparkContext.broadcast(token_bytes(read_ranks(path)))
    rest = [c for c in encoded.columns if c != out]
    at = rest.index(ids)

    def run(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        flat, ends = t.value["bytes"], t.value["ends"]
        for b in batches:
            got = []
            for packed in b.column(at).to_pylist():
                x = np.frombuffer(packed or b"", "<u4").astype(np.int64)
                if len(x) and x.max() >= len(ends) - 1:
                    raise ValueError(f"id {x.max()} is not in the vocabulary")
                got.append(flat[_ranges(ends[x], ends[x + 1] - ends[x])].tobytes())
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(got, pa.binary())], [*rest, out])

    schema = encoded.select(*[F.col(f"`{c}`") for c in rest]).schema.add(out, "binary")
    return encoded.select(*[F.col(f"`{c}`") for c in rest]).mapInArrow(run, schema)
