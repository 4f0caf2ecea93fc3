"""Fast whole-text encoding with the public word tokenizer.

The tokenizer drops white space, so the ids of a text are those of its
white-space-separated chunks one after another. Chunks repeat: each distinct
one is encoded once per task by ``tokenizers`` itself and gathered from a
bounded cache afterwards, which gives the same ids as encoding the text whole
(tests hold it against the plain call).
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import give_back, text_slices

#: Words kept per task before the cache starts anew.
CACHE_WORDS = 500_000
#: Closing marks that are a piece of their own right after a letter.
MARKS = ".,"
#: Ends a word in the rank form of the vocabulary; never part of an all-letter word.
WORD_END = "\x01"


def byte_symbols() -> dict[str, int]:
    """Printable symbol -> byte, the fixed alphabet of byte-level BPE files."""
    shown = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


def letter_ranks(spec: str):
    """The vocabulary as byte ranks (ids in merge order), words closed by ``WORD_END``.

    Used for words of letters only, which are one piece each; the merges
    are the file's own, run by ``tiktoken`` over many words in one call.
    """
    import json

    import tiktoken

    model = json.loads(spec)["model"]
    byte, end = byte_symbols(), model["end_of_word_suffix"]
    ranks: dict[bytes, int] = {}
    for token, i in model["vocab"].items():
        word = token.endswith(end)
        body = token[: -len(end)] if word else token
        if body and all(c in byte for c in body):
            ranks[bytes(byte[c] for c in body) + WORD_END.encode() * word] = i
    return tiktoken.Encoding("letters", pat_str="[^ ]+| ", mergeable_ranks=ranks, special_tokens={})


class ChunkEncoder:
    """Vectorised text -> ids for the word tokenizer."""

    def __init__(self, spec: str):
        import os

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tok = Tokenizer.from_str(spec)
        self.letters = letter_ranks(spec)
        self.space = self.letters.encode_ordinary(" ")[0]
        self.marks = [self.tok.encode(m, add_special_tokens=False).ids[0] for m in MARKS]
        self.clear()

    def clear(self) -> None:
        import numpy as np

        self.slot: dict[str, int] = {"": 0}
        self.flat = np.zeros(1 << 16, np.uint32)
        self.ends = np.zeros(1 << 14, np.int64)  # of slot i: flat[ends[i]:ends[i + 1]]
        self.n = 1

    def _put(self, words: list[str], ids, sizes) -> None:
        import numpy as np

        at, used = self.n, int(self.ends[self.n])
        while used + len(ids) > len(self.flat):
            self.flat = np.concatenate([self.flat, np.zeros_like(self.flat)])
        while at + len(words) >= len(self.ends):
            self.ends = np.concatenate([self.ends, np.zeros_like(self.ends)])
        self.flat[used : used + len(ids)] = ids
        self.ends[at + 1 : at + 1 + len(words)] = used + np.cumsum(sizes)
        self.slot.update(zip(words, range(at, at + len(words)), strict=True))
        self.n += len(words)

    def _learn(self, words: list[str]) -> None:
        """Words of Latin-1 letters in bulk by ranks, all others by ``tokenizers``."""
        import numpy as np

        plain = [w for w in words if w.isalpha() and w.isascii() or w.isalpha() and max(w) <= "\xff"]
        for at in range(0, len(plain), 100_000):
            part = plain[at : at + 100_000]
            ids = np.array(self.letters.encode_ordinary(f"{WORD_END} ".join(part) + WORD_END), np.uint32)
            gaps = np.flatnonzero(ids == self.space)
            sizes = np.diff(np.concatenate([[-1], gaps, [len(ids)]])) - 1
            self._put(part, ids[ids != self.space], sizes)
        rest = [w for w in words if w not in self.slot]
        for at in range(0, len(rest), 50_000):
            part = rest[at : at + 50_000]
            got = [e.ids for e in self.tok.encode_batch_fast(part, add_special_tokens=False)]
            self._put(part, np.fromiter((i for x in got for i in x), np.uint32), [len(x) for x in got])

    def encode(self, texts, ids: bool = True):
        """(uint32 ids of all texts in a row or None, int64 id count of each text).

        A full stop or comma right after a Latin-1 letter is a piece of its
        own, and Latin-1 text is lower-cased by the tokenizer anyway, so
        chunks that differ in these share one cached word. Chunks that may
        hold a special token's string stay as they are.
        """
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc

        lists = pc.ascii_split_whitespace(texts)
        enc = lists.flatten().dictionary_encode()
        off = lists.offsets.to_numpy()
        off = off - off[0]
        chunks = enc.dictionary
        odd = pc.or_(pc.match_substring_regex(chunks, "[^\\x{0}-\\x{ff}]"), pc.match_substring(chunks, "<|"))
        marked = pc.and_(pc.match_substring_regex(chunks, r"\p{L}[.,]$"), pc.invert(odd))
        tail = np.full(len(chunks), -1, np.int64)
        for m, i in zip(MARKS, self.marks, strict=True):
            tail[pc.and_(marked, pc.ends_with(chunks, m)).to_numpy(zero_copy_only=False)] = i
        core = pc.if_else(marked, pc.utf8_slice_codeunits(chunks, 0, -1), chunks)
        core = pc.if_else(odd, core, pc.utf8_lower(core)).dictionary_encode()
        words = core.dictionary.to_pylist()
        if len(self.slot) + len(words) > CACHE_WORDS:
            self.clear()
        missing = [w for w in words if w not in self.slot]
        if missing:
            self._learn(missing)
        slot = np.fromiter(map(self.slot.__getitem__, words), np.int64, len(words))[core.indices.to_numpy(zero_copy_only=False)]
        size = self.ends[slot + 1] - self.ends[slot]
        has = tail >= 0
        at = enc.indices.to_numpy(zero_copy_only=False)
        n = (size + has)[at]
        ends = np.concatenate([[0], np.cumsum(n)])
        counts = ends[off[1:]] - ends[off[:-1]]
        if not ids:
            return None, counts
        # ids of the slice's distinct chunks in a row, then of all chunks
        start = np.concatenate([[0], np.cumsum(size + has)])
        own = np.empty(start[-1], np.uint32)
        own[(start[1:] - 1)[has]] = tail[has]
        body = np.ones(len(own), bool)
        body[(start[1:] - 1)[has]] = False
        own[body] = self.flat[_ranges(self.ends[slot], size)]
        return own[_ranges(start[:-1][at], n)], counts


def _ranges(starts, sizes):
    """starts[0], starts[0]+1, ... for ``sizes[0]`` entries, then the next."""
    import numpy as np

    ends = np.cumsum(sizes)
    total = int(ends[-1]) if len(ends) else 0
    kind = np.int32 if total < 2**31 and (not len(starts) or int(starts.max()) + total < 2**31) else np.int64
    out = np.repeat((starts - ends + sizes).astype(kind), sizes)
    out += np.arange(total, dtype=kind)
    return out


def read_spec(path: str) -> str:
    """The tokenizer file's content; of a fixed size, so it may be broadcast."""
    with open(path, encoding="utf-8") as f:
        return f.read()


def token_counts(docs: DataFrame, path: str, text: str = "text") -> DataFrame:
    """Partial counts (length, documents) of encoded lengths, one row per length and batch."""
    spec = docs.sparkSession.sparkContext.broadcast(read_spec(path))

    def run(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        enc = ChunkEncoder(spec.value)
        for b in batches:
            got = [enc.encode(part, ids=False)[1] for _, part in text_slices(b.column(0))]
            if got:
                n, c = np.unique(np.concatenate(got), return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(n, pa.int64()), pa.array(c, pa.int64())], ["length", "documents"])
        del enc
        give_back()

    return docs.select(F.coalesce(F.col(text), F.lit("")).alias("t")).mapInArrow(run, "length bigint, documents bigint")
