"""Language identification by prediction by partial matching (operator 6).

Per language, a context tree over bytes holds how often each byte followed
each context of up to ``order`` bytes. Escape probabilities (method C: a
context seen T times with D different bytes escapes with D/(T+D)) lead to the
next shorter context. With the statistics frozen, the code length of a byte
in its context is a constant, so the trees are compiled to tables and whole
texts are scored by array look-ups: exact code lengths, summed per language.
The language with the shortest code wins.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import bytes_of, give_back, rebuilt, text_slices

UNKNOWN = "und"


class ContextTrees:
    """The compiled trees of all languages over one shared trie of contexts.

    ``child[d][node * width + symbol]`` leads from an n-gram of d bytes to
    the one that is a byte longer (-1: never seen in any language), ``cost``
    holds the last byte's code length in bits per language, ``escape`` the
    sum of escapes from the n-gram as a context down to the empty one.
    """

    def __init__(self, langs: list[str], order: int, grams: list, counts: list):
        """grams[d]: sorted unique codes of n-grams of d + 1 symbols (base ``width``); counts[d]: (n-grams, languages)."""
        import numpy as np

        self.langs, self.order = langs, order
        width = self.width
        n_lang = len(langs)
        self.child, self.cost, self.escape = [], [], []
        # level 0: the empty context
        prev = np.zeros(1, np.int64)
        self.escape.append(None)
        prev_suffix_cost = None
        for d in range(order + 1):
            codes, cnt = grams[d], counts[d].astype(np.float64)
            ctx = np.searchsorted(prev, codes // width) if d else np.zeros(len(codes), np.int64)
            table = np.full(len(prev) * width, -1, np.int32)
            table[ctx * width + codes % width] = np.arange(len(codes), dtype=np.int32)
            self.child.append(table)
            total = np.zeros((len(prev), n_lang))
            kinds = np.zeros((len(prev), n_lang))
            np.add.at(total, ctx, cnt)
            np.add.at(kinds, ctx, cnt > 0)
            with np.errstate(divide="ignore", invalid="ignore"):
                esc = np.where(total > 0, np.log2((total + kinds) / np.maximum(kinds, 1)), 0.0)
                own = np.log2((total + kinds)[ctx]) - np.log2(cnt)
            if d == 0:
                below = np.full((len(codes), n_lang), 8.0)  # order -1: any byte alike
                self.escape[0] = esc
            else:
                # the same byte in the context without its first byte
                short = np.searchsorted(grams[d - 1], codes % width**d)
                below = prev_suffix_cost[short]
                shorter = self._suffix(prev, d, grams)
                self.escape.append(esc + self.escape[d - 1][shorter])
            cost = np.where(cnt > 0, own, esc[ctx] + below)
            self.cost.append(cost)
            prev_suffix_cost, prev = cost, codes
        self.cost = [c.astype(np.float32) for c in self.cost]
        self.escape = [e.astype(np.float32) for e in self.escape]

    width = 257  # bytes and one symbol for "before the text"

    def _suffix(self, codes, d: int, grams):
        """Rows of the (d - 1)-byte suffixes of d-byte contexts."""
        import numpy as np

        if d == 1:
            return np.zeros(len(codes), np.int64)
        return np.searchsorted(grams[d - 2], codes % self.width ** (d - 1))

    def bits(self, raw, off):
        """Code length in bits of every text, per language (texts, languages)."""
        import numpy as np

        n, n_lang = len(raw), len(self.langs)
        out = np.zeros((len(off) - 1, n_lang))
        if not n:
            return out
        at_start = np.zeros(n, np.int64)  # position within its text, at most order + 1
        starts = off[:-1][np.diff(off) > 0]
        at_start[:] = self.order + 1
        for k in range(self.order + 1):
            p = starts + k
            p = p[(p < n)]
            at_start[p] = np.minimum(at_start[p], k)
        at_start[starts] = 0
        # node[d]: the n-gram of d bytes that ends here; -1 if never seen
        sym = raw.astype(np.int32)
        node = self.child[0][sym]
        got = np.zeros(n, np.int8)  # longest known n-gram ending here
        best = np.where(node >= 0, node, 0)
        got[node >= 0] = 1
        ctx_len = np.zeros(n, np.int8)  # longest known context before
        ctx = np.zeros(n, np.int32)
        before = node
        for d in range(1, self.order + 1):
            last = np.empty(n, np.int32)
            last[0], last[1:] = -1, before[:-1]
            last[at_start < d] = -1
            seen = np.flatnonzero(last >= 0)
            ctx_len[seen], ctx[seen] = d, last[seen]
            node = np.full(n, -1, np.int32)
            node[seen] = self.child[d][last[seen].astype(np.int64) * self.width + sym[seen]]
            hit = seen[node[seen] >= 0]
            got[hit], best[hit] = d + 1, node[hit]
            before = node
        cost = np.empty((n, n_lang), np.float32)
        for d in range(self.order + 2):
            rows = np.flatnonzero(got == d)
            if not len(rows):
                continue
            cost[rows] = 8.0 if d == 0 else self.cost[d - 1][best[rows]]
            # escapes from the longest known context down to the one that knew the byte
            far = rows[ctx_len[rows] >= max(d, 1)]
            for m in range(max(d, 1), self.order + 1):
                r = far[ctx_len[far] == m]
                if len(r):
                    down = self._down(ctx[r], m, max(d - 1, 0))
                    cost[r] += self.escape[m][ctx[r]] - (self.escape[max(d - 1, 0)][down] if d else 0)
            if d == 0:
                none = rows[ctx_len[rows] == 0]
                cost[none] += self.escape[0][0]
        full = np.diff(off) > 0
        out[full] = np.add.reduceat(cost.astype(np.float64), starts, axis=0)
        return out

    def _down(self, nodes, m: int, to: int):
        """The ``to``-byte suffix of m-byte contexts."""
        import numpy as np

        for d in range(m, to, -1):
            nodes = self.up[d][nodes]
        return nodes if to else np.zeros(len(nodes), np.int64)


def build_trees(counts: list[tuple[str, int, int, int]], order: int) -> ContextTrees:
    """Trees from rows (language, bytes of the n-gram, code, count)."""
    import numpy as np

    langs = sorted({r[0] for r in counts})
    where = {x: i for i, x in enumerate(langs)}
    width = ContextTrees.width
    grams, cnts = [], []
    for d in range(order + 1):
        rows = [(r[2], where[r[0]], r[3]) for r in counts if r[1] == d + 1]
        code = np.array([r[0] for r in rows], np.int64)
        u, inv = np.unique(code, return_inverse=True)
        c = np.zeros((len(u), len(langs)), np.int64)
        np.add.at(c, (inv, [r[1] for r in rows]), [r[2] for r in rows])
        grams.append(u)
        cnts.append(c)
    t = ContextTrees(langs, order, grams, cnts)
    # suffix links between contexts
    t.up = [None] + [
        (np.zeros(len(grams[d - 1]), np.int32) if d == 1 else np.searchsorted(grams[d - 2], grams[d - 1] % width ** (d - 1)).astype(np.int32))
        for d in range(1, order + 1)
    ]
    return t


def gram_counts(texts: DataFrame, order: int) -> DataFrame:
    """(lang, n, code, count) of all byte n-grams of up to order + 1 bytes of (lang, text)."""

    def run(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        for b in batches:
            langs = np.array(b.column(0).to_pylist(), object)
            for first, part in text_slices(b.column(1), 2_000_000):
                raw, off = bytes_of(part)
                own = np.repeat(np.arange(len(part)), np.diff(off))
                lang = langs[first : first + len(part)]
                for d in range(order + 1):
                    if len(raw) <= d:
                        continue
                    code = np.zeros(len(raw) - d, np.int64)
                    for j in range(d + 1):
                        code = code * ContextTrees.width + raw[j : len(raw) - d + j]
                    same = own[: len(raw) - d] == own[d:]
                    for x in sorted(set(lang)):
                        u, c = np.unique(code[same & (lang == x)[own[d:]]], return_counts=True)
                        yield pa.RecordBatch.from_arrays([pa.array([x] * len(u), pa.string()), pa.array([d + 1] * len(u), pa.int32()), pa.array(u), pa.array(c)], ["lang", "n", "code", "c"])
        give_back()

    parts = texts.mapInArrow(run, "lang string, n int, code bigint, c bigint")
    return parts.groupBy("lang", "n", "code").agg(F.sum("c").alias("c"))


def fit(
    docs: DataFrame,
    order: int = 4,
    max_rows: int = 400,
    max_bytes: int = 20_000,
    text: str = "text",
    lang: str = "lang",
    key: str = "doc_id",
    min_count: int = 2,
) -> ContextTrees:
    """Trees of the languages of ``docs`` (labelled rows only), from a bounded sample.

    Sampled are at most ``max_rows`` rows per language, in the order of a
    hash of the key, of the rows whose text has at most ``max_bytes`` bytes
    (longer ones only if a language has no others). N-grams of two bytes and more
    that are counted less than ``min_count`` times over all languages are left out:
    most are met once, and with ``min_count`` 1 the trees are the exact ones, several times as large. Rows with null text or
    language teach nothing; an empty table gives trees of no language.
    """
    from pyspark.sql import Window

    rows = docs.filter(F.col(text).isNotNull() & F.col(lang).isNotNull() & (F.length(text) > 0))
    # keys only: per language, the first rows by size class and hash; slices keep a window small
    x = rows.select(F.col(lang).alias("l"), (F.octet_length(text) > max_bytes).cast("int").alias("big"), F.xxhash64(key, text).alias("h"))
    x = x.withColumn("s", F.pmod("h", F.lit(1024)))
    w = Window.partitionBy("l", "s").orderBy("big", "h")
    top = x.withColumn("r", F.row_number().over(w)).filter(F.col("r") <= max_rows)
    # at most 1,024 * max_rows rows of a language reach the second window
    w2 = Window.partitionBy("l").orderBy("big", "h")
    top = top.withColumn("r", F.row_number().over(w2)).filter(F.col("r") <= max_rows).select("l", "h").distinct()
    chosen = rows.select(F.col(lang).alias("l0"), F.col(text).alias("t0"), F.xxhash64(key, text).alias("h0"))
    chosen = chosen.join(F.broadcast(top), (F.col("l0") == F.col("l")) & (F.col("h0") == F.col("h")), "left_semi").select("l0", "t0")
    counts = gram_counts(chosen, order)
    if min_count > 1:
        seen = counts.groupBy("n", "code").agg(F.sum("c").alias("all")).filter((F.col("all") >= min_count) | (F.col("n") == 1)).select("n", "code")
        counts = counts.join(seen, ["n", "code"], "left_semi")
    got = counts.select("lang", "n", "code", "c").toArrow()
    data = list(zip(*(got.column(c).to_pylist() for c in ("lang", "n", "code", "c")), strict=True))
    return build_trees(data, order)


def predict(docs: DataFrame, trees: ContextTrees, text: str = "text", pred: str = "lang_pred", score_as: str = "score") -> DataFrame:
    """Adds ``pred`` and ``score_as`` to ``docs``; every other column stays (older ones of these names go).

    The score is the winner's posterior under equal priors, from code lengths
    of the whole text: 2^-bits over the sum for all languages. A null text
    or one without a letter is ``und`` with score 0. Ties go to the language
    first in code-point order. Without any learned language all are ``und``;
    repeated rows are judged each, an empty table gives no rows.
    """
    model = docs.sparkSession.sparkContext.broadcast(vars(trees))
    docs = docs.drop(pred, score_as)
    names = docs.columns
    at = names.index(text)

    def run(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc

        t = rebuilt(ContextTrees, model.value)
        for b in batches:
            col = b.column(at).cast(pa.large_string())
            letters = pc.fill_null(pc.match_substring_regex(col, "\\p{L}"), False).to_numpy(zero_copy_only=False)
            bits = [np.zeros((0, max(1, len(t.langs))))]
            if t.langs:
                for _, part in text_slices(pc.fill_null(col, ""), 2_000_000):
                    bits.append(t.bits(*bytes_of(part)))
            bits = np.concatenate(bits)
            if len(t.langs) and len(b.column(0)):
                won = bits.argmin(axis=1)
                low = bits.min(axis=1, keepdims=True)
                score = 1.0 / np.exp2(np.clip(low - bits, -1000, 0)).sum(axis=1)
            else:
                won, score = np.zeros(len(col), int), np.zeros(len(col))
            known = letters & bool(t.langs)
            named = [t.langs[i] if k else UNKNOWN for i, k in zip(won, known, strict=True)]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(named, pa.string()), pa.array(np.where(known, score, 0.0))], [*names, pred, score_as])
        del t
        give_back()

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields)
    return docs.mapInArrow(run, schema + f", `{pred}` string, `{score_as}` double")
