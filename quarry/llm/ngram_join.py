"""N-gram Jaccard join over count vectors (operator 7).

Shingles are hashed into groups and the counts per group are a point. Two
sets share at most the sum of the coordinate-wise minima of their points, so
an R-tree over points, whose nodes keep the largest count of each coordinate,
finds every pair whose bound reaches the threshold; such pairs are verified
on the sets.

One tree over all documents would be walked almost whole for each of them,
as no single coordinate tells unlike texts apart. So trees are built per
block, and blocks come from the groups too: two sets with likeness t differ
in at most k = (|A|+|B|)(1-t)/(1+t) shingles, and of more than k groups one is
then the same in both. Documents with an equal group form a block. With some
spare groups, linked pairs have several blocks in common, and each document
leaves out its most frequent ones but that many. No linked pair is outside
every block that is left, so the join is exact.

Sets that are equal form one class before anything else. Each class first
meets one pivot of its blocks; blocks still in several components compare
members with two pivots of their own, and what is then still apart is searched
by the block's tree. Pairs inside a
component are not needed for membership and never made.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quarry.llm.common import give_back, suspects, text_slices
from quarry.llm.graph import components
from quarry.session import materialize, release

#: Coordinates of the points.
GROUPS = 128
#: Sets keep 48 bits of each shingle's hash.
SET_BITS = 48
#: One spare group for so many needed ones. Sets that share a part of their shingles have few equal groups, those
#: that link many: with more spare groups fewer false partners are left, at more keys a set.
SPARE = 2


def bands(percent: int, upto: int) -> list[int]:
    """Lower ends of the size bands 1, 2, 3, 4, 6, 9, 13, ..."""
    ends = [1]
    while ends[-1] <= upto:
        ends.append(max(ends[-1] + 1, ends[-1] * 3 // 2))
    return ends


def differing(top: int, percent: int) -> int:
    """Most shingles in which two linked sets of at most ``top`` each differ."""
    # |A∩B| >= p/(100+p) * (|A|+|B|), so |AΔB| <= (100-p)/(100+p) * (|A|+|B|)
    return (100 - percent) * 2 * top // (100 + percent)


def mix64(x):
    """A 64-bit finaliser (multiply and shift) over a numpy uint64 array."""
    import numpy as np

    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def shingle_hashes(texts, width: int = 3):
    """(uint64 shingle hashes of all texts in a row, offsets). A-Z is lower-cased.

    Fewer words than ``width`` give the whole sequence as one; no word, none.
    """
    import numpy as np
    import pandas as pd
    import pyarrow.compute as pc

    lists = pc.ascii_split_whitespace(pc.ascii_lower(texts))
    enc = lists.flatten().dictionary_encode()
    own = pd.util.hash_array(np.array(enc.dictionary.to_pylist(), dtype=object), categorize=False)
    empty = np.array([w == "" for w in enc.dictionary.to_pylist()], bool)
    at = enc.indices.to_numpy(zero_copy_only=False)
    off = lists.offsets.to_numpy().astype(np.int64)
    off = off - off[0]
    real = ~empty[at]
    before = np.concatenate([[0], np.cumsum(real)])
    off, w = before[off], own[at[real]]
    n = np.diff(off)
    many = np.maximum(n - width + 1, 0)
    many[(n > 0) & (n < width)] = 1
    out = np.concatenate([[0], np.cumsum(many)])
    starts = np.repeat(off[:-1] - out[:-1], many) + np.arange(out[-1])
    h = np.zeros(out[-1], np.uint64)
    short = np.repeat((n > 0) & (n < width), many)
    ends = np.repeat(off[1:], many)
    for j in range(width):
        has = starts + j < ends
        word = np.where(has, w[np.minimum(starts + j, max(len(w) - 1, 0))], np.uint64(0)) if len(w) else h
        h = mix64(h * np.uint64(0x9E3779B97F4A7C15) + word + np.uint64(j + 1))
    h[short] = mix64(h[short] + np.uint64(0x5851F42D4C957F2D))  # never equal to a full shingle
    return h, out


def band_keys(s, percent: int, ends):
    """(band, need, uint64 block keys) of one sorted shingle set, per size band in which a partner may be the larger set.

    The set is dealt to k + 1 + spare groups, of which a linked set has at
    least spare + 1 in common. Groups without shingles make no key unless more
    groups than the spare ones are empty. ``need`` keys at least are in common
    with every linked set, as groups that are empty in both are empty here.
    """
    import numpy as np

    n = len(s)
    out = []
    for b in range(int(np.searchsorted(ends, n, side="right")) - 1, len(ends) - 1):
        if 100 * n < percent * ends[b]:
            break
        k = differing(int(ends[b + 1]) - 1, percent)
        if k == 0:
            continue
        spare = max(1, (k + 1) // SPARE)
        m = k + 1 + spare
        g = (s >> np.uint64(20)) % np.uint64(m)
        order = np.argsort(g, kind="stable")
        g, x = g[order], mix64(s[order])
        first = np.flatnonzero(np.concatenate([[True], g[1:] != g[:-1]]))
        sums = np.add.reduceat(x, first)
        groups = g[first]
        empty = m - len(groups)
        if empty > spare:
            none = np.setdiff1d(np.arange(m, dtype=np.uint64), groups)
            groups, sums = np.concatenate([groups, none]), np.concatenate([sums, np.zeros(len(none), np.uint64)])
        out.append((b, max(1, spare + 1 - empty), mix64(sums + mix64(groups + np.uint64(b << 32)))))
    return out


def block_keys(s, percent: int, ends):
    """All block keys of one sorted shingle set."""
    import numpy as np

    keys = [k for _, _, k in band_keys(s, percent, ends)]
    return np.concatenate(keys) if keys else np.zeros(0, np.uint64)


def packed_point(s) -> bytes:
    """Group counts of a set: 16 bits each, or 32 where one of them needs more."""
    import numpy as np

    c = np.bincount((s & np.uint64(GROUPS - 1)).astype(np.int64), minlength=GROUPS)
    return c.astype("<u2" if c.max() <= 65535 else "<u4").tobytes()


def unpacked_points(raws: list):
    """Points as ``packed_point`` gives them, one per row, 32 bits a coordinate."""
    import numpy as np

    out = np.empty((len(raws), GROUPS), np.uint32)
    wide = np.array([len(r) > 2 * GROUPS for r in raws], bool)
    for kind, rows in (("<u2", np.flatnonzero(~wide)), ("<u4", np.flatnonzero(wide))):
        out[rows] = np.frombuffer(b"".join(raws[i] for i in rows), kind).reshape(-1, GROUPS)
    return out


def set_name(s) -> int:
    """64-bit name of a sorted shingle set."""
    import hashlib

    return int.from_bytes(hashlib.blake2b(s.tobytes(), digest_size=8).digest(), "little", signed=True)


def shingle_sets(docs: DataFrame, key: str = "doc_id", text: str = "text", percent: int = 90, width: int = 3) -> DataFrame:
    """(id, cls, n, point, blocks): one row per document.

    ``cls`` names the set (equal sets, equal name; null for an empty one),
    ``point`` holds the group counts, ``blocks`` the keys per size band.
    """

    def run(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        ends = np.array(bands(percent, 1 << 40), np.int64)
        for b in batches:
            ids = b.column(0)
            for first, part in text_slices(b.column(1)):
                h, off = shingle_hashes(part, width)
                cls, n, point, found = [], [], [], []
                for i in range(len(part)):
                    s = np.unique(h[off[i] : off[i + 1]])
                    n.append(len(s))
                    cls.append(set_name(s) if len(s) else None)
                    point.append(packed_point(s) if len(s) else None)
                    found.append(band_keys(s, percent, ends) if len(s) else [])
                per = [x for f in found for x in f]
                keys = np.concatenate([np.zeros(0, np.uint64), *(k for _, _, k in per)]).view(np.int64)
                ends_of = lambda sizes: pa.array(np.concatenate([[0], np.cumsum(sizes)]), pa.int32())
                inner = pa.ListArray.from_arrays(ends_of([len(k) for _, _, k in per]), pa.array(keys))
                each = pa.StructArray.from_arrays([pa.array([x[0] for x in per], pa.int32()), pa.array([x[1] for x in per], pa.int32()), inner], ["band", "need", "keys"])
                blocks = pa.ListArray.from_arrays(ends_of([len(f) for f in found]), each)
                yield pa.RecordBatch.from_arrays(
                    [ids.slice(first, len(part)), pa.array(cls, pa.int64()), pa.array(n, pa.int64()), pa.array(point, pa.binary()), blocks], ["id", "cls", "n", "point", "blocks"]
                )
        give_back()

    src = docs.select(F.col(key).cast("bigint").alias("id"), F.coalesce(F.col(text), F.lit("")).alias("t"))
    return src.mapInArrow(run, "id bigint, cls bigint, n bigint, point binary, blocks array<struct<band:int,need:int,keys:array<bigint>>>")


def whole_sets(docs: DataFrame, named: DataFrame, key: str = "doc_id", text: str = "text", width: int = 3) -> DataFrame:
    """(cls, shingles): the sorted hashes of the sets in ``named`` (cls, id), made anew from the texts.

    Only rows whose key may be wanted are read into a task; sets are several
    times the size of what finds them, so they are not kept.
    """

    def run(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        for b in batches:
            for _, part in text_slices(b.column(0)):
                h, off = shingle_hashes(part, width)
                sets = [np.unique(h[off[i] : off[i + 1]]) for i in range(len(part))]
                sets = [s for s in sets if len(s)]
                kept = [np.sort(s >> np.uint64(64 - SET_BITS)).view(np.uint8).reshape(-1, 8)[:, : SET_BITS // 8].tobytes() for s in sets]
                yield pa.RecordBatch.from_arrays([pa.array([set_name(s) for s in sets], pa.int64()), pa.array(kept, pa.binary())], ["cls", "shingles"])
        give_back()

    src = docs.select(F.col(key).cast("bigint").alias("id"), F.coalesce(F.col(text), F.lit("")).alias("t"))
    maybe = suspects(src, "id", named.select(F.col("id").alias("_w"))).filter("_maybe").select("t")
    made = maybe.mapInArrow(run, "cls bigint, shingles binary")
    return made.join(named.select("cls"), "cls", "left_semi").dropDuplicates(["cls"])


def among(rows: DataFrame, key: str, wanted: DataFrame, bits: int = 1 << 24) -> DataFrame:
    """``rows`` whose ``key`` may be in ``wanted``: a bitmap of key hashes, broadcast.

    At most ``bits``/64 rows whatever the tables hold; a key that shares a
    bit comes along, so an exact join follows. Keeps unmatched rows, and the
    sets they carry, out of the shuffle.
    """
    bit = F.pmod(F.xxhash64(key), F.lit(bits))
    mask = F.expr(f"shiftleft(1L, cast(pmod(xxhash64({key}), {bits}L) % 64 AS int))")
    seen = wanted.groupBy(F.floor(bit / 64).alias("_word")).agg(F.bit_or(mask).alias("_mask"))
    x = rows.withColumn("_word", F.floor(bit / 64)).join(F.broadcast(seen), "_word")
    return x.filter(mask.bitwiseAND(F.col("_mask")) != 0).drop("_word", "_mask")


def enough(n_a, n_b, percent: int):
    """Least intersection of linked sets of these sizes."""
    return -(-(percent * (n_a + n_b)) // (100 + percent))


def unpacked(raw: bytes):
    """Sorted shingle hashes of a set as kept."""
    import numpy as np

    x = np.frombuffer(raw, np.uint8).reshape(-1, SET_BITS // 8)
    out = np.zeros((len(x), 8), np.uint8)
    out[:, : SET_BITS // 8] = x
    return out.view("<u8").ravel()


def sizes_link(a: str, b: str, percent: int):
    """True where sets of these sizes can link: the intersection is at most the smaller, the union at least the larger."""
    return 100 * F.least(a, b) >= percent * F.greatest(a, b)


def verified(pairs: DataFrame, sets: DataFrame, percent: int, whole=None) -> DataFrame:
    """Pairs (a, b) of classes that link: their sizes, then the bound on their points, then the sets themselves.

    sets: (cls, n, point), and shingles unless ``whole`` gives those of some
    classes: (cls) -> (cls, shingles).
    """
    size = lambda c: sets.select(F.col("cls").alias(c), F.col("n").alias(f"n_{c}"))
    near = pairs.select("a", "b").join(size("a"), "a").join(size("b"), "b").filter(sizes_link("n_a", "n_b", percent))
    # a class's point meets all its pairs where it is: it moves once, and once more with the pair
    point = lambda c: sets.select(F.col("cls").alias(c), F.col("point").alias(f"p_{c}"))
    near = near.join(point("a"), "a").join(point("b"), "b")

    def bounded(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        for t in batches:
            if not t.num_rows:
                continue
            p = [unpacked_points(t.column(c).to_pylist()) for c in ("p_a", "p_b")]
            need = enough(t.column("n_a").to_numpy(), t.column("n_b").to_numpy(), percent)
            yield t.select(["a", "b"]).filter(pa.array(np.minimum(*p).sum(axis=1, dtype=np.int64) >= need))

    near = materialize(near.select("a", "b", "n_a", "n_b", "p_a", "p_b").mapInArrow(bounded, "a bigint, b bigint"), "jaccard-near")
    if whole is None:
        full = sets.select("cls", "shingles")
    else:
        wanted = near.select(F.col("a").alias("cls")).unionByName(near.select(F.col("b").alias("cls"))).distinct()
        full = materialize(whole(wanted), "jaccard-whole")
    both = near.join(full.select(F.col("cls").alias("a"), F.col("shingles").alias("s_a")), "a")
    both = both.join(full.select(F.col("cls").alias("b"), F.col("shingles").alias("s_b")), "b")

    def exact(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        for t in batches:
            ok = []
            for x, y in zip(t.column("s_a").to_pylist(), t.column("s_b").to_pylist(), strict=True):
                x, y = unpacked(x), unpacked(y)
                common = len(x) + len(y) - len(np.union1d(x, y))
                ok.append(100 * common >= percent * (len(x) + len(y) - common))
            yield t.select(["a", "b"]).filter(pa.array(ok, pa.bool_()))
        give_back()

    out = materialize(both.select("a", "b", "s_a", "s_b").mapInArrow(exact, "a bigint, b bigint"), "jaccard-links")
    release(near, *([full] if whole is not None else []))
    return out


def rarest(members: DataFrame) -> DataFrame:
    """Memberships (block, cls, band, need, size) without each class's ``need`` - 1 most frequent blocks of a band.

    Linked sets have ``need`` keys of a band or more in common. Of these, the one
    that comes first by (size, block) is among no class's need - 1 last ones, so
    every linked pair still meets; documents that merely share some passages
    mostly have fewer blocks in common with anyone, and none is left.
    """
    one = Window.partitionBy("cls", "band").orderBy(F.desc("size"), F.desc("block"))
    return members.withColumn("_k", F.row_number().over(one)).filter("_k >= need").drop("_k")


class CountTree:
    """R-tree over count vectors, packed top-down by the widest coordinate.

    A node keeps the largest count per coordinate, its smallest set size and
    the component of its points where that is one. ``search`` returns points
    of other components whose summed coordinate minima reach what their
    sizes need.
    """

    LEAF = 48

    def __init__(self, points, sizes, comps):
        import numpy as np

        self.points, self.sizes, self.comps = points, sizes, comps
        self.nodes = []  # (upper corner, least size, component or None, row indices or children)
        self.root = self._build(np.arange(len(points)))

    def _build(self, rows):
        p = self.points[rows]
        comps = self.comps[rows]
        one = int(comps[0]) if (comps == comps[0]).all() else None
        if len(rows) <= self.LEAF:
            below = (rows, None)
        else:
            wide = int((p.max(axis=0) - p.min(axis=0)).argmax())
            order = rows[p[:, wide].argsort(kind="stable")]
            half = len(order) // 2
            below = (None, (self._build(order[:half]), self._build(order[half:])))
        self.nodes.append((p.max(axis=0), int(self.sizes[rows].min()), one, *below))
        return len(self.nodes) - 1

    def search(self, point, size: int, comp: int, percent: int):
        import numpy as np

        found, todo = [], [self.root]
        while todo:
            upper, least, one, rows, children = self.nodes[todo.pop()]
            if one == comp or np.minimum(upper, point).sum() < enough(size, least, percent):
                continue
            if children is not None:
                todo.extend(children)
                continue
            rows = rows[self.comps[rows] != comp]
            bound = np.minimum(self.points[rows], point).sum(axis=1)
            found.append(rows[bound >= enough(size, self.sizes[rows], percent)])
        return np.concatenate(found) if found else np.zeros(0, np.int64)


def tree_pairs(members: DataFrame, percent: int, part_rows: int = 4096) -> DataFrame:
    """Pairs of one block and of different components whose bound reaches the threshold.

    members: (block, cls, comp, n, point). A block beyond ``part_rows`` is
    dealt to parts by class, and each part meets each other one in a group
    of its own, so that no group grows with the block.
    """
    size = members.groupBy("block").agg(F.count(F.lit(1)).alias("_c"))
    parts = F.ceil(F.col("_c") / part_rows).cast("int")
    x = members.join(size, "block").withColumn("_p", parts).withColumn("_i", F.pmod(F.xxhash64("cls"), F.col("_p")).cast("int"))
    x = x.withColumn("_j", F.explode(F.sequence(F.lit(0), F.col("_p") - 1)))
    x = x.withColumn("_lo", F.least("_i", "_j")).withColumn("_hi", F.greatest("_i", "_j"))
    total = max(1, members.count())
    packs = max(1, total // part_rows)
    pack = F.when(F.col("_p") == 1, F.pmod(F.xxhash64("block"), F.lit(packs))).otherwise(-1 - F.abs(F.xxhash64("block", "_lo", "_hi") / 2).cast("bigint"))
    x = x.select(pack.alias("pack"), "block", "cls", "comp", "n", "point", "_i", "_lo", "_hi")

    def run(table):
        import numpy as np
        import pyarrow as pa

        block, lo, hi, own = (table.column(c).to_numpy() for c in ("block", "_lo", "_hi", "_i"))
        cls, comp, n = (table.column(c).to_numpy() for c in ("cls", "comp", "n"))
        pts = unpacked_points(table.column("point").to_pylist()).astype(np.int32)
        corners: dict = {}
        order = np.lexsort((hi, lo, block))
        key = np.stack([block, lo, hi], axis=1)[order]
        cuts = np.flatnonzero(np.concatenate([[True], (key[1:] != key[:-1]).any(axis=1)]))
        a, b = [], []
        for rows in np.split(order, cuts[1:]):
            if len(rows) < 2 or (comp[rows] == comp[rows[0]]).all():
                continue
            across = lo[rows[0]] != hi[rows[0]]
            if not across and len(rows) <= CountTree.LEAF:  # one leaf: its pairs at once
                i, j = corners.setdefault(len(rows), np.triu_indices(len(rows), 1))
                i, j = rows[i], rows[j]
                ok = (comp[i] != comp[j]) & (100 * np.minimum(n[i], n[j]) >= percent * np.maximum(n[i], n[j]))
                i, j = i[ok], j[ok]
                ok = np.minimum(pts[i], pts[j]).sum(axis=1) >= enough(n[i], n[j], percent)
                a.extend(cls[i[ok]].tolist())
                b.extend(cls[j[ok]].tolist())
                continue
            base = rows[own[rows] == lo[rows[0]]] if across else rows
            asked = rows[own[rows] == hi[rows[0]]] if across else rows
            if not len(base):
                continue
            tree = CountTree(pts[base], n[base], comp[base])
            for q in asked:
                for f in tree.search(pts[q], int(n[q]), int(comp[q]), percent):
                    if across or cls[base[f]] < cls[q]:
                        a.append(cls[base[f]])
                        b.append(cls[q])
        a, b = np.array(a, np.int64), np.array(b, np.int64)
        return pa.table({"a": np.minimum(a, b), "b": np.maximum(a, b)})

    # searching costs far more than its few bytes tell: as many tasks as packs, not as bytes
    width = max(packs, int(members.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    return x.repartition(width, "pack").groupBy("pack").applyInArrow(run, "a bigint, b bigint").distinct()


def jaccard_components(docs: DataFrame, key: str = "doc_id", text: str = "text", percent: int = 90, width: int = 3) -> DataFrame:
    """(key, n_shingles, component_id), one row per row of ``docs``.

    Two documents link when 100 |A∩B| >= percent |A∪B| over their distinct
    shingles of ``width`` words; component_id is the smallest key that links
    reach. Texts with fewer words are one shingle; empty, blank and null
    texts have none and are alone. Rows repeating a key or text are linked
    like any others; a null key ranks after all others. An empty table gives
    no rows. Equal 64-bit names of shingles and sets count as equal.
    """
    sets_all = materialize(shingle_sets(docs, key, text, percent, width), "jaccard-sets")
    ids = materialize(sets_all.select("id", "cls", "n"), "jaccard-ids")
    # one row per class
    sets = sets_all.filter("cls is not null")
    names = ids.filter("cls is not null").groupBy("cls").agg(F.min("id").alias("least"), F.count(F.lit(1)).alias("copies"))
    per_band = sets.select("cls", F.inline("blocks"))
    keys = per_band.select("cls", F.explode("keys").alias("block"))
    held = keys.groupBy("block").agg(F.min("cls").alias("lo"), F.max("cls").alias("hi"), F.count(F.lit(1)).alias("size")).filter("lo < hi")
    held = materialize(held.select("block", "size"), "jaccard-blocks")
    own = per_band.select("cls", "band", "need", F.explode("keys").alias("block"))
    members = among(own, "block", held).distinct().join(held, "block")
    members = materialize(rarest(members).select("block", "cls"), "jaccard-kept")
    held = members.groupBy("block").agg(F.min("cls").alias("lo"), F.max("cls").alias("hi")).filter("lo < hi")
    members = materialize(members.join(held, "block").select("block", "cls", "lo", "hi"), "jaccard-members")
    # every class of a block first meets one pivot
    star = members.groupBy("cls").agg(F.min("lo").alias("p")).filter("p <> cls").select(F.col("p").alias("a"), F.col("cls").alias("b"))
    star = materialize(star, "jaccard-stars")
    met = materialize(members.select("cls").distinct(), "jaccard-met")
    used = among(sets.select("cls", "n", "point"), "cls", met).join(met, "cls", "left_semi").dropDuplicates(["cls"])
    used = materialize(used, "jaccard-used")
    release(sets_all)

    def whole(wanted: DataFrame) -> DataFrame:
        return whole_sets(docs, names.select("cls", F.col("least").alias("id")).join(wanted, "cls", "left_semi"), key, text, width)

    links, tried = verified(star, used, percent, whole), star
    for tree in (False, True):
        comp = components(links)
        # blocks whose members are still in several components
        lab = members.join(comp, members["cls"] == comp["v"], "left").select("block", "cls", "lo", "hi", F.coalesce("comp", "cls").alias("comp"))
        lab = materialize(lab, "jaccard-labels")
        mixed = lab.groupBy("block").agg(
            F.min("comp").alias("_lo"), F.max("comp").alias("_hi"), F.count(F.lit(1)).alias("_c"), F.sum(F.xxhash64("cls").cast("decimal(38,0)")).alias("_s")
        ).filter("_lo < _hi")
        # blocks of the same members need one search
        mixed = mixed.groupBy("_c", "_s").agg(F.min("block").alias("block"))
        if not tree:  # the block's two pivots meet all members of other components
            rest = lab.join(mixed.select("block"), "block", "left_semi")
            pivot = rest.filter("cls = lo or cls = hi").select("block", F.col("cls").alias("p"), F.col("comp").alias("p_comp"))
            more = rest.join(pivot, "block").filter("comp <> p_comp").select(F.least("p", "cls").alias("a"), F.greatest("p", "cls").alias("b")).distinct()
        else:  # blocks of up to three have met both pivots; the others are searched by trees
            rest = lab.join(mixed.filter("_c > 3").select("block"), "block", "left_semi").join(used.select("cls", "n", "point"), "cls")
            rest = materialize(rest.select("block", "cls", "comp", "n", "point"), "jaccard-open")
            if rest.isEmpty():
                break
            more = tree_pairs(rest, percent)
        more = materialize(more.join(tried, ["a", "b"], "left_anti"), "jaccard-more")
        links, tried = links.unionByName(verified(more, used, percent, whole)), tried.unionByName(more)
    comp = components(links)
    # smallest key of each component, through the classes
    named = names.join(comp, names["cls"] == comp["v"], "left").select("cls", "least", F.coalesce("comp", "cls").alias("comp"))
    least = named.groupBy("comp").agg(F.min("least").alias("component_id"))
    named = materialize(named.join(least, "comp").select(F.col("cls").alias("_c"), "component_id"), "jaccard-names")
    out = ids.join(named, ids["cls"] == named["_c"], "left")
    return out.select(F.col("id").alias(key), F.col("n").alias("n_shingles"), F.coalesce("component_id", "id").alias("component_id"))


def drop_near(docs: DataFrame, key: str = "doc_id", text: str = "text", percent: int = 90, width: int = 3) -> DataFrame:
    """``docs`` with one document of each component: that whose key is its component_id; all columns as they are.

    Of rows that repeat this key one stays. Documents without shingles stay,
    and so do rows with a null key whose component has no other.
    """
    c = materialize(jaccard_components(docs, key, text, percent, width), "jaccard-components")
    lost = c.filter(f"`{key}` <> component_id or (`{key}` is null and component_id is not null)")
    again = c.filter(f"`{key}` = component_id and n_shingles > 0").groupBy(key).agg(F.count(F.lit(1)).alias("rows")).filter("rows > 1")
    lost, again = (materialize(x.select(F.col(key).alias("_xn_k")).distinct(), "jaccard-lost") for x in (lost, again))
    same = F.col(key).eqNullSafe(F.col("_xn_k"))
    x = suspects(docs, key, lost.unionByName(again).select(F.col("_xn_k").alias("_w")))
    clear, x = (x.filter(c).select(*[F.col(f"`{n}`") for n in docs.columns]) for c in ("not _maybe", "_maybe"))
    out = x.join(lost, same, "left_anti")
    if not again.isEmpty():
        out = out.join(again, same, "left_anti").unionByName(out.join(again, same, "left_semi").dropDuplicates([key]))
    return clear.unionByName(out)
