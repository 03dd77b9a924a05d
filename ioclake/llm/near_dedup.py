"""Near-duplicate documents by SetSketch registers.

A document's set holds its distinct word n-grams.  Its sketch has ``m``
registers; register ``i`` is the minimum, over the set, of an exponential
variate drawn by hash, put on the scale ``floor(1 - log_b x)`` and truncated
to 16 bits.  Registers of a union are the element-wise maxima (``merge``), and
two sketches agree in a register with a probability close to the Jaccard
similarity, so bands of registers find candidates.  A candidate pair is first
estimated from the joint likelihood of larger, smaller and equal registers and
then confirmed on the full sets.

Candidates are resolved without listing all pairs of a bucket.  First one member
of each bucket is held against the others; confirmed links give components, links
that the estimate only leaves possible give wider families.  Inside a family,
sets of different components meet in blocks within a task, which emits one link
per pair of components.  Members of a bucket that are of different families meet
in blocks too, where sizes, register parities and joint estimates are held
against the threshold; only pairs that all three allow leave the task.  No join lists the pairs of a bucket.

What may be missed: with 48 bands of 7 registers, a pair at similarity exactly 0.8
shares no band with probability 1.2e-5, one at 0.85 with 5e-9.  Parities and joint
estimate each drop such a pair 5 standard deviations off, 3e-7 each at 0.8 and less
above; so 1.3e-5 in all at 0.8, for pairs that no third document ties together.

Defined results: null or blank text has an empty set and links with nothing; a
text with fewer words than ``ngram`` is one shingle; equal ids are one document
(linked if any of their texts is); rows with a null id take no part and come
back kept with a null component; extra columns are ignored; an empty table gives
an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ioclake.llm.bytewords import MIX1, Words, mix, words
from ioclake.llm.common import Bitmap, join_counted, written
from ioclake.llm.components import connected_components

BANDS, ROWS = 48, 7
BASE, RATE, TOP = 1.001, 20.0, 65535
#: registers whose lowest bit goes into the parity word that travels with bucket rows
PARITY = 256
#: sets in a block of a family; columns of one matrix product
BLOCK, SLAB = 128, 4096
#: bits of the id filter in front of joins that move texts, sets or registers
ID_BITS = 1 << 22
#: standard deviations below the threshold at which an estimate is dropped
MARGIN = 5.0
#: members of a bucket in a block; pairs enumerated at once, and estimated at once
BUCKET_BLOCK, PAIRS_AT_ONCE, ESTIMATED = 512, 1 << 20, 1 << 13


def _family(m: int) -> np.ndarray:
    rng = np.random.default_rng(20240229)
    return rng.integers(0, 2**31, m, dtype=np.uint32) * np.uint32(2) + np.uint32(1)


def shingle_sets(w: Words, ngram: int) -> tuple[np.ndarray, np.ndarray]:
    """Per text the sorted distinct 64-bit hashes of its word n-grams, as one
    flat array and the bounds of the texts in it."""
    count = np.diff(w.bound)
    n = len(w.hash)
    grams = mix(w.hash + np.uint64(1))
    padded = np.concatenate((w.hash, np.zeros(ngram, np.uint64)))
    left = np.repeat(w.bound[1:], count) - np.arange(n)  # words from here to the text's end
    for k in range(1, ngram):
        inside = left > k
        grams = np.where(inside, mix(grams * MIX1 + padded[k:k + n]), grams)
    # a text of fewer words keeps only its first entry, the whole sequence
    short = np.repeat(count, count) < ngram
    first = np.arange(n) == np.repeat(w.bound[:-1], count)
    use = np.where(short, first, left >= ngram)
    bound = np.concatenate(([0], np.cumsum(use)))[w.bound]
    flat = grams[use]
    for a, b in zip(bound[:-1], bound[1:], strict=True):
        flat[a:b].sort()
    new = np.ones(len(flat), bool)
    new[1:] = flat[1:] != flat[:-1]
    new[bound[:-1][bound[:-1] < len(flat)]] = True
    return flat[new], np.concatenate(([0], np.cumsum(new)))[bound]


def sketch_sets(flat: np.ndarray, bound: np.ndarray, m: int) -> np.ndarray:
    """uint16 registers, one row per set; an empty set has all zeros."""
    out = np.zeros((len(bound) - 1, m), np.uint16)
    full = np.flatnonzero(np.diff(bound))
    h = (flat >> np.uint64(32)).astype(np.uint32)
    at = 0
    while at < len(full):
        end = max(at + 1, int(np.searchsorted(bound[full + 1], bound[full[at]] + (1 << 15), "right")))
        part = h[bound[full[at]]:bound[full[end - 1] + 1]]
        starts = bound[full[at:end]] - bound[full[at]]
        low = np.empty((m, len(starts)), np.uint32)
        buf = np.empty_like(part)
        for i, a in enumerate(_family(m)):
            np.multiply(part, a, out=buf)
            low[i] = np.minimum.reduceat(buf, starts)
        x = -np.log1p(-(low + 0.5) / 2.0**32) / RATE
        k = np.floor(1 - np.log(x) / np.log(BASE))
        out[full[at:end]] = np.clip(k, 0, TOP).astype(np.uint16).T
        at = end
    return out


def parities(regs: np.ndarray) -> np.ndarray:
    """Lowest bits of the first PARITY registers as 64-bit words."""
    low = np.zeros((len(regs), PARITY), np.uint8)
    low[:, :regs.shape[1]] = regs[:, :PARITY] & 1
    return np.packbits(low, axis=1).view(np.int64)


def _apart(j: float) -> float:
    """The most parities in which sets of similarity ``j`` may differ:
    registers that differ have equal parity half of the time.  The bound is
    MARGIN deviations wide."""
    miss = (1 - j) / 2
    return PARITY * miss + MARGIN * (PARITY * miss * (1 - miss)) ** 0.5


def _least_estimate(j: float, m: int) -> float:
    """The estimate from ``m`` registers below which a pair is ruled out,
    MARGIN deviations below ``j``."""
    return j - MARGIN * (j * (1 - j) / m) ** 0.5


def _alike(j: float) -> Column:
    """Whether the parities of ``bits`` and ``other`` are as close as those of
    sets of similarity ``j``."""
    apart = sum((F.bit_count(F.col("bits")[k].bitwiseXOR(F.col("other")[k])) for k in range(PARITY // 64)), F.lit(0))
    return apart <= _apart(j)


def merge(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Registers of the union of two sets."""
    return np.maximum(a, b)


def joint_estimate(u: np.ndarray, v: np.ndarray, nu: np.ndarray, nv: np.ndarray) -> np.ndarray:
    """Maximum-likelihood Jaccard similarity per row from registers that are
    larger in u, larger in v, or equal, given both set sizes."""
    more = (u > v).sum(1).astype(float)
    less = (u < v).sum(1).astype(float)
    same = u.shape[1] - more - less
    p, q = nu / (nu + nv), nv / (nu + nv)
    scale = (BASE - 1) / BASE

    def loglik(j: np.ndarray) -> np.ndarray:
        def prob(x):
            return -np.log1p(-np.maximum(x, 0) * scale) / np.log(BASE)
        a, b = prob(p - q * j), prob(q - p * j)
        tiny = 1e-300
        return (more * np.log(np.maximum(a, tiny)) + less * np.log(np.maximum(b, tiny))
                + same * np.log(np.maximum(1 - a - b, tiny)))

    lo, hi = np.zeros(len(p)), np.minimum(p / q, q / p)
    g = (np.sqrt(5) - 1) / 2
    for _ in range(40):  # the likelihood has one peak in the similarity
        x, y = hi - g * (hi - lo), lo + g * (hi - lo)
        left = loglik(x) > loglik(y)
        hi, lo = np.where(left, y, hi), np.where(left, lo, x)
    return (lo + hi) / 2


def _sketcher(ngram: int, m: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for w in words(b.column(1)):
                flat, bound = shingle_sets(w, ngram)
                regs = sketch_sets(flat, bound, m)
                digests = [hashlib.blake2b(w.hash[x:y].tobytes(), digest_size=16).digest()
                           for x, y in zip(w.bound[:-1], w.bound[1:], strict=True)]
                words64 = parities(regs)
                offs = np.arange(w.rows + 1, dtype=np.int32) * words64.shape[1]
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).slice(w.first, w.rows), pa.array(digests, pa.binary()),
                     pa.array(np.diff(bound).astype(np.int64)),
                     pa.array([r.tobytes() for r in regs], pa.binary()),
                     pa.ListArray.from_arrays(pa.array(offs), pa.array(words64.ravel()))],
                    names=["id", "digest", "n", "regs", "bits"])
    return run


def _set_maker(ngram: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for w in words(b.column(1)):
                flat, bound = shingle_sets(w, ngram)
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).slice(w.first, w.rows),
                     pa.ListArray.from_arrays(pa.array(bound.astype(np.int32)), pa.array(flat.view(np.int64)))],
                    names=["id", "set"])
    return run


def _estimator(low: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            a, c, na, nc, ra, rc = b.columns
            u = np.stack([np.frombuffer(x.as_py(), np.uint16) for x in ra])
            v = np.stack([np.frombuffer(x.as_py(), np.uint16) for x in rc])
            keep = joint_estimate(u, v, na.to_numpy(zero_copy_only=False).astype(float),
                                  nc.to_numpy(zero_copy_only=False).astype(float)) >= low
            yield pa.RecordBatch.from_arrays([a, c], names=["a", "b"]).filter(pa.array(keep))
    return run


def sketches(docs: DataFrame, id_col: str, text_col: str, ngram: int,
             bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """(id, digest of the word sequence, n shingles, registers) per row."""
    src = docs.select(F.col(id_col).cast("long"), F.col(text_col).cast("binary"))
    return src.mapInArrow(_sketcher(ngram, bands * rows),
                          "id long, digest binary, n long, regs binary, bits array<long>")


def buckets(classes: DataFrame, bands: int, rows: int) -> DataFrame:
    """(key, id, hub, held) for each band whose registers another class
    shares: the bucket's member that stands for it, by hash, and its size."""
    width = 2 * rows
    keys = F.array(*[F.xxhash64(F.lit(i), F.substring("regs", i * width + 1, width))
                     for i in range(bands)])
    flat = classes.select("id", F.explode(keys).alias("key"))
    shared = flat.groupBy("key").agg(F.min(F.struct(F.xxhash64("id"), F.col("id"))).getField("id").alias("hub"),
                                     F.count(F.lit(1)).alias("held")).filter("held > 1")
    return flat.join(shared, "key")


def _ends(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.col("a").alias("id")).union(pairs.select("b")).distinct()


def _among(df: DataFrame, pairs: DataFrame) -> DataFrame:
    """The rows of ``df`` whose id may be an end of ``pairs``."""
    return df.filter(Bitmap(_ends(pairs), "id", ID_BITS).may_hold("id"))


def _near(pairs: DataFrame, classes: DataFrame, low: float) -> DataFrame:
    """The pairs (a, b) that the joint estimate does not rule out."""
    sk = _among(classes.select("id", "n", "regs"), pairs)
    return pairs.join(sk.toDF("a", "na", "ra"), "a").join(sk.toDF("b", "nb", "rb"), "b") \
        .select("a", "b", "na", "nb", "ra", "rb").mapInArrow(_estimator(low), "a long, b long")


def _confirm(near: DataFrame, sets: DataFrame, num: int, den: int) -> DataFrame:
    """The pairs (a, b) whose sets have similarity >= num / den."""
    both = F.size(F.array_intersect("sa", "sb"))
    sets = _among(sets, near)
    return near.join(sets.toDF("a", "sa"), "a").join(sets.toDF("b", "sb"), "b") \
        .select("a", "b", (F.size("sa") + F.size("sb")).alias("total"), both.alias("both")) \
        .filter(F.lit(den) * F.col("both") >= F.lit(num) * (F.col("total") - F.col("both"))) \
        .select("a", "b").distinct()


def block_links(sets: list[np.ndarray], comps: np.ndarray, other: int, num: int, den: int) -> list[tuple[int, int]]:
    """Places (i, j) of one link per pair of components between the first
    ``other`` sets and the rest, or among all sets if ``other`` is 0.

    Intersections of all pairs are one matrix product over the elements that
    two sets at least hold, taken in slabs of bounded width."""
    sizes = np.array([len(s) for s in sets])
    owner = np.repeat(np.arange(len(sets)), sizes)
    _, place, count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    keep = count[place] > 1
    owner, column = owner[keep], (np.cumsum(count > 1) - 1)[place[keep]]
    left, right = (slice(0, other), slice(other, None)) if other else (slice(None), slice(None))
    both = np.zeros((len(sizes[left]), len(sizes[right])), np.float32)
    order = np.argsort(column, kind="stable")
    owner, column = owner[order], column[order]
    for low in range(0, int(column[-1]) + 1 if len(column) else 0, SLAB):
        x, y = np.searchsorted(column, [low, low + SLAB])
        m = np.zeros((len(sets), SLAB), np.float32)
        m[owner[x:y], column[x:y] - low] = 1
        both += m[left] @ m[right].T
    total = sizes[left][:, None] + sizes[right][None, :] - both
    found = (den * both >= num * total) & (comps[left][:, None] != comps[right][None, :])
    one = {}
    for i, j in zip(*np.nonzero(found), strict=True):
        j += other
        one.setdefault((min(comps[i], comps[j]), max(comps[i], comps[j])), (i, j))
    return list(one.values())


def _block_linker(num: int, den: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for same, x, y in zip(*batch.columns, strict=True):
                same = same.as_py()
                parts = [x.values] if same else [x.values, y.values]
                ids, comps = (np.concatenate([p.field(f).to_numpy() for p in parts]) for f in ("id", "comp"))
                sets = [v.values.to_numpy() for p in parts for v in p.field("set")]
                for i, j in block_links(sets, comps, 0 if same else len(x.values), num, den):
                    out.append((min(ids[i], ids[j]), max(ids[i], ids[j])))
            yield pa.RecordBatch.from_arrays([pa.array([o[k] for o in out], pa.int64()) for k in (0, 1)],
                                             names=["a", "b"])
    return run


def _fetched(meet: DataFrame, blocks: DataFrame, key: str) -> DataFrame:
    """(same, x, y): the blocks ``held`` of each pair (key, i, j) of numbers;
    y is null where a block meets itself."""
    x = blocks.select(key, F.col("no").alias("i"), F.col("held").alias("x"))
    y = blocks.select(key, F.col("no").alias("j"), F.col("held").alias("y"))
    same = meet.filter("i = j").join(x, [key, "i"]).select(F.lit(True).alias("same"), "x", F.lit(None).cast(
        y.schema["y"].dataType).alias("y"))
    return same.unionByName(meet.filter("i < j").join(x, [key, "i"]).join(y, [key, "j"]).select(
        F.lit(False).alias("same"), "x", "y"))


def _family_links(families: DataFrame, comps: DataFrame, sets: DataFrame, num: int, den: int) -> DataFrame:
    """Links between different components of a family, from blocks of about
    BLOCK sets that meet block by block; a large component has blocks of its
    own, which never meet each other."""
    m = families.toDF("id", "family").join(comps.toDF("id", "comp"), "id", "left") \
        .select("id", "family", F.coalesce("comp", "id").alias("comp"))
    size = m.groupBy("family", "comp").agg(F.count(F.lit(1)).alias("n"))
    several = size.groupBy("family").agg(F.count(F.lit(1)).alias("comps"), F.sum(
        F.when(F.col("n") < BLOCK, F.col("n")).otherwise(0)).alias("small")).filter("comps > 1")
    own = F.col("n") >= BLOCK
    sized = join_counted(m, size.withColumn("held", F.col("n")), ["family", "comp"], "held", m.count())
    placed = written(sized.join(several, "family").select(
        "id", "family", "comp", F.when(own, F.col("comp")).alias("alone"),
        F.when(own, F.pmod(F.xxhash64("id"), F.ceil(F.col("n") / BLOCK)))
        .otherwise(F.pmod(F.xxhash64("comp"), F.ceil(F.col("small") / BLOCK))).alias("block")), "members")
    some = _among(sets, placed.select(F.col("id").alias("a"), F.col("id").alias("b")))
    blocks = written(placed.join(some, "id").groupBy("family", "alone", "block")
                     .agg(F.collect_list(F.struct("id", "comp", "set")).alias("held"))
                     .withColumn("no", F.struct(F.coalesce("alone", F.lit(-1)).alias("alone"), "block")), "blocks")
    # block numbers meet first, then each pair of numbers fetches its sets
    left = blocks.select("family", F.col("no").alias("i"), F.col("alone").alias("p"))
    right = blocks.select("family", F.col("no").alias("j"), F.col("alone").alias("q"))
    meet = left.join(right, "family").filter("i <= j AND (p IS NULL OR q IS NULL OR p <> q)").select("family", "i", "j")
    return _fetched(meet, blocks, "family").mapInArrow(_block_linker(num, den), "a long, b long")


def possible_pairs(members: tuple, lefts: np.ndarray, rights: np.ndarray, ordered: bool, num: int, den: int) -> np.ndarray:
    """Distinct id pairs, smaller first, of members of different families
    whose sizes, parities and joint estimate allow the similarity num / den.
    Row k of ``lefts`` and ``rights`` are two ranges of members that meet;
    ``ordered`` takes each pair of a range that meets itself once."""
    (ids, family, n, bits, regs), out, apart = members, [], _apart(num / den)
    low = _least_estimate(num / den, regs.shape[1])
    sizes = (lefts[:, 1] - lefts[:, 0]) * (rights[:, 1] - rights[:, 0])
    at = 0
    while at < len(sizes):
        end = max(at + 1, int(np.searchsorted(np.cumsum(sizes[at:]), PAIRS_AT_ONCE, "right")) + at)
        count = sizes[at:end]
        within = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
        wide = np.repeat(rights[at:end, 1] - rights[at:end, 0], count)
        i = np.repeat(lefts[at:end, 0], count) + within // np.maximum(wide, 1)
        j = np.repeat(rights[at:end, 0], count) + within % np.maximum(wide, 1)
        use = family[i] != family[j]
        if ordered:
            use &= i < j
        use &= den * np.minimum(n[i], n[j]) >= num * np.maximum(n[i], n[j])
        i, j = i[use], j[use]
        close = np.bitwise_count(bits[i] ^ bits[j]).sum(1) <= apart
        i, j = i[close], j[close]
        for k in range(0, len(i), ESTIMATED):
            a, b = i[k:k + ESTIMATED], j[k:k + ESTIMATED]
            likely = joint_estimate(regs[a], regs[b], n[a].astype(float), n[b].astype(float)) >= low
            out.append(np.stack((ids[a[likely]], ids[b[likely]])))
        at = end
    both = np.concatenate(out, 1) if out else np.empty((2, 0), np.int64)
    return np.unique(np.sort(both, 0), axis=1)


def _members(held: pa.ListArray) -> tuple[tuple, np.ndarray]:
    """Columns of all members of the blocks, and the range of each block."""
    flat = held.flatten()
    bits = flat.field("bits").flatten().to_numpy().view(np.uint64).reshape(len(flat), -1)
    size = held.value_lengths().to_numpy()
    end = np.cumsum(size)
    regs = np.stack([np.frombuffer(x.as_buffer(), np.uint16) for x in flat.field("regs")])
    return tuple(flat.field(f).to_numpy() for f in ("id", "family", "n")) + (bits, regs), np.stack((end - size, end), 1)


def _bucket_tester(num: int, den: int):
    """Pairs that may be similar among blocks of buckets that meet."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            same = b.column(0).to_numpy(zero_copy_only=False).astype(bool)
            for alone in (True, False):
                part = b.filter(pa.array(same == alone))
                if not part.num_rows:
                    continue
                x, left = _members(part.column(1))
                right = left
                if not alone:
                    y, right = _members(part.column(2))
                    right = right + len(x[0])
                    x = tuple(np.concatenate(p) for p in zip(x, y, strict=True))
                a, c = possible_pairs(x, left, right, alone, num, den)
                yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(c)], names=["a", "b"])
    return run


def _bucket_pairs(rest: DataFrame, num: int, den: int) -> DataFrame:
    """Pairs (a, b) of members (key, id, family, n, bits, regs, held) of a
    bucket that are of different families and that sizes, parities and joint
    estimate allow, each listed once a bucket at most.  ``held``: members of the
    bucket at most."""
    blocks = written(rest.withColumn("no", F.pmod(F.xxhash64("id"), F.ceil(F.col("held") / BUCKET_BLOCK)))
                     .groupBy("key", "no").agg(F.collect_list(F.struct("id", "family", "n", "bits", "regs")).alias("held")), "bins")
    keys = blocks.select("key", "no")
    meet = keys.withColumnRenamed("no", "i").join(keys.withColumnRenamed("no", "j"), "key").filter("i <= j")
    return _fetched(meet, blocks, "key").mapInArrow(_bucket_tester(num, den), "a long, b long")


def near_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
               ngram: int = 5, num: int = 80, den: int = 100,
               bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """One row per input row: the id, n_shingles, component_id (smallest id
    reachable over links) and kept (id = component_id).  Links join documents
    with ``den * |intersection| >= num * |union|``."""
    src = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("binary"))
    sig = written(sketches(docs, id_col, text_col, ngram, bands, rows), "sketch")
    full = sig.filter("n > 0 and id is not null")
    classes = written(full.groupBy("digest").agg(
        F.min("id").alias("id"), F.first("n").alias("n"), F.first("regs").alias("regs"),
        F.first("bits").alias("bits")), "classes")
    bins = written(buckets(classes, bands, rows), "buckets")
    j = num / den
    low = _least_estimate(j, bands * rows)
    # what sizes and parities allow
    fits = (F.lit(den) * F.least("n", "m") >= F.lit(num) * F.greatest("n", "m")) & _alike(j)

    def with_sets(near: DataFrame, known: DataFrame | None) -> DataFrame:
        ids = _ends(near)
        if known is not None:
            ids = ids.join(known.select("id"), "id", "left_anti")
        ids = written(ids, "ids")
        some = src.filter(Bitmap(ids, "id", ID_BITS).may_hold("id"))
        new = written(some.join(ids, "id", "left_semi").mapInArrow(
            _set_maker(ngram), "id long, set array<long>"), "sets")
        return new if known is None else known.union(new)

    # an id that has several texts ties their classes to the smallest one
    owner = written(full.select("id", "digest").join(classes.select("digest", F.col("id").alias("cls")), "digest")
                    .select("id", "cls"), "owner")
    home = written(owner.groupBy("id").agg(F.min("cls").alias("cls"), F.max("cls").alias("far")), "home")
    tied = written(owner.join(home.filter("cls < far").select("id", F.col("cls").alias("low")), "id")
                   .filter("low < cls").select(F.col("low").alias("a"), F.col("cls").alias("b")).distinct(), "tied")

    # one member of each bucket against the others
    narrow = classes.select("id", "n", "bits")
    star = bins.filter("id <> hub").select("id", "hub").distinct().join(narrow, "id") \
        .join(narrow.toDF("hub", "m", "other"), "hub").filter(fits).select(
            F.least("id", "hub").alias("a"), F.greatest("id", "hub").alias("b"))
    near = written(_near(written(star.distinct(), "candidates"), classes, low), "pairs")
    sets = with_sets(near.union(tied), None)  # of all that a family may hold
    edges = written(tied.union(_confirm(near, sets, num, den)), "edges")
    comps = written(connected_components(edges), "components")
    families = written(connected_components(edges.union(near)), "families")

    # inside a family all components meet; beyond it, pairs that share a bucket
    inner = written(_family_links(families, comps, sets, num, den), "inner")
    lab = written(bins.join(families.toDF("id", "family"), "id", "left")
                  .join(families.toDF("hub", "hubs"), "hub", "left").select(
                      "key", "id", "held", F.coalesce("family", "id").alias("family"), F.coalesce("hubs", "hub").alias("hubs")), "lab")
    # a bucket whose members are all of its hub's family has nothing left to test
    mixed = lab.filter("family <> hubs").select("key").distinct()
    rest = lab.join(mixed, "key", "left_semi").join(classes.select("id", "n", "bits", "regs"), "id") \
        .select("key", "id", "family", "n", "bits", "regs", "held")
    near = written(_bucket_pairs(rest, num, den).distinct(), "pairs")
    outer = _confirm(near, with_sets(near, sets), num, den)
    comps = connected_components(edges.union(inner).union(outer)).toDF("cls", "comp")
    label = home.join(comps, "cls", "left").select(F.col("id").alias("doc"), F.coalesce("comp", "cls").alias("comp"))
    return sig.select(F.col("id").alias("doc"), "n").join(label, "doc", "left").select(
        F.col("doc").alias(id_col), F.col("n").alias("n_shingles"),
        F.coalesce("comp", "doc").alias("component_id"),
        F.col("doc").eqNullSafe(F.coalesce("comp", "doc")).alias("kept"))


def keep_one(docs: DataFrame, id_col: str = "doc_id", **options) -> DataFrame:
    """The documents without all but one of each group; rows that repeat a
    kept id go too, null ids stay."""
    keep = near_dedup(docs, id_col, **options).filter(f"kept and {id_col} is not null") \
        .select(id_col).distinct()
    w = Window.partitionBy(id_col).orderBy(*[c for c in docs.columns if c != id_col])
    once = docs.join(keep, id_col, "left_semi").withColumn("__nth", F.row_number().over(w)) \
        .filter("__nth = 1").select(*docs.columns)
    return once.unionByName(docs.filter(F.col(id_col).isNull()))
