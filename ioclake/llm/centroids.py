"""Centroid clustering of integer vectors by Walsh-Hadamard progressive search.

Vectors become integers, ``floor(scale * x)``, and are turned once by the
Walsh-Hadamard transform, which is exact in integers and multiplies every
squared distance by the number of components.  Its coefficients, ordered by
sign changes, go from coarse to fine.  To find the nearest centroid of a vector,
squared coefficient differences are added level by level (1, 1, 2, 4, ...
coefficients); the centroid that leads after a level is finished first and gives
a bound, and a centroid whose partial sum is already larger is strictly worse
and leaves.  The rest finish all coefficients, so the answer and its distance
are exact; of equal distances the smaller number wins.

The transform is linear, so cluster sums are taken over coefficients and turned
back once per centroid.  Every task emits one row per cluster it has met; only
``k`` centroids reach the driver, as exact decimals.

Defined results: a vector takes part if it has exactly ``dims`` components, none
null or non-finite; others have no row.  Components must lie within 2**24 after
scaling, where all sums are exact in 64 bits; beyond that the job ends with an
error that says so.  Equal rows are separate vectors; a null id counts as the
empty text in the choice of first centroids, and ties there go to the smaller
vector; fewer vectors than ``k`` give fewer centroids; an empty table gives an
empty result; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ioclake.llm.common import written

DIMS, SCALE, K, ROUNDS = 64, 64, 16, 3
#: largest magnitude of a component: 64 squared differences of 64 coefficients fit a long
WIDEST = 1 << 24
#: vectors compared at once
AT_ONCE = 8192


def transform(x: np.ndarray) -> np.ndarray:
    """Walsh-Hadamard coefficients of the rows of ``x``, by butterflies, in
    order of sign changes.  Twice over gives ``x`` times its width."""
    n = x.shape[1]
    y = x.copy()
    half = 1
    while half < n:
        pairs = y.reshape(len(y), -1, 2, half)
        y = np.stack((pairs[:, :, 0] + pairs[:, :, 1], pairs[:, :, 0] - pairs[:, :, 1]), 2).reshape(len(y), n)
        half *= 2
    return y[:, sequency(n)]


def inverse(y: np.ndarray) -> np.ndarray:
    """The rows whose coefficients are ``y``: exact for coefficients of integers."""
    n = y.shape[1]
    natural = np.empty_like(y)
    natural[:, sequency(n)] = y
    back = transform(natural)
    out = np.empty_like(back)
    out[:, sequency(n)] = back
    return out // n


def sequency(n: int) -> np.ndarray:
    """Rows of the n x n Hadamard matrix by their number of sign changes."""
    i = np.arange(n)
    odd = np.bitwise_count(i[:, None] & i[None, :]) & 1
    return np.argsort((odd[:, 1:] != odd[:, :-1]).sum(1), kind="stable")


def levels(n: int) -> list[tuple[int, int]]:
    """Coefficient ranges from coarse to fine: 1, 1, 2, 4, ... wide."""
    edges = [0, *(1 << k for k in range(n.bit_length()))]
    return list(zip(edges[:-1], edges[1:], strict=True))


def nearest(coefs: np.ndarray, centres: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(number, squared distance) of the nearest centroid of every row, both
    sides given by their coefficients."""
    rows, n = coefs.shape
    partial = np.zeros((rows, len(centres)), np.int64)
    alive = np.ones(partial.shape, bool)
    bound = np.full(rows, np.iinfo(np.int64).max)
    never = np.iinfo(np.int64).max
    for low, high in levels(n):
        r, c = np.nonzero(alive)
        partial[r, c] += ((coefs[r, low:high] - centres[c, low:high]) ** 2).sum(1)
        if high < n:
            leader = np.where(alive, partial, never).argmin(1)
            rest = ((coefs[:, high:] - centres[leader, high:]) ** 2).sum(1)
            bound = np.minimum(bound, partial[np.arange(rows), leader] + rest)
            alive &= partial <= bound[:, None]
    whole = np.where(alive, partial, never)
    best = whole.argmin(1)  # the first of equal ones
    return best, whole[np.arange(rows), best] // n


def _rows(lists: pa.Array, dims: int) -> np.ndarray:
    return lists.flatten().to_numpy().astype(np.int64).reshape(-1, dims)


def _slices(b: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    for at in range(0, b.num_rows, AT_ONCE):
        yield b.slice(at, AT_ONCE)


def _transforming(dims: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for b in _slices(batch):
                coefs = transform(_rows(b.column(1), dims)).astype(np.int32)
                offs = pa.array(np.arange(b.num_rows + 1, dtype=np.int32) * dims)
                yield pa.RecordBatch.from_arrays(
                    [b.column(0), pa.ListArray.from_arrays(offs, pa.array(coefs.ravel()))], names=["id", "coefs"])
    return run


def _summing(shared, dims: int):
    """One row per cluster met by the task: number, vectors, coefficient sums."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        centres = shared.value
        count = np.zeros(len(centres), np.int64)
        total = np.zeros((len(centres), dims), np.int64)
        for batch in batches:
            for b in _slices(batch):
                coefs = _rows(b.column(0), dims)
                best, _ = nearest(coefs, centres)
                order = np.argsort(best, kind="stable")
                met, first = np.unique(best[order], return_index=True)
                total[met] += np.add.reduceat(coefs[order], first, 0)
                count += np.bincount(best, minlength=len(centres))
        met = np.flatnonzero(count)
        offs = pa.array(np.arange(len(met) + 1, dtype=np.int32) * dims)
        yield pa.RecordBatch.from_arrays(
            [pa.array(met.astype(np.int32)), pa.array(count[met]),
             pa.ListArray.from_arrays(offs, pa.array(total[met].ravel()))], names=["cluster", "n", "sums"])
    return run


def _assigning(shared, dims: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for b in _slices(batch):
                best, far = nearest(_rows(b.column(1), dims), shared.value)
                yield pa.RecordBatch.from_arrays(
                    [b.column(0), pa.array(best.astype(np.int32)), pa.array(far)], names=["id", "cluster", "distance"])
    return run


def integer_vectors(vectors: DataFrame, id_col: str, vec_col: str, dims: int, scale: int) -> DataFrame:
    """(id, v array<long>) of the vectors that take part."""
    wide = F.col(vec_col).cast("array<double>")
    finite = F.forall("x", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    kept = vectors.select(F.col(id_col).alias("id"), wide.alias("x")) \
        .filter((F.size("x") == dims) & finite)
    inside = F.when(F.forall("x", lambda c: F.abs(c) * scale < WIDEST), F.col("x")).otherwise(F.raise_error(F.lit(
        f"a component times {scale} reaches {WIDEST}: distances would not fit 64 bits")))
    return kept.select("id", F.transform(inside, lambda c: F.floor(c * scale).cast("long")).alias("v"))


def first_centroids(ints: DataFrame, k: int) -> np.ndarray:
    """The vectors of the ``k`` smallest hashes of their ids."""
    seed = F.sha2(F.concat(F.lit("1:"), F.coalesce(F.col("id").cast("string"), F.lit(""))), 256)
    got = ints.select(seed.alias("h"), "v").orderBy("h", "v").limit(k).collect()
    return np.array([r.v for r in got], np.int64)


def cluster(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", k: int = K,
            rounds: int = ROUNDS, dims: int = DIMS, scale: int = SCALE) -> DataFrame:
    """(id, cluster, distance, cluster_inertia, inertia, centroid_sha256) per
    vector that takes part: ``rounds`` of assignment and exact floor means,
    then a last assignment.  ``dims`` is a power of two."""
    if dims & (dims - 1) or not dims:
        raise ValueError("dims is a power of two")
    spark = vectors.sparkSession
    id_type = dict(vectors.dtypes)[id_col]
    ints = integer_vectors(vectors, id_col, vec_col, dims, scale)
    centres = first_centroids(ints, k)
    out = f"`{id_col}` {id_type}, cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string"
    if not len(centres):
        return spark.createDataFrame([], out)
    turned = written(ints.mapInArrow(_transforming(dims), f"id {id_type}, coefs array<int>"), "coefs")

    def sent(c: np.ndarray):
        return spark.sparkContext.broadcast(transform(c))  # k x dims longs

    for _ in range(rounds):
        parts = turned.select("coefs").mapInArrow(_summing(sent(centres), dims), "cluster int, n long, sums array<long>")
        got = parts.groupBy("cluster").agg(F.sum("n").alias("n"), F.array(
            *[F.sum(F.col("sums")[i].cast("decimal(38,0)")) for i in range(dims)]).alias("sums")).collect()
        for r in got:
            sums = inverse(np.array([[int(s) for s in r.sums]], object))[0]
            centres[r.cluster] = [int(s) // r.n for s in sums]
    placed = written(turned.mapInArrow(_assigning(sent(centres), dims), f"id {id_type}, cluster int, distance long"),
                     "assigned")
    per = {r.cluster: r.d for r in placed.groupBy("cluster").agg(F.sum("distance").alias("d")).collect()}
    digest = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centres.tolist()]
    inertia = F.create_map(*[F.lit(x) for c, d in per.items() for x in (c, d)])
    names = F.array(*[F.lit(d) for d in digest])
    return placed.select(F.col("id").alias(id_col), "cluster", "distance", inertia[F.col("cluster")].cast("long").alias(
        "cluster_inertia"), F.lit(sum(per.values())).cast("long").alias("inertia"),
        names[F.col("cluster")].alias("centroid_sha256"))
