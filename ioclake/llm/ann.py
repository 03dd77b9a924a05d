"""Nearest vectors by inner product over a hierarchical k-means tree.

Largest inner product becomes smallest distance by one more coordinate,
``sqrt(M - |x|^2)`` for stored vectors (M: the largest squared norm) and 0 for
queries.  A tree is fitted in one task to at most ``SAMPLE`` vectors chosen by
hash; every vector is filed under one leaf.  A query walks the tree best bin
first: a priority queue holds open branches by the distance to their centre, and
leaves come out in that order.  How many leaves to visit is calibrated: for
``CALIBRATE`` queries the true neighbours are found by brute force, and visits
widen until ``TARGET`` of those lie in visited leaves.  Scores are exact inner
products of the original vectors.

Equal vectors are searched once: a class of equal vectors carries its ``top + 1``
smallest ids, which is all that any answer can hold, so a vector that a third of
the rows share is one entry.

Leaves are numbered in tree order and laid into blocks of about ``STORED_BLOCK``
vectors, queries by their first leaf into blocks of about ``QUERY_BLOCK``; a larger
leaf fills several.  A walk gives out block numbers only.  Query blocks and stored
blocks that meet do so in a task of their own, which gives out the best few of
each query; so memory is bounded by two blocks, and where the tree prunes, blocks
that no query of a block visits are never sent.

Defined results: vectors that are null, empty, zero, of another length than most,
or hold null or non-finite components take no part, nor do null ids; rows that
repeat an id and vector count once, and a row never answers a query of its own
id; ties go to the smaller id; fewer candidates than ``top`` give fewer rows;
extra columns are ignored.
"""

from __future__ import annotations

import heapq
import pickle
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ioclake.llm.common import written

#: vectors the tree is fitted to; children a node; sample vectors a leaf
SAMPLE, BRANCH, LEAF = 32_768, 8, 32
CALIBRATE, TARGET = 256, 0.94
STORED_BLOCK, QUERY_BLOCK = 4096, 1024
#: queries scored at once; queries a task walks
SCORED, WALKED = 128, 256
ROUNDS, SEED = 8, 5


# --------------------------------------------------------------------- tree

def _split(x: np.ndarray, rng) -> np.ndarray | None:
    """Centres of a k-means over ``x``, or None where it does not divide."""
    centres = x[rng.choice(len(x), min(BRANCH, len(x)), replace=False)]
    for _ in range(ROUNDS):
        side = nearest(x, centres)
        centres = np.stack([x[side == k].mean(0) for k in np.unique(side)])
    return centres if len(centres) > 1 else None


def nearest(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return ((centres**2).sum(1) - 2 * x @ centres.T).argmin(1)


def build_tree(x: np.ndarray) -> dict:
    """children[i]: (node ids, centres) or None for a leaf; leaf[i]: its number."""
    rng, children, leaf, leaves = np.random.default_rng(SEED), [None], {}, 0
    todo = [(0, x)]
    while todo:
        node, part = todo.pop()
        centres = _split(part, rng) if len(part) > LEAF else None
        if centres is None:
            leaf[node], leaves = leaves, leaves + 1
            continue
        side = nearest(part, centres)
        ids = list(range(len(children), len(children) + len(centres)))
        children += [None] * len(centres)
        children[node] = (ids, centres)
        todo += [(i, part[side == k]) for k, i in enumerate(ids)]
    return {"children": children, "leaf": leaf, "leaves": leaves}


def leaf_of(tree: dict, x: np.ndarray) -> np.ndarray:
    """The leaf each row of ``x`` is filed under, level by level."""
    out = np.zeros(len(x), np.int64)
    todo = [(0, np.arange(len(x)))]
    while todo:
        node, rows = todo.pop()
        if not len(rows):
            continue
        if tree["children"][node] is None:
            out[rows] = tree["leaf"][node]
            continue
        ids, centres = tree["children"][node]
        side = nearest(x[rows], centres)
        todo += [(i, rows[side == k]) for k, i in enumerate(ids)]
    return out


def best_bins(tree: dict, q: np.ndarray) -> Iterator[int]:
    """Leaves in the order in which a best-bin-first walk reaches them."""
    heap = [(0.0, 0)]
    while heap:
        _, node = heapq.heappop(heap)
        if tree["children"][node] is None:
            yield tree["leaf"][node]
            continue
        ids, centres = tree["children"][node]
        for far, i in zip(((centres - q) ** 2).sum(1).tolist(), ids, strict=True):
            heapq.heappush(heap, (far, i))


def _stored(v: np.ndarray, most: float) -> np.ndarray:
    return np.concatenate([v, np.sqrt(np.maximum(0, most - (v**2).sum(1)))[:, None]], 1)


def _asked(v: np.ndarray) -> np.ndarray:
    return np.concatenate([v, np.zeros((len(v), 1))], 1)


def _matrix(lists: pa.Array) -> np.ndarray:
    flat = lists.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(lists), -1) if len(lists) else np.empty((0, 1))


# --------------------------------------------------------------- task bodies

def _fitting(most: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = [_matrix(b.column(0)) for b in batches if b.num_rows]
        if parts:
            x = np.concatenate(parts)
            x = x[np.lexsort(x.T)]  # the same tree for any order of rows
            yield pa.RecordBatch.from_pydict({"tree": [pickle.dumps(build_tree(_stored(x, most)))]})
    return run


def _filing(shared, most: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                leaf = leaf_of(shared.value, _stored(_matrix(b.column(1)), most))
                yield pa.RecordBatch.from_arrays([*b.columns, pa.array(leaf)], names=[*b.schema.names, "leaf"])
    return run


def lay_out(sizes: dict[int, int], per: int) -> dict[int, tuple[int, int]]:
    """leaf -> (first block, blocks): leaves in order share blocks of about
    ``per`` rows, a leaf of more rows has blocks of its own."""
    out, block, held = {}, 0, 0
    for leaf in sorted(sizes):
        n = sizes[leaf]
        if held and held + n > per:
            block, held = block + 1, 0
        blocks = max(1, -(-n // per))
        out[leaf] = (block, blocks)
        held += n
        if blocks > 1:
            block, held = block + blocks, 0
    return out


def _walking(shared, visits: int):
    """Per query its first leaf and the blocks of the leaves it visits."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tree, places = shared.value
        for b in batches:
            home, blocks = [], []
            for q in _asked(_matrix(b.column(1))):
                order = [leaf for _, leaf in zip(range(visits), best_bins(tree, q), strict=False)]
                home.append(order[0])
                blocks.append(sorted({p + k for x in order if x in places for p, n in (places[x],) for k in range(n)}))
            yield pa.RecordBatch.from_arrays(
                [*b.columns, pa.array(home, pa.int64()), pa.array(blocks, pa.list_(pa.int32()))],
                names=[*b.schema.names, "leaf", "blocks"])
    return run


def _best(q: np.ndarray, v: np.ndarray, ids: np.ndarray, top: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, id, score) of the ``top`` largest inner products per row of
    ``q``, ties to smaller ids."""
    by_id = np.argsort(ids, kind="stable")
    v, ids, parts = v[by_id], ids[by_id], []
    for at in range(0, len(q), SCORED):
        score = q[at:at + SCORED] @ v.T
        n = score.shape[1]
        least = np.partition(score, n - top, 1)[:, n - top] if n > top else np.full(len(score), -np.inf)
        row, col = np.nonzero(score >= least[:, None])  # a few more than top where scores are equal
        order = np.lexsort((col, -score[row, col], row))
        row, col = row[order], col[order]
        nth = np.arange(len(row)) - np.searchsorted(row, row)
        row, col = row[nth < top], col[nth < top]
        parts.append((row + at, ids[col], score[row, col]))
    return tuple(np.concatenate(x) for x in zip(*parts, strict=True))


def _meeting(top: int):
    def run(asked: pa.Table, stored: pa.Table) -> pa.Table:
        if not asked.num_rows or not stored.num_rows:
            return FOUND.empty_table()
        rows, found, score = _best(_table(asked["v"]), _table(stored["v"]), stored["cid"].to_numpy(), top)
        return pa.Table.from_arrays([pa.array(asked["id"].to_numpy()[rows]), pa.array(found), pa.array(score)], schema=FOUND)
    return run


FOUND = pa.schema([("asked", pa.int64()), ("cid", pa.int64()), ("score", pa.float64())])


def _table(lists: pa.ChunkedArray) -> np.ndarray:
    return np.concatenate([_matrix(c) for c in lists.chunks])


def _brute(shared, top: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        asked, q = shared.value
        for b in batches:
            if not b.num_rows:
                continue
            ids, leaf = b.column(0).to_numpy(), b.column(2).to_numpy()
            rows, found, score = _best(q, _matrix(b.column(1)), np.arange(len(ids)), top + 1)
            yield pa.RecordBatch.from_arrays(
                [pa.array(asked[rows]), pa.array(ids[found]), pa.array(score), pa.array(leaf[found])],
                names=["asked", "cid", "score", "leaf"])
    return run


# -------------------------------------------------------------------- search

def usable(vectors: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """(id, v array<double>) of the rows that take part."""
    v = F.col("v")
    d = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vec_col).cast("array<double>").alias("v")) \
        .filter(F.col("id").isNotNull() & F.col("v").isNotNull()
                & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
                & F.exists(v, lambda x: x != 0))
    size = d.groupBy(F.size("v").alias("d")).count().orderBy(F.desc("count"), "d").first()
    return d.filter(F.size("v") == (size.d if size else 0))


def _placed(df: DataFrame, key: str, per: int) -> tuple[DataFrame, dict[int, tuple[int, int]]]:
    """``df`` with a block per row, by its leaf, and the layout.  There are at
    most as many leaves as the tree has, so both are small."""
    sizes = {r.leaf: r.n for r in df.groupBy("leaf").agg(F.count(F.lit(1)).alias("n")).collect()}
    layout = lay_out(sizes, per)
    table = df.sparkSession.createDataFrame([(x, *p) for x, p in layout.items()], "leaf long, first int, several int")
    return df.join(F.broadcast(table), "leaf").withColumn("block", (
        F.col("first") + F.pmod(F.xxhash64(key), F.col("several"))).cast("int")).drop("leaf", "first", "several"), layout


def search(vectors: DataFrame, queries: Column, top: int = 20, id_col: str = "vec_id",
           vec_col: str = "embedding", target: float = TARGET) -> DataFrame:
    """The ``top`` nearest rows to each row where ``queries`` (on ``id``)
    holds: query_id, rank, the id, score, and the leaves visited per query."""
    out = f"query_id long, rank int, {id_col} long, score double, visits long"
    spark = vectors.sparkSession
    rows = usable(vectors, id_col, vec_col)
    nth = F.row_number().over(Window.partitionBy("v").orderBy("id"))
    first = rows.distinct().withColumn("nth", nth).filter(F.col("nth") <= top + 1)
    classes = written(first.groupBy("v").agg(F.min("id").alias("cid"), F.sort_array(F.collect_list("id")).alias("ids"))
                      .select("cid", "v", "ids"), "vectors")
    norm = F.aggregate("v", F.lit(0.0), lambda a, x: a + x * x)
    most = classes.agg(F.max(norm)).first()[0]
    asked = written(rows.filter(queries).distinct().join(classes.select("v", "cid"), "v").select("id", "cid", "v"),
                    "queries")
    if most is None or asked.isEmpty():
        return spark.createDataFrame([], out)
    sample = classes.orderBy(F.xxhash64("v"), "cid").limit(SAMPLE).select("v")
    tree = pickle.loads(sample.coalesce(1).mapInArrow(_fitting(most), "tree binary").first().tree)
    shared = spark.sparkContext.broadcast(tree)  # at most SAMPLE / LEAF leaves and their centres
    index = written(classes.select("cid", "v").mapInArrow(
        _filing(shared, most), "cid long, v array<double>, leaf long"), "index")

    trial = asked.select(F.col("cid").alias("id"), "v").distinct().orderBy(F.xxhash64("v", F.lit(1)), "id") \
        .limit(CALIBRATE).toPandas()
    exact = spark.sparkContext.broadcast((trial["id"].to_numpy(), np.stack(trial["v"].to_list())))
    w = Window.partitionBy("asked").orderBy(F.desc("score"), "cid")
    truth = index.mapInArrow(_brute(exact, top), "asked long, cid long, score double, leaf long") \
        .filter("asked <> cid").withColumn("nth", F.row_number().over(w)).filter(F.col("nth") <= top) \
        .select("asked", "leaf").toPandas()
    ranks = []
    for one, q in zip(trial["id"], _asked(np.stack(trial["v"].to_list())), strict=True):
        place = {leaf: n for n, leaf in enumerate(best_bins(tree, q), 1)}
        ranks += [place[x] for x in truth.loc[truth["asked"] == one, "leaf"]]
    visits = int(np.sort(ranks)[int(np.ceil(target * len(ranks))) - 1]) if ranks else 1

    stored, places = _placed(index, "cid", STORED_BLOCK)
    shared = spark.sparkContext.broadcast((tree, places))
    distinct = asked.select(F.col("cid").alias("id"), "v").distinct()
    walked = written(distinct.repartition(max(1, -(-distinct.count() // WALKED)), "id").mapInArrow(
        _walking(shared, visits), "id long, v array<double>, leaf long, blocks array<int>"), "walked")
    queries_in, _ = _placed(walked, "id", QUERY_BLOCK)
    sent = queries_in.select("id", "v", F.col("block").alias("asking"), F.explode("blocks").alias("block"))
    pairs = queries_in.select(F.col("block").alias("asking"), F.explode("blocks").alias("block")).distinct()
    met = sent.groupBy("asking", "block").cogroup(stored.join(pairs, "block").groupBy("asking", "block")).applyInArrow(
        _meeting(top + 1), "asked long, cid long, score double")
    found = met.withColumn("nth", F.row_number().over(w)).filter(F.col("nth") <= top + 1).drop("nth")
    by_score = Window.partitionBy("asked").orderBy(F.desc("score"), "near")
    near = found.join(classes.select("cid", "ids"), "cid").select("asked", F.explode("ids").alias("near"), "score") \
        .withColumn("nth", F.row_number().over(by_score)).filter(F.col("nth") <= top + 1) \
        .groupBy("asked").agg(F.collect_list(F.struct(F.negative("score").alias("down"), F.col("near"))).alias("near"))
    # the answer of a class of equal queries, without each query's own row
    own = asked.select(F.col("id").alias("query_id"), F.col("cid").alias("asked")).join(near, "asked")
    ranked = own.select("query_id", F.posexplode(F.slice(F.sort_array(
        F.filter("near", lambda x: x.near != F.col("query_id"))), 1, top)).alias("pos", "x"))
    return ranked.select("query_id", (F.col("pos") + 1).alias("rank"), F.col("x.near").alias(id_col),
                         F.negative("x.down").alias("score"), F.lit(visits).cast("long").alias("visits"))
