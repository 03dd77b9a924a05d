"""Centroid clustering against plain Lloyd rounds in Python integers."""

import hashlib
import math

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from ioclake.llm.centroids import cluster, inverse, levels, nearest, sequency, transform
from ioclake.llm.oracle import SQL
from ioclake.llm.queries import QUERIES

from .conftest import SF


def brute(rows, k, rounds, dims, scale):
    kept = [(i, [math.floor(float(x) * scale) for x in v]) for i, v in rows
            if v is not None and len(v) == dims and all(x is not None and math.isfinite(x) for x in v)]
    seeds = sorted((hashlib.sha256(f"1:{'' if i is None else i}".encode()).hexdigest(), v) for i, v in kept)[:k]
    cs = [list(v) for _, v in seeds]

    def place(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c)), n) for n, c in enumerate(cs))

    for _ in range(rounds):
        own = [place(v)[1] for _, v in kept]
        for n in range(len(cs)):
            mine = [v for (_, v), o in zip(kept, own) if o == n]
            if mine:
                cs[n] = [sum(col) // len(mine) for col in zip(*mine)]
    last = [(i, *place(v)) for i, v in kept]
    per = {}
    for _, d, n in last:
        per[n] = per.get(n, 0) + d
    return sorted(((i, n, d, per[n], sum(per.values()), hashlib.sha256(",".join(map(str, cs[n])).encode()).hexdigest())
                   for i, d, n in last), key=str)


def got(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


@given(st.lists(st.lists(st.integers(-2**20, 2**20), min_size=16, max_size=16), min_size=1, max_size=6))
def test_transform_is_exact_and_invertible(rows):
    x = np.array(rows, np.int64)
    y = transform(x)
    assert (inverse(y) == x).all()
    assert ((y**2).sum(1) == 16 * (x**2).sum(1)).all()
    assert (y[:, 0] == x.sum(1)).all()  # the coarsest coefficient


def test_order_by_sign_changes():
    h = transform(np.eye(8, dtype=np.int64)).T
    assert [int((a[1:] != a[:-1]).sum()) for a in h] == list(range(8))
    assert sorted(sequency(64)) == list(range(64))
    assert levels(64) == [(0, 1), (1, 2), (2, 4), (4, 8), (8, 16), (16, 32), (32, 64)]


@settings(max_examples=60)
@given(st.data())
def test_progressive_search_is_the_full_search(data):
    cell = st.integers(-3, 3)
    x = np.array(data.draw(st.lists(st.lists(cell, min_size=8, max_size=8), min_size=1, max_size=20)), np.int64)
    c = np.array(data.draw(st.lists(st.lists(cell, min_size=8, max_size=8), min_size=1, max_size=7)), np.int64)
    best, far = nearest(transform(x), transform(c))
    full = ((x[:, None] - c[None]) ** 2).sum(2)
    assert (best == full.argmin(1)).all() and (far == full.min(1)).all()


def test_whole_table_equals_brute_force(spark):
    src = spark.read.parquet(f"{SF}/embeddings.parquet")
    want = brute([(r.vec_id, r.embedding) for r in src.collect()], 16, 3, 64, 64)
    assert got(QUERIES["op13_centroids"](spark, SF)) == want


def test_sql_gives_the_same(spark):
    import duckdb
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM read_parquet('{SF}/embeddings.parquet')")
    rel = con.sql(SQL["op13_centroids"])
    df = QUERIES["op13_centroids"](spark, SF)
    assert rel.columns == df.columns
    assert sorted((tuple(r) for r in rel.fetchall()), key=str) == got(df)


ODD = [(1, [1.0, -0.6, 0.0, 0.3]), (1, [1.0, -0.6, 0.0, 0.3]), (None, [0.5, 0.5, -0.5, 2.0]), (2, None), (3, []),
       (4, [1.0, 2.0]), (5, [1.0, None, 0.0, 0.0]), (6, [1.0, float("nan"), 0.0, 0.0]), (7, [float("inf"), 0.0, 0.0, 0.0]),
       (8, [0.0, 0.0, 0.0, 0.0]), (9, [-7.0, 2.0, 0.1, 0.2]), (9, [3.0, 3.0, 3.0, -3.0])]


def test_odd_rows(spark):
    df = spark.createDataFrame([(i, v, "x") for i, v in ODD], "vec_id long, embedding array<double>, cluster string")
    for k in (1, 3, 50):
        assert got(cluster(df, k=k, rounds=2, dims=4, scale=10)) == brute(ODD, k, 2, 4, 10)


def test_empty_and_all_unusable(spark):
    schema = "vec_id long, embedding array<float>"
    for rows in ([], [(1, None), (2, [1.0])]):
        df = cluster(spark.createDataFrame(rows, schema))
        assert df.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]
        assert df.count() == 0


def test_components_beyond_exact_sums_are_told(spark):
    df = spark.createDataFrame([(1, [1e9, 0.0])], "vec_id long, embedding array<double>")
    with pytest.raises(Exception, match="would not fit 64 bits"):
        cluster(df, dims=2).collect()
