import numpy as np
from pyspark.sql import functions as F

from ioclake.llm.ann import _best, best_bins, build_tree, lay_out, leaf_of, search

VECS = "vec_id long, embedding array<float>, rank int, score string"


def brute(rows, top):
    """{query: [(id, score)]} over the usable rows."""
    use = [(i, np.array(v, np.float32).astype(float)) for i, v in rows]
    out = {}
    for q, x in use:
        if q % 20 == 0:
            near = sorted(((-float(x @ y), i) for i, y in use if i != q))
            out[q] = [(i, -s) for s, i in near[:top]]
    return out


def found(df):
    got = {}
    for r in df.orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    return got


def frame(spark, rows):
    return spark.createDataFrame([(i, v, 1, "x") for i, v in rows], VECS)


def is_query():
    return F.pmod("id", F.lit(20)) == 0


def test_recall_and_exact_scores(spark):
    rng = np.random.default_rng(1)
    x = rng.normal(size=(3000, 16)) * rng.uniform(0.2, 3, size=(3000, 1))  # norms differ: inner product is not distance
    rows = [(i, [float(a) for a in v]) for i, v in enumerate(x)]
    want, got = brute(rows, 20), found(search(frame(spark, rows), is_query()))
    assert set(got) == set(want)
    exact = {i: np.array(v, np.float32).astype(float) for i, v in rows}
    hit = 0
    for q, near in got.items():
        assert [r for r, _, _ in near] == list(range(1, 21))
        assert all(abs(s - exact[q] @ exact[i]) < 1e-9 for _, i, s in near)
        assert near == sorted(near, key=lambda n: (-n[2], n[1]))
        hit += len({i for _, i, _ in near} & {i for i, _ in want[q]})
    assert hit / (20 * len(want)) >= 0.9


def test_small_table_is_exact_with_copies_and_ties(spark):
    rows = [(i, [1.0, 0.0]) for i in range(0, 50)] + [(i, [0.0, 1.0]) for i in range(50, 70)] + [(100, [-1.0, -2.0])]
    rows.append((3, [1.0, 0.0]))
    got = found(search(frame(spark, rows), is_query(), top=5))
    want = brute(rows[:-1], 5)
    assert {q: [(i, s) for _, i, s in near] for q, near in got.items()} == want


def test_rows_that_take_no_part(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 2.0]), (20, [2.0, 1.0]), (1, [3.0, 3.0]), (40, None), (60, []), (80, [0.0, 0.0]), (100, [1.0, nan]),
            (120, [inf, 1.0]), (140, [None, 1.0]), (160, [1.0, 2.0, 3.0]), (None, [9.0, 9.0])]
    got = found(search(frame(spark, rows), is_query()))
    assert {q: [i for _, i, _ in near] for q, near in got.items()} == {0: [1, 20], 20: [1, 0]}
    assert search(frame(spark, rows[3:5]), is_query()).count() == 0
    assert search(frame(spark, rows).limit(0), is_query()).count() == 0
    assert search(frame(spark, rows[:1]), is_query()).count() == 0


def test_walk_visits_every_leaf_once_and_starts_at_home():
    x = np.random.default_rng(2).normal(size=(2000, 8))
    tree = build_tree(x)
    home = leaf_of(tree, x[:50])
    first = 0
    for v, leaf in zip(x[:50], home, strict=True):
        order = list(best_bins(tree, v))
        assert sorted(order) == list(range(tree["leaves"]))
        first += order.index(leaf) < tree["leaves"] // 4
    assert first >= 45


def test_one_vector_for_a_third_of_the_rows(spark):
    rng = np.random.default_rng(3)
    rows = [(i, [1.0, 1.0, 1.0] if i % 3 == 0 else [float(a) for a in rng.normal(size=3)]) for i in range(3000)]
    got = found(search(frame(spark, rows), is_query(), top=4))
    hot = {q: [i for _, i, _ in near] for q, near in got.items() if q % 3 == 0}
    best = brute(rows, 4)
    assert len(hot) == 50 and all(len(n) == 4 for n in hot.values())
    assert sum(len(set(n) & {i for i, _ in best[q]}) for q, n in hot.items()) >= 0.9 * 200


def test_best_takes_ties_by_id():
    rng = np.random.default_rng(4)
    v, ids = rng.integers(-2, 3, (60, 3)).astype(float), rng.permutation(60)
    q = rng.integers(-2, 3, (300, 3)).astype(float)
    for top in (1, 7, 60, 100):
        row, got, score = _best(q, v, ids, top)
        want = [(r, i, s) for r in range(len(q)) for s, i in sorted(((-float(q[r] @ v[k]), int(ids[k])) for k in range(60)))[:top]]
        assert list(zip(row.tolist(), got.tolist(), (-score).tolist())) == [(r, i, s) for r, i, s in want]


def test_layout_fills_blocks_in_order():
    assert lay_out({0: 3, 1: 3, 2: 5, 5: 21, 7: 1, 8: 10}, 10) == {0: (0, 1), 1: (0, 1), 2: (1, 1), 5: (2, 3), 7: (5, 1), 8: (6, 1)}
    assert lay_out({}, 10) == {}


def test_blocks_that_no_query_visits_are_not_sent(spark, monkeypatch):
    """Well separated groups: a query meets the blocks around it alone."""
    from ioclake.llm import ann
    monkeypatch.setattr(ann, "STORED_BLOCK", 64)
    monkeypatch.setattr(ann, "QUERY_BLOCK", 8)
    rng = np.random.default_rng(5)
    centres = rng.normal(size=(40, 12)) * 30
    centres /= np.linalg.norm(centres, axis=1)[:, None] / 30
    rows = [(i, [float(a) for a in centres[i % 40] + rng.normal(size=12) * 0.1]) for i in range(4000)]
    met = []
    whole = ann._walking

    def seen(shared, visits):
        met.append((visits, shared.value[0]["leaves"]))
        return whole(shared, visits)

    monkeypatch.setattr(ann, "_walking", seen)
    got = found(search(frame(spark, rows), is_query()))
    visits, leaves = met[0]
    assert visits < leaves / 10
    want = brute(rows, 20)
    assert sum(len({i for _, i, _ in near} & {i for i, _ in want[q]}) for q, near in got.items()) >= 0.9 * 20 * len(want)
