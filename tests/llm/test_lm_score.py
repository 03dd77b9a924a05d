import math
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from ioclake.llm import lm_score as M
from ioclake.llm.common import fold_bucket
from ioclake.llm.queries import q_lm_score

SF = "/root/testdata/sf0.001"


def brute(rows):
    """(held_out, n_tokens, n_known, train_tokens, base) per row."""
    c = Counter()
    toks = [(t or "").encode().lower().split() + [b"\n"] for _, t in rows]
    held = [i is not None and zlib.crc32(str(i).encode()) % 10 == 0 for i, _ in rows]
    for (i, _), t, h in zip(rows, toks, held, strict=True):
        if i is not None and not h:
            c.update(t)
    n, v = sum(c.values()), len(c)
    return [(h, len(t), sum(c[w] > 0 for w in t), n, sum(math.log10((c[w] + .1) / (n + .1 * (v + 1))) for w in t))
            for t, h in zip(toks, held, strict=True)]


def test_query_equals_brute_force_and_beats_the_base(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    want = {i: b for (i, _), b in zip(docs, brute(docs), strict=True)}
    total = base = 0
    for r in q_lm_score(spark, SF).collect():
        h, n, k, t, b = want[r.doc_id]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (h, n, k, t)
        assert r.base_score == pytest.approx(b, rel=1e-9)
        assert r.score < 0
        total, base = total + r.score, base + r.base_score
    assert total > base


def test_few_frequent_words_and_edge_rows(spark, monkeypatch):
    monkeypatch.setattr(M, "HEAD", 6)  # most words go through the join
    rng = np.random.default_rng(1)
    rows = [(i, " ".join(f"w{rng.zipf(1.5) % 50}" for _ in range(30))) for i in range(40)]
    rows += [(40, None), (41, ""), (42, "Never SEEN words never"), (1, rows[1][1]), (None, "w1 w2"), (43, "w1 " * 40_000)]
    df = spark.createDataFrame([(i, t, 1, 2.0) for i, t in rows], "doc_id long, text string, n_known int, score double")
    got = M.score(df, "doc_id", "text", fold_bucket(F.col("doc_id"), 10)).collect()
    key = lambda x: (str(x[0]), x[1:3])
    a = sorted(((r.doc_id, r.n_tokens, r.n_known, r.held_out, r.train_tokens, round(r.base_score, 6)) for r in got), key=key)
    b = sorted(((i, n, k, h, t, round(s, 6)) for (i, _), (h, n, k, t, s) in zip(rows, brute(rows), strict=True)), key=key)
    assert a == b
    assert all(np.isfinite(r.score) and r.score < 0 for r in got)
    empty = M.score(df.limit(0), "doc_id", "text", fold_bucket(F.col("doc_id"), 10))
    assert empty.count() == 0
    untrained = M.score(df.filter("doc_id < 3"), "doc_id", "text", F.lit(0)).collect()
    assert {(r.train_tokens, r.n_known, r.base_score) for r in untrained} == {(0, 0, 0.0)}


def test_probabilities_sum_to_one():
    net = M.initial(np.arange(1, 5000)[:M.NEURAL].astype(float), 100.0)
    rng = np.random.default_rng(2)
    net = {k: v + rng.normal(0, .05, v.shape).astype(np.float32) for k, v in net.items()}
    h = rng.normal(size=(1, M.HIDDEN)).astype(np.float32)
    ids = np.arange(M.NEURAL + 1)
    p = np.exp(M.log_probs(net, np.repeat(h, len(ids), 0), ids))
    assert p.sum() == pytest.approx(1, abs=1e-4)


def test_state_is_carried_over_windows_and_not_over_documents():
    rng = np.random.default_rng(3)
    net = M.initial(np.ones(50), 10.0)
    net = {k: v + rng.normal(0, .2, v.shape).astype(np.float32) for k, v in net.items()}
    docs = [rng.integers(0, 60, n).astype(np.int16) for n in (1, 5, 33, 200, 7, 64)]

    def plain(doc):
        h, out = np.zeros((1, M.HIDDEN), np.float32), 0.0
        table = net["e"] @ net["x"] + net["g"]
        for t in doc:
            out += M.log_probs(net, h, np.array([t]))[0]
            h = M._cell(table[[t]], h, net["u"])[0]
        return out

    want = [plain(d) for d in docs]
    for many in (1, 2, 6):
        assert np.allclose(M.score_documents(net, docs, many), want, rtol=1e-4)


def test_gradient_by_differences():
    rng = np.random.default_rng(4)
    net = M.initial(np.ones(50), 10.0)
    net = {k: (v + rng.normal(0, .2, v.shape)).astype(np.float32) for k, v in net.items()}
    docs = [rng.integers(0, 60, 20).astype(np.int16) for _ in range(8)]
    before = M.score_documents(net, docs).sum()
    trained = net
    for _ in range(5):
        trained, seen = M.train(trained, docs)
    assert seen == 160 and M.score_documents(trained, docs).sum() > before


def test_hash_table_finds_all_and_nothing_else():
    rng = np.random.default_rng(5)
    keys = np.unique(rng.integers(0, 2**63, 5000, dtype=np.uint64))
    t = M.HashTable(keys)
    assert (t.find(keys) == np.arange(len(keys))).all()
    assert (t.find(keys + np.uint64(1)) == -1).sum() >= len(keys) - 1
    assert (M.HashTable(keys[:0]).find(keys[:3]) == -1).all()


def test_network_learns_from_every_training_row(spark, monkeypatch):
    monkeypatch.setattr(M, "WARM_DOCS", 0)
    left = F.pmod(F.xxhash64(F.lit("train"), F.col("text").cast("binary")), F.lit(16)) != 0
    # one text, held by all rows: its words are as frequent as each other, only their order tells
    texts = spark.createDataFrame([(" ".join([f"p{i}", f"q{i}", f"r{i}", f"s{i}"] * 50),) for i in range(20)], "text string")
    text = texts.filter(left).first().text
    df = spark.createDataFrame([(i, text) for i in range(400)], "doc_id long, text string")
    got = M.score(df, "doc_id", "text", F.lit(1)).collect()
    assert got[0].train_tokens == 400 * 201
    assert got[0].score > 0.8 * got[0].base_score


def test_tokens_learned_from_are_all_tokens(spark):
    table = [(w.encode(), 100 - i) for i, w in enumerate("abcdefgh")]
    df = spark.createDataFrame([(i, " ".join("abcdefgh"[(i + j) % 8] for j in range(i % 7))) for i in range(300)],
                               "doc_id long, text string").select(F.col("text").cast("binary").alias("text"))
    net = M.initial(np.array([300, *(c for _, c in table)], float), 0.0)
    assert M.fitted(df.repartition(3), (table, 300, net))[1] == sum(i % 7 + 1 for i in range(300))
    assert M.fitted(df.limit(0), (table, 300, net)) == (net, 0)


def test_rows_meet_their_rare_words_without_a_sort_for_the_group(spark):
    df = spark.createDataFrame([(1, "a b"), (2, "a b"), (2, "a b"), (None, "c")], "doc_id long, text string")
    got = M.score(df, "doc_id", "text", F.lit(1))
    assert "SortAggregate" not in got._jdf.queryExecution().toString()
    assert sorted((r.doc_id or 0, r.n_tokens) for r in got.collect()) == [(0, 2), (1, 3), (2, 3), (2, 3)]


@pytest.mark.parametrize("wide", [1, 60])
def test_log_probs_equal_plain_softmax_for_small_and_large_weights(wide):
    rng = np.random.default_rng(6)
    net = {k: (v + rng.normal(0, .1, v.shape) * wide).astype(np.float32)
           for k, v in M.initial(np.arange(1, 5000)[:M.NEURAL].astype(float), 100.0).items()}
    assert M._levels(net)[0][1] == (wide == 1)
    h, ids = np.tanh(rng.normal(size=(50, M.HIDDEN))).astype(np.float32), rng.integers(0, M.NEURAL + 1, 50)
    soft = lambda x: x - x.max() - np.log(np.exp(x - x.max()).sum())
    for s, i, got in zip(h.astype(float), ids, M.log_probs(net, h, ids), strict=True):
        c, k = divmod(int(i), M.CLASS_SIZE)
        want = soft(s @ net["c"].astype(float) + net["cb"])[c]
        if c < M.CLASSES:
            want += soft(net["w"][c].astype(float) @ s + net["wb"][c])[k]
        assert got == pytest.approx(want, rel=1e-4, abs=1e-4)


def test_slopes_of_a_window_equal_differences(monkeypatch):
    rng = np.random.default_rng(7)
    net = {k: (v + rng.normal(0, .3, v.shape)).astype(np.float32) for k, v in M.initial(np.ones(50), 10.0).items()}
    docs = [rng.integers(0, 60, n).astype(np.int16) for n in (9, 31, 14, 2)] + [np.full(5, M.NEURAL, np.int16)]
    seen = {}
    monkeypatch.setattr(M, "_adam", lambda at, g, *_: seen.setdefault("g", g.copy()))
    M.train(net, docs)
    like = {k: net[k] for k in ("e", "x", "u", "g")}
    grad = M._views(seen["g"][:sum(v.size for v in like.values())], like)
    total = sum(map(len, docs))
    for k, v in like.items():
        way = rng.normal(size=v.shape).astype(np.float32)
        up, down = (M.score_documents(net | {k: v + np.float32(e) * way}, docs).sum() for e in (2e-3, -2e-3))
        assert (way * grad[k]).sum() == pytest.approx((down - up) / 4e-3 / total, rel=0.02, abs=2e-4)
