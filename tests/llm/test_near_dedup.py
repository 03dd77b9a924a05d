import numpy as np
import pytest
from pyspark.sql import functions as F

from ioclake.llm.components import connected_components
from ioclake.llm.near_dedup import BASE, RATE, TOP, joint_estimate, keep_one, merge, near_dedup, sketch_sets

DOCS = "doc_id long, text string, lang string, n_shingles int, kept string"


def brute(rows, ngram, num=80, den=100):
    """component of each id, by comparing all sets."""
    sets, parent = {}, {}
    for i, t in rows:
        w = (t or "").encode().lower().split()
        s = set(zip(*[w[k:] for k in range(ngram)])) if len(w) >= ngram else ({tuple(w)} if w else set())
        sets.setdefault(i, []).append(s)
        parent[i] = i

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(sets)
    for a in ids:
        for b in ids:
            if a < b and any(s and t and den * len(s & t) >= num * len(s | t) for s in sets[a] for t in sets[b]):
                x, y = root(a), root(b)
                parent[max(x, y)] = min(x, y)
    return {i: root(i) for i in ids}


def varied(rng, words, edits):
    out = list(words)
    for _ in range(edits):
        out[rng.integers(len(out))] = f"x{rng.integers(10**6)}"
    return " ".join(out)


@pytest.mark.parametrize("ngram", [2, 5])
def test_components_equal_brute_force(spark, ngram):
    rng = np.random.default_rng(ngram)
    rows, i = [], 0
    for g in range(12):
        base = [f"w{rng.integers(5000)}" for _ in range(120)]
        for _ in range(8):
            rows.append((i, varied(rng, base, int(rng.integers(0, 9)))))
            i += 1
    rows += [(i, rows[3][1]), (i + 1, rows[3][1].upper()), (i + 2, "one"), (i + 3, "ONE"), (i + 4, ""), (i + 5, None),
             (i + 6, "one two"), (i + 7, " \t\n"), (4, "quite another text of id four " * 9)]
    df = spark.createDataFrame([(a, t, "x", 1, "k") for a, t in rows], DOCS)
    got = {r.doc_id: r.component_id for r in near_dedup(df, ngram=ngram).collect()}
    assert got == brute(rows, ngram)


def test_edge_rows_and_columns(spark):
    df = spark.createDataFrame([(None, "a b c", "x", 1, ""), (1, None, None, None, None), (2, "a b c", "x", 1, ""),
                                (2, "a b c", "x", 1, ""), (3, "A  b\tc", "x", 1, "")], DOCS)
    got = sorted(map(tuple, near_dedup(df, ngram=2).collect()), key=str)
    assert got == sorted([(1, 0, 1, True), (2, 2, 2, True), (2, 2, 2, True), (3, 2, 2, False), (None, 2, None, True)],
                         key=str)
    left = keep_one(df, ngram=2)
    assert left.columns == df.columns
    assert sorted(str(r.doc_id) for r in left.collect()) == ["1", "2", "None"]
    assert near_dedup(df.limit(0)).count() == 0


def test_one_large_group_needs_no_pairs(spark):
    base = " ".join(f"w{i}" for i in range(200))
    df = spark.range(3000).select(F.col("id").alias("doc_id"), F.concat(F.lit(base), F.lit(" t"), F.col("id") % 700)
                                  .alias("text"))
    got = near_dedup(df, ngram=2).groupBy("component_id").count().collect()
    assert [tuple(r) for r in got] == [(0, 3000)]


def test_registers_merge_and_estimate():
    rng = np.random.default_rng(1)
    m = 336
    for j in (0.5, 0.8, 0.95):
        n = 1000
        both = int(round(2 * n * j / (1 + j)))
        pool = np.unique(rng.integers(0, 2**63, 4 * n, dtype=np.uint64))
        rng.shuffle(pool)
        a, b = np.sort(pool[:n]), np.sort(np.concatenate([pool[:both], pool[n:2 * n - both]]))
        u = np.union1d(a, b)
        flat = np.concatenate([a, b, u])
        regs = sketch_sets(flat, np.array([0, n, 2 * n, len(flat)]), m)
        assert (merge(regs[0], regs[1]) == regs[2]).all()
        est = joint_estimate(regs[:1], regs[1:2], np.array([n]), np.array([n]))[0]
        assert abs(est - j) < 5 * (j * (1 - j) / m) ** 0.5 + 0.01
    assert (BASE, RATE, TOP) == (1.001, 20.0, 65535)


def test_chain_of_links(spark):
    edges = spark.range(1, 200).select(F.col("id").alias("a"), (F.col("id") - 1).alias("b"))
    edges = edges.union(spark.createDataFrame([(900, 901), (901, 900), (950, 950)], "a long, b long"))
    got = {r.id: r.comp for r in connected_components(edges).collect()}
    assert got == {**{i: 0 for i in range(200)}, 900: 900, 901: 900}


def test_an_id_with_three_texts_is_one_document(spark, monkeypatch):
    from ioclake.llm import near_dedup as module

    texts = [" ".join(f"{w}{i}" for i in range(60)) for w in "abcd"]
    rows = [(1, texts[0]), (2, texts[1]), (3, texts[2]), (4, texts[3]), *[(9, x) for x in texts]]
    real, lost = module._family_links, []

    def links(families, comps, sets, num, den):
        lost.append(families.select("id").join(sets.select("id"), "id", "left_anti").count())
        return real(families, comps, sets, num, den)

    monkeypatch.setattr(module, "_family_links", links)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {(r.doc_id, r.component_id) for r in module.near_dedup(df, ngram=2).collect()}
    assert got == {(i, 1) for i in (1, 2, 3, 4, 9)}
    assert lost == [0]


def made_members(n, twins, rng):
    """(id, family, n, bits, regs): random registers, every ``twins``-th a copy of the one before with 9 changed."""
    regs = rng.integers(0, 60_000, (n, 336)).astype(np.uint16)
    for i in range(1, n, twins):
        regs[i] = regs[i - 1]
        regs[i, :9] ^= 1
    bits = rng.integers(0, 2**63, (n, 4), dtype=np.int64)
    for i in range(1, n, twins):
        bits[i] = bits[i - 1] ^ np.array([511, 0, 0, 0])
    return [(int(i), int(i // 3), int(90 + i % 20), [int(x) for x in bits[i]], bytearray(regs[i].tobytes())) for i in range(n)]


def allowed(rows, num, den):
    from ioclake.llm.near_dedup import _apart
    out = set()
    bits = np.array([r[3] for r in rows])
    for k, (i, f, n, _, _) in enumerate(rows):
        near = np.flatnonzero(np.bitwise_count(bits[k] ^ bits).sum(1) <= _apart(num / den))
        out |= {(min(i, rows[m][0]), max(i, rows[m][0])) for m in near if rows[m][1] != f
                and den * min(n, rows[m][2]) >= num * max(n, rows[m][2])}
    return out


@pytest.mark.parametrize("at_once", [1 << 20, 100])
def test_members_of_a_bucket_meet_in_blocks(spark, monkeypatch, at_once):
    from ioclake.llm import near_dedup as module
    monkeypatch.setattr(module, "PAIRS_AT_ONCE", at_once)
    monkeypatch.setattr(module, "BUCKET_BLOCK", 16)
    rows = made_members(120, 4, np.random.default_rng(2))
    df = spark.createDataFrame([(k, *r, 120) for k in (7, 8) for r in rows] + [(9, *r, 3) for r in rows[:3]],
                               "key long, id long, family long, n long, bits array<long>, regs binary, held long")
    got = {tuple(r) for r in module._bucket_pairs(df, 80, 100).collect()}
    assert got == allowed(rows, 80, 100)


def test_a_bucket_of_many_unlike_members_lists_no_pairs(spark):
    from ioclake.llm import near_dedup as module
    rows = made_members(5000, 50, np.random.default_rng(3))
    df = spark.createDataFrame([(1, *r, 5000) for r in rows],
                               "key long, id long, family long, n long, bits array<long>, regs binary, held long")
    out = module._bucket_pairs(df, 80, 100)
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" in plan and "family" not in plan.split("MapInArrow")[0]
    met = spark.read.parquet(*{f for f in out.inputFiles()}).groupBy("key").count().first()[1]
    assert met <= 2 * 5000 / module.BUCKET_BLOCK  # blocks, so under 200 pairs of them for 12 million of members
    assert {tuple(r) for r in out.collect()} == allowed(rows, 80, 100)


def test_joins_by_count_keep_every_row(spark, monkeypatch):
    from ioclake.functions import joins
    from ioclake.llm import common
    monkeypatch.setattr(joins, "HOT_KEYS", 4)
    rows = [(1, n) for n in range(60)] + [(2, n) for n in range(30)] + [(k, 0) for k in range(3, 20)]
    df = spark.createDataFrame(rows, "k long, x long")
    per = df.groupBy("k").agg(F.count("x").alias("held"), F.max("x").alias("top"))
    got = common.join_counted(df, per, "k", "held", len(rows))
    assert sorted(map(tuple, got.collect())) == sorted((k, x, {1: 59, 2: 29}.get(k, 0)) for k, x in rows)
