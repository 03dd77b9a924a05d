import random

import pytest
from pyspark.sql import functions as F

from ioclake.llm.decontaminate import contamination, drop_contaminated
from ioclake.llm.queries import q_decontaminate

DOCS = "doc_id long, text string, items string, n_hit int"
ITEMS = "item_id string, text string, window string"


def words(t):
    out, cur = [], ""
    for ch in (t or "") + " ":
        c = ch.lower() if ch.isascii() else ch
        if ord(c) > 127 or c.isdigit() or "a" <= c <= "z":
            cur += c
        elif cur:
            out.append(cur)
            cur = ""
    return out


def brute(docs, items):
    out = []
    for i, t in docs:
        w, hit, found = words(t), set(), set()
        for k, it in items:
            x = words(it)
            n = min(10, len(x))
            for o in range(len(x) - n + 1 if n else 0):
                for p in range(len(w) - n + 1):
                    if w[p:p + n] == x[o:o + n]:
                        hit |= set(range(p, p + n))
                        found |= {k} - {None}
        out.append((i, len(w), len(hit), len(found), tuple(sorted(found)), bool(hit)))
    return sorted(out, key=str)


@pytest.mark.parametrize("seed", range(3))
def test_equals_brute_force(spark, seed):
    rng = random.Random(seed)
    vocab = ["ab", "cd", "Éa", "9", "x1", "ZZ", "日本"]
    text = lambda n: rng.choice([" ", ", ", "\n", "--"]).join(rng.choice(vocab) for _ in range(n))
    items = [(str(k), text(rng.choice([0, 1, 3, 9, 10, 11, 25]))) for k in range(12)] + [("7", text(12)), (None, text(14))]
    docs = []
    for i in range(40):
        t = text(rng.randrange(0, 40))
        if rng.random() < 0.6:
            x = words(rng.choice(items)[1])
            a = rng.randrange(0, max(1, len(x) - 9))
            t += " " + " ".join(x[a:a + rng.choice([8, 10, 13, 30])]).upper() + "; " + text(3)
        docs.append((i, t))
    docs += [(50, None), (51, ""), (52, docs[3][1]), (52, docs[3][1]), (None, docs[5][1]), (53, "ab " * 3000)]
    df = spark.createDataFrame([(i, t, "x", 5) for i, t in docs], DOCS)
    it = spark.createDataFrame([(k, t, "w") for k, t in items], ITEMS)
    got = sorted(((r.doc_id, r.n_words, r.n_hit, r.n_items, tuple(r["items"]), r.contaminated)
                  for r in contamination(df, it).collect()), key=str)
    assert got == brute(docs, items)
    left = drop_contaminated(df, it)
    assert left.columns == df.columns
    assert sorted(map(str, (r.doc_id for r in left.collect()))) == sorted(str(g[0]) for g in got if not g[5])


def test_empty_tables(spark):
    df = spark.createDataFrame([(1, "a b c", "x", 5)], DOCS)
    none = spark.createDataFrame([], ITEMS)
    assert [tuple(r) for r in contamination(df, none).collect()] == [(1, 3, 0, 0, [], False)]
    assert contamination(df.limit(0), none).count() == 0


def test_plan_is_native(spark):
    from tests.llm.conftest import SF
    plan = q_decontaminate(spark, SF)._jdf.queryExecution().toString()
    assert not any(x in plan for x in ("Python", "Pandas", "Arrow", "CartesianProduct", "NestedLoop"))
    assert F is not None
