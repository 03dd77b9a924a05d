import corpus_pipeline as cp
from ioclake.llm.pieces import Encoder, load
from ioclake.llm.queries import q_language_id
from tests.llm.test_decontaminate import brute as hits
from tests.llm.test_near_dedup import brute as groups

SF = "/root/testdata/sf0.001"


def test_stages_on_their_own_inputs(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    items = [(str(r.item_id), r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    seen = {}
    for name, stage in cp.STAGES:
        out = stage(spark, docs, SF)
        if name != "sentencepiece":
            assert out.columns == docs.columns
        out = cp.written(out, f"test-{name}")
        seen[name] = ({r.doc_id: r.text for r in docs.collect()}, out.collect())
        docs = out
    before, after = seen["language_id"]
    told = {r.doc_id: r for r in q_language_id(spark, SF).collect()}
    assert {r.doc_id for r in after} == {i for i in before
                                         if told[i].lang_pred != "und" and told[i].score >= cp.MIN_SCORE}
    assert len(after) >= 0.99 * len(before)
    before, after = seen["near_dedup"]
    root = groups(sorted(before.items()), cp.NGRAM)
    assert {r.doc_id for r in after} == set(root.values()) and len(after) == len(set(root.values())) < len(before)
    before, after = seen["decontaminate"]
    dirty = {h[0] for h in hits(sorted(before.items()), items) if h[5]}
    assert dirty and {r.doc_id for r in after} == set(before) - dirty
    before, after = seen["sentencepiece"]
    enc = Encoder(load())
    assert {r.doc_id: list(r.pieces) for r in after} == {i: enc.encode([t])[0].tolist() for i, t in before.items()}
    assert all(r.round_trip for r in after)


def test_edge_documents(spark):
    kind = "doc_id long, text string, lang string, source string, n_chars long, score int"
    rows = [(1, None, None, None, None, 1), (2, "", "en", "s", 0, 1), (3, "12 34", "en", "s", 5, 1),
            (4, "the house of the dog", "en", "s", 20, 1), (4, "the house of the dog", "en", "s", 20, 1),
            (5, "THE house  of the dog", "en", "t", 21, 2), (None, "a text without an id", None, None, None, None)]
    docs = spark.createDataFrame(rows, kind)
    for _, stage in cp.STAGES[:-1]:
        docs = cp.written(stage(spark, docs, SF), "edge")
        assert docs.columns == [c.split()[0] for c in kind.split(", ")]
    assert sorted(str(r.doc_id) for r in docs.collect()) == ["4", "None"]
    assert cp.STAGES[-1][1](spark, docs, SF).count() == 2
    empty = spark.createDataFrame([], kind)
    for _, stage in cp.STAGES:
        assert stage(spark, empty, SF).count() == 0
