import numpy as np
from pyspark.sql import functions as F

from ioclake.llm import language_id as L
from ioclake.llm.common import fold_bucket
from ioclake.llm.queries import q_language_id

SF = "/root/testdata/sf0.01"


def test_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang")
    rows = q_language_id(spark, SF).join(docs, "doc_id").filter("held_out").collect()
    assert len(rows) > 150
    assert np.mean([r.lang_pred == r.lang for r in rows]) > 0.95
    assert all(0 <= r.score <= 1 for r in rows)


def test_tables_equal_the_plain_network():
    rng = np.random.default_rng(1)
    net = L._init(3)
    x = rng.integers(0, 256, (40, L.WINDOW))
    pooled = []
    for w in L.WIDTHS:
        z = sum(net[f"t{w}"][k][x[:, k:L.WINDOW - w + 1 + k]] for k in range(w))
        pooled.append(np.maximum(z.max(1) + net[f"b{w}"], 0))
    plain = L._softmax(np.concatenate(pooled, 1) @ net["out"] + net["bias"])
    assert np.allclose(L.probabilities(L.ready(net), x, 16), plain, atol=1e-5)


def test_gradients_move_the_loss_down():
    rng = np.random.default_rng(2)
    x = np.concatenate([rng.integers(97, 110, (200, L.WINDOW)), rng.integers(108, 122, (200, L.WINDOW))])
    y = np.repeat([0, 1], 200)
    p = L.probabilities(L.ready(L.train(x, y, 2)), x)
    assert (p.argmax(1) == y).mean() > 0.95


def test_edge_texts(spark):
    kind = "doc_id long, text string, lang string, lang_pred int, score string"
    rows = [(i, "the cat of the house and the dog " * 5, "en", 1, "x") for i in range(10)]
    rows += [(20 + i, "der Hund und die Katze von dem Haus " * 5, "de", 1, "x") for i in range(10)]
    rows += [(50, None, "en", 1, ""), (51, "", "en", 1, ""), (52, "123 ²½ !?", "en", 1, ""), (53, "a" * 300_000, None, 1, ""),
             (54, "日本", None, 1, ""), (0, rows[0][1], "en", 1, "")]
    df = spark.createDataFrame(rows, kind)
    use = fold_bucket(F.col("doc_id"), 5) != 0
    out = L.predict(df, L.fit(df, "text", "lang", use), "doc_id", "text", {"n": F.length("text")}).collect()
    by = {r.doc_id: r for r in out}
    assert len(out) == len(rows)
    assert [by[i].lang_pred for i in (50, 51, 52)] == ["und"] * 3 and by[50].score == 0
    assert by[53].lang_pred in ("de", "en") and by[54].lang_pred in ("de", "en") and by[53].n == 300_000
    whole = L.with_language(df, L.fit(df, "text", "lang", use), "text")
    assert whole.select(*df.columns).columns == df.columns
    none = L.fit(df, "text", "lang", F.lit(False))
    assert none is None
    assert {r.lang_pred for r in L.predict(df, none, "doc_id", "text").collect()} == {"und"}
    assert L.predict(df.limit(0), none, "doc_id", "text").count() == 0


def test_copies_do_not_thin_out_the_sample(spark, monkeypatch):
    monkeypatch.setattr(L, "PER_LANG", 20)
    words = {"en": "the cat of the house and the dog number", "de": "der Hund und die Katze von dem Haus Nummer"}
    docs = spark.range(20_000).select("id", F.when(F.col("id") % 2 == 0, "en").otherwise("de").alias("lang")).select(
        "lang", F.concat(F.when(F.col("lang") == "en", words["en"]).otherwise(words["de"]), F.lit(" "),
                         F.when(F.col("id") < 15_000, F.col("id") % 10).otherwise(F.lit(77)).cast("string")).alias("text"))
    monkeypatch.setattr(L, "_trainer", _rows_then(L._trainer))
    known, net = L.fit(docs, "text", "lang", F.lit(True))
    seen = net.pop("rows")
    assert known == ["de", "en"]
    assert len(seen) == len(set(seen)) == 12  # five texts and the common one of each language


def _rows_then(real):
    def run(batches):
        import pickle

        import pyarrow as pa
        held = list(batches)
        for out in real(iter(held)):
            known, net = pickle.loads(out.column(0)[0].as_py())
            net["rows"] = [x for b in held for x in b.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps((known, net))], pa.binary())], names=["model"])
    return run


def test_every_labelled_language_is_learned(spark):
    df = spark.createDataFrame([(f"{chr(97 + n % 26) * 5} {chr(97 + n // 26) * 7} {i}", f"l{n:02}")
                                for n in range(70) for i in range(1 + (n < 69))], "text string, lang string")
    known, net = L.fit(df, "text", "lang", F.lit(True))
    assert known == [f"l{n:02}" for n in range(70)] and net["out"].shape[1] == 70


def test_gradient_by_differences():
    rng = np.random.default_rng(6)
    net = {k: v.astype(float) for k, v in L._init(3).items()}
    x, y = rng.integers(0, 30, (5, L.WINDOW)), np.array([0, 1, 2, 1, 0])
    _, grad = L.loss_and_grad(net, x, y)
    for name, values in net.items():
        flat, slope = values.reshape(-1), grad[name].reshape(-1)
        for at in np.argsort(-np.abs(slope))[:6]:
            kept, e = flat[at], 1e-5
            flat[at] = kept + e
            up = L.loss_and_grad(net, x, y)[0]
            flat[at] = kept - e
            down = L.loss_and_grad(net, x, y)[0]
            flat[at] = kept
            assert abs((up - down) / (2 * e) - slope[at]) < 1e-4 * max(1, abs(slope[at])), name


def test_document_score_is_the_mean_over_bytes(spark):
    """Every window by plain sums, weighted by the bytes it holds."""
    known, net = ["a", "b", "c"], L._init(3)
    texts = ["x" * 10, "the quick brown fox " * 40, "é" * 300 + " end", "q" * 256, "z" * 257]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r for r in L.predict(df, (known, net), "doc_id", "text").collect()}
    for i, t in enumerate(texts):
        data, total = t.encode(), np.zeros(3)
        for at in range(0, len(data), L.WINDOW):
            held = data[at:at + L.WINDOW]
            x = np.zeros(L.WINDOW, int)
            x[:len(held)] = list(held)
            feat = []
            for w in L.WIDTHS:
                z = np.array([sum(net[f"t{w}"][k][x[p + k]] for k in range(w)) for p in range(L.WINDOW - w + 1)])
                feat.append(np.maximum(z.max(0) + net[f"b{w}"], 0))
            total += len(held) * L._softmax((np.concatenate(feat) @ net["out"] + net["bias"])[None])[0]
        mean = total / len(data)
        assert got[i].lang_pred == known[mean.argmax()] and abs(got[i].score - mean.max()) < 1e-4


def test_a_null_id_is_not_held_out(spark, tmp_path):
    rows = [(n, "the cat of the house " * 3, "en") for n in range(20)] + [(None, "the cat of the house", "en")]
    spark.createDataFrame(rows, "doc_id long, text string, lang string").write.parquet(str(tmp_path / "documents.parquet"))
    out = {r.doc_id: r for r in q_language_id(spark, str(tmp_path)).collect()}
    assert len(out) == 21 and out[None].held_out is False and out[None].lang_pred == "en"


def test_the_sample_is_bounded(spark, monkeypatch):
    monkeypatch.setattr(L, "LANGS", 2)
    monkeypatch.setattr(L, "PER_LANG", 30)
    df = spark.createDataFrame([(f"{lang} word {i} " * 200, lang) for lang, n in (("aa", 400), ("bb", 300), ("cc", 5)) for i in range(n)],
                               "text string, lang string")
    seen, real = [], L.train
    path = __import__("tempfile").mkdtemp()

    def spied(x, y, n):
        import numpy
        numpy.save(path + "/y.npy", y)
        return real(x[:64], y[:64] * 0, n)

    monkeypatch.setattr(L, "train", spied)
    known, _ = L.fit(df, "text", "lang", F.lit(True))
    y = np.load(path + "/y.npy")
    assert known == ["aa", "bb"] and not seen
    assert all(20 * L.PER_DOC < (y == k).sum() <= 30 * L.PER_DOC for k in (0, 1))
