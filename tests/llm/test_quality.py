"""Positive-unlabelled quality: gradients by differences, the prior on made
scores, features against a plain count, held-out accuracy, odd rows."""

import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from ioclake.llm import quality
from ioclake.llm.queries import QUERIES

from .conftest import SF


@pytest.mark.parametrize("prior", [0.2, 0.7, 0.99])
def test_direction_is_the_gradient(prior):
    rng = np.random.default_rng(3)
    good, mixed, w = rng.normal(0.5, 1, (30, 4)), rng.normal(0, 1, (50, 4)), rng.normal(0, 0.5, 5)
    value, direction = quality.pu_risk(w, good, mixed, prior)
    z, u = good @ w[:-1] + w[-1], mixed @ w[:-1] + w[-1]
    bad = np.log1p(np.exp(u)).mean() - prior * np.log1p(np.exp(z)).mean()
    assert value == pytest.approx(prior * np.log1p(np.exp(-z)).mean() + max(0, bad))

    def part(v):  # what the direction descends: the whole risk, or up the negative part
        z, u = good @ v[:-1] + v[-1], mixed @ v[:-1] + v[-1]
        low = np.log1p(np.exp(u)).mean() - prior * np.log1p(np.exp(z)).mean()
        return -low if bad < 0 else prior * np.log1p(np.exp(-z)).mean() + low

    for k in range(5):
        e = np.zeros(5)
        e[k] = 1e-6
        assert (part(w + e) - part(w - e)) / 2e-6 == pytest.approx(direction[k], abs=1e-6)


def test_a_negative_part_turns_the_step():
    good, mixed = np.full((5, 1), 3.0), np.full((5, 1), -3.0)
    value, direction = quality.pu_risk(np.array([2.0, 0.0]), good, mixed, 0.9)
    assert value >= 0 and direction[0] < 0 or direction[0] > 0
    assert quality._loss(-(mixed @ [2.0])).mean() - 0.9 * quality._loss(-(good @ [2.0])).mean() < 0


@pytest.mark.parametrize("share", [0.1, 0.5, 0.9])
def test_prior_of_made_scores(share):
    rng = np.random.default_rng(1)
    good = rng.normal(2, 1, 4000)
    n = int(8000 * share)
    mixed = np.concatenate((rng.normal(2, 1, n), rng.normal(-2, 1, 8000 - n)))
    assert quality.class_prior(good, mixed) == pytest.approx(share, abs=0.06)


def test_features_are_plain_counts():
    texts = ["the the cat The", "", None, "a" * 25 + " b", "ÀÉ ÀÉ x"]
    rows = np.concatenate([x for _, x in quality.features(pa.array(texts))])
    assert rows.shape == (5, 256 + quality.PAIRS + len(quality.MEASURES))
    for t, row in zip(texts, rows):
        data = (t or "").encode()
        for b in range(256):
            assert row[b] == pytest.approx((data.count(bytes([b])) / max(1, len(data))) ** 0.5, abs=1e-6)
        assert (row[256:256 + quality.PAIRS] ** 2).sum() == pytest.approx(1.0 if len(data) > 1 else 0.0, abs=1e-4)
    assert rows[0][-5:-1] == pytest.approx([1 / 4, 2 / 4, 3, 0])
    assert rows[3][-5:-1] == pytest.approx([0, 0, 13, 1 / 2])


def test_features_do_not_depend_on_the_batch():
    texts = [f"word{n} " * (n % 7) + "x" * (n * 13 % 50) for n in range(600)]
    one = np.concatenate([x for _, x in quality.features(pa.array(texts))])
    each = np.concatenate([x for t in texts for _, x in quality.features(pa.array([t]))])
    assert np.allclose(one, each)


def test_held_out_accuracy(spark):
    sf = SF.replace("0.001", "0.01")
    got = {r.doc_id: r for r in QUERIES["op12_quality"](spark, sf).collect()}
    docs = spark.read.parquet(f"{sf}/documents.parquet").collect()
    assert len(got) == len(docs)
    for d in docs:
        r = got[d.doc_id]
        assert r.held_out == (zlib.crc32(str(d.doc_id).encode()) % 5 == 0)
        assert 0 <= r.score <= 1 and r.predicted == (1 if r.score >= 0.3 else 0)
    held = [(got[x.doc_id], x.quality) for x in spark.read.parquet(f"{sf}/labels.parquet").collect()
            if x.doc_id in got and got[x.doc_id].held_out]
    assert np.mean([r.predicted == y for r, y in held]) > 0.93
    good, bad = ([r.score for r, y in held if y == k] for k in (1, 0))
    assert np.mean([[g > b for g in good] for b in bad]) > 0.85


def test_odd_rows(spark):
    fine = "some good words of plain prose number"
    rows = [(n, f"{fine} {n} more", "n") for n in range(40)] + [(n, "||| *** ### !!! " * (n % 5 + 1), "n") for n in range(40, 60)]
    odd = [(None, fine, "n"), (70, None, "n"), (71, "", "n"), (72, "   ", "n"), (73, "x" * 200_000, "n"),
           (1, fine + " 1 more", "n"), (74, "\x00▁🙂", "n")]
    docs = spark.createDataFrame(rows + odd, "doc_id long, text string, score string")
    labels = spark.createDataFrame([(n, 1, 0) for n in range(40)] + [(5, 0, 0), (6, None, 0), (None, 1, 0), (999, 1, 1)],
                                   "doc_id long, quality int, toxic int")
    model = quality.fit(docs, labels, F.lit(True))
    assert model == model and 0 < model["prior"] < 1
    out = quality.score(docs, model, {"doc_id": F.col("doc_id")}).collect()
    assert len(out) == len(rows) + len(odd)
    score = {}
    for r in out:
        assert 0 <= r.score <= 1
        assert score.setdefault(r.doc_id, r.score) == r.score  # repeated rows agree
    assert score[70] == score[71]
    assert np.mean([score[n] for n in range(40)]) > np.mean([score[n] for n in range(40, 60)])
    again = quality.fit(docs.repartition(7), labels, F.lit(True))
    assert (again["weights"] == model["weights"]).all()


def test_nothing_to_learn_from(spark):
    schema = "doc_id long, text string"
    docs = spark.createDataFrame([(1, "a"), (2, None)], schema)
    none = spark.createDataFrame([], "doc_id long, quality int")
    assert quality.fit(docs, none, F.lit(True)) is None
    assert [r.score for r in quality.score(docs, None, {"doc_id": F.col("doc_id")}).collect()] == [0.5, 0.5]
    empty = spark.createDataFrame([], schema)
    assert quality.fit(empty, spark.createDataFrame([(1, 1)], "doc_id long, quality int"), F.lit(True)) is None
    assert quality.score(empty, None, {"doc_id": F.col("doc_id")}).collect() == []
