"""Text quality from trusted positives and unlabelled text.

Only texts known to be good are labels; everything else, good or bad, is
unlabelled web text.  With class prior ``p`` (the share of good texts among the
unlabelled) the risk of calling bad what is bad is that of the unlabelled minus
``p`` times that of the positives.  A flexible model drives this estimate below
zero, which no risk can be; so where it is negative, a step goes back up it
(non-negative risk).  The loss is logistic, so the sigmoid of the model is the
probability of a good text.

The prior is estimated from the data: a classifier of positives against
unlabelled texts is fitted to one half of each; over the other half, the share
of unlabelled over the share of positives above a cut of its score tends to the
prior from above, and the cut with the best confidence bound is taken.

The model is linear in a text's byte frequencies, hashed byte-pair frequencies
(square roots of shares) and a few measures of its words.  Features are made in
parallel over whole texts; training is plain numpy in one task on at most
``PER_CLASS`` different positive and twice as many unlabelled texts, those of the
smallest hashes.  Scoring is one pass.

Defined results: a document with several labels is a trusted positive if all say
so; a null text is empty, and an empty text gets the score of its features (all
zero); rows with a null id are scored and not learned from; without a positive or
an unlabelled training text every score is 0.5; equal texts get equal scores; no
column but the text is an input; extra columns are ignored.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ioclake.llm.bytewords import words
from ioclake.llm.common import written

#: bound of the training sample: positives; unlabelled texts are twice as many
PER_CLASS = 4096
PAIRS = 1024
MEASURES = ("adjacent equal words", "words seen before", "bytes a word", "words of over 20 bytes", "size")
STEPS, RATE, DECAY = 300, 0.02, 1e-4
#: confidence of the prior's bound
DELTA, GAMMA = 0.1, 0.01
ROWS_AT_ONCE = 256


# ----------------------------------------------------------------- features

def _shares(row: np.ndarray, place: np.ndarray, rows: int, width: int) -> np.ndarray:
    count = np.bincount(row * width + place, minlength=rows * width).reshape(rows, width)
    return np.sqrt(count / np.maximum(1, count.sum(1, keepdims=True)))


def features(texts: pa.Array) -> Iterator[tuple[int, np.ndarray]]:
    """(first row, feature rows) of runs of whole texts."""
    for at in range(0, len(texts), ROWS_AT_ONCE):
        for w in words(texts.slice(at, ROWS_AT_ONCE)):
            size = np.diff(w.offs)
            row = np.repeat(np.arange(w.rows), size)
            inner = row[1:] == row[:-1]
            pair = (w.data[:-1].astype(np.int64) * 257 + w.data[1:]) * 40503 >> 4 & (PAIRS - 1)
            count = np.diff(w.bound)
            word_row = np.repeat(np.arange(w.rows), count)
            length = w.end - w.start
            same = (w.hash[1:] == w.hash[:-1]) & (word_row[1:] == word_row[:-1])
            order = np.lexsort((w.hash, word_row))
            again = (w.hash[order][1:] == w.hash[order][:-1]) & (word_row[order][1:] == word_row[order][:-1])
            n = np.maximum(1, count)
            measures = np.stack([
                np.bincount(word_row[1:][same], minlength=w.rows) / n,
                np.bincount(word_row[order][1:][again], minlength=w.rows) / n,
                np.bincount(word_row, length, w.rows) / n,
                np.bincount(word_row[length > 20], minlength=w.rows) / n,
                np.log1p(size)], 1)
            yield at + w.first, np.concatenate(
                (_shares(row, w.data.astype(np.int64), w.rows, 256),
                 _shares(row[1:][inner], pair[inner], w.rows, PAIRS), measures), 1).astype(np.float32)


# ----------------------------------------------------------------- training

def _score(x: np.ndarray, w: np.ndarray) -> np.ndarray:
    """Model values in the precision of the features, which are never copied."""
    return (x @ w[:-1].astype(x.dtype)).astype(float) + w[-1]


def _grad(x: np.ndarray, s: np.ndarray) -> np.ndarray:
    """Mean over rows of the weights' gradient, from slopes per row."""
    return np.append(s.astype(x.dtype) @ x, s.sum()) / len(s)


def _loss(z: np.ndarray) -> np.ndarray:
    return np.logaddexp(0, -z)


def _slope(z: np.ndarray) -> np.ndarray:
    """Derivative of the loss."""
    return -1 / (1 + np.exp(np.clip(z, -500, 500)))


def pu_risk(weights: np.ndarray, good: np.ndarray, mixed: np.ndarray, prior: float) -> tuple[float, np.ndarray]:
    """Non-negative risk and the direction to descend.  The last weight is
    the bias."""
    zg, zm = _score(good, weights), _score(mixed, weights)
    bad = _loss(-zm).mean() - prior * _loss(-zg).mean()
    of_bad = _grad(mixed, -_slope(-zm)) - prior * _grad(good, -_slope(-zg))
    if bad < 0:  # no risk is: go back up
        return prior * _loss(zg).mean(), -of_bad
    return prior * _loss(zg).mean() + bad, prior * _grad(good, _slope(zg)) + of_bad


def _adam(width: int, direction) -> np.ndarray:
    w, m, v = (np.zeros(width + 1) for _ in range(3))
    for step in range(1, STEPS + 1):
        g = direction(w) + DECAY * np.append(w[:-1], 0)
        m, v = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g
        w = w - RATE * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
    return w


def class_prior(good: np.ndarray, mixed: np.ndarray) -> float:
    """Share of positives among the unlabelled, from scores of both: the
    ratio of shares above the cut whose upper bound is least."""
    cuts = np.unique(good)
    of_good = 1 - np.searchsorted(np.sort(good), cuts) / len(good)
    of_mixed = 1 - np.searchsorted(np.sort(mixed), cuts) / len(mixed)
    slack = sum(np.sqrt(np.log(4 / DELTA) / (2 * len(x))) for x in (good, mixed))
    best = np.argmin((of_mixed + (1 + GAMMA) * slack) / of_good)
    return float(np.clip(of_mixed[best] / of_good[best], 0.01, 0.99))


def train(good: np.ndarray, mixed: np.ndarray) -> dict:
    """Weights, the scale of features and the estimated prior."""
    both = np.concatenate((good, mixed))
    mean, spread = both.mean(0), both.std(0) + 1e-3
    good, mixed = (good - mean) / spread, (mixed - mean) / spread

    def apart(w):  # positives against unlabelled texts
        return _grad(halves[0], _slope(_score(halves[0], w))) + _grad(halves[1], -_slope(-_score(halves[1], w)))

    halves = good[::2], mixed[::2]
    w = _adam(good.shape[1], apart)
    others = [x[1::2] if len(x) > 1 else x for x in (good, mixed)]
    prior = class_prior(*(_score(x, w) for x in others))
    w = _adam(good.shape[1], lambda w: pu_risk(w, good, mixed, prior)[1])
    return {"mean": mean, "spread": spread, "weights": w, "prior": prior}


def probabilities(model: dict, x: np.ndarray) -> np.ndarray:
    # summed row by row, so a text's score does not depend on its neighbours
    z = ((x - model["mean"]) / model["spread"] * model["weights"][:-1]).sum(1) + model["weights"][-1]
    return 1 / (1 + np.exp(np.clip(-z, -500, 500)))


# -------------------------------------------------------------------- Spark

def _featuring(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for first, x in features(b.column(0)):
            yield pa.RecordBatch.from_arrays(
                [*[c.slice(first, len(x)) for c in b.columns[1:]], pa.array([r.tobytes() for r in x], pa.binary())],
                names=[*b.schema.names[1:], "x"])


def _training(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    rows = {}
    for b in batches:
        for h, good, mixed, x in zip(*(c.to_pylist() for c in b.columns), strict=True):
            rows[h] = (good, mixed, x)  # repeated rows of a text are one
    ordered = [rows[h] for h in sorted(rows)]  # the same model for any order of rows
    sides = [[np.frombuffer(r[2], np.float32) for r in ordered if r[k]] for k in (0, 1)]
    if sides[0] and sides[1]:
        model = train(*(np.stack(s) for s in sides))
        yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(model)], pa.binary())], names=["model"])


def _part(h: Column, salt: int) -> Column:
    """A uniform number in [0, 1) by hash."""
    return F.pmod(F.xxhash64(h, F.lit(salt)), F.lit(1 << 40)) / float(1 << 40)


def fit(docs: DataFrame, labels: DataFrame, use: Column, id_col: str = "doc_id", text_col: str = "text",
        label_col: str = "quality", per_class: int = PER_CLASS) -> dict | None:
    """The model learned from the documents where ``use`` holds and the
    positive ones among ``labels`` (id, 1 or 0) of those documents."""
    trusted = labels.select(F.col(id_col).alias("id"), F.col(label_col).alias("y")).groupBy("id") \
        .agg(F.min("y").alias("y"), F.count_if(F.col("y").isNull()).alias("gaps")).filter("y = 1 and gaps = 0").select("id")
    # each different text once, by narrow rows
    src = docs.filter(F.coalesce(use, F.lit(False)) & F.col(id_col).isNotNull() & (F.col(text_col) != "")).select(
        F.col(id_col).alias("id"), F.xxhash64(F.lit("quality"), F.col(text_col)).alias("h"), F.col(text_col).alias("text"))
    texts = written(src.select("id", "h").join(trusted.withColumn("good", F.lit(True)), "id", "left").groupBy("h").agg(
        F.min("id").alias("id"), F.coalesce(F.bool_or("good"), F.lit(False)).alias("good")), "texts")
    n = texts.agg(F.count(F.lit(1)).alias("mixed"), F.count_if("good").alias("good")).first()
    if not n.good:
        return None
    some = texts.select("id", "h", (F.col("good") & (_part(F.col("h"), 1) * n.good < per_class)).alias("good"),
                        (_part(F.col("h"), 2) * n.mixed < 2 * per_class).alias("mixed")).filter("good or mixed")
    # about 3 * per_class narrow rows; the limit is the proof
    chosen = F.broadcast(some.orderBy("h").limit(6 * per_class))
    made = src.join(chosen, ["id", "h"]).select("text", "h", "good", "mixed") \
        .mapInArrow(_featuring, "h long, good boolean, mixed boolean, x binary")
    got = made.repartition(1).mapInArrow(_training, "model binary").first()
    return pickle.loads(got.model) if got else None


def _scoring(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for b in batches:
            for first, x in features(b.column(0)):
                p = np.full(len(x), 0.5) if model is None else probabilities(model, x)
                yield pa.RecordBatch.from_arrays([*[c.slice(first, len(x)) for c in b.columns[1:]], pa.array(p)],
                                                 names=[*b.schema.names[1:], "score"])
    return run


def score(docs: DataFrame, model: dict | None, keep: dict[str, Column], text_col: str = "text") -> DataFrame:
    """``keep`` columns and score, the probability of a good text, per row."""
    src = docs.select(F.col(text_col).cast("binary").alias("__text"), *[c.alias(n) for n, c in keep.items()])
    schema = ", ".join([*(f"`{n}` {t}" for n, t in src.dtypes[1:]), "score double"])
    return src.mapInArrow(_scoring(src.sparkSession.sparkContext.broadcast(model)), schema)  # of fixed size
