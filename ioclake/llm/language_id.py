"""Language of whole texts by a small convolutional network over bytes.

Texts are cut into fixed windows of ``WINDOW`` bytes (the last one padded).
Byte filters of several widths run over each window; per filter the largest
response is kept; a softmax layer gives the language.  A document's
probabilities are the mean over all its windows, weighted by their bytes.

Filters are linear in one-hot bytes, so a filter of width w is a sum of w table
rows; for use the tables of neighbouring bytes are merged into byte-pair
tables, which halves the look-ups.  Training is plain numpy (Adam, gradients
through the winning positions) inside one task.  Its sample is bounded: the
``LANGS`` languages with most different labelled texts, at most ``PER_LANG`` such
texts a language, those of the smallest hashes, and of each at most ``PER_DOC``
windows, spread over the whole text.  Prediction reads all bytes of all texts.

Defined results: null text or a text without a letter is ``und`` with score 0;
a table without labelled rows gives ``und`` with score 0 everywhere; equal rows
get equal answers; no column but the text is an input; extra columns are ignored.
"""

from __future__ import annotations

import pickle
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ioclake.llm.bytewords import pieces
from ioclake.llm.common import written

WIDTHS, FILTERS, WINDOW = (2, 3, 4), 16, 256
#: the bound of the training sample: languages, different texts a language, windows a text
LANGS, PER_LANG, PER_DOC = 256, 600, 4
#: texts that are looked at for each that is used, so that PER_LANG are found
SPARE = 1.25
EPOCHS, BATCH, RATE = 4, 64, 0.01
SEED = 11
_LETTER = re.compile(r"[^\W\d_]")


def has_letter(text: str) -> bool:
    return any(m.group().isalpha() for m in _LETTER.finditer(text))


def _cut(data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Windows (n, WINDOW) of whole texts, their bytes and the text of each."""
    size = np.diff(offs)
    count = -(-size // WINDOW)
    row = np.repeat(np.arange(len(size)), count)
    nth = np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)
    start = offs[row] + nth * WINDOW
    held = np.minimum(WINDOW, offs[row + 1] - start)
    at = start[:, None] + np.arange(WINDOW)
    inside = np.arange(WINDOW) < held[:, None]
    return np.where(inside, data[np.minimum(at, max(len(data) - 1, 0))], 0), held, row


def _init(n_langs: int) -> dict:
    rng = np.random.default_rng(SEED)
    net = {f"t{w}": rng.normal(0, 0.3, (w, 256, FILTERS)).astype(np.float32) for w in WIDTHS}
    net |= {f"b{w}": np.zeros(FILTERS, np.float32) for w in WIDTHS}
    net["out"] = rng.normal(0, 0.1, (FILTERS * len(WIDTHS), n_langs)).astype(np.float32)
    net["bias"] = np.zeros(n_langs, np.float32)
    return net


def _softmax(z: np.ndarray) -> np.ndarray:
    z = np.exp(z - z.max(1, keepdims=True))
    return z / z.sum(1, keepdims=True)


def loss_and_grad(net: dict, xb: np.ndarray, yb: np.ndarray) -> tuple[float, dict]:
    """Mean cross-entropy of windows ``xb`` and its gradient."""
    n, pooled, won = len(xb), [], []
    for w in WIDTHS:
        z = sum(net[f"t{w}"][k][xb[:, k:WINDOW - w + 1 + k]] for k in range(w))
        won.append(z.argmax(1))
        pooled.append(np.maximum(z.max(1) + net[f"b{w}"], 0))
    feat = np.concatenate(pooled, 1)
    d = _softmax(feat @ net["out"] + net["bias"])
    loss = -np.log(np.maximum(d[np.arange(n), yb], 1e-300)).mean()
    d[np.arange(n), yb] -= 1
    d /= n
    grad = {"out": feat.T @ d, "bias": d.sum(0)}
    back = (d @ net["out"].T) * (feat > 0)
    for i, w in enumerate(WIDTHS):
        g = back[:, i * FILTERS:(i + 1) * FILTERS]
        grad[f"b{w}"] = g.sum(0)
        t = np.zeros_like(net[f"t{w}"])
        for k in range(w):
            byte = np.take_along_axis(xb, won[i] + k, 1)
            np.add.at(t[k], (byte, np.arange(FILTERS)), g)
        grad[f"t{w}"] = t
    return float(loss), grad


def train(x: np.ndarray, y: np.ndarray, n_langs: int) -> dict:
    """Weights fitted to windows ``x`` (n, WINDOW) of languages ``y``."""
    net = _init(n_langs)
    m1 = {k: np.zeros_like(v) for k, v in net.items()}
    m2 = {k: np.zeros_like(v) for k, v in net.items()}
    rng, step = np.random.default_rng(SEED), 0
    for _ in range(EPOCHS):
        order = rng.permutation(len(x))
        for at in range(0, len(x), BATCH):
            pick = order[at:at + BATCH]
            _, grad = loss_and_grad(net, x[pick].astype(np.int64), y[pick])
            step += 1
            for k, g in grad.items():
                m1[k] = 0.9 * m1[k] + 0.1 * g
                m2[k] = 0.99 * m2[k] + 0.01 * g * g
                net[k] = net[k] - RATE * (m1[k] / (1 - 0.9**step)) / (np.sqrt(m2[k] / (1 - 0.99**step)) + 1e-8)
    return {k: v.astype(np.float32) for k, v in net.items()}


def _pair(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return (a[:, None, :] + b[None, :, :]).reshape(65536, -1)


def ready(net: dict) -> dict:
    """Tables over byte pairs: the first two bytes of each width, the last
    two of width 4; width 3 adds a table over its last byte."""
    pairs = {f"p{w}": _pair(net[f"t{w}"][0], net[f"t{w}"][1] + net[f"b{w}"]) for w in WIDTHS}
    return net | pairs | {"third": np.ascontiguousarray(net["t3"][2]), "last": _pair(net["t4"][2], net["t4"][3])}


def probabilities(net: dict, x: np.ndarray, at_once: int = 1024) -> np.ndarray:
    """Language probabilities of windows ``x``: position by position over
    many windows, so every step works on whole rows of a table."""
    out = np.empty((len(x), net["out"].shape[1]), np.float32)
    for at in range(0, len(x), at_once):
        xb = np.ascontiguousarray(x[at:at + at_once].T).astype(np.int64)
        pair = xb[:-1] * 256 + xb[1:]
        n = xb.shape[1]
        top = np.zeros((len(WIDTHS), n, FILTERS), np.float32)
        z, more = np.empty((2, n, FILTERS), np.float32)
        for i in range(WINDOW - 1):
            np.maximum(top[0], net["p2"].take(pair[i], 0, z, "clip"), out=top[0])
            if i < WINDOW - 2:
                np.add(net["p3"].take(pair[i], 0, z, "clip"), net["third"].take(xb[i + 2], 0, more, "clip"), out=z)
                np.maximum(top[1], z, out=top[1])
            if i < WINDOW - 3:
                np.add(net["p4"].take(pair[i], 0, z, "clip"), net["last"].take(pair[i + 2], 0, more, "clip"), out=z)
                np.maximum(top[2], z, out=top[2])
        out[at:at + n] = _softmax(np.concatenate(list(top), 1) @ net["out"] + net["bias"])
    return out


def _trainer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: dict[str, dict[int, np.ndarray]] = {}
    for b in batches:
        for first, rows, data, offs in pieces(b.column(0)):
            x, _, row = _cut(data, offs)
            # whole windows spread over the text; a shorter text's only one
            size = np.bincount(row, minlength=rows)
            nth = np.arange(len(row)) - (np.cumsum(size) - size)[row]
            step = np.maximum(1, size[row] // PER_DOC)
            use = (nth % step == 0) & (nth // step < PER_DOC)
            names, hashes = (b.column(k).slice(first, rows).to_pylist() for k in (1, 2))
            for r in range(rows):
                held.setdefault(names[r], {})[hashes[r]] = x[use & (row == r)].astype(np.uint8)
    if not held:
        return
    known = sorted(held)
    # by hash, so the same model for any order of rows
    chosen = [(y, held[lang][h]) for y, lang in enumerate(known) for h in sorted(held[lang])[:PER_LANG]]
    x = np.concatenate([w for _, w in chosen])
    y = np.repeat([y for y, _ in chosen], [len(w) for _, w in chosen])
    lex = np.lexsort((*x.T[:16], y))
    net = train(x[lex], y[lex], len(known))
    yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps((known, net))], pa.binary())], names=["model"])


def fit(docs: DataFrame, text_col: str, lang_col: str, use: Column, salt: str = "language") -> tuple | None:
    """(languages, network) learned from the rows where ``use`` holds."""
    rows = docs.filter(use & F.col(lang_col).isNotNull() & F.col(text_col).rlike(r"\p{L}")) \
        .select(F.col(text_col).alias("text"), F.col(lang_col).alias("lang"),
                F.xxhash64(F.lit(salt), F.col(text_col)).alias("h"))
    # chosen on narrow rows, each text once, by a hash below the language's share: no language meets in one task
    texts = written(rows.groupBy("lang", "h").agg(F.count(F.lit(1)).alias("copies")).select("lang", "h"), "texts")
    count = texts.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "lang").limit(LANGS)
    part = F.pmod(F.xxhash64("h"), F.lit(1 << 40)) / float(1 << 40)
    below = texts.join(F.broadcast(count), "lang").filter(part * F.col("n") < PER_LANG * SPARE).select("lang", "h")
    chosen = F.broadcast(below.limit(2 * LANGS * PER_LANG))  # narrow rows; the limit is the proof
    some = rows.join(chosen, ["lang", "h"]).dropDuplicates(["lang", "h"])
    got = some.select(F.col("text").cast("binary"), "lang", F.xxhash64("h").alias("h")).coalesce(1).mapInArrow(_trainer, "model binary").first()
    return pickle.loads(got.model) if got else None


def _predictor(shared, names: tuple[str, str], text: int, first: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        known, net = (model[0], ready(model[1])) if model else ([], None)
        for b in batches:
            texts = b.column(text).cast(pa.binary())
            for begin, rows, data, offs in pieces(texts):
                prob = np.zeros((rows, max(1, len(known))))
                if net is not None and len(data):
                    x, held, row = _cut(data, offs)
                    np.add.at(prob, row, probabilities(net, x) * held[:, None])
                    prob /= np.maximum(1, np.diff(offs))[:, None]
                best = prob.argmax(1)
                lang, score = [], []
                for i, t in enumerate(texts.slice(begin, rows)):
                    s = t.as_py()
                    told = net is not None and s is not None and has_letter(s.decode("utf-8", "replace"))
                    lang.append(known[best[i]] if told else "und")
                    score.append(min(1.0, float(prob[i, best[i]])) if told else 0.0)
                yield pa.RecordBatch.from_arrays(
                    [*[c.slice(begin, rows) for c in b.columns[first:]],
                     pa.array(lang), pa.array(score, pa.float64())],
                    names=[*b.schema.names[first:], *names])
    return run


def predict(docs: DataFrame, model: tuple | None, id_col: str, text_col: str,
            keep: dict[str, Column] | None = None) -> DataFrame:
    """(id, ``keep`` columns, lang_pred, score) per row."""
    src = docs.select(F.col(text_col).alias("__text"), F.col(id_col), *[c.alias(n) for n, c in (keep or {}).items()])
    return _predicted(src, model, ("lang_pred", "score"), 0, 1)


def with_language(docs: DataFrame, model: tuple | None, text_col: str,
                  names: tuple[str, str] = ("__lang_pred", "__score")) -> DataFrame:
    """All columns of ``docs`` and the answer under ``names``."""
    return _predicted(docs, model, names, docs.columns.index(text_col), 0)


def _predicted(src: DataFrame, model: tuple | None, names: tuple[str, str], text: int, first: int) -> DataFrame:
    """``src`` from column ``first`` on and the answer to column ``text``."""
    schema = ", ".join(f"`{n}` {t}" for n, t in src.dtypes[first:])
    shared = src.sparkSession.sparkContext.broadcast(model)  # its size follows the languages alone
    return src.mapInArrow(_predictor(shared, names, text, first), f"{schema}, `{names[0]}` string, `{names[1]}` double")
