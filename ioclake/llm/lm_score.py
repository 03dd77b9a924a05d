"""Log-likelihood of whole documents under a gated recurrent language model.

Tokens are the words of a text (runs without white space, A-Z folded) and one
end.  All training documents are counted.  The words that are frequent enough
for ``NEURAL`` places have a class each (``CLASSES`` classes of equal size in
order of frequency); the others share one more class, within which a word's
probability is its smoothed count.  The network, a gated recurrent unit with a
softmax over classes and one within the class, predicts every token from the
state that all tokens before it left; the state is carried from window to
window, so a document is scored to its end at constant memory.

Training is truncated backpropagation in numpy.  A first task warms the network
up on a bounded number of documents; then every partition trains on all its
training documents, and the weights are averaged in a tree, weighted by tokens.
So weights, and with them scores, depend on how the table is partitioned: a
partition is one learner, which takes its documents in pools of ``POOL`` tokens,
in ``LANES`` lanes as the pool allows, with a fresh optimiser for each pool.

Counts of the ``HEAD`` most frequent words at most (a bound on what is
broadcast) are known to the tasks; the other words of a document are joined with
the count table, a shuffle on the word in which no word is frequent.

Base score: the sum over tokens of log10((c + 0.1) / (N + 0.1 (V + 1))).

Defined results: null text is empty, an empty text is its end; repeated rows
give the same row again; a null id is not held out and is not learned from;
without training documents every score is that of an untrained network; extra
columns are ignored.
"""

from __future__ import annotations

import heapq
import pickle
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ioclake.llm.bytewords import Words, words
from ioclake.llm.common import written

END = b"\n"  # no word holds white space
ALPHA = 0.1
HEAD, CLASSES, CLASS_SIZE = 131_072, 64, 64
NEURAL = CLASSES * CLASS_SIZE
HIDDEN = 24
WARM_DOCS = 200
#: lanes of a step: from few to many, where that leaves about ``STEPS`` steps
LANES, STEPS, WINDOW, RATE, CLIP = (32, 128), 256, 32, 0.006, 5.0
SCORE_LANES, SCORE_WINDOW, POOL = 256, 32, 1_500_000
FLUSH = 500_000
#: distance of a bound from the largest logit up to which exp keeps its digits; optimiser's block
SAFE, BLOCK, ONE = 80, 65_536, np.float32(1)
R, Z, N = (slice(k * HIDDEN, (k + 1) * HIDDEN) for k in range(3))
SEED = 3


# -------------------------------------------------------------------- network

def initial(counts: np.ndarray, rest: float) -> dict:
    """Weights whose output is the unigram distribution.  ``counts``: of the
    neural words in order; ``rest``: of all other tokens."""
    rng = np.random.default_rng(SEED)
    full = np.full(NEURAL, 1e-3)
    full[:len(counts)] = counts + ALPHA
    per = full.reshape(CLASSES, CLASS_SIZE)
    mass = np.append(per.sum(1), rest + ALPHA)
    net = {"e": rng.normal(0, 0.3, (NEURAL + 1, HIDDEN)), "x": rng.normal(0, 0.3, (HIDDEN, 3 * HIDDEN)),
           "u": rng.normal(0, 0.2, (HIDDEN, 3 * HIDDEN)), "g": np.zeros(3 * HIDDEN),
           "c": np.zeros((HIDDEN, CLASSES + 1)), "cb": np.log(mass / mass.sum()),
           "w": np.zeros((CLASSES, CLASS_SIZE, HIDDEN)), "wb": np.log(per / per.sum(1, keepdims=True))}
    return {k: v.astype(np.float32) for k, v in net.items()}


def _gates(x: np.ndarray, u: np.ndarray, g: np.ndarray) -> np.ndarray:
    """One matrix from (state, embedding, 1) to the sums of the gates: of the
    candidate by embedding, z, r, of the candidate by state."""
    out = np.zeros((4, HIDDEN, 2 * HIDDEN + 1), np.float32)
    for k, at in enumerate((N, Z, R)):
        out[k, :, HIDDEN:-1], out[k, :, -1] = x[:, at].T, g[at]
    for k, at in enumerate((Z, R, N), 1):
        out[k, :, :HIDDEN] = u[:, at].T
    return out.reshape(4 * HIDDEN, -1)


def _inputs(h: np.ndarray, e: np.ndarray, tok: np.ndarray) -> np.ndarray:
    """(steps + 1, (state, embedding, 1), lanes) with the state before the first step."""
    high, n = tok.shape
    out = np.empty((high + 1, 2 * HIDDEN + 1, n), np.float32)
    out[0, :HIDDEN], out[:, -1] = h[:, :n], 1
    out[:-1, HIDDEN:-1] = e.take(tok.ravel(), 0).reshape(high, n, HIDDEN).transpose(0, 2, 1)
    return out


def _steps(weights: np.ndarray, inputs: np.ndarray, fresh: list, gates: np.ndarray, change: np.ndarray) -> None:
    """Runs the cell over the steps of a window, in arrays of (steps, features,
    lanes); the states in ``inputs`` are filled in.  ``fresh``: per step the lanes
    that open a document, or None.  Left for the way back: in ``gates`` the
    candidate, z, r and the candidate's sum by state, in ``change`` the state
    before less the candidate."""
    low = slice(HIDDEN, 3 * HIDDEN)
    weights = weights.copy()
    weights[low] *= -1
    for now, h, new, opens, a, n, zr, z, r, by, d in zip(  # noqa: B905
            inputs, inputs[:, :HIDDEN], inputs[1:, :HIDDEN], fresh, gates, gates[:, :HIDDEN], gates[:, low],
            gates[:, HIDDEN:2 * HIDDEN], gates[:, 2 * HIDDEN:3 * HIDDEN], gates[:, 3 * HIDDEN:], change):
        if opens is not None:
            h[:, opens] = 0
        np.matmul(weights, now, a)
        np.exp(zr, zr)
        np.add(zr, ONE, zr)
        np.reciprocal(zr, zr)
        np.multiply(r, by, d)
        np.add(n, d, n)
        np.tanh(n, n)
        np.subtract(h, n, d)
        np.multiply(z, d, new)
        np.add(new, n, new)


def _cell(g: np.ndarray, h: np.ndarray, u: np.ndarray):
    """One step of rows of lanes, ``g`` what their tokens bring: (new state,)."""
    weights = _gates(np.zeros_like(u), u, np.zeros_like(u[0]))
    out = []
    with np.errstate(over="ignore"):
        for brings, state in zip(g, h, strict=True):
            weights[:3 * HIDDEN, -1] = np.concatenate([brings[N], brings[Z], brings[R]])
            inputs = np.ones((2, 2 * HIDDEN + 1, 1), np.float32)
            inputs[0, :HIDDEN, 0] = state
            _steps(weights, inputs, [None], np.empty((1, 4 * HIDDEN, 1), np.float32), np.empty((1, HIDDEN, 1), np.float32))
            out.append(inputs[1, :HIDDEN, 0])
    return (np.array(out),)


def _sorted(ids: np.ndarray) -> tuple[np.ndarray, list[tuple[int, int, int]]]:
    """(order, [(class, first, end)]) of the neural tokens among ``ids``."""
    cls = (ids // CLASS_SIZE).astype(np.uint8)
    order = np.argsort(cls, kind="stable")
    bound = np.searchsorted(cls[order], np.arange(CLASSES + 1)).tolist()
    return order[:bound[CLASSES]], [(c, x, y) for c, (x, y) in enumerate(zip(bound, bound[1:], strict=False)) if x < y]


def _level(weights: np.ndarray) -> tuple[np.ndarray, bool]:
    """``weights`` (state and, last, bias; outputs) with a bias less by a bound of
    the logits; whether no softmax can vanish by that.  States are within -1 and
    1, so sums of absolute weights bound the logits."""
    bias = weights[..., -1, :]
    reach = np.ones(HIDDEN, np.float32) @ np.abs(weights[..., :-1, :])
    high, low = (bias + reach).max(-1, keepdims=True), (bias - reach).max(-1, keepdims=True)
    out = weights.copy()
    out[..., -1, :] -= high
    return out, bool((high - low).max() < SAFE)


def _exp(x: np.ndarray, safe: bool) -> np.ndarray:
    """exp in place, of rows less their largest where that is needed."""
    if not safe:
        x -= x.max(1, keepdims=True)
    return np.exp(x, x)


def _within(w: np.ndarray, state: np.ndarray, spans: list[tuple[int, int, int]]) -> np.ndarray:
    """Logits within the class of each row of ``state``, rows in order of class."""
    x = np.empty((len(state), CLASS_SIZE), np.float32)
    for c, i, j in spans:
        np.matmul(state[i:j], w[c], x[i:j])
    return x


def _outputs(net: dict) -> tuple[np.ndarray, np.ndarray]:
    """Weights of the softmax over classes and of those within: (state and
    bias, classes) and (class, state and bias, words)."""
    return (np.concatenate([net["c"], net["cb"][None]]),
            np.concatenate([net["w"].transpose(0, 2, 1), net["wb"][:, None]], 1))


def _log_picked(x: np.ndarray, at: np.ndarray, safe: bool) -> np.ndarray:
    """ln of the softmax of each row at its place ``at``."""
    if not safe:
        x -= x.max(1, keepdims=True)
    here = x[np.arange(len(x)), at].astype(np.float64)
    np.exp(x, x)
    return here - np.log(x @ np.ones(x.shape[1], np.float32))


def _log_probs(outputs: tuple, state: np.ndarray, ids: np.ndarray) -> np.ndarray:
    (c, safe_c), (w, safe_w) = outputs
    out = _log_picked(state @ c, ids // CLASS_SIZE, safe_c)
    order, spans = _sorted(ids)
    out[order] += _log_picked(_within(w, state[order], spans), ids[order] % CLASS_SIZE, safe_w)
    return out


def _levels(net: dict) -> tuple:
    c, w = _outputs(net)
    return _level(c), _level(w)


def log_probs(net: dict, h: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """ln P of each token (of the class alone for tokens of the last class)."""
    return _log_probs(_levels(net), np.hstack([h, np.ones((len(h), 1), np.float32)]), ids)


def lanes(docs: list[np.ndarray], many: int) -> list[list[int]]:
    """Documents laid end to end in up to ``many`` lanes of about equal
    length, longest lane first: per lane the places of its documents."""
    size = [len(d) for d in docs]
    heap = [(0, i) for i in range(min(many, len(docs)))]
    held: list[list[int]] = [[] for _ in heap]
    for d in sorted(range(len(docs)), key=lambda d: (-size[d], d)):
        n, i = heapq.heappop(heap)
        held[i].append(d)
        heapq.heappush(heap, (n + size[d], i))
    return sorted(held, key=lambda ds: -sum(size[d] for d in ds))


def windows(docs: list[np.ndarray], many: int, steps: int):
    """Per window: tokens and documents (steps, lanes; NEURAL and -1 where a lane
    is over) and per step the lanes that open a document, or None."""
    held = lanes(docs, many)
    inorder = [d for ds in held for d in ds]
    size = np.array([len(docs[d]) for d in inorder], np.int64)
    # the end stands for all places where a lane is over
    toks = np.concatenate([*(docs[d] for d in inorder), [NEURAL]]).astype(np.int16)
    owner = np.append(np.repeat(np.array(inorder, np.int32), size), np.int32(-1))
    opens = np.zeros(len(toks), bool)
    opens[np.cumsum(size) - size] = True
    length = np.array([sum(len(docs[d]) for d in ds) for ds in held], np.int64)
    first = np.cumsum(length) - length
    for at in range(0, int(length[0]) if len(length) else 0, steps):
        n = int((length > at).sum())
        step = at + np.arange(min(steps, int(length[0]) - at))[:, None]
        place = np.where(step < length[:n], first[:n] + step, len(toks) - 1)
        fresh = opens[place]
        yield toks[place], owner[place], [x.nonzero()[0] if y else None for x, y in zip(fresh, fresh.any(1), strict=True)]


def _rows(states: np.ndarray) -> np.ndarray:
    """(steps, features, lanes) as rows of one per step and lane, with a one for the bias."""
    high, size, n = states.shape
    out = np.ones((high, n, size + 1), np.float32)
    out[:, :, :size] = states.transpose(0, 2, 1)
    return out.reshape(high * n, size + 1)


def score_documents(net: dict, docs: list[np.ndarray], many: int = SCORE_LANES) -> np.ndarray:
    """ln P of every document's neural tokens and classes."""
    out = np.zeros(len(docs))
    weights, outputs = _gates(net["x"], net["u"], net["g"]), _levels(net)
    h = np.zeros((HIDDEN, min(many, len(docs))), np.float32)
    with np.errstate(over="ignore"):
        for tok, own, fresh in windows(docs, many, SCORE_WINDOW):
            inputs = _inputs(h, net["e"], tok)
            n = tok.shape[1]
            # nothing goes back: all steps have the same place for their gates
            held = np.empty((5 * HIDDEN, n), np.float32)
            same = np.lib.stride_tricks.as_strided(held, (len(tok), *held.shape), (0, *held.strides))
            _steps(weights, inputs, fresh, same[:, :4 * HIDDEN], same[:, 4 * HIDDEN:])
            h = inputs[-1, :HIDDEN]
            real = np.flatnonzero(own.ravel() >= 0)
            state, ids, own = _rows(inputs[:-1, :HIDDEN]), tok.ravel(), own.ravel()
            if len(real) < len(ids):
                state, ids, own = state[real], ids[real], own[real]
            out += np.bincount(own, _log_probs(outputs, state, ids), len(docs))
    return out


def _views(flat: np.ndarray, like: dict) -> dict:
    """Arrays in the shapes of ``like``, one after the other in ``flat``."""
    ends = np.cumsum([v.size for v in like.values()])
    return {k: flat[e - v.size:e].reshape(v.shape) for (k, v), e in zip(like.items(), ends, strict=True)}


def _adam(at: np.ndarray, g: np.ndarray, m1: np.ndarray, m2: np.ndarray, step: int) -> None:
    """One step of the optimiser (decays 0.9 and 0.99) in place; the moments are
    kept as sums, not means, and ``g`` is used up."""
    size = float(np.sqrt(np.dot(g, g)))
    if size > CLIP:
        g *= np.float32(CLIP / size)
    root = np.sqrt(0.01 / (1 - 0.99**step))
    rate, least = np.float32(RATE * 0.1 / (1 - 0.9**step) / root), np.float32(1e-6 / root)
    held = np.empty(min(len(g), BLOCK), np.float32)
    for i in range(0, len(g), BLOCK):
        x, y, z, p = g[i:i + BLOCK], m1[i:i + BLOCK], m2[i:i + BLOCK], at[i:i + BLOCK]
        t = held[:len(x)]
        y *= np.float32(0.9)
        y += x
        x *= x
        z *= np.float32(0.99)
        z += x
        np.sqrt(z, t)
        t += least
        np.divide(y, t, t)
        t *= rate
        p -= t


def train(net: dict, docs: list[np.ndarray]) -> tuple[dict, int]:
    """Truncated backpropagation over the documents, once; (weights, tokens)."""
    c, w = _outputs(net)
    mine = {"e": net["e"], "x": net["x"], "u": net["u"], "g": net["g"], "c": c, "w": w}
    flat = np.concatenate([v.ravel() for v in mine.values()])
    m1, m2, slope = np.zeros((3, len(flat)), np.float32)
    mine, grad = _views(flat, mine), _views(slope, mine)
    many = int(np.clip(sum(map(len, docs)) // (WINDOW * STEPS), *LANES))
    h = np.zeros((HIDDEN, min(many, len(docs))), np.float32)
    places = np.arange(HIDDEN)
    step = seen = 0
    with np.errstate(over="ignore"):
        for tok, own, fresh in windows(docs, many, WINDOW):
            high, wide = tok.shape
            ids, step = tok.ravel(), step + 1
            real = own.ravel() >= 0
            many_real = int(real.sum())
            weights, inputs = _gates(mine["x"], mine["u"], mine["g"]), _inputs(h, mine["e"], tok)
            gates = np.empty((high, 4 * HIDDEN, wide), np.float32)
            change = np.empty((high, HIDDEN, wide), np.float32)
            _steps(weights, inputs, fresh, gates, change)
            h = inputs[-1, :HIDDEN]

            slope.fill(0)
            state, scale = _rows(inputs[:-1, :HIDDEN]), np.float32(1 / many_real)
            (cc, safe_c), (ww, safe_w) = _level(mine["c"]), _level(mine["w"])
            d = _exp(state @ cc, safe_c)
            d *= (real * scale / (d @ np.ones(d.shape[1], np.float32)))[:, None].astype(np.float32)
            d[np.arange(len(ids)), ids // CLASS_SIZE] -= real * scale
            np.matmul(state.T, d, grad["c"])
            back = d @ mine["c"][:-1].T
            order, spans = _sorted(ids)
            some = state[order]
            d = _exp(_within(ww, some, spans), safe_w)
            d *= (scale / (d @ np.ones(CLASS_SIZE, np.float32)))[:, None]
            d[np.arange(len(order)), ids[order] % CLASS_SIZE] -= scale
            more = np.empty((len(order), HIDDEN), np.float32)
            for k, i, j in spans:
                np.matmul(some[i:j].T, d[i:j], grad["w"][k])
                np.matmul(d[i:j], mine["w"][k, :-1].T, more[i:j])
            back[order] += more
            direct = np.ascontiguousarray(back.reshape(high, wide, HIDDEN).transpose(0, 2, 1))

            # slopes of a step by the rows of ``weights``; their factors but for those of the state and the candidate
            by = np.empty((high, 4, HIDDEN, wide), np.float32)
            factor = np.empty_like(by)
            gn, gz, gr, gs = gates.reshape(by.shape).swapaxes(0, 1)
            keep = ONE - gz
            np.multiply(gn, gn, factor[:, 0])
            np.subtract(ONE, factor[:, 0], factor[:, 0])
            factor[:, 0] *= keep
            np.multiply(change, gz, factor[:, 1])
            factor[:, 1] *= keep
            np.subtract(ONE, gr, factor[:, 2])
            factor[:, 2] *= gr
            factor[:, 2] *= gs
            factor[:, 3] = gr
            flow, u = by.reshape(gates.shape), np.ascontiguousarray(weights[HIDDEN:, :HIDDEN].T)
            dh, dm = np.zeros((2, HIDDEN, wide), np.float32)
            for s, a, rest, f, last, down, z, more, opens in reversed(list(zip(
                    by[:, :2], by[:, 0], by[:, 2:], factor[:, :2], factor[:, 2:], flow[:, HIDDEN:], gz, direct, fresh,
                    strict=True))):
                np.multiply(dh, f, s)
                np.multiply(a, last, rest)
                np.matmul(u, down, dm)
                np.multiply(dh, z, dh)
                np.add(dh, dm, dh)
                np.add(dh, more, dh)
                if opens is not None:
                    dh[:, opens] = 0
            dw = np.matmul(flow, inputs[:-1].transpose(0, 2, 1)).sum(0).reshape(4, HIDDEN, -1)
            for k, at in enumerate((N, Z, R)):
                grad["x"][:, at], grad["g"][at] = dw[k, :, HIDDEN:-1].T, dw[k, :, -1]
            for k, at in enumerate((Z, R, N), 1):
                grad["u"][:, at] = dw[k, :, :HIDDEN].T
            np.add.at(grad["e"].reshape(-1), (ids[:, None].astype(np.intp) * HIDDEN + places).ravel(), np.matmul(
                flow[:, :3 * HIDDEN].transpose(0, 2, 1), weights[:3 * HIDDEN, HIDDEN:-1]).ravel())
            _adam(flat, slope, m1, m2, step)
            seen += many_real
    return {"e": mine["e"], "x": mine["x"], "u": mine["u"], "g": mine["g"], "c": mine["c"][:-1], "cb": mine["c"][-1],
            "w": mine["w"][:, :-1].transpose(0, 2, 1), "wb": mine["w"][:, -1]}, seen


# ----------------------------------------------------------------- vocabulary

class HashTable:
    """Places of 64-bit hashes, looked up by open addressing."""

    def __init__(self, hashes: np.ndarray):
        self.mask = np.uint64((1 << max(4, int(2 * len(hashes) - 1).bit_length() + 1)) - 1)
        self.key = np.zeros(int(self.mask) + 1, np.uint64)
        self.place = np.full(int(self.mask) + 1, -1, np.int32)
        left, probe = np.arange(len(hashes)), np.uint64(0)
        while len(left):
            at = ((hashes[left] + probe) & self.mask).astype(np.int64)
            free = self.place[at] < 0
            first = np.unique(at[free], return_index=True)[1]
            won = np.flatnonzero(free)[first]
            self.place[at[won]], self.key[at[won]] = left[won], hashes[left[won]]
            left = np.delete(left, won)
            probe += np.uint64(1)

    def find(self, hashes: np.ndarray) -> np.ndarray:
        """Places, -1 for an unknown hash."""
        out = np.full(len(hashes), -1, np.int32)
        left, probe = np.arange(len(hashes)), np.uint64(0)
        while len(left):
            at = ((hashes[left] + probe) & self.mask).astype(np.int64)
            place, same = self.place[at], self.key[at] == hashes[left]
            hit = (place >= 0) & same
            out[left[hit]] = place[hit]
            left = left[(place >= 0) & ~same]
            probe += np.uint64(1)
        return out


def hashed(table: list[tuple[bytes, int]]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes and counts of words, found once for all tasks."""
    joined = pa.array([b" ".join(w for w, _ in table)], pa.binary())
    return (next(words(joined, 1 << 62)).hash if table else np.empty(0, np.uint64),
            np.array([c for _, c in table], np.float64))


class Head:
    """The frequent words: their counts, and which of them are neural."""

    def __init__(self, hashes: np.ndarray, counts: np.ndarray, end_count: int):
        self.table = HashTable(hashes)
        self.log = np.log10(counts + ALPHA)
        self.end_count, self.end_id = end_count, 0

    def ids(self, place: np.ndarray) -> np.ndarray:
        """Network ids: 0 is the end, then the neural words, NEURAL the rest."""
        return np.where((place >= 0) & (place < NEURAL - 1), place + 1, NEURAL)


def _documents(w: Words, place: np.ndarray, head: Head) -> list[np.ndarray]:
    ids = head.ids(place).astype(np.int16)
    return [np.append(ids[a:b], np.int16(head.end_id)) for a, b in zip(w.bound[:-1], w.bound[1:], strict=True)]


# --------------------------------------------------------------- task bodies

def _distinct(h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(order, places in it where another value begins) of the hashes in order."""
    order = np.argsort(h)
    inorder = h[order]
    new = np.ones(len(h), bool)
    np.not_equal(inorder[1:], inorder[:-1], new[1:])
    return order, np.flatnonzero(new)


def _counting(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Partial counts (word, n), merged over about FLUSH distinct words."""
    held, distinct, texts = [], 0, 0

    def merged() -> pa.RecordBatch:
        order, new = _distinct(np.concatenate([x[0] for x in held]))
        n = np.concatenate([x[1] for x in held])[order]
        strings = pa.concat_arrays([x[2] for x in held]).take(pa.array(order[new]))
        return pa.RecordBatch.from_arrays([strings, pa.array(np.add.reduceat(n, new))], names=["word", "n"])

    for b in batches:
        texts += b.num_rows
        for w in words(b.column(0)):
            if not len(w.hash):
                continue
            order, new = _distinct(w.hash)
            first = order[new]
            held.append((w.hash[first], np.diff(new, append=len(order)), w.strings(first)))
            distinct += len(first)
            if distinct >= FLUSH:
                yield merged()
                held, distinct = [], 0
    if held:
        yield merged()
    if texts:
        yield pa.RecordBatch.from_pydict({"word": pa.array([END], pa.binary()), "n": [texts]})


def _training(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        *head, net = shared.value
        head, docs, size = Head(*head), [], 0
        total, weights = 0, None

        def learn(docs):
            nonlocal total, weights, net
            net, n = train(net, docs)
            total, weights = total + n, net

        for b in batches:
            for w in words(b.column(0)):
                docs += _documents(w, head.table.find(w.hash), head)
                size += len(w.hash)
                if size >= POOL:
                    learn(docs)
                    docs, size = [], 0
        if docs:
            learn(docs)
        if total:
            yield pa.RecordBatch.from_pydict({"net": [pickle.dumps(weights)], "n": [total]})
    return run


def _scoring(shared):
    names = ["id", "h", "held_out", "n_tokens", "n_rest", "n_known", "base", "score", "tail", "times"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        *head, net = shared.value
        head = Head(*head)
        end_log = np.log10(head.end_count + ALPHA)
        held: list[tuple] = []
        docs: list[np.ndarray] = []
        size = 0

        def scored() -> Iterator[pa.RecordBatch]:
            lp = score_documents(net, docs) / np.log(10)
            at = 0
            for cols, more in held:
                n = len(cols[0])
                rest_log = more.pop("rest_log")
                yield pa.RecordBatch.from_arrays(
                    [*cols, *[pa.array(more[k]) for k in ("n_tokens", "n_rest", "n_known", "base")],
                     pa.array(lp[at:at + n] + rest_log), more["tail"], more["times"]], names=names)
                at += n

        for b in batches:
            for w in words(b.column(3)):
                place = head.table.find(w.hash)
                docs += _documents(w, place, head)
                row = np.repeat(np.arange(w.rows), np.diff(w.bound))
                log = np.where(place >= 0, head.log[place] if len(head.log) else 0.0, 0.0)
                rest = head.ids(place) == NEURAL
                count = lambda x, k=None, row=row, rows=w.rows: np.bincount(row[x], k, rows)
                # words beyond the head, once per document with their number
                out = np.flatnonzero(place < 0)
                order = out[np.lexsort((w.hash[out], row[out]))]
                new = np.ones(len(order), bool)
                new[1:] = (w.hash[order][1:] != w.hash[order][:-1]) | (row[order][1:] != row[order][:-1])
                times = np.diff(np.append(np.flatnonzero(new), len(order)))
                offs = np.searchsorted(row[order][new], np.arange(w.rows + 1)).astype(np.int32)
                held.append(([b.column(i).slice(w.first, w.rows) for i in range(3)], {
                    "n_tokens": np.diff(w.bound).astype(np.int64) + 1,
                    "n_rest": count(rest).astype(np.int64),
                    "n_known": count(place >= 0).astype(np.int64) + int(head.end_count > 0),
                    "base": count(slice(None), log) + end_log,
                    "rest_log": count(rest, log[rest]),
                    "tail": pa.ListArray.from_arrays(pa.array(offs), w.strings(order[new])),
                    "times": pa.ListArray.from_arrays(pa.array(offs), pa.array(times.astype(np.int32)))}))
                size += len(w.hash)
                if size >= POOL:
                    yield from scored()
                    held, docs, size = [], [], 0
        if held:
            yield from scored()
    return run


# -------------------------------------------------------------------- Spark

def word_counts(texts: DataFrame) -> DataFrame:
    """(word, c) over all rows of the one binary column, ends included."""
    return texts.mapInArrow(_counting, "word binary, n long").groupBy("word").agg(F.sum("n").alias("c"))


def frequent(counts: DataFrame, most: int) -> DataFrame:
    """The words from the lowest count on that at most ``most`` words have."""
    step = F.floor(F.log("c") * 16)
    groups = counts.groupBy(step.alias("s")).agg(F.count(F.lit(1)).alias("n"), F.min("c").alias("low")) \
        .orderBy(F.desc("s")).collect()  # a few hundred rows at any size
    total, low = 0, None
    for g in groups:
        total += g.n
        if total > most:
            break
        low = g.low
    return counts.filter(F.col("c") >= low) if low is not None else counts.filter("false")


def fitted(learn: DataFrame, shared: tuple) -> tuple[dict, int]:
    """(weights, tokens learned from) after a pass over all texts of ``learn``;
    ``shared``: the frequent words, the number of ends and the weights so far."""
    table, ends, net = shared
    parts = learn.select("text").mapInArrow(
        _training(learn.sparkSession.sparkContext.broadcast((*hashed(table), ends, net))), "net binary, n long")
    added, n = parts.rdd.map(_weighted).treeAggregate((None, 0), _add, _add, 3)
    return ({k: (v / n).astype(np.float32) for k, v in added.items()}, n) if n else (net, 0)


def score(docs: DataFrame, id_col: str, text_col: str, fold: Column) -> DataFrame:
    """(id, held_out, n_tokens, n_known, train_tokens, base_score, score) per
    row; ``fold`` is 0 for rows that are not learned from."""
    spark = docs.sparkSession
    src = docs.select(F.col(id_col).alias("id"), F.xxhash64(text_col).alias("h"), fold.alias("fold"),
                      F.coalesce(F.col(text_col).cast("binary"), F.lit(b"")).alias("text"))
    learn = src.filter("fold <> 0")
    counts = written(word_counts(learn.select("text")), "counts")
    all_n, all_v = counts.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count(F.lit(1))).first()
    ends = counts.filter(F.col("word") == F.lit(END)).first()
    end_count = ends.c if ends else 0
    table = sorted(((bytes(r.word), r.c) for r in frequent(counts.filter(F.col("word") != F.lit(END)), HEAD).collect()),
                   key=lambda r: (-r[1], r[0]))
    neural = [end_count, *(c for _, c in table[:NEURAL - 1])]
    rest_n, rest_v = all_n - sum(neural), all_v - len(neural) + (not ends)
    rest_norm = float(np.log10(rest_n + ALPHA * (rest_v + 1)))
    base_norm = float(np.log10(all_n + ALPHA * (all_v + 1)))

    net = initial(np.array(neural, float), float(rest_n))
    sc = spark.sparkContext
    warm = learn.orderBy(F.xxhash64(F.lit("train"), "id", "text"), "h").limit(WARM_DOCS).select("text").coalesce(1) \
        .mapInArrow(_training(sc.broadcast((*hashed(table), end_count, net))), "net binary, n long").first()
    if warm:
        net = pickle.loads(warm.net)
    net = fitted(learn, (table, end_count, net))[0]

    kind = src.dtypes[0][1]
    rows = src.select("id", "h", F.coalesce(F.col("fold") == 0, F.lit(False)).alias("held_out"), "text").mapInArrow(
        _scoring(sc.broadcast((*hashed(table), end_count, net))),
        f"id {kind}, h long, held_out boolean, n_tokens long, n_rest long, n_known long, base double, score double, "
        "tail array<binary>, times array<int>")
    facts = {"held_out": "boolean", "n_tokens": "bigint", "n_rest": "bigint", "n_known": "bigint", "base": "double",
             "score": "double"}
    # one entry per word beyond the head, and one that stands for the row; it joins nothing
    own = F.struct(F.concat(F.lit(END), F.col("h").cast("string").cast("binary")).alias("word"),
                   F.lit(0).alias("times"), *facts)
    tail = F.transform(F.arrays_zip("tail", "times"), lambda x: F.struct(
        x.tail.alias("word"), x.times.alias("times"), *[F.lit(None).cast(t).alias(k) for k, t in facts.items()]))
    flat = rows.select("id", "h", F.inline(F.concat(F.array(own), tail)))
    known = flat.join(counts, "word", "left")
    # copies of a row have the same facts; a struct of them would have to be sorted for
    per = known.groupBy("id", "h").agg(
        F.count("n_tokens").alias("copies"), *[F.max(k).alias(k) for k in facts],
        F.sum(F.when(F.col("c").isNotNull(), F.col("times")).otherwise(0)).alias("known"),
        F.sum(F.col("times") * F.log10(F.coalesce("c", F.lit(0)) + ALPHA)).alias("log"))
    log = F.col("log") / F.col("copies")
    return per.select(
        F.col("id").alias(id_col), "held_out", "n_tokens",
        (F.col("n_known") + (F.col("known") / F.col("copies")).cast("long")).alias("n_known"),
        F.lit(all_n).cast("long").alias("train_tokens"),
        (F.col("base") + log - F.col("n_tokens") * base_norm).alias("base_score"),
        (F.col("score") + log - F.col("n_rest") * rest_norm).alias("score"),
        F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))).alias("copy")).drop("copy")


def _weighted(row) -> tuple[dict, int]:
    return {k: v.astype(np.float64) * row.n for k, v in pickle.loads(row.net).items()}, row.n


def _add(a: tuple, b: tuple) -> tuple:
    if a[0] is None or b[0] is None:
        return b if a[0] is None else a
    return {k: v + b[0][k] for k, v in a[0].items()}, a[1] + b[1]
