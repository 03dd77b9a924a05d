"""Alignment of two tokenizers over a corpus, each distinct text once.

Rows are shuffled by their full text and counted; every distinct text is
tokenised and aligned once, whatever its number of copies.  Tokens of both sides
are byte ranges of blank + text.  Offsets where tokens of both sides end cut the
ranges into groups, and tokens of one group are linked with each other.  The count
of an id pair is the number of rows whose text holds it linked: a text adds its
multiplicity to each of its distinct pairs.  Measures of a text that need those
counts are joined back to the ids by a digest of the text.

Nothing that may be hot meets in one task.  Copies are added up before the
shuffle.  Pairs with more than 1 / ``HOT_PAIRS`` of the sum of all counts, so fewer
than that many, go to all tasks as arrays; rows of the other pairs are joined by a
shuffle.  Texts with more than 1 / ``HOT_TEXTS`` of the rows, so fewer than that
many, meet their ids by broadcast, the others by a shuffle.

Defined results: null and empty texts, and texts whose tokens of either side do
not spell blank + text (a literal U+2581, for instance), have no tokens: zeros and
an empty digest, and they add to no count.  Special tokens' strings are plain text.
Rows with null or repeated ids are rows of their own, and count; an empty table
gives an empty result; extra columns are ignored.  A text is handled whole and its
memory follows its length.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ioclake.llm.common import written

HOT_PAIRS, HOT_TEXTS = 1 << 20, 1 << 10
#: bytes of text aligned at once; distinct pairs in a row of the aligned table
AT_ONCE, PART = 1 << 18, 1 << 16
#: links of one group that are listed; larger groups go by their distinct ids
LISTED = 1 << 12


@dataclass
class Side:
    """A tokenizer: ids of texts, and the bytes that each id spells."""

    encode: Callable[[list[str]], list[list[int]]]
    spell: list[bytes]


def byte_alphabet() -> dict[str, int]:
    """Characters that stand for bytes in a byte-level vocabulary: printable
    Latin-1 for itself, the other bytes in order from U+0100 on."""
    plain = [b for b in range(256) if chr(b).isprintable() and chr(b) != " " and b != 0xAD]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + n): b for n, b in enumerate(rest)}


#: how a byte-level vocabulary cuts a text before it merges bytes
CUT = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: texts of these characters alone are cut alike by every version of Unicode
STEADY = re.compile(r"[\t\n\r -~\u00a1-\u024f]*")


def byte_level_side(definition: str) -> Side:
    """A byte-level vocabulary from the JSON text of its definition.

    Where ids follow the order of merges, the same definition is also given to
    a faster engine, for texts whose cut cannot depend on the engine's tables of
    characters; it gives the same ids."""
    import tiktoken
    from tokenizers import Tokenizer

    tok = Tokenizer.from_str(definition)
    tok.encode_special_tokens = True
    of = byte_alphabet()
    names = tok.get_vocab(with_added_tokens=True)
    spell = [b""] * (max(names.values()) + 1)
    for name, i in names.items():
        spell[i] = bytes(of[c] for c in name) if all(c in of for c in name) else name.encode()

    made = json.loads(definition)
    merges = [m.split(" ") if isinstance(m, str) else m for m in made["model"]["merges"]]
    cut = made.get("pre_tokenizer") or {}
    plain = cut.get("type") == "ByteLevel" and not cut.get("add_prefix_space") and cut.get("use_regex", True)
    quick = None
    if plain and not made.get("normalizer") and all(names["".join(m)] == 256 + n for n, m in enumerate(merges)):
        ranks = {spell[i]: i for i in range(256 + len(merges))}
        quick = tiktoken.Encoding("definition", pat_str=CUT, mergeable_ranks=ranks, special_tokens={})

    def encode(texts: list[str]) -> list[list[int]]:
        steady = [quick is not None and STEADY.fullmatch(t) is not None for t in texts]
        slow = iter(tok.encode_batch_fast([" " + t for t, s in zip(texts, steady, strict=True) if not s],
                                          add_special_tokens=False))
        return [quick.encode_ordinary(" " + t) if s else next(slow).ids for t, s in zip(texts, steady, strict=True)]

    return Side(encode, spell)


def piece_side(proto: bytes) -> Side:
    """A SentencePiece vocabulary from the bytes of its model file."""
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_proto=proto)
    spell = []
    for i in range(sp.get_piece_size()):
        name = sp.id_to_piece(i)
        spell.append(bytes([int(name[3:5], 16)]) if sp.is_byte(i) else name.replace("▁", " ").encode())

    return Side(lambda texts: sp.encode(texts, out_type=int, num_threads=1), spell)


def decimals(n: int) -> np.ndarray:
    """Decimal digits of 0 .. n - 1, one row each, padded with zero bytes."""
    width = len(str(n - 1))
    left = np.arange(n)
    out = np.zeros((n, width), np.uint8)
    for k in range(width - 1, -1, -1):
        out[:, k] = np.where((left > 0) | (k == width - 1), left % 10 + 48, 0)
        left = left // 10
    return out


@dataclass
class Aligned:
    """Measures per text and its distinct linked pairs, flat with bounds."""

    n_a: np.ndarray
    n_b: np.ndarray
    n_groups: np.ndarray
    n_links: np.ndarray
    digests: list[str]
    pair: np.ndarray
    links: np.ndarray
    bound: np.ndarray


class Aligner:
    def __init__(self, a: Side, b: Side):
        self.a, self.b = a, b
        self.size_a, self.size_b = (np.array([len(x) for x in s.spell], np.int64) for s in (a, b))
        self.digits_a, self.digits_b = decimals(len(a.spell)), decimals(len(b.spell))
        self.base = len(b.spell)  # pair = a id * base + b id

    def _tokens(self, texts: list[str]) -> tuple[list[list[int]], list[list[int]]]:
        """Ids of both sides; none where either does not spell the text."""
        some = [t for t in texts if t]
        found = iter(zip(some, self.a.encode(some), self.b.encode(some), strict=True)) if some else iter(())
        ids_a, ids_b = [], []
        for t in texts:
            x, y = [], []
            if t:
                _, x, y = next(found)
                whole = b" " + t.encode()
                if b"".join(map(self.a.spell.__getitem__, x)) != whole or \
                        b"".join(map(self.b.spell.__getitem__, y)) != whole:
                    x, y = [], []
            ids_a.append(x)
            ids_b.append(y)
        return ids_a, ids_b

    def align(self, texts: list[str]) -> Aligned:
        lists_a, lists_b = self._tokens(texts)
        n_a, n_b = (np.array([len(x) for x in ls], np.int64) for ls in (lists_a, lists_b))
        a, b = (np.array([i for x in ls for i in x], np.int64) for ls in (lists_a, lists_b))
        # all texts of the call lie behind each other as one run of bytes
        end_a, end_b = np.cumsum(self.size_a[a]), np.cumsum(self.size_b[b])
        cut = np.intersect1d(end_a, end_b, assume_unique=True)
        in_a, in_b = np.searchsorted(cut, end_a), np.searchsorted(cut, end_b)
        held_a, held_b = np.bincount(in_a, minlength=len(cut)), np.bincount(in_b, minlength=len(cut))
        from_a, from_b = (np.concatenate(([0], np.cumsum(h))) for h in (held_a, held_b))
        row_a = np.repeat(np.arange(len(texts)), n_a)
        row = row_a[from_a[:-1]] if len(cut) else np.empty(0, np.int64)  # the text of each group
        links = held_a * held_b
        pair, times, bound = self._pairs(len(texts), a, b, row, row_a, in_a, from_a, from_b, held_b, links)
        return Aligned(n_a, n_b, np.bincount(row, minlength=len(texts)),
                       np.bincount(row, links, len(texts)).astype(np.int64) if len(row) else np.zeros(len(texts), np.int64),
                       self._digests(a, b, in_a, in_b, from_a, from_b, n_a, n_b), pair, times, bound)

    def _pairs(self, n, a, b, row, row_a, in_a, from_a, from_b, held_b, links):
        """Distinct linked pairs of each text and how often they are linked."""
        big = links > LISTED
        use = ~big[in_a] if len(in_a) else np.empty(0, bool)
        times = held_b[in_a][use]
        left = np.repeat(a[use], times)
        begin = np.repeat(from_b[in_a][use] - (np.cumsum(times) - times), times)
        right = b[begin + np.arange(len(left))]
        space = len(self.a.spell) * self.base
        key = np.repeat(row_a[use], times) * space + left * self.base + right
        count = np.ones(len(key), np.int64)
        for g in np.flatnonzero(big):
            ua, ca = np.unique(a[from_a[g]:from_a[g + 1]], return_counts=True)
            ub, cb = np.unique(b[from_b[g]:from_b[g + 1]], return_counts=True)
            key = np.concatenate((key, row[g] * space + (ua[:, None] * self.base + ub).ravel()))
            count = np.concatenate((count, (ca[:, None] * cb).ravel()))
        order = np.argsort(key, kind="stable")
        key, count = key[order], count[order]
        first = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1]))) if len(key) else np.empty(0, np.int64)
        total = np.add.reduceat(count, first) if len(first) else count
        key = key[first]
        return key % space, total, np.searchsorted(key, np.arange(n + 1) * space)

    def _digests(self, a, b, in_a, in_b, from_a, from_b, n_a, n_b) -> list[str]:
        """sha256 of ``a1,a2|b1;a3|b2,b3`` per text, '' without tokens."""
        width = max(self.digits_a.shape[1], self.digits_b.shape[1])
        out = np.zeros((len(a) + len(b), width + 1), np.uint8)
        at_a = np.arange(len(a)) + (from_b[in_a] if len(a) else 0)
        at_b = np.arange(len(b)) + (from_a[in_b + 1] if len(b) else 0)
        for ids, at, digits in ((a, at_a, self.digits_a), (b, at_b, self.digits_b)):
            out[at, :digits.shape[1]] = digits[ids]
            out[at, width] = ord(",")
        if len(a):
            out[at_a[from_a[1:] - 1], width] = ord("|")
            out[at_b[from_b[1:] - 1], width] = ord(";")
        rows = np.concatenate(([0], np.cumsum(n_a + n_b)))
        full = rows[1:] > rows[:-1]
        out[rows[1:][full] - 1, width] = 0  # nothing after the last group
        bytes_in = np.concatenate(([0], np.cumsum((out != 0).sum(1))))[rows]
        data = out.ravel()
        data = data[data != 0].tobytes()
        return [hashlib.sha256(data[x:y]).hexdigest() if y > x else "" for x, y in
                zip(bytes_in[:-1], bytes_in[1:], strict=True)]


def _runs(texts: pa.Array) -> Iterator[tuple[int, list[str]]]:
    """(first row, texts) of about AT_ONCE bytes, a longer text alone."""
    held, size, first = [], 0, 0
    for at in range(0, len(texts), 256):
        for n, t in enumerate(texts.slice(at, 256).to_pylist(), at):
            if held and size + len(t) > AT_ONCE:
                yield first, held
                held, size, first = [], 0, n
            held.append(t)
            size += len(t)
    if held:
        yield first, held


def _aligner(shared) -> Aligner:
    """The aligner of this worker, made once from the broadcast files."""
    files = shared.value
    if "aligner" not in files:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        files["aligner"] = Aligner(byte_level_side(files["a"]), piece_side(files["b"]))
    return files["aligner"]


ALIGNED = ("digest binary, copies long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, "
           "pairs array<long>, links array<long>")


def _aligning(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = None
        for batch in batches:
            aligner = aligner or _aligner(shared)
            for first, texts in _runs(batch.column(1)):
                got = aligner.align(texts)
                b = batch.slice(first, len(texts))
                # a text of very many pairs fills several rows, its measures are in the first
                size = np.diff(got.bound)
                parts = np.maximum(1, -(-size // PART))
                row = np.repeat(np.arange(len(texts)), parts)
                nth = np.arange(len(row)) - np.repeat(np.cumsum(parts) - parts, parts)
                offs = np.append(got.bound[:-1][row] + nth * PART, got.bound[-1]).astype(np.int32)
                head = nth == 0

                def measure(values):
                    return pa.array(np.where(head, values[row], 0))

                yield pa.RecordBatch.from_arrays(
                    [b.column(0).take(pa.array(row)), b.column(2).take(pa.array(row)), measure(got.n_a),
                     measure(got.n_b), measure(got.n_groups), measure(got.n_links),
                     pa.array([got.digests[r] if h else None for r, h in zip(row, head, strict=True)], pa.string()),
                     pa.ListArray.from_arrays(pa.array(offs), pa.array(got.pair)),
                     pa.ListArray.from_arrays(pa.array(offs), pa.array(got.links))],
                    names=[part.split()[0] for part in ALIGNED.split(", ")])
    return run


def _weighing(shared):
    """Sums of a row over the pairs at hand; the other pairs as a list."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, count, best = shared.value
        for b in batches:
            if not b.num_rows:
                continue
            pairs, links = b.column("pairs"), b.column("links")
            size = pairs.value_lengths().to_numpy()
            row = np.repeat(np.arange(b.num_rows), size)
            p, n = pairs.flatten().to_numpy(), links.flatten().to_numpy()
            at = np.minimum(np.searchsorted(known, p), max(len(known) - 1, 0))
            hit = known[at] == p if len(known) else np.zeros(len(p), bool)
            sums = np.zeros((2, b.num_rows), np.int64)
            np.add.at(sums[0], row[hit], (n[hit] * count[at[hit]]))
            np.add.at(sums[1], row[hit], (n[hit] * best[at[hit]]))
            offs = pa.array(np.concatenate(([0], np.cumsum(np.bincount(row[~hit], minlength=b.num_rows)))).astype(np.int32))
            yield pa.RecordBatch.from_arrays(
                [b.column("digest"), pa.array(sums[0]), pa.array(sums[1]),
                 pa.ListArray.from_arrays(offs, pa.array(p[~hit])), pa.ListArray.from_arrays(offs, pa.array(n[~hit]))],
                names=["digest", "count_sum", "n_best", "pairs", "links"])
    return run


def _each_pair(rows: DataFrame, *keep: str) -> DataFrame:
    return rows.select(*keep, F.inline(F.arrays_zip("pairs", "links"))).withColumnRenamed("pairs", "pair")


def pair_counts(aligned: DataFrame, base: int) -> DataFrame:
    """(pair, count, best): rows that hold the pair linked, and whether no
    pair of the same A id counts more."""
    counted = written(_each_pair(aligned, "copies").groupBy("pair").agg(F.sum("copies").alias("count")), "pair-counts")
    a_id = F.expr(f"pair div {base}")
    top = counted.groupBy(a_id.alias("a")).agg(F.max("count").alias("top"))
    return written(counted.withColumn("a", a_id).join(top, "a").select(
        "pair", "count", (F.col("count") == F.col("top")).alias("best")), "counts")


def align(docs: DataFrame, byte_level: str, piece: str, id_col: str = "doc_id", text_col: str = "text",
          hot_pairs: int = HOT_PAIRS, hot_texts: int = HOT_TEXTS) -> tuple[DataFrame, DataFrame]:
    """(measures, counts): per row id, n_a, n_b, n_groups, n_links, n_best,
    count_sum and groups_sha256; per linked pair a_id, b_id, count, best.
    ``byte_level`` and ``piece`` are the paths of the vocabulary files."""
    spark = docs.sparkSession
    with open(byte_level, encoding="utf-8") as f, open(piece, "rb") as g:
        files = {"a": f.read(), "b": g.read()}  # two files of fixed size
    spelled_b = _piece_count(files["b"])
    shared = spark.sparkContext.broadcast(files)
    text = F.col(text_col)
    digest = F.unhex(F.sha2(text, 256))
    rows = written(docs.select(F.col(id_col).alias("id"), F.when(text != "", digest).alias("digest")), "rows")
    distinct = docs.select(text.alias("text")).filter(text != "").groupBy("text").agg(
        F.count(F.lit(1)).alias("copies")).select(F.unhex(F.sha2("text", 256)).alias("digest"), "text", "copies")
    aligned = written(distinct.mapInArrow(_aligning(shared), ALIGNED), "aligned")
    counts = pair_counts(aligned, spelled_b)
    most = counts.agg(F.sum("count")).first()[0] or 0
    hot = counts.filter(F.col("count") * hot_pairs > most).toArrow().sort_by("pair")
    weights = spark.sparkContext.broadcast(tuple(
        hot[c].to_numpy().astype(np.int64) for c in ("pair", "count", "best")))

    weighed = written(aligned.select("digest", "pairs", "links").mapInArrow(
        _weighing(weights), "digest binary, count_sum long, n_best long, pairs array<long>, links array<long>"), "weighed")
    rare = _each_pair(weighed.filter(F.size("pairs") > 0), "digest").join(counts, "pair").select(
        "digest", (F.col("links") * F.col("count")).alias("count_sum"),
        F.when(F.col("best"), F.col("links")).otherwise(0).alias("n_best"))
    sums = weighed.select("digest", "count_sum", "n_best").unionByName(rare)
    zero = F.lit(0).cast("long")
    own = ["n_a", "n_b", "n_groups", "n_links"]
    parts = aligned.select("digest", "copies", *own, "groups_sha256", zero.alias("count_sum"), zero.alias("n_best")) \
        .unionByName(sums.select("digest", F.lit(None).cast("long").alias("copies"), *[zero.alias(c) for c in own],
                                 F.lit(None).cast("string").alias("groups_sha256"), "count_sum", "n_best"))
    measures = [*own, "n_best", "count_sum"]
    per_text = written(parts.groupBy("digest").agg(
        F.max("copies").alias("copies"), *[F.sum(c).alias(c) for c in measures],
        F.max("groups_sha256").alias("groups_sha256")), "measures")
    n_rows = per_text.agg(F.sum("copies")).first()[0] or 0
    often = F.col("copies") * hot_texts > n_rows  # fewer than hot_texts of them
    few = F.broadcast(per_text.filter(often).drop("copies").withColumn("near", F.lit(True)))
    met = rows.filter("digest is not null").join(few, "digest", "left")
    rest = met.filter("near is null").select("id", "digest").join(per_text.filter(~often), "digest")
    found = met.filter("near").select("id", *measures, "groups_sha256").unionByName(
        rest.select("id", *measures, "groups_sha256"))
    none = rows.filter("digest is null").select("id", *[zero.alias(c) for c in measures], F.lit(None).alias("groups_sha256"))
    result = found.unionByName(none).select(F.col("id").alias(id_col), *measures,
                                            F.coalesce("groups_sha256", F.lit("")).alias("groups_sha256"))
    return result, counts.select(F.expr(f"pair div {spelled_b}").alias("a_id"), (F.col("pair") % spelled_b).alias("b_id"),
                                 "count", "best")


def _piece_count(proto: bytes) -> int:
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_proto=proto).get_piece_size()

