"""SentencePiece encoding and decoding by a shared-prefix Viterbi search.

Spaces become the mark U+2581 and one mark opens the text, so a text is a
sequence of marked words and no piece spans two of them.  The distinct marked
words of a batch are sorted, which makes them a depth-first walk of their trie:
each word keeps the forward scores and the open piece-trie nodes of the prefix
it shares with the word before, and computes only what is new.

Scores are the log-probabilities of the vocabulary.  A vocabulary that stores
merge ranks instead (scores are minus the rank) gets Zipf's law over the ranks:
log p = -log(1 + rank) - log(sum of 1 / (1 + rank)).  A character without a
piece is written as its UTF-8 byte pieces, at ``UNKNOWN`` below the lowest score;
so is a literal U+2581.  Equal scores prefer the longer last piece.

Defined results: a null text has null pieces and decodes to null, an empty text
has none and decodes to the empty text; decoding gives the very text back for any
text; repeated rows repeat; extra columns are ignored.  The vocabulary file is a
parameter of fixed size and is sent to all tasks.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
# LITERAL stands for a mark in the text itself, CUT lies between words
MARK, LITERAL, CUT = "▁", "\ud800", "\ud801"
UNKNOWN = 10.0
#: distinct words a task remembers before it starts afresh; texts encoded at once
REMEMBER, AT_ONCE = 250_000, 512
#: a longer word is not remembered
LONG_WORD = 64


@dataclass
class Vocabulary:
    names: list[str]
    scores: list[float]
    bytes_at: int  # id of the piece of byte 0
    special: set[int]

    def usable(self) -> Iterator[tuple[int, str, float]]:
        for i, (name, score) in enumerate(zip(self.names, self.scores, strict=True)):
            if i not in self.special:
                yield i, name, score


def load(path: str = MODEL, scores: str = "auto") -> Vocabulary:
    """Pieces of a SentencePiece model file.  ``scores``: "stored", "zipf",
    or "auto" (zipf where the stored ones are whole numbers)."""
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    n = sp.get_piece_size()
    kept = [sp.get_score(i) for i in range(n)]
    special = {i for i in range(n) if sp.is_byte(i) or sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i)}
    if scores == "zipf" or scores == "auto" and all(float(s).is_integer() for s in kept):
        total = math.log(sum(1 / (1 - s) for i, s in enumerate(kept) if i not in special))
        kept = [-math.log(1 - s) - total for s in kept]
    return Vocabulary([sp.id_to_piece(i) for i in range(n)], kept,
                      next(i for i in range(n) if sp.is_byte(i)), special)


def marked_words(text: str, breaks: str = "") -> list[str]:
    """The text as marked words; joined they are the marked text.  Characters
    of ``breaks``, which are in no piece, are words of their own."""
    if not text:
        return []
    text = MARK + text.replace(MARK, LITERAL).replace(" ", CUT + MARK)
    for ch in breaks:
        text = text.replace(ch, CUT + ch + CUT)
    words = text.split(CUT)
    if text[-1] != MARK and MARK + CUT not in text:
        return words
    out, run = [], ""
    for w in words:  # a lone mark goes before the next word
        if w == MARK:
            run += MARK
        elif run and w[:1] != MARK:
            out += [run, w]
            run = ""
        else:
            out.append(run + w)
            run = ""
    return [*out, run] if run else out


class Encoder:
    def __init__(self, vocab: Vocabulary):
        self.root: dict = {}
        for i, name, score in vocab.usable():
            node = self.root
            for ch in name:
                node = node.setdefault(ch, {})
            node[""] = (score, i)
        self.floor = min(s for _, _, s in vocab.usable()) - UNKNOWN
        self.bytes_at = vocab.bytes_at
        alphabet = set().union(*(name for _, name, _ in vocab.usable()))
        self.breaks = "".join(c for c in "\n\r\t" if c not in alphabet)
        self.seen: dict[str, bytes] = {}

    def _spell(self, ch: str) -> list[int]:
        return [self.bytes_at + x for x in (MARK if ch == LITERAL else ch).encode()]

    def walk(self, ordered: list[str]) -> Iterator[tuple[str, list[int]]]:
        """Best pieces of each word of a sorted list."""
        root, floor, last = self.root, self.floor, ""
        # per prefix: best score, its last step, open trie nodes with their start
        best, back, open_ = [0.0], [None], [[]]
        for word in ordered:
            n = 0
            for x, y in zip(word, last):
                if x != y:
                    break
                n += 1
            del best[n + 1:], back[n + 1:], open_[n + 1:]
            alive = open_[n]
            for i in range(n, len(word)):
                ch, top, via, going = word[i], -math.inf, None, []
                for node, j in alive:
                    if ch in node:
                        child = node[ch]
                        going.append((child, j))
                        if "" in child:
                            end = child[""]
                            score = best[j] + end[0]
                            if score > top:
                                top, via = score, (j, end[1])
                child = root.get(ch)
                if child is not None:
                    going.append((child, i))
                if child is not None and "" in child:
                    end = child[""]
                    if best[i] + end[0] > top:
                        top, via = best[i] + end[0], (i, end[1])
                elif best[i] + floor > top:
                    top, via = best[i] + floor, (i, -1)
                best.append(top)
                back.append(via)
                open_.append(going)
                alive = going
            ids, at = [], len(word)
            while at:
                j, piece = back[at]
                if piece >= 0:
                    ids.append(piece)
                else:
                    ids += self._spell(word[j])[::-1]
                at = j
            yield word, ids[::-1]
            last = word

    def encode(self, texts: list[str | None]) -> list[np.ndarray | None]:
        split = [None if t is None else marked_words(t, self.breaks) for t in texts]
        if len(self.seen) > REMEMBER:
            self.seen = {}
        held = [None if w is None else list(map(self.seen.get, w)) for w in split]
        new = {w for ws, ids in zip(split, held, strict=True) if ids and None in ids
               for w, x in zip(ws, ids, strict=True) if x is None}
        fresh = {w: np.array(ids, np.int32).tobytes() for w, ids in self.walk(sorted(new))}
        self.seen.update((w, ids) for w, ids in fresh.items() if len(w) <= LONG_WORD)
        out = []
        for ws, ids in zip(split, held, strict=True):
            if ids and None in ids:
                ids = [fresh[w] if x is None else x for w, x in zip(ws, ids, strict=True)]
            out.append(None if ids is None else np.frombuffer(b"".join(ids), np.int32))
        return out


def spellings(vocab: Vocabulary) -> list[bytes]:
    """Bytes of each piece; special pieces other than bytes have none."""
    out = [b"" if i in vocab.special else n.replace(MARK, " ").encode() for i, n in enumerate(vocab.names)]
    out[vocab.bytes_at:vocab.bytes_at + 256] = [bytes([x]) for x in range(256)]
    return out


class Speller:
    """Texts of lists of pieces: the bytes of all pieces of a batch are
    gathered at once."""

    def __init__(self, vocab: Vocabulary):
        spell = spellings(vocab)
        self.size = np.array([len(x) for x in spell], np.int64)
        self.start = np.concatenate(([0], np.cumsum(self.size)[:-1]))
        self.data = np.frombuffer(b"".join(spell), np.uint8)

    def texts(self, lists: pa.ListArray) -> list[str | None]:
        rows = np.array([0 if n is None else n for n in lists.value_lengths().to_pylist()], np.int64)
        ids = lists.flatten().to_numpy()
        size = self.size[ids]
        end = np.cumsum(size)
        at = np.arange(end[-1] if len(end) else 0) + np.repeat(self.start[ids] - (end - size), size)
        data = self.data[at].tobytes()
        bound = np.concatenate(([0], end))[np.concatenate(([0], np.cumsum(rows)))]
        # the mark that opened the text is its first byte
        return [data[x + 1:y].decode("utf-8", "replace") if v.is_valid else None
                for v, x, y in zip(lists, bound[:-1], bound[1:], strict=True)]


def _lists(rows: list[np.ndarray | None]) -> pa.Array:
    full = [r for r in rows if r is not None]
    offs = np.zeros(len(rows) + 1, np.int32)
    np.cumsum([0 if r is None else len(r) for r in rows], out=offs[1:])
    flat = np.concatenate(full) if full else np.empty(0, np.int32)
    return pa.ListArray.from_arrays(pa.array(offs), pa.array(flat),
                                    mask=pa.array([r is None for r in rows]))


def _encoding(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = Encoder(Vocabulary(**shared.value))
        for b in batches:
            for at in range(0, b.num_rows, AT_ONCE):
                part = b.slice(at, AT_ONCE)
                rows = enc.encode(part.column(0).to_pylist())
                yield pa.RecordBatch.from_arrays([*part.columns[1:], _lists(rows)],
                                                 names=[*part.schema.names[1:], "pieces"])
    return run


def _decoding(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        spell = Speller(Vocabulary(**shared.value))
        for b in batches:
            for at in range(0, b.num_rows, AT_ONCE):
                part = b.slice(at, AT_ONCE)
                texts = spell.texts(part.column(0))
                yield pa.RecordBatch.from_arrays([*part.columns[1:], pa.array(texts, pa.string())],
                                                 names=[*part.schema.names[1:], "text"])
    return run


def _checking(shared):
    """Encodes and decodes again in one worker, which holds one vocabulary."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocab = Vocabulary(**shared.value)
        enc, spell = Encoder(vocab), Speller(vocab)
        for b in batches:
            for at in range(0, b.num_rows, AT_ONCE):
                part = b.slice(at, AT_ONCE)
                texts = part.column(0).to_pylist()
                made = _lists(enc.encode(texts))
                same = [x == y for x, y in zip(texts, spell.texts(made), strict=True)]
                yield pa.RecordBatch.from_arrays([*part.columns[1:], made, pa.array(same)],
                                                 names=[*part.schema.names[1:], "pieces", "round_trip"])
    return run


def _mapped(df: DataFrame, first: Column, keep: dict[str, Column], task, vocab: Vocabulary, made: str) -> DataFrame:
    src = df.select(first.alias("__in"), *[c.alias(n) for n, c in keep.items()])
    schema = ", ".join([*(f"`{n}` {t}" for n, t in src.dtypes[1:]), made])
    return src.mapInArrow(task(df.sparkSession.sparkContext.broadcast(vars(vocab))), schema)


def encode(df: DataFrame, vocab: Vocabulary, keep: dict[str, Column], text_col: str = "text") -> DataFrame:
    """``keep`` columns and pieces array<int>."""
    return _mapped(df, F.col(text_col), keep, _encoding, vocab, "pieces array<int>")


def decode(df: DataFrame, vocab: Vocabulary, keep: dict[str, Column], pieces_col: str = "pieces") -> DataFrame:
    """``keep`` columns and the text that the pieces spell."""
    return _mapped(df, F.col(pieces_col), keep, _decoding, vocab, "text string")


def round_trip(docs: DataFrame, vocab: Vocabulary, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_pieces, pieces, round_trip): every text encoded, decoded from
    its pieces, and held against the original."""
    both = _mapped(docs, F.col(text_col), {"id": F.col(id_col)}, _checking, vocab,
                   "pieces array<int>, round_trip boolean")
    return both.select(F.col("id").alias(id_col), F.coalesce(F.size("pieces"), F.lit(0)).cast("long").alias("n_pieces"),
                       "pieces", "round_trip")
