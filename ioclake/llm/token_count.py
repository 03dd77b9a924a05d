"""Greedy word-piece lengths by a linear longest-match automaton.

A text's words are its runs of non-white-space characters, each opened by the
mark U+2581.  Greedy matching takes the longest vocabulary piece at each
position; a character that starts no piece counts as its UTF-8 bytes.  The
automaton is the trie of the pieces.  Where a node has no transition for the
next character, its failure link leads to the node of what is left after the
pieces that greedy matching would have cut off, and ``popped`` holds how many
tokens those are; so a word is counted in one pass, without building a piece.
Single characters that occur in pieces but are none themselves enter the trie as
pieces that weigh their byte count, so every node has a failure link.

Defined results: null or blank text counts 0 words and 0 tokens; repeated rows
repeat; extra columns are ignored.
"""

from __future__ import annotations

from collections import deque
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MARK = "▁"
REMEMBER, LONG_WORD = 400_000, 64


class Automaton:
    """Lists over nodes: ``go`` (character -> node), ``fail``, ``popped``."""

    def __init__(self, pieces: Iterable[str]):
        go, weight = [{}], [0]

        def add(piece: str, tokens: int) -> None:
            at = 0
            for ch in piece:
                if ch not in go[at]:
                    go[at][ch] = len(go)
                    go.append({})
                    weight.append(0)
                at = go[at][ch]
            weight[at] = weight[at] or tokens

        pieces = [p for p in pieces if p]
        for p in pieces:
            add(p, 1)
        for ch in {c for p in pieces for c in p}:
            add(ch, len(ch.encode()))
        fail, popped = [0] * len(go), [0] * len(go)
        queue = deque([0])
        while queue:
            at = queue.popleft()
            for ch, to in go[at].items():
                queue.append(to)
                if weight[to]:
                    fail[to], popped[to] = 0, weight[to]
                    continue
                z, n = fail[at], popped[at]
                while ch not in go[z]:
                    z, n = fail[z], n + popped[z]
                fail[to], popped[to] = go[z][ch], n
        self.go, self.fail, self.popped = go, fail, popped

    def count(self, word: str) -> int:
        go, fail, popped = self.go, self.fail, self.popped
        at = n = 0
        for ch in word:
            to = go[at].get(ch)
            while to is None and at:
                n += popped[at]
                at = fail[at]
                to = go[at].get(ch)
            if to is None:
                n += len(ch.encode())
            else:
                at = to
        while at:
            n += popped[at]
            at = fail[at]
        return n


class _Counts(dict):
    def __init__(self, auto: Automaton):
        super().__init__()
        self.auto = auto

    def __missing__(self, word: str) -> int:
        n = self.auto.count(MARK + word)
        if len(word) <= LONG_WORD:
            if len(self) >= REMEMBER:
                self.clear()
            self[word] = n
        return n


def _counting(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = _Counts(Automaton(shared.value))
        for b in batches:
            words, tokens, longest = [], [], []
            for t in b.column(1):
                each = [counts[w] for w in (t.as_py() or "").split()]
                words.append(len(each))
                tokens.append(sum(each))
                longest.append(max(each, default=0))
            yield pa.RecordBatch.from_arrays(
                [b.column(0), *[pa.array(x, pa.int64()) for x in (words, tokens, longest)]],
                names=["id", "n_words", "n_tokens", "max_word_tokens"])
    return run


def token_counts(docs: DataFrame, pieces: list[str], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_words, n_tokens, max_word_tokens) per row.  ``pieces`` is the
    vocabulary, a list of fixed size that all tasks get."""
    src = docs.select(F.col(id_col).alias("id"), F.col(text_col))
    shared = docs.sparkSession.sparkContext.broadcast(pieces)
    kind = src.dtypes[0][1]
    return src.mapInArrow(_counting(shared), f"id {kind}, n_words long, n_tokens long, max_word_tokens long") \
        .withColumnRenamed("id", id_col)
