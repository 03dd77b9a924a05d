"""Chunks of a bounded number of byte-pair tokens (H8).

A text is encoded once, whole, with the merge ranks of a vocabulary file, and its
token sequence is cut after every ``max_tokens`` tokens.  Where a cut would split
a character's bytes it moves back to the character's start, so chunks are text,
joined they are the document, and none has more than ``max_tokens`` tokens.  Row by
row in Arrow batches: no shuffle, one text's tokens in memory at a time.
"""

from __future__ import annotations

import base64
import sys
from collections.abc import Iterator

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ioclake import config

# the task function travels by value, so executors need no installed copy
cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: how a text is cut before bytes are merged (fixed value of the vocabulary)
CUT = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: a character has at most four bytes, so a cut moves back by less than that
LEAST = 4
ROWS_AT_ONCE = 256


def read_ranks(data: bytes) -> dict[bytes, int]:
    """token bytes -> rank from lines of base64 and number."""
    return {base64.b64decode(t): int(r) for t, r in (line.split() for line in data.splitlines() if line)}


def cuts(lengths: list[int], data: bytes, max_tokens: int) -> Iterator[tuple[int, int, int]]:
    """(first byte, end byte, tokens) of each chunk, from token lengths."""
    ends, at = [], 0
    for n in lengths:
        at += n
        ends.append(at)
    first = begin = 0
    while first < len(ends):
        last = min(first + max_tokens, len(ends))
        while last < len(ends) and data[ends[last - 1]] & 0xC0 == 0x80:
            last -= 1
        yield begin, ends[last - 1], last - first
        first, begin = last, ends[last - 1]


def _chunking(shared, pattern: str, max_tokens: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import tiktoken

        ranks = read_ranks(shared.value)
        enc = tiktoken.Encoding("file", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        size = {r: len(t) for t, r in ranks.items()}
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS_AT_ONCE):
                b = batch.slice(at, ROWS_AT_ONCE)
                rows, numbers, chunks, tokens = [], [], [], []
                for row, text in enumerate(b.column(0)):
                    text = text.as_py()
                    if not text:
                        continue
                    data = text.encode()
                    lengths = [size[i] for i in enc.encode_ordinary(text)]
                    for n, (x, y, count) in enumerate(cuts(lengths, data, max_tokens)):
                        rows.append(row)
                        numbers.append(n)
                        chunks.append(data[x:y].decode())
                        tokens.append(count)
                keys = [c.take(pa.array(rows, pa.int64())) for c in b.columns[1:]]
                yield pa.RecordBatch.from_arrays(
                    [*keys, pa.array(numbers, pa.int32()), pa.array(chunks, pa.string()), pa.array(tokens, pa.int32())],
                    names=[*b.schema.names[1:], "chunk_no", "chunk", "n_tokens"])
    return run


def chunk_bpe(docs: DataFrame, ranks: str, key="doc", text: str = "text", max_tokens: int = config.CHUNK_TOKENS,
              pattern: str = CUT) -> DataFrame:
    """(key..., chunk_no, chunk, n_tokens): consecutive pieces of each text of
    at most ``max_tokens`` tokens of the vocabulary in the file ``ranks``.  Null
    and empty texts have none."""
    if max_tokens < LEAST:
        raise ValueError(f"max_tokens is at least {LEAST}, the bytes of one character")
    keys = [key] if isinstance(key, str) else list(key)
    with open(ranks, "rb") as f:
        shared = docs.sparkSession.sparkContext.broadcast(f.read())  # a file of fixed size
    src = docs.select(F.col(text).alias("__text"), *keys)
    schema = ", ".join([*(f"`{n}` {t}" for n, t in src.dtypes[1:]), "chunk_no int, chunk string, n_tokens int"])
    return src.mapInArrow(_chunking(shared, pattern, max_tokens), schema)
