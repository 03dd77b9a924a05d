"""Byte-pair chunks against a slow merge loop."""

import pytest
import regex
from hypothesis import given, settings
from hypothesis import strategies as st

from conftest import rows

from ioclake import config
from ioclake.operators.bpe import CUT, chunk_bpe, cuts, read_ranks

with open(config.BPE_RANKS, "rb") as f:
    RANKS = read_ranks(f.read())


def slow_tokens(text):
    """Of each piece, again and again the pair of the lowest rank is merged."""
    out = []
    for piece in regex.findall(CUT, text):
        parts = [bytes([x]) for x in piece.encode()]
        while len(parts) > 1:
            rank, at = min((RANKS.get(a + b, 1 << 60), i) for i, (a, b) in enumerate(zip(parts, parts[1:])))
            if rank == 1 << 60:
                break
            parts[at:at + 2] = [parts[at] + parts[at + 1]]
        out += parts
    return out


def slow_chunks(text, n):
    toks, out, first = slow_tokens(text), [], 0
    while first < len(toks):
        last = min(first + n, len(toks))
        while True:
            try:
                out.append((b"".join(toks[first:last]).decode(), last - first))
                break
            except UnicodeDecodeError:
                last -= 1
        first = last
    return out


def chunks(spark, texts, n):
    df = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)], "doc long, text string, chunk string")
    got = {i: [] for i in range(len(texts))}
    for d, no, chunk, k in sorted(rows(chunk_bpe(df, config.BPE_RANKS, max_tokens=n))):
        assert no == len(got[d])
        got[d].append((chunk, k))
    return got


@settings(max_examples=12, deadline=None)
@given(st.lists(st.text(st.sampled_from(list("abc theing' \n\t.,1é日🙂­")), max_size=60), min_size=1, max_size=8), st.integers(4, 9))
def test_chunks_are_those_of_the_merge_loop(spark, texts, n):
    got = chunks(spark, texts, n)
    for i, t in enumerate(texts):
        assert got[i] == slow_chunks(t, n)
        assert "".join(c for c, _ in got[i]) == t


def test_landed_texts(spark):
    texts = [r[0] for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("text").limit(30).collect()]
    got = chunks(spark, texts, 50)
    assert all(got[i] == slow_chunks(t, 50) for i, t in enumerate(texts))


def test_odd_texts(spark):
    got = chunks(spark, [None, "", " ", "x" * 100_000, "🙂" * 5000, "<|endoftext|>"], 100)
    assert got[0] == got[1] == [] and got[2] == [(" ", 1)]
    assert "".join(c for c, _ in got[3]) == "x" * 100_000 and "".join(c for c, _ in got[4]) == "🙂" * 5000
    assert all(k <= 100 for cs in got.values() for _, k in cs) and len(got[5]) == 1
    assert rows(chunk_bpe(spark.createDataFrame([], "doc long, text string"), config.BPE_RANKS)) == []


def test_a_cut_keeps_characters_whole():
    assert list(cuts([1, 1, 1, 1, 1, 1, 1, 1], "🙂🙂".encode(), 6)) == [(0, 4, 4), (4, 8, 4)]


def test_too_few_tokens_a_chunk(spark):
    with pytest.raises(ValueError):
        chunk_bpe(spark.createDataFrame([], "doc long, text string"), config.BPE_RANKS, max_tokens=3)
