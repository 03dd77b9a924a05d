"""Cross-tokenizer alignment against a walk over characters of each text."""

import hashlib
from collections import Counter

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from ioclake.llm import alignment
from ioclake.llm.queries import BYTE_LEVEL, PIECES, QUERIES

from .conftest import SF

MEASURES = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


def token_lists(text):
    """[(id, bytes)] of both sides, or None."""
    import sentencepiece
    from tokenizers import Tokenizer
    if not hasattr(token_lists, "made"):
        tok = Tokenizer.from_file(BYTE_LEVEL)
        tok.encode_special_tokens = True
        token_lists.made = tok, sentencepiece.SentencePieceProcessor(model_file=PIECES)
    tok, sp = token_lists.made
    whole = (" " + text).encode()
    e = tok.encode(" " + text, add_special_tokens=False)
    # the table of the byte-level alphabet, spelled out another way
    keep = [*range(33, 127), *range(161, 173), *range(174, 256)]
    byte = {chr(b): b for b in keep}
    byte.update((chr(256 + n), b) for n, b in enumerate(b for b in range(256) if b not in keep))
    a = [(i, bytes(byte[c] for c in t)) for i, t in zip(e.ids, e.tokens)]
    b = []
    for i in sp.encode(text):
        p = sp.id_to_piece(i)
        b.append((i, bytes.fromhex(p[3:5]) if sp.is_byte(i) else p.replace("▁", " ").encode()))
    if any(b"".join(x for _, x in side) != whole for side in (a, b)):
        return None
    return a, b


def groups_of(text):
    lists = token_lists(text) if text else None
    if not lists:
        return []
    groups, sides = [], [list(x) for x in lists]
    while sides[0]:
        held, size = ([], []), [0, 0]
        while not size[0] or size[0] != size[1]:
            k = 0 if size[0] <= size[1] else 1
            i, x = sides[k].pop(0)
            held[k].append(i)
            size[k] += len(x)
        groups.append(held)
    return groups


def brute(rows):
    per = [groups_of(t) for _, t in rows]
    occ = [Counter((x, y) for a, b in gs for x in a for y in b) for gs in per]
    count = Counter(p for o in occ for p in o)
    top = {}
    for (x, _), n in count.items():
        top[x] = max(n, top.get(x, 0))
    out = []
    for (i, _), gs, o in zip(rows, per, occ):
        text = ";".join(",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b in gs)
        out.append((i, sum(len(a) for a, _ in gs), sum(len(b) for _, b in gs), len(gs), sum(o.values()),
                    sum(n for p, n in o.items() if count[p] == top[p[0]]), sum(n * count[p] for p, n in o.items()),
                    hashlib.sha256(text.encode()).hexdigest() if gs else ""))
    return sorted(out, key=str), count, top


def got(df, *cols):
    return sorted((tuple(r) for r in df.select(*cols).collect()), key=str)


ROWS = [(1, "plain words of a text"), (2, "plain words of a text"), (None, "plain words of a text"), (3, None), (4, ""),
        (5, " "), (6, "tab\tand\nline\r\n\x00 end  "), (7, "naïve café — 東京 🙂👩‍👩‍👧 ﷺ"), (8, "a literal ▁ mark"),
        (9, "special <|endoftext|> and <s> </s> <0x41> <unk>"), (9, "repeated id"), (10, "x" * 3000),
        (11, " " * 777 + "a" + "あ" * 300), (12, "ÀÉ" * 400 + "  \n\n  ")]


@pytest.fixture(scope="module")
def table(spark):
    return spark.createDataFrame([(i, t, "n") for i, t in ROWS], "doc_id long, text string, n_a string")


@pytest.mark.parametrize("hot_pairs, hot_texts", [(1 << 20, 1 << 10), (1, 1), (40, 5)])
def test_odd_texts(spark, table, hot_pairs, hot_texts):
    want, count, top = brute(ROWS)
    df, counts = alignment.align(table, BYTE_LEVEL, PIECES, hot_pairs=hot_pairs, hot_texts=hot_texts)
    assert df.columns == ["doc_id", *MEASURES]
    assert got(df, "doc_id", *MEASURES) == want
    assert got(counts, "a_id", "b_id", "count", "best") == sorted(
        ((x, y, n, n == top[x]) for (x, y), n in count.items()), key=str)


def test_large_groups_and_split_rows(spark, table, monkeypatch):
    monkeypatch.setattr(alignment, "LISTED", 2)
    monkeypatch.setattr(alignment, "PART", 3)
    want, _, _ = brute(ROWS)
    assert got(alignment.align(table, BYTE_LEVEL, PIECES)[0], "doc_id", *MEASURES) == want


def test_whole_table(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    want, _, _ = brute(rows)
    assert got(QUERIES["op11_alignment"](spark, SF), "doc_id", *MEASURES) == want


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert alignment.align(df, BYTE_LEVEL, PIECES)[0].collect() == []


@settings(max_examples=300, deadline=None)
@given(st.text(st.characters(max_codepoint=0x24F) | st.sampled_from("'stredmvl \n\t\r0123456789 \u00ad"), max_size=60))
def test_both_engines_of_a_definition_agree(text):
    side = getattr(test_both_engines_of_a_definition_agree, "side", None)
    if side is None:
        with open(BYTE_LEVEL) as f:
            side = test_both_engines_of_a_definition_agree.side = alignment.byte_level_side(f.read())
    token_lists("x")
    assert side.encode([text]) == [token_lists.made[0].encode(" " + text, add_special_tokens=False).ids]


def test_the_faster_engine_is_used(monkeypatch):
    import tiktoken
    seen = []
    whole = tiktoken.Encoding.encode_ordinary
    monkeypatch.setattr(tiktoken.Encoding, "encode_ordinary", lambda self, t: seen.append(t) or whole(self, t))
    with open(BYTE_LEVEL) as f:
        side = alignment.byte_level_side(f.read())
    side.encode(["plain déjà vu", "東京"])
    assert seen == [" plain déjà vu"]


def test_decimals():
    rows = alignment.decimals(1200)
    assert [bytes(r[r != 0]).decode() for r in rows] == [str(n) for n in range(1200)]
