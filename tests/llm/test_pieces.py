import random

from hypothesis import given
from hypothesis import strategies as st

from ioclake.llm import pieces
from ioclake.llm.pieces import Encoder, Vocabulary, load, marked_words, round_trip, spellings
from ioclake.llm.token_count import Automaton, token_counts

VOCAB = load()
ENCODER, SPELL = Encoder(VOCAB), spellings(VOCAB)
SCORES = {n: s for _, n, s in VOCAB.usable()}


def best(word):
    top = [0.0] + [-1e18] * len(word)
    for i in range(1, len(word) + 1):
        for j in range(max(0, i - 16), i):
            if word[j:i] in SCORES:
                top[i] = max(top[i], top[j] + SCORES[word[j:i]])
        if word[i - 1] not in SCORES:
            top[i] = max(top[i], top[i - 1] + ENCODER.floor)
    return top[-1]


def greedy(word):
    i = n = 0
    while i < len(word):
        k = next((k for k in range(min(16, len(word) - i), 0, -1) if word[i:i + k] in SCORES), 0)
        n += 1 if k else len(word[i].encode())
        i += k or 1
    return n


@given(st.text(max_size=60))
def test_any_text_comes_back(text):
    ids = ENCODER.encode([text])[0]
    assert b"".join(SPELL[i] for i in ids)[1:].decode() == text


def some_words(seed, n=1500):
    rng = random.Random(seed)
    return sorted({"▁" * rng.randint(1, 3) + "".join(rng.choice("thealiéß.x\n日") for _ in range(rng.randint(0, 9)))
                   for _ in range(n)})


def test_shared_prefixes_find_the_best_path():
    for word, ids in ENCODER.walk(some_words(1)):
        unknown = sum(c not in SCORES for c in word)
        assert abs(sum(VOCAB.scores[i] for i in ids if i not in VOCAB.special) + unknown * ENCODER.floor - best(word)) < 1e-9


def test_order_of_words_does_not_matter():
    words = some_words(2, 300)
    one = {w: next(iter(ENCODER.walk([w])))[1] for w in words}
    assert dict(ENCODER.walk(words)) == one


def test_marked_words_join_to_the_marked_text():
    assert marked_words("") == []
    for t in (" ", "a", " a", "a  b ", "  "):
        assert "".join(marked_words(t)) == "▁" + t.replace(" ", "▁")


def test_stored_scores_and_longer_last_piece():
    v = Vocabulary(["<u>", *[f"<{i}>" for i in range(256)], "▁", "a", "aa", "▁a"], [0.0] * 257 + [-1.0, -1.0, -2.0, -2.0],
                   1, set(range(257)))
    assert [v.names[i] for i in Encoder(v).encode(["aa"])[0]] == ["▁", "aa"]


def test_round_trip_table(spark):
    df = spark.createDataFrame([(1, None, 2), (2, "", 2), (3, "x" * 200_000, 1), (3, "a b", 1), (None, "é ▁ \n", 1)],
                               "doc_id long, text string, pieces int")
    got = sorted((str(r.doc_id), r.n_pieces, r.pieces is None, r.round_trip) for r in round_trip(df, VOCAB).collect())
    assert [(a, c, d) for a, _, c, d in got] == [("1", True, True), ("2", False, True), ("3", False, True),
                                                ("3", False, True), ("None", False, True)]
    assert got[0][1] == got[1][1] == 0
    assert round_trip(df.limit(0), VOCAB).count() == 0


def test_remembering_is_bounded(monkeypatch):
    monkeypatch.setattr(pieces, "REMEMBER", 10)
    enc = Encoder(VOCAB)
    for k in range(5):
        assert [x.tolist() for x in enc.encode([f"w{k}{i}" for i in range(20)])] == \
            [x.tolist() for x in Encoder(VOCAB).encode([f"w{k}{i}" for i in range(20)])]


def test_automaton_counts_greedy_pieces():
    auto = Automaton(SCORES)
    for w in [*some_words(3), "▁日本語😀", "▁\x00a", "▁" * 50, "▁" + "abc" * 500]:
        assert auto.count(w) == greedy(w)


@given(st.sets(st.text("ab▁c", min_size=1, max_size=5), max_size=12), st.text("ab▁cd", max_size=14))
def test_automaton_on_any_vocabulary(vocab, text):
    i = n = 0
    while i < len(text):
        k = next((k for k in range(5, 0, -1) if text[i:i + k] in vocab and i + k <= len(text)), 0)
        n += 1 if k else len(text[i].encode())
        i += k or 1
    assert Automaton(vocab).count(text) == n


def test_token_count_table(spark):
    df = spark.createDataFrame([(1, None, 2), (2, " \n", 2), (3, "hello  hello\nyou", 1), (3, "y" * 50_000, 1)],
                               "doc_id long, text string, n_tokens int")
    got = sorted(tuple(r) for r in token_counts(df, list(SCORES)).collect())
    words = ["▁hello", "▁hello", "▁you"]
    assert got == sorted([(1, 0, 0, 0), (2, 0, 0, 0), (3, 1, greedy("▁" + "y" * 50_000), greedy("▁" + "y" * 50_000)),
                          (3, 3, sum(map(greedy, words)), max(map(greedy, words)))])
    assert token_counts(df.limit(0), ["a"]).count() == 0


def test_decode_is_the_inverse_of_encode(spark):
    rows = [(1, None), (2, ""), (3, " a  b\n▁"), (4, "日本 x" * 50)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    made = pieces.encode(df, VOCAB, {"doc_id": df.doc_id})
    assert sorted(tuple(r) for r in pieces.decode(made, VOCAB, {"doc_id": made.doc_id}).collect()) == rows
