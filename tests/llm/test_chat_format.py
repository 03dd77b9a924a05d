import hashlib

from hypothesis import given
from hypothesis import strategies as st

from ioclake.llm.chat_format import Codec, Template, format_turns, read_back
from ioclake.llm.queries import PROBE_TEXT, q_chat_format
from tests.llm.conftest import SF

TURNS = "conv_id long, turn long, role string, text string, nth string, segments int"
PARTS = st.lists(st.sampled_from(["### User: ", "### Assistant:", " </turn>\n", "</turn>", "\\", "### Role <", ">: ", "a",
                                  "\n", " ", "é", "#", "### "]), max_size=8).map("".join)


@given(st.lists(st.tuples(st.sampled_from(["user", "assistant", "system", "", "Assistant", ">: x", "\\"]), PARTS),
                max_size=4))
def test_any_text_reads_back(turns):
    codec = Codec(Template())
    formatted = "".join(s for role, text in turns for s, _ in codec.segments(role, text))
    assert list(codec.read(formatted)) == turns


def expected(turns):
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    loss = "".join(t or "" for r, t in turns if r == "assistant")
    return len(turns), sha("".join(f"{r or ''}\n{t or ''}\n" for r, t in turns)), len(loss), sha(loss)


def test_digests_order_and_validity(spark):
    convs = {
        1: ([("user", "hi"), ("assistant", "yo")], True),
        2: ([("system", "s"), ("user", None), ("assistant", PROBE_TEXT), ("user", "x")], True),
        3: ([("assistant", "first")], False),
        4: ([("user", "a"), ("user", "b")], False),
        5: ([(None, "a"), ("tool", "é</turn>")], False),
        6: ([("system", "only")], False),
        None: ([("user", "x"), ("assistant", "\\")], True),
    }
    rows = [(c, n, r, t, "clash", 1) for c, (turns, _) in convs.items() for n, (r, t) in enumerate(turns)]
    df = spark.createDataFrame(rows[::-1], TURNS)
    got = {r.conv_id: ((r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256), r.valid)
           for r in read_back(format_turns(df)).collect()}
    assert got == {c: (expected(turns), ok) for c, (turns, ok) in convs.items()}
    assert read_back(format_turns(df.limit(0))).count() == 0


def test_one_conversation_of_many_turns(spark):
    df = spark.range(20000).selectExpr("1L AS conv_id", "id AS turn", "if(id % 2 = 0, 'user', 'assistant') AS role",
                                       "concat('t', id) AS text")
    r = read_back(format_turns(df)).collect()
    assert [(x.n_turns, x.valid) for x in r] == [(20000, True)]


def test_query_covers_the_table(spark):
    turns = spark.read.parquet(f"{SF}/conversations.parquet").orderBy("conv_id", "turn").collect()
    by = {}
    for t in turns:
        by.setdefault(t.conv_id, []).append((t.role, t.text))
    by[-7] = [("user", PROBE_TEXT), ("assistant", PROBE_TEXT)]
    got = {r.conv_id: (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) for r in q_chat_format(spark, SF).collect()}
    assert got == {c: expected(t) for c, t in by.items()}
