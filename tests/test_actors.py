import random
import time

from conftest import rows
from hypothesis import given, settings
from hypothesis import strategies as st

from ioclake.operators import actors as ac
from ioclake.operators import mentions as mn

MSCHEMA = "doc string, sent long, pos long, n_tokens int, text string, label string"


def ment(spark, data):
    return spark.createDataFrame(data, MSCHEMA)


def test_actor_forms_merge_keep_first_attributes(spark):
    m = ment(spark, [("d", 0, 0, 1, "ACME", "ORG"), ("d", 0, 2, 1, "Paris", "GPE"),
                     ("d", 1, 0, 1, "Acme", "ORG"), ("d", 2, 0, 1, "ACME", "ORG"),
                     ("d", 1, 3, 1, "Rome", "GPE")])
    a = ac.merge_actors(m)
    assert rows(a, "actor_key", "names", "sent") == [("acme", ["ACME", "Acme"], 0)]
    assert rows(ac.actor_targets(a, m), "target") == [("Paris",)]


def test_self_target_excluded(spark):
    m = ment(spark, [("d", 0, 0, 1, "ACME", "ORG"), ("d", 0, 3, 1, "acme", "ORG"), ("d", 0, 5, 1, "Bank", "ORG")])
    a = ac.merge_actors(m)
    got = sorted(rows(ac.actor_targets(a, m), "actor_key", "target"))
    assert [t for k, t in got if k == "acme"] == ["Bank"]
    assert [t for k, t in got if k == "bank"] == ["ACME", "acme"]


def test_overlapping_labels(spark):
    m = ment(spark, [("d", 0, 0, 1, "ACME", "ORG"), ("d", 0, 2, 2, "Big Book", "WORK_OF_ART"),
                     ("d", 0, 5, 1, "Summit", "EVENT"), ("d", 0, 7, 1, "Act", "LAW")])
    a = ac.merge_actors(m)
    assert rows(ac.actor_tactics(a, m), "tactic") == [("Big Book",), ("Summit",)] or \
        sorted(rows(ac.actor_tactics(a, m), "tactic")) == [("Big Book",), ("Summit",)]
    assert sorted(rows(ac.actor_techniques(a, m), "technique")) == [("Act",), ("Big Book",)]
    assert sorted(rows(mn.ttps(m), "tactic", "technique")) == [
        ("EVENT", "Summit"), ("LAW", "Act"), ("WORK_OF_ART", "Big Book")]


def test_related_ioc_by_substring(spark):
    m = ment(spark, [("d", 0, 0, 1, "ACME", "ORG"), ("d", 0, 1, 1, "by", "PERSON")])
    a = ac.merge_actors(m)
    iocs = spark.createDataFrame([("d", 1, 0, 3, 0, "URL", "login.acme.com"), ("d", 1, 0, 4, 0, "URL", "other.org"),
                                  ("e", 1, 0, 1, 0, "URL", "acme.net")],
                                 "doc string, src_rank int, sent long, pos long, pat_rank int, type string, value string")
    got = sorted(rows(ac.actor_related_iocs(a, iocs), "actor_key", "value"))
    assert got == [("acme", "login.acme.com")]


def test_motivation_and_summary(spark):
    m = ment(spark, [("d", 0, 0, 1, "Group", "ORG")])
    a = ac.merge_actors(m)
    s = spark.createDataFrame([("d", 0, "Group Aims To steal.")], "doc string, sent long, sent_text string")
    t = spark.createDataFrame([("d", "Title")], "doc string, title string")
    (r,) = rows(ac.actor_context(a, s, t), "description", "summary", "motivation")
    assert r == ("Extracted from article: Title",
                 "Potential threat actor 'Group' identified in the context: 'Group Aims To steal.'",
                 "Group Aims To steal.")


def test_gazetteer_longest_span_wins(spark):
    d = spark.createDataFrame([("d", "Apt One Group attacked. One more.")], "doc string, text string")
    g = spark.createDataFrame([("one", "CARDINAL"), ("apt one", "ORG"), ("apt one group", "ORG"),
                               ("one group", "NORP")], "term string, label string")
    got = sorted(rows(mn.find_mentions(d, g), "sent", "pos", "text", "label"))
    assert got == [(0, 0, "Apt One Group", "ORG"), (1, 0, "One", "CARDINAL")]


def mentions(spark, text, *terms):
    d = spark.createDataFrame([("d", text)], "doc string, text string")
    g = spark.createDataFrame(list(terms), "term string, label string")
    return sorted(rows(mn.find_mentions(d, g), "sent", "pos", "n_tokens", "text", "label"))


def test_long_terms_and_all_labels(spark):
    got = mentions(spark, "The North Korean Lazarus Group Bureau struck.",
                   ("North Korean Lazarus Group Bureau", "ORG"), ("north korean lazarus group bureau", "PERSON"),
                   ("Lazarus", "ORG"))
    text = "North Korean Lazarus Group Bureau"
    assert got == [(0, 1, 5, text, "ORG"), (0, 1, 5, text, "PERSON")]


def test_overlapping_spans_leftmost_then_longest(spark):
    got = mentions(spark, "Lazarus Group Bureau", ("Lazarus Group", "ORG"), ("Group Bureau", "ORG"), ("Lazarus", "ORG"))
    assert got == [(0, 0, 2, "Lazarus Group", "ORG")]


def test_spans_do_not_jump_over_punctuation(spark):
    assert mentions(spark, "of, the of - the of (the) of the", ("of the", "ORG")) == [(0, 6, 2, "of the", "ORG")]


def test_related_iocs_of_a_very_long_token(spark):
    a = spark.createDataFrame([("d", "evil"), ("d", "x"), ("e", "evil")], "doc string, actor_key string")
    long = "ab" * 10_000 + "EVIL" + "cd" * 10_000
    i = spark.createDataFrame([("d", 0, long), ("d", 1, long), ("d", 2, "none"), ("e", 0, "x")],
                              "doc string, pos int, value string")
    assert sorted(rows(ac.actor_related_iocs(a, i), "doc", "actor_key", "pos")) == [("d", "evil", 0), ("d", "evil", 1)]


def mentions_of(spark, texts, terms):
    df = spark.createDataFrame(list(enumerate(texts)), "doc long, text string")
    gaz = mn.gazetteer_table(spark, terms)
    return sorted(rows(mn.find_mentions(df, gaz), "doc", "sent", "pos", "n_tokens", "text", "label"))


def walk(text, terms):
    """Leftmost-longest terms of one sentence of plain words."""
    toks, held, out, at = text.split(), {}, [], 0
    for term, label in terms:
        held.setdefault(tuple(term.lower().split()), set()).add(label)
    sizes = sorted({len(t) for t in held}, reverse=True)
    while at < len(toks):
        n = next((n for n in sizes if at + n <= len(toks) and tuple(t.lower() for t in toks[at:at + n]) in held), 0)
        if n:
            out += [(0, 0, at, n, " ".join(toks[at:at + n]), lab) for lab in sorted(held[tuple(t.lower() for t in toks[at:at + n])])]
        at += n or 1
    return sorted(out)


@settings(max_examples=15, deadline=None)
@given(st.lists(st.sampled_from(["a", "B", "c", "d"]), min_size=1, max_size=30),
       st.lists(st.tuples(st.lists(st.sampled_from("abcd"), min_size=1, max_size=5).map(" ".join), st.sampled_from("XY")),
                min_size=1, max_size=6))
def test_mentions_are_the_leftmost_longest(spark, words, terms):
    assert mentions_of(spark, [" ".join(words)], terms) == walk(" ".join(words), terms)


def test_large_gazetteer_makes_few_spans(spark):
    rng = random.Random(5)
    word = lambda: f"w{rng.randrange(40_000)}"
    terms = list({" ".join(word() for _ in range(rng.randrange(1, 11))): "ORG" for _ in range(100_000)}.items())
    text = " ".join(t for term, _ in rng.sample(terms, 300) for t in [*term.split(), *(word() for _ in range(20))])
    assert mentions_of(spark, [text], terms) == walk(text, terms)
    df = spark.createDataFrame([(0, text)], "doc long, text string")
    plan = mn.find_mentions(df, mn.gazetteer_table(spark, terms))._jdf.queryExecution().optimizedPlan().toString()
    assert "scalar-subquery" in plan


def test_many_matches_in_one_sentence_are_walked_once(spark):
    took = []
    for n in (5_000, 40_000):
        began = time.time()
        assert len(mentions_of(spark, ["one two three " * n], [("two", "X"), ("one two", "Y"), ("none", "Z")])) == n
        took.append(time.time() - began)
    assert took[1] < 8 * took[0] + 15


def test_no_terms_give_no_mentions(spark):
    assert mentions_of(spark, ["a b c"], []) == []
    assert mentions_of(spark, ["a b c", "", "..."], [("***", "X"), ("", "Y")]) == []


def test_any_way_to_join_the_gazetteer_gives_the_same(spark, monkeypatch):
    args = (["of the - of, the (of the) x of the -", "- - of the", "", "- .", "of THE"], [("of the", "X"), ("the", "Y"), ("x", "X")])
    want = mentions_of(spark, *args)
    assert want == [(0, 0, 0, 2, "of the", "X"), (0, 0, 3, 1, "the", "Y"), (0, 0, 4, 2, "of the", "X"), (0, 0, 6, 1, "x", "X"),
                    (0, 0, 7, 2, "of the", "X"), (1, 0, 0, 2, "of the", "X"), (4, 0, 0, 2, "of THE", "X")]
    monkeypatch.setattr(mn, "SMALL_GAZETTEER", 2)
    assert mentions_of(spark, *args) == want
