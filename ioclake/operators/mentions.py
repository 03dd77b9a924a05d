"""Entity mentions by gazetteer lookup (C7, the stand-in for a statistical
NER model) and the mention-label projections B12, B14.

Mentions are ``(doc, sent, pos, n_tokens, text, label)`` with ``pos`` the
span's first token inside its sentence; mention order in a document is
(sent, pos).  An external model can supply the same table instead.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ioclake import config
from ioclake.functions.bitmap import Bitmap
from ioclake.functions.text import PY_WHITESPACE, TOKEN_LEAD, WS, fold_out, none_of, project_once
from ioclake.functions.text import tokens as token_array
from ioclake.operators.text import split_sentences

# Marks in place of the punctuation a token lost before and after it, so a
# span can tell "of the" from "of, the".
LOST_BEFORE, LOST_AFTER = "\x01", "\x02"
#: bits of a sketch of how terms begin (half a megabyte each)
START_BITS = 1 << 22
#: terms that every task is given; a larger gazetteer is joined by a shuffle
SMALL_GAZETTEER = 200_000


def gazetteer_table(spark: SparkSession, entries=None) -> DataFrame:
    entries = config.TESTDATA_GAZETTEER if entries is None else entries
    return spark.createDataFrame(list(entries), "term string, label string")


def prepare_gazetteer(gaz: DataFrame) -> DataFrame:
    """(n_tokens, term_l, labels): terms normalised with the token rule and
    lower-cased, each with all its labels, sorted.  Terms of any length."""
    toks = F.transform(token_array(F.col("term")), lambda t: F.lower(t))
    return (gaz.select(toks.alias("_t"), "label").filter(F.size("_t") >= 1)
            .groupBy(F.size("_t").alias("n_tokens"), F.array_join("_t", " ").alias("term_l"))
            .agg(F.sort_array(F.collect_set("label")).alias("labels")))


def marked_tokens(text) -> F.Column:
    """The tokens of the token rule, with marks where punctuation was lost;
    a token of punctuation only marks the next one.  Without tokens: one empty
    string, which is no term."""
    s = F.coalesce(F.col(text), F.lit(""))
    for mark in (LOST_BEFORE, LOST_AFTER):
        s = F.replace(s, F.lit(mark), F.lit("-"))
    s = F.regexp_replace(s, TOKEN_LEAD, LOST_BEFORE)
    s = F.regexp_replace(s, r"[^\p{L}\p{N}/\x01 \t\n\x0B\f\r]+(?![^ \t\n\x0B\f\r])", LOST_AFTER)
    s = F.regexp_replace(s, LOST_BEFORE + WS + "+", LOST_BEFORE)
    # what is left of punctuation alone can only end the text; a mark before its first token parts nothing
    return F.split(F.btrim(s, F.lit(LOST_BEFORE + PY_WHITESPACE)), WS + "+")


def _unmarked(token) -> F.Column:
    return F.replace(F.replace(token, F.lit(LOST_BEFORE)), F.lit(LOST_AFTER))


def _starts(gaz: DataFrame) -> tuple[Bitmap, Bitmap, Bitmap]:
    """Sketches of the first tokens of all terms, of the terms of one token,
    and of the first two tokens of longer ones."""
    t = F.split("term_l", " ")
    first = gaz.select(F.xxhash64(t[0]).alias("h"))
    one = gaz.filter("n_tokens = 1").select(F.xxhash64(t[0]).alias("h"))
    two = gaz.filter("n_tokens > 1").select(F.xxhash64(t[0], F.get(t, 1)).alias("h"))
    return Bitmap(first, "h", START_BITS), Bitmap(one, "h", START_BITS), Bitmap(two, "h", START_BITS)


def _leftmost_longest(spans) -> F.Column:
    """Of an ordered array of spans (pos, less = -tokens, ...) those that a
    walk from the left keeps: the first that begins where the last has ended."""
    def step(free, m):
        fits = m.pos >= free
        return F.when(fits, m.pos - m.less).otherwise(free), F.when(fits, F.array(m)).otherwise(none_of(m))
    return F.when(F.size(spans) == 1, spans).otherwise(fold_out(spans, F.lit(0), step))


def find_mentions(docs: DataFrame, gazetteer: DataFrame, key: str = "doc", text: str = "text") -> DataFrame:
    """(key, sent, pos, n_tokens, text, label): spans inside one sentence
    whose lower-cased text is a gazetteer term and that hold no punctuation
    between their tokens; of overlapping spans the leftmost stays, of those at
    one place the longest.  A term with several labels gives a row for each.

    Plan: fixed-size sketches of how terms begin decide inside the scan where a
    span may start; only there spans are made, of the lengths that the gazetteer
    holds -> equi-join on (length, span), where a gazetteer of up to
    SMALL_GAZETTEER terms goes to every task and no span moves -> one walk over
    the few matches of a sentence.  The distinct lengths and their numbers of
    terms are the only thing read up front."""
    gaz = prepare_gazetteer(gazetteer)
    held = dict(gaz.groupBy("n_tokens").count().collect())
    lengths = sorted(held)
    longer = [n for n in lengths if n > 1]
    first, one, two = _starts(gaz)
    sents = project_once(split_sentences(docs, key, text), [key, "sent"], {"_t": marked_tokens("sent_text")})
    # a row per token; where it passes, it takes the tokens along that a span may have, not the whole sentence
    words = sents.select(key, "sent", "_t", F.posexplode("_t").alias("pos", "_w"))
    hashed = words.withColumn("h1", F.xxhash64(F.lower(_unmarked("_w")))).filter(first.may_hold("h1")).withColumn(
        "h2", F.xxhash64(F.lower(_unmarked("_w")), F.lower(_unmarked(F.get("_t", F.col("pos") + 1)))))
    begun = hashed.select(key, "sent", "pos", F.slice("_t", F.col("pos") + 1, max(lengths, default=1)).alias("_s"),
                          one.may_hold("h1").alias("one"), two.may_hold("h2").alias("two")).filter("one OR two")

    sizes = F.concat(F.when(F.col("one"), F.array(F.lit(1))).otherwise(none_of(F.lit(1))),
                     F.when(F.col("two"), F.array(*map(F.lit, longer or [2]))).otherwise(none_of(F.lit(1))))
    spans = F.transform(F.filter(sizes, lambda n: n <= F.size("_s")), lambda n: F.struct(
        n.alias("n_tokens"), F.array_join(F.slice("_s", 1, n), " ").alias("raw")))

    whole = ~F.col("raw").contains(LOST_AFTER + " ") & ~F.col("raw").contains(" " + LOST_BEFORE)
    grams = (begun.select(key, "sent", "pos", F.inline(spans)).filter(whole)
             .select(key, "sent", "pos", "n_tokens", _unmarked("raw").alias("text"))
             .withColumn("term_l", F.lower("text")))
    terms = F.broadcast(gaz) if sum(held.values()) <= SMALL_GAZETTEER else gaz
    matched = grams.join(terms, ["n_tokens", "term_l"]).select(
        key, "sent", F.struct("pos", F.negative("n_tokens").alias("less"), "text", "labels").alias("_m"))
    return (matched.groupBy(key, "sent").agg(F.array_sort(F.collect_list("_m")).alias("_all"))
            .select(key, "sent", F.explode(_leftmost_longest(F.col("_all"))).alias("_m"))
            .select(key, "sent", "_m.pos", F.negative("_m.less").alias("n_tokens"), "_m.text",
                    F.explode("_m.labels").alias("label")))


def ttps(mentions: DataFrame, key: str = "doc", labels=None) -> DataFrame:
    """(key, sent, pos, tactic, technique): mentions with a TTP label, no
    dedup (B12)."""
    labels = config.TTP_LABELS if labels is None else labels
    return (mentions.filter(F.col("label").isin(labels))
            .select(key, "sent", "pos", F.col("label").alias("tactic"), F.col("text").alias("technique")))


def actor_mentions(mentions: DataFrame, labels=None) -> DataFrame:
    """Mentions that may name an actor."""
    labels = config.ACTOR_LABELS if labels is None else labels
    return mentions.filter(F.col("label").isin(labels))
