"""Benchmark decontamination by winnowing, in SQL functions only.

Words are runs of digits, a-z (A-Z folded) and non-ASCII characters.  A window
is ``span`` consecutive words of an item; an item of fewer words is one window.
Every ``span``-word window is represented by the smallest hash of its ``k``-word
grams, so any shared window has the same fingerprint on both sides: with
``k = 4`` and 7 grams per window every shared span of 10 words is found.
Document fingerprints that a fixed-size bitmap of item fingerprints rules out
are dropped inside the scan; the others carry their window's words to an
equi-join with the item windows, which confirms the hit, and the overlapping
windows are merged into covered words.

Only the bitmap (``BITS`` bits, a fixed size) is sent to all tasks.

Defined results: null or blank text has no words and no hits; an item without
words matches nothing; a null item id marks words but is not counted as an item;
rows that repeat an id and text give the same row again; a null id is a document
like any other; extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ioclake.llm.common import Bitmap, ascii_lower

SPAN, K = 10, 4
#: bits of the fingerprint bitmap; a full map costs shuffle, not results
BITS = 1 << 20

SEPARATOR = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def word_list(text: Column) -> Column:
    return F.array_remove(F.split(ascii_lower(F.coalesce(text, F.lit(""))), SEPARATOR), "")


def _tail(col: str, by: int) -> Column:
    return F.slice(col, F.lit(by + 1), F.size(col))


def _pair(a: str, b: Column) -> Column:
    return F.zip_with(a, b, lambda x, y: F.xxhash64(x, y))


def _low(a: str, by: int) -> Column:
    return F.zip_with(a, _tail(a, by), lambda x, y: F.least(x, y))


def fingerprints(df: DataFrame) -> DataFrame:
    """Adds ``mins``: per position the smallest 4-gram hash of the 10-word
    window that starts there (meaningless past the last whole window)."""
    return (df.withColumn("h", F.transform("words", lambda w: F.xxhash64(w)))
            .withColumn("g2", _pair("h", _tail("h", 1))).withColumn("g4", _pair("g2", _tail("g2", 2)))
            .withColumn("m2", _low("g4", 1)).withColumn("m4", _low("m2", 2))
            .withColumn("mins", F.zip_with("m4", _tail("m4", 3), lambda x, y: F.least(x, y))))


def _gram(n: int) -> Column:
    """Hash of the n words from each position on (n < span)."""
    out = F.transform("words", lambda w: F.xxhash64(w, F.lit(n)))
    for k in range(1, n):
        out = F.zip_with(out, F.transform(_tail("words", k), lambda w: F.xxhash64(w)), lambda x, y: F.xxhash64(x, y))
    return out


def _text(pos: Column, n: int) -> Column:
    return F.array_join(F.slice("words", pos + 1, F.lit(n)), " ")


def _windows(df: DataFrame, keys: list[str], hashes: Column, n: int) -> DataFrame:
    """One row per position: keys, n_words, pos, len, the hash there."""
    return df.select(*keys, "words", F.size("words").alias("nw"), F.posexplode_outer(hashes).alias("pos", "m")) \
        .withColumn("whole", F.coalesce(F.col("pos") <= F.col("nw") - n, F.lit(False)))


def item_windows(items: DataFrame, id_col: str, text_col: str) -> tuple[DataFrame, list[int]]:
    """(window, m, len, items) per distinct window, and the lengths below
    ``span`` that occur (nine at most)."""
    it = items.select(F.col(id_col).cast("string").alias("item"), word_list(F.col(text_col)).alias("words")) \
        .withColumn("nw", F.size("words")).filter("nw > 0")
    short = sorted(r[0] for r in it.filter(F.col("nw") < SPAN).select("nw").distinct().collect())
    parts = [_windows(fingerprints(it.filter(F.col("nw") >= SPAN)), ["item"], F.col("mins"), SPAN)
             .filter("whole").select("item", "m", F.lit(SPAN).alias("len"), _text(F.col("pos"), SPAN).alias("window"))]
    for n in short:
        parts.append(_windows(it.filter(F.col("nw") == n), ["item"], _gram(n), n).filter("whole")
                     .select("item", "m", F.lit(n).alias("len"), _text(F.col("pos"), n).alias("window")))
    flat = parts[0]
    for p in parts[1:]:
        flat = flat.union(p)
    return flat.groupBy("window", "len", "m").agg(F.collect_set("item").alias("items")), short


def contamination(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """Per row of ``docs``: the id, n_words, n_hit (words inside an occurrence
    of an item's window), n_items and ``items`` (ids of items with occurring
    windows, sorted as strings), contaminated."""
    windows, short = item_windows(items, item_id, item_text)
    seen = Bitmap(windows, "m", BITS)
    d = docs.select(F.col(id_col).alias("id"), F.xxhash64(text_col).alias("key"),
                    word_list(F.col(text_col)).alias("words"))

    def hits(flat: DataFrame, n: int, mark: Column) -> DataFrame:
        return flat.withColumn("hit", F.col("whole") & seen.may_hold("m")).withColumn("mark", mark) \
            .filter(F.col("hit") | F.col("mark")) \
            .select("id", "key", "nw", "mark", "pos", F.lit(n).alias("len"),
                    # a row that only stands for its document joins nothing
                    F.when(F.col("hit"), _text(F.col("pos"), n))
                    .otherwise(F.concat(F.lit(" "), "key")).alias("window"))

    base = _windows(fingerprints(d), ["id", "key"], F.col("mins"), SPAN)
    cand = hits(base, SPAN, F.coalesce(F.col("pos") == 0, F.lit(True)))
    for n in short:
        cand = cand.union(hits(_windows(d, ["id", "key"], _gram(n), n), n, F.lit(False)))
    found = cand.join(windows.select("window", "len", "items"), ["window", "len"], "left")
    per = found.groupBy("id", "key").agg(
        F.max("nw").alias("nw"), F.count(F.when(F.col("mark"), 1)).alias("copies"),
        F.collect_set(F.when(F.col("items").isNotNull(), F.struct("pos", "len"))).alias("at"),
        F.collect_set("items").alias("items"))
    start = F.struct(F.lit(0).alias("end"), F.lit(0).alias("n"))

    def cover(acc: Column, x: Column) -> Column:
        end = x.pos + x.len
        return F.struct(F.greatest(acc.end, end).alias("end"),
                        (acc.n + F.greatest(F.lit(0), end - F.greatest(acc.end, x.pos))).alias("n"))

    return per.withColumn("n_hit", F.aggregate(F.array_sort("at"), start, cover, lambda a: a.n).cast("long")) \
        .withColumn("items", F.array_sort(F.array_distinct(F.flatten("items")))) \
        .select(F.col("id").alias(id_col), F.col("nw").cast("long").alias("n_words"), "n_hit",
                F.size("items").cast("long").alias("n_items"), "items",
                (F.col("n_hit") > 0).alias("contaminated"), "copies") \
        .withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int")))).drop("copy", "copies")


def drop_contaminated(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", **options) -> DataFrame:
    """The documents without a hit; null ids are judged like others."""
    bad = contamination(docs, items, id_col, **options).filter("contaminated").select(F.col(id_col).alias("__id")).distinct()
    return docs.join(bad, F.col(id_col).eqNullSafe(F.col("__id")), "left_anti").select(*docs.columns)
