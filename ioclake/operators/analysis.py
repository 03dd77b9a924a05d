"""Chunk analysis as tables: requests (H9), replies classified and parsed
(H10-H12, notes 13-14), salvage of broken replies (H13), first good
attempt per chunk (H14), rejects (H15), per-article combine (D3) and the
analysed / unanalysed split (C6).

The model call itself happens elsewhere; its replies land as a table
``responses(<key>, chunk_no, attempt, status, content)``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ioclake import config
from ioclake.functions.text import py_strip
from ioclake.functions.text import project_once
from ioclake.operators.aggregates import CONCAT_FANOUT

KEYS = config.REPLY_KEYS
LIST_KEYS = config.REPLY_LIST_KEYS
TEXT_KEYS = [k for k in KEYS if k not in LIST_KEYS]


def build_requests(chunks: DataFrame, key: str = "doc") -> DataFrame:
    """(key, chunk_no, model, system, user, temperature, max_tokens,
    request): one chat request per chunk, also as one JSON document."""
    user = F.concat(F.lit(config.USER_PROMPT_PREFIX), F.col("chunk"))
    req = F.to_json(F.struct(
        F.lit(config.MODEL_NAME).alias("model"),
        F.array(F.struct(F.lit("system").alias("role"), F.lit(config.SYSTEM_PROMPT).alias("content")),
                F.struct(F.lit("user").alias("role"), user.alias("content"))).alias("messages"),
        F.lit(config.TEMPERATURE).alias("temperature"),
        F.lit(config.REPLY_MAX_TOKENS).alias("max_tokens")))
    return chunks.select(key, "chunk_no", F.lit(config.MODEL_NAME).alias("model"),
                         F.lit(config.SYSTEM_PROMPT).alias("system"), user.alias("user"),
                         F.lit(config.TEMPERATURE).alias("temperature"),
                         F.lit(config.REPLY_MAX_TOKENS).alias("max_tokens"),
                         req.alias("request"))


def classify_replies(responses: DataFrame) -> DataFrame:
    """Add ``reply_class`` and the parsed six fields.

    Classes: 'a' object of strings, 'b' object with missing keys (filled
    with ''), 'c' not strict JSON (summary = raw text, lists empty), 'd'
    JSON that is not an object or has a non-string list value (a failed
    attempt), 'e' summary or impact not a string (passes the parse, ends in
    rejects), 'failed' error status or no content.  Strict JSON = parses
    alone, inside [...] and as an object member (no trailing garbage).

    The reply is parsed once per row; generator barriers keep later
    filters on the class from re-running the parse."""
    c = F.col("content")
    parsed = project_once(responses, responses.columns, {
        "_v": F.expr("try_parse_json(content)"),
        "_strict": (F.expr("try_parse_json(content)").isNotNull()
                    & F.expr("try_parse_json(concat('[', content, ']'))").isNotNull()
                    & F.expr("try_parse_json(concat('{\"w\":', content, '}'))").isNotNull())})
    typed = project_once(parsed, parsed.columns, {
        "_root": F.expr("schema_of_variant(_v)"),
        **{f"_t_{k}": F.expr(f"schema_of_variant(variant_get(_v, '$.{k}'))") for k in KEYS}})

    def t(k):
        return F.col(f"_t_{k}")

    bad_list = F.lit(False)
    for k in LIST_KEYS:
        bad_list = bad_list | (t(k).isNotNull() & (t(k) != "STRING"))
    bad_text = F.lit(False)
    for k in TEXT_KEYS:
        bad_text = bad_text | (t(k).isNotNull() & (t(k) != "STRING"))
    all_present = F.lit(True)
    for k in KEYS:
        all_present = all_present & t(k).isNotNull()
    cls = (F.when((F.col("status") != "ok") | c.isNull(), F.lit("failed"))
           .when(~F.col("_strict"), F.lit("c"))
           .when(~F.col("_root").startswith("OBJECT") | bad_list, F.lit("d"))
           .when(bad_text, F.lit("e"))
           .when(all_present, F.lit("a"))
           .otherwise(F.lit("b")))
    classed = project_once(typed, typed.columns, {"reply_class": cls})
    ok = F.col("reply_class").isin("a", "b")

    def get_str(k):
        return F.coalesce(F.expr(f"try_variant_get(_v, '$.{k}', 'string')"), F.lit(""))

    cols = {}
    for k in KEYS:
        if k in LIST_KEYS:
            cols[k] = (F.when(ok, F.split(get_str(k), config.REPLY_LIST_SEPARATOR))
                       .otherwise(F.array().cast("array<string>")))
        elif k == "Executive_Summary":
            cols[k] = F.when(ok, get_str(k)).when(F.col("reply_class") == "c", c).otherwise(F.lit(""))
        else:
            cols[k] = F.when(ok, get_str(k)).otherwise(F.lit(""))
    keep = [x for x in classed.columns if not x.startswith("_")]
    return project_once(classed, keep, cols)


def choose_attempt(classified: DataFrame, key: str = "doc",
                   max_attempts: int = config.MAX_ATTEMPTS) -> DataFrame:
    """The first attempt (<= max_attempts) per chunk whose reply returned:
    classes a, b, c and e (H14).  Chunks with none are absent."""
    ok = classified.filter(F.col("reply_class").isin("a", "b", "c", "e")
                           & (F.col("attempt") <= max_attempts))
    # the raw reply stays behind; its parsed fields go on
    fields = [c for c in ok.columns if c not in (key, "chunk_no", "content")]
    best = (ok.groupBy(key, "chunk_no")
            .agg(F.min_by(F.struct(*fields), F.col("attempt")).alias("_r")))
    return best.select(key, "chunk_no", "_r.*")


def chunk_analysis(chosen: DataFrame, key: str = "doc") -> DataFrame:
    """Chosen replies that parse into an analysis (classes a, b, c)."""
    return chosen.filter(F.col("reply_class").isin("a", "b", "c")).select(key, "chunk_no", *KEYS)


def reply_rejects(classified: DataFrame, key: str = "doc",
                  max_attempts: int = config.MAX_ATTEMPTS) -> DataFrame:
    """Chunks whose chosen reply has a non-string summary/impact (class e)
    and chunks with no usable attempt (H15).  One aggregate per chunk: the
    class of the first returning attempt, null when none returned."""
    ok = F.col("reply_class").isin("a", "b", "c", "e")
    per_chunk = (classified.filter(F.col("attempt") <= max_attempts)
                 .groupBy(key, "chunk_no")
                 .agg(F.min_by(F.col("reply_class"), F.when(ok, F.col("attempt"))).alias("_cls"),
                      F.count_if(ok).alias("_ok")))
    reason = (F.when(F.col("_ok") == 0, F.lit("no_usable_reply"))
              .when(F.col("_cls") == "e", F.lit("non_string_text")))
    k = F.concat_ws("#", F.col(key).cast("string"), F.col("chunk_no").cast("string"))
    return (per_chunk.select(F.lit("analysis").alias("stage"), k.alias("key"), reason.alias("reason"))
            .filter(F.col("reason").isNotNull()))


# fixed value: how a field is found in a broken reply
SALVAGE_FIELD = r'"{key}"\s*:\s*"([^"]*)"'


def salvage_replies(responses: DataFrame) -> DataFrame:
    """Six list fields recovered from a broken reply by pattern (H13): a
    field found gives its value stripped and split on ', ' (a found empty
    value gives ['']), a field not found gives []; ``salvaged`` is false
    when no field was found (the original returns nothing then)."""
    cols = {}
    found = F.lit(False)
    for k in KEYS:
        rx = SALVAGE_FIELD.format(key=k)
        hit = F.regexp_instr(F.col("content"), F.lit(rx)) > 0
        val = py_strip(F.regexp_extract(F.col("content"), rx, 1))
        cols[k] = F.when(hit, F.split(val, config.REPLY_LIST_SEPARATOR)).otherwise(
            F.array().cast("array<string>"))
        found = found | hit
    return responses.withColumns(cols).withColumn("salvaged", F.coalesce(found, F.lit(False)))


def combine_articles(analyses: DataFrame, key: str = "doc",
                     fanout: int = CONCAT_FANOUT) -> DataFrame:
    """One analysis per article (D3): summaries and impacts each joined with
    a trailing blank in chunk order then stripped; the four lists
    concatenated, empty strings dropped, distinct, sorted.

    One two-level aggregate: runs of at most ``fanout`` consecutive chunks
    are combined first (strings in order, lists made distinct), then the
    runs of an article.  No task gathers more than ``fanout`` chunks or
    more list values than an article's distinct ones."""
    def distinct_nonempty(col):
        return F.array_distinct(F.filter(F.flatten(F.collect_list(col)), lambda x: x != ""))

    run = (analyses
           .withColumn("_run", F.floor(F.col("chunk_no") / F.lit(fanout)))
           .groupBy(key, "_run")
           .agg(F.sort_array(F.collect_list(F.struct(
               "chunk_no", *[F.concat(F.col(k), F.lit(" ")).alias(k) for k in TEXT_KEYS]))).alias("_t"),
               *[distinct_nonempty(k).alias(k) for k in LIST_KEYS]))
    run = run.select(key, "_run", *[F.array_join(F.transform("_t", _field(k)), "").alias(k) for k in TEXT_KEYS],
                     *LIST_KEYS)
    art = (run.groupBy(key)
           .agg(F.sort_array(F.collect_list(F.struct("_run", *TEXT_KEYS))).alias("_t"),
                *[F.array_sort(F.array_distinct(F.flatten(F.collect_list(k)))).alias(k) for k in LIST_KEYS]))
    return art.select(key, *[py_strip(F.array_join(F.transform("_t", _field(k)), "")).alias(k)
                             if k in TEXT_KEYS else F.col(k) for k in KEYS])


def _field(name):
    return lambda x: x[name]


def analysed_articles(articles: DataFrame, combined: DataFrame, key: str = "doc") -> DataFrame:
    """Articles with at least one analysed chunk, with their analysis."""
    return articles.join(combined, key, "inner")


def unanalysed_articles(articles: DataFrame, combined: DataFrame, key: str = "doc") -> DataFrame:
    """Articles none of whose chunks was analysed (C6 complement)."""
    return articles.join(combined.select(key), key, "left_anti")
