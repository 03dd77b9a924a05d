"""The ledger of what has been asked (H14, A3): attempts per request, what
is still to be asked, and when.

A request is done once an attempt has succeeded or ``max_attempts`` have been
made.  The next attempt waits a random exponential time between one second and a
minute; the random part is a hash of the request and the attempt, so every run
computes the same times.  Recording is idempotent: of an attempt that is
recorded twice the first stays.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ioclake import config
from ioclake.operators.analysis import classify_replies
from ioclake.sources.staging import written

SUCCESS = ["a", "b", "c", "e"]
#: bounds of a wait (fixed values of the job)
LEAST_MS, MOST_MS = 1000, 60_000
KEYS = ["doc", "chunk_no"]
SCHEMA = "doc string, chunk_no int, attempt int, reply_class string, asked_ms long"


def wait_ms(keys, attempt: Column) -> Column:
    """Milliseconds to wait before an attempt (none before the first)."""
    draw = F.conv(F.substring(F.md5(F.concat_ws("#", *[F.col(k).cast("string") for k in keys],
                                                attempt.cast("string")).cast("binary")), 1, 4), 16, 10).cast("long")
    top = F.least(F.lit(MOST_MS), F.lit(LEAST_MS) * F.pow(F.lit(2), attempt - 1)).cast("long")
    return F.when(attempt > 1, LEAST_MS + F.floor((top - LEAST_MS) * draw / 65536)).otherwise(0).cast("long")


def due(requests: DataFrame, ledger: DataFrame, keys=KEYS, max_attempts: int = config.MAX_ATTEMPTS) -> DataFrame:
    """(requests..., attempt, not_before_ms): the next attempt of each request
    that has neither succeeded nor been tried ``max_attempts`` times."""
    tried = ledger.groupBy(*keys).agg(F.max("attempt").alias("_last"), F.max("asked_ms").alias("_asked"),
                                      F.bool_or(F.col("reply_class").isin(SUCCESS)).alias("_done"))
    left = requests.join(tried, list(keys), "left").filter(
        ~F.coalesce("_done", F.lit(False)) & (F.coalesce("_last", F.lit(0)) < max_attempts))
    attempt = F.coalesce("_last", F.lit(0)) + 1
    return left.select(*requests.columns, attempt.alias("attempt"),
                       (F.coalesce("_asked", F.lit(0)) + wait_ms(keys, attempt)).alias("not_before_ms"))


def record(ledger: DataFrame, attempts: DataFrame, keys=KEYS) -> DataFrame:
    """The ledger with attempts added that it does not hold."""
    place = [*keys, "attempt"]
    new = attempts.select(*ledger.columns).groupBy(*place).agg(F.min(F.struct("asked_ms", "reply_class")).alias("_r")) \
        .select(*place, "_r.reply_class", "_r.asked_ms")
    return ledger.unionByName(new.join(ledger.select(*place), place, "left_anti").select(*ledger.columns))


def ask_all(requests: DataFrame, ask: Callable[[DataFrame], DataFrame], ledger: DataFrame | None = None,
            max_attempts: int = config.MAX_ATTEMPTS) -> DataFrame:
    """Rounds until nothing is due.  ``ask`` answers (requests..., attempt)
    with (doc, chunk_no, attempt, status, content).  The ledger is written after
    every round, so a run that is started again goes on from there."""
    spark = requests.sparkSession
    ledger = spark.createDataFrame([], SCHEMA) if ledger is None else ledger
    for _ in range(max_attempts):
        todo = written(due(requests, ledger, KEYS, max_attempts), "due")
        if todo.isEmpty():
            break
        replies = classify_replies(ask(todo)).select(*KEYS, "attempt", "reply_class")
        asked = replies.join(todo.select(*KEYS, "attempt", F.col("not_before_ms").alias("asked_ms")), [*KEYS, "attempt"])
        ledger = written(record(ledger, asked), "ledger")
    return ledger
