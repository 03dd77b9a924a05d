"""Token, sentence and chunk tables (token rule, H7, H8).

All three are row-local generators (posexplode over an array built in the
same projection): no shuffle, and each document is handled by one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ioclake import config
from ioclake.functions.text import sentences as sentence_array
from ioclake.functions.text import let
from ioclake.functions.text import tokens as token_array


def _keys(key) -> list[str]:
    return [key] if isinstance(key, str) else list(key)


def tokenize(docs: DataFrame, key="doc", text: str = "text") -> DataFrame:
    """(key, pos, token): tokens in order, 0-based position."""
    return docs.select(*_keys(key), F.posexplode(token_array(text)).alias("pos", "token"))


def split_sentences(docs: DataFrame, key="doc", text: str = "text") -> DataFrame:
    """(key, sent, sent_text): sentences in order (H7)."""
    return docs.select(*_keys(key), F.posexplode(sentence_array(text)).alias("sent", "sent_text"))


# One raw word with the white space before it; the last also takes what
# follows, so the pieces of a text joined are the text.
PIECE = r"[ \t\n\x0B\f\r]*[^ \t\n\x0B\f\r]+(?:[ \t\n\x0B\f\r]+\z)?"


def chunk_array(pieces, max_tokens: int) -> F.Column:
    """Consecutive slices of at most ``max_tokens`` entries; none for none."""
    def body(t):
        n = F.size(t)
        starts = F.when(n == 0, F.array().cast("array<int>")).otherwise(
            F.sequence(F.lit(0), F.ceil(n / F.lit(max_tokens)).cast("int") - 1))
        return F.transform(starts, lambda i: F.slice(t, i * max_tokens + 1, max_tokens))
    return let(pieces, body)


def chunk_tokens(docs: DataFrame, key="doc", text: str = "text",
                 max_tokens: int = config.CHUNK_TOKENS) -> DataFrame:
    """(key, chunk_no, chunk, n_tokens): the text cut into consecutive
    chunks of at most ``max_tokens`` words (H8).  Chunks are cut from the text
    itself: joined they give it back.  Blank text gives no chunk."""
    keys = _keys(key)
    pieces = F.regexp_extract_all(F.coalesce(F.col(text), F.lit("")), F.lit(PIECE), 0)
    return (docs.select(*keys, F.posexplode(chunk_array(pieces, max_tokens)).alias("chunk_no", "_p"))
            .select(*keys, "chunk_no", F.array_join("_p", "").alias("chunk"), F.size("_p").alias("n_tokens")))
