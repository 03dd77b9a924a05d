"""Indicators of compromise: per-token patterns (H5), URL / e-mail tokens
(H6), mention-derived IOCs (B13) and their ordered union (G2)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ioclake import config
from ioclake.functions.text import tokens as token_array

# fixed values: the indicator patterns, in matcher order, with Python's
# Unicode-aware \b and \d spelled out, so Java and RE2 agree with Python:
# \b -> (^|[^\p{L}\p{N}_]) ... ($|[^\p{L}\p{N}_]),  \d -> \p{Nd}
IOC_TOKEN_PATTERNS = [
    ("IP_ADDRESS", r"(^|[^\p{L}\p{N}_])(\p{Nd}{1,3}\.){3}\p{Nd}{1,3}($|[^\p{L}\p{N}_])"),
    ("MD5_HASH", r"(^|[^\p{L}\p{N}_])[a-fA-F0-9]{32}($|[^\p{L}\p{N}_])"),
    ("SHA1_HASH", r"(^|[^\p{L}\p{N}_])[a-fA-F0-9]{40}($|[^\p{L}\p{N}_])"),
    ("SHA256_HASH", r"(^|[^\p{L}\p{N}_])[a-fA-F0-9]{64}($|[^\p{L}\p{N}_])"),
    ("CVE", r"CVE-\p{Nd}{4}-\p{Nd}{4,7}"),
]
EMAIL_TOKEN = r"^[^@]+@[^@]+\.[A-Za-z]{2,}$"


def candidate(tok: F.Column) -> F.Column:
    """Cheap test every indicator needs to pass: long enough for a hash, or
    holding '.', '@', ':' or 'CVE-'.  Most tokens are words and skip all
    regex work."""
    return ((F.length(tok) >= 32) | (F.instr(tok, ".") > 0) | (F.instr(tok, "@") > 0)
            | (F.instr(tok, ":") > 0) | (F.instr(tok, "CVE-") > 0))


def like_url(tok: F.Column) -> F.Column:
    """Token looks like a URL: scheme prefix, www. prefix, or host.tld with
    a known top-level domain (any two letters, or a generic one)."""
    last = F.substring_index(F.substring_index(tok, ".", -1), ":", 1)
    tld_ok = (last.endswith("/")
              | last.rlike(r"^[a-z]{2}$")
              | last.isin(config.URL_GENERIC_TLDS))
    return (F.when(tok.startswith("http://") | tok.startswith("https://"), True)
            .when(tok.startswith("www.") & (F.length(tok) >= 5), True)
            .when(tok.startswith(".") | tok.endswith("."), False)
            .when(F.instr(tok, "@") > 0, False)
            .when(F.instr(tok, ".") == 0, False)
            .otherwise(tld_ok))


def like_email(tok: F.Column) -> F.Column:
    return tok.rlike(EMAIL_TOKEN)


def _candidates(docs: DataFrame, key: str, text: str) -> DataFrame:
    return docs.select(key, F.posexplode(token_array(text)).alias("pos", "value")).filter(candidate(F.col("value")))


def token_iocs(docs: DataFrame, key: str = "doc", text: str = "text") -> DataFrame:
    """(key, pos, src_rank, pat_rank, type, value) from one pass over the
    tokens: pattern hits (src_rank 1, one row per matching pattern, H5)
    and URL-like else e-mail-like tokens (src_rank 2, H6)."""
    v = F.col("value")

    def hit(src, rank, name):
        return F.struct(F.lit(src).alias("src_rank"), F.lit(rank).alias("pat_rank"), F.lit(name).alias("type"))

    hits = F.array(*[F.when(v.rlike(rx), hit(1, i, name)) for i, (name, rx) in enumerate(IOC_TOKEN_PATTERNS)],
                   F.when(like_url(v), hit(2, 0, "URL")).when(like_email(v), hit(2, 0, "Email")))
    return (_candidates(docs, key, text)
            .select(key, "pos", "value", F.explode(F.filter(hits, lambda h: h.isNotNull())).alias("_h"))
            .select(key, "pos", "_h.src_rank", "_h.pat_rank", "_h.type", "value"))


def pattern_iocs(docs: DataFrame, key: str = "doc", text: str = "text") -> DataFrame:
    """(key, pos, pat_rank, type, value): one row per token and matching
    pattern, value = the whole token (H5)."""
    return (token_iocs(docs, key, text).filter(F.col("src_rank") == 1)
            .select(key, "pos", "pat_rank", "type", "value"))


def url_email_iocs(docs: DataFrame, key: str = "doc", text: str = "text") -> DataFrame:
    """(key, pos, type, value): URL-like tokens, else e-mail-like (H6)."""
    return (token_iocs(docs, key, text).filter(F.col("src_rank") == 2)
            .select(key, "pos", "type", "value"))


def mention_iocs(mentions: DataFrame, key: str = "doc", labels=None) -> DataFrame:
    """(key, sent, pos, type, value) from mentions with an IOC label."""
    labels = config.IOC_LABELS if labels is None else labels
    return (mentions.filter(F.col("label").isin(labels))
            .select(key, "sent", "pos", F.col("label").alias("type"), F.col("text").alias("value")))


def all_iocs(mention_part: DataFrame, token_part: DataFrame, key: str = "doc") -> DataFrame:
    """Union of the IOC sources, duplicates kept, ordered by
    (src_rank, sent, pos, pat_rank) within a document (G2): mention-derived
    first, then pattern hits, then URL/e-mail tokens (``token_part`` is
    ``token_iocs``: both token sources from one pass)."""
    m = mention_part.select(key, F.lit(0).alias("src_rank"), F.col("sent").cast("long").alias("sent"),
                            F.col("pos").cast("long").alias("pos"), F.lit(0).alias("pat_rank"), "type", "value")
    t = token_part.select(key, "src_rank", F.lit(0).cast("long").alias("sent"),
                          F.col("pos").cast("long").alias("pos"), "pat_rank", "type", "value")
    return m.unionByName(t)
