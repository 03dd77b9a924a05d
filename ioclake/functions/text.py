"""Text column expressions: tokens, sentences, trimming, character references.

All functions return ``Column`` objects built from Spark SQL built-ins so
they stay inside whole-stage codegen.
"""

from __future__ import annotations

from html.entities import name2codepoint

from pyspark.sql import Column
from pyspark.sql import functions as F

# Python's str.strip() default set restricted to ASCII whitespace.
PY_WHITESPACE = " \t\n\r\x0b\x0c"

# Whitespace for tokens and sentences: the ASCII set, spelled out so every
# regex engine reads it the same way.
WS = r"[ \t\n\x0B\f\r]"
# Token rule: split on whitespace, strip leading non-alphanumerics and
# trailing non-alphanumerics other than '/', drop empties.  Applied to the
# whole text in two passes (token starts, token ends) before one split,
# which is cheaper than two regex calls per token and gives the same tokens.
TOKEN_LEAD = r"(?<![^ \t\n\x0B\f\r])[^\p{L}\p{N} \t\n\x0B\f\r]+"
TOKEN_TRAIL = r"[^\p{L}\p{N}/ \t\n\x0B\f\r]+(?![^ \t\n\x0B\f\r])"
# Sentence rule: break after . ! or ? followed by whitespace.
SENTENCE_SPLIT = r"(?<=[.!?])" + WS + "+"


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def let(value: Column, body) -> Column:
    """``body(v)`` with ``v`` bound to ``value`` computed once.

    A one-element ``transform`` is a let-binding: the optimizer does not
    copy ``value`` into every place ``body`` uses it (it would, for a
    column alias under a pushed-down filter or inside a lambda)."""
    return F.transform(F.array(value), body)[0]


#: steps of a fold whose results are gathered together
FOLD = 256


def none_of(value: Column) -> Column:
    """The empty array of values like ``value``."""
    return F.slice(F.array(value), 1, 0)


def fold_out(items: Column, start: Column, step) -> Column:
    """All that ``step`` gives out over the array ``items``: it maps a state
    and an item to (state, array of results).  Results are gathered by blocks of
    FOLD items, so that no step copies what all steps before have given out."""
    def blocks(xs):
        none = F.flatten(none_of(step(start, F.get(xs, 0))[1]))  # empty, and of the type of results

        def one(acc, x):
            state, out = step(acc.state, x)
            return F.struct(state.alias("state"), F.concat(acc.out, out).alias("out"))

        def block(acc, part):
            done = F.aggregate(part, F.struct(acc.state.alias("state"), none.alias("out")), one)
            return let(done, lambda d: F.struct(d.state.alias("state"), F.concat(acc.outs, F.array(d.out)).alias("outs")))

        count = F.ceil(F.size(xs) / FOLD).cast("int")
        cut = F.when(count > 0, F.transform(F.sequence(F.lit(0), count - 1), lambda k: F.slice(xs, k * FOLD + 1, FOLD)))
        every = F.aggregate(F.coalesce(cut, none_of(xs)), F.struct(start.alias("state"), none_of(none).alias("outs")), block)
        return F.flatten(every.outs)

    return let(items, blocks)


def tokens(text) -> Column:
    """array<string> of tokens of ``text`` (empty array for null text)."""
    s = F.regexp_replace(F.coalesce(_c(text), F.lit("")), TOKEN_LEAD, "")
    s = F.regexp_replace(s, TOKEN_TRAIL, "")
    return F.filter(F.split(s, WS + "+"), lambda t: t != "")


def sentences(text) -> Column:
    """array<string> of sentences; punctuation stays with its sentence."""
    return F.split(F.coalesce(_c(text), F.lit("")), SENTENCE_SPLIT)


def py_strip(col) -> Column:
    """Trim ASCII whitespace at both ends, like Python's ``str.strip()``."""
    return F.btrim(_c(col), F.lit(PY_WHITESPACE))


# Named character references: the standard library's table of the HTML
# entities, plus the XML one; a no-break space becomes a plain blank.
NAMED_ENTITIES = {n: " " if c == 0xA0 else chr(c) for n, c in (*name2codepoint.items(), ("apos", 39))}
#: what one reference looks like, right after its '&'
REFERENCE = r"^(#[0-9]+|#[xX][0-9a-fA-F]+|[A-Za-z][A-Za-z0-9]*);"


def _codepoint_char(num: Column) -> Column:
    """Character of a Unicode code point given as a long column; a null, a
    surrogate, zero or a number beyond Unicode gives U+FFFD."""
    ok = num.between(1, 0x10FFFF) & ~num.between(0xD800, 0xDFFF)
    safe = F.when(ok, num).otherwise(F.lit(0xFFFD))
    return F.decode(F.unhex(F.lpad(F.hex(safe), 8, "0")), "UTF-32")


def _decode_piece(piece: Column) -> Column:
    """Text after one '&' with the reference it opens, if any, replaced."""
    name = F.regexp_extract(piece, REFERENCE, 1)
    digits = F.regexp_replace(F.lower(name), "^#x?0*", "")
    # more digits than any code point has: out of range, not a number error
    digits = F.concat(F.lit("0"), digits)
    number = F.when(F.length(digits) > 8, F.lit("-1")).when(
        F.lower(name).startswith("#x"), F.conv(digits, 16, 10)).otherwise(F.conv(digits, 10, 10)).cast("long")
    known = F.create_map(*[F.lit(x) for pair in NAMED_ENTITIES.items() for x in pair])
    char = F.when(name.startswith("#"), _codepoint_char(number)).when(name != "", F.try_element_at(known, name))
    return F.coalesce(F.concat(char, F.substring(piece, F.length(name) + 2, F.length(piece))),
                      F.concat(F.lit("&"), piece))


def decode_entities(col) -> Column:
    """Decode HTML character references (named, decimal, hex) in one pass:
    the text is cut at every '&' and each piece looked at once, so decoded
    text is never decoded again and nothing in it can fail."""
    def decoded(x):
        parts = F.split(x, "&")
        rest = F.transform(F.slice(parts, 2, F.size(parts)), _decode_piece)
        return F.concat(parts[0], F.array_join(rest, ""))
    return let(_c(col), lambda x: F.when(x.contains("&"), let(x, decoded)).otherwise(x))


def project_once(df, keep, new: dict):
    """``df`` with ``keep`` columns plus ``new`` computed columns, behind a
    generator so a later filter on them cannot be pushed below and
    evaluate the expressions a second time."""
    packed = F.struct(*[e.alias(n) for n, e in new.items()])
    return df.select(*keep, F.inline(F.array(packed)))
