"""Pages as a parser sees them, in time linear in the page.

A page is cut into tokens by one left-to-right pass: comments, raw-text elements
(scripts, titles, ... up to their own closing tag or the end), tags, text.  Every
alternative of the pattern takes all it has looked at and none goes back, so
neither an unclosed quote nor a tag of any length makes it look twice.  Quotes
open a value only after an equals sign.  Joined, the tokens are the page.

Structure (articles, menus, body) is a fold over the few tokens that matter; its
state is a handful of numbers, and what it gives out is gathered in blocks, so no
step copies what all steps before have made.

All functions return ``Column`` objects of Spark SQL built-ins.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ioclake.functions.text import decode_entities, fold_out, let, none_of, py_strip

_W = r" \t\n\f\r"  # white space inside tags
_NAME = rf"(?:=[^{_W}/>=]*+|[^{_W}/>=]++)"
_VALUE = rf"""(?:[{_W}]*+=[{_W}]*+(?:"[^"]*+(?:"|\z)|'[^']*+(?:'|\z)|[^{_W}>"'][^{_W}>]*+)?+)?+"""
_ATTRIBUTES = rf"(?:[{_W}/]++|{_NAME}{_VALUE})*+"
#: elements whose inside is text up to their own closing tag
RAW_TEXT = ["script", "style", "textarea", "title", "xmp", "iframe", "noembed", "noframes"]
TOKEN = (r"(?i)<!--(?:-?>|(?s:.*?)(?:--!?>|\z))"
         rf"|<({'|'.join(RAW_TEXT)})(?=[{_W}/>]){_ATTRIBUTES}(?:>(?s:.*?)(?:</\1(?=[{_W}/>])[^>]*+(?:>|\z)|\z)|\z)"
         rf"|</?[a-z][^{_W}/>]*+{_ATTRIBUTES}(?:>|\z)"
         r"|<[!?/][^>]*+(?:>|\z)"
         r"|[^<]++|<[^<]*+")
MARKUP = "^<[a-zA-Z!?/]"

# The attribute named exactly href: those before it are passed one by one.
_HREF = (rf"(?i)^<a(?:[{_W}/]++|(?!href[{_W}/>=]){_NAME}{_VALUE})*+href[{_W}]*+=[{_W}]*+"
         rf"""("[^"]*+"|'[^']*+'|[^{_W}>"'][^{_W}>]*+)""")

#: elements that hold no article text; a page header only outside articles
BOILERPLATE = ["noscript", "template", "nav", "footer", "aside"]
_MARK = rf"(?i)^<(/?(?:{'|'.join(BOILERPLATE)}|header|article|body|html))(?=[{_W}/>])"
# tags that end a text block
_BLOCK = rf"(?i)^<(?:br|/?(?:p|h[1-6]|li|div|tr|blockquote|section|article))(?=[{_W}/>])"
#: what stands for other tags until the text is decoded, and around links
_TAG, _LINK, _UNLINK = "\x00", "\x01", "\x02"
#: weights of a block: a word outside links, a word in links, the block itself
OWN, LINKED, EACH = 1, 3, 6


def html_tokens(html) -> Column:
    """array<string> of tokens; joined they are the page (null: none)."""
    return F.regexp_extract_all(F.coalesce(html, F.lit("")), F.lit(TOKEN), F.lit(0))


def token_hrefs(tokens) -> Column:
    """Raw href values, quotes included, of the <a> tags that have one."""
    anchors = F.filter(tokens, lambda t: t.rlike(rf"(?i)^<a[{_W}/>]") & t.endswith(">"))
    return F.filter(F.transform(anchors, lambda t: F.regexp_extract(t, _HREF, 1)), lambda h: h != "")


def href_value(raw) -> Column:
    """A raw href without its quotes, decoded."""
    quoted = raw.rlike("^[\"']")
    return decode_entities(F.when(quoted, F.substring(raw, F.lit(2), F.length(raw) - 2)).otherwise(raw))


def token_title(tokens) -> Column:
    """Decoded, whitespace-squeezed inside of the first <title>, or ''."""
    first = F.filter(tokens, lambda t: t.rlike(rf"(?i)^<title[{_W}/>]"))
    inside = F.regexp_extract(F.get(first, 0), rf"(?is)^<title{_ATTRIBUTES}>(.*?)(?:</title(?=[{_W}/>])[^>]*+>?+\z|\z)", 1)
    return py_strip(F.regexp_replace(decode_entities(F.coalesce(inside, F.lit(""))), r"\s+", " "))


def _structure_step(s, m):
    """One tag that opens or closes a part of the page.

    A boilerplate element is skipped up to its own closing tag, those of its
    name inside it counted; the end of the article or body around it ends it
    too.  The state's code says what follows: 0 skipped, 1 page, 2 body,
    3 article."""
    name, skips = m["name"], s.skip != ""
    closing = F.concat(F.lit("/"), s.skip)
    ends_page = name.isin("/body", "/html")
    opens = ~skips & (name.isin(BOILERPLATE) | ((name == "header") & (s.art == 0)))
    out_of_article = skips & (name == "/article") & (s.inner == 0) & (s.art > 0)
    over = (skips & (name == closing) & (s.depth == 1)) | out_of_article | ends_page
    skip = F.when(opens, name).when(over, F.lit("")).otherwise(s.skip)
    depth = F.when(opens, 1).when(over, 0).when(skips & (name == s.skip), s.depth + 1) \
        .when(skips & (name == closing), s.depth - 1).otherwise(s.depth)
    inner = F.when(opens | ends_page, 0).when(skips & (name == "article"), s.inner + 1) \
        .when(skips & (name == "/article") & (s.inner > 0), s.inner - 1).otherwise(s.inner)
    art = F.when(ends_page, 0).when(~skips & (name == "article"), s.art + 1) \
        .when((~skips | out_of_article) & (name == "/article"), F.greatest(s.art - 1, F.lit(0))).otherwise(s.art)
    body = F.when(~skips & (name == "body"), 1).when(ends_page & (s.body == 1), 2).otherwise(s.body)
    code = F.when(skip != "", 0).when(art > 0, 3).when(body == 1, 2).otherwise(1)
    state = F.struct(skip.alias("skip"), depth.alias("depth"), inner.alias("inner"), art.alias("art"),
                     body.alias("body"), code.alias("code"))
    new = F.struct(m["at"].alias("at"), code.alias("code"))
    return state, F.when(code != s.code, F.array(new)).otherwise(none_of(new))


def token_parts(tokens) -> Column:
    """array<struct<at, upto, code>>: runs of tokens by what they belong to,
    0 boilerplate, 1 page, 2 body, 3 article."""
    marks = F.filter(F.transform(tokens, lambda t, i: F.struct(i.alias("at"), F.lower(F.regexp_extract(t, _MARK, 1)).alias("name"))),
                     lambda m: m["name"] != "")
    zero = F.lit(0)
    start = F.struct(F.lit("").alias("skip"), zero.alias("depth"), zero.alias("inner"), zero.alias("art"),
                     zero.alias("body"), F.lit(1).alias("code"))
    turns = F.concat(F.array(F.struct(zero.alias("at"), F.lit(1).alias("code"))),
                     fold_out(marks, start, _structure_step))
    return let(turns, lambda ts: F.transform(ts, lambda t, k: F.struct(
        t["at"].alias("at"), F.coalesce(F.get(ts, k + 1)["at"], F.size(tokens)).alias("upto"), t["code"].alias("code"))))


def _piece(t) -> Column:
    """What a token adds to the text."""
    return (F.when(~t.rlike(MARKUP), F.translate(t, _TAG + _LINK + _UNLINK, ""))
            .when(t.rlike(_BLOCK), F.lit("\n"))
            .when(t.rlike(rf"(?i)^<a[{_W}/>]"), F.lit(_LINK)).when(t.rlike(rf"(?i)^</a[{_W}/>]"), F.lit(_UNLINK))
            .otherwise(F.lit(_TAG)))


def _tidy(text) -> Column:
    """Decoded text, blanks squeezed, lines trimmed, links still marked."""
    s = F.translate(decode_entities(text), _TAG, "")
    s = F.regexp_replace(s, r"[ \t\f\r\x0B]+", " ")
    return F.regexp_replace(s, r" ?\n[ \n]*", "\n")


def _unmarked(text) -> Column:
    return py_strip(F.regexp_replace(F.translate(text, _LINK + _UNLINK, ""), r" ?\n[ \n]*", "\n"))


def _word_count(text) -> Column:
    return F.size(F.filter(F.split(text, " "), lambda w: w != ""))


def block_weights(lines) -> Column:
    """array<int>: a block's words outside links, less the words in links and
    a fee for each block, smoothed with its neighbours (1, 2, 1)."""
    def weight(line):
        own = F.regexp_replace(line, f"{_LINK}[^{_UNLINK}]*+", "")
        every, alone = (_word_count(F.translate(x, _LINK + _UNLINK, "")) for x in (line, own))
        return alone * OWN - (every - alone) * LINKED - EACH

    def smooth(xs):
        return F.transform(xs, lambda x, i: x * 2 + F.coalesce(F.get(xs, i - 1), F.lit(0)) + F.coalesce(F.get(xs, i + 1), F.lit(0)))

    return let(F.transform(lines, weight), smooth)


def best_run(weights) -> Column:
    """struct<first, last, total> of the consecutive blocks of the largest
    total; of equal ones the first to end, and of those the shortest."""
    start = F.struct(F.lit(0).alias("sum"), F.lit(0).alias("since"), F.lit(0).alias("total"),
                     F.lit(-1).alias("first"), F.lit(-1).alias("last"))

    def step(s, x):
        going = s["sum"] > 0
        total = F.when(going, s["sum"] + x["w"]).otherwise(x["w"])
        since = F.when(going, s["since"]).otherwise(x["i"])
        more = total > s["total"]
        return F.struct(total.alias("sum"), since.alias("since"), F.when(more, total).otherwise(s["total"]).alias("total"),
                        F.when(more, since).otherwise(s["first"]).alias("first"),
                        F.when(more, x["i"]).otherwise(s["last"]).alias("last"))

    numbered = F.transform(weights, lambda w, i: F.struct(w.alias("w"), i.alias("i")))
    return F.aggregate(numbered, start, step, lambda s: F.struct(
        s["first"].alias("first"), s["last"].alias("last"), s["total"].alias("total")))


def content_run(text) -> Column:
    """struct<blocks, first, last, text> of a text with marked links: the
    best run of its blocks, or all of them where none is worth anything."""
    def picked(lines):
        def run(r):
            some = F.when(r["first"] >= 0, F.slice(lines, r["first"] + 1, r["last"] - r["first"] + 1)).otherwise(lines)
            return F.struct(F.size(lines).alias("blocks"), r["first"].alias("first"), r["last"].alias("last"),
                            _unmarked(F.array_join(some, "\n")).alias("text"))
        return let(best_run(block_weights(lines)), run)

    return let(F.filter(F.split(text, "\n"), lambda x: F.trim(F.translate(x, _LINK + _UNLINK, "")) != ""), picked)


def parts_text(tokens, parts, code) -> Column:
    """Text of the parts of one code, links marked."""
    runs = F.transform(F.filter(parts, lambda p: p["code"] == code), lambda p: F.concat(
        F.transform(F.slice(tokens, p["at"] + 1, p["upto"] - p["at"]), _piece), F.array(F.lit("\n"))))
    return _tidy(F.array_join(F.flatten(runs), ""))


def token_text(tokens) -> Column:
    """Main text: that of the articles; without one, the best run of blocks of
    the body, or of the page if that has no body either."""
    def of(parts):
        best = F.array_max(F.transform(parts, lambda p: p["code"]))
        return let(best, lambda b: let(parts_text(tokens, parts, b), lambda text: F.when(b == 3, _unmarked(text)).otherwise(
            content_run(text)["text"])))
    return let(token_parts(tokens), of)


def token_content(tokens) -> Column:
    """``content_run`` over the whole page, its structure disregarded."""
    text = F.array_join(F.transform(tokens, _piece), "")
    return content_run(_tidy(text))


def html_title(html) -> Column:
    return let(html_tokens(html), token_title)


def html_main_text(html) -> Column:
    return let(html_tokens(html), token_text)
