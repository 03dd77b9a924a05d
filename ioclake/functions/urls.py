"""URL expressions: reference resolution (B2) and http(s) normalisation.

Both are DataFrame transforms that add columns built from Spark SQL
built-ins (regexp_extract, split, aggregate over path segments), so they
run inside codegen and never leave the JVM.

Resolution follows the standard library's ``urljoin`` (RFC 3986 merge with
its quirks: interior empty segments of a relative path are dropped, ``..``
never rises above the root, empty query/fragment are not kept, a different
or non-relative scheme returns the reference unchanged).  A reference whose
authority has unbalanced or invalid brackets is an error row, not a failure.

Normalisation follows the WHATWG URL rules as applied to http(s) URLs:
lower-case scheme and host, other than ASCII labels in punycode, default port dropped, empty path -> '/', dot
segments removed, space and other unsafe characters percent-encoded,
query and fragment kept.  Other schemes, empty hosts, bad ports and URLs
over 2083 characters are rejected with a reason.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ioclake.functions.punycode import ascii_host_sql

# fixed values: schemes the standard library resolves relative references
# for, and schemes whose URLs carry a network location
USES_RELATIVE = ["", "ftp", "http", "gopher", "nntp", "imap", "wais", "file",
                 "https", "shttp", "mms", "prospero", "rtsp", "rtsps", "rtspu",
                 "sftp", "svn", "svn+ssh", "ws", "wss"]
USES_NETLOC = ["", "ftp", "http", "gopher", "nntp", "telnet", "imap", "wais",
               "file", "mms", "https", "shttp", "snews", "prospero", "rtsp",
               "rtsps", "rtspu", "rsync", "svn", "svn+ssh", "sftp", "nfs", "git",
               "git+ssh", "ws", "wss", "itms-services"]
MAX_URL_LENGTH = 2083

# RFC 3986 appendix B, with the scheme restricted to the standard syntax.
URL_PARTS = r"^(?:([A-Za-z][A-Za-z0-9+.-]*):)?(?://([^/?#]*))?([^?#]*)(?:\?([^#]*))?(?:#(.*))?$"


def _lit_list(values) -> str:
    return ", ".join("'" + v + "'" for v in values)


def _clean_sql(col: str) -> str:
    # leading C0 controls and spaces are ignored; tab, CR, LF removed anywhere
    return (f"regexp_replace(regexp_replace({col}, '[\\\\t\\\\r\\\\n]', ''), "
            f"'^[\\\\x00-\\\\x20]+', '')")


def _unparse_sql(scheme: str, netloc: str, path: str, query: str, frag: str) -> str:
    return (
        f"concat(if({scheme} <> '', concat({scheme}, ':'), ''), "
        f"if({netloc} <> '' or ({scheme} in ({_lit_list(USES_NETLOC)}) and left({path}, 2) <> '//'), "
        f"concat('//', {netloc}, if({path} <> '' and left({path}, 1) <> '/', concat('/', {path}), {path})), "
        f"{path}), "
        f"if({query} <> '', concat('?', {query}), ''), "
        f"if({frag} <> '', concat('#', {frag}), ''))"
    )


def _bad_brackets_sql(netloc: str) -> str:
    return (f"((instr({netloc}, '[') > 0) <> (instr({netloc}, ']') > 0) "
            f"or (instr({netloc}, '[') > 0 and not {netloc} rlike "
            f"'\\\\[(?:[0-9A-Fa-f:.]+|v[0-9A-Fa-f]+\\\\.[^\\\\]]+)\\\\]'))")


def _let(value_sql: str, var: str, body_sql: str) -> str:
    """Bind ``value_sql`` to ``var`` once (a one-element transform), so the
    value is computed once however often ``body_sql`` uses it, and the
    optimizer never copies it into pushed-down filters."""
    return f"transform(array({value_sql}), {var} -> {body_sql})[0]"


def resolve_url_sql(base: str, href: str) -> str:
    """SQL expression: struct<url string, error string> for ``href``
    resolved against ``base`` (both SQL expressions)."""
    p = URL_PARTS.replace("\\", "\\\\")
    parts = ", ".join(
        f"'{side}{name}', " + (f"lower(regexp_extract(c.{side}, '{p}', {i}))" if name == "s"
                              else f"regexp_extract(c.{side}, '{p}', {i})")
        for side in ("b", "h") for i, name in enumerate(["s", "n", "p", "q", "f"], start=1))
    merge = """aggregate(sg, cast(array() as array<string>),
                 (acc, x) -> case when x = '..' then slice(acc, 1, greatest(size(acc) - 1, 0))
                                  when x = '.' then acc
                                  else concat(acc, array(x)) end)"""
    res = _let(merge, "r0", "if(element_at(sg, -1) in ('.', '..'), concat(r0, array('')), r0)")
    mpath = _let(f"array_join({res}, '/')", "j", "if(j = '', '/', j)")
    body = f"""named_struct(
      'url', case
        when {base} is null or {base} = '' then {href}
        when {href} is null or {href} = '' then {base}
        when {_bad_brackets_sql('u.hn')} or {_bad_brackets_sql('u.bn')} then null
        when s <> u.bs or s not in ({_lit_list(USES_RELATIVE)}) then {href}
        when s in ({_lit_list(USES_NETLOC)}) and u.hn <> '' then {_unparse_sql('s', 'u.hn', 'u.hp', 'u.hq', 'u.hf')}
        when u.hp = '' then {_unparse_sql('s', 'u.bn', 'u.bp', "if(u.hq = '', u.bq, u.hq)", 'u.hf')}
        else {_unparse_sql('s', 'u.bn', 'mp', 'u.hq', 'u.hf')}
      end,
      'error', case when {href} is null then 'null_href'
                    when {_bad_brackets_sql('u.hn')} or {_bad_brackets_sql('u.bn')} then 'invalid_ipv6'
               end)"""
    segs = ("if(left(u.hp, 1) = '/' or size(s0) < 3, s0, "
            "concat(array(s0[0]), filter(slice(s0, 2, size(s0) - 2), x -> x <> ''), array(element_at(s0, -1))))")
    s0 = "if(left(u.hp, 1) = '/', split(u.hp, '/'), concat(bparts, split(u.hp, '/')))"
    bparts = "if(element_at(bp0, -1) <> '', slice(bp0, 1, size(bp0) - 1), bp0)"
    inner = _let(segs, "sg", _let(mpath, "mp", body))
    inner = _let(s0, "s0", inner)
    inner = _let(bparts, "bparts", inner)
    inner = _let("split(u.bp, '/')", "bp0", inner)
    inner = _let("if(u.hs = '', u.bs, u.hs)", "s", inner)
    inner = _let(f"named_struct({parts})", "u", inner)
    return _let(f"named_struct('b', {_clean_sql(base)}, 'h', {_clean_sql(href)})", "c", inner)


def with_resolved_url(df: DataFrame, base: str, href: str, out: str = "abs_url",
                      error: str = "resolve_error") -> DataFrame:
    """Add ``out`` = ``href`` resolved against ``base`` and ``error`` (null
    when fine, else a reason; ``out`` is then null)."""
    r = F.expr(resolve_url_sql(f"`{base}`", f"`{href}`"))
    # generator barrier: filters on the result stay above the computation
    return df.select("*", F.inline(F.array(F.struct(r["url"].alias(out), r["error"].alias(error)))))


# Characters percent-encoded in each component (besides controls, space and
# everything outside printable ASCII).
_PATH_ENC = "\"<>`{}"
_QUERY_ENC = "\"<>'"
_FRAG_ENC = "\"<>`"


def _pct_sql(col: str, extra: str) -> str:
    cls = "[^\\\\x21-\\\\x7E" + "]|[" + extra.replace("'", "\\'") + "]"
    return (f"if({col} rlike '{cls}', array_join(transform(regexp_extract_all({col}, '(?s).', 0), "
            f"c -> if(c rlike '{cls}', regexp_replace(hex(encode(c, 'UTF-8')), '(..)', '%$1'), c)), ''), "
            f"{col})")


def normalize_url_sql(url: str) -> str:
    """SQL expression: struct<url string, reason string> for ``url``."""
    dots = "('..', '.%2e', '%2e.', '%2e%2e')"
    walk = f"""aggregate(ps, cast(array() as array<string>),
                 (acc, x) -> case when lower(x) in {dots} then slice(acc, 1, greatest(size(acc) - 1, 0))
                                  when lower(x) in ('.', '%2e') then acc
                                  else concat(acc, array(x)) end)"""
    npath = _let(walk, "pr",
                 f"concat('/', array_join(if(lower(element_at(ps, -1)) in ('..', '.%2e', '%2e.', '%2e%2e', '.', '%2e'), "
                 f"concat(pr, array('')), pr), '/'))")
    rej = """case
        when o is null then 'null_url'
        when k.sch not in ('http', 'https') then 'scheme'
        when k.host = '' then 'host'
        when left(k.host, 1) = '[' and not k.host rlike '^\\\\[[0-9a-f:.]+\\\\]$' then 'host'
        when left(k.host, 1) <> '[' and k.host rlike '[\\\\x00-\\\\x20#%/:<>?@\\\\[\\\\]^|\\\\x7F]' then 'host'
        when k.port <> '' and (k.portn is null or k.portn > 65535) then 'port'
      end"""
    built = f"""concat(k.sch, '://', if(k.ui <> '', concat(k.ui, '@'), ''), k.host,
             if(k.port <> '' and k.portn <> if(k.sch = 'http', 80, 443), concat(':', cast(k.portn as string)), ''),
             {_pct_sql('np', _PATH_ENC)},
             if(k.has_q, concat('?', {_pct_sql('k.q', _QUERY_ENC)}), ''),
             if(k.has_f, concat('#', {_pct_sql('k.f', _FRAG_ENC)}), ''))"""
    body = _let(rej, "rj", _let(
        f"if(rj is null, {_let(npath, 'np', built)}, null)", "bu",
        f"named_struct('url', if(rj is null and length(bu) <= {MAX_URL_LENGTH}, bu, null), "
        f"'reason', coalesce(rj, if(length(bu) > {MAX_URL_LENGTH}, 'too_long', null)))"))
    body = _let("split(substring(if(k.path = '', '/', k.path), 2), '/')", "ps", body)
    fields = """named_struct(
        'sch', h.sch, 'ui', h.ui, 'host', h.host,
        'port', h.port, 'portn', if(h.port rlike '^[0-9]{1,5}$', cast(h.port as int), null),
        'path', regexp_extract(h.tail, '^([^?#]*)', 1),
        'has_q', h.tail rlike '^[^#]*\\\\?',
        'q', regexp_extract(h.tail, '^[^?#]*\\\\?([^#]*)', 1),
        'has_f', instr(h.tail, '#') > 0,
        'f', substring(h.tail, instr(h.tail, '#') + 1))"""
    body = _let(fields, "k", body)
    # a host with other characters in ASCII; one that cannot be so is no host
    named = ("named_struct('sch', h.sch, 'ui', h.ui, 'tail', h.tail, 'host', coalesce(" + ascii_host_sql("h.host")
             + ", ''), 'port', substring(h.hp, length(h.host) + 2))")
    body = _let(named, "h", body)
    host = """named_struct('sch', a.sch, 'tail', a.tail, 'ui', a.ui, 'hp', a.hp,
        'host', lower(if(left(a.hp, 1) = '[', regexp_extract(a.hp, '^(\\\\[[^\\\\]]*\\\\])', 1),
                         regexp_extract(a.hp, '^([^:]*)', 1))))"""
    body = _let(host, "h", body)
    auth = """named_struct('sch', r.sch,
        'tail', substring(r.rest, length(regexp_extract(r.rest, '^([^/?#]*)', 1)) + 1),
        'ui', if(instr(regexp_extract(r.rest, '^([^/?#]*)', 1), '@') > 0,
                 substring(regexp_extract(r.rest, '^([^/?#]*)', 1), 1,
                           length(regexp_extract(r.rest, '^([^/?#]*)', 1))
                           - length(substring_index(regexp_extract(r.rest, '^([^/?#]*)', 1), '@', -1)) - 1), ''),
        'hp', substring_index(regexp_extract(r.rest, '^([^/?#]*)', 1), '@', -1))"""
    body = _let(auth, "a", body)
    rest = """named_struct('sch', sc,
        'rest', regexp_replace(regexp_replace(substring(u, length(sc) + 2), '\\\\\\\\', '/'), '^/+', ''))"""
    body = _let(rest, "r", body)
    body = _let("lower(regexp_extract(u, '^([A-Za-z][A-Za-z0-9+.-]*):', 1))", "sc", body)
    clean = (f"regexp_replace(regexp_replace(o, '[\\\\t\\\\r\\\\n]', ''), "
             f"'^[\\\\x00-\\\\x20]+|[\\\\x00-\\\\x20]+$', '')")
    body = _let(clean, "u", body)
    return _let(url, "o", body)


def with_normalized_url(df: DataFrame, url: str, out: str = "url_norm",
                        reason: str = "url_reject") -> DataFrame:
    """Add ``out`` = normalised http(s) URL, or null with ``reason`` set."""
    r = F.expr(normalize_url_sql(f"`{url}`"))
    # generator barrier: filters on the result stay above the computation
    return df.select("*", F.inline(F.array(F.struct(r["reason"].alias(reason), r["url"].alias(out)))))
