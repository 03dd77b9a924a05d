"""DuckDB SQL for every catalog query (the correctness oracle).

Written independently of the Spark plans, in DuckDB's dialect, over the
pre-registered views (pages, documents, ...).  Where the Spark side uses a
cheaper equivalent (whole-text token passes, a window for span
containment, substring keys for the IOC link), the oracle uses the plain
definition, so agreement checks the rewrite too.
"""

from __future__ import annotations

from html.entities import name2codepoint

from ioclake import config
from ioclake.functions.urls import USES_NETLOC, USES_RELATIVE

WS = r"[ \t\n\x0B\f\r]"
PYWS = "chr(32) || chr(9) || chr(10) || chr(13) || chr(11) || chr(12)"


def _q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _in(values) -> str:
    return "(" + ", ".join(_q(v) for v in values) + ")"


def tokens(col: str) -> str:
    return ("list_filter(list_transform(string_split_regex(coalesce(" + col + ", ''), '" + WS + "+'), "
            r"lambda t: regexp_replace(regexp_replace(t, '^[^\p{L}\p{N}]+', ''), '[^\p{L}\p{N}/]+$', '')), "
            "lambda t: t <> '')")


def sentences(col: str) -> str:
    return ("string_split(regexp_replace(coalesce(" + col + ", ''), '([.!?])" + WS
            + "+', '\\1' || chr(1), 'g'), chr(1))")


def words(col: str) -> str:
    """Raw words, each with the white space before it, the last also with
    what follows: joined they are the text."""
    return f"regexp_extract_all(coalesce({col}, ''), '{WS}*[^{WS[1:]}+(?:{WS}+\\z)?')"


def py_strip(col: str) -> str:
    return f"trim({col}, {PYWS})"


_NAMES = {n: " " if c == 0xA0 else chr(c) for n, c in (*name2codepoint.items(), ("apos", 39))}
_NAME_MAP = (f"map([{', '.join(_q(n) for n in _NAMES)}], [{', '.join(_q(c) for c in _NAMES.values())}])")


def _char(number: str) -> str:
    return (f"CASE WHEN coalesce({number}, -1) BETWEEN 1 AND 1114111 AND NOT {number} BETWEEN 55296 AND 57343 "
            f"THEN chr(CAST({number} AS INTEGER)) ELSE chr(65533) END")


def decode_entities(col: str) -> str:
    ref = lambda rx: f"regexp_extract(p, '^{rx};', 1)"
    dec, hx, name = ref("#0*([0-9]{1,7})"), ref("#[xX]0*([0-9a-fA-F]{1,7})"), ref("([A-Za-z][A-Za-z0-9]*)")
    tail = "substring(p, strpos(p, ';') + 1)"
    piece = (f"CASE WHEN {dec} <> '' THEN {_char(f'TRY_CAST({dec} AS BIGINT)')} || {tail} "
             f"WHEN {hx} <> '' THEN {_char(f'TRY_CAST(concat(chr(48), chr(120), {hx}) AS BIGINT)')} || {tail} "
             f"WHEN regexp_matches(p, '^#([0-9]+|[xX][0-9a-fA-F]+);') THEN chr(65533) || {tail} "
             f"WHEN {name} <> '' AND len(map_extract({_NAME_MAP}, {name})) > 0 "
             f"THEN map_extract({_NAME_MAP}, {name})[1] || {tail} ELSE '&' || p END")
    return (f"CASE WHEN contains({col}, '&') THEN string_split({col}, '&')[1] || array_to_string("
            f"list_transform(string_split({col}, '&')[2:], lambda p: {piece}), '') ELSE {col} END")


# One left-to-right pass that never gives back what it has taken, in a dialect
# without look-ahead: raw-text elements are spelled out by name.
_W = r" \t\n\f\r"
_ATTR = (rf"""(?:=[^{_W}/>=]*|[^{_W}/>=]+)(?:[{_W}]*=[{_W}]*(?:"[^"]*(?:"|\z)|'[^']*(?:'|\z)|[^{_W}>"'][^{_W}>]*)?)?""")
_REST = rf"(?:[{_W}/]+|{_ATTR})*"
_RAW = "|".join(rf"<{n}(?:[{_W}/]{_REST})?(?:>(?s:.*?)(?:</{n}(?:[{_W}/][^>]*)?(?:>|\z)|\z)|\z)"
                for n in ("script", "style", "textarea", "title", "xmp", "iframe", "noembed", "noframes"))
_TOKEN = (rf"(?i)<!--(?:-?>|(?s:.*?)(?:--!?>|\z))|{_RAW}|</?[a-z][^{_W}/>]*{_REST}(?:>|\z)|<[!?/][^>]*(?:>|\z)|[^<]+|<[^<]*")
_DROP = "('noscript', 'template', 'nav', 'footer', 'aside')"
_MARKUP = "'^<[a-zA-Z!?/]'"


def _starts(token: str, names: str) -> str:
    return f"regexp_matches({token}, '(?i)^<(?:{names})[{_W}/>]')"


def _turn() -> str:
    """State after one tag, as a struct; 'out' keeps what follows each tag."""
    n, skips = "m.name", "s.skip <> ''"
    ends = f"{n} IN ('/body', '/html')"
    opens = f"(s.skip = '' AND ({n} IN {_DROP} OR ({n} = 'header' AND s.art = 0)))"
    leaves = f"({skips} AND {n} = '/article' AND s.inn = 0 AND s.art > 0)"
    over = f"(({skips} AND {n} = '/' || s.skip AND s.depth = 1) OR {leaves} OR {ends})"
    skip = f"CASE WHEN {opens} THEN {n} WHEN {over} THEN '' ELSE s.skip END"
    depth = (f"CASE WHEN {opens} THEN 1 WHEN {over} THEN 0 WHEN {skips} AND {n} = s.skip THEN s.depth + 1 "
             f"WHEN {skips} AND {n} = '/' || s.skip THEN s.depth - 1 ELSE s.depth END")
    inn = (f"CASE WHEN {opens} OR {ends} THEN 0 WHEN {skips} AND {n} = 'article' THEN s.inn + 1 "
           f"WHEN {skips} AND {n} = '/article' AND s.inn > 0 THEN s.inn - 1 ELSE s.inn END")
    art = (f"CASE WHEN {ends} THEN 0 WHEN s.skip = '' AND {n} = 'article' THEN s.art + 1 "
           f"WHEN (s.skip = '' OR {leaves}) AND {n} = '/article' THEN greatest(s.art - 1, 0) ELSE s.art END")
    body = f"CASE WHEN s.skip = '' AND {n} = 'body' THEN 1 WHEN {ends} AND s.body = 1 THEN 2 ELSE s.body END"
    code = f"CASE WHEN ({skip}) <> '' THEN 0 WHEN ({art}) > 0 THEN 3 WHEN ({body}) = 1 THEN 2 ELSE 1 END"
    return (f"{{'skip': {skip}, 'depth': {depth}, 'inn': {inn}, 'art': {art}, 'body': {body}, "
            f"'out': list_append(s.out, {{'at': m.at, 'code': {code}}})}}")


def _tidy(text: str) -> str:
    dec = f"replace({text}, chr(0), '')"
    squeezed = f"regexp_replace({dec}, '[ \\t\\f\\r\\x0B]+', ' ', 'g')"
    return f"regexp_replace({squeezed}, ' ?\\n[ \\n]*', chr(10), 'g')"


_LINE = "regexp_replace(regexp_replace({}, '[\\x01\\x02]', '', 'g'), ' ?\\n[ \\n]*', chr(10), 'g')"
_PIECE = (rf"CASE WHEN NOT regexp_matches(tok, {_MARKUP}) THEN regexp_replace(tok, '[\x00\x01\x02]', '', 'g') "
          f"WHEN {_starts('tok', 'br|/?(?:p|h[1-6]|li|div|tr|blockquote|section|article)')} THEN chr(10) "
          f"WHEN {_starts('tok', 'a')} THEN chr(1) WHEN {_starts('tok', '/a')} THEN chr(2) ELSE chr(0) END")

TOKENS_OF_PAGES = f"""pg_tok AS MATERIALIZED (SELECT page_id, url, regexp_extract_all(html, {_q(_TOKEN)}) AS t FROM pages),
pg_rows AS MATERIALIZED (SELECT page_id, unnest(range(len(t))) AS i, unnest(t) AS tok FROM pg_tok)"""


def _content(source: str, name: str) -> str:
    """CTEs over ``source`` (page_id, tidied text with marked links): the
    best run of blocks, all runs held against each other."""
    words = "len(list_filter(string_split({}, ' '), lambda w: w <> ''))"
    plain = "regexp_replace({}, '[\\x01\\x02]', '', 'g')"
    every, alone = words.format(plain.format("line")), words.format(plain.format("regexp_replace(line, '\\x01[^\\x02]*', '', 'g')"))
    return f"""{name}_lines AS MATERIALIZED (
      SELECT page_id, k, line, {alone} - 3 * ({every} - {alone}) - 6 AS x FROM (
        SELECT page_id, unnest(range(len(ls))) AS k, unnest(ls) AS line FROM (
          SELECT page_id, list_filter(string_split(text, chr(10)), lambda l: trim({plain.format('l')}) <> '') AS ls FROM {source}))),
    {name}_sums AS MATERIALIZED (
      SELECT page_id, k, sum(w) OVER (PARTITION BY page_id ORDER BY k) AS upto, w FROM (
        SELECT page_id, k, 2 * x + lag(x, 1, 0) OVER p + lead(x, 1, 0) OVER p AS w FROM {name}_lines
        WINDOW p AS (PARTITION BY page_id ORDER BY k))),
    {name}_best AS (
      SELECT page_id, a AS first, b AS last FROM (
        SELECT f.page_id, f.k AS a, l.k AS b, row_number() OVER (PARTITION BY f.page_id
          ORDER BY l.upto - f.upto + f.w DESC, l.k, f.k DESC) AS rn
        FROM {name}_sums f JOIN {name}_sums l ON l.page_id = f.page_id AND l.k >= f.k WHERE l.upto - f.upto + f.w > 0)
      WHERE rn = 1),
    {name} AS (
      SELECT s.page_id, coalesce(n, 0) AS blocks, coalesce(first, -1) AS first, coalesce(last, -1) AS last,
        {py_strip(_LINE.format("coalesce(body, '')"))} AS text
      FROM {source} s LEFT JOIN (
        SELECT l.page_id, count(*) AS n, any_value(first) AS first, any_value(last) AS last, string_agg(line, chr(10) ORDER BY l.k)
          FILTER (first IS NULL OR l.k BETWEEN first AND last) AS body
        FROM {name}_lines l LEFT JOIN {name}_best b ON b.page_id = l.page_id GROUP BY l.page_id) USING (page_id))"""


def page_text_cte() -> str:
    """Main text by the state after each tag that matters; each token takes
    the state of the last such tag before it."""
    marks = rf"lower(regexp_extract(tok, '(?i)^<(/?(?:noscript|template|nav|footer|aside|header|article|body|html))[{_W}/>]', 1))"
    start = "{'skip': '', 'depth': 0, 'inn': 0, 'art': 0, 'body': 0, 'out': [{'at': -1::BIGINT, 'code': 1}]}"
    end = rf"(?:</title(?:[{_W}/][^>]*)?>?$|$)"
    raw_title = rf"regexp_extract(tok, '(?is)^<title(?:[{_W}/]{_REST.replace(chr(39), chr(39) * 2)})?>(.*?){end}', 1)"
    title = py_strip("regexp_replace(" + decode_entities("raw_title") + r", '\s+', ' ', 'g')")
    return f"""{TOKENS_OF_PAGES},
    pt_marks AS (SELECT page_id, list({{'at': i, 'name': {marks}}} ORDER BY i) AS ms FROM pg_rows WHERE {marks} <> '' GROUP BY page_id),
    pt_turns AS (
      SELECT page_id, o.at AS i, o.code AS code FROM (
        SELECT page_id, unnest(list_reduce(ms, lambda s, m: {_turn()}, {start}).out) AS o FROM pt_marks)),
    pt_codes AS (
      SELECT page_id, i, tok, coalesce(last_value(code IGNORE NULLS) OVER (PARTITION BY page_id ORDER BY i), 1) AS code
      FROM pg_rows LEFT JOIN pt_turns USING (page_id, i)),
    pt_best AS (SELECT page_id, max(code) AS best FROM pt_codes GROUP BY page_id),
    pt_raw AS (
      SELECT page_id, best, string_agg(CASE WHEN code = best THEN {_PIECE} || CASE WHEN more THEN '' ELSE chr(10) END ELSE '' END,
               '' ORDER BY i) AS raw
      FROM (SELECT *, coalesce(lead(code) OVER (PARTITION BY page_id ORDER BY i) = code, false) AS more FROM pt_codes)
      JOIN pt_best USING (page_id) GROUP BY page_id, best),
    pt_dec AS (SELECT page_id, best, {decode_entities('raw')} AS dec FROM pt_raw),
    pt_flat AS MATERIALIZED (SELECT page_id, best, {_tidy('dec')} AS text FROM pt_dec),
    pt_loose AS (SELECT page_id, text FROM pt_flat WHERE best < 3),
    {_content('pt_loose', 'pt_run')},
    pt_title AS (
      SELECT page_id, {title} AS title FROM (
        SELECT page_id, {raw_title} AS raw_title FROM (SELECT page_id, arg_min(tok, i) AS tok FROM pg_rows
          WHERE {_starts('tok', 'title')} GROUP BY page_id))),
    page_text AS (
      SELECT page_id, url, title, text FROM (
        SELECT page_id, url, coalesce(title, '') AS title,
          CASE WHEN best = 3 THEN {py_strip(_LINE.format('f.text'))} ELSE r.text END AS text
        FROM pg_tok JOIN pt_flat f USING (page_id) LEFT JOIN pt_run r USING (page_id) LEFT JOIN pt_title USING (page_id))
      WHERE text <> '')"""


def page_content_sql() -> str:
    return f"""WITH {TOKENS_OF_PAGES},
    pc_raw AS (SELECT page_id, coalesce(string_agg({_PIECE}, '' ORDER BY i), '') AS raw FROM (SELECT page_id FROM pages) LEFT JOIN pg_rows USING (page_id) GROUP BY page_id),
    pc_dec AS (SELECT page_id, {decode_entities('raw')} AS dec FROM pc_raw),
    pc_text AS MATERIALIZED (SELECT page_id, {_tidy('dec')} AS text FROM pc_dec),
    {_content('pc_text', 'pc_run')}
    SELECT page_id, blocks, first, last, text FROM pc_run"""


# ------------------------------------------------------------------ URLs

URL_PARTS = r"^(?:([A-Za-z][A-Za-z0-9+.-]*):)?(?://([^/?#]*))?([^?#]*)(?:\?([^#]*))?(?:#(.*))?$"


def _unparse(s, n, p, q, f) -> str:
    return (f"(CASE WHEN {s} <> '' THEN {s} || ':' ELSE '' END || "
            f"CASE WHEN {n} <> '' OR ({s} IN {_in(USES_NETLOC)} AND left({p}, 2) <> '//') "
            f"THEN '//' || {n} || CASE WHEN {p} <> '' AND left({p}, 1) <> '/' THEN '/' || {p} ELSE {p} END "
            f"ELSE {p} END || "
            f"CASE WHEN {q} <> '' THEN '?' || {q} ELSE '' END || "
            f"CASE WHEN {f} <> '' THEN '#' || {f} ELSE '' END)")


def _bad_brackets(n: str) -> str:
    return (f"((strpos({n}, '[') > 0) <> (strpos({n}, ']') > 0) OR "
            f"(strpos({n}, '[') > 0 AND NOT regexp_matches({n}, '\\[(?:[0-9A-Fa-f:.]+|v[0-9A-Fa-f]+\\.[^\\]]+)\\]')))")


def _chain(source: str, steps: list[tuple[str, str]]) -> str:
    """Nested SELECTs adding one column per step (each step sees the
    previous ones as plain columns, so no expression is expanded twice)."""
    sql = source
    for alias, expr in steps:
        sql = f"(SELECT *, {expr} AS {alias} FROM {sql})"
    return sql


def resolve_from(source: str, base: str, href: str) -> str:
    """Subquery over ``source`` adding abs_url and resolve_error."""
    clean = lambda c: f"regexp_replace(regexp_replace({c}, '[\\t\\r\\n]', '', 'g'), '^[\\x00-\\x20]+', '')"
    steps = [("_bc", clean(base)), ("_hc", clean(href))]
    for side in ("b", "h"):
        for i, name in enumerate(["s", "n", "p", "q", "f"], start=1):
            e = f"regexp_extract(_{side}c, {_q(URL_PARTS)}, {i})"
            steps.append((f"_{side}{name}", f"lower({e})" if name == "s" else e))
    merge = ("list_reduce(_segs, lambda acc, x: CASE WHEN x = '..' THEN acc[1:greatest(len(acc) - 1, 0)] "
             "WHEN x = '.' THEN acc ELSE list_concat(acc, [x]) END, []::VARCHAR[])")
    steps += [
        ("_s", "CASE WHEN _hs = '' THEN _bs ELSE _hs END"),
        ("_bp0", "string_split(_bp, '/')"),
        ("_bparts", "CASE WHEN _bp0[-1] <> '' THEN _bp0[1:len(_bp0) - 1] ELSE _bp0 END"),
        ("_segs0", "CASE WHEN left(_hp, 1) = '/' THEN string_split(_hp, '/') "
                   "ELSE list_concat(_bparts, string_split(_hp, '/')) END"),
        ("_segs", "CASE WHEN left(_hp, 1) = '/' OR len(_segs0) < 3 THEN _segs0 "
                  "ELSE list_concat([_segs0[1]], list_filter(_segs0[2:len(_segs0) - 1], lambda x: x <> ''), [_segs0[-1]]) END"),
        ("_res0", merge),
        ("_res", "CASE WHEN _segs[-1] IN ('.', '..') THEN list_concat(_res0, ['']) ELSE _res0 END"),
        ("_mpath", "CASE WHEN array_to_string(_res, '/') = '' THEN '/' ELSE array_to_string(_res, '/') END"),
        ("resolve_error", f"CASE WHEN {href} IS NULL THEN 'null_href' "
                          f"WHEN {_bad_brackets('_hn')} OR {_bad_brackets('_bn')} THEN 'invalid_ipv6' END"),
        ("abs_url", f"""CASE WHEN resolve_error IS NOT NULL THEN NULL
           WHEN {base} IS NULL OR {base} = '' THEN {href}
           WHEN {href} = '' THEN {base}
           WHEN _s <> _bs OR _s NOT IN {_in(USES_RELATIVE)} THEN {href}
           WHEN _s IN {_in(USES_NETLOC)} AND _hn <> '' THEN {_unparse('_s', '_hn', '_hp', '_hq', '_hf')}
           WHEN _hp = '' THEN {_unparse('_s', '_bn', '_bp', "CASE WHEN _hq = '' THEN _bq ELSE _hq END", '_hf')}
           ELSE {_unparse('_s', '_bn', '_mpath', '_hq', '_hf')} END"""),
    ]
    return _chain(source, steps)


def _pct(col: str, extra: str) -> str:
    cls = "[^\\x21-\\x7E]|[" + extra.replace("'", "''") + "]"
    return (f"CASE WHEN regexp_matches({col}, '{cls}') THEN array_to_string(list_transform("
            f"regexp_extract_all({col}, '(?s).'), lambda ch: CASE WHEN regexp_matches(ch, '{cls}') "
            f"THEN regexp_replace(hex(encode(ch)), '(..)', '%\\1', 'g') ELSE ch END), '') ELSE {col} END")


def normalize_from(source: str, url: str, out: str = "url_norm", reason: str = "url_reject") -> str:
    """Subquery over ``source`` adding ``out`` and ``reason`` for ``url``."""
    dots = "('..', '.%2e', '%2e.', '%2e%2e')"
    walk = (f"list_reduce(_ps, lambda acc, x: CASE WHEN lower(x) IN {dots} THEN acc[1:greatest(len(acc) - 1, 0)] "
            "WHEN lower(x) IN ('.', '%2e') THEN acc ELSE list_concat(acc, [x]) END, []::VARCHAR[])")
    steps = [
        ("_u", f"regexp_replace(regexp_replace({url}, '[\\t\\r\\n]', '', 'g'), '^[\\x00-\\x20]+|[\\x00-\\x20]+$', '', 'g')"),
        ("_sch", "lower(regexp_extract(_u, '^([A-Za-z][A-Za-z0-9+.-]*):', 1))"),
        ("_rest", "regexp_replace(regexp_replace(substring(_u, length(_sch) + 2), '\\\\', '/', 'g'), '^/+', '')"),
        ("_auth", "regexp_extract(_rest, '^([^/?#]*)', 1)"),
        ("_tail", "substring(_rest, length(_auth) + 1)"),
        ("_hp", "string_split(_auth, '@')[-1]"),
        ("_ui", "CASE WHEN strpos(_auth, '@') > 0 THEN left(_auth, length(_auth) - length(_hp) - 1) ELSE '' END"),
        ("_host", "lower(CASE WHEN left(_hp, 1) = '[' THEN regexp_extract(_hp, '^(\\[[^\\]]*\\])', 1) "
                  "ELSE regexp_extract(_hp, '^([^:]*)', 1) END)"),
        ("_port", "substring(_hp, length(_host) + 2)"),
        ("_portn", "CASE WHEN regexp_matches(_port, '^[0-9]{1,5}$') THEN _port::INTEGER END"),
        ("_path", "regexp_extract(_tail, '^([^?#]*)', 1)"),
        ("_has_q", "regexp_matches(_tail, '^[^#]*\\?')"),
        ("_q", "regexp_extract(_tail, '^[^?#]*\\?([^#]*)', 1)"),
        ("_has_f", "strpos(_tail, '#') > 0"),
        ("_f", "substring(_tail, strpos(_tail, '#') + 1)"),
        ("_ps", "string_split(substring(CASE WHEN _path = '' THEN '/' ELSE _path END, 2), '/')"),
        ("_pr0", walk),
        ("_pr", "CASE WHEN lower(_ps[-1]) IN ('..', '.%2e', '%2e.', '%2e%2e', '.', '%2e') "
                "THEN list_concat(_pr0, ['']) ELSE _pr0 END"),
        ("_np", "'/' || array_to_string(_pr, '/')"),
        ("_rej", f"""CASE WHEN {url} IS NULL THEN 'null_url'
           WHEN _sch NOT IN ('http', 'https') THEN 'scheme'
           WHEN _host = '' THEN 'host'
           WHEN left(_host, 1) = '[' AND NOT regexp_matches(_host, '^\\[[0-9a-f:.]+\\]$') THEN 'host'
           WHEN left(_host, 1) <> '[' AND regexp_matches(_host, '[\\x00-\\x20#%/:<>?@\\[\\\\\\]^|\\x7F]') THEN 'host'
           WHEN _port <> '' AND (_portn IS NULL OR _portn > 65535) THEN 'port' END"""),
        ("_built", f"""CASE WHEN _rej IS NULL THEN
        _sch || '://' || CASE WHEN _ui <> '' THEN _ui || '@' ELSE '' END || _host
        || CASE WHEN _port <> '' AND _portn <> CASE WHEN _sch = 'http' THEN 80 ELSE 443 END THEN ':' || _portn::VARCHAR ELSE '' END
        || {_pct('_np', '"<>`{}')}
        || CASE WHEN _has_q THEN '?' || {_pct('_q', "\"<>'")} ELSE '' END
        || CASE WHEN _has_f THEN '#' || {_pct('_f', '"<>`')} ELSE '' END END"""),
        (reason, "coalesce(_rej, CASE WHEN length(_built) > 2083 THEN 'too_long' END)"),
        (out, f"CASE WHEN {reason} IS NULL THEN _built END"),
    ]
    return _chain(source, steps)


def _cols(*names) -> str:
    return ", ".join(names)


# ------------------------------------------------------- shared CTE chains

_ATTR_Q = _ATTR.replace("'", "''")
_PAGE_LINKS = rf"""links_raw AS (
  SELECT page_id, url AS page_url, list_filter(t, lambda x: {_starts('x', 'a')} AND ends_with(x, '>')) AS tags FROM pg_tok),
links_attr AS (
  SELECT page_id, page_url, t, a, regexp_extract(attr, '^(=[^{_W}/>=]*|[^{_W}/>=]+)', 1) AS name,
         regexp_extract(attr, '(?s)^(?:=[^{_W}/>=]*|[^{_W}/>=]+)[{_W}]*=[{_W}]*("[^"]*"|''[^'']*''|[^{_W}>"''][^{_W}>]*)$', 1) AS raw
  FROM (SELECT page_id, page_url, t, unnest(range(len(attrs))) AS a, unnest(attrs) AS attr
        FROM (SELECT page_id, page_url, t, regexp_extract_all(substring(tag, 3), '(?s){_ATTR_Q}') AS attrs
              FROM (SELECT page_id, page_url, unnest(range(len(tags))) AS t, unnest(tags) AS tag FROM links_raw)))),
links_x AS (
  SELECT page_id, page_url, row_number() OVER (PARTITION BY page_id ORDER BY t) - 1 AS link_pos, raw
  FROM (SELECT page_id, page_url, t, arg_min(raw, a) AS raw FROM links_attr WHERE lower(name) = 'href' GROUP BY ALL)
  WHERE raw <> ''),
links AS (
  SELECT page_id, page_url, link_pos, href FROM (
    SELECT page_id, page_url, link_pos,
      {decode_entities("CASE WHEN left(raw, 1) IN ('\"', chr(39)) THEN substring(raw, 2, length(raw) - 2) ELSE raw END")} AS href
    FROM links_x) WHERE href <> ''),
resolved AS (
  SELECT page_id, page_url, link_pos, href, resolve_error, abs_url FROM {resolve_from('links', 'page_url', 'href')}),
article_links AS (
  SELECT * FROM resolved WHERE resolve_error IS NULL AND ({' OR '.join(f"contains(abs_url, {_q(m)})" for m in config.TESTDATA_LINK_MARKERS)})),
first_links AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY page_id ORDER BY link_pos) AS rn FROM article_links) WHERE rn <= {config.LINKS_PER_SITE})"""
LINKS_CTE = f"{TOKENS_OF_PAGES},\n{_PAGE_LINKS}"


SITE_CTE = """
landed AS (SELECT string_split(url, '#')[1] AS fetch_url, min(page_id) AS page_id FROM pages WHERE url IS NOT NULL GROUP BY 1),
site_links AS (
  SELECT l.page_id AS site_pos, l.link_pos, coalesce(p.url, l.abs_url) AS abs_url
  FROM first_links l LEFT JOIN pages p
    ON p.page_id = (l.page_id * 7 + l.link_pos * 13 + 1) % (SELECT (max(page_id) + 1) * 2 FROM pages))"""


ARTICLES_CTE = page_text_cte() + f""",
built AS (
  SELECT page_id AS pos, url AS raw_url, url_norm AS url, title, text,
         CASE WHEN title IS NULL THEN 'null_title' WHEN text IS NULL THEN 'null_text'
              WHEN url_reject IS NOT NULL THEN 'url_' || url_reject END AS reject
  FROM {normalize_from('page_text', 'url')}),
deduped AS (
  SELECT pos, raw_url, url, title, text FROM (
    SELECT *, row_number() OVER (PARTITION BY url ORDER BY pos) AS rn FROM built WHERE reject IS NULL)
  WHERE rn = 1),
validated AS (
  SELECT url AS doc, pos, url, title, text FROM deduped
  WHERE coalesce(title <> '' AND text <> '' AND url <> '', false))"""


DOCS_CTE = f"""
docs AS (
  SELECT doc_id AS doc, doc_id AS pos, {py_strip("string_split(text, chr(10))[1]")} AS title, text FROM documents)"""

GAZ_VALUES = ", ".join(f"({_q(t)}, {_q(l)})" for t, l in config.TESTDATA_GAZETTEER)

MENTIONS_CTE = DOCS_CTE + f""",
gaz AS (
  SELECT DISTINCT array_to_string(list_transform({tokens('term')}, lambda t: lower(t)), ' ') AS term_l,
         len({tokens('term')}) AS n_tokens, label
  FROM (VALUES {GAZ_VALUES}) g(term, label) WHERE len({tokens('term')}) >= 1),
sents AS (
  SELECT doc, unnest(range(len(ss))) AS sent, unnest(ss) AS sent_text
  FROM (SELECT doc, {sentences('text')} AS ss FROM docs)),
rawtoks AS (
  SELECT doc, sent, unnest(range(len(rs))) AS r, unnest(rs) AS raw
  FROM (SELECT doc, sent, list_filter(string_split_regex(sent_text, '{WS}+'), lambda x: x <> '') AS rs FROM sents)),
cores AS (
  SELECT doc, sent, r, regexp_replace(regexp_replace(raw, '^[^\\p{{L}}\\p{{N}}]+', ''), '[^\\p{{L}}\\p{{N}}/]+$', '') AS core,
         regexp_matches(raw, '^[^\\p{{L}}\\p{{N}}]') AS lead, regexp_matches(raw, '[^\\p{{L}}\\p{{N}}/]$') AS trail
  FROM rawtoks),
stoks AS MATERIALIZED (
  SELECT doc, sent, row_number() OVER w - 1 AS pos, core,
         coalesce(lead(r) OVER w = r + 1 AND NOT trail AND NOT lead(lead) OVER w, false) AS glued
  FROM cores WHERE core <> '' WINDOW w AS (PARTITION BY doc, sent ORDER BY r)),
slists AS (SELECT doc, sent, list(core ORDER BY pos) AS toks, list(glued ORDER BY pos) AS glue FROM stoks GROUP BY doc, sent),
begins AS (
  SELECT s.doc, s.sent, s.pos, f.n FROM stoks s
  JOIN (SELECT DISTINCT string_split(term_l, ' ')[1] AS t, n_tokens AS n FROM gaz) f ON f.t = lower(s.core)),
grams AS (
  SELECT doc, sent, b.pos, n AS n_tokens, array_to_string(toks[b.pos + 1:b.pos + n], ' ') AS text
  FROM begins b JOIN slists USING (doc, sent)
  WHERE b.pos + n <= len(toks) AND coalesce(list_bool_and(glue[b.pos + 1:b.pos + n - 1]), true)),
matched AS (
  SELECT DISTINCT g.doc, g.sent, g.pos, g.n_tokens, g.text
  FROM grams g JOIN gaz z ON lower(g.text) = z.term_l AND g.n_tokens = z.n_tokens),
longest AS (SELECT doc, sent, pos, max(n_tokens) AS n_tokens FROM matched GROUP BY ALL),
walked AS (
  SELECT doc, sent, unnest(list_reduce(list({{'pos': pos, 'n': n_tokens}} ORDER BY pos),
    lambda acc, m: CASE WHEN len(acc) = 0 OR m.pos >= acc[-1].pos + acc[-1].n THEN list_append(acc, m) ELSE acc END,
    [{{'pos': -1, 'n': 0::BIGINT}}][2:])) AS m
  FROM longest GROUP BY doc, sent),
mentions AS MATERIALIZED (
  SELECT w.doc, w.sent, w.m.pos AS pos, x.n_tokens, x.text, z.label
  FROM walked w JOIN matched x ON x.doc = w.doc AND x.sent = w.sent AND x.pos = w.m.pos AND x.n_tokens = w.m.n
  JOIN gaz z ON z.term_l = lower(x.text) AND z.n_tokens = x.n_tokens)"""

IOC_PATTERNS = [
    ("IP_ADDRESS", r"(^|[^\p{L}\p{N}_])(\p{Nd}{1,3}\.){3}\p{Nd}{1,3}($|[^\p{L}\p{N}_])"),
    ("MD5_HASH", r"(^|[^\p{L}\p{N}_])[a-fA-F0-9]{32}($|[^\p{L}\p{N}_])"),
    ("SHA1_HASH", r"(^|[^\p{L}\p{N}_])[a-fA-F0-9]{40}($|[^\p{L}\p{N}_])"),
    ("SHA256_HASH", r"(^|[^\p{L}\p{N}_])[a-fA-F0-9]{64}($|[^\p{L}\p{N}_])"),
    ("CVE", r"CVE-\p{Nd}{4}-\p{Nd}{4,7}"),
]

_PAT_ROWS = ", ".join(f"({i}, {_q(n)}, {_q(rx)})" for i, (n, rx) in enumerate(IOC_PATTERNS))

TOKENS_CTE = """,
dtoks AS (
  SELECT doc, unnest(range(len(toks))) AS pos, unnest(toks) AS token
  FROM (SELECT doc, """ + tokens("text") + """ AS toks FROM docs))"""

LIKE_URL = f"""(CASE WHEN starts_with(value, 'http://') OR starts_with(value, 'https://') THEN true
      WHEN starts_with(value, 'www.') AND length(value) >= 5 THEN true
      WHEN starts_with(value, '.') OR ends_with(value, '.') THEN false
      WHEN strpos(value, '@') > 0 THEN false
      WHEN strpos(value, '.') = 0 THEN false
      ELSE ends_with(string_split(string_split(value, '.')[-1], ':')[1], '/')
           OR regexp_matches(string_split(string_split(value, '.')[-1], ':')[1], '^[a-z]{{2}}$')
           OR string_split(string_split(value, '.')[-1], ':')[1] IN {_in(config.URL_GENERIC_TLDS)} END)"""

IOCS_CTE = TOKENS_CTE + """,
pat_iocs AS (
  """ + " UNION ALL ".join(
      f"SELECT doc, pos, {i} AS pat_rank, {_q(n)} AS type, token AS value FROM dtoks WHERE regexp_matches(token, {_q(rx)})"
      for i, (n, rx) in enumerate(IOC_PATTERNS)) + f"""),
ue_iocs AS (
  SELECT doc, pos, type, value FROM (
    SELECT doc, pos, token AS value,
      CASE WHEN {LIKE_URL} THEN 'URL'
           WHEN regexp_matches(value, '^[^@]+@[^@]+\\.[A-Za-z]{{2,}}$') THEN 'Email' END AS type
    FROM dtoks) WHERE type IS NOT NULL),
men_iocs AS (
  SELECT doc, sent, pos, label AS type, text AS value FROM mentions WHERE label IN {_in(config.IOC_LABELS)}),
all_iocs AS (
  SELECT doc, 0 AS src_rank, sent::BIGINT AS sent, pos::BIGINT AS pos, 0 AS pat_rank, type, value FROM men_iocs
  UNION ALL SELECT doc, 1, 0, pos, pat_rank, type, value FROM pat_iocs
  UNION ALL SELECT doc, 2, 0, pos, 0, type, value FROM ue_iocs)"""

ACTORS_CTE = f""",
am AS (SELECT *, lower(text) AS actor_key FROM mentions WHERE label IN {_in(config.ACTOR_LABELS)}),
forms AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY doc, actor_key, text ORDER BY sent, pos) AS rn FROM am)
  WHERE rn = 1),
actors AS (
  SELECT doc, actor_key, list(text ORDER BY sent, pos) AS names,
         list(text ORDER BY sent, pos)[1] AS first_text,
         min(sent) AS sent, list(pos ORDER BY sent, pos)[1] AS pos
  FROM forms GROUP BY doc, actor_key)"""


def _actor_join(labels) -> str:
    return (f"SELECT a.doc, a.actor_key, m.pos AS m_pos, m.text AS m_text FROM actors a "
            f"JOIN mentions m ON m.doc = a.doc AND m.sent = a.sent WHERE m.label IN {_in(labels)}")


CHUNKS = config.CHUNK_TOKENS

ANALYSIS_CTE = ARTICLES_CTE + f""",
atoks AS (SELECT doc, pos, {words('text')} AS toks FROM validated),
chunks AS (
  SELECT doc, pos, c AS chunk_no, array_to_string(toks[c * {CHUNKS} + 1:(c + 1) * {CHUNKS}], '') AS chunk,
         len(toks[c * {CHUNKS} + 1:(c + 1) * {CHUNKS}]) AS n_tokens
  FROM (SELECT doc, pos, toks, unnest(range(CAST(ceil(len(toks) / {CHUNKS}) AS BIGINT))) AS c FROM atoks)),
replies AS (
  SELECT doc, pos, chunk_no, attempt,
    CASE WHEN k = 1 AND attempt = 1 THEN 'error' ELSE 'ok' END AS status,
    CASE WHEN k = 0 THEN full_json
         WHEN k = 1 THEN CASE WHEN attempt = 1 THEN NULL ELSE full_json END
         WHEN k = 2 THEN json_object('Executive_Summary', array_to_string(w[2:6], ' '),
                                     'TTPs', array_to_string(w[2:3], ', '))::VARCHAR
         WHEN k = 3 THEN 'Summary: ' || array_to_string(w[1:8], ' ')
         WHEN k = 4 THEN CASE WHEN attempt < 3 THEN '[1]' ELSE full_json END
         WHEN k = 5 THEN json_object('Executive_Summary', array_to_string(w[1:4], ' '), 'TTPs', chunk_no)::VARCHAR
         ELSE json_object('Executive_Summary', chunk_no, 'TTPs', array_to_string(w[1:2], ', '))::VARCHAR END AS content
  FROM (
    SELECT *, (pos + chunk_no) % 7 AS k,
      json_object('Executive_Summary', array_to_string(w[1:12], ' '), 'Threat_Actors', array_to_string(w[1:3], ', '),
                  'TTPs', array_to_string(w[4:5], ', '), 'IOCs', array_to_string(w[6:6], ', '),
                  'Global_Impact', array_to_string(w[7:12], ' '),
                  'Recommendations', array_to_string(w[13:14], ', '))::VARCHAR AS full_json
    FROM (SELECT doc, pos, chunk_no, string_split_regex({py_strip('chunk')}, '{WS}+') AS w, unnest(range(1, {config.MAX_ATTEMPTS} + 1)) AS attempt
          FROM chunks))),
classified AS (
  SELECT doc, pos, chunk_no, attempt, content, cls AS reply_class,
    CASE WHEN cls IN ('a', 'b') THEN coalesce(json_extract_string(content, '$.Executive_Summary'), '')
         WHEN cls = 'c' THEN content ELSE '' END AS Executive_Summary,
    CASE WHEN cls IN ('a', 'b') THEN string_split(coalesce(json_extract_string(content, '$.Threat_Actors'), ''), ', ') ELSE []::VARCHAR[] END AS Threat_Actors,
    CASE WHEN cls IN ('a', 'b') THEN string_split(coalesce(json_extract_string(content, '$.TTPs'), ''), ', ') ELSE []::VARCHAR[] END AS TTPs,
    CASE WHEN cls IN ('a', 'b') THEN string_split(coalesce(json_extract_string(content, '$.IOCs'), ''), ', ') ELSE []::VARCHAR[] END AS IOCs,
    CASE WHEN cls IN ('a', 'b') THEN coalesce(json_extract_string(content, '$.Global_Impact'), '') ELSE '' END AS Global_Impact,
    CASE WHEN cls IN ('a', 'b') THEN string_split(coalesce(json_extract_string(content, '$.Recommendations'), ''), ', ') ELSE []::VARCHAR[] END AS Recommendations
  FROM (
    SELECT *,
      CASE WHEN status <> 'ok' OR content IS NULL THEN 'failed'
           WHEN NOT json_valid(content) THEN 'c'
           WHEN json_type(content::JSON) <> 'OBJECT' THEN 'd'
           WHEN {' OR '.join(f"coalesce(json_type(content::JSON, '$.{k}') <> 'VARCHAR', false)" for k in config.REPLY_LIST_KEYS)} THEN 'd'
           WHEN coalesce(json_type(content::JSON, '$.Executive_Summary') <> 'VARCHAR', false)
             OR coalesce(json_type(content::JSON, '$.Global_Impact') <> 'VARCHAR', false) THEN 'e'
           WHEN {' AND '.join(f"json_type(content::JSON, '$.{k}') IS NOT NULL" for k in config.REPLY_KEYS)} THEN 'a'
           ELSE 'b' END AS cls
    FROM replies)),
chosen AS (
  SELECT * FROM (
    SELECT *, row_number() OVER (PARTITION BY doc, chunk_no ORDER BY attempt) AS rn
    FROM classified WHERE reply_class IN ('a', 'b', 'c', 'e') AND attempt <= {config.MAX_ATTEMPTS})
  WHERE rn = 1),
chunk_an AS (SELECT * FROM chosen WHERE reply_class IN ('a', 'b', 'c')),
combined_text AS (
  SELECT doc, {py_strip("string_agg(Executive_Summary || ' ', '' ORDER BY chunk_no)")} AS Executive_Summary,
         {py_strip("string_agg(Global_Impact || ' ', '' ORDER BY chunk_no)")} AS Global_Impact
  FROM chunk_an GROUP BY doc),
combined_items AS (
  SELECT DISTINCT doc, field, value FROM (
    SELECT doc, 'Threat_Actors' AS field, unnest(Threat_Actors) AS value FROM chunk_an
    UNION ALL SELECT doc, 'TTPs', unnest(TTPs) FROM chunk_an
    UNION ALL SELECT doc, 'IOCs', unnest(IOCs) FROM chunk_an
    UNION ALL SELECT doc, 'Recommendations', unnest(Recommendations) FROM chunk_an) WHERE value <> ''),
combined AS (
  SELECT t.doc, t.Executive_Summary, t.Global_Impact,
    coalesce((SELECT list(value ORDER BY value) FROM combined_items i WHERE i.doc = t.doc AND field = 'Threat_Actors'), []::VARCHAR[]) AS Threat_Actors,
    coalesce((SELECT list(value ORDER BY value) FROM combined_items i WHERE i.doc = t.doc AND field = 'TTPs'), []::VARCHAR[]) AS TTPs,
    coalesce((SELECT list(value ORDER BY value) FROM combined_items i WHERE i.doc = t.doc AND field = 'IOCs'), []::VARCHAR[]) AS IOCs,
    coalesce((SELECT list(value ORDER BY value) FROM combined_items i WHERE i.doc = t.doc AND field = 'Recommendations'), []::VARCHAR[]) AS Recommendations
  FROM combined_text t),
analysed AS (SELECT v.*, c.Executive_Summary, c.Global_Impact, c.Threat_Actors, c.TTPs, c.IOCs, c.Recommendations
             FROM validated v JOIN combined c ON v.doc = c.doc)"""


def _first_seen(field: str, out: str, extra: str) -> str:
    return (f"WITH {ANALYSIS_CTE} SELECT {out}, {extra}, min(pos) AS first_pos FROM "
            f"(SELECT pos, unnest({field}) AS {out} FROM analysed) GROUP BY {out}")


def _json_list_cols(prefix: str = "") -> str:
    return ", ".join(f"to_json({prefix}{k}) AS {k}" if k in config.REPLY_LIST_KEYS else f"{prefix}{k}"
                     for k in config.REPLY_KEYS)


SALVAGE = ", ".join(
    f"CASE WHEN regexp_matches(content, {_q(chr(34) + k + chr(34) + r'\s*:\s*' + chr(34) + '([^' + chr(34) + ']*)' + chr(34))}) "
    f"THEN to_json(string_split({py_strip('regexp_extract(content, ' + _q(chr(34) + k + chr(34) + r'\s*:\s*' + chr(34) + '([^' + chr(34) + ']*)' + chr(34)) + ', 1)')}, ', ')) "
    f"ELSE '[]' END AS {k}" for k in config.REPLY_KEYS)
SALVAGED = " OR ".join(
    f"regexp_matches(content, {_q(chr(34) + k + chr(34) + r'\s*:\s*' + chr(34) + '([^' + chr(34) + ']*)' + chr(34))})"
    for k in config.REPLY_KEYS)


REPORT_ID = "00000000-0000-0000-0000-000000000000"


def enriched_cte() -> str:
    """Each document with its actors, TTPs and IOCs as JSON arrays."""
    same = ("SELECT a2.doc, a2.actor_key, m.pos, m.text AS v FROM actors a2 JOIN mentions m "
            "ON m.doc = a2.doc AND m.sent = a2.sent WHERE m.label IN ")
    lists = {
        "targets": (f"{same}{_in(config.TARGET_LABELS)} AND lower(m.text) <> a2.actor_key", "pos, v"),
        "tactics": (f"{same}{_in(config.TACTIC_LABELS)}", "pos, v"),
        "techniques": (f"{same}{_in(config.TECHNIQUE_LABELS)}", "pos, v"),
        "related": ("SELECT a2.doc, a2.actor_key, i.src_rank, i.sent, i.pos, i.pat_rank, i.value AS v FROM actors a2 "
                    "JOIN all_iocs i ON i.doc = a2.doc AND contains(lower(i.value), a2.actor_key)",
                    "src_rank, sent, pos, pat_rank, v"),
    }
    ctes = ", ".join(f"en_{n} AS (SELECT doc, actor_key, list(v ORDER BY {o}) AS {n} FROM ({sql}) GROUP BY doc, actor_key)"
                     for n, (sql, o) in lists.items())
    joined = " ".join(f"LEFT JOIN en_{n} ON en_{n}.doc = a.doc AND en_{n}.actor_key = a.actor_key" for n in lists)
    empty, quote = "[]::VARCHAR[]", "chr(39)"
    held = ", ".join(f"'{k}': coalesce({k}, {empty})" for k in ("targets", "tactics", "techniques"))
    actor = (f"to_json({{'names': a.names, 'aliases': {empty}, "
             f"'description': 'Extracted from article: ' || coalesce(d.title, 'None'), "
             f"'summary': 'Potential threat actor ' || {quote} || a.first_text || {quote} || ' identified in the context: ' "
             f"|| {quote} || s.sent_text || {quote}, "
             f"'motivation': CASE WHEN regexp_matches(lower(s.sent_text), {_q('|'.join(config.MOTIVATION_PHRASES))}) "
             f"THEN s.sent_text END, {held}, 'procedures': {empty}, 'related_iocs': coalesce(related, {empty})}})::VARCHAR")
    ttp = (f"to_json({{'tactic': label, 'technique': text, 'procedure': NULL::VARCHAR, 'mitre_id': NULL::VARCHAR, "
           f"'related_actors': {empty}}})::VARCHAR")
    ioc = (f"to_json({{'type': type, 'value': value, 'first_seen': NULL::VARCHAR, 'last_seen': NULL::VARCHAR, "
           f"'related_actors': {empty}, 'related_ttps': {empty}}})::VARCHAR")

    def array_of(n):
        return f"'[' || coalesce(array_to_string({n}, ','), '') || ']' AS {n}"

    return f"""{ctes},
en_a AS (SELECT a.doc, list({actor} ORDER BY a.sent, a.pos, a.actor_key) AS threat_actors
  FROM actors a JOIN docs d ON d.doc = a.doc LEFT JOIN sents s ON s.doc = a.doc AND s.sent = a.sent {joined} GROUP BY a.doc),
en_t AS (SELECT doc, list({ttp} ORDER BY sent, pos, label) AS ttps FROM mentions WHERE label IN {_in(config.TTP_LABELS)} GROUP BY doc),
en_i AS (SELECT doc, list({ioc} ORDER BY src_rank, sent, pos, pat_rank, type) AS iocs FROM all_iocs GROUP BY doc),
enriched AS (SELECT d.*, {array_of('threat_actors')}, {array_of('ttps')}, {array_of('iocs')}
  FROM docs d LEFT JOIN en_a USING (doc) LEFT JOIN en_t USING (doc) LEFT JOIN en_i USING (doc))"""


def _report_sql(x: str, a: str) -> str:
    """The report's lines, with the fixed id and time of the query."""
    body = a.replace(DOCS_CTE, f"{x}, docs AS (SELECT doc, pos, title, text, url FROM validated)")
    head = f"SELECT {_q(REPORT_ID)} AS report_id, '20240102_030405' AS run_ts, "
    art = "to_json({'pos': pos, 'title': title, 'url': url, 'text': text})::VARCHAR"
    entities = """',"threat_actors":' || threat_actors || ',"ttps":' || ttps || ',"iocs":' || iocs || '}'"""
    header = (f"to_json({{'id': {_q(REPORT_ID)}, 'timestamp': '2024-01-02 03:04:05', 'version': {_q(config.REPORT_VERSION)}, "
              f"'generated_by': {_q(config.REPORT_GENERATOR)}}})::VARCHAR")

    def part(section, pos, json, source=""):
        return (head + f"'{section}' AS section, {pos} AS pos, " + """'{"threat_intelligence":' || """ + json
                + " || '}' AS json " + source)

    def items(field, out, extra):
        return (f"FROM (SELECT {out}, {extra}, min(pos) AS first_pos FROM (SELECT pos, unnest({field}) AS {out} "
                f"FROM analysed) GROUP BY {out})")

    parts = [
        part("header", "0::BIGINT", header),
        part("summary", "pos", "to_json({'executive_summary': Executive_Summary, 'global_impact': Global_Impact})::VARCHAR",
             "FROM analysed"),
        part("landscape", "first_pos", "to_json({'actor': actor, 'entry': {'description': ''}})::VARCHAR",
             items("Threat_Actors", "actor", "0 AS x")),
        part("threat", "first_pos", "to_json({'description': description, 'severity': NULL::VARCHAR})::VARCHAR",
             items("TTPs", "description", "0 AS x")),
        part("recommendation", "first_pos", "to_json({'description': description, 'priority': NULL::VARCHAR})::VARCHAR",
             items("Recommendations", "description", "0 AS x")),
        part("article", "pos", f"left({art}, length({art}) - 1) || {entities}", "FROM enriched"),
    ]
    return f"WITH {body}{IOCS_CTE}, {enriched_cte()} " + " UNION ALL ".join(parts)


def oracle_sql() -> dict[str, str]:
    M = MENTIONS_CTE
    q = {}
    q["seed_scan"] = "SELECT page_id AS site_pos, url FROM pages"
    q["page_scan"] = "SELECT page_id, url, length(html) AS html_chars FROM pages"
    q["link_extract"] = f"WITH {LINKS_CTE} SELECT page_id, link_pos, href FROM links"
    q["link_resolve"] = f"WITH {LINKS_CTE} SELECT page_id, link_pos, href, abs_url, resolve_error FROM resolved"
    q["link_filter"] = f"WITH {LINKS_CTE} SELECT page_id, link_pos, abs_url FROM article_links"
    q["links_first_n"] = f"WITH {LINKS_CTE} SELECT page_id, link_pos, abs_url FROM first_links"
    q["fetch_frontier"] = (f"WITH {LINKS_CTE}, {SITE_CTE} SELECT DISTINCT string_split(abs_url, '#')[1] AS url, "
                           f"string_split(abs_url, '#')[1] IN (SELECT fetch_url FROM landed) AS cached FROM site_links")
    q["link_page_join"] = (f"WITH {LINKS_CTE}, {SITE_CTE} SELECT l.site_pos, l.link_pos, l.abs_url, "
                           f"p.page_id FROM site_links l JOIN landed p ON p.fetch_url = string_split(l.abs_url, '#')[1]")
    q["link_page_missing"] = (f"WITH {LINKS_CTE}, {SITE_CTE} SELECT site_pos, link_pos, abs_url FROM site_links "
                              f"WHERE string_split(abs_url, '#')[1] NOT IN (SELECT fetch_url FROM landed)")
    q["page_text"] = f"WITH {page_text_cte()} SELECT page_id, url, title, text FROM page_text"
    q["page_content"] = page_content_sql()
    q["url_normalize"] = (f"WITH {LINKS_CTE}, u AS (SELECT 'page' AS src, page_id AS id, -1 AS link_pos, url FROM pages "
                          f"UNION ALL SELECT 'link', page_id, link_pos, abs_url FROM resolved WHERE abs_url IS NOT NULL) "
                          f"SELECT src, id, link_pos, url, url_reject, url_norm FROM {normalize_from('u', 'url')}")
    q["dedup_by_url"] = f"WITH {ARTICLES_CTE} SELECT pos, url FROM deduped"
    q["validate_articles"] = f"WITH {ARTICLES_CTE} SELECT pos, url, title FROM validated"
    q["validate_rejects"] = (f"WITH {ARTICLES_CTE} SELECT 'validate' AS stage, url AS key, "
                             f"CASE WHEN coalesce(title, '') = '' THEN 'empty_title' WHEN coalesce(text, '') = '' "
                             f"THEN 'empty_text' ELSE 'empty_url' END AS reason, pos FROM deduped "
                             f"WHERE NOT coalesce(title <> '' AND text <> '' AND url <> '', false)")
    q["articles_ordered"] = (
        f"WITH {page_text_cte()}, {_PAGE_LINKS}, {SITE_CTE}, "
        f"reached AS (SELECT l.site_pos, l.link_pos, l.abs_url, t.title, t.text FROM site_links l "
        f"JOIN landed p ON p.fetch_url = string_split(l.abs_url, '#')[1] JOIN page_text t ON t.page_id = p.page_id) "
        f"SELECT site_pos, link_pos, url_norm AS doc, title FROM (SELECT *, row_number() OVER "
        f"(PARTITION BY url_norm ORDER BY site_pos, link_pos) AS rn FROM {normalize_from('reached', 'abs_url')} "
        f"WHERE url_reject IS NULL) WHERE rn = 1 AND coalesce(title <> '' AND text <> '', false) ORDER BY 1, 2")
    q["risk_range_check"] = ("SELECT doc_id, risk_score FROM (SELECT doc_id, n_chars / 100.0 AS risk_score "
                             "FROM documents) WHERE risk_score IS NULL OR risk_score BETWEEN 0 AND 100")
    q["doc_tokens"] = f"WITH {DOCS_CTE}{TOKENS_CTE} SELECT doc, pos, token FROM dtoks"
    q["sentence_split"] = f"WITH {M} SELECT doc, sent, sent_text FROM sents"
    q["chunk_tokens"] = (f"WITH {DOCS_CTE}, t AS (SELECT doc, {words('text')} AS toks FROM docs) "
                         f"SELECT doc, c AS chunk_no, array_to_string(toks[c * {CHUNKS} + 1:(c + 1) * {CHUNKS}], '') AS chunk, "
                         f"len(toks[c * {CHUNKS} + 1:(c + 1) * {CHUNKS}]) AS n_tokens "
                         f"FROM (SELECT doc, toks, unnest(range(CAST(ceil(len(toks) / {CHUNKS}) AS BIGINT))) AS c FROM t)")
    small = 60
    q["chunk_tokens_small"] = q["chunk_tokens"].replace(str(CHUNKS), str(small))
    q["dedup_by_text"] = "SELECT min(doc_id) AS pos, sha256(text) AS text_sha256 FROM documents GROUP BY sha256(text)"
    article = "resolve_error IS NULL AND (" + " OR ".join(f"contains(abs_url, {_q(m)})" for m in config.TESTDATA_LINK_MARKERS) + ")"
    sites = (f"SELECT page_id AS site_pos, count(*) AS links, count(resolve_error) AS link_rejects, "
             f"count(*) FILTER ({article}) AS article_links, "
             f"least(count(*) FILTER ({article}), {config.LINKS_PER_SITE}) AS kept_links FROM resolved GROUP BY page_id")
    q["site_link_counts"] = f"WITH {LINKS_CTE} {sites}"
    q["iocs_patterns"] = f"WITH {M}{IOCS_CTE} SELECT doc, pos, pat_rank, type, value FROM pat_iocs"
    q["iocs_url_email"] = f"WITH {M}{IOCS_CTE} SELECT doc, pos, type, value FROM ue_iocs"
    q["gazetteer_mentions"] = f"WITH {M} SELECT doc, sent, pos, n_tokens, text, label FROM mentions"
    q["ttps"] = (f"WITH {M} SELECT doc, sent, pos, label AS tactic, text AS technique FROM mentions "
                 f"WHERE label IN {_in(config.TTP_LABELS)}")
    q["iocs_from_mentions"] = f"WITH {M}{IOCS_CTE} SELECT doc, sent, pos, type, value FROM men_iocs"
    q["iocs_all"] = f"WITH {M}{IOCS_CTE} SELECT doc, src_rank, sent, pos, pat_rank, type, value FROM all_iocs"
    A = M + ACTORS_CTE
    q["actors_merged"] = f"WITH {A} SELECT doc, actor_key, to_json(names) AS names, first_text, sent, pos FROM actors"
    q["actor_targets"] = (f"WITH {A} SELECT doc, actor_key, m_pos, m_text AS target FROM ({_actor_join(config.TARGET_LABELS)}) "
                          f"WHERE lower(m_text) <> actor_key")
    q["actor_tactics"] = f"WITH {A} SELECT doc, actor_key, m_pos, m_text AS tactic FROM ({_actor_join(config.TACTIC_LABELS)})"
    q["actor_techniques"] = (f"WITH {A} SELECT doc, actor_key, m_pos, m_text AS technique "
                             f"FROM ({_actor_join(config.TECHNIQUE_LABELS)})")
    ctx = (f"WITH {A} SELECT a.doc, a.actor_key, 'Extracted from article: ' || coalesce(d.title, 'None') AS description, "
           f"'Potential threat actor ''' || a.first_text || ''' identified in the context: ''' || s.sent_text || '''' AS summary, "
           f"CASE WHEN regexp_matches(lower(s.sent_text), {_q('|'.join(config.MOTIVATION_PHRASES))}) THEN s.sent_text END AS motivation "
           f"FROM actors a LEFT JOIN sents s ON s.doc = a.doc AND s.sent = a.sent LEFT JOIN docs d ON d.doc = a.doc")
    q["actor_summary"] = f"SELECT doc, actor_key, description, summary FROM ({ctx})"
    q["actor_motivation"] = f"SELECT doc, actor_key, motivation FROM ({ctx})"
    q["actor_related_iocs"] = (f"WITH {A}{IOCS_CTE} SELECT a.doc, a.actor_key, i.src_rank, i.sent, i.pos, i.pat_rank, i.type, i.value "
                               f"FROM actors a JOIN all_iocs i ON i.doc = a.doc AND contains(lower(i.value), a.actor_key)")
    q["articles_enriched"] = f"WITH {A}{IOCS_CTE}, {enriched_cte()} SELECT doc, title, threat_actors, ttps, iocs FROM enriched"
    shared = ("SELECT type, value, count(DISTINCT doc) AS n_articles, min(doc) AS first_article FROM all_iocs "
              "GROUP BY type, value HAVING count(DISTINCT doc) > 1")
    q["indicator_classes"] = f"WITH {M}{IOCS_CTE} {shared}"
    q["related_articles"] = (f"WITH {M}{IOCS_CTE}, shared AS ({shared}) SELECT DISTINCT doc, type, value, n_articles, first_article, "
                             f"n_articles - 1 AS n_links FROM all_iocs JOIN shared USING (type, value)")
    none = "[]::VARCHAR[]"
    q["ttp_links"] = (
        f"WITH {A} SELECT doc, sent, pos, label AS tactic, text AS technique, to_json(coalesce((SELECT list(DISTINCT actor_key "
        f"ORDER BY actor_key) FROM am WHERE am.doc = m.doc AND am.sent = m.sent), {none}))::VARCHAR AS related_actors "
        f"FROM mentions m WHERE label IN {_in(config.TTP_LABELS)}")
    q["ioc_links"] = (
        f"WITH {A}{IOCS_CTE}, alone AS (SELECT DISTINCT doc, type, value FROM all_iocs), "
        f"ra AS (SELECT i.doc, i.type, i.value, list(DISTINCT actor_key ORDER BY actor_key) AS ra FROM alone i JOIN actors a "
        f"ON a.doc = i.doc AND contains(lower(i.value), a.actor_key) GROUP BY ALL), "
        f"rt AS (SELECT i.doc, i.type, i.value, list(DISTINCT m.text ORDER BY m.text) AS rt FROM men_iocs i JOIN mentions m "
        f"ON m.doc = i.doc AND m.sent = i.sent AND m.label IN {_in(config.TTP_LABELS)} GROUP BY ALL) "
        f"SELECT doc, type, value, to_json(coalesce(ra, {none}))::VARCHAR AS related_actors, "
        f"to_json(coalesce(rt, {none}))::VARCHAR AS related_ttps FROM alone LEFT JOIN ra USING (doc, type, value) "
        f"LEFT JOIN rt USING (doc, type, value)")
    at = "TIMESTAMP '2024-01-01 00:00:00' + to_days(CAST(doc % 3 AS INTEGER)) + to_hours(doc % 7)"
    q["ioc_seen"] = (f"WITH {M}{IOCS_CTE} SELECT type, value, strftime(min({at}), '%Y-%m-%d %H:%M:%S') AS first_seen, "
                     f"strftime(max({at}), '%Y-%m-%d %H:%M:%S') AS last_seen FROM all_iocs GROUP BY type, value")
    X = ANALYSIS_CTE
    draw = "CAST('0x' || substring(md5(doc || '#' || chunk_no || '#' || {0}), 1, 4) AS BIGINT)"
    waits = " + ".join(f"CASE WHEN attempt >= {n} THEN 1000 + (least(60000, 1000 * {2 ** (n - 1)}) - 1000) * {draw.format(n)} // 65536 ELSE 0 END"
                       for n in range(2, config.MAX_ATTEMPTS + 1))
    q["attempt_ledger"] = (
        f"WITH {X} SELECT doc, chunk_no, attempt, reply_class, {waits} AS asked_ms FROM classified c WHERE NOT EXISTS ("
        f"SELECT 1 FROM classified e WHERE e.doc = c.doc AND e.chunk_no = c.chunk_no AND e.attempt < c.attempt "
        f"AND e.reply_class IN ('a', 'b', 'c', 'e'))")
    q["analysis_requests"] = (f"WITH {X} SELECT doc, chunk_no, {_q(config.MODEL_NAME)} AS model, "
                              f"{_q(config.SYSTEM_PROMPT)} AS system, {_q(config.USER_PROMPT_PREFIX)} || chunk AS user, "
                              f"{config.TEMPERATURE} AS temperature, {config.REPLY_MAX_TOKENS} AS max_tokens FROM chunks")
    q["response_parse"] = (f"WITH {X} SELECT doc, chunk_no, attempt, reply_class, {_json_list_cols()} FROM classified")
    q["response_salvage"] = (f"WITH {X} SELECT doc, chunk_no, attempt, coalesce({SALVAGED}, false) AS salvaged, "
                             f"{SALVAGE} FROM replies")
    q["response_attempts"] = f"WITH {X} SELECT doc, chunk_no, attempt, reply_class FROM chosen"
    q["article_combine"] = f"WITH {X} SELECT doc, {_json_list_cols()} FROM combined"
    cut = (str(CHUNKS), str(small))
    q["article_combine_small"] = q["article_combine"].replace(*cut)
    classified = X[X.index("classified AS ("):X.index("chosen AS (")].rstrip().rstrip(",")
    q["reply_parse_landed"] = (
        "WITH replies AS (SELECT 'event ' || event_id AS doc, 0 AS pos, 0 AS chunk_no, 1 AS attempt, 'ok' AS status, "
        "props AS content FROM events UNION ALL SELECT 'turn ' || conv_id || ' ' || turn, 0, 0, 1, 'ok', text FROM conversations), "
        f"{classified} SELECT doc, reply_class, {_json_list_cols()} FROM classified")
    q["analysed_articles"] = f"WITH {X} SELECT doc, pos, title FROM analysed"
    q["unanalysed_articles"] = f"WITH {X} SELECT doc, pos, title FROM validated WHERE doc NOT IN (SELECT doc FROM combined)"
    q["report_summary"] = (f"WITH {X} SELECT pos, Executive_Summary AS executive_summary, Global_Impact AS global_impact "
                           f"FROM analysed")
    q["report_landscape"] = _first_seen("Threat_Actors", "actor", "'' AS description")
    q["report_threats"] = _first_seen("TTPs", "description", "NULL::VARCHAR AS severity")
    q["report_recommendations"] = _first_seen("Recommendations", "description", "NULL::VARCHAR AS priority")
    q["report_json"] = _report_sql(X, A)
    def firsts(field):
        return f"(SELECT min(pos) AS pos FROM (SELECT pos, unnest({field}) AS v FROM analysed) GROUP BY v)"
    q["report_published"] = f"WITH {X} " + " UNION ALL ".join(
        f"SELECT '20240102_030405' AS run_ts, '{section}' AS section, count(*) AS n_lines, min(pos) AS first_pos, max(pos) AS last_pos "
        f"FROM {source} HAVING count(*) > 0" for section, source in (
            ("header", "(SELECT 0::BIGINT AS pos)"), ("summary", "analysed"), ("landscape", firsts("Threat_Actors")),
            ("threat", firsts("TTPs")), ("recommendation", firsts("Recommendations")), ("article", "validated")))
    q["rejects"] = (
        f"WITH {X}, {_PAGE_LINKS} "
        f"SELECT 'build' AS stage, raw_url AS key, reject AS reason FROM built WHERE reject IS NOT NULL "
        f"UNION ALL SELECT 'validate', url, CASE WHEN coalesce(title, '') = '' THEN 'empty_title' "
        f"WHEN coalesce(text, '') = '' THEN 'empty_text' ELSE 'empty_url' END FROM deduped "
        f"WHERE NOT coalesce(title <> '' AND text <> '' AND url <> '', false) "
        f"UNION ALL SELECT 'link_resolve', page_id::VARCHAR || '#' || link_pos::VARCHAR, resolve_error FROM resolved WHERE resolve_error IS NOT NULL "
        f"UNION ALL SELECT 'analysis', doc || '#' || chunk_no::VARCHAR, 'non_string_text' FROM chosen WHERE reply_class = 'e' "
        f"UNION ALL SELECT 'analysis', doc || '#' || chunk_no::VARCHAR, 'no_usable_reply' FROM "
        f"(SELECT DISTINCT doc, chunk_no FROM classified WHERE attempt <= {config.MAX_ATTEMPTS}) c "
        f"WHERE NOT EXISTS (SELECT 1 FROM chosen h WHERE h.doc = c.doc AND h.chunk_no = c.chunk_no)")
    q["stage_counts"] = (
        f"WITH {X}, {_PAGE_LINKS}, sites AS ({sites}) SELECT 'pages' AS stage, count(*) AS n_rows FROM pages "
        + "".join(f"UNION ALL SELECT '{c}', coalesce(sum({c}), 0) FROM sites "
                  for c in ("links", "link_rejects", "article_links", "kept_links")) +
        f"UNION ALL SELECT 'build_rejects', count(*) FROM built WHERE reject IS NOT NULL "
        f"UNION ALL SELECT 'duplicates_skipped', (SELECT count(*) FROM built WHERE reject IS NULL) - count(*) FROM deduped "
        f"UNION ALL SELECT 'validate_rejects', (SELECT count(*) FROM deduped) - count(*) FROM validated "
        f"UNION ALL SELECT 'page_text', count(*) FROM page_text "
        f"UNION ALL SELECT 'articles_built', count(*) FROM built WHERE reject IS NULL "
        f"UNION ALL SELECT 'deduped', count(*) FROM deduped "
        f"UNION ALL SELECT 'validated', count(*) FROM validated "
        f"UNION ALL SELECT 'chunks', count(*) FROM chunks "
        f"UNION ALL SELECT 'chunk_analysis', count(*) FROM chunk_an "
        f"UNION ALL SELECT 'analysed_articles', count(*) FROM analysed")
    return q
