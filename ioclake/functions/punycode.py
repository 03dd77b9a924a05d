"""Host names in ASCII: each label with other characters becomes ``xn--``
and its Bootstring encoding (RFC 3492), as one SQL expression.

The encoder is a fold over (inserted code point, code point of the label), with a
fold for the digits of a number and one for the bias inside.  A label has at most
63 characters, longer ones are refused before they are encoded, so the folds are
short; ASCII hosts never reach them.
"""

from __future__ import annotations

# fixed values of the encoding: base, least and most threshold, skew, damping,
# first bias, first code point, digits
BASE, T_MIN, T_MAX, SKEW, DAMP, BIAS, FIRST = 36, 1, 26, 38, 700, 72, 128
DIGITS = "abcdefghijklmnopqrstuvwxyz0123456789"
LONGEST = 63
#: characters that count as a dot in a host
DOTS = "。．｡"


def _let(value: str, var: str, body: str) -> str:
    return f"transform(array({value}), {var} -> {body})[0]"


def _number(delta: str, bias: str) -> str:
    """Digits of ``delta`` in the variable-length code."""
    digit = f"substring('{DIGITS}', cast({{}} as int) + 1, 1)"
    more = digit.format(f"t + (v.q - t) % ({BASE} - t)")
    step = _let(f"greatest({T_MIN}L, least({T_MAX}L, {BASE} * k - {bias}))", "t",
                f"if(v.q < t, named_struct('q', 0L, 'o', concat(v.o, {digit.format('v.q')}), 'e', true), "
                f"named_struct('q', (v.q - t) div ({BASE} - t), 'o', concat(v.o, {more}), 'e', false))")
    return (f"aggregate(sequence(1L, 12L), named_struct('q', {delta}, 'o', '', 'e', false), "
            f"(v, k) -> if(v.e, v, {step}), v -> v.o)")


def _adapted(delta: str, points: str, first: str) -> str:
    """The bias after a number."""
    damped = _let(f"{delta} div if({first}, {DAMP}L, 2L)", "d0", f"d0 + d0 div {points}")
    limit = (BASE - T_MIN) * T_MAX // 2
    shrunk = (f"aggregate(sequence(1, 12), named_struct('d', {damped}, 'k', 0L), (a, n) -> if(a.d > {limit}, "
              f"named_struct('d', a.d div {BASE - T_MIN}, 'k', a.k + {BASE}), a))")
    return _let(shrunk, "w", f"w.k + ({BASE - T_MIN + 1} * w.d) div (w.d + {SKEW})")


def _encoded(label: str) -> str:
    """``xn--`` and the encoding of a label that is not all ASCII."""
    emit = ("named_struct('n', x.m, 'd', 0L, 'b', " + _adapted("d1", "(s.h + 1)", "s.h = p.basic")
            + ", 'h', s.h + 1, 'o', concat(s.o, " + _number("d1", "s.b") + "))")
    skip = "named_struct('n', x.m, 'd', d1 + if(x.c < x.m, 1L, 0L), 'b', s.b, 'h', s.h, 'o', s.o)"
    here = _let("if(x.i = 0, s.d + (x.m - s.n) * (s.h + 1), s.d)", "d1", f"if(x.c = x.m, {emit}, {skip})")
    step = _let(here, "r", "if(x.i = size(p.cs) - 1, named_struct('n', r.n + 1, 'd', r.d + 1, 'b', r.b, 'h', r.h, 'o', r.o), r)")
    items = ("flatten(transform(array_sort(array_distinct(filter(p.cs, c -> c > 127))), "
             "m -> transform(p.cs, (c, i) -> named_struct('m', m, 'c', c, 'i', i))))")
    fold = (f"aggregate({items}, named_struct('n', {FIRST}L, 'd', 0L, 'b', {BIAS}L, 'h', p.basic, "
            f"'o', if(p.basic > 0, concat(p.plain, '-'), '')), (s, x) -> {step}, s -> concat('xn--', s.o))")
    chars = f"regexp_extract_all({label}, '(?s).', 0)"
    parts = _let(chars, "ch", "named_struct('cs', transform(ch, c -> cast(ascii(c) as bigint)), "
                 "'plain', array_join(filter(ch, c -> ascii(c) < 128), ''), "
                 "'basic', cast(size(filter(ch, c -> ascii(c) < 128)) as bigint))")
    return _let(parts, "p", fold)


def ascii_host_sql(host: str) -> str:
    """SQL expression: the lower-case ``host`` in ASCII; null where a label
    has more than 63 characters, before or after."""
    label = f"if(l rlike '^[\\\\x00-\\\\x7F]*$', l, if(length(l) > {LONGEST}, null, {_encoded('l')}))"
    labels = f"transform(split(translate(hs, '{DOTS}', '...'), '[.]'), l -> {label})"
    whole = _let(labels, "ls", f"if(exists(ls, l -> l is null or length(l) > {LONGEST}), null, array_join(ls, '.'))")
    return _let(host, "hs", f"if(hs rlike '^[\\\\x00-\\\\x7F]*$', hs, {whole})")
