"""Licence scans by sentence rules.

Texts are cut into sentences at line ends and at stops followed by white space;
a sentence is normalised to its lower-case words of letters and digits.  Lines
with neither a stop nor a blank line between them are joined where together they
are a known sentence (the longest one from the first line that starts one), so a
wrapped sentence is known as well; it counts as one sentence.  Each known
sentence gives an identifier; rules are ordered, each a sequence of identifiers,
and at each position of a document's identifier sequence the first rule that
matches is taken and its sentences are used up.  Sentences of a sequence must
follow each other, but sentences without an identifier may stand between lines
of a licence only where the rule allows gaps.

Everything is SQL functions: the look-up is a map of fixed size, asked only at
lines whose first words open a known sentence; rules are tested by array
comparisons on the few identified sentences of a document.

Defined results: null or blank text has no sentence and no licence; equal rows
give equal rows; extra columns are ignored.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: between lines that never belong to one sentence, and between those that may
BREAK, LINE_END = r"(?<=[.!?])\s+|\s*\n\s*\n\s*", r"\s*\n\s*"


def _plain(text: str) -> str:
    return re.sub(r"[\W_]+", " ", text.lower()).strip()


# fixed values: names of licences in one-line notices
NAMES = {
    "MIT": ("MIT License",),
    "Apache-2.0": ("Apache License, Version 2.0", "Apache License 2.0", "Apache 2.0 License"),
    "GPL-2.0-only": ("GNU General Public License version 2", "GNU General Public License v2.0", "GPLv2"),
    "GPL-2.0-or-later": ("GNU General Public License version 2 or later", "GNU General Public License v2.0 or later"),
    "GPL-3.0-only": ("GNU General Public License version 3", "GNU General Public License v3.0", "GPLv3"),
    "GPL-3.0-or-later": ("GNU General Public License version 3 or later", "GNU General Public License v3.0 or later"),
    "LGPL-2.1-only": ("GNU Lesser General Public License version 2.1", "GNU Lesser General Public License v2.1"),
    "LGPL-3.0-only": ("GNU Lesser General Public License version 3", "GNU Lesser General Public License v3.0"),
    "AGPL-3.0-only": ("GNU Affero General Public License version 3", "GNU Affero General Public License v3.0"),
    "MPL-2.0": ("Mozilla Public License, Version 2.0", "Mozilla Public License 2.0"),
    "ISC": ("ISC License",),
    "BSD-2-Clause": ("BSD 2-Clause License", "Simplified BSD License"),
    "BSD-3-Clause": ("BSD 3-Clause License", "New BSD License"),
    "CC-BY-4.0": ("CC BY 4.0", "Creative Commons Attribution 4.0 International License"),
    "CC-BY-SA-4.0": ("CC BY-SA 4.0", "Creative Commons Attribution-ShareAlike 4.0 International License"),
    "CC-BY-NC-4.0": ("CC BY-NC 4.0", "Creative Commons Attribution-NonCommercial 4.0 International License"),
}
SPDX = (*NAMES, "LGPL-2.1-or-later", "LGPL-3.0-or-later", "AGPL-3.0-or-later", "Unlicense")
OPENINGS = ("Licensed under", "Released under", "Distributed under", "This project is licensed under",
            "This work is licensed under", "This program is licensed under", "This software is licensed under")

_FREE = "This {thing} is free software: you can redistribute it and/or modify it under the terms of the GNU {name} " \
    "as published by the Free Software Foundation, "
_GNU = {"GPL": ("General Public License", "program", ("2", "3")),
        "LGPL": ("Lesser General Public License", "library", ("2.1", "3")),
        "AGPL": ("Affero General Public License", "program", ("3",))}

# fixed values: whole licence sentences and their identifiers
TEXTS = {
    "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
    "documentation files (the \"Software\"), to deal in the Software without restriction, including without "
    "limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the "
    "Software, and to permit persons to whom the Software is furnished to do so, subject to the following "
    "conditions:": "mit-grant",
    "The above copyright notice and this permission notice shall be included in all copies or substantial portions "
    "of the Software.": "mit-condition",
    "The above copyright notice and this permission notice (including the next paragraph) shall be included in all "
    "copies or substantial portions of the Software.": "mit-condition",
    "Licensed under the Apache License, Version 2.0 (the \"License\")": "Apache-2.0-notice",
    "you may not use this file except in compliance with the License.": "apache2-compliance",
    "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance "
    "with the License.": "apache2-grant",
    "You may obtain a copy of the License at": "licence-copy",
    "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0": "licence-copy",
    "You may obtain a copy of the License at https://www.apache.org/licenses/LICENSE-2.0": "licence-copy",
    "This Source Code Form is subject to the terms of the Mozilla Public License, v": "mpl-subject",  # a stop follows
    "If a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/.":
        "mpl2-copy",
    "If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/.":
        "mpl2-copy",
    "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
    "granted, provided that the above copyright notice and this permission notice appear in all copies.": "isc-grant",
    "Permission to use, copy, modify, and distribute this software for any purpose with or without fee is hereby "
    "granted, provided that the above copyright notice and this permission notice appear in all copies.": "isc-grant",
    "This is free and unencumbered software released into the public domain.": "unlicense",
    "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
    "following conditions are met:": "bsd-grant",
    "Redistributions of source code must retain the above copyright notice, this list of conditions and the following "
    "disclaimer.": "bsd-source",
    "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the "
    "following disclaimer in the documentation and/or other materials provided with the distribution.": "bsd-binary",
    "All advertising materials mentioning features or use of this software must display the following "
    "acknowledgement:": "bsd-advert",
    "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote "
    "products derived from this software without specific prior written permission.": "bsd-names",
    "All rights reserved.": "all-rights",
} | {
    _FREE.format(thing=t, name=name) + tail: f"{short}-{v if '.' in v else v + '.0'}-{kind}-grant"
    for short, (name, thing, versions) in _GNU.items() for v in versions for t in {thing, "program"}
    for kind, tail in (("or-later", f"either version {v} of the License, or (at your option) any later version."),
                       ("only", f"version {v} of the License."), ("only", f"version {v}."))
}
SENTENCES = {_plain(s): i for s, i in TEXTS.items()} | {
    _plain(f"{o} {the}{name}"): f"{licence}-notice" for licence, names in NAMES.items() for name in names
    for o in OPENINGS for the in ("the ", "")
} | {_plain(f"SPDX-License-Identifier: {i}"): f"{i}-notice" for i in SPDX}


@dataclass(frozen=True)
class Rule:
    licence: str
    needs: tuple[str, ...]
    gaps: bool = False  # sentences without an identifier may stand between


_BSD = ("bsd-grant", "bsd-source", "bsd-binary")
# fixed values: rules in order; the first that matches at a sentence is taken
RULES = (
    Rule("MIT", ("MIT-notice", "mit-grant", "mit-condition"), True),
    Rule("MIT", ("mit-grant", "mit-condition"), True),
    Rule("Apache-2.0", ("Apache-2.0-notice", "apache2-compliance", "licence-copy"), True),
    Rule("Apache-2.0", ("Apache-2.0-notice", "apache2-compliance")),
    Rule("Apache-2.0", ("apache2-grant", "licence-copy"), True),
    Rule("MPL-2.0", ("mpl-subject", "mpl2-copy"), True),
    Rule("BSD-4-Clause", (*_BSD, "bsd-advert"), True),
    Rule("BSD-3-Clause", (*_BSD, "bsd-names"), True),
    Rule("MIT", ("mit-grant",)),
    Rule("Apache-2.0", ("apache2-grant",)),
    Rule("ISC", ("isc-grant",)),
    Rule("Unlicense", ("unlicense",)),
    Rule("BSD", ("bsd-grant",)),
    *(Rule(i.removesuffix("-grant"), (i,)) for i in sorted(set(TEXTS.values())) if i.endswith(("only-grant", "later-grant"))),
    *(Rule(i, (f"{i}-notice",)) for i in SPDX),
)


def normalised(sentence: Column) -> Column:
    return F.btrim(F.regexp_replace(F.lower(sentence), r"[^\p{L}\p{N}]+", " "))


def _with(value: Column, use) -> Column:
    """``use(value)``, the value worked out once."""
    return F.element_at(F.transform(F.array(value), use), 1)


def _opens(known: dict[str, str]):
    """Whether a line's first two words, or its only one, open a known sentence."""
    heads = sorted({" ".join(s.split(" ")[:n]) for s in known for n in (1, 2)})
    alone, two = [h for h in heads if " " not in h], [h for h in heads if " " in h]
    both = F.array(*[F.lit(h) for h in alone + two])
    return lambda line: F.array_contains(both, F.substring_index(line, " ", 2))


def _identified(known: dict[str, str], ids: list[str]):
    """Lines of one stretch without a break -> the identifier, or null, of
    each sentence; lines that are a known sentence together are one."""
    lookup = F.create_map(*[F.lit(x) for s, i in known.items() for x in (s, ids.index(i))])
    every, most = F.array(*[F.lit(s) for s in known]), max(len(s.split(" ")) for s in known)
    opens, none = _opens(known), F.lit(None).cast("int")

    def run(lines: Column) -> Column:
        def joined(i: Column, n) -> Column:
            return F.array_join(F.slice(lines, i + 1, n), " ")

        def longest(i: Column) -> Column:
            """How many lines from ``i`` on are a known sentence (null: none)."""
            left = F.least(F.lit(most), F.size(lines) - i)
            starts = _with(joined(i, left), lambda rest: F.filter(every, lambda s: F.startswith(rest, s)))
            return _with(starts, lambda some: F.when(F.size(some) > 0, F.array_max(F.filter(
                F.sequence(F.lit(1), left), lambda n: F.array_contains(some, joined(i, n))))))

        spans = F.transform(lines, lambda line, i: F.when(opens(line), longest(i)))

        def step(acc: Column, x: Column) -> Column:
            taken = F.when(x.n.isNotNull(), lookup[joined(x.i, x.n)])
            return F.when(x.i < acc.free, acc).otherwise(F.struct(
                (x.i + F.coalesce(x.n, F.lit(1))).alias("free"), F.concat(acc.ids, F.array(taken)).alias("ids")))

        start = F.struct(F.lit(0).alias("free"), F.array().cast("array<int>").alias("ids"))
        merged = F.aggregate(F.transform(spans, lambda n, i: F.struct(i.alias("i"), n.alias("n"))), start, step,
                             lambda acc: acc.ids)
        return F.when(F.exists(lines, opens), merged).otherwise(F.array_repeat(none, F.size(lines)))

    return run


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
         sentences: dict[str, str] | None = None, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Per row: the id, n_sentences, n_known (sentences with an identifier),
    n_matches, and ``licences``, the distinct licences found, sorted."""
    known = sentences or SENTENCES
    ids = sorted(set(known.values()) | {i for r in rules for i in r.needs})
    text = F.coalesce(F.col(text_col), F.lit(""))
    identified = _identified(known, ids)
    cut = F.transform(F.split(text, BREAK), lambda s: _with(F.transform(F.filter(
        F.split(s, LINE_END), lambda x: F.length(F.btrim(x)) > 0), normalised), identified))
    d = docs.select(F.col(id_col), F.flatten(cut).alias("s"))
    found = F.transform("s", lambda s, i: F.struct(i.alias("pos"), s.alias("id")))
    d = d.select(id_col, F.size("s").cast("long").alias("n_sentences"),
                 F.filter(found, lambda x: x.id.isNotNull()).alias("k"))

    def fits(rule: Rule, at: Column) -> Column:
        part = F.slice("k", at + 1, len(rule.needs))
        ok = F.transform(part, lambda x: x.id) == F.array(*[F.lit(ids.index(i)) for i in rule.needs])
        return ok if rule.gaps or len(rule.needs) == 1 else ok & (
            F.element_at(part, -1).pos - F.element_at(part, 1).pos == len(rule.needs) - 1)

    def step(acc: Column, at: Column) -> Column:
        rule = F.lit(-1)
        for n in reversed(range(len(rules))):
            rule = F.when(fits(rules[n], at), n).otherwise(rule)
        size = F.array(*[F.lit(len(r.needs)) for r in rules])
        chosen = F.when(at < acc.free, F.lit(-1)).otherwise(rule)
        return _with(chosen, lambda c: F.when(c < 0, acc).otherwise(F.struct(
            (at + F.element_at(size, c + 1)).alias("free"), F.concat(acc.hits, F.array(c)).alias("hits"))))

    start = F.struct(F.lit(0).alias("free"), F.array().cast("array<int>").alias("hits"))
    places = F.when(F.size("k") > 0, F.sequence(F.lit(0), F.size("k") - 1)).otherwise(F.array().cast("array<int>"))
    names = F.array(*[F.lit(r.licence) for r in rules])
    return d.withColumn("hits", F.aggregate(places, start, step, lambda a: a.hits)) \
        .select(id_col, "n_sentences", F.size("k").cast("long").alias("n_known"),
                F.size("hits").cast("long").alias("n_matches"),
                F.array_sort(F.array_distinct(F.transform("hits", lambda h: F.element_at(names, h + 1))))
                .alias("licences"))
