import re

from ioclake.llm.license_scan import RULES, SENTENCES, Rule, scan

DOCS = "doc_id long, text string, licences string, k int"


def brute(text, sentences=SENTENCES, rules=RULES):
    parts = [s for s in re.split(r"\s*\n\s*|(?<=[.!?])\s+", text or "") if s.strip(" ")]
    ids = [(n, sentences[k]) for n, s in enumerate(parts)
           if (k := re.sub(r"[\W_]+", " ", s.lower()).strip(" ")) in sentences]
    hits, at = [], 0
    while at < len(ids):
        for r in rules:
            part = ids[at:at + len(r.needs)]
            if tuple(i for _, i in part) == r.needs and (r.gaps or part[-1][0] - part[0][0] == len(r.needs) - 1):
                hits.append(r.licence)
                at += len(r.needs)
                break
        else:
            at += 1
    return len(parts), len(ids), len(hits), sorted(set(hits))


def run(spark, texts, **options):
    df = spark.createDataFrame([(i, t, "clash", 1) for i, t in enumerate(texts)], DOCS)
    got = {r.doc_id: tuple(r)[1:] for r in scan(df, **options).collect()}
    return [(a, b, c, list(d)) for a, b, c, d in (got[i] for i in range(len(texts)))]


def test_texts(spark):
    grant = [k for k, v in SENTENCES.items() if v == "mit-grant"][0]
    rule = [k for k, v in SENTENCES.items() if v == "mit-condition"][0]
    texts = [None, "", " \n\n ", "Prose. More prose!", "a\nReleased under the MIT License.\nb",
             "LICENSED under the Apache License, Version 2.0. You may not use this file except in compliance with the License.",
             f"Released under the MIT License.\nfiller here\n{grant}.\n{rule}.\nmore", f"{rule}. {grant}.",
             "Licensed under CC BY-NC 4.0. Licensed under CC BY-NC 4.0.\nReleased under the MIT License.",
             "This is not released under the MIT License.", "x. " * 5000 + "All rights reserved."]
    assert run(spark, texts) == [brute(t) for t in texts]
    assert run(spark, texts)[6][2:] == (1, ["MIT"])


def test_order_of_rules_gaps_and_use_of_sentences(spark):
    known = {"a": "A", "b": "B", "c": "C"}
    rules = (Rule("AB", ("A", "B")), Rule("A..C", ("A", "C"), True), Rule("A", ("A",)), Rule("B", ("B",)))
    texts = ["a. b. a. x. c.", "a. x. b.", "a. a. b. c. b.", "c. c.", "A!\nB?"]
    assert run(spark, texts, sentences=known, rules=rules) == [brute(t, known, rules) for t in texts]


def test_empty_table_and_real_documents(spark):
    from tests.llm.conftest import SF
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    got = {r.doc_id: (r.n_sentences, r.n_known, r.n_matches, list(r.licences)) for r in scan(docs).collect()}
    assert got == {r.doc_id: brute(r.text) for r in docs.collect()}
    assert scan(docs.limit(0)).count() == 0


MIT = """MIT License

Copyright (c) 2020 Some One

Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
copies of the Software, and to permit persons to whom the Software is
furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all
copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND.
"""
APACHE = """Licensed under the Apache License, Version 2.0 (the "License");
you may not use this file except in compliance with the License.
You may obtain a copy of the License at

    http://www.apache.org/licenses/LICENSE-2.0

Unless required by applicable law or agreed to in writing, software
distributed under the License is distributed on an "AS IS" BASIS.
"""
BSD = """Copyright (c) 2020, Some One
All rights reserved.

Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:
1. Redistributions of source code must retain the above copyright notice, this
   list of conditions and the following disclaimer.
2. Redistributions in binary form must reproduce the above copyright notice,
   this list of conditions and the following disclaimer in the documentation
   and/or other materials provided with the distribution.
"""
NAMES = """3. Neither the name of the copyright holder nor the names of its
   contributors may be used to endorse or promote products derived from
   this software without specific prior written permission.
"""
GPL = """This program is free software: you can redistribute it and/or modify
it under the terms of the GNU General Public License as published by
the Free Software Foundation, either version 3 of the License, or
(at your option) any later version.

This program is distributed in the hope that it will be useful,
but WITHOUT ANY WARRANTY; without even the implied warranty of
MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.  See the
GNU General Public License for more details.
"""
MPL = """This Source Code Form is subject to the terms of the Mozilla Public
License, v. 2.0. If a copy of the MPL was not distributed with this
file, You can obtain one at https://mozilla.org/MPL/2.0/.
"""


def test_genuine_texts_wrapped_and_not(spark):
    gpl2 = GPL.replace("version 3", "version 2")
    agpl = GPL.replace("GNU General", "GNU Affero General")
    lgpl = GPL.replace("This program", "This library").replace("GNU General", "GNU Lesser General").replace("n 3", "n 2.1")
    genuine = [(MIT, "MIT"), (APACHE, "Apache-2.0"), (BSD, "BSD"), (BSD + NAMES, "BSD-3-Clause"),
               (GPL, "GPL-3.0-or-later"), (gpl2, "GPL-2.0-or-later"), (agpl, "AGPL-3.0-or-later"),
               (lgpl, "LGPL-2.1-or-later"), (MPL, "MPL-2.0")]
    unwrapped = [re.sub(r"(?<!\n)\n(?!\n)", " ", t) for t, _ in genuine]
    commented = ["".join(f" * {line}\n" for line in t.split("\n")) for t, _ in genuine]
    inside = [f"some prose without a stop\n{t}more prose" for t, _ in genuine]
    want = [[x] for _, x in genuine]
    for texts in ([t for t, _ in genuine], commented, inside):
        assert [r[3] for r in run(spark, texts)] == want
    # BSD's first clause is no sentence of its own there: it follows a heading on the same line
    assert [r[3] for r in run(spark, unwrapped)][:2] == want[:2] and [r[3] for r in run(spark, unwrapped)][4:] == want[4:]


def test_wrapped_sentences_count_once_and_do_not_join_over_breaks(spark):
    known = {"a b c": "ABC", "a b": "AB", "d": "D"}
    rules = (Rule("ABCD", ("ABC", "D")), Rule("AB", ("AB",)))
    texts = ["x\na\nb\nc\nd", "a\nb\n\nc", "a.\nb c", "a b\nx c", "y a\nb c", "a\nb\na b\nc\nd y"]
    assert run(spark, texts, sentences=known, rules=rules) == [
        (3, 2, 1, ["ABCD"]), (2, 1, 1, ["AB"]), (2, 0, 0, []), (2, 1, 1, ["AB"]), (2, 0, 0, []), (3, 2, 1, ["AB"])]
