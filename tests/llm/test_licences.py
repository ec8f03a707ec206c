import re

from bidlines.llm.licences import ALIKE, RUN, TEMPLATES, UNKNOWN, UNLIKE, gate_words, grams, op2_licences, scan_licences, train, words


def test_table_equals_search_for_the_wordings(spark):
    sf = "/root/testdata/sf0.01"
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    got = {r["doc_id"]: r for r in op2_licences(spark, sf).collect()}
    assert got.keys() == texts.keys()
    for i, text in texts.items():
        want = {f for f, ts in TEMPLATES.items() for t in ts if re.search(rf"^.*{re.escape(t)}.*$", text, re.M)}
        assert set(filter(None, got[i]["families"].split(","))) == want


def test_wordings_and_unlike_paragraphs(spark, docs_of):
    texts = [(f, f"Some words.\nCopyright 2020 by somebody. {t}\nMore.") for f, ts in TEMPLATES.items() for t in ts]
    docs = docs_of([(i, t) for i, (_, t) in enumerate(texts)] + [(1000 + i, t) for i, t in enumerate(UNLIKE)] + [(2000, None), (2000, None), (2001, ""), (None, "x\n" * 30_000 + TEMPLATES["MIT"][0]), (3000, "The licence of the inn was lost.")])
    got = [(r["doc_id"], [x["family"] for x in r["licences"]]) for r in scan_licences(docs, train()).collect()]
    assert len(got) == docs.count()
    for i, families in got:
        if i is None:
            assert families == ["MIT"]
        elif i < 1000:
            assert families == [texts[i][0]], texts[i]
        else:
            assert set(families) <= {UNKNOWN}
    assert scan_licences(docs_of([])).count() == 0


MIT_TEXT = """\
Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
copies of the Software, and to permit persons to whom the Software is
furnished to do so, subject to the following conditions:"""
BSD_TEXT = """\
Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions
are met:"""
GPL_TEXT = """\
# This program is free software: you can redistribute it and/or modify
# it under the terms of the GNU General Public License as published by
# the Free Software Foundation, either version 3 of the License, or
# (at your option) any later version."""
APACHE_TEXT = """\
 * Unless required by applicable law or agreed to in writing, software
 * distributed under the License is distributed on an "AS IS" BASIS,
 * WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied."""


def families(spark, docs_of, texts):
    got = scan_licences(docs_of(list(enumerate(texts))), train()).collect()
    return [[(x["line"], x["family"]) for x in r["licences"]] for r in sorted(got, key=lambda r: r["doc_id"])]


def test_hard_wrapped_notices(spark, docs_of):
    notices = {"MIT": MIT_TEXT, "BSD": BSD_TEXT, "GPL": GPL_TEXT, "Apache-2.0": APACHE_TEXT}
    narrow = "\n".join(MIT_TEXT.split(" "))
    texts = [*notices.values(), *[f"One line.\nAnother line of the text.\n{t}\n\nThe end of it." for t in notices.values()], narrow, f"{BSD_TEXT}\n{'word ' * 200}\n{GPL_TEXT}"]
    got = families(spark, docs_of, texts)
    for f, found in zip([*notices, *notices, "MIT"], got, strict=False):
        assert [x[1] for x in found] == [f]
    assert {x[1] for x in got[-1]} == {"BSD", "GPL"}


def test_short_forms_headings_and_tags(spark, docs_of):
    want = {"Text available as CC BY-SA 4.0.": "CC-BY-SA", "Released under GPLv3.": "GPL", "See the AGPLv3 for more.": "AGPL", "// SPDX-License-Identifier: Apache-2.0": "Apache-2.0", "SPDX-License-Identifier: MIT": "MIT", "Apache License\nVersion 2.0, January 2004": "Apache-2.0", "The MIT License (MIT)": "MIT", "SPDX-License-Identifier: Zlib": UNKNOWN}
    got = families(spark, docs_of, want)
    assert [{x[1] for x in found} for found in got] == [{f} for f in want.values()]


def test_gate_holds_a_word_of_all_that_can_be_confirmed():
    gate = set(gate_words())
    for wording in (t for ts in TEMPLATES.values() for t in ts):
        pairs = grams(words(wording), (2,))
        assert sum(not gate & set(p.split(" ")) for p in pairs) / len(pairs) < ALIKE
        assert len(words(wording)) * 2 <= RUN


def test_unknown_lines_beside_a_wrapped_notice_stay_unknown(spark, docs_of):
    texts = [f"The licence of the inn was lost.\n{BSD_TEXT}\nHe asked about the copyright of the song.", "The licence of the inn was lost.\nReleased under the MIT License."]
    got = families(spark, docs_of, texts)
    assert sorted(x[1] for x in got[0]) == ["BSD", UNKNOWN, UNKNOWN]
    assert got[1] == [(0, UNKNOWN), (1, "MIT")]
