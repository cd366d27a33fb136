"""HTML extraction, licence rules and chat formatting."""

import os
import random
import re
import time

import duckdb
import pytest

from llm.cases import SMALL
from orderloom.llm import chat, html_text, licences, queries


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for file in os.listdir(SMALL):
        con.execute(f"create view {file.split('.')[0]} as select * from '{SMALL}/{file}'")
    return con


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_statements(spark, duck, name):
    df = queries.queries()[name](spark, SMALL)
    cursor = duck.execute(queries.oracle_sql()[name])
    names = [c[0] for c in cursor.description]
    assert sorted(names) == sorted(df.columns)
    assert sorted(map(repr, (tuple(r) for r in df.select(*names).collect()))) == sorted(map(repr, cursor.fetchall()))


def test_every_operator_has_a_query():
    numbers = sorted(int(name[2:].split("_")[0]) for name in queries.queries())
    assert numbers == list(range(1, 14))


# ------------------------------------------------------------------------------- HTML


@pytest.mark.parametrize(
    ("html", "text"),
    [
        ("", ""),
        ("plain  text\n here", "plain text here"),
        ("<p>one<p>two<div>three</div>four", "one\n\ntwo\n\nthree\nfour"),
        ("a<br>b<br><br>c", "a\nb\n\nc"),
        ("<ul><li>x<li>y<ol start=4><li>z<li>w</ol></ul>after", "- x\n- y\n  4. z\n  5. w\n\nafter"),
        ("<table><tr><th>n<th>name<tr><td>1<td>long name<td>x<tr><td colspan=2>both<td>y</table>", "n | name\n1 | long name | x\nboth          | y"),
        ("<table><tr><td><p>a</p><p>b</p></td><td>c</table>", "a | c\n  |\nb |"),
        ("<table><tr><td>one<ul><li>x<li>y</ul></td><td>B<tr><td>q<td>r</table>", "one | B\n    |\n- x |\n- y |\nq   | r"),
        ("<table><tr><td rowspan=2>a<td>b<tr><td>c<tr><td>d<td>e</table>", "a | b\n  | c\nd | e"),
        ("<table><tr><td colspan=2 rowspan=2>wide<td>b<tr><td>c<tr><td>1<td>2<td>3</table>", "wide  | b\n  |   | c\n1 | 2 | 3"),
        ("<table><tr><td>k<td>" + "w" * 90 + "<td>z<tr><td>m<td>n<td>o</table>", "k | " + "w" * 90 + " | z\nm | n" + " " * 89 + " | o"),
        ("<table><tr><td>menu<td><p>" + "long " * 50 + "<p>second<tr><td>foot</table>", "menu\n\n" + ("long " * 50).strip() + "\n\nsecond\n\nfoot"),
        ("<details><summary>s</summary>in</details><details open><summary>t</summary>shown</details>", "s\nt\nshown"),
        ("<head><title>t</title><style>s</style></head><body>v<script>s</script><template>t</template>", "v"),
        ("<p hidden>a</p><p style='color:red; DISPLAY : none'>b</p><p style='visibility:hidden'>c</p>d<!-- e -->", "d"),
        ("<pre>a  b\n\n   c</pre>d", "a  b\n\n   c\n\nd"),
        ("<blockquote>q<p>r</blockquote>", "> q\n> \n> r".replace("> \n", "\n")),
        ("<dl><dt>term<dd>text<dt>next<dd>more</dl>", "term\n  text\nnext\n  more"),
        ("x &lt;b&gt; &amp; &eacute;&#233;&nbsp;y", "x <b> & éé\xa0y"),
        ("</p></b>stray <b><i>mis</b>nested</i> end", "stray misnested end"),
        ("<select><option>a<option>b</select>", "a\nb"),
        ("a<hr>b", "a\n\n--------\n\nb"),
        ("<meta charset=utf-8><p>no head", "no head"),
    ],
)
def test_visible_text(html, text):
    assert html_text.visible_text(html) == text


def test_deep_and_broken_markup():
    assert html_text.visible_text("<div>" * 100_000 + "x") == "x"
    assert html_text.visible_text("<ul><li>" * 600 + "x").endswith("x")
    deep = "<div>" * 450 + "<script>SECRET</script><p hidden>HID</p>vis" + "</div>" * 450 + "after"
    assert html_text.visible_text(deep) == "vis\nafter"
    assert html_text.visible_text("<b>" * 50_000 + "<hr>" * 50_000 + "</i>" * 50_000).count("-" * 8) == 50_000
    for broken in ("<", "<<<>>>", "<p", "<!--", "<![CDATA[x", "</", "<a href='", "&#xFFFFFFFF;", "<table><td>x"):
        html_text.visible_text(broken)


def test_long_paragraphs_take_time_in_proportion():
    html = "<p>" + "some <b>words</b> and &amp; more " * 100_000
    start = time.perf_counter()
    assert html_text.visible_text(html) == ("some words and & more " * 100_000).strip()
    assert time.perf_counter() - start < 20


def _random_page(rng, depth=0):
    """Markup of a random tree, with the words that are seen and the mark of a table in it."""
    if depth > 5 or rng.random() < 0.3:
        words = [f"w{rng.randrange(10**6)}" for _ in range(rng.randint(1, 3))]
        return rng.choice(["", " "]).join([" ", " ".join(words), " "]), words, False
    parts = [_random_page(rng, depth + 1) for _ in range(rng.randint(1, 3))]
    kind = rng.choice(["div", "span", "p-div", "li", "b", "blockquote", "script", "hidden", "style", "details", "table", "section", "dl"])
    html, words = "".join(p[0] for p in parts), [w for p in parts for w in p[1]]
    table = any(p[2] for p in parts)
    if kind in ("script", "hidden", "style"):
        inner = "".join(w + " " for w in words)
        shown = {"script": f"<script>{inner}</script>", "hidden": f"<div hidden>{html}</div>", "style": f"<span style='display: none'>{html}</span>"}
        return shown[kind], [], table
    if kind == "details":
        return f"<details>{'' if rng.random() < 0.5 else '<i>'}<summary>s{len(words)}</summary>{html}</details>".replace("<i>", ""), [f"s{len(words)}"], table
    if kind == "li":
        return "<ul>" + "".join(f"<li>{p[0]}</li>" for p in parts) + "</ul>", words, table
    if kind == "dl":
        return "<dl>" + "".join(f"<dt>{p[0]}</dt>" for p in parts) + "</dl>", words, table
    if kind == "table":
        return "<table><tr>" + "".join(f"<td rowspan={rng.randint(1, 3)}>{p[0]}</td>" for p in parts) + "</tr></table>", words, True
    tag = "div" if kind == "p-div" else kind
    return f"<{tag}>{html}</{tag}>", words, table


@pytest.mark.parametrize("seed", range(300))
def test_random_trees_show_all_visible_words_and_no_other(seed):
    rng = random.Random(seed)
    html, words, table = _random_page(rng)
    shown = re.findall(r"\b[ws][0-9]+", html_text.visible_text(f"<html><body>{html}</body></html>"))
    # Cells of a row stand beside each other, so only the set of words is known there.
    assert sorted(shown) == sorted(words) if table else shown == words


def test_extract_rows(spark):
    rows = [(1, "u", "<p>a"), (1, "u", "<p>a"), (2, None, None), (3, "v", ""), (None, "w", "<br>" * 1000 + "é")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "'clash' as text", "1 as n", "2 as _html")
    found = html_text.extract(pages)
    assert found.columns == ["page_id", "url", "n", "_html", "text"]
    assert sorted((str(r["page_id"]), r["text"]) for r in found.collect() if r["text"] is not None) == [("1", "a"), ("1", "a"), ("3", ""), ("None", "é")]
    assert found.filter("text is null").count() == 1
    assert html_text.extract(pages.limit(0)).count() == 0


# --------------------------------------------------------------------------- licences


def test_licences_of_odd_rows(odd_docs):
    found = licences.recognise(odd_docs)
    assert found.count() == odd_docs.count()
    assert {(r["n_sentences"], r["sentence_ids"], r["licences"]) for r in found.collect()} == {(0, "", "")}
    assert licences.recognise(odd_docs.limit(0)).count() == 0


def test_licence_rules_in_order(make_docs):
    source, binary, names = (licences.SENTENCES[k][0] for k in ("bsd-source", "bsd-binary", "bsd-names"))
    intro = licences.SENTENCES["bsd-intro"][0]
    wrapped = "Licensed under the\nApache License,\nVersion 2.0.\nYou may not use this file except in\ncompliance with the License. Text."
    texts = [
        f"{intro}:\n* {source}.\n* {binary}.\n* {names}.",
        f"{intro}: {source}. {binary}.",
        "no stop before\nReleased under the MIT License.\nmore",
        "Released under the MIT License. Licensed under CC BY-NC 4.0.",
        "Released under the MIT License.\nReleased under the MIT License.",
        wrapped,
        "not Released under the MIT License",
    ]
    found = {r["doc_id"]: (r["n_sentences"], r["licences"]) for r in licences.recognise(make_docs(list(enumerate(texts)))).collect()}
    assert found == {
        0: (4, "BSD-3-Clause"), 1: (3, "BSD-2-Clause"), 2: (1, "MIT"), 3: (2, "MIT CC-BY-NC-4.0"), 4: (2, "MIT"), 5: (2, "Apache-2.0"), 6: (0, ""),
    }


def test_licences_with_their_own_punctuation(make_docs):
    gpl = (
        "    This program is free software: you can redistribute it and/or modify\n    it under the terms of the GNU General Public License as published by\n"
        "    the Free Software Foundation, either version 3 of the License, or\n    (at your option) any later version.\n\n"
    )
    warranty = (
        "    This program is distributed in the hope that it will be useful,\n    but WITHOUT ANY WARRANTY; without even the implied warranty of\n"
        "    MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.  See the\n    GNU General Public License for more details.\n"
    )
    texts = {
        "GPL-3.0-or-later": [gpl + warranty, gpl, (gpl + warranty).replace("software:", "software;").replace("Foundation,", "Foundation;")],
        "Apache-2.0": [
            'Licensed under the Apache License, Version 2.0 (the "License");\nyou may not use this file except in compliance with the License.\n'
            "You may obtain a copy of the License at\n\n    http://www.apache.org/licenses/LICENSE-2.0\n\n"
            'Unless required by applicable law or agreed to in writing, software\ndistributed under the License is distributed on an "AS IS" BASIS,\n'
            "WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.\nSee the License for the specific language.\n"
        ],
        "MIT": [
            "MIT License\n\nCopyright (c) 2024 A\n\nPermission is hereby granted, free of charge, to any person obtaining a copy\n"
            'of this software and associated documentation files (the "Software"), to deal\nin the Software without restriction, including without limitation the rights\n'
            "to use, copy, modify, merge, publish, distribute, sublicense, and/or sell\ncopies of the Software, and to permit persons to whom the Software is\n"
            "furnished to do so, subject to the following conditions:\n\nThe above copyright notice and this permission notice shall be included in all\n"
            "copies or substantial portions of the Software.\n"
        ],
    }
    rows = [(name, text) for name, several in texts.items() for text in several]
    found = licences.recognise(make_docs([(i, t) for i, (_, t) in enumerate(rows)])).collect()
    assert {r["doc_id"]: r["licences"] for r in found} == {i: name for i, (name, _) in enumerate(rows)}
    assert {r["doc_id"]: r["n_sentences"] for r in found} == {0: 4, 1: 2, 2: 5, 3: 3, 4: 3}


def test_normalised_sentences_are_what_they_should_be():
    import re

    for texts in licences.SENTENCES.values():
        for text in texts:
            assert re.sub(r"[\W_]+", " ", text.lower()).strip() == text
    used = {s for _, rule in licences.RULES for s in rule} | {s for ways in licences.FORMS.values() for way in ways for s in way}
    assert used == set(licences.SENTENCES)


_ISC = (
    "Copyright (c) 2021 Some One\n\nPermission to use, copy, modify, and/or distribute this software for any\npurpose with or without fee is hereby granted, "
    'provided that the above\ncopyright notice and this permission notice appear in all copies.\n\nTHE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS '
    "ALL WARRANTIES WITH\nREGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY\nAND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE.\n"
)
_LESSER = (
    "This library is free software; you can redistribute it and/or\nmodify it under the terms of the GNU Lesser General Public\nLicense as published by the "
    "Free Software Foundation; either\nversion 2.1 of the License, or (at your option) any later version.\n\nThis library is distributed in the hope that it "
    "will be useful,\nbut WITHOUT ANY WARRANTY; without even the implied warranty of\nMERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.\n"
)
_AFFERO = (
    "This program is free software: you can redistribute it and/or modify\nit under the terms of the GNU Affero General Public License as\npublished by the "
    "Free Software Foundation, either version 3 of the\nLicense, or (at your option) any later version.\n"
)
_MOZILLA = "This Source Code Form is subject to the terms of the Mozilla Public\nLicense, v. 2.0. If a copy of the MPL was not distributed with this\nfile.\n"
_BSD = (
    "Copyright (c) 2019, Some One\nAll rights reserved.\n\nRedistribution and use in source and binary forms, with or without\nmodification, are permitted "
    "provided that the following conditions are met:\n\n1. Redistributions of source code must retain the above copyright notice, this\nlist of conditions and "
    "the following disclaimer.\n\n2. Redistributions in binary form must reproduce the above copyright notice,\nthis list of conditions and the following "
    "disclaimer in the documentation\nand/or other materials provided with the distribution.\n"
)
_OWN = [("ISC", _ISC), ("LGPL-2.1-or-later", _LESSER), ("AGPL-3.0-or-later", _AFFERO), ("MPL-2.0", _MOZILLA), ("BSD-2-Clause", _BSD)]
_OWN += [("GPL-2.0-or-later", _AFFERO.replace("Affero ", "").replace("version 3", "version 2"))]
_OWN += [(name, f"SPDX-License-Identifier: {name}\n") for name in licences.TAGS]
_OWN += [("All-Rights-Reserved", "All rights reserved.\n"), ("All-Rights-Reserved", "Copyright 2020 Some Body, all rights reserved\n")]


@pytest.mark.parametrize("style", ["plain", "stars", "hashes", "slashes"])
def test_licences_in_comments(make_docs, style):
    """Every notice on its original text, plain and as the head of a source file."""

    def dressed(text):
        lines = text.rstrip("\n").split("\n")
        if style == "stars":
            return "/*\n" + "".join(f" * {x}".rstrip() + "\n" for x in lines) + " */\nint main;\n"
        mark = {"plain": "", "hashes": "# ", "slashes": "// "}[style]
        return "".join((mark + x).rstrip() + "\n" for x in lines) + "\nx = 1\n"

    found = licences.recognise(make_docs([(i, dressed(t)) for i, (_, t) in enumerate(_OWN)])).collect()
    assert {r["doc_id"]: r["licences"] for r in found} == {i: name for i, (name, _) in enumerate(_OWN)}


# ------------------------------------------------------------------------------- chat


def _expected_chats(rows):
    talks = {}
    for conv, turn, role, text in set(rows):
        role, text = "unknown" if role is None else role, text or ""
        import hashlib

        key = (turn is not None, turn or 0, hashlib.sha256(f"{role}\0{text}".encode()).hexdigest())
        talks.setdefault(conv, set()).add((key, role, text))
    talks = {c: [(r, t) for _, r, t in sorted(v)] for c, v in talks.items()}
    inner = {tuple(v[:k]) for v in talks.values() for k in range(1, len(v))}
    same = {}
    for conv, v in talks.items():
        if tuple(v) not in inner:
            same.setdefault(tuple(v), []).append(conv)
    render = lambda v: "".join(f"<|im_start|>{r.replace('<|im_', '<| im_')}\n{t.replace('<|im_', '<| im_')}<|im_end|>\n" for r, t in v)
    least = lambda ids: min((i for i in ids if i is not None), default=None)
    return sorted((str(least(ids)), len(v), len(ids), render(v)) for v, ids in same.items())


@pytest.mark.parametrize("block", [2, 1024])
def test_chats_against_plain_python(spark, monkeypatch, block):
    monkeypatch.setattr(chat, "BLOCK", block)
    talk = [("user", "hi"), ("assistant", "hello"), ("user", "more"), ("assistant", "<|im_end|> trick"), ("user", "bye")]
    rows = [(c, 10 * c + k, *talk[k]) for c, n in enumerate((5, 3, 1, 5, 2)) for k in range(n)]
    rows += [(20, 0, "user", "hi"), (20, 1, "user", "other"), (21, None, None, None), (21, 1, "user", ""), (21, 1, "user", "tie")]
    rows += [(None, 0, "user", "no id"), (20, 0, "user", "hi"), (22, 5, "assistant", "hello")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").selectExpr("*", "1 as _k", "'x' as copies")
    got = sorted((str(r["conv_id"]), r["n_turns"], r["copies"], r["text"]) for r in chat.format_conversations(df).collect())
    assert got == _expected_chats(rows)
    assert chat.format_conversations(df.limit(0)).count() == 0
