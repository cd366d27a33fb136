"""Licence recognition by sentences and ordered rules.

Comment marks at the begin of lines are taken off. A text is cut into sentences, and sentences
that go over several lines also into their lines. Each is normalised (lower case, runs of other characters than letters and digits as
one space) and looked up among known licence sentences. The identifiers found form a
sequence in the order of the text; rules are tried in their order, and a rule that matches
takes its sentences, so that a rule for more sentences goes before one for fewer.

Only row-by-row DataFrame expressions: no shuffle, no group, nothing to skew.
"""

from __future__ import annotations

import re
from itertools import product

from pyspark.sql import Column, DataFrame, functions as F

from .common import prepare, read_table, stored, text_of

# Sentences of public licence texts and notices, normalised, as their own punctuation cuts them.
SENTENCES = {
    "mit-title": ["mit license", "the mit license", "the mit license mit"],
    "mit-notice": ["released under the mit license", "licensed under the mit license", "this project is licensed under the mit license"],
    "mit-grant": [
        "permission is hereby granted free of charge to any person obtaining a copy of this software and associated "
        "documentation files the software to deal in the software without restriction including without limitation the "
        "rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit "
        "persons to whom the software is furnished to do so subject to the following conditions"
    ],
    "mit-condition": [
        "the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software"
    ],
    "mit-warranty": [
        "the software is provided as is without warranty of any kind express or implied including but not limited to the "
        "warranties of merchantability fitness for a particular purpose and noninfringement"
    ],
    "isc-grant": [
        "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted "
        "provided that the above copyright notice and this permission notice appear in all copies",
        "permission to use copy modify and distribute this software for any purpose with or without fee is hereby granted "
        "provided that the above copyright notice and this permission notice appear in all copies",
    ],
    "isc-warranty": [
        "the software is provided as is and the author disclaims all warranties with regard to this software including all "
        "implied warranties of merchantability and fitness"
    ],
    "apache2-notice": ["licensed under the apache license version 2 0", "licensed under the apache license version 2 0 the license"],
    "apache2-compliance": ["you may not use this file except in compliance with the license"],
    "apache2-warranty": [
        "unless required by applicable law or agreed to in writing software distributed under the license is distributed on "
        "an as is basis without warranties or conditions of any kind either express or implied"
    ],
    "gpl3-notice": [
        "this work is licensed under the gnu general public license version 3",
        "licensed under the gnu general public license version 3",
    ],
    "gpl-free": [
        "this program is free software you can redistribute it and or modify it under the terms of the gnu general public "
        "license as published by the free software foundation either version 3 of the license or at your option any later version"
    ],
    "gpl-warranty": [
        "this program is distributed in the hope that it will be useful but without any warranty without even the implied "
        "warranty of merchantability or fitness for a particular purpose"
    ],
    "free-program": ["this program is free software"],
    "free-library": ["this library is free software"],
    "gpl-terms3": [
        "you can redistribute it and or modify it under the terms of the gnu general public license as published by the free "
        "software foundation either version 3 of the license or at your option any later version"
    ],
    "gpl-terms2": [
        "you can redistribute it and or modify it under the terms of the gnu general public license as published by the free "
        "software foundation either version 2 of the license or at your option any later version"
    ],
    "gpl-terms": [
        "you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation"
    ],
    "lgpl-terms3": [
        "you can redistribute it and or modify it under the terms of the gnu lesser general public license as published by the "
        "free software foundation either version 3 of the license or at your option any later version"
    ],
    "lgpl-terms": [
        "you can redistribute it and or modify it under the terms of the gnu lesser general public license as published by the "
        "free software foundation"
    ],
    "agpl-terms3": [
        "you can redistribute it and or modify it under the terms of the gnu affero general public license as published by the "
        "free software foundation either version 3 of the license or at your option any later version"
    ],
    "either-2": ["either version 2 of the license or at your option any later version"],
    "either-2.1": ["either version 2 1 of the license or at your option any later version"],
    "either-3": ["either version 3 of the license or at your option any later version"],
    "hope-program": ["this program is distributed in the hope that it will be useful but without any warranty"],
    "hope-library": ["this library is distributed in the hope that it will be useful but without any warranty"],
    "hope-implied": ["without even the implied warranty of merchantability or fitness for a particular purpose"],
    "mpl2-notice": [
        "this source code form is subject to the terms of the mozilla public license v",
        "this source code form is subject to the terms of the mozilla public license v 2 0",
        "this source code form is subject to the terms of the mozilla public license version 2 0",
    ],
    "bsd-intro": [
        "redistribution and use in source and binary forms with or without modification are permitted provided that the "
        "following conditions are met"
    ],
    "bsd-source": [
        "redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer"
    ],
    "bsd-binary": [
        "redistributions in binary form must reproduce the above copyright notice this list of conditions and the following "
        "disclaimer in the documentation and or other materials provided with the distribution"
    ],
    "bsd-names": [
        "neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products "
        "derived from this software without specific prior written permission"
    ],
    "unlicense-grant": ["this is free and unencumbered software released into the public domain"],
    "cc0-notice": ["licensed under cc0 1 0", "this work is licensed under cc0 1 0"],
    "cc-by-nc4-notice": ["licensed under cc by nc 4 0", "this work is licensed under cc by nc 4 0"],
    "cc-by4-notice": ["licensed under cc by 4 0", "this work is licensed under cc by 4 0"],
    "cc-by-sa4-notice": ["licensed under cc by sa 4 0", "this work is licensed under cc by sa 4 0"],
    "reserved": ["all rights reserved"],
}
# Identifiers of the public list of short licence names that a tag may hold.
TAGS = [
    "MIT", "ISC", "Apache-2.0", "BSD-2-Clause", "BSD-3-Clause", "GPL-2.0-only", "GPL-2.0-or-later", "GPL-3.0-only",
    "GPL-3.0-or-later", "LGPL-2.1-only", "LGPL-2.1-or-later", "LGPL-3.0-only", "LGPL-3.0-or-later", "AGPL-3.0-only",
    "AGPL-3.0-or-later", "MPL-2.0", "Unlicense", "CC0-1.0", "CC-BY-4.0", "CC-BY-SA-4.0", "CC-BY-NC-4.0",
]


def _tag_text(name: str) -> str:
    return "spdx license identifier " + " ".join(re.findall(r"[a-z0-9]+", name.lower()))


SENTENCES |= {f"tag-{name.lower()}": [_tag_text(name)] for name in TAGS}
# A copyright line with years and a holder that reserves all rights: its words are not fixed, but its form is.
_RESERVED = r"^(copyright |c )+([0-9]{4} )+.* all rights reserved$"
# Other sequences that stand for one of the sentences above.
FORMS = {
    "gpl-free": [["free-program", "gpl-terms3"], ["free-program", "gpl-terms", "either-3"]],
    "gpl-warranty": [["hope-program", "hope-implied"]],
}
# Ordered: the first rule that matches takes its sentences.
RULES = [
    ("Apache-2.0", ["apache2-notice", "apache2-compliance", "apache2-warranty"]),
    ("GPL-3.0-or-later", ["gpl-free", "gpl-warranty"]),
    ("GPL-2.0-or-later", ["free-program", "gpl-terms", "either-2", "hope-program", "hope-implied"]),
    ("GPL-2.0-or-later", ["free-program", "gpl-terms2", "hope-program", "hope-implied"]),
    ("AGPL-3.0-or-later", ["free-program", "agpl-terms3", "hope-program", "hope-implied"]),
    ("LGPL-2.1-or-later", ["free-library", "lgpl-terms", "either-2.1", "hope-library", "hope-implied"]),
    ("LGPL-3.0-or-later", ["free-library", "lgpl-terms3", "hope-library", "hope-implied"]),
    ("BSD-3-Clause", ["reserved", "bsd-intro", "bsd-source", "bsd-binary", "bsd-names"]),
    ("BSD-3-Clause", ["bsd-intro", "bsd-source", "bsd-binary", "bsd-names"]),
    ("BSD-2-Clause", ["reserved", "bsd-intro", "bsd-source", "bsd-binary"]),
    ("BSD-2-Clause", ["bsd-intro", "bsd-source", "bsd-binary"]),
    ("MIT", ["mit-grant", "mit-condition", "mit-warranty"]),
    ("MIT", ["mit-grant", "mit-condition"]),
    ("ISC", ["isc-grant", "isc-warranty"]),
    ("ISC", ["isc-grant"]),
    ("MPL-2.0", ["mpl2-notice"]),
    ("Apache-2.0", ["apache2-notice"]),
    ("GPL-3.0-only", ["gpl3-notice"]),
    ("GPL-3.0-or-later", ["gpl-free"]),
    ("GPL-2.0-or-later", ["free-program", "gpl-terms", "either-2"]),
    ("GPL-2.0-or-later", ["free-program", "gpl-terms2"]),
    ("AGPL-3.0-or-later", ["free-program", "agpl-terms3"]),
    ("LGPL-2.1-or-later", ["free-library", "lgpl-terms", "either-2.1"]),
    ("LGPL-3.0-or-later", ["free-library", "lgpl-terms3"]),
    ("MIT", ["mit-notice"]),
    ("MIT", ["mit-grant"]),
    ("MIT", ["mit-title"]),
    ("Unlicense", ["unlicense-grant"]),
    ("CC0-1.0", ["cc0-notice"]),
    ("CC-BY-NC-4.0", ["cc-by-nc4-notice"]),
    ("CC-BY-SA-4.0", ["cc-by-sa4-notice"]),
    ("CC-BY-4.0", ["cc-by4-notice"]),
    *[(name, [f"tag-{name.lower()}"]) for name in TAGS],
    ("All-Rights-Reserved", ["reserved"]),
]

_SENTENCE_END = r"[.!?:;]+[ \t\r\n\f]+|\n[ \t\r]*\n"
_TAG = "SPDX-License-Identifier"
_OTHER = r"[^\p{L}\p{N}]+"
# Marks of comments at the begin of a line, and their ends: C, shell, SQL, Lisp, TeX, HTML and others.
_COMMENT = r"(?m)^[ \t]*(?:/\*+|\*+/?|//+|#+|--+|;+|%+|<!--|dnl\b|rem\b)[ \t]*|[ \t]*(?:\*/|-->)[ \t\r]*$"


def rule_pattern(sentences: list[str]) -> str:
    """The rule's sentences one after another, between single spaces."""
    return " " + " ".join(sentences) + " "


def all_rules() -> list[tuple[str, list[str]]]:
    """The rules in their order, each followed by itself with the other forms of its sentences."""
    ways = lambda s: [[s], *FORMS.get(s, [])]
    return [(name, sum(way, [])) for name, sentences in RULES for way in product(*map(ways, sentences))]


def _known() -> Column:
    entries = [(text, name) for name, texts in SENTENCES.items() for text in texts]
    return F.create_map(*[F.lit(x) for entry in entries for x in entry])


def _normalised(part: Column) -> Column:
    return F.trim(F.regexp_replace(F.lower(part), _OTHER, " "))


def recognise(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: ``doc_id, n_sentences, sentence_ids, licences``.

    ``sentence_ids`` is the sequence found, ``licences`` the names by rule, both joined by
    a space, in the order of the text and of the rules. Null and empty texts and texts
    without a known sentence give 0 and empty strings. Repeated rows each get a row; an
    empty table gives an empty result; other columns are ignored.
    """
    prepare(docs.sparkSession)
    # The colon of a tag is no end of a sentence.
    text = F.replace(text_of(text_col), F.lit(f"{_TAG}:"), F.lit(_TAG))
    sentences = F.split(F.regexp_replace(text, _COMMENT, ""), _SENTENCE_END)
    lines = lambda s: F.when(F.contains(s, F.lit("\n")), F.concat(F.array(s), F.split(s, "\n"))).otherwise(F.array(s))
    parts, known = F.flatten(F.transform(sentences, lines)), _known()

    def named(part: Column) -> Column:
        """The identifier of a sentence or line; a copyright line may reserve the rights itself."""
        line = F.contains(F.lower(part), F.lit("reserved")) & ~F.contains(part, F.lit("\n"))
        return F.coalesce(
            F.try_element_at(known, _normalised(part)), F.when(line & _normalised(part).rlike(_RESERVED), "reserved")
        )

    found = F.filter(F.transform(parts, named), lambda name: name.isNotNull())
    rows = docs.select(F.col(id_col).alias("doc_id"), F.array_join(found, " ").alias("sentence_ids"))
    # Every sentence between two single spaces, so that neighbours do not share one.
    sequence = F.concat(F.lit(" "), F.regexp_replace("sentence_ids", " ", "  "), F.lit(" "))
    rules = F.array(
        *[F.struct(F.lit(name).alias("name"), F.lit(rule_pattern(s).replace(" ", "  ")[1:-1]).alias("text")) for name, s in all_rules()]
    )
    start = F.struct(sequence.alias("left"), F.array().cast("array<string>").alias("names"))

    def tried(state: Column, rule: Column) -> Column:
        hit = F.contains(state["left"], rule["text"])
        left = F.when(hit, F.replace(state["left"], rule["text"], F.lit(" "))).otherwise(state["left"])
        names = F.when(hit, F.concat(state["names"], F.array(rule["name"]))).otherwise(state["names"])
        return F.struct(left.alias("left"), names.alias("names"))

    names = F.array_join(F.array_distinct(F.aggregate(rules, start, tried)["names"]), " ")
    return rows.select(
        "doc_id",
        F.when(F.col("sentence_ids") == "", 0).otherwise(F.size(F.split("sentence_ids", " "))).cast("long").alias("n_sentences"),
        "sentence_ids",
        F.when(F.col("sentence_ids") == "", "").otherwise(names).alias("licences"),
    )


def op5_license_scans(spark, sf_dir: str) -> DataFrame:
    return recognise(read_table(spark, sf_dir, "documents"))


def _sql() -> str:
    known = ", ".join(f"('{text}', '{name}')" for name, texts in SENTENCES.items() for text in texts)
    steps, before = [], "step0"
    for k, (name, sentences) in enumerate(all_rules(), 1):
        text = rule_pattern(sentences).replace(" ", "  ")[1:-1]
        steps.append(
            f"step{k} as (select doc_id, ids, case when contains(rest, '{text}') then replace(rest, '{text}', ' ') else rest end as rest, "
            f"case when contains(rest, '{text}') and not list_contains(names, '{name}') then list_append(names, '{name}') else names end as names "
            f"from {before})"
        )
        before = f"step{k}"
    return rf"""
        with known(sentence, name) as (values {known}),
        cut as (
            select doc_id, unnest(regexp_split_to_array(coalesce(text, ''), '[.!?:;]+[ \t\r\n\f]+|\n[ \t\r]*\n')) as s,
                   generate_subscripts(regexp_split_to_array(coalesce(text, ''), '[.!?:;]+[ \t\r\n\f]+|\n[ \t\r]*\n'), 1) as i
            from documents
        ), parts as (
            select doc_id, i, 0 as j, s from cut
            union all
            select doc_id, i, generate_subscripts(string_split(s, chr(10)), 1), unnest(string_split(s, chr(10)))
            from cut where contains(s, chr(10))
        ), plain as (
            select doc_id, i, j, contains(s, chr(10)) as several, trim(regexp_replace(lower(s), '[^\p{{L}}\p{{N}}]+', ' ', 'g')) as s
            from parts
        ), found as (
            select doc_id, i, j, name from plain join known on s = sentence
            union all
            select doc_id, i, j, 'reserved' from plain where not several and regexp_matches(s, '{_RESERVED}')
        ), listed as (
            select d.doc_id, coalesce(string_agg(name, ' ' order by i, j), '') as ids
            from documents d left join found using (doc_id) group by d.doc_id
        ), step0 as (
            select doc_id, ids, ' ' || replace(ids, ' ', '  ') || ' ' as rest, []::varchar[] as names from listed
        ), {", ".join(steps)}
        select doc_id, case when ids = '' then 0 else len(string_split(ids, ' ')) end as n_sentences, ids as sentence_ids,
               array_to_string(names, ' ') as licences
        from {before}"""


SQL = {"op5_license_scans": _sql()}
