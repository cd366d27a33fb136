"""The registered queries of the subpackage and their check statements."""

from __future__ import annotations

from . import (
    chat,
    collocations,
    decontamination,
    exact_dedup,
    html_text,
    language_id,
    lexical_search,
    licences,
    line_dedup,
    ngram_join,
    packing,
    sentence_pieces,
    toxicity,
)

MODULES = [decontamination, packing, html_text, ngram_join, licences, language_id, line_dedup, exact_dedup, toxicity, chat]
MODULES += [collocations, lexical_search, sentence_pieces]


def queries() -> dict:
    found = {}
    for module in MODULES:
        found |= {name: f for name, f in vars(module).items() if name.startswith("op") and name[2].isdigit()}
    return found


def oracle_sql() -> dict[str, str]:
    return {name: text for module in MODULES for name, text in getattr(module, "SQL", {}).items()}
