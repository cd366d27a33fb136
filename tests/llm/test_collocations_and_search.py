"""Collocations and ranked search against plain Python over the same rows."""

import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from llm.cases import SMALL
from orderloom.llm import collocations, common, lexical_search
from orderloom.llm.common import read_table

#: A map that holds back nothing.
FULL = common.BitMap(np.full(1 << (common.MAP_BITS - 3), 255, np.uint8))

# ------------------------------------------------------------------------ collocations


def _lower(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")


def _plain_collocations(rows, min_count, top):
    count, total = defaultdict(Counter), Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\x0a-\x0d]", _lower(text)):
            words = re.findall("[^ \t]+", piece)
            total[lang] += len(words)
            for n in range(1, 6):
                count[lang].update(tuple(words[i : i + n]) for i in range(len(words) - n + 1))
    found = []
    for lang, f in count.items():
        candidates = {g: a for g, a in f.items() if len(g) > 1 and a >= min_count}
        held = Counter()
        for gram, a in candidates.items():
            for n in range(2, len(gram)):
                for i in range(len(gram) - n + 1):
                    held[gram[i : i + n]] = max(held[gram[i : i + n]], a)
        rows_of_lang = []
        for gram, a in candidates.items():
            if 100 * held[gram] >= 100 * a:
                continue
            cuts = [(1000 * a * total[lang] // (f[gram[:k]] * f[gram[k:]]), k) for k in range(1, len(gram))]
            score, k = min(cuts)
            rows_of_lang.append((-score, -a, " ".join(gram).encode(), f[gram[:k]], f[gram[k:]]))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(rows_of_lang)[:top], 1):
            found.append((lang, rank, phrase.decode(), -a, left, right, total[lang], -score))
    return sorted(found)


def _found(df):
    return sorted(tuple(r) for r in df.select("lang", "rank", "phrase", "a", "l", "r", "n", "score").collect())


@pytest.fixture(scope="module")
def phrases(spark):
    """Texts of few words, so that phrases and windows repeat, with copies and odd rows."""
    rng = random.Random(3)
    words = ["The", "the", "of", "É", "é", "a b", "x", "yz", "漢字", "'", "-", "Of"]
    rows = []
    for i in range(300):
        text = "".join(rng.choice(words) + rng.choice([" ", " ", " ", " ", "\t", "  ", ", ", ".", "\n", "\x0b"]) for _ in range(rng.randint(0, 90)))
        rows += [(text, rng.choice(["en", "de", None]))] * rng.choice([1, 1, 3])
    rows += [(None, "en"), ("", "fr"), ("...,,\n", "en"), ("z " * 3000, "fr"), ("a b c d e f g " * 400, None)]
    return rows


@pytest.mark.parametrize("trigger", [1, 3, 32])
def test_collocations(spark, phrases, trigger):
    docs = spark.createDataFrame(phrases, "text string, lang string").repartition(3)
    assert _found(collocations.collocations(docs, min_count=5, top=60, trigger=trigger)) == _plain_collocations(phrases, 5, 60)


def test_small_blocks_and_a_full_map_change_nothing(spark, phrases, monkeypatch):
    wanted = _plain_collocations(phrases, 4, 1000)
    docs = spark.createDataFrame(phrases, "text string, lang string")
    monkeypatch.setattr(collocations, "bit_map", lambda hashes: FULL)
    assert _found(collocations.collocations(docs, min_count=4, top=1000, trigger=4)) == wanted


def test_equal_hashes_are_counted_by_words(monkeypatch):
    monkeypatch.setattr(collocations, "_mixed", lambda h: h & np.uint64(1))
    rows = pa.record_batch(
        [["en", "en", "de"], ["a b a b c", "b a", "a b"], [False] * 3, [2, 5, 7]], ["lang", "chunk", "goes_on", "times"]
    )
    block = collocations.Block(next(collocations._pack(iter([rows]))), 0)
    found = collocations._count_phrases(block, 2, FULL).to_pylist()
    assert {(r["lang"], r["phrase"]): r["times"] for r in found} == {
        ("en", "a b"): 4, ("en", "b a"): 7, ("en", "b c"): 2, ("de", "a b"): 7,
    }
    assert sum(r["times"] for r in collocations._count_hashes(block, 2, FULL).to_pylist()) == 20


def test_names_of_languages_as_words_have_hashes_of_their_own(monkeypatch):
    names = ["en", "es", "de", "fr"]
    rows = pa.record_batch([names, [" ".join(names)] * 4, [False] * 4, [2, 3, 5, 7]], ["lang", "chunk", "goes_on", "times"])
    block = collocations.Block(next(collocations._pack(iter([rows]))), 0)
    assert len(np.unique(block.grams(1))) == 16
    sorts, unique = [], np.unique
    monkeypatch.setattr(np, "unique", lambda *a, **b: sorts.append(b) or unique(*a, **b))
    found = collocations._count_phrases(block, 1, FULL).to_pylist()
    assert {(r["lang"], r["phrase"]): r["times"] for r in found} == {(a, b): n for a, n in zip(names, (2, 3, 5, 7)) for b in names}
    assert sorts == [{"return_inverse": True}]  # neither a sort for first places nor one by words


def test_scores_pass_64_bits(spark):
    big = 10**13
    rows = [("en", "a", big), ("en", "b", big + 7), ("en", "a b", big - 1)]
    phrases = spark.createDataFrame(rows, "lang string, phrase string, f long")
    totals = spark.createDataFrame([("en", 10**15)], "lang string, n long")
    row = collocations._scored(phrases, totals).first()
    assert row["score"] == 1000 * (big - 1) * 10**15 // (big * (big + 7))


def test_bit_map_holds_exactly_the_hashes(spark):
    hashes = [0, 1, -1, 12345678901, -(2**63), 2**63 - 1, 1 << 26]
    bits = common.bit_map(spark.createDataFrame([(h,) for h in hashes], "hash long"))
    assert bits.holds(np.array(hashes, np.int64).view(np.uint64)).all()
    assert int(np.unpackbits(bits.bits).sum()) == len({h & ((1 << common.MAP_BITS) - 1) for h in hashes})


def test_collocations_of_odd_tables(spark, odd_docs):
    assert collocations.collocations(odd_docs.limit(0)).collect() == []
    rows = [(r["text"], r["lang"]) for r in odd_docs.collect()]
    assert _found(collocations.collocations(odd_docs, min_count=1, top=50)) == _plain_collocations(rows, 1, 50)


# ---------------------------------------------------------------------- ranked search


def _terms(text):
    return re.findall("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+", _lower(text))


def _plain_search(docs, items, k):
    texts = [(i, Counter(_terms(t))) for i, t in docs]
    n_docs, total = sum(bool(c) for _, c in texts), sum(sum(c.values()) for _, c in texts)
    df = Counter(t for _, c in texts for t in c)
    wanted = defaultdict(set)
    for item, text in items:
        wanted[item] |= set(_terms(text))
    found = []
    for item, terms in wanted.items():
        scored = []
        for doc, c in texts:
            m = 50 + (50 * sum(c.values()) * n_docs) // max(total, 1)
            score = sum(
                math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((10**9 * c[t]) // (1000 * c[t] + 20 * m))
                for t in terms
                if c[t]
            )
            if score > 0:
                scored.append((-score, doc is None, doc or 0))
        for rank, (score, none, doc) in enumerate(sorted(scored)[:k], 1):
            found.append((item, rank, None if none else doc, -score))
    return sorted(found, key=str)


def _ranked(df):
    return sorted((tuple(r) for r in df.select("item_id", "rank", "doc_id", "score").collect()), key=str)


@pytest.mark.parametrize("shard", [1, 7, 16_384])
def test_search(spark, make_docs, monkeypatch, shard):
    monkeypatch.setattr(lexical_search, "SHARD_ROWS", shard)
    monkeypatch.setattr(lexical_search, "FIRST_READ", 2)
    rng = random.Random(5)
    words = [f"w{i}" for i in range(40)] + ["É", "é", "漢字", "A", "a", "a_b"]
    texts = [" ".join(rng.choices(words, weights=range(1, len(words) + 1), k=rng.randint(0, 60))) for _ in range(250)]
    rows = [(rng.randrange(200), t) for t in texts] + [(900, texts[7]), (901, texts[7]), (None, texts[7]), (None, None), (5, "")]
    items = [(i, " ".join(rng.choices(words, k=rng.randint(0, 12)))) for i in range(12)]
    items += [(3, "w1 É"), (None, "w2 w3"), (50, None), (51, "unknown"), (52, "!!")]
    df = spark.createDataFrame(items, "item_id long, text string")
    found = lexical_search.search(make_docs(rows).repartition(3), df, k=10)
    assert _ranked(found) == _plain_search(rows, items, 10)


def test_items_in_several_blocks(spark, documents, monkeypatch):
    monkeypatch.setattr(lexical_search, "ITEM_BLOCK", 2000)
    items = read_table(spark, SMALL, "benchmark")
    rows = [(r["doc_id"], r["text"]) for r in documents.collect()]
    wanted = _plain_search(rows, [(r["item_id"], r["text"]) for r in items.collect()], 50)
    assert _ranked(lexical_search.search(documents, items)) == wanted


class Counted(np.ndarray):
    """Rows of a list that note how far they were read."""

    end = 0

    def __getitem__(self, at):
        if isinstance(at, slice):
            Counted.end = max(Counted.end, int(at.stop))
        return np.asarray(self)[at]


def test_search_stops_early_and_strictly_below(spark):
    """Long lists: few rows are read, yet all ties with the last rank are seen."""
    n = 5000
    terms = np.zeros(n, np.int32)
    times = np.where(np.arange(n) % 50 == 3, 9, 1).astype(np.int32)
    offsets = pa.array(np.arange(n + 1, dtype=np.int32))
    table = pa.table(
        {
            "doc_id": np.arange(n)[::-1].copy(),
            "n_terms": np.full(n, 10),
            "terms": pa.ListArray.from_arrays(offsets, pa.array(terms)),
            "times": pa.ListArray.from_arrays(offsets, pa.array(times)),
        }
    )
    shard = lexical_search.Shard(table, n, 10 * n, 1)
    shard.row = shard.row.view(Counted)
    rows, scores = shard.search(np.array([0]), np.array([5]), 20, 1)
    assert 100 <= Counted.end < 1000
    best = sorted(i for i, t in zip(table["doc_id"].to_pylist(), times) if t == 9)[:20]
    assert shard.ids.take(pa.array(rows)).to_pylist() == best and len(set(scores.tolist())) == 1


def test_search_of_empty_tables(spark, documents):
    items = read_table(spark, SMALL, "benchmark")
    assert lexical_search.search(documents.limit(0), items).collect() == []
    assert lexical_search.search(documents, items.limit(0)).collect() == []
