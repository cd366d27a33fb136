"""Token ids against the tokenizer itself, and the invariants of packed sequences."""

import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pytest
from hypothesis import given, settings, strategies as st
from tokenizers import Tokenizer

from llm.cases import ODD_TEXTS, SMALL
from orderloom.llm import common, packing
from orderloom.llm.tokens import END_ID, TOKENIZER_FILE, Segments

SEGMENTS = Segments(TOKENIZER_FILE)
FRESH = Tokenizer.from_file(TOKENIZER_FILE)


def _whole(text):
    return FRESH.encode(text or "", add_special_tokens=False).ids


def _encoded(segments, texts):
    found = {}
    for rows, counts, ids in segments.encode(pa.array(texts, pa.string())):
        ends = np.cumsum(counts)
        found |= {int(r): ids[e - n : e].tolist() for r, n, e in zip(rows, counts, ends)}
    return [found[i] for i in range(len(texts))]


def test_segments_give_the_ids_of_whole_texts(documents):
    texts = [r["text"] for r in documents.select("text").collect()] + ODD_TEXTS
    texts += [" lead", "trail ", "a \n b", "a  b", "\n\n", "l'été d'y can't", " . .. ", "tab\tx  y z  w"]
    texts += ["a <|endoftext|> b", "<|endoftext|>", "x<|endoftext|><|endoftext|> y  z", "<|endoftext| >"]
    assert _encoded(SEGMENTS, texts) == [_whole(t) for t in texts]


@settings(max_examples=150, deadline=None)
@given(st.lists(st.lists(st.sampled_from([*" \n\tab'1.,é\u00a0\u3000漢<|>", "<|endoftext|>"]), max_size=12).map("".join), max_size=4))
def test_segments_of_any_text(texts):
    assert _encoded(SEGMENTS, texts) == [_whole(t) for t in texts]


def test_memory_of_segments_is_bounded(monkeypatch):
    monkeypatch.setattr("orderloom.llm.tokens.REMEMBERED", 3)
    small = Segments(TOKENIZER_FILE)
    for texts in (["a b c d e f"], ["b c"], ["x y z b"]):
        assert _encoded(small, texts) == [_whole(t) for t in texts]
    assert len(small.known) <= 3


def test_a_known_word_is_not_encoded_again_beside_other_punctuation_or_a_line_feed(monkeypatch):
    segments = Segments(TOKENIZER_FILE)
    words = [f"{a}{b}word" for a in "bcdfghjklm" for b in "aeiouäéñ"]
    first, *later = ["x " + " ".join([w + end for w in words]) for end in ("", ",", "...", "'", ")")]
    feeds, again = ("x" + "".join([f"{before}\n{w}" for w in words]) for before in (".", ""))
    assert _encoded(segments, [first, feeds]) == [_whole(first), _whole(feeds)]
    given, encode = [], segments._one_by_one
    monkeypatch.setattr(segments, "_one_by_one", lambda texts: given.extend(texts) or encode(texts))
    assert _encoded(segments, [*later, again]) == [_whole(t) for t in [*later, again]]
    assert not [t for t in given if "word" in t]


@settings(max_examples=150, deadline=None)
@given(st.lists(st.lists(st.sampled_from([*" \n", "\n\n", "\r\n", *"\tab'1.,()é漢", "'s", "word", " Word,"]), max_size=10).map("".join), max_size=6))
def test_segments_of_lines_and_punctuation(texts):
    assert _encoded(SEGMENTS, texts) == [_whole(t) for t in texts]
    assert _encoded(Segments.shared(TOKENIZER_FILE), texts) == [_whole(t) for t in texts]


@given(st.dictionaries(st.integers(1, 64), st.integers(1, 500), max_size=40))
@settings(deadline=None)
def test_patterns_use_every_piece_once(histogram):
    used = Counter()
    for pattern, count in packing.pack_patterns(histogram, 64):
        assert sum(pattern) <= 64 and list(pattern) == sorted(pattern, reverse=True)
        for length in pattern:
            used[length] += count
    assert used == Counter(histogram)


def test_patterns_waste_little():
    rng = np.random.default_rng(0)
    histogram = dict(Counter(rng.integers(1, 1024, 50_000).tolist()))
    patterns = packing.pack_patterns(histogram, 1024)
    filled = sum(k * n for k, n in histogram.items()) / sum(1024 * n for _, n in patterns)
    assert filled > 0.99 and len(patterns) < 4 * 1024


def _check(rows, texts, sequence):
    pieces, sequences = defaultdict(list), defaultdict(list)
    for r in rows:
        ids = np.frombuffer(r["ids"], "<u4")
        assert len(ids) == r["length"] <= sequence and r["ids_crc32"] == zlib.crc32(r["ids"])
        pieces[(r["doc_id"], r["doc_tokens"])].append((r["start"], ids))
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    got = Counter()
    for (doc_id, total), own in pieces.items():
        own.sort(key=lambda p: p[0])
        flat, at = [], 0
        for start, ids in own:
            if start == 0 and at:  # another row with the same id and length
                got[(doc_id, tuple(flat))] += 1
                flat, at = [], 0
            flat += ids.tolist()
            at += len(ids)
        got[(doc_id, tuple(flat))] += 1
    assert sum(len(k[1]) * n for k, n in got.items()) == sum(len(_whole(t)) + 1 for _, t in texts)
    assert sorted(sequences) == list(range(len(sequences)))
    for own in sequences.values():
        end = 0
        for offset, length in sorted(own):
            assert offset == end
            end += length
        assert end <= sequence
    return got


def test_pack_documents(documents):
    texts = [(r["doc_id"], r["text"]) for r in documents.collect()]
    got = _check(packing.pack(documents).collect(), texts, 1024)
    assert got == Counter((d, tuple([*_whole(t), END_ID])) for d, t in texts)


def test_pack_query_digest(spark):
    rows = packing.op2_packing(spark, SMALL).collect()
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    assert {r["doc_id"] for r in rows} == set(docs)
    for r in rows:
        ids = np.array([*_whole(docs[r["doc_id"]]), END_ID], "<u4")
        assert r["doc_tokens"] == len(ids)
        assert r["ids_crc32"] == zlib.crc32(ids[r["start"] : r["start"] + r["length"]].tobytes())


@pytest.mark.parametrize("sequence", [8, 1024])
def test_pack_odd_rows(odd_docs, sequence):
    texts = [(r["doc_id"], r["text"]) for r in odd_docs.collect()]
    rows = packing.pack(odd_docs.repartition(3), sequence=sequence).collect()
    assert sum(r["length"] for r in rows) == sum(len(_whole(t)) + 1 for _, t in texts)
    sequences = defaultdict(list)
    for r in rows:
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    assert sorted(sequences) == list(range(len(sequences)))
    for own in sequences.values():
        own.sort()
        assert [o for o, _ in own] == np.cumsum([0, *[n for _, n in own]])[:-1].tolist()


def test_pack_nothing(odd_docs):
    assert packing.pack(odd_docs.limit(0)).count() == 0


def test_the_parts_of_a_batch_give_arrow_memory_back(monkeypatch):
    released = []

    class Pool:
        def release_unused(self):
            released.append(1)

    monkeypatch.setattr(pa, "default_memory_pool", Pool)
    batch = pa.record_batch({"text": ["a" * 10, None, "b" * 10]})
    assert sum(p.num_rows for p in common.slices(batch, pc.binary_length(batch["text"]), 10)) == 3
    assert released == [1]
