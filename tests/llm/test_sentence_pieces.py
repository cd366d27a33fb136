"""SentencePiece encoding against the library itself: ids, spans, decoded texts, character maps."""

import hashlib

import numpy as np
import pytest
import sentencepiece
from hypothesis import given, settings, strategies as st
from sentencepiece import sentencepiece_model_pb2

from llm.cases import ODD_TEXTS, SMALL
from orderloom.llm import sentence_pieces
from orderloom.llm.sentence_pieces import MARK, MODEL_FILE, PieceModel

with open(MODEL_FILE, "rb") as file:
    DATA = file.read()

ALPHABET = ["a", "b", " ", "  ", MARK, "é", "é", "😀", "　", "\n", "\t", "the", "ing", "\x00", "‍", "<s>", "<0x41>"]
ALPHABET += ["�", "ﬁ", "①", "Å", "ｶﾞ", "1", ".", "x" * 40]


def _with_normaliser(rule: str, **changes) -> bytes:
    model = sentencepiece_model_pb2.ModelProto.FromString(DATA)
    other = sentencepiece.SentencePieceNormalizer(rule_name=rule).serialized_model_proto()
    spec = sentencepiece_model_pb2.ModelProto.FromString(other).normalizer_spec
    model.normalizer_spec.precompiled_charsmap = spec.precompiled_charsmap
    for name, value in changes.items():
        setattr(model.normalizer_spec, name, value)
    return model.SerializeToString()


MODELS = {
    "as given": DATA,
    "nfkc": _with_normaliser("nmt_nfkc"),
    "folded and trimmed": _with_normaliser("nmt_nfkc_cf", remove_extra_whitespaces=True),
    "no prefix": _with_normaliser("nfkc", add_dummy_prefix=False),
}


def _compare(data: bytes, texts: list[str]) -> None:
    model, library = PieceModel.shared(data), sentencepiece.SentencePieceProcessor(model_proto=data)
    counts, *flat = model.encode(texts)
    bounds = np.concatenate([[0], np.cumsum(counts)]).astype(np.int64)
    decoded = model.decode(flat[0], bounds)
    for i, text in enumerate(texts):
        ids, begins, ends = (f[bounds[i] : bounds[i + 1]].tolist() for f in flat)
        wanted = library.encode(text, return_type="proto").pieces
        assert ids == [p.id for p in wanted], text
        assert (begins, ends) == ([p.begin for p in wanted], [p.end for p in wanted]), text
        assert decoded[i].decode() == library.decode(ids), text


@pytest.mark.parametrize("name", MODELS)
def test_ids_spans_and_texts_are_the_librarys(name):
    _compare(MODELS[name], [t or "" for t in ODD_TEXTS] + ["".join(ALPHABET), " lead", "trail ", "   ", MARK, " " + MARK])


@settings(max_examples=150, deadline=None)
@given(st.lists(st.lists(st.sampled_from(ALPHABET), max_size=30).map("".join), min_size=1, max_size=5), st.sampled_from(list(MODELS)))
def test_any_mixture(texts, name):
    _compare(MODELS[name], texts)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.one_of(st.sampled_from([0, 1, 2, 3, 259, 260]), st.integers(0, 31999), st.integers(131, 258)), max_size=12))
def test_any_ids_decode_as_the_library_decodes_them(ids):
    library = sentencepiece.SentencePieceProcessor(model_file=MODEL_FILE)
    bounds = np.array([0, 0, len(ids), len(ids)])
    assert [t.decode() for t in PieceModel.shared(DATA).decode(np.array(ids, np.int32), bounds)] == ["", library.decode(ids), ""]


def test_long_texts_and_forgotten_segments(monkeypatch):
    monkeypatch.setattr(sentence_pieces, "REMEMBERED", 5)
    model = PieceModel(DATA)
    library = sentencepiece.SentencePieceProcessor(model_file=MODEL_FILE)
    texts = ["word " * 100_000, "x" * 20_000, "äöü€" * 5_000]
    for _ in range(2):
        counts, ids, *_ = model.encode(texts)
        assert ids.tolist() == [i for t in texts for i in library.encode(t)]


def test_whole_table(spark, documents):
    library = sentencepiece.SentencePieceProcessor(model_file=MODEL_FILE)
    found = {r["doc_id"]: r for r in sentence_pieces.op13_sentence_pieces(spark, SMALL).collect()}
    rows = documents.select("doc_id", "text").collect()
    assert len(found) == len(rows)
    for r in rows:
        text = r["text"] or ""
        ids = library.encode(text)
        own = found[r["doc_id"]]
        assert own["n_tokens"] == len(ids) and own["covered_bytes"] == len(text.encode())
        assert own["ids_sha256"] == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert own["decoded_sha256"] == hashlib.sha256(library.decode(ids).encode()).hexdigest()


def test_odd_rows(spark, odd_docs):
    """Nulls, repeated rows, clashing columns, an empty table, null lists."""
    encoded = sentence_pieces.encode(odd_docs)
    assert encoded.count() == odd_docs.count()
    back = sentence_pieces.decode(encoded).select("doc_id", "text").collect()
    spaced = [(r["doc_id"], (r["text"] or "").replace(MARK, " ")) for r in odd_docs.collect()]
    assert sorted(map(str, spaced)) == sorted(str((r["doc_id"], r["text"])) for r in back)
    assert sentence_pieces.encode(odd_docs.limit(0)).collect() == []
    lists = spark.createDataFrame([(1, None), (2, []), (3, [259])], "score long, ids array<int>")
    assert [(r["score"], r["text"]) for r in sentence_pieces.decode(lists).collect()] == [(1, None), (2, ""), (3, " ")]


def test_the_query_keeps_texts_without_pieces(spark, odd_docs, tmp_path):
    """A null or empty text has a row with no tokens and no bytes."""
    odd_docs.select("doc_id", "text").write.parquet(str(tmp_path / "documents.parquet"))
    library = sentencepiece.SentencePieceProcessor(model_file=MODEL_FILE)
    found = sentence_pieces.op13_sentence_pieces(spark, str(tmp_path)).collect()

    def row(doc_id, text):
        ids = library.encode(text)
        shas = (hashlib.sha256(t.encode()).hexdigest() for t in (",".join(map(str, ids)), library.decode(ids)))
        return (doc_id, len(ids), *shas, len(text.encode()))

    wanted = [row(r["doc_id"], r["text"] or "") for r in odd_docs.collect()]
    assert sorted(map(str, wanted)) == sorted(str(tuple(r)) for r in found)


def test_unknown_kinds_of_models_are_refused():
    model = sentencepiece_model_pb2.ModelProto.FromString(DATA)
    model.trainer_spec.model_type = 1
    with pytest.raises(ValueError):
        PieceModel(model.SerializeToString())
