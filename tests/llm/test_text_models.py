"""Language ID and toxicity: held-out accuracy, defined results for odd rows, and the network's gradients."""

import zlib

import numpy as np
import pytest

from llm.cases import ODD_TEXTS
from orderloom.llm import gated_network, language_id, toxicity

MEDIUM = "/root/testdata/sf0.01"


def test_language_of_held_out_documents(spark):
    truth = {r["doc_id"]: r["lang"] for r in spark.read.parquet(f"{MEDIUM}/documents.parquet").collect()}
    rows = language_id.op6_language_id(spark, MEDIUM).collect()
    assert sorted(r["doc_id"] for r in rows) == sorted(truth)
    for r in rows:
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2)
        assert 0 <= r["score"] <= 1
    held_out = [r for r in rows if r["held_out"]]
    right = sum(r["lang_pred"] == truth[r["doc_id"]] for r in held_out)
    assert right >= 0.98 * len(held_out)


def _labelled(spark, texts):
    return spark.createDataFrame(texts, "text string, lang string")


def test_language_of_odd_rows(spark, documents, odd_docs):
    model = language_id.train(documents)
    found = language_id.predict(odd_docs, model)
    assert found.columns == ["lang_pred", "score", "ambiguous", "outside", *[c for c in odd_docs.columns if c != "score"]]
    for r in found.collect():
        letters = any(ch.isalpha() for ch in r["text"] or "")
        assert (r["lang_pred"] == "und") == (not letters)
        assert letters or (r["score"] == 0 and not r["ambiguous"])
    kept = language_id.accepted(odd_docs, model)
    assert kept.columns == odd_docs.columns
    assert kept.count() == sum(any(ch.isalpha() for ch in r["text"] or "") and len(r["text"]) < 24 for r in odd_docs.collect())
    assert language_id.predict(odd_docs.limit(0), model).count() == 0


def test_debris_is_outside_and_documents_are_not(spark, documents, make_docs):
    model = language_id.train(documents)
    rng = np.random.default_rng(1)
    debris = [bytes(rng.integers(0, 256, 150, np.uint8)).hex() for _ in range(5)]
    debris += ["".join(rng.choice(list("ABCDEFGHabcdefgh0123456789+/"), 200)) for _ in range(5)]
    assert language_id.accepted(make_docs(list(enumerate(debris))), model).isEmpty()
    letters = documents.filter(r"text rlike '\\p{L}'")
    assert language_id.accepted(documents, model).count() == letters.count()


def test_signs_that_count_as_numbers_are_no_letters(make_docs, documents):
    found = language_id.predict(make_docs(list(enumerate(["½", "²", "①", "_", "5", "ª", "漢", "Ж"]))), language_id.train(documents))
    assert [r["lang_pred"] == "und" for r in found.orderBy("doc_id").collect()] == [True] * 5 + [False] * 3


def test_copies_of_a_text_are_fitted_once(spark, documents):
    own = documents.select("text", "lang").filter("lang is not null").limit(50)
    copies = own.unionByName(own.limit(1).crossJoin(spark.range(500)).drop("id"))
    assert len(language_id._sample(_sampled(copies), 1000)) == len(language_id._sample(_sampled(own), 1000))


def _sampled(df):
    return df.select(df["lang"].alias("_lang"), df["text"].alias("_text")).filter("_text is not null")


def test_scores_are_those_of_a_plain_loop(spark, documents):
    """Features, outputs, losses and decoding of every document, one number after the other."""
    model = language_id.train(documents)
    rows = language_id.predict(documents.select("doc_id", "text"), model).limit(40).collect()
    for r in rows:
        data = f" {(r['text'] or '').lower()} ".encode()
        counts = {}
        for i in range(len(data) - 2):
            code = data[i] | data[i + 1] << 8 | data[i + 2] << 16
            slot = (code * 0x9E3779B1 % 2**32) >> (32 - language_id.FEATURE_BITS)
            counts[slot] = counts.get(slot, 0) + 1
        size = sum(counts.values()) ** 0.5
        distance = []
        for code, trust in zip(model.code, model.trust):
            loss = 0.0
            for bit, (sign, weight) in enumerate(zip(code, trust)):
                output = float(model.bias[bit]) + sum(n**0.5 / size * float(model.weights[s, bit]) for s, n in counts.items())
                loss += float(weight) * np.log1p(np.exp(-output * sign))
            distance.append(loss)
        if r["lang_pred"] == "und":
            continue
        near = [np.exp(-(d - min(distance)) * model.code.shape[1]) for d in distance]
        assert model.languages[int(np.argmin(distance))] == r["lang_pred"]
        assert abs(max(near) / sum(near) - r["score"]) < 1e-3


def test_no_and_one_learned_language(spark, odd_docs):
    none = language_id.train(_labelled(spark, [("text", None), (None, "en"), ("123", "en")]))
    assert {r["lang_pred"] for r in language_id.predict(odd_docs, none).collect()} == {"und"}
    one = language_id.train(_labelled(spark, [("some text", "xx")]))
    assert {r["lang_pred"] for r in language_id.predict(odd_docs, one).collect()} == {"und", "xx"}


@pytest.mark.parametrize("classes", [2, 3, 4, 5, 6, 12, 40])
def test_codewords_differ_enough(classes):
    code = language_id.codewords(classes)
    assert set(np.unique(code)) <= {-1, 1} and code.shape[0] == classes
    distances = [(code[i] != code[j]).sum() for i in range(classes) for j in range(i)]
    assert min(distances) >= (1 if classes == 2 else 2 if classes == 3 else 4)


def test_decoding_corrects_a_wrong_bit():
    code = language_id.codewords(4)
    weights = np.zeros((language_id.FEATURES, code.shape[1]), np.float32)
    trust = np.full(code.shape, 1 / code.shape[1], np.float32)
    for k in range(4):
        output = code[k].astype(np.float32) * 3
        output[0] *= -1
        model = language_id.Model(list("abcd"), code, weights, output, trust)
        assert model.decode(np.zeros((1, language_id.FEATURES), np.float32)).argmax() == k


def test_trigrams_do_not_depend_on_slices(monkeypatch):
    text = "Ünïcode text " * 50
    whole = language_id.trigram_counts(text)
    monkeypatch.setattr(language_id, "_SLICE", 7)
    assert (language_id.trigram_counts(text) == whole).all()


# --------------------------------------------------------------------------- toxicity


def test_toxicity_of_held_out_documents(spark):
    labels = {r["doc_id"]: r["toxic"] for r in spark.read.parquet("/root/testdata/sf0.1/labels.parquet").collect()}
    rows = toxicity.op9_toxicity(spark, "/root/testdata/sf0.1").collect()
    assert len(rows) == 10_000
    for r in rows:
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1)
        assert 0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.7)
    judged = [(labels[r["doc_id"]], r["predicted"]) for r in rows if r["held_out"] and r["doc_id"] in labels]
    toxic = [p for y, p in judged if y == 1]
    clean = [p for y, p in judged if y == 0]
    # Some labels of this small table mark texts that have nothing toxic in them.
    assert sum(toxic) >= 0.8 * len(toxic) and sum(clean) <= 0.01 * len(clean)


def test_toxicity_of_odd_rows(spark, odd_docs):
    texts = [(i, f"plain words number {i}" + (" horrid" if i % 2 else "")) for i in range(60)]
    docs = spark.createDataFrame([*texts, (None, "horrid")], "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(60)] + [(1, 0), (2, None), (None, 1), (999, 1)], "doc_id long, toxic int")
    network = toxicity.train(docs, labels)
    found = toxicity.score(odd_docs, network)
    assert found.count() == odd_docs.count()
    by_text = {}
    for r in found.collect():
        assert 0 <= r["score"] <= 1
        assert by_text.setdefault(r["text"] or "", r["score"]) == r["score"]
    assert toxicity.score(odd_docs.limit(0), network).count() == 0
    assert toxicity.train(docs, labels.limit(0)).curve == (1.0, 0.0)


def test_every_word_is_in_a_window():
    for n in (0, 1, 15, 16, 17, 31, 32, 33, 48, 49, 1000):
        starts = toxicity.window_starts(n)
        covered = {i for s in starts for i in range(s, min(n, s + toxicity.WINDOW))}
        assert covered == set(range(n)) and len(starts) >= 1


def test_batches_score_as_single_texts():
    network = gated_network.Network(gated_network.Vocabulary([{b"a", b"b"}] * 3))
    texts = [" ".join("ab"[(i * k) % 2] + str(i % 7) for i in range(90 * k % 71)) for k in range(6)] + ODD_TEXTS
    texts = [t or "" for t in texts]
    together = toxicity._largest_logits(network, texts)
    assert np.allclose(together, [toxicity._largest_logits(network, [t])[0] for t in texts], atol=1e-5)


def test_gradients_match_differences():
    rng = np.random.default_rng(0)
    words = [f"w{i}x".encode() for i in range(6)]
    network = gated_network.Network(gated_network.Vocabulary([set(words)] * 3))
    ids = np.array([[0, 1, 2, 3], [4, 5, -1, -1], [2, 2, 1, -1]])
    target, weight = np.array([1, 0, 1], np.float32), np.array([1, 2, 1], np.float32)
    for name in network.p:
        network.p[name] = network.p[name].astype(np.float64)

    def loss():
        logit = network.forward(network.inputs(words)[0].astype(np.float64), ids)
        p = 1 / (1 + np.exp(-logit.astype(np.float64)))
        return -(weight * (target * np.log(p) + (1 - target) * np.log(1 - p))).sum() / weight.sum()

    g = network.gradients(words, ids, target, weight)
    for name, value in network.p.items():
        flat = value.reshape(-1)
        for i in rng.choice(len(flat), min(6, len(flat)), replace=False):
            kept = flat[i]
            flat[i] = kept + 1e-2
            high = loss()
            flat[i] = kept - 1e-2
            low = loss()
            flat[i] = kept
            assert np.isclose(g[name].reshape(-1)[i], (high - low) / 2e-2, rtol=0.05, atol=2e-4), (name, i)
