"""Toxicity of whole texts: a gated recurrent network over all overlapping windows.

A text is as toxic as its most toxic window of ``WINDOW`` words; windows begin every
``STRIDE`` words, so each place lies in two of them and none is left out. The network
(``gated_network``) is trained in numpy on windows of a bounded sample of labelled
documents. A label belongs to a document, not to a window, so after a first training only
the windows of a toxic document that look most toxic are used for the next. At last the
largest logits of the sample's whole texts are turned into probabilities by a logistic
curve, so that long clean texts, which have many windows, are not taken for toxic ones.
"""

from __future__ import annotations

import re
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import chunk_of, prepare, read_table, strings, text_of, unused_name
from .gated_network import Network, Vocabulary, scores, train_epochs

#: Bounds of the training sample: labelled documents of either class, and windows of each.
SAMPLE_TOXIC, SAMPLE_CLEAN, SAMPLE_WINDOWS = 1500, 3000, {1: 16, 0: 8}
WINDOW, STRIDE = 32, 16
_WORD = re.compile(r"\w+")
_AT_ONCE = 4096


def words_of(text: str) -> list[bytes]:
    return [w.encode("utf-8", "replace") for w in _WORD.findall(text.lower())]


def window_starts(words: int) -> np.ndarray:
    """Where the windows of a text begin; the last one reaches its end."""
    return np.arange(0, max(1, words - STRIDE), STRIDE)


def _sample(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """A bounded sample of labelled documents, chosen by a hash of the id."""
    rows = labels.filter("label is not null").groupBy("doc_id").agg(F.max("label").alias("label"))
    counts = {r["label"]: r["count"] for r in rows.groupBy("label").count().collect()}
    wanted = {1: SAMPLE_TOXIC, 0: SAMPLE_CLEAN}
    kept = F.lit(False)
    for label, most in wanted.items():
        share = int(min(1.0, most / max(1, counts.get(label, 0))) * (1 << 20))
        # The hash decides, so the same documents are taken whatever the partitioning.
        kept = kept | ((F.col("label") == label) & (F.pmod(F.xxhash64("doc_id", F.lit("sample")), F.lit(1 << 20)) < share))
    # About SAMPLE_TOXIC + SAMPLE_CLEAN rows, whatever the input.
    return docs.join(F.broadcast(rows.filter(kept)), "doc_id").select("label", "_text")


def _sample_windows(sample: DataFrame) -> list[tuple[int, int, list[list[bytes]]]]:
    """(label, hash, some windows) of each document of the sample."""

    def cut(batches):
        for batch in batches:
            labels, keys, texts = [], [], []
            for label, text in zip(batch["label"].to_pylist(), strings(batch["_text"]).to_pylist()):
                words = words_of(text)
                key = zlib.crc32(text.encode("utf-8", "replace"))
                starts = np.random.default_rng(key).permutation(window_starts(len(words)))[: SAMPLE_WINDOWS[label]]
                labels.append(label)
                keys.append(key)
                texts.append([b" ".join(words[s : s + WINDOW]) for s in sorted(starts)])
            yield pa.record_batch(
                {"label": pa.array(labels, pa.int32()), "key": pa.array(keys, pa.int64()), "windows": pa.array(texts, pa.list_(pa.binary()))}
            )

    table = sample.mapInArrow(cut, "label int, key long, windows array<binary>").toArrow().to_pylist()
    found = [(r["label"], r["key"], [w.split() for w in r["windows"]]) for r in table]
    return sorted(found)  # collected rows come in no fixed order


def fit(sample: list[tuple[int, int, list[list[bytes]]]]) -> Network:
    """Network from labelled documents given as windows."""
    vocabulary = Vocabulary([{w for window in windows for w in window} for _, _, windows in sample])
    network = Network(vocabulary)
    owner = np.array([i for i, (_, _, windows) in enumerate(sample) for _ in windows], np.int64)
    windows = [w for _, _, own in sample for w in own]
    if not windows:
        return network
    target = np.array([sample[i][0] for i in owner], np.float32)
    share = np.float32(max(1.0, (target == 0).sum()) / max(1.0, (target == 1).sum()))
    train_epochs(network, windows, target, np.where(target == 1, share, np.float32(1)), epochs=1, rate=0.02, seed=1)
    for seed in (2, 3):
        found = scores(network, windows)
        best = np.full(len(sample), -1.0)
        np.maximum.at(best, owner, found)
        rows = np.flatnonzero((target == 0) | (found >= best[owner]))
        weight = np.where(target[rows] == 1, np.float32(4), np.float32(1))
        train_epochs(network, [windows[i] for i in rows], target[rows], weight, epochs=1, rate=0.01, seed=seed)
    return network


def calibrate(network: Network, label: np.ndarray, logit: np.ndarray) -> None:
    """Logistic curve from largest logits to probabilities, with targets kept off 0 and 1."""
    toxic, clean = (label == 1).sum(), (label == 0).sum()
    if not toxic or not clean:
        return
    goal = np.where(label == 1, (toxic + 1) / (toxic + 2), 1 / (clean + 2))
    centre, spread = logit.mean(), max(1e-6, logit.std())
    x = np.stack([(logit - centre) / spread, np.ones(len(logit))])
    curve = np.array([1.0, 0.0])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(curve @ x, -30, 30)))
        slope = x @ (p - goal) + np.array([1e-3 * curve[0], 0.0])
        curve = curve - np.linalg.solve((x * (p * (1 - p) + 1e-4)) @ x.T + np.diag([1e-3, 0.0]), slope)
    network.curve = (float(curve[0] / spread), float(curve[1] - curve[0] * centre / spread))


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic") -> Network:
    """Network from the documents that have a label 0 or 1; of several labels the larger counts."""
    rows = docs.select(F.col(id_col).alias("doc_id"), text_of(text_col).alias("_text"))
    marks = labels.select(F.col(id_col).alias("doc_id"), F.col(label_col).cast("int").alias("label"))
    sample = _sample(rows, marks)
    network = fit(_sample_windows(sample))

    def largest(batches):
        for batch in batches:
            logits = _largest_logits(network, strings(batch["_text"]).to_pylist())
            yield pa.record_batch({"label": batch["label"], "logit": pa.array(logits)})

    found = sample.mapInArrow(largest, "label int, logit double").toArrow()
    calibrate(network, found["label"].to_numpy(), found["logit"].to_numpy())
    return network


def _largest_logits(network: Network, texts: list[str]) -> np.ndarray:
    """The logit of the most toxic window of each text."""
    if not texts:
        return np.zeros(0)
    lists = [words_of(t) for t in texts]
    counts = np.array([len(x) for x in lists], np.int64)
    flat = pa.array([w for x in lists for w in x], pa.binary()).dictionary_encode()
    index = flat.indices.to_numpy().astype(np.int64)
    vectors = network.inputs(flat.dictionary.to_pylist())[0]
    begin = np.cumsum(counts) - counts
    starts = [window_starts(n) for n in counts]
    first = np.cumsum([0, *map(len, starts)])[:-1]
    low = np.concatenate([b + s for b, s in zip(begin, starts)])
    high = np.concatenate([np.full(len(s), b + n) for b, s, n in zip(begin, starts, counts)])
    found = np.empty(len(low), np.float32)
    for k in range(0, len(low), _AT_ONCE):
        at = low[k : k + _AT_ONCE, None] + np.arange(WINDOW)[None]
        inside = at < high[k : k + _AT_ONCE, None]
        ids = np.where(inside, index[np.where(inside, at, 0)] if len(index) else -1, -1)
        found[k : k + _AT_ONCE] = network.forward(vectors, ids)
    return np.maximum.reduceat(found.astype(np.float64), first)


def _probabilities(network: Network, texts: list[str]) -> np.ndarray:
    scale, shift = network.curve
    return 1 / (1 + np.exp(-np.clip(scale * _largest_logits(network, texts) + shift, -500, 500)))


def score(docs: DataFrame, network: Network, text_col: str = "text", threshold: float = 0.7) -> DataFrame:
    """The rows with ``score`` and ``predicted`` in front of their columns.

    A text without words, null included, is one empty window and gets the score that the
    network has without input. Repeated rows are scored alike; an empty table stays empty.
    Columns of the input that have one of these names are replaced.
    """
    spark = prepare(docs.sparkSession)
    shared = spark.sparkContext.broadcast(network)
    own = [c for c in docs.columns if c not in ("score", "predicted")]
    helper = unused_name(docs, "_text")
    rows = docs.select(F.col(text_col).alias(helper), *[F.col(f"`{c}`") for c in own])

    def judge(batches):
        for batch in batches:
            texts = strings(batch[helper]).to_pylist()
            found = _probabilities(shared.value, texts)
            columns = {"score": pa.array(found), "predicted": pa.array((found >= threshold).astype(np.int32))}
            yield pa.record_batch(columns | {c: batch[c] for c in batch.schema.names if c != helper})

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields[1:])
    return rows.mapInArrow(judge, f"score double, predicted int{', ' + kinds if kinds else ''}")


def op9_toxicity(spark, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    held_out = chunk_of("doc_id", 3) == 1
    labels = read_table(spark, sf_dir, "labels").select("doc_id", "toxic")
    network = train(docs.select("doc_id", "text"), labels.filter(~held_out))
    found = score(docs.select("doc_id", held_out.alias("held_out"), "text"), network)
    return found.select("doc_id", "held_out", "score", "predicted")
