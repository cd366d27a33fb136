"""Language identification by error-correcting output codes.

Each language has a codeword of bits. For each bit a linear classifier over hashed byte
trigrams tells the languages with a one from those with a zero. A text is given to the
language whose codeword is nearest to the classifiers' outputs under a loss, weighted by
how well each bit was learned for each language. Errors of single bits are corrected by
the others; when two codewords are about equally near, the text is flagged as ambiguous, and
when it is much farther from every codeword than any labelled text was, as outside.

The classifiers are fitted in numpy on a bounded sample of labelled texts (``SAMPLE_ROWS``
distinct ones, spread evenly over the languages and chosen by a hash of the text). Whole
texts are read both for fitting and for prediction, in Arrow batches; only predictions come
back from Python.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from .common import chunk_of, prepare, read_table, strings, text_of, unused_name

#: Distinct texts that the classifiers are fitted on, at most about this many in all.
SAMPLE_ROWS = 3000
FEATURE_BITS = 12
FEATURES = 1 << FEATURE_BITS
UNKNOWN = "und"
#: A text is ambiguous when the second language has this share of the first one's score.
AMBIGUOUS_RATIO = 0.5
#: Bytes of the short excerpts that are fitted beside each whole text.
EXCERPTS = (24, 96)
_SLICE = 1 << 20
#: A text is outside all languages at so many times the largest distance of a fitted text.
OUTSIDE_RATIO = 1.25
#: Texts that features are made of at a time.
_ROWS_AT_ONCE = 128
_PREDICTION = "struct<lang_pred: string, score: double, ambiguous: boolean, outside: boolean>"


def _has_letter(text: Column) -> Column:
    return text.rlike(r"\p{L}")


def trigram_counts(text: str) -> np.ndarray:
    """Counts of the hashed byte trigrams of the lower-cased text with a space on either side."""
    data = np.frombuffer(f" {text.lower()} ".encode("utf-8", "replace"), np.uint8)
    counts = np.zeros(FEATURES, np.int64)
    for start in range(0, len(data) - 2, _SLICE):
        part = data[start : start + _SLICE + 2].astype(np.uint32)
        code = part[:-2] | part[1:-1] << np.uint32(8) | part[2:] << np.uint32(16)
        counts += np.bincount((code * np.uint32(0x9E3779B1)) >> np.uint32(32 - FEATURE_BITS), minlength=FEATURES)
    return counts


def _scaled(counts: np.ndarray) -> np.ndarray:
    """Square roots of the counts, scaled to length one: a text's length does not matter."""
    roots = np.sqrt(counts.astype(np.float32))
    return roots / np.maximum(np.linalg.norm(roots, axis=-1, keepdims=True), 1e-9)


def codewords(classes: int, seed: int = 7) -> np.ndarray:
    """A row of -1 and 1 for each class.

    Up to five classes get the exhaustive code; more get the random code with the largest
    least distance between rows among a fixed number of draws.
    """
    if classes <= 5:
        columns = [(1, *rest) for rest in itertools.product((1, -1), repeat=classes - 1)][1:]
        return np.array(columns, np.int8).T.reshape(classes, len(columns))
    rng = np.random.default_rng(seed)
    width = max(15, int(np.ceil(10 * np.log2(classes))))
    draws = (rng.choice(np.array([-1, 1], np.int8), (classes, width)) for _ in range(100))

    def least_distance(code: np.ndarray) -> int:
        same = code.astype(np.int32) @ code.T.astype(np.int32)
        return int(((width - same) // 2 + width * np.eye(classes, dtype=np.int32)).min())

    return max(draws, key=least_distance)


@dataclass
class Model:
    languages: list[str]
    code: np.ndarray
    weights: np.ndarray
    bias: np.ndarray
    trust: np.ndarray
    #: Distance from the nearest codeword beyond which a text is outside.
    limit: float = np.inf

    def distances(self, features: np.ndarray) -> np.ndarray:
        """Weighted loss of every codeword for each row."""
        outputs = features @ self.weights + self.bias
        losses = np.log1p(np.exp(-np.clip(outputs[:, None, :] * self.code[None], -30, 30)))
        return (losses * self.trust[None]).sum(axis=2)

    def decode(self, features: np.ndarray) -> np.ndarray:
        """Scores of all languages for each row, adding up to one."""
        distance = self.distances(features)
        near = np.exp(-(distance - distance.min(axis=1, keepdims=True)) * max(1, self.code.shape[1]))
        return near / near.sum(axis=1, keepdims=True)


class _Sparse:
    """Trigram counts of many texts; features are made of a few at a time."""

    def __init__(self, rows: list[tuple[np.ndarray, np.ndarray]]):
        self.rows = rows

    def __getitem__(self, which: np.ndarray) -> np.ndarray:
        counts = np.zeros((len(which), FEATURES), np.int64)
        for i, row in enumerate(which):
            counts[i, self.rows[row][0]] = self.rows[row][1]
        return _scaled(counts)

    def parts(self) -> Iterator[np.ndarray]:
        for start in range(0, len(self.rows), _ROWS_AT_ONCE):
            yield self[np.arange(start, min(len(self.rows), start + _ROWS_AT_ONCE))]


def _fitted(features: _Sparse, target: np.ndarray, epochs: int = 12, rate: float = 0.05) -> tuple[np.ndarray, np.ndarray]:
    """Logistic classifiers for all bits at once, by Adam over small batches."""
    rng = np.random.default_rng(11)
    weights = np.zeros((FEATURES, target.shape[1]), np.float32)
    bias = np.zeros(target.shape[1], np.float32)
    moments = [np.zeros_like(weights), np.zeros_like(weights), np.zeros_like(bias), np.zeros_like(bias)]
    step = 0
    for _ in range(epochs):
        order = rng.permutation(len(target))
        for start in range(0, len(order), _ROWS_AT_ONCE):
            rows = order[start : start + _ROWS_AT_ONCE]
            x, y = features[rows], target[rows]
            slope = -y / (1 + np.exp(np.clip(y * (x @ weights + bias), -30, 30))) / len(rows)
            step += 1
            for value, grad, k in ((weights, x.T @ slope, 0), (bias, slope.sum(axis=0), 2)):
                moments[k] *= 0.9
                moments[k] += 0.1 * grad
                moments[k + 1] *= 0.999
                moments[k + 1] += 0.001 * grad * grad
                scale = np.sqrt(moments[k + 1] / (1 - 0.999**step)) + 1e-7
                value -= rate * moments[k] / (1 - 0.9**step) / scale
    return weights, bias


def fit(rows: list[tuple[str, np.ndarray, np.ndarray]]) -> Model:
    """Model from languages with the trigrams that a text has and their counts."""
    languages = sorted({lang for lang, _, _ in rows})
    number = {lang: i for i, lang in enumerate(languages)}
    code = codewords(len(languages)) if languages else np.zeros((0, 0), np.int8)
    if not code.size:
        empty = np.zeros((FEATURES, code.shape[1]), np.float32)
        return Model(languages, code, empty, np.zeros(code.shape[1], np.float32), np.ones(code.shape, np.float32))
    features = _Sparse([(at, n) for _, at, n in rows])
    own = np.array([number[lang] for lang, _, _ in rows])
    weights, bias = _fitted(features, code[own].astype(np.float32))
    right = np.concatenate([part @ weights + bias for part in features.parts()]) * code[own] > 0
    trust = np.array([right[own == k].mean(axis=0) for k in range(len(languages))], np.float32)
    model = Model(languages, code, weights, bias, trust / np.maximum(trust.sum(axis=1, keepdims=True), 1e-9))
    model.limit = OUTSIDE_RATIO * max(float(model.distances(part).min(axis=1).max()) for part in features.parts())
    return model


def _sample(rows: DataFrame, sample_rows: int) -> list[tuple[str, np.ndarray, np.ndarray]]:
    """Features of about ``sample_rows`` distinct labelled texts and of short excerpts from each.

    However often a text is repeated, it is taken once.
    """
    rows = rows.withColumn("_key", F.xxhash64("_text", F.lit("sample")))
    per_lang = rows.groupBy("_lang").agg(F.approx_count_distinct("_key").alias("texts")).collect()
    share = sample_rows / max(1, len(per_lang))
    kept = None
    for r in per_lang:
        # The hash decides, so the same rows are taken whatever the partitioning.
        part = F.pmod("_key", F.lit(1 << 20)) < int(min(1.0, share / max(1, r["texts"])) * (1 << 20))
        chosen = (F.col("_lang") == r["_lang"]) & part
        kept = chosen if kept is None else kept | chosen
    if kept is None:
        return []
    chosen = rows.filter(kept).groupBy("_lang", "_key").agg(F.min("_text").alias("_text"))

    def read(batches):
        for batch in batches:
            langs, found = [], []
            for lang, text in zip(batch["_lang"].to_pylist(), strings(batch["_text"]).to_pylist()):
                cuts = [text]
                for width in EXCERPTS:
                    cuts += [text[len(text) // 3 :][:width]] if len(text) > 3 * width else []
                for cut in cuts:
                    langs.append(lang)
                    found.append(trigram_counts(cut))
            index = [np.flatnonzero(c) for c in found]
            yield pa.record_batch(
                {
                    "lang": pa.array(langs, pa.string()),
                    "at": pa.array([i.astype(np.int32) for i in index], pa.list_(pa.int32())),
                    "n": pa.array([c[i].astype(np.int32) for c, i in zip(found, index)], pa.list_(pa.int32())),
                }
            )

    table = chosen.select("_lang", "_text").mapInArrow(read, "lang string, at array<int>, n array<int>").toArrow()
    result = [(lang, at.values.to_numpy(), n.values.to_numpy()) for lang, at, n in zip(table["lang"].to_pylist(), table["at"], table["n"])]
    # Collected rows come in no fixed order.
    return sorted(result, key=lambda r: (r[0], r[1].tobytes(), r[2].tobytes()))


def train(labelled: DataFrame, text_col: str = "text", lang_col: str = "lang", sample_rows: int = SAMPLE_ROWS) -> Model:
    """Model from the rows with a language and a text that has a letter."""
    prepare(labelled.sparkSession)
    rows = labelled.select(F.col(lang_col).alias("_lang"), text_of(text_col).alias("_text"))
    return fit(_sample(rows.filter(F.col("_lang").isNotNull() & _has_letter(F.col("_text"))), sample_rows))


def _prediction(learned: Model, texts: pa.Array) -> pa.Array:
    """One prediction per text; null gives ``und``."""
    given = texts.to_pylist()
    known = [i for i, t in enumerate(given) if learned.languages and t is not None]
    langs = [UNKNOWN] * len(given)
    scores, doubt, outside = np.zeros(len(given)), np.zeros(len(given), bool), np.zeros(len(given), bool)
    for start in range(0, len(known), _ROWS_AT_ONCE):
        rows = known[start : start + _ROWS_AT_ONCE]
        features = _scaled(np.array([trigram_counts(given[i]) for i in rows]))
        found = learned.decode(features)
        ranked = np.sort(found, axis=1)
        for i, best in zip(rows, found.argmax(axis=1)):
            langs[i] = learned.languages[best]
        scores[rows] = ranked[:, -1]
        doubt[rows] = ranked[:, -2] >= AMBIGUOUS_RATIO * ranked[:, -1] if found.shape[1] > 1 else False
        far = learned.distances(features).min(axis=1) > learned.limit
        outside[rows] = far & (np.array([len(given[i]) for i in rows]) >= EXCERPTS[0])
    columns = [pa.array(langs, pa.string()), pa.array(scores), pa.array(doubt), pa.array(outside)]
    return pa.StructArray.from_arrays(columns, ["lang_pred", "score", "ambiguous", "outside"])


def prediction(docs: DataFrame, model: Model, text_col: str = "text") -> Column:
    """The prediction for a text column as a struct; the other columns do not go through Python."""
    spark = prepare(docs.sparkSession)
    shared = spark.sparkContext.broadcast(model)

    @F.arrow_udf(_PREDICTION)
    def predicted(texts: pa.Array) -> pa.Array:
        return _prediction(shared.value, texts)

    text = F.col(f"`{text_col}`")
    return predicted(F.when(_has_letter(text), text))


def predict(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """The rows with ``lang_pred, score, ambiguous, outside`` in front of their columns.

    A null text, a text without a letter (of any script) and, if no language was learned,
    any text gives ``und`` with score 0. A text shorter than the shortest excerpt that was
    fitted is never outside. An empty table stays empty; repeated rows are
    predicted alike. Columns of the input that have one of these names are replaced.
    """
    own = [c for c in docs.columns if c not in ("lang_pred", "score", "ambiguous", "outside")]
    helper = unused_name(docs, "_prediction")
    found = docs.withColumn(helper, prediction(docs, model, text_col))
    return found.select(f"{helper}.*", *[F.col(f"`{c}`") for c in own])


def accepted(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` whose text is in a learned language; ``und`` and what is outside all codewords go.

    An ambiguous text stays: its language is in doubt, not that it is language.
    """
    helper = unused_name(docs, "_prediction")
    found = docs.withColumn(helper, prediction(docs, model, text_col))
    kept = found.filter((F.col(f"{helper}.lang_pred") != UNKNOWN) & ~F.col(f"{helper}.outside"))
    return kept.select(*[F.col(f"`{c}`") for c in docs.columns])


def op6_language_id(spark, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    held_out = chunk_of("doc_id", 4) == 2
    model = train(docs.filter(~held_out).select("text", "lang"))
    found = predict(docs.select("doc_id", "text", held_out.alias("held_out")), model)
    return found.select("doc_id", "held_out", "lang_pred", "score", "ambiguous", "outside")
