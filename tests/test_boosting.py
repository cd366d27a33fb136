"""Boosted trees against a plain implementation over the same bins."""

import math
import random

import pytest

from conftest import rows
from orderloom.plans import boosting
from orderloom.plans.boosting import LOGISTIC, Settings


def _data(n, kind):
    rng = random.Random(7)
    found = []
    for _ in range(n):
        x = (rng.randint(0, 9), rng.choice([None, 0.5, 1.5, 2.5]), rng.randint(0, 3))
        y = 3 * (x[0] > 4) + (x[1] or 0) + (2 if x[2] == 1 and x[0] < 3 else 0)
        found.append((*x, float(y > 3) if kind == LOGISTIC else float(y)))
    return found


def _plain(data, cuts, s):
    """Trees and predictions, one row after the other; all rows and columns."""
    binned = [[sum(c < (v or 0) for c in cuts[f]) for f, v in enumerate(r[:-1])] for r in data]
    label = [r[-1] for r in data]
    margin = [s.base] * len(data)

    def leaf(g, h):
        return -g / (h + s.penalty)

    for _ in range(s.trees):
        if s.objective == LOGISTIC:
            p = [1 / (1 + math.exp(-m)) for m in margin]
            g, h = [a - y for a, y in zip(p, label)], [a * (1 - a) for a in p]
        else:
            g, h = [m - y for m, y in zip(margin, label)], [1.0] * len(data)

        def grow(part, depth):
            gt, ht = sum(g[i] for i in part), sum(h[i] for i in part)
            best = None
            for f in range(len(cuts)):
                for b in sorted({binned[i][f] for i in part}):
                    left = [i for i in part if binned[i][f] <= b]
                    gl, hl = sum(g[i] for i in left), sum(h[i] for i in left)
                    gain = gl**2 / (hl + s.penalty) + (gt - gl) ** 2 / (ht - hl + s.penalty) - gt**2 / (ht + s.penalty)
                    if hl >= s.least_weight and ht - hl >= s.least_weight and gain > 1e-12 and (best is None or gain > best[0] + 1e-12):
                        best = (gain, f, b)
            if best is None or depth == 0:
                return {i: leaf(gt, ht) for i in part}
            _, f, b = best
            return grow([i for i in part if binned[i][f] <= b], depth - 1) | grow([i for i in part if binned[i][f] > b], depth - 1)

        values = grow(list(range(len(data))), s.depth)
        margin = [m + s.rate * values[i] for i, m in enumerate(margin)]
    return margin


@pytest.mark.parametrize("kind", ["squared", LOGISTIC])
def test_predictions_equal_a_plain_implementation(spark, tmp_path, kind):
    data = _data(200, kind)
    s = Settings(trees=3, depth=3, rate=0.3, rows=1.0, columns=1.0, bins=8, base=0.5, objective=kind)
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(data)], "i long, a long, b double, c long, y double").repartition(3)
    model = boosting.train(df, ["a", "b", "c"], "y", s)
    want = _plain(data, model.cuts, s)
    if kind == LOGISTIC:
        want = [1 / (1 + math.exp(-m)) for m in want]
    boosting.save(model, spark, str(tmp_path / "m"))
    again = boosting.load(spark, str(tmp_path / "m"))
    for m in (model, again):
        found = {r["i"]: r["prediction"] for r in boosting.predict(m, df).collect()}
        assert [found[i] for i in range(len(data))] == pytest.approx(want, abs=1e-9)


def test_sampled_trees_are_repeatable_and_learn(spark):
    data = _data(400, "squared")
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(data)], "i long, a long, b double, c long, y double").coalesce(1)
    s = Settings(trees=6, depth=3, rate=0.5, bins=8)
    model = boosting.train(df, ["a", "b", "c"], "y", s)
    assert boosting.train(df, ["a", "b", "c"], "y", s) == model
    error = sum((r["prediction"] - r["y"]) ** 2 for r in boosting.predict(model, df).collect())
    mean = sum(r[-1] for r in data) / len(data)
    assert error < 0.2 * sum((r[-1] - mean) ** 2 for r in data)


def test_no_rows_and_constant_labels(spark):
    with pytest.raises(ValueError, match="no training rows"):
        boosting.train(spark.createDataFrame([], "a long, y double"), ["a"], "y", Settings(trees=1))
    df = spark.createDataFrame([(1, 2.0), (2, 2.0), (3, None)], "a long, y double")
    model = boosting.train(df, ["a"], "y", Settings(trees=2, depth=2))
    assert {r[0] for r in rows(boosting.predict(model, df), "prediction")} == {2.0}
    assert boosting.predict(boosting.Model(["a"], [[]], 1.5, 0.1, "squared"), df).first()["prediction"] == 1.5
