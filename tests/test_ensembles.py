"""Models grown together against Spark's own trainer, and the sizes of the registered ones."""

import inspect

import pytest
from pyspark.ml import Pipeline
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import OneHotEncoder, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import functions as F

import __spark_entry__ as registered
from conftest import SMALL
from orderloom.plans import ensembles, models
from orderloom.plans.ensembles import Feature, Plan
from test_features_and_splits import _delay_rows

INPUTS, PLACES = [Feature("a", 0), Feature("b", 1), Feature("c", 2, 4)], 6
SIZES = {"maxIter": 4, "maxDepth": 3, "stepSize": 0.3, "subsamplingRate": 1.0, "featureSubsetStrategy": "1.0", "seed": 1, "labelCol": "y"}


def _near(values):
    """Targets have seven digits."""
    return pytest.approx(sorted(values), abs=1e-6)


@pytest.fixture(scope="module")
def table(spark):
    """Two numbers, a category with a level that the encoder drops, three parts, repeated rows."""
    data = [(float(i % 13), float(i * i % 7), float(i % 5), i % 3, float((i * 7 % 11 + i % 5 > 7) != (i % 17 == 0))) for i in range(600)]
    df = spark.createDataFrame(data + data[:90], "a double, b double, c double, part int, y double")
    encode = OneHotEncoder(inputCols=["c"], outputCols=["v"], dropLast=True)
    return Pipeline(stages=[encode, VectorAssembler(inputCols=["a", "b", "v"], outputCol="features")]).fit(df).transform(df).cache()


@pytest.mark.parametrize("tasks", [1, 3])
@pytest.mark.parametrize("kind", [GBTClassifier, GBTRegressor])
def test_models_are_sparks_own(table, monkeypatch, kind, tasks):
    monkeypatch.setattr(ensembles, "TASK_ROWS", 1)
    monkeypatch.setattr(ensembles, "MOST_TASKS", tasks)
    monkeypatch.setattr(ensembles, "CHUNK", 50)
    estimator = kind(**SIZES)
    plans = [Plan(frozenset({0, 1, 2})), Plan(frozenset({1, 2}), 0), Plan(frozenset({0, 1}), 2)]
    model, answers = ensembles.fit(estimator, table, INPUTS, "part", plans, PLACES)
    wanted = estimator.fit(table.filter("part < 2"))

    def predicted(m, rows):
        shown = vector_to_array("probability")[1] if kind is GBTClassifier else F.col("prediction")
        return _near(r[0] for r in m.transform(rows).select(shown).collect())

    assert predicted(model, table).expected == predicted(wanted, table)
    assert model.getNumTrees == 4 and model.treeWeights == wanted.treeWeights
    assert list(model.featureImportances.toArray()) == pytest.approx(list(wanted.featureImportances.toArray()))
    # What the models say of their asked rows is what they predict.
    margin = 1 / (1 + F.exp(-2 * F.col("margin"))) if kind is GBTClassifier else F.col("margin")
    said = [_near(r[0] for r in answers.filter(F.col("model") == k).select(margin).collect()) for k in range(3)]
    assert len(said[0].expected) == 0 and said[2].expected == predicted(wanted, table.filter("part = 2"))
    assert said[1].expected == predicted(estimator.fit(table.filter("part > 0")), table.filter("part = 0"))


def test_rows_beyond_memory_lie_in_a_file(table, monkeypatch):
    estimator = GBTClassifier(**SIZES | {"subsamplingRate": 0.7, "featureSubsetStrategy": "0.7"})
    found = []
    for most in (ensembles.IN_MEMORY, 1000):
        monkeypatch.setattr(ensembles, "IN_MEMORY", most)
        model, _ = ensembles.fit(estimator, table, INPUTS, "part", [Plan(frozenset({0, 1, 2}))], PLACES)
        found.append([t.toDebugString.partition("\n")[2] for t in model.trees])
    assert found[0] == found[1]


def test_jobs_do_not_grow_with_trees(spark):
    train, found = _delay_rows(spark, 120, lambda i: i % 20 > 11), []
    for trees in (1, 4):
        spark.sparkContext.setJobGroup(f"trees-{trees}", "training")
        models.train_delay(train, trees=trees, depth=2, folds=2)
        found.append(len(spark.sparkContext.statusTracker().getJobIdsForGroup(f"trees-{trees}")))
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert found[0] == found[1] > 0


@pytest.mark.parametrize(("query", "trainer", "sizes"), [("delay_cv", "train_delay", (500, 6)), ("forecast_cv", "train_forecast", (400, 7))])
def test_validations_train_models_of_full_size(spark, monkeypatch, query, trainer, sizes):
    real, found = getattr(models, trainer), []

    def spied(train, *given):
        bound = inspect.signature(real).bind(train, *given)
        bound.apply_defaults()
        found.append((bound.arguments["trees"], bound.arguments["depth"]))
        return real(train, 1, 1)

    monkeypatch.setattr(models, trainer, spied)
    registered.queries()[query](spark, SMALL)
    assert found == [sizes]
