"""Demand and delay models on Spark ML: matrices, cross-validation, scoring."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor
from datetime import datetime

from pyspark import inheritable_thread_target
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.feature import OneHotEncoder, SQLTransformer, StringIndexer, StringIndexerModel, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from .. import schemas, session
from ..functions import metrics
from ..functions.clock import moment
from ..sources.sinks import stored
from . import ensembles, splits

DEMAND_FEATURES = [
    "daily_orders", "daily_gmv", "daily_review", "lag_1_orders", "lag_7_orders", "rolling_7_orders", "dow", "month_num",
]
DEMAND_TARGET = "target_orders_next_7d"
DELAY_CATEGORIES = ["customer_state", "seller_state", "payment_type"]
DELAY_NUMBERS = ["item_price", "freight_value", "delivery_days"]
DELAY_LABEL = "is_delayed"
LEAKY = {"delivery_days"}  # only known once the order has arrived
MISSING = "__nan__"
SEED = 42


def _number(name: str) -> Column:
    return F.coalesce(F.col(name).try_cast("double"), F.lit(0.0)).alias(name)


def demand_matrix(train: DataFrame) -> DataFrame:
    """Numeric demand features, 0 for NULL; rows without a target dropped."""
    return train.filter(F.col(DEMAND_TARGET).isNotNull()).select(
        "kpi_date",
        "customer_state",
        "product_category_name",
        *[_number(c) for c in DEMAND_FEATURES],
        _number(DEMAND_TARGET),
    )


def delay_matrix(train: DataFrame) -> DataFrame:
    """Delay features as the model sees them: NULL is a category of its own, numbers default to 0."""
    return train.select(
        "order_id",
        *[F.coalesce(c, F.lit(MISSING)).alias(c) for c in DELAY_CATEGORIES],
        *[_number(c) for c in DELAY_NUMBERS],
        F.col(DELAY_LABEL).cast("int").alias(DELAY_LABEL),
    )


#: Models that are trained at the same time, where each one's Spark jobs are small next to a cluster.
AT_ONCE = 4
#: Training rows that all models of a time keep in the executors; what exceeds memory would be
#: written to disk and read again for every level of every tree.
ROWS_AT_ONCE = 20_000_000


def at_once(rows: int) -> int:
    """How many models of so many rows are trained at the same time."""
    return max(1, min(AT_ONCE, ROWS_AT_ONCE // max(1, rows)))


def side_by_side(spark: SparkSession, fit: Callable, parts: Sequence, rows: int = 0) -> list:
    """Results of independent fits in the order of ``parts``; small ones run at the same time.

    ``rows`` is the size of one fit. Threads of the driver only start and await Spark jobs.
    With the FAIR scheduler (``spark.scheduler.mode``) their jobs share the executors evenly.
    The first error is raised.
    """
    with ThreadPoolExecutor(max_workers=at_once(rows)) as pool:
        # Wrapped one by one, so that each thread has job settings of its own.
        started = [pool.submit(inheritable_thread_target(spark)(fit), part) for part in parts]
        return [job.result() for job in started]


# ---------------------------------------------------------------- demand model


def demand_pipeline(trees: int = 400, depth: int = 7) -> Pipeline:
    clean = SQLTransformer(
        statement="SELECT *, "
        + ", ".join(f"coalesce(try_cast({c} AS double), 0.0D) AS x_{c}" for c in DEMAND_FEATURES)
        + " FROM __THIS__"
    )
    assemble = VectorAssembler(inputCols=[f"x_{c}" for c in DEMAND_FEATURES], outputCol="features")
    model = GBTRegressor(
        featuresCol="features", labelCol=DEMAND_TARGET, predictionCol="prediction",
        maxIter=trees, maxDepth=depth, stepSize=0.05, subsamplingRate=0.9, featureSubsetStrategy="0.9", seed=SEED,
    )
    return Pipeline(stages=[clean, assemble, model])


def train_forecast(
    train: DataFrame, trees: int = 400, depth: int = 7, folds: int = splits.TIME_FOLDS, refit: bool = False
) -> tuple[PipelineModel, DataFrame]:
    """Model of the last fold (or of all rows with ``refit``) and one score row per fold.

    Only the row count and the fold scores reach the driver.
    """
    spark = train.sparkSession
    indexed = stored(splits.time_index(demand_matrix(train)), "demand-matrix")
    n = indexed.count()
    if n == 0:
        raise ValueError("no training rows")
    plan = splits.time_fold_plan(n, folds)
    clean, assemble, regressor = demand_pipeline(trees, depth).getStages()
    # Part k is what fold k validates; it learns from the parts before.
    begun = sum((F.col("row_index") >= fold.start).cast("int") for fold in plan)
    rows = clean.transform(indexed).withColumn("part", begun)
    plans = [ensembles.Plan(frozenset(range(k)), k) for k in range(1, len(plan) + 1)]
    if refit:
        plans.append(ensembles.Plan(frozenset(range(len(plan) + 1))))
    columns = assemble.getInputCols()
    inputs = [ensembles.Feature(c, i) for i, c in enumerate(columns)]
    model, answers = ensembles.fit(regressor, rows, inputs, "part", plans, len(columns))
    found = {r["model"]: r["score"] for r in answers.groupBy("model").agg(metrics.mape("label", "margin").alias("score")).collect()}
    scored = [(f.fold, f.start, f.end - f.start, found[k]) for k, f in enumerate(plan)]
    scores = spark.createDataFrame(scored, "fold int, train_rows long, validation_rows long, score double")
    return PipelineModel([clean, assemble, model]), scores


def score_demand(model: PipelineModel, scoring: DataFrame, version: str, scored_at: datetime | None = None) -> DataFrame:
    predicted = model.transform(scoring).select(
        "forecast_date",
        "customer_state",
        "product_category_name",
        F.col("prediction").cast("double").alias("predicted_orders_7d"),
        F.lit(version).alias("model_version"),
        moment(scored_at).alias("scored_at"),
    )
    return schemas.conform(predicted, schemas.OUTPUT["demand_forecast_daily"])


# ----------------------------------------------------------------- delay model


def delay_encoder(drop_leaky: bool = False) -> list:
    """Pipeline stages up to the feature vector. A category unseen in training becomes
    the indexer's extra level, which the encoder drops: all zeros."""
    numbers = [c for c in DELAY_NUMBERS if not (drop_leaky and c in LEAKY)]
    clean = SQLTransformer(
        statement="SELECT *, "
        + ", ".join(f"coalesce({c}, '{MISSING}') AS c_{c}" for c in DELAY_CATEGORIES)
        + ", "
        + ", ".join(f"coalesce(try_cast({c} AS double), 0.0D) AS x_{c}" for c in numbers)
        + " FROM __THIS__"
    )
    index = StringIndexer(
        inputCols=[f"c_{c}" for c in DELAY_CATEGORIES],
        outputCols=[f"i_{c}" for c in DELAY_CATEGORIES],
        handleInvalid="keep",
    )
    encode = OneHotEncoder(
        inputCols=[f"i_{c}" for c in DELAY_CATEGORIES], outputCols=[f"v_{c}" for c in DELAY_CATEGORIES], dropLast=True
    )
    assemble = VectorAssembler(
        inputCols=[f"x_{c}" for c in numbers] + [f"v_{c}" for c in DELAY_CATEGORIES], outputCol="features"
    )
    return [clean, index, encode, assemble]


def delay_classifier(trees: int = 500, depth: int = 6) -> GBTClassifier:
    return GBTClassifier(
        featuresCol="features", labelCol=DELAY_LABEL,
        maxIter=trees, maxDepth=depth, stepSize=0.05, subsamplingRate=0.9, featureSubsetStrategy="0.9", seed=SEED,
    )


def delay_matrix_encoded(train: DataFrame, drop_leaky: bool = False) -> DataFrame:
    """Rows with their assembled (sparse) feature vector."""
    fitted = Pipeline(stages=delay_encoder(drop_leaky)).fit(train)
    return fitted.transform(train).select("order_id", "features", F.col(DELAY_LABEL).cast("int").alias(DELAY_LABEL))


def matrix_cells(matrix: DataFrame) -> DataFrame:
    """The matrix in long form: how many rows of an order have which value other than 0 at which position."""
    cells = matrix.select("order_id", F.posexplode(vector_to_array("features")).alias("position", "value"))
    cells = cells.filter(F.col("value") != 0).groupBy("order_id", "position", "value").agg(F.count("*").alias("matrix_rows"))
    return cells.withColumn("position", F.col("position").cast("bigint"))


def _late_probability() -> Column:
    return vector_to_array("probability")[1]


def _delay_auc(answers: DataFrame) -> float:
    # The model's probability: its margin is half the logarithm of the odds.
    return metrics.roc_auc(answers.withColumn("p", 1 / (1 + F.exp(-2 * F.col("margin")))), "p", "label").first()[0]


def train_delay(
    train: DataFrame, trees: int = 500, depth: int = 6, folds: int = splits.STRATIFIED_FOLDS, drop_leaky: bool = False
) -> tuple[PipelineModel, DataFrame]:
    """Model refitted on all rows and one score row per usable fold.

    Folds with a single class are skipped; if none is left, a quarter of the rows
    is held out once, and a single class there is an error.

    The encoder is fitted on all rows and their numbers and levels are stored once: all models
    are grown from them together. A level that a fold's training rows lack is a column of zeros
    there, which no tree splits on, so a held-out row with it counts as none of the known ones.
    """
    spark = train.sparkSession
    folded = stored(splits.stratified_folds(train, folds=folds), "delay-matrix")
    if folded.isEmpty():
        raise ValueError("no training rows")
    counts = splits.fold_class_counts(folded).orderBy("fold").collect()
    asked = [int(r["fold"]) for r in counts if r["usable"]]
    if not asked:
        asked, folds = [0], 4
        folded = stored(splits.stratified_folds(train, folds=folds), "delay-holdout")
        if folded.filter(F.col("fold") == 0).select(DELAY_LABEL).distinct().count() < 2:
            raise ValueError("cannot compute ROC-AUC: the validation rows hold one class only")
    encoder = Pipeline(stages=delay_encoder(drop_leaky)).fit(folded)
    _, index, _, assemble = encoder.stages
    numbers = [c for c in assemble.getInputCols() if c.startswith("x_")]
    inputs, place = [ensembles.Feature(c, i) for i, c in enumerate(numbers)], len(numbers)
    for c, known in zip(index.getOutputCols(), index.labelsArray):
        inputs.append(ensembles.Feature(c, place, len(known)))
        place += len(known)
    rows = encoder.transform(folded).select(*[f.column for f in inputs], DELAY_LABEL, "fold")
    rows = stored(rows, "delay-vectors")
    every = frozenset(range(folds))
    plans = [*[ensembles.Plan(every - {fold}, fold) for fold in asked], ensembles.Plan(every)]
    final, answers = ensembles.fit(delay_classifier(trees, depth), rows, inputs, "fold", plans, place)
    n = sum(r["val_pos"] + r["val_neg"] for r in counts)
    scores = side_by_side(spark, lambda k: _delay_auc(answers.filter(F.col("model") == k)), range(len(asked)), n)
    return PipelineModel([*encoder.stages, final]), spark.createDataFrame(list(zip(asked, scores)), "fold int, score double")


def score_delay(model: PipelineModel, scoring: DataFrame, version: str, scored_at: datetime | None = None) -> DataFrame:
    scored = model.transform(scoring).select(
        "order_id",
        "order_purchase_ts",
        "customer_state",
        "seller_state",
        "payment_type",
        _late_probability().alias("delay_risk_score"),
        F.lit(version).alias("model_version"),
        moment(scored_at).alias("scored_at"),
    )
    return schemas.conform(scored, schemas.OUTPUT["delay_risk_scores"])



# ------------------------------------------------------------------- artifacts


_CONTRACT = "name string, kind string, levels array<string>"


def _contract(model: PipelineModel, inputs: DataFrame) -> list[tuple]:
    """Name and type of every input column that the model reads, and the levels of a category."""
    levels = {}
    for stage in model.stages:
        if isinstance(stage, StringIndexerModel):
            levels |= {c.removeprefix("c_"): list(known) for c, known in zip(stage.getInputCols(), stage.labelsArray)}
    read = set(levels) | {c.removeprefix("x_") for s in model.stages if isinstance(s, VectorAssembler) for c in s.getInputCols()}
    return [(f.name, f.dataType.simpleString(), levels.get(f.name)) for f in inputs.schema.fields if f.name in read]


def save_model(model: PipelineModel, path: str, inputs: DataFrame) -> None:
    """Store a model and beside it the columns that it reads, as ``inputs`` has them."""
    model.write().overwrite().save(f"{path}/model")
    rows = inputs.sparkSession.createDataFrame(_contract(model, inputs), _CONTRACT)
    rows.coalesce(1).write.mode("overwrite").parquet(f"{path}/columns")


def load_model(spark: SparkSession, path: str, inputs: DataFrame) -> PipelineModel:
    """A stored model for the given frame; an error where the frame lacks a column or has another type.

    Further columns do no harm, and neither do unknown levels of a category: they count as
    none of the known ones.
    """
    have = {f.name: f.dataType.simpleString() for f in inputs.schema.fields}
    for row in spark.read.schema(_CONTRACT).parquet(f"{path}/columns").collect():
        if row["name"] not in have:
            raise ValueError(f"the model reads a column {row['name']}")
        if have[row["name"]] != row["kind"]:
            raise ValueError(f"column {row['name']} is {have[row['name']]}, the model reads {row['kind']}")
    return PipelineModel.load(f"{path}/model")


def differing_predictions(one: PipelineModel, other: PipelineModel, rows: DataFrame, column: str = "prediction") -> DataFrame:
    """One row: how many rows were scored, and how many of them differently by the two models."""
    first = one.transform(rows).select(*rows.columns, F.col(column).alias("_first"))
    return other.transform(first).agg(
        F.count("*").alias("scored_rows"), F.count_if(~F.col("_first").eqNullSafe(F.col(column))).alias("differing")
    )


def mean_score(spark: SparkSession, scores: DataFrame) -> float:
    return metrics.fold_mean(scores).first()[0]


def naive_forecast(train: DataFrame) -> DataFrame:
    """Baseline: the value seven rows ago as the prediction."""
    return train.withColumn("prediction", F.col("lag_7_orders").cast("double"))
