"""Second-order boosted trees over binned features, grown level by level with grouped sums.

Features are binned once at quantiles. For each level of a tree one aggregation sums
gradients and hessians per (node, feature, bin); running sums over the bins give the gain of
every split, and the best split of each node, a few numbers, comes to the driver. Columns
are sampled per tree and rows per tree by a hash, so a model is repeatable whatever the
partitioning. The work of a level does not depend on the number of nodes but for its
histogram, which has at most nodes x features x bins rows.
"""

from __future__ import annotations

import json
import random
from collections.abc import Sequence
from dataclasses import asdict, dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from ..operators.quantiles import exact_quantiles
from ..sources.sinks import stored

SQUARED, LOGISTIC = "squared", "logistic"


@dataclass(frozen=True)
class Settings:
    """Sizes and rates; the penalty and the least weight of a leaf are the usual ones."""

    trees: int = 400
    depth: int = 7
    rate: float = 0.05
    rows: float = 0.9
    columns: float = 0.9
    bins: int = 64
    penalty: float = 1.0
    least_weight: float = 1.0
    objective: str = SQUARED
    base: float | None = None
    seed: int = 42


@dataclass
class Tree:
    """Nodes by number, the children of node k being 2k + 1 and 2k + 2. A leaf has feature -1."""

    feature: list[int]
    bin: list[int]
    value: list[float]


@dataclass
class Model:
    features: list[str]
    cuts: list[list[float]]
    base: float
    rate: float
    objective: str
    trees: list[Tree] = field(default_factory=list)

    def to_json(self) -> str:
        return json.dumps(asdict(self))

    @staticmethod
    def from_json(text: str) -> Model:
        given = json.loads(text)
        return Model(**given | {"trees": [Tree(**t) for t in given["trees"]]})


def _bin(name: str, cuts: Sequence[float]) -> Column:
    """How many cuts lie below the value; NULL and NaN count as 0, as in the feature matrix."""
    value = F.coalesce(F.nanvl(F.col(name).cast("double"), F.lit(0.0)), F.lit(0.0))
    return F.size(F.filter(F.lit(list(cuts)).cast("array<double>"), lambda cut: cut < value))


def feature_cuts(df: DataFrame, features: Sequence[str], bins: int) -> list[list[float]]:
    """Distinct inner quantiles of each feature, NULL as 0."""
    found = []
    for name in features:
        filled = df.select(F.coalesce(F.col(name).cast("double"), F.lit(0.0)).alias("v"))
        row = exact_quantiles(filled, "v", [i / bins for i in range(1, bins)]).first()
        found.append(sorted(set(row["quantiles"])))
    return found


def _gradients(objective: str) -> tuple[Column, Column]:
    if objective == LOGISTIC:
        p = 1 / (1 + F.exp(-F.col("_margin")))
        return p - F.col("_label"), p * (1 - p)
    return F.col("_margin") - F.col("_label"), F.lit(1.0)


def _child(tree: Tree) -> Column:
    """The next node of a row: a child, or the node itself where it is a leaf."""
    node = F.col("_node")
    feature = F.get(F.lit(tree.feature).cast("array<int>"), node)
    right = F.get("_bins", feature) > F.get(F.lit(tree.bin).cast("array<int>"), node)
    return F.when(feature < 0, node).otherwise(2 * node + 1 + right.cast("int"))


def histograms(rows: DataFrame, features: Sequence[int]) -> DataFrame:
    """``node, feature, bin, g, h``: gradient and hessian sums."""
    cells = F.array(*[F.struct(F.lit(f).alias("feature"), F.get("_bins", F.lit(f)).alias("bin")) for f in features])
    opened = rows.select(F.col("_node").alias("node"), "_g", "_h", F.inline(cells))
    return opened.groupBy("node", "feature", "bin").agg(F.sum("_g").alias("g"), F.sum("_h").alias("h"))


def best_splits(sums: DataFrame, penalty: float, least_weight: float) -> DataFrame:
    """Per node its sums and the split with the greatest gain; ties go to the first feature and bin.

    ``feature`` is NULL where no split gains anything.
    """
    upto = Window.partitionBy("node", "feature").orderBy("bin").rowsBetween(Window.unboundedPreceding, 0)
    every = Window.partitionBy("node", "feature")
    sided = sums.select(
        "node", "feature", "bin",
        F.sum("g").over(upto).alias("gl"), F.sum("h").over(upto).alias("hl"),
        F.sum("g").over(every).alias("gt"), F.sum("h").over(every).alias("ht"),
    )
    gr, hr = F.col("gt") - F.col("gl"), F.col("ht") - F.col("hl")

    def score(g: Column, h: Column) -> Column:
        return g * g / (h + penalty)

    gain = score(F.col("gl"), F.col("hl")) + score(gr, hr) - score(F.col("gt"), F.col("ht"))
    fits = (F.col("hl") >= least_weight) & (hr >= least_weight) & (gain > 0)
    choice = F.struct(gain.alias("gain"), (-F.col("feature")).alias("feature"), (-F.col("bin")).alias("bin"))
    # The sums of a node are those of any of its features; the least one is taken, so that they are repeatable.
    total = F.min(F.struct("feature", F.col("gt").alias("g"), F.col("ht").alias("h")))
    best = sided.groupBy("node").agg(F.max(F.when(fits, choice)).alias("c"), total.alias("t"))
    return best.select(
        "node", "t.g", "t.h", (-F.col("c.feature")).alias("feature"), (-F.col("c.bin")).alias("bin"), "c.gain"
    )


def _grow(rows: DataFrame, features: Sequence[int], s: Settings) -> Tree:
    size = 2 ** (s.depth + 1) - 1
    tree = Tree([-1] * size, [0] * size, [0.0] * size)
    rows = rows.withColumn("_node", F.lit(0))
    open_nodes = {0}
    for level in range(s.depth + 1):
        alive = rows.filter(F.col("_node") >= 2**level - 1)
        for r in best_splits(histograms(alive, features), s.penalty, s.least_weight).collect():
            if r["node"] not in open_nodes:
                continue
            tree.value[r["node"]] = -r["g"] / (r["h"] + s.penalty)
            if r["feature"] is not None and level < s.depth:
                tree.feature[r["node"]], tree.bin[r["node"]] = r["feature"], r["bin"]
        open_nodes = {c for n in open_nodes if tree.feature[n] >= 0 for c in (2 * n + 1, 2 * n + 2)}
        if not open_nodes:
            break
        rows = rows.withColumn("_node", _child(tree))
    return tree


def train(df: DataFrame, features: Sequence[str], label: str, s: Settings = Settings()) -> Model:
    """A boosted model; an error for a table without rows.

    Rows are stored with their bins once and with their margins after every tree, so a lost
    executor repeats one tree at most.
    """
    labelled = df.filter(F.col(label).isNotNull())
    start = labelled.agg(F.avg(F.col(label).cast("double"))).first()[0]
    if start is None:
        raise ValueError("no training rows")
    base = s.base if s.base is not None else (0.0 if s.objective == LOGISTIC else start)
    cuts = feature_cuts(labelled, features, s.bins)
    model = Model(list(features), cuts, base, s.rate, s.objective)
    bins = F.array(*[_bin(f, c) for f, c in zip(features, cuts)]).alias("_bins")
    rows = labelled.select(bins, F.col(label).cast("double").alias("_label"), F.lit(base).alias("_margin"))
    rows = stored(rows.withColumn("_row", F.monotonically_increasing_id()), "binned")
    rng = random.Random(s.seed)
    for nth in range(s.trees):
        taken = sorted(rng.sample(range(len(features)), max(1, round(s.columns * len(features)))))
        g, h = _gradients(s.objective)
        part = F.pmod(F.xxhash64("_row", F.lit(s.seed), F.lit(nth)), F.lit(1 << 20)) < int(s.rows * (1 << 20))
        drawn = rows.filter(part).withColumns({"_g": g, "_h": h})
        tree = _grow(drawn.select("_bins", "_g", "_h"), taken, s)
        model.trees.append(tree)
        rows = stored(rows.withColumn("_margin", F.col("_margin") + s.rate * _leaf(tree, s.depth)), "margins")
    return model


def _leaf(tree: Tree, depth: int) -> Column:
    """The value of the leaf that a row's bins lead to."""
    feature, cut = F.lit(tree.feature).cast("array<int>"), F.lit(tree.bin).cast("array<int>")

    def step(node: Column, _: Column) -> Column:
        own = F.get(feature, node)
        return F.when(own < 0, node).otherwise(2 * node + 1 + (F.get("_bins", own) > F.get(cut, node)).cast("int"))

    node = F.aggregate(F.sequence(F.lit(1), F.lit(depth)), F.lit(0), step)
    return F.get(F.lit(tree.value).cast("array<double>"), node)


def predict(model: Model, df: DataFrame, column: str = "prediction") -> DataFrame:
    """The rows with a prediction: the value, or for the logistic objective the probability.

    All trees are one array of structs that an aggregate runs over, so the plan does not
    grow with their number.
    """
    depth = max((len(t.feature).bit_length() - 1 for t in model.trees), default=0)
    kind = "array<struct<feature: array<int>, bin: array<int>, value: array<double>>>"
    trees = F.from_json(F.lit(json.dumps([asdict(t) for t in model.trees])), kind)
    bins = F.array(*[_bin(f, c) for f, c in zip(model.features, model.cuts)])

    def walk(tree: Column, given: Column) -> Column:
        def step(node: Column, _: Column) -> Column:
            own = F.get(tree["feature"], node)
            right = F.get(given, own) > F.get(tree["bin"], node)
            return F.when(own < 0, node).otherwise(2 * node + 1 + right.cast("int"))

        return F.get(tree["value"], F.aggregate(F.sequence(F.lit(1), F.lit(max(1, depth))), F.lit(0), step))

    total = F.aggregate(trees, F.lit(model.base).cast("double"), lambda acc, t: acc + model.rate * walk(t, F.col("_bins")))
    shown = 1 / (1 + F.exp(-total)) if model.objective == LOGISTIC else total
    return df.withColumn("_bins", bins).withColumn(column, shown).drop("_bins")


def save(model: Model, spark: SparkSession, path: str) -> None:
    spark.createDataFrame([(model.to_json(),)], "model string").coalesce(1).write.mode("overwrite").parquet(path)


def load(spark: SparkSession, path: str) -> Model:
    return Model.from_json(spark.read.parquet(path).first()["model"])


def splits_of(model: Model, tree: int = 0) -> list[tuple]:
    """Nodes of a tree that can be reached: number, feature name, bin, and the value of a leaf."""
    found, todo, t = [], [0], model.trees[tree]
    while todo:
        node = todo.pop(0)
        leaf = t.feature[node] < 0
        found.append((node, None if leaf else model.features[t.feature[node]], None if leaf else t.bin[node], t.value[node] if leaf else None))
        todo += [] if leaf else [2 * node + 1, 2 * node + 2]
    return found
