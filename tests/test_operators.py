import itertools
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import rows
from orderloom.functions import metrics
from orderloom.operators import changes, quantiles
from orderloom.operators.joins import left_join_details
from orderloom.operators.ordering import capped_sample, hash_text, running_total, with_even_bucket


def test_running_total_matches_a_loop(spark):
    rng = random.Random(1)
    data = [(i, rng.choice(["a", "b", None]), rng.uniform(-50, 50), rng.randint(0, 4)) for i in range(300)]
    df = spark.createDataFrame(data, "i int, g string, x double, w int")
    got = {
        r["i"]: (r["before"], r["total"])
        for r in running_total(
            with_even_bucket(df, "x", "b"), F.col("w"), F.col("b"), [F.col("x")], within=["g"], grand_total="total"
        ).collect()
    }
    for i, g, x, _ in data:
        same = [r for r in data if r[1] == g]
        assert got[i] == (sum(r[3] for r in same if r[2] < x), sum(r[3] for r in same))


def test_even_bucket_keeps_order(spark):
    values = sorted([-1e300, -5.0, -1e-9, 0.0, 1e-9, 0.3, 0.5, 0.50001, 7.0, 1e6, 1e300])
    df = spark.createDataFrame([(v,) for v in values], "x double")
    buckets = [r["b"] for r in with_even_bucket(df, "x", "b").orderBy("x").collect()]
    assert buckets == sorted(buckets) and len(set(buckets)) > 5


def test_crowded_values_spread_over_many_buckets(spark):
    df = spark.range(20_000).select((0.5 + F.col("id") / 20_000_000).alias("x"))
    sizes = [r["count"] for r in with_even_bucket(df, "x", "b").groupBy("b").count().collect()]
    assert len(sizes) > 200 and max(sizes) < 400


def test_running_total_of_text_buckets_sorts_no_rows_for_its_offsets(spark):
    df = spark.createDataFrame([(b, i) for b in (None, "a", "b") for i in range(3)], "b string, i long")
    ranked = running_total(df, F.lit(1), F.col("b"), [F.col("i")], name="before")
    assert sorted(r["before"] for r in ranked.collect()) == list(range(9))
    assert "SortAggregate" not in ranked._jdf.queryExecution().executedPlan().toString()


def test_running_total_shuffles_rows_once(spark):
    """With broadcasts off, the rows meet their offsets in the partitioning of the window."""
    df = spark.range(1000).select("id", (F.col("id") % 7).cast("string").alias("g"))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        ranked = running_total(df, F.lit(1), F.floor(F.col("id") / 100), [F.col("id")], within=["g"])
        plan = ranked._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    join = plan.index("SortMergeJoin")
    rows_side = plan[join:].split("Range (0")[0]
    assert rows_side.count("Exchange hashpartitioning") == 1, plan


@pytest.mark.parametrize(
    "values",
    [
        [1.0],
        [5.0] * 20,
        [1.0, 2.0, 2.0, 2.0, 9.0, -4.0, 7.5],
        [float(x) for x in range(101)],
        [10.0] * 60 + [float(i * i) for i in range(40)],
    ],
)
def test_quantiles_match_numpy(spark, values):
    df = spark.createDataFrame([(v,) for v in values] + [(None,)], "x double")
    probs = [i / 10 for i in range(11)]
    got = quantiles.exact_quantiles(df, "x", probs).first()[0]
    assert np.allclose(got, np.quantile(values, probs), rtol=1e-12)


def _psi(expected, actual, bins=10):
    """Brute force on plain lists."""
    edges = sorted(set(np.quantile(expected, np.linspace(0, 1, bins + 1))))
    if len(edges) < 3 or not len(actual):
        return 0.0
    e, a = np.histogram(expected, edges)[0], np.histogram(actual, edges)[0]
    e, a = np.maximum(e / max(e.sum(), 1), 1e-6), np.maximum(a / max(a.sum(), 1), 1e-6)
    return float(((a - e) * np.log(a / e)).sum())


@pytest.mark.parametrize(
    "base,now",
    [
        ([float(i) for i in range(100)], [float(i) for i in range(50, 150)]),
        ([float(i) for i in range(100)], [0.0, 99.0, 9.9, 200.0, -3.0]),
        ([float(i) for i in range(100)], [500.0, 600.0]),
        ([4.0] * 50, [1.0, 2.0]),
        ([float(i % 7) for i in range(80)], [float(i % 5) for i in range(30)]),
        ([float(i) for i in range(40)], []),
    ],
)
def test_psi_matches_brute_force(spark, base, now):
    b = spark.createDataFrame([(v,) for v in base], "x double")
    c = spark.createDataFrame([(v,) for v in now], "x double")
    assert quantiles.psi(b, c, "x").first()[0] == pytest.approx(_psi(base, now), abs=1e-12)


def test_psi_of_an_empty_baseline_is_zero(spark):
    empty = spark.createDataFrame([], "x double")
    assert quantiles.psi(empty, spark.createDataFrame([(1.0,)], "x double"), "x").first()[0] == 0.0


@pytest.mark.parametrize("cap", [1, 7, 40, 1000])
def test_capped_sample_with_copies(spark, cap):
    # One key holds a third of all rows, all alike.
    data = [("hot", 1, 5.0)] * 40 + [(f"o{i}", 1, float(i)) for i in range(80)]
    df = spark.createDataFrame(data, "k string, s int, v double")
    got = sorted(r["v"] for r in capped_sample(df, ["k", "s"], ["v"], cap).collect())
    hashed = df.select(hash_text("k", "s").alias("h"), "k", "s", "v").collect()
    assert got == sorted(r["v"] for r in sorted(hashed)[:cap])


def test_auc_matches_pair_counting(spark):
    rng = random.Random(3)
    data = [(round(rng.random(), 1), rng.randint(0, 1)) for _ in range(120)]
    pos = [s for s, y in data if y]
    neg = [s for s, y in data if not y]
    want = sum((p > n) + (p == n) / 2 for p, n in itertools.product(pos, neg)) / (len(pos) * len(neg))
    df = spark.createDataFrame(data, "s double, y int")
    assert metrics.roc_auc(df, "s", "y").first()[0] == pytest.approx(want, abs=1e-12)
    assert metrics.roc_auc(df.filter("y = 1"), "s", "y").first()[0] is None


def test_mape_floor_and_fold_mean(spark):
    df = spark.createDataFrame([(2.0, 1.0), (4.0, 6.0), (0.0, 0.0)], "y double, p double")
    assert df.agg(metrics.mape("y", "p")).first()[0] == pytest.approx((0.5 + 0.5 + 0) / 3)
    for scores, want in [([0.2, 0.4], 0.3), ([float("nan"), 0.4], 1.0), ([float("inf")], 1.0), ([], 1.0)]:
        s = spark.createDataFrame([(x,) for x in scores], "score double")
        assert metrics.fold_mean(s).first()[0] == pytest.approx(want)


def test_change_feed_updates_inserts_deletes_nulls_copies(spark):
    schema = "k string, v string"
    old = spark.createDataFrame([("same", "x"), ("null", None), ("upd", "a"), ("del", "d"), ("dup", "z"), ("dup", "z")], schema)
    new = spark.createDataFrame([("same", "x"), ("null", None), ("upd", "b"), ("ins", "i"), ("dup", "z")], schema)
    assert rows(changes.change_feed(old, new, "k")) == [
        ("del", "d", "DELETE", False),
        ("dup", "z", "DELETE", False),
        ("ins", "i", "INSERT", False),
        ("upd", "a", "DELETE", True),
        ("upd", "b", "INSERT", True),
    ]


def test_left_join_details_equals_left_joins(spark):
    left = spark.createDataFrame([("a", 1), ("b", 2), ("c", 3), (None, 4), ("a", 5)], "k string, x int")
    d1 = spark.createDataFrame([("a", "p"), ("a", "q"), ("b", "r"), (None, "n"), ("z", "z")], "k string, y string")
    d2 = spark.createDataFrame([("a", 1.0), ("a", 1.0), ("c", 2.0)], "k string, w double")
    want = left.join(d1, "k", "left").join(d2, "k", "left").select("k", "x", "y", "w")
    assert rows(left_join_details(left, "k", d1, d2), "k", "x", "y", "w") == rows(want)


def test_hot_detail_key_is_split_at_run_time(spark):
    """One key holds a third of the detail rows: its join partition is split, the result stays whole."""
    keep = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "50KB",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.shuffle.partitions": "8",
    }
    before = {k: spark.conf.get(k, None) for k in keep}
    try:
        for k, v in keep.items():
            spark.conf.set(k, v)
        left = spark.range(3000).select(F.col("id").cast("string").alias("k"))
        detail = spark.range(0, 60000, 1, 8).select(
            F.when(F.col("id") % 3 == 0, F.lit("7")).otherwise((F.col("id") % 2900).cast("string")).alias("k"),
            F.md5(F.col("id").cast("string")).alias("y"),
        )
        joined = left_join_details(left, "k", detail)
        joined.write.format("noop").mode("overwrite").save()
        want = left.join(detail, "k", "left")
        out = joined.groupBy("k").count()
        assert sorted(out.collect()) == sorted(want.groupBy("k").count().collect())
        joined.collect()
        assert "skew=true" in joined._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v) if v is not None else spark.conf.unset(k)


def test_shuffles_begin_with_more_partitions_for_more_input(spark, tmp_path, monkeypatch):
    import __spark_entry__ as registered
    from orderloom import session
    from conftest import SMALL

    begin = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    registered.Tables(spark, SMALL)
    assert spark.conf.get(begin) == "4"  # as the session says
    assert spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes") == str(session.SHUFFLED_PER_TASK)
    size = session.input_bytes(spark, f"{SMALL}/lineitem.parquet")
    assert size > 0 and session.input_bytes(spark, str(tmp_path / "none")) == 0
    monkeypatch.setattr(session, "INPUT_PER_PARTITION", size // 50)
    registered.Tables(spark, SMALL)
    assert int(spark.conf.get(begin)) >= 50
    spark.conf.set(begin, "4")


def test_tasks_read_no_more_of_larger_files(spark):
    """Sums per order held as many rows as a part of a file has, which grew with the file."""
    import __spark_entry__ as registered
    from orderloom import session
    from conftest import SMALL

    key = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(key, None)
    spark.conf.unset(key)
    try:
        registered.Tables(spark, SMALL)
        assert spark.conf.get(key) == str(session.SCANNED_PER_TASK)
        spark.conf.set(key, "64m")
        registered.Tables(spark, SMALL)
        assert spark.conf.get(key) == "64m"
    finally:
        spark.conf.set(key, before) if before is not None else spark.conf.unset(key)
