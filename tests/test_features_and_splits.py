from datetime import date, datetime, timedelta
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from conftest import rows
from orderloom import schemas
from orderloom.plans import features, models, splits

DAY = date(2018, 1, 1)


def _base(spark, series):
    """``series``: {(state, category): [orders per day]}"""
    data = [
        (DAY + timedelta(days=i), state, category, n, Decimal(n), 4.0)
        for (state, category), values in series.items()
        for i, n in enumerate(values)
    ]
    schema = "kpi_date date, customer_state string, product_category_name string, daily_orders long, daily_gmv decimal(38,2), daily_review double"
    return spark.createDataFrame(data, schema)


def test_series_of_seven_rows_vanish_and_eight_give_one(spark):
    base = _base(spark, {("SP", "a"): range(1, 8), ("SP", "b"): range(1, 9), (None, "c"): range(1, 11)})
    train = features.demand_features_train(base)
    assert rows(train.groupBy("product_category_name").count()) == [("b", 1), ("c", 3)]
    first = train.filter("product_category_name = 'b'").first()
    assert (first["lag_1_orders"], first["rolling_7_orders"], first["target_orders_next_7d"]) == (None, None, 8)
    assert first["dow"] == 1 and first["month_num"] == 1  # a Monday, Sunday is 0
    newest = {r["product_category_name"]: r["forecast_date"] for r in features.demand_features_scoring(base).collect()}
    assert newest == {"b": DAY, "c": DAY + timedelta(days=2)}
    full = {r["product_category_name"]: r["forecast_date"] for r in features.demand_features_scoring(base, from_full=True).collect()}
    assert full == {"a": DAY + timedelta(days=6), "b": DAY + timedelta(days=7), "c": DAY + timedelta(days=9)}


def test_rolling_mean_leaves_out_the_current_row(spark):
    base = _base(spark, {("SP", "a"): range(1, 20)})
    got = {r["kpi_date"]: r["rolling_7_orders"] for r in features.demand_features_train(base).collect()}
    assert got[DAY + timedelta(days=1)] == 1.0
    assert got[DAY + timedelta(days=10)] == sum(range(4, 11)) / 7


def _orders(spark):
    fct = spark.createDataFrame(
        [
            ("o1", "SP", DAY, datetime(2018, 1, 1, 9), datetime(2018, 1, 4, 1), Decimal("10.00"), 4.0, 1),
            ("o2", "SP", DAY, datetime(2018, 1, 1, 9), None, Decimal("7.00"), None, None),
            ("o3", None, None, None, None, Decimal("1.00"), 1.0, 0),
        ],
        "order_id string, customer_state string, order_date date, order_purchase_ts timestamp_ntz, "
        "order_delivered_customer_ts timestamp_ntz, payment_total decimal(28,2), avg_review_score double, is_delayed int",
    )
    item = lambda o, n, p, s, price: (o, n, p, s, None, Decimal(price), Decimal("1.00"))
    items = spark.createDataFrame(
        [item("o1", 1, "p1", "s1", "3.00"), item("o1", 2, "p1", "s1", "3.00"), item("o1", 3, "p2", "s2", "4.00"), item("o1", 4, "p9", None, "5.00")],
        schemas.STAGING["order_items"],
    )
    products = spark.createDataFrame([("p1", "toys", 1, 1, 1, 1), ("p2", None, 1, 1, 1, 1)], schemas.STAGING["products"])
    sellers = spark.createDataFrame([("s1", "1", "x", "RJ"), ("s2", "1", "x", "SP")], schemas.STAGING["sellers"])
    payments = spark.createDataFrame(
        [("o1", 1, "card", 1, Decimal("6.00")), ("o1", 2, "voucher", 1, Decimal("4.00"))], schemas.STAGING["payments"]
    )
    return fct, items, products, sellers, payments


def test_demand_base_counts_payments_per_item_row(spark):
    fct, items, products, _, _ = _orders(spark)
    got = {r["product_category_name"]: (r["daily_orders"], r["daily_gmv"], r["daily_review"]) for r in features.demand_base(fct, items, products).collect()}
    # unknown: two item rows of o1 (no category, no product) and o2, which has no items.
    assert got == {"toys": (1, Decimal("20.00"), 4.0), "unknown": (2, Decimal("27.00"), 4.0)}


def test_delay_features_fan_out_items_by_payments(spark):
    fct, items, _, sellers, payments = _orders(spark)
    train = features.delay_features_train(fct, items, sellers, payments)
    plain = (
        fct.filter("order_purchase_ts is not null")
        .join(items, "order_id", "left")
        .join(sellers, "seller_id", "left")
        .join(payments, "order_id", "left")
    )
    assert rows(train, "order_id", "seller_state", "payment_type") == rows(plain, "order_id", "seller_state", "payment_type")
    o1 = train.filter("order_id = 'o1'").first()
    assert o1["delivery_days"] == 3 and o1["is_delayed"] == 1
    o2 = train.filter("order_id = 'o2'").first()
    assert (o2["item_price"], o2["delivery_days"], o2["is_delayed"], o2["seller_state"]) == (Decimal("0.00"), None, 0, None)
    best = features.delay_features_scoring(train).filter("order_id = 'o1'").first()
    assert (best["seller_state"], best["payment_type"], best["item_price"]) == ("RJ", "card", Decimal("3.00"))


def test_time_plan():
    with pytest.raises(ValueError):
        splits.time_fold_plan(4)
    for n in (5, 15, 79, 80, 160, 1003):
        plan = splits.time_fold_plan(n)
        assert len(plan) == 4
        assert plan[-1].end == n and all(a.end == b.start for a, b in zip(plan, plan[1:]))
        assert {f.end - f.start for f in plan} == {n // (len(plan) + 1)} and plan[0].start > 0
    with pytest.raises(ValueError):
        splits.time_fold_plan(20, folds=20)
    assert splits.time_fold_plan(3, folds=2) == [splits.TimeFold(1, 1, 2), splits.TimeFold(2, 2, 3)]


def test_time_index_is_gapless_and_ordered(spark):
    base = _base(spark, {(s, c): range(1, 30) for s in ("SP", "RJ", None) for c in ("a", "b")})
    indexed = splits.time_index(base)
    got = [(r["kpi_date"], r["customer_state"] or "", r["product_category_name"]) for r in indexed.orderBy("row_index").collect()]
    assert got == sorted(got)
    assert [r[0] for r in indexed.select("row_index").orderBy("row_index").collect()] == list(range(len(got)))
    plan = splits.time_fold_plan(len(got))
    for fold, row in zip(plan, splits.time_series_folds(indexed, plan, "daily_orders").orderBy("fold").collect()):
        train, val = splits.time_fold_rows(indexed, fold)
        assert (train.count(), val.count()) == (row["train_rows"], row["validation_rows"])
        assert row["last_train_day"] <= row["first_validation_day"]


def _delay_rows(spark, n, positive, copies=0):
    data = [
        (f"o{i}", datetime(2018, 1, 1), ("SP", "RJ", None)[i % 3], ("MG", "SP")[i % 2], "card", Decimal(i % 9), Decimal("1.00"), i % 20, int(positive(i)))
        for i in range(n)
    ]
    data += [("hot", datetime(2018, 1, 1), "SP", "SP", "card", Decimal("1.00"), Decimal("1.00"), 4, 0)] * copies
    return spark.createDataFrame(
        data,
        "order_id string, order_purchase_ts timestamp_ntz, customer_state string, seller_state string, payment_type string, "
        "item_price decimal(18,2), freight_value decimal(18,2), delivery_days int, is_delayed int",
    )


def test_stratified_folds_are_balanced_whole_and_repeatable(spark):
    df = _delay_rows(spark, 200, lambda i: i % 4 == 0, copies=100)
    folded = splits.stratified_folds(df)
    assert rows(folded.drop("fold")) == rows(df)
    assert rows(folded) == rows(splits.stratified_folds(df.repartition(7)))
    sizes = folded.groupBy("is_delayed", "fold").count().collect()
    for label in (0, 1):
        counts = [r["count"] for r in sizes if r["is_delayed"] == label]
        assert len(counts) == 5 and max(counts) - min(counts) <= 1
    assert all(r["usable"] for r in splits.fold_class_counts(folded).collect())


def test_delay_training_errors_and_skips(spark):
    with pytest.raises(ValueError, match="one class"):
        models.train_delay(_delay_rows(spark, 40, lambda i: False), trees=1, depth=2)
    with pytest.raises(ValueError, match="no training rows"):
        models.train_delay(_delay_rows(spark, 0, lambda i: False), trees=1, depth=2)


def test_delay_model_scores_unseen_categories_and_is_repeatable(spark, tmp_path):
    train = _delay_rows(spark, 120, lambda i: i % 20 > 11)
    model, scores = models.train_delay(train, trees=2, depth=2, folds=2)
    assert scores.count() == 2 and all(0.9 < r["score"] <= 1 for r in scores.collect())
    unseen = train.limit(5).withColumn("customer_state", F.lit("ZZ")).drop("is_delayed")
    scored = models.score_delay(model, unseen, "v", datetime(2024, 1, 1))
    assert scored.count() == 5 and scored.filter("delay_risk_score between 0 and 1").count() == 5
    assert scored.first()["scored_at"] == datetime(2024, 1, 1)
    path = str(tmp_path / "model")
    models.save_model(model, path, train)
    again = models.score_delay(models.load_model(spark, path, unseen), unseen, "v", datetime(2024, 1, 1))
    assert rows(again) == rows(scored)
    # The frame has to have the columns that the model was trained on, with their types.
    with pytest.raises(ValueError, match="reads a column seller_state"):
        models.load_model(spark, path, unseen.drop("seller_state"))
    with pytest.raises(ValueError, match="item_price is string"):
        models.load_model(spark, path, unseen.withColumn("item_price", F.lit("1")))
    known = {r["name"]: r["levels"] for r in spark.read.parquet(f"{path}/columns").collect()}
    assert set(known) == {*models.DELAY_CATEGORIES, *models.DELAY_NUMBERS} and "ZZ" not in known["customer_state"]
    encoded = models.delay_matrix_encoded(train, drop_leaky=True).first()["features"]
    assert encoded.size == 2 + 3 + 2 + 1  # two numbers; states, seller states, payment types as levels


def test_forecast_model(spark):
    base = _base(spark, {(s, "a"): [1 + (i + k) % 7 for i in range(40)] for k, s in enumerate(("SP", "RJ"))})
    train = features.demand_features_train(base)
    model, scores = models.train_forecast(train, trees=2, depth=2)
    assert [r["fold"] for r in scores.orderBy("fold").collect()] == [1, 2, 3, 4]
    out = models.score_demand(model, features.demand_features_scoring(base), "v1", datetime(2024, 1, 1))
    assert out.schema.simpleString() == schemas.OUTPUT["demand_forecast_daily"].simpleString() and out.count() == 2
    assert models.mean_score(spark, scores) > 0


def test_delay_training_encodes_its_rows_once(spark, monkeypatch):
    """Not once per fold; the folds read stored vectors, and the model still takes raw rows."""
    made, real, kept, store = [], models.delay_encoder, [], models.stored
    monkeypatch.setattr(models, "delay_encoder", lambda *a: made.append(a) or real(*a))
    monkeypatch.setattr(models, "stored", lambda df, name: kept.append(name) or store(df, name))
    train = _delay_rows(spark, 120, lambda i: i % 20 > 11)
    model, scores = models.train_delay(train, trees=1, depth=2, folds=3)
    assert len(made) == 1 and kept.count("delay-vectors") == 1 and scores.count() == 3
    assert model.transform(train).count() == train.count()


def test_large_models_are_trained_one_by_one():
    assert [models.at_once(n) for n in (0, 1000, models.ROWS_AT_ONCE // 2, 50_000_000)] == [4, 4, 2, 1]
