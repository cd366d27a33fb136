from datetime import date, datetime
from decimal import Decimal

from conftest import rows
from orderloom import schemas
from orderloom.functions import casts
from orderloom.plans import staging as plan
from orderloom.sources import csv_tables


def _cast(spark, values, cast):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, x string")
    return [r[1] for r in sorted(df.select("i", cast("x")).collect())]


def test_timestamps_need_a_full_date(spark):
    got = _cast(
        spark,
        ["2017-10-02 10:56:33", "2017-10-02", "2017", "2017-10", "bad", "", None, "2017-02-30 00:00:00", " 2017-10"],
        casts.to_timestamp,
    )
    assert got == [datetime(2017, 10, 2, 10, 56, 33), datetime(2017, 10, 2)] + [None] * 7


def test_dates_accept_a_time_part(spark):
    assert _cast(spark, ["2018-01-18", "2018-01-18 00:00:00", "2018", "soon"], casts.to_date) == [
        date(2018, 1, 18), date(2018, 1, 18), None, None,
    ]


def test_numbers_round_and_never_fail(spark):
    assert _cast(spark, ["7", "1.7", "-1.5", "x", "", None, "9" * 25], casts.to_number) == [
        7, 2, -2, None, None, None, None,
    ]


def test_decimals(spark):
    assert _cast(spark, ["1.005", "12.3", "n/a", "9" * 20], casts.to_decimal) == [
        Decimal("1.01"), Decimal("12.30"), None, None,
    ]
    assert _cast(spark, ["-33.5", "south", ""], casts.to_double) == [-33.5, None, None]


def test_cast_failures_count_only_given_values(spark):
    raw = {t: spark.createDataFrame([], s) for t, s in schemas.RAW.items()}
    raw["payments"] = spark.createDataFrame(
        [("a", "1", "card", "x", "1.0"), ("b", None, "card", "2", "bad"), ("c", "2", "card", "3", None)],
        schemas.RAW["payments"],
    )
    got = {
        r["column_name"]: (r["row_count"], r["given_values"], r["failed_casts"])
        for r in plan.cast_failures(raw).filter("table_name = 'payments'").collect()
    }
    assert got == {
        "payment_sequential": (3, 2, 0), "payment_installments": (3, 3, 1), "payment_value": (3, 2, 1),
    }


def _write(tmp_path, name, text):
    (tmp_path / name).write_text(text, encoding="utf-8")
    return str(tmp_path / name)


def test_csv_quotes_newlines_markers_and_rejects(spark, tmp_path):
    path = _write(
        tmp_path,
        "reviews.csv",
        "review_id,order_id,review_score,review_comment_title,review_comment_message,review_creation_date,review_answer_timestamp\n"
        'r1,o1,5,"said ""wow""","two\nlines",2018-01-01,2018-01-02 10:00:00\n'
        "r2,o2,NULL,null,,2018-01-01,2018-01-02 10:00:00\n"
        "r3,o3,4\n"
        "r4,o4,4,a,b,2018-01-01,2018-01-02 10:00:00,extra\n",
    )
    parsed = csv_tables.parse_csv(spark, "reviews", path)
    good = rows(csv_tables.good_rows(parsed))
    assert good == [
        ("r1", "o1", "5", 'said "wow"', "two\nlines", "2018-01-01", "2018-01-02 10:00:00"),
        ("r2", "o2", None, None, None, "2018-01-01", "2018-01-02 10:00:00"),
    ]
    assert rows(csv_tables.good_rows(parsed).select("review_id")) == [("r1",), ("r2",)]
    assert rows(csv_tables.rejected_rows(parsed, "reviews"), "first_field", "line", "reason", "file_name") == [
        ("r3", "r3,o3,4", "too few fields", "reviews.csv"),
        ("r4", "r4,o4,4,a,b,2018-01-01,2018-01-02 10:00:00,extra", "too many fields", "reviews.csv"),
    ]


def test_landed_tables_count_without_parsing_again(spark, tmp_path):
    path = _write(tmp_path, "sellers.csv", "seller_id,seller_zip_code_prefix,seller_city,seller_state\ns1,1,a,SP\nbroken\n")
    landed = csv_tables.land(spark, str(tmp_path), str(tmp_path / "landed"), {"sellers": "sellers.csv"})
    assert csv_tables.good_rows(landed["sellers"]).count() == 1
    assert rows(csv_tables.rejects_by_table(landed)) == [
        ("sellers", "broken", "broken", "too few fields", "sellers.csv", 0)
    ]
    assert path.endswith("sellers.csv")


def test_prefixed_file_names():
    names = csv_tables.prefixed_files("shop")
    assert names["orders"] == "shop_orders_dataset.csv"
    assert names["payments"] == "shop_order_payments_dataset.csv"
    assert names["reviews"] == "shop_order_reviews_dataset.csv"


def test_declared_output_tables(spark):
    for name, schema in schemas.OUTPUT.items():
        empty = schemas.empty_table(spark, name)
        assert empty.schema == schema and empty.isEmpty()
    got = {(f.name, f.dataType.simpleString()) for f in schemas.OUTPUT["model_registry"].fields}
    assert ("metric_value", "double") in got and ("updated_at", "timestamp_ntz") in got
