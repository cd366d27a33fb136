"""Ledger, change feed and text streams: repeats, moves, cancellations, late details, refusals."""

import pathlib

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as registered
from conftest import SMALL, rows
from orderloom import schemas, session
from orderloom.operators.changes import apply_changes, change_feed
from orderloom.sources import csv_tables
from orderloom.streaming import changes, ledger, orders as order_streams




def _states(spark, *given):
    """States as the streaming aggregate gives them."""
    df = spark.createDataFrame(
        [(o, p, d, late, [*days], pay, s, n) for o, p, d, late, days, pay, s, n in given],
        "order_id string, present boolean, day string, is_delayed int, days array<string>, payment string, score long, scores long",
    )
    money = lambda c: F.col(c).cast("decimal(28,2)")
    return df.select(
        "order_id",
        F.struct(F.lit(1).cast("long").alias("version"), "present", F.col("day").cast("date").alias("day"), "is_delayed").alias("latest"),
        F.transform("days", lambda d: d.cast("date")).alias("days"),
        F.lit(None).cast("decimal(28,2)").alias("items_total"),
        F.lit(None).cast("decimal(28,2)").alias("freight_total"),
        money("payment").alias("payment_total"),
        "score",
        "scores",
    )


@pytest.fixture()
def kept(spark, tmp_path):
    paths = [str(tmp_path / n) for n in ("ledger", "kpis", "work")]

    def apply(*states, period=ledger.MONTHS):
        ledger.apply_states(spark, _states(spark, *states), *paths, period)
        found = rows(ledger.current_kpis(spark, paths[1]), "kpi_date", "total_orders", "gmv", "avg_review_score")
        return [(str(d), n, float(g), s) for d, n, g, s in found]

    return apply


@pytest.mark.parametrize("period", [ledger.MONTHS, ledger.DAYS])
def test_ledger_follows_moves_and_cancellations(kept, period):
    a, b = "2020-01-05", "2020-02-01"
    first = [("1", True, a, 0, [a], "10", 4, 1), ("2", True, a, 1, [a], None, None, None)]
    assert kept(*first, period=period) == [(a, 2, 10.0, 4.0)]
    # The same batch again changes nothing.
    assert kept(*first, period=period) == [(a, 2, 10.0, 4.0)]
    assert kept(("1", True, b, 0, [a, b], "12", 9, 2), period=period) == [(a, 1, 0.0, None), (b, 1, 12.0, 4.5)]
    # The last order of a day goes, and so does the day.
    assert kept(("2", False, a, 1, [a], None, None, None), period=period) == [(b, 1, 12.0, 4.5)]
    # An order without a day, and details without an order.
    assert kept(("3", True, None, None, [], "5", None, None), ("4", None, None, None, [], "7", 1, 1), period=period) == [(b, 1, 12.0, 4.5)]
    # It gets its day later, with the details that came before.
    assert kept(("4", True, b, None, [b], "7", 1, 1), period=period) == [(b, 2, 19.0, 2.75)]


def test_states_of_orders_take_the_newest_version_and_signed_details(spark):
    names = schemas.RAW["orders"].names
    text = ", ".join(f"{c} string" for c in names) + ", action string, is_update boolean, version long"
    row = lambda o, day, action="INSERT", update=False, version=1: (o, "c", "x", day, None, None, None, None, action, update, version)
    day1, day2 = "2020-01-01 10:00:00", "2020-01-02 10:00:00"
    orders = spark.createDataFrame(
        [
            row("1", day1), row("1", day2, version=3), row("1", day1, version=2),  # out of order
            row("2", day1), row("2", day1, "DELETE", True, 2), row("2", day2, "INSERT", True, 2),  # an update
            row("3", day1), row("3", day1, "DELETE", False, 2),  # cancelled
            row(None, day1),
        ],
        text,
    )
    paid = spark.createDataFrame(
        [("1", "1", "card", "1", "5.50", "INSERT", False, 1), ("1", "1", "card", "1", "5.50", "DELETE", True, 2),
         ("1", "1", "card", "1", "6.50", "INSERT", True, 2), ("9", "1", "card", "1", "1", "INSERT", False, 1)],
        ", ".join(f"{c} string" for c in schemas.RAW["payments"].names) + ", action string, is_update boolean, version long",
    )
    found = {r["order_id"]: r for r in ledger.order_states(orders, {"payments": paid}).collect()}
    state = {o: (r["latest"] and (r["latest"]["present"], str(r["latest"]["day"])), r["payment_total"]) for o, r in found.items()}
    assert state["1"][0] == (True, "2020-01-02") and float(state["1"][1]) == 6.5
    assert state["2"][0] == (True, "2020-01-02") and state["3"][0][0] is False
    assert state["9"][0] is None and None not in state
    assert sorted(map(str, found["1"]["days"])) == ["2020-01-01", "2020-01-02"]


def test_tables_of_another_checkpoint_are_refused(spark, tmp_path):
    (tmp_path / "ledger").mkdir()
    empty = spark.readStream.schema(schemas.RAW["orders"]).parquet(str(tmp_path))
    with pytest.raises(ValueError, match="another checkpoint"):
        ledger.stream_ledger(ledger.as_inserts(empty), {}, str(tmp_path / "ledger"), str(tmp_path / "k"), str(tmp_path / "c"))


def test_a_batch_writes_few_files(spark, tmp_path):
    """A period's rows are put together, however many tasks had some of them."""
    given = registered.Tables(spark, SMALL)
    arriving = given.change_stream("orders", [given.order_text.repartition(8)])
    paths = [str(tmp_path / n) for n in ("ledger", "kpis", "state")]
    ledger.stream_ledger(arriving, {}, *paths).awaitTermination()
    for path in paths[:2]:
        files = [len(list(folder.glob("*.parquet"))) for folder in pathlib.Path(path).glob("period=*")]
        assert len(files) > 12 and set(files) == {1}


# --------------------------------------------------------------------------- change feed


def _snapshot(spark, *given):
    return spark.createDataFrame(list(given), "k string, v long")


def test_changes_lead_from_one_snapshot_to_the_other(spark):
    old = _snapshot(spark, ("a", 1), ("a", 1), ("b", None), (None, 3), ("c", 4), ("d", 5))
    new = _snapshot(spark, ("a", 1), ("b", 2), (None, None), (None, None), ("d", 5), ("e", None))
    feed = change_feed(old, new, "k")
    assert rows(apply_changes(old, feed)) == rows(new)
    assert rows(apply_changes(old, feed.limit(0))) == rows(old)
    assert rows(apply_changes(old.limit(0), change_feed(old.limit(0), new, "k"))) == rows(new)
    with pytest.raises(Exception, match="does not hold"):
        apply_changes(new, feed).collect()


def test_a_repeated_batch_applies_once(spark, tmp_path):
    path, schema = str(tmp_path / "table"), session.struct("k string, v long")
    states = [_snapshot(spark, *[(k, i) for k in "abc"[: i + 1]]) for i in range(4)]
    changes.start_table(states[0], path)
    for batch, (old, new) in enumerate(zip(states, states[1:])):
        for _ in range(2):
            changes.apply_batch(change_feed(old, new, "k"), batch, path, schema)
            assert rows(changes.current_table(spark, path, schema)) == rows(new)
    # All rows may go.
    changes.apply_batch(change_feed(states[3], states[3].limit(0), "k"), 3, path, schema)
    assert changes.current_table(spark, path, schema).isEmpty()
    assert session.children(spark, path) == ["as_of=2", "as_of=3", "as_of=start"]


def test_feed_is_read_on_from_its_position(spark, tmp_path):
    feed, path, state = (str(tmp_path / n) for n in ("feed", "table", "state"))
    schema = session.struct("k string, v long")
    old, middle, new = _snapshot(spark, ("a", 1)), _snapshot(spark, ("a", 2)), _snapshot(spark, ("b", 3), ("b", 3))
    changes.start_table(old, path)
    for version, (a, b) in enumerate([(old, middle), (middle, new)]):
        changes.publish(change_feed(a, b, "k"), feed, version)
        changes.follow(changes.read_feed(spark, feed, schema), path, schema, state).awaitTermination()
        assert rows(changes.current_table(spark, path, schema)) == rows(b)
    # Nothing new: nothing happens.
    changes.follow(changes.read_feed(spark, feed, schema), path, schema, state).awaitTermination()
    assert rows(changes.current_table(spark, path, schema)) == rows(new)
    with pytest.raises(ValueError, match="another checkpoint"):
        changes.follow(changes.read_feed(spark, feed, schema), path, schema, str(tmp_path / "other"))


# ---------------------------------------------------------------------------- text stream


def test_text_stream_keeps_rejects_apart(spark, tmp_path):
    source, good, rejects, state = (str(tmp_path / n) for n in ("in", "good", "rejects", "state"))
    (tmp_path / "in").mkdir()
    header = "seller_id,seller_zip_code_prefix,seller_city,seller_state\n"

    def run():
        arriving = order_streams.arriving_text(spark, "sellers", source, files_per_batch=1)
        order_streams.stream_text("sellers", arriving, good, rejects, state).awaitTermination()
        read = spark.read.parquet
        return rows(read(good), "seller_id", "seller_city"), rows(read(rejects), "line", "reason", "file_name", "block_start")

    (tmp_path / "in" / "a.csv").write_text(header + 's1,1,"a, ""b""",SP\nshort\n', encoding="utf-8")
    assert run() == ([("s1", 'a, "b"')], [("short", "too few fields", "a.csv", 0)])
    (tmp_path / "in" / "b.csv").write_text(header + 's2,NULL,,SP\ns3,"1",x,SP,"more, yes"\ns4,"open\n', encoding="utf-8")
    found = run()
    assert found[0] == [("s1", 'a, "b"'), ("s2", None)]
    assert [(line, reason, name) for line, reason, name, _ in found[1]] == [
        ('s3,"1",x,SP,"more, yes"', "too many fields", "b.csv"),
        ('s4,"open', "broken quote", "b.csv"),
        ("short", "too few fields", "a.csv"),
    ]


def test_place_of_a_bad_row_in_a_large_file(spark, tmp_path):
    lines = ["seller_id,seller_zip_code_prefix,seller_city,seller_state"] + [f"s{i},1,city,SP" for i in range(5000)]
    lines[3000] = "broken"
    (tmp_path / "sellers.csv").write_text("\n".join(lines), encoding="utf-8")
    size = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20k")
    try:
        found = rows(csv_tables.rejected_rows(csv_tables.parse_csv(spark, "sellers", str(tmp_path / "sellers.csv")), "sellers"))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
    before = len("\n".join(lines[:3000]))
    assert len(found) == 1 and 0 < found[0][4] <= before < found[0][4] + 2 * 20 * 1024
