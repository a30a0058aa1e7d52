"""Facts that are delivered after their day, repeated, or ahead of it."""

from decimal import Decimal

import pytest

from bazaarlake.operators import quality
from bazaarlake.plans.daily import DailyRun, run_day
from bazaarlake.sources import files
from bazaarlake.sources.arrivals import event_day, keyed
from bazaarlake.sources.schemas import raw_schema
from pyspark.sql import functions as F
from test_daily import load_lookups, order, put

D0, D1, D2, D3 = "2024-01-20", "2024-01-21", "2024-01-22", "2024-01-23"


def line(i, oid, time, n=2):
    return {"id": i, "order_id": oid, "sku_id": "s1", "order_price": "5", "sku_num": n, "create_time": time}


def refund(i, oid, time):
    return {"id": i, "order_id": oid, "sku_id": "s1", "refund_num": 1, "refund_amount": "4", "create_time": time}


def paid(i, oid, time):
    return {"id": i, "order_id": oid, "total_amount": "10", "create_time": time}


def view(user, time):
    return {"user_id": user, "sku_id": "s1", "page_id": "x", "session_id": "s", "action_time": time}


def run_facts(spark, raw, root, day, first_day=False):
    """A day's run up to its aggregates."""
    run = DailyRun(spark, raw, root, day, first_day, not_delivered=SKIP)
    run.run_dim()
    run.run_dwd()
    run.run_dws()


SKIP = ("action_favor_add", "action_cart_add", "action_order")
TABLES = [(f"dwd/{t}", d) for t in ("dwd_order_info", "dwd_order_detail", "dwd_payment_info", "dwd_order_refund", "dwd_action") for d in (D1, D2)]
TABLES += [(f"dws/{t}", d) for t in ("dws_sku_stats", "dws_user_action_stats", "dws_order_day") for d in (D1, D2)] + [("ads/ads_gmv_day", D2)]


@pytest.fixture(scope="module")
def late(spark, tmp_path_factory):
    raw, root = str(tmp_path_factory.mktemp("raw")), str(tmp_path_factory.mktemp("wh"))
    for d in (D1, D2, D3):
        load_lookups(spark, raw, d, "1")
    eve = f"{D1} 23:59"
    orders = [order("o1", "u1", "10", D1)]
    put(spark, raw, "order_info", D1, orders)
    put(spark, raw, "order_detail", D1, [line("d1", "o1", f"{D1} 09:30"), line("f1", "o3", f"{D2} 00:10")])  # f1 is ahead of its day
    put(spark, raw, "payment_info", D1, [paid("p1", "o1", f"{D1} 09:31")])
    put(spark, raw, "order_refund_info", D1, [])
    put(spark, raw, "action_page_view", D1, [view("u1", f"{D1} 08:00"), view("u1", f"{D1} 08:00")])
    run_facts(spark, raw, root, D1, first_day=True)
    first = {t: [tuple(r) for r in files.read_partition(spark, f"{root}/{t}", D1).collect()] for t, d in TABLES if d == D1}
    # A full export of lines and payments, increments of the rest; late rows of the day before in all of them.
    put(spark, raw, "order_info", D2, [*orders, order("o2", "u2", "20", D1), order("o3", "u1", "10", D2)])
    put(spark, raw, "order_detail", D2, [line("d1", "o1", f"{D1} 09:30"), line("d2", "o2", eve), line("d9", "o1", eve, 1),
                                         line("d3", "o3", f"{D2} 09:30"), line("d3", "o3", f"{D2} 09:30")])
    put(spark, raw, "payment_info", D2, [paid("p1", "o1", f"{D1} 09:31"), paid("p2", "o2", eve), paid("p0", "o0", f"{D0} 10:00")])
    put(spark, raw, "order_refund_info", D2, [refund("r1", "o1", eve), {**refund("r2", "o1", None)}])
    put(spark, raw, "action_page_view", D2, [view("u1", f"{D1} 08:00"), view("u1", f"{D1} 08:00"), view("u1", f"{D1} 08:00"), view("u2", eve),
                                             view("u2", f"{D2} 08:00")])
    run_day(spark, raw, root, D2, not_delivered=SKIP)
    return raw, root, first


def read(spark, root, table, day):
    return files.read_partition(spark, f"{root}/{table}", day)


def test_late_rows_land_on_their_day(spark, late, rows):
    _, root, first = late
    lines = read(spark, root, "dwd/dwd_order_detail", D1)
    assert rows(lines, "id", "user_id", "is_paid", "order_amount", "arrived_on") == [
        ("d1", "u1", 1, Decimal("10.00"), D1), ("d2", "u2", 1, Decimal("10.00"), D2), ("d9", "u1", 1, Decimal("5.00"), D2)]
    assert rows(read(spark, root, "dwd/dwd_order_detail", D2), "id", "user_id", "arrived_on") == [("d3", "u1", D2), ("f1", "u1", D1)]
    assert rows(read(spark, root, "dwd/dwd_payment_info", D1), "id", "user_id", "province_id") == [("p1", "u1", "p1"), ("p2", "u2", "p1")]
    assert rows(read(spark, root, "dwd/dwd_payment_info", D0), "id", "user_id") == [("p0", None)]
    assert rows(read(spark, root, "dwd/dwd_order_refund", D1), "id", "user_id") == [("r1", "u1")]
    # Of three equal views two were known.
    assert rows(read(spark, root, "dwd/dwd_action", D1), "user_id", "action_time", "arrived_on") == [
        ("u1", f"{D1} 08:00", D1), ("u1", f"{D1} 08:00", D1), ("u1", f"{D1} 08:00", D2), ("u2", f"{D1} 23:59", D2)]
    assert rows(read(spark, root, "dwd/dwd_action", D2), "user_id") == [("u2",)]
    assert len(first["dwd/dwd_action"]) == 2 and len(first["dwd/dwd_order_detail"]) == 1


def test_aggregates_of_the_day_follow(spark, late, rows):
    _, root, _ = late
    sku = read(spark, root, "dws/dws_sku_stats", D1)
    assert rows(sku, "sku_id", "date_id", "order_count", "order_amount", "refund_amount") == [("s1", D1, 2, Decimal("25.00"), Decimal("4.00"))]
    day = read(spark, root, "dws/dws_order_day", D1)
    assert rows(day, "order_count", "order_amount", "refund_amount") == [(2, Decimal("30.00"), Decimal("4.00"))]
    gmv = read(spark, root, "ads/ads_gmv_day", D2).where("recent_days = 7")
    assert rows(gmv, "gmv", "order_count", "net_sales_amount") == [(Decimal("40.00"), 3, Decimal("36.00"))]


def test_rerun_changes_nothing_and_a_shorter_feed_takes_rows_back(spark, late, rows, tmp_path):
    raw, root, _ = late
    before = {(t, d): rows(read(spark, root, t, d)) for t, d in TABLES}
    short = str(tmp_path / "raw")
    load_lookups(spark, short, D2, "1")
    for feed in ("order_info", "order_refund_info", "action_page_view"):
        files.write_raw(files.read_raw(spark, f"{raw}/{feed}", raw_schema(feed), D2).drop("dt"), f"{short}/{feed}", D2)
    put(spark, short, "order_detail", D2, [line("d3", "o3", f"{D2} 09:30")])
    put(spark, short, "payment_info", D2, [])
    run_facts(spark, short, root, D2)
    assert rows(read(spark, root, "dwd/dwd_order_detail", D1), "id") == [("d1",)]
    assert rows(read(spark, root, "dwd/dwd_payment_info", D0), "id") == []
    assert rows(read(spark, root, "dwd/dwd_payment_info", D1), "id") == [("p1",)]
    assert rows(read(spark, root, "dws/dws_sku_stats", D1), "order_count", "order_amount") == [(1, Decimal("10.00"))]
    run_facts(spark, raw, root, D2)
    assert before == {(t, d): rows(read(spark, root, t, d)) for t, d in TABLES}


def test_rows_without_a_day_are_kept_apart(spark, late, rows):
    _, root, _ = late
    rejected = spark.read.orc(f"{root}/arrivals/order_refund_info_rejected")
    assert rows(rejected, "id", "reason", "seen") == [("r2", "create_time is no day", D2)]


def test_known_days_are_not_read(spark, late):
    raw, root, _ = late
    run = DailyRun(spark, raw, root, D3)
    ledger = run.ledger("order_detail")
    export = files.read_raw(spark, f"{raw}/order_detail", raw_schema("order_detail"), D2).drop("dt").distinct()
    whole = export.unionByName(files.read_raw(spark, f"{raw}/order_detail", raw_schema("order_detail"), D1).drop("dt").distinct()).distinct()
    new, days, _ = ledger.unseen(whole, D3, "create_time")
    assert days == [] and new.count() == 0
    plus = whole.unionByName(spark.createDataFrame([("z", "o1", f"{D2} 12:00")], "id string, order_id string, create_time string"), allowMissingColumns=True)
    new, days, _ = ledger.unseen(plus, D3, "create_time")
    assert days == [D2] and [r["id"] for r in new.collect()] == ["z"]
    plan = new._jdf.queryExecution().executedPlan().toString()
    filters = [part for part in plan.split("PartitionFilters: [")[1:] if "seen#" in part[:200]]
    assert filters and all(f"= {D2})" in part.split("]")[0] and D1 not in part.split("]")[0] for part in filters)


def test_gate_stops_on_facts_that_are_missing(spark, late, tmp_path):
    raw, root, _ = late
    run = DailyRun(spark, raw, root, D2, not_delivered=SKIP)
    run.late = {feed: [D0, D1] for feed in ("order_detail", "payment_info", "order_refund_info", "action_page_view", *SKIP)}
    run.written = ["dwd/dwd_order_detail"]
    quality.assert_quality(run.check())
    path = f"{root}/dwd/dwd_payment_info"
    stored = [tuple(r) for r in files.read_partition(spark, path, D1).drop("dt").collect()]
    schema = files.read_partition(spark, path, D1).drop("dt").schema
    files.write_partition(spark.createDataFrame(stored[:0], schema), path, D1)
    with pytest.raises(quality.QualityError, match="dwd/dwd_payment_info"):
        quality.assert_quality(run.check())
    files.write_partition(spark.createDataFrame(stored, schema), path, D1)


def test_keys_and_days(spark):
    df = spark.createDataFrame([("1", "2024-01-15 09:30"), ("", "x"), (None, "2024-02-30"), (None, None)], "id string, create_time string")
    got = keyed(df).withColumn("day", event_day("create_time")).collect()
    assert [r["day"] for r in got] == ["2024-01-15", None, None, None]
    assert got[0]["event_key"] == "1" and len({r["event_key"] for r in got}) == 4
    pair = spark.createDataFrame([("a", None), (None, "a"), ("a", None)], "x string, y string")
    assert [r["n"] for r in keyed(pair).groupBy("event_key").agg(F.count("*").alias("n")).orderBy("n").collect()] == [1, 2]
