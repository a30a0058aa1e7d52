from decimal import Decimal

import pytest

from bazaarlake.operators import quality
from bazaarlake.plans.daily import DailyRun, MissingInput, run_day, user_history
from bazaarlake.sources import files
from bazaarlake.sources.jdbc import hash_predicates, hour_predicates
from bazaarlake.sources.schemas import RAW_COLUMNS, raw_schema


def put(spark, root, table, dt, rows):
    """Raw rows given as dicts; missing columns are NULL."""
    schema = raw_schema(table)
    data = []
    for row in rows:
        data.append(tuple(
            Decimal(row[f.name]) if f.name in row and f.dataType.typeName() == "decimal" else row.get(f.name)
            for f in schema.fields))
    files.write_raw(spark.createDataFrame(data, schema), f"{root}/{table}", dt)


def load_lookups(spark, root, dt, level):
    put(spark, root, "user_info", dt, [{"id": "u1", "user_level": level, "create_time": "2024-01-01"},
                                       {"id": "u2", "user_level": "1", "create_time": "2024-01-01", "email": "NULL"}])
    put(spark, root, "sku_info", dt, [{"id": "s1", "sku_name": "thing", "tm_id": "t1", "category3_id": "c31", "price": "5"}])
    put(spark, root, "base_trademark", dt, [{"tm_id": "t1", "tm_name": "brand"}])
    put(spark, root, "base_category1", dt, [{"id": "c11", "name": "one"}])
    put(spark, root, "base_category2", dt, [{"id": "c21", "name": "two", "category1_id": "c11"}])
    put(spark, root, "base_category3", dt, [{"id": "c31", "name": "three", "category2_id": "c21"}])
    put(spark, root, "base_province", dt, [{"id": "p1", "name": "north", "region_id": "r1"}])
    put(spark, root, "base_region", dt, [{"id": "r1", "region_name": "R"}])


def order(i, user, amount, day, status="1002"):
    return {"id": i, "user_id": user, "province_id": "p1", "total_amount": amount, "order_status": status, "payment_way": "1",
            "create_time": f"{day} 09:30", "operate_time": f"{day} 10:00", "feight_fee": "0", "benefit_reduce_amount": "0"}


def detail(i, oid, day):
    return {"id": i, "order_id": oid, "sku_id": "s1", "order_price": "5", "sku_num": 2, "create_time": f"{day} 09:30"}


UNUSED = ("payment_info", "action_favor_add", "action_cart_add")
NO_EVENTS = (*UNUSED, "order_refund_info", "action_page_view", "action_order")


@pytest.fixture(scope="module")
def warehouse(spark, tmp_path_factory):
    raw, root = str(tmp_path_factory.mktemp("raw")), str(tmp_path_factory.mktemp("wh"))
    d1, d2 = "2024-01-21", "2024-01-22"
    load_lookups(spark, raw, d1, "1")
    load_lookups(spark, raw, d2, "2")
    put(spark, raw, "order_info", d1, [order("o1", "u1", "10", d1), order("o2", "u2", "20", d1, "1001")])
    put(spark, raw, "order_detail", d1, [detail("d1", "o1", d1), detail("d2", "o2", d1)])
    # a full export: the first day's rows come again
    put(spark, raw, "order_info", d2, [order("o1", "u1", "10", d1, "1004"), order("o3", "u1", "10", d2)])
    put(spark, raw, "order_detail", d2, [detail("d1", "o1", d1), detail("d3", "o3", d2)])
    put(spark, raw, "order_refund_info", d2, [{"id": "r1", "order_id": "o3", "sku_id": "s1", "refund_num": 1, "refund_amount": "4", "create_time": f"{d2} 11:00"}])
    put(spark, raw, "action_page_view", d2, [{"user_id": "u1", "sku_id": "s1", "page_id": "x", "action_time": f"{d2} 08:00"}])
    put(spark, raw, "action_order", d2, [{"user_id": "u1", "sku_id": "s1", "order_id": "o3", "order_detail_id": "d3", "create_time": f"{d2} 09:30"}])
    run_day(spark, raw, root, d1, first_day=True, not_delivered=NO_EVENTS)
    run_day(spark, raw, root, d2, not_delivered=UNUSED)
    return raw, root, d1, d2


def test_reports_after_two_days(spark, warehouse, rows):
    _, root, _, d2 = warehouse
    gmv = files.read_partition(spark, f"{root}/ads/ads_gmv_day", d2)
    assert rows(gmv, "recent_days", "gmv", "order_count", "order_user_count", "net_sales_amount") == [
        (1, Decimal("10.00"), 1, 1, Decimal("6.00")), (30, Decimal("40.00"), 3, 2, Decimal("16.00")), (7, Decimal("40.00"), 3, 2, Decimal("16.00"))]
    rank = files.read_partition(spark, f"{root}/ads/ads_sku_sales_rank", d2).where("recent_days = 7")
    assert rows(rank, "sku_id", "order_amount", "payment_amount", "refund_amount", "rank") == [
        ("s1", Decimal("30.00"), Decimal("20.00"), Decimal("4.00"), 1)]
    back = files.read_partition(spark, f"{root}/ads/ads_user_retention", d2)
    assert rows(back, "cohort_day", "retention_day", "new_user_count", "retention_count", "active_user_count") == [
        ("2024-01-21", 1, 2, 1, 1)]
    trend = files.read_partition(spark, f"{root}/ads/ads_gmv_trend", d2)
    assert rows(trend, "gmv", "gmv_dod_rate", "gmv_yoy_rate") == [(Decimal("10.00"), -66.67, None)]
    funnel = files.read_partition(spark, f"{root}/ads/ads_conversion_rate", d2).where("recent_days = 1")
    assert rows(funnel, "visit_count", "order_count", "payment_count") == [(1, 1, 1)]


def test_reports_of_daily_tables_read_no_fact(spark, warehouse, rows):
    raw, root, d1, d2 = warehouse
    reports = DailyRun(spark, raw, root, d2).reports()
    for name in ("ads_gmv_day", "ads_user_repurchase_rate", "ads_user_activity", "ads_user_retention"):
        files_read = reports[name]().inputFiles()
        assert files_read and not any("/dwd/" in f for f in files_read)
    numbers = files.read_table(spark, f"{root}/dim/dim_buyer_number")
    assert rows(numbers, "user_id", "number", "dt") == [("u1", 0, d1), ("u2", 1, d1)]


def test_zipper_and_snapshot_continue(spark, warehouse, rows):
    _, root, d1, d2 = warehouse
    users = user_history(spark, root, d2)
    assert rows(users, "id", "user_level", "start_date", "end_date") == [
        ("u1", "1", d1, d1), ("u1", "2", d2, "9999-12-31"), ("u2", "1", d1, "9999-12-31")]
    assert [r["email"] for r in users.where("id = 'u2'").collect()] == [None]
    snapshot = files.read_partition(spark, f"{root}/dim/dim_order_accumulate_snapshot", d2)
    assert rows(snapshot, "order_id", "order_status", "finish_time") == [
        ("o1", "COMPLETED", f"{d1} 10:00"), ("o2", "UNPAID", None), ("o3", "PAID", None)]


def test_rerun_of_a_day_is_idempotent(spark, warehouse, rows):
    raw, root, _, d2 = warehouse
    tables = ("dim/dim_user_scd1", "dwd/dwd_order_detail", "dws/dws_sku_stats", "ads/ads_gmv_day", "ads/ads_user_retention")
    before = {t: rows(files.read_partition(spark, f"{root}/{t}", d2)) for t in tables}
    users = rows(user_history(spark, root, d2))
    run_day(spark, raw, root, d2, not_delivered=UNUSED)
    assert users == rows(user_history(spark, root, d2))
    assert before == {t: rows(files.read_partition(spark, f"{root}/{t}", d2)) for t in tables}


def test_partition_listing_pruning_and_expiry(spark, warehouse, rows):
    _, root, d1, d2 = warehouse
    found = quality.list_partitions(spark, {"dwd_order_info": f"{root}/dwd/dwd_order_info"})
    assert rows(found) == [("dwd_order_info", d1), ("dwd_order_info", d2)]
    assert rows(quality.expired_partitions(found, "2024-01-29")) == [("dwd_order_info", d1)]
    one = files.read_table(spark, f"{root}/dwd/dwd_order_info", d2, d2)
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(dt" in plan
    assert one.count() == 1


def test_dynamic_overwrite_touches_only_its_days(spark, tmp_path, rows):
    path = str(tmp_path / "t")
    files.write_partitions(spark.createDataFrame([("a", "2024-01-01"), ("b", "2024-01-02")], "x string, dt string"), path)
    files.write_partitions(spark.createDataFrame([("c", "2024-01-02")], "x string, dt string"), path)
    assert rows(files.read_table(spark, path), "x", "dt") == [("a", "2024-01-01"), ("c", "2024-01-02")]


def test_gate_fails_an_empty_day(spark):
    counts = quality.layer_row_counts({"a": spark.range(3), "b": spark.range(0)})
    with pytest.raises(quality.QualityError, match="b"):
        quality.assert_quality(quality.quality_gate(counts, {}))
    quality.assert_quality(quality.quality_gate(counts, {"b": 0}))


def test_external_table_partitions_are_attached(spark, warehouse, rows):
    _, root, d1, d2 = warehouse
    path = f"{root}/dws/dws_gmv_stats"
    spark.sql("DROP TABLE IF EXISTS gmv_ext")
    spark.sql(f"CREATE TABLE gmv_ext (date_id STRING, gmv DECIMAL(26,2), dt STRING) USING orc PARTITIONED BY (dt) LOCATION '{path}'")
    files.attach_partitions(spark, "gmv_ext")
    assert rows(spark.table("gmv_ext"), "dt") == [(d1,), (d2,)]
    spark.sql("DROP TABLE gmv_ext")


def test_gzip_ingest_clickstream_and_products(spark, tmp_path, rows):
    files.write_raw(spark.createDataFrame([("1", "a", None)], "id string, name string, create_time string"), str(tmp_path / "g"), "d", "gzip")
    assert list((tmp_path / "g" / "dt=d").glob("*.txt.gz"))
    got = files.read_raw(spark, str(tmp_path / "g"), raw_schema("base_category1"), "d")
    assert rows(got, "id", "name", "create_time") == [("1", "a", None)]
    (tmp_path / "log.csv").write_text("2025-06-15 10:00:00,u,ip,a,p\nx,\n")
    assert [r["line"] for r in files.read_clickstream(spark, str(tmp_path / "log.csv")).orderBy("line_id").collect()] == [
        "2025-06-15 10:00:00,u,ip,a,p", "x,"]
    (tmp_path / "p.csv").write_text("p1,n,12,c\n")
    assert rows(files.read_products(spark, str(tmp_path / "p.csv"))) == [("p1", "n", 12, "c")]


def test_schemas_and_jdbc_slices():
    assert len(RAW_COLUMNS) == 26
    assert raw_schema("order_detail")["order_price"].dataType.simpleString() == "decimal(16,2)"
    slices = hour_predicates("create_time", "2024-02-29", 12)
    assert slices == [
        "create_time >= '2024-02-29' AND create_time < '2024-02-29 12:00'",
        "create_time >= '2024-02-29 12:00' AND create_time < '2024-03-01'"]
    assert hash_predicates("id", 2) == ["MOD(CRC32(id), 2) = 0 OR id IS NULL", "MOD(CRC32(id), 2) = 1"]
    # Text times of the minute after midnight belong to the new day, whatever their length.
    for time in ("2024-02-29 00:00", "2024-02-29 00:00:00"):
        assert "2024-02-29" <= time < "2024-02-29 12:00"


def test_ingest_counts_rows_and_replaces_a_rerun(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = [("1", "a\tb \"q\"", None), ("2", "", "x")]
    df = spark.createDataFrame(rows, "id string, name string, create_time string")
    assert files.ingest(df, path, "2024-01-01") == 2
    assert files.ingest(df.limit(1), path, "2024-01-01") == 1


def test_ingest_fails_on_another_width(spark, tmp_path, monkeypatch):
    df = spark.createDataFrame([("1", "a\tb"), ("2", "c")], "id string, name string")
    monkeypatch.setattr(files, "ESCAPES", files.ESCAPES[:1])
    with pytest.raises(files.IngestError, match="1 of another width"):
        files.ingest(df, str(tmp_path / "t"), "2024-01-02")


def test_raw_text_comes_back_as_it_was(spark, tmp_path, rows):
    texts = ["a\tb \"q\"", 'say "hi"', "", None, "two\nlines", "\r\n", "\\", "\\t", "\\\\n", "\\\t", "\\N", "x\\", "\\\\\\N", "é \u2028", " "]
    data = [(str(i), t, "2024-01-02 00:00") for i, t in enumerate(texts)]
    df = spark.createDataFrame(data, "id string, name string, create_time string")
    assert files.ingest(df, str(tmp_path / "t"), "2024-01-02") == len(texts)
    got = files.read_raw(spark, str(tmp_path / "t"), df.schema, "2024-01-02")
    assert {r["id"]: (r["name"], r["create_time"]) for r in got.collect()} == {i: (t, c) for i, t, c in data}
    assert files.read_raw(spark, str(tmp_path / "t"), df.schema).count() == len(texts)
    numbers = spark.createDataFrame([("1", Decimal("1.50"), 3), ("2", None, None)], "id string, price decimal(16,2), n int")
    files.write_raw(numbers, str(tmp_path / "n"), "d")
    assert rows(files.read_raw(spark, str(tmp_path / "n"), numbers.schema, "d"), "id", "price", "n") == [
        ("1", Decimal("1.50"), 3), ("2", None, None)]


@pytest.fixture(scope="module")
def late(spark, tmp_path_factory):
    """o1 is paid a day later, o2 gets a line and a refund a day later, o4 of day 1 is delivered on day 2."""
    raw, root = str(tmp_path_factory.mktemp("raw")), str(tmp_path_factory.mktemp("wh"))
    d1, d2 = "2024-01-21", "2024-01-22"
    for d in (d1, d2):
        load_lookups(spark, raw, d, "1")
    put(spark, raw, "order_info", d1, [order("o1", "u1", "10", d1, "1001"), order("o2", "u2", "10", d1, "1002")])
    put(spark, raw, "order_detail", d1, [detail("d1", "o1", d1), detail("d2", "o2", d1)])
    put(spark, raw, "order_info", d2, [order("o1", "u1", "10", d1, "1002"), order("o3", "u1", "10", d2), order("o4", "u2", "30", d1)])
    put(spark, raw, "order_detail", d2, [detail("d3", "o3", d2), detail("d4", "o2", d2), detail("d5", "nobody", d2)])
    put(spark, raw, "order_refund_info", d2, [{"id": "r1", "order_id": "o2", "sku_id": "s1", "refund_num": 1, "refund_amount": "4", "create_time": f"{d2} 00:00"}])
    put(spark, raw, "payment_info", d2, [{"id": "p1", "order_id": "o1", "total_amount": "10", "create_time": f"{d2} 01:00"}])
    skip = ("action_page_view", "action_favor_add", "action_cart_add", "action_order")
    run_day(spark, raw, root, d1, first_day=True, not_delivered=(*skip, "order_refund_info", "payment_info"))
    run_day(spark, raw, root, d2, not_delivered=skip)
    return raw, root, d1, d2, skip


def test_late_lines_refunds_and_payments_have_their_order(spark, late, rows):
    _, root, d1, d2, _ = late
    lines = files.read_partition(spark, f"{root}/dwd/dwd_order_detail", d2)
    assert rows(lines, "id", "user_id", "province_id", "is_paid", "date_id") == [
        ("d3", "u1", "p1", 1, d2), ("d4", "u2", "p1", 1, d2), ("d5", None, None, 0, d2)]
    refunds = files.read_partition(spark, f"{root}/dwd/dwd_order_refund", d2)
    assert rows(refunds, "id", "user_id", "province_id", "date_id") == [("r1", "u2", "p1", d2)]
    payments = files.read_partition(spark, f"{root}/dwd/dwd_payment_info", d2)
    assert rows(payments, "id", "user_id", "province_id") == [("p1", "u1", "p1")]


def test_changed_and_late_orders_reach_their_day(spark, late, rows):
    _, root, d1, d2, _ = late
    orders = files.read_partition(spark, f"{root}/dwd/dwd_order_info", d1)
    assert rows(orders, "id", "order_status", "is_paid", "user_level") == [
        ("o1", "1002", 1, "1"), ("o2", "1002", 1, "1"), ("o4", "1002", 1, "1")]
    lines = files.read_partition(spark, f"{root}/dwd/dwd_order_detail", d1)
    assert rows(lines, "id", "is_paid", "user_id") == [("d1", 1, "u1"), ("d2", 1, "u2")]
    gmv = files.read_partition(spark, f"{root}/dws/dws_gmv_stats", d1)
    assert rows(gmv, "gmv", "paid_gmv") == [(Decimal("50.00"), Decimal("50.00"))]
    rank = files.read_partition(spark, f"{root}/ads/ads_sku_sales_rank", d2).where("recent_days = 30")
    assert rows(rank, "order_amount", "payment_amount") == [(Decimal("50.00"), Decimal("40.00"))]


def test_a_rerun_with_late_rows_changes_nothing(spark, late, rows):
    raw, root, d1, d2, skip = late
    tables = [(t, d) for t in ("dwd/dwd_order_info", "dwd/dwd_order_detail", "dws/dws_gmv_stats", "dws/dws_sku_stats") for d in (d1, d2)]
    before = [rows(files.read_partition(spark, f"{root}/{t}", d)) for t, d in tables]
    run_day(spark, raw, root, d2, not_delivered=skip)
    assert before == [rows(files.read_partition(spark, f"{root}/{t}", d)) for t, d in tables]


def test_missing_days_and_feeds_stop_the_run(spark, late):
    raw, root, _, d2, skip = late
    d4 = "2024-01-24"
    load_lookups(spark, raw, d4, "1")
    with pytest.raises(MissingInput, match="2024-01-23"):
        run_day(spark, raw, root, d4, not_delivered=skip)
    with pytest.raises(MissingInput, match="action_page_view"):
        run_day(spark, raw, root, d2)
