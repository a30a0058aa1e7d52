from decimal import Decimal

import pytest

from bazaarlake.functions.common import expand_recent_days, growth, last_year, pct
from bazaarlake.operators import ads, batch, dws
from pyspark.sql import functions as F

ORDER = (
    "id string, user_id string, total_amount decimal(16,2), goods_amount decimal(16,2), feight_fee decimal(16,2), "
    "benefit_reduce_amount decimal(16,2), order_status_name string, is_paid int, date_id string"
)
LINE = "order_id string, user_id string, sku_id string, sku_num bigint, order_amount decimal(16,2), is_paid int, date_id string"


def orders(spark, *items):
    return spark.createDataFrame(
        [(i, u, Decimal(a), Decimal(a), Decimal(0), Decimal(0), s, int(s in ("PAID", "COMPLETED")), d)
         for i, u, a, s, d in items],
        ORDER,
    )


def lines(spark, *items):
    return spark.createDataFrame([(o, u, s, n, Decimal(a), p, d) for o, u, s, n, a, p, d in items], LINE)


def test_recent_days_bounds(spark, rows):
    days = ["2024-01-30", "2024-01-24", "2024-01-23", "2024-01-01", "2023-12-31", "2024-01-31"]
    df = spark.createDataFrame([(d,) for d in days], "d string")
    got = rows(expand_recent_days(df, "d", "2024-01-30"), "d", "recent_days")
    assert got == [
        ("2024-01-01", 30), ("2024-01-23", 30), ("2024-01-24", 30), ("2024-01-24", 7),
        ("2024-01-30", 1), ("2024-01-30", 30), ("2024-01-30", 7),
    ]


def test_ratios_round_half_up_and_survive_zero(spark):
    row = spark.range(1).select(
        pct(F.lit(1), F.lit(0)), pct(F.lit(107), F.lit(4000)), growth(F.lit(5), F.lit(0)), growth(F.lit(5), F.lit(10))
    ).first()
    assert tuple(row) == (None, 2.68, None, -50.0)
    assert last_year("2024-02-29") == "2023-02-28"


def test_gmv_day_counts_buyers_once(spark, rows):
    df = orders(spark, ("1", "u", "10", "PAID", "2024-01-30"), ("2", "u", "20", "UNPAID", "2024-01-29"),
                ("3", "v", "5", "COMPLETED", "2024-01-02"), ("4", "w", "99", "PAID", "2023-12-01"))
    got = ads.ads_gmv_day(df, "2024-01-30")
    assert rows(got, "recent_days", "gmv", "order_count", "order_user_count", "order_user_days", "payment_count", "completed_count") == [
        (1, Decimal("10.00"), 1, 1, 1, 1, 0),
        (30, Decimal("35.00"), 3, 2, 3, 2, 1),
        (7, Decimal("30.00"), 2, 1, 2, 1, 0),
    ]


def test_gmv_day_net_of_refunds(spark, rows):
    df = orders(spark, ("1", "u", "10", "PAID", "2024-01-30"))
    refunds = spark.createDataFrame([("1", Decimal("4"), "2024-01-30"), ("1", Decimal("1"), "2024-01-30")],
                                    "order_id string, refund_amount decimal(16,2), date_id string")
    got = ads.ads_gmv_day(df, "2024-01-30", refunds)
    assert rows(got, "recent_days", "refund_count", "net_sales_amount") == [
        (1, 1, Decimal("5.00")), (30, 1, Decimal("5.00")), (7, 1, Decimal("5.00"))]


def test_retention_denominator_and_unobserved_days(spark, rows):
    acts = [("a", "2024-01-01"), ("a", "2024-01-02"), ("b", "2024-01-01"), ("c", "2024-01-08"), ("a", "2024-01-08")]
    df = spark.createDataFrame(acts + acts[:1], "user_id string, date_id string")
    got = ads.ads_user_retention(df, "2024-01-08", offsets=(1, 7))
    assert rows(got) == [("2024-01-01", 1, 2, 1, 50.0, 1), ("2024-01-01", 7, 2, 1, 50.0, 2)]
    wide = ads.ads_user_retention_detail(df, "2024-01-08", offsets=(1, 3))
    assert rows(wide, "cohort_day", "total_new_users", "day_1_retention", "day_3_retention", "day_1_rate") == [
        ("2024-01-01", 2, 1, 0, 50.0), ("2024-01-08", 1, None, None, None)]
    per_user = dws.dws_user_retention_day(df)
    assert rows(per_user, "user_id", "retention_day") == [("a", 1), ("a", 7)]
    firsts = dws.first_days(df)
    columns = wide.columns
    assert rows(ads.ads_user_retention_detail(df, "2024-01-08", (1, 3), firsts=firsts), *columns) == rows(wide, *columns)
    since = dws.dws_user_retention_day(df.where("date_id >= '2024-01-05'"), firsts=firsts)
    assert rows(since, "user_id", "retention_day") == [("a", 7)]


def test_repurchase_ignores_a_second_line_of_one_order(spark, rows):
    df = lines(spark, ("o1", "u", "s", 1, "10", 1, "2024-01-01"), ("o1", "u", "s", 1, "5", 1, "2024-01-01"),
               ("o2", "u", "s", 1, "7", 1, "2024-01-02"), ("o3", "v", "s", 1, "1", 1, "2024-01-02"))
    got = ads.ads_sku_repurchase_analysis(df)
    assert rows(got, "total_order_count", "repurchase_order_count", "repurchase_user_count", "total_user_count",
                "repurchase_rate", "avg_repurchase_times", "repurchase_amount") == [
        (3, 1, 1, 2, 50.0, 1.5, Decimal("7.00"))]
    none = ads.ads_sku_repurchase_analysis(df, "2024-02-02")
    assert rows(none) == []


def test_repurchase_rate_by_user(spark, rows):
    df = orders(spark, ("1", "u", "1", "PAID", "2024-01-30"), ("2", "u", "1", "PAID", "2024-01-29"),
                ("3", "v", "1", "PAID", "2024-01-30"), ("4", "v", "1", "PAID", "2024-01-05"))
    assert rows(ads.ads_user_repurchase_rate(df, "2024-01-30")) == [(30, 2, 2, 100.0, 2.0, 2), (7, 2, 1, 50.0, 1.5, 2)]


def test_sku_stats_counts_distinct_paid_orders(spark, rows):
    df = lines(spark, ("o1", "u", "s", 2, "10", 1, "d"), ("o1", "u", "s", 1, "5", 1, "d"), ("o2", "u", "s", 1, "7", 0, "d"))
    refunds = spark.createDataFrame([("s", 1, Decimal("5"), "d")], "sku_id string, refund_num bigint, refund_amount decimal(16,2), date_id string")
    got = dws.dws_sku_stats(df, refunds)
    assert rows(got, "order_count", "order_num", "order_amount", "payment_count", "payment_num", "payment_amount", "refund_count", "refund_amount") == [
        (2, 4, Decimal("22.00"), 1, 3, Decimal("15.00"), 1, Decimal("5.00"))]


def test_user_action_stats_merges_all_branches(spark, rows):
    acts = spark.createDataFrame([("u", "s", "page_view", "d"), ("u", "s", "page_view", "d"), ("u", "s", "cart_add", "d"), ("v", "t", "favor_add", "d")],
                                 "user_id string, sku_id string, action_code string, date_id string")
    df = lines(spark, ("o1", "u", "s", 2, "10", 1, "d"), ("o2", "w", "s", 1, "7", 0, "d"))
    refunds = spark.createDataFrame([("u", "s", 1, Decimal("5"), "d")],
                                    "user_id string, sku_id string, refund_num bigint, refund_amount decimal(16,2), date_id string")
    got = dws.dws_user_action_stats(acts, df, refunds)
    assert rows(got, "user_id", "page_view_count", "cart_add_count", "favor_add_count", "order_count", "payment_count", "payment_amount", "refund_amount") == [
        ("u", 2, 1, 0, 1, 1, Decimal("10.00"), Decimal("5.00")),
        ("v", 0, 0, 1, 0, 0, Decimal("0.00"), Decimal("0.00")),
        ("w", 0, 0, 0, 1, 0, Decimal("0.00"), Decimal("0.00")),
    ]


def test_rank_ties_and_order(spark, rows):
    df = lines(spark, ("o1", "u", "b", 1, "10", 1, "2024-01-30"), ("o2", "u", "a", 5, "10", 1, "2024-01-30"), ("o3", "u", "c", 9, "90", 1, "2024-01-30"))
    got = ads.ads_sku_sales_rank(df, "2024-01-30").where("recent_days = 7")
    assert rows(got, "sku_id", "rank", "sales_rank") == [("a", 2, 2), ("b", 3, 3), ("c", 1, 1)]
    assert rows(ads.ads_sku_sales_rank_top100(df, "2024-01-30", n=2), "sku_id", "rank") == [("a", 2), ("c", 1)]


def test_favorite_period_prefers_the_earlier(spark, rows):
    acts = spark.createDataFrame(
        [("u", "order", "2024-01-01 06:59:00"), ("u", "order", "2024-01-01 19:00:00"), ("v", "order", "2024-01-01 12:30:00"),
         ("v", "order", "2024-01-01 13:00:00"), ("v", "order", "2024-01-01 18:00:00"), ("w", "page_view", "2024-01-01 01:00:00")],
        "user_id string, action_code string, action_time string",
    ).withColumn("action_time", F.col("action_time").cast("timestamp"))
    assert rows(dws.user_favorite_period(acts)) == [("u", "dawn"), ("v", "afternoon")]


def test_sessions_split_after_the_gap_only(spark, rows):
    times = ["10:00:00", "10:00:30", "10:30:30", "11:00:31", "12:00:00"]
    df = spark.createDataFrame([("u", f"2024-01-01 {t}") for t in times], "user_id string, ts string").withColumn(
        "ts", F.col("ts").cast("timestamp"))
    got = dws.user_sessions(df, "ts")
    assert rows(got, "views", "duration_sec") == [(1, 0.0), (1, 0.0), (3, 1830.0)]
    day = dws.dws_page_view_day(df, "ts")
    assert rows(day, "hour_id", "view_count", "session_count", "bounce_rate", "avg_duration_sec") == [
        (10, 3, 1, 0.0, 1830), (11, 1, 1, 100.0, 0), (12, 1, 1, 100.0, 0)]
    with pytest.raises(ValueError):
        dws.user_sessions(df, "ts", 59)


def test_growth_without_a_base_is_null(spark, rows):
    df = orders(spark, ("1", "u", "10", "PAID", "2024-01-30"), ("2", "u", "8", "PAID", "2023-01-30"))
    got = ads.ads_gmv_trend(df, "2024-01-30")
    assert rows(got, "gmv", "gmv_dod_rate", "gmv_yoy_rate") == [(Decimal("10.00"), None, 25.0)]
    series = ads.ads_gmv_trend_series(df)
    assert rows(series, "date_id", "prev_gmv") == [("2023-01-30", None), ("2024-01-30", None)]


def test_funnel_with_empty_steps(spark, rows):
    acts = spark.createDataFrame([("u", "page_view", "2024-01-30", 0), ("u", "page_view", "2024-01-30", 0), ("v", "order", "2024-01-30", 1)],
                                 "user_id string, action_code string, date_id string, is_paid int")
    got = ads.ads_conversion_rate(acts, "2024-01-30").where("recent_days = 1")
    assert rows(got, "visit_count", "cart_count", "order_count", "visit_to_cart_rate", "cart_to_order_rate", "total_conversion_rate") == [
        (2, 0, 1, 0.0, None, 50.0)]
    users = ads.ads_conversion_funnel(acts, "2024-01-30").where("recent_days = 1")
    assert rows(users, "step1_count", "step4_count", "step5_count", "total_conversion_rate") == [(1, 1, 1, 100.0)]


def test_refund_analysis_top_category_and_json(spark, rows):
    refunds = spark.createDataFrame(
        [("o1", "u", Decimal("5"), "2024-01-03", "2024-01-01", "b", "7"), ("o1", "u", Decimal("5"), "2024-01-02", "2024-01-01", "a", "7"),
         ("o2", "v", Decimal("1"), "2024-01-02", "2024-01-02", "a", "2"), ("o3", "v", Decimal("1"), "2024-01-02", "2024-01-02", "b", None)],
        "order_id string, user_id string, refund_amount decimal(16,2), refund_time string, create_time string, category_name string, refund_reason_type string",
    ).withColumn("refund_time", F.col("refund_time").cast("date")).withColumn("create_time", F.col("create_time").cast("date"))
    df = orders(spark, *[(str(i), "u", "10", "PAID", "2024-01-01") for i in range(4)])
    got = ads.ads_refund_analysis(refunds, df)
    assert rows(got, "refund_count", "refund_user_count", "avg_refund_days", "top_refund_category", "refund_reason_distribution", "refund_rate") == [
        (3, 2, 0.75, "a", '{"2":1,"7":2}', 75.0)]


def test_campaign_without_cost(spark, rows):
    df = spark.createDataFrame([("c", "n", "s", "e", "ch", 0, 0, 1, Decimal("5"), Decimal("0"))],
                               "campaign_id string, campaign_name string, start_date string, end_date string, channel string, exposure_count bigint, "
                               "click_count bigint, order_count bigint, order_amount decimal(16,2), cost decimal(16,2)")
    assert rows(ads.ads_campaign_effect(df), "click_rate", "conversion_rate", "roi") == [(None, None, 0.0)]


def test_dashboard_ties(spark, rows):
    acts = spark.createDataFrame(
        [("u", "2", "order", "2024-01-01 09:00:00", "2024-01-01", Decimal("1"), "y"), ("v", "1", "order", "2024-01-01 10:00:00", "2024-01-01", Decimal("2"), "x"),
         ("v", "1", "page_view", "2024-01-01 10:00:00", "2024-01-01", Decimal("2"), "x"), ("v", "1", "order", "2024-01-01 11:00:00", "2024-01-01", Decimal("2"), "x")],
        "user_id string, sku_id string, action_code string, action_time string, date_id string, value decimal(16,2), category string",
    ).withColumn("action_time", F.col("action_time").cast("timestamp"))
    got = ads.ads_dashboard(acts, "2024-01-01", 10, "value", "category", 10)
    assert rows(got, "current_gmv", "today_gmv", "today_order_count", "peak_hour", "hot_sku", "hot_category", "gmv_progress") == [
        (Decimal("2.00"), Decimal("3.00"), 2, 9, "1", "x", 30.0)]


def test_device_traffic_and_service(spark, rows):
    device = spark.createDataFrame([("u", "PC", 1, 0, 10, 4), ("v", "PC", 0, 1, 5, 2)],
                                   "user_id string, device_type string, is_new int, is_return int, duration_minutes bigint, page_view_count bigint")
    assert rows(ads.ads_dau_by_device(device)) == [("PC", 2, 1, 1, 7.5, 3.0)]
    traffic = spark.createDataFrame([("a", "b", "c", "u", 3, 1, 2, 10, 1), ("a", "b", "c", "u", 1, 0, 0, None, 0)],
                                    "source_type string, source_name string, channel string, user_id string, pv bigint, bounce_count bigint, "
                                    "session_count bigint, session_duration bigint, conversion_count bigint")
    assert rows(ads.ads_traffic_source(traffic), "pv", "uv", "bounce_rate", "avg_session_duration", "conversion_rate") == [(4, 1, 50.0, 10.0, 100.0)]
    tickets = spark.createDataFrame([("t", "2024-01-01 10:00:00", "2024-01-01 10:30:00", "resolved", "2024-01-01"), ("t", "2024-01-01 10:00:00", None, "pending", "2024-01-01")],
                                    "service_type string, create_time string, handle_time string, handle_result string, date_id string")
    got = ads.ads_customer_service(tickets, "2024-01-01").where("recent_days = 1")
    assert rows(got, "total_count", "resolved_rate", "avg_handle_time_minutes") == [(2, 50.0, 30.0)]


def test_quartiles_interpolate(spark, rows):
    df = spark.createDataFrame([(Decimal(x),) for x in ("1", "2", "4", "5000", "2")] + [(None,)], "total_amount decimal(16,2)")
    assert rows(batch.order_amount_summary(df), "cnt", "min_amount", "p25", "p50", "p75", "max_amount") == [(5, 1.0, 2.0, 2.0, 4.0, 5000.0)]
    two = spark.createDataFrame([(Decimal("1"),), (Decimal("2"),)], "total_amount decimal(16,2)")
    assert rows(batch.order_amount_summary(two), "p25", "p50", "p75") == [(1.25, 1.5, 1.75)]


def test_sku_rank_from_the_daily_table_equals_that_from_lines(spark, rows):
    sold = lines(spark, ("1", "u", "a", 1, "10", 1, "2024-01-30"), ("1", "u", "b", 2, "30", 1, "2024-01-30"),
                 ("2", "v", "a", 3, "30", 0, "2024-01-25"), ("3", "v", "c", 1, "1", 1, "2024-01-03"), ("1", "u", "a", 1, "5", 1, "2024-01-30"))
    refunds = spark.createDataFrame(
        [("1", "u", "a", 1, Decimal("4"), "2024-01-30"), ("0", "u", "gone", 1, Decimal("9"), "2024-01-29")],
        "order_id string, user_id string, sku_id string, refund_num bigint, refund_amount decimal(16,2), date_id string",
    )
    direct = ads.ads_sku_sales_rank(sold, "2024-01-30", refunds)
    stored = ads.ads_sku_sales_rank(None, "2024-01-30", daily=dws.dws_sku_stats(sold, refunds))
    columns = sorted(direct.columns)
    assert sorted(stored.columns) == columns
    assert rows(stored, *columns) == rows(direct, *columns)
