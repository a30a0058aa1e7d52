from bazaarlake.streaming.live import append_to, live_bursts, live_hours

SCHEMA = "action_id bigint, user_id string, action_code string, value decimal(16,2), action_time timestamp"


def batch(spark, path, rows):
    values = ", ".join(f"({i}, '{u}', '{c}', {v}, timestamp'2024-01-01 {t}')" for i, u, c, v, t in rows)
    spark.sql(f"SELECT CAST(a AS BIGINT) action_id, b user_id, c action_code, CAST(d AS DECIMAL(16,2)) value, e action_time "
              f"FROM VALUES {values} AS t(a, b, c, d, e)").coalesce(1).write.mode("append").parquet(path)


def test_live_hours_and_bursts_across_restarts(spark, tmp_path, rows):
    source = str(tmp_path / "in")
    first = [(1, "u", "order", 10, "09:00:00"), (2, "u", "page_view", 0, "09:10:00"), (2, "u", "page_view", 0, "09:10:00"),
             (3, "u", "order", 5, "09:59:59"), (4, "v", "page_view", 0, "10:00:00")]
    second = [(5, "v", "order", 7, "10:30:00"), (3, "u", "order", 5, "09:59:59"), (6, "w", "page_view", 0, "12:30:00")]
    batch(spark, source, first)
    for step in (None, second):
        if step:
            batch(spark, source, step)
        events = spark.readStream.schema(SCHEMA).parquet(source)
        for name, df in (("hours", live_hours(events)), ("bursts", live_bursts(events))):
            append_to(df, str(tmp_path / name), str(tmp_path / f"{name}-state")).awaitTermination()
    hours = spark.read.parquet(str(tmp_path / "hours")).selectExpr("hour(hour_start) AS h", "order_count", "CAST(gmv AS INT) AS gmv", "view_count")
    assert rows(hours) == [(10, 1, 7, 1), (9, 2, 15, 1)]
    bursts = spark.read.parquet(str(tmp_path / "bursts")).selectExpr("user_id", "hour(hour_start) AS h", "event_count")
    assert rows(bursts) == [("u", 9, 3)]
