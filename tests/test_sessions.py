"""Sessions carried from day to day against the sessions of the whole log."""

import random
from datetime import datetime, timedelta

import pytest

from bazaarlake.operators import dws
from bazaarlake.operators.sessions import MAX_GAP_SECONDS, as_of, daily_sessions
from bazaarlake.plans.daily import DailyRun, MissingInput
from bazaarlake.sources import files

DAYS = [f"2024-01-{d:02d}" for d in range(20, 26)]
KEYS = ("user_id", "session_start", "session_end", "views")
HOURS = ("date_id", "hour_id", "view_count", "visitor_count", "session_count", "avg_duration_sec", "bounce_rate")


def log(seed=5):
    """Views that gather around midnight, a user active through two midnights, a day without views, equal rows."""
    draw = random.Random(seed)
    midnights = [datetime(2024, 1, d) for d in (21, 22, 25)]
    rows = []
    for user in ("a", "b", "c", None):
        for _ in range(25):
            at = draw.choice(midnights) + timedelta(minutes=draw.randint(-90, 60))
            rows.append((user, at.strftime("%Y-%m-%d %H:%M")))
    at = datetime(2024, 1, 20, 23, 50)
    while at < datetime(2024, 1, 22, 0, 20):
        rows.append(("bot", at.strftime("%Y-%m-%d %H:%M")))
        at += timedelta(minutes=29)
    rows += [("edge", "2024-01-20 23:30"), ("edge", "2024-01-21 00:00"), ("edge", "2024-01-21 00:31"), ("gone", "2024-01-20 23:45")]
    return rows + rows[:3]


def frame(spark, rows):
    return spark.createDataFrame(rows, "user_id string, action_time string")


def by_days(spark, rows, spans):
    """The open and ended rows of every dt, span by span."""
    carried, out = None, None
    for first, last in spans:
        views = frame(spark, [r for r in rows if first <= r[1][:10] <= last])
        got = daily_sessions(carried, views, "action_time", first, last)
        out = got if out is None else out.unionByName(got)
        carried = got.where(f"dt = '{last}'").drop("dt")
    return out


@pytest.mark.parametrize("spans", [
    [(DAYS[0], DAYS[0]), (DAYS[1], DAYS[4]), (DAYS[5], DAYS[5])], [(DAYS[0], DAYS[5])],
])
def test_any_split_of_the_log_gives_the_same(spark, rows, spans):
    whole = rows(dws.user_sessions(frame(spark, log()), "action_time"), *KEYS)
    got = by_days(spark, log(), spans)
    assert rows(as_of(got, DAYS[-1]), *KEYS) == whole
    # The tables of the days are the same, too, open rows included.
    single = by_days(spark, log(), [(d, d) for d in DAYS])
    assert rows(got, *KEYS, "date_id", "is_open", "dt") == rows(single, *KEYS, "date_id", "is_open", "dt")


def test_every_day_knows_the_log_so_far(spark, rows):
    got = by_days(spark, log(), [(d, d) for d in DAYS]).persist()
    for day in DAYS:
        so_far = frame(spark, [r for r in log() if r[1][:10] <= day])
        assert rows(as_of(got, day), *KEYS) == rows(dws.user_sessions(so_far, "action_time"), *KEYS)
    got.unpersist()


def test_unreadable_times_empty_days_and_long_gaps(spark, rows):
    odd = frame(spark, [("a", "2024-01-20 9 o'clock"), ("a", None), ("a", "2024-01-20 09:00")])
    assert rows(daily_sessions(None, odd, "action_time", DAYS[0], DAYS[0]), "views", "is_open", "dt") == [(1, False, DAYS[0])]
    assert rows(daily_sessions(None, frame(spark, []), "action_time", DAYS[0], DAYS[0])) == []
    with pytest.raises(ValueError):
        daily_sessions(None, odd, "action_time", DAYS[0], DAYS[0], MAX_GAP_SECONDS + 1)


def land(spark, root, day, known):
    views = frame(spark, [r for r in known if r[1][:10] == day]).selectExpr("*", "'page_view' AS action_code")
    carts = spark.createDataFrame([("a", f"{day} 12:00", "cart_add")], "user_id string, action_time string, action_code string")
    files.write_partition(views.unionByName(carts), f"{root}/dwd/dwd_action", day)


def run(spark, root, day, late=(), first_day=False):
    daily = DailyRun(spark, "", root, day, first_day)
    daily.late = {"action_page_view": list(late)}
    daily._page_views()


def check(spark, root, known, day, rows):
    stored = files.read_table(spark, f"{root}/dws/dws_page_view_day")
    so_far = frame(spark, [r for r in known if r[1][:10] <= day])
    assert rows(stored, *HOURS) == rows(dws.dws_page_view_day(so_far, "action_time"), *HOURS)
    assert stored.where("dt <> date_id").count() == 0


def test_daily_run_with_late_views_and_a_rerun(spark, rows, tmp_path):
    root, days, known = str(tmp_path), DAYS[:4], log()
    # Held back: the bot's views of one hour, which cut its session, and a view that moves a session's start.
    late = [r for r in known if r[0] == "bot" and "2024-01-21 10" <= r[1] < "2024-01-21 12"]
    joins = [("gone", "2024-01-20 23:20"), ("new", "2024-01-19 23:59"), ("new", "2024-01-20 00:10")]
    known = [r for r in known if r not in late]
    for day in days:
        if day == days[3]:
            known += late + joins
            for d in ("2024-01-19", days[0], days[1]):
                land(spark, root, d, known)
        land(spark, root, day, known)
        run(spark, root, day, ["2024-01-19", days[0], days[1]] if day == days[3] else [], day == days[0])
        check(spark, root, known, day, rows)
    before = rows(files.read_table(spark, f"{root}/dws/dws_session"))
    run(spark, root, days[3], ["2024-01-19", days[0], days[1]])
    assert before == rows(files.read_table(spark, f"{root}/dws/dws_session"))
    check(spark, root, known, days[3], rows)


def test_first_day_with_history_equals_single_days(spark, rows, tmp_path):
    root, known = str(tmp_path), log()
    for day in DAYS[:3]:
        land(spark, root, day, known)
    run(spark, root, DAYS[2], DAYS[:2], first_day=True)
    check(spark, root, known, DAYS[2], rows)
    with pytest.raises(MissingInput):
        run(spark, root, DAYS[5])


def test_a_late_view_leaves_days_behind_it_alone(spark, rows, tmp_path):
    root, known = str(tmp_path), [("a", "2024-01-20 10:00"), ("b", "2024-01-21 23:50"), ("b", "2024-01-22 00:05"), ("a", "2024-01-23 09:00")]
    for day in DAYS[:3]:
        land(spark, root, day, known)
        run(spark, root, day, first_day=day == DAYS[0])
    kept = f"{root}/dws/dws_session/dt={DAYS[1]}"
    stamps = {p: p.stat().st_mtime_ns for p in (tmp_path / "dws/dws_session" / f"dt={DAYS[1]}").iterdir()}
    known.append(("a", "2024-01-20 10:10"))
    land(spark, root, DAYS[0], known)
    land(spark, root, DAYS[3], known)
    run(spark, root, DAYS[3], [DAYS[0]])
    check(spark, root, known, DAYS[3], rows)
    assert stamps == {p: p.stat().st_mtime_ns for p in (tmp_path / "dws/dws_session" / f"dt={DAYS[1]}").iterdir()}, kept
