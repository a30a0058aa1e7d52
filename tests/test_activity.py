"""Masks of active days, carried from day to day, against the days themselves."""

import random

import pytest

from bazaarlake.functions.common import shift
from bazaarlake.operators import activity, ads, dws

START = "2024-01-01"


def log(users=25, days=75, seed=5):
    """(user, day of activity, day of arrival): most arrive on their day, some up to 70 days later."""
    rng = random.Random(seed)
    out = []
    for u in range(users):
        begin = rng.randrange(days)
        for d in range(begin, days):
            if rng.random() < 0.25 or d == begin:
                late = rng.choice([0] * 12 + [1, 3, 70])
                out.append((f"u{u}", d, min(days - 1, d + late)))
    return out


def masks_of(rows_, last):
    """user: (first day, since_first, recent) from the definition."""
    days = {}
    for user, day in rows_:
        days.setdefault(user, set()).add(day)
    bits = lambda ks: sum(1 << k for k in ks if 0 <= k < 63)
    return {u: (shift(START, min(d)), bits(x - min(d) for x in d), bits(last - x for x in d)) for u, d in days.items()}


def frame(spark, rows_):
    return spark.createDataFrame([(u, shift(START, d)) for u, d in rows_], "user_id string, date_id string")


def test_carried_masks_equal_those_of_all_days(spark):
    data = log()
    data += [("early", 70, 70), ("early", 2, 73), ("twice", 71, 72), ("twice", 71, 72)]  # a first day 68 days late
    masks = None
    for day in range(75):
        if day % 15 and day < 70:  # some days at once, as after a pause
            continue
        before = next((d for d in range(day - 1, -1, -1) if not (d % 15 and d < 70)), None)
        new = [(u, d) for u, d, at in data if at <= day and (before is None or at > before)]
        masks = activity.update_masks(masks, frame(spark, new), shift(START, day), 1 if before is None else day - before)
        masks = spark.createDataFrame(masks.collect(), masks.schema)
    got = {r["user_id"]: tuple(r)[1:] for r in masks.collect()}
    want = masks_of([(u, d) for u, d, _ in data], 74)
    exact = {u for u in want if u != "early"}
    # Days that arrive late before the known first one, and older than the mask, move the first day only.
    late_first = {u for u, d, at in data if at - d >= 63}
    assert all(got[u] == want[u] for u in exact - late_first) and len(exact - late_first) > 5
    assert all(got[u][0] == want[u][0] and got[u][2] == want[u][2] for u in want)
    assert got["early"] == (shift(START, 2), 1, 1 << 4)  # the later day is beyond the mask of the new first day


def test_reports_equal_those_from_days(spark, rows):
    last = shift(START, 74)
    days = frame(spark, [(u, d) for u, d, _ in log(users=60)])
    masks = activity.update_masks(None, days, last)
    assert rows(activity.user_retention(masks, last)) == rows(ads.ads_user_retention(days, last))
    assert rows(activity.user_retention_detail(masks, last, cohort_days=74)) == rows(ads.ads_user_retention_detail(days, last, cohort_days=74))
    assert rows(activity.user_activity(masks, last)) == rows(ads.ads_user_activity(days, last))
    assert rows(activity.user_retention_day(masks)) == rows(dws.dws_user_retention_day(days))
    per_day = days.distinct().groupBy("date_id").count()
    assert set(rows(activity.active_users(masks, last))) <= set(rows(per_day)) and activity.active_users(masks, last).count() == 63


def test_edges(spark, rows):
    none = frame(spark, [])
    assert activity.update_masks(None, none, START).count() == 0
    future = frame(spark, [("u", 5), (None, 0)])
    assert activity.update_masks(None, future, START).count() == 0
    one = activity.update_masks(None, frame(spark, [("u", 0)]), START)
    assert rows(activity.update_masks(one, none, shift(START, 62), 62)) == [("u", START, 1, 1 << 62)]
    assert rows(activity.update_masks(one, none, shift(START, 100), 100)) == [("u", START, 1, 0)]
    assert rows(activity.user_activity(activity.update_masks(None, none, START), START)) == [(0, 0, 0, None, None)]
    with pytest.raises(ValueError):
        activity.user_retention(one, START, cohort_days=90)
    with pytest.raises(ValueError):
        activity.user_retention_detail(one, START, offsets=(1, 63))
