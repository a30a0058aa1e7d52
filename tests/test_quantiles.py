"""Quartiles of windows from stored daily counts, against sorted amounts."""

import random
from decimal import ROUND_HALF_UP, Decimal
from math import floor

import pytest

from bazaarlake.functions.common import shift
from bazaarlake.operators import quantiles

START = "2024-01-01"
SCHEMA = "date_id string, total_amount decimal(16,2)"


def brute(made, last, days=(1, 7, 30)):
    out = []
    for k in days:
        inside = sorted(a for d, a in made if a is not None and shift(last, 1 - k) <= d <= last)
        if not inside:
            continue
        cells = []
        for q in (0.25, 0.5, 0.75):
            at = (len(inside) - 1) * q
            low, high = inside[floor(at)], inside[min(len(inside) - 1, floor(at) + 1)]
            exact = low + (high - low) * Decimal(at - floor(at))
            cells.append(float(exact.quantize(Decimal("0.01"), ROUND_HALF_UP)))
        out.append((k, len(inside), float(inside[0]), *cells, float(inside[-1])))
    return out


def amounts(kind, seed=11):
    rng = random.Random(seed)
    draw = {
        "spread": lambda: Decimal(rng.randrange(1, 10**9)) / 100,
        "one value": lambda: Decimal("5.00"),
        "skewed": lambda: Decimal("1.00") if rng.random() < 0.6 else Decimal(int(10 ** rng.uniform(0, 12))) / 100,
        "negative": lambda: Decimal(rng.randrange(-500, 500)) / 100,
    }[kind]
    return [(shift(START, rng.randrange(40)), draw() if rng.random() < 0.95 else None) for _ in range(700)]


@pytest.mark.parametrize("kind", ["spread", "one value", "skewed", "negative"])
def test_windows_equal_sorted_amounts(spark, kind):
    made = amounts(kind)
    daily = quantiles.daily_amounts(spark.createDataFrame(made, SCHEMA))
    last = shift(START, 36)
    buckets = {"spread": 256, "one value": 4, "skewed": 16, "negative": 2}[kind]
    got = sorted(tuple(r) for r in quantiles.amount_windows(daily, last, buckets=buckets).collect())
    assert got == brute(made, last)


def test_days_add_up_and_empty_windows(spark, rows):
    made = [(START, Decimal("1.00")), (START, Decimal("1.00")), (shift(START, 5), Decimal("4.00")), (shift(START, 5), None)]
    parts = [quantiles.daily_amounts(spark.createDataFrame(made[:2], SCHEMA)), quantiles.daily_amounts(spark.createDataFrame(made[2:], SCHEMA))]
    got = rows(quantiles.amount_windows(parts[0].unionByName(parts[1]), shift(START, 6)))
    assert got == [(30, 3, 1.0, 1.0, 1.0, 2.5, 4.0), (7, 3, 1.0, 1.0, 1.0, 2.5, 4.0)]
    assert quantiles.amount_windows(parts[0].limit(0), START).count() == 0
