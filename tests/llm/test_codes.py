"""Codebooks in exact integers: pivots against plain evaluation of every entry."""

import hashlib
import math

import numpy as np
import pytest

from bazaarlake.llm import codes
from bazaarlake.llm.codes import compress
from bazaarlake.llm.queries import op11_codes


def brute(data):
    """(id, vector, label) rows to {row number: (code, error)}, the digest and the errors by label."""
    kept = [(n, i, [math.floor(256 * x) for x in v], label) for n, (i, v, label) in enumerate(data)
            if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    if not kept:
        return {}, None, {}
    order = sorted(kept, key=lambda r: (r[1] is None, r[1] or 0, r[2]))[:64]
    step = len(kept[0][2]) // 16
    cut = lambda v, p: v[p * step:(p + 1) * step]
    books = [[cut(r[2], p) for r in order] for p in range(16)]
    far = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b))

    def assign():
        return {n: [min((far(cut(v, p), e), k) for k, e in enumerate(books[p])) for p in range(16)] for n, _, v, _ in kept}

    for _ in range(2):
        to = assign()
        for p in range(16):
            for k in range(len(books[p])):
                of = [cut(v, p) for n, _, v, _ in kept if to[n][p][1] == k]
                if of:
                    books[p][k] = [sum(c) // len(of) for c in zip(*of)]
    to = assign()
    digest = hashlib.sha256(",".join(str(x) for part in books for e in part for x in e).encode()).hexdigest()
    rows = {n: ("".join(f"{k:02x}" for _, k in to[n]), sum(d for d, _ in to[n])) for n, *_ in kept}
    by_label = {}
    for n, _, _, label in kept:
        by_label[label] = by_label.get(label, 0) + rows[n][1]
    return rows, digest, by_label


def frame(spark, data):
    return spark.createDataFrame(data, "vec_id long, embedding array<double>, label int")


def check(spark, tmp_path, data):
    frame(spark, data).selectExpr("*", "'x' AS code", "1L AS error", "2 AS vector", "3 AS kept", "4 AS of").write.parquet(
        str(tmp_path / "embeddings.parquet"))
    want, digest, by_label = brute(data)
    got = op11_codes(spark, str(tmp_path)).collect()
    expected = [(data[n][0], code, error, by_label[data[n][2]], digest) for n, (code, error) in want.items()]
    key = lambda t: tuple((x is None, str(x)) for x in t)
    assert sorted((tuple(r) for r in got), key=key) == sorted(expected, key=key)


def test_nulls_ties_repeats_and_hot_label(spark, tmp_path):
    rng = np.random.default_rng(3)
    data = [(i, [float(x) for x in rng.normal(size=32) / 4], None if i % 7 == 0 else i % 2) for i in range(300)]
    data += [(400 + i, [0.5] * 32, 1) for i in range(60)]  # copies
    data += [(5, data[5][1], 1), (5, [0.25] * 32, None), (None, [-0.001] * 32, 1), (None, [-0.001] * 32, 1)]
    data += [(901, None, 1), (902, [None] * 32, 1), (903, [float("nan")] * 32, 0), (904, [float("inf")] + [0.0] * 31, 0)]
    check(spark, tmp_path, data)


def test_few_rows_and_large_numbers(spark, tmp_path):
    data = [(3, [1e30] * 16, 1), (1, [-3e20 * (i + 1) for i in range(16)], 1), (2, [1.0] * 16, 2), (4, [-1e7] * 16, 2)]
    with_small_errors = [*data, (9, [1.0] * 16, None)]
    check(spark, tmp_path, with_small_errors)


def test_empty_tables_and_odd_lengths(spark):
    empty, books = compress(frame(spark, []))
    assert books is None and empty.count() == 0
    assert empty.columns == ["id", "kept", "code", "error"]
    none, books = compress(frame(spark, [(1, None, 1), (2, [float("nan")], 1)]))
    assert books is None and none.count() == 0
    blank, books = compress(frame(spark, [(1, [], 1)]))
    assert [tuple(r)[2:] for r in blank.collect()] == [("00" * 16, 0)] and books.width == 0
    with pytest.raises(ValueError, match="17 components"):
        compress(frame(spark, [(1, [0.0] * 17, 1)]))
    with pytest.raises(Exception, match="a vector has 32 components"):
        compress(frame(spark, [(1, [0.0] * 16, 1), (2, [0.0] * 32, 1)]))[0].collect()


def test_pivots_spare_most_evaluations():
    rng = np.random.default_rng(5)
    part = rng.integers(-60, 60, (3000, 4))
    entries, pivots = part[:64], part[[0, 9, 21, 40]]
    best, least, evaluations = codes.nearest(part, codes.pivot_distances(part, pivots).astype("f4"), entries, pivots)
    full = ((part[:, None] - entries[None]) ** 2).sum(-1)
    assert (best == full.argmin(1)).all() and (least == full.min(1)).all()
    assert evaluations < 3000 * 64 / 4


def test_large_entries_against_small_parts():
    part, entries = np.array([[1, 2]]), np.array([[10**30, 0], [-(10**29), 5]], dtype=object)
    best, least, _ = codes.nearest(part, codes.pivot_distances(part, entries[:1]), entries, entries[:1])
    assert best.tolist() == [1] and least.tolist() == [(10**29 + 1) ** 2 + 9]


def test_limbs_add_up():
    numbers = [0, -1, 5, -(10**40), 10**40, 1 << 90, -(1 << 60)]
    back = [sum(v << (codes.LIMB * i) for i, v in enumerate(limbs)) for limbs in codes._limbs(np.array(numbers, dtype=object))]
    assert back == numbers
