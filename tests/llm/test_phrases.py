"""Counting quotient filters and the phrases counted in them, against plain Python."""

import re
from collections import Counter

import numpy as np
import pytest

from bazaarlake.llm import phrases
from bazaarlake.llm.phrases import collocations
from pyspark.sql import functions as F


def test_permutation_is_inverted():
    rng = np.random.default_rng(1)
    for order in (2, 3):
        ids = [rng.integers(0, 1 << phrases.ID_BITS, 5000).astype(np.uint64) for _ in range(order)]
        ids[0][:2], ids[-1][:2] = 0, (1 << phrases.ID_BITS) - 1
        half = phrases.half_bits(order)
        high, low = phrases.permuted(*phrases.packed(ids), half)
        assert max(high.max(), low.max()) < 1 << half
        back = phrases.unpacked(*phrases.restored(high, low, half), order)
        assert all((a == b).all() for a, b in zip(ids, back))


@pytest.mark.parametrize("half", [42, 63])
@pytest.mark.parametrize("prefix", [0, 3, 6])
@pytest.mark.parametrize("n", [0, 1, 2, 700, 5000])
def test_filters_keep_every_value_and_count(half, prefix, n):
    rng = np.random.default_rng(n + prefix)
    segment = (1 << prefix) - 1
    within = half - prefix
    values = sorted({(int(h) | segment << within, int(x)) for h, x in zip(
        rng.integers(0, 1 << within, n), rng.integers(0, 1 << half, n))})
    values += [(values[-1][0], values[-1][1] + 1)] if n > 2 else []  # a run of one quotient and equal upper halves
    high, low = (np.array([v[i] for v in values], dtype=np.uint64) for i in (0, 1))
    counts = np.array([(1, 2, 255, 256, 257, 258, 1 << 40)[i % 7] for i in range(len(values))], dtype=np.uint64)
    data = phrases.encode(high, low, counts, half, prefix)
    back = phrases.decode(data, segment)
    assert all((a == b).all() for a, b in zip(back, (high, low, counts)))
    if n == 5000:
        assert len(phrases.encode(high, low, np.ones_like(counts), half, prefix)) < len(values) * (2 * half / 8 + 1)


def test_merge_adds_equal_values():
    rng = np.random.default_rng(4)
    parts, want = [], Counter()
    for _ in range(5):
        some = sorted({(int(a), int(b)) for a, b in rng.integers(0, 12, (60, 2))})
        counts = rng.integers(1, 9, len(some))
        want.update({v: int(c) for v, c in zip(some, counts)})
        parts.append((*(np.array([v[i] for v in some], dtype=np.uint64) for i in (0, 1)), counts.astype(np.uint64)))
    high, low, counts = phrases.merged(parts)
    assert [(int(a), int(b), int(c)) for a, b, c in zip(high, low, counts)] == [(*v, want[v]) for v in sorted(want)]


def brute(docs, top):
    """The definition, on (text, lang) rows."""
    grams, n = {}, Counter()
    for text, lang in docs:
        lang = "und" if lang is None else lang
        text = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", text):
            words = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(words)
            of = grams.setdefault(lang, Counter())
            for k in (1, 2, 3):
                of.update(tuple(words[i:i + k]) for i in range(len(words) - k + 1))
    out = []
    for lang, of in grams.items():
        found = [g for g, a in of.items() if len(g) > 1 and a >= 10]
        kept = []
        for g in found:
            a = of[g]
            if any(len(x) > len(g) and g in (x[:2], x[1:]) and 100 * of[x] >= 50 * a for x in found):
                continue
            cuts = [(1000000 * a * a // (of[g[:k]] * of[g[k:]]), k) for k in range(1, len(g))]
            score, k = min(cuts)
            kept.append((-score, -a, " ".join(g).encode(), of[g[:k]], of[g[k:]]))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(kept)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, n[lang], -score))
    return sorted(out)


NAMES = ("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def frame(spark, docs):
    data = [(i, t, lang) for i, (t, lang) in enumerate(docs)]
    clash = ("1L AS n", "'x' AS word", "2 AS a", "3 AS score", "4 AS rank", "'y' AS phrase")
    return spark.createDataFrame(data, "doc_id long, text string, lang string").selectExpr("*", *clash).repartition(3)


def sample():
    rng = np.random.default_rng(9)
    vocabulary = [f"w{i}" for i in range(40)] + ["New", "York", "é", "\x1c", " ", "of", "the"]
    docs = []
    for i in range(150):
        words = [vocabulary[j] for j in np.minimum(rng.geometric(0.08, rng.integers(0, 120)) - 1, len(vocabulary) - 1)]
        for at in range(0, len(words) - 3, 11):
            words[at:at + 3] = (["new", "YORK", "city"], ["la", "la", "la"], ["of", "the", "é"])[at % 3]
        joints = (" ", "  ", "\t", " \t ", ", ", "\n", "\r\n", ". ", "\x0b", "!?", ": ")
        docs.append(("".join(w + joints[min(int(rng.geometric(0.6)) - 1, 10)] for w in words), ("en", "de", None, "")[min(i % 5, 3)]))
    return docs + [(None, "en"), ("", "en"), (" \t\n", None), (".,;", "xx"), ("one", "yy"), ("a b " * 20_000, "long"), ("x" * 100_000, "en")]


def test_phrases_equal_the_definition(spark, rows):
    docs = sample()
    got = collocations(frame(spark, docs), top=25)
    assert got.columns == list(NAMES) and rows(got, *NAMES) == sorted(brute(docs, 25), key=lambda t: tuple((False, str(v)) for v in t))


def test_small_filters_and_shared_ids_change_nothing(spark, rows, monkeypatch):
    docs = sample()[:60]
    want = sorted(brute(docs, 2000), key=lambda t: tuple((False, str(v)) for v in t))
    monkeypatch.setattr(phrases, "WORDS_PER_SEGMENT", 300)
    monkeypatch.setattr(phrases, "HELD", 50)
    monkeypatch.setattr(phrases, "WORDS_AT_ONCE", 7)
    monkeypatch.setattr(phrases, "BITMAP_BITS", range(15, 16))
    monkeypatch.setattr(phrases, "HASHED", (1 << 4) - 1)  # sixteen hashed ids for fifty words
    words = phrases.word_counts(frame(spark, docs))
    frequent, replaced = phrases._frequent_words(words)
    assert len(replaced) > 20 and frequent.groupBy("lang", "id").count().where("count > 1").count() == 0
    assert rows(collocations(frame(spark, docs)), *NAMES) == want


def test_empty_table_and_hash(spark):
    assert collocations(frame(spark, [("a", "b")]).limit(0)).count() == 0
    words = ["", "a", "é ", "x" * 500]
    got = spark.createDataFrame([(w,) for w in words], "w string").select("w", F.xxhash64("w").bitwiseAND(phrases.HASHED).alias("h"))
    assert all(r["h"] == phrases.hashed(r["w"].encode()) for r in got.collect())


def test_score_is_exact_beyond_64_bits(spark):
    n, a, b = 123_456_789_012, 987_654_321_098, 456_789_012_345
    row = spark.createDataFrame([(n, a, b)], "n long, a long, b long").select(phrases._score("a", "b").alias("s")).first()
    assert row["s"] == 1_000_000 * n * n // (a * b)
