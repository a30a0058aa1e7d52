"""License scan, quality classifier, personal data and language model."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from bazaarlake.llm import hmm, pii, quality
from bazaarlake.llm.licenses import NOTICES, NoticeSearch, license_scan
from bazaarlake.llm.shared import fold


def lowered(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


# License scan ---------------------------------------------------------------


def test_license_scan(spark, rows):
    data = [
        (1, "Under the MIT License; mit-license, MIT LICENSE. Apache License!"),
        (2, "GNU General Public Licence, version 2"),
        (3, "Permission is hereby granted, free of charge, to any persn"),
        (4, "emit license mit licenses apache  2"),
        (5, None),
        (6, ""),
        (7, "general public license " * 3 + "é general public\0license"),
        (8, "x " * 100_000 + "apache license"),
    ]
    df = spark.createDataFrame(data, "doc_id long, text string").selectExpr("*", "1 AS license")
    got = {r["doc_id"]: r for r in license_scan(df).select("doc_id", "license.*").collect()}
    short = {i: (r["n_words"], r["n_base"], r["first_word"], r["last_word"], r["base_labels"], r["labels"]) for i, r in got.items()}
    assert short[1] == (10, 4, 2, 8, "apache,mit", "apache,mit")
    assert short[2] == (6, 0, None, None, "", "gpl") and 0.8 < got[2]["score"] < 1
    assert short[3][1:] == (0, None, None, "", "mit")
    assert short[4][1:5] == (0, None, None, "") and got[4]["score"] < 1
    assert short[5] == short[6] == (0, 0, None, None, "", "") and got[5]["score"] == 0.0
    assert short[7] == (13, 4, 0, 10, "gpl", "gpl") and got[7]["score"] == 1.0
    assert short[8][:4] == (100_002, 1, 100_000, 100_000)
    spans = [(s["label"], s["first_word"], s["last_word"], s["edits"]) for s in got[2]["spans"]]
    assert spans == [("gpl", 1, 3, 1)]
    assert license_scan(df.limit(0)).count() == 0


def distance(a, b):
    line = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(line[j] + 1, new[-1] + 1, line[j - 1] + (x != y)))
        line = new
    return line[-1]


def test_seeds_lose_no_notice():
    rng, search = random.Random(7), NoticeSearch()
    for _ in range(300):
        phrase, label, edits = rng.choice(NOTICES)
        text = list(phrase)
        for _ in range(rng.randrange(edits + 1)):
            i = rng.randrange(1, len(text) - 1)
            kind = rng.randrange(3)
            text[i : i + (kind != 0)] = ["z"] if kind < 2 else []
        changed = "".join(text)
        assert distance(phrase, changed) <= edits
        assert label in {f[0] for f in search.find(f"some words {changed} more words")}, changed


# Quality --------------------------------------------------------------------


def text_of(rng, good):
    words = ["".join(rng.choice(["th", "er", "on", "an", "re"]) for _ in range(rng.randrange(1, 5))) for _ in range(60)]
    if good:
        return " ".join(words) + "."
    style = rng.randrange(3)
    if style == 0:
        return " ".join(w.upper() + "!!" for w in words)
    return " | ".join(words) if style == 1 else " ".join(w + rng.choice(["$$$", "%%%"]) for w in words)


def test_quality_on_held_out_rows(spark):
    rng = random.Random(8)
    data = [(i, text_of(rng, i % 5 > 0), int(i % 5 > 0)) for i in range(600)]
    docs = spark.createDataFrame([d[:2] for d in data] + [(9000, None), (9001, ""), (None, "x")], "doc_id long, text string")
    labels = spark.createDataFrame([(i, y, 0) for i, _, y in data] + [(0, 0, 0), (None, 1, 0), (9, None, 0)], "doc_id long, quality int, toxic int")
    held = fold(F.col("doc_id"), 5) == 0
    model = quality.fit(docs, labels, train=~held)
    scored = quality.score(docs.selectExpr("*", "'s' AS quality_score"), model).select("doc_id", "quality_score").collect()
    score = {r["doc_id"]: r["quality_score"] for r in scored}
    assert len(scored) == 603 and all(0 <= s <= 1 for s in score.values()) and score[9000] == score[9001]
    out = [(score[i], y) for i, _, y in data if zlib.crc32(str(i).encode()) % 5 == 0]
    assert min(s for s, y in out if y) > 0.5 and max(s for s, y in out if not y) < quality.REJECT_BELOW
    again = quality.fit(docs, labels, train=~held)
    assert np.allclose(model.weights, again.weights) and model.slope == again.slope


def test_quality_without_both_classes(spark):
    docs = spark.createDataFrame([(1, "a b"), (2, None)], "doc_id long, text string")
    labels = spark.createDataFrame([(1, 1)], "doc_id long, quality int")
    for known, want in ((labels, 2 / 3), (labels.limit(0), 1 / 2)):
        model = quality.fit(docs, known)
        assert [round(r[0], 6) for r in quality.score(docs, model, out="s").select("s").collect()] == [round(want, 6)] * 2
    assert quality.score(docs.limit(0), quality.fit(docs.limit(0), labels)).count() == 0


# Personal data --------------------------------------------------------------


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def base(text):
    out = [("email", *m.span()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(p) <= 255 for p in m[0].split(".")):
            out.append(("ip", *m.span()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        digits = re.sub("[ -]", "", m[0])
        if 13 <= len(digits) <= 19 and luhn(digits):
            out.append(("card", *m.span()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 9 <= len(re.sub("[^0-9]", "", m[0])) <= 15:
            out.append(("phone", *m.span()))
    return ",".join(f"{k}:{a}:{b}" for k, a, b in out)


def noise(rng):
    parts = ["a", "b.c", "@", ".", "1", "23", "255", "256", "+", "-", " ", "  ", "(", ")", "_", "é", "\U0001f600", "x@y.z", "1.2.3.4"]
    parts += ["4532015112830366", "4532 0151 1283 0366", "+33 1 23 45 67 89", "0" * 12, "\n"]
    return "".join(rng.choice(parts) for _ in range(rng.randrange(60)))


def test_base_spans_equal_the_rules(spark):
    rng = random.Random(9)
    texts = [noise(rng) for _ in range(1500)] + [None, "", "a@b.c_d@e.f", "1.2.3.4.5.6.7.8", "1.1 " * 3000, "4 " * 40_000, "+1" * 3000]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    got = pii.personal_data(df).select("doc_id", pii.span_text(F.col("pii"), pii.KINDS).alias("spans")).collect()
    wrong = [(texts[r["doc_id"]], r["spans"]) for r in got if r["spans"] != base(texts[r["doc_id"]] or "")]
    assert len(got) == len(texts) and not wrong


def test_long_runs_need_no_deep_stack(spark):
    texts = ["4" * 300_000, "a" * 200_000 + "@" + "b." * 50_000 + "c", "x" * 300_000, "1." * 20_000]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    sizes = {r[0]: r[1:] for r in pii.personal_data(df).select("doc_id", F.size("pii.email"), F.size("pii.ip")).collect()}
    assert sizes == {0: (0, 0), 1: (1, 0), 2: (0, 0), 3: (0, 5000)}


def test_secrets_are_told_from_other_tokens(spark):
    rng = random.Random(10)
    hex_ = lambda n: "".join(rng.choice("0123456789abcdef") for _ in range(n))
    secret, plain = [], []
    for i in range(60):
        secret.append(rng.choice([f'token = "{hex_(40)}"', f"password={hex_(18)}", f"api key: {hex_(32)}"]))
        plain.append(rng.choice([f"in {rng.randrange(10**7, 10**8)} units", "see 2024-01-02 now", f"the {rng.randrange(10**8, 10**9)} of"]))
    df = spark.createDataFrame([(i, f"some words {t} and more") for i, t in enumerate(secret + plain)], "doc_id long, text string")
    got = {r[0]: r[1] for r in pii.personal_data(df).select("doc_id", F.size("pii.secret")).collect()}
    assert all(got[i] == 1 for i in range(60)) and not any(got[i] for i in range(60, 120))


def test_pii_plan_has_no_python(spark):
    df = spark.createDataFrame([(1, "a@b.c password=abc123def456abc1")], "doc_id long, text string")
    plan = pii.personal_data(df.selectExpr("*", "2 AS pii"))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
    assert pii.personal_data(df.limit(0)).count() == 0


# Language model -------------------------------------------------------------


def tokens(text):
    return re.findall(r"[^\x20\x09-\x0D]+", lowered(text)) + [None]


@pytest.mark.parametrize("common", [1 << 18, 5])
def test_base_score_equals_brute_force(spark, monkeypatch, common):
    monkeypatch.setattr(hmm, "COMMON", common)
    monkeypatch.setattr(hmm, "HEAD", 3)
    monkeypatch.setattr(hmm, "SYMBOLS", 1 + 3 + hmm.CLASSES)
    rng = random.Random(11)
    data = [(i, " ".join(f"w{int(rng.paretovariate(1))}" for _ in range(rng.randrange(40)))) for i in range(80)]
    data += [(80, None), (81, ""), (82, "only here"), (None, "w1 w2"), data[0], data[0], (83, "É é W1")]
    df = spark.createDataFrame(data, "doc_id long, text string").selectExpr("*", "0 AS n_tokens").repartition(3)
    held = {i: i is not None and zlib.crc32(str(i).encode()) % 5 == 1 for i, _ in data}
    counts = Counter(t for i, text in data if not held[i] for t in tokens(text))
    total, words = sum(counts.values()), len(counts)
    want = sorted(
        (str(i), held[i], len(tokens(t)), sum(counts[w] > 0 for w in tokens(t)), total,
         round(sum(math.log10((counts[w] + 0.5) / (total + 0.5 * (words + 1))) for w in tokens(t)), 8))
        for i, t in data
    )
    got = hmm.score(df, fold(F.col("doc_id"), 5) == 1).collect()
    assert sorted((str(r[0]), r[1], r[2], r[3], r[4], round(r[5], 8)) for r in got) == want
    assert all(r["score"] < 0 for r in got)


def test_the_model_is_a_distribution(spark):
    """Over all tokens that can follow, known ones and one new one per class, probabilities add up to 1."""
    data = [(i, "a b c a b dd, eee. a") for i in range(20)]
    df = spark.createDataFrame(data, "doc_id long, text string")
    counts = df.select("text").mapInArrow(hmm._count, "hash bigint, class int, n bigint").groupBy("hash").agg(
        F.min("class").alias("class"), F.sum("n").alias("n")
    )
    lex = hmm.lexicon(counts)
    assert (lex.tokens, lex.words) == (20 * 9, 6)
    model = hmm.train(df.select(hmm._encoder(lex)("text").alias("e")).select("e.symbols"), lex)
    assert np.allclose(model.emit.sum(axis=0), 1) and np.allclose(model.move.sum(axis=1), 1) and np.isclose(model.start.sum(), 1)
    # Deterministic text: the trained states beat the same symbols drawn one by one.
    got = hmm.score(df, F.lit(False)).first()
    assert got["score"] > got["base_score"]


def test_forward_and_expected_counts():
    rng = np.random.default_rng(12)
    model = hmm.first_model(rng.integers(1, 50, 30).astype(float), 3)
    sequences = [rng.integers(0, 30, n).astype(np.int16) for n in (1, 5, 0, 9, 9, 2, 700)]

    def naive(s):
        a = model.start * model.emit[s[0]]
        scale = 0.0
        for y in s[1:]:
            a = (a @ model.move) * model.emit[y]
            scale += math.log(a.sum())
            a = a / a.sum()
        return scale + math.log(a.sum()) if len(s) > 1 else math.log(a.sum())

    want = [naive(s) if len(s) else 0.0 for s in sequences]
    assert np.allclose(hmm.log_likelihoods(model, sequences), want)
    before = -math.inf
    for _ in range(5):
        starts, moves, emits, likelihood = hmm.expected_counts(model, sequences, [True] * 7)
        assert likelihood > before and np.isclose(emits.sum(), 726) and np.isclose(moves.sum(), 720) and np.isclose(starts.sum(), 6)
        before = likelihood
        model = hmm.Hmm(starts / starts.sum(), moves / moves.sum(axis=1, keepdims=True), emits / emits.sum(axis=0))


def test_language_model_edges(spark):
    df = spark.createDataFrame([(1, "x y"), (2, None)], "doc_id long, text string")
    assert hmm.score(df.limit(0), F.lit(False)).count() == 0
    none = hmm.score(df, F.lit(True)).collect()
    assert all(abs(r["base_score"]) < 1e-9 and r["train_tokens"] == 0 and r["n_known"] == 0 for r in none)




def test_shapes_of_whole_words():
    from bazaarlake.llm.quality import _shape

    assert _shape(b"Word12!!") == b"Aa9!!"
    assert _shape(b"x" * 40 + b"1234-5678") == b"a9-9" != _shape(b"x" * 40 + b"ABCDEF!!!")


def test_edited_notice_in_front_of_an_exact_one():
    from bazaarlake.llm.licenses import NoticeSearch

    found = NoticeSearch((("apache license", "apache", 2),)).find("apche licnse apache license")
    assert [(f[1], f[3]) for f in found] == [(0, 2), (13, 0)]
