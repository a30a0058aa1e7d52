"""Packing: tokens of whole texts, the linear program, and every property of the pieces."""

import zlib
from itertools import groupby

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from bazaarlake.llm import packing
from bazaarlake.llm.packing import CAPACITY, MIN_FILL, Tokens, pack, patterns, sequences
from bazaarlake.llm.queries import op12_pack

public_tokenizers = pytest.importorskip("public_tokenizers")
PATH = public_tokenizers.path("word_bpe_49k.json")
TOKENS = Tokens(PATH)


def plain(text):
    """Ids by the tokenizer itself, then the end id."""
    return TOKENS.tokenizer.encode(text or "", add_special_tokens=False).ids + [2]


PARTS = st.sampled_from(
    ["word", "Word's", "don't", "'s", "x'll,", "é", "é", "́", "İ", "—", "…", "2024", "a1b2", "<|endoftext|>", "<|ENDOFTEXT|>",
     "endoftext", "|>", "\x0b", "\x0c", "\x1c", "\x85", " ", " ", "　", " ", "\t", "\r\n", "\0", "中文", "🙂", "ß", "ẞ", "K", "_", "--", ".", "ﬁ",
     "naïve", "ó,", "×", "÷3", "Ünï1", "ÿ", "Σίσυφος", "ΟΔΟΣ", "ǅ", "ª", "a̓", "4b", "9é", "é́", "ı", "ﬀ", "ʰ", "Ž", "ž."]
)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.one_of(PARTS, st.text(max_size=6)), max_size=25))
def test_ids_of_runs_are_ids_of_the_text(parts):
    text = "".join(parts)
    text = text.encode("utf-8", "ignore").decode()
    assert np.frombuffer(TOKENS.ids(text.encode()), "<u4").tolist() == plain(text)


def test_cache_is_dropped_and_built_again(monkeypatch):
    monkeypatch.setattr(packing, "CACHED_BYTES", 500)
    tokens = Tokens(PATH)
    for i in range(30):
        text = f"some words number {i} come, and some go {i * i}"
        assert np.frombuffer(tokens.ids(text.encode()), "<u4").tolist() == plain(text)
        assert len(tokens.known) < 30


def test_knapsack_and_program_against_enumeration():
    sizes = np.array([2, 3, 7, 8])
    rng = np.random.default_rng(2)

    def all_patterns(capacity, i=0):
        if i == len(sizes):
            yield ()
            return
        for k in range(capacity // sizes[i] + 1):
            for rest in all_patterns(capacity - k * sizes[i], i + 1):
                yield (k, *rest)

    every = [np.array(p) for p in all_patterns(17)]
    for _ in range(20):
        prices = rng.random(4)
        pattern, price = packing.knapsack(sizes, prices, 17)
        assert pattern @ sizes <= 17 and abs(pattern @ prices - price) < 1e-9
        assert abs(price - max(p @ prices for p in every)) < 1e-9
    demand = np.array([1000.0, 400, 900, 350])
    columns, used, bound = packing.fractional_patterns(sizes, demand, 17)
    assert np.allclose(columns @ used, demand) and (used >= 0).all()
    assert bound - 1e-6 <= used.sum() <= max(bound * (1 + packing.GAP), bound + 0.5)
    assert used.sum() >= demand @ sizes / 17 - 1e-6


@settings(max_examples=60, deadline=None)
@given(st.dictionaries(st.integers(1, 64), st.integers(1, 500), max_size=20))
def test_patterns_take_every_piece_once(histogram):
    plan = patterns(histogram, 64)
    taken = {}
    for pattern, times in plan:
        assert times > 0 and sum(size * n for size, n in pattern.items()) <= 64
        for size, n in pattern.items():
            taken[size] = taken.get(size, 0) + n * times
    assert taken == histogram


def check(result, docs):
    """Every property of the contract; returns padded tokens per token."""
    want = sorted((str(i), tuple(plain(t))) for i, t in docs)
    rows = result.collect()
    of = {}
    for r in sorted(rows, key=lambda r: (str(r["doc_id"]), r["start"])):
        of.setdefault(str(r["doc_id"]), []).append(r)
    assert set(of) == {i for i, _ in want}
    for doc, group in groupby(want, key=lambda w: w[0]):
        texts = [ids for _, ids in group]
        if len(texts) > 1:
            assert sorted(r["doc_tokens"] for r in of[doc] if r["start"] == 0) == sorted(map(len, texts))
            continue
        at = 0
        for r in of[doc]:
            assert r["start"] == at and r["length"] > 0 and r["doc_tokens"] == len(texts[0])
            piece = np.array(texts[0][at:at + r["length"]], "<u4")
            assert r["ids_crc32"] == zlib.crc32(piece.tobytes())
            at += r["length"]
        assert at == len(texts[0])
    padded = total = 0
    by_sequence = {}
    for r in rows:
        by_sequence.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for pieces in by_sequence.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= CAPACITY and (at >= CAPACITY * MIN_FILL or at.bit_count() == 1)
        total += at
        padded += at if at.bit_count() == 1 else CAPACITY
    assert total == sum(len(ids) for _, ids in want)
    return padded / total if total else 1


def frame(spark, docs):
    clash = ("'x' AS id", "1 AS row", "2 AS start", "3 AS size", "4 AS bucket", "5 AS sequence", "6 AS tokens", "7 AS ids")
    return spark.createDataFrame(docs, "doc_id long, text string").selectExpr("*", *clash)


def test_packing(spark, tmp_path, monkeypatch):
    rng = np.random.default_rng(7)
    words = ["alpha", "Beta,", "gämma", "d'll", "42", "(x)"]
    docs = [(i, " ".join(rng.choice(words, int(n)))) for i, n in enumerate(rng.lognormal(5, 1.5, 300))]
    docs += [(1000 + i, "the same text again " * 40) for i in range(150)]  # one class holds a third
    docs += [(2000, None), (2001, ""), (2002, " \n"), (2003, "word " * 30_000), (2004, "x" * 20_000), (2005, "a <|endoftext|> b")]
    docs += [(2006, "word " * 4095), (2007, "word " * 8191), (None, "no id"), (7, "twice"), (7, "twice two")]
    frame(spark, docs).repartition(5).write.parquet(str(tmp_path / "documents.parquet"))
    monkeypatch.setattr(packing, "RANKED_AT_ONCE", 40)
    result = op12_pack(spark, str(tmp_path))
    assert result.columns == ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    assert check(result, docs) < 1.01


@pytest.mark.parametrize("docs", [[], [(1, None)], [(1, "one two three")], [(i, "word " * 2500) for i in range(5)]])
def test_small_tables(spark, tmp_path, docs):
    frame(spark, docs).write.parquet(str(tmp_path / "documents.parquet"))
    assert check(op12_pack(spark, str(tmp_path)), docs) == 1  # all of a power of two, or full


def test_sequences_hold_the_tokens(spark):
    docs = [(i, f"text number {i} " * (20 * i + 1)) for i in range(40)]
    packed = pack(frame(spark, docs), PATH)
    for s in sequences(packed).collect():
        ids = np.frombuffer(bytes(s["ids"]), "<u4").tolist()
        assert len(ids) == s["length"] and s["padded_to"] == (s["length"] if s["length"].bit_count() == 1 else CAPACITY)
        at = 0
        for doc, start, length, offset in s["documents"]:
            assert offset == at and ids[at:at + length] == plain(docs[doc][1])[start:start + length]
            at += length
        assert at == len(ids)
