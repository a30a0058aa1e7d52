"""Hidden Markov language model over whole documents.

A document is the sequence of its words and one end. The model emits symbols: the HEAD most frequent
tokens and the end are symbols of their own, every other token shows its class (length and kind of
ending) and is then drawn from the class by its smoothed count. Baum-Welch trains start,
transition and emission probabilities: each task adds up expected counts over its training
documents, the sums of all tasks make the next model. The scaled forward recursion gives the exact
likelihood of the whole sequence, whatever its length.

Counts cover every training token. Those of the COMMON most frequent tokens or somewhat fewer, a bounded table, go to all
tasks; the occurrences of all others meet their counts in a join, so that neither the
vocabulary nor a frequent word weighs on one place. Tokens are known by a 64-bit hash.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bazaarlake.llm.shared import as_bytes, checkpointed, small_batches, space_words

STATES = 8
HEAD = 4096
CLASSES = 64
COMMON = 1 << 18
ITERATIONS = 4
# Training sequences: passages of this many symbols. Only scoring needs the whole text at once.
PASSAGE = 1024
# Symbols worked on at a time, and text bytes tokenised at a time.
BATCH_SYMBOLS = 1 << 20
CHUNK_BYTES = 4 << 20
COUNTS_HELD = 1 << 20
END = b""
SYMBOLS = 1 + HEAD + CLASSES


def token_class(token: bytes) -> int:
    """Of a token other than the end: its length up to 15, and how it ends."""
    last = token[-1]
    letter = last >= 0x80 or 0x61 <= last <= 0x7A
    kind = 0 if letter else 1 if last in b".!?" else 2 if last in b",;:" else 3
    return min(len(token), 15) * 4 + kind


class Chunk:
    """Some documents as numbers: the distinct tokens with hashes and classes, the
    sequences of all documents on end, each closed by the end token (number 0)."""

    def __init__(self, texts: list[bytes | None]):
        number: dict[bytes, int] = {END: 0}
        ids: list[int] = []
        ends = []
        for text in texts:
            ids += [number.setdefault(w, len(number)) for w in space_words(text)]
            ids.append(0)
            ends.append(len(ids))
        self.ids = np.array(ids, np.int64)
        self.ends = np.array(ends, np.int64)
        self.starts = np.concatenate(([0], self.ends[:-1])).astype(np.int64)
        self.hashes = np.array([xxhash.xxh3_64_intdigest(t) for t in number], np.uint64).view(np.int64)
        self.classes = np.array([0] + [token_class(t) for t in list(number)[1:]], np.int64)
        self.size = len(number)


def _chunks(texts: list[bytes | None]) -> Iterator[tuple[int, Chunk]]:
    """(first row, chunk): rows cut by bytes of text."""
    first, size = 0, 0
    for i, text in enumerate(texts):
        if size + len(text or b"") > CHUNK_BYTES and i > first:
            yield first, Chunk(texts[first:i])
            first, size = i, 0
        size += len(text or b"")
    if first < len(texts):
        yield first, Chunk(texts[first:])


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(hash, class, count): tokens combined per task, in tables of a bounded size."""

    def out() -> pa.RecordBatch:
        keys = np.fromiter(held, np.int64, len(held))
        values = np.array(list(held.values()), np.int64).reshape(-1, 2)
        return pa.RecordBatch.from_arrays(
            [pa.array(keys), pa.array(values[:, 0].astype(np.int32)), pa.array(values[:, 1])],
            names=["hash", "class", "n"],
        )

    held: dict[int, tuple[int, int]] = {}
    for batch in batches:
        for _, chunk in _chunks(as_bytes(batch.column(0))):
            n = np.bincount(chunk.ids, minlength=chunk.size)
            for h, c, k in zip(chunk.hashes.tolist(), chunk.classes.tolist(), n.tolist()):
                old = held.get(h)
                held[h] = (c, k if old is None else old[1] + k)
            if len(held) > COUNTS_HELD:
                yield out()
                held = {}
    yield out()


@dataclass
class Lexicon:
    """The bounded part of the counts: common tokens by hash, totals, and per class what is not head."""

    hashes: np.ndarray  # sorted
    counts: np.ndarray
    symbols: np.ndarray
    tokens: int
    words: int
    class_tokens: np.ndarray
    class_words: np.ndarray

    def find(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(place, whether it is there) of each hash among the common tokens."""
        if not len(self.hashes):
            return np.zeros(len(hashes), np.int64), np.zeros(len(hashes), bool)
        at = np.minimum(np.searchsorted(self.hashes, hashes), len(self.hashes) - 1)
        return at, self.hashes[at] == hashes

    def symbols_of(self, chunk: Chunk) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Per distinct token: symbol, count, and whether it is common."""
        at, there = self.find(chunk.hashes)
        own = np.where(there, self.symbols[at] if len(self.symbols) else -1, -1)
        symbol = np.where(own >= 0, own, 1 + HEAD + chunk.classes)
        symbol[0] = 0
        count = np.where(there, self.counts[at] if len(self.counts) else 0, 0)
        return symbol, count, there

    def class_log(self) -> np.ndarray:
        """log10 of the denominator of a class's distribution: its tokens, and one never seen."""
        return np.log10(self.class_tokens + 0.5 * (self.class_words + 1))

    def base_log(self) -> float:
        return math.log10(self.tokens + 0.5 * (self.words + 1))


END_HASH = int(np.array([xxhash.xxh3_64_intdigest(END)], np.uint64).view(np.int64)[0])


def lexicon(counts: DataFrame) -> Lexicon:
    """From (hash, class, n) of all training tokens."""
    total = counts.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()
    # The smallest count for which the table is not too large, from counts of counts in classes of a
    # 32nd of a doubling: no sort, and nothing to the driver but two thousand rows.
    size = F.floor(F.log2("n") * 32).cast("int")
    classes = counts.groupBy(size.alias("size")).agg(F.count("*").alias("words")).collect()
    room, least = COMMON, 1 << 30
    for r in sorted(classes, key=lambda r: -r["size"]):
        room -= r["words"]
        if room < 0:
            break
        least = r["size"]
    top = (
        counts.where((size >= least) | (F.col("hash") == END_HASH))
        .toPandas()
        .sort_values(["n", "hash"], ascending=[False, True], ignore_index=True)
    )
    words = top[top["hash"] != END_HASH]
    head = words.head(HEAD)
    symbol = np.full(len(top), -1, np.int64)
    symbol[head.index.to_numpy()] = 1 + np.arange(len(head))
    symbol[(top["hash"] == END_HASH).to_numpy()] = 0
    class_tokens, class_words = np.zeros(CLASSES), np.zeros(CLASSES)
    for r in counts.where(F.col("hash") != END_HASH).groupBy("class").agg(F.sum("n").alias("n"), F.count("*").alias("w")).collect():
        class_tokens[r["class"]], class_words[r["class"]] = r["n"], r["w"]
    np.subtract.at(class_tokens, head["class"].to_numpy(), head["n"].to_numpy())
    np.subtract.at(class_words, head["class"].to_numpy(), 1)
    order = np.argsort(top["hash"].to_numpy())
    return Lexicon(
        top["hash"].to_numpy()[order],
        top["n"].to_numpy()[order],
        symbol[order],
        int(total[0]),
        int(total[1]),
        class_tokens,
        class_words,
    )


ENCODED = "struct<symbols: array<smallint>, n_tokens: bigint, known: bigint, log_counts: double, rare: bigint, inside: double>"


def _encoder(lex: Lexicon):
    """Per text: its symbols; of its common tokens how many there are and the sum of log10(c + 0.5); how
    many are not common; and what the classes add to the score, but for the counts of tokens
    that are not common."""

    @F.arrow_udf(ENCODED)
    def encode(texts: pa.Array) -> pa.Array:
        class_log = lex.class_log()
        symbols, n, known, logs, rare, inside = [], [], [], [], [], []
        for _, chunk in _chunks(as_bytes(texts)):
            symbol, count, there = lex.symbols_of(chunk)
            log_count = np.where(there, np.log10(count + 0.5), 0.0)
            in_class = symbol > HEAD
            add = np.where(in_class, log_count - class_log[chunk.classes], 0.0)
            ids, starts = chunk.ids, chunk.starts
            seq = symbol[ids].astype(np.int16)
            symbols += [seq[a:b] for a, b in zip(starts, chunk.ends)]
            n.append(chunk.ends - starts)
            known.append(np.add.reduceat((there & (count > 0))[ids].astype(np.int64), starts))
            logs.append(np.add.reduceat(log_count[ids], starts))
            rare.append(np.add.reduceat((~there)[ids].astype(np.int64), starts))
            inside.append(np.add.reduceat(add[ids], starts))
        join = lambda parts, t: pa.array(np.concatenate(parts) if parts else np.zeros(0), t)
        return pa.StructArray.from_arrays(
            [
                pa.array(symbols, pa.list_(pa.int16())),
                join(n, pa.int64()),
                join(known, pa.int64()),
                join(logs, pa.float64()),
                join(rare, pa.int64()),
                join(inside, pa.float64()),
            ],
            names=["symbols", "n_tokens", "known", "log_counts", "rare", "inside"],
        )

    return encode


def _rare_tokens(lex: Lexicon):
    """(row_key, hash, n): the tokens of each row that are not common."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = batch.column(0).to_numpy(zero_copy_only=False)
            for first, chunk in _chunks(as_bytes(batch.column(1))):
                _, there = lex.find(chunk.hashes)
                there[0] = True  # the end has its own count
                owner = np.repeat(np.arange(len(chunk.ends)), chunk.ends - chunk.starts)
                some = ~there[chunk.ids]
                pair, n = np.unique(owner[some] * chunk.size + chunk.ids[some], return_counts=True)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(keys[first + pair // chunk.size]),
                        pa.array(chunk.hashes[pair % chunk.size]),
                        pa.array(n.astype(np.int64)),
                    ],
                    names=["row_key", "hash", "n"],
                )

    return run


@dataclass
class Hmm:
    start: np.ndarray  # states
    move: np.ndarray  # states x states
    emit: np.ndarray  # symbols x states

    def stationary(self) -> np.ndarray:
        p = self.start
        for _ in range(200):
            p = p @ self.move
        return p / p.sum()


def first_model(counts: np.ndarray, states: int = STATES, seed: int = 10) -> Hmm:
    """Symbol frequencies, tilted at random in every state so that states can part."""
    rng = np.random.default_rng(seed)
    emit = counts[:, None] * rng.uniform(0.5, 1.5, (len(counts), states))
    move = rng.uniform(0.5, 1.5, (states, states)) + np.eye(states)
    return Hmm(
        np.full(states, 1 / states), move / move.sum(axis=1, keepdims=True), emit / emit.sum(axis=0)
    )


def _groups(sequences: list[np.ndarray]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(rows, padded symbols by time, lengths): sequences by falling length, so that those still
    running at any time are the first ones."""
    length = np.array([len(s) for s in sequences], np.int64)
    order = np.argsort(-length, kind="stable")
    order = order[length[order] > 0]
    at = 0
    while at < len(order):
        longest = int(length[order[at]])
        take = max(1, BATCH_SYMBOLS // longest)
        rows = order[at : at + take]
        padded = np.zeros((longest, len(rows)), np.int64)
        for i, r in enumerate(rows):
            padded[: length[r], i] = sequences[r]
        yield rows, padded, length[rows]
        at += take


def _active(length: np.ndarray, steps: int) -> np.ndarray:
    """How many sequences are longer than t, for each t."""
    return np.searchsorted(-length, -np.arange(steps), side="left")


def log_likelihoods(model: Hmm, sequences: list[np.ndarray]) -> np.ndarray:
    """Natural log of each sequence's probability by the scaled forward recursion; 0 if empty."""
    out = np.zeros(len(sequences))
    for rows, padded, length in _groups(sequences):
        active = _active(length, len(padded))
        total = np.zeros(len(rows))
        a = model.start * model.emit[padded[0]]
        for t in range(len(padded)):
            n = active[t]
            if t:
                a = (a[:n] @ model.move) * model.emit[padded[t, :n]]
            scale = a.sum(axis=1)
            a = a / scale[:, None]
            total[:n] += np.log(scale)
        out[rows] = total
    return out


def expected_counts(model: Hmm, sequences: list[np.ndarray], first: list[bool]) -> tuple:
    """(starts, moves, emissions, log likelihood) by forward and backward recursion. A
    sequence that is not the first of its document starts from the stationary distribution and
    adds nothing to the starts."""
    states = len(model.start)
    starts, moves = np.zeros(states), np.zeros((states, states))
    emits = np.zeros((len(model.emit), states))
    likelihood = 0.0
    initial = np.where(np.array(first, bool)[:, None], model.start, model.stationary())
    first = np.array(first, bool)
    for rows, padded, length in _groups(sequences):
        steps = len(padded)
        active = _active(length, steps)
        alpha, scales = [], []
        for t in range(steps):
            n = active[t]
            before = initial[rows] if t == 0 else alpha[-1][:n] @ model.move
            a = before * model.emit[padded[t, :n]]
            scale = a.sum(axis=1)
            alpha.append(a / scale[:, None])
            scales.append(scale)
            likelihood += float(np.log(scale).sum())
        beta = np.ones((active[-1], states))
        for t in range(steps - 1, -1, -1):
            n = active[t]
            alpha[t] *= beta  # now the probability of each state at t
            if t == 0:
                starts += alpha[0][first[rows]].sum(axis=0)
                break
            ahead = model.emit[padded[t, :n]] * beta / scales[t][:, None]
            moves += alpha[t - 1][:n].T @ ahead
            beta = np.ones((active[t - 1], states))
            beta[:n] = ahead @ model.move.T
        symbols = np.concatenate([padded[t, : active[t]] for t in range(steps)])
        gamma = np.concatenate(alpha)
        for s in range(states):
            emits[:, s] += np.bincount(symbols, weights=gamma[:, s], minlength=len(emits))
    return starts, moves * model.move, emits, likelihood


def _expect(model: Hmm):
    """Expected counts of one task as (cell, value); cells in the order starts, moves, emissions."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            column = batch.column(0)
            values = column.flatten().to_numpy(zero_copy_only=False)
            at = np.concatenate(([0], np.cumsum(column.value_lengths().to_numpy(zero_copy_only=False))))
            sequences, first = [], []
            for a, b in zip(at[:-1], at[1:]):
                for c in range(a, b, PASSAGE):
                    sequences.append(values[c : min(b, c + PASSAGE)])
                    first.append(c == a)
            if sequences:
                s, m, e, _ = expected_counts(model, sequences, first)
                part = np.concatenate([s, m.ravel(), e.ravel()])
                total = part if total is None else total + part
        if total is not None:
            some = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some])], names=["cell", "value"])

    return run


def _next(model: Hmm, sums: np.ndarray, frequency: np.ndarray) -> Hmm:
    states, symbols = len(model.start), len(model.emit)
    start = sums[:states] + 1e-3
    move = sums[states : states + states * states].reshape(states, states) + 1e-3
    # One more symbol, in the shares of the corpus, keeps all of them possible in every state.
    emit = sums[states + states * states :].reshape(symbols, states) + frequency[:, None]
    return Hmm(start / start.sum(), move / move.sum(axis=1, keepdims=True), emit / emit.sum(axis=0))


def train(encoded: DataFrame, lex: Lexicon, iterations: int = ITERATIONS) -> Hmm:
    """Baum-Welch over a column `symbols`. Each round sends SYMBOLS * STATES sums to the driver."""
    # What training has not seen can only be the end or a class; symbols no word has stay at 0.
    frequency = np.zeros(SYMBOLS)
    own = lex.symbols >= 0
    frequency[lex.symbols[own]] = lex.counts[own]
    frequency[0] += 0.5
    frequency[1 + HEAD :] = lex.class_tokens + 0.5
    model = first_model(frequency)
    share = frequency / frequency.sum()
    for _ in range(iterations):
        rows = (
            encoded.select("symbols")
            .mapInArrow(_expect(model), "cell bigint, value double")
            .groupBy("cell")
            .agg(F.sum("value").alias("value"))
            .toPandas()
        )
        sums = np.zeros(STATES + STATES * STATES + SYMBOLS * STATES)
        sums[rows["cell"].to_numpy(dtype=np.int64)] = rows["value"].to_numpy(dtype=float)
        model = _next(model, sums, share)
    return model


def score(
    docs: DataFrame, held_out: F.Column, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score for every row of docs.

    Rows for which held_out is not true are learned from. base_score is the sum over the tokens
    of log10((c + 0.5) / (N + 0.5 (V + 1))), score the model's log10 probability of the sequence.
    Null and empty texts are the end alone. Rows that repeat are scored, and learned from, each.
    Other columns are not read. Without training rows every token is new: base_score 0, and
    the untrained model's score; without rows there are none.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = small_batches(docs).select(
        F.col(id_col).alias("doc_id"), F.coalesce(held_out, F.lit(False)).alias("held_out"), text.alias("text")
    ).withColumn("row_key", F.xxhash64("doc_id", "text"))
    counts = checkpointed(
        rows.where(~F.col("held_out"))
        .select("text")
        .mapInArrow(_count, "hash bigint, class int, n bigint")
        .groupBy("hash")
        .agg(F.min("class").alias("class"), F.sum("n").alias("n"))
        .where("n > 0")
    )
    lex = lexicon(counts)
    encoded = checkpointed(
        rows.withColumn("e", _encoder(lex)("text")).select("doc_id", "held_out", "row_key", "e.*")
    )
    model = train(encoded.where(~F.col("held_out")), lex)

    @F.arrow_udf("double")
    def forward(symbols: pa.Array) -> pa.Array:
        values = symbols.flatten().to_numpy(zero_copy_only=False)
        cuts = np.cumsum(symbols.value_lengths().to_numpy(zero_copy_only=False))[:-1]
        return pa.array(log_likelihoods(model, np.split(values, cuts)) / math.log(10))

    scored = encoded.withColumn("forward", forward("symbols")).drop("symbols")
    rare = rows.select("row_key", "text").mapInArrow(_rare_tokens(lex), "row_key bigint, hash bigint, n bigint")
    seen = rare.join(counts.select("hash", F.col("n").alias("c")), "hash")
    found = seen.groupBy("row_key").agg(
        F.sum("n").alias("seen"), F.sum(F.col("n") * F.log10(F.col("c") + 0.5)).alias("seen_log")
    )
    times = encoded.groupBy("row_key").agg(F.count("*").alias("times"))
    found = found.join(times, "row_key").select(
        "row_key", (F.col("seen") / F.col("times")).alias("seen"), (F.col("seen_log") / F.col("times")).alias("seen_log")
    )
    seen_n = F.coalesce("seen", F.lit(0.0))
    # Tokens that are not common: those in the counts, and new ones with c = 0.
    rare_log = F.coalesce("seen_log", F.lit(0.0)) + (F.col("rare") - seen_n) * F.lit(math.log10(0.5))
    return scored.join(found, "row_key", "left").select(
        "doc_id",
        "held_out",
        "n_tokens",
        (F.col("known") + F.round(seen_n)).cast("bigint").alias("n_known"),
        F.lit(lex.tokens).cast("bigint").alias("train_tokens"),
        (F.col("log_counts") + rare_log - F.col("n_tokens") * F.lit(lex.base_log())).alias("base_score"),
        (F.col("forward") + F.col("inside") + rare_log).alias("score"),
    )
