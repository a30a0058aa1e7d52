"""Collocations from n-gram counts held in counting quotient filters.

Words become ids of ID_BITS bits, an n-gram of them one integer. A Feistel network permutes
that integer invertibly, so equal n-grams meet and the values spread evenly, yet nothing is lost: the
highest bits name the segment, the next ones (the quotient) a place in the filter, and the whole rest
is the remainder that is stored. A filter holds its remainders in the order of their values, a bit per
quotient in use, a bit per end of a run, and counters only where a count is above one. Each task writes
filters of its documents; those of one segment are merged like sorted lists, and every n-gram of the
merged filter comes back through the inverse permutation with its exact count.

Three passes over the texts keep the filters small without changing a result. A phrase that occurs
MIN_COUNT times has parts that occur as often, so word pairs are only counted between words that do, and
triples only where both pairs do. What occurs often enough goes to the tasks as a bitmap of bounded
size; where it holds too much for its size it lets more n-grams through, which costs work and nothing else.

Two words with one id would be mixed up. The word table shows which ids they are; ids shared with a
frequent word are replaced by reserved ones, and counts of ids that only rare words share cannot reach
the result, since it is joined with the frequent words.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from bazaarlake.llm.shared import INT, LONG, TEXT, T, as_bytes, checkpointed, small_batches, struct

MIN_COUNT = 10
TOP = 2000
ABSORBED = 50  # percent of a phrase's occurrences inside one longer phrase
SCORE_SCALE = 1_000_000
NO_LANG = "und"

# Ids: 41 bits of a hash; reserved ones have the 42nd bit.
ID_BITS = 42
HASHED = (1 << (ID_BITS - 1)) - 1
SEED = 42  # of Spark's xxhash64
# Per task: n-grams and words held before a filter is written; ids of words within one task.
HELD = 1 << 20
WORDS_AT_ONCE = 1 << 19
LOCAL_BITS = 21
WORDS_PER_SEGMENT = 4_000_000
BITMAP_BITS = range(16, 29)  # 2^28 bits are 32 MB

# A-Z to a-z; what ends a piece becomes a line break, which no word holds; tabs become spaces.
_TEXT = bytes(
    0x0A if chr(b) in ".,;:!?\n\x0b\x0c\r" else 0x20 if b == 0x09 else b + 32 if 0x41 <= b <= 0x5A else b
    for b in range(256)
)
U64 = np.uint64
MASK64 = (1 << 64) - 1


# The invertible permutation ---------------------------------------------------


def _mix(x: np.ndarray) -> np.ndarray:
    """Spreads 64 bits over 64 bits (multiply and shift, twice)."""
    x = (x ^ (x >> U64(32))) * U64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> U64(32))) * U64(0xD6E8FEB86659FD93)
    return x ^ (x >> U64(32))


_ROUND_KEYS = [U64((i + 1) * 0x9E3779B97F4A7C15 & MASK64) for i in range(4)]


def permuted(high: np.ndarray, low: np.ndarray, half: int) -> tuple[np.ndarray, np.ndarray]:
    """Four Feistel rounds over two halves of `half` bits."""
    cut = U64(64 - half)
    for first, second in zip(_ROUND_KEYS[::2], _ROUND_KEYS[1::2]):
        high = high ^ (_mix(low + first) >> cut)
        low = low ^ (_mix(high + second) >> cut)
    return high, low


def restored(high: np.ndarray, low: np.ndarray, half: int) -> tuple[np.ndarray, np.ndarray]:
    """The inverse of permuted."""
    cut = U64(64 - half)
    for first, second in zip(_ROUND_KEYS[-2::-2], _ROUND_KEYS[::-2]):
        low = low ^ (_mix(high + second) >> cut)
        high = high ^ (_mix(low + first) >> cut)
    return high, low


def half_bits(order: int) -> int:
    return order * ID_BITS // 2


def packed(ids: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Two or three ids in two halves: the middle one of three is split between them."""
    if len(ids) == 2:
        return ids[0], ids[1]
    a, b, c = ids
    return (a << U64(21)) | (b >> U64(21)), ((b & U64((1 << 21) - 1)) << U64(ID_BITS)) | c


def unpacked(high: np.ndarray, low: np.ndarray, order: int) -> list[np.ndarray]:
    if order == 2:
        return [high, low]
    middle = ((high & U64((1 << 21) - 1)) << U64(21)) | (low >> U64(ID_BITS))
    return [high >> U64(21), middle, low & U64((1 << ID_BITS) - 1)]


# The filter -------------------------------------------------------------------


def _bits(flags: np.ndarray) -> bytes:
    return np.packbits(flags).tobytes()


def _flags(data: bytes, start: int, n: int) -> tuple[np.ndarray, int]:
    size = (n + 7) // 8
    return np.unpackbits(np.frombuffer(data, np.uint8, size, start), count=n).astype(bool), start + size


def _lowest_bytes(values: np.ndarray, size: int) -> bytes:
    return np.ascontiguousarray(values.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :size]).tobytes()


def _from_lowest_bytes(data: bytes, start: int, n: int, size: int) -> tuple[np.ndarray, int]:
    out = np.zeros((n, 8), np.uint8)
    out[:, :size] = np.frombuffer(data, np.uint8, n * size, start).reshape(n, size)
    return out.view("<u8").reshape(n), start + n * size


def encode(high: np.ndarray, low: np.ndarray, counts: np.ndarray, half: int, prefix: int) -> bytes:
    """A filter of distinct values in ascending order, all of which share their first `prefix` bits.

    The quotient takes as many bits as leave whole bytes of the upper half, at most eight quotients
    per value. Counts above one are stored as one byte, those above 256 as eight more.
    """
    n = len(high)
    within = half - prefix
    rest_bytes = min(-(-max(0, within - max(0, (8 * n).bit_length() - 1)) // 8), within // 8)
    quotient = (high & U64((1 << within) - 1)) >> U64(8 * rest_bytes)
    occupied = np.zeros(1 << (within - 8 * rest_bytes), bool)
    occupied[quotient] = True
    run_end = np.ones(n, bool)
    run_end[:-1] = quotient[1:] != quotient[:-1]
    repeated = counts > 1
    more = counts[repeated]
    return b"".join(
        (
            np.array([n, half, prefix, rest_bytes], "<u8").tobytes(),
            _bits(occupied),
            _bits(run_end),
            _bits(repeated),
            np.minimum(more - U64(2), U64(255)).astype(np.uint8).tobytes(),
            more[more > 256].astype("<u8").tobytes(),
            _lowest_bytes(high, rest_bytes),
            _lowest_bytes(low, (half + 7) // 8),
        )
    )


def decode(data: bytes, segment: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The values of a filter in ascending order, and their counts."""
    n, half, prefix, rest_bytes = (int(x) for x in np.frombuffer(data, "<u8", 4))
    within = half - prefix
    occupied, at = _flags(data, 32, 1 << (within - 8 * rest_bytes))
    run_end, at = _flags(data, at, n)
    repeated, at = _flags(data, at, n)
    more = np.frombuffer(data, np.uint8, int(repeated.sum()), at).astype(np.uint64) + U64(2)
    at += len(more)
    large = np.frombuffer(data, "<u8", int((more == 257).sum()), at)
    at += 8 * len(large)
    more[more == 257] = large
    counts = np.ones(n, U64)
    counts[repeated] = more
    upper, at = _from_lowest_bytes(data, at, n, rest_bytes)
    low, at = _from_lowest_bytes(data, at, n, (half + 7) // 8)
    # The i-th value lies in the run after as many as ended before it.
    run = np.cumsum(run_end) - run_end
    quotient = np.flatnonzero(occupied).astype(U64)[run]
    return upper | (quotient << U64(8 * rest_bytes)) | U64(segment << within), low, counts


def merged(parts: list[tuple]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sorted lists of values with counts as one, equal values added up."""
    high, low, counts = (np.concatenate(columns) for columns in zip(*parts))
    # A stable sort merges the sorted runs it finds.
    order = np.argsort(high, kind="stable")
    tied = high[order[1:]] == high[order[:-1]]
    if (low[order[1:]][tied] < low[order[:-1]][tied]).any():
        order = np.lexsort((low, high))
    high, low = high[order], low[order]
    first = np.ones(len(high), bool)
    first[1:] = (high[1:] != high[:-1]) | (low[1:] != low[:-1])
    starts = np.flatnonzero(first)
    return high[first], low[first], np.add.reduceat(counts[order], starts) if len(starts) else counts


# Words ------------------------------------------------------------------------


class _Ids(dict):
    """Word to number within a task: 0 ends a piece, words from 1 on."""

    def __init__(self) -> None:
        super().__init__({b"\n": 0})

    def __missing__(self, word: bytes) -> int:
        self[word] = number = len(self)
        return number

    def numbers(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.int64, len(words))


def words_of(texts: list[bytes]) -> list[bytes]:
    """The words of all texts, a line break between pieces and texts and on both ends."""
    joined = b"\n".join((b"", *texts, b""))
    return list(filter(None, joined.translate(_TEXT).replace(b"\n", b" \n ").split(b" ")))


def hashed(word: bytes) -> int:
    return xxhash.xxh64_intdigest(word, SEED) & HASHED


def _by_lang(batch: pa.RecordBatch) -> Iterator[tuple[str, list[bytes]]]:
    groups: dict[str, list[bytes]] = {}
    for lang, text in zip(batch.column("lang").to_pylist(), as_bytes(batch.column("text"))):
        if text:
            groups.setdefault(lang, []).append(text)
    yield from groups.items()


def _docs(docs: DataFrame, lang_col: str, text_col: str) -> DataFrame:
    lang = F.coalesce(F.col(f"`{lang_col}`").cast("string"), F.lit(NO_LANG)).alias("lang")
    return small_batches(docs.select(lang, F.col(f"`{text_col}`").alias("text")))


def word_counts(docs: DataFrame, lang_col: str = "lang", text_col: str = "text") -> DataFrame:
    """lang, word, n: occurrences of every word, counted in each task first."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, tuple[_Ids, np.ndarray]] = {}

        def rows() -> Iterator[pa.RecordBatch]:
            for lang, (ids, total) in held.items():
                words = list(ids)
                for i in range(1, len(words), 10_000):
                    part = words[i : i + 10_000]
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array([lang] * len(part), pa.string()),
                            pa.array(part, pa.binary()).cast(pa.string()),
                            pa.array(total[i : i + len(part)], pa.int64()),
                        ],
                        ["lang", "word", "n"],
                    )
            held.clear()

        for batch in batches:
            for lang, texts in _by_lang(batch):
                ids, total = held.get(lang) or (_Ids(), np.zeros(1, np.int64))
                numbers = ids.numbers(words_of(texts))
                added = np.bincount(numbers, minlength=len(ids))
                added[: len(total)] += total
                held[lang] = ids, added
            if sum(len(ids) for ids, _ in held.values()) > HELD // 4:
                yield from rows()
        yield from rows()

    local = _docs(docs, lang_col, text_col).mapInArrow(count, struct(lang=TEXT, word=TEXT, n=LONG))
    return local.groupBy("lang", "word").agg(F.sum("n").alias("n"))


# Bitmaps ----------------------------------------------------------------------


def _lang_key(lang: str) -> np.uint64:
    return U64(xxhash.xxh64_intdigest(lang.encode(), SEED))


def _mark(lang_key: np.uint64, *ids: np.ndarray) -> np.ndarray:
    value = np.full(len(ids[0]), lang_key, U64)
    for x in ids:
        value = _mix(value + x)
    return value


class Bitmap:
    """A set of n-grams that answers yes for each of them, and for few others while it is sparse."""

    def __init__(self, frequent: DataFrame, columns: list[str]):
        self.bits = bits = min(max((32 * frequent.count()).bit_length(), BITMAP_BITS[0]), BITMAP_BITS[-1])

        def places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                ids = [batch.column(c).to_numpy(zero_copy_only=False).astype(U64) for c in columns]
                langs = np.array(batch.column("lang").to_pylist(), dtype=object)
                for lang in set(langs):
                    of = langs == lang
                    place = _mark(_lang_key(lang), *[x[of] for x in ids]) >> U64(64 - bits)
                    yield pa.RecordBatch.from_arrays([pa.array(place.astype(np.int64))], ["place"])

        # Spark counts places from 1, in buckets of 2^15.
        place = F.col("place") + 1
        blocks = (
            frequent.select("lang", *columns)
            .mapInArrow(places, struct(place=LONG))
            .groupBy(F.bitmap_bucket_number(place).alias("bucket"))
            .agg(F.bitmap_construct_agg(F.bitmap_bit_position(place)).alias("bitmap"))
            .collect()
        )
        data = np.zeros((1 << bits) // 8, np.uint8)
        for r in blocks:
            start = (r["bucket"] - 1) << 12
            data[start : start + (1 << 12)] = np.frombuffer(r["bitmap"], np.uint8)
        self.shared = frequent.sparkSession.sparkContext.broadcast(data.tobytes())

    def test(self, marks: np.ndarray) -> np.ndarray:
        data = np.frombuffer(self.shared.value, np.uint8)
        place = marks >> U64(64 - self.bits)
        return (data[place >> U64(3)] >> (place & U64(7)).astype(np.uint8)) & 1 == 1


# Counting ---------------------------------------------------------------------


class _Counter:
    """The n-grams of a task by language, as numbers of its own words, and the filters made of them."""

    def __init__(self, order: int, allowed: Bitmap, replaced: dict[bytes, int], segments_log2: int):
        self.order, self.allowed, self.replaced, self.segments_log2 = order, allowed, replaced, segments_log2
        self.clear()

    def clear(self) -> None:
        self.ids, self.word = _Ids(), np.zeros(1, U64)
        self.held: dict[str, list[tuple[np.ndarray, np.ndarray]]] = {}
        self.entries = 0

    def full_with(self, words: int) -> bool:
        """Whether so many words more might not have numbers, or too much is held."""
        if self.entries > HELD:
            self.shrink()
        return self.entries > HELD or len(self.ids) + words > 1 << LOCAL_BITS

    def add(self, lang: str, words: list[bytes]) -> None:
        numbers = self.ids.numbers(words)
        new = islice(self.ids, len(self.word), None)
        fresh = np.array([self.replaced.get(w) or hashed(w) for w in new], dtype=U64)
        self.word = np.concatenate((self.word, fresh))
        # Runs of words whose parts are frequent.
        good, key = numbers > 0, _lang_key(lang)
        if self.order == 3:
            good = good[:-1] & good[1:]
        at = np.flatnonzero(good)
        parts = [self.word[numbers[at + i]] for i in range(self.order - 1)]
        good[at] = self.allowed.test(_mark(key, *parts))
        at = np.flatnonzero(good[:-1] & good[1:])
        if not len(at):
            return
        gram = np.zeros(len(at), U64)
        for i in range(self.order):
            gram = (gram << U64(LOCAL_BITS)) | numbers[at + i].astype(U64)
        self.held.setdefault(lang, []).append(np.unique(gram, return_counts=True))
        self.entries += len(self.held[lang][-1][0])

    def shrink(self) -> None:
        for lang, parts in self.held.items():
            if len(parts) > 1:
                gram, count = (np.concatenate(columns) for columns in zip(*parts))
                by = np.argsort(gram, kind="stable")
                gram = gram[by]
                starts = np.flatnonzero(np.concatenate(([True], gram[1:] != gram[:-1])))
                self.held[lang] = [(gram[starts], np.add.reduceat(count[by], starts))]
        self.entries = sum(len(parts[0][0]) for parts in self.held.values())

    def filters(self) -> Iterator[pa.RecordBatch]:
        """One filter per language and segment; nothing is held afterwards."""
        self.shrink()
        half, own = half_bits(self.order), U64((1 << LOCAL_BITS) - 1)
        for lang, [(gram, count)] in self.held.items():
            shifts = [U64(LOCAL_BITS * i) for i in reversed(range(self.order))]
            high, low = permuted(*packed([self.word[(gram >> s) & own] for s in shifts]), half)
            by = np.lexsort((low, high))
            high, low, count = high[by], low[by], count[by].astype(U64)
            segment = high >> U64(half - self.segments_log2)
            cuts = np.flatnonzero(np.concatenate(([True], segment[1:] != segment[:-1])))
            ends = np.append(cuts[1:], len(segment))
            data = [encode(high[a:b], low[a:b], count[a:b], half, self.segments_log2) for a, b in zip(cuts, ends)]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([lang] * len(cuts), pa.string()),
                    pa.array(segment[cuts].astype(np.int32)),
                    pa.array(data, pa.binary()),
                ],
                ["lang", "segment", "filter"],
            )
        self.clear()


def ngram_counts(
    docs: DataFrame,
    order: int,
    allowed: Bitmap,
    exceptions: dict[bytes, int],
    segments_log2: int,
    lang_col: str = "lang",
    text_col: str = "text",
) -> DataFrame:
    """lang, a, b (, c), n for the n-grams of `order` words that occur MIN_COUNT times or more in
    their language. `allowed` has the frequent (order - 1)-grams."""
    known = docs.sparkSession.sparkContext.broadcast(exceptions)
    names = ["a", "b", "c"][:order]

    def filters(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = _Counter(order, allowed, known.value, segments_log2)
        for batch in batches:
            for lang, texts in _by_lang(batch):
                words = words_of(texts)
                for start in range(0, len(words), WORDS_AT_ONCE):
                    part = words[start : start + WORDS_AT_ONCE + order - 1]
                    if counter.full_with(len(part)):
                        yield from counter.filters()
                    counter.add(lang, part)
        yield from counter.filters()

    def merge(key: tuple, table: pa.Table) -> pa.Table:
        segment = key[1].as_py()
        high, low, count = merged([decode(data, segment) for data in table.column("filter").to_pylist()])
        often = count >= MIN_COUNT
        ids = unpacked(*restored(high[often], low[often], half_bits(order)), order)
        return pa.table(
            {
                "lang": pa.array([key[0].as_py()] * len(ids[0]), pa.string()),
                **{name: pa.array(x.astype(np.int64)) for name, x in zip(names, ids)},
                "n": pa.array(count[often].astype(np.int64)),
            }
        )

    schema = struct(lang=TEXT, segment=INT, filter=T.BinaryType())
    local = _docs(docs, lang_col, text_col).mapInArrow(filters, schema)
    result = struct(lang=TEXT, **dict.fromkeys(names, LONG), n=LONG)
    return local.groupBy("lang", "segment").applyInArrow(merge, result)


# Phrases ----------------------------------------------------------------------


def _frequent_words(words: DataFrame) -> tuple[DataFrame, dict[bytes, int]]:
    """lang, word, id, n of words that occur often enough, and the words whose id is replaced: the
    expected number is the words times the frequent words over 2^41."""
    ids = words.select("lang", "word", "n", F.xxhash64("word").bitwiseAND(HASHED).alias("id"))
    shared = (
        ids.groupBy("id", "word")
        .agg(F.max("n").alias("n"))
        .groupBy("id")
        .agg(F.count("word").alias("words"), F.max("n").alias("n"))
        .where((F.col("words") > 1) & (F.col("n") >= MIN_COUNT))
    )
    clashing = ids.join(shared.select("id"), "id", "left_semi").select("word").distinct()
    numbered = {r["word"].encode(): HASHED + 1 + i for i, r in enumerate(clashing.orderBy("word").collect())}
    frequent = ids.where(F.col("n") >= MIN_COUNT)
    if numbered:
        rows = [(w.decode(), i) for w, i in numbered.items()]
        replaced = words.sparkSession.createDataFrame(rows, "word string, own long")
        frequent = frequent.join(replaced, "word", "left").withColumn("id", F.coalesce("own", "id")).drop("own")
    return frequent.select("lang", "word", "id", "n"), numbered


def _score(left: str, right: str) -> Column:
    """floor(SCORE_SCALE * n^2 / (left * right)) in exact decimals."""
    n, left, right = (f"cast({c} AS decimal(15,0))" for c in ("n", left, right))
    return F.expr(f"({SCORE_SCALE}BD * ({n} * {n})) div ({left} * {right})")


def collocations(docs: DataFrame, lang_col: str = "lang", text_col: str = "text", top: int = TOP) -> DataFrame:
    """Each language's `top` phrases of two and three words: lang, rank, phrase, a, l, r, n, score.

    A null text has no words, a null language is `und`. Words are what stands between spaces and tabs,
    of any length; repeated rows count as often as they stand there. Phrases with equal score and
    count are ranked by their bytes, so no two have one rank. Languages without a phrase that occurs
    MIN_COUNT times, and empty tables, have no rows. Other columns are not read.
    """
    words = checkpointed(word_counts(docs, lang_col, text_col))
    totals = words.groupBy("lang").agg(F.sum("n").alias("n"))
    total = words.agg(F.sum("n")).first()[0] or 0
    segments_log2 = (total // WORDS_PER_SEGMENT).bit_length()
    frequent, exceptions = _frequent_words(words)
    frequent = checkpointed(frequent)
    at = {"exceptions": exceptions, "segments_log2": segments_log2, "lang_col": lang_col, "text_col": text_col}
    twos = checkpointed(ngram_counts(docs, 2, Bitmap(frequent, ["id"]), **at))
    threes = checkpointed(ngram_counts(docs, 3, Bitmap(twos, ["a", "b"]), **at))

    def word(of: str) -> DataFrame:
        return frequent.select("lang", F.col("id").alias(of), F.col("word").alias(f"word_{of}"), F.col("n").alias(f"n_{of}"))

    pairs = twos.join(word("a"), ["lang", "a"]).join(word("b"), ["lang", "b"])
    inside = (
        threes.select("lang", "n", F.explode(F.array(F.struct("a", "b"), F.struct(F.col("b").alias("a"), F.col("c").alias("b")))).alias("p"))
        .groupBy("lang", "p.a", "p.b")
        .agg(F.max("n").alias("longer"))
    )
    two = (
        pairs.join(inside, ["lang", "a", "b"], "left")
        .where(F.coalesce(F.col("longer") * 100 < F.col("n") * ABSORBED, F.lit(True)))
        .select(
            "lang",
            F.concat_ws(" ", "word_a", "word_b").alias("phrase"),
            F.col("n").alias("count"),
            F.col("n_a").alias("l"),
            F.col("n_b").alias("r"),
            _score("n_a", "n_b").alias("score"),
        )
    )
    head = twos.select("lang", "a", "b", F.col("n").alias("n_ab"))
    tail = twos.select("lang", F.col("a").alias("b"), F.col("b").alias("c"), F.col("n").alias("n_bc"))
    cuts = (
        threes.join(word("a"), ["lang", "a"])
        .join(word("b").drop("n_b"), ["lang", "b"])
        .join(word("c"), ["lang", "c"])
        .join(head, ["lang", "a", "b"])
        .join(tail, ["lang", "b", "c"])
        .withColumn("first", _score("n_a", "n_bc"))
        .withColumn("second", _score("n_ab", "n_c"))
    )
    early = F.col("first") <= F.col("second")
    three = cuts.select(
        "lang",
        F.concat_ws(" ", "word_a", "word_b", "word_c").alias("phrase"),
        F.col("n").alias("count"),
        F.when(early, F.col("n_a")).otherwise(F.col("n_ab")).alias("l"),
        F.when(early, F.col("n_bc")).otherwise(F.col("n_c")).alias("r"),
        F.least("first", "second").alias("score"),
    )
    # A limit per language applies in every task before rows of a language meet.
    best = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("count"), "phrase")
    ranked = two.unionByName(three).withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= top)
    return ranked.join(totals, "lang").select(
        "lang",
        F.col("rank").cast("bigint").alias("rank"),
        "phrase",
        F.col("count").alias("a"),
        "l",
        "r",
        "n",
        "score",
    )
