"""Documents packed into token sequences by cutting-stock column generation.

A document is cut into pieces of CAPACITY tokens and a rest. Pieces fall into classes of UNIT
tokens, rounded up; a pattern says how many pieces of each class share a sequence. The linear program
over the histogram of classes minimises the number of sequences: its columns are patterns, and a
knapsack over the program's prices finds the next pattern worth having (dynamic programming over the
capacity). The driver sees the histogram only, whose size is CAPACITY / UNIT. Solutions are rounded
down; what is left over, less than a sequence per class, is filled first fit by decreasing size.

Pieces are ranked within their class, and each pattern takes the next ranks of its classes: which
sequence a piece goes to follows from its class and rank alone. Sequences that stay emptier than
MIN_FILL are cut into ones of a power of two, which need no padding.

Tokens are made once, stored in the shared folder with a row number, and joined to the pieces by it.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from unicodedata import is_normalized

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from bazaarlake.llm.shared import LONG, T, as_bytes, shared_folder, small_batches

CAPACITY = 4096
UNIT = 8
END_ID = 2
MIN_FILL = 31 / 32
# The program ends this close to its bound or half a sequence above it, or after so many columns;
# any end is a valid packing.
GAP = 0.001
COLUMNS = 4000
RANKED_AT_ONCE = 10_000
CACHED_BYTES = 128 << 20


# Tokens -----------------------------------------------------------------------


# Kinds of bytes: 1 ASCII letters, 2 other visible ASCII, 3 digits, 0 the rest.
_KIND = np.array(
    [
        0 if not 0x21 <= b < 0x7F else 1 if chr(b).isalpha() else 3 if chr(b).isdigit() else 2
        for b in range(256)
    ],
    np.uint8,
)
# Latin letters of two bytes, 0xC3 and one of 0x80 to 0xBF, but for the signs of multiplication and division.
_LATIN = np.array([0x80 <= b < 0xC0 and b not in (0x97, 0xB7) for b in range(256)])
# A byte-level model knows bytes that print as themselves, and others as the letters from U+0100 on.
_HIDDEN = [b for b in range(256) if not (0x21 <= b < 0x7F or 0xA1 <= b and b != 0xAD)]
_PRINTED = {b: 0x100 + i for i, b in enumerate(_HIDDEN)}


def runs_of(text: bytes) -> list[bytes]:
    """The text cut where no token reaches across: at white space, between a letter and visible ASCII
    that is no letter, as a token ends with its run of letters, and between a digit, which is a token,
    and any visible ASCII. Letters are those of ASCII and the Latin ones of two bytes."""
    bytes_ = np.frombuffer(text, np.uint8)
    kind = _KIND[bytes_]
    kind[1:][(bytes_[:-1] == 0xC3) & _LATIN[bytes_[1:]]] = 1
    ascii_next = (kind[1:] > 0) & (bytes_[1:] < 0x80)
    cut = ascii_next & ((kind[:-1] == 3) | (kind[:-1] == 1) & (kind[1:] > 1))
    return np.insert(bytes_, np.flatnonzero(cut) + 1, 0x20).tobytes().split()


class _Known(dict):
    """Run to its ids, found when a run is first asked for."""

    def __init__(self, tokenizer: Tokenizer):
        self.tokenizer, self.model = tokenizer, tokenizer.model
        self.held = 0

    def __missing__(self, run: bytes) -> bytes:
        text = run.decode()
        # One token before the model: the tokenizer's own steps would change nothing.
        if run.isalpha() and run.islower():
            found = [t.id for t in self.model.tokenize(text)]
        elif text.isalpha() and max(text) < "\u0250" and text == text.lower() and is_normalized("NFC", text):
            found = [t.id for t in self.model.tokenize(run.decode("latin-1").translate(_PRINTED))]
        else:
            found = self.tokenizer.encode(text, add_special_tokens=False).ids
        self[run] = ids = b"".join([i.to_bytes(4, "little") for i in found])
        self.held += len(run) + len(ids) + 200
        return ids


class Tokens:
    """Token ids of whole texts by a tokenizer whose tokens are runs of letters, single digits or runs
    of other signs, in lower case. The ids of a text are those of its runs, and runs that come
    again are looked up; a text that names a special token is encoded as it is."""

    def __init__(self, path: str, end_id: int = END_ID):
        self.tokenizer = Tokenizer.from_file(path)
        self.end = end_id.to_bytes(4, "little")
        added = self.tokenizer.get_added_tokens_decoder().values()
        self.special = [t.content.encode().lower() for t in added]
        self.known = _Known(self.tokenizer)

    def ids(self, text: bytes | None) -> bytes:
        """The ids as little-endian 32-bit integers, the end id last."""
        if not text:
            return self.end
        lower = text.lower()  # as the tokenizer does
        if any(s in lower for s in self.special):
            ids = self.tokenizer.encode(text.decode(), add_special_tokens=False).ids
            return np.array(ids, "<u4").tobytes() + self.end
        if self.known.held > CACHED_BYTES:
            self.known = _Known(self.tokenizer)
        return b"".join(map(self.known.__getitem__, runs_of(lower))) + self.end


# One per worker and tokenizer, as workers run many tasks.
_TOKENS: dict[str, Tokens] = {}


def tokenized(docs: DataFrame, tokenizer: str, id_col: str, text_col: str) -> DataFrame:
    """row, id, tokens (their number), ids: written to the shared folder and read again."""

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = _TOKENS.setdefault(tokenizer, None) or Tokens(tokenizer)
        _TOKENS[tokenizer] = tokens
        for batch in batches:
            ids = [tokens.ids(text) for text in as_bytes(batch.column("text"))]
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), pa.array([len(i) // 4 for i in ids], pa.int64()), pa.array(ids, pa.binary())],
                ["id", "tokens", "ids"],
            )

    read = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text"))
    schema = T.StructType([read.schema["id"], T.StructField("tokens", LONG), T.StructField("ids", T.BinaryType())])
    rows = small_batches(read).mapInArrow(encode, schema)
    path = f"{shared_folder(docs.sparkSession)}/packing-{uuid.uuid4().hex}"
    rows.select(F.monotonically_increasing_id().alias("row"), "*").write.parquet(path)
    return docs.sparkSession.read.parquet(path)


# Patterns ---------------------------------------------------------------------


def knapsack(sizes: np.ndarray, prices: np.ndarray, capacity: int) -> tuple[np.ndarray, float]:
    """The pattern of the highest total price that fits, and that price."""
    best = np.zeros(capacity + 1)
    choice = np.full(capacity + 1, -1)
    fitting = np.searchsorted(sizes, np.arange(capacity + 1), side="right")
    for room in range(1, capacity + 1):
        best[room] = best[room - 1]
        k = fitting[room]
        if k:
            totals = prices[:k] + best[room - sizes[:k]]
            i = int(totals.argmax())
            if totals[i] > best[room]:
                best[room], choice[room] = totals[i], i
    pattern, room = np.zeros(len(sizes)), capacity
    while room > 0:
        if choice[room] < 0:
            room -= 1
        else:
            pattern[choice[room]] += 1
            room -= sizes[choice[room]]
    return pattern, float(best[capacity])


def fractional_patterns(
    sizes: np.ndarray, demand: np.ndarray, capacity: int
) -> tuple[np.ndarray, np.ndarray, float]:
    """Patterns (one a column), how often each is used, and a lower bound of any number of sequences:
    the revised simplex method, whose next column comes from the knapsack."""
    columns = np.diag((capacity // sizes).astype(float))
    inverse = np.diag(1 / np.diag(columns))
    used = inverse @ demand
    prices = inverse.sum(axis=0)
    bound = 0.0
    for _ in range(COLUMNS):
        pattern, price = knapsack(sizes, prices, capacity)
        bound = max(bound, float(prices @ demand) / max(price, 1.0))
        if price <= 1 + 1e-9 or used.sum() <= max(bound * (1 + GAP), bound + 0.5):
            break
        sold = np.flatnonzero(pattern)
        direction = inverse[:, sold] @ pattern[sold]
        limits = np.full(len(used), np.inf)
        grows = direction > 1e-9
        limits[grows] = used[grows] / direction[grows]
        leaving = int(limits.argmin())
        used = np.maximum(used - limits[leaving] * direction, 0)
        used[leaving] = limits[leaving]
        row = inverse[leaving] / direction[leaving]
        inverse -= np.outer(direction, row)
        inverse[leaving] = row
        prices = prices + (1 - direction.sum()) * row
        columns[:, leaving] = pattern
    return columns, used, bound


def patterns(histogram: dict[int, int], capacity: int) -> list[tuple[dict[int, int], int]]:
    """Patterns (size: pieces) and how many sequences each fills; together they take every piece of
    the histogram (size: pieces) exactly once."""
    sizes = np.array(sorted(histogram), dtype=np.int64)
    left = np.array([histogram[s] for s in sizes], dtype=np.int64)
    out: list[tuple[dict[int, int], int]] = []

    def take(pattern: np.ndarray, times: int) -> None:
        if times > 0:
            out.append(({int(sizes[i]): int(pattern[i]) for i in np.flatnonzero(pattern)}, int(times)))
            left[:] -= pattern * int(times)

    if len(sizes):
        columns, used, _ = fractional_patterns(sizes, left.astype(float), capacity)
        for j in np.argsort(-used, kind="stable"):
            pattern = columns[:, j].astype(np.int64)
            most = int((left[pattern > 0] // pattern[pattern > 0]).min())
            take(pattern, min(int(used[j] + 1e-6), most))
    while left.any():
        pattern, room = np.zeros(len(sizes), np.int64), capacity
        for i in reversed(range(len(sizes))):
            pattern[i] = min(left[i], room // sizes[i])
            room -= int(pattern[i] * sizes[i])
        take(pattern, int((left[pattern > 0] // pattern[pattern > 0]).min()))
    return out


def _runs(plan: list[tuple[dict[int, int], int]]) -> list[tuple[int, list[tuple[int, int, int]]]]:
    """Per class its ranks in runs: (first rank, first sequence, pieces per sequence)."""
    runs: dict[int, list[tuple[int, int, int]]] = {}
    next_rank: dict[int, int] = {}
    sequence = 0
    for pattern, times in plan:
        for size, pieces in pattern.items():
            start = next_rank.get(size, 0)
            runs.setdefault(size, []).append((start, sequence, pieces))
            next_rank[size] = start + pieces * times
        sequence += times
    return sorted(runs.items())


# Packing ----------------------------------------------------------------------


def _ranked(pieces: DataFrame) -> tuple[DataFrame, dict[int, int]]:
    """Pieces with their rank in their class, and the pieces per class. A class is numbered in buckets
    of a bounded size, however many rows it has."""
    per_bucket = pieces.agg(F.count(F.lit(1))).first()[0] // RANKED_AT_ONCE + 1
    in_buckets = pieces.withColumn("bucket", F.pmod(F.xxhash64("row", "start"), F.lit(per_bucket)))
    counts = in_buckets.groupBy("size", "bucket").agg(F.count(F.lit(1)).alias("n"))
    earlier = Window.partitionBy("size").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    before = counts.select("size", "bucket", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    histogram = {r["size"]: r["n"] for r in counts.groupBy("size").agg(F.sum("n").alias("n")).collect()}
    within = Window.partitionBy("size", "bucket").orderBy("row", "start")
    ranked = in_buckets.join(before, ["size", "bucket"]).withColumn(
        "rank", F.col("before") + F.row_number().over(within) - 1
    )
    return ranked.drop("bucket", "before"), histogram


def _placed(ranked: DataFrame, plan: list[tuple[dict[int, int], int]]) -> DataFrame:
    """Pieces with sequence and offset, from class and rank; emptier sequences cut at powers of two."""
    runs = ranked.sparkSession.createDataFrame(
        [(size, of) for size, of in _runs(plan)],
        "size long, runs array<struct<first: long, sequence: long, pieces: long>>",
    )
    run = F.array_max(F.filter("runs", lambda r: r["first"] <= F.col("rank")))
    sequenced = ranked.join(runs, "size").withColumn("run", run).select(
        "row",
        "start",
        "length",
        (F.col("run.sequence") + F.floor((F.col("rank") - F.col("run.first")) / F.col("run.pieces"))).alias("sequence"),
    )
    inside = Window.partitionBy("sequence")
    earlier = inside.orderBy(F.desc("length"), "row", "start").rowsBetween(Window.unboundedPreceding, -1)
    offset = sequenced.withColumn("offset", F.coalesce(F.sum("length").over(earlier), F.lit(0))).withColumn(
        "total", F.sum("length").over(inside)
    )
    # The part of bit b of the total starts where the higher bits end; part 13 is a whole sequence.
    bits = F.expr("filter(sequence(0, 12), b -> (total & shiftleft(1L, b)) != 0)")
    parts = F.when(F.col("total") < CAPACITY * MIN_FILL, bits).otherwise(F.array(F.lit(13)))
    cut = (
        offset.withColumn("bit", F.explode(parts))
        .withColumn("low", F.expr("if(bit = 13, 0L, shiftleft(shiftright(total, bit + 1), bit + 1))"))
        .withColumn("high", F.expr("if(bit = 13, total, low + shiftleft(1L, bit))"))
        .withColumn("from", F.greatest("offset", "low"))
        .withColumn("to", F.least(F.col("offset") + F.col("length"), F.col("high")))
        .where(F.col("from") < F.col("to"))
    )
    return cut.select(
        "row",
        (F.col("start") + F.col("from") - F.col("offset")).alias("start"),
        (F.col("to") - F.col("from")).alias("length"),
        (F.col("sequence") * 14 + F.col("bit")).alias("sequence_id"),
        (F.col("from") - F.col("low")).alias("offset"),
    )


def pack(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per piece: id, start, length, tokens (of its document), sequence_id, offset, and ids
    (the piece's token ids as little-endian 32-bit integers).

    Every document ends in END_ID; a null or empty text has that token alone. Rows count each, also
    with equal or null ids. A sequence has at most CAPACITY tokens, its pieces stand without gaps
    from offset 0, and unless its length is a power of two it is at least MIN_FILL full. Very long
    documents have a piece for every CAPACITY tokens. An empty table has no rows. Other columns
    are not read. The tokens stay in the shared folder until the caller drops them.
    """
    rows = tokenized(docs, tokenizer, id_col, text_col)
    starts = F.expr(f"sequence(0L, tokens - 1, {CAPACITY}L)")
    pieces = rows.select("row", "tokens", F.explode(starts).alias("start")).select(
        "row", "start", F.least(F.col("tokens") - F.col("start"), F.lit(CAPACITY)).alias("length")
    )
    sized = pieces.withColumn("size", F.ceil(F.col("length") / UNIT))
    ranked, histogram = _ranked(sized)
    placed = _placed(ranked, patterns(histogram, CAPACITY // UNIT))
    ids = F.expr("substring(ids, cast(4 * start + 1 AS int), cast(4 * length AS int))")
    return placed.join(rows, "row").select(
        "id", "start", "length", "tokens", "sequence_id", "offset", ids.alias("ids")
    )


def sequences(packed: DataFrame) -> DataFrame:
    """The sequences themselves: sequence_id, length, padded_to (CAPACITY, or the length where it is
    a power of two), ids, and documents (id, start, length, offset of each piece)."""
    piece = F.struct("offset", "id", "start", "length", "ids")
    whole = packed.groupBy("sequence_id").agg(F.sort_array(F.collect_list(piece)).alias("pieces"))
    length = F.expr("aggregate(pieces, 0L, (n, p) -> n + p.length)")
    return (
        whole.withColumn("length", length)
        .withColumn("padded_to", F.when(F.bit_count("length") == 1, F.col("length")).otherwise(CAPACITY))
        .withColumn("ids", F.expr("aggregate(pieces, cast('' AS binary), (all, p) -> concat(all, p.ids))"))
        .withColumn("documents", F.transform("pieces", lambda p: F.struct(p["id"], p["start"], p["length"], p["offset"])))
        .drop("pieces")
    )
