"""Vectors compressed to one codebook index per part, learned in exact integers with LAESA pivots.

Components become integers, vectors are cut into PARTS equal parts, and every part position learns
a codebook by rounds of assignment and averaging. Assigning a part to its nearest entry would
measure it against every entry. Instead the distances of each part to a few fixed pivots are taken
once and stored; a round measures only the pivots against the entries. By the triangle inequality
|d(part, pivot) - d(pivot, entry)| is a lower bound of d(part, entry): entries are evaluated in the
order of their bounds, and a part is done when the least bound left is above its best distance.
Distances that decide anything are exact integers; the bounds are doubles, lowered by more than
their rounding.

The driver holds codebooks, pivots and their sums, whose size depends on ENTRIES and the length of a
vector alone. Each round reads the stored parts and returns a row per used entry and task.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bazaarlake.llm.shared import INT, LONG, TEXT, T, checkpointed, small_batches, struct

SCALE = 256
PARTS = 16
ENTRIES = 64
ROUNDS = 2
PIVOTS = 4
ROWS_AT_ONCE = 2048
# Sums of squared differences of smaller components are exact in 64 bits for parts of up to 2^13.
SMALL = 1 << 24
# Large components travel as signed limbs of this many bits, whose sums stay below 2^63.
LIMB = 30
LONG_MAX = (1 << 63) - 1


@dataclass(frozen=True)
class Codebooks:
    """entries[part][k] is a tuple of integers; pivots[part] are the fixed pivots."""

    entries: tuple
    pivots: tuple

    @property
    def width(self) -> int:
        return sum(len(part[0]) for part in self.entries) if self.entries else 0

    def sha256(self) -> str:
        numbers = [str(x) for part in self.entries for entry in part for x in entry]
        return hashlib.sha256(",".join(numbers).encode()).hexdigest()


def _usable(vector: Column) -> Column:
    """Neither null nor holding a null, NaN or infinite component."""

    def finite(x: Column) -> Column:
        x = x.cast("double")
        return x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))

    return F.coalesce(vector.isNotNull() & F.forall(vector, finite), F.lit(False))


def _whole(rows: list[list[float]], width: int) -> np.ndarray:
    """floor(SCALE * x) of every component; 64-bit integers, or Python's where one is not SMALL."""
    scaled = np.floor(np.array(rows, dtype=np.float64).reshape(len(rows), width) * SCALE)
    if np.abs(scaled).max(initial=0) < SMALL:
        return scaled.astype(np.int64)
    return np.frompyfunc(int, 1, 1)(scaled)


def _matrix(part: Sequence) -> np.ndarray:
    """Codebook entries or pivots of one part position."""
    small = all(abs(x) < SMALL for entry in part for x in entry)
    return np.array(part, dtype=np.int64 if small else object).reshape(len(part), -1)


def _squares(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact squared distances of rows a[i] and b[i], or of all pairs when shaped for it."""
    difference = a - b
    return (difference * difference).sum(axis=-1) if difference.shape[-1] else np.zeros(difference.shape[:-1], np.int64)


def _roots(squares: np.ndarray) -> np.ndarray:
    return np.sqrt(squares.astype(np.float64))


def pivot_distances(part: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    return _roots(np.stack([_squares(part, p) for p in pivots], axis=1))


def nearest(
    part: np.ndarray, to_pivots: np.ndarray, entries: np.ndarray, pivots: np.ndarray
) -> tuple[np.ndarray, np.ndarray, int]:
    """For every row of part the index of its nearest entry (ties to the lower index), the exact
    squared distance, and the number of exact evaluations all rows took together."""
    n = len(part)
    between = pivot_distances(entries, pivots)
    # Stored distances are right to 2^-24, which 2^-20 more than covers. One too large for its
    # type is infinite, its bound no number, and fmax passes over it.
    bound = np.zeros((n, len(entries)))
    with np.errstate(invalid="ignore"):
        for p in range(len(pivots)):
            one, other = to_pivots[:, p : p + 1].astype(np.float64), between[None, :, p]
            np.fmax(bound, np.abs(one - other) - (one + other) * 2.0**-20, out=bound)
    best = np.full(n, -1, dtype=np.int64)
    least = np.zeros(n, dtype=np.result_type(part, entries))
    reach = np.full(n, np.inf)
    rows, evaluations = np.arange(n), 0
    while len(rows):
        candidate = bound.argmin(axis=1)
        at = np.arange(len(rows))
        # The bounds only order and prune: an entry whose bound is the best distance itself may tie.
        undone = bound[at, candidate] <= reach[rows]
        if not undone.all():
            rows, bound, candidate = rows[undone], bound[undone], candidate[undone]
            at = at[: len(rows)]
            if not len(rows):
                break
        evaluations += len(rows)
        squares = _squares(part[rows], entries[candidate])
        better = (best[rows] < 0) | (squares < least[rows]) | ((squares == least[rows]) & (candidate < best[rows]))
        won = rows[better]
        best[won], least[won] = candidate[better], squares[better]
        reach[won] = _roots(squares[better]) * (1 + 2.0**-40)
        bound[at, candidate] = np.inf
        if np.isinf(bound[0]).all():
            break
    return best, least, evaluations


def _limbs(numbers: np.ndarray) -> list[list[int]]:
    """Python integers as rows of limbs, the last one signed."""
    most = max((abs(int(x)) for x in numbers), default=0)
    count = most.bit_length() // LIMB + 1
    mask = (1 << LIMB) - 1
    return [
        [(int(x) >> (LIMB * i)) & mask for i in range(count - 1)] + [int(x) >> (LIMB * (count - 1))]
        for x in numbers
    ]


def _rows(batches: Iterator[pa.RecordBatch], books: Codebooks) -> Iterator[tuple]:
    """Blocks of rows: the ids, the parts as integer matrices, and their stored pivot distances."""
    width, n_pivots = books.width, len(books.pivots[0])
    step = width // PARTS
    for batch in batches:
        for start in range(0, batch.num_rows, ROWS_AT_ONCE):
            block = batch.slice(start, ROWS_AT_ONCE)
            vectors = _whole(block.column("vector").to_pylist(), width)
            stored = np.frombuffer(b"".join(block.column("pivots").to_pylist()), dtype="<f4")
            stored = stored.reshape(block.num_rows, PARTS, n_pivots)
            parts = [vectors[:, i * step : (i + 1) * step] for i in range(PARTS)]
            yield block, parts, stored


def _assign(parts: list[np.ndarray], stored: np.ndarray, books: Codebooks) -> tuple[np.ndarray, np.ndarray]:
    codes, errors = [], []
    for i, part in enumerate(parts):
        best, least, _ = nearest(part, stored[:, i], _matrix(books.entries[i]), _matrix(books.pivots[i]))
        codes.append(best)
        errors.append(least)
    return np.stack(codes, axis=1), np.stack(errors, axis=1)


def _prepared(vectors: DataFrame, id_col: str, vector_col: str, keep: Sequence[str]) -> DataFrame:
    v = F.col(f"`{vector_col}`")
    return vectors.where(_usable(v)).select(
        F.col(f"`{id_col}`").alias("id"),
        F.struct(*[F.col(f"`{c}`") for c in keep]).alias("kept") if keep else F.lit(None).cast("int").alias("kept"),
        v.alias("vector"),
    )


def _seed(rows: DataFrame) -> Codebooks | None:
    """The first codebooks: parts of the ENTRIES smallest ids; pivots far from each other among them."""
    first = rows.select("id", "vector").orderBy(F.col("id").asc_nulls_last(), "vector").limit(ENTRIES).collect()
    if not first:
        return None
    width = len(first[0]["vector"])
    if width % PARTS:
        raise ValueError(f"vectors of {width} components cannot be cut into {PARTS} equal parts")
    whole = _whole([r["vector"] for r in first if len(r["vector"]) == width], width)
    step = width // PARTS
    entries, pivots = [], []
    for i in range(PARTS):
        part = whole[:, i * step : (i + 1) * step]
        chosen = [0]
        distance = _squares(part, part[0])
        while len(chosen) < min(PIVOTS, len(part)):
            chosen.append(int(np.argmax(distance)))
            distance = np.minimum(distance, _squares(part, part[chosen[-1]]))
        entries.append(tuple(tuple(int(x) for x in row) for row in part))
        pivots.append(tuple(entries[-1][c] for c in chosen))
    return Codebooks(tuple(entries), tuple(pivots))


def _with_pivots(rows: DataFrame, books: Codebooks) -> DataFrame:
    """The rows with the distances of their parts to the pivots, taken once and stored."""
    width, step = books.width, books.width // PARTS

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pivots = [_matrix(p) for p in books.pivots]
        for batch in batches:
            vectors = _whole(batch.column("vector").to_pylist(), width)
            distances = np.stack(
                [pivot_distances(vectors[:, i * step : (i + 1) * step], pivots[i]) for i in range(PARTS)], axis=1
            )
            with np.errstate(over="ignore"):
                packed = pa.array([row.astype("<f4").tobytes() for row in distances], pa.binary())
            yield pa.RecordBatch.from_arrays([*batch.columns, packed], [*batch.schema.names, "pivots"])

    schema = T.StructType([*rows.schema.fields, T.StructField("pivots", T.BinaryType())])
    return checkpointed(small_batches(rows).mapInArrow(measure, schema))


def _updated(stored: DataFrame, books: Codebooks) -> Codebooks:
    """One round: every part to its nearest entry, then each used entry to its parts' floored mean."""

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        step = books.width // PARTS
        total: dict[tuple[int, int], list] = {}
        for _, parts, distances in _rows(batches, books):
            codes, _ = _assign(parts, distances, books)
            for i, part in enumerate(parts):
                used, code = np.unique(codes[:, i], return_inverse=True)
                added = np.zeros((len(used), step), dtype=part.dtype)
                np.add.at(added, code, part)
                for k, count, add in zip(used, np.bincount(code), added):
                    held = total.setdefault((i, int(k)), [0, [0] * step])
                    held[0] += int(count)
                    held[1] = [x + int(y) for x, y in zip(held[1], add)]
        keys = [(i, k, at) for (i, k), held in total.items() for at in range(step)]
        numbers = [x for held in total.values() for x in held[1]]
        yield pa.RecordBatch.from_pydict(
            {
                "part": pa.array([k[0] for k in keys], pa.int32()),
                "entry": pa.array([k[1] for k in keys], pa.int32()),
                "at": pa.array([k[2] for k in keys], pa.int32()),
                "n": pa.array([total[k[:2]][0] for k in keys], pa.int64()),
                "limbs": pa.array(_limbs(numbers), pa.list_(pa.int64())),
            }
        )

    schema = struct(part=INT, entry=INT, at=INT, n=LONG, limbs=T.ArrayType(LONG))
    keys = ["part", "entry", "at"]
    partial = stored.select("vector", "pivots").mapInArrow(sums, schema)
    summed = (
        partial.select(*keys, "n", F.posexplode("limbs").alias("limb", "value"))
        .groupBy(*keys, "limb")
        .agg(F.sum("n").alias("n"), F.sum("value").alias("value"))
        .collect()
    )
    entries = [[list(e) for e in part] for part in books.entries]
    counts: dict[tuple, int] = {}
    values: dict[tuple, int] = {}
    for r in summed:
        key = (r["part"], r["entry"], r["at"])
        # Every partial sum has a lowest limb, so its rows count all members.
        counts[key] = max(counts.get(key, 0), r["n"])
        values[key] = values.get(key, 0) + (r["value"] << (LIMB * r["limb"]))
    for (i, k, at), value in values.items():
        entries[i][k][at] = value // counts[i, k, at]
    return Codebooks(tuple(tuple(tuple(e) for e in part) for part in entries), books.pivots)


def compress(
    vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", keep: Sequence[str] = ()
) -> tuple[DataFrame, Codebooks | None]:
    """One row per usable vector: id, kept (a struct of the columns named in keep), code (two hex
    digits per part), error (squared distances of its parts to their entries, at most 2^63 - 1); and the
    codebooks.

    Vectors that are null or hold a null, NaN or infinite component take no part. The vector of the
    smallest id gives the length, which must be a multiple of PARTS; vectors of another length cannot
    be measured against it and stop the job with an error. Rows without id come after all others when
    the first codebook is chosen and are coded like them. Rows that repeat an id count each, in the
    order of their vectors. With fewer than ENTRIES rows the codebooks are as small; with none the
    result is empty and the codebooks are None. Columns not named are not read.
    """
    rows = _prepared(vectors, id_col, vector_col, keep)
    books = _seed(rows)
    result = T.StructType(
        [rows.schema["id"], rows.schema["kept"], *struct(code=TEXT, error=LONG).fields]
    )
    if books is None:
        return vectors.sparkSession.createDataFrame([], result), None
    width = books.width
    same = F.when(F.size("vector") == width, F.col("vector")).otherwise(
        F.raise_error(F.format_string(f"a vector has %d components, the first has {width}", F.size("vector")))
    )
    stored = _with_pivots(rows.withColumn("vector", same), books)
    for _ in range(ROUNDS):
        books = _updated(stored, books)
    final = books

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block, parts, distances in _rows(batches, final):
            codes, errors = _assign(parts, distances, final)
            yield pa.RecordBatch.from_arrays(
                [
                    block.column("id"),
                    block.column("kept"),
                    pa.array([row.astype(np.uint8).tobytes().hex() for row in codes]),
                    pa.array([min(LONG_MAX, sum(row.tolist())) for row in errors], pa.int64()),
                ],
                result.names,
            )

    return stored.mapInArrow(code, result), final
