"""Exact top-k inner products by a three-phase uniform threshold.

The dimensions are cut into LISTS groups; a group's partial inner products are one score list per
query. Every task holds such lists for its own vectors.

1. Each task gathers the k best entries of every local list and resolves their scores;
   the k-th best of all tasks' answers is a cutoff that the true k-th score cannot be below.
2. The cutoff goes to all tasks. A sum that reaches it has a list whose entry reaches
   cutoff / LISTS, so each task collects exactly the entries with such a list.
3. The collected entries, and only those, get their full scores; what reaches the cutoff is
   returned and ranked.

Queries come in blocks of a bounded size, as the stated query set; each block takes two
passes over the vectors. Nothing but a block and its cutoffs is broadcast.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from bazaarlake.llm.shared import checkpointed

LISTS = 4
QUERY_BLOCK_BYTES = 16 << 20
QUERIES_AT_ONCE = 256
ROWS_AT_ONCE = 4096
SCALE = 256
LONG_MAX, LONG_MIN = (1 << 63) - 1, -(1 << 63)


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    """Integer vectors of one batch as exact doubles, or as Python integers where a product might
    not be exact; shorter vectors end in zeros."""
    rows = column.to_pylist()
    out = np.zeros((len(rows), width))
    for i, row in enumerate(rows):
        out[i, : len(row)] = row
    return out


def _exact(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Both as doubles if every sum of products is below 2^53, else as Python integers."""
    most = np.abs(a).max(initial=0) * np.abs(b).max(initial=0) * max(1, a.shape[1])
    if most < 2.0**53:
        return a, b
    whole = np.frompyfunc(int, 1, 1)
    return whole(a), whole(b)


def _lists(vectors: np.ndarray, queries: np.ndarray) -> list[np.ndarray]:
    """Per group of dimensions the partial scores, vectors x queries."""
    cuts = np.linspace(0, vectors.shape[1], LISTS + 1).astype(int)
    return [vectors[:, a:b] @ queries[:, a:b].T for a, b in zip(cuts[:-1], cuts[1:])]


def _tiles(batches: Iterator[pa.RecordBatch], ids: np.ndarray, queries: np.ndarray) -> Iterator[tuple]:
    """Row block x query block: vector ids, query numbers, partial scores, and where the vector is
    the query itself."""
    width = queries.shape[1]
    for batch in batches:
        for start in range(0, batch.num_rows, ROWS_AT_ONCE):
            part = batch.slice(start, ROWS_AT_ONCE)
            vec = part.column(0).to_numpy(zero_copy_only=False)
            rows = _matrix(part.column(1), width)
            for first in range(0, len(ids), QUERIES_AT_ONCE):
                number = np.arange(first, min(first + QUERIES_AT_ONCE, len(ids)))
                a, b = _exact(rows, queries[number])
                yield vec, number, _lists(a, b), vec[:, None] == ids[number][None, :]


def _record(ids: np.ndarray, number: np.ndarray, vec: np.ndarray, score: np.ndarray) -> pa.RecordBatch:
    if score.dtype == object:
        score = np.array([max(LONG_MIN, min(LONG_MAX, s)) for s in score], np.int64)
    return pa.RecordBatch.from_arrays(
        [pa.array(ids[number]), pa.array(vec), pa.array(score.astype(np.int64))],
        names=["query_id", "vec_id", "score"],
    )


OUT = "query_id bigint, vec_id bigint, score bigint"


def _leaders(ids: np.ndarray, queries: np.ndarray, k: int):
    """Phase 1: the k best entries of each local list, resolved."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for vec, number, lists, own in _tiles(batches, ids, queries):
            total = sum(lists)
            n = min(k + 1, len(vec))  # one more, for the query's own row
            picks = [np.argpartition(-s.astype(float), n - 1, axis=0)[:n] for s in lists]
            rows = np.concatenate(picks).ravel()
            cols = np.tile(np.arange(len(number)), LISTS * n)
            at = np.unique(rows * len(number) + cols)
            rows, cols = at // len(number), at % len(number)
            other = ~own[rows, cols]
            rows, cols = rows[other], cols[other]
            yield _record(ids, number[cols], vec[rows], total[rows, cols])

    return run


def _above(ids: np.ndarray, queries: np.ndarray, cutoff: np.ndarray):
    """Phases 2 and 3: entries with a list at cutoff / LISTS or more; of those the scores that reach
    the cutoff. A query without a cutoff takes all."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for vec, number, lists, own in _tiles(batches, ids, queries):
            limit = cutoff[number]
            collected = ~own
            reach = lists[0] * LISTS >= limit
            for s in lists[1:]:
                reach |= s * LISTS >= limit
            rows, cols = np.nonzero((collected & reach.astype(bool)))
            score = lists[0][rows, cols]
            for s in lists[1:]:
                score = score + s[rows, cols]
            on = (score >= limit[cols]).astype(bool)
            rows, cols = rows[on], cols[on]
            yield _record(ids, number[cols], vec[rows], score[on])

    return run


def _ranked(found: DataFrame, k: int) -> DataFrame:
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (
        found.distinct().withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    )


def top_k(
    vectors: DataFrame,
    queries: DataFrame,
    k: int = 5,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
) -> DataFrame:
    """query_id, rank, vec_id, score: the k largest integer inner products of each query with all
    vectors but its own, ties to the smaller vec_id; all, where there are fewer than k.

    A component x counts as floor(256 * x), x as double. Vectors that are null, or hold a null
    or non-finite component, and rows without id take no part. A shorter vector counts as if
    ended by zeros, an empty one scores 0. Rows with the query's id are its own, and rows that
    repeat both id and vector count once; with one id and several vectors each counts. Scores beyond
    a long are held at its limits. Other columns are not read; without vectors there are no rows.
    """

    def whole(df: DataFrame) -> DataFrame:
        x = F.transform(F.col(vector_col), lambda v: v.cast("double"))
        finite = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) != float("inf")))
        # floor() of a double gives a long; beyond 2^53 a double is whole already.
        floor = lambda v: F.when(F.abs(v * SCALE) < 2.0**53, F.floor(v * SCALE).cast("double")).otherwise(v * SCALE)
        return df.where(F.col(id_col).isNotNull() & F.col(vector_col).isNotNull() & finite).select(
            F.col(id_col).cast("bigint").alias("vec_id"), F.transform(x, floor).alias("v")
        )

    spark = vectors.sparkSession
    rows = whole(vectors)
    asked = checkpointed(whole(queries).distinct())
    count, width = asked.agg(F.count("*"), F.coalesce(F.max(F.size("v")), F.lit(0))).first()
    width = max(width, rows.agg(F.coalesce(F.max(F.size("v")), F.lit(0))).first()[0]) if count else 0
    blocks = count * max(width, 1) * 8 // QUERY_BLOCK_BYTES + 1
    block = F.pmod(F.xxhash64("vec_id", "v"), F.lit(blocks))
    result = None
    for b in range(blocks if count else 0):
        local = asked.where(block == b).collect()
        if not local:
            continue
        ids = np.array([r["vec_id"] for r in local], np.int64)
        matrix = np.zeros((len(local), width))
        for i, r in enumerate(local):
            matrix[i, : len(r["v"])] = r["v"]
        first = _ranked(rows.mapInArrow(_leaders(ids, matrix, k), OUT), k)
        floors = {
            r["query_id"]: r["low"]
            for r in first.groupBy("query_id").agg(F.min("score").alias("low"), F.count("*").alias("n")).where(F.col("n") == k).collect()
        }
        # Beyond 2^53 a double may lie above the score it stands for: one step down is safe.
        cutoff = np.array([float(floors.get(i, -np.inf)) for i in ids.tolist()])
        cutoff = np.where(np.abs(cutoff) < 2.0**53, cutoff, np.nextafter(cutoff, -np.inf))
        part = rows.mapInArrow(_above(ids, matrix, cutoff), OUT)
        result = part if result is None else result.unionByName(part)
    if result is None:
        result = spark.createDataFrame([], OUT)
    return _ranked(result, k).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
