"""Row numbers over orderings too large for one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from bazaarlake.session import ensure_checkpoint_dir

_ROW_BITS = 33  # monotonically_increasing_id keeps the partition above bit 33


def distributed_row_number(
    df: DataFrame, group: Sequence[str], order: Sequence[Column], name: str
) -> DataFrame:
    """row_number() over (partition by group order by order) without gathering a
    group in one task.

    Rows are range-partitioned on (group, order) and sorted inside each piece; a
    row's rank is its place inside the piece plus the rows of the group in earlier
    pieces. The pieces are checkpointed because range bounds are sampled: both
    readers below must see the same bounds. `order` has to be unique per group.
    """
    ensure_checkpoint_dir(df.sparkSession)
    keys = [F.col(c) for c in group]
    piece = F.shiftright("__row", _ROW_BITS).alias("__piece")
    ranged = (
        df.repartitionByRange(*keys, *order)
        .sortWithinPartitions(*keys, *order)
        .withColumn("__row", F.monotonically_increasing_id())
        .checkpoint()
        .select("*", piece)
    )
    # One row per (group, piece): bounded by the number of range partitions.
    sizes = ranged.groupBy(*group, "__piece").agg(
        F.min("__row").alias("__first"), F.count(F.lit(1)).alias("__rows")
    )
    earlier = Window.partitionBy(*group).orderBy("__piece").rowsBetween(
        Window.unboundedPreceding, -1
    )
    offsets = sizes.select(
        *group,
        "__piece",
        "__first",
        F.coalesce(F.sum("__rows").over(earlier), F.lit(0)).alias("__before"),
    )
    position = F.col("__row") - F.col("__first") + 1 + F.col("__before")
    return ranged.join(offsets, [*group, "__piece"]).select(
        *df.columns, position.cast("bigint").alias(name)
    )
