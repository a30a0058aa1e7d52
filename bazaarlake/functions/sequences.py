"""Per-user ordering that survives a user holding a large share of all rows.

A window over the user alone would put all of that user's rows in one task. Here the
user's order is cut by slice columns, from coarse to fine (say day, second, block of line
ids), that the caller bounds. Rows are windowed inside the finest slices, and each coarser
level sees only a few rows per slice of the level below.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def with_position(
    df: DataFrame, user: str, slices: Sequence[str], within: Sequence[str], value: str, name: str
) -> DataFrame:
    """Number each user's rows 1, 2, … ordered by the slice columns and then `within`;
    `value` must not be NULL."""
    in_slice = Window.partitionBy(user, *slices).orderBy(*within)
    placed = df.withColumn("__place", F.row_number().over(in_slice))
    # Reads the same columns as the rows, so that both share one scan and shuffle.
    rows = F.max(F.when(F.col(value).isNotNull(), F.col("__place")))
    sizes = placed.groupBy(user, *slices).agg(rows.alias("__rows"))
    # Rows before a slice: those of earlier slices of its parent, level by level.
    offsets = None
    for level in range(1, len(slices) + 1):
        keys = [user, *slices[:level]]
        earlier = Window.partitionBy(*keys[:-1]).orderBy(keys[-1]).rowsBetween(Window.unboundedPreceding, -1)
        before = F.coalesce(F.sum("__rows").over(earlier), F.lit(0))
        step = sizes.groupBy(*keys).agg(F.sum("__rows").alias("__rows")).select(*keys, before.alias("__step"))
        if offsets is None:
            offsets = step.withColumnRenamed("__step", "__before")
        else:
            offsets = step.join(offsets, keys[:-1]).select(
                *keys, (F.col("__step") + F.col("__before")).alias("__before")
            )
    return placed.join(offsets, [user, *slices], "left").select(
        *df.columns, (F.col("__place") + F.col("__before")).alias(name)
    )


def with_next_two(
    df: DataFrame, user: str, slices: Sequence[str], within: Sequence[str], value: str
) -> DataFrame:
    """Rows that have two followers of the same user, ordered by the slice columns and
    then `within`, with `value` of both as next_1 and next_2; `value` must not be NULL.

    Rows whose followers are in their own slice are done there. The others are
    among the last two of their slice, and their followers among the first two of
    later slices: at most four rows per slice go on to the next coarser level.
    """
    columns = [*df.columns, "next_1", "next_2"]
    rows = df.withColumn("__open", F.lit(True))
    done = None
    for level in range(len(slices), -1, -1):
        order = Window.partitionBy(user, *slices[:level]).orderBy(*slices[level:], *within)
        rows = rows.select(
            *df.columns,
            "__open",
            F.row_number().over(order).alias("__place"),
            F.lead(value, 1).over(order).alias("next_1"),
            F.lead(value, 2).over(order).alias("next_2"),
        )
        found = F.col("next_2").isNotNull()
        here = rows.where(F.col("__open") & found).select(*columns)
        done = here if done is None else done.unionByName(here)
        rows = (
            rows.where((F.col("__place") <= 2) | (F.col("__open") & ~found))
            .withColumn("__open", F.col("__open") & ~found)
            .select(*df.columns, "__open")
        )
    return done
