"""Positions over a whole ordered table without a single-task window.

The table is range-sorted into slices; only one small row per slice (its size, its edge rows) is
ever brought together. The sorted slices are written to the checkpoint folder first, so every
later pass sees the same rows in the same slices even when executors are lost.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfmark.operators.merge import lookup_join
from shelfmark.session import cut_lineage

SLICE, ROW = "_slice", "_row"


def ordered_slices(df: DataFrame, order: Sequence[Column]) -> DataFrame:
    """Sort globally; add the slice number and the row number within the slice (from 0).

    ``order`` should end in a key with few repeats, so that equal leading values can be spread over slices.
    """
    row = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    ordered = df.orderBy(*order).select("*", F.spark_partition_id().alias(SLICE), row.alias(ROW))
    return cut_lineage(ordered)


def _slice_offsets(slices: DataFrame) -> DataFrame:
    """Rows before each slice. The input of the window has one row per slice."""
    sizes = slices.groupBy(SLICE).agg(F.count("*").alias("_size"))
    before = Window.orderBy(SLICE).rowsBetween(Window.unboundedPreceding, -1)
    return sizes.select(SLICE, F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_offset"))


def assign_ids(df: DataFrame, order: Sequence[Column], name: str = "id") -> DataFrame:
    """Dense ids 1..n in the given order. Every row gets one, also rows with null or repeated keys.

    The rows themselves are sorted and numbered, so the input is computed once.
    """
    columns = [c for c in df.columns if c != name]
    slices = ordered_slices(df.drop(name), order)
    # one offset row per slice: bounded by the number of shuffle partitions
    numbered = slices.join(F.broadcast(_slice_offsets(slices)), SLICE)
    numbered = numbered.withColumn(name, F.col("_offset") + F.col(ROW) + 1)
    return numbered.select(name, *columns)


def index_in_group(df: DataFrame, group: Sequence[str], order: Sequence[Column], name: str) -> DataFrame:
    """Row number (from 0) within a group, for groups too large for one task."""
    ids = assign_ids(df, [F.col(c) for c in group] + list(order), "_position")
    first = ids.groupBy(*group).agg(F.min("_position").alias("_first"))
    joined = lookup_join(ids, first, list(group))
    return joined.select(*df.columns, (F.col("_position") - F.col("_first")).alias(name))


def neighbours(df: DataFrame, order: Sequence[Column], value: str) -> DataFrame:
    """``value`` of the row before and after, as ``previous`` and ``next``."""
    slices = ordered_slices(df, order)
    within = Window.partitionBy(SLICE).orderBy(ROW)
    across = Window.orderBy(SLICE)  # over one row per slice
    edges = slices.groupBy(SLICE).agg(
        F.max(ROW).alias("_last"),
        F.min_by(value, ROW).alias("_first_value"),
        F.max_by(value, ROW).alias("_last_value"),
    )
    edges = edges.select(
        SLICE,
        "_last",
        F.lag("_last_value").over(across).alias("_before"),
        F.lead("_first_value").over(across).alias("_after"),
    )
    joined = slices.join(F.broadcast(edges), SLICE)
    return joined.select(
        *df.columns,
        F.when(F.col(ROW) == 0, F.col("_before")).otherwise(F.lag(value).over(within)).alias("previous"),
        F.when(F.col(ROW) == F.col("_last"), F.col("_after")).otherwise(F.lead(value).over(within)).alias("next"),
    )
