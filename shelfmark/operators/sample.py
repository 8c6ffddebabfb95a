"""Reproducible random samples: the n rows with the smallest hash of (key, seed)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def draw_order(key: Column, seed: str) -> Column:
    return F.md5(F.concat(key.cast("string"), F.lit(seed)))


def sample_n(df: DataFrame, key: str, n: int, seed: str) -> DataFrame:
    """n rows. Every task keeps its own best n, so nothing is sorted or shuffled whole."""
    return df.orderBy(draw_order(F.col(key), seed), key).limit(n)


def sample_groups(df: DataFrame, key: str, value: str, seed: str, groups: int = 10, decoys: int = 3) -> DataFrame:
    """``groups`` targets with ``decoys`` other rows each, all from one draw without repeats.

    ``slot`` 0 is the target. The window runs over the drawn rows only.
    """
    drawn = sample_n(df, key, groups * (decoys + 1), seed)
    position = F.row_number().over(Window.orderBy(draw_order(F.col(key), seed), key)) - 1
    numbered = drawn.withColumn("_p", position)
    rest = F.col("_p") - groups
    group = F.when(F.col("_p") < groups, F.col("_p")).otherwise(F.floor(rest / decoys))
    slot = F.when(F.col("_p") < groups, F.lit(0)).otherwise(rest % decoys + 1)
    return numbered.select(group.cast("int").alias("group"), slot.cast("int").alias("slot"), key, value)
