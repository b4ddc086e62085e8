"""Counts, modes and top-k, whole tables and per group."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def first_per_group(frame: DataFrame, groups: list[str], order: list[Column], k: int = 1, rank: str = "rank") -> DataFrame:
    """The first ``k`` rows of each group with their position.

    The filter on the row number lets Spark cut every group to ``k`` rows in
    each task before the shuffle, so a group of any size reaches one task only
    as ``k`` rows per input task.
    """
    numbered = frame.withColumn(rank, F.row_number().over(Window.partitionBy(*groups).orderBy(*order)))
    return numbered.where(F.col(rank) <= k)


def top_k(frame: DataFrame, order: list[Column], k: int) -> DataFrame:
    """The first ``k`` rows overall, in order; planned as a bounded heap per task."""
    return frame.orderBy(*order).limit(k)
