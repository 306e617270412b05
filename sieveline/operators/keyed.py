"""Aggregates of tasks and the rows of these tasks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sieveline.session import cut, few


def join_back(df: DataFrame, stats: DataFrame, keys: Sequence[str]) -> DataFrame:
    """df with each task's aggregates; null keys meet null keys. Without keys, stats is one row."""
    if not keys:
        return df.crossJoin(F.broadcast(stats))
    named = stats.select(*(F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)), *(F.col(x) for x in stats.columns if x not in keys))
    return df.join(named, [F.col(k).eqNullSafe(F.col(f"_k{i}")) for i, k in enumerate(keys)], "left").drop(*(f"_k{i}" for i in range(len(keys))))


def to_tasks(df: DataFrame, stats: DataFrame, keys: Sequence[str]) -> DataFrame:
    """join_back of what is one row a task: it is written, and goes to the rows where they are if it is small.

    A plain join would first deal all rows by task, and one with a third of them is then read in one place.
    """
    return join_back(df, few(cut(stats, "task-facts")) if keys else stats, keys)
