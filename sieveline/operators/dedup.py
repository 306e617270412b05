"""Duplicates within tasks, by aggregates that are joined back: a hot key is one row before it is joined."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sieveline.operators.stats import join_back


def strict(df: DataFrame, keys: Sequence[str], key: str) -> DataFrame:
    """Records whose key occurs once in their task; null keys count as equal."""
    counts = df.groupBy(*keys, key).agg(F.count(F.lit(1)).alias("_n"))
    return join_back(df, counts, [*keys, key]).filter("_n = 1").drop("_n")


def strict_or_first(df: DataFrame, keys: Sequence[str], key: str, row_id: str, skip: str | None = None) -> DataFrame:
    """strict(), but a task of which nothing would remain keeps the first record of each key; tasks with skip keep all."""
    flag = F.col(skip) if skip else F.lit(False)
    counts = df.groupBy(*keys, key).agg(F.count(F.lit(1)).alias("_n"), F.min(row_id).alias("_first"), F.bool_or(flag).alias("_any"))
    tasks = counts.groupBy(*keys).agg(F.coalesce(F.bool_or("_any"), F.lit(False)).alias("_all"), (F.count_if(F.col("_n") == 1) == 0).alias("_none"))
    both = join_back(df, join_back(counts, tasks, keys), [*keys, key])  # the records themselves are joined once
    kept = both.filter(F.col("_all") | F.when(F.col("_none"), F.col(row_id) == F.col("_first")).otherwise(F.col("_n") == 1))
    return kept.select(*df.columns)


def first_of_each(df: DataFrame, key: str, row_id: str) -> DataFrame:
    """The record of least row_id for each key."""
    first = df.groupBy(key).agg(F.min(row_id).alias("_first"))
    return join_back(df, first, [key]).filter(F.col(row_id) == F.col("_first")).drop("_first")
