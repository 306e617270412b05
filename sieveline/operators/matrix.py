"""Long records to a wide matrix: means by entity and endpoint, expanded rows, efflux rows, what is unmapped."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def mean_pivot(df: DataFrame, entity: str, endpoint: str, value: str, endpoints: Sequence[str], fill: float | None = None, digits: int | None = None) -> DataFrame:
    """One row per entity with the mean of each endpoint, in the given order; null (or fill) where there is none.

    Null values and entities are left out first, so an entity with null values alone has no row, while one
    whose endpoints are all outside the list keeps an empty row. Names that the list gives are never searched
    for, and the pivot is a partial and a final aggregation.
    """
    kept = df.filter(F.col(value).isNotNull() & F.col(entity).isNotNull())
    mean = F.avg(value) if digits is None else F.round(F.avg(value), digits)
    wide = kept.groupBy(entity).pivot(endpoint, list(endpoints)).agg(mean)
    return wide if fill is None else wide.select(entity, *(F.coalesce(F.col(f"`{x}`"), F.lit(fill)).alias(x) for x in endpoints))


def expand_rows(df: DataFrame, entity: str, endpoint: str, value: str, endpoints: Sequence[str], fill: float | None = None) -> DataFrame:
    """One row per record, its value in its endpoint's column."""
    empty = F.lit(fill).cast("double")
    return df.select(entity, *(F.when(F.col(endpoint) == x, F.col(value)).otherwise(empty).alias(x) for x in endpoints))


def is_pk_row(*texts: Column) -> Column:
    """Whether the texts together speak of patients or pk."""
    said = F.lower(F.concat_ws(" ", *texts))
    return F.contains(said, F.lit("patient")) | F.contains(said, F.lit("pk"))


def matrix_with_rows(df: DataFrame, entity: str, endpoint: str, value: str, endpoints: Sequence[str], as_rows: Column, fill: float | None = None, digits: int | None = None) -> DataFrame:
    """Means for most records; those that as_rows picks stay rows of their own. The records are read once for each."""
    means = mean_pivot(df.filter(~as_rows), entity, endpoint, value, endpoints, fill, digits)
    return means.unionByName(expand_rows(df.filter(as_rows), entity, endpoint, value, endpoints, fill))


def inject_ratio_rows(df: DataFrame, endpoint: str, value: str, ratio: str, name: str = "Efflux_ratio") -> DataFrame:
    """df and, for each record with a ratio, another with the ratio as value of endpoint name; in one pass."""
    own = F.struct(F.col(endpoint).alias("e"), F.col(value).cast("double").alias("v"))
    more = F.struct(F.lit(name).alias("e"), F.col(ratio).cast("double").alias("v"))
    rows = df.withColumn("_r", F.explode(F.when(F.col(ratio).isNotNull(), F.array(own, more)).otherwise(F.array(own))))
    return rows.withColumns({endpoint: F.col("_r.e"), value: F.col("_r.v")}).drop("_r")


def unmapped(df: DataFrame, endpoint: str, endpoints: Sequence[str]) -> DataFrame:
    """Records whose endpoint is not in the list."""
    return df.filter(~F.coalesce(F.col(endpoint).isin(*endpoints), F.lit(False)))


def mapping_report(df: DataFrame, original: str, endpoint: str) -> DataFrame:
    return df.groupBy(original, endpoint).agg(F.count(F.lit(1)).alias("n"))


def final_columns(df: DataFrame, wanted: Sequence[str]) -> DataFrame:
    """The wanted columns that are there, each once, in the order in which they are wanted."""
    return df.select(*(F.col(f"`{x}`") for x in dict.fromkeys(wanted) if x in df.columns))
