"""Small results for reports and plots."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sieveline.operators.dedup import first_of_each


def value_counts(df: DataFrame, *columns: str) -> DataFrame:
    return df.groupBy(*columns).agg(F.count(F.lit(1)).alias("n"))


def top_groups(df: DataFrame, column: str, k: int) -> DataFrame:
    """The k most frequent values, by name where they tie."""
    return value_counts(df, column).orderBy(F.desc("n"), column).limit(k)


def histogram(df: DataFrame, value: str, width: float) -> DataFrame:
    """bin, its lower edge and n, for bins of one width from the least value; the least value is a scalar subquery."""
    low = df.agg(F.min(value).alias("_low"))
    binned = df.filter(F.col(value).isNotNull()).crossJoin(F.broadcast(low)).withColumn("bin", F.floor((F.col(value) - F.col("_low")) / F.lit(width)))
    return binned.groupBy("bin", "_low").agg(F.count(F.lit(1)).alias("n")).select("bin", (F.col("_low") + F.col("bin") * F.lit(width)).alias("lower"), "n")


def density(df: DataFrame, value: str, points: list[float], bandwidth: float) -> DataFrame:
    """point and density: the kernel density (normal kernel) at a few points, all in one aggregation."""
    scale = 1 / (bandwidth * (2 * 3.141592653589793) ** 0.5)
    kernels = [F.avg(F.exp(-F.pow((F.col(value) - p) / F.lit(bandwidth), F.lit(2.0)) / 2) * scale) for p in points]
    both = df.agg(F.array(*(F.struct(F.lit(float(p)).alias("point"), k.alias("density")) for p, k in zip(points, kernels))).alias("all"))
    return both.select(F.explode("all").alias("x")).select("x.point", "x.density")


def gallery(df: DataFrame, key: str, row_id: str, n: int = 10) -> DataFrame:
    """The first n distinct entities."""
    return first_of_each(df.filter(F.col(key).isNotNull()), key, row_id).orderBy(row_id).limit(n)
