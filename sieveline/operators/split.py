"""Train, validation and test parts of exact size.

Ranks in a random but fixed order (the MD5 of an id) are exact and need no sort of a whole task in one place:
the hash's first digits make buckets, whose sizes are summed up, and rows are numbered within buckets only.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from sieveline.functions.cleaning import number
from sieveline.operators.stats import CHUNK, exact_quantiles, join_back, sorted_chunks, to_tasks

DIGITS = 3


def hash_rank(df: DataFrame, keys: Sequence[str], row_id: str, out: str = "_rank", digits: int = DIGITS) -> DataFrame:
    """df with the place (from 1) of each row of a task in the order of md5(row_id), and the task's size in <out>_n."""
    hashed = df.withColumn("_h", F.md5(F.col(row_id).cast("string").cast("binary"))).withColumn("_b", F.substring("_h", 1, digits))
    sizes = hashed.groupBy(*keys, "_b").agg(F.count(F.lit(1)).alias("_size"))
    upto = Window.partitionBy(*keys).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.withColumns({"_before": F.coalesce(F.sum("_size").over(upto), F.lit(0)), f"{out}_n": F.sum("_size").over(Window.partitionBy(*keys))}).drop("_size")
    placed = join_back(hashed, sizes, [*keys, "_b"])
    return placed.withColumn(out, F.col("_before") + F.row_number().over(Window.partitionBy(*keys, "_b").orderBy("_h", row_id))).drop("_h", "_b", "_before")


def _parts(rank: Column, n: Column, test: float, valid: float) -> Column:
    """test for the first ceil(n * test) ranks, then valid of what is left, the share re-based to it."""
    n_test = F.ceil(F.round(n * F.lit(test), 9))
    n_valid = F.ceil(F.round((n - n_test) * F.lit(valid / (1 - test) if test < 1 else 0.0), 9))
    return F.when(rank <= n_test, F.lit("test")).when(rank <= n_test + n_valid, F.lit("valid")).otherwise(F.lit("train"))


def random_split(df: DataFrame, keys: Sequence[str], row_id: str, test: float = 0.2, valid: float = 0.1) -> DataFrame:
    ranked = hash_rank(df, keys, row_id)
    return ranked.withColumn("split", _parts(F.col("_rank"), F.col("_rank_n"), test, valid)).drop("_rank", "_rank_n")


def group_split(df: DataFrame, keys: Sequence[str], group: str, row_id: str, test: float = 0.2, valid: float = 0.1, chunk: int = CHUNK) -> DataFrame:
    """Whole groups, largest first (of equal ones, by first row): test until it has its share, then valid, then train.

    A null group is a group; row_id is a number. What is summed up is sizes of groups and places among groups of one size.
    """
    groups = df.groupBy(*keys, group).agg(F.count(F.lit(1)).alias("_n"), F.min(row_id).alias("_first"))
    sizes = groups.groupBy(*keys, "_n").agg(F.count(F.lit(1)).alias("_of"))
    larger = Window.partitionBy(*keys).orderBy(F.desc("_n")).rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.withColumns({"_above": F.coalesce(F.sum(F.col("_n") * F.col("_of")).over(larger), F.lit(0)), "_all": F.sum(F.col("_n") * F.col("_of")).over(Window.partitionBy(*keys))}).drop("_of")
    # many groups may be of one size, such as those of one row: places come from buckets of the order, not from one window
    same = groups.withColumnRenamed("_n", "_rows")
    same = sorted_chunks(same, [*keys, "_rows"], "_first", group, 0, chunk).select(*keys, group, F.col("_rows").alias("_n"), F.col("_pos").alias("_place"))
    placed = join_back(same, sizes, [*keys, "_n"]).withColumn("_before", F.col("_above") + F.col("_place") * F.col("_n"))
    is_test = F.col("_before") / F.col("_all") < test
    full = placed.groupBy(*keys).agg(F.coalesce(F.max(F.when(is_test, F.col("_before") + F.col("_n"))), F.lit(0)).alias("_full"))
    told = join_back(placed, full, keys)
    split = F.when(is_test, F.lit("test")).when((F.col("_before") - F.col("_full")) / F.col("_all") < valid, F.lit("valid")).otherwise(F.lit("train"))
    return join_back(df, told.select(*keys, group, split.alias("split")), [*keys, group])


def stratified_split(df: DataFrame, keys: Sequence[str], value: str, row_id: str, bins: int = 10, test: float = 0.2, valid: float = 0.1) -> DataFrame:
    """Each stratum split at random: tenths of a number by its quantiles (equal edges fall together), or else the label itself."""
    text = F.col(value).cast("string")
    x = number(text) if dict(df.dtypes)[value] == "string" else F.col(value).cast("double")
    edges = exact_quantiles(df.withColumn("_x", x), keys, "_x", [i / bins for i in range(bins + 1)], "_edges").withColumn("_edges", F.array_distinct("_edges"))
    both = to_tasks(df.withColumn("_x", x), edges, keys)
    bin_ = F.greatest(F.size(F.filter("_edges", lambda e: e < F.col("_x"))), F.lit(1))
    stratum = F.when(F.col("_x").isNull(), F.coalesce(text, F.lit(""))).otherwise(F.concat(F.lit("#"), bin_.cast("string")))
    ranked = hash_rank(both.withColumn("_stratum", stratum), [*keys, "_stratum"], row_id)
    return ranked.withColumn("split", _parts(F.col("_rank"), F.col("_rank_n"), test, valid)).select(*df.columns, "split")


def split(df: DataFrame, method: str, keys: Sequence[str], row_id: str, group: str | None = None, value: str | None = None, test: float = 0.2, valid: float = 0.1) -> DataFrame:
    """By method: random, scaffold (group) or stratified; random where the column that a method needs is missing."""
    if method == "scaffold" and group in df.columns:
        return group_split(df, keys, group, row_id, test, valid)
    if method == "stratified" and value in df.columns:
        return stratified_split(df, keys, value, row_id, test=test, valid=valid)
    if method not in ("random", "scaffold", "stratified"):
        raise ValueError(f"no such split: {method}")
    return random_split(df, keys, row_id, test, valid)
