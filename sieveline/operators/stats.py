"""Scaling, labels and outliers by task.

What a task needs of all its records is aggregated first and joined back, rather than put in one window, so
that a task with a third of all records is no larger in any one place.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from sieveline.operators.keyed import join_back, to_tasks
from sieveline.operators.one_class import one_class_outliers
from sieveline.session import Scratch, cut, few, small

#: Of approximate quantiles: their error in rank is at most a task's rows over this.
QUANTILE_ACCURACY = 10_000
#: Rows of a task's sorted order that one window holds.
CHUNK = 200_000
#: Buckets of a task's values that is larger than that.
SPLITS = 1000
#: Rounds of a mixture's fit that one plan holds.
STEPS = 8


def zscore(df: DataFrame, keys: Sequence[str], value: str, out: str | None = None) -> DataFrame:
    """value minus its task's mean, over the population's standard deviation; 0 where that is 0, null for null."""
    stats = df.groupBy(*keys).agg(F.avg(value).alias("_mean"), F.stddev_pop(value).alias("_std"))
    scaled = F.when(F.col(value).isNotNull(), F.when(F.col("_std") == 0, F.lit(0.0)).otherwise((F.col(value) - F.col("_mean")) / F.col("_std")))
    return to_tasks(df, stats, keys).withColumn(out or f"{value}_scaled", scaled).drop("_mean", "_std")


def classification_label(text: Column, value: Column, threshold: float, high_is_active: bool = True, named: Column | None = None) -> Column:
    """active or inactive: the text itself where named says that the task's labels are words, else by the threshold."""
    active = value >= threshold if high_is_active else value <= threshold
    by_number = F.when(value.isNull(), F.lit("Not classified")).when(active, F.lit("active")).otherwise(F.lit("inactive"))
    return by_number if named is None else F.when(named, F.lower(text)).otherwise(by_number)


def labels(df: DataFrame, keys: Sequence[str], text: str, value: str, threshold: float, high_is_active: bool = True, out: str = "Classification_label") -> DataFrame:
    """Classification labels; a task whose values are all active or inactive in some spelling keeps them."""
    stats = df.groupBy(*keys).agg(F.bool_and(F.lower(F.col(text)).isin("active", "inactive")).alias("_named"))
    return to_tasks(df, stats, keys).withColumn(out, classification_label(F.col(text), F.col(value), threshold, high_is_active, F.coalesce("_named", F.lit(False)))).drop("_named")


def normality(df: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """keys, n, k2 and p of D'Agostino and Pearson's test; null for fewer than 8 values or no spread."""
    moments = df.groupBy(*keys).agg(F.count(value).alias("n"), F.skewness(value).alias("_g1"), F.kurtosis(value).alias("_g2"))
    n, g1, g2, y, w, x, root, a, d = (F.col(f"_{k}") for k in ("n", "g1", "g2", "y", "w", "x", "root", "a", "d"))
    steps = moments.withColumn("_n", F.when((F.col("n") >= 8) & g1.isNotNull() & ~F.isnan(g1), F.col("n").cast("double")))
    # skewness: a symmetric sample counts as one of 1
    steps = steps.withColumn("_y", g1 * F.sqrt((n + 1) * (n + 3) / (6 * (n - 2)))).withColumn("_y", F.when(y == 0, F.lit(1.0)).otherwise(y))
    steps = steps.withColumn("_w", 3 * (n * n + 27 * n - 70) * (n + 1) * (n + 3) / ((n - 2) * (n + 5) * (n + 7) * (n + 9))).withColumn("_w", F.sqrt(2 * (w - 1)) - 1)
    steps = steps.withColumn("_z1", F.asinh(y / F.sqrt(2 / (w - 1))) / F.sqrt(0.5 * F.log(w)))
    # kurtosis
    steps = steps.withColumn("_x", (g2 + 3 - 3 * (n - 1) / (n + 1)) / F.sqrt(24 * n * (n - 2) * (n - 3) / ((n + 1) * (n + 1) * (n + 3) * (n + 5))))
    steps = steps.withColumn("_root", 6 * (n * n - 5 * n + 2) / ((n + 7) * (n + 9)) * F.sqrt(6 * (n + 3) * (n + 5) / (n * (n - 2) * (n - 3))))
    steps = steps.withColumn("_a", 6 + 8 / root * (2 / root + F.sqrt(1 + 4 / (root * root)))).withColumn("_d", 1 + x * F.sqrt(2 / (a - 4)))
    third = F.sign(d) * F.cbrt((1 - 2 / a) / F.abs(F.when(d != 0, d)))
    steps = steps.withColumn("_z2", (1 - 2 / (9 * a) - third) / F.sqrt(2 / (9 * a))).withColumn("k2", F.col("_z1") * F.col("_z1") + F.col("_z2") * F.col("_z2"))
    return steps.select(*keys, "n", "k2", F.exp(-F.col("k2") / 2).alias("p"))


def exact_quantiles(df: DataFrame, keys: Sequence[str], value: str, shares: Sequence[float], out: str = "quantiles") -> DataFrame:
    """keys and the quantiles of each task, exact and interpolated between neighbours, in the order of shares.

    A first pass brackets each quantile by approximate ones, whose error in rank has a bound (one in small
    tasks, where they are exact); a second counts what is outside each bracket and orders only the distinct
    values in it, some ten-thousandths of a task.
    """
    margin = 2 / QUANTILE_ACCURACY
    known = df.filter(F.col(value).isNotNull()).select(*keys, F.col(value).cast("double").alias("_v"))
    bounds = known.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("_n"),
        F.min("_v").alias("_min"),
        F.max("_v").alias("_max"),
        F.percentile_approx("_v", [max(0.0, x - margin) for x in shares], QUANTILE_ACCURACY).alias("_lows"),
        F.percentile_approx("_v", [min(1.0, x + margin) for x in shares], QUANTILE_ACCURACY).alias("_highs"),
    )
    brackets = F.array(
        *(
            F.struct(F.lit(i).alias("i"), F.lit(float(x)).alias("p"), (F.col("_min") if x <= margin else F.get("_lows", F.lit(i))).alias("low"), (F.col("_max") if x >= 1 - margin else F.get("_highs", F.lit(i))).alias("high"))
            for i, x in enumerate(shares)
        )
    )
    both = to_tasks(known, bounds.select(*keys, "_n", brackets.alias("_b")), keys).select(*keys, "_v", "_n", F.explode("_b").alias("_b"))
    # outside a bracket the number of values matters and the one next to it; in it, how often each value occurs
    side = F.when(F.col("_v") < F.col("_b.low"), -1).when(F.col("_v") > F.col("_b.high"), 1).otherwise(0)
    placed = both.select(*keys, "_n", "_v", F.col("_b.i").alias("_i"), F.col("_b.p").alias("_p"), side.alias("_side")).withColumn("_in", F.when(F.col("_side") == 0, F.col("_v")))
    counts = placed.groupBy(*keys, "_n", "_i", "_p", "_side", "_in").agg(F.count(F.lit(1)).alias("_c"), F.max("_v").alias("_last"), F.min("_v").alias("_next"))
    counts = counts.withColumn("_at", F.when(F.col("_side") < 0, F.col("_last")).otherwise(F.col("_next")))
    upto = counts.withColumn("_upto", F.sum("_c").over(Window.partitionBy(*keys, "_i").orderBy("_at")))
    rank = (F.col("_n") - 1) * F.col("_p")
    found = upto.groupBy(*keys, "_i").agg(
        F.min(F.when(F.col("_upto") > F.floor(rank), F.col("_at"))).alias("_a"), F.min(F.when(F.col("_upto") > F.ceil(rank), F.col("_at"))).alias("_z"), F.first(rank - F.floor(rank)).alias("_part")
    )
    values = found.withColumn("_q", F.when(F.col("_part") == 0, F.col("_a")).otherwise(F.col("_a") + (F.col("_z") - F.col("_a")) * F.col("_part")))
    return values.groupBy(*keys).agg(F.transform(F.array_sort(F.collect_list(F.struct("_i", "_q"))), lambda x: x["_q"]).alias(out))


def iqr_outliers(df: DataFrame, keys: Sequence[str], value: str, out: str = "is_outlier") -> DataFrame:
    """df with whether a value lies more than 1.5 quartile ranges outside the quartiles (exact, interpolated)."""
    q = exact_quantiles(df, keys, value, (0.25, 0.75), "_q")
    low, high = F.get("_q", F.lit(0)), F.get("_q", F.lit(1))
    flag = (F.col(value) < low - 1.5 * (high - low)) | (F.col(value) > high + 1.5 * (high - low))
    return to_tasks(df, q, keys).withColumn(out, F.coalesce(flag, F.lit(False))).drop("_q")


def sorted_chunks(df: DataFrame, keys: Sequence[str], value: str, row_id: str, reach: int, chunk: int = CHUNK) -> DataFrame:
    """df by place in each task's sorted order, in chunks that overlap by reach rows on both sides.

    Adds _n (the task's rows), _pos (from 0), _chunk and _own (whether the row belongs to this chunk). Places are
    exact: values fall into buckets between approximate quantiles, buckets' sizes are summed, and rows are
    numbered within buckets only. A value that is a quantile twice has many rows: these are a bucket of their own, which is
    dealt out by a hash of row_id, in whose order its rows then come.
    """
    splits = F.percentile_approx(value, [i / SPLITS for i in range(1, SPLITS)], QUANTILE_ACCURACY)
    bounds = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"), splits.alias("_splits"))
    again = F.array_distinct(F.filter("_splits", lambda x, i: x == F.get("_splits", i - 1)))
    bounds = bounds.select(*keys, "_n", F.when(F.col("_n") > chunk, F.array_distinct("_splits")).otherwise(F.array()).alias("_splits"), F.when(F.col("_n") > chunk, again).otherwise(F.array()).alias("_often"))
    often = F.coalesce(F.array_contains("_often", F.col(value)), F.lit(False))
    bucket = 2 * F.size(F.filter("_splits", lambda x: x < F.col(value))) + often.cast("int")
    part = F.when(often, F.substring(F.md5(F.col(row_id).cast("string").cast("binary")), 1, 3)).otherwise(F.lit(""))
    placed = to_tasks(df, bounds, keys).withColumns({"_bucket": bucket, "_part": part}).drop("_splits", "_often")
    sizes = placed.groupBy(*keys, "_bucket", "_part").agg(F.count(F.lit(1)).alias("_size"))
    before = F.coalesce(F.sum("_size").over(Window.partitionBy(*keys).orderBy("_bucket", "_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    placed = join_back(placed, sizes.select(*keys, "_bucket", "_part", before.alias("_before")), [*keys, "_bucket", "_part"])
    place = F.col("_before") + F.row_number().over(Window.partitionBy(*keys, "_bucket", "_part").orderBy(value, row_id)) - 1
    placed = placed.withColumn("_pos", place).drop("_bucket", "_part", "_before")
    at = lambda x: F.floor(x / chunk)
    chunks = F.sequence(at(F.greatest(F.col("_pos") - reach, F.lit(0))), at(F.least(F.col("_pos") + reach, F.col("_n") - 1)))
    return placed.withColumn("_chunk", F.explode(chunks)).withColumn("_own", F.col("_chunk") == at(F.col("_pos")))


def local_outlier_factor(df: DataFrame, keys: Sequence[str], value: str, row_id: str, k: int = 20, limit: float = 1.5, chunk: int = CHUNK) -> DataFrame:
    """df with lof and is_outlier: the local outlier factor of one number, by its k nearest in sorted order.

    The nearest k are among the k before and the k after; ties go to the earlier place. A row's factor depends
    on the 3k rows to either side, so large tasks are cut into chunks of their sorted order that overlap by as
    many. Null values get null.
    """
    known = sorted_chunks(df.filter(F.col(value).isNotNull()), keys, value, row_id, 3 * k, chunk)
    w = Window.partitionBy(*keys, "_chunk").orderBy("_pos")
    near_rows = w.rowsBetween(-k, k)
    near = known.withColumns({"_i": F.row_number().over(w), "_near": F.collect_list(F.col(value)).over(near_rows)})
    near = near.withColumn("_k", F.least(F.lit(k), F.col("_n") - 1)).withColumn("_at", F.least(F.col("_i"), F.lit(k + 1)).cast("int") - 1)
    first = F.col("_i") - F.col("_at")
    steps = F.transform("_near", lambda x, i: F.struct(F.abs(x - F.col(value)).alias("d"), (first + i).alias("j")))
    others = F.array_sort(F.filter(steps, lambda x: x["j"] != F.col("_i")))
    near = near.withColumn("_nn", F.slice(others, F.lit(1), F.greatest(F.col("_k").cast("int"), F.lit(0)))).withColumn("_kd", F.get("_nn", F.size("_nn") - 1)["d"])
    around = near.withColumn("_kds", F.collect_list(F.coalesce("_kd", F.lit(0.0))).over(near_rows))
    reach = F.transform("_nn", lambda x: F.greatest(x["d"], F.get("_kds", (x["j"] - first).cast("int"))))
    total = F.aggregate(reach, F.lit(0.0), lambda a, x: a + x)
    dense = around.withColumn("_lrd", F.when(F.col("_k") > 0, 1 / (total / F.when(F.col("_k") > 0, F.col("_k")) + 1e-10)))
    dense = dense.withColumn("_lrds", F.collect_list(F.coalesce("_lrd", F.lit(0.0))).over(near_rows))
    mean = F.aggregate(F.transform("_nn", lambda x: F.get("_lrds", (x["j"] - first).cast("int"))), F.lit(0.0), lambda a, x: a + x) / F.when(F.col("_k") > 0, F.col("_k"))
    found = dense.withColumn("lof", mean / F.col("_lrd")).filter("_own")
    found = found.select(*df.columns, "lof").unionByName(df.filter(F.col(value).isNull()).withColumn("lof", F.lit(None).cast("double")))
    return found.withColumn("is_outlier", F.coalesce(F.col("lof") > limit, F.lit(False)))


def _shares(value: Column) -> tuple[Column, Column]:
    """For the parts (_w, _m, _s: weights, means, variances) of a mixture: log density of value, and the share that each part has in it."""
    each = F.transform(F.arrays_zip("_w", "_m", "_s"), lambda p: F.log(p["_w"]) - 0.5 * F.log(2 * math.pi * p["_s"]) - (value - p["_m"]) * (value - p["_m"]) / (2 * p["_s"]))
    most = F.array_max(each)
    density = most + F.log(F.aggregate(each, F.lit(0.0), lambda a, x: a + F.exp(x - most)))
    return density, F.transform(each, lambda x: F.exp(x - density))


def gaussian_mixtures(df: DataFrame, value: str, keys: Sequence[str] = (), parts: int = 2, rounds: int = 100, least_gain: float = 1e-3) -> DataFrame:
    """keys, n, weights, means, variances and rounds of a mixture of normal distributions for each task.

    Expectation and maximisation run for all tasks at once: each round joins the tasks' parts to their distinct
    values, with how often they occur, and is one aggregation. It begins with equal weights, the task's variance, and means spread evenly from one deviation
    below its mean to one above. A task stops when its mean log likelihood rises by less than least_gain, or after rounds. Null and NaN values
    don't count; variances are raised by 1e-6.
    """
    x, floor = F.col("_v"), 1e-6
    known = df.filter(F.col(value).isNotNull() & ~F.isnan(F.col(value).cast("double"))).select(*keys, F.col(value).cast("double").alias("_v"))
    with Scratch(df.sparkSession) as held:
        counted = cut(known.groupBy(*keys, "_v").agg(F.count(F.lit(1)).cast("double").alias("_c")), "mixture-values")
        first = counted.groupBy(*keys).agg(F.sum("_c").alias("_n"), (F.sum(x * F.col("_c")) / F.sum("_c")).alias("_mean"))
        spread = join_back(counted, first, keys).groupBy(*keys).agg(F.first("_n").alias("_n"), F.first("_mean").alias("_mean"), (F.sum(F.col("_c") * (x - F.col("_mean")) * (x - F.col("_mean"))) / F.sum("_c")).alias("_var"))
        steps = [0.0] if parts == 1 else [2 * i / (parts - 1) - 1 for i in range(parts)]
        means = F.array(*(F.col("_mean") + F.lit(z) * F.sqrt("_var") for z in steps))
        start = spread.select(*keys, "_n", F.array_repeat(F.lit(1 / parts), parts).alias("_w"), means.alias("_m"), F.array_repeat(F.col("_var") + floor, parts).alias("_s"), F.lit(float("-inf")).alias("_ll"), F.lit(0).alias("_round"), F.lit(False).alias("_done"))
        if not keys:  # an empty table has one empty task
            start = start.filter("_n > 0")
        now = cut(start, "mixture-start")
        told = F.broadcast if small(now) else lambda t: t

        kept = ("_n", "_w", "_m", "_s", "_ll", "_round", "_done")

        def step(now: DataFrame) -> DataFrame:
            """One round; tasks go through it once, so that rounds may follow each other in one plan."""
            parts_of = told(now).select(*(F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)), *kept)
            met = counted.join(parts_of, [F.col(k).eqNullSafe(F.col(f"_k{i}")) for i, k in enumerate(keys)]) if keys else counted.crossJoin(parts_of)
            density, shares = _shares(x)
            met = met.select(*keys, "_c", "_v", *kept, density.alias("_d"), shares.alias("_r"))
            of = lambda j, y: F.sum(F.col("_c") * F.get("_r", F.lit(j)) * y)
            away = lambda j: x - F.get("_m", F.lit(j))
            sums = [F.array(of(j, F.lit(1.0)), of(j, away(j)), of(j, away(j) * away(j))) for j in range(parts)]
            both = met.groupBy(*keys).agg(*(F.first(y).alias(y) for y in kept), F.array(*sums).alias("_sums"), (F.sum(F.col("_c") * F.col("_d")) / F.sum("_c")).alias("_new"))
            if not keys:
                both = both.filter("_n IS NOT NULL")
            at = lambda i: F.transform("_sums", lambda p: F.get(p, F.lit(i)))
            size = F.transform("_sums", lambda p: F.greatest(F.get(p, F.lit(0)), F.lit(1e-300)))
            moved = F.zip_with(at(1), size, lambda a, n: a / n)
            fresh = ~F.col("_done")
            return both.select(
                *keys, "_n",
                F.when(fresh, F.transform(size, lambda n: n / F.col("_n"))).otherwise(F.col("_w")).alias("_w"),
                F.when(fresh, F.zip_with("_m", moved, lambda m, d: m + d)).otherwise(F.col("_m")).alias("_m"),
                F.when(fresh, F.zip_with(F.zip_with(at(2), size, lambda a, n: a / n), moved, lambda v, d: F.greatest(v - d * d, F.lit(0.0)) + floor)).otherwise(F.col("_s")).alias("_s"),
                F.when(fresh, F.col("_new")).otherwise(F.col("_ll")).alias("_ll"),
                F.when(fresh, F.col("_round") + 1).otherwise(F.col("_round")).alias("_round"),
                (F.col("_done") | (F.abs(F.col("_new") - F.col("_ll")) < least_gain) | (F.col("_round") + 1 >= rounds)).alias("_done"),
            )

        while not now.filter("NOT _done").isEmpty():
            later = now
            for _ in range(STEPS):
                later = step(later)
            before, now = now, cut(later, "mixture-step")
            held.drop(before)
        held.keep(now)
    return now.select(*keys, F.col("_n").cast("bigint").alias("n"), F.col("_w").alias("weights"), F.col("_m").alias("means"), F.col("_s").alias("variances"), F.col("_round").alias("rounds"))


def gaussian_mixture_outliers(df: DataFrame, value: str, parts: int = 2, share: float = 0.05, keys: Sequence[str] = ()) -> DataFrame:
    """df with log_density under its task's mixture of normal distributions, and whether it is below the share's exact quantile of these.

    Rows without a value have no density, and are no outliers.
    """
    fitted = gaussian_mixtures(df, value, keys, parts).select(*keys, F.col("weights").alias("_w"), F.col("means").alias("_m"), F.col("variances").alias("_s"))
    x = F.col(value).cast("double")
    scored = join_back(df, few(fitted), keys).withColumn("log_density", F.when(x.isNotNull() & ~F.isnan(x), _shares(x)[0])).drop("_w", "_m", "_s")
    limit = exact_quantiles(scored, keys, "log_density", (share,), "_limit")
    return to_tasks(scored, limit, keys).withColumn("is_outlier", F.coalesce(F.col("log_density") < F.get("_limit", F.lit(0)), F.lit(False))).drop("_limit")


def outliers(df: DataFrame, keys: Sequence[str], value: str, row_id: str, task_type: str | Column = "regression") -> DataFrame:
    """df with is_outlier: by quartiles in tasks that look normal, else by the local outlier factor (regression) or a one-class boundary.

    task_type is one for all records, or a column with that of each task (null: regression). A boundary is fitted only where
    there are records for it.
    """
    gate = normality(df, keys, value).select(*keys, (F.coalesce("p", F.lit(0.0)) >= 0.05).alias("_normal"))
    both = cut(to_tasks(df, gate, keys), "gated")  # read by each of the ways below, several times
    straight = iqr_outliers(both.filter("_normal"), keys, value)
    rest = both.filter("NOT _normal")
    if isinstance(task_type, Column):
        kind = F.coalesce(task_type, F.lit("regression"))
        others = rest.filter(kind != "regression")
        found = straight.unionByName(local_outlier_factor(rest.filter(kind == "regression"), keys, value, row_id).drop("lof"))
        found = found if others.isEmpty() else found.unionByName(one_class_outliers(others, value, keys))
    else:
        found = straight.unionByName(local_outlier_factor(rest, keys, value, row_id).drop("lof") if task_type == "regression" else one_class_outliers(rest, value, keys))
    return found.drop("_normal")
