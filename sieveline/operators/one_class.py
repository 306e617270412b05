"""One-class boundary by task: the dual of a one-class support-vector model with the kernel exp(-(x - y)^2).

    least 1/2 a'Ka  with  0 <= a_i <= w_i  and  sum a = nu * sum w;   outlier: f(x) = sum a_i K(x, x_i) < rho

Values fall into cells of 1/64 of the kernel's width: a cell has one place (its mean) and one weight (its rows),
and f within it is its Taylor polynomial of second order, so that the error of f is some 1e-5 of it. What is left of a task's
rows is one row a cell, by one aggregation with partial sums, however many rows a cell has.

A task of at most POINTS cells is solved in one row. A larger one is cut into stretches of as many cells: for a given
rho stretches meet only at their ends, since the kernel is nothing beyond REACH. Each round solves all stretches
for several rho at once, first the even ones and then the odd ones, together with what their neighbours hold near their ends;
the sums of a say between which rho the constraint is met. No row holds more than POINTS cells and two ends of 2 * REACH.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sieveline.operators.keyed import join_back
from sieveline.session import Scratch, cut, few

#: Cells in the kernel's width, and cells of one stretch.
CELLS, POINTS = 64, 2048
#: Beyond this distance the kernel is under 1e-15.
REACH = 6.0
#: Values of rho that a round tries, and rounds: each narrows what rho lies between by (TRIED + 1) / 3.
TRIED, ROUNDS = 16, 8
#: A value is an outlier where f is below rho by more than this share, the tolerance at which such models are commonly fitted: where values lie
#: densely f equals rho for most of them, up to the rounding of the fit, and these are none.
SLACK = 1e-3


def solve(x: np.ndarray, w: np.ndarray, total: float | None, pulls: Sequence[np.ndarray]) -> list[tuple[np.ndarray, float]]:
    """a and rho of least 1/2 a'Ka - pull'a within 0 and w, for each pull; with sum a = total, if there is a total (else rho is 0).

    An interior-point method, whose steps are solved in the space of K's eigenvectors that matter.
    """
    values, vectors = np.linalg.eigh(np.exp(-((x[:, None] - x[None, :]) ** 2)))
    matter = values > max(values[-1], 1.0) * 1e-13
    basis = vectors[:, matter] * np.sqrt(values[matter])
    unit, n = float(w.mean()), len(x)
    top, found = w / unit, []

    def solved(weights: np.ndarray, right: np.ndarray) -> np.ndarray:
        scaled = basis / weights[:, None]
        inner = np.linalg.solve(np.eye(basis.shape[1]) + basis.T @ scaled, scaled.T @ right)
        return right / weights[:, None] - scaled @ inner

    for pull in pulls:
        goal = None if total is None else total / unit
        share = 0.5 if goal is None else goal / top.sum()
        a, low, high, rho = top * share, np.ones(n), np.ones(n), 0.0
        for _ in range(100):
            room = top - a
            gap = float(a @ low + room @ high) / (2 * n)
            off = 0.0 if goal is None else goal - a.sum()
            slope = basis @ (basis.T @ a) - pull / unit - rho
            if gap < 1e-11 and np.abs(slope - low + high).max() < 1e-9 * max(1.0, abs(rho)) and abs(off) < 1e-9 * top.sum():
                break
            aim = 0.1 * gap
            right = -slope + aim / a - aim / room
            both = solved(low / a + high / room, np.column_stack([right, np.ones(n)]))
            turn = 0.0 if goal is None else (off - both[:, 0].sum()) / both[:, 1].sum()
            da = both[:, 0] + turn * both[:, 1]
            dl, dh = aim / a - low - low / a * da, aim / room - high + high / room * da
            step = min(1.0, *(0.995 * float((-v[d < 0] / d[d < 0]).min()) for v, d in ((a, da), (room, -da), (low, dl), (high, dh)) if (d < 0).any()))
            a, low, high, rho = a + step * da, low + step * dl, high + step * dh, rho + step * turn
        found.append((a * unit, rho * unit))
    return found


def field(x: np.ndarray, places: np.ndarray, a: np.ndarray) -> np.ndarray:
    """f and its first two derivatives at x, three rows."""
    d = x[:, None] - places[None, :]
    k = np.exp(-d * d)
    return np.stack([k @ a, (-2 * d * k) @ a, ((4 * d * d - 2) * k) @ a])


def _whole(x: list[float], w: list[float], nu: float) -> tuple:
    """A task in one row: rho, and f with its derivatives at each cell."""
    at, weights = np.array(x), np.array(w)
    if nu >= 1:
        a, rho = weights, float(field(at, at, weights)[0].max())
    else:
        ((a, rho),) = solve(at, weights, nu * float(weights.sum()), [np.zeros(len(at))])
    return float(rho), [x.tolist() for x in field(at, at, a)]


def _ends(halo: list | None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Places, weights and a (for each rho) of what lies near a stretch in its neighbours."""
    parts = [x for x in halo or [] if x["x"]]
    if not parts:
        return np.zeros(0), np.zeros(0), np.zeros((TRIED, 0))
    return np.concatenate([x["x"] for x in parts]), np.concatenate([x["w"] for x in parts]), np.concatenate([np.array(x["a"]) for x in parts], axis=1)


def _stretch(x: list[float], w: list[float], halo: list | None, rhos: list[float]) -> list[list[float]]:
    """a of a stretch for each rho: solved together with its neighbours' cells within REACH, given those beyond."""
    own, (places, weights, near) = np.array(x), _ends(halo)
    along = (places > own[0] - REACH) & (places < own[-1] + REACH)
    at = np.concatenate([own, places[along]])
    pulls = [rho - field(at, places[~along], near[j][~along])[0] for j, rho in enumerate(rhos)]
    return [a[: len(own)].tolist() for a, _ in solve(at, np.concatenate([w, weights[along]]), None, pulls)]


def _stretch_field(x: list[float], a: list[list[float]], halo: list | None) -> list[list[float]]:
    """f and its derivatives at a stretch's cells, for the rho in the middle of those tried."""
    at, (places, _, near), j = np.array(x), _ends(halo), TRIED // 2
    return [y.tolist() for y in field(at, np.concatenate([at, places]), np.concatenate([np.array(a[j]), near[j]]))]


_numbers = T.ArrayType(T.DoubleType())
_rows_of_numbers = T.ArrayType(_numbers)
# one call has a whole stretch of cells: there is nothing to be won by batches of them, which would be large
whole = F.udf(_whole, T.StructType([T.StructField("rho", T.DoubleType()), T.StructField("field", _rows_of_numbers)]), useArrow=False)
stretch = F.udf(_stretch, _rows_of_numbers, useArrow=False)
stretch_field = F.udf(_stretch_field, _rows_of_numbers, useArrow=False)


def _cell(x: Column) -> Column:
    return F.when(F.abs(x) < 2.0**40, F.floor(x * CELLS).cast("double")).otherwise(x * CELLS)


def _halos(state: DataFrame, keys: Sequence[str]) -> DataFrame:
    """keys, block and what the blocks on both sides hold near it."""
    first, last = F.col("_from") + 2 * REACH, F.col("_from") + POINTS / CELLS - 2 * REACH
    below = F.size(F.filter("_x", lambda x: x < first))
    above = F.size(F.filter("_x", lambda x: x >= last))
    part = lambda start, n: F.struct(F.slice("_x", start, n).alias("x"), F.slice("_w", start, n).alias("w"), F.transform("_a", lambda a: F.slice(a, start, n)).alias("a"))
    sent = F.array(
        F.struct((F.col("_block") - 1).alias("to"), part(F.lit(1), below).alias("end")),
        F.struct((F.col("_block") + 1).alias("to"), part(F.greatest(F.size("_x") - above + 1, F.lit(1)), above).alias("end")),
    )
    told = state.select(*keys, F.explode(sent).alias("_s")).filter(F.size("_s.end.x") > 0)
    return told.groupBy(*keys, F.col("_s.to").alias("_block")).agg(F.collect_list("_s.end").alias("_halo"))


def _in_stretches(rows: DataFrame, keys: Sequence[str], nu: float, held: Scratch) -> DataFrame:
    """rows (stretches of large tasks) with _rho and _field."""
    block = [*keys, "_block"]
    half = F.transform("_w", lambda w: w * nu)
    state = held.keep(cut(rows.withColumns({"_a": F.array_repeat(half, TRIED)}), "one-class-stretches"))
    # f is nowhere larger than the rows within REACH, of which three stretches have all
    most = state.select(*keys, F.explode(F.array(F.col("_block") - 1, F.col("_block"), F.col("_block") + 1)).alias("_b"), F.aggregate("_w", F.lit(0.0), lambda s, w: s + w).alias("_sum"))
    most = most.groupBy(*keys, "_b").agg(F.sum("_sum").alias("_sum")).groupBy(*keys).agg(F.lit(0.0).alias("_low"), F.max("_sum").alias("_high"))
    span = held.keep(cut(most, "one-class-span"))
    kept = [x for x in state.columns if x != "_a"]
    for _ in range(ROUNDS):
        tries = F.transform(F.sequence(F.lit(1), F.lit(TRIED)), lambda j: F.col("_low") + (F.col("_high") - F.col("_low")) * j / (TRIED + 1))
        rhos = span.select(*keys, tries.alias("_rhos"))
        for parity in (0, 1):
            met = join_back(join_back(state, _halos(state, keys), block), few(rhos), keys)
            mine = met.filter(F.pmod("_block", F.lit(2)) == parity).select(*kept, stretch("_x", "_w", "_halo", "_rhos").alias("_a"))
            before, state = state, cut(mine.unionByName(state.filter(F.pmod("_block", F.lit(2)) != parity)), "one-class-stretches")
            held.drop(before)
        sums = state.groupBy(*keys).agg(F.first("_total").alias("_total"), F.array(*(F.sum(F.aggregate(F.get("_a", F.lit(j)), F.lit(0.0), lambda s, a: s + a)) for j in range(TRIED))).alias("_sums"))
        under = F.size(F.filter("_sums", lambda s: s <= F.col("_total") * nu))
        grid = (F.col("_high") - F.col("_low")) / (TRIED + 1)
        # the ends were of rho nearby, so there is one place more on both sides
        narrowed = join_back(span, sums, keys).withColumn("_under", under).select(*keys, F.greatest(F.col("_low") + grid * (F.col("_under") - 1), F.lit(0.0)).alias("_low"), (F.col("_low") + grid * (F.col("_under") + 2)).alias("_high"))
        before, span = span, held.keep(cut(narrowed, "one-class-span"))
        held.drop(before)
    middle = F.get("_rhos", F.lit(TRIED // 2))
    met = join_back(join_back(state, _halos(state, keys), block), few(rhos), keys)
    return met.select(*kept, middle.alias("_rho"), stretch_field("_x", "_a", "_halo").alias("_field"))


def one_class_outliers(df: DataFrame, value: str, keys: Sequence[str] = (), nu: float = 0.5) -> DataFrame:
    """df with is_outlier: whether a value lies outside the boundary of its task, fitted to all the task's values by their number.

    About nu of a task's rows lie on or outside its boundary; a task of one value, or of values that are all far apart, has none outside.
    Null, NaN and infinite values (and those beyond 1e300) take no part and are no outliers; null keys are a task.
    """
    x, d = F.col(value).cast("double"), F.col("_v") - F.col("_at")
    fine = x.isNotNull() & ~F.isnan(x) & (F.abs(x) < 1e300)
    with Scratch(df.sparkSession) as held:
        cells = cut(df.filter(fine).groupBy(*keys, _cell(x).alias("_cell")).agg(F.count(F.lit(1)).cast("double").alias("_w"), F.avg(x).alias("_x")), "one-class-cells")
        tasks = cells.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"), F.sum("_w").alias("_total"), F.min("_cell").alias("_first"))
        placed = join_back(cells, tasks, keys).withColumn("_block", F.when(F.col("_n") <= POINTS, F.lit(0)).otherwise(F.floor((F.col("_cell") - F.col("_first")) / POINTS)).cast("double"))
        sorted_ = F.array_sort(F.collect_list(F.struct("_x", "_cell", "_w")))
        grouped = placed.groupBy(*keys, "_block").agg(F.first("_n").alias("_n"), F.first("_total").alias("_total"), ((F.first("_first") + F.col("_block") * POINTS) / CELLS).alias("_from"), sorted_.alias("_p"))
        rows = cut(grouped.withColumns({"_x": F.col("_p._x"), "_cell": F.col("_p._cell"), "_w": F.col("_p._w")}).drop("_p"), "one-class-rows")
        solved = rows.filter(F.col("_n") <= POINTS).withColumn("_s", whole("_x", "_w", F.lit(nu)))
        found = solved.select(*keys, "_x", "_cell", F.col("_s.rho").alias("_rho"), F.col("_s.field").alias("_field"))
        large = rows.filter(F.col("_n") > POINTS)
        if not large.isEmpty():
            found = found.unionByName(_in_stretches(large, keys, nu, held).select(*found.columns))
        each = F.arrays_zip(F.col("_cell"), F.col("_x").alias("at"), *(F.get("_field", F.lit(i)).alias(f"f{i}") for i in range(3)))
        flat = found.select(*keys, "_rho", F.explode(each).alias("_e")).select(*keys, F.col("_e._cell").alias("_cell"), F.col("_e.at").alias("_at"), "_rho", *(F.col(f"_e.f{i}").alias(f"_f{i}") for i in range(3)))
        flat = held.keep(cut(flat, "one-class-cells-solved"))
    f = F.col("_f0") + F.col("_f1") * d + F.col("_f2") * d * d / 2
    both = join_back(df.withColumns({"_v": x, "_cell": F.when(fine, _cell(x))}), few(flat), [*keys, "_cell"])
    flag = F.when(fine, F.coalesce(f < F.col("_rho") * (1 - SLACK), F.lit(False))).otherwise(F.lit(False))
    return both.withColumn("is_outlier", flag).select(*df.columns, "is_outlier")
