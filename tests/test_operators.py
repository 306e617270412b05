import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from sieveline import session
from sieveline.operators import chem, dedup, features, matrix, one_class, quality, split, stats, summary
from sieveline.plans import registry

KEYS = ("k",)


def frame(spark, rows, schema):
    return spark.createDataFrame(rows, schema)


def test_zscore_is_of_the_population(spark):
    df = frame(spark, [("a", 1.0), ("a", 3.0), ("b", 5.0), ("b", 5.0), (None, 2.0), ("a", None)], "k string, v double")
    got = sorted(((x.k or "", x.v or 0, x.v_scaled) for x in stats.zscore(df, KEYS, "v").collect()), key=str)
    assert got == sorted([("", 2.0, 0.0), ("a", 1.0, -1.0), ("a", 3.0, 1.0), ("b", 5.0, 0.0), ("b", 5.0, 0.0), ("a", 0, None)], key=str)


def test_rows_of_a_task_stay_where_they_are(spark, monkeypatch):
    """What is told of few tasks goes to the rows; a task with half of all rows is not read in one place."""
    df = spark.range(0, 4000, 1, 4).select(F.when(F.col("id") % 2 == 0, "a").when(F.col("id") % 4 == 1, "b").alias("k"), F.col("id").cast("double").alias("v"))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # as for tables that Spark takes to be large
    try:
        for out in (stats.zscore(df, KEYS, "v", "x"), stats.labels(df, KEYS, "k", "v", 7.0, out="x"), stats.iqr_outliers(df, KEYS, "v", "x")):
            assert [x.n for x in out.groupBy(F.spark_partition_id()).agg(F.count("x").alias("n")).collect()] == [1000] * 4
        told = stats.zscore(df, KEYS, "v", "x").agg(F.count("x"), F.count_distinct("k"), F.round(F.sum(F.col("x") * F.col("x")), 6)).first()
        monkeypatch.setattr(session, "BROADCAST_BYTES", 0)
        dealt = stats.zscore(df, KEYS, "v", "x").agg(F.count("x"), F.count_distinct("k"), F.round(F.sum(F.col("x") * F.col("x")), 6)).first()
        assert told == dealt == (4000, 2, 4000.0)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_normality_of_known_samples(spark):
    eight = frame(spark, [("a", float(x)) for x in range(1, 9)], "k string, v double")
    from scipy_free import k2  # noqa: PLC0415

    got = stats.normality(eight, KEYS, "v").first()
    assert math.isclose(got.k2, k2([float(x) for x in range(1, 9)]), rel_tol=1e-9) and math.isclose(got.p, math.exp(-got.k2 / 2))
    assert stats.normality(frame(spark, [("a", 1.0)] * 9, "k string, v double"), KEYS, "v").first().k2 is None
    assert stats.normality(eight.limit(5), KEYS, "v").first().k2 is None


def test_iqr(spark):
    df = frame(spark, [("a", x) for x in (1.0, 2.0, 3.0, 4.0, 100.0)] + [("a", None)], "k string, v double")
    assert [x.v for x in stats.iqr_outliers(df, KEYS, "v").filter("is_outlier").collect()] == [100.0]


@pytest.mark.parametrize("values", [[1.0, 1.1, 1.2, 1.3, 9.0], [1.0], [2.0, 2.0, 2.0], [0.0, 5.0]])
def test_lof_against_brute_force(spark, values):
    k = min(2, len(values) - 1)
    df = frame(spark, [("a", i, v) for i, v in enumerate(values)] + [("a", 99, None)], "k string, i long, v double")
    got = {x.i: x.lof for x in stats.local_outlier_factor(df, KEYS, "v", "i", k=2).collect()}
    assert got.pop(99) is None
    if k == 0:
        assert got == {0: None}
        return
    order = sorted(range(len(values)), key=lambda i: (values[i], i))
    near = {i: sorted((abs(values[i] - values[j]), order.index(j), j) for j in range(len(values)) if j != i)[:k] for i in range(len(values))}
    reach = {i: max(x[0] for x in near[i]) for i in near}
    lrd = {i: 1 / (sum(max(d, reach[j]) for d, _, j in near[i]) / k + 1e-10) for i in near}
    for i in near:
        assert math.isclose(got[i], sum(lrd[j] for _, _, j in near[i]) / k / lrd[i], rel_tol=1e-9)


def dense_one_class(values, nu=0.5):
    """Flags of each value by pairs of coefficients, the worst pair first, over all rows, each with a coefficient in 0 to 1."""
    x = np.array(values)
    k, n = np.exp(-((x[:, None] - x[None, :]) ** 2)), len(x)
    a = np.clip(nu * n - np.arange(n), 0, 1.0)
    f = k @ a
    for _ in range(200_000):
        up, down = np.where(a < 1 - 1e-12, f, np.inf), np.where(a > 1e-12, f, -np.inf)
        i, j = int(up.argmin()), int(down.argmax())
        if down[j] - up[i] < 1e-9:
            break
        curve = max(2 - 2 * k[i, j], 1e-12)
        step = min((f[j] - f[i]) / curve, 1 - a[i], a[j])
        a[i], a[j] = a[i] + step, a[j] - step
        f += step * (k[:, i] - k[:, j])
    rho = (up[i] + down[j]) / 2
    return f / rho - 1


def test_one_class_against_pairs(spark):
    rng = np.random.default_rng(3)
    tasks = {"e": rng.exponential(size=150), "f": rng.normal(size=150) * 2, "a": rng.normal(size=60), "b": rng.normal(size=40) * 10, "c": np.repeat([1.0, 1.5, 9.0], [30, 5, 3]), "d": np.array([7.0]), None: rng.uniform(-2, 2, 50) * 3 + 1e6}
    df = frame(spark, [(k, i, float(v)) for k, vs in tasks.items() for i, v in enumerate(vs)], "k string, i long, v double")
    got = {(x.k, x.i): x.is_outlier for x in one_class.one_class_outliers(df, "v", KEYS).collect()}
    assert len(got) == df.count()
    told = 0
    for k, values in tasks.items():
        for i, away in enumerate(dense_one_class(values)):
            if abs(away + one_class.SLACK) > 3e-4:  # cells of values and the two solvers differ by less
                told += 1
                assert got[k, i] == (away < -one_class.SLACK), (k, i, away)
    assert told > len(got) // 2 and sum(got.values()) > 30


def test_query_of_boundaries(spark, data):
    rows = spark.read.parquet(f"{data}/events.parquet").select("event_id", "event_type", F.log1p("value").alias("level")).collect()
    got = {x.event_id: x.is_outlier for x in registry.QUERIES["one_class_by_task"](spark, data).collect()}
    told = 0
    for kind in {x.event_type for x in rows}:
        ids, values = zip(*((x.event_id, x.level) for x in rows if x.event_type == kind))
        for i, away in zip(ids, dense_one_class(values)):
            if abs(away + one_class.SLACK) > 3e-4:
                told += 1
                assert got[i] == (away < -one_class.SLACK), (kind, i, away)
    assert len(got) == len(rows) and told > len(rows) // 2


def test_one_class_in_stretches(spark, monkeypatch):
    """A task of more cells than a row may hold gets the flags that it has in one row; without keys too."""
    rng = np.random.default_rng(5)
    values = np.concatenate([rng.normal(size=400) * 4, rng.uniform(0, 70, 1500), [500.0, 501.0, 1e9]])
    df = frame(spark, [("a", i, float(v)) for i, v in enumerate(values)] + [("b", 1, 1.0)], "k string, i long, v double")
    one = {x.i: x.is_outlier for x in one_class.one_class_outliers(df.filter("k = 'a'"), "v").collect()}
    monkeypatch.setattr(one_class, "POINTS", 1024)
    many = {x.i: x.is_outlier for x in one_class.one_class_outliers(df, "v", KEYS).filter("k = 'a'").collect()}
    differ = [i for i in one if one[i] != many[i]]
    assert len(one) == len(many) == len(values) and len(differ) <= len(values) // 100, differ


def test_one_class_of_odd_values(spark):
    rows = [("a", 1, None), ("a", 2, math.nan), ("a", 3, math.inf), ("b", 4, None), *(("a", 10 + i, 1.0) for i in range(30)), ("a", 99, 1e308)]
    df = frame(spark, rows, "k string, i long, v double").withColumn("_at", F.lit("x")).drop("_at")
    got = one_class.one_class_outliers(df, "v", KEYS)
    assert got.columns == [*df.columns, "is_outlier"] and got.count() == len(rows) and got.filter("is_outlier").count() == 0
    assert one_class.one_class_outliers(df.limit(0), "v", KEYS).count() == 0 == one_class.one_class_outliers(df.limit(0), "v").count()


def test_boundary_by_kind_of_task(spark):
    """Classification tasks get a boundary each; the others keep the local outlier factor."""
    rows = [("a", i, 0.0, "classification") for i in range(3000)] + [("a", 20_000, 5.0, "classification"), ("a", 20_001, None, "classification")]
    rows += [("b", 30_000 + i, 5.0, "classification") for i in range(20)] + [(None, 40_000, 0.0, "classification"), ("r", 50_000, 1.0, "regression")]
    df = frame(spark, rows, "k string, i long, v double, t string")
    got = stats.outliers(df, KEYS, "v", "i", F.col("t"))
    assert got.count() == len(rows) and [x.i for x in got.filter("is_outlier").collect()] == [20_000]
    assert stats.outliers(df.filter("k = 'a'"), KEYS, "v", "i", "classification").filter("is_outlier").count() == 1


def test_strict_dedup_and_recovery(spark):
    rows = [(1, "a", "x"), (2, "a", "x"), (3, "a", "y"), (4, "b", "x"), (5, "b", "x"), (6, "c", None), (7, "c", None), (8, "c", "z"), (9, "d", None)]
    df = frame(spark, rows, "i long, k string, s string")
    assert sorted(x.i for x in dedup.strict(df, KEYS, "s").collect()) == [3, 8, 9]
    assert sorted(x.i for x in dedup.strict_or_first(df, KEYS, "s", "i").collect()) == [3, 4, 8, 9]
    kept = dedup.strict_or_first(df.withColumn("pk", F.col("k") == "a"), KEYS, "s", "i", "pk")
    assert sorted(x.i for x in kept.collect()) == [1, 2, 3, 4, 8, 9]


def test_random_split_sizes(spark):
    df = frame(spark, [(i, "a" if i < 77 else None) for i in range(100)], "i long, k string")
    got = split.random_split(df, KEYS, "i", 0.2, 0.1)
    counts = {(x.k, x.split): x.n for x in got.groupBy("k", "split").agg(F.count("*").alias("n")).collect()}
    assert counts == {("a", "test"): 16, ("a", "valid"): 8, ("a", "train"): 53, (None, "test"): 5, (None, "valid"): 3, (None, "train"): 15}


@pytest.mark.parametrize("chunk", [stats.CHUNK, 3])
@pytest.mark.parametrize("sizes", [[16, 15] + [5] * 8 + [2, 2, 1, 1], [1] * 10, [50, 1], [3, 3, 3, 1], [2] * 7 + [1] * 300])
def test_group_split_is_the_greedy_fill(spark, sizes, chunk):
    rows, first = [], 0
    for g, n in enumerate(sizes):
        rows += [(first + i, g, "a") for i in range(n)]
        first += n
    got = {(x.g): x.split for x in split.group_split(frame(spark, rows, "i long, g long, k string"), KEYS, "g", "i", chunk=chunk).select("g", "split").distinct().collect()}
    total, test, valid, want = len(rows), 0, 0, {}
    for g in sorted(range(len(sizes)), key=lambda g: -sizes[g]):
        if test / total < 0.2:
            want[g], test = "test", test + sizes[g]
        elif valid / total < 0.1:
            want[g], valid = "valid", valid + sizes[g]
        else:
            want[g] = "train"
    assert got == want


def test_stratified_split_by_label(spark):
    df = frame(spark, [(i, "active" if i % 2 else "inactive", "a") for i in range(40)], "i long, v string, k string")
    counts = {(x.v, x.split): x.n for x in split.stratified_split(df, KEYS, "v", "i").groupBy("v", "split").agg(F.count("*").alias("n")).collect()}
    assert counts[("active", "test")] == counts[("inactive", "test")] == 4
    with pytest.raises(ValueError):
        split.split(df, "other", KEYS, "i")


def test_quorum(spark):
    rows = [("r", str(x)) for x in range(60)] + [("c", "active")] * 25 + [("c", "inactive")] * 25 + [("f", ">5")] * 40 + [("f", "3")] * 20 + [("few", "1.5")] * 3
    got = {x.k: (x.task_type, x.has_quorum) for x in quality.task_profile(frame(spark, rows, "k string, v string"), KEYS, "v").collect()}
    assert got == {"r": ("regression", True), "c": ("classification", True), "f": ("regression", False), "few": ("regression", False)}
    with pytest.raises(quality.TrainingQuorumError):
        quality.require_quorum(frame(spark, rows[-3:], "k string, v string"), "v", "regression")


@pytest.mark.parametrize("values, kind", [(["1.2", ">3", "4"], "regression"), (["active", "1"], "classification"), (["0", "1", "1"], "classification"), (["0.5", "1"], "regression"), ([None, "2"], "classification")])
def test_task_type(spark, values, kind):
    df = frame(spark, [("a", x) for x in values], "k string, v string")
    assert quality.task_profile(df, KEYS, "v").first().task_type == kind


def test_label_kinds():
    with pytest.raises(ValueError):
        quality.check_label_kind("Categorical", "regression")
    quality.check_label_kind("Continuous", "regression")


def test_matrix_drops_null_values_but_keeps_unmapped_entities(spark):
    df = frame(spark, [("a", "X", 1.0), ("a", "X", 3.0), ("b", "other", 5.0), ("c", "X", None), (None, "X", 1.0)], "s string, e string, v double")
    got = {x.s: (x.X, x.Y) for x in matrix.mean_pivot(df, "s", "e", "v", ("X", "Y")).collect()}
    assert got == {"a": (2.0, None), "b": (None, None)}


def test_ratio_rows(spark):
    df = frame(spark, [("a", 1.0, None), ("b", 2.0, 0.5)], "e string, v double, r double")
    assert sorted((x.e, x.v) for x in matrix.inject_ratio_rows(df, "e", "v", "r").collect()) == [("Efflux_ratio", 0.5), ("a", 1.0), ("b", 2.0)]


def test_pk_rows(spark):
    df = frame(spark, [("pKa",), ("Pharmacokinetics",), ("Patient",), (None,)], "t string")
    assert [x.p for x in df.select(matrix.is_pk_row(F.col("t")).alias("p")).collect()] == [True, False, True, False]


def test_chemistry_is_optional(spark):
    df = frame(spark, [("CCO",)], "s string")
    with pytest.raises(chem.ChemBackendUnavailable):
        chem.standardise(df, "s")
    counts = chem.atom_counts(F.col("s"))
    got = frame(spark, [("c1ccccc1Cl",)], "s string").select(*(c.alias(x) for x, c in counts.items())).first()
    assert got["C"] == 6 and got["Cl"] == 1


def test_features(spark):
    """Widths, what is in no list, nulls, and motifs that lack an attribute or a key."""
    rows = [(6, 4, "CHI_OTHER", 0, "SP3", 3, False), (92, 9, "?", 7, "?", 8, True), (None,) * 7]
    atoms = frame(spark, rows, "n int, d int, c string, q int, h string, k int, a boolean")
    got = atoms.select(features.atom_onehot(*map(F.col, atoms.columns)).alias("x"), features.atom_indices(*map(F.col, atoms.columns)).alias("i")).collect()
    assert [len(x.x) for x in got] == [43] * 3
    assert [x.i for x in got] == [[2, 4, 3, 5, 3, 3, 0], [18, 5, 0, 11, 6, 4, 1], [18, 5, 0, 11, 6, 4, 0]]
    assert [i for i, v in enumerate(got[0].x) if v] == [2, 23, 28, 29, 33, 40] and got[0].x[29] == 5 and got[1].x[29] == 11
    bonds = frame(spark, [("AROMATIC", "NONE", True, True), (None, "ENDUPRIGHT", False, None), ("DATIVE", "?", None, False)], "k string, d string, c boolean, r boolean")
    got = bonds.select(features.bond_onehot(*map(F.col, bonds.columns)).alias("x"), features.bond_indices(*map(F.col, bonds.columns)).alias("i")).collect()
    assert [x.x for x in got] == [[0, 0, 0, 1, 0, 1, 0, 0, 1, 1], [0, 0, 0, 0, 1, 0, 1, 0, 0, 0], [0.0] * 10]
    assert [x.i for x in got] == [[3, 0, 1, 1], [4, 1, 0, 0], [None, None, 0, 0]]
    motifs = [(50.0, 1.5, 120.0, 2, ["C", "C", "Cl", "N"], [1] * 167), (None, 1.5, 120.0, 2, ["C"], [1] * 167), (50.0, 1.5, 120.0, 2, ["C"], [1]), (50.0, 1.5, 120.0, 0, None, [0] * 167), (50.0, 1.5, 120.0, 0, [], [0] * 167)]
    df = frame(spark, motifs, "t double, l double, w double, r int, s array<string>, k array<int>")
    got = df.select(features.motif_features(*map(F.col, df.columns)).alias("x"), features.motif_features(*map(F.col, df.columns), F.lit(7)).alias("y")).collect()
    assert [len(x.x) for x in got] == [182] * 5 and [len(x.y) for x in got] == [183] * 5
    assert got[0].x[:5] == [0.5, 1.5, 1.2, 1, 2] and got[0].x[5:15] == [2, 0, 0, 1, 0, 0, 0, 0, 0, 1] and got[0].y[0] == 7
    assert [any(x.x) for x in got] == [True, False, False, False, True] and not any(got[1].y)


def test_density_and_gallery(spark):
    df = frame(spark, [(i, float(i), f"g{i % 3}") for i in range(9)], "i long, v double, g string")
    got = {x.point: x.density for x in summary.density(df, "v", [4.0, 40.0], 1.0).collect()}
    want = sum(math.exp(-((4 - v) ** 2) / 2) for v in range(9)) / 9 / math.sqrt(2 * math.pi)
    assert math.isclose(got[4.0], want) and got[40.0] < 1e-9
    assert [x.i for x in summary.gallery(df, "g", "i", 2).collect()] == [0, 1]


def test_empty_tables(spark):
    empty = frame(spark, [], "i long, k string, v double, s string")
    for out in (stats.zscore(empty, KEYS, "v"), stats.iqr_outliers(empty, KEYS, "v"), dedup.strict_or_first(empty, KEYS, "s", "i"), split.random_split(empty, KEYS, "i"), split.group_split(empty, KEYS, "s", "i"), quality.task_profile(empty, KEYS, "v"), matrix.mean_pivot(empty, "k", "s", "v", ("X",))):
        assert out.count() == 0


def test_exact_quantiles(spark, monkeypatch):
    import random

    draw = random.Random(1)
    rows = [("a", round(draw.gauss(0, 1), 2)) for _ in range(3001)] + [("b", 5.0)] * 7 + [("c", 1.0), ("c", 2.0)] + [(None, float(x)) for x in range(10)] + [("d", None)]
    df = frame(spark, rows, "k string, v double")
    shares = (0.0, 0.1, 0.25, 0.5, 0.75, 0.999, 1.0)
    want = {x.k: x.q for x in df.filter("v IS NOT NULL").groupBy("k").agg(F.percentile("v", F.array(*map(F.lit, shares))).alias("q")).collect()}
    for accuracy in (10_000, 50):  # a coarse bracket still holds the quantile
        monkeypatch.setattr(stats, "QUANTILE_ACCURACY", accuracy)
        got = {x.k: x.quantiles for x in stats.exact_quantiles(df, KEYS, "v", shares).collect()}
        assert got.keys() == want.keys()
        for k in want:
            assert all(math.isclose(a, b, rel_tol=1e-12, abs_tol=1e-12) for a, b in zip(got[k], want[k]))


@pytest.mark.parametrize("chunk", [7, 40])
def test_lof_in_chunks(spark, chunk):
    import random

    draw = random.Random(2)
    rows = [("a", i, round(draw.gauss(0, 3), 1)) for i in range(150)] + [("b", i, float(i % 3)) for i in range(200, 230)] + [(None, 300, 1.0), (None, 301, 9.0)]
    df = frame(spark, rows, "k string, i long, v double")
    whole = {x.i: x.lof for x in stats.local_outlier_factor(df, KEYS, "v", "i", k=4).collect()}
    cut = {x.i: x.lof for x in stats.local_outlier_factor(df, KEYS, "v", "i", k=4, chunk=chunk).collect()}
    assert whole.keys() == cut.keys() == {i for _, i, _ in rows}
    assert all(math.isclose(whole[i], cut[i], rel_tol=1e-9) for i in whole)


def plain_mixture(values, parts=2, rounds=100, least_gain=1e-3):
    n = len(values)
    mean = sum(values) / n
    var = sum((x - mean) ** 2 for x in values) / n
    w, m, s, last = [1 / parts] * parts, [mean + z * var**0.5 for z in ([0.0] if parts == 1 else [2 * i / (parts - 1) - 1 for i in range(parts)])], [var + 1e-6] * parts, -math.inf
    for k in range(rounds):
        p = [[a * math.exp(-((x - b) ** 2) / (2 * c)) / math.sqrt(2 * math.pi * c) for a, b, c in zip(w, m, s)] for x in values]
        total = [sum(x) for x in p]
        now = sum(map(math.log, total)) / n
        r = [[y / t for y in x] for x, t in zip(p, total)]
        size = [sum(x[j] for x in r) for j in range(parts)]
        w = [x / n for x in size]
        m = [sum(x[j] * v for x, v in zip(r, values)) / size[j] for j in range(parts)]
        s = [sum(x[j] * (v - m[j]) ** 2 for x, v in zip(r, values)) / size[j] + 1e-6 for j in range(parts)]
        if abs(now - last) < least_gain:
            break
        last = now
    return w, m, s, k + 1


@pytest.mark.parametrize("parts", [1, 2, 3])
def test_mixtures_of_many_tasks(spark, parts):
    """All tasks at once, each as it comes out by itself: two humps, one, equal values, one value, repeated values, a null key."""
    import random

    draw = random.Random(parts)
    tasks = {"two": [draw.gauss(0, 1) for _ in range(60)] + [draw.gauss(9, 2) for _ in range(40)], "one": [draw.gauss(5, 3) for _ in range(50)], "same": [4.0] * 9, "single": [7.0], None: [1.0] * 20 + [2.0] * 20 + [10.0] * 5}
    df = frame(spark, [(k, v) for k, x in tasks.items() for v in x] + [("one", None), ("one", float("nan"))], "k string, v double")
    got = {x.k: x for x in stats.gaussian_mixtures(df, "v", KEYS, parts).collect()}
    assert set(got) == set(tasks)
    for k, values in tasks.items():
        w, m, s, rounds = plain_mixture(values, parts)
        row = got[k]
        assert row.n == len(values) and row.rounds == rounds
        for a, b in ((row.weights, w), (row.means, m), (row.variances, s)):
            assert all(math.isclose(x, y, rel_tol=1e-6, abs_tol=1e-9) for x, y in zip(a, b)), (k, a, b)
    flagged = stats.gaussian_mixture_outliers(df, "v", parts, keys=KEYS).collect()
    assert len(flagged) == df.count() and not any(x.is_outlier for x in flagged if x.v is None or x.v != x.v)
    w, m, s, _ = plain_mixture(tasks["two"], parts)
    density = sorted(math.log(sum(a * math.exp(-((x - b) ** 2) / (2 * c)) / math.sqrt(2 * math.pi * c) for a, b, c in zip(w, m, s))) for x in tasks["two"])
    limit = density[4] + (density[5] - density[4]) * 0.95
    assert sum(x.is_outlier for x in flagged if x.k == "two") == sum(d < limit for d in density) == 5


def test_mixture_without_keys(spark):
    values = [float(x % 7) + 20 * (x % 3) for x in range(90)]
    df = frame(spark, [(v,) for v in values], "v double")
    row = stats.gaussian_mixtures(df, "v").first()
    w, m, s, rounds = plain_mixture(values)
    assert row.rounds == rounds and all(math.isclose(x, y, rel_tol=1e-6) for x, y in zip(row.means, m))
    assert stats.gaussian_mixtures(df.limit(0), "v").count() == 0 and stats.gaussian_mixture_outliers(df.limit(0), "v").count() == 0


def test_places_of_a_value_with_most_rows(spark):
    """A repeated value's rows are dealt out, and places stay those of a sorted order."""
    rows = [(i, 5.0 if i % 3 else float(i % 50)) for i in range(3000)]
    got = stats.sorted_chunks(frame(spark, rows, "i long, v double"), (), "v", "i", 0, 500).collect()
    assert sorted(x._pos for x in got) == list(range(3000))
    assert [x.v for x in sorted(got, key=lambda x: x._pos)] == sorted(v for _, v in rows)
