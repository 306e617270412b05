"""The driver's queries over the reference's operators, with the SQL they are held against.

The tables hold no assays, so each operator runs over columns of theirs that have the shape it needs.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sieveline.functions import cleaning, endpoints, ph, units
from sieveline.operators import chem, dedup, features, fragments, matrix, one_class, quality, split, stats, summary
from sieveline.session import dealt, numbered, read_table

EVENT_TYPES = ("click", "error", "purchase", "signup", "view")
SPLIT_KEYS = ("l_returnflag", "l_linestatus")
UNIT_CHOICES = ("uM", "ng/mL", "hr", "%", "10-6 cm/s", "mL/min/kg", "min-1", "ng·h/mL", "WeirdUnit", "um", "uL/min/10^6 cells", "-", "ug/mL", "mM", "L/hr/kg")
SYNONYMS = [("red", "Colour"), ("blue", "Colour"), ("small", "Size"), ("ring", "Jewel"), ("small ring", "Tiny"), ("widget", "Tool"), ("red widget", "Signal"), ("gear", "Tool"), ("bolt", "Fastener"), ("large bolt", "Anchor")]
LABELS = ["red widget", "small ring", "blue gear", "green bolt", "large plate", "tiny nut"]
ROUND = 6

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    def keep(f):
        QUERIES[f.__name__] = f
        if sql is not None:
            ORACLES[f.__name__] = sql
        return f

    return keep


def _sql_list(values) -> str:
    return ", ".join("'" + x.replace("'", "''") + "'" for x in values)


def _values(rows) -> str:
    return ", ".join("(" + ", ".join(str(x) if isinstance(x, (int, float)) else "'" + x.replace("'", "''") + "'" for x in row) + ")" for row in rows)


_MEANS = ", ".join(f"round(avg(value) FILTER (WHERE event_type = '{x}'), 6) AS {x}" for x in EVENT_TYPES)
_ZEROS = ", ".join(f"coalesce(round(avg(value) FILTER (WHERE event_type = '{x}'), 6), 0) AS {x}" for x in EVENT_TYPES)
_CASES = ", ".join(f"CASE WHEN event_type = '{x}' THEN value END AS {x}" for x in EVENT_TYPES)


@query(f"SELECT user_id, {_MEANS} FROM events WHERE value IS NOT NULL AND user_id IS NOT NULL GROUP BY user_id")
def matrix_mean_pivot(spark, sf_dir):
    return matrix.mean_pivot(read_table(spark, sf_dir, "events"), "user_id", "event_type", "value", EVENT_TYPES, digits=ROUND)


@query(f"SELECT user_id, {_ZEROS} FROM events WHERE value IS NOT NULL AND user_id IS NOT NULL GROUP BY user_id")
def matrix_fill_zero(spark, sf_dir):
    return matrix.mean_pivot(read_table(spark, sf_dir, "events"), "user_id", "event_type", "value", EVENT_TYPES, fill=0.0, digits=ROUND)


@query(f"""SELECT user_id, {_MEANS} FROM events WHERE user_id % 7 <> 0 AND value IS NOT NULL AND user_id IS NOT NULL GROUP BY user_id
UNION ALL SELECT user_id, {_CASES} FROM events WHERE user_id % 7 = 0""")
def matrix_with_row_expansion(spark, sf_dir):
    return matrix.matrix_with_rows(read_table(spark, sf_dir, "events"), "user_id", "event_type", "value", EVENT_TYPES, F.col("user_id") % 7 == 0, digits=ROUND)


@query("""SELECT c_custkey, c_name, c_mktsegment,
  lower(c_name || ' ' || text) LIKE '%pk%' OR lower(c_name || ' ' || text) LIKE '%patient%' AS is_pk
FROM (SELECT *, CASE c_custkey % 4 WHEN 0 THEN 'pKa' WHEN 1 THEN 'Patient group' WHEN 2 THEN 'Pharmacokinetics' ELSE c_mktsegment END AS text FROM customer)""")
def pk_rows(spark, sf_dir):
    text = F.when(F.col("c_custkey") % 4 == 0, F.lit("pKa")).when(F.col("c_custkey") % 4 == 1, F.lit("Patient group")).when(F.col("c_custkey") % 4 == 2, F.lit("Pharmacokinetics")).otherwise(F.col("c_mktsegment"))
    return read_table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_mktsegment", matrix.is_pk_row(F.col("c_name"), text).alias("is_pk"))


@query("""SELECT p_type, bool_or(regexp_matches(p_brand, '^[<>]?=?\\s*\\d+\\.?\\d*$') OR p_size > 10) AS has_numbers FROM part GROUP BY p_type""")
def numeric_gate(spark, sf_dir):
    parts = read_table(spark, sf_dir, "part").withColumn("text", F.when(F.col("p_size") > 10, F.concat(F.lit(">= "), F.col("p_size").cast("string"))).otherwise(F.col("p_brand")))
    return quality.has_numbers(parts, ("p_type",), "text")


@query("SELECT p_partkey, p_name AS name, p_size AS size FROM part")
def final_projection(spark, sf_dir):
    parts = read_table(spark, sf_dir, "part").select("p_partkey", F.col("p_name").alias("name"), F.col("p_size").alias("size"), "p_type")
    return matrix.final_columns(parts, ("p_partkey", "name", "missing", "size", "name"))


def _pairs(df: DataFrame) -> DataFrame:
    """Bracket lists of every shape out of quantity and discount."""
    q, d, shape = F.col("l_quantity").cast("int").cast("string"), F.round(F.col("l_discount") * 100).cast("int").cast("string"), F.col("l_orderkey") % 5
    ab = F.when(shape == 0, F.concat(F.lit("["), q, F.lit(","), d, F.lit("]"))).when(shape == 1, F.concat(F.lit("["), q, F.lit(",]"))).when(shape == 2, F.concat(F.lit(">"), q)).when(shape == 3, F.lit("-")).otherwise(F.lit("[]"))
    ba = F.when(shape == 0, F.concat(F.lit("[,"), q, F.lit("]"))).when(shape == 1, d).when(shape == 2, F.concat(F.lit("["), d, F.lit(","), q, F.lit("]"))).when(shape == 3, q).otherwise(F.lit("nan"))
    return df.select("l_orderkey", "l_linenumber", F.lit("flux").alias("endpoint"), ab.alias("ab"), ba.alias("ba"))


_PAIRS = """WITH raw AS (SELECT l_orderkey, l_linenumber, CAST(l_quantity AS INT) AS q, CAST(round(l_discount * 100) AS INT) AS d, l_orderkey % 5 AS s FROM lineitem),
pairs AS (SELECT l_orderkey, l_linenumber,
  CASE s WHEN 0 THEN q WHEN 1 THEN q WHEN 2 THEN q WHEN 3 THEN q END::DOUBLE AS forth,
  CASE s WHEN 0 THEN q WHEN 1 THEN d WHEN 2 THEN q WHEN 3 THEN q END::DOUBLE AS back FROM raw),
told AS (SELECT *, CASE WHEN forth IS NOT NULL AND forth <> 0 AND back IS NOT NULL THEN back / forth END AS ratio FROM pairs)"""


@query(f"""{_PAIRS}
SELECT l_orderkey, l_linenumber, 'flux' AS endpoint, round(forth, 6) AS value FROM told
UNION ALL SELECT l_orderkey, l_linenumber, 'Efflux_ratio', round(ratio, 6) FROM told WHERE ratio IS NOT NULL""")
def efflux_injection(spark, sf_dir):
    expanded = cleaning.expand_permeability(_pairs(read_table(spark, sf_dir, "lineitem")), "ab", "ba", "value", "back", "ratio")
    rows = matrix.inject_ratio_rows(expanded, "endpoint", "value", "ratio")
    return rows.select("l_orderkey", "l_linenumber", "endpoint", F.round("value", ROUND).alias("value"))


_PROFILE = """WITH t AS (SELECT {keys}, CAST(l_extendedprice AS VARCHAR) AS v, CASE WHEN l_discount > 0.08 THEN '>' WHEN l_discount < 0.01 THEN '"="' ELSE '=' END AS r FROM lineitem),
p AS (SELECT {keys}, count(*) AS n, count(*) FILTER (WHERE v = 'active') AS n_active, count(*) FILTER (WHERE v = 'inactive') AS n_inactive, count(*) FILTER (WHERE r = '>') AS n_censored, count(DISTINCT v) AS n_distinct,
  bool_and(TRY_CAST(v AS DOUBLE) IN (0, 1)) AS b FROM t GROUP BY {keys})
SELECT {keys}, n, n_active, n_inactive, n_censored, n_distinct, CASE WHEN b THEN 'classification' ELSE 'regression' END AS task_type,
  CASE WHEN n_distinct = 2 OR n_distinct < n / 2.0 THEN 'Categorical' ELSE 'Continuous' END AS label_kind,
  CASE WHEN b THEN FALSE ELSE n >= 50 AND n - n_censored >= 25 END AS has_quorum FROM p"""


def _profile(spark, sf_dir, keys):
    relation = F.when(F.col("l_discount") > 0.08, F.lit(">")).when(F.col("l_discount") < 0.01, F.lit('"="')).otherwise(F.lit("="))
    told = read_table(spark, sf_dir, "lineitem").select(*keys, F.format_string("%.2f", "l_extendedprice").alias("v"), relation.alias("r"))
    return quality.task_profile(told, keys, "v", "r")


@query(_PROFILE.format(keys="l_returnflag, l_linestatus"))
def task_profile_quorum(spark, sf_dir):
    return _profile(spark, sf_dir, SPLIT_KEYS)


@query(_PROFILE.format(keys="l_suppkey"))
def task_profile_many(spark, sf_dir):
    return _profile(spark, sf_dir, ("l_suppkey",))


@query("""WITH t AS (SELECT l_suppkey, l_linenumber, CASE WHEN l_returnflag = 'R' THEN 'inactive' WHEN l_discount < 0.02 THEN 'Active' ELSE 'active' END AS v FROM lineitem),
p AS (SELECT l_suppkey, l_linenumber, count(*) AS n, count(*) FILTER (WHERE v = 'active') AS n_active, count(*) FILTER (WHERE v = 'inactive') AS n_inactive FROM t GROUP BY ALL)
SELECT *, 'classification' AS task_type, n >= 50 AND n_active >= 25 AND n_inactive >= 25 AS has_quorum FROM p""")
def class_quorum(spark, sf_dir):
    """Tasks of words, some with too few of a class; other spellings of a class don't count."""
    word = F.when(F.col("l_returnflag") == "R", F.lit("inactive")).when(F.col("l_discount") < 0.02, F.lit("Active")).otherwise(F.lit("active"))
    told = read_table(spark, sf_dir, "lineitem").select("l_suppkey", "l_linenumber", word.alias("v"))
    return quality.task_profile(told, ("l_suppkey", "l_linenumber"), "v").select("l_suppkey", "l_linenumber", "n", "n_active", "n_inactive", "task_type", "has_quorum")


@query("""SELECT event_id, user_id FROM events WHERE (user_id) IN (SELECT user_id FROM events GROUP BY user_id HAVING count(*) >= 50 AND count(*) - count(*) FILTER (WHERE CAST(value AS VARCHAR) SIMILAR TO '[<>].*') >= 25
  AND NOT bool_and(value IN (0, 1)))""")
def quorum_records(spark, sf_dir):
    events = read_table(spark, sf_dir, "events").filter(F.col("value").isNotNull()).withColumn("text", F.format_string("%.2f", "value"))
    return quality.with_quorum(events, ("user_id",), "text").select("event_id", "user_id")


@query("""SELECT 'event_type' AS "column", event_type AS value, count(*) AS n FROM events WHERE event_type NOT IN ('click', 'view', 'purchase') GROUP BY event_type""")
def vocab_violations(spark, sf_dir):
    return quality.vocabulary_violations(read_table(spark, sf_dir, "events"), {"event_type": ("click", "view", "purchase")})


@query("""WITH t AS (SELECT l_orderkey, l_linenumber, CASE l_orderkey % 4 WHEN 0 THEN '>' WHEN 1 THEN '<= ' WHEN 2 THEN '' ELSE 'active ' END AS pre, l_quantity AS q FROM lineitem)
SELECT l_orderkey, l_linenumber, nullif(regexp_extract(pre, '^([<>]=?)', 1), '') AS relation, CASE WHEN pre LIKE 'active%' THEN NULL ELSE q END AS value FROM t""")
def censored_parse(spark, sf_dir):
    pre = F.when(F.col("l_orderkey") % 4 == 0, F.lit(">")).when(F.col("l_orderkey") % 4 == 1, F.lit("<= ")).when(F.col("l_orderkey") % 4 == 2, F.lit("")).otherwise(F.lit("active "))
    text = F.concat(pre, F.col("l_quantity").cast("string"))
    return read_table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", cleaning.censored(text).alias("c")).select("l_orderkey", "l_linenumber", "c.relation", "c.value")


def _unit_of(key: str):
    return F.element_at(F.array(*map(F.lit, UNIT_CHOICES)), (F.col(key) % len(UNIT_CHOICES)).cast("int") + 1)


#: unit, factor, SI unit, kind, as the SQL's own table.
_UNIT_ROWS = [
    ("uM", 1e-3, "mole / meter ** 3", "concentration"), ("ng/mL", 1e-6, "kilogram / meter ** 3", "concentration"), ("hr", 3600, "second", "time"), ("%", 1, "percent", "dimensionless"), ("10-6 cm/s", 1, "1e-6 cm/s", "rate"),
    ("mL/min/kg", 1e-6 / 60, "meter ** 3 / kilogram / second", "rate"), ("min-1", 1 / 60, "1 / second", "concentration"), ("ng·h/mL", 3.6e-3, "kilogram * second / meter ** 3", "concentration"), ("WeirdUnit", 1, "WeirdUnit", "unknown"),
    ("um", 1e-6, "meter", "concentration"), ("uL/min/10^6 cells", 1, "ul/min/10^6cells", "dimensionless"), ("-", 1, "-", "dimensionless"), ("ug/mL", 1e-3, "kilogram / meter ** 3", "concentration"), ("mM", 1, "mole / meter ** 3", "concentration"), ("L/hr/kg", 1e-3 / 3600, "meter ** 3 / kilogram / second", "rate"),
]

@query(f"""WITH u AS (SELECT generate_subscripts(l, 1) - 1 AS i, unnest(l) AS x FROM (SELECT [{", ".join("{'unit': '%s', 'factor': %r, 'si': '%s'}" % (a, float(b), c) for a, b, c, _ in _UNIT_ROWS)}] AS l))
SELECT p_partkey, u.x.unit AS unit, round(p_retailprice * u.x.factor, 9) AS value_si, u.x.si AS unit_si FROM part JOIN u ON p_partkey % {len(UNIT_CHOICES)} = u.i""")
def unit_to_si(spark, sf_dir):
    parts = read_table(spark, sf_dir, "part").select("p_partkey", F.concat(F.lit(">"), F.col("p_retailprice").cast("string")).alias("v"), _unit_of("p_partkey").alias("unit"))
    return units.convert_column(parts, "v", "unit").select("p_partkey", "unit", F.round("value_si", 9).alias("value_si"), "unit_si")


@query(f"""WITH u AS (SELECT generate_subscripts(l, 1) - 1 AS i, unnest(l) AS x FROM (SELECT [{", ".join("{'unit': '%s', 'kind': '%s'}" % (a, d) for a, _, _, d in _UNIT_ROWS)}] AS l))
SELECT p_type AS measurement, u.x.unit AS unit, count(*) AS n, u.x.kind AS kind FROM part JOIN u ON p_partkey % {len(UNIT_CHOICES)} = u.i GROUP BY ALL""")
def unit_summary(spark, sf_dir):
    return units.unit_summary(read_table(spark, sf_dir, "part").withColumn("unit", _unit_of("p_partkey")), "p_type", "unit")


@query("""SELECT p_partkey, CASE WHEN p_partkey % 5 = 0 THEN p_size / 10.0 WHEN p_partkey % 5 = 1 THEN p_size / 4.0 WHEN p_partkey % 5 = 2 THEN p_size::DOUBLE
  WHEN p_partkey % 5 = 3 THEN CASE WHEN p_size <= 14 THEN p_size::DOUBLE END END::DOUBLE AS inferred_ph FROM part""")
def ph_infer(spark, sf_dir):
    size, way = F.col("p_size"), F.col("p_partkey") % 5
    told = read_table(spark, sf_dir, "part").select(
        "p_partkey",
        F.when(way == 0, (size / 10).cast("string")).alias("ph"),
        F.when(way == 1, F.concat(F.lit("Human pH "), (size / 4).cast("string"))).otherwise(F.lit("Human")).alias("subject"),
        F.when(way == 2, F.concat(F.lit("at PH"), size.cast("string"))).when(way == 3, size.cast("string")).alias("condition"),
        F.lit("Solubility").alias("type"),
    )
    return told.select("p_partkey", ph.infer_ph([F.col("ph")], F.col("subject"), F.col("condition"), F.col("type")).alias("inferred_ph"))


_PH = "CASE WHEN l_linenumber % 6 = 0 THEN NULL ELSE 4 + l_tax * 50 END"


def _ph_query(spark, sf_dir, method, **columns):
    lines = read_table(spark, sf_dir, "lineitem").withColumn("_ph", F.when(F.col("l_linenumber") % 6 != 0, 4 + F.col("l_tax") * 50))
    found = ph.corrected(F.col("l_quantity"), F.col("_ph"), method, **columns)
    return lines.select("l_orderkey", "l_linenumber", F.round(found[method], ROUND).alias("corrected"))


_ACID, _BASE = "CASE WHEN l_linenumber % 3 > 0 THEN 4.5 END", "CASE WHEN l_linenumber % 2 > 0 THEN 5 + l_discount * 50 END"


@query(f"""WITH t AS (SELECT l_orderkey, l_linenumber, l_quantity AS v, {_PH} AS ph, {_ACID} AS a, {_BASE} AS b FROM lineitem),
c AS (SELECT *, CASE WHEN a IS NOT NULL AND (b IS NULL OR abs(a - 7.4) < abs(b - 7.4)) THEN TRUE ELSE FALSE END AS acid FROM t),
f AS (SELECT *, CASE WHEN acid THEN 1 - 1 / (1 + power(10.0, a - 7.4)) ELSE 1 - 1 / (1 + power(10.0, 7.4 - b)) END AS ft, CASE WHEN acid THEN 1 - 1 / (1 + power(10.0, a - ph)) ELSE 1 - 1 / (1 + power(10.0, ph - b)) END AS fm FROM c)
SELECT l_orderkey, l_linenumber, round(CASE WHEN ph IS NULL THEN NULL WHEN ph = 7.4 OR (a IS NULL AND b IS NULL) THEN v ELSE v * ft / fm END, 6) AS corrected FROM f""")
def ph_correct_hh(spark, sf_dir):
    acid, base = F.when(F.col("l_linenumber") % 3 > 0, F.lit(4.5)), F.when(F.col("l_linenumber") % 2 > 0, 5 + F.col("l_discount") * 50)
    return _ph_query(spark, sf_dir, "hh", acid_pka=acid, base_pka=base)


@query(f"""WITH t AS (SELECT l_orderkey, l_linenumber, l_quantity AS v, 7.4::DOUBLE - ({_PH}) AS d FROM lineitem)
SELECT l_orderkey, l_linenumber, round(v * greatest(0.1, least(10, 1 + d * CASE WHEN abs(d) <= 1 THEN 0.05 WHEN abs(d) <= 2 THEN 0.1 ELSE 0.15 END)), 6) AS corrected FROM t WHERE d IS NOT NULL
UNION ALL SELECT l_orderkey, l_linenumber, NULL FROM t WHERE d IS NULL""")
def ph_correct_emp(spark, sf_dir):
    return _ph_query(spark, sf_dir, "emp")


@query(f"""WITH t AS (SELECT l_orderkey, l_linenumber, l_quantity AS v, 7.4::DOUBLE - ({_PH}) AS d, l_discount * 80 AS logp, l_quantity * 4 AS tpsa, l_linenumber AS h FROM lineitem),
s AS (SELECT *, (greatest(0.5, least(2, 1 - logp / 10)) + greatest(0.5, least(2, 1 + tpsa / 200)) + greatest(0.5, least(2, 1 + (h + 2.0) / 20))) / 3 AS s FROM t)
SELECT l_orderkey, l_linenumber, CASE WHEN d IS NOT NULL THEN round(v * greatest(0.1, least(10, 1 + d * 0.1 * s)), 6) END AS corrected FROM s""")
def ph_correct_mp(spark, sf_dir):
    return _ph_query(spark, sf_dir, "mp", logp=F.col("l_discount") * 80, tpsa=F.col("l_quantity") * 4, donors=F.col("l_linenumber"), acceptors=F.lit(2))


@query("""SELECT l_orderkey, l_linenumber, l_partkey, round((l_extendedprice - avg(l_extendedprice) OVER w) / stddev_pop(l_extendedprice) OVER w, 6) AS scaled FROM lineitem WINDOW w AS (PARTITION BY l_returnflag)""")
def zscore_by_group(spark, sf_dir):
    found = stats.zscore(read_table(spark, sf_dir, "lineitem"), ("l_returnflag",), "l_extendedprice", "scaled")
    return found.select("l_orderkey", "l_linenumber", "l_partkey", F.round("scaled", ROUND).alias("scaled"))


@query("""SELECT c_custkey, CASE WHEN c_acctbal IS NULL THEN 'Not classified' WHEN c_acctbal >= 4500 THEN 'active' ELSE 'inactive' END AS label FROM customer""")
def threshold_label(spark, sf_dir):
    customers = read_table(spark, sf_dir, "customer").withColumn("text", F.col("c_acctbal").cast("string"))
    return stats.labels(customers, ("c_mktsegment",), "text", "c_acctbal", 4500.0, out="label").select("c_custkey", "label")


@query("""SELECT c_custkey, CASE WHEN c_nationkey % 2 = 0 THEN CASE WHEN c_acctbal > 2000 THEN 'active' ELSE 'inactive' END WHEN c_acctbal >= 4500 THEN 'active' ELSE 'inactive' END AS label FROM customer""")
def named_labels(spark, sf_dir):
    """Tasks whose labels are words keep them, in lower case; the others go by the threshold."""
    word = F.when(F.col("c_acctbal") > 2000, F.lit("Active")).otherwise(F.lit("INACTIVE"))
    text = F.when(F.col("c_nationkey") % 2 == 0, word).otherwise(F.col("c_acctbal").cast("string"))
    return stats.labels(read_table(spark, sf_dir, "customer").withColumn("text", text), ("c_nationkey",), "text", "c_acctbal", 4500.0, out="label").select("c_custkey", "label")


#: Common table expressions of the normality test; the last is r, with z1 and z2 of each key.
_NORMALITY = """m AS (SELECT {key}, count(*)::DOUBLE AS n, avg({value}) AS mu FROM {table} GROUP BY {key}),
p AS (SELECT l.{key}, any_value(n) AS n, avg(power({value} - mu, 2)) AS m2, avg(power({value} - mu, 3)) AS m3, avg(power({value} - mu, 4)) AS m4 FROM {table} l JOIN m ON l.{key} = m.{key} GROUP BY l.{key}),
g AS (SELECT {key}, n, m3 / power(m2, 1.5) AS g1, m4 / (m2 * m2) - 3 AS g2 FROM p WHERE n >= 8 AND m2 > 0),
z AS (SELECT *, g1 * sqrt((n + 1) * (n + 3) / (6 * (n - 2))) AS y, 3 * (n * n + 27 * n - 70) * (n + 1) * (n + 3) / ((n - 2) * (n + 5) * (n + 7) * (n + 9)) AS beta,
  (g2 + 3 - 3 * (n - 1) / (n + 1)) / sqrt(24 * n * (n - 2) * (n - 3) / ((n + 1) * (n + 1) * (n + 3) * (n + 5))) AS x,
  6 * (n * n - 5 * n + 2) / ((n + 7) * (n + 9)) * sqrt(6 * (n + 3) * (n + 5) / (n * (n - 2) * (n - 3))) AS sb FROM g),
w AS (SELECT *, -1 + sqrt(2 * (beta - 1)) AS w2, 6 + 8 / sb * (2 / sb + sqrt(1 + 4 / (sb * sb))) AS a FROM z),
k AS (SELECT {key}, n, 1 / sqrt(0.5 * ln(w2)) * asinh(y / sqrt(2 / (w2 - 1))) AS z1, 1 + x * sqrt(2 / (a - 4)) AS d, a FROM w),
r AS (SELECT {key}, n, z1, ((1 - 2 / (9 * a)) - sign(d) * cbrt((1 - 2 / a) / abs(d))) / sqrt(2 / (9 * a)) AS z2 FROM k)"""


@query(f"""WITH {_NORMALITY.format(table="lineitem", key="l_suppkey", value="l_extendedprice")}
SELECT l_suppkey, n::BIGINT AS n, round(z1 * z1 + z2 * z2, 4) AS k2, round(exp(-(z1 * z1 + z2 * z2) / 2), 4) AS p FROM r""")
def normality_k2(spark, sf_dir):
    found = stats.normality(read_table(spark, sf_dir, "lineitem"), ("l_suppkey",), "l_extendedprice")
    return found.filter(F.col("k2").isNotNull()).select("l_suppkey", "n", F.round("k2", 4).alias("k2"), F.round("p", 4).alias("p"))


@query("""WITH q AS (SELECT o_orderpriority, quantile_cont(o_totalprice::DOUBLE, 0.25) AS a, quantile_cont(o_totalprice::DOUBLE, 0.75) AS b FROM orders GROUP BY 1)
SELECT o_orderkey, o_totalprice < a - 1.5 * (b - a) OR o_totalprice > b + 1.5 * (b - a) AS is_outlier FROM orders JOIN q USING (o_orderpriority)""")
def iqr_outliers(spark, sf_dir):
    return stats.iqr_outliers(read_table(spark, sf_dir, "orders"), ("o_orderpriority",), "o_totalprice").select("o_orderkey", "is_outlier")


_NEAR = 5


#: Common table expressions of the local outlier factor; the last is lof, with that of each id.
_LOF = """s AS (SELECT {id}, {key}, {value} AS v, row_number() OVER (PARTITION BY {key} ORDER BY {value}, {id}) AS i, count(*) OVER (PARTITION BY {key}) AS n FROM {table}),
nn AS (SELECT * FROM (SELECT a.{id}, a.{key}, a.i, b.i AS j, abs(a.v - b.v) AS d, least({k}, a.n - 1) AS k, row_number() OVER (PARTITION BY a.{id} ORDER BY abs(a.v - b.v), b.i) AS r FROM s a JOIN s b ON a.{key} = b.{key} AND a.i <> b.i) WHERE r <= k),
kd AS (SELECT {key}, i, max(d) AS kd FROM nn GROUP BY ALL),
lrd AS (SELECT nn.{id}, nn.{key}, nn.i, any_value(nn.k) AS k, 1 / (sum(greatest(nn.d, kd.kd)) / any_value(nn.k) + 1e-10) AS lrd FROM nn JOIN kd ON nn.{key} = kd.{key} AND nn.j = kd.i GROUP BY ALL),
lof AS (SELECT nn.{id}, sum(o.lrd) / any_value(nn.k) / any_value(own.lrd) AS lof FROM nn JOIN lrd o ON nn.{key} = o.{key} AND nn.j = o.i JOIN lrd own ON nn.{id} = own.{id} GROUP BY nn.{id})"""


@query(f"""WITH {_LOF.format(table="supplier", key="s_nationkey", id="s_suppkey", value="s_acctbal", k=_NEAR)}
SELECT s.s_suppkey, round(lof, 6) AS lof, coalesce(lof > 1.5, FALSE) AS is_outlier FROM s LEFT JOIN lof ON s.s_suppkey = lof.s_suppkey""")
def lof_1d(spark, sf_dir):
    found = stats.local_outlier_factor(read_table(spark, sf_dir, "supplier"), ("s_nationkey",), "s_acctbal", "s_suppkey", k=_NEAR)
    return found.select("s_suppkey", F.round("lof", ROUND).alias("lof"), "is_outlier")


@query(f"""WITH {_LOF.format(table="customer", key="c_mktsegment", id="c_custkey", value="c_acctbal", k=_NEAR)}
SELECT s.c_custkey, round(lof, 6) AS lof, coalesce(lof > 1.5, FALSE) AS is_outlier FROM s LEFT JOIN lof ON s.c_custkey = lof.c_custkey""")
def lof_chunks(spark, sf_dir):
    """Groups far larger than the reach of a row, in many chunks."""
    found = stats.local_outlier_factor(read_table(spark, sf_dir, "customer"), ("c_mktsegment",), "c_acctbal", "c_custkey", k=_NEAR, chunk=64)
    return found.select("c_custkey", F.round("lof", ROUND).alias("lof"), "is_outlier")


def _dispatch_sql(table: str, key: str, id: str, value: str) -> str:
    names = {"table": table, "key": key, "id": id, "value": value}
    return """WITH {normality}, q AS (SELECT {key}, quantile_cont({value}::DOUBLE, 0.25) AS a, quantile_cont({value}::DOUBLE, 0.75) AS b FROM {table} GROUP BY {key}), {lof}
SELECT t.{id}, t.{key}, t.{value}, CASE WHEN coalesce(exp(-(z1 * z1 + z2 * z2) / 2), 0) >= 0.05 THEN t.{value} < q.a - 1.5 * (q.b - q.a) OR t.{value} > q.b + 1.5 * (q.b - q.a) ELSE coalesce(lof > 1.5, FALSE) END AS is_outlier
FROM {table} t JOIN q ON t.{key} = q.{key} LEFT JOIN r ON t.{key} = r.{key} LEFT JOIN lof ON t.{id} = lof.{id}""".format(normality=_NORMALITY.format(**names), lof=_LOF.format(**names, k=20), **names)


@query(_dispatch_sql("orders", "o_custkey", "o_orderkey", "o_totalprice"))
def outlier_dispatch_orders(spark, sf_dir):
    """Tasks of both kinds: those that look normal and those that don't."""
    return stats.outliers(read_table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice"), ("o_custkey",), "o_totalprice", "o_orderkey")


@query("SELECT o_orderkey, o_custkey FROM (SELECT *, count(*) OVER (PARTITION BY o_orderpriority, o_custkey) AS c FROM orders) WHERE c = 1")
def strict_dedup(spark, sf_dir):
    return dedup.strict(read_table(spark, sf_dir, "orders"), ("o_orderpriority",), "o_custkey").select("o_orderkey", "o_custkey")


@query("""WITH c AS (SELECT doc_id, source, count(*) OVER (PARTITION BY source, text) AS n, row_number() OVER (PARTITION BY source, text ORDER BY doc_id) AS r FROM documents),
s AS (SELECT *, sum((n = 1)::INT) OVER (PARTITION BY source) AS singles FROM c)
SELECT doc_id, source FROM s WHERE CASE WHEN singles = 0 THEN r = 1 ELSE n = 1 END""")
def dedup_recover(spark, sf_dir):
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "source", F.md5(F.col("text").cast("binary")).alias("digest"))
    return dedup.strict_or_first(docs, ("source",), "digest", "doc_id").select("doc_id", "source")


@query("""WITH c AS (SELECT o_orderkey, o_custkey, count(*) OVER (PARTITION BY o_custkey, o_orderpriority) AS n, row_number() OVER (PARTITION BY o_custkey, o_orderpriority ORDER BY o_orderkey) AS r, bool_or(o_orderkey % 40 = 0) OVER (PARTITION BY o_custkey) AS whole FROM orders),
s AS (SELECT *, sum((n = 1)::INT) OVER (PARTITION BY o_custkey) AS singles FROM c)
SELECT o_orderkey, o_custkey FROM s WHERE whole OR CASE WHEN singles = 0 THEN r = 1 ELSE n = 1 END""")
def dedup_skips_groups(spark, sf_dir):
    """Tasks with a record of the kind that is left alone keep all their records."""
    orders = read_table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderpriority", (F.col("o_orderkey") % 40 == 0).alias("alone"))
    return dedup.strict_or_first(orders, ("o_custkey",), "o_orderpriority", "o_orderkey", "alone").select("o_orderkey", "o_custkey")


@query("SELECT min(doc_id) AS doc_id, lang FROM documents GROUP BY lang")
def first_of_each(spark, sf_dir):
    return dedup.first_of_each(read_table(spark, sf_dir, "documents").select("doc_id", "lang"), "lang", "doc_id")


_SHARES = "CASE WHEN r <= ceil(round(n * 0.2, 9)) THEN 'test' WHEN r <= ceil(round(n * 0.2, 9)) + ceil(round((n - ceil(round(n * 0.2, 9))) * 0.125, 9)) THEN 'valid' ELSE 'train' END AS split"


@query(f"""WITH t AS (SELECT o_orderkey, o_orderpriority, row_number() OVER (PARTITION BY o_orderpriority ORDER BY md5(CAST(o_orderkey AS VARCHAR)), o_orderkey) AS r, count(*) OVER (PARTITION BY o_orderpriority) AS n FROM orders)
SELECT o_orderkey, o_orderpriority, {_SHARES} FROM t""")
def split_random(spark, sf_dir):
    return split.random_split(read_table(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority"), ("o_orderpriority",), "o_orderkey")


@query("""WITH g AS (SELECT o_orderpriority, o_custkey, count(*) AS n, min(o_orderkey) AS f FROM orders GROUP BY ALL),
b AS (SELECT *, sum(n) OVER (PARTITION BY o_orderpriority ORDER BY n DESC, f ROWS UNBOUNDED PRECEDING) - n AS before, sum(n) OVER (PARTITION BY o_orderpriority) AS total FROM g),
t AS (SELECT *, before / total < 0.2 AS is_test FROM b),
f AS (SELECT *, coalesce(max(CASE WHEN is_test THEN before + n END) OVER (PARTITION BY o_orderpriority), 0) AS taken FROM t)
SELECT o.o_orderkey, CASE WHEN is_test THEN 'test' WHEN (before - taken) / total < 0.1 THEN 'valid' ELSE 'train' END AS split FROM orders o JOIN f ON o.o_orderpriority = f.o_orderpriority AND o.o_custkey = f.o_custkey""")
def split_group_greedy(spark, sf_dir):
    orders = read_table(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority", "o_custkey")
    return split.group_split(orders, ("o_orderpriority",), "o_custkey", "o_orderkey").select("o_orderkey", "split")


@query(f"""WITH q AS (SELECT c_mktsegment, list_distinct(quantile_cont(c_acctbal::DOUBLE, [0, 0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9, 1])) AS e FROM customer GROUP BY 1),
b AS (SELECT c_custkey, c.c_mktsegment, greatest(len(list_filter(e, lambda x: x < c_acctbal)), 1) AS bin FROM customer c JOIN q ON c.c_mktsegment = q.c_mktsegment),
t AS (SELECT c_custkey, row_number() OVER (PARTITION BY c_mktsegment, bin ORDER BY md5(CAST(c_custkey AS VARCHAR)), c_custkey) AS r, count(*) OVER (PARTITION BY c_mktsegment, bin) AS n FROM b)
SELECT c_custkey, {_SHARES} FROM t""")
def split_stratified(spark, sf_dir):
    customers = read_table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment", "c_acctbal")
    return split.stratified_split(customers, ("c_mktsegment",), "c_acctbal", "c_custkey").select("c_custkey", "split")


@query("SELECT source, count(*) AS n FROM documents GROUP BY source ORDER BY n DESC, source LIMIT 7")
def topk_groups(spark, sf_dir):
    return summary.top_groups(read_table(spark, sf_dir, "documents"), "source", 7)


@query("""SELECT doc_id, replace(replace(replace(replace(replace(replace(replace(replace(translate(text, 'μ×÷', 'ux/'), '°', 'deg'), 'α', 'alpha'), 'β', 'beta'), 'γ', 'gamma'), 'δ', 'delta'), '±', '+/-'), '≤', '<='), '≥', '>=') AS text FROM documents""")
def text_clean(spark, sf_dir):
    return read_table(spark, sf_dir, "documents").select("doc_id", cleaning.spell_out(F.col("text")).alias("text"))


@query("""SELECT p_partkey, trim(regexp_replace(lower(p_name || '-' || p_brand || ' /' || p_type), '[^a-z0-9]+', ' ', 'g')) AS name,
  CASE WHEN p_brand = 'Brand#2' THEN p_name ELSE regexp_replace(p_name || ' | ' || p_brand || ' | ' || CASE WHEN p_type = 'ECONOMY' THEN '' ELSE p_type END, '^[ |]+|[ |]+$', '', 'g') END AS endpoint_key FROM part""")
def endpoint_key(spark, sf_dir):
    blank = F.lit("Not specified")
    second, third = F.when(F.col("p_brand") == "Brand#2", blank).otherwise(F.col("p_brand")), F.when((F.col("p_type") == "ECONOMY") | (F.col("p_brand") == "Brand#2"), blank).otherwise(F.col("p_type"))
    name = endpoints.normal_name(F.concat("p_name", F.lit("-"), "p_brand", F.lit(" /"), "p_type"))
    return read_table(spark, sf_dir, "part").select("p_partkey", name.alias("name"), cleaning.endpoint_key(F.col("p_name"), second, third).alias("endpoint_key"))


@query("""SELECT l_orderkey, l_linenumber, CASE WHEN l_returnflag = 'A' THEN 1.0 WHEN l_returnflag = 'R' THEN 0.0 ELSE l_quantity END::DOUBLE AS value FROM lineitem""")
def qualitative_values(spark, sf_dir):
    unit = F.when(F.col("l_returnflag") == "A", F.lit(" Positive")).when(F.col("l_returnflag") == "R", F.lit("NEGATIVE ")).otherwise(F.lit("uM"))
    return read_table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", cleaning.qualitative(unit, F.col("l_quantity")).alias("value"))


_TYPE_MAP = {"ECONOMY": "Cheap", "STANDARD": "Plain", "PROMO": "Offer"}


@query("SELECT p_partkey, p_type, coalesce(CASE p_type WHEN 'ECONOMY' THEN 'Cheap' WHEN 'STANDARD' THEN 'Plain' WHEN 'PROMO' THEN 'Offer' END, p_type) AS endpoint FROM part")
def dict_map_join(spark, sf_dir):
    mapping = spark.createDataFrame(list(_TYPE_MAP.items()), "p_type string, endpoint string")
    return endpoints.map_endpoints(read_table(spark, sf_dir, "part"), "p_type", F.broadcast(mapping)).select("p_partkey", "p_type", "endpoint")


@query("""WITH m AS (SELECT p_type, CASE p_type WHEN 'ECONOMY' THEN 'Cheap' WHEN 'STANDARD' THEN 'Plain' WHEN 'PROMO' THEN 'Offer' ELSE p_type END AS endpoint FROM part)
SELECT p_type, endpoint, count(*) AS n FROM m WHERE endpoint NOT IN ('Cheap', 'Plain') GROUP BY ALL""")
def unmapped_report(spark, sf_dir):
    mapping = spark.createDataFrame(list(_TYPE_MAP.items()), "p_type string, endpoint string")
    mapped = endpoints.map_endpoints(read_table(spark, sf_dir, "part"), "p_type", F.broadcast(mapping))
    return matrix.mapping_report(matrix.unmapped(mapped, "endpoint", ("Cheap", "Plain")), "p_type", "endpoint")


_NAMED = "SELECT DISTINCT p_name AS name FROM part"


@query(f"""WITH n AS ({_NAMED}), s(syn, endpoint, place, tokens) AS (VALUES {_values((a, b, i, len(a.split())) for i, (a, b) in enumerate(SYNONYMS))}),
m AS (SELECT name, endpoint, row_number() OVER (PARTITION BY name ORDER BY tokens DESC, len(string_split(substr(' ' || name || ' ', 1, instr(' ' || name || ' ', ' ' || syn || ' ')::INT), ' ')) DESC, place) AS r FROM n JOIN s ON contains(' ' || name || ' ', ' ' || syn || ' '))
SELECT p_partkey, p_name AS name, endpoint AS stretch FROM part LEFT JOIN m ON p_name = m.name AND r = 1""")
def token_subsequence_match(spark, sf_dir):
    parts = read_table(spark, sf_dir, "part").select("p_partkey", F.col("p_name").alias("name"))
    return endpoints.best_stretch(parts, "name", SYNONYMS)


@query(f"""WITH n AS ({_NAMED}), l(label, place) AS (VALUES {_values((x, i) for i, x in enumerate(LABELS))}),
g AS (SELECT name, label, place, [substr(replace(name, ' ', ''), i, 2) FOR i IN range(1, len(replace(name, ' ', '')))] AS a, [substr(replace(label, ' ', ''), i, 2) FOR i IN range(1, len(replace(label, ' ', '')))] AS b, string_split(name, ' ') AS ta, string_split(label, ' ') AS tb FROM n, l),
s AS (SELECT name, label, place, greatest(2.0 * len(list_intersect(a, b)) / (len(a) + len(b)), len(list_intersect(ta, tb)) / len(list_distinct(list_concat(ta, tb)))) + CASE WHEN ta[1] = tb[1] THEN 0.1 ELSE 0 END AS score FROM g),
m AS (SELECT name, label, score, row_number() OVER (PARTITION BY name ORDER BY round(score, 12) DESC, place) AS r FROM s)
SELECT p_partkey, p_name AS name, label AS alike, round(score, 6) AS score FROM part JOIN m ON p_name = m.name AND r = 1""")
def bigram_similarity_match(spark, sf_dir):
    parts = read_table(spark, sf_dir, "part").select("p_partkey", F.col("p_name").alias("name"))
    return endpoints.most_alike(parts, "name", LABELS).withColumn("score", F.round("score", ROUND))


@query("""SELECT doc_id, """ + ", ".join(f"length(text) - length(replace(text, '{x}', '')) AS {x.lower()}_plain" for x in "PI") + """, (length(text) - length(replace(text, 'Cl', ''))) // 2 AS cl, (length(text) - length(replace(text, 'Br', ''))) // 2 AS br,
  length(replace(replace(text, 'Cl', ''), 'Br', '')) - length(regexp_replace(replace(replace(text, 'Cl', ''), 'Br', ''), '[Cc]', '', 'g')) AS c, length(replace(replace(text, 'Cl', ''), 'Br', '')) - length(regexp_replace(replace(replace(text, 'Cl', ''), 'Br', ''), '[Nn]', '', 'g')) AS n FROM documents""")
def atom_text_count(spark, sf_dir):
    counts = chem.atom_counts(F.col("text"), ("C", "N", "Cl", "Br"))
    plain = {x: F.length("text") - F.length(F.replace("text", F.lit(x), F.lit(""))) for x in "PI"}
    return read_table(spark, sf_dir, "documents").select("doc_id", *(plain[x].cast("bigint").alias(f"{x.lower()}_plain") for x in "PI"), *(counts[x].cast("bigint").alias(x.lower()) for x in ("Cl", "Br", "C", "N")))


@query("SELECT event_id, " + ", ".join(f"(event_type = '{x}')::INT::DOUBLE AS is_{x}" for x in EVENT_TYPES[:3]) + f", (event_type NOT IN ({_sql_list(EVENT_TYPES[:3])}))::INT::DOUBLE AS is_other FROM events")
def one_hot(spark, sf_dir):
    coded = read_table(spark, sf_dir, "events").select("event_id", chem.one_hot(F.col("event_type"), EVENT_TYPES[:3], other=True).alias("x"))
    return coded.select("event_id", *(F.get("x", F.lit(i)).alias(f"is_{x}") for i, x in enumerate((*EVENT_TYPES[:3], "other"))))


def _one_of(choices, at: str) -> Column:
    """The choice whose place, from 0, a number tells; null beyond them."""
    return F.get(F.array(*map(F.lit, choices)), F.expr(f"cast({at} AS INT)"))


def _places(choices, value: str, other: bool = False) -> str:
    """SQL for a list of 0 and 1, one place for each choice."""
    told = ["'" + x + "'" if isinstance(x, str) else str(x) for x in choices]
    return "[" + ", ".join([f"coalesce(({value} = {x})::INT, 0)" for x in told] + [f"(coalesce({value} NOT IN ({', '.join(told)}), TRUE))::INT"] * other) + "]"


def _place(choices, value: str, default) -> str:
    told = ["'" + x + "'" if isinstance(x, str) else str(x) for x in choices]
    return f"coalesce(list_position([{', '.join(told)}], {value}) - 1, {default})"


def _chosen(choices, at: str) -> str:
    return f"([{_sql_list(choices)}])[{at} + 1]"


_HAND, _ORBIT = (*features.CHIRALITIES, "CHI_ALLENE"), (*features.HYBRIDISATIONS, "SP2D")
_WAY = (*features.DIRECTIONS, "EITHERDOUBLE")


@query(f"""WITH t AS (SELECT l_orderkey, l_linenumber, l_quantity::INT AS num, l_partkey % 7 AS deg, {_chosen(_HAND, "l_suppkey % 6")} AS hand, l_partkey % 13 - 6 AS charge, {_chosen(_ORBIT, "l_orderkey % 9")} AS orbit, l_linenumber AS hyd, l_returnflag = 'A' AS aro FROM lineitem)
SELECT l_orderkey, l_linenumber, array_to_string(list_concat(list_concat(list_concat({_places(features.ATOMIC_NUMBERS, "num", True)}, {_places(features.DEGREES, "deg", True)}), list_concat({_places(features.CHIRALITIES, "hand")}, [{_place(features.CHARGES, "charge", 11)}])), list_concat({_places(features.HYBRIDISATIONS, "orbit")}, list_concat({_places(features.HYDROGENS, "hyd")}, [aro::INT]))), ',') AS onehot,
  array_to_string([{_place(features.ATOMIC_NUMBERS, "num", 18)}, {_place(features.DEGREES, "deg", 5)}, {_place(features.CHIRALITIES, "hand", 0)}, {_place(features.CHARGES, "charge", 11)}, {_place(features.HYBRIDISATIONS, "orbit", 6)}, {_place(features.HYDROGENS, "hyd", 4)}, aro::INT], ',') AS places FROM t""")
def atom_features(spark, sf_dir):
    told = [F.col("l_quantity").cast("int"), F.expr("cast(l_partkey % 7 AS INT)"), _one_of(_HAND, "l_suppkey % 6"), F.expr("cast(l_partkey % 13 - 6 AS INT)"), _one_of(_ORBIT, "l_orderkey % 9"), F.col("l_linenumber").cast("int"), F.col("l_returnflag") == "A"]
    joined = lambda x: F.array_join(F.transform(x, lambda v: v.cast("int").cast("string")), ",")
    return read_table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", joined(features.atom_onehot(*told)).alias("onehot"), joined(features.atom_indices(*told)).alias("places"))


@query(f"""WITH t AS (SELECT l_orderkey, l_linenumber, {_chosen(features.BONDS, "l_partkey % 5")} AS kind, {_chosen(_WAY, "l_suppkey % 4")} AS way, l_returnflag = 'A' AS con, l_linestatus = 'O' AS ring FROM lineitem)
SELECT l_orderkey, l_linenumber, array_to_string(list_concat(list_concat({_places(features.BONDS, "kind")}, [(kind IS NULL)::INT]), list_concat({_places(features.DIRECTIONS, "way")}, [con::INT, ring::INT])), ',') AS onehot,
  CASE WHEN kind IS NULL THEN 4 ELSE {_place(features.BONDS, "kind", -1)} END::INT AS kind_place, ({_place(features.DIRECTIONS, "way", -1)})::INT AS way_place FROM t""")
def bond_features(spark, sf_dir):
    told = [_one_of(features.BONDS, "l_partkey % 5"), _one_of(_WAY, "l_suppkey % 4"), F.col("l_returnflag") == "A", F.col("l_linestatus") == "O"]
    coded = read_table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", features.bond_onehot(*told).alias("x"), features.bond_indices(*told).alias("i"))
    onehot = F.array_join(F.transform("x", lambda v: v.cast("int").cast("string")), ",")
    return coded.select("l_orderkey", "l_linenumber", onehot.alias("onehot"), F.get("i", F.lit(0)).alias("kind_place"), F.coalesce(F.get("i", F.lit(1)), F.lit(-1)).alias("way_place"))


_SYMBOLS = ("C", "H", "O", "N", "P", "S", "F", "Cl", "Br", "Si", "I")


@query(f"""WITH t AS (SELECT p_partkey, p_partkey % 5 <> 0 AS fine, p_retailprice AS tpsa, p_size / 10.0 AS logp, p_partkey % 3 AS rings, [{_chosen(_SYMBOLS, "(p_partkey * i) % 11")} FOR i IN range(1, p_size + 1)] AS e FROM part)
SELECT p_partkey, CASE WHEN fine THEN round(tpsa * 0.01, 6) ELSE 0 END::DOUBLE AS tpsa, CASE WHEN fine THEN round(logp, 6) ELSE 0 END::DOUBLE AS logp,
  array_to_string(list_concat(list_concat([(fine AND rings > 0)::INT, CASE WHEN fine THEN rings ELSE 0 END], [{", ".join(f"CASE WHEN fine THEN len([x FOR x IN e IF x = '{x}']) ELSE 0 END" for x in features.ELEMENTS)}, CASE WHEN fine THEN len([x FOR x IN e IF x NOT IN ({_sql_list(features.ELEMENTS)})]) ELSE 0 END]), [(fine AND (p_partkey * i) % 3 = 0)::INT FOR i IN range(1, 168)]), ',') AS rest FROM t""")
def motif_features(spark, sf_dir):
    """Every fifth motif lacks its weight, and so gets zeros."""
    symbols = F.transform(F.sequence(F.lit(1), F.col("p_size").cast("int")), lambda i: F.get(F.array(*map(F.lit, _SYMBOLS)), ((F.col("p_partkey") * i) % 11).cast("int")))
    keys = F.transform(F.sequence(F.lit(1), F.lit(features.MOTIF_KEYS)), lambda i: ((F.col("p_partkey") * i) % 3 == 0).cast("int"))
    weight = F.when(F.col("p_partkey") % 5 != 0, F.col("p_size") * 14.0)
    whole = features.motif_features(F.col("p_retailprice"), F.col("p_size") / 10.0, weight, F.col("p_partkey") % 3, symbols, keys)
    coded = dealt(read_table(spark, sf_dir, "part").select("p_partkey", "p_size", "p_retailprice"), "p_partkey").select("p_partkey", whole.alias("x"))
    rest = F.array_join(F.transform(F.slice("x", 4, features.MOTIF_WIDTH - 3), lambda v: v.cast("int").cast("string")), ",")
    return coded.select("p_partkey", F.round(F.get("x", F.lit(0)), ROUND).alias("tpsa"), F.round(F.get("x", F.lit(1)), ROUND).alias("logp"), rest.alias("rest"))


@query("""WITH m AS (SELECT min(l_quantity) AS low FROM lineitem) SELECT floor((l_quantity - low) / 5)::BIGINT AS bin, low + floor((l_quantity - low) / 5) * 5 AS lower, count(*) AS n FROM lineitem, m GROUP BY ALL""")
def histogram_bins(spark, sf_dir):
    return summary.histogram(read_table(spark, sf_dir, "lineitem"), "l_quantity", 5.0)


@query("SELECT event_id, coalesce(event_type, 'Not specified') AS event_type, CASE WHEN props IN ('', 'NA', 'N/A', 'nan', 'null') THEN 'Not specified' ELSE coalesce(props, 'Not specified') END AS props, 'Not specified' AS \"Test\" FROM events")
def sentinel_fill(spark, sf_dir):
    events = read_table(spark, sf_dir, "events").select("event_id", "event_type", cleaning.missing_to_null(F.col("props")).alias("props"))
    return cleaning.fill_conditions(events, ("event_type", "props", "Test"))


@query()
def gmm_low_density(spark, sf_dir):
    return stats.gaussian_mixture_outliers(read_table(spark, sf_dir, "customer").select("c_custkey", "c_acctbal"), "c_acctbal")


@query(_dispatch_sql("supplier", "s_nationkey", "s_suppkey", "s_acctbal"))
def outlier_dispatch(spark, sf_dir):
    return stats.outliers(read_table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey", "s_acctbal"), ("s_nationkey",), "s_acctbal", "s_suppkey")


_POINTS = [5.0, 20.0, 45.0]


@query(" UNION ALL ".join(f"SELECT {p}::DOUBLE AS point, round(avg(exp(-power((l_quantity - {p}) / 2, 2) / 2) / (2 * sqrt(2 * pi()))), 6) AS density FROM lineitem" for p in _POINTS))
def kernel_density(spark, sf_dir):
    return summary.density(read_table(spark, sf_dir, "lineitem"), "l_quantity", _POINTS, 2.0).select("point", F.round("density", ROUND).alias("density"))


@query("SELECT l_suppkey, " + ", ".join(f"round(quantile_cont(l_extendedprice::DOUBLE, {p}), 6) AS q{int(p * 100)}" for p in (0.05, 0.5, 0.95)) + " FROM lineitem GROUP BY l_suppkey")
def task_quantiles(spark, sf_dir):
    found = stats.exact_quantiles(read_table(spark, sf_dir, "lineitem"), ("l_suppkey",), "l_extendedprice", (0.05, 0.5, 0.95))
    return found.select("l_suppkey", *(F.round(F.get("quantiles", F.lit(i)), ROUND).alias(f"q{x}") for i, x in enumerate((5, 50, 95))))


@query("SELECT source, min(doc_id) AS doc_id FROM documents GROUP BY source ORDER BY doc_id LIMIT 6")
def gallery_heads(spark, sf_dir):
    return summary.gallery(read_table(spark, sf_dir, "documents").select("source", "doc_id"), "source", "doc_id", 6)


def _made_up_names(parts: DataFrame) -> DataFrame:
    more = F.when(F.col("p_size") % 3 == 0, F.lit("hERG")).when(F.col("p_size") % 3 == 1, F.lit("CYP2D6 substrate")).when(F.col("p_size") % 5 == 0, F.lit("Solublity")).when(F.col("p_size") % 5 == 1, F.lit("cyp9z1 cytotoxicity"))
    return parts.select(F.concat_ws(" | ", F.when(F.col("p_size") % 4 > 0, F.col("p_type")), F.when(F.col("p_size") % 2 > 0, F.col("p_name")), more).alias("name")).filter(F.col("name") != "")


_SYNONYM_ROWS = [(s, e, i, len(s.split())) for i, (s, e) in enumerate(endpoints.synonym_list())]
_ENDPOINT_ROWS = [(x, endpoints._normal(x), i) for i, x in enumerate(endpoints.ENDPOINTS)]


@query(f"""WITH n AS (SELECT DISTINCT concat_ws(' | ', CASE WHEN p_size % 4 > 0 THEN p_type END, CASE WHEN p_size % 2 > 0 THEN p_name END,
  CASE WHEN p_size % 3 = 0 THEN 'hERG' WHEN p_size % 3 = 1 THEN 'CYP2D6 substrate' WHEN p_size % 5 = 0 THEN 'Solublity' WHEN p_size % 5 = 1 THEN 'cyp9z1 cytotoxicity' END) AS name FROM part),
t AS (SELECT name, trim(regexp_replace(lower(name), '[^a-z0-9]+', ' ', 'g')) AS k FROM n WHERE name <> ''),
s(syn, endpoint, place, tokens) AS (VALUES {_values(_SYNONYM_ROWS)}), l(label, normal, place) AS (VALUES {_values(_ENDPOINT_ROWS)}),
c AS (SELECT name, k, upper(regexp_extract(k, 'cyp(\\d+[a-z]\\d*)', 1)) AS iso FROM t),
stretch AS (SELECT k, endpoint FROM (SELECT t.k, endpoint, row_number() OVER (PARTITION BY t.k ORDER BY tokens DESC, len(string_split(substr(' ' || t.k || ' ', 1, instr(' ' || t.k || ' ', ' ' || syn || ' ')::INT), ' ')) DESC, place) AS r
  FROM (SELECT DISTINCT k FROM t) t JOIN s ON contains(' ' || t.k || ' ', ' ' || syn || ' ')) WHERE r = 1),
g AS (SELECT k, label, place, [substr(replace(k, ' ', ''), i, 2) FOR i IN range(1, len(replace(k, ' ', '')))] AS a, [substr(replace(normal, ' ', ''), i, 2) FOR i IN range(1, len(replace(normal, ' ', '')))] AS b, string_split(k, ' ') AS ta, string_split(normal, ' ') AS tb FROM (SELECT DISTINCT k FROM t), l),
sim AS (SELECT k, label, place, greatest(CASE WHEN len(a) + len(b) > 0 THEN 2.0 * len(list_intersect(a, b)) / (len(a) + len(b)) ELSE 0 END, len(list_intersect(ta, tb)) / len(list_distinct(list_concat(ta, tb)))) + CASE WHEN ta[1] = tb[1] THEN 0.1 ELSE 0 END AS score FROM g),
best AS (SELECT k, label, score FROM (SELECT *, row_number() OVER (PARTITION BY k ORDER BY round(score, 12) DESC, place) AS r FROM sim) WHERE r = 1)
SELECT c.name, coalesce(CASE WHEN iso IN ({_sql_list(endpoints.ISOFORMS)}) THEN 'CYP' || iso || CASE WHEN contains(c.k, 'substrate') THEN '_Substrate' ELSE '_Inhibitor' END WHEN iso <> '' THEN c.name END,
  e.endpoint, CASE WHEN len(list_intersect(string_split(c.k, ' '), ['cytotoxicity', 'genetoxicity'])) > 0 THEN c.name END, st.endpoint, CASE WHEN b.score >= 0.55 THEN b.label END, c.name) AS endpoint
FROM c LEFT JOIN s e ON e.syn = c.k LEFT JOIN stretch st ON st.k = c.k LEFT JOIN best b ON b.k = c.k""")
def endpoint_match(spark, sf_dir):
    return endpoints.match_endpoints(_made_up_names(read_table(spark, sf_dir, "part")), "name")


@query(f"""SELECT p_partkey, CASE WHEN iso IN ({_sql_list(endpoints.ISOFORMS)}) THEN 'CYP' || iso || CASE WHEN p_size % 2 = 0 THEN '_Substrate' ELSE '_Inhibitor' END WHEN iso <> '' THEN name END AS endpoint
FROM (SELECT *, CASE p_size % 4 WHEN 0 THEN '2C19' WHEN 1 THEN '3A4' WHEN 2 THEN '7Q1' ELSE '' END AS iso, 'CYP' || CASE p_size % 4 WHEN 0 THEN '2C19' WHEN 1 THEN '3A4' WHEN 2 THEN '7q1' ELSE '' END || CASE WHEN p_size % 2 = 0 THEN '-Substrate' ELSE ' inhibition' END AS name FROM part)""")
def cyp_guard(spark, sf_dir):
    iso = F.when(F.col("p_size") % 4 == 0, F.lit("2C19")).when(F.col("p_size") % 4 == 1, F.lit("3A4")).when(F.col("p_size") % 4 == 2, F.lit("7q1")).otherwise(F.lit(""))
    name = F.concat(F.lit("CYP"), iso, F.when(F.col("p_size") % 2 == 0, F.lit("-Substrate")).otherwise(F.lit(" inhibition")))
    return read_table(spark, sf_dir, "part").select("p_partkey", endpoints.cyp_endpoint(name).alias("endpoint"))


@query("""WITH t AS (SELECT l_partkey, l_suppkey % 10 AS task FROM lineitem GROUP BY l_partkey, l_suppkey),
c AS (SELECT task, l_partkey, count(*) AS n FROM t GROUP BY task, l_partkey), s AS (SELECT *, sum((n = 1)::INT) OVER (PARTITION BY task) AS singles FROM c)
SELECT task, l_partkey FROM s WHERE singles = 0 OR n = 1""")
def dedup_aggregated_records(spark, sf_dir):
    """Records that an aggregation makes, numbered as they are read, and cleared of duplicates by these numbers."""
    lines = read_table(spark, sf_dir, "lineitem").groupBy("l_partkey", "l_suppkey").agg(F.count(F.lit(1)).alias("n"))
    records = numbered(lines.select("l_partkey", (F.col("l_suppkey") % 10).alias("task")))
    return dedup.strict_or_first(records, ("task",), "l_partkey", "row_id").select("task", "l_partkey")


#: What hangs on a carbon: as text, whether it has an oxygen whose only bond is to carbon, and a nitrogen with three bonds at most.
_GROUPS = (("C", 0, 0), ("O", 1, 0), ("OC", 0, 0), ("N", 0, 1), ("C#N", 0, 1), ("[N+](C)(C)C", 0, 0), ("c1ccccc1", 0, 0), ("C(=O)O", 1, 0), ("S(C)(=O)=O", 0, 0), ("[O-]", 1, 0), ("N(=O)=O", 0, 1))
_SPOTS = ("p_partkey % 11", "p_partkey // 11 % 11", "p_size % 11")


def _compounds(spark, sf_dir) -> DataFrame:
    """Structures of a carbon with three groups, one for each part; every thirteenth is no structure."""
    chosen = [_one_of([x for x, _, _ in _GROUPS], at.replace("//", "DIV")) for at in _SPOTS]
    text = F.concat(F.lit("C("), chosen[0], F.lit(")("), chosen[1], F.lit(")"), chosen[2])
    return read_table(spark, sf_dir, "part").select("p_partkey", "p_size", "p_retailprice", F.when(F.col("p_partkey") % 13 == 0, F.concat(text, F.lit("("))).otherwise(text).alias("structure"))


def _any_of(place: int) -> str:
    return " + ".join(f"([{', '.join(str(x[place]) for x in _GROUPS)}])[({at}) + 1]" for at in _SPOTS)


@query(f"""WITH t AS (SELECT p_partkey, p_retailprice AS v, 4.0::DOUBLE + p_size % 7 AS ph, CASE WHEN p_partkey % 13 > 0 AND {_any_of(1)} > 0 THEN 4.5::DOUBLE END AS a, CASE WHEN p_partkey % 13 > 0 AND {_any_of(2)} > 0 THEN 9.5::DOUBLE END AS b FROM part),
c AS (SELECT *, a IS NOT NULL AND (b IS NULL OR abs(a - 7.4) < abs(b - 7.4)) AS acid FROM t),
f AS (SELECT *, CASE WHEN acid THEN 1 - 1 / (1 + power(10.0, a - 7.4)) ELSE 1 - 1 / (1 + power(10.0, 7.4 - b)) END AS ft, CASE WHEN acid THEN 1 - 1 / (1 + power(10.0, a - ph)) ELSE 1 - 1 / (1 + power(10.0, ph - b)) END AS fm FROM c)
SELECT p_partkey, a AS acid_pka, b AS base_pka, round(CASE WHEN a IS NULL AND b IS NULL THEN v ELSE v * ft / fm END, 6) AS corrected FROM f""")
def structure_pka(spark, sf_dir):
    """The pKa rule over structures that are read as columns, and the correction that takes it."""
    told = chem.with_pkas(_compounds(spark, sf_dir), "structure")
    found = ph.corrected(F.col("p_retailprice"), F.lit(4.0) + F.col("p_size") % 7, "hh", acid_pka=F.col("acid_pka"), base_pka=F.col("base_pka"))
    return told.select("p_partkey", "acid_pka", "base_pka", F.round(found["hh"], ROUND).alias("corrected"))


#: Ring systems to hang groups on, each written in two ways; and groups that are no part of a scaffold.
_SYSTEMS = (("C1CCCCC1", "C2CCCCC2"), ("c1ccccc1", "c1(ccccc1)"), ("C1CCC2CCCCC2C1", "C2CCCC1CCCCC12"), ("C1CCCC1C2CCCC2", "C1(CCCC1)C1CCCC1"), ("O=C1CCCCC1", "C1(CCCCC1)=O"), ("c1ccccc1CCc2ccncc2", "c1cnccc1CCc1ccccc1"), ("C1CC2(C1)CCC2", "C1C2(CC1)CCC2"))
_HANGING = ("", "C", "CC(C)C", "O", "CCO", "Cl")
_SYSTEM, _WRITTEN, _HANG = "p_partkey % 7", "p_partkey // 7 % 2", "p_size % 6"


@query(f"""WITH t AS (SELECT p_partkey, CASE WHEN p_partkey % 17 > 0 THEN {_SYSTEM} END AS s FROM part), f AS (SELECT s, min(p_partkey) AS first FROM t GROUP BY s)
SELECT p_partkey, first FROM t JOIN f ON t.s IS NOT DISTINCT FROM f.s""")
def scaffold_key_groups(spark, sf_dir):
    """Structures by the key of their rings and links: the first part of each group. What hangs on the rings, and how they are written, makes no difference."""
    system = F.when(F.expr(_WRITTEN.replace("//", "DIV")) == 0, _one_of([a for a, _ in _SYSTEMS], _SYSTEM)).otherwise(_one_of([b for _, b in _SYSTEMS], _SYSTEM))
    hang = _one_of(_HANGING, _HANG)
    # the first atom of each system may bear a group more, in a branch behind its ring closure; that of the keto one may not
    text = F.when((hang == "") | system.contains("=O") | system.startswith("O="), system).otherwise(F.regexp_replace(system, r"^([Cc][0-9]?)", F.concat(F.lit("$1("), hang, F.lit(")"))))
    parts = read_table(spark, sf_dir, "part").select("p_partkey", F.when(F.col("p_partkey") % 17 > 0, text).otherwise(F.lit("C1CC")).alias("structure"))
    keyed = fragments.with_fragments(parts, "structure").select("p_partkey", "ring_linker_key")
    first = keyed.groupBy("ring_linker_key").agg(F.min("p_partkey").alias("first"))
    return stats.to_tasks(keyed, first, ("ring_linker_key",)).select("p_partkey", "first")


@query()
def fragment_words(spark, sf_dir):
    """Fragments of structures with their places in a vocabulary that the commonest fragments' own structures make."""
    listed = spark.createDataFrame([("CO", 2, 9), ("C=O", 2, 8), ("c1ccccc1", 6, 7), ("CC", 2, 6), ("CN", 2, 5), ("CC#N", 3, 4)], "smiles string, atom_num int, freq long")
    found = fragments.with_fragments(_compounds(spark, sf_dir).select("p_partkey", "structure"), "structure")
    nodes = fragments.fragment_nodes(found, "p_partkey", fragments.vocabulary(listed))
    return nodes.select("p_partkey", "node", "kind", F.array_join("atoms", ",").alias("atoms"), "word")


@query("SELECT l_orderkey, a AS atom, l_linenumber AS node FROM (SELECT l_orderkey, l_linenumber, unnest(range(l_partkey % 5, l_partkey % 5 + l_suppkey % 4)) AS a FROM lineitem)")
def graph_incidence(spark, sf_dir):
    """Atoms and nodes that meet: an order is a graph, and each of its lines a node of some atoms in a row."""
    first, n = F.expr("cast(l_partkey % 5 AS BIGINT)"), F.expr("cast(l_suppkey % 4 AS BIGINT)")
    atoms = F.when(n > 0, F.sequence(first, first + n - 1))
    nodes = read_table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", atoms.alias("atoms"))
    return fragments.incidence(nodes, "l_orderkey", "l_linenumber")


@query("""WITH g AS (SELECT l_orderkey, count(*) AS n FROM lineitem GROUP BY l_orderkey), p AS (SELECT *, (row_number() OVER (ORDER BY l_orderkey) - 1) // 32 AS batch FROM g)
SELECT l_orderkey, n, batch, coalesce(sum(n) OVER (PARTITION BY batch ORDER BY l_orderkey ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS in_batch, coalesce(sum(n) OVER (ORDER BY l_orderkey ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS in_all FROM p""")
def graph_offsets(spark, sf_dir):
    """Where each graph's nodes begin in the union of its batch of 32, and in that of all graphs."""
    graphs = read_table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.count(F.lit(1)).alias("n"))
    batched = fragments.batch_offsets(graphs, "l_orderkey", "n", 32, "in_batch")
    return fragments.batch_offsets(batched, "l_orderkey", "n", out="in_all").select("l_orderkey", "n", "batch", "in_batch", "in_all")


@query()
def gmm_by_task(spark, sf_dir):
    """A mixture for each customer segment at once; the rows of least density in each."""
    customers = read_table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment", "c_acctbal")
    found = stats.gaussian_mixture_outliers(customers, "c_acctbal", keys=("c_mktsegment",))
    return found.select("c_custkey", "c_mktsegment", F.round("log_density", ROUND).alias("log_density"), "is_outlier")


@query()
def one_class_by_task(spark, sf_dir):
    """A boundary for each type of event, over the logarithm of its value."""
    events = read_table(spark, sf_dir, "events").select("event_id", "event_type", F.log1p("value").alias("level"))
    found = one_class.one_class_outliers(events, "level", ("event_type",))
    return found.select("event_id", "event_type", "is_outlier")
