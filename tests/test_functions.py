import math
import random

import pytest
from pyspark.sql import functions as F

from sieveline.functions import cleaning, endpoints, ph, units
from sieveline.schema import ENDPOINTS


def one(spark, column, **values):
    kinds = {bool: "boolean", int: "bigint", float: "double", str: "string", type(None): "string"}
    schema = ", ".join(f"{k} {kinds[type(v)]}" for k, v in values.items()) or "_ int"
    row = spark.createDataFrame([tuple(values.values()) or (1,)], schema).select(column.alias("x")).first().x
    return row


def test_endpoint_list():
    assert len(ENDPOINTS) == 86 and len(set(ENDPOINTS)) == 86


@pytest.mark.parametrize(
    "cell, numbers",
    [("[6,2]", [6.0, 2.0]), ("[6,]", [6.0, None]), ("[,2]", [None, 2.0]), ("6.2", [6.2]), ("-", []), ("[]", []), ("[>5,<=2]", [5.0, 2.0]), (None, []), ("nan", [])],
)
def test_bracket_numbers(spark, cell, numbers):
    assert one(spark, cleaning.bracket_numbers(F.col("c")), c=cell) == numbers


@pytest.mark.parametrize("ab, ba, pair", [("[6,2]", "-", (6.0, 2.0)), ("[6,]", "[,2]", (6.0, 2.0)), ("6", "3", (6.0, 3.0)), ("-", "3", (3.0, 3.0)), ("-", "-", (None, None))])
def test_permeability_pair(spark, ab, ba, pair):
    forth, back = cleaning.permeability_pair(cleaning.bracket_numbers(F.col("a")), cleaning.bracket_numbers(F.col("b")))
    assert tuple(one(spark, F.struct(forth, back), a=ab, b=ba)) == pair


@pytest.mark.parametrize("text, value", [("5d", None), (" 3 ", 3.0), ("+3", 3.0), (".5", 0.5), ("1e3", 1000.0), ("NaN", None), ("", None), (None, None), (">5", None)])
def test_number(spark, text, value):
    assert one(spark, cleaning.number(F.col("t")), t=text) == value


def test_spelled_out_signs(spark):
    assert one(spark, cleaning.spell_out(F.col("t")), t="μM 5°C α β γ δ ± ≤ ≥ × ÷") == "uM 5degC alpha beta gamma delta +/- <= >= x /"


def test_canonical_names():
    assert cleaning.canonical_names(["test*", "Test_Species", "TEST_SUBJECT", "Unnamed: 3", "Unnamed: 10", "own"]) == ["Test", "Test_Subject", None, None, "Measurement_Value", "own"]
    assert cleaning.canonical_names(["Measurment_Value"], lower=True) == ["measurement_value"]


@pytest.mark.parametrize(
    "value, unit, si, label",
    [
        (1.0, "uM", 1e-3, "mole / meter ** 3"), (1.0, "nM", 1e-6, "mole / meter ** 3"), (1.0, "hr", 3600.0, "second"), (30.0, "min", 1800.0, "second"), (5.0, "ug/mL", 0.005, "kilogram / meter ** 3"),
        (2.5, "ng*h/mL", 0.009, "kilogram * second / meter ** 3"), (7.0, "10-6 cm/s", 7.0, "1e-6 cm/s"), (7.0, "ratio", 7.0, "ratio"), (7.0, "%", 7.0, "percent"), (7.0, "WeirdUnit", 7.0, "WeirdUnit"), (1.0, "um", 1e-6, "meter"),
    ],
)
def test_units(spark, value, unit, si, label):
    converted, name = units.to_si(F.col("v"), F.col("u"))
    got = one(spark, F.struct(converted.alias("v"), name.alias("n")), v=value, u=unit)
    assert math.isclose(got.v, si, rel_tol=1e-12) and got.n == label


def test_unit_column_drops_comparators(spark):
    df = spark.createDataFrame([(">5", "uM"), ("<0.1", "uM"), ("2.0", "uM"), ("active", "uM"), (None, None)], "v string, u string")
    assert [x.value_si and round(x.value_si, 9) for x in units.convert_column(df, "v", "u").collect()] == [0.005, 0.0001, 0.002, None, None]


def test_ph_corrections(spark):
    hh = ph.corrected(F.col("v"), F.col("p"), "hh", acid_pka=F.lit(4.5), base_pka=F.lit(None).cast("double"))["hh"]
    emp = ph.corrected(F.col("v"), F.col("p"), "emp")["emp"]
    assert math.isclose(one(spark, hh, v=100.0, p=4.0), 0.16549491248390955, rel_tol=1e-9)
    assert math.isclose(one(spark, emp, v=100.0, p=4.0), 151.0)
    assert one(spark, hh, v=100.0, p=7.4) == 100.0
    with pytest.raises(ValueError):
        ph.corrected(F.col("v"), F.col("p"), "other")


@pytest.mark.parametrize("subject, condition, kind, value", [("pH7.4 x", "3", "", 7.4), ("Human", "ph 2.1", "", 2.1), ("Human", "7", "Sol_pH5", 7.0), ("Human", "15", "Sol_pH5", 5.0), ("Human", "", "Sol", None), ("Graph4", "", "", 4.0)])
def test_ph_inference(spark, subject, condition, kind, value):
    assert one(spark, ph.infer_ph([], F.col("s"), F.col("c"), F.col("k")), s=subject, c=condition, k=kind) == value


API = {
    "Permeability | Caco-2": "Caco2", "CYP_Inhibition | CYP2C9": "CYP2C9_Inhibitor", "CYP2D6": "CYP2D6_Inhibitor", "CYP1A1 inhibition": "CYP1A1 inhibition", "CYP3A4_MDZ": "CYP3A4_Inhibitor", "Toxicity | hERG": "hERG", "Solubility": "Solubility",
    "Efflux_transporter | P_gp | efflux_Ratio": "Efflux_ratio", "Brain_penetration | Unbound_BBB | Kp_uu": "BBB_logbb(cls)", "Metabolic_stability | Liver_microsomes | CLint": "HLM", "Physicochem | LogD": "Physicochem | LogD", "Toxicity | Cytotoxicity": "ClinTox",
    "Toxicity | Cytotoxicity | IC50": "Toxicity | Cytotoxicity | IC50",
}
CLI = {"Metabolic_stability | Liver_microsomes | CLint": "Metabolic_stability | Liver_microsomes | CLint", "Physicochem | LogD": "Lipophilicity", "Toxicity | Cytotoxicity": "Toxicity | Cytotoxicity"}


@pytest.mark.parametrize("dialect, cases", [("api", API), ("cli", CLI)])
def test_endpoint_matching(spark, dialect, cases):
    names = spark.createDataFrame([(x,) for x in [*cases, None]], "name string")
    got = {x.name: x.endpoint for x in endpoints.match_endpoints(names, "name", dialect).collect()}
    assert got == cases


def test_likeness(spark):
    value = one(spark, endpoints.likeness(F.col("a"), F.col("b")), a="aqueous solubility", b="solubility")
    assert value > 0.5 and one(spark, endpoints.likeness(F.col("a"), F.col("b")), a="zz", b="yy") == 0.0


def test_most_alike_against_all_pairs(spark):
    """The label of the greatest likeness, the first listed of equals; without a join of names and labels."""
    rng = random.Random(5)
    labels = list(dict.fromkeys(" ".join(rng.choices(("ab", "abc", "bcd", "d", "Ab-c"), k=rng.randint(1, 3))) for _ in range(25))) + ["--", "x", "it's", "a\\'b", "\\"]
    names = [*(" ".join(rng.choices(("ab", "abc", "cd", "d", "q"), k=rng.randint(1, 4))) for _ in range(60)), "", "q", "ab", "it s", "a b", None]
    df = spark.createDataFrame([(x,) for x in names], "n string")
    pairs = spark.createDataFrame([(x, y, i) for x in {*names} - {None} for i, y in enumerate(labels)], "n string, label string, i int")
    scored = pairs.select("n", "label", "i", endpoints.likeness(F.col("n"), endpoints.normal_name(F.col("label"))).alias("s")).collect()
    want = {}
    for x in sorted(scored, key=lambda x: (-x.s, x.i)):
        want.setdefault(x.n, (x.label, x.s))
    out = endpoints.most_alike(df, "n", labels)
    assert sorted((x.n or "", x.alike or "", x.score or 0.0) for x in out.collect()) == sorted((x or "", *want.get(x, ("", 0.0))) for x in names)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan
    assert [tuple(x) for x in endpoints.most_alike(df.limit(1), "n", []).select("alike", "score").collect()] == [(None, None)]


def test_mapping_by_callable(spark):
    df = spark.createDataFrame([("a",), ("a",), ("b",)], "name string")
    got = {x.name: x.endpoint for x in endpoints.map_by_callable(df, "name", lambda names: {"a": "A"}).collect()}
    assert got == {"a": "A", "b": "b"}


def test_own_synonyms_replace(spark):
    names = spark.createDataFrame([("my assay",)], "name string")
    assert endpoints.match_endpoints(names, "name", own={"my assay": "DILI"}).first().endpoint == "DILI"


def test_replies():
    assert endpoints.read_reply('```json\n{"a": "DILI", "b": 3}\n```', ["a", "b", "c"]) == {"a": "DILI", "b": "b", "c": "c"}
    assert endpoints.read_reply("sorry", ["a"]) == {"a": "a"} and endpoints.read_reply("[1]", ["a"]) == {"a": "a"}
    assert '"a"' in endpoints.prompt_for(["a"])


def test_stretches_against_all_places(spark):
    """Synonyms that stand in a name as whole tokens: most tokens, then the latest first place, then the first listed."""
    rng = random.Random(1)
    synonyms = list({" ".join(rng.choices("abcd", k=rng.randint(1, 3))): f"e{i}" for i in range(30)}.items())
    names = [*(" ".join(rng.choices("abcdx", k=rng.randint(1, 7))) for _ in range(300)), "", None, "ab", "abc a"]

    def best(name):
        tokens = name.split(" ") if name is not None else []
        found = []
        for place, (synonym, endpoint) in enumerate(synonyms):
            own = synonym.split(" ")
            at = [i for i in range(len(tokens) - len(own) + 1) if tokens[i : i + len(own)] == own]
            found += [(len(own), at[0], -place, endpoint)] if at else []
        return max(found)[3] if found else None

    got = endpoints.best_stretch(spark.createDataFrame([(x,) for x in names], "n string"), "n", synonyms).collect()
    assert len(got) == len(names) and all(x.stretch == best(x.n) for x in got)
    assert {x.stretch for x in endpoints.best_stretch(spark.createDataFrame([("a",)], "n string"), "n", []).collect()} == {None}
