"""Units as columns: normal spelling, factor to SI, kind of measurement."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sieveline.functions.cleaning import number, strip_comparator
from sieveline.schema import SENTINEL

MOLAR, MASS_VOLUME, VOLUME, MASS = "mole / meter ** 3", "kilogram / meter ** 3", "meter ** 3", "kilogram"
PREFIXES = {"": 1.0, "m": 1e-3, "u": 1e-6, "n": 1e-9, "p": 1e-12}
TIMES = {"second": 1.0, "minute": 60.0, "hour": 3600.0, "day": 86400.0}
#: Spellings (lower case, without blanks) of units; "um" is a length, as molar units keep their capital.
SPELLINGS = {
    "ug/ml": "ug/mL", "ug/l": "ug/L", "mg/ml": "mg/mL", "mg/l": "mg/L", "ng/ml": "ng/mL", "ng/l": "ng/L", "pg/ml": "pg/mL", "pg/l": "pg/L",
    "umol/l": "uM", "umol/liter": "uM", "mmol/l": "mM", "mmol/liter": "mM", "nmol/l": "nM", "nmol/liter": "nM", "pmol/l": "pM", "pmol/liter": "pM", "mol/l": "M", "mol/liter": "M",
    "hr": "hour", "hrs": "hour", "hours": "hour", "min": "minute", "mins": "minute", "minutes": "minute", "sec": "second", "secs": "second", "seconds": "second", "day": "day", "days": "day",
    "ml": "mL", "l": "L", "ul": "uL", "nl": "nL", "pl": "pL", "ug": "ug", "mg": "mg", "ng": "ng", "pg": "pg", "g": "g", "kg": "kg",
    "c": "degC", "celsius": "degC", "f": "degF", "fahrenheit": "degF", "k": "kelvin", "kelvin": "kelvin", "atm": "atm", "bar": "bar", "pa": "Pa", "pascal": "Pa", "psi": "psi",
    "j": "J", "joule": "J", "kj": "kJ", "kcal": "kcal", "cal": "cal", "m": "m", "cm": "cm", "mm": "mm", "um": "um", "nm": "nm", "pm": "pm", "angstrom": "angstrom", "a": "angstrom",
    "ng*h/ml": "ng*hour/mL", "ng*hr/ml": "ng*hour/mL", "ng*hour/ml": "ng*hour/mL", "ug*h/ml": "ug*hour/mL", "mg*h/ml": "mg*hour/mL",
    "l/hr/kg": "L/hour/kg", "l/h/kg": "L/hour/kg", "ml/min/kg": "mL/minute/kg", "ul/min/mg": "uL/minute/mg", "ml/min/mg": "mL/minute/mg",
}
#: Units whose values stay as reported.
AS_REPORTED = ("1e-6 cm/s", "ratio", "fold", "percent", "dimensionless", "x")
BLANK = ("", "-", SENTINEL, "nan", "NaN", "None")


def si_factors() -> dict[str, tuple[float, str]]:
    """Factor and SI unit of each normal spelling that has a factor."""
    found = {f"{p}M": (x * 1e3, MOLAR) for p, x in PREFIXES.items()}
    for p, x in PREFIXES.items():
        found |= {f"{p}L": (x * 1e-3, VOLUME), f"{p}g": (x * 1e-3, MASS)}
        found |= {f"{p}g/mL": (x * 1e3, MASS_VOLUME), f"{p}g/L": (x, MASS_VOLUME)} if p else {}
    found |= {"kg": (1.0, MASS)}
    found |= {t: (x, "second") for t, x in TIMES.items()} | {"h": (3600.0, "second")}
    found |= {f"1/{t}": (1 / TIMES[t], "1 / second") for t in ("second", "minute", "hour")}
    found |= {f"{p}g*hour/mL": (PREFIXES[p] * 3.6e6, "kilogram * second / meter ** 3") for p in ("n", "u", "m")}
    found |= {"L/hour/kg": (1e-3 / 3600, "meter ** 3 / kilogram / second"), "mL/minute/kg": (1e-6 / 60, "meter ** 3 / kilogram / second")}
    found |= {"uL/minute/mg": (1e-3 / 60, "meter ** 3 / kilogram / second"), "mL/minute/mg": (1 / 60, "meter ** 3 / kilogram / second")}
    found |= {"l/kg": (1e-3, "meter ** 3 / kilogram"), "ml/kg": (1e-6, "meter ** 3 / kilogram")}
    found |= {"m": (1.0, "meter"), "cm": (1e-2, "meter"), "mm": (1e-3, "meter"), "um": (1e-6, "meter"), "nm": (1e-9, "meter"), "pm": (1e-12, "meter"), "angstrom": (1e-10, "meter")}
    pressure, energy = "kilogram / meter / second ** 2", "kilogram * meter ** 2 / second ** 2"
    found |= {"Pa": (1.0, pressure), "bar": (1e5, pressure), "atm": (101325.0, pressure), "psi": (6894.757293168361, pressure)}
    found |= {"J": (1.0, energy), "kJ": (1e3, energy), "cal": (4.184, energy), "kcal": (4184.0, energy), "kelvin": (1.0, "kelvin")}
    return found


def _lookup(key: Column, values: dict) -> Column:
    """The value of key in a literal map, null if there is none."""
    pairs = [F.lit(x) for pair in values.items() for x in pair]
    return F.element_at(F.create_map(*pairs), key)


def normal_unit(unit: Column) -> Column:
    """A unit's normal spelling; null for a blank one, and the lower-cased text of one that is not known."""
    told = F.trim(unit)
    low = F.regexp_replace(F.translate(F.lower(told), "·×•", "***"), r"\s+", "")
    per = F.regexp_extract(low, r"^(min|hr|h|s|sec)-1$", 1)
    base = F.when(per == "min", F.lit("minute")).when(per.isin("hr", "h"), F.lit("hour")).otherwise(F.lit("second"))
    powers = F.replace(low, F.lit("^"), F.lit("**"))
    return (
        F.when(told.isNull() | told.isin(*BLANK), F.lit(None).cast("string"))
        .when(F.replace(told, F.lit(" "), F.lit("")).rlike("^[munp]?M$"), F.replace(told, F.lit(" "), F.lit("")))
        .when(low.rlike(r"^x?10\^?-6cm/s(ec)?$"), F.lit("1e-6 cm/s"))
        .when(low.isin("ratio", "fold", "x"), low)
        .when(low.isin("%", "percent"), F.lit("percent"))
        .when(per != "", F.concat(F.lit("1/"), base))
        .when(F.contains(low, F.lit("cell")), low)
        .otherwise(F.coalesce(_lookup(powers, SPELLINGS), powers))
    )


def to_si(value: Column, unit: Column) -> tuple[Column, Column]:
    """Value and unit in SI. Reported units keep the value; unknown ones keep value and unit as they are."""
    normal = normal_unit(unit)
    factors = si_factors()
    factor = _lookup(normal, {x: f for x, (f, _) in factors.items()})
    reported = normal.isin(*AS_REPORTED) | F.contains(normal, F.lit("cell"))
    return F.when(~reported & factor.isNotNull(), value * factor).otherwise(value), F.when(reported, normal).otherwise(F.coalesce(_lookup(normal, {x: s for x, (_, s) in factors.items()}), unit))


def convert_column(df: DataFrame, value: str, unit: str, value_si: str = "value_si", unit_si: str = "unit_si") -> DataFrame:
    """df with value_si (number; null where the value is no number) and unit_si added; a comparator before a value is dropped."""
    own = number(strip_comparator(F.col(value).cast("string")))
    converted, label = to_si(own, F.col(unit))
    return df.withColumns({value_si: converted, unit_si: F.when(own.isNotNull(), label).otherwise(F.col(unit))})


def measurement_kind(unit: Column) -> Column:
    """What a unit measures, by its spelling; the order of the questions decides."""
    u = F.lower(unit)
    holds = lambda *words: u.rlike("|".join(words))
    return (
        F.when(u.isNull() | (u == ""), F.lit("unknown"))
        .when(u.isin("ratio", "fold", "-", "x", "%", "percent") | F.contains(u, F.lit("cell")), F.lit("dimensionless"))
        .when(u.rlike(r"/\s*(min|hr|h|sec|s|day)\b") | u.rlike("^1/(min|hour|minute|s|second|hr|h)$"), F.lit("rate"))
        .when(holds("/l", "m"), F.lit("concentration"))
        .when(holds("hr", "sec", "day"), F.lit("time"))
        .when(holds("l"), F.lit("volume"))
        .when(holds("g"), F.lit("mass"))
        .when(holds("c", "f", "k"), F.lit("temperature"))
        .when(holds("bar", "pa", "psi"), F.lit("pressure"))
        .when(holds("j"), F.lit("energy"))
        .otherwise(F.lit("unknown"))
    )


def unit_summary(df: DataFrame, measurement: str, unit: str) -> DataFrame:
    """How often each unit is used for each kind of measurement."""
    return df.groupBy(F.col(measurement).alias("measurement"), F.col(unit).alias("unit")).agg(F.count(F.lit(1)).alias("n")).withColumn("kind", measurement_kind(F.col("unit")))
