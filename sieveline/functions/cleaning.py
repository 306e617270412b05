"""Row-local columns: text clean-up, numbers in text, permeability pairs, endpoint keys."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sieveline.schema import CANONICAL_COLUMNS, COLUMN_ALIASES, CONDITION_COLUMNS, MISSING_TOKENS, SENTINEL

#: Signs that are spelled out.
SPELLED_OUT = {"°": "deg", "α": "alpha", "β": "beta", "γ": "gamma", "δ": "delta", "±": "+/-", "≤": "<=", "≥": ">="}
#: Cells that hold no bracket list.
NO_LIST = ("", "-", SENTINEL, "nan", "NaN", "None")
COMPARATOR = r"^[<>]=?\s*"
NUMBER = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"


def canonical_names(names: list[str], lower: bool = False) -> list[str | None]:
    """New names of columns, None where a column is dropped: of columns with the same new name the first stays.

    A name is matched without case and without trailing asterisks; others stay. Without a Measurement_Value,
    the legacy column "Unnamed: 10" takes its place; other unnamed columns go.
    """
    known = {x.lower(): x for x in CANONICAL_COLUMNS} | COLUMN_ALIASES
    found: list[str | None] = []
    for name in names:
        new = known.get(name.strip().rstrip("*").strip().lower(), name)
        found.append(new.lower() if lower and new in known.values() else new)
    value = "measurement_value" if lower else "Measurement_Value"
    if value not in found and "Unnamed: 10" in found:
        found[found.index("Unnamed: 10")] = value
    return [x if not x.startswith("Unnamed") and x not in found[:i] else None for i, x in enumerate(found)]


def canonicalise_columns(df: DataFrame, lower: bool = False) -> DataFrame:
    new = canonical_names(df.columns, lower)
    return df.toDF(*(f"_{i}" for i in range(len(new)))).select(*(F.col(f"_{i}").alias(x) for i, x in enumerate(new) if x is not None))


def spell_out(text: Column) -> Column:
    """Greek and mathematical signs in plain letters."""
    out = F.translate(text, "μ×÷", "ux/")
    for sign, words in SPELLED_OUT.items():
        out = F.replace(out, F.lit(sign), F.lit(words))
    return out


def clean_text_columns(df: DataFrame) -> DataFrame:
    """spell_out over every text column, in one projection."""
    return df.select(*(spell_out(F.col(f"`{x}`")).alias(x) if kind == "string" else F.col(f"`{x}`") for x, kind in df.dtypes))


def missing_to_null(text: Column) -> Column:
    return F.when(~text.isin(*MISSING_TOKENS), text)


def with_sentinel(text: Column) -> Column:
    return F.coalesce(text, F.lit(SENTINEL))


def fill_conditions(df: DataFrame, columns: tuple[str, ...] = CONDITION_COLUMNS) -> DataFrame:
    """The condition columns, made where they are missing, with the sentinel for null."""
    return df.withColumns({x: with_sentinel(F.col(f"`{x}`")) if x in df.columns else F.lit(SENTINEL) for x in columns})


def number(text: Column) -> Column:
    """A number as text, or null: no trailing type letters, and no NaN."""
    return F.when(text.rlike(NUMBER), F.trim(text).try_cast("double"))


def strip_comparator(text: Column) -> Column:
    return F.regexp_replace(F.trim(text), COMPARATOR, "")


def censored(text: Column) -> Column:
    """relation and value of a number that may follow <, <=, > or >=."""
    relation = F.nullif(F.regexp_extract(F.trim(text), r"^([<>]=?)", 1), F.lit(""))
    return F.struct(relation.alias("relation"), number(strip_comparator(text)).alias("value"))


def bracket_numbers(cell: Column) -> Column:
    """[6,2], [6,] or 6.2 as an array of numbers, null where a place is empty."""
    inner = F.regexp_replace(F.trim(cell), r"^[\[\]]+|[\[\]]+$", "")
    parts = F.transform(F.split(inner, ",", -1), lambda x: number(strip_comparator(x)))
    empty = F.array().cast("array<double>")
    return F.when(cell.isNull() | F.trim(cell).isin(*NO_LIST) | (F.trim(inner) == ""), empty).otherwise(parts)


def permeability_pair(ab: Column, ba: Column) -> tuple[Column, Column]:
    """Permeability from A to B and from B to A out of two bracket lists."""
    forth = F.coalesce(F.get(ab, F.lit(0)), F.get(ba, F.lit(0)))
    back = F.when(F.size(ba) >= 2, F.get(ba, F.lit(1))).when(F.size(ba) == 1, F.get(ba, F.lit(0)))
    return forth, F.coalesce(back, F.get(ab, F.lit(1)))


def ratio(over: Column, under: Column) -> Column:
    return F.when(over.isNotNull() & under.isNotNull() & (under != 0), over / under)


def expand_permeability(df: DataFrame, ab: str, ba: str, value: str = "Measurement_Value", back: str = "Measurement_Value_BtoA", efflux: str = "Measurement_EffluxRatio") -> DataFrame:
    """value filled from A to B where it is missing, and the columns back and efflux."""
    forth, backward = permeability_pair(bracket_numbers(F.col(f"`{ab}`")), bracket_numbers(F.col(f"`{ba}`")))
    missing = F.col(value).isNull() | F.trim(F.col(value).cast("string")).isin(*NO_LIST) if value in df.columns else F.lit(True)
    own = F.col(value).cast("string") if value in df.columns else F.lit(None).cast("string")
    return df.withColumns({value: F.when(missing, forth.cast("string")).otherwise(own), back: backward, efflux: ratio(backward, forth)})


def endpoint_key(test: Column, test_type: Column, measurement_type: Column) -> Column:
    """The three joined by bars, without bars and blanks at the ends; the test where nothing is left."""
    parts = [F.when(x.isNull() | (x == SENTINEL), F.lit("")).otherwise(x) for x in (test, test_type, measurement_type)]
    joined = F.regexp_replace(F.concat(parts[0], F.lit(" | "), parts[1], F.lit(" | "), parts[2]), r"^[ |]+|[ |]+$", "")
    return F.when(joined == "", test).otherwise(joined)


def qualitative(unit: Column, value: Column) -> Column:
    """1 and 0 for units that say positive and negative, else the value."""
    said = F.lower(F.trim(unit))
    return F.when(said == "positive", F.lit(1.0)).when(said == "negative", F.lit(0.0)).otherwise(value)


def task_file_name(name: str) -> str:
    """A name without signs that file systems treat as special."""
    return re.sub(r"[^\w\-.]", "_", name)
