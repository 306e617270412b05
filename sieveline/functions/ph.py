"""pH of a record, and three corrections of a value to a target pH."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from sieveline.functions.cleaning import number

PH_TEXT = r"(?i)pH\s*([0-9]+(?:\.[0-9]+)?)"
TARGET = 7.4


def ph_in_text(text: Column) -> Column:
    return F.nullif(F.regexp_extract(text, PH_TEXT, 1), F.lit("")).try_cast("double")


def bare_ph(text: Column) -> Column:
    found = number(text)
    return F.when((found >= 0) & (found <= 14), found)


def infer_ph(direct: list[Column], subject: Column, condition: Column, test_type: Column) -> Column:
    """The first of: columns that hold a pH, pH in the subject, pH or a bare number in the condition, pH in the type."""
    return F.coalesce(*(number(x.cast("string")) for x in direct), ph_in_text(subject), ph_in_text(condition), bare_ph(condition), ph_in_text(test_type))


def _unionised(pka: Column, ph: Column | float, acid: bool) -> Column:
    shift = (pka - ph) if acid else (F.lit(ph) if isinstance(ph, float) else ph) - pka
    return 1 - 1 / (1 + F.pow(F.lit(10.0), shift))


def henderson_hasselbalch(value: Column, ph: Column, acid_pka: Column, base_pka: Column, target: float = TARGET) -> Column:
    """By the share that is not ionised; of two pKa the one closer to 7.4 counts, the basic one of equals."""
    use_acid = acid_pka.isNotNull() & (base_pka.isNull() | (F.abs(acid_pka - TARGET) < F.abs(base_pka - TARGET)))
    at_target = F.when(use_acid, _unionised(acid_pka, target, True)).otherwise(_unionised(base_pka, target, False))
    measured = F.when(use_acid, _unionised(acid_pka, ph, True)).otherwise(_unionised(base_pka, ph, False))
    same = (ph == target) | (acid_pka.isNull() & base_pka.isNull()) | (measured == 0)
    return F.when(same, value).otherwise(value * at_target / F.when(measured != 0, measured))


def _clamped(x: Column, low: float, high: float) -> Column:
    return F.greatest(F.lit(low), F.least(F.lit(high), x))


def empirical(value: Column, ph: Column, target: float = TARGET) -> Column:
    shift = F.lit(target) - ph
    slope = F.when(F.abs(shift) <= 1, F.lit(0.05)).when(F.abs(shift) <= 2, F.lit(0.1)).otherwise(F.lit(0.15))
    return value * _clamped(1 + shift * slope, 0.1, 10.0)


def molecular_properties(value: Column, ph: Column, logp: Column, tpsa: Column, donors: Column, acceptors: Column, target: float = TARGET) -> Column:
    """By lipophilicity, polar surface and hydrogen bonds, which come as columns."""
    sensitivity = (_clamped(1 - logp / 10, 0.5, 2.0) + _clamped(1 + tpsa / 200, 0.5, 2.0) + _clamped(1 + (donors + acceptors) / 20, 0.5, 2.0)) / 3
    return value * _clamped(1 + (F.lit(target) - ph) * 0.1 * sensitivity, 0.1, 10.0)


def corrected(value: Column, ph: Column, method: str, target: float = TARGET, **columns: Column) -> dict[str, Column]:
    """Columns by method: hh, emp, mp, or all of them; null where there is no pH, the value itself where either is no number."""
    ways = {
        "hh": lambda v: henderson_hasselbalch(v, ph, columns["acid_pka"], columns["base_pka"], target),
        "emp": lambda v: empirical(v, ph, target),
        "mp": lambda v: molecular_properties(v, ph, columns["logp"], columns["tpsa"], columns["donors"], columns["acceptors"], target),
    }
    if method not in (*ways, "all"):
        raise ValueError(f"no such pH correction: {method}")
    return {k: F.when(ph.isNotNull(), way(value)) for k, way in ways.items() if method in (k, "all")}
