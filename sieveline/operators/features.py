"""Features of atoms, bonds and motifs as columns over their attributes, whichever toolkit or table these come from.

Chirality, hybridisation, bond types and directions are told by name (CHI_OTHER, SP2, AROMATIC, ENDUPRIGHT).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from sieveline.functions.structures import let

#: What has a place of its own, in order.
ATOMIC_NUMBERS = (1, 5, 6, 7, 8, 9, 11, 13, 14, 15, 16, 17, 19, 30, 33, 34, 35, 53)
DEGREES = (0, 1, 2, 3, 4)
CHIRALITIES = ("CHI_UNSPECIFIED", "CHI_TETRAHEDRAL_CW", "CHI_TETRAHEDRAL_CCW", "CHI_OTHER")
CHARGES = (-5, -4, -3, -2, -1, 0, 1, 2, 3, 4, 5)
HYBRIDISATIONS = ("S", "SP", "SP2", "SP3", "SP3D", "SP3D2", "UNSPECIFIED")
HYDROGENS = (0, 1, 2, 3, 4)
BONDS = ("SINGLE", "DOUBLE", "TRIPLE", "AROMATIC")
DIRECTIONS = ("NONE", "ENDUPRIGHT", "ENDDOWNRIGHT")
#: Counted elements. No symbol is spelt CL, so chlorine falls under what is left.
ELEMENTS = ("C", "H", "O", "N", "P", "S", "F", "CL", "Br")
MOTIF_KEYS = 167
MOTIF_WIDTH = 5 + len(ELEMENTS) + 1 + MOTIF_KEYS


def index_of(value: Column, choices: Sequence, default: int | None = None) -> Column:
    """The place of a value among the choices, from 0; else, and for null, the default."""
    place = F.array_position(F.array(*map(F.lit, choices)), value) - 1
    return F.when(place >= 0, place).otherwise(F.lit(default)).cast("int")


def _flag(value: Column) -> Column:
    return F.coalesce(value.cast("int"), F.lit(0))


def _row_of(value: Column, choices: Sequence, other: bool = False) -> Column:
    """chem.one_hot by one look-up in an array of ready rows: the first is for what is in no list."""
    width = len(choices) + other
    ready = [[float(other and j == width - 1) for j in range(width)]] + [[float(i == j) for j in range(width)] for i in range(len(choices))]
    rows = F.array(*(F.array(*map(F.lit, x)) for x in ready))
    return F.get(rows, F.coalesce(F.array_position(F.array(*map(F.lit, choices)), value), F.lit(0)).cast("int"))


def atom_onehot(number: Column, degree: Column, chirality: Column, charge: Column, hybridisation: Column, hydrogens: Column, aromatic: Column) -> Column:
    """43 numbers: element (19), degree (6), chirality (4), place of the charge, hybridisation (7), hydrogens (5), aromatic."""
    places = F.concat(_row_of(number, ATOMIC_NUMBERS, other=True), _row_of(degree, DEGREES, other=True), _row_of(chirality, CHIRALITIES))
    tail = F.concat(_row_of(hybridisation, HYBRIDISATIONS), _row_of(hydrogens, HYDROGENS), F.array(_flag(aromatic).cast("double")))
    return F.concat(places, F.array(index_of(charge, CHARGES, len(CHARGES)).cast("double")), tail)


def atom_indices(number: Column, degree: Column, chirality: Column, charge: Column, hybridisation: Column, hydrogens: Column, aromatic: Column) -> Column:
    """7 places: what is in no list takes the last place, chirality the first, and a charge the one after the last."""
    return F.array(
        index_of(number, ATOMIC_NUMBERS, len(ATOMIC_NUMBERS)),
        index_of(degree, DEGREES, len(DEGREES)),
        index_of(chirality, CHIRALITIES, 0),
        index_of(charge, CHARGES, len(CHARGES)),
        index_of(hybridisation, HYBRIDISATIONS, len(HYBRIDISATIONS) - 1),
        index_of(hydrogens, HYDROGENS, len(HYDROGENS) - 1),
        _flag(aromatic),
    )


def bond_onehot(kind: Column, direction: Column, conjugated: Column, ring: Column) -> Column:
    """10 numbers: type (4, and one for null, which is no bond), direction (3), conjugated, in a ring. Motif bonds alike."""
    return F.concat(_row_of(kind, BONDS), F.array(kind.isNull().cast("double")), _row_of(direction, DIRECTIONS), F.array(_flag(conjugated).cast("double"), _flag(ring).cast("double")))


def bond_indices(kind: Column, direction: Column, conjugated: Column, ring: Column) -> Column:
    """4 places; a type or direction in no list is null, a null type has the last place. Motif bonds alike."""
    place = F.when(kind.isNull(), F.lit(len(BONDS))).otherwise(index_of(kind, BONDS))
    return F.array(place, index_of(direction, DIRECTIONS), _flag(conjugated), _flag(ring))


def element_counts(symbols: Column) -> Column:
    """Atoms by ELEMENTS, and at the end all others, from an array of symbols."""
    counts = [F.size(symbols) - F.size(F.array_remove(symbols, x)) for x in ELEMENTS]  # nulls stay, and are not counted
    others = F.size(F.filter(symbols, lambda s: ~s.isin(*ELEMENTS)))
    return F.array(*(x.cast("double") for x in (*counts, others)))


def motif_features(tpsa: Column, logp: Column, heavy_weight: Column, rings: Column, symbols: Column, keys: Column, place: Column | None = None) -> Column:
    """182 numbers of a motif: surface and weight over 100, logP, rings, elements, structural keys; with place, 183.

    A motif with a missing attribute, or without its 167 keys, gets zeros throughout.
    """
    head = F.array(tpsa * 0.01, logp * 1.0, heavy_weight * 0.01, (rings > 0).cast("double"), rings.cast("double"))
    parts = [head, let(symbols, element_counts), F.transform(keys, lambda x: x.cast("double"))]
    width = MOTIF_WIDTH
    if place is not None:
        parts, width = [F.array(place.cast("double")), *parts], width + 1

    def checked(whole: Column) -> Column:  # null where symbols or keys are
        fine = (F.size(whole) == width) & ~F.exists(whole, lambda x: x.isNull())
        return F.when(F.coalesce(fine, F.lit(False)), whole).otherwise(F.array_repeat(F.lit(0.0), width))

    return let(F.when(symbols.isNotNull(), F.concat(*parts)), checked)
