"""Chemistry: what needs no toolkit as columns, and the boundary to an optional toolkit."""

from __future__ import annotations

from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sieveline.functions import structures
from sieveline.session import spread


class ChemBackendUnavailable(ImportError):
    """The operator needs a chemistry toolkit that is not installed; there is no stand-in for it."""


def _toolkit():
    try:
        from rdkit import Chem
    except ImportError as missing:
        raise ChemBackendUnavailable("this operator needs RDKit on the driver and the executors") from missing
    return Chem


def atom_counts(structure: Column, symbols: Sequence[str] = ("C", "N", "O", "S", "P", "F", "Cl", "Br", "I")) -> dict[str, Column]:
    """Atoms by symbol in a line notation, aromatic (lower-case) ones included; chlorine and bromine are no carbon and boron."""
    bare = F.regexp_replace(structure, "Cl|Br", "")
    return {x: F.regexp_count(structure if len(x) == 2 else bare, F.lit(x if len(x) == 2 else f"[{x}{x.lower()}]")) for x in symbols}


def one_hot(value: Column, choices: Sequence[str], other: bool = False) -> Column:
    """An array of 0 and 1, one place for each choice and, if asked, one for all else."""
    places = [F.coalesce(value == x, F.lit(False)) for x in choices]
    if other:
        places.append(~F.coalesce(value.isin(*choices), F.lit(False)))
    return F.array(*(x.cast("double") for x in places))


def standardise(df: DataFrame, structure: str, keep_stereo: bool = True) -> DataFrame:
    """df with Standardized_SMILES and Scaffold, each distinct structure worked on once; null for what is no structure."""
    _toolkit()

    @F.pandas_udf("std string, scaffold string")
    def worked(parts: pd.Series) -> pd.DataFrame:
        from rdkit import Chem
        from rdkit.Chem.MolStandardize import rdMolStandardize as std
        from rdkit.Chem.SaltRemover import SaltRemover
        from rdkit.Chem.Scaffolds import MurckoScaffold

        salts, charges, tautomers = SaltRemover(), std.Uncharger(), std.TautomerEnumerator()

        def one(text):
            mol = Chem.MolFromSmiles(text) if text else None
            if mol is None:
                return None, None
            mol = salts.StripMol(mol)
            for atom in mol.GetAtoms():
                atom.SetIsotope(0)
            mol = Chem.RemoveHs(charges.uncharge(mol))
            if not keep_stereo:
                Chem.AssignStereochemistry(mol, force=True, cleanIt=True)
            mol = tautomers.Canonicalize(mol)
            return Chem.MolToSmiles(mol), MurckoScaffold.MurckoScaffoldSmiles(mol=mol)

        return pd.DataFrame([one(x) for x in parts], columns=["std", "scaffold"])

    known = df.select(structure).distinct().withColumn("_w", worked(F.col(structure)))
    return df.join(known.select(structure, F.col("_w.std").alias("Standardized_SMILES"), F.col("_w.scaffold").alias("Scaffold")), structure, "left")


def with_pkas(df: DataFrame, structure: str) -> DataFrame:
    """df with acid_pka and base_pka by structures.pkas, each distinct structure read once; null for what is no structure."""
    known = df.select(F.col(f"`{structure}`").alias("_structure")).filter(F.col("_structure").isNotNull()).distinct()
    told = spread(known, "_structure").select("_structure", structures.pkas(structures.graph(F.col("_structure"))).alias("_p")).select("_structure", F.col("_p.acid").alias("acid_pka"), F.col("_p.base").alias("base_pka"))
    return df.drop("acid_pka", "base_pka").join(told, F.col(f"`{structure}`") == F.col("_structure"), "left").drop("_structure")


#: The columns that descriptors adds.
DESCRIPTORS = ("logp", "tpsa", "donors", "acceptors")


def descriptors(df: DataFrame, structure: str) -> DataFrame:
    """df with logp, tpsa, donors and acceptors, as one of the pH corrections takes them."""
    _toolkit()

    @F.pandas_udf("logp double, tpsa double, donors double, acceptors double")
    def described(parts: pd.Series) -> pd.DataFrame:
        from rdkit import Chem
        from rdkit.Chem import Crippen, Lipinski, rdMolDescriptors

        def one(text):
            mol = Chem.MolFromSmiles(text) if text else None
            if mol is None:
                return [None] * len(DESCRIPTORS)
            return [Crippen.MolLogP(mol), rdMolDescriptors.CalcTPSA(mol), float(Lipinski.NumHDonors(mol)), float(Lipinski.NumHAcceptors(mol))]

        return pd.DataFrame([one(x) for x in parts], columns=[*DESCRIPTORS])

    known = df.select(structure).distinct().withColumn("_d", described(F.col(structure)))
    return df.join(known.select(structure, "_d.*"), structure, "left")


def atom_graph(df: DataFrame, structure: str, places: bool = False) -> DataFrame:
    """df with nodes (features of each atom) and edges (src, dst, features; both ways) of each structure.

    The toolkit only tells attributes; features, one-hot or as places, are columns. Null for what is no structure.
    """
    from sieveline.operators import features

    _toolkit()

    @F.pandas_udf(
        "atoms array<struct<number:int,degree:int,chirality:string,charge:int,hybridisation:string,hydrogens:int,aromatic:boolean>>,"
        "bonds array<struct<src:int,dst:int,kind:string,direction:string,conjugated:boolean,ring:boolean>>"
    )
    def told(parts: pd.Series) -> pd.DataFrame:
        from rdkit import Chem

        def one(text):
            mol = Chem.MolFromSmiles(text) if text else None
            if mol is None:
                return None, None
            atoms = [{"number": a.GetAtomicNum(), "degree": a.GetTotalDegree(), "chirality": str(a.GetChiralTag()), "charge": a.GetFormalCharge(), "hybridisation": str(a.GetHybridization()), "hydrogens": a.GetTotalNumHs(), "aromatic": a.GetIsAromatic()} for a in mol.GetAtoms()]
            bonds = [(b.GetBeginAtomIdx(), b.GetEndAtomIdx(), str(b.GetBondType()), str(b.GetBondDir()), b.GetIsConjugated(), b.IsInRing()) for b in mol.GetBonds()]
            return atoms, [{"src": x, "dst": y, "kind": k, "direction": d, "conjugated": c, "ring": r} for a, b, k, d, c, r in bonds for x, y in ((a, b), (b, a))]

        return pd.DataFrame([one(x) for x in parts], columns=["atoms", "bonds"])

    of_atom, of_bond = (features.atom_indices, features.bond_indices) if places else (features.atom_onehot, features.bond_onehot)
    nodes = F.transform("_g.atoms", lambda a: of_atom(*(a[x] for x in ("number", "degree", "chirality", "charge", "hybridisation", "hydrogens", "aromatic"))))
    edges = F.transform("_g.bonds", lambda b: F.struct(b["src"].alias("src"), b["dst"].alias("dst"), of_bond(*(b[x] for x in ("kind", "direction", "conjugated", "ring"))).alias("bond")))
    known = df.select(structure).distinct().withColumn("_g", told(F.col(structure)))
    return df.join(known.select(structure, nodes.alias("nodes"), edges.alias("edges")), structure, "left")
