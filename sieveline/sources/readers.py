"""Long assay records from CSV, workbooks, Parquet or a DataFrame, in canonical form."""

from __future__ import annotations

import os
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sieveline.functions import cleaning
from sieveline.functions.cleaning import canonicalise_columns, clean_text_columns, fill_conditions, missing_to_null, with_sentinel
from sieveline.schema import ENDPOINTS
from sieveline.session import numbered
from sieveline.sources import workbook

#: Sheets that are read where they are there, with the row of their header.
SHEETS = {"ADMET": 0, "PK": 0, "데이터": 1}
HUMAN_PK_HEADER = 2


class HumanPkWorkbook(ValueError):
    """The workbook holds human pharmacokinetics, which stay as they are; frame has them."""

    def __init__(self, frame: DataFrame):
        super().__init__("a workbook of human pharmacokinetics")
        self.frame = frame


def check_path(path: str, base_dir: str | None = None) -> str:
    """path, which must be a CSV, workbook or Parquet path and, if a base is given, lie under it."""
    if base_dir is not None and os.path.commonpath([os.path.realpath(base_dir), os.path.realpath(path)]) != os.path.realpath(base_dir):
        raise ValueError(f"{path} is outside {base_dir}")
    if not path.lower().rstrip("/").endswith((".csv", ".xlsx", ".xls", ".parquet")):
        raise ValueError(f"unsupported kind of file: {path}")
    if "://" not in path and not os.path.exists(path):
        raise FileNotFoundError(path)
    return path


def read_csv(spark: SparkSession, path: str) -> DataFrame:
    """All columns as text, with missing tokens as null."""
    raw = spark.read.option("header", True).option("inferSchema", False).option("multiLine", True).option("escape", '"').csv(path)
    return raw.select(*(missing_to_null(F.col(f"`{x}`")).alias(x) for x in raw.columns))


def choose_sheets(names: list[str]) -> tuple[list[tuple[str, int]], bool]:
    """The sheets to read with their header rows, and whether they hold human pharmacokinetics."""
    human = [x for x in names if x.startswith("데이터") and "human pk" in x.lower()]
    if human:
        return [(x, HUMAN_PK_HEADER) for x in human], True
    return [(x, SHEETS[x]) for x in SHEETS if x in names] or [(names[0], 0)], False


def union_sheets(sheets: Mapping[str, DataFrame]) -> DataFrame:
    """Sheets one below the other, by column names; what a sheet lacks is null."""
    frames = list(sheets.values())
    out = frames[0]
    for frame in frames[1:]:
        out = out.unionByName(frame, allowMissingColumns=True)
    return out


def read_workbook(spark: SparkSession, path: str) -> DataFrame:
    """A workbook's records, all as text with missing tokens as null; its sheets are read in ranges of rows (sources.workbook)."""
    workbook.register(spark)
    chosen, human = choose_sheets(workbook.sheet_names(path))
    sheets = {name: spark.read.format(workbook.FORMAT).options(sheet=name, header=str(header)).load(path) for name, header in chosen}
    raw = union_sheets(sheets)
    found = raw.select(*(missing_to_null(F.col(f"`{x}`")).alias(x) for x in raw.columns))
    if human:
        smiles = next((x for x in found.columns if "smiles" in x.lower()), None)
        raise HumanPkWorkbook((found.withColumnRenamed(smiles, "SMILES_Structure_Parent") if smiles else found).withColumn("is_human_pk", F.lit(True)))
    return found


def canonical(df: DataFrame, lower: bool = False, smiles: str = "SMILES_Structure_Parent") -> DataFrame:
    """Canonical columns, plain text, permeability pairs, condition columns, and the sentinel for null text."""
    named = canonicalise_columns(df, lower)
    smiles = smiles.lower() if lower else smiles
    if smiles not in named.columns:
        raise ValueError(f"no column {smiles}")
    case = str.lower if lower else str
    ab, ba = case("Measurement_Value(AtoB)"), case("Measurement_Value(BtoA)")
    clean = clean_text_columns(named)
    if ab in clean.columns and ba in clean.columns:
        back, efflux = ("measurement_value_btoa", "measurement_efflux_ratio") if lower else ("Measurement_Value_BtoA", "Measurement_EffluxRatio")
        clean = cleaning.expand_permeability(clean, ab, ba, case("Measurement_Value"), back, efflux)
    filled = fill_conditions(clean, tuple(map(case, cleaning.CONDITION_COLUMNS)))
    kept_null = {case("Measurement_Value"), smiles}
    return filled.select(*(with_sentinel(F.col(f"`{x}`")).alias(x) if kind == "string" and x not in kept_null else F.col(f"`{x}`") for x, kind in filled.dtypes))


def read_records(spark: SparkSession, source: str | DataFrame, lower: bool = False, base_dir: str | None = None, number_rows: bool = True) -> DataFrame:
    """Records in canonical form; with a row_id, if rows are to be numbered, for which they are written (session.numbered)."""
    if isinstance(source, DataFrame):
        raw = source
    else:
        path = check_path(source, base_dir)
        kind = path.lower().rstrip("/").rpartition(".")[2]
        raw = {"csv": read_csv, "parquet": lambda s, p: s.read.parquet(p)}.get(kind, read_workbook)(spark, path)
    records = canonical(raw, lower)
    return numbered(records) if number_rows else records


def read_synonyms(spark: SparkSession, path: str, most: int = 100_000) -> dict[str, str]:
    """Own names of endpoints from a JSON object or a CSV with source and target; later entries win."""
    if path.endswith(".json"):
        row = spark.read.option("multiLine", True).json(path).limit(1).collect()
        return {k: str(v) for k, v in row[0].asDict().items()} if row else {}
    rows = spark.read.option("header", True).csv(path).select("source", "target").limit(most + 1).collect()
    if len(rows) > most:
        raise ValueError(f"more than {most} synonyms")
    return {x.source: x.target for x in rows if x.source and x.target}


def read_endpoints(spark: SparkSession, path: str | None = None) -> tuple[str, ...]:
    """The endpoint columns: a file's first line, between tabs, or the built-in ones."""
    if path is None:
        return ENDPOINTS
    first = spark.read.text(path).limit(1).collect()
    return tuple(x.strip() for x in first[0].value.split("\t") if x.strip()) if first else ()


def read_vocabulary(spark: SparkSession, path: str, most: int = 10_000) -> dict[str, tuple[str, ...]]:
    """A controlled vocabulary: the columns of a small CSV, each without its blanks; raises beyond most rows."""
    table = spark.read.option("header", True).csv(path)
    rows = table.limit(most + 1).collect()
    if len(rows) > most:
        raise ValueError(f"more than {most} rows of vocabulary")
    return {c: tuple(x[c] for x in rows if x[c]) for c in table.columns}


def read_fragments(spark: SparkSession, path: str) -> DataFrame:
    """A fragment vocabulary: smiles, atom_num and freq between tabs."""
    return spark.read.option("sep", "\t").schema("smiles string, atom_num int, freq long").csv(path)
