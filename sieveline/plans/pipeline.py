"""The three ways in: tasks, the wide matrix, and both for callers in Python. All plans are lazy until written."""

from __future__ import annotations

import logging
from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sieveline.functions import cleaning, endpoints, ph, units
from sieveline.functions.cleaning import endpoint_key, number, qualitative
from sieveline.operators import chem, dedup, fragments, matrix, quality, split, stats
from sieveline.schema import CONDITION_COLUMNS, ENDPOINTS, SENTINEL
from sieveline.session import Scratch, cut, numbered
from sieveline.sources import readers, sinks
from sieveline.sources.config import Settings

PH_COLUMNS = ("pH", "pH_Value", "Measurement_pH", "Test_pH")
PK_TEST = "Pharmacokinetics"
RING_KEY = "Ring_Linker_Key"
PK_TEXTS = ("test", "test_type", "measurement_type", "test_subject")


def _case(lower: bool) -> Callable[[str], str]:
    return str.lower if lower else str


def add_ph(df: DataFrame, value: str, settings: Settings, lower: bool = False) -> DataFrame:
    """inferred_pH and a column for each correction whose inputs are there."""
    case = _case(lower)
    columns = {x.lower(): x for x in df.columns}
    direct = [F.col(columns[x.lower()]) for x in PH_COLUMNS if x.lower() in columns]
    text = lambda name: F.col(case(name)) if case(name) in df.columns else F.lit(None).cast("string")
    found = df.withColumn("inferred_pH", ph.infer_ph(direct, text("Test_Subject"), text("Measurement_Condition"), text("Test_Type")))
    asked = settings.ph_method
    pkas = [x for x in ("acid_pka", "base_pka") if asked in ("hh", "all") and x not in df.columns]
    if pkas:  # what the input has stays its own
        own_columns = [x for x in ("acid_pka", "base_pka") if x not in pkas]
        told = chem.with_pkas(found.withColumnsRenamed({x: f"_own_{x}" for x in own_columns}), case(settings.smiles_col))
        found = told.drop(*own_columns).withColumnsRenamed({f"_own_{x}": x for x in own_columns})
    missing = [x for x in chem.DESCRIPTORS if asked in ("mp", "all") and x not in df.columns]
    if missing:
        try:
            own_columns = [x for x in chem.DESCRIPTORS if x in found.columns]
            described = chem.descriptors(found.withColumnsRenamed({x: f"_own_{x}" for x in own_columns}), case(settings.smiles_col))
            found = described.drop(*(x for x in chem.DESCRIPTORS if x not in missing)).withColumnsRenamed({f"_own_{x}": x for x in own_columns})
        except chem.ChemBackendUnavailable:
            if asked != "all":
                raise
            logging.getLogger(__name__).warning("without RDKit the pH correction that needs %s is left out", ", ".join(missing))
    inputs = {x: F.col(x) for x in ("acid_pka", "base_pka", "logp", "tpsa", "donors", "acceptors") if x in found.columns}
    methods = [x for x, needs in (("hh", ("acid_pka", "base_pka")), ("emp", ()), ("mp", ("logp", "tpsa", "donors", "acceptors"))) if settings.ph_method in (x, "all") and all(n in inputs for n in needs)]
    own = number(F.col(value).cast("string"))
    for method in methods:
        column = ph.corrected(own, F.col("inferred_pH"), method, settings.target_ph, **inputs)[method]
        found = found.withColumn(f"{value}_pH_corrected_{method}", column)
    return found


def prepare_tasks(df: DataFrame, settings: Settings, keys: tuple[str, ...], task_type: str | None = None, lower: bool = False) -> DataFrame:
    """Units, pH, structures, labels, outliers and duplicates of all tasks at once; df has row_id.

    Labels are scaled from raw values and before duplicates go, as the results depend on it.
    """
    case = _case(lower)
    value, unit, smiles = case(settings.activity_col), case("Measurement_Unit"), case(settings.smiles_col)
    out = df
    if settings.convert_units and unit in out.columns:
        out = units.convert_column(out, value, unit, f"{value}_si", f"{unit}_si")
    if settings.correct_ph:
        out = add_ph(out, value, settings, lower)
    structure, by_scaffold = "Standardized_SMILES", settings.split and settings.split_method == "scaffold"
    if structure not in out.columns:
        try:
            out = chem.standardise(out.drop("Scaffold"), smiles, settings.keep_stereo)
        except chem.ChemBackendUnavailable:
            logging.getLogger(__name__).warning("without RDKit no structure is standardised: duplicates are those of one spelling")
            structure = smiles
    if by_scaffold and "Scaffold" not in out.columns:
        # rings and what links them, read from the structure as it stands, under a name of its own
        out = fragments.with_fragments(out, structure).drop("rings", "fragments", "edges").withColumnRenamed("ring_linker_key", RING_KEY)
    out = out.withColumn("_x", number(F.col(value).cast("string")))
    task_type = task_type or settings.task_type
    kind = F.lit(task_type) if task_type else F.col("task_type") if "task_type" in out.columns else F.lit("regression")
    out = stats.zscore(out, keys, "_x", f"{value}_scaled").withColumn(f"{value}_scaled", F.when(kind == "regression", F.col(f"{value}_scaled")))
    if settings.threshold is not None:
        out = stats.labels(out, keys, value, "_x", settings.threshold)
    if settings.detect_outliers:
        out = stats.outliers(out, keys, "_x", "row_id", task_type or kind).filter(~F.col("is_outlier")).drop("is_outlier")
    if not settings.keep_duplicates:
        out = dedup.strict_or_first(out.withColumn("_pk", F.col(case("Test")) == PK_TEST), keys, structure, "row_id", "_pk").drop("_pk")
    return out.drop("_x")


def run_tasks(spark: SparkSession, settings: Settings) -> DataFrame:
    """Records of all tasks with a quorum, prepared and, if asked, split; raises where no task has one.

    A workbook of human pharmacokinetics has no tasks: readers.HumanPkWorkbook comes through, with its frame.
    """
    records = readers.read_records(spark, settings.input_path, base_dir=settings.base_dir)
    keys = tuple(CONDITION_COLUMNS)
    relation = "Measurement_Relation" if "Measurement_Relation" in records.columns else None
    good = quality.with_quorum(records, keys, settings.activity_col, relation)
    if good.isEmpty():
        raise quality.TrainingQuorumError("regression", "no task has enough records to train on")
    out = prepare_tasks(good, settings, keys)
    if settings.split:
        group = "Scaffold" if "Scaffold" in out.columns else RING_KEY
        out = split.split(out, settings.split_method, keys, "row_id", group, settings.activity_col, settings.test_size, settings.valid_size)
    return out.withColumn("task", sinks.task_name(*(F.col(x) for x in keys)))


def _find(columns: list[str], wanted: list[str], holds: Callable[[str], bool], what: str) -> str:
    for name in (*wanted, *(x for x in columns if holds(x.lower()))):
        if name in columns:
            return name
    raise ValueError(f"no {what} column")


def _texts(df: DataFrame) -> Callable[[str], Column]:
    """The column of a lower-case name, or what stands for one that is lacking."""
    lowered = {x.lower(): x for x in df.columns}
    return lambda name: F.col(f"`{lowered[name]}`") if name in lowered else F.lit(SENTINEL)


def wide_matrix(df: DataFrame, settings: Settings, own_synonyms: dict[str, str] | None = None, ask: Callable[[list[str]], dict[str, str]] | None = None, names: tuple[str, ...] = ENDPOINTS, store: str | None = None) -> tuple[DataFrame, DataFrame]:
    """The wide matrix and the records without an endpoint.

    ask: an outside mapper of distinct names, in place of the rules. With store, a folder for its answers, it is asked
    from tasks, about any number of names (endpoints.map_by_service); else at once on the driver, about a bounded number.
    """
    return _wide_matrix(df, settings, own_synonyms, ask, names, store)[:2]


def _wide_matrix(df: DataFrame, settings: Settings, own_synonyms: dict[str, str] | None, ask: Callable[[list[str]], dict[str, str]] | None = None, names: tuple[str, ...] = ENDPOINTS, store: str | None = None) -> tuple[DataFrame, DataFrame, tuple[int, bool]]:
    """wide_matrix, and how many distinct names were asked for, and whether any record is of pharmacokinetics.

    These facts come from the distinct names, which are written once with a mark of their own; the source isn't read again for them.
    """
    columns = df.columns
    prepared = settings.skip_preprocessing
    smiles = _find(columns, ["Standardized_SMILES", "smiles_structure_parent", "smiles"] if prepared else [settings.smiles_col, "smiles_structure_parent"], lambda x: "smiles" in x, "structure")
    ladder = ["measurement_value_si", "measurement_value_scaled", "measurement_value"] if prepared else [settings.activity_col]
    value = _find(columns, ladder, lambda x: "measurement" in x and "value" in x or prepared and "activity" in x, "activity")
    lowered, text = {x.lower(): x for x in columns}, _texts(df)
    keyed = df.withColumn("endpoint_key", endpoint_key(text("test"), text("test_type"), text("measurement_type")))
    pk = F.coalesce(matrix.is_pk_row(*(text(x) for x in PK_TEXTS)), F.lit(False))
    with Scratch(df.sparkSession) as held:
        asked = cut(keyed.groupBy("endpoint_key").agg(F.bool_or(pk).alias("pk")), "matrix-names")
        if ask and store:
            mapping = cut(endpoints.map_by_service(asked, "endpoint_key", ask, store), "matrix-mapping")
        elif ask:
            mapping = endpoints.map_by_callable(asked, "endpoint_key", ask)
        else:
            mapping = endpoints.match_endpoints(asked, "endpoint_key", settings.dialect, own_synonyms, settings.min_similarity, names)
        told = asked.agg(F.count("endpoint_key").alias("names"), F.coalesce(F.bool_or("pk"), F.lit(False)).alias("pk")).first()
        held.keep_all_but(asked)
    mapped = endpoints.map_endpoints(keyed, "endpoint_key", mapping)
    if prepared or "measurement_unit" not in lowered:
        valued = mapped.withColumn("value_si", number(F.col(f"`{value}`").cast("string")))
    else:
        unit = lowered["measurement_unit"]
        blank = F.col(f"`{unit}`").isNull() | F.col(f"`{unit}`").isin(*units.BLANK)
        converted = units.convert_column(mapped, value, unit)
        valued = converted.withColumn("value_si", qualitative(F.col(f"`{unit}`"), F.when(blank, number(F.col(f"`{value}`").cast("string"))).otherwise(F.col("value_si"))))
    efflux = next((lowered[x] for x in ("measurement_effluxratio", "measurement_efflux_ratio") if x in lowered), None)
    if efflux:
        valued = matrix.inject_ratio_rows(valued, "endpoint", "value_si", efflux)
    fill = 0.0 if settings.fill_missing or settings.dialect == "cli" else None
    wide = matrix.matrix_with_rows(valued.withColumnRenamed(smiles, "smiles"), "smiles", "endpoint", "value_si", names, pk, fill)
    return wide, matrix.unmapped(valued, "endpoint", names), (told.names, told.pk)


def run_matrix(spark: SparkSession, settings: Settings) -> tuple[DataFrame, DataFrame]:
    """The wide matrix of a source; a workbook of human pharmacokinetics comes back as it is."""
    return matrix_and_facts(spark, settings)[:2]


def matrix_and_facts(spark: SparkSession, settings: Settings) -> tuple[DataFrame, DataFrame, tuple[int, bool]]:
    """run_matrix, and (distinct names that a source asks endpoints for, whether any of its records is of pharmacokinetics)."""
    try:
        records = readers.read_records(spark, settings.input_path, base_dir=settings.base_dir, number_rows=False)
    except readers.HumanPkWorkbook as found:
        return found.frame, found.frame.limit(0), (0, True)
    own = readers.read_synonyms(spark, settings.mapping_path) if settings.mapping_path else None
    service = endpoints.named_service(settings.mapper_service) if settings.endpoint_mapper == "llm" and settings.mapper_service else None
    return _wide_matrix(records, settings, own, service, store=settings.answers_path or f"{settings.output_path.rstrip('/')}_answers")


def preprocess_frame(df: DataFrame, task_type: str, task: str | None = None, settings: Settings | None = None, **options) -> DataFrame:
    """Python's way in: one task's records, all of them, by lower-case canonical names; raises where nothing is left."""
    settings = (settings or Settings()).merged({"activity_col": "measurement_value", "smiles_col": "smiles_structure_parent", "dialect": "api", "correct_ph": True} | options)
    records = readers.canonical(df, lower=True, smiles=settings.smiles_col)
    if "row_id" not in records.columns:
        records = numbered(records)
    quality.require_quorum(records, settings.activity_col, task_type, "measurement_relation" if "measurement_relation" in records.columns else None)
    out = prepare_tasks(records, settings, (), task_type, lower=True)
    if out.isEmpty():
        raise ValueError("no record is left")
    return out


def to_wide_matrix(source: DataFrame | str, spark: SparkSession | None = None, settings: Settings | None = None, **options) -> DataFrame:
    """Python's way to the wide matrix, from a frame or a path."""
    settings = (settings or Settings()).merged({"dialect": "api", "activity_col": "measurement_value", "smiles_col": "smiles_structure_parent"} | options)
    spark = spark or SparkSession.active()
    if isinstance(source, DataFrame) and settings.skip_preprocessing:
        return wide_matrix(source, settings)[0]
    return wide_matrix(readers.read_records(spark, source, lower=True, base_dir=settings.base_dir, number_rows=False), settings)[0]


def load_datasets(sources: list[DataFrame], task: str, settings: Settings | None = None) -> DataFrame:
    """smiles and y of one endpoint from several frames, split at random; what follows in training is outside this library."""
    frames = [to_wide_matrix(x, settings=settings) for x in sources]
    both = reduce(lambda a, b: a.unionByName(b), frames)
    return split.random_split(both.select("smiles", F.col(f"`{task}`").alias("y")).filter("y IS NOT NULL"), (), "smiles", 0.2, 0.0)


def rename_for_conversion(df: DataFrame, dialect: str = "api") -> DataFrame:
    """The converter's projection: short names, the endpoint in place of the test, numbers as numbers."""
    #: Columns and their short names.
    short = {"Chemical ID": "compound_id", "SMILES_Structure_Parent": "smiles", "Test": "original_endpoint", "Test_Type": "test_type", "Test_Subject": "species", "Measurement_Type": "measurement_type", "Measurement_Relation": "relation", "Measurement_Value": "value", "Measurement_Unit": "unit"}
    named = cleaning.canonicalise_columns(df)
    kept = named.select(*(F.col(f"`{x}`").alias(short[x]) for x in named.columns if x in short))
    mapped = endpoints.map_endpoints(kept, "original_endpoint", endpoints.match_endpoints(kept, "original_endpoint", dialect))
    return mapped.withColumns({"original_endpoint": F.col("endpoint"), "value": number(F.col("value").cast("string"))}).drop("endpoint")
