"""What a task's records are, and whether they suffice, in one aggregation over all tasks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sieveline.functions.cleaning import number, strip_comparator
from sieveline.schema import SENTINEL, VOCABULARY

MIN_ROWS, MIN_CLASS, MIN_UNCENSORED = 50, 25, 25
CENSORED = (">", ">=", "<", "<=")


class TrainingQuorumError(ValueError):
    """No task, or not the one asked for, has enough records to train on."""

    def __init__(self, task_type: str, message: str | None = None):
        needs = f"{MIN_CLASS} records of each class" if task_type == "classification" else f"{MIN_ROWS} records, {MIN_UNCENSORED} of them uncensored"
        super().__init__(message or f"a {task_type} task needs {needs}")
        self.task_type = task_type


def is_censored(value: Column, relation: Column | None = None) -> Column:
    """By the relation, quotes aside, or else by a comparator before the value."""
    if relation is None:
        return value.rlike("^[<>]=?")
    return F.coalesce(F.regexp_replace(F.trim(relation), "^[\"']+|[\"']+$", "").isin(*CENSORED), F.lit(False))


def task_profile(df: DataFrame, keys: Sequence[str], value: str, relation: str | None = None) -> DataFrame:
    """keys, n, n_active, n_inactive, n_censored, n_distinct, task_type, label_kind and has_quorum of each task.

    A task is a classification if a value is missing, starts with a letter or is no number, or if all are 0
    or 1. Partial aggregates go before the shuffle, so large tasks cost no more than small ones.
    """
    text = F.col(value).cast("string")
    x = number(strip_comparator(text))
    counts = df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(text == "active").alias("n_active"),
        F.count_if(text == "inactive").alias("n_inactive"),
        F.count_if(is_censored(text, F.col(relation) if relation else None)).alias("n_censored"),
        F.count_distinct(text).alias("n_distinct"),
        F.bool_or(text.isNull() | text.rlike("^[a-zA-Z]") | (text == SENTINEL) | x.isNull()).alias("_words"),
        F.bool_and(F.coalesce(x.isin(0.0, 1.0), F.lit(False))).alias("_binary"),
    )
    task_type = F.when(F.col("_words") | F.col("_binary"), F.lit("classification")).otherwise(F.lit("regression"))
    label_kind = F.when((F.col("n_distinct") == 2) & F.col("_binary"), F.lit("Binary")).when((F.col("n_distinct") == 2) | (F.col("n_distinct") < F.col("n") / 2), F.lit("Categorical")).otherwise(F.lit("Continuous"))
    typed = counts.withColumns({"task_type": task_type, "label_kind": label_kind}).drop("_words", "_binary")
    classes = (F.col("n_active") >= MIN_CLASS) & (F.col("n_inactive") >= MIN_CLASS)
    numbers = (F.col("n") >= MIN_ROWS) & (F.col("n") - F.col("n_censored") >= MIN_UNCENSORED)
    return typed.withColumn("has_quorum", (F.col("n") >= MIN_ROWS) & F.when(F.col("task_type") == "classification", classes).otherwise(numbers))


def has_numbers(df: DataFrame, keys: Sequence[str], value: str, out: str = "has_numbers") -> DataFrame:
    """keys and whether any value is a plain number, with or without a comparator; one is enough."""
    return df.groupBy(*keys).agg(F.bool_or(F.coalesce(F.col(value).rlike(r"^[<>]?=?\s*\d+\.?\d*$"), F.lit(False))).alias(out))


def with_quorum(df: DataFrame, keys: Sequence[str], value: str, relation: str | None = None) -> DataFrame:
    """The records of tasks that have a quorum, with their task_type; task keys are compared null-safe."""
    good = task_profile(df, keys, value, relation).filter("has_quorum").select(*(F.col(x).alias(f"_k{i}") for i, x in enumerate(keys)), "task_type")
    same = [F.col(x).eqNullSafe(F.col(f"_k{i}")) for i, x in enumerate(keys)]
    return df.join(good, same, "inner").drop(*(f"_k{i}" for i in range(len(keys))))


def require_quorum(df: DataFrame, value: str, task_type: str, relation: str | None = None) -> None:
    """Raise where the records, as one task of the given type, are too few."""
    row = task_profile(df.withColumn("_all", F.lit(1)), ["_all"], value, relation).first()
    enough = row is not None and (min(row.n_active, row.n_inactive) >= MIN_CLASS if task_type == "classification" else row.n >= MIN_ROWS and row.n - row.n_censored >= MIN_UNCENSORED)
    if not enough:
        raise TrainingQuorumError(task_type)


def check_label_kind(kind: str, task_type: str) -> None:
    if task_type == "classification" and kind == "Continuous" or task_type == "regression" and kind in ("Categorical", "Binary"):
        raise ValueError(f"{kind.lower()} labels do not fit a {task_type} task")


def vocabulary_table(spark: SparkSession, vocabulary: dict[str, Sequence[str]] = VOCABULARY) -> DataFrame:
    return spark.createDataFrame([(c, v) for c, values in vocabulary.items() for v in values], "column string, value string")


def vocabulary_violations(df: DataFrame, vocabulary: dict[str, Sequence[str]] = VOCABULARY) -> DataFrame:
    """column, value and n of values outside the vocabulary; the records are read once."""
    columns = [x for x in vocabulary if x in df.columns]
    told = df.select(F.explode(F.array(*(F.struct(F.lit(x).alias("column"), F.col(x).cast("string").alias("value")) for x in columns))).alias("x")).select("x.*")
    counted = told.filter(F.col("value").isNotNull() & (F.col("value") != SENTINEL)).groupBy("column", "value").agg(F.count(F.lit(1)).alias("n"))
    return counted.join(F.broadcast(vocabulary_table(df.sparkSession, vocabulary)), ["column", "value"], "left_anti")
