"""Results as folders of Parquet by task and split, or as CSV for other tools."""

from __future__ import annotations

import json
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sieveline.schema import SENTINEL
from sieveline.session import delete, file_system


def task_name(*columns: Column, whole: bool = False) -> Column:
    """A task's name as part of a path: its conditions but for those not specified (whole: all of them), without special signs."""
    parts = [F.coalesce(x, F.lit(SENTINEL)) if whole else F.when(x != SENTINEL, x) for x in columns]
    return F.regexp_replace(F.concat_ws("_", *parts), r"[^\w.-]", "_")


def write_tasks(df: DataFrame, path: str, task: str = "task", by_split: bool = False, form: str = "parquet") -> None:
    """One folder per task, and in it, if asked, one per split; empty ones don't come up."""
    by = [task, "split"] if by_split else [task]
    # rows of a task stay together, so that it is written by few files; a large one is split over several tasks
    writer = df.hint("rebalance", *by).write.mode("overwrite").partitionBy(*by)
    (writer.option("header", True).csv if form == "csv" else writer.parquet)(path)


MANIFEST, STAGING = "named-files.manifest", "_named-parts"


def write_named(df: DataFrame, path: str, base: str, task: str = "task", by_split: bool = False) -> list[str]:
    """CSV files by name: path/{base}_{task}_processed.csv, and if asked also path/splits/{base}_{task}_{split}.csv; their names.

    Parts are written under a folder of their own and then renamed by a manifest, which is written first: should the driver be lost
    in between, finish_named (or the next call) completes what was begun. A task that is large enough for several parts has them numbered:
    {name}.0001.csv and so on. Columns named task and split stand in the names alone. What is listed on the driver are files.
    """
    spark = df.sparkSession
    finish_named(spark, path)
    parts = f"{path}/{STAGING}"
    kinds = {"all": [task]} | ({"splits": [task, "split"]} if by_split else {})
    for kind, by in kinds.items():
        kept = df.drop("split") if kind == "all" else df
        kept.hint("rebalance", *by).write.mode("overwrite").option("header", True).partitionBy(*by).csv(f"{parts}/{kind}")
    moves: dict[str, list[str]] = {}
    for kind, by in kinds.items():
        for file in _files(spark, f"{parts}/{kind}"):
            held = [unquote(x.partition("=")[2]) for x in file.removeprefix(f"{parts}/{kind}").split("/") if "=" in x]
            name = f"{base}_{held[0]}_processed" if kind == "all" else f"splits/{base}_{held[0]}_{held[1]}"
            moves.setdefault(name, []).append(file)
    told = [[x, f"{path}/{name}.csv" if len(files) == 1 else f"{path}/{name}.{k + 1:04d}.csv"] for name, files in sorted(moves.items()) for k, x in enumerate(sorted(files))]
    where, files = file_system(spark, f"{path}/{MANIFEST}.part")
    out = files.create(where, True)
    out.write(bytearray(json.dumps(told).encode()))
    out.close()
    files.rename(where, file_system(spark, f"{path}/{MANIFEST}")[0])
    finish_named(spark, path)
    return [x for _, x in told]


def finish_named(spark: SparkSession, path: str) -> bool:
    """Complete a half-done write_named, if there is one: parts that are still in their folder are renamed; whether there was one."""
    where, files = file_system(spark, f"{path}/{MANIFEST}")
    found = files.exists(where)
    if found:
        text = "".join(x.value for x in spark.read.text(f"{path}/{MANIFEST}", wholetext=True).collect())
        for source, target in json.loads(text):
            part, name = file_system(spark, source)[0], file_system(spark, target)[0]
            if files.exists(part):
                files.mkdirs(name.getParent())
                files.delete(name, False)
                if not files.rename(part, name):
                    raise OSError(f"{source} could not be renamed to {target}")
    delete(spark, f"{path}/{STAGING}")  # without a manifest these parts are of a write that didn't end
    delete(spark, f"{path}/{MANIFEST}")
    return found


def _files(spark: SparkSession, path: str) -> list[str]:
    """The data files under a path, as their names begin with it."""
    where, files = file_system(spark, path)
    found, listed = [], files.listFiles(where, True)
    root = files.makeQualified(where).toString()
    while listed.hasNext():
        file = listed.next().getPath()
        if file.getName().startswith("part-"):
            found.append(path + file.toString().removeprefix(root))
    return found


def _write_text(spark: SparkSession, path: str, text: str) -> None:
    spark.createDataFrame([(text,)], "value string").coalesce(1).write.mode("overwrite").text(path)


def write_matrix(df: DataFrame, path: str, value: str, mapper: str, n_mapped: int, has_pk: bool, form: str = "csv") -> dict:
    """The wide matrix under path/matrix, and what it is as JSON under path/metadata."""
    writer = df.write.mode("overwrite")
    (writer.option("header", True).csv if form == "csv" else writer.parquet)(f"{path}/matrix")
    spark = df.sparkSession
    written = spark.read.option("header", True).csv(f"{path}/matrix") if form == "csv" else spark.read.parquet(f"{path}/matrix")
    told = {"rows": written.count(), "columns": len(df.columns), "has_pk": has_pk, "value_column": value, "endpoint_map_size": n_mapped, "mapper": mapper}
    _write_text(spark, f"{path}/metadata", json.dumps(told))
    return told


def write_human_pk(df: DataFrame, path: str, source: str) -> str:
    """A table of human pharmacokinetics as it is, as CSV in a folder named after its source."""
    name = source.rstrip("/").rpartition("/")[2].rpartition(".")[0]
    out = f"{path}/{name}_HumanPK"
    df.write.mode("overwrite").option("header", True).csv(out)
    return out


def write_unmapped(df: DataFrame, path: str, name: str, k: int = 20) -> list[tuple[str, int]]:
    """Records without an endpoint as CSV, and the most frequent of their names."""
    df.write.mode("overwrite").option("header", True).csv(path)
    top = df.groupBy(name).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), name).limit(k)
    return [(x[0], x.n) for x in top.collect()]
