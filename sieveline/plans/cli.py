"""python -m sieveline.plans.cli --input-path X [--to-matrix] [--split] ...: the command line."""

from __future__ import annotations

import logging
import sys

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from sieveline.plans import pipeline
from sieveline.schema import CONDITION_COLUMNS
from sieveline.session import build_session
from sieveline.sources import config, readers, sinks


def run(spark: SparkSession, settings: config.Settings) -> None:
    if not settings.to_matrix:
        if settings.form == "named":
            base = settings.input_path.rstrip("/").rpartition("/")[2].partition(".")[0]
            out = pipeline.run_tasks(spark, settings).withColumn("task", sinks.task_name(*(F.col(x) for x in CONDITION_COLUMNS), whole=True))
            sinks.write_named(out, settings.output_path, base, by_split=settings.split)
        else:
            sinks.write_tasks(pipeline.run_tasks(spark, settings), settings.output_path, by_split=settings.split, form=settings.form)
        return
    wide, unmapped, facts = pipeline.matrix_and_facts(spark, settings)
    if "endpoint_key" not in unmapped.columns:
        raise readers.HumanPkWorkbook(wide)
    sinks.write_matrix(wide, settings.output_path, settings.activity_col, settings.endpoint_mapper, *facts)
    sinks.write_unmapped(unmapped, f"{settings.output_path}/unmapped", "endpoint_key")


def main(arguments: list[str] | None = None) -> int:
    words = sys.argv[1:] if arguments is None else arguments
    given = config.from_arguments(words)
    path = given.pop("config", None)
    settings = config.Settings().merged(config.from_file(path) if path else {}).merged(given)
    if settings.endpoint_mapper != "manual" and not settings.mapper_service:
        logging.getLogger(__name__).warning("no --mapper-service to ask: endpoints are mapped by the rules")
        settings = settings.merged({"endpoint_mapper": "manual"})
    spark = build_session(scratch=settings.scratch_path or f"{settings.output_path.rstrip('/')}_scratch")
    try:
        run(spark, settings)
    except readers.HumanPkWorkbook as found:
        written = sinks.write_human_pk(found.frame, settings.output_path, settings.input_path)
        logging.getLogger(__name__).warning("human pharmacokinetics have neither tasks nor endpoints: written as they are to %s", written)
    return 0


if __name__ == "__main__":
    sys.exit(main())
