"""Streams of records: row-local columns run as they are; what needs a whole task runs on each batch."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from sieveline.functions import units
from sieveline.functions.cleaning import clean_text_columns


def clean_stream(stream: DataFrame, value: str, unit: str) -> DataFrame:
    """Plain text and SI values of a stream; no state is kept."""
    return units.convert_column(clean_text_columns(stream), value, unit)


def running_means(stream: DataFrame, entity: str, endpoint: str, value: str, time: str, late: str = "1 hour", window: str = "1 hour") -> DataFrame:
    """Means by entity and endpoint in windows; rows later than the watermark are left out."""
    return stream.withWatermark(time, late).groupBy(F.window(time, window), entity, endpoint).agg(F.avg(value).alias("mean"), F.count(F.lit(1)).alias("n"))


def by_batch(stream: DataFrame, work: Callable[[DataFrame], DataFrame], path: str, checkpoint: str) -> StreamingQuery:
    """Work that needs whole tasks (quorum, scaling, duplicates, splits) on each batch; a batch that is run again replaces its own folder."""

    def write(batch: DataFrame, number: int) -> None:
        work(batch).write.mode("overwrite").parquet(f"{path}/batch={number}")

    return stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).start()
