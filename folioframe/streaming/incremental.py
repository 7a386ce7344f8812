"""Incremental forms: event logs read as streams, resumable processing, retries."""

from __future__ import annotations

import time
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType


def event_log(spark: SparkSession, folder: str, schema: StructType) -> DataFrame:
    """A folder of JSON lines as a stream of events."""
    return spark.readStream.schema(schema).json(folder)


def upsert_batches(stream: DataFrame, checkpoint: str, apply: Callable[[DataFrame, int], None]):
    """Run ``apply`` once for each new batch; the checkpoint makes a restart go on where it stopped."""
    return stream.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def windowed_counts(stream: DataFrame, at: str, keys: list[str], size: str, late: str) -> DataFrame:
    """Counts by time window, late rows accepted up to the watermark."""
    from pyspark.sql import functions as F

    return stream.withWatermark(at, late).groupBy(F.window(at, size), *keys).count().select("window.start", *keys, "count")


def with_retries(call: Callable, attempts: int = 3, wait: float = 1.0, retry: Callable[[Exception], bool] = lambda e: True, stop: Callable[[Exception], bool] = lambda e: False):
    """Call until it succeeds: waits grow linearly, an error for which ``stop`` holds or ``retry`` doesn't is raised at once."""
    for n in range(1, attempts + 1):
        try:
            return call()
        except Exception as e:
            if stop(e) or not retry(e) or n == attempts:
                raise
            time.sleep(wait * n)
