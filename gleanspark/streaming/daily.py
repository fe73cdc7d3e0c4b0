"""Structured Streaming over new sample tables: each micro-batch is a date's plan. An extension; the batch plan is the same."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from gleanspark.operators.scoring import Config
from gleanspark.plans.audit import plan
from gleanspark.sources.audit import SAMPLE_SCHEMA


def stream_samples(spark: SparkSession, folder: str, checkpoint: str, write: Callable[[str, DataFrame, int], None], config: Config = Config()):
    """Runs the plan over every Parquet file of samples that arrives in ``folder`` and hands each output to ``write(name, rows, batch)``; ends when none is left."""

    def each(batch: DataFrame, number: int) -> None:
        for name, rows in plan(batch, config).items():
            if name != "done":
                write(name, rows, number)

    arrived = spark.readStream.schema(f"{SAMPLE_SCHEMA}, reason string").parquet(folder)
    return arrived.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
