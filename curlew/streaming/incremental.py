"""Incremental ingestion: new files of JSON lines run through the build loop's step, one micro-batch at a time.

The store is keyed by id and upserts replace rows, so a batch that is replayed after a failure changes nothing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from curlew.plans.pipeline import Pipeline


def ingest_stream(pipeline: Pipeline, folder: str, checkpoint: str, max_files: int = 100):
    """A query that watches `folder`; reports of its batches are in `pipeline.reports`."""
    pipeline.reports = []
    lines = pipeline.spark.readStream.option("maxFilesPerTrigger", max_files).text(folder)

    def step(batch: DataFrame, number: int) -> None:
        rows = batch.filter(F.trim("value") != "").select(F.col("value").alias("raw"), (F.monotonically_increasing_id() + F.lit(number).cast("long") * (1 << 40)).alias("seq"))
        if not rows.isEmpty():
            pipeline.reports.append(pipeline.step(rows))

    return lines.writeStream.foreachBatch(step).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
