"""The streaming job: a folder of device uploads into the event marts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..sources.uploads import stream_uploads, upload_rows
from .marts import EventMarts


def start(
    spark: SparkSession,
    folder: str,
    checkpoint: str,
    marts: EventMarts,
    max_files: int = 1000,
    name: str = "uploads",
) -> StreamingQuery:
    """Process everything that has arrived, in micro-batches, then stop; schedule it or call it
    again for what comes later. Files are tracked by the checkpoint, so an upload is never skipped
    for being old, and a replayed micro-batch is recognised by its number."""

    def land(batch: DataFrame, epoch: int) -> None:
        marts.run(upload_rows(batch), note=f"{name} {epoch}")

    return (
        stream_uploads(spark, folder, max_files)
        .writeStream.foreachBatch(land)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def thin_copies(copies: DataFrame, horizon: str = "3 days") -> DataFrame:
    """Optional filter before landing, with state bounded by the horizon: drops copies of an event
    seen within it. It forgets, so the marts' own de-duplication stays the authority; and it keeps
    whichever copy it sees first, so use it only where copies of an event are identical."""
    timed = copies.withColumn("__at", F.col("received_at").cast("timestamp"))
    return timed.withWatermark("__at", horizon).dropDuplicatesWithinWatermark(["event_id"]).drop("__at")
