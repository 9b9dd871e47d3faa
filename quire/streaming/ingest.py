"""Documents as a stream: micro-batches with exactly-once ingest by content hash."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quire.operators.stores import TableStore, first_of_content, unseen, write_and_read


def source(spark: SparkSession, folder: str, schema: T.StructType | str, files_per_batch: int = 1) -> DataFrame:
    """New Parquet files of a folder, so many a batch."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(folder)


def start(stream: DataFrame, store: TableStore, checkpoint: str, process: Callable[[DataFrame], DataFrame] | None = None, available_now: bool = True):
    """Ingest a stream of (source_path, content_hash, ...) to a store keyed by content_hash.

    A batch drops what the store has and its own copies, marks the rest as being processed, runs
    ``process`` and puts the outcome in. Sent again after a failure, it finds what it wrote and adds
    nothing twice.
    """

    def batch(rows: DataFrame, number: int) -> None:
        first = write_and_read(first_of_content(rows))
        stored = store.matching(first)  # only the buckets of this batch's keys
        done = None if stored is None else stored.where("processing_status <> 'processing'")
        new = write_and_read(unseen(first, done).withColumn("processing_status", F.lit("processing")))
        if new.isEmpty():
            return
        store.upsert(new)
        outcome = process(new) if process else new.withColumn("processing_status", F.lit("complete"))
        store.upsert(outcome)

    writer = stream.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if available_now else writer).start()


def deduplicated(stream: DataFrame, time: str | None = None, delay: str = "1 hour") -> DataFrame:
    """The first row of each content_hash in a stream; with an event time only within its watermark."""
    if time is None:
        return stream.dropDuplicates(["content_hash"])
    return stream.withWatermark(time, delay).dropDuplicatesWithinWatermark(["content_hash"])


def windowed_counts(events: DataFrame, width: str = "5 minutes", delay: str = "10 minutes", time: str = "ts", label: str = "event_type") -> DataFrame:
    """An extension: counts by event-time window and label, closed by a watermark."""
    stamped = events.withColumn(time, F.col(time).cast("timestamp"))
    return stamped.withWatermark(time, delay).groupBy(F.window(time, width), label).agg(F.count("*").alias("n")).select(F.col("window.start").alias("window_start"), label, "n")
