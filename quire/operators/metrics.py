"""Counters and histograms as tables."""

from __future__ import annotations

import logging
import time
from contextlib import contextmanager

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

log = logging.getLogger(__name__)

# Upper bounds of buckets.
VLM_SECONDS = (0.5, 1.0, 2.0, 5.0, 10.0, 20.0, 30.0, 60.0)
CONFIDENCE = (0.0, 0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9, 1.0)
PIPELINE_SECONDS = (5.0, 10.0, 30.0, 60.0, 120.0, 300.0, 600.0)


def counter(rows: DataFrame, *labels: str, name: str = "n") -> DataFrame:
    return rows.groupBy(*labels).agg(F.count("*").alias(name))


def histogram(rows: DataFrame, value: str, buckets: tuple[float, ...], *labels: str) -> DataFrame:
    """(labels, le, n): how many values are at most each bound, and all of them where le is null; one partial aggregate
    of a column a bucket, so no row is repeated."""
    bounds = [*buckets, None]
    sums = [F.coalesce(F.sum(F.lit(1) if b is None else F.when(F.col(value) <= b, 1).otherwise(0)), F.lit(0)).cast("long").alias(f"b{i}") for i, b in enumerate(bounds)]
    wide = rows.where(F.col(value).isNotNull()).groupBy(*labels).agg(*sums)
    pairs = F.array(*[F.struct(F.lit(b).cast("double").alias("le"), F.col(f"b{i}").alias("n")) for i, b in enumerate(bounds)])
    return wide.select(*labels, F.explode(pairs).alias("x")).select(*labels, "x.le", "x.n")


def write_failures(manifest: DataFrame) -> DataFrame:
    """(sink, n): documents that a sink didn't take."""
    return counter(manifest.where("status <> 'ok'"), "sink")


def dedup_hits(files: DataFrame, stored: DataFrame | None = None, key: str = "content_hash") -> DataFrame:
    """(n): files whose content an earlier file, or the store, has already."""
    per = files.groupBy(key).agg(F.count("*").alias("n"))
    if stored is None:
        return per.agg(F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("n"))
    per = per.join(stored.select(key, F.lit(1).alias("known")).distinct(), key, "left")
    return per.agg(F.coalesce(F.sum(F.col("n") - F.when(F.col("known").isNull(), 1).otherwise(0)), F.lit(0)).alias("n"))


class Timings:
    """Seconds that steps of a run took, as a table (step, seconds)."""

    def __init__(self):
        self.rows: list[tuple[str, float]] = []

    @contextmanager
    def timed(self, step: str):
        began = time.perf_counter()
        try:
            yield
        finally:
            self.rows.append((step, time.perf_counter() - began))
            log.info("%s took %.3f s", *self.rows[-1])

    def table(self, spark) -> DataFrame:
        return spark.createDataFrame(self.rows, "step string, seconds double")
