"""Connected components of a link table, by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quire.llm.common import drop_folder, materialize, recording

MAX_ROUNDS = 60


def _star(links: DataFrame) -> DataFrame:
    """For links (hub, leaf): each leaf to the least of hub and its leaves."""
    # Written first: the join below may then split a hub that has very many leaves.
    least = materialize(links.groupBy("hub").agg(F.least("hub", F.min("leaf")).alias("m")), "least")
    return links.join(least, "hub").select("hub", "leaf", "m")


def _state(links: DataFrame) -> tuple:
    row = links.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
    return tuple(row)


def components(links: DataFrame) -> DataFrame:
    """(node, component) for each node of ``links`` (a, b); the component is its least node.

    Each round is two aggregations and joins over the links, which shrink to one link a node;
    rounds grow with the logarithm of the number of nodes. Each is written to the shared folder.
    """
    spark = links.sparkSession
    with recording() as last:
        links = materialize(links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links")
    state = _state(links)
    for _ in range(MAX_ROUNDS):
        if not state[0]:
            break
        with recording() as made:
            both = links.select(F.col("a").alias("hub"), F.col("b").alias("leaf")).union(links.select(F.col("b").alias("hub"), F.col("a").alias("leaf")))
            large = materialize(_star(both).where("leaf > hub").select(F.col("leaf").alias("hub"), F.col("m").alias("leaf")).distinct(), "links")
            small = _star(large)
            moved = small.select(F.col("leaf").alias("a"), F.col("m").alias("b")).union(small.select(F.col("hub").alias("a"), F.col("m").alias("b")))
            links = materialize(moved.where("a <> b").distinct(), "links")
        for path in [*last, *made[:-1]]:  # only the newest links are read from here on
            drop_folder(spark, path)
        last = made[-1:]
        before, state = state, _state(links)
        if state == before:
            break
    else:
        raise RuntimeError("components did not settle")
    return links.select(F.col("a").alias("node"), F.col("b").alias("component")).union(links.select(F.col("b").alias("node"), F.col("b").alias("component"))).distinct()
