"""Reciprocal-rank fusion of several retrievers."""

from __future__ import annotations

import logging
from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

K = 60
TOP = 20
log = logging.getLogger(__name__)


def ranked(found: DataFrame, key: str, adapter: str, order: int) -> DataFrame:
    """(chunk_id, rank, adapter, adapter_order) of a list with a rank column from 1."""
    return found.select(F.col(key).alias("chunk_id"), F.col("rank").cast("int").alias("rank"), F.lit(adapter).alias("adapter"), F.lit(order).alias("adapter_order"))


def fuse(lists: list[DataFrame], k: int = K, top: int | None = TOP) -> DataFrame:
    """chunk_id, rrf_score, sources, first_adapter: sums of 1 / (k + rank) over all appearances.

    Ties go to what came first: the first adapter's list, then its rank. The terms are added in that
    order, so the sum doesn't depend on how rows are dealt out. Lists are top-k lists, so this is small;
    rows of chunks are joined to the result, after the limit.
    """
    rows = lists[0]
    for more in lists[1:]:
        rows = rows.unionByName(more)
    seen = F.array_sort(F.collect_list(F.struct("adapter_order", "rank", "adapter")))
    fused = rows.groupBy("chunk_id").agg(seen.alias("seen"))
    score = F.aggregate("seen", F.lit(0.0), lambda acc, x: acc + F.lit(1.0) / (F.lit(float(k)) + x["rank"]))
    fused = fused.select("chunk_id", score.alias("rrf_score"), F.transform("seen", lambda x: x["adapter"]).alias("sources"), F.col("seen")[0].alias("first"))
    ordered = fused.orderBy(F.col("rrf_score").desc(), "first.adapter_order", "first.rank", "chunk_id")
    ordered = ordered if top is None else ordered.limit(top)
    return ordered.select("chunk_id", "rrf_score", "sources", F.col("first.adapter").alias("first_adapter"))


def search(adapters: dict[str, Callable[[], DataFrame]], include: Iterable[str] | None = None, k: int = K, top: int = TOP, key: str = "chunk_id") -> DataFrame | None:
    """Ask the adapters (all, or those that ``include`` names; an empty list means all) and fuse their lists.

    An adapter that fails is logged and left out; its list is run to find out, and held for the fusion.
    """
    wanted = set(include or adapters)
    lists = []
    for order, (name, call) in enumerate(adapters.items()):
        if name not in wanted:
            continue
        try:
            found = ranked(call(), key, name, order)
            rows = found.limit(top).collect()  # at most ``top`` rows
            lists.append(found.sparkSession.createDataFrame(rows, found.schema))
        except Exception:  # noqa: BLE001
            log.exception("adapter %s failed and is left out", name)
    return fuse(lists, k, top) if lists else None


def with_chunks(fused: DataFrame, chunks: DataFrame, key: str = "chunk_id") -> DataFrame:
    """The fused rows with their chunks; the fused side is at most ``top`` rows."""
    return chunks.join(F.broadcast(fused), key)
