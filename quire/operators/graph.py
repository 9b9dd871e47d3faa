"""The property graph as node and edge tables, and traversals as joins."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

UNKNOWN = "UNKNOWN"


def next_chunk(chunks: DataFrame, key: str = "document_id", order: str = "reading_order_index", node: str = "chunk_id") -> DataFrame:
    """(from_id, to_id) between consecutive chunks of a document."""
    follows = F.lead(node).over(Window.partitionBy(key).orderBy(order, node))
    return chunks.select(F.col(node).alias("from_id"), follows.alias("to_id")).where(F.col("to_id").isNotNull())


def mentions(chunks: DataFrame, unique: bool = False) -> DataFrame:
    """(chunk_id, text, type), once for each chunk and entity; entities without text are skipped. ``unique``: no
    two rows share a chunk_id, so a row's mentions are distinct among themselves and needn't meet others."""
    named = F.transform("entities", lambda e: F.struct(e["text"].alias("text"), F.coalesce(e["type"], F.lit(UNKNOWN)).alias("type")))
    found = chunks.select("chunk_id", F.explode(F.array_distinct(named)).alias("e"))
    told = found.select("chunk_id", "e.text", "e.type").where(F.coalesce(F.col("text"), F.lit("")) != "")
    return told if unique else told.distinct()


def entities(mentions_: DataFrame) -> DataFrame:
    """(text, type, n_chunks): the entity nodes."""
    return mentions_.groupBy("text", "type").agg(F.count("*").alias("n_chunks"))


def has_chunk(chunks: DataFrame) -> DataFrame:
    return chunks.select("document_id", "chunk_id").distinct()


def has_region(regions: DataFrame) -> DataFrame:
    return regions.select("document_id", "region_id").distinct()


def table_rows(chunks: DataFrame) -> DataFrame:
    """(chunk_id, row_index, values): keyed by chunk and number, so writing again adds nothing."""
    rows = chunks.where(F.col("content_type") == "table").select("chunk_id", F.posexplode("table_data.rows").alias("row_index", "cells"))
    return rows.select("chunk_id", "row_index", F.to_json("cells").alias("values"))


def entity_chunks(mentions_: DataFrame, text: str, kind: str | None = None, depth: int = 1) -> DataFrame:
    """(chunk_id) reached from an entity over at most ``depth`` mention edges in either direction, no edge
    twice. The graph has two sides, so chunks lie at odd distances: each two further edges add the chunks
    that share an entity with those found. Each step joins the new chunks only."""
    from quire.operators.stores import write_and_read

    start = mentions_.where(F.col("text") == text)
    if kind is not None:
        start = start.where(F.col("type") == kind)
    found = front = write_and_read(start.select("chunk_id").distinct())
    used = start.select("text", "type").distinct()
    for _ in range(3, depth + 1, 2):
        # Each step is written, so the next one's plan starts from tables.
        new = write_and_read(mentions_.join(front, "chunk_id", "left_semi").select("text", "type").distinct().join(used, ["text", "type"], "left_anti"))
        front = write_and_read(mentions_.join(new, ["text", "type"], "left_semi").select("chunk_id").distinct().join(found, "chunk_id", "left_anti"))
        found, used = found.unionByName(front), used.unionByName(new)
    return found


def entity_documents(mentions_: DataFrame, chunks: DataFrame, documents: DataFrame, text: str) -> DataFrame:
    """(document_id, source_path, n_chunks) of the documents that mention an entity."""
    hits = mentions_.where(F.col("text") == text).select("chunk_id").distinct()
    by_doc = chunks.join(hits, "chunk_id", "left_semi").groupBy("document_id").agg(F.count("*").alias("n_chunks"))
    return documents.join(by_doc, "document_id").select("document_id", "source_path", "n_chunks")


def chain_heads(edges: DataFrame, nodes: DataFrame, node: str = "chunk_id") -> DataFrame:
    """Nodes that no edge leads to."""
    return nodes.join(edges.select(F.col("to_id").alias(node)), node, "left_anti")


def chain_order(chunks: DataFrame, key: str = "document_id", order: str = "reading_order_index", node: str = "chunk_id") -> DataFrame:
    """(key, node, position) along each document's chain from its head: the sort that made the edges."""
    return chunks.select(key, node, (F.row_number().over(Window.partitionBy(key).orderBy(order, node)) - 1).alias("position"))
