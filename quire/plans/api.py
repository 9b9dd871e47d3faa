"""Retrieval over stored tables with pages and cursors, the calls an application makes."""

from __future__ import annotations

from dataclasses import dataclass
from typing import Any

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quire.operators import fusion, graph, retrieval
from quire.operators.retrieval import LIMIT, Page
from quire.providers import HashEmbedder
from quire.schema import adapt_chunks

TOP = 20


@dataclass
class Retrieval:
    """Chunks (any supported schema version), their vectors (chunk_id, vector, payload) and mentions.

    Tables that are None are taken to be empty; mentions default to the chunks' entities.
    """

    chunks: DataFrame
    vectors: DataFrame | None = None
    mentions: DataFrame | None = None
    embedder: Any = None

    def __post_init__(self):
        if "schema_version" in self.chunks.columns:
            self.chunks = adapt_chunks(self.chunks)
        self.embedder = self.embedder or HashEmbedder()
        if self.mentions is None and "entities" in self.chunks.columns:
            self.mentions = graph.mentions(self.chunks)

    def structured(self, sql_filter: str | None = None, jsonpath: str | None = None, content_types: list[str] | None = None, document_id: str | None = None, min_confidence: float | None = None, limit: int = LIMIT, cursor: str | None = None, count: bool = False) -> Page:
        """Column filters, a JSON path into structured_data and a SQL condition; keyset pages by chunk_id."""
        found = retrieval.structured(self.chunks, sql_filter, jsonpath, content_types, document_id, min_confidence)
        return retrieval.keyset_page(found, "chunk_id", limit, cursor, count)

    def documents(self, filters: dict[str, Any] | None = None, full_text: str | None = None, content_types: list[str] | None = None, document_id: str | None = None, min_confidence: float | None = None, limit: int = LIMIT, cursor: str | None = None, count: bool = False) -> Page:
        """A filter document and full text over overviews; keyset pages by chunk_id."""
        found = retrieval.documents_query(self.chunks, filters, full_text, content_types, document_id, min_confidence)
        return retrieval.keyset_page(found, "chunk_id", limit, cursor, count)

    def _scored(self, query_text: str, metadata_filter, content_types, document_id, min_score) -> DataFrame:
        tests = retrieval.metadata_tests(metadata_filter) + retrieval.common_filters(content_types, document_id)
        return retrieval.vector_scores(self.vectors, self.embedder.embed(query_text), min_score=min_score, tests=tests)

    def vector(self, query_text: str, metadata_filter: dict[str, Any] | None = None, content_types: list[str] | None = None, document_id: str | None = None, min_score: float | None = None, limit: int = TOP, cursor: str | None = None, count: bool = False) -> Page:
        """Nearest payloads by cosine; pages by offset."""
        found = retrieval.partial_chunks(self._scored(query_text, metadata_filter, content_types, document_id, min_score))
        return retrieval.offset_page(found, [F.col("similarity_score").desc(), "chunk_id"], limit, cursor, count)

    def graph(self, start_entity: str | None = None, entity_type: str | None = None, depth: int = 1, sql: str | None = None, document_id: str | None = None, limit: int = LIMIT, cursor: str | None = None) -> Page:
        """Chunks from an entity, by SQL over the views chunks and mentions, or all; in reading order."""
        return retrieval.traverse_page(retrieval.traverse(self.chunks, self.mentions, start_entity, entity_type, depth, document_id, sql), limit, cursor)

    def adapters(self, query_text: str, top_k: int = TOP, metadata_filter: dict[str, Any] | None = None) -> dict:
        """Ranked lists by text, by vector, and by the entities that the query names."""
        by_id = lambda order: F.row_number().over(Window.orderBy(*order))  # noqa: E731  over top_k rows

        def text():
            rows = retrieval.keep(self.chunks, retrieval.metadata_tests(metadata_filter))
            return retrieval.fulltext_rank(rows, query_text, "chunk_id", "overview", top_k)

        def vector():
            order = [F.col("similarity_score").desc(), "chunk_id"]
            best = self._scored(query_text, metadata_filter, None, None, None).orderBy(*order).limit(top_k)
            return best.withColumn("rank", by_id(order))

        def entities():
            named = self.mentions.where(F.contains(F.lit(query_text.lower()), F.lower("text")))
            hits = named.groupBy("chunk_id").agg(F.count("*").alias("n"))
            if metadata_filter:
                hits = hits.join(retrieval.keep(self.chunks, retrieval.metadata_tests(metadata_filter)), "chunk_id", "left_semi")
            order = [F.col("n").desc(), "chunk_id"]
            return hits.orderBy(*order).limit(top_k).withColumn("rank", by_id(order))

        found = {"text": text}
        if self.vectors is not None:
            found["vector"] = vector
        if self.mentions is not None:
            found["graph"] = entities
        return found

    def fused(self, query_text: str, top_k: int = TOP, metadata_filter: dict[str, Any] | None = None, include_adapters: list[str] | None = None, rrf_k: int = fusion.K) -> Page:
        """Reciprocal-rank fusion of the adapters, with the chunks; a single page."""
        fused = fusion.search(self.adapters(query_text, top_k, metadata_filter), include_adapters, rrf_k, top_k)
        if fused is None:
            return Page([], None, 0)
        rows = fusion.with_chunks(fused, self.chunks).collect()
        order = {r.chunk_id: i for i, r in enumerate(fused.select("chunk_id").collect())}
        return Page(sorted(rows, key=lambda r: order[r.chunk_id]), None, len(rows))
