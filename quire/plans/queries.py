"""One query for each operator, over the whole tables of a data folder."""

from __future__ import annotations

import functools
import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quire.functions.jsonpath import json_contains, path_exists

from quire.operators import chunking, extraction, fusion, graph, layout, metrics, retrieval, stores, tables, validation
from quire.plans.engine import PROMPTS, Pipeline
from quire.schema import ENTITY, ExtractionSchema, adapt_chunks
from quire.session import shared_folder
from quire.providers import HashEmbedder
from quire.sources import mail, routing, sheets
from quire.sources.text import csv_text, html_text, paginate

SUFFIXES = (".pdf", ".DOCX", ".doc", ".jpeg", ".txt", ".html", ".csv", ".md", ".xlsx", ".eml", ".json", "")
PAGE_AREA = 595.0 * 842.0
QUERY_TEXT = "the license of that idiot clown"
ENTITY_TEXT = "Eriner"
KINDS = ("text", "table", "figure", "formula")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents")


def as_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select(F.col("doc_id").alias("document_id"), "text")
    return paginate(docs)


def _kind(key: Column) -> Column:
    return F.element_at(F.array(*map(F.lit, KINDS)), (key % len(KINDS) + 1).cast("int"))


def as_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as chunks: the source is the document, the quality label the confidence."""
    labels = table(spark, sf_dir, "labels").groupBy("doc_id").agg(F.max("quality").alias("quality"))
    docs = documents(spark, sf_dir).join(labels, "doc_id", "left")
    return docs.select(
        F.format_string("%012d", "doc_id").alias("chunk_id"), "doc_id", F.col("source").alias("document_id"), _kind(F.col("doc_id")).alias("content_type"), F.col("text").alias("overview"),
        F.coalesce(F.col("quality").cast("double"), F.lit(0.5)).alias("confidence_score"), F.to_json(F.struct("lang", "n_chars")).alias("structured_data"), F.col("doc_id").alias("reading_order_index"),
    )


def as_mentions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Entities by rule: capitalised ASCII words of five letters or more, those of nine or more as organisations."""
    words = F.regexp_extract_all("text", F.lit("[A-Z][a-z]{4,}"), F.lit(0))
    entity = lambda w: F.struct(w.alias("text"), F.when(F.length(w) > 8, "ORG").otherwise("PERSON").alias("type"), w.alias("value")).cast(ENTITY)
    chunks = documents(spark, sf_dir).select(F.col("doc_id").alias("chunk_id"), F.transform(F.array_distinct(words), entity).alias("entities"))
    return graph.mentions(chunks)


def query_vector(spark: SparkSession, sf_dir: str) -> list[float]:
    return [float(x) for x in table(spark, sf_dir, "embeddings").where("vec_id = 0").select("embedding").first()[0]]


def as_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "embeddings").withColumnRenamed("embedding", "vector")


# Sources ---------------------------------------------------------------------------------------


def doc_content_hash(spark, sf_dir):
    return documents(spark, sf_dir).select("doc_id", routing.content_hash(F.col("text")).alias("content_hash"))


def doc_dedup_survivors(spark, sf_dir):
    hashed = documents(spark, sf_dir).select("doc_id", routing.content_hash(F.col("text")).alias("content_hash"))
    return stores.first_of_content(hashed, "doc_id")


def doc_unseen(spark, sf_dir):
    hashed = documents(spark, sf_dir).select("doc_id", routing.content_hash(F.col("text")).alias("content_hash"))
    return stores.unseen(hashed, hashed.where("doc_id % 2 = 0"))


def route_formats(spark, sf_dir):
    name = F.concat(F.lit("in/doc_"), F.col("doc_id").cast("string"), F.element_at(F.array(*map(F.lit, SUFFIXES)), (F.col("doc_id") % len(SUFFIXES) + 1).cast("int")))
    paths = documents(spark, sf_dir).select("doc_id", name.alias("path"))
    return paths.select("doc_id", routing.reader(F.col("path")).alias("reader"), routing.format_label(F.col("path")).alias("format"))


def text_paginate(spark, sf_dir):
    return as_pages(spark, sf_dir)


def quality_tier(spark, sf_dir):
    tiers = routing.quality_tier(as_pages(spark, sf_dir), F.lit(PAGE_AREA))
    return tiers.select("document_id", F.round("density", 9).alias("density"), "quality_tier")


def scanned_pages(spark, sf_dir):
    return as_pages(spark, sf_dir).select("document_id", "page_number", layout.is_scanned(F.col("native_text")).alias("is_scanned"))


def html_strip(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", html_text(F.col("html")).alias("text"))


def html_strip_visible(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", html_text(F.col("html"), visible=True).alias("text"))


def csv_to_text(spark, sf_dir):
    quoted = F.concat(F.lit('"'), F.replace(F.col("text"), F.lit('"'), F.lit('""')), F.lit('"'))
    content = F.concat(F.lit("id,lang,text\n"), F.concat_ws(",", F.col("doc_id").cast("string"), "lang", quoted), F.lit("\n"))
    return documents(spark, sf_dir).select("doc_id", csv_text(content).alias("text"))


def mail_pages(spark, sf_dir):
    head = F.concat(F.lit("Subject: Document "), F.col("doc_id").cast("string"), F.lit("\nFrom: "), F.col("source"), F.lit("@example.org\nDate: Mon, 1 Jan 2024 00:00:00 +0000\nContent-Type: text/plain; charset=utf-8\nContent-Transfer-Encoding: 8bit\n\n"))
    files = documents(spark, sf_dir).select(F.col("doc_id").cast("string").alias("source_path"), F.concat(head, "text").cast("binary").alias("content"))
    pages = mail.mail_pages(files)
    return pages.select("source_path", "page_number", "native_text", F.col("metadata")["subject"].alias("subject"), F.col("metadata")["from"].alias("sender"))


# Layout ----------------------------------------------------------------------------------------


def virtual_regions(spark, sf_dir):
    regions = layout.virtual_regions(as_pages(spark, sf_dir))
    return regions.select("document_id", "page_number", "region_index", "region_type", "text", F.col("bbox.y0").alias("y0"), F.col("bbox.y1").alias("y1"))


def bbox_derived(spark, sf_dir):
    box = F.col("bbox")
    measures = {k: F.round(v, 6).alias(k) for k, v in layout.box_measures(box).items()}
    return layout.virtual_regions(as_pages(spark, sf_dir)).select("document_id", "page_number", "region_index", *measures.values())


def crop_box_path(spark, sf_dir):
    regions = layout.virtual_regions(as_pages(spark, sf_dir))
    box = layout.crop_box(F.col("bbox"))
    path = layout.crop_path(F.lit("crops"), F.col("document_id").cast("string"), F.col("page_number"), F.col("region_index"), F.col("region_type"))
    return regions.select("document_id", "page_number", "region_index", *[box[c].alias(c) for c in ("x0", "y0", "x1", "y1")], path.alias("path"))


def xy_cut_order(spark, sf_dir):
    """Every order as a page: its lines as boxes in two columns, with gaps that depend on the data."""
    n, q = F.col("l_linenumber"), F.col("l_quantity")
    x0 = F.when(n % 2 == 0, 100.0).otherwise(1300.0)
    y0 = 100.0 + 150.0 * n + q
    box = layout.bbox(x0, y0, x0 + 900.0 + q * 4, y0 + 60.0 + F.col("l_discount") * 900)
    lines = table(spark, sf_dir, "lineitem").groupBy("l_orderkey", "l_linenumber").agg(F.max("l_quantity").alias("l_quantity"), F.max("l_discount").alias("l_discount"))
    regions = lines.select(F.col("l_orderkey").alias("document_id"), F.lit(1).alias("page_number"), n.alias("region_index"), n.alias("line"), box.alias("bbox"))
    return layout.xy_cut_order(regions).select("document_id", "line", "region_index")


def detector_classes(spark, sf_dir):
    return table(spark, sf_dir, "part").select("p_partkey", layout.region_type(F.col("p_size") % 13).alias("region_type"))


def resolution_guard(spark, sf_dir):
    height = F.col("p_size") * 60
    return table(spark, sf_dir, "part").select("p_partkey", F.round(layout.estimated_dpi(height), 6).alias("dpi"), layout.upscale_factor(height).alias("factor"))


def skew_angle(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").select(F.col("l_suppkey").alias("page_id"), (F.col("l_quantity") - 25.5).alias("angle"))
    return layout.skew_angle(lines)


# Chunks ----------------------------------------------------------------------------------------


def _chunks(spark, sf_dir):
    regions = layout.virtual_regions(as_pages(spark, sf_dir)).withColumn("cropped_image_path", F.concat_ws("/", "page_number", "region_index"))
    return chunking.chunk_regions(regions)


def chunk_merge(spark, sf_dir):
    return _chunks(spark, sf_dir).select("document_id", "page_number", "chunk_index", "content_type", "raw_text", F.size("region_indexes").alias("n_regions"), "cropped_image_path")


def caption_attach(spark, sf_dir):
    kind = F.when(F.col("role") == "user", "figure").when(F.col("role") == "assistant", "caption").otherwise("text")
    items = table(spark, sf_dir, "conversations").select("conv_id", "turn", kind.alias("region_type"), "text")
    return chunking.attach_captions(items, ["conv_id"], "turn")


def page_break_bridge(spark, sf_dir):
    pages = as_pages(spark, sf_dir).select("document_id", "page_number", F.concat_ws("-", "document_id", "page_number").alias("chunk_id"), F.col("native_text").alias("raw_text"), F.lit("text").alias("content_type"), F.lit(False).alias("metadata_only"), F.col("page_number").alias("reading_order_index"))
    return chunking.page_break_context(pages)


# Tables ----------------------------------------------------------------------------------------


def _parsed(spark, sf_dir):
    piped = documents(spark, sf_dir).where(F.contains("text", F.lit("|")))
    return piped.select("doc_id", tables.parse_markdown(F.col("text")).alias("t"))


def md_table_parse(spark, sf_dir):
    return _parsed(spark, sf_dir).select("doc_id", F.array_join("t.headers", "␟").alias("headers"), F.size("t.rows").alias("n_rows"), F.array_join(F.flatten("t.rows"), "␟").alias("cells"))


def md_table_cells(spark, sf_dir):
    cells = _parsed(spark, sf_dir).select("doc_id", F.explode(tables.build_cells(F.col("t.headers"), F.col("t.rows"))).alias("c"))
    return cells.select("doc_id", "c.row", "c.col", "c.value", "c.is_header")


def md_table_build(spark, sf_dir):
    return _parsed(spark, sf_dir).select("doc_id", tables.build_markdown(F.col("t.headers"), F.col("t.rows")).alias("markdown"))


def figure_reclassify(spark, sf_dir):
    return documents(spark, sf_dir).select("doc_id", tables.looks_like_table(F.col("text")).alias("is_table"))


def _turn_tables(spark, sf_dir):
    kind = F.when(F.col("role") == "system", "text").otherwise("table")
    return table(spark, sf_dir, "conversations").select(
        F.col("conv_id").alias("document_id"), F.col("turn").alias("page_number"), F.lit(0).alias("reading_order_index"), kind.alias("content_type"), F.concat_ws("-", "conv_id", "turn").alias("chunk_id"),
        tables.ending(F.lit(None).cast("array<array<string>>"), F.lit(None).cast("string"), F.col("text")).alias("ending"),
    )


def table_continuation(spark, sf_dir):
    found = tables.continuations(_turn_tables(spark, sf_dir))
    return found.select("document_id", "page_number", "is_continuation", "continuation_confidence")


def table_merge(spark, sf_dir):
    found = tables.continuations(_turn_tables(spark, sf_dir)).where("content_type = 'table'")
    parts = found.withColumns({"headers": F.array(F.lit("ending")), "rows": F.array(F.array("chunk_id"))})
    merged = tables.merge_continued(parts)
    return merged.select("chunk_id", "page_number", F.array_join(F.flatten("rows"), ",").alias("rows"), F.coalesce("continued_from_page", F.lit(-1)).alias("continued_from_page"), F.coalesce("merge_confidence", F.lit(0.0)).alias("merge_confidence"))


def table_cell_match(spark, sf_dir):
    parsed = _parsed(spark, sf_dir)
    chunks = parsed.select("doc_id", F.struct(tables.build_cells(F.col("t.headers"), F.col("t.rows")).alias("cells")).alias("table_data"))
    return retrieval.cell_match(chunks, {"row": {"$gte": 1}, "value": {"$gt": "m"}}).select("doc_id")


# Extraction and validation ---------------------------------------------------------------------


def prompt_build(spark, sf_dir):
    asked = ExtractionSchema(fields={"total": "the sum"})
    kind = F.when(F.col("doc_id") % 5 == 4, "unknown").otherwise(_kind(F.col("doc_id")))
    return documents(spark, sf_dir).select("doc_id", extraction.prompt(kind, PROMPTS, "Be exact.", asked).alias("prompt"))


def _answers(spark, sf_dir):
    body = F.to_json(F.struct(F.col("text").alias("text"), F.col("lang").alias("language"), F.col("source").alias("overview"), F.lit("1").alias("confidence")))
    shape = F.col("doc_id") % 4
    answer = F.when(shape == 0, body).when(shape == 1, F.concat(F.lit("```json\n"), body, F.lit("\n```"))).when(shape == 2, "[1]").otherwise("oops")
    return documents(spark, sf_dir).select("doc_id", answer.alias("answer"))


def answer_parse(spark, sf_dir):
    parsed = extraction.parse_answer(F.col("answer"))
    return _answers(spark, sf_dir).select("doc_id", parsed.alias("a"), extraction.structured_data(F.col("answer")).alias("structured_data")).select("doc_id", F.coalesce("a.text", "a.raw_text").alias("raw_text"), "a.overview", F.get_json_object("structured_data", "$.language").alias("language"))


def completion_content(spark, sf_dir):
    body = F.to_json(F.struct(F.array(F.struct(F.struct(F.col("text").alias("content")).alias("message"))).alias("choices")))
    response = F.when(F.col("doc_id") % 3 == 0, F.lit("{}")).otherwise(body)
    return documents(spark, sf_dir).select("doc_id", extraction.answer_text(response).alias("content"))


def validate_rules(spark, sf_dir):
    labels = table(spark, sf_dir, "labels").groupBy("doc_id").agg(F.max("quality").alias("quality"))
    docs = documents(spark, sf_dir).join(labels, "doc_id", "left")
    kind = _kind(F.col("doc_id"))
    parsed = tables.parse_markdown(F.when(kind == "table", F.col("text")))  # only tables are asked about rows
    answer = docs.select("doc_id", kind.alias("kind"), F.when(F.col("quality") == 1, F.col("source")).otherwise(" ").alias("overview"), F.when(F.col("lang") == "en", F.col("text")).alias("latex"), parsed.alias("t"))
    answer = answer.select("doc_id", "kind", "overview", "latex", "t.headers", "t.rows")
    return answer.select("doc_id", F.array_join(validation.failing(F.col("kind"), F.col), ",").alias("failed"))


def correction_hints(spark, sf_dir):
    names = F.when(F.col("doc_id") % 2 == 0, F.array(F.lit("latex_present"), F.lit("overview_present"))).otherwise(F.array(F.lit("row_column_count")))
    return documents(spark, sf_dir).select("doc_id", validation.correction_prompt(F.col("source"), names).alias("prompt"))


def review_status(spark, sf_dir):
    return extraction.document_status(as_chunks(spark, sf_dir).withColumn("metadata_only", F.col("content_type") == "formula"))


def adapt_v1_v2(spark, sf_dir):
    rows = documents(spark, sf_dir).select("doc_id", F.col("source").alias("image_path"), F.when(F.col("doc_id") % 3 > 0, F.col("n_chars").cast("int")).alias("chunk_index"), F.when(F.col("doc_id") % 2 == 0, 1).alias("schema_version"))
    out = adapt_chunks(rows)
    return out.select("doc_id", "cropped_image_path", F.size("entities").alias("n_entities"), "reading_order_index", "correction_applied", "schema_version")


# Stores ----------------------------------------------------------------------------------------


def upsert_columns(spark, sf_dir):
    docs = documents(spark, sf_dir).select("doc_id", "lang", "n_chars")
    old = docs.where("doc_id % 3 < 2")
    new = docs.where("doc_id % 3 > 0").select("doc_id", F.upper("lang").alias("lang"), (F.col("n_chars") + 1).alias("n_chars"))
    return stores.upsert_rows(old, new, ["doc_id"], ["n_chars"])


def point_ids(spark, sf_dir):
    return documents(spark, sf_dir).select("doc_id", stores.point_id(F.md5(F.col("doc_id").cast("string"))).cast("string").alias("point_id"))


def embed_sources(spark, sf_dir):
    chunks = documents(spark, sf_dir).select(F.col("doc_id").alias("chunk_id"), _kind(F.col("doc_id")).alias("content_type"), F.when(F.col("lang") == "en", F.col("source")).alias("cropped_image_path"), F.when(F.col("doc_id") % 8 < 4, F.col("lang")).alias("image_description"), F.col("text").alias("overview"))
    return stores.embed_source(chunks, visual=True)


def manifest_outcomes(spark, sf_dir):
    def broken(_):
        raise OSError("sink is closed")

    docs = documents(spark, sf_dir).select(F.col("doc_id").cast("string").alias("document_id"))
    sinks = {"mongo": lambda rows: rows.write.format("noop").mode("overwrite").save(), "postgres": broken, "vector": lambda rows: rows.write.format("noop").mode("overwrite").save()}
    return stores.write_to_sinks(docs, sinks, ["mongodb", "postgres"])


# Retrieval -------------------------------------------------------------------------------------


def structured_filter_page(spark, sf_dir):
    found = retrieval.structured(as_chunks(spark, sf_dir), "doc_id >= 10", "$.lang", ["text", "table"], None, 0.5)
    return retrieval.keyset(found, "chunk_id", 50).select("chunk_id", "document_id", "confidence_score")


def keyset_page2(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").where("o_orderstatus in ('O', 'F')").select("o_orderkey", "o_orderstatus", "o_totalprice")
    first = retrieval.keyset_page(orders.select("o_orderkey"), "o_orderkey", 50)
    after = int(retrieval.decode_cursor(first.next_cursor)) if first.next_cursor else None
    return retrieval.keyset(orders, "o_orderkey", 50, after) if after is not None else orders.limit(0)


def filter_total(spark, sf_dir):
    found = retrieval.structured(as_chunks(spark, sf_dir), "doc_id >= 10", None, ["text", "table"], None, 0.5)
    return found.agg(F.count("*").alias("total"))


def mongo_filter(spark, sf_dir):
    spec = {"$or": [{"document_id": {"$in": ["src1", "src2", "src3"]}}, {"doc_id": {"$gte": 100, "$lt": 160}}], "confidence_score": {"$gt": 2}, "doc_id": {"$not": {"$eq": 101}}}
    found = retrieval.documents_query(as_chunks(spark, sf_dir), spec, "the", ["text", "figure"], None, 0.5)
    return found.select("chunk_id", "document_id", "confidence_score")


def json_path_filter(spark, sf_dir):
    events = table(spark, sf_dir, "events").select("event_id", "props")
    return events.where(path_exists(F.col("props"), "$.k ? (@ > 50)")).select("event_id")


def json_key_exists(spark, sf_dir):
    return table(spark, sf_dir, "events").select("event_id", path_exists(F.col("props"), "$.k").alias("has_k"), path_exists(F.col("props"), "$.k.z").alias("has_z"))


def fulltext_rank(spark, sf_dir):
    return retrieval.fulltext_rank(documents(spark, sf_dir), QUERY_TEXT, "doc_id", "text", 50)


def _rounded(found: DataFrame) -> DataFrame:
    return found.select("vec_id", "label", F.round("similarity_score", 6).alias("similarity_score"))


def vector_topk(spark, sf_dir):
    return _rounded(retrieval.vector_search(as_vectors(spark, sf_dir), query_vector(spark, sf_dir), "vec_id", 20))


def vector_min_score(spark, sf_dir):
    return _rounded(retrieval.vector_scores(as_vectors(spark, sf_dir), query_vector(spark, sf_dir), min_score=0.1))


def vector_filtered(spark, sf_dir):
    tests = retrieval.metadata_tests({"label": 3})
    return _rounded(retrieval.vector_search(as_vectors(spark, sf_dir), query_vector(spark, sf_dir), "vec_id", 20, tests=tests))


def vector_page2(spark, sf_dir):
    return _rounded(retrieval.vector_search(as_vectors(spark, sf_dir), query_vector(spark, sf_dir), "vec_id", 20, skip=20))


# Graph -----------------------------------------------------------------------------------------


def graph_mentions(spark, sf_dir):
    return as_mentions(spark, sf_dir)


def entity_dedup(spark, sf_dir):
    return graph.entities(as_mentions(spark, sf_dir))


def _turns(spark, sf_dir):
    return table(spark, sf_dir, "conversations").select(F.col("conv_id").alias("document_id"), F.concat_ws("-", "conv_id", "turn").alias("chunk_id"), F.col("turn").alias("reading_order_index"))


def next_chunk(spark, sf_dir):
    return graph.next_chunk(_turns(spark, sf_dir))


def chain_order(spark, sf_dir):
    return graph.chain_order(_turns(spark, sf_dir))


def chain_heads(spark, sf_dir):
    turns = _turns(spark, sf_dir)
    return graph.chain_heads(graph.next_chunk(turns), turns).select("document_id", "chunk_id")


def table_row_nodes(spark, sf_dir):
    chunks = _parsed(spark, sf_dir).select(F.col("doc_id").alias("chunk_id"), F.lit("table").alias("content_type"), F.struct("t.rows").alias("table_data"))
    return graph.table_rows(chunks).select("chunk_id", "row_index", F.array_join(F.from_json("values", "array<string>"), "␟").alias("cells"))


def entity_traverse_d1(spark, sf_dir):
    return graph.entity_chunks(as_mentions(spark, sf_dir), ENTITY_TEXT, depth=1)


def entity_traverse_d3(spark, sf_dir):
    return graph.entity_chunks(as_mentions(spark, sf_dir), ENTITY_TEXT, "PERSON", depth=3)


def entity_docs(spark, sf_dir):
    docs = documents(spark, sf_dir)
    chunks = docs.select(F.col("doc_id").alias("chunk_id"), F.col("source").alias("document_id"))
    sources = docs.select(F.col("source").alias("document_id")).distinct().withColumn("source_path", F.concat(F.lit("in/"), "document_id"))
    return graph.entity_documents(as_mentions(spark, sf_dir), chunks, sources, ENTITY_TEXT)


def traverse_all(spark, sf_dir):
    chunks = as_chunks(spark, sf_dir).select("chunk_id", "document_id", "reading_order_index")
    found = retrieval.traverse(chunks, as_mentions(spark, sf_dir), document_id="src3")
    return found.orderBy("reading_order_index", "chunk_id").offset(5).limit(50)


# Fusion ----------------------------------------------------------------------------------------


def _fused(spark, sf_dir, top: int | None = 20):
    text = retrieval.fulltext_rank(documents(spark, sf_dir), QUERY_TEXT, "doc_id", "text", 20)
    best = retrieval.vector_search(as_vectors(spark, sf_dir), query_vector(spark, sf_dir), "vec_id", 20)
    best = best.withColumn("score6", F.round("similarity_score", 6)).withColumn("rank", F.row_number().over(Window.orderBy(F.col("score6").desc(), "vec_id")))
    low = retrieval.keyset(as_chunks(spark, sf_dir).where("confidence_score >= 0.5"), "doc_id", 20).withColumn("rank", F.row_number().over(Window.orderBy("doc_id")))
    lists = [fusion.ranked(text, "doc_id", "text", 0), fusion.ranked(best, "vec_id", "vector", 1), fusion.ranked(low, "doc_id", "structured", 2)]
    return fusion.fuse(lists, top=top)


def fused_rrf(spark, sf_dir):
    return _fused(spark, sf_dir).select("chunk_id", F.round("rrf_score", 9).alias("rrf_score"))


def fused_sources(spark, sf_dir):
    return _fused(spark, sf_dir, None).select("chunk_id", F.array_join("sources", ",").alias("sources"))


def fused_representative(spark, sf_dir):
    fused = _fused(spark, sf_dir).select("chunk_id", "first_adapter")
    docs = documents(spark, sf_dir).select(F.col("doc_id").alias("chunk_id"), "source", "lang")
    return fusion.with_chunks(fused, docs)


# Metrics, streams, the whole -------------------------------------------------------------------


def metrics_by_status(spark, sf_dir):
    return metrics.counter(extraction.document_status(as_chunks(spark, sf_dir)), "processing_status")


def metrics_regions_by_type(spark, sf_dir):
    return metrics.counter(layout.virtual_regions(as_pages(spark, sf_dir)), "region_type")


def confidence_histogram(spark, sf_dir):
    return metrics.histogram(as_chunks(spark, sf_dir), "confidence_score", metrics.CONFIDENCE)


def latency_histogram(spark, sf_dir):
    return metrics.histogram(table(spark, sf_dir, "events"), "value", metrics.PIPELINE_SECONDS, "event_type")


def stream_ingest_dedup(spark, sf_dir):
    """Documents replayed as a stream of files, twice; each content is stored once."""
    from quire.streaming import ingest

    folder = f"{shared_folder(spark)}/quire/stream-{uuid.uuid4().hex}"
    docs = documents(spark, sf_dir).select(F.col("doc_id").cast("string").alias("source_path"), routing.content_hash(F.col("text")).alias("content_hash"))
    for name in ("a", "b"):
        docs.write.mode("append").parquet(f"{folder}/in")
        store = stores.TableStore(spark, f"{folder}/documents", ["content_hash"])
        ingest.start(ingest.source(spark, f"{folder}/in", docs.schema, 1000), store, f"{folder}/checkpoint").awaitTermination()
        del name
    return store.read().select("content_hash", "processing_status")


def ingest_documents(spark, sf_dir):
    """All documents through the whole plan with the offline providers."""
    head = documents(spark, sf_dir).select(F.sha2("text", 256).alias("content_hash"), F.col("doc_id").cast("string").alias("source_path"), F.lit("txt").alias("format"), "text")
    pages = paginate(stores.first_of_content(head).withColumn("document_id", F.col("content_hash")))
    result = Pipeline().run(pages, unique=True)
    return result.chunks.select("chunk_id", "document_id", "page_number", "chunk_index", "content_type", "overview", "confidence_score", "page_break_context")


def _ingested(spark, sf_dir, name: str):
    """All documents through the whole plan and into a sink; the sink."""
    head = documents(spark, sf_dir).select(F.sha2("text", 256).alias("content_hash"), F.col("doc_id").cast("string").alias("source_path"), F.lit("txt").alias("format"), "text")
    pages = paginate(stores.first_of_content(head).withColumn("document_id", F.col("content_hash")))
    pipeline = Pipeline(sinks=stores.default_stores(spark, f"{shared_folder(spark)}/quire/stores-{uuid.uuid4().hex}", HashEmbedder()))
    pipeline.write(pipeline.run(pages, unique=True), [name])
    return pipeline.sinks[name]


def stored_documents(spark, sf_dir):
    return _ingested(spark, sf_dir, "mongo").documents.read().select("document_id", "content_hash", "source_path", "total_pages", "processing_status")


def stored_chunks(spark, sf_dir):
    return _ingested(spark, sf_dir, "postgres").chunks.read().select("document_id", "page_number", "chunk_index", "content_type", "raw_text", "confidence_score")


def stored_regions(spark, sf_dir):
    return _ingested(spark, sf_dir, "mongo").regions.read().select("document_id", "page_number", "region_index", "region_type", F.col("bbox.y0").alias("y0"), F.col("bbox.y1").alias("y1"))


def stored_graph(spark, sf_dir):
    """How many nodes and edges of each kind the graph has."""
    g = _ingested(spark, sf_dir, "neo4j")
    kinds = ("documents", "chunks", "regions", "has_chunk", "has_region", "next_chunk")
    return functools.reduce(DataFrame.unionByName, [getattr(g, k).read().agg(F.count("*").alias("n")).select(F.lit(k).alias("kind"), "n") for k in kinds])


def stored_vectors(spark, sf_dir):
    return _ingested(spark, sf_dir, "vector").table.read().select("chunk_id", "document_id", "content_type", "page_number", F.size("vector").alias("dim"))


def stem_rank(spark, sf_dir):
    """Full text by stored stems."""
    return retrieval.fulltext_rank(retrieval.with_tokens(documents(spark, sf_dir), "text"), "licenses reserved", "doc_id", "text", 50)


def json_contained(spark, sf_dir):
    rows = documents(spark, sf_dir).select("doc_id", F.to_json(F.struct("lang", "source")).alias("j"))
    return rows.where(json_contains(F.col("j"), {"lang": "de", "source": "src1"})).select("doc_id")


def json_path_or(spark, sf_dir):
    events = table(spark, sf_dir, "events").select("event_id", "props")
    return events.where(path_exists(F.col("props"), "$ ? (@.k > 90 || !(@.k >= 10))")).select("event_id")


def dedup_hit_count(spark, sf_dir):
    hashed = documents(spark, sf_dir).select("doc_id", routing.content_hash(F.col("text")).alias("content_hash"))
    return metrics.dedup_hits(hashed, hashed.where("doc_id % 2 = 0"))


def sheet_grid_cells(spark, sf_dir):
    """Piped documents as sheets: how their cells are drawn."""
    parsed = _parsed(spark, sf_dir).select(F.col("doc_id").alias("source_path"), F.lit(1).alias("page_number"), "t.headers", "t.rows")
    return sheets.sheet_grid(parsed).select(F.col("source_path").alias("doc_id"), "row", "col", "x0", "y0", "x1", "y1", "text")


QUERIES = (
    doc_content_hash, doc_dedup_survivors, doc_unseen, route_formats, text_paginate, quality_tier, scanned_pages, html_strip, html_strip_visible,
    csv_to_text, mail_pages, virtual_regions, bbox_derived, crop_box_path, xy_cut_order, detector_classes, resolution_guard, skew_angle, chunk_merge,
    caption_attach, page_break_bridge, md_table_parse, md_table_cells, md_table_build, figure_reclassify, table_continuation, table_merge,
    table_cell_match, prompt_build, answer_parse, completion_content, validate_rules, correction_hints, review_status, adapt_v1_v2, upsert_columns,
    point_ids, embed_sources, manifest_outcomes, structured_filter_page, keyset_page2, filter_total, mongo_filter, json_path_filter, json_key_exists,
    fulltext_rank, vector_topk, vector_min_score, vector_filtered, vector_page2, graph_mentions, entity_dedup, next_chunk, chain_order, chain_heads,
    table_row_nodes, entity_traverse_d1, entity_traverse_d3, entity_docs, traverse_all, fused_rrf, fused_sources, fused_representative,
    metrics_by_status, metrics_regions_by_type, confidence_histogram, latency_histogram, stream_ingest_dedup, ingest_documents,
    stored_documents, stored_chunks, stored_regions, stored_graph, stored_vectors, stem_rank, json_contained, json_path_or, dedup_hit_count, sheet_grid_cells,
)


def queries() -> dict:
    return {f.__name__: f for f in QUERIES}
