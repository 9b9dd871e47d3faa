"""Schemas of the document model and schema-on-read of older chunk rows."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

CURRENT_VERSION = 2
SUPPORTED_VERSIONS = (1, 2)

# Fixed values.
REGION_TYPES = "text", "table", "figure", "formula", "header", "footer", "caption"
ENTITY_TYPES = "ORG", "PERSON", "DATE", "MONEY", "LOCATION", "PRODUCT"
STATUSES = "pending", "processing", "complete", "review_required"

BBOX = "struct<x0:double,y0:double,x1:double,y1:double,page_width:double,page_height:double>"
CELL = "struct<row:int,col:int,row_span:int,col_span:int,value:string,is_header:boolean>"
TABLE = f"struct<headers:array<string>,rows:array<array<string>>,cells:array<{CELL}>,markdown:string,continued_from_page:int,merge_confidence:double>"
ENTITY = "struct<text:string,type:string,value:string>"


# Schemas as DDL text: a Python worker that imports this module has no session to parse them with.
DOCUMENTS = "document_id string, source_path string, content_hash string, format string, total_pages int, processing_status string, schema_version int, metadata map<string,string>"
PAGES = "document_id string, page_number int, native_text string, estimated_dpi int, quality_tier string, is_scanned boolean, metadata map<string,string>"
REGIONS = (
    f"region_id string, document_id string, page_number int, region_index int, region_type string, bbox {BBOX}, cropped_image_path string, content_hash string, detector_confidence double, metadata map<string,string>, schema_version int"
)
CHUNKS = (
    f"chunk_id string, document_id string, page_number int, chunk_index int, reading_order_index int, content_type string, raw_text string, overview string, table_data {TABLE}, image_description string, formula_latex string, structured_data string, entities array<{ENTITY}>, cropped_image_path string, confidence_score double, correction_applied boolean, page_break_context string, caption string, metadata map<string,string>, schema_version int"
)


@dataclass(frozen=True)
class ExtractionSchema:
    """What a caller wants extracted beside the standard keys."""

    fields: dict[str, str] = field(default_factory=dict)
    extract_entities: bool = True
    entity_types: tuple[str, ...] = ENTITY_TYPES
    validation_hints: tuple[str, ...] = ()


def stable_id(*parts):
    """An identifier that a retried task computes again alike."""
    return F.sha2(F.concat_ws("|", *[F.coalesce(p.cast("string"), F.lit("")) for p in parts]), 256)


def adapt_chunks(chunks: DataFrame) -> DataFrame:
    """Bring chunk rows of version 1 (or without one) to version 2; other versions are an error.

    Columns that a version-1 table lacks are added with their defaults; nothing is written back.
    """
    have = set(chunks.columns)

    def col(name: str, kind: str):
        return F.col(name) if name in have else F.lit(None).cast(kind)

    version = F.coalesce(col("schema_version", "int"), F.lit(1))
    known = F.when(version.isin(*SUPPORTED_VERSIONS), F.lit(CURRENT_VERSION)).otherwise(F.raise_error(F.concat(F.lit("unsupported chunk schema version "), version)).cast("int"))
    old = version == 1
    out = chunks.withColumns(
        {
            "cropped_image_path": F.when(old, F.coalesce(col("cropped_image_path", "string"), col("image_path", "string"), F.lit(""))).otherwise(col("cropped_image_path", "string")),
            "entities": F.when(old, F.coalesce(col("entities", f"array<{ENTITY}>"), F.from_json(F.lit("[]"), f"array<{ENTITY}>"))).otherwise(col("entities", f"array<{ENTITY}>")),
            "reading_order_index": F.when(old, F.coalesce(col("reading_order_index", "int"), col("chunk_index", "int"), F.lit(0))).otherwise(col("reading_order_index", "int")),
            "correction_applied": F.when(old, F.coalesce(col("correction_applied", "boolean"), F.lit(False))).otherwise(col("correction_applied", "boolean")),
            "schema_version": known,
        }
    )
    return out.drop("image_path")
