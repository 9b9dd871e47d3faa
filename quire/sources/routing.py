"""From paths to formats: which reader takes a file, what it is called, and its content hash."""

from __future__ import annotations

import mimetypes
import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Suffixes and media types by reader.
READERS = {
    "pdf": (".pdf",),
    "docx": (".docx", ".doc"),
    "image": (".jpg", ".jpeg", ".png", ".tiff", ".tif", ".bmp", ".webp"),
    "text": (".txt", ".html", ".htm", ".csv", ".md"),
    "excel": (".xlsx", ".xls", ".xlsm"),
    "email": (".eml", ".msg"),
}
MEDIA = {
    "pdf": ("application/pdf",),
    "docx": ("application/vnd.openxmlformats-officedocument.wordprocessingml.document", "application/msword"),
    "image": ("image/jpeg", "image/png", "image/tiff", "image/bmp", "image/webp"),
    "text": ("text/plain", "text/html", "text/csv"),
    "excel": ("application/vnd.openxmlformats-officedocument.spreadsheetml.sheet", "application/vnd.ms-excel"),
    "email": ("message/rfc822",),
}
DENSITY_LIMIT = 0.3
DENSITY_PAGES = 5


def _lookup(key: Column, by_reader: dict[str, tuple[str, ...]]) -> Column:
    pairs = [F.lit(x) for reader, keys in by_reader.items() for k in keys for x in (k, reader)]
    return F.element_at(F.create_map(*pairs), key)


def suffix(path: Column) -> Column:
    """The last suffix of the last path part, lower case; empty if there is none."""
    name = F.regexp_extract(path, r"([^/]*)/*$", 1)
    return F.lower(F.regexp_extract(name, r"^.+(\.[^.]+)$", 1))


def by_media_type(path: Column) -> Column:
    """The reader by the media type that the platform's table gives a suffix; null if none does.

    The table is small and known when the plan is made, so it becomes a literal map; a compression
    suffix is taken off first, as the table's own lookup does.
    """
    known = {t: r for r, types in MEDIA.items() for t in types}
    mimetypes.init()
    table = {s: known[t] for s, t in mimetypes.types_map.items() if t in known}
    pairs = [F.lit(x) for item in sorted(table.items()) for x in item]
    packed = "|".join(re.escape(s) for s in mimetypes.encodings_map)
    return F.element_at(F.create_map(*pairs), suffix(F.regexp_replace(path, f"(?:{packed})$", "")))


def reader(path: Column) -> Column:
    """By suffix, else by media type, else text."""
    return F.coalesce(_lookup(suffix(path), READERS), by_media_type(path), F.lit("text"))


def format_label(path: Column) -> Column:
    """image, excel, email and text for those groups, else the suffix itself, else unknown."""
    s = suffix(path)
    group = _lookup(s, {k: v for k, v in READERS.items() if k in ("image", "excel", "email", "text")})
    return F.coalesce(group, F.nullif(F.ltrim(s, F.lit(".")), F.lit("")), F.lit("unknown"))


def content_hash(content: Column) -> Column:
    return F.sha2(content.cast("binary"), 256)


def quality_tier(pages: DataFrame, area: Column, limit: float = DENSITY_LIMIT, first: int = DENSITY_PAGES) -> DataFrame:
    """(document_id, density, quality_tier): mean over the first pages of stripped text length by page area."""
    from quire.functions.text import strip

    density = F.avg(F.length(strip(F.coalesce("native_text", F.lit("")))) / area)
    per = pages.where(F.col("page_number") <= first).groupBy("document_id").agg(density.alias("density"))
    return per.withColumn("quality_tier", F.when(F.col("density") < limit, "high_detail").otherwise("standard"))


def read_files(spark: SparkSession, *paths: str, pattern: str | None = None) -> DataFrame:
    """source_path, content, content_hash, reader, format of files; a missing path is an error at once."""
    options = {"recursiveFileLookup": "true"} | ({"pathGlobFilter": pattern} if pattern else {})
    files = spark.read.format("binaryFile").options(**options).load(list(paths))
    return route(files.select(F.col("path").alias("source_path"), "content"))


def route(files: DataFrame) -> DataFrame:
    path = F.col("source_path")
    return files.select("source_path", "content", content_hash(F.col("content")).alias("content_hash"), reader(path).alias("reader"), format_label(path).alias("format"))
