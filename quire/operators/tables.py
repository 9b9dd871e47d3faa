"""Markdown tables: parse, build, cells, continuation over pages, and figures that are tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quire.functions.arrays import let
from quire.functions.text import splitlines, strip, strip_char
from quire.schema import CELL

# Fixed values.
SEPARATOR = r"^\|?[\s\-:]+(?:\|[\s\-:]+)*\|?\s*$"
TERMINAL = r"(?i)\b(total|grand total|subtotal|sum|average)\b"
CONTINUATION_CONFIDENCE = 0.9
TAIL_CHARS = 200


def pipe_lines(text: Column) -> Column:
    """The lines that hold a pipe, stripped."""
    return F.transform(F.filter(splitlines(text), lambda x: F.contains(x, F.lit("|"))), strip)


def _cells(line: Column) -> Column:
    return F.transform(F.split(strip_char(line, "|"), r"\|", -1), strip)


def parse_markdown(text: Column) -> Column:
    """struct(headers, rows): the first pipe line is the header, the first later separator line is
    skipped, all others are rows. Without a pipe line both are empty."""
    empty = F.array().cast("array<string>")

    def without(rest: Column, separator: Column) -> Column:
        return F.when(separator > 0, F.concat(F.slice(rest, 1, separator - 1), F.slice(rest, separator + 1, F.size(rest)))).otherwise(rest)

    def parsed(lines: Column) -> Column:
        rest = F.slice(lines, 2, F.greatest(F.size(lines) - 1, F.lit(0)))
        separator = lambda rest: F.array_position(F.transform(rest, lambda x: x.rlike(SEPARATOR)), True).cast("int")
        rows = let(rest, lambda rest: let(separator(rest), lambda at: without(rest, at)))
        return F.when(F.size(lines) > 0, F.struct(_cells(lines[0]).alias("headers"), F.transform(rows, _cells).alias("rows"))).otherwise(
            F.struct(empty.alias("headers"), F.array().cast("array<array<string>>").alias("rows"))
        )

    return let(pipe_lines(F.coalesce(text, F.lit(""))), parsed)


def build_cells(headers: Column, rows: Column) -> Column:
    """Cells of a table: headers are row 0, data rows count from 1."""

    def cell(row, col, value, header: bool) -> Column:
        return F.struct(row.cast("int").alias("row"), col.cast("int").alias("col"), F.lit(1).alias("row_span"), F.lit(1).alias("col_span"), value.alias("value"), F.lit(header).alias("is_header"))

    top = F.transform(headers, lambda v, c: cell(F.lit(0), c, v, True))
    body = F.flatten(F.transform(rows, lambda r, i: F.transform(r, lambda v, c: cell(i + 1, c, v, False))))
    return F.concat(top, body).cast(f"array<{CELL}>")


def build_markdown(headers: Column, rows: Column) -> Column:
    line = lambda cells: F.concat(F.lit("| "), F.array_join(cells, " | "), F.lit(" |"))
    dashes = F.transform(headers, lambda _: F.lit("---"))
    return F.when(F.size(headers) > 0, F.array_join(F.concat(F.array(line(headers), line(dashes)), F.transform(rows, line)), "\n")).otherwise("")


def table_from_response(headers: Column, rows: Column, cells: Column, markdown: Column, raw_text: Column) -> Column:
    """Table data of a model response: its own headers and rows if both are there, else what its
    markdown (or text) parses to, else the text alone as markdown."""
    text = F.coalesce(F.nullif(markdown, F.lit("")), raw_text, F.lit(""))
    parsed = parse_markdown(text)
    own = headers.isNotNull() & rows.isNotNull()
    found = F.when(own, F.struct(headers.alias("headers"), rows.alias("rows"))).otherwise(parsed)
    given = F.filter(cells, lambda c: c["row"].isNotNull() & c["col"].isNotNull())
    shown = F.when(own, F.coalesce(F.nullif(markdown, F.lit("")), build_markdown(headers, rows))).otherwise(text)

    def data(found: Column) -> Column:
        made = F.when(F.size(given) > 0, given.cast(f"array<{CELL}>")).otherwise(build_cells(found["headers"], found["rows"]))
        return F.struct(found["headers"].alias("headers"), found["rows"].alias("rows"), made.alias("cells"), shown.alias("markdown"), F.lit(None).cast("int").alias("continued_from_page"), F.lit(None).cast("double").alias("merge_confidence"))

    return let(found, data)


def looks_like_table(text: Column, at_least: int = 3) -> Column:
    """Three lines or more with a pipe."""
    return F.coalesce(F.size(F.filter(F.split(text, "\n", -1), lambda x: F.contains(x, F.lit("|")))) >= at_least, F.lit(False))


def ending(rows: Column, markdown: Column, raw_text: Column) -> Column:
    """The text that tells whether a table is finished: last row, else last markdown line, else the text's end."""
    lines = F.filter(splitlines(markdown), lambda x: F.length(strip(x)) > 0)
    return (
        F.when(F.size(rows) > 0, F.array_join(F.element_at(rows, -1), " "))
        .when(F.coalesce(F.length(markdown), F.lit(0)) > 0, F.coalesce(F.try_element_at(lines, F.lit(-1)), F.lit("")))
        .otherwise(F.coalesce(F.right(raw_text, F.lit(TAIL_CHARS)), F.lit("")))
    )


def continuations(chunks: DataFrame, key: str = "document_id", page: str = "page_number", order: str = "reading_order_index", kind: str = "content_type", text: str = "ending") -> DataFrame:
    """Adds is_continuation and continuation_confidence: a table continues the last chunk of the page
    before, if that is a table whose ending holds no closing word.

    The last chunks (one row a page) are joined back by document and page.
    """
    last = chunks.groupBy(key, F.col(page).alias("__page")).agg(F.max_by(F.struct(F.col(kind).alias("kind"), F.col(text).alias("ending")), order).alias("__last"))
    last = last.select(F.col(key).alias("__key"), (F.col("__page") + 1).alias("__page"), "__last")
    joined = chunks.join(last, (F.col(key) == F.col("__key")) & (F.col(page) == F.col("__page")), "left")
    goes_on = (F.col(kind) == "table") & F.coalesce(F.col("__last.kind") == "table", F.lit(False)) & ~F.coalesce(F.col("__last.ending"), F.lit("")).rlike(TERMINAL)
    return joined.withColumn("is_continuation", goes_on).withColumn("continuation_confidence", F.when(goes_on, CONTINUATION_CONFIDENCE).otherwise(0.0)).drop("__key", "__page", "__last")


def merge_continued(tables: DataFrame) -> DataFrame:
    """Join tables that go on over pages: from (document_id, page_number, reading_order_index, chunk_id,
    headers, rows, is_continuation) to one row a table, with rows in page order, the first chunk's id,
    and continued_from_page and merge_confidence where parts were joined."""
    order = Window.partitionBy("document_id").orderBy("page_number", "reading_order_index")
    grouped = tables.withColumn("__group", F.sum((~F.col("is_continuation")).cast("int")).over(order.rowsBetween(Window.unboundedPreceding, 0)))
    parts = F.array_sort(F.collect_list(F.struct("page_number", "reading_order_index", "chunk_id", "headers", "rows")))
    whole = grouped.groupBy("document_id", "__group").agg(parts.alias("parts"))
    first = F.col("parts")[0]
    joined = F.size("parts") > 1
    return whole.select(
        first["chunk_id"].alias("chunk_id"), "document_id", first["page_number"].alias("page_number"), first["headers"].alias("headers"),
        F.flatten(F.transform("parts", lambda p: p["rows"])).alias("rows"),
        F.when(joined, first["page_number"]).alias("continued_from_page"), F.when(joined, F.lit(CONTINUATION_CONFIDENCE)).alias("merge_confidence"),
    )
