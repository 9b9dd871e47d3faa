"""Queries over the stores: filters with keyset pages, full text, vectors, graph walks.

A retriever builds a lazy plan; a page is one bounded collect. Totals are a second job and only run
when asked for.
"""

from __future__ import annotations

import base64
import binascii
import functools
import operator
from dataclasses import dataclass
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quire.functions.jsonpath import path_exists
from quire.functions.vectors import cosine_literal
from quire.operators import graph
from quire.schema import CURRENT_VERSION, ENTITY

LIMIT = 50


@dataclass
class Page:
    """Rows of one page, the cursor of the next (None: no more), and the total where it was asked for."""

    rows: list
    next_cursor: str | None
    total: int | None = None


def encode_cursor(value: object) -> str:
    return base64.b64encode(str(value).encode()).decode()


def decode_cursor(cursor: str) -> str:
    try:
        return base64.b64decode(cursor.encode(), validate=True).decode()
    except (binascii.Error, UnicodeError) as e:
        raise ValueError(f"not a cursor: {cursor!r}") from e


def offset_of(cursor: str | None) -> int:
    text = decode_cursor(cursor) if cursor else "0"
    if not text.isdigit():
        raise ValueError(f"not an offset cursor: {cursor!r}")
    return int(text)


def common_filters(content_types: list[str] | None = None, document_id: str | None = None, min_confidence: float | None = None) -> list[Column]:
    found = []
    if content_types:
        found.append(F.col("content_type").isin(*content_types))
    if document_id:
        found.append(F.col("document_id") == document_id)
    if min_confidence is not None:
        found.append(F.col("confidence_score") >= min_confidence)
    return found


def keep(df: DataFrame, tests: list[Column]) -> DataFrame:
    return functools.reduce(lambda d, t: d.where(t), tests, df)


def keyset(df: DataFrame, key: str, limit: int, after: object | None = None) -> DataFrame:
    """The next ``limit`` rows by key; a filter and a bounded top-k, which the scan's statistics can prune."""
    return (df if after is None else df.where(F.col(key) > F.lit(after))).orderBy(key).limit(limit)


def keyset_page(df: DataFrame, key: str, limit: int = LIMIT, cursor: str | None = None, count: bool = False) -> Page:
    kind = df.schema[key].dataType.simpleString()
    after = None if cursor is None else F.lit(decode_cursor(cursor)).cast(kind)
    narrowed = df if after is None else df.where(F.col(key) > after)
    rows = narrowed.orderBy(key).limit(limit + 1).collect()
    more = len(rows) > limit
    return Page(rows[:limit], encode_cursor(rows[limit - 1][key]) if more else None, df.count() if count else None)


def offset_page(df: DataFrame, order: list, limit: int, cursor: str | None = None, count: bool = False) -> Page:
    """Pages by offset: a full page has a cursor, even if nothing follows."""
    skip = offset_of(cursor)
    rows = df.orderBy(*order).offset(skip).limit(limit).collect()
    return Page(rows, encode_cursor(skip + limit) if len(rows) == limit else None, df.count() if count else None)


def structured(chunks: DataFrame, sql_filter: str | None = None, jsonpath: str | None = None, content_types: list[str] | None = None, document_id: str | None = None, min_confidence: float | None = None) -> DataFrame:
    """Chunks by column filters, a path into structured_data, and a SQL condition of the caller."""
    tests = common_filters(content_types, document_id, min_confidence)
    if sql_filter:
        tests.append(F.expr(f"({sql_filter})"))
    if jsonpath:
        tests.append(path_exists(F.col("structured_data"), jsonpath))
    return keep(chunks, tests)


COMPARE = {"$eq": operator.eq, "$ne": operator.ne, "$gt": operator.gt, "$gte": operator.ge, "$lt": operator.lt, "$lte": operator.le}


def compile_filter(spec: dict[str, Any], column=None) -> Column:
    """A filter document as a condition: values, $eq $ne $gt $gte $lt $lte $in $nin $exists $elemMatch $not,
    and $and $or $nor of filters. A missing (null) value equals only null; $ne and $nin hold for it."""
    column = column or F.col
    tests: list[Column] = []
    for name, want in spec.items():
        if name in ("$and", "$or", "$nor"):
            parts = [compile_filter(s, column) for s in want]
            joined = functools.reduce(operator.and_ if name == "$and" else operator.or_, parts)
            tests.append(~joined if name == "$nor" else joined)
            continue
        if name.startswith("$"):
            raise ValueError(f"unknown operator {name}")
        tests.append(_field(column(name), want, column))
    return functools.reduce(operator.and_, tests) if tests else F.lit(True)


def _field(c: Column, want: Any, column) -> Column:
    if not (isinstance(want, dict) and any(k.startswith("$") for k in want)):
        return c.isNull() if want is None else F.coalesce(c == F.lit(want), F.lit(False))
    tests = []
    for op, value in want.items():
        if op in COMPARE and value is None:
            tests.append(c.isNull() if op == "$eq" else c.isNotNull() if op == "$ne" else F.lit(False))
        elif op in COMPARE:
            tests.append(F.coalesce(COMPARE[op](c, F.lit(value)), F.lit(op == "$ne")))
        elif op in ("$in", "$nin"):
            inside = F.coalesce(c.isin(*[v for v in value if v is not None]), F.lit(False))
            inside = inside | c.isNull() if None in value else inside
            tests.append(~inside if op == "$nin" else inside)
        elif op == "$exists":
            tests.append(c.isNotNull() if value else c.isNull())
        elif op == "$not":
            tests.append(~_field(c, value, column))
        elif op == "$elemMatch":
            tests.append(F.coalesce(F.exists(c, lambda x: compile_filter(value, lambda n: x[n]) if not any(k.startswith("$") and k not in ("$and", "$or", "$nor") for k in value) else _field(x, value, column)), F.lit(False)))
        else:
            raise ValueError(f"unknown operator {op}")
    return functools.reduce(operator.and_, tests)


def terms(text: Column) -> Column:
    """Lower-case runs of ASCII letters and digits."""
    return F.filter(F.split(F.lower(text), r"[^a-z0-9]+", -1), lambda t: t != "")


def query_terms(text: str) -> list[str]:
    import re

    return sorted(set(re.findall(r"[a-z0-9]+", text.lower())))


# Endings of English words and what a stem has in their place, the first that fits.
ENDINGS = (("ies", "y"), ("sses", "ss"), ("ings", ""), ("ing", ""), ("edly", ""), ("ed", ""), ("ly", ""), ("es", ""), ("s", ""))
STEM_CHARS = 3


def stem(word: Column) -> Column:
    """A light stem: one ending goes where three letters or more are left; words in ss and us stay."""
    out = word
    for ending, instead in reversed(ENDINGS):
        fits = F.endswith(word, F.lit(ending)) & (F.length(word) >= STEM_CHARS + len(ending)) & ~F.endswith(word, F.lit("ss")) & ~F.endswith(word, F.lit("us"))
        out = F.when(fits, F.concat(F.substring(word, F.lit(1), F.length(word) - len(ending)), F.lit(instead))).otherwise(out)
    return out


def stem_word(word: str) -> str:
    if word.endswith(("ss", "us")):
        return word
    return next((word[: -len(e)] + x for e, x in ENDINGS if word.endswith(e) and len(word) >= STEM_CHARS + len(e)), word)


def with_tokens(rows: DataFrame, text: str = "overview", name: str = "tokens") -> DataFrame:
    """Rows with the stems of their text, to be stored beside it: a search then doesn't read the text."""
    return rows.withColumn(name, F.transform(terms(F.coalesce(text, F.lit(""))), stem))


def text_score(text: Column, query: str) -> Column:
    """How often the query's terms stand in a text, in all; terms are alternatives."""
    wanted = query_terms(query)
    if not wanted:
        return F.lit(0)
    # Words of letters and digits, counted in place: no array of the text's words is made.
    return F.regexp_count(F.lower(F.coalesce(text, F.lit(""))), F.lit(f"(?<![a-z0-9])(?:{'|'.join(wanted)})(?![a-z0-9])"))


def token_score(tokens: Column, query: str) -> Column:
    """The same by stored stems, with the query's terms stemmed too."""
    wanted = sorted({stem_word(t) for t in query_terms(query)})
    return F.size(F.filter(tokens, lambda t: t.isin(*wanted))) if wanted else F.lit(0)


def documents_query(chunks: DataFrame, filters: dict[str, Any] | None = None, full_text: str | None = None, content_types: list[str] | None = None, document_id: str | None = None, min_confidence: float | None = None, text_col: str = "overview") -> DataFrame:
    """Chunks by a filter document; the built-in filters take the place of the caller's on the same field."""
    built_in = set()
    built_in |= {"content_type"} if content_types else set()
    built_in |= {"document_id"} if document_id else set()
    built_in |= {"confidence_score"} if min_confidence is not None else set()
    own = {k: v for k, v in (filters or {}).items() if k not in built_in}
    found = keep(chunks.where(compile_filter(own)), common_filters(content_types, document_id, min_confidence))
    if not full_text:
        return found
    return found.where((token_score(F.col("tokens"), full_text) if "tokens" in chunks.columns else text_score(F.col(text_col), full_text)) > 0)


def fulltext_rank(rows: DataFrame, query: str, key: str, text: str, k: int) -> DataFrame:
    """(key, score, rank) of the k best by term count, ties by key; by stems where ``rows`` have tokens."""
    from pyspark.sql import Window

    count = token_score(F.col("tokens"), query) if "tokens" in rows.columns else text_score(F.col(text), query)
    scored = rows.select(key, count.alias("score")).where("score > 0")
    top = scored.orderBy(F.col("score").desc(), key).limit(k)
    return top.withColumn("rank", F.row_number().over(Window.orderBy(F.col("score").desc(), key)))


def cell_match(chunks: DataFrame, spec: dict[str, Any]) -> DataFrame:
    """Chunks whose table has a cell that meets a filter document."""
    return chunks.where(compile_filter({"cells": {"$elemMatch": spec}}, lambda n: F.col(f"table_data.{n}")))


def vector_scores(rows: DataFrame, query: list[float], vector: str = "vector", min_score: float | None = None, tests: list[Column] | None = None) -> DataFrame:
    """``rows`` with similarity_score, the cosine with the query; filters run before, the vector is dropped
    after. Rows without a vector or of length 0 don't take part."""
    kept = keep(rows.where(F.col(vector).isNotNull()), tests or [])
    scored = kept.withColumn("similarity_score", cosine_literal(F.col(vector), query)).drop(vector).where("similarity_score is not null")
    return scored if min_score is None else scored.where(F.col("similarity_score") >= min_score)


def vector_search(rows: DataFrame, query: list[float], key: str, k: int, skip: int = 0, vector: str = "vector", min_score: float | None = None, tests: list[Column] | None = None) -> DataFrame:
    """The k nearest after ``skip``, best first, ties by key; a bounded top-k in each task, then one merge."""
    return vector_scores(rows, query, vector, min_score, tests).orderBy(F.col("similarity_score").desc(), key).offset(skip).limit(k)


def partial_chunks(points: DataFrame) -> DataFrame:
    """Chunks as far as a vector's payload tells them, with what it lacks empty."""
    have = set(points.columns)
    empty = {"raw_text": F.lit(""), "entities": F.array().cast(f"array<{ENTITY}>"), "correction_applied": F.lit(False), "reading_order_index": F.lit(0), "schema_version": F.lit(CURRENT_VERSION)}
    return points.select("*", *[v.alias(k) for k, v in empty.items() if k not in have])


def metadata_tests(metadata_filter: dict[str, Any] | None) -> list[Column]:
    return [F.col(k) == F.lit(v) for k, v in (metadata_filter or {}).items()]


def traverse(chunks: DataFrame, mentions: DataFrame, start_entity: str | None = None, entity_type: str | None = None, depth: int = 1, document_id: str | None = None, sql: str | None = None) -> DataFrame:
    """Chunks by a SQL query over the views ``chunks`` and ``mentions``, from an entity, or all."""
    if sql:
        chunks.createOrReplaceTempView("chunks")
        mentions.createOrReplaceTempView("mentions")
        return chunks.sparkSession.sql(sql)
    found = chunks
    if start_entity is not None:
        found = chunks.join(graph.entity_chunks(mentions, start_entity, entity_type, depth), "chunk_id", "left_semi")
    return found if document_id is None else found.where(F.col("document_id") == document_id)


def traverse_page(found: DataFrame, limit: int = LIMIT, cursor: str | None = None) -> Page:
    """A page by reading order; there is a next one while skip and limit are under the total."""
    skip, total = offset_of(cursor), found.count()
    rows = found.orderBy("reading_order_index", "chunk_id").offset(skip).limit(limit).collect()
    return Page(rows, encode_cursor(skip + limit) if skip + limit < total else None, total)
