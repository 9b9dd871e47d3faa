"""Around the extraction model: prompts, answers, and what an answer puts into a chunk."""

from __future__ import annotations

import json
import time
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quire.functions.text import strip
from quire.operators.tables import looks_like_table, table_from_response
from quire.schema import CELL, ENTITY, TABLE, ExtractionSchema

# Keys of an answer that aren't structured data.
RESERVED_KEYS = ("text", "raw_text", "overview", "entities", "markdown", "headers", "rows", "cells", "description", "latex", "plain_text", "image_type", "embedded_text", "confidence", "metadata_only")
FALLBACK = {"raw_text": "", "overview": "", "confidence": 0.0}
RETRY_STATUS = (429, 500, 502, 503, 504)
MAX_RETRIES = 3
REVIEW_BELOW = 0.5

ANSWER = f"struct<text:string,raw_text:string,overview:string,entities:array<{ENTITY}>,markdown:string,headers:array<string>,rows:array<array<string>>,cells:array<{CELL}>,description:string,image_description:string,latex:string,confidence:double>"


def prompt(kind: Column, prompts: dict[str, tuple[str, str]], suffix: str = "", schema: ExtractionSchema | None = None) -> Column:
    """The prompt for a region type: its system text, overview instruction, the suffix, and what the
    schema asks for. ``prompts``: type to (system, instruction); it is configuration, so it is literal."""
    parts = [F.lit(x) for k, v in prompts.items() for x in (k, "\n\n".join(p.strip() for p in v if p.strip()))]
    own = F.coalesce(F.element_at(F.create_map(*parts), kind), F.lit("Extract all content from this region."))
    more = [suffix.strip()] if suffix.strip() else []
    if schema and schema.fields:
        more.append("Also extract the following schema fields as JSON keys:\n" + "\n".join(f'  "{k}": "{v}"' for k, v in schema.fields.items()))
    if schema and schema.extract_entities and schema.entity_types:
        more.append(f"Restrict entity types to: {'|'.join(schema.entity_types)}. Return them in the 'entities' key as described above.")
    return F.concat_ws("\n\n", own, *map(F.lit, more))


def image_url(content: Column, media_type: str = "image/png") -> Column:
    """An image as a data URI, for a message of a chat model."""
    return F.concat(F.lit(f"data:{media_type};base64,"), F.base64(content))


def answer_text(response: Column) -> Column:
    """The message of a chat completion; empty if it isn't there."""
    return F.coalesce(F.get_json_object(response, "$.choices[0].message.content"), F.lit(""))


def clean_answer(text: Column) -> Column:
    """The JSON object of an answer as a string, without a code fence around it; else the fallback."""
    bare = strip(F.coalesce(text, F.lit("")))
    fenced = F.regexp_replace(F.regexp_replace(bare, r"\A```[^\n]*\n?", ""), r"\n?```\s*\z", "")
    body = strip(F.when(F.startswith(bare, F.lit("```")), fenced).otherwise(bare))
    parsed = F.try_parse_json(body)
    # JSON that begins with a brace is an object; only what begins otherwise needs its schema.
    is_object = F.when(F.startswith(body, F.lit("{")), parsed.isNotNull()).otherwise(F.coalesce(F.startswith(F.schema_of_variant(parsed), F.lit("OBJECT")), F.lit(False)))
    return F.when(is_object, body).otherwise(F.lit(json.dumps(FALLBACK)))


def parse_answer(text: Column) -> Column:
    return F.from_json(clean_answer(text), ANSWER)


def with_parsed(rows: DataFrame, answer: str = "answer") -> DataFrame:
    """``rows`` with __body, the object of the answer, and __a, what it says. Columns of their own, so whatever looks at
    an answer, and however often, it is cleaned and parsed once."""
    return rows.withColumn("__body", clean_answer(F.col(answer))).withColumn("__a", F.from_json("__body", ANSWER))


PARSED = ("__body", "__a")


def structured_data(text: Column) -> Column:
    """JSON string: the answer's ``fields`` if it has them, else all its keys that aren't reserved."""
    return _structured(clean_answer(text))


def _structured(body: Column) -> Column:
    fields = F.get_json_object(body, "$.fields")
    rest = F.to_json(F.map_filter(F.from_json(body, "map<string,string>"), lambda k, _: ~k.isin(*RESERVED_KEYS)))
    # Most answers have reserved keys alone; then the whole needn't be parsed.
    plain = F.forall(F.json_object_keys(body), lambda k: k.isin(*RESERVED_KEYS))
    return F.when(plain, "{}").otherwise(F.coalesce(fields, rest))


def populate(chunks: DataFrame, answer: str = "answer") -> DataFrame:
    """Chunks with what the model's answer (a string column) says, by content type; a figure whose text
    is a table becomes one. Chunks that are metadata only stay as they are. Answers that with_parsed has parsed
    aren't parsed again."""
    found = chunks if set(PARSED) <= set(chunks.columns) else with_parsed(chunks, answer)
    a, kind = F.col("__a"), F.col("content_type")
    text = F.coalesce(a["text"], a["raw_text"], F.lit(""))
    seen = F.coalesce(F.nullif(a["raw_text"], F.lit("")), a["image_description"], a["description"])
    table = (kind == "table") | ((kind == "figure") & looks_like_table(seen))
    skip = F.coalesce(F.col("metadata_only"), F.lit(False))
    none = F.lit(None)
    data = table_from_response(a["headers"], a["rows"], a["cells"], a["markdown"], a["raw_text"]).cast(TABLE)
    new = {
        "content_type": F.when(table & ~skip, F.lit("table")).otherwise(kind),
        "raw_text": F.when(skip, F.col("raw_text")).otherwise(text),
        "overview": F.when(~skip, F.coalesce(a["overview"], F.lit(""))),
        "entities": F.when(~skip, F.coalesce(a["entities"], F.array().cast(f"array<{ENTITY}>"))),
        "table_data": F.when(table & ~skip, data).otherwise(none.cast(TABLE)),
        "image_description": F.when((kind == "figure") & ~table & ~skip, F.coalesce(a["description"], F.lit(""))),
        "formula_latex": F.when((kind == "formula") & ~skip, F.coalesce(a["latex"], F.lit(""))),
        "structured_data": F.when(~skip, _structured(F.col("__body"))),
    }
    return found.select(*[c for c in chunks.columns if c not in new and c not in (answer, *PARSED)], *[v.alias(k) for k, v in new.items()])


# The request of an overview alone, and its length.
OVERVIEW_PROMPT, OVERVIEW_TOKENS = "In 1-2 sentences, describe this region.", 256


def overviews(chunks: DataFrame, model, concurrency: int = 8) -> DataFrame:
    """``chunks`` with overview asked for on its own, by a short prompt."""
    asked = call_model(chunks.drop("overview").withColumn("prompt", F.lit(OVERVIEW_PROMPT)), model, concurrency=concurrency)
    said = F.coalesce(parse_answer(F.col("answer"))["overview"], F.lit(""))
    return asked.withColumn("overview", said).drop("prompt", "answer")


def chunk_regions_lookup(chunks: DataFrame, regions: DataFrame) -> DataFrame:
    """Each chunk with the first region of its crop path (region_id; null if there is none)."""
    first = regions.groupBy("document_id", "cropped_image_path").agg(F.min_by("region_id", F.struct("page_number", "region_index")).alias("region_id"))
    return chunks.join(first, ["document_id", "cropped_image_path"], "left")


def document_status(chunks: DataFrame, strict: bool = False) -> DataFrame:
    """(document_id, processing_status): review_required if any chunk's confidence is under a half.
    Chunks that are metadata only are never scored, so they count only if ``strict``."""
    scored = chunks if strict or "metadata_only" not in chunks.columns else chunks.where(~F.coalesce(F.col("metadata_only"), F.lit(False)))
    low = F.bool_or(F.coalesce(F.col("confidence_score"), F.lit(0.0)) < REVIEW_BELOW)
    return scored.groupBy("document_id").agg(F.when(low, "review_required").otherwise("complete").alias("processing_status"))


def with_retry(call: Callable[[], tuple[int, str]], sleep: Callable[[float], None] = time.sleep, retries: int = MAX_RETRIES) -> str:
    """The body of a call that gives (status, body): busy and failing servers and broken connections are
    tried again after 1, 2, 4 seconds; what still fails is an empty object, other errors are raised."""
    for attempt in range(retries + 1):
        try:
            status, body = call()
        except (ConnectionError, TimeoutError):
            status, body = RETRY_STATUS[0], ""
        if status < 400:
            return body
        if status not in RETRY_STATUS:
            raise RuntimeError(f"extraction call failed with status {status}")
        if attempt < retries:
            sleep(2.0**attempt)
    return "{}"


def call_model(rows: DataFrame, model, prompt_col: str = "prompt", text_col: str = "raw_text", concurrency: int = 8) -> DataFrame:
    """Adds ``answer``: the provider's answer to each row's prompt and text.

    The provider is any object with ``answer(prompt, text) -> str``; it is sent to the executors, and each
    task keeps ``concurrency`` calls open; one call if the provider says that it never ``waits``. Its answers may differ from call to call, so callers write the
    result before they branch on it.
    """
    at_prompt, at_text = rows.columns.index(prompt_col), rows.columns.index(text_col)

    def run(batches):
        from concurrent.futures import ThreadPoolExecutor

        import pyarrow as pa

        with ThreadPoolExecutor(concurrency) as pool:
            calls = pool.map if getattr(model, "waits", True) else map
            for batch in batches:
                answers = list(calls(model.answer, batch.column(at_prompt).to_pylist(), batch.column(at_text).to_pylist()))
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(answers, pa.string())], [*batch.schema.names, "answer"])

    from pyspark.sql import types as T

    return rows.mapInArrow(run, T.StructType([*rows.schema.fields, T.StructField("answer", T.StringType())]))
