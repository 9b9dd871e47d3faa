"""Ingest as one plan: sources to documents, pages, regions, chunks, answers, stores."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quire.operators import chunking, extraction, layout, metrics, stores, validation
from quire.providers import RuleExtractor
from quire.schema import CURRENT_VERSION, ExtractionSchema, stable_id
from quire.sources import mail, routing, sheets
from quire.sources.readers import read_pages
from quire.sources.text import PAGE_CHARS, file_text, paginate

# System text and overview instruction by region type, in short.
PROMPTS = {
    "text": ("Extract all text exactly as written.", "In 1-2 sentences, describe what this text region covers."),
    "table": ("Extract the full table.", "In 1-2 sentences, describe what data this table presents."),
    "figure": ("Describe this image.", "In 1-2 sentences, describe what this image depicts."),
    "formula": ("Extract the formula as LaTeX.", "In 1-2 sentences, describe what this formula expresses."),
    "header": ("Extract the header text exactly as written.", "In one sentence, describe this header."),
    "footer": ("Extract the footer text exactly as written.", "In one sentence, describe this footer."),
    "caption": ("Extract the caption text exactly as written.", "In one sentence, describe what this caption refers to."),
}


@dataclass
class Config:
    page_chars: int = PAGE_CHARS
    max_text_chars: int = chunking.MAX_TEXT_CHARS
    max_passes: int = 2
    concurrency: int = 8
    crop_store: str = "crops"
    rules: tuple = validation.RULES
    prompts: dict = field(default_factory=lambda: dict(PROMPTS))
    suffix: str = ""


@dataclass
class Result:
    documents: DataFrame
    pages: DataFrame
    regions: DataFrame
    chunks: DataFrame


def file_pages(files: DataFrame, page_chars: int = PAGE_CHARS, readers: dict | None = None) -> DataFrame:
    """(document_id, source_path, content_hash, format, page_number, native_text, metadata, image, error) of
    routed files. A file that nothing reads has one row, without page number, that says why."""
    keyed = files.withColumn("document_id", stable_id(F.col("content_hash")))
    names = ["document_id", "source_path", "content_hash", "format"]
    own = [r for r in (readers or {}) if r.startswith(".")]  # a caller's reader for a suffix comes first
    spark_side = lambda name, *but: (F.col("reader") == name) & ~routing.suffix(F.col("source_path")).isin(*but, *own)
    plain = keyed.where(spark_side("text", "")).withColumn("text", file_text(F.col("content"), F.col("source_path")))
    told = ["source_path", "page_number", "native_text", "metadata"]
    text = paginate(plain.select("source_path", "text"), page_chars=page_chars).withColumn("metadata", F.lit(None).cast("map<string,string>"))
    mails = mail.mail_pages(keyed.where(spark_side("email", ".msg")), page_chars)
    sheet = F.create_map(F.lit("sheet"), "sheet", F.lit("headers"), F.to_json("headers"), F.lit("rows"), F.to_json("rows"), F.lit("markdown"), "markdown")
    books = sheets.sheet_pages(keyed.where(spark_side("excel", ".xls"))).withColumn("metadata", sheet)
    native = text.select(told).unionByName(mails.select(told)).unionByName(books.select(told))
    pages = native.withColumns({"image": F.lit(None).cast("binary"), "error": F.lit(None).cast("string")}).unionByName(read_pages(keyed, readers))
    why = F.when(F.col("page_number").isNull(), F.coalesce("error", F.concat(F.lit("no pages from a file of format "), F.col("format"))))
    return keyed.select(names).join(pages, "source_path", "left").select(*names, "page_number", "native_text", "metadata", "image", why.alias("error"))


class Pipeline:
    """The whole way from files or texts to chunks and stores; providers and sinks are plugged in.

    ``detector`` finds the regions of pages that have an image, ``steps`` cleans the images up before, ``cropper``
    cuts regions out; pages without image have the regions of their text. ``sinks``: by name, objects with
    ``write(documents, chunks, regions)`` (see stores.default_stores) or functions of the documents. ``manifest``: a
    TableStore by document_id and sink that keeps what became of each write.
    """

    def __init__(self, config: Config | None = None, extractor=None, sinks: dict | None = None, readers: dict | None = None, detector=None, steps=None, cropper=None, manifest: stores.TableStore | None = None):
        self.config, self.extractor, self.sinks = config or Config(), extractor or RuleExtractor(), sinks or {}
        self.readers, self.detector, self.steps, self.cropper, self.manifest = readers, detector, steps, cropper, manifest
        self.timings = metrics.Timings()

    def regions(self, pages: DataFrame) -> DataFrame:
        """Regions in reading order: by the detector and XY cuts where there is an image, else by the text."""
        seen = layout.virtual_regions(pages if self.detector is None or "image" not in pages.columns else pages.where("image is null"))
        if self.detector is not None and "image" in pages.columns:
            drawn = pages.where("image is not null")
            drawn = drawn if self.steps is None else stores.write_and_read(layout.preprocess(drawn, self.steps))
            found = stores.write_and_read(layout.detect_regions(drawn, self.detector))
            found = layout.xy_cut_order(found).withColumn("text", F.lit(""))
            if self.cropper is not None:
                found = layout.crop_regions(found, drawn, self.cropper)
            seen = seen.unionByName(found, allowMissingColumns=True)
        crop = self._crop_path(F.col("region_index"), F.col("region_type"))
        return seen.withColumns({"cropped_image_path": crop, "region_id": stable_id(F.col("document_id"), F.col("page_number"), F.col("region_index")), "schema_version": F.lit(CURRENT_VERSION)})

    def _crop_path(self, index: Column, kind: Column) -> Column:
        return layout.crop_path(F.lit(self.config.crop_store), F.col("document_id"), F.col("page_number"), index, kind)

    def run(self, pages: DataFrame, schema: ExtractionSchema | None = None, stored: DataFrame | None = None, unique: bool = False) -> Result:
        """``pages`` as file_pages gives them; documents whose content is ``stored`` are left out first. A
        document without pages is kept, for review, with the reason in error. Of files with one content the first by
        path is read, so pages, regions and chunks have keys of their own; ``unique``: the caller knows that there is
        one file for each content, so pages needn't meet.

        What a page's regions and chunks need is in its row, so texts go through a shuffle only where the chunks of a
        document are numbered and look at their neighbours, after the answers.
        """
        c = self.config
        pages = pages if stored is None else stores.unseen(pages, stored)
        if not unique:
            first = F.min("source_path").over(Window.partitionBy("document_id"))
            pages = pages.withColumn("__first", first).where(F.col("source_path").eqNullSafe(F.col("__first"))).drop("__first")
        pages = stores.write_and_read(pages, stores.SORTED_BYTES)
        read = pages.where("page_number is not null")
        regions = self.regions(read)
        if self.cropper is not None:
            regions = stores.write_and_read(regions)
        drawn = self.detector is not None and "image" in pages.columns
        if drawn:
            whole = chunking.gather_pages(regions)
        else:
            named = F.transform("regions", lambda r: r.withField("cropped_image_path", self._crop_path(r["region_index"], r["region_type"])))
            whole = layout.page_regions(read).withColumn("regions", named)
        chunks = chunking.chunk_pages(whole, c.max_text_chars)
        asked = chunks.withColumn("prompt", extraction.prompt(F.col("content_type"), c.prompts, c.suffix, schema))
        call = lambda rows: extraction.call_model(rows, self.extractor, concurrency=c.concurrency)
        content = asked.where(~F.col("metadata_only"))
        fill = lambda rows: extraction.populate(rows).drop("prompt")
        chunks = validation.validate_and_correct(call(content), call, c.rules, c.max_passes, fill=fill).drop("failed")
        if drawn:  # only a detector finds headers and footers
            bare = asked.where("metadata_only").drop("prompt").withColumns({"confidence_score": F.lit(0.0), "correction_applied": F.lit(False)})
            chunks = chunks.unionByName(stores.write_and_read(bare), allowMissingColumns=True)
        status = extraction.document_status(chunks)
        chunks = stores.dealt_out(chunks, "document_id", pages)
        chunks = chunking.number_chunks(chunking.with_page_break_context(chunks, "grp")).withColumn("schema_version", F.lit(CURRENT_VERSION))
        error = F.max("error") if "error" in pages.columns else F.lit(None).cast("string")
        documents = pages.groupBy("document_id", "content_hash", "format").agg(F.min("source_path").alias("source_path"), F.max("page_number").alias("total_pages"), error.alias("error"))
        state = F.when(F.col("error").isNotNull(), "review_required").otherwise(F.coalesce("processing_status", F.lit("complete")))
        documents = documents.join(status, "document_id", "left").withColumns({"processing_status": state, "schema_version": F.lit(CURRENT_VERSION)})
        return Result(documents, pages, regions, chunks)

    def write(self, result: Result, targets: list[str] | None = None, only_failed: DataFrame | None = None) -> DataFrame:
        """Documents, chunks, regions, graph and vectors to the sinks; the manifest, which is kept too."""
        tables = result.chunks, result.regions.drop("crop")

        def adapt(sink):
            if not hasattr(sink, "write"):
                return sink
            write = getattr(sink, "write_unique", sink.write)
            of = lambda docs, t: t if docs is result.documents else t.join(docs.select("document_id"), "document_id", "left_semi")
            return lambda docs: write(docs, *(of(docs, t) for t in tables))

        told = stores.write_to_sinks(result.documents, {n: adapt(s) for n, s in self.sinks.items()}, targets, only_failed)
        if self.manifest is not None:
            told = stores.write_and_read(told)
            self.manifest.upsert(told)
        return told


def ingest(spark: SparkSession, paths: list[str], schema: ExtractionSchema | None = None, targets: list[str] | None = None, pipeline: Pipeline | None = None, stored: DataFrame | None = None) -> DataFrame:
    """Ingest files and write to the pipeline's sinks; (document_id, processing_status) of each content, those that
    are ``stored`` already (document_id, content_hash, processing_status) with the status they have there."""
    pipeline = pipeline or Pipeline()
    with pipeline.timings.timed("read"):
        files = stores.first_of_content(routing.read_files(spark, *paths))
        known = None if stored is None else stored.join(files.select("content_hash"), "content_hash", "left_semi").select("document_id", "processing_status")
        fresh = files if stored is None else stores.unseen(files, stored)
    with pipeline.timings.timed("extract"):
        result = pipeline.run(file_pages(fresh, pipeline.config.page_chars, pipeline.readers), schema, unique=True)
        result.documents = stores.write_and_read(result.documents)
    if pipeline.sinks:
        with pipeline.timings.timed("write"):
            pipeline.write(result, targets)
    outcome = result.documents.select("document_id", "processing_status")
    return outcome if known is None else outcome.unionByName(known)
