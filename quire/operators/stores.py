"""Tables as stores: keyed upserts as a log, lookups, the write manifest."""

from __future__ import annotations

import functools
import json
import math
import uuid
from collections.abc import Callable, Iterable

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quire.operators import graph
from quire.session import shared_folder

# Columns that an upsert of an existing row replaces.
CHUNK_UPDATES = (
    "reading_order_index", "raw_text", "overview", "table_data", "image_description", "formula_latex", "structured_data",
    "entities", "cropped_image_path", "confidence_score", "correction_applied", "page_break_context", "caption", "metadata",
)
REGION_UPDATES = ("detector_confidence", "bbox", "cropped_image_path", "metadata")
VECTOR_PAYLOAD = ("chunk_id", "document_id", "content_type", "cropped_image_path", "overview", "page_number", "confidence_score")
SINKS = ("mongo", "postgres", "neo4j", "vector")


# Fixed value: of a written table, the bytes that one task is to sort at most.
SORTED_BYTES = 8 << 20


def write_and_read(df: DataFrame, task_bytes: int | None = None) -> DataFrame:
    """Fix a table in the shared folder, so what is computed from it doesn't compute it again. ``task_bytes``: a task
    reads about so many bytes of its files at most, or what the session allows if that is less; so what a task makes of
    them, and sorts by bucket to write it, doesn't grow with the table."""
    path = f"{shared_folder(df.sparkSession)}/quire/table-{uuid.uuid4().hex}"
    writer = df.write.option("compression", "zstd")
    if task_bytes is None:
        writer.parquet(path)
        return df.sparkSession.read.schema(df.schema).parquet(path)
    writer.option("parquet.block.size", str(task_bytes)).parquet(path)  # files are cut between their blocks
    # Only a session can say it, so a copy of this one reads the table; the session's own settings stay.
    session = df._jdf.sparkSession().cloneSession()
    most = min(task_bytes, session.sessionState().conf().filesMaxPartitionBytes())
    session.conf().set("spark.sql.files.maxPartitionBytes", str(most))
    return DataFrame(session.read().schema(session.parseDataType(df.schema.json())).parquet(path), df.sparkSession)


def dealt_out(rows: DataFrame, key: str, source: DataFrame) -> DataFrame:
    """``rows`` by ``key`` in so many partitions that each has about SORTED_BYTES of ``source``, the written table that
    they come from; so what a task sorts, and spills, doesn't grow with the table. Where the session's number of
    partitions is enough for that, they are left as they are."""
    n = math.ceil(int(source._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()) / SORTED_BYTES)
    return rows.repartition(n, key) if n > int(source.sparkSession.conf.get("spark.sql.shuffle.partitions")) else rows


def point_id(chunk_id: Column) -> Column:
    """The first 16 hex digits of an id without dashes, as an unsigned 64-bit number."""
    return F.conv(F.substring(F.replace(chunk_id, F.lit("-")), 1, 16), 16, 10).cast("decimal(20,0)")


def last_by_key(new: DataFrame, keys: list[str], order: str | None = None) -> DataFrame:
    """One row a key: the last by ``order``, without it any."""
    if order is None:
        return new.dropDuplicates(keys)
    last = F.row_number().over(Window.partitionBy(*keys).orderBy(F.col(order).desc()))
    return new.withColumn("__n", last).where("__n = 1").drop("__n")


def upsert_rows(old: DataFrame | None, new: DataFrame, keys: list[str], updates: Iterable[str] | None = None, order: str | None = None) -> DataFrame:
    """``old`` with the rows of ``new`` put in by key. ``updates``: the columns that an existing row takes
    from the new one (None: all). Of several new rows of a key the last by ``order`` counts.

    A full outer join by key: both sides shuffle once, neither is broadcast.
    """
    new = last_by_key(new, keys, order)
    if old is None:
        return new
    columns = list(dict.fromkeys([*old.columns, *new.columns]))
    a = old.select(F.struct(*old.columns).alias("a"), *[F.col(k).alias(f"__a_{k}") for k in keys])
    b = new.select(F.struct(*new.columns).alias("b"), *[F.col(k).alias(f"__b_{k}") for k in keys])
    same = None
    for k in keys:
        test = F.col(f"__a_{k}").eqNullSafe(F.col(f"__b_{k}"))
        same = test if same is None else same & test
    joined = a.join(b, same, "full")
    taken = set(columns if updates is None else updates)

    def value(c: str) -> Column:
        if c not in new.columns:
            return F.col(f"a.{c}")
        if c not in old.columns or c in taken:
            return F.when(F.col("b").isNotNull(), F.col(f"b.{c}")).otherwise(F.col(f"a.{c}") if c in old.columns else F.lit(None))
        return F.when(F.col("a").isNotNull(), F.col(f"a.{c}")).otherwise(F.col(f"b.{c}"))

    return joined.select(*[value(c).alias(c) for c in columns])


def bucket_of(keys: list[str], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*[F.col(k).cast("string") for k in keys]), F.lit(buckets)).cast("int")


class TableStore:
    """A table kept as a log of upserts, folded by key when it is read.

    An upsert writes its rows, and no others, to a folder of its own, dealt into buckets by key, and then
    creates the next marker file in log/, never over another one. The marker is the commit: a writer that
    finds its number taken goes on to the next, so two writers both count, and a failed write counts for
    nothing. Of a key's rows the last counts, but for columns outside ``updates``, which stay as first written.

    Compaction writes the fold as a base and marks it with the number it covers; it is due when there are
    ``compact_after`` upserts of together half the base's size or more, so rows are rewritten a number of
    times that grows with the logarithm of the table. ``bloom``: columns whose Parquet files get Bloom filters.
    """

    def __init__(self, spark: SparkSession, folder: str, keys: list[str], updates: Iterable[str] | None = None, buckets: int = 16, compact_after: int = 16, bloom: Iterable[str] = ()):
        self.spark, self.folder, self.keys, self.buckets, self.compact_after = spark, folder.rstrip("/"), keys, buckets, compact_after
        self.updates, self.bloom = None if updates is None else set(updates), tuple(bloom)
        self._jvm = spark.sparkContext._jvm
        self._fs = self._path("").getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def _path(self, name: str):
        return self._jvm.org.apache.hadoop.fs.Path(f"{self.folder}/{name}" if name else self.folder)

    def _numbers(self) -> list[int]:
        log = self._path("log")
        return sorted(int(n) for s in self._fs.listStatus(log) if (n := s.getPath().getName()).isdigit()) if self._fs.exists(log) else []

    def _entries(self) -> list[dict]:
        """What counts, oldest first: the widest base, then the upserts after what it covers."""
        told = []
        for n in self._numbers():
            file = self._fs.open(self._path(f"log/{n:012d}"))
            raw = bytes(file.readAllBytes())
            file.close()
            if raw:  # a writer lost before it closed its marker committed nothing
                told.append(json.loads(raw) | {"number": n})
        base = max((e for e in told if "covers" in e), key=lambda e: e["covers"], default=None)
        after = [e for e in told if "covers" not in e and (base is None or e["number"] > base["covers"])]
        return ([base] if base else []) + after

    def version(self) -> int | None:
        numbers = self._numbers()
        return numbers[-1] if numbers else None

    def _write(self, rows: DataFrame) -> dict:
        name = f"data/{uuid.uuid4().hex}"
        writer = rows.withColumn("__bucket", bucket_of(self.keys, self.buckets)).write.partitionBy("__bucket").option("compression", "zstd")
        for c in self.bloom:
            if c in rows.columns:
                # Adaptive: a filter is as large as its file's values need, not a MB in each of the many files.
                writer = writer.option(f"parquet.bloom.filter.enabled#{c}", "true").option("parquet.bloom.filter.adaptive.enabled", "true").option(f"parquet.bloom.filter.candidates.number#{c}", "10")
        writer.parquet(f"{self.folder}/{name}")
        return {"data": name, "schema": rows.schema.json(), "bytes": self._fs.getContentSummary(self._path(name)).getLength()}

    def _commit(self, told: dict) -> int:
        numbers = self._numbers()
        number = numbers[-1] + 1 if numbers else 0
        while True:
            try:
                out = self._fs.create(self._path(f"log/{number:012d}"), False)
                break
            except Py4JJavaError as e:
                if "FileAlreadyExists" not in str(e.java_exception):
                    raise
                number += 1
        out.write(bytearray(json.dumps(told).encode()))
        out.close()
        return number

    def _stored(self, entry: dict) -> DataFrame:
        schema = T.StructType.fromJson(json.loads(entry["schema"]))
        kinds = T.StructType([*(T.StructField(f.name, f.dataType) for f in schema), T.StructField("__bucket", T.IntegerType())])
        return self.spark.read.schema(kinds).parquet(f"{self.folder}/{entry['data']}")

    def _fold(self, entries: list[dict], narrow: Callable[[DataFrame], DataFrame] = lambda d: d) -> DataFrame | None:
        if not entries:
            return None
        frames, have = [], []
        for i, e in enumerate(entries):
            rows = self._stored(e)
            have.append([c for c in rows.columns if c != "__bucket"])
            frames.append(narrow(rows).drop("__bucket").withColumn("__n", F.lit(i)))
        if len(frames) == 1:
            return frames[0].drop("__n")
        rows = functools.reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
        columns = list(dict.fromkeys(c for names in have for c in names))

        def value(c: str) -> Column:
            written = F.when(F.col("__n").isin([i for i, names in enumerate(have) if c in names]), F.col("__n"))
            return (F.max_by if self.updates is None or c in self.updates else F.min_by)(c, written).alias(c)

        return rows.groupBy(*self.keys).agg(*[value(c) for c in columns if c not in self.keys]).select(columns)

    def read(self) -> DataFrame | None:
        return self._fold(self._entries())

    def matching(self, rows: DataFrame) -> DataFrame | None:
        """The stored rows with a key that ``rows`` have; only the buckets of those keys are read."""
        keys = write_and_read(rows.select(*self.keys).distinct())
        inside = [r[0] for r in keys.select(bucket_of(self.keys, self.buckets)).distinct().collect()]  # ``buckets`` numbers at most
        return self._fold(self._entries(), lambda d: d.where(F.col("__bucket").isin(inside)).join(keys, self.keys, "left_semi"))

    def upsert(self, new: DataFrame, order: str | None = None, unique: bool = False) -> DataFrame:
        """Put rows in by key; of several new rows of a key the last by ``order`` counts (without it: any).
        ``unique``: the caller knows that no two new rows share a key, so they needn't meet.
        Returns the new rows that count, read from where they were written; a vacuum after a compaction deletes them."""
        told = self._write(new if unique else last_by_key(new, self.keys, order))
        self._commit(told)
        entries = self._entries()
        deltas = [e for e in entries if "covers" not in e]
        base = sum(e["bytes"] for e in entries if "covers" in e)
        if len(deltas) >= self.compact_after and 2 * sum(e["bytes"] for e in deltas) >= base:
            self.compact()
        return self._stored(told).drop("__bucket")

    def compact(self) -> None:
        entries = self._entries()
        if len(entries) > 1:
            self._commit(self._write(self._fold(entries)) | {"covers": max(e.get("covers", e["number"]) for e in entries)})

    def vacuum(self) -> None:
        """Delete what no longer counts; for when nobody reads an earlier state."""
        entries = self._entries()
        kept, covered = {e["data"].split("/")[1] for e in entries}, max((e["covers"] for e in entries if "covers" in e), default=-1)
        if not entries:
            return
        newest = max(e["number"] for e in entries)
        for n in self._numbers():
            if n < newest and n not in {e["number"] for e in entries} and n <= max(covered, newest):
                self._fs.delete(self._path(f"log/{n:012d}"), False)
        for s in self._fs.listStatus(self._path("data")):
            if s.getPath().getName() not in kept:
                self._fs.delete(s.getPath(), True)


class DocumentStore:
    """Documents, chunks and regions under one folder, by identifier; documents also by content_hash."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.documents = TableStore(spark, f"{folder}/documents", ["document_id"], bloom=["content_hash"])
        self.chunks = TableStore(spark, f"{folder}/chunks", ["chunk_id"], CHUNK_UPDATES, bloom=["document_id"])
        self.regions = TableStore(spark, f"{folder}/regions", ["region_id"], REGION_UPDATES, bloom=["document_id"])

    def write(self, documents: DataFrame, chunks: DataFrame, regions: DataFrame, unique: bool = False) -> None:
        self.documents.upsert(documents)
        self.chunks.upsert(chunks, unique=unique)
        self.regions.upsert(regions, unique=unique)

    def write_unique(self, documents: DataFrame, chunks: DataFrame, regions: DataFrame) -> None:
        """For chunks and regions that have keys of their own, as the pipeline makes them."""
        self.write(documents, chunks, regions, True)

    def find_by_hash(self, content_hash: str) -> DataFrame | None:
        found = self.documents.read()
        return None if found is None else found.where(F.col("content_hash") == content_hash)

    def get_chunk(self, chunk_id: str) -> DataFrame | None:
        return self.chunks.matching(self.spark.createDataFrame([(chunk_id,)], "chunk_id string"))

    def chunks_of(self, document_id: str) -> DataFrame | None:
        found = self.chunks.read()
        return None if found is None else found.where(F.col("document_id") == document_id).orderBy("reading_order_index", "chunk_id")

    def regions_of(self, document_id: str) -> DataFrame | None:
        found = self.regions.read()
        return None if found is None else found.where(F.col("document_id") == document_id).orderBy("page_number", "region_index")

    def close(self) -> None:
        """Nothing is held open."""


class GraphStore:
    """The property graph as tables: nodes (documents, chunks, regions, entities, table rows) and edges."""

    def __init__(self, spark: SparkSession, folder: str):
        table = lambda name, *keys: TableStore(spark, f"{folder}/{name}", list(keys))
        self.spark = spark
        self.documents, self.chunks, self.regions = table("documents", "content_hash"), table("chunks", "chunk_id"), table("regions", "region_id")
        self.has_chunk, self.has_region = table("has_chunk", "document_id", "chunk_id"), table("has_region", "document_id", "region_id")
        self.next_chunk, self.mentions, self.table_rows = table("next_chunk", "from_id"), table("mentions", "chunk_id", "text", "type"), table("table_rows", "chunk_id", "row_index")

    def write(self, documents: DataFrame, chunks: DataFrame, regions: DataFrame, unique: bool = False) -> None:
        """Writing the same again changes nothing: every node and edge has a key. ``unique``: chunks and regions have
        keys of their own; then edges between nodes come from the nodes just written, so chunks aren't numbered, nor pages
        laid out, again for each kind of edge, and a chunk's mentions come from its row."""
        self.documents.upsert(documents.select("content_hash", "document_id", "source_path"))
        nodes = self.chunks.upsert(chunks.select("chunk_id", "document_id", "reading_order_index", "content_type", "page_number"), unique=unique)
        boxes = self.regions.upsert(regions.select("region_id", "document_id", "page_number", "region_index", "region_type"), unique=unique)
        self.has_chunk.upsert(nodes.select("document_id", "chunk_id") if unique else graph.has_chunk(chunks), unique=unique)
        self.has_region.upsert(boxes.select("document_id", "region_id") if unique else graph.has_region(regions), unique=unique)
        self.next_chunk.upsert(graph.next_chunk(nodes if unique else chunks), unique=unique)
        self.mentions.upsert(graph.mentions(chunks, unique), unique=True)  # they are distinct
        self.table_rows.upsert(graph.table_rows(chunks), unique=unique)

    def write_unique(self, documents: DataFrame, chunks: DataFrame, regions: DataFrame) -> None:
        self.write(documents, chunks, regions, True)

    def children(self, content_hash: str) -> DataFrame:
        """The chunks of a document in reading order."""
        document = self.documents.read().where(F.col("content_hash") == content_hash).select("document_id")
        held = self.has_chunk.read().join(document, "document_id", "left_semi").select("chunk_id")
        return self.chunks.read().join(held, "chunk_id", "left_semi").orderBy("reading_order_index", "chunk_id")

    def entities(self) -> DataFrame:
        return graph.entities(self.mentions.read())


class VectorStore:
    """Vectors of chunks with their payload, by chunk_id."""

    def __init__(self, spark: SparkSession, folder: str, embedder, visual: bool = False):
        self.table, self.embedder, self.visual = TableStore(spark, folder, ["chunk_id"]), embedder, visual

    def write(self, documents: DataFrame, chunks: DataFrame, regions: DataFrame, unique: bool = False) -> None:
        content = chunks.where(~F.coalesce("metadata_only", F.lit(False))) if "metadata_only" in chunks.columns else chunks
        points = embed_chunks(content, self.embedder, self.visual)
        self.table.upsert(points.withColumn("point_id", point_id(F.col("chunk_id"))), unique=unique)

    def write_unique(self, documents: DataFrame, chunks: DataFrame, regions: DataFrame) -> None:
        self.write(documents, chunks, regions, True)


def default_stores(spark: SparkSession, folder: str, embedder) -> dict:
    """The four sinks by name, each with ``write(documents, chunks, regions)``."""
    return dict(zip(SINKS, (DocumentStore(spark, f"{folder}/mongo"), DocumentStore(spark, f"{folder}/postgres"), GraphStore(spark, f"{folder}/neo4j"), VectorStore(spark, f"{folder}/vector", embedder))))


def first_of_content(documents: DataFrame, order: str = "source_path") -> DataFrame:
    """One row for each content_hash: the first by ``order``. A partial aggregate, so copies meet as one row a task."""
    columns = [c for c in documents.columns if c != "content_hash"]
    first = documents.groupBy("content_hash").agg(F.min_by(F.struct(*columns), order).alias("x"))
    return first.select(*[F.col("content_hash") if c == "content_hash" else F.col(f"x.{c}").alias(c) for c in documents.columns])


def unseen(documents: DataFrame, stored: DataFrame | None) -> DataFrame:
    """Documents whose content_hash isn't stored yet."""
    return documents if stored is None else documents.join(stored.select("content_hash"), "content_hash", "left_anti").select(documents.columns)


def select_sinks(names: Iterable[str], targets: Iterable[str] | None) -> list[str]:
    """The sinks that ``targets`` asks for (None: all); "mongodb" means mongo too."""
    if targets is None:
        return list(names)
    wanted = {{"mongodb": "mongo"}.get(t.lower(), t.lower()) for t in targets}
    return [n for n in names if n in wanted]


MANIFEST = "document_id string, sink string, status string, error string"


def write_to_sinks(documents: DataFrame, sinks: dict[str, Callable[[DataFrame], None]], targets: Iterable[str] | None = None, only_failed: DataFrame | None = None) -> DataFrame:
    """Write to each sink in turn; a failing sink doesn't stop the others. Returns the manifest
    (document_id, sink, status, error), a row for each document and sink.

    ``only_failed``: an earlier manifest; then a sink gets only the documents that failed there.
    """
    rows = None
    for name in select_sinks(sinks, targets):
        batch = documents
        if only_failed is not None:
            batch = documents.join(only_failed.where((F.col("sink") == name) & (F.col("status") != "ok")).select("document_id").distinct(), "document_id", "left_semi")
        try:
            sinks[name](batch)
            status, error = "ok", None
        except Exception as e:  # noqa: BLE001  what went wrong is the manifest's content
            status, error = "error", f"{type(e).__name__}: {e}".splitlines()[0]
        told = batch.select("document_id", F.lit(name).alias("sink"), F.lit(status).alias("status"), F.lit(error).cast("string").alias("error"))
        rows = told if rows is None else rows.unionByName(told)
    return rows if rows is not None else documents.sparkSession.createDataFrame([], MANIFEST)


def encode_rows(rows: DataFrame) -> DataFrame:
    """Nested columns as JSON text, for a store of plain rows: a null array is [], any other null {}."""
    def cell(f: T.StructField) -> Column:
        if not isinstance(f.dataType, (T.StructType, T.ArrayType, T.MapType)):
            return F.col(f.name)
        return F.coalesce(F.to_json(f.name), F.lit("[]" if isinstance(f.dataType, T.ArrayType) else "{}")).alias(f.name)

    return rows.select(*[cell(f) for f in rows.schema])


def decode_rows(rows: DataFrame, schema: T.StructType) -> DataFrame:
    """The nested columns of ``schema`` again, from their JSON text; what is null or not JSON is empty."""
    def cell(f: T.StructField) -> Column:
        if not isinstance(f.dataType, (T.StructType, T.ArrayType, T.MapType)):
            return F.col(f.name)
        empty = "[]" if isinstance(f.dataType, T.ArrayType) else "{}"
        return F.coalesce(F.from_json(F.col(f.name), f.dataType), F.from_json(F.lit(empty), f.dataType)).alias(f.name)

    return rows.select(*[cell(f) for f in schema])


def embed_source(chunks: DataFrame, visual: bool = False) -> DataFrame:
    """(chunk_id, embed_kind, embed_input): what of a chunk is embedded: a figure's image if visual
    embedding is on, else its description; the overview of anything else."""
    kind, value = _embedded(chunks, visual)
    return chunks.select("chunk_id", kind.alias("embed_kind"), value.alias("embed_input"))


def _embedded(chunks: DataFrame, visual: bool) -> tuple[Column, Column]:
    col = lambda c: F.col(c) if c in chunks.columns else F.lit(None).cast("string")
    figure = F.col("content_type") == "figure"
    path = F.coalesce(col("cropped_image_path"), F.lit("")) != ""
    image = figure & F.lit(visual) & path
    described = figure & (F.coalesce(col("image_description"), F.lit("")) != "")
    kind = F.when(image, "image").when(described, "description").otherwise("overview")
    value = F.when(image, col("cropped_image_path")).when(described, col("image_description")).otherwise(F.coalesce("overview", F.lit("")))
    return kind, value


def embed_chunks(chunks: DataFrame, embedder, visual: bool = False) -> DataFrame:
    """(vector payload, vector) of chunks: what embed_source picks goes through the embedder, any object
    with ``embed(text) -> list of floats``. Columns of the payload that chunks lack are left out."""
    payload = [c for c in VECTOR_PAYLOAD if c in chunks.columns]
    rows = chunks.select(*payload, _embedded(chunks, visual)[1].alias("embed_input"))
    at = len(payload)

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            vectors = pa.array([embedder.embed(t) for t in batch.column(at).to_pylist()], pa.list_(pa.float32()))
            yield pa.RecordBatch.from_arrays([*batch.columns[:at], vectors], [*payload, "vector"])

    return rows.mapInArrow(run, T.StructType([*rows.schema.fields[:at], T.StructField("vector", T.ArrayType(T.FloatType()))]))
